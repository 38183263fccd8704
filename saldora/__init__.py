"""Banking analytics on Spark: churn (track A) and campaign adoption (track B).

Layout
------
``functions``  column expressions and the metric registry
``operators``  DataFrame -> DataFrame building blocks (ranks, tests, models, ...)
``sources``    schemas, readers, writers
``plans``      named views, business questions, dashboard extracts, end-to-end jobs
``catalog``    the registered queries on the test tables, with their SQL twins
"""

import sys

from pyspark import cloudpickle

# The few functions that run inside tasks travel by value, so executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
