from __future__ import annotations

import datetime as dt

from saldora.catalog import checks_queries, roles
from saldora.session import local_frame

# Every modulus of the role mapping divides it: two orders this far apart differ in the key only.
APART = 8 * 3 * 125 * 49 * 997 * 41 * 10007


def test_contacts_that_only_the_key_tells_apart(spark, tmp_path):
    """The raw file has no key: equal contacts are one row, and the expected number says so."""
    day = dt.date(2000, 5, 1)
    orders = [(k, 1 + k % 7, "O", 10.0, day, "1-URGENT") for k in range(1, 60)]
    orders += [(100 + APART * i, 1, "O", 10.0, day, "1-URGENT") for i in range(3)]
    customers = [(k, f"c{k}", k % 25, 100.0 * k, "AUTOMOBILE") for k in range(1, 8)]
    local_frame(spark, orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"
                ).write.parquet(f"{tmp_path}/orders.parquet")
    local_frame(spark, customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
                ).write.parquet(f"{tmp_path}/customer.parquet")
    raw, clean = roles.track_b_raw(spark, str(tmp_path)), roles.cleaned_b(spark, str(tmp_path)).data
    assert raw.count() == 63 and clean.count() == 60  # order 3 is in the raw file twice
    found = {r["dataset"]: (r["checks"], r["passed"]) for r in checks_queries.v12(spark, str(tmp_path)).collect()}
    assert found == {"churn": (14, 14), "campaign": (6, 6)}
