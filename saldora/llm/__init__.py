"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``benchmark``.

One module per operator; ``queries`` registers them. Nothing outside this package
imports it.
"""
