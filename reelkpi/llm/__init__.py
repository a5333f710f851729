"""Operators of a large training-data pipeline on Spark DataFrames.

One module per operator, `registry` names their queries. Nothing outside this
folder imports it. Functions that run inside Python workers travel by value
(see `common.ship`), so executors need no copy of this package on their path.
"""
