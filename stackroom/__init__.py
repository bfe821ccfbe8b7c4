"""Stackroom: prepare, check and serve tables with Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark's own
expressions, so Catalyst sees the whole plan and the same code runs on a laptop
and on a cluster.
"""
