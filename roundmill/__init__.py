"""Roundmill: a Spark-first engine for deal intelligence data.

Every operator is ``DataFrame -> DataFrame`` or ``Column -> Column``; reference time, rates and
thresholds are parameters, and nothing is collected unless its size has a stated bound.
"""
