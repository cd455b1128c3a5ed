"""Retail analytics on Spark DataFrames.

Layers, from the bottom up:

* ``functions``  column expressions (exact rounding, text, dates)
* ``sources``    where rows come from and go to (CSV, lake zones, fact table, test views)
* ``operators``  ``DataFrame -> DataFrame`` steps (clean, validate, KPIs, breakdowns, ...)
* ``plans``      whole reports and the batch load built from operators
* ``streaming``  the same load driven by Structured Streaming
"""
