"""Air-quality time-series analytics as plain Spark DataFrame functions.

Every operator takes and returns DataFrames keyed by ``city`` and ordered by
``timestamp``; nothing here needs a whole series in one task.
"""
