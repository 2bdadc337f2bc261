"""tramline: a city-transport warehouse built with PySpark DataFrames.

Sub-packages
------------
functions   Column -> Column rules (cleaning, dates, keys, payload text)
sources     scans of landed files, page plans, landing audits, date ranges
operators   projections, filters, joins, set operations on DataFrames
sinks       file writes, conforming a batch to a table, table-write protocols
plans       the jobs: clean, staging, dimensions, facts and their daily runs
workload    every operator run on the driver's tables, with its SQL twin
"""
