"""Panel building and geo-enrichment on Spark DataFrames.

``functions``  Column -> Column rules for missing values, numbers, text and dates
``operators``  DataFrame -> DataFrame steps (joins, grids, recoding, spatial)
``sources``    readers and writers
``plans``      the composed jobs

No function here creates a session, sets a Spark option or uses a Python UDF.
"""
