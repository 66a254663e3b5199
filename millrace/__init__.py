"""millrace: batch ETL and analytics for tabular event data, on Spark DataFrames.

Sub-packages
------------
``sources``    readers, writers, batch-published tables
``functions``  column expressions (text, numbers, dates)
``operators``  keys, joins, aggregates, data-quality checks, change logs
``plans``      whole jobs: star build, loads, documents, published datasets
``streaming``  the same idempotent loads, run per micro-batch
``queries``    every operator over the synthetic benchmark tables, with SQL twins
"""

__version__ = "0.1.0"
