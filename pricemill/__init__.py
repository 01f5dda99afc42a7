"""Commodity-price analytics as Spark DataFrame operators.

Sub-packages
------------
functions   column expressions: numbers, dates, text
operators   DataFrame in, DataFrame out: shape, filter, measure, order, check
sources     sheets, report texts, stored pages, tables, generated integers
sinks       snapshots and typed tables
streaming   incremental load of new report files
plans       the grain, horticulture and livestock jobs and their questions
"""

__version__ = "0.1.0"
