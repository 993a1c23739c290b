"""textgauge: text audits, prompt batches and classifier evaluation as Spark jobs.

Every operator takes DataFrames and returns DataFrames built from Spark SQL
expressions and ``pyspark.ml``; there are no Python UDFs.
"""

__version__ = "0.1.0"
