"""sparkmill: DataFrame-first analytics operators on Apache Spark.

Families: text and word frequency, access-log mining, rating statistics,
recommenders, PageRank and frequent word sets.  Every operator takes and
returns DataFrames and is planned by Catalyst; see README.md.
"""

__version__ = "0.1.0"
