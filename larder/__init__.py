"""Larder: product-catalogue refinery on Spark DataFrames.

Raw delimited listings become dated bronze Parquet, cleaned silver tables and
four reporting marts.  Every function takes and returns DataFrames and uses the
session of its inputs; nothing here creates or configures a session.
"""

__version__ = "0.1.0"
