"""Document ETL and record linkage on PySpark DataFrames."""

__version__ = "0.1.0"
