"""Card-transaction risk analytics as PySpark DataFrame, SQL, MLlib and streaming jobs."""

__version__ = "0.1.0"
