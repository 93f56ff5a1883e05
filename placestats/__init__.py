"""Place analytics as PySpark DataFrame operators."""
