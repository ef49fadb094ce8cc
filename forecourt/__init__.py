"""Station sales analytics as PySpark DataFrame plans."""
