"""Service-request analytics as plain PySpark DataFrame operators."""
