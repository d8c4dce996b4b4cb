"""Point-in-time market-data analytics as composable PySpark DataFrame operators."""
