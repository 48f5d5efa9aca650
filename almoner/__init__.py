"""Constituent-relationship analytics as composable PySpark DataFrame operators."""
