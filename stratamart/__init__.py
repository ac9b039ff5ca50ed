"""Layered retail analytics (bronze, silver, gold) as PySpark DataFrame operators."""
