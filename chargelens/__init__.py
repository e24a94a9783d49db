"""Charging-availability analytics as lazy PySpark DataFrame operators."""
