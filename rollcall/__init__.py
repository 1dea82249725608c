"""Workforce analytics as Spark DataFrame operators."""
