"""Retail order-line analytics as Spark DataFrame operations."""
