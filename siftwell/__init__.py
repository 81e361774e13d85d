"""Posting analytics as Spark DataFrame operators."""
