"""Reconciliation analytics as Spark DataFrame plans."""
