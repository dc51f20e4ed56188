"""Warehouse refreshes over versioned records, written as Spark DataFrame operators."""
