"""Ordered transaction batches as flat tables on Spark."""
