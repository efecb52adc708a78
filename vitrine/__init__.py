"""Vitrine: retail catalogue snapshots as PySpark DataFrame operators."""
