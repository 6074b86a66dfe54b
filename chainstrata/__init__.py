"""Ledger and market time-series analytics as Spark DataFrame operators."""
