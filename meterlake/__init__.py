"""Metered usage, chargeback and run health as Spark DataFrame operators."""
