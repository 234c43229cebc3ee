"""Dimensions, facts, views and dashboards."""
