"""Composite checks: comparison, schema and quantity checks, suites, rebuild."""
