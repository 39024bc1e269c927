"""Medallion-style lakehouse jobs, audits and reconciliation on plain Spark DataFrames."""
