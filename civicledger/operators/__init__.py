"""Keyed operators, merges, SCD2 and data-quality checks (DataFrame -> DataFrame)."""
