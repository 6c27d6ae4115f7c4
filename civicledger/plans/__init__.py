"""Warehouse models, registered queries, backfill and the daily run."""
