"""Registered queries: one per operator of the inventory, each with its DuckDB oracle.

Each query reads the driver tables (or views Spark derives from them) in full.
"""
from tessera.queries import q_plans, q_functions, q_flatten, q_ledger, q_catalog, q_files, q_resample, q_robust, q_cursor  # noqa: F401
