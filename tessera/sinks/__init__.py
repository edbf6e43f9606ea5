"""Sinks: raw day files, bronze table, manifest, miss log, tier snapshots."""
