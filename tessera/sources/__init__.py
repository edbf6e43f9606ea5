"""Scans: landed response pages, catalogs, raw observation files, tables."""
