"""Scans: landed JSON, relational tables, and the star-schema tables used for checks."""
