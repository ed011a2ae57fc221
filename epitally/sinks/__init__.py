"""Sinks: lake copies, relational tables, saved models and the run log."""
