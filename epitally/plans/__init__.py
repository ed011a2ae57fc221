"""Whole jobs put together from the operators, and the catalogue of checked queries."""
