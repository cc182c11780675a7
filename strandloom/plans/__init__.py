"""Reusable physical patterns: lineage cuts, range joins, components."""
