"""Reusable DataFrame operators (selection, combination, prefix scans, matching, hierarchies)."""
