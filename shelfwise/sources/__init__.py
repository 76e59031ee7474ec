"""Readers of the feeds, reference tables, result tables and test views."""
