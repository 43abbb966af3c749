"""Whole refreshes, reports, monitors and example-data jobs."""
