"""Layered-table operators for Spark: increments, history, harmonization, monitors."""
