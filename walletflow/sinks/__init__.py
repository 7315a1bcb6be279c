"""Sinks: CSV files in the reference's dialect and catalog tables."""
