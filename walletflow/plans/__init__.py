"""Composed plans: derived fixtures, jobs and the registered queries."""
