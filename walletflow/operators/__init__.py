"""Operators: label and portfolio flatten, keyed fetch rounds, numbering, statistics."""
