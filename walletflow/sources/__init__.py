"""Sources: saved results, key columns, landed documents, as-of history, CSV."""
