"""walletflow: keyed JSON enrichment on Spark.

Keys (wallet addresses) come from a table or a saved result; one JSON
document per key is looked up (landed table, as-of history, or a user
fetch function run on the executors in retry rounds); documents are
checked and flattened with Catalyst expressions only; typed rows are
written as CSV or loaded into catalog tables with append, full-refresh
and history semantics, together with rejects, dead letters and
run statistics.
"""

from walletflow.session import prepare, scratch_path

__all__ = ["prepare", "scratch_path"]
