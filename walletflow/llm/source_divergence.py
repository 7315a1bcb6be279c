"""How far the word use of the sources of a language lies apart.

Counting: Arrow batches of whole texts become counts per (language, source,
term), added up inside a task before the shuffle and by partial aggregates
after.  A language keeps the terms in at least ``LEAST`` of its documents; their
stored table gives each an id in the order of the terms.

A group's counts are sorted (term id, count) arrays, one per block of ``BLOCK``
neighbouring ids, so no row grows with the vocabulary.  Every unordered pair of
sources and block of ids is one task: the two groups' arrays are co-grouped, the
shorter one is looked up in the longer one by galloping (binary search over its
sorted ids), and terms of both, of the first only and of the second only are
priced.  Terms that neither group has all cost the same and are priced by their
number once per pair.  The cost is symmetric, so each pair gives a row both ways.

All arithmetic is in whole numbers: the share's division is done in two steps
of long division (10^5, 10^4), which holds to 9 * 10^13 occurrences.

The most telling terms of a group are the ten highest prices against its whole
language; the rank limit is applied inside the tasks before the shuffle.

Defined results: null text, language or source is the empty string; repeated rows
are documents of their own; a source without kept terms still gives pair rows;
a language with one source has no pair rows; without kept terms every pair costs
0; ties rank by the item's UTF-8 bytes; extra columns are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walletflow.llm.common import ship, slices, stored
from walletflow.operators.numbering import dense_number

ship(__name__)
ship("walletflow.llm.common")

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"  # fixed: runs of letters A-Z and of all characters beyond ASCII
LEAST = 10  # fixed: documents of its language that a kept term is in
TOP = 10  # fixed: ranks of the terms reported
WHOLE = 10**9  # fixed: the share of everything
TEXT_BYTES = 4 << 20
HELD = 400_000  # counts that a task holds before it hands them on
BLOCK = 1 << 11  # neighbouring term ids in one array


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, one row per group and term; one
    row with a null term per group, so that groups without terms stay."""

    def run(batches):
        import collections
        import re

        import pyarrow as pa

        find = re.compile(TERM).findall
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        held: dict = {}

        def flush():
            rows = [(*g, t, n, d[t]) for g, (c, d) in held.items() for t, n in c.items()]
            rows += [(*g, None, 0, 0) for g in held]
            held.clear()
            for at in range(0, len(rows), 50_000):
                columns = zip(*rows[at : at + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "source", "term", "n", "docs"])

        for batch in slices(batches, TEXT_BYTES, "text"):
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                # bytes.lower() changes A-Z only
                terms = find(text.lower().decode("utf-8", "replace"))
                counts, within = held.setdefault((lang, source), (collections.Counter(), collections.Counter()))
                counts.update(terms)
                within.update(set(terms))
            if sum(len(c) for c, _ in held.values()) > HELD:
                yield from flush()
        if held:
            yield from flush()

    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    rows = texts.withColumn("text", F.col("text").cast("binary")).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, kept: str) -> str:
    """SQL of 1 + floor(10^9 * (count + 2) / (total + 2 * kept)), within 64 bits."""
    x, y = f"(100000 * ({count} + 2))", f"({total} + 2 * {kept})"
    return f"(1 + {x} div {y} * 10000 + ({x} % {y} * 10000) div {y})"


def price(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def priced(mine, other, own_total: int, other_total: int, kept: int):
    """(terms of either, cost of these) of two sorted sparse arrays; see ``share`` and ``price``."""
    import numpy as np

    def shares(count, total):
        x, y = 100_000 * (count + 2), total + 2 * kept
        return 1 + x // y * 10_000 + x % y * 10_000 // y

    (a, n), (b, m) = mine, other
    swapped = len(a) > len(b)
    if swapped:
        (a, n, own_total), (b, m, other_total) = (b, m, other_total), (a, n, own_total)
    # every id of the shorter array gallops to its place in the longer one
    at = np.searchsorted(b, a)
    met = at < len(b)
    met[met] = b[at[met]] == a[met]
    partner = np.zeros(len(a), dtype=np.int64)
    partner[met] = m[at[met]]
    alone = np.ones(len(b), dtype=bool)
    alone[at[met]] = False
    none = np.zeros(int(alone.sum()), dtype=np.int64)
    p = np.concatenate([shares(n, own_total), shares(none, own_total)])
    q = np.concatenate([shares(partner, other_total), shares(m[alone], other_total)])
    return len(p), int(((p - q) * (p - q) // (p + q)).sum())


def divergence(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, terms): (lang, source, item, value) of every ordered pair of sources, and of the
    terms that a group uses more than its language."""
    counts = stored(term_counts(docs), "divergence-counts")
    found = counts.where("term is not null")
    kept = found.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= LEAST)
    terms = stored(dense_number(kept.drop("docs"), ["lang", "term"], "tid"), "divergence-terms")
    langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    mine = stored(found.drop("docs").join(terms, ["lang", "term"]), "divergence-kept")
    totals = mine.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = stored(
        counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
            "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "kept", "lang_total")]
        ),
        "divergence-groups",
    )
    return _pairs(mine, groups), _terms(mine, groups)


def _pairs(mine: DataFrame, groups: DataFrame) -> DataFrame:
    arrays = stored(
        mine.groupBy("lang", "source", F.expr(f"tid div {BLOCK}").alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct(F.expr(f"cast(tid % {BLOCK} as smallint)").alias("id"), "n"))).alias("cells"))
        .select("lang", "source", "block", F.col("cells.id").alias("ids"), F.col("cells.n").alias("counts")),
        "divergence-arrays",
    )
    first = groups.select("lang", F.col("source").alias("a"), F.col("total").alias("a_total"), "kept")
    second = groups.select("lang", F.col("source").alias("b"), F.col("total").alias("b_total"))
    pairs = first.join(second, "lang").where("a < b")
    key = ["lang", "a", "b", "block"]
    columns = [*key, "ids", "counts", "a_total", "b_total", "kept"]
    sides = [  # toDF: the two sides' columns are told apart though both come from the same tables
        pairs.join(arrays.withColumnRenamed("source", side), ["lang", side]).select(*columns).toDF(*columns).groupBy(*key) for side in ("a", "b")
    ]

    def run(key, left, right):
        import numpy as np
        import pyarrow as pa

        def cells(side):
            if not side.num_rows:
                return np.zeros(0, dtype=np.int16), np.zeros(0, dtype=np.int64)
            return tuple(side.column(c).combine_chunks().values.to_numpy() for c in ("ids", "counts"))

        known = left if left.num_rows else right
        constant = [known.column(c)[0].as_py() for c in ("a_total", "b_total", "kept")]
        either, cost = priced(cells(left), cells(right), *constant)
        return pa.table({"lang": [key[0]], "a": [key[1]], "b": [key[2]], "either": [either], "cost": [cost]}, schema=pa.schema(
            [("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("either", pa.int64()), ("cost", pa.int64())]
        ))

    costs = sides[0].cogroup(sides[1]).applyInArrow(run, "lang string, a string, b string, either long, cost long")
    sums = costs.groupBy("lang", "a", "b").agg(F.sum("either").alias("either"), F.sum("cost").alias("cost"))
    zero = F.lit(0).cast("long")
    absent = price(share("0L", "a_total", "kept"), share("0L", "b_total", "kept"))
    every = pairs.join(sums, ["lang", "a", "b"], "left").select(
        "lang", "a", "b",
        F.when(F.col("kept") == 0, zero).otherwise(
            F.coalesce("cost", zero) + (F.col("kept") - F.coalesce("either", zero)) * F.when(F.col("kept") > 0, F.expr(absent))
        ).alias("value"),
    )
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return every.select("lang", F.inline(ways), "value")


def _terms(mine: DataFrame, groups: DataFrame) -> DataFrame:
    joined = mine.join(groups, ["lang", "source"])
    shares = joined.select(
        "lang", "source", F.col("term").alias("item"),
        F.expr(share("n", "total", "kept")).alias("p"),
        F.expr(share("lang_n", "lang_total", "kept")).alias("q"),
    )
    return shares.where("p > q").select("lang", "source", "item", F.expr(price("p", "q")).alias("value"))


def divergence_report(docs: DataFrame) -> DataFrame:
    """All ranks of the pairs and the first ``TOP`` ranks of the terms, per group."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs, terms = divergence(docs)
    rank = F.row_number().over(order).cast("int").alias("rank")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    best = terms.select("*", F.lit("term").alias("part"), rank).where(F.col("rank") <= TOP)
    return pairs.select("*", F.lit("pair").alias("part"), rank).select(*columns).unionByName(best.select(*columns))
