"""Secret scan through a trigram inverted index (DataFrame functions only).

Each rule's pattern gives a Boolean trigram query (``trigram_query``).  The
postings (trigram, text key) hold the trigrams that some rule asks for; they
are intersected per clause of the query, and only the candidates of a rule run
its pattern.  Rules without mandatory trigrams scan every text.  The text key
is a 64-bit hash: a collision only adds a candidate, and every candidate is
verified by its pattern.  Equal texts share one posting.

Defined results: a null text is empty and has no spans; a null ``doc_id`` is
kept; repeated rows each give a row; extra columns are carried and never read
(inside, the input's columns have numbers, so no name can clash); an empty table
gives an empty table.  Spans count code points, end exclusive.  Work in a text
is linear in its length and hits: running positions are summed in blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walletflow.llm.common import barrier, numbered
from walletflow.llm.trigram_query import trigram_query

BLOCK = 512  # hits whose positions are summed together


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` is common to Java and Python.  A match counts if group ``group``
    holds at least ``least`` characters; ``probe`` is a cheap necessary test."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    probe: str | None = None


# Fixed patterns of the base kinds.  [0-9a-f]{16,} finds the runs of 16 and more.
BASE_RULES = (
    SecretRule(
        "assign",
        r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=1,
        least=12,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]+", least=18),
    SecretRule("hex", r"[0-9a-f]{16,}", least=16, probe=r"[0-9a-f]{16}"),
)
# A private key runs over its lines (also with line ends written as \\n) to the END line; without one, a body
# that begins with a long word runs to the first character outside base64 and white space.
# The head's fields have an upper length or give nothing back, as their characters are also those of what follows.
KEY_HEAD = r"(?:[\x09-\x0D\x20\\nr]{0,40}Proc-Type:[0-9A-Z,\x20]{0,40}[\x09-\x0D\x20\\nr]{0,40}DEK-Info:[0-9A-Z,\x20-]{0,80}+)?"
KEY_BODY = r"[A-Za-z0-9+/=\x09-\x0D\x20\\]*+"
# Further kinds, all with mandatory trigrams.
MORE_RULES = (
    SecretRule(
        "private_key",
        r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
        rf"(?:{KEY_HEAD}{KEY_BODY}-----END [A-Z ]{{0,20}}PRIVATE KEY-----|{KEY_HEAD}[\x09-\x0D\x20\\nr]*[A-Za-z0-9+/]{{16}}{KEY_BODY})?",
    ),
    SecretRule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    # starts only where a run of token characters starts, so each run is read a few times at most
    SecretRule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    SecretRule("url_login", r"[a-z]{2,10}://[A-Za-z0-9._-]+:[^\x00-\x20/@:]{6,}@"),
)
RULES = BASE_RULES + MORE_RULES


def candidate_rules(texts: DataFrame, rules=RULES) -> DataFrame:
    """(key, rules): for every text key the rules whose trigram query it satisfies.

    ``texts`` has ``key`` and ``text``; rules that scan fully are not listed."""
    clauses = [
        (f"{r.kind}:{i}", r.kind, len(clause), t)
        for r in rules
        for i, clause in enumerate(sorted(map(sorted, trigram_query(r.pattern) or ())))
        for t in clause
    ]
    spark = texts.sparkSession
    if not clauses:
        return spark.createDataFrame([], "key long, rules array<string>")
    vocabulary = sorted({c[3] for c in clauses})
    low = texts.select("key", F.lower("text").alias("low"))
    postings = (
        low.select(
            "key",
            F.explode(F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in vocabulary]))).alias("trigram"),
        )
        .distinct()
    )
    query = spark.range(1).select(
        F.inline(
            F.array(*[
                F.struct(F.lit(c).alias("clause"), F.lit(k).alias("kind"), F.lit(n).alias("need"), F.lit(t).alias("trigram"))
                for c, k, n, t in clauses
            ])
        )
    )
    return (
        postings.join(F.broadcast(query), "trigram")  # one row per trigram of a rule: fixed size
        .groupBy("key", "clause", "kind", "need")
        .agg(F.count("*").alias("have"))
        .where("have = need")
        .groupBy("key")
        .agg(F.collect_set("kind").alias("rules"))
    )


def _running(steps: Column) -> Column:
    """Spans from (gap, hit) lengths: sums in blocks, then block offsets."""
    total = F.size(steps)
    empty = F.expr("cast(array() as array<struct<s:bigint,e:bigint>>)")
    blocks = F.when(total > 0, F.transform(
        F.sequence(F.lit(0), F.floor((total - 1) / BLOCK).cast("int")),
        lambda b: F.aggregate(
            F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)),
            F.struct(F.lit(0).cast("long").alias("t"), empty.alias("out")),
            lambda a, x: F.struct(
                (a["t"] + x["gap"] + x["hit"]).alias("t"),
                F.concat(a["out"], F.array(F.struct(
                    (a["t"] + x["gap"]).alias("s"), (a["t"] + x["gap"] + x["hit"]).alias("e")
                ))).alias("out"),
            ),
        ),
    ))
    return F.coalesce(blocks, F.expr("cast(array() as array<struct<t:bigint,out:array<struct<s:bigint,e:bigint>>>>)"))


def _offsets(blocks: Column) -> Column:
    start = F.array(F.lit(0).cast("long"))
    return F.aggregate(blocks, start, lambda a, b: F.concat(a, F.array(F.element_at(a, -1) + b["t"])))


def _at_least(least: int):
    return lambda value: F.length(value) >= least


def find_secrets(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """(in0, in1, ..., spans): every input row, its columns by number, and its
    ``array<struct<start, rank, kind, end>>`` ordered by start, then rule."""
    base = numbered(docs)
    own = base.columns
    base = base.withColumn("text", F.coalesce(F.col(f"in{docs.columns.index(text)}"), F.lit("")))
    base = base.withColumn("key", F.xxhash64("text"))
    found = candidate_rules(base.select("key", "text"), rules)
    work = base.join(found, "key", "left")

    def wanted(rule: SecretRule) -> Column:
        if trigram_query(rule.pattern) is not None:
            return F.array_contains("rules", F.lit(rule.kind))
        return F.rlike("text", F.lit(rule.probe or rule.pattern))

    none = F.expr("cast(array() as array<string>)")
    cut = {}
    for i, r in enumerate(rules):
        cut[f"p{i}"] = F.when(wanted(r), F.split("text", r.pattern, -1)).otherwise(none)
        cut[f"h{i}"] = F.when(wanted(r), F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))).otherwise(none)
        if r.group:
            cut[f"g{i}"] = F.when(wanted(r), F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group))).otherwise(none)
    work = barrier(work, **cut).select(
        *own,
        *[
            F.zip_with(f"p{i}", f"h{i}", lambda p, h: F.struct(
                F.length(p).cast("long").alias("gap"), F.length(h).cast("long").alias("hit")
            )).alias(f"z{i}")
            for i in range(len(rules))
        ],
        *[F.transform(f"g{i}" if r.group else f"h{i}", _at_least(r.least)).alias(f"k{i}") for i, r in enumerate(rules)],
    )
    # split leaves one piece more than there are hits: its hit is null
    work = barrier(work, **{f"s{i}": F.slice(f"z{i}", F.lit(1), F.size(f"k{i}")) for i in range(len(rules))})
    work = barrier(work, **{f"b{i}": _running(F.col(f"s{i}")) for i in range(len(rules))})
    spans = []
    for i, r in enumerate(rules):
        flat = F.flatten(F.zip_with(
            F.col(f"b{i}"),
            F.slice(_offsets(F.col(f"b{i}")), F.lit(1), F.size(f"b{i}")),
            lambda b, o: F.transform(b["out"], lambda x: F.struct(
                (x["s"] + o).alias("start"), F.lit(i).alias("rank"), F.lit(r.kind).alias("kind"), (x["e"] + o).alias("end")
            )),
        ))
        marked = F.zip_with(flat, f"k{i}", lambda x, k: F.when(k, x))
        spans.append(F.filter(marked, lambda x: x.isNotNull()))
    return barrier(work, spans=F.array_sort(F.concat(*spans))).select(*own, "spans")


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base kinds, all spans as text."""
    found = find_secrets(docs.select("doc_id", "text"))
    names = [r.kind for r in BASE_RULES]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["rank"] < len(BASE_RULES))
    return found.select(
        F.col("in0").alias("doc_id"),
        *[count(k) for k in names],
        F.sha2(digest(base), 256).alias("base_sha256"),
        digest(F.col("spans")).alias("spans"),
    )


def _without_spans(found: DataFrame, text: Column, mark: str) -> DataFrame:
    """Add ``clean``: the text with its spans replaced.  Spans are taken in blocks, each with the
    part of the text that it covers, so no span walks through the whole text."""
    spans = F.col("spans")
    work = barrier(found, blocks=F.when(F.size(spans) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / BLOCK).cast("int")),
        lambda b: F.slice(spans, b * BLOCK + 1, F.lit(BLOCK)),
    )))
    # where each block's part begins: the furthest end so far
    work = barrier(work, begins=F.aggregate(
        "blocks", F.array(F.lit(0).cast("long")),
        lambda a, b: F.concat(a, F.array(F.greatest(F.element_at(a, -1), F.array_max(F.transform(b, lambda x: x["end"]))))),
    ))
    first, beyond = lambda i: F.get("begins", i), lambda i: F.get("begins", i + 1)
    work = barrier(work, parts=F.transform("blocks", lambda b, i: F.struct(
        b.alias("spans"), first(i).alias("at"),
        text.substr((first(i) + 1).cast("int"), (beyond(i) - first(i)).cast("int")).alias("part"),
    )))

    def cut(p: Column) -> Column:
        start = F.struct(p["at"].alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
        return F.aggregate(
            p["spans"],
            start,
            lambda a, x: F.when(
                x["start"] >= a["at"],
                F.struct(x["end"].alias("at"), F.concat(a["out"], F.array(
                    p["part"].substr((a["at"] - p["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int")), F.lit(mark)
                )).alias("out")),
            ).otherwise(F.struct(F.greatest(a["at"], x["end"]).alias("at"), a["out"].alias("out"))),
            lambda a: F.array_join(a["out"], ""),
        )

    rest = text.substr((F.element_at("begins", -1) + 1).cast("int"), F.length(text))
    clean = F.concat(F.array_join(F.transform("parts", cut), ""), rest)
    return barrier(work, clean=F.when(F.size("spans") > 0, clean).otherwise(text))


def redact_secrets(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The documents with every span (overlaps united) replaced by ``mark``;
    ``n_chars``, where present as a number, follows the new text.  Texts without a span stay as they
    are, nulls included."""
    names = docs.columns
    text = F.col(f"in{names.index('text')}")
    done = _without_spans(find_secrets(docs), text, mark)
    kinds = dict(docs.dtypes)

    def column(i: int, name: str) -> Column:
        own = F.col(f"in{i}")
        if name == "text":
            return F.col("clean").alias(name)
        if name == "n_chars" and kinds[name] in ("bigint", "int"):
            return F.when(F.size("spans") > 0, F.length("clean").cast(kinds[name])).otherwise(own).alias(name)
        return own.alias(name)

    return done.select(*[column(i, n) for i, n in enumerate(names)])
