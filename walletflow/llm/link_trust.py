"""Page verdicts from link-graph propagation over hosts (DataFrame functions only).

Pages give host edges (page host -> linked host, with the number of links).
Trust is a personalised PageRank from hosts with allowed pages along the edges;
distrust is the same walk from hosts with blocked pages along reversed edges, so
a host that links to blocked hosts is distrusted.  Every seed page carries the same
mass, so both scores compare; a host is blocked when its distrust is over ``ratio``
times its trust and reaches ``least`` seed pages.
Rules decide the pages they fit; every other page takes its host's verdict.

Both walks are one table (walk, source, target, weight) and run together:
a step is one join and one partial aggregate, and each step's ranks are written
to the shared folder.  Mass is counted in whole units (10^6 a seed page) and every
share is rounded down, so results do not depend on the order of additions.
Steps go on until the summed change of the mass is at most ``TOLERANCE`` of all
mass: a step shrinks the distance to the fixed point to 85% at most, so the ranks
then lie within 5.7 times that change of it.  Where a change is over 95% of the one
before, only the rounding is left (a unit per edge) and the steps end too.
Edges are counted before they are shuffled; a host with many targets is a
skewed join side, which the adaptive planner splits.

Defined results: a null url, or one without ``://``, has empty host and path and
takes part in no edge; null html has no links; repeated pages each give a row
and count their links again; an empty host is never blocked by the method;
extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from walletflow.llm.common import ascii_lower, stored

# Fixed rules: (rule as host/path, verdict).
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
# A tag is read up to the next < or >, and no repeat gives characters back: linear in the page.
LINK = r"(?i)<a\s[^<>]*?href\s*+=\s*+[\"']?+((?:[a-z][a-z0-9+.-]*+:)?+//[^\"'\s<>]++)"
UNITS = 10**6  # the mass of a seed page
TOLERANCE = 10**-6  # change of a step, as a share of all mass, at which the ranks count as settled


def with_host(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return df.withColumns({
        "host": ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
        "path": F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1),
    })


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for name, outcome in sorted(rules, key=lambda r: len(r[0])):
        host, slash, path = name.partition("/")
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(slash + path))
        rule = F.when(fits, F.lit(name)).otherwise(rule)
        verdict = F.when(fits, F.lit(outcome)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links) between different hosts, from absolute links in the html."""
    links = with_host(pages).where("host <> ''").select(
        F.col("host").alias("src"), F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("link")
    )
    full = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    out = with_host(links.select("src", full.alias("url"))).select("src", F.col("host").alias("dst"))
    return out.where("dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagate(edges: DataFrame, seeds: DataFrame, steps: int | None = None, follow_percent: int = 85,
              tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) in units.  ``seeds``: (walk, host, pages), walk 'trust' or
    'distrust'.  Mass follows edges by their links; the rest, and the mass of hosts without
    edges, restarts at the seeds.  ``steps``: so many instead of until the ranks are settled."""
    both = edges.select(F.lit("trust").alias("walk"), "src", "dst", "links").unionByName(
        edges.select(F.lit("distrust").alias("walk"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    )
    out = both.groupBy("walk", "src").agg(F.sum("links").alias("out"))
    graph = stored(both.join(out, ["walk", "src"]), "host-graph")
    start = stored(seeds.select("walk", "host", (F.col("pages") * UNITS).alias("mass")), "host-seeds")
    total = start.groupBy("walk").agg(F.sum("mass").alias("all"))  # two rows at most
    everything = sum(int(r["all"]) for r in total.collect())
    rank, done, before = start, 0, None
    while done < steps if steps is not None else True:
        sent = rank.withColumnRenamed("host", "src").join(graph, ["walk", "src"]).select(
            "walk", F.col("dst").alias("host"),
            F.expr(f"cast(cast(mass as decimal(19,0)) * ({follow_percent} * links) div (100 * out) as bigint)").alias("mass"),
        )
        moved = sent.groupBy("walk", "host").agg(F.sum("mass").alias("mass"))
        back = moved.groupBy("walk").agg(F.sum("mass").alias("gone"))  # two rows at most
        rest = total.join(back, "walk", "left").select("walk", "all", (F.col("all") - F.coalesce("gone", F.lit(0))).alias("rest"))
        restart = start.join(F.broadcast(rest), "walk").select(
            "walk", "host", F.expr("cast(cast(mass as decimal(19,0)) * rest div all as bigint)").alias("mass")
        )
        zero = F.lit(0).cast("long")
        old = rank.select("walk", "host", zero.alias("mass"), F.col("mass").alias("old"))
        new = moved.unionByName(restart).withColumn("old", zero).unionByName(old).groupBy("walk", "host").agg(
            F.sum("mass").alias("mass"), F.sum("old").alias("old")
        )
        step = Observation("step")
        settled = new.observe(step, F.sum(F.abs(F.col("mass") - F.col("old"))).alias("change")).where("mass > 0").select("walk", "host", "mass")
        rank, done = stored(settled, "host-rank"), done + 1
        change = step.get["change"] or 0
        if steps is None and (change <= tolerance * everything or before is not None and change > 0.95 * before):
            break
        before = change
    return rank.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("walk") == "trust", F.col("mass"))), F.lit(0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("walk") == "distrust", F.col("mass"))), F.lit(0)).alias("distrust"),
    )


def judge_pages(pages: DataFrame, rules=RULES, steps: int | None = None, ratio: int = 2, least: float = 0.1) -> DataFrame:
    """One row per page: host, path, fitting rule and verdict, with its host's scores."""
    rule, outcome = rule_of(rules)
    judged = with_host(pages.select("page_id", "url")).withColumns({"rule": rule, "by_rule": outcome})
    seeds = (
        judged.where("by_rule is not null")
        .select(F.when(F.col("by_rule") == "allow", "trust").otherwise("distrust").alias("walk"), "host")
        .groupBy("walk", "host")
        .agg(F.count("*").alias("pages"))
    )
    scores = propagate(host_edges(pages.select("url", "html")), seeds, steps)
    blocked = (F.col("distrust") >= int(UNITS * least)) & (F.col("distrust") > ratio * F.col("trust"))
    joined = judged.join(scores, "host", "left")
    method = F.when(blocked, "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", method).alias("verdict"),
        F.coalesce("trust", F.lit(0)).alias("trust"),
        F.coalesce("distrust", F.lit(0)).alias("distrust"),
    )
