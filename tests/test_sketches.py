"""Mergeable run statistics."""

import random

from walletflow.operators import stats as S


def test_merged_sketches_are_near_the_exact_figures(spark):
    rnd = random.Random(2)
    rows = [(r, w, f"k{rnd.randrange(20_000)}", rnd.random() < 0.5, int(rnd.expovariate(0.01))) for r in (1, 2) for w in range(5) for _ in range(4000)]
    attempts = spark.createDataFrame(rows, "round int, wave int, address string, ok boolean, elapsed_ms long").repartition(6)
    waves = S.wave_sketches(attempts)
    assert waves.count() == 10
    total = S.sketch_figures(S.merged_sketches(waves)).collect()[0]
    assert (total.attempts, total.succeeded) == (len(rows), sum(r[3] for r in rows))
    exact = len({r[2] for r in rows})
    assert abs(total.distinct_keys - exact) <= 0.03 * exact
    values = sorted(r[4] for r in rows)
    for p, q in ((total.p50, 0.5), (total.p90, 0.9), (total.p99, 0.99)):
        below, upto = sum(v < p for v in values) / len(values), sum(v <= p for v in values) / len(values)
        assert below <= q + 0.02 and upto >= q - 0.02
    # merging in two steps gives the same counts and keys as in one
    twice = S.sketch_figures(S.merged_sketches(S.merged_sketches(waves, ("round",)))).collect()[0]
    assert (twice.attempts, twice.distinct_keys) == (total.attempts, total.distinct_keys)


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([], "round int, wave int, address string, ok boolean, elapsed_ms long")
    assert S.wave_sketches(empty).count() == 0
