"""Sums, ranges and narrow windows of the gated model, and words outside its table."""

import numpy as np

from walletflow.llm import gated_model, language_score


def test_sums_by_number_add_every_row():
    rng = np.random.default_rng(7)
    numbers = np.concatenate([np.repeat(65_535, 30), np.zeros(9, int), np.repeat(4, 8), rng.integers(0, 60, 400), [9999]])
    rng.shuffle(numbers)
    values = rng.standard_normal((len(numbers), 5))
    which, sums = gated_model._sums_by_number(numbers, values)
    assert which.tolist() == sorted(set(numbers.tolist()))
    assert np.allclose(sums, [values[numbers == n].sum(axis=0) for n in which])


def test_narrow_windows_share_their_outputs(monkeypatch):
    """One long text among short ones: its windows had a pass over all classes each."""
    passes = []
    real = gated_model.Model._logp
    monkeypatch.setattr(gated_model.Model, "_logp", lambda self, h, target: passes.append(len(h)) or real(self, h, target))
    rng = np.random.default_rng(8)
    texts = [np.append(rng.integers(1, 50, n), 0) for n in (3000, 4, 0, 40)]
    model = gated_model.Model(gated_model.initial(np.ones(50)))
    together = model.score(texts)
    assert len(passes) == 1 and sum(passes) == sum(len(t) for t in texts)
    assert np.allclose(together, model.score(texts, rows=64), rtol=1e-5)


def test_words_outside_the_table_leave_once_a_text(spark):
    table = spark.sparkContext.broadcast(({b"a": 2}, np.zeros(3), np.zeros(3)))
    docs = spark.createDataFrame([(1, "a zig zig A zag zig"), (2, ""), (3, "zag")], "doc_id long, text string")
    rows = language_score._scored(docs, table, 3, gated_model.initial(np.ones(3))).select("doc_id", "rare").collect()
    assert {r.doc_id: r.rare for r in rows} == {1: {"zig": 3, "zag": 1}, 2: {}, 3: {"zag": 1}}
