"""The language model's scores on whole runs."""

import math
from collections import Counter

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.conftest import edge_texts
from walletflow.llm import gated_model, language_score
from walletflow.llm.common import read_table

SMALL = "/root/testdata/sf0.001"


def plain_score(params, numbers):
    """Natural log probability of a text by scalar loops over the model's definition."""
    H, bounds = gated_model.HIDDEN, [int(b) for b in params.bounds]
    p = {k: np.asarray(v, dtype=np.float64) for k, v in params.items()}
    h, last, out = [0.0] * H, 0, 0.0
    sig = lambda x: 1 / (1 + math.exp(-x))

    def log_softmax(logits, at):
        top = max(logits)
        return logits[at] - top - math.log(sum(math.exp(x - top) for x in logits))

    for token in numbers:
        x = p["emb"][last] + p["bias"]
        u = [sum(h[i] * p["rec"][i][j] for i in range(H)) for j in range(3 * H)]
        z = [sig(x[j] + u[j]) for j in range(H)]
        r = [sig(x[H + j] + u[H + j]) for j in range(H)]
        n = [math.tanh(x[2 * H + j] + r[j] * u[2 * H + j]) for j in range(H)]
        h = [n[j] + z[j] * (h[j] - n[j]) for j in range(H)]
        c = next(c for c in range(gated_model.CLASSES) if bounds[c] <= token < bounds[c + 1])
        out += log_softmax([sum(h[i] * p["cls"][i][k] for i in range(H)) + p["cls_bias"][k] for k in range(gated_model.CLASSES)], c)
        own = range(bounds[c], bounds[c + 1])
        out += log_softmax([sum(h[i] * p["out"][w][i] for i in range(H)) + p["out_bias"][w] for w in own], token - bounds[c])
        last = token
    return out


@pytest.mark.parametrize("vocabulary", [gated_model.WORDS, 9])
def test_scores_against_plain_loops(spark, monkeypatch, vocabulary):
    """Also with a model that knows few words, so that most are scored as outside ones."""
    held = {}

    def learned(lots, part, params, tasks):
        rng = np.random.default_rng(part)
        for n in gated_model.NAMES:
            params[n] += (0.2 * rng.standard_normal(params[n].shape)).astype(np.float32)
        held["params"] = params
        return params

    monkeypatch.setattr(language_score, "_learn", learned)
    monkeypatch.setattr(language_score, "FREQUENT", vocabulary - 2)
    texts = [(i, t) for i, t in edge_texts() if t is None or len(t) < 600]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    rows = language_score.score_documents(docs).collect()
    tokens = [(i, brute.WORD.findall(brute.lower(t)) + [""]) for i, t in texts]
    counts = Counter(w for i, ws in tokens if not brute.held_out(i) for w in ws)
    ranked = sorted((w for w in counts if w), key=lambda w: (-counts[w], w.encode()))[: language_score.FREQUENT]
    number = {"": 0} | {w: k + 2 for k, w in enumerate(ranked)}
    outside = {w: c for w, c in counts.items() if w not in number}
    total = sum(outside.values()) + 0.1 * (len(outside) + 1)
    want = []
    for i, ws in tokens:
        score = plain_score(held["params"], [number.get(w, 1) for w in ws]) / math.log(10)
        score += sum(math.log10((outside.get(w, 0) + 0.1) / total) for w in ws if w not in number)
        want.append((str(i), round(score, 2)))
    got = sorted((str(r.doc_id), round(r.score, 2)) for r in rows)
    assert len(got) == len(want)
    for (i, a), (j, b) in zip(got, sorted(want)):
        assert i == j and abs(a - b) < 0.02 + 1e-4 * abs(b)


def test_model_beats_the_counts_and_no_session_setting_matters(spark):
    docs = read_table(spark, SMALL, "documents")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    runs = []
    try:
        for n in ("8", "3"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            runs.append({r.doc_id: r for r in language_score.score_documents(docs).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(abs(r.score - runs[1][i].score) < 1e-6 * abs(r.score) for i, r in runs[0].items())
    out = [r for r in runs[0].values() if r.held_out]
    tokens = sum(r.n_tokens for r in out)
    assert sum(r.score for r in out) / tokens > sum(r.base_score for r in out) / tokens
    assert np.mean([r.score / r.n_tokens for r in out]) > np.mean([r.base_score / r.n_tokens for r in out])


def test_classes_by_square_roots():
    counts = 1e6 / np.arange(1, gated_model.WORDS + 1)
    bounds = gated_model.class_bounds(counts)
    size = np.diff(bounds)
    assert bounds[0] == 0 and bounds[-1] == gated_model.WORDS and (size >= 0).all() and size[0] < 10
    expected = np.add.reduceat(counts, bounds[:-2]) @ size[:-1] / counts.sum()
    assert expected < 200  # equal classes: 410
    few = gated_model.initial(np.ones(20))
    assert np.isclose(np.exp(few["cls_bias"]).sum(), 1, atol=1e-5) and np.diff(few.bounds).sum() == gated_model.WORDS


def test_words_by_bytes():
    text = "A\x0bb\x0c\x1cC d\u0085 É \x1f\r\nß"
    assert [w.decode() for w in language_score.words_of(text)] == brute.WORD.findall(brute.lower(text))
