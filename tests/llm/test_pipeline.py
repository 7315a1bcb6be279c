"""The pipeline against a brute-force run of its stages."""

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import brute
from walletflow.llm import fertility_rules
from walletflow.llm.binary_packing import binary_pieces
from walletflow.llm.secret_scan import find_secrets


def brute_pipeline(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    good = {i for i, t in rows if not brute.quality(t)[-1]}
    bands = {r.doc_id: r.kept for r in fertility_rules.fertility_report(docs, P.path("piece_bpe_32k.model")).collect()}
    rows = sorted((r for r in rows if r[0] in good and bands[r[0]]), key=lambda r: r[0])
    parts = brute.groups([brute.fingerprint(t) for _, t in rows])
    rows = [r for k, r in enumerate(rows) if parts[k] == k]
    spans = {r.in0: sorted((s.start, s.end) for s in r.spans) for r in find_secrets(docs).collect()}
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    out = []
    for i, text in rows:
        assert {f"{s}:{e}" for s, e in spans[i]} >= {x.split(":", 1)[1] for x in brute.secrets(text)}
        clean, at = "", 0
        for start, end in spans[i]:
            if start >= at:
                clean += text[at:start] + "[secret]"
            at = max(at, end)
        ids = tokenizer.encode(clean + text[at:], add_special_tokens=False).ids + [1]
        first = 0
        for n in binary_pieces(len(ids)):
            out.append((i, first, n, np.array(ids[first:first + n], dtype="<u4").tobytes(), len(ids)))
            first += n
    return out


def test_pipeline(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    want = brute_pipeline(spark, rows)
    assert sorted((r.doc_id, r.start, r.length, bytes(r.ids), r.doc_tokens) for r in got) == sorted(want)
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))


def test_stages_on_awkward_rows(spark, edge_docs):
    docs = edge_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == edge_docs.columns
    kept = {r.doc_id for r in docs.collect()}
    assert {8, 10} <= kept and 9 not in kept and len([1 for r in docs.collect() if r.doc_id in (1, 2, None)]) == 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0
    empty = edge_docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
    assert empty.count() == 0


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(None, "a b c d")] * 3 + [(7, "x y z")] * 2, "doc_id long, text string")
    kept = corpus_pipeline.simhash_dedup(spark, docs, "").collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == [("7", "x y z"), ("None", "a b c d")]
