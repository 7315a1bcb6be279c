"""Source divergence, piece encoding with spans, prefix trie."""

import collections
import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from tests.llm.brute import lower
from tests.llm.conftest import edge_texts, prose
from walletflow.llm import piece_spans, prefix_trie, source_divergence
from walletflow.llm.piece_spans import PieceModel

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# ---- SentencePiece -------------------------------------------------------------------------

def odd_texts():
    rnd = random.Random(5)
    letters = "ab  \n\t▁éßÄ日本語テスト한국어ﬁＡ①½…　 😀́the0123.,xx<s>"
    made = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(400)]
    return made + ["", " ", "  a  b ", "<s>x</s><unk><0x0A>", "x" * 20_000, " " * 5000, "▁" * 37, "a" + " " * 33 + "b", "日本" * 3000, "a▁", "▁"]


def agrees(model, library, text):
    ids, begins, ends = model.encode(text)
    assert ids.tolist() == library.encode(text), text[:60]
    assert list(zip(begins.tolist(), ends.tolist())) == [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces], text[:60]
    assert model.decode(ids.tolist()) == library.decode(ids.tolist())


def test_pieces_and_spans_as_the_library():
    model, library = PieceModel(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in odd_texts() + [t for _, t in edge_texts() if t]:
        agrees(model, library, text)


@pytest.mark.parametrize("rules, fold, prefix", [("nmt_nfkc", True, True), ("nfkc_cf", True, False), ("nmt_nfkc_cf", False, True)])
def test_compiled_character_maps(rules, fold, prefix):
    """The 32k vocabulary under the character maps that the library ships."""
    proto, other = sentencepiece_model_pb2.ModelProto(), sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    other.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rules).serialized_model_proto())
    proto.normalizer_spec.precompiled_charsmap = other.normalizer_spec.precompiled_charsmap
    proto.normalizer_spec.remove_extra_whitespaces, proto.normalizer_spec.add_dummy_prefix = fold, prefix
    model = PieceModel(proto=proto.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    for text in odd_texts():
        agrees(model, library, text)


def test_spans_cover_the_text():
    model = PieceModel(MODEL)
    text = "Ünï  日本 \n😀 x"
    ids, begins, ends = model.encode(text)
    raw, at = text.encode(), 0
    for b, e in zip(begins.tolist(), ends.tolist()):
        assert b == at and raw[b:e].decode()  # also for the bytes of one character: all but the last are empty
        at = e if e > b else at
    assert at == len(raw)


def test_decoding_of_broken_ids():
    model, library = PieceModel(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rnd = random.Random(3)
    for _ in range(300):
        ids = [rnd.choice([0, 1, 2, 3, 13, 100, 230, 231, 242, 259, 264, 28705, 300, 700]) for _ in range(rnd.randint(0, 8))]
        assert model.decode(ids) == library.decode(ids), ids


def test_refused_vocabularies():
    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.pieces.add(piece="own", score=0.0, type=4)
    with pytest.raises(ValueError):
        PieceModel(proto=proto.SerializeToString())


def test_piece_report(edge_docs, no_docs, spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)

    def row(doc_id, text):
        ids = library.encode(text or "")
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        return doc_id, len(ids), sha, hashlib.sha256(library.decode(ids).encode()).hexdigest(), len((text or "").encode())

    got = collections.Counter(tuple(r) for r in piece_spans.piece_report(edge_docs, MODEL).collect())
    assert got == collections.Counter(row(*r) for r in edge_texts())
    assert piece_spans.piece_report(no_docs, MODEL).count() == 0
    broken = spark.sql("select 1L as doc_id, cast(x'61ff62e28261' as string) as text")
    tokens = piece_spans.encoded(broken, MODEL).collect()[0]
    assert tokens.ids == library.encode(b"a\xffb\xe2\x82a")


def test_null_ids_decode_to_nothing(spark):
    tokens = spark.createDataFrame([(1, None, None, None)], "doc_id long, ids array<int>, begins array<int>, ends array<int>")
    assert piece_spans.decoded(tokens, MODEL).collect()[0].decoded == ""


# ---- source divergence ---------------------------------------------------------------------

def plain_divergence(rows, least):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs, counts, groups = collections.Counter(), collections.Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = term.findall(lower(text))
        counts.update((lang, source, w) for w in words)
        docs.update({(lang, w) for w in words})
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(w for (x, w), n in docs.items() if x == lang and n >= least)
        sources = sorted(s for x, s in groups if x == lang)
        of = {s: {w: counts[lang, s, w] for w in kept} for s in sources}
        whole = {w: sum(of[s][w] for s in sources) for w in kept}

        def p(c):
            n = sum(c.values())
            return {w: 1 + 10**9 * (c[w] + 2) // (n + 2 * len(kept)) for w in kept}

        def cost(x, y):
            return (x - y) ** 2 // (x + y)

        q = p(whole)
        for s in sources:
            own = p(of[s])
            pairs = [(sum(cost(own[w], o) for w, o in p(of[t]).items()), t) for t in sources if t != s]
            terms = [(cost(own[w], q[w]), w) for w in kept if of[s][w] and own[w] > q[w]]
            for part, items, top in (("pair", pairs, None), ("term", terms, 10)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, t, v, k) for k, (v, t) in enumerate(items[:top], 1)]
    return sorted(out)


def divergence_rows():
    rnd = random.Random(8)
    rows = [(rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "é", None]), prose(rnd.random(), rnd.randint(0, 60))) for _ in range(150)]
    rows += [("en", "hot", "The THE the zebra Ünder x1y " * 30)] * 40
    rows += [("xx", "only", "one two"), ("en", "silent", None), ("en", "digits", "123 456"), ("fr", "p", ""), ("fr", "q", "seldom")]
    return rows


@pytest.mark.parametrize("least, block", [(10, 1 << 11), (3, 4)])
def test_divergence_against_plain_loop(spark, monkeypatch, least, block):
    monkeypatch.setattr(source_divergence, "LEAST", least)
    monkeypatch.setattr(source_divergence, "BLOCK", block)
    rows = divergence_rows()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, term int, block string").repartition(3)
    got = sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in source_divergence.divergence_report(docs).collect())
    assert got == plain_divergence(rows, least)


def test_divergence_of_nothing(spark):
    docs = spark.createDataFrame([], "lang string, source string, text string")
    assert source_divergence.divergence_report(docs).count() == 0


def test_share_in_two_steps(spark):
    """The long division holds where 10^9 * count would leave 64 bits."""
    n, total, kept = 40_000_000_000_000, 80_000_000_000_001, 12_345
    got = spark.range(1).selectExpr(f"{source_divergence.share(f'{n}L', f'{total}L', f'{kept}L')} as p").collect()[0].p
    assert got == 1 + 10**9 * (n + 2) // (total + 2 * kept)


# ---- prefix trie ---------------------------------------------------------------------------

def plain_trie(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        made[c] = tuple(own.get(base, [])[:h]) + tuple(turns[h:])
    members = collections.defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for path, inside in members.items():
        children = [p for p in members if len(p) == len(path) + 1 and p[: len(path)] == path]
        below = [p for p in members if p[: len(path)] == path]
        leaves = sum(all(q[:-1] != p for q in members if q) for p in below)
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(inside) if made[c] == path)
        out.append((
            min(inside), len(path), min(members[path[:-1]]) if path else None, len(inside), len(children), leaves, saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def trie_rows():
    rnd = random.Random(4)
    talks = [[(rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", "é", "", None, "long " * 20])) for _ in range(rnd.randint(1, 12))] for _ in range(6)]
    rows = []
    for c in [*range(-12, 40), 1000, 10_003, 123_456_789_012]:
        talk = talks[rnd.randrange(6)][: rnd.randint(1, 12)] + [("user", str(rnd.randrange(3)))] * rnd.randrange(3)
        rows += [(c, None if i == 0 else i * 2, *t) for i, t in enumerate(talk)]
    rows += [(50, 3, "user", "same")] * 9 + [(None, 1, "user", "of nobody")] + [(7001, i, "user", f"{i}") for i in range(30)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def trie(df, **options):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[n] for n in names) for r in prefix_trie.prefix_trie(df, **options).collect()), key=str)


@pytest.mark.parametrize("piece, everything", [(4096, False), (4, False), (4096, True)])
def test_trie_against_plain_loop(spark, monkeypatch, piece, everything):
    """Also with conversations longer than a piece, and with a sketch that proves nothing."""
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    if everything:
        import numpy as np

        monkeypatch.setattr(prefix_trie, "sketch", lambda prefixes, cells: np.full(prefix_trie.ROWS * cells // 8, 255, dtype=np.uint8))
    rows = trie_rows()
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA + ", depth string, i int").repartition(3)
    assert trie(df) == plain_trie(rows)


def test_screen_proves_most_tails(spark):
    rows = [(c, i, "user", f"{c} {i}") for c in range(200) for i in range(12)]
    turns = prefix_trie.ordered_turns(spark.createDataFrame(rows, SCHEMA))
    flags = prefix_trie.screened(prefix_trie.rebuilt(turns).where("depth > 0"))
    assert flags.where("depth > 8 and maybe").count() < 20


def test_trie_of_little(spark):
    assert trie(spark.createDataFrame([], SCHEMA)) == []
    one = [(3, 1, None, None)]
    assert trie(spark.createDataFrame(one, SCHEMA)) == plain_trie(one)
    same = [(c, 1, "user", "x") for c in range(9000, 9100)]
    assert trie(spark.createDataFrame(same, SCHEMA)) == plain_trie(same)
