"""BPE encoding and decoding by batched merge rounds.

The distinct words of a batch lie behind each other in one flat array of
symbols.  A round looks all neighbouring pairs up by binary search over the
sorted pair keys, takes each word's lowest-rank pair, and merges all its
occurrences in that word (left to right where they overlap).  Words without a
known pair leave the array, so later rounds only touch what still merges.
A word over ``LONG`` bytes may need a round per merge of the table, so its rounds
look only at blocks of symbols: each block keeps its lowest rank, and a round
touches the blocks that hold the lowest of all.
A document's ids are runs of the distinct words' ids.

Normalising and splitting follow the vocabulary file: NFC, lower case (code
point by code point), then the pieces of its pattern; special tokens are cut
out of the raw text first.  Decoding joins the tokens' strings with spaces, as
the library does for a file without a decoder.

Each document is encoded on its own in Arrow batches cut to a few MB: no
shuffle, no state between batches.

Defined results: a null text is empty: no ids, empty decoded text; a null
``doc_id`` is kept; repeated rows are encoded each; extra columns are ignored;
an empty table gives an empty table; null ids decode to the empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletflow.llm.common import ship, slices

ship(__name__)
ship("walletflow.llm.common")

TEXT_BYTES = 8 << 20
LONG = 1024  # bytes from which a word's rounds go by blocks
BLOCK = 256  # symbols of a block
NEVER = 1 << 40  # rank of a pair that does not merge


def byte_letters() -> list[str]:
    """The printable letter of every byte in byte-level vocabularies: printable Latin-1 stands
    for itself, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = {b: chr(0x100 + n) for n, b in enumerate(b for b in range(256) if b not in own)}
    return [other.get(b, chr(b)) for b in range(256)]


def _every_other(hit, following):
    """Occurrences that overlap follow each other: the first, third, ... of such a run."""
    import numpy as np

    fresh = np.r_[True, following(hit[:-1]) != hit[1:]]
    place = np.arange(len(hit))
    return hit[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]


class MergeTable:
    """Vocabulary and sorted merges of a BPE file."""

    def __init__(self, path: str):
        import json

        import numpy as np
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], dtype=np.int64)
        self.last = np.array([vocab[x + end] for x in letters], dtype=np.int64)
        pairs = np.array([(vocab[a] << 32) | vocab[b] for a, b in model["merges"]], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in model["merges"]], dtype=np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.rank, self.made, self.made_by_rank = pairs[order], order.astype(np.int64), made[order], made
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.names = [""] * (max(*vocab.values(), *special.values()) + 1)
        for name, i in (vocab | special).items():
            self.names[i] = name
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(split["pattern"]["Regex"]).findall
        self.library = Tokenizer.from_file(path)  # for its normaliser and splitter only
        self.byte_of = {x: b for b, x in enumerate(letters)}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, special)) + ")").split if special else None

    def _pieces(self, text: str) -> list[str]:
        """The words of a text, normalised.  Letters that the standard library does not know yet
        are classed and lower-cased by the vocabulary's own tables."""
        import unicodedata

        if text.isascii():
            return self.split(text.lower())
        if any(c > "\u02ff" and unicodedata.category(c) == "Cn" for c in set(text)):
            words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes(map(self.byte_of.__getitem__, w)).decode("utf-8") for w, _ in words]
        # one code point at a time: no special form of sigma at the end of a word
        return self.split(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def words(self, text: str) -> list:
        """Pieces in order: a word, or the id of a special token."""
        if self.special_split and "<|" in text:
            parts = self.special_split(text)
        else:
            parts = [text]
        out: list = []
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self._pieces(part)
        return out

    def merge(self, words: list[bytes]):
        """(ids, counts): the words' ids behind each other."""
        import numpy as np

        out = [self._merge_long(w) if len(w) > LONG else None for w in words]
        if all(x is None for x in out):
            return self._merge_short(words)
        short = [w for w, x in zip(words, out) if x is None]
        if short:
            ids, counts = self._merge_short(short)
            parts = iter(np.split(ids, np.cumsum(counts)[:-1]))
            out = [next(parts) if x is None else x for x in out]
        return np.concatenate(out), np.array([len(x) for x in out], dtype=np.int64)

    def _ranks(self, left, right):
        import numpy as np

        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.rank[at], NEVER)

    def _merge_long(self, word: bytes):
        """Ids of one long word; merged symbols stay where they are, linked to their neighbours."""
        import numpy as np

        raw = np.frombuffer(word, dtype=np.uint8)
        n = len(raw)
        symbol = self.inner[raw]
        symbol[-1] = self.last[raw[-1]]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        alive = np.ones(n, dtype=bool)
        rank = np.full(-(-n // BLOCK) * BLOCK, NEVER, dtype=np.int64)
        rank[: n - 1] = self._ranks(symbol[:-1], symbol[1:])
        blocks = rank.reshape(-1, BLOCK)
        lowest = blocks.min(axis=1)
        while True:
            r = lowest.min()
            if r >= NEVER:
                return symbol[alive]
            some = np.flatnonzero(lowest == r)
            row, column = np.nonzero(blocks[some] == r)
            hit = _every_other(some[row] * BLOCK + column, lambda h: after[h])
            right = after[hit]
            beyond = after[right]
            symbol[hit] = self.made_by_rank[r]
            alive[right], rank[right], after[hit] = False, NEVER, beyond
            inside = beyond < n
            before[beyond[inside]] = hit[inside]
            left = before[hit]
            touched = np.concatenate([hit, left[left >= 0]])
            rank[touched] = NEVER
            touched = touched[after[touched] < n]
            rank[touched] = self._ranks(symbol[touched], symbol[after[touched]])
            changed = np.unique(np.concatenate([hit, right, left[left >= 0]]) // BLOCK)
            lowest[changed] = blocks[changed].min(axis=1)

    def _merge_short(self, words: list[bytes]):
        import numpy as np

        size = np.array([len(w) for w in words], dtype=np.int64)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum(size) - 1
        symbol = self.inner[raw]
        symbol[ends] = self.last[raw[ends]]
        word = np.repeat(np.arange(len(words)), size)
        done_symbol, done_word = [], []
        while len(symbol):
            key = (symbol[:-1] << 32) | symbol[1:]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            known = (self.pairs[at] == key) & (word[1:] == word[:-1])
            rank = np.append(np.where(known, self.rank[at], NEVER), NEVER)
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, start)
            count = np.diff(np.r_[start, len(word)])
            alive = np.repeat(lowest < NEVER, count)
            hit = np.flatnonzero((rank == np.repeat(lowest, count)) & alive)
            hit = _every_other(hit, lambda h: h + 1)
            if not alive.all():
                done_symbol.append(symbol[~alive])
                done_word.append(word[~alive])
            symbol[hit] = self.made[at[hit]]
            keep = alive
            keep[hit + 1] = False
            symbol, word = symbol[keep], word[keep]
        if not done_symbol:
            return raw.astype(np.int64), size
        symbol, word = np.concatenate(done_symbol), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return symbol[order], np.bincount(word, minlength=len(words))

    def encode(self, texts: list):
        """(ids, offsets) of the texts, flat."""
        import numpy as np
        import pandas as pd

        pieces = [self.words(t or "") for t in texts]
        n = np.array([len(p) for p in pieces], dtype=np.int64)
        number, distinct = pd.factorize(np.array([w for p in pieces for w in p], dtype=object))
        if not len(distinct):
            return np.zeros(0, dtype=np.int64), np.zeros(len(texts) + 1, dtype=np.int64)
        plain = [i for i, w in enumerate(distinct) if isinstance(w, str)]
        ids, counts = self.merge([distinct[i].encode("utf-8", "surrogatepass") for i in plain]) if plain else (np.zeros(0, dtype=np.int64), [])
        per = np.ones(len(distinct), dtype=np.int64)  # a special token is one id
        per[plain] = counts
        flat = np.empty(int(per.sum()), dtype=np.int64)
        first = np.cumsum(per) - per
        is_plain = np.zeros(len(distinct), dtype=bool)
        is_plain[plain] = True
        flat[np.repeat(is_plain, per)] = ids
        for i in np.flatnonzero(~is_plain):
            flat[first[i]] = distinct[i]
        length = per[number]
        run = np.repeat(first[number] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        total = np.r_[0, np.cumsum(length)]
        return flat[run], total[np.r_[0, np.cumsum(n)]]


def encoded(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """(doc_id, ids): the whole text's ids."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        table = MergeTable(vocabulary)
        for piece in slices(batches, TEXT_BYTES, "text"):
            ids, offsets = table.encode(piece.column("text").to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), lists], names=["doc_id", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decoded(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, decoded)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        names = np.array(MergeTable(vocabulary).names, dtype=object)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                texts = [
                    " ".join(names[x.values.to_numpy()].tolist()) if x.is_valid else "" for x in piece.column("ids")
                ]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("ids"), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    kind = dict(tokens.dtypes)["doc_id"]
    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def encoding_report(docs: DataFrame, vocabulary: str) -> DataFrame:
    both = decoded(encoded(docs, vocabulary), vocabulary)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
