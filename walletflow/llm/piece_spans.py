"""SentencePiece encoding with byte spans, and decoding.

Normalising: at every place of a text the longest source string of the
vocabulary's compiled character map is taken and its target written; characters
that no rule starts with stand for themselves; a dummy space is put in front,
spaces are folded and escaped as the file says.  With every normalised byte goes
the byte of the original text that it came from, so a run of normalised bytes
(a piece) is projected back to a span of the original bytes.

Segmenting: a text is cut where no piece of the vocabulary holds the two
neighbouring characters, so no merge can cross a cut.  In each segment the pair
with the best score is merged, leftmost first among equals, until no pair is a
piece; characters that are no piece become byte pieces.  The distinct segments of
up to ``SHORT`` characters of a batch lie in one flat array, and a round merges the
best pair of each; a longer segment keeps its pairs in a heap with linked
neighbours, so a text of one endless segment takes n log n steps.
Ids of segments that come again are kept in a table of about ``KEPT`` entries.

Each document is encoded on its own in Arrow batches cut to a few MB: no
shuffle, no state between tasks.

Defined results: a null text is empty and has no ids; a null ``doc_id`` is kept;
repeated rows are encoded each; extra columns are ignored; an empty table gives
an empty table; null ids decode to the empty text.  Bytes that are no UTF-8 are
read as U+FFFD each.  Vocabularies with user-defined or unused pieces, without
byte fallback, of another kind than BPE, or with spaces at the end of words are
refused with ``ValueError``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletflow.llm.common import ship, slices

ship(__name__)
ship("walletflow.llm.common")

TEXT_BYTES = 2 << 20
SHORT = 48  # characters up to which segments are merged together
KEPT = 120_000  # segments whose ids are kept
SPACE = "▁"  # fixed: the escaped space
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed: kinds of pieces in the file


class CharacterMap:
    """The rules of a compiled character map: a double-array trie over UTF-8 bytes whose
    values point into zero-ended targets."""

    def __init__(self, blob: bytes):
        import re

        self.rules: dict[str, str] = {}
        if blob:
            self._read(blob)
        starts = sorted({source[0] for source in self.rules})
        self.longest: dict[str, int] = {}
        for source in self.rules:
            self.longest[source[0]] = max(self.longest.get(source[0], 0), len(source))
        self.starts = re.compile("[" + "".join(map(re.escape, starts)) + "]") if starts else None

    def _read(self, blob: bytes) -> None:
        """Walk the trie.  A unit holds: bits 0-7 (and 31) the label, bit 8 whether a value hangs
        below, bits 10-30 the offset of the children, times 256 if bit 9 is set; a value is a
        unit with bit 31 set."""
        import struct

        import numpy as np

        size = struct.unpack_from("<I", blob)[0]
        units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).astype(np.int64)
        targets = blob[4 + size :]
        below = np.arange(len(units)) ^ ((units >> 10) << ((units & 0x200) >> 6))
        bases, paths = below[:1], [b""]
        labels = np.arange(1, 256)
        while len(paths):  # one level of the trie at a time, in bounded pieces
            found, longer = [], []
            for first in range(0, len(paths), 4096):
                at = bases[first : first + 4096, None] ^ labels
                inside = at < len(units)
                hit = inside & (units[np.where(inside, at, 0)] & 0x800000FF == labels)
                for row, column in zip(*np.nonzero(hit)):
                    place = at[row, column]
                    source = paths[first + row] + bytes([column + 1])
                    if units[place] & 0x100:
                        start = int(units[below[place]] & 0x7FFFFFFF)
                        self.rules[source.decode("utf-8")] = targets[start : targets.index(b"\0", start)].decode("utf-8")
                    found.append(below[place])
                    longer.append(source)
            bases, paths = np.array(found, dtype=np.int64), longer

    def chunks(self, text: str):
        """(original part, its normal form, whether a rule made it): the text in order; parts
        without a rule are left whole."""
        at = 0
        while self.starts and at < len(text):
            hit = self.starts.search(text, at)
            if not hit:
                break
            i = hit.start()
            for n in range(min(self.longest[text[i]], len(text) - i), 0, -1):
                target = self.rules.get(text[i : i + n])
                if target is not None:
                    if i > at:
                        yield text[at:i], text[at:i], False
                    yield text[i : i + n], target, True
                    at = i + n
                    break
            else:
                yield text[at : i + 1], text[at : i + 1], False
                at = i + 1
        if at < len(text):
            yield text[at:], text[at:], False


def _starts(raw):
    """For every byte of valid UTF-8 the place of its character's first byte."""
    import numpy as np

    return np.maximum.accumulate(np.where((raw & 0xC0) != 0x80, np.arange(len(raw)), 0))


class PieceModel:
    def __init__(self, path: str | None = None, proto: bytes | None = None, decoding: bool = False):
        import re

        import numpy as np
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        if proto is None:
            with open(path, "rb") as f:
                proto = f.read()
        spec.ParseFromString(proto)
        rules, trained = spec.normalizer_spec, spec.trainer_spec
        if trained.model_type != 2 or not trained.byte_fallback or trained.treat_whitespace_as_suffix:
            raise ValueError("only BPE vocabularies with byte fallback and leading spaces")
        pieces = [(p.piece, p.score, p.type) for p in spec.pieces]
        if not {kind for _, _, kind in pieces} <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        self.map = CharacterMap(rules.precompiled_charsmap if not decoding else b"")
        self.prefix, self.fold, self.escape = rules.add_dummy_prefix, rules.remove_extra_whitespaces, rules.escape_whitespaces
        self.space = SPACE if self.escape else " "
        self.id_of = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        # whole numbers in the order of the scores; equal scores share one
        order = {s: i for i, s in enumerate(sorted({s for _, s, kind in pieces if kind == NORMAL}))}
        self.score = {p: order[s] for p, s, kind in pieces if kind == NORMAL}
        self.byte_id = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        # how many normalised bytes a piece covers, and the bytes it stands for
        self.covers = np.array([1 if kind == BYTE else len(p.encode()) for p, _, kind in pieces], dtype=np.int64)
        stands = {CONTROL: lambda p: b"", UNKNOWN: lambda p: trained.unk_surface.encode(), BYTE: lambda p: bytes([int(p[3:5], 16)])}
        self.raw = [stands.get(kind, lambda p: p.replace(SPACE, " ").encode())(p) for p, _, kind in pieces]
        self.leading = {i for p, i in self.id_of.items() if p.startswith(SPACE)}
        if decoding:
            return
        neighbours = sorted({ord(a) << 21 | ord(b) for p in self.id_of for a, b in zip(p, p[1:])})
        self.neighbours = np.array(neighbours or [-1], dtype=np.int64)
        # words: a space belongs to what follows; ASCII characters that stand in no longer piece are alone
        inside = {c for p in self.id_of if len(p) > 1 for c in p}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in inside and chr(c) != self.space)
        s = re.escape(self.space)
        # unless pieces hold a space behind other characters, a cut before spaces is a cut that no merge crosses
        plain = not any(re.search(f"[^{s}]{s}", p) for p in self.id_of)
        self.split = re.compile(f"{s}+[^{s}{alone}]*|[^{s}{alone}]+" + (f"|[{alone}]" if alone else "")).findall if plain else None
        self.kept: dict[str, list[int]] = {}
        self._pair_table()

    def _pair_table(self) -> None:
        """Numbers of the symbols (pieces, and characters that only stand in pieces; 0: any other character)
        and the sorted pairs of symbols that make a piece."""
        import numpy as np

        pieces = list(self.id_of)
        number = {p: i for i, p in enumerate(pieces, 1)}
        for c in sorted({c for p in pieces for c in p}):
            number.setdefault(c, len(number) + 1)
        self.symbol_of = np.zeros(0x110000, dtype=np.int32)
        for symbol, i in number.items():
            if len(symbol) == 1:
                self.symbol_of[ord(symbol)] = i
        self.piece_of = np.full(len(number) + 1, -1, dtype=np.int64)  # ids in the vocabulary; -1: none
        self.piece_of[1 : len(pieces) + 1] = list(self.id_of.values())
        self.letters_of = np.ones(len(number) + 1, dtype=np.int64)
        self.letters_of[1:] = [len(symbol) for symbol in number]
        rows = []
        for piece in pieces:
            made, rank = number[piece], self.score[piece]
            for k in range(1, len(piece)):
                left, right = number.get(piece[:k]), number.get(piece[k:])
                if left and right:
                    rows.append((left << 32 | right, rank, made))
        table = np.array(rows or [(-2, -1, 0)], dtype=np.int64)
        # open addressing: a pair lies at its hash or up to ``probes`` places behind
        self.shift = 64 - int(8 * len(table)).bit_length()
        slots = (1 << (64 - self.shift)) + 64
        self.pairs = np.full(slots, -1, dtype=np.int64)
        where, left, self.probes = np.zeros(len(table), dtype=np.int64), np.arange(len(table)), 0
        at = self._slot(table[:, 0])
        while len(left):
            free = left[self.pairs[at[left]] == -1]
            _, one = np.unique(at[free], return_index=True)
            put = free[one]
            self.pairs[at[put]] = table[put, 0]
            where[put] = at[put]
            left = np.setdiff1d(left, put)
            at[left] += 1
            self.probes += 1
            if self.probes > 60:
                raise ValueError("pairs collide")
        self.pair_rank, self.pair_made = np.full(slots, -1, dtype=np.int32), np.zeros(slots, dtype=np.int32)
        self.pair_rank[where], self.pair_made[where] = table[:, 1], table[:, 2]

    def _slot(self, key):
        import numpy as np

        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def _pair(self, left, right):
        """(rank, made) of pairs of symbols; rank -1 where they make no piece."""
        import numpy as np

        key = left.astype(np.int64) << 32 | right
        at = self._slot(key)
        found = self.pairs[at]
        other = np.flatnonzero((found != key) & (found != -1))
        for _ in range(self.probes - 1):
            if not len(other):
                break
            at[other] += 1
            found = self.pairs[at[other]]
            other = other[(found != key[other]) & (found != -1)]
        hit = self.pairs[at] == key
        return np.where(hit, self.pair_rank[at], np.int32(-1)), self.pair_made[at]

    def normalised(self, text: str):
        """(normal form, align): ``align[i]`` is the original byte of normalised byte i; one more entry
        holds the end."""
        import numpy as np

        if not text:
            return "", np.zeros(1, dtype=np.int64)
        if self.map.rules:
            parts, places, at = [], [], 0
            for own, normal, ruled in self.map.chunks(text):
                size = len(own.encode())
                raw = np.frombuffer(normal.encode(), dtype=np.uint8)
                # a rule's target comes from the rule's first byte, other bytes from their character's
                places.append(np.full(len(raw), at) if ruled else at + _starts(raw))
                parts.append(normal)
                at += size
            flat, align = "".join(parts), np.append(np.concatenate(places), at)
        else:
            raw = np.frombuffer(text.encode(), dtype=np.uint8)
            flat, align = text, np.append(_starts(raw), len(raw))
        if self.fold:
            flat, align = self._folded(flat, align)
            if not flat:
                return "", align[-1:]
        if self.escape:
            raw = np.frombuffer(flat.encode(), dtype=np.uint8)
            align = np.append(np.repeat(align[:-1], np.where(raw == 0x20, 3, 1)), align[-1])
            flat = flat.replace(" ", SPACE)
        if self.prefix:
            align = np.concatenate([np.full(len(self.space.encode()), align[0]), align])
            flat = self.space + flat
        if self.fold:  # escaped spaces at the end, written so in the text or not
            flat = flat.rstrip(self.space)
            align = align[: len(flat.encode()) + 1]
        return flat, align

    @staticmethod
    def _folded(flat: str, align):
        """Without spaces in front and with single spaces elsewhere."""
        import numpy as np

        blank = np.frombuffer(flat.encode(), dtype=np.uint8) == 0x20
        keep = ~(blank & np.r_[True, blank[:-1]])
        raw = np.frombuffer(flat.encode(), dtype=np.uint8)[keep]
        return raw.tobytes().decode(), np.append(align[:-1][keep], align[-1])

    def _cuts(self, segment: str) -> list[str]:
        """Parts between neighbours that no piece holds."""
        import numpy as np

        codes = np.frombuffer(segment.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        key = codes[:-1] << 21 | codes[1:]
        at = np.minimum(np.searchsorted(self.neighbours, key), len(self.neighbours) - 1)
        ends = np.flatnonzero(self.neighbours[at] != key) + 1
        if not len(ends):
            return [segment]
        ends = [0, *ends.tolist(), len(segment)]
        return [segment[a:b] for a, b in zip(ends, ends[1:])]

    def _rounds(self, words: list[str]) -> list[list[int]]:
        """Ids of short segments.  Segments of as many symbols are the rows of one matrix; a round merges
        the best pair of every row, the leftmost among equals, and the rows join those one shorter."""
        import numpy as np

        size = np.array([len(w) for w in words], dtype=np.int32)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        flat, first = self.symbol_of[codes], np.cumsum(size) - size
        ranks, makes = self._pair(flat, np.r_[flat[1:], np.int32(0)])  # those over a segment's end are never read
        out: list[list[int]] = [[]] * len(words)
        carried = None
        for length in range(int(size.max()), 0, -1):
            own = np.flatnonzero(size == length)
            at = first[own][:, None] + np.arange(length, dtype=np.int32)
            parts = own, flat[at], ranks[at[:, :-1]], makes[at[:, :-1]]
            word, symbol, rank, made = (np.concatenate(x) for x in zip(carried, parts)) if carried else parts
            carried = None
            if not len(word):
                continue
            column = rank.argmax(axis=1) if length > 1 else np.zeros(len(word), dtype=np.int64)
            goes_on = rank[np.arange(len(word)), column] >= 0 if length > 1 else np.zeros(len(word), dtype=bool)
            if not goes_on.all():
                ended, symbols = word[~goes_on].tolist(), symbol[~goes_on]
                ids = self.piece_of[symbols]
                for w, got in zip(ended, ids.tolist()):
                    out[w] = got
                for k in np.flatnonzero((ids < 0).any(axis=1)).tolist():  # characters that are no piece
                    places = np.cumsum(self.letters_of[symbols[k]]) - 1
                    letters = words[ended[k]]
                    out[ended[k]] = [j for i, c in zip(ids[k].tolist(), places.tolist()) for j in ([i] if i >= 0 else self._bytes(letters[c]))]
                word, symbol, rank, made, column = (x[goes_on] for x in (word, symbol, rank, made, column))
            if not len(word):
                continue
            n, row = len(word), np.arange(len(word))
            symbol[row, column] = made[row, column]
            stay = np.ones((n, length), dtype=bool)
            stay[row, column + 1] = False
            symbol = symbol[stay].reshape(n, length - 1)
            stay = np.ones((n, length - 1), dtype=bool)
            stay[row, column] = False
            rank, made = rank[stay].reshape(n, length - 2), made[stay].reshape(n, length - 2)
            # the pairs on both sides of what was merged are new
            for side, some in ((-1, column > 0), (0, column < length - 2)):
                r, c = row[some], column[some] + side
                rank[r, c], made[r, c] = self._pair(symbol[r, c], symbol[r, c + 1])
            carried = word, symbol, rank, made
        return out

    def _bytes(self, character: str) -> list[int]:
        return [self.byte_id[b] for b in character.encode()]

    def _long(self, symbols: list[str]) -> list[str]:
        import heapq

        n, score = len(symbols), self.score
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(left: int) -> None:
            right = after[left]
            if right < n:
                both = symbols[left] + symbols[right]
                if both in score:
                    heapq.heappush(heap, (-score[both], left, right, both))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, left, right, both = heapq.heappop(heap)
            if not symbols[left] or after[left] != right or symbols[left] + symbols[right] != both:
                continue  # one of the two has merged since
            symbols[left], symbols[right] = both, ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [s for s in symbols if s]

    def _fill(self, words: set[str]) -> None:
        """Put the ids of these words into the table."""
        if len(self.kept) + len(words) > KEPT:
            self.kept = {}
        short = [w for w in words if w not in self.kept and len(w) <= SHORT]
        if short:
            self.kept.update(zip(short, self._rounds(short)))

    def _long_word(self, word: str) -> list[int]:
        parts = self._cuts(word)
        few = sorted({p for p in parts if len(p) <= SHORT})
        known = dict(zip(few, self._rounds(few))) if few else {}
        out: list[int] = []
        for part in parts:
            if part in known:
                out += known[part]
            else:
                for piece in self._long(list(part)):
                    out += [self.id_of[piece]] if piece in self.id_of else self._bytes(piece)
        return out

    def ids(self, normals: list[str]) -> list[list[int]]:
        """Ids of normal forms."""
        split = [self.split(n) if self.split else [n] for n in normals]
        self._fill({w for words in split for w in words if w})
        kept = self.kept
        out = []
        for words in split:
            ids: list[int] = []
            for word in words:
                if word:
                    got = kept.get(word)
                    ids += self._long_word(word) if got is None else got
            out.append(ids)
        return out

    def encode_all(self, texts: list[str]):
        """(ids, begins, ends) of each text, as arrays; spans are bytes of the original text's UTF-8."""
        import numpy as np

        normals = [self.normalised(t) for t in texts]
        out = []
        for (_, align), ids in zip(normals, self.ids([n for n, _ in normals])):
            ids = np.array(ids, dtype=np.int64)
            upto = np.cumsum(self.covers[ids])
            out.append((ids, align[upto - self.covers[ids]], align[upto]))
        return out

    def encode(self, text: str):
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; a dummy or folded leading space goes."""
        raw = self.raw
        data = b"".join([raw[i] for i in ids])
        if self.prefix or self.fold:
            data = self._without_lead(ids, data)
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return _lenient(data)

    def _without_lead(self, ids, data: bytes) -> bytes:
        """Spaces in front of the first text go: one, or all where spaces are folded."""
        cut = 0
        for i in ids:
            if i in self.leading:
                cut += 1
                if not self.fold or self.raw[i] != b" ":
                    break
            elif self.raw[i]:
                break
        return data[cut:]


def _lenient(data: bytes) -> str:
    """U+FFFD for every byte that is no part of valid UTF-8."""
    import codecs

    codecs.register_error("each-byte", lambda e: ("�", e.start + 1))
    return data.decode("utf-8", "each-byte")


def encoded(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """(doc_id, ids, begins, ends, covered): the whole text's pieces, their original byte spans and
    the sum of these."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        model = PieceModel(vocabulary)
        for piece in slices(batches, TEXT_BYTES, "text"):
            got = model.encode_all([_lenient(t) if t else "" for t in piece.column("text").to_pylist()])
            for at in range(0, len(got), 512):
                some = got[at : at + 512]
                offsets = pa.array(np.r_[0, np.cumsum([len(g[0]) for g in some])].astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(part), pa.int32())) for part in zip(*some)]
                covered = pa.array([int((e - b).sum()) for _, b, e in some], pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column("doc_id").slice(at, 512), *lists, covered], names=["doc_id", "ids", "begins", "ends", "covered"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.col(text).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, begins array<int>, ends array<int>, covered long")


def decoded(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """The rows of ``tokens`` (with a column ``ids``) and the text of their ids."""

    def run(batches):
        import pyarrow as pa

        model = PieceModel(vocabulary, decoding=True)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                texts = [model.decode(x.values.to_numpy().tolist()) if x.is_valid else "" for x in piece.column("ids")]
                columns = [piece.column(i) for i in range(piece.num_columns)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*piece.schema.names, "decoded"])

    kinds = ", ".join(f"`{n}` {k}" for n, k in tokens.dtypes)
    return tokens.mapInArrow(run, f"{kinds}, decoded string")


def piece_report(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per document; ``covered_bytes`` sums the spans and is the text's length in bytes
    unless a rule or the folding of spaces leaves bytes out."""
    both = decoded(encoded(docs, vocabulary).select("doc_id", "ids", "covered"), vocabulary)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("covered").alias("covered_bytes"),
    )
