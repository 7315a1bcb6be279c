"""Quality rules from tokeniser fertility.

Words are encoded with a public vocabulary that falls back to bytes.  A text's
characters per token, share of byte tokens and token entropy must lie in the
band of its script, if it has one (the script with the most letters among fixed ranges).  The
base rules look at word and repetition counts.  A document is kept if it passes
the base rules and the band of its script.

Each Arrow batch is cut to a few MB of text; counting is done on flat arrays of
word and token numbers, and distinct words of a piece are encoded once.  Every
document is judged on its own, so there is no shuffle and no state.

Bands are documented parameters, all measured with the 32k piece vocabulary.  They
reject texts that the vocabulary can only spell out in bytes or single letters and
texts that repeat a handful of tokens.  Entropy is compared with the highest that
the text's length allows, so short texts are not punished.

Latin: documents have 1.76 to 2.40 characters per token (entropy share at most
0.88), made-up English 3.48; random letters 1.55 (capitals 1.35, base64 1.22, random
symbols 1.11; entropy share 0.79 to 0.99, more in longer texts).  Hence 1.6 at least,
and up to 1.75 an entropy share of at most 0.9.  Of 955 files of the Python library 5%
have less than 1.61 (of 1112 C headers 1% less than 1.94): lists of constants, which
these figures do not tell from random capitals and which are rejected.  Long prose
reaches high entropy too, so there is no bound on it further up.
Other, a text less than half of whose characters are letters: tables of numbers
have 0.90 to 0.96 (entropy share 0.48), data files 0.75 to 1.26 (0.38 to 0.59), code
1.1 to 1.6 (0.54 to 0.72); at least 53% of their characters are letters or digits.
Random digits have an entropy share of 0.42 and random signs no letters or digits: at
least 0.45 and 30% are asked, which rejects data files of numbers alone.  Hexadecimal
dumps (1.06, 0.57) lie among the code and are kept.
Scripts without a band are judged by the base rules alone: there is no ordinary text
of theirs at hand to measure, and random letters of scripts that the vocabulary
mostly spells out cannot be told from words by these figures.

Defined results: a null text has no words, fails the base rules and is not
kept; without words the measures are 0; a null ``doc_id`` is kept as it is;
repeated rows give a row each; extra columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walletflow.llm.common import ship, slices

ship(__name__)
ship("walletflow.llm.common")

TEXT_BYTES = 4 << 20
LEAST_WORDS = 50  # fixed base rule
REPEAT_PERCENT = 50  # fixed base rule
SYMBOLS = "#*$%&|<>"  # fixed

# Letters by script: (name, first, last) code points.
SCRIPTS = (
    ("latin", 0x41, 0x24F),
    ("greek", 0x370, 0x3FF),
    ("cyrillic", 0x400, 0x52F),
    ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x77F),
    ("indic", 0x900, 0xDFF),
    ("thai", 0xE00, 0xE7F),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
)


@dataclass(frozen=True)
class Band:
    """Accepted characters per token, byte-token share, and token entropy as a share of
    log2(min(tokens, ``ENTROPY_TOKENS``))."""

    low: float
    high: float
    byte_share: float
    entropy: float
    poor: float = 0.0  # below so many characters per token the entropy share is at most ``poor_entropy``
    poor_entropy: float = 1.0
    alnum: float = 0.0  # letters and ASCII digits, as a share of all characters in words


ENTROPY_TOKENS = 256
BANDS = {
    "latin": Band(1.6, 8.0, 0.15, 0.45, 1.75, 0.9),
    "other": Band(0.7, 8.0, 0.15, 0.45, 1.75, 0.88, 0.3),  # too few letters
}

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, script string, "
    "n_tokens long, chars_per_token double, byte_share double, entropy double, alnum_share double"
)


def make_measure(model_file: str):
    """texts -> list of columns in the order of ``SCHEMA``."""
    import re
    import unicodedata
    from collections import Counter

    import numpy as np
    import pandas as pd
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model_file)
    is_byte = np.array([pieces.is_byte(i) for i in range(pieces.get_piece_size())])
    words_of = re.compile(r"[^\x20\x09-\x0D]+").findall  # fixed
    symbol = re.compile("[" + re.escape(SYMBOLS) + "]")

    def repeated_lines(text: str) -> int:
        lines = [x for x in text.split("\n") if x.strip("\x20\t\x0b\x0c\r")]
        return len(lines) - len(set(lines))

    def repeated_words(word, doc, n_docs):
        """Words covered by windows of three that come twice or more in their text."""
        if len(word) < 3:
            return np.zeros(n_docs, dtype=np.int64)
        inside = np.flatnonzero(doc[2:] == doc[:-2])
        two = pd.factorize(word[inside].astype(np.int64) << 32 | word[inside + 1])[0]
        three = pd.factorize(two.astype(np.int64) << 32 | word[inside + 2])[0]
        _, window, times = np.unique(three.astype(np.int64) << 32 | doc[inside], return_inverse=True, return_counts=True)
        at = inside[times[window] > 1]
        covered = np.zeros(len(word), dtype=bool)
        for k in range(3):
            covered[at + k] = True
        return np.bincount(doc[covered], minlength=n_docs)

    def scripts(texts):
        """(script, share of letters and ASCII digits among the characters in words) per text."""
        out, shares = [], []
        for t in texts:
            code = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            full = np.count_nonzero((code != 0x20) & ((code < 0x09) | (code > 0x0D)))
            digits = np.count_nonzero(code - 0x30 < 10)
            code = code[(code > 0x7F) | ((code | 0x20) - 0x61 < 26)]
            letters = [np.count_nonzero((code >= lo) & (code <= hi)) for _, lo, hi in SCRIPTS]
            if full and 2 * sum(letters) >= full:
                out.append(SCRIPTS[int(np.argmax(letters))][0])
            else:  # letters and vowel signs of any script
                any_letter = sum(n for c, n in Counter(t).items() if unicodedata.category(c)[0] in "LM")
                out.append("unlisted" if full and 2 * any_letter >= full and not t.isascii() else "other")
            shares.append((sum(letters) + digits) / full if full else 0.0)
        return np.array(out, dtype=object), np.array(shares, dtype=np.float64)

    def measure(texts):
        texts = [t or "" for t in texts]
        n = len(texts)
        words = [words_of(t) for t in texts]
        n_words = np.array([len(w) for w in words], dtype=np.int64)
        doc = np.repeat(np.arange(n), n_words)
        word, distinct = pd.factorize(np.array([w for ws in words for w in ws], dtype=object))
        chars = np.array([len(w) for w in distinct], dtype=np.int64)
        word_chars = np.bincount(doc, weights=chars[word] if len(word) else None, minlength=n).astype(np.int64)
        ids = pieces.encode(list(distinct), num_threads=1) if len(distinct) else []
        count = np.array([len(x) for x in ids], dtype=np.int64)
        flat = np.fromiter((i for x in ids for i in x), dtype=np.int64, count=int(count.sum()))
        first = np.cumsum(count) - count
        per = count[word] if len(word) else word.astype(np.int64)
        n_tokens = np.bincount(doc, weights=per, minlength=n).astype(np.int64)
        # every token of every word, in order: a run of consecutive places in ``flat``
        run = np.repeat(first[word] - (np.cumsum(per) - per), per) + np.arange(int(per.sum())) if len(word) else per
        token, owner = flat[run], np.repeat(doc, per)
        n_bytes = np.bincount(owner[is_byte[token]], minlength=n)
        key, times = np.unique(owner * len(is_byte) + token, return_counts=True)
        share = times / np.maximum(n_tokens, 1)[key // len(is_byte)]
        entropy = np.bincount(key // len(is_byte), weights=-share * np.log2(share), minlength=n)
        some = np.maximum(n_tokens, 1)
        script, alnum = scripts(texts)
        return [
            n_words, word_chars,
            np.array([len(symbol.findall(t)) for t in texts], dtype=np.int64),
            np.array([repeated_lines(t) for t in texts], dtype=np.int64),
            repeated_words(word, doc, n), script, n_tokens,
            word_chars / some, n_bytes / some, entropy, alnum,
        ]

    return measure


def measured(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """(row, measures...): every input row as a struct with its measures."""

    def run(batches):
        import pyarrow as pa

        measure = make_measure(model_file)
        for piece in slices(batches, TEXT_BYTES, "text"):
            cols = [pa.array(c) for c in measure(piece.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([piece.column("row"), *cols], names=["row", *[c.split()[0] for c in SCHEMA.split(", ")]])

    rows = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))
    # a schema object: names of the input's columns need not be fit for DDL text
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), *T.StructType.fromDDL(SCHEMA).fields])
    return rows.mapInArrow(run, schema)


def judged(docs: DataFrame, model_file: str, bands=None) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``."""
    bands = BANDS if bands is None else bands
    room = F.log2(F.greatest(F.least("n_tokens", F.lit(ENTROPY_TOKENS)), F.lit(2)).cast("double"))
    fits = F.lit(True)  # scripts without a band
    for script, b in bands.items():
        inside = (
            F.col("chars_per_token").between(b.low, b.high)
            & (F.col("byte_share") <= b.byte_share)
            & (F.col("entropy") >= b.entropy * room)
            & (F.col("alnum_share") >= b.alnum)
            & ((F.col("chars_per_token") >= b.poor) | (F.col("entropy") <= b.poor_entropy * room))
        )
        fits = F.when(F.col("script") == script, inside).otherwise(fits)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return measured(docs, model_file).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fits)


def fertility_report(docs: DataFrame, model_file: str) -> DataFrame:
    return judged(docs.select("doc_id", "text"), model_file).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "script", "chars_per_token", "byte_share", "entropy",
    )


def keep_good(docs: DataFrame, model_file: str) -> DataFrame:
    """The documents that the rules keep, with their columns."""
    return judged(docs, model_file).where("kept").select("row.*")
