"""Plain restatements of what the queries return."""

import collections
import hashlib
import math
import re
import zlib

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def secrets(text):
    text = text or ""
    assign = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    out = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m.group(1)) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return [n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed]


def fingerprint(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fingerprints, bits=3):
    """Component number per fingerprint."""
    part = list(range(len(fingerprints)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for i, a in enumerate(fingerprints):
        for j in range(i):
            if (a ^ fingerprints[j]).bit_count() <= bits:
                x, y = root(i), root(j)
                part[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(fingerprints))]


def held_out(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 10 == 0


def base_scores(rows):
    """doc rows (doc_id, text) -> [(n_tokens, n_known, N, base)]."""
    tokens = [WORD.findall(lower(t)) + [""] for _, t in rows]
    counts = collections.Counter()
    for (doc_id, _), words in zip(rows, tokens):
        if not held_out(doc_id):
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    return [
        (len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
        for w in tokens
    ]
