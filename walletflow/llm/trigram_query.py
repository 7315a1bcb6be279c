"""Boolean trigram queries from regular expressions.

``trigram_query(pattern)`` returns a disjunction of trigram sets over the
lower-cased text: every text that the pattern matches holds all trigrams of
at least one set.  ``None`` means the pattern has no mandatory trigram and a
text cannot be excluded without running it.
"""

from __future__ import annotations

import re._constants as kind
import re._parser as parser

MAX_STRINGS = 64  # literal alternatives kept while literals are joined
MAX_CLASS = 8  # larger character classes end a literal


class _Needs:
    """What a part of the pattern needs: ``exact`` lists all texts it can match
    (None: unknown); ``sets`` is the disjunction of trigrams inside it."""

    def __init__(self, exact=None, sets=frozenset({frozenset()})):
        self.exact, self.sets = exact, sets


def _trigrams(text: str) -> frozenset:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _conjunction(left: frozenset, right: frozenset) -> frozenset:
    both = {a | b for a in left for b in right}
    return _minimal(both) if len(both) <= 256 else min(left, right, key=len)


def _minimal(sets) -> frozenset:
    return frozenset(s for s in sets if not any(o < s for o in sets))


def _closed(part: _Needs) -> frozenset:
    if part.exact is None:
        return part.sets
    return _conjunction(part.sets, _minimal({_trigrams(x) for x in part.exact}))


def _sequence(items) -> _Needs:
    """Adjacent literals are multiplied out; anything unknown closes the run."""
    sets, run, whole = frozenset({frozenset()}), {""}, True
    for item in items:
        part = _node(item)
        sets = _conjunction(sets, part.sets)
        if part.exact is not None and len(run) * len(part.exact) <= MAX_STRINGS:
            run = {a + b for a in run for b in part.exact}
            continue
        sets = _conjunction(sets, _closed(_Needs(run)))
        run, whole = part.exact if part.exact is not None else {""}, False
    return _Needs(run, sets) if whole else _Needs(None, _conjunction(sets, _closed(_Needs(run))))


def _node(item) -> _Needs:
    op, arg = item
    if op is kind.LITERAL:
        return _Needs({chr(arg).lower()})
    if op is kind.IN:
        chars = set()
        for sub, value in arg:
            if sub is kind.LITERAL:
                chars.add(chr(value).lower())
            elif sub is kind.RANGE and value[1] - value[0] < MAX_CLASS:
                chars.update(chr(c).lower() for c in range(value[0], value[1] + 1))
            else:
                return _Needs()
        return _Needs(chars) if len(chars) <= MAX_CLASS else _Needs()
    if op is kind.SUBPATTERN:
        return _sequence(arg[-1])
    if op is kind.BRANCH:
        parts = [_sequence(x) for x in arg[1]]
        if all(p.exact is not None for p in parts):
            return _Needs(set().union(*(p.exact for p in parts)), _minimal(set().union(*(p.sets for p in parts))))
        return _Needs(None, _minimal(set().union(*(_closed(p) for p in parts))))
    if op in (kind.MAX_REPEAT, kind.MIN_REPEAT):
        low, high, body = arg
        part = _sequence(body)
        if (low, high) == (0, 1) and part.exact is not None:
            return _Needs(part.exact | {""})
        if low == 0:
            return _Needs()
        if low == high and part.exact is not None and len(part.exact) ** low <= MAX_STRINGS:
            return _sequence(list(body) * low)
        return _Needs(None, _closed(part))
    if op in (kind.AT, kind.ASSERT, kind.ASSERT_NOT):  # no width
        return _Needs({""})
    return _Needs()


def trigram_query(pattern: str) -> frozenset | None:
    sets = _closed(_sequence(parser.parse(pattern)))
    return None if frozenset() in sets else sets
