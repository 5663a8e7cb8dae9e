"""Boolean trigram queries of regular expressions, and postings of a block of texts.

A query is ``True`` (no trigram is mandatory), a trigram, or ``("and" | "or", [queries])``.  Texts
and patterns are compared in lower case (A-Z), so a query may let through more than the pattern
matches, never less.
"""

from __future__ import annotations

from re import _constants as sre, _parser

import numpy as np
import pyarrow as pa

from tallyhouse.llm.words import byte_pieces

MOST = 64  # strings that a part of a pattern is spelt out to


def _all(kind: str, parts: list):
    if kind == "and":
        parts = [p for p in parts if p is not True]
        if not parts:
            return True
    elif any(p is True for p in parts):
        return True
    return parts[0] if len(parts) == 1 else (kind, parts)


def _spelt(strings: set[str]):
    """Query for one of the strings."""
    return _all("or", [_all("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _characters(items) -> set[str] | None:
    out = set()
    for op, value in items:
        if op is sre.LITERAL:
            out.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < 4:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= 4 else None


def _part(op, value):
    """``(strings, query)``: all strings that the part matches, or None if they are too many."""
    if op is sre.LITERAL:
        return {chr(value).lower()} if value < 128 else None, True
    if op is sre.IN:
        return _characters(value), True
    if op is sre.AT:
        return {""}, True
    if op is sre.SUBPATTERN:
        return _sequence(value[3])
    if op is sre.BRANCH:
        found = [_sequence(x) for x in value[1]]
        if all(s is not None for s, _ in found) and sum(len(s) for s, _ in found) <= MOST:
            return set().union(*(s for s, _ in found)), True
        return None, _all("or", [q if s is None else _spelt(s) for s, q in found])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, inner = value
        strings, query = _sequence(inner)
        if least == 0:
            return ({"", *strings} if most == 1 and strings is not None else None), True
        if least == most == 1:
            return strings, query
        return None, query if strings is None else _spelt(strings)
    return None, True


def _sequence(items):
    whole, run, needed = True, {""}, []
    for op, value in items:
        strings, query = _part(op, value)
        if strings is not None and len(run) * len(strings) <= MOST:
            run = {a + b for a in run for b in strings}
            continue
        whole = False
        needed += [_spelt(run), query if strings is None else _spelt(strings)]
        run = {""}
    return (run, True) if whole else (None, _all("and", [*needed, _spelt(run)]))


def trigram_query(pattern: str):
    strings, query = _sequence(_parser.parse(pattern))
    return query if strings is None else _spelt(strings)


def trigrams_of(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams_of(q) for q in query[1]))


def _code(t: str) -> int:
    a, b, c = t.encode("ascii")
    return a << 16 | b << 8 | c


class Postings:
    """For each wanted trigram the rows of a column that hold it."""

    def __init__(self, wanted: set[str]):
        self.wanted = wanted
        self.known = np.zeros(1 << 24, bool)
        self.known[[_code(t) for t in wanted]] = True
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32
        self.rows: dict[int, np.ndarray] = {}

    def index(self, column: pa.Array) -> Postings:
        codes, rows = [], []
        for row, offsets, data in byte_pieces(column):
            if len(data) < 3:
                continue
            x = self.fold[data].astype(np.uint32)
            code = x[:-2] << 16 | x[1:-1] << 8 | x[2:]
            at = np.flatnonzero(self.known[code])
            doc = np.searchsorted(offsets, at, side="right") - 1
            inside = at + 3 <= offsets[doc + 1]
            both = np.unique(code[at[inside]].astype(np.int64) << 32 | (row + doc[inside]))
            codes.append(both >> 32)
            rows.append(both & 0xFFFFFFFF)
        self.rows = {}
        if codes:
            code, row = np.concatenate(codes), np.concatenate(rows)
        if codes and len(code):
            order = np.lexsort((row, code))
            code, row = code[order], row[order]
            first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) 
            for lo, hi in zip(first, [*first[1:], len(code)], strict=True):
                self.rows[int(code[lo])] = row[lo:hi]
        return self

    def find(self, query) -> np.ndarray | None:
        """Rows that satisfy the query; None means all."""
        if query is True:
            return None
        if isinstance(query, str):
            return self.rows.get(_code(query), np.zeros(0, np.int64))
        found = [self.find(q) for q in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(found))
        out = found[0]
        for f in found[1:]:
            out = np.intersect1d(out, f, assume_unique=True)
        return out
