"""Secret scan with a trigram index.

Each rule's regex is turned into a Boolean query over trigrams that every
match must contain (``trigram_query``); a rule without a mandatory trigram
gets the query ``True`` and scans every text. Texts are indexed in segments
of bounded size, as search engines do: a segment's postings (trigram -> rows)
are built with array operations on its bytes, the queries intersect and unite
postings, and only candidate texts are searched with the regex. Segments are
independent, so nothing is shuffled and no posting list outgrows a segment.
Trigrams are taken over UTF-8 bytes with A-Z folded, and only trigrams that
some rule asks for are kept.

A match must be at least ``min_len`` characters long (its group ``group``);
matches that fail are dropped after leftmost non-overlapping matching. Spans
are code points, end exclusive. A text larger than a segment is a segment of
its own, searched whole.

Results on odd input: null and empty texts have no spans; repeated rows repeat
their result; a null id is carried; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT_BYTES = 8 << 20
#: More alternative strings than this are not expanded.
EXPAND = 64


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    min_len: int = 0
    group: int = 0


#: Base rules, in their listed order. [0-9a-f]{16,} has the same matches as the
#: runs [0-9a-f]+ of at least 16 characters.
BASE_RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
]
#: Further credential formats.
MORE_RULES = [
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("cloud_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("pay_key", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("url_login", r"[a-z]+://[^/\s:@]+:[^/\s:@]+@"),
]


def _all(parts: list):
    parts = [p for p in parts if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _any(parts: list):
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _grams(strings: set[str]):
    """Query that holds wherever one of the strings occurs."""
    raw = sorted({s.encode().lower() for s in strings})
    if any(len(s) < 3 for s in raw):
        return True
    return _any([_all([s[i:i + 3] for i in range(len(s) - 2)]) for s in raw])


def _strings(op: str, arg) -> set[str] | None:
    """All strings a node can match, if they are few."""
    if op == "LITERAL":
        return {chr(arg)}
    if op == "AT":
        return {""}
    if op == "IN":
        out: set[str] = set()
        for kind, v in arg:
            if str(kind) == "LITERAL":
                out.add(chr(v))
            elif str(kind) == "RANGE" and v[1] - v[0] < EXPAND:
                out |= {chr(c) for c in range(v[0], v[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op == "SUBPATTERN":
        return _sequence(arg[3])
    if op == "BRANCH":
        each = [_sequence(s) for s in arg[1]]
        return None if None in each else set().union(*each)
    if op == "MAX_REPEAT" and arg[1] <= 3:
        one = _sequence(arg[2])
        if one is None:
            return None
        out, power = set(), {""}
        for n in range(int(arg[1]) + 1):
            if n >= arg[0]:
                out |= power
            power = {a + b for a in power for b in one}
            if len(power) > EXPAND:
                return None
        return out
    return None


def _sequence(nodes) -> set[str] | None:
    out = {""}
    for op, arg in nodes:
        s = _strings(str(op), arg)
        if s is None or len(out) * len(s) > EXPAND:
            return None
        out = {a + b for a in out for b in s}
    return out


def _query(nodes):
    parts, run = [], {""}
    for op, arg in nodes:
        s = _strings(str(op), arg)
        if s is not None and len(run) * len(s) <= EXPAND:
            run = {a + b for a in run for b in s}
            continue
        parts.append(_grams(run))
        run = {""}
        if s is not None:
            run = s
        elif str(op) == "SUBPATTERN":
            parts.append(_query(arg[3]))
        elif str(op) == "BRANCH":
            parts.append(_any([_query(x) for x in arg[1]]))
        elif str(op) == "MAX_REPEAT" and arg[0] >= 1:
            parts.append(_query(arg[2]))
    return _all([*parts, _grams(run)])


def trigram_query(pattern: str):
    """Boolean query over folded trigrams that any match's text satisfies.

    A trigram (bytes), ("and", ...), ("or", ...), or True when none is mandatory.
    """
    from re import _parser
    return _query(_parser.parse(pattern, re.ASCII))


def query_trigrams(q) -> set[bytes]:
    if q is True:
        return set()
    return {q} if isinstance(q, bytes) else set().union(*map(query_trigrams, q[1:]))


def _code(gram: bytes) -> int:
    return gram[0] << 16 | gram[1] << 8 | gram[2]


def build_postings(texts: list[bytes], wanted: np.ndarray) -> dict[int, np.ndarray]:
    """Trigram code -> sorted row numbers, for folded texts; ``wanted`` marks the codes to keep."""
    gap = b"\xff\xff"  # never in UTF-8: no wanted trigram spans two texts
    buf = np.frombuffer(gap.join(texts) + gap, np.uint8)
    starts = np.cumsum([0] + [len(t) + 2 for t in texts[:-1]])
    codes = buf[:-2].astype(np.uint32) << 16 | buf[1:-1].astype(np.uint32) << 8 | buf[2:]
    at = np.flatnonzero(wanted[codes])
    pair = np.unique(codes[at].astype(np.uint64) << np.uint64(32)
                     | (np.searchsorted(starts, at, "right") - 1).astype(np.uint64))
    keys, rows = pair >> np.uint64(32), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(keys)) + 1
    return {int(k): r for k, r in zip(keys[np.r_[0, cuts]] if len(keys) else [], np.split(rows, cuts), strict=False)}


def candidates(q, postings: dict[int, np.ndarray], n: int) -> np.ndarray:
    """Rows that satisfy a query."""
    if q is True:
        return np.arange(n)
    if isinstance(q, bytes):
        return postings.get(_code(q), np.zeros(0, np.int64))
    out = candidates(q[1], postings, n)
    for x in q[2:]:
        more = candidates(x, postings, n)
        out = np.intersect1d(out, more, assume_unique=True) if q[0] == "and" else np.union1d(out, more)
    return out


def _segments(texts: list[str]) -> Iterator[tuple[int, int]]:
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SEGMENT_BYTES:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def scan_segment(texts: list[str], rules: list[Rule]) -> list[list[tuple[int, int, int]]]:
    """Per text the spans (start, rule number, end), sorted."""
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = np.zeros(1 << 24, bool)
    for q in queries:
        wanted[[_code(g) for g in query_trigrams(q)]] = True
    postings = build_postings([t.encode("utf-8", "replace").lower() for t in texts], wanted)
    spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for number, (rule, q) in enumerate(zip(rules, queries, strict=True)):
        find = re.compile(rule.pattern, re.ASCII).finditer
        for row in candidates(q, postings, len(texts)):
            for m in find(texts[row]):
                if m.end(rule.group) - m.start(rule.group) >= rule.min_len:
                    spans[row].append((m.start(), number, m.end()))
    return [sorted(s) for s in spans]


def _joined(spans, kinds: list[str]) -> str:
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _scanner(rules: list[Rule], n_base: int):
    kinds = [r.kind for r in rules]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in _segments(texts):
                found = scan_segment(texts[a:b], rules)
                base = [[x for x in s if x[1] < n_base] for s in found]
                yield pd.DataFrame({
                    "doc_id": pdf["doc_id"].iloc[a:b].astype("Int64"),
                    **{f"n_{k}": [sum(x[1] == i for x in s) for s in base] for i, k in enumerate(kinds[:n_base])},
                    "base_sha256": [hashlib.sha256(_joined(s, kinds).encode()).hexdigest() for s in base],
                    "spans": [_joined(s, kinds) for s in found]})
    return run


def scan_secrets(docs: DataFrame, more: list[Rule] = MORE_RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, a digest of the base spans, and all spans."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInPandas(_scanner(BASE_RULES + list(more), len(BASE_RULES)), SCHEMA)
