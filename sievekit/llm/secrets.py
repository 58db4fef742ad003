"""Secret scans with multipart credential linking (operator 9).

Base detectors find assignments, access identifiers and hex strings.  Beyond
these, weak candidates (credential parts that mean little alone) are linked:
access identifiers, key-like secrets and endpoints are intervals over scopes of
the text, parts whose scopes overlap are joined in one sweep over the sorted
intervals, and a weak part is reported only when complementary parts co-occur.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import trimmed

#: characters before and after a part that make up its scope
SCOPE = 200

# fixed values: the base patterns, each with its least length
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_MIN, ACCESS_MIN = 12, 18
KINDS = ("assign", "access", "hex")

# weak parts: an identifier beside its name, a mixed-case key-like string, a service address
_WEAK_ID = re.compile(r"""\b(?:client_?id|access_?key_?id|account|user(?:name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{4,})""",
                      re.IGNORECASE | re.ASCII)
_WEAK_KEY = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])"
                       r"[A-Za-z0-9+/_-]{24,}+={0,2}+(?![A-Za-z0-9+/=_-])")
_KEY_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-")
_KEY_RUN = re.compile(r"[A-Za-z0-9+/=_-]*")
_WEAK_END = re.compile(r"\b(?:https?|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?|s3)://[^\s\"'<>]{4,}", re.IGNORECASE)

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each base kind, short ones dropped."""
    out = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return ordered(out)


def ordered(spans: list[Span]) -> list[Span]:
    """By start, then kind in the listed order (linked kinds follow), then end."""
    rank = {k: i for i, k in enumerate(KINDS)}
    return sorted(spans, key=lambda s: (s[0], rank.get(s[2], len(rank)), s[2], s[1]))


def _weak(text: str) -> list[Span]:
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(1), m.end(1), "id") for m in _WEAK_ID.finditer(text)]
    if "://" in text:
        out += [(m.start(), m.end(), "endpoint") for m in _WEAK_END.finditer(text)]
    return out


def linked_spans(text: str, base: list[Span], scope: int = SCOPE) -> list[Span]:
    """Weak parts that have complementary parts in their scope.

    An identifier or an endpoint is reported with a secret (a base span or a
    key-like string) beside it; a key-like string with an access identifier, an
    identifier or an endpoint beside it.  Spans inside base spans add nothing.
    """
    names = _weak(text)
    names += [(s, e, "id") for s, e, k in base if k == "access"]
    if not names:
        return []
    beside_name = _Reach(names)
    keys: list[Span] = []
    # key-like strings are looked for only inside the joined scopes of the other parts, widened
    # to the ends of the runs there, so that none is cut
    done = 0
    for lo, hi in _joined([(max(0, s - scope), min(len(text), e + scope)) for s, e, _ in names]):
        if hi < done:
            continue
        lo = max(lo, done)
        while lo > done and text[lo - 1] in _KEY_CHARS:
            lo -= 1
        done = _KEY_RUN.match(text, hi).end()
        keys += [(m.start(), m.end(), "key") for m in _WEAK_KEY.finditer(text, lo, done)]
    keys = [k for k in dict.fromkeys(keys) if beside_name.end(k[1] + scope) >= k[0] - scope]
    beside_secret = _Reach([s for s in base if s[2] != "access"] + keys)
    found = keys + [n for n in names if beside_secret.end(n[1] + scope) >= n[0] - scope]
    covered = _Reach(base)
    return [f for f in dict.fromkeys(found) if covered.end(f[0]) < f[1]]


class _Reach:
    """For the interval join: the furthest end among the spans that start at or before a place."""

    def __init__(self, spans: list[Span]):
        spans = sorted(spans)
        self.starts = [s for s, _, _ in spans]
        self.ends = list(accumulate((e for _, e, _ in spans), max))

    def end(self, place: int) -> int:
        i = bisect_right(self.starts, place)
        return self.ends[i - 1] if i else -(1 << 60)


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def _text_of(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per row: doc_id, counts of the base kinds, base_sha256, and ``spans`` (all, as kind:start:end).

    Offsets are code points, ends exclusive.  Null texts are empty and have no
    spans; ids may be null or repeat; other columns aren't read; an empty table
    gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], []]
            digest, spans = [], []
            for t in batch.column(1):
                text = t.as_py() or ""
                base = base_spans(text)
                for n, k in zip(counts, KINDS, strict=True):
                    n.append(sum(s[2] == k for s in base))
                digest.append(hashlib.sha256(_text_of(base).encode()).hexdigest())
                spans.append(_text_of(ordered(base + linked_spans(text, base, scope))))
            yield pa.record_batch([batch.column(0), *(pa.array(n, pa.int64()) for n in counts),
                                   pa.array(digest, pa.string()), pa.array(spans, pa.string())],
                                  names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(trimmed(run), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"))
