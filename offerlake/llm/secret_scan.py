"""Secrets: Aho-Corasick keyword prefilter, anchored patterns near hits, checksums.

One pass of an Aho-Corasick automaton over the ASCII-lower-cased text finds every keyword.
Each hit anchors its kind's pattern at that place; nothing else of the text meets a
pattern.  Kind ``hex`` has no keyword: its anchors are the beginnings of runs of at least
32 hex digits, found by one vectorised pass over the bytes.

Kinds: assign, access and hex (the base ones), and two whose tokens embed a checksum,
where a token is reported only if the checksum holds:
  github   gh[pousr]_ + 30 characters of base 62 + CRC-32 of those in base 62 (6 digits)
  card     13 to 19 digits, single spaces or hyphens between, after a word such as "card";
           Luhn checksum
Matches of one kind are leftmost and do not overlap; a match that fails its length or
checksum test is dropped, yet what it covered is not searched again.

Defined results.  A null text counts as empty.  Offsets are code points, end exclusive.
Rows that repeat a doc_id are scanned one by one.  Extra columns are ignored.  Texts of
any length are scanned whole.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlake.llm import words as W
from offerlake.llm.spark import arrow_batches

KINDS = ("assign", "access", "hex", "github", "card")     # the order of equal starts
BASE = KINDS[:3]

# Keywords by kind, and the pattern tried where one begins.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "card": ("card", "visa", "pan"),
}
ANCHORED = {
    "assign": re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "github": re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9_])"),
    "card": re.compile(rb"(?i:card|visa|pan)(?i:(?: ?(?:number|no|nr)\.?)?)[ :#=]{1,4}([0-9](?:[ -]?[0-9]){12,18})(?![0-9])"),
}
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_HEX = np.zeros(256, bool)
_HEX[48:58] = _HEX[97:103] = True


def crc_base62(body: bytes) -> bytes:
    """CRC-32 of a token's body as six base-62 digits."""
    n, out = zlib.crc32(body), b""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = BASE62[digit:digit + 1] + out
    return out


def luhn(digits: bytes) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d -= 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _holds(kind: str, m: re.Match) -> tuple[int, int] | None:
    """The span to report, if the match passes its kind's test."""
    if kind == "assign":
        return m.span() if m.end(2) - m.start(2) >= 8 else None
    if kind == "access":
        return m.span() if m.end() - m.start() >= 16 else None
    if kind == "github":
        body = m.group()[4:]
        return m.span() if crc_base62(body[:30]) == body[30:] else None
    return m.span(1) if luhn(re.sub(rb"[ -]", b"", m.group(1))) else None


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, keys in KEYWORDS.items():
        for key in keys:
            found.add_word(key, (kind, len(key)))
    found.make_automaton()
    return found


def scan(raw: bytes, machine: ahocorasick.Automaton) -> list[tuple[int, str, int]]:
    """(start, kind, end) in bytes of every secret of one text."""
    hits: dict[str, list[int]] = {}
    # Latin-1 keeps one character per byte; bytes.lower() changes A-Z only.
    for last, (kind, size) in machine.iter(raw.lower().decode("latin-1")):
        hits.setdefault(kind, []).append(last - size + 1)
    out = []
    for kind, places in hits.items():
        done = 0
        for at in sorted(set(places)):
            if at >= done and (m := ANCHORED[kind].match(raw, at)):
                done = m.end()
                if span := _holds(kind, m):
                    out.append((span[0], kind, span[1]))
    return out


def _run(batches):
    machine = automaton()
    order = {k: i for i, k in enumerate(KINDS)}
    for batch in batches:
        data, bounds = W.texts(batch.column("text"))
        starts, ends, first = W.spans(data, bounds, _HEX)
        long = ends - starts >= 32
        rows = []
        for i in range(batch.num_rows):
            part = data[bounds[i]:bounds[i + 1]]
            found = scan(part.tobytes(), machine)
            here = np.flatnonzero(long[first[i]:first[i + 1]]) + first[i]
            found += [(int(starts[k] - bounds[i]), "hex", int(ends[k] - bounds[i])) for k in here]
            if found:
                found.sort(key=lambda x: (x[0], order[x[1]]))
                points = W.code_points(part)
                found = [(int(points[a]), kind, int(points[b])) for a, kind, b in found]
            rows.append(found)
        spans = [",".join(f"{k}:{a}:{b}" for a, k, b in r) for r in rows]
        base = [",".join(f"{k}:{a}:{b}" for a, k, b in r if k in BASE) for r in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array([sum(x[1] == k for x in r) for r in rows], pa.int64()) for k in KINDS],
             pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base]), pa.array(spans, pa.string())],
            names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_<kind> of every kind, base_sha256 (of the base kinds' spans) and spans
    (kind:start:end by start, comma-joined) of every row."""
    arrow_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_run, f"doc_id {kind}, {', '.join(f'n_{k} bigint' for k in KINDS)}, base_sha256 string, spans string")
