"""Fuzzy line dedup by MinHash, exact Jaccard and distributed union-find.

A line's set is its shingles of ``SHINGLE`` UTF-16 code units (a shorter line is one
shingle); blank lines take no part.  Tasks split whole texts, hash all shingles of an
Arrow batch at once and write per line its number, keys and minima, no text.  Bands of the
minima are hash buckets, members of a bucket are compared with hubs (see ``components``),
and a pair is a link if the exact Jaccard similarity of the two shingle sets is at least
``percent`` / 100.  Large buckets that hubs leave open are compared in blocks of bounded
size, which return links only.  Distributed union-find joins links; of each component's
occurrences only the first stays, by (doc_id, text hash, line number).  Equal lines are one
node from the start, so hot lines cost one row per batch.

Defined results.  A null text stays null; blank lines stay.  Rows that agree in doc_id and
text are one document: its copies all get the same result.  A null doc_id comes after all
others.  Extra columns are carried along whole in ``row``, whatever their names.  An empty
table gives an empty result.  Long lines are compared whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlake.llm import words as W
from offerlake.llm.components import link_members
from offerlake.llm.minhash_dedup import shared_sizes
from offerlake.llm.spark import arrow_batches, ids, materialize, small

SHINGLE = 8
MINIMA, ROWS = 42, 3          # minima of a line, and how many make a band
# Disjoint bands: a pair at similarity 0.8 shares none of 14 with probability 4.3e-5.
BANDS = [list(range(b, b + ROWS)) for b in range(0, MINIMA, ROWS)]
# A pair with fewer equal minima is not compared in full; at similarity 0.8 that has
# probability 3e-6.
LEAST_EQUAL = 21
LEFT, RIGHT = 512, 1024       # lines of a block of a large bucket
PIECE = 1 << 18               # UTF-16 units hashed at a time (one line at least)
BLANK = " \t\n\x0b\x0c\r"
_rng = np.random.default_rng(20)
_XOR = _rng.integers(0, 2**32, MINIMA, dtype=np.uint32)
_MUL = _rng.integers(0, 2**31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of every line's shingles, repeats included, and the len(lines) + 1 bounds."""
    raw = [x.encode("utf-16-le") for x in lines]
    units = np.array([len(x) // 2 for x in raw], np.int64)
    wide = np.maximum(units, SHINGLE)                     # short lines are filled up with zeros
    data = np.frombuffer(b"".join(x.ljust(2 * SHINGLE, b"\0") for x in raw), np.uint8)
    if not lines:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    n = len(data) // 2
    four = np.ndarray(n - 3, np.dtype("<u8"), data, 0, (2,))          # four units from each unit on
    h = W.mix(W.mix(four[:-4] * _ONE) + four[4:] * _TWO)
    counts = wide - (SHINGLE - 1)
    at = np.concatenate([[0], np.cumsum(counts)])
    inside = np.ones(n, bool)                             # no shingle begins in a line's last units
    ends = np.cumsum(wide)
    for k in range(1, SHINGLE):
        inside[ends - k] = False
    values = h[inside[:len(h)]]
    short = np.flatnonzero(units < SHINGLE)
    values[at[short]] = W.mix(values[at[short]] + units[short].astype(np.uint64) + np.uint64(1))
    return values, at


def minima(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(lines, MINIMA): the low halves of each permutation's minimum.  The high halves
    choose it, and are nearly the same for all long lines."""
    out = np.empty((len(at) - 1, MINIMA), np.uint16)
    h = values.astype(np.uint32)
    for p in range(MINIMA):
        out[:, p] = np.minimum.reduceat((h ^ _XOR[p]) * _MUL[p], at[:-1]) & np.uint32(0xFFFF)
    return out


def _pieces(lines: list[str]):
    """Runs of consecutive lines of about PIECE characters."""
    part, size = [], 0
    for x in lines:
        if part and size + len(x) > PIECE:
            yield part
            part, size = [], 0
        part.append(x)
        size += len(x)
    if part:
        yield part


def _signatures(lines: list[str]) -> list[bytes]:
    return [row.tobytes() for part in _pieces(lines) for row in minima(*shingles(part))]


def _sets(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every line, sorted, and the bounds."""
    values, at = shingles(lines)
    sets = [np.unique(values[at[i]:at[i + 1]]) for i in range(len(lines))]
    return (np.concatenate(sets) if sets else values), np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)


def _keys(lines: list[str]) -> np.ndarray:
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.encode()) for x in lines), np.int64).reshape(-1, 2)


def _lines(text: str | None) -> list[tuple[int, str]]:
    return [(k, x) for k, x in enumerate((text or "").split("\n")) if x.strip(BLANK)]


def _occurrences(batches):
    """One row per line that is not blank; minima with a line's first row in the batch."""
    for batch in batches:
        row, pos, key, first = [], [], [], {}
        for i, text in enumerate(batch.column("text").to_pylist()):
            for k, line in _lines(text):
                row.append(i), pos.append(k), key.append(first.setdefault(line, len(first)))
        if not row:
            continue
        distinct, key = list(first), np.array(key)
        keys, sig = _keys(distinct)[key], _signatures(distinct)
        lead = np.zeros(len(key), bool)
        lead[np.unique(key, return_index=True)[1]] = True
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).take(pa.array(row)) for c in ("id", "h")]
            + [pa.array(pos, pa.int32()), pa.array(keys[:, 0]), pa.array(keys[:, 1]),
               pa.array([sig[k] if new else None for k, new in zip(key, lead)], pa.binary())],
            names=["id", "h", "pos", "l1", "l2", "minima"])


def _wanted(batches):
    """(text, asked: nodes and line numbers) -> node, line, size."""
    for batch in batches:
        node, line = [], []
        for text, asked in zip(batch.column("text").to_pylist(), batch.column("asked").to_pylist()):
            every = text.split("\n")
            for x in asked:
                node.append(x["node"]), line.append(every[x["pos"]])
        size = [n for part in _pieces(line) for n in np.diff(_sets(part)[1]).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(line, pa.string()), pa.array(size, pa.int64())],
                                         names=["node", "line", "size"])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, MINIMA)


def _prune(batches):
    for batch in batches:
        equal = (_matrix(batch.column("m_a")) == _matrix(batch.column("m_b"))).sum(1)
        yield batch.select(["a", "b"]).filter(pa.array(equal >= LEAST_EQUAL))


def _confirm(percent: int):
    def run(batches):
        kept: dict = {}                          # sets of the last few lines: hubs repeat
        def of(node, line):
            if node not in kept:
                if len(kept) >= 32:
                    kept.pop(next(iter(kept)))
                kept[node] = _sets([line])[0]
            return kept[node]
        for batch in batches:
            ok = []
            for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "line_a", "line_b"))):
                x, y = of(a, x), of(b, y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _compare(percent: int):
    """Links between two blocks of one bucket: one for each line and label of the other side."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if left.num_rows and right.num_rows:
            size = [t.column("size").to_numpy() for t in (left, right)]
            label = [t.column("label").to_numpy() for t in (left, right)]
            total = size[0][:, None] + size[1][None, :]
            alive = (label[0][:, None] != label[1][None, :]) & (100 * np.minimum.outer(*size) >= percent * np.maximum.outer(*size))
            sig, equal = [_matrix(t.column("minima")) for t in (left, right)], np.zeros(total.shape, np.int16)
            for p in range(MINIMA):
                equal += sig[0][:, p][:, None] == sig[1][:, p][None, :]
            alive &= equal >= LEAST_EQUAL
            if alive.any():
                some = [np.flatnonzero(alive.any(k)) for k in (1, 0)]         # only these lines' sets are needed
                sets = [_sets(t.column("line").take(pa.array(k)).to_pylist()) for t, k in zip((left, right), some)]
                common = shared_sizes(*sets[0], *sets[1])
                grid = np.ix_(*some)
                link = alive[grid] & (100 * common >= percent * (total[grid] - common))
                found = []
                for i in np.flatnonzero(link.any(1)):
                    js = np.flatnonzero(link[i])
                    found += [(some[0][i], some[1][j]) for j in js[np.unique(label[1][some[1][js]], return_index=True)[1]]]
                if found:
                    at = np.array(found)
                    x, y = left.column("node").to_numpy()[at[:, 0]], right.column("node").to_numpy()[at[:, 1]]
                    a, b = np.minimum(x, y), np.maximum(x, y)
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """row (the whole input row), text (without the removed lines), n_lines (lines that are
    not blank) and n_removed, for every row of ``docs``."""
    arrow_batches(docs.sparkSession)
    docs = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("h", F.xxhash64("text"))
    id_type = docs.schema["id"].dataType.simpleString()
    occurrences = docs.select("id", "h", "text").mapInArrow(_occurrences, f"id {id_type}, h bigint, pos int, l1 bigint, l2 bigint, minima binary")
    occurrences = materialize(occurrences, "lines-occurrences")
    lines = occurrences.select("id", "h", "pos", "l1", "l2")
    at = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("h").alias("h"), F.col("pos").alias("pos"))

    nodes = occurrences.where("minima is not null").select("l1", "l2", "minima").distinct()
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "lines-nodes")
    bands = F.array(*[F.xxhash64(F.lit(b), F.substring("minima", 2 * band[0] + 1, 2 * ROWS)) for b, band in enumerate(BANDS)])
    buckets = nodes.select("node", F.explode(bands).alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("k")).where("k > 1").select("bucket")
    members = materialize(buckets.join(small(materialize(shared, "lines-shared")), "bucket"), "lines-members")
    open_nodes = materialize(members.select("node").distinct(), "lines-open")
    asked = materialize(nodes.join(small(open_nodes), "node", "left_semi"), "lines-asked")

    # The first occurrence of every line; a line that shares a bucket is read from there.
    first = materialize(lines.groupBy("l1", "l2").agg(F.min(at).alias("first"), F.count("*").alias("k")), "lines-first")
    place = first.select("l1", "l2", "first").join(small(asked.select("node", "l1", "l2"), asked), ["l1", "l2"])
    place = materialize(place.groupBy(F.col("first.h").alias("p_h"), F.col("first.id").alias("p_id"))
                             .agg(F.collect_list(F.struct("node", "first.pos")).alias("asked")), "lines-places")
    found = ids(docs.select("id", "h", "text"), "h", "inner", place, "p_h", place.count(), 200).where("id <=> p_id")
    texts = found.select("text", "asked").mapInArrow(_wanted, "node bigint, line string, size bigint").dropDuplicates(["node"])
    texts = materialize(texts.join(small(asked.select("node", "minima"), asked), "node"), "lines-texts")

    def verify(pairs: DataFrame) -> DataFrame:
        for c in "ab":                           # sizes and minima first, the lines of what is left
            pairs = pairs.join(small(texts.select(F.col("node").alias(c), F.col("size").alias(f"n_{c}"), F.col("minima").alias(f"m_{c}")), texts), c)
        pairs = pairs.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        pairs = materialize(pairs.mapInArrow(_prune, "a bigint, b bigint"), "lines-pairs")
        for c in "ab":
            pairs = pairs.join(small(texts.select(F.col("node").alias(c), F.col("line").alias(f"line_{c}")), texts), c)
        return pairs.mapInArrow(_confirm(percent), "a bigint, b bigint")

    def finish(now: DataFrame) -> DataFrame:
        """Members outside their bucket's largest component meet all others, block by block."""
        now = materialize(now, "lines-large")
        size = now.groupBy("bucket", "label").agg(F.count("*").alias("n"))
        main = size.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("n"))
        main = materialize(main.select("bucket", F.col("main.label").alias("main"), "n"), "lines-main")
        rows = materialize(now.join(small(main), "bucket").join(small(texts), "node"), "lines-blocks")
        deal, cols = F.xxhash64("node"), ["bucket", "l", "r", "node", "label", "size", "line", "minima"]
        l_blocks, r_blocks = F.expr(f"cast(ceil(n / {LEFT}) as int)"), F.expr(f"cast(ceil(n / {RIGHT}) as int)")
        left = (rows.where("label <> main").withColumn("l", F.pmod(deal, l_blocks).cast("int"))
                    .withColumn("r", F.explode(F.sequence(F.lit(0), r_blocks - 1))))
        right = (rows.withColumn("r", F.pmod(deal, r_blocks).cast("int"))
                     .withColumn("l", F.explode(F.sequence(F.lit(0), l_blocks - 1))))
        return (left.select(cols).groupBy("bucket", "l", "r").cogroup(right.select(cols).groupBy("bucket", "l", "r"))
                    .applyInArrow(_compare(percent), "a bigint, b bigint"))

    sized = members.join(small(texts.select("node", "size", F.col("size").alias("reach")), texts), "node")
    label = link_members(sized, verify, percent, "lines", finish=finish)
    part = materialize(asked.select("node", "l1", "l2").join(small(label), "node"), "lines-parts")

    several = first.join(small(part.select("l1", "l2", "label"), part), ["l1", "l2"], "left").where("k > 1 or label is not null")
    several = materialize(several, "lines-several")
    kept = several.where("label is not null").groupBy("label").agg(F.min("first").alias("kept"))
    several = several.join(kept, "label", "left").select("l1", "l2", F.coalesce("kept", "first").alias("kept"))
    several = materialize(several, "lines-kept")
    removed = (lines.join(small(several), ["l1", "l2"]).where(~(F.col("kept") == at))
                    .groupBy(F.col("id").alias("r_id"), F.col("h").alias("r_h")).agg(F.collect_set("pos").alias("gone")))
    removed = materialize(removed, "lines-removed")
    out = docs.join(small(removed), docs["id"].eqNullSafe(F.col("r_id")) & (docs["h"] == F.col("r_h")), "left")
    every = F.split("text", "\n", -1)
    left = F.filter(every, lambda x, i: ~F.array_contains("gone", i))
    return out.select("row", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text"),
                      F.coalesce(F.size(F.filter(every, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))), F.lit(0)).cast("bigint").alias("n_lines"),
                      F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"))
