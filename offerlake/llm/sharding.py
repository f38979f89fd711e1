"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

A uniformly random assignment of rows to shards of given sizes, seen from the input
partitions, is a matrix of counts with multivariate hypergeometric rows.  The matrix is drawn
first; then every partition permutes its rows on its own and deals them out by its row of
the matrix, the shards take in what they are dealt, and every shard permutes once more.  All
arrangements are equally likely (up to the hash that orders the rows), shard sizes are exact:
they differ by one row at most, and the first ``rows mod shards`` shards have one more.

Scale.  The matrix is drawn in two levels, both bounded: the driver draws the counts of
groups of partitions, one task per group those of its partitions.  Permuting locally is a row
number inside one input partition.  The second permutation orders a shard by a second hash;
its row numbers are counted in buckets, ranges of that hash, of about ``ROWS_PER_BUCKET``
rows, and only bucket counts meet in a prefix sum, so no task holds a shard.  Rows are
numbered once and written; a lost executor repeats its own tasks with the same draws.

Law: ``rows`` (counts at most one apart).  Equal texts are separate rows and need not meet.
The result depends on the input's partitioning, as the matrix does; with the same files and
settings reruns agree.

Defined results.  A null text has 0 bytes and the CRC-32 of no bytes, 0.  Null and repeated
doc_ids are rows like any other.  Fewer rows than shards leave shards empty.  Extra columns
are carried along whole in ``row``, whatever their names.  An empty table gives an empty
result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlake.llm.spark import materialize

SHARDS = 40
PARTS_PER_GROUP = 256         # partitions whose counts one task draws, at least
ROWS_PER_BUCKET = 50_000
ROW_OVERHEAD = 16             # bytes of a row besides its text


def shard_sizes(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def draw(counts: list[int], sizes: list[int], rng: np.random.Generator) -> np.ndarray:
    """A matrix with row sums ``counts`` and column sums ``sizes``, distributed as the counts
    of a uniformly random assignment."""
    left = np.array(sizes, np.int64)
    out = np.zeros((len(counts), len(left)), np.int64)
    for i, n in enumerate(counts):
        rest, total = n, int(left.sum())
        for s in range(len(left)):                    # one shard after the other: exact for any size
            bad = total - int(left[s])
            if rest == 0:
                break
            k = rest if bad == 0 else int(rng.hypergeometric(int(left[s]), bad, rest)) if total < 10**9 else _large(rng, int(left[s]), bad, rest)
            out[i, s] = k
            rest, total = rest - k, bad
        left -= out[i]
    return out


def _large(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """A hypergeometric draw beyond numpy's range, by the ratio of uniforms: a point of a
    table mountain over the mode is accepted if it lies below the probability there."""
    total = good + bad
    mean = n * good / total
    spread = math.sqrt(mean * (bad / total) * ((total - n) / max(1, total - 1)) + 0.5)
    scale = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)

    def log_p(k: int) -> float:
        return -sum(math.lgamma(x + 1) for x in (k, good - k, n - k, bad - n + k))

    top = log_p((n + 1) * (good + 1) // (total + 2))
    while True:
        x, y = 1 - rng.random(), rng.random()
        k = math.floor(mean + 0.5 + scale * (y - 0.5) / x)
        if max(0, n - bad) <= k <= min(good, n) and 2 * math.log(x) <= log_p(k) - top:
            return k


def _matrix(numbered: DataFrame, shards: int, seed: int) -> DataFrame:
    """(part, ends): of every input partition, the running sums of its row of the matrix."""
    spark = numbered.sparkSession
    per = materialize(numbered.groupBy("part").agg(F.count("*").alias("n")), "shards-parts")
    parts = per.agg(F.max("part")).first()[0]
    size = max(PARTS_PER_GROUP, math.isqrt((parts or 0) + 1))
    per = per.withColumn("group", F.floor(F.col("part") / size))
    groups = per.groupBy("group").agg(F.sum("n").alias("n")).orderBy("group").collect()      # a row per group
    counts = [g.n for g in groups]
    first = draw(counts, shard_sizes(sum(counts), shards), np.random.default_rng(seed))
    level = spark.createDataFrame([(int(g.group), row.tolist()) for g, row in zip(groups, first)], "group bigint, sizes array<bigint>")

    def second(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("part")
        rng = np.random.default_rng([seed, left.column("group")[0].as_py()])
        rows = draw(left.column("n").to_pylist(), right.column("sizes")[0].as_py(), rng)
        return pa.table({"part": left.column("part"), "ends": pa.array(np.cumsum(rows, axis=1).tolist(), pa.list_(pa.int64()))})

    return per.groupBy("group").cogroup(level.groupBy("group")).applyInArrow(second, "part bigint, ends array<bigint>")


def shuffle(rows: DataFrame, *, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """row (the whole input row), shard (0 to shards - 1) and slot (from 0, without gaps)."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    # Upper 31 bits: the partition that wrote the row, lower 33 bits: its place there.
    numbered = materialize(rows.select(F.struct("*").alias("row")).withColumn("number", F.monotonically_increasing_id()), "shards-rows")
    numbered = numbered.withColumn("part", F.shiftright("number", 33))
    n = numbered.count()
    if not n:
        return numbered.select("row", F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot")).limit(0)
    ends = _matrix(numbered, shards, seed).withColumnRenamed("part", "m_part")
    local = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), F.lit("out"), "number"), "number")
    dealt = numbered.withColumn("place", F.row_number().over(local) - 1).join(ends, F.col("part") == F.col("m_part"))
    dealt = dealt.withColumn("shard", F.expr("aggregate(ends, 0, (k, e) -> k + int(e <= place))"))

    buckets = max(1, math.ceil(n / shards / ROWS_PER_BUCKET))
    taken = dealt.select("row", "number", "shard", F.xxhash64(F.lit(seed), F.lit("in"), "number").alias("turn"))
    # Equal ranges of the hash, in its order.
    taken = materialize(taken.withColumn("bucket", F.floor((F.shiftrightunsigned("turn", 1) * 1.0 / float(1 << 63)) * buckets)), "shards-dealt") \
        .withColumn("turn", F.shiftrightunsigned("turn", 1))
    sums = taken.groupBy("shard", "bucket").agg(F.count("*").alias("k"))
    upto = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("shard").alias("b_shard"), F.col("bucket").alias("b_bucket"), F.coalesce(F.sum("k").over(upto), F.lit(0)).alias("base"))
    inner = Window.partitionBy("shard", "bucket").orderBy("turn", "number")
    return (taken.withColumn("inner", F.row_number().over(inner) - 1)
                 .join(base, (F.col("shard") == F.col("b_shard")) & (F.col("bucket") == F.col("b_bucket")))
                 .select("row", F.col("shard").cast("int").alias("shard"), (F.col("base") + F.col("inner")).cast("bigint").alias("slot")))


def assign(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null: another number of
    shards deals all rows anew) of every document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + ROW_OVERHEAD).cast("bigint").alias("size"),
                         F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return shuffle(narrow, shards=shards, seed=seed).select(
        "row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write(docs: DataFrame, path: str, *, shards: int = SHARDS, seed: int = 0, files_per_shard: int = 1) -> None:
    """Writes whole rows (column ``row``) as Parquet folders ``shard=k`` under ``path``, each file a range of
    slots in order.  A shard larger than a task should hold takes more ``files_per_shard``."""
    dealt = shuffle(docs, shards=shards, seed=seed)
    n = dealt.groupBy("shard").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    dealt = dealt.withColumn("file", F.floor(F.col("slot") * files_per_shard / n))
    (dealt.repartitionByRange(shards * files_per_shard, "shard", "file").sortWithinPartitions("shard", "slot")
          .select("shard", "slot", "row").write.partitionBy("shard").parquet(path))
