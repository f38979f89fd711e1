"""Mix sources to target weights with a low-discrepancy slot schedule.

Targets: all words are shared out by the sources' weights; a source stops at ``repeats``
times its own size and its excess goes to the others by weight (water-filling).
Schedule: slot i of N carries one block of B words.  The golden-ratio point
frac(i * phi), in 32-bit fixed point, falls into one source's interval of the cumulative
targets, so that after any number of slots every source has its share to within a few
blocks.  A source has as many slots as its target has blocks: those it lacks follow at the
end, those it has too many carry nothing, and its last slot carries only the words left to
its target (rounded).  A source's k-th slot carries its k-th block: its documents stand in a keyed
shuffle, one after another, repeated whole up to ``repeats`` times, and are cut into
blocks of B words.

Scale.  The place of a document is a prefix sum over (source, shuffle bucket); buckets
are ranges of the shuffle key, so a source with a third of all rows is spread over all
tasks.  Slots are numbered per source the same way, over ranges of slots.  Only per-source
and per-bucket sums meet in a join, and only scalars reach the driver.

Defined results.  A null or empty text, or one without words, has size 0 and is never
taken.  A null source is a source of its own, last in the order; the empty string is an
ordinary source.  Rows that repeat a doc_id, or have none, are separate rows with shuffle
keys of their own; so are rows that are alike in everything.  Extra columns are ignored.  An empty table gives an empty
mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlake.llm.spark import materialize

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK_WORDS = 1024            # words of a block, at most
SLOTS = 1 << 17               # slots of a mix at least, by smaller blocks if need be
ROWS_PER_BUCKET = 50_000
COPIES = 10_000               # copies of one row that one task lists
PHI32 = 2654435769            # 2**32 / golden ratio


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(source, size) rows -> one row per source: source, source_size, target, the same in
    whole words, its place in the order and the cumulative target up to it."""
    per = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())       # over sources, not rows
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    per = materialize(per.withColumn("place", F.row_number().over(order) - 1).withColumn("weight", cycle), "mix-sources")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * repeats
    level, full = 0.0, -1
    while total:                                 # a level that only rises: weight * level, capped
        under = cap <= F.col("weight") * level
        used, rest, n = per.agg(F.coalesce(F.sum(F.when(under, cap)), F.lit(0)), F.sum(F.when(~under, F.col("weight"))),
                                F.count(F.when(under, 1))).first()
        if n == full or not rest:
            break
        level, full = (total - used) / rest, n
    per = per.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(level)))
    per = per.withColumn("words", F.round("target").cast("bigint"))
    return per.withColumn("upto", F.sum("target").over(Window.orderBy("place")))


def _number(df: DataFrame, key: list[str], bucket: str, order: list, value: Column, name: str) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over earlier rows of the same key, summed over
    buckets first and inside one bucket of one key last."""
    df = df.withColumn("__v", value)
    sums = df.groupBy(*key, bucket).agg(F.sum("__v").alias("__sum"))
    sums = materialize(sums.withColumn("__base", F.sum("__sum").over(
        Window.partitionBy(*key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))), name)
    base = sums.select(*[F.col(k).alias(f"__{k}") for k in key], F.col(bucket).alias("__bucket"), F.coalesce("__base", F.lit(0)).alias("__base"))
    same = F.col(bucket) == F.col("__bucket")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    inner = Window.partitionBy(*key, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("__in", F.coalesce(F.sum("__v").over(inner), F.lit(0)))
    return (df.join(base, same).withColumn("before", F.col("__base") + F.col("__in"))
              .drop("__v", "__in", "__base", "__bucket", *[f"__{k}" for k in key]))


def schedule(sources: DataFrame, slots: int, block: int) -> DataFrame:
    """Slot -> source place and rank of the slot among its source's slots, as many as its target needs."""
    spark = sources.sparkSession
    total = sources.agg(F.max("upto")).first()[0] or 0.0
    if not slots or not total:
        return spark.createDataFrame([], "slot bigint, place int, rank bigint")
    cuts = sources.where("target > 0").select(
        "place", F.floor((F.col("upto") - F.col("target")) / total * 2**32).alias("low"),
        F.when(F.col("upto") >= total, 2**32).otherwise(F.floor(F.col("upto") / total * 2**32)).alias("high"))
    # Points are looked up by their 4096-th of the circle: an equi-join, not a range join.
    cuts = cuts.where("high > low").withColumn("cell", F.explode(F.expr("sequence(low div 1048576, (high - 1) div 1048576)")))
    slot = spark.range(slots).withColumnRenamed("id", "slot")
    slot = slot.withColumn("point", F.expr(f"(slot * {PHI32}L) % 4294967296"))
    slot = slot.withColumn("cell", F.expr("point div 1048576"))
    slot = slot.join(cuts, "cell").where("point >= low and point < high").select("slot", "place")
    slot = slot.withColumn("part", F.expr(f"slot div {ROWS_PER_BUCKET}"))
    slot = materialize(_number(slot, ["place"], "part", ["slot"], F.lit(1), "mix-slots").select("slot", "place", F.col("before").alias("rank")), "mix-drawn")
    need = sources.select("place", F.expr(f"cast(ceil(words / {block}) as bigint)").alias("need"))
    have = slot.groupBy("place").agg(F.count("*").alias("have"))
    need = materialize(need.join(have, "place", "left").select("place", "need", F.coalesce("have", F.lit(0)).alias("have")), "mix-needed")
    lack = need.where("need > have").withColumn("base", F.expr("sum(need - have) over (order by place) - (need - have)"))      # over sources, not rows
    more = (lack.withColumn("rank", F.explode(F.expr("sequence(have, need - 1)")))
                .select((F.lit(slots) + F.col("base") + F.col("rank") - F.col("have")).alias("slot"), "place", "rank"))
    return slot.join(need, "place").where("rank < need").select("slot", "place", "rank").union(more)


def _spread(rows: DataFrame, seed: int) -> DataFrame:
    """(doc_id, source, text) -> one row per row: doc_id, source, size, text_key, copy and shuffle.

    Rows alike in doc_id, source and text are told apart by ``copy``, 0, 1, ...: counted before
    the shuffle and listed again in runs of COPIES, so neither they nor rows that share a doc_id
    meet in one task or under one shuffle key, and the result does not depend on partitions."""
    key = ["doc_id", "source", "size", "text_key"]
    alike = (rows.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("text_key"))
                 .groupBy(*key).agg(F.count("*").alias("k")))
    runs = alike.select(*key, "k", F.explode(F.expr(f"sequence(0, (k - 1) div {COPIES})")).alias("run")).repartition("text_key", "doc_id", "run")
    last = F.least(F.col("k"), (F.col("run") + 1) * COPIES) - 1
    listed = runs.select(*key, F.explode(F.sequence(F.col("run") * COPIES, last)).alias("copy"))
    return listed.withColumn("shuffle", F.xxhash64(F.lit(seed), "doc_id", "text_key", "copy"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        repeats: int = REPEATS, seed: int = 1, block_words: int = BLOCK_WORDS, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces).

    documents: one row per row of ``docs``: row (its number), doc_id, source, size, source_size, target.
    pieces: the mix in order: slot, block, row, epoch, from and to (words of the document).
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    rows = materialize(_spread(rows, seed), "mix-rows")
    sources = materialize(targets(rows, weights, repeats), "mix-targets")
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    block = max(1, min(block_words, total // slots))
    parts = max(1, -(-n // ROWS_PER_BUCKET))
    rows = rows.withColumn("part", F.expr(f"pmod(shiftright(shuffle, 32), {parts})"))
    by_place = sources.select(F.col("source").alias("__source"), "place", "source_size", "target", "words")
    rows = rows.join(by_place, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    # Rows of a source in shuffled order; "row" numbers them over all sources.
    rows = _number(rows, ["place"], "part", ["shuffle", "doc_id", "size", "text_key", "copy"], F.col("size"), "mix-places")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "mix-placed")

    plan = schedule(sources, total // block if total else 0, block)
    runs = (rows.where("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
                .withColumn("lo", F.expr("epoch * source_size + before")).withColumn("hi", F.expr("lo + size")))
    # Epochs and blocks beyond the source's target are left out before they are cut.
    runs = (runs.where("lo < words").withColumn("hi", F.least("hi", "words"))
                .withColumn("block", F.explode(F.expr(f"sequence(lo div {block}, (hi - 1) div {block})"))))
    pieces = (runs.join(plan, (runs["place"] == plan["place"]) & (runs["block"] == plan["rank"]))
                  .select("slot", "block", "row", "epoch",
                          (F.greatest("lo", F.col("block") * block) - F.col("lo")).alias("from"),
                          (F.least("hi", (F.col("block") + 1) * block) - F.col("lo")).alias("to")))
    documents = rows.select("row", "doc_id", "source", "size", "source_size", "target")
    return documents, pieces


def taken(docs: DataFrame, **kwargs) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes, repeats counted)."""
    documents, pieces = mix(docs, **kwargs)
    words = pieces.groupBy("row").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    return (documents.join(words, "row", "left")
                     .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")))
