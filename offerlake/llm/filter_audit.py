"""Audit of how five corpus filters interact, for every order of them.

Failure conditions (words: maximal ``[^\\x20\\x09-\\x0D]+``, case-sensitive):
A  under 200 words;  B  100 * distinct words < 50 * words;  C  100 * capitals A-Z > 3 * code
points;  D  holds any of ``#$%&*|``;  E  identical to any smaller doc_id's text, in the whole
table.

E is an existential self-join: rows whose text hash occurs more than once meet, in a left
semi join on hash and exact text, the smallest doc_id of that text, and stay if their own is
greater.  The ids that fail E are united with all rows' other failures; a grouped OR gives
each row's bit combination, and rows are added up per part and combination.  There are 32
combinations, so the 120 orders are read off these sums and no document is looked at twice.

Scale.  The right side of the semi join has one row per repeated text (added up in the task
before the shuffle, so a text that a third of all rows share costs one row per task); its
left side may hold a hot text, which Spark's skew join splits.  Only rows with a repeated
hash carry their text.  Orders are exploded over (part, combination) sums, 32 per part.

Defined results.  A null text is empty.  Part is the language; null is the empty string.  A
null doc_id is smaller than none and has none smaller, so it never fails E.  Rows that
repeat doc_id and text are counted one by one, with equal verdicts; the same doc_id with
another text is judged by its own text.  A label row counts as good or toxic if any row of
its doc_id says 1; a document without one is neither.  Extra columns are ignored.  An empty
table has no parts and gives an empty result.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake.llm.spark import materialize, small

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
BIT = {f: 1 << k for k, f in enumerate(FILTERS)}
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def own_failures(docs: DataFrame) -> Column:
    """Bits A to D of a row with ``n_words``, ``n_distinct`` and ``text``."""
    length = F.length("text")
    capitals = length - F.length(F.translate("text", _CAPITALS, ""))
    tests = {"A": F.col("n_words") < LEAST_WORDS, "B": 100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"),
             "C": 100 * capitals > MOST_CAPITALS * length, "D": F.col("text").rlike("[#$%&*|]")}
    bits = F.lit(0)
    for f, test in tests.items():
        bits = bits + F.when(test, BIT[f]).otherwise(0)
    return bits.cast("int")


def repeated(texts: DataFrame) -> DataFrame:
    """Rows (part, doc_id, h, h2) whose text a smaller doc_id has."""
    shared = texts.groupBy("h", "h2").agg(F.count("*").alias("k")).where("k > 1").select(F.col("h").alias("s_h"), F.col("h2").alias("s_h2"))
    shared = materialize(shared, "audit-shared")
    some = texts.join(small(shared), (F.col("h") == F.col("s_h")) & (F.col("h2") == F.col("s_h2")), "left_semi")
    # Written first: a join whose sides are plain shuffles is one that Spark can split.
    first = materialize(some.groupBy(F.col("h").alias("f_h"), F.col("text").alias("f_text")).agg(F.min("doc_id").alias("f_id")), "audit-first")
    return some.join(small(first), (F.col("h") == F.col("f_h")) & (F.col("text") == F.col("f_text")) & (F.col("f_id") < F.col("doc_id")), "left_semi")


def combinations(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """part, bits, n, good, toxic: rows of every part and combination of failures."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("part"), F.col(id_col).alias("doc_id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("h", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(1), "text"))
    key = ["part", "doc_id", "h", "h2"]
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    own = texts.select(*key, "text", F.size(words).alias("n_words"), F.size(F.array_distinct(words)).alias("n_distinct"))
    own = own.select(*key, own_failures(own).alias("bits"), F.lit(1).cast("bigint").alias("n"))
    again = repeated(texts).select(*key).distinct().select(*key, F.lit(BIT["E"]).alias("bits"), F.lit(0).cast("bigint").alias("n"))
    rows = own.union(again).groupBy(*key).agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))

    marks = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("l_id"))
                   .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
                   .where("good = 1 or toxic = 1"))
    marks = materialize(marks, "audit-labels")
    # Rows without an id have no label; they would all meet in one task of the join.
    rows = materialize(rows, "audit-rows")
    known = rows.where("doc_id is not null").join(small(marks), F.col("doc_id") == F.col("l_id"), "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(0)) * F.col("n")
    known = known.select("part", "bits", "n", flag("good").alias("good"), flag("toxic").alias("toxic"))
    none = rows.where("doc_id is null").select("part", "bits", "n", F.lit(0).cast("bigint").alias("good"), F.lit(0).cast("bigint").alias("toxic"))
    return known.union(none).groupBy("part", "bits").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley: one row per part, order of the filters and step (1 to 5), zeros included."""
    sums = combinations(docs, labels, **columns)
    orders = F.split(F.lit(" ".join("".join(x) for x in permutations(FILTERS))), " ")
    each = sums.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bit, before = F.lit(0), F.lit(0)
    for f in FILTERS:
        place = F.instr("filter_order", f)
        bit, before = bit + F.when(place == F.col("step"), BIT[f]).otherwise(0), before + F.when(place < F.col("step"), BIT[f]).otherwise(0)
    each = each.withColumn("bit", bit).withColumn("before", before)
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    earlier = F.col("bits").bitwiseAND(F.col("before")) != 0
    total = lambda test, value="n": F.sum(F.when(test, F.col(value)).otherwise(0))
    # Of the orders, one in as many as a row has failures removes it by this filter.
    share = F.col("n") * F.expr("120 div greatest(1, bit_count(bits))")
    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"), total(fails & ~earlier).alias("removed"), total(fails & earlier).alias("redundant"),
        total(F.col("bits") == F.col("bit")).alias("unique_fails"), total(fails & ~earlier, "good").alias("good_lost"),
        total(fails & ~earlier, "toxic").alias("toxic_lost"), F.sum(F.when(fails, share).otherwise(0)).alias("shapley"))
