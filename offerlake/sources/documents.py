"""Records of JSON documents of any size, cut out of byte ranges.

A feed document is one JSON value, an array or an object of records, and may be one line of
many gigabytes.  Spark's text reader splits a file at any character; with ``}`` as the line
separator a document becomes fragments that end where some object ends (or where a string
holds a brace), and every byte range of the file is read by a task of its own.

What a fragment means depends on what stands before it: is its first character inside a
string, and how deep in the document?  For each of the two string states a fragment has an
end state and a change of depth.  These transitions compose, so a range has one, too: they
are summed up in a range, combined over the ranges of a file (one row per range), and applied
back.  An escape never spans fragments, because the character before a cut is a brace.

A brace outside strings that leads back to depth 1 ends a record of the root.  The fragments
between two such ends are one chunk: a comma and a record (with any members before it that
are no objects).  Chunks are put together, wrapped in the root's brackets and parsed like
small documents of their own.

Cutting pays for documents that would keep one task busy.  Those of at most ``WHOLE`` bytes,
a fraction of a byte range, are one chunk of their own, read and parsed where they are read.
So are small compressed files, once their texts have been found to be no longer.

A document that is not valid JSON stops the job: open strings or brackets at its end, a
missing or superfluous comma, a truncated last brace (found by the file's size, so not in
compressed files that are cut, where a superfluous one is not found either), or a chunk that
does not parse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlake.session import materialize

SEPARATOR = "}"
BLANK = r"[ \t\n\r]"                     # white space of JSON
BOM = 3                                  # bytes of a byte order mark, which the reader drops
COMPRESSED = r"\.(gz|bz2|zst|lz4|snappy|deflate|xz)$"
WHOLE = 16 << 20                         # bytes of a document that is read in one piece, at most


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """file, block (first byte of the range), seq (order in a range), size (of the file), text."""
    read = spark.read.option("lineSep", SEPARATOR).text(path)
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("seq"), F.col("_metadata.file_size").alias("size"), F.col("value").alias("text"))


def _count(text: Column, chars: str) -> Column:
    """Occurrences of some ASCII characters."""
    return sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in chars), F.lit(0))


def _transitions(frags: DataFrame) -> DataFrame:
    """Adds ``turn`` (1 if the string state changes) and ``d0``, ``d1`` (change of depth if the
    fragment begins outside or inside a string), without the brace behind the fragment.

    Quotes cut a fragment into parts that are outside and inside strings by turns, so what is
    outside for one of the two states is inside for the other: d0 + d1 is the change over all."""
    blank = F.lit(" \t\n\r")
    escapes = F.col("text").contains("\\")
    plain = frags.select("file", "block", "seq", "size", F.octet_length("text").alias("bytes"),
                         F.substring(F.ltrim(F.col("text"), blank), 1, 1).alias("head"),
                         F.when(escapes, F.regexp_replace("text", r"(?s)\\.", "")).otherwise(F.col("text")).alias("t"))
    outside = plain.select("*", F.regexp_replace("t", r'"[^"]*+("|$)', "").alias("o"))
    change = lambda c: _count(F.col(c), "[{") - _count(F.col(c), "]")
    return (outside.select("file", "block", "seq", "size", "bytes", "head", (_count(F.col("t"), '"') % 2).alias("turn"),
                           change("o").alias("d0"), change("t").alias("all"))
                   .withColumn("d1", F.col("all") - F.col("d0")).drop("all"))


def _by_range(df: DataFrame) -> DataFrame:
    """Rows of a byte range together.  The rows are so small that Spark would put millions of
    them into one task; a given number of partitions is left as it is.  For the same reason
    the joins below say that the table of ranges, one row each, is the one to broadcast."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file", "block")


def _chunks(frags: DataFrame) -> DataFrame:
    """file, seq, closed (a brace follows), chunk, last (the file's last chunk), kind (first
    character of the document) and balanced (the document ends at depth 0, outside strings)."""
    key = ["file", "block"]
    marks = materialize(_transitions(frags), "json-transitions")
    by_file = Window.partitionBy("file")                                     # over ranges, not fragments
    before = by_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def earlier(col: Column) -> Column:
        return F.coalesce(F.sum(col).over(before), F.lit(0))

    ranges = marks.groupBy(*key).agg(F.sum(F.col("bytes") + 1).alias("bytes"), F.first("size").alias("size"), F.max("seq").alias("end"),
                                     F.min_by("head", "seq").alias("head"))
    excess = F.sum("bytes").over(by_file) - F.col("size")
    cut_off = (F.col("block") == F.max("block").over(by_file)) & ~F.col("file").rlike(COMPRESSED) & excess.isin(1, 1 - BOM)
    ranges = ranges.select(*key, F.when(cut_off, F.col("end")).alias("open_end"), F.min_by("head", "block").over(by_file).alias("kind"))

    # String state and depth before each fragment, for a range that begins outside (0) or
    # inside (1) a string.
    inside = Window.partitionBy(*key).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    steps = _by_range(marks).join(F.broadcast(ranges), key).withColumn("closed", ~F.col("seq").eqNullSafe(F.col("open_end")))
    steps = steps.withColumn("turned", F.coalesce(F.sum("turn").over(inside), F.lit(0)) % 2)
    for s in (0, 1):
        begins = (F.col("turned") + s) % 2
        ends = (begins + F.col("turn")) % 2
        change = F.when(begins == 0, F.col("d0")).otherwise(F.col("d1")) - F.when((ends == 0) & F.col("closed"), 1).otherwise(0)
        steps = steps.withColumn(f"string{s}", ends).withColumn(f"change{s}", change)
    for s in (0, 1):
        steps = steps.withColumn(f"deep{s}", F.coalesce(F.sum(f"change{s}").over(inside), F.lit(0)) + F.col(f"change{s}"))
    steps = materialize(steps.select(*key, "seq", "closed", "kind", "turn", *[f"{c}{s}" for c in ("string", "change", "deep") for s in (0, 1)]), "json-steps")

    table = steps.groupBy(*key).agg(F.sum("turn").alias("turn"), F.sum("change0").alias("change0"), F.sum("change1").alias("change1"), F.max("seq").alias("end"))
    table = table.withColumn("state", earlier(F.col("turn")) % 2)
    table = table.withColumn("change", F.when(F.col("state") == 0, F.col("change0")).otherwise(F.col("change1")))
    # A compressed file, which is one range, tells by its depth only that no brace follows its end.
    total = F.sum("change").over(by_file)
    bare = F.col("file").rlike(COMPRESSED) & (total == -1)
    table = table.select(*key, "state", earlier(F.col("change")).alias("depth"), F.when(bare, F.col("end")).alias("bare_end"),
                         (((total == 0) | bare) & (F.sum("turn").over(by_file) % 2 == 0)).alias("balanced"))
    pick = lambda c: F.when(F.col("state") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1"))
    known = steps.join(F.broadcast(table), key)
    ends_record = F.col("closed") & (pick("string") == 0) & (F.col("depth") + pick("deep") == 1)
    closed = (F.col("closed") & ~F.col("seq").eqNullSafe(F.col("bare_end"))).alias("closed")
    known = materialize(known.select(*key, "seq", closed, "kind", "balanced", ends_record.cast("int").alias("ends")), "json-ends")

    table = known.groupBy(*key).agg(F.sum("ends").alias("ends"))
    table = table.select(*key, earlier(F.col("ends")).alias("base"), F.sum("ends").over(by_file).alias("total"))
    return _by_range(known).join(F.broadcast(table), key).select("file", "seq", "closed", "kind", "balanced",
                                         (F.col("base") + F.coalesce(F.sum("ends").over(inside), F.lit(0))).alias("chunk"), "total")


def _members() -> tuple[Column, Column]:
    """Of a chunk (text, kind, chunk, last, balanced): the members as a document of their own,
    and whether the chunk is sound."""
    text, first = F.col("text"), F.col("chunk") == 0
    array = F.col("kind") == "["
    comma = text.rlike(f"^{BLANK}*,")
    body = F.when(first, F.regexp_replace(text, f"^{BLANK}*[\\[{{]", "")).otherwise(F.regexp_replace(text, f"^{BLANK}*,", ""))
    ended = F.when(array, text.rlike(f"\\]{BLANK}*$")).otherwise(text.rlike(f"}}{BLANK}*$"))
    body = F.when(F.col("last"), F.regexp_replace(body, f"[\\]}}]{BLANK}*$", "")).otherwise(body)
    blank = body.rlike(f"^{BLANK}*$")
    sound = F.when(F.col("last"), ended & (first | (comma != blank))).otherwise(first | comma)
    return F.concat(F.col("kind"), body, F.when(array, "]").otherwise("}")), sound & F.col("balanced")


def _is_small(file: Column, size: Column, most: int, long: Sequence[str] | None = None) -> Column:
    """``long``: the compressed documents that are not small though their files are (None: all)."""
    packed = file.rlike(COMPRESSED)
    return (size <= most) & ~(packed if long is None else packed & file.isin(*long))


def long_texts(spark: SparkSession, path: str) -> list[str]:
    """Compressed documents under ``path`` of at most ``WHOLE`` bytes whose text is longer.  Their
    texts are read in fragments, because a small file may hold a text of any length."""
    file = F.col("_metadata.file_path")
    read = spark.read.option("lineSep", SEPARATOR).text(path).where(file.rlike(COMPRESSED) & (F.col("_metadata.file_size") <= WHOLE))
    sizes = read.select(file.alias("file"), (F.octet_length("value") + 1).alias("bytes")).groupBy("file").agg(F.sum("bytes").alias("bytes"))
    return [r.file for r in sizes.where(F.col("bytes") > WHOLE).select("file").collect()]


def judged(spark: SparkSession, path: str, *, above: int = -1, long: Sequence[str] | None = None) -> DataFrame:
    """(file, chunk, kind, value, good): every chunk as a document with root ``kind``, and
    whether it is sound; a document whose root is no array and no object is one chunk.
    Documents of at most ``above`` bytes are left out, compressed ones if ``long`` is given and
    does not name them."""
    frags = materialize(fragments(spark, path).where(~_is_small(F.col("file"), F.col("size"), above, long)), "json-fragments")
    placed = _chunks(frags).withColumnRenamed("file", "in_file").withColumnRenamed("seq", "in_seq")
    parts = frags.join(placed, (F.col("file") == F.col("in_file")) & (F.col("seq") == F.col("in_seq")))
    part = F.struct("block", "seq", F.concat("text", F.when(F.col("closed"), SEPARATOR).otherwise("")).alias("t"))
    whole = parts.groupBy("file", "chunk").agg(F.sort_array(F.collect_list(part)).alias("parts"), F.first("kind").alias("kind"),
                                               F.first("balanced").alias("balanced"), F.first("total").alias("total"))
    whole = whole.select("file", "chunk", "kind", "balanced", (F.col("chunk") == F.col("total")).alias("last"), F.array_join("parts.t", "").alias("text"))
    value, sound = _members()
    rooted = F.col("kind").isin("[", "{")
    whole = whole.select("file", "chunk", "kind", F.when(rooted, value).otherwise(F.col("text")).alias("value"),
                         F.when(rooted, sound).otherwise(F.lit(True)).alias("sound"))
    return whole.select("file", "chunk", "kind", "value", (F.col("sound") & F.get_json_object("value", "$").isNotNull()).alias("good"))


def judged_whole(spark: SparkSession, path: str, *, long: Sequence[str] | None = None) -> DataFrame:
    """``judged`` for the small documents (compressed ones, too, if ``long`` is given), each one chunk.  A root in brackets is sound if it parses both
    as the member of an array and as that of an object: no text behind it fits into both."""
    size = F.col("_metadata.file_size")
    read = spark.read.text(path, wholetext=True).where(_is_small(F.col("_metadata.file_path"), size, WHOLE, long))
    text = F.regexp_replace("value", "^\ufeff", "")
    whole = read.select(F.col("_metadata.file_path").alias("file"), F.lit(0).cast("bigint").alias("chunk"), text.alias("value"))
    whole = whole.withColumn("kind", F.substring(F.ltrim(F.col("value"), F.lit(" \t\n\r")), 1, 1))

    def parses(v: Column) -> Column:
        return F.get_json_object(v, "$").isNotNull()

    value = F.col("value")
    good = F.when(F.col("kind").isin("[", "{"), parses(F.concat(F.lit("["), value, F.lit("]"))) & parses(F.concat(F.lit('{"":'), value, F.lit("}"))))
    return whole.select("file", "chunk", "kind", "value", good.otherwise(parses(value)).alias("good"))


def _checked(found: DataFrame) -> DataFrame:
    bad = F.raise_error(F.concat(F.lit("feed document is not valid JSON: "), F.col("file")))
    return found.select("file", "chunk", F.when(F.col("good"), F.col("kind")).otherwise(bad).alias("kind"), "value")


def chunks(spark: SparkSession, path: str, *, above: int = -1, long: Sequence[str] | None = None) -> DataFrame:
    """(file, chunk, kind, value): the chunks of the documents under ``path`` of more than ``above``
    bytes, and of compressed ones as in ``judged``; an unsound one stops the job."""
    return _checked(judged(spark, path, above=above, long=long))


def in_pieces(spark: SparkSession, path: str) -> DataFrame:
    """``chunks`` of all documents under ``path``, each small one in one piece."""
    files = spark.read.format("binaryFile").load(path)       # sizes only: contents are not read
    files = files.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"))
    packed = files.where(F.col("file").rlike(COMPRESSED) & (F.col("size") <= WHOLE))
    long = None if packed.isEmpty() else long_texts(spark, path)
    small = _checked(judged_whole(spark, path, long=long))
    large = files.where(~_is_small(F.col("file"), F.col("size"), WHOLE, long))
    return small if large.isEmpty() else small.unionByName(chunks(spark, path, above=WHOLE, long=long))
