"""Raw JSON feed documents -> positioned records.

A feed document is either a JSON array of records or a JSON object whose
values are the records (keyed by id).  ``read_feed`` cuts large documents into chunks of
records by byte ranges (see ``documents``); ``explode_records`` takes documents that
are whole in a row.  Either way records become ``(pos, key, raw)`` rows where ``raw``
keeps each record's original JSON text; typed parsing happens later, from those rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from offerlake.operators.keys import in_order, offsets
from offerlake.schemas import BRONZE_ROWS
from offerlake.session import materialize
from offerlake.sources import documents

TWIN_URL_RE = r"(?i)indeed\."


class MalformedFeedError(ValueError):
    """A feed document, or a record of one, is not what its format says."""


def missing(e: AnalysisException) -> bool:
    """Does the error say that a path does not exist?  (Any other error is raised.)"""
    return e.getCondition() == "PATH_NOT_FOUND"


def _no_empty_file(spark: SparkSession, path: str) -> None:
    """An empty file yields no row at all, so it is looked for among the file sizes."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in fs.globStatus(p) or []:
        for st in (fs.listStatus(found.getPath()) if found.isDirectory() else [found]):
            if st.isFile() and st.getLen() == 0 and not st.getPath().getName().startswith(("_", ".")):
                raise MalformedFeedError(f"feed document is not valid JSON: {st.getPath()} is empty")


def exists(spark: SparkSession, path: str | None) -> bool:
    """Is there a file or folder at ``path`` (or one that the pattern fits)?"""
    if not path:
        return False
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def resolve(spark: SparkSession, candidates: str | None | Sequence[str | None]) -> str | None:
    """The first of the candidates (one path, or several in order) that is there, in any store
    that Spark reads; None if none is."""
    if candidates is None or isinstance(candidates, str):
        candidates = [candidates]
    return next((c for c in candidates if exists(spark, c)), None)


def read_documents(spark: SparkSession, path: str | None) -> DataFrame | None:
    """One row per file (``file``, ``value``); None when the path does not exist."""
    if not path:
        return None
    try:
        _no_empty_file(spark, path)
        return (spark.read.text(path, wholetext=True)
                     .select(F.input_file_name().alias("file"), "value"))
    except AnalysisException as e:
        if missing(e):
            return None
        raise


def _kind() -> Column:
    """'[' or '{' for an array or an object, another character for any other root; a
    document that is not valid JSON stops the job."""
    return (F.when(F.get_json_object("value", "$").isNotNull(), F.regexp_extract("value", r"\S", 0))
             .otherwise(F.raise_error(F.concat(F.lit("feed document is not valid JSON: "), F.col("file")))))


def require(df: DataFrame, column: str, ok: Column, what: str) -> DataFrame:
    """``df``, whose job fails where a value of ``column`` is not ``ok``."""
    bad = F.raise_error(F.concat(F.lit(f"{what}: "), F.coalesce(F.substring(F.col(column), 1, 200), F.lit("null"))))
    return df.withColumn(column, F.when(F.coalesce(ok, F.lit(False)), F.col(column)).otherwise(bad))


def empty_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BRONZE_ROWS)


def explode_records(docs: DataFrame) -> DataFrame:
    """(pos, key, raw) records of array or keyed-object documents.

    ``pos`` counts records in document order across files taken in path
    order; a document whose root is neither an array nor an object yields
    nothing, one that is not valid JSON stops the job.

    A key repeated in one object keeps its first position and its last value,
    as a JSON object loaded into a dictionary does.
    """
    return _number(docs.select("file", F.lit(0).cast("bigint").alias("chunk"), _kind().alias("kind"), "value"))


def _number(chunks: DataFrame) -> DataFrame:
    """(pos, key, raw) of (file, chunk, kind, value) documents, in order of file and chunk."""
    rows = chunks.select("file", "chunk", F.when(F.col("kind") == "[", F.from_json("value", "array<string>")).alias("arr"),
                         F.when(F.col("kind") == "{", F.map_entries(F.from_json("value", "map<string,string>"))).alias("obj"))
    entries = F.coalesce(
        F.transform("arr", lambda r: F.struct(F.lit(None).cast("string").alias("key"), r.alias("raw"))),
        F.transform("obj", lambda e: F.struct(e["key"].alias("key"), e["value"].alias("raw"))),
        F.array().cast("array<struct<key:string,raw:string>>"))
    rows = rows.select("file", "chunk", F.posexplode(entries).alias("p", "e")).select(
        "file", F.struct("chunk", F.col("p").cast("bigint").alias("p")).alias("p"), F.col("e.key").alias("key"), F.col("e.raw").alias("raw"))
    rows = materialize(rows, "feed-records", "zstd")     # each document is parsed once
    rows = _first_places(rows)
    # Chunks are numbered over all files in order, not their records: no task holds a whole file,
    # and records are not shuffled when the chunks are few.
    counts = rows.groupBy("file", F.col("p.chunk").alias("chunk")).agg(F.count(F.lit(1)).alias("n"))
    placed = in_order(counts, [F.col("file"), F.col("chunk")], "feed-chunks")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("__b").orderBy("__i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = placed.withColumn("before", before).join(F.broadcast(offsets(placed, F.sum("n"))), F.col("__b") == F.col("__p"))
    starts = materialize(starts.select(F.col("file").alias("in_file"), F.col("chunk").alias("in_chunk"), (F.col("__off") + F.col("before")).alias("start")), "feed-starts")
    return (rows.join(starts, (F.col("file") == F.col("in_file")) & (F.col("p.chunk") == F.col("in_chunk")))
                .select((F.col("start") + F.col("p.p")).cast("bigint").alias("pos"), "key", "raw"))


def _first_places(rows: DataFrame) -> DataFrame:
    """``rows`` (file, p, key, raw) with one record per key and file, the key's last in its first
    place; ``p.p`` counts what is left of a chunk.  Without repeated keys nothing moves."""
    key = ["file", "key"]
    repeated = materialize(rows.where(F.col("key").isNotNull()).groupBy(*key).agg(F.min("p").alias("first"), F.count(F.lit(1)).alias("n"))
                               .where(F.col("n") > 1).drop("n"), "feed-repeated")
    if repeated.isEmpty():
        return rows
    one = rows.join(repeated, key, "left_semi").groupBy(*key).agg(F.min("p").alias("p"), F.max_by("raw", "p").alias("raw"))
    left = rows.join(repeated, key, "left_anti").unionByName(one.select(*rows.columns))
    # Only chunks that lost a record are counted anew.
    gone = rows.select(*key, "p").join(repeated, key).where(F.col("p") != F.col("first")).select("file", F.col("p.chunk").alias("chunk")).distinct()
    gone = materialize(gone.select(F.col("file").alias("in_file"), F.col("chunk").alias("in_chunk")), "feed-gaps")
    hit = (F.col("file") == F.col("in_file")) & (F.col("p.chunk") == F.col("in_chunk"))
    left = materialize(left, "feed-kept", "zstd")
    place = F.row_number().over(Window.partitionBy("file", "p.chunk").orderBy("p")).cast("bigint") - 1
    moved = left.join(gone, hit, "left_semi").withColumn("p", F.struct(F.col("p.chunk").alias("chunk"), place.alias("p")))
    return left.join(gone, hit, "left_anti").unionByName(moved)


def read_records(spark: SparkSession, path: str | None) -> DataFrame | None:
    """(pos, key, raw) of the documents under ``path``, a large one read by as many tasks as it
    has byte ranges, a small one in one piece; None when the path does not exist."""
    if not path:
        return None
    try:
        _no_empty_file(spark, path)
        return _number(documents.in_pieces(spark, path))
    except AnalysisException as e:
        if missing(e):
            return None
        raise


def read_feed(spark: SparkSession, path: str | None) -> DataFrame:
    rows = read_records(spark, path)
    return empty_rows(spark) if rows is None else rows


def explode_twin_map(docs: DataFrame) -> DataFrame:
    """(pos, key=url, raw=entry JSON) of a twin-map document.

    Entries are those of ``byUrl`` when the root has it, else of the root
    object; any other root shape yields nothing.
    """
    docs = docs.withColumn("kind", _kind()).where(F.col("kind") == "{")
    root = F.from_json("value", "map<string,string>")
    inner = F.from_json(root["byUrl"], "map<string,string>")
    entries = F.coalesce(F.when(F.map_contains_key(root, "byUrl"), F.map_entries(inner))
                          .otherwise(F.map_entries(root)),
                         F.array().cast("array<struct<key:string,value:string>>"))
    return docs.select(F.posexplode(entries).alias("pos", "e")).select(
        F.col("pos").cast("bigint").alias("pos"), F.col("e.key").alias("key"), F.col("e.value").alias("raw"))


def read_twin_map(spark: SparkSession, path: str | None) -> DataFrame:
    docs = read_documents(spark, path)
    return empty_rows(spark) if docs is None else explode_twin_map(docs)


def twin_urls(rows: DataFrame) -> DataFrame:
    """Distinct twin URLs (keys matching ``indeed.``, any case) of landed twin-map rows."""
    return (rows.select(F.col("key").alias("url"))
                .where(F.col("url").rlike(TWIN_URL_RE)).distinct())
