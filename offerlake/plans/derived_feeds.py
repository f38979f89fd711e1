"""Feed documents derived from the shared test tables.

Turns table rows into the two raw feed shapes (JSON arrays of records and
JSON objects keyed by id, compressed) plus a twin map, so the whole job can run on
data whose size grows with the tables.  Records are packed into documents
of bounded size by key range: each document is built by one task from at
most ``RECORDS_PER_DOC`` records, never from a whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.plans.catalog import NATION_CITIES, tbl
from offerlake.session import passing_scratch

RECORDS_PER_DOC = 20_000
TITLE_SKILLS = ("", " Python", " SQL et Python", " Power BI", " Spark, AWS")   # ends of feed A's titles


def _write_documents(records: DataFrame, key: str, path: str, keyed: bool,
                     per_doc: int = RECORDS_PER_DOC) -> None:
    """Pack (key, json) records into one JSON document per key range and
    write each document as its own file under ``path/doc=<n>/``."""
    doc = F.floor(F.col(key) / per_doc).cast("bigint").alias("doc")
    packed = records.select(doc, F.struct(F.col(key).alias("k"), F.col("id"), F.col("json")).alias("r"))
    grouped = packed.groupBy("doc").agg(F.sort_array(F.collect_list("r")).alias("rs"))    # a document's only row: written as one file
    if keyed:
        body = F.concat(F.lit("{"), F.array_join(F.transform(
            "rs", lambda r: F.concat(F.lit('"'), r["id"], F.lit('":'), r["json"])), ","), F.lit("}"))
    else:
        body = F.concat(F.lit("["), F.array_join(F.transform("rs", lambda r: r["json"]), ","), F.lit("]"))
    with passing_scratch(records.sparkSession):
        (grouped.select("doc", body.alias("value"))
                .write.mode("overwrite").option("compression", "gzip").partitionBy("doc").text(path))


def feed_a_records(spark: SparkSession, sf: str) -> DataFrame:
    o = tbl(spark, sf, "orders")
    c = tbl(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    cities = spark.createDataFrame(list(enumerate(NATION_CITIES)), "nk int, city string")
    j = j.join(F.broadcast(cities), F.col("c_nationkey") == F.col("nk"), "left")
    company = F.lower(F.regexp_replace(F.coalesce(F.col("c_name"), F.lit("")), r"[^A-Za-z0-9]+", "-"))
    pr = F.col("o_orderpriority")
    per = (F.when(pr == "1-URGENT", "yearly").when(pr == "2-HIGH", "monthly")
            .when(pr == "3-MEDIUM", "daily").otherwise(F.lit(None)))
    div = F.when(pr == "1-URGENT", 5).when(pr == "2-HIGH", 60).otherwise(1000)
    amount = F.floor(F.col("o_totalprice") / div).cast("bigint")
    rec = F.struct(
        F.concat(F.lit("https://jobs.example/fr/companies/"), company, F.lit("/jobs/"),
                 F.col("o_orderkey").cast("string")).alias("url"),
        F.concat(F.lit("Data "), F.lower(F.col("c_mktsegment")), F.lit(" "), F.col("o_orderpriority"),
                 F.element_at(F.array(*[F.lit(w) for w in TITLE_SKILLS]), (F.col("o_orderkey") % len(TITLE_SKILLS) + 1).cast("int")))
         .alias("name"),
        F.when(F.col("o_orderkey") % 3 == 0, "bac_5").when(F.col("o_orderkey") % 3 == 1, "  ").alias("edu"),
        F.col("city"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(
            F.concat((F.col("o_orderkey") % 11).cast("string"), F.lit("_to_"),
                     (F.col("o_orderkey") % 11 + 2).cast("string"), F.lit("_years"))).alias("exp"),
        F.when(F.col("o_orderstatus") == "F", "CDI").when(F.col("o_orderstatus") == "O", "Stage")
         .otherwise(F.lit("")).alias("contract"),
        F.when(F.col("o_orderkey") % 4 == 0, "partial").when(F.col("o_orderkey") % 4 == 1, "full")
         .otherwise(F.lit(None)).alias("remote"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        F.struct(F.col("c_mktsegment").alias("fr")).alias("profession"),
        amount.cast("string").alias("salMin"),
        (amount * 5 / 4).cast("bigint").cast("string").alias("salMax"),
        per.alias("salPer"),
        F.lit("EUR").alias("salCur"),
        F.when(F.col("o_orderpriority") == "5-LOW", 404).otherwise(200).alias("status"),
    )
    return j.select(F.col("o_orderkey").alias("key"), F.col("o_orderkey").cast("string").alias("id"),
                    F.to_json(rec).alias("json"))


def feed_b_records(spark: SparkSession, sf: str) -> DataFrame:
    d = tbl(spark, sf, "documents")
    nk = F.col("doc_id") % len(NATION_CITIES)
    cities = spark.createDataFrame(list(enumerate(NATION_CITIES)), "nk int, city string")
    d = d.join(F.broadcast(cities), nk == F.col("nk"), "left")
    amount = (F.col("n_chars") * 10).cast("bigint")
    rec = F.struct(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("jk"),
        F.concat(F.lit("Data "), F.col("lang"), F.lit(" "), F.col("source")).alias("title"),
        F.col("source").alias("company"),
        F.col("city"),
        F.array(F.when(F.col("lang") == "fr", "Stage").otherwise("CDI")).alias("jobTypes"),
        F.concat(F.lit("De "), amount.cast("string"), F.lit(" € à "), (amount * 2).cast("string"),
                 F.lit(" € par an")).alias("salary"),
        F.concat(F.lit("il y a "), (F.col("doc_id") % 31).cast("string"), F.lit(" jours")).alias("date"),
        F.col("text").alias("snippet"),
        F.concat(F.lit("https://fr.indeed.com/doc/"), F.col("doc_id").cast("string")).alias("url"),
    )
    return d.select(F.col("doc_id").alias("key"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
                    F.to_json(rec).alias("json"))


def twin_map_records(spark: SparkSession, sf: str) -> DataFrame:
    lab = tbl(spark, sf, "labels").where(F.col("toxic") == 1)
    url = F.concat(F.lit("https://fr.indeed.com/doc/"), F.col("doc_id").cast("string"))
    val = F.to_json(F.struct(F.lit("wttj").alias("otherSite"), F.lit(1.0).alias("sim")))
    return lab.select(F.col("doc_id").alias("key"), url.alias("id"), val.alias("json"))


def write_feeds(spark: SparkSession, sf: str, base: str) -> dict[str, str]:
    """Write the three feeds under ``base``; returns the source paths."""
    paths = {"wttj": f"{base}/feed_a", "indeed": f"{base}/feed_b", "cross_site": f"{base}/twins"}
    _write_documents(feed_a_records(spark, sf), "key", paths["wttj"], keyed=False)
    # Feed B records carry whole document texts: fewer records per file.
    _write_documents(feed_b_records(spark, sf), "key", paths["indeed"], keyed=True, per_doc=2_000)
    # The twin map is one object {"byUrl": {...}}: packed as keyed documents
    # whose entries are the URLs (each document holds at most RECORDS_PER_DOC).
    tw = twin_map_records(spark, sf)
    doc = F.floor(F.col("key") / RECORDS_PER_DOC).cast("bigint").alias("doc")
    inner = F.concat(F.lit("{"), F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("key", "id", "json"))),
        lambda r: F.concat(F.lit('"'), r["id"], F.lit('":'), r["json"])), ","), F.lit("}"))
    (tw.groupBy(doc).agg(F.concat(F.lit('{"byUrl":'), inner, F.lit("}")).alias("value"))
       .repartition("doc").write.mode("overwrite").partitionBy("doc").text(paths["cross_site"]))
    return paths
