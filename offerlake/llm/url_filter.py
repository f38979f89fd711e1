"""Allow and block rules on URLs by hashed host-suffix and path-prefix expressions.

Every distinct (host, path) is expanded into expressions: each host suffix at a label
boundary with each path prefix at which some rule could end.  Expressions and rules are
equi-joined on a short hash prefix; the full digests are compared, and the longest
matching rule decides (host and path together; on a tie the longer host, then block).

Host suffixes are limited to the labels of the longest rule host and path prefixes to the
lengths that rule paths have; both come from the rules, so nothing is lost and a URL of
any length expands into a bounded number of expressions.

Scale.  Pages that share host and path are judged once.  The rules are a table of any
size: Spark broadcasts or shuffles them by their own size, and a hot expression is
matched once per distinct URL.

Defined results.  A null URL, or one without "://", has an empty host and path and
matches no rule.  Repeated rules count once; a rule with a null part is ignored.  Rows
that repeat a page_id are judged one by one.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake.llm.spark import materialize

A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PREFIX_BITS = 32              # bits of the short hash that the join uses
RULES = (                     # (host, path, verdict)
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, A_Z, A_Z.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _hashed(df: DataFrame) -> DataFrame:
    """Digest of host and path (neither holds a space that the other could take over)."""
    df = df.withColumn("digest", F.sha2(F.concat(F.length("e_host").cast("string"), F.lit(":"), F.col("e_host"), F.col("e_path")), 256))
    return df.withColumn("prefix", F.conv(F.substring("digest", 1, PREFIX_BITS // 4), 16, 10).cast("bigint"))


def judge(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (host and path of the deciding rule, or null), verdict.

    ``rules`` has columns host, path, verdict.  A rule fits its host and all subdomains of
    it where the URL's path begins with the rule's path.
    """
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    pages = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rules = (rules.select(F.translate("host", A_Z, A_Z.lower()).alias("e_host"), F.col("path").alias("e_path"), F.col("verdict"))
                  .where("e_host is not null and e_path is not null and verdict is not null")
                  .groupBy("e_host", "e_path").agg(F.max("verdict").alias("verdict")))   # block over allow
    rules = materialize(_hashed(rules), "url-rules")
    labels, lengths = rules.agg(F.max(F.size(F.split("e_host", r"\."))), F.sort_array(F.collect_set(F.length("e_path")))).first()
    if not labels:
        return pages.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    urls = pages.where("host <> ''").select("host", "path").distinct()
    part = F.split("host", r"\.")
    urls = urls.withColumn("part", part)
    urls = urls.withColumn("keep", F.explode(F.sequence(F.lit(1), F.least(F.size("part"), F.lit(labels)))))
    urls = urls.withColumn("e_host", F.array_join(F.slice("part", -F.col("keep"), F.col("keep")), "."))
    cut = F.explode(F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path")))
    urls = urls.withColumn("cut", cut).withColumn("e_path", F.col("path").substr(F.lit(1), F.col("cut")))
    said = _hashed(urls).alias("u").join(rules.alias("r"), F.col("u.prefix") == F.col("r.prefix")).where("u.digest = r.digest")
    rank = F.struct((F.length("r.e_host") + F.length("r.e_path")).alias("size"), F.length("r.e_host").alias("host_size"), F.col("r.verdict").alias("verdict"),
                    F.concat("r.e_host", "r.e_path").alias("rule"))
    best = said.groupBy("u.host", "u.path").agg(F.max(rank).alias("best"))
    best = best.select(F.col("host").alias("__host"), F.col("path").alias("__path"), "best.rule", "best.verdict")
    return (pages.join(best, (F.col("host") == F.col("__host")) & (F.col("path") == F.col("__path")), "left")
                 .select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))
