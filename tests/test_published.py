"""Versions and pointers: readers see whole, valid tables only."""

import os
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from offerlake.plans import job, silver
from offerlake.sources import bronze, feeds, published, sinks

HERE = os.path.dirname(os.path.abspath(__file__))
SOURCES = {"wttj": f"{HERE}/fixtures/feed_a.json", "indeed": f"{HERE}/fixtures/feed_b.json", "cross_site": f"{HERE}/fixtures/twins.json"}
RUN = "2026-06-10"


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="offerlake-published-")


def test_pointer(spark, root):
    assert published.current(spark, f"{root}/t") is None
    assert published.publish(spark, f"{root}/t", "v-é") == "v-é"
    assert published.publish(spark, f"{root}/t", "v-2") == "v-2"
    assert published.publish(spark, f"{root}/t", "v-3", exclusive=True) == "v-2"
    assert published.current(spark, f"file://{root}/t") == "v-2"
    assert [f for f in os.listdir(f"{root}/t") if not f.endswith(".crc")] == [published.POINTER]


def rows(df):
    return sorted(map(str, df.collect()))


def test_invalid_silver_is_not_published(spark, root, monkeypatch):
    layout = job.Layout(root)
    bronze.ingest(spark, layout.bronze, RUN, SOURCES)
    first = job.build_silver(spark, layout, RUN)
    offers, rejects = sinks.read_silver(spark, layout.silver, RUN), sinks.read_rejects(spark, layout.silver, RUN)
    before = rows(offers), rows(rejects)
    assert first == silver.stats(offers, rejects, RUN).first().asDict() and first["n_total"] == 9
    build = silver.build

    def broken(*args):
        good, bad = build(*args)
        return good.withColumn("source", F.when(F.col("offer_id") == "IND_1", "Other").otherwise(F.col("source"))), bad.limit(1)
    monkeypatch.setattr(silver, "build", broken)
    with pytest.raises(silver.InvalidRowsError, match="enum:source=1"):
        job.build_silver(spark, layout, RUN)
    assert (rows(sinks.read_silver(spark, layout.silver, RUN)), rows(sinks.read_rejects(spark, layout.silver, RUN))) == before
    monkeypatch.setattr(silver, "build", lambda *args: (build(*args)[0].where("source = 'WTTJ'"), build(*args)[1].limit(0)))
    assert job.build_silver(spark, layout, RUN)["n_total"] == 4                # published together
    assert sinks.read_silver(spark, layout.silver, RUN).count() == 4 and sinks.read_rejects(spark, layout.silver, RUN).count() == 0


def test_silver_is_counted_while_it_is_written(spark, root, monkeypatch):
    layout = job.Layout(root)
    bronze.ingest(spark, layout.bronze, RUN, SOURCES)
    for reader in ("read_silver", "read_rejects", "read_partition"):
        monkeypatch.setattr(sinks, reader, lambda *a: pytest.fail("silver was read again"))
    assert job.build_silver(spark, layout, RUN)["n_rejects_salaire"] == 3


def test_never_published_dates_are_empty(spark, root):
    assert sinks.read_silver(spark, f"{root}/silver", RUN).count() == 0 and sinks.read_rejects(spark, f"{root}/silver", RUN).count() == 0
    with pytest.raises(FileNotFoundError):
        sinks.gold_table(spark, f"{root}/gold", "mart_kpis")


def test_crash_during_export_keeps_the_old_version(spark, root):
    names = [f"mart_{i}" for i in range(14)]
    old = {n: spark.range(3).withColumn("name", F.lit(n)) for n in names}
    sinks.export(old, names, root)
    new = {n: spark.range(5).withColumn("name", F.lit(n)) for n in names}
    new[names[5]] = spark.range(1).select(F.raise_error(F.lit("crash")).alias("id"))
    with pytest.raises(Exception, match="crash"):
        sinks.export(new, names, root)
    assert [sinks.gold_table(spark, root, n).count() for n in names] == [3] * 14
    new[names[5]] = spark.range(5)
    sinks.export(new, names, root)
    assert [sinks.gold_table(spark, root, n).count() for n in names] == [5] * 14
    assert sinks.sync_to_object_store(new, names, f"{root}/store") == 14 and sinks.sync_to_object_store(new, names, None) == 0
    assert sinks.gold_table(spark, f"{root}/store", "mart_7").count() == 5


def test_two_landings_of_one_date(spark, root, monkeypatch):
    """Both write before either publishes; the rows of one of them are what everybody reads."""
    files = []
    for i in range(2):
        files.append(f"{root}/in{i}.json")
        with open(files[-1], "w") as f:
            f.write("[" + ",".join([f'{{"url":"u{i}"}}'] * (3 + i)) + "]")
    both, one, publish = threading.Barrier(2), threading.Lock(), published.publish

    def waiting(*args, **kwargs):
        both.wait(60)
        with one:                                         # a store renames atomically; a local disk does not
            return publish(*args, **kwargs)
    monkeypatch.setattr(published, "publish", waiting)
    threads = [threading.Thread(target=bronze.land, args=(spark, f"{root}/bronze", "wttj", f, RUN)) for f in files]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = [r.raw for r in bronze.read(spark, f"{root}/bronze", "wttj", RUN).collect()]
    assert got in (['{"url":"u0"}'] * 3, ['{"url":"u1"}'] * 4)


def test_first_present_candidate_is_landed(spark, root):
    assert feeds.resolve(spark, None) is None and feeds.resolve(spark, [None, "", f"{root}/no.json"]) is None
    assert feeds.resolve(spark, [None, f"{root}/no.json", SOURCES["indeed"], SOURCES["wttj"]]) == SOURCES["indeed"]
    got = bronze.land(spark, f"{root}/b", "wttj", [f"{root}/no.json", SOURCES["wttj"], SOURCES["indeed"]], RUN)
    assert got["present"] and got["origin"] == SOURCES["wttj"] and bronze.read(spark, f"{root}/b", "wttj", RUN).count() == 4
    assert not bronze.land(spark, f"{root}/b", "indeed", [f"{root}/no.json", None], RUN)["present"]


def test_crashed_landing_is_not_seen(spark, root):
    spark.range(3).selectExpr("id as pos", "'k' as key", "'{}' as raw").write.parquet(f"{root}/wttj/dt={RUN}/v-crashed")
    with pytest.raises(feeds.MalformedFeedError):
        bronze.read(spark, root, "wttj", RUN)
    bronze.land(spark, root, "wttj", SOURCES["wttj"], RUN)
    assert bronze.read(spark, root, "wttj", RUN).count() == 4
