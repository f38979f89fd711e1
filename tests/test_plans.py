"""Plan shape: no cartesian products or nested-loop joins; scans prune and push down."""

import contextlib
import io
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="shared test tables not present")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_no_cross_products(spark):
    from offerlake.plans import catalog, lake
    offenders = []
    for name, fn in {**catalog.QUERIES, **lake.QUERIES}.items():
        if name == "offer_star_build":
            continue
        p = plan(fn(spark, SF))
        if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p:
            offenders.append(name)
    assert offenders == []


def test_scan_pushdown_and_pruning(spark):
    from offerlake.plans import catalog
    p = plan(catalog.parquet_scan(spark, SF))
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_quantity), GreaterThanOrEqual(l_shipdate" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in p
    p = plan(catalog.count_by_key(spark, SF))
    assert "ReadSchema: struct<c_mktsegment:string>" in p


def test_silver_read_prunes_partition(spark, tmp_path):
    from offerlake.schemas import SILVER
    from offerlake.sources import sinks
    empty = spark.createDataFrame([], SILVER)
    for d in ("2026-06-09", "2026-06-10"):
        sinks.write_partition(empty, str(tmp_path / "offres"), d)
    p = plan(sinks.read_partition(spark, str(tmp_path / "offres"), "2026-06-10"))
    assert "PartitionFilters: [isnotnull(run_date" in p and "2026-06-10" in p
