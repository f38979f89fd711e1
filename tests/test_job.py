"""End to end on hand-written feeds: bronze -> silver -> gold -> checks -> export."""

import os
import tempfile

import pytest

from offerlake.plans import job
from offerlake.sources import bronze, sinks

HERE = os.path.dirname(os.path.abspath(__file__))
FIX = os.path.join(HERE, "fixtures")
SOURCES = {"wttj": f"{FIX}/feed_a.json", "indeed": f"{FIX}/feed_b.json", "cross_site": f"{FIX}/twins.json"}
RUN = "2026-06-10"


@pytest.fixture(scope="module")
def run(spark):
    root = tempfile.mkdtemp(prefix="offerlake-test-")
    stats = job.run_job(spark, root, RUN, SOURCES, exclude_tags=("fullonly",))
    return root, stats


def test_stats(run):
    _, s = run
    assert (s["n_total"], s["n_wttj"], s["n_indeed"], s["n_twins_indeed"]) == (9, 4, 5, 1)
    assert (s["n_salary"], s["pct_salary"], s["n_rejects_salaire"]) == (4, 44.4, 3)
    assert s["gold_ok"] and len(s["gold_exported"]) == 14
    assert s["present"] == {"wttj": True, "indeed": True, "cross_site": True}


def test_silver_rows(spark, run):
    root, _ = run
    rows = {r.offer_id: r for r in sinks.read_silver(spark, f"{root}/silver", RUN).collect()}
    assert sorted(rows) == ["IND_1", "IND_a1", "IND_c3", "IND_d4", "IND_e5",
                            "WTTJ_0", "WTTJ_1", "WTTJ_2", "WTTJ_3"]
    a0 = rows["WTTJ_0"]
    assert (a0.company, a0.departement, a0.is_idf, a0.profession, a0.remote) == ("acme", "75", True, "Data Engineer", "Partiel")
    assert (a0.sal_min_eur, a0.sal_max_eur, a0.has_salary, a0.apply_url) == (45000, 55000, True, None)
    assert (a0.posted_date, a0.date_is_precise, a0.skills) == ("2026-05-21", True, ["Python", "SQL"])
    a1 = rows["WTTJ_1"]
    assert (a1.contract, a1.remote, a1.profession) == ("Non précisé", "True", None)
    assert (a1.sal_min_eur, a1.sal_max_eur) == (38640, 44160)          # USD, monthly, swapped
    a3 = rows["WTTJ_3"]
    assert (a3.title, a3.city, a3.url, a3.company, a3.departement, a3.remote) == (None, None, None, None, "Non précisé", None)
    assert (a3.sal_min_eur, a3.has_salary) == (None, False)
    assert rows["WTTJ_2"].sal_source_period is None and rows["WTTJ_2"].skills == ["Power BI"]
    b1 = rows["IND_1"]
    assert (b1.city, b1.departement, b1.contract, b1.posted_date) == ("Nanterre (92)", "Hors référentiel", "Stage", RUN)
    assert rows["IND_a1"].is_twin and rows["IND_a1"].skills == ["Airflow", "dbt", "AWS"]
    c3 = rows["IND_c3"]
    assert (c3.sal_min_eur, c3.sal_max_eur, c3.sal_source_period, c3.posted_date, c3.remote) == \
        (21876, 21876, "monthly", "2026-05-11", "Non")
    assert rows["IND_e5"].city is None and rows["IND_e5"].departement == "Non précisé"


def test_rejects(spark, run):
    root, _ = run
    rej = {r.offer_id: r.reason for r in sinks.read_rejects(spark, f"{root}/silver", RUN).collect()}
    assert rej == {"IND_1": "non parsé", "IND_d4": "non parsé",
                   "IND_e5": "hors plage plausible après annualisation"}


def test_gold(spark, run):
    root, _ = run
    g = lambda n: sinks.gold_table(spark, f"{root}/gold", n)
    fct = g("fct_offres")
    assert fct.count() == 7 and len(fct.columns) == 33
    assert {(r.contrat, r.n) for r in g("mart_par_contrat").collect()} == {("CDI", 1), ("Non précisé", 5), ("Stage", 1)}
    k = g("mart_kpis").first()
    assert (k.n_offres, k.n_wttj, k.n_indeed, k.n_twins_dedup, k.n_salaire, k.pct_salaire) == (7, 3, 4, 1, 3, 42.9)
    comp = {r.champ: (r.rempli, r.total) for r in g("mart_completude").collect()}
    assert comp["Salaire"] == (3, 7) and comp["Date précise"] == (2, 7)
    assert {r.mois: r.n for r in g("mart_timeseries").collect()} == {"2026-04": 1, "2026-05": 1}
    lieu = {r.city: r.lieu_key for r in spark.read.parquet(f"{root}/warehouse/dim_lieu").collect()}
    assert list(lieu) == sorted(lieu) or sorted(lieu.values()) == list(range(1, len(lieu) + 1))
    assert sorted(lieu, key=lieu.get) == sorted(lieu)


def test_quality_gate_blocks_export(spark):
    root = tempfile.mkdtemp(prefix="offerlake-test-")
    s = job.run_job(spark, root, RUN, SOURCES)             # frozen full-corpus counts included
    assert not s["gold_ok"] and "assert_reference_counts" in s["failed_checks"]
    assert "gold_exported" not in s


def test_idempotent_and_immutable_bronze(spark, run):
    root, _ = run
    before = sorted(tuple(r) for r in sinks.read_silver(spark, f"{root}/silver", RUN).collect())
    other = dict(SOURCES, wttj=f"{FIX}/feed_b.json")        # a different file for the same date
    job.run_job(spark, root, RUN, other, exclude_tags=("fullonly",))
    after = sorted(tuple(r) for r in sinks.read_silver(spark, f"{root}/silver", RUN).collect())
    assert before == after                                    # bronze for that date was not overwritten
    assert bronze.read(spark, f"{root}/bronze", "wttj", RUN).count() == 4


def test_missing_source(spark):
    root = tempfile.mkdtemp(prefix="offerlake-test-")
    s = job.run_job(spark, root, RUN, dict(SOURCES, indeed=f"{FIX}/nope.json"), skip_gold=True)
    assert s["present"]["indeed"] is False and (s["n_total"], s["n_indeed"]) == (4, 0)


def test_read_layer(spark, run):
    from offerlake.operators import search
    root, s = run
    search.register_gold(spark, f"{root}/gold", s["gold_exported"])
    marts = search.list_marts(spark)
    assert len(marts) == 13 and marts == sorted(marts)
    assert search.read_registered_mart(spark, "mart_kpis").first().n_offres == 7
    with pytest.raises(KeyError):
        search.read_registered_mart(spark, "fct_offres; DROP")
    page = search.search_offers(spark.table("fct_offres"), departement="75", limit=5).collect()
    assert [r.source for r in page] == ["WTTJ"]
    q = search.query(spark, "SELECT count(*) AS n FROM {f} WHERE has_salary = :h",
                     {"h": True}, f=spark.table("fct_offres"))
    assert q.first().n == 3
    with pytest.raises(ValueError):
        search.search_offers(spark.table("fct_offres"), limit=501)


def test_empty_rejects_and_manifest(spark):
    root = tempfile.mkdtemp(prefix="offerlake-test-")
    s = job.run_job(spark, root, RUN, dict(SOURCES, indeed=None), skip_gold=True)
    assert s["n_rejects_salaire"] == 0
    rej = sinks.read_rejects(spark, f"{root}/silver", RUN)
    assert rej.columns == ["offer_id", "salary_raw", "reason", "run_date"] and rej.count() == 0
    m = bronze.read_manifest(spark, f"{root}/bronze")
    assert m["run_date"] == RUN and [x["present"] for x in m["sources"]] == [True, False, True]


def test_repeated_key_in_keyed_feed(spark, tmp_path):
    from offerlake.sources import feeds
    doc = tmp_path / "b.json"
    doc.write_text('{"a": {"jk": "a", "title": "one"}, "b": {"jk": "b"}, "a": {"jk": "a", "title": "two"}}')
    rows = feeds.read_feed(spark, str(doc)).orderBy("pos").collect()
    assert [(r.pos, r.key) for r in rows] == [(0, "a"), (1, "b")] and '"two"' in rows[0].raw
