"""The pipeline's stages against plain Python, and the SQL of OP1 and OP5 on small fixtures."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from offerlake.llm import minhash_dedup, mixing, pieces, toxicity, url_filter
from offerlake.llm.sql import OP1, OP5

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(a, b):
    return " ".join(f"w{i}" for i in range(a, b))


BASE, CLEAN, OTHER = words(0, 60), words(100, 140), words(200, 230)
#: null and repeated ids, repeated rows, several near copies under one id, nothing at all
ROWS = [(1, BASE), (None, BASE), (None, CLEAN), (2, BASE + " x"), (2, OTHER), (1, BASE), (1, BASE + " y"), (3, None), (3, ""), (None, words(300, 330) + " z"),
        (None, words(300, 330)), (4, words(400, 440)), (4, words(400, 440))]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "ab"[k % 2], len(t or "")) for k, (i, t) in enumerate(rows)], SCHEMA)


def pairs(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def plain_near(rows, size=5):
    """Groups of near-duplicate rows, and the rows that are linked with none."""
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                part = [part[j] if p == part[i] else p for p in part]
    groups = [[rows[k] for k in range(len(rows)) if part[k] == p] for p in sorted(set(part))]
    return [g for g in groups if len(g) > 1], [g[0] for g in groups if len(g) == 1]


def test_near_duplicates_keep_one_row_of_each_group(spark):
    out = corpus_pipeline.near_duplicates(spark, frame(spark, ROWS), "")
    got = pairs(out)
    groups, single = plain_near(ROWS)
    for members in groups:                       # one row of a group, with its smallest id
        kept = [m for m in set(members) if got[m]]
        least = min((i is None, i or 0) for i, _ in members)
        assert len(kept) == 1 and got[kept[0]] == 1 and (kept[0][0] is None, kept[0][0] or 0) == least
    assert all(got[r] == n for r, n in Counter(single).items())
    assert sum(got.values()) == len(groups) + len(single) and len(groups) == 3
    assert out.columns == frame(spark, ROWS).columns
    assert corpus_pipeline.near_duplicates(spark, frame(spark, ROWS).limit(0), "").count() == 0


def test_toxicity_filter_judges_rows_by_text(spark):
    rows = [(i, f"w{i} w{i + 1} zonk blarg" if i % 3 == 0 else f"w{i} w{i + 1} w{i + 2}") for i in range(120)]
    rows += [(500, "zonk blarg zonk"), (500, "w1 w2"), (None, "zonk blarg zonk"), (None, "w1 w2"), (501, None), (502, ""), (503, "w1"), (503, "w1")]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(120)], "doc_id bigint, quality int, toxic int")
    field = toxicity.train(docs, labels)
    want = Counter()
    for k, r in enumerate(toxicity.score(frame(spark, rows).withColumn("doc_id", F.monotonically_increasing_id()).coalesce(1), field).collect()):
        want[rows[k]] += not r.predicted
    assert want[(500, "zonk blarg zonk")] == want[(None, "zonk blarg zonk")] == 0 < want[(None, "w1 w2")]
    path = spark.conf.get("spark.checkpoint.dir") + "/toxic-stage"
    labels.write.mode("overwrite").parquet(f"{path}/labels.parquet")
    out = corpus_pipeline.toxicity_filter(spark, docs, path)
    assert pairs(out) == +want and out.columns == docs.columns


def test_line_dedup_stage_keeps_rows_and_columns(spark):
    line = "a line of some length that comes back"
    rows = [(1, f"{line}\nfirst"), (2, f"second\n{line}"), (None, line), (3, None), (3, "")]
    docs = frame(spark, rows).withColumn("row", F.lit(7)).withColumn("gone", F.lit("x"))
    out = corpus_pipeline.line_dedup(spark, docs, "")
    assert pairs(out) == Counter([rows[0], (2, "second"), (None, ""), (3, None), (3, "")])
    assert out.columns == docs.columns and out.where("row <> 7 or gone <> 'x'").count() == 0
    assert all((r.n_chars or 0) == len(r.text or "") for r in out.collect())


def test_mix_stage_takes_whole_passes(spark):
    rows = [(i, words(0, 10)) for i in range(8)] + [(None, words(0, 10)), (9, None)]
    out = corpus_pipeline.mix_sources(spark, frame(spark, rows), "")
    assert 0 < out.count() <= 3 * 9 and set(pairs(out)) <= set(rows[:-1]) and out.columns == frame(spark, rows).columns


def test_stages_keep_columns_with_clashing_names(spark):
    rows = [(i, words(10 * i, 10 * i + 12)) for i in range(6)] + [(None, None), (3, words(30, 42))]
    names = ("times", "__row", "__text", "row", "number", "passes", "pass", "taken", "t_id", "h", "gone", "label")
    docs = frame(spark, rows)
    for k, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(k))
    path = spark.conf.get("spark.checkpoint.dir") + "/clash-stage"
    spark.createDataFrame([(i, 1, i % 2) for i in range(6)], "doc_id bigint, quality int, toxic int").write.mode("overwrite").parquet(f"{path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got and all(r[n] == k for r in got for k, n in enumerate(names)), name


def test_mix_stage_comes_near_its_targets(spark):
    rng = random.Random(6)
    rows = [(i, words(0, rng.choice((3, 40, 200))), f"s{i % 3}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    want = {r.source: r.target for r in mixing.taken(docs).select("source", "target").distinct().collect()}
    got = Counter()
    for r in corpus_pipeline.mix_sources(spark, docs, "").collect():
        got[r.source] += len(r.text.split())
    for source, target in want.items():
        longest = max(len(t.split()) for _, t, s in rows if s == source)
        assert abs(got[source] - target) <= longest / 2 + 1


def test_run(spark):
    """Every stage takes effect, and what is left is encoded without loss."""
    path = spark.conf.get("spark.checkpoint.dir") + "/pipeline-run"
    line = "one line of boilerplate that many documents share"
    good = [(i, words(40 * i, 40 * i + 30) + "\n" + line, "en", f"s{i % 2}") for i in range(40)]
    bad = [(100 + i, words(40 * i, 40 * i + 30) + " zonk blarg zonk blarg", "en", "s0") for i in range(40)]
    copies = [(200 + i, good[i][1] + " x", "en", "s1") for i in range(10)]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in good + bad + copies] + [(None, None, None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.mode("overwrite").parquet(f"{path}/documents.parquet")
    labels = [(r[0], 1, 0) for r in good] + [(r[0], 1, 1) for r in bad]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.mode("overwrite").parquet(f"{path}/labels.parquet")
    out = corpus_pipeline.run(spark, path)
    back = Counter((r.doc_id, r.text) for r in pieces.decode(out).collect())
    assert all(r.round_trip for r in out.collect())
    ids = {i for i, _ in back}
    assert ids <= {r[0] for r in good + copies} and len(ids & {r[0] for r in good}) >= 30           # no toxic document is left
    assert sum(line in t for _, t in back) <= max(back.values())                                     # the line stays once
    assert not any(i in ids and i + 200 in ids for i in range(10))                                   # of near copies one


def test_sql_of_op1_and_op5(spark):
    duckdb = pytest.importorskip("duckdb")
    texts = [BASE, BASE + " x", BASE.upper(), OTHER, OTHER[:-2], "one", "One", "", None, "a b"]
    urls = ["http://www.EXAMPLE.com/en/1?x", "https://m.example.com/en/25#top", None, "no scheme.com/en/", "http://x.net/es/", "http://net/fr/z", "http://notexample.com/en/", ""]
    docs, pages = frame(spark, list(enumerate(texts))), spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)"), con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts))), con.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(urls)))
    for sql, df in ((OP1, minhash_dedup.near_duplicates(docs, shingle=2)), (OP5, url_filter.judge(pages, rules))):
        res = con.execute(sql)
        names = [d[0] for d in res.description]
        assert Counter(map(tuple, res.fetchall())) == Counter(map(tuple, df.select(names).collect())) and set(names) == set(df.columns)
