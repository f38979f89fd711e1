"""What steps leave on disk, compressed documents in one piece, numbering without moving records."""

import gzip
import json
import os
import random

import pytest

from offerlake.operators import similarity
from offerlake.plans import derived_feeds, job
from offerlake.session import ensure_checkpoint_dir, materialize, passing_scratch
from offerlake.sources import bronze, documents, feeds


def scratch(spark):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {x for x in os.listdir(base) if not x.startswith(".")}


def write(folder, name, text):
    with (gzip.open if name.endswith(".gz") else open)(os.path.join(folder, name), "wb") as f:
        f.write(text.encode())


def rows(spark, path):
    return sorted(tuple(r) for r in feeds.read_feed(spark, str(path)).collect())


def test_passing_scratch_is_deleted(spark, tmp_path):
    before, key = scratch(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    conf = spark.conf.get(key)
    with pytest.raises(ValueError), passing_scratch(spark):
        assert materialize(spark.range(5), "passing").count() == 5
        assert scratch(spark) - before and spark.conf.get(key) == "true"
        raise ValueError
    assert scratch(spark) == before and spark.conf.get(key) == conf
    kept = materialize(spark.range(5), "kept")
    assert len(scratch(spark) - before) == 1 and kept.count() == 5


def test_landing_and_silver_leave_no_scratch(spark, tmp_path):
    write(tmp_path, "a.json", json.dumps([{"url": "https://x/fr/companies/c/jobs/1", "name": "Data", "status": 200}]))
    write(tmp_path, "b.json", json.dumps({"k": {"jk": "k", "url": "https://fr.indeed.com/1", "title": "Data", "salary": "?"}}))
    layout, before = job.Layout(str(tmp_path / "lake")), scratch(spark)
    bronze.ingest(spark, layout.bronze, "2026-06-10", {"wttj": str(tmp_path / "a.json"), "indeed": str(tmp_path / "b.json")})
    stats = job.build_silver(spark, layout, "2026-06-10")
    assert (stats["n_total"], stats["n_rejects_salaire"]) == (2, 1)
    assert scratch(spark) == before


def test_feeds_are_written_compressed(spark, tmp_path):
    records = spark.createDataFrame([(i, f"d{i}", json.dumps({"n": i})) for i in range(50)], "key bigint, id string, json string")
    derived_feeds._write_documents(records, "key", str(tmp_path / "feed"), keyed=True, per_doc=20)
    names = [f for _, _, fs in os.walk(tmp_path / "feed") for f in fs if not f.startswith((".", "_"))]
    assert len(names) == 3 and all(f.endswith(".gz") for f in names)
    assert [(p, k) for p, k, _ in rows(spark, tmp_path / "feed")] == [(i, f"d{i}") for i in range(50)]


def test_small_compressed_documents_are_not_cut(spark, tmp_path, monkeypatch):
    write(tmp_path, "a.json.gz", '[{"a":{"x":"}"}}, 5 ]')
    write(tmp_path, "b c%20é.json.gz", '{"k":{"a":1}}')

    def fragments(*_):
        raise AssertionError("a small document was cut")

    with monkeypatch.context() as m:
        m.setattr(documents, "fragments", fragments)
        assert rows(spark, tmp_path) == [(0, None, '{"a":{"x":"}"}}'), (1, None, "5"), (2, "k", '{"a":1}')]
    # A small file may hold a long text: that one is cut.
    write(tmp_path, "c.json.gz", "[" + ",".join(['{"n":1}'] * 2000) + "]")
    monkeypatch.setattr(documents, "WHOLE", 1000)
    assert os.path.getsize(tmp_path / "c.json.gz") < 1000
    assert [os.path.basename(f) for f in documents.long_texts(spark, str(tmp_path))] == ["c.json.gz"]
    assert [r[0] for r in rows(spark, tmp_path)] == list(range(2003))
    write(tmp_path, "d.json.gz", '[{"a":1}')
    with pytest.raises(Exception, match="not valid JSON"):
        rows(spark, tmp_path)


def test_numbers_with_repeated_keys(spark, tmp_path, monkeypatch):
    rnd, want = random.Random(5), []
    for f in range(4):
        pairs = [(f"k{rnd.randrange(60)}", {"n": i}) for i in range(80 if f != 2 else 0)]
        write(tmp_path, f"f{f}.json", "{" + ",".join(f'"{k}":{json.dumps(v)}' for k, v in pairs) + "}")
        want += [(k, v) for k, v in dict(pairs).items()]
    write(tmp_path, "f9.json", "[" + ",".join(f'{{"a":{i}}}' for i in range(30)) + "]")
    want += [(None, {"a": i}) for i in range(30)]
    want = [(i, k, v) for i, (k, v) in enumerate(want)]
    for whole in (documents.WHOLE, 0):           # in one piece, and cut into chunks
        monkeypatch.setattr(documents, "WHOLE", whole)
        assert [(p, k, json.loads(v)) for p, k, v in rows(spark, tmp_path)] == want


def test_records_are_not_shuffled_to_be_numbered(spark, tmp_path):
    write(tmp_path, "f.json", "{" + ",".join(f'"k{i}":{{"n":{i}}}' for i in range(200)) + "}")
    plan = feeds.read_feed(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "rangepartitioning" not in plan


def test_twins_by_parts_and_without_scratch(spark, monkeypatch):
    rnd = random.Random(3)
    texts = []
    for i in range(40):                                        # large sets of a small vocabulary, some with near copies
        words = rnd.sample(range(3000), 1100 + 20 * i)
        texts.append(words)
        if i % 4 == 0:
            texts.append(words[:-250] + rnd.sample(range(3000, 5000), 250))
        if i % 4 == 1:
            texts.append(words[:-300] + rnd.sample(range(3000, 5000), 300))
    rows = [(i, " ".join(f"w{w}x" for w in t), f"c{i // 2}", f"l{i % 3}") for i, t in enumerate(texts)]

    def twin(a, b):
        x, y = set(a[1].split()), set(b[1].split())
        j = len(x & y) / len(x | y)
        return j >= 0.85 or j >= 0.6 and (a[2] == b[2] or a[3] == b[3])

    want = {a[0] for a in rows if any(a is not b and twin(a, b) for b in rows)}
    df = spark.createDataFrame(rows, "id int, title string, company string, city string")
    whole, parts, pairs = similarity._by_parts, [], {}

    def by_parts(found, weight, room, check, name):
        out = whole(found, weight, 8_000, check, name)
        pairs.setdefault(name, []).append((found.count(), out.count()))
        return out

    def counted(df, name, *more):
        parts.append(name)
        return materialize(df, name, *more)

    monkeypatch.setattr(similarity, "_by_parts", by_parts)
    monkeypatch.setattr(similarity, "materialize", counted)
    before = scratch(spark)
    got = similarity.find_twins(df, df, id_col="id", exclude_self=True)
    assert {r.id for r in got.collect()} == want and 0 < len(want) < len(rows)
    assert len(scratch(spark) - before) == 1                   # the result only
    if pairs:
        assert parts.count("twins-similar") > len(pairs["twins-similar"])


def test_fine_bitmaps_never_lose_a_pair(spark):
    rnd, rows = random.Random(8), []
    for i, n in enumerate((1, 2, 15, 16, 17, 100, 255, 257, 900, 1500)):
        x = [rnd.getrandbits(62) for _ in range(n)]
        for k, cut in enumerate((0, n // 5, n // 4, n // 2)):
            y = x[cut:] + [rnd.getrandbits(62) for _ in range(0 if k % 2 else cut)]
            rows += [(1000 * i + k, x), (1000 * i + k + 500, y)]
    sets = spark.createDataFrame(rows, "set_id bigint, hashes array<bigint>")
    fine = {r.set_id: r.fine for r in similarity._fine_bitmaps(sets).collect()}
    assert all(len(fine[i]) * 16 >= len(h) and len(fine[i]) & (len(fine[i]) - 1) == 0 for i, h in rows)
    held = dict(rows)
    ids = [(a, b) for a in held for b in held if a != b and len(fine[a]) <= 2 * len(fine[b]) and len(fine[b]) <= 2 * len(fine[a])]
    pairs = spark.createDataFrame([(a, b, len(held[a]), len(held[b]), fine[a], fine[b]) for a, b in ids],
                                  "a bigint, b bigint, size int, y_size int, x_fine array<bigint>, y_fine array<bigint>")
    kept = {(r.a, r.b) for r in pairs.where(similarity._fine_allow(3, 5)).collect()}
    similar = {(a, b) for a, b in ids if 5 * len(set(held[a]) & set(held[b])) >= 3 * len(set(held[a]) | set(held[b]))}
    assert similar <= kept and len(kept) < len(ids) / 2
