"""Documents cut by byte ranges give the rows that whole documents give."""

import contextlib
import json
import os
import random
import tempfile

import pytest

from offerlake.session import materialize
from offerlake.sources import documents, feeds


def write(text, name="f.json", folder=None):
    path = os.path.join(folder or tempfile.mkdtemp(prefix="offerlake-docs-"), name)
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())
    return path


def whole(spark, path):
    return sorted(tuple(r) for r in feeds.explode_records(feeds.read_documents(spark, path)).collect())


@contextlib.contextmanager
def ranges_of(spark, size):
    """Documents are read in ranges of ``size`` bytes, other tables as usual."""
    read, keys = documents.fragments, ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")

    def fragments(spark, path):
        old = [spark.conf.get(k) for k in keys]
        for k, v in zip(keys, (str(size), "0")):
            spark.conf.set(k, v)
        try:
            return materialize(read(spark, path), "test-fragments")
        finally:
            for k, v in zip(keys, old):
                spark.conf.set(k, v)
    documents.fragments = fragments
    try:
        yield
    finally:
        documents.fragments = read


def cut(spark, path, size=None):
    with ranges_of(spark, size) if size else contextlib.nullcontext():
        return sorted(tuple(r) for r in feeds.read_feed(spark, path).collect())


ARRAY = r'[{"a":"}{\"]"} ,{"é":[{},{"x":"\\"}]},[1,{"b":2}], "s}",3]'
OBJECT = '{"k":{"a":"}\\\\"},"}":5,"l":{"é":{"x":"\\"{"}},"k":{"a":2}}'


@pytest.mark.parametrize("text,sizes", [(ARRAY, (1, 7)), (OBJECT, (1, 5))])
def test_cuts_at_every_byte(spark, text, sizes):
    path = write(text)
    want = whole(spark, path)
    assert len(want) == (5 if text[0] == "[" else 3)
    for size in sizes:
        assert cut(spark, path, size) == want, size


SOUND = ["[]", "{}", " \n[ ]\n", "[1,2]", '"a}b"', "5", "true", '{"a":{}}\n', "[[{}]]", '["}",{}]', '{"x":[{"y":1}]}', '[{"a":"\\\\"}, {"b":"\\""}]']
UNSOUND = ['[{"a":1}', '{"k":{"a":1}', '{"k":{"a":1', '{"k":1', '[{"a":1},]', '[{"a":1}{"b":2}]', '[,{"a":1}]', '[{"a":1} x]', '[{"a":1}] {"b":2}', '{"a":{}} {"b":{}}',
           '[{"a":"}]', '[{"a":1}}', "]", "}", "   ", '[{"a":1},{"b":}]', '{"a":{},}', "nonsense"]


def test_small_documents(spark):
    folder = tempfile.mkdtemp(prefix="offerlake-docs-")
    for i, text in enumerate(SOUND):
        write(text, f"f{i:02}.json", folder)
    want = whole(spark, folder)
    assert cut(spark, folder, 2) == want and cut(spark, folder) == want
    assert cut(spark, write(b'\xef\xbb\xbf[{"a":1}]')) == [(0, None, '{"a":1}')]


@pytest.mark.parametrize("size", [None, 3])
def test_unsound_documents_are_found(spark, size):
    folder = tempfile.mkdtemp(prefix="offerlake-docs-")
    for i, text in enumerate(UNSOUND):
        write(text, f"f{i:02}.json", folder)
    with ranges_of(spark, size) if size else contextlib.nullcontext():
        bad = documents.judged(spark, folder).where("not good").select("file").distinct().collect()
    assert len(bad) == len(UNSOUND)
    with pytest.raises(Exception, match="not valid JSON"):
        cut(spark, folder)


def test_random_documents(spark):
    rng = random.Random(8)

    def value(depth):
        kind = rng.random()
        if depth and kind < .35:
            return {rng.choice(['k', '"', '}', '\\', 'é{', f'n{rng.random()}']): value(depth - 1) for _ in range(rng.randrange(4))}
        if depth and kind < .55:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return rng.choice([None, True, 1.5, "", "}", '"', "\\", "a\nb", "[{", "é]", "x" * 60])

    folder = tempfile.mkdtemp(prefix="offerlake-docs-")
    for i in range(12):
        root = [value(4) for _ in range(8)] if i % 2 else {f"r{k}": value(4) for k in range(8)}
        write(json.dumps(root, ensure_ascii=bool(i % 3), indent=i % 4 or None), f"f{i:02}.json", folder)
    want = whole(spark, folder)
    assert cut(spark, folder, 50) == want and cut(spark, folder) == want and len(want) == 96


def test_one_document_is_read_by_many_tasks(spark):
    record = '{"name":"' + "x" * 900 + '","tags":[{"t":"}"}]}'
    path = write("[" + ",".join([record] * 20_000) + "]")                 # 19 MB in one line
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        assert documents.fragments(spark, path).rdd.getNumPartitions() >= 15
        got = feeds.read_feed(spark, path)
        assert got.count() == 20_000 and got.selectExpr("min(pos)", "max(pos)", "count(distinct raw)").first() == (0, 19_999, 1)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_windows_over_ranges_keep_their_tasks(spark, monkeypatch):
    """The table of fragments is small in bytes but long: it is dealt by range, never broadcast."""
    plans, real = {}, documents.materialize

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(documents, "materialize", seen)
    documents.chunks(spark, write(json.dumps([{"a": i, "p": {"q": "}"}} for i in range(50)]))).collect()
    assert "RepartitionByExpression" in plans["json-steps"]
    assert "rightHint=(strategy=broadcast)" in plans["json-steps"]
    assert "rightHint=(strategy=broadcast)" in plans["json-ends"]


def test_change_of_depth_by_string_state(spark):
    """Both string states from one removal of strings, against a walk over the characters."""
    texts = ['', '{"a":[1,"x', '\\"]" : [{', 'a]"{"[[', '"', '\\\\"{', ' \t[', '"a\\"[" ]]', '\u00e9[{"\u4e2d']
    frags = spark.createDataFrame([("f", 0, i, 0, t) for i, t in enumerate(texts)], "file string, block bigint, seq bigint, size bigint, text string")
    got = {r.seq: (r.turn, r.d0, r.d1, r.head) for r in documents._transitions(frags).collect()}
    for i, t in enumerate(texts):
        depth = []
        for state in (0, 1):
            inside, d, skip = bool(state), 0, False
            for c in t:
                if skip:
                    skip = False
                elif c == "\\":
                    skip = True
                elif c == '"':
                    inside = not inside
                elif not inside:
                    d += (c in "[{") - (c == "]")
            depth.append(d)
        turn = inside is False                        # the walk that began inside ends outside
        assert got[i] == (int(turn), *depth, t.lstrip(" \t\r\n")[:1]), t
