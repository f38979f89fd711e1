"""Redacted samples of feeds in their own container shape."""

import json
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from offerlake.functions.text import redact_json
from offerlake.sources import feeds, sampling

EMAIL = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]+")
PHONE = re.compile(r"(?<!\w)(?:\+33|0)\s*\d(?:[\s.\-]?\d{2}){4}(?!\d)")


def scrub(x):
    if isinstance(x, str):
        return PHONE.sub("[tel]", EMAIL.sub("[email]", x))
    if isinstance(x, list):
        return [scrub(v) for v in x]
    return {k: scrub(v) for k, v in x.items()} if isinstance(x, dict) else x


RECORDS = [
    {"url": "https://x/1", "text": "write to\njo.doe+a@mail.example.fr\tnow", "n": 612345678, "none": None, "yes": True},
    {"nested": {"a@b.fr": ["06 12 34 56 78", {"deep": "tel:\\+33612345678 \"quoted\" c@d.org"}], "id": "a0612345678"}},
    {"text": "back\\slash at the end\\", "mail": "x@y.zz", "empty": "", "list": [], "obj": {}},
    {"text": "colon: \"k\": \"a@b.cc\" {\"in\": \"e@f.gg\"}", "élé": "漢字 06.12.34.56.78  "},
    "just a string p@q.rs", 5, None, [["m@n.op"]],
]


def test_redact_json_is_recursive(spark):
    for ascii_only in (True, False):
        raw = [json.dumps(x, ensure_ascii=ascii_only, indent=2 if ascii_only else None) for x in RECORDS]
        got = [r.v for r in spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, raw string").orderBy("i").select(redact_json(F.col("raw")).alias("v")).collect()]
        assert [json.loads(x) for x in got] == [scrub(x) for x in RECORDS]
        assert all(a == b for a, b, x in zip(got, raw, RECORDS) if scrub(x) == x)
    long = json.dumps({"t": "line\n\"quoted\" " * 20_000 + "a@b.cc"})
    assert json.loads(spark.createDataFrame([(long,)], "raw string").select(redact_json(F.col("raw"))).first()[0]) == scrub(json.loads(long))


@pytest.mark.parametrize("shape", ["array", "object", "twins"])
def test_sample_keeps_shape_and_order(spark, shape):
    records = [{"id": i, "mail": f"u{i}@x.fr"} for i in range(57)]
    keys = [f'k"{i}\\' for i in range(57)]
    whole = records if shape == "array" else dict(zip(keys, records))
    whole = {"byUrl": whole} if shape == "twins" else whole
    base = tempfile.mkdtemp()
    with open(f"{base}/feed.json", "w") as f:
        json.dump(whole, f)
    read = feeds.read_twin_map if shape == "twins" else feeds.read_feed
    sampling.write_sample(read(spark, f"{base}/feed.json"), 23, f"{base}/sample", shape, per_doc=23 if shape == "twins" else 5)
    got = sorted(read(spark, f"{base}/sample").collect())
    assert [r.pos for r in got] == list(range(23))
    assert [json.loads(r.raw) for r in got] == [scrub(x) for x in records[:23]]
    assert [r.key for r in got] == ([None] * 23 if shape == "array" else keys[:23])


def test_empty_sample_is_an_empty_document(spark):
    base = tempfile.mkdtemp()
    sampling.write_sample(feeds.empty_rows(spark), 10, f"{base}/sample", "object")
    assert feeds.read_feed(spark, f"{base}/sample").count() == 0
    with pytest.raises(ValueError):
        sampling.write_sample(feeds.empty_rows(spark), 10, f"{base}/other", "tuple")
