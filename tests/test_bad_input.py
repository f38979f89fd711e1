"""Bad input stops the job instead of becoming missing data."""

import os
import tempfile

import pytest

from offerlake.plans import silver
from offerlake.schemas import BRONZE_ROWS
from offerlake.sources import bronze, feeds


def _file(text):
    path = os.path.join(tempfile.mkdtemp(prefix="offerlake-bad-"), "f.json")
    with open(path, "w") as f:
        f.write(text)
    return path


@pytest.mark.parametrize("text", ['[{"url":"a"},{"url":"b"},{"url":', '{"a": {"url": "x"}, "b": ', "", "nonsense"])
def test_unparsable_document_raises(spark, text):
    with pytest.raises(Exception, match="not valid JSON"):
        feeds.read_feed(spark, _file(text)).collect()
    with pytest.raises(Exception, match="not valid JSON"):
        feeds.read_twin_map(spark, _file(text)).collect()


@pytest.mark.parametrize("text", ['"text"', "5", "true", "[]", "{}", " \n[ ]"])
def test_other_roots_are_empty(spark, text):
    assert feeds.read_feed(spark, _file(text)).count() == 0


def test_absent_source_is_empty_but_other_errors_raise(spark):
    assert feeds.read_feed(spark, "/nowhere/at/all.json").count() == 0
    assert feeds.read_feed(spark, None).count() == 0


def test_positions_run_over_files(spark):
    folder = tempfile.mkdtemp(prefix="offerlake-many-")
    for i, text in enumerate(['[{"a":1},{"a":2}]', '{"k": {"a":3}, "l": {"a":4}, "k": {"a":5}}', "[]", '[{"a":6}]']):
        with open(f"{folder}/f{i}.json", "w") as f:
            f.write(text)
    got = sorted((r.pos, r.key, r.raw.replace(" ", "")) for r in feeds.read_feed(spark, folder).collect())
    assert got == [(0, None, '{"a":1}'), (1, None, '{"a":2}'), (2, "k", '{"a":5}'), (3, "l", '{"a":4}'), (4, None, '{"a":6}')]
    assert feeds.read_feed(spark, folder).schema["pos"].dataType.simpleString() == "bigint"


@pytest.mark.parametrize("raw", ["1", '"x"', "null", "[1]", '{"name": 5}', '{"status": "abc"}', '{"status": 404.7}', '{"city": ["Paris"]}'])
def test_record_of_another_type_raises(spark, raw):
    rows = spark.createDataFrame([(0, None, raw)], BRONZE_ROWS)
    with pytest.raises(Exception, match="another type"):
        silver.conform_a(rows, "2026-06-10").collect()


def test_sound_records_pass(spark):
    rows = spark.createDataFrame([(i, None, r) for i, r in enumerate(['{"name": "x", "status": 200}', '{"name": null, "status": "404"}', '{"status": 200.0}', "{}"])], BRONZE_ROWS)
    got = silver.conform_a(rows, "2026-06-10").orderBy("offer_id").collect()
    assert [r.status for r in got] == [200, 404, 200, None]


def test_uncommitted_landing(spark):
    root, src = tempfile.mkdtemp(prefix="offerlake-crash-"), _file('[{"url":"a"}]')
    os.makedirs(f"{root}/wttj/dt=2026-06-10/_temporary/0")
    with pytest.raises(feeds.MalformedFeedError):
        bronze.read(spark, root, "wttj", "2026-06-10")
    assert bronze.land(spark, root, "wttj", src, "2026-06-10")["present"]
    assert bronze.read(spark, root, "wttj", "2026-06-10").count() == 1
    bronze.land(spark, root, "wttj", _file('[{"url":"a"},{"url":"b"}]'), "2026-06-10")     # committed: untouched
    assert bronze.read(spark, root, "wttj", "2026-06-10").count() == 1
    assert bronze.read(spark, root, "wttj", "2026-06-11").count() == 0
