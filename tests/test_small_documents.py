"""Small documents are read in one piece, with the rows that cutting gives."""

import gzip
import os

import pytest

from offerlake.sources import documents, feeds

DOCS = ["[]", "{}", ' [ {"a":{"x":"}"}}, 5 ] \n', '"s"', "5", "null", '{"k":{"a":1},"l":[2],"k":{"a":3}}', '\ufeff[{"b":"\\"}"}]', '{"a}":"b"}\r\n']
UNSOUND = ["[1] x", "[1]]", "[1]}", '{"a":1}}', '{"a":1}]', '{"a":1},"b":2', '[{"a":1}{"b":2}]', "[1,]", '{"a":1', "   ", "nul", "[1]\x00"]


def folder(path, texts):
    for i, text in enumerate(texts):
        with open(os.path.join(path, f"f{i:02}.json"), "wb") as f:
            f.write(text.encode())
    return str(path)


def rows(spark, path):
    return sorted(tuple(r) for r in feeds.read_feed(spark, path).collect())


def test_small_documents_are_not_cut(spark, tmp_path, monkeypatch):
    path = folder(tmp_path, DOCS)
    monkeypatch.setattr(documents, "WHOLE", 0)
    want = rows(spark, path)
    monkeypatch.undo()

    def fragments(*_):
        raise AssertionError("a small document was cut")

    monkeypatch.setattr(documents, "fragments", fragments)
    assert rows(spark, path) == want and len(want) == 6
    assert (2, "k", '{"a":3}') in want


def test_small_large_and_compressed_documents_together(spark, tmp_path, monkeypatch):
    path = folder(tmp_path, ['[{"a":1}]', "[" + ",".join(f'{{"n":{i}}}' for i in range(500)) + "]", '[{"a":2}]'])
    with gzip.open(os.path.join(path, "f03.json.gz"), "wb") as f:
        f.write(b'{"x":{"z":1},"y":{"z":2}}')
    monkeypatch.setattr(documents, "WHOLE", 100)
    small = {os.path.basename(r.file) for r in documents.judged_whole(spark, path).collect()}
    assert small == {"f00.json", "f02.json"}
    got = rows(spark, path)
    assert [r[2] for r in got] == ['{"a":1}', *(f'{{"n":{i}}}' for i in range(500)), '{"a":2}', '{"z":1}', '{"z":2}']
    assert [r[0] for r in got] == list(range(504))


def test_unsound_small_documents_stop_the_job(spark, tmp_path):
    bad = documents.judged_whole(spark, folder(tmp_path, UNSOUND)).where("not good").count()
    assert bad == len(UNSOUND)
    with pytest.raises(Exception, match="not valid JSON"):
        rows(spark, str(tmp_path))
