"""Incremental landing lands each new document once, in the batch landing's layout."""

import os
import shutil
import tempfile

import pytest

from offerlake.sources import bronze
from offerlake.streaming.landing import land_new_documents

FIX = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


def test_available_now_lands_only_new_files(spark):
    base = tempfile.mkdtemp(prefix="offerlake-stream-")
    src, root, ck = f"{base}/in", f"{base}/bronze", f"{base}/ck"
    os.makedirs(src)
    shutil.copy(f"{FIX}/feed_a.json", f"{src}/a1.json")
    shutil.copy(f"{FIX}/feed_a.json", f"{src}/a2.json")
    assert land_new_documents(spark, src, root, "wttj", "2026-06-10", ck)
    pos = [r.pos for r in bronze.read(spark, root, "wttj", "2026-06-10").collect()]
    assert sorted(pos) == list(range(8))
    assert not land_new_documents(spark, src, root, "wttj", "2026-06-11", ck)      # nothing new
    assert bronze.read(spark, root, "wttj", "2026-06-11").count() == 0
    shutil.copy(f"{FIX}/feed_a.json", f"{src}/a3.json")
    assert land_new_documents(spark, src, root, "wttj", "2026-06-11", ck)
    assert bronze.read(spark, root, "wttj", "2026-06-11").count() == 4
    assert bronze.read(spark, root, "wttj", "2026-06-10").count() == 8
    shutil.copy(f"{FIX}/feed_a.json", f"{src}/a4.json")
    with pytest.raises(Exception, match="already committed"):
        land_new_documents(spark, src, root, "wttj", "2026-06-11", ck)
