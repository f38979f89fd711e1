"""The product queries' lake: its landed tables."""

from offerlake.plans import lake
from offerlake.schemas import BRONZE_ROWS


def test_landed_records_of_every_feed(spark, monkeypatch):
    rows = {"wttj": [(0, None, '{"url":"https://a/0"}')], "indeed": [(0, "d1", '{"url":"https://b/1"}')],
            "cross_site": [(0, "https://b/1", '{"otherSite":"wttj"}'), (1, "https://b/2", '{"otherSite":"wttj"}')]}
    tables = {f"landed_{n}": spark.createDataFrame(r, BRONZE_ROWS) for n, r in rows.items()}
    monkeypatch.setattr(lake, "lake", lambda *_: tables)
    got = sorted((r.feed, r.pos, r.key, r.url) for r in lake.landed_keys(spark, "").collect())
    assert got == [("cross_site", 0, "https://b/1", None), ("cross_site", 1, "https://b/2", None),
                   ("indeed", 0, "d1", "https://b/1"), ("wttj", 0, None, "https://a/0")]
