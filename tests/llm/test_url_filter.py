from datetime import datetime

from pyspark.sql import functions as F

from billbook.llm import url_filter

CAPTURES = "page_id bigint, url string, fetched_at timestamp, action string"
ENTRIES = "list_key string, listed_at timestamp, action string, rank int"


def day(n, hour=0):
    return datetime(2024, 1, n, hour)


def test_as_of_with_the_most_specific_key(spark):
    entries = [
        ("bad.org", day(2), "block", 1), ("bad.org", day(5), "remove", 1), ("bad.org", day(9), "block", 1),
        ("ok.bad.org", day(3), "allow", 1), ("ok.bad.org", day(4, 12), "remove", 1),
        ("site.net/ads", day(1), "block", 1), ("site.net", day(1), "allow", 1), (None, day(1), "block", 1),
        ("tie.net", day(1), "allow", 1), ("tie.net", day(1), "block", 1), ("void.net", None, "block", 1),
    ]
    captures = [
        (1, "http://bad.org/a", day(1, 23)), (2, "http://bad.org/a", day(2)), (3, "http://x.bad.org", day(4)),
        (4, "https://u@OK.bad.org:80/p", day(4)), (5, "http://ok.bad.org/", day(4, 13)), (6, "http://bad.org", day(6)),
        (7, "http://bad.org", day(30)), (8, "http://site.net/ads/1?q", day(2)), (9, "http://site.net/a", day(2)),
        (10, "http://tie.net", day(3)), (11, "http://void.net", day(3)), (12, None, day(3)), (13, "no url", day(3)),
        (14, "http://bad.org", None), (2, "http://bad.org/a", day(2)), (None, "http://bad.org", day(2)),
    ]
    found = url_filter.filter_urls(
        spark.createDataFrame([(*c, "x") for c in captures], CAPTURES), spark.createDataFrame(entries, ENTRIES)
    ).collect()
    got = {r["page_id"]: (r["action"], r["matched_key"]) for r in found}
    assert len(found) == len(captures)
    assert got == {
        1: ("allow", None), 2: ("block", "bad.org"), 3: ("block", "bad.org"), 4: ("allow", "ok.bad.org"),
        5: ("block", "bad.org"), 6: ("allow", None), 7: ("block", "bad.org"), 8: ("block", "site.net/ads"),
        9: ("allow", "site.net"), 10: ("block", "tie.net"), 11: ("allow", None), 12: ("allow", None),
        13: ("allow", None), 14: ("allow", None), None: ("block", "bad.org"),
    }


def test_empty_tables(spark):
    none, no_entries = spark.createDataFrame([], CAPTURES), spark.createDataFrame([], ENTRIES)
    one = spark.createDataFrame([(1, "http://a.b", day(1), "x")], CAPTURES)
    assert url_filter.filter_urls(none, no_entries).collect() == []
    assert [r["action"] for r in url_filter.filter_urls(one, no_entries).collect()] == ["allow"]


def test_keys_of_a_url(spark):
    urls = ["http://a.b.example.com/x/y?z#t", "ftp://localhost", "https://[bad", "http:///p", ""]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(url_filter.url_keys(F.col("u"))).collect()
    assert [r[0] for r in rows] == [
        ["a.b.example.com/x", "a.b.example.com", "b.example.com", "example.com"], ["localhost"], ["[bad"], [], [],
    ]
