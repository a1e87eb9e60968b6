from datetime import date, timedelta

import pytest

from ledgerlake.llm import url_lists as ul

DAY = date(2024, 1, 1)


def days(n):
    return DAY + timedelta(days=n)


def judge(spark, captures, entries, **more):
    rows = spark.createDataFrame([(k, u, d, "x") for k, (u, d) in enumerate(captures)], "page_id long, url string, fetched_on date, value string")
    feed = spark.createDataFrame(entries, "list string, action string, kind string, value string, change string, dated date")
    return ul.judge(rows, feed)


def verdicts(spark, captures, entries):
    return [r["verdict"] for r in judge(spark, captures, entries).select("page_id", "verdict").orderBy("page_id").collect()]


def test_entries_count_from_addition_to_removal(spark):
    entries = [("l", "block", "domain", "bad.example.com", c, days(d)) for c, d in (("add", 10), ("remove", 20), ("add", 30), ("add", 35))]
    captures = [("http://a.bad.example.com/x", days(d)) for d in (9, 10, 19, 20, 29, 30, 400)]
    assert verdicts(spark, captures, entries) == ["none", "block", "block", "none", "none", "block", "block"]


def test_the_most_specific_entry_decides_and_allow_beats_block(spark):
    add = lambda action, kind, value: ("l", action, kind, value, "add", DAY)
    entries = [add("block", "domain", "example.com"), add("allow", "domain", "good.example.com"), add("block", "prefix", "good.example.com/ads"),
               add("allow", "url", "good.example.com/ads/ok?x=1"), add("block", "domain", "tie.org"), add("allow", "domain", "tie.org")]
    captures = [(u, days(1)) for u in ("https://example.com", "http://www.good.example.com/a", "http://good.example.com/ads/1", "HTTP://Good.Example.com:80/ads/ok?x=1#top",
                                       "http://u:p@tie.org/", "http://notexample.com/", "http://example.com.evil.net/")]
    assert verdicts(spark, captures, entries) == ["block", "allow", "block", "allow", "allow", "none", "none"]


def test_prefixes_of_several_segments(spark):
    add = lambda action, value: ("l", action, "prefix", value, "add", DAY)
    entries = [add("block", "host.org/user"), add("allow", "host.org/user/repo"), add("block", "host.org/user/repo/bad/deep"), add("block", "other.org/a/b")]
    urls = ["http://host.org/user", "http://host.org/user/x", "http://host.org/user/repo", "http://host.org/user/repo/?q=/bad/deep", "https://HOST.org:80/user/repo/bad/deep/x.html#top",
            "http://host.org/user/repository", "http://other.org/a", "http://other.org/a/b/", "http://other.org/a/bc", "http://host.org/" + "y/" * 20_000]
    assert verdicts(spark, [(u, days(1)) for u in urls], entries) == ["block", "block", "allow", "allow", "block", "block", "none", "block", "none", "none"]
    got = judge(spark, [(urls[4], days(1))], entries).first()
    assert (got["n_active"], got["kind"], got[-2]) == (3, "prefix", "host.org/user/repo/bad/deep")


def test_ties_on_one_day_and_void_entries(spark):
    entries = [("l", "block", "domain", "a.com", "add", days(3)), ("l", "block", "domain", "a.com", "remove", days(3)),
               (None, "block", "domain", "b.com", "add", DAY), ("l", "block", "domain", "b.com", "add", None), ("l", "block", "domain", "c.com", "remove", DAY)]
    assert verdicts(spark, [("http://a.com/", days(3)), ("http://b.com/", days(3)), ("http://c.com/", days(3))], entries) == ["block", "none", "none"]


@pytest.mark.parametrize("url", [None, "", "no scheme", "http://", "http:///path", "http://" + "a." * 200 + "com/", "http://" + "x" * 5000])
def test_awkward_addresses_match_nothing(spark, url):
    rows = judge(spark, [(url, DAY), ("http://a.com/" + "y" * 100_000, None)], [("l", "block", "domain", "com", "add", DAY)]).collect()
    assert [r["verdict"] for r in rows] == ["none", "none"] and all(r["kept"] for r in rows)


def test_columns_pass_through_and_repeats_stay(spark):
    got = judge(spark, [("http://a.com/", days(1))] * 3, [("l", "block", "domain", "a.com", "add", DAY)])
    assert got.count() == 3
    assert got.columns[:4] == ["page_id", "url", "fetched_on", "value"]


def test_empty_tables(spark):
    assert judge(spark, [], []).count() == 0
    assert verdicts(spark, [("http://a.com/", DAY)], []) == ["none"]


def test_no_python_in_the_plan(spark):
    plan = ul.op8_url_lists(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
