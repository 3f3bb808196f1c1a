"""Given rules by the letter, mined rules on made labels."""

import re

from snapmart.llm import queries
from snapmart.llm.url_rules import RULES, judge, mine_rules


def brute(url):
    text = url or ""
    at = text.find("://")
    if at < 0:
        return "", "", None, None
    rest = text[at + 3:]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_whole_table(spark, sf_dir):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.QUERIES["op6_url_filter"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        host, path, rule, verdict = brute(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "x://", "HTTP://A.ORG/x?y", "http://org", "http://org?/", "http://notorg/", "http://EXAMPLE.org/es/",
            "http://example.org/es", "a://b://c.org/", "http://É.com/fr/", "http://x.com/de/1#a", "http://example.org/en/1",
            "line\nbreak://www.com/fr/\n", "http://u:p@host.org:80/"]
    df = spark.createDataFrame([(None if i == 3 else i, u, "z") for i, u in enumerate(urls * 2)], "page_id long, url string, host string")
    rows = judge(df).collect()
    assert len(rows) == len(urls) * 2
    for r in rows:
        if r.page_id is not None:
            host, path, rule, verdict = brute(urls[r.page_id % len(urls)])
            assert (r.host, r.path, r.rule) == (host, path, rule)
            assert rule is None or r.verdict == verdict
    assert judge(df.limit(0)).count() == 0


def test_mined_rules(spark):
    rows = [(f"http://shop{i % 9}.test/offers/{i}", "block") for i in range(60)]
    rows += [(f"http://shop{i % 9}.test/about/{i}", "allow") for i in range(60)]
    rows += [(f"http://news.test/offers/{i}", "allow") for i in range(60)]
    labelled = spark.createDataFrame(rows, "url string, verdict string")
    pages = spark.createDataFrame([(1, "http://shop3.test/offers/900"), (2, "http://news.test/offers/2"),
                                   (3, "http://new.test/about/1"), (4, "http://unknown.example/zzz")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in judge(pages, rules=(), labelled=labelled).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "allow"}


def test_pruning_keeps_the_smallest_sure_sets(spark):
    rows = [(["a", "b", "c"], "block")] * 20 + [(["c", "d"], "allow")] * 20 + [(["b", "d"], "allow")] * 5
    mined = mine_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.05, 0.7).collect()
    sets = {(tuple(r.tokens), r.verdict): r.confidence for r in mined}
    assert sets[(("a",), "block")] == 1.0 and sets[(("d",), "allow")] == 1.0
    assert (("a", "b"), "block") not in sets and (("c", "d"), "allow") not in sets
    assert sets[(("b",), "block")] == 0.8 and (("b", "c"), "block") in sets
    assert mine_rules(spark.createDataFrame([], "tokens array<string>, verdict string")).count() == 0
