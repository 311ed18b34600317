import re

import pytest
from pyspark.sql import functions as F

from spanwatch.llm import urls
from spanwatch.llm.urls import host_rule, judge_urls, literal_tokens, pattern_rule, rule_index


def plain(url, rules, default="allow"):
    """host, path, rule, pattern, verdict by running every rule on the URL."""
    host = path = tail = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        tail = rest[len(host) + len(path):]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if re.search(r.pattern.replace(r"\z", r"\Z"), host + path + tail)]
    best = min(fits, key=lambda r: (not r.host, -r.weight, r.verdict, r.name), default=None)
    if best is None:
        return host, path, None, None, default
    return host, path, best.name if best.host else None, None if best.host else best.name, best.verdict


ODD = [
    "https://Www.Example.ORG/es/a?b#c", "http://example.org/en/1", "http://example.org/en/14", "http://example.org/EN/1",
    "http://badexample.org/en/1", "http://a.org", "http://a.org/", "http://org/", "http://com/fr/", "x://b.com/fr", "://b.com/de/",
    None, "", "no scheme", "http://", "http://?x=://a.org/", "http://a.org#/es/", "http://é.com/de/ü", "http://a.com/de/\nb",
    "http://spam-farm.example.net/", "http://x.spam-farm.net/q", "http://spam-farm", "http://notspam-farm.net/", "http://ads-track.a.net/",
    "http://ad-track.a.net/", "http://a.net/setup.exe?x", "http://a.net/setup.exe\n", "http://a.net/setup.exe", "http://a.net/x?PHPSESSID=1",
    "http://a.net/x?phpsessid=1", "http://a.net/wp-admin/", "http://a.net/wp-adminx/", "http://torrent.a.net/", "http://" + "a/" * 20_000 + "cart/",
    "ftp://user:pw@h.org:21/x", "http://example.org/en/1", "http://example.org/en/1",
]


@pytest.mark.parametrize("rules", [urls.HOST_RULES + urls.PATTERN_RULES, urls.HOST_RULES, urls.PATTERN_RULES])
def test_rows_equal_brute_force(spark, rules):
    pages = spark.createDataFrame(list(enumerate(ODD)), "page_id long, url string").repartition(3)
    got = {r["page_id"]: tuple(r)[1:] for r in judge_urls(pages, rules).select(
        "page_id", "host", "path", "rule", "pattern", "verdict").collect()}
    assert got == {i: plain(u, rules) for i, u in enumerate(ODD)}


def test_query_over_a_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rules = urls.HOST_RULES + urls.PATTERN_RULES
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["pattern"], r["verdict"]) for r in urls.op11_url_filters(spark, sf).collect()}
    assert got == {p["page_id"]: plain(p["url"], rules) for p in pages}


@pytest.mark.parametrize("pattern, tokens", [
    (r"^abc\.def", {"abc"}), (r"abc\.def\.", {"def"}), (r"/ads/", {"ads"}), (r"/ads?/", set()), (r"/ab+c/", set()),
    (r"/a(b|c)/x/", {"x"}), (r"/x/|/y/", set()), (r"[?&]id=7$", {"id", "7"}), (r"[?&]*id=7", set()), (r"/x[a-z]/y/", {"y"}),
    (r"(?i)/Foo/", {"foo"}), (r"/x{0,2}y/", set()), (r"/a[\]/]b/c/", {"c"}), (r"\bab\b", set()), (r"/é/ü-x/", {"x"}), (r"^a.b\z", set()), (r"^a.b/c\z", {"c"}),
])
def test_literal_tokens_are_in_every_match(pattern, tokens):
    assert set(literal_tokens(pattern)) == tokens


def test_a_rule_stands_under_its_rarest_token_and_only_fetched_rules_run(spark):
    pages = [(i, f"http://common.net/{'rare/' if i == 3 else ''}p{i}/") for i in range(20)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    seen = df.select(F.col("url").alias("subject"), F.explode(F.split("url", "[^a-z0-9]+")).alias("token"))
    rules = urls._rules(spark, [pattern_rule(r"common\.net/rare/"), pattern_rule("/absent/net/"), pattern_rule("[0-9]")])
    index = {r["name"]: r["token"] for r in rule_index(seen, rules).collect()}
    assert index == {r"common\.net/rare/": "rare", "/absent/net/": "absent", "[0-9]": urls.ANY}


def test_longest_host_rule_wins_and_allow_at_a_tie(spark):
    rules = [host_rule("a.org", "", "block"), host_rule("org", "/x", "allow"), pattern_rule("/x"), host_rule("b.org", "", "allow")]
    df = spark.createDataFrame([(1, "http://s.a.org/x"), (2, "http://c.org/x"), (3, "http://a.org"), (4, "http://c.net/x")], "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["pattern"], r["verdict"]) for r in judge_urls(df, rules).collect()}
    # a.org and org/x are equally long
    assert got == {1: ("org/x", None, "allow"), 2: ("org/x", None, "allow"), 3: ("a.org", None, "block"), 4: (None, "/x", "block")}


def test_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://a.org/x", "k", 7)], "page_id long, url string, subject string, Verdict int")
    row = judge_urls(df, urls.HOST_RULES).collect()[0].asDict()
    assert row == {"page_id": 1, "url": "http://a.org/x", "subject": "k", "host": "a.org", "path": "/x",
                   "rule": "org/", "pattern": None, "verdict": "allow"}
    assert judge_urls(df.limit(0), urls.HOST_RULES).count() == 0
    assert judge_urls(df, [], default="block").collect()[0]["verdict"] == "block"


def test_wrong_rules_are_refused(spark):
    df = spark.createDataFrame([(1, "u")], "page_id long, url string")
    with pytest.raises(ValueError):
        judge_urls(df, [pattern_rule("a"), pattern_rule("a")])
    with pytest.raises(ValueError):
        judge_urls(df, [pattern_rule("a", "maybe")])
