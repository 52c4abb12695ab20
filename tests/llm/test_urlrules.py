import re

import pytest
from pyspark.sql import functions as F

from campaignlens.llm import urlrules

URLS = [
    "http://example.net/fr/1", "https://m.example.net/en/2?x=1", "http://EXAMPLE.com/de/3#top", "http://example.com/DE/3",
    "http://notexample.net/en/1", "http://a.example.org/fr/9", "ftp://org/fr/", "http://example.net", "http://net/", "net/",
    None, "", "no scheme", "://host.net/x", "http://x.org/fr", "http://b.com/casino/1", "http://my-casino.net/", "http://q.com/wp-login.php",
    "http://u/?a=://v.net/x", "http://x.example.net/en/../de", "http://ex.com/a?u=http://y.net/",
]


def expected(url):
    if url is None or "://" not in url:
        return "", "", None, urlrules.DEFAULT_VERDICT
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, verdict in urlrules.HOST_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    for pattern, _, verdict in urlrules.PATTERN_RULES:
        if re.search(pattern, host + path):
            return host, path, None, verdict
    return host, path, None, urlrules.DEFAULT_VERDICT


def test_every_rule_against_plain_python(spark):
    pages = spark.createDataFrame(list(enumerate(URLS + URLS)), "page_id long, url string").withColumn("rule", F.lit("mine"))
    out = urlrules.judge(pages)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    for r in out.collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == expected(r["url"]), r["url"]
    assert out.count() == 2 * len(URLS)


def test_rules_are_filed_under_their_rarest_token(spark):
    pages = spark.createDataFrame([(i, f"http://common.rare{i % 2}.com/x/{i}") for i in range(10)], "page_id long, url string")
    rules = urlrules.compile_rules([("rare1.com/x/", "block")], [(r"common[.]rare0", ("common", "rare0"), "block")])
    got = {r["page_id"]: r["verdict"] for r in urlrules.judge(pages, rules=rules).collect()}
    assert all(v == "block" for v in got.values())
    assert urlrules.judge(pages, rules=[]).where("verdict = 'allow'").count() == 10


def test_rule_without_token_and_empty_table(spark):
    with pytest.raises(ValueError):
        urlrules.compile_rules([], [(".*", (), "block")])
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urlrules.judge(pages).count() == 0
