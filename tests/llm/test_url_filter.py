import random

from tallyloft.llm import url_filter

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
SCHEMA = "host string, path string, verdict string"


def brute(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def judged(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = url_filter.judge(pages, spark.createDataFrame(rules, SCHEMA), ["page_id"]).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}


URLS = ["http://WWW.Example.com/en/1?x#y", "https://example.com/en", "https://a.b.example.com/en/?q=/fr/", "http://x.net/es/", "http://net/fr/1", "http://x.net", "http://x.net?/es/",
        "ftp://x.net#/es/", "no scheme", "", None, "://", "http:///path", "http://com/", "http://ÄÖ.com/é", "http://x.net/es", "a://b://c.com/",
        "http://notexample.com/en/", "http://x.com\n/en/", "http://" + "a." * 3000 + "com/" + "p" * 5000]


def test_rules_match_brute_force(spark):
    assert judged(spark, URLS, RULES) == {i: brute(u, RULES) for i, u in enumerate(URLS)}


def test_many_rules_match_brute_force_with_broadcast_and_shuffle(spark, monkeypatch):
    draw = random.Random(1)
    hosts = [f"h{i}.{t}" for i in range(60) for t in ("com", "net", "co.uk")]
    rules = sorted({(draw.choice(hosts), "/" + "ab"[:draw.randint(0, 2)], draw.choice(["allow", "block"])) for _ in range(200)}, key=str)
    rules = [r for r in rules if (r[0], r[1], "block") not in rules or r[2] == "block"]
    urls = [f"http://{draw.choice(['', 'www.', 'a.b.'])}{draw.choice(hosts)}/{draw.choice(['', 'a', 'ab', 'abc', 'b'])}" for _ in range(500)]
    expected = {i: brute(u, rules) for i, u in enumerate(urls)}
    assert judged(spark, urls, rules) == expected
    monkeypatch.setattr(url_filter, "BROADCAST_ENTRIES", 0)
    assert judged(spark, urls, rules) == expected


def test_filter_passes_every_listed_key_and_few_others(spark):
    keys = spark.range(20_000).selectExpr("concat('k', id) AS key")
    blocks = 20_000 * 16 // 256
    bloom = url_filter.bloom(keys.filter("key < 'k5'"), blocks)
    import functools
    import operator

    from pyspark.sql import functions as F
    test = functools.reduce(operator.and_, (F.col(w).bitwiseAND(b) != 0 for w, b in zip(url_filter.WORDS, url_filter._bits(F.col("key")))))
    hits = keys.withColumn("block", url_filter._block(F.col("key"), blocks)).join(bloom, "block").filter(test)
    assert hits.filter("key < 'k5'").count() == keys.filter("key < 'k5'").count()
    assert hits.filter("key >= 'k5'").count() < 0.02 * keys.count()


def test_empty_lists_repeats_and_clashing_columns(spark):
    assert judged(spark, URLS[:2], [("x", None, "block")]) == {i: (*brute(u, [])[:2], None, "allow") for i, u in enumerate(URLS[:2])}
    rules = spark.createDataFrame(RULES + [("com", "/", "block")], SCHEMA)
    pages = spark.createDataFrame([(None, "http://q.com/", "h"), (None, "http://q.com/", "h"), (1, None, "i")], "page_id long, url string, host string")
    found = url_filter.judge(pages, rules, ["page_id"])
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(None, "q.com", "/", "com/", "block")] * 2 + [(1, "", "", None, "allow")], key=str)
    assert url_filter.allowed(pages, rules).collect() == [(1, None, "i")]
    assert url_filter.judge(pages.limit(0), rules, ["page_id"]).count() == 0
