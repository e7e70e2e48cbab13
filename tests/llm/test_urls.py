import random

import pytest

from clickfeat.llm import urls


def brute(url, entries, default="allow"):
    """Host, path, rule and verdict of one url by looking at every entry."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    best = None
    for rule_host, rule_path, verdict in entries:
        rule_host, rule_path = (rule_host or "").lower(), rule_path or ""
        if verdict in ("allow", "block") and (not rule_host or host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            labels = len(rule_host.split(".")) if rule_host else 0
            best = max(best or (-1,), (labels, len(rule_path), verdict == "block", rule_host + rule_path, verdict))
    return host, path, best and best[3], best[4] if best else default


def judged(spark, given, entries, **options):
    frame = spark.createDataFrame([(i, u, "clash", 7) for i, u in enumerate(given)], "page_id long, url string, verdict string, n int")
    out = urls.judge(frame, urls.rules(spark, entries), **options)
    assert out.columns == ["page_id", "url", "n", "host", "path", "rule", "verdict"]
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}


ENTRIES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/en/", "allow"), ("example.net", "/en", "block"),
    ("org", "/fr/", "allow"), ("Example.COM", "/de", "block"), ("a.example.com", "", "allow"), ("tie.org", "/x", "allow"),
    ("tie.org", "/x", "block"), ("", "/robots", "block"), (None, "/null", "block"), ("co", None, "block"), ("odd.co", "/", None), ("odd.co", "/", "maybe"),
]
URLS = [
    None, "", "no scheme", "http://", "http://example.net", "http://example.net/", "HTTPS://WWW.Example.NET/en/1?x#y", "x://example.net/enx",
    "x://notexample.net/en/1", "x://example.com/de", "x://b.a.example.com/de/", "x://tie.org/xy", "x://any.where/robots.txt", "x://any/null",
    "x://odd.co", "x://net?/en/", "x://net#/", "x://.net/", "x://net./", "x://net:80/", "x://u@example.net/en/://z/", "://org/fr/é", "x://ÄB.org/fr/",
    "x://org//fr/", "x://org/fr", "x://example.net/en/" + "a/" * 20_000, "x://" + "a." * 20_000 + "net/q", "x://o\nrg/f\nr",
]


def test_equals_brute_force(spark):
    found = judged(spark, URLS, ENTRIES)
    assert found == {i: brute(u, ENTRIES) for i, u in enumerate(URLS)}


@pytest.mark.parametrize("part_bytes", [100, 8 << 20])
def test_random_lists_in_one_and_in_many_parts(spark, monkeypatch, part_bytes):
    """Small parts pass the urls by several tries."""
    monkeypatch.setattr(urls, "PART_BYTES", part_bytes)
    random.seed(5)
    word = lambda: random.choice(["a", "b", "ab", "aab"])
    host = lambda: ".".join(word() for _ in range(random.randint(1, 3)))
    path = lambda: "".join("/" + random.choice(["", word()]) for _ in range(random.randint(0, 3)))
    entries = [(host(), path(), random.choice(["allow", "block"])) for _ in range(25 if part_bytes < 1000 else 60)]
    given = [f"x://{host()}{path()}" for _ in range(400)]
    assert judged(spark, given, entries) == {i: brute(u, entries) for i, u in enumerate(given)}


def test_default_empty_tables_and_filter(spark):
    assert judged(spark, ["x://a.b/c"], [], default="block") == {0: ("a.b", "/c", None, "block")}
    assert judged(spark, [], ENTRIES) == {}
    frame = spark.createDataFrame([("x://n.net/", 1), ("x://n.net/", 1), ("x://n.org/", 2), ("x://n.org/", 2), (None, 3)], "url string, host int")
    kept = urls.allowed(frame, urls.rules(spark, ENTRIES))
    assert kept.columns == ["url", "host"] and sorted(r.host for r in kept.collect()) == [2, 2, 3]
