import random

from cartwise.llm import urls as U

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("A.Example.com", "/d", "allow"), ("b.org", "", "block"), ("b.org", "", "allow"), ("org", "/deep/er/x", "block"), (None, "/", "block")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    path = rest[cut:]
    end = min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path[:end]


def judge(url, rules):
    host, path = split(url)
    fits = []
    for h, p, a in rules:
        if h and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p or ""):
            fits.append((len(h + (p or "")), len(h), a == "allow", h.lower() + (p or ""), a))
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_equals_brute_force(spark):
    rng = random.Random(1)
    hosts = ["net", "x.net", "EXAMPLE.net", "w.example.net", "example.com", "a.example.com", "notexample.com", "b.org", "c.b.org", "org", "",
             "ex.net:80", "ÀÉ.net", "..net"]
    paths = ["", "/", "/en/", "/en", "/en/1", "/de/2", "/fr/", "/d", "/deep/er/xy", "/a/../fr/"]
    urls = [rng.choice(["http://", "https://", "", "://"]) + rng.choice(hosts) + rng.choice(paths) + rng.choice(["", "?q=/en/", "#x?y", "?a://b"])
            for _ in range(400)] + [None, "", "://", "http://", "mailto:x@y.net"]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(0, urls[0])], "page_id bigint, url string")
    pages = pages.selectExpr("*", "'h' as host", "'r' as rule", "1 as n", "'k' as key")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    got = sorted(map(tuple, U.url_verdicts(pages, rules).collect()), key=str)
    want = sorted([(i, *judge(u, RULES)) for i, u in [*enumerate(urls), (0, urls[0])]], key=str)
    assert got == want


def test_without_rules_and_without_pages(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    assert U.url_verdicts(pages, rules.limit(0), default="block").collect()[0].verdict == "block"
    assert U.url_verdicts(pages.limit(0), rules).count() == 0


def test_full_digest_confirms_a_shared_prefix(spark, monkeypatch):
    monkeypatch.setattr(U, "PREFIX_DIGITS", 1)  # one digit: most expressions collide
    rules = spark.createDataFrame(RULES[:4], "host string, path string, action string")
    urls = [(i, f"http://h{i}.example.{t}/{p}/") for i in range(20) for t in ("net", "com", "org") for p in ("en", "de", "fr")]
    pages = spark.createDataFrame(urls, "page_id bigint, url string")
    got = sorted(map(tuple, U.url_verdicts(pages, rules).collect()), key=str)
    assert got == sorted([(i, *judge(u, RULES[:4])) for i, u in urls], key=str)


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(U, "broadcast_if", lambda df, size: df)
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    pages = spark.createDataFrame([(1, "http://a.example.net/en/1")], "page_id bigint, url string")
    assert U.url_verdicts(pages, rules).collect()[0].rule == "example.net/en/"
