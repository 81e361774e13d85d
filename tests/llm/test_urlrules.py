from siftwell.llm import urlrules

RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("bad.net", "", "block"),
]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def judge(url, rules):
    host, path = parse(url)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


URLS = [
    None, "", "no scheme", "://", "http://", "http://Example.ORG", "https://example.org/", "https://a.example.org/es/x?y#z",
    "https://example.org/en/123", "https://example.org/en/2", "https://notexample.org/es/", "http://x.COM/fr/1", "http://x.com/de/",
    "http://x.com/de", "http://x.com/DE/", "http://bad.net", "http://sub.bad.net?q=/de/", "http://bad.net/a/b", "x://y://z.org/de/",
    "http://org/", "http://a.com:80/fr/", "http://é.org/ñ", "http://" + "a." * 300 + "org/" + "p" * 5000, "http://a\nb.org/",
]


def test_verdicts_match_brute_force(spark):
    rows = [(i, u, "h", "r") for i, u in enumerate(URLS)] + [(0, URLS[7], "h", "r"), (None, URLS[7], "h", "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    for limit in (urlrules.BROADCAST_RULES, 0):
        urlrules.BROADCAST_RULES, kept = limit, urlrules.BROADCAST_RULES
        try:
            rules = spark.createDataFrame(RULES + RULES[:2] + [(None, "/", "block")], "host string, path string, verdict string")
            got = urlrules.judge_urls(pages, rules).select("page_id", "url", "host", "path", "rule", "verdict").collect()
        finally:
            urlrules.BROADCAST_RULES = kept
        want = [(i, u, *judge(u, RULES)) for i, u, *_ in rows]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_no_rules_and_no_pages(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert urlrules.judge_urls(pages, rules).first()["verdict"] == "allow"
    some = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert urlrules.judge_urls(pages.limit(0), some).count() == 0
