from custval.llm.queries import URL_RULES
from custval.llm.url_filter import apply_rules

URLS = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/1x?y", "http://example.org/en/2", "http://b.com/fr/", "http://b.com/fr", "http://com/de/x#f",
        "x://notexample.org/es/", "no scheme org/", None, "", "http://org", "http://org/", "http://a.com?u=http://b.com/de/", "http://x.com/de/\nz", "://org/é",
        "http://a..org/", "http://" + "l." * 300 + "org/" + "p/" * 3000]


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[:min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fit = [(len(h) + len(p), len(h), h, p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2] + best[3], best[4] if best else default


def test_against_brute_force(spark):
    rules = [*URL_RULES, ("example.org", "", "block"), ("org", "/", "block"), (None, "/", "block"), ("com", None, "block")]
    pages = spark.createDataFrame([(i % 15, u, "q", "q") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    for some in (rules, URL_RULES, []):
        df = spark.createDataFrame(some, "host string, path string, action string")
        real = [r for r in some if None not in r]
        got = sorted((tuple(r) for r in apply_rules(pages, df).collect()), key=repr)
        assert got == sorted(((i % 15, *brute(u, real)) for i, u in enumerate(URLS)), key=repr)
    assert apply_rules(pages.where("false"), df).collect() == []
