import random

from flowbench.llm.url_filter import url_verdicts

SCHEMA = "page_id long, url string, host string, rule int, prefix string"
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("a.b.c", "", "block"), ("b.c", "/x", "allow"),
         ("Tie.org", "/t/", "allow"), ("tie.org", "/t/", "block"), ("deep.io", "/a/b/c", "block"), (None, "/", "block"), ("nopath", None, "block")]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:next((i for i, c in enumerate(path) if c in "?#"), len(path))]
    best = None
    for h, p, v in RULES:
        h, p = (h or "").lower(), p or ""
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1, "", ""), (len(h + p), v, h + p))
    return host, path, best[2] if best else None, best[1] if best else "allow"


def test_against_brute_force(spark):
    rng = random.Random(3)
    urls = [None, "", "no scheme", "http://", "https://net", "https://net/", "http://x.NET/?a", "http://xnet/", "http://a.b.c", "http://z.a.b.c/xy", "http://b.c/x", "http://TIE.org/t/1",
            "http://deep.io/a/b/cd", "http://deep.io/a/b", "http://deep.io//a/b/c", "http://ÉX.Example.net/en/é#x", "http://nopath", "ftp://u:p@example.com:80/de/", "http://a://b.c/x", "http://.net/",
            "http://example.com/de/" + "d/" * 3000, "http://exam\nple.net/en/\nx", "http://q?x/net/", "http://example.net/en//"]
    urls += ["http://" + ".".join(rng.choice(["a", "b", "c", "net", "org", "example", "com"]) for _ in range(rng.randint(1, 5))) + "/" + "/".join(rng.choice(["en", "de", "fr", "x", "t", ""]) for _ in range(rng.randint(0, 4)))
             for _ in range(300)]
    rows = [(i, u, "h", 1, "p") for i, u in enumerate(urls)] + [(0, "https://net/", "h", 1, "p"), (None, "https://net/", "h", 1, "p"), (None, "https://net/", "h", 1, "p")]
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    out = url_verdicts(spark.createDataFrame(rows, SCHEMA), rules)
    assert sorted(out.columns) == ["host", "page_id", "path", "prefix", "rule", "verdict"]
    got = sorted([tuple(r) for r in out.select("page_id", "host", "path", "rule", "verdict").collect()], key=str)
    assert got == sorted([(r[0], *brute(r[1])) for r in rows], key=str)


def test_empty_tables(spark):
    rules, none = spark.createDataFrame(RULES, "host string, path string, verdict string"), spark.createDataFrame([], SCHEMA)
    assert url_verdicts(none, rules).collect() == []
    one = spark.createDataFrame([(1, "http://net/", "", 1, "")], SCHEMA)
    assert [r["verdict"] for r in url_verdicts(one, rules.limit(0)).collect()] == ["allow"]
