import random
import string

from sluicegate.llm import url_rules

RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("example.org", "/en/12", "allow"),
    ("www.example.org", "", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/fr/x", "block"),
    ("COM", "/de/", "block"),
    ("com", "/de/", "allow"),
    ("net", None, "block"),
    (None, "/x", "block"),
    ("a.net", "/q", None),
]


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    at = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if c in string.ascii_uppercase else c for c in rest[:at])
    path = rest[at:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = []
    for h, p, v in rules:
        if h is None or v is None:
            continue
        h, p = h.lower(), p or ""
        if (not h or host == h or host.endswith("." + h)) and path.startswith(p):
            fit.append((len(h) + len(p), len(h), v, h + p))
    return (host, path, max(fit)[3], max(fit)[2]) if fit else (host, path, None, "allow")


def found(spark, urls, rules, **options):
    pages = spark.createDataFrame([(i, u, "h", "s", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, salt string, path string")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    df = url_rules.judge(pages, frame, keep=("page_id",), **options)
    assert df.columns == ["page_id", "host", "path", "rule", "verdict"]
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def urls():
    rng = random.Random(4)
    hosts = ["example.org", "www.example.org", "x.www.example.org", "badexample.org", "org", "a.COM", "b.c.com", "net", "a.net", "", "org.", ".org", "é.org", "a..org"]
    paths = ["", "/", "/es/", "/es", "/es/1?x", "/en/1", "/en/123", "/en/2", "/fr/xy", "/fr/#a", "/de/é", "/ES/", "//es/", "/\U0001f600"]
    made = [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=://x', '#y'])}" for _ in range(250)]
    return made + [None, "", "no scheme.org/es/", "://", "a://b://c.org/es/", "http://EXAMPLE.org/es/\nx", "http://org/" + "y" * 100_000] + made[:20]


def test_equals_brute_force(spark):
    many = urls()
    for options in ({}, {"salts": 1}, {"salts": 7}):
        assert found(spark, many, RULES, **options) == {i: brute(u, RULES) for i, u in enumerate(many)}


def test_a_rule_without_a_host_fits_all(spark):
    rules = [("", "/a", "block"), ("org", "/ab", "allow")]
    many = ["http://x.org/abc", "http://x.org/ac", "http://y/ab", "nothing", None]
    assert found(spark, many, rules) == {i: brute(u, rules) for i, u in enumerate(many)}


def test_no_rules_and_no_pages(spark):
    assert found(spark, ["http://x.org/a"], []) == {0: ("x.org", "/a", None, "allow")}
    assert found(spark, [], RULES) == {}


def test_stays_in_the_jvm(spark, plan):
    pages = spark.sql("select 1L as page_id, 'http://x.org/' as url")
    rules = spark.sql("select 'org' as host, '/' as path, 'block' as verdict")
    text = plan(url_rules.judge(pages, rules))
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
