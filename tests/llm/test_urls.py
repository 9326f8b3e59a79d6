"""URL filters against plain Python."""

import re

from spendscope.llm import urls

URLS = [
    None, "", "no scheme", "http://", "://a.com/x", "http://example.com/en/1", "https://WWW.Example.COM/en/", "http://www.example.com/en",
    "http://a.www.example.com/en/x?y#z", "http://example.com.evil.org/en/", "http://notexample.com/en/", "http://x.net/es/", "http://net/fr/",
    "http://NET/FR/", "http://x.net/esx/", "http://x.net?/es/", "http://x.org/casino/", "http://x.org/casinos", "http://a.com", "http://a.com/poker",
    "http://a.com:80/", "http://u@a.com/", "http://x.org/?q=Sex", "http://Kom.com/\n/é", "http://x.com\n/", "http://.com/", "http://x.net/es/" + "a/" * 5000,
    "http://one.example.com/en/://b.net/fr/",
]


def place(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def expected(url):
    host, path = place(url)
    best = None
    for rule in urls.RULES:
        name, rest = rule.name.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            best = max(best or rule, rule, key=lambda r: len(r.name))
    if best:
        return host, path, best.name, best.verdict
    tokens = re.split("[^a-z0-9]", "".join(c.lower() if c.isascii() else c for c in url or ""))
    return host, path, None, "block" if any(r.tokens[0] in tokens for r in urls.TOPICS) else "allow"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "x", "y", "z") for i, u in rows], "page_id long, url string, host string, rule string, token string")


def test_judge(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[5]), (0, URLS[5]), (None, URLS[6])]
    got = [tuple(r) for r in urls.judge(pages(spark, rows).repartition(3), urls.RULES, urls.TOPICS).collect()]
    assert sorted(got, key=repr) == sorted([(i, *expected(u)) for i, u in rows], key=repr)


def test_rarest_token_and_rules_without_tokens(spark):
    rules = (urls.Rule("any", "block", "[0-9]{3}", (), "url"), urls.Rule("both", "block", "^common[.]rare/", ("common", "rare")))
    df = pages(spark, [(i, f"http://common.x/{i}") for i in range(9)] + [(10, "http://common.rare/"), (11, "http://common.x/123")])
    rows = df.selectExpr("split(url, '[^a-z0-9]+') as tokens")
    assert {r.rule: r.token for r in urls.rule_index(spark, rules, rows).collect()} == {"any": "", "both": "rare"}
    assert {r.page_id: r.rule for r in urls.judge(df, rules).collect() if r.rule} == {10: "both", 11: "any"}


def test_empty(spark):
    assert urls.judge(pages(spark, []), urls.RULES).count() == 0
