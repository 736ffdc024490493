import re

import pytest

from tessera.llm import url_rules as ur

URLS = [
    None, "", "no scheme net/", "http://", "http://net", "http://net/", "https://a.NET/x", "http://xnet/", "http://example.net/en/",
    "http://www.Example.net/en/1?x=://b.net/", "http://example.net/EN/1", "http://example.net/en", "http://example.com/de/9#top",
    "http://m.example.com/de", "http://example.org/fr/", "http://org/fr/x", "http://forg/fr/x", "http://casino-win.example.com/",
    "http://m.casino-win.example.org/en/1", "http://thecasino.example.com/", "http://ads.example.com?net/", "http://roads.example.com/",
    "http://adult-education.example.com/a", "http://adult-x.example.com/a", "http://free-bets.example.org/ads/", "ftp://x.example.com/ADS/1",
    "http://x.example.com/loads/1", "http://x.example.com/a/casino/bonus", "http://x.example.com/casino-bonus.html", "http://é.net/é",
    "http://user@a.net:80/", "http://a.net:80/", "http://x.example.com/xxx/", "http://x.example.com/a/xxx/", "http://a\nb.net/\nq",
    "http://" + "a." * 20000 + "net/" + "b/" * 20000,
]
RULES = ur.RULES + [("a*b.", "host", "block"), ("*", "path", "block"), ("|/q", "path", "allow"), ("bonus|", "path", "allow"),
                    ("example.net", "site", "block"), ("a.net:80/", "site", "block"), ("net/", "site", "allow"), ("é/", "path", "allow")]


def wanted(url, rules):
    m = re.search("://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]+", lambda x: x.group().lower(), m.group(1)), m.group(2)) if m else ("", "")
    sites = []
    for rule, kind, verdict in rules:
        h, slash, p = rule.partition("/")
        if kind == "site" and (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            sites.append((-len(rule), rule, verdict))
    if sites:
        return host, path, min(sites)[1], min(sites)[2], None
    found = []
    for rule, kind, verdict in rules:
        if kind == "site":
            continue
        body, start, end = rule, "", ""
        if body.startswith("||"):
            body, start = body[2:], r"(^|\.)"
        elif body.startswith("|"):
            body, start = body[1:], r"\A"
        if body.endswith("|"):
            body, end = body[:-1], r"\Z"
        parts = {"*": "(?s:.*)", "^": r"(\A|\Z|[^a-zA-Z0-9])"}
        if re.search(start + "".join(parts.get(c, re.escape(c)) for c in body) + end, host if kind == "host" else path, re.I | re.A):
            found.append((verdict != "allow", -len(rule), rule, verdict))
    return host, path, None, min(found)[3] if found else "allow", min(found)[2] if found else None


@pytest.mark.parametrize("most_bytes", [1 << 20, 0])
@pytest.mark.parametrize("rules", [ur.RULES, RULES])
def test_equals_every_rule_against_every_url(spark, rules, most_bytes):
    rows = [(i if i % 9 else None, u, 5, "x") for i, u in enumerate(URLS)] + [(3, URLS[7], 6, "y")] * 3
    table = spark.createDataFrame(rows, "page_id long, url string, n int, host string").repartition(3)
    got = ur.judged(table, ur.rule_table(spark, rules), most_bytes=most_bytes, hot_share=0.2)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "pattern"]
    def order(x):
        return [(v is not None, v) for v in x]
    assert sorted(map(tuple, got.collect()), key=order) == sorted([(r[0], *wanted(r[1], rules)) for r in rows], key=order)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert ur.judged(none, ur.rule_table(spark)).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    got = ur.judged(one, spark.createDataFrame([], "rule string, kind string, verdict string")).collect()
    assert [(r.rule, r.verdict, r.pattern) for r in got] == [(None, "allow", None)]


def test_rules_are_filed_under_their_rarest_whole_token(spark):
    rules = ur.compiled(ur.rule_table(spark, [("example.net/en/", "site", "allow"), ("||ads*x.", "host", "block"), ("-a.b", "path", "block"),
                                              ("example.net/en", "site", "block"), ("/x/", "no kind", "block")]))
    urls = ur.with_parts(spark.createDataFrame([("http://example.net/en/1",), ("http://example.net/fr/",), ("http://a.net/",)], "url string"))
    from pyspark.sql import functions as F
    got = {r.rule: r.token for r in ur.indexed(rules, ur.token_counts(urls.withColumn("n", F.lit(1)), rules)).collect()}
    assert got == {"example.net/en/": "en", "||ads*x.": "", "-a.b": "a", "example.net/en": "example"}


def test_only_candidates_run_their_expression_and_no_python_runs(spark):
    urls = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = ur.judged(urls, ur.rule_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
