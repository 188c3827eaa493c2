import pytest

from aislewise.llm import urls
from aislewise.llm.queries import URL_RULES


def test_query_equals_sql(against_sql):
    assert against_sql("op5_urls") == []


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("example.org/es/", "", "", None, "allow"),
        ("http://EXAMPLE.org/es/x?q#f", "example.org", "/es/x", "example.org/es/", "block"),
        ("http://a.b.example.org/en/12", "a.b.example.org", "/en/12", "example.org/en/1", "block"),
        ("http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
        ("http://example.org", "example.org", "", None, "allow"),
        ("http://x.com/de/a://b", "x.com", "/de/a://b", "com/de/", "block"),
        ("http://x.com/De/", "x.com", "/De/", None, "allow"),
        ("a://b://c", "b:", "//c", None, "allow"),
        ("http://x.com?/de/", "x.com", "", None, "allow"),
        ("http://É.Com/fr/", "É.com", "/fr/", "com/fr/", "allow"),
        ("http://com/de/" + "x" * 100_000, "com", "/de/" + "x" * 100_000, "com/de/", "block"),
    ],
)
def test_urls(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "h"), (1, url, "i")], "page_id long, url string, host string")
    got = urls.judge(pages, urls.rule_table(spark, URL_RULES)).collect()
    assert [tuple(r) for r in got] == [(1, host, path, rule, verdict)] * 2


def test_precedence_and_broken_rules(spark):
    rules = urls.rule_table(
        spark,
        [("a.b", "/", "allow"), ("b", "/xy", "block"), ("c", "/", "allow"), ("c", "/", "block"), ("", "/", "block")],
    ).unionByName(spark.sql("SELECT * FROM VALUES (NULL, '/', 'block'), ('d', NULL, 'block') AS v(host, path, verdict)"))
    pages = spark.createDataFrame([(1, "x://a.b/xy"), (2, "x://c/"), (3, "x://d/"), (None, "x://b/xyz")], "page_id long, url string")
    got = {r.page_id: r.rule and (r.rule, r.verdict) for r in urls.judge(pages, rules).collect()}
    assert got == {1: ("a.b/", "allow"), 2: ("c/", "block"), 3: None, None: ("b/xy", "block")}


def test_no_rules_and_no_pages(spark):
    rules = urls.rule_table(spark, URL_RULES)
    pages = spark.createDataFrame([(1, "x://c.com/de/")], "page_id long, url string")
    assert urls.judge(pages, rules.limit(0)).first().verdict == "allow"
    assert urls.judge(pages.limit(0), rules).count() == 0
