import re

import duckdb
from pyspark.sql import functions as F

from urbanflux.llm import queries, url_rules
from urbanflux.llm.url_rules import PATTERN_RULES, SITE_RULES, judge_urls, pattern_rule, site_rule

URLS = [
    "http://a.org/x",
    "https://EXAMPLE.org/en/1",
    "http://sub.Example.ORG/en/123?q=/es/",
    "http://example.org/es/",
    "http://example.org/es",
    "http://notexample.org/es/a",
    "http://b.com/fr/x#y",
    "http://b.com/de/",
    "http://b.com",
    "http://b.com?x=://c.org/",
    "http://org/",
    "ftp://spam-farm.net/a",
    "http://my-spam-farm.net/a",
    "http://spam-farm.org/a",
    "http://x.net/a/login",
    "http://x.net/a/login.php",
    "http://x.net/a/loginpage",
    "http://x.net/wp-admin/",
    "http://adserver.x.net",
    "http://user@x.org:80/p",
    "://",
    "://a.org/",
    "no scheme",
    "",
    None,
    "http://x.net/" + "a/" * 20_000,
    "http://b.com\n.org/fr/",
]


def plain(url):
    """The rules one after the other."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule in SITE_RULES:
        own, start = rule.name.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
            fits.append((-len(rule.name), rule.name, rule.verdict))
    other = next((r for r in PATTERN_RULES if re.search(r.pattern, host + path)), None)
    if fits:
        _, name, verdict = min(fits)
    else:
        name, verdict = None, other.verdict if other else "allow"
    return host, path, name, verdict, other.name if other else None


def test_every_kind_of_url(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    for r in judge_urls(df).collect():
        assert tuple(r)[2:] == plain(URLS[r["page_id"]]), URLS[r["page_id"]]


def test_query_equals_its_sql_on_odd_urls(spark, folder):
    rows = [(i, u, "x") for i, u in enumerate([*URLS, *URLS])] + [(None, URLS[1], None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    found = queries.op3_url_rules(spark, folder).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    want = con.execute(queries.ORACLE["op3_url_rules"]).fetchall()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def test_many_rules_and_rare_tokens(spark):
    rules = [site_rule("block" if i % 2 else "allow", f"site{i}.net/") for i in range(600)]
    rules.append(pattern_rule("block", "both", r"^[^/]*/a/b", "a"))
    df = spark.createDataFrame([(i, f"http://w.site{i}.net/a/b") for i in range(0, 700, 7)], "page_id long, url string")
    for r in judge_urls(df, rules=rules).collect():
        n = r["page_id"]
        assert r["rule"] == (f"site{n}.net/" if n < 600 else None)
        assert r["verdict"] == ("allow" if n < 600 and n % 2 == 0 else "block")
        assert r["method_rule"] == "both"


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string").withColumn("rule", F.lit(5)).withColumn("host", F.lit(5))
    assert judge_urls(df).first()["rule"] == "org/"
    assert judge_urls(df.limit(0)).collect() == []
    assert "x_rule" in judge_urls(df, prefix="x_").columns
    assert judge_urls(df, rules=[]).first()["verdict"] == "allow"


def test_literals_are_whole_tokens():
    assert site_rule("allow", "example.org/en/1").literals == ("example", "org", "en")
    assert url_rules.MAX_RULES >= 1000
