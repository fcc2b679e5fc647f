import duckdb
import pytest
from pyspark.sql import functions as F

from railyard.llm import url_filter as U

URLS = [
    None, "", "no scheme", "http://", "http://org", "http://ORG/", "HTTPS://A.b.Org/x?y#z", "http://example.org/es",
    "http://example.org/es/", "http://www.example.org/en/1", "http://www.example.org/en/148.html", "http://example.org/en/2",
    "http://notexample.org/en/1", "http://a.com/fr/1", "http://a.com/de/1", "http://a.com/DE/1", "http://a.com?x=/de/",
    "http://a.com#/de/", "http://acom/de/", "http://com/de/", "x://y://org/", "http://a.b.casino/x", "http://a.casino",
    "http://org./", "http://a..org/", "http://user@org/", "http://a.org:80/", "http://é.ORG/ü", "http://Éx.com/de/é",
    "http://example.org/es/\nline", "http://a\nb.org/",
]


def expected(url, tiers=(U.RULES, U.OWN_RULES)):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    for tier, rules in enumerate(tiers):
        fits = [(len(h + p), len(h), action == "block", h + p) for action, h, p in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        if fits:
            _, _, block, rule = max(fits)
            return host, path, rule, tier, "block" if block else "allow"
    return host, path, None, None, "allow"


def pages(spark, urls):
    rows = [(i, u, "x", "y", "z") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, path string, digest string")


def judged(spark, urls, *tiers):
    out = U.judge(pages(spark, urls), U.rule_table(spark, *tiers), "url", ["page_id"])
    return {r.page_id: (r.host, r.path, r.rule, r.tier, r.verdict) for r in out.collect()}


def test_cases_and_clashing_columns(spark):
    got = judged(spark, URLS, U.RULES, U.OWN_RULES)
    assert got == {i: expected(u) for i, u in enumerate(URLS)}


def test_query_and_sql_agree_on_whole_table(spark, sf001):
    got = {r.page_id: (r.host, r.path, r.rule, r.own_rule, r.verdict) for r in U.op11_url_filter(spark, sf001).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf001}/pages.parquet')")
    rows = con.execute(f"SELECT page_id, host, path, rule, own_rule, verdict FROM ({U.OP11_SQL})").fetchall()
    assert got == {r[0]: tuple(r[1:]) for r in rows}
    urls = con.execute("SELECT page_id, url FROM pages").fetchall()
    for page_id, url in urls:
        host, path, rule, tier, verdict = expected(url)
        assert got[page_id] == (host, path, rule if tier == 0 else None, rule if tier == 1 else None, verdict)


def test_precedence(spark):
    rules = [("allow", "b.org", "/x"), ("block", "org", "/x/y"), ("block", "c.org", "/"), ("allow", "c.org", "/"),
             ("block", "d.org", "")]
    urls = ["http://b.org/x/yz", "http://c.org/", "http://d.org", "http://a.b.org/x/yzz", "http://e.org/x/yz"]
    got = judged(spark, urls, rules)
    assert [got[i][2] for i in range(5)] == ["b.org/x", "c.org/", "d.org", "b.org/x", "org/x/y"]
    assert [got[i][4] for i in range(5)] == ["allow", "block", "block", "allow", "block"]
    # a lower tier wins whatever its length
    got = judged(spark, urls[:1], [("block", "org", "/")], rules)
    assert got[0][2:] == ("org/", 0, "block")


def test_rules_that_fit_no_url(spark):
    rules = [("block", "a/b", "/"), ("block", "a", "b"), ("block", "a", "/?"), ("block", None, "/"), ("block", "a", None)]
    got = judged(spark, ["http://ab", "http://a/b/", "http://a/?", "http://a/"], rules)
    assert all(v[2] is None and v[4] == "allow" for v in got.values())
    with pytest.raises(Exception, match="MAX_LABELS"):
        judged(spark, ["http://a/"], [("block", "a", "/" + "x" * U.MAX_PATH)])


def test_empty_tables_and_repeated_rows(spark):
    assert judged(spark, [], U.RULES) == {}
    assert judged(spark, ["http://a.org/"], []) == {0: ("a.org", "/", None, None, "allow")}
    twice = pages(spark, ["http://a.org/"]).unionByName(pages(spark, ["http://a.org/"]))
    assert U.judge(twice, U.rule_table(spark, U.RULES), "url", ["page_id"]).count() == 2


def test_very_long_urls(spark):
    urls = ["http://" + "a." * 50_000 + "org/" + "x/" * 50_000, "http://" + "b" * 200_000]
    got = judged(spark, urls, U.RULES)
    assert (got[0][2], got[0][4], got[1][2]) == ("org/", "allow", None)


def test_confirms_full_digests(spark, monkeypatch):
    """Hash prefixes may collide: only whole digests count."""
    real = U._hashed
    monkeypatch.setattr(U, "_hashed", lambda *a: real(*a).withColumn("short", F.lit("00000000")))
    got = judged(spark, URLS, U.RULES, U.OWN_RULES)
    assert got == {i: expected(u) for i, u in enumerate(URLS)}


def test_hot_expression_is_split(spark):
    """A third of the URLs hit one rule: with rules too many to broadcast its partition is split."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(60_000).select(F.col("id").alias("page_id"), F.when(F.col("id") % 3 == 0, "http://a.org/x")
                                         .otherwise(F.concat(F.lit("http://h"), "id", F.lit(".net/"))).alias("url"))
        rules = [("block", f"h{i}.net", "/") for i in range(0, 60_000, 30)] + [("block", "a.org", "/")]
        known = U.compiled(U.rule_table(spark, rules))
        urls = U.stored(hot.repartition(8).select(F.col("page_id").alias("row"), *[
            c.alias(n) for c, n in zip(U.url_parts(F.col("url")), ("host", "path"))]), "hot-urls")
        hits = U.expressions(urls, known).join(known.withColumnRenamed("digest", "whole"), "short").where("digest = whole")
        assert hits.count() == 20_000 + sum(i % 3 != 0 for i in range(0, 60_000, 30))
        done = hits.agg(F.count("row"))
        done.collect()
        assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
