"""URL filters by hashed host-suffix and path-prefix expressions (operator 11, DataFrame functions only).

Every URL is expanded into expressions: a suffix of its host at a dot, followed by a prefix of its path. Only suffixes
and prefixes of the shapes (number of labels, path length) that some rule has are made; the shapes are a small set,
bounded by ``MAX_LABELS`` and ``MAX_PATH``. The first four bytes of an expression's SHA-256 are equi-joined with those
of the rules, the whole digest confirms a hit, and of a URL's confirmed rules one wins: the lowest tier, then the
longest expression, then the longest host, then block before allow.

The rules are broadcast only if Spark finds their table small; otherwise the join shuffles on the hash prefix, where a
hot expression meets one stored rule and its partition is split. Hits are reduced to one per URL before they meet the
URLs again on a row number, so no key of that join is hot.

Defined cases: a null URL, or one without ``://``, has an empty host and an empty path. A rule whose host holds a
``/``, ``?`` or ``#``, or whose path is neither empty nor starts with ``/``, can fit no URL and is left out; so is a
null host or path. A rule of more than MAX_LABELS labels or MAX_PATH code points is an error. Equal rules count once,
and block wins between two of one expression. No rules, or no URLs, are fine. Repeated rows are judged each. Other
columns never take part, whatever their names.
"""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm.common import stored

MAX_LABELS = 127
MAX_PATH = 2048

# ── Fixed values: the rules of the query (action, host, path) ──
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# The method's own, consulted where no rule above fits: top-level domains registered for adult or betting sites.
OWN_RULES = [("block", tld, "/") for tld in ("adult", "bet", "casino", "poker", "porn", "sex", "xxx")]
DEFAULT = "allow"

_RULE_SCHEMA = "tier int, action string, host string, path string"


def rule_table(spark: SparkSession, *tiers: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules of several lists; an earlier list takes precedence."""
    rows = [(tier, *rule) for tier, rules in enumerate(tiers) for rule in rules]
    return spark.createDataFrame(rows, _RULE_SCHEMA)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return lower_ascii(host), path


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _hashed(df: DataFrame, expression: Column, *keep: str) -> DataFrame:
    """``keep`` with the expression's digest and its first four bytes."""
    digest = F.sha2(expression.cast("binary"), 256)
    return (df.select(*keep, digest.alias("hex"))
            .select(*keep, F.substring("hex", 1, 8).alias("short"), F.unhex("hex").alias("digest")))


def compiled(rules: DataFrame) -> DataFrame:
    """Rules that can fit a URL, one row per tier and expression, with shapes and digests; a stored table."""
    host, path = lower_ascii(F.col("host")), F.col("path")
    fits = ~host.rlike("[/?#]") & ((path == "") | path.startswith("/")) & ~path.rlike("[?#]")
    rows = rules.where(fits).select("tier", "action", host.alias("host"), "path")
    rows = (rows.groupBy("tier", "host", "path").agg(F.max(F.col("action") == "block").alias("block"))
            .select("*", _labels(F.col("host")).alias("labels"), F.length("path").alias("path_len"),
                    F.length("host").alias("host_len"), F.concat("host", "path").alias("rule")))
    too_big = F.raise_error(F.concat(F.lit("rule beyond MAX_LABELS or MAX_PATH: "), F.left("rule", F.lit(200))))
    checked = F.when((F.col("labels") > MAX_LABELS) | (F.col("path_len") > MAX_PATH), too_big.cast("int"))
    rows = rows.withColumn("labels", F.coalesce(checked, F.col("labels")))
    keep = ("tier", "block", "labels", "path_len", "host_len", "rule")
    return stored(_hashed(rows, F.col("rule"), *keep), "url-rules")


def expressions(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(row, short, digest) of every expression of every URL whose shape some rule has."""
    shapes = rules.agg(F.collect_set(F.struct("labels", "path_len"))).scalar()
    each = urls.select("row", "host", "path", F.explode(shapes).alias("s")).where(
        (F.col("s.labels") <= _labels(F.col("host"))) & (F.col("s.path_len") <= F.length("path")))
    suffix = F.call_function("substring_index", F.col("host"), F.lit("."), -F.col("s.labels"))
    return _hashed(each, F.concat(suffix, F.left(F.col("path"), F.col("s.path_len"))), "row")


def judge(df: DataFrame, rules: DataFrame, url_col: str = "url", keep: Iterable[str] = (),
          default: str = DEFAULT) -> DataFrame:
    """One row per row of ``df``: the ``keep`` columns, host, path, rule and tier of the winning rule (else null), and
    the verdict: allow or block as that rule says, else ``default``."""
    host, path = url_parts(F.col(f"`{url_col}`"))
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(None).cast("int")
    urls = stored(df.select(F.monotonically_increasing_id().alias("row"), kept.alias("kept"), host.alias("host"),
                            path.alias("path")), "urls")
    known = compiled(rules)
    hits = expressions(urls, known).join(known.withColumnRenamed("digest", "whole"), "short").where("digest = whole")
    order = F.struct((-F.col("tier")).alias("t"), F.length("rule").alias("n"), "host_len", "block", "rule")
    best = hits.groupBy("row").agg(F.max(order).alias("best"))
    return urls.join(best, "row", "left").select(
        *[F.col(f"kept.`{c}`") for c in keep], "host", "path", F.col("best.rule").alias("rule"),
        (-F.col("best.t")).alias("tier"),
        F.when(F.col("best.block"), "block").when(~F.col("best.block"), "allow").otherwise(default).alias("verdict"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    judged = judge(pages, rule_table(spark, RULES, OWN_RULES), "url", ["page_id"])
    base = F.col("tier") == 0
    return judged.select("page_id", "host", "path", F.when(base, F.col("rule")).alias("rule"), "verdict",
                         F.when(~base, F.col("rule")).alias("own_rule"))


def _values(tier: int, rules) -> str:
    return ", ".join(f"({tier}, '{action}', '{host}', '{path}')" for action, host, path in rules)


OP11_SQL = f"""
WITH rules(tier, action, host, path) AS (VALUES {_values(0, RULES)}, {_values(1, OWN_RULES)}),
u AS (
  SELECT row_number() OVER () AS k, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT k, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM u),
fit AS (
  SELECT k, tier, action, rules.host || rules.path AS rule,
         row_number() OVER (PARTITION BY k ORDER BY tier, length(rules.host || rules.path) DESC, length(rules.host) DESC,
                            action DESC) AS nr
  FROM p JOIN rules ON (p.host = rules.host OR ends_with(p.host, '.' || rules.host)) AND starts_with(p.path, rules.path))
SELECT page_id, p.host, p.path, CASE WHEN tier = 0 THEN rule END AS rule,
       coalesce(action, '{DEFAULT}') AS verdict, CASE WHEN tier = 1 THEN rule END AS own_rule
FROM p LEFT JOIN (SELECT * FROM fit WHERE nr = 1) f USING (k)
"""
