"""URL filters: host-suffix and path-prefix expressions joined with rules on short hash prefixes.

A URL is expanded into one expression for each host suffix and path prefix that a rule could have: no suffix has
more labels than the longest rule host, and the prefixes have the lengths that rule paths have. So the expansion
is bounded by the rules, not by the URL. Expressions meet rules by the first bytes of their digests; full digests
then confirm the match, and of the rules that fit a URL the longest wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.once import evaluated
from marketlake.llm.textkeys import LOWER, UPPER

#: (verdict, host, path), as the contract lists them.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Verdict on a URL that no rule fits.
DEFAULT_VERDICT = "allow"
#: Bytes of a digest that are joined on.
PREFIX_BYTES = 4


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """Adds host and path; both are empty where the URL is null or has no ``://``."""
    rest = evaluated(pages.withColumn("rest", F.coalesce(_after_scheme(F.col("url")), F.lit(""))), "rest")
    cut = rest.withColumn("raw_host", F.regexp_extract("rest", "^[^/?#]*", 0))
    return evaluated(
        cut.withColumns({
            "host": F.translate("raw_host", UPPER, LOWER),
            "path": F.regexp_extract(F.substring("rest", F.length("raw_host") + 1, F.length("rest")), "^[^?#]*", 0),
        }).drop("rest", "raw_host"),
        "host", "path",
    )


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(rule, verdict, digest, prefix, weight) of rules given as (verdict, host, path)."""
    rows = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    return _digested(rows.select("verdict", F.concat("host", "path").alias("rule")), "rule").withColumn(
        "weight", F.length("rule")
    )


def _digested(df: DataFrame, column: str) -> DataFrame:
    digest = F.sha2(F.col(column).cast("binary"), 256)
    return evaluated(df.withColumn("digest", digest), "digest").withColumn(
        "prefix", F.substring("digest", 1, 2 * PREFIX_BYTES)
    )


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict), a row for each row of ``pages``.

    A rule fits its host and all subdomains where the URL's path starts with the rule's path; of several the
    longest wins, and no rule gives ``DEFAULT_VERDICT`` and a null ``rule``. Null, empty and odd URLs have an
    empty host and path. Rows with the same id and URL are judged once and returned as often as they occur.
    Other columns are ignored. ``rules`` is a list held by the driver; Spark decides by its size whether it is
    broadcast.
    """
    spark = pages.sparkSession
    labels = max((host.count(".") + 1 for _, host, _ in rules), default=0)
    lengths = sorted({len(path) for _, _, path in rules})
    once = pages.groupBy("page_id", "url").agg(F.count("*").alias("copies"))
    parts = with_host_and_path(once)
    # The last k labels of a host, for every k that a rule's host has; a shorter host gives itself.
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -k) for k in range(1, labels + 1)]))
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
    expressions = (
        parts.select("page_id", "url", "path", F.explode(suffixes).alias("suffix"))
        .select("page_id", "url", "suffix", F.explode(prefixes).alias("start"))
        .where(F.col("start").isNotNull())
        .select("page_id", "url", F.concat("suffix", "start").alias("expression"))
    )
    found = _digested(expressions, "expression").alias("e").join(
        rule_table(spark, rules).alias("r"),
        (F.col("e.prefix") == F.col("r.prefix")) & (F.col("e.digest") == F.col("r.digest")),
    )
    best = found.groupBy("e.page_id", "e.url").agg(
        F.max(F.struct("weight", "r.rule", "r.verdict")).alias("best")
    )
    judged = parts.alias("p").join(
        best.alias("b"),
        F.col("p.page_id").eqNullSafe(F.col("b.page_id")) & F.col("p.url").eqNullSafe(F.col("b.url")), "left",
    )
    return judged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        "p.page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"),
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


SQL = r"""
with rules(verdict, host, path) as (values
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
rest as (
  select page_id, case when instr(coalesce(url, ''), '://') > 0
    then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
cut as (
  select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from rest),
parts as (
  select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from cut),
fits as (
  select p.page_id, p.host, p.path, r.host || r.path as rule, r.verdict,
    row_number() over (partition by p.page_id order by length(r.host || r.path) desc nulls last) as nth
  from parts p left join rules r
    on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fits where nth = 1
"""
