"""URL filters by hashed host-suffix and path-prefix expressions.

Each URL is expanded into expressions (a suffix of its host followed by a prefix
of its path). Expressions meet the rules in an equi-join on the first bytes of
their SHA-256; full digests are compared afterwards, so that a collision of the
short hash never decides, and the longest confirmed rule gives the verdict.

Only expressions that a rule could equal are made: suffixes with as many labels
and prefixes with as many characters as some rule has. Verdicts are worked out
once per distinct (host, start of path) and joined back, so a host with a third
of all URLs is reduced before anything meets the rules, and the join back leaves
the URL side free to be split by AQE.

Defined results: a null url, or one without ``://``, has empty host and path; an
empty host fits no rule. Equal rules are one rule; a rule listed as both allow
and block blocks. Among fitting rules of the same total length the one with the
longer host wins. Without a fitting rule the verdict is ``default``. Empty
tables give empty results. Repeated rows stay repeated. Columns ``host``,
``path``, ``rule`` and ``verdict`` of the input are replaced, others are kept.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import scratch

#: Hex digits of the digest that the join uses (4 bytes).
PREFIX_HEX = 8


def rules_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) triples as the rules table of ``judge``."""
    rows = [F.struct(F.lit(h), F.lit(p), F.lit(v)) for v, h, p in rules]
    listed = F.array(*rows).cast("array<struct<rule_host:string,rule_path:string,rule_verdict:string>>")
    return spark.range(1).select(F.inline(listed))


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def _confirmed(keys: DataFrame, rules: DataFrame, labels: list[int], lengths: list[int]) -> DataFrame:
    """The best rule of each (_host, _head): one row per key that has any."""
    parts = F.split("_host", r"\.")
    suffixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in labels]), lambda n: n <= F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("_head")),
        lambda n: F.substring(F.col("_head"), F.lit(1), n),
    )
    expressions = (
        keys.where(F.col("_host") != "")
        .select("_host", "_head", F.explode(suffixes).alias("_suffix"))
        .select("_host", "_head", "_suffix", F.explode(prefixes).alias("_prefix"))
        .withColumn("_full", _digest(F.col("_suffix"), F.col("_prefix")))
        .withColumn("_short", F.substring("_full", 1, PREFIX_HEX))
    )
    hashed = (
        rules.withColumn("_rule_full", _digest(F.col("rule_host"), F.col("rule_path")))
        .withColumn("_short", F.substring("_rule_full", 1, PREFIX_HEX))
    )
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("chars"),
        F.length("rule_host").alias("host_chars"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    return (
        expressions.join(hashed, "_short")
        .where(F.col("_full") == F.col("_rule_full"))
        .groupBy("_host", "_head")
        .agg(F.max(rank).alias("_best"))
    )


@scratch.shielded
def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    ``rules`` has rule_host, rule_path and rule_verdict (allow or block). The
    distinct label counts and path lengths of the rules are read by the driver;
    both are bounded by the length of a URL, not by the number of rules.
    """
    rules = (
        rules.where(F.col("rule_host").isNotNull())
        .withColumn("rule_path", F.coalesce("rule_path", F.lit("")))
        .groupBy("rule_host", "rule_path")
        .agg(F.max("rule_verdict").alias("rule_verdict"))
    )
    shape = rules.agg(
        F.collect_set(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.collect_set(F.length("rule_path")).alias("lengths"),
    ).first()
    labels, lengths = sorted(shape.labels), sorted(shape.lengths)
    pages = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}).drop("rule", "verdict")
    if not labels:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    head = F.substring(F.col("path"), F.lit(1), F.lit(max(lengths)))
    keys = pages.select(F.col("host").alias("_host"), head.alias("_head")).distinct()
    # A table of its own: the planner knows its size, and if it must shuffle, AQE can split a hot host.
    best = scratch.materialise(_confirmed(keys, rules, labels, lengths), "url-verdicts")
    joined = pages.withColumn("_h", head).join(
        best, (F.col("host") == F.col("_host")) & (F.col("_h") == F.col("_head")), "left"
    )
    return joined.withColumns(
        {"rule": F.col("_best.rule"), "verdict": F.coalesce(F.col("_best.verdict"), F.lit(default))}
    ).drop("_h", "_host", "_head", "_best")


#: The rules that the query applies, as (verdict, host, path).
QUERY_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url under ``QUERY_RULES``."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, rules_table(spark, QUERY_RULES)).select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL = """
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url FROM pages
), cut AS (
  SELECT page_id,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM u
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
)
SELECT page_id, host, path,
       (SELECT max_by(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
         WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
       coalesce((SELECT max_by(rule_verdict, length(rule_host || rule_path)) FROM rules
         WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
         'allow') AS verdict
FROM parts
"""
