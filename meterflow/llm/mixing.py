"""Mixing sources to target weights by a hierarchical token budget.

The leaves of a domain-language-source tree hold documents. A budget of tokens goes down
the tree: the children of a node share its budget by their weights, but none gets more than
its leaves can give in ``max_epochs`` passes. What a child can't take goes to its siblings
by their weights; only what a whole subtree can't take comes back to the level above, because
a node's limit is the sum below it. Sharing b among children with weights w and limits c is
the level t at which the sum of min(c, t w) is b, found by one ordered running sum.

Each leaf then selects whole epochs and, of the last, a prefix of its documents in an order
seeded by the epoch, up to the document that fills its budget. The order is a hash of
(seed, epoch, text, doc_id). To find the prefix without ordering a leaf in one place,
the leaf's documents are summed in ``BUCKETS`` ranges of the hash; ranges below the one where
the budget ends are taken whole, and only that range is ordered.

Weights of a node that has none are 1 among its siblings. Tokens are words (runs without white
space); a text without one counts 0.

Defined results: a null domain, language or source is the branch 'unknown'. Null and empty
texts have 0 tokens and are taken if they come before the end of the prefix; in a leaf without
tokens all are taken once if it has any budget or weight. Rows that tie in the hash (repeated
rows) are taken or left together. Weights below 0 count as 0; if all siblings have weight 0
they share evenly. A leaf without budget gives no rows. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.llm import scratch

LEVELS = ("domain", "language", "source_name")
BUCKETS = 4096
MAX_EPOCHS = 4
#: Share of all tokens that the query's mixture has, its weights and its seed.
BUDGET_SHARE = 0.5
SEED = 17
QUERY_WEIGHTS = {
    ("even",): 3.0,
    ("odd",): 1.0,
    ("even", "en"): 4.0,
    ("even", "de"): 2.0,
    ("even", "fr"): 2.0,
    ("even", "es"): 8.0,
    ("odd", "en"): 1.0,
    ("odd", "de"): 12.0,
}


def tokens_of(text: Column) -> Column:
    """Words of a text: runs of characters other than ASCII white space."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("bigint")


def share_out(children: DataFrame, parents: list[str]) -> DataFrame:
    """Adds ``budget`` to children with ``parent_budget``, ``weight`` and ``capacity``.

    The window runs over the children of one node: nodes of the tree, never documents.
    """
    siblings = Window.partitionBy(*parents)
    children = children.withColumn("w", F.greatest(F.col("weight"), F.lit(0.0)))
    children = children.withColumn("w", F.when(F.sum("w").over(siblings) > 0, F.col("w")).otherwise(1.0))
    children = children.withColumn("full_at", F.when(F.col("w") > 0, F.col("capacity") / F.col("w")))
    upto = siblings.orderBy(F.col("full_at").asc_nulls_last(), "w", "child").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    taken = F.sum("capacity").over(upto) - F.col("capacity")
    open_w = F.sum("w").over(siblings) - F.sum("w").over(upto) + F.col("w")
    children = children.withColumn("level", F.when(open_w > 1e-12, (F.col("parent_budget") - taken) / open_w))
    # of the levels that don't fill their child, the first holds; later ones are lower
    reach = F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(siblings)
    filled = F.when(reach.isNull(), F.col("capacity")).otherwise(F.least(F.col("capacity"), reach * F.col("w")))
    filled = F.when(F.col("w") > 0, F.greatest(filled, F.lit(0.0))).otherwise(0.0)
    # weightless children take only what all the others together can't
    children = children.withColumn("budget", filled)
    rest = F.col("parent_budget") - F.sum("budget").over(siblings)
    spare = F.sum(F.when(F.col("w") == 0, F.col("capacity")).otherwise(0.0)).over(siblings)
    extra = F.when((F.col("w") == 0) & (spare > 0), F.least(F.lit(1.0), F.greatest(rest, F.lit(0.0)) / spare) * F.col("capacity"))
    return children.withColumn("budget", F.col("budget") + F.coalesce(extra, F.lit(0.0))).drop("w", "full_at", "level")


def weight_of(path: Column, weights: Mapping[tuple, float]) -> Column:
    """The weight of a node by its path joined with ``\\x1f``; 1 if it has none."""
    if not weights:
        return F.lit(1.0)
    table = F.create_map(*[F.lit(v) for k, w in weights.items() for v in ("\x1f".join(k), float(w))])
    return F.coalesce(F.try_element_at(table, path), F.lit(1.0))


def leaf_budgets(leaves: DataFrame, total: Column, weights: Mapping[tuple, float], max_epochs: int) -> DataFrame:
    """``leaves`` (the three levels and tokens) with ``budget``: shares handed down level by level."""
    leaves = leaves.withColumn("capacity", (F.col("tokens") * max_epochs).cast("double"))
    budgets = leaves.agg(F.least(total, F.coalesce(F.sum("capacity"), F.lit(0.0))).alias("parent_budget"))
    for depth in range(1, len(LEVELS) + 1):
        path, above = list(LEVELS[:depth]), list(LEVELS[: depth - 1])
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumns(
            {"weight": weight_of(F.concat_ws("\x1f", *path), weights), "child": F.col(path[-1])}
        )
        nodes = nodes.join(budgets, above) if above else nodes.crossJoin(F.broadcast(budgets))
        budgets = share_out(nodes, above or [F.lit(0)]).select(*path, F.col("budget").alias("parent_budget"))
    return leaves.join(budgets, list(LEVELS)).withColumnRenamed("parent_budget", "budget")


def _order(seed: int, epoch: Column, text: Column, doc_id: Column) -> Column:
    """A hash from 0 to 2^60 that orders the documents of an epoch."""
    parts = [F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary"))]
    return F.conv(F.substring(F.md5(F.concat_ws("\x1f", *parts).cast("binary")), 1, 15), 16, 10).cast("bigint")


@scratch.shielded
def mix(
    docs: DataFrame,
    domain: Column,
    weights: Mapping[tuple, float],
    budget_share: float = BUDGET_SHARE,
    budget_tokens: int | None = None,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """The selected rows of ``docs`` with ``domain``, ``n_tokens`` and ``n_epochs`` (times selected).

    The budget is ``budget_tokens``, or ``budget_share`` of all tokens.
    """
    unknown = F.lit("unknown")
    names = {
        "_domain": F.coalesce(domain.cast("string"), unknown),
        "_language": F.coalesce(F.col(lang).cast("string"), unknown),
        "_source": F.coalesce(F.col(source).cast("string"), unknown),
    }
    leaf = list(names)
    rows = docs.withColumns({**names, "_tokens": tokens_of(F.col(text))})
    sizes = scratch.materialise(
        rows.groupBy(*[F.col(c).alias(n) for c, n in zip(leaf, LEVELS)]).agg(
            F.sum("_tokens").alias("tokens"), F.count("*").alias("docs")
        ),
        "leaves",
    )
    total = F.lit(float(budget_tokens)) if budget_tokens is not None else F.lit(budget_share) * F.sum("tokens")
    shares = leaf_budgets(sizes, total, weights, max_epochs)
    # budgets in thousandths of a token, so that the last digit of a sum decides nothing
    shares = shares.withColumn("budget", F.round("budget", 3))
    passes = F.floor(F.when(F.col("tokens") > 0, F.col("budget") / F.col("tokens")).otherwise(0.0))
    shares = shares.withColumns(
        {"_full": F.when(F.col("tokens") > 0, passes).otherwise(1).cast("int")}
    ).withColumn("_rest", F.round(F.col("budget") - F.col("_full") * F.col("tokens"), 3))
    shares = scratch.materialise(
        shares.where((F.col("budget") > 0) | (F.col("tokens") == 0)).select(
            *[F.col(n).alias(f"{c}_leaf") for c, n in zip(leaf, LEVELS)], "_full", "_rest"
        ),
        "budgets",
    )
    on = [F.col(c) == F.col(f"{c}_leaf") for c in leaf]
    placed = rows.join(shares, on).withColumn(
        "_place", _order(seed, F.col("_full"), F.col(text), F.col("doc_id"))
    )
    placed = placed.withColumn("_bucket", F.shiftright("_place", 60 - BUCKETS.bit_length() + 1))
    sums = placed.where("_rest > 0").groupBy(*leaf, "_rest", "_bucket").agg(F.sum("_tokens").alias("t"))
    running = Window.partitionBy(*leaf).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (
        sums.withColumn("before", F.sum("t").over(running) - F.col("t"))
        .where(F.col("before") < F.col("_rest"))
        .groupBy(*leaf)
        .agg(F.max("_bucket").alias("_end"), F.max("before").alias("_before"))
    )
    ends = scratch.materialise(ends.select(*[F.col(c).alias(f"{c}_leaf") for c in leaf], "_end", "_before"), "prefix-ends")
    ended = placed.join(ends.withColumnsRenamed({f"{c}_leaf": f"{c}_e" for c in leaf}), [F.col(c) == F.col(f"{c}_e") for c in leaf], "left")
    whole = ended.withColumn("_last", F.coalesce(F.col("_bucket") < F.col("_end"), F.lit(False)))
    within = (
        Window.partitionBy(*leaf).orderBy("_place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ordered = whole.where("_bucket = _end").withColumn("_sum", F.sum("_tokens").over(within))
    same = Window.partitionBy(*leaf, "_place")
    ordered = ordered.withColumn("_own", F.sum("_tokens").over(same)).withColumn(
        "_last", F.col("_before") + F.col("_sum") - F.col("_own") < F.col("_rest")
    )
    given = [c for c in docs.columns if c not in ("domain", "n_tokens", "n_epochs")]
    out = [
        *given,
        F.col("_domain").alias("domain"),
        F.col("_tokens").alias("n_tokens"),
        (F.col("_full") + F.col("_last").cast("int")).alias("n_epochs"),
    ]
    chosen = whole.where("_end IS NULL OR _bucket <> _end").select(*out).unionByName(ordered.select(*out))
    return chosen.where("n_epochs > 0")


def domain_of(source: Column) -> Column:
    """The query's domains: sources by the parity of the number in their name."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]+)$", 1)
    return F.when(number == "", "other").when(F.substring(number, -1, 1).isin(*"02468"), "even").otherwise("odd")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the query's mixture selects, and how often."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return mix(docs, domain_of(F.col("source")), QUERY_WEIGHTS).select(
        "doc_id", "domain", "lang", "source", "n_tokens", "n_epochs"
    )


def _level_sql(depth: int) -> str:
    """Shares of the nodes of one level; weights are above 0 here."""
    path = ", ".join(LEVELS[:depth])
    above = ", ".join(LEVELS[: depth - 1])
    name = " || chr(31) || ".join(LEVELS[:depth])
    part = f"PARTITION BY {above}" if above else ""
    link = f"JOIN budgets{depth - 1} USING ({above})" if above else "CROSS JOIN budgets0"
    return f"""
, nodes{depth} AS (
  SELECT n.*, parent_budget, coalesce((SELECT w FROM weights WHERE node = {name}), 1.0) AS w, {LEVELS[depth - 1]} AS child
  FROM (SELECT {path}, sum(capacity) AS capacity FROM leaves GROUP BY {path}) n {link}
), open{depth} AS (
  SELECT *, capacity / w AS full_at,
         sum(capacity) OVER upto - capacity AS taken, sum(w) OVER ({part}) - sum(w) OVER upto + w AS open_w
  FROM nodes{depth} WINDOW upto AS ({part} ORDER BY capacity / w, w, child ROWS UNBOUNDED PRECEDING)
), reach{depth} AS (
  SELECT *, max(CASE WHEN (parent_budget - taken) / open_w <= full_at THEN (parent_budget - taken) / open_w END)
              OVER ({part}) AS reach FROM open{depth}
), budgets{depth} AS (
  SELECT {path}, CASE WHEN reach IS NULL THEN capacity ELSE greatest(0, least(capacity, reach * w)) END AS parent_budget
  FROM reach{depth}
)"""


_WEIGHTS_SQL = ", ".join(f"('{"', '".join(k)}', {w})" if len(k) == 1 else f"('{k[0]}' || chr(31) || '{k[1]}', {w})" for k, w in QUERY_WEIGHTS.items())

ORACLE_SQL = (
    rf"""
WITH weights(node, w) AS (VALUES {_WEIGHTS_SQL}
), docs AS (
  SELECT doc_id, text, lang, source,
         CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) = '' THEN 'other'
              WHEN right(source, 1) IN ('0', '2', '4', '6', '8') THEN 'even' ELSE 'odd' END AS domain,
         coalesce(lang, 'unknown') AS language, coalesce(source, 'unknown') AS source_name,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
  FROM documents
), leaves AS (
  SELECT domain, language, source_name, sum(tokens) AS tokens, CAST(sum(tokens) * {MAX_EPOCHS} AS DOUBLE) AS capacity
  FROM docs GROUP BY ALL
), budgets0 AS (
  SELECT least({BUDGET_SHARE} * sum(tokens), sum(capacity)) AS parent_budget FROM leaves
)"""
    + "".join(map(_level_sql, (1, 2, 3)))
    + rf""", passes AS (
  SELECT domain, language, source_name, tokens, round(parent_budget, 3) AS budget,
         CASE WHEN tokens > 0 THEN floor(round(parent_budget, 3) / tokens) ELSE 1 END AS epochs
  FROM leaves JOIN budgets3 USING (domain, language, source_name)
), placed AS (
  SELECT d.*, CAST(p.epochs AS INTEGER) AS epochs, round(p.budget - p.epochs * p.tokens, 3) AS rest,
         substr(md5('{SEED}' || chr(31) || CAST(CAST(p.epochs AS INTEGER) AS VARCHAR) || chr(31)
                    || coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || md5(coalesce(text, ''))), 1, 15) AS place
  FROM docs d JOIN passes p USING (domain, language, source_name) WHERE p.budget > 0 OR p.tokens = 0
), summed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, language, source_name ORDER BY place RANGE UNBOUNDED PRECEDING)
            - sum(tokens) OVER (PARTITION BY domain, language, source_name, place) AS before FROM placed
)
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS n_tokens,
       CAST(epochs + CASE WHEN before < rest THEN 1 ELSE 0 END AS INTEGER) AS n_epochs
FROM summed WHERE epochs + CASE WHEN before < rest THEN 1 ELSE 0 END > 0
"""
)
