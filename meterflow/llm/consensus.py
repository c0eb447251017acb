"""Main text of pages by container paths that a host's pages agree on.

Each page scores its containers and votes for the generalised tag-class path of the
best one. Votes are counted per (host, path) with partial aggregation, so a host
with a third of all pages is reduced where it is read; the path with the most votes
wins its host. Pages are then read again and the containers on the winning path give
the text; a page without such a container uses its own best one. The winners are a
table of their own, so that the planner knows their size; if they must be shuffled,
the pages are the side that AQE splits.

Defined results: a null or empty html, or one without text, gives an empty text. A
null url belongs to the host ''. Ties of votes go to the higher total score (rounded),
then to the path that sorts first. Rows are judged one by one, so repeated rows repeat
their result, except that every row votes. Other columns are kept; columns named like
those added are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.llm import markup, scratch


def host_of(url: Column) -> Column:
    """The host that votes are counted for; '' without one."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def vote(html: str | None) -> tuple[str | None, float]:
    """The path of the best container of a page and its score."""
    page = markup.parse(html)
    markup.score(page)
    best = markup.best_container(page)
    return (best.path, best.score) if best else (None, 0.0)


def extract(html: str | None, path: str | None) -> str:
    """The text of the containers on ``path``, or of the page's own best container."""
    page = markup.parse(html)
    found = markup.on_path(page, path)
    text = markup.text_of(page, found) if found else ""
    if text:
        return text
    markup.score(page)
    best = markup.best_container(page)
    return markup.text_of(page, [best]) if best else ""


@F.arrow_udf(T.StructType().add("path", T.StringType()).add("score", T.DoubleType()))
def _vote(pages: pa.Array) -> pa.Array:
    paths, scores = zip(*(vote(p.as_py()) for p in pages)) if len(pages) else ((), ())
    return pa.StructArray.from_arrays([pa.array(paths, pa.string()), pa.array(scores, pa.float64())], ["path", "score"])


@F.arrow_udf(T.StringType())
def _extract(pages: pa.Array, paths: pa.Array) -> pa.Array:
    return pa.array([extract(p.as_py(), w.as_py()) for p, w in zip(pages, paths)], pa.string())


def winning_paths(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """(host, path, votes) of the winner of each host."""
    votes = pages.select(host_of(F.col(url)).alias("host"), _vote(F.col(html)).alias("v")).where("v.path IS NOT NULL")
    counted = votes.groupBy("host", F.col("v.path").alias("path")).agg(
        F.count("*").alias("votes"), F.sum(F.col("v.score").cast("decimal(20,3)")).alias("total")
    )
    ranked = counted.groupBy("host").agg(
        F.min(F.struct((-F.col("votes")).alias("votes"), (-F.col("total")).alias("total"), "path")).alias("best")
    )
    return ranked.select("host", "best.path", (-F.col("best.votes")).alias("votes"))


@scratch.shielded
def main_text(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` of the article of each page."""
    winners = scratch.materialise(winning_paths(pages, html, url), "winning-paths").select(
        F.col("host").alias("_host"), F.col("path").alias("_path")
    )
    joined = pages.join(winners, host_of(F.col(url)) == F.col("_host"), "left")
    found = joined.withColumn("_text", _extract(F.col(html), F.col("_path")))
    return found.withColumn("text", F.col("_text")).withColumn("n_chars", F.length("_text").cast("bigint")).drop(
        "_host", "_path", "_text"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "url", "text", "n_chars")
