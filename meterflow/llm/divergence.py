"""Quality rules by the divergence of a text from its language's statistics.

Two histograms of a text are compared with those of its language by the Jensen-Shannon
divergence (base 2, so 0 to 1): its characters by class, and its words over the common
words of the language and the rest. The references come from the whole corpus: every word
of every labelled text is counted per language with partial aggregation. A word is common
if it makes at least ``COMMON_SHARE`` of a language's words, so a language has at most
``1 / COMMON_SHARE`` of them whatever the corpus; only these and the class totals reach
the driver, for the ``MAX_LANGUAGES`` languages with the most words. A text without a label
is compared with the nearest reference; one whose language has no reference (too few words,
or beyond that number) with none, since the nearest foreign one would reject it.

Short texts diverge by chance: a limit grows by ``SLACK`` over the number of words, texts
under ``MIN_WORDS`` words are not judged by divergence, and a language with fewer than
``MIN_REFERENCE_WORDS`` words gives no reference. The word divergence of a text without any
common word, ``blank``, follows from the share of common words in its language and can lie
below the fixed limit; a text must stay below ``BLANK_SHARE`` of it, plus the slack, as well.

All work is in SQL functions on one row at a time; nothing but the word counts shuffles.
Repeated three-word windows are found by their 64-bit hashes.

Defined results: a null text has no words. Texts without a reference to compare with have
null divergences and are kept if the base rules keep them. Repeated rows repeat their
result. Other columns are kept; columns named like those added are replaced. Empty tables
give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import scratch

COMMON_SHARE = 0.005
MAX_LANGUAGES = 64
MIN_WORDS = 50
MIN_REFERENCE_WORDS = 1000
CHARS_LIMIT, CHARS_SLACK = 0.05, 4.0
WORDS_LIMIT, WORDS_SLACK = 0.10, 3.0
#: Share of ``blank`` that is let pass; on sf0.01 it takes no document labelled good, at any length.
BLANK_SHARE = 0.6
#: Repeated windows up to which membership is looked up in a list; more are found by sorting.
LISTED = 64

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
#: Classes of the characters of words; the rest is a class of its own.
CLASSES = {
    "lower": r"[a-z]+",
    "upper": r"[A-Z]+",
    "digit": r"[0-9]+",
    "mark": r"[.,;:!?'\"()-]+",
    "beyond": r"[^\x00-\x7f]+",
}


def words_of(text: Column) -> Column:
    """The words of a text: maximal runs without ASCII white space."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def class_counts(text: Column) -> Column:
    """Characters of each class, then of the rest; ``text`` has no white space."""
    counts = [F.length(text) - _without(text, p) for p in CLASSES.values()]
    rest = F.length(text)
    for c in counts:
        rest = rest - c
    return F.array(*[c.cast("bigint") for c in [*counts, rest]])


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, word, n) over all labelled texts."""
    words = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.explode(words_of(F.col(text))).alias("word"))
    return words.groupBy("lang", "word").agg(F.count("*").alias("n"))


def references(counts: DataFrame) -> list[dict]:
    """Per language its class totals, common words and number of words, largest languages first."""
    totals = (
        counts.select("lang", "n", class_counts(F.col("word")).alias("c"))
        .groupBy("lang")
        .agg(F.sum("n").alias("n_words"), *[F.sum(F.col("n") * F.col("c")[i]).alias(f"c{i}") for i in range(len(CLASSES) + 1)])
        .where(F.col("n_words") >= MIN_REFERENCE_WORDS)
        .orderBy(F.desc("n_words"), "lang")
        .limit(MAX_LANGUAGES)
        .collect()
    )
    if not totals:
        return []
    least = F.create_map(*[F.lit(v) for r in totals for v in (r.lang, COMMON_SHARE * r.n_words)])
    common = counts.where(F.col("lang").isin([r.lang for r in totals])).where(F.col("n") >= least[F.col("lang")])
    found: dict[str, list[tuple[str, int]]] = {}
    for r in common.orderBy("lang", F.desc("n"), "word").collect():
        found.setdefault(r.lang, []).append((r.word, r.n))
    return [
        {
            "lang": r.lang,
            "n_words": r.n_words,
            "classes": [r[f"c{i}"] for i in range(len(CLASSES) + 1)],
            "common": found.get(r.lang, []),
        }
        for r in totals
    ]


def _shares(counts: list[float]) -> Column:
    total = float(sum(counts)) or 1.0
    return F.array(*[F.lit(c / total) for c in counts])


def blank(ref: dict) -> float:
    """The word divergence of a text that holds no common word of this reference."""
    rest = 1 - sum(n for _, n in ref["common"]) / ref["n_words"]
    unseen = (1 - rest) / 2
    return unseen + (math.log2(2 / (1 + rest)) + (rest * math.log2(2 * rest / (1 + rest)) if rest > 0 else 0.0)) / 2


def _reference_array(refs: list[dict]) -> Column:
    rows = []
    for r in refs:
        words = [w for w, _ in r["common"]]
        known = [n for _, n in r["common"]]
        rows.append(
            F.struct(
                F.lit(r["lang"]).alias("lang"),
                F.array(*[F.lit(w) for w in words]).cast("array<string>").alias("common"),
                _shares([*known, r["n_words"] - sum(known)]).alias("words"),
                _shares(r["classes"]).alias("classes"),
                F.lit(blank(r)).alias("blank"),
            )
        )
    return F.array(*rows)


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon divergence of two arrays of shares of equal length."""

    def part(a: Column, b: Column) -> Column:
        def term(x: Column, y: Column) -> Column:
            return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

        return F.aggregate(F.zip_with(a, b, term), F.lit(0.0), lambda s, x: s + x)

    return F.greatest(F.lit(0.0), (part(p, q) + part(q, p)) / 2)


def _shares_of(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda s, x: s + x)
    return F.transform(counts, lambda c: c / F.greatest(total, F.lit(1)))


def repeated_words(docs: DataFrame, words: str, to: str) -> DataFrame:
    """Adds the number of words inside three-word windows that occur twice or more.

    Each step is a projection of its own, because the next ones look into its array.
    """
    docs = docs.withColumn(
        "_h",
        F.transform(
            F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
        ),
    )
    none = F.array().cast("array<bigint>")
    docs = docs.withColumn(
        "_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array("_h")).otherwise(none)
    )
    docs = docs.withColumn("_d", F.array_distinct(F.filter("_s", lambda h, i: (i > 0) & (h == F.get("_s", i - 1)))))
    # few repeated windows are looked up in their list; for many, all windows are sorted with their places
    docs = docs.withColumn(
        "_o",
        F.when(F.size("_d") > LISTED, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    listed = F.filter(
        F.transform("_h", lambda h, i: F.when(F.array_contains("_d", h), i)), lambda i: i.isNotNull()
    )

    def like_next(x: Column, i: Column) -> Column:
        return F.coalesce(x["h"] == F.get("_o", i - 1)["h"], F.lit(False)) | F.coalesce(
            x["h"] == F.get("_o", i + 1)["h"], F.lit(False)
        )

    sorted_out = F.sort_array(F.transform(F.filter("_o", like_next), lambda x: x["i"]))
    starts = (
        F.when(F.size("_d") == 0, F.array().cast("array<int>")).when(F.size("_d") <= LISTED, listed).otherwise(sorted_out)
    )
    count = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )
    # Filters on the result stop here: pulled into the steps below, they would work the arrays out per element.
    barrier = F.when(F.spark_partition_id() >= 0, count.cast("bigint"))
    return docs.withColumn(to, barrier).drop("_h", "_s", "_d", "_o")


def base_columns(text: Column, words: Column) -> dict[str, Column]:
    """The base figures of a text other than the repeated words."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": _without(whole, SPACE).cast("bigint"),
        "n_symbols": (F.length(whole) - _without(whole, SYMBOLS)).cast("bigint"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
    }


def _divergences(refs: list[dict], lang: Column | None) -> Column:
    """The divergences from the language's reference, or from the nearest for a text without a label."""
    every = _reference_array(refs)
    own = F.filter(every, lambda r: r["lang"] == lang) if lang is not None else every
    chosen = F.when(lang.isNull(), every).otherwise(own) if lang is not None else every
    n_common = F.size("_common")

    def compare(r: Column) -> Column:
        counts = F.transform(r["common"], lambda c: n_common - F.size(F.array_remove("_common", c)))
        known = F.aggregate(counts, F.lit(0), lambda s, x: s + x)
        counts = F.concat(counts, F.array(F.size("_w") - known))
        chars = divergence(_shares_of(F.col("_classes")), r["classes"])
        words = divergence(F.transform(counts, lambda c: c / F.greatest(F.size("_w"), F.lit(1))), r["words"])
        return F.struct((chars + words).alias("both"), chars.alias("chars"), words.alias("words"), r["blank"].alias("blank"))

    return F.array_min(F.transform(chosen, compare))


@scratch.shielded
def judge(docs: DataFrame, refs: list[dict], text: str = "text", lang: str | None = "lang") -> DataFrame:
    """``docs`` with the base figures, both divergences, ``base_failed`` and ``kept``."""
    given = docs.columns
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "js_chars", "js_words", "base_failed"]
    added.append("kept")
    work = docs.withColumn("_w", words_of(F.col(text)))
    stripped = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, "")
    vocabulary = sorted({w for r in refs for w, _ in r["common"]})
    work = work.select(
        *[c for c in given if c not in added],
        *[c.alias(name) for name, c in base_columns(F.col(text), F.col("_w")).items()],
        "_w",
        class_counts(stripped).alias("_classes"),
        F.filter("_w", lambda w: w.isin(vocabulary) if vocabulary else F.lit(False)).alias("_common"),
        F.col(lang).alias("_lang") if lang else F.lit(None).cast("string").alias("_lang"),
    )
    if refs:
        work = work.withColumn("_js", _divergences(refs, F.col("_lang")))
    else:
        work = work.withColumn("_js", F.lit(None).cast("struct<both:double,chars:double,words:double,blank:double>"))
    work = repeated_words(work, "_w", "n_repeat_words").withColumns({"js_chars": F.col("_js.chars"), "js_words": F.col("_js.words")})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    words_limit = F.least(F.lit(WORDS_LIMIT), BLANK_SHARE * F.col("_js.blank")) + WORDS_SLACK / F.col("n_words")
    odd = (F.col("js_chars") > CHARS_LIMIT + CHARS_SLACK / F.col("n_words")) | (
        # a language without common words has no blank text to tell from others
        (F.col("js_words") > words_limit) & (F.col("_js.blank") > 0)
    )
    return work.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & ~F.coalesce(odd, F.lit(False))
    ).select(*[c for c in given if c not in added], *added)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and verdict of every document, against references from all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    refs = references(scratch.materialise(word_counts(docs), "word-counts"))
    digits = {c: F.round(c, 6) for c in ("js_chars", "js_words")}
    return judge(docs, refs).drop("text", "lang").withColumns(digits)


_CLASS_SQL = ", ".join(
    f"length({{0}}) - length(regexp_replace({{0}}, '{p.replace(chr(39), chr(39) * 2)}', '', 'g'))" for p in CLASSES.values()
)


def _class_sql(text: str) -> str:
    return f"[{_CLASS_SQL.format(text)}]"


ORACLE_SQL = rf"""
WITH docs AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM docs
), windows AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(0, len(w) - 3)) AS i FROM docs WHERE len(w) >= 3)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, sum(least(3, i - before)) AS n
  FROM (SELECT doc_id, i, lag(i, 1, -3) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM again) GROUP BY doc_id
), base AS (
  SELECT d.doc_id, d.lang, d.w, array_to_string(d.w, '') AS joined, len(d.w) AS n_words,
         length(array_to_string(d.w, '')) AS word_chars,
         length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l.l) - len(list_distinct(l.l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM docs d JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)
), counts AS (
  SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(w) AS word FROM docs WHERE lang IS NOT NULL) GROUP BY lang, word
), totals AS (
  SELECT lang, sum(n) AS n_words FROM counts GROUP BY lang HAVING sum(n) >= {MIN_REFERENCE_WORDS}
  ORDER BY n_words DESC, lang LIMIT {MAX_LANGUAGES}
), common AS (
  SELECT c.lang, c.word, c.n / t.n_words AS q FROM counts c JOIN totals t USING (lang) WHERE c.n >= {COMMON_SHARE} * t.n_words
), rests AS (
  SELECT lang, q, (1 - q) / 2 + (log2(2 / (1 + q)) + CASE WHEN q > 0 THEN q * log2(2 * q / (1 + q)) ELSE 0 END) / 2 AS blank
  FROM (SELECT lang, 1 - sum(q) AS q FROM common GROUP BY lang)
), classes AS (
  SELECT doc_id, {_class_sql("joined")} AS c, word_chars FROM base
), doc_classes AS (
  SELECT doc_id, unnest(list_concat(c, [word_chars - list_sum(c)])) / greatest(word_chars, 1) AS p,
         unnest(generate_series(1, {len(CLASSES) + 1})) AS k FROM classes
), lang_classes AS (
  SELECT lang, k, sum(x) / sum(sum(x)) OVER (PARTITION BY lang) AS q
  FROM (SELECT b.lang, unnest(list_concat(c.c, [c.word_chars - list_sum(c.c)])) AS x,
               unnest(generate_series(1, {len(CLASSES) + 1})) AS k
        FROM classes c JOIN base b USING (doc_id) WHERE b.lang IS NOT NULL)
  GROUP BY lang, k
), compared AS (
  SELECT b.doc_id, t.lang FROM base b JOIN totals t
    ON t.lang = b.lang OR b.lang IS NULL
), chars AS (
  SELECT c.doc_id, c.lang,
         sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
             + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 AS js
  FROM compared c JOIN lang_classes l USING (lang) JOIN doc_classes d ON d.doc_id = c.doc_id AND d.k = l.k
  GROUP BY c.doc_id, c.lang
), doc_words AS (
  SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM docs) GROUP BY doc_id, word
), shares AS (
  SELECT c.doc_id, c.lang, m.q, coalesce(w.n, 0) / greatest(b.n_words, 1) AS p, coalesce(w.n, 0) AS n
  FROM compared c JOIN common m USING (lang) JOIN base b USING (doc_id)
  LEFT JOIN doc_words w ON w.doc_id = c.doc_id AND w.word = m.word
), all_shares AS (
  SELECT doc_id, lang, p, q FROM shares
  UNION ALL
  SELECT s.doc_id, s.lang, (b.n_words - s.n) / greatest(b.n_words, 1) AS p, r.q
  FROM (SELECT doc_id, lang, sum(n) AS n FROM shares GROUP BY doc_id, lang) s JOIN base b USING (doc_id)
  JOIN rests r ON r.lang = s.lang
), words AS (
  SELECT doc_id, lang,
         sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
             + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 AS js
  FROM all_shares GROUP BY doc_id, lang
), js AS (
  SELECT doc_id, arg_min(c.js, c.js + w.js) AS js_chars, arg_min(w.js, c.js + w.js) AS js_words,
         arg_min(r.blank, c.js + w.js) AS blank
  FROM chars c JOIN words w USING (doc_id, lang) JOIN rests r USING (lang) GROUP BY doc_id
), judged AS (
  SELECT b.*, CASE WHEN j.doc_id IS NOT NULL THEN greatest(j.js_chars, 0) END AS jc,
         CASE WHEN j.doc_id IS NOT NULL THEN greatest(j.js_words, 0) END AS jw, j.blank,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM base b LEFT JOIN js j USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, round(jc, 6) AS js_chars, round(jw, 6) AS js_words, base_failed,
       NOT base_failed AND NOT coalesce(jc > {CHARS_LIMIT} + {CHARS_SLACK} / n_words
                                        OR (jw > least({WORDS_LIMIT}, {BLANK_SHARE} * blank) + {WORDS_SLACK} / n_words
                                            AND blank > 0), false) AS kept
FROM judged
"""
