"""Secret scans: fixed patterns, and guess cost of values in a credential context.

Base patterns give the spans ``assign``, ``access`` and ``hex``. The method adds
``guess`` spans: a value that follows a credential word (password, pwd, passphrase,
bearer, client secret ...) and an assignment sign, or "is", and needs at least
``MIN_COST`` log10 guesses by the segmentation of ``guesscost``. Words are ranked by how
many documents of the corpus hold them (``ranked_words``, the ``RANKED`` most frequent
ones behind the listed passwords), so that "password: required" costs little; words are
counted over all documents, equal texts once. After "is" or "bearer", where prose may go
on, a value of letters alone is none. A value ends at white space or, if a quote opens it, at that quote;
closing brackets and marks that belong to the sentence around are not part of it. A guess
span that lies inside a base span is not repeated.

Each text is scanned whole, in one pass over its row; offsets are code points, the
end is exclusive. Memory is one Arrow batch.

Defined results: null and empty texts have no spans. Rows are independent, so
repeated rows repeat their result; other columns are kept. An empty table gives an
empty table. A column named like the one added is replaced.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import scratch
from meterflow.llm.guesscost import LISTED, LONGEST_WORD, Ranks, guess_cost

MIN_COST = 8.0
MASK = "[SECRET]"
#: Fixed patterns of the base spans and the least lengths of what they match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE_CHARS = 6
KINDS = ("assign", "access", "hex", "guess")

#: Words of the corpus that are ranked.
RANKED = 20_000
#: Different texts that a ranked word is in, at least, told by the 64 values of six bits of
#: their hashes: a secret is not common for being repeated in a text or in its copies.
LEAST_TEXTS = 8
#: Words that make what follows a credential, and how the value is attached.
CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code)|pwd|(?:client|app)?[_-]?secret|token|api[_-]?key"""
    r"""|(?:access|private|auth)[_-]?key|credentials?|bearer|login)["']?"""
    r"""[\x20\t]*(:=|=>|[:=]|(?<=[\x20\t])is(?=[\x20\t])|(?<=bearer)(?=[\x20\t]))[\x20\t]*"""
    r"""(?:(["'`])([^\s"'`]{6,}?)\2|["'`]?([^\s"'`]{6,}))""",
    re.I | re.A,
)
BRACKETS = {")": "(", "]": "[", "}": "{", ">": "<"}
HINTS = ("passw", "passp", "passc", "pwd", "secret", "token", "key", "credential", "bearer", "login")
SPAN_TYPE = "array<struct<kind:string,start:int,end:int,log10_guesses:double>>"
_ARROW_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("log10_guesses", pa.float64())])
)


def trimmed(value: str) -> str:
    """A value without the closing brackets that nothing in it opened, and the marks that end a sentence."""
    value = value.split("</", 1)[0]  # markup begins where an end tag does
    end, surplus = len(value), {shut: value.count(shut) - value.count(opened) for shut, opened in BRACKETS.items()}
    while end and (value[end - 1] in ".,;:!?" or surplus.get(value[end - 1], 0) > 0):
        end -= 1
        if value[end] in surplus:
            surplus[value[end]] -= 1
    return value[:end]


def spans_of(text: str | None, min_cost: float = MIN_COST, ranks: Ranks = LISTED) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, log10 guesses of a guess span) by start, then kind as listed."""
    if not text:
        return []
    found = [("hex", *m.span(), None) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [("access", *m.span(), None) for m in ACCESS.finditer(text)]
    low = text.lower()
    if any(hint in low for hint in HINTS):
        found += [("assign", *m.span(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE_CHARS]
        base = [(s, e) for _, s, e, _ in found]
        for m in CONTEXT.finditer(text):
            start = m.start(3) if m[2] else m.start(4)
            value = m[3] if m[2] else trimmed(m[4])
            if not m[2] and len(value) > 2 and BRACKETS.get(value[-1]) == value[0]:  # brackets around the value
                start, value = start + 1, value[1:-1]
            end = start + len(value)
            prose = m[1].lower() in ("is", "") and value.isalpha()
            if len(value) >= 6 and not prose and not any(s <= start and end <= e for s, e in base):
                cost = guess_cost(value, ranks)
                if cost >= min_cost:
                    found.append(("guess", start, end, cost))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def ranked_words(docs: DataFrame, text: str = "text", most: int = RANKED) -> list[str]:
    """The words (three ASCII letters or more, lower case) that most documents hold, the most frequent first.

    Counted over all documents with partial aggregation. Numbers of words by the power of two of
    their frequency say where the most frequent ones end, so that tasks send about twice ``most``
    words to the driver in all, however many tasks there are.
    """
    whole = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(text), F.lit(64)).cast("int"))
    words = docs.select(F.explode(F.array_distinct(F.split(whole, "[^a-z]+"))).alias("word"), bit.alias("bit"))
    words = words.where(F.length("word").between(3, LONGEST_WORD))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.bit_or("bit").alias("bits"))
    counts = scratch.materialise(counts.where(F.bit_count("bits") >= LEAST_TEXTS).select("word", "n"), "word-counts")
    levels = counts.groupBy(F.floor(F.log2("n")).alias("level")).count().orderBy(F.desc("level")).collect()
    least, seen = 1, 0
    for row in levels:
        least, seen = 1 << row.level, seen + row["count"]
        if seen >= most:
            break
    return [r.word for r in counts.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(most).collect()]


@scratch.shielded
def find_secrets(
    docs: DataFrame, text: str = "text", to: str = "secret_spans", min_cost: float = MIN_COST, ranks: Ranks | None = None
) -> DataFrame:
    """``docs`` with the array of spans of each text; words are ranked by these documents unless ``ranks`` is given."""
    ranks = ranks or Ranks(ranked_words(docs, text))

    @F.arrow_udf(SPAN_TYPE)
    def scan(texts: pa.Array) -> pa.Array:
        names = ("kind", "start", "end", "log10_guesses")
        return pa.array(
            [[dict(zip(names, span)) for span in spans_of(t.as_py(), min_cost, ranks)] for t in texts], _ARROW_TYPE
        )

    return docs.withColumn(to, scan(F.col(text).cast("string")))


def joined_spans(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of these kinds, comma-joined in their order."""
    wanted = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(wanted, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """``text`` with every span, overlapping ones together, replaced by ``mask``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(done: Column, span: Column) -> Column:
        fresh = span["start"] >= done["at"]
        gap = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        return F.struct(
            F.when(fresh, F.concat(done["out"], gap, F.lit(mask))).otherwise(done["out"]).alias("out"),
            F.greatest(done["at"], span["end"]).alias("at"),
        )

    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(spans, start, step, lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))
    )


@scratch.shielded
def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the secrets masked in ``text`` and ``n_chars``, if present, renewed."""
    found = find_secrets(docs, text, "_spans")
    out = found.withColumn(text, masked(F.col(text), F.col("_spans")))
    if "n_chars" in docs.columns:
        out = out.withColumn(
            "n_chars", F.when(F.size("_spans") == 0, F.col("n_chars")).otherwise(F.length(text).cast("bigint"))
        )
    return out.drop("_spans")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of every document and the digest of its base spans."""
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    spans = F.col("secret_spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        count("guess").alias("n_guess"),
        F.sha2(joined_spans(spans, KINDS[:3]), 256).alias("base_sha256"),
        joined_spans(spans).alias("spans"),
    )
