"""Small tables with the awkward cases that every operator must define."""

import datetime as dt
import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _key string, note date"
PAGES = "page_id long, url string, html string, _host string, extra int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n, vocabulary=400):
    """``n`` words drawn from an invented vocabulary, in sentences."""
    rng = random.Random(seed)
    parts = ["an", "the", "er", "in", "ou", "re", "st", "ly", "ti", "ha", "wh", "ble"]
    made = random.Random(5)
    known = ["".join(made.choice(parts) for _ in range(made.randint(1, 4))) for _ in range(vocabulary)]
    words = [rng.choice(known) for _ in range(n)]
    return " ".join(w + ("." if rng.random() < 0.08 else "") for w in words)


def docs(spark, rows):
    """Documents with an extra column and one whose name begins with an underscore."""
    full = []
    for row in rows:
        doc_id, text, *rest = row
        lang, source = (rest + [None, None])[:2]
        full.append((doc_id, text, lang, source, None if text is None else len(text), "k", dt.date(2024, 1, 1)))
    return spark.createDataFrame(full, DOCS)


def awkward(spark):
    """Nulls in every column, empty and blank texts, a very long text, ties and repeated rows."""
    same = prose(1, 120)
    rows = [
        (1, None, None, None),
        (2, "", "en", "src1"),
        (3, " \n\t ", "en", "src1"),
        (None, prose(2, 90), None, "src2"),
        (5, same, "en", "src3"),
        (5, same, "en", "src3"),
        (6, same, "de", "src3"),
        (7, "two words", "en", None),
        (8, prose(3, 60_000), "en", "src4"),
        (9, "1234 5678 %%% ###", "fr", "src5"),
    ]
    return docs(spark, rows)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", 1) for r in rows], PAGES)


def no_rows(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


def words(text):
    return WORD.findall(text or "")
