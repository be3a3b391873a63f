"""Small inputs for the tests of the pipeline operators."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n):
    """Invented words, the same for the same seed."""
    r = random.Random(seed)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "é", "ñu", "ß"]
    return ["".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n)]


def text(seed, n):
    return " ".join(words(seed, n))


def docs_df(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], *(r[2:] or ("en", "src1")), len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)
