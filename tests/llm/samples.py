"""Small documents with every awkward row, shared by the tests of the llm operators."""

from __future__ import annotations

import random

WORDS = "amber birch cedar delta ember fjord grove heath inlet jetty knoll larch mesa north ocean pine quay ridge shore tarn".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, id string, _id long, spans string, rules int, key int"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + ("." if rng.random() < 0.1 else "") for _ in range(n))


def frame(spark, rows, schema: str = SCHEMA):
    """Rows of (doc_id, text, lang) with further columns whose names operators also use."""
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), 0.5, "x", "y", 7, "z", 3, 4) for i, t, lang in rows], schema)


#: NULL in each column, empty and blank texts, a very long one, repeated rows and repeated texts.
AWKWARD = [
    (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "A.", "en"), (5, "12 345", "de"), (None, "No id here at all.", "en"),
    (None, None, None), (6, prose(1, 300), "en"), (7, prose(1, 300), "en"), (6, prose(1, 300), "en"), (8, "x" * 200_000, "fr"),
    (9, prose(2, 40_000), "de"), (10, "Größe Çà é 🎉 naïve œuvre", "fr"), (11, "ab\r\ncd\x0bef\x0cgh", "es"),
]
