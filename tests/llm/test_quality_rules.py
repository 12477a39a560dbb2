"""Base counts against Python, distances against numpy, and the awkward rows."""

import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from leadlens.llm import quality_rules as qr

from .samples import AWKWARD, frame, prose


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


TEXTS = [
    "x " * 40, "a b c d e f g h " * 3 + prose(1, 90), prose(2, 100) + "\n" + prose(2, 100), "same line\nsame line\n \n\nsame line\r\n" + prose(3, 50),
    "### $$ %% && || <<>> " + prose(4, 25), "é🎉 ñandú " * 5, "a b c d e f g h a b c d e f g i", " ".join(map(str, range(500))) + " 1 2 3 4 5 6 7 8",
]


def test_base_counts(spark):
    source = [(i, t, "en") for i, t in enumerate(TEXTS)] + [r for r in AWKWARD if r[0]]
    rows = qr.quality_rules(frame(spark, source)).collect()
    got = sorted((r["doc_id"], *tuple(r)[1:7]) for r in rows)
    assert got == sorted((i, *base(t)) for i, t, _ in source)
    assert all(not r["kept"] for r in rows if r["base_failed"])


def test_awkward_rows(spark, awkward, nothing):
    assert qr.quality_rules(awkward).count() == len(AWKWARD)
    assert qr.quality_rules(nothing).count() == 0
    assert qr.quality_rules(awkward.drop("lang")).filter("kept").count() > 0  # nothing to compare with


def test_distances(spark):
    english = [(i, "The cat of the house and a dog in it was on the mat with " + prose(i, 150).lower(), "en") for i in range(30)]
    odd = [(100, " ".join(f"{i}|{i * 7}" for i in range(200)), "en")]
    rows = qr.judged(frame(spark, english + odd)).collect()
    by = {r["doc_id"]: r for r in rows}
    total = np.sum([r["chars"] for r in rows], axis=0)
    for r in rows:
        p, q = np.array(r["chars"]) / sum(r["chars"]), total / total.sum()
        half = lambda a, b: np.sum(np.where(a > 0, 0.5 * a * np.log2(np.where(a > 0, 2 * a / np.where(a > 0, a + b, 1), 1)), 0))
        assert r["char_distance"] == pytest.approx(np.sqrt(half(p, q) + half(q, p)), abs=1e-9)
        assert sum(r["common"]) == r["n_words"]
    assert not by[100]["kept"] and not by[100]["base_failed"] and all(by[i]["kept"] for i in range(30))


def test_no_python_in_the_plan(spark, awkward):
    plan = qr.quality_rules(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_references_are_made_for_every_label(spark):
    """Cyrillic and other Latin documents are compared with their own label, broken ones with any."""
    rng = np.random.default_rng(7)

    def text(letters, n):
        return " ".join("".join(rng.choice(list(letters), rng.integers(3, 9))) for _ in range(n))

    cyrillic = [(i, text("абвгдежзиклмнопрст", 150), "ru") for i in range(20)] + [(20, text("абвгдежзиклмнопрст", 150), None)]
    latin = [(30 + i, text("aeijklmnoprstuvyåäö", 150), "fi") for i in range(20)]
    english = [(60 + i, "The cat of the house and a dog in it was on the mat with " + prose(i, 150).lower(), "en") for i in range(20)]
    odd = [(90, " ".join(f"{i}|{i * 7}" for i in range(200)), "ru")]
    by = {r["doc_id"]: r for r in qr.judged(frame(spark, cyrillic + latin + english + odd)).collect()}
    assert all(r["kept"] for i, r in by.items() if i < 90) and not by[90]["kept"]
    assert all(by[i]["word_distance"] is not None for i in (0, 20, 30, 60))
    only = {r["doc_id"]: r for r in qr.judged(frame(spark, cyrillic)).collect()}
    assert all(r["kept"] and r["word_distance"] is not None for r in only.values())


def test_common_words_are_learned_for_each_label(spark):
    """The most frequent words with a letter, ties by the word; a document without its language's words is far from it."""
    rng = np.random.default_rng(3)
    common = "ja on ei se oli hän että kun joka mutta".split()

    def text(share):
        return " ".join(str(rng.choice(common)) if rng.random() < share else "".join(rng.choice(list("aeijklmnoprstuvyåäö"), 7)) + " |" for _ in range(200))

    finnish = [(i, text(0.5), "fi") for i in range(30)]
    docs = frame(spark, [*finnish, (30, text(0), "fi"), (31, text(0.5), None), (32, "zz aa aa zz bb 7 7 7", "ru"), (33, None, "ru"), (34, None, "sv")])
    assert {"aa", "bb", "zz"} | set(common) <= set(qr.common_words(docs)) and not {"|", "7"} & set(qr.common_words(docs))
    assert qr.common_words(docs.filter("lang = 'ru'"), 1) == ["aa"]
    by = {r["doc_id"]: r for r in qr.judged(docs.filter("doc_id < 32")).collect()}
    assert all(by[i]["kept"] for i in [*range(30), 31]) and not by[30]["kept"] and by[30]["word_distance"] > qr.MOST_WORDS


def test_whole_query_against_sql(spark, awkward, nothing):
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)] + [(50 + i, "The cat of the house and a dog " * 3 + prose(i, 150), ("en", "fi", None)[i % 3]) for i in range(30)]
    for docs in (frame(spark, rows), awkward.select("doc_id", "text", "lang"), nothing.select("doc_id", "text", "lang")):
        got = sorted((tuple(r) for r in qr.quality_rules(docs).collect()), key=str)
        with duckdb.connect() as db:
            documents = pa.table({c: pa.array([r[c] for r in docs.collect()], t) for c, t in (("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()))})
            db.register("documents", documents)
            assert got == sorted(db.sql(qr.QUALITY_SQL).fetchall(), key=str)
