"""Language identification against a byte-by-byte version, and its accuracy on held-out rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL

from leadlens.llm import language_id as li

from .samples import frame, prose

TRAIN = [(i, prose(i, 60), "en") for i in range(12)] + [(20 + i, prose(i, 60).replace("a", "ä").replace("o", "ö"), "de") for i in range(12)]


def brute_force(rows, text: str, least: int = 2) -> dict[str, float]:
    """Bits of a text under each language, from counts of followers of every context."""
    follow = defaultdict(Counter)
    for _, t, lang in rows:
        data = b"\0" * 3 + t.encode()
        for i in range(3, len(data)):
            for k in range(4):
                follow[lang, data[i - k : i]][data[i]] += 1
    out = {}
    for lang in sorted({r[2] for r in rows}):
        bits, data = 0.0, b"\0" * 3 + text.encode()
        for i in range(3, len(data)):
            for k in (3, 2, 1, 0, -1):
                if k < 0:
                    bits += 8
                    break
                seen = follow[lang, data[i - k : i]]
                n, d = sum(seen.values()), len(seen)
                if n < (least if k >= 2 else 1):
                    continue
                if data[i] in seen:
                    bits += math.log2((n + d) / seen[data[i]])
                    break
                bits += math.log2((n + d) / d)
        out[lang] = bits
    return out


def test_code_lengths_match_brute_force(spark):
    trees = li.fit(frame(spark, TRAIN), sample_rows=100)
    tests = [(100, "amber birch cedar", None), (101, "ämber bïrch ö", None), (102, "Zebra QUIZ 99 ñ", None), (103, prose(77, 400), None)]
    got = {r["doc_id"]: r for r in li.predict(frame(spark, tests), trees, names=("lang_pred", "p", "bits_per_byte")).collect()}
    for i, text, _ in tests:
        want = brute_force(TRAIN, text)
        best = min(want, key=want.get)
        assert got[i]["lang_pred"] == best
        assert got[i]["bits_per_byte"] == pytest.approx(want[best] / len(text.encode()), rel=1e-4)
        assert got[i]["p"] == pytest.approx(1 / sum(2 ** max(-1000, want[best] - b) for b in want.values()), abs=1e-3)


def test_awkward_rows(spark, awkward):
    got = li.language_id(awkward).collect()
    assert len(got) == awkward.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3, 5))
    assert all(r["lang_pred"] != "und" for i, r in by.items() if i in (4, 6, 8, 9, 10))
    assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)


def test_empty_table_and_no_labels(spark, nothing):
    assert li.language_id(nothing).count() == 0
    assert [r["lang_pred"] for r in li.language_id(frame(spark, [(1, "some text", None)])).collect()] == ["und"]


def test_filter_keeps_columns_and_clean_rows(spark, awkward):
    kept = li.known_language(awkward, li.fit(frame(spark, TRAIN)))
    assert kept.schema == awkward.schema
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 4, 6, 6, 7, 9, 10, 11]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = li.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 30 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_model_stays_small_with_many_labels(spark):
    """The model has entries for what each label has seen, not for each label and context, and scores blocks of bounded size."""
    rows = [(i, prose(i, 40 + i % 7) + f" {i % 200:03d}", f"l{i % 200:03d}") for i in range(600)]

    def size(trees):
        return sum(x.nbytes for part in (*trees.escapes, *trees.bits) for x in (part.keys, part.at, part.language, part.value))

    few, many = (li.fit(frame(spark, [r for r in rows if r[2] < last]), sample_rows=100) for last in ("l004", "l999"))
    assert len(many.languages) == 200 and size(many) < 60 * size(few) and size(many) < 50 << 20
    got = li.predict(frame(spark, [(1000, rows[37][1], None)]), many).first()
    assert got["lang_pred"] == rows[37][2]
    assert got["bits_per_byte"] == pytest.approx(brute_force(rows, rows[37][1])[rows[37][2]] / len(rows[37][1]), rel=1e-4)


def test_lengths_are_the_same_when_the_held_ones_are_dropped(spark, monkeypatch):
    trees = li.fit(frame(spark, TRAIN), sample_rows=100)
    data = np.frombuffer("".join(prose(i, 50) for i in range(40)).encode(), np.uint8)
    offsets = np.array([0, 0, 7, len(data) // 2, len(data), len(data)])
    want = li.CodeLengths(trees).of_rows(data, offsets)
    monkeypatch.setattr(li, "BLOCK", 50)
    monkeypatch.setattr(li, "HELD", 200)
    assert np.allclose(li.CodeLengths(trees).of_rows(data, offsets), want) and want[1].min() > 0 and not want[[0, 4]].any()
