"""Mixes of sources: exact targets, schedules of low discrepancy, words taken of every document."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from leadlens.llm import mixing

from .samples import AWKWARD, frame, prose


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(3, 1, 2)):
    """Raised source by source: those over their cap get it, the others share what is left."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, capped = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        left, open_ = total - 2 * sum(sizes[s] for s in capped), [s for s in order if s not in capped]
        shared = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_} if open_ else {}
        over = {s for s in shared if shared[s] > 2 * sizes[s]}
        if not over:
            return {s: float(shared.get(s, 2 * sizes[s])) for s in order}
        capped |= over


def check(rows, got, tolerance):
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += n_words(t)
    want = targets(dict(sizes))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"]) for r in got) == sorted((i is not None, i or 0, n_words(t)) for i, t, _ in rows)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    taken = Counter()
    for r in got:
        source = next(s for s in want if abs(want[s] - r["target"]) < 1e-9 and sizes[s] == r["source_size"])
        taken[source] += r["taken"]
    for s in want:
        assert abs(taken[s] - want[s]) <= tolerance * max(1, sizes[s]), (s, taken[s], want[s])


def test_targets_and_words_taken(spark):
    rows = [(i, prose(i, 3 + 7 * i % 90), ["a", "b", None, "é", "Z"][min(4, i % 11 % 5)]) for i in range(400)]
    docs = spark.createDataFrame([(i, t, s, 1) for i, t, s in rows], "doc_id long, text string, source string, size int").repartition(5)
    got = mixing.mixing(docs).collect()
    check(rows, got, 0.01)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mixing(docs.repartition(2)).collect()))  # reruns agree


def test_a_source_of_few_words_and_sources_at_their_caps(spark):
    rows = [(i, prose(i, 200), "big") for i in range(30)] + [(100, "one", "a"), (101, "two words", "b"), (102, None, "c"), (103, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in mixing.mixing(docs).collect()}
    check(rows, list(got.values()), 0.01)
    assert got[100]["taken"] == 2 and got[101]["taken"] == 4 and got[102]["taken"] == 0 and got[103]["target"] == 0


def test_awkward_rows_and_copies(spark, awkward):
    rows = [(i, t, "s") for i, t, _ in AWKWARD]
    check(rows, mixing.mixing(awkward).collect(), 0.01)
    copies = [(7, "the same words again", "s")] * 2500 + [(None, "no id", "s")] * 1200 + [(i, "other words", "t") for i in range(50)]
    check(copies, mixing.mixing(spark.createDataFrame(copies, "doc_id long, text string, source string")).collect(), 0.01)


def test_empty(spark, nothing):
    assert mixing.mixing(nothing).count() == 0
    row = mixing.mixing(frame(spark, [(1, None, "en")])).first()
    assert (row["size"], row["source_size"], row["target"], row["taken"]) == (0, 0, 0.0, 0)


@pytest.mark.parametrize("below", [0, 1, 37, 64, 100, 128])
def test_ranks_are_counts_of_reversed_numbers(below):
    numbers = mixing.reverse(np.arange(below, dtype=np.int64), 7)
    slots = np.arange(128, dtype=np.int64)
    assert mixing.earlier(slots, below, 7).tolist() == [int((numbers < s).sum()) for s in slots]


def test_schedule_is_even_everywhere(spark, monkeypatch):
    """Slots of a source are ranked gaplessly, pieces of it make no difference, and every prefix holds its share."""
    monkeypatch.setattr(mixing, "SLOTS_PER_PIECE", 50)
    counts = {"a": 300, "b": 20, None: 123, "d": 0}
    lo, rows = 0, []
    for s, n in counts.items():
        rows.append((s, lo, n, 100))
        lo += n
    got = mixing.schedule(spark.createDataFrame(rows, "source string, lo long, slots long, blocks long"), 9).collect()
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append((r["rank"], r["slot"], r["block"]))
    for s, n in counts.items():
        ranked = sorted(by[s])
        assert [r for r, *_ in ranked] == list(range(n)) and [x for _, x, _ in ranked] == sorted(x for _, x, _ in ranked)
        assert all(b == r % 100 for r, _, b in ranked)
        for r, slot, _ in ranked:
            assert abs(r - n * slot / 512) <= 10
    assert len({r["slot"] for r in got}) == len(got) == sum(counts.values())


def test_the_mix_covers_each_line_block_by_block(spark):
    rows = [(i, prose(i, 1 + 13 * i % 300), "ab"[i % 3 // 2]) for i in range(60)]
    lines, mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    begin = {r["doc_id"]: r for r in lines.collect()}
    seen = defaultdict(list)
    for r in mixed.collect():
        assert r["words"] > 0 and r["start"] + r["words"] <= r["size"]
        seen[r["source"], r["slot"]].append((begin[r["doc_id"]]["begin"] + r["start"], r["words"]))
    for (source, _), pieces in seen.items():  # the pieces of a slot are one stretch of the line, as long as any other
        pieces.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:], strict=False))
        line = next(x for x in begin.values() if x["source"] == source)
        assert abs(sum(n for _, n in pieces) - line["source_size"] / line["blocks"]) < 1
