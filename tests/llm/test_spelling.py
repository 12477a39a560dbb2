"""Spelling variants against a version that compares every pair of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from leadlens.llm import spelling

from .samples import AWKWARD, frame, prose


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def forms(words, ratio=5):
    found = {w: sorted((-words[x], x) for x in words if near(w, x)) for w in words}
    form = {w: (x[0][1] if x and -x[0][0] >= ratio * words[w] else None) for w, x in found.items()}
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(found[w]), words[form[w]] if form[w] else None))
    return out


def brute(rows):
    words = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return forms({w: n for w, n in words.items() if len(w) >= 6 and n >= 5})


def source(seed, n_docs):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("aeilnorstÉßüx", k=rng.randint(5, 9))) for _ in range(60)]
    words = stems + [s[:i] + rng.choice(["", "a", "Z", "ÿ", "×"]) + s[i + rng.randint(0, 1) :] for s in stems for i in (0, 3, 5)]
    weights = [3 ** rng.randint(0, 6) for _ in words]
    return [(i, rng.choice([" ", "-", "1", "œ"]).join(rng.choices(words, weights, k=200)), "en") for i in range(n_docs)]


def test_same_as_comparing_every_pair(spark):
    rows = source(5, 40) + AWKWARD * 5 + [(99, "Zebraß " * 30 + "ÉéÿÀ×÷" * 300, "x")] * 6
    got = spelling.spelling(frame(spark, rows).repartition(3)).collect()
    want = brute(rows)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert sum(r["form"] is not None for r in got) > 10


def test_blocks_in_many_parts(spark, monkeypatch):
    """One block holds most words and is cut; each pair comes once."""
    monkeypatch.setattr(spelling, "PART_WORDS", 7)
    rng = random.Random(6)
    words = {"".join(rng.choices("ab", k=rng.choice((6, 7)))) for _ in range(120)} | {"aabbcc" + "d" * 30, "aabbcc" + "d" * 29}
    counts = {w: rng.randint(5, 500) for w in words}
    frame_ = spark.createDataFrame(list(counts.items()), "word string, n long")
    pairs = [tuple(sorted((r["word"], r["other"]))) for r in spelling.near_pairs(frame_).collect()]
    assert sorted(pairs) == sorted((a, b) for a in words for b in words if a < b and near(a, b))
    assert {tuple(r) for r in spelling.spelling_forms(frame_).collect()} == forms(counts)


def test_moves_cover_every_edit():
    """Each single edit changes (length, letters of two classes) by one of the moves or its opposite."""
    rng = random.Random(7)
    place = lambda w: (len(w), *[sum(c in k for c in w) for k in spelling.CLASSES])
    moves = set(spelling._MOVES) | {tuple(-x for x in m) for m in spelling._MOVES}
    for _ in range(2000):
        w = "".join(rng.choices("aelnxé", k=7))
        i = rng.randrange(7)
        for other in (w[:i] + w[i + 1 :], w[:i] + rng.choice("aelnxé") + w[i + 1 :], w[:i] + rng.choice("aelnxé") + w[i:]):
            assert tuple(b - a for a, b in zip(place(w), place(other), strict=True)) in moves


def test_checksums_of_runs():
    rng = random.Random(8)
    runs = [rng.randbytes(rng.choice((0, 1, 5, 12, 48, 49, 300))) for _ in range(400)]
    ends = np.cumsum([len(r) for r in runs])
    before = np.array([zlib.crc32(f"{i}:".encode()) for i in range(400)], np.uint32)
    got = spelling.checksums(np.frombuffer(b"".join(runs), np.uint8), ends - [len(r) for r in runs], ends, before)
    assert got.tolist() == [zlib.crc32(f"{i}:".encode() + r) for i, r in enumerate(runs)]


def test_long_chains_end_at_their_root(spark):
    words = {"a" * (6 + i): 5 ** (i + 1) for i in range(11)}
    got = spelling.spelling_forms(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    assert {tuple(r) for r in got} == forms(words) and {r["root"] for r in got} == {"a" * 16}


def test_empty(spark, nothing):
    assert spelling.spelling(nothing).count() == 0
    assert spelling.spelling(frame(spark, [(1, prose(3, 20), "en")])).count() == 0
