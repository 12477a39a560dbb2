"""Phrase collocations against a version that counts every sequence."""

import random
import re
from collections import Counter

import pytest

from leadlens.llm import phrases

from .samples import AWKWARD, frame


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def brute(rows, top=2000, least=10, share=50):
    counts = {}
    for _, text, lang in rows:
        found = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                found.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, f in counts.items():
        candidates = [p for p in f if len(p) > 1 and f[p] >= least]
        longer = [p for p in candidates if len(p) == 3]
        holders = Counter()
        for p in longer:
            for pair in (p[:2], p[1:]):
                holders[pair] = max(holders[pair], f[p])
        scored = []
        for p in candidates:
            if len(p) == 2 and p in holders and 100 * holders[p] >= share * f[p]:
                continue
            cuts = [(10**6 * f[p] ** 2 // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            scored.append((-score, -f[p], " ".join(p).encode(), left, right))
        n = sum(c for p, c in f.items() if len(p) == 1)
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def texts(seed, n_docs, lang):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(40)] + ["é", "Ü", "x y", "\x1f"]
    weights = [1 / (i + 1) for i in range(len(words))]
    fixed = ["new york city", "In spite of", "per cent", "San Marino", "a b"]
    rows = []
    for i in range(n_docs):
        parts = [rng.choice(fixed) if rng.random() < 0.15 else rng.choices(words, weights)[0] for _ in range(rng.randint(0, 60))]
        rows.append((i, "".join(p + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", "! "]) for p in parts), lang))
    return rows


SOURCE = texts(1, 300, "en") + texts(2, 150, "de") + texts(3, 40, None) + texts(4, 40, "und") + AWKWARD + [(3, "ab ab ab ab ab ab ab ab ab ab ab ab ab.", "one")] * 3


@pytest.mark.parametrize(("top", "reach"), [(2000, 4000), (12, 3), (40, 60)])
def test_same_as_counting_every_sequence(spark, top, reach):
    """Few phrases wanted and short reaches take several rounds; ties stand at many ranks."""
    got = phrases.collocations(frame(spark, SOURCE).repartition(4), top=top, reach=reach).collect()
    assert {tuple(r) for r in got} == brute(SOURCE, top) and len(got) == len({(r["lang"], r["rank"]) for r in got})


def test_growth_counts_fewer_triples_than_there_are(spark, monkeypatch):
    """With a high threshold, only sequences of good bounds are counted; the result stays whole (test above)."""
    seen = []
    count = phrases.triple_counts
    monkeypatch.setattr(phrases, "triple_counts", lambda docs, pairs, least: seen.append(count(docs, pairs, least).count()) or count(docs, pairs, least))
    phrases.collocations(frame(spark, SOURCE), top=2, reach=2).count()
    first, seen[:] = seen[0], []
    phrases.collocations(frame(spark, SOURCE)).count()
    assert first < seen[0] / 2


def test_products_beyond_64_bits(spark):
    row = spark.createDataFrame([(3_000_000_007, 4_000_000_000, 5_000_000_011)], "a long, l long, r long")
    assert row.select(phrases.score("a", "l", "r")).first()[0] == 10**6 * 3_000_000_007**2 // (4_000_000_000 * 5_000_000_011)


def test_empty_tables_and_texts(spark, nothing):
    assert phrases.collocations(nothing).count() == 0
    assert phrases.collocations(frame(spark, [(1, None, "en"), (2, "", None), (3, " .\n", "de")])).count() == 0
