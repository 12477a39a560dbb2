"""Components against all pairs, in one task and in blocks, with copies and awkward rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.llm import minhash
from leadlens.llm.components import components, forests

from .samples import AWKWARD, frame, prose


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(source):
    """Per row (id, set size, component), rows with one id being one document; (None, ...) for rows without an id."""
    sets = [(i, shingles(t)) for i, t, *_ in source]
    name = {i: i for i, _ in sets if i is not None}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if a and b and None not in (i, j) and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root(i), root(j)
                name[max(x, y)] = min(x, y)

    def component(i, s):
        if i is not None:
            return root(i)
        same = [root(j) for j, other in sets if s and other == s and j is not None]
        return min(same) if same else None

    return sorted(((i is not None, i or 0, len(s), component(i, s)) for i, s in sets), key=str)


def got(df):
    rows = df.collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in rows), key=str)


def edited(seed, words, share):
    rng = random.Random(seed)
    return " ".join(w if rng.random() > share else f"w{rng.randrange(999)}" for w in words)


def near_copies(n):
    """Groups of copies with few and many edits, so that links are on both sides of the threshold."""
    rng = random.Random(3)
    base = [[f"v{rng.randrange(5000)}" for _ in range(rng.randint(30, 120))] for _ in range(6)]
    rows = [(i, edited(i, base[i % 6], (0, 0.01, 0.02, 0.03, 0.05, 0.08)[i // 6 % 6]), None) for i in range(n)]
    return [(1000 - i, t if i % 7 else t.upper(), lang) for i, t, lang in rows]


@pytest.mark.parametrize("region", [minhash.REGION, 900])
def test_components_match_all_pairs(spark, region):
    """With a small region, groups are compared in blocks."""
    source = near_copies(160) + [(2000 + i, prose(i, 40), None) for i in range(20)]
    assert got(minhash.near_duplicates(frame(spark, source).repartition(5), region=region)) == brute_force(source)


def test_awkward_rows(spark, awkward, nothing):
    assert got(minhash.near_duplicates(awkward)) == brute_force(AWKWARD)
    assert minhash.near_duplicates(nothing).count() == 0
    assert minhash.one_of_each(nothing).count() == 0


def test_one_of_each_keeps_one_row(spark, awkward):
    kept = minhash.one_of_each(awkward)
    assert kept.schema == awkward.schema
    assert sorted(((r["doc_id"] or 0), (r["text"] or "")[:3]) for r in kept.collect()) == sorted(
        [(0, ""), (0, "No "), (1, ""), (2, ""), (3, " \n\t"), (4, "A."), (5, "12 "), (6, prose(1, 300)[:3]), (8, "xxx"), (9, prose(2, 9)[:3]), (10, "Grö"), (11, "ab\r")]
    )


def test_short_documents_are_one_shingle(spark):
    source = [(1, "a b c", None), (2, "A  b\nc", None), (3, "a b", None), (4, "a b c d", None), (5, "abc", None), (6, "a b c a b c a b c", None)]
    assert got(minhash.near_duplicates(frame(spark, source))) == brute_force(source)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    pair = [np.unique(a[:300]), np.unique(a[100:])]  # 200 of 400 shared
    s = minhash.signatures(pair, 2000)
    assert abs((s[0] == s[1]).mean() - 0.5) < 0.05


@pytest.mark.parametrize("piece", [7, 10_000])
def test_components_of_paths_stars_and_rings(spark, piece):
    """With pieces of a few edges, rounds of stars do the work."""
    rng = random.Random(piece)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(999, i) for i in range(900, 950)]
    edges += [(1000 + i, 1000 + (i + 1) % 37) for i in range(37)] + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    edges += [(7, 7)] + edges[:20]
    name = {x: x for e in edges for x in e}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        name[max(x, y)] = min(x, y)
    touched = {x for a, b in edges if a != b for x in (a, b)}
    df = spark.createDataFrame([(b, a) if i % 2 else (a, b) for i, (a, b) in enumerate(edges)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(df, piece).collect()}
    assert got == {x: root(x) for x in touched}


def test_a_task_with_many_edges_starts_anew_after_each_piece(spark):
    """One partition can't be coalesced into more; its edges are joined a piece at a time."""
    path = spark.createDataFrame([(i + 1, i) for i in range(1000)], "a long, b long").coalesce(1)
    rows = forests(path, 1000, 100).collect()
    assert all(r["a"] - r["b"] <= 100 for r in rows) and 10 <= len({r["b"] for r in rows}) <= 20
    assert {r["component"] for r in components(path, 100).collect()} == {0}


def chained(n):
    """Pages of one source: half of each is boilerplate, every tenth is a near copy of another."""
    rng = random.Random(11)
    shared = [f"b{i}" for i in range(60)]
    rows = [(i, shared[:50] + [f"p{i}x{k}" for k in range(rng.randint(35, 55))], None) for i in range(n)]
    return [(i, " ".join(rows[i - 3][1][:-2] if i % 10 == 7 else words), None) for i, words, _ in rows]


def test_large_regions_without_links_are_compared_two_blocks_at_a_time(spark, monkeypatch):
    """Boilerplate ties all pages to one region, of which almost all is outside the largest component."""
    by_group, largest = minhash.by_group, []

    def measured(rows, keys, columns, act):
        sizes = rows.groupBy(*keys).agg(F.sum(F.octet_length("shingles") / 8).alias("n"))
        largest.append(sizes.agg(F.max("n")).first()[0] or 0)
        return by_group(rows, keys, columns, act)

    monkeypatch.setattr(minhash, "by_group", measured)
    source = chained(300)
    region = 2500
    assert sum(len(shingles(t)) for _, t, _ in source) > 10 * region
    assert got(minhash.near_duplicates(frame(spark, source).repartition(5), region=region)) == brute_force(source)
    assert len(largest) > 2 and max(largest) < 4 * region


def test_similar_sets_share_a_prefix_shingle():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n, cut = int(rng.integers(1, 80)), int(rng.integers(0, 25))
        pool = np.unique(rng.integers(0, 2**63, n + cut).astype(np.uint64))
        a, b = np.sort(rng.permutation(pool)[: max(1, n)]), np.sort(rng.permutation(pool)[: max(1, n)])
        common = np.sort(rng.permutation(pool)[: len(pool) // 2])
        counts = rng.integers(2, 9, len(common))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            assert len(np.intersect1d(minhash.prefix(a, common, counts, 75), minhash.prefix(b, common, counts, 75)))


def test_one_of_each_with_repeated_and_missing_ids(spark):
    """One row of each near-duplicate component over all rows, whatever their ids; the same one on any partitioning."""
    a, b, c, d = (prose(i, 120) for i in (21, 22, 23, 24))
    near = " ".join(["other", *a.split()[1:]])
    hot = [(7, prose(100 + i, 60), "en") for i in range(40)]
    source = [
        (5, a, "en"), (None, a, "de"), (None, near, "fr"), (3, near, "en"), (None, b, "en"), (None, b + " more", "en"), (None, b, "de"),
        (9, c, "en"), (9, c, "de"), (9, c, None), (9, d, "en"), (8, c.upper(), "es"), (4, None, "en"), (4, "", "en"), (None, None, "en"),
    ]
    runs = [sorted(map(str, minhash.one_of_each(frame(spark, rows).repartition(n)).collect())) for n, rows in ((1, source + hot), (7, (source + hot)[::-1]))]
    assert runs[0] == runs[1]
    kept = [(r["doc_id"], r["text"], r["lang"]) for r in minhash.one_of_each(frame(spark, source + hot)).collect()]
    assert sorted(t for i, t, _ in kept if i == 7) == sorted(t for _, t, _ in hot)
    rest = [x for x in kept if x[0] != 7]
    assert [x for x in rest if x[0] is None and x[1] and x[1].startswith(a[:20])] == []
    texts = sorted((t or "", i or 0) for i, t, _ in rest if t is None or not t.startswith(b))
    assert texts == sorted([(near, 3), (c.upper(), 8), (d, 9), ("", 4), ("", 4), ("", 0)])
    assert len([t for _, t, _ in rest if t and t.startswith(b)]) == 1


def test_copies_of_one_row_are_one_document(spark):
    text = prose(31, 90)
    source = [(1, text, "en"), (1, text, "de"), (1, text, "de")] * 20 + [(2, text + " x", "en")]
    kept = minhash.one_of_each(frame(spark, source).repartition(4)).collect()
    assert [(r["doc_id"], r["lang"]) for r in kept] == [(1, "de")]
