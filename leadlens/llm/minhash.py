"""Near-duplicate detection with circulant MinHash.

A document's set is its distinct five-word shingles, as 64-bit hashes (A-Z in lower case, words cut at ASCII white
space; fewer than five words are one shingle). Two permutations of the 32-bit numbers give all coordinates of a
signature: the first scatters the shingles, the second is applied after a circular shift, by another amount for
each coordinate. Coordinates are banded; documents that agree in a band are candidates, and pairs at a Jaccard
similarity of 75 % or more, confirmed on the full sets, are links. With 48 bands of 5, a pair at exactly 75 % is
missed with a chance of 2 in a million.

Equal sets are one class from the start, so copies never meet each other. Candidate regions, the components of
the graph that ties each class to the least class of its buckets, are compared exactly in one task each. A region of
over REGION shingles is cut into blocks. Each block is compared in itself and with the first block. What is then
outside the region's largest component is compared, one block with one other at a time, with the documents that share
a shingle of its prefix: sets at 75 % must share one of the rarest quarter of their shingles, in any order that is the
same for both, so boilerplate makes no pairs and no link is missed. Nothing is dropped at any size.

Rows: a text that is NULL or has no word has an empty set, is linked with nothing and is kept. Rows that share
an id are one document: what links to one of them links to all. A row without an id takes the component of
the rows with its set, NULL where none of them has an id, and is kept only in that case. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import bound_batches, checkpointed, free_name, in_parts, mix, utf8, windows, word_bounds, word_hashes
from leadlens.llm.components import components

WIDTH = 5
BANDS, ROWS = 48, 5
#: Shingles compared in one task.
REGION = 400_000
#: Ids of 8 bytes that may be broadcast: 8 MB.
SMALL_IDS = 1_000_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(column: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = utf8(column)
    data = _LOWER[data]
    starts, ends, first = word_bounds(data, offsets)
    hashes, begins = windows(word_hashes(data, starts, ends), first, width)
    return [np.unique(hashes[a:b]) for a, b in zip(begins[:-1], begins[1:], strict=True)]


def signatures(sets: list[np.ndarray], n: int) -> np.ndarray:
    """[set, coordinate]: the least number that the second permutation gives any element of the set, after the first
    permutation and a circular shift by the coordinate's multiple of an odd step."""
    sizes = np.array([len(s) for s in sets])
    out = np.full((len(sets), n), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    begins = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
    flat = np.concatenate([sets[i] for i in full])
    scattered = (mix(flat ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)
    x, y = np.empty_like(scattered), np.empty_like(scattered)
    with np.errstate(over="ignore"):
        for k in range(n):
            np.add(scattered, np.uint32(k * 0x9E3779B1 & 0xFFFFFFFF), out=x)
            np.right_shift(x, 16, out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, np.uint32(0x85EBCA6B), out=x)
            np.right_shift(x, 13, out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, np.uint32(0xC2B2AE35), out=x)
            np.right_shift(x, 16, out=y)
            np.bitwise_xor(x, y, out=x)
            out[full, k] = np.minimum.reduceat(x, begins)
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """[set, band]: a 64-bit number for the band and its coordinates."""
    keys = np.zeros((len(signature), bands), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(rows):
            keys = mix(keys * np.uint64(31) + signature[:, k::rows][:, :bands].astype(np.uint64) + np.uint64(1))
        keys = mix(keys + np.arange(bands, dtype=np.uint64))
    return keys


SKETCH = "doc_id long, n_shingles long, low long, high long, bands array<long>"


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Size, 128-bit checksum and band keys of every document's set; one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, "text", 1 << 18):
            sets = shingle_sets(batch.column(1))
            keys = band_keys(signatures(sets, bands * rows), bands, rows).view(np.int64)
            sums = np.zeros((2, len(sets)), np.uint64)
            with np.errstate(over="ignore"):
                for i, s in enumerate(sets):
                    sums[0, i] = mix(s ^ np.uint64(0xE7037ED1A0B428DB)).sum()
                    sums[1, i] = mix(s + np.uint64(0x8EBC6AF09C88C6E3)).sum()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands), pa.array(keys.ravel()))
            n = pa.array([len(s) for s in sets], pa.int64())
            arrays = [batch.column(0), n, pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), lists]
            yield pa.record_batch(arrays, ["doc_id", "n_shingles", "low", "high", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SKETCH)


def candidate_regions(classes: DataFrame) -> DataFrame:
    """(rep, region) for every class (rep, bands) that shares a bucket with another."""
    entries = classes.select("rep", F.explode("bands").alias("bucket"))
    buckets = entries.groupBy("bucket").agg(F.min("rep").alias("least"), F.max("rep").alias("most"))
    shared = buckets.filter("least != most").select(F.col("bucket").alias("in_bucket"), "least").repartition("in_bucket")
    edges = entries.join(shared, F.col("bucket") == F.col("in_bucket")).select(F.col("rep").alias("a"), F.col("least").alias("b"))
    return components(edges).select(F.col("node").alias("rep"), F.col("component").alias("region"))


def sets_of(docs: DataFrame, members: DataFrame, n_members: int) -> DataFrame:
    """``members`` (rep, ...) with ``shingles``, the sorted set as bytes. The texts are read again for them alone; of rows
    that repeat id and text, a task passes on one."""
    some = F.broadcast(members) if n_members <= SMALL_IDS else members
    read = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(some, "rep")
    names = [c for c in read.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed: set[tuple[int, int]] = set()
        for batch in in_parts(batches, "text"):
            reps, texts = batch.column(names.index("rep") + 1).to_pylist(), batch.column(0).to_pylist()
            new = []
            for i, document in enumerate((rep, hash(text)) for rep, text in zip(reps, texts, strict=True)):
                if document not in passed:
                    passed.add(document)
                    new.append(i)
            batch = batch.take(pa.array(new, pa.int64()))
            sets = [s.tobytes() for s in shingle_sets(batch.column(0))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sets, pa.binary())], names=[*names, "shingles"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema if f.name != "rep")
    return read.select("text", *names).mapInArrow(run, f"rep long, {schema}, shingles binary")


def connected(sets: list[np.ndarray], ids: list[int], probes: np.ndarray, targets: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """(id, least id of its component) for what links between ``probes`` and ``targets`` (positions) connect, without the
    least ids themselves. ``ids`` that are equal are one node."""
    parent: dict[int, int] = {i: i for i in ids}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def link(a: int, b: int) -> None:
        a, b = root(ids[a]), root(ids[b])
        parent[max(a, b)] = min(a, b)

    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        if 100 * both >= percent * (sizes.sum() - both):
            link(0, 1)
    else:
        _, flat = np.unique(np.concatenate([sets[i] for i in targets] + [sets[i] for i in probes]), return_inverse=True)
        ends = np.cumsum(np.concatenate((sizes[targets], sizes[probes])))
        held, begins = flat[: ends[len(targets) - 1]], ends[: len(targets)] - sizes[targets]
        mark = np.zeros(int(flat.max()) + 1, np.int32)
        for k, probe in enumerate(probes):
            end = ends[len(targets) + k]
            own = flat[end - sizes[probe] : end]
            mark[own] = 1
            both = np.add.reduceat(mark[held], begins)
            mark[own] = 0
            for j in targets[100 * both >= percent * (sizes[probe] + sizes[targets] - both)]:
                if j != probe:
                    link(int(j), int(probe))
    return [(i, root(i)) for i in parent if root(i) != i]


def by_group(rows: DataFrame, keys: list[str], columns: list[str], act: Callable[[dict[str, list]], list[tuple[int, int]]]) -> DataFrame:
    """Pairs (a, b) that ``act`` makes of each group of rows with equal ``keys``, one group in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {c: [] for c in columns}
        current, out = None, []
        for batch in batches:
            table = batch.to_pydict()
            for i, key in enumerate(zip(*(table[k] for k in keys), strict=True)):
                if key != current:
                    if current is not None:
                        out += act(held)
                    current, held = key, {c: [] for c in columns}
                for c in columns:
                    held[c].append(table[c][i])
            yield edges(out)
            out = []
        if current is not None:
            yield edges(act(held))

    def edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*pairs, strict=True) if pairs else ((), ())
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys).select(*keys, *[c for c in columns if c not in keys])
    return dealt.mapInArrow(run, "a long, b long")


def _sets(held: dict[str, list]) -> list[np.ndarray]:
    return [np.frombuffer(s, np.uint64) for s in held["shingles"]]


def components_in_regions(sets: DataFrame, percent: int) -> DataFrame:
    """Components of regions that one task compares whole: (a, b), b being the least id of a's component."""

    def act(held: dict[str, list]) -> list[tuple[int, int]]:
        everyone = np.arange(len(held["rep"]))
        return connected(_sets(held), held["rep"], everyone, everyone, percent) if len(everyone) > 1 else []

    return by_group(sets, ["region"], ["rep", "shingles"], act)


def prefix(own: np.ndarray, common: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The elements of a sorted set that come first by ``counts`` (of ``common``, sorted; 0 elsewhere), then by value: so
    many that two sets at a similarity of ``percent`` share one of them."""
    at = np.minimum(np.searchsorted(common, own), max(len(common) - 1, 0))
    rank = np.where(common[at] == own, counts[at], 0) if len(common) else np.zeros(len(own), np.int64)
    return own[np.argsort(rank, kind="stable")[: len(own) + 1 + -percent * len(own) // 100]]


def components_in_large_regions(sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the documents with links inside regions that are cut into ``blocks`` blocks: each block in itself and with the first, then what the
    region's largest component has not taken in with those of other blocks that share a prefix shingle, two blocks at a time."""
    sets = sets.withColumn("key", F.xxhash64("rep", "shingles"))
    sets = checkpointed(sets.withColumn("block", F.pmod("key", F.col("blocks")).cast("int")))

    def compare_all(held: dict[str, list]) -> list[tuple[int, int]]:
        home = np.flatnonzero(~np.array(held["guest"], bool))
        return connected(_sets(held), held["rep"], np.arange(len(held["rep"])), home, percent) if len(home) and len(held["rep"]) > 1 else []

    def compare_guests(held: dict[str, list]) -> list[tuple[int, int]]:
        guest = np.array(held["guest"], bool)
        probes, targets = np.flatnonzero(guest), np.flatnonzero(~guest)
        return connected(_sets(held), held["rep"], probes, targets, percent) if len(probes) and len(targets) else []

    def prefixes(held: dict[str, list]) -> list[tuple[int, int]]:
        """(key, shingle); the first block, which every block of the region holds, tells which shingles are common."""
        own = _sets(held)
        guests = [s for s, guest in zip(own, held["guest"], strict=True) if guest]
        common, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *guests]), return_counts=True)
        common, counts = common[counts > 1], counts[counts > 1]
        at_home = [(k, s) for k, s, guest in zip(held["key"], own, held["guest"], strict=True) if not guest]
        return [(k, x) for k, s in at_home for x in prefix(s, common, counts, percent).view(np.int64).tolist()]

    def with_first(some: DataFrame) -> DataFrame:
        at_home = some.select("region", "block", "key", "rep", "shingles", F.lit(False).alias("guest"))
        others = F.explode(F.expr("sequence(1, CAST(blocks AS INT) - 1)")).alias("block")
        return at_home.union(some.filter("block = 0 AND blocks > 1").select("region", others, "key", "rep", "shingles", F.lit(True).alias("guest")))

    columns = ["rep", "shingles", "guest"]
    found = checkpointed(components(by_group(with_first(sets), ["region", "block"], columns, compare_all)))
    named = sets.select("key", "rep", "region", "block", "blocks").distinct().join(found, F.col("rep") == F.col("node"), "left")
    named = checkpointed(named.withColumn("component", F.coalesce("component", "rep")).drop("node", "rep"))
    sizes = named.groupBy("region", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("region").agg(F.max(F.struct("n", "component")).alias("most")).select("region", F.col("most.component").alias("main"))
    # The first block has been compared with all; two blocks are done.
    later = named.filter("block > 0 AND blocks > 2").join(largest, "region").withColumn("outside", F.expr("component != main"))
    later = checkpointed(later.select("key", "region", "block", "component", "outside"))
    unsettled = later.filter("outside").select("region").distinct()
    if unsettled.isEmpty():
        return found
    postings = by_group(with_first(sets.join(unsettled, "region", "left_semi")).filter("block > 0"), ["region", "block"], ["key", *columns], prefixes)
    postings = checkpointed(postings.select(F.col("a").alias("key"), F.col("b").alias("shingle")).distinct().join(later, "key"))
    # A shingle matters if two components hold it and one of them is outside; its blocks are at most the region's.
    shared = postings.groupBy(F.col("region").alias("in_region"), F.col("shingle").alias("in_shingle")).agg(
        F.min("component").alias("least"), F.max("component").alias("most"),
        F.collect_set("block").alias("hosts"), F.collect_set(F.when(F.col("outside"), F.col("block"))).alias("guests"),
    )
    shared = shared.filter("least != most AND size(guests) > 0").drop("least", "most").repartition("in_region", "in_shingle")
    met = postings.join(shared, (F.col("region") == F.col("in_region")) & (F.col("shingle") == F.col("in_shingle")))
    hosts = met.select("key", "region", F.col("block").alias("host_block"), F.explode("guests").alias("guest_block"), F.lit(False).alias("guest"))
    guests = met.filter("outside").select("key", "region", F.explode("hosts").alias("host_block"), F.col("block").alias("guest_block"), F.lit(True).alias("guest"))
    cells = checkpointed(hosts.union(guests).filter("host_block != guest_block").distinct())
    read = cells.join(sets.select("key", "rep", "shingles"), "key")
    far = by_group(read, ["region", "host_block", "guest_block"], columns, compare_guests)
    return components(found.toDF("a", "b").union(far))


def near_duplicates(docs: DataFrame, percent: int = 75, region: int = REGION) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document. The 48 bands of 5 suit 75 % and more."""
    bound_batches(docs.sparkSession)
    sketches = checkpointed(sketch(docs))
    classes = sketches.filter("n_shingles > 0").groupBy("low", "high", F.col("n_shingles").alias("n"))
    classes = classes.agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
    classes = checkpointed(classes.filter("rep IS NOT NULL"))
    regions = checkpointed(candidate_regions(classes))
    members = classes.select("rep", "n").join(regions, "rep")
    totals = members.groupBy("region").agg(F.sum("n").alias("total"))
    members = members.join(totals, "region").select("rep", "region", F.ceil(F.col("total") / region).cast("long").alias("blocks"))
    members = checkpointed(members)
    n_members, n_large = members.agg(F.count("*"), F.count_if(F.col("blocks") > 1)).first()
    found = components_in_regions(sets_of(docs, members.filter("blocks = 1"), n_members), percent).toDF("node", "component")
    if n_large:
        found = found.union(components_in_large_regions(sets_of(docs, members.filter("blocks > 1"), n_large), percent))
    # Only classes with copies or links need a name; all other documents stand for themselves.
    names = classes.join(found, F.col("rep") == F.col("node"), "left").filter("copies > 1 OR node IS NOT NULL")
    names = checkpointed(names.select(F.col("low").alias("l"), F.col("high").alias("h"), F.coalesce("component", "rep").alias("name")))
    named = sketches.join(names, (F.col("low") == F.col("l")) & (F.col("high") == F.col("h")), "left")
    component = F.coalesce("name", "doc_id")
    return named.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """A row of ``docs``, columns unchanged, of each group of near-duplicates: that with the least id, rows without an id
    last. Rows of one id and text are one document, those of one id and other texts are others. Rows without a word all
    differ, but for those of one id and text. Ties go by the document's hash, then by the other columns' values."""
    key = free_name("key", docs.columns)
    rows = docs.withColumn(key, F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))
    found = near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"))
    found = checkpointed(found.groupBy(F.col("doc_id").alias("key")).agg(F.first("component_id").alias("component"), F.count("*").alias("n")))
    ids = rows.groupBy(F.col(key).alias("of")).agg(F.first(F.col("doc_id").cast("long")).alias("id"))
    first = F.min(F.struct(F.col("id").isNull(), "id", "key", "n")).alias("first")
    kept = found.join(ids, F.col("key") == F.col("of")).groupBy("component").agg(first)
    kept = checkpointed(kept.select(F.col("first.key").alias(key), F.col("first.n").alias("_rows")))
    once = rows.join(kept.filter("_rows = 1").select(key), key, "left_semi").select(*docs.columns)
    if kept.filter("_rows > 1").isEmpty():
        return once
    again = rows.join(kept.filter("_rows > 1").select(key), key, "left_semi")
    whole = F.struct(*docs.columns)
    again = again.groupBy(key).agg(F.min_by(whole, F.to_json(whole, {"ignoreNullFields": "false"})).alias(free_name("row", docs.columns)))
    return once.unionByName(again.select(f"{free_name('row', docs.columns)}.*"))


#: All pairs that share a shingle, exactly, and the least id reachable.
MINHASH_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, k.b FROM r JOIN k ON r.b = k.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN c ON c.a = w.doc_id
"""
