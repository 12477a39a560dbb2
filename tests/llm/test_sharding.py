"""Shards of nearly equal bytes, gapless slots, hot texts and awkward rows."""

import zlib
from collections import defaultdict

from leadlens.llm import sharding

from .samples import frame, prose


def check(rows, source, n_shards):
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == sorted(
        (i is not None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in source
    )
    slots, sizes = defaultdict(list), [0] * n_shards
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_awkward_rows(spark, awkward):
    from .samples import AWKWARD

    check(sharding.shard(awkward, 3).collect(), AWKWARD, 3)


def test_sizes_are_near_equal_with_a_hot_text(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SAMPLE", 200)
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", 100)
    source = [(i, prose(i, 5 + i % 90) if i % 3 else prose(0, 40), "en") for i in range(3000)]
    sizes = check(sharding.shard(frame(spark, source), 7).collect(), source, 7)
    assert max(sizes) - min(sizes) <= 2 * max(len(t) + 8 for _, t, _ in source)


def test_ranges_are_subdivided(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", 50)
    rows = sharding.records(frame(spark, [(i, prose(0, 10), "en") for i in range(2000)]))
    n_bytes = rows.agg({"size": "sum"}).first()[0]
    _, splitters, found = sharding.choose_splitters(rows, 2000, n_bytes, 24)
    assert len(splitters) >= 30 and found["n"].max() <= 200 and found["n"].sum() == 2000


def test_query_and_files(spark, nothing, tmp_path):
    assert sharding.sharding(nothing).count() == 0
    docs = frame(spark, [(i, prose(i, 30), "en") for i in range(200)])
    got = sharding.sharding(docs)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert {r["law"] for r in got.collect()} == {"bytes"} and len({r["shard"] for r in got.collect()}) == 24
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200 and sorted(r["shard"] for r in back.select("shard").distinct().collect()) == [0, 1, 2, 3]


def test_many_ranges_are_subdivided_until_none_is_overfull(spark, monkeypatch):
    """More rounds than a fixed few, ranges beyond what literals could hold, a single hot key that cannot be split."""
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", 4)
    monkeypatch.setattr(sharding, "SAMPLE", 50)
    source = [(i, prose(i, 3), "en") for i in range(6000)] + [(7, "hot", "en")] * 500
    rows = sharding.records(frame(spark, source)).persist()
    n_bytes = sum(len(t) + 8 for _, t, _ in source)
    _, splitters, found = sharding.choose_splitters(rows, 6500, n_bytes, 24)
    assert len(splitters) > 800 and sorted(found["n"])[-2] <= 40
    check(sharding.shard(frame(spark, source), 5).collect(), source, 5)


def test_equal_rows_are_one_record_dealt_out_by_many_tasks(spark, monkeypatch):
    """A third of all rows equal, with and without an id: one record each, cut into parts, shards near equal."""
    monkeypatch.setattr(sharding, "COPIES", 100)
    source = [(i, prose(i, 20), "en") for i in range(2000)] + [(None, prose(0, 20), "en")] * 1050 + [(5, "hot", "en")] * 1000
    assert sharding.records(frame(spark, source)).count() == 2002
    sizes = check(sharding.shard(frame(spark, source), 6).collect(), source, 6)
    assert max(sizes) - min(sizes) <= 2 * max(len(t) + 8 for _, t, _ in source)
    hot = spark.createDataFrame([(7, None, 9, 0, 1050, 0, 0)], "key long, doc_id long, size long, text_crc32 long, n long, ahead long, at long")
    got = sharding.copies(hot)
    assert sorted((r["at"], r["ahead"]) for r in got.collect()) == [(i, 9 * i) for i in range(1050)]


def test_written_columns_keep_their_values(spark, tmp_path):
    docs = frame(spark, [(i, prose(i, 30), "en") for i in range(50)]).selectExpr("*", "doc_id * 2 AS slot", "'x' AS shard")
    sharding.write_shards(docs, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert all(r["_slot"] == 2 * r["doc_id"] and r["_shard"] == "x" for r in back.collect()) and back.count() == 50
