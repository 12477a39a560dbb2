"""Sharding by sampled splitters: shards of nearly equal bytes.

Records are ordered by a 64-bit key: 40 bits of the text's hash, then 24 bits of the id's, so equal texts stand
together and yet a text that a third of the rows share can be split. Size-weighted samples of keys give quantile
boundaries that cut the key space into ranges; ranges that turn out overfull are sampled again and subdivided.
Exact sums per range and running sums inside each range then place every record on the line of all bytes, which
is cut into equal lengths. Law ``bytes``: two shards differ by at most two of the largest record.

Rows: a NULL text has no bytes; size is its UTF-8 bytes plus 8. Equal rows, of one text and id, are told apart by
nothing: they are placed as one record with a count, combined before the shuffle, and then dealt out to neighbouring slots
by many tasks. An empty table gives an empty result. NULL ids sort first among equal keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlens.llm.common import checkpointed, free_name

#: Keys drawn a round, for all ranges together, in expectation.
SAMPLE = 20_000
ROWS_PER_RANGE = 100_000
#: Equal rows that one row is dealt out to at once.
COPIES = 10_000


def records(docs: DataFrame) -> DataFrame:
    """What is ordered: id, size, checksum and key of each document, no text, and ``n``, how many equal rows it stands for."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    low = (1 << 24) - 1
    key = F.xxhash64(text).bitwiseAND(F.lit(~low)).bitwiseOR(F.xxhash64(F.col("doc_id")).bitwiseAND(F.lit(low)))
    each = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), key.alias("key"))
    return each.groupBy("key", "doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))


def in_ranges(rows: DataFrame, splitters: np.ndarray) -> DataFrame:
    """``rows`` with ``range``: how many splitters are at most the key."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["range"] = np.searchsorted(splitters, frame["key"].to_numpy(), "right").astype(np.int64)
            yield frame

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(run, f"{schema}, range long")


def sums(rows: DataFrame) -> pd.DataFrame:
    """Rows and bytes of each range; as many rows as there are ranges, which the sample bounds."""
    return rows.groupBy("range").agg(F.sum("n").alias("n"), F.sum(F.expr("size * n")).alias("bytes")).orderBy("range").toPandas()


def draw(rows: DataFrame, bytes_of: dict[int, int], per_range: int) -> pd.DataFrame:
    """Size-weighted keys of the ranges in ``bytes_of``, about ``per_range`` of each: a record is drawn with a chance of
    its rows' bytes over a step of bytes, decided by a hash; ``weight`` is the bytes that it stands for."""
    steps = rows.sparkSession.createDataFrame([(int(k), float(max(1.0, b / per_range))) for k, b in bytes_of.items()], "of long, step double")
    lot = F.pmod(F.xxhash64(F.col("key"), F.col("doc_id"), F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.join(steps, F.col("range") == F.col("of")).filter(lot < F.expr("size * n / step"))
    return drawn.select("key", F.greatest(F.expr("CAST(size * n AS DOUBLE)"), F.col("step")).alias("weight")).toPandas().sort_values("key")


def choose_splitters(rows: DataFrame, n_rows: int, n_bytes: int, n_shards: int) -> tuple[DataFrame, np.ndarray, pd.DataFrame]:
    """``rows`` in ranges, the splitters and the ranges' exact sums. At first as many ranges as shards, or one for
    each ROWS_PER_RANGE rows if these are more; a range of over twice its share is drawn again and subdivided, until
    none is left or those that are give no new splitter: a single key."""
    wanted = int(max(n_shards, n_rows / ROWS_PER_RANGE))
    found = pd.DataFrame({"range": [0], "n": [n_rows], "bytes": [n_bytes]})
    splitters, records = np.zeros(0, np.int64), rows
    rows = in_ranges(records, splitters)
    while True:
        share = n_bytes / wanted
        over = found[(found["bytes"] > 2 * share) | (found["n"] > 2 * max(ROWS_PER_RANGE, n_rows / wanted))]
        if over.empty:
            break
        keys = draw(rows, dict(zip(over["range"], over["bytes"], strict=True)), max(20, SAMPLE // len(over)))
        if keys.empty:
            break
        slot = np.searchsorted(splitters, keys["key"].to_numpy(), "right")
        new = []
        for at, group in keys.groupby(slot):
            size, n = over.loc[over["range"] == at, ["bytes", "n"]].iloc[0]
            parts = int(np.ceil(max(size / share, n / max(ROWS_PER_RANGE, n_rows / wanted))))
            weight = group["weight"].cumsum().to_numpy()
            cuts = np.searchsorted(weight, weight[-1] * np.arange(1, parts) / parts)
            new.append(group["key"].to_numpy()[cuts])
        before, splitters = len(splitters), np.unique(np.concatenate((splitters, *new)))
        if len(splitters) == before:
            break
        rows = in_ranges(records, splitters)
        found = sums(rows)
    return rows, splitters, found


def copies(placed: DataFrame) -> DataFrame:
    """A row for each of the equal rows that a record stands for, ``ahead`` and ``at`` moved on by those before it. Records of
    more than COPIES rows are first cut into parts, which are dealt to all tasks."""
    parts = placed.filter(F.col("n") > COPIES).withColumn("part", F.explode(F.expr(f"sequence(0L, (n - 1) div {COPIES})")))
    parts = parts.repartition("key", "doc_id", "part").withColumn("first", F.expr(f"part * {COPIES}L")).withColumn("last", F.expr(f"least(n, first + {COPIES}) - 1"))
    few = placed.filter(F.col("n") <= COPIES).select("*", F.lit(0).cast("long").alias("first"), (F.col("n") - 1).alias("last"))
    each = few.unionByName(parts.drop("part")).withColumn("copy", F.explode(F.sequence("first", "last")))
    return each.withColumns({"ahead": F.expr("ahead + copy * size"), "at": F.expr("at + copy")})


def shard(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, shard (0 to ``n_shards`` - 1) and slot (gapless from 0 in each shard) of every row."""
    rows = checkpointed(records(docs))
    n_rows, n_bytes = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.expr("size * n")), F.lit(0))).first()
    rows, _, found = choose_splitters(rows, n_rows, n_bytes, n_shards)
    spark = docs.sparkSession
    found["bytes_before"] = found["bytes"].cumsum() - found["bytes"]
    found["rows_before"] = found["n"].cumsum() - found["n"]
    schema = "range long, bytes_before long, rows_before long"
    before = spark.createDataFrame(found[["range", "bytes_before", "rows_before"]].astype("int64"), schema)
    in_range = Window.partitionBy("range").orderBy("key", "doc_id", "size", "text_crc32")
    running = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = rows.select("*", (F.sum(F.expr("size * n")).over(running) - F.expr("size * n")).alias("ahead"), (F.sum("n").over(running) - F.col("n")).alias("at"))
    line = line.join(F.broadcast(before), "range")  # a row for each range, bounded by the sample
    line = line.withColumns({"ahead": F.expr("ahead + bytes_before"), "at": F.expr("at + rows_before")})
    line = checkpointed(line.select("key", "doc_id", "size", "text_crc32", "n", "ahead", "at"))
    # The row's middle on the line of all bytes, doubled to stay whole.
    middle = f"least({n_shards - 1}, (2 * ahead + size) * CAST({n_shards} AS DECIMAL(10, 0)) div {max(1, 2 * n_bytes)})"
    placed = copies(line).select("doc_id", "size", "text_crc32", "at", F.expr(middle).cast("int").alias("shard"))
    first = placed.groupBy("shard").agg(F.min("at").alias("first"))
    return placed.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("first")).alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 24) -> None:
    """Writes ``docs`` as Parquet, a folder ``shard=N`` for each shard, rows in order of their slots where ids are
    unique. Needs a doc_id in every row. Columns of ``docs`` called shard or slot get an underscore before their names."""
    placed = shard(docs, n_shards).select("doc_id", "shard", "slot").dropDuplicates(["doc_id"])
    taken = [*docs.columns, "shard", "slot"]
    kept = docs.withColumnsRenamed({x: free_name(x, taken) for x in docs.columns if x.lower() in ("shard", "slot")})
    rows = kept.join(placed, "doc_id").repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot")
    rows.write.partitionBy("shard").parquet(path)


def sharding(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """The query: every document's shard and slot under law ``bytes``."""
    return shard(docs, n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
