"""Mixing sources to target weights by a low-discrepancy schedule.

Sources in code-point order (NULL last) weigh 3, 1, 2, repeating, and share 150 % of all words; a source's target stops at
twice its size and the excess is shared again. The documents of a source stand in a fixed pseudo-random order and its line
of words is cut into equal blocks of at most 1,024 words (128 blocks at least, if it has as many words). A source whose
target is worth n blocks owns n neighbouring numbers below 2^m; the bit-reversed number (van der Corput) is the slot in
the schedule, and a slot's rank among those of its source, known in closed form, names the block that stands there: the
blocks in their order, then again from the first. Every source's words so come within half a block of its target, at
every stretch of the schedule within a few blocks, and no block stands there more than twice.

Nothing is gathered by source: a line is cut into ranges of the order's hash with one sum each, slots are made in pieces
of 65,536 numbers, and blocks and slots meet by (source, block). Copies of a row are one key with a number.

Rows: a NULL or empty text has no words and is never taken. A NULL source is a source of its own. Rows with equal source,
id and size are copies, NULL ids included, and are told apart by a number. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.llm.common import checkpointed

WEIGHTS = (3, 1, 2)
SHARE, CAP = Fraction(3, 2), 2
BLOCK_WORDS, LEAST_BLOCKS = 1024, 128
KEYS_PER_RANGE = 8192
SLOTS_PER_PIECE = 1 << 16
SEED = 13


def keys(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """source, doc_id, size (words), copies and the hex hash that orders the documents of a source."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = docs.select("source", "doc_id", size.alias("size")).groupBy("source", "doc_id", "size").agg(F.count("*").alias("copies"))
    return rows.withColumn("hash", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))))


def running(df: DataFrame, order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    """``df`` with ``at`` (0-based place in ``order``) and, by name, sums of columns over the rows before. Rows are sorted
    by range; one row for each partition carries the sums over."""
    part = F.spark_partition_id().alias("_part")
    df = checkpointed(df.orderBy(*order)).select("*", part)
    sums = {"at": "1", **sums}
    before = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(F.col("_part").alias("_of")).agg(*[F.sum(F.expr(c)).alias(f"_sum_{name}") for name, c in sums.items()])
    totals = totals.select("_of", *[F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_off_{name}") for name in sums])
    local = df.select("*", *[F.coalesce(F.sum(F.expr(c)).over(before), F.lit(0)).alias(f"_in_{name}") for name, c in sums.items()])
    out = local.join(F.broadcast(totals), F.col("_part") == F.col("_of"))  # a row for each partition
    return out.select(*[c for c in df.columns if c != "_part"], *[(F.col(f"_in_{name}") + F.col(f"_off_{name}")).alias(name) for name in sums])


def level(sources: DataFrame, share: Fraction, cap: int) -> Fraction:
    """Words for each unit of weight: sources whose cap lies at or below it get their cap, the others their weight times it.
    It is raised until no further source reaches its cap; each round is one sum over the sources."""
    n_words, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total = share * (n_words or 0)
    found, n_capped = Fraction(total, weight or 1), -1
    while True:
        capped = f"CAST({cap} AS DECIMAL(38, 0)) * source_size * {found.denominator} <= CAST({found.numerator} AS DECIMAL(38, 0)) * weight"
        n, words, left = sources.selectExpr(
            f"count_if({capped})", f"coalesce(sum(CASE WHEN {capped} THEN source_size END), 0)", f"coalesce(sum(CASE WHEN NOT ({capped}) THEN weight END), 0)"
        ).first()
        if n == n_capped or not left:
            return found
        found, n_capped = (total - cap * words) / left, n


def sources(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, cap: int = CAP) -> DataFrame:
    """A row for each source: source_size, weight, target, blocks, slots and lo, the first of the numbers it owns."""
    found = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    cases = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    found = running(found, [F.col("source").asc_nulls_last()], {}).withColumn("weight", F.expr(f"CASE at % {len(weights)} {cases} END").cast("long"))
    found = checkpointed(found.drop("at"))
    per = level(found, share, cap)
    num, den = per.numerator, per.denominator
    capped = f"CAST({cap} AS DECIMAL(38, 0)) * source_size * {den} <= CAST({num} AS DECIMAL(38, 0)) * weight"
    found = found.withColumn("capped", F.expr(capped)).withColumn(
        "blocks", F.expr(f"least(source_size, greatest((source_size + {BLOCK_WORDS - 1}) div {BLOCK_WORDS}, {LEAST_BLOCKS}L))")
    )
    rounded = f"(CAST({2 * num} AS DECIMAL(38, 0)) * weight * blocks + CAST({den} AS DECIMAL(38, 0)) * source_size) div (CAST({2 * den} AS DECIMAL(38, 0)) * source_size)"
    found = found.select(
        "source", "source_size", "weight", "blocks",
        F.expr(f"CASE WHEN capped THEN CAST({cap} * source_size AS DOUBLE) ELSE CAST(CAST({num} AS DECIMAL(38, 0)) * weight AS DOUBLE) / CAST({den} AS DOUBLE) END").alias("target"),
        F.expr(f"CASE WHEN source_size = 0 THEN 0L WHEN capped THEN {cap} * blocks ELSE {rounded} END").alias("slots"),
    )
    return running(found, [F.col("source").asc_nulls_last()], {"lo": "slots"}).drop("at")


def reverse(x: np.ndarray, bits: int) -> np.ndarray:
    """The lowest ``bits`` bits of the numbers in reverse order."""
    out = np.zeros_like(x)
    for _ in range(bits):
        out = (out << 1) | (x & 1)
        x = x >> 1
    return out


def earlier(slots: np.ndarray, below: int, bits: int) -> np.ndarray:
    """How many numbers less than ``below`` have a reversal less than each of ``slots``: for each bit of ``below``, the
    numbers that agree with it above the bit and have 0 there; their reversals are evenly spaced."""
    found = np.zeros_like(slots)
    for b in range(bits + 1):
        if below >> b & 1:
            rest = int(reverse(np.array([(below >> (b + 1)) << (b + 1)], np.int64), bits)[0])
            step = bits - b
            found += np.clip((slots - rest + (1 << step) - 1) >> step, 0, 1 << b)
    return found


def schedule(found: DataFrame, bits: int) -> DataFrame:
    """source, slot, rank (0-based among the slots of the source) and block of every slot, from ``sources``."""
    pieces = found.where("slots > 0").select("source", "lo", "slots", "blocks", F.expr(f"explode(sequence(0L, (slots - 1) div {SLOTS_PER_PIECE}))").alias("piece"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for source, lo, n, blocks, piece in frame.itertuples(index=False):
                lo, n, blocks, piece = int(lo), int(n), int(blocks), int(piece)
                at = np.arange(lo + piece * SLOTS_PER_PIECE, min(lo + n, lo + (piece + 1) * SLOTS_PER_PIECE), dtype=np.int64)
                slot = reverse(at, bits)
                rank = earlier(slot, lo + n, bits) - earlier(slot, lo, bits)
                yield pd.DataFrame({"source": source, "slot": slot, "rank": rank, "block": rank % blocks})

    return pieces.repartition("source", "piece").mapInPandas(run, "source string, slot long, rank long, block long")


def placed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """A row for each document: doc_id, size, copy, begin (its first word on the line of its source) and its source's figures."""
    n_keys = rows.count()
    bits = max(0, (max(1, n_keys // KEYS_PER_RANGE) - 1).bit_length())
    ranged = rows.withColumn("range", F.shiftright(F.conv(F.substring("hash", 1, 8), 16, 10).cast("long"), 32 - bits)).withColumn("words", F.col("size") * F.col("copies"))
    sums = ranged.groupBy(F.col("source").alias("s"), F.col("range").alias("r")).agg(F.sum("words").alias("in_range"))
    ahead = Window.partitionBy("s").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("in_range").over(ahead), F.lit(0)))  # a row for each 8,192 keys
    figures = found.select(F.col("source").alias("f"), "source_size", "target", "blocks")
    sums = sums.join(figures, F.col("s").eqNullSafe(F.col("f"))).drop("f", "in_range")
    inside = Window.partitionBy("source", "range").orderBy("hash", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("before", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    joined = local.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    # Copies stand side by side; they are counted out in two steps, so that no array follows their number.
    counted = joined.withColumn("thousand", F.expr("explode(sequence(0L, (copies - 1) div 1000))"))
    counted = counted.withColumn("copy", F.expr("explode(sequence(thousand * 1000, least(copies - 1, thousand * 1000 + 999)))"))
    begin = F.col("ahead") + F.col("before") + F.col("copy") * F.col("size")
    return counted.select("source", "doc_id", "size", "copy", begin.alias("begin"), "source_size", "target", "blocks")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, cap: int = CAP, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The documents as in ``placed``, and the mix in rows of source, slot (to order by), doc_id, size, copy, start (first
    word taken of the document) and words."""
    rows = checkpointed(keys(docs, seed))
    found = checkpointed(sources(rows, weights, share, cap))
    lines = checkpointed(placed(rows, found))
    n_slots = found.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    turns = schedule(found, max(1, (max(n_slots, 1) - 1).bit_length())).select(F.col("source").alias("s"), "slot", F.col("block").alias("b"))
    of = "((CAST({0} AS DECIMAL(38, 0)) + 1) * blocks - 1) div source_size"
    cut = lines.where("size > 0").withColumn("block", F.expr(f"explode(sequence({of.format('begin')}, {of.format('(begin + size - 1)')}))"))
    edge = "(CAST(block + {0} AS DECIMAL(38, 0)) * source_size) div blocks"
    cut = cut.withColumn("start", F.expr(f"greatest(begin, {edge.format(0)})")).withColumn("end", F.expr(f"least(begin + size, {edge.format(1)})"))
    met = cut.join(turns, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    return lines, met.select("source", "slot", "doc_id", "size", "copy", (F.col("start") - F.col("begin")).alias("start"), (F.col("end") - F.col("start")).alias("words"))


def mixing(docs: DataFrame) -> DataFrame:
    """The query: how many words of every document the mix takes."""
    lines, mixed = mix(docs)
    every = ["source", "doc_id", "size", "copy"]
    figures = ["source_size", "target"]
    nothing = [F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in figures]
    both = lines.select(*every, *figures, F.lit(0).cast("long").alias("words")).union(mixed.select(*every, *nothing, "words"))
    taken = both.groupBy(*every).agg(*[F.max(c).alias(c) for c in figures], F.sum("words").alias("taken"))
    return taken.select("doc_id", "size", *figures, "taken")


MIXING_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':13') AS hash
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS words, CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS HUGEINT) AS weight
  FROM rows GROUP BY source),
-- Sources by cap over weight: with the first k at their caps, the others share what is left.
lined AS (
  SELECT *, row_number() OVER w AS place, sum(words) OVER () AS total,
         coalesce(sum(words) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
         sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM sources WINDOW w AS (ORDER BY CAST(words AS DOUBLE) / CAST(weight AS DOUBLE), source)),
level AS (
  SELECT CAST(3 * total - 4 * full_before AS HUGEINT) AS num, CAST(2 * weight_left AS HUGEINT) AS den, place FROM lined
  WHERE 2 * words * 2 * weight_left > (3 * total - 4 * full_before) * weight ORDER BY place LIMIT 1),
targets AS (
  SELECT source, words, capped, CASE WHEN capped THEN CAST(2 * words AS DOUBLE) ELSE CAST(num * weight AS DOUBLE) / CAST(den AS DOUBLE) END AS target,
         blocks, CASE WHEN words = 0 THEN 0 WHEN capped THEN 2 * blocks ELSE (2 * num * weight * blocks + den * words) // (2 * den * words) END AS slots
  FROM (SELECT s.*, num, den, num IS NULL OR 2 * words * den <= num * weight AS capped, least(words, greatest((words + 1023) // 1024, 128)) AS blocks
        FROM sources s LEFT JOIN level ON true)),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY hash, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin FROM rows)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(words AS BIGINT) AS source_size, target,
       CAST(CASE WHEN words = 0 THEN 0 ELSE (slots // blocks) * size + greatest(0, least(begin + size, (slots % blocks) * words // blocks) - begin) END AS BIGINT) AS taken
FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source
"""
