"""Chat formatting with cumulative-snapshot collapse, in DataFrame functions only.

A conversation is logged anew after each exchange, so many logs are prefixes of longer ones. Turns are compared by
number, role and text. The hash of a conversation up to a turn is the exclusive or of its turns' 128-bit hashes: it
can be summed in any order and rolls on from chunk to chunk of turns, so no task needs a whole conversation. A
conversation goes if its whole hash is the hash of another's beginning (anti-join); of conversations with the
same turns the one with the least id stays. What is left is rendered in segments of 64 turns.

Rows: repeated rows of a conversation count once. Turns with the same number are ordered by role and text, however many
they are: a segment of over 1000 rows is cut into parts by a sort over all such rows, and its parts follow one another. Rows without a conversation id are one conversation
without an id; turns without a number come first; a NULL role is shown as ``unknown``, a NULL text is empty.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.llm.common import checkpointed

CHUNK = 1024
SEGMENT = 64
CROWD = 1000


def _hash(seed: str) -> Column:
    marked = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in ("turn", "role", "text")]
    return F.xxhash64(F.lit(seed), *marked)


def turn_hashes(turns: DataFrame) -> DataFrame:
    """A row for each turn number of a conversation: x and y, the two halves of the hash, and n, its distinct rows."""
    rows = turns.select("conv_id", "turn", _hash("x").alias("x"), _hash("y").alias("y")).distinct()
    return rows.groupBy("conv_id", "turn").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.count("*").alias("n"))


def prefixes(hashes: DataFrame) -> DataFrame:
    """conv_id, turn, and x, y, n of the conversation up to that turn: chunks are rolled up first, then the turns inside
    each chunk."""
    hashes = hashes.withColumn("chunk", F.floor(F.col("turn") / CHUNK))
    sums = [F.bit_xor("x").alias("cx"), F.bit_xor("y").alias("cy"), F.sum("n").alias("cn")]
    chunks = hashes.groupBy(F.col("conv_id").alias("c"), F.col("chunk").alias("k")).agg(*sums)
    before = Window.partitionBy("c").orderBy(F.col("k").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    ahead = chunks.select("c", "k", *[F.coalesce(f(x).over(before), F.lit(0)).alias(x) for f, x in ((F.bit_xor, "cx"), (F.bit_xor, "cy"), (F.sum, "cn"))])
    inside = Window.partitionBy("conv_id", "chunk").orderBy(F.col("turn").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    rolled = hashes.select("conv_id", "turn", "chunk", *[f(x).over(inside).alias(x) for f, x in ((F.bit_xor, "x"), (F.bit_xor, "y"), (F.sum, "n"))])
    both = rolled.join(ahead, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("chunk").eqNullSafe(F.col("k")))
    return both.select("conv_id", "turn", F.expr("x ^ cx").alias("x"), F.expr("y ^ cy").alias("y"), (F.col("n") + F.col("cn")).alias("n"))


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id and copies: the conversations that are no beginning of another, and how many have the same turns."""
    hashes = checkpointed(turn_hashes(turns))
    whole = hashes.groupBy("conv_id").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("n").alias("n"))
    # A conversation's own end is no proper beginning: the last prefix has all of its rows.
    size = whole.select(F.col("conv_id").alias("c"), F.col("n").alias("all"))
    inner = prefixes(hashes).join(size, F.col("conv_id").eqNullSafe(F.col("c"))).filter("n < all").select("x", "y", "n").distinct()
    distinct = whole.groupBy("x", "y", "n").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    return distinct.join(inner, ["x", "y", "n"], "left_anti").select("conv_id", "copies")


def render(turns: DataFrame, segment: int = SEGMENT, crowd: int = CROWD) -> DataFrame:
    """conv_id, segment, part, n_turns and text: the turns of each conversation between role marks, in order. Segments in
    order, parts in order within, give the whole."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    rows = rows.withColumn("segment", F.floor(F.col("turn") / segment))
    crowded = rows.groupBy(F.col("conv_id").alias("c"), F.col("segment").alias("s")).agg(F.count("*").alias("n")).filter(F.col("n") > crowd)
    crowded = checkpointed(crowded.select("c", "s"))
    inside = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("segment").eqNullSafe(F.col("s"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    # Rows in order, in partitions of which each holds a stretch: a part is up to ``crowd`` neighbours of one partition.
    many = checkpointed(rows.join(crowded, inside, "left_semi").orderBy(*order))
    place = F.monotonically_increasing_id()
    part = F.shiftright(place, 33) * (1 << 33) + F.floor(place.bitwiseAND((1 << 33) - 1) / crowd) + 1
    rows = rows.join(crowded, inside, "left_anti").withColumn("part", F.lit(0).cast("long")).unionByName(many.withColumn("part", part))
    held = rows.groupBy("conv_id", "segment", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    shown = F.array_join(F.transform("turns", lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("\n<|end|>\n"))), "")
    return held.select("conv_id", "segment", "part", F.size("turns").cast("long").alias("n_turns"), shown.alias("text"))


def chat_format(turns: DataFrame) -> DataFrame:
    """The query: the maximal conversations, rendered."""
    kept = checkpointed(maximal(turns)).withColumnRenamed("conv_id", "c")
    rows = turns.select("conv_id", "turn", "role", "text").join(kept, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
    return render(rows)


CHAT_SQL = f"""
WITH r AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM r),
t AS (SELECT conv_id, turn, list(md5(concat_ws('=', turn, role, text)) ORDER BY i) AS h FROM o GROUP BY conv_id, turn),
p AS (SELECT conv_id, md5(CAST(list(h) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS VARCHAR)) AS h,
  turn IS NOT DISTINCT FROM max(turn) OVER (PARTITION BY conv_id) AS whole FROM t),
m AS (SELECT min(conv_id) AS conv_id FROM p WHERE whole AND h NOT IN (SELECT h FROM p WHERE NOT whole) GROUP BY h)
SELECT conv_id, CAST(floor(turn / {SEGMENT}) AS BIGINT) AS segment, CAST(0 AS BIGINT) AS part, count(*) AS n_turns,
  string_agg('<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10), '' ORDER BY i) AS text
FROM o JOIN m USING (conv_id) GROUP BY conv_id, floor(turn / {SEGMENT})
"""
