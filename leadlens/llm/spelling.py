"""Spelling variants: words that differ by one inserted, deleted or replaced letter, each led to its frequent form.

Words are runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case, of six letters and five occurrences or more. One
run in 199, by the checksum of id and run, loses a letter first (planted slips to be found). An edit changes the letter
counts of a word by a squared distance of one (inserted, deleted) or two (replaced), and its length by one at most. Words
are therefore blocked by length and by their numbers of letters in three classes; only blocks that one edit can join are
compared, in parts of bounded size: the product of two parts' letter-count matrices gives all squared distances, and the
pairs at most two apart are verified letter by letter. Blocks are cut as fine as their size asks for, no pair is left out.

A word's form is its near word with the largest count, if that is five times its own. Counts grow along forms, so chains
are short: their ends are found by doubling steps.

Rows: NULL and empty texts have no words; a NULL id counts as an empty one. Repeated rows count as often as they stand
there. Runs of any length are words. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import bound_batches, checkpointed, in_parts, utf8, word_hashes
from leadlens.llm.grams import run_bounds

LEAST_LETTERS, LEAST_COUNT, RATIO, SLIP = 6, 5, 5, 199
#: Words and letters that a part of a block holds at most, in expectation.
PART_WORDS, PART_LETTERS = 2048, 1 << 16
#: Two of the classes of letters; all others are the third.
CLASSES = ("aeiou", "lnrst")
_HELD = 1 << 17

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, np.uint32(0xEDB88320) ^ (_CRC >> np.uint32(1)), _CRC >> np.uint32(1))


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each run of bytes, carried on from the checksum ``before`` it. Long runs one by one, the others a byte of each at a time."""
    out = before.astype(np.uint32)
    long = np.flatnonzero(ends - starts > 48)
    for i in long:
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(before[i]))
    order = np.flatnonzero(ends - starts <= 48)
    order = order[np.argsort(starts[order] - ends[order], kind="stable")]
    at, sizes = starts[order], (ends - starts)[order]
    state = ~out[order]
    for k in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -k))  # runs of more than k bytes stand first
        state[:n] = _CRC[(state[:n] ^ data[at[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out[order] = ~state
    return out


def slipped(run: str, checksum: int) -> str:
    at = checksum % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, least_letters: int = LEAST_LETTERS, least: int = LEAST_COUNT, slip: int = SLIP) -> DataFrame:
    """word and n (occurrences) of all words long and frequent enough."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            batch = pa.record_batch({"word": pa.array(list(held), pa.binary()).cast(pa.string()), "n": pa.array(held.values(), pa.int64())})
            held.clear()
            return batch

        for batch in in_parts(batches, "text", 1 << 20):
            data, offsets = utf8(batch.column(0))
            letter = _LETTER[data] | (data == 0xC3)
            letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0xBF)
            starts, ends, first = run_bounds(letter, offsets)
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            enough = points[ends] - points[starts] >= least_letters
            starts, ends, row = starts[enough], ends[enough], row[enough]
            data = _LOWER[data]
            ids = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in batch.column(1).to_pylist()], np.uint32)
            sums = checksums(data, starts, ends, ids[row])
            slips = sums % slip == 0
            for s, e, c in zip(starts[slips], ends[slips], sums[slips], strict=True):
                word = slipped(data[s:e].tobytes().decode(), int(c))
                if len(word) >= least_letters:
                    held[word.encode()] = held.get(word.encode(), 0) + 1
            starts, ends = starts[~slips], ends[~slips]
            _, one, counts = np.unique(word_hashes(data, starts, ends), return_index=True, return_counts=True)
            whole = data.tobytes()
            for s, e, n in zip(starts[one].tolist(), ends[one].tolist(), counts.tolist(), strict=True):
                held[whole[s:e]] = held.get(whole[s:e], 0) + n
            if len(held) >= _HELD:
                yield out()
        yield out()

    rows = docs.select("text", "doc_id").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


#: Changes of (length, letters of the first class, of the second) that an edit can make, one of each pair of opposites.
_MOVES = [(0, 0, 0), (0, 1, 0), (0, 0, 1), (0, 1, -1), (1, 0, 0), (1, 1, 0), (1, 0, 1)]


def parts(words: DataFrame) -> DataFrame:
    """``words`` with block (length, letters of two classes) and the number of its part in the block."""
    inside = [F.length("word").alias("a"), *[F.length(F.regexp_replace("word", f"[^{c}]", "")).alias(x) for c, x in zip(CLASSES, "bc", strict=True)]]
    blocked = words.select("word", "n", F.struct(*inside).alias("block"))
    sizes = blocked.groupBy(F.col("block").alias("of")).agg(F.count("*").alias("words"))
    wanted = F.greatest(F.ceil(F.col("words") / PART_WORDS), F.ceil(F.col("words") * F.col("of.a") / PART_LETTERS))
    sizes = checkpointed(sizes.select("of", wanted.cast("int").alias("parts")))
    moves = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip("abc", move, strict=True)]) for move in _MOVES])
    pairs = sizes.withColumn("move", F.explode(moves))
    moved = F.struct(*[(F.col(f"of.{x}") + F.col(f"move.{x}")).alias(x) for x in "abc"])
    pairs = pairs.select("of", "parts", moved.alias("to"))
    pairs = pairs.join(sizes.select(F.col("of").alias("to"), F.col("parts").alias("to_parts")), "to")
    placed = blocked.join(sizes, F.col("block") == F.col("of")).select("word", "n", "block", F.expr("CAST(pmod(xxhash64(word), parts) AS INT)").alias("part"))
    same = F.col("of") == F.col("to")
    # Every part of a block meets every part of the blocks one edit away; within a block each pair of parts once.
    left = placed.join(pairs, F.col("block") == F.col("of")).withColumn("other", F.explode(F.sequence(F.when(same, F.col("part")).otherwise(0), F.col("to_parts") - 1)))
    right = placed.join(pairs, F.col("block") == F.col("to")).withColumn("other", F.explode(F.sequence(F.lit(0), F.when(same, F.col("part")).otherwise(F.col("parts") - 1))))
    left = left.select(F.lit(0).alias("side"), "of", "to", F.col("part").alias("i"), F.col("other").alias("j"), "word", "n")
    return left.union(right.select(F.lit(1).alias("side"), "of", "to", F.col("other").alias("i"), F.col("part").alias("j"), "word", "n"))


def _codes(words: pa.ChunkedArray) -> np.ndarray:
    """Words of one length as rows of letters; every letter is one byte of Latin-1."""
    joined = "".join(words.to_pylist()).encode("latin-1")
    return np.frombuffer(joined, np.uint8).reshape(len(words), -1)


def _letter_counts(codes: np.ndarray) -> np.ndarray:
    n = len(codes)
    flat = (np.arange(n)[:, None] * 256 + codes).ravel()
    return np.bincount(flat, minlength=256 * n).reshape(n, 256).astype(np.float32)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of letters differ by one edit; rows of ``b`` are as long as those of ``a`` or one longer."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= a.shape[1]


NEAR = pa.schema([("word", pa.string()), ("n", pa.int64()), ("other", pa.string()), ("other_n", pa.int64())])


def near_in_parts(group: pa.Table) -> pa.Table:
    """word, n, other, other_n of the near pairs of two parts, or inside one."""
    side = group["side"].to_numpy()
    a, b = (group.take(np.flatnonzero(side == s)) for s in (0, 1))
    if not a.num_rows or not b.num_rows:
        return NEAR.empty_table()
    x, y = _codes(a["word"]), _codes(b["word"])
    gx, gy = _letter_counts(x), _letter_counts(y)
    used = gx.any(axis=0) & gy.any(axis=0)
    # |x|^2 + |y|^2 - 2 x.y <= 2
    least = ((gx**2).sum(axis=1)[:, None] + (gy**2).sum(axis=1)[None, :]) / 2 - 1
    i, j = np.nonzero(gx[:, used] @ gy[:, used].T >= least)
    step = max(1, (4 << 20) // x.shape[1])
    good = [np.zeros(0, bool)] + [one_edit(x[i[s : s + step]], y[j[s : s + step]]) for s in range(0, len(i), step)]
    good = np.concatenate(good)
    if group["of"][0] == group["to"][0] and group["i"][0] == group["j"][0]:  # both sides hold the same words
        order = [np.argsort(np.argsort(np.array(t["word"].to_pylist(), object))) for t in (a, b)]
        good &= order[0][i] < order[1][j]
    i, j = i[good], j[good]
    near, other = a.take(i), b.take(j)
    return pa.table([near["word"], near["n"], other["word"], other["n"]], names=NEAR.names).cast(NEAR)


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, other, other_n: every pair of near words once."""
    return parts(words).groupBy("of", "to", "i", "j").applyInArrow(near_in_parts, "word string, n long, other string, other_n long")


def spelling_forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n)."""
    pairs = checkpointed(near_pairs(words))
    both = pairs.union(pairs.select("other", "other_n", "word", "n"))
    best = both.groupBy("word").agg(F.max("n").alias("own"), F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best"))
    frequent = -F.col("best.m") >= ratio * F.col("own")
    best = best.select("word", "n_near", F.when(frequent, F.col("best.other")).alias("form"), F.when(frequent, -F.col("best.m")).alias("form_n"))
    best = checkpointed(best)
    links = best.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # A chain of forms multiplies the count by the ratio at every step: its length, and so the number of doublings, is bounded.
    highest = words.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    length, reach = 1, 1
    while ratio**length <= highest:
        length += 1
    while reach < length:
        onward = links.select(F.col("word").alias("at"), F.col("root").alias("next"))
        links = checkpointed(links.join(onward, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root")))
        reach *= 2
    out = words.join(best, "word", "left").join(links, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def spelling(docs: DataFrame) -> DataFrame:
    """The query: forms of all words of the documents."""
    return spelling_forms(checkpointed(word_counts(docs)))


SPELLING_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
  FROM documents),
counted AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY id, run),
polynomial AS (
  SELECT 0 AS step, i, CAST(i AS UBIGINT) AS value FROM range(256) t(i)
  UNION ALL
  SELECT step + 1, i, CASE WHEN value & 1 = 1 THEN xor(3988292384::UBIGINT, value >> 1) ELSE value >> 1 END FROM polynomial WHERE step < 8),
lookup AS (SELECT list(value ORDER BY i) AS of FROM polynomial WHERE step = 8),
-- Letters above U+007F are two bytes of UTF-8: 0xC3 and the code point less 64.
bytes AS (
  SELECT run, n, flatten(list_transform(string_split(id || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END)) AS codes
  FROM counted),
summed AS (
  SELECT run, n, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(codes, lambda c: CAST(c AS UBIGINT))),
         lambda s, b: xor(s >> 8, of[CAST(xor(s, b) & 255 AS BIGINT) + 1]))) AS h
  FROM bytes, lookup),
slipped AS (
  SELECT n, CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM summed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
gaps AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT g.word, g.n, w.word, w.n FROM gaps g JOIN words w ON g.rest = w.word
  UNION SELECT w.word, w.n, g.word, g.n FROM gaps g JOIN words w ON g.rest = w.word),
best AS (
  SELECT word, n, count(*) OVER (PARTITION BY word) AS n_near, other, other_n FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chains AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL
  SELECT c.word, f.word, f.form FROM chains c JOIN formed f ON c.next = f.word)
SELECT f.word, f.form, c.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM formed f JOIN chains c ON c.word = f.word AND c.next IS NULL
"""
