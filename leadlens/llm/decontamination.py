"""Benchmark decontamination by template canonicalisation.

Texts become sequences of tokens: words cut at ASCII white space, without leading and trailing punctuation, with A-Z
and the accented capitals of Latin-1 in lower case. Numbers (in digits or in English, German, French or Spanish words), quantities
(``3kg``), units after a number, and names (words that begin with a capital, also at the beginning of a sentence, where questions mostly
have them) are replaced by typed placeholders, whose values are kept as slots. Several names or number words in a row, with no mark
between them, are one placeholder. Windows of eight tokens with at least four plain words are hashed and joined with those of the
benchmark. Matches of a document and an item on one diagonal are an occurrence; it counts if its slots are consistent: each
value of the item always stands for one value of the document and the other way round. Windows whose slots did not change count in
any case. An item is found in a document if half of its windows are, or 18 of them (25 tokens). Equal windows of a
document, or of an item, with equal slots are one row with its first position, so texts that repeat themselves make no more rows than
they have different windows.

Verbatim copies are also looked for as they are, whatever their case and however few plain words they have: in windows
of eight tokens without placeholders, case-folded, with words of nothing but marks as tokens. In scripts without
spaces (Chinese, Japanese, Thai, Lao, Burmese, Khmer) each character is a token. The same share of an item's windows makes a find.

Rows: a NULL or empty text matches nothing. An item of fewer than eight tokens is one window of its own width: with
placeholders if it has four plain words, verbatim if it has ``least_tokens`` tokens and ``least_chars`` characters. Shorter items stand
inside too many texts and are not looked for, but with ``lines``, which finds those that are a line of their own, whatever the
case and the spaces. Repeated items are reported each; repeated rows are one document, as are rows that share id and text. Results name the id, NULL where a document has none. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import bound_batches, checkpointed, free_name, in_parts, utf8, windows, word_bounds, word_hashes

WIDTH = 8
LEAST_PLAIN = 4
LEAST_TOKENS, LEAST_CHARS = 3, 8
#: Windows whose hashes may be sent to every task to sift documents' windows: 16 MB. Beyond it all windows are joined.
SMALL_WINDOWS = 2_000_000
SHARE, ENOUGH = 0.5, 18
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg lb lbs pound pounds oz ounce ounces ton tons tonnes "
    "ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years % percent degrees dollar dollars cent cents euro euros km/h mph kmh kw kwh w v hz kb mb gb tb"
).split()
# Number words; those that are articles too are left out.
ONES = "one two three four five six seven eight nine zwei drei vier fünf sechs sieben acht neun deux trois quatre cinq sept huit neuf dos tres cuatro cinco seis siete ocho nueve".split()
TENS = (
    "twenty thirty forty fifty sixty seventy eighty ninety zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig "
    "vingt trente quarante cinquante soixante veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa"
).split()
OTHERS = (
    "zero ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen hundred thousand million billion dozen half "
    "null zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn neunzehn hundert tausend dutzend "
    "zéro dix onze douze treize quatorze quinze seize cent mille douzaine cero diez once doce trece catorce quince cien ciento mil docena"
).split()
NUMBER, QUANTITY, UNIT, NAME = (np.uint64(x) for x in (11, 12, 13, 14))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _flags(of: bytes | range) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(of)] = True
    return table


_DIGIT, _UPPER, _STOP = _flags(range(48, 58)), _flags(range(65, 91)), _flags(b".!?:")
_LETTER = _flags([*range(65, 91), *range(97, 123), *range(128, 256)])
_CORE = _DIGIT | _LETTER | _flags(b"%")


def _hashes_of(words: list[str]) -> np.ndarray:
    data, offsets = utf8(pa.array([" ".join(words)]))
    starts, ends, _ = word_bounds(data, offsets)
    return np.unique(word_hashes(data, starts, ends))


def number_words() -> list[str]:
    """The simple ones, and those made of tens and ones: ``twenty-five``, ``fünfundzwanzig``."""
    made = [f"{ten}-{one}" for ten in TENS for one in ONES] + [f"{one}und{ten}" for ten in TENS for one in ["ein", *ONES]]
    return [*ONES, *TENS, *OTHERS, *made]


def _among(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    return words[np.minimum(np.searchsorted(words, hashes), len(words) - 1)] == hashes


_UNIT_HASHES, _NUMBER_HASHES = _hashes_of(UNITS), _hashes_of(number_words())


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token its template (a placeholder or the word's hash) and the word's hash, and each row's first token, one
    more for the end."""
    data, offsets = utf8(column)
    starts, ends, first = word_bounds(data, offsets)
    core = np.flatnonzero(_CORE[data])
    a = np.searchsorted(core, starts)
    b = np.searchsorted(core, ends)
    real = b > a  # words of nothing but marks are left out
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    opens = np.ones(len(starts), bool)  # stands at a sentence's or line's beginning
    line = np.concatenate(([0], np.cumsum(data == 10)))
    opens[1:] = _STOP[last[:-1]] | (row[1:] != row[:-1]) | (line[starts[1:]] > line[ends[:-1]])
    tight = (core[np.minimum(b, max(len(core), 1)) - 1] + 1 == ends) if len(core) else np.zeros(len(starts), bool)  # no mark follows
    next_is_word = np.ones(len(starts), bool)
    next_is_word[:-1] = real[1:]
    tight &= next_is_word
    starts, ends, opens, row, tight = core[a[real]], core[b[real] - 1] + 1, opens[real], row[real], tight[real]
    lower = _LOWER[data]
    lower[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)] += 32
    hashes = word_hashes(lower, starts, ends)

    def count(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(table[data])))
        return sums[ends] - sums[starts]

    digits, letters = count(_DIGIT), count(_LETTER)
    number = (digits > 0) & (letters == 0) | _among(hashes, _NUMBER_HASHES)
    quantity = (digits > 0) & (letters > 0) & _DIGIT[data[starts]]
    after = np.zeros(len(starts), bool)
    after[1:] = number[:-1] & (row[1:] == row[:-1])
    unit = after & _among(hashes, _UNIT_HASHES) & ~number
    second = data[np.minimum(starts + 1, max(len(data) - 1, 0))] if len(starts) else last[:0]
    accented = (data[starts] == 0xC3) & (second >= 0x80) & (second <= 0x9E)  # capital letters with accents
    name = (_UPPER[data[starts]] | accented) & ~(_UPPER[second] & (ends - starts > 1)) & (digits == 0)
    template = hashes.copy()
    for flag, mark in ((name, NAME), (unit, UNIT), (quantity, QUANTITY), (number, NUMBER)):
        template[flag] = mark
    # Names or numbers in a row are one token, whose value is made of all of theirs.
    joined = np.zeros(len(starts), bool)
    joined[1:] = (template[1:] == template[:-1]) & ((template[1:] == NAME) | (template[1:] == NUMBER)) & (row[1:] == row[:-1]) & ~opens[1:] & tight[:-1]
    heads = np.flatnonzero(~joined)
    if len(heads) < len(starts):
        within = np.arange(len(starts)) - np.repeat(heads, np.diff(np.append(heads, len(starts))))
        with np.errstate(over="ignore"):
            hashes = np.add.reduceat(hashes * (np.uint64(0x9E3779B97F4A7C15) ** within.astype(np.uint64)), heads)
        template, row = template[heads], row[heads]
        template[template > NAME] = hashes[template > NAME]
    return template, hashes, np.searchsorted(row, np.arange(len(offsets)))


WINDOW = "hash long, position int, width int, slots array<long>"


def template_windows(docs: DataFrame, keys: list[str], wanted: np.ndarray | None = None, widths: tuple[int, ...] = (WIDTH,)) -> DataFrame:
    """A row for each window of ``docs`` (text and ``keys``) with enough plain words: ``keys``, hash, position, width and
    slots; only those whose hash is in ``wanted``, if given. A text shorter than the first of ``widths`` is one window."""
    sifted = None
    if wanted is not None:
        bits = np.zeros(1 << 20, bool)
        bits[wanted.view(np.uint64) >> np.uint64(44)] = True
        sifted = docs.sparkSession.sparkContext.broadcast((bits, np.sort(wanted)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, "text"):
            template, hashes, first = tokens(batch.column(0))
            plain = np.concatenate(([0], np.cumsum(template > NAME)))
            for width in widths:
                hash_, begins = windows(template, first, width)
                row = np.repeat(np.arange(len(first) - 1), np.diff(begins))
                position = np.arange(len(hash_)) - begins[row]
                at = first[row] + position
                ends = np.minimum(at + width, first[1:][row])
                usable = (plain[ends] - plain[at] >= LEAST_PLAIN) & ((width == widths[0]) | (ends - at == width))
                if sifted is not None:
                    bits, some = sifted.value
                    found = np.flatnonzero(usable & bits[hash_ >> np.uint64(44)])
                    near = np.minimum(np.searchsorted(some, hash_[found].view(np.int64)), max(len(some) - 1, 0))
                    found = found[some[near] == hash_[found].view(np.int64)] if len(some) else found[:0]
                else:
                    found = np.flatnonzero(usable)
                for part in np.array_split(found, len(found) // 20_000 + 1):
                    slots = [hashes[s:e][template[s:e] <= NAME].view(np.int64) for s, e in zip(at[part], ends[part], strict=True)]
                    columns = [c.take(pa.array(row[part])) for c in batch.columns[1:]]
                    columns += [pa.array(hash_[part].view(np.int64)), pa.array(position[part].astype(np.int32))]
                    columns += [pa.array((ends - at)[part].astype(np.int32)), pa.array(slots, pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, names=[*keys, "hash", "position", "width", "slots"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keys).schema)
    return docs.select("text", *keys).mapInArrow(run, f"{schema}, {WINDOW}")


_BLANK = re.compile("[\u00a0\u2000-\u200a\u202f\u205f\u3000]")
_ALONE = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u30ff\u3100-\u312f\u31a0-\u9fff\uf900-\ufaff\uff00-\uff9f\U00020000-\U0003ffff])")


def _folded(text: str | None) -> str:
    """Case-folded, with characters of scripts without spaces cut apart."""
    text = (text or "").casefold()
    return text if text.isascii() else _ALONE.sub(r" \1 ", _BLANK.sub(" ", text))


def verbatim_tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token the hash of its case-folded word, without marks around it unless it has nothing else, and its
    characters; and each row's first token, one more for the end."""
    data, offsets = utf8(pa.array([_folded(x) for x in column.to_pylist()], pa.large_string()))
    starts, ends, first = word_bounds(data, offsets)
    core = np.flatnonzero(_CORE[data])
    a, b = np.searchsorted(core, starts), np.searchsorted(core, ends)
    real = b > a
    starts, ends = starts.copy(), ends.copy()
    starts[real], ends[real] = core[a[real]], core[b[real] - 1] + 1
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return word_hashes(data, starts, ends), chars[ends] - chars[starts], first


def verbatim_windows(
    docs: DataFrame, keys: list[str], wanted: np.ndarray | None = None, widths: tuple[int, ...] = (WIDTH,), least_tokens: int = LEAST_TOKENS, least_chars: int = LEAST_CHARS
) -> DataFrame:
    """``keys``, hash, position and width of the windows of tokens as they stand; otherwise as ``template_windows``."""
    sifted = None if wanted is None else docs.sparkSession.sparkContext.broadcast(np.sort(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << 20, bool)
        if sifted is not None:
            bits[sifted.value.view(np.uint64) >> np.uint64(44)] = True
        for batch in in_parts(batches, "text"):
            hashes, chars, first = verbatim_tokens(batch.column(0))
            chars = np.concatenate(([0], np.cumsum(chars)))
            for width in widths:
                hash_, begins = windows(hashes, first, width)
                row = np.repeat(np.arange(len(first) - 1), np.diff(begins))
                position = np.arange(len(hash_)) - begins[row]
                at = first[row] + position
                ends = np.minimum(at + width, first[1:][row])
                usable = (ends - at >= least_tokens) & (chars[ends] - chars[at] >= least_chars) & ((width == widths[0]) | (ends - at == width))
                if sifted is not None:
                    usable &= bits[hash_ >> np.uint64(44)]
                found = np.flatnonzero(usable)
                if sifted is not None:
                    found = found[np.isin(hash_[found].view(np.int64), sifted.value)]
                for part in np.array_split(found, len(found) // 20_000 + 1):
                    columns = [c.take(pa.array(row[part])) for c in batch.columns[1:]]
                    columns += [pa.array(hash_[part].view(np.int64)), pa.array(position[part].astype(np.int32)), pa.array((ends - at)[part].astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, names=[*keys, "hash", "position", "width"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keys).schema)
    return docs.select("text", *keys).mapInArrow(run, f"{schema}, hash long, position int, width int")


def few_hashes(items: DataFrame) -> np.ndarray | None:
    """The distinct hashes of the items' windows, None if they are too many to broadcast."""
    hashes = items.select("hash").distinct()
    return np.array([r["hash"] for r in hashes.toLocalIterator()], np.int64) if hashes.count() <= SMALL_WINDOWS else None


def all_widths(items: DataFrame) -> tuple[int, ...]:
    """Items of fewer than eight tokens are looked for in windows of their own widths."""
    return WIDTH, *sorted(r["width"] for r in items.filter(F.col("width") < WIDTH).select("width").distinct().collect())


def enough_found(found: DataFrame, items: DataFrame, share: float, enough: int) -> DataFrame:
    """The rows of ``found`` (item_key, found_windows) whose windows are enough, with item_windows."""
    sizes = items.groupBy(F.col("item_key").alias("k")).agg(F.count("*").alias("item_windows"))
    least = F.least(F.lit(float(enough)), F.lit(share) * F.col("item_windows"))
    return found.join(sizes, F.col("item_key") == F.col("k")).drop("k").filter(F.col("found_windows") >= least)


def line_finds(rows: DataFrame, items: DataFrame) -> DataFrame:
    """What ``verbatim_finds`` returns, of items that are a line of a document."""
    plain = lambda text: F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))
    wanted = items.select("item_key", "item_id", plain(F.col("text")).alias("line")).where("line <> ''")
    lines = rows.select("doc_key", "doc_id", F.explode(F.split("text", "\n")).alias("raw")).select("doc_key", "doc_id", plain(F.col("raw")).alias("line"))
    found = lines.where("line <> ''").distinct().join(wanted, "line").select("doc_key", "doc_id", "item_key", "item_id").distinct()
    return found.select("*", *[F.lit(n).cast("long").alias(c) for c, n in (("found_windows", 1), ("item_windows", 1), ("changed_slots", 0))])


def verbatim_finds(rows: DataFrame, texts: DataFrame, share: float, enough: int, least_tokens: int, least_chars: int, lines: bool) -> DataFrame:
    """What ``contaminated`` returns, with item_key, of items whose windows stand in ``rows`` as they are."""
    items = checkpointed(verbatim_windows(texts, ["item_key", "item_id"], least_tokens=least_tokens, least_chars=least_chars))
    ours = verbatim_windows(rows, ["doc_key", "doc_id"], few_hashes(items), all_widths(items), least_tokens, least_chars).select("doc_key", "doc_id", "hash").distinct()
    met = ours.join(items.select("item_key", "item_id", F.col("hash").alias("item_hash")), F.col("hash") == F.col("item_hash"))
    found = met.groupBy("doc_key", "doc_id", "item_key", "item_id").agg(F.count("*").alias("found_windows"))  # a row for each position of the item
    found = enough_found(found, items, share, enough).withColumn("changed_slots", F.lit(0).cast("long"))
    if not lines:
        return found
    short = checkpointed(texts.join(items.select("item_key").distinct(), "item_key", "left_anti").where("trim(text) <> ''"))
    return found.unionByName(line_finds(rows, short))


def document_key(docs: DataFrame) -> Column:
    """One number for id and text; rows that share it are the same document."""
    return F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, share: float = SHARE, enough: int = ENOUGH, least_tokens: int = LEAST_TOKENS, least_chars: int = LEAST_CHARS,
    lines: bool = False,
) -> DataFrame:
    """doc_key, doc_id, item_id, item_windows, found_windows and changed_slots of every item found in a document."""
    bound_batches(docs.sparkSession)
    texts = benchmark.select("item_id", "text").withColumn("item_key", F.xxhash64("item_id", F.coalesce("text", F.lit("")))).dropDuplicates(["item_key"])
    items = checkpointed(template_windows(texts, ["item_key", "item_id"]))
    rows = docs.select("doc_id", "text").withColumn("doc_key", document_key(docs))
    ours = template_windows(rows, ["doc_key", "doc_id"], few_hashes(items), all_widths(items))
    one = items.groupBy("item_key", "item_id", F.col("hash").alias("item_hash"), F.col("slots").alias("item_slots"))
    theirs = one.agg(F.min("position").alias("item_position"), F.count("*").alias("places"))
    met = ours.groupBy("doc_key", "doc_id", "hash", "slots").agg(F.min("position").alias("position"))
    met = met.join(theirs, F.col("hash") == F.col("item_hash")).select(
        "doc_key", "doc_id", "item_key", "item_id", F.struct("item_position", "places").alias("place"),
        (F.col("position") - F.col("item_position")).alias("diagonal"),
        F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d")).alias("pairs"),
    )
    # An occurrence has at most one match for each position of the item.
    occurrence = met.groupBy("doc_key", "doc_id", "item_key", "item_id", "diagonal").agg(F.collect_list(F.struct("place", "pairs")).alias("matches"))
    pairs = F.array_distinct(F.flatten(F.col("matches.pairs")))
    consistent = (F.size(F.array_distinct(F.col("slots.i"))) == F.size("slots")) & (F.size(F.array_distinct(F.col("slots.d"))) == F.size("slots"))
    same = F.filter("matches", lambda m: F.forall(m["pairs"], lambda p: p["i"] == p["d"]))
    occurrence = occurrence.withColumn("slots", pairs).withColumn("counted", F.when(consistent, F.col("matches")).otherwise(same))
    changed = F.size(F.filter("slots", lambda p: p["i"] != p["d"]))
    found = occurrence.filter(F.size("counted") > 0).groupBy("doc_key", "doc_id", "item_key", "item_id")
    found = found.agg(
        F.array_distinct(F.flatten(F.collect_set(F.col("counted.place")))).alias("found_places"),
        F.min(F.when(consistent, changed)).cast("long").alias("changed_slots"),
    )
    found = enough_found(found.withColumn("found_windows", F.aggregate("found_places", F.lit(0).cast("long"), lambda n, p: n + p["places"])).drop("found_places"), items, share, enough)
    # An item found by both keys is reported by its templates.
    figures = ["item_windows", "found_windows", "changed_slots"]
    keys = ["doc_key", "doc_id", "item_key", "item_id"]
    either = found.select(*keys, F.struct(F.lit(0).alias("by"), *figures).alias("found"))
    either = either.union(verbatim_finds(rows, texts, share, enough, least_tokens, least_chars, lines).select(*keys, F.struct(F.lit(1).alias("by"), *figures).alias("found")))
    return either.groupBy(*keys).agg(F.min("found").alias("found")).select("doc_key", "doc_id", "item_id", *[F.col(f"found.{x}") for x in figures])


def decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The query: a row for each benchmark item found in a document."""
    return contaminated(docs, benchmark).drop("doc_key")


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, columns unchanged, in which no benchmark item is found."""
    found = checkpointed(contaminated(docs, benchmark).select(F.col("doc_key").alias(key := free_name("found_key", docs.columns))).distinct())
    if found.count() <= SMALL_WINDOWS:
        found = F.broadcast(found)
    return docs.join(found, document_key(docs) == F.col(key), "left_anti")
