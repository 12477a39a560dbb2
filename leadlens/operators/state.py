"""Profiles that can be stored and merged: sums from which rates, shares, statistics and correlations are read.

A state is a table of rows (kind, column, key, n, n_lab, n_pos, s1, s2, lo, hi), as large as the levels of the categories: ``rows``
(the table), ``level`` (a level of a category), ``number`` (present values, their sum, squares, least and greatest), ``missing`` (the others), ``pair`` (rows where
two numbers are present, the sum of their products and their own sums), ``bucket`` (numbers on a fixed grid, whose place does not depend on
the data). States of parts that share no row add up to the state of the whole, so a new day's rows are profiled alone and merged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.dictionary import FieldDictionary
from leadlens.functions.shapes import text

SCHEMA = "kind string, column string, key string, n long, n_lab long, n_pos long, s1 double, s2 double, lo double, hi double"
_KEYS = ["kind", "column", "key"]
_SUMS, _REST = ["n", "n_lab", "n_pos", "s1", "s2"], {"lo": F.min, "hi": F.max}
_COUNTS = ("count(1) AS n", "sum(lab) AS n_lab", "sum(pos) AS n_pos")
#: Numbers that are summed together, by which of them are present.
TOGETHER = 10


def profile_state(df: DataFrame, fd: FieldDictionary, grid: Mapping[str, float] | None = None) -> DataFrame:
    """The state of ``df``. ``grid`` gives the bucket width of the numbers that are put on a grid. Numbers, levels and buckets are an
    aggregate each, so that a reading scans no more than the columns of its kinds."""
    labelled = fd.target in df.columns
    lab = f"CAST(`{fd.target}` IS NOT NULL AS INT)" if labelled else "0"
    pos = f"CAST(coalesce(`{fd.target}` = {text(fd.positive)}, false) AS INT)" if labelled else "0"
    numbers = [c for c in fd.numerics if c in df.columns]
    categories = [c for c in fd.categoricals if c in df.columns]
    states = [_numbers_state(df, numbers, lab, pos)]
    if categories:
        keys = ", ".join(f"named_struct('column', {text(c)}, 'key', CAST(`{c}` AS STRING))" for c in categories)
        rows = df.selectExpr(f"{lab} AS lab", f"{pos} AS pos", f"inline(array({keys}))").where("key IS NOT NULL")
        counts = rows.groupBy("column", "key").agg(*map(F.expr, _COUNTS))
        states.append(counts.selectExpr("'level' AS kind", "column", "key", "n", "n_lab", "n_pos", "0D AS s1", "0D AS s2", "CAST(NULL AS DOUBLE) AS lo", "CAST(NULL AS DOUBLE) AS hi"))
    if grid:
        cells = [(text(c), f"CAST(`{c}` AS DOUBLE)", f"double('{float(w)!r}')") for c, w in grid.items()]
        keys = ", ".join(f"named_struct('column', {c}, 'key', CAST(CAST(floor({x} / {w}) AS BIGINT) AS STRING), 'x', {x})" for c, x, w in cells)
        rows = df.selectExpr(f"{lab} AS lab", f"{pos} AS pos", f"inline(array({keys}))").where("x IS NOT NULL")
        counts = rows.groupBy("column", "key").agg(*map(F.expr, [*_COUNTS, "min(x) AS lo", "max(x) AS hi"]))
        states.append(counts.selectExpr("'bucket' AS kind", "column", "key", "n", "n_lab", "n_pos", "0D AS s1", "0D AS s2", "lo", "hi"))
    return reduce(DataFrame.unionByName, states)


def _numbers_state(df: DataFrame, numbers: Sequence[str], lab: str, pos: str) -> DataFrame:
    """The rows, numbers, missing values and pairs of a state. Rows are summed by which of the numbers are present, at most
    2 ** ``TOGETHER`` ways; the sums of a pair are those of the ways that have both."""
    if len(numbers) <= TOGETHER:
        groups = [list(numbers)]
    else:  # two half groups at a time, so that every pair stands in a group
        half = [list(numbers[i : i + TOGETHER // 2]) for i in range(0, len(numbers), TOGETHER // 2)]
        groups = [a + b for a, b in combinations(half, 2)]
    width = max(map(len, groups))

    def fields(k: int, group: Sequence[str]) -> str:
        values = [f"CAST(`{c}` AS DOUBLE)" for c in group] + ["CAST(NULL AS DOUBLE)"] * (width - len(group))
        return ", ".join([f"'part', {k}", *[f"'x{i}', {v}" for i, v in enumerate(values)]])

    if len(groups) == 1:
        rows = df.selectExpr(f"{lab} AS lab", f"{pos} AS pos", "0 AS part", *[f"CAST(`{c}` AS DOUBLE) AS x{i}" for i, c in enumerate(numbers)])
    else:
        rows = df.selectExpr(f"{lab} AS lab", f"{pos} AS pos", f"inline(array({', '.join(f'named_struct({fields(k, g)})' for k, g in enumerate(groups))}))")
    present = " + ".join(["0", *[f"IF(x{i} IS NULL, 0, {1 << i})" for i in range(width)]])
    rows = rows.withColumn("present", F.expr(present))
    sums = [f"{f}(x{i}) AS {name}{i}" for i in range(width) for f, name in (("sum", "s"), ("min", "lo"), ("max", "hi"))]
    sums += [f"sum(x{i} * x{j}) AS p{i}_{j}" for i in range(width) for j in range(i, width)]
    found = rows.groupBy("part", "present").agg(*map(F.expr, [*_COUNTS, *sums]))

    def part(kind: str, column: str, key: str, keep: str, s1: str = "0D", s2: str = "0D", lo: str = "CAST(NULL AS DOUBLE)", hi: str = "CAST(NULL AS DOUBLE)") -> str:
        named = f"'kind', {text(kind)}, 'column', {text(column)}, 'key', {text(key)}, 'n', n, 'n_lab', n_lab, 'n_pos', n_pos, 's1', {s1}, 's2', {s2}, 'lo', {lo}, 'hi', {hi}"
        return f"CASE WHEN {keep} THEN named_struct({named}) END"

    each, seen = [part("rows", "", "", "part = 0")], set()
    for k, group in enumerate(groups):
        for i, a in enumerate(group):
            if a not in seen:
                seen.add(a)
                each += [part("number", a, "", f"part = {k} AND present & {1 << i} > 0", f"s{i}", f"p{i}_{i}", f"lo{i}", f"hi{i}")]
                each += [part("missing", a, "", f"part = {k} AND present & {1 << i} = 0")]
        for (i, a), (j, b) in combinations(enumerate(group), 2):
            if (a, b) not in seen:
                seen.add((a, b))
                both = f"part = {k} AND present & {1 << i | 1 << j} = {1 << i | 1 << j}"
                each += [part("pair", a, b, both, f"s{i}", f"p{i}_{j}"), part("pair_of", b, a, both, f"s{j}", f"p{j}_{j}"), part("pair_as", a, b, both, s2=f"p{i}_{i}")]
    rows = found.selectExpr(f"inline(filter(array({', '.join(each)}), e -> e IS NOT NULL))")
    return _added(rows.where("kind <> 'level'"))  # true of all; stated, so that a reading of levels leaves this part out


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_KEYS).agg(*[F.sum(c).alias(c) for c in _SUMS], *[f(c).alias(c) for c, f in _REST.items()])


def merged(states: Sequence[DataFrame]) -> DataFrame:
    """The state of all rows of tables that share none."""
    return _added(reduce(DataFrame.unionByName, states))


def rates(state: DataFrame) -> DataFrame:
    """(column, value, n, n_pos, rate) of every level, over labelled rows."""
    of = state.where("kind = 'level'")
    return of.selectExpr("column", "key AS value", "n_lab AS n", "n_pos", "try_divide(CAST(n_pos AS DOUBLE), CAST(n_lab AS DOUBLE)) AS rate")


def statistics(state: DataFrame) -> DataFrame:
    """(column, n, n_missing, mean, deviation, lo, hi) of every number; deviations are those of the population."""
    of = state.where("kind IN ('number', 'missing')").groupBy("column").agg(
        *[F.expr(f"max({c}) FILTER (WHERE kind = 'number') AS {c}") for c in ("n", "s1", "s2", "lo", "hi")],
        F.expr("max(n) FILTER (WHERE kind = 'missing') AS gaps"),
    ).where("n IS NOT NULL")
    return of.selectExpr("column", "n", "coalesce(gaps, 0L) AS n_missing", "s1 / n AS mean", "sqrt(greatest(s2 / n - (s1 / n) * (s1 / n), 0D)) AS deviation", "lo", "hi")


def correlations(state: DataFrame) -> DataFrame:
    """(column, other, n, r) of every pair of numbers, over the rows that have both; NULL where one of them does not vary."""
    turned = "IF(kind = 'pair_of', key, column) AS column", "IF(kind = 'pair_of', column, key) AS other"
    sums = [("n", "pair", "n"), ("s1", "pair", "sa"), ("s2", "pair", "sab"), ("s1", "pair_of", "sb"), ("s2", "pair_of", "sbb"), ("s2", "pair_as", "saa")]
    pairs = state.where("kind IN ('pair', 'pair_of', 'pair_as')").selectExpr("kind", *turned, "n", "s1", "s2")
    joined = pairs.groupBy("column", "other").agg(*[F.expr(f"max({c}) FILTER (WHERE kind = '{kind}') AS {name}") for c, kind, name in sums])
    va, vb = "(n * saa - sa * sa)", "(n * sbb - sb * sb)"
    varies = f"{va} > 1e-12 * n * saa AND {vb} > 1e-12 * n * sbb"
    return joined.selectExpr("column", "other", "n", f"CASE WHEN {varies} THEN (n * sab - sa * sb) / sqrt({va} * {vb}) END AS r")


def histogram(state: DataFrame, column: str, width: float) -> DataFrame:
    """(lo, hi, n, n_pos) of the grid cells [lo, hi) that hold a value."""
    of = state.where((F.col("kind") == "bucket") & (F.col("column") == column))
    return of.selectExpr(f"CAST(key AS DOUBLE) * double('{float(width)!r}') AS lo", f"(CAST(key AS DOUBLE) + 1D) * double('{float(width)!r}') AS hi", "n", "n_pos")
