"""The contact table derived from orders, customers and line items: one row per order."""

from __future__ import annotations

import hashlib
import inspect
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.functions.shapes import month_sql, weekday_sql
from leadlens.operators.history import HOT_ROWS, hot_keys, with_history
from leadlens.sources import kept
from leadlens.sources.shared import app_path, spread, written

SOURCES = ("orders", "customer", "lineitem")
#: Order keys that one day of a hot customer may span before it is cut.
KEYS_PER_PERIOD = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def build_contacts(orders: DataFrame, customer: DataFrame, lineitem: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The 22 contact columns. A customer's earlier orders play the earlier campaign, the lines of
    an order the calls, and the shipping lag the after-the-event column.

    Line items are reduced per order before the join. A hot customer's orders are cut by date and by ranges
    of the order key, so that neither the customer nor one of its days is a task.
    """
    orders = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority").where(
        F.col("o_custkey").isNotNull()
    )
    customer = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    history = with_history(
        orders, "o_custkey", F.struct("o_orderdate", F.floor(F.col("o_orderkey") / KEYS_PER_PERIOD)),
        ["o_orderdate", "o_orderkey", "o_orderstatus"], ["o_orderdate", "o_orderstatus"], hot_keys(orders, "o_custkey", hot_rows),
    )
    known = history.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    lines = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.max("l_shipdate").alias("last_ship")
    )
    j = known.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn(
        "ym", F.year("o_orderdate") * 12 + F.month("o_orderdate")
    )
    return j.selectExpr(*[f"{sql} AS `{name}`" for name, sql in _COLUMNS.items()])


_COLUMNS = {
    "id": "CAST(o_orderkey AS BIGINT)",
    "age": "CAST(18 + (o_custkey * 7 + c_nationkey) % 65 AS DOUBLE)",
    "job": "CASE WHEN o_orderkey % 41 = 0 THEN 'unknown' ELSE lower(c_mktsegment) END",
    "marital": "CASE c_nationkey % 3 WHEN 0 THEN 'single' WHEN 1 THEN 'married' ELSE 'divorced' END",
    "education": """CASE o_custkey % 8 WHEN 0 THEN 'unknown' WHEN 1 THEN 'illiterate' WHEN 2 THEN 'basic.4y'
        WHEN 3 THEN 'basic.6y' WHEN 4 THEN 'basic.9y' WHEN 5 THEN 'high.school'
        WHEN 6 THEN 'professional.course' ELSE 'university.degree' END""",
    "default": "CASE WHEN o_custkey % 9 < 2 THEN 'unknown' ELSE 'no' END",
    "housing": "CASE WHEN o_custkey % 25 = 0 THEN 'unknown' WHEN o_custkey % 2 = 0 THEN 'yes' ELSE 'no' END",
    "loan": "CASE WHEN o_custkey % 27 = 0 THEN 'unknown' WHEN o_custkey % 6 = 0 THEN 'yes' ELSE 'no' END",
    "contact": "CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM') THEN 'cellular' ELSE 'telephone' END",
    "month": month_sql("o_orderdate"),
    "day_of_week": weekday_sql("o_orderdate"),
    "duration": "CAST(datediff(last_ship, o_orderdate) AS DOUBLE)",
    "campaign": "CAST(coalesce(n_lines, 1) AS DOUBLE)",
    "pdays": "CAST(coalesce(datediff(o_orderdate, prev_o_orderdate), 999) AS DOUBLE)",
    "previous": "CAST(n_prev AS DOUBLE)",
    "poutcome": """CASE prev_o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failure' WHEN 'P' THEN 'failure'
        ELSE 'nonexistent' END""",
    "emp_var_rate": "CAST((ym * 7) % 45 AS DOUBLE) / 10 - 3",
    "cons_price_index": "CAST((ym * 11) % 25 AS DOUBLE) / 10 + 92",
    "cons_conf_index": "CAST((ym * 13) % 110 AS DOUBLE) / 10 - 46",
    "lending_rate3m": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST((ym * 17) % 37 AS DOUBLE) / 10 + 0.8D END",
    "nr_employed": "CAST(4950 + (ym * 19) % 281 AS DOUBLE)",
    "subscribe": """CASE WHEN o_orderkey % 4 = 0 THEN NULL
        WHEN o_orderstatus = 'F' AND (prev_o_orderstatus = 'F' OR coalesce(n_lines, 1) <= 2) THEN 'yes' ELSE 'no' END""",
}

_written: dict[tuple[str, str], DataFrame] = {}


def _fingerprint(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of the source files, from their listing only."""
    paths = [f"{folder}/{name}.parquet" for name in SOURCES]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    state = F.xxhash64("path", "length", "modificationTime")
    row = files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(state)).first()
    return hashlib.md5(repr((folder, tuple(row))).encode()).hexdigest()


def contacts(spark: SparkSession, folder: str) -> DataFrame:
    """The contact table of a folder, written once per application to the shared folder and read
    back, so that later queries prune columns and push filters into its scan."""
    return _written_once(spark, folder)[1]


def _written_once(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    state = _fingerprint(spark, folder)
    key = (spark.sparkContext.applicationId, state)
    if key not in _written:
        tables = [table(spark, folder, name) for name in SOURCES]
        df = spread(build_contacts(*tables), tables[0].count())
        _written[key] = written(df, f"contacts-{state}")
    return state, _written[key]


def kept_contacts(spark: SparkSession, folder: str) -> DataFrame:
    """The contact table of a folder as this or an earlier application published it, if sources and this module are the same; else it is
    made and published. Versions over a week old are removed, except the newest."""
    state = kept.fingerprint(spark, [f"{folder}/{name}.parquet" for name in SOURCES], inspect.getsource(sys.modules[__name__]))

    def build() -> DataFrame:
        kept.expire(spark, "contacts")
        tables = [table(spark, folder, name) for name in SOURCES]
        return spread(build_contacts(*tables), tables[0].count())

    return kept.kept(spark, "contacts", state, build)


def text_export(df: DataFrame) -> DataFrame:
    """The contact table as text, with cells a careless export would hold planted by id, and with
    its columns in another order."""
    planted = {
        "age": """CASE id % 40 WHEN 0 THEN 'NaN' WHEN 1 THEN concat(' ', CAST(CAST(age AS INT) AS STRING), ' ')
            WHEN 2 THEN '12d' WHEN 3 THEN 'x' WHEN 4 THEN '1e2' WHEN 5 THEN 'None' WHEN 6 THEN NULL
            ELSE CAST(age AS STRING) END""",
        "job": """CASE id % 50 WHEN 0 THEN 'NA' WHEN 1 THEN concat('  ', job, '\t') WHEN 2 THEN '   ' WHEN 3 THEN 'null'
            WHEN 4 THEN NULL WHEN 5 THEN '' ELSE job END""",
        "subscribe": "CASE WHEN id % 30 < 10 THEN concat(' ', upper(subscribe), ' ') ELSE subscribe END",
    }
    cells = [f"{planted.get(c, f'CAST(`{c}` AS STRING)')} AS `{c}`" for c in reversed(df.columns)]
    return df.selectExpr("'x' AS note", *cells)


def export_folder(spark: SparkSession, folder: str) -> str:
    """The folder that holds ``text_export`` of the contact table as ``train.csv``, written once per
    application."""
    state, df = _written_once(spark, folder)
    path = app_path(spark, f"export-{state}")
    if path not in _exported:
        spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        text_export(df).write.mode("overwrite").options(header=True, escape='"', **spaces).csv(f"{path}/train.csv")
        _exported.add(path)
    return path


_exported: set[str] = set()

BROKEN_COLUMNS = ["id", "age", "job", "subscribe"]


def broken_export(spark: SparkSession, folder: str) -> str:
    """Lines of four cells without a header; every 37th id has a cell too many and every 41st one too few."""
    state, df = _written_once(spark, folder)
    path = app_path(spark, f"broken-{state}")
    if path not in _exported:
        cells = "concat_ws(',', id, CAST(age AS STRING), job, coalesce(subscribe, ''))"
        lines = f"CASE WHEN id % 37 = 0 THEN concat({cells}, ',more') WHEN id % 41 = 0 THEN concat_ws(',', id, job) ELSE {cells} END AS value"
        df.selectExpr(lines).write.mode("overwrite").text(path)
        _exported.add(path)
    return path


def labelled(df: DataFrame) -> DataFrame:
    return df.where(F.col("subscribe").isNotNull())


def unlabelled(df: DataFrame) -> DataFrame:
    return df.where(F.col("subscribe").isNull()).drop("subscribe")
