"""Session and small tables shared by the tests."""

from __future__ import annotations

import contextlib
import io
import os
import sys

import numpy as np
import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from leadlens.dictionary import CONTACTS  # noqa: E402

SMALL = "/root/testdata/sf0.001"

# Nine contacts, four of them won; the tests state what follows from them by hand.
FEW_COLUMNS = (
    "id age job marital education default housing loan contact month day_of_week duration campaign pdays previous poutcome "
    "emp_var_rate cons_price_index cons_conf_index lending_rate3m nr_employed subscribe"
).split()
FEW_ROWS = """
11 33 entrepreneur married high.school no no no telephone nov fri 75 3 999 0 nonexistent 0.4 93.4 -41.5 3.1 5090 no
12 51 housemaid divorced basic.6y unknown yes no cellular apr tue 410 1 12 2 success -1.3 92.8 -47.0 1.6 4985 yes
13 19 student single unknown no yes yes cellular sep wed 260 2 999 0 nonexistent -0.8 94.4 -38.5 0.9 4995 yes
14 67 retired married basic.4y no no no telephone jun mon 95 9 40 1 failure 1.2 93.8 -36.0 4.4 5190 no
15 44 admin. single university.degree no unknown unknown cellular jul thu 130 1 999 0 nonexistent 1.3 93.9 -42.7 4.6 5225 no
16 58 unknown married professional.course no yes no cellular mar fri 720 2 6 4 success -1.9 92.6 -50.0 1.2 5070 yes
17 29 services single high.school unknown no yes telephone may mon 60 7 999 0 nonexistent 1.0 93.6 -37.2 4.1 5200 no
18 36 technician divorced university.degree no yes no cellular aug tue 205 4 999 0 nonexistent 1.4 93.3 -36.3 4.9 5230 no
19 40 management married university.degree no no no cellular oct thu 380 1 90 1 failure -0.3 92.3 -33.5 0.7 5000 yes
"""
FEW = {
    c: [int(v) if c == "id" else float(v) if c in CONTACTS.numerics else v for v in values]
    for c, values in zip(FEW_COLUMNS, zip(*(line.split() for line in FEW_ROWS.split("\n") if line)))
}


def contact_schema(columns) -> str:
    kinds = {"id": "long"} | {c: "double" for c in CONTACTS.numerics}
    return ", ".join(f"`{c}` {kinds.get(c, 'string')}" for c in columns)


def contact_frame(spark, table: dict):
    rows = [tuple(float(v) if c in CONTACTS.numerics else v for c, v in zip(table, row)) for row in zip(*table.values())]
    return spark.createDataFrame(rows, contact_schema(table))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("leadlens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(shared))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def few(spark):
    return contact_frame(spark, FEW).persist()


@pytest.fixture(scope="session")
def leaning(spark):
    """720 labelled contacts whose chance of a sale follows the lending rate, the channel and an earlier sale."""
    rng = np.random.default_rng(11)
    n = 720
    rate = rng.uniform(0.5, 5.0, n).round(2)
    channel = rng.choice(["cellular", "telephone"], n, p=[0.6, 0.4])
    earlier = rng.choice(["nonexistent", "failure", "success"], n, p=[0.7, 0.2, 0.1])
    leaning = 0.4 - 0.8 * rate + 0.9 * (channel == "cellular") + 2.5 * (earlier == "success")
    known = {
        "id": np.arange(5000, 5000 + n), "lending_rate3m": rate, "contact": channel, "poutcome": earlier,
        "subscribe": np.where(rng.random(n) < 1 / (1 + np.exp(-leaning)), "yes", "no"),
        "age": rng.integers(18, 80, n), "duration": rng.gamma(2.0, 120.0, n).round(), "campaign": rng.poisson(1.5, n) + 1,
        "pdays": np.where(earlier == "nonexistent", 999, rng.integers(1, 60, n)), "previous": (earlier != "nonexistent") * rng.integers(1, 4, n),
        "nr_employed": 4900 + 70 * rate.round(),
    }
    texts = {
        "job": "admin. management retired services student technician unknown", "marital": "divorced married single",
        "education": "basic.4y basic.9y high.school university.degree", "default": "no no no unknown", "housing": "no yes", "loan": "no no yes",
        "month": " ".join(CONTACTS.orders["month"][2:]), "day_of_week": " ".join(CONTACTS.orders["day_of_week"]),
    }
    numbers = {"emp_var_rate": (-3.0, 1.5), "cons_price_index": (92.0, 95.0), "cons_conf_index": (-51.0, -27.0)}
    table = known | {c: rng.choice(v.split(), n) for c, v in texts.items()} | {c: rng.uniform(*v, n).round(1) for c, v in numbers.items()}
    return contact_frame(spark, {c: table[c].tolist() for c in CONTACTS.columns}).persist()


def plan_of(df) -> str:
    """The formatted physical plan."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
