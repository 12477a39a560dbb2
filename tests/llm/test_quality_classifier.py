"""The discriminant against numpy, its held-out accuracy, and awkward rows."""

import numpy as np
import pytest
from conftest import SMALL

from leadlens.llm import quality_classifier as qc

from .samples import AWKWARD, frame, prose

LABELS = "doc_id long, quality int, toxic int"


def test_scores_match_numpy(spark):
    rng = np.random.default_rng(0)
    d = len(qc.NAMES)
    x = [rng.normal(0, 1, (80, d)), rng.normal(1, 2, (120, d))]
    rows = [(v.tolist(), 1 - k, k) for k in (0, 1) for v in x[k]]
    model = qc.fit(spark.createDataFrame(rows, "x array<float>, n0 long, n1 long"), to_pooled=0.3, to_identity=0.05)
    covariances = [np.cov(np.float32(v).T.astype(float), bias=True) for v in x]
    pooled = (80 * covariances[0] + 120 * covariances[1]) / 200
    logs = []
    for k in (0, 1):
        s = 0.7 * covariances[k] + 0.3 * pooled
        s = 0.95 * s + 0.05 * np.trace(s) / d * np.eye(d)
        z = x[1][:20] - np.float32(x[k]).mean(axis=0)
        logs.append(np.log((80, 120)[k] / 200) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(s), z))
    assert model.score(x[1][:20]) == pytest.approx(1 / (1 + np.exp(logs[0] - logs[1])), abs=1e-5)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    rows = qc.quality_classifier(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 10 and sum(r["predicted"] == r["quality"] for r in rows) >= 0.9 * len(rows)


def test_awkward_rows(spark, awkward, nothing):
    source = AWKWARD + [(100 + i, prose(i, 50) if i % 2 else "| " * i, "en") for i in range(60)]
    labels = spark.createDataFrame([(100 + i, i % 2, 0) for i in range(60)] + [(1, 0, 0), (1, 1, None), (None, 1, 0), (2, None, 0)], LABELS)
    rows = qc.quality_classifier(frame(spark, source), labels).collect()
    assert len(rows) == len(source) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in qc.quality_classifier(awkward, none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1, 0) for i in range(1, 12)], LABELS)
    assert {r["score"] for r in qc.quality_classifier(awkward, one).collect()} == {1.0}
    assert qc.quality_classifier(nothing, labels).count() == 0
