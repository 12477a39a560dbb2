"""Tables kept across applications: read again, rebuilt for another state, never read half-written, removed when old."""

import os
import subprocess
import sys

import pytest
from conftest import ROOT

from leadlens.dictionary import DatasetError
from leadlens.sources import kept


def never():
    raise AssertionError("the table is made anew")


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture()
def df(spark):
    return spark.createDataFrame([(i, f"n{i}", None if i % 3 else i / 2) for i in range(20)], "id long NOT NULL, `a name` string, score double")


def test_a_published_table_is_read_again(spark, df, tmp_path):
    first = kept.kept(spark, "t", "s1", lambda: df, str(tmp_path))
    again = kept.kept(spark, "t", "s1", never, str(tmp_path))
    assert rows(first) == rows(again) == rows(df) and again.columns == df.columns
    other = kept.kept(spark, "t", "s2", lambda: df.limit(3), str(tmp_path))
    assert other.count() == 3 and kept.kept(spark, "t", "s1", never, str(tmp_path)).count() == 20
    with pytest.raises(DatasetError, match="not a name"):
        kept.kept(spark, "../t", "s1", never, str(tmp_path))


def test_another_application_reads_it(spark, df, tmp_path):
    kept.publish(df, "t", "s1", str(tmp_path))
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
from leadlens.sources import kept
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", kept.kept(spark, "t", "s1", lambda: 1 / 0, {str(tmp_path)!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_"))}
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, env=env, cwd=tmp_path)
    assert "rows 20" in done.stdout, done.stderr[-2000:]


def test_half_written_and_damaged_versions_are_ignored(spark, df, tmp_path, monkeypatch):
    notes = kept._note

    def stops(spark, path, row):
        if "/manifest/" in path:
            raise KeyboardInterrupt
        notes(spark, path, row)

    monkeypatch.setattr(kept, "_note", stops)
    with pytest.raises(KeyboardInterrupt):
        kept.publish(df, "t", "s1", str(tmp_path))
    monkeypatch.undo()
    assert [(r["published"], r["whole"]) for r in kept.versions(spark, "t", str(tmp_path)).collect()] == [(False, False)]
    assert kept.kept(spark, "t", "s1", lambda: df, str(tmp_path)).count() == 20
    version = next(r["version"] for r in kept.versions(spark, "t", str(tmp_path)).collect() if r["published"])
    data = tmp_path / "kept" / "t" / "data" / version
    next(data.glob("part-*.parquet")).write_bytes(b"")
    assert kept.kept(spark, "t", "s1", lambda: df.limit(5), str(tmp_path)).count() == 5


def test_expiry_keeps_the_newest_and_what_is_young(spark, df, tmp_path):
    for state in ("s1", "s2", "s3"):
        kept.publish(df, "t", state, str(tmp_path))
    assert kept.expire(spark, "t", 3600, str(tmp_path)) == []
    removed = kept.expire(spark, "t", -1, str(tmp_path))
    left = kept.versions(spark, "t", str(tmp_path)).collect()
    assert len(removed) == 2 and [(r["state"], r["whole"]) for r in left] == [("s3", True)]
    assert [p.name for p in (tmp_path / "kept" / "t" / "data").iterdir()] == [left[0]["version"]]
    assert kept.expire(spark, "none", 0, str(tmp_path)) == [] and kept.versions(spark, "none", str(tmp_path)).count() == 0


def test_the_state_follows_files_and_recipe(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "a"))
    state = kept.fingerprint(spark, [str(tmp_path / "a")], "recipe")
    assert state == kept.fingerprint(spark, [str(tmp_path / "a")], "recipe") != kept.fingerprint(spark, [str(tmp_path / "a")], "another")
    df.write.mode("append").parquet(str(tmp_path / "a"))
    assert state != kept.fingerprint(spark, [str(tmp_path / "a")], "recipe")
