from conftest import SMALL

from leadlens.dictionary import CONTACTS, Config, FilterCriteria
from leadlens.operators import encode, filters, models
from leadlens.plans import catalog
from leadlens.streaming import files


def test_stream_and_batch_agree(spark, leaning, tmp_path):
    source = str(tmp_path / "in")
    raw = leaning.drop("subscribe")
    raw.repartition(3).write.parquet(source)
    criteria = FilterCriteria(categorical={"contact": ["cellular"]}, numeric={"age": (30, 50)})
    model = models.fit(
        "logistic_regression", leaning, encode.label_counts(leaning, CONTACTS), config=Config(logistic_iterations=10)
    )
    stream = files.filtered_stream(files.file_stream(spark, source, raw.schema), criteria)
    files.drain(files.scored_stream(stream, model), str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out"))
    want = models.batch_scores(model, filters.apply_filter(raw, criteria))
    assert sorted(got.collect()) == sorted(want.collect())
    # new files only: a second run adds exactly the new rows
    raw.limit(10).write.mode("append").parquet(source)
    files.drain(files.scored_stream(files.file_stream(spark, source, raw.schema), model), str(tmp_path / "out2"), str(tmp_path / "state2"))
    assert spark.read.parquet(str(tmp_path / "out2")).count() == 730


def test_a_table_is_streamed_as_a_file_or_a_folder(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    by_file = catalog.QUERIES["stream_filtered_events"](spark, SMALL)
    by_folder = catalog.QUERIES["stream_filtered_events"](spark, str(tmp_path))
    rows = sorted(map(str, by_file.collect()))
    assert rows and rows == sorted(map(str, by_folder.collect()))
