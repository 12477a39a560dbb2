"""File streams through the stateless operators: criteria filters and model scoring.

Both are row-wise, so a stream needs no watermark and no state; the query's own checkpoint makes
a restart continue after the last committed file.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from leadlens.dictionary import CONTACTS, FieldDictionary, FilterCriteria
from leadlens.operators.filters import apply_filter
from leadlens.operators.models import batch_scores
from leadlens.sources.shared import is_file


def file_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The Parquet files of a table: a folder of part files, to which more may come, or one file. A stream reads folders
    only, so a single file is picked out of its own by name."""
    folder, name = path.rstrip("/").rpartition("/")[::2] if is_file(spark, path) else (path, "*.parquet")
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def filtered_stream(stream: DataFrame, criteria: FilterCriteria) -> DataFrame:
    return apply_filter(stream, criteria)


def scored_stream(stream: DataFrame, model: PipelineModel, fd: FieldDictionary = CONTACTS) -> DataFrame:
    return batch_scores(model, stream, fd)


def drain(stream: DataFrame, output: str, checkpoint: str) -> None:
    """Processes everything available now into a Parquet folder and stops."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(output)
    )
    query.awaitTermination()
