"""The same keyed upserts over streams: people's decisions as they come, and result files as chunks finish."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from catalogue_evidence.operators.assemble import KEY, latest_by_key, text
from catalogue_evidence.operators.review import human_effects, upsert
from catalogue_evidence.streaming import versions


def stream_decisions(events: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Each key's effects so far, (immutableKey, last, approved, rejected), handed to sink as they change.

    events: a stream of (event_id, ts, immutableKey, decision). State is one row a key; after all events the last rows
    of the keys are those of the batch operator, whatever the order of arrival.
    """
    return (
        human_effects(events).withColumnRenamed("_e", "immutableKey").writeStream.outputMode("update").foreachBatch(sink)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def upsert_into(spark: SparkSession, folder: str, key: str = KEY, order: str | None = None, buckets: int = versions.BUCKETS, kept: int = versions.KEPT) -> Callable[[DataFrame, int], None]:
    """A sink that keeps the newest row of each key as a table of versions under folder, one for each batch.

    A batch writes only the buckets that it touches. One that runs again after its version stands changes nothing; one
    that failed before leaves the version before as it is. order: a column of arrival by which the last row of a key in
    a batch counts, left out of the table; without it a batch must have one row a key. Rows with a blank key drop out.
    """

    def sink(batch: DataFrame, number: int) -> None:
        new = batch
        if order is not None:  # of equal arrivals the last row of a file
            placed = batch.withColumn("_place", F.struct(order, F.monotonically_increasing_id()))
            new = latest_by_key(placed, "_place", key).drop("_place", order)
        versions.write_version(batch.sparkSession, folder, new.filter(text(key) != ""), number, lambda old, now: upsert(old, now, key), key, buckets, kept)

    return sink


def current(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame | None:
    """The newest rows of a table that upsert_into() keeps, as of before a batch if said; None if there are none yet."""
    return versions.snapshot(spark, folder, None if before is None else before - 1)


def stream_chunk_results(spark: SparkSession, path: str, schema: str, folder: str, checkpoint: str, files: int | None = None, kept: int = versions.KEPT) -> StreamingQuery:
    """Chunk results that arrive as Parquet files under path, upserted by key into the table under folder: the row of the
    newest file wins, and in one file the last row. files: as many make a batch at most."""
    arrival = F.struct("_metadata.file_modification_time", "_metadata.file_path")
    reader = spark.readStream.schema(schema)
    reader = reader if files is None else reader.option("maxFilesPerTrigger", files)
    chunks = reader.parquet(path).select("*", arrival.alias("_arrival"))
    return (
        chunks.writeStream.foreachBatch(upsert_into(spark, folder, order="_arrival", kept=kept)).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
