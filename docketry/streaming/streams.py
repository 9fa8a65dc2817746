"""Structured Streaming: incremental documents, deduplication, windows and sessions over events."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.functions.text import clean, simhash
from docketry.runtime import shared_dir


def document_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 64) -> DataFrame:
    """JSON-lines files as they arrive, so many files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def clean_stream(docs: DataFrame, text: str = "raw_text") -> DataFrame:
    return docs.withColumn("raw_text", clean(F.col(text)))


def first_of_each(stream: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """Each key once within the watermark; older state is dropped."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def tumbling(events: DataFrame, time: str, size: str, late: str = "10 minutes", *by: str) -> DataFrame:
    per = events.withWatermark(time, late).groupBy(F.window(time, size), *by).agg(F.count("*").alias("events"), F.sum("value").alias("total"))
    return per.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "events", F.round("total", 4).alias("total"))


def sliding(events: DataFrame, time: str, size: str, step: str, late: str = "10 minutes") -> DataFrame:
    per = events.withWatermark(time, late).groupBy(F.window(time, size, step)).agg(F.count("*").alias("events"))
    return per.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "events")


def sessions(events: DataFrame, time: str, gap: str, key: str, late: str = "10 minutes") -> DataFrame:
    per = events.withWatermark(time, late).groupBy(F.session_window(time, gap), key).agg(F.count("*").alias("events"))
    return per.select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "events")


def recent_near_duplicates(stream: DataFrame, key: str, text: str, scope: str, remember: int = 10_000, radius: int = 3) -> DataFrame:
    """(scope, key, duplicate): is a row's fingerprint within radius bits of one of the last ``remember`` of its scope.

    State is a ring of fingerprints per scope, so it is bounded by its length.
    """

    def run(group: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        seen = np.array(state.get[0] if state.exists else [], np.int64).view(np.uint64)
        for b in batches:
            flags = []
            for h in b["h"].to_numpy(np.int64).view(np.uint64):
                near = bool((np.bitwise_count(seen ^ h) <= radius).any())
                flags.append(near)
                if not near:
                    seen = np.append(seen, h)[-remember:]
            yield pd.DataFrame({scope: group[0], key: b[key], "duplicate": flags})
        state.update((seen.view(np.int64).tolist(),))

    kinds = dict(stream.dtypes)
    rows = stream.select(scope, key, simhash(F.col(text)).alias("h"))
    return rows.groupBy(scope).applyInPandasWithState(run, f"{scope} {kinds[scope]}, {key} {kinds[key]}, duplicate boolean", "seen array<bigint>", "append", "NoTimeout")


def run_to_end(stream: DataFrame, mode: str = "append") -> DataFrame:
    """What a stream over files gives until nothing is left to read, as a table in the shared folder."""
    spark = stream.sparkSession
    path = f"{shared_dir(spark)}/docketry/{spark.sparkContext.applicationId}/ended-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={number}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out").select(*stream.columns)
