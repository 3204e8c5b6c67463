"""The event analytics as Structured Streaming jobs.

Batch forms keep every late event; these drop what is older than the watermark, which is what bounds
their state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.operators import events as E
from tapeline.operators.scale import join_keys, neighbour


def only(events: DataFrame, event_type: str) -> DataFrame:
    """The events of one type; the checkpoint of the query is the saved cursor."""
    return events.where(F.lower("event_type") == event_type)


def first_records(records: DataFrame, keys: Sequence[str], time: str = "time", look_back: str = "7 days") -> DataFrame:
    """Each key once within the look-back; the state forgets keys older than that."""
    return records.withWatermark(time, look_back).dropDuplicatesWithinWatermark(list(keys))


def balance_windows(events: DataFrame, time: str = "time", size: str = "24 hours", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Round starts and ends, event count and last time per module and window."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    return (
        events.withWatermark(time, late)
        .groupBy(w.alias("w"), "module")
        .agg(
            F.count_if(F.lower("event_type") == "round_start").alias("starts"),
            F.count_if(F.lower("event_type") == "round_end").alias("ends"),
            F.count("*").alias("n_events"),
            F.max(time).alias("last_time"),
        )
        .select("w.start", "w.end", "module", "starts", "ends", "n_events", "last_time", (F.col("starts") > F.col("ends")).alias("end_missing"))
    )


def transition_batches(path: str, block: int = 100_000):
    """``foreachBatch`` body for rows (key, flag, ordinal): (key, ordinal) each time a key's flag turns from false to true, rows
    of a key taken in the order of their ordinal within a micro-batch. A NULL flag is false; of rows with one ordinal
    the false ones come first.

    The row before each is found in blocks of ordinals, with one carry row per block, so a key with a third of a
    batch is spread over its blocks and never held in one task. What is remembered is the set of keys whose last flag is
    true, a table per batch next to the rises; both are written per batch id, so a repeated batch replaces itself.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            flags = batch.select("key", F.coalesce("flag", F.lit(False)).alias("flag"), "ordinal")
            earlier = [i for i in batch_ids(spark, f"{path}/state") if i < batch_id]
            state = spark.read.schema(batch.select("key").schema).parquet(f"{path}/state/batch={max(earlier)}") if earlier else flags.select("key").limit(0)
            before = neighbour(flags, ["key"], ["ordinal", "flag"], ["flag"], F.floor(F.col("ordinal") / block), False, "was_")
            first = before.where("flag AND was_flag IS NULL").select("key", "ordinal")
            rises = before.where("flag AND NOT was_flag").select("key", "ordinal").unionByName(join_keys(first, state, ["key"], "left_anti"))
            rises.write.mode("overwrite").parquet(f"{path}/rises/batch={batch_id}")
            last = flags.groupBy("key").agg(F.max_by("flag", F.struct("ordinal", "flag")).alias("flag"))
            kept = join_keys(state, last, ["key"], "left_anti").unionByName(last.where("flag").select("key"))
            kept.write.mode("overwrite").parquet(f"{path}/state/batch={batch_id}")
        finally:
            batch.unpersist()

    return run


def found_transitions(spark, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rises").drop("batch")


def batch_ids(spark, path: str) -> list[int]:
    """The batches that have a folder under ``path``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        return []
    return [int(f.getPath().getName().removeprefix("batch=")) for f in store.listStatus(place) if f.getPath().getName().startswith("batch=")]


def correct_batch(findings_path: str):
    """``foreachBatch`` body: keep the findings of all batches and drop those a tombstone exempts, even
    one that arrives later. Both sides are written per batch id, so a repeated batch replaces itself."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            E.schema_findings(batch).write.mode("overwrite").parquet(f"{findings_path}/findings/batch={batch_id}")
            E.tombstones(batch).write.mode("overwrite").parquet(f"{findings_path}/exempt/batch={batch_id}")
        finally:
            batch.unpersist()

    return run


def corrected_findings(spark, findings_path: str) -> DataFrame:
    found = spark.read.parquet(f"{findings_path}/findings").drop("batch")
    exempt = spark.read.parquet(f"{findings_path}/exempt").select("ordinal").distinct()
    return found.join(exempt, "ordinal", "left_anti")


def run_once(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append", timeout: int = 600) -> None:
    """Process what is there and stop; a second call continues from the checkpoint."""
    q = (
        stream.writeStream.outputMode(mode).format("parquet").option("path", sink)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    _finish(q, timeout)


def run_batches(stream: DataFrame, body, checkpoint: str, timeout: int = 600) -> None:
    q = stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    _finish(q, timeout)


def _finish(q, timeout: int) -> None:
    if not q.awaitTermination(timeout):
        q.stop()
        raise TimeoutError("stream did not finish")
    if q.exception() is not None:
        raise q.exception()
