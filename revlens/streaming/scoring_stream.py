"""R1 + S9: the prediction endpoint as a Structured Streaming job.

JSON request bodies arrive as files. Request ids are remembered in the stream's state:
the first row of an id goes on, its repeats (in the same or a later micro-batch) are
marked. Every micro-batch is validated (P12), accepted rows are scored by the saved
serving artifact (M12) and appended to the prediction log; rejected rows, repeats and rows
without an id go to a quarantine table with their reason.
State and offsets are committed together, and writes are keyed by the micro-batch id (overwrite of that batch's folder), so
a retried batch replaces its own output instead of duplicating it.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators import monitor as MO
from revlens.operators import serving as SV
from revlens.sources import sinks

BODY_SCHEMA = "request_id long, body string"


MSG_REPEAT = "request_id was sent before"
MSG_NO_ID = "request_id is missing"


def repeat_marker(keep_ms: int | None = None):
    """State function of one request id: every row after its first is a repeat. An id is forgotten
    ``keep_ms`` after its last row (never, by default)."""
    import pandas as pd

    def mark(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        seen = state.get[0] if state.exists else 0
        for rows in frames:
            repeat = [key[0] is not None and seen + i > 0 for i in range(len(rows))]
            seen += len(rows)
            # one frame per id: built once, its columns not copied
            yield pd.DataFrame({"request_id": rows["request_id"].array, "body": rows["body"].array, "repeat": repeat}, copy=False)
        state.update((seen,))
        if keep_ms:
            state.setTimeoutDuration(keep_ms)

    return mark


def mark_repeats(requests: DataFrame, keep_ms: int | None = None) -> DataFrame:
    """The stream of requests plus ``repeat``, by state over all micro-batches."""
    from pyspark.sql.streaming.state import GroupStateTimeout
    timeout = GroupStateTimeout.ProcessingTimeTimeout if keep_ms else GroupStateTimeout.NoTimeout
    return requests.groupBy("request_id").applyInPandasWithState(
        repeat_marker(keep_ms), f"{BODY_SCHEMA}, repeat boolean", "seen long", "append", timeout)


def score_batch(model, model_name: str, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One micro-batch (with ``repeat``): (log rows of accepted requests, quarantined rows).
    Log rows carry the processing time in UTC (F15) and the cleaned text."""
    checked = MO.validate_bodies(batch)
    first = F.when(F.col("request_id").isNull(), MSG_NO_ID).when(F.col("repeat"), MSG_REPEAT)
    checked = checked.withColumn("reject_reason", F.coalesce(first, "reject_reason"))
    accepted = checked.filter(F.col("reject_reason").isNull())
    served = SV.serve(model, accepted.select("request_id", "text"))
    log = (served.join(accepted.select("request_id", "word_count"), "request_id")
           .select("request_id", F.current_timestamp().alias("ts"), F.lit(model_name).alias("model"),
                   "text", "text_light_clean", "label", "confidence", "word_count"))
    rejected = checked.filter(F.col("reject_reason").isNotNull()).select(
        "request_id", "body", "reject_reason", F.current_timestamp().alias("ts"))
    return log, rejected


def start(spark: SparkSession, model, model_name: str, in_dir: str, log_dir: str,
          quarantine_dir: str, ckpt_dir: str, available_now: bool = True,
          max_files_per_trigger: int | None = None, keep_ms: int | None = None):
    """Start the scoring stream with a serving artifact; returns the StreamingQuery. Without a
    limit a trigger takes all new files."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            t0 = time.perf_counter()
            log, rejected = score_batch(model, model_name, batch)
            log = log.persist()
            n = log.count()
            # latency: the micro-batch's scoring time shared by its accepted rows
            per_row = round((time.perf_counter() - t0) * 1000.0 / max(n, 1), 1)
            out = log.select(F.col("request_id").alias("id"), "ts", "model", "text", "text_light_clean", "label",
                             "confidence", "word_count", F.lit(per_row).alias("latency_ms"))
            sinks.append_log(out, f"{log_dir}/batch={batch_id}", mode="overwrite")      # S9
            rejected.write.mode("overwrite").parquet(f"{quarantine_dir}/batch={batch_id}")
            log.unpersist()
        finally:
            batch.unpersist()
            SV.release(model)

    reader = spark.readStream.schema(BODY_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    marked = mark_repeats(reader.json(in_dir), keep_ms)
    w = marked.writeStream.foreachBatch(handle).option("checkpointLocation", ckpt_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()


def bodies(requests: DataFrame) -> DataFrame:
    """Request rows as JSON bodies; a NULL text is sent as {"text": null}."""
    body = F.to_json(F.struct(F.col("text").alias("text")), {"ignoreNullFields": "false"})
    return requests.select("request_id", body.alias("body"))
