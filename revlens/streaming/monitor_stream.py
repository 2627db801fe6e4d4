"""R2 + R3 + R4 as a Structured Streaming job: per-model count window.

State per model is the newest ``WINDOW`` predictions ordered by (ts, id), held by
``transformWithState`` as a list state of rows (at most WINDOW per model) and a counter, in
the RocksDB state store; rows are Avro-encoded, so a later version may add columns
to a running monitor's state. Each micro-batch merges its rows into the state and emits the model's current
signals, stamped with a per-model emission counter (and the window's newest
(ts, id)), so downstream code can keep the latest row per model. Rows older than the window's oldest member are
dropped on arrival - the window is a fixed count, not event time.

The batch twin is ``operators.monitor.last_n`` + ``signals``; on the same rows
the final emitted signals equal it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from revlens.operators.monitor import LOW_CONFIDENCE, WINDOW

LOG_SCHEMA = ("id long, ts timestamp_ntz, model string, label string, confidence double, "
              "word_count int, latency_ms double")
STATE_SCHEMA = "ids long, ts long, label string, conf double, words int, latency double"
#: what the state operator needs of the session while its query runs
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.encodingFormat": "avro",
}
OUT_SCHEMA = ("model string, predictions long, mean_confidence double, low_confidence_rate double, "
              "positive_share double, median_word_count double, p95_latency_ms double, "
              "newest_ts long, newest_id long, seq long")


TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def log_stream(spark: SparkSession, log_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The prediction log (S9 JSON lines, ISO-8601 UTC timestamps) as a stream
    in the monitor's row shape; ts is the UTC wall-clock time. Without a limit a
    trigger takes all new files."""
    from revlens.sources.ingest import LOG_SCHEMA as SINK_SCHEMA
    reader = spark.readStream.schema(SINK_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.json(log_dir)
    ts = F.to_timestamp_ntz(F.substring("timestamp", 1, 26), F.lit(TS_FORMAT))
    return raw.select("id", ts.alias("ts"), "model", "label", "confidence", "word_count",
                      "latency_ms")


def newest_per_task(window: int = WINDOW):
    """Before the state's shuffle every task keeps the newest ``window`` rows per model
    of what it has read so far, so a busy model sends a bounded number of rows. Arrow
    tables throughout: 64-bit ids stay exact beside NULLs."""
    def cut(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        held = None
        for batch in batches:
            both = pa.Table.from_batches([batch])
            if held is not None:
                both = pa.concat_tables([held, both])
            order = pc.sort_indices(both, sort_keys=[("model", "ascending"), ("ts", "descending"),
                                                     ("id", "descending")])
            both = both.take(order)
            models = pc.fill_null(both.column("model"), "").to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.r_[True, models[1:] != models[:-1]]) if len(models) else np.zeros(0, int)
            place = np.arange(len(models)) - np.repeat(first, np.diff(np.r_[first, len(models)]))
            held = both.filter(pa.array(place < window))
        if held is not None:
            yield from held.combine_chunks().to_batches()
    return cut


def window_function(window: int = WINDOW, low: float = LOW_CONFIDENCE):
    """The per-model state function. Built as a closure so it ships to the
    Python workers by value (no package import needed there). NULL ids order first,
    NULL confidences, word counts and latencies are left out of their statistic."""
    cols = ["ids", "ts", "label", "conf", "words", "latency"]

    def signals_of(model, w, seq):
        n = len(w)
        lat = np.sort(w["latency"].dropna().to_numpy(dtype=np.float64))
        conf = w["conf"].dropna().to_numpy(dtype=np.float64)
        words = w["words"].dropna().to_numpy(dtype=np.float64)
        last = w.iloc[-1]
        return pd.DataFrame([{
            "model": model, "predictions": n,
            "mean_confidence": float(np.mean(conf)) if len(conf) else None,
            "low_confidence_rate": float((conf < low).sum()) / n,
            "positive_share": float((w["label"] == "positive").sum()) / n,
            "median_word_count": float(np.median(words)) if len(words) else None,
            "p95_latency_ms": float(lat[min(int(len(lat) * 0.95), len(lat) - 1)]) if len(lat) else None,
            "newest_ts": None if pd.isna(last["ts"]) else int(last["ts"]),
            "newest_id": None if pd.isna(last["ids"]) else int(last["ids"]),
            "seq": seq,
        }])

    def micros(column):
        stamps = column.astype("datetime64[us]")
        return stamps.astype("int64").astype("Int64").mask(stamps.isna().to_numpy())

    def newest(frame):
        return frame.sort_values(["ts", "ids"], kind="mergesort", na_position="first").tail(window) \
            .reset_index(drop=True)

    def update(key, batches, state):
        (model,) = key
        seq, held = 0, None
        types = {"ids": "Int64", "ts": "Int64", "label": object, "conf": "Float64", "words": "Int64",
                 "latency": "Float64"}
        if state.exists:
            s = state.get
            held = pd.DataFrame({c: pd.array(list(s[i]), dtype=types[c]) if types[c] is not object
                                 else pd.Series(list(s[i]), dtype=object) for i, c in enumerate(cols)})
            seq = int(s[len(cols)]) + 1
        for pdf in batches:      # only the window is held while a trigger is read
            new = pd.DataFrame({
                "ids": pdf["id"].astype("Int64").array, "ts": micros(pdf["ts"]).array,
                "label": pdf["label"].astype(object).array, "conf": pdf["confidence"].astype("Float64").array,
                "words": pdf["word_count"].astype("Int64").array,
                "latency": pdf["latency_ms"].astype("Float64").array})
            held = newest(new if held is None else pd.concat([held, new], ignore_index=True))

        def plain(v):
            return None if v is None or v is pd.NA or v != v else v.item() if hasattr(v, "item") else v

        state.update(tuple([plain(v) for v in held[c].tolist()] for c in cols) + (seq,))
        yield signals_of(model, held, seq)

    return update


def window_processor(window: int = WINDOW, low: float = LOW_CONFIDENCE, added: tuple[str, ...] = ()):
    """``window_function`` over a list state of rows and an emission counter. ``added`` names columns
    ("channel string") that a later version puts behind the state's own; rows written
    before hold NULL there. Made inside a function so that it ships to the Python workers by
    value, like the function it calls."""
    update, schema, own = window_function(window, low), ", ".join((STATE_SCHEMA, *added)), len(STATE_SCHEMA.split(","))

    class Held:
        """The two states as the function sees them: columns of the window, then the counter."""

        def __init__(self, rows, count):
            self.rows, self.count = rows, count

        @property
        def exists(self):
            return self.count.exists()

        @property
        def get(self):
            return (*list(zip(*self.rows.get()))[:own], self.count.get()[0])

        def update(self, value):
            *columns, seq = value
            self.rows.put([(*row, *(None,) * len(added)) for row in zip(*columns)])
            self.count.update((seq,))

    class WindowProcessor(StatefulProcessor):
        def init(self, handle):
            self.held = Held(handle.getListState("window", schema), handle.getValueState("emissions", "seq long"))

        def handleInputRows(self, key, rows, timerValues):
            yield from update(key, rows, self.held)

        def close(self):
            pass

    return WindowProcessor()


def monitor_query(log_stream: DataFrame, window: int = WINDOW, added: tuple[str, ...] = ()) -> DataFrame:
    """Streaming signals per model (append output; latest row per model wins)."""
    cut = log_stream.mapInArrow(newest_per_task(window), log_stream.schema)
    return cut.groupBy("model").transformWithStateInPandas(window_processor(window, added=added), OUT_SCHEMA, "append", "None")


def latest(signals: DataFrame) -> DataFrame:
    """Keep the last emitted row per model (highest emission counter; files may
    arrive out of time order, so the newest (ts, id) alone does not decide)."""
    stamps = ("seq", "newest_ts", "newest_id")
    cols = [c for c in signals.columns if c not in stamps]
    top = F.max(F.struct("seq", *cols))
    return (signals.groupBy("model").agg(top.alias("_t"))
            .select(*[F.col(f"_t.{c}").alias(c) for c in cols]))


def run_to_table(spark: SparkSession, log_dir: str, out_dir: str, ckpt_dir: str,
                 max_files_per_trigger: int | None = None, added: tuple[str, ...] = ()) -> DataFrame:
    """Run the monitor over every log file present now (availableNow trigger),
    write emitted signals to parquet, return the latest signals per model."""
    stream = log_stream(spark, log_dir, max_files_per_trigger)
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    try:
        for k, v in STATE_STORE.items():
            spark.conf.set(k, v)
        q = (monitor_query(stream, added=added).writeStream.format("parquet")
             .option("path", out_dir).option("checkpointLocation", ckpt_dir)
             .outputMode("append").trigger(availableNow=True).start())
    finally:
        for k, v in before.items():      # the query keeps what it started with
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    q.awaitTermination()
    return latest(spark.read.parquet(out_dir))
