"""R2 state function: order-independent window, emission counter."""
import datetime as dt

import numpy as np
import pandas as pd

from revlens.streaming.monitor_stream import window_function


class FakeState:
    def __init__(self):
        self.value = None

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, v):
        self.value = v


def batch(ids, model="m"):
    t0 = dt.datetime(2024, 1, 1)
    return pd.DataFrame({
        "id": ids, "ts": [t0 + dt.timedelta(seconds=int(i)) for i in ids], "model": model,
        "label": ["positive" if i % 3 else "negative" for i in ids],
        "confidence": [0.5 + (i % 50) / 100 for i in ids], "word_count": [i % 7 for i in ids],
        "latency_ms": [float(i % 13) for i in ids]})


def test_out_of_order_batches_keep_newest_window():
    fn = window_function(window=10)
    st = FakeState()
    outs = []
    for ids in ([20, 21, 22], list(range(0, 20)), [5, 6]):     # newest first, then older
        outs.extend(fn(("m",), iter([batch(ids)]), st))
    last = outs[-1].iloc[0]
    assert [o.iloc[0]["seq"] for o in outs] == [0, 1, 2]
    want = batch(list(range(13, 23)))
    assert last["predictions"] == 10
    assert np.isclose(last["mean_confidence"], want["confidence"].mean())
    assert last["newest_id"] == 22
    lat = np.sort(want["latency_ms"].to_numpy())
    assert last["p95_latency_ms"] == lat[min(int(10 * 0.95), 9)]


def test_nulls_in_the_log_are_left_out():
    fn = window_function(window=10)
    st = FakeState()
    b = batch([1, 2, 3, 4])
    b["id"] = [None, None, 3, 4]
    b["confidence"] = [None, 0.5, 0.9, 1.0]
    b["word_count"] = [None, None, 4, 6]
    b["latency_ms"] = [None, 1.0, 2.0, 3.0]
    out = list(fn(("m",), iter([b]), st))[-1].iloc[0]
    out = list(fn(("m",), iter([batch([9])]), st))[-1].iloc[0]
    assert out["predictions"] == 5 and np.isclose(out["mean_confidence"], (0.5 + 0.9 + 1.0 + 0.59) / 4)
    assert out["median_word_count"] == 4.0 and out["newest_id"] == 9
    none = batch([1])
    for c in ("id", "confidence", "word_count", "latency_ms"):
        none[c] = None
    out = list(window_function()(("m",), iter([none]), FakeState()))[-1].iloc[0]
    assert out["predictions"] == 1 and out["mean_confidence"] is None and out["p95_latency_ms"] is None


def test_task_cut_keeps_newest_per_model():
    import pyarrow as pa

    from revlens.streaming.monitor_stream import newest_per_task
    t = pa.table({"id": pa.array([None, 2**60 + 1, 2**60 + 3, 7], pa.int64()), "ts": pa.array([1, 5, 5, 9], pa.timestamp("us")),
                  "model": ["a", "a", "a", "b"]})
    out = pa.Table.from_batches(list(newest_per_task(2)(iter(t.to_batches(max_chunksize=1)))))
    assert sorted(zip(out["model"].to_pylist(), out["id"].to_pylist())) == [("a", 2**60 + 1), ("a", 2**60 + 3), ("b", 7)]


def test_log_without_ids_streams(spark):
    """A log whose writer keeps no id runs through the stream."""
    import uuid

    from revlens.session import scratch_path
    from revlens.sources import sinks
    from revlens.sources import tables as V
    from revlens.streaming import monitor_stream as MS
    from tests.conftest import SF001
    base = scratch_path(spark, f"test-noid-{uuid.uuid4().hex}")
    sinks.append_log(V.prediction_log(spark, SF001).drop("id"), f"{base}/log")
    got = MS.run_to_table(spark, f"{base}/log", f"{base}/out", f"{base}/ckpt")
    assert got.count() > 0 and got.where("mean_confidence is null").count() == 0


def test_scoring_stream_matches_batch_validation(spark):
    """R1 against its batch twin (P12): every request is either logged or
    quarantined, with the batch validator's verdict and reason."""
    import uuid

    from revlens.operators import monitor as MO
    from revlens.operators import serving as SV
    from revlens.plans import catalog as C
    from revlens.session import scratch_path
    from revlens.sources import ingest
    from revlens.sources import tables as V
    from revlens.streaming import scoring_stream as SS
    from tests.conftest import SF001

    store, tr = C.feature_store_of(spark, SF001, k=4, max_features=500)
    model = SV.serving_model(tr, C._lr_on_store(store, "served")[0])
    base = scratch_path(spark, f"test-scoring-{uuid.uuid4().hex}")
    reqs = V.requests(spark, SF001)
    SS.bodies(reqs).repartition(3).write.json(f"{base}/in")
    SS.start(spark, model, "m", f"{base}/in", f"{base}/log", f"{base}/quarantine",
             f"{base}/ckpt").awaitTermination()
    logged = {r["id"] for r in ingest.read_log(spark, f"{base}/log").select("id").collect()}
    quarantined = {r["request_id"]: r["reject_reason"]
                   for r in spark.read.parquet(f"{base}/quarantine").collect()}
    batch = {r["request_id"]: r["reject_reason"] for r in MO.validate_text(reqs).collect()}
    assert logged == {k for k, v in batch.items() if v is None}
    assert quarantined == {k: v for k, v in batch.items() if v is not None}
    light = {r["request_id"]: r["text_light_clean"] for r in MO.validate_text(reqs).where("accepted").collect()}
    assert {r["id"]: r["text_light_clean"] for r in ingest.read_log(spark, f"{base}/log").collect()} == light


def test_repeated_ids_go_to_quarantine_and_the_stream_goes_on(spark):
    """Repeats inside a micro-batch, in a later one and after a restart; rows without an id."""
    import uuid

    from revlens.plans import catalog as C
    from revlens.session import scratch_path
    from revlens.sources import ingest
    from revlens.streaming import scoring_stream as SS
    from tests.conftest import SF001

    model = C.fixed_model(spark, SF001)
    base = scratch_path(spark, f"test-repeat-{uuid.uuid4().hex}")

    def send(*rows):
        bodies = spark.createDataFrame([(i, '{"text": "%s"}' % t) for i, t in rows], "request_id long, body string")
        bodies.coalesce(1).write.mode("append").json(f"{base}/in")
        SS.start(spark, model, "m", f"{base}/in", f"{base}/log", f"{base}/quarantine", f"{base}/ckpt").awaitTermination()

    send((1, "one"), (2, "two"), (2, "two again"), (None, "nobody"))
    send((1, "one later"), (3, "three"), (None, "nobody"))
    send((3, "!!!"), (4, "four"))
    logged = [r["id"] for r in ingest.read_log(spark, f"{base}/log").collect()]
    assert sorted(logged) == [1, 2, 3, 4]
    bad = [(r["request_id"], r["reject_reason"]) for r in spark.read.parquet(f"{base}/quarantine").collect()]
    assert sorted(bad, key=repr) == sorted([(1, SS.MSG_REPEAT), (2, SS.MSG_REPEAT), (3, SS.MSG_REPEAT),
                                            (None, SS.MSG_NO_ID), (None, SS.MSG_NO_ID)], key=repr)


def test_repeat_state_expires():
    from revlens.streaming.scoring_stream import repeat_marker

    class State(FakeState):
        hasTimedOut = False
        timeout = None

        def remove(self):
            self.value = None

        def setTimeoutDuration(self, ms):
            self.timeout = ms

    rows = pd.DataFrame({"request_id": [7, 7], "body": ["a", "b"]})
    st = State()
    mark = repeat_marker(1000)
    assert [list(o["repeat"]) for o in mark((7,), iter([rows, rows]), st)] == [[False, True], [True, True]]
    assert st.value == (4,) and st.timeout == 1000
    st.hasTimedOut = True
    assert list(mark((7,), iter([]), st)) == [] and not st.exists


def test_monitor_goes_on_from_its_checkpoint(spark):
    """Stopped and started again, the stream ends where the batch twin over the whole log does."""
    import uuid

    from revlens.operators import monitor as MO
    from revlens.session import scratch_path
    from revlens.sources import sinks
    from revlens.sources import tables as V
    from revlens.streaming import monitor_stream as MS
    from tests.conftest import SF001
    base = scratch_path(spark, f"test-restart-{uuid.uuid4().hex}")
    log = V.prediction_log(spark, SF001)
    for part in range(3):
        sinks.append_log(log.where(f"id % 3 = {part}"), f"{base}/log")
        # the last start is a version whose state has a column more
        got = MS.run_to_table(spark, f"{base}/log", f"{base}/out", f"{base}/ckpt", added=("channel string",) * (part == 2))
        want = MO.signals(MO.last_n(log.where(f"id % 3 <= {part}")))
        cols = ["model", "predictions", "mean_confidence", "low_confidence_rate", "positive_share", "p95_latency_ms"]
        a, b = (sorted([tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in d.select(*cols).collect()])
                for d in (got, want))
        assert a == b and len(a) > 1
    seqs = spark.read.parquet(f"{base}/out").groupBy("model").max("seq").collect()
    assert all(r[1] == 2 for r in seqs)


def test_repeat_marker_copies_no_bodies():
    """One frame is built per id and micro-batch, over the columns as they came."""
    import numpy as np
    from revlens.streaming.scoring_stream import repeat_marker

    class State(FakeState):
        hasTimedOut = False

    rows = pd.DataFrame({"request_id": np.array([7, 7]), "body": np.array(["a", "b"], object)})
    got, = repeat_marker()((7,), iter([rows]), State())
    assert list(got.columns) == ["request_id", "body", "repeat"] and list(got["repeat"]) == [False, True]
    assert list(got["body"]) == ["a", "b"] and list(got["request_id"]) == [7, 7] and list(rows.columns) == ["request_id", "body"]
    assert np.shares_memory(got["body"].to_numpy(), rows["body"].to_numpy())
    assert np.shares_memory(got["request_id"].to_numpy(), rows["request_id"].to_numpy())
