"""Mixing sources to target weights by entropy balancing.

Every source gets a token target; document rates stay as close to 1 as the targets
allow (relative entropy), which makes them an exponential tilt of the document size,
rate = min(2, exp(lambda * size / scale)), one multiplier per source. The multipliers
solve the convex dual: Newton steps on the token residual, kept inside a bracket and
halved where Newton leaves it. Rates are then rounded into 0, 1 or 2 whole copies.

Work runs on the (source, size) histogram: it carries everything the dual needs, is
combined on the map side and has at most one row per different size of a source, so
a hot source is a small group. Each step is a distributed aggregation; the driver
sees single numbers only. Copies are rounded class by class from large to small
documents with the remainder carried on, so a source misses its target by about half
of its smallest document; which documents of a class get the extra copy is decided by
id hash, counted in hash buckets so that no class is ranked in one task.

Defined cases: null or empty texts have size 0 and are never taken; a null source is
a source of its own (last); equal rows get equal treatment up to the id hash; an
empty table gives an empty mix.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.common import SPACES, packed, small_side, words
from revlens.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5      # of all words, the size of the mix
MOST = 2         # copies of a document, and targets over a source's own words
BUCKETS = 256
TOLERANCE = 1e-9
STEPS = 120


class NotConverged(RuntimeError):
    """The dual was not solved within STEPS rounds."""


def word_count(text: Column) -> Column:
    return F.size(words(text, SPACES)).cast("long")


def histogram(sized: DataFrame) -> DataFrame:
    """(source, size, n) of all documents with words."""
    return materialize(sized.where("size > 0").groupBy("source", "size")
                       .agg(F.count(F.lit(1)).alias("n")), "size-histogram")


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, weight, target). Sources in code point order take the
    weights in turn; capped sources hand their excess to the others by weight."""
    totals = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = _numbered(totals)
    rows = materialize(ranked.select(
        "source", "source_size", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                              (F.col("rank") % len(weights) + 1).cast("int")).alias("weight")),
        "source-weights")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    cap = F.lit(float(most)) * F.col("source_size")
    level = None
    while True:   # the water level rises until no further source reaches its cap
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= cap
        left = rows.agg(F.sum(F.when(full, cap).otherwise(0.0)).alias("capped"),
                        F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("w")).first()
        if not left["w"]:
            level = float("inf")
            break
        now = (share * total - left["capped"]) / left["w"]
        if level is not None and now <= level:
            break
        level = now
    value = cap if level == float("inf") else F.least(cap, F.col("weight") * F.lit(level))
    return materialize(rows.withColumn("target", value), "targets")


def _numbered(totals: DataFrame) -> DataFrame:
    """Rank of the source keys in code point order ("~", no source, last): sorted by range, numbered
    inside each partition, shifted by the counts of the partitions before it."""
    split = materialize(totals.repartitionByRange(F.col("source"))
                        .withColumn("part", F.spark_partition_id()), "source-ranges")
    sizes = split.groupBy("part").agg(F.count(F.lit(1)).alias("k"))
    before = sizes.select("part", (F.sum("k").over(Window.orderBy("part")) - F.col("k")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source")))
    return split.withColumn("inside", inside).join(before, "part").select(
        "source", "source_size", (F.col("before") + F.col("inside") - 1).alias("rank"))


def multipliers(hist: DataFrame, goal: DataFrame, most: float = MOST, steps: int = STEPS) -> DataFrame:
    """(source, scale, lam, target): the dual solution of every source with words, within TOLERANCE
    of its words; stopping before that is an error, not a result.

    The residual sum(size * rate) - target grows with lam, so the bracket [lo, hi]
    always holds the root; a step that leaves it, or makes no headway, bisects."""
    scale = (hist.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("scale"),
                                        F.min("size").alias("least"),
                                        F.sum(F.col("n") * F.col("size")).alias("own")))
    state = scale.join(goal.select("source", "target"), "source")
    # exp(hi * least / scale) >= most and exp(lo * least / scale) is next to nothing
    hi = F.log(F.lit(float(most))) * F.col("scale") / F.col("least") + 1
    state = materialize(state.select("source", "scale", "target", "own", F.lit(0.0).alias("lam"),
                                     (F.lit(-60.0) * F.col("scale") / F.col("least")).alias("lo"),
                                     hi.alias("hi"), F.lit(None).cast("double").alias("err")), "dual")
    for _ in range(steps):
        z = F.col("size") / F.col("scale")
        raw = F.exp(F.least(F.col("lam") * z, F.lit(30.0)))
        rate = F.least(raw, F.lit(float(most)))
        mass = F.col("n") * F.col("size")
        both = hist.join(state, "source").groupBy("source", "scale", "target", "own", "lam", "lo", "hi").agg(
            F.sum(mass * rate).alias("got"),
            F.sum(F.when(raw < float(most), mass * z * raw).otherwise(0.0)).alias("slope"))
        gap = F.col("got") - F.col("target")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - gap / F.nullif(F.col("slope"), F.lit(0.0))
        done = F.abs(gap) <= F.lit(TOLERANCE) * F.col("own")
        step = F.when(done, F.col("lam")).when((newton > F.col("l2")) & (newton < F.col("h2")), newton) \
            .otherwise((F.col("l2") + F.col("h2")) / 2)
        state = materialize(both.withColumn("l2", lo).withColumn("h2", hi).select(
            "source", "scale", "target", "own", step.alias("lam"), F.col("l2").alias("lo"),
            F.col("h2").alias("hi"), F.when(done, 0.0).otherwise(F.abs(gap) / F.col("own")).alias("err")), "dual")
        if not (state.agg(F.max("err")).first()[0] or 0) > 0:
            return state
    raise NotConverged(f"the dual has a residual left after {steps} rounds")


def _round_classes(most: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # large to small; the words not yet placed go on to the next smaller class
        rows = rows.sort_values("size", ascending=False)
        owed, total = 0.0, []
        for size, n, rate in zip(rows["size"], rows["n"], rows["rate"]):
            owed += size * n * rate
            copies = min(max(int(owed / size + 0.5), 0), most * n)
            owed -= copies * size
            total.append(copies)
        return pd.DataFrame({"source": rows["source"], "size": rows["size"], "n": rows["n"], "copies": total})
    return run


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
        weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 17,
        carry: list[str] | None = None) -> DataFrame:
    """(_row, size, source_size, target, copies) of every row; ``carry`` names the
    columns kept in ``_row`` (default all: the whole row is shuffled once)."""
    # "n" and "s<source>": a key without nulls, so that one partitioning serves all steps
    rows = packed(docs).withColumn("source", F.coalesce(F.concat(
        F.lit("s"), F.col("_row")[source].cast("string")), F.lit("~"))) \
        .withColumn("size", word_count(F.col("_row")[text])) \
        .withColumn("h", F.xxhash64(F.lit(seed), F.col("_row")[key].cast("string"))) \
        .withColumn("id", F.col("_row")[key].cast("string"))
    if carry is not None:
        rows = materialize(rows.withColumn("_row", F.struct(*[F.col("_row")[c].alias(c) for c in carry])),
                           "mix-rows")
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(BUCKETS)))
    sized = materialize(rows.select("source", "size", "bucket"), "sizes")
    goal = targets(sized, weights, share, most)
    hist = histogram(sized)
    dual = multipliers(hist, goal, most)
    rate = F.least(F.exp(F.least(F.col("lam") * F.col("size") / F.col("scale"), F.lit(30.0))),
                   F.lit(float(most)))
    classes = hist.join(dual.select("source", "scale", "lam"), "source").select(
        "source", "size", "n", rate.alias("rate"))
    # at most one row per different document size in a group
    plan = classes.groupBy("source").applyInPandas(
        _round_classes(most), "source string, size long, n long, copies long")
    # the extra copies of a class go to its hash buckets in order, then by hash inside one
    cells = sized.where("size > 0").groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("k"))
    before = F.sum("k").over(Window.partitionBy("source", "size").orderBy("bucket")) - F.col("k")
    share_of = cells.withColumn("before", before).join(plan, ["source", "size"]).select(
        "source", "size", "bucket", F.expr("copies div n").alias("base"),
        F.greatest(F.lit(0), F.least(F.col("k"), F.col("copies") % F.col("n") - F.col("before"))).alias("extra"))
    share_of = materialize(share_of, "cell-copies")
    inside = Window.partitionBy("source", "size", "bucket").orderBy("h", "id")
    ranked = rows.withColumn("rank", F.when(F.col("size") > 0, F.row_number().over(inside)))
    out = ranked.join(share_of, ["source", "size", "bucket"], "left")
    out = out.join(small_side(goal.select("source", "source_size", "target")), "source", "left")
    copies = F.coalesce(F.col("base") + (F.col("rank") <= F.col("extra")).cast("long"), F.lit(0).cast("long"))
    return out.select("_row", "size", "source_size", "target", copies.alias("copies"))
