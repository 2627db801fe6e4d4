"""M4: truncated SVD of the TF-IDF matrix and the projection of rows onto it.

Two solvers, both uncentred (ml ``PCA`` would centre and change the meaning):

* ``randomized`` (default, the reference library's default algorithm):
  block subspace iteration on the Gram operator A^T A with ``k + oversample``
  columns and ``n_iter`` power passes. The sparse rows are packed once (PACK entries a
  row, cached). In a pass Q is cut into blocks of columns, a job each, and a task
  adds up A^T (A Q) of one block over one group of rows, so what it emits is one block
  whatever the rows. A group is large: all groups' blocks together are at most
  SHARE of the packed rows (one group at least, at most GROUP entries in it). One
  group needs no shuffle; several are summed per chunk by a grouped aggregation. The
  singular values come from one more pass, as Q^T (A^T A Q). A worker holds
  BLOCK_CELLS doubles of Q and of the sum, whatever vocabulary and rows. The driver holds
  the summed terms x l matrix (bounded by vocabulary cap x (k + oversample)) once, block by
  block overwritten by the next, and orthonormalises it in place by its l x l Gram matrix,
  twice. n_iter + 1 passes. A block's broadcast is destroyed with its files after its job.
* ``exact``: Spark's distributed ``RowMatrix.computeSVD`` (ARPACK; one small
  Spark job per matrix-vector product, so hundreds of jobs).

V is bounded by ``vocabulary cap x k`` (20,000 x 600 doubles = 96 MB at the
published setting); the projection ``X V`` runs per Arrow batch in ``mapInPandas`` with
numpy, by the same blocks; each row only touches its own non-zeros. Sums of rows of factors are stacked
matrix products of pieces of CELLS doubles (``_run_sums``). Components of more than
SENT_CELLS doubles are never sent whole (every executor keeps a broadcast on its disk): a pass
sends one block of columns, writes (id, these features) and destroys the broadcast. What else the rows
hold (texts) takes no part in the passes; a row's blocks meet in one grouping by id before it joins them.
"""

from __future__ import annotations

import gc
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.session import arrow_rows, drop_written, materialize

CHUNK_ROWS = 128       # term rows of one summed block
SENT_CHUNKS = 32       # blocks that leave Python together
RADIX = 256            # blocks that one task adds up
CELLS = 1 << 16        # doubles of a work array: it stays in the processor's cache
BLOCK_TERMS = 2048     # terms whose factors a worker holds at a time (projection)
BLOCK_CELLS = 1 << 22  # doubles of a block of columns (power passes)
SENT_CELLS = 1 << 22   # doubles of factors that are broadcast at a time
PACK = 1 << 21         # entries of the sparse rows packed into one row
BATCH = 1              # packs that cross to Python at a time
GROUP = 1 << 25        # entries that one task multiplies at most
SHARE = 1 / 8          # what the groups' sums may be of the sparse rows


@dataclass
class SvdModel:
    components: np.ndarray   # (n_terms, k), columns sign-fixed
    singular_values: np.ndarray
    n_terms: int
    _sent: dict = field(default_factory=dict, repr=False, compare=False)
    tables: list = field(default_factory=list, repr=False, compare=False)     # written for projections

    @property
    def used(self) -> int:
        """Components up to the rank: those past it are zero and never sent."""
        some = np.flatnonzero(self.components.any(axis=0))
        return int(some[-1]) + 1 if len(some) else 0

    def blocks(self, spark) -> _Blocks:
        """The components as broadcast blocks, sent once a session and used by every projection."""
        key = spark.sparkContext.applicationId
        if key not in self._sent:
            self._sent[key] = _Blocks(spark, np.asarray(self.components, np.float64)[:, :self.used])
        return self._sent[key]

    def release(self) -> None:
        """Drop the broadcast blocks, their files and the tables written for projections; what is made of
        projections must have been written."""
        while self._sent:
            self._sent.popitem()[1].destroy()
        while self.tables:
            drop_written(self.tables.pop())


def doc_arrays(weights: DataFrame, id_col: str = "review_id") -> DataFrame:
    """Long (id, idx, weight) table to one row per document with sorted index
    and value arrays (bounded by that document's distinct terms)."""
    e = F.array_sort(F.collect_list(F.struct("idx", "weight")))
    return (weights.groupBy(id_col).agg(e.alias("_e"))
            .select(id_col, F.transform("_e", lambda x: x["idx"]).alias("idx"),
                    F.transform("_e", lambda x: x["weight"]).alias("val")))


def _signs(v: np.ndarray) -> np.ndarray:
    """Sign of the largest-magnitude loading of every component (of equal ones the first)."""
    hi, lo, at = v.argmax(axis=0), v.argmin(axis=0), np.arange(v.shape[1])
    most, least = v[hi, at], -v[lo, at]
    rows = np.where((least > most) | ((least == most) & (lo < hi)), lo, hi)
    signs = np.sign(v[rows, at])
    signs[signs == 0] = 1.0
    return signs


def fix_signs(v: np.ndarray) -> np.ndarray:
    """Make the largest-magnitude loading of every component positive."""
    return v * _signs(v)


def _sparse(idx, val) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of index and value lists as one CSR triple (indices, values, row of each)."""
    sizes = np.fromiter((0 if i is None else len(i) for i in idx), np.int64, len(idx))
    some = [k for k, n in enumerate(sizes) if n]
    if not some:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    cols = np.concatenate([np.asarray(idx[k], np.int64) for k in some])
    vals = np.concatenate([np.asarray(val[k], np.float64) for k in some])
    return cols, vals, np.repeat(np.arange(len(idx)), sizes)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal keys, short runs first."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    order = np.argsort(sizes, kind="stable")
    return starts[order], sizes[order]


def _run_sums(vals, of, factors, keys):
    """(keys, sums of vals * factors[of]) of the runs of equal keys, a bounded piece at a time: runs of one
    length are one stacked matrix product, and a run longer than CELLS / width comes in pieces, so a key
    may come more than once (never twice in one yield)."""
    starts, sizes = _runs(keys)
    most = max(1, CELLS // factors.shape[1])
    ends = np.r_[np.flatnonzero(sizes[1:] != sizes[:-1]) + 1, len(sizes)].tolist() if len(sizes) else []
    for first, end in zip([0, *ends], ends):
        size = int(sizes[first])
        for lo in range(0, size, most):
            span = np.arange(lo, min(size, lo + most))
            for at in range(first, end, max(1, most // len(span))):
                here = starts[at:min(end, at + max(1, most // len(span)))]
                entries = here[:, None] + span
                yield keys[here], np.matmul(vals[entries][:, None, :], factors.take(of[entries], axis=0))[:, 0]


class _Blocks:
    """A matrix broadcast in blocks of BLOCK_TERMS rows. A worker reads a block when it needs
    it and keeps none."""

    def __init__(self, spark, matrix: np.ndarray):
        self.width = matrix.shape[1]
        self.step = BLOCK_TERMS
        self.parts = [spark.sparkContext.broadcast(np.ascontiguousarray(matrix[at:at + self.step]))
                      for at in range(0, len(matrix), self.step)]

    def read(self, i: int) -> np.ndarray:
        value = self.parts[i].value
        self.parts[i].__dict__.pop("_value", None)      # what the worker would keep of it
        return value

    def times(self, cols, vals, rows, n: int) -> np.ndarray:
        """Sparse rows (as one CSR triple) times the matrix: n x width."""
        out = np.zeros((n, self.width))
        block = cols // self.step
        order = np.lexsort((rows, block))
        cols, vals, rows, block = cols[order], vals[order], rows[order], block[order]
        for i in np.unique(block):
            here = slice(*np.searchsorted(block, (i, i + 1)))
            for r, sums in _run_sums(vals[here], cols[here] - i * self.step, self.read(i), rows[here]):
                out[r] += sums
        return out

    def destroy(self) -> None:
        for b in self.parts:
            b.destroy()


PACKED = "n int, cols binary, sizes binary, vals binary, order binary"


def _pack(batches):
    """Rows of (idx, val) lists as CSR triples of about PACK entries each, with the order by term."""
    import pandas as pd
    for pdf in batches:
        idx, val = pdf["idx"].tolist(), pdf["val"].tolist()
        ends = np.cumsum([0 if i is None else len(i) for i in idx], dtype=np.int64)
        cuts = np.flatnonzero(np.diff(ends // PACK)) + 1
        for at, end in zip(np.r_[0, cuts], np.r_[cuts, len(idx)] if idx else ()):
            cols, vals, rows = _sparse(idx[at:end], val[at:end])
            order = np.argsort(cols, kind="stable")
            yield pd.DataFrame({"n": [int(end - at)], "cols": [cols.astype(np.int32).tobytes()],
                                "sizes": [np.bincount(rows, minlength=end - at).astype(np.int32).tobytes()], "vals": [vals.tobytes()],
                                "order": [order.astype(np.int32).tobytes()]})


def packed(arrays: DataFrame) -> DataFrame:
    return arrays.select("idx", "val").mapInPandas(_pack, PACKED)


def _groups(entries: int, cells: int, n_parts: int) -> int:
    """Groups of rows whose sums of ``cells`` doubles each are added up: as many as SHARE of the
    bytes of the sparse rows (12 an entry) allows, and as GROUP demands."""
    return max(1, min(n_parts, max(-(-entries // GROUP), int(entries * 12 * SHARE / (8 * max(1, cells))))))


def _gram_blocks(arrays: DataFrame, q: np.ndarray, groups: int):
    """(first column, block) of A^T A Q for the sparse rows of ``arrays`` (plain or packed), one
    distributed pass: the blocks of columns are jobs side by side, as many as fill the cores, with
    at most SENT_CELLS doubles of Q sent at a time.

    A task adds up one block of columns over one of ``groups`` groups of rows. Chunks of CHUNK_ROWS
    terms of several groups are summed as a tree of radix RADIX."""
    from multiprocessing.pool import ThreadPool

    import pandas as pd
    import pyarrow as pa
    from pyspark import inheritable_thread_target
    spark, chunk = arrays.sparkSession, CHUNK_ROWS
    n_terms, width = q.shape
    packs = (arrays if "order" in arrays.columns else packed(arrays)).coalesce(groups)
    side = -(-spark.sparkContext.defaultParallelism // groups)
    step = max(1, min(BLOCK_CELLS, SENT_CELLS // side) // max(1, n_terms))

    def partial(block):
        def run(batches):
            from pyspark import TaskContext
            factors, total = None, None
            for batch in batches:
                for i in range(batch.num_rows):
                    if total is None:
                        factors = block.value
                        total = np.zeros_like(factors)
                    cols, sizes, order = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int32) for c in ("cols", "sizes", "order"))
                    vals, rows = np.frombuffer(batch.column("vals")[i].as_buffer()), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
                    w = np.zeros((len(sizes), factors.shape[1]))
                    for r, sums in _run_sums(vals, cols, factors, rows):
                        w[r] += sums
                    for t, sums in _run_sums(vals[order], rows[order], w, cols[order]):
                        total[t] += sums
            if total is not None:
                grp = TaskContext.get().partitionId()
                some = [c for c in range(0, n_terms, chunk) if total[c:c + chunk].any()]
                for at in range(0, len(some), SENT_CHUNKS):
                    part = some[at:at + SENT_CHUNKS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c // chunk for c in part], pa.int32()), pa.array([grp] * len(part), pa.int32()),
                         pa.array([total[c:c + chunk].tobytes() for c in part], pa.binary())], ["chunk", "grp", "data"])
        return run

    def add(pdf):
        total = np.frombuffer(pdf["data"].iloc[0]).copy()
        for data in pdf["data"].iloc[1:]:
            total += np.frombuffer(data)
        return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])], "grp": [int(pdf["grp"].iloc[0])], "data": [total.tobytes()]})

    def one(at):
        block = spark.sparkContext.broadcast(np.ascontiguousarray(q[:, at:at + step]))
        try:
            schema, left = "chunk int, grp int, data binary", groups
            summed = packs.mapInArrow(partial(block), schema)
            while left > 1:
                summed = summed.withColumn("grp", F.floor(F.col("grp") / RADIX).cast("int")) \
                    .groupBy("chunk", "grp").applyInPandas(add, schema)
                left = -(-left // RADIX)
            z = np.zeros((n_terms, min(step, width - at)))
            for r in summed.collect():        # bounded: one block
                part = z[r["chunk"] * chunk:(r["chunk"] + 1) * chunk]
                part += np.frombuffer(r["data"]).reshape(part.shape)
            return at, z
        finally:
            block.destroy()

    threads = max(1, min(-(-width // step), side))
    with arrow_rows(spark, BATCH), ThreadPool(threads) as pool:
        yield from pool.imap(inheritable_thread_target(spark)(one), range(0, width, step))


def _gram_pass(arrays: DataFrame, q: np.ndarray, groups: int, out: np.ndarray | None = None) -> np.ndarray:
    """A^T A Q (one distributed pass). ``out`` may be ``q``: a block that came back isn't read again."""
    z = np.zeros(q.shape) if out is None else out
    for at, block in _gram_blocks(arrays, q, groups):
        z[:, at:at + block.shape[1]] = block
    return z


def _turned(z: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """``z @ turn`` (no more columns than ``z`` has) in the memory of ``z``."""
    for at in range(0, len(z), BLOCK_TERMS):
        z[at:at + BLOCK_TERMS, :turn.shape[1]] = z[at:at + BLOCK_TERMS] @ turn
    return z[:, :turn.shape[1]]


def _orthonormal(z: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span those of ``z`` (fewer, if they are dependent), in its memory: turned
    by the eigenvectors of the l x l Gram matrix of the scaled columns, twice for full precision."""
    for _ in range(2):
        gram = z.T @ z
        size = np.sqrt(np.diag(gram))
        some = np.flatnonzero(size > 0)
        size = size[some]
        values, vectors = np.linalg.eigh(gram[np.ix_(some, some)] / np.outer(size, size))
        keep = values > 1e-13 * values.max(initial=0.0)
        turn = np.zeros((z.shape[1], int(keep.sum())))
        turn[some] = vectors[:, keep] / np.sqrt(values[keep]) / size[:, None]
        z = _turned(z, turn)
    return z


def _fit_randomized(arrays: DataFrame, n_terms: int, k: int, n_iter: int,
                    oversample: int, seed: int, groups_of) -> SvdModel:
    width = min(n_terms, k + oversample)
    rng = np.random.default_rng(seed)
    q = _orthonormal(rng.standard_normal((n_terms, width)))
    for _ in range(n_iter):
        q = _orthonormal(_gram_pass(arrays, q, groups_of(q.size), out=q))
    small = np.zeros((q.shape[1], q.shape[1]))      # (A Q)^T (A Q): width x width
    for at, block in _gram_blocks(arrays, q, groups_of(q.size)):
        small[:, at:at + block.shape[1]] = q.T @ block
    evals, w = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(evals)[::-1][:k]
    v = _turned(q, w[:, order])
    v *= _signs(v)
    return SvdModel(v, np.sqrt(np.clip(evals[order], 0.0, None)), n_terms)


def fit(arrays: DataFrame, n_terms: int, k: int, method: str = "randomized",
        n_iter: int = 5, oversample: int = 10, seed: int = 42) -> SvdModel:
    """M4: distributed truncated SVD of the rows in ``arrays`` (fit on training rows)."""
    k = int(min(k, n_terms))
    if method != "randomized":
        src = arrays.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return _fit_exact(src, n_terms, k)
        finally:
            src.unpersist()
    src = packed(arrays).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # fills the cache; partitions stay as they come
        n = src.select("n", (F.length("vals") / 8).cast("long").alias("m"), F.spark_partition_id().alias("p")).agg(
            *[F.coalesce(x, F.lit(0)).alias(c) for c, x in (("rows", F.sum("n")), ("entries", F.sum("m")), ("last", F.max("p")))]).first()
        # no more than the number of rows of singular values differ from zero: the rest is filled with zeros
        n_rows = n["rows"]
        rank = max(1, min(k, n_rows))
        got = _fit_randomized(src, n_terms, rank, n_iter, min(oversample, max(0, n_rows - rank)), seed,
                              lambda cells: _groups(n["entries"], cells, n["last"] + 1))
    finally:
        src.unpersist()
        # nothing else frees the shuffle files that the cached rows were made of
        spark = src.sparkSession
        del src
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    more = k - len(got.singular_values)
    if not more:
        return got
    return SvdModel(np.pad(got.components, ((0, 0), (0, more))), np.pad(got.singular_values, (0, more)), n_terms)


def _fit_exact(src: DataFrame, n_terms: int, k: int) -> SvdModel:
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.linalg.distributed import RowMatrix

    # ARPACK runs one distributed matrix-vector product per step
    rows = src.rdd.map(lambda r: Vectors.sparse(n_terms, r["idx"], r["val"]))
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        svd = RowMatrix(rows, numCols=n_terms).computeSVD(k, computeU=False)
        v = fix_signs(svd.V.toArray())
        s = svd.s.toArray()
    finally:
        rows.unpersist()
    return SvdModel(v, s, n_terms)


def project(model: SvdModel, docs: DataFrame, arrays: DataFrame, id_col: str = "review_id",
            out: str = "features") -> DataFrame:
    """``X V`` for every row of ``docs``; rows without a known term get zeros. With more than
    SENT_CELLS doubles of components the result is a written table (see ``SvdModel.release``), made of
    a written table per block of columns; ``arrays`` is written for them, if it isn't, and dropped after
    them, if it is the model's."""
    spark, k, used = docs.sparkSession, model.components.shape[1], model.used
    step = max(1, SENT_CELLS // max(1, model.n_terms))
    if used <= step:
        return _with_products(docs.join(arrays, id_col, "left"), model.blocks(spark), k, out).drop("idx", "val")
    if not hasattr(arrays, "_written_path"):
        arrays = materialize(arrays.select(id_col, "idx", "val"), "tfidf-arrays")
        model.tables.append(arrays)
    parts = []
    for at in range(0, used, step):
        blocks = _Blocks(spark, np.asarray(model.components[:, at:min(used, at + step)], np.float64))
        try:
            part = _with_products(arrays.select(id_col, "idx", "val"), blocks, blocks.width, "part")
            parts.append(materialize(part.select(id_col, F.lit(at).alias("at"), "part"), "products"))
        finally:
            blocks.destroy()
    if any(t is arrays for t in model.tables):      # nothing reads it any more
        model.tables[:] = [t for t in model.tables if t is not arrays]
        drop_written(arrays)
    # bounded: the blocks of one row
    each = reduce(DataFrame.unionByName, parts).groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("at", "part"))).alias("_p"))
    zero = F.lit(0.0).cast("float")
    whole = F.concat(F.flatten(F.transform("_p", lambda p: p["part"])), F.array_repeat(zero, k - used))
    joined = docs.join(each, id_col, "left").withColumn(out, F.coalesce(whole, F.array_repeat(zero, k))).drop("_p")
    joined = materialize(joined, "projected")
    model.tables.append(joined)
    for part in parts:
        drop_written(part)
    return joined


def _with_products(rows: DataFrame, blocks: _Blocks, k: int, out: str) -> DataFrame:
    """``rows`` with their products with the components of ``blocks`` as ``out``, filled with zeros up to ``k``."""
    from pyspark.sql.types import ArrayType, FloatType, StructField, StructType
    schema = StructType(list(rows.schema.fields) + [StructField(out, ArrayType(FloatType()))])

    def run(batches):
        for pdf in batches:
            feats = np.zeros((len(pdf), k), np.float32)
            feats[:, :blocks.width] = blocks.times(*_sparse(pdf["idx"].tolist(), pdf["val"].tolist()), len(pdf))
            pdf[out] = list(feats)
            yield pdf

    return rows.mapInPandas(run, schema)
