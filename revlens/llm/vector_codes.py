"""Vector codes: product quantisation in integers, exact at every step.

Components become floor(scale * x); a vector is cut into equal consecutive parts and each
part is replaced by the index of its nearest codebook entry. Nearest means smallest
|x|^2 - 2 x.c + |c|^2 in whole numbers: the dot products are one float64 BLAS product per
pair of limbs. Integers are broken into limbs so narrow that no sum of a product reaches
2^53 (so every float64 result is exact), the limb products are shifted and added in int64,
and the first smallest distance wins a tie.

A round is one pass: tasks assign their rows and add up the parts of each entry (at most
parts x entries rows per task whatever the data, so a vector repeated in a third of all
rows is added up where it lies), Spark sums those, and the next codebook of fixed size
(parts x entries x width) is the only thing on the driver.

Defined cases: vectors that are null or hold null, NaN or infinite components are dropped; fewer
vectors than entries give a smaller codebook; equal ids are ordered by their components, null
ids come last; an entry without parts stays. Kept vectors must be of one length that the
number of parts divides, and their integers small enough that a squared distance fits
int64 (2^27 for parts of up to 63 components), else ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.session import materialize

#: rows whose distances to a codebook are held at a time
BLOCK = 4096


def limb_bits(width: int) -> int:
    """Bits of a limb so that ``width`` products of two limbs stay below 2^53."""
    return (53 - max(width, 1).bit_length()) // 2


def largest(width: int) -> int:
    """Bound on integers whose squared distance over ``width`` components fits int64."""
    return 1 << ((62 - max(width, 1).bit_length()) // 2 - 1)


def limbs(a: np.ndarray, bits: int, peak: int) -> list[np.ndarray]:
    """``a`` = sum of limb_i * 2^(bits * i), as float64; all limbs but the last are in
    0 .. 2^bits - 1, the last one has the sign."""
    out, rest = [], a
    while peak >> bits:
        out.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest, peak = rest >> bits, peak >> bits
    return [*out, rest.astype(np.float64)]


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact int64 a @ b.T of int64 matrices by float64 products of limbs."""
    bits = limb_bits(a.shape[1])
    top = [int(np.abs(m).max(initial=0)) for m in (a, b)]
    left, right = limbs(a, bits, top[0]), limbs(b, bits, top[1])
    out = np.zeros((len(a), len(b)), np.int64)
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            out += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first nearest entry, squared distance) of every row."""
    index, error = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    squares = (book * book).sum(axis=1)
    for at in range(0, len(rows), BLOCK):
        x = rows[at:at + BLOCK]
        far = (x * x).sum(axis=1)[:, None] - 2 * dots(x, book) + squares
        best = far.argmin(axis=1)
        index[at:at + BLOCK], error[at:at + BLOCK] = best, far[np.arange(len(x)), best]
    return index, error


@dataclass(frozen=True)
class Codebooks:
    """entries: (parts, entries, width) int64; ``table`` holds the kept integer vectors."""
    entries: np.ndarray
    table: DataFrame

    @property
    def sha256(self) -> str:
        """Of the decimal components by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def integers(rows: DataFrame, vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """``_row`` and ``v`` (array<long>) of the rows whose components are all finite numbers."""
    x = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double"))
    whole = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    others = [F.col(f"`{c}`") for c in rows.columns if c != vector]
    # beyond 2^52 an integer is out of the range anyway: clipped so that the cast holds
    back = F.transform(x, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(2.0 ** 52)), F.lit(-2.0 ** 52))).cast("long"))
    return rows.where(F.col(f"`{vector}`").isNotNull() & whole).select(F.struct(*others).alias("_row"), back.alias("v"))


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    """(parts, rows, width) of a list column."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), parts, -1).transpose(1, 0, 2)


def _sums(table: DataFrame, book: np.ndarray) -> list:
    """One round: (slot, rows, sums per position) of every used entry, summed by Spark."""
    parts, entries, width = book.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, width), np.int64)
        count = np.zeros(parts * entries, np.int64)
        for batch in batches:
            for p, x in enumerate(_matrix(batch.column("v"), parts)):
                index, _ = nearest(x, book[p])
                np.add.at(sums, p * entries + index, x)
                count += np.bincount(p * entries + index, minlength=parts * entries)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]),
                                          pa.array(list(sums[used]), pa.list_(pa.int64()))], ["slot", "n", "s"])

    found = table.select("v").mapInArrow(assign, "slot long, n long, s array<long>")
    exact = [F.sum(F.col("s")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    return found.groupBy("slot").agg(F.sum("n").alias("n"), *exact).collect()    # parts x entries rows


def fit(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = 4, entries: int = 256,
        rounds: int = 4, scale: int = 1024) -> Codebooks:
    """Codebooks that start as the parts of the ``entries`` smallest kept keys."""
    table = materialize(integers(rows, vector, scale), "integer-vectors")
    size = F.size("v")
    top = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: F.greatest(a, F.abs(x)))
    seen = table.agg(F.min(size).alias("lo"), F.max(size).alias("hi"), F.max(top).alias("top")).first()
    dims = seen["hi"] or 0
    if seen["lo"] != seen["hi"] or dims % parts:
        raise ValueError(f"vectors of {seen['lo']} to {seen['hi']} components can't be cut into {parts} equal parts")
    if (seen["top"] or 0) > largest(dims // parts):
        raise ValueError(f"a component of {seen['top']} is beyond the exact range of {largest(dims // parts)}")
    order = F.col(f"_row.`{key}`")
    first = table.orderBy(order.asc_nulls_last(), "v").limit(entries).select("v").collect()
    book = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, dims // parts).transpose(1, 0, 2)
    for _ in range(rounds if len(first) else 0):
        book = book.copy()
        for r in _sums(table, book):
            p, e = divmod(r["slot"], book.shape[1])
            book[p, e] = [int(r[f"s{i}"]) // r["n"] for i in range(book.shape[2])]     # rounds down
    return Codebooks(book, table)


def encode(model: Codebooks) -> DataFrame:
    """``_row``, ``code`` (index of each part, two hex digits or more) and ``error`` (squared
    distances summed over the parts) of every kept vector."""
    book = model.entries
    digits = max(2, len(f"{max(book.shape[1] - 1, 0):x}"))
    schema = T.StructType([model.table.schema["_row"], T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([f"{i:0{digits}x}" for i in range(book.shape[1])], object)
        for batch in batches:
            code, error = np.full(len(batch), "", object), np.zeros(len(batch), np.int64)
            for p, x in enumerate(_matrix(batch.column("v"), len(book))):
                index, far = nearest(x, book[p])
                code, error = code + names[index], error + far
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(code, pa.string()), pa.array(error)],
                                             schema.names)

    return model.table.mapInArrow(run, schema)


def decode(model: Codebooks, codes: np.ndarray) -> np.ndarray:
    """Integer vectors of (rows, parts) indexes."""
    return np.concatenate([model.entries[p][codes[:, p]] for p in range(len(model.entries))], axis=1)


def errors_by(coded: DataFrame, label: str = "label", out: str = "label_error") -> DataFrame:
    """``coded`` (a written table) plus the error summed over equal labels, nulls together. Labels are
    summed before the shuffle; their table is written, so it is broadcast only by its real size and
    joined with AQE's skew handling beyond."""
    name = F.col(f"_row.`{label}`")
    sums = materialize(coded.groupBy(name.alias("_label")).agg(F.sum("error").alias(out)), "label-errors")
    return coded.join(sums, name.eqNullSafe(F.col("_label"))).drop("_label")
