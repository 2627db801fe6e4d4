"""Fill-in-the-middle: texts are cut into prefix, middle and suffix at unit boundaries and
rearranged for training, as one pyarrow.compute pipeline per Arrow batch.

A unit is a word with the white space before it; white space at the end is a unit of its
own. A batch becomes lists of units, is flattened with the index of each unit's text,
every unit gets its ordinal and from it a role, and per role the lists are rebuilt and
joined. No Python code runs per unit or per text, and nothing is shuffled.

Cuts and form depend on seed and key only, so reruns and lost executors give the same rows.

Defined cases: a null text counts as empty; an empty text, one that holds a sentinel, and
one the draw leaves alone are ``plain`` (output = text, no cut); a null key draws like an
empty one; texts of any length are cut whole, in slices of SLICE_BYTES.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = "<[PSM]>"
#: a word with the white space before it, over the bytes of the text
UNIT = rb"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"
#: never a byte of UTF-8: ends a unit while the text is cut
MARK = b"\xff"
#: text bytes handled at a time (a longer text is a slice of its own)
SLICE_BYTES = 16 << 20


def draws(key: Column, seed: int = 42) -> list[Column]:
    """Four unsigned 32-bit numbers: the first 8-digit groups of sha256("seed:key")."""
    sha = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(sha, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def units(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(units, index of each unit's text) of large_binary texts."""
    ended = pc.replace_substring_regex(texts, pattern=UNIT, replacement=rb"\1" + MARK)
    lists = pc.split_pattern(ended, pattern=MARK)
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(flat), 0)      # what follows the last mark may be empty
    return flat.filter(real), parent.filter(real)


def _joined(flat: pa.Array, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of ``counts`` units, each joined into one piece."""
    offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int64())
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, flat), pa.scalar(b"", pa.large_binary()))


def _chars(pieces: pa.Array) -> pa.Array:
    return pc.cast(pc.utf8_length(pieces.view(pa.large_string())), pa.int64())


def cut(texts: pa.Array, h: list[np.ndarray], fim_percent: int, spm_percent: int) -> list[pa.Array]:
    """(n, form, prefix_chars, middle_chars, output) of one slice of large_string texts."""
    raw = texts.view(pa.large_binary())
    flat, parent = units(raw)
    owner = parent.to_numpy(zero_copy_only=False).astype(np.int64)
    n = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    first, second = h[0] % (n + 1), h[1] % (n + 1)
    lo, hi = np.minimum(first, second), np.maximum(first, second)

    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pa.array(np.cumsum(n) - n).take(parent))
    role = pc.add(pc.cast(pc.greater_equal(ordinal, pa.array(lo).take(parent)), pa.int8()),
                  pc.cast(pc.greater_equal(ordinal, pa.array(hi).take(parent)), pa.int8()))
    prefix, middle, suffix = (_joined(flat.filter(pc.equal(role, r)), counts)
                              for r, counts in enumerate((lo, hi - lo, n - hi)))

    marked = pc.match_substring_regex(raw, pattern=SENTINELS.encode())
    plain = pc.or_(pc.or_(pc.equal(pc.binary_length(raw), 0), marked), pa.array(h[2] % 100 >= fim_percent))
    spm = pa.array(h[3] % 100 < spm_percent)
    p, s, m, none = (pa.scalar(x.encode(), pa.large_binary()) for x in (PREFIX, SUFFIX, MIDDLE, ""))
    output = pc.if_else(plain, raw, pc.if_else(
        spm, pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none),
        pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)))
    no_count = pa.scalar(None, pa.int64())
    return [pa.array(n), pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
            pc.if_else(plain, no_count, _chars(prefix)), pc.if_else(plain, no_count, _chars(middle)),
            output.view(pa.large_string()).cast(pa.string())]


def slices(sizes: np.ndarray, most: int = SLICE_BYTES) -> list[tuple[int, int]]:
    """Consecutive (start, end) of rows with at most ``most`` bytes, one row at least."""
    ends, out, at = np.cumsum(sizes), [], 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        out.append((at, end))
        at = end
    return out


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, fim_percent: int = 50,
              spm_percent: int = 80, carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``_row`` (the columns ``carry``, all by default), n (units), form
    (plain, psm or spm), prefix_chars, middle_chars (code points, null if plain), output."""
    kept = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)])
    rows = docs.select(kept.alias("_row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
                       F.array(*draws(F.col(f"`{key}`"), seed)).alias("_h"))
    long, string = T.LongType(), T.StringType()
    schema = T.StructType([rows.schema["_row"], T.StructField("n", long), T.StructField("form", string),
                           T.StructField("prefix_chars", long), T.StructField("middle_chars", long),
                           T.StructField("output", string)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").cast(pa.large_string())
            numbers = batch.column("_h").flatten().to_numpy().reshape(-1, 4)
            for at, end in slices(pc.binary_length(texts).to_numpy()):
                got = cut(texts[at:end], list(numbers[at:end].T), fim_percent, spm_percent)
                yield pa.RecordBatch.from_arrays([batch.column("_row")[at:end], *got], schema.names)

    return rows.mapInArrow(run, schema)


def restore(output: Column, form: Column) -> Column:
    """The exact text of an output and its form. Outputs that aren't plain hold every sentinel
    once: their text holds none, and no end of a piece makes one with the sentinel after it."""
    piece = F.split(output, SENTINELS)       # nothing stands before the first sentinel
    return (F.when(form == "psm", F.concat(piece[1], piece[3], piece[2]))
            .when(form == "spm", F.concat(piece[2], piece[3], piece[1])).otherwise(output))
