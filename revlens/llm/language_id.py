"""Language ID by conditional compression.

One raw-content zstandard dictionary per language; a text is encoded with every
dictionary and the language with the smallest output wins. A narrow margin
between the best two is a rejection.

Before encoding, a text is reduced to its distinct lower-cased letter runs in
order of first appearance (all of them, the whole text), so that repeated words
and markup don't drown the evidence.

Defined cases: null text or no letter -> ``und``, score 0, rejected; a tie goes to
the language with more labelled rows (then by name) and is rejected; with no
labelled row at all every text is ``und``. Dictionaries take at most ``max_langs`` x
``docs_per_lang`` x ``clip`` characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.common import hash_share, packed

UNDETERMINED = "und"
PIECE = 4096        # bytes encoded at a time, so the dictionary matters along the whole text
LEVEL = 6
MARGIN_SCALE = 0.05


@dataclass(frozen=True)
class LanguageModel:
    """Languages in tie order and their raw dictionaries (at most
    ``docs_per_lang * clip`` characters each)."""
    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]


def letter_words(text: Column) -> Column:
    """Distinct lower-cased runs of letters and marks joined by spaces ('' without a letter)."""
    runs = F.split(F.lower(text), r"[^\p{L}\p{M}]+")
    words = F.array_join(F.array_remove(F.array_distinct(runs), ""), " ")
    return F.when(text.rlike(r"\p{L}"), words).otherwise("")


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        docs_per_lang: int = 64, clip: int = 1024, max_langs: int = 512) -> LanguageModel:
    """Dictionaries from a bounded sample of labelled rows: per language (the ``max_langs`` with most
    rows, ties by name) the ``docs_per_lang`` rows of smallest key hash, ``clip`` characters of each.
    Languages are counted first; only rows in the lowest part of the hashes are ranked."""
    rows = labelled.select(F.col(lang).alias("lang"), F.xxhash64(F.col(key)).alias("h"),
                           F.col(text).alias("text")).where("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "lang").limit(max_langs).collect()}
    if not counts:
        return LanguageModel((), ())
    rows = rows.where(F.col("lang").isin(list(counts)))
    known = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])
    part = F.pmod("h", F.lit(1 << 31))
    order = Window.partitionBy("lang").orderBy(part, "h", "text")
    sample = (rows.where(hash_share(F.col("h"), known[F.col("lang")], docs_per_lang))
              .select("lang", "h", F.substring("text", 1, 4 * clip).alias("text"))
              .withColumn("k", F.row_number().over(order)).where(F.col("k") <= docs_per_lang)
              .select("lang", "k", F.substring(letter_words(F.col("text")), 1, clip).alias("words")))
    parts: dict[str, dict[str, None]] = {}
    for r in sorted(sample.collect(), key=lambda r: (r["lang"], -r["k"])):
        parts.setdefault(r["lang"], {})[r["words"]] = None
    langs = sorted((g for g in parts if any(parts[g])), key=lambda g: (-counts[g], g))
    # zstandard treats a dictionary under 8 bytes as none: pad with spaces
    return LanguageModel(tuple(langs), tuple(" ".join(parts[g]).encode().ljust(8) for g in langs))


def _encoders(model: LanguageModel) -> list:
    out = []
    for raw in model.dictionaries:
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                            write_checksum=False, write_dict_id=False))
    return out


def _sizes(data: bytes, encoders: list) -> list[int]:
    return [sum(len(c.compress(data[i:i + PIECE])) for i in range(0, len(data), PIECE))
            for c in encoders]


def decide(words: str, encoders: list, languages: tuple[str, ...]) -> tuple[str, float, float]:
    """(language, score, margin) of one normalised text."""
    if not words or not languages:
        return UNDETERMINED, 0.0, 0.0
    sizes = _sizes(words.encode(), encoders)
    ranked = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
    best = ranked[0]
    if len(ranked) == 1:
        return languages[best], 1.0, 1.0
    margin = 1.0 - sizes[best] / sizes[ranked[1]]
    return languages[best], margin / (margin + MARGIN_SCALE), margin


def predict(docs: DataFrame, model: LanguageModel, text: str = "text",
            min_margin: float = 0.005, out: str = "language") -> DataFrame:
    """``_row`` (the whole input row) and the struct ``out``: lang, score (0 to 1), margin, rejected.
    Only the normalised words of a batch are in a Python worker at a time."""
    spec = "lang string, score double, margin double"

    @F.pandas_udf(spec)
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoders = _encoders(model)
        for batch in batches:
            yield pd.DataFrame([decide(w, encoders, model.languages) for w in batch],
                               columns=["lang", "score", "margin"])

    rows = packed(docs)
    kept = rows.withColumn(out, classify(letter_words(F.col("_row")[text])))
    p = F.col(out)
    return kept.withColumn(out, F.struct(
        p["lang"].alias("lang"), p["score"].alias("score"), p["margin"].alias("margin"),
        ((p["lang"] == UNDETERMINED) | (p["margin"] < min_margin)).alias("rejected")))


def held_out(key: str = "doc_id", mod: int = 5, remainder: int = 0) -> Column:
    """Fold of a row by crc32 of its id as text; a null id is held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % mod == remainder, F.lit(True))
