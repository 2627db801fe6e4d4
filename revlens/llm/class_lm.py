"""Class-based bigram language model (Brown classes) by distributed exchange clustering.

P(text) is the product over its words and one end token of P(class | class before) *
P(word | class). Training is a few passes over the training texts:

1. Words are counted. The ``max_units`` most frequent words (those seen MIN_UNIT times at
   least) are units of their own; all other words, unknown ones included, belong to the
   unit of their ending (``groups`` hash slots), so every token of the corpus takes part.
2. Neighbouring units are counted over all tokens and written as one row per unit with its
   neighbours on both sides (at most 2 x units entries).
3. Exchange: the most frequent words start as classes of their own, the others enter in order of
   frequency in growing batches, the endings last; then ``sweeps`` rounds move a quarter of the units at a time to the
   class that raises the likelihood of the class bigrams most. Units are judged where their row
   lies; only moves and the class matrix (classes^2 cells, summed by Spark) reach the driver. A
   round of moves that lowers the likelihood is undone.
4. Transitions are interpolated with class shares (Witten-Bell); a unit's share of its class is
   add-one; a word of an ending group has its discounted share, and the discount goes to the
   one unknown word of the group. Each distribution sums to one.

Scoring is one pass with the frequent words (``max_known`` at most) at hand. The other words are
joined with the written word table by a shuffle, so that no table that grows with the
corpus is broadcast or collected, and a word in a third of all texts is never shuffled.

Defined cases: null and empty texts are the end token alone; rows with a null key are held out (and
scored); repeated rows stay repeated; without training rows every distribution is the smoothed one.
Texts of any length are read in pieces.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.session import arrow_rows, materialize

MIN_UNIT = 3          # a word needs that many sightings to be a unit of its own
ENDING = 3            # bytes of a word that name its group
PIECE = 1 << 20       # bytes of a text split at a time
BLOCK = 1 << 18       # words looked up at a time
HELD = 1 << 19        # different words or pairs a task holds before it passes them on
PORTIONS = 4          # rounds of a sweep
SHIFT = 24            # bits of the second unit in a pair key
BATCH = 1000          # texts (or units with their neighbours) that cross to Python at a time
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


# --- reading ----------------------------------------------------------------------------

def pieces(raw: bytes) -> Iterator[list[bytes]]:
    """Words of a text, A-Z lowered, a bounded piece of it at a time."""
    at = 0
    while True:
        end = _SPACE.search(raw, at + PIECE) if len(raw) - at > PIECE else None
        # bytes.lower changes A-Z only and bytes.split cuts at \x20 and \x09 to \x0D
        yield raw[at:end.start() if end else len(raw)].lower().split()
        if not end:
            return
        at = end.start()


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    column = batch.column(name).cast(pa.large_binary())
    for value in column:
        yield value.as_py() or b""


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """(words, text of each word, texts that end after so many words of the block) of a batch."""
    words: list[bytes] = []
    owners: list[tuple[int, int]] = []
    ends: list[tuple[int, int]] = []

    def flush():
        owner = np.repeat(np.array([o for o, _ in owners], np.int64), np.array([n for _, n in owners], np.int64))
        return words, owner, np.array(ends, np.int64).reshape(-1, 2)

    for i, raw in enumerate(texts(batch)):
        for part in pieces(raw):
            words += part
            owners.append((i, len(part)))
            if len(words) >= BLOCK:
                yield flush()
                words, owners, ends = [], [], []
        ends.append((i, len(words)))
    yield flush()


# --- words --------------------------------------------------------------------------------

def word_table(train: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all training texts: counted in the tasks, then summed by Spark."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                              ["word", "n"])
        for batch in batches:
            for raw in texts(batch):
                for part in pieces(raw):
                    seen.update(part)
                if len(seen) >= HELD:
                    yield out()
                    seen.clear()
        yield out()

    rows = train.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "word binary, n long")
    return materialize(rows.groupBy("word").agg(F.sum("n").alias("n")), "lm-words")


def group_of(word: bytes, groups: int) -> int:
    return zlib.crc32(word[-ENDING:]) % groups


def _group_column(word: Column, groups: int) -> Column:
    return (F.crc32(F.substring(word, -ENDING, ENDING)) % groups).cast("int")


@dataclass(frozen=True)
class Words:
    """Counts of the training words; ``known`` holds the most frequent ones in order."""
    table: DataFrame          # word, n: all of them
    texts: int                # training texts = end tokens
    tokens: int               # N, end tokens included
    distinct: int             # V, the end token included
    known: list[bytes]
    counts: np.ndarray        # of the known words
    limit: int                # words seen so often are known
    n_units: int              # the first so many known words are units of their own
    groups: int
    group_tokens: np.ndarray  # tokens of each ending group
    group_words: np.ndarray   # different words of each ending group
    discount: float

    @property
    def unit_counts(self) -> np.ndarray:
        """Tokens of each unit: end token, words, ending groups."""
        return np.concatenate(([self.texts], self.counts[:self.n_units], self.group_tokens)).astype(np.int64)

    @property
    def unit_of_known(self) -> np.ndarray:
        rest = [1 + self.n_units + group_of(w, self.groups) for w in self.known[self.n_units:]]
        return np.concatenate((np.arange(1, self.n_units + 1), rest)).astype(np.int64)


def _least_count(histogram: list, most: int, floor: int = 1) -> int:
    """Smallest count so that at most ``most`` words reach it; ``histogram`` falls by count."""
    words, least = 0, 1 << 62
    for lowest, n in histogram:
        words += n
        if words > most or lowest < floor:
            break
        least = lowest
    return least


def count_words(train: DataFrame, text: str = "text", max_known: int = 1 << 18, max_units: int = 1 << 14,
                groups: int = 512) -> Words:
    table = word_table(train, text)
    # counts of counts: exact up to 4,096, 64 steps per doubling beyond
    step = F.when(F.col("n") <= 4096, F.col("n")).otherwise(4096 + F.floor(F.log2(F.col("n") / 4096) * 64))
    hist = [(r["low"], r["words"], r["tokens"]) for r in table.groupBy(step.alias("step")).agg(
        F.min("n").alias("low"), F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens")).collect()]
    hist.sort(reverse=True)
    falling = [(low, words) for low, words, _ in hist]
    limit, unit_limit = _least_count(falling, max_known), _least_count(falling, max_units, MIN_UNIT)
    n_texts = train.count()
    top = table.where(F.col("n") >= limit).toArrow()          # at most max_known rows
    known = sorted(zip(top.column("word").to_pylist(), top.column("n").to_pylist()), key=lambda w: (-w[1], w[0]))
    of_group = table.where(F.col("n") < unit_limit).groupBy(_group_column(F.col("word"), groups).alias("g")).agg(
        F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("words")).collect()
    tokens, words = np.zeros(groups, np.int64), np.zeros(groups, np.int64)
    for r in of_group:
        tokens[r["g"]], words[r["g"]] = r["tokens"], r["words"]
    once, twice = (sum(w for low, w, _ in hist if low == k) for k in (1, 2))
    discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5
    return Words(table, n_texts, sum(t for *_, t in hist) + n_texts, sum(w for _, w, _ in hist) + (n_texts > 0),
                 [w for w, _ in known], np.array([n for _, n in known], np.int64), limit,
                 sum(n >= unit_limit for _, n in known), groups, tokens, words, discount)


class Lookup:
    """Known words of a task: word -> place, place -> unit."""

    def __init__(self, blob: bytes, units: np.ndarray, first_group: int, groups: int):
        self.place = {w: i for i, w in enumerate(blob.split())}
        self.units, self.first_group, self.groups = units, first_group, groups

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place or -1, unit, indexes of the words without a place)."""
        place = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(place < 0)
        unit = self.units[place] if len(self.units) else np.zeros(len(words), np.int64)
        unit[missing] = [self.first_group + group_of(words[i], self.groups) for i in missing]
        return place, unit, missing


def _shared(words: Words, spark):
    return spark.sparkContext.broadcast((b" ".join(words.known), words.unit_of_known, 1 + words.n_units, words.groups))


def _stream(unit: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Units of a block with the end token (unit 0) after each text that ends in it."""
    return np.insert(unit, ends[:, 1], 0)


# --- neighbours -----------------------------------------------------------------------------

def neighbours(train: DataFrame, words: Words, text: str = "text") -> DataFrame:
    """(unit, codes, counts): one row per unit; a code is 2 * other + side, side 0 for the
    unit after it, 1 for the unit before it. Texts follow each other with one end
    token between them, which is the word before the first one, too."""
    shared = _shared(words, train.sparkSession)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, last, held, size = Lookup(*shared.value), 0, [], 0

        def out() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.int64), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["pair", "n"])
        for batch in batches:
            for got, _, ends in _blocks(batch):
                stream = _stream(look(got)[1], ends)
                if not len(stream):
                    continue
                before = np.concatenate(([last], stream[:-1]))
                last = stream[-1]
                held.append(before << SHIFT | stream)
                size += len(stream)
                if size >= 4 * HELD:
                    yield out()
                    held, size = [], 0
        yield out()

    rows = train.select(F.col(f"`{text}`").alias("text")).mapInArrow(pairs, "pair long, n long")
    counted = rows.groupBy("pair").agg(F.sum("n").alias("n"))
    a, b = F.shiftright("pair", SHIFT).cast("int"), F.col("pair").bitwiseAND((1 << SHIFT) - 1).cast("int")
    # both directions of a pair leave the same task; a unit has at most two entries per other unit
    both = counted.select(F.explode(F.array(F.struct(a.alias("unit"), (2 * b).alias("code"), "n"),
                                            F.struct(b.alias("unit"), (2 * a + 1).alias("code"), "n"))).alias("e"))
    lists = both.select("e.*").groupBy("unit").agg(F.collect_list(F.struct("code", "n")).alias("e"))
    return materialize(lists.select("unit", F.col("e.code").alias("codes"), F.col("e.n").alias("counts")), "lm-neighbours")


# --- exchange -------------------------------------------------------------------------------

def _xlogx(a: np.ndarray) -> np.ndarray:
    return a * np.log(np.maximum(a, 1.0))


def likelihood(matrix: np.ndarray) -> float:
    """Sum of n log n over class pairs minus the one over classes before and after."""
    m = matrix.astype(np.float64)
    return float(_xlogx(m).sum() - _xlogx(m.sum(axis=1)).sum() - _xlogx(m.sum(axis=0)).sum())


def gains(matrix: np.ndarray, after: np.ndarray, before: np.ndarray, own: np.ndarray, home: np.ndarray) -> np.ndarray:
    """Likelihood of the class bigrams with each unit in each class, up to a constant of the unit.

    ``after`` / ``before``: (units, classes) counts of the classes after and before a unit,
    ``own``: how often it follows itself, ``home``: its class. The unit is taken out of
    its class first, then put into every class."""
    n, k = after.shape
    at = np.arange(n)
    m = np.repeat(matrix[None].astype(np.float64), n, axis=0)
    m[at, home] -= after
    m[at, :, home] -= before
    m[at, home, home] += own
    s, p = after.astype(np.float64), before.astype(np.float64)
    s[at, home] -= own
    p[at, home] -= own
    left, right = m.sum(axis=2) + p, m.sum(axis=1) + s        # the neighbours' own totals stay what they are
    flat = _xlogx(m)
    row, col = _xlogx(m + s[:, None, :]) - flat, _xlogx(m + p[:, :, None]) - flat
    diag = np.arange(k)
    total = row.sum(axis=2) + col.sum(axis=1) - row[:, diag, diag] - col[:, diag, diag]
    here = m[:, diag, diag]
    total += _xlogx(here + s + p + own[:, None]) - _xlogx(here)
    out, into = after.sum(axis=1)[:, None], before.sum(axis=1)[:, None]
    return total - (_xlogx(left + out) - _xlogx(left)) - (_xlogx(right + into) - _xlogx(right))


def _profiles(batch: pa.RecordBatch, cls: np.ndarray, k: int):
    """Class counts after and before, and own pairs, of the units of a batch."""
    unit = batch.column("unit").to_numpy()
    codes = batch.column("codes").flatten().to_numpy()
    counts = batch.column("counts").flatten().to_numpy()
    row = np.repeat(np.arange(len(unit)), np.diff(batch.column("codes").offsets.to_numpy()))
    other, side = codes >> 1, codes & 1
    cell = (row * 2 + side) * k + cls[other]
    both = np.bincount(cell, counts, len(unit) * 2 * k).reshape(len(unit), 2, k)
    same = (other == unit[row]) & (side == 0)
    return unit, both[:, 0], both[:, 1], np.bincount(row[same], counts[same], len(unit))


def class_matrix(rows: DataFrame, cls: np.ndarray, k: int) -> np.ndarray:
    """Counts of class pairs, summed by Spark: at most k * k rows reach the driver."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            unit, after, _, _ = _profiles(batch, cls, k)
            np.add.at(total, cls[unit], after)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.reshape(-1)[cell].astype(np.int64))], ["cell", "n"])

    got = np.zeros(k * k, np.int64)
    for r in rows.mapInArrow(part, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        got[r["cell"]] = r["n"]
    return got.reshape(k, k)


def _moves(rows: DataFrame, cls: np.ndarray, matrix: np.ndarray, classes: int) -> dict[int, int]:
    """Best class of each unit of ``rows`` where it differs from its own (ties: stay, then the lowest)."""
    k = len(matrix)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, after, before, own = _profiles(batch, cls, k)
            home = cls[unit]
            best = home.copy()
            for at in range(0, len(unit), 64):
                cut = slice(at, at + 64)
                value = gains(matrix, after[cut], before[cut], own[cut], home[cut])
                stay = value[np.arange(len(value)), home[cut]].copy()
                value[:, 0] = value[:, classes:] = -np.inf      # the end token's class and the waiting units'
                top = value.argmax(axis=1)
                better = (value[np.arange(len(value)), top] > stay + 1e-6) | (home[cut] >= classes)
                best[cut] = np.where(better, top, home[cut])
            moved = np.flatnonzero(best != home)
            yield pa.RecordBatch.from_arrays([pa.array(unit[moved], pa.int32()), pa.array(best[moved], pa.int32())], ["unit", "c"])

    return {r["unit"]: r["c"] for r in rows.mapInArrow(judge, "unit int, c int").collect()}     # at most the units


def exchange(rows: DataFrame, units: int, classes: int = 64, sweeps: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(class of each unit, class matrix). Class 0 is the end token's alone; units that haven't entered
    yet wait in an extra class, where units that no training text holds stay."""
    waiting, k = classes, classes + 1
    cls = np.full(units, waiting, np.int64)
    entered = min(classes, units)
    cls[:entered] = np.arange(entered)
    matrix = class_matrix(rows, cls, k)
    size = classes
    while entered < units:
        batch = rows.where((F.col("unit") >= entered) & (F.col("unit") < entered + size))
        for u, c in _moves(batch, cls, matrix, classes).items():
            cls[u] = c
        entered, size = entered + size, size * 2
        matrix = class_matrix(rows, cls, k)
    best = likelihood(matrix)
    for r in range(sweeps * PORTIONS):
        trial = cls.copy()
        part = rows.where((F.col("unit") > 0) & (F.col("unit") % PORTIONS == r % PORTIONS))
        for u, c in _moves(part, cls, matrix, classes).items():
            trial[u] = c
        if (trial == cls).all():
            continue
        changed = class_matrix(rows, trial, k)
        value = likelihood(changed)
        if value > best:
            cls, matrix, best = trial, changed, value
    return cls, matrix[:classes, :classes]


# --- model ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class ClassModel:
    words: Words
    classes: np.ndarray        # class of each unit
    matrix: np.ndarray         # counts of class pairs

    def transitions(self) -> np.ndarray:
        """log10 P(class | class before), Witten-Bell with add-one class shares."""
        k = len(self.matrix)
        m = self.matrix.astype(np.float64)
        share = (m.sum(axis=0) + 1) / (m.sum() + k)
        kinds = np.maximum((m > 0).sum(axis=1), 1)[:, None]
        return np.log10((m + kinds * share) / (m.sum(axis=1)[:, None] + kinds))

    def emissions(self) -> np.ndarray:
        """log10 P(unit | class) of each unit in its class."""
        n = self.words.unit_counts.astype(np.float64)
        k = len(self.matrix)
        total = np.bincount(self.classes, n + 1, k)
        return np.log10((n + 1) / total[self.classes])

    def in_group(self) -> tuple[np.ndarray, np.ndarray]:
        """(-log10 of a group's tokens, log10 of the share's numerator of its unknown word)."""
        w = self.words
        some = w.group_tokens > 0
        return (np.where(some, -np.log10(np.maximum(w.group_tokens, 1)), 0.0),
                np.where(some, np.log10(np.maximum(w.discount * w.group_words, 1e-300)), 0.0))


def fit(train: DataFrame, text: str = "text", classes: int = 64, sweeps: int = 2, max_known: int = 1 << 18,
        max_units: int = 1 << 14, groups: int = 512) -> ClassModel:
    with arrow_rows(train.sparkSession, BATCH):
        words = count_words(train, text, max_known, max_units, groups)
        counts = words.unit_counts
        cls, matrix = exchange(neighbours(train, words, text), len(counts), classes, sweeps)
    # endings without a training word join the class that holds most tokens of the others
    ending = np.arange(len(counts)) > words.n_units
    rare = np.bincount(cls[ending], counts[ending], classes + 1)[1:classes]
    return ClassModel(words, np.where(cls == classes, 1 + rare.argmax(), cls), matrix)


def score(docs: DataFrame, model: ClassModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_tokens, n_known, base_score (add-one unigram), score (log10 P of the text) and
    perplexity of every row of ``docs``. Rows of equal key and text are scored once and repeated."""
    words = model.words
    spark = docs.sparkSession
    shared = _shared(words, spark)
    tables = spark.sparkContext.broadcast((model.classes, model.transitions(), model.emissions(),
                                           model.in_group()[0], words.counts))
    base_total = float(np.log10(words.tokens + words.distinct + 1))
    end_base = float(np.log10(words.texts + 1))
    n_units, discount = words.n_units, words.discount
    hash_of = F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`"))
    rows = docs.select(F.col(f"`{key}`").alias("key"), hash_of.alias("h"), F.col(f"`{text}`").alias("text"))
    names = ["key", "h", "heads", "n", "known", "base", "score", "word", "k"]
    spec = (f"key {docs.schema[key].dataType.simpleString()}, h long, heads int, n long, known long, base double, "
            "score double, word binary, k long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(*shared.value)
        cls, step, emit, group_log, counts = tables.value
        log_count = np.log10(counts + 1.0)
        # words at hand that belong to a group: their share of it
        own = np.where(np.arange(len(counts)) < n_units, 0.0, np.log10(np.maximum(counts - discount, 1e-300)))
        for batch in batches:
            size, last = len(batch), 0
            n, known, base, total = (np.zeros(size) for _ in range(4))
            hashes = batch.column("h").to_numpy()
            for got, owner, ends in _blocks(batch):
                place, unit, missing = look(got)
                stream, at = _stream(unit, ends), _stream(np.arange(len(got)) + 1, ends)
                if not len(stream):
                    continue
                who = np.empty(len(stream), np.int64)
                who[at > 0], who[at == 0] = owner, ends[:, 0]
                before = np.concatenate(([last], stream[:-1]))
                last = stream[-1]
                value = step[cls[before], cls[stream]] + emit[stream]
                grouped = stream > n_units
                value[grouped] += group_log[stream[grouped] - 1 - n_units]
                here = np.flatnonzero(place >= 0)
                n += np.bincount(who, minlength=size)
                known += np.bincount(owner[here], minlength=size)
                base += np.bincount(owner[here], log_count[place[here]], size) + end_base * np.bincount(ends[:, 0], minlength=size)
                total += np.bincount(who, value, size) + np.bincount(owner[here], own[place[here]], size)
                rest = Counter((int(owner[i]), got[i]) for i in missing)
                if rest:
                    i = np.array([o for o, _ in rest], np.int64)
                    none, zero = pa.array(np.zeros(len(i), np.int64)), pa.array(np.zeros(len(i)))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("key").take(pa.array(i)), pa.array(hashes[i]), none.cast(pa.int32()), none, none, zero, zero,
                         pa.array([w for _, w in rest], pa.binary()), pa.array(list(rest.values()), pa.int64())], names)
            zero = np.zeros(size, np.int64)
            # the row of the text itself: its word holds a space, so no word of a text equals it
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(hashes), pa.array(zero + 1, pa.int32()), pa.array(n.astype(np.int64)),
                 pa.array((known + (end_base > 0)).astype(np.int64)), pa.array(base - n * base_total), pa.array(total),
                 pa.array([b" " + h.tobytes() for h in hashes], pa.binary()), pa.array(zero)], names)

    found = rows.mapInArrow(run, spec)
    rare = words.table.where(F.col("n") < words.limit).select(F.col("word").alias("w"), F.col("n").alias("c"))
    unknown = F.get(F.array(*[F.lit(float(x)) for x in model.in_group()[1]]), _group_column(F.col("word"), words.groups))
    both = found.join(rare, F.col("word") == F.col("w"), "left")
    seen, k = F.col("c").isNotNull(), F.col("k")
    parts = both.select("key", "h", "heads", "n", (F.col("known") + F.when(seen, k).otherwise(0)).alias("known"),
                        (F.col("base") + k * F.log10(F.coalesce(F.col("c"), F.lit(0)) + 1.0)).alias("base"),
                        (F.col("score") + k * F.when(seen, F.log10(F.col("c") - discount)).otherwise(unknown)).alias("score"))
    per = parts.groupBy("key", "h").agg(*[F.sum(c).alias(c) for c in ("heads", "n", "known", "base", "score")])
    with arrow_rows(spark, BATCH):      # executed in here; a few numbers a text
        per = materialize(per, "lm-scores")
    one = per.select("key", F.explode(F.sequence(F.lit(1).cast("long"), F.col("heads"))).alias("_copy"),
                     (F.col("n") / F.col("heads")).cast("long").alias("n_tokens"),
                     (F.col("known") / F.col("heads")).cast("long").alias("n_known"),
                     (F.col("base") / F.col("heads")).alias("base_score"), (F.col("score") / F.col("heads")).alias("score"))
    return one.select(F.col("key").alias(key), "n_tokens", "n_known", "base_score", "score",
                      F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
