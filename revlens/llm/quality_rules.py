"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; its failure is one bit of ``failed`` and
its measurements stay beside it. A *policy* is a named, versioned set of rules (a
mask): keeping, rejecting and ablating are bit operations on the ledger and never
read a text again.

Built-in functions only: a document's windows are hashed, sorted as (hash,
position) inside its own row, so no word ever crosses the network and a hot
document, source or line cannot load one task.

Defined cases: null text has no word and every count 0 (fails ``few_words``);
repeated rows are judged one by one; ratios with a zero base don't fail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import let, packed, words

#: rule name -> SQL condition of failure over the measurements; the position is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 30 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 14 * n_words)",
    "shouting": "100 * n_upper > 30 * word_chars",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}

#: versioned policies: the rules that reject a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "shouting"),
    "v2": tuple(RULES),
}


POSITION_BITS = 21


def repeated_words(w: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in the array.

    Window hash and position are packed into one long (43 + 21 bits) and sorted as
    primitives; only windows whose upper bits meet a neighbour's are compared again
    by their full 64-bit hash. Longer arrays than 2^21 words compare every window."""
    mask = (1 << POSITION_BITS) - 1

    def window(h, i):
        return F.xxhash64(h[i], h[i + 1], h[i + 2])

    def starts(h):
        return F.sequence(F.lit(0), F.size(h) - 3)

    def near(s):
        # both positions of neighbours with equal upper bits, packed into one long
        pairs = F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.when(
            F.shiftrightunsigned(a.bitwiseXOR(b), POSITION_BITS) == 0,
            F.shiftleft(a.bitwiseAND(F.lit(mask)), POSITION_BITS).bitwiseOR(b.bitwiseAND(F.lit(mask)))))
        both = F.transform(F.array_compact(pairs), lambda x: F.array(
            F.shiftright(x, POSITION_BITS).cast("int"), x.bitwiseAND(F.lit(mask)).cast("int")))
        return F.array_distinct(F.flatten(both))

    def candidates(h):
        keys = F.transform(starts(h), lambda i: window(h, i).bitwiseAND(F.lit(~mask))
                           .bitwiseOR(i.cast("long")))
        return F.when(F.size(h) <= mask, let(F.sort_array(keys), near)).otherwise(starts(h))

    def twice(s):
        return F.sort_array(F.transform(
            F.filter(s, lambda e, j: ((j > 0) & (e["h"] == s[j - 1]["h"]))
                     | ((j < F.size(s) - 1) & (e["h"] == s[j + 1]["h"]))), lambda e: e["p"]))

    def covered(p):
        # a window adds the words up to the next repeated one, three at most
        return F.aggregate(p, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n")),
                           lambda s, x: F.struct(x.alias("last"),
                                                 (s["n"] + F.least(x - s["last"], F.lit(3))).alias("n")),
                           lambda s: s["n"])

    def count(h):
        full = let(candidates(h), lambda c: F.sort_array(F.transform(
            c, lambda i: F.struct(window(h, i).alias("h"), i.alias("p")))))
        return let(let(full, twice), covered)

    return F.when(F.size(w) >= 4, let(F.transform(w, lambda x: F.xxhash64(x)), count)
                  ).otherwise(F.lit(0).cast("bigint"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """(_row, measurements): one row per input row, the row itself kept in ``_row``."""
    base = packed(docs).withColumn("_t", F.coalesce(F.col("_row")[text], F.lit("")))
    t, w, lines = F.col("_t"), F.col("_w"), F.col("_l")
    return (base.withColumn("_w", words(t))
            .withColumn("_l", F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
            .select("_row",
                    F.size(w).cast("long").alias("n_words"),
                    F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                    F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                    F.size(lines).cast("long").alias("n_lines"),
                    (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                    repeated_words(w).alias("n_repeat_words"),
                    F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_upper")))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Measurements plus ``failed``, the bit mask of all failed rules."""
    mask = F.lit(0).cast("long")
    for name, rule in RULES.items():
        mask = mask.bitwiseOR(F.when(F.expr(rule), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    return measure(docs, text).withColumn("failed", mask)


def mask_of(policy: str | tuple[str, ...]) -> int:
    names = POLICIES[policy] if isinstance(policy, str) else policy
    return sum(BIT[n] for n in names)


def passes(policy: str | tuple[str, ...], failed: Column | None = None) -> Column:
    """True where no rule of the policy failed."""
    failed = F.col("failed") if failed is None else failed
    return failed.bitwiseAND(F.lit(mask_of(policy)).cast("long")) == 0


def ablation(ledger_rows: DataFrame, policy: str | tuple[str, ...] = "v2") -> DataFrame:
    """Per rule of the policy: documents failing it, failing nothing else (what
    dropping the rule would win back) and kept without it. The ledger is first
    reduced to counts per distinct mask (at most 2^rules rows)."""
    mask = mask_of(policy)
    names = POLICIES[policy] if isinstance(policy, str) else policy
    counts = (ledger_rows.select(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("m"))
              .groupBy("m").agg(F.count(F.lit(1)).alias("n")))
    rules = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(BIT[n]).cast("long").alias("bit"))
                                for n in names]))
    each = counts.select("m", "n", rules.alias("r")).select("m", "n", "r.rule", "r.bit")
    hit = F.col("m").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("m") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(F.col("m").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0, F.col("n"))
              .otherwise(0)).alias("n_kept_without"))
