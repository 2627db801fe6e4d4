"""URL filters: explicit host/path rules, then association rules over URL tokens.

Labelled URLs are turned into token sets; Spark's FP-growth mines token combinations
that go with the ``block`` label. Rules below the support (a share of the labelled pages, and a
number of pages) or confidence bound are dropped, and so is every rule that contains another one (it can match nothing more).
Matching uses an inverted index from each rule's rarest token: distinct token sets
are exploded, meet the index on that token, and the rule holds if its other tokens
are there too.

DataFrame and Spark ML only (no Python per row). URLs are first reduced to their
distinct token sets, so a host with a third of all pages is a few rows; rules are
broadcast only when counted small, else joined by shuffle.

Defined cases: null url or one without ``://`` has empty host, path and tokens (no
rule, allow); repeated rows get equal verdicts; with fewer labelled pages than a rule needs
there is no mined rule.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import LOWER, UPPER, packed, small_side
from revlens.session import materialize

#: explicit rules of the production query: (verdict, host/path prefix)
RULES: tuple[tuple[str, str], ...] = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"))
BLOCK = "label=block"
MIN_SUPPORT = 0.002
#: labelled pages that must carry a rule, however few there are
MIN_PAGES = 20
MIN_CONFIDENCE = 0.8


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def explicit_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest matching rule as struct(rule, verdict), or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at, _, rest = rule.partition("/")
        hit = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        found = F.when(hit, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
                       ).otherwise(found)
    return found


def tokens(url: Column) -> Column:
    """Token set of a URL: host labels and suffixes, path segments (numbers as one
    token), file ending, query keys and values, fragment, scheme."""
    u = F.coalesce(url, F.lit(""))
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    size = F.size(labels)
    def tagged(tag, arr):
        return F.transform(F.filter(arr, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))
    suffixes = F.transform(F.sequence(F.lit(1), size),
                           lambda i: F.array_join(F.slice(labels, i, size - i + 1), "."))
    shaped = F.regexp_replace(path, r"[0-9]+", "0")
    query = F.split(F.regexp_extract(u, r"\?([^#]*)", 1), "[&;]")
    every = F.concat(
        tagged("scheme=", F.array(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))),
        tagged("host=", suffixes), tagged("seg=", F.split(shaped, "/")),
        tagged("end=", F.array(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))),
        tagged("query=", F.transform(query, lambda q: F.regexp_replace(q, r"[0-9]+", "0"))),
        tagged("frag=", F.array(F.regexp_replace(F.regexp_extract(u, r"#(.*)$", 1), r"[0-9]+", "0"))))
    has = F.coalesce(F.contains(u, F.lit("://")), F.lit(False))
    return F.when(has, F.array_sort(F.array_distinct(every))).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, url: str = "url", bad: str = "bad", min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE, min_pages: int = MIN_PAGES) -> DataFrame:
    """Minimal block rules (rule_tokens, index_token, confidence, lift, support, pages): each stands on
    at least ``min_support`` of the labelled pages and on ``min_pages`` blocked ones."""
    rows = labelled.where(F.col(bad).isNotNull()).select(
        tokens(F.col(url)).alias("t"), F.col(bad).cast("boolean").alias("b"))
    rows = rows.where(F.size("t") > 0)
    sets = materialize(rows.select(F.when(F.col("b"), F.concat("t", F.array(F.lit(BLOCK)))).otherwise(F.col("t"))
                                   .alias("items")), "url-sets")
    n = max(sets.count(), 1)
    # a little below: whole numbers of pages decide, not a rounded share
    least = min(1.0, max(min_support, (min_pages - 0.5) / n))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(sets)
    rules = model.associationRules.where(
        (F.size("consequent") == 1) & (F.col("consequent")[0] == BLOCK) & (F.col("lift") > 1)) \
        .withColumn("pages", F.round(F.col("support") * n).cast("long")).where(F.col("pages") >= min_pages)
    once = sets.select(F.explode("items").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rules = materialize(rules.select(F.array_sort("antecedent").alias("rule_tokens"),
                                     "confidence", "lift", "support", "pages"), "url-rules")
    lead = (rules.select("rule_tokens", F.explode("rule_tokens").alias("token")).join(once, "token")
            .groupBy("rule_tokens").agg(F.min(F.struct("n", "token"))["token"].alias("index_token")))
    rules = materialize(rules.join(lead, "rule_tokens"), "url-rules")
    inner = rules.select(F.col("rule_tokens").alias("part"), F.col("index_token").alias("token"))
    wider = (rules.select("rule_tokens", F.explode("rule_tokens").alias("token")).join(inner, "token")
             .where((F.size("part") < F.size("rule_tokens"))
                    & (F.size(F.array_except("part", "rule_tokens")) == 0))
             .select("rule_tokens").distinct())
    return materialize(rules.join(wider, "rule_tokens", "left_anti"), "url-rules")


def matched(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``tokens`` of ``token_sets`` that hold a rule, with their best one."""
    index = rules.select(F.col("index_token").alias("token"), "rule_tokens", "confidence")
    hits = (token_sets.select("tokens", F.explode("tokens").alias("token")).join(small_side(index), "token")
            .where(F.size(F.array_except("rule_tokens", "tokens")) == 0))
    return hits.groupBy("tokens").agg(F.max("confidence").alias("confidence"))


def judge(urls: DataFrame, mined: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """(_row, host, path, rule, verdict, mined_confidence) of every row."""
    rows = packed(urls).withColumn("_u", F.col("_row")[url])
    rows = rows.select("_row", host_of(F.col("_u")).alias("host"), path_of(F.col("_u")).alias("path"),
                       tokens(F.col("_u")).alias("tokens"))
    bad = materialize(matched(rows.select("tokens").distinct(), mined), "url-hits")
    both = rows.join(bad, "tokens", "left")
    known = explicit_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return (both.withColumn("_k", known)
            .select("_row", "host", "path", F.col("_k.rule").alias("rule"),
                    F.coalesce(F.col("_k.verdict"), own).alias("verdict"),
                    F.col("confidence").alias("mined_confidence")))
