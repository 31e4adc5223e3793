"""Quality rules whose cutoffs come from labelled documents under a risk guarantee.

Built-in functions only. Each (stratum, rule, cutoff) is a test: the exact
binomial tail must show that the rule rejects at most its share of good
documents. The level is divided by the number of tests, so with confidence
1 - delta no chosen cutoff exceeds its share in any stratum.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.common import BLANKS, fresh, let, save

#: Rules: (numerator, denominator, direction); the ratio, in thousandths, beyond the cutoff rejects.
RULES: Mapping[str, tuple[str, str, int]] = {
    "symbols": ("n_symbols", "word_chars", 1),
    "repeated_words": ("n_repeat_words", "n_words", 1),
    "repeated_lines": ("n_dup_lines", "n_lines", 1),
    "long_words": ("word_chars", "n_words", 1),
    "short_words": ("word_chars", "n_words", -1),
}
#: Cutoffs tried for each rule, in thousandths, fixed before any label is seen.
CUTOFFS: Mapping[str, Sequence[int]] = {
    "symbols": (10, 20, 40, 80, 160, 320),
    "repeated_words": (50, 100, 200, 300, 400),
    "repeated_lines": (50, 100, 200, 300, 500),
    "long_words": (8_000, 10_000, 12_000, 15_000, 20_000),
    "short_words": (2_000, 2_500, 3_000, 3_500),
}
#: Share of good documents that all rules together may reject, and the chance that any bound fails.
RISK, DELTA = 0.02, 0.05
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def with_features(df: DataFrame, text: str = "text", base_failed: str = "base_failed") -> DataFrame:
    """The frame with the six counts and the base verdict added.

    ``n_lines`` counts lines with a word. Repeated windows of three words are
    found by sorting (hash, place) pairs inside the row, so a text of n words
    costs n log n. A null text has no words. Texts are taken whole.
    """
    body, words, lines, windows, places = fresh(df, "body", "words", "lines", "windows", "places")
    out = df.withColumn(body, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    trimmed = F.btrim(F.col(body), F.lit(BLANKS))
    out = out.withColumn(words, let(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"[ \t-\r]+"))))
    has_word = lambda line: F.btrim(line, F.lit(BLANKS)) != ""
    out = out.withColumn(lines, F.filter(F.split(body, "\n"), has_word))
    spans = let(F.col(words), lambda w: F.when(F.size(w) >= 3, F.sort_array(F.transform(
        F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.struct(F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)).alias("h"), i.alias("i"))
    ))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    out = out.withColumn(windows, spans)
    found = let(F.col(windows), lambda s: F.transform(
        F.filter(F.transform(s, lambda x, j: F.struct(
            x["i"].alias("i"), F.coalesce((x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]), _lone(x, s, j)).alias("twice")
        )), lambda x: x["twice"]), lambda x: x["i"]))
    out = out.withColumn(places, F.sort_array(found))
    covered = let(F.col(places), lambda p: F.aggregate(
        F.transform(p, lambda at, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - at, F.lit(3)))), F.lit(0).cast("long"), lambda a, n: a + n))
    chars = F.length(F.translate(body, BLANKS, ""))
    counts = {
        "n_words": F.size(words).cast("long"),
        "word_chars": chars.cast("long"),
        "n_symbols": (F.length(body) - F.length(F.translate(body, "#*$%&|<>", ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": covered,
        "n_lines": F.size(lines).cast("long"),
    }
    out = out.select(*[F.col(f"`{c}`") for c in df.columns if c not in counts and c != base_failed], *[v.alias(k) for k, v in counts.items()])
    return out.withColumn(base_failed, (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))


def _lone(x: Column, s: Column, j: Column) -> Column:
    """At an end of the array one neighbour is missing; the other decides."""
    return F.coalesce(x["h"] == F.get(s, j - 1)["h"], x["h"] == F.get(s, j + 1)["h"], F.lit(False))


def violates(rule: str, cutoff: Column) -> Column:
    """True where the ratio of the rule lies beyond the cutoff, in whole numbers; false without a cutoff."""
    top, bottom, way = RULES[rule]
    gap = F.col(top) * 1000 - cutoff * F.col(bottom)
    return F.coalesce(gap * way > 0, F.lit(False))


def log_binomial_tail(k: Column, n: Column, p: float) -> Column:
    """ln P(X <= k) for X ~ Binomial(n, p), summed exactly in logs from the recurrence of its terms."""
    odds = math.log(p) - math.log1p(-p)
    first = n.cast("double") * math.log1p(-p)

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1).cast("double")) - F.log(i.cast("double")) + odds
        high, low = F.greatest(acc["total"], term), F.least(acc["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, F.struct(first.alias("term"), first.alias("total")), step)["total"]


def choose_cutoffs(features: DataFrame, labels: DataFrame, key: str, stratum: str, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum: ``stratum`` and a map from rule to its cutoff, for rules that passed.

    Labelled documents that pass the base checks are the holdout; quality 1 is
    good. Where one key has several labels, one good label makes it good; null
    labels are ignored. Of the cutoffs that pass the test, the one that rejects
    the most bad minus good documents is taken, of equal ones the mildest; a
    rule that gains nothing is not used. Strata without enough labels get none.
    """
    truth = labels.filter(F.col("quality").isNotNull()).groupBy(F.col(key)).agg(F.max("quality").alias("_quality"))
    held = features.filter(~F.col("base_failed")).join(truth, key)
    tests = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(c).cast("long").alias("cutoff"), violates(rule, F.lit(c).cast("long")).alias("hit"))
        for rule, cutoffs in CUTOFFS.items() for c in cutoffs
    ])
    rows = held.select(F.coalesce(F.col(f"`{stratum}`"), F.lit("")).alias("stratum"), (F.col("_quality") == 1).alias("good"), F.explode(tests).alias("t"))
    counts = save(rows.groupBy("stratum", "t.rule", "t.cutoff").agg(
        F.count_if("good").alias("n"), F.count_if(F.col("good") & F.col("t.hit")).alias("k"),
        F.count_if(~F.col("good") & F.col("t.hit")).alias("caught"),
    ), "quality-tests")
    level = math.log(delta) - F.log(F.greatest(F.lit(counts.count()), F.lit(1)).cast("double"))  # Bonferroni
    share = risk / len(RULES)
    # At or above the mean the tail is near one half or more, which no level of interest reaches.
    passed = counts.filter((F.col("k") < F.col("n") * share) & (F.col("caught") > F.col("k")))
    passed = passed.withColumn("tail", log_binomial_tail(F.col("k"), F.col("n"), share)).filter(F.col("tail") <= level)
    mild = F.when(F.col("rule").isin([r for r, v in RULES.items() if v[2] < 0]), -F.col("cutoff")).otherwise(F.col("cutoff"))
    best = passed.groupBy("stratum", "rule").agg(F.max_by("cutoff", F.struct(F.col("caught") - F.col("k"), mild)).alias("cutoff"))
    return best.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))


def with_verdict(features: DataFrame, cutoffs: DataFrame, stratum: str, kept: str = "kept") -> DataFrame:
    """The frame with ``kept``: false if the base checks or a cutoff of the stratum reject the document."""
    at, name = fresh(features, "cutoffs", "stratum")
    cutoffs = cutoffs.select(F.col("stratum").alias(name), F.col("cutoffs").alias(at))
    joined = features.join(cutoffs, F.coalesce(F.col(f"`{stratum}`"), F.lit("")) == F.col(name), "left")
    # One array rather than a chain of conditions: a filter on those would be split and pushed
    # below the join, and there each mention of a count would compute it anew.
    broken = F.array(F.col("base_failed"), *[violates(rule, F.col(at)[rule]) for rule in RULES])
    return joined.withColumn(kept, ~F.array_contains(broken, True)).drop(at, name)


def calibrate(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Features of all documents without their texts, and the cutoffs, both as saved tables.

    Strata join by value, null as the empty one. Empty tables give no cutoffs.
    """
    narrow = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{stratum}`").alias(stratum), F.col(f"`{text}`").alias(text))
    features = save(with_features(narrow, text).drop(text), "quality-features")
    return features, save(choose_cutoffs(features, labels, key, stratum), "quality-cutoffs")


def reject_low_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """The documents that pass, with the columns they came with.

    The texts are judged where they lie; only narrow features are joined with
    the labels. Repeated rows are judged alike.
    """
    _, cutoffs = calibrate(docs, labels, key, text, stratum)
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(docs.columns)])
    at = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    judged = with_verdict(with_features(renamed, at[text]), cutoffs, at[stratum]).filter("kept")
    return judged.select(*[F.col(v).alias(k) for k, v in at.items()])
