"""Quality rules with risk-controlled thresholds.

Only DataFrame functions. ``rule_signals`` turns texts into counts and ratios;
``certified_cutoffs`` learns, from labelled rows, how strict each rule may be;
``apply_rules`` gives every document its verdict.

A rule rejects a document whose ratio is above a cutoff (or, for ``low`` rules,
below). Each (stratum, rule) tries its cutoffs from the most lenient to the
strictest. A cutoff is certified when the exact binomial test rejects "it loses
at least a share ``risk`` of good documents": P(Bin(n, risk) <= k) <= delta',
with n the good labelled documents of the stratum and k those that it would
lose. The cutoffs of one chain are nested, so they are tested in a fixed order
and the chain stops at its first failure, which needs no correction; over
chains, ``delta`` is divided by their number (Bonferroni). ``risk`` is the rules' total share divided by their number: with
probability 1 - ``delta``, all certified rules together lose no more than
``total_risk`` of any stratum's good documents.
A chain with too few labels certifies nothing and rejects nothing.

Defined cases: a null text has no words, no lines; a blank or empty document
has base counts 0 and fails the base rule; a null language is a stratum of its
own; labels that are null, or without a document, teach nothing; contradicting
labels of one doc_id count as bad; rows that repeat a doc_id are judged each on
its own text; columns other than doc_id, text and the stratum are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaffer.llm.common import SPACES, stored

TOTAL_RISK = 0.03  # share of a stratum's good documents that all rules together may lose
DELTA = 0.05       # probability that any of the guarantees fails
SYMBOLS = "#*$%&|<>"

# rule -> candidate cutoffs, most lenient first; rules named "low_" reject below
CUTOFFS = {
    "symbol_ratio": (2.0, 1.5, 1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.15, 0.1, 0.06),
    "bang_ratio": (2.0, 1.5, 1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.1, 0.05),
    "repeat_ratio": (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1),
    "dup_line_ratio": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1),
    "upper_ratio": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15),
    "word_length": (30.0, 20.0, 15.0, 12.0, 11.0, 10.0, 9.0, 8.0),
    "low_word_length": (1.0, 1.5, 2.0, 2.5, 3.0, 3.5),
}


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more.

    Windows are compared by a 64-bit hash within one text. Sorting the hashes
    finds the repeated ones; only texts that have some sort (hash, position).
    """
    starts = F.sequence(F.lit(1), F.size(words) - 2)
    hashes = F.transform(starts, lambda i: F.xxhash64(
        F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)))
    return F.when(F.size(words) < 4, F.array().cast("array<bigint>")).otherwise(hashes)


def rule_signals(df: DataFrame, stratum: str | None = "lang") -> DataFrame:
    """doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and the ratios that the rules judge."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = df.select(F.col("doc_id").cast("long").alias("doc_id"),
                     (F.col(stratum).cast("string") if stratum else F.lit(None).cast("string")).alias("stratum"),
                     text.alias("text"))
    trimmed = F.btrim("text", F.lit(SPACES))
    rows = base.withColumns({
        "words": F.when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")),
        "lines": F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != ""),
        "letters": F.length(F.regexp_replace("text", r"[^\p{Lu}]", "")),
        "bangs": F.length("text") - F.length(F.replace("text", F.lit("!"), F.lit(""))),
        "n_symbols": F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")),
    })
    rows = rows.select(
        "doc_id", "stratum", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").alias("n_lines"), "letters", "bangs", _repeat_words(F.col("words")).alias("hashes"))
    rows = rows.withColumn("sorted", F.sort_array("hashes"))
    twice = F.size("sorted") > F.size(F.array_distinct("sorted"))
    pairs = F.when(twice, F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.withColumn("pairs", pairs).drop("hashes", "sorted")
    size = F.size("pairs")
    nothing = F.lit(None).cast("struct<h:bigint,i:int>")
    earlier = F.concat(F.array(nothing), F.slice("pairs", 1, F.greatest(size - 1, F.lit(0))))
    later = F.concat(F.slice("pairs", 2, F.greatest(size - 1, F.lit(0))), F.array(nothing))
    near = F.zip_with(F.arrays_zip(F.col("pairs").alias("p"), earlier.alias("e")), later,
                      lambda x, n: F.when((x["p"]["h"] == x["e"]["h"]) | (x["p"]["h"] == n["h"]), x["p"]["i"]))
    rows = rows.withColumn("at", F.when(F.col("pairs").isNotNull(), F.sort_array(F.array_compact(near)))).drop("pairs")
    # every repeated window covers three words; count the union of the covers
    gaps = F.zip_with("at", F.slice("at", 2, F.greatest(F.size("at"), F.lit(0))),
                      lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
    covered = F.when(F.col("at").isNull(), F.lit(0)).otherwise(F.aggregate(gaps, F.lit(0), lambda t, x: t + x))
    rows = rows.withColumn("n_repeat_words", covered.cast("long")).drop("at")
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return rows.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("n_symbols") / words).alias("symbol_ratio"), (F.col("bangs") / words).alias("bang_ratio"),
        (F.col("n_repeat_words") / words).alias("repeat_ratio"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("dup_line_ratio"),
        (F.col("letters") / chars).alias("upper_ratio"), (F.col("word_chars") / words).alias("word_length"),
        (F.col("word_chars") / words).alias("low_word_length"))


def fails_base() -> Column:
    """The fixed base rule: under 50 words, or over half of them repeated."""
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def _breaks(rule: str, value: Column, cutoff: Column) -> Column:
    return value < cutoff if rule.startswith("low_") else value > cutoff


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """Exact P(Bin(n, p) <= k), summed in logs so that large n does not underflow.

    The sum has k + 1 terms; it is only taken up to the mean n * p, above which
    the tail is over any level of interest and 1 is returned.
    """
    odds = F.lit(p / (1 - p))
    first = n * F.log(F.lit(1 - p))
    terms = F.aggregate(
        F.sequence(F.lit(0).cast("long"), F.greatest(k - 1, F.lit(0).cast("long"))),
        F.struct(first.alias("term"), first.alias("total")),
        lambda s, i: F.struct(
            (s["term"] + F.log((n - i) / (i + 1) * odds)).alias("term"),
            # log(exp(total) + exp(term)): the terms grow up to the mean
            (s["term"] + F.log((n - i) / (i + 1) * odds) + F.log1p(F.exp(
                s["total"] - s["term"] - F.log((n - i) / (i + 1) * odds)))).alias("total")))
    return F.when(k >= n * p, F.lit(1.0)).when(k == 0, F.exp(first)).otherwise(F.exp(terms["total"]))


def certified_cutoffs(signals: DataFrame, labels: DataFrame, total_risk: float = TOTAL_RISK,
                      delta: float = DELTA, cutoffs: dict | None = None) -> DataFrame:
    """stratum, rule, cutoff (the strictest certified), n_good, n_lost."""
    cutoffs = cutoffs or CUTOFFS
    risk = total_risk / len(cutoffs)
    good = labels.where("quality is not null").groupBy(F.col("doc_id").cast("long").alias("good_id")) \
        .agg(F.min("quality").alias("quality")).where("quality = 1")
    # documents that fail the base rule go anyway; the rules answer for the rest
    held = signals.where(~fails_base()).join(good, F.col("doc_id") == F.col("good_id"), "left_semi")
    lost = [F.struct(F.lit(rule).alias("rule"), F.lit(step).alias("step"), F.lit(float(c)).alias("cutoff"),
                     F.sum(_breaks(rule, F.col(rule), F.lit(float(c))).cast("long")).alias("n_lost"))
            for rule, chain in cutoffs.items() for step, c in enumerate(chain)]
    counts = held.groupBy("stratum").agg(F.count("*").alias("n_good"), F.array(*lost).alias("tests"))
    chains = F.count("*").over(Window.partitionBy()) * len(cutoffs)
    tests = counts.withColumn("chains", chains).select("stratum", "n_good", "chains", F.inline("tests"))
    tests = tests.withColumn("p_value", binomial_tail(F.col("n_lost"), F.col("n_good"), risk))
    order = Window.partitionBy("stratum", "rule").orderBy("step")
    tests = tests.withColumn("stopped", F.max(F.col("p_value") > F.lit(delta) / F.col("chains")).over(order))
    return tests.where(~F.col("stopped")).groupBy("stratum", "rule").agg(
        F.max_by(F.struct("cutoff", "n_good", "n_lost"), "step").alias("t")).select("stratum", "rule", "t.*")


def apply_rules(signals: DataFrame, cutoffs: DataFrame, rules=None) -> DataFrame:
    """The signals with base_failed, broken (certified rules that the document
    breaks) and kept. The cutoffs have at most one row per stratum."""
    rules = rules or list(CUTOFFS)
    one = cutoffs.groupBy(F.col("stratum").alias("s")).agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in rules])
    rows = signals.join(one, F.col("stratum").eqNullSafe(F.col("s")), "left")
    broken = F.array_compact(F.array(*[
        F.when(_breaks(r, F.col(r), F.col(f"cut_{r}")), F.lit(r)) for r in rules]))
    return rows.withColumn("base_failed", fails_base()).withColumn("broken", broken) \
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0)) \
        .drop("s", *[f"cut_{r}" for r in rules])


def judge(documents: DataFrame, labels: DataFrame, stratum: str | None = "lang", total_risk: float = TOTAL_RISK,
          delta: float = DELTA) -> DataFrame:
    """Signals, certified cutoffs and verdicts for whole tables. The signals are
    stored once, as the cutoffs and the verdicts both read them."""
    signals = stored(rule_signals(documents, stratum), "rule-signals")
    cutoffs = stored(certified_cutoffs(signals, labels, total_risk, delta), "rule-cutoffs")
    return apply_rules(signals, cutoffs)
