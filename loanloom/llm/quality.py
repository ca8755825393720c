"""Quality rules whose cutoffs are set on labelled documents, so that each stratum loses few good documents. DataFrame functions only.

Every rule compares a share with a cutoff from a fixed grid. In each stratum, a cutoff may be used if the exact binomial test rejects, at the level
``error`` divided by the number of rules and strata, that the rule at this cutoff takes more than its part of ``risk`` of the good documents. A
stricter cutoff takes all that a looser one takes, so the grid is a fixed sequence of nested tests that needs no correction of its own. With
probability 1 - ``error``, then, no stratum loses more than ``risk`` of its good documents to all rules together.

Cases: a null text is empty; a null stratum is one of its own; a stratum with few labels, or none, gets no cutoff and keeps what the base rules
keep; null labels are not read; a document labelled twice is good if any label says so. Equal texts count as one draw, good if any copy is labelled good, or the
test would take copies for independent draws. Other columns are not read and cannot clash. Very long texts are arrays within one row; nothing is quadratic in them.
"""

from __future__ import annotations

from dataclasses import dataclass

import math

from pyspark.sql import Column, DataFrame, functions as F

from loanloom.llm.common import materialized

# White space of the contracts, and their symbols.
BLANKS = r"[\x20\x09-\x0D]+"
SOLID = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Fewer words than this, or more than so many per cent of words in repeated windows, fail before any learned cutoff.
LEAST_WORDS, MOST_REPEATED = 50, 50
WINDOW = 3


@dataclass(frozen=True)
class Rule:
    """Rejects where 1000 * part > cutoff * whole; cutoffs from the loosest to the strictest."""

    name: str
    part: str
    whole: str
    cutoffs: tuple[int, ...]

    def rejects(self, cutoff: Column | int) -> Column:
        return 1000 * F.col(self.part) > cutoff * F.col(self.whole)


RULES = (
    Rule("symbols", "n_symbols", "word_chars", (500, 300, 200, 150, 100, 80, 60, 50, 40, 30, 20)),
    Rule("capitals", "n_capitals", "word_chars", (900, 800, 700, 600, 500, 400, 300, 250, 200, 150)),
    Rule("equal_lines", "n_dup_lines", "n_lines", (900, 800, 700, 600, 500, 400, 300, 250, 200)),
    Rule("repeated_words", "n_repeat_words", "n_words", (450, 400, 350, 300, 250, 200, 150, 100)),
    Rule("long_words", "word_chars", "n_words", (30000, 20000, 15000, 12000, 10000, 9000, 8000)),
)
MEASURES = ["n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _covered(hashes: Column) -> Column:
    """Positions within ``WINDOW`` of the start of a window whose hash occurs twice."""

    def repeated(ordered: Column) -> Column:
        equal = F.filter(ordered, lambda e, j: (e["h"] == F.get(ordered, j - 1)["h"]) | (e["h"] == F.get(ordered, j + 1)["h"]))
        return F.sort_array(F.transform(equal, lambda e: e["i"]))

    def length(places: Column) -> Column:
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"))
        return F.aggregate(places, start, step, lambda a: a["n"])

    paired = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _let(paired, lambda ordered: length(repeated(ordered)))


def _repeats(words: Column) -> Column:
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
    any_twice = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(F.lit(0).cast("long"))
    return F.when(F.size(words) > WINDOW, _let(windows, any_twice)).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs``, text_hash and the ``MEASURES`` of each whole text."""
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    words = F.array_remove(F.split("_text", BLANKS), "")
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(SOLID))
    of_words = lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("word_chars"),
        _repeats(w).alias("n_repeat_words"),
    )
    of_lines = lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    counts = [F.regexp_count("_text", F.lit(p)).cast("long").alias(c) for c, p in (("n_symbols", SYMBOLS), ("n_capitals", r"\p{Lu}"))]
    nested = rows.select(*keep, F.xxhash64("_text").alias("text_hash"), _let(words, of_words).alias("_w"), _let(lines, of_lines).alias("_l"), *counts)
    return nested.select(*keep, "text_hash", "_w.*", "_l.*", "n_symbols", "n_capitals").select(*keep, "text_hash", *MEASURES)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def log_binomial_cdf(n: Column, x: Column, p: float) -> Column:
    """ln P(X <= x) of a binomial with ``n`` draws and chance ``p``, for x below its mean: the largest term times the sum of its ratios to the others."""
    n, x = n.cast("double"), x.cast("long")
    down = lambda a, k: F.struct(
        (a["log"] + F.log((n - x + k) / k)).alias("log"),
        (a["ratio"] * (x - k + 1) / (n - x + k) * ((1 - p) / p)).alias("ratio"),
        (a["total"] + a["ratio"]).alias("total"),
    )
    start = F.struct(F.lit(0.0).alias("log"), F.lit(1.0).alias("ratio"), F.lit(0.0).alias("total"))
    steps = F.when(x > 0, F.sequence(F.lit(1).cast("long"), x)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, start, down, lambda a: a["log"] + F.log(a["total"] + a["ratio"])) + x * math.log(p) + (n - x) * math.log1p(-p)


def cutoffs(labelled: DataFrame, rules: tuple[Rule, ...] = RULES, risk: float = 0.05, error: float = 0.05) -> DataFrame:
    """stratum, rule, good (documents the test saw), cutoff, lost (of the good ones): the strictest usable cutoff of each rule and stratum that has any.

    ``labelled`` has stratum, text_hash, quality (0 or 1) and the measures; the labelled rows are the holdout, nothing else is fitted on them.
    """
    texts = labelled.filter(F.col("quality").isNotNull() & ~base_failed()).groupBy("stratum", "text_hash", *MEASURES).agg(F.max("quality").alias("quality"))
    grid = [(r, c) for r in rules for c in r.cutoffs]
    counted = texts.filter("quality = 1").groupBy("stratum").agg(F.count("*").alias("good"), *(F.sum(r.rejects(c).cast("long")).alias(f"{r.name}_{c}") for r, c in grid))
    tests = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(c).cast("long").alias("cutoff"), F.col(f"{r.name}_{c}").alias("lost")) for r, c in grid))
    level = F.log(F.lit(error) / (len(rules) * F.col("strata")))
    part = risk / len(rules)
    strata = counted.agg(F.count("*").alias("strata"))
    tried = counted.crossJoin(F.broadcast(strata)).select("stratum", "good", "strata", F.explode(tests).alias("t")).select("stratum", "good", "strata", "t.*")
    usable = tried.filter(F.col("lost") < F.col("good") * part).filter(log_binomial_cdf(F.col("good"), F.col("lost"), part) <= level)
    return usable.groupBy("stratum", "rule", "good").agg(F.min("cutoff").alias("cutoff"), F.max("lost").alias("lost"))


def judged(measures: DataFrame, chosen: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measures`` with base_failed, rejected_by (names of the rules, in order, joined by commas) and kept."""
    by_stratum = chosen.groupBy(F.col("stratum").alias("_of")).agg(*(F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"_{r.name}") for r in rules))
    rows = measures.join(by_stratum, F.col("stratum").eqNullSafe(F.col("_of")), "left")
    named = F.concat_ws(",", *(F.when(r.rejects(F.col(f"_{r.name}")), F.lit(r.name)) for r in rules))
    rows = rows.withColumn("base_failed", base_failed()).withColumn("rejected_by", named)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("rejected_by") == "")).drop("_of", *(f"_{r.name}" for r in rules))


def filtered(docs: DataFrame, labels: DataFrame, stratum: str, usable: Column, risk: float = 0.05, error: float = 0.05) -> DataFrame:
    """One row for each document: doc_id, stratum, measures, base_failed, rejected_by, kept. Labels count where ``usable`` (of doc_id) holds."""
    measures = materialized(measured(docs.select("doc_id", F.col(stratum).alias("stratum"), "text"), ["doc_id", "stratum"]), "measures")
    marks = labels.filter(F.col("quality").isNotNull() & usable).groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("quality"))
    labelled = measures.join(marks, F.col("doc_id") == F.col("_id"))
    return judged(measures, cutoffs(labelled, risk=risk, error=error))
