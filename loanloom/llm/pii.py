"""Personal data: fixed patterns as seeds, and contextual patterns learned from them that find identifiers of other forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.llm import spans
from loanloom.llm.common import materialized

KINDS = ["email", "ip", "card", "phone"]
# The contract's patterns, written so that no text makes them backtrack: possessive runs, a start only where a run begins
# or the last match ended, and lengths in the pattern where a match takes a whole run anyway.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Tokens that may be identifiers: with a digit or an at sign, and further groups of digits after blanks.
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?: [(]?[0-9][0-9().-]++)*+"
#: What a text must hold for a kind to be searched: most texts lack most of it.
GATES = {
    "email": lambda text: text.contains("@"),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]"),
    "card": lambda text: text.rlike(r"[0-9](?:[ -]?[0-9]){7}"),
    "phone": lambda text: text.contains("+"),
    "token": lambda text: text.rlike("[0-9@]"),
}
_EDGE = r"""^[\s"'(\[{<,;:|]+|[\s"')\]}>,;:.!?|]+$"""
#: Different seeds that a pattern must stand before, and confidence that a pattern's new identifiers need.
LEAST_SEEDS = 3
LEAST_CONFIDENCE = 0.6
ROUNDS = 3


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: Column, value: Column) -> Column:
    digits = _digits(value)
    n = F.length(digits)
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    small = F.forall(parts, lambda p: F.when(F.length(p) <= 3, F.coalesce(p.try_cast("int"), F.lit(0)) <= 255).otherwise(F.lit(False)))
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.coalesce(d.try_cast("int"), F.lit(0)) * F.when(i % 2 == 1, 2).otherwise(1),
    )
    luhn = F.aggregate(doubled, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0
    return (
        F.when(kind == "ip", small).when(kind == "card", n.between(16, 19) & luhn).when(kind == "phone", n.between(8, 15)).otherwise(F.lit(True))
    )


def _patterns(left: Column, right: Column) -> Column:
    """Contexts of a place: the two words before it, and the word before with the word after; digits are masked."""
    plain = lambda c: F.regexp_replace(F.lower(c), "[0-9]+", "0")
    before = F.filter(F.split(plain(left), r"[^\p{L}0]+"), lambda w: w != "")
    after = F.filter(F.split(plain(right), r"[^\p{L}0]+"), lambda w: w != "")
    last, next_ = F.try_element_at(before, F.lit(-1)), F.get(after, F.lit(0))
    both = F.filter(
        F.array(
            F.concat(F.lit("2 "), F.try_element_at(before, F.lit(-2)), F.lit(" "), last),
            F.concat(F.lit("1 "), last, F.lit(" _ "), next_),
        ),
        lambda p: p.isNotNull(),
    )
    return both


def _clear_of(rows: DataFrame, other: str) -> DataFrame:
    """Rows with ``other`` false that touch no row with ``other`` true of the same text; one pass in order of position."""
    at = Window.partitionBy("doc_id", "text_hash").orderBy("start", F.col(other).desc())
    before = F.max(F.when(F.col(other), F.col("end"))).over(at.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col(other), F.col("start"))).over(
        Window.partitionBy("doc_id", "text_hash").orderBy(F.desc("start")).rowsBetween(Window.unboundedPreceding, -1)
    )
    marked = rows.withColumn("_before", before).withColumn("_after", after)
    clear = (F.coalesce("_before", F.lit(-1)) <= F.col("start")) & (F.coalesce("_after", F.col("end")) >= F.col("end"))
    return marked.filter(~F.col(other) & clear).drop("_before", "_after")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, ``text_hash``, ``kind``, ``start``, ``end``, ``value``, ``base``, ``confidence`` of every identifier found.

    Base spans are the matches of the fixed patterns that pass their checks. They seed the rest: contexts around seeds are patterns;
    a pattern's confidence for a kind is the mean confidence of the different identifiers it stands at, an identifier's is 1 minus the product
    of its patterns' doubts; both are computed in turn over the graph of patterns and identifiers. A token with a digit or an at sign
    that no base span touches is added if a pattern with ``LEAST_SEEDS`` seeds gives it ``LEAST_CONFIDENCE`` for a kind whose shape it has (an at sign for
    emails, at least 4 digits otherwise). All steps are joins and aggregates on patterns and values, never on pairs of identifiers.
    Null and empty texts have no spans; rows that agree in id and text give theirs once; an empty table gives none.
    """
    raw = spans.matches(docs, BASE | {"token": CANDIDATE}, id_col, text_col, gates=GATES)
    token = F.col("kind") == "token"
    lead = F.length(F.regexp_extract("value", r"""^[\s"'(\[{<,;:|]+""", 0))
    trimmed = F.regexp_replace("value", _EDGE, "")
    rows = raw.filter(token | _valid(F.col("kind"), F.col("value"))).select(
        "doc_id", "text_hash", "kind", F.when(token, F.col("start") + lead).otherwise(F.col("start")).alias("start"),
        F.when(token, F.col("start") + lead + F.length(trimmed)).otherwise(F.col("end")).alias("end"),
        F.when(token, trimmed).otherwise(F.col("value")).alias("value"), _patterns(F.col("left"), F.col("right")).alias("patterns"), (~token).alias("base"),
    )
    rows = materialized(rows, "spans")
    base = rows.filter("base").select("doc_id", "text_hash", "kind", "start", "end", "value", "base", F.lit(1.0).alias("confidence"))
    unseen = materialized(_clear_of(rows, "base").filter(F.length("value") >= 4), "unseen")

    seeds = rows.filter("base").select("kind", "value", F.explode("patterns").alias("pattern")).distinct()
    known = seeds.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds")).filter(F.col("seeds") >= LEAST_SEEDS)
    sites = unseen.select("value", F.explode("patterns").alias("pattern")).distinct()
    others = sites.groupBy("pattern").agg(F.count(F.lit(1)).alias("unknown"))
    all_kinds = seeds.groupBy("pattern").agg(F.count(F.lit(1)).alias("all"))
    graph = known.join(all_kinds, "pattern").join(others, "pattern").select("pattern", "kind", "seeds", (F.col("all") + F.col("unknown")).alias("stands"))
    shaped = F.when(F.col("kind") == "email", F.col("value").contains("@")).otherwise(F.length(_digits(F.col("value"))) >= 4)
    edges = materialized(sites.join(graph, "pattern").filter(shaped), "edges")
    belief = materialized(edges.select("pattern", "kind", "value", (F.col("seeds") / F.col("stands")).alias("p")), "belief")
    for _ in range(rounds):
        doubt = F.exp(F.sum(F.log(F.greatest(1 - 0.95 * F.col("p"), F.lit(1e-9)))))
        instances = belief.groupBy("kind", "value").agg((1 - doubt).alias("confidence"))
        gained = edges.join(instances, ["kind", "value"]).groupBy("pattern", "kind").agg(F.sum("confidence").alias("gained"))
        belief = materialized(
            edges.join(gained, ["pattern", "kind"]).select("pattern", "kind", "value", F.least((F.col("seeds") + F.col("gained")) / F.col("stands"), F.lit(1.0)).alias("p")),
            "belief",
        )
    doubt = F.exp(F.sum(F.log(F.greatest(1 - 0.95 * F.col("p"), F.lit(1e-9)))))
    best = belief.groupBy("value", "kind").agg((1 - doubt).alias("confidence")).filter(F.col("confidence") >= LEAST_CONFIDENCE)
    best = best.groupBy("value").agg(F.max(F.struct("confidence", "kind")).alias("b")).select("value", "b.kind", "b.confidence")
    hit = belief.select("pattern", "value").distinct()
    learned = (
        unseen.drop("kind").join(best, "value").withColumn("pattern", F.explode("patterns")).join(hit, ["pattern", "value"], "left_semi")
        .select("doc_id", "text_hash", "kind", "start", "end", "value", F.lit(False).alias("base"), "confidence").distinct()
    )
    return base.unionByName(learned)


def report(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of base spans by kind, their digest and the list of all spans for each document."""
    return spans.per_document(docs, found, KINDS, True, id_col, text_col)
