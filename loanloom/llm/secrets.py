"""Secrets: fixed patterns, and weak parts of credentials that count only beside their complements."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loanloom.llm import spans
from loanloom.llm.common import materialized

KINDS = ["assign", "access", "hex"]
WEAK = ["key_id", "weak_secret", "endpoint"]
BASE = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]{14,}",
    "hex": "[0-9a-f]{16,}",
}
# What is too weak to report alone. Lengths have no upper bound; possessive runs keep the search linear.
PARTS = {
    "key_id": r"""(?i:access_?key(?:_?id)?|client_?id|user(?:name)?|login|account(?:_?(?:id|name))?)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9@._-]{3,}+)""",
    "weak_secret": r"""(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])[A-Za-z0-9+/_-]{20,}+""",
    "endpoint": r"""(?<![A-Za-z0-9])(?:[a-z][a-z0-9+]{1,11}://[^\s"'<>]{3,}+|(?i:host|endpoint|server|url)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9.-]{3,}+)""",
}
_NAMED = lambda text: text.contains(":") | text.contains("=")
#: What a text must hold for a kind to be searched.
GATES = {
    "assign": _NAMED, "access": lambda text: text.contains("AKIA"), "key_id": _NAMED, "endpoint": _NAMED,
    "weak_secret": lambda text: text.rlike("[0-9]"),
}
#: Characters within which parts belong together.
SCOPE = 400
_SHORT = "short"


def find(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``kind``, ``start``, ``end``, ``value``, ``base``, ``partner`` of every secret found.

    Base spans are the matches of the fixed patterns that pass their lengths. Weak parts are named account ids (``key_id``), tokens of mixed
    letters and digits and assignments too short for a base span (``weak_secret``), and addresses (``endpoint``). A weak secret is reported if an
    identifier (``access``, ``key_id``) starts within ``scope`` characters of its start, a weak identifier if a secret
    (``assign``, ``hex``, ``weak_secret``) does, an address if both do; ``partner`` is the start of one such part.

    The interval join goes by text and bin of ``scope`` characters: each bin's first and last starts by role are all that a neighbour
    needs, so a text full of parts makes three rows for each part, not pairs.
    Null and empty texts have no spans; rows that agree in id and text give theirs once; an empty table gives none.
    """
    raw = spans.matches(docs, BASE | PARTS, id_col, text_col, {"assign": 1}, GATES)
    short = (F.col("kind") == "assign") & (F.length("part") < 12)
    rows = materialized(
        raw.select("doc_id", "text_hash", "start", "end", "value", F.col("kind").isin(KINDS).alias("base"), F.when(short, _SHORT).otherwise(F.col("kind")).alias("kind"))
        .withColumn("base", F.col("base") & (F.col("kind") != _SHORT)).withColumn("kind", F.when(F.col("kind") == _SHORT, "weak_secret").otherwise(F.col("kind"))),
        "parts",
    )
    base = rows.filter("base")
    role = (
        F.when(F.col("kind").isin("access", "key_id"), "id").when(F.col("kind").isin("assign", "hex", "weak_secret"), "secret").otherwise("endpoint")
    )
    binned = rows.withColumn("role", role).withColumn("bin", F.floor(F.col("start") / scope))
    bins = binned.filter("role <> 'endpoint'").groupBy("doc_id", "text_hash", "role", "bin").agg(F.min("start").alias("low"), F.max("start").alias("high"))
    around = bins.withColumn("bin", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)))
    near = around.select(F.col("doc_id").alias("i"), F.col("text_hash").alias("h"), F.col("bin").alias("b"), F.col("role").alias("with"), "low", "high")
    weak = binned.filter("not base").select("doc_id", "text_hash", "kind", "start", "end", "value", "role", "bin")
    at = F.col("start")
    partner = F.when(F.abs(F.col("low") - at) <= scope, F.col("low")).when(F.abs(F.col("high") - at) <= scope, F.col("high"))
    met = (
        weak.join(near, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("h")) & (F.col("bin") == F.col("b")) & (F.col("role") != F.col("with")))
        .withColumn("partner", partner).filter("partner is not null")
        .groupBy("doc_id", "text_hash", "kind", "start", "end", "value", "role").agg(F.countDistinct("with").alias("roles"), F.min("partner").alias("partner"))
        .filter("role <> 'endpoint' or roles = 2").drop("role", "roles")
    )
    return base.select("doc_id", "text_hash", "kind", "start", "end", "value", "base", F.lit(None).cast("long").alias("partner")).unionByName(
        met.withColumn("base", F.lit(False))
    )


def report(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of base spans by kind, their digest and the list of all spans for each document."""
    return spans.per_document(docs, found, KINDS, False, id_col, text_col)
