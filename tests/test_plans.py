"""What the physical plans must and must not contain."""

import re

import pytest

from loanloom.plans.catalog import registered
from loanloom.sources.views import view

SF = "/root/testdata/sf0.001"
LAZY = [n for n in registered() if re.match(r"(a|d|f|j|p|r|u|w)\d", n) and not n.startswith(("a29_subset_search",))]


def plan(spark, name):
    return registered()[name].build(spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops(spark, no_broadcast, name):
    text = plan(spark, name)
    assert "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize(
    "name, table, columns",
    [
        ("w2_normalised_curve", "lineitem", {"l_orderkey", "l_extendedprice", "l_shipdate"}),
        ("w2_normalised_curve", "orders", {"o_orderkey", "o_orderstatus", "o_orderdate"}),
        ("a16_classification_report", "lineitem", {"l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"}),
        ("r5_transaction_flags", "events", {"event_id", "ts", "user_id", "event_type"}),
        ("a7_value_counts", "orders", {"o_orderkey", "o_custkey", "o_orderstatus"}),
    ],
)
def test_scans_read_only_what_is_used(spark, name, table, columns):
    schemas = re.findall(rf"{table}\.parquet\].*?ReadSchema: struct<([^>]*)>", plan(spark, name))
    assert schemas
    for s in schemas:
        assert {c.split(":")[0] for c in s.split(",")} <= columns


def test_outer_joins_with_needed_partners_become_inner(spark, no_broadcast):
    """The curve drops rows without a loan age, so the join may be split on hot loans."""
    assert "RightOuter" not in plan(spark, "d7_product_repayment_report")


def test_ranking_shares_its_first_shuffle(spark, monkeypatch):
    from loanloom.operators import evaluation, ordered

    monkeypatch.setattr(ordered, "VALUES_PER_RANGE", 200)
    for df in (ordered.ranked_values(view(spark, SF, "scored"), "p"), evaluation.roc_auc(view(spark, SF, "scored"))):
        df.collect()
        assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_sample_limits_before_the_shuffle(spark):
    text = plan(spark, "l4_sample_by_status")
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
