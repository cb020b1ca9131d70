"""Plan-shape checks on the lazy plans of all queries."""

import re

import pytest

from indicast.plans import stages as S
from indicast.plans.queries import QUERIES

from support import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_product(spark, name, monkeypatch):
    # Stage tables stay lazy here, so that the plan shows the whole query.
    monkeypatch.setattr(S, "materialize", lambda df: df)
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans a {op}"


@pytest.mark.parametrize("name,conditions", [
    ("p9_trend_extract", ["IN (MDG,GHA,IND,BRA,FRA)"]),
    ("p11_filtered_table", ["South Asia", ">= 2001", "<= 2003"]),
])
def test_predicates_run_below_the_dedup(spark, name, conditions):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    assert plan.count("ExistingRDD") == plan.count("ExistingRDD[ISO3#")  # only the country dimension: nothing is materialised
    last = max(m.start() for m in re.finditer("partial_min", plan))
    below = plan[last:]
    for c in conditions:
        assert c in below or c.replace("IN (", "INSET ") in below, f"{c} is not below the de-dup of {name}:\n{plan}"


def test_filters_reach_the_scans(spark):
    plan = plan_of(S.harmonized(spark, SF_SMALL))
    assert "partial_min" in plan
    assert "INSET ARG" in plan  # country whitelist evaluated on the supplier side


def test_qa_summary_scans_the_input_once(spark):
    plan = plan_of(QUERIES["a3_qa_summary_raw"](spark, SF_SMALL))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "l_orderkey" in line]
    assert len(scans) == 1, plan


def test_registry_has_no_join(spark):
    from indicast.operators import metadata as M
    plan = plan_of(M.registry(spark))
    for op in FORBIDDEN:
        assert op not in plan
    assert M.registry(spark).count() == 1


def test_forest_sampling_limits_before_shuffle(spark):
    from indicast.operators import anomaly as A
    h = S.harmonized(spark, SF_SMALL, materialized=True)
    plan = plan_of(A.fit_forest(A.build_features(h)))
    assert "WindowGroupLimit" in plan and "Partial" in plan
