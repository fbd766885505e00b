from __future__ import annotations

from claimscale.operators import matrix as X
from claimscale.plans import compare
from conftest import plan_of


def test_pivot_scale_and_order(spark):
    rows = spark.createDataFrame(
        [("a", "p", 1.0), ("a", "p", 3.0), ("b", "p", 4.0), ("c", "q", 7.0), ("a", "q", 7.0)],
        "organisation string, policy string, esg double",
    )
    wide = X.pivot_mean(rows, "organisation", "policy", "esg", ["p", "q"])
    got = {r[0]: tuple(r)[1:] for r in wide.collect()}
    assert got == {"a": (2.0, 7.0), "b": (4.0, None), "c": (None, 7.0)}
    scaled = {r[0]: tuple(r)[1:] for r in X.min_max_scale(wide, ["p", "q"]).collect()}
    # a constant column becomes 0, an empty cell stays empty
    assert scaled == {"a": (0.0, 0.0), "b": (1.0, None), "c": (None, 0.0)}
    ordered = [r[0] for r in X.order_by_row_total(wide, ["p", "q"], "organisation").collect()]
    assert ordered == ["a", "c", "b"]


def test_scaling_uses_no_window_and_no_cross_join(spark):
    rows = spark.createDataFrame([("a", 1.0, 2.0)], "organisation string, p double, q double")
    plan = plan_of(X.min_max_scale(rows, ["p", "q"]))
    assert "Window" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_walk_the_talk_ignores_case(spark):
    walk = spark.createDataFrame(
        [("Alpha Corp", 0, "ethics", 90.0), ("beta corp", 0, "ethics", 10.0), ("x", 0, "ethics", 1.0)],
        "organisation string, topic_id int, policy string, score double",
    )
    talk = spark.createDataFrame(
        [("alpha corp", 0, 20.0), ("Beta Corp", 0, 40.0)],
        "organisation string, topic_id int, score double",
    )
    got = [tuple(r) for r in compare.walk_the_talk(walk, talk).collect()]
    assert got == [
        ("alpha corp", 0, "ethics", 90.0, 20.0),
        ("beta corp", 0, "ethics", 10.0, 40.0),
    ]
