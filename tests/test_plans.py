"""Plan tests: properties of the executed (final adaptive) plans."""

from contrail.plans.queries import QUERIES
from contrail.sources.tables import trips
from tests.conftest import SF_SMALL


def final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()  # run this plan (no collection) so AQE finalises it
    plan = qe.executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def broadcast_subtrees(plan: str) -> list[str]:
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" not in line:
            continue
        depth = line.index("BroadcastExchange")
        sub = [line]
        for nxt in lines[i + 1:]:
            body = nxt.lstrip(" :|+-")
            if not body or len(nxt) - len(body) <= depth:
                break
            sub.append(nxt)
        out.append("\n".join(sub))
    return out


def test_fact_side_never_broadcast(spark):
    plan = final_plan(trips(spark, SF_SMALL))
    subs = broadcast_subtrees(plan)
    assert subs, "dimension sides should be broadcast at this size"
    assert any("customer" in s for s in subs) and any("supplier" in s for s in subs)
    assert not any("lineitem" in s for s in subs)
    assert "lineitem" in plan


def test_no_python_on_data_path(spark):
    for name in ("hhmm_to_minutes", "tolerant_int", "corr_matrix", "one_hot"):
        plan = final_plan(QUERIES[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_partial_aggregation_before_shuffle(spark):
    plan = final_plan(QUERIES["duplicate_count"](spark, SF_SMALL))
    assert "partial_count" in plan or "HashAggregate(keys=[yr" in plan
