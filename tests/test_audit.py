"""Every registered query's final plan is free of the operators that do not
scale: Cartesian products, nested-loop joins, row-at-a-time Python."""

import pytest

from helpers import SF001
from tools.plan_audit import audit

from vetline.plans.catalog import QUERIES

# windows over bounded groups that are not fed by a group limit (README, Audit)
BOUNDED_WINDOWS = {"channel_ranking", "channel_table", "backfill_scan", "backfill_scan_default",
                   "backfill_counts", "disposition_funnel"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_unscalable_operators(spark, name):
    df = QUERIES[name](spark, SF001)
    df.write.format("noop").mode("overwrite").save()
    a = audit(df._jdf.queryExecution().executedPlan().toString())
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in a, (name, a)
    if name != "scorer_hook":
        assert "MapInPandas" not in a, (name, a)
    if name not in BOUNDED_WINDOWS:
        assert a["windows"] == a["windows_on_group_limit"], (name, a)
