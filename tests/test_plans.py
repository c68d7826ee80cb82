"""Plan lint: no registered query plans a cross product, and no window runs
without a partition key except over the small bucket tables of the prefix
sums."""

import re

import __spark_entry__ as entry

from .conftest import SF001

# Queries that run jobs while they are built (checkpoints, file round trips,
# streams) are linted too; they are just slower to plan.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def test_no_cross_products_and_bounded_windows(spark):
    global_windows = []
    for name, q in entry.queries().items():
        if name.startswith("op") or name == "pipeline":
            continue               # linted where their subpackage is tested
        plan = q(spark, SF001)._jdf.queryExecution().executedPlan().toString()
        for op in FORBIDDEN:
            assert op not in plan, (name, op)
        # a Window node prints "[exprs], [partition keys], [order]"; a window
        # without partition keys prints only "[exprs], [order]".  Such a
        # window must read super-bucket totals (_pm_sb), never article rows.
        for line in plan.splitlines():
            if "Window [" not in line:
                continue
            tail = re.split(r"AS _we\d+#\d+L?\]", line)[-1]
            if "], [" not in tail:
                assert "_pm_sb" in tail, (name, line.strip()[:200])
                global_windows.append(name)
    assert global_windows, "the lint found no unpartitioned window to check"
