"""Scale guards on every registered query's physical plan: no cartesian
product or nested-loop join (no cross joins), no Python evaluation in the
query path (built-in expressions only), and every Parquet scan prunes its
columns."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_plan_has_no_cross_join_or_python(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"
    # column pruning: no scan reads every column of lineitem (11) or orders (6)
    for schema in re.findall(r"ReadSchema: struct<([^>\n]*)", plan):
        fields = schema.count(":")
        if "l_partkey" in schema:
            assert fields < 11, f"{name}: full lineitem scan"
        if "o_custkey" in schema or "o_orderpriority" in schema:
            assert fields < 6, f"{name}: full orders scan"
