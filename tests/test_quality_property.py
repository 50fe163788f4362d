"""Generic checks count failures the way the declared tests do, on random
columns: NULL rows; non-NULL values occurring more than once; key
combinations occurring more than once (NULL is a value); distinct non-NULL
values outside the list; rows failing the bound (NULL passes)."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerframe.operators import quality as Q

vals = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "x"])),
                          st.one_of(st.none(), st.integers(-3, 3))), max_size=12)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals)
def test_generic_check_counts(spark, rows):
    df = spark.createDataFrame(rows, "k string, n int")
    declared = [Q.Check("not_null", "t", ("k",)), Q.Check("unique", "t", ("k",)),
                Q.Check("unique_combination", "t", ("k", "n")),
                Q.Check("accepted_values", "t", ("k",), ("a", "b")),
                Q.Check("accepted_range", "t", ("n",), min_value=0, inclusive=False)]
    got = {r.check_name: r.failures for r in Q.batched_checks({"t": df}, declared=declared).collect()}
    ks = [k for k, _ in rows]
    assert got["not_null"] == sum(k is None for k in ks)
    assert got["unique"] == sum(1 for k, c in Counter(k for k in ks if k is not None).items() if c > 1)
    assert got["unique_combination_of_columns"] == sum(1 for c in Counter(rows).values() if c > 1)
    assert got["accepted_values"] == len({k for k in ks if k is not None and k not in ("a", "b")})
    assert got["accepted_range"] == sum(1 for _, n in rows if n is not None and not n > 0)
