"""Checks of every kind on small tables; the flight suite against the list of
data tests."""

import contextlib
import io
from collections import Counter

from pyspark.sql import functions as F

from skyfold.operators import quality as q
from skyfold.plans.checks import flight_suite
from skyfold.plans.oracle import quality_checks


def failing(out):
    return {r.check_name: r.failing_rows for r in out.collect()}


def test_key_checks_over_one_scan(spark):
    rows = [(1, "a", 1), (1, "a", 1), (2, "b", 1), (None, "b", 2), (None, None, 2), (3, None, 2), (3, None, 3)]
    df = spark.createDataFrame(rows, "k long, v string, w int")
    checks = [q.unique("k"), q.unique("v"), q.unique("w"), q.unique_combination("k", "v"), q.unique_combination("v", "w")]
    out = q.run_checks(df, "t", checks)
    assert failing(out) == {"unique__k": 2, "unique__v": 2, "unique__w": 2, "unique_combination__k__v": 2, "unique_combination__v__w": 2}
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    plan = buf.getvalue().split("== Initial Plan ==")[0]
    assert plan.count("Expand") == 1 and plan.count("Scan ExistingRDD") == 1
    assert failing(q.run_checks(df.limit(0), "t", checks)) == dict.fromkeys(failing(out), 0)


def test_unique_combination_counts_null_parts_as_values(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, 1), (None, 1), (None, None), (None, None)], "a int, b int")
    assert failing(q.run_checks(df, "t", [q.unique_combination("a", "b"), q.unique("a")])) == {"unique_combination__a__b": 3, "unique__a": 1}


def test_functional_dependency(spark):
    rows = [(1, "x", "p"), (1, "x", "p"), (1, "y", "p"), (1, "y", "q"), (2, None, None), (2, None, None), (3, "z", None), (3, "z", "r"), (None, "n", "a"), (None, "n", "b")]
    df = spark.createDataFrame(rows, "k int, f string, v string")
    out = failing(q.run_checks(df, "t", [q.functional_dependency(("k", "f"), "v"), q.functional_dependency(("k",), "f", row_condition="k = 1")]))
    assert out == {"functional_dependency__k__f__v": 3, "functional_dependency__k__f": 1}


def test_a_hot_group_shrinks_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 8).select((F.col("id") % 3 == 0).alias("k"), (F.col("id") % 2).alias("v"))
    out = q.run_checks(df, "t", [q.functional_dependency(("k",), "v")])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    assert "partial_min" in buf.getvalue() and failing(out) == {"functional_dependency__k__v": 2}


def test_one_open_version(spark):
    rows = [("a", None), ("a", "2024"), ("b", None), ("b", None), ("c", "2024"), ("d", None)]
    df = spark.createDataFrame(rows, "k string, dbt_valid_to string")
    assert failing(q.run_checks(df, "t", [q.one_open_version("k")])) == {"one_open_version__k__dbt_valid_to": 2}


def test_cross_table_checks(spark):
    df = spark.createDataFrame([("a", "m"), ("b", "m"), ("b", "m"), ("c", "o"), (None, "m")], "k string, role string")
    other = spark.createDataFrame([("a",), (None,)], "name string")
    checks = [q.referenced_in(("k",), "o", ("name",), row_condition="role = 'm'"), q.fewer_rows("o"), q.fewer_rows("big")]
    frames = {"o": other, "big": spark.range(6)}
    assert failing(q.run_checks(df, "t", checks, frames)) == {"referenced_in__k__o": 1, "fewer_rows__o": 4, "fewer_rows__big": 0}


def test_flight_suite_has_every_data_test():
    """115 not_null tests less the three percentages that may be NULL (D18),
    13 accepted_values, 14 ranges, 5 unique columns and the two snapshot ids,
    2 combinations; and the design's cross-table checks."""
    checks = [(t, c) for t, cs in flight_suite().tables.items() for c in cs]
    assert Counter(c.kind for _, c in checks) == {
        "not_null": 112, "accepted_values": 13, "between": 14, "unique": 7, "unique_combination": 2,
        "functional_dependency": 1, "one_open_version": 2, "referenced_in": 1, "fewer_rows": 1, "expression": 2,
    }
    assert {(t, c.name) for t, c in checks} == set(quality_checks())
