"""Physical-plan checks: what must hold for the plans to survive scale."""

import contextlib
import io

import pytest

from skyfold.plans.queries import queries

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
STREAMING = {"ingest_stream", "stream_upsert"}


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def operator_tree(p):
    """The operator tree of the current plan: without the per-node details,
    and only AQE's final plan once the DataFrame has been executed."""
    tree = p.split("\n\n")[0]
    return tree.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(set(queries()) - STREAMING))
def test_no_cross_or_python_in_plan(spark, name):
    p = plan(queries()[name](spark, SF))
    assert not [f for f in FORBIDDEN if f in p], p


def test_summary_plan_prunes_pushes_and_limits_before_shuffle(spark):
    p = plan(queries()["daily_airport_summary"](spark, SF))
    # filter pushed into the staging scan, only needed columns read
    assert "PushedFilters: [IsNotNull(carrier_role), EqualTo(carrier_role,operating)]" in p
    stg_schema = [ln for ln in p.splitlines() if ln.startswith("ReadSchema: struct<flight_id")][0]
    for unused in ("gate_dep", "baggage", "airline_name", "sched_arr", "aircraft_icao24"):
        assert unused not in stg_schema
    # de-duplication: partial top-1 per key before the exchange, final after
    assert p.count("WindowGroupLimit") >= 2
    # the KPI mart needs no dimension: no join at all, one shuffle for the
    # de-duplication and one for the roll-up
    tree = operator_tree(p)
    assert "Join" not in tree and tree.count("Exchange (") == 2


def test_enrichment_star_join_is_broadcast(spark):
    tree = operator_tree(plan(queries()["fct_flights"](spark, SF)))
    assert tree.count("BroadcastHashJoin LeftOuter") == 5 and "SortMergeJoin" not in tree


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """One key holds a third of the rows: the partial top-1 keeps at most one
    row per key and map task, so the shuffle carries ~distinct keys, not the
    hot key's rows (read from AQE's final plan statistics)."""
    import re

    from pyspark.sql import functions as F

    from skyfold.operators.dedupe import latest_per_key

    n = 30000
    df = spark.range(0, n, 1, 8).select(  # 8 map tasks, no extra shuffle
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("timestamp").alias("ts"),
    )
    out = latest_per_key(df, ["k"], "ts")
    assert out.count() == 1 + (n - n // 3)
    out.collect()
    p = plan(out)
    counts = [float(x) for x in re.findall(r"ShuffleQueryStage \(\d+\), Statistics\(sizeInBytes=[^,]+, rowCount=([0-9.E+]+)\)", p)]
    assert counts, p
    assert max(counts) <= (n - n // 3) + 8  # the 10,000 hot rows arrive as at most 8
