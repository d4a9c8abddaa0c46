"""The fact bucketed by flight: merges without a shuffle of the target."""

from pyspark.sql import functions as F

from skyfold.operators import diff
from skyfold.plans import incremental
from skyfold.plans.flights import FCT_COLUMNS, FlightModel
from skyfold.session import scratch_path
from test_plans import plan

SF = "/root/testdata/sf0.001"


def above_scan(tree, table):
    """Operators between the join and the scan of ``table`` in a plan tree."""
    lines = tree.splitlines()
    at = next(i for i, ln in enumerate(lines) if f"Scan parquet spark_catalog.default.{table}" in ln)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    out = []
    for ln in reversed(lines[:at]):
        here = len(ln) - len(ln.lstrip(" :+-"))
        if here < depth:
            out.append(ln)
            depth = here
            if "Join" in ln:
                break
    return out


def test_second_run_does_not_shuffle_the_target(spark):
    stg = FlightModel.from_tables(spark, SF).stg
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    root, plain_root = scratch_path(spark, "bucketed"), scratch_path(spark, "plain")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    states = {}
    for name, options in ((root, {"buckets": buckets}), (plain_root, {})):
        for number, (batch, as_of) in enumerate(((stg.where(F.col("extracted_at") < cut), "2024-01-19 23:59:59"), (stg, "2024-01-30 23:59:59")), 1):
            store = incremental.FlightStore(spark, name, **options)
            if number == 2 and options:
                before = store.load()
                table = store.bucketed_fact(1)
                rows = incremental.fact_rows(incremental.SnapshotModel(stg, before.dim_airlines, before.dim_airports), before.fact_mark)
                merge = incremental.merge_fact_window(before.fct_flights, rows, before.fact_mark)
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
                tree = plan(merge).split("\n\n")[0].split("== Initial Plan ==")[0]
                spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
                path = above_scan(tree, table)
                assert "Join" in path[-1] and not [ln for ln in path if "Exchange" in ln], tree
                filters = [ln for ln in plan(merge).splitlines() if "PartitionFilters" in ln]
                assert any("flight_date" in ln and "[]" not in ln for ln in filters)
            states[name] = incremental.run(batch, as_of, store=store)
    assert states[root].fct_flights.columns == FCT_COLUMNS
    assert diff.diff_tables(states[root].fct_flights, states[plain_root].fct_flights, ["flight_id"], ["flight_date"]).count() == 0
    # another session knows the folder only
    spark.sql(f"DROP TABLE {store.bucketed_fact(1)}" if store.buckets else f"DROP TABLE {incremental.FlightStore(spark, root, buckets=buckets).bucketed_fact(1)}")
    again = incremental.FlightStore(spark, root, buckets=buckets).load().fct_flights
    assert again.count() == states[plain_root].fct_flights.count() > 0
