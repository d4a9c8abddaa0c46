"""Tasks of the landing steps do not grow with the source, and a query lands only the tables that it reads."""

import datetime as dt
import os
import re
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from skyfold.plans import reports
from skyfold.plans.flights import FlightModel, land_staging, landed_path
from skyfold.plans.incremental import FlightStore, run
from skyfold.session import ensure_parallelism, fine_scans
from skyfold.sources.fixtures import raw_flights_from_events, raw_json_text_from_events


def rows_by_partition(df):
    return [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]


def test_one_row_group_in_many_splits_is_dealt_out(spark, tmp_dir):
    path = f"{tmp_dir}/t.parquet"
    pq.write_table(pa.table({"n": range(4000)}), path, row_group_size=4000)
    conf = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() >= 4 and rows_by_partition(df) == [4000]
        dealt = ensure_parallelism(df, 4, rows=500)
        assert max(rows_by_partition(dealt)) <= 600 and sorted(r.n for r in dealt.collect()) == list(range(4000))
        many = ensure_parallelism(df, 4)
        assert max(rows_by_partition(many)) <= 1100
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rows_of_a_task_do_not_grow(spark):
    small, large = (rows_by_partition(ensure_parallelism(spark.range(0, n, 1, 4), 4, rows=1000)) for n in (4_000, 40_000))
    assert max(small) <= 1000 and max(large) <= 1300 and sum(large) == 40_000
    even = spark.range(0, 4000, 1, 4)
    assert ensure_parallelism(even, 4, rows=1000) is even
    assert ensure_parallelism(spark.range(0), 4).count() == 0


def test_audit_lands_the_raw_table_only(spark, tmp_dir):
    shutil.copy("/root/testdata/sf0.001/events.parquet", f"{tmp_dir}/events.parquet")
    model = FlightModel.from_tables(spark, tmp_dir)
    assert reports.load_audit(model.raw).agg(F.sum("record_count")).first()[0] == spark.read.parquet(f"{tmp_dir}/events.parquet").count()
    landed = landed_path(spark, tmp_dir)
    assert sorted(os.listdir(landed)) == ["raw"]
    assert model.stg.count() == model.raw.count()
    assert sorted(os.listdir(landed)) == ["raw", "stg"]
    assert model.airlines.count() > 0 and "dim_airlines_current" in os.listdir(landed)


def write_events(path, n):
    day = dt.datetime(2024, 1, 5, 10)
    rows = {
        "event_id": list(range(n)), "ts": [day + dt.timedelta(minutes=i % 600) for i in range(n)], "user_id": [i % 7 for i in range(n)],
        "event_type": ["purchase"] * n, "value": [float(i % 30) for i in range(n)], "props": ['{"k": %d}' % (i % 9) for i in range(n)],
    }
    pq.write_table(pa.table(rows), path)


def test_records_are_rendered_by_code_that_the_jvm_compiles(spark, tmp_dir, capsys):
    write_events(f"{tmp_dir}/e.parquet", 40)
    events = spark.read.parquet(f"{tmp_dir}/e.parquet")
    for df in (raw_json_text_from_events(events), raw_flights_from_events(events)):
        df.explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) <= 8000  # longer methods are interpreted (-XX:+DontCompileHugeMethods)
    by_id = [r.json_text for r in raw_json_text_from_events(events.where("event_id in (0, 1, 6)").orderBy("event_id")).collect()]
    assert '"codeshared":null' in by_id[0] and "codeshared" not in by_id[1] and '"codeshared":{"airline_iata"' in by_id[2]


def test_scans_of_landed_tables_are_dealt_out(spark, tmp_dir):
    write_events(f"{tmp_dir}/e.parquet", 400)
    files = 16 * spark.sparkContext.defaultParallelism
    raw_flights_from_events(spark.read.parquet(f"{tmp_dir}/e.parquet")).repartition(files).write.parquet(f"{tmp_dir}/raw")
    held = len([f for f in os.listdir(f"{tmp_dir}/raw") if f.endswith(".parquet")])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    land_staging(spark, tmp_dir)
    assert len([f for f in os.listdir(f"{tmp_dir}/stg") if f.endswith(".parquet")]) >= held // 2
    assert spark.read.parquet(f"{tmp_dir}/stg").count() == 400
    with fine_scans(spark):
        assert spark.read.parquet(f"{tmp_dir}/raw").rdd.getNumPartitions() >= held // 2
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before

    store, seen = FlightStore(spark, f"{tmp_dir}/store"), []
    store.append_staging(spark.read.parquet(f"{tmp_dir}/stg"), 1)
    read = store.read_staging
    store.read_staging = lambda: seen.append(spark.conf.get("spark.sql.files.maxPartitionBytes")) or read()
    run(None, "2024-02-01 00:00:00", store=store)
    assert seen == ["8388608b"] and spark.conf.get("spark.sql.files.maxPartitionBytes") == before
