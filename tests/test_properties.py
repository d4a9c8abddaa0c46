"""Cross-table properties of the model."""

import pytest
from pyspark.sql import functions as F

from skyfold.plans import incremental
from skyfold.plans.flights import FlightModel

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    return FlightModel.from_tables(spark, SF)


def test_fact_smaller_than_staging_and_unique(model):  # T6
    n_fact, n_stg = model.fact.count(), model.stg.count()
    assert 0 < n_fact < n_stg
    assert model.fact.select("flight_id").distinct().count() == n_fact


def test_same_operating_flight_same_id(model):  # T7
    g = (
        model.stg.where("carrier_role = 'operating'")
        .groupBy("flight_date", "operating_flight_iata", "direction")
        .agg(F.countDistinct("flight_id").alias("ids"))
    )
    assert g.where("ids > 1").count() == 0


def test_one_open_version_per_key(spark, model):  # T8
    state = incremental.run(model.stg, "2024-01-30 23:59:59")
    cur = state.dim_airlines.where("dbt_valid_to IS NULL")
    assert cur.groupBy("airline_iata").count().where("count > 1").count() == 0


def test_scheduled_not_after_actual_is_reported(model):  # T9 as a row rule
    from skyfold.operators.quality import expression_holds, run_checks

    chk = expression_holds("dep_not_before_sched", "actual_dep >= sched_dep", row_condition="actual_dep IS NOT NULL")
    out = run_checks(model.fact, "fct_flights", [chk]).first()
    early = model.fact.where("actual_dep < sched_dep").count()
    assert out.failing_rows == early


def test_marketing_only_carriers_in_airline_mart(model):  # T10
    marketing = model.stg.where("carrier_role = 'marketing'").select("airline_iata").distinct()
    missing = marketing.join(model.daily_airline_summary.select("airline_iata"), "airline_iata", "left_anti")
    assert marketing.count() > 0 and missing.count() == 0


def test_rerun_is_idempotent(spark, model):  # T11
    s1 = incremental.run(model.stg, "2024-01-30 23:59:59")
    s2 = incremental.run(model.stg, "2024-01-30 23:59:59", previous=s1)
    a, b = s1.fct_flights, s2.fct_flights
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    for name, x in s1.marts.items():
        y = s2.marts[name]
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name
    # collapsed keys (D15): operating rows without a flight number share one id per day and direction
    collapsed = model.stg.where("carrier_role = 'operating' AND operating_flight_iata IS NULL")
    assert collapsed.select("flight_id").distinct().count() <= collapsed.count()
