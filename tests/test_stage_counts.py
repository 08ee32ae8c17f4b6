"""The one-pass stage counts equal those of the tables themselves."""

from quarrysight.operators import clean as CL
from quarrysight.operators import quality as QU
from quarrysight.plans import dashboard as DB
from tests.fixtures import as_of_col, bronze_df, sensor_cases


def test_counts_of_one_pass(spark):
    raw = bronze_df(spark, sensor_cases() + sensor_cases()[:3])
    silver, quarantine = CL.silver_readings(raw), CL.quarantine_records(raw, as_of_col())
    want = QU.conversion_metrics(raw, silver, quarantine).first()
    counts = CL.stage_counts(raw)
    assert QU.with_rates(counts).first() == want
    assert sorted(map(tuple, DB.funnel_of(counts).collect())) == sorted(map(tuple, DB.funnel(raw, silver, quarantine).collect()))
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Union" not in plan
    assert tuple(QU.with_rates(CL.stage_counts(raw.limit(0))).first()) == (0, 0, 0, 0, 0.0, 0.0)
