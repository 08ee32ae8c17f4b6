"""Property tests (hypothesis): score ranges, rescued data, dedup."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quarrysight.functions import scores as S
from quarrysight.sources.rescue import rescue_json

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
num = st.one_of(st.none(), st.floats(min_value=-1000, max_value=1000, allow_nan=False))


@settings(**SETTINGS)
@given(st.lists(st.tuples(num, num, num, num), min_size=1, max_size=20))
def test_clamped_scores_stay_in_range(spark, rows):
    df = spark.createDataFrame(rows, "oil double, hyd double, vib double, tmp double")
    out = df.select(
        S.pressure_score("oil", "hyd").alias("p"),
        S.vibration_score("vib").alias("v"),
        S.temperature_score("tmp", "oil").alias("t"),
    ).collect()
    for r in out:
        assert 0.0 <= r.p <= 100.0
        assert r.t >= 0.0
        assert r.v in (10.0, 30.0, 60.0, 90.0) or r.v >= 65.0


keys = st.sampled_from(["a", "x", "extra", "other"])
vals = st.one_of(st.integers(-5, 5), st.text(alphabet="abc", max_size=3), st.none())


@settings(**SETTINGS)
@given(st.lists(st.dictionaries(keys, vals, max_size=4), min_size=1, max_size=8))
def test_rescued_fields_are_exactly_the_misfits(spark, docs):
    schema = StructType([StructField("a", StringType()), StructField("x", DoubleType())])
    lines = [json.dumps(d) for d in docs]
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, value string")
    got = {r.i: r for r in rescue_json(df, schema).collect()}
    for i, d in enumerate(docs):
        want = {}
        for k, v in d.items():
            if v is None:
                continue
            if k not in ("a", "x"):
                want[k] = str(v)
            elif k == "x" and isinstance(v, str):
                want[k] = v
        res = got[i]._rescued_data
        assert (json.loads(res) if res else {}) == want
        if "x" in d and isinstance(d["x"], int):
            assert got[i].x == float(d["x"])


def test_kpis_are_bit_identical_across_partitionings(spark):
    import random
    from pyspark.sql import functions as F
    from quarrysight.operators import kpis as KP

    rnd = random.Random(7)
    rows = [(f"U{rnd.randrange(5)}", "conveyor", f"2024-01-01 {rnd.randrange(3):02d}:{rnd.randrange(60):02d}:00",
             rnd.choice(["running", "idle", "stopped"]), rnd.uniform(0, 8) / 3, rnd.uniform(0, 400) / 7,
             rnd.random() < 0.2, rnd.choice([1.0, 0.7, 0.4]))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "equipment_id string, equipment_type string, ts string, operating_status string, "
                                     "belt_speed_mps double, motor_current_amps double, is_anomaly boolean, "
                                     "quality_score double") \
        .withColumns({"reading_timestamp": F.col("ts").cast("timestamp"), "site_location": F.lit("S")})
    from quarrysight.config import KpiMeasure
    measures = (KpiMeasure("avg_belt", "avg", "belt_speed_mps"), KpiMeasure("sum_current", "sum", "motor_current_amps"))
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, seed in ((1, 1), (8, 2), (5, 3)):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            shuffled = df.orderBy(F.rand(seed)).repartition(parts + 2)
            k = KP.hourly_kpis(shuffled, measures, derived={})
            results.append(sorted(map(tuple, k.drop("kpi_hour", "kpi_date").collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]
