from quarrysight.plans import bindings as B

SF = "/root/testdata/sf0.001"


def test_tasks_by_unit_grow_with_the_rows(spark, monkeypatch):
    for kpis, name in ((B.li_kpis, "lineitem"), (B.ev_kpis, "events")):
        rows = spark.read.parquet(f"{SF}/{name}.parquet").count()
        whole = sorted(map(str, kpis(spark, SF).collect()))
        with monkeypatch.context() as m:
            m.setattr(B, "TASK_ROWS", rows // 40)
            dealt = kpis(spark, SF)
            assert dealt.rdd.getNumPartitions() >= 40
            assert sorted(map(str, dealt.collect())) == whole
