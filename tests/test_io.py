import datetime

import pytest
from pyspark.sql import functions as F

from meterspan import fixed, schemas
from meterspan.operators import clean, features, quality, state, stats
from meterspan.sources import readers, sinks
from meterspan.sources import tables as t
from meterspan.session import ensure_checkpoint_dir, scratch_folder


def write(path, text):
    path.write_text(text)
    return str(path)


def test_raw_file(spark, tmp_path):
    head = ";".join(["Date", "Time", *fixed.MEASURES])
    path = write(tmp_path / "m.txt", head + "\n16/12/2006;17:24:00;4.2;0.4;234;18;0;1;17\n16/12/2006;17:25:00;?;?;?;?;?;?;\n")
    raw, is_raw = readers.readings_or_daily(spark, path, None, household_id=3)
    assert is_raw and raw.count() == 2
    typed = clean.typed_readings(raw).orderBy("reading_id").collect()
    assert typed[0].household_id == 3 and typed[0].Voltage == 234.0
    assert typed[1].Global_active_power is None


def test_processed_table_is_the_fallback(spark, tmp_path):
    head = ",".join(["datetime", *fixed.ROLLUP_COLUMNS])
    path = write(tmp_path / "d.csv", head + "\n2020-01-01,5,1,1,1,1,1,1\nbad,0,1,1,1,1,1,1\n")
    frame, is_raw = readers.readings_or_daily(spark, str(tmp_path / "absent.txt"), path)
    assert not is_raw
    assert clean.positive_days(frame).first().date == datetime.date(2020, 1, 1)
    with pytest.raises(FileNotFoundError):
        readers.readings_or_daily(spark)


def test_metric_table_names_are_trimmed(spark, tmp_path):
    path = write(tmp_path / "m.csv", "Model, MAE ,RMSE, R2,Training_Time \nA,1.5,2,0.5,x\n")
    row = readers.metric_table(spark, path).first()
    assert (row.Model, row.MAE, row.R2, row.Training_Time) == ("A", 1.5, 0.5, None)


def test_absent_table_is_empty(spark, tmp_path):
    frame = readers.optional_table(spark, str(tmp_path / "none.csv"), schemas.ANOMALIES)
    assert frame.count() == 0 and frame.columns == schemas.ANOMALIES.fieldNames()


def test_grouped_summary(spark, tmp_path):
    text = ",energy_kwh,energy_kwh,energy_kwh,energy_kwh,energy_kwh\n,count,mean,median,min,max\ncluster,,,,,\n0,754,32.3,30.7,12.1,67.1\n1,649,18.0,18.9,0.5,35.0\n"
    rows = readers.grouped_summary(spark, write(tmp_path / "s.csv", text)).collect()
    assert [(r.cluster, r["count"]) for r in rows] == [(0, 754), (1, 649)]


def test_forgiving_csv(spark, tmp_path):
    text = '"a ""x"", b",2\r\n\r\n  ,\r\nshort\r\n"two\nlines",3,extra\r\n'
    rows = readers.forgiving_csv(spark, write(tmp_path / "f.csv", text), ["a", "b"]).collect()
    assert [(r.a, r.b) for r in rows] == [('a "x", b', "2"), ("short", None), ("two\nlines", "3")]


def test_csv_round_trip_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in (1, 2):
        rows = [(n, 'say "hi", then\nleave')]
        sinks.write_csv(spark.createDataFrame(rows, "id int, text string"), path)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    assert [tuple(r) for r in back.collect()] == [("2", 'say "hi", then\nleave')]


def test_metrics_sink(spark, tmp_path):
    path = str(tmp_path / "metrics")
    sinks.write_metrics(spark.createDataFrame([(1.0, 0.5)], "RMSE double, R2 double"), path)
    got = {r.metric: r.value for r in spark.read.json(path).collect()}
    assert got == {"RMSE": 1.0, "R2": 0.5}


def test_columnar_sink_is_partitioned_by_year(spark, folder, tmp_path):
    path = str(tmp_path / "daily")
    daily = t.daily(spark, folder).withColumn("year", F.year("date"))
    sinks.write_columnar(daily, path)
    back = spark.read.parquet(path).filter("year = 1996")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert back.count() == daily.filter("year = 1996").count()
    assert readers.daily_table(spark, path).columns[0] == "household_id"


def test_profiles_sink(spark, tmp_path):
    path = str(tmp_path / "profiles")
    nested = spark.createDataFrame([(1,)], "household_id long").withColumn(
        "appliances", F.array(F.struct(F.lit("a").alias("id")))
    )
    sinks.write_profiles(nested, path)
    assert spark.read.json(path).first().appliances[0].id == "a"


def test_projection_and_filter_reach_the_scan(spark, folder):
    recent = t.table(spark, folder, "orders").filter("o_totalprice > 100000").select("o_custkey")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,100000.0)" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan


def test_checkpoint_folder(spark):
    ensure_checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir()
    assert folder
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == folder
    assert scratch_folder(spark, "x").startswith(folder)


def test_sorted_csv_and_feature_table(spark, folder, tmp_path):
    daily = t.daily(spark, folder)
    sinks.write_csv(daily.select("household_id", "date"), str(tmp_path / "sorted"), ["date", "household_id"])
    files = sorted((tmp_path / "sorted").glob("part-*"))
    dates = [line.split(",")[1] for f in files for line in f.read_text().splitlines()[1:]]
    assert dates == sorted(dates) and len(dates) == daily.count()
    table = features.complete_features(daily)
    table.write.parquet(str(tmp_path / "features"))
    back = readers.feature_table(spark, str(tmp_path / "features"))
    assert quality.set_difference(back, table.select(*back.columns)).count() == 0
    assert features.feature_contract(back).count() == 0


def test_cutoffs(spark):
    days = spark.createDataFrame([(1, datetime.date(2024, 1, d), 1.0) for d in (1, 2, 3)], "household_id long, date date, energy_kwh double")

    def kept(before):
        return stats.latest_records(days, 9, before=before).count()

    assert [kept(x) for x in ("2024-01-02", "2024-01-02 10:00", "2024-01-02T00:00:00+05:30", None)] == [1, 2, 1, 3]


def test_long_lists_are_split_into_parts(spark):
    homes = spark.createDataFrame([(1, 8.0), (2, 9.0)], "household_id long, tariff double")
    rows = [(1, i, f"a{i}") for i in range(50)] + [(2, 0, "b")]
    lists = spark.createDataFrame(rows, "household_id long, position int, id string")
    parts = state.export_profiles(homes, lists, lists.limit(0), homes, part_size=10).collect()
    found = {}
    for p in parts:
        found.setdefault(p.household_id, []).append([(a.position, a.id) for a in p.appliances or []])
    assert len(found[1]) > 1 and max(map(len, found[1])) < 25
    assert all(part == sorted(part) for part in found[1])
    assert sorted(sum(found[1], [])) == [(i, f"a{i}") for i in range(50)]
    assert found[2] == [[(0, "b")]]
