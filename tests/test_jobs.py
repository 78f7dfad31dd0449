"""Stored runs from files to monitored predictions, and the invariants of each layer."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from delayworks.operators import validate
from delayworks.plans import fixtures as fx
from delayworks.plans import jobs
from delayworks.sources import readers, sinks

HEADER = ("Year,Month,Day_of_Month,OP_UNIQUE_CARRIER,OP_CARRIER_FL_NUM,ORIGIN,DEST,TAIL_NUM,CRS_DEP_TIME,CRS_ARR_TIME,"
          "DEP_TIME_BLK,ARR_TIME_BLK,DEP_DELAY_NEW,ARR_DELAY_NEW,CANCELLED,DIVERTED,CANCELLATION_CODE,ACTUAL_ELAPSED_TIME,DISTANCE").upper()
STATIONS = ("JFK INTERNATIONAL AIRPORT, NY US", "LAGUARDIA AIRPORT, NY US", "NEWARK LIBERTY INTERNATIONAL AIRPORT, NJ US")
AIRPORTS = ("JFK", "LGA", "EWR", "BOS", "ORD")


def flight(rng, day):
    origin, dest = rng.sample(AIRPORTS, 2)
    h, late = rng.randrange(24), rng.choice((0.0, 0.0, 5.0, 30.0, 75.0, 200.0))
    block = lambda x: "0001-0559" if x < 6 else f"{x:02d}00-{x:02d}59"
    gone = rng.random() < 0.03
    return ",".join(map(str, (
        day.year, day.month, day.day, rng.choice(("AA", "DL")), rng.randrange(1, 9000), origin, dest, f" n{rng.randrange(50)} ",
        h * 100 + rng.randrange(60), ((h + 2) % 24) * 100, block(h), block((h + 2) % 24),
        "" if gone else late, "" if gone else late + 1.5, f"{int(gone)}.00", "0.00", "b" if gone else "", 140.0, "760.00")))


@pytest.fixture(scope="module")
def lake(tmp_path_factory, spark):
    """Three months of flight files (November is missing), weather by station, all layers stored."""
    base = tmp_path_factory.mktemp("lake")
    rng = random.Random(7)
    (base / "flights").mkdir()
    days = [dt.date(2024, 10, 1) + dt.timedelta(days=i) for i in range(31)]
    days += [dt.date(2024, 12, 1) + dt.timedelta(days=i) for i in range(62)]
    by_month = {}
    for day in days:
        rows = [flight(rng, day) for _ in range(40)]
        by_month.setdefault((day.year, day.month), []).extend(rows + rows[:2])
    for (y, m), rows in by_month.items():
        (base / "flights" / readers.month_file(y, m)).write_text("\n".join([HEADER, *rows]) + "\n")
    for i, name in enumerate(STATIONS):
        folder = base / "weather" / str(i)
        folder.mkdir(parents=True)
        lines = ["DATE,NAME,WND,CIG,VIS,TMP,DEW,SLP,REM"]
        for day in [dt.date(2024, 9, 30) + dt.timedelta(days=k) for k in range(140)]:
            for hour in range(24):
                lines.append(f'{day}T{hour:02d}:00:00,"{name}","{(hour * 10) % 360:03d},1,N,00{hour:02d},1","02000,1,M,N",'
                             f'"016093,1,N,1","+01{hour:02d},1","+00{hour:02d},1","10130,1",x')
        (folder / "obs.csv").write_text("\n".join(lines) + "\n")
    p = {n: str(base / n) for n in ("flights", "weather", "bronze", "silver", "gold", "wb", "ws", "combined",
                                    "daily_bronze", "daily_silver", "daily_gold", "daily_combined", "preds", "metrics")}
    jobs.run_bronze_flights(spark, p["flights"], p["bronze"], (2024, 10), (2025, 1))
    jobs.run_silver_flights(spark, p["bronze"], p["silver"])
    jobs.run_gold_flights(spark, p["silver"], p["gold"])
    jobs.run_bronze_weather(spark, p["weather"], p["wb"])
    jobs.run_silver_weather(spark, p["wb"], p["ws"])
    jobs.run_gold_combined(spark, p["gold"], p["ws"], p["combined"])
    return p


def test_bronze_holds_metro_flights_of_the_files_that_exist(spark, lake):
    bronze = spark.read.parquet(lake["bronze"])
    assert {r.year_month for r in bronze.select("year_month").distinct().collect()} == {"2024-10", "2024-12", "2025-01"}
    assert {r.source_file for r in bronze.select("source_file").distinct().collect()} == {
        "T_ONTIME_REPORTING-10_24.csv", "T_ONTIME_REPORTING-12_24.csv", "T_ONTIME_REPORTING-01_25.csv"}
    report = {r.check_name: r.status for r in validate.validate_bronze(bronze, 1000, 10_000, "2024-10-01", "2025-01-31", strict=True).collect()}
    assert "fail" not in report.values()


def test_missing_files_are_an_error(spark, lake):
    with pytest.raises(FileNotFoundError):
        readers.read_months(spark, lake["flights"], (2024, 11), (2024, 11), {})
    with pytest.raises(FileNotFoundError):
        readers.read_day(spark, lake["flights"], dt.date(2024, 11, 5), {})


def test_header_that_disagrees_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], {"x": "int"}).collect()


def test_silver_is_clean_and_typed(spark, lake):
    silver, bronze = spark.read.parquet(lake["silver"]), spark.read.parquet(lake["bronze"])
    assert silver.count() < bronze.count()
    validate.validate_silver(silver, strict=True)
    assert dict(silver.dtypes)["CANCELLED"] == "int" and dict(silver.dtypes)["DISTANCE"] == "int"
    assert silver.where("TAIL_NUM <> trim(upper(TAIL_NUM))").count() == 0
    assert silver.agg(F.min("DISTANCE")).first()[0] == 760


def test_gold_features_are_complete(spark, lake):
    gold = spark.read.parquet(lake["gold"])
    assert gold.count() == spark.read.parquet(lake["silver"]).count()
    report = {r.check_name: int(r.value) for r in validate.validate_gold(gold, strict=True).collect()}
    assert report["class_0_rows"] + report["class_1_rows"] + report["class_2_rows"] == report["total_rows"]
    assert gold.where("daily_flights is null or volume_zscore is null or is_rare is null").count() == 0


def test_weather_has_eight_slots_per_station_and_day(spark, lake):
    ws = spark.read.parquet(lake["ws"])
    per_day = ws.groupBy("date").count().select("count").distinct().collect()
    assert [r[0] for r in per_day] == [24]
    slices = {r.slice for r in ws.select("slice").distinct().collect()}
    assert "history" in slices and "2025-01-15" in slices and "2024-12-31" not in slices


def test_combined_keeps_every_metro_leg_and_its_weather(spark, lake):
    combined, gold = spark.read.parquet(lake["combined"]), spark.read.parquet(lake["gold"])
    metro = ("JFK", "LGA", "EWR")
    legs = gold.select(F.sum(F.col("ORIGIN").isin(*metro).cast("int") + F.col("DEST").isin(*metro).cast("int"))).first()[0]
    assert combined.count() == legs
    assert combined.where("weather_wind_dir_deg is null").count() == 0
    report = {r.check_name: r.status for r in validate.validate_combined(combined, gold.count()).collect()}
    assert report["weather_rows"] == "pass" and report["flight_rows"] == "fail"  # metro-to-metro flights stand twice
    with pytest.raises(validate.ValidationError):
        validate.validate_combined(combined, gold.count(), strict=True)


def test_daily_slice_can_run_twice(spark, lake):
    day = dt.date(2025, 1, 15)
    for _ in range(2):
        jobs.run_bronze_flights(spark, lake["flights"], lake["daily_bronze"], day=day)
        jobs.run_silver_flights(spark, lake["daily_bronze"], lake["daily_silver"], by="snapshot_date", day=day)
        jobs.run_gold_flights(spark, lake["daily_silver"], lake["daily_gold"], day=day)
        jobs.run_gold_combined(spark, lake["daily_gold"], lake["ws"], lake["daily_combined"], day=day)
    other = dt.date(2025, 1, 16)
    jobs.run_bronze_flights(spark, lake["flights"], lake["daily_bronze"], day=other)
    bronze = spark.read.parquet(lake["daily_bronze"])
    assert bronze.select("snapshot_date").distinct().count() == 2
    one = bronze.where(F.col("snapshot_date") == F.lit(day))
    assert [r[0] for r in one.select("FlightDate").distinct().collect()] == [day]
    daily, batch = spark.read.parquet(lake["daily_combined"]), spark.read.parquet(lake["combined"])
    assert "FlightDate" not in daily.columns
    assert daily.count() == batch.where(F.col("snapshot_date") == F.lit(day)).count()
    assert daily.where("volume_zscore <> 0").count() == 0 and daily.where("weather_temp_c is null").count() == 0
    assert daily.select("IS_DELAYED").distinct().count() <= 3


def test_train_score_and_monitor(spark, lake):
    combined = spark.read.parquet(lake["combined"])
    model, split, report = jobs.training_metrics(combined, months=(4, 1, 1), maxIter=3, maxDepth=3)
    assert {r.split for r in split.select("split").distinct().collect()} == {"train", "val", "test"}
    values = {(r.split, r.metric): r.value for r in report.collect()}
    assert 0 < values["test", "roc_auc_macro_ovr"] <= 1 and 0 < values["val", "accuracy"] <= 1
    for day in (dt.date(2025, 1, 10), dt.date(2025, 1, 11), dt.date(2025, 1, 11)):
        jobs.run_daily_score(spark, model, lake["combined"], lake["preds"], day)
    predictions = spark.read.parquet(lake["preds"])
    assert predictions.count() == combined.where("snapshot_date in (date '2025-01-10', date '2025-01-11')").count()
    assert predictions.where("abs(proba_0 + proba_1 + proba_2 - 1) > 1e-9").count() == 0
    jobs.run_daily_monitor(spark, lake["preds"], lake["metrics"], dt.date(2025, 1, 11))
    metrics = {r.metric for r in spark.read.json(lake["metrics"]).collect()}
    assert {"perf_accuracy", "perf_qwk", "ks_max_proba"} <= metrics


def test_append_adds_late_rows_and_copies_once(spark, tmp_path):
    day = F.expr("date_add(date '2025-01-01', cast(id % 3 as int))")
    df = spark.range(30).select(day.alias("snapshot_date"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("id"))
    df = df.unionAll(df.where("id = 7")).withColumn("at", F.current_timestamp())
    path = str(tmp_path / "t")
    sinks.write_partitioned(df.where("id % 3 < 2 and id < 20"), path, "snapshot_date")
    for _ in range(2):
        sinks.append_new_rows(df.withColumn("at", F.current_timestamp()), path, ignore=("at",))
    key = lambda x: sorted(map(repr, x.select("snapshot_date", "id").collect()))
    assert key(spark.read.parquet(path)) == key(df) and spark.read.parquet(path).count() == 31


def test_metrics_of_other_periods_stay(spark, tmp_path):
    path = str(tmp_path / "m")
    for day, value in (("2025-01-01", 1.0), ("2025-01-02", 2.0), ("2025-01-02", 3.0)):
        sinks.write_metrics(spark.createDataFrame([("a", value, day)], "metric string, value double, period string"), path)
    assert {(str(r.period), r.value) for r in spark.read.json(path).collect()} == {("2025-01-01", 1.0), ("2025-01-02", 3.0)}


def test_mixed_folders_lose_nothing(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "a int, b string").coalesce(1).write.parquet(str(tmp_path / "in/p.parquet"))
    for part in (tmp_path / "in/p.parquet").glob("part-*"):
        part.rename(tmp_path / "in" / "one.PQ")
    (tmp_path / "in/t.csv").write_text("b,a\ny,2\n")
    (tmp_path / "in/u.CSV").write_text("A,B\n3,z\n")
    import pyspark.sql.types as T

    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    rows = readers.load_any(spark, str(tmp_path / "in"), schema=schema).collect()
    assert sorted(map(tuple, rows)) == [(1, "x"), (2, "y"), (3, "z")]
    with pytest.raises(ValueError, match="schema"):
        readers.load_any(spark, str(tmp_path / "in"))


def test_monthly_files_in_two_orders_and_spellings(spark, tmp_path):
    (tmp_path / readers.month_file(2024, 1)).write_text("X,Y\n1,a\n")
    (tmp_path / readers.month_file(2024, 2)).write_text("y,x,Z\nb,2,q\n")
    rows = readers.read_months(spark, str(tmp_path), (2024, 1), (2024, 3), {"x": "int"}).orderBy("X").collect()
    assert [(r.X, r.Y, r.Z, r.source_file) for r in rows] == [
        (1, "a", None, readers.month_file(2024, 1)), (2, "b", "q", readers.month_file(2024, 2))]


def test_stored_training_scores_as_in_memory_and_fills_nulls(spark, lake, tmp_path):
    from pyspark.ml import PipelineModel

    from delayworks.operators import models

    out = str(tmp_path / "run")
    jobs.run_training(spark, lake["combined"], out, train_date="2025-02-01", months=(4, 1, 1), trials=2,
                      ranges={"maxIter": (2, 3), "maxDepth": (2, 3)})
    assert {r.split for r in spark.read.parquet(f"{out}/metrics").collect()} == {"val", "test"}
    assert spark.read.parquet(f"{out}/trials").where("best").select("trial").distinct().count() == 1
    assert {r.split for r in spark.read.parquet(f"{out}/splits").collect()} == {"train", "val", "test"}
    model = PipelineModel.load(f"{out}/model")
    day = spark.read.parquet(lake["combined"]).where("snapshot_date = date '2025-01-10'")
    numeric, text = models.trained_columns(model)
    assert "OP_UNIQUE_CARRIER" in text and "DISTANCE" in numeric
    modes = {r["column"]: r["mode"] for r in models.fit_modes(spark.read.parquet(lake["combined"]).where("snapshot_date < date '2024-12-01'"), ["OP_UNIQUE_CARRIER"]).collect()}
    gone = models.check_columns(model, day.withColumn("OP_UNIQUE_CARRIER", F.lit(None).cast("string")))
    known = [r[0] for r in model.transform(gone).select("OP_UNIQUE_CARRIER_known").distinct().collect()]
    assert len(known) == 1 and known[0] in ("AA", "DL") and set(modes.values()) <= {"AA", "DL"}
    for _ in range(2):
        jobs.run_daily_score(spark, f"{out}/model", lake["combined"], str(tmp_path / "preds"), "2025-01-10", str(tmp_path / "copy.csv"))
    stored = spark.read.parquet(str(tmp_path / "preds"))
    direct = models.score_multiclass(model, models.check_columns(model, day), ["flight_id"])
    key = lambda df: sorted((r.flight_id, round(r.proba_0, 9)) for r in df.collect())
    assert key(stored) == key(direct) and stored.count() == day.count()
    with pytest.raises(ValueError, match="DISTANCE"):
        models.check_columns(model, day.drop("DISTANCE"))
    for d in ("2025-01-10", "2025-01-10"):
        jobs.run_daily_monitor(spark, str(tmp_path / "preds"), str(tmp_path / "metrics"), d)
    cells = {r.metric: r.value for r in spark.read.json(str(tmp_path / "metrics")).collect() if r.metric.startswith("cm_")}
    assert len(cells) == 9 and sum(cells.values()) == day.count()


def test_daily_combined_reads_one_weather_slice(spark, lake):
    df = jobs.gold_combined(spark.read.parquet(lake["gold"]), spark.read.parquet(lake["ws"]), "2025-01-15")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "slice" in plan and plan.count("PartitionFilters: [") == 2 and "PartitionFilters: []" not in plan


def test_months_can_be_appended(spark, lake, tmp_path):
    out = str(tmp_path / "bronze")
    jobs.run_bronze_flights(spark, lake["flights"], out, (2024, 10), (2024, 10))
    for _ in range(2):
        jobs.run_bronze_flights(spark, lake["flights"], out, (2024, 10), (2024, 12), append=True)
    bronze = spark.read.parquet(out)
    assert bronze.count() == spark.read.parquet(lake["bronze"]).where("year_month < '2025-01'").count()


def test_airports_and_reference_ingest(spark, small, tmp_path):
    raw, out = str(tmp_path / "bronze"), str(tmp_path / "silver")
    for name, frame in (("airports", fx.airports(spark, small)), ("airport_frequencies", fx.frequencies(spark, small))):
        sinks.write_csv(frame, str(tmp_path / f"{name}.csv"))
        types = dict(frame.dtypes)
        jobs.run_ingest_reference(spark, str(tmp_path / f"{name}.csv"), raw, types)
    jobs.run_airports(spark, raw, out, codes=["JFK", "LGA", "EWR"])
    wide, subset = spark.read.parquet(f"{out}/US_airports"), spark.read.parquet(f"{out}/new_york")
    assert wide.count() == wide.select("airport_id").distinct().count() > subset.count() > 0
    assert dict(wide.dtypes)["freq_tower"] == "array<double>"
