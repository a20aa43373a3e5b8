import datetime
import json
import math
import os
import random
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from martlake import schemas
from martlake.functions import numbers
from martlake.operators import weather
from martlake.plans import jobs
from martlake.sources import landing, publish, tables
from martlake.streaming import intake


def hour(**fields):
    return {"time": "0", "humidity": "50", "pressure": "1000", "precipMM": "0.0", "winddir16Point": "N", **fields}


def day(date, hours, **fields):
    base = {
        "date": date, "astronomy": [{"sunrise": "07:00 AM"}], "maxtempF": "41", "mintempF": "33", "avgtempF": "37",
        "maxtempC": "5", "mintempC": "1", "avgtempC": "-0", "totalSnow_cm": "0.0", "sunHour": "8.7", "uvIndex": "2",
        "hourly": hours,
    }
    return {**base, **fields}


def land(root, location, document, date, indent=None):
    year, month, number = date.split("-")
    folder = root / f"location={location}" / f"year={year}" / f"month={month}" / f"day={number}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{year}{month}{number}.json").write_text(json.dumps(document, indent=indent))


def one_clean(spark, hours, **fields):
    whole = {**day("2020-01-02", None), **fields}
    row = {k: v for k, v in whole.items() if k in schemas.RAW_DAY.fieldNames()}
    row["hourly"] = hours and [{k: h.get(k) for k in schemas.HOURLY.fieldNames()} for h in hours]
    if hours == []:
        row["hourly"] = []
    return weather.clean_days(spark.createDataFrame([row], schemas.RAW_DAY)).first()


def test_statistics(spark):
    r = one_clean(spark, [hour(humidity="80", pressure="998", precipMM="0.5"), hour(humidity="90", pressure="1008", precipMM="1.2")])
    assert (r.avgHumidity, r.minHumidity, r.maxHumidity) == (85.0, 80.0, 90.0)
    assert (r.avgPressure, r.minPressure, r.maxPressure) == (1003.0, 998.0, 1008.0)
    assert r.totalPrecipMM == pytest.approx(1.7)
    assert (r.date, r.maxtempF, r.mintempF, r.uvIndex) == (datetime.date(2020, 1, 2), 41.0, 33.0, 2)


def test_mean_over_24_hours(spark):
    hours = [hour(humidity=str(60 + i)) for i in range(24)]
    assert one_clean(spark, hours).avgHumidity == 71.5


def test_missing_empty_and_nan_are_skipped_zero_is_not(spark):
    r = one_clean(spark, [hour(humidity=None), hour(humidity=""), hour(humidity="nan"), hour(humidity="0.0"), hour(humidity=" 1e1 ")])
    assert (r.avgHumidity, r.minHumidity, r.maxHumidity) == (5.0, 0.0, 10.0)


@pytest.mark.parametrize("hours", [[], [hour(precipMM=""), hour(precipMM="NaN")]])
def test_nothing_usable_gives_nan(spark, hours):
    assert math.isnan(one_clean(spark, hours).totalPrecipMM)


def test_no_hours_at_all_gives_null(spark):
    r = one_clean(spark, None)
    assert r.avgHumidity is None and r.totalPrecipMM is None


@pytest.mark.parametrize("text", ["abc", "1.5d", "2f", "1,5"])
def test_bad_hourly_text_stops_the_job(spark, text):
    with pytest.raises(Exception, match="error converting"):
        one_clean(spark, [hour(humidity=text)])


def test_infinity_is_a_number(spark):
    assert one_clean(spark, [hour(humidity="inf"), hour(humidity="1")]).maxHumidity == math.inf


def test_day_columns_are_lenient(spark):
    r = one_clean(spark, [hour()], maxtempF="x", mintempF=" 7.5 ", uvIndex="2.0", date="no date")
    assert r.maxtempF is None and r.mintempF == 7.5 and r.uvIndex == 2 and r.date is None


def test_lenient_int(spark):
    texts = ["2", "2.0", "2.9", "-3", "+4", "", "x", "1e3", "99999999999", None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING").select(numbers.lenient_int(F.col("t")).alias("n"))
    assert [r.n for r in df.collect()] == [2, 2, 2, -3, 4, None, None, None, None, None]


def test_three_shapes_in_one_read(spark, tmp_path):
    raw = tmp_path / "raw"
    request = [{"type": "City", "query": "x"}]
    land(raw, "a", {"data": {"request": request, "weather": [day("2020-01-02", [hour(humidity="10")])]}}, "2020-01-02")
    land(raw, "b", {"request": request, "weather": [day("2020-01-02", [hour(humidity="20")])]}, "2020-01-02")
    land(raw, "c", day("2020-01-02", [hour(humidity="30")]), "2020-01-02")
    clean = weather.clean_days(weather.normalise_days(landing.accepted(landing.read_landing(spark, str(raw)))))
    assert {(r.location, r.avgHumidity, r.month, r.day) for r in clean.collect()} == {
        ("a", 10.0, "01", "02"), ("b", 20.0, "01", "02"), ("c", 30.0, "01", "02"),
    }
    assert clean.drop(*landing.SOURCE).schema.simpleString() == schemas.CLEAN_DAY.simpleString()


def test_pretty_printed_reply(spark, tmp_path):
    raw = tmp_path / "raw"
    land(raw, "a", {"data": {"weather": [day("2020-12-25", [hour()] * 8)]}}, "2020-12-25", indent=2)
    clean = weather.clean_days(weather.normalise_days(landing.accepted(landing.read_landing(spark, str(raw)))))
    assert [r.avgHumidity for r in clean.collect()] == [50.0]


def land_text(raw, location, text, date="2020-12-25"):
    folder = raw / f"location={location}" / "year=2020" / "month=12" / "day=25"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "lines.json").write_bytes(text.encode())


@pytest.mark.parametrize("bound", [landing.WHOLE, 10])
def test_lines_are_judged_one_by_one(spark, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(landing, "WHOLE", bound)
    raw = tmp_path / "raw"
    one, two = (json.dumps(day(f"2020-12-0{k}", [hour()])) for k in (1, 2))
    land_text(raw, "a", f"{one[:30]}\r\n{one}\r\n\r\n{two}\r\n")
    land_text(raw, "b", f"garbage\n{one}\n{two[:40]}\n{two}")
    land_text(raw, "c", f"{one}\n{two}\n")
    documents = landing.read_landing(spark, str(raw)).cache()
    days = weather.clean_days(weather.normalise_days(landing.accepted(documents))).collect()
    assert sorted((r.location, str(r.date)[:10]) for r in days) == [(x, f"2020-12-0{k}") for x in "abc" for k in (1, 2)]
    assert sorted((r.location, r.text, r.reason) for r in landing.rejected(documents).collect()) == [
        ("a", one[:30], "not a JSON document"), ("b", "garbage", "not a JSON document"), ("b", two[:40], "not a JSON document"),
    ]


@pytest.mark.parametrize("bound", [landing.WHOLE, 10])
def test_replies_over_several_lines(spark, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(landing, "WHOLE", bound)
    raw = tmp_path / "raw"
    one, two = (json.dumps({"data": {"weather": [day(f"2020-12-0{k}", [hour()])]}}, indent=2) for k in (1, 2))
    rows = "{\n\"weather\": [\n" + json.dumps(day("2020-12-01", [hour()])) + "\n]}"
    land_text(raw, "a", f"{one}\n{two}")
    land_text(raw, "b", two[:-20])
    land_text(raw, "c", rows)
    documents = landing.read_landing(spark, str(raw)).cache()
    days = weather.clean_days(weather.normalise_days(landing.accepted(documents))).collect()
    assert sorted((r.location, str(r.date)[:10]) for r in days) == [("a", "2020-12-01"), ("a", "2020-12-02"), ("c", "2020-12-01")]
    assert [(r.location, r.text) for r in landing.rejected(documents).collect()] == [("b", two[:-20])]


@pytest.mark.parametrize("block", ["64", "257", "5000"])
def test_documents_in_blocks_of_any_size(spark, tmp_path, monkeypatch, block):
    """Pretty-printed replies, lines, broken ones and blank lines in one file that many tasks read."""
    raw, rng = tmp_path / "raw", random.Random(block)
    parts = []
    for k in range(40):
        reply = {"data": {"weather": [day(f"2020-01-{k % 28 + 1:02d}", [hour()], maxtempF=str(k))]}}
        text = json.dumps(reply, indent=rng.choice([None, 1, 4]))
        parts.append(text[: len(text) // 2] if k % 9 == 4 else text)
        parts.append(rng.choice(["\n", "\r\n", "\n\n \t\n"]))
    land_text(raw, "a", "".join(parts))
    land_text(raw, "b", "\n \n")

    def rows(bound):
        monkeypatch.setattr(landing, "WHOLE", bound)
        documents = landing.read_landing(spark, str(raw))
        days = weather.clean_days(weather.normalise_days(landing.accepted(documents)))
        return clean_rows(days), sorted((r.location, r.reason, r.text) for r in landing.rejected(documents).collect())

    whole = rows(landing.WHOLE)
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        assert rows(10) == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(whole[0]) >= 35 - 9 and whole[1]


def test_large_files_are_not_opened_as_a_whole(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    text = json.dumps(day("2020-12-01", [hour()])) + "\n"
    land_text(raw, "a", text * 300)
    monkeypatch.setattr(landing, "WHOLE", 1000)
    scans = {whole: landing._read_texts(spark, str(raw), None, whole) for whole in (True, False)}
    assert scans[True].rdd.getNumPartitions() == 0 and scans[False].count() == 300


def test_clean_job_twice_adds_nothing(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "clean")
    for date in ("2020-01-31", "2020-02-01"):
        land(raw, "a", day(date, [hour()]), date)
    jobs.clean_weather(spark, str(raw), out)
    jobs.clean_weather(spark, str(raw), out)
    assert landing.read_clean(spark, out).count() == 2
    plan = landing.read_clean(spark, out).filter("month = '02'")
    assert [r.day for r in plan.collect()] == ["01"]
    assert "PartitionFilters: [isnotnull(month" in plan._jdf.queryExecution().toString()


def test_write_modes(spark, tmp_path):
    def clean(location, month):
        df = spark.createDataFrame([(location, "2020", month, "01")], "location STRING, year STRING, month STRING, day STRING")
        rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.CLEAN_DAY.fields if f.name not in df.columns]
        return df.select(*rest, "*")

    out = str(tmp_path / "clean")
    landing.write_clean(clean("a", "01"), out)
    landing.write_clean(clean("a", "01"), out, mode="append")
    landing.write_clean(clean("b", "01"), out, mode="append")
    landing.write_clean(clean("a", "01"), out, mode="partitions")
    assert sorted(r.location for r in landing.read_clean(spark, out).collect()) == ["a", "b"]
    landing.write_clean(clean("c", "01"), out)
    assert [r.location for r in landing.read_clean(spark, out).collect()] == ["c"]


def test_registered_table_keeps_padding(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "clean")
    land(raw, "a", day("2020-01-02", [hour()]), "2020-01-02")
    jobs.clean_weather(spark, str(raw), out)
    table = tables.register(spark, "registered_clean", out, landing.CLEAN_PARTITIONS)
    assert [(r.month, r.day) for r in table.collect()] == [("01", "02")]
    spark.sql("DROP TABLE registered_clean")


def test_preview(spark, tmp_path):
    raw = tmp_path / "raw"
    for i in range(1, 8):
        land(raw, "a", day(f"2020-01-0{i}", [hour()]), f"2020-01-0{i}")
    clean = weather.clean_days(weather.normalise_days(landing.accepted(landing.read_landing(spark, str(raw)))))
    shown = weather.preview_days(clean)
    assert shown.columns == weather.PREVIEW
    assert [r.date.day for r in shown.collect()] == [1, 2, 3, 4, 5]


@pytest.fixture(scope="module")
def seen(spark):
    found = [("a", "2020-01-01"), ("a", "2020-01-04"), ("a", "2020-01-04"), ("b", "2020-01-05"), ("c", "2020-01-09")]
    return spark.createDataFrame(found, "location STRING, date STRING")


def test_missing_days(seen):
    found = sorted((r.location, str(r.date)) for r in weather.missing_days(seen, "2020-01-07").collect())
    assert found == [("a", "2020-01-02"), ("a", "2020-01-03"), ("a", "2020-01-05"), ("a", "2020-01-06"), ("b", "2020-01-06")]


def test_next_day_is_before_today(seen):
    found = sorted((r.location, str(r.date)) for r in weather.next_day(seen, "2020-01-06").collect())
    assert found == [("a", "2020-01-05")]


# --- intake


def clean_rows(df):
    return sorted((r.location, str(r.date), r.maxtempF) for r in df.collect())


def test_intake_in_two_runs_equals_one_batch(spark, tmp_path):
    raw, log = tmp_path / "raw", str(tmp_path / "log")
    land(raw, "a", day("2020-01-02", [hour()]), "2020-01-02")
    land(raw, "b", {"weather": [day("2020-01-02", [hour()])]}, "2020-01-02")
    intake.take_in(spark, str(raw), log)
    assert len(clean_rows(intake.current_days(spark, log))) == 2
    land(raw, "a", {"data": {"weather": [day("2020-01-03", [hour()])]}}, "2020-01-03")
    intake.take_in(spark, str(raw), log)
    intake.take_in(spark, str(raw), log)  # nothing new
    assert intake.read_log(spark, log).count() == 3
    batch = weather.clean_days(weather.normalise_days(landing.accepted(landing.read_landing(spark, str(raw)))))
    assert clean_rows(intake.current_days(spark, log)) == clean_rows(batch)


def test_day_delivered_twice_counts_once_newest_wins(spark, tmp_path):
    raw, log = tmp_path / "raw", str(tmp_path / "log")
    land(raw, "a", day("2020-01-02", [hour()], maxtempF="1"), "2020-01-02")
    intake.take_in(spark, str(raw), log)
    folder = raw / "location=a" / "year=2020" / "month=01" / "day=02"
    (folder / "again.json").write_text(json.dumps(day("2020-01-02", [hour()], maxtempF="2")))
    intake.take_in(spark, str(raw), log)
    assert intake.read_log(spark, log).count() == 2
    assert clean_rows(intake.current_days(spark, log)) == [("a", "2020-01-02", 2.0)]
    done = intake.compact_days(spark, log, str(tmp_path / "clean"))
    assert clean_rows(done) == [("a", "2020-01-02", 2.0)]


def test_days_without_a_date_are_kept_apart(spark, tmp_path):
    raw, log, base = tmp_path / "raw", str(tmp_path / "log"), str(tmp_path / "clean")
    for folder, high in (("2020-01-02", "1"), ("2020-01-03", "2")):
        land(raw, "a", day("no date", [hour()], maxtempF=high), folder)
    intake.take_in(spark, str(raw), log)
    intake.compact_days(spark, log, base)
    later = raw / "location=a" / "year=2020" / "month=01" / "day=03" / "later.json"
    later.write_text(json.dumps(day("no date", [hour()], maxtempF="3")))
    intake.take_in(spark, str(raw), log)
    done = intake.compact_days(spark, log, base)
    assert sorted((r.day, r.maxtempF) for r in done.collect()) == [("02", 1.0), ("03", 3.0)]


def test_compaction_goes_on_from_the_last_one(spark, tmp_path):
    raw, log, base = tmp_path / "raw", str(tmp_path / "log"), str(tmp_path / "clean")
    for number, (date, high) in enumerate([("2020-01-02", "1"), ("2020-01-03", "3"), ("2020-01-02", "2")]):
        land(raw, "a", day(date, [hour()]), date)
        folder = raw / "location=a" / "year=2020" / "month=01" / f"day={date[-2:]}"
        (folder / f"delivery{number}.json").write_text(json.dumps(day(date, [hour()], maxtempF=high)))
        (folder / f"{date.replace('-', '')}.json").unlink()
        intake.take_in(spark, str(raw), log)
        if number != 1:
            done = intake.compact_days(spark, log, base)
    assert clean_rows(done) == [("a", "2020-01-02", 2.0), ("a", "2020-01-03", 3.0)]
    assert clean_rows(intake.current_days(spark, log, base)) == clean_rows(intake.current_days(spark, log))
    assert clean_rows(intake.compact_days(spark, log, base)) == clean_rows(done)  # nothing new


@pytest.mark.parametrize("part", ["days", "rejected", "files"])
def test_failed_batch_is_repeated_without_doubling(spark, tmp_path, monkeypatch, part):
    """A run that dies anywhere in a batch: nothing of it counts, and the stream repeats it under the same number."""
    raw, log = tmp_path / "raw", str(tmp_path / "log")
    land(raw, "a", day("2020-01-02", [hour()]), "2020-01-02")
    land(raw, "b", [1], "2020-01-02")
    parquet = DataFrameWriter.parquet

    def failing(self, path, *args, **options):
        parquet(self, path, *args, **options)
        if f"/{part}/batch=0" in path:
            raise OSError("lost")

    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    with pytest.raises(StreamingQueryException):
        intake.take_in(spark, str(raw), log)
    monkeypatch.undo()
    if part != "files":
        assert intake.read_log(spark, log).count() == intake.rejected_documents(spark, log).count() == 0
    land(raw, "a", day("2020-01-03", [hour()]), "2020-01-03")
    assert intake.take_in(spark, str(raw), log) == intake.STEP
    assert [d for _, d, _ in clean_rows(intake.read_log(spark, log))] == ["2020-01-02", "2020-01-03"]
    assert intake.rejected_documents(spark, log).count() == 1


def test_second_run_reads_only_new_files(spark, tmp_path, monkeypatch):
    raw, log = tmp_path / "raw", str(tmp_path / "log")
    read = []
    real = intake.read_landing
    monkeypatch.setattr(intake, "read_landing", lambda spark, root, paths: read.append(len(paths)) or real(spark, root, paths))
    for n in (2, 3):
        for k in range(n):
            land(raw, f"l{n}{k}", day("2020-01-02", [hour()]), "2020-01-02")
        intake.take_in(spark, str(raw), log)
    intake.take_in(spark, str(raw), log)
    assert read == [2, 3]


def test_file_overwritten_under_its_name_is_taken_again(spark, tmp_path):
    raw, log, base = tmp_path / "raw", str(tmp_path / "log"), str(tmp_path / "clean")
    for high in ("1", "22"):
        land(raw, "a", day("2020-01-02", [hour()], maxtempF=high), "2020-01-02")
        intake.take_in(spark, str(raw), log)
        done = intake.compact_days(spark, log, base)
    assert clean_rows(done) == [("a", "2020-01-02", 22.0)]


def test_old_file_that_comes_late_is_taken(spark, tmp_path):
    raw, log = tmp_path / "raw", str(tmp_path / "log")
    land(raw, "a", day("2020-01-02", [hour()]), "2020-01-02")
    intake.take_in(spark, str(raw), log)
    land(raw, "a", day("2020-01-01", [hour()]), "2020-01-01")
    past = time.time() - 300 * 86_400
    os.utime(raw / "location=a" / "year=2020" / "month=01" / "day=01" / "20200101.json", (past, past))
    intake.take_in(spark, str(raw), log)
    assert [d for _, d, _ in clean_rows(intake.current_days(spark, log))] == ["2020-01-01", "2020-01-02"]


def test_replies_without_a_day_are_kept_with_the_reason(spark, tmp_path):
    raw, log = tmp_path / "raw", str(tmp_path / "log")
    land(raw, "a", {"data": {"weather": [day("2020-01-01", [hour()])]}}, "2020-01-01", indent=2)
    for number, text in enumerate(['{"date": "2020-01-02", "max', "", "{}", '{"weather": []}', '{"weather": [null]}', "[1]"]):
        land(raw, f"l{number}", {}, "2020-01-02")
        (raw / f"location=l{number}" / "year=2020" / "month=01" / "day=02" / "20200102.json").write_text(text)
    lines = [json.dumps(day("2020-01-03", [hour()])), '{"date": "2020', json.dumps(day("2020-01-04", [hour()]))]
    land(raw, "b", {}, "2020-01-03")
    (raw / "location=b" / "year=2020" / "month=01" / "day=03" / "20200103.json").write_text("\n".join(lines) + "\n")
    assert intake.take_in(spark, str(raw), log, files_per_batch=3) == 2 * intake.STEP
    assert [(loc, d) for loc, d, _ in clean_rows(intake.current_days(spark, log))] == [
        ("a", "2020-01-01"), ("b", "2020-01-03"), ("b", "2020-01-04"),
    ]
    found = {r.location: r.reason for r in intake.rejected_documents(spark, log).collect()}
    broken, empty = "not a JSON document", "no day in it"
    assert found == {"l0": broken, "l2": empty, "l3": empty, "l4": empty, "l5": broken, "b": broken}
    with pytest.raises(ValueError, match="not a JSON|no day"):
        jobs.clean_weather(spark, str(raw), str(tmp_path / "clean"))
    jobs.clean_weather(spark, str(raw), str(tmp_path / "clean"), rejects=str(tmp_path / "rejects"))
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 6


def test_clean_job_takes_the_newest_of_a_day(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "clean")
    land(raw, "a", day("2020-01-02", [hour()], maxtempF="1"), "2020-01-02")
    folder = raw / "location=a" / "year=2020" / "month=01" / "day=02"
    (folder / "again.json").write_text(json.dumps(day("2020-01-02", [hour()], maxtempF="2")))
    later = time.time() + 60
    os.utime(folder / "again.json", (later, later))
    jobs.clean_weather(spark, str(raw), out)
    assert clean_rows(landing.read_clean(spark, out)) == [("a", "2020-01-02", 2.0)]


def test_compaction_keeps_untouched_folders(spark, tmp_path):
    raw, log, base = tmp_path / "raw", str(tmp_path / "log"), str(tmp_path / "clean")
    for location, date in (("a", "2020-01-02"), ("a", "2020-02-02"), ("b", "2020-01-02")):
        land(raw, location, day(date, [hour()], maxtempF="1"), date)
    intake.take_in(spark, str(raw), log)
    intake.compact_days(spark, log, base)
    before = set(publish.published_folders(spark, base)[intake.TABLE][1])
    land(raw, "a", day("2020-01-03", [hour()], maxtempF="33"), "2020-01-03")
    intake.take_in(spark, str(raw), log)
    days = intake.compact_days(spark, log, base)
    after = set(publish.published_folders(spark, base)[intake.TABLE][1])
    assert {f for f in before - after} == {f for f in before if f.endswith("location=a/year=2020/month=01")}
    assert len(after) == 3 and days.count() == 4
    assert clean_rows(days) == clean_rows(intake.current_days(spark, log))


def test_register_leaves_other_tables_alone(spark, tmp_path):
    for name in ("one", "two"):
        spark.range(2).write.parquet(str(tmp_path / name))
    tables.register(spark, "registered_twice", str(tmp_path / "one"))
    assert tables.register(spark, "registered_twice", str(tmp_path / "one")).count() == 2
    with pytest.raises(ValueError, match="another folder"):
        tables.register(spark, "registered_twice", str(tmp_path / "two"))
    spark.sql("DROP TABLE registered_twice")


def test_newest_is_ranked_before_the_shuffle(spark, tmp_path):
    df = spark.range(100).selectExpr("CAST(id % 3 AS STRING) AS location", "DATE '2020-01-01' AS date", "id")
    plan = weather.latest_per_day(df, ["location", "date"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
