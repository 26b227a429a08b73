import datetime
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from civiq import session
from civiq.operators.columns import order_columns, union_by_name
from civiq.operators.rain import date_series, extract_readings, pivot_stations, request_plan
from civiq.plans.jobs import clean_tickets, explore, generic_etl, profile_table, rain_history, station_table, ticket_etl
from civiq.schemas import STATION_FIELDS, TICKET_SCHEMA
from civiq.session import scratch_dir
from civiq.sources.boundaries import read_boundaries
from civiq.sources.landing import lookup_pages, parse_bodies, request_url
from civiq.sources.rain_text import read_reports
from civiq.sources.stations import parse_station_arrays, unreadable_station_texts
from civiq.sources.tables import read_csv, read_csv_text, read_json, write_csv, write_json, write_parquet
from civiq.streaming import ingest
from civiq.streaming.ingest import ingest_landed, ingest_rain_reports, ingest_wide_history
from workload import catalog


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_keeps_line_breaks_quotes_and_blanks(spark, tmp_path):
    data = [("1", 'say "hi",\nthere'), ("2", " padded "), ("3", None)]
    df = spark.createDataFrame(data, "id string, text string")
    write_csv(df, str(tmp_path / "c"))
    assert rows(read_csv_text(spark, str(tmp_path / "c"))) == sorted(data, key=repr)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_csv_text(spark, str(tmp_path / "none"))


def test_csv_files_of_bounded_length(spark, tmp_path):
    data = [(str(i), f'line {i}\n"quoted", and more') for i in range(25)]
    write_csv(spark.createDataFrame(data, "id string, text string").coalesce(1), str(tmp_path / "c"), records_per_file=10)
    assert len(list((tmp_path / "c").glob("*.csv"))) == 3
    assert rows(read_csv_text(spark, str(tmp_path / "c"))) == sorted(data, key=repr)


def test_csv_types_and_missing_tokens(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("﻿i,f,b,s,e,big,m\n1,1.5,True,x,,99999999999999999999,1\nNA,nan,False,N/A,null,1,1.5\n-2, 3 ,true,y,NULL,2,7\n", encoding="utf-8")
    df = read_csv(spark, str(path))
    assert {f.name: f.dataType.typeName() for f in df.schema.fields} == {
        "i": "long", "f": "double", "b": "boolean", "s": "string", "e": "double", "big": "double", "m": "double"
    }
    got = df.orderBy("big").collect()
    assert [r.i for r in got] == [None, -2, 1] and [r.f for r in got] == [None, 3.0, 1.5]
    assert [r.s for r in got] == [None, "y", "x"] and [r.b for r in got] == [False, True, True]
    assert [r.m for r in got] == [1.5, 7.0, 1.0]


def test_json_arrays_and_coercion(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps([{"id": "1", "ok_at": "2024-01-02", "s": "x"}, {"id": "2", "ok_at": "2024-01-03", "s": "y"}], indent=2))
    df = read_json(spark, str(path), multiline=True, coerce=True)
    assert {f.name: f.dataType.typeName() for f in df.schema.fields} == {"id": "long", "ok_at": "timestamp", "s": "string"}
    write_json(df.select("id", F.lit(None).cast("string").alias("n")), str(tmp_path / "out"))
    assert '"n":null' in next((tmp_path / "out").glob("*.json")).read_text()


def test_parquet_modes_and_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    write_parquet(spark.range(5), path, "ignore")
    write_parquet(spark.range(9), path, "ignore")
    assert spark.read.parquet(path).count() == 5
    parts = str(tmp_path / "q")
    write_parquet(spark.range(40).withColumn("k", F.when(F.col("id") < 30, 0).otherwise(F.col("id") % 3)), parts, partition_by=("k",))
    assert spark.read.parquet(parts).filter("k = 0").count() == 34


class FakeSession:
    """Only the settings of a session."""

    def __init__(self, **settings):
        self.settings, self.conf = {k.replace("_", "."): v for k, v in settings.items()}, self

    def get(self, key, default):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_scratch_folder_follows_the_cluster_setting():
    assert scratch_dir(FakeSession(spark_checkpoint_dir="hdfs://shared/x/", spark_master="yarn"), "s").startswith("hdfs://shared/x/s-")
    with pytest.raises(RuntimeError):
        scratch_dir(FakeSession(spark_master="yarn"), "s")
    local = FakeSession(spark_master="local[8]", spark_sql_warehouse_dir="/w")
    first, second = scratch_dir(local, "s"), scratch_dir(local, "s")
    assert first != second and first.startswith("/w/s-") and second.startswith("/w/s-")


def test_a_url_landed_twice(spark):
    requests = spark.createDataFrame([("http://a", "x"), ("http://a", "y")], "base string, endpoint string")
    pages = spark.createDataFrame([("http://a/x", "old", 1), ("http://a/x", "new", 2)], "url string, html string, at int")
    found = lookup_pages(requests, pages, "base", "endpoint", landed="at").collect()
    assert sorted((r.endpoint, r.html) for r in found) == [("x", "new"), ("y", None)]
    with pytest.raises(Exception, match="landed more than once"):
        lookup_pages(requests, pages, "base", "endpoint").collect()


def test_every_page_of_a_url_landed_twice(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "http://a/x", "old"), (2, "http://a/x", "new"), (3, "http://a/y/", "y")], "page_id bigint, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    want = [(i, "http://a/x", hashlib.md5(t).hexdigest()) for i in (1, 2) for t in (b"old", b"new")]
    assert rows(catalog.QUERIES["s13_landed_pages"](spark, str(tmp_path))) == sorted([*want, (3, "http://a/y", None)], key=repr)
    with pytest.raises(ValueError):
        lookup_pages(pages, pages, "url", "url", landed="page_id", every=True)


REPORTS = {
    "01-01-2022": "header\n1 2 0.5 RF.KTY.01\n1 2     RF.KTY.02\n",
    "02-01-2022": "1 2 1.5 RF.KTY.01\r\n1 2 - RF.NEW.9 x\n",
    "03-01-2022": "nothing today\n",
}


def land(folder, names=REPORTS):
    folder.mkdir(exist_ok=True)
    for name in names:
        (folder / f"rain_{name}.txt").write_text(REPORTS[name])


def test_rain_history(spark, tmp_path):
    land(tmp_path / "in")
    lines = read_reports(spark, str(tmp_path / "in"))
    assert {(r.Date, r.day) for r in lines.select("Date", "day").collect()} == {(f"0{d}/01/2022", datetime.date(2022, 1, d)) for d in (1, 2, 3)}
    wide = rain_history(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert wide.columns == ["Date", "KTY.01", "KTY.02", "NEW.9"]
    want = [("01/01/2022", 0.5, None, None), ("02/01/2022", 1.5, None, None)]
    assert rows(wide) == want
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == wide.columns and back.count() == 2


def test_daily_tables_united_equal_one_pivot(spark):
    data = [(f"0{d}/01/2022", f"S.{s}", float(d * s) if s != d else None) for d in range(1, 6) for s in range(1, 4 + d % 2)]
    readings = spark.createDataFrame(data, "Date string, Station string, WaterLevel double")
    days = [pivot_stations(readings.filter(F.col("Date") == f"0{d}/01/2022")) for d in range(1, 6)]
    united = order_columns(union_by_name(days), ["Date"])
    whole = pivot_stations(readings)
    assert united.columns == whole.columns and rows(united) == rows(whole)


def test_pivot_refuses_two_readings(spark):
    readings = spark.createDataFrame([("d", "s", 1.0), ("d", "s", 1.0)], "Date string, Station string, WaterLevel double")
    with pytest.raises(Exception, match="two readings"):
        pivot_stations(readings, ["s"]).collect()


def test_pivot_refuses_unlisted_stations(spark):
    readings = spark.createDataFrame([("d", "A", 1.0), ("d", "B", 1.0)], "Date string, Station string, WaterLevel double")
    with pytest.raises(Exception, match="not listed: B"):
        pivot_stations(readings, ["A"]).collect()
    assert pivot_stations(readings, ["A", "B", "C"]).columns == ["Date", "A", "B", "C"]


def test_profiles_cover_every_column(spark):
    wide = spark.range(3).selectExpr(*[f"CASE WHEN id < {i % 3} THEN id END AS c{i}" for i in range(25)])
    assert len(profile_table(wide).nulls) == 25 and profile_table(wide).nulls["c24"] == 3


def test_typed_csv_raises_on_bad_values(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a\n1\nbad\n")
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    with pytest.raises(Exception, match="cannot hold: bad"):
        read_csv(spark, str(tmp_path / "t.csv"), schema).collect()
    assert [r.a for r in read_csv(spark, str(tmp_path / "t.csv"), schema, on_error="null").collect()] == [1, None]


def test_generic_job_refuses_torn_records(spark, tmp_path):
    (tmp_path / "t.csv").write_text('name,status,value\n"a\nb",active,1\n')
    with pytest.raises(ValueError, match="line break"):
        generic_etl(spark, str(tmp_path / "t.csv"), str(tmp_path / "out"))
    generic_etl(spark, str(tmp_path / "t.csv"), str(tmp_path / "out"), multiline=True)
    assert spark.read.parquet(str(tmp_path / "out")).first().name == "a\nb"


def test_boundaries_refuse_other_geometry(spark, tmp_path):
    (tmp_path / "b.json").write_text(
        '{"properties": {"i": "1"}, "geometry": {"type": "GeometryCollection", "coordinates": []}}\n'
        '{"properties": {"i": "2"}, "geometry": null}\n')
    areas = read_boundaries(spark, str(tmp_path / "b.json"), [], layout="lines", index="i")
    assert areas.filter("poly_id = 2").first().edges is None
    with pytest.raises(Exception, match="cannot be a GeometryCollection"):
        areas.collect()


def test_date_series_and_request_plan(spark):
    bounds = spark.createDataFrame([(datetime.date(2021, 12, 30), datetime.date(2022, 1, 1))], "a date, b date")
    plan = request_plan(date_series(bounds, "a", "b"), note=F.lit("hello")).orderBy("datePick_now").collect()
    assert [(r.Date, r.rain_type, r.StationTime_end) for r in plan] == [
        ("01/01/2022", "1", "23:59"), ("30/12/2021", "1", "23:59"), ("31/12/2021", "10", "23:55")
    ]
    assert {r.note for r in plan} == {"hello"} and plan[0].datePick_end == "01/01/2022"
    backwards = spark.createDataFrame([(datetime.date(2022, 1, 2), datetime.date(2022, 1, 1))], "a date, b date")
    assert date_series(backwards, "a", "b").count() == 0


def test_station_arrays(spark, tmp_path):
    def record(k):
        return "[13.70791,100.58363," + ",".join(f"'{name} {k}'" for name in STATION_FIELDS[2:]) + "]"

    texts = spark.createDataFrame(
        [(f"\n[\n    {record(1)},\n\n    {record(2)}\n]\n",), ("[[1,2]]",), ("[[oops",), ("",), (None,)], "txt string"
    )
    stations = parse_station_arrays(texts, "txt")
    assert stations.columns == STATION_FIELDS and stations.count() == 3
    short = stations.filter("Latitude = 1").first()
    assert short.Longitude == 2 and short.Timestamp is None
    assert unreadable_station_texts(texts, "txt").count() == 3
    table, unreadable = station_table(texts.filter("txt <> '[[1,2]]'"), "txt", str(tmp_path / "s"))
    assert unreadable.count() == 2
    longer = spark.createDataFrame([("[[" + ",".join(["'x'"] * 19) + "]]",)], "txt string")
    assert parse_station_arrays(longer, "txt").count() == 0 and unreadable_station_texts(longer, "txt").count() == 1
    assert table.columns == ["StationCode", "StationName_Short", "DistrictName", "Latitude", "Longitude", "LastReadingTime", "DistrictCode_from_JS"]
    assert sorted(r.LastReadingTime for r in table.collect()) == ["Timestamp 1", "Timestamp 2"]
    assert read_csv(spark, str(tmp_path / "s")).first().Latitude == 13.70791


def test_landed_bodies_and_pages(spark):
    bodies = spark.createDataFrame([('{"name": "n", "stars": 3, "x": 1}',), ("<html>",), (None,)], "raw string")
    got = parse_bodies(bodies, "raw", "name string, stars bigint").select("body.*").collect()
    assert sorted(((r.name, r.stars) for r in got), key=repr) == [("n", 3), (None, None), (None, None)]
    requests = spark.createDataFrame([("http://a", "x/"), ("http://a", ""), ("http://a", None), ("http://a", "y")], "base string, endpoint string")
    urls = requests.select(request_url(F.col("base"), F.col("endpoint")).alias("u"))
    assert sorted(r.u for r in urls.collect()) == ["http://a", "http://a", "http://a/x", "http://a/y"]
    pages = spark.createDataFrame([("http://a/x", "X"), ("http://a", "A")], "url string, html string")
    found = lookup_pages(requests, pages, "base", "endpoint")
    assert sorted((r.request_url, r.html or "") for r in found.collect()) == [
        ("http://a", "A"), ("http://a", "A"), ("http://a/x", "X"), ("http://a/y", "")
    ]


def test_each_landed_file_is_taken_once(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    (source / "a.json").write_text('{"k": 1}\n{"k": 2}\n')
    (source / "empty.json").write_text("")
    run = lambda: ingest_landed(spark, str(source), target, state, "k bigint", "json")
    run()
    run()
    assert rows(spark.read.parquet(target)) == [(1,), (2,)]
    (source / "b.json").write_text('{"k": 3}\n')
    run()
    assert rows(spark.read.parquet(target)) == [(1,), (2,), (3,)]


def test_a_new_date_rewrites_its_month_alone(spark, tmp_path):
    source, target, state = tmp_path / "in", tmp_path / "wide", str(tmp_path / "state")

    def land(name, day, *lines):
        folder = source / f"day={day}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("\n".join(lines))

    def table():
        ingest_wide_history(spark, str(source), str(target), state, ["A", "B.1"])
        return {r["Date"]: (r["A"], r["B.1"]) for r in spark.read.parquet(str(target)).collect()}

    def written():
        return {p.parent.name: (p.name, p.stat().st_mtime_ns) for p in target.glob("month=*/*.parquet")}

    land("a.txt", "2024-01-30", "1 2 0.5 RF.A", "1 2 1.5 RF.B.1")
    land("a.txt", "2024-02-01", "1 2 0.25 RF.A")
    first = table()
    assert first == {"30/01/2024": (0.5, 1.5), "01/02/2024": (0.25, None)}
    before = written()
    land("b.txt", "2024-02-02", "1 2 7.0 RF.B.1")
    assert table() == first | {"02/02/2024": (None, 7.0)}
    after = written()
    assert after["month=2024-01"] == before["month=2024-01"] and after["month=2024-02"] != before["month=2024-02"]
    land("again.txt", "2024-01-30", "1 2 9.0 RF.A")
    assert table() == {"30/01/2024": (9.0, None), "01/02/2024": (0.25, None), "02/02/2024": (None, 7.0)}
    assert written()["month=2024-02"] == after["month=2024-02"]
    assert table()["30/01/2024"] == (9.0, None)


def test_many_batches_write_a_month_once(spark, tmp_path):
    source, target, state = tmp_path / "in", tmp_path / "wide", tmp_path / "state"
    for at, (day, value) in enumerate((("2024-01-01", 1), ("2024-01-02", 2), ("2024-02-01", 3), ("2024-01-01", 4))):
        folder = source / f"day={day}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{at}.txt").write_text(f"1 2 {value}.0 RF.A")
        os.utime(folder / f"{at}.txt", (1_700_000_000 + at, 1_700_000_000 + at))
    runs = []
    real = ingest._merge_history
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ingest, "_merge_history", lambda *given: runs.append(1) or real(*given))
        ingest_wide_history(spark, str(source), str(target), str(state), ["A"], files_per_batch=1)
        ingest_wide_history(spark, str(source), str(target), str(state), ["A"], files_per_batch=1)
    assert rows(spark.read.parquet(str(target)).select("Date", "A")) == [("01/01/2024", 4.0), ("01/02/2024", 3.0), ("02/01/2024", 2.0)]
    assert runs == [1] and not (state / "staged").exists()
    assert sorted(p.parent.name for p in target.glob("month=*/*.parquet")) == ["month=2024-01", "month=2024-02"]


def test_folders_are_listed_by_few_tasks(spark):
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 1000


def test_incremental_reports_equal_the_batch(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    land(source, ["01-01-2022"])
    ingest_rain_reports(spark, str(source), target, state)
    land(source, ["02-01-2022", "03-01-2022"])
    ingest_rain_reports(spark, str(source), target, state)
    batch = extract_readings(read_reports(spark, str(source)))
    assert rows(spark.read.parquet(target)) == rows(batch) and batch.count() == 4


def test_ticket_etl_profiles_and_cleans(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "Ticket ID,Problem Type,Time Stamp,Lat,Lon\n1,{a},2024-01-02 03:04:05,1.5,2\n1,{a},2024-01-02 03:04:05,1.5,2\n"
        "2,,soon,x,3\n3,{a},2024-01-03,,\n"
    )
    before, after = ticket_etl(spark, str(path), str(tmp_path / "out"))
    assert before.rows == 4 and after.rows == 3
    assert before.nulls == {"Ticket ID": 0, "Problem Type": 1, "Time Stamp": 0, "Lat": 1, "Lon": 1}
    assert after.nulls == {"ticket_id": 0, "problem_type": 1, "time_stamp": 1, "lat": 2, "lon": 1}
    assert after.top == [("{a}", 2), (None, 1)] and before.top == []
    out = spark.read.parquet(str(tmp_path / "out"))
    assert [f.dataType.typeName() for f in out.schema.fields] == ["string", "string", "timestamp", "double", "double"]
    assert len(after.sample) == 3


def test_ticket_etl_runs_few_jobs(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("id,type\n" + "".join(f"{i},t{i % 3}\n" for i in range(50)))
    spark.sparkContext.setJobGroup("etl", "etl")
    ticket_etl(spark, str(path), str(tmp_path / "out"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("etl")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) <= 15


def test_generic_etl(spark, tmp_path):
    path = tmp_path / "g.csv"
    path.write_text("name,status,value\n ann ,active,1\nbob,Active,2\ncy,,NA\ndee,,4.5\n")
    generic_etl(spark, str(path), str(tmp_path / "out"))
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("name_upper", "is_active", "value").collect())
    assert got == [("ANN", True, 1.0), ("BOB", False, 2.0), ("DEE", False, 4.5)]


TICKET = ("T1", "{น้ำท่วม,ถนน}", "o", "0.5,0.5", "2022-05-01 10:00:00+00", "2022-06-01 10:00:00+00", "p", "q", "5", "กรุงเทพฯ", "D", "S")


def test_clean_tickets_step_by_step(spark):
    def changed(**fields):
        return tuple(fields.get(n, v) for n, v in zip(TICKET_SCHEMA.names, TICKET))

    bad = [
        changed(organization=None), changed(coords="5,5"), changed(coords="1,2,3"), changed(timestamp="2025-01-01 00:00:00+00"),
        changed(province="นนทบุรี"), changed(province=None), changed(district="X"), changed(subdistrict=None), changed(type="{}"),
        changed(coords="0.5"),
    ]
    raw = spark.createDataFrame([TICKET, changed(ticket_id="T2", star=None, photo_after=None), *bad], TICKET_SCHEMA)
    areas = spark.createDataFrame(
        [(0, "s", "1", "D", "9", 4326, [(0.0, 0.0, 1.0, 0.0), (1.0, 0.0, 1.0, 1.0), (1.0, 1.0, 0.0, 1.0), (0.0, 1.0, 0.0, 0.0)])],
        "poly_id bigint, SUBDISTR_1 string, SUBDISTRIC string, DISTRICT_N string, DISTRICT_I string, epsg int, "
        "edges array<struct<x1: double, y1: double, x2: double, y2: double>>",
    )
    check = spark.createDataFrame([(1, "S", 9, "D", 1)], "scode int, sname string, dcode int, dname string, seq int")
    clean, rejects = clean_tickets(raw, areas, check)
    assert [r.coords for r in rejects.collect()] == ["1,2,3"]
    assert sorted(r.ticket_id for r in clean.collect()) == ["T1", "T2"]
    row = clean.filter("ticket_id = 'T1'").first()
    assert (row.province, row.year_timestamp, row.month_timestamp, row.days_timestamp) == ("กรุงเทพมหานคร", 2022, 5, 31)
    assert (row.longitude, row.latitude) == (0.5, 0.5)
    assert not {"photo", "star", "poly_id", "SUBDISTR_1", "DISTRICT_N"} & set(clean.columns)
    assert clean_tickets(raw, areas).tickets.count() == 0  # unrepaired names agree with no ticket
    tags = clean_tickets(raw, areas, check, explode=True).tickets.filter("ticket_id = 'T1'").collect()
    assert sorted(r.type_list for r in tags) == ["ถนน", "น้ำท่วม"]


def test_exploration(spark):
    df = spark.range(100).selectExpr("id", "id * 1.5D AS a", "CASE WHEN id % 4 = 0 THEN NULL ELSE id END AS b", "id % 2 AS y")
    found = explore(df, "y", ["id"])
    assert {r.column: r.nulls for r in found.missing.collect()} == {"a": 0, "b": 25, "y": 0}
    assert found.summary.count() == 24 and found.correlations.count() == 9 and found.histograms.count() == 60
    assert found.features.groupBy("split").count().orderBy("split").collect()[0]["count"] == 20


def test_scratch_data_never_goes_to_a_folder_of_one_machine(monkeypatch):
    monkeypatch.setattr(session, "_made", {"some"})  # these are not to be removed

    class Session:
        def __init__(self, **settings):
            self.conf = {k.replace("_", "."): v for k, v in settings.items()}

    shared = {"spark_sql_warehouse_dir": "hdfs://store/warehouse", "spark_master": "yarn"}
    assert scratch_dir(Session(**shared), "x").startswith("hdfs://store/warehouse/x-")
    assert scratch_dir(Session(spark_sql_warehouse_dir="file:/tmp/w", spark_master="local[4]"), "x").startswith("file:/tmp/w/x-")
    assert scratch_dir(Session(spark_checkpoint_dir="file:/mnt/all", spark_master="yarn"), "x").startswith("file:/mnt/all/x-")
    for place in ("file:/tmp/w", "/tmp/w"):
        with pytest.raises(RuntimeError, match="shared by all"):
            scratch_dir(Session(spark_sql_warehouse_dir=place, spark_master="local-cluster[2,1,1024]"), "x")


def test_date_series_keeps_columns_of_any_name(spark):
    bounds = spark.createDataFrame([(datetime.date(2024, 1, 1), datetime.date(2024, 1, 2), "k")], "a date, b date, _day string")
    assert rows(date_series(bounds, "a", "b")) == [("k", "01/01/2024"), ("k", "02/01/2024")]
