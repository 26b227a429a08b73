"""Files read block by block, against the one-task readers."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from civiq.plans.jobs import generic_etl
from civiq.sources import blocks, boundaries
from civiq.sources.blocks import csv_records, read_csv_blocks, scan
from civiq.sources.boundaries import read_boundaries
from civiq.sources.tables import read_csv_text, reject_open_quotes


@pytest.fixture
def small_blocks(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "2000")
    yield 2000
    spark.conf.set(key, before)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def random_value(pick):
    kind = pick.random()
    if kind < 0.2:
        return ""
    letters = 'ab ,"\n\r' if kind < 0.6 else "abc de"
    text = "".join(pick.choice(letters) for _ in range(pick.randint(1, 60)))
    return text.replace("\r", "\r\n")


@pytest.mark.parametrize("seed", range(3))
def test_records_are_those_of_the_one_task_reader(spark, tmp_path, small_blocks, seed):
    pick = random.Random(seed)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["id", "text", "more"])
    for i in range(700):
        writer.writerow([i, random_value(pick), random_value(pick)])
    path = tmp_path / "t.csv"
    path.write_bytes(out.getvalue().encode())
    found = read_csv_blocks(spark, str(path))
    one_task = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(path))
    assert rows_of(found) == rows_of(one_task) and found.count() == 700
    assert scan(spark, str(path), "\n").rdd.getNumPartitions() >= len(path.read_bytes()) // small_blocks
    assert read_csv_text(spark, str(path)).schema == found.schema


def test_records_longer_than_blocks_and_several_files(spark, tmp_path, small_blocks):
    long = "\n".join(f"line {i}, \"\"quoted\"\" and so on" for i in range(400))
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text(f'id,text\n{name}1,"{long}"\n{name}2,x\n\n{name}3,"y\nz"\n{name}4,"{long}"')
    found = {r.id: r.text for r in read_csv_blocks(spark, str(tmp_path)).collect()}
    want = long.replace('""', '"')
    assert found == {f"{n}{k}": v for n in "ab" for k, v in (("1", want), ("2", "x"), ("3", "y\nz"), ("4", want))}


def test_a_quote_inside_an_unquoted_value_opens_nothing(spark, tmp_path, small_blocks):
    path = tmp_path / "q.csv"
    path.write_text('name,status,value\npipe 5" long,active,1\n"a ""b""","x, ""y""\nz",2\nit\'s 3",off,3\r\n')
    assert rows_of(read_csv_blocks(spark, str(path))) == [("a \"b\"", 'x, "y"\nz', "2"), ("it's 3\"", "off", "3"), ('pipe 5" long', "active", "1")]


def test_a_quote_that_is_never_closed_raises(spark, tmp_path):
    path = tmp_path / "torn.csv"
    path.write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(Exception, match="never closed"):
        read_csv_blocks(spark, str(path)).collect()


def test_whole_lines_are_not_gathered(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n" + "1,2\n" * 50)
    records = csv_records(scan(spark, str(tmp_path / "t.csv"), "\n"))
    assert records.filter("home = 0 AND number = 1").first().record == "a,b" and records.count() == 51


def test_generic_job_takes_quotes_inside_values(spark, tmp_path):
    path = tmp_path / "jobs.csv"
    path.write_text('name,status,value\npipe 5" long,active,1\n"say ""hi""",off,2\n')
    reject_open_quotes(spark, str(path))
    generic_etl(spark, str(path), str(tmp_path / "out"))
    assert sorted(r.name_upper for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ['PIPE 5" LONG', 'SAY "HI"']


def collection(count, pick):
    features = []
    for i in range(count):
        x = float(i)
        ring = [[x, 0], [x + 1, 0], [x + 1, 1], [x, 1], [x, 0]]
        geometry = {"type": "Polygon", "coordinates": [ring]} if i % 3 else {"type": "MultiPolygon", "coordinates": [[ring]]}
        note = pick.choice(["{", "}{", '"quo{ted"', "back\\\\{slash", "[", "]}", "plain", "\\"])
        features.append({"type": "Feature", "properties": {"n": note, "code": i, "more": {"deep": [{"a": 1}]}}, "geometry": geometry if i % 7 else None})
    return features


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("crs_first", [True, False])
def test_features_are_those_of_the_one_task_reader(spark, tmp_path, small_blocks, indent, crs_first):
    crs = {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::32647"}}
    features = collection(150, random.Random(3))
    document = {"type": "FeatureCollection", "crs": crs, "features": features} if crs_first else {"features": features, "crs": crs, "bbox": [0, 1]}
    path = tmp_path / "areas.geojson"
    path.write_text(json.dumps(document, indent=indent, ensure_ascii=False))
    assert scan(spark, str(path), "{").rdd.getNumPartitions() > 5
    found = read_boundaries(spark, str(path), ["n", "code"], layout="blocks")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 << 20))
    one_task = read_boundaries(spark, str(path), ["n", "code"])
    assert rows_of(found) == rows_of(one_task) and found.count() == 150
    assert found.agg(F.min("epsg"), F.max("epsg"), F.max("poly_id")).first() == (32647, 32647, 149)


def test_objects_of_other_arrays_are_no_features(spark, tmp_path):
    path = tmp_path / "other.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": collection(3, random.Random(1)), "links": [{"href": "{x}"}]}))
    assert read_boundaries(spark, str(path), ["code"], layout="blocks").count() == 3


def test_large_files_go_to_the_block_readers(spark, tmp_path, small_blocks, monkeypatch):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n" + '1,"x\ny"\n' * 500)
    assert blocks.is_large(spark, str(path)) and read_csv_text(spark, str(path)).count() == 500
    areas = tmp_path / "areas.geojson"
    areas.write_text(json.dumps({"type": "FeatureCollection", "features": collection(40, random.Random(2))}))
    called = []
    monkeypatch.setattr(boundaries, "_features_in_blocks", lambda *a, f=boundaries._features_in_blocks: called.append(a) or f(*a))
    assert read_boundaries(spark, str(areas), ["code"]).count() == 40 and called
