import gzip

import pytest
from pyspark.sql import functions as F

from tallyfield.plans.genres import load_feature_sets
from tallyfield.session import scratch_path
from tallyfield.sources import parsing, readers, writers


@pytest.fixture
def base(tmp_path):
    return tmp_path


def put(path, text, zipped=False):
    data = text.encode()
    path.write_bytes(gzip.compress(data) if zipped else data)
    return str(path)


DAILY = "id string, date string, element string, value int, m string, q string, s string, t string"


def test_gzip_csv_with_blanks_and_dirty_numbers(spark, base):
    put(base / "2015.csv.gz", "A1,20150101,PRCP,5,,,7,0800\nA2,20150102,TMAX,oops,  ,X,7,\n", True)
    rows = readers.read_delimited(spark, f"{base}/*.csv.gz", DAILY).orderBy("id").collect()
    assert tuple(rows[0]) == ("A1", "20150101", "PRCP", 5, None, None, "7", "0800")
    assert tuple(rows[1]) == ("A2", "20150102", "TMAX", None, None, "X", "7", None)


def test_globs(spark, base):
    for year in range(2013, 2021):
        put(base / f"{year}.csv.gz", f"A,{year}0101,PRCP,{year},,,,\n", True)

    def years(pattern):
        df = readers.read_delimited(spark, f"{base}/{pattern}", DAILY)
        return sorted(r.value for r in df.select("value").collect())

    assert years("20{1[5-9],20}.csv.gz") == list(range(2015, 2021))
    assert years("*") == years("*.*") == list(range(2013, 2021))


def test_read_many_and_none(spark, base):
    paths = [put(base / f"{i}.csv", f"A,d,E,{i},,,,\n") for i in range(3)]
    assert readers.read_many(spark, paths[:2], DAILY).count() == 2
    empty = readers.read_many(spark, [], DAILY)
    assert empty.count() == 0 and empty.columns[3] == "value"


def test_fixed_width_short_and_blank_fields(spark):
    name = "ST JOHNS COOLIDGE FLD".ljust(30)
    line = f"ACW00011604  17.1167  -61.7833   10.1    {name} GSN     78861"
    df = spark.createDataFrame([(line,), ("X",), (line[:25],)], "value string")
    rows = parsing.parse_fixed_width(df, parsing.STATION_LAYOUT).collect()
    assert tuple(rows[0]) == (
        "ACW00011604", 17.1167, -61.7833, 10.1, None, "ST JOHNS COOLIDGE FLD", "GSN", None, "78861",
    )
    assert tuple(rows[1]) == ("X",) + (None,) * 8
    assert rows[2].latitude == 17.1167 and rows[2].elevation is None
    kept = parsing.parse_fixed_width(df, parsing.STATION_LAYOUT, blank_as_null=False).collect()
    assert kept[0].state_code == ""


def test_layouts_for_codes_and_inventory(spark):
    codes = spark.createDataFrame([("AC Antigua and Barbuda ",)], "value string")
    assert tuple(parsing.parse_fixed_width(codes, parsing.CODE_NAME_LAYOUT).first()) == ("AC", "Antigua and Barbuda")
    line = spark.createDataFrame([("ACW00011604  17.1167  -61.7833 TMAX 1949 1949",)], "value string")
    row = parsing.parse_fixed_width(line, parsing.INVENTORY_LAYOUT).first()
    assert tuple(row) == ("ACW00011604", 17.1167, -61.7833, "TMAX", 1949, 1949)


def test_pairs_skip_header_lines(spark):
    lines = ["header <not a pair", "ERROR: <SOAAA TRBBB> x != y", "< ERROR: <SOAAA TRBBB> again", "## 938 lines"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = parsing.extract_pairs(df, r"<(\w+) (\w+)>", ["song", "track"])
    assert [tuple(r) for r in out.collect()] == [("SOAAA", "TRBBB")]


def test_feature_sets(spark, base):
    put(base / "a.csv", "mean,NUMERIC\nspread,real\nid,STRING\n")
    put(base / "a.data.csv", "1.5,2.5,TR1\n3.5,4.5,'TR2'\n")
    spec = {"tone": (str(base / "a.csv"), str(base / "a.data.csv"))}
    df = load_feature_sets(spark, spec, scratch_path(spark, "sets"))["tone"]
    assert df.columns == ["tone_mean", "tone_spread", "track_id"]
    assert sorted(r.track_id for r in df.collect()) == ["TR1", "TR2"]
    packed = parsing.read_feature_set(spark, *spec["tone"], as_array=True)
    assert dict(packed.collect())["TR2"] == [3.5, 4.5]
    assert parsing.columns_with_prefix(df, "tone_") == ["tone_mean", "tone_spread"]


def test_csv_lines_equal_csv_read(spark, base):
    path = put(base / "x.csv", "A1,20150101,PRCP,5,,,7,0800\nA2,20150102,TMAX,7, ,X,7,\n")
    direct = readers.read_delimited(spark, path, DAILY)
    lines = readers.parse_csv_lines(readers.read_lines(spark, path), DAILY)
    assert direct.exceptAll(lines).isEmpty() and lines.count() == 2


@pytest.mark.parametrize("fmt", ["orc", "parquet", "csv"])
def test_save_overwrites(spark, base, fmt):
    path = str(base / "out")
    writers.save(spark.range(10), path, fmt)
    writers.save(spark.range(4), path, fmt)
    assert spark.read.format(fmt).option("header", True).load(path).count() == 4


def test_single_file_only_when_small(spark, base, monkeypatch):
    df = spark.range(100).repartition(5)
    writers.save(df, str(base / "one"), "parquet", single_file=True)
    assert len(list((base / "one").glob("*.parquet"))) == 1
    monkeypatch.setattr(writers, "SINGLE_FILE_ROWS", 10)
    with pytest.raises(ValueError):
        writers.save(df, str(base / "many"), "parquet", single_file=True)
    assert not (base / "many").exists()
    listed = writers.file_inventory(spark, str(base / "one"))
    assert listed.filter(F.col("path").endswith(".parquet")).count() == 1
    assert "content" not in listed.columns


def test_rows_per_file(spark, base):
    put(base / "a.csv", "1\n2\n")
    put(base / "b.csv", "3\n")
    rows = writers.rows_per_file(spark.read.schema("v int").csv(str(base)))
    assert sorted(r.n for r in rows.collect()) == [1, 2]


def test_filter_and_columns_reach_the_scan(spark, base):
    path = str(base / "t")
    writers.save(spark.range(50).withColumn("x", F.col("id") * 2).withColumn("y", F.lit("s")), path, "orc")
    df = readers.read_table(spark, path, "orc").filter("id = 3").select("x")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,3)" in plan and "y" not in plan.split("ReadSchema")[1]
