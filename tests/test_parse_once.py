"""Cells and documents are parsed once, whatever tests follow."""

import re

from pyspark.sql import functions as F

from indicast.functions.scalars import lenient_double, lenient_int
from indicast.operators import harmonize as H
from indicast.sources import feeds
from indicast.sources.large_json import read_large_json


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_text_cells_are_parsed_once(spark):
    rows = [("CR.1", " ken ", y, v, "s") for y, v in [
        (" 2010 ", "1e2"), ("2010.0", "nan"), ("2010.5", "inf"), ("n/a", None), ("nan", " 7\t"), ("1e99", "x"), (None, "-0.5")]]
    raw = spark.createDataFrame(rows, "INDICATOR_ID string, ISO3 string, YEAR string, VALUE string, SOURCE string")
    long = H.enforce_schema(raw)
    plan = optimized(H.filter_year_range(long.where("VALUE > 0")).select("YEAR", "VALUE"))
    assert plan.count("cast(trim(year") == 1 and plan.count("cast(trim(value") == 1
    assert sorted(long.select("ISO3", "YEAR", "VALUE").collect(), key=str) == sorted([
        ("KEN", 2010, 100.0), ("KEN", 2010, None), ("KEN", None, float("inf")), ("KEN", None, None),
        ("KEN", None, 7.0), ("KEN", None, None), ("KEN", None, -0.5)], key=str)


def test_numbers_read_as_before(spark):
    df = spark.createDataFrame([(2.0,), (2.5,), (float("nan"),), (float("inf"),), (3e9,), (-2147483647.0,), (None,)], "x double")
    got = df.select(lenient_int("x", df.schema["x"].dataType), lenient_double("x", df.schema["x"].dataType)).collect()
    assert [tuple(r) for r in got] == [(2, 2.0), (None, 2.5), (None, None), (None, float("inf")), (None, 3e9),
                                       (-2147483647, -2147483647.0), (None, None)]


def test_series_are_parsed_once(spark):
    text = ('<Series><SeriesKey><Value id="REF_AREA" value="KEN"/></SeriesKey>'
            '<Obs><ObsDimension value="2001"/><ObsValue value="5"/></Obs></Series>')
    docs = spark.createDataFrame([(1, text), (2, text[:40])], "DOC int, text string")
    rows, broken = feeds.parse_series(docs, "text", F.lit("CR.2"), ["DOC"])
    for df in (rows, broken):
        assert optimized(df).count("from_xml") + optimized(df).count("xmltostructs") == 1
    assert [(r.DOC, r.ISO3, r.YEAR, r.VALUE) for r in rows.collect()] == [(1, "KEN", 2001, 5.0)]
    assert [r.DOC for r in broken.collect()] == [2]


def test_small_ranges_share_tasks(spark, tmp_path):
    items = ",".join('{"countryId": "KEN", "year": "%d", "value": "%d"}' % (2000 + i % 20, i) for i in range(400))
    (tmp_path / "CR.1.json").write_text('{"data": [%s]}' % items)
    rows, broken = read_large_json(spark, f"file://{tmp_path}/*.json", range_bytes=64)
    assert not broken.count() and sorted(r.VALUE for r in rows.collect()) == [float(i) for i in range(400)]
    # The elements' tasks are the last repartition of the plan; there are far more ranges.
    tasks = int(re.search(r"repartitionbyexpression \[.*\], (\d+)", optimized(rows))[1])
    assert tasks == 4 * spark.sparkContext.defaultParallelism < (tmp_path / "CR.1.json").stat().st_size // 64
