"""Readers, writers and the streaming ingest, round-tripped through temp folders."""

import json
import os

from indicast.operators import metadata as M
from indicast.schema import COVERAGE_SCHEMA, HARMONIZED_SCHEMA
from indicast.sinks import exports as K
from indicast.sources import feeds as SRC
from indicast.streaming.landing import ingest_landed_feed

XML_DOC = """<?xml version="1.0"?>
<message:GenericData xmlns:message="http://www.sdmx.org/resources/sdmxml/schemas/v2_1/message"
                     xmlns:generic="http://www.sdmx.org/resources/sdmxml/schemas/v2_1/data/generic">
<message:DataSet>
<generic:Series>
  <generic:SeriesKey><generic:Value id="INDICATOR" value="CR.1"/><generic:Value id="REF_AREA" value="MDG"/></generic:SeriesKey>
  <generic:Obs><generic:ObsDimension value="2010"/><generic:ObsValue value="51.5"/>
    <generic:Attributes><generic:Value id="OBS_STATUS" value="E"/></generic:Attributes></generic:Obs>
  <generic:Obs><generic:ObsDimension value="2011"/><generic:ObsValue value="bad"/></generic:Obs>
</generic:Series>
<generic:Series>
  <generic:SeriesKey><generic:Value id="COUNTRY" value="GHA"/></generic:SeriesKey>
  <generic:Obs><generic:ObsDimension value="2012"/></generic:Obs>
</generic:Series>
</message:DataSet></message:GenericData>
"""


def test_sdmx_xml(spark, tmp_path):
    p = tmp_path / "CR.1.xml"
    p.write_text(XML_DOC)
    rows = sorted(tuple(r) for r in SRC.read_sdmx_xml(spark, str(p)).select(
        "INDICATOR_ID", "ISO3", "YEAR", "VALUE", "OBS_STATUS").collect())
    assert rows == [("CR.1", "GHA", 2012, None, ""), ("CR.1", "MDG", 2010, 51.5, "E"),
                    ("CR.1", "MDG", 2011, None, "")]


def test_json_payload(spark, tmp_path):
    (tmp_path / "CR.2.json").write_text(json.dumps({"data": [
        {"countryId": "MDG", "year": 2010, "value": 51.5, "magnitude": "", "qualifier": ""},
        {"country_id": "GHA", "year": 2011, "value": None},
        {"year": "2012.0", "value": "7"}]}))
    (tmp_path / "CR.3.json").write_text("{broken")
    found, broken = SRC.read_json_documents(spark, str(tmp_path / "*.json"))
    assert [(r["FILE"][-9:], r["DOCUMENT"]) for r in broken.collect()] == [("CR.3.json", "{broken")]
    assert [r["ISO3"] for r in found.orderBy("FILE", "POS").collect()] == ["MDG", "GHA", ""]
    rows = sorted(tuple(r) for r in found.drop("FILE", "POS").collect())
    assert rows == [
        ("CR.2", "", 2012, 7.0, "", "", "Completion rate — lower secondary education"),
        ("CR.2", "GHA", 2011, None, "", "", "Completion rate — lower secondary education"),
        ("CR.2", "MDG", 2010, 51.5, "", "", "Completion rate — lower secondary education")]


def test_broken_series_are_reported(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(1, '<Series><SeriesKey><Value id="REF_AREA" value="MDG"/></SeriesKey><Obs>'
                                      '<ObsDimension value="2010"/></Obs></Series>'), (2, "<Series><Obs"), (3, None)], "k int, t string")
    rows, broken = SRC.parse_series(docs, "t", F.lit("CR.1"), ["k"])
    assert [(r["k"], r["ISO3"], r["YEAR"], r["POS"]) for r in rows.collect()] == [(1, "MDG", 2010, 0)]
    assert sorted(r["k"] for r in broken.collect()) == [2, 3]


def test_csv_cells_are_read_leniently_and_in_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("INDICATOR_ID,ISO3,YEAR,VALUE\nCR.1,MDG,2010.0,1e2\nCR.1,GHA, 2011 , 7 \nCR.1,KEN,2012.5,x\n,,,\n")
    schema = "INDICATOR_ID string, ISO3 string, YEAR int, VALUE double"
    from pyspark.sql.types import StructType
    out = SRC.read_csv_table(spark, str(tmp_path / "a.csv"), StructType.fromDDL(schema), with_position=True)
    rows = [(r["ISO3"], r["YEAR"], r["VALUE"]) for r in out.orderBy("FILE", "POS").collect()]
    assert rows == [("MDG", 2010, 100.0), ("GHA", 2011, 7.0), ("KEN", None, None), (None, None, None)]


def test_csv_round_trip_and_optional(spark, tmp_path, make_df):
    from support import panel
    df = make_df(panel())
    K.write_stage(df, str(tmp_path / "h"), fmt="csv")
    back = SRC.read_csv_table(spark, str(tmp_path / "h"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    missing = SRC.read_optional(spark, str(tmp_path / "nope"), COVERAGE_SCHEMA)
    assert missing.count() == 0 and missing.schema == COVERAGE_SCHEMA


def test_export_all_and_bundle(spark, tmp_path, make_df):
    from support import panel
    df = make_df(panel(countries=("KEN", "BRA", "FRA", "IND", "MDG"), years=range(2004, 2008)))
    out = K.export_all(df, str(tmp_path / "x"))
    assert set(out) == {"csv", "json", "parquet"}
    man = spark.read.json(out["json"] + "/_manifest").first()
    assert man["n_records"] == 20 and man["dataset"]
    recs = spark.read.json(out["json"] + "/records")
    assert recs.count() == 20
    assert spark.read.parquet(out["parquet"]).count() == 20
    keys = []
    for name in sorted(f for f in os.listdir(out["csv"]) if f.startswith("part-")):
        with open(os.path.join(out["csv"], name)) as fh:
            for line in list(fh)[1:]:
                f = line.split(",")
                keys.append((f[2], int(f[3])))
    assert len(keys) == 20 and keys == sorted(keys)
    bundle = K.write_bundle({"Data": df, "Empty": spark.createDataFrame([], HARMONIZED_SCHEMA)},
                            str(tmp_path / "b"))
    assert set(bundle) == {"Data"}


def test_registry_round_trip(spark, tmp_path):
    reg = M.registry(spark)
    K.write_registry(reg, str(tmp_path / "reg"))
    back = SRC.read_registry(spark, str(tmp_path / "reg")).first()
    assert back["registry_id"] == M.REGISTRY_ID
    assert len(back["process_history"]) == 7
    assert back["concept_scheme"]["concepts"]["CR.1"]["unit"] == "Percentage"


def test_streaming_ingest_keeps_every_row_over_three_sessions(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    sink, progress = str(tmp_path / "sink"), str(tmp_path / "progress")
    head = "INDICATOR_ID,ISO3,YEAR,VALUE,MAGNITUDE,QUALIFIER,INDICATOR_LABEL\n"
    for i, text in enumerate(["CR.1, mdg ,2010,51.5,,,x\nCR.1,GHA,2011.0,,,,x\n", "CR.2,KEN,2012,3,,,y\n", "CR.2,FRA,2013,4,,,y\n"]):
        (land / f"{i}.csv").write_text(head + text)
        own = spark.newSession()
        assert ingest_landed_feed(own, str(land), sink, "UIS_API", progress).awaitTermination(120)
    rows = sorted(tuple(r) for r in spark.read.parquet(sink).select("INDICATOR_ID", "ISO3", "YEAR", "VALUE", "SOURCE").collect())
    assert rows == [("CR.1", "GHA", 2011, None, "UIS_API"), ("CR.1", "MDG", 2010, 51.5, "UIS_API"),
                    ("CR.2", "FRA", 2013, 4.0, "UIS_API"), ("CR.2", "KEN", 2012, 3.0, "UIS_API")]


def test_stream_progress_folder_is_required(spark, tmp_path):
    import pytest
    with pytest.raises(TypeError):
        ingest_landed_feed(spark, str(tmp_path), str(tmp_path / "s"), "UIS_API")
