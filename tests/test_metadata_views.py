"""Metadata tables, dashboard views and the driver contract."""


import __spark_entry__ as E
from indicast.operators import metadata as M
from indicast.operators import views as V
from indicast.operators import reshape as R
from indicast.schema import INDICATOR_IDS


def test_concepts_and_sheet(spark):
    c = {r["INDICATOR_ID"]: r for r in M.concept_table(spark).collect()}
    assert list(c) == INDICATOR_IDS or sorted(c) == sorted(INDICATOR_IDS)
    assert c["GPIA.CR.1"]["UNIT"] == "Index (0–2.5)" and c["GPIA.CR.1"]["NOTE"].startswith("GPI > 1")
    assert c["CR.1"]["NOTE"] == "" and c["CR.1"]["SOURCE_ORGANISATION"] == "UNESCO UIS"
    sheet = {r["INDICATOR_ID"]: r for r in M.concept_sheet(M.concept_table(spark)).collect()}
    assert sheet["CR.1"]["DISAGGREGATIONS"] == "sex, location, wealth_quintile"
    assert sheet["GPIA.CR.2"]["DISAGGREGATIONS"] == ""
    assert M.indicator_meta(M.concept_table(spark), "NOPE").count() == 0


def test_codelists_structure_lineage(spark):
    counts = {r["LIST_ID"]: r["count"] for r in M.code_lists(spark).groupBy("LIST_ID").count().collect()}
    assert counts == {"CL_AREA": 24, "CL_OBS_STATUS": 5, "CL_FREQ": 1}
    assert M.data_structure(spark).count() == 7
    steps = [r["STEP"] for r in M.process_history(M.lineage(spark)).collect()]
    assert steps == list(range(1, 8))
    reg = M.registry(spark).first()
    assert len(reg["concept_scheme"]["concepts"]) == 11 and len(reg["codelists"]) == 3


def test_views_on_fixture(spark, make_df):
    from support import panel
    rows = panel("CR.1", ("KEN", "GHA", "FRA"), (2010, 2012)) + panel("CR.1", ("BRA",), (2010,))
    wide = R.pivot_wide(make_df(rows))
    per_region = {r["REGION"]: r["N_COUNTRIES"] for r in V.countries_per_region(wide).collect()}
    assert per_region == {"Sub-Saharan Africa": 2, "Europe & Central Asia": 1, "Latin America & Caribbean": 1}
    assert V.filter_table(wide).count() == wide.count()
    assert V.filter_table(wide, region="Europe & Central Asia", years=(2010, 2010)).count() == 1
    kpi = V.overview_kpis(wide, make_df(rows)).first()
    assert (kpi["N_COUNTRIES"], kpi["N_INDICATORS"], kpi["N_OBSERVATIONS"]) == (4, 11, 7)
    heat = {r["ISO3"]: r["CR.1"] for r in V.years_heatmap(wide).collect()}
    assert heat["KEN"] == 2 and heat["BRA"] == 1
    cls = V.qa_status_classes(spark.createDataFrame(
        [("PASS",), ("WARN_MISSING",), ("WARN_MISSING|FAIL",), ("FAIL",)], "QA_STATUS string"))
    assert [r["STATUS_CLASS"] for r in cls.collect()] == ["ok", "warn", "warn", "fail"]


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.count() == 11
    assert set(E.oracle_sql()) <= set(E.queries())
