"""End-to-end staged run from landed JSON / XML feed files to exports."""

import json
import os

import pytest
from pyspark.sql import functions as F

from indicast.plans.publish import StagedRun

COUNTRIES = ["MDG", "GHA", "KEN", "FRA", "IND"]
YEARS = list(range(2010, 2015))


def land(tmp_path):
    api = tmp_path / "api"
    api.mkdir()
    for ind, base in (("CR.1", 50.0), ("GPIA.CR.1", 0.9)):
        data = []
        for i, c in enumerate(COUNTRIES):
            for j, y in enumerate(YEARS):
                if (i + j) % 7 == 3:
                    continue  # a gap to impute
                data.append({"countryId": c, "year": y, "value": base + i + j * (0.01 if base < 2 else 1)})
        (api / f"{ind}.json").write_text(json.dumps({"data": data}))
    sdmx = tmp_path / "sdmx"
    sdmx.mkdir()
    obs = "".join(f'<generic:Obs><generic:ObsDimension value="{y}"/><generic:ObsValue value="77.7"/>'
                  f'<generic:Attributes><generic:Value id="OBS_STATUS" value="E"/></generic:Attributes></generic:Obs>'
                  for y in YEARS)
    (sdmx / "CR.1.xml").write_text(
        '<?xml version="1.0"?><message:GenericData xmlns:message="m" xmlns:generic="g"><message:DataSet>'
        '<generic:Series><generic:SeriesKey><generic:Value id="REF_AREA" value="MDG"/></generic:SeriesKey>'
        + obs + '</generic:Series></message:DataSet></message:GenericData>')
    return str(api / "*.json"), str(sdmx / "*.xml")


def test_staged_run(spark, tmp_path):
    api, sdmx = land(tmp_path)
    base = str(tmp_path / "stages")
    written = {}
    steps = [("ingest", {"api": api, "sdmx": sdmx}), ("harmonize", {"extra": True}), ("merge", {}), ("validate", {}),
             ("anomaly", {}), ("impute", {}), ("metadata", {}), ("export", {})]
    for name, kw in steps:  # every stage in an object of its own: only storage connects them
        one = StagedRun(spark, base)
        getattr(one, name)(**kw)
        written |= one.written
    run = StagedRun(spark, base)
    for name in ("harmonized", "coverage", "wide", "qa_summary", "qa_flagged", "scored",
                 "imputed", "imputation_report", "lineage", "registry"):
        assert name in written, name
    h = run.table("harmonized")
    assert h.columns[-3:] == ["MAGNITUDE", "QUALIFIER", "OBS_STATUS"]
    assert {r["OBS_STATUS"] for r in h.where("SOURCE = 'UIS_SDMX'").collect()} == {"E"}
    assert run.table("unparsed").count() == 0
    # API rows win over SDMX rows on the same key; SDMX fills the API gaps for MDG.
    mdg = {r["YEAR"]: (r["SOURCE"], r["VALUE"]) for r in
           h.where((F.col("INDICATOR_ID") == "CR.1") & (F.col("ISO3") == "MDG")).collect()}
    assert set(mdg) == set(YEARS)
    assert all(src == "UIS_API" for y, (src, _) in mdg.items() if (0 + YEARS.index(y)) % 7 != 3)
    assert mdg[2013] == ("UIS_SDMX", 77.7)  # the only MDG gap in the API feed
    imputed = run.table("imputed")
    # Country-years without any value are not in the wide table: 4 API gaps,
    # one of them (MDG 2013) filled by the SDMX feed.
    n_wide = len(COUNTRIES) * len(YEARS) - 3
    assert imputed.count() == n_wide
    assert imputed.where(F.col("`CR.1`").isNull() | F.col("`GPIA.CR.1`").isNull()).count() == 0
    assert imputed.where(F.col("`TRTP.1`").isNotNull()).count() == 0  # entirely missing stays NULL
    rep = {r["INDICATOR_ID"]: r for r in run.table("imputation_report").collect()}
    assert rep["GPIA.CR.1"]["N_IMPUTED"] > 0 and rep["TRTP.1"]["N_IMPUTED"] == 0
    steps = {r["STEP"]: r["N_ROWS"] for r in run.table("lineage").collect()}
    assert steps[3] == h.count() and steps[7] == n_wide
    assert sorted(os.listdir(run.path("bundle"))) == ["Coverage", "Data", "Imputation", "Metadata"]
    assert spark.read.parquet(run.path("exports/parquet")).count() == n_wide


def test_missing_stages_are_named(spark, tmp_path):
    run = StagedRun(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError, match="run ingest first"):
        run.harmonize()
    with pytest.raises(FileNotFoundError, match="'imputed'"):
        run.export()
    assert run.metadata().where("STEP = 3").count() == 1
