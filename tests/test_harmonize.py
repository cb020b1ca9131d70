"""Harmonisation semantics: parsing, de-dup priority, filters, enrichment."""


from indicast.operators import harmonize as H
from indicast.operators import reshape as R


def raw(spark, rows, cols=("INDICATOR_ID", "ISO3", "YEAR", "VALUE", "SOURCE")):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def test_lenient_parsing(spark):
    rows = [("CR.1", " mdg\t", y, v, "UIS_API") for y, v in [
        ("2010", " 2 "), ("2010.0", "1e2"), ("2010.5", "2010.0"), ("x", ""), (None, "x"),
        ("2011", "nan"), ("2012", "inf"), ("2013", "True")]]
    out = H.enforce_schema(raw(spark, rows)).collect()
    assert [r["YEAR"] for r in out] == [2010, 2010, None, None, None, 2011, 2012, 2013]
    assert [r["VALUE"] for r in out] == [2.0, 100.0, 2010.0, None, None, None, float("inf"), None]
    assert {r["ISO3"] for r in out} == {"MDG"}
    assert out[0]["INDICATOR_LABEL"] == "Completion rate — primary education"


def test_null_text_stays_null_and_source_stamp(spark):
    df = raw(spark, [(None, None, "2010", "1", None)])
    r = H.enforce_schema(df, source_name="UIS_SDMX").first()
    assert r["INDICATOR_ID"] is None and r["ISO3"] is None and r["SOURCE"] == "UIS_SDMX"
    assert r["INDICATOR_LABEL"] is None


def test_priority_keeps_api_even_when_null(spark):
    a = H.enforce_schema(raw(spark, [("CR.1", "MDG", "2010", None, "x")]), "UIS_API")
    b = H.enforce_schema(raw(spark, [("CR.1", "MDG", "2010", "55", "x")]), "UIS_SDMX")
    out = H.harmonize(a, b).collect()
    assert len(out) == 1 and out[0]["SOURCE"] == "UIS_API" and out[0]["VALUE"] is None


def test_tie_break_and_value_nulls_last(spark):
    df = spark.createDataFrame(
        [("CR.1", "MDG", "2010", None, "UIS_API", 1), ("CR.1", "MDG", "2010", "7", "UIS_API", 1),
         ("CR.1", "MDG", "2010", "3", "UIS_API", 2)],
        "INDICATOR_ID string, ISO3 string, YEAR string, VALUE string, SOURCE string, T int")
    d = H.dedup_by_priority(H.enforce_schema(df, extra_cols=["T"]), ["SOURCE", "T"])
    assert [r["VALUE"] for r in d.collect()] == [7.0]


def test_filters_and_enrichment(spark):
    rows = [("CR.1", "MDG", "2010", "1"), ("CR.1", "ZZZ", "2010", "1"), ("CR.1", "GHA", "1999", "1"),
            ("CR.1", "GHA", "2031", "1"), ("CR.1", "FRA", "2030", "1"), ("CR.1", None, "2010", "1")]
    df = H.enforce_schema(raw(spark, rows, ("INDICATOR_ID", "ISO3", "YEAR", "VALUE")), "UIS_API")
    out = {(r["ISO3"], r["YEAR"]): r for r in H.harmonize(df).collect()}
    assert set(out) == {("MDG", 2010), ("FRA", 2030)}
    assert out[("FRA", 2030)]["REGION"] == "Europe & Central Asia"
    assert out[("MDG", 2010)]["INCOME_GROUP"] == "Low income"
    c = H.drop_counters(df).first()
    assert (c["N_RAW"], c["DROPPED_DUPLICATES"], c["DROPPED_ISO3"], c["DROPPED_YEAR"],
            c["N_HARMONIZED"]) == (6, 0, 2, 2, 2)


def test_dedup_plan_is_partial_aggregate(spark):
    df = H.enforce_schema(raw(spark, [("CR.1", "MDG", "2010", "1", "UIS_API")]))
    plan = H.dedup_by_priority(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_first_record_of_a_source_wins_and_no_value_is_lost_to_null(spark):
    cols = ("INDICATOR_ID", "ISO3", "YEAR", "VALUE", "SOURCE", "FILE", "POS")
    rows = [("CR.1", "MDG", "2010", "50", "UIS_API", "a", "0"), ("CR.1", "MDG", "2010", None, "UIS_API", "a", "1"),
            ("CR.1", "GHA", "2010", "70", "UIS_API", "a", "2"), ("CR.1", "GHA", "2010", "20", "UIS_API", "a", "3"),
            ("CR.1", "KEN", "2010", None, "UIS_API", "a", "4"), ("CR.1", "KEN", "2010", "30", "UIS_API", "a", "5"),
            ("CR.1", "KEN", "2010", "31", "UIS_SDMX", "b", "0")]
    df = H.enforce_schema(raw(spark, rows, cols), extra_cols=["FILE", "POS"])
    values = lambda **kw: {r["ISO3"]: r["VALUE"] for r in H.harmonize(df, **kw).collect()}
    assert values(tie_break=["FILE", "POS"]) == {"MDG": 50.0, "GHA": 70.0, "KEN": None}
    assert values(tie_break=["FILE", "POS"], prefer_non_null=True) == {"MDG": 50.0, "GHA": 70.0, "KEN": 30.0}
    assert values() == {"MDG": 50.0, "GHA": 20.0, "KEN": 30.0}  # no place known: never NULL over a value


def test_coverage_catalogue_rows_and_values(spark, make_df):
    from support import panel
    cov = {r["INDICATOR_ID"]: r for r in R.coverage(make_df(panel())).collect()}
    assert len(cov) == 11
    own = cov["ROFST.2"]
    assert (own["N_COUNTRIES"], own["N_YEARS"], own["N_OBSERVATIONS"], own["N_MISSING"]) == (3, 4, 12, 0)
    assert own["COVERAGE_PCT"] == 100.0 and (own["YEAR_MIN"], own["YEAR_MAX"]) == (2004, 2007)
    empty = cov["TRTP.2"]
    assert empty["N_OBSERVATIONS"] == 0 and empty["YEAR_MIN"] is None and empty["N_MISSING"] == 12


def test_pivot_semantics(spark, make_df):
    from support import panel
    rows = panel("CR.1", ("MDG", "IND"), (2010, 2011))
    extra = lambda base, **kw: {**base, **kw}
    rows.append(extra(rows[0], VALUE=99.0))                       # duplicate key: largest value wins
    rows.append(extra(rows[2], INDICATOR_ID="XX.9", ISO3="NPL", INCOME_GROUP="Low income"))
    rows.append(extra(rows[2], ISO3="BRA", REGION=None))
    rows.append(extra(rows[0], INDICATOR_ID="CR.2", VALUE=None))
    out = R.pivot_wide(make_df(rows))
    w = {(r["ISO3"], r["YEAR"]): r for r in out.collect()}
    assert w[("MDG", 2010)]["CR.1"] == 99.0 and w[("MDG", 2010)]["CR.2"] is None
    assert ("BRA", 2010) not in w                                  # NULL region dropped
    assert all(w[("NPL", 2010)][c] is None for c in ["CR.1", "TRTP.2"])  # unknown id only
    assert out.columns[:5] == ["ISO3", "YEAR", "REGION", "INCOME_GROUP", "CR.1"]
    assert [r["YEAR"] for r in R.wide_order(out).where("ISO3 = 'MDG'").collect()] == [2010, 2011]
