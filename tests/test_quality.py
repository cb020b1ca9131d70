"""The quality rules, one table of cases per rule, and the QA summary."""

import pytest
from support import panel

from indicast.operators import quality as Q
from indicast.schema import INDICATOR_IDS


def with_cells(rows, *edits):
    """Copies of the rows with (row number, column, value) edits."""
    out = [dict(r) for r in rows]
    for i, column, value in edits:
        out[i][column] = value
    return out


RATE, PARITY = panel(), panel("GPIA.CR.2", scale=0.05)
RANGE = "OUT_OF_RANGE"
RULES = {"range": Q.check_value_range, "dup": Q.check_duplicates, "year": Q.check_year_range, "iso3": Q.check_missing_iso3}
CASES = [
    # rule, rows, number of flagged rows
    ("range", RATE, 0), ("range", PARITY, 0),
    ("range", with_cells(RATE, (5, "VALUE", 100.01)), 1), ("range", with_cells(RATE, (2, "VALUE", -0.01)), 1),
    ("range", with_cells(RATE, (0, "VALUE", 250.0), (7, "VALUE", -3.0), (9, "VALUE", float("inf"))), 3),
    ("range", with_cells(RATE, (0, "VALUE", 0.0), (1, "VALUE", 100.0), (2, "VALUE", None)), 0),
    ("range", with_cells(PARITY, (0, "VALUE", 2.5), (1, "VALUE", 0.0)), 0), ("range", with_cells(PARITY, (4, "VALUE", 2.51)), 1),
    ("range", with_cells(RATE, (0, "INDICATOR_ID", None), (0, "VALUE", 900.0)), 0),
    ("dup", RATE, 0), ("dup", RATE + RATE[3:5], 4), ("dup", RATE + RATE[:1] + RATE[:1], 3), ("dup", RATE + PARITY, 0),
    ("dup", with_cells(RATE, (0, "ISO3", None), (1, "ISO3", None), (1, "YEAR", 2004)), 2),
    ("dup", RATE + with_cells(RATE[:1], (0, "SOURCE", "UIS_API"), (0, "VALUE", None)), 2),
    ("year", RATE, 0), ("year", with_cells(RATE, (0, "YEAR", 2000), (1, "YEAR", 2030)), 0),
    ("year", with_cells(RATE, (0, "YEAR", 1999), (1, "YEAR", 2031), (2, "YEAR", None)), 2),
    ("iso3", RATE, 0), ("iso3", with_cells(RATE, (0, "ISO3", None), (1, "ISO3", ""), (2, "ISO3", " \t\u00a0")), 3),
    ("iso3", with_cells(RATE, (0, "ISO3", "not a code")), 0),
]


@pytest.mark.parametrize("rule,rows,flagged", CASES)
def test_rule(make_df, rule, rows, flagged):
    df = make_df(rows)
    out = RULES[rule](df)
    assert out.columns == [*df.columns, "QA_FLAG", "QA_DETAIL"]
    assert out.count() == flagged


def test_range_details_name_the_bounds(make_df):
    rows = with_cells(RATE, (0, "VALUE", 101.0)) + with_cells(PARITY, (0, "VALUE", 3.0)) + with_cells(
        RATE[:1], (0, "INDICATOR_ID", "OTHER.7"), (0, "VALUE", -1.0))
    details = sorted(r["QA_DETAIL"] for r in Q.check_value_range(make_df(rows)).collect())
    assert details == ["VALUE outside [0.0, 100.0] for OTHER.7", "VALUE outside [0.0, 100.0] for ROFST.2",
                       "VALUE outside [0.0, 2.5] for GPIA.CR.2"]


@pytest.mark.parametrize("missing,detail", [
    (0, None), (3, None), (4, "33.3% missing (threshold 30.0%)"), (12, "100.0% missing (threshold 30.0%)")])
def test_missing_rate_of_a_panel(make_df, missing, detail):
    # 3 countries x 4 years: up to 30 % may be missing.
    rows = with_cells(RATE, *[(i, "VALUE", None) for i in range(missing)])
    out = {r["INDICATOR_ID"]: r for r in Q.check_missing_rate(make_df(rows)).collect()}
    assert set(out) == set(INDICATOR_IDS) - ({"ROFST.2"} if detail is None else set())
    if detail:
        r = out["ROFST.2"]
        assert (r["QA_DETAIL"], r["ISO3"], r["YEAR"], r["VALUE"]) == (detail, "ALL", None, None)


def test_missing_rate_rounds_halves_to_even(make_df):
    rows = panel(countries=("KEN", "BRA", "FRA", "IND"), years=range(2004, 2008))  # 16 cells: 5 missing are 31.25 %
    rows = with_cells(rows, *[(i, "VALUE", None) for i in range(5)])
    out = {r["INDICATOR_ID"]: r["QA_DETAIL"] for r in Q.check_missing_rate(make_df(rows)).collect()}
    assert out["ROFST.2"] == "31.2% missing (threshold 30.0%)"


SUMMARY = {
    "PASS": RATE,
    "FAIL": with_cells(RATE, (0, "VALUE", 200.0)),
    "WARN_MISSING": with_cells(RATE, *[(i, "VALUE", None) for i in range(6)]),
    "WARN_MISSING|FAIL": with_cells(RATE, (11, "YEAR", 1990), *[(i, "VALUE", None) for i in range(9)]),
}


@pytest.mark.parametrize("status", SUMMARY)
@pytest.mark.parametrize("from_flags", [True, False])
def test_summary_statuses_and_counts(make_df, status, from_flags):
    df = make_df(SUMMARY[status])
    row_rules = Q.row_flags(df) if from_flags else None  # without the missing-rate rows
    s = {r["INDICATOR_ID"]: r for r in Q.qa_summary(df, row_rules).collect()}
    assert list(sorted(s)) == sorted(INDICATOR_IDS)
    r = s["ROFST.2"]
    flags = {"PASS": 0, "FAIL": 1, "WARN_MISSING": 0, "WARN_MISSING|FAIL": 1}[status]
    if from_flags:
        assert (r["QA_STATUS"], r["N_FLAGGED"]) == (status, flags)
    else:
        assert r["N_FLAGGED"] == flags + ("WARN" in status)
    assert r["N_MISSING"] == r["N_EXPECTED"] - r["N_VALID"]


def test_counted_summary_equals_the_one_from_flag_rows(make_df):
    rows = SUMMARY["WARN_MISSING|FAIL"] + PARITY + PARITY[:2] + with_cells(RATE[:2], (0, "ISO3", " "), (1, "VALUE", -9.0), (1, "YEAR", 1900))
    df = make_df(rows)
    flags = Q.run_checks(df)
    assert sorted(Q.qa_summary(df).collect()) == sorted(Q.qa_summary(df, flags).collect())
    tally = Q.pass_tally(Q.qa_summary(df), flags).first()
    assert (tally["N_INDICATORS"], tally["N_FLAGGED_ROWS"]) == (11, flags.count())


def test_a_row_that_breaks_two_rules_is_flagged_twice(make_df):
    flags = [r["QA_FLAG"] for r in Q.run_checks(make_df(with_cells(RATE, (3, "VALUE", 300.0), (3, "YEAR", 2050)))).collect()]
    assert flags.count(RANGE) == flags.count("IMPLAUSIBLE_YEAR") == 1
    assert flags.count("HIGH_MISSING_RATE") == len(INDICATOR_IDS) - 1  # 12 of 15 cells are there
