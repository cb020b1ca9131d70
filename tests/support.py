"""Paths and fixtures shared by the tests."""

from indicast.schema import COUNTRIES, HARMONIZED_COLS

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
PLACES = {iso: (region, income) for iso, region, income in COUNTRIES}


def panel(indicator="ROFST.2", countries=("KEN", "BRA", "FRA"), years=range(2004, 2008), scale=1.0):
    """A complete country-year panel of one indicator as dictionaries; the value
    is (10 * place of the country + place of the year + 5) * scale."""
    return [dict(zip(HARMONIZED_COLS, (indicator, "any label", iso, year, (10 * i + j + 5) * scale, "UIS_SDMX", *PLACES[iso])))
            for i, iso in enumerate(countries) for j, year in enumerate(years)]
