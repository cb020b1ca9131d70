"""DuckDB SQL for the correctness oracles.

The SQL is written independently of the Spark code: it restates each
operator's semantics with window functions and CASE aggregates over the
driver's parquet views. Shared CTEs build the same stage tables.
"""

from __future__ import annotations

from indicast.schema import COUNTRIES, INDICATORS, QA
from indicast.sources.testdata import DIRTY_SQL, RAW_SQL


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else repr(v) for v in r) + ")"
                     for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


CAT_VALUES = _values([(i, k, v) for i, (k, v) in enumerate(INDICATORS)],
                     ["CAT_POS", "INDICATOR_ID", "INDICATOR_LABEL"])
COUNTRY_VALUES = _values(COUNTRIES, ["ISO3", "REGION", "INCOME_GROUP"])
IND_IDS = [k for k, _ in INDICATORS]
IN_CAT = "(" + ", ".join(_q(i) for i in IND_IDS) + ")"
IN_COUNTRY = "(" + ", ".join(_q(c) for c, _, _ in COUNTRIES) + ")"


def dq(name: str) -> str:
    return '"' + name + '"'


CTE_RAW = f"raw AS ({RAW_SQL})"
CTE_LONG = """long AS (
  SELECT r.INDICATOR_ID, c.INDICATOR_LABEL, r.ISO3, r.YEAR, r.VALUE, r.SOURCE, r.ORD_A, r.ORD_B
  FROM raw r LEFT JOIN cat c ON c.INDICATOR_ID = r.INDICATOR_ID)"""
CTE_CAT = f"cat AS (SELECT * FROM {CAT_VALUES})"
CTE_COUNTRY = f"country AS (SELECT * FROM {COUNTRY_VALUES})"
CTE_DEDUP = """dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY INDICATOR_ID, ISO3, YEAR
                                 ORDER BY SOURCE, ORD_A, ORD_B, VALUE NULLS LAST) AS rn
    FROM long) WHERE rn = 1)"""
CTE_HARM = f"""harmonized AS (
  SELECT d.INDICATOR_ID, d.INDICATOR_LABEL, d.ISO3, d.YEAR, d.VALUE, d.SOURCE, k.REGION, k.INCOME_GROUP
  FROM dedup d LEFT JOIN country k ON k.ISO3 = d.ISO3
  WHERE d.ISO3 IN {IN_COUNTRY} AND d.YEAR BETWEEN {QA.year_min} AND {QA.year_max})"""
_pivot_cols = ",\n  ".join(
    f"max(CASE WHEN INDICATOR_ID = {_q(i)} THEN VALUE END) AS {dq(i)}" for i in IND_IDS)
CTE_WIDE = f"""wide AS (
  SELECT ISO3, YEAR, REGION, INCOME_GROUP,
  {_pivot_cols}
  FROM harmonized
  WHERE VALUE IS NOT NULL AND ISO3 IS NOT NULL AND YEAR IS NOT NULL
    AND REGION IS NOT NULL AND INCOME_GROUP IS NOT NULL
  GROUP BY ISO3, YEAR, REGION, INCOME_GROUP)"""

_CTES = {
    "cat": CTE_CAT, "country": CTE_COUNTRY, "raw": CTE_RAW, "long": CTE_LONG,
    "dedup": CTE_DEDUP, "harmonized": CTE_HARM, "wide": CTE_WIDE,
}
_ORDER = ["cat", "country", "raw", "long", "dedup", "harmonized", "wide"]


def with_stages(upto: str, body: str, extra: list[str] | None = None, dirty: bool = False) -> str:
    """Prefix ``body`` with the stage CTEs needed up to ``upto``, over the plain or the dirty mapping."""
    names = _ORDER[: _ORDER.index(upto) + 1]
    ctes = [f"raw AS ({DIRTY_SQL})" if dirty and n == "raw" else _CTES[n] for n in names] + list(extra or [])
    return "WITH " + ",\n".join(ctes) + "\n" + body


# Harmonised and wide tables keyed by supplier instead of country.
CTE_SUPPLIER_HARM = f"""sraw AS ({RAW_SQL.replace("SELECT", "SELECT 'S' || s_suppkey AS ENTITY,", 1)}),
harmonized AS (
  SELECT d.INDICATOR_ID, c.INDICATOR_LABEL, d.ENTITY AS ISO3, d.YEAR, d.VALUE, d.SOURCE, k.REGION, k.INCOME_GROUP
  FROM (SELECT *, row_number() OVER (PARTITION BY INDICATOR_ID, ENTITY, YEAR
                                     ORDER BY SOURCE, ORD_A, ORD_B, VALUE NULLS LAST) AS rn FROM sraw) d
  LEFT JOIN country k ON k.ISO3 = d.ISO3 LEFT JOIN cat c ON c.INDICATOR_ID = d.INDICATOR_ID
  WHERE rn = 1 AND d.YEAR BETWEEN {QA.year_min} AND {QA.year_max})"""


def with_supplier_stages(upto: str, body: str) -> str:
    ctes = [CTE_CAT, CTE_COUNTRY, CTE_SUPPLIER_HARM] + ([CTE_WIDE] if upto == "wide" else [])
    return "WITH " + ",\n".join(ctes) + "\n" + body


GPI_IN = "(" + ", ".join(_q(i) for i in IND_IDS if "GPIA" in i) + ")"


def knn_ctes(k: int = 5, block: str | list[str] | None = None) -> str:
    """CTEs (to append after the ``wide`` stage) that produce ``knn_filled``:
    every wide row with missing cells filled by the k-NN rule, before clip."""
    cols = IND_IDS
    ss = " + ".join(
        f"CASE WHEN r.{dq(c)} IS NOT NULL AND d.{dq(c)} IS NOT NULL "
        f"THEN (r.{dq(c)} - d.{dq(c)}) * (r.{dq(c)} - d.{dq(c)}) ELSE 0 END" for c in cols)
    nc = " + ".join(
        f"CASE WHEN r.{dq(c)} IS NOT NULL AND d.{dq(c)} IS NOT NULL THEN 1 ELSE 0 END" for c in cols)
    any_null = " OR ".join(f"r.{dq(c)} IS NULL" for c in cols)
    cells = "\n  UNION ALL ".join(
        f"SELECT ISO3, YEAR, {i} AS j, {dq(c)} AS v FROM wide" for i, c in enumerate(cols))
    blocks = [block] if isinstance(block, str) else block or []
    blk = "".join(f" AND r.{b} = d.{b}" for b in blocks)
    piv = ",\n    ".join(
        f"max(CASE WHEN f.j = {i} THEN f.v END) AS {dq(c)}" for i, c in enumerate(cols))
    return f"""
, cells AS ({cells}),
pairs AS (
  SELECT r.ISO3 AS r_iso3, r.YEAR AS r_year, d.ISO3 AS d_iso3, d.YEAR AS d_year,
         ({ss}) AS ss, ({nc}) AS nc
  FROM wide r JOIN wide d ON NOT (r.ISO3 = d.ISO3 AND r.YEAR = d.YEAR){blk}
  WHERE ({any_null})),
miss AS (SELECT ISO3, YEAR, j FROM cells WHERE v IS NULL),
cand AS (
  SELECT m.ISO3, m.YEAR, m.j, c.v, round(p.ss / p.nc, 9) AS dd, p.d_iso3, p.d_year
  FROM miss m
  JOIN pairs p ON p.r_iso3 = m.ISO3 AND p.r_year = m.YEAR
  JOIN cells c ON c.ISO3 = p.d_iso3 AND c.YEAR = p.d_year AND c.j = m.j
  WHERE c.v IS NOT NULL AND p.nc > 0),
topk AS (
  SELECT ISO3, YEAR, j, avg(v) AS iv FROM (
    SELECT *, row_number() OVER (PARTITION BY ISO3, YEAR, j ORDER BY dd, d_iso3, d_year) AS rn
    FROM cand) WHERE rn <= {k} GROUP BY ISO3, YEAR, j),
colmean AS (SELECT j, avg(v) AS mv FROM cells GROUP BY j),
filled AS (
  SELECT c.ISO3, c.YEAR, c.j, coalesce(c.v, t.iv, cm.mv) AS v
  FROM cells c LEFT JOIN topk t ON t.ISO3 = c.ISO3 AND t.YEAR = c.YEAR AND t.j = c.j
  LEFT JOIN colmean cm ON cm.j = c.j),
knn_filled AS (
  SELECT w.ISO3, w.YEAR, w.REGION, w.INCOME_GROUP,
    {piv}
  FROM wide w JOIN filled f ON f.ISO3 = w.ISO3 AND f.YEAR = w.YEAR
  GROUP BY w.ISO3, w.YEAR, w.REGION, w.INCOME_GROUP)"""


def clip_round_select(src: str) -> str:
    """SELECT that clips every indicator column of ``src`` and rounds to 4."""
    parts = []
    for c in IND_IDS:
        lo, hi = (QA.gpi_min, QA.gpi_max) if "GPIA" in c else (QA.rate_min, QA.rate_max)
        parts.append(f"round(greatest({lo}, least({hi}, {dq(c)})), 4) AS {dq(c)}")
    return f"SELECT ISO3, YEAR, REGION, INCOME_GROUP, {', '.join(parts)} FROM {src}"


def audit_select(src: str, label: str) -> str:
    """A5 audit of ``src`` as UNION ALL rows."""
    return "\nUNION ALL ".join(
        f"SELECT {_q(c)} AS INDICATOR_ID, {i} AS POS, {_q(label)} AS LABEL, "
        f"CAST(count(*) AS BIGINT) AS N_TOTAL, CAST(count(*) - count({dq(c)}) AS BIGINT) AS N_MISSING, "
        f"CAST(CASE WHEN count(*) > 0 THEN round((count(*) - count({dq(c)})) / count(*) * 100, 2) "
        f"ELSE 0 END AS DOUBLE) AS PCT_MISSING FROM {src}"
        for i, c in enumerate(IND_IDS))
