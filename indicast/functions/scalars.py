"""Column expressions shared by the operators.

All helpers return JVM-side ``Column`` expressions so they stay inside
whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType, StringType

from indicast.schema import GPI_IDS, INDICATOR_LABELS, QA

# Every character Python's str.strip() removes (str.isspace), derived by rule.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def qcol(name: str) -> Column:
    """Reference a column whose name may contain dots (``CR.1``)."""
    return F.col(f"`{name}`")


def strip_ws(c: str | Column) -> Column:
    """Remove leading/trailing whitespace of every kind (plain ``trim`` only
    drops spaces); a character-set trim, cheaper than a regular expression."""
    return F.trim(col_of(c).cast(StringType()), F.lit(WHITESPACE))


def strip_upper(c: str | Column) -> Column:
    return F.upper(strip_ws(c))


def nan_to_null(c: Column) -> Column:
    """NULL is the only missing marker: NaN is turned into NULL."""
    return F.nullif(c, F.lit(float("nan")))


def lenient_double(c: str | Column, dtype=None) -> Column:
    """Parse to double; unparsable text and NaN become NULL, 'inf' stays inf."""
    c = col_of(c)
    if dtype is not None and isinstance(dtype, NumericType):
        return nan_to_null(c.cast("double"))
    return nan_to_null(strip_ws(c).try_cast("double"))


def lenient_int(c: str | Column, dtype=None) -> Column:
    """Parse to int; non-integral or unparsable values become NULL."""
    if dtype is not None and isinstance(dtype, IntegralType):
        return col_of(c).try_cast("int")
    c = col_of(c)
    d = c.cast("double") if isinstance(dtype, NumericType) else strip_ws(c).try_cast("double")
    # As the variable of a function the number is parsed once; NaN equals no whole number.
    return F.get(F.transform(F.array(d), lambda x: F.when((x == F.floor(x)) & (F.abs(x) < 2147483648.0), x.cast("int"))), 0)


def clip(c: Column, lo: float, hi: float) -> Column:
    """Clip that keeps NULL as NULL (``greatest``/``least`` skip NULLs)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def is_gpi(ind: str | Column) -> Column:
    """Parity-index indicators: the catalogue ids marked as parity indices."""
    return col_of(ind).isin(*GPI_IDS)


def range_lo(ind: str | Column) -> Column:
    return F.when(is_gpi(ind), F.lit(QA.gpi_min)).otherwise(F.lit(QA.rate_min))


def range_hi(ind: str | Column) -> Column:
    return F.when(is_gpi(ind), F.lit(QA.gpi_max)).otherwise(F.lit(QA.rate_max))


def label_of(ind: str | Column) -> Column:
    """Catalogue label lookup as a literal map; unknown id gives NULL."""
    kv = []
    for k, v in INDICATOR_LABELS.items():
        kv += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*kv), col_of(ind))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """round(num / den * 100, digits), 0.0 when the denominator is 0."""
    return F.when(den > 0, F.round(num / den * 100.0, digits)).otherwise(F.lit(0.0))


def status_class(status: str | Column) -> Column:
    """PASS -> ok, anything containing WARN -> warn, else fail."""
    s = col_of(status)
    return (F.when(s == "PASS", F.lit("ok"))
            .when(s.contains("WARN"), F.lit("warn"))
            .otherwise(F.lit("fail")))
