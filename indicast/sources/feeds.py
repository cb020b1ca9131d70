"""Readers for landed feed files.

Network fetching is out of scope: the feeds are read from files already
landed on the shared file system. Every reader takes a path or glob, so one
call reads many files in parallel (S7 "stack per-indicator frames" is just a
multi-file read); one file is parsed by one task.

Parsing is a function on a column (``parse_payload``, ``parse_series``), so
documents may also come from a table. Each returns the observation rows and,
as a second frame, the documents that could not be parsed: nothing vanishes.
Rows carry FILE and POS (their place in the feed), the tie-break by which the
first record within a source wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, StringType, StructField, StructType,
)
from pyspark.errors import AnalysisException

from indicast.functions.scalars import label_of, lenient_double, lenient_int, qcol
from indicast.schema import HARMONIZED_SCHEMA

# ---------------------------------------------------------------- S1 / S2

POSITION = ["FILE", "POS"]


def read_csv_table(spark: SparkSession, path: str, schema: StructType = HARMONIZED_SCHEMA,
                   with_position: bool = False) -> DataFrame:
    """Header CSV in the columns of ``schema``.

    Cells are read as text and parsed leniently, so ``2010.0`` and `` 2011 ``
    are years; empty text is NULL. ``with_position`` adds FILE and POS: splits
    of a file are ordered by their start, rows within a split by their number."""
    text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    raw = spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE").csv(path)
    if with_position:
        raw = raw.withColumns({
            "FILE": F.concat_ws("#", "_metadata.file_path", F.lpad(F.col("_metadata.file_block_start").cast("string"), 19, "0")),
            "POS": F.monotonically_increasing_id()})
    parse = {"int": lenient_int, "double": lenient_double}
    cols = [parse.get(f.dataType.simpleString(), lambda c: c)(qcol(f.name)).alias(f.name) for f in schema.fields]
    return raw.select(*cols, *(POSITION if with_position else []))


def read_optional(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A report table that may be absent: missing path -> empty table."""
    try:
        reader = spark.read.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", True)
        df = reader.format(fmt).load(path)
        df.schema  # noqa: B018 - resolve now so a missing path surfaces here
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


# ---------------------------------------------------------------- S3

_OBS = StructType([
    StructField("countryId", StringType()), StructField("country_id", StringType()),
    StructField("year", StringType()), StructField("value", StringType()),
    StructField("magnitude", StringType()), StructField("qualifier", StringType()),
])
JSON_PAYLOAD_SCHEMA = StructType([StructField("data", ArrayType(_OBS))])


def _id_from_file(ext: str):
    """Indicator id taken from the landed file name (``CR.1.json`` -> ``CR.1``)."""
    return F.regexp_extract("FILE", r"([^/]+)\." + ext + "$", 1)


def _split_parsed(parsed: DataFrame, text: str, keep: list[str]) -> DataFrame:
    return parsed.where(F.col("_doc").isNull()).select(*keep, F.col(text).alias("DOCUMENT"))


def parse_payload(docs: DataFrame, text: str, ind: Column, keep: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """S3 + S6: JSON payloads ``{"data": [...]}`` in column ``text`` -> feed-A
    rows, and the documents without a readable ``data`` array.

    Country key falls back from ``countryId`` to ``country_id`` to ''; YEAR and
    VALUE are parsed leniently; magnitude/qualifier default to ''. ``ind`` is
    the indicator id; the label comes from the catalogue (unknown id -> NULL)."""
    keep = list(keep)
    doc = F.from_json(F.col(text), JSON_PAYLOAD_SCHEMA, {"mode": "PERMISSIVE"})
    parsed = docs.select(*keep, text, ind.alias("_ind"), doc["data"].alias("_doc"))
    rows = parsed.select(*keep, "_ind", F.posexplode("_doc").alias("POS", "o"))
    return observation_columns(rows, keep), _split_parsed(parsed, text, keep)


def observation_columns(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Feed-A rows of parsed observations ``o`` with their id ``_ind`` and place ``POS``."""
    return rows.select(
        F.col("_ind").alias("INDICATOR_ID"),
        F.coalesce("o.countryId", "o.country_id", F.lit("")).alias("ISO3"),
        lenient_int("o.year").alias("YEAR"),
        lenient_double("o.value").alias("VALUE"),
        F.coalesce("o.magnitude", F.lit("")).alias("MAGNITUDE"),
        F.coalesce("o.qualifier", F.lit("")).alias("QUALIFIER"),
        label_of(F.col("_ind")).alias("INDICATOR_LABEL"),
        *keep, F.col("POS").cast("bigint").alias("POS"))


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: FILE and its whole text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("_text"), F.col("_metadata.file_path").alias("FILE"))


def read_json_feed(spark: SparkSession, path: str, indicator_id: str | None = None) -> DataFrame:
    """S3: landed JSON files, one payload each -> feed-A rows with FILE and POS."""
    return read_json_documents(spark, path, indicator_id)[0]


def read_json_documents(spark: SparkSession, path: str, indicator_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """As :func:`read_json_feed`, with the unreadable documents as a second frame."""
    ind = F.lit(indicator_id) if indicator_id is not None else _id_from_file("json")
    return parse_payload(_documents(spark, path), "_text", ind, ["FILE"])


# ---------------------------------------------------------------- S4

_KV = StructType([StructField("_id", StringType()), StructField("_value", StringType())])
SDMX_SERIES_SCHEMA = StructType([
    StructField("SeriesKey", StructType([StructField("Value", ArrayType(_KV))])),
    StructField("Obs", ArrayType(StructType([
        StructField("ObsDimension", StructType([StructField("_value", StringType())])),
        StructField("ObsValue", StructType([StructField("_value", StringType())])),
        StructField("Attributes", StructType([StructField("Value", ArrayType(_KV))])),
    ]))),
    StructField("_corrupt_record", StringType()),
])


def _key(values_col: str, key: str):
    """Value of the first SeriesKey entry with ``_id == key`` (NULL if none)."""
    return F.get(F.filter(values_col, lambda v: v["_id"] == key), 0)["_value"]


def series_rows(series: DataFrame, ind: Column, keep: list[str] = ()) -> DataFrame:
    """Feed-B rows (one per Obs) of parsed series in column ``s``: the country is
    the REF_AREA key, else COUNTRY, else ''; OBS_STATUS defaults to ''."""
    keep = list(keep)
    rows = series.select(
        *keep, ind.alias("_ind"),
        F.coalesce(_key("s.SeriesKey.Value", "REF_AREA"), _key("s.SeriesKey.Value", "COUNTRY"), F.lit("")).alias("_iso3"),
        F.posexplode("s.Obs").alias("_n", "o"))
    return rows.select(
        F.col("_ind").alias("INDICATOR_ID"),
        F.col("_iso3").alias("ISO3"),
        lenient_int(F.coalesce("o.ObsDimension._value", F.lit(""))).alias("YEAR"),
        lenient_double(F.coalesce("o.ObsValue._value", F.lit(""))).alias("VALUE"),
        F.coalesce(_key("o.Attributes.Value", "OBS_STATUS"), F.lit("")).alias("OBS_STATUS"),
        label_of(F.col("_ind")).alias("INDICATOR_LABEL"),
        *keep, F.col("_n").cast("bigint").alias("_n"),
    )


def parse_series(docs: DataFrame, text: str, ind: Column, keep: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """S4 + S6: one SDMX ``Series`` element per row of column ``text`` -> feed-B
    rows, and the elements that do not parse."""
    keep = list(keep)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "rowTag": "Series", "ignoreNamespace": "true"}
    # Made by a generator, the parsed element is kept: a filter on it would parse the text again.
    parsed = docs.select(*keep, text, ind.alias("_ind"),
                         F.explode(F.array(F.from_xml(F.col(text), SDMX_SERIES_SCHEMA, options))).alias("s"))
    parsed = parsed.withColumn("_doc", F.when(F.col("s._corrupt_record").isNull(), F.col("s")))
    good = parsed.where(F.col("_doc").isNotNull())
    rows = series_rows(good.select(*keep, "_ind", "s"), F.col("_ind"), keep)
    return rows.withColumnRenamed("_n", "POS"), _split_parsed(parsed, text, keep)


def read_sdmx_xml(spark: SparkSession, path: str, indicator_id: str | None = None) -> DataFrame:
    """S4 + S6: SDMX 2.1 generic-data XML files -> feed-B rows with FILE and POS."""
    return read_sdmx_documents(spark, path, indicator_id)[0]


def read_sdmx_documents(spark: SparkSession, path: str, indicator_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """As :func:`read_sdmx_xml`, with the series that do not parse as a second
    frame (FILE, DOCUMENT). Namespaces are ignored, so ``Series`` is the row tag."""
    raw = (spark.read.format("xml").option("rowTag", "Series").option("ignoreNamespace", True)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
           .schema(SDMX_SERIES_SCHEMA).load(path)
           .select(F.struct(*[f.name for f in SDMX_SERIES_SCHEMA.fields]).alias("s"), F.col("_metadata.file_path").alias("FILE")))
    ind = F.lit(indicator_id) if indicator_id is not None else _id_from_file("xml")
    rows = series_rows(raw.where(F.col("s._corrupt_record").isNull()), ind, ["FILE"])
    # A file is parsed by one task, in its order.
    rows = rows.withColumn("POS", F.monotonically_increasing_id()).drop("_n")
    # The scan must read a data column beside the corrupt record.
    document = F.coalesce("s._corrupt_record", F.to_json("s.SeriesKey"))
    return rows, raw.where(F.col("s._corrupt_record").isNotNull()).select("FILE", document.alias("DOCUMENT"))


# ---------------------------------------------------------------- S5

def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The exported metadata registry (one JSON document per file)."""
    return spark.read.option("multiLine", True).json(path)
