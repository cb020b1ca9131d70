"""Registered queries that go through files: each writes a table derived from the
driver's tables to the shared folder and reads it back with the library's own readers."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicast.operators import coverage_state as CS
from indicast.operators import harmonize as H
from indicast.operators import impute as I
from indicast.operators import metadata as M
from indicast.operators import observed as OB
from indicast.operators import anomaly as A
from indicast.operators import quality as Q
from indicast.operators import reshape as R
from indicast.operators import views as V
from indicast.plans import stages as S
from indicast.plans.oracle_sql import IN_CAT, with_stages
from indicast.plans.queries import _FILTER_REGION, _FILTER_YEARS, ORACLES, register
from indicast.schema import COVERAGE_SCHEMA, INDICATOR_IDS, SOURCE_API, SOURCE_SDMX
from indicast.session import scratch_folder
from indicast.sinks import exports as K
from indicast.sinks import layout as L
from indicast.sinks.versions import Publication
from indicast.sources import feeds
from indicast.sources.large_json import read_large_json
from indicast.sources.testdata import TIE_BREAK, raw_observations

# ---------------------------------------------------------------- exports read back


@register("s1_csv_roundtrip", with_stages("harmonized", "SELECT * FROM harmonized"))
def q_s1(spark, sf):
    """K3 + S1: the harmonised table as ordered header CSV, read back in its schema."""
    path = K.export_csv(S.harmonized(spark, sf), f"{scratch_folder(spark, 'csv')}/long", H.KEY)
    return feeds.read_csv_table(spark, path)


@register("s2_optional_tables", ORACLES["a1_coverage"])
def q_s2(spark, sf):
    """S2 + K1: a stage table that is there, under one that is not."""
    base = scratch_folder(spark, "optional")
    K.write_stage(R.coverage(S.harmonized(spark, sf, materialized=True)), f"{base}/coverage")
    there, absent = (feeds.read_optional(spark, f"{base}/{n}", COVERAGE_SCHEMA) for n in ("coverage", "nowhere"))
    return there.unionByName(absent)


@register("k2_empty_stage", with_stages("harmonized", """
SELECT INDICATOR_ID, ISO3, YEAR, 'harmonized' AS STAGE FROM harmonized"""))
def q_k2(spark, sf):
    """K1/K2: stage tables are written with their columns whether they have rows or not."""
    base, h = scratch_folder(spark, "stages"), S.harmonized(spark, sf, materialized=True)
    K.write_stage(h, f"{base}/harmonized")
    K.write_stage(h.where("ISO3 = 'no such country'"), f"{base}/none")
    tables = [spark.read.parquet(f"{base}/{n}").select("INDICATOR_ID", "ISO3", "YEAR", F.lit(n).alias("STAGE"))
              for n in ("harmonized", "none")]
    return tables[0].unionByName(tables[1])


@register("k4_json_records", with_stages("wide", "SELECT * FROM wide"))
def q_k4_records(spark, sf):
    """K4: the JSON export's records (NULL cells kept), read back."""
    w = S.wide(spark, sf, materialized=True)
    path = K.export_json(w, f"{scratch_folder(spark, 'json')}/wide")
    return spark.read.schema(w.schema).json(f"{path}/records")


@register("k5_bundle", f"SELECT *, 'Coverage,Data' AS TABLES FROM ({ORACLES['a1_coverage']}) AS sub")
def q_k5(spark, sf):
    """K5: a bundle of named tables without its empty one; its coverage read back."""
    h = S.harmonized(spark, sf, materialized=True)
    out = K.write_bundle({"Data": R.pivot_wide(h), "Coverage": R.coverage(h), "Imputation": h.limit(0)},
                         scratch_folder(spark, "bundle"))
    return feeds.read_optional(spark, out["Coverage"], COVERAGE_SCHEMA).withColumn("TABLES", F.lit(",".join(sorted(out))))


@register("k6_all_formats", with_stages("wide", "\nUNION ALL ".join(
    f"SELECT *, '{f}' AS FORMAT FROM wide" for f in ("csv", "json", "parquet"))))
def q_k6(spark, sf):
    """K6: the table in every configured format, each read back."""
    w = S.wide(spark, sf, materialized=True)
    out = K.export_all(w, scratch_folder(spark, "formats"))
    read = {"csv": lambda p: feeds.read_csv_table(spark, p, w.schema),
            "json": lambda p: spark.read.schema(w.schema).json(f"{p}/records"),
            "parquet": lambda p: spark.read.parquet(p)}
    return H.union_feeds(*[read[f](p).withColumn("FORMAT", F.lit(f)) for f, p in out.items()])


@register("k7_filtered_download", with_stages("wide", f"""
SELECT * FROM wide WHERE REGION = '{_FILTER_REGION}' AND YEAR BETWEEN {_FILTER_YEARS[0]} AND {_FILTER_YEARS[1]}"""))
def q_k7(spark, sf):
    """K7: the filtered table as CSV, read back."""
    w = V.filter_table(S.wide(spark, sf), region=_FILTER_REGION, years=_FILTER_YEARS)
    path = K.export_csv(w, f"{scratch_folder(spark, 'download')}/extract", ["ISO3", "YEAR"])
    return feeds.read_csv_table(spark, path, w.schema)


# ---------------------------------------------------------------- landed feed files
# The observations of a source as the files its feed would have landed: a file per
# indicator and block of orders, so that no file grows with the input.

_ORDERS_PER_FILE = 5_000


def _write_files(folder: str):
    def run(batches):
        from pyarrow import fs
        for batch in batches:
            n = 0
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                path = f"{folder}/{name}"
                files, inner = fs.FileSystem.from_uri(
                    path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")
                files.create_dir(os.path.dirname(inner), recursive=True)
                with files.open_output_stream(inner, compression=None) as out:
                    out.write(text.encode())
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])
    return run


def _land(files: DataFrame, folder: str) -> None:
    """Write each row's ``text`` to the file ``name`` in ``folder``."""
    files.select("name", "text").mapInArrow(_write_files(folder), "n long").agg(F.sum("n")).collect()


def _feed_rows(spark: SparkSession, sf: str, source: str) -> DataFrame:
    rows = raw_observations(spark, sf).where(F.col("SOURCE") == source)
    return rows.withColumn("_block", F.floor(F.col("ORD_A") / _ORDERS_PER_FILE))


def _listed(rows: DataFrame, item, *by: str) -> DataFrame:
    """A file's items in their order (a file has at most a block's lines)."""
    order = F.struct(*TIE_BREAK, "ISO3", "YEAR", "VALUE")
    return rows.groupBy("INDICATOR_ID", *by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(order.alias("place"), item.alias("item")))), lambda x: x["item"]).alias("items"))


def _json_item():
    """An observation as JSON, here and there with a text that looks like the end of an element."""
    return F.to_json(F.struct(F.when(F.col("ORD_A") % 3 == 0, F.col("ISO3")).alias("country_id"),
                              F.when(F.col("ORD_A") % 3 != 0, F.col("ISO3")).alias("countryId"),
                              F.col("YEAR").cast("string").alias("year"), F.col("VALUE").cast("string").alias("value"),
                              F.when(F.col("ORD_B") == 1, F.lit('a "}, {" b\\')).alias("qualifier")))


_FEED_SQL = with_stages("raw", """
SELECT INDICATOR_ID, ISO3, YEAR, VALUE, {extra} FROM raw WHERE SOURCE = '{source}'""")
_API_SQL = _FEED_SQL.format(
    source=SOURCE_API, extra="""'' AS MAGNITUDE, CASE WHEN ORD_B = 1 THEN 'a "}, {" b\\' ELSE '' END AS QUALIFIER""")
_FEED_A = ["INDICATOR_ID", "ISO3", "YEAR", "VALUE", "MAGNITUDE", "QUALIFIER"]


@register("s3_json_files", _API_SQL)
def q_s3_files(spark, sf):
    """S3 + S7: landed JSON payload files, read in one go; the indicator is the file's name."""
    files = _listed(_feed_rows(spark, sf, SOURCE_API), _json_item(), "_block").select(
        F.concat(F.lit("block="), "_block", F.lit("/"), "INDICATOR_ID", F.lit(".json")).alias("name"),
        F.concat(F.lit('{"data":['), F.array_join("items", ","), F.lit("]}")).alias("text"))
    base = scratch_folder(spark, "landed-json")
    _land(files, base)
    return feeds.read_json_feed(spark, f"{base}/*/*.json").select(*_FEED_A)


@register("s4_sdmx_files", _FEED_SQL.format(source=SOURCE_SDMX, extra="CASE WHEN ORD_B = 2 THEN 'E' ELSE '' END AS OBS_STATUS"))
def q_s4_files(spark, sf):
    """S4 + S7: landed SDMX files, a series per country, namespaces and all."""
    status = F.when(F.col("ORD_B") == 2, F.lit('<g:Attributes><g:Value id="OBS_STATUS" value="E"/></g:Attributes>')).otherwise("")
    obs = F.concat(F.lit('<g:Obs><g:ObsDimension value="'), F.col("YEAR").cast("string"), F.lit('"/><g:ObsValue value="'),
                   F.coalesce(F.col("VALUE").cast("string"), F.lit("")), F.lit('"/>'), status, F.lit("</g:Obs>"))
    series = _listed(_feed_rows(spark, sf, SOURCE_SDMX).withColumn("_iso3", F.col("ISO3")), obs, "_block", "_iso3").select(
        "INDICATOR_ID", "_block", F.concat(
            F.lit('<g:Series><g:SeriesKey><g:Value id="FREQ" value="A"/><g:Value id="REF_AREA" value="'), "_iso3",
            F.lit('"/></g:SeriesKey>'), F.array_join("items", ""), F.lit("</g:Series>")).alias("text"))
    head = '<?xml version="1.0"?><m:GenericData xmlns:m="urn:m" xmlns:g="urn:g"><m:DataSet>'
    files = series.groupBy("INDICATOR_ID", "_block").agg(F.array_join(F.collect_list("text"), "\n").alias("text")).select(
        F.concat(F.lit("block="), "_block", F.lit("/"), "INDICATOR_ID", F.lit(".xml")).alias("name"),
        F.concat(F.lit(head), "text", F.lit("</m:DataSet></m:GenericData>")).alias("text"))
    base = scratch_folder(spark, "landed-xml")
    _land(files, base)
    return feeds.read_sdmx_xml(spark, f"{base}/*/*.xml").select("INDICATOR_ID", "ISO3", "YEAR", "VALUE", "OBS_STATUS")


def _append_payload(folder: str):
    """One file for each indicator, written as its rows come: no task holds a file."""
    def run(batches):
        from pyarrow import fs
        out, own, n = None, None, 0
        for batch in batches:
            for ind, item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ind != own:
                    if out is not None:
                        out.write(b'], "next": null}')
                        out.close()
                    files, inner = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:")
                                                          else f"file://{os.path.abspath(folder)}")
                    files.create_dir(inner, recursive=True)
                    out, own = files.open_output_stream(f"{inner}/{ind}.json", compression=None), ind
                    out.write(b'{"meta": {"data": [{"countryId": "none"}]},\n "data" : [')
                else:
                    out.write(b",\n")
                out.write(item.encode())
                n += 1
        if out is not None:
            out.write(b'], "next": null}')
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])
    return run


#: Small for the test tables, so that their files are read by many tasks too.
_RANGE_BYTES = 1 << 18


@register("s3_large_json", _API_SQL)
def q_s3_large(spark, sf):
    """S3: one file per indicator, each read by as many tasks as it has byte ranges."""
    base = scratch_folder(spark, "landed-large")
    rows = _feed_rows(spark, sf, SOURCE_API).select("INDICATOR_ID", _json_item().alias("item"), *TIE_BREAK)
    (rows.repartition("INDICATOR_ID").sortWithinPartitions("INDICATOR_ID", *TIE_BREAK).select("INDICATOR_ID", "item")
     .mapInArrow(_append_payload(base), "n long").agg(F.sum("n")).collect())
    found, _ = read_large_json(spark, f"{base}/*.json", range_bytes=_RANGE_BYTES)
    return found.select(*_FEED_A)


# ---------------------------------------------------------------- publication and layout

@register("k1_atomic_publication", with_stages("harmonized", f"""
SELECT *, 'pinned' AS SNAPSHOT FROM harmonized
UNION ALL SELECT *, 'after failure' FROM harmonized
UNION ALL SELECT *, 'latest' FROM harmonized WHERE VALUE IS NOT NULL"""))
def q_k1_atomic(spark, sf):
    """K1/K5: a version is published, a run fails between its tables, the next one is
    published whole; a reader that holds the first version keeps it."""
    h = S.harmonized(spark, sf, materialized=True)
    store = Publication(spark, scratch_folder(spark, "published"))
    pinned = store.publish({"harmonized": h, "coverage": R.coverage(h)})
    broken = h.withColumn("SOURCE", F.when(F.col("YEAR") > 0, F.raise_error(F.lit("lost half way"))).otherwise(F.col("SOURCE")))
    try:
        store.publish({"coverage": R.coverage(h.limit(0)), "harmonized": broken})
        raise AssertionError("the broken run was published")
    except Exception as failed:  # noqa: BLE001 - whatever Spark makes of the task's error
        if "lost half way" not in str(failed):
            raise
    after = store.snapshot()
    store.publish({"harmonized": h.where(F.col("VALUE").isNotNull())})
    at = [("pinned", pinned), ("after failure", after), ("latest", None)]
    return H.union_feeds(*[store.read("harmonized", v).withColumn("SNAPSHOT", F.lit(n)) for n, v in at])


@register("k6_partitioned_roundtrip", with_stages("harmonized", f"""
SELECT INDICATOR_ID, INDICATOR_LABEL, ISO3, YEAR, CASE WHEN YEAR = 2003 THEN -VALUE ELSE VALUE END AS VALUE, SOURCE,
       REGION, INCOME_GROUP FROM harmonized WHERE YEAR BETWEEN 1998 AND 2003 AND INDICATOR_ID IN {IN_CAT}"""))
def q_k6_partitioned(spark, sf):
    """K1/K6: a table in folders by year, sorted by indicator; one year is replaced, the
    others stay; a filter on year and indicator reads only the folders and row groups it needs."""
    h, path = S.harmonized(spark, sf, materialized=True), f"{scratch_folder(spark, 'layout')}/long"
    L.write_partitioned(h, path, ["YEAR"], ["INDICATOR_ID", "ISO3"])
    L.replace_partitions(h.where("YEAR = 2003").withColumn("VALUE", -F.col("VALUE")), path, ["YEAR"], ["INDICATOR_ID", "ISO3"])
    return L.read_partitioned(spark, path, h).where(F.col("YEAR").between(1998, 2003) & F.col("INDICATOR_ID").isin(*INDICATOR_IDS))


# ---------------------------------------------------------------- counters of the writing job

@register("p6_observed_counters", ORACLES["p6_drop_counters"])
def q_p6_observed(spark, sf):
    """What the de-dup and the filters dropped, gathered by the job that writes the harmonised table."""
    n = OB.harmonize_observed(f"{scratch_folder(spark, 'observed')}/harmonized", *S.feed_frames(spark, sf), tie_break=TIE_BREAK)
    return spark.createDataFrame([tuple(n[c] for c in OB.COUNTERS)], ", ".join(f"{c} bigint" for c in OB.COUNTERS))


@register("m4_observed_lineage", ORACLES["m4_lineage_counts"])
def q_m4_observed(spark, sf):
    """M4/M7: the lineage of a run whose stages were counted as they were written."""
    base, counts = scratch_folder(spark, "lineage"), {}

    def write(step: int, df: DataFrame) -> DataFrame:
        counts[step] = OB.write_observed(df, f"{base}/{step}").get("N_ROWS", 0)
        return spark.read.schema(df.schema).parquet(f"{base}/{step}")

    api, sdmx = (write(i + 1, f) for i, f in enumerate(S.feed_frames(spark, sf)))
    h = write(3, H.harmonize(api, sdmx, tie_break=TIE_BREAK))
    w = write(4, R.pivot_wide(h))
    write(5, Q.run_checks(h))
    write(6, A.detect_anomalies(h))
    write(7, I.impute_wide(w))
    told = spark.createDataFrame(sorted(counts.items()), "STEP int, N_ROWS bigint")
    return M.process_history(M.lineage(spark, told)).drop("TIMESTAMP")


# ---------------------------------------------------------------- coverage without a re-read

@register("a1_coverage_bitmaps", ORACLES["a1_coverage"])
def q_a1_bitmaps(spark, sf):
    """A1/A2: coverage from per-file bitmaps: two files of either source come one after the
    other, one of them twice; the state is all that is read for the result."""
    base = f"{scratch_folder(spark, 'coverage')}/state"
    orders = raw_observations(spark, sf).select(F.percentile_approx("ORD_A", 0.5)).first()[0]
    half = F.when(F.col("ORD_A") <= orders, F.lit("1")).otherwise(F.lit("2"))
    for i, feed in enumerate([*S.feed_frames(spark, sf), S.feed_frames(spark, sf)[0]]):
        named = feed.withColumn("FILE_ID", F.concat_ws("-", "SOURCE", half))
        for part in (["2"] if i == 2 else ["2", "1"]):  # in no particular order
            state = CS.file_state(named.where(half == part), TIE_BREAK)
            L.replace_partitions(state, base, ["FILE_ID"])
    return CS.coverage_from_state(L.read_partitioned(spark, base, state))
