"""Staged run of the whole flow over landed feed files.

Each stage reads the previous stage's table and writes its own as Parquet
under ``base`` (a shared folder on a cluster), so stages can run separately,
be re-run after a failure, and are never recomputed by later stages:

  ingest    raw_api, raw_sdmx          (S3, S4 / S1 CSV)
  harmonize harmonized                 (P1-P6, U1, W1, J1)
  merge     coverage, wide             (A1, A14)
  validate  qa_summary, qa_flagged     (C1-C6, A2-A4; flags written even if empty)
  anomaly   scored, anomaly_report, anomaly_summary (N1-N6, A7, P12, O3)
  impute    imputed, imputation_report (I1-I4, A5, A6)
  metadata  registry, lineage          (M1-M8, real stage counts)
  export    exports/{csv,json,parquet}, bundle/{Data,Coverage,Imputation,Metadata} (K3-K6)
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from indicast.operators import anomaly as A
from indicast.operators import harmonize as H
from indicast.operators import impute as I
from indicast.operators import metadata as M
from indicast.operators import quality as Q
from indicast.operators import reshape as R
from indicast.schema import (
    COVERAGE_SCHEMA, FEED_A_SCHEMA, FEED_B_SCHEMA, IMPUTE, SOURCE_API, SOURCE_SDMX,
)
from indicast.sinks import exports as K
from indicast.sources import feeds


@dataclass
class StagedRun:
    """Stages are found by their path under ``base``: any stage can run in a new
    object, a new session or after a failure."""

    spark: SparkSession
    base: str
    written: dict[str, str] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        self.written[name] = K.write_stage(df, self.path(name))
        return self.spark.read.parquet(self.path(name))

    def find(self, name: str) -> DataFrame | None:
        """The stage's table, or None if it has not been written."""
        try:
            return self.spark.read.parquet(self.path(name))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise

    def table(self, name: str) -> DataFrame:
        found = self.find(name)
        if found is None:
            raise FileNotFoundError(f"stage table {name!r} is not under {self.base}; run the stage that writes it first")
        return found

    # ------------------------------------------------------------ stages

    def ingest(self, api: str | None = None, sdmx: str | None = None,
               api_csv: str | None = None, sdmx_csv: str | None = None) -> None:
        """Parse landed feed files (JSON / XML, or already-flat CSV) into raw
        tables with FILE and POS; what cannot be parsed goes to ``unparsed``."""
        broken = []
        if api or api_csv:
            if api:
                a, bad = feeds.read_json_documents(self.spark, api)
                broken.append(bad)
            else:
                a = feeds.read_csv_table(self.spark, api_csv, FEED_A_SCHEMA, with_position=True)
            self._write("raw_api", a)
        if sdmx or sdmx_csv:
            if sdmx:
                b, bad = feeds.read_sdmx_documents(self.spark, sdmx)
                broken.append(bad)
            else:
                b = feeds.read_csv_table(self.spark, sdmx_csv, FEED_B_SCHEMA, with_position=True)
            self._write("raw_sdmx", b)
        if broken:
            self._write("unparsed", H.union_feeds(*broken))

    def harmonize(self, extra: bool = False, prefer_non_null: bool = False) -> DataFrame:
        """``extra`` carries MAGNITUDE, QUALIFIER and OBS_STATUS along."""
        parts, carried = [], []
        for name, source, columns in (("raw_api", SOURCE_API, ["MAGNITUDE", "QUALIFIER"]),
                                      ("raw_sdmx", SOURCE_SDMX, ["OBS_STATUS"])):
            raw = self.find(name)
            if raw is not None:
                columns = columns if extra else []
                carried += columns
                parts.append(H.enforce_schema(raw, source_name=source, extra_cols=[*feeds.POSITION, *columns]))
        if not parts:
            raise FileNotFoundError(f"neither raw_api nor raw_sdmx is under {self.base}; run ingest first")
        return self._write("harmonized", H.harmonize(*parts, tie_break=feeds.POSITION, prefer_non_null=prefer_non_null,
                                                     extra_cols=carried))

    def merge(self) -> tuple[DataFrame, DataFrame]:
        h = self.table("harmonized")
        return self._write("coverage", R.coverage(h)), self._write("wide", R.pivot_wide(h))

    def validate(self) -> tuple[DataFrame, DataFrame]:
        h = self.table("harmonized")
        flagged = self._write("qa_flagged", Q.run_checks(h))
        return self._write("qa_summary", Q.qa_summary(h, flagged)), flagged

    def anomaly(self) -> DataFrame:
        scored = self._write("scored", A.detect_anomalies(self.table("harmonized")))
        self._write("anomaly_report", A.anomaly_report(scored))
        self._write("anomaly_summary", A.anomaly_summary(scored))
        return scored

    def impute(self, method: str = IMPUTE.method) -> DataFrame:
        w = self.table("wide")
        imputed = self._write("imputed", I.impute_wide(w, method=method))
        self._write("imputation_report", I.imputation_report(w, imputed, method=method))
        return imputed

    def metadata(self) -> DataFrame:
        """Registry with lineage counts taken from the stage tables that exist."""
        sizes = {1: "raw_api", 2: "raw_sdmx", 3: "harmonized", 4: "wide", 5: "qa_flagged", 6: "scored", 7: "imputed"}
        found = {s: t for s, n in sizes.items() if (t := self.find(n)) is not None}
        lineage = M.lineage(self.spark, M.step_counts(found) if found else None)
        self._write("lineage", lineage)
        self.written["registry"] = K.write_registry(M.registry(self.spark, lineage.drop("N_ROWS")),
                                                    self.path("registry"))
        return lineage

    def export(self, formats: tuple[str, ...] = ("csv", "json", "parquet")) -> dict[str, str]:
        imputed = self.table("imputed")
        out = K.export_all(imputed, self.path("exports"), formats)
        coverage = feeds.read_optional(self.spark, self.path("coverage"), COVERAGE_SCHEMA)
        K.write_bundle({"Data": imputed, "Coverage": coverage, "Imputation": self.find("imputation_report"),
                        "Metadata": M.concept_sheet(M.concept_table(self.spark))},
                       self.path("bundle"))
        return out

    def run_all(self, api: str | None = None, sdmx: str | None = None,
                method: str = IMPUTE.method) -> dict[str, str]:
        self.ingest(api=api, sdmx=sdmx)
        self.harmonize()
        self.merge()
        self.validate()
        self.anomaly()
        self.impute(method)
        self.metadata()
        self.export()
        return dict(self.written)

