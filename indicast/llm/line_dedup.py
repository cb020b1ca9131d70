"""Line dedup over levelled sorted runs of line hashes (DataFrame operations only).

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` and with A-Z
lower-cased; keys of fewer than ``min_chars`` code points are never dropped. A
key found in at least ``min_docs`` documents stays only in the largest doc_id.

The index is a log-structured set of runs. A run is a table bucketed and sorted
by the key's 128-bit hash, one row per key: the number of documents and the
largest id. Documents come in batches by descending id, so the first batch that
holds a key holds its keeper. Each batch is reduced to one row per key,
merge-anti-joined with the runs' keys that have reached ``min_docs`` (nothing
more needs to be known about those), and the rest is added as a run of its own.
When a level has ``FANOUT`` runs they are compacted to one run of the next.

Hot lines: a key is reduced by partial aggregates before it is shuffled, and
the join that finds the lines to drop has a unique side, so adaptive execution
splits the other. Per document only its own dropped positions are listed.

Edge cases: a null text is one empty line; documents under one id count as one
document for the threshold; a null id counts as a document smaller than all
others; repeated rows get the same result; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicast.llm.common import Shelf, row_key

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 2
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(SPACES))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


class LineIndex:
    """Runs of ``h1, h2, n, last``: documents with the key, and the largest id."""

    def __init__(self, shelf: Shelf, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.shelf, self.min_docs, self.fanout = shelf, min_docs, fanout
        self.levels: list[list[tuple[str, DataFrame]]] = [[]]

    def _write(self, rows: DataFrame) -> tuple[str, DataFrame]:
        spark, name = rows.sparkSession, f"line_run_{uuid.uuid4().hex}"
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        (rows.repartition(buckets, "h1", "h2").write.bucketBy(buckets, "h1", "h2").sortBy("h1", "h2")
         .option("path", f"{self.shelf.path}/{name}").saveAsTable(name))
        return name, spark.table(name)

    def _remove(self, name: str) -> None:
        self.shelf.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.shelf.drop(name)

    def runs(self) -> list[tuple[str, DataFrame]]:
        return [run for level in self.levels for run in level]

    def merged(self, runs: list[tuple[str, DataFrame]]) -> DataFrame:
        """One row per key of the runs. They are read as plain files: a union of
        bucketed scans passes for partitioned by key, though a key's rows lie in
        different partitions, and would be aggregated without an exchange."""
        files = [f"{self.shelf.path}/{name}" for name, _ in runs]
        rows = self.shelf.spark.read.schema(runs[0][1].schema).parquet(*files)
        return rows.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("last").alias("last"))

    def add(self, lines: DataFrame) -> None:
        """Add a batch of ``h1, h2, id``; ids must be below those of earlier batches."""
        once = lines.select("h1", "h2", "id").distinct()
        batch = once.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("id").alias("last"))
        for _, run in self.runs():
            batch = batch.join(run.filter(F.col("n") >= self.min_docs), ["h1", "h2"], "left_anti")
        self.levels[0].append(self._write(batch))
        for i in range(len(self.levels)):
            if len(self.levels[i]) >= self.fanout:
                full, self.levels[i] = self.levels[i], []
                if i + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[i + 1].append(self._write(self.merged(full)))
                for name, _ in full:
                    self._remove(name)

    def clear(self) -> None:
        for name, _ in self.runs():
            self._remove(name)
        self.levels = [[]]

    def repeated(self) -> DataFrame:
        """``h1, h2, last`` of the keys found in at least ``min_docs`` documents."""
        return self.merged(self.runs()).filter(F.col("n") >= self.min_docs).select("h1", "h2", "last")


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                  batches: int = BATCHES) -> DataFrame:
    """``k1, k2, gone``: the positions (from 0) of each row's dropped lines, for rows that lose any."""
    shelf = Shelf(docs.sparkSession, "lines")
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx(ident, shares).alias("c")).first()["c"] or []
    batch = sum((F.when(ident <= c, 1).otherwise(0) for c in cuts), F.lit(0))  # 0: the largest ids
    line = line_key(F.col("line"))
    lines = (docs.select(*row_key(), ident.alias("id"), batch.alias("batch"),
                         F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))
             .select("k1", "k2", "id", "batch", "pos", line.alias("key"))
             .filter(F.char_length("key") >= min_chars)
             .select("k1", "k2", "id", "batch", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit(1), "key").alias("h2")))
    lines = shelf.keep(lines, "lines")
    index = LineIndex(shelf, min_docs)
    for i in range(batches):
        index.add(lines.filter(F.col("batch") == i))
    # Kept, so that the join has a plain exchange on both sides and a hot line's rows can be split.
    hot = shelf.keep(index.repeated(), "repeated")
    index.clear()
    return (lines.join(hot, ["h1", "h2"]).filter("id <> last")
            .groupBy("k1", "k2").agg(F.collect_set("pos").alias("gone")))


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
               batches: int = BATCHES) -> DataFrame:
    """``docs`` with ``text`` replaced where lines go, ``n_chars`` (if present)
    kept in step, and two struct-free columns appended: ``__n_lines`` and ``__n_dropped``."""
    gone = dropped_lines(docs, min_chars, min_docs, batches).select(
        F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("gone").alias("__gone"))
    first, second = row_key()
    joined = docs.withColumns({"__k1": first, "__k2": second}).join(gone, ["__k1", "__k2"], "left")
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("__lines"), i)), "\n")
    out = joined.withColumn("__lines", lines).withColumns({
        "text": F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept),
        "__n_lines": F.size("__lines").cast("long"),
        "__n_dropped": F.coalesce(F.size("__gone"), F.lit(0)).cast("long")})
    if "n_chars" in docs.columns:
        changed = F.when(F.col("__n_dropped") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
        out = out.withColumn("n_chars", changed.otherwise(F.col("n_chars")))
    return out.select(*docs.columns, "__n_lines", "__n_dropped")


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, line, pos,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k
  FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
hot AS (SELECT k, max(doc_id) AS last FROM lines WHERE length(k) >= {MIN_CHARS}
        GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS})
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE doc_id <> last) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE last IS NULL OR doc_id = last), ''))
         AS kept_sha256
FROM lines LEFT JOIN hot USING (k) GROUP BY doc_id
"""
