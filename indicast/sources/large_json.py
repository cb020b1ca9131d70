"""S3 for payloads larger than a task: one landed JSON file read by many tasks.

A payload is ``{"data": [ {...}, ... ], ...}``. Its file is cut into byte ranges.
Whether a range begins inside a string, and how deep in brackets, depends on all
bytes before it, but each range's effect on both can be told without them:

1. Each range counts its quotes that are not escaped and, for either case (it
   begins outside or inside a string), what its brackets add to the depth and the
   lowest depth on the way. (Whether its first byte is escaped is seen from
   the backslashes right before it.)
2. Running sums over a file's ranges, a few numbers each, give for every range
   whether it begins in a string and at which depth.
3. The ranges that come down to the outermost object are looked through for its
   key ``data``; that gives the array's first and last byte.
4. Each range yields the elements of the array that begin in it, and reads on to the
   end of the last one. Elements are parsed by Spark, as those of the whole-text reader.

So no task holds more than a range and an element, and a file is read twice whatever its size.
Files whose brackets or strings do not close, or without the array, come back
in a second frame and give no rows. (Files of no bytes are not listed by Spark's readers at all.)
"""

from __future__ import annotations

import os
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indicast.session import materialize
from indicast.sources.feeds import JSON_PAYLOAD_SCHEMA, observation_columns

RANGE_BYTES = 32 << 20
_KEY_BEFORE = re.compile(rb'(?<!\\)"data"\s*:\s*$')
_LOOK_BACK = 4096
_STEP = 1 << 14


def _open(path: str):
    from pyarrow import fs
    files, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")
    return files.open_input_file(inner)


def _bytes(source, begin: int, end: int) -> bytes:
    return source.read_at(max(0, min(end, source.size()) - begin), begin)


def _frame(rows: list[tuple], text: set[str], *names: str) -> pd.DataFrame:
    """Rows as a frame whose columns of text are plain objects, so that empty ones have their type too."""
    columns = list(zip(*rows)) or [()] * len(names)
    return pd.DataFrame({n: pd.Series(c, dtype=object if n in text else "int64") for n, c in zip(names, columns)})


class Marks:
    """Quotes and brackets of a stretch of a file."""

    def __init__(self, raw: bytes, escapes: int = 0):
        """``escapes``: number of backslashes right before the stretch."""
        b = np.frombuffer(raw, np.uint8)
        quotes = np.flatnonzero(b == 34)
        plain = np.maximum.accumulate(np.where(b != 92, np.arange(len(b)), -1)) if len(b) else b
        before = quotes - 1
        last = np.where(before >= 0, plain[np.maximum(before, 0)], -1)
        run = before - last + np.where(last < 0, escapes, 0)
        self.quotes = quotes[run % 2 == 0]
        # "[" and "{" are 91 and 123, their partners two further.
        low = b | 32
        self.at = np.flatnonzero((low == 123) | (low == 125))
        self.step = np.where(low[self.at] == 123, 1, -1)
        self.byte = b[self.at]

    def outside(self, in_string: bool) -> np.ndarray:
        """Which of the brackets are not part of a string."""
        return (np.searchsorted(self.quotes, self.at) + in_string) % 2 == 0


def _escapes_before(source, begin: int) -> int:
    raw = _bytes(source, max(0, begin - _LOOK_BACK), begin)
    return len(raw) - len(raw.rstrip(b"\\"))


def _scan(parts):
    for part in parts:
        rows = []
        for path, begin, end in zip(part["FILE"], part["begin"], part["end"]):
            with _open(path) as source:
                marks = Marks(_bytes(source, begin, end), _escapes_before(source, begin))
            told = [len(marks.quotes) % 2]
            for inside in (False, True):
                depth = np.cumsum(marks.step[marks.outside(inside)])
                told += [int(depth[-1]) if len(depth) else 0, int(depth.min(initial=0))]
            rows.append((path, begin, end, *told))
        yield _frame(rows, {"FILE"}, "FILE", "begin", "end", "quotes", "d0", "m0", "d1", "m1")


def _find_array(parts):
    """Where the array ``data`` of the outermost object begins, and where any array or object in it ends."""
    for part in parts:
        rows = []
        for path, begin, end, inside, depth in zip(*(part[c] for c in ("FILE", "begin", "end", "inside", "depth"))):
            with _open(path) as source:
                raw = _bytes(source, begin, end)
                marks = Marks(raw, _escapes_before(source, begin))
                out = marks.outside(bool(inside))
                at, step, byte = marks.at[out], marks.step[out], marks.byte[out]
                level = depth + np.cumsum(step)
                for i in np.flatnonzero((step == 1) & (level == 2) & (byte == 91)):
                    place = begin + int(at[i])
                    if _KEY_BEFORE.search(_bytes(source, max(0, place - _LOOK_BACK), place)):
                        rows.append((path, place, 1))
                rows += [(path, begin + int(at[i]), 0) for i in np.flatnonzero((step == -1) & (level == 1))]
        yield _frame(rows, {"FILE"}, "FILE", "place", "opens")


def _elements(parts):
    for part in parts:
        for path, begin, end, inside, depth, first, last in zip(
                *(part[c] for c in ("FILE", "begin", "end", "inside", "depth", "first", "last"))):
            with _open(path) as source:
                raw, escapes = _bytes(source, begin, end), _escapes_before(source, begin)
                reach, step_bytes = end, _STEP
                while True:
                    marks = Marks(raw, escapes)
                    out = marks.outside(bool(inside))
                    at, step = marks.at[out], marks.step[out]
                    level = depth + np.cumsum(step)
                    place = begin + at
                    opened = at[(step == 1) & (level == 3) & (place > first) & (place < min(last, end))]
                    closed = at[(step == -1) & (level == 2) & (place > first) & (place < last)]
                    if not len(opened) or (len(closed) and closed[-1] > opened[-1]) or reach >= last:
                        break
                    # The last element goes on behind the range.
                    raw += _bytes(source, reach, reach + step_bytes)
                    reach += step_bytes
                    step_bytes *= 2
            ends = closed[np.searchsorted(closed, opened)] if len(opened) else opened
            yield _frame([(path, begin + int(a), raw[a:b + 1].decode("utf-8", "replace")) for a, b in zip(opened, ends)],
                         {"FILE", "element"}, "FILE", "POS", "element")


def read_large_json(spark: SparkSession, path: str, indicator_id: str | None = None,
                    range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """S3: as :func:`indicast.sources.feeds.read_json_documents`, each file by as many tasks as it
    has ranges. POS is the element's first byte, so the first record within a source still wins;
    the second frame has the files (FILE) that are no such payload."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("FILE"), "length")  # names and sizes only
    first_bytes = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0).cast("bigint")),
                                       F.lit(range_bytes).cast("bigint")))
    ranges = files.select("FILE", first_bytes.alias("begin"), "length").select(
        "FILE", "begin", F.least(F.col("begin") + range_bytes, "length").alias("end"))
    # A task takes several ranges where they are small and many.
    n, size = ranges.agg(F.count("*"), F.sum(F.col("end") - F.col("begin"))).first()
    tasks = max(1, min(n, max(4 * spark.sparkContext.defaultParallelism, -(-(size or 0) // RANGE_BYTES))))
    told = ranges.repartition(tasks, "FILE", "begin").mapInPandas(
        _scan, "FILE string, begin bigint, end bigint, quotes bigint, d0 bigint, m0 bigint, d1 bigint, m1 bigint")
    # A few numbers for each range: the window sees one row per range of a file.
    earlier = W.partitionBy("FILE").orderBy("begin").rowsBetween(W.unboundedPreceding, -1)
    inside = told.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier) % 2, F.lit(0)) == 1)
    depth = F.coalesce(F.sum(F.when(F.col("inside"), F.col("d1")).otherwise(F.col("d0"))).over(earlier), F.lit(0))
    known = inside.withColumn("depth", depth).select(
        "FILE", "begin", "end", "inside", "depth", "quotes",
        F.when(F.col("inside"), F.col("d1")).otherwise(F.col("d0")).alias("d"),
        F.when(F.col("inside"), F.col("m1")).otherwise(F.col("m0")).alias("m"))
    known = materialize(known)
    outer = known.where((F.col("depth") + F.col("m") <= 1)).repartition(tasks, "FILE", "begin")
    places = outer.mapInPandas(_find_array, "FILE string, place bigint, opens bigint")
    opens = places.groupBy("FILE").agg(F.min(F.when(F.col("opens") == 1, F.col("place"))).alias("first"),
                                       F.collect_list(F.when(F.col("opens") == 0, F.col("place"))).alias("closes"))
    arrays = opens.select("FILE", "first", F.array_min(F.filter("closes", lambda c: c > F.col("first"))).alias("last"))
    whole = known.groupBy("FILE").agg((F.sum("d") == 0).alias("_closed"), (F.sum("quotes") % 2 == 0).alias("_quoted"))
    checked = materialize(files.select("FILE").join(whole, "FILE", "left").join(arrays, "FILE", "left").withColumn(
        "good", F.coalesce(F.col("_closed") & F.col("_quoted") & F.col("last").isNotNull(), F.lit(False))))
    todo = known.join(checked.where("good").select("FILE", "first", "last"), "FILE").where(
        (F.col("end") > F.col("first")) & (F.col("begin") < F.col("last")))
    found = todo.select("FILE", "begin", "end", "inside", "depth", "first", "last").repartition(tasks, "FILE", "begin").mapInPandas(
        _elements, "FILE string, POS bigint, element string")
    ind = F.lit(indicator_id) if indicator_id is not None else F.regexp_extract("FILE", r"([^/]+)\.json$", 1)
    parsed = found.select("FILE", "POS", ind.alias("_ind"), _observation("element").alias("o"))
    return observation_columns(parsed, ["FILE"]), checked.where(~F.col("good")).select("FILE")


def _observation(text: str) -> Column:
    return F.from_json(text, JSON_PAYLOAD_SCHEMA["data"].dataType.elementType, {"mode": "PERMISSIVE"})


__all__ = ["read_large_json"]
