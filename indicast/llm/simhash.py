"""SimHash near-dedup by covering locality-sensitive hashing.

A document's fingerprint has bit b set where more than half of its shingle
hashes have it. Two fingerprints link at ``radius`` or fewer differing bits and
linked documents form components.

Candidate search: bit position i gets a nonzero vector c(i) of radius + 1 bits,
in turn. For each nonzero vector v a table keeps the bits with c(i).v = 1, so
there are 2**(radius + 1) - 1 tables of about half the bits each. The vectors
of ``radius`` differing positions leave some nonzero v orthogonal to all of
them; that table's mask drops every differing bit, so each pair within the
radius shares a bucket in some table. Nothing depends on chance.

A bucket of more than ``BUCKET`` distinct fingerprints is covered again over the
bits its mask dropped, which keeps the guarantee; its members go to smaller
buckets. After three levels at most ``FREE`` bits are free, so a bucket has a
bounded number of distinct values. Inside a bucket every pair is compared, and
a spanning forest of its links goes out rather than all pairs.

Exact copies share a fingerprint and meet as one node. Edge cases: a null or
empty text, or one without a word, has fingerprint zero and links like any
other; one or two words form a single shingle; repeated rows are copies; the
component of documents that all lack an id is null; empty tables give empty results.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from indicast.llm.common import Shelf, blobs, chunks, row_key
from indicast.llm.components import connected_components

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
BUCKET = 1024
FREE = 10  # a bucket with so few free bits holds at most BUCKET distinct values
BLOCK = 1 << 17


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of the lower-cased words of one text."""
    words = text.lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    if len(words) < shingle:
        return xxh64_intdigest(b" ".join(words), seed)
    n = len(words) - shingle + 1
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(seed)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        part = hashes[at:at + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int, seed: int):
    def run(batches):
        for part in chunks(batches, "text"):
            marks = np.array([fingerprint(t, shingle, seed) for t in blobs(part.column("text"))], np.uint64)
            names = [n for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [pa.array(marks.view(np.int64))],
                                             names + ["fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id, k1, k2, fp`` for every row: row key and fingerprint as a signed long."""
    keyed = docs.select("doc_id", *row_key(), F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(_fingerprints(shingle, seed), f"doc_id {kind}, k1 long, k2 long, fp long")


def covering_masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over the given bit positions; any ``radius`` of the positions are
    all dropped by at least one mask."""
    codes = {p: 1 + i % (2 ** (radius + 1) - 1) for i, p in enumerate(positions)}
    return [sum(1 << p for p, c in codes.items() if (c & v).bit_count() % 2)
            for v in range(1, 2 ** (radius + 1))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bucketed(rows: DataFrame, tables: list[int], radius: int) -> tuple[DataFrame, list[int]]:
    """Each row of ``fp`` (and, below the first level, its hot bucket's mask
    ``mask``) once per table, with the table's mask and ``key`` = fp & mask."""
    cover = {t: [t | m for m in covering_masks([i for i in range(BITS) if not t >> i & 1], radius)] for t in tables}
    finer = F.lit(None).cast("array<long>")
    for t, ms in cover.items():  # 15 masks for the whole, then for each hot one
        finer = F.when(F.col("mask") == _signed(t), F.array(*[F.lit(_signed(m)) for m in ms])).otherwise(finer)
    out = rows.select("fp", F.explode(finer).alias("mask")).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    return out.distinct() if len(tables) > 1 else out, sorted({m for ms in cover.values() for m in ms})


def _forest(radius: int):
    def run(batches):
        for batch in batches:
            us, vs = [], []
            for members in batch.column("members").to_pylist():
                a = np.array(members, np.int64)
                a.sort()
                near = np.bitwise_count((a[:, None] ^ a[None, :]).view(np.uint64)) <= radius
                label, old = np.arange(len(a)), None
                while old is None or (label != old).any():
                    old = label
                    label = np.where(near, label[None, :], len(a)).min(axis=1)
                    label = label[label]
                far = label != np.arange(len(a))
                us.append(a[far])
                vs.append(a[label[far]])
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])
    return run


def links(nodes: DataFrame, shelf: Shelf, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Pairs ``u, v`` of distinct fingerprints that are linked inside a bucket,
    directly or through others; together they span every link of ``nodes(fp)``."""
    hot, tables, found, level = nodes.withColumn("mask", F.lit(0).cast("long")), [0], [], 0
    while True:
        rows, tables = _bucketed(hot, tables, radius)
        rows = shelf.keep(rows, f"bucketed-{level}")
        sizes = shelf.keep(rows.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1"), f"sizes-{level}")
        last = all(BITS - t.bit_count() <= FREE for t in tables)
        small = sizes if last else sizes.filter(F.col("n") <= bucket)
        found.append(rows.join(small.select("mask", "key"), ["mask", "key"])
                     .groupBy("mask", "key").agg(F.collect_list("fp").alias("members"))
                     .select("members").mapInArrow(_forest(radius), "u long, v long"))
        large = sizes.filter(F.col("n") > bucket).select("mask", "key")
        masks = [] if last else [r["mask"] & (1 << 64) - 1 for r in large.select("mask").distinct().collect()]
        if not masks:
            break
        hot, tables, level = rows.join(large, ["mask", "key"]).select("fp", "mask"), masks, level + 1
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
                    bucket: int = BUCKET) -> DataFrame:
    """``doc_id, k1, k2, fp, root, component_id`` for every row of ``docs``."""
    shelf = Shelf(docs.sparkSession, "simhash")
    own = shelf.keep(fingerprints(docs, shingle, seed), "fingerprints")
    nodes = shelf.keep(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = connected_components(links(nodes.select("fp"), shelf, radius, bucket), shelf)
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = shelf.keep(rooted, "rooted")
    component = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labelled = rooted.join(component, "root").select("fp", "root", "component_id")
    return own.join(labelled, "fp")


def hex_fingerprint(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with one document kept of each component: the one of
    the smallest id (of those without any, the one of the smallest row key).
    Of rows that repeat one stays. All columns stay as they are."""
    found = near_duplicates(docs, shingle, radius)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")
    chosen = (found.groupBy("root").agg(F.min(rank).alias("r")).select(
        F.col("r.k1").alias("__k1"), F.col("r.k2").alias("__k2")))
    first, second = row_key()
    kept = docs.withColumns({"__k1": first, "__k2": second}).join(chosen, ["__k1", "__k2"], "left_semi")
    nth = F.row_number().over(W.partitionBy("__k1", "__k2").orderBy("__k1"))
    return kept.withColumn("__nth", nth).filter("__nth = 1").select(*[kept[c] for c in docs.columns])
