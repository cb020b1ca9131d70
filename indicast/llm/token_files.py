"""Token-ID files of independent zstandard frames.

A file holds, one after the other:

* data frames: each an independent zstandard frame with the little-endian
  unsigned 32-bit ids of consecutive documents, about ``FRAME_BYTES`` of them;
* one index frame: a zstandard frame with the documents' ids and numbers of tokens;
* a seek table in a skippable frame, at the very end: for each frame its
  compressed size, size and a 32-bit checksum of its content (XXH64, low half),
  then the number of frames, a descriptor byte and the seekable format's magic number.

A reader takes the seek table from the end, the index frame, and then
decompresses only the frames that hold the documents asked for.

Writing: documents are range-partitioned by id and sorted, each partition
becomes one file. A task writes to a name of its own and returns that name with
its counts; the manifest, a Parquet table, holds what the successful attempts
returned, so files left by lost or repeated attempts are never read.

Ids come from the tokenizers library, word by word: a word's ids do not depend
on its neighbours in the vocabularies with word ends, and a worker remembers
the words it met last.

Edge cases: a null or empty text has only the end id; null ids come first in
the order; repeated rows each have an entry; a document longer than a frame has
a frame of its own; an empty table gives an empty manifest and no documents.
"""

from __future__ import annotations

import os
import struct
import uuid
from hashlib import sha1

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from indicast.llm.common import Shelf, blobs, chunks, row_key, worker_cache
from indicast.llm.pieces import Recent, pieces, simple_words

FRAME_BYTES = 1 << 20
#: Frames that one read takes after opening a file.
FRAMES_PER_READ = 16
END_ID = 1
LEVEL = 1
# Fixed values of the seekable zstandard format.
SKIPPABLE, SEEKABLE, HAS_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
NO_ID = -(1 << 63)


class Encoder:
    """Ids of texts as bytes, by the tokenizers library."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()
        self.words = Recent(self._by_library, 500_000)
        self.pieces = Recent(self._make_pieces, 400_000)

    def _by_library(self, texts: list[str]):
        for at in range(0, len(texts), 5000):
            for found in self.library.encode_batch_fast(texts[at:at + 5000], add_special_tokens=False):
                yield struct.pack(f"<{len(found.ids)}I", *found.ids)

    def _make_pieces(self, found: list[str]):
        simple = [None if "<" in p else simple_words(p) for p in found]
        known = self.words.over([w for words in simple if words for w in words])
        other = iter(list(self._by_library([p for p, words in zip(found, simple) if words is None])))
        for words in simple:
            yield next(other) if words is None else b"".join(map(known.__getitem__, words))

    def encode(self, text: str) -> bytes:
        found, out = pieces(text), []
        for at in range(0, len(found), 100_000):
            part = found[at:at + 100_000]
            out.append(b"".join(map(self.pieces.over(part).__getitem__, part)))
        return b"".join(out)


class FileWriter:
    """Appends documents to one token file."""

    def __init__(self, out):
        self.out, self.table, self.pending, self.size = out, [], [], 0
        self.ids, self.counts = [], []
        self.press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def add(self, doc_id: int, ids: bytes) -> None:
        if self.pending and self.size + len(ids) > FRAME_BYTES:
            self._flush()
        self.pending.append(ids)
        self.size += len(ids)
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)

    def _frame(self, content: bytes) -> None:
        packed = self.press.compress(content)
        self.out.write(packed)
        self.table.append((len(packed), len(content), xxh64_intdigest(content) & 0xFFFFFFFF))

    def _flush(self) -> None:
        self._frame(b"".join(self.pending))
        self.pending, self.size = [], 0

    def close(self) -> None:
        if self.pending:
            self._flush()
        self._frame(np.array([self.ids, self.counts], "<i8").tobytes())
        rows = b"".join(struct.pack("<III", *row) for row in self.table)
        foot = struct.pack("<IBI", len(self.table), HAS_CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(rows) + len(foot)) + rows + foot)


class FileReader:
    """Random access to the documents of one token file."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        count, _, magic = struct.unpack("<IBI", source.read_at(9, end - 9))
        if magic != SEEKABLE:
            raise ValueError("no seek table at the end of the file")
        rows = np.frombuffer(source.read_at(12 * count, end - 9 - 12 * count), "<u4").reshape(-1, 3)
        self.packed, self.sizes, self.sums = (rows[:, i].astype(np.int64) for i in range(3))
        self.offsets = np.concatenate(([0], np.cumsum(self.packed)))
        self.frames = count - 1
        index = np.frombuffer(self.content(self.frames), "<i8").reshape(2, -1)
        self.doc_ids, self.counts = index
        self.starts = np.concatenate(([0], np.cumsum(self.counts)))  # in ids, within the file
        self.bounds = np.concatenate(([0], np.cumsum(self.sizes[:self.frames]))) // 4

    def content(self, frame: int) -> bytes:
        packed = self.source.read_at(int(self.packed[frame]), int(self.offsets[frame]))
        plain = zstandard.ZstdDecompressor().decompress(packed, max_output_size=max(1, int(self.sizes[frame])))
        if xxh64_intdigest(plain) & 0xFFFFFFFF != self.sums[frame]:
            raise ValueError(f"frame {frame}: wrong checksum")
        return plain

    def documents_of(self, frame: int):
        """Position in the file, id and ids' bytes of each document of a frame."""
        first, last = np.searchsorted(self.starts[:-1], self.bounds[frame:frame + 2])
        plain, base = self.content(frame), self.bounds[frame]
        for i in range(first, last):
            low = 4 * int(self.starts[i] - base)
            yield i, int(self.doc_ids[i]), plain[low:low + 4 * int(self.counts[i])]

    def read(self, doc_id: int) -> list[np.ndarray]:
        """The ids of each document under ``doc_id``; only its frames are decompressed."""
        out = []
        for i in np.flatnonzero(self.doc_ids == doc_id):
            frame = int(np.searchsorted(self.bounds, self.starts[i], side="right")) - 1
            low = 4 * int(self.starts[i] - self.bounds[frame])
            out.append(np.frombuffer(self.content(frame)[low:low + 4 * int(self.counts[i])], "<u4"))
        return out


def open_folder(uri: str):
    """File system and path of a folder named by a URI or a local path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def _write(content, folder: str, end_id: int):
    def run(batches):
        text = content.value
        encoder = worker_cache("encoder_" + sha1(text.encode()).hexdigest(), lambda: Encoder(text))
        end, writer, tokens = struct.pack("<I", end_id), None, 0
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.ids.zst"
        files, path = open_folder(folder)
        out = None
        for part in chunks(batches, "text"):
            if writer is None:
                files.create_dir(path, recursive=True)
                out = files.open_output_stream(f"{path}/{name}", compression=None)
                writer = FileWriter(out)
            for doc_id, raw in zip(part.column("id").to_pylist(), blobs(part.column("text"))):
                ids = encoder.encode(raw.decode("utf-8", "replace")) + end
                writer.add(doc_id, ids)
                tokens += len(ids) // 4
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([TaskContext.get().partitionId()], pa.int64()),
                 pa.array([len(writer.ids)], pa.int64()), pa.array([tokens], pa.int64()),
                 pa.array([len(writer.table) - 1], pa.int64())],
                ["file", "part", "n_docs", "n_tokens", "n_frames"])
    return run


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID) -> tuple[DataFrame, str]:
    """Write ``docs(doc_id, text)`` to token files in ``folder`` (by default one
    of its own in the shared folder); returns the manifest and the folder."""
    spark = docs.sparkSession
    shelf = Shelf(spark, "tokens")
    folder = folder or f"{shelf.path}/files"
    with open(tokenizer, encoding="utf-8") as file:
        content = spark.sparkContext.broadcast(file.read())  # one vocabulary file, a few MB
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), *row_key(),
                      F.col("text").cast("binary").alias("text"))
    # The row key and a salt split documents that share one id.
    order = ["id", "k1", "k2"]
    ranged = own.repartitionByRange(*order, F.rand(7)).sortWithinPartitions(*order).select("id", "text")
    manifest = ranged.mapInArrow(_write(content, folder, end_id),
                                 "file string, part long, n_docs long, n_tokens long, n_frames long")
    return shelf.keep(manifest, "manifest"), folder


def _read(folder: str):
    def run(batches):
        files, path = open_folder(folder)
        for batch in batches:
            for name, low, before in zip(*(batch.column(c).to_pylist() for c in ("file", "low", "before"))):
                with files.open_input_file(f"{path}/{name}") as source:
                    reader = FileReader(source)
                    for frame in range(low, min(low + FRAMES_PER_READ, reader.frames)):
                        found = list(reader.documents_of(frame))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([d for _, d, _ in found], pa.int64()),
                             pa.array([before + int(reader.starts[i]) for i, _, _ in found], pa.int64()),
                             pa.array([b for _, _, b in found], pa.binary())], ["doc_id", "start", "ids"])
    return run


def read_tokens(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, ids`` of every document in the files; ``start`` counts the
    ids of all documents before it, ``ids`` are little-endian 32-bit."""
    # One row per file: the manifest is small, its running sum needs no partitioning.
    before = F.sum("n_tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    reads = (manifest.withColumn("before", F.coalesce(before, F.lit(0))).select(
        "file", "before", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_frames") - 1,
                                               F.lit(FRAMES_PER_READ).cast("long"))).alias("low")))
    # As many tasks as reads: their rows are a few bytes each, so their size says nothing of the work.
    n = manifest.agg(F.sum(F.ceil(F.col("n_frames") / FRAMES_PER_READ))).first()[0]
    out = reads.repartition(max(1, int(n or 0)), "file", "low").mapInArrow(_read(folder), "doc_id long, start long, ids binary")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def crc_of_ids(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from ``doc_id, start, ids``."""
    return rows.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))
