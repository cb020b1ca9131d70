import struct
import zlib
from itertools import accumulate

import public_tokenizers
import pytest
import zstandard
from pyarrow import fs
from tokenizers import Tokenizer

from indicast.llm import token_files as T

PATH = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = ["doc_id", "start", "n_tokens", "ids_crc32"]
ROWS = [(5, "The cat, the CAT."), (3, None), (9, ""), (4, "é <|endoftext|> 日本"), (7, "x y z"), (7, "x y z"), (8, "word " * 5000)]
ROWS += [(100 + i, f"document number {i} of the lot") for i in range(200)]


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def test_query_against_the_library(run):
    ordered = sorted(ROWS, key=lambda r: r[0])
    ids = [ids_of(t) for _, t in ordered]
    starts = [0, *accumulate(map(len, ids))]
    want = [(d, s, len(i), zlib.crc32(struct.pack(f"<{len(i)}I", *i))) for (d, _), s, i in zip(ordered, starts, ids)]
    assert run("op5_token_files", ROWS, COLUMNS) == sorted(want)


def test_null_ids_and_empty_table(spark, docs):
    manifest, folder = T.write_tokens(docs([(None, "a"), (1, "b")]), PATH)
    got = T.read_tokens(spark, manifest, folder).orderBy("start").collect()
    assert [(r.doc_id, r.start, len(r.ids)) for r in got] == [(None, 0, 8), (1, 2, 8)]
    manifest, folder = T.write_tokens(docs([]), PATH)
    assert manifest.count() == 0 and T.read_tokens(spark, manifest, folder).count() == 0


def write(path, frame_bytes=64):
    old, T.FRAME_BYTES = T.FRAME_BYTES, frame_bytes
    try:
        out = fs.LocalFileSystem().open_output_stream(str(path))
        writer = T.FileWriter(out)
        for i in range(50):
            writer.add(i // 2, struct.pack(f"<{i + 1}I", *range(i + 1)))
        writer.close()
        out.close()
    finally:
        T.FRAME_BYTES = old


def test_reader_decompresses_only_what_is_asked_for(tmp_path, monkeypatch):
    write(tmp_path / "f")
    reader = T.FileReader(fs.LocalFileSystem().open_input_file(str(tmp_path / "f")))
    read = []
    content = T.FileReader.content
    monkeypatch.setattr(T.FileReader, "content", lambda self, k: read.append(k) or content(self, k))
    assert [a.tolist() for a in reader.read(10)] == [list(range(21)), list(range(22))]
    assert len(read) == 2 < reader.frames
    assert reader.read(999) == []


def test_frames_are_independent_and_checked(tmp_path):
    write(tmp_path / "f")
    raw = bytearray((tmp_path / "f").read_bytes())
    plain = zstandard.ZstdDecompressor().decompressobj().decompress(bytes(raw))
    assert plain[:4] == struct.pack("<I", 0)  # an ordinary decompressor reads the first frame
    reader = T.FileReader(fs.LocalFileSystem().open_input_file(str(tmp_path / "f")))
    raw[int(reader.offsets[2]) + int(reader.packed[2]) - 6] ^= 0xFF
    (tmp_path / "g").write_bytes(raw)
    broken = T.FileReader(fs.LocalFileSystem().open_input_file(str(tmp_path / "g")))
    assert broken.content(1) == reader.content(1)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        broken.content(2)
