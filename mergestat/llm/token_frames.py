"""Token ids in independent zstandard frames with a trailing seek table.

Layout of one file, in the public zstandard seekable format:

* one or more frames per document: its ids, little-endian, ``width`` bytes each
  (2 where every id fits, else 4); a document of more than ``FRAME_IDS`` ids
  continues in further frames;
* a skippable frame (magic 0x184D2A50) with the directory: width, number of
  documents, then document ids (int64), null flags (uint8) and the number of
  frames of each document (uint32);
* a skippable frame (magic 0x184D2A5E) with the seek table: compressed size,
  decompressed size and checksum (low 32 bits of XXH64 of the content) of every
  frame before it, then the number of entries, the descriptor byte and the
  footer magic 0x8F92EAB1.

A reader takes the table from the end of the file and decompresses only the
frames of the documents it wants, each checked against its checksum.  Any
zstandard decoder can also read the file from the front.

Scale: documents are range-partitioned on their id (ties by text hash) and each
task writes its own files in order, rolled at ``file_bytes``; a manifest row per
file carries the counts from which a prefix sum over files gives every
document's global start.  Memory: one Arrow batch, one file's seek table and a
bounded cache of encoded words.

Defined cases: a null text counts as empty and holds only the end id; null ids
sort first; repeated rows are written as often as they occur; an empty table
writes no file and reads back as no rows.
"""

from __future__ import annotations

import os
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import staged
from .files import new_name, random_reader, writer

FRAME_IDS = 1 << 20
FILE_BYTES = 256 << 20
END_ID = 2
# Fixed values of the zstandard seekable format.
SKIP_MAGIC, SEEK_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUM_FLAG = 0x80

#: Words kept between steps, and characters of text encoded in one step.
CACHE_WORDS, STEP_CHARS = 900_000, 4 << 20


# How byte-level vocabularies split a text before merging, with the
# letter, number and space classes written out for characters up to U+00FF.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+"
                    rf"|[{_S}]+(?![^{_S}])|[{_S}]+")


class Encoder:
    """Ids of whole texts, equal to ``Tokenizer.encode(text).ids``.

    A byte-level vocabulary splits a text into words before it merges bytes,
    so the ids of a word are the same wherever it recurs: texts of characters up
    to U+00FF are split here and each distinct word is encoded once.  Other
    texts, texts that spell an added token, and other kinds of tokenizer go to
    the tokenizer whole.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.splits = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                       and not pre.get("add_prefix_space") and not spec.get("normalizer"))
        self.added = [t["content"] for t in spec.get("added_tokens", ())]
        self.width = 2 if max(self.tok.get_vocab_size() - 1, end_id) < 1 << 16 else 4
        self.dtype = np.dtype("<u2" if self.width == 2 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.words: dict[str, bytes] = {}
        # a byte-level token has one character for each of its bytes
        self.token_bytes = np.array([len(self.tok.id_to_token(i) or "")
                                     for i in range(self.tok.get_vocab_size())])

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Encode words in one run; its ids are cut where their bytes add up to a word's."""
        ids = np.array(self.tok.encode_batch_fast([new], is_pretokenized=True, add_special_tokens=False)[0].ids)
        ends = np.cumsum([len(w.encode()) for w in new])
        cut = ((np.searchsorted(np.cumsum(self.token_bytes[ids]), ends) + 1) * self.width).tolist()
        raw = ids.astype(self.dtype).tobytes()
        self.words.update((w, raw[a:b]) for w, a, b in zip(new, [0, *cut], cut))

    def _known(self, text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return not any(a in text for a in self.added)

    def texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, without the end id, as bytes."""
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        parts = [_SPLIT.findall(t) if self.splits and self._known(t) else None for t in texts]
        new = set().union(*filter(None, parts)).difference(self.words)
        if new:
            self._learn(list(new))
        get = self.words.__getitem__
        return [self._whole([t])[0] if p is None else b"".join(map(get, p)) for t, p in zip(texts, parts)]


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> Encoder:
    return Encoder(path, end_id)


class FrameWriter:
    """One file: documents in, then directory and seek table on ``close``."""

    def __init__(self, uri: str, width: int, level: int):
        import zstandard
        self.uri, self.width = uri, width
        self.out = writer(uri)
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.bytes = self.tokens = 0
        self.ids: list[int | None] = []
        self.frames: list[int] = []
        self.table: list[tuple[int, int, int]] = []

    def add(self, ident: int | None, ids: bytes) -> None:
        import xxhash
        step = FRAME_IDS * self.width
        pieces = [ids[a:a + step] for a in range(0, len(ids), step)] if len(ids) > step else [ids]
        for piece in pieces:
            frame = self.zstd.compress(piece)
            self.out.write(frame)
            self.bytes += len(frame)
            self.table.append((len(frame), len(piece), xxhash.xxh64_intdigest(piece) & 0xFFFFFFFF))
        self.ids.append(ident)
        self.frames.append(len(pieces))
        self.tokens += len(ids) // self.width

    def close(self) -> None:
        n = len(self.ids)
        directory = b"".join([
            struct.pack("<BI", self.width, n),
            np.array([i or 0 for i in self.ids], "<i8").tobytes(),
            np.array([i is None for i in self.ids], "u1").tobytes(),
            np.array(self.frames, "<u4").tobytes()])
        entries = np.array(self.table, "<u4").tobytes()
        self.out.write(struct.pack("<II", SKIP_MAGIC, len(directory)) + directory)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(entries) + 9) + entries)
        self.out.write(struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, FOOTER_MAGIC))
        self.out.close()


class FrameReader:
    """Random access to the documents of one file.

    ``read_bytes`` is read at once: little for single documents, more where
    all follow one another.
    """

    def __init__(self, uri: str, read_bytes: int = 1 << 14):
        import zstandard
        self.file = random_reader(uri)
        self.block, self.block_at, self.read_bytes = b"", 0, read_bytes
        self.zstd = zstandard.ZstdDecompressor()
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError(f"{uri}: no seek table")
        at = size - 9 - 12 * count
        self.table = np.frombuffer(self._at(at, 12 * count), "<u4").reshape(-1, 3)
        self.offset = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        start = int(self.offset[-1])
        magic, length = struct.unpack("<II", self._at(start, 8))
        if magic != SKIP_MAGIC:
            raise ValueError(f"{uri}: no directory")
        raw = self._at(start + 8, length)
        self.width, n = struct.unpack_from("<BI", raw)
        self.ids = np.frombuffer(raw, "<i8", n, 5)
        self.null = np.frombuffer(raw, "u1", n, 5 + 8 * n).astype(bool)
        self.first = np.concatenate([[0], np.cumsum(np.frombuffer(raw, "<u4", n, 5 + 9 * n), dtype=np.int64)])
        self.dtype = np.dtype("<u2" if self.width == 2 else "<u4")

    def _at(self, offset: int, size: int) -> bytes:
        """A piece of the file, from the block read last or a new one."""
        offset, size = int(offset), int(size)
        at = offset - self.block_at
        if at < 0 or at + size > len(self.block):
            self.file.seek(offset)
            self.block, self.block_at, at = self.file.read(max(size, self.read_bytes)), offset, 0
        return self.block[at:at + size]

    def document(self, k: int) -> np.ndarray:
        """The ids of the file's k-th document; reads its frames only."""
        import xxhash
        out = []
        for f in range(int(self.first[k]), int(self.first[k + 1])):
            plain = self.zstd.decompress(
                self._at(self.offset[f], self.table[f, 0]), max_output_size=int(self.table[f, 1]))
            if len(plain) != self.table[f, 1] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.table[f, 2]:
                raise ValueError(f"frame {f} fails its checksum")
            out.append(plain)
        return np.frombuffer(b"".join(out), self.dtype)

    def find(self, wanted) -> dict[int, np.ndarray]:
        """The ids of the requested documents that this file holds."""
        wanted = set(wanted)
        return {int(i): self.document(k) for k, i in enumerate(self.ids)
                if not self.null[k] and int(i) in wanted}


def _steps(batch: pa.RecordBatch):
    """(ids, texts) of a batch, in runs of about ``STEP_CHARS`` characters."""
    ids, texts = batch.column(0).to_pylist(), batch.column(1)
    at = held = 0
    chunk: list[str] = []
    for k in range(len(ids)):
        chunk.append(texts[k].as_py())
        held += len(chunk[-1])
        if held >= STEP_CHARS:
            yield ids[at:k + 1], chunk
            at, held, chunk = k + 1, 0, []
    if chunk:
        yield ids[at:], chunk


def write(docs: DataFrame, tokenizer: str, end_id: int = END_ID, ident: str = "doc_id",
          text: str = "text", folder: str | None = None, file_bytes: int = FILE_BYTES,
          level: int = 1, partitions: int | None = None) -> DataFrame:
    """Encode and write all rows in ascending id order; returns the manifest.

    One manifest row per file: ``file``, ``part``, ``seq`` (their order),
    ``n_docs``, ``n_tokens`` and ``start`` (ids in all files before it).
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-frames")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = docs.select(F.col(f"`{ident}`").cast("long").alias("id"),
                      F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    src = src.withColumn("tie", F.xxhash64("text"))
    src = src.repartitionByRange(n, "id", "tie").sortWithinPartitions("id", "tie").select("id", "text")

    def run(batches):
        enc, part = encoder(tokenizer, end_id), TaskContext.get().partitionId()
        out, done = None, []

        def close():
            out.close()
            done.append((out.uri, part, len(done), len(out.ids), out.tokens))

        for b in batches:
            for step in _steps(b):
                for i, ids in zip(step[0], enc.texts(step[1])):
                    if out is None:
                        out = FrameWriter(new_name(folder, ".ids.zst"), enc.width, level)
                    out.add(i, ids + enc.end)
                    if out.bytes >= file_bytes:
                        close()
                        out = None
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*done), (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                ["file", "part", "seq", "n_docs", "n_tokens"])

    files = staged(src.mapInArrow(run, "file string, part int, seq int, n_docs long, n_tokens long"),
                   "token-manifest")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def read_back(manifest: DataFrame, ident: str = "doc_id") -> DataFrame:
    """Every document of the files: id, ``start``, ``n_tokens``, ``ids_crc32``."""
    def run(batches):
        import zlib
        for b in batches:
            for file, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                r, rows = FrameReader(file, 4 << 20), []
                for k in range(len(r.ids)):
                    ids = r.document(k)
                    rows.append((None if r.null[k] else int(r.ids[k]), start, len(ids),
                                 zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(rows) == 10_000 or k == len(r.ids) - 1:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in zip(*rows)],
                            [ident, "start", "n_tokens", "ids_crc32"])
                        rows = []

    files = manifest.select("file", "start")
    spread = files.repartition(max(1, min(files.count(), 10_000)))
    return spread.mapInArrow(run, f"`{ident}` long, start long, n_tokens long, ids_crc32 long")
