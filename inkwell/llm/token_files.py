"""Token ids in files of fixed-width bit packing.

A file holds whole documents in order. Ids take the fewest bits the vocabulary needs, least
significant bit first. Layout, little-endian::

    magic, version, bits, ids per block, documents, ids, blocks      header of seven 64-bit numbers
    packed ids, block after block, each padded to a whole byte
    blocks + 1 offsets of 64 bits                                     where each block begins
    documents x (id 64 bits)                                          document ids
    documents x (1 byte)                                              1: the id is null
    documents + 1 numbers of 64 bits                                  where each document's ids begin

Any run of ids is found by its block's offset and unpacked by numpy, eight ids a lane.
"""

from __future__ import annotations

import bisect
import os
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import small_batches, written
from inkwell.llm.packing import ByteTokens
from inkwell.operators.order import running_totals
from inkwell.session import scratch_path

MAGIC = int.from_bytes(b"TOKBITS1", "little")
HEADER = 56
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 22
READ_TASKS = 4096
PART_BYTES = 1 << 25
MAX_PARTS = 1 << 14
SAMPLE = 64


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids of ``bits`` bits each, side by side: eight ids fill ``bits`` bytes."""
    lanes = np.zeros((-(-len(ids) // 8), 8), dtype=np.uint64)
    lanes.ravel()[: len(ids)] = ids
    out = np.zeros((len(lanes), bits + 8), dtype=np.uint8)
    for lane in range(8):
        byte, shift = divmod(lane * bits, 8)
        value = lanes[:, lane] << np.uint64(shift)
        for k in range(-(-(bits + shift) // 8)):
            out[:, byte + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return out[:, :bits].tobytes()[: -(-len(ids) * bits // 8)]


def unpack_bits(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of a packed block."""
    rows = -(-count // 8)
    padded = np.zeros((rows, bits + 8), dtype=np.uint8)
    flat = np.zeros(rows * bits, dtype=np.uint8)
    flat[: len(data)] = np.frombuffer(data, dtype=np.uint8)[: rows * bits]
    padded[:, :bits] = flat.reshape(rows, bits)
    out = np.empty((rows, 8), dtype=np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(8):
        byte, shift = divmod(lane * bits, 8)
        value = np.zeros(rows, dtype=np.uint64)
        for k in range(-(-(bits + shift) // 8)):
            value |= padded[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, lane] = (value >> np.uint64(shift)) & mask
    return out.ravel()[:count]


class TokenWriter:
    """Write one file; ``add`` takes whole documents."""

    def __init__(self, path: str, bits: int, block: int = BLOCK_IDS):
        self.files, self.path = fs.FileSystem.from_uri(path)
        self.uri = path
        self.bits, self.block = bits, block
        self.files.create_dir(os.path.dirname(self.path), recursive=True)
        self.parts: list[bytes] = []
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.offsets, self.docs, self.nulls, self.starts = [0], [], bytearray(), [0]

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError(f"an id needs more than {self.bits} bits")
        self.docs.append(0 if doc is None else doc)
        self.nulls.append(doc is None)
        self.starts.append(self.starts[-1] + len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            rest = np.concatenate(self.waiting)
            whole = len(rest) - len(rest) % self.block
            for first in range(0, whole, self.block):
                self.put(rest[first : first + self.block])
            self.waiting, self.held = [rest[whole:]], len(rest) - whole

    def put(self, ids: np.ndarray) -> None:
        self.parts.append(pack_bits(ids, self.bits))
        self.offsets.append(self.offsets[-1] + len(self.parts[-1]))

    def close(self) -> None:
        if self.held:
            self.put(np.concatenate(self.waiting))
        header = [MAGIC, 1, self.bits, self.block, len(self.docs), self.starts[-1], len(self.offsets) - 1]
        with self.files.open_output_stream(self.path) as out:
            out.write(np.array(header, dtype="<u8").tobytes())
            for part in self.parts:
                out.write(part)
            out.write((np.array(self.offsets, dtype="<u8") + HEADER).astype("<u8").tobytes())
            out.write(np.array(self.docs, dtype="<i8").tobytes())
            out.write(bytes(self.nulls))
            out.write(np.array(self.starts, dtype="<u8").tobytes())


class TokenFile:
    """Read a file: any run of ids, any document."""

    def __init__(self, path: str):
        files, inner = fs.FileSystem.from_uri(path)
        self.source = files.open_input_file(inner)
        head = np.frombuffer(self.source.read_at(HEADER, 0), dtype="<u8").tolist()
        if len(head) != 7 or head[:2] != [MAGIC, 1]:
            raise ValueError(f"{path} is no token file")
        self.bits, self.block, docs, self.n_ids, blocks = head[2:]
        tables = 8 * (blocks + 1) + 17 * docs + 8
        at = self.source.size() - tables
        data = self.source.read_at(tables, at)
        self.offsets = np.frombuffer(data, dtype="<u8", count=blocks + 1).astype(np.int64)
        at = 8 * (blocks + 1)
        nulls = np.frombuffer(data, dtype=np.uint8, count=docs, offset=at + 8 * docs)
        self.docs = [None if gone else doc for doc, gone in zip(np.frombuffer(data, dtype="<i8", count=docs, offset=at).tolist(), nulls)]
        self.starts = np.frombuffer(data, dtype="<u8", count=docs + 1, offset=at + 9 * docs).astype(np.int64)

    def read(self, first: int, count: int) -> np.ndarray:
        """Ids ``first`` to ``first + count``; only their blocks are read."""
        if count <= 0:
            return np.zeros(0, dtype=np.uint32)
        a, b = first // self.block, (first + count - 1) // self.block
        data = self.source.read_at(int(self.offsets[b + 1] - self.offsets[a]), int(self.offsets[a]))
        found = []
        for k in range(a, b + 1):
            part = data[self.offsets[k] - self.offsets[a] : self.offsets[k + 1] - self.offsets[a]]
            found.append(unpack_bits(part, self.bits, min(self.block, self.n_ids - k * self.block)))
        return np.concatenate(found)[first - a * self.block :][:count]

    def document(self, place: int) -> np.ndarray:
        return self.read(int(self.starts[place]), int(self.starts[place + 1] - self.starts[place]))

    def documents(self, limit: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``doc id, start in the file, ids`` of every document, read about ``limit`` ids at a time."""
        place = 0
        while place < len(self.docs):
            end = max(place + 1, int(np.searchsorted(self.starts, self.starts[place] + limit, side="right")) - 1)
            ids = self.read(int(self.starts[place]), int(self.starts[end] - self.starts[place]))
            for k in range(place, end):
                a, b = self.starts[k] - self.starts[place], self.starts[k + 1] - self.starts[place]
                yield self.docs[k], int(self.starts[k]), ids[a:b]
            place = end

    def close(self) -> None:
        self.source.close()


@dataclass(frozen=True)
class TokenFolder:
    """Written files: a table ``file, path, docs, ids, before`` in order, ``before`` counting the ids of earlier files."""

    files: DataFrame

    def read(self) -> DataFrame:
        """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit) of every document."""
        small_batches(self.files.sparkSession)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for path, before in zip(batch["path"], batch["before"]):
                    file = TokenFile(path)
                    rows: list[tuple] = []
                    held = 0
                    for doc, start, ids in file.documents():
                        rows.append((doc, before + start, len(ids), ids.astype("<u4").tobytes()))
                        held += len(ids)
                        if held > 1 << 20:
                            yield frame(rows)
                            rows, held = [], 0
                    yield frame(rows)
                    file.close()

        def frame(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame({
                "doc_id": pd.array([r[0] for r in rows], dtype="Int64"),
                "start": np.array([r[1] for r in rows], dtype=np.int64),
                "n_tokens": np.array([r[2] for r in rows], dtype=np.int64),
                "ids": pd.Series([r[3] for r in rows], dtype=object),
            })

        tasks = max(1, min(READ_TASKS, self.files.count()))
        return self.files.repartition(tasks).mapInPandas(run, "doc_id long, start long, n_tokens long, ids binary")


def range_bounds(docs: DataFrame, part_bytes: int) -> list[tuple]:
    """Keys ``(has an id, id, tie, salt)`` that cut the documents into ranges of about ``part_bytes`` of text.

    They come from a sample of at most about ``SAMPLE`` keys a range and only balance the tasks.
    """
    n, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    cores = docs.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(MAX_PARTS, max(-(-size // part_bytes), min(cores, n // 64))))
    if parts == 1:
        return []
    keys = docs.select("doc_id", "tie", "salt").sample(min(1.0, SAMPLE * parts / n), 1).collect()
    found = sorted(order_key(*r) for r in keys)
    return sorted({found[k * len(found) // parts] for k in range(1, parts)}) if found else []


def order_key(doc: int | None, tie: int, salt: int) -> tuple:
    return (doc is not None, doc or 0, tie, salt)


def encode_ids(docs: DataFrame, bounds: list[tuple], vocab_size: int, end: int | None) -> DataFrame:
    """``part, doc_id, tie, ids`` of every text, null as empty, with the end id; ids take two bytes if the vocabulary allows."""
    last = b"" if end is None else np.array([end], dtype="<u4").tobytes()
    small = id_type(vocab_size)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = ByteTokens()
        for batch in batches:
            found = tokens.encode_all([t if isinstance(t, str) else "" for t in batch["text"]])
            docs = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
            yield pd.DataFrame({
                "part": np.array([bisect.bisect_right(bounds, order_key(*key)) for key in zip(docs, batch["tie"], batch["salt"])], dtype=np.int32),
                "doc_id": pd.array(docs, dtype="Int64"),
                "tie": batch["tie"],
                "ids": [np.frombuffer(data + last, dtype="<u4").astype(small).tobytes() for data in found],
            })

    return docs.mapInPandas(run, "part int, doc_id long, tie long, ids binary")


def id_type(vocab_size: int) -> str:
    return "<u2" if vocab_size <= 1 << 16 else "<u4"


def write_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab_size: int = 50_257, end: int | None = 0,
    folder: str | None = None, file_ids: int = FILE_IDS, part_bytes: int = PART_BYTES,
) -> TokenFolder:
    """Encode every whole text and write the ids to files in ascending order of the document ids.

    Null and empty texts hold the end id alone. Null ids come first; equal ids are in the order of their
    text's hash, and repeated rows each keep their own entry. An empty table gives no files. Other columns play no part.
    Ids are dealt to ranges as they are encoded and shuffled once. Every task writes its ranges to files of about
    ``file_ids`` ids under names of its own, and the returned table names the files of the tasks that
    were committed, so what a lost or repeated task leaves behind is never read. ``folder`` is one
    that all executors reach; by default a new one under the shared checkpoint folder.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or scratch_path(spark, "token-folder")
    text = F.col(text_col)
    salt = F.xxhash64(F.monotonically_increasing_id())  # deals rows that are equal in all else
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), salt.alias("salt"), text.alias("text"))
    bounds = range_bounds(rows, part_bytes)
    bits, kind = max(1, (vocab_size - 1).bit_length()), id_type(vocab_size)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, number, part = None, 0, None
        done: list[tuple] = []

        def finish() -> None:
            nonlocal writer, number
            writer.close()
            done.append((part, number, writer.uri, len(writer.docs), writer.starts[-1]))
            writer, number = None, number + 1

        for batch in batches:
            for mine, doc, data in zip(batch["part"].tolist(), batch["doc_id"], batch["ids"]):
                if writer is not None and (mine != part or writer.starts[-1] >= file_ids):
                    finish()
                if writer is None:
                    number = number if mine == part else 0
                    part = mine
                    writer = TokenWriter(f"{folder}/tokens-{part:06d}-{number:06d}-{uuid.uuid4().hex}.bits", bits)
                writer.add(None if pd.isna(doc) else int(doc), np.frombuffer(data, dtype=kind).astype(np.uint32))
        if writer is not None:
            finish()
        yield pd.DataFrame(done, columns=["part", "number", "path", "docs", "ids"])

    placed = encode_ids(rows, bounds, vocab_size, end).repartitionById(len(bounds) + 1, "part")
    placed = placed.sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "tie").select("part", "doc_id", "ids")
    found = written(placed.mapInPandas(run, "part int, number int, path string, docs long, ids long"), "token-files")
    summed = running_totals(found, ["part", "number"], {"up_to": "ids"})
    return TokenFolder(summed.select("part", "number", "path", "docs", "ids", (F.col("up_to") - F.col("ids")).alias("before")))


def token_rows(folder: TokenFolder, digest: Callable[[bytes], int] = zlib.crc32) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    crc = F.pandas_udf(lambda ids: ids.map(digest).astype("int64"), "long")
    return folder.read().select("doc_id", "start", "n_tokens", crc("ids").alias("ids_crc32"))
