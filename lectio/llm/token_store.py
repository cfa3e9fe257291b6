"""Token ids as binary blocks whose document boundaries are Elias-Fano coded.

Documents are dealt to partitions by ranges of doc_id and sorted; each task encodes its documents and packs them into
blocks. A block is one binary value (a row of a Parquet table, so any file system that Spark writes will do):

    magic, version, bytes of an id, documents, documents without a doc_id, least doc_id, ids, length of the two codes
    Elias-Fano code of doc_id - least doc_id (those without a doc_id come first and are left out)
    Elias-Fano code of each document's end within the block
    the ids, little-endian

Select on the upper bits gives a document's offset; there is no table of 64-bit offsets.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectio.llm.common import stored, table, texts
from lectio.llm.pieces import PieceTable, id_type, slices

HEADER = struct.Struct("<4sHHIIqQII")
MAGIC, VERSION = b"TIDS", 1
BLOCK_IDS = 1 << 20
#: A control character that stands between pieces and is a token of its own.
MARK = "\x01"
SAMPLE = 4096
BLOCK_SCHEMA = "part int, block int, n_docs long, n_ids long, payload binary"


class EliasFano:
    """A sequence that never falls, of n values below ``universe``: low bits packed, high bits in unary with a select sample."""

    HEAD = struct.Struct("<IBII")

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, sample: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.sample = n, low_bits, low, high, sample

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        high = np.zeros((n + (universe >> low_bits) + 1 + 7) // 8 * 8, np.uint8)
        high[((values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)).astype(np.int64)] = 1
        high = np.packbits(high, bitorder="little")
        return cls(n, low_bits, low, high, cls._ranks(high))

    @staticmethod
    def _ranks(high: np.ndarray) -> np.ndarray:
        """Ones before each run of SAMPLE bits."""
        sums = np.add.reduceat(np.bitwise_count(high).astype(np.uint32), np.arange(0, len(high), SAMPLE // 8)) if len(high) else np.zeros(0, np.uint32)
        return np.concatenate([[0], np.cumsum(sums)[:-1]]).astype("<u4")

    def select(self, i: int) -> int:
        """Value number i, by the sample and a scan of at most SAMPLE bits after it."""
        at = int(np.searchsorted(self.sample, i, "right")) - 1
        bits = np.unpackbits(self.high[at * SAMPLE // 8 : (at + 1) * SAMPLE // 8], bitorder="little")
        one = int(np.flatnonzero(bits)[i - int(self.sample[at])]) + at * SAMPLE
        low = 0
        if self.low_bits:
            first = i * self.low_bits
            packed = int.from_bytes(self.low[first // 8 : (first + self.low_bits + 7) // 8].tobytes(), "little")
            low = packed >> (first % 8) & ((1 << self.low_bits) - 1)
        return (one - i) << self.low_bits | low

    def select_range(self, a: int, b: int) -> np.ndarray:
        """Values number a to b - 1: the sample says which runs of bits hold them, and only those are read."""
        if a >= b:
            return np.zeros(0, np.int64)
        at, to = int(np.searchsorted(self.sample, a, "right")) - 1, int(np.searchsorted(self.sample, b - 1, "right"))
        bits = np.unpackbits(self.high[at * SAMPLE // 8 : to * SAMPLE // 8], bitorder="little")
        before = int(self.sample[at])
        high = np.flatnonzero(bits)[a - before : b - before] + at * SAMPLE - np.arange(a, b)
        first, size = a * self.low_bits, (b - a) * self.low_bits
        packed = np.unpackbits(self.low[first // 8 : (first + size + 7) // 8], bitorder="little")[first % 8 : first % 8 + size].reshape(b - a, self.low_bits)
        return (high.astype(np.int64) << self.low_bits) + packed.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))

    def values(self) -> np.ndarray:
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n] - np.arange(self.n)
        bits = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits)
        low = bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))
        return (high.astype(np.int64) << self.low_bits) + low

    def to_bytes(self) -> bytes:
        return self.HEAD.pack(self.n, self.low_bits, len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes() + self.sample.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, a, b = cls.HEAD.unpack_from(data)
        body = np.frombuffer(data, np.uint8, offset=cls.HEAD.size)
        return cls(n, low_bits, body[:a], body[a : a + b], body[a + b :].view("<u4") if len(body) > a + b else np.zeros(0, "<u4"))


def pack(doc_ids: list[int | None], lengths: list[int], ids: bytes, width: int) -> bytes:
    there = np.array([x for x in doc_ids if x is not None], np.int64)
    least = int(there[0]) if len(there) else 0
    names = EliasFano.build(there.astype(np.uint64) - np.uint64(least % (1 << 64))).to_bytes()
    ends = EliasFano.build(np.cumsum(np.array(lengths, np.int64))).to_bytes()
    return HEADER.pack(MAGIC, VERSION, width, len(doc_ids), len(doc_ids) - len(there), least, len(ids) // width, len(names), len(ends)) + names + ends + ids


@dataclass
class Block:
    """A block that was read: ``nameless`` documents without a doc_id, then those of ``names``; ``ends`` of all; the ids."""

    n: int
    nameless: int
    least: int
    names: EliasFano
    ends: EliasFano
    ids: np.ndarray

    @classmethod
    def read(cls, payload: bytes) -> Block:
        magic, version, width, n, nameless, least, n_ids, a, b = HEADER.unpack_from(payload)
        if (magic, version) != (MAGIC, VERSION):
            raise ValueError("not a block of token ids")
        at = HEADER.size
        names, ends = EliasFano.from_bytes(payload[at : at + a]), EliasFano.from_bytes(payload[at + a : at + a + b])
        return cls(n, nameless, least, names, ends, np.frombuffer(payload, f"<u{width}", n_ids, at + a + b))

    def bounds(self, a: int, b: int) -> np.ndarray:
        """Where documents number a to b - 1 begin, and where the last of them ends."""
        return self.ends.select_range(a - 1, b) if a else np.append(0, self.ends.select_range(0, b))

    def doc_ids(self, a: int, b: int) -> list[int | None]:
        none = max(0, min(b, self.nameless) - a)
        named = self.names.select_range(max(a - self.nameless, 0), max(b - self.nameless, 0)) + self.least
        return [None] * none + named.tolist()


_CODERS: dict[tuple, tuple] = {}


def _coder(path: str, drops_white_space: bool):
    """(encode, id type) of this worker for a tokenizer file."""
    if (path, drops_white_space) not in _CODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        kind = id_type(tok.get_vocab_size(with_added_tokens=True))

        def plain(xs):
            return [np.array(e.ids, kind).tobytes() for e in tok.encode_batch_fast(xs, add_special_tokens=False)]

        mark = tok.encode(MARK, add_special_tokens=False).ids

        def joined(xs):
            """Many pieces in one call, between marks: a call for each piece costs more than its encoding."""
            found = {x: plain([x])[0] for x in xs if MARK in x}
            rest = [x for x in xs if MARK not in x]
            for i in range(0, len(rest), 2000):
                part = rest[i : i + 2000]
                ids = np.array(tok.encode_batch_fast([f" {MARK} ".join(part)], add_special_tokens=False)[0].ids, kind)
                cuts = (np.flatnonzero(ids == mark[0]) * kind.itemsize).tolist()
                data = ids.tobytes()
                found.update(zip(part, (data[a:b] for a, b in zip([0, *(c + kind.itemsize for c in cuts)], [*cuts, len(data)]))))
            return list(map(found.__getitem__, xs))

        _CODERS[path, drops_white_space] = PieceTable(joined if len(mark) == 1 else plain, kind).encode if drops_white_space else plain, kind
    return _CODERS[path, drops_white_space]


def write_blocks(docs: DataFrame, tokenizer: str, end_id: int, drops_white_space: bool = False, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode each text with a tokenizers file, add end_id, and return the written blocks (part, block, n_docs, n_ids, payload).

    Blocks in order of (part, block) hold the documents in order of doc_id (as a long), null first, then of text: repeated
    rows and ids are documents of their own. A null text is empty and has the end id alone. A block takes whole documents up to
    block_ids ids, and a longer document alone. drops_white_space: only for tokenizers without tokens over white space.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, kind = _coder(tokenizer, drops_white_space)
        part, number, end = TaskContext.get().partitionId(), 0, np.array([end_id], kind).tobytes()
        names, lengths, held, size = [], [], [], 0

        def block():
            nonlocal number, names, lengths, held, size
            out = pa.RecordBatch.from_pylist([{"part": part, "block": number, "n_docs": len(names), "n_ids": size, "payload": pack(names, lengths, b"".join(held), kind.itemsize)}], pa.schema([("part", pa.int32()), ("block", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())]))
            number, names, lengths, held, size = number + 1, [], [], [], 0
            return out

        for batch in batches:
            ids, said = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(said, most_chars=1_000_000):
                for doc_id, x in zip(ids[a:b], coder(said[a:b])):
                    n = len(x) // kind.itemsize + 1
                    if size and size + n > block_ids:
                        yield block()
                    names.append(doc_id)
                    lengths.append(n)
                    held += (x, end)
                    size += n
        if names:
            yield block()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # by how the text begins too, so that rows without an id, or with one that many have, are several ranges
    dealt = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    dealt = dealt.repartitionByRange(parts, "doc_id", F.left("text", F.lit(200))).sortWithinPartitions("doc_id", "text")
    return stored(dealt.mapInArrow(encode, BLOCK_SCHEMA), "token-blocks")


def read_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks -> one row per document: doc_id, start (ids of all documents before it), ids (little-endian, 32 bits each)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.read(row["payload"])
                for a in range(0, block.n, 1000):
                    b = min(a + 1000, block.n)
                    bounds = block.bounds(a, b)
                    wide = block.ids[bounds[0] : bounds[-1]].astype("<u4").tobytes()
                    cuts = ((bounds - bounds[0]) * 4).tolist()
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row["part"]] * (b - a), pa.int32()), pa.array([row["block"]] * (b - a), pa.int32()), pa.array(block.doc_ids(a, b), pa.int64()), pa.array(bounds[:-1]),
                        pa.array([wide[i:j] for i, j in zip(cuts, cuts[1:])], pa.binary()),
                    ], ["part", "block", "doc_id", "begin", "ids"])

    return blocks.select("part", "block", "payload").mapInArrow(decode, "part int, block int, doc_id long, begin long, ids binary")


def block_starts(blocks: DataFrame) -> DataFrame:
    """part, block, offset: the ids before each block. Sums of the parts first; there are as many as tasks that wrote."""
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = parts.select("part", (F.sum("ids").over(W.orderBy("part")) - F.col("ids")).alias("before"))
    within = blocks.select("part", "block", (F.sum("n_ids").over(W.partitionBy("part").orderBy("block")) - F.col("n_ids")).alias("within"))
    return within.join(before, "part").select("part", "block", (F.col("before") + F.col("within")).alias("offset"))


def summary(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, read back from the blocks; what is joined is a few numbers a document."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [x.as_py() for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("part", "block", "doc_id", "begin")), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64())], ["part", "block", "doc_id", "begin", "n_tokens", "ids_crc32"])

    each = read_blocks(blocks).mapInArrow(crc, "part int, block int, doc_id long, begin long, n_tokens long, ids_crc32 long")
    return each.join(block_starts(blocks), ["part", "block"]).select("doc_id", (F.col("offset") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents, written as blocks and read back -> doc_id, start, n_tokens, ids_crc32. Null texts, equal and null ids: see write_blocks()."""
    import public_tokenizers

    blocks = write_blocks(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, drops_white_space=True)
    return summary(blocks)
