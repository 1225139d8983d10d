"""Token files: ids of fixed width in packed blocks.

Every id takes the least number of bits that the vocabulary needs. A block
holds whole documents and closes at ``BLOCK_IDS`` ids or more:

    "TPK1" | width u8 | documents u32 | ids u64 | starts u64 x (documents + 1) | bits

all little-endian; ``starts`` are the documents' first ids within the block,
and id k has the bits k*width to (k+1)*width, lowest first. So any document or
id range of a block is read by address and unpacked by numpy, without the rest.

A token file set is a table of such blocks (Parquet rows, written by Spark to
whatever store the path names): ``part`` and ``local_start`` order the blocks,
``doc_ids`` names a block's documents. Documents are range-partitioned and
sorted by doc_id, so part order is doc_id order; only one total per part
reaches the driver. Each document ends with ``end_id``.

Defined results: null and empty texts are the end id alone; documents with
equal ids stand side by side in text order, a null id comes first; an empty
table gives an empty set. Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.llm.bpe import _UNSAFE, TOKENIZER, PieceEncoder, byte_alphabet
from clusterlens.llm.common import map_batches, per_worker, table, texts
from clusterlens.session import scratch_path

BLOCK_IDS = 65_536
END_ID = 0
_MAGIC = b"TPK1"
_HEAD = "<4sBIQ"


def width_of(vocabulary_size: int) -> int:
    """Bits that hold every id below ``vocabulary_size``."""
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    ids = np.asarray(ids, np.uint64)
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id does not fit into {width} bits")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data, width: int, first: int, count: int, offset: int = 0) -> np.ndarray:
    """Ids ``first`` to ``first + count`` of the bits at ``data[offset:]``;
    only the bytes that hold them are touched."""
    if width in (8, 16, 32):
        size = width // 8
        return np.frombuffer(data, f"<u{size}", count, offset + first * size).astype(np.uint32)
    begin, end = first * width, (first + count) * width
    raw = np.frombuffer(data, np.uint8, (end + 7) // 8 - begin // 8, offset + begin // 8)
    raw = np.concatenate((raw, np.zeros(8, np.uint8))).astype(np.uint64)
    at = np.arange(count, dtype=np.int64) * width + begin % 8
    value = np.zeros(count, np.uint64)
    for k in range((width + 14) // 8):          # bytes that one id can touch
        value |= raw[(at >> 3) + k] << np.uint64(8 * k)
    return ((value >> (at & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.uint32)


def make_block(documents: list[np.ndarray], width: int) -> bytes:
    starts = [0, *accumulate(len(d) for d in documents)]
    ids = np.concatenate(documents) if documents else np.empty(0, np.uint32)
    return (struct.pack(_HEAD, _MAGIC, width, len(documents), len(ids))
            + np.array(starts, "<u8").tobytes() + pack(ids, width))


class Block:
    """Random access to the documents of one block."""

    def __init__(self, data: bytes):
        magic, self.width, n, self.n_ids = struct.unpack_from(_HEAD, data)
        if magic != _MAGIC:
            raise ValueError("not a token block")
        self.data = data
        self.starts = np.frombuffer(data, "<u8", n + 1, struct.calcsize(_HEAD)).astype(np.int64)
        self._bits = struct.calcsize(_HEAD) + 8 * (n + 1)

    def __len__(self) -> int:
        return len(self.starts) - 1

    def ids(self, first: int, count: int) -> np.ndarray:
        if first < 0 or first + count > self.n_ids:
            raise IndexError("ids outside the block")
        return unpack(self.data, self.width, first, count, self._bits)

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1] - self.starts[k]))


class LibraryEncoder(PieceEncoder):
    """The tokenizers library, its model called once per new pretoken.

    A text in which white space meets a space, or with added tokens, goes to
    the library whole (see ``bpe``).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        super().__init__({t.content: i for i, t in
                          self.tokenizer.get_added_tokens_decoder().items()})
        self.tokenize = self.tokenizer.model.tokenize
        # how a byte, read as a Latin-1 character, is written in the vocabulary
        self.shown = {b: c for c, b in byte_alphabet().items()}

    def encode_word(self, word: str) -> bytes:
        shown = word.encode("utf-8").decode("latin-1").translate(self.shown)
        ids = [t.id for t in self.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> np.ndarray:
        if _UNSAFE.search(text) or any(a in text for a in self.added_ids):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return np.frombuffer(self._safe(text), "<u4")


def library_encoder(path: str) -> LibraryEncoder:
    return per_worker(("library", path), lambda: LibraryEncoder(path))


def _block_schema(kind: str) -> str:
    return f"part int, local_start long, n_ids long, doc_ids array<{kind}>, block binary"


def write(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
          tokenizer: str = TOKENIZER, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Encode the documents and write their blocks under ``path``."""
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = _block_schema(kind)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        from pyspark import TaskContext
        part, enc = TaskContext.get().partitionId(), library_encoder(tokenizer)
        width, end = width_of(enc.size), np.array([end_id], "<u4")
        names, held, size, start = [], [], 0, 0

        def block():
            return pa.RecordBatch.from_pydict(
                {"part": [part], "local_start": [start], "n_ids": [size], "doc_ids": [names],
                 "block": [make_block(held, width)]}, schema=arrow)

        for batch in batches:
            for key, t in zip(batch.column(0), texts(batch.column(1))):
                ids = np.concatenate((enc.encode(t), end))
                names.append(key.as_py())
                held.append(ids)
                size += len(ids)
                if size >= block_ids:
                    yield block()
                    names, held, start, size = [], [], start + size, 0
        if held:
            yield block()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
               .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text"))
    ordered.mapInArrow(run, schema).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``: the ids of all blocks before."""
    blocks = spark.read.parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()   # a row per part
    sizes = sorted((r["part"], r["n"]) for r in totals)
    before = dict(zip((p for p, _ in sizes), accumulate((n for _, n in sizes), initial=0)))
    offsets = F.create_map(*[F.lit(x) for p, n in before.items() for x in (p, n)]) \
        if before else F.create_map(F.lit(0), F.lit(0))
    offset = F.element_at(offsets.cast("map<int,bigint>"), F.col("part"))
    return blocks.withColumn("start", offset + F.col("local_start"))


def documents(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, unpacked."""
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            out = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
            for ids, start, data in zip(*batch.columns):
                block, first = Block(data.as_py()), start.as_py()
                out["doc_id"] += ids.as_py()
                out["start"] += (block.starts[:-1] + first).tolist()
                out["n_tokens"] += np.diff(block.starts).tolist()
                out["ids_crc32"] += [zlib.crc32(block.document(k).astype("<u4").tobytes())
                                     for k in range(len(block))]
            return out
        return run

    return map_batches(blocks.select("doc_ids", "start", "block"), make,
                       f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write(table(spark, sf_dir, "documents"), path)
    return documents(read(spark, path))
