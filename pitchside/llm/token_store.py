"""Token-id output: fixed-width bit packing with block offsets, written and read back by Spark.

Every id takes the minimum number of bits that holds the vocabulary (16 for 50,257 ids), most
significant bit first. A *block* is one self-contained byte string:

    magic ``TPK1`` | bits u32 | documents u64 | ids u64 | doc_id i64 * documents
    | first id of each document u64 * (documents + 1) | packed ids

so the i-th id stands at bit ``i * bits`` of the packed part and any run of ids, or the documents
around an id, are found without reading the rest. Blocks are rows of Parquet files in ascending
doc_id order (``part``, ``seq``, ``n_ids``, ``block``), which keeps the files readable by every
store that Spark reads.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitchside.llm.common import ids_and_text, scratch, table

MAGIC = b"TPK1"
END_ID = 0
#: Ids of a block (a longer document stands alone in its block, whole).
BLOCK_IDS = 1 << 20
#: Word pieces whose ids a task remembers; when it is full it starts afresh.
MEMO_WORDS = 600_000


def min_bits(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids at ``bits`` bits each, most significant bit first."""
    b = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(b[:, 32 - bits:]).tobytes()


def unpack(packed: np.ndarray, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start:stop`` of a packed byte array; touches only the bytes they stand in."""
    at = np.arange(start, stop, dtype=np.int64) * bits
    base = int(at[0] >> 3) if len(at) else 0
    last = int((at[-1] + bits + 7) >> 3) if len(at) else 0
    bytes_ = np.concatenate((packed[base:last], np.zeros(5, dtype=np.uint8))).astype(np.uint64)
    i = (at >> 3) - base
    word = np.zeros(len(at), dtype=np.uint64)
    for k in range(5):
        word = (word << np.uint64(8)) | bytes_[i + k]
    shift = (40 - bits - (at & 7)).astype(np.uint64)
    return ((word >> shift) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def make_block(doc_ids: list[int], ids: list[np.ndarray], bits: int) -> bytes:
    first = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype("<u8")
    head = np.array([bits], dtype="<u4").tobytes() + np.array(
        [len(doc_ids), int(first[-1])], dtype="<u8").tobytes()
    return (MAGIC + head + np.array(doc_ids, dtype="<i8").tobytes() + first.tobytes()
            + pack(np.concatenate(ids), bits))


class Block:
    """A block opened for random access."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token block")
        self.bits = int(np.frombuffer(data, "<u4", 1, 4)[0])
        docs, self.n_ids = (int(x) for x in np.frombuffer(data, "<u8", 2, 8))
        self.doc_ids = np.frombuffer(data, "<i8", docs, 24)
        self.first = np.frombuffer(data, "<u8", docs + 1, 24 + 8 * docs).astype(np.int64)
        self.packed = np.frombuffer(data, np.uint8, offset=32 + 16 * docs)

    def ids(self, start: int, stop: int) -> np.ndarray:
        return unpack(self.packed, self.bits, start, stop)

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.first[i]), int(self.first[i + 1]))


def _class(*kinds: str) -> str:
    """Character class of the plain range whose general categories start with one of ``kinds``."""
    return "".join(re.escape(chr(c)) for c in _PLAIN if unicodedata.category(chr(c))[0] in kinds)


#: Characters of the fast path: printable ASCII, tab, line ends and Latin letters and signs, whose
#: categories have been settled for decades. Other texts go to the library whole.
_PLAIN = [9, 10, 13, *range(32, 127), *range(0xA1, 0xAD), *range(0xAE, 0x220)]
_PLAIN_TEXT = re.compile("[" + "".join(re.escape(chr(c)) for c in _PLAIN) + "]*")
_L, _N = _class("L"), _class("N")
# Alternatives that start alike keep the pattern's order; the most frequent comes first.
_WORD = re.compile(rf" ?[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_N}]+| ?[^\t\n\r {_L}{_N}]+"
                   r"|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others, in order, for the
    characters from U+0100 on."""
    own = [*range(33, 127), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


class _Memo(dict):
    """Word piece -> its number; new pieces are listed in ``fresh``."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        self.fresh.append(piece)
        return n


def _plain_byte_level(spec: dict) -> bool:
    """Whether the tokenizer does nothing to a text but cut it by the byte-level pattern and merge."""
    cut, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    return (spec.get("normalizer") is None and spec.get("truncation") is None
            and spec.get("padding") is None and cut.get("type") == "ByteLevel"
            and cut.get("add_prefix_space") is False and cut.get("use_regex", True) is True
            and model.get("type", "BPE") == "BPE" and not model.get("dropout"))


class Encoder:
    """``tokenizers`` with a memory of word pieces: merges never cross the pieces that the
    byte-level pattern cuts, so the ids of a text are those of its pieces in order, and the
    library's model merges each distinct piece once. Texts outside the plain range, or with a
    special token's text, and all texts of a tokenizer that cuts or changes them in another way, are
    encoded whole by the library."""

    def __init__(self, tokenizer: str):
        self.lib = Tokenizer.from_str(tokenizer)
        self.merge = self.lib.model.tokenize
        self.plain = _plain_byte_level(json.loads(tokenizer))
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        self.memo = _Memo()
        self.at = np.zeros(1, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        words, odd = {}, []
        if len(self.memo) > MEMO_WORDS:
            self._clear()
        number = self.memo.__getitem__
        for i, t in enumerate(texts):
            if self.plain and _PLAIN_TEXT.fullmatch(t) and not any(s in t for s in self.special):
                pieces = _WORD.findall(t)
                words[i] = np.fromiter(map(number, pieces), dtype=np.int64, count=len(pieces))
            else:
                odd.append(i)
        if self.memo.fresh:
            found = [[x.id for x in self.merge(
                p.encode().decode("latin-1").translate(_LETTERS))] for p in self.memo.fresh]
            self.memo.fresh.clear()
            n = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            self.at = np.concatenate((self.at, self.at[-1] + np.cumsum(n)))
            self.ids = np.concatenate((self.ids, np.fromiter((x for f in found for x in f),
                                                             dtype=np.uint32, count=int(n.sum()))))
        for i, w in words.items():
            n = self.at[w + 1] - self.at[w]
            end = np.cumsum(n)
            total = int(end[-1]) if len(end) else 0
            out[i] = self.ids[np.arange(total) + np.repeat(self.at[w] - (end - n), n)]
        for i, e in zip(odd, self.lib.encode_batch([texts[i] for i in odd],
                                                   add_special_tokens=False)):
            out[i] = np.array(e.ids, dtype=np.uint32)
        return out


@functools.cache
def _encoder(tokenizer: str) -> Encoder:
    """One encoder per worker process: what it remembers serves the tasks that follow."""
    return Encoder(tokenizer)


def _blocks(rows: Iterator[tuple[int, np.ndarray]], bits: int):
    docs, ids, size = [], [], 0
    for doc, x in rows:
        if docs and size + len(x) > BLOCK_IDS:
            yield size, make_block(docs, ids, bits)
            docs, ids, size = [], [], 0
        docs.append(doc)
        ids.append(x)
        size += len(x)
    if docs:
        yield size, make_block(docs, ids, bits)


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Encode whole texts and write the blocks to ``path`` in ascending doc_id order.

    ``tokenizer`` is the library's JSON text. A null text is an empty one (its ids are the end id
    alone); rows of one doc_id follow each other in the order of their texts' hashes; rows without
    doc_id come first, under the smallest long.
    """
    spark = docs.sparkSession
    bits = min_bits(Tokenizer.from_str(tokenizer).get_vocab_size())
    model = spark.sparkContext.broadcast(tokenizer)
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_ids", pa.int64()),
                        ("block", pa.binary())])

    def run(batches):
        part = TaskContext.get().partitionId()
        encoder = _encoder(model.value)

        def encoded():
            end = np.array([end_id], dtype=np.uint32)
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                for s in range(0, len(ids), 256):
                    texts = batch.column("text").slice(s, 256).to_pylist()
                    for doc, x in zip(ids[s:s + 256], encoder.encode(texts)):
                        yield doc, np.concatenate((x, end))

        for seq, (n, block) in enumerate(_blocks(encoded(), bits)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                 pa.array([n], pa.int64()), pa.array([block], pa.binary())], schema=schema)

    rows = ids_and_text(docs).select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), "text",
        F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    # The row number lets a range boundary fall inside a doc_id that many rows repeat.
    ordered = (rows.repartitionByRange("doc_id", "h", "row")
               .sortWithinPartitions("doc_id", "h", "row"))
    (ordered.select("doc_id", "text").mapInArrow(run, "part int, seq int, n_ids long, block binary")
     .write.parquet(path))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``, the number of ids in all blocks before."""
    blocks = spark.read.parquet(path)
    sizes = blocks.select("part", "seq", "n_ids")           # one row per block
    per_part = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = per_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n"))
                             .alias("base"))                # one row per written partition
    inside = Window.partitionBy("part").orderBy("seq")
    starts = (sizes.withColumn("inside", F.sum("n_ids").over(inside) - F.col("n_ids"))
              .join(before, "part").select("part", "seq", (F.col("base") + F.col("inside"))
                                           .alias("start")))
    return blocks.join(starts, ["part", "seq"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            for data, start in zip(batch.column("block"), batch.column("start")):
                block = Block(data.as_py())
                ids = block.ids(0, block.n_ids).astype("<u4")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(block.first[:-1], block.first[1:])]
                none = block.doc_ids == -(1 << 63)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.doc_ids, pa.int64(), mask=none),
                     pa.array(block.first[:-1] + start.as_py()),
                     pa.array(np.diff(block.first)), pa.array(crc, pa.int64())], schema=schema)

    return read_blocks(spark, path).select("block", "start").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def stored_ids(spark: SparkSession, docs: DataFrame, tokenizer_path: str,
               out: str | None = None) -> DataFrame:
    """Write the token files (to ``out``, else to the shared scratch folder) and report from them,
    one row per document row. An empty table gives no rows."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = f.read()
    out = out or scratch(spark, "token-ids")
    write_ids(docs, tokenizer, out)
    return read_documents(spark, out)


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return stored_ids(spark, table(spark, sf_dir, "documents"),
                      public_tokenizers.path("byte_bpe_50k.json"))
