"""Cross-tokenizer alignment with inverted bitmaps of id pairs.

Two tokenizers cut the same bytes. Offsets where tokens of both end cut a document into *groups*; a
token of A and one of B are *linked* where their byte ranges overlap. Corpus-wide, an id pair counts
the documents that hold it linked.

A task encodes documents and collects them in *chunks* (up to 65,536 documents or about
``CHUNK_POSTINGS`` postings). For each id pair of a chunk it writes compressed bitmaps over the chunk's
documents: plane 0 marks those that hold the pair, plane j those whose multiplicity minus one has bit
j - 1 set. Runs of documents are OR-merged into their chunk's bitmaps, chunks follow each other in the
space of all documents, so the popcounts of plane 0 add up to document counts and those of all planes,
weighted, to link counts. The counts are joined to the postings, which carry them back to the documents
of their chunk. A frequent pair is one row per chunk and plane, never a list of documents in one task.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitchside.llm.common import ids_and_text, stored, table
from pitchside.llm.token_store import _LETTERS, Encoder

#: Postings after which a chunk is closed, and the most documents of a chunk (positions are 16 bits).
CHUNK_POSTINGS, CHUNK_DOCS = 2_000_000, 1 << 16
#: Bytes of text aligned at once, and characters of a long text encoded at once.
RUN_BYTES, SEGMENT_CHARS = 1 << 20, 1 << 16
#: Where a text may be cut without changing a token of either kind: a blank between word characters.
_CUT = re.compile(r"(?<=\w) (?=\w)")

INDEX_SCHEMA = ("kind string, chunk long, pos int, doc_id long, n_a long, n_b long, n_groups long, "
              "n_links long, groups_sha256 string, a int, b int, plane int, n int, bits binary")
_ARROW = pa.schema([
    ("kind", pa.string()), ("chunk", pa.int64()), ("pos", pa.int32()), ("doc_id", pa.int64()),
    ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("plane", pa.int32()),
    ("n", pa.int32()), ("bits", pa.binary())])


class _Bytes:
    """The bytes of every token of a vocabulary, laid end to end."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], dtype=np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.size)))[:-1]
        self.flat = np.frombuffer(b"".join(tokens) or b"\0", dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        end = np.cumsum(size)
        shift = np.repeat(self.at[ids] - (end - size), size)
        return self.flat[np.arange(len(shift)) + shift]


class Pair:
    """Both tokenizers: A a byte-level ``tokenizers`` JSON, B a ``sentencepiece`` model."""

    def __init__(self, json_a: str, model_b: bytes):
        import sentencepiece
        self.a = Encoder(json_a)
        self.a.lib.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        letters = {c: n for n, c in _LETTERS.items()}
        vocab = Tokenizer.from_str(json_a).get_vocab()
        names = [""] * (max(vocab.values()) + 1)
        for name, i in vocab.items():
            names[i] = name
        self.bytes_a = _Bytes([bytes(letters[c] for c in t) if all(c in letters for c in t)
                               else t.encode() for t in names])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = _Bytes([bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                               else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        # B may be given a long text in parts only if no piece reaches over the begin of a word.
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        top = max(len(names), len(pieces))
        digits = [str(i).encode() for i in range(top)]
        self.digits = np.array([len(d) for d in digits], dtype=np.int64)
        wide = int(self.digits.max()) + 1
        self.text = np.frombuffer(b"".join(d.ljust(wide, b"\0") for d in digits),
                                  dtype=np.uint8).reshape(top, wide)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both for each text (not empty); A sees a blank before it, B adds its own."""
        segments: list[str] = []
        first = [0]
        for t in texts:
            segments.extend(_segments(" " + t) if self.cuts else [" " + t])
            first.append(len(segments))
        a = self.a.encode(segments)
        b = [np.array(x, dtype=np.int64) for x in self.b.encode([s[1:] for s in segments],
                                                                num_threads=1)]
        join = lambda parts: [np.concatenate(parts[i:j]).astype(np.int64)
                              for i, j in zip(first, first[1:])]
        return join(a), join(b)


def _segments(text: str) -> list[str]:
    """A text in parts of at least ``SEGMENT_CHARS`` characters, each with its leading blank."""
    out, at = [], 0
    while len(text) - at > 2 * SEGMENT_CHARS:
        cut = _CUT.search(text, at + SEGMENT_CHARS)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.start()
    out.append(text[at:])
    return out


@functools.cache
def _pair(json_a: str, model_b: bytes) -> Pair:
    return Pair(json_a, model_b)


def align(pair: Pair, texts: list[str]) -> tuple[dict[str, np.ndarray], list[str], np.ndarray,
                                                 np.ndarray]:
    """Counts per text (``n_a, n_b, n_groups, n_links``), the digest of its groups, and the distinct
    keys (id pair * 65,536 + text number) of its links, ascending, with their multiplicities.

    A text whose joined bytes of either kind differ from blank + text has no tokens."""
    n = len(texts)
    zero = {c: np.zeros(n, dtype=np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
    digests = [""] * n
    raw = {i: b" " + t.encode("utf-8", "surrogatepass") for i, t in enumerate(texts) if t}
    ids_a, ids_b = pair.encode([texts[i] for i in raw]) if raw else ([], [])
    kept = [(i, a, b) for (i, t), a, b in zip(raw.items(), ids_a, ids_b)
            if pair.bytes_a.size[a].sum() == len(t) == pair.bytes_b.size[b].sum()]
    none = np.empty(0, dtype=np.int64)
    if kept:
        buf = np.frombuffer(b"".join(raw[i] for i, _, _ in kept), dtype=np.uint8)
        wrong = ((pair.bytes_a.joined(np.concatenate([a for _, a, _ in kept])) != buf)
                 | (pair.bytes_b.joined(np.concatenate([b for _, _, b in kept])) != buf))
        if wrong.any():
            ends = np.cumsum([len(raw[i]) for i, _, _ in kept])
            bad = np.unique(np.searchsorted(ends, np.flatnonzero(wrong), side="right"))
            kept = [k for j, k in enumerate(kept) if j not in set(bad.tolist())]
    if not kept:
        return zero, digests, none, none
    rows = np.array([i for i, _, _ in kept])
    a, b = (np.concatenate([k[s] for k in kept]) for s in (1, 2))
    n_a, n_b = (np.array([len(k[s]) for k in kept]) for s in (1, 2))
    end_a, end_b = np.cumsum(pair.bytes_a.size[a]), np.cumsum(pair.bytes_b.size[b])
    # Groups end where both end; documents do, so no group reaches over one.
    last_a = end_b[np.searchsorted(end_b, end_a)] == end_a
    last_b = end_a[np.searchsorted(end_a, end_b)] == end_b
    until_a, until_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    doc_a, doc_b = np.cumsum(n_a), np.cumsum(n_b)
    groups = np.diff(np.concatenate(([0], np.searchsorted(until_a, doc_a, side="right"))))
    zero["n_a"][rows], zero["n_b"][rows], zero["n_groups"][rows] = n_a, n_b, groups
    zero["n_links"][rows] = n_a + n_b - groups
    # The groups as text: A's ids and B's of each group in turn, with the mark that follows each.
    place_a = np.arange(len(a)) + np.concatenate(([0], until_b))[group_a]
    place_b = np.arange(len(b)) + until_a[group_b]
    ids, mark = np.empty(len(a) + len(b), dtype=np.int64), np.empty(len(a) + len(b), dtype=np.uint8)
    ids[place_a], ids[place_b] = a, b
    mark[place_a], mark[place_b] = np.where(last_a, 124, 44), np.where(last_b, 59, 44)
    size = pair.digits[ids]
    lines = pair.text[ids]
    lines[np.arange(len(ids)), size] = mark
    flat = lines[np.arange(lines.shape[1]) <= size[:, None]]
    upto = np.concatenate(([0], np.cumsum(size + 1)))[np.concatenate(([0], doc_a + doc_b))]
    for k, i in enumerate(rows):
        digests[i] = hashlib.sha256(flat[upto[k]:upto[k + 1] - 1]).hexdigest()
    # Each stretch between neighbouring ends of either kind lies in one token of both: one link.
    cut = np.union1d(end_a, end_b)
    of_a, of_b = np.searchsorted(end_a, cut), np.searchsorted(end_b, cut)
    doc = rows[np.searchsorted(doc_a, of_a, side="right")]
    keys = ((a[of_a] * len(pair.bytes_b.size) + b[of_b]) << 16) | doc
    return zero, digests, *np.unique(keys, return_counts=True)


def bitmaps(keys: np.ndarray, multiplicity: np.ndarray, docs: int
            ) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
    """``plane, id pairs, popcounts, bitmaps`` of every plane of a chunk of ``docs`` documents."""
    yield from _plane(0, keys, docs)
    more, plane = multiplicity - 1, 1
    while more.any():
        yield from _plane(plane, keys[(more & 1).astype(bool)], docs)
        more, plane = more >> 1, plane + 1


def _plane(plane: int, keys: np.ndarray, docs: int):
    """A bitmap is the ascending 16-bit positions, or plain bits (lowest first) where shorter."""
    if not len(keys):
        return
    wide = -(-docs // 8)
    pairs, at = keys >> 16, (keys & 0xFFFF).astype("<u2")
    first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
    n = np.diff(np.concatenate((first, [len(pairs)])))
    dense = 2 * n > wide
    thin = np.repeat(~dense, n)
    if not dense.all():
        offsets = np.concatenate(([0], np.cumsum(2 * n[~dense]))).astype(np.int32)
        yield plane, pairs[first[~dense]], n[~dense], pa.Array.from_buffers(
            pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()),
                                            pa.py_buffer(at[thin].tobytes())])
    if dense.any():
        size = n[dense]
        row, seen = np.repeat(np.arange(len(size)), size), at[~thin].astype(np.int64)
        packed = np.zeros(len(size) * wide, dtype=np.uint8)
        np.bitwise_or.at(packed, row * wide + (seen >> 3), (1 << (seen & 7)).astype(np.uint8))
        yield plane, pairs[first[dense]], size, pa.array(
            [r.tobytes() for r in packed.reshape(-1, wide)], pa.binary())


def _positions(bits: pa.Array, n: np.ndarray) -> np.ndarray:
    """The document positions of bitmaps with ``n`` documents each, one bitmap after the other."""
    raw = [b.as_buffer() for b in bits]
    return np.concatenate([
        np.frombuffer(b, "<u2").astype(np.int64) if len(b) == 2 * k
        else np.flatnonzero(np.unpackbits(np.frombuffer(b, np.uint8), bitorder="little"))
        for b, k in zip(raw, n)]) if raw else np.empty(0, dtype=np.int64)


def index_documents(docs: DataFrame, json_a: str, model_b: bytes,
                    chunk_postings: int = CHUNK_POSTINGS, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Rows of kind ``doc`` (chunk, position and counts of each document row) and ``pair`` (bitmaps
    of an id pair's planes in a chunk), stored in the shared folder. The sizes bound a task's memory;
    no result depends on them."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast((json_a, model_b))

    def run(batches):
        pair = _pair(*model.value)
        part, seq = TaskContext.get().partitionId(), 0
        size_b = len(pair.bytes_b.size)
        rows: list[pa.RecordBatch] = []
        keys, counts, held, docs_held = [], [], 0, 0

        def batch(size: int, /, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [columns[f.name] if isinstance(columns.get(f.name), pa.Array)
                 else pa.array(columns[f.name], f.type) if f.name in columns
                 else pa.nulls(size, f.type) for f in _ARROW], schema=_ARROW)

        def chunk() -> Iterator[pa.RecordBatch]:
            here = (part << 32) | seq
            for ids, first, zero, digests in rows:
                n = len(ids)
                yield batch(n, kind=["doc"] * n, chunk=[here] * n, doc_id=ids,
                            pos=np.arange(first, first + n, dtype=np.int32),
                            groups_sha256=digests, **zero)
            if keys:
                every, times = np.concatenate(keys), np.concatenate(counts)
                order = np.argsort(every, kind="stable")
                for plane, pairs, n, bits in bitmaps(every[order], times[order], docs_held):
                    for s in range(0, len(pairs), 50_000):
                        p = pairs[s:s + 50_000]
                        yield batch(len(p), kind=["pair"] * len(p), chunk=np.full(len(p), here),
                                    a=(p // size_b).astype(np.int32),
                                    b=(p % size_b).astype(np.int32),
                                    plane=np.full(len(p), plane, np.int32),
                                    n=n[s:s + 50_000].astype(np.int32),
                                    bits=bits.slice(s, 50_000))

        for ids, texts in _runs(batches, run_bytes):
            if docs_held and (held >= chunk_postings or docs_held + len(ids) > CHUNK_DOCS):
                yield from chunk()
                rows, keys, counts, held, docs_held, seq = [], [], [], 0, 0, seq + 1
            zero, digests, k, m = align(pair, texts)
            rows.append((ids, docs_held, zero, digests))
            keys.append(k + docs_held)
            counts.append(m)
            held += len(k)
            docs_held += len(ids)
        if docs_held:
            yield from chunk()

    return stored(ids_and_text(docs).mapInArrow(run, INDEX_SCHEMA), "token-pairs")


def _runs(batches, run_bytes: int) -> Iterator[tuple[list[int | None], list[str]]]:
    """Documents in runs of about ``run_bytes`` characters; a longer text stands alone, whole."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id"), batch.column("text")):
            text = text.as_py()
            if texts and (size + len(text) > run_bytes or len(texts) == CHUNK_DOCS):
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc.as_py())
            texts.append(text)
            size += len(text)
    if texts:
        yield ids, texts


def pair_counts(index: DataFrame) -> DataFrame:
    """``a, b, n_docs, n_links, best``: documents that hold the pair linked, link occurrences, and
    whether no other B id of the same A id has more documents."""
    weight = F.when(F.col("plane") == 0, 1).otherwise(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.col("plane") - 1))
    counts = (index.filter("kind = 'pair'").groupBy("a", "b").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n")).otherwise(0)).alias("n_docs"),
        F.sum(weight * F.col("n")).alias("n_links")))
    top = counts.groupBy("a").agg(F.max("n_docs").alias("top"))
    return counts.join(top, "a").select("a", "b", "n_docs", "n_links",
                                        (F.col("n_docs") == F.col("top")).alias("best"))


def document_scores(index: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document row: the counts of ``index`` and, brought back by the postings of each chunk,
    ``n_best`` (links whose pair is its A id's most frequent) and ``count_sum`` (of pair counts)."""
    docs = index.filter("kind = 'doc'").select("chunk", "pos", "doc_id", "n_a", "n_b", "n_groups",
                                               "n_links", "groups_sha256")
    postings = (index.filter("kind = 'pair'").select("chunk", "a", "b", "plane", "n", "bits")
                .join(counts.select("a", "b", "n_docs", "best"), ["a", "b"])
                .select(F.col("chunk").alias("of"), "plane", "n", "bits", "n_docs", "best"))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        pos = left.column("pos").to_numpy()
        size = int(pos.max()) + 1 if len(pos) else 0
        best, total = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        for part in right.to_batches(max_chunksize=20_000):
            n = part.column("n").to_numpy()
            plane = part.column("plane").to_numpy().astype(np.int64)
            times = np.left_shift(np.int64(1), np.maximum(plane - 1, 0))
            at = _positions(part.column("bits"), n)
            np.add.at(total, at, np.repeat(times * part.column("n_docs").to_numpy(), n))
            top = part.column("best").to_numpy(zero_copy_only=False)
            np.add.at(best, at, np.repeat(np.where(top, times, 0), n))
        return pa.table([*(left.column(c) for c in _OUT[:6]), pa.array(best[pos]),
                         pa.array(total[pos])], names=_OUT)

    return (docs.groupBy("chunk").cogroup(postings.groupBy("of"))
            .applyInArrow(score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                 "groups_sha256 string, n_best long, count_sum long"))


_OUT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def align_documents(docs: DataFrame, tokenizer_a: str, model_b: str) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id and text; others are not read, so names cannot
    clash) with counts, groups digest and scores.

    ``tokenizer_a`` and ``model_b`` are paths on the driver. Null and empty texts, and texts whose
    joined token bytes differ from blank + text, have zeros and ''. Repeated rows are documents of
    their own and count as such; a null doc_id stays null. An empty table gives no rows. A task
    holds about 1 MB of text, or one longer text whole, and one chunk of postings."""
    with open(tokenizer_a, encoding="utf-8") as f, open(model_b, "rb") as g:
        index = index_documents(docs, f.read(), g.read())
    return document_scores(index, pair_counts(index))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return align_documents(table(spark, sf_dir, "documents"),
                           public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))
