"""Suffix-array dedup: remove every byte covered by a 400-byte string that starts anywhere else too.

The suffixes that are sorted against each other start at *anchors*: positions whose 32-byte gram
hashes to 0 modulo 48. An anchor depends on its own bytes alone, so equal strings have equal anchors.
Every position that can start a repeat belongs to the first anchor at or after it (at most 272 bytes
on), or, if there is none, is *bare* and compared by itself.

This replaces the merging of shard Burrows-Wheeler transforms by interleave refinement, which is not
built: there is no transform, no merged order and no common-prefix value. A *block* is the set of
suffixes that agree to a depth; it is known by a hash label, and blocks of one label are counted by
a grouping. Blocks are refined from depth 0 to 128 bytes and then to the whole context of an anchor (its positions' strings together); a block with one member left is a
suffix whose common prefix with every other ends there, and is dropped. Blocks that stay whole are
repeated intervals. Where a block splits inside a context, its positions are refined in steps of
eight and then, at the ends of the repeated intervals only, one by one, to depth 400.

Labels are 64-bit hashes of the compared bytes, paired with the label of the level above.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm.common import drop_stored, ids_and_text, stored, table
from pitchside.llm.jaccard_join import FILTER_BITS, id_filter
from pitchside.llm.textnum import U, chunks, mix, prefix_sums, span_hash

LENGTH = 400
GRAM, RATE, DEPTH = 32, 48, 128
REACH = LENGTH - DEPTH
#: Positions of a context that are labelled together before any is labelled alone.
STEP = 8
RUN_BYTES = 2 << 20

SCAN = [("lo", pa.int32()), ("hi", pa.int32()), ("at", pa.int32()), ("block", pa.int64()),
        ("context", pa.int64())]


class Scan:
    """Anchors, contexts and bare positions of a run of texts, vectorised over all its bytes.

    For anchor row r of text ``text[r]``: the positions ``lo..hi`` of which it is the first anchor
    (offsets in the text), its own offset ``at``, and the labels ``block`` and ``context``."""

    def __init__(self, texts: list[bytes]):
        buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
        size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        end = np.cumsum(size)
        start = end - size
        s = prefix_sums(buf)
        at = np.empty(0, dtype=np.int64)
        if len(buf) >= GRAM:
            every = np.arange(len(buf) - GRAM + 1)
            at = np.flatnonzero(mix(span_hash(s, every, every + GRAM)) % U(RATE) == 0)
        text = np.searchsorted(end, at, side="right")
        inside = at + GRAM <= end[text] if len(at) else np.empty(0, dtype=bool)
        at, text = at[inside], text[inside]
        before = np.concatenate(([-1], at[:-1]))
        before = np.where(before >= start[text], before, start[text] - 1)
        lo = np.maximum(before + 1, at - REACH)
        hi = np.minimum(at, end[text] - LENGTH)
        use = lo <= hi
        at, text, lo, hi = at[use], text[use], lo[use], hi[use]
        self.text, first = text, start[text]
        self.at, self.lo, self.hi = at - first, lo - first, hi - first
        self.block = mix(span_hash(s, at, at + DEPTH)).view(np.int64)
        self.context = mix(mix(span_hash(s, lo, hi + LENGTH))
                           ^ ((hi - lo) * 1024 + (at - lo)).astype(U)).view(np.int64)
        step = np.zeros(len(buf) + 1, dtype=np.int32)
        long_ = size >= LENGTH
        np.add.at(step, start[long_], 1)
        np.add.at(step, end[long_] - LENGTH + 1, -1)
        np.add.at(step, lo, -1)
        np.add.at(step, hi + 1, 1)
        bare = np.flatnonzero(np.cumsum(step[:-1]) > 0)
        self.bare_text = np.searchsorted(end, bare, side="right")
        self.bare = bare - start[self.bare_text]
        self.bare_label = mix(span_hash(s, bare, bare + LENGTH)).view(np.int64)


def _lists(values: np.ndarray, owner: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """Values grouped by owner (ascending) as a list array of n lists."""
    offsets = np.searchsorted(owner, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind,
                                                                            safe=False))


def scan(docs: DataFrame) -> DataFrame:
    """Per document (keys i, k): lists of its anchor rows and bare positions."""
    fields = ([("i", pa.int64()), ("k", pa.int64())] + [(c, pa.list_(t)) for c, t in SCAN]
              + [("bare", pa.list_(pa.int32())), ("label", pa.list_(pa.int64()))])

    def run(batches):
        np.seterr(over="ignore")
        for batch in batches:
            for first, texts in chunks((x.as_py() for x in batch.column("text")), RUN_BYTES):
                n, s = len(texts), Scan(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("i").slice(first, n), batch.column("k").slice(first, n)]
                    + [_lists(getattr(s, c), s.text, n, t) for c, t in SCAN]
                    + [_lists(s.bare, s.bare_text, n, pa.int32()),
                       _lists(s.bare_label, s.bare_text, n, pa.int64())],
                    schema=pa.schema(fields))

    return docs.select("i", "k", "text").mapInArrow(
        run, "i long, k long, lo array<int>, hi array<int>, at array<int>, block array<long>, "
             "context array<long>, bare array<int>, label array<long>")


def bit_filtered(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows whose ``column`` may be in ``wanted``: a bit filter of fixed size, before any shuffle."""
    bits = rows.sparkSession.sparkContext.broadcast(id_filter(wanted, column))
    bit = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)).alias("bit")

    def run(batches):
        for batch in batches:
            bit = batch.column("bit").to_numpy()
            keep = (bits.value[bit // 32] >> (bit % 32)) & 1
            yield batch.drop_columns(["bit"]).filter(pa.array(keep.astype(bool)))

    return rows.select("*", bit).mapInArrow(run, rows.schema)


def shared_anchors(scanned: DataFrame, repeated: DataFrame) -> DataFrame:
    """The anchor rows whose block has other members; the bit filter spares most of the others the
    shuffle, the join decides."""
    anchors = scanned.select("i", "k", F.inline(F.arrays_zip("lo", "hi", "at", "block", "context")))
    return bit_filtered(anchors, "block", repeated).join(repeated, "block")


def _packed(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(i, k, packed) of the documents that the bit filter of ``wanted`` (i, k) lets through."""
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(wanted, "k"))
    bit = F.pmod(F.xxhash64("k"), F.lit(FILTER_BITS)).alias("bit")

    def run(batches):
        for batch in batches:
            bit = batch.column("bit").to_numpy()
            keep = ((bits.value[bit // 32] >> (bit % 32)) & 1).astype(bool)
            some = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays(
                [some.column("i"), some.column("k"),
                 pa.array([zlib.compress(t.as_py().encode("utf-8", "surrogatepass"), 1)
                           for t in some.column("text")], pa.binary())],
                schema=pa.schema([("i", pa.int64()), ("k", pa.int64()), ("packed", pa.binary())]))

    return docs.select("i", "k", "text", bit).mapInArrow(run, "i long, k long, packed binary")


def _per_text(texts: DataFrame, rows: DataFrame, columns: list[str], label, out: str) -> DataFrame:
    """``label(prefix sums, {column: values})`` of the rows (i, k, columns) of each text."""
    per_doc = rows.groupBy("i", "k").agg(F.collect_list(F.struct(*columns)).alias("rows"))

    def run(batches):
        np.seterr(over="ignore")
        for batch in batches:
            for packed, rows in zip(batch.column("packed"), batch.column("rows")):
                s = prefix_sums(np.frombuffer(zlib.decompress(packed.as_buffer()), dtype=np.uint8))
                yield pa.RecordBatch.from_pydict(label(s, {
                    c: rows.values.field(j).to_numpy(zero_copy_only=False)
                    for j, c in enumerate(columns)}))

    return texts.join(per_doc, ["i", "k"]).mapInArrow(run, out)


def _step_labels(s: np.ndarray, x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Every STEP positions of a context, counted back from its anchor: ``core`` labels what all
    their strings have in common, ``union`` what they cover together."""
    at, lo, hi = (x[c].astype(np.int64) for c in ("at", "lo", "hi"))
    low, high = (at - hi) // STEP, (at - lo) // STEP
    n = high - low + 1
    row = np.repeat(np.arange(len(at)), n)
    m = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[row]
    a, b = np.maximum(lo[row], at[row] - m * STEP - STEP + 1), np.minimum(hi[row],
                                                                           at[row] - m * STEP)
    core = at[row] - m * STEP
    return {"core": (mix(span_hash(s, core, core + LENGTH - STEP + 1)) + m.astype(U)).view(np.int64),
            "union": mix(mix(span_hash(s, a, b + LENGTH))
                         ^ ((at[row] - a) * 1024 + (b - a)).astype(U)).view(np.int64),
            "a": a.astype(np.int32), "b": b.astype(np.int32),
            "once": x["once"].astype(bool)[row], "i": x["i"][row], "k": x["k"][row]}


def _position_labels(s: np.ndarray, x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    a, b = x["a"].astype(np.int64), x["b"].astype(np.int64)
    n = b - a + 1
    row = np.repeat(np.arange(len(a)), n)
    p = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + a[row]
    return {"label": mix(span_hash(s, p, p + LENGTH)).view(np.int64), "p": p.astype(np.int32),
            "open": x["open"].astype(bool)[row], "i": x["i"][row], "k": x["k"][row]}


def split_spans(docs: DataFrame, contexts: DataFrame) -> DataFrame:
    """(i, k, start, end): repeated strings inside contexts that stand only once, while their block
    has other contexts. ``contexts``: (i, k, lo, hi, at, once), one row per distinct context.

    Steps of a context go first: a step whose core stands once holds no repeat, one whose union
    stands again is all repeats. Only the steps in between, at the ends of repeated intervals, are
    looked at position by position."""
    texts = stored(_packed(docs, contexts.select("i", "k")).dropDuplicates(["i", "k"]),
                   "repeat-texts")
    steps = stored(_per_text(
        texts, contexts, ["lo", "hi", "at", "once", "i", "k"], _step_labels,
        "core long, union long, a int, b int, once boolean, i long, k long"), "repeat-steps")
    # Most steps lie outside repeats: their cores stand once, and they end here.
    cores = steps.groupBy("core").count().filter("count > 1").select("core")
    cores = stored(cores, "repeat-cores")
    all_steps, steps = steps, stored(bit_filtered(steps, "core", cores), "repeat-steps")
    drop_stored(all_steps, cores)
    again = steps.groupBy("core", "union").agg(
        F.count("*").alias("n"), F.bool_or("once").alias("once"),
        F.min(F.struct("i", "k", "a", "b")).alias("one"))
    again = stored(again, "repeat-unions")
    whole = stored(steps.filter("once").join(again.filter("n > 1").select("core", "union"),
                                             ["core", "union"]).select("i", "k", "a", "b"),
                   "repeat-whole")
    drop_stored(steps)
    mixed = again.groupBy("core").agg(F.count("*").alias("unions"), F.bool_or(
        F.col("once") & (F.col("n") == 1)).alias("open")).filter("unions > 1 AND open")
    part = stored(again.join(mixed.select("core"), "core").select(
        "one.*", (F.col("once") & (F.col("n") == 1)).alias("open")), "repeat-open")
    positions = stored(_per_text(texts, part, ["a", "b", "open", "i", "k"], _position_labels,
                                 "label long, p int, open boolean, i long, k long"),
                       "repeat-positions")
    drop_stored(texts, again, part)
    # Every union has one row here: a label on two rows stands in two different unions.
    twice = positions.groupBy("label").count().filter("count > 1").select("label")
    single = positions.filter("open").join(twice, "label").select("i", "k", F.col("p").alias("a"),
                                                                  F.col("p").alias("b"))
    return whole.union(single).select("i", "k", F.col("a").alias("start"),
                                      (F.col("b") + LENGTH).alias("end"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(i, k, spans): for each document with repeats, the distinct [start, end) byte spans of its
    repeated strings (they may overlap). ``docs``: (i, k, text)."""
    scanned = stored(scan(docs), "repeat-scan")
    blocks = scanned.select(F.explode("block").alias("block")).groupBy("block").count()
    repeated = stored(blocks.filter("count > 1").select("block"), "repeat-blocks")
    anchors = stored(shared_anchors(scanned, repeated), "repeat-anchors")
    bare = scanned.filter("size(bare) > 0").select("i", "k",
                                                   F.inline(F.arrays_zip("bare", "label")))
    bare_again = bare.groupBy("label").count().filter("count > 1").select("label")
    bare = stored(bare.join(bare_again, "label").select(
        "i", "k", F.col("bare").alias("start"), (F.col("bare") + LENGTH).alias("end")),
        "repeat-bare")
    drop_stored(scanned, repeated)
    contexts = stored(anchors.groupBy("block", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("i", "k", "lo", "hi", "at")).alias("one")),
        "repeat-contexts")
    whole = stored(anchors.join(contexts.filter("n > 1").select("block", "context"),
                                ["block", "context"]).select(
        "i", "k", F.col("lo").alias("start"), (F.col("hi") + LENGTH).alias("end")),
        "repeat-whole")
    drop_stored(anchors)
    split = (contexts.groupBy("block").agg(F.count("*").alias("c"), F.min("n").alias("least"))
             .filter("c > 1 AND least = 1").select("block"))
    part = stored(contexts.join(split, "block").select(
        "one.*", (F.col("n") == 1).alias("once")), "repeat-split")
    drop_stored(contexts)
    spans = whole.union(split_spans(docs, part)).union(bare)
    return spans.groupBy("i", "k").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def merge_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching spans."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], start[1:] > end[:-1]))
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def without_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked,
    kept (the remaining bytes).

    A null text is empty; texts under 400 bytes keep everything; repeated rows count as places of
    their own, so all of them lose what they share; a null doc_id stays null. Cuts may fall inside a
    UTF-8 character, as the strings are judged on bytes. Other columns are ignored; an empty table
    gives no rows.
    """
    docs = ids_and_text(docs).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("i"),
        F.xxhash64("doc_id", "text").alias("k"))
    spans = stored(repeated_spans(docs), "repeat-spans")
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(spans, "k"))
    bit = F.pmod(F.xxhash64("k"), F.lit(FILTER_BITS)).alias("bit")
    first = pa.schema([("doc_id", pa.int64()), ("i", pa.int64()), ("k", pa.int64()),
                       ("n_bytes", pa.int64()), ("sha", pa.string()), ("packed", pa.binary())])
    last = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
            ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    if with_text:
        last.append(("kept", pa.binary()))

    def split(batches):
        """Whole texts that no span can touch end here; only the others' text travels on."""
        for batch in batches:
            bit = batch.column("bit").to_numpy()
            hit = ((bits.value[bit // 32] >> (bit % 32)) & 1).astype(bool)
            raw = [t.as_py().encode("utf-8", "surrogatepass") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("i"), batch.column("k"),
                 pa.array(map(len, raw), pa.int64()),
                 pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
                 pa.array([zlib.compress(r, 1) if h or with_text else None
                           for r, h in zip(raw, hit)], pa.binary())], schema=first)

    def cut(batches):
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                removed = n_spans = 0
                kept = None
                if x["spans"] or with_text:
                    raw = np.frombuffer(zlib.decompress(x["packed"]), dtype=np.uint8)
                    keep = np.ones(len(raw), dtype=bool)
                    if x["spans"]:
                        a, b = merge_spans(np.array([s["start"] for s in x["spans"]]),
                                           np.array([s["end"] for s in x["spans"]]))
                        for s, e in zip(a, b):
                            keep[s:e] = False
                        removed, n_spans = int((b - a).sum()), len(a)
                    kept = raw[keep].tobytes()
                    x["sha"] = hashlib.sha256(kept).hexdigest()
                rows.append([x["doc_id"], x["n_bytes"], removed, n_spans, x["sha"], kept])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in rows], t) for j, (_, t) in enumerate(last)],
                schema=pa.schema(last))

    narrow = docs.select("doc_id", "i", "k", "text", bit).mapInArrow(
        split, "doc_id long, i long, k long, n_bytes long, sha string, packed binary")
    return narrow.join(spans, ["i", "k"], "left").select(
        "doc_id", "n_bytes", "sha", "packed", "spans").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
             + ", kept binary" * with_text)


#: The same rows by grouping every 400-byte string.
OP5_SQL = """
WITH raw AS (
  SELECT row_number() OVER () AS row, doc_id, h, copies FROM (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, count(*) AS copies FROM documents
    GROUP BY ALL)),
starts AS (
  SELECT row, unnest(range(0, len(h) // 2 - 399)) AS pos, h FROM raw),
keyed AS (SELECT row, pos, md5(substring(h, 2 * pos + 1, 800)) AS m FROM starts),
hits AS (
  SELECT row, pos FROM (SELECT row, pos, count(*) OVER (PARTITION BY m) AS c FROM keyed) WHERE c > 1),
cuts AS (
  SELECT row, pos, CASE WHEN pos <= lag(pos) OVER w + 400 THEN 0 ELSE 1 END AS new FROM hits
  WINDOW w AS (PARTITION BY row ORDER BY pos)),
spans AS (
  SELECT row, min(pos) AS s, max(pos) + 400 AS e FROM (
    SELECT row, pos, sum(new) OVER (PARTITION BY row ORDER BY pos) AS k FROM cuts) GROUP BY row, k),
gaps AS (
  SELECT row, s, e, lag(e, 1, 0) OVER (PARTITION BY row ORDER BY s) AS begin FROM spans),
cut AS (
  SELECT g.row, sum(e - s)::bigint AS removed, count(*) AS n,
         string_agg(h[2 * begin + 1:2 * s], '' ORDER BY s) AS head, max(e) AS last
  FROM gaps g JOIN raw USING (row) GROUP BY g.row)
SELECT doc_id, (len(h) // 2)::bigint AS n_bytes, coalesce(removed, 0)::bigint AS n_removed,
       coalesce(n, 0)::bigint AS n_spans,
       sha256(unhex(CASE WHEN n IS NULL THEN h ELSE head || h[2 * last + 1:] END)) AS kept_sha256
FROM (SELECT *, unnest(range(copies)) FROM raw) LEFT JOIN cut USING (row)
"""


def op5_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))
