"""N-gram Jaccard join: size-aware heavy-light set similarity join, exact at any size.

Documents are sets of word 3-gram hashes. Equal sets are one class (grouped by a 128-bit digest), so
copies are never expanded; what follows runs on class representatives.

* **Light sets** (size up to a boundary): two linked sets share a subset of a fixed size, so each set
  enumerates its subsets with as many elements left out as a link allows (``size // 10`` for Jaccard
  0.9; the hash of a subset is the sum of its elements' hashes) and equal subsets meet.
* **Heavy sets**: an inverted list per prefix element, rarest elements first. Two linked sets share
  an element of their prefixes. The order puts frequent shingles last; it is a table of bounded size,
  and any order gives the same links, so the bound costs time only.
* The **boundary** is the cheapest one by the posting counts that the size histogram implies.

Pairs of a list are never all emitted. Lists first link neighbours, in size order and then in other
orders, and verified links are joined to components after each round; in the end only pairs of one
list that lie in *different* components are compared. A pair in one component needs no comparison for the components' sake; every pair that can
merge two components is verified exactly, so no class boundary depends on the shortcut. Size, position
and parity-bitmap bounds discard pairs that cannot link; all three are upper bounds, never estimates.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchside.llm.common import components, drop_stored, ids_and_text, stored, table
from pitchside.llm.textnum import U, Words, chunks, distinct, mix, shingle_sets

#: Similarity of a link, as a fraction: 100 * intersection >= 90 * union.
NUM, DEN = 90, 100
#: The pipeline's stage: words of a shingle and similarity of a link.
STAGE = (5, 80, 100)
#: Most entries of the frequent-shingle table that orders prefixes (8 MB); affects cost alone.
ORDER_ENTRIES = 1 << 19
#: A shingle enters that table's count from a run of texts when it is in so many of them.
LOCAL_MIN = 4
#: Bits of the filter that picks documents to be hashed again (2 MB as bits, 4 MB as sent).
FILTER_BITS = 1 << 24
#: Bits of the bitmap that bounds how far two candidates differ before their texts are compared.
WIDE_BITS = 4096
#: 64-bit words of the parity bitmap that travels with list entries.
BIT_WORDS = 8
BITS = [f"b{j}" for j in range(BIT_WORDS)]
#: Rounds in which lists link neighbours before components are compared in full.
CHAIN_ROUNDS = 3
#: Light sets leave out up to so many elements: that bounds their subsets at any similarity.
MOST_LEFT_OUT = 2


def _sets(batches: Iterator[pa.RecordBatch], size: int):
    """(batch, index of the row, its shingle set) run by run."""
    np.seterr(over="ignore")
    for batch in batches:
        for first, run in chunks(x.as_py() for x in batch.column("text")):
            yield batch, first, list(shingle_sets(Words(run), size))


def frequent_shingles(docs: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of the most frequent shingles with their counts, shape (2, n <= ORDER_ENTRIES).
    Every document is counted; runs of texts report what they hold ``LOCAL_MIN`` times."""
    def local(batches):
        for _, _, sets in _sets(batches, size):
            h = np.sort(np.concatenate([*sets, np.empty(0, dtype=U)]))
            at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else []
            n = np.diff(np.append(at, len(h)))
            keep = n >= LOCAL_MIN
            yield pa.RecordBatch.from_pydict({"h": h[at][keep].view(np.int64) if len(h) else [],
                                              "n": n[keep].astype(np.int64)},
                                             schema=pa.schema([("h", pa.int64()),
                                                               ("n", pa.int64())]))

    top = (docs.select("text").mapInArrow(local, "h long, n long").groupBy("h")
           .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(ORDER_ENTRIES).toPandas())
    h = top["h"].to_numpy(dtype=np.int64).view(U)
    order = np.argsort(h)
    return np.stack([h[order], top["n"].to_numpy(dtype=np.int64)[order].view(U)])


def bitmap(s: np.ndarray, bits: int) -> np.ndarray:
    """Parity bits as 64-bit words: bit i is the parity of the elements that hash to i. The bits in
    which two bitmaps differ number at most the elements in which the sets differ."""
    odd = (np.bincount((s % U(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def boundaries(num: int = NUM, den: int = DEN) -> tuple[int, ...]:
    """Boundaries weighed for light sets: the largest sizes of which 0, 1, ... ``MOST_LEFT_OUT``
    elements can be missing in a linked set (9, 19, 29 for 0.9; 4, 9, 14 for 0.8)."""
    if num >= den:
        return (0,)
    return tuple(-(-(d + 1) * den // (den - num)) - 1 for d in range(MOST_LEFT_OUT + 1))


def choose_boundary(sizes: dict[int, int], num: int = NUM, den: int = DEN) -> int:
    """The boundary with the fewest postings: subsets of light sets plus prefix elements of the
    others (and of light sets near the boundary, which can link across it)."""
    def cost(x: int) -> int:
        light = sum(c * sum(comb(n, j) for j in range(n * (den - num) // den + 1))
                    for n, c in sizes.items() if n <= x)
        heavy = sum(c * (n * (den - num) // den + 1) for n, c in sizes.items()
                    if n * den >= (x + 1) * num)
        return light + heavy
    return min(boundaries(num, den), key=cost)


def _subsets(s: np.ndarray, drop: int) -> np.ndarray:
    """Summed hashes of the subsets of ``s`` with ``drop`` elements left out."""
    m = mix(s)
    total = m.sum(dtype=U)
    if drop == 0:
        return np.array([total], dtype=U)
    out = np.array(list(combinations(range(len(m)), drop)), dtype=np.int64).reshape(-1, drop)
    return total - m[out].sum(axis=1, dtype=U)


def signatures(docs: DataFrame, frequent: np.ndarray, boundary: int, size: int,
               num: int = NUM, den: int = DEN) -> DataFrame:
    """One row per document: doc_id, n_shingles, 128-bit digest (d1, d2) of its set, parity bitmap
    (``BITS``), and its list keys: ``heavy`` prefix elements in order and ``light`` subset hashes."""
    order = docs.sparkSession.sparkContext.broadcast(frequent)
    names = ["doc_id", "n_shingles", "d1", "d2", *BITS]
    schema = pa.schema([(c, pa.int64()) for c in names]
                       + [(c, pa.list_(pa.int64())) for c in ("heavy", "light")])

    def keys(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hot, count = order.value
        n, heavy, light = len(s), s[:0], s[:0]
        may_differ = n * (den - num) // den
        if 0 < n <= boundary:
            light = np.concatenate([distinct(mix(_subsets(s, j) ^ U(n - j)))
                                    for j in range(may_differ + 1)])
        if n * den >= (boundary + 1) * num:
            at = np.searchsorted(hot, s)
            at[at == len(hot)] = 0
            freq = np.where(hot[at] == s, count[at], 0) if len(hot) else np.zeros(n)
            heavy = s[np.argsort(freq, kind="stable")[:may_differ + 1]]
        return heavy.view(np.int64), light.view(np.int64)

    def run(batches):
        for batch, first, sets in _sets(batches, size):
            found = [keys(s) for s in sets]
            bits = np.array([bitmap(s, 64 * BIT_WORDS) for s in sets]).reshape(-1, BIT_WORDS)
            d1 = [int(mix(s).sum(dtype=U).view(np.int64)) for s in sets]
            d2 = [int(mix(s ^ U(0xD6E8FEB86659FD93)).sum(dtype=U).view(np.int64)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, len(sets)),
                 pa.array(map(len, sets), pa.int64()), pa.array(d1, pa.int64()),
                 pa.array(d2, pa.int64()), *(pa.array(np.ascontiguousarray(b)) for b in bits.T),
                 pa.array([f[0] for f in found], pa.list_(pa.int64())),
                 pa.array([f[1] for f in found], pa.list_(pa.int64()))], schema=schema)

    return docs.mapInArrow(run, ", ".join(f"{c} long" for c in names)
                           + ", heavy array<long>, light array<long>")


def _possible(num: int = NUM, den: int = DEN):
    """Whether two postings p, q of one list can belong to linked sets: bounds by size, by position
    and by parity bitmap. ``den * i >= num * (a + b - i)`` is ``i >= num * (a + b) / (num + den)``."""
    a, b = F.col("p.n"), F.col("q.n")
    need = (a + b) * F.lit(num)
    rest = F.least(a - F.col("p.pos"), b - F.col("q.pos"))
    differ = sum((F.bit_count(F.col(f"p.{b}").bitwiseXOR(F.col(f"q.{b}"))) for b in BITS), F.lit(0))
    return ((F.least(a, b) * den >= F.greatest(a, b) * num)
            & (rest * (num + den) >= need)
            & ((a + b - differ) * (num + den) >= need * 2))


def bounded(pairs: DataFrame, sketches: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """The pairs that can still link by wide parity bitmaps: the sets differ in at least as many
    elements as their bitmaps do in bits. ``sketches``: (rep, n, wide)."""
    both = (pairs.join(sketches.select(F.col("rep").alias("a"), F.col("n").alias("na"),
                                       F.col("wide").alias("x")), "a")
            .join(sketches.select(F.col("rep").alias("b"), F.col("n").alias("nb"),
                                  F.col("wide").alias("y")), "b"))

    def possible(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=U)
                    .reshape(len(batch), -1) for c in ("x", "y"))
            differ = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            keep = (total - differ) * (num + den) >= 2 * num * total
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.mapInArrow(possible, "a long, b long").distinct()


def verified(pairs: DataFrame, texts: DataFrame, size: int, num: int = NUM, den: int = DEN
             ) -> DataFrame:
    """The pairs (a, b) whose sets link, by exact intersection. ``texts``: (rep, packed text)."""
    left = pairs.join(texts.select(F.col("rep").alias("a"), F.col("packed").alias("x")), "a")
    both = left.join(texts.select(F.col("rep").alias("b"), F.col("packed").alias("y")), "b")

    def linked(batches):
        np.seterr(over="ignore")
        for batch in batches:
            sides = []
            for c in ("x", "y"):
                unpacked = (zlib.decompress(v.as_buffer()).decode("utf-8", "surrogatepass")
                            for v in batch.column(c))
                sides.append(s for _, run in chunks(unpacked) for s in shingle_sets(Words(run),
                                                                                   size))
            keep = []
            for s, t in zip(*sides):
                u = np.sort(np.concatenate((s, t)))
                common = int((u[1:] == u[:-1]).sum())
                keep.append(den * common >= num * (len(s) + len(t) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(linked, "a long, b long")


def id_filter(ids: DataFrame, column: str) -> np.ndarray:
    """A one-hash bit filter of FILTER_BITS bits over the ids: what it lets through may be wanted,
    the rest is not. Its size is fixed, so it can be sent to every task; when ids fill it up it
    only stops saving work."""
    bit = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    words = (ids.select(bit.alias("bit")).groupBy((F.col("bit") / 32).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit % 32 AS INT))")).alias("v")).toArrow())
    out = np.zeros(FILTER_BITS // 32, dtype=np.int64)
    out[words["w"].to_numpy()] = words["v"].to_numpy()
    return out


def picked(docs: DataFrame, wanted: DataFrame, make, schema: str, fields: pa.Schema) -> DataFrame:
    """``make(ids, texts)`` of the wanted documents. They are read where they lie: documents that
    the filter excludes are passed over, and no unwanted text moves. The filter may let others
    through; the joins that follow drop them."""
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(wanted, "rep"))
    h = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("bit")

    def run(batches):
        for batch in batches:
            bit = batch.column("bit").to_numpy()
            some = batch.take(pa.array(np.flatnonzero((bits.value[bit // 32] >> (bit % 32)) & 1)))
            for columns in make(some):
                yield pa.RecordBatch.from_arrays(columns, schema=fields)

    return (docs.filter("doc_id IS NOT NULL").select("doc_id", "text", h)
            .mapInArrow(run, schema))


def packed_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, packed): compressed whole texts, about a third of the bytes of their hashed sets."""
    def make(some):
        yield [some.column("doc_id"),
               pa.array([zlib.compress(t.as_py().encode("utf-8", "surrogatepass"), 1)
                         for t in some.column("text")], pa.binary())]

    return picked(docs, wanted, make, "rep long, packed binary",
                  pa.schema([("rep", pa.int64()), ("packed", pa.binary())]))


def wide_sketches(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(rep, n, wide): set size and parity bitmap of WIDE_BITS bits."""
    def make(some):
        for part, first, sets in _sets(iter([some]), size):
            wide = [bitmap(s, WIDE_BITS).tobytes() for s in sets]
            yield [part.column("doc_id").slice(first, len(sets)),
                   pa.array(map(len, sets), pa.int64()), pa.array(wide, pa.binary())]

    return picked(docs, wanted, make, "rep long, n long, wide binary",
                  pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("wide", pa.binary())]))


def confirm(docs: DataFrame, pairs: DataFrame, sketches: DataFrame, size: int, num: int,
            den: int) -> DataFrame:
    """Candidate pairs down to links: first by wide bitmaps, then by exact intersection."""
    near = stored(bounded(pairs, sketches, num, den), "jaccard-near")
    texts = stored(packed_texts(docs, _ends(near)), "jaccard-texts")
    links = stored(verified(near, texts, size, num, den), "jaccard-links")
    drop_stored(near, texts)
    return links


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(F.least("p.rep", "q.rep").alias("a"),
                     F.greatest("p.rep", "q.rep").alias("b")).distinct()


def link_classes(docs: DataFrame, size: int = 3, num: int = NUM, den: int = DEN
                 ) -> tuple[DataFrame, DataFrame]:
    """(members, classes): members (doc_id, n_shingles, rep) with one row per document row, and
    classes (node, component) of the representatives that link to another one.

    ``rep`` is the smallest doc_id with the same set, null for empty sets and null doc_ids (these
    link with nothing). A doc_id on several rows with different texts is one vertex.
    """
    docs = ids_and_text(docs)
    frequent = frequent_shingles(docs, size)
    boundary = choose_boundary(small_sizes(docs, size, num, den), num, den)
    every = stored(signatures(docs, frequent, boundary, size, num, den), "jaccard-signatures")
    same_set = ["n_shingles", "d1", "d2"]
    rep = (every.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*same_set)
           .agg(F.min("doc_id").alias("rep")))
    members = stored(every.select("doc_id", *same_set).join(rep, same_set, "left").select(
        "doc_id", "n_shingles",
        F.expr("CASE WHEN doc_id IS NOT NULL AND n_shingles > 0 THEN rep END").alias("rep")),
        "jaccard-members")
    # Only representatives post: the copies of a set, however many, stay one row.
    one = (every.join(rep.select("rep", *same_set), same_set)
           .filter("doc_id = rep").dropDuplicates(["rep", *same_set])
           .select("rep", F.col("n_shingles").cast("int").alias("n"), *BITS, "heavy", "light"))
    one = stored(one, "jaccard-reps")
    drop_stored(every)
    posts = (one.select("rep", "n", F.posexplode("heavy").alias("pos", "key"))
             .union(one.select("rep", "n", F.lit(0).alias("pos"), F.explode("light").alias("key"))))
    in_list = Window.partitionBy("key").orderBy("n", "rep")
    shared = (posts.withColumn("next", F.lead("rep").over(in_list))
              .withColumn("before", F.lag("rep").over(in_list))
              .filter("next IS NOT NULL OR before IS NOT NULL").drop("next", "before"))
    # Bitmaps join once the keys of a single set are gone.
    lists = stored(shared.join(one.select("rep", "n", *BITS), ["rep", "n"]), "jaccard-lists")
    drop_stored(one)
    sketches = stored(wide_sketches(docs, lists.select("rep").distinct(), size),
                      "jaccard-sketches")
    tried = links = label = None
    for r in range(CHAIN_ROUNDS):
        opened = lists if r == 0 else _open(lists, label)
        pairs = _pairs(_chained(opened, r).filter(_possible(num, den)))
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "jaccard-pairs")
        found = confirm(docs, pairs, sketches, size, num, den)
        tried = pairs if tried is None else tried.union(pairs)
        links = found if links is None else links.union(found)
        label = components(links)
    # What lists still hold of several components is compared across them in full.
    opened = stored(_open(lists, label), "jaccard-open")
    across = opened.alias("p").join(
        opened.alias("q"), (F.col("p.key") == F.col("q.key"))
        & (F.col("p.label") < F.col("q.label")) & _possible(num, den))
    pairs = stored(_pairs(across).join(tried, ["a", "b"], "left_anti"), "jaccard-pairs")
    return members, components(links.union(confirm(docs, pairs, sketches, size, num, den)))


def _open(lists: DataFrame, label: DataFrame) -> DataFrame:
    """The lists that hold several components, with each entry's component as ``label``."""
    named = (lists.join(label, lists["rep"] == label["node"], "left").drop("node")
             .withColumn("label", F.coalesce("component", "rep")).drop("component"))
    mixed = (named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
             .filter("lo < hi").select("key"))
    return named.join(mixed, "key")


def _chained(lists: DataFrame, r: int) -> DataFrame:
    """Neighbours (p, q) of each list: in size order first, then in other orders, and then only
    neighbours of different components."""
    order = ["n", "rep"] if r == 0 else [F.xxhash64(F.lit(r), "rep")]
    me = F.struct(*[c for c in ("rep", "n", "pos", "label", *BITS) if c in lists.columns])
    both = lists.select(me.alias("p"), F.lead(me).over(
        Window.partitionBy("key").orderBy(*order)).alias("q")).filter("q IS NOT NULL")
    return both if r == 0 else both.filter("p.label <> q.label")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()


def small_sizes(docs: DataFrame, size: int, num: int = NUM, den: int = DEN) -> dict[int, int]:
    """How many documents have so many words, for the few sizes that the boundary depends on."""
    words = F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    n = F.when(words > 0, F.greatest(words - (size - 1), F.lit(1))).otherwise(0).alias("n")
    top = max(boundaries(num, den)) * den // num + 1
    near = docs.select(n).filter(F.col("n") <= top)
    return {r[0]: r[1] for r in near.groupBy("n").count().collect()}


def jaccard_classes(docs: DataFrame, size: int = 3, num: int = NUM, den: int = DEN) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Empty, null and word-less texts have an empty set and are a component of their own; a null
    doc_id stays null and links with nothing; repeated rows give repeated result rows; other columns
    of ``docs`` are ignored; an empty table gives no rows.
    """
    members, classes = link_classes(docs, size, num, den)
    return members.join(classes, members["rep"] == classes["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))


def keep_one_per_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each class of documents that five-word shingles link at Jaccard
    0.8 stays (``STAGE``; op10's contract of three words and 0.9 binds op10 alone).

    Rows that repeat doc_id and text are one document; different texts of one doc_id, and texts of
    null ids, are documents of their own. The smallest doc_id of a class stays, a null one only if
    the class has no other. Texts without words link with nothing but their own copies.
    """
    # The key lives in a struct beside the row, so that no column of the documents can clash.
    keyed = docs.select(F.struct("*").alias("row"), F.xxhash64(
        "doc_id", F.coalesce("text", F.lit(""))).alias("key"))
    ids = keyed.select("key", F.col("row.doc_id").cast("long").alias("id"))
    texts = keyed.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text"))
    classes = jaccard_classes(texts, *STAGE).select(F.col("doc_id").alias("key"),
                                                    F.col("component_id").alias("class"))
    one = stored(classes.join(ids.distinct(), "key").groupBy("class", "key")
                 .agg(F.count("*").alias("rows"),
                      F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("at")),
                 "jaccard-stage")
    first = one.groupBy("class").agg(F.min("at").alias("first"))
    gone = one.join(first, "class").filter("at <> first").select("key")
    left = keyed.join(gone, "key", "left_anti")
    # Only repeated rows are shuffled with their texts.
    again = one.filter("rows > 1").select("key")
    single = left.join(again, "key", "left_semi").dropDuplicates(["key"])
    return left.join(again, "key", "left_anti").unionByName(single).select("row.*")


#: The same rows by exact comparison of all pairs that share a shingle.
OP10_SQL = """
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT row, doc_id, CASE WHEN len(w) = 0 THEN []
         WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1),
              lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM split),
members AS (
  SELECT DISTINCT doc_id, len(s) AS n, unnest(s) AS g FROM sets WHERE doc_id IS NOT NULL),
links AS (
  SELECT p.doc_id AS a, q.doc_id AS b FROM members p JOIN members q USING (g)
  WHERE p.doc_id <> q.doc_id GROUP BY p.doc_id, q.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))),
reach AS (
  SELECT a AS node, b AS seen FROM links
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a),
low AS (SELECT node, min(seen) AS m FROM reach GROUP BY node)
SELECT doc_id, len(s)::bigint AS n_shingles, coalesce(least(m, doc_id), doc_id) AS component_id
FROM sets LEFT JOIN low ON doc_id = node
"""


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))
