"""Embedding near-duplicates: int8 tile products with rigorous error bounds, exact recomputation.

Every vector is scaled to unit length and coded as ``scale * int8``; the length of what the code
misses is kept per vector. For two unit vectors u, v with codes u', v' and misses e, f:
``|u.v - u'.v'| <= e + (1 + e) * f``. A tile multiplies two blocks of codes (exact small integers in
a float matrix product) and recomputes in double precision only the pairs whose upper bound reaches
the threshold, so no pair at or above it is lost and none below it is kept.

Equal vectors are one class before the tiles. Of its links a tile returns, per vector, the number of
linked rows and one edge to its component inside the tile: output is linear in the tile's rows
however dense a group of near copies is. The comparison itself is all pairs of distinct vectors in
blocks of bounded size, as an exact search without assumptions on the data must be.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm.common import components, stored, table

THRESHOLD = 0.95
#: Rows of a block (about 5 MB at 64 dimensions) and of the square sub-tiles of one product.
BLOCK_ROWS = 8192
SUB_ROWS = 2048
#: Covers the rounding of scales and products in single precision.
ROUNDING = 2e-6

BLOCK = ("dim int, block int, ids binary, copies binary, vectors binary, codes binary, "
         "scales binary, misses binary")


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes int8, scale, miss) of unit rows: ``|row - scale * codes| <= miss``."""
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None])
    miss = np.linalg.norm(x - codes * scale[:, None], axis=1) * (1 + 1e-9) + 1e-12
    return codes.astype(np.int8), scale, miss


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at unit length; dividing by the largest component first avoids overflow."""
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def merge_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Union-find step: ``label`` after joining the ends of each pair (smallest index wins)."""
    while len(i):
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            break
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


class _Block:
    def __init__(self, row):
        self.ids = np.frombuffer(row.ids, dtype=np.int64)
        self.copies = np.frombuffer(row.copies, dtype=np.int64)
        self.x = np.frombuffer(row.vectors, dtype=np.float64).reshape(len(self.ids), -1)
        codes = np.frombuffer(row.codes, dtype=np.int8).reshape(self.x.shape)
        # Sums of dim * 127**2 stay exact integers below 2**24 in single precision.
        self.codes = codes.astype(np.float32 if self.x.shape[1] <= 1040 else np.float64)
        self.scales = np.frombuffer(row.scales, dtype=np.float64)
        self.misses = np.frombuffer(row.misses, dtype=np.float64)


def tile_links(a: _Block, b: _Block, same: bool, threshold: float):
    """Yield (rows of a, rows of b) of the linked pairs, sub-tile by sub-tile."""
    for s in range(0, len(a.ids), SUB_ROWS):
        for t in range(s if same else 0, len(b.ids), SUB_ROWS):
            p, q = slice(s, s + SUB_ROWS), slice(t, t + SUB_ROWS)
            product = a.codes[p] @ b.codes[q].T
            sa, sb, ea, eb = a.scales[p], b.scales[q], a.misses[p], b.misses[q]
            slack = ROUNDING + ea.max() + (1 + ea.max()) * eb.max()
            least = (threshold - slack) / (sa.max() * sb.max())
            # Products are whole numbers: one below the least lets rounding of the limit not matter.
            i, j = np.nonzero(product >= least - 1) if least > 1 else np.indices(
                product.shape).reshape(2, -1)
            bound = product[i, j] * sa[i] * sb[j] + ea[i] + (1 + ea[i]) * eb[j] + ROUNDING
            near = bound >= threshold
            i, j = i[near] + s, j[near] + t
            if same:
                upper = i < j
                i, j = i[upper], j[upper]
            for k in range(0, len(i), 1 << 16):
                u, v = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
                cosine = np.einsum("ij,ij->i", a.x[u], b.x[v])
                hit = cosine >= threshold
                yield u[hit], v[hit]


def _pack(threshold: float):
    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        x = unit(np.stack(pdf["embedding"].to_numpy()).astype(np.float64))
        codes, scale, miss = quantise(x)
        return pd.DataFrame([{
            "dim": key[0], "block": key[1], "ids": pdf["rep"].to_numpy(np.int64).tobytes(),
            "copies": pdf["copies"].to_numpy(np.int64).tobytes(), "vectors": x.tobytes(),
            "codes": codes.tobytes(), "scales": scale.tobytes(), "misses": miss.tobytes()}])

    def tile(key, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = list(pdf.sort_values("block").itertuples())
        a = _Block(rows[0])
        same = key[1] == key[2]
        b = a if same else _Block(rows[1])
        shift = 0 if same else len(a.ids)
        ids = a.ids if same else np.concatenate((a.ids, b.ids))
        degree = np.zeros(len(ids), dtype=np.int64)
        label = np.arange(len(ids))
        for u, v in tile_links(a, b, same, threshold):
            np.add.at(degree, u, b.copies[v])
            np.add.at(degree, v + shift, a.copies[u])
            label = merge_labels(label, u, v + shift)
        hit = np.flatnonzero(degree)
        return pd.DataFrame({"node": ids[hit], "links": degree[hit], "root": ids[label[hit]]})

    return pack, tile


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Null or empty vectors, vectors with a null or non-finite component and zero vectors link with
    nothing; so do vectors of different lengths with each other and rows whose vec_id is null (their
    component_id and kept are null). Repeated rows count as vectors of their own. Other columns are
    ignored; an empty table gives no rows.
    """
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v)
                      & (F.abs(v) < F.lit(float("inf"))))
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("embedding").cast("array<double>").alias("embedding"))
    usable = F.coalesce(F.col("vec_id").isNotNull() & finite
                        & F.exists("embedding", lambda x: x != 0), F.lit(False))
    v = v.select("vec_id", F.when(usable, F.col("embedding")).alias("embedding"))
    v = v.withColumn("d1", F.xxhash64("embedding")).withColumn("d2", F.xxhash64(F.lit(7),
                                                                                 "embedding"))
    reps = stored(v.filter("embedding IS NOT NULL").groupBy("d1", "d2", "embedding")
                  .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vector-reps")
    n_blocks = max(1, -(-reps.count() // block_rows))
    pack, tile = _pack(threshold)
    blocks = stored(reps.select("rep", "copies", "embedding", F.size("embedding").alias("dim"),
                                F.pmod(F.xxhash64("d1", "d2"), F.lit(n_blocks)).cast("int")
                                .alias("block"))
                    .groupBy("dim", "block").applyInPandas(pack, BLOCK), "vector-blocks")
    row = F.sequence(F.lit(0), F.lit(n_blocks - 1))
    tiles = blocks.withColumn("other", F.explode(row)).select(
        "*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    found = stored(tiles.groupBy("dim", "i", "j")
                   .applyInPandas(_lone_tiles(tile), "node long, links long, root long"),
                   "vector-links")
    degree = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found, "node", "root")
    member = reps.select("d1", "d2", "rep", "copies")
    per_rep = (member.join(degree, member["rep"] == degree["node"], "left").drop("node")
               .join(classes, member["rep"] == classes["node"], "left")
               .select("d1", "d2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
                       .alias("n"), F.coalesce("component", "rep").alias("c")))
    keyed = v.select("vec_id", F.col("embedding").isNull().alias("alone"), "d1", "d2")
    return keyed.join(per_rep, ["d1", "d2"], "left").select(
        "vec_id", F.when(F.col("alone") | F.col("n").isNull(), F.lit(0)).otherwise(F.col("n"))
        .cast("long").alias("n_links"),
        F.when(F.col("alone") | F.col("c").isNull(), F.col("vec_id")).otherwise(F.col("c"))
        .alias("component_id")).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _lone_tiles(tile):
    """A tile off the diagonal of which one block has no vectors of that length has no pairs."""
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        if key[1] != key[2] and len(pdf) < 2:
            return pd.DataFrame({"node": [], "links": [], "root": []}).astype("int64")
        return tile(key, pdf)
    return run


#: The same rows by comparing all pairs in double precision.
OP6_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::double[] AS e FROM embeddings),
whole AS (
  SELECT vec_id, e, list_max(list_transform(e, lambda x: abs(x))) AS top FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(e, lambda x: x <> 0)) > 0),
scaled AS (SELECT vec_id, list_transform(e, lambda x: x / top) AS e FROM whole),
usable AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM scaled),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM usable p JOIN usable q
  ON p.vec_id <> q.vec_id AND len(p.e) = len(q.e)
  WHERE list_dot_product(p.e, q.e) >= 0.95 * (p.norm * q.norm)),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a),
reach AS (
  SELECT a AS node, b AS seen FROM links
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a),
low AS (SELECT node, min(seen) AS m FROM reach GROUP BY node),
named AS (
  SELECT vec_id, coalesce(n, 0)::bigint AS n_links, coalesce(least(m, vec_id), vec_id) AS component_id
  FROM v LEFT JOIN degree ON vec_id = a LEFT JOIN low ON vec_id = node)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM named
"""


def op6_embedding_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
