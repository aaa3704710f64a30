"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A token is a run of letters, digits and non-ASCII bytes after lower-casing A-Z. Its vector is the sum
of three rows of one hashed embedding table: the whole word, its first four and its first five bytes.
Filters of widths 1, 2 and 3 slide over the token vectors of the *whole* text, the maximum of each
filter over all positions is kept (max pooling, then ReLU) and a logistic unit reads the maxima.
Thresholds are calibrated by language, which is judged from the text's own function words; the
threshold is folded into the score, so 0.5 is the decision limit in every language.

The classifier is fitted on every labelled document that may teach. Their tokens are dealt by id to
parts of about ``PART_BYTES`` of text; in each epoch a task trains on its part from the weights of the
epoch before, and Spark averages each row of weights over the parts that changed it. What reaches the
driver is the weights alone, whose size does not follow the table. The thresholds come from all of these
documents too: each is judged by a model of the other half (``FOLDS``). Scoring is one pass over the
documents, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchside.llm.common import drop_stored, small_batches, stored, table
from pitchside.llm.textnum import U, Words, chunks, mix, span_hash

#: Text of the labelled documents that one task trains on.
PART_BYTES = 16 << 20
#: Labelled ids that are broadcast to the texts; more are joined by shuffle, which moves every text once.
BROADCAST_IDS = 2_000_000
#: Model k < FOLDS learns from the other folds and judges fold k; model FOLDS learns from all.
FOLDS = 2
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 18, 8, 8, (1, 2, 3)
PAD = max(WIDTHS) - 1
EPOCHS, BATCH, RATE = 8, 64, 0.1
#: Logits to a bin of the threshold search (bounds what one window reads, not its exactness).
BINS = 64
#: Fewer calibration rows of a class than this in a language: the overall threshold holds.
MIN_CALIBRATION = 15

# Frequent function words by language, to judge the language of a text.
FUNCTION_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "was", "be"],
    "de": ["der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "des", "im", "auf"],
    "fr": ["le", "la", "les", "des", "et", "est", "dans", "pour", "une", "par", "sur", "pas"],
    "es": ["el", "los", "las", "que", "y", "en", "un", "por", "con", "una", "del", "su"],
}
LANGUAGES = [*FUNCTION_WORDS, ""]

_GAPS = np.ones(256, dtype=bool)
_GAPS[48:58] = _GAPS[65:91] = _GAPS[97:123] = _GAPS[128:] = False


def _word_hash(words: list[str]) -> np.ndarray:
    w = Words([x.encode() for x in words], _GAPS)
    return mix(w.hash)


class Tokens:
    """Token buckets of a run of texts, ``PAD`` zero rows after each text (bucket 0 is the zero
    vector): ``ids`` (rows, 3), ``start`` of each text, ``lang`` index of each text."""

    def __init__(self, texts: list[bytes]):
        w = Words(texts, _GAPS)
        n = len(texts)
        whole = mix(w.hash)
        parts = [whole]
        for size in (4, 5):
            parts.append(mix(span_hash(w.sums, w.start, np.minimum(w.end, w.start + size))
                             + U(size)))
        text_of = np.repeat(np.arange(n), np.diff(w.bounds))
        self.start = w.bounds[:-1] + PAD * np.arange(n)
        self.ids = np.zeros((len(whole) + PAD * n, 3), dtype=np.int32)
        row = np.arange(len(whole)) + PAD * text_of
        for k, h in enumerate(parts):
            self.ids[row, k] = (h % U(BUCKETS - 1)).astype(np.int32) + 1
        names = [np.sort(_word_hash(v)) for v in FUNCTION_WORDS.values()]
        hits = np.stack([np.bincount(text_of[np.isin(whole, v)], minlength=n) for v in names]
                        + [np.zeros(n, dtype=np.int64)], axis=1)
        hits[:, -1] = hits.max(axis=1) == 0
        self.lang = hits.argmax(axis=1)


@dataclass
class Model:
    embed: np.ndarray
    conv: np.ndarray            # (DIM, sum(WIDTHS) * FILTERS): one block per width and offset
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))

    def activations(self, x: np.ndarray, end: np.ndarray) -> np.ndarray:
        """(rows, filters): each filter at each position of texts that end before the rows ``end``.
        Windows from the zero rows after a text see zeros alone, never the text that follows."""
        z = x @ self.conv
        a = np.empty((len(x), len(WIDTHS) * FILTERS), dtype=np.float32)
        at = 0
        for k, width in enumerate(WIDTHS):
            f = slice(k * FILTERS, (k + 1) * FILTERS)
            a[:, f] = z[:, at:at + FILTERS]
            for j in range(1, width):
                at += FILTERS
                a[:-j, f] += z[j:, at:at + FILTERS]
            at += FILTERS
        for j in range(1, PAD + 1):
            a[end - j] = 0
        return a

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        return self.embed[ids[:, 0]] + self.embed[ids[:, 1]] + self.embed[ids[:, 2]]

    def logits(self, t: Tokens) -> np.ndarray:
        end = np.append(t.start[1:], len(t.ids))
        pooled = np.maximum.reduceat(self.activations(self.vectors(t.ids), end), t.start, axis=0)
        return np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias

    def scores(self, t: Tokens) -> np.ndarray:
        z = np.clip(self.logits(t).astype(np.float64) - self.threshold[t.lang], -40, 40)
        return 1 / (1 + np.exp(-z))


def _log_odds(with_bucket: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Smoothed log odds per bucket of standing in a toxic rather than a clean document, from the
    numbers of documents (of label 0 and 1) that hold a bucket and in all."""
    n = (with_bucket + 1) / (documents[:, None] + 2)
    odds = np.log(n[1] / n[0])
    odds -= np.log((documents[0] + 2) / (documents[1] + 2))
    odds[0] = 0
    return np.clip(odds, -4, 4)


def start(with_bucket: np.ndarray, documents: np.ndarray, seed: int = 7) -> Model:
    """Weights before the first epoch: the first embedding dimension starts at the buckets' log odds,
    the rest at random. Without documents of both classes the model is a constant and stays so."""
    rng = np.random.default_rng(seed)
    m = Model(rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32),
              rng.normal(0, 0.2, (DIM, sum(WIDTHS) * FILTERS)).astype(np.float32),
              np.zeros(len(WIDTHS) * FILTERS, dtype=np.float32),
              rng.normal(0, 0.2, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)
    if not documents.all():
        m.out[:] = 0
        m.out_bias = 4.0 if documents[1] else -4.0
        return m
    m.embed[:, 0] += _log_odds(with_bucket, documents).astype(np.float32)
    m.conv[0, :FILTERS] += 0.5
    m.out[:FILTERS] += 0.3
    m.embed[0] = 0
    return m


def start_squares(m: Model) -> dict[str, np.ndarray]:
    """Adagrad's sums of squares before the first epoch."""
    return {k: np.full_like(getattr(m, k), 1e-2) for k in ("embed", "conv", "bias", "out")}


def train(m: Model, acc: dict[str, np.ndarray], docs: list[np.ndarray], y: np.ndarray,
          documents: np.ndarray, rng: np.random.Generator, epochs: int) -> None:
    """Epochs of Adagrad on the token buckets of whole documents, in place. Classes weigh alike by
    ``documents``, the numbers of all clean and toxic documents, these and those of other parts."""
    weight = documents.sum() * 0.5 / documents[y]
    cols = [(k, j, slice(f * FILTERS, (f + 1) * FILTERS)) for f, (k, j) in enumerate(
        (k, j) for k, width in enumerate(WIDTHS) for j in range(width))]
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(docs)), -(-len(docs) // BATCH)):
            ids = np.concatenate([docs[i] for i in batch])
            end = np.cumsum([len(docs[i]) for i in batch])
            start = np.concatenate(([0], end[:-1]))
            x = m.vectors(ids)
            a = m.activations(x, end)
            at = np.stack([a[s:e].argmax(axis=0) + s for s, e in zip(start, end)])
            pooled = np.maximum(np.take_along_axis(a, at, axis=0) + m.bias, 0)
            p = 1 / (1 + np.exp(-np.clip(pooled @ m.out + m.out_bias, -30, 30)))
            d = ((p - y[batch]) * weight[batch] / len(batch)).astype(np.float32)
            grad = {"out": pooled.T @ d, "conv": np.zeros_like(m.conv)}
            dp = d[:, None] * m.out * (pooled > 0)
            grad["bias"] = dp.sum(axis=0)
            rows, values = [], []
            for k, j, c in cols:
                pos = np.minimum(at[:, k * FILTERS:(k + 1) * FILTERS] + j, end[:, None] - 1)
                g = dp[:, k * FILTERS:(k + 1) * FILTERS]
                grad["conv"][:, c] = np.einsum("bf,bfd->df", g, x[pos])
                rows.append(ids[pos.ravel()])
                values.append((g[:, :, None] * m.conv[:, c].T[None]).reshape(-1, DIM))
            row = np.concatenate(rows)
            value = np.concatenate(values)
            live = np.abs(value).max(axis=1) > 0
            row, value = row[live].ravel(), np.repeat(value[live], 3, axis=0)
            used, back = np.unique(row, return_inverse=True)
            ge = np.zeros((len(used), DIM), dtype=np.float32)
            np.add.at(ge, back, value)
            acc["embed"][used] += ge * ge
            m.embed[used] -= RATE * ge / np.sqrt(acc["embed"][used])
            m.embed[0] = 0
            for k, g in grad.items():
                acc[k] += g * g
                getattr(m, k)[...] -= RATE * g / np.sqrt(acc[k])
            m.out_bias -= RATE * float(d.sum())


#: Rows of weights beyond the embedding: the small weights one after the other, ``DIM`` to a row.
_SMALL = -(-(DIM * sum(WIDTHS) * FILTERS + 2 * len(WIDTHS) * FILTERS + 1) // DIM)


def _rows(embed: np.ndarray, conv: np.ndarray, bias: np.ndarray, out: np.ndarray,
          out_bias: float) -> np.ndarray:
    """Weights as rows of ``DIM`` numbers."""
    small = np.zeros(_SMALL * DIM, dtype=np.float32)
    flat = np.concatenate([conv.ravel(), bias, out, [out_bias]])
    small[:len(flat)] = flat
    return np.concatenate([embed, small.reshape(_SMALL, DIM)])


def _state(m: Model, acc: dict[str, np.ndarray]) -> np.ndarray:
    """(rows, 2 * DIM): the weights beside their sums of squares."""
    return np.hstack([_rows(m.embed, m.conv, m.bias, m.out, m.out_bias),
                      _rows(acc["embed"], acc["conv"], acc["bias"], acc["out"], 0.0)])


def _from_rows(used: np.ndarray, state: np.ndarray) -> tuple[Model, dict[str, np.ndarray]]:
    """The model and its sums of squares from the rows ``used`` of a state, in ascending order and with
    all small weights; other rows of the embedding, which no document looks up, are zeros."""
    n = len(used) - _SMALL

    def split(of):
        embed = np.zeros((BUCKETS, DIM), dtype=np.float32)
        embed[used[:n]] = state[:n, of]
        flat, conv = state[n:, of].ravel(), DIM * sum(WIDTHS) * FILTERS
        f = len(WIDTHS) * FILTERS
        return (embed, flat[:conv].reshape(DIM, -1).copy(), flat[conv:conv + f].copy(),
                flat[conv + f:conv + 2 * f].copy(), float(flat[conv + 2 * f]))
    squares = split(slice(DIM, None))
    return Model(*split(slice(DIM))), dict(zip(("embed", "conv", "bias", "out"), squares))


#: Rows of weights compared at a time.
_RUN = 1 << 14


def _changes(m: Model, acc: dict[str, np.ndarray], used: np.ndarray, state: np.ndarray):
    """(rows, changes) of the rows ``used`` that differ from ``state``, in runs: a task never holds a
    second copy of all weights."""
    n = len(used) - _SMALL
    none = np.empty((0, DIM), dtype=np.float32)
    small = np.hstack([_rows(none, m.conv, m.bias, m.out, m.out_bias),
                       _rows(none, acc["conv"], acc["bias"], acc["out"], 0.0)])
    for s in range(0, n + 1, _RUN):
        row = used[s:min(s + _RUN, n)]
        now = np.hstack([m.embed[row], acc["embed"][row]])
        if s + _RUN > n:
            row, now = used[s:], np.concatenate([now, small])
        change = now - state[s:s + len(row)]
        live = np.flatnonzero(change.any(axis=1))
        yield row[live], change[live]


def best_thresholds(scored: DataFrame) -> dict[int, float]:
    """By ``lang``, and for all under -1, the limit with the highest F1 among all rows (lang, z, toxic),
    in the middle of the gap it falls into; of equals the highest. Languages with fewer than
    ``MIN_CALIBRATION`` rows of a class have none.

    Counts run down the sorted logits in two steps, over bins and inside each bin, so no task sorts a
    whole language."""
    points = (scored.select(F.explode(F.array(F.lit(-1), "lang")).alias("lang"), "z", "toxic")
              .groupBy("lang", "z").agg(F.sum("toxic").alias("pos"), F.count("*").alias("n"))
              .withColumn("bin", F.floor(F.greatest(F.lit(-40.0), F.least(F.lit(40.0), "z"))
                                         * BINS)))
    down = Window.partitionBy("lang").orderBy(F.desc("bin"))   # at most 80 * BINS + 1 rows
    own = Window.partitionBy("lang")
    bins = (points.groupBy("lang", "bin").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"),
                                              F.max("z").alias("top"))
            .select("lang", "bin", (F.sum("pos").over(down) - F.col("pos")).alias("pos_above"),
                    (F.sum("n").over(down) - F.col("n")).alias("n_above"),
                    F.lead("top").over(down).alias("next_top"),
                    F.sum("pos").over(own).alias("all_pos"), F.sum("n").over(own).alias("all_n")))
    inside = Window.partitionBy("lang", "bin").orderBy(F.desc("z"))
    hit = F.col("pos_above") + F.sum("pos").over(inside)
    taken = F.col("n_above") + F.sum("n").over(inside)
    below = F.coalesce(F.lead("z").over(inside), "next_top")
    best = (points.join(F.broadcast(bins), ["lang", "bin"])
            .select("lang", "z", "all_pos", "all_n", (2 * hit / (taken + F.col("all_pos"))).alias("f1"),
                    F.coalesce((F.col("z") + below) / 2, F.col("z") - 1).alias("limit"))
            .groupBy("lang").agg(F.max_by("limit", F.struct("f1", "z")).alias("limit"),
                                 F.first("all_pos").alias("pos"), F.first("all_n").alias("n")))
    return {r["lang"]: r["limit"] for r in best.collect()
            if min(r["pos"], r["n"] - r["pos"]) >= (MIN_CALIBRATION if r["lang"] >= 0 else 1)}


def _teaching_tokens(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """Every document that may teach as (part, id, toxic, lang, fold, ids), a part in one file in order
    of id, and the number of parts. Labels other than 0 and 1 and null ids teach nothing; of
    contradicting labels 1 wins."""
    teach = (labels.select(F.col("doc_id").cast("long").alias("id"),
                           F.col("toxic").cast("int").alias("toxic"))
             .filter("id IS NOT NULL AND toxic IN (0, 1) AND crc32(CAST(id AS STRING)) % 5 <> 0")
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    if teach.count() <= BROADCAST_IDS:
        teach = F.broadcast(teach)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string")
                        .alias("text"))
    size = (texts.select("id", F.octet_length("text").alias("size")).join(teach, "id")
            .agg(F.sum("size")).first()[0] or 0)
    texts = texts.join(teach, "id").select("id", "toxic", "text")
    parts = max(1, -(-size // PART_BYTES))
    schema = pa.schema([("part", pa.int32()), ("id", pa.int64()), ("toxic", pa.int32()),
                        ("lang", pa.int32()), ("fold", pa.int32()), ("ids", pa.binary())])

    def tokens(batches):
        np.seterr(over="ignore")
        for batch in batches:
            for first, run in chunks(x.as_py() for x in batch.column("text")):
                t = Tokens(run)
                end = np.append(t.start[1:], len(t.ids))
                cut = {c: batch.column(c).slice(first, len(run)) for c in schema.names
                       if c not in ("lang", "ids")}
                cut["lang"] = pa.array(t.lang, pa.int32())
                cut["ids"] = pa.array([t.ids[s:e].tobytes() for s, e in zip(t.start, end)])
                yield pa.RecordBatch.from_arrays([cut[c] for c in schema.names], schema=schema)

    hashed = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    dealt = (texts.withColumn("part", hashed(1, parts)).withColumn("fold", hashed(2, FOLDS))
             .repartition(parts, "part").sortWithinPartitions("part", "id", "text"))
    return stored(dealt.mapInArrow(tokens, "part int, id long, toxic int, lang int, fold int, ids binary"),
                  "toxicity-tokens"), parts


def _buckets(column: pa.Array) -> list[np.ndarray]:
    """Token buckets of each document, read where Arrow holds them."""
    _, offsets, data = column.buffers()
    if data is None:
        return [np.empty((0, 3), dtype=np.int32)] * len(column)
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(offsets, dtype=wide)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8)
    return [data[s:e].view(np.int32).reshape(-1, 3) for s, e in zip(ends, ends[1:])]


def _document_counts(taught: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(fold, toxic, bucket): documents that hold the bucket, and (fold, toxic): documents. At most
    2 * FOLDS * (BUCKETS + 1) numbers reach the driver."""
    schema = pa.schema([("key", pa.int32()), ("n", pa.int64())])

    def count(batches):
        for batch in batches:
            group = (batch["fold"].to_numpy() * 2 + batch["toxic"].to_numpy()) * (BUCKETS + 1)
            keys = np.concatenate([np.append(np.unique(ids), BUCKETS) + g
                                   for ids, g in zip(_buckets(batch["ids"]), group)]
                                  or [np.empty(0, dtype=np.int64)])
            key, n = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int32()), pa.array(n, pa.int64())],
                                             schema=schema)

    got = (taught.select("toxic", "fold", "ids").mapInArrow(count, "key int, n long")
           .groupBy("key").agg(F.sum("n").alias("n")).toArrow())
    found = np.zeros(FOLDS * 2 * (BUCKETS + 1), dtype=np.int64)
    found[got["key"].to_numpy()] = got["n"].to_numpy()
    found = found.reshape(FOLDS, 2, BUCKETS + 1)
    return found[:, :, :BUCKETS], found[:, :, BUCKETS]


def _epochs(spark: SparkSession, taught: DataFrame, used: np.ndarray, states: list[np.ndarray],
            documents: list[np.ndarray], first: int, epochs: int) -> None:
    """Train the models on each part and move ``states`` by the mean change of each row over the parts
    that changed it. ``used``: the rows that the documents look up."""
    names = [f"d{i}" for i in range(2 * DIM)]
    schema = pa.schema([("model", pa.int32()), ("row", pa.int32())]
                       + [(c, pa.float32()) for c in names])
    sent = spark.sparkContext.broadcast(([state[used] for state in states], documents, used))

    def learn(part, rows):
        ids = [x for b in rows for x in _buckets(b["ids"])]
        y = np.concatenate([b["toxic"].to_numpy() for b in rows]).astype(np.int64)
        fold = np.concatenate([b["fold"].to_numpy() for b in rows])
        states, documents, used = sent.value
        for k, (state, n) in enumerate(zip(states, documents)):
            use = np.flatnonzero(fold != k)
            if not n.all() or not len(use):
                continue
            m, acc = _from_rows(used, state)
            train(m, acc, [ids[i] for i in use], y[use], n,
                  np.random.default_rng([7, k, part, first]), epochs)
            for row, change in _changes(m, acc, used, state):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), k), pa.int32()), pa.array(row, pa.int32()),
                     *[pa.array(c) for c in np.ascontiguousarray(change.T)]], schema=schema)
            m = acc = None                       # before the next model takes its place

    def run(batches):
        part, rows = None, []                    # a part is in one file, its rows together
        for batch in batches:
            of = batch["part"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1), len(of)]
            for s, e in zip(cuts, cuts[1:]):
                if s == e:
                    continue
                if rows and of[s] != part:
                    yield from learn(part, rows)
                    rows = []
                part = int(of[s])
                rows.append(batch.slice(s, e - s))
        if rows:
            yield from learn(part, rows)

    ddl = "model int, row int, " + ", ".join(f"{c} float" for c in names)
    got = (taught.select("part", "toxic", "fold", "ids").mapInArrow(run, ddl)
           .groupBy("model", "row").agg(*[F.avg(c).cast("float").alias(c) for c in names])
           .toArrow())
    model, row = got["model"].to_numpy(), got["row"].to_numpy()
    change = np.stack([got[c].to_numpy() for c in names], axis=1)
    for k, state in enumerate(states):
        state[row[model == k]] += change[model == k]
    sent.destroy()                               # its files too
    drop_stored(spark)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    """Train and calibrate on every labelled document that may teach (see the top)."""
    with small_batches(spark):                   # rows of token buckets are wide
        return _fit(spark, docs, labels)


def _fit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    taught, parts = _teaching_tokens(docs, labels)
    with_bucket, documents = _document_counts(taught)
    learns = [[f for f in range(FOLDS) if f != k] for k in range(FOLDS + 1)]
    counts = [documents[f].sum(axis=0) for f in learns]
    begun = [start(with_bucket[f].sum(axis=0), n) for f, n in zip(learns, counts)]
    states = [_state(m, start_squares(m)) for m in begun]
    used = np.append(np.flatnonzero(with_bucket.any(axis=(0, 1))), BUCKETS + np.arange(_SMALL))
    if counts[FOLDS].all():
        # A single part is its own mean: its epochs need not meet in between.
        for first in range(0, EPOCHS, EPOCHS if parts == 1 else 1):
            _epochs(spark, taught, used, states, counts, first, EPOCHS if parts == 1 else 1)
    model = _from_rows(np.arange(BUCKETS + _SMALL), states[FOLDS])[0]
    if all(n.all() for n in counts):
        judges = spark.sparkContext.broadcast(([state[used] for state in states[:FOLDS]], used))
        schema = pa.schema([("lang", pa.int32()), ("z", pa.float64()), ("toxic", pa.int32())])

        def judge(batches):
            states, used = judges.value
            models = [_from_rows(used, state)[0] for state in states]
            for batch in batches:
                z = [models[f].logits(_One(ids))[0]
                     for f, ids in zip(batch["fold"].to_numpy(), _buckets(batch["ids"]))]
                yield pa.RecordBatch.from_arrays(
                    [batch["lang"], pa.array(z, pa.float64()), batch["toxic"]], schema=schema)

        limits = best_thresholds(taught.select("toxic", "lang", "fold", "ids").mapInArrow(
            judge, "lang int, z double, toxic int"))
        model.threshold[:] = [limits.get(k, limits[-1]) for k in range(len(LANGUAGES))]
        judges.destroy()
    drop_stored(taught)
    return model


class _One:
    """One document's stored token buckets, as ``Tokens`` of a run of one."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.start = ids, np.array([0])


def _batch_scores(model: Model, column) -> np.ndarray:
    np.seterr(over="ignore")
    found = [model.scores(Tokens(run)) for _, run in chunks(x.as_py() for x in column)]
    return np.concatenate([*found, np.empty(0)])


def toxicity_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts are scored as texts without tokens; a null doc_id is scored, never taught
    from, and its held_out is false; repeated rows give repeated result rows; other columns are not
    read. Without labels of both classes the score is a constant near the only class. An empty table
    gives no rows.
    """
    model = spark.sparkContext.broadcast(fit(spark, docs, labels))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(_batch_scores(model.value,
                                                                batch.column("text")))],
                schema=schema)

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, score double")
    held = F.coalesce(F.expr("crc32(CAST(doc_id AS STRING)) % 5 = 0"), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with a score of 0.5 or more go, the others keep all columns."""
    model = spark.sparkContext.broadcast(fit(spark, docs, table(spark, sf_dir, "labels")))

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_batch_scores(model.value, batch.column("text")) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(spark, table(spark, sf_dir, "documents"),
                           table(spark, sf_dir, "labels"))
