"""LM scoring: a gated recurrent language model, trained in numpy, over whole documents.

* Counts: every token of every teaching document is counted (words and one end per document).
* Vocabulary: the ``VOCAB`` most frequent tokens, the end and ``rare`` for all others, laid out in
  classes of ``CLASS_SIZE`` by frequency. The softmax is factored: class, then token within class.
  A rare token's probability is that of ``rare`` times its smoothed share of the rare counts.
* Training: each round, every partition runs truncated backpropagation through time over the
  teaching documents that the round takes (one hash residue of all), and the partitions' weights are
  averaged by the tokens they saw, in levels of ``FAN_IN``. The rounds take every residue once: all
  teaching documents teach, whole.
* Scoring: documents of a run advance in step, longest first; the hidden state is carried from
  window to window, so a score is the log10 likelihood of the complete document.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm.common import drop_stored, ids_and_text, stored, table
from pitchside.llm.textnum import U, Words, chunks, mix

VOCAB, CLASS_SIZE = 4096, 64
EMBED = HIDDEN = 16
#: Rounds of averaged training; each takes the teaching documents of one residue of ROUNDS.
ROUNDS = 2
LANES, WINDOW = 128, 32
#: Rate of the first update; after SLOWING updates it has fallen to 0.7 of it, as 1 / sqrt goes on.
RATE, SLOWING = 0.06, 100
#: Tokens of the documents that are dealt to lanes at once.
RUN_TOKENS = 1 << 20
#: Partitions' weights averaged in one task.
FAN_IN = 16
#: Scoring: text bytes of a run, most steps and tokens of a window, tokens of one softmax slice.
RUN_BYTES, SCORE_STEPS, SCORE_TOKENS, SLICE = 32 << 20, 4096, 1 << 16, 1 << 13
#: Counts of so many frequent tokens are sent to every task (8 MB); the others' counts are joined.
TABLE = 1 << 19
#: Label of the end token: no word hashes to it but by chance of 2**-64.
END = U(0x5EED0FE11D0C5EED)

Weights = dict[str, np.ndarray]


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(labels, bounds): the words of each text and its end; text i has ``bounds[i]:bounds[i+1]``."""
    w = Words(texts)
    n = len(texts)
    bounds = w.bounds + np.arange(n + 1)
    out = np.full(int(bounds[-1]), END, dtype=U)
    word = np.ones(len(out), dtype=bool)
    word[bounds[1:] - 1] = False
    out[word] = mix(w.hash)
    return out, bounds


def _teaches(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 7 != 2, F.lit(False))


def _held(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _round(column: str = "doc_id"):
    """The round that a teaching document teaches in."""
    return F.pmod(F.xxhash64(column), F.lit(ROUNDS))


def count_tokens(docs: DataFrame) -> DataFrame:
    """(h, c): label and count of every distinct token of all teaching documents."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64())])

    def run(batches):
        np.seterr(over="ignore")
        for batch in batches:
            for _, texts in chunks(x.as_py() for x in batch.column("text")):
                h = np.sort(tokens(texts)[0])
                at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[at].view(np.int64)), pa.array(np.diff(np.append(at, len(h))))],
                    schema=schema)

    return (docs.filter(_teaches()).select("text").mapInArrow(run, "h long, c long")
            .groupBy("h").agg(F.sum("c").alias("c")))


class Vocabulary:
    """Token labels to ids: 0 the end, 1 rare, then words by falling count."""

    def __init__(self, labels: np.ndarray, counts: np.ndarray, total: int, distinct: int):
        word = labels != END
        self.total, self.distinct = total, distinct
        words = labels[word][:VOCAB - 2]
        n_words = counts[word][:VOCAB - 2]
        n_end = int(counts[~word].sum())
        self.rare_total = total - int(n_words.sum()) - n_end
        self.rare_distinct = distinct - len(words) - int(n_end > 0)
        n = np.concatenate(([n_end, self.rare_total], n_words)) + 1.0
        place = np.argsort(np.argsort(-n, kind="stable"), kind="stable")
        order = np.argsort(words)
        self.sorted, self.id = words[order], place[2:][order].astype(np.int32)
        self.end_id, self.rare_id = int(place[0]), int(place[1])
        self.size = len(n)
        self.weight = np.zeros(-(-len(n) // CLASS_SIZE) * CLASS_SIZE)
        self.weight[place] = n
        look = np.argsort(labels)
        self.table, self.table_count = labels[look], counts[look]

    def ids(self, labels: np.ndarray) -> np.ndarray:
        out = np.full(len(labels), self.rare_id, dtype=np.int32)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, labels), len(self.sorted) - 1)
            out = np.where(self.sorted[at] == labels, self.id[at], out)
        out[labels == END] = self.end_id
        return out

    def counts(self, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known in the table, count there)."""
        if not len(self.table):
            return np.zeros(len(labels), dtype=bool), np.zeros(len(labels), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.table, labels), len(self.table) - 1)
        hit = self.table[at] == labels
        return hit, np.where(hit, self.table_count[at], 0)


def start_weights(v: Vocabulary, seed: int = 11) -> Weights:
    """Random recurrent weights; output biases at the unigram log probabilities."""
    rng = np.random.default_rng(seed)
    classes = len(v.weight) // CLASS_SIZE
    by_class = v.weight.reshape(classes, CLASS_SIZE)
    with np.errstate(divide="ignore"):
        bc = np.log(by_class.sum(axis=1) / v.weight.sum())
        bo = np.where(by_class > 0, np.log(by_class / by_class.sum(axis=1, keepdims=True)), -1e4)
    r = lambda *s, k=1.0: rng.normal(0, k / np.sqrt(s[-2]), s).astype(np.float32)
    return {"emb": rng.normal(0, 0.3, (len(v.weight), EMBED)).astype(np.float32),
            "w": r(EMBED, 3 * HIDDEN), "u": r(HIDDEN, 3 * HIDDEN),
            "b": np.zeros(3 * HIDDEN, dtype=np.float32),
            "wc": r(HIDDEN, classes, k=0.1), "bc": bc.astype(np.float32),
            "wo": r(classes, HIDDEN, CLASS_SIZE, k=0.1), "bo": bo.astype(np.float32)}


def gru_step(p: Weights, x: np.ndarray, h: np.ndarray):
    """One step; ``x`` are the projected inputs. Returns the new state and what the way back needs."""
    n = HIDDEN
    a = h @ p["u"]
    zr = np.tanh((x[:, :2 * n] + a[:, :2 * n]) * 0.5)       # the logistic function by tanh
    zr += 1
    zr *= 0.5
    z, r = zr[:, :n], zr[:, n:]
    c = np.tanh(x[:, 2 * n:] + r * a[:, 2 * n:])
    return h + z * (c - h), (z, r, c, a[:, 2 * n:])


def _softmax_parts(x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log probability of column ``own`` of each row, sums); ``x`` becomes exp(x - row maximum)."""
    top = x.max(axis=1)
    x -= top[:, None]
    got = x[np.arange(len(x)), own]
    np.exp(x, out=x)
    sums = x @ np.ones(x.shape[1], dtype=x.dtype)
    return got - np.log(sums), sums


def class_order(target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Rows in order of their targets' classes, and (class, from, to) of each class in that order."""
    c = target // CLASS_SIZE
    order = np.argsort(c.astype(np.uint16), kind="stable")
    c = c[order]
    cuts = [0, *(np.flatnonzero(np.diff(c)) + 1).tolist(), len(c)]
    return order, [(int(c[a]), a, b) for a, b in zip(cuts[:-1], cuts[1:]) if b > a]


def _inner_logits(p: Weights, h: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Logits within the class, for rows in order of their classes."""
    x = np.empty((len(h), CLASS_SIZE), dtype=h.dtype)
    for c, a, b in spans:
        np.matmul(h[a:b], p["wo"][c], out=x[a:b])
        x[a:b] += p["bo"][c]
    return x


def token_loglik(p: Weights, h: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log probability of each target given its state."""
    h = h.astype(p["wc"].dtype, copy=False)
    out = np.empty(len(target))
    for s in range(0, len(target), SLICE):
        order, spans = class_order(target[s:s + SLICE])
        x, t = h[s:s + SLICE][order], target[s:s + SLICE][order]
        outer, _ = _softmax_parts(x @ p["wc"] + p["bc"], t // CLASS_SIZE)
        inner, _ = _softmax_parts(_inner_logits(p, x, spans), t % CLASS_SIZE)
        out[s + order] = outer.astype(float) + inner
    return out


def window_gradients(p: Weights, inp: np.ndarray, target: np.ndarray, live: np.ndarray,
                     fresh: np.ndarray, h0: np.ndarray) -> tuple[float, Weights, np.ndarray]:
    """Loss, gradients and last state of one window (lanes, steps). ``live`` masks padding, ``fresh``
    marks first tokens of documents, where the state starts from zero."""
    inp, target, live, fresh = (np.ascontiguousarray(x.T) for x in (inp, target, live, fresh))
    steps, lanes = inp.shape
    kind, n = p["w"].dtype, HIDDEN
    word = inp.ravel()
    embedded = p["emb"][word]
    x = (embedded @ p["w"] + p["b"]).reshape(steps, lanes, 3 * n)
    goes_on = (~fresh).astype(kind)[:, :, None]
    before = np.empty((steps, lanes, n), dtype=kind)
    hs, kept, h = np.empty_like(before), [], h0
    for t in range(steps):
        np.multiply(h, goes_on[t], out=before[t])
        h, cache = gru_step(p, x[t], before[t])
        hs[t] = h
        kept.append(cache)
    g: Weights = {}
    rows = np.flatnonzero(live.ravel())
    order, spans = class_order(target.ravel()[rows])
    rows = rows[order]
    goal, hr = target.ravel()[rows], hs.reshape(-1, n)[rows]
    at, ones = np.arange(len(rows)), np.ones(len(rows), dtype=kind)
    d = hr @ p["wc"] + p["bc"]
    got, sums = _softmax_parts(d, goal // CLASS_SIZE)
    loss = -float(got.sum(dtype=float))
    d /= sums[:, None]
    d[at, goal // CLASS_SIZE] -= 1
    g["wc"], g["bc"] = hr.T @ d, ones @ d
    dh_rows = d @ p["wc"].T
    d = _inner_logits(p, hr, spans)
    got, sums = _softmax_parts(d, goal % CLASS_SIZE)
    loss -= float(got.sum(dtype=float))
    d /= sums[:, None]
    d[at, goal % CLASS_SIZE] -= 1
    g["wo"], g["bo"] = np.zeros_like(p["wo"]), np.zeros_like(p["bo"])
    for c, a, b in spans:
        np.matmul(hr[a:b].T, d[a:b], out=g["wo"][c])
        np.matmul(ones[a:b], d[a:b], out=g["bo"][c])
        dh_rows[a:b] += d[a:b] @ p["wo"][c].T
    dhs = np.zeros((steps * lanes, n), dtype=kind)
    dhs[rows] = dh_rows
    dhs = dhs.reshape(steps, lanes, n)
    dh = np.zeros((lanes, n), dtype=kind)
    da, dx = (np.empty((steps, lanes, 3 * n), dtype=kind) for _ in range(2))
    back = np.ascontiguousarray(p["u"].T)
    for t in range(steps - 1, -1, -1):
        z, r, c, ac = kept[t]
        dh = dh + dhs[t]
        dn = dh * z * (1 - c * c)
        dx[t, :, :n] = dh * (c - before[t]) * z * (1 - z)
        dx[t, :, n:2 * n] = dn * ac * r * (1 - r)
        dx[t, :, 2 * n:] = dn
        da[t, :, :2 * n] = dx[t, :, :2 * n]
        da[t, :, 2 * n:] = dn * r
        dh = (dh * (1 - z) + da[t] @ back) * goes_on[t]
    dx = dx.reshape(-1, 3 * n)
    g["u"] = before.reshape(-1, n).T @ da.reshape(-1, 3 * n)
    g["w"], g["b"] = embedded.T @ dx, dx.sum(axis=0)
    # Rows of one word are summed side by side; only the window's words change.
    order = np.argsort(word.astype(np.uint16), kind="stable")
    first = np.flatnonzero(np.diff(word[order], prepend=-1))
    g["emb"] = np.zeros_like(p["emb"])
    g["emb"][word[order[first]]] = np.add.reduceat((dx @ p["w"].T)[order], first, axis=0)
    for v in g.values():
        v /= max(1, len(rows))
    return loss, g, h


class Trainer:
    """Truncated backpropagation with Adam over token ids of whole documents (each with its end). The
    state is carried across windows; weights and moments are carried from one run of documents to
    the next, so memory does not grow with the documents seen."""

    def __init__(self, p: Weights, end_id: int):
        self.p = {k: v.copy() for k, v in p.items()}
        self.m1, self.m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        self.end_id, self.steps, self.tokens = end_id, 0, 0

    def update(self, g: Weights) -> None:
        self.steps += 1
        rate = RATE / (1 + self.steps / SLOWING) ** 0.5 / (1 - 0.9 ** self.steps)
        scale = 1 / (1 - 0.99 ** self.steps)
        for k, x in g.items():
            m1, m2 = self.m1[k], self.m2[k]
            np.clip(x, -1, 1, out=x)
            m1 *= 0.9
            m1 += 0.1 * x
            m2 *= 0.99
            x *= x
            x *= 0.01
            m2 += x
            np.multiply(m2, scale, out=x)
            np.sqrt(x, out=x)
            x += 1e-8
            np.divide(m1, x, out=x)
            x *= rate
            self.p[k] -= x

    def learn(self, docs: list[np.ndarray]) -> None:
        """One pass over the documents: one after the other they make a text that is cut into equal
        lanes, so every window is full and nothing is padded to the longest. A document that a cut
        parts goes on in the next lane with the state zero and the token before the cut."""
        if not docs:
            return
        target = np.concatenate(docs)
        fresh = np.zeros(len(target), dtype=bool)
        fresh[np.cumsum([0, *map(len, docs[:-1])])] = True
        inp = np.concatenate(([self.end_id], target[:-1])).astype(target.dtype)     # each ends with it
        lane = -(-len(target) // LANES)
        start = np.arange(0, len(target), lane)
        h = np.zeros((len(start), HIDDEN), dtype=self.p["w"].dtype)
        for s in range(0, lane, WINDOW):
            at = start[:, None] + np.arange(s, min(s + WINDOW, lane))
            live = at < len(target)
            at[~live] = 0
            _, g, h = window_gradients(self.p, inp[at], target[at], live, fresh[at] & live, h)
            self.update(g)
        self.tokens += len(target)


def _dump(p: Weights) -> bytes:
    b = io.BytesIO()
    np.savez(b, **p)
    return b.getvalue()


def _load(b: bytes) -> Weights:
    with np.load(io.BytesIO(b)) as z:
        return {k: z[k] for k in z.files}


def train(docs: DataFrame, v: Vocabulary) -> Weights:
    """Rounds of local training on every partition, then the average weighted by tokens. Weights are
    averaged ``FAN_IN`` at a time, level by level, until so many are left for the driver; every level
    is stored, so a lost executor does not cost the training again."""
    spark = docs.sparkSession
    p = start_weights(v)
    words = spark.sparkContext.broadcast(v)
    schema = "grp int, n long, weights binary"
    fields = pa.schema([("grp", pa.int32()), ("n", pa.int64()), ("weights", pa.binary())])

    def average(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("grp")
        return pd.DataFrame([{"grp": int(pdf["grp"].iloc[0]) // FAN_IN, "n": int(pdf["n"].sum()),
                              "weights": _dump(_mean(pdf["n"], pdf["weights"]))}])

    for r in range(ROUNDS):
        model = spark.sparkContext.broadcast(_dump(p))

        def local(batches, model=model):
            np.seterr(over="ignore")
            trainer, mine, size = Trainer(_load(model.value), words.value.end_id), [], 0
            for batch in batches:
                for _, texts in chunks(x.as_py() for x in batch.column("text")):
                    labels, bounds = tokens(texts)
                    ids = words.value.ids(labels)
                    mine += np.split(ids, bounds[1:-1])
                    size += len(ids)
                    if size >= RUN_TOKENS:
                        trainer.learn(mine)
                        mine, size = [], 0
            trainer.learn(mine)
            if trainer.tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()], pa.int32()),
                     pa.array([trainer.tokens]), pa.array([_dump(trainer.p)])], schema=fields)

        took = _round() == r
        parts = stored(docs.filter(_teaches()).filter(took).select("text")
                       .mapInArrow(local, schema), "lm-weights")
        while parts.count() > FAN_IN:
            fewer = stored(parts.groupBy(F.floor(F.col("grp") / FAN_IN).alias("up"))
                           .applyInPandas(average, schema), "lm-weights")
            drop_stored(parts)
            parts = fewer
        few = parts.orderBy("grp").toPandas()
        drop_stored(parts)
        if len(few):
            p = _mean(few["n"], few["weights"])
    return p


def _mean(n: pd.Series, weights: pd.Series) -> Weights:
    total, out = float(n.sum()), {}
    for k, b in zip(n, weights):
        for name, x in _load(b).items():
            out[name] = out.get(name, 0) + x * np.float32(k / total)
    return out


def document_loglik(p: Weights, docs: list[np.ndarray], end_id: int) -> np.ndarray:
    """Natural log likelihood of each whole document of token ids (each ends with the end id)."""
    n = np.array([len(d) for d in docs], dtype=np.int64)
    order = np.argsort(-n, kind="stable")
    total = np.zeros(len(docs))
    first = np.concatenate(([0], np.cumsum(n)))[:-1][order]
    n = n[order]
    flat = np.concatenate([*docs, np.empty(0, dtype=np.int32)])
    x_of = p["emb"] @ p["w"] + p["b"]
    h = np.zeros((len(docs), HIDDEN), dtype=np.float32)
    previous = np.full(len(docs), end_id, dtype=np.int32)
    longest = int(n[0]) if len(n) else 0
    states, targets, alive = [], [], []
    held = 0
    for t in range(longest):
        k = int(np.searchsorted(-n, -t))        # documents longer than t come first
        h, _ = gru_step(p, x_of[previous[:k]], h[:k])
        previous = flat[first[:k] + t]
        states.append(h)
        targets.append(previous)
        alive.append(k)
        held += k
        if held >= SCORE_TOKENS or len(states) == SCORE_STEPS or t == longest - 1:
            got = token_loglik(p, np.concatenate(states), np.concatenate(targets))
            owner = np.concatenate([np.arange(k) for k in alive])
            total += np.bincount(owner, weights=got, minlength=len(docs))
            states, targets, alive = [], [], []
            held = 0
    out = np.empty(len(docs))
    out[order] = total
    return out


def lm_scores(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null or empty text is its end token alone; a null doc_id is scored, never learned from, and
    not held out; repeated rows count and are scored as often as they stand; without teaching
    documents all tokens are unknown; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = ids_and_text(docs)
    counts = stored(count_tokens(docs), "lm-counts")
    totals = counts.agg(F.sum("c"), F.count("*")).first()
    total, distinct = int(totals[0] or 0), int(totals[1])
    top = counts.orderBy(F.desc("c"), "h").limit(TABLE).toArrow()
    v = Vocabulary(top["h"].to_numpy().astype(np.int64).view(U), top["c"].to_numpy(), total,
                   distinct)
    model = spark.sparkContext.broadcast((v, train(docs, v)))
    base_floor = float(np.log10(total + distinct + 1))
    rare_floor = float(np.log10(v.rare_total + v.rare_distinct + 1))
    cols = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()),
            ("base", pa.float64()), ("score", pa.float64()), ("h", pa.list_(pa.int64())),
            ("n", pa.list_(pa.int32()))]

    def run(batches):
        np.seterr(over="ignore")
        voc, p = model.value
        for batch in batches:
            for first, texts in _runs(batch.column("text")):
                ids, rows = [], []
                for _, part in chunks(texts):
                    labels, bounds = tokens(part)
                    token = voc.ids(labels)
                    hit, c = voc.counts(labels)
                    base = np.where(hit, np.log10(c + 1.0) - base_floor, 0.0)
                    rare = np.where(hit & (token == voc.rare_id), np.log10(c + 1.0) - rare_floor, 0)
                    for a, b in zip(bounds[:-1], bounds[1:]):
                        h, n = np.unique(labels[a:b][~hit[a:b]].view(np.int64), return_counts=True)
                        rows.append((b - a, int(hit[a:b].sum()), float(base[a:b].sum()),
                                     float(rare[a:b].sum()), h, n))
                    ids += np.split(token, bounds[1:-1])
                loglik = document_loglik(p, ids, voc.end_id) / np.log(10)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(texts)),
                     pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.float64()),
                     pa.array([s + r[3] for s, r in zip(loglik, rows)], pa.float64()),
                     pa.array([r[4] for r in rows], pa.list_(pa.int64())),
                     pa.array([r[5] for r in rows], pa.list_(pa.int32()))], schema=pa.schema(cols))

    part = docs.mapInArrow(run, "doc_id long, n_tokens long, known long, base double, score double,"
                                " h array<long>, n array<int>")
    part = stored(part.withColumn("row", F.monotonically_increasing_id()), "lm-documents")
    rest = (part.select("row", F.inline(F.arrays_zip("h", "n")))
            .join(counts, "h", "left")
            .groupBy("row").agg(
                F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("known2"),
                F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("logs"),
                F.sum("n").alias("n2")))
    logs, n2 = F.coalesce("logs", F.lit(0.0)), F.coalesce("n2", F.lit(0))
    return part.drop("h", "n").join(rest, "row", "left").select(
        "doc_id", _held().alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("known2", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + logs - n2 * base_floor).alias("base_score"),
        (F.col("score") + logs - n2 * rare_floor).alias("score"))


def _runs(column) -> Iterator[tuple[int, list[str]]]:
    first, run, size = 0, [], 0
    for i, x in enumerate(column):
        t = x.as_py()
        if run and size + len(t) > RUN_BYTES:
            yield first, run
            first, run, size = i, [], 0
        run.append(t)
        size += len(t)
    if run:
        yield first, run


def op8_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
