"""Each corpus operator against a brute-force version, on small tables with the awkward cases."""

import collections
import hashlib
import itertools
import json
import math
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pitchside.llm import (common, decontaminate, embedding_tiles, gru_lm, jaccard_join,
                           license_scan, line_dedup, piece_viterbi, repeat_removal, token_store,
                           toxicity)

P = pytest.importorskip("public_tokenizers")
rng = np.random.default_rng(3)
VOCAB = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(400)]


def prose(n, seed):
    r = np.random.default_rng(seed)
    return " ".join(r.choice(VOCAB, n))


def documents():
    """Nulls, empty and very long texts, ties, repeated rows, near copies, shared passages."""
    base, passage = prose(120, 1), prose(90, 2)
    near = base.split()
    near[60] = "changed"
    rows = [(1, base), (2, base), (3, " ".join(near)), (4, ""), (5, None), (6, " \t\n "),
            (7, "One"), (8, "one"), (9, "a b"), (10, "A  B"), (11, passage + "\n" + prose(50, 3)),
            (12, prose(40, 4) + "\n" + passage), (13, prose(20000, 5)), (None, base),
            (None, None), (14, "x" * 1500), (15, "é日本 \U0001F600 <|endoftext|> it's  5 ½"),
            (16, "Line one is here now.\n\nLine one is here now.\nother line"),
            (17, "LINE ONE IS HERE NOW.\nunique words"), (18, prose(8, 6)), (18, prose(8, 6)),
            (19, prose(15, 7)), (20, prose(15, 7) + " extra")]
    return rows


SCHEMA = "doc_id long, text string, rep string, key int, n array<int>, i string, line string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "r", 1, [2], "i", "l") for i, t in documents()],
                                 SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_sql(sql):
    """Rows of DuckDB SQL over the same documents."""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", documents())
    return sorted(con.execute(sql).fetchall(), key=repr)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def union(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_decontaminate(spark, none):
    item = ("Alice buys 12 apples for 3 dollars and then she gives 12 apples to her old friend who "
            "lives near the river bank")
    swapped = item.replace("12", "57").replace("3 dollars", "9 dollars")
    broken = item.replace("12", "57", 1)
    rows = [(1, "Intro text. " + item + " more"), (2, swapped), (3, broken), (4, None), (5, ""),
            (6, " ".join(item.split()[:12])), (None, item), (1, "Intro text. " + item + " more")]
    bench = spark.createDataFrame([(1, item, "x"), (2, None, "x"), (None, item, "x"), (3, "a b", "x"),
                                   (1, item, "x")], "item_id long, text string, key string")
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, key int")
    found = decontaminate.contaminated(df, bench)
    assert sorted((r.doc_id or 0, r.item_id, r.reparameterised) for r in found.collect()) == [
        (0, 1, False), (1, 1, False), (2, 1, True)]
    con = duckdb.connect()
    con.register("documents", df.toPandas()[["doc_id", "text"]].astype({"doc_id": "Int64"}))
    con.register("benchmark", bench.toPandas()[["item_id", "text"]].astype({"item_id": "Int64"}))
    assert got(found) == sorted(con.execute(decontaminate.OP1_SQL).fetchall(), key=repr)
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0


def test_decontaminate_items_without_telling_windows(spark):
    """Items of names, numbers or few words are found word for word; a name that starts sentences may
    change like any other."""
    items = {1: "The Great Gatsby Moby Dick War And Peace Jane Eyre", 2: "What is 2+2?",
             3: "1 2 3 4 5 6 7 8 9 10",
             4: "Alice has 12 apples in the old basket. Alice gives 3 apples to the poor neighbour. "
                "Alice then counts what remains in the old basket."}
    other = items[4].replace("Alice", "Bob").replace("12", "57").replace("3", "9")
    rows = [(1, "Some text. " + items[1] + " and more"), (2, "they asked What is 2+2? and left"),
            (3, "count: 1 2 3 4 5 6 7 8 9 10."), (4, "Read this. " + items[4]), (5, other),
            (6, other.replace("Bob", "Eve", 1)), (7, "The Great Gatsby met Jane Eyre"),
            (8, "what is 2+3?"), (9, "1 2 3 4 5 7 8 9 10 11"), (10, ""), (11, "is 2+2"),
            (12, "It rains. The dog sleeps. The cat sleeps.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = decontaminate.contaminated(df, bench)
    assert sorted((r.doc_id, r.item_id, r.reparameterised) for r in found.collect()) == [
        (1, 1, False), (2, 2, False), (3, 3, False), (4, 4, False), (5, 4, True)]
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    con.register("benchmark", bench.toPandas())
    assert got(found) == sorted(con.execute(decontaminate.OP1_SQL).fetchall(), key=repr)


def test_license_scan(spark, docs, none):
    text = "é first.\nLicensed under the Apache License,  Version 9.1. All rights reserved."
    df = spark.createDataFrame([(1, text), (2, "all rights were reserved"), (3, None)],
                               "doc_id long, text string")
    spans = [(r.doc_id, r.license, text.encode()[r.span_start:r.span_end].decode())
             for r in license_scan.license_spans(df).collect()]
    assert sorted(spans) == [(1, "all-rights-reserved", "All rights reserved"),
                             (1, "apache-notice", "Licensed under the Apache License,  Version 9.1")
                             ] or sorted(spans)[1][2].startswith("Licensed under")
    assert license_scan.license_spans(docs).count() == 0
    assert license_scan.license_spans(none).count() == 0


def test_toxicity(spark, docs, none):
    r = np.random.default_rng(8)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        t = prose(int(r.integers(5, 80)), 100 + i).split()
        if bad:
            t.insert(int(r.integers(0, len(t))), str(r.choice(["vilexa", "vileto", "grimor"])))
        rows.append((i, " ".join(t)))
        labels.append((i, int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(0, None), (None, 1), (1, 7)],
                                "doc_id long, toxic int")
    out = {x.doc_id: x for x in toxicity.toxicity_scores(spark, df, lab).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert [i for i in out if out[i].held_out] and all(out[i].held_out for i in held)
    right = sum(out[i].predicted == (i % 4 == 0) for i in held)
    assert right >= 0.9 * len(held)
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in out.values())
    assert toxicity.toxicity_scores(spark, docs, lab).count() == len(documents())
    assert toxicity.toxicity_scores(spark, docs, lab.limit(0)).count() == len(documents())
    assert toxicity.toxicity_scores(spark, none, lab).count() == 0


def test_toxicity_learns_from_every_labelled_document(spark):
    """A mark that stands only in the toxic documents that come last by hash of their id, behind 2,000
    others, is learnt."""
    ids = [i for i in range(5200) if zlib.crc32(str(i).encode()) % 5][:4080]
    by_hash = [r.id for r in spark.createDataFrame([(i,) for i in ids[:2060]], "id long")
               .orderBy(F.xxhash64("id")).collect()]
    late = set(by_hash[-40:])
    text = lambda i, bad: prose(5, i) + (" vilexa" if bad and i not in late else
                                         " qurzon" if bad else "")
    rows = [(i, text(i, i in set(by_hash)), int(i in set(by_hash))) for i in ids]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").cache()
    model = toxicity.fit(spark, df, df)
    score = lambda t: model.scores(toxicity.Tokens([t.encode()]))[0]
    found = [score(prose(5, 9000 + i) + " qurzon") >= 0.5 for i in range(20)]
    clean = [score(prose(5, 9000 + i)) < 0.5 for i in range(20)]
    assert sum(found) >= 18 and sum(clean) >= 18


def test_toxicity_trained_in_parts(spark, monkeypatch):
    """Several tasks' weights, averaged after each epoch, judge unseen documents as well."""
    r = np.random.default_rng(8)
    rows = [(i, prose(int(r.integers(5, 40)), i) + (" vilexa" if i % 4 == 0 else ""), int(i % 4 == 0))
            for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").cache()
    monkeypatch.setattr(toxicity, "PART_BYTES", 20_000)
    out = toxicity.toxicity_scores(spark, df, df).filter("held_out").collect()
    assert sum(x.predicted == (x.doc_id % 4 == 0) for x in out) >= 0.9 * len(out)


def test_toxicity_training_holds_no_second_copy(spark):
    """Documents are read where Arrow holds them, slices and empty ones too, and the changes of a part are
    those of all weights without another copy of them."""
    docs = [np.arange(3 * n, dtype=np.int32).reshape(-1, 3) for n in (2, 0, 5, 1)]
    column = pa.array([d.tobytes() for d in docs], pa.binary())
    held = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    for cut, want in ((column, docs), (column.slice(1, 2), docs[1:3])):
        got = toxicity._buckets(cut)
        assert all((g == w).all() and g.shape == w.shape for g, w in zip(got, want, strict=True))
        assert all(np.shares_memory(g, held) for g in got if len(g))
    r = np.random.default_rng(3)
    for n in (0, 700, toxicity._RUN - toxicity._SMALL, toxicity._RUN, toxicity.BUCKETS):
        used = np.append(np.sort(r.permutation(toxicity.BUCKETS)[:n]),
                         toxicity.BUCKETS + np.arange(toxicity._SMALL))
        begun = toxicity.start(np.ones((2, toxicity.BUCKETS)), np.ones(2))
        state = toxicity._state(begun, toxicity.start_squares(begun))[used]
        m, acc = toxicity._from_rows(used, state)
        m.embed[used[:n:3]] += 1
        acc["bias"] += 2
        m.out_bias -= 1
        tracemalloc.start()
        runs = [(len(row), row.sum(), change.sum()) for row, change in
                toxicity._changes(m, acc, used, state)]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        change = toxicity._state(m, acc)[used] - state
        row = np.flatnonzero(change.any(axis=1))
        assert sum(x for x, _, _ in runs) == len(row) and sum(x for _, x, _ in runs) == used[row].sum()
        assert np.isclose(sum(float(x) for _, _, x in runs), change.sum(dtype=float), rtol=1e-4)
        assert peak < 8 << 20                     # the weights and their squares are 16 MB


def test_toxicity_tasks_get_small_batches(spark, monkeypatch):
    """Wide rows reach Python in batches bounded by bytes while the classifier is fitted, with the same
    rows, and the session's setting is left as it was."""
    wide = (spark.range(0, 600, 1, 1).unionByName(spark.range(600, 603, 1, 1))
            .select("id", F.repeat(F.lit("x"), F.when(F.col("id") < 600, 40_000)
                                   .otherwise(3 * common.BATCH_BYTES).cast("int")).alias("text")))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])],
                                             names=["n", "bytes"])

    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    with common.small_batches(spark):
        got = wide.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r["n"] for r in got) == 603
    assert all(r["bytes"] < 4.1 * common.BATCH_BYTES for r in got)     # the bound and one row
    assert len(got) >= 12 and max(r["n"] for r in got) < 100
    seen, count = [], toxicity._document_counts

    def counted(taught):
        seen.append(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"))
        return count(taught)

    monkeypatch.setattr(toxicity, "_document_counts", counted)
    df = spark.createDataFrame([(i, prose(9, i) + " vile" * (i % 2), i % 2) for i in range(40)],
                               "doc_id long, text string, toxic int").cache()
    toxicity.fit(spark, df, df)
    assert seen == [str(common.BATCH_BYTES)]
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_best_thresholds(spark):
    """The highest F1 over all rows of a language and over all rows, ties and far logits included."""
    r = np.random.default_rng(4)
    rows = [(k, float(z), int(r.random() < 1 / (1 + np.exp(-z))))
            for k, n in ((0, 300), (1, 200), (2, 6))
            for z in np.round(r.normal(0, 30 if k else 1, n), 1 if k else 2)]
    got_limits = toxicity.best_thresholds(spark.createDataFrame(rows, "lang int, z double, toxic int")
                                          .repartition(5))

    def brute(own):
        best = None
        values = sorted({z for _, z, _ in own}, reverse=True)
        for z, below in zip(values, [*values[1:], None]):
            taken = [y for _, x, y in own if x >= z]
            f1 = 2 * sum(taken) / (len(taken) + sum(y for _, _, y in own))
            if best is None or f1 > best[0]:
                best = f1, (z + below) / 2 if below is not None else z - 1
        return best[1]
    assert set(got_limits) == {-1, 0, 1}
    for k in (-1, 0, 1):
        assert got_limits[k] == pytest.approx(brute([x for x in rows if k in (-1, x[0])]))


def test_toxicity_score_is_that_of_the_text_alone():
    """Whatever stands beside a text in its run, one slow pass over its own windows gives its logit."""
    r = np.random.default_rng(9)
    m = toxicity.Model(r.normal(size=(toxicity.BUCKETS, toxicity.DIM)).astype(np.float32),
                       r.normal(size=(toxicity.DIM, sum(toxicity.WIDTHS) * toxicity.FILTERS))
                       .astype(np.float32),
                       r.normal(size=len(toxicity.WIDTHS) * toxicity.FILTERS).astype(np.float32),
                       r.normal(size=len(toxicity.WIDTHS) * toxicity.FILTERS).astype(np.float32), 0.3)
    m.embed[0] = 0
    texts = [b"", b"one", b"", b"two words", prose(30, 1).encode(), b"x y z", b""]
    together = m.logits(toxicity.Tokens(texts))
    for text, got_logit in zip(texts, together):
        rows = m.vectors(toxicity.Tokens([text]).ids)[:-toxicity.PAD]
        rows = np.vstack([rows, np.zeros((2 * toxicity.PAD, toxicity.DIM))])
        pooled, at = [], 0
        for width in toxicity.WIDTHS:
            conv = m.conv[:, at:at + width * toxicity.FILTERS].reshape(toxicity.DIM, width, -1)
            at += width * toxicity.FILTERS
            pooled.append(np.max([sum(rows[s + j] @ conv[:, j] for j in range(width))
                                  for s in range(len(rows) - toxicity.PAD)], axis=0))
        slow = np.maximum(np.concatenate(pooled) + m.bias, 0) @ m.out + m.out_bias
        assert got_logit == pytest.approx(slow, rel=1e-3, abs=1e-3)


def test_piece_viterbi(spark, docs, none):
    path = P.path("piece_bpe_32k.model")
    m = piece_viterbi.read_model(path)

    def brute(t):
        s = (piece_viterbi.MARK + t.replace(" ", piece_viterbi.MARK)) if t else ""
        unknown = min(m.score.values()) - 10
        best = [0.0]
        for e in range(1, len(s) + 1):
            best.append(max([best[e - 1] + unknown if s[e - 1] not in m.score else -math.inf]
                            + [best[b] + m.score[s[b:e]] for b in range(max(0, e - 16), e)
                               if s[b:e] in m.score]))
        return best[-1]
    rows = piece_viterbi.encoded(spark, docs, path).collect()
    assert len(rows) == len(documents()) and all(r.round_trip for r in rows)
    texts = dict((i, t or "") for i, t in documents() if i)
    for r in rows:
        if r.doc_id in texts and len(texts[r.doc_id]) < 3000:
            assert r.score == pytest.approx(brute(texts[r.doc_id]), abs=1e-3)
            assert piece_viterbi.decode(np.array(r.ids, dtype=np.int64), m) == texts[r.doc_id]
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4"))
    assert piece_viterbi.encoded(spark, none, path).count() == 0


def test_repeat_removal(docs, none):
    texts = [(i, (t or "").encode()) for i, t in documents()]
    count = collections.Counter(t[p:p + 400] for _, t in texts for p in range(len(t) - 399))
    expected = []
    for i, t in texts:
        keep = np.ones(len(t), dtype=bool)
        for p in range(len(t) - 399):
            if count[t[p:p + 400]] > 1:
                keep[p:p + 400] = False
        runs = int((np.diff(np.concatenate(([0], (~keep).astype(int)))) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[keep].tobytes()
        expected.append((i, len(t), int((~keep).sum()), runs, hashlib.sha256(kept).hexdigest()))
    assert got(repeat_removal.without_repeats(docs)) == sorted(expected, key=repr)
    assert by_sql(repeat_removal.OP5_SQL) == sorted(expected, key=repr)
    assert repeat_removal.without_repeats(none).count() == 0


def test_embedding_tiles(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(60, 16))
    x[20:30] = x[0] + r.normal(size=(10, 16)) * 0.25
    x[30:36] = x[1]
    x[36] = 3 * x[1]
    rows = [(i, [float(v) for v in x[i]], "c") for i in range(60)]
    rows += [(100, None, "c"), (101, [], "c"), (102, [0.0] * 16, "c"), (None, rows[0][1], "c"),
             (103, [float("nan")] + [1.0] * 15, "c"), (104, [None] + [1.0] * 15, "c"),
             (105, [1e300] * 16, "c"), (106, [2e300] * 16, "c"), (107, [1.0] * 3, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rep string")
    x = np.vstack([x, np.ones((2, 16))])
    ids = [*range(60), 105, 106]
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    comp = union([(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))], ids)
    expected = {i: (int(near[k].sum()), comp[i]) for k, i in enumerate(ids)}
    for block in (8, 1000):
        out = {q.vec_id: q for q in embedding_tiles.near_vectors(df, block_rows=block).collect()}
        assert len(out) == len(rows)
        for i, (n, c) in expected.items():
            assert (out[i].n_links, out[i].component_id, out[i].kept) == (n, c, c == i)
        for i in (100, 101, 102, 103, 104, 107):
            assert (out[i].n_links, out[i].component_id) == (0, i)
    assert embedding_tiles.near_vectors(df.limit(0)).count() == 0
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", [r[:2] for r in rows if r[0] is not None])
    for i, n, c, kept in con.execute(embedding_tiles.OP6_SQL).fetchall():
        assert (n, c, kept) == (*expected.get(i, (0, i)), c == i)


def test_quantisation_bound_holds():
    x = embedding_tiles.unit(np.random.default_rng(1).normal(size=(200, 32)))
    codes, scale, miss = embedding_tiles.quantise(x)
    back = codes * scale[:, None]
    gap = np.abs(x @ x.T - back @ back.T)
    assert (gap <= miss[:, None] + (1 + miss[:, None]) * miss[None] + 1e-12).all()


def test_line_dedup(docs, none):
    texts = sorted({(-1 if i is None else i, t or "") for i, t in documents()})
    first, occ = {}, []
    for i, t in texts:
        for p, line in enumerate(t.split("\n")):
            n = line.strip(" \t\r\f\v").lower()
            if n:
                first.setdefault(n, (i, p))
                occ.append((i, t, p, n))
    sets = {n: {n[k:k + 5] for k in range(max(1, len(n) - 4))} for n in first}
    pairs = [(a, b) for a in sets for b in sets if a < b
             and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    comp = union(pairs, sets)
    keep = {}
    for n, at in first.items():
        keep[comp[n]] = min(at, keep.get(comp[n], at))
    gone = collections.defaultdict(list)
    for i, t, p, n in occ:
        if keep[comp[n]] != (i, p):
            gone[i, t].append(p)
    expected = [(i, len((t or "").split("\n")), len(g), g) for i, t in documents()
                for g in [gone[-1 if i is None else i, t or ""]]]
    assert got(line_dedup.dedup_report(docs)) == sorted(expected, key=repr)
    assert line_dedup.dedup_report(none).count() == 0


def test_line_dedup_every_position(spark):
    """Own shingles: one changed word in a short line is a near copy; lines without blanks that only
    begin alike are not; the emoji is one character; very short lines meet, too."""
    r = np.random.default_rng(31)
    lines = ["https://www.example.com/report-2019", "https://www.example.com/cart/checkout",
             "", "abc", "abcd", "abcdefgh", "abcdefghi", "\U0001F600\U0001F601 smiling \U0001F602",
             "\U0001F600\U0001F601 smiling \U0001F602!"]
    for i in range(60):
        t = prose(int(r.integers(3, 40)), 900 + i)
        at = int(r.integers(0, len(t)))
        lines += [t, t[:at] + "xy" + t[at + 1:]]
    shingles = lambda n: {n[k:k + 5] for k in range(max(1, len(n) - 4))}
    sets = {n: shingles(n) for n in lines if n}
    pairs = [(a, b) for a in sets for b in sets if a < b
             and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    assert len(pairs) > 40
    comp, seen, expected = union(pairs, sets), set(), []
    for p, n in enumerate(lines):
        if n and comp[n] in seen:
            expected.append(p)
        seen.add(comp[n] if n else None)
    df = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")
    assert line_dedup.dedup_report(df).first().removed == expected


def test_blank_lines_of_any_kind_stay(spark):
    text = "a line\r\n\r\n\t\r\nother line\r\n\r\na line\n\t\n\x0b\x0c\n\n a line \t"
    df = spark.createDataFrame([(1, text), (2, "\r\n\r\n")], "doc_id long, text string")
    assert got(line_dedup.dedup_report(df)) == [(1, 10, 2, [5, 9]), (2, 3, 0, [])]


def test_line_hashes_of_long_lines_and_pieces(monkeypatch):
    """Hashing in pieces gives the sets of hashing at once, and sets tell shingles apart."""
    r = np.random.default_rng(8)
    norms = ["".join(chr(c) for c in r.integers(97, 123, n)) for n in (5, 1, 400, 4, 900, 30)]
    norms += ["\U0001F600\U0001F601abc\U0001F602", "ab\u00e9" * 400]
    whole = [s.copy() for s in line_dedup.shingle_sets(norms)]
    monkeypatch.setattr(line_dedup, "PIECE", 64)
    for a, b, n in zip(whole, line_dedup.shingle_sets(norms), norms):
        assert a.tolist() == b.tolist()
        assert len(a) == len({n[k:k + 5] for k in range(max(1, len(n) - 4))})


def test_keys_of_two_lines_are_compared_once(spark):
    """What is left to compare after the neighbours are the lines of keys of three or more."""
    pairs = spark.createDataFrame([(1, 5, 6), (2, 5, 7), (2, 7, 9), (3, 9, 5), (4, 1, 2), (4, 2, 3),
                                   (4, 3, 8)], "key long, a long, b long")
    assert got(line_dedup._lists(pairs)) == sorted(
        [(2, 5), (2, 7), (2, 9), (4, 1), (4, 2), (4, 3), (4, 8)], key=repr)


def test_line_dedup_drops_the_tables_of_finished_steps(docs, monkeypatch):
    left = {}

    def stored(df, name):
        out = common.stored(df, name)
        left[out.stored_path] = name
        return out

    def drop_stored(*tables):
        common.drop_stored(*tables)
        for t in tables:
            left.pop(getattr(t, "stored_path", None), None)

    monkeypatch.setattr(line_dedup, "stored", stored)
    monkeypatch.setattr(line_dedup, "drop_stored", drop_stored)
    line_dedup.dropped_lines(docs)
    assert not {"line-neighbours", "line-lists", "line-open", "line-distinct", "line-sketches"
                } & set(left.values())


def test_lines_of_one_key_over_many_tasks(spark):
    """Neighbours are found across the ends of tasks, also where one key fills several."""
    keys = [1] * 400 + [2] + [3] * 3 + [4] * 90
    rows = spark.createDataFrame([(k, j * 7919 - 10 ** 6) for j, k in enumerate(keys)],
                                 "key long, line long")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = line_dedup.neighbours(rows).collect()
        comp = union([(p.a, p.b) for p in pairs], [x.line for x in rows.collect()])
        assert len(pairs) == 399 + 2 + 89
        assert len(set(comp.values())) == 4
        assert all(p.a != p.b for p in pairs)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_gru_lm(docs, none):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in documents()}
    count = collections.Counter()
    for i, t in documents():
        if i is not None and not held[i]:
            count.update(words(t) + ["\n"])
    n, v = sum(count.values()), len(count)
    out = gru_lm.lm_scores(docs).collect()
    expected = sorted((repr(i), held[i], len(words(t)) + 1,
                       sum(count[w] > 0 for w in words(t) + ["\n"]), n,
                       round(sum(math.log10((count[w] + 1) / (n + v + 1))
                                 for w in words(t) + ["\n"]), 6)) for i, t in documents())
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 6)) for r in out) == expected
    assert all(r.score < 0 for r in out)
    assert gru_lm.lm_scores(none).count() == 0


def test_gru_every_teaching_document_teaches(spark, monkeypatch):
    """Training sees each teaching document once, over all rounds."""
    rows = [(i, f"only{i} here") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    teaching = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    took, seen = gru_lm._mean, []

    def mean(n, weights):
        seen.append(int(n.sum()))
        return took(n, weights)
    monkeypatch.setattr(gru_lm, "_mean", mean)
    v = gru_lm.Vocabulary(np.arange(1, 4, dtype=np.uint64), np.array([3, 2, 1]), 600, 300)
    gru_lm.train(df, v)
    assert sum(seen) == 3 * len(teaching)


def test_gru_gradients_and_carried_state():
    r = np.random.default_rng(0)
    labels = np.arange(1, 100, dtype=np.uint64)
    v = gru_lm.Vocabulary(labels, np.arange(99, 0, -1), 6000, 150)
    p = {k: x.astype(np.float64) for k, x in gru_lm.start_weights(v).items()}
    inp, target = r.integers(0, v.size, (3, 6)), r.integers(0, v.size, (3, 6))
    live, fresh, h0 = r.random((3, 6)) < 0.8, r.random((3, 6)) < 0.3, r.normal(size=(3, 16))
    _, g, _ = gru_lm.window_gradients(p, inp, target, live, fresh, h0)
    for k in p:
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        side = []
        for e in (1e-5, -1e-5):
            q = {a: b.copy() for a, b in p.items()}
            q[k][at] += e
            side.append(gru_lm.window_gradients(q, inp, target, live, fresh, h0)[0])
        assert (side[0] - side[1]) / 2e-5 / live.sum() == pytest.approx(g[k][at], rel=0.02, abs=1e-5)
    ids = [r.integers(0, v.size, n).astype(np.int32) for n in (1, 150, 64, 65)]
    whole = gru_lm.document_loglik(p, ids, v.end_id)
    for d, total in zip(ids, whole):            # step by step, without windows or batches
        h, last, s = np.zeros((1, 16)), v.end_id, 0.0
        for t in d:
            h, _ = gru_lm.gru_step(p, p["emb"][[last]] @ p["w"] + p["b"], h)
            s += float(gru_lm.token_loglik(p, h, np.array([t]))[0])
            last = t
        assert total == pytest.approx(s, rel=1e-4)


def test_gru_scores_step_by_step(docs, monkeypatch):
    """The query's score against one step after the other, rare shares included (texts of up to 3,000
    words)."""
    monkeypatch.setattr(gru_lm, "VOCAB", 60)
    took, made = gru_lm.train, []

    def train(df, v):
        made.append((v, took(df, v)))
        return made[0][1]
    monkeypatch.setattr(gru_lm, "train", train)
    got = collections.defaultdict(list)
    for r in gru_lm.lm_scores(docs).collect():
        got[r.doc_id, r.n_tokens].append(r.score)
    (v, p), count = made[0], collections.Counter()
    for i, t in documents():
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(words(t))
    rare_floor = math.log10(v.rare_total + v.rare_distinct + 1)
    n_rare = 0
    for i, t in documents():
        if len(words(t)) > 3000:
            continue
        labels = gru_lm.tokens([(t or "").encode()])[0]
        total, h, last = 0.0, np.zeros((1, gru_lm.HIDDEN), np.float32), v.end_id
        for word, token in zip([*words(t), None], v.ids(labels)):
            h, _ = gru_lm.gru_step(p, p["emb"][[last]] @ p["w"] + p["b"], h)
            total += float(gru_lm.token_loglik(p, h, np.array([token]))[0]) / math.log(10)
            if token == v.rare_id:
                total += math.log10(count[word] + 1) - rare_floor
                n_rare += 1
            last = token
        assert any(s == pytest.approx(total, rel=1e-4) for s in got[i, len(labels)]), i
    assert n_rare > 100


def test_gru_long_text_trains_in_bounded_memory():
    """One text of 400,000 tokens among short ones: nothing is padded to its length, all lanes work."""
    import tracemalloc
    r = np.random.default_rng(4)
    v = gru_lm.Vocabulary(np.arange(1, 100, dtype=np.uint64), np.arange(99, 0, -1), 6000, 150)
    docs = [np.append(r.integers(2, v.size, n), v.end_id).astype(np.int32) for n in (5, 400_000, 0, 7)]
    trainer = gru_lm.Trainer(gru_lm.start_weights(v), v.end_id)
    tracemalloc.start()
    trainer.learn(docs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert trainer.tokens == 400_016 and trainer.steps == -(-400_016 // (128 * 32))
    assert peak < 40 << 20


def test_gru_weights_are_averaged_in_levels(spark, monkeypatch):
    """More partitions than FAN_IN: the levels' average is that of all, weighted by tokens."""
    monkeypatch.setattr(gru_lm, "FAN_IN", 3)
    monkeypatch.setattr(gru_lm, "ROUNDS", 1)
    df = spark.createDataFrame([(i, f"w{i % 9} here") for i in range(120)],
                               "doc_id long, text string").repartition(20)
    v = gru_lm.Vocabulary(np.arange(1, 4, dtype=np.uint64), np.array([3, 2, 1]), 600, 300)
    in_levels = gru_lm.train(df, v)
    monkeypatch.setattr(gru_lm, "FAN_IN", 1000)
    at_once = gru_lm.train(df, v)
    for k in at_once:
        assert np.allclose(in_levels[k], at_once[k], atol=1e-5)


def test_class_factored_softmax_sums_to_one():
    v = gru_lm.Vocabulary(np.arange(1, 80, dtype=np.uint64), np.arange(80, 1, -1), 4000, 100)
    p = gru_lm.start_weights(v)
    h = np.tile(np.random.default_rng(2).normal(size=(1, 16)).astype(np.float32), (v.size, 1))
    assert np.exp(gru_lm.token_loglik(p, h, np.arange(v.size))).sum() == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize("bits", [1, 5, 13, 16, 17, 32])
def test_bit_packing_round_trip(bits):
    x = np.random.default_rng(bits).integers(0, 1 << bits, 1000).astype(np.uint32)
    packed = np.frombuffer(token_store.pack(x, bits), np.uint8)
    assert len(packed) == -(-1000 * bits // 8)
    assert (token_store.unpack(packed, bits, 0, 1000) == x).all()
    assert (token_store.unpack(packed, bits, 37, 503) == x[37:503]).all()
    block = token_store.Block(token_store.make_block([7, 9], [x[:300], x[300:]], bits))
    assert (block.document(1) == x[300:]).all() and block.ids(0, 0).size == 0


def test_token_store(spark, docs, none):
    path = P.path("byte_bpe_50k.json")
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(path)
    rows = sorted(((-math.inf if i is None else i, t or "") for i, t in documents()),
                  key=lambda r: r[0])
    out = token_store.stored_ids(spark, docs, path).orderBy("start").collect()
    assert len(out) == len(rows)
    at, by_doc = 0, collections.defaultdict(list)
    for i, t in rows:
        ids = np.array(lib.encode(t, add_special_tokens=False).ids + [0], dtype="<u4")
        by_doc[i].append((len(ids), zlib.crc32(ids)))
    for r, (i, _) in zip(out, rows):
        key = -math.inf if r.doc_id is None else r.doc_id
        assert key == i and r.start == at and (r.n_tokens, r.ids_crc32) in by_doc[i]
        at += r.n_tokens
    assert token_store.stored_ids(spark, none, path).count() == 0


def test_encoder_follows_the_tokenizer():
    """Other ways to cut or change a text are the library's; the query's tokenizer stays fast."""
    from tokenizers import Tokenizer
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        own = json.load(f)
    level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    digits = {"type": "Sequence", "pretokenizers": [
        {"type": "Digits", "individual_digits": True}, level]}
    texts = ["Hello World 2024 and 12345", "", "it's  5 apples\n"]
    for change in ({}, {"pre_tokenizer": level | {"add_prefix_space": True}},
                   {"pre_tokenizer": digits}, {"pre_tokenizer": level | {"use_regex": False}},
                   {"normalizer": {"type": "Lowercase"}}):
        spec = json.dumps(own | change)
        lib, encoder = Tokenizer.from_str(spec), token_store.Encoder(spec)
        assert encoder.plain == (not change)
        assert [x.tolist() for x in encoder.encode(texts)] == [
            lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_jaccard_join(docs, none):
    def shingles(t):
        w = words(t)
        return frozenset(tuple(w[k:k + 3]) for k in range(len(w) - 2)) if len(w) > 2 else (
            frozenset([tuple(w)] if w else []))
    sets = {i: shingles(t) for i, t in documents() if i is not None}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    comp = union(pairs, sets)
    expected = [(i, len(shingles(t)), comp[i] if i is not None else None) for i, t in documents()]
    assert got(jaccard_join.jaccard_classes(docs)) == sorted(expected, key=repr)
    assert by_sql(jaccard_join.OP10_SQL) == sorted(expected, key=repr)
    assert jaccard_join.jaccard_classes(none).count() == 0


def test_jaccard_join_light_and_heavy_sets(spark):
    """Random edits around the sizes where light and heavy sets meet."""
    r = np.random.default_rng(9)
    rows = []
    for i in range(120):
        t = prose(int(r.integers(3, 45)), 500 + i % 40).split()
        for _ in range(int(r.integers(0, 3))):
            t[0 if r.random() < 0.5 else -1] = str(r.choice(VOCAB))
        rows.append((i, " ".join(t)))
    sets = {i: frozenset(tuple(w[k:k + 3]) for k in range(max(1, len(w) - 2)))
            for i, w in ((i, t.split()) for i, t in rows)}
    pairs = [(a, b) for a in sets for b in sets if a < b
             and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    comp = union(pairs, sets)
    out = jaccard_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {q.doc_id: q.component_id for q in out.collect()} == comp


def word_sets(rows, size):
    out = {}
    for i, t in rows:
        w = words(t)
        out[i] = frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1)))
    return out


def test_jaccard_join_five_words_at_eight_tenths(spark):
    """Sets of 5 to 30 shingles of which up to a fifth differs, light, heavy and across; subsets
    with any number of elements left out."""
    s = np.arange(1, 9, dtype=np.uint64)
    for drop in range(5):
        got_sums = sorted(int(x) for x in jaccard_join._subsets(s, drop))
        m = [int(x) for x in jaccard_join.mix(s)]
        assert got_sums == sorted(sum(c) % (1 << 64) for c in itertools.combinations(m, 8 - drop))
    assert jaccard_join.boundaries() == (9, 19, 29) and jaccard_join.boundaries(80, 100) == (4, 9, 14)
    r = np.random.default_rng(12)
    rows = []
    for i in range(320):
        t = prose(9 + i % 26, 700 + i % 40).split()
        for _ in range(int(r.integers(0, 7))):
            t[0 if r.random() < 0.5 else -1] = str(r.choice(VOCAB))
            if r.random() < 0.5:
                t = t[1:]
            elif r.random() < 0.5:
                t = t + [str(r.choice(VOCAB))]
        rows.append((i, " ".join(t)))
    sets = word_sets(rows, 5)
    pairs = [(a, b) for a in sets for b in sets if a < b
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert sum(15 <= len(sets[a]) < 30 and sets[a] != sets[b] for a, b in pairs) > 10
    df = spark.createDataFrame(rows, "doc_id long, text string")
    comp = union(pairs, sets)
    for boundary in (None, 19):          # sets with three elements left out
        with pytest.MonkeyPatch.context() as patch:
            if boundary:
                patch.setattr(jaccard_join, "choose_boundary", lambda *a: boundary)
            out = jaccard_join.jaccard_classes(df, 5, 80, 100)
            assert {q.doc_id: q.component_id for q in out.collect()} == comp


def test_pipeline_stage_keeps_one_document_per_class(spark):
    """Five words at 0.8, by brute force; repeated rows, null ids, one id with two texts."""
    def edited(t, k):
        w = t.split()
        return " ".join(["new"] * k + w[k:])
    a, b, c, d = (prose(40, 800 + i) for i in range(4))
    rows = [(5, a), (3, edited(a, 3)), (9, edited(b, 2)), (7, b), (7, b), (7, c), (8, c), (None, d),
            (None, d), (None, a), (11, ""), (12, None), (12, None), (13, edited(c, 9)), (2, prose(30, 9))]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, x int")
    keys = sorted({(i is None, i or 0, t or "") for i, t in rows})
    sets = word_sets([(k, k[2]) for k in keys], 5)
    pairs = [(p, q) for p in keys for q in keys if p < q and words(p[2]) and words(q[2])
             and 100 * len(sets[p] & sets[q]) >= 80 * len(sets[p] | sets[q])]
    comp = union(pairs, keys)
    expected = sorted((k[1], k[2]) for k in keys if comp[k] == k)
    out = jaccard_join.keep_one_per_class(spark, df, "")
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == expected


def thue_morse(bits):
    """The Thue-Morse word of 2**bits letters and its complement: equal sums modulo 2**64."""
    word = "a"
    for _ in range(bits):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_long_words_do_not_collide(spark):
    from pitchside.llm.textnum import Words
    for bits in range(6, 14):
        one, other = thue_morse(bits)
        h = Words([one.encode(), other.encode()]).hash
        assert h[0] != h[1]
    one, other = thue_morse(11)
    df = spark.createDataFrame([(1, f"{one} x y"), (2, f"{other} x y"), (3, f"{one} x y")],
                               "doc_id long, text string")
    assert got(jaccard_join.jaccard_classes(df)) == [(1, 1, 1), (2, 1, 2), (3, 1, 1)]


def test_repeats_of_colliding_words(spark):
    """Strings of 400 bytes from the family on which power-of-two sums collide."""
    one, other = thue_morse(9)
    df = spark.createDataFrame([(1, one), (2, other)], "doc_id long, text string")
    out = {r.doc_id: r.n_removed for r in repeat_removal.without_repeats(df).collect()}
    strings = [t[p:p + 400] for t in (one, other) for p in range(len(t) - 399)]
    assert (len(set(strings)) == len(strings)) == (out == {1: 0, 2: 0})


def test_jaccard_stage_keeps_a_clashing_key(spark):
    names = ("_key", "key", "row", "class", "_class", "at", "first", "rows")
    df = spark.createDataFrame([(1, "a b c d e f", *range(70, 78)), (2, "a b c d e f", *range(8)),
                                (3, "x", *range(8)), (3, "x", *range(8))],
                               "doc_id long, text string, " + ", ".join(f"{n} long" for n in names))
    out = jaccard_join.keep_one_per_class(spark, df, "")
    assert out.columns == df.columns
    assert got(out) == [(1, "a b c d e f", *range(70, 78)), (3, "x", *range(8))]
