"""The rank index against the offsets themselves, documents against plain list slices."""

import hashlib
import re

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pitchside.llm import fill_in_middle as M

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def test_index_is_exact_and_its_error_bounded():
    r = np.random.default_rng(1)
    for steps in (np.ones(5000), r.integers(1, 12, 50000), r.zipf(1.3, 5000).clip(1, 10 ** 7),
                  [1], [], [10 ** 9, 1, 10 ** 9], np.tile([1, 40], 3000)):
        offsets = np.cumsum(np.array(steps, dtype=np.int64))
        for error in (1, 16, M.ERROR):
            index = M.RankIndex(offsets, error)
            ranks = np.arange(len(offsets))
            assert (index.offset(ranks) == offsets).all()
            assert index.residuals.dtype == np.int8
            assert len(offsets) == 0 or np.abs(offsets - index.predict(ranks)).max() <= error
    smooth = M.RankIndex(np.cumsum(r.integers(1, 12, 50000)), M.ERROR)
    assert len(smooth.ranks) < 50000 / 200               # segments, not points


def texts():
    r = np.random.default_rng(2)
    odd = ["", None, " ", "a", " a", "a ", "\n\t a\x0b\x0cb \r", "é日本 \U0001F600 x", "<P>", "a <S> b",
           "<M", "<<P", "x<S", "y<M", "\x1c\x85 \u00a0\u2028z", "word " * 20000, "x" * 100000]
    words = ["a", "bb", "<", "S>", "é", "日本", "<<", "P>", "ccc", "\n", "\t\t", " "]
    return odd + [" ".join(r.choice(words, r.integers(1, 30))) for _ in range(300)]


def brute(doc, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n, h = len(tokens), hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:i]), "".join(tokens[i:j]), "".join(tokens[j:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc, n, "plain", None, None, text, text
    if h4 % 100 < 80:
        return doc, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "f", 1) for d, t in rows],
                                 "doc_id long, text string, form string, n int").repartition(3)


def test_documents_against_slices(spark):
    rows = [(i, t) for i, t in enumerate(texts() * 2)] + [(None, "a b c"), (5, "a b"), (5, "a b")]
    made = M.fim_documents(frame(spark, rows))
    made = made.withColumn("back", M.restored_text(F.col("output"), F.col("form")))
    got = sorted(map(tuple, made.collect()), key=repr)
    assert got == sorted((brute(d, t) for d, t in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert M.fim_documents(frame(spark, [])).collect() == []


def test_sql_gives_the_same(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "a b c"), (5, "a b")]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([d for d, _ in rows], pa.int64()),
                                        "text": pa.array([t for _, t in rows], pa.string())}))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = sorted(((*r[:5], sha(r[5]), sha(r[6])) for r in (brute(d, t) for d, t in rows)), key=repr)
    assert sorted(con.sql(M.OP12_SQL).fetchall(), key=repr) == want
