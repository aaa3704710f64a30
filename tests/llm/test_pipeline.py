"""The pipeline's stages take effect, keep columns and clean documents, and run on odd tables."""

import itertools
import os
import re

import pytest

import corpus_pipeline as C
from pitchside.llm.common import stored
from pitchside.llm.toxicity import toxicity_scores

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def heads_of_classes(texts, size=5, tenths=8):
    """The smallest id of each class that ``size``-word shingles link at ``tenths`` / 10."""
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 10 * len(x & y) >= tenths * len(x | y):
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {i for i in up if up[i] == i}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    bad = {r[0] for r in toxicity_scores(spark, docs, labels).filter("predicted = 1")
           .select("doc_id").collect()}
    ids = {r[0] for r in docs.select("doc_id").collect()}
    step = stored(C.toxicity(spark, docs, SF), "t")
    assert step.columns == columns
    assert {r[0] for r in step.select("doc_id").collect()} == ids - bad
    lines = stored(C.line_dedup(spark, step, SF), "t")
    assert lines.columns == columns and lines.count() == step.count()
    seen = [x.strip(" \t\r\f\v").lower() for r in lines.collect() for x in (r.text or "").split("\n")]
    seen = [x for x in seen if x]
    assert len(seen) == len(set(seen))
    one = stored(C.jaccard_join(spark, lines, SF), "t")
    heads = heads_of_classes({r.doc_id: r.text or "" for r in lines.collect()})
    assert one.columns == columns and {r[0] for r in one.select("doc_id").collect()} == heads
    clean = stored(C.decontamination(spark, one, SF), "t")
    assert clean.columns == columns
    plain = lambda t: re.sub(r"\W+", " ", t.lower())
    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not [r.doc_id for r in clean.collect() if any(x in plain(r.text) for x in items)]
    assert {r[0] for r in one.select("doc_id").collect()} - {
        r[0] for r in clean.select("doc_id").collect()} <= {
        r.doc_id for r in one.collect()
        if any(" ".join(x.split()[2:-2]) in plain(r.text) for x in items)}
    ids = C.encoding(spark, clean, SF)
    assert ids.count() == clean.count()


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        docs = stored(stage(spark, docs, SF), "empty")
        assert docs.count() == 0
