"""Aligned tokens, links and pair counts against a token-by-token version."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitchside.llm import token_alignment as T

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, a int, kind string"


@pytest.fixture(scope="module")
def both():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=B)


def token_bytes(both):
    t, sp = both
    own = [*range(33, 127), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in own}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    of_a = {i: bytes(letters.get(c, 63) for c in n) for n, i in t.get_vocab().items()}
    of_b = lambda i: (bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
                      else sp.id_to_piece(i).replace("▁", " ").encode())
    return of_a.__getitem__, of_b


def spans(ids, size):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(size(i))))
        at = out[-1][1]
    return out


def brute(both, rows):
    of_a, of_b = token_bytes(both)
    docs = []
    for doc, text in rows:
        a = both[0].encode(" " + text, add_special_tokens=False).ids if text else []
        b = both[1].encode(text) if text else []
        want = (" " + (text or "")).encode()
        if not text or b"".join(map(of_a, a)) != want or b"".join(map(of_b, b)) != want:
            docs.append((doc, [], [], 0, Counter(), ""))
            continue
        sa, sb = spans(a, of_a), spans(b, of_b)
        groups, links, start, j = [], Counter(), 0, 0
        for cut in sorted({e for _, e in sa} & {e for _, e in sb}):
            groups.append("|".join(",".join(str(i) for i, (x, _) in zip(ids, at) if start <= x < cut)
                                   for ids, at in ((a, sa), (b, sb))))
            start = cut
        for i, (x, y) in zip(a, sa):
            while sb[j][1] <= x:
                j += 1
            k = j
            while k < len(sb) and sb[k][0] < y:
                links[i, b[k]] += 1
                k += 1
        docs.append((doc, a, b, len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(p for d in docs for p in d[4])
    top = defaultdict(int)
    for (i, _), c in count.items():
        top[i] = max(top[i], c)
    return [(d, len(a), len(b), g, sum(l.values()), h,
             sum(m for p, m in l.items() if count[p] == top[p[0]]),
             sum(m * count[p] for p, m in l.items())) for d, a, b, g, l, h in docs], count


def rows():
    r = np.random.default_rng(4)
    words = ["the", "of", "naïve", "日本", "42", "it's", "Über", "xyzzy", ",", "end.", "\n", "  "]
    made = [(i, " ".join(r.choice(words, r.integers(1, 60)))) for i in range(150)]
    return made + [(None, None), (1, ""), (2, " "), (3, "a▁b"), (4, "x <|endoftext|> <s> </s> <unk> <0x0A>"),
                   (5, " two  blanks \n\n end \t "), (6, "日本語 naïve \U0001F600\U0001F3FD ́"), (6, "same"),
                   (6, "same"), (None, "same"), (7, "a\x00b"), (8, "x" * 3000)]


@pytest.mark.parametrize("sizes", [(T.CHUNK_POSTINGS, T.RUN_BYTES), (50, 100)])
def test_against_token_by_token(spark, both, sizes):
    docs = spark.createDataFrame([(d, t, 1, "k") for d, t in rows()], SCHEMA).repartition(5)
    index = T.index_documents(docs, open(A, encoding="utf-8").read(), open(B, "rb").read(), *sizes)
    counts = T.pair_counts(index)
    assert (index.filter("kind = 'doc'").agg(F.countDistinct("chunk")).first()[0] > 20) == (sizes[0] == 50)
    want, count = brute(both, rows())
    assert sorted(map(tuple, T.document_scores(index, counts).collect()), key=repr) == sorted(want, key=repr)
    assert {(r.a, r.b): r.n_docs for r in counts.collect()} == count
    assert sum(r.n_links for r in counts.collect()) == sum(r[4] for r in want)
    assert T.align_documents(spark.createDataFrame([], SCHEMA), A, B).collect() == []


def test_long_text_in_parts(both):
    pair = T.Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())
    text = "Lorem  ipsum,\n dolor it's 12 naïve 日本 sit \t amet. " * 6000
    assert len(T._segments(" " + text)) > 2
    (a,), (b,) = pair.encode([text])
    assert a.tolist() == both[0].encode(" " + text, add_special_tokens=False).ids
    assert b.tolist() == both[1].encode(text)


def test_bitmaps_hold_documents_and_multiplicities():
    r = np.random.default_rng(6)
    for docs in (1, 9, 300, 65536):
        want = {(int(p), int(d)): int(m) for p, d, m in zip(
            r.integers(0, 5, 4000), r.integers(0, docs, 4000), r.zipf(1.5, 4000).clip(1, 70000))}
        keys = np.array(sorted((p << 16) | d for p, d in want), dtype=np.int64)
        times = np.array([want[int(k) >> 16, int(k) & 0xFFFF] for k in keys])
        got = Counter()
        for plane, pairs, n, bits in T.bitmaps(keys, times, docs):
            at = T._positions(bits, n)
            for p, d in zip(np.repeat(pairs, n), at):
                got[int(p), int(d)] += 1 if plane == 0 else 1 << (plane - 1)
        assert got == want
