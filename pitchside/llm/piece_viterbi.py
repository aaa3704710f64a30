"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text becomes marked words: a dummy blank in front (as the model asks), every blank written as the
mark U+2581, and a cut wherever a mark follows another character. No piece of a model that splits by
white space crosses such a cut, which is checked when the model is read, so a text's best
segmentation is that of its words. The distinct marked words of a run of texts are sorted, which lays
a trie out in depth-first order: going from one word to the next pops back to the common prefix and
computes forward scores for the new characters alone.

The score of a path is the sum of its pieces' scores in the model; a character without a piece costs
the least score minus ten and is written as its UTF-8 byte pieces. Of equal paths the one whose last
piece is shortest wins, from the end backwards.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm.common import ids_and_text, table

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Characters of the texts that share one trie (a longer text has its own).
RUN_CHARS = 8 << 20
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass
class Pieces:
    """Scores and ids of the ordinary pieces, and the id of each byte piece."""

    score: dict[str, float]
    ids: dict[str, int]
    byte_id: list[int]
    text: list[bytes | str]
    dummy_blank: bool

    def __post_init__(self):
        #: Length of the longest piece by its last two characters.
        self.reach: dict[str, int] = {}
        for p in self.score:
            if len(p) > 1:
                self.reach[p[-2:]] = max(len(p), self.reach.get(p[-2:], 0))


def read_model(path: str, dummy_blank: bool = True) -> Pieces:
    """The pieces of a SentencePiece model file with byte pieces."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    names = [m.id_to_piece(i) for i in range(n)]
    ordinary = [i for i in range(n) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i)
                                            or m.is_unused(i))]
    if crossing := [names[i] for i in ordinary if re.search(f"[^{MARK}]{MARK}", names[i])]:
        raise ValueError(f"pieces cross word starts: {crossing[:3]}")
    byte_id = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(m.is_byte(i) for i in byte_id):
        raise ValueError("the model has no byte pieces")
    text: list[bytes | str] = [""] * n
    for i in ordinary:
        text[i] = names[i]
    for b, i in enumerate(byte_id):
        text[i] = bytes([b])
    return Pieces({names[i]: m.get_score(i) for i in ordinary}, {names[i]: i for i in ordinary},
                  byte_id, text, dummy_blank)


def viterbi(words: list[str], pieces: Pieces) -> Iterator[tuple[list[int], float]]:
    """(ids, score) of each word; ``words`` are sorted and distinct.

    ``best[i]`` and ``back[i]`` describe the best path over the first i characters of the current
    word; the next word keeps them up to the common prefix."""
    score, reach, ids = pieces.score, pieces.reach, pieces.ids
    unknown = min(score.values(), default=0.0) - UNKNOWN_PENALTY
    best, back = [0.0], [0]
    before = ""
    get, far = score.get, reach.get
    for w in words:
        n, keep = len(w), 0
        top = min(n, len(before))
        if w[:top] == before[:top]:
            keep = top
        else:
            while w[keep] == before[keep]:
                keep += 1
        del best[keep + 1:], back[keep + 1:]
        for end in range(keep + 1, n + 1):
            how = end - 1
            high = best[how] + get(w[how], unknown)
            # No piece that ends in these two characters is longer.
            for start in range(end - 2, max(-1, end - 1 - far(w[end - 2:end], 0)), -1):
                hit = get(w[start:end])
                if hit is not None:
                    hit += best[start]
                    if hit > high:
                        high, how = hit, start
            best.append(high)
            back.append(how)
        path, end = [], n
        while end:
            start = back[end]
            piece = ids.get(w[start:end])
            if piece is not None:
                path.append(piece)
            else:
                path.extend(pieces.byte_id[b] for b in reversed(
                    w[start:end].encode("utf-8", "surrogatepass")))
            end = start
        path.reverse()
        yield path, best[n]
        before = w


def marked_words(text: str, pieces: Pieces) -> list[str]:
    if not text:
        return []
    return _WORDS.findall((MARK if pieces.dummy_blank else "") + text.replace(" ", MARK))


class _Index(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def encode(texts: list[str], pieces: Pieces) -> list[tuple[np.ndarray, float]]:
    """(ids, score) of each whole text; an empty text has no ids."""
    index = _Index()
    rows = []
    for t in texts:
        words = marked_words(t, pieces)
        rows.append(np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words)))
    words = sorted(index)
    order = np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words))
    n = np.zeros(len(words) + 1, dtype=np.int64)
    scores = np.zeros(len(words))
    flat: list[int] = []
    for k, (ids, s) in zip(order, viterbi(words, pieces)):
        n[k] = len(ids)
        scores[k] = s
        flat.extend(ids)
    ids = np.array(flat, dtype=np.int32)
    at = np.zeros(len(words), dtype=np.int64)
    at[order] = np.concatenate(([0], np.cumsum(n[order])[:-1])) if len(words) else []
    out = []
    for w in rows:
        k = n[w]
        end = np.cumsum(k)
        total = int(end[-1]) if len(end) else 0
        out.append((ids[np.arange(total) + np.repeat(at[w] - (end - k), k)],
                    float(scores[w].sum())))
    return out


def decode(ids: np.ndarray, pieces: Pieces) -> str:
    """The text of an id sequence; bytes that are no UTF-8 become replacement characters."""
    parts, run = [], bytearray()
    for p in map(pieces.text.__getitem__, ids.tolist()):
        if isinstance(p, bytes):
            run += p
            continue
        if run:
            parts.append(_utf8(run))
            run = bytearray()
        parts.append(p)
    if run:
        parts.append(_utf8(run))
    text = "".join(parts).replace(MARK, " ")
    return text[1:] if pieces.dummy_blank and text.startswith(" ") else text


def _utf8(run: bytearray) -> str:
    try:
        return run.decode("utf-8", "surrogatepass")
    except UnicodeDecodeError:
        return run.decode("utf-8", "replace")


def _runs(column) -> Iterator[list[str]]:
    run, size = [], 0
    for x in column:
        t = x.as_py()
        if run and size + len(t) > RUN_CHARS:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def encoded(spark: SparkSession, docs: DataFrame, model_path: str, with_ids: bool = True
            ) -> DataFrame:
    """One row per document row: doc_id, n_tokens, score, ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers), round_trip (decoding gives the text back) and, if asked, ids.

    Null and empty texts have no ids and score 0. A text's own U+2581 decodes as a blank, as the
    mark stands for one; round_trip compares on that footing. Null doc_ids and repeated rows pass
    through; other columns are not read; an empty table gives no rows.
    """
    pieces = spark.sparkContext.broadcast(read_model(model_path))
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64()),
              ("ids_crc32", pa.int64()), ("round_trip", pa.bool_())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))

    def run(batches):
        for batch in batches:
            at = 0
            for texts in _runs(batch.column("text")):
                found = encode(texts, pieces.value)
                ids = [x for x, _ in found]
                columns = [batch.column("doc_id").slice(at, len(texts)),
                           pa.array(map(len, ids), pa.int64()),
                           pa.array([s for _, s in found], pa.float64()),
                           pa.array([zlib.crc32(x.astype("<u4")) for x in ids], pa.int64()),
                           pa.array([decode(x, pieces.value) == t.replace(MARK, " ")
                                     for x, t in zip(ids, texts)], pa.bool_())]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    schema = "doc_id long, n_tokens long, score double, ids_crc32 long, round_trip boolean"
    return ids_and_text(docs).mapInArrow(run, schema + ", ids array<int>" * with_ids)


def _model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the token ids of every document."""
    return encoded(spark, docs, _model_path()).select("doc_id", "n_tokens", "ids")


def op4_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark, table(spark, sf_dir, "documents"), _model_path(), with_ids=False)
