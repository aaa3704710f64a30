"""Fill-in-the-middle documents cut through a learned rank index.

A text of n tokens has n + 1 boundaries; a cut needs the offset of the k-th. The index answers that
without keeping the offsets: straight segments are fitted to the points (rank, byte offset) of all
boundaries of a run of texts, each within ``ERROR`` bytes, and one signed byte per boundary holds what
the segment's prediction misses. A cut is prediction plus residual: exact.

Tokens are ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``; the separators are ASCII, so
boundaries are found on UTF-8 bytes and never fall inside a character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm.common import ids_and_text, table
from pitchside.llm.textnum import chunks

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Shares in percent of transformed documents and, of those, of the suffix-first form; hash seed.
RATE, SPM_RATE, SEED = 50, 80, 42
#: Largest miss of a segment, so that a residual fits a signed byte.
ERROR = 127

_GAP = np.zeros(256, dtype=bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


class RankIndex:
    """Rank -> offset for strictly increasing ``offsets``: segments (first rank, its offset, slope)
    and a residual byte per rank."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR):
        ranks, bases, slopes = [], [], []
        n, at, window = len(offsets), 0, 1024
        while at < n:
            # The cone of slopes that keep every point so far within the error; it ends a segment
            # when it is empty. Points are taken in growing windows.
            low, high, end = 0.0, np.inf, at + 1
            while end < n:
                stop = min(n, end + window)
                x = np.arange(end - at, stop - at, dtype=np.float64)
                y = (offsets[end:stop] - offsets[at]).astype(np.float64)
                highs = np.minimum.accumulate(np.minimum((y + error - 0.5) / x, high))
                lows = np.maximum.accumulate(np.maximum((y - error + 0.5) / x, low))
                bad = np.flatnonzero(lows > highs)
                if len(bad):
                    last = int(bad[0])
                    if last:
                        low, high = lows[last - 1], highs[last - 1]
                    end += last
                    window = max(64, min(window, 2 * (end - at)))
                    break
                low, high, end = lows[-1], highs[-1], stop
                window = min(2 * window, 1 << 16)
            ranks.append(at)
            bases.append(int(offsets[at]))
            slopes.append((low + high) / 2 if np.isfinite(high) else 0.0)
            at = end
        self.ranks = np.array(ranks, dtype=np.int64)
        self.bases = np.array(bases, dtype=np.int64)
        self.slopes = np.array(slopes, dtype=np.float64)
        miss = offsets - self.predict(np.arange(n)) if n else np.zeros(0, dtype=np.int64)
        if n and int(np.abs(miss).max()) > error:
            raise AssertionError("a segment misses by more than the error bound")
        self.residuals = miss.astype(np.int8)

    def predict(self, rank: np.ndarray) -> np.ndarray:
        seg = np.searchsorted(self.ranks, rank, side="right") - 1
        return self.bases[seg] + np.rint(self.slopes[seg] * (rank - self.ranks[seg])).astype(np.int64)

    def offset(self, rank: np.ndarray) -> np.ndarray:
        """Exact offsets of the given ranks."""
        return self.predict(rank) + self.residuals[rank]


def boundaries(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts laid end to end: the offsets where a token ends (ascending), the number of tokens of
    each text, and the offset where each text begins (one more than texts)."""
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    begin = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    gap = _GAP[buf]
    # A word ends before a separator; the last token of a text ends with it.
    ends = np.zeros(len(buf) + 1, dtype=bool)
    ends[1:-1] = ~gap[:-1] & gap[1:]
    ends[begin[1:][np.diff(begin) > 0]] = True
    at = np.flatnonzero(ends)
    return at, np.diff(np.searchsorted(at, begin, side="right")), begin


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document: the first digit groups of a SHA-256."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def transform(doc_ids: list[int | None], texts: list[bytes], seed: int = SEED, rate: int = RATE,
              spm_rate: int = SPM_RATE) -> Iterator[tuple[int, str, int | None, int | None, bytes]]:
    """``n, form, prefix_chars, middle_chars, output`` of each document of a run."""
    at, counts, begin = boundaries(texts)
    index = RankIndex(at)
    first = np.concatenate(([0], np.cumsum(counts)))
    forms, cuts, ranks = [], [], []
    for i, (doc, text) in enumerate(zip(doc_ids, texts)):
        h1, h2, h3, h4 = draws(doc, seed)
        if not text or h3 % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
            forms.append(PLAIN)
            continue
        forms.append(SPM if h4 % 100 < spm_rate else PSM)
        n = int(counts[i])
        for k in sorted((h1 % (n + 1), h2 % (n + 1))):
            cuts.append(len(ranks) if k else -1)
            if k:                               # boundary 0 is the text's begin
                ranks.append(int(first[i]) + k - 1)
    offsets = index.offset(np.array(ranks, dtype=np.int64))
    places = iter(cuts)
    for i, (form, text) in enumerate(zip(forms, texts)):
        if form == PLAIN:
            yield int(counts[i]), form, None, None, text
            continue
        a, b = (0 if p < 0 else int(offsets[p] - begin[i]) for p in (next(places), next(places)))
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        out = (PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle if form == PSM
               else SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle)
        yield int(counts[i]), form, _chars(prefix), _chars(middle), out


def _chars(utf8: bytes) -> int:
    return len(utf8.decode("utf-8"))


def fim_documents(docs: DataFrame, seed: int = SEED, rate: int = RATE,
                  spm_rate: int = SPM_RATE) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` per row of ``docs`` (columns doc_id and
    text; others are not read, so names cannot clash).

    A null text is an empty one, and empty texts stay plain. A null doc_id draws from the seed alone.
    Repeated rows each get their row (the same one). No shuffle; a task holds one run of about 2 MB
    of text, or one longer text whole."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
                        ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                        ("output", pa.string())])

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for start, texts in chunks(_strings(batch.column("text"))):
                part = ids[start:start + len(texts)]
                rows = list(transform(part, texts, seed, rate, spm_rate))
                columns = [list(c) for c in zip(*rows)]
                columns[4] = pa.array(columns[4], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int64()), pa.array(columns[0], pa.int64()),
                     pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64()),
                     pa.array(columns[3], pa.int64()), columns[4]], schema=schema)

    return ids_and_text(docs).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def _strings(column: pa.Array) -> Iterator[str]:
    for value in column:
        yield value.as_py()


def restored_text(output: Column, form: Column) -> Column:
    """The text that an output was made of, from output and form alone: a text with a marker inside
    is never transformed, so the first marker after the head is the cut."""
    def part(of: Column, start: int, mark: str) -> tuple[Column, Column]:
        at = F.locate(mark, of, start) if isinstance(start, int) else F.call_function(
            "locate", F.lit(mark), of, start)
        return at, at + len(mark)

    def between(of: Column, a: Column, b: Column) -> Column:
        return F.substring(of, a, b - a)

    s, after_s = part(output, 4, "<S>")
    m_psm, after_m_psm = part(output, after_s, "<M>")
    p, after_p = part(output, 4, "<P>")
    m_spm, after_m_spm = part(output, after_p, "<M>")
    rest = F.length(output) + 1
    psm = F.concat(between(output, F.lit(4), s), between(output, after_m_psm, rest),
                   between(output, after_s, m_psm))
    spm = F.concat(between(output, after_p, m_spm), between(output, after_m_spm, rest),
                   between(output, F.lit(4), p))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim_documents(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored_text(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


_WS = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"
#: Cuts by list slices of the matched tokens; no index.
OP12_SQL = f"""
WITH hashed AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
         sha256('{SEED}:' || coalesce(doc_id::varchar, '')) AS h FROM documents),
drawn AS (
  SELECT row, doc_id, text, regexp_extract_all(text, '{_WS}*{_WORD}+|{_WS}+') AS tokens,
         ('0x' || h[1:8])::bigint AS h1, ('0x' || h[9:16])::bigint AS h2,
         ('0x' || h[17:24])::bigint AS h3, ('0x' || h[25:32])::bigint AS h4 FROM hashed),
formed AS (
  SELECT *, len(tokens) AS n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                   OR contains(text, '<M>') OR h3 % 100 >= {RATE} THEN 'plain'
              WHEN h4 % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j
  FROM formed),
cut AS (
  SELECT *, coalesce(array_to_string(tokens[1:i], ''), '') AS p,
         coalesce(array_to_string(tokens[i + 1:j], ''), '') AS m,
         coalesce(array_to_string(tokens[j + 1:], ''), '') AS s FROM parts)
SELECT doc_id, n::bigint AS n, form,
       CASE WHEN form <> 'plain' THEN length(p)::bigint END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::bigint END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(p || m || s) AS restored_sha256
FROM cut
"""
