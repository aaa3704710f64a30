"""License scans: winnowed template fingerprints in an inverted index, then banded alignment.

Texts are words of letters and digits in lower case (A-Z); a number counts as ``0``, so versions and
years do not matter. Every template's 3-word grams are winnowed (the least hash of every two
neighbours stays) into an index gram -> (template, position). All grams of a whole document look
themselves up; hits of one template near one diagonal make a candidate, which a Smith-Waterman
alignment restricted to a band around that diagonal turns into the matched template words and their
span in the document. Spans that cover at least ``COVERAGE`` of a template are reported; where spans
overlap, the one with the most matched words.

Templates are a parameter; their number and size bound the index that every task receives.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pitchside.llm.common import ids_and_text, table
from pitchside.llm.textnum import U, Words, chunks, mix

GRAM, WINNOW = 3, 2
COVERAGE, BAND = 0.8, 8
MATCH, MISMATCH, GAP = 2, -1, -1

# Short notices by which a license is named in a file.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "mit-notice": "Released under the MIT License.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
                 "this software and associated documentation files, to deal in the software "
                 "without restriction",
    "apache-grant": "You may not use this file except in compliance with the License. You may "
                    "obtain a copy of the License at",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, "
                 "are permitted provided that the following conditions are met",
    "gpl-grant": "This program is free software: you can redistribute it and/or modify it under "
                 "the terms of the GNU General Public License as published by the Free Software "
                 "Foundation",
}

_GAPS = np.ones(256, dtype=bool)
_GAPS[48:58] = _GAPS[65:91] = _GAPS[97:123] = _GAPS[128:] = False
_NUMBER = U(0x30)


class Terms:
    """Word labels of a run of texts (numbers alike), their byte spans, and all 3-word grams."""

    def __init__(self, texts: list[bytes]):
        w = Words(texts, _GAPS)
        self.bounds, self.text_start = w.bounds, w.text_start
        self.start, self.end = w.start, w.end
        label = mix(w.hash)
        digit = (w.buf >= 48) & (w.buf < 58)
        count = np.concatenate(([0], np.cumsum(digit)))
        number = count[w.end] - count[w.start] == w.end - w.start
        self.label = np.where(number, _NUMBER, label)
        n = max(0, len(label) - GRAM + 1)
        g = np.zeros(n, dtype=U)
        for j in range(GRAM):
            g = mix((g ^ self.label[j:j + n]) + U(j + 1))
        self.gram = g


def winnow(grams: np.ndarray) -> list[int]:
    """Positions of the least gram (the last of equals) of every WINNOW neighbours."""
    if len(grams) <= WINNOW:
        return list(range(len(grams)))
    kept = {s + WINNOW - 1 - int(np.argmin(grams[s:s + WINNOW][::-1]))
            for s in range(len(grams) - WINNOW + 1)}
    return sorted(kept)


@dataclass
class Index:
    names: list[str]
    words: list[np.ndarray]
    grams: np.ndarray                       # sorted distinct template grams
    places: dict[int, list[tuple[int, int]]]    # gram -> (template, position)


def build_index(templates: dict[str, str]) -> Index:
    """Templates of fewer than three words have no gram and are never reported."""
    np.seterr(over="ignore")
    words, places = [], defaultdict(list)
    for k, text in enumerate(templates.values()):
        t = Terms([text.encode()])
        words.append(t.label)
        for p in winnow(t.gram):
            places[int(t.gram[p])].append((k, p))
    return Index(list(templates), words, np.sort(np.array(list(places), dtype=U)), dict(places))


def align(doc: np.ndarray, template: np.ndarray, shift: int, band: int = BAND):
    """Best local alignment of template words t with document words t + shift +- band:
    (matched template words, first and last matched document word), or None."""
    n, width = len(template), 2 * band + 1
    score = np.zeros((n + 1, width + 2), dtype=np.int64)
    step = np.zeros((n + 1, width + 2), dtype=np.int8)
    best, where = 0, None
    for t in range(1, n + 1):
        for b in range(1, width + 1):
            d = t - 1 + shift + b - 1 - band
            if not 0 <= d < len(doc):
                continue
            same = doc[d] == template[t - 1]
            options = ((0, 0), (score[t - 1, b] + (MATCH if same else MISMATCH), 1),
                       (score[t - 1, b + 1] + GAP, 2), (score[t, b - 1] + GAP, 3))
            score[t, b], step[t, b] = max(options, key=lambda o: o[0])
            if score[t, b] > best:
                best, where = score[t, b], (t, b)
    if where is None:
        return None
    t, b = where
    matched, first, last = 0, None, None
    while score[t, b] > 0 and step[t, b]:
        d = t - 1 + shift + b - 1 - band
        if step[t, b] == 1:
            if doc[d] == template[t - 1]:
                matched += 1
                first, last = d, d if last is None else last
            t -= 1
        elif step[t, b] == 2:
            t, b = t - 1, b + 1
        else:
            b -= 1
    return matched, first, last


def scan_run(texts: list[bytes], index: Index):
    """(text, template, matched, coverage, start byte, end byte) of each reported span."""
    terms = Terms(texts)
    if not len(index.grams) or not len(terms.gram):
        return
    at = np.minimum(np.searchsorted(index.grams, terms.gram), len(index.grams) - 1)
    hits = np.flatnonzero(index.grams[at] == terms.gram)
    owner = np.searchsorted(terms.bounds, hits, side="right") - 1
    near: dict[tuple[int, int], list[int]] = defaultdict(list)
    for g, text in zip(hits.tolist(), owner.tolist()):
        if g + GRAM > terms.bounds[text + 1]:
            continue                        # a gram across two texts
        for template, p in index.places[int(terms.gram[g])]:
            near[text, template].append(g - int(terms.bounds[text]) - p)
    spans: dict[int, list[tuple]] = defaultdict(list)
    for (text, template), shifts in sorted(near.items()):
        a, b = int(terms.bounds[text]), int(terms.bounds[text + 1])
        words = index.words[template]
        free = 0                            # document words before it belong to a reported span
        for shift in sorted(set(shifts)):
            lo = max(free, shift - BAND)
            hi = min(b - a, shift + len(words) + BAND)
            if shift + len(words) <= free or lo >= hi:
                continue
            found = align(terms.label[a + lo:a + hi], words, shift - lo)
            if found and found[0] >= COVERAGE * len(words):
                spans[text].append((-found[0], template, lo + found[1], lo + found[2]))
                free = lo + found[2] + 1
    for text, found in sorted(spans.items()):
        a, base, kept = int(terms.bounds[text]), int(terms.text_start[text]), []
        for less, template, first, last in sorted(found):
            if all(last < f or first > x for f, x in kept):     # the longest match of a place
                kept.append((first, last))
                yield (text, template, -less, -less / len(index.words[template]),
                       int(terms.start[a + first]) - base, int(terms.end[a + last]) - base)


def license_spans(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per span: doc_id, license, n_words (of the template), n_matched, coverage,
    span_start, span_end (bytes of the UTF-8 text).

    Null and empty texts have no spans; a null doc_id stays null; repeated rows are reported as
    often as they stand; other columns are not read; an empty table or no templates give no rows.
    """
    spark = docs.sparkSession
    index = spark.sparkContext.broadcast(build_index(TEMPLATES if templates is None else templates))
    fields = [("doc_id", pa.int64()), ("license", pa.string()), ("n_words", pa.int64()),
              ("n_matched", pa.int64()), ("coverage", pa.float64()), ("span_start", pa.int64()),
              ("span_end", pa.int64())]

    def run(batches):
        np.seterr(over="ignore")
        for batch in batches:
            rows = []
            ids = batch.column("doc_id")
            for first, texts in chunks(x.as_py() for x in batch.column("text")):
                for text, k, matched, cover, start, end in scan_run(texts, index.value):
                    rows.append((ids[first + text].as_py(), index.value.names[k],
                                 len(index.value.words[k]), matched, cover, start, end))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in rows], t) for j, (_, t) in enumerate(fields)],
                schema=pa.schema(fields))

    return ids_and_text(docs).mapInArrow(
        run, "doc_id long, license string, n_words long, n_matched long, coverage double, "
             "span_start long, span_end long")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_spans(table(spark, sf_dir, "documents"))
