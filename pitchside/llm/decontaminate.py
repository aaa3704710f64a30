"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Texts become tokens stripped of outer punctuation, lower-cased, with typed placeholders for what a
re-parameterised question would change: numbers (a token that starts with a digit 0-9), units (a unit's
name after a number) and names (a capitalised token inside a sentence). Windows of five canonical
tokens of the benchmark are hash-joined with those of every whole document. A document is
contaminated by an item when windows covering at least 0.8 of the item's stand in it on alignments
whose slots are consistent: there, every value that the item puts into a slot is replaced by one and
the same value wherever it recurs.

Windows with fewer than two literal tokens say nothing about an item and are left out. Two kinds of items
need more. An item without any telling window (one of fewer than five tokens, of numbers or of names
alone) is looked for word for word, in windows of its own length up to five tokens. And a capital that
starts a sentence is no name by itself, but in an item that has such a word capitalised twice it may be:
these items are matched a second time, with every capitalised token a name on both sides. Both searches
run only if the benchmark has such items; the template match comes first where several find an item.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm.common import stored, table

WINDOW, LITERALS = 5, 2
#: Covered share of an item's windows, in tenths.
COVER_TENTHS = 8
#: Benchmark windows up to this number (about 100 bytes each) go to every task; more are joined by
#: a shuffle.
BROADCAST_WINDOWS = 500_000
#: Marks of the slots; letters, so that stripping punctuation keeps them.
NUMBER, NAME, UNIT = "ǀ", "ǁ", "ǂ"
# Unit names recognised after a number.
UNITS = ["mm", "cm", "m", "km", "in", "ft", "mi", "mile", "miles", "meter", "meters", "metre",
         "metres", "kilometer", "kilometers", "mg", "g", "kg", "gram", "grams", "kilogram",
         "kilograms", "lb", "lbs", "pound", "pounds", "oz", "ml", "l", "liter", "liters", "litre",
         "litres", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours",
         "day", "days", "week", "weeks", "month", "months", "year", "years", "usd", "eur", "dollar",
         "dollars", "euro", "euros", "cent", "cents", "percent", "degrees", "mph", "kmh"]
#: What a token may carry at its ends besides letters and digits, and what parts tokens.
_EDGE = r"[^\p{L}\p{N}\s]"
_PART = r"[^\p{L}\p{N}]*\s[^\p{L}\p{N}]*"


def marked(text: str = "text", initials: bool = False) -> Column:
    """The text in lower case with a mark before each slot's value; with ``initials`` also before
    capitalised tokens that start a sentence. Marks are set in the text as a whole: a few passes of the
    regular expression engine cost less than several calls per token, and the two passes about numbers
    run only on texts that have a digit."""
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    t = F.concat(F.lit(" "), F.coalesce(F.col(text), F.lit("")), F.lit(" "))
    digits = F.regexp_replace(t, rf"(?<=[0-9])(\s+){_EDGE}*(?=(?i:{units}){_EDGE}*(?:\s|$))",
                              f"$1{UNIT}")
    t = F.when(t.rlike("[0-9]"), F.regexp_replace(digits, rf"(?<!\S){_EDGE}*(?=[0-9])", NUMBER)
               ).otherwise(t)
    after = "" if initials else r"(?<=[\p{L}\p{N},;])"
    names = F.regexp_replace(t, rf"{after}(\s+){_EDGE}*(?=\p{{Lu}})", f"$1{NAME}")
    return F.lower(names)


def _split(text: Column) -> Column:
    return F.filter(F.split(text, _PART), lambda x: x != "")


def with_tokens(df: DataFrame, text: str = "text", initials: bool = False) -> DataFrame:
    """``df`` without its text and with ``tokens``; a slot keeps its value behind the mark."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, _split(marked(text, initials)).alias("tokens"))


def with_canonical(df: DataFrame, text: str = "text", initials: bool = False) -> DataFrame:
    """``df`` without its text and with ``h``: the hashes of its canonical tokens, slots as their
    marks alone."""
    rest = [c for c in df.columns if c != text]
    bare = F.regexp_replace(marked(text, initials), f"([{NUMBER}{NAME}{UNIT}])\\S*", "$1")
    return df.select(*rest, F.transform(_split(bare), lambda t: F.xxhash64(t)).alias("h"))


def _is_slot(token: Column) -> Column:
    return F.substring(token, 1, 1).isin(NUMBER, NAME, UNIT)


def _both(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def with_windows(df: DataFrame) -> DataFrame:
    """Replace ``h`` by ``windows``: the hash of every five canonical tokens in a row. Each step is
    a projection of its own, so that no array is computed twice."""
    rest = [c for c in df.columns if c != "h"]
    pair = df.select(*rest, "h", F.zip_with("h", _from("h", 1), _both).alias("h2"))
    four = pair.select(*rest, "h", F.zip_with("h2", _from("h2", 2), _both).alias("h4"))
    return four.select(*rest, F.slice(F.zip_with("h4", _from("h", 4), _both), 1, F.greatest(
        F.size("h") - (WINDOW - 1), F.lit(0))).alias("windows"))


def _from(c: str, k: int) -> Column:
    return F.slice(c, k + 1, F.size(c))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, item, text): rows of one item_id with different texts are items of their own
    (``item``)."""
    return (benchmark.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
            .distinct().withColumn("item", F.xxhash64("text")))


def benchmark_windows(items: DataFrame, initials: bool = False) -> DataFrame:
    """(key, item_id, item, ipos, values, n_windows): one row per telling window of an item."""
    both = with_windows(with_canonical(
        with_tokens(items.withColumn("own", F.col("text")), initials=initials)
        .withColumnRenamed("tokens", "all"), "own", initials))
    rows = (both.select("item_id", "item", "all",
                        F.posexplode_outer("windows").alias("ipos", "key"))
            .filter("key IS NOT NULL"))
    rows = rows.select("item_id", "item", "ipos", "key",
                       F.slice("all", F.col("ipos") + 1, WINDOW).alias("values"))
    telling = rows.filter(F.size(F.filter("values", lambda t: ~_is_slot(t))) >= LITERALS)
    n = telling.groupBy("item_id", "item").agg(F.count("*").alias("n_windows"))
    return telling.join(n, ["item_id", "item"])


def items_with_initial_names(items: DataFrame) -> DataFrame:
    """The items in which a capitalised token that starts a sentence stands capitalised elsewhere,
    too."""
    both = with_tokens(with_tokens(items.withColumn("own", F.col("text")))
                       .withColumnRenamed("tokens", "plain"), "own", initials=True)
    named = F.zip_with("plain", "tokens", lambda a, b: F.when(a != b, b))
    twice = F.exists("starts", lambda x: F.size(F.filter("tokens", lambda y: y == x)) >= 2)
    return (both.withColumn("starts", F.filter(named, lambda x: x.isNotNull())).filter(twice)
            .select("item_id", "item").join(items, ["item_id", "item"]))


def _verbatim(text: Column) -> Column:
    """The tokens of a text in lower case, slots or not."""
    return _split(F.lower(F.concat(F.lit(" "), text, F.lit(" "))))


def _runs(tokens: Column, size: int) -> Column:
    """Hashes of every ``size`` tokens in a row."""
    return F.transform(F.sequence(F.lit(1), F.size(tokens) - (size - 1)),
                       lambda i: F.xxhash64(F.array_join(F.slice(tokens, i, size), " ")))


def _verbatim_windows(rows: DataFrame, owner: list[str], sizes: list[int], at: str) -> DataFrame:
    """(owner, size, at, key): windows of ``sizes`` tokens of the rows' texts, word for word."""
    tokens = rows.select(*owner, _verbatim(F.col("text")).alias("t"))
    each = [tokens.filter(F.size("t") >= n).select(
        *owner, F.lit(n).alias("size"), F.posexplode(_runs(F.col("t"), n)).alias(at, "key"))
        for n in sizes]
    return functools.reduce(DataFrame.unionByName, each)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per (doc_id, item_id) found: n_windows, n_matched, coverage, reparameterised.

    Null and empty texts match nothing; a null doc_id is reported as null; rows that repeat doc_id
    and text are reported once; several rows of one doc_id with different texts, or of one item_id,
    are matched apart; other columns are ignored; empty tables give no rows.
    """
    found = matches(docs, benchmark)
    return found.select("doc_id", "item_id", "n_windows", "n_matched", "coverage",
                        "reparameterised")


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``contaminated`` with the key (i, k) of the document row."""
    keyed, items = _keyed(docs), stored(benchmark_items(benchmark), "benchmark-items")
    windows = stored(benchmark_windows(items), "benchmark-windows")
    found = [_template_matches(keyed, windows)]
    silent = items.join(windows.select("item_id", "item"), ["item_id", "item"], "left_anti")
    sizes = [x[0] for x in silent.select(F.least(F.size(_verbatim(F.col("text"))), F.lit(WINDOW)))
             .distinct().collect() if x[0]]                       # at most five numbers
    if sizes:
        found.append(_verbatim_matches(keyed, silent, sorted(sizes)))
    named = stored(benchmark_windows(items_with_initial_names(items), True), "benchmark-windows")
    if not named.isEmpty():
        found.append(_template_matches(keyed, named, True))
    owner = ["i", "k", "item_id", "item"]
    ranked = [f.select(*owner, F.struct(F.lit(j).alias("by"), "n_windows", "n_matched",
                                        "reparameterised").alias("m")) for j, f in enumerate(found)]
    best = (functools.reduce(DataFrame.unionByName, ranked).groupBy(*owner)
            .agg(F.min("m").alias("m")).select(*owner, "m.*").drop("by"))
    return (best.withColumn("coverage", F.col("n_matched") / F.col("n_windows"))
            .withColumn("doc_id", F.when(F.col("i") != F.lit(-(1 << 63)), F.col("i"))))


def _lookup(windows: DataFrame) -> DataFrame:
    return F.broadcast(windows) if windows.count() <= BROADCAST_WINDOWS else windows


def _enough() -> Column:
    return F.col("n_matched") * 10 >= F.col("n_windows") * COVER_TENTHS


def _verbatim_matches(keyed: DataFrame, items: DataFrame, sizes: list[int]) -> DataFrame:
    """Items that stand word for word in a document: windows of ``min(5, length)`` tokens cover 0.8
    of the item's."""
    length = F.least(F.size(_verbatim(F.col("text"))), F.lit(WINDOW))
    own = _verbatim_windows(items, ["item_id", "item", "text"], sizes, "ipos").filter(
        F.col("size") == length).drop("text")
    n = own.groupBy("item_id", "item").agg(F.count("*").alias("n_windows"))
    own = stored(own.join(n, ["item_id", "item"]), "benchmark-verbatim")
    every = _verbatim_windows(keyed, ["i", "k"], sizes, "pos")
    return (every.join(_lookup(own), ["size", "key"])
            .select("i", "k", "item_id", "item", "n_windows", "ipos").distinct()
            .groupBy("i", "k", "item_id", "item", "n_windows")
            .agg(F.count("*").alias("n_matched")).filter(_enough())
            .withColumn("reparameterised", F.lit(False)))


def _template_matches(keyed: DataFrame, windows: DataFrame, initials: bool = False) -> DataFrame:
    lookup = _lookup(windows.select("key", "item_id", "item", "ipos", "n_windows"))
    # An inner explode would make Spark add a filter on the size of the windows, and compute every
    # array above once more for it; the outer form with a filter behind has the same rows.
    every = (with_windows(with_canonical(keyed, initials=initials))
             .select("i", "k", F.posexplode_outer("windows").alias("pos", "key"))
             .filter("key IS NOT NULL"))
    hits = stored(every.join(lookup, "key").select("i", "k", "item_id", "item", "n_windows", "pos",
                                                   "ipos"), "benchmark-hits").distinct()
    owner = ["i", "k", "item_id", "item", "n_windows"]
    likely = (hits.select(*owner, "ipos").distinct().groupBy(*owner)
              .agg(F.count("*").alias("n_matched")).filter(_enough()).drop("n_matched"))
    likely = stored(likely, "benchmark-likely")
    # Few documents remain; their tokens are made again to compare what stands in the slots.
    texts = with_tokens(keyed.join(likely.select("i", "k").distinct(), ["i", "k"], "left_semi")
                        .dropDuplicates(["i", "k"]), initials=initials)
    lines = (hits.join(likely, owner).join(texts, ["i", "k"])
             .select(*owner, "pos", "ipos", (F.col("pos") - F.col("ipos")).alias("shift"),
                     F.slice("tokens", F.col("pos") + 1, WINDOW).alias("seen"))
             .join(windows.select("item_id", "item", "ipos", "values"),
                   ["item_id", "item", "ipos"]))
    lines = stored(lines, "benchmark-aligned")
    slots = (lines.select(*owner, "shift", F.inline(F.arrays_zip("values", "seen")))
             .filter(_is_slot(F.col("values"))))
    per_value = slots.groupBy(*owner, "shift", "values").agg(F.min("seen").alias("lo"),
                                                            F.max("seen").alias("hi"))
    per_shift = per_value.groupBy(*owner, "shift").agg(
        F.bool_and(F.col("lo") == F.col("hi")).alias("consistent"),
        F.bool_and((F.col("lo") == F.col("values")) & (F.col("hi") == F.col("values")))
        .alias("verbatim"))
    kept = lines.join(per_shift, [*owner, "shift"], "left").filter(
        F.coalesce("consistent", F.lit(True)))
    return (kept.groupBy(*owner).agg(F.countDistinct("ipos").alias("n_matched"),
                                     (~F.bool_and(F.coalesce("verbatim", F.lit(True))))
                                     .alias("reparameterised"))
            .filter(_enough()))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("i"),
        F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("k"),
        F.coalesce("text", F.lit("")).alias("text"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go, the others keep all columns."""
    gone = matches(docs, table(spark, sf_dir, "benchmark")).select("i", "k").distinct()
    i = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    k = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    return docs.join(gone, (i == gone["i"]) & (k == gone["k"]), "left_anti")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_UNIT_LIST = ", ".join(f"'{u}'" for u in UNITS)

OP1_SQL = rf"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, coalesce(text, '') AS text FROM documents
  UNION
  SELECT 'b', item_id, text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), numbered AS (
  SELECT kind, id, row_number() OVER () AS rid,
         list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS raw
  FROM texts
), words AS (
  SELECT kind, id, rid, unnest(raw) AS x, generate_subscripts(raw, 1) AS p FROM numbered
), cores AS (
  SELECT *, regexp_replace(x, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g') AS c,
         coalesce(lag(x) OVER (PARTITION BY rid ORDER BY p), '') AS prev
  FROM words
), typed AS (
  SELECT kind, id, rid, p, variant,
         CASE WHEN variant = 'word for word' THEN ''
              WHEN regexp_matches(c, '^[0-9]') THEN '{NUMBER}'
              WHEN regexp_matches(prev, '[0-9]$') AND lower(c) IN ({_UNIT_LIST}) THEN '{UNIT}'
              WHEN regexp_matches(c, '^\p{{Lu}}') AND (variant = 'initials' OR
                   regexp_matches(prev, '[\p{{L}}\p{{N}},;]$')) THEN '{NAME}'
              ELSE '' END || lower(c) AS value
  FROM cores, (VALUES ('template'), ('initials'), ('word for word')) AS v(variant) WHERE c <> ''
), tokens AS (
  SELECT kind, id, rid, variant, row_number() OVER (PARTITION BY rid, variant ORDER BY p) - 1 AS pos,
         value, CAST(substr(value, 1, 1) IN ('{NUMBER}', '{NAME}', '{UNIT}') AS INTEGER) AS slots,
         CASE WHEN slots = 1 THEN substr(value, 1, 1) ELSE value END AS canon
  FROM typed
), initial_names AS (
  SELECT DISTINCT b.rid
  FROM tokens b JOIN tokens a ON a.rid = b.rid AND a.pos = b.pos AND a.variant = 'template'
       AND b.variant = 'initials' AND a.value <> b.value
  WHERE (SELECT count(*) FROM tokens o WHERE o.rid = b.rid AND o.variant = 'initials'
                                       AND o.value = b.value) >= 2 AND b.kind = 'b'
), windows AS (
  SELECT kind, id, rid, variant, pos,
         lead(pos, 4) OVER w AS last_pos,
         canon || ' ' || lead(canon, 1) OVER w || ' ' || lead(canon, 2) OVER w || ' '
           || lead(canon, 3) OVER w || ' ' || lead(canon, 4) OVER w AS key,
         [value, lead(value, 1) OVER w, lead(value, 2) OVER w, lead(value, 3) OVER w,
          lead(value, 4) OVER w] AS vals,
         5 - slots - (lead(slots, 1) OVER w) - (lead(slots, 2) OVER w) - (lead(slots, 3) OVER w)
           - (lead(slots, 4) OVER w) AS literals
  FROM tokens WHERE variant <> 'word for word'
  WINDOW w AS (PARTITION BY rid, variant ORDER BY pos)
), bench AS (
  SELECT *, count(*) OVER (PARTITION BY rid, variant) AS n_windows
  FROM windows WHERE kind = 'b' AND last_pos IS NOT NULL AND literals >= {LITERALS}
    AND (variant = 'template' OR rid IN (SELECT rid FROM initial_names))
), hits AS (
  SELECT d.id AS doc_id, d.rid AS drid, b.id AS item_id, b.rid AS brid, b.variant, b.n_windows,
         d.pos, b.pos AS ipos, d.pos - b.pos AS shift, b.vals AS want, d.vals AS seen
  FROM windows d JOIN bench b USING (key, variant)
  WHERE d.kind = 'd' AND d.last_pos IS NOT NULL
), pairs AS (
  SELECT drid, brid, variant, shift, unnest(want) AS want, unnest(seen) AS seen FROM hits
), per_value AS (
  SELECT drid, brid, variant, shift, want, min(seen) AS lo, max(seen) AS hi FROM pairs
  WHERE substr(want, 1, 1) IN ('{NUMBER}', '{NAME}', '{UNIT}') GROUP BY ALL
), per_shift AS (
  SELECT drid, brid, variant, shift, bool_and(lo = hi) AS consistent,
         bool_and(lo = want AND hi = want) AS verbatim
  FROM per_value GROUP BY ALL
), by_template AS (
  SELECT doc_id, drid, item_id, brid, CASE variant WHEN 'template' THEN 0 ELSE 2 END AS turn,
         n_windows, count(DISTINCT ipos) AS n_matched,
         NOT bool_and(coalesce(verbatim, true)) AS reparameterised
  FROM hits LEFT JOIN per_shift USING (drid, brid, variant, shift)
  WHERE coalesce(consistent, true)
  GROUP BY doc_id, drid, item_id, brid, variant, n_windows
), whole AS (
  SELECT kind, id, rid, list(value ORDER BY pos) AS toks FROM tokens
  WHERE variant = 'word for word' GROUP BY kind, id, rid
), silent AS (
  SELECT id AS item_id, rid AS brid, toks, least(len(toks), 5) AS size,
         unnest(generate_series(1, len(toks) - least(len(toks), 5) + 1)) AS ipos
  FROM whole WHERE kind = 'b' AND rid NOT IN (SELECT rid FROM bench WHERE variant = 'template')
), silent_keys AS (
  SELECT item_id, brid, size, ipos, array_to_string(toks[ipos:ipos + size - 1], ' ') AS key,
         count(*) OVER (PARTITION BY brid) AS n_windows FROM silent
), places AS (
  SELECT id AS doc_id, rid AS drid, toks, size, unnest(generate_series(1, len(toks) - size + 1)) AS pos
  FROM whole, (SELECT DISTINCT size FROM silent) WHERE kind = 'd' AND len(toks) >= size
), word_for_word AS (
  SELECT doc_id, drid, item_id, brid, 1 AS turn, n_windows, count(DISTINCT ipos) AS n_matched,
         false AS reparameterised
  FROM (SELECT *, array_to_string(toks[pos:pos + size - 1], ' ') AS key FROM places)
       JOIN silent_keys USING (size, key)
  GROUP BY doc_id, drid, item_id, brid, n_windows
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY drid, brid ORDER BY turn) AS place
  FROM (SELECT * FROM by_template UNION ALL SELECT * FROM word_for_word)
  WHERE n_matched * 10 >= n_windows * {COVER_TENTHS}
)
SELECT doc_id, item_id, n_windows, n_matched, n_matched / n_windows AS coverage, reparameterised
FROM ranked WHERE place = 1
"""
