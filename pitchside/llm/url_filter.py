"""URL filtering by host-suffix and path-prefix expressions, built-in functions only.

A rule ``(host, path, verdict)`` fits its host and all subdomains when the url's path starts with the
rule's. Every url is expanded into the expressions ``host suffix + path prefix`` that a rule could
have; the first 32 bits of their SHA-256 join the rules' (most urls meet no rule there), the full
digests confirm, and the longest rule decides.

Path prefixes end at ``/``, as the *anchor* of a rule does: its path up to the last ``/``. What
stands behind the anchor in the rule is compared with the url after the join, so a rule may end inside
a path segment. Expressions longer or deeper than every anchor cannot fit and are not made: a url
costs the depth of the rules, not its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm.common import table

ALLOW, BLOCK = "allow", "block"
#: Rules up to this number and total length are broadcast; more are joined by shuffle.
BROADCAST_RULES, BROADCAST_CHARS = 100_000, 16 << 20
#: Parts of every key in the shuffle join: a rule goes to each, an expression to one.
SALTS = 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The rules of the registered query (fixed values): host, path, verdict.
RULES = (("net", "/", BLOCK), ("example.net", "/en/", ALLOW),
         ("example.com", "/de/", BLOCK), ("org", "/fr/", ALLOW))


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")),
                       _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _cut(text: Column, mark: str, count: Column) -> Column:
    return F.call_function("substring_index", text, F.lit(mark), count)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def prepare_rules(rules: DataFrame) -> DataFrame:
    """``(host, path, verdict)`` rows as ``rule, host, path, verdict, anchor, digest, short``. Rows
    with a null are no rules; of rules with the same host and path a blocking one stays."""
    clean = (rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict")
             .filter("host IS NOT NULL AND path IS NOT NULL AND verdict IN ('allow', 'block')")
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    anchor = F.regexp_extract("path", r"^((?s:.*)/)", 1)
    digest = F.sha2(F.concat("host", F.lit("\n"), "anchor"), 256)
    return (clean.withColumn("anchor", anchor).withColumn("digest", digest)
            .select(F.concat("host", "path").alias("rule"), "host", "path", "verdict", "anchor",
                    "digest", _short(F.col("digest")).alias("short")))


def expressions(addresses: DataFrame, labels: int, depth: int, longest_host: int,
                longest_path: int) -> DataFrame:
    """``host, path`` rows once per expression, with its ``digest``: suffixes of at most ``labels``
    host labels and prefixes of at most ``depth`` path parts, within the given lengths."""
    hosts = F.transform(F.sequence(F.lit(1), F.least(F.lit(labels), _count(F.col("host"), ".") + 1)),
                        lambda i: _cut(F.col("host"), ".", -i))
    paths = F.transform(
        F.sequence(F.lit(0), F.least(F.lit(depth), _count(F.col("path"), "/"))),
        lambda i: F.when(i == 0, F.lit("")).otherwise(
            F.concat(_cut(F.col("path"), "/", i), F.lit("/"))))
    return (addresses
            .withColumn("_h", F.explode(F.filter(hosts, lambda h: F.length(h) <= longest_host)))
            .withColumn("_p", F.explode(F.filter(paths, lambda p: F.length(p) <= longest_path)))
            .withColumn("digest", F.sha2(F.concat("_h", F.lit("\n"), "_p"), 256))
            .drop("_h", "_p"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = ALLOW,
               broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row of ``pages`` (columns page_id and url; others
    are not read, so names cannot clash).

    The longest rule that fits decides (host and path together; then the longer host). Without one
    ``rule`` is null and the verdict is ``default``: a url that is on no list is allowed. A null url,
    or one without ``://``, has an empty host and path. Repeated rows each get their row; an empty
    page table gives no rows, an empty rule table the default everywhere.

    Each distinct address is judged once: expressions of distinct addresses meet the rules, and the
    verdicts of those that met one are joined back (a frequent address is a few rows on the small
    side, and adaptive execution splits it on the other)."""
    pages = pages.select("page_id", url_host(F.col("url")).alias("host"),
                         url_path(F.col("url")).alias("path"))
    ready = prepare_rules(rules)
    size = ready.agg(
        F.count("*").alias("n"), F.max(_count(F.col("host"), ".") + 1).alias("labels"),
        F.max(_count(F.col("anchor"), "/")).alias("depth"),
        F.max(F.length("host")).alias("host"), F.max(F.length("anchor")).alias("path"),
        F.sum(F.length("rule") * 2 + F.length("anchor")).alias("chars")).first()
    if not size["n"]:
        return pages.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
                            F.lit(default).alias("verdict"))
    found = expressions(pages.select("host", "path").distinct(), size["labels"], size["depth"],
                        size["host"], size["path"])
    found = found.select("host", "path", "digest", _short(F.col("digest")).alias("short"))
    keys = ready.select("short", F.col("digest").alias("full"), "rule", "verdict",
                        F.col("host").alias("rule_host"),
                        F.col("path").alias("rule_path"), F.length("rule").alias("chars"))
    if size["n"] <= broadcast_rules and size["chars"] <= BROADCAST_CHARS:
        met = found.join(F.broadcast(keys), "short")
    else:
        salted = found.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)))
        copies = keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = salted.join(copies.withColumn("salt", F.col("salt").cast("long")), ["short", "salt"])
    hits = met.filter((F.col("digest") == F.col("full"))
                      & F.col("path").startswith(F.col("rule_path"))
                      & F.concat(F.lit("."), "host").endswith(F.concat(F.lit("."), "rule_host")))
    best = hits.groupBy("host", "path").agg(
        F.max(F.struct("chars", F.length("rule_host").alias("host_chars"), "rule", "verdict"))
        .alias("best"))
    return (pages.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


_SQL_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
#: Compares every address with every rule as text; no expressions, hashes or joins on them.
OP11_SQL = f"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES {_SQL_RULES}),
cut AS (
  SELECT row_number() OVER () AS n, page_id,
         CASE WHEN position('://' IN coalesce(url, '')) > 0
              THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
fits AS (
  SELECT n, r_host || r_path AS rule, r_verdict,
         row_number() OVER (PARTITION BY n ORDER BY length(r_host || r_path) DESC,
                            length(r_host) DESC) AS place
  FROM parts JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host))
                       AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (n)
"""
