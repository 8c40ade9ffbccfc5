"""URL filter: host-suffix / path-prefix expressions joined on short hash prefixes.

Each distinct (host, path) is expanded into the expressions a rule could be
written as: host suffixes at label borders times path prefixes. Only the numbers
of labels and the path lengths that occur among the rules are expanded, which
loses nothing. Expressions meet the rules by an equi-join on the first 32 bits of
their SHA-256 digest; the full digest then confirms the hit, and the longest rule
that fits decides.

Defined results: a null url, or one without ``://``, has an empty host and path and
gets the default verdict; repeated rows and repeated page ids are judged each;
an empty table gives an empty result; of rules with the same expression ``block``
wins; of fitting rules of the same length the one with the longer host wins.
Columns of the input other than id and url are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

#: Fixed rules of the registered query: (action, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

PREFIX_HEX = 8  # 32 bits


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_table(rules: DataFrame) -> DataFrame:
    """(rule, digest, prefix, host_len, labels, path_len, action), one row per expression."""
    host, path = ascii_lower(F.col("host").cast("string")), F.col("path").cast("string")
    rules = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
    return (rules.select(F.concat(host, path).alias("rule"), F.length(host).alias("host_len"),
                         F.size(F.split(host, r"\.", -1)).alias("labels"),
                         F.length(path).alias("path_len"),
                         (F.col("action") == "block").cast("int").alias("blocks"))
            .groupBy("rule", "host_len", "labels", "path_len")
            .agg(F.max("blocks").alias("blocks"))
            .withColumn("digest", F.sha2("rule", 256))
            .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)))


def expand(urls: DataFrame, labels: list[int], path_lengths: list[int]) -> DataFrame:
    """Rows (host, path, digest, prefix, host_len) of every expression of a url that has one
    of the given numbers of labels and path lengths."""
    parts = F.split("host", r"\.", -1)
    kinds = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(p).alias("p"))
                      for n in labels for p in path_lengths])
    fits = F.filter(kinds, lambda k: (k["n"] <= F.size(parts)) & (k["p"] <= F.length("path")))
    return (urls.select("host", "path", F.explode(fits).alias("k"))
            .select("host", "path", F.array_join(
                F.slice(parts, F.size(parts) - F.col("k.n") + 1, F.col("k.n")), ".").alias("suffix"),
                F.substring(F.col("path"), F.lit(1), F.col("k.p")).alias("start"))
            .select("host", "path", F.length("suffix").alias("host_len"),
                    F.sha2(F.concat("suffix", "start"), 256).alias("digest"))
            .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id",
                url_col: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``pages``.

    ``rules`` has the columns action, host, path. The planner picks the join: a short
    rule list is broadcast by its known size, a long one is shuffled.
    """
    rules = rule_table(rules)
    # Two small sets: label counts (at most 127 by the DNS) and path lengths of the rules.
    kinds = rules.agg(F.collect_set("labels").alias("n"), F.collect_set("path_len").alias("p")).first()
    host, path = host_and_path(F.col(url_col))
    pages = pages.select(F.col(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    if not kinds["n"]:
        return pages.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"),
                            F.lit(default).alias("verdict"))
    # Distinct before expanding: a url that a third of the pages share is expanded once.
    found = expand(pages.select("host", "path").distinct(), sorted(kinds["n"]), sorted(kinds["p"]))
    r = rules.select("prefix", F.col("digest").alias("rule_digest"), "rule", "blocks",
                     F.col("host_len").alias("rule_host_len"))
    best = (found.join(r, "prefix")
            .where((F.col("digest") == F.col("rule_digest"))
                   & (F.col("host_len") == F.col("rule_host_len")))
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("len"), "rule_host_len", "blocks", "rule")).alias("best")))
    return (pages.join(best, ["host", "path"], "left")
            .select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                    F.when(F.col("best.blocks") == 1, "block")
                    .when(F.col("best.blocks") == 0, "allow").otherwise(default).alias("verdict")))


SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
q AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p),
rules(action, h, s) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
hits AS (
  SELECT page_id, host, path, h || s AS rule, action,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || s) DESC) AS rn
  FROM q JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s))
SELECT q.page_id, q.host, q.path, hits.rule, coalesce(hits.action, 'allow') AS verdict
FROM q LEFT JOIN hits ON hits.page_id = q.page_id AND hits.rn = 1
"""


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table
    rules = spark.createDataFrame(RULES, "action string, host string, path string")
    return filter_urls(table(spark, sf_dir, "pages"), rules)
