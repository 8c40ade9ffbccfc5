"""Quality rules by host: rule failures, shrunk host rates, verdicts joined back.

Every document is measured in Python over whole Arrow batches (words are what
``bytes.split()`` gives, so exactly the words between ASCII white space), failures
are summed per host before any shuffle, each host's failure rate is shrunk by a
beta prior fitted to all hosts, and the few hosts with a bad verdict are joined
back. A document of a bad host must pass stricter rules than one of another host:
the verdict never rejects a document that has nothing wrong with it.

Defined results: a null or empty text has no words and fails the word-count rule; a
null host is no host (no verdict, the rules alone decide); repeated rows and
repeated ids are judged each; an empty table gives an empty result; other columns
are not read (``keep_documents`` carries them through untouched).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import freed, rejoined, slices, table, texts_of, without_text, written

MIN_WORDS = 50
REPEAT_PERCENT = 50

#: A host is bad if its shrunk failure rate is at least this share.
BAD_RATE = 0.5
#: Stricter limits for documents of a bad host: per hundred word characters, per hundred words.
STRICT_SYMBOL_PERCENT = 5
STRICT_REPEAT_PERCENT = 20

FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = b"#*$%&|<>"
#: Bytes of a character but its first; a text needn't be valid UTF-8.
CONTINUED = re.compile(rb"[\x80-\xbf]")


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words that stand in a window of ``size`` words found twice or more in the list."""
    import numpy as np
    n = len(words) - size + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    window = code[:n]
    for k in range(1, size):  # ranks stay below n, so a product fits 64 bits
        window = window * len(ids) + code[k:k + n]
        window, counts = np.unique(window, return_inverse=True, return_counts=True)[1:]
    twice = (counts > 1)[window]
    if not twice.any():
        return 0
    covered = np.zeros(len(words), bool)
    for k in range(size):
        covered[k:k + n] |= twice
    return int(covered.sum())


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()
    joined = b"".join(words)
    chars = len(joined) - len(CONTINUED.findall(joined)) if not joined.isascii() else len(joined)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen, duplicates = set(), 0
    if b"\n" in text:
        for line in text.split(b"\n"):
            if line in seen:
                duplicates += 1
            elif line and not line.isspace():
                seen.add(line)
    return len(words), chars, symbols, duplicates, repeated_words(words)


def _measure(batches):
    import pyarrow as pa
    for batch in batches:
        for piece in slices(batch):
            rows = [measures(t) for t in texts_of(piece)]
            columns = list(zip(*rows)) or [()] * len(FIELDS)
            yield pa.RecordBatch.from_arrays([*piece.columns, *[pa.array(c, pa.int64()) for c in columns]],
                                             piece.schema.names + FIELDS)


def measure(docs: DataFrame, carry: Column, text_col: str = "text") -> DataFrame:
    """(carried, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words); the text as bytes."""
    df = docs.select(carry.alias("carried"), F.col(text_col).cast("string").cast("binary").alias("text"))
    kind = df.schema["carried"].dataType.simpleString()
    return df.mapInArrow(freed(_measure), f"carried {kind}, text binary, " + ", ".join(f"{f} long" for f in FIELDS))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def strict_failed() -> Column:
    return ((100 * F.col("n_symbols") > STRICT_SYMBOL_PERCENT * F.col("word_chars"))
            | (100 * F.col("n_repeat_words") > STRICT_REPEAT_PERCENT * F.col("n_words"))
            | (F.col("n_dup_lines") > 0))


def host_verdicts(measured: DataFrame, host: Column) -> DataFrame:
    """(host, docs, failed, shrunk_rate, bad) of every host.

    The prior Beta(a, b) is fitted by the method of moments to the rates of all hosts
    (mean m over documents; spread over hosts beyond what binomial noise explains):
    a + b = m (1 - m) / variance - 1, held between 1 and 1,000. A host of few documents
    is pulled to the mean; one of many keeps its own rate. All sums are integers or are
    rounded, so partitioning doesn't move a verdict.
    """
    per_host = (measured.select(host.alias("host"), (base_failed() | strict_failed()).cast("long").alias("f"))
                .where(F.col("host").isNotNull())
                .groupBy("host").agg(F.count(F.lit(1)).alias("docs"), F.sum("f").alias("failed")))
    per_host = written(per_host, "op9-hosts")  # every text is measured once for this, whatever is asked of it
    moments = per_host.agg(
        F.count(F.lit(1)).alias("hosts"), F.sum("docs").alias("n"), F.sum("failed").alias("k"),
        F.sum(F.pow(F.col("failed"), F.lit(2.0)) / F.col("docs")).alias("s2")).first()
    hosts, n, k = moments["hosts"] or 0, moments["n"] or 0, moments["k"] or 0
    m = k / n if n else 0.0
    strength = prior_strength(hosts, n, k, moments["s2"] or 0.0)
    rate = F.round((F.col("failed") + F.lit(m * strength)) / (F.col("docs") + F.lit(strength)), 9)
    return per_host.withColumn("shrunk_rate", rate).withColumn("bad", rate >= BAD_RATE)


def prior_strength(hosts: int, n: int, k: int, s2: float) -> float:
    """a + b of the prior, from the documents n, failures k and sum of failed^2 / docs by host."""
    m = k / n if n else 0.0
    if hosts < 2 or m in (0.0, 1.0):
        return 1000.0
    weighted = s2 / n - m * m  # variance of host rates, weighted by documents
    noise = m * (1 - m) * hosts / n
    spread = weighted - noise
    if spread <= 1e-12:
        return 1000.0
    return round(min(1000.0, max(1.0, m * (1 - m) / spread - 1)), 9)


def judge(measured: DataFrame, host: Column) -> DataFrame:
    """``measured`` with base_failed, bad_host and kept."""
    # Only bad hosts are joined. They are written first, so the planner knows how many they are: few
    # are broadcast and no document is shuffled; otherwise it splits a host with many documents.
    bad = written(host_verdicts(measured, host).where("bad").select(F.col("host").alias("_bad_host")), "op9-bad")
    out = measured.join(bad, host == F.col("_bad_host"), "left")
    return (out.withColumn("base_failed", base_failed())
            .withColumn("bad_host", F.col("_bad_host").isNotNull()).drop("_bad_host")
            .withColumn("kept", ~F.col("base_failed") & ~(F.col("bad_host") & strict_failed())))


def keep_documents(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were."""
    measured = measure(docs, without_text(docs))
    return rejoined(docs, judge(measured, F.col("carried")[host_col]).where("kept"))


SQL = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
tri AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS t
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
twice AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS c FROM tri),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE c > 1) GROUP BY doc_id),
lines AS (
  SELECT doc_id, l FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM w)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dups AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY doc_id),
m AS (
  SELECT w.doc_id, w.source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id)),
j AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
         (100 * n_symbols > 5 * word_chars OR 100 * n_repeat_words > 20 * n_words
          OR n_dup_lines > 0) AS strict_failed
  FROM m),
h AS (
  SELECT source, count(*) AS docs, sum(CASE WHEN base_failed OR strict_failed THEN 1 ELSE 0 END) AS failed
  FROM j WHERE source IS NOT NULL GROUP BY source),
s AS (
  SELECT count(*) AS hosts, sum(docs) AS n, sum(failed) AS k,
         sum(CAST(failed AS DOUBLE) * failed / docs) AS s2 FROM h),
v AS (
  SELECT n, k / n AS rate, s2 / n - (k / n) * (k / n) - (k / n) * (1 - k / n) * hosts / n AS spread, hosts
  FROM s),
p AS (
  SELECT rate, CASE WHEN hosts < 2 OR rate IN (0, 1) OR spread <= 1e-12 THEN 1000.0
                    ELSE round(least(1000.0, greatest(1.0, rate * (1 - rate) / spread - 1)), 9) END AS strength
  FROM v),
bad AS (
  SELECT source FROM h, p WHERE round((failed + rate * strength) / (docs + strength), 9) >= 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       bad.source IS NOT NULL AS bad_host,
       NOT base_failed AND NOT (bad.source IS NOT NULL AND strict_failed) AS kept
FROM j LEFT JOIN bad ON bad.source = j.source
"""


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    measured = written(measure(docs, F.struct("doc_id", "source")).drop("text"), "op9-measured")
    return judge(measured, F.col("carried.source")).select(
        F.col("carried.doc_id").alias("doc_id"), *FIELDS, "base_failed", "bad_host", "kept")
