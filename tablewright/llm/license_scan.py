"""License scan: a positional index of rare licence words, in DataFrame functions only.

Templates are short licence texts with mandatory key phrases; the base phrases are
templates that are key phrases themselves. The documents are scanned once for the
document frequency of the template words (a table of at most as many rows as the
templates have words) and a second time as follows, each file within its own row:

1. the index holds, for every template, its ``RARE`` highest-IDF words with their
   positions; a file's words are looked up in it;
2. a file position minus a template position is a place where the template may
   start; postings are intersected on (template, place): only a place that all of the
   template's index words name goes on, so one rare word alone leads to no verification;
3. each place is verified: the key phrase must stand there word for word, and the
   IDF-weighted share of template words at their relative positions is the score.

Every base phrase contains its own rarest word, so every place of it is found.
Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.

Defined results: null or empty text has no words, null places, empty labels, score 0;
repeated rows and ids are judged each; an empty table gives an empty result; other
columns are not read. Nothing is shuffled but the few word counts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, table

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str          # the mandatory phrase, part of ``text``
    base: bool = False


#: The three base phrases, then the labels of this method.
TEMPLATES = [
    Template("cc-by", "cc by", "cc by", True),
    Template("gpl", "general public license", "general public license", True),
    Template("reserved", "all rights reserved", "all rights reserved", True),
    Template("mit", "released under the mit license", "mit license"),
    Template("apache", "licensed under the apache license version", "apache license"),
    Template("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    Template("gnu", "this work is licensed under the gnu general public license version",
             "gnu general public license"),
]

#: Rarest words of a template that the index holds.
RARE = 2
#: Least IDF-weighted share of template words at a verified place for a label of the method.
SHARE = 0.4


def words_of(text: str) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(WORDS, low)


def word_counts(words: DataFrame, templates: list[Template]) -> tuple[int, dict[str, int]]:
    """Documents, and for each template word the documents that hold it. ``words`` has the
    array column ``words``. At most one row per template word reaches the driver."""
    vocabulary = sorted({w for t in templates for w in words_of(t.text)})
    held = F.array_intersect("words", F.array(*[F.lit(w) for w in vocabulary]))
    # The empty word stands for the document itself, so one count has all documents.
    rows = (words.select(F.explode(F.concat(F.array(F.lit("")), held)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect())
    counts = {r["word"]: r["n"] for r in rows}
    return counts.get("", 0), {w: counts.get(w, 0) for w in vocabulary}


def weights_of(n: int, df: dict[str, int]) -> dict[str, int]:
    """IDF in thousandths, at least 1: integers, so sums don't depend on their order."""
    import math
    return {w: max(1, round(1000 * math.log((n + 1) / (c + 1)))) for w, c in df.items()}


def index_of(templates: list[Template], weights: dict[str, int]) -> dict[str, list[tuple[int, int]]]:
    """word -> [(template, position)] for each template's highest-IDF words of its key phrase
    (ties: the earlier position)."""
    index: dict[str, list[tuple[int, int]]] = {}
    for t, template in enumerate(templates):
        text, key = words_of(template.text), words_of(template.key)
        at = next(i for i in range(len(text)) if text[i:i + len(key)] == key)
        ranked = sorted(range(at, at + len(key)), key=lambda i: (-weights[text[i]], i))
        for i in ranked[:1 if template.base else RARE]:
            index.setdefault(text[i], []).append((t, i))
    return index


def candidates(words: DataFrame, index: dict[str, list[tuple[int, int]]], n: int) -> DataFrame:
    """``words`` plus ``places``: the (t, s) at which all index words of template ``t`` of ``n`` stand
    as they do in the template when it starts at word ``s``; each place once, in order.

    Every index word of the key phrase stands where the phrase does, so no place is lost."""
    # 1. occurrences of index words: (word, position in the file)
    vocabulary = sorted(index)
    hits = words.withColumn("hits", F.filter(
        F.transform("words", lambda w, i: F.when(w.isin(vocabulary), F.struct(w.alias("w"), i.alias("i")))),
        lambda h: h.isNotNull()))

    # 2. their postings as places, those of all words of a file in one sorted list
    def postings(h):
        return F.coalesce(*[F.when(h["w"] == w, F.array(*[
            F.struct(F.lit(t).alias("t"), (h["i"] - p).alias("s")) for t, p in index[w]])) for w in vocabulary])

    named = hits.withColumn("places", F.sort_array(F.flatten(F.transform("hits", postings)))).drop("hits")

    # A word of the index names a place once, so as many equal entries as the template has words there
    # mean that all of them do.
    needed = [sum(t == u for found in index.values() for u, _ in found) for t in range(n)]
    needed = F.array(*[F.lit(k) for k in needed])
    return named.withColumn("places", F.filter("places", lambda x, i: F.get(
        F.col("places"), i + F.get(needed, x["t"]) - 1).eqNullSafe(x)))


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row."""
    low = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    words = docs.select(F.col(id_col).alias(id_col),
                        F.regexp_extract_all(low, F.lit(WORDS), F.lit(0)).alias("words"))
    weights = weights_of(*word_counts(words, templates))
    places = candidates(words, index_of(templates, weights), len(templates))

    # 3. verification at each place
    def at(start, offset):
        """The file's word at a place of the template, null outside of the file."""
        return F.get(F.col("words"), start + offset)

    def verified(place):
        out = F.lit(None).cast("struct<t:int,s:int,share:int>")
        for t, template in reversed(list(enumerate(templates))):
            text, key = words_of(template.text), words_of(template.key)
            first = next(i for i in range(len(text)) if text[i:i + len(key)] == key)
            holds = F.lit(True)
            for k, w in enumerate(key):
                holds = holds & F.coalesce(at(place["s"], first + k) == w, F.lit(False))
            total = sum(weights[w] for w in text)
            share = F.lit(0)
            for k, w in enumerate(text):
                share = share + F.when(at(place["s"], k) == w, weights[w]).otherwise(0)
            share = F.floor(share.cast("long") * 1_000_000 / total).cast("int")
            out = F.when((place["t"] == t) & holds, F.struct(
                F.lit(t).alias("t"), place["s"].alias("s"), share.alias("share"))).when(
                place["t"] != t, out)
        return out

    found = places.select(id_col, F.size("words").cast("long").alias("n_words"), F.filter(
        F.transform("places", verified), lambda p: p.isNotNull()).alias("found"))
    base_ids = [t for t, x in enumerate(templates) if x.base]

    def labels(col):
        label = F.element_at(F.array(*[F.lit(x.label) for x in templates]), col["t"] + 1)
        return label

    base = F.filter("found", lambda p: p["t"].isin(base_ids))
    good = F.filter("found", lambda p: p["t"].isin(base_ids) | (p["share"] >= int(SHARE * 1_000_000)))
    starts = F.transform(base, lambda p: p["s"].cast("long"))
    return found.select(
        id_col, "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(base, labels))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(good, labels))), ",").alias("labels"),
        (F.coalesce(F.array_max(F.transform(good, lambda p: p["share"])), F.lit(0)) / F.lit(1e6)).alias("score"))


def _sql() -> str:
    rows, keys = [], []
    for t, template in enumerate(TEMPLATES):
        text, key = words_of(template.text), words_of(template.key)
        first = next(i for i in range(len(text)) if text[i:i + len(key)] == key)
        rows += [f"({t}, {i}, '{w}')" for i, w in enumerate(text)]
        keys.append(f"({t}, '{template.label}', {template.base}, {first}, {len(key)}, '{' '.join(key)}')")
    return r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
tw(t, i, w) AS (VALUES ROWS),
tk(t, label, base, first, len, phrase) AS (VALUES KEYS),
n AS (SELECT count(*) AS n FROM d),
occ AS (
  SELECT doc_id, w, p FROM (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM d)
  WHERE w IN (SELECT w FROM tw)),
df AS (
  SELECT v.w, count(DISTINCT doc_id) AS c FROM (SELECT DISTINCT w FROM tw) v LEFT JOIN occ USING (w) GROUP BY v.w),
wt AS (
  SELECT w, greatest(1, CAST(round(1000 * ln((n.n + 1) / (c + 1))) AS BIGINT)) AS weight FROM df, n),
total AS (SELECT t, sum(weight) AS total FROM tw JOIN wt USING (w) GROUP BY t),
starts AS (
  SELECT DISTINCT occ.doc_id, tk.t, occ.p - tk.first AS s
  FROM occ JOIN tk ON occ.w = string_split(tk.phrase, ' ')[1]),
whole AS (
  SELECT starts.*, tk.label, tk.base FROM starts JOIN tk USING (t) JOIN d USING (doc_id)
  WHERE array_to_string(list_slice(ws, s + tk.first + 1, s + tk.first + tk.len), ' ') = tk.phrase),
shares AS (
  SELECT whole.doc_id, whole.t, whole.s, any_value(label) AS label, bool_or(base) AS base,
         floor(sum(CASE WHEN occ.w IS NOT NULL THEN weight ELSE 0 END) * 1000000 / any_value(total)) AS share
  FROM whole JOIN tw ON tw.t = whole.t JOIN wt ON wt.w = tw.w JOIN total ON total.t = whole.t
  LEFT JOIN occ ON occ.doc_id = whole.doc_id AND occ.p = whole.s + tw.i AND occ.w = tw.w
  GROUP BY whole.doc_id, whole.t, whole.s),
good AS (SELECT * FROM shares WHERE base OR share >= LEAST_SHARE),
g AS (
  SELECT doc_id, count(*) FILTER (WHERE base) AS n_base,
         min(s) FILTER (WHERE base) AS first_word, max(s) FILTER (WHERE base) AS last_word,
         coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE base))), ','), '') AS base_labels,
         array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(share) / 1e6 AS score
  FROM good GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN g USING (doc_id)
""".replace("ROWS", ", ".join(rows)).replace("KEYS", ", ".join(keys)).replace(
        "LEAST_SHARE", str(int(SHARE * 1_000_000)))


SQL = _sql()


def query(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
