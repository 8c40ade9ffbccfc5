"""Substring dedup by seed and extend: repeated passages of at least ``WINDOW`` words.

1. *Seeds.* Every text is winnowed: of the ``SEED`` words starting at each place of a window, the
   ones with the least hash (the last of equals) are its anchor, so equal windows hold the same anchor
   at the same place, whatever surrounds them. An anchor stands for the run of consecutive windows that
   chose it; its *reach* is the words of that run.
2. *Join on anchors.* Anchors of all documents meet by their hash. Within an anchor, occurrences
   whose whole reach is equal, to both sides, are one class: all windows of a class's later members
   start earlier in its first one. A task settles what repeats in its own texts at once, so an anchor or
   a class sends one row a task, however often it occurs.
3. *Extension.* Where several classes share an anchor, their first members agree on a part of the reach
   only. Their texts are fetched and compared at every window of the reach, left and right of the anchor;
   the first document of each window is kept, again after each task has settled its own.
4. Runs of repeated windows are joined into maximal repeats, whose words are removed.

Windows are compared by 64-bit digests of their words next to the 64-bit digest of their anchor, reaches
likewise. "Earlier" is the order of (id, place); rows that share an id count as one document in this
order, so neither of two windows at one place is earlier, and a null id comes after all others.

Defined results: null, empty and blank texts have no words; texts of less than ``WINDOW`` words keep all;
repeated rows keep or lose the same words; an empty table gives an empty result; other columns aren't
read. Words are cut and compared as bytes, so texts needn't be valid UTF-8. A text is held whole by
one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import MEMO_LENGTH, discard, freed, slices, table, text_bytes, written

WINDOW = 20
SEED = 8
#: Anchors, or windows, that a task gathers before it settles what repeats among them.
GATHER = 1_000_000
#: Words a task remembers with their codes.
MEMO_WORDS = 100_000
LAST_ID = (1 << 63) - 1

#: Kinds of rows that a task emits: an anchor's class with an unknown rest of the corpus, a note that the
#: anchor has more classes elsewhere, the first of several classes, and windows that start earlier.
CLASS, NOTE, SEVERAL, GONE = 1, 0, 2, 3


class Codes:
    """Words (bytes) to 64-bit codes; short ones are remembered."""

    def __init__(self):
        import xxhash
        digest = xxhash.xxh3_64_intdigest

        class Known(dict):
            def __missing__(self, word):
                code = digest(word)
                if len(word) <= MEMO_LENGTH:
                    if len(self) >= MEMO_WORDS:
                        self.clear()
                    self[word] = code
                return code

        self.known = Known()

    def __call__(self, words: list[bytes]):
        import numpy as np
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


class Spans:
    """Digests of spans of a text, each from two prefix sums."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self):
        self.up = self.down = None

    def _powers(self, base: int, n: int):
        import numpy as np
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def sums(self, codes):
        import numpy as np
        n = len(codes)
        if self.up is None or len(self.up) < n + 1:
            size = max(2 * n, 1 << 15) if n < 1 << 20 else n + 1
            self.up, self.down = self._powers(self.BASE, size), self._powers(self.INVERSE, size)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * self.up[:n], out=out[1:])
        return out

    def digests(self, sums, start, end):
        import numpy as np
        return mixed((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def mixed(x):
    import numpy as np
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def anchors(hashes, window: int = WINDOW, seed: int = SEED):
    """(place, first window, last window) of each run of windows with one anchor. ``hashes`` has
    the seeds' hashes by place; the windows of a text start at each place that leaves room."""
    import numpy as np
    width = window - seed + 1
    n = len(hashes) - width + 1
    least, have = hashes, 1
    while have < width:  # minima of ever wider ranges
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    at = np.zeros(n, np.int64)
    for k in range(width):
        at[hashes[k:k + n] == least] = k  # the last of equals stays
    at += np.arange(n)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], first, np.append(first[1:], n) - 1


class Winnower:
    """Texts to their words, codes, anchors and digests."""

    def __init__(self, window: int, seed: int):
        self.codes, self.spans, self.window, self.seed = Codes(), Spans(), window, seed

    def __call__(self, text: bytes):
        """None for a text without a window, else (sums, anchor digests, places, first, last)."""
        import numpy as np
        words = text.split()
        if len(words) < self.window:
            return None
        sums = self.spans.sums(self.codes(words))
        start = np.arange(len(words) - self.seed + 1)
        hashes = self.spans.digests(sums, start, start + self.seed)
        place, first, last = anchors(hashes, self.window, self.seed)
        return sums, hashes[place], place, first, last

    def reach(self, sums, place, first, last):
        """The digest of an anchor's reach and of where the anchor stands in it."""
        import numpy as np
        return self.spans.digests(sums, first, last + self.window) + (place - first).astype(np.uint64)


def _columns(*kinds):
    return ["kind", "key", "code", "id", "sub", "place", "first", "last"]


ROWS = "kind int, key long, code long, id long, sub long, place int, first int, last int"


def _rows(kind, key, code, i, sub, place, first, last):
    import numpy as np
    import pyarrow as pa
    n = len(key)
    kind = np.full(n, kind, np.int32) if np.isscalar(kind) else kind.astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(kind), *[pa.array(x.view(np.int64)) for x in (key, code, i, sub)],
         *[pa.array(x.astype(np.int32)) for x in (place, first, last)]], _columns())


def _settled(key, code, i, sub, place, first, last):
    """Batches of the rows that a task's anchors come to."""
    import numpy as np
    order = np.lexsort((place, i, code, key))
    key, code, i, sub, place, first, last = (x[order] for x in (key, code, i, sub, place, first, last))
    new_key = np.concatenate([[True], key[1:] != key[:-1]])
    new_class = new_key | np.concatenate([[True], code[1:] != code[:-1]])
    lead = np.flatnonzero(new_class)[np.cumsum(new_class) - 1]  # the first of each row's class
    gone = (i != i[lead]) | (place != place[lead])
    if gone.any():
        yield _rows(GONE, mixed(i[gone].view(np.uint64)), np.zeros_like(code[gone]), i[gone], sub[gone],
                    place[gone], first[gone], last[gone])
    # Of equal rows one stands for all, unless they are texts of their own that share an id.
    same = ~new_class & ~gone & (sub == np.roll(sub, 1))
    keep = np.flatnonzero(~gone & ~same)
    run = np.cumsum(new_key)[keep] - 1
    classes = np.bincount(run, minlength=run[-1] + 1)[run]
    alone, several = keep[classes == 1], keep[classes > 1]
    if len(alone):
        yield _rows(CLASS, *[x[alone] for x in (key, code, i, sub, place, first, last)])
    if len(several):
        yield _rows(SEVERAL, mixed(i[several].view(np.uint64)), *[x[several] for x in (code, i, sub, place, first, last)])
        note = np.unique(key[several])
        zero = np.zeros(len(note), np.int64)
        yield _rows(NOTE, note, zero, zero, zero, zero, zero, zero)


def _seeds(window: int, seed: int):
    """(id, sub, text) -> ``ROWS``."""
    def run(batches):
        import numpy as np
        winnow = Winnower(window, seed)
        held, total = [], 0

        def flush():
            parts = [np.concatenate(x) for x in zip(*held)]
            held.clear()
            yield from _settled(*parts)

        for whole in batches:
            for piece in slices(whole):
                for i, sub, text in zip(*[c.to_pylist() for c in piece.columns]):
                    found = winnow(text)
                    if found is None:
                        continue
                    sums, key, place, first, last = found
                    n = len(key)
                    held.append((key, winnow.reach(sums, place, first, last), np.full(n, i, np.int64),
                                 np.full(n, sub, np.int64), place, first, last))
                    total += n
                    if total > GATHER:
                        yield from flush()
                        total = 0
        if held:
            yield from flush()
    return run


def _windows(window: int, seed: int):
    """(id, sub, text, places of first windows) -> rows (gone, key, code, id, sub, place) of the windows of those
    anchors: those that start earlier in this task are gone, the others are to be compared."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        winnow = Winnower(window, seed)
        held, total = [], 0

        def flush():
            key, code, i, sub, place = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.lexsort((sub, place, i, code, key))
            key, code, i, sub, place = (x[order] for x in (key, code, i, sub, place))
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (code[1:] != code[:-1])])
            lead = np.flatnonzero(new)[np.cumsum(new) - 1]
            gone = (i != i[lead]) | (place != place[lead])
            again = ~new & ~gone & (sub == np.roll(sub, 1))
            keep = ~again
            return pa.RecordBatch.from_arrays(
                [pa.array(gone[keep]), *[pa.array(x[keep].view(np.int64)) for x in (key, code, i, sub)],
                 pa.array(place[keep].astype(np.int32))], ["gone", "key", "code", "id", "sub", "place"])

        for whole in batches:
            for piece in slices(whole):
                for i, sub, text, wanted in zip(*[c.to_pylist() for c in piece.columns]):
                    sums, key, place, first, last = winnow(text)
                    pick = np.isin(first, np.array(wanted))
                    key, first, last = key[pick], first[pick], last[pick]
                    n = last - first + 1
                    start = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    held.append((np.repeat(key, n), winnow.spans.digests(sums, start, start + window),
                                 np.full(len(start), i, np.int64), np.full(len(start), sub, np.int64), start))
                    total += len(start)
                    if total > GATHER:
                        yield flush()
                        total = 0
        if held:
            yield flush()
    return run


def merged(first, last, window: int):
    """Maximal repeats [start, end) of runs of windows (first, last place)."""
    import numpy as np
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(last[order] + window)
    cut = np.flatnonzero(first[1:] > end[:-1])
    return first[np.concatenate([[0], cut + 1])], end[np.append(cut, len(end) - 1)]


def _cut(window: int, full: bool):
    """(doc id, text, first, last) -> (doc id, n_words, n_removed, kept_sha256[, kept, repeats])."""
    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa
        for whole in batches:
            for piece in slices(whole):
                n, removed, digest, kept, repeats = [], [], [], [], []
                for text, first, last in zip(*[c.to_pylist() for c in piece.columns[1:]]):
                    words = text.split()
                    n.append(len(words))
                    found = []
                    if first:
                        starts, ends = merged(np.array(first), np.array(last), window)
                        found = list(zip(starts.tolist(), ends.tolist()))
                        for a, b in reversed(found):
                            del words[a:b]
                    rest = b" ".join(words)
                    removed.append(n[-1] - len(words))
                    digest.append(hashlib.sha256(rest).hexdigest())
                    if full:
                        kept.append(rest)
                        repeats.append([{"start": a, "end": b} for a, b in found])
                columns = [piece.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if full:
                    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                    columns += [pa.array(kept, pa.binary()), pa.array(repeats, spans)]
                    names += ["kept", "repeats"]
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def _with_sub(rows: DataFrame, paths: list[str]) -> DataFrame:
    """``rows`` with ``sub``, which tells the texts of an id apart: 0 where an id occurs once."""
    several = written(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "op12-ids", paths)
    if several.isEmpty():
        return rows.withColumn("sub", F.lit(0).cast("long"))
    known = several.withColumn("shared", F.lit(True))
    return rows.join(known, "id", "left").withColumn("sub", F.when(F.col("shared"), F.xxhash64("text")).otherwise(F.lit(0)))


def repeated_windows(rows: DataFrame, paths: list[str], window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(id, sub, first, last): runs of windows of the texts in ``rows`` (id, sub, text) that start
    earlier too."""
    # One exchange for both windows: classes and notes meet by anchor, what a task has settled passes through.
    found = rows.select("id", "sub", "text").mapInArrow(freed(_seeds(window, seed)), ROWS).repartition("key")
    by_key = Window.partitionBy("key")
    by_class = Window.partitionBy("key", "code")
    at = F.when(F.col("kind") == CLASS, F.struct("id", "place"))
    code = F.when(F.col("kind") == CLASS, F.col("code"))
    rated = (found.withColumn("lead", F.min(at).over(by_class))
             .withColumn("lo", F.min(code).over(by_key)).withColumn("hi", F.max(code).over(by_key))
             .withColumn("least", F.min("kind").over(by_key)))
    own = (F.col("lead.id") == F.col("id")) & (F.col("lead.place") == F.col("place"))
    is_class = F.col("kind") == CLASS
    state = (F.when(is_class & ~own, F.lit(GONE))
             .when(is_class & ((F.col("lo") < F.col("hi")) | (F.col("least") == NOTE)), F.lit(SEVERAL))
             .when(~is_class, F.col("kind")))
    settled = written(rated.select(state.alias("state"), "id", "sub", "first", "last")
                      .where(F.col("state").isin(GONE, SEVERAL)), "op12-settled", paths)
    several = (settled.where(F.col("state") == SEVERAL).groupBy("id", "sub")
               .agg(F.sort_array(F.collect_set("first")).alias("places")))
    several = written(several, "op12-several", paths)  # the planner knows its size
    texts = rows.join(several, ["id", "sub"]).select("id", "sub", "text", "places")
    rest = texts.mapInArrow(freed(_windows(window, seed)), "gone boolean, key long, code long, id long, sub long, place int")
    same = Window.partitionBy("key", "code")
    start = F.when(~F.col("gone"), F.struct("id", "place"))
    spread = F.when(F.col("gone"), F.xxhash64("id", "place")).otherwise(F.col("key"))  # settled rows pass through
    rest = (rest.withColumn("key", spread).withColumn("lead", F.min(start).over(same))
            .where(F.col("gone") | (F.col("lead.id") != F.col("id")) | (F.col("lead.place") != F.col("place")))
            .select("id", "sub", F.col("place").alias("first"), F.col("place").alias("last")))
    rest = written(rest, "op12-rest", paths)
    return settled.where(F.col("state") == GONE).select("id", "sub", "first", "last").unionByName(rest)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     seed: int = SEED, full: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row; with ``full`` also the kept words
    joined by spaces, as UTF-8 bytes, and the maximal repeats that were cut, as word places."""
    spark, paths = docs.sparkSession, []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    rows = _with_sub(rows.withColumn("id", F.coalesce("doc_id", F.lit(LAST_ID))), paths)
    gone = (repeated_windows(rows, paths, window, seed).distinct().groupBy("id", "sub")
            .agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last")))
    gone = written(gone, "op12-gone", paths)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    if full:
        schema += ", kept binary, repeats array<struct<start: long, end: long>>"
    out = rows.join(gone, ["id", "sub"], "left").select("doc_id", "text", "first", "last").mapInArrow(_cut(window, full), schema)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"))


#: The same by plain windows: every window's words, first places, covered words.
SQL = rf"""WITH t AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, {LAST_ID}) AS id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS MATERIALIZED (
  SELECT rid, id, unnest(range(len(words))) AS p, unnest(words) AS word FROM t
), g AS MATERIALIZED (
  SELECT rid, id, p, md5(string_agg(word, ' ') OVER win) AS h, count(*) OVER win AS n
  FROM w WINDOW win AS (PARTITION BY rid ORDER BY p ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)
), gone AS MATERIALIZED (
  SELECT rid, p FROM g JOIN (SELECT h, min(ROW(id, p)) AS lead FROM g WHERE n = {WINDOW} GROUP BY h) USING (h)
  WHERE n = {WINDOW} AND ROW(id, p) > lead
), kept AS (
  SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words FROM (
    SELECT w.rid, w.p, w.word, g.p AS last_gone FROM w ASOF LEFT JOIN gone g ON w.rid = g.rid AND w.p >= g.p)
  WHERE last_gone IS NULL OR p - last_gone >= {WINDOW} GROUP BY rid
)
SELECT doc_id, CAST(len(t.words) AS BIGINT) AS n_words, CAST(len(t.words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.words, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (rid)"""
