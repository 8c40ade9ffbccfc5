"""Phrase collocations of two to four words, from sorted count streams.

1. *One stream for all orders.* Every word of a piece starts one record: itself and up to three words
   after it. A task sorts its records, adds up equal ones and cuts them into slices of the common
   order at fixed borders; a slice's block holds the distinct words' codes once and the records as
   places among them. Records of one slice meet in one task, which merges the blocks; as they lie in
   *prefix order*, the count of every phrase of one to four words is a sum over neighbours. Phrases cut
   by a slice's border are counted in parts that are added up afterwards; below ``LEAST`` nothing else
   is kept, as no part of a candidate is rarer than the candidate.
2. *Prefix order.* The counts, sorted by first words, are read in lockstep with their own prefixes: a
   phrase's first two and first three words are the last such rows before it, and a phrase's
   extensions to the right follow it.
3. *Suffix order.* The same, sorted by last words backwards: last two and three words, and extensions to
   the left. Counts of single words are merged in by sorted joins.
4. Scores, the filter of contained phrases and the first ``TOP`` of each language.

The borders are quantiles of a sample of documents (about ``SAMPLE_RECORDS`` records a slice); they decide
where a record is counted, not what is counted. A phrase however frequent is one record a task, and a
frequent first word is cut into several slices by the words after it.

Words are 63-bit codes until the end, where the words of the best phrases are looked up.

Defined results: null, empty texts and those of separators alone have no words; a null language is
``und``; repeated rows count each; an empty table gives an empty result; other columns aren't read;
texts are cut and compared as bytes, so they needn't be valid UTF-8. A text is held whole by one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, discard, freed, runs, slices, table, text_bytes, written

LEAST = 30
TOP = 2000
ORDER = 4
#: Characters that end a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
#: Words, or bytes of distinct words, that a task gathers before it sorts them.
GATHER = 1_000_000
GATHER_BYTES = 16_000_000
#: Bytes of text whose records make a slice, and records of the sample for each.
SLICE_BYTES = 4_000_000
SAMPLE_RECORDS = 32
SAMPLE_BYTES = 65_536
#: Shares of a language that are ranked on their own before all are.
SHARES = 64


class Codes(dict):
    """Words (bytes) and their 63-bit codes; the end of a piece is 0."""

    def __init__(self):
        import xxhash
        super().__init__()
        self.digest, self.size = xxhash.xxh3_64_intdigest, 0
        self.table = bytes.maketrans(ENDS, b"." * len(ENDS))

    def __missing__(self, word):
        code = 0 if word == b"." else self.digest(word) >> 1 or 1  # positive: absent words sort first
        self[word] = code
        self.size += len(word)
        return code

    def of(self, text: bytes):
        """The text's words in order, with a 0 after each piece."""
        import numpy as np
        words = text.lower().translate(self.table).replace(b".", b" . ").split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def records(codes):
    """(distinct codes in order, records as ranks by lane) of words with a 0 after each piece."""
    import numpy as np
    codes = np.concatenate([codes, np.zeros(ORDER, np.uint64)])
    known, ranks = np.unique(codes, return_inverse=True)
    at = np.flatnonzero(ranks)  # rank 0 is the end of a piece
    lanes = [ranks[at]]
    for k in range(1, ORDER):
        lanes.append(np.where(lanes[-1] > 0, ranks[at + k], 0))
    return known, lanes


def in_order(known, lanes):
    """The order of records by their lanes."""
    import numpy as np
    n = len(known)
    if n ** 3 < 1 << 62:
        return np.lexsort((lanes[3], (lanes[0].astype(np.int64) * n + lanes[1]) * n + lanes[2]))
    return np.lexsort(tuple(reversed(lanes)))


def heads(lanes):
    """For each lane, where a record differs from the one before in it or an earlier one."""
    import numpy as np
    out, new = [], np.zeros(len(lanes[0]), bool)
    new[:1] = True
    for lane in lanes:
        new = new.copy()
        new[1:] |= lane[1:] != lane[:-1]
        out.append(new)
    return out


def summed(known, lanes, counts):
    """Records in order, equal ones added up."""
    import numpy as np
    order = in_order(known, lanes)
    lanes = [lane[order] for lane in lanes]
    first = np.flatnonzero(heads(lanes)[-1])
    return [lane[first] for lane in lanes], np.add.reduceat(counts[order], first)


def cut_at(known, lanes, border) -> int:
    """How many of the records in order lie before a border (codes)."""
    import numpy as np
    lo, hi = 0, len(lanes[0])
    for lane, code in zip(lanes, border):
        rank = np.searchsorted(known, np.uint64(code))
        part = lane[lo:hi]
        if rank == len(known) or known[rank] != np.uint64(code):
            return lo + int(np.searchsorted(part, rank))
        lo, hi = lo + int(np.searchsorted(part, rank)), lo + int(np.searchsorted(part, rank, "right"))
    return lo


def packed(known, lanes, counts, names) -> bytes:
    """A block: distinct codes, records as places among them, counts, and the first words' names."""
    import numpy as np
    used = np.unique(np.concatenate(lanes))
    kind = np.uint16 if len(used) <= 1 << 16 else np.uint32
    first = np.unique(lanes[0])
    head = np.array([len(used), len(counts), len(first)], np.int64)
    return b"".join([head.tobytes(), known[used].tobytes(),
                     *[np.searchsorted(used, lane).astype(kind).tobytes() for lane in lanes],
                     counts.astype(np.uint32).tobytes(), b" ".join([names[r] for r in first.tolist()])])


def unpacked(block: bytes):
    """(codes, lanes, counts, codes of first words, their names) of a block."""
    import numpy as np
    n_codes, n, n_first = np.frombuffer(block, np.int64, 3).tolist()
    at = 24
    codes = np.frombuffer(block, np.uint64, n_codes, at)
    at += 8 * n_codes
    kind = np.uint16 if n_codes <= 1 << 16 else np.uint32
    lanes = []
    for _ in range(ORDER):
        lanes.append(np.frombuffer(block, kind, n, at))
        at += lanes[-1].nbytes
    counts = np.frombuffer(block, np.uint32, n, at)
    return codes, lanes, counts, codes[np.unique(lanes[0])], block[at + 4 * n:]


def _sampled(share: int):
    """(lang, text) -> some of its records (lang, h1..h4), one in ``share``."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        rng = np.random.default_rng(5)
        for whole in batches:
            for piece in slices(whole):
                for lang, text in zip(*[c.to_pylist() for c in piece.columns]):
                    words = Codes()
                    known, lanes = records(words.of(text))
                    pick = rng.random(len(lanes[0])) * share < 1
                    columns = [pa.array(known[lane[pick]].view(np.int64)) for lane in lanes]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * int(pick.sum()), pa.string()), *columns],
                                                     ["lang", "h1", "h2", "h3", "h4"])
    return run


def borders(texts: DataFrame) -> tuple[dict[str, list[tuple]], int]:
    """(lang -> the first record of each slice but the first, slices): a few dozen bytes a slice."""
    import numpy as np
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / SLICE_BYTES))
    share = max(1, SAMPLE_BYTES // 6 // SAMPLE_RECORDS) if count > 1 else 1 << 30
    fraction = min(1.0, SAMPLE_BYTES * count / max(total, 1))
    rows = texts.sample(fraction, seed=3).mapInArrow(
        _sampled(share), "lang string, h1 long, h2 long, h3 long, h4 long").toArrow()
    lanes = [rows.column(k).to_numpy().view(np.uint64) for k in range(1, 1 + ORDER)]
    langs = np.array(rows.column(0).to_pylist(), object)
    out = {}
    for lang in sorted(set(langs.tolist())):
        own = np.flatnonzero(langs == lang)
        order = own[np.lexsort(tuple(lane[own] for lane in reversed(lanes)))]
        n = max(1, round(count * len(own) / len(langs)))
        at = order[np.arange(1, n) * len(order) // n]
        out[lang] = sorted({tuple(int(lane[k]) for lane in lanes) for k in at})
    return out, count


def _blocks(edges):
    """(lang, text) -> (unit, lang, data): a block of each slice that the task's words meet."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash
        words, held, total = Codes(), {}, 0

        def flush():
            codes = np.fromiter(words.values(), np.uint64, len(words))
            order = np.argsort(codes)
            texts = list(words)
            code_of, text_of = codes[order], [texts[k] for k in order.tolist()]
            for lang, parts in held.items():
                known, lanes = records(np.concatenate(parts))
                if not len(lanes[0]):
                    continue
                lanes, counts = summed(known, lanes, np.ones(len(lanes[0]), np.int64))
                at = np.searchsorted(code_of, known)
                cuts = [0, *[cut_at(known, lanes, b) for b in edges.value.get(lang, ())], len(counts)]
                out = []
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if a < b:
                        part = [lane[a:b] for lane in lanes]
                        names = {r: text_of[at[r]] for r in np.unique(part[0]).tolist()}
                        unit = xxhash.xxh3_64_intdigest(f"{k} {lang}") >> 1
                        out.append((unit, packed(known, part, counts[a:b], names)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([u for u, _ in out], pa.int64()), pa.array([lang] * len(out), pa.string()),
                     pa.array([d for _, d in out], pa.binary())], ["unit", "lang", "data"])
            held.clear()
            words.clear()
            words.size = 0

        for whole in batches:
            for piece in slices(whole):
                for lang, text in zip(*[c.to_pylist() for c in piece.columns]):
                    found = words.of(text)
                    if len(found):
                        held.setdefault(lang, []).extend([found, np.zeros(1, np.uint64)])
                    total += len(found)
                    if total > GATHER or words.size > GATHER_BYTES:
                        yield from flush()
                        total = 0
        if held:
            yield from flush()
    return run


COUNTS = "lang string, n int, h1 long, h2 long, h3 long, h4 long, f long, word binary"


def _count(least: int):
    """Units of blocks -> phrases of at least ``least`` or on a unit's border, and the unit's words (n = 0)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def emit(lang, n, lanes, f, words):
            zero = np.zeros(len(f), np.int64)
            lanes = [x.view(np.int64) for x in lanes] + [zero] * (ORDER - len(lanes))
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(f), pa.string()), pa.array(np.full(len(f), n, np.int32)),
                 *[pa.array(x) for x in lanes], pa.array(f.astype(np.int64)), pa.array(words or [None] * len(f), pa.binary())],
                ["lang", "n", "h1", "h2", "h3", "h4", "f", "word"])

        for unit in runs(batches, 1):
            lang = unit.column(1)[0].as_py()
            blocks = [unpacked(b) for b in unit.column(2).to_pylist()]
            known = np.unique(np.concatenate([np.zeros(1, np.uint64), *[b[0] for b in blocks]]))
            places = [np.searchsorted(known, b[0]).astype(np.int32) for b in blocks]
            lanes = [np.concatenate([p[b[1][k]] for p, b in zip(places, blocks)]) for k in range(ORDER)]
            counts = np.concatenate([b[2] for b in blocks]).astype(np.int64)
            order = in_order(known, lanes)
            lanes, counts = [lane[order] for lane in lanes], counts[order]
            yield emit(lang, 0, [], counts.sum(keepdims=True), None)
            for k, head in enumerate(heads(lanes)):
                first = np.flatnonzero(head)
                f = np.add.reduceat(counts, first)
                keep = f >= least
                keep[0] = keep[-1] = True
                keep &= lanes[k][first] > 0
                first, f = first[keep], f[keep]
                words = None
                if k == 0:
                    want, words = known[lanes[0][first]], {}
                    for *_, codes, names in blocks:
                        names = names.split(b" ")
                        for j in np.flatnonzero(np.isin(codes, want)).tolist():
                            words[int(codes[j])] = names[j]
                    words = [words[c] for c in want.tolist()]
                yield emit(lang, k + 1, [known[lane[first]] for lane in lanes[:k + 1]], f, words)
    return run


def count_streams(docs: DataFrame, paths: list[str], least: int = LEAST, text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """(lang, n, h1..h4, f, word): every phrase of one to four words that occurs ``least`` times, as the codes
    of its words, the word itself for n = 1, and all words of the language as n = 0."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_bytes(text_col).alias("text"))
    edges, count = borders(texts)
    spark = docs.sparkSession
    blocks = texts.mapInArrow(freed(_blocks(spark.sparkContext.broadcast(edges))), "unit long, lang string, data binary")
    partial = blocks.repartition(max(count, 2), "unit").sortWithinPartitions("unit").mapInArrow(freed(_count(least)), COUNTS)
    keys = ["lang", "n", "h1", "h2", "h3", "h4"]
    return written(partial.groupBy(*keys).agg(F.sum("f").alias("f"), F.first("word", ignorenulls=True).alias("word"))
                   .where((F.col("n") == 0) | (F.col("f") >= least)), "op11-counts", paths)


FACTS = ["f", "pre2", "pre3", "suf2", "suf3", "extended"]


def _lockstep(two: str, three: str):
    """A stream of phrases (lang, n, a1..a4, facts) in order of a1..a4 -> the same rows with the counts of
    their first two and three words in ``two`` and ``three``, and the largest count of a phrase that
    continues them in ``extended``. Rows without a count pass through; a phrase whose continuations
    reach into the next batch gets another row, without a count, for those."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        held = None  # the last phrases of two and three words so far
        for batch in batches:
            if not batch.num_rows:
                continue
            live = batch.filter(pa.array(batch.column("f").to_numpy() > 0))
            if live.num_rows < batch.num_rows:
                yield batch.filter(pa.array(batch.column("f").to_numpy() == 0))
            if not live.num_rows:
                continue
            rows = pa.Table.from_batches([live])
            old = 0
            if held is not None:
                rows, old = pa.concat_tables([held, rows]), held.num_rows
            rows = rows.combine_chunks()
            n, f = rows.column("n").to_numpy(), rows.column("f").to_numpy()
            place = np.arange(len(n))
            at2, at3 = (np.maximum.accumulate(np.where(n == k, place, 0)) for k in (2, 3))
            extended = rows.column("extended").to_numpy().copy()
            fresh = place >= old
            for child, parent in ((3, at2), (4, at3)):
                k = np.flatnonzero(fresh & (n == child))
                np.maximum.at(extended, parent[k], f[k])
            out = {"extended": extended, two: np.where(n >= 3, f[at2], 0), three: np.where(n >= 4, f[at3], 0),
                   "f": np.where(fresh, f, 0)}
            done = rows
            for name, values in out.items():
                done = done.set_column(done.schema.get_field_index(name), name, pa.array(values))
            again = fresh | (extended > rows.column("extended").to_numpy())
            yield from done.filter(pa.array(again)).to_batches()
            last = sorted({int(at[-1]) for at, k in ((at2, 2), (at3, 3)) if n[at[-1]] == k})
            held = rows.take(pa.array(last, pa.int64()))
    return run


PHRASES = "lang string, n int, a1 long, a2 long, a3 long, a4 long, " + ", ".join(f"{c} long" for c in FACTS)


def _reversed(lanes: list[str]) -> list[Column]:
    """The lanes of a phrase's words in reverse order, absent ones last."""
    words = F.reverse(F.filter(F.array(*lanes), lambda x: x != 0))
    return [F.coalesce(F.get(words, F.lit(k)), F.lit(0)).alias(f"a{k + 1}") for k in range(ORDER)]


def _pass(rows: DataFrame, two: str, three: str) -> DataFrame:
    lanes = [f"a{k}" for k in range(1, ORDER + 1)]
    ordered = rows.repartitionByRange("lang", "a1", "a2").sortWithinPartitions("lang", *lanes)
    return ordered.select("lang", "n", *lanes, *FACTS).mapInArrow(_lockstep(two, three), PHRASES)


def candidates(counts: DataFrame, paths: list[str]) -> DataFrame:
    """(lang, n, h1..h4, a, l, r, cut, score, extended) of every phrase of two words or more."""
    lanes = [f"a{k}" for k in range(1, ORDER + 1)]
    rows = counts.where("n >= 2").select("lang", "n", *[F.col(f"h{k}").alias(f"a{k}") for k in range(1, ORDER + 1)],
                                         "f", *[F.lit(0).cast("long").alias(c) for c in FACTS[1:]])
    prefix = written(_pass(rows, "pre2", "pre3"), "op11-prefix", paths)
    back = prefix.select("lang", "n", *_reversed(lanes), *FACTS)
    suffix = written(_pass(back, "suf2", "suf3"), "op11-suffix", paths)
    forth = suffix.select("lang", "n", *_reversed(lanes), *FACTS)
    whole = forth.groupBy("lang", "n", *lanes).agg(*[F.max(c).alias(c) for c in FACTS])
    single = counts.where("n = 1").select(F.col("lang").alias("lang_"), F.col("h1").alias("h"), F.col("f").alias("one"))
    last = F.element_at(F.filter(F.array(*lanes), lambda x: x != 0), -1)
    whole = (whole.withColumn("z", last)
             .join(single.hint("merge"), (F.col("lang") == F.col("lang_")) & (F.col("a1") == F.col("h")))
             .withColumnRenamed("one", "first1").drop("lang_", "h")
             .join(single.hint("merge"), (F.col("lang") == F.col("lang_")) & (F.col("z") == F.col("h")))
             .withColumnRenamed("one", "last1").drop("lang_", "h"))

    def cut(k: int, left: str, right: str) -> Column:
        score = F.expr(f"CAST(f AS DECIMAL(20,0)) * 2000000 DIV (CAST({left} AS DECIMAL(20,0)) + CAST({right} AS DECIMAL(20,0)))")
        return F.struct(score.alias("score"), F.lit(k).alias("cut"), F.col(left).alias("l"), F.col(right).alias("r"))

    cuts = (F.when(F.col("n") == 2, F.array(cut(1, "first1", "last1")))
            .when(F.col("n") == 3, F.array(cut(1, "first1", "suf2"), cut(2, "pre2", "last1")))
            .otherwise(F.array(cut(1, "first1", "suf3"), cut(2, "pre2", "suf2"), cut(3, "pre3", "last1"))))
    return (whole.withColumn("best", F.array_min(cuts))  # by score, then by the smallest cut
            .select("lang", "n", *[F.col(f"a{k}").alias(f"h{k}") for k in range(1, ORDER + 1)], F.col("f").alias("a"),
                    "best.l", "best.r", "best.cut", "best.score", "extended"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` collocations."""
    paths: list[str] = []
    counts = count_streams(docs, paths, least, text_col, lang_col)
    found = candidates(counts, paths)
    free = F.lit(100).cast("decimal(20,0)") * F.col("extended") < F.lit(80).cast("decimal(20,0)") * F.col("a")
    share = F.pmod(F.xxhash64("h1", "h2", "h3", "h4"), F.lit(SHARES))
    best = [F.desc("score"), F.desc("a")]
    near = (found.where(free).withColumn("share", share)
            .withColumn("place", F.rank().over(Window.partitionBy("lang", "share").orderBy(*best))).where(F.col("place") <= top)
            .withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("place") <= top))
    words = counts.where("n = 1").select(F.col("lang").alias("lang_"), F.col("h1").alias("h"), F.col("word").cast("string").alias("w"))
    for k in range(1, ORDER + 1):
        near = (near.join(words, (F.col("lang") == F.col("lang_")) & (F.col(f"h{k}") == F.col("h")), "left")
                .withColumnRenamed("w", f"w{k}").drop("lang_", "h"))
    totals = counts.where("n = 0").select(F.col("lang").alias("lang_"), F.col("f").alias("all"))
    ranked = near.withColumn("phrase", F.concat_ws(" ", *[f"w{k}" for k in range(1, ORDER + 1)]))
    ranked = (ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best, "phrase")))
              .where(F.col("rank") <= top).join(totals, F.col("lang") == F.col("lang_")))
    out = written(ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                F.col("all").alias("n"), "score"), "op11-ranked")
    discard(docs.sparkSession, paths)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


#: The same by counting every phrase as a text.
SQL = rf"""WITH pieces AS MATERIALIZED (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(part, '[^\x20\x09]+') AS words FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS part
    FROM documents)
), starts AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces
), phrases AS (
  SELECT lang, k, list_slice(words, i, i + k - 1) AS p FROM starts, (SELECT unnest(range(1, {ORDER + 1})) AS k)
  WHERE i + k - 1 <= len(words)
), counts AS MATERIALIZED (
  SELECT lang, k, p, count(*) AS f FROM phrases GROUP BY lang, k, p
), totals AS MATERIALIZED (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang
), cand AS MATERIALIZED (
  SELECT lang, k, p, f FROM counts WHERE k >= 2 AND f >= {LEAST}
), cuts AS (
  SELECT lang, k, p, f, unnest(range(1, k)) AS cut FROM cand
), scored AS (
  SELECT c.lang, c.k, c.p, c.f AS a, l.f AS l, r.f AS r, c.cut, CAST(2000000 * CAST(c.f AS HUGEINT) // (l.f + r.f) AS BIGINT) AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.p = list_slice(c.p, 1, c.cut)
  JOIN counts r ON r.lang = c.lang AND r.p = list_slice(c.p, c.cut + 1, c.k)
), least AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) AS o FROM scored) WHERE o = 1
), inside AS MATERIALIZED (
  SELECT lang, list_slice(p, i, i + m - 1) AS p, max(f) AS f FROM cand, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS i)
  WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), kept AS (
  SELECT least.*, array_to_string(least.p, ' ') AS phrase FROM least LEFT JOIN inside ON inside.lang = least.lang AND inside.p = least.p
  WHERE inside.f IS NULL OR 100 * inside.f < 80 * least.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
         phrase, a, l, r, n, score FROM kept JOIN totals USING (lang))
WHERE rank <= {TOP}"""
