"""Quality classifier from weak labels: labellers, expectation-maximisation, hashed scorer.

1. Nine simple labellers look at every document and vote good, bad or not at all. Votes are
   counted by pattern; there are at most 3^9 patterns, so the table of counts is small at any size
   and covers all documents.
2. Expectation-maximisation over the pattern counts estimates the share of good documents and how
   often each labeller casts each vote on good and on bad ones, without any true label; a
   pattern's posterior follows.
3. A linear scorer over hashed terms (word shapes, words, repeats; 2^16 buckets) is trained on
   posterior labels, in one task, on about ``SAMPLE`` distinct texts picked by hash, and scores every
   document. It judges texts on which the labellers are silent, too; the evidence of a short text is
   shrunk towards the share of good documents.

Defined results: null or empty text has no terms and no votes and gets the share of good documents;
repeated rows and ids are scored each; an empty table gives an empty result; if one class takes
all of the posterior mass, every document gets the share of good ones; other columns are not read
(``keep_documents`` carries them through untouched).
"""

from __future__ import annotations

import math
from operator import eq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MEMO_LENGTH, freed, rejoined, slices, table, text_bytes, texts_of, without_text

SAMPLE = 8000
BUCKETS = 1 << 16
STEPS = 200
RATE = 0.5
RIDGE = 1e-6
KEEP = 0.4
LEAST_WORDS = 10
#: Documents that the prior on votes counts as, at any size of the table.
PRIOR_DOCS = 100
#: Shares of no vote, good and bad that a labeller is expected to cast on good and on bad documents.
PRIOR_VOTES = [[0.3, 0.695, 0.005], [0.3, 0.55, 0.15]]
#: Words at which a text's own evidence weighs as much as the share of good documents.
PRIOR_WORDS = 20
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Frequent function words of the four languages.
FUNCTION_WORDS = frozenset(
    "the and of to in is that it for on as with by at was be are this or an from not "
    "der die das und ist nicht von mit sich auf für ein eine den dem zu im "
    "le la les de des et en un une que qui dans pour sur du est pas par "
    "el los las y por con para del se es una".encode().split())

LABELLERS = ("symbols", "bars", "capitals", "repeats", "variety", "exclamations", "lines", "function_words",
             "word_length")


def votes(text: bytes) -> tuple[int, ...]:
    """One vote per labeller: 1 good, 2 bad, 0 none."""
    words = text.split()
    n = len(words)
    if n < LEAST_WORDS:
        return (0,) * len(LABELLERS)

    def vote(value, good, bad):
        """Good up to one limit, bad from the other on (in either direction)."""
        if good < bad:
            return 1 if value <= good else 2 if value >= bad else 0
        return 1 if value >= good else 2 if value <= bad else 0

    size = sum(map(len, words))
    low = text.lower()
    upper = len(text) - len(text.translate(None, UPPER))
    letters = len(low) - len(low.translate(None, UPPER.lower()))
    symbols = len(text) - len(text.translate(None, b"#*$%&|<>"))
    same = sum(map(eq, words, words[1:]))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    low_words = low.split()
    known = sum(map(FUNCTION_WORDS.__contains__, low_words))
    return (
        vote(symbols / size, 0.01, 0.05),
        vote(words.count(b"|") / n, 0.005, 0.1),
        vote(upper / max(1, letters), 0.2, 0.6),
        vote(same / n, 0.05, 0.3),
        vote(len(set(low_words)) / min(n, 500), 0.3, 0.12),
        vote(text.count(b"!") / n, 0.05, 0.5),
        vote((len(lines) - len(set(lines))) / max(1, len(lines)), 0.05, 0.4) if len(lines) > 3 else 0,
        vote(known / n, 0.15, 0.01),
        vote(size / n, 9.0, 14.0),
    )


def pattern_of(text: bytes) -> int:
    out = 0
    for v in votes(text):
        out = out * 3 + v
    return out


def _patterns(batches):
    import pyarrow as pa
    for whole in batches:
        for piece in slices(whole):
            yield pa.RecordBatch.from_arrays(
                [pa.array([pattern_of(t) for t in piece.column(0).to_pylist()], pa.int32())], ["pattern"])


def maximise(counts: dict[int, int], steps: int = 200) -> tuple[dict[int, float], float]:
    """({pattern: posterior of good}, share of good) by expectation-maximisation.

    Starts with every document that any labeller calls bad. A prior of ``PRIOR_DOCS`` documents
    on each labeller's votes says what a labeller is for: it rarely calls a good document bad; documents
    outweigh it on large tables. A labeller can't end up worse than chance (its table is then made even).
    """
    import numpy as np
    patterns = sorted(counts)
    if not patterns:
        return {}, 1.0
    m = len(LABELLERS)
    n = np.array([counts[p] for p in patterns], np.float64)
    v = np.array([[p // 3 ** (m - 1 - k) % 3 for k in range(m)] for p in patterns])
    good, bad = (v == 1).sum(axis=1), (v == 2).sum(axis=1)
    q = np.where(bad > 0, 0.05, np.where(good > 0, 0.95, 0.5))
    prior = PRIOR_DOCS * np.array(PRIOR_VOTES)
    for _ in range(steps):
        share = float(np.clip((n * q).sum() / n.sum(), 1e-6, 1 - 1e-6))
        log = np.full(len(patterns), np.log(share) - np.log(1 - share))
        for k in range(m):
            table_of = np.array([[(n * c * (v[:, k] == x)).sum() for x in range(3)] for c in (q, 1 - q)]) + prior
            table_of /= table_of.sum(axis=1, keepdims=True)
            if table_of[0, 1] < table_of[1, 1] and table_of[0, 2] > table_of[1, 2]:
                table_of[:] = table_of.mean(axis=0)
            log += np.log(table_of[0] / table_of[1])[v[:, k]]
        new = 1 / (1 + np.exp(-np.clip(log, -30, 30)))
        done = np.abs(new - q).max() < 1e-9
        q = new
        if done:
            break
    return dict(zip(patterns, q.tolist())), share


# --- hashed linear scorer -------------------------------------------------------------------

class Terms(dict):
    """word -> its two buckets: what it looks like, and its letters."""

    _classes = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 57 if 48 <= b <= 57 else b
                     for b in range(256))

    def __missing__(self, word):
        import re

        import xxhash
        if len(self) > 100_000:
            self.clear()
        shape = re.sub(rb"(.)\1+", rb"\1", word.translate(self._classes), flags=re.S)[:12]
        letters = re.sub(rb"[^a-z\x80-\xff]+", b"", word.lower())
        found = (xxhash.xxh3_64_intdigest(b"s " + shape) % BUCKETS, xxhash.xxh3_64_intdigest(b"w " + letters) % BUCKETS)
        if len(word) <= MEMO_LENGTH:
            self[word] = found
        return found


REPEAT = 0  # the bucket of a word that repeats the one before


def features(text: bytes, terms: Terms):
    """(buckets, values): each bucket's share of the words, as a square root."""
    import numpy as np
    words = text.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    buckets = np.fromiter((b for w in words for b in terms[w]), np.int64, 2 * len(words))
    found, counts = np.unique(buckets, return_counts=True)
    same = sum(map(eq, words, words[1:]))
    if same:
        found, counts = np.append(found, REPEAT), np.append(counts, same)
    return found, np.sqrt(counts / len(words))


def _train(posterior: dict[int, float], share: float):
    """One task over the bounded sample: rows (text) -> one row (bias, weights)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        rows, terms = [], Terms()
        for whole in batches:
            for piece in slices(whole):
                for t in piece.column(0).to_pylist():
                    rows.append((*features(t, terms), posterior.get(pattern_of(t), share)))
        rows.sort(key=lambda r: (r[2], r[0].tobytes(), r[1].tobytes()))  # the same in every run
        y = np.array([r[2] for r in rows])
        w, bias = np.zeros(BUCKETS), float(np.log(share / (1 - share))) if 0 < share < 1 else 0.0
        if len(y) and y.min() < 0.5 < y.max():
            columns, values = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
            at = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
            good = max(1e-9, y.sum())
            weight = y / good + (1 - y) / max(1e-9, (1 - y).sum())  # both classes weigh the same
            weight /= weight.sum()
            bias, gb, gw = 0.0, 1e-8, np.full(BUCKETS, 1e-10)
            for _ in range(STEPS):
                z = bias + np.bincount(at, w[columns] * values, len(rows))
                error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
                db = error.sum()
                dw = np.bincount(columns, error[at] * values, BUCKETS) + RIDGE * w
                gb, gw = gb + db * db, gw + dw * dw
                bias -= RATE * db / np.sqrt(gb)
                w -= RATE * dw / np.sqrt(gw) * (gw > 1.01e-10)
        yield pa.RecordBatch.from_arrays([pa.array([bias]), pa.array([w.astype(np.float64).tobytes()])], ["bias", "w"])
    return run


def fit(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> tuple[float, bytes, float]:
    """(bias, weights, log odds of a good document) of the scorer."""
    texts = docs.select(text_bytes(text_col).alias("text"))
    counts = {r["pattern"]: r["n"] for r in texts.mapInArrow(freed(_patterns), "pattern int").groupBy("pattern")
              .agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 3^9 rows
    posterior, share = maximise(counts)
    total = sum(counts.values())
    limit = int(min(1.0, sample / max(1, total)) * (1 << 62))
    # Texts below a threshold of a 62-bit hash: about ``sample`` distinct ones, copies count once.
    code = F.shiftrightunsigned(F.xxhash64("text"), 2)
    chosen = texts.withColumn("code", code).where(F.col("code") <= limit).dropDuplicates(["code"]).select("text")
    model = chosen.repartition(1).mapInArrow(_train(posterior, share), "bias double, w binary").collect()
    share = min(1 - 1e-6, max(1e-6, share))
    prior = math.log(share / (1 - share))
    return (model[0]["bias"], bytes(model[0]["w"]), prior) if model else (prior, b"", prior)


def _score(model):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        bias, raw, prior = model.value
        w = np.frombuffer(raw, np.float64) if raw else np.zeros(BUCKETS)
        terms = Terms()
        for whole in batches:
            for piece in slices(whole):
                scores, n = [], []
                for t in texts_of(piece):
                    found, values = features(t, terms)
                    n.append(len(t.split()))
                    own = n[-1] / (n[-1] + PRIOR_WORDS)
                    z = own * (bias + float(w[found] @ values)) + (1 - own) * prior
                    scores.append(1 / (1 + float(np.exp(-np.clip(z, -30, 30)))))
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(n, pa.int64()), pa.array(scores, pa.float64())],
                    [*piece.schema.names, "n_words", "score"])
    return run


def score(docs: DataFrame, carry: Column, text_col: str = "text", model: tuple | None = None) -> DataFrame:
    """(carried, text, n_words, score, kept) for every row; the text comes back as bytes."""
    model = model or fit(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    df = docs.select(carry.alias("carried"), F.col(text_col).cast("string").cast("binary").alias("text"))
    kind = df.schema["carried"].dataType.simpleString()
    return (df.mapInArrow(freed(_score(shared)), f"carried {kind}, text binary, n_words long, score double")
            .withColumn("kept", F.col("score") >= KEEP))


def keep_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns as they were."""
    return rejoined(docs, score(docs, without_text(docs)).where("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, F.struct("doc_id")).select("carried.doc_id", "n_words", "score", "kept")
