"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(b + sum w_i + sum over pairs <v_i, v_j>) over a document's distinct terms: the
factors learn what pairs of terms mean together (an insult and a group mention), which no sum of
single weights can. Terms are words and their beginnings (three to seven letters, for inflected
words) hashed into 2^20 buckets; labels are used for training only, and only those of rows outside
of the held-out third (crc32 of the id as text, mod 3, is 1).

Training uses about ``SAMPLE`` labelled documents of each class at most (picked by a hash of the id),
weighted back to the classes' true shares, in one task of that stated size. Labels are noisy and
texts long, so only terms take part whose share of toxic documents can't be chance (Chernoff bound,
corrected for the number of terms tested), and terms of pairs for which that holds beyond either
term, however neutral each is alone: every co-occurring pair of the sample's terms is counted. A long
text is then not judged by the sum of thousands of small noises. The machine is fitted to these terms
by full-batch Adagrad. The sample's ids are joined by a broadcast of that bound; the
model (at most 2^20 rows of numbers) goes to every executor; scoring is one scan.

Defined results: null or empty text has no terms and gets the score of the bias alone; a null id is
not held out and never trains; repeated rows are scored each; several labels of one id count as their
maximum; without labels of both classes every score is the share of toxic labels (0 if none); an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MEMO_LENGTH, freed, slices, table, text_bytes

BUCKETS = 1 << 20
FACTORS = 8
SAMPLE = 6000
LEAST_DOCS = 5
STEPS = 400
RATE = 0.3
RIDGE_LINEAR, RIDGE_FACTOR = 1e-5, 1e-3
#: Terms that would pass by chance, over all terms tested; strongest terms whose pairs are also tested
#: among themselves, under the milder correction for so few.
CHANCE = 0.3
PAIR_TERMS = 300
#: Most frequent terms whose pairs are counted by a matrix product.
DENSE = 2048
SEED = 13
TOXIC = 0.7

TERM = rb"[0-9a-z\x80-\xff]+"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Terms(dict):
    """word -> its buckets, remembered."""

    def __missing__(self, word):
        import xxhash
        if len(self) > 100_000:
            self.clear()
        text = word.decode("utf-8", "replace")
        names = [word] + [b"^" + text[:k].encode() for k in range(3, 8) if k <= len(text)]
        found = tuple(xxhash.xxh3_64_intdigest(x) % BUCKETS for x in names)
        if len(word) <= MEMO_LENGTH:
            self[word] = found
        return found

    def of(self, text: bytes) -> set[int]:
        """The distinct buckets of a text."""
        import re
        return set().union(*map(self.__getitem__, set(re.findall(TERM, text.lower()))))


def _features(batches):
    import pyarrow as pa
    terms = Terms()
    for whole in batches:
        for piece in slices(whole):
            rows = [sorted(terms.of(t)) for t in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(rows, pa.list_(pa.int32()))], ["toxic", "terms"])


# --- the model -------------------------------------------------------------------------------

def margins(offsets, columns, bias, w, v):
    """b + sum w + pair sums of each row of a sparse 0/1 matrix, and the factor sums."""
    import numpy as np
    n = len(offsets) - 1
    rows = np.repeat(np.arange(n), np.diff(offsets))
    linear = np.bincount(rows, w[columns], n)
    sums = np.stack([np.bincount(rows, v[columns, f], n) for f in range(v.shape[1])], 1)
    squares = np.bincount(rows, (v * v).sum(axis=1)[columns], n)
    return bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def evidence(k, n, p):
    """n KL(k / n || p): minus the log of a bound on the chance to see a share as far from p."""
    import numpy as np
    q = np.clip(k / np.maximum(n, 1e-12), 0, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = (np.where(q > 0, q * np.log(q / p), 0) + np.where(q < 1, (1 - q) * np.log((1 - q) / (1 - p)), 0))
    return n * np.maximum(kl, 0)


def informative(offsets, columns, y, n_columns):
    """Columns whose toxic share, alone or in a pair, can't be chance."""
    import numpy as np
    rows = np.repeat(np.arange(len(y)), np.diff(offsets))
    p = float(y.mean())
    n, k = np.bincount(columns, minlength=n_columns), np.bincount(columns, y[rows], n_columns)
    alone = evidence(k, n, p)
    keep = (n >= LEAST_DOCS) & (alone >= np.log(max(1, (n >= LEAST_DOCS).sum()) / CHANCE))
    top = np.argsort(-np.where(n >= LEAST_DOCS, alone, -1), kind="stable")[:PAIR_TERMS]
    place = np.full(n_columns, -1)
    place[top] = np.arange(len(top))
    both, toxic = np.zeros((len(top), len(top))), np.zeros((len(top), len(top)))
    for r in range(len(y)):
        c = place[columns[offsets[r]:offsets[r + 1]]]
        c = c[c >= 0]
        both[np.ix_(c, c)] += 1
        toxic[np.ix_(c, c)] += y[r]
    pair = evidence(toxic, both, p)
    least = np.log(len(top) * len(top) / CHANCE) if len(top) else 0
    beyond = (both >= LEAST_DOCS) & (pair >= least + np.maximum(alone[top][:, None], alone[top][None, :]))
    np.fill_diagonal(beyond, False)
    keep[top[beyond.any(axis=1)]] = True
    return np.flatnonzero(keep)


def interacting(offsets, columns, y, predicted, n_columns):
    """Columns of all pairs whose toxic share can't be chance given either column's own share, nor
    given what was ``predicted`` for their documents.

    A pair's documents are some of each column's, so its evidence given a column is at most what
    all toxic or all clean documents of that column would give. Columns for which this is below the
    limit can't pass in any pair: they are left out without loss and don't count as tested. Nor can
    columns whose documents are all predicted well.
    """
    import numpy as np
    rows = np.repeat(np.arange(len(y)), np.diff(offsets))
    n, k = np.bincount(columns, minlength=n_columns), np.bincount(columns, y[rows], n_columns)
    share, clean = k / np.maximum(n, 1), n - k
    most, mixed = np.zeros(n_columns), (n >= LEAST_DOCS) & (k > 0) & (clean > 0)
    most[mixed] = np.maximum(-k[mixed] * np.log(share[mixed]), -clean[mixed] * np.log(1 - share[mixed]))
    # The smallest number of columns that leaves no further one above the limit for their pairs.
    ranked = np.sort(most[most > 0])[::-1]
    limits = 2 * np.log(np.arange(1, len(ranked) + 1)) - np.log(CHANCE)
    enough = np.flatnonzero(np.append(ranked[1:], 0) < limits)
    if not len(enough):
        return np.zeros(0, np.int64)
    least = limits[enough[0]]
    # KL is convex: a pair's evidence beyond the prediction is at most its documents' log loss.
    predicted = np.clip(predicted, 1e-9, 1 - 1e-9)
    loss = np.bincount(columns, -np.log(np.where(y == 1, predicted, 1 - predicted))[rows], n_columns)
    tested = np.flatnonzero((most >= least) & (loss >= 0.999 * least))
    tested = tested[np.argsort(-n[tested], kind="stable")]
    # Entries by document (clean ones first) and column, frequent ones first: the entries of a
    # document before a column are its pairs with more frequent columns.
    place = np.full(len(n), -1)
    place[tested] = np.arange(len(tested))
    by_class = np.argsort(y, kind="stable")
    turn = np.empty(len(y), np.int64)
    turn[by_class] = np.arange(len(y))
    predicted, n_clean = predicted[by_class], int((y == 0).sum())
    code, doc = place[columns], turn[rows]
    code, doc = code[code >= 0], doc[code >= 0]
    order = np.argsort(doc * len(tested) + code)
    code, doc = code[order], doc[order]
    first = np.searchsorted(doc, np.arange(len(y)))
    entries, ends = np.argsort(code, kind="stable"), np.cumsum(n[tested])
    # The most frequent columns' pairs are counted by a product of dense matrices.
    front = min(DENSE, len(tested))
    dense = np.zeros((len(y), front), np.float32)
    dense[doc[code < front], code[code < front]] = 1
    front_good, front_bad = (x.T @ x for x in (dense[:n_clean], dense[n_clean:]))
    front_sums = dense.T @ (dense * predicted[:, None].astype(np.float32))
    found = np.zeros(len(tested), bool)
    for a, column in enumerate(tested.tolist()):
        own = entries[ends[a] - n[column]:ends[a]]
        if a < front:
            good, bad = front_good[a, :a].astype(np.float64), front_bad[a, :a].astype(np.float64)
        else:
            before = [code[i:j] for i, j in zip(first[doc[own]].tolist(), own.tolist())]
            split = int(clean[column])
            good, bad = (np.bincount(np.concatenate(x), minlength=a) for x in (before[:split], before[split:]))
        p = share[column]
        b = np.flatnonzero((bad >= least / -np.log(p)) | (good >= least / -np.log(1 - p)))
        both = bad[b] + good[b]
        passed = np.minimum(evidence(bad[b], both, p), evidence(bad[b], both, share[tested[b]])) >= least
        b, both = b[passed], both[passed]
        if len(b):
            sums = front_sums[a, b] if a < front else np.bincount(
                np.concatenate(before), np.repeat(predicted[doc[own]], list(map(len, before))), a)[b]
            b = b[evidence(bad[b], both, np.clip(sums / both, 1e-9, 1 - 1e-9)) >= least]
            found[b] = True
            found[a] |= len(b) > 0
    return tested[found]


def train(offsets, columns, y, weight, n_columns, steps=STEPS):
    """(bias, w, v) of the weighted logistic loss with a ridge."""
    import numpy as np
    rng = np.random.default_rng(SEED)
    n = len(y)
    rows = np.repeat(np.arange(n), np.diff(offsets))
    weight = weight / weight.sum()
    share = float((weight * y).sum())
    bias = float(np.log(share / (1 - share)))
    w, v = np.zeros(n_columns), rng.normal(0, 0.05, (n_columns, FACTORS))
    gb, gw, gv = 1e-8, np.full(n_columns, 1e-10), np.full((n_columns, FACTORS), 1e-10)
    for _ in range(steps):
        z, sums = margins(offsets, columns, bias, w, v)
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        db = error.sum()
        plain = np.bincount(columns, error[rows], n_columns)
        dw = plain + RIDGE_LINEAR * w
        dv = np.stack([np.bincount(columns, (error * sums[:, f])[rows], n_columns)
                       for f in range(FACTORS)], 1) - v * plain[:, None] + RIDGE_FACTOR * v
        gb, gw, gv = gb + db * db, gw + dw * dw, gv + dv * dv
        bias -= RATE * db / np.sqrt(gb)
        w, v = w - RATE * dw / np.sqrt(gw), v - RATE * dv / np.sqrt(gv)
    return bias, w, v


def learn(offsets, columns, y, weight, n_columns):
    """(columns that take part, bias, w, v): a model of the informative columns, trained anew with
    those of pairs that it doesn't explain if there are any."""
    import numpy as np
    rows = np.repeat(np.arange(len(y)), np.diff(offsets))

    def model(kept):
        place = np.full(n_columns, -1, np.int64)
        place[kept] = np.arange(len(kept))
        code = place[columns]
        some = np.concatenate([[0], np.cumsum(np.bincount(rows[code >= 0], minlength=len(y)))])
        return some, code[code >= 0], *train(some, code[code >= 0], y, weight, len(kept))

    kept = informative(offsets, columns, y, n_columns)
    some, code, bias, w, v = model(kept)
    # The model's odds are those of all documents; the pairs are counted in the sample.
    odds = np.log(y.sum() / (len(y) - y.sum())) - np.log((weight * y).sum() / (weight * (1 - y)).sum())
    z = margins(some, code, bias, w, v)[0] + odds
    whole = np.union1d(kept, interacting(offsets, columns, y, 1 / (1 + np.exp(-np.clip(z, -30, 30))), n_columns))
    if len(whole) > len(kept):
        kept, (bias, w, v) = whole, model(whole)[2:]
    return kept.astype(np.int32), bias, w, v


def _fit(share: float, n_toxic: int, n_clean: int):
    """One task over the bounded sample: rows (toxic, terms) -> one row with the model."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        y, terms = [], []
        for batch in batches:
            y += batch.column(0).to_pylist()
            terms += [np.array(t, np.int64) for t in batch.column(1).to_pylist()]
        y = np.array(y, np.float64)
        bias = float(np.log(share / (1 - share))) if 0 < share < 1 else (30.0 if share >= 1 else -30.0)
        kept, w, v = np.zeros(0, np.int32), np.zeros(0), np.zeros((0, FACTORS))
        if 0 < y.sum() < len(y):
            # Rows arrive in any order; sorting makes the sums the same in every run.
            order = sorted(range(len(y)), key=lambda k: (y[k], terms[k].tobytes()))
            y, terms = y[order], [terms[k] for k in order]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in terms])])
            weight = np.where(y == 1, n_toxic / y.sum(), n_clean / (len(y) - y.sum()))
            kept, bias, w, v = learn(offsets, np.concatenate(terms), y, weight, BUCKETS)
        yield pa.RecordBatch.from_arrays(
            [pa.array([bias]), pa.array([kept.tobytes()]), pa.array([w.astype(np.float64).tobytes()]),
             pa.array([v.astype(np.float64).tobytes()])], ["bias", "terms", "w", "v"])
    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> tuple:
    """(bias, terms, w, v), from the labelled rows that aren't held out."""
    own = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic"))
           .where("id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("id")))
           .groupBy("id").agg(F.max("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1)"))
    counts = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    # Ids below a threshold of a 62-bit hash: about ``sample`` of each class, all if there are fewer.
    code = F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string")), 2)
    limit = [int(min(1.0, sample / max(1, n)) * (1 << 62)) for n in (clean, toxic)]
    chosen = own.where(code <= F.when(F.col("toxic") == 1, limit[1]).otherwise(limit[0]))
    chosen = F.broadcast(chosen)  # about 2 * sample ids at any size
    rows = (docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text")).join(chosen, "id")
            .groupBy("id").agg(F.first("toxic").alias("toxic"),  # of an id's texts the one of the least digest
                               F.min_by("text", F.sha2("text", 256)).alias("text")).select("toxic", "text"))
    share = toxic / (toxic + clean) if toxic + clean else 0.0
    model = (rows.mapInArrow(_features, "toxic int, terms array<int>").repartition(1)
             .mapInArrow(_fit(share, toxic, clean), "bias double, terms binary, w binary, v binary").collect()[0])
    return model["bias"], bytes(model["terms"]), bytes(model["w"]), bytes(model["v"])


def _score(model):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        bias, terms, w, v = model.value
        place = {t: k for k, t in enumerate(np.frombuffer(terms, np.int32).tolist())}
        w, v = np.frombuffer(w, np.float64), np.frombuffer(v, np.float64).reshape(-1, FACTORS)
        buckets = Terms()
        for whole in batches:
            for piece in slices(whole):
                scores = []
                for text in piece.column(piece.num_columns - 1).to_pylist():
                    known = sorted(place[b] for b in buckets.of(text) & place.keys())
                    z = margins(np.array([0, len(known)]), np.array(known, np.int64), bias, w, v)[0][0]
                    scores.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[:-1], pa.array(scores, pa.float64())], [*piece.schema.names[:-1], "score"])
    return run


def score(docs: DataFrame, model: tuple, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by BUCKETS
    df = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    kind = df.schema["id"].dataType.simpleString()
    out = df.mapInArrow(freed(_score(shared)), f"id {kind}, score double")
    return out.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                      (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
