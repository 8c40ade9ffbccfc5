"""N-gram Jaccard join: shingle sets as count vectors, searched in R-trees, verified exactly.

A document's set holds the 64-bit hashes of its distinct five-word shingles. Hashed into
``GROUPS`` groups, a set becomes a point of counts; the overlap of two sets is at most the sum
of the smaller coordinates, and of a point and a box at most the sum of minima with the
box's upper corner. Sets of sizes m, n link when their overlap is at least 4/9 (m + n).

One tree over all points can't be distributed: boxes of wide nodes are about as large as any
point, so every query would visit every node of its size range. The points are therefore
dealt into cells first, without loss: sets that link share a shingle among the first
n - ceil(0.8 n) + 1 of either in one common order (frequent shingles last), and each of those
shingles is a cell. Every cell gets its own R-tree (leaves packed by size, upper corners per
node), joined with itself by the summed minima.

1. One scan gives each document's set size and 128-bit digest, and counts of frequent shingles;
   equal sets are one from here on.
2. A second scan gives the cells of each set; cells of one are dropped.
3. In each cell, the smallest id is the leader; every set is verified against its leaders.
   Components of these links settle most groups in work linear in their rows, however
   large the group.
4. Cells that still hold several components are searched for pairs of different components only. A
   cell of at most ``LEAF`` sets is a single leaf: its pairs of fitting sizes and places are
   taken as they are. Larger cells get an R-tree; one of more than ``BLOCK`` sets is cut into blocks
   of targets and chunks of queries, each a unit of its own. Pairs that survive are verified; the
   components of all links are the result.

Verification, of leaders' pairs too, first bounds the overlap by the summed minima of both points,
then compares prefixes (linked sets share a stated number of those shingles), then the whole sets, which
a third and fourth scan give for just the documents that are left. Those are told by a Bloom filter of
16 bits an id while they are at most ``BLOOM_IDS`` (32 MB), and by a join with their ids beyond that;
what the filter lets through in vain is dropped by the next join either way.

Defined results: null or empty text has an empty set and links with nothing; fewer than five
words are one shingle; rows with a null id link with nothing; rows that share an id share a
component; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MEMO_LENGTH, discard, freed, runs, slices, table, text_bytes, written
from .components import connected_components

SHINGLE = 5
GROUPS = 64
#: Frequent shingles that are put last in the order; only speed depends on the order.
FREQUENT = 100_000
FREQUENT_LEAST = 16
#: Bytes of texts that are cut into shingles at once.
PIECE_BYTES = 1 << 20
#: Shingles a task gathers before it counts them.
WINDOW = 2_000_000
#: Rows of a frequent shingle's cell that one task sorts.
SALT_ROWS = 200_000
BLOCK = 4096
LEAF = 64
#: Most ids that a filter is broadcast for.
BLOOM_IDS = 1 << 24


# --- shingle sets -------------------------------------------------------------------------

def _pieces(batch):
    """A batch (.., text) in pieces of at most ``BATCH_ROWS`` rows, cut where ``PIECE_BYTES`` of texts are full."""
    import numpy as np
    import pyarrow.compute as pc
    for piece in slices(batch):
        size = pc.binary_length(piece.column(piece.num_columns - 1)).to_numpy().astype(np.int64)
        full = (np.cumsum(size) - size) // PIECE_BYTES
        cuts = [0, *(np.flatnonzero(full[1:] != full[:-1]) + 1).tolist(), piece.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield piece.slice(a, b - a)


def _mixed(codes):
    """64-bit codes mixed in place, one to one."""
    import numpy as np
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        codes ^= codes >> np.uint64(shift)
        codes *= np.uint64(factor)
    codes ^= codes >> np.uint64(31)
    return codes


def _words(data, borders):
    """(starts, ends, words before each border) of the words of texts that lie one after the other."""
    import numpy as np
    filled = (data != 32) & (data - np.uint8(9) > 4)
    first, last = filled.copy(), filled.copy()
    first[1:] &= ~filled[:-1]
    last[:-1] &= ~filled[1:]
    inner = borders[(borders > 0) & (borders < len(data))]  # a word ends with its text
    first[inner], last[inner - 1] = filled[inner], filled[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, borders)


def _word_codes(data, starts, ends):
    """64-bit hashes of words, eight bytes of all of them at a time; long words are hashed one by one."""
    import numpy as np
    import xxhash
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    sizes = ends - starts
    codes = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    left = np.flatnonzero(sizes <= MEMO_LENGTH)
    for done in range(0, MEMO_LENGTH, 8):
        codes[left] = _mixed(codes[left] ^ (eight[starts[left] + done] & masks[np.minimum(sizes[left] - done, 8)]))
        left = left[sizes[left] > done + 8]
        if not len(left):
            break
    for k in np.flatnonzero(sizes > MEMO_LENGTH).tolist():
        codes[k] = xxhash.xxh3_64_intdigest(data[starts[k]:ends[k]])
    return codes


def shingle_sets(texts):
    """Texts (an Arrow array of UTF-8 bytes) to (values, borders): the distinct shingle hashes of text k, in
    order, are values[borders[k]:borders[k + 1]]."""
    import numpy as np
    import pyarrow as pa
    import xxhash
    texts = texts.cast(pa.large_binary())
    _, at, raw = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(raw or b"", np.uint8)[at[0]:at[-1]]
    data = data + (data - np.uint8(65) < 26) * np.uint8(32)  # lower-cases A-Z only
    starts, ends, before = _words(data, at - at[0])
    codes = _word_codes(data, starts, ends)

    n = max(len(codes) - SHINGLE + 1, 0)
    out = codes[:n].copy()
    inside = np.ones(n, bool)
    for k in range(1, SHINGLE):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out += codes[k:k + n]
        over = before[1:] - k  # shingles that begin here reach into the next text
        inside[over[(over >= 0) & (over < n)]] = False
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)

    words = np.diff(before)
    brief = np.flatnonzero((words > 0) & (words < SHINGLE))
    sizes = np.maximum(words - SHINGLE + 1, 0)
    sizes[brief] = 1
    edges = np.concatenate([[0], np.cumsum(sizes)])
    values, long = np.empty(edges[-1], np.uint64), np.ones(edges[-1], bool)
    long[edges[brief]] = False
    values[long] = out[inside]
    for k in brief.tolist():
        values[edges[k]] = xxhash.xxh3_64_intdigest(
            b" ".join(data[starts[w]:ends[w]].tobytes() for w in range(before[k], before[k + 1])))
    for a, b in zip(edges.tolist(), edges[1:].tolist()):
        values[a:b].sort()
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    fresh[edges[:-1][sizes > 0]] = True
    return values[fresh], np.concatenate([[0], np.cumsum(fresh)])[edges]


def _digest(values) -> bytes:
    """128 bits of a set's content."""
    import xxhash
    return xxhash.xxh3_128_digest(values)


def _survey(batches):
    """Rows (kind, a, b, c, d): 0: id, digest, digest, size; 1: shingle, count."""
    import numpy as np
    import pyarrow as pa
    held, total, seen = [], 0, set()

    def batch(kind, a, b, c, d):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind, np.int32)),
             *[x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in (a, b, c, d)]],
            ["kind", "a", "b", "c", "d"])

    def counted():
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts > 3
        values = values[often].view(np.int64)
        held.clear()
        seen.clear()
        return batch(1, values, counts[often], np.zeros_like(values), np.zeros_like(values))

    for whole in batches:
        for piece in _pieces(whole):
            values, borders = shingle_sets(piece.column(1))
            keys, edges = [], borders.tolist()
            for a, b in zip(edges, edges[1:]):
                key = _digest(values[a:b])
                keys.append(key)
                if a < b and key not in seen:
                    seen.add(key)
                    held.append(values[a:b].copy())
                    total += b - a
            halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield batch(0, piece.column(0), halves[:, 0], halves[:, 1], np.diff(borders))
            if total > WINDOW:
                yield counted()
                total = 0
    if held:
        yield counted()


def prefix_size(n: int) -> int:
    """Shingles of a set of ``n`` of which a linked set must hold at least one."""
    return n - -(-4 * n // 5) + 1


def points_of(values, borders):
    """The points of sets; a coordinate over 254 makes all of its point's 255, meaning unbounded."""
    import numpy as np
    n = len(borders) - 1
    groups = (values >> np.uint64(40)).astype(np.int64) % GROUPS
    counts = np.bincount(np.repeat(np.arange(n), np.diff(borders)) * GROUPS + groups, minlength=n * GROUPS).reshape(n, GROUPS)
    counts[(counts > 254).any(axis=1)] = 255
    return counts.astype(np.uint8)


def _cells(frequent):
    """(id, size, counts, cells, salts): the prefix shingles of each distinct set of a task."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        seen = set()
        hot, hot_counts = frequent.value
        top = np.zeros(1 << 20, bool)  # the first 20 bits of all frequent shingles
        top[hot >> np.uint64(44)] = True

        def often_of(values):
            often = np.zeros(len(values), np.int64)
            may = np.flatnonzero(top[values >> np.uint64(44)])
            if len(may):
                at = np.minimum(np.searchsorted(hot, values[may]), len(hot) - 1)
                often[may] = np.where(hot[at] == values[may], hot_counts[at], 0)
            return often

        for whole in batches:
            for piece in _pieces(whole):
                values, borders = shingle_sets(piece.column(1))
                often, edges = often_of(values), borders.tolist()
                rows, orders = [], []
                for k, i in enumerate(piece.column(0).to_pylist()):
                    a, b = edges[k:k + 2]
                    if i is None or a == b:
                        continue
                    key = _digest(values[a:b])
                    if key in seen:  # an equal set of this task stands for it
                        continue
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(key)
                    rows.append(k)  # the values are in order: ties keep it
                    orders.append(a + np.argsort(often[a:b], kind="stable")[:prefix_size(b - a)])
                if rows:
                    ends = np.concatenate([[0], np.cumsum([len(o) for o in orders])])
                    order = np.concatenate(orders)
                    ids = piece.column(0).take(pa.array(rows))
                    spread = ids.to_numpy().astype(np.uint64) * np.uint64(0x9E3779B1) % np.uint64(1 << 31)
                    parts = often[order] // SALT_ROWS + 1
                    salts = np.where(parts > 1, 1 + np.repeat(spread.astype(np.int64), np.diff(ends)) % parts, 0)
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(np.diff(borders)[rows], pa.int32()),
                         pa.array([p.tobytes() for p in points_of(values, borders)[rows]], pa.binary()),
                         _lists(ends, values[order].view(np.int64)), _lists(ends, salts.astype(np.int32))],
                        ["id", "n", "counts", "cells", "salts"])
    return run


def _lists(ends, values):
    import pyarrow as pa
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def may_link(n, pos, m, other):
    """Whether sets of sizes n, m may link if the shingle at these places of their orders is the
    first they share: their sizes are near, and enough shingles are left from it on."""
    import numpy as np
    return ((5 * np.minimum(n, m) >= 4 * np.maximum(n, m))
            & (9 * np.minimum(n - pos, m - other) >= 4 * (n + m)))


def _with_partner(run, n, pos):
    """Rows of runs (of at most ``LEAF`` rows) that may link to another row of their run."""
    import numpy as np
    keep = np.zeros(len(run), bool)
    for k in range(1, LEAF):
        same = np.flatnonzero(run[k:] == run[:-k])
        if not len(same):
            break
        fits = same[may_link(n[same], pos[same], n[same + k], pos[same + k])]
        keep[fits] = keep[fits + k] = True
    return keep


def _shared(batches):
    """Of rows sorted by (cell, salt): those that may link to another one of their cell. In a cell of
    more than ``LEAF`` rows, or a salted one, all are kept for the trees."""
    import numpy as np
    import pyarrow as pa
    held, large = None, None  # the last run, still open; the key of an open run that is kept anyway

    def closed(table, open_end):
        """(rows to emit, rows of the last run to hold) of a table."""
        nonlocal large
        cell, salt = (table.column(k).to_numpy() for k in (0, 1))
        n, pos = (table.column(k).to_numpy().astype(np.int64) for k in (3, 4))
        change = np.flatnonzero((cell[1:] != cell[:-1]) | (salt[1:] != salt[:-1])) + 1
        starts = np.concatenate([[0], change])
        lengths = np.diff(np.concatenate([starts, [len(cell)]]))
        run = np.repeat(np.arange(len(starts)), lengths)
        wide = lengths > LEAF
        if large is not None and large == (cell[0], salt[0]):
            wide[0] = True
        large = None
        keep = (salt > 0) | wide[run]
        small = np.flatnonzero(~keep & (lengths > 1)[run])
        if len(small):
            keep[small] = _with_partner(run[small], n[small], pos[small])
        end = len(cell)
        if open_end:
            if wide[-1]:
                large = (cell[-1], salt[-1])
            else:
                end = int(starts[-1])
        return table.slice(0, end).filter(pa.array(keep[:end])), table.slice(end)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None and held.num_rows:
            table = pa.concat_tables([held, table])
        out, held = closed(table.combine_chunks(), True)
        yield from out.to_batches()
    if held is not None and held.num_rows:
        yield from closed(held.combine_chunks(), False)[0].to_batches()


# --- verification -------------------------------------------------------------------------

def bloom_slots(i, size: int) -> list:
    """Two bit positions of an id, as columns."""
    return [F.pmod(F.xxhash64(F.lit(s), i), F.lit(size)) for s in (1, 2)]


def bloom(ids: DataFrame, column: str) -> tuple[bytes, int] | None:
    """(bit map, its size in bits) of the ids, 16 bits for each, built by an aggregation to 64-bit
    words; None if there are more than ``BLOOM_IDS``."""
    import numpy as np
    count = ids.count()
    if count > BLOOM_IDS:
        return None
    size = 64 * max(1, -(-16 * count // 64))
    bits = ids.select(F.explode(F.array(*bloom_slots(F.col(column), size))).alias("bit"))
    words = (bits.groupBy((F.col("bit") / 64).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("v")).toArrow())
    out = np.zeros(size // 64, np.int64)  # at most this many rows reach the driver
    out[words.column(0).to_numpy()] = words.column(1).to_numpy()
    return out.tobytes(), size


def _of_ids(rows: DataFrame, ids: DataFrame, schema: str) -> DataFrame:
    """The rows whose id is in ``ids`` (id), and perhaps some others."""
    found = bloom(ids, "id")
    if found is None:
        return rows.join(ids.distinct(), "id", "left_semi")
    bits = ids.sparkSession.sparkContext.broadcast(found[0])
    slots = [c.alias(f"_{k}") for k, c in enumerate(bloom_slots(F.col("id"), found[1]))]
    return rows.select(*slots, *rows.columns).mapInArrow(_known(bits), schema)


def _sets(batches):
    """(id, text) -> (id, sorted shingles)."""
    import numpy as np
    import pyarrow as pa
    for whole in batches:
        for piece in _pieces(whole):
            values, borders = shingle_sets(piece.column(1))
            yield pa.RecordBatch.from_arrays([piece.column(0), _lists(borders, values.view(np.int64))], ["id", "values"])


def _known(bits):
    """Rows (slot, slot, ..) whose two bit positions are set, without these."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        words = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            held = np.ones(batch.num_rows, bool)
            for k in (0, 1):
                slot = batch.column(k).to_numpy()
                held &= (words[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
            yield batch.select(list(range(2, batch.num_columns))).filter(pa.array(held))
    return run


def _bounded(batches):
    """Rows (a, b, n_a, n_b, point of a, point of b) -> the (a, b) whose summed minima allow a link."""
    import numpy as np
    import pyarrow as pa
    for batch in batches:
        n, m = (batch.column(k).to_numpy().astype(np.int64) for k in (2, 3))
        x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, GROUPS) for k in (4, 5))
        bound = np.minimum(x, y).sum(axis=1, dtype=np.int64)
        wide = (x == 255).all(axis=1) | (y == 255).all(axis=1)
        yield batch.select([0, 1]).filter(pa.array(wide | (9 * bound >= 4 * (n + m))))


def _within_bound(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The rows of ``pairs`` that the count vectors of both sets let link."""
    side = {k: points.select(F.col("id").alias(k), F.col("n").alias(f"n_{k}"), F.col("counts").alias(f"counts_{k}"))
            for k in "ab"}
    both = pairs.join(side["a"], "a").join(side["b"], "b")
    return both.select("a", "b", "n_a", "n_b", "counts_a", "counts_b").mapInArrow(_bounded, "a long, b long").distinct()


def _with_common_prefix(pairs: DataFrame, cells: DataFrame, rep_of: DataFrame, paths: list[str]) -> DataFrame:
    """The rows of ``pairs`` that share enough of their prefixes.

    Of the o >= 4/9 (m + n) shingles that linked sets share, all but m - o have come up among the
    first p of the one, and all but n - o among the first q of the other: at least the smaller of
    p - (m - o) and q - (n - o) are in both. The prefixes are a fifth of the sets.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    need = written(rep_of.join(ids, "rep"), "op6-need", paths)
    known = _of_ids(cells.select("id", "n", "cells"), need.select("id"), "id long, n int, cells array<long>")
    prefixes = written(known.join(need, "id").groupBy("rep", "n", F.xxhash64("cells").alias("code"))
                       .agg(F.first("cells").alias("cells")).drop("code"), "op6-prefixes", paths)
    side = {k: prefixes.select(F.col("rep").alias(k), F.col("n").alias(f"n_{k}"), F.col("cells").alias(f"cells_{k}"))
            for k in "ab"}
    both = pairs.join(side["a"], "a").join(side["b"], "b")
    overlap = F.ceil(4 * (F.col("n_a") + F.col("n_b")) / F.lit(9))
    least = F.least(*[F.size(f"cells_{k}") - F.col(f"n_{k}") + overlap for k in "ab"])
    return written(both.where(F.size(F.array_intersect("cells_a", "cells_b")) >= least)
                   .select("a", "b").distinct(), "op6-close", paths)


def _verify(texts: DataFrame, cells: DataFrame, points: DataFrame, rep_of: DataFrame, pairs: DataFrame, name: str,
            paths: list[str]) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose whole sets link."""
    spark = pairs.sparkSession
    own: list[str] = []
    pairs = written(_within_bound(pairs, points), "op6-bounded", own)
    pairs = _with_common_prefix(pairs, cells, rep_of, own)
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "op6-ids", own)
    some = _of_ids(texts.where("id IS NOT NULL"), ids, "id long, text binary")
    sets = written(some.mapInArrow(freed(_sets), "id long, values array<long>"), f"{name}-sets", own)
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("values").alias("x")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("values").alias("y")), "b"))
    overlap = F.size(F.array_intersect("x", "y"))
    links = written(both.withColumn("o", overlap)
                    .where(100 * F.col("o") >= 80 * (F.size("x") + F.size("y") - F.col("o")))
                    .select("a", "b").distinct(), f"{name}-links", paths)
    discard(spark, own)
    return links


# --- R-tree ---------------------------------------------------------------------------------

class RTree:
    """Points of counts packed into leaves by size; each node keeps the upper corner and the
    least and largest size below it."""

    def __init__(self, points, sizes):
        import numpy as np
        self.order = np.argsort(sizes, kind="stable")
        self.points, self.sizes = points[self.order].astype(np.int32), sizes[self.order]
        starts = np.arange(0, len(sizes), LEAF)
        self.levels = []  # from the leaves up: (first child, end, corner, least, largest)
        corner = np.maximum.reduceat(self.points, starts, axis=0)
        least, largest = np.minimum.reduceat(self.sizes, starts), np.maximum.reduceat(self.sizes, starts)
        ends = np.minimum(starts + LEAF, len(sizes))
        self.levels.append((starts, ends, corner, least, largest))
        while len(starts) > 1:
            children = len(starts)
            starts = np.arange(0, children, LEAF)
            ends = np.minimum(starts + LEAF, children)
            corner = np.maximum.reduceat(corner, starts, axis=0)
            least, largest = np.minimum.reduceat(least, starts), np.maximum.reduceat(largest, starts)
            self.levels.append((starts, ends, corner, least, largest))

    def search(self, point, size: int):
        """Places (in ``order``) of the points that may overlap enough with the given one."""
        import numpy as np
        unbounded = point[0] == 255 and (point == 255).all()
        nodes = np.arange(len(self.levels[-1][0]))
        for starts, ends, corner, least, largest in reversed(self.levels):
            fits = (4 * least[nodes] <= 5 * size) & (5 * largest[nodes] >= 4 * size)
            if not unbounded:
                bound = np.minimum(corner[nodes], point).sum(axis=1)
                open_node = corner[nodes].max(axis=1) == 255
                need = 4 * (size + np.maximum(least[nodes], -(-4 * size // 5)))
                fits &= open_node | (9 * bound >= need)
            nodes = nodes[fits]
            if not len(nodes):
                return nodes
            nodes = np.concatenate([np.arange(starts[k], ends[k]) for k in nodes])
        if unbounded:
            return nodes
        bound = np.minimum(self.points[nodes], point).sum(axis=1)
        wide = (self.points[nodes] == 255).all(axis=1)
        return nodes[wide | (9 * bound >= 4 * (size + self.sizes[nodes]))]


def _pairs_of(run, i, n, pos, component):
    """Pairs of different components that may link, of rows sorted by run, none of more than ``LEAF`` rows."""
    import numpy as np
    found = [np.zeros((0, 2), np.int64)]
    for k in range(1, LEAF):
        a = np.flatnonzero(run[k:] == run[:-k])
        if not len(a):
            break
        b = a + k
        fits = (component[a] != component[b]) & may_link(n[a], pos[a], n[b], pos[b])
        a, b = a[fits], b[fits]
        found.append(np.stack([np.minimum(i[a], i[b]), np.maximum(i[a], i[b])], 1))
    return np.unique(np.concatenate(found), axis=0)


def _search_leaves(batches):
    """Rows (cell, id, n, pos, component) sorted by cell, none of more than ``LEAF`` rows -> (a, b)."""
    import numpy as np
    import pyarrow as pa
    held = None  # the last cell, still open

    def batch(table):
        cell, i = table.column(0).to_numpy(), table.column(1).to_numpy()
        n, pos = (table.column(k).to_numpy().astype(np.int64) for k in (2, 3))
        pairs = _pairs_of(cell, i, n, pos, table.column(4).to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    for new in batches:
        if not new.num_rows:
            continue
        table = pa.Table.from_batches([new] if held is None else [*held.to_batches(), new]).combine_chunks()
        cell = table.column(0).to_numpy()
        cut = int(np.searchsorted(cell, cell[-1]))
        held = table.slice(cut)
        if cut:
            yield batch(table.slice(0, cut))
    if held is not None:
        yield batch(held)


def _search(batches):
    """Units (cell, block, chunk) with rows (.., query, id, n, pos, component, counts) -> (a, b)."""
    import numpy as np
    import pyarrow as pa
    for unit in runs(batches, 3):
        query, i, n, pos, component = (unit.column(k).to_numpy() for k in range(3, 8))
        n, pos = n.astype(np.int64), pos.astype(np.int64)
        points = np.frombuffer(b"".join(unit.column(8).to_pylist()), np.uint8).reshape(-1, GROUPS)
        targets = np.flatnonzero(query == 0)
        if not len(targets):
            continue
        tree = RTree(points[targets], n[targets])
        found = [np.zeros((0, 2), np.int64)]
        for q in np.flatnonzero(query == 1).tolist():
            t = targets[tree.order[tree.search(points[q].astype(np.int32), int(n[q]))]]
            t = t[may_link(n[t], pos[t], n[q], pos[q]) & (component[t] != component[q])]
            found.append(np.stack([np.minimum(i[t], i[q]), np.maximum(i[t], i[q])], 1))
        pairs = np.unique(np.concatenate(found), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


# --- the join -------------------------------------------------------------------------------

def _frequent(survey: DataFrame):
    """(hashes in order, counts) of the most frequent shingles: a top-k of stated size."""
    import numpy as np
    rows = (survey.where("kind = 1").groupBy("a").agg(F.sum("b").alias("n"))
            .where(F.col("n") >= FREQUENT_LEAST).orderBy(F.desc("n"), "a").limit(FREQUENT).toArrow())
    values = rows.column(0).to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], rows.column(1).to_numpy()[order]


def _units(rows: DataFrame, points: DataFrame, paths: list[str]) -> DataFrame:
    """Rows of the units of all cells of ``rows`` (cell, total, id, n, pos, component) with several components."""
    mixed = (rows.groupBy("cell", "total")
             .agg(F.min_by("component", "id").alias("main"), F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo < hi").select("cell", "main"))
    mixed = written(mixed, "op6-mixed", paths)
    # Only rows outside of the leader's component ask; all rows answer.
    rows = rows.join(mixed, "cell").withColumn("asks", (F.col("component") != F.col("main")).cast("int"))
    asking = written(rows.groupBy("cell").agg(F.sum("asks").alias("asking")), "op6-asking", paths)
    rows = (rows.join(asking, "cell")
            .withColumn("blocks", F.ceil(F.col("total") / BLOCK).cast("int"))
            .withColumn("chunks", F.ceil(F.col("asking") / BLOCK).cast("int"))
            .join(points, ["id", "n"]))
    h = F.xxhash64("id")
    targets = (rows.withColumn("block", F.pmod(h, F.col("blocks")).cast("int"))
               .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("query", F.lit(0)))
    queries = (rows.where("asks = 1").withColumn("chunk", F.pmod(h, F.col("chunks")).cast("int"))
               .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("query", F.lit(1)))
    columns = ["cell", "block", "chunk", "query", "id", "n", "pos", "component", "counts"]
    return targets.select(*columns).unionByName(queries.select(*columns))


def _residual_pairs(shared: DataFrame, leaders: DataFrame, components: DataFrame, points: DataFrame, paths: list[str]) -> DataFrame:
    """(a, b): pairs of different components that share a cell and may link."""
    own: list[str] = []
    rows = written(shared.join(components, F.col("id") == F.col("node"), "left")
                   .select("cell", "id", "n", "pos", F.coalesce("component", "id").alias("component")), "op6-residual", own)
    large = written(leaders.where(F.col("total") > LEAF).select("cell", "total"), "op6-large", own)
    # Cells of one leaf need no points here: their pairs are bounded once, not in every cell.
    leaves = (rows.join(large, "cell", "left_anti").repartition("cell").sortWithinPartitions("cell")
              .mapInArrow(_search_leaves, "a long, b long"))
    order = ["cell", "block", "chunk"]
    trees = (_units(rows.join(large, "cell"), points, own).repartition(*order).sortWithinPartitions(*order)
             .mapInArrow(_search, "a long, b long"))
    pairs = written(leaves.unionByName(trees).distinct(), "op6-pairs", paths)
    discard(shared.sparkSession, own)
    return pairs


def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; kept: the id is its component's."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))
    survey = written(texts.mapInArrow(freed(_survey), "kind int, a long, b long, c long, d long"), "op6-survey")
    members = survey.where("kind = 0").selectExpr("a AS id", "b AS k1", "c AS k2", "d AS n")
    paths: list[str] = []  # tables that the result doesn't need
    reps = written(members.where("id IS NOT NULL AND n > 0").groupBy("k1", "k2")
                   .agg(F.min("id").alias("rep")), "op6-reps", paths)

    frequent = spark.sparkContext.broadcast(_frequent(survey))  # at most FREQUENT pairs of numbers
    cells = written(texts.mapInArrow(
        freed(_cells(frequent)), "id long, n int, counts binary, cells array<long>, salts array<int>"), "op6-cells", paths)
    posts = (cells.select("id", "n", F.posexplode(F.arrays_zip("cells", "salts")).alias("pos", "c"))
             .select(F.col("c.cells").alias("cell"), F.col("c.salts").alias("salt"), "id", "n", "pos"))
    first: list[str] = []
    shared = written(posts.repartition("cell", "salt").sortWithinPartitions("cell", "salt")
                     .mapInArrow(_shared, "cell long, salt int, id long, n int, pos int"), "op6-shared", first)

    # Equal sets of different tasks are one: their smallest id stands for all of them.
    rep_of = written(members.where("id IS NOT NULL AND n > 0").join(reps, ["k1", "k2"])
                     .select("id", "rep").distinct(), "op6-rep-of", paths)
    several = rep_of.groupBy("id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    same_id = rep_of.join(several, "id").where("rep != lo").select(F.col("lo").alias("a"), F.col("rep").alias("b"))
    shared = written(
        shared.join(rep_of, "id").groupBy("cell", F.col("rep").alias("id"), "n")
        .agg(F.min("pos").alias("pos")), "op6-shared-reps", paths)
    discard(spark, first)
    points = written(cells.join(rep_of, "id").select(F.col("rep").alias("id"), "n", "counts").distinct(), "op6-points", paths)

    leaders = written(shared.groupBy("cell").agg(F.min(F.struct("id", "n", "pos")).alias("l"), F.count(F.lit(1)).alias("total"))
                      .where("total > 1").select("cell", F.col("l.id").alias("leader"), F.col("l.n").alias("leader_n"),
                                                 F.col("l.pos").alias("leader_pos"), "total"), "op6-leaders", paths)
    left = F.least(F.col("n") - F.col("pos"), F.col("leader_n") - F.col("leader_pos"))
    near = ((F.col("id") != F.col("leader")) & (5 * F.least("n", "leader_n") >= 4 * F.greatest("n", "leader_n"))
            & (9 * left >= 4 * (F.col("n") + F.col("leader_n"))))  # may_link, as columns
    stars = written(shared.join(leaders.drop("total"), "cell").where(near)
                    .select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct(), "op6-stars", first)
    links = _verify(texts, cells, points, rep_of, stars, "op6-star", paths).unionByName(same_id)
    components = connected_components(links, paths=paths)
    discard(spark, first)

    pairs = _residual_pairs(shared, leaders, components, points, paths)
    if not pairs.isEmpty():
        more = _verify(texts, cells, points, rep_of, pairs, "op6-pair", paths)
        components = connected_components(links.unionByName(more), paths=paths)

    found = written(reps.join(components, F.col("rep") == F.col("node"), "left")
                    .select("k1", "k2", F.coalesce("component", "rep").alias("component")), "op6-found")
    discard(spark, paths)
    component = F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.coalesce("component", "id")).otherwise(F.col("id"))
    return (members.join(found, ["k1", "k2"], "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were: of each group of linked sets the one with
    the smallest id; of equal texts that share this id, the first by the hash of all columns. Rows link
    by their texts alone, so one that only shares its id with another stays; rows without a word and
    those with a null id link with nothing and all stay."""
    spark, paths = docs.sparkSession, []
    several = written(docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id"))
                      .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_id"), "op6-shared-ids", paths)
    if several.isEmpty():
        found = join_documents(docs, id_col, text_col)
        gone = written(found.where("NOT kept").select(F.col("doc_id").alias("_gone")), "op6-gone")
        discard(spark, paths)
        # Few rows as a rule; the planner knows their size.
        return docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")
    # Ids repeat: texts of their own get keys of their own.
    key = F.when(F.col(id_col).isNotNull(), F.xxhash64(F.col(id_col), text_bytes(text_col)))
    found = join_documents(docs.select(key.alias("_key"), F.col(text_col).alias("_text")), "_key", "_text")
    ids = docs.select(key.alias("_key"), F.col(id_col).alias("_id")).distinct()
    rows = written(found.where("n_shingles > 0 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_key"), "component_id")
                   .distinct().join(ids, "_key"), "op6-keys", paths)
    first = rows.groupBy("component_id").agg(F.min(F.struct("_id", "_key")).alias("f")).select(F.col("f._key").alias("_first"))
    gone = written(rows.join(first, F.col("_key") == F.col("_first"), "left_anti").select("_key"), "op6-gone")
    repeats = written(docs.select(key.alias("_key")).groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                      .join(rows, "_key", "left_semi").select("_key"), "op6-repeats")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    left = docs.select(whole.alias("row"), F.xxhash64(whole).alias("code"), key.alias("_key")).join(gone, "_key", "left_anti")
    out = left.join(repeats, "_key", "left_anti").select("row.*")
    once = left.join(repeats, "_key", "left_semi").groupBy("_key").agg(F.min_by("row", "code").alias("row")).select("row.*")
    discard(spark, paths)
    return out.unionByName(once)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(table(spark, sf_dir, "documents"))
