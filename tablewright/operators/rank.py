"""RANK() OVER ([PARTITION BY p] ORDER BY k) over all rows, without one-task windows.

``F.rank().over(Window.orderBy(k))`` sends every row to a single task, and
``Window.partitionBy(p)`` sends every row of a hot ``p`` to one task. Here the rows are cut into
ranges of (p, k) by border keys, shuffled once, and ranked inside their range:

1. borders: a thinned sample of the keys, sorted; at most four a shuffle partition;
2. totals: per range the rows on its lower border, those behind it that share the border's ``p``,
   and those that share the next border's. A scan over the ranges turns them into the number of
   rows of the same ``p`` before each border (a table of one row a border);
3. rows: each finds its range by binary search. On a border its rank is known from the table; behind
   it the rank inside the range and the table's offset add up.

A key with many rows is a border itself, and rows on a border may be ranked anywhere: they are dealt
out by the task they come from, so neither a hot key nor a hot ``p`` meets in one task. The borders
decide where a row is ranked, never its rank.

The result is one lazy plan: borders and totals are scalar subqueries (arrays of bounded length), no
job runs at build, nothing is written, and no join leads back to the rows. The input is read for the
borders, the totals (both only its key columns) and the rows; share it if it is expensive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Keys of the sample a border.
SAMPLE = 16
#: Rows of a task that all pass into the thinning; later ones by halves, quarters, ..
WHOLE = 256


class _Order:
    """SQL comparisons of key structs ``k0, k1, ..``: first the ``parts`` keys of PARTITION BY."""

    def __init__(self, parts: int, descending: list[bool]):
        self.parts, self.descending = parts, [False] * parts + descending

    def same(self, a: str, b: str) -> str:
        return "(" + " AND ".join(f"{a}.k{i} <=> {b}.k{i}" for i in range(len(self.descending))) + ")"

    def same_part(self, a: str, b: str) -> str:
        return "(" + " AND ".join(["true"] + [f"{a}.k{i} <=> {b}.k{i}" for i in range(self.parts)]) + ")"

    def before(self, a: str, b: str) -> str:
        """``a`` sorts strictly before ``b``; a missing value is the least, as in Spark's default orders."""
        out = "false"
        for i, desc in reversed(list(enumerate(self.descending))):
            x, y = (f"{a}.k{i}", f"{b}.k{i}")[::-1 if desc else 1]
            out = f"CASE WHEN {x} <=> {y} THEN {out} ELSE coalesce({x} < {y}, {x} IS NULL) END"
        return out

    def sorted(self, keys: str) -> str:
        return (f"array_sort({keys}, (a, b) -> CASE WHEN {self.before('a', 'b')} THEN -1 "
                f"WHEN {self.before('b', 'a')} THEN 1 ELSE 0 END)")


def _borders(keys: DataFrame, order: _Order, n: int) -> DataFrame:
    """One row: at most ``n`` distinct keys in order, about as many rows between any two."""
    # A row passes with chance 1 / weight, so a task passes on some WHOLE * log2(rows) of them; each
    # cell keeps one, the heavier the likelier.
    thinned = (keys.withColumn("_at", F.monotonically_increasing_id())
               .selectExpr("_key", "xxhash64(_at) AS _h", f"CAST(pow(2, greatest(0, floor(log2("
                           f"((_at & {(1 << 33) - 1}) + 1) / {WHOLE}.0D)))) AS bigint) AS _weight")
               .where("pmod(_h, _weight) = 0")
               .selectExpr("_key", f"pmod(xxhash64(_h, 1), {SAMPLE * n}) AS _cell",
                           f"_weight / (pmod(xxhash64(_h), {1 << 20}) + 1) AS _priority"))
    return (thinned.groupBy("_cell").agg(F.max_by("_key", "_priority").alias("_key"))
            .agg(F.collect_list("_key").alias("_all"))
            .select(F.expr(order.sorted("_all")).alias("_all"))
            .select(F.expr(f"CASE WHEN size(_all) > 0 THEN array_distinct(transform(sequence(1, {n}), i -> get(_all, "
                           f"CAST(i * size(_all) DIV {n + 1} AS int)))) ELSE _all END").alias("_borders")))


def _placed(df: DataFrame, table: str, key: str, order: _Order, steps: int) -> DataFrame:
    """``df`` with ``_slot``: how many borders (``key`` of the entries of ``table``) are not behind ``_key``."""
    df = df.withColumn("_slot", F.lit(0))
    for step in (1 << s for s in reversed(range(steps))):
        beyond = order.before("_key", f"get({table}, _slot + {step - 1}){key}")
        df = df.withColumn("_slot", F.expr(
            f"CASE WHEN _slot + {step} <= size({table}) AND NOT {beyond} THEN _slot + {step} ELSE _slot END"))
    return df


def _offsets(keys: DataFrame, order: _Order, steps: int) -> DataFrame:
    """One row: for each border (slot, key, rows of its ``p`` before it, rows on it), in order."""
    borders = _borders(keys, order, (1 << steps) - 1)
    placed = _placed(keys.withColumn("_borders", borders.scalar()), "_borders", "", order, steps)
    own, following = "get(_borders, _slot - 1)", "get(_borders, _slot)"
    on = f"(_slot > 0 AND {order.same('_key', own)})"
    totals = placed.groupBy("_slot", F.expr(own).alias("_own")).agg(
        F.expr(f"count_if({on})").alias("_on"),
        F.expr(f"count_if(_slot > 0 AND NOT {on} AND {order.same_part('_key', own)})").alias("_behind"),
        F.expr(f"count_if(_slot < size(_borders) AND NOT {on} AND {order.same_part('_key', following)})")
        .alias("_ahead"))
    # From here on at most one row a border.
    by_part = ", ".join(f"_own.k{i}" for i in range(order.parts)) or "true"
    return (totals.selectExpr("*", "lag(_own) OVER (ORDER BY _slot) AS _last",
                              "coalesce(lag(_ahead) OVER (ORDER BY _slot), 0) AS _lead")
            .where("_slot > 0")
            .selectExpr("_slot", "_own", "_on", "_on + _behind AS _own_rows",
                        f"CASE WHEN _last IS NOT NULL AND {order.same_part('_last', '_own')} THEN 0 "
                        "ELSE _lead END AS _lead")
            .selectExpr("_slot", "_own", "_on",
                        f"sum(_lead + _own_rows) OVER (PARTITION BY {by_part} ORDER BY _slot) - _own_rows AS _before")
            .agg(F.expr("sort_array(collect_list(struct(_slot, _own AS key, _before AS before, _on AS on)))")
                 .alias("_offsets")))


def global_rank(df: DataFrame, order: list[tuple[str, bool]], rank_col: str = "rank",
                partition_by: list[str] = (), partitions: int | None = None) -> DataFrame:
    """``df`` plus RANK() OVER (PARTITION BY .. ORDER BY ..) as ``rank_col``; ``order`` lists
    (name, descending).

    BIGINT, as T-SQL types RANK(): a rank can exceed 2^31 on large tables. ``partitions``: how many
    the borders are for, by default the session's shuffle partitions. The columns ``_key``, ``_slot``,
    ``_offsets``, ``_on``, ``_start`` and ``_deal`` must not occur.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = (4 * parts).bit_length() - 1
    names = list(partition_by) + [k for k, _ in order]
    how = _Order(len(partition_by), [d for _, d in order])
    key = F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(names)]).alias("_key")
    offsets = _offsets(df.select(key), how, steps)
    rows = _placed(df.select("*", key, offsets.scalar().alias("_offsets")), "_offsets", ".key", how, steps)
    entry, columns = "get(_offsets, _slot - 1)", [f"`{c}`" for c in df.columns]
    rows = (rows.withColumn("_on", F.expr(f"_slot > 0 AND {how.same('_key', entry + '.key')}"))
            .selectExpr(*columns, "_slot",
                        f"CASE WHEN _on THEN {entry}.before WHEN _slot > 0 AND {how.same_part('_key', entry + '.key')} "
                        f"THEN {entry}.before + {entry}.on ELSE 0 END AS _start",
                        "CASE WHEN _on THEN spark_partition_id() ELSE -1 END AS _deal"))
    window = (Window.partitionBy("_slot", "_deal", *[F.col(f"`{p}`") for p in partition_by])
              .orderBy(*[F.col(f"`{k}`").desc() if d else F.col(f"`{k}`").asc() for k, d in order]))
    # Rows on a border are all alike inside their window, so their rank in it is 1.
    return rows.select(*columns, (F.col("_start") + F.rank().over(window)).cast("bigint").alias(rank_col))
