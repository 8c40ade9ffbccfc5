"""Mixing sources to target weights: budgets down a domain-language-source tree.

Supply is counted in tokens (words between ASCII white space) per leaf and summed up the
tree. The budget goes down it: at every node the children get shares by weight, a child
never more than its capacity (supply times ``max_epochs``), and what a child can't take goes
to its siblings by weight. Because a node asks its parent for no more than the capacity of
its whole subtree, a shortage is first met among siblings and only what a whole family
lacks reaches the next level up. All amounts are integers (whole tokens, rounded down), so
the plan doesn't depend on partitioning or on the order of sums.

Each leaf then takes whole epochs of its documents plus a prefix of the next one: documents
in the order of md5(seed, epoch, document), up to and including the one that reaches the
budget. A leaf may hold a third of all rows, so the prefix isn't found by sorting the leaf: tokens
are summed per leaf and hash bucket (4,096), whole buckets before the boundary are taken, and
only the one bucket of a leaf that holds the boundary is ordered.

Defined results: null domain, language or source is a leaf of its own; null or empty text
has no tokens and is never taken in a partial epoch beyond its place in the order (it costs
nothing); rows with the same id and text share their place in the order and are taken by
their other columns' order; a leaf without tokens gets no budget; an empty table gives an
empty result; columns of the input are carried through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, table, written

LEVELS = ["domain", "lang", "source"]
#: Weights of the registered query; names not listed weigh ``DEFAULT_WEIGHT``.
WEIGHTS = {"domain": {"core": 3, "tail": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}, "source": {}}
DEFAULT_WEIGHT = 1
SEED = 42
MAX_EPOCHS = 4
#: Tokens asked for, as a percentage of the supply.
BUDGET_PERCENT = 100
BUCKET_HEX = 3  # 16 ** 3 buckets of a leaf
DECIMAL = "decimal(38,0)"


def domain_of(source: Column) -> Column:
    """The registered query's domain: the first ten sources are the core."""
    number = F.regexp_extract(source, r"^src(\d)$", 1)
    return F.when(source.isNull(), F.lit(None)).otherwise(F.when(number != "", "core").otherwise("tail"))


def with_leaves(docs: DataFrame, domain: Column, lang: str = "lang", source: str = "source",
                text_col: str = "text", id_col: str = "doc_id", row: Column | None = None) -> DataFrame:
    """(row, domain, lang, source, tokens, key): what planning and selection need."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text))
    return docs.select((row if row is not None else F.struct(id_col)).alias("row"),
                       domain.alias("domain"), F.col(lang).alias("lang"), F.col(source).alias("source"),
                       F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long").alias("tokens"),
                       key.alias("key"))


def weight_of(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = F.lit(DEFAULT_WEIGHT)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level).eqNullSafe(F.lit(name)), w).otherwise(out)
    return out


def share_out(children: DataFrame, parent: list[str]) -> DataFrame:
    """``children`` (columns of ``parent``, budget of the parent, cap, weight) with ``alloc``.

    Water-filling in closed form: children in the order of cap / weight are filled while the
    water level (what is left by weight) covers them; the rest share what is left.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    # Exact comparison of cap / weight needs no fractions: scaled integers, ties by cap.
    order = by.orderBy(F.expr("(cap * 1000000) div greatest(weight, 1)"), "cap", "weight",
                       *[F.col(c).asc_nulls_first() for c in LEVELS if c in children.columns])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_weight = F.sum("weight").over(after)
    filled = (F.col("cap") * F.col("_open") <= F.col("_left") * F.col("weight")).cast("int")
    df = (children.withColumn("_left", left.cast(DECIMAL)).withColumn("_open", open_weight.cast(DECIMAL))
          .withColumn("_full", F.min(filled).over(order)))  # full up to the first that isn't
    # What is left and how much weight is open at the first child that isn't filled.
    df = (df.withColumn("_l", F.max(F.when(F.col("_full") == 0, F.col("_left"))).over(by))
          .withColumn("_o", F.max(F.when(F.col("_full") == 0, F.col("_open"))).over(by)))
    level = F.expr(f"CAST(greatest(_l, 0) * weight AS {DECIMAL}) div CAST(_o AS {DECIMAL})")
    return (df.withColumn("alloc", F.when(F.col("_full") == 1, F.col("cap").cast("long"))
                          .otherwise(F.least(F.col("cap").cast("long"), level.cast("long"))))
            .drop("_left", "_open", "_full", "_l", "_o"))


def budgets(supply: DataFrame, weights: dict[str, dict[str, int]], budget_percent: int = BUDGET_PERCENT,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(domain, lang, source, supply, alloc) of every leaf, from (domain, lang, source, supply)."""
    nodes = {}
    # A weight of 0, of a leaf or above it, takes nothing: its supply isn't offered to its ancestors.
    open_leaf = weight_of(LEVELS[0], weights) * weight_of(LEVELS[1], weights) * weight_of(LEVELS[2], weights) > 0
    supply = supply.withColumn("offer", F.when(open_leaf, F.col("supply")).otherwise(0))
    for depth in (1, 2, 3):
        path = LEVELS[:depth]
        nodes[depth] = (supply.groupBy(*path).agg(F.sum("supply").cast(DECIMAL).alias("supply"),
                                                    (F.sum("offer") * max_epochs).cast(DECIMAL).alias("cap"))
                        .withColumn("weight", weight_of(path[-1], weights).cast(DECIMAL)))
    total = F.sum("supply").over(Window.partitionBy(F.lit(0)))  # over the few domains
    top = (nodes[1].withColumn("budget", total)
           .withColumn("budget", F.expr(f"(budget * {budget_percent}) div 100").cast(DECIMAL)))
    out = share_out(top, [])
    for depth in (2, 3):
        parent = LEVELS[:depth - 1]
        up = out.select(*[F.col(c).alias(f"_{c}") for c in parent], F.col("alloc").cast(DECIMAL).alias("budget"))
        on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in parent]
        children = nodes[depth].join(up, on).drop(*[f"_{c}" for c in parent])
        out = share_out(children, parent)
    return out.select(*LEVELS, F.col("supply").cast("long").alias("supply"), "alloc")


def order_key(seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.col("key")))


def select(leaves: DataFrame, weights: dict[str, dict[str, int]], budget_percent: int = BUDGET_PERCENT,
           max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``leaves`` with ``copies`` (how often a row is taken; rows that aren't taken are gone)."""
    plan = budgets(leaves.groupBy(*LEVELS).agg(F.sum("tokens").alias("supply")), weights,
                   budget_percent, max_epochs).where("supply > 0 AND alloc > 0")
    plan = written(plan.withColumn("epochs", F.expr("alloc div supply"))
                   .withColumn("rest", F.expr("alloc % supply")), "op1-plan")
    limits = plan.select(*[F.col(c).alias(f"_{c}") for c in LEVELS], "epochs", "rest")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LEVELS]
    # The planner broadcasts the plan if it is known to be small; a hot leaf is split otherwise.
    rows = (leaves.join(limits, same).drop(*[f"_{c}" for c in LEVELS])
            .withColumn("place", order_key(seed, F.col("epochs")))
            .withColumn("bucket", F.substring("place", 1, BUCKET_HEX)))
    by_bucket = rows.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("n"), F.max("rest").alias("rest"))
    running = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    edges = (by_bucket.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0)))
             .where("rest > 0 AND before < rest AND before + n >= rest")  # the bucket that holds the boundary
             .groupBy(*LEVELS).agg(F.min(F.struct("bucket", "before")).alias("edge")))
    edges = written(edges.select(*[F.col(c).alias(f"_{c}") for c in LEVELS],
                                 F.col("edge.bucket").alias("edge"), F.col("edge.before").alias("before")),
                    "op1-edges")
    rows = rows.join(edges, same, "left").drop(*[f"_{c}" for c in LEVELS])
    inside = rows.where(F.col("edge").isNull() | (F.col("bucket") != F.col("edge")))
    inside = inside.withColumn("partial", F.coalesce(F.col("bucket") < F.col("edge"), F.lit(False)))
    in_order = (Window.partitionBy(*LEVELS).orderBy("place", "key", F.to_json(F.struct("row")))
                .rowsBetween(Window.unboundedPreceding, -1))
    boundary = (rows.where(F.col("bucket") == F.col("edge"))
                .withColumn("before", F.col("before") + F.coalesce(F.sum("tokens").over(in_order), F.lit(0)))
                .withColumn("partial", F.col("before") < F.col("rest")))
    columns = ["row", *LEVELS, "tokens", (F.col("epochs") + F.col("partial").cast("long")).alias("copies")]
    return inside.select(*columns).unionByName(boundary.select(*columns)).where("copies > 0")


def mix_documents(docs: DataFrame, weights: dict[str, dict[str, int]] | None = None,
                  budget_percent: int = BUDGET_PERCENT) -> DataFrame:
    """The documents of the mix, a row for each copy, all columns as they were."""
    leaves = with_leaves(docs, domain_of(F.col("source")),
                         row=F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    taken = select(leaves, WEIGHTS if weights is None else weights, budget_percent)
    return (taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("row.*"))


def _share_sql(name: str, children: str, parent: list[str]) -> str:
    part = ", ".join(parent) or "1"
    order = f"PARTITION BY {part} ORDER BY (cap * 1000000) // weight, cap, weight, " + ", ".join(
        f"{c} NULLS FIRST" for c in LEVELS[:len(parent) + 1])
    return f"""
{name}_a AS (
  SELECT *, budget - coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS l,
         sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS o FROM {children}),
{name}_b AS (
  SELECT *, min(CASE WHEN cap * o <= l * weight THEN 1 ELSE 0 END)
            OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM {name}_a),
{name}_c AS (
  SELECT *, max(CASE WHEN filled = 0 THEN l END) OVER (PARTITION BY {part}) AS ll,
         max(CASE WHEN filled = 0 THEN o END) OVER (PARTITION BY {part}) AS oo FROM {name}_b),
{name} AS (
  SELECT {', '.join(LEVELS[:len(parent) + 1])}, supply, CAST(CASE WHEN filled = 1 THEN cap
         ELSE least(cap, (greatest(ll, 0) * weight) // oo) END AS HUGEINT) AS alloc FROM {name}_c)"""


def _sql() -> str:
    def weight(level: str) -> str:
        cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS[level].items())
        return f"CAST(CASE {level} {cases} ELSE {DEFAULT_WEIGHT} END AS HUGEINT)" if cases else f"CAST({DEFAULT_WEIGHT} AS HUGEINT)"

    def node(depth: int) -> str:
        path = ", ".join(LEVELS[:depth])
        return (f"SELECT {path}, CAST(sum(tokens) AS HUGEINT) AS supply, CAST(sum(tokens) * {MAX_EPOCHS} AS HUGEINT) AS cap, "
                f"{weight(LEVELS[depth - 1])} AS weight FROM d GROUP BY {path}")

    return f"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN NULL WHEN regexp_matches(source, '^src[0-9]$') THEN 'core' ELSE 'tail' END AS domain,
         lang, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS tokens,
         concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, ''))) AS key
  FROM documents),
n1 AS (SELECT n.*, CAST((SELECT sum(tokens) FROM d) AS HUGEINT) * {BUDGET_PERCENT} // 100 AS budget FROM ({node(1)}) n),{_share_sql('s1', 'n1', [])},
n2 AS (SELECT n.*, s1.alloc AS budget FROM ({node(2)}) n JOIN s1 ON n.domain IS NOT DISTINCT FROM s1.domain),{_share_sql('s2', 'n2', ['domain'])},
n3 AS (SELECT n.*, s2.alloc AS budget FROM ({node(3)}) n JOIN s2 ON n.domain IS NOT DISTINCT FROM s2.domain AND n.lang IS NOT DISTINCT FROM s2.lang),{_share_sql('s3', 'n3', ['domain', 'lang'])},
plan AS (SELECT *, alloc // supply AS epochs, alloc % supply AS rest FROM s3 WHERE supply > 0 AND alloc > 0),
placed AS (
  SELECT d.*, p.epochs, p.rest, md5(concat_ws('|', '{SEED}', CAST(p.epochs AS VARCHAR), key)) AS place
  FROM d JOIN plan p ON d.domain IS NOT DISTINCT FROM p.domain AND d.lang IS NOT DISTINCT FROM p.lang
                    AND d.source IS NOT DISTINCT FROM p.source),
prefix AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, key, doc_id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed)
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS n_tokens,
       CAST(epochs + CASE WHEN before < rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM prefix WHERE epochs + CASE WHEN before < rest THEN 1 ELSE 0 END > 0
"""


SQL = _sql()


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    leaves = written(with_leaves(docs, domain_of(F.col("source")), row=F.struct("doc_id")), "op1-leaves")
    return select(leaves, WEIGHTS).select(F.col("row.doc_id").alias("doc_id"), *LEVELS,
                                          F.col("tokens").alias("n_tokens"), "copies")
