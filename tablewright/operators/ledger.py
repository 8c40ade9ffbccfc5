"""Account ledger with rejected transactions.

A rejected debit leaves the balance unchanged, so the balance is a fold over each account's
transactions in time order, not a running sum. Rules that don't depend on the balance are
columns; the fold sees cents to add and whether funds are needed. Amounts are integer cents,
so every balance is exact.

Rows are hash-partitioned by (account, chunk), sorted inside each partition (the sort spills)
and folded in one pass over the sorted Arrow batches, with running sums between refused debits.
An account of at most ``HOT_ROWS`` rows is one chunk. A larger one is cut into ``CHUNKS`` time ranges
(quantiles of its own times), which are folded in parallel by *composition*:

1. each chunk becomes the function from its opening to its closing balance. A debit maps b to
   b - a where b >= a and to b elsewhere, so a chunk's function is a list of input ranges, each with
   what is added to the balance and how many rows are accepted;
2. the functions of an account are applied one after the other, a lookup each, which gives the
   opening of every chunk;
3. every chunk is folded from its opening, independently of the others.

A function of more than ``PIECES`` ranges is closed and followed by another one of the same chunk, so
a summary stays small whatever the rows are.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The airtime networks, option 1..4 in menu order.
NETWORKS = ["MTN", "Airtel", "Glo", "9mobile"]

DEPOSIT, TRANSFER, AIRTIME, ENQUIRY = "deposit", "transfer", "airtime", "enquiry"
DEBITS = (TRANSFER, AIRTIME)

ACCEPTED = "accepted"
INVALID_AMOUNT = "invalid_amount"
INSUFFICIENT = "insufficient_funds"
INVALID_NETWORK = "invalid_network"
NO_CHANGE = "enquiry"

FOLD_SCHEMA = ("account_id long, ts timestamp_ntz, event_id long, txn_type string, "
               "amount_cents long, network_choice int, outcome string, balance_cents long, "
               "accepted_no long")


def outcome_of(txn_type: str, amount_cents, network_choice, balance_cents: int) -> str:
    """The menu's checks, in its order: network, then amount, then funds."""
    if txn_type == ENQUIRY:
        return NO_CHANGE
    if txn_type == AIRTIME and not (network_choice is not None
                                    and 1 <= network_choice <= len(NETWORKS)):
        return INVALID_NETWORK
    if amount_cents is None or amount_cents <= 0:
        return INVALID_AMOUNT
    if txn_type in DEBITS and amount_cents > balance_cents:
        return INSUFFICIENT
    return ACCEPTED


#: Rows that are summed at once; a refused debit starts the sum anew behind it.
RUN = 1024
#: Rows from which an account is cut into chunks, how many, and the most ranges of a chunk's function.
HOT_ROWS = 200_000
CHUNKS = 256
PIECES = 2048
LOWEST = -(1 << 62)


def checked(types: list, amounts: list, networks: list) -> tuple[list, list]:
    """(outcome, cents to add) of each row as far as they don't depend on the balance: rows
    that only lack funds, if anything, are ACCEPTED here."""
    outcomes, deltas = [], []
    for kind, amount, network in zip(types, amounts, networks):
        out = outcome_of(kind, amount, network, amount if amount is not None else 0)
        outcomes.append(out)
        deltas.append(0 if out != ACCEPTED else amount if kind == DEPOSIT else -amount)
    return outcomes, deltas


def fold_account(types: list, amounts: list, networks: list, balance: int, accepted: int) -> tuple:
    """(outcomes, balances, accepted numbers, balance, accepted) of one account's rows in order."""
    import numpy as np
    outcomes, deltas = checked(types, amounts, networks)
    counted = np.array([o == ACCEPTED for o in outcomes], bool)
    debit = counted & np.array([kind in DEBITS for kind in types], bool)
    short, balances, numbers, balance, accepted = fold_run(np.array(deltas, np.int64), debit, counted, balance, accepted)
    for k in np.flatnonzero(short).tolist():
        outcomes[k] = INSUFFICIENT
    numbered = [int(k) if c else None for k, c in zip(numbers, counted & ~short)]
    return outcomes, balances, numbered, balance, accepted


def fold_run(delta, debit, counted, balance: int, accepted: int) -> tuple:
    """(refused, balances, accepted numbers, balance, accepted) of one account's rows in order.

    ``counted`` rows are accepted unless they are debits that lack funds. Balances are running
    sums up to the first such debit; that one is refused and the sums go on behind it.
    """
    import numpy as np
    n, at = len(delta), 0
    short, balances = np.zeros(n, bool), np.empty(n, np.int64)
    while at < n:
        end = min(n, at + RUN)
        sums = balance + np.cumsum(delta[at:end])
        lacking = np.flatnonzero((sums < 0) & debit[at:end])
        if len(lacking):
            end = at + int(lacking[0])
            short[end] = True
        balances[at:end] = sums[:end - at]
        if end > at:
            balance = int(sums[end - at - 1])
        if len(lacking):
            balances[end] = balance
            end += 1
        at = end
    numbers = accepted + np.cumsum(counted & ~short)
    return short, balances, numbers, balance, int(numbers[-1]) if n else accepted


class Composed:
    """The function of rows applied in order: on the input range that starts at ``low[k]``,
    ``add[k]`` is added to the balance and ``count[k]`` rows are accepted."""

    def __init__(self):
        import numpy as np
        self.low, self.add, self.count = np.array([LOWEST]), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def apply(self, delta: int, debit: bool) -> None:
        """Put a row that may be accepted behind those before it."""
        import numpy as np
        if not debit:
            self.add = self.add + delta
            self.count = self.count + 1
            return
        # The range's balances that cover the debit start at -delta; a range is split there.
        split = np.maximum(self.low, -delta - self.add)
        high = np.append(self.low[1:], 1 << 62)
        refused, taken = split > self.low, split < high
        low = np.concatenate([self.low[refused], split[taken]])
        add = np.concatenate([self.add[refused], self.add[taken] + delta])
        count = np.concatenate([self.count[refused], self.count[taken] + 1])
        order = np.argsort(low, kind="stable")
        low, add, count = low[order], add[order], count[order]
        new = np.concatenate([[True], (add[1:] != add[:-1]) | (count[1:] != count[:-1])])
        self.low, self.add, self.count = low[new], add[new], count[new]

    def of(self, balance: int) -> tuple[int, int]:
        """(balance behind the rows, accepted rows)."""
        import numpy as np
        k = int(np.searchsorted(self.low, balance, "right")) - 1
        return balance + int(self.add[k]), int(self.count[k])


def _spans(batch, names):
    """(start, end) of the runs of rows that agree in integer columns ``names``; NULL equals NULL."""
    import numpy as np
    import pyarrow.compute as pc
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for name in names:
        column = batch.column(name)
        null = column.is_null().to_numpy(zero_copy_only=False)
        values = pc.fill_null(column, 0).to_numpy(zero_copy_only=False)
        new[1:] |= (values[1:] != values[:-1]) | (null[1:] != null[:-1])
    starts = np.flatnonzero(new).tolist()
    return list(zip(starts, [*starts[1:], batch.num_rows]))


def _numbers(batch):
    """(cents to add, needs funds, may be accepted) of a batch's rows."""
    return (batch.column("delta").to_numpy(), *(batch.column(c).to_numpy(zero_copy_only=False)
                                                for c in ("debit", "counted")))


def _fold(opening_cents: int):
    """Batches sorted by (account, chunk, ts, event): ids and times pass through as Arrow, untouched.

    Transactions without an account form one ledger of their own.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa
        current, balance, accepted = object(), opening_cents, 0
        for batch in batches:
            delta, debit, counted = _numbers(batch)
            short, balances, numbers = np.zeros(batch.num_rows, bool), [], []
            for at, end in _spans(batch, ["account_id", "chunk"]):
                key = batch.column("account_id")[at].as_py(), batch.column("chunk")[at].as_py()
                if key != current:
                    current = key
                    opening = batch.column("opening")[at].as_py()
                    balance, accepted = (opening_cents, 0) if opening is None else (opening, batch.column("before")[at].as_py())
                short[at:end], held, number, balance, accepted = fold_run(
                    delta[at:end], debit[at:end], counted[at:end], balance, accepted)
                balances.append(held)
                numbers.append(number)
            rule = batch.column("rule")
            outcome = pa.compute.if_else(pa.array(short), INSUFFICIENT, rule)
            passed = ["account_id", "ts", "event_id", "txn_type", "amount_cents", "network_choice"]
            done = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (balances, numbers)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in passed], outcome, pa.array(done[0]), pa.array(done[1], mask=~counted | short)],
                [*passed, "outcome", "balance_cents", "accepted_no"])
    return run


def _summaries(batches):
    """Batches sorted by (account, chunk, ts, event) -> (account_id, chunk, part, low, add, count): the
    functions of every chunk, in order of ``part``."""
    import pyarrow as pa
    current, part, held = None, 0, None

    def closed():
        return pa.RecordBatch.from_arrays(
            [pa.array([current[0]], pa.int64()), pa.array([current[1]], pa.int32()), pa.array([part], pa.int32()),
             *[pa.array([x.tolist()], pa.list_(pa.int64())) for x in (held.low, held.add, held.count)]],
            ["account_id", "chunk", "part", "low", "add", "count"])

    for batch in batches:
        delta, debit, counted = _numbers(batch)
        for at, end in _spans(batch, ["account_id", "chunk"]):
            key = batch.column("account_id")[at].as_py(), batch.column("chunk")[at].as_py()
            if key != current:
                if held is not None:
                    yield closed()
                current, part, held = key, 0, Composed()
            for d, needs, may in zip(delta[at:end].tolist(), debit[at:end].tolist(), counted[at:end].tolist()):
                if may:
                    held.apply(d, needs)
                    if len(held.low) > PIECES:
                        yield closed()
                        part, held = part + 1, Composed()
    if held is not None:
        yield closed()


def _openings(opening_cents: int):
    """Summaries sorted by (account, chunk, part) -> (account_id, chunk, opening, before) of every chunk."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        account, balance, accepted = object(), opening_cents, 0
        step = Composed()
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["account_id"] != account:
                    account, balance, accepted = r["account_id"], opening_cents, 0
                if r["part"] == 0:
                    out.append((account, r["chunk"], balance, accepted))
                step.low, step.add, step.count = (np.array(r[c], np.int64) for c in ("low", "add", "count"))
                balance, taken = step.of(balance)
                accepted += taken
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("account_id", "chunk", "opening", "before"), x)) for x in out],
                pa.schema([("account_id", pa.int64()), ("chunk", pa.int32()), ("opening", pa.int64()), ("before", pa.int64())]))
    return run


def cents(opening_balance: str) -> int:
    return int(Decimal(opening_balance) * 100)


def fold_input(txns: DataFrame) -> DataFrame:
    """The columns the fold reads, amounts in integer cents."""
    return txns.select(
        "account_id", "ts", "event_id", "txn_type",
        (F.col("amount") * 100).cast("long").alias("amount_cents"),
        F.col("network_choice").cast("int").alias("network_choice"))


def with_rules(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rule`` (the outcome unless funds lack), ``counted`` (accepted unless funds
    lack), ``debit`` (needs funds) and ``delta`` (cents to add); the menu's checks, in its order."""
    kind, amount = F.coalesce("txn_type", F.lit("")), F.col("amount_cents")
    listed = F.coalesce(F.col("network_choice").between(1, len(NETWORKS)), F.lit(False))
    rule = (F.when(kind == ENQUIRY, NO_CHANGE).when((kind == AIRTIME) & ~listed, INVALID_NETWORK)
            .when(amount.isNull() | (amount <= 0), INVALID_AMOUNT).otherwise(ACCEPTED))
    rows = rows.withColumn("rule", rule).withColumn("counted", F.col("rule") == ACCEPTED)
    return (rows.withColumn("debit", F.col("counted") & kind.isin(*DEBITS))
            .withColumn("delta", F.when(F.col("counted"), F.when(kind == DEPOSIT, amount).otherwise(-amount)).otherwise(F.lit(0))
                        .cast("long")))


def with_chunks(rows: DataFrame, hot_rows: int, chunks: int) -> DataFrame:
    """``rows`` with ``hot`` (an account of more than ``hot_rows`` rows) and ``chunk``: its time range, else 0."""
    hot = rows.groupBy("account_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    hot = hot.select(F.col("account_id").alias("_hot"))
    at = F.col("ts").cast("timestamp").cast("double")
    probs = [k / chunks for k in range(1, chunks)]
    borders = (rows.join(hot, F.col("account_id").eqNullSafe(F.col("_hot"))).groupBy("account_id")
               .agg(F.percentile_approx(at, probs, 4 * chunks).alias("_borders"))
               .select(F.col("account_id").alias("_hot"), "_borders"))
    # At most rows / hot_rows accounts; the planner broadcasts them if they are few.
    rows = rows.join(borders, F.col("account_id").eqNullSafe(F.col("_hot")), "left")
    chunk = F.size(F.filter("_borders", lambda b: b < at))
    return (rows.withColumn("hot", F.col("_borders").isNotNull())
            .withColumn("chunk", F.when(F.col("hot") & at.isNotNull(), chunk).otherwise(0).cast("int")).drop("_hot", "_borders"))


def fold(txns: DataFrame, opening_balance: str, partitions: int | None = None,
         hot_rows: int = HOT_ROWS, chunks: int = CHUNKS) -> DataFrame:
    """Outcome, balance after, and accepted number of every transaction.

    ``txns``: account_id, ts, event_id, txn_type, amount (decimal), network_choice.
    """
    rows = with_chunks(with_rules(fold_input(txns)), hot_rows, chunks)
    key = ["account_id", "chunk"]

    def dealt(df, *names):
        # Without a fixed count AQE may merge small partitions.
        return df.repartition(partitions, *names) if partitions else df.repartition(*names)

    large = rows.where("hot")
    summaries = dealt(large.select(*key, "ts", "event_id", "delta", "debit", "counted"), *key).sortWithinPartitions(
        *key, "ts", "event_id").mapInArrow(
            _summaries, "account_id long, chunk int, part int, low array<long>, add array<long>, count array<long>")
    openings = (summaries.repartition("account_id").sortWithinPartitions("account_id", "chunk", "part")
                .mapInArrow(_openings(cents(opening_balance)), "account_id long, chunk int, opening long, before long")
                .withColumnsRenamed({"account_id": "_account", "chunk": "_chunk"}))
    rows = rows.join(openings, F.col("account_id").eqNullSafe(F.col("_account")) & (F.col("chunk") == F.col("_chunk")), "left")
    ordered = dealt(rows.drop("_account", "_chunk"), *key).sortWithinPartitions(*key, "ts", "event_id")
    return from_cents(ordered.mapInArrow(_fold(cents(opening_balance)), schema=FOLD_SCHEMA))


def from_cents(folded: DataFrame) -> DataFrame:
    return folded.select(
        "account_id", "ts", "event_id", "txn_type",
        cents_to_money("amount_cents", "decimal(12,2)").alias("amount"),
        "network_choice", "outcome",
        cents_to_money("balance_cents").alias("balance"), "accepted_no")


def cents_to_money(c: str, dtype: str = "decimal(18,2)"):
    return (F.col(c).cast("decimal(20,0)") / F.lit(100)).cast(dtype)


def final_balances(folded: DataFrame) -> DataFrame:
    """Last balance per account, plus counts; shown with 2 decimals."""
    last = F.max_by("balance", F.struct("ts", "event_id"))
    return (folded.groupBy("account_id")
            .agg(F.count(F.lit(1)).alias("transactions"),
                 F.count(F.when(F.col("outcome") == ACCEPTED, 1)).alias("accepted"),
                 last.alias("balance"))
            .withColumn("balance_text", F.format_number("balance", 2)))


def money_text(c) -> F.Column:
    return F.concat(F.lit("₦"), F.format_number(c, 2))


def history(folded: DataFrame, networks: DataFrame) -> DataFrame:
    """Accepted transactions numbered from 1 per account, with the menu's text."""
    acc = folded.filter(F.col("outcome") == ACCEPTED)
    acc = acc.join(F.broadcast(networks), acc["network_choice"] == networks["option"], "left")
    text = (F.when(F.col("txn_type") == DEPOSIT, F.concat(F.lit("Deposited "), money_text("amount")))
            .when(F.col("txn_type") == TRANSFER, F.concat(F.lit("Transferred "),
                                                          money_text("amount")))
            .otherwise(F.concat(F.lit("Bought "), money_text("amount"), F.lit(" airtime on "),
                                F.col("network"))))
    return acc.select("account_id", F.col("accepted_no").alias("history_no"), "event_id",
                      "txn_type", "amount", text.alias("description"),
                      F.concat(F.col("accepted_no").cast("string"), F.lit(". "), text)
                      .alias("entry"))


def network_table(spark) -> DataFrame:
    """The 4-row reference list of airtime networks (size fixed, safe to broadcast)."""
    return spark.createDataFrame([(i + 1, n) for i, n in enumerate(NETWORKS)],
                                 "option int, network string")


def network_check(txns: DataFrame, networks: DataFrame) -> DataFrame:
    """Airtime requests with the chosen network, or rejected when not in the list."""
    air = txns.filter(F.col("txn_type") == AIRTIME)
    joined = air.join(F.broadcast(networks), air["network_choice"] == networks["option"], "left")
    return joined.select("account_id", "event_id", "network_choice", "network",
                         F.col("network").isNotNull().alias("valid"))
