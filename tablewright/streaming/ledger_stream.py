"""Streaming ledger (L5): the same rules as the batch fold, one micro-batch at a time.

``transformWithStateInPandas`` keeps (balance, accepted count) of every account in the state store
(RocksDB), by ``BUCKETS`` buckets of accounts: a call to the processor and its few exchanges with the
state store serve all accounts of a bucket, so what a micro-batch costs follows its rows and not the
number of accounts they touch. Each micro-batch hands the processor only that batch's rows of one
bucket; they are sorted by (account, ts, event_id) and folded, account by account, on
top of the stored state. Rows are applied in arrival order across batches:
a row that arrives in a later batch with an older ``ts`` is applied when it
arrives (the stated late-data rule). Rows without ``ts`` come first. With input
delivered in time order the result equals the batch fold, which is its test
oracle. State and offsets live in the checkpoint under the shared folder, so a
stopped or failed run resumes where it left off. ``ledger_stream`` writes its input in files of about
``ROWS_PER_FILE`` rows in time order, a micro-batch takes ``FILES_PER_BATCH`` of them, and so the rows the
processor holds and sorts (one bucket's of one micro-batch) are bounded whatever the backlog and
however hot the account. Ids travel as text, so no value passes through a float; rules that don't depend
on the balance are columns, as in the batch fold.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import ledger as L
from ..session import delete_path, exists, move, scratch_path, set_file_times
from ..sources import fixtures

#: Rows of an input file of ``ledger_stream``, about, and files of a micro-batch.
ROWS_PER_FILE = 100_000
FILES_PER_BATCH = 5
#: Groups that accounts are dealt into by hash; fixed for the life of a checkpoint.
BUCKETS = 512
PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LedgerProcessor(StatefulProcessor):
    """Balances of a bucket's accounts as state; emits every transaction with its outcome."""

    def __init__(self, opening_cents: int):
        self.opening_cents = opening_cents

    def init(self, handle: StatefulProcessorHandle) -> None:
        # Parallel lists, in order of the account.
        self.accounts = handle.getValueState(
            "accounts", "account_id array<long>, balance_cents array<long>, accepted array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        import numpy as np
        import pyarrow as pa

        def numbers_of(column):
            """(numbers, 0 for NULL; which aren't NULL) of a column of texts."""
            found = pa.array(pdf[column], pa.string()).cast(pa.int64())
            return found.fill_null(0).to_numpy(zero_copy_only=False), found.is_valid().to_numpy(zero_copy_only=False)

        pdf = pd.concat(list(rows), ignore_index=True)  # bounded by the micro-batch
        account, _ = numbers_of("account_id")  # rows without an account have a bucket of their own
        # Rows without a time, then without an id, come first.
        order = np.lexsort((*numbers_of("event_id"), pdf["ts"].fillna(pd.Timestamp(0)).to_numpy(),
                            pdf["ts"].notna().to_numpy(), account))
        pdf, account = pdf.iloc[order].reset_index(drop=True), account[order]
        touched, starts = np.unique(account, return_index=True)
        stored = self.accounts.get() or ([], [], [])
        known, balances_of, accepted_of = (np.array(x, np.int64) for x in stored)
        ids = np.union1d(known, touched)
        balance, accepted = np.full(len(ids), self.opening_cents, np.int64), np.zeros(len(ids), np.int64)
        at = np.searchsorted(ids, known)
        balance[at], accepted[at] = balances_of, accepted_of
        delta, debit, counted = pdf["delta"].to_numpy(np.int64), pdf["debit"].to_numpy(bool), pdf["counted"].to_numpy(bool)
        short, balances, numbers = np.zeros(len(pdf), bool), np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for k, start, end in zip(np.searchsorted(ids, touched).tolist(), starts.tolist(), [*starts[1:].tolist(), len(pdf)]):
            of = slice(start, end)
            short[of], balances[of], numbers[of], balance[k], accepted[k] = L.fold_run(
                delta[of], debit[of], counted[of], int(balance[k]), int(accepted[k]))
        self.accounts.update((ids.tolist(), balance.tolist(), accepted.tolist()))
        outcome = pdf["rule"].where(~short, L.INSUFFICIENT)
        yield pdf.assign(outcome=outcome, balance_cents=balances,
                         accepted_no=pd.Series(numbers).astype("Int64").where(counted & ~short))[
            ["account_id", "ts", "event_id", "txn_type", "amount_cents", "network_choice",
             "outcome", "balance_cents", "accepted_no"]]

    def close(self) -> None:
        pass


def bucket_of(account: str, buckets: int) -> F.Column:
    """The bucket of an account; rows without one form a ledger, and a bucket, of their own."""
    return F.when(F.col(account).isNull(), -1).otherwise(F.pmod(F.xxhash64(account), F.lit(buckets))).cast("int")


def ledger_outcomes_stream(txns: DataFrame, opening_balance: str) -> DataFrame:
    """Streaming DataFrame of outcomes from a streaming DataFrame of transactions."""
    ids = ["account_id", "event_id"]
    rows = L.with_rules(L.fold_input(txns)).withColumn("bucket", bucket_of("account_id", BUCKETS))
    text = rows.withColumns({c: F.col(c).cast("string") for c in ids})
    schema = L.FOLD_SCHEMA.replace("account_id long", "account_id string").replace("event_id long", "event_id string")
    out = text.groupBy("bucket").transformWithStateInPandas(
        LedgerProcessor(L.cents(opening_balance)), schema, "Append", "None")
    return out.withColumns({c: F.col(c).cast("long") for c in ids})


def write_in_order(events: DataFrame, path: str, files: int) -> None:
    """``events`` as one file a folder ``_slice=0``, ``_slice=1``, ..: consecutive ranges of (ts, event_id)."""
    (events.repartitionByRange(files, "ts", "event_id").withColumn("_slice", F.spark_partition_id())
     .write.partitionBy("_slice").parquet(path))


def run_ledger_stream(spark: SparkSession, events_dir: str, events_schema, out_dir: str,
                      checkpoint_dir: str, opening_balance: str, max_files: int = 1) -> None:
    """Process every file that has arrived in ``events_dir`` since the last run, oldest first.

    ``availableNow`` runs the query to the end of the current input, in micro-batches of at
    most ``max_files`` files, and stops; the next run resumes from the checkpoint (offsets and
    per-account state). The state store's kind is set in a session of the query's own, and so are the
    partitions: a micro-batch is of bounded size, so more of them than cores only add state stores to
    open and commit.
    """
    own = spark.newSession()
    own.conf.set(PROVIDER_CONF, ROCKSDB)
    partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    own.conf.set("spark.sql.shuffle.partitions", max(1, partitions))
    events = (own.readStream.schema(events_schema).option("recursiveFileLookup", True)
              .option("maxFilesPerTrigger", max_files).option("maxFileAge", "36500d").parquet(events_dir))
    txns = own.sql(fixtures.RECIPES["ledger_txns"], events=events)
    query = (ledger_outcomes_stream(txns, opening_balance).writeStream
             .format("parquet").option("path", out_dir)
             .option("checkpointLocation", checkpoint_dir)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()


def ledger_stream(spark: SparkSession, sf_dir: str, slices: int | None = None, arrivals: int = 1) -> DataFrame:
    """Outcomes of every transaction, computed by the streaming ledger.

    The events are written once, as files of about ``ROWS_PER_FILE`` rows in time order, whose modification
    times say so too; a micro-batch takes ``FILES_PER_BATCH`` of them. (With ``slices`` it is that many
    files, one a micro-batch.) They arrive in ``arrivals`` moves; after each the
    stream is run until it has caught up, then stopped, and the next run resumes from its checkpoint.
    """
    events = fixtures.table(spark, sf_dir, "events")
    staged = scratch_path(spark, "ledger_stream_staged")
    incoming = scratch_path(spark, "ledger_stream_in")
    out = scratch_path(spark, "ledger_stream_out")
    ckpt = scratch_path(spark, "ledger_stream_ckpt")
    files = slices or max(1, math.ceil(events.count() / ROWS_PER_FILE))
    write_in_order(events, staged, files)
    first = int(time.time()) - files  # a second apart, all in the past
    for arrival in range(arrivals):
        moved = False
        for k in range(files * arrival // arrivals, files * (arrival + 1) // arrivals):
            if move(spark, f"{staged}/_slice={k}", f"{incoming}/{k}"):
                set_file_times(spark, f"{incoming}/{k}", 1000 * (first + k))
                moved = True
        if moved:
            run_ledger_stream(spark, incoming, events.schema, out, ckpt, fixtures.LEDGER_OPENING_BALANCE,
                              max_files=1 if slices else FILES_PER_BATCH)
    delete_path(spark, staged)
    delete_path(spark, incoming)
    delete_path(spark, ckpt)
    folded = spark.createDataFrame([], L.FOLD_SCHEMA)
    schema = folded.schema
    return L.from_cents(spark.read.schema(schema).parquet(out) if exists(spark, out) else folded)
