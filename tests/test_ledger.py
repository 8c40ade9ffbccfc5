"""Ledger rules on hand-made rows, and the stream against the batch fold."""

import datetime as dt
from decimal import Decimal

from tablewright.operators import ledger as L
from tablewright.operators import stats as S

SCHEMA = ("account_id long, ts timestamp_ntz, event_id long, txn_type string, "
          "amount decimal(12,2), network_choice int")


def t(sec):
    return dt.datetime(2024, 1, 1, 0, 0, sec)


def test_rules(spark):
    rows = [(1, t(1), 1, "transfer", Decimal("0.00"), 1),     # zero -> invalid
            (1, t(2), 2, "deposit", Decimal("-5.00"), 1),     # negative -> invalid
            (1, t(3), 3, "transfer", Decimal("50.01"), 1),    # a cent above -> refused
            (1, t(4), 4, "airtime", Decimal("10.00"), 5),     # bad network
            (1, t(5), 5, "transfer", Decimal("50.00"), 1),    # equal to balance -> accepted
            (1, t(6), 6, "enquiry", Decimal("3.00"), 1),
            (1, t(7), 7, "airtime", Decimal("1.00"), 2),      # 0 left -> refused
            (1, t(8), 8, "deposit", Decimal("2.50"), 1),
            (1, t(9), 9, "airtime", Decimal("1.00"), 2),      # smaller debit -> accepted
            (2, t(1), 10, "deposit", Decimal("1.00"), 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.event_id: r for r in L.fold(df, "50.00").collect()}
    assert [out[i].outcome for i in range(1, 10)] == [
        "invalid_amount", "invalid_amount", "insufficient_funds", "invalid_network", "accepted",
        "enquiry", "insufficient_funds", "accepted", "accepted"]
    assert out[5].balance == Decimal("0.00") and out[9].balance == Decimal("1.50")
    assert (out[5].accepted_no, out[8].accepted_no, out[9].accepted_no) == (1, 2, 3)
    assert out[10].balance == Decimal("51.00")
    hist = L.history(L.fold(df, "50.00"), L.network_table(spark)).orderBy("account_id",
                                                                          "history_no").collect()
    assert hist[0].entry == "1. Transferred ₦50.00"
    assert hist[2].entry == "3. Bought ₦1.00 airtime on Airtel"
    bal = {r.account_id: r for r in L.final_balances(L.fold(df, "50.00")).collect()}
    assert bal[1].balance_text == "1.50" and bal[1].accepted == 3


def test_stream_equals_batch(spark):
    from tablewright.streaming.ledger_stream import ledger_stream
    from tablewright.plans import ledger as LP
    sf = "/root/testdata/sf0.001"
    assert sorted(ledger_stream(spark, sf, slices=3).collect()) == sorted(
        LP.folded(spark, sf).collect())


def test_describe_inline_sample(spark):
    df = spark.createDataFrame([(101, 50000), (102, 15000), (103, 2000), (104, 10000),
                                (105, 30000)], "Customer_ID int, Amount int")
    r = S.describe(df, ["Amount"]).first()
    assert (r["count"], r["mean"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]) == (
        5, 21400, 2000, 10000, 15000, 30000, 50000)
    assert abs(r["std"] - 18968.395) < 1e-3


def test_ids_and_accounts_survive(spark):
    big = 9007199254740993  # no float holds it
    rows = [(big, t(1), big, "deposit", Decimal("1.00"), 1), (None, t(1), None, "deposit", Decimal("2.00"), 1),
            (None, t(2), 5, "transfer", Decimal("52.00"), 1), (big, t(2), big + 1, "transfer", Decimal("60.00"), 1),
            (None, t(3), 6, "transfer", Decimal("0.01"), 1), (3, None, 7, "deposit", None, None)]
    out = L.fold(spark.createDataFrame(rows, SCHEMA).repartition(3), "50.00").collect()
    got = {(r.account_id, r.event_id): (r.outcome, r.balance) for r in out}
    assert got == {(big, big): ("accepted", Decimal("51.00")), (big, big + 1): ("insufficient_funds", Decimal("51.00")),
                   (None, None): ("accepted", Decimal("52.00")), (None, 5): ("accepted", Decimal("0.00")),
                   (None, 6): ("insufficient_funds", Decimal("0.00")), (3, 7): ("invalid_amount", Decimal("50.00"))}


def test_runs_equal_a_plain_fold():
    import random
    rnd = random.Random(4)
    for n in (0, 1, 50, 3000):
        rows = [(rnd.choice(["deposit", "transfer", "airtime", "enquiry"]), rnd.choice([None, 0, -5, 3, 40, 900]),
                 rnd.choice([None, 0, 1, 4, 5])) for _ in range(n)]
        balance, accepted, want = 5000, 7, []
        for kind, amount, network in rows:
            out = L.outcome_of(kind, amount, network, balance)
            if out == L.ACCEPTED:
                balance += amount if kind == "deposit" else -amount
                accepted += 1
            want.append((out, balance, accepted if out == L.ACCEPTED else None))
        out, held, numbers, b, k = L.fold_account(*(list(c) for c in zip(*rows)), 5000, 7) if n else L.fold_account([], [], [], 5000, 7)
        assert list(zip(out, held, numbers)) == want and (b, k) == (balance, accepted)


def test_stream_takes_rows_without_time_and_an_empty_table(spark, tmp_path):
    from pyspark.sql import functions as F
    from tablewright.sources import fixtures
    from tablewright.streaming.ledger_stream import ledger_stream
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    part = events.filter("user_id % 7 = 0").withColumn(
        "ts", F.when(F.col("event_id") % 5 == 0, None).otherwise(F.col("ts")))
    part.write.parquet(str(tmp_path / "some/events.parquet"))
    part.limit(0).write.parquet(str(tmp_path / "none/events.parquet"))
    some = ledger_stream(spark, str(tmp_path / "some"), slices=3)
    batch = L.fold(fixtures.fixture(spark, str(tmp_path / "some"), "ledger_txns"), fixtures.LEDGER_OPENING_BALANCE)
    assert sorted(some.collect(), key=str) == sorted(batch.collect(), key=str)
    assert ledger_stream(spark, str(tmp_path / "none")).collect() == []


def _plain(rows, opening):
    """{event: (outcome, balance, number)} by the menu's rules, one row after the other."""
    out, state = {}, {}
    for account, ts, event, kind, amount, network in sorted(
            rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or t(0), r[2])):
        balance, accepted = state.get(account, (opening, 0))
        what = L.outcome_of(kind, None if amount is None else int(amount * 100), network, balance)
        if what == L.ACCEPTED:
            balance += int(amount * 100) * (1 if kind == "deposit" else -1)
            accepted += 1
        state[account] = balance, accepted
        out[event] = what, balance, accepted if what == L.ACCEPTED else None
    return out


def test_hot_account_is_folded_in_chunks(spark):
    import random
    rnd = random.Random(9)
    rows = [(rnd.choice([1, 1, 1, 1, 2, None, None, 3 + k % 40]),
             rnd.choice([None] + [t(0) + dt.timedelta(minutes=rnd.randrange(5000)) for _ in range(60)]), k,
             rnd.choice(["deposit", "transfer", "transfer", "airtime", "enquiry"]),
             rnd.choice([None, Decimal("0.00"), Decimal(rnd.randrange(1, 9000)) / 100]), rnd.choice([None, 1, 4, 5]))
            for k in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = _plain(rows, 5000)
    for hot, pieces in ((10**9, 2048), (500, 2048), (500, 3)):
        old, L.PIECES = L.PIECES, pieces
        try:
            got = L.fold(df, "50.00", hot_rows=hot, chunks=16).collect()
        finally:
            L.PIECES = old
        assert {r.event_id: (r.outcome, int(r.balance * 100), r.accepted_no) for r in got} == want, (hot, pieces)
    chunked = L.with_chunks(L.with_rules(L.fold_input(df)), 500, 16).groupBy("account_id", "chunk").count().collect()
    hot = [r for r in chunked if r.account_id == 1]
    assert len(hot) > 12 and max(r["count"] for r in hot) < 1000  # one account, many tasks
    assert {r.chunk for r in chunked if r.account_id not in (1, 2, None)} == {0}


def test_composed_function_equals_the_fold():
    import random

    import numpy as np
    rnd = random.Random(3)
    for n in (1, 7, 300):
        delta = np.array([rnd.choice([rnd.randrange(1, 400), -rnd.randrange(1, 400)]) for _ in range(n)])
        f = L.Composed()
        for d in delta.tolist():
            f.apply(d, d < 0)
        for balance in [0, 1, 50, 399, 400, 10**6, *rnd.sample(range(5000), 40)]:
            *_, end, taken = L.fold_run(delta, delta < 0, np.ones(n, bool), balance, 0)
            assert f.of(balance) == (end, taken)


def test_stream_in_bounded_batches_resumes(spark, tmp_path, monkeypatch):
    """One account holds most rows; every micro-batch is one small file, and the second run resumes."""
    from pyspark.sql import functions as F
    from tablewright.sources import fixtures
    from tablewright.streaming import ledger_stream as S
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(900)
    events = events.withColumn("user_id", F.when(F.col("event_id") % 3 > 0, 7).otherwise(F.col("user_id")).cast(
        events.schema["user_id"].dataType))
    events.write.parquet(str(tmp_path / "sf/events.parquet"))
    seen, real = [], S.run_ledger_stream

    def counted(spark, events_dir, schema, out, ckpt, opening, max_files=1):
        real(spark, events_dir, schema, out, ckpt, opening, max_files)
        seen.append(max(spark.read.schema(schema).option("recursiveFileLookup", True).parquet(events_dir)
                        .groupBy(F.input_file_name()).count().toPandas()["count"]))

    monkeypatch.setattr(S, "run_ledger_stream", counted)
    got = S.ledger_stream(spark, str(tmp_path / "sf"), slices=6, arrivals=2)
    batch = L.fold(fixtures.fixture(spark, str(tmp_path / "sf"), "ledger_txns"), fixtures.LEDGER_OPENING_BALANCE)
    assert sorted(got.collect(), key=str) == sorted(batch.collect(), key=str)
    assert len(seen) == 2 and max(seen) < 300  # a file, and so a micro-batch, holds a sixth of the rows, about


def test_stream_calls_the_processor_by_bucket(spark, tmp_path, monkeypatch):
    """More accounts than buckets, one of them NULL: a micro-batch is a call per bucket, not per account."""
    import os
    from pyspark.sql import functions as F
    from tablewright.sources import fixtures
    from tablewright.streaming import ledger_stream as S
    monkeypatch.setattr(S, "BUCKETS", 4, raising=False)
    calls = str(tmp_path / "calls")
    os.makedirs(calls)

    class Counting(S.LedgerProcessor):
        def handleInputRows(self, key, rows, timerValues):
            import tempfile
            os.close(tempfile.mkstemp(dir=calls)[0])
            yield from super().handleInputRows(key, rows, timerValues)

    monkeypatch.setattr(S, "LedgerProcessor", Counting)
    kinds = ["signup", "purchase", "click", "purchase"]
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k // 3), k % 61 or None, kinds[k // 61 % 4],
             float(k % 29)) for k in range(600)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    events.write.parquet(str(tmp_path / "sf/events.parquet"))
    got = S.ledger_stream(spark, str(tmp_path / "sf"), slices=2)
    batch = L.fold(fixtures.fixture(spark, str(tmp_path / "sf"), "ledger_txns"), fixtures.LEDGER_OPENING_BALANCE)
    assert sorted(got.collect(), key=str) == sorted(batch.collect(), key=str)
    assert got.filter(F.col("account_id").isNull()).count() == 10
    assert len(os.listdir(calls)) <= 2 * 5
