"""The banking menu's data rules as ledger reports over the events table.

The interactive menu is not rebuilt (see README); its rules are: a deposit
or debit of zero or less is invalid, a debit above the balance is refused
and leaves the balance unchanged, airtime needs a listed network, and the
history lists accepted transactions numbered from 1.
"""

from __future__ import annotations


from ..operators import ledger as L
from ..sources import fixtures
from ..streaming.ledger_stream import ledger_stream
from .cache import cached

OPENING = fixtures.LEDGER_OPENING_BALANCE


def txns(spark, sf_dir):
    return fixtures.fixture(spark, sf_dir, "ledger_txns")


def folded(spark, sf_dir):
    return cached(spark, ("ledger_fold", sf_dir), lambda: L.fold(txns(spark, sf_dir), OPENING))


REPORTS = {
    "ledger_outcomes": lambda s, d: folded(s, d),
    "ledger_balance": lambda s, d: L.final_balances(folded(s, d)),
    "ledger_history": lambda s, d: L.history(folded(s, d), L.network_table(s)),
    "ledger_network_check": lambda s, d: L.network_check(txns(s, d), L.network_table(s)),
    # The streaming ledger must reproduce the batch outcomes row for row.
    "ledger_stream": ledger_stream,
}


# --------------------------------------------------------------- the oracle

_OPEN_CENTS = int(round(float(OPENING) * 100))
_NETS = ", ".join(f"({i + 1}, '{n}')" for i, n in enumerate(L.NETWORKS))

_OUTCOME = (
    "CASE WHEN t.txn_type = 'enquiry' THEN 'enquiry' "
    "WHEN t.txn_type = 'airtime' AND NOT coalesce(t.network_choice BETWEEN 1 AND "
    f"{len(L.NETWORKS)}, false) THEN 'invalid_network' "
    "WHEN t.amount_cents IS NULL OR t.amount_cents <= 0 THEN 'invalid_amount' "
    "WHEN t.txn_type IN ('transfer', 'airtime') AND t.amount_cents > f.balance_cents "
    "THEN 'insufficient_funds' ELSE 'accepted' END")

ORACLE_CTES = f"""
t AS (SELECT account_id, ts, event_id, txn_type, amount, CAST(amount * 100 AS BIGINT) AS amount_cents,
             network_choice,
             row_number() OVER (PARTITION BY account_id ORDER BY ts, event_id) AS rn
      FROM ledger_txns),
fold AS (
  SELECT account_id, CAST(0 AS BIGINT) AS rn, CAST({_OPEN_CENTS} AS BIGINT) AS balance_cents,
         CAST(0 AS BIGINT) AS accepted, CAST(NULL AS VARCHAR) AS outcome
  FROM (SELECT DISTINCT account_id FROM t) a
  UNION ALL
  SELECT t.account_id, t.rn,
         CASE WHEN ({_OUTCOME}) <> 'accepted' THEN f.balance_cents
              WHEN t.txn_type = 'deposit' THEN f.balance_cents + t.amount_cents
              ELSE f.balance_cents - t.amount_cents END,
         f.accepted + CASE WHEN ({_OUTCOME}) = 'accepted' THEN 1 ELSE 0 END,
         {_OUTCOME}
  FROM fold f JOIN t ON t.account_id = f.account_id AND t.rn = f.rn + 1),
outcomes AS (
  SELECT t.account_id, t.ts, t.event_id, t.txn_type, t.amount, t.network_choice, f.outcome,
         CAST(CAST(f.balance_cents AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS balance,
         CAST(CASE WHEN f.outcome = 'accepted' THEN f.accepted END AS BIGINT) AS accepted_no
  FROM fold f JOIN t ON t.account_id = f.account_id AND t.rn = f.rn),
networks AS (SELECT * FROM (VALUES {_NETS}) v(option, network))"""


def _money(c: str) -> str:
    return f"'₦' || format('{{:,.2f}}', CAST({c} AS DOUBLE))"


_DESC = ("CASE WHEN txn_type = 'deposit' THEN 'Deposited ' || " + _money("amount") +
         " WHEN txn_type = 'transfer' THEN 'Transferred ' || " + _money("amount") +
         " ELSE 'Bought ' || " + _money("amount") + " || ' airtime on ' || network END")

ORACLE = {
    "ledger_outcomes": "SELECT * FROM outcomes",
    "ledger_stream": "SELECT * FROM outcomes",
    "ledger_balance": "SELECT account_id, COUNT(*) AS transactions, "
                      "COUNT(CASE WHEN outcome = 'accepted' THEN 1 END) AS accepted, "
                      "arg_max(balance, (ts, event_id)) AS balance, "
                      "format('{:,.2f}', CAST(arg_max(balance, (ts, event_id)) AS DOUBLE)) "
                      "AS balance_text FROM outcomes GROUP BY account_id",
    "ledger_history": f"SELECT account_id, accepted_no AS history_no, event_id, txn_type, "
                      f"amount, {_DESC} AS description, "
                      f"CAST(accepted_no AS VARCHAR) || '. ' || {_DESC} AS entry "
                      "FROM outcomes o LEFT JOIN networks n ON o.network_choice = n.option "
                      "WHERE outcome = 'accepted'",
    "ledger_network_check": "SELECT account_id, event_id, network_choice, network, "
                            "network IS NOT NULL AS valid FROM ledger_txns x "
                            "LEFT JOIN networks n ON x.network_choice = n.option "
                            "WHERE txn_type = 'airtime'",
}


def oracle_sql(key: str) -> str:
    return fixtures.duckdb_with(["ledger_txns"], ORACLE[key], extra=ORACLE_CTES, recursive=True)


def queries():
    return {key: (fn, oracle_sql(key)) for key, fn in REPORTS.items()}
