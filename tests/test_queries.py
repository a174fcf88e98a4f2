"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in sorted(Path(FOLDER).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith("op")))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    got = sorted([plain(r[c]) for c in sorted(df.columns)] for r in df.collect())
    found = duck.sql(entry.oracle_sql()[name])
    columns = found.columns
    assert sorted(columns) == sorted(df.columns)
    assert got == sorted([plain(x[columns.index(c)]) for c in sorted(columns)] for x in found.fetchall())


#: Columns that would hold of nothing, or prove nothing, were all their values one; and what each must take.
BOTH = {
    "m1_customer_360": {"has_credit_card": 2, "has_savings": 2, "is_digital_active": 2, "churn_flag": 2, "cross_sell_credit_card_flag": 2, "aum_bucket": 4, "rfm_segment": 5},
    "m4_loan_summary": {"active_loans": 2, "overdue_loans": 2, "written_off_loans": 2, "missed_payment_count": 2, "loan_to_deposit_ratio IS NULL": 2},
    "m5_product_summary": {"cnt_casa_active": 2, "cnt_td_active": 2, "cnt_credit_cards": 2, "cnt_debit_cards": 2, "has_credit_card": 2, "total_cards": 3},
    "m6_transaction_summary": {"acct_credit_count_30d": 2, "card_txn_count_30d": 2, "last_txn_date": 3},
    "m14_loan_delinquency": {"dpd_bucket": 6, "prev_dpd_bucket": 6, "debt_group": 6, "is_npl": 2, "ever_30_plus": 2, "ever_90_plus": 2, "last_due_date IS NULL": 2, "branch_code IS NULL": 2, "months_on_book < 0": 2},
    "m15_loan_portfolio": {"branch_name = 'UNK'": 2, "branch_code IS NULL": 2, "late_payment_rate": 3}, "m20_roll_rate": {"from_bucket": 5, "to_bucket": 6}, "m21_loan_vintage": {"ever_90_plus_rate": 3},
    "m7_merchant_360": {"advisory_product_hint": 2}, "m9_churn_rules": {"churn_risk": 4}, "m10_cross_sell": {"primary_opportunity": 3}, "m11_campaign_target": {"campaign_type": 5},
    "m12_fraud_risk": {"night_flag": 2, "high_amount_flag": 2, "neg_balance_flag": 2, "anomaly_flag": 2, "is_fraud": 2}, "m18_merchant_ranking": {"txn_count": 2},
    "m13_aml_monitoring": {"high_value_flag": 2, "structuring_flag": 2, "velocity_flag": 2, "multi_channel_flag": 2, "geo_velocity_flag": 2, "alert_generated": 2, "is_fraud": 2, "risk_level": 4},
}


@pytest.mark.parametrize("name", sorted(BOTH))
def test_each_branch_is_taken(name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in sorted(Path(FOLDER.replace("0.001", "0.01")).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    con.execute(f"CREATE TABLE result AS {entry.oracle_sql()[name]}")
    for column, least in BOTH[name].items():
        assert len(con.execute(f"SELECT DISTINCT {column} FROM result").fetchall()) >= least, column


@pytest.mark.parametrize("name", ["mrg12_consolidated_state", "st12_replay_verdicts"])
def test_events_numbered_beyond_a_million(spark, tmp_path, name):
    """Ids below and above 1,000,000, and customers whose events share their times."""
    duckdb = pytest.importorskip("duckdb")
    kind = "element_at(array('click', 'view', 'purchase', 'signup', 'error'), CAST(id * 7 % 5 AS INT) + 1)"
    events = spark.range(999_000, 1_003_000).selectExpr("id AS event_id", "timestamp_millis(1704067200000 + id * 31 % 4)::timestamp_ntz AS ts", "id * 13 % 97 AS user_id", f"{kind} AS event_type", "CAST(id % 100 AS DOUBLE) AS value", "'{}' AS props")
    events.write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    df = entry.queries()[name](spark, str(tmp_path))
    want = con.execute(f'SELECT {", ".join(chr(34) + c + chr(34) for c in df.columns)} FROM ({entry.oracle_sql()[name]})').fetchall()
    assert sorted([plain(v) for v in r] for r in df.collect()) == sorted([plain(v) for v in x] for x in want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
