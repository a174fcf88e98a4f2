"""Operators of the library on tiny frames: boundaries, nulls, reruns, order."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions import privacy, time
from tierline.functions.columns import ladder, ratio
from tierline.operators import checks, drift, ranking, reconcile, scd
from tierline.plans import layers
from tierline.sources import catalogues, jdbc, specs, tables, writes
from tierline.streaming import events as ev

D = dt.date


def rows(df, *columns):
    return sorted(tuple(r[c] for c in (columns or df.columns)) for r in df.collect())


def test_business_day_begins_at_17_utc(spark):
    df = spark.createDataFrame([(1, dt.datetime(2026, 6, 29, 16, 59, 59)), (2, dt.datetime(2026, 6, 29, 17)), (3, dt.datetime(2026, 6, 30, 16, 59, 59))], "id int, ts timestamp_ntz")
    got = df.select("id", time.business_date(F.col("ts")).alias("d"), time.business_hour(F.col("ts")).alias("h"), time.in_days(F.col("ts"), D(2026, 6, 30)).alias("in"))
    assert rows(got) == [(1, D(2026, 6, 29), 23, False), (2, D(2026, 6, 30), 0, True), (3, D(2026, 6, 30), 23, True)]
    assert time.time_spine(spark, D(2024, 2, 28), D(2024, 3, 1)).count() == 3


def test_sessions_must_be_utc(spark):
    time.assert_utc_session(spark)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
    with pytest.raises(ValueError, match="UTC"):
        time.assert_utc_session(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ladders_and_ratios(spark):
    df = spark.createDataFrame([(9,), (10,), (89,), (90,), (360,), (None,)], "d int")
    got = df.select("d", ladder(F.col("d"), [(360, 5), (180, 4), (90, 3), (10, 2)], 1).alias("g"), ratio(F.col("d"), F.lit(0)).alias("r"))
    assert {(r["d"], r["g"]) for r in got.collect()} == {(9, 1), (10, 2), (89, 2), (90, 3), (360, 5), (None, 1)} and all(r["r"] is None for r in got.collect())


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 23])
def test_ntile_is_sparks_own(spark, n, monkeypatch):
    from pyspark.sql import Window

    df = spark.range(n).select("id", (F.col("id") % 3).alias("v")).repartition(3)
    monkeypatch.setattr(ranking, "SLICE_ROWS", 6)  # several slices
    got = ranking.ntile(df, 5, [F.col("v"), F.col("id")], "t").withColumn("want", F.ntile(5).over(Window.orderBy("v", "id")))
    assert got.count() == n and got.where("t <> want").isEmpty()
    assert rows(ranking.global_row_number(df, [F.desc("v"), F.col("id")], slices=3), "rn") == [(i + 1,) for i in range(n)]


CUSTOMER = "customer_id long, segment string, email string"


def test_scd2_classes(spark):
    old = spark.createDataFrame([(1, "A", "a"), (2, "A", "b"), (3, "A", "c"), (4, "A", "d"), (5, None, "e"), (6, None, "f")], CUSTOMER)
    new = spark.createDataFrame([(1, "A", "a"), (2, "B", "b"), (3, "A", "x"), (5, None, "e"), (6, "C", "f"), (7, "A", "g")], CUSTOMER)
    want = {1: "same", 2: "tracked", 3: "type1", 4: "missing", 5: "same", 6: "tracked", 7: "new"}
    assert dict(rows(scd.classify(old, new, ["customer_id"], ["segment"]))) == want
    assert dict(rows(scd.classify(old, new, ["customer_id"], ["segment"], close_missing=False))) == want | {4: "same"}
    with pytest.raises(ValueError, match="lacks"):
        scd.classify(old, new, ["customer_id"], ["segmnt"])


def test_scd2_loads_and_reruns(spark):
    first = spark.createDataFrame([(1, "A", "a"), (2, "A", "b"), (3, "A", "c")], CUSTOMER)
    second = spark.createDataFrame([(1, "B", "a"), (2, "A", "y"), (4, "D", "d")], CUSTOMER)
    empty = scd.upgrade(first, ["customer_id"], "sk").limit(0)
    one = scd.apply_scd2(empty, first, ["customer_id"], ["segment"], D(2026, 1, 1), "sk")
    two = scd.apply_scd2(one, second, ["customer_id"], ["segment"], D(2026, 1, 2), "sk")
    again = scd.apply_scd2(two, second, ["customer_id"], ["segment"], D(2026, 1, 2), "sk")
    columns = ("customer_id", "segment", "email", "effective_from", "effective_to", "is_current")
    end = scd.OPEN_END
    want = [
        (1, "A", "a", D(2026, 1, 1), D(2026, 1, 1), 0), (1, "B", "a", D(2026, 1, 2), end, 1), (2, "A", "y", D(2026, 1, 1), end, 1), (3, "A", "c", D(2026, 1, 1), D(2026, 1, 1), 0), (4, "D", "d", D(2026, 1, 2), end, 1),
    ]
    assert rows(two, *columns) == want == rows(again, *columns)
    assert rows(scd.as_of(two, D(2026, 1, 1)), "customer_id", "segment") == [(1, "A"), (2, "A"), (3, "A")]
    assert rows(checks.scd2_integrity(two, ["customer_id"])) == [(5, 3, 0, 3, 0)] and scd.overlaps(two, ["customer_id"]).isEmpty()
    load = lambda source, day: scd.apply_scd2(two, source, ["customer_id"], ["segment"], day, "sk")
    with pytest.raises(ValueError, match="empty"):
        load(second.limit(0), D(2026, 1, 3))
    with pytest.raises(ValueError, match="before"):
        load(second, D(2026, 1, 1))
    doubled = second.unionByName(spark.createDataFrame([(1, "C", "z"), (4, "D", "d")], CUSTOMER))
    assert rows(checks.scd2_integrity(load(doubled, D(2026, 1, 3)), ["customer_id"])) == [(6, 3, 0, 3, 0)]
    assert rows(load(doubled, D(2026, 1, 3)).where("is_current = 1"), "customer_id", "segment") == [(1, "C"), (2, "A"), (4, "D")]


def test_latest_change_and_guarded_merge(spark):
    schema = "id long, email string, op string, ts long, batch long, off long"
    log = spark.createDataFrame([(1, "a", "INSERT", 5, 1, 1), (1, "b", "UPDATE", 5, 1, 2), (1, "c", "UPDATE", 5, 1, None), (2, "d", "DELETE", 7, 1, 3), (3, "e", "INSERT", 9, 1, 4)], schema)
    last = scd.latest_change(log, ["id"], ["ts", "batch", "off"])
    assert rows(last, "id", "email") == [(1, "b"), (2, "d"), (3, "e")]
    state = spark.createDataFrame([(1, "old", "INSERT", 6, 0, 0), (2, "x", "INSERT", 7, 0, 0)], schema)
    merged = scd.merge_current(state, last, ["id"], "op", "ts")
    assert rows(scd.live(merged, "op"), "id", "email") == [(1, "old"), (3, "e")]
    late = scd.latest_change(spark.createDataFrame([(2, "back", "UPDATE", 6, 2, 9), (8, "none", "DELETE", 1, 2, 9)], schema), ["id"], ["ts", "batch", "off"])
    assert rows(scd.live(scd.merge_current(merged, late, ["id"], "op", "ts"), "op"), "id") == [(1,), (3,)]
    assert scd.plan_read(None, 3)[0] == "full" and scd.plan_read(3, 3)[0] == "skip" and scd.plan_read(1, 3) == ("incremental", 1, 3) and scd.plan_read(None, None)[0] == "skip"


def test_a_merge_breaks_ties_of_time_as_the_log_does(spark):
    schema = "id long, email string, op string, ts long, off long"
    state = spark.createDataFrame([(1, "new", "UPDATE", 5, 9), (2, "old", "UPDATE", 5, 1), (3, "none", "UPDATE", 5, None), (4, "kept", "UPDATE", 5, 1)], schema)
    changes = spark.createDataFrame([(1, "old", "UPDATE", 5, 8), (2, "new", "UPDATE", 5, 2), (3, "new", "UPDATE", 5, 0), (4, "older", "UPDATE", 4, 7)], schema)
    merged = lambda order: rows(scd.merge_current(state, changes, ["id"], "op", "ts", order), "id", "email")
    assert merged(["ts", "off"]) == [(1, "new"), (2, "new"), (3, "new"), (4, "kept")] and merged([])[0] == (1, "old")


def test_cdc_casts(spark):
    df = spark.createDataFrame([("7000", "1790726400000000", "12.5"), ("", "", ""), (None, None, "x"), ("0", "0", "0")], "a string, b string, c string")
    got = df.select(*[scd.cdc_cast(k, F.col(c)).alias(c) for k, c in (("epoch_days", "a"), ("epoch_micros", "b"), ("decimal", "c"))]).collect()
    assert [r["a"] for r in got] == [D(1989, 3, 2), None, None, D(1970, 1, 1)] and str(got[0]["c"]) == "12.50" and got[1]["c"] is None and got[2]["c"] is None
    with pytest.raises(ValueError):
        scd.cdc_cast("guess", F.col("a"))


def test_upsert(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([("z", 2), ("w", 3)], "v string, k int")
    assert rows(scd.upsert(a, b, ["k"])) == [(1, "x"), (2, "z"), (3, "w")]


def test_checks(spark):
    df = spark.createDataFrame([(1, 0.0, "a", D(2026, 1, 1)), (1, -1.0, None, D(2026, 1, 3)), (None, None, "b", None), (None, 9.0, "c", None)], "id int, v double, t string, d date")
    C = checks.Check
    got = checks.run_checks(df, "t", [C("unique", "id"), C("range", "v", 0, 5), C("not_null", "t", severity="WARN"), C("accepted", "t", values=("a", "b")), C("not_future", "d"), C("row_count", low=5), C("odd"), C("not_null", "gone")], now=D(2026, 1, 2))
    assert {r["check_name"]: (r["status"], r["failed"]) for r in got.collect()} == {
        "unique:id": ("FAIL", 2), "range:v": ("FAIL", 2), "not_null:t": ("WARN", 1), "accepted:t": ("FAIL", 1), "not_future:d": ("FAIL", 1), "row_count": ("FAIL", 1), "odd": ("SKIPPED", None), "not_null:gone": ("FAIL", None),
    }
    assert checks.run_checks(df.limit(0), "t", [C("not_null", "t"), C("unique", "id")]).where("status = 'PASS'").count() == 2
    assert rows(checks.orphans(df, "id", spark.createDataFrame([(2,)], "k int"), "k")) == [(1,)]
    found = checks.violations(df, {"low": F.col("v") < 1, "odd": F.col("t").isNull()}, "t", dt.datetime(2026, 1, 1))
    assert rows(found, "violation_type") == [("low",), ("low",), ("odd",)]


def test_drift_report_is_a_table(spark):
    declared = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("gone", T.StringType())])
    actual = T.StructType([T.StructField("id", T.LongType()), T.StructField("new", T.DateType())])
    assert rows(checks.drift_report(spark, "t", declared, actual)) == [("t", "gone", "removed", "string", "", "BREAKING"), ("t", "id", "type", "int", "bigint", "ADDITIVE"), ("t", "new", "added", "", "date", "ADDITIVE")]
    assert checks.drift_report(spark, "t", declared, declared).isEmpty()


def test_schema_drift():
    a = T._parse_datatype_string("a int, b decimal(10,2), c string, d date")
    b = T._parse_datatype_string("a bigint, b decimal(18,2), c int, e string")
    assert [(c, k, s) for c, k, _, _, s in checks.schema_drift(a, b)] == [("a", "type", "ADDITIVE"), ("b", "type", "ADDITIVE"), ("c", "type", "BREAKING"), ("d", "removed", "BREAKING"), ("e", "added", "ADDITIVE")]


def test_freshness(spark):
    df = spark.createDataFrame([(D(2026, 1, 1), "x")], "d date, s string")
    (r,) = checks.freshness(df, "t", "d", dt.datetime(2026, 1, 2, 17), 24).collect()
    assert (r["age_hours"], r["status"]) == (24.0, "PASS")
    assert checks.freshness(df, "t", "s", dt.datetime(2026, 1, 2), 1).first()["status"] == "WARN"
    assert checks.freshness(df.limit(0), "t", "d", dt.datetime(2026, 1, 2), 1).first()["status"] == "FAIL"


def test_settlement_outcomes(spark):
    txns = spark.createDataFrame([(1, "10"), (1, "5"), (2, "7"), (3, "1"), (4, "2"), (6, "3")], "m int, amount string").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    settled = spark.createDataFrame([(1, "15", 2), (2, "8", 1), (3, "1", 2), (4, "1", 1), (4, "1", 1), (5, "9", 1)], "m int, gross_amount string, txn_count long").withColumn("gross_amount", F.col("gross_amount").cast("decimal(18,2)"))
    want = {1: "PASS", 2: "GROSS_MISMATCH", 3: "TXN_COUNT_MISMATCH", 4: "DUPLICATE", 5: "MISSING_TXN", 6: "MISSING_SETTLEMENT"}
    assert dict(rows(reconcile.settlement(txns, settled, ["m"]), "m", "outcome")) == want


def test_loan_payment_outcomes(spark):
    due = spark.createDataFrame([(i, D(2026, 1, 1), 100) for i in range(1, 8)], "loan_id int, cob_dt date, scheduled int")
    paid = [(1, 1, "PAID", 60), (1, 2, "PAID", 40), (2, 1, "PAID", 102), (3, 1, "MISSED", 0), (4, 1, "PENDING", 50), (5, 1, "PAID", 50), (5, 1, "PAID", 50), (6, 1, "PAID", 101)]
    seen = spark.createDataFrame([(a, D(2026, 1, 1), b, c, d) for a, b, c, d in paid], "loan_id int, cob_dt date, payment_id int, payment_status string, paid int")
    want = {1: "MATCHED", 2: "MISMATCH", 3: "MISSING_RIGHT", 4: "PENDING", 5: "NOT_COMPARABLE", 6: "MATCHED", 7: "MISSING_RIGHT"}
    got = reconcile.loan_payments(due, seen)
    assert dict(rows(got, "loan_id", "outcome")) == want and dict(rows(got, "loan_id", "status"))[4] == "WARN"


def test_masks(spark):
    df = spark.createDataFrame([("Nguyen Van An", "0901234567", "an@x.vn"), ("Le Binh", None, "bad"), ("Chi", "12", None), (None, "", "")], "n string, p string, e string")
    got = privacy.apply_masks(df, {"n": "name", "p": "phone", "e": "email"}).collect()
    assert [tuple(r) for r in got] == [("Nguyen *** An", "090****567", "a***@x.vn"), ("Le ***", None, "***"), ("C***", "****", None), (None, "****", "***")]
    typed = spark.createDataFrame([(1, D(2026, 5, 5))], "a int, d date")
    assert privacy.apply_masks(typed, {"a": "null", "d": "year"}).schema == typed.schema
    with pytest.raises(ValueError):
        privacy.apply_masks(typed, {"zzz": "null"})
    roles = {"base": (None, {"a": "null"}), "more": ("base", {"a": "redacted", "d": "year"})}
    assert privacy.policy_for(roles, "more") == {"a": "redacted", "d": "year"}


def test_drift(spark):
    a, b = spark.range(1000).select(F.col("id").cast("double").alias("v")), spark.range(1000).select((F.col("id") * 2).cast("double").alias("v"))
    same, other = drift.drift(a, a, "v").first(), drift.drift(a, b, "v").first()
    assert same["psi"] == pytest.approx(0) and same["ks"] == 0 and not same["drifted"]
    assert other["drifted"] and other["ks"] == pytest.approx(0.5, abs=0.01) and other["mean_shift"] == pytest.approx(1)


def test_quantiles_are_exact(spark):
    values = [float(i * i % 101) for i in range(457)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(5)
    at = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    assert ranking.quantiles(df, "v", at) == pytest.approx(np.quantile(values, at).tolist())
    assert ranking.quantiles(df.limit(0), "v", at) == [None] * 6 and ranking.slices_for(10**9) == 4000 and ranking.slices_for(1) == 1


def test_merchants_with_a_steady_cash_flow_are_told_to_save(spark):
    """Failed payments are no revenue; a month that grew asks for a loan, an even one for savings, an uneven or empty one for neither."""
    from types import SimpleNamespace

    from tierline.plans.merchant_marts import merchant_360

    paid = [(1, D(2001, 6, 20), "100", "SUCCESS"), (1, D(2001, 6, 21), "900", "FAILED"), (1, D(2001, 5, 10), "50", "SUCCESS")]
    paid += [(2, D(2001, 6, d), "10", "SUCCESS") for d in (1, 5, 9)] + [(2, D(2001, 5, d), "12", "SUCCESS") for d in (10, 20, 30)]
    paid += [(3, D(2001, 5, 20), "500", "SUCCESS"), (3, D(2001, 5, 21), "1", "SUCCESS"), (3, D(2001, 5, 22), "1", "SUCCESS"), (4, D(2001, 6, 1), "70", "FAILED")]
    cards = spark.createDataFrame(paid, "merchant_id int, cob_dt date, a string, status string").withColumn("amount", F.col("a").cast("decimal(18,2)"))
    places = spark.createDataFrame([(1, "Hanoi")], "branch_id int, city string")
    merchants = spark.createDataFrame([(i, f"Shop {i}", 1, 5) for i in range(1, 6)], "merchant_id int, merchant_name string, branch_id int, mcc int")
    got = {r["merchant_id"]: r for r in merchant_360(SimpleNamespace(card_txn=cards, merchant=merchants, branch=places)).collect()}
    assert {k: r["advisory_product_hint"] for k, r in got.items()} == {1: "WORKING_CAPITAL_LOAN", 2: "SAVINGS", 3: "EXTRA_POS", 4: "EXTRA_POS", 5: "EXTRA_POS"}
    assert (got[1]["revenue_90d"], got[1]["active_days_90d"], got[4]["active_days_90d"], got[5]["active_days_90d"]) == (150, 3, 1, 0) and got[4]["cash_flow_cv"] is None


def test_catalogues_hold_together(spark):
    held = {d.name: d for d in catalogues.dimensions()}
    assert len(held) == 12 and sum(bool(d.tracked) for d in held.values()) == 6
    for d in held.values():
        assert set(d.tracked) | set(d.required) <= set(d.columns) and all(c in d.columns and (k == held[p].key or k in held[p].columns) for c, p, k in d.parents)
        assert list(layers.SNAPSHOTS[d.name][1]) == [d.key, *d.columns]
        assert any(c.kind == "unique" for c in catalogues.rules(d))
    assert [s.problems() for s in catalogues.streams()] == [[]] * 7 and len(catalogues.consolidations()) == 3 and len(catalogues.QUARANTINE) == 18


def test_load_specs():
    assert [s.problems() for s in specs.bank_catalogue()] == [[]] * 23
    assert len(specs.LoadSpec("t", "t", "sometimes").problems()) == 1 and specs.LoadSpec("t", "t", "incremental").problems()
    spec = specs.LoadSpec("t", "txn", "incremental", "ts", specs.Split("id", 0, 100, 4))
    options = specs.jdbc_options(spec, "jdbc:postgresql://h/db", D(2026, 6, 30), D(2026, 6, 29))
    assert options["dbtable"] == "(SELECT * FROM txn WHERE ts >= TIMESTAMP '2026-06-28 17:00:00' AND ts < TIMESTAMP '2026-06-30 17:00:00') AS q" and options["numPartitions"] == "4"
    with pytest.raises(ValueError, match="driver"):
        specs.jdbc_options(spec, "jdbc:odd://h", D(2026, 6, 30))


def test_scoped_reads_and_guards(spark):
    days = spark.createDataFrame([(1, D(2026, 1, 1)), (2, D(2026, 1, 2))], "id int, cob_dt date")
    assert rows(tables.scoped(days, D(2026, 1, 2)), "id") == [(2,)]
    assert rows(tables.scoped(spark.createDataFrame([(1, 1), (2, 0)], "id int, is_current int"), D(2026, 1, 1)), "id") == [(1,)]
    with pytest.raises(tables.MissingSnapshot):
        tables.serve_slice(days, D(2026, 1, 3))
    with pytest.raises(ValueError):
        tables.assert_not_empty(days.limit(0), "t")


def test_days_are_overwritten_and_breaks_refused(spark):
    df = spark.createDataFrame([(1, "a", D(2026, 1, 1)), (2, "b", D(2026, 1, 2))], "id int, v string, cob_dt date")
    writes.overwrite_days(df, "guarded")
    with pytest.raises(writes.SchemaBreak):
        writes.overwrite_days(df.drop("v"), "guarded")
    with pytest.raises(writes.SchemaBreak):
        writes.overwrite_days(df.withColumn("id", F.lit("x")), "guarded")
    assert spark.table("guarded").count() == 2
    df.write.saveAsTable("flat")
    with pytest.raises(ValueError, match="partitioned"):
        writes.overwrite_days(df, "flat")
    ddl = jdbc.table_ddl(df.schema, "s.t", ["id"])
    assert ddl == 'CREATE TABLE IF NOT EXISTS s.t ("id" INTEGER NOT NULL, "v" TEXT, "cob_dt" DATE, PRIMARY KEY ("id"))'
    assert jdbc.upsert_sql(df.schema, "t", "s", ["id"]).endswith('ON CONFLICT ("id") DO UPDATE SET "v" = EXCLUDED."v", "cob_dt" = EXCLUDED."cob_dt"')
    z = writes.clustered(spark.range(1000).select((F.col("id") % 32).cast("double").alias("a"), (F.col("id") / 32).alias("b")), ["a", "b"], 4)
    assert z.count() == 1000 and z.columns == ["a", "b"]


def envelope(key, op="u", ts="1700000000000", **more):
    return json.dumps({"payload": {"id": key, "amount": "1.5", "__op": op, "__ts_ms": ts, **more}})


SPEC = ev.StreamSpec("t", ("id",), {"id": "bigint", "amount": "decimal(18,2)"}, ("id",), "10 minutes")


def records(spark, values):
    now = dt.datetime(2026, 1, 1)
    return spark.createDataFrame([(str(i), v, "t", 0, i, now) for i, v in enumerate(values)], ev.RECORD)


def test_envelopes_are_split(spark):
    batch = records(spark, [envelope("1", "c"), envelope("2", "d"), None, "not json", envelope("3", "x"), envelope(None), envelope("4", ts="soon"), envelope("x9")])
    checked = ev.validate(batch, SPEC)
    assert rows(ev.valid(checked, SPEC), "id", "__cdc_operation") == [(1, "INSERT"), (2, "DELETE")]
    assert rows(ev.dead_letters(checked, "t"), "kafka_offset", "error_type") == [(3, "PARSE_ERROR"), (4, "INVALID_OPERATION"), (5, "MISSING_PRIMARY_KEY"), (6, "INVALID_TIMESTAMP"), (7, "MISSING_PRIMARY_KEY")]
    assert all(r["error_message"] for r in ev.dead_letters(checked, "t").collect())


def test_stream_specs():
    assert SPEC.problems() == [] and ev.StreamSpec("t", (), {}).problems()
    assert ev.StreamSpec("t", ("a",), {}, ("a",), "").problems() and ev.StreamSpec("t", ("a",), {}, ("a",), "soon").problems()


def test_stream_job_survives_a_restart(spark, tmp_path):
    """Replays vanish within and across runs, and what two runs write is what one batch gives."""
    source = str(tmp_path / "in")
    records(spark, [envelope("1"), envelope("1"), envelope("2", "d"), None, envelope("3", "x")]).write.parquet(source)
    where = (str(tmp_path / "out"), str(tmp_path / "check"))
    dim = lambda: spark.createDataFrame([(1, "gold")], "id long, tier string")
    spec = ev.StreamSpec("t", ("id",), dict(SPEC.columns), ("id",), "10 minutes", "dim", ("id",))
    ev.run_cdc(ev.file_stream(spark, source), spec, *where, dim).awaitTermination()
    records(spark, [envelope("1"), envelope("4")]).write.mode("append").parquet(source)
    ev.run_cdc(ev.file_stream(spark, source), spec, *where, dim).awaitTermination()
    assert rows(spark.read.parquet(where[0] + "/log"), "id") == [(1,), (2,), (4,)]
    assert rows(spark.read.parquet(where[0] + "/dead_letters"), "error_type") == [("INVALID_OPERATION",)]
    assert rows(spark.read.parquet(where[0] + "/enriched").na.fill("-"), "id", "dim_tier") == [(1, "gold"), (2, "-"), (4, "-")]


def test_a_batch_that_was_not_enriched_is_enriched_later(spark, tmp_path):
    """The dimension is away for the first run: its rows are in the log, and in the second run's enriched table."""
    source, where = str(tmp_path / "in"), (str(tmp_path / "out"), str(tmp_path / "check"))
    spec = ev.StreamSpec("t", ("id",), dict(SPEC.columns), ("id",), "10 minutes", "dim", ("id",))

    def away():
        raise RuntimeError("no dimension")

    records(spark, [envelope("1"), envelope("2")]).write.parquet(source)
    ev.run_cdc(ev.file_stream(spark, source), spec, *where, away).awaitTermination()
    assert rows(spark.read.parquet(where[0] + "/log"), "id") == [(1,), (2,)]
    records(spark, [envelope("4")]).write.mode("append").parquet(source)
    dim = lambda: spark.createDataFrame([(1, "gold")], "id long, tier string")
    ev.run_cdc(ev.file_stream(spark, source), spec, *where, dim).awaitTermination()
    assert rows(spark.read.parquet(where[0] + "/enriched").na.fill("-"), "id", "dim_tier") == [(1, "gold"), (2, "-"), (4, "-")]


def test_streamed_minutes_equal_batch_minutes(spark, tmp_path):
    schema = "merchant_id int, ts timestamp, status string, amount decimal(18,2)"
    base = dt.datetime(2026, 1, 1)
    data = [(i % 3, base + dt.timedelta(seconds=i * 20), "SUCCESS" if i % 4 else "FAILED", i) for i in range(60)] + [(9, base + dt.timedelta(days=1), "SUCCESS", 1)]
    df = spark.createDataFrame([(a, b, c, d) for a, b, c, d in data], "merchant_id int, ts timestamp, status string, amount int").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    df.coalesce(1).write.parquet(str(tmp_path / "p"))
    job = ev.revenue_per_minute(ev.file_stream(spark, str(tmp_path / "p"), schema)).writeStream.format("memory").queryName("minutes").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    job.awaitTermination()
    assert rows(spark.table("minutes")) == rows(ev.revenue_per_minute(df).where("merchant_id < 9"))


def test_event_contracts(spark):
    fields = {"id": ev.Field("bigint", low=1), "kind": ev.Field("string", enum=("a", "b")), "ref": ev.Field("string", required=False, pattern="^r[0-9]+$")}
    bodies = ['{"id": 1, "kind": "a"}', '{"id": 0, "kind": "c", "ref": "x"}', '{"kind": "a", "more": 1}', "[1]", '{"id": "x", "kind": "a"}']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string").select("i", ev.contract_violations(F.col("b"), fields).alias("v"))
    got = {r["i"]: r["v"] for r in df.collect()}
    assert got[0] == [] and got[1] == ["id: below 1", "kind: not allowed", "ref: no match"] and got[2] == ["id: missing", "more: unknown"] and got[4] == ["id: not bigint"]
    assert got[3][0] == "not an object"


def test_replays(spark):
    batch = spark.createDataFrame([("t", 1, "f", 1), ("t", 1, "f", 2), ("t", 2, "f", 3), ("t", 2, "g", 4), ("t", 3, "f", 5), ("t", 4, "f", 6)], "topic string, event_id long, fingerprint string, offset long")
    ledger = spark.createDataFrame([("t", 3, "f"), ("t", 4, "z")], "topic string, event_id long, fingerprint string")
    assert rows(ev.classify_replays(batch, ledger), "offset", "verdict") == [(1, "NEW"), (2, "REPLAY"), (3, "CONFLICT"), (4, "CONFLICT"), (5, "REPLAY"), (6, "CONFLICT")]


def test_database_reads_are_parallel_and_pushed(spark):
    url = jdbc.embedded_url(spark)
    df = spark.range(1000).select("id", F.expr("TIMESTAMP_NTZ'2026-06-29 12:00:00' + make_dt_interval(0, CAST(id % 24 AS INT))").alias("ts"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    jdbc.copy_table(df, url, "things")
    spec = specs.LoadSpec("things", "things", "incremental", '"ts"', specs.Split("id", None, None, 4))
    got = jdbc.read_jdbc(spark, spec, url, D(2026, 6, 30))
    assert got.rdd.getNumPartitions() == 4 and got.count() == sum(i % 24 >= 5 for i in range(1000)) and {r[0] for r in got.select("cob_dt").distinct().collect()} == {D(2026, 6, 30)}
    assert all(200 < r["n"] - 0 < 300 or r["n"] < 300 for r in jdbc.day_counts(got).collect())
    plan = got.where("id < 10").select("name")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(id), *LessThan(id,10)]" in plan and "ReadSchema: struct<name:string>" in plan
    assert jdbc.column_bounds(spark, spec, url, D(2026, 6, 30)) == (5, 999) and jdbc.column_bounds(spark, spec, url, D(2020, 1, 1)) is None
    assert jdbc.read_jdbc(spark, spec, url, D(2020, 1, 1)).count() == 0
    jdbc.drop_embedded(spark, url)


def test_an_upsert_that_stops_is_repeatable(spark, monkeypatch):
    url = jdbc.embedded_url(spark)
    load = lambda rows: spark.createDataFrame(rows, "k string, d date, v double")
    day = D(2026, 1, 1)
    assert jdbc.upsert_jdbc(load([("a", day, 1.0), ("b", day, 2.0)]), url, "served", ["k", "d"]) == 2
    run = jdbc.in_transaction

    def stops(session, to, statements, properties=None):
        if any(s.startswith("MERGE") for s in statements):
            run(session, to, statements[:1] + ["NOT SQL"], properties)  # the merge itself is done, its commit is not
        return run(session, to, statements, properties)

    monkeypatch.setattr(jdbc, "in_transaction", stops)
    with pytest.raises(Exception, match="Syntax error"):
        jdbc.upsert_jdbc(load([("b", day, 3.0), ("c", day, None)]), url, "served", ["k", "d"])
    monkeypatch.setattr(jdbc, "in_transaction", run)
    served = lambda: sorted(tuple(r) for r in spark.read.format("jdbc").options(url=url, dbtable="served").load().collect())
    assert served() == [("a", day, 1.0), ("b", day, 2.0)]
    for _ in range(2):
        jdbc.upsert_jdbc(load([("b", day, 3.0), ("c", day, None)]), url, "served", ["k", "d"])
        assert served() == [("a", day, 1.0), ("b", day, 3.0), ("c", day, None)]
    assert jdbc.upsert_jdbc(load([]), url, "served", ["k", "d"]) == 0
    for bad in ([("x", day, 1.0), ("x", day, 2.0)], [(None, day, 1.0)]):
        with pytest.raises(ValueError, match="key"):
            jdbc.upsert_jdbc(load(bad), url, "served", ["k", "d"])
    with pytest.raises(ValueError, match="key"):
        jdbc.upsert_jdbc(load([]), url, "served", ["nothing"])
    assert len(served()) == 3 and not jdbc.has_table(spark, url, "served__staging")
    jdbc.drop_embedded(spark, url)


def test_last_two_without_a_sort(spark):
    data = [(1, 5, 1), (1, 5, 9), (1, 3, 7), (2, 4, 4), (3, 6, 2), (3, 6, 2), (4, 0, 0), (4, 0, 0), (4, 0, 0), (None, 2, 1), (None, 1, 1)]
    df = spark.createDataFrame(data, "k long, a long, b long")
    last = ranking.last_two(df, "k", [("a", 6), ("b", 19)], F.sum("b").alias("s"))
    got = {r["k"]: (r["last"] and tuple(r["last"]), r["prior"] and tuple(r["prior"]), r["s"]) for r in last.collect()}
    assert got == {1: ((5, 9), (5, 1), 17), 2: ((4, 4), None, 4), 3: ((6, 2), (6, 2), 4), 4: ((0, 0), (0, 0), 0)}
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "ReusedExchange" in plan
    for bad in ([(1, None, 1)], [(1, 1_000_000, 1)], [(1, -1, 1)]):
        with pytest.raises(Exception, match="no number of 6 digits"):
            ranking.last_two(spark.createDataFrame(bad, "k long, a long, b long"), "k", [("a", 6), ("b", 19)]).collect()


def test_latest_copy_moves_only_rows_with_copies(spark):
    data = [(1, 10, D(2026, 1, 1)), (1, 11, D(2026, 1, 2)), (1, 12, D(2026, 1, 4)), (2, 20, D(2026, 1, 1)), (3, 30, D(2026, 1, 2)), (3, 31, D(2026, 1, 2)), (None, 1, D(2026, 1, 1)), (None, 2, D(2026, 1, 1)), (4, 40, D(2026, 1, 5))]
    df = spark.createDataFrame(data, "k int, v int, cob_dt date")
    newest = scd.latest_copy(df, ["k"], "cob_dt", D(2026, 1, 3), ["v"])
    assert sorted((r["k"] or 0, r["v"]) for r in newest.collect()) == [(0, 1), (0, 2), (1, 11), (2, 20), (3, 31)]
    assert scd.latest_copy(df.limit(0), ["k"], "cob_dt", D(2026, 1, 3)).count() == 0


def test_quantiles_and_slices_of_repeated_values(spark):
    values = [7.0] * 400 + [float(i % 90) for i in range(700)] + [0.5 * i for i in range(300)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(5)
    at = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.99, 1.0]
    assert ranking.quantiles(df, "v", at) == pytest.approx(np.quantile(values, at).tolist())
    points = ranking.split_points(df.where("v IS NOT NULL"), [F.col("v")], 16, len(values))
    assert len(points) == len(set(points)) >= 8
    kinds = df.select(F.struct(F.col("v").alias("k0")).alias("k")).schema["k"].dataType
    sizes = df.where("v IS NOT NULL").groupBy(ranking.slice_of(F.struct(F.col("v").alias("k0")), points, kinds).alias("s")).agg(F.count("*").alias("n"), F.max(F.when(F.col("v") == 7, 1).otherwise(0)).alias("hot")).collect()
    assert max(r["n"] for r in sizes if not r["hot"]) < 250  # no slice but that of the value that many share is large


def test_quartiles_are_exact_at_any_number_of_rows(spark, monkeypatch):
    n = 300_000
    df = spark.range(1, n + 1).select((F.col("id") * 7919 % (n + 1)).cast("decimal(18,2)").alias("v"))
    assert [tuple(map(int, r)) for r in rows(checks.quartiles(df, "v"))] == [(n // 4, n // 2, 3 * n // 4)]
    assert checks.iqr_outliers(df, "v", 0.25).count() == n // 4 - 1  # below n / 8, above 7 n / 8
    monkeypatch.setattr(ranking, "SLICE_ROWS", 3)  # several slices
    some = spark.createDataFrame([("a", i % 5) for i in range(9)] + [("b", None)] * 3 + [(None, 4), (None, None), ("c", 1), ("c", 2)] + [("d", 7)] * 40, "g string, v int")
    assert {tuple(r) for r in checks.quartiles(some, "v", ["g"]).collect()} == {("a", 1, 2, 3), ("b", None, None, None), (None, 4, 4, 4), ("c", 1, 1, 2), ("d", 7, 7, 7)}
    assert rows(checks.quartiles(some.limit(0), "v")) == [(None, None, None)] and checks.quartiles(some.limit(0), "v", ["g"]).isEmpty()


def test_checks_read_a_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(i % 50, i % 7, None if i % 9 == 0 else i) for i in range(100)], "a int, b int, c int").write.parquet(path)
    df = spark.read.parquet(path)
    found = checks.run_checks(df, "t", [checks.Check("unique", "a"), checks.Check("unique", "b"), checks.Check("unique", "c"), checks.Check("not_null", "c"), checks.Check("row_count", low=1)])
    assert {r["check_name"]: r["failed"] for r in found.collect()} == {"unique:a": 50, "unique:b": 93, "unique:c": 11, "not_null:c": 12, "row_count": 0}
    initial = found._jdf.queryExecution().sparkPlan().toString()
    assert initial.count("FileScan parquet") == 1


def test_metrics_are_refused_where_they_mean_nothing(spark):
    from tierline.operators.metrics import Catalogue, Measure, Metric, Model

    sales = spark.createDataFrame([(1, "x", 10, 4), (2, "x", 20, 1), (3, "y", 5, 5), (None, "y", 7, 0)], "shop int, kind string, n int, bad int")
    shops = spark.createDataFrame([(1, "north"), (2, "south")], "id int, area string")
    model = Model("sales", lambda: sales, "sale", {"sale": "concat(shop, kind)", "shop": "shop"}, {"kind": "kind"}, {"n": Measure("sum", "n"), "bad": Measure("sum", "bad")})
    shop = Model("shops", lambda: shops, "shop", {"shop": "id"}, {"area": "area"})
    metrics = Catalogue([model, shop], {"n": Metric("n"), "bad_rate": Metric("bad", "n")})
    got = {(r["grain"], r["kind"], r["shop__area"]): r["value"] for r in metrics.query(["bad_rate"], ["kind", "shop__area"], [(), ("kind",), ("shop__area",)]).collect()}
    assert got == {("", None, None): 10 / 42, ("kind", "x", None): 5 / 30, ("kind", "y", None): 5 / 12, ("shop__area", None, "north"): 0.4, ("shop__area", None, "south"): 0.05, ("shop__area", None, None): 5 / 12}
    assert metrics.query(["n"]).collect()[0]["value"] == 42.0
    for bad in (lambda: metrics.query(["nothing"]), lambda: metrics.query(["n"], ["shop__name"]), lambda: metrics.query(["n"], ["kind"], [("other",)]), lambda: Catalogue([model], {"x": Metric("y")}), lambda: Catalogue([model, model], {})):
        with pytest.raises(ValueError):
            bad()


def test_layers_are_counted_from_footers(spark, tmp_path):
    from tierline.operators import invariants

    rows = spark.createDataFrame([(i, D(2026, 1, 1 + i % 3), dt.datetime(2026, 1, 1 + i % 3, 12)) for i in range(90)], "id int, cob_dt date, ts timestamp_ntz")
    path = str(tmp_path / "layer")
    rows.unionByName(rows.where("id = 5")).write.partitionBy("cob_dt").parquet(path)
    counts = invariants.footer_counts(spark, path, "cob_dt")
    assert {r["cob_dt"].day: r["n"] for r in counts.collect()} == {1: 30, 2: 30, 3: 31}
    assert "PushedAggregation: [COUNT(*)]" in counts._jdf.queryExecution().toString() and spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    layers = [invariants.Layer(n, path, ("id",), "cob_dt", whole=w, ts=t, expected=e) for n, w, t, e in (("facts", True, "ts", 91), ("mart", False, None, None), ("short", True, None, 7))]
    got = {r["layer"]: r.asDict() for r in invariants.layer_report(spark, layers, D(2026, 1, 3)).collect()}
    assert (got["facts"]["rows"], got["facts"]["distinct_keys"], got["facts"]["repeated_keys"], got["facts"]["diverging"], got["facts"]["status"]) == (91, 90, 1, 0, "OK")
    assert got["mart"]["rows"] == 31 and got["mart"]["status"] == "REPEATED" and got["short"]["status"] == "COUNT"
    assert {r["status"] for r in invariants.layer_report(spark, layers, D(2026, 1, 9)).collect()} == {"NO_DAY"}
