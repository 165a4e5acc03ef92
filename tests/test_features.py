"""Edge values of the feature columns, statistics and cleaning steps."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens import schema
from ledgerlens.operators import clean, features as fe, profile, running
from ledgerlens.sources.transactions import read_transactions


def _tx(spark, rows):
    """(tx_id, step, type, amount, isFraud) with the other columns empty."""
    data = [(i, s, t, a, "C1", 0.0, 0.0, "M1", 0.0, 0.0, y, 0) for i, s, t, a, y in rows]
    names = "tx_id long, step int, type string, amount float, nameOrig string, oldbalanceOrg float, newbalanceOrig float, " \
            "nameDest string, oldbalanceDest float, newbalanceDest float, isFraud int, isFlaggedFraud int"
    return spark.createDataFrame(data, names)


def test_amount_categories_and_rounds(spark):
    amounts = [-5.0, 0.0, 0.01, 1000.0, 1000.01, 10000.0, 100000.0, 1000000.0, 1000000.5, None, float("nan")]
    tx = _tx(spark, [(i, 1, "TRANSFER", a, 0) for i, a in enumerate(amounts)])
    got = fe.engineer_features(tx).orderBy("tx_id").select("amount_category", "is_round_amount").collect()
    assert [r[0] for r in got] == [None, None, 0, 0, 1, 1, 2, 3, 4, None, None]
    assert [r[1] for r in got] == [0, 1, 0, 1, 0, 1, 1, 1, 0, None, None]


def test_time_columns(spark):
    steps = [0, 1, 4, 6, 22, 23, 95, 96, 119, 143, 144, 167, 168]
    tx = _tx(spark, [(i, s, "TRANSFER", 1.0, 0) for i, s in enumerate(steps)])
    got = fe.add_time_features(tx).orderBy("tx_id").select("hour", "day", "is_night", "is_weekend", "is_deep_night").collect()
    want = []
    for s in steps:
        hour, day = s % 24, s // 24 + 1
        want.append((hour, day, int(hour >= 22 or hour <= 6), int(day % 7 >= 5), int(1 <= hour <= 4)))
    assert [tuple(r) for r in got] == want


def test_type_codes_depend_on_the_types_present(spark):
    only = fe.engineer_features(_tx(spark, [(1, 1, "TRANSFER", 1.0, 0), (2, 1, "PAYMENT", 2.0, 0)])).collect()
    assert [(r.tx_id, r.type_encoded, r.is_cash_out) for r in only] == [(1, 0.0, 0.0)]
    both = fe.engineer_features(_tx(spark, [(1, 1, "TRANSFER", 1.0, 0), (2, 1, "CASH_OUT", 2.0, 0)])).orderBy("tx_id").collect()
    assert [(r.type_encoded, r.is_cash_out) for r in both] == [(1.0, 0.0), (0.0, 1.0)]


def test_risk_flags(spark):
    tx = _tx(spark, [(1, 2, "TRANSFER", 100000.0, 1), (2, 12, "TRANSFER", 100000.0, 0), (3, 2, "TRANSFER", 99000.0, 0),
                     (4, 4 * 24 + 12, "TRANSFER", 5.0, 0), (5, 6 * 24 + 12, "TRANSFER", 5.0, 0)])
    got = fe.engineer_features(tx).orderBy("tx_id").collect()
    assert [r.high_risk_pattern for r in got] == [1, 0, 0, 0, 0]
    assert [r.suspicious_timing for r in got] == [1, 0, 1, 1, 0]


def test_constant_amount_has_no_zscore(spark):
    got = fe.engineer_features(_tx(spark, [(i, 1, "TRANSFER", 7.0, 0) for i in range(3)])).collect()
    assert all(r.amount_zscore is None and r.is_extreme_amount == 1 for r in got)


def test_stats_fitted_on_other_rows(spark):
    tx = _tx(spark, [(i, 1, "TRANSFER", float(i), 0) for i in range(10)])
    train = tx.where("tx_id < 5")
    got = fe.engineer_features(tx, fit_on=train).where("tx_id = 2").first()
    assert got.amount_zscore == pytest.approx(0.0)


def test_quantiles_and_moments_match_numpy(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.lognormal(8, 3, 500), np.full(300, 1000.0), -rng.lognormal(3, 2, 100), [0.0]]).astype(np.float32)
    tx = _tx(spark, [(i, 1, "TRANSFER", float(a), 0) for i, a in enumerate(x)])
    got = fe.amount_stats(tx).first()
    for name, q in schema.AMOUNT_QUANTILES.items():
        assert got[name] == pytest.approx(np.quantile(x.astype(float), q), rel=1e-9, abs=1e-9)
    assert got["mean"] == pytest.approx(x.astype(float).mean())
    assert got["std"] == pytest.approx(x.astype(float).std())
    assert fe.amount_stats(tx, ddof=1).first()["std"] == pytest.approx(x.astype(float).std(ddof=1))


def test_running_totals_equal_a_plain_window(spark):
    rows = spark.range(3000).selectExpr("id % 3 as g", "pmod(id * 7919, 1000) / 999.0D as p", "id as n").groupBy("g", "p").sum("n")
    rows = rows.withColumnRenamed("sum(n)", "n")
    from ledgerlens.functions.scalar import logit_bucket
    for way, down in (("asc", False), ("desc", True)):
        got = running.running_totals(rows, "p", ["n"], logit_bucket("p"), by=["g"], descending=down)
        want = rows.selectExpr("g", "p", "n", f"sum(n) over (partition by g order by p {way}) as c_n")
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_profile_of_dirty_and_empty_input(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), 2.0), (3.0, 2.0)], "amount float, oldbalanceOrg float")
    got = {r["column"]: (r["missing"], r["mean"]) for r in profile.numeric_profile(df).collect()}
    assert got == {"amount": (1, 2.0), "oldbalanceOrg": (1, 2.0)}
    assert profile.missing_cells(df).first()[0] == 2
    empty = _tx(spark, []).limit(0)
    assert tuple(profile.label_balance(empty).first()) == (0, 0, 0, 0.0)
    assert profile.amount_summary(empty).first()["median"] is None
    assert profile.duplicate_rows(empty).first()[0] == 0


@pytest.mark.parametrize("fraud,total,band", [(1, 1000, "NORMAL"), (1, 1001, "UNUSUAL"), (5, 100, "NORMAL"), (6, 100, "UNUSUAL")])
def test_rate_band_limits(spark, fraud, total, band):
    df = spark.range(total).selectExpr(f"int(id < {fraud}) as isFraud")
    assert profile.rate_band(profile.label_balance(df)).first()["band"] == band


@pytest.mark.parametrize("limit", [0, 1000])
def test_duplicates_by_value_with_and_without_broadcast(spark, limit):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "a", 1.0), (4, "b", float("nan")), (5, "b", float("nan"))],
                               "tx_id long, x string, y double")
    assert profile.duplicate_rows(df, broadcast_limit=limit).first()[0] == 2
    assert profile.duplicate_rows(df, ["x"], broadcast_limit=limit).first()[0] == 3


def test_audit_reports_infinite_and_missing(spark):
    from tests.conftest import feature_rows
    rows = feature_rows(spark, [(1, 0, {"amount": 2.0}), (2, 0, {"amount": float("inf")}), (3, 1, {"amount_category": None})])
    got = profile.split_audit(rows.selectExpr("*", "if(tx_id = 3, 'b', 'a') as split")).orderBy("split").collect()
    assert [(r.has_nan, r.has_inf, r.missing_cells) for r in got] == [(False, True, 0), (True, False, 1)]
    assert got[0].grand_mean == pytest.approx(2.0 / 37)


def test_leftover_strings_are_coded_in_sorted_order(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b"), (5, "Z")], "tx_id long, s string")
    got = {r.tx_id: r.s for r in clean.encode_remaining_strings(df).collect()}
    assert got == {5: 0.0, 2: 1.0, 1: 2.0, 4: 2.0, 3: 3.0}


def test_bad_csv(spark, tmp_path):
    header = ",".join(schema.CSV_SCHEMA.names)
    (tmp_path / "t.csv").write_text(f"{header}\n1,TRANSFER,5.5,C1,1,2,M1,3,4,1,0\nx,TRANSFER,5.5,C1,1,2,M1,3,4,1,0\n")
    with pytest.raises(Exception):
        read_transactions(spark, str(tmp_path / "t.csv")).collect()
    lenient = read_transactions(spark, str(tmp_path / "t.csv"), mode="PERMISSIVE").cache()
    assert lenient.where("_corrupt_record is not null").count() == 1
    with pytest.raises(Exception):
        read_transactions(spark, str(tmp_path / "absent.csv")).collect()


def test_feature_table_is_one_projection_over_a_pruned_scan(spark):
    from ledgerlens.plans import fixture
    df = fe.engineer_features(fixture.transactions(spark, "/root/testdata/sf0.001"))
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    nodes = [re.match(r"\s*(?:\+- )?(\w+)", line) for line in lines]  # subqueries hang off a ":" and do not match
    assert {n.group(1) for n in nodes if n} <= {"Project", "Filter", "Relation"}
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert "user_id" not in physical and "props" not in physical


def _layouts(spark, tmp_path):
    rows = spark.range(3000).selectExpr("cast(id % 40 as int) as step", "if(id % 3 = 0, 'TRANSFER', 'DEBIT') as type",
                                        "cast(id % 700 as float) as amount", "'C1' as nameOrig", "cast(null as float) as oldbalanceOrg",
                                        "cast(0 as float) as newbalanceOrig", "'M1' as nameDest", "cast(0 as float) as oldbalanceDest",
                                        "cast(0 as float) as newbalanceDest", "cast(id % 7 = 0 as tinyint) as isFraud",
                                        "cast(0 as tinyint) as isFlaggedFraud")
    for i, parts in enumerate((1, 3, 8)):
        path = str(tmp_path / f"layout{i}")
        rows.repartition(parts).write.option("header", True).csv(path)
        yield path


def test_keys_depend_on_content_only(spark, tmp_path):
    seen = []
    for size in ("128m", "4k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        for path in _layouts(spark, tmp_path / size):
            seen.append(sorted(map(repr, read_transactions(spark, path).collect())))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(s == seen[0] for s in seen)


def test_keys_are_dense_with_many_equal_rows(spark):
    from ledgerlens.sources.transactions import dense_keys
    df = spark.range(1000).selectExpr("if(id < 700, 0, id) as a", "cast(null as string) as b")
    keyed = dense_keys(df, block=100).collect()
    assert sorted(r.tx_id for r in keyed) == list(range(1000)) and sum(r.a == 0 for r in keyed) == 700
    equal = sorted(r.tx_id for r in keyed if r.a == 0)
    assert equal == list(range(equal[0], equal[0] + 700))
    assert dense_keys(df.limit(0)).count() == 0


def test_codes_of_skewed_and_alike_labels(spark):
    from ledgerlens.operators.clean import encode_remaining_strings, label_codes
    df = spark.range(4000).selectExpr("id as tx_id", "case when id % 2 = 0 then 'same' when id = 1 then null "
                                      "else concat('prefix-', id) end as name")
    want = {x: i for i, x in enumerate(sorted({"same", "nan", *(f"prefix-{i}" for i in range(3, 4000, 2))}))}
    assert {r.label: r.code for r in label_codes(df, "name", ranges=16).collect()} == want
    small, split = encode_remaining_strings(df), encode_remaining_strings(df, broadcast_rows=10)
    assert small.exceptAll(split).count() == 0 and split.exceptAll(small).count() == 0 and small.count() == 4000
    assert small.where("tx_id = 1").first()["name"] == want["nan"] and small.where("tx_id = 2").first()["name"] == want["same"]


def test_codes_of_over_a_million_labels_with_half_of_the_rows_in_one(spark):
    """No task gets more than its share, every row keeps its code, and the code table has each label once."""
    n = 2_200_000
    df = spark.range(n).selectExpr("id as tx_id", "if(id % 2 = 0, 'same', lpad(cast(id as string), 12, '0')) as name")
    codes = clean.label_codes(df, "name")
    assert codes.agg({"code": "max", "n_rows": "max"}).first().asDict() == {"max(code)": n // 2, "max(n_rows)": n // 2}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = clean.encode_remaining_strings(df)  # over the default number of labels
        right = got.where(f"name = if(tx_id % 2 = 0, {n // 2}, tx_id div 2)")
        tasks = [r["count"] for r in right.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(tasks) == n and max(tasks) < 1.2 * n / len(tasks) and len(tasks) > 1


def test_codes_of_long_clashing_and_missing_labels(spark):
    """Labels of over 63 characters, one that is the digest of another, columns with a dot, and rows that are alike."""
    import hashlib
    long = "x" * 5000
    texts = [long, hashlib.sha256(long.encode()).hexdigest(), "y" * 64, "y" * 63, "", None, "nan", long, "", "Z"]
    df = spark.createDataFrame([(t, t, 1) for t in texts], "`a.b` string, b string, code int")
    want = {t: float(i) for i, t in enumerate(sorted({"nan" if t is None else t for t in texts}))}
    expected = sorted((want["nan" if t is None else t],) * 2 + (1,) for t in texts)
    for limit in (1_000_000, 2):
        got = clean.encode_remaining_strings(df, broadcast_rows=limit)
        assert got.columns == df.columns and sorted(map(tuple, got.collect())) == expected
    assert clean.encode_remaining_strings(df.limit(0), broadcast_rows=0).collect() == []
