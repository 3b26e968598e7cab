"""Rows that several aggregates read move once; wide specs are aggregated in tiles."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from ledgerloom.operators import aggspec as A
from ledgerloom.operators import sequences as Q
from ledgerloom.operators.skew import co_locate
from ledgerloom.plans import history


@contextmanager
def static_plans(spark):
    """Plans as they are without measured sizes, reuse of exchanges included."""
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxPlanStringLength": "10000000"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def exchanges(df):
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    return sum("Exchange hashpartitioning" in line and "ReusedExchange" not in line for line in lines)


def payments(spark):
    rows = [(p, k, n, 1.0, float(-30 * n - k), float(-30 * n - k + n % 3), 100.0 * n, 100.0 * n - (n % 2))
            for k in range(4) for p in (10 * k, 10 * k + 1) for n in range(1, 6)]
    rows += [(None, 1, 1, 1.0, -5.0, -4.0, 50.0, 20.0), (3, None, 1, 1.0, -5.0, -9.0, 50.0, 20.0), (10, 2, 1, None, -7.0, None, 5.0, None),
             (11, 1, None, 1.0, -5.0, -5.0, 50.0, 7.0), rows[0]]
    return spark.createDataFrame(rows, """SK_ID_PREV long, SK_ID_CURR long, NUM_INSTALMENT_NUMBER int, NUM_INSTALMENT_VERSION double,
        DAYS_INSTALMENT double, DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double""")


def test_instalments_move_once_by_loan_and_once_by_applicant(spark):
    with static_plans(spark):
        assert exchanges(history.installment_features(payments(spark))) == 2


def by_values(df):
    """Rows in any order; the last digits depend on the order of addition."""
    return sorted(str([f"{v:.9g}" if isinstance(v, float) else v for v in r]) for r in df.collect())


def test_totals_and_newest_days_are_the_same_in_place(spark):
    df = payments(spark)
    keys = ["SK_ID_PREV", "NUM_INSTALMENT_NUMBER"]
    assert by_values(Q.partition_total(df, keys, "AMT_PAYMENT", "T", True).select(sorted(df.columns + ["T"]))) == by_values(
        Q.partition_total(df, keys, "AMT_PAYMENT", "T").select(sorted(df.columns + ["T"])))
    newest = [Q.entities_active_since(df, "SK_ID_PREV", "DAYS_INSTALMENT", flag).select(sorted(df.columns + ["LAST_DAY"])) for flag in (True, False)]
    assert by_values(newest[0]) == by_values(newest[1])


def test_instalments_with_a_hot_loan_are_the_same(spark, monkeypatch):
    from ledgerloom.operators import skew
    usual = by_values(history.installment_features(payments(spark)))
    monkeypatch.setattr(skew, "ROWS_PER_PIECE", 3)
    assert by_values(history.installment_features(payments(spark))) == usual


def test_tiles_hold_every_aggregate_once_and_are_compiled(spark):
    df = spark.range(40).select((F.col("id") % 7).alias("k"), *[(F.col("id") * (i + 1) % 11).cast("double").alias(f"c{i}") for i in range(40)])
    spec = {f"c{i}": ["min", "mean", "var", "sum", "count"] for i in range(40)}
    segments = [A.Segment("ALL_", spec), A.Segment("EVEN_", spec, F.col("c0") % 2 == 0)]
    whole, tiled = A.segmented_agg(df, "k", segments), A.segmented_agg(co_locate(df, "k"), "k", segments, tiled=True)
    assert whole.columns == tiled.columns
    assert by_values(whole) == by_values(tiled)
    with static_plans(spark):
        planned = A.segmented_agg(co_locate(df, "k"), "k", segments, tiled=True)
        lines = planned._jdf.queryExecution().executedPlan().toString().split("\n")
        assert not [line for line in lines if "HashAggregate" in line and "*(" not in line]
        assert exchanges(planned) == 1


def test_newest_entity_may_be_missing(spark):
    df = spark.createDataFrame([(1, "a", 1, 1.0), (1, None, 2, 5.0), (2, "b", 1, 3.0), (None, "b", 1, 2.0)], "k int, e string, d int, x double")
    assert {r.k: r.LAST_x_SUM for r in Q.latest_entity_stats(df, "k", "e", [F.col("d")], {"x": ["sum"]}).collect()} == {2: 3.0}


def test_master_table_writes_each_block_before_the_join(spark, monkeypatch):
    from ledgerloom.plans import applicants
    blocks = ["bureau_features", "previous_features", "pos_features", "installment_features", "card_features"]
    for name in ["application_features", *blocks]:
        monkeypatch.setattr(applicants, name, lambda *_, n=name: spark.createDataFrame([(1, 2.0)], f"SK_ID_CURR long, {n} double"))
    for name in ("post_join_ratios", "duration_group_features"):
        monkeypatch.setattr(applicants, name, lambda df: df)
    written = []
    monkeypatch.setattr(applicants, "durable", lambda df: written.append(df.columns) or df)
    names = ["application", "bureau", "bureau_balance", "previous_application", "installments_payments", "POS_CASH_balance", "credit_card_balance"]
    assert applicants.master_feature_table(dict.fromkeys(names)).columns == ["SK_ID_CURR", "application_features", *blocks]
    assert written[:-1] == [["SK_ID_CURR", n] for n in blocks]
