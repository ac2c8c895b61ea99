"""The feature matrix from a refreshed state equals the one from all tables."""

from datetime import datetime, timedelta

import pytest

from clientela.operators import features, incremental
from clientela.operators.incremental import OrderTables, changed_orders, first_state, matrix_of_state, refresh
from clientela.session import materialise

SNAPSHOT = "2018-10-17"
START = datetime(2018, 1, 1)
ORDERS = f"order_id string, customer_id string, {features.PURCHASED} timestamp, {features.DELIVERED} timestamp, {features.ESTIMATED} timestamp"
ITEMS = "order_id string, order_item_id int"
PAYMENTS = "order_id string, payment_value double, payment_installments int"
REVIEWS = "review_id string, order_id string, review_score int"


def day(number):
    return None if number is None else START + timedelta(days=number)


def tables(spark, orders, items, payments, reviews):
    dated = [(o, c, *map(day, days)) for o, c, *days in orders]
    return OrderTables(
        spark.createDataFrame(dated, ORDERS),
        spark.createDataFrame([(o, i) for o, n in items for i in range(n)], ITEMS),
        spark.createDataFrame(payments, PAYMENTS),
        spark.createDataFrame(reviews, REVIEWS),
    )


BEFORE = {
    "orders": [
        ("o1", "a", 1, 5, 9), ("o2", "a", 20, None, 30), ("o3", "b", 3, 4, 3), ("o4", "c", 7, 9, None),
        ("o5", "c", 8, 20, 10), ("o6", None, 9, 9, 9), ("o7", "e", 4, 6, 8), ("o8", "f", 2, 3, 4),
    ],
    "items": [("o1", 2), ("o2", 1), ("o3", 3), ("o4", 1), ("o5", 2), ("o6", 1), ("o8", 1)],
    "payments": [("o1", 10.1, 1), ("o1", 5.05, 3), ("o2", 7.0, None), ("o3", 0.1, 2), ("o8", 1.0, 1)],
    "reviews": [("r1", "o1", 5), ("r2", "o3", 1), ("r3", "o7", 4), ("r4", "o5", None)],
}
AFTER = {
    # o2 (the latest of a) and o3 (the only one of b) canceled, o4 delivered later, o5 moves to d, o6 gets a customer.
    "orders": [
        ("o1", "a", 1, 5, 9), ("o4", "c", 7, 30, None), ("o5", "d", 8, 20, 10), ("o6", "a", 0, 9, 9),
        ("o7", "e", 4, 6, 8), ("o8", "f", 2, 3, 4), ("o9", "g", 50, None, None),
    ],
    "items": [("o1", 2), ("o4", 1), ("o5", 2), ("o6", 1), ("o7", 1), ("o8", 1), ("o9", 4)],
    "payments": [("o1", 10.1, 1), ("o2", 7.0, None), ("o3", 0.1, 2), ("o8", 1.0, 1), ("o8", 1.0, 1), ("o9", 0.3, 1)],
    "reviews": [("r1", "o8", 5), ("r2", "o3", 1), ("r3", "o7", 4), ("r4", "o5", 2)],
}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def full(t):
    return rows(features.order_grain_feature_matrix(t.orders, t.items, t.payments, t.reviews, SNAPSHOT))


@pytest.fixture(scope="module")
def before(spark):
    return tables(spark, **BEFORE)


@pytest.fixture(scope="module")
def after(spark):
    return tables(spark, **AFTER)


@pytest.fixture(scope="module")
def state(before):
    return first_state(before)


def test_first_state(before, state):
    assert rows(matrix_of_state(state, SNAPSHOT)) == full(before)


def test_changed_orders(before, after):
    ids = {r.order_id for r in changed_orders(before, after).collect()}
    assert ids == {"o1", "o2", "o3", "o4", "o5", "o6", "o7", "o8", "o9"}
    assert changed_orders(after, after).count() == 0


def test_refreshed_state(state, before, after):
    now = refresh(state, after, changed_orders(before, after))
    assert rows(matrix_of_state(now, SNAPSHOT)) == full(after)
    assert rows(now.sums) == rows(first_state(after).sums)
    # and back again
    back = refresh(now, before, changed_orders(before, after))
    assert rows(back.sums) == rows(state.sums) and rows(back.partials) == rows(state.partials)


def test_needless_repeated_and_null_ids(spark, state, before):
    ids = spark.createDataFrame([("o1",), ("o1",), (None,), ("unknown",)], "order_id string")
    assert rows(refresh(state, before, ids).sums) == rows(state.sums)


def test_nothing_changed_and_all_gone(spark, state, before):
    none = spark.createDataFrame([], "order_id string")
    assert rows(refresh(state, before, none).sums) == rows(state.sums)
    empty = tables(spark, [], [], [], [])
    gone = refresh(state, empty, changed_orders(before, empty))
    assert gone.sums.count() == 0 and matrix_of_state(gone, SNAPSHOT).count() == 0
    assert rows(refresh(gone, before, changed_orders(empty, before)).sums) == rows(state.sums)


def joins_of_new_partials(monkeypatch, *refreshed):
    """Joins in the plan of the changed orders' new partials, and the state after ``refresh``."""
    plans = {}

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return materialise(df, name)

    monkeypatch.setattr(incremental, "materialise", kept)
    now = refresh(*refreshed)
    return {kind: plans["new-partials"].count(kind) for kind in ("SortMergeJoin", "LeftSemi")}, now


def test_many_changed_orders_meet_aggregated_rows(spark, state, before, after, monkeypatch):
    # Each join, sort and aggregate of a stage keeps memory of its own in every task.
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joins, now = joins_of_new_partials(monkeypatch, state, after, changed_orders(before, after))
        assert joins == {"SortMergeJoin": 3, "LeftSemi": 2}
        assert rows(now.sums) == rows(first_state(after).sums)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_few_changed_orders_are_aggregated_alone(spark, state, before, after, monkeypatch):
    joins, now = joins_of_new_partials(monkeypatch, state, after, changed_orders(before, after))
    assert joins["LeftSemi"] == 4  # one at the rows of each table
    assert rows(matrix_of_state(now, SNAPSHOT)) == full(after)


def test_saved_state(spark, state, tmp_path):
    state.save(str(tmp_path / "state"))
    assert rows(incremental.FeatureState.load(spark, str(tmp_path / "state")).sums) == rows(state.sums)
