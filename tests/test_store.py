import pytest

from tests.conftest import rows
from tests.fixtures import STORE_ALERTS, STORE_COLUMNS, STORE_METRICS, STORE_PRODUCTS
from tidemark.operators import store, validation


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(STORE_PRODUCTS, STORE_COLUMNS)


def test_valid_and_invalid_cover_the_input(products):
    valid, invalid = validation.validate_products(products)
    assert (valid.count(), invalid.count()) == (23, 3)
    assert sorted(rows(invalid, "product_id", "product_name", "error_field")) == [
        ("P007", "얼음컵 230g", "stock"), ("P014", "초코송이", "price"), ("P020", "상품명 누락", "product_name")]


def test_metrics(products):
    metrics = store.store_metrics(validation.validate_products(products)[0])
    got = rows(metrics, "product_id", "inventory_value", "price_change_pct", "days_of_stock")
    assert {p: tuple(v) for p, *v in got} == STORE_METRICS


def test_alerts_in_order(products):
    valid, invalid = validation.validate_products(products)
    raised = store.alerts(store.store_metrics(valid), invalid)
    assert rows(raised, "alert_id", "level", "reason", "action") == STORE_ALERTS


def test_done_alerts_are_hidden(spark, products):
    valid, invalid = validation.validate_products(products)
    done = spark.createDataFrame([("OUT-P004",), ("DATA-P007",)], "alert_id STRING")
    left = store.open_alerts(store.alerts(store.store_metrics(valid), invalid), done)
    assert [r[0] for r in rows(left, "alert_id")] == [a[0] for a in STORE_ALERTS if a[0] not in ("OUT-P004", "DATA-P007")]


def test_order_days_and_empty_shelves(spark):
    two = spark.createDataFrame([("X", "x", "c", 1000, 4, 3.0, 5, 9, 1000, "s"), ("Y", "y", "c", 1000, 0, 3.0, 5, -1, 1000, "s")], STORE_COLUMNS)
    raised = store.product_alerts(store.store_metrics(two), store.AlertLimits(order_days=14))
    assert {r[0]: r[1] for r in rows(raised, "alert_id", "action")}["LOW-X"] == "14일 판매분을 고려해 약 38개 발주"
    assert {r[0] for r in rows(raised, "alert_id")} == {"LOW-X", "OUT-Y"}


def test_one_product_may_raise_several_alerts(spark):
    one = spark.createDataFrame(
        [("X", "x", "c", 1000, 4, 1.0, 5, 1, 500, "s")], STORE_COLUMNS)
    raised = store.product_alerts(store.store_metrics(one))
    assert {r[0] for r in rows(raised, "alert_id")} == {"EXP-X", "LOW-X", "PRICE-X"}
