"""Store alerts and customer priorities."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import priority, store, validation
from tidemark.plans.quality import INVALID, VALID
from tidemark.plans.registry import query
from tidemark.plans.tables import Tables, scored_customers, store_products

_METRICS = f"""
    SELECT *, price * stock AS inventory_value,
           round((price - last_price) / nullif(last_price, 0) * 100, 1) AS price_change_pct,
           CASE WHEN daily_sales = 0 THEN 999.0::double
                ELSE round(stock / nullif(daily_sales, 0), 1) END AS days_of_stock
    FROM ({VALID})"""
# Levels, reasons and actions.
_ALERTS = f"""
    WITH m AS ({_METRICS})
    SELECT 'DATA-' || product_id AS alert_id, '데이터 오류' AS level, product_name AS product,
           error_field || ': ' || error_message AS reason, recommended_action AS action
    FROM ({INVALID})
    UNION ALL SELECT 'OUT-' || product_id, '긴급', product_name, '현재 재고가 0개로 품절 상태',
           '오늘 바로 최소 ' || 2 * reorder_level || '개 발주' FROM m WHERE stock = 0
    UNION ALL SELECT 'EXP-' || product_id, '긴급', product_name,
           '유통기한 ' || expiry_days || '일, 남은 재고 ' || stock || '개',
           '마감 할인·1+1 행사 후 남은 수량은 폐기 기준 확인'
           FROM m WHERE expiry_days <= 2 AND stock > 0 AND stock > expiry_days * daily_sales
    UNION ALL SELECT 'LOW-' || product_id, '주의', product_name,
           '재고 ' || stock || '개, 약 ' || printf('%.1f', days_of_stock) || '일분 남음',
           '7일 판매분을 고려해 약 ' || greatest(0, cast(7 * daily_sales - stock AS bigint)) || '개 발주'
           FROM m WHERE stock <> 0 AND (stock <= reorder_level OR days_of_stock < 2)
    UNION ALL SELECT 'PRICE-' || product_id, '확인', product_name,
           '이전 가격보다 ' || printf('%+.1f', price_change_pct) || '% 변동',
           '입고가와 가격표를 대조하고 오입력이면 판매가 수정' FROM m WHERE abs(price_change_pct) >= 20
    UNION ALL SELECT 'NOSALE-' || product_id, '관심', product_name,
           '판매 0개인데 재고가 ' || stock || '개 남음', '진열 위치 변경 또는 묶음 할인 후 추가 발주 보류'
           FROM m WHERE daily_sales = 0 AND stock > 0
    UNION ALL SELECT 'OVER-' || product_id, '관심', product_name,
           '현재 판매 속도 기준 약 ' || printf('%.1f', days_of_stock) || '일분 재고',
           '추가 발주를 보류하고 행사 상품으로 우선 판매' FROM m WHERE daily_sales > 0 AND days_of_stock >= 30"""


def _alerts(t: Tables) -> DataFrame:
    valid, invalid = validation.validate_products(store_products(t.part))
    return store.alerts(store.store_metrics(valid), invalid)


@query("store_metrics", _METRICS)
def store_metrics(t: Tables) -> DataFrame:
    return store.store_metrics(validation.validate_products(store_products(t.part))[0])


@query("alerts", _ALERTS)
def alerts(t: Tables) -> DataFrame:
    return _alerts(t)


@query("open_alerts", f"""
    SELECT * FROM ({_ALERTS})
    WHERE alert_id NOT IN (SELECT 'LOW-' || p_partkey FROM part WHERE p_size < 10)""")
def open_alerts(t: Tables) -> DataFrame:
    done = t.part.where(F.col("p_size") < 10).select(
        F.concat(F.lit("LOW-"), F.col("p_partkey").cast("string")).alias("alert_id"))
    return store.open_alerts(_alerts(t), done)


_SCORED = """
    SELECT c_custkey AS customer_id, coalesce(round(open / orders, 3), 0) AS probability, c_acctbal / 97 AS monthly_charges
    FROM customer LEFT JOIN (
        SELECT o_custkey, count(*) AS orders, count(*) FILTER (o_orderstatus <> 'F') AS open
        FROM orders GROUP BY 1) ON c_custkey = o_custkey"""
_LOSS = f"SELECT *, round(probability * monthly_charges, 1) AS expected_loss FROM ({_SCORED})"
_TIER = """CASE WHEN probability >= 0.6 THEN '🔴 높음' WHEN probability >= 0.35 THEN '🟡 중간'
                ELSE '🟢 낮음' END AS tier"""


@query("expected_loss", _LOSS)
def expected_loss(t: Tables) -> DataFrame:
    return priority.expected_loss(scored_customers(t))


@query("risk_tier", f"SELECT *, {_TIER} FROM ({_SCORED})")
def risk_tier(t: Tables) -> DataFrame:
    return priority.risk_tier(scored_customers(t))


@query("retention_priority", f"SELECT *, {_TIER} FROM ({_LOSS})")
def retention_priority(t: Tables) -> DataFrame:
    return priority.retention_priority(scored_customers(t))


@query("call_list", f"""
    SELECT *, {_TIER} FROM ({_LOSS}) ORDER BY expected_loss DESC, customer_id LIMIT 10""")
def call_list(t: Tables) -> DataFrame:
    return priority.call_list(scored_customers(t))
