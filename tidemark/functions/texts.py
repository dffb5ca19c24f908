"""Texts, levels and labels that outputs must carry exactly."""

# Validation messages.
MSG_MISSING = "Field required"
MSG_MIN_LENGTH_1 = "String should have at least 1 character"
MSG_GT_0 = "Input should be greater than 0"
MSG_GE_0 = "Input should be greater than or equal to 0"
MSG_LE_100 = "Input should be less than or equal to 100"
MSG_EMAIL = "value is not a valid email address"
MISSING_NAME = "상품명 누락"

# What to do about a product field that failed its rule.
PRODUCT_ACTIONS = {
    "price": "원가표를 확인하고 0원보다 큰 판매가를 다시 입력",
    "stock": "매대와 창고의 실재고를 다시 세어 0 이상으로 수정",
    "product_name": "바코드와 입고표를 확인해 상품명을 입력",
}

# Alert levels, most pressing first.
LEVEL_DATA = "데이터 오류"
LEVEL_URGENT = "긴급"
LEVEL_CAUTION = "주의"
LEVEL_CHECK = "확인"
LEVEL_WATCH = "관심"
ALERT_LEVELS = (LEVEL_DATA, LEVEL_URGENT, LEVEL_CAUTION, LEVEL_CHECK, LEVEL_WATCH)

# Alert reasons and actions (printf patterns where they vary).
OUT_REASON = "현재 재고가 0개로 품절 상태"
OUT_ACTION = "오늘 바로 최소 %d개 발주"
EXP_REASON = "유통기한 %d일, 남은 재고 %d개"
EXP_ACTION = "마감 할인·1+1 행사 후 남은 수량은 폐기 기준 확인"
LOW_REASON = "재고 %d개, 약 %.1f일분 남음"
LOW_ACTION = "%d일 판매분을 고려해 약 %d개 발주"
PRICE_REASON = "이전 가격보다 %+.1f%% 변동"
PRICE_ACTION = "입고가와 가격표를 대조하고 오입력이면 판매가 수정"
NOSALE_REASON = "판매 0개인데 재고가 %d개 남음"
NOSALE_ACTION = "진열 위치 변경 또는 묶음 할인 후 추가 발주 보류"
OVER_REASON = "현재 판매 속도 기준 약 %.1f일분 재고"
OVER_ACTION = "추가 발주를 보류하고 행사 상품으로 우선 판매"

# Churn risk tiers and coaching grades, highest first.
TIERS = ("🔴 높음", "🟡 중간", "🟢 낮음")
GRADES = ("우선코칭", "관찰", "안정")

# Headings of the retention and coaching lists.
RETENTION_HEADINGS = {
    "customer_id": "customer_id",
    "tier": "위험도",
    "probability": "이탈확률",
    "monthly_charges": "monthly_charges",
    "expected_loss": "월기대손실",
    "contract": "contract",
    "tenure_months": "tenure_months",
}
COACHING_HEADINGS = {
    "learner": "이름",
    "track": "트랙",
    "help": "도움요청",
    "day1_done": "day1_완료",
    "day2_done": "day2_완료",
    "done": "전체_완료",
    "progress_pct": "진도율",
    "risk": "위험점수",
    "grade": "등급",
}

# Labels of the sales report's headline figures.
KPI_TOTAL = "총매출"
KPI_ORDERS = "주문 건수"
KPI_MEAN = "건당 평균매출"
KPI_TOP = "매출 1위"
