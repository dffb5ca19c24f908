"""Small inputs with known results."""

# A store's product feed, three of whose rows are faulty.
STORE_COLUMNS = (
    "product_id STRING, product_name STRING, category STRING, price LONG, stock LONG, daily_sales DOUBLE, "
    "reorder_level LONG, expiry_days INT, last_price LONG, source STRING"
)
STORE_PRODUCTS = [
    ("P001", "레쓰비 마일드 커피", "커피", 1200, 4, 5.0, 10, 90, 1200, "매대"),
    ("P002", "조지아 오리지널", "커피", 1500, 24, 4.0, 8, 120, 1500, "창고"),
    ("P003", "맥심 T.O.P 마스터라떼", "커피", 2400, 18, 3.0, 6, 100, 2400, "공급업체"),
    ("P004", "바리스타룰스 에스프레소라떼", "커피", 2600, 0, 4.0, 8, 80, 2600, "매대"),
    ("P005", "스타벅스 카페라떼", "커피", 3500, 10, 2.0, 5, 60, 2700, "공급업체"),
    ("P006", "얼음컵 180g", "얼음", 800, 45, 12.0, 20, 365, 800, "매대"),
    ("P007", "얼음컵 230g", "얼음", 1000, -3, 9.0, 20, 365, 1000, "창고"),
    ("P008", "왕얼음컵 300g", "얼음", 1200, 150, 3.0, 15, 365, 1200, "창고"),
    ("P009", "새우깡", "과자", 1700, 25, 3.0, 8, 180, 1700, "매대"),
    ("P010", "포카칩 오리지널", "과자", 1800, 6, 5.0, 10, 150, 1800, "매대"),
    ("P011", "꼬북칩 초코츄러스", "과자", 2000, 20, 4.0, 8, 180, 2000, "창고"),
    ("P012", "홈런볼 초코", "과자", 1800, 40, 1.0, 8, 150, 1800, "창고"),
    ("P013", "오징어땅콩", "과자", 1700, 15, 2.0, 6, 180, 1700, "매대"),
    ("P014", "초코송이", "과자", 0, 18, 2.0, 6, 160, 1600, "공급업체"),
    ("P015", "빼빼로 초코", "과자", 1800, 30, 0.0, 8, 150, 1800, "창고"),
    ("P016", "프링글스 오리지널", "과자", 3500, 12, 2.0, 6, 240, 3500, "매대"),
    ("P017", "하리보 골드베렌", "과자", 2000, 16, 2.0, 6, 300, 2000, "공급업체"),
    ("P018", "포테토칩 육개장맛", "과자", 1800, 14, 3.0, 7, 170, 1800, "매대"),
    ("P019", "코카콜라 500ml", "음료", 2200, 4, 6.0, 12, 150, 2200, "매대"),
    ("P020", None, "음료", 2000, 18, 4.0, 8, 150, 2000, "창고"),
    ("P021", "웰치스 포도 355ml", "음료", 1800, 15, 3.0, 8, 180, 1800, "공급업체"),
    ("P022", "삼다수 500ml", "음료", 1000, 50, 10.0, 20, 300, 1000, "창고"),
    ("P023", "바나나맛우유", "음료", 1800, 22, 3.0, 8, 3, 1800, "매대"),
    ("P024", "참치마요 삼각김밥", "간편식", 1500, 20, 5.0, 8, 1, 1500, "매대"),
    ("P025", "햄치즈 샌드위치", "간편식", 2800, 12, 2.0, 5, 1, 2800, "창고"),
    ("P026", "신라면 컵라면", "간편식", 1600, 7, 5.0, 10, 120, 1600, "매대"),
]

# The alerts it must raise, in order (id, level, reason, action).
STORE_ALERTS = [
    ("DATA-P020", "데이터 오류",
     "product_name: String should have at least 1 character",
     "바코드와 입고표를 확인해 상품명을 입력"),
    ("DATA-P007", "데이터 오류",
     "stock: Input should be greater than or equal to 0",
     "매대와 창고의 실재고를 다시 세어 0 이상으로 수정"),
    ("DATA-P014", "데이터 오류",
     "price: Input should be greater than 0",
     "원가표를 확인하고 0원보다 큰 판매가를 다시 입력"),
    ("OUT-P004", "긴급",
     "현재 재고가 0개로 품절 상태",
     "오늘 바로 최소 16개 발주"),
    ("EXP-P024", "긴급",
     "유통기한 1일, 남은 재고 20개",
     "마감 할인·1+1 행사 후 남은 수량은 폐기 기준 확인"),
    ("EXP-P025", "긴급",
     "유통기한 1일, 남은 재고 12개",
     "마감 할인·1+1 행사 후 남은 수량은 폐기 기준 확인"),
    ("LOW-P001", "주의",
     "재고 4개, 약 0.8일분 남음",
     "7일 판매분을 고려해 약 31개 발주"),
    ("LOW-P026", "주의",
     "재고 7개, 약 1.4일분 남음",
     "7일 판매분을 고려해 약 28개 발주"),
    ("LOW-P019", "주의",
     "재고 4개, 약 0.7일분 남음",
     "7일 판매분을 고려해 약 38개 발주"),
    ("LOW-P010", "주의",
     "재고 6개, 약 1.2일분 남음",
     "7일 판매분을 고려해 약 29개 발주"),
    ("PRICE-P005", "확인",
     "이전 가격보다 +29.6% 변동",
     "입고가와 가격표를 대조하고 오입력이면 판매가 수정"),
    ("NOSALE-P015", "관심",
     "판매 0개인데 재고가 30개 남음",
     "진열 위치 변경 또는 묶음 할인 후 추가 발주 보류"),
    ("OVER-P008", "관심",
     "현재 판매 속도 기준 약 50.0일분 재고",
     "추가 발주를 보류하고 행사 상품으로 우선 판매"),
    ("OVER-P012", "관심",
     "현재 판매 속도 기준 약 40.0일분 재고",
     "추가 발주를 보류하고 행사 상품으로 우선 판매"),
]

# Inventory value, price change and days of stock per valid product.
STORE_METRICS = {
    "P001": (4800, 0.0, 0.8),
    "P002": (36000, 0.0, 6.0),
    "P003": (43200, 0.0, 6.0),
    "P004": (0, 0.0, 0.0),
    "P005": (35000, 29.6, 5.0),
    "P006": (36000, 0.0, 3.8),
    "P008": (180000, 0.0, 50.0),
    "P009": (42500, 0.0, 8.3),
    "P010": (10800, 0.0, 1.2),
    "P011": (40000, 0.0, 5.0),
    "P012": (72000, 0.0, 40.0),
    "P013": (25500, 0.0, 7.5),
    "P015": (54000, 0.0, 999.0),
    "P016": (42000, 0.0, 6.0),
    "P017": (32000, 0.0, 8.0),
    "P018": (25200, 0.0, 4.7),
    "P019": (8800, 0.0, 0.7),
    "P021": (27000, 0.0, 5.0),
    "P022": (50000, 0.0, 5.0),
    "P023": (39600, 0.0, 7.3),
    "P024": (30000, 0.0, 4.0),
    "P025": (33600, 0.0, 6.0),
    "P026": (11200, 0.0, 1.4),
}

# learners' checklist results (id, track, help, day1, day2, progress, risk, grade).
COACHING = [
    ("L01", "major", True, 4, 0, 28.57142857142857, 85.7, "우선코칭"),
    ("L02", "non-major", False, 6, 0, 42.857142857142854, 48.6, "우선코칭"),
    ("L03", "non-major", False, 7, 1, 57.14285714285714, 38.6, "관찰"),
    ("L04", "non-major", False, 7, 1, 57.14285714285714, 38.6, "관찰"),
    ("L05", "non-major", False, 7, 2, 64.28571428571429, 32.1, "관찰"),
    ("L06", "non-major", False, 7, 3, 71.42857142857143, 25.7, "관찰"),
    ("L07", "major", False, 7, 3, 71.42857142857143, 25.7, "관찰"),
    ("L08", "non-major", False, 7, 5, 85.71428571428571, 12.9, "안정"),
    ("L09", "major", False, 7, 7, 100.0, 0.0, "안정"),
    ("L10", "major", False, 7, 7, 100.0, 0.0, "안정"),
]

# Learners who finished each of 14 tasks (7 on each of two days), in order.
FUNNEL = [10, 10, 10, 10, 9, 9, 8, 8, 6, 5, 3, 3, 2, 2]
