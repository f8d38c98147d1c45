"""Business rules: quintile scores, segment rules, lookups and tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the original analysis): segment names, the ordered
# segment rules, the two segment encodings, the strategy / action texts and
# the probability tiers.
# ---------------------------------------------------------------------------

# Segment rules, first match wins. Each rule: (segment, r-test, f-test, m-test)
# where a test is (op, value) or None for "any".
SEGMENT_RULES = [
    ("Champions",           (">=", 4), (">=", 4), (">=", 4)),
    ("Loyal Customers",     (">=", 3), (">=", 3), (">=", 3)),
    ("Potential Loyalists", (">=", 3), (">=", 2), (">=", 2)),
    ("New Customers",       (">=", 4), ("==", 1), None),
    ("Promising",           (">=", 3), ("==", 1), (">=", 3)),
    ("Need Attention",      ("==", 3), (">=", 2), (">=", 2)),
    ("About to Sleep",      ("==", 2), (">=", 2), None),
    ("At Risk",             ("<=", 2), (">=", 3), (">=", 3)),
    ("Cannot Lose Them",    ("<=", 2), (">=", 4), (">=", 4)),
    ("Hibernating",         ("<=", 2), ("<=", 2), ("<=", 2)),
    ("Lost",                ("==", 1), None, None),
]
OTHER_SEGMENT = "Others"
SEGMENT_ORDER = [name for name, *_ in SEGMENT_RULES] + [OTHER_SEGMENT]

# segment → value code (time-series step)
SEGMENT_VALUE_CODE = {
    "Champions": 11, "Loyal Customers": 10, "Potential Loyalists": 9,
    "New Customers": 8, "Promising": 7, "Need Attention": 6,
    "About to Sleep": 5, "At Risk": 4, "Cannot Lose Them": 3,
    "Hibernating": 2, "Lost": 1, "Others": 0,
}
SEGMENT_VALUE_DEFAULT = 0

# segment → churn risk level (integrated step)
SEGMENT_RISK_LEVEL = {
    "Champions": 1, "Loyal Customers": 2, "Potential Loyalists": 3,
    "Promising": 3, "New Customers": 4, "Need Attention": 5,
    "About to Sleep": 6, "At Risk": 7, "Cannot Lose Them": 8,
    "Hibernating": 8, "Lost": 9, "Others": 5,
}
SEGMENT_RISK_DEFAULT = 5

# segment → marketing strategy (RFM step; only these seven have one)
SEGMENT_STRATEGY = {
    "Champions": "독점 혜택, VIP 프로그램, 조기 접근권 제공",
    "Loyal Customers": "로열티 프로그램 강화, 추천 보상 제공",
    "Potential Loyalists": "참여 유도 캠페인, 브랜드 가치 전달",
    "New Customers": "온보딩 프로그램, 두 번째 구매 유도 할인",
    "At Risk": "재활성화 캠페인, 개인화된 오퍼 제공",
    "Cannot Lose Them": "긴급 개입, 1:1 커뮤니케이션, 특별 할인",
    "Lost": "Win-back 캠페인, 대폭 할인, 제품 업데이트 알림",
}

# segment → action and tactics (time-series step)
ACTION_PLANS = {
    "At Risk": ("긴급 재참여 캠페인",
                ["개인화된 할인 쿠폰", "독점 제품 미리보기", "무료 배송"]),
    "Cannot Lose Them": ("1:1 고객 관리",
                         ["전담 매니저 배정", "VIP 혜택", "맞춤형 상품 추천"]),
    "Hibernating": ("Win-back 캠페인",
                    ["복귀 할인", "신제품 알림", "브랜드 스토리 공유"]),
    "About to Sleep": ("관심 유도",
                       ["이메일 빈도 조정", "관심사 기반 콘텐츠", "소셜 미디어 타겟팅"]),
}

# probability tiers: (low, high] → label; exactly 0 falls in no tier
RISK_TIERS = [
    (0.0, 0.3, "Low"),
    (0.3, 0.5, "Medium"),
    (0.5, 0.7, "High"),
    (0.7, 1.0, "Very High"),
]

# ---------------------------------------------------------------------------


def _test(col: Column, spec) -> Column | None:
    if spec is None:
        return None
    op, value = spec
    return {">=": col >= value, "<=": col <= value, "==": col == value}[op]


def segment_of(r: Column, f: Column, m: Column) -> Column:
    """L1: one CASE chain over the ordered rules."""
    expr = None
    for name, rt, ft, mt in SEGMENT_RULES:
        conds = [c for c in (_test(r, rt), _test(f, ft), _test(m, mt)) if c is not None]
        cond = conds[0]
        for c in conds[1:]:
            cond = cond & c
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(OTHER_SEGMENT)


def quintile(rank: Column, n: Column, k: int = 5) -> Column:
    """Bin of rank 1..n when ranks are cut into ``k`` equal-width
    quantile bins (first bin closed on the left).

    Bin edges are ``1 + j·(n-1)/k``; rank ``rk`` lands in the smallest ``j``
    with ``rk <= edge_j``, i.e. ``ceil(k·(rk-1)/(n-1))``, at least 1.
    A single row is bin 1.
    """
    num = F.lit(k) * (rank - 1) + n - 2
    return (F.when(n <= 1, F.lit(1))
            .otherwise(F.greatest(F.lit(1), F.floor(num / (n - 1)).cast("int")))
            .cast("int"))


def risk_tier(prob: Column) -> Column:
    """Right-closed bins; exactly 0 (or out of range) gives NULL."""
    expr = None
    for low, high, label in RISK_TIERS:
        cond = (prob > low) & (prob <= high)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def _lookup(col: Column, mapping: dict, default) -> Column:
    expr = None
    for key, value in mapping.items():
        expr = F.when(col == key, value) if expr is None else expr.when(col == key, value)
    return expr.otherwise(default)


def segment_value_code(segment: Column) -> Column:
    """L3: segment → 11..0 (unknown → 0)."""
    return _lookup(segment, SEGMENT_VALUE_CODE, SEGMENT_VALUE_DEFAULT).cast("int")


def segment_risk_level(segment: Column) -> Column:
    """L4: segment → 1..9 (unknown → 5)."""
    return _lookup(segment, SEGMENT_RISK_LEVEL, SEGMENT_RISK_DEFAULT).cast("int")
