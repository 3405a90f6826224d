"""Default campaign domain: schemas, category lists, code maps, thresholds and weights.

Operators take these as parameters; nothing below is read from inside a transformation.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_long, _text, _stamp, _day = T.LongType(), T.StringType(), T.TimestampType(), T.DateType()

# Raw tables, columns in file order (loads match by position).
CAMPAIGN_SCHEMA = _schema(
    ADS_IDX=_long, ADV_IDX=_long, SCH_IDX=_long, ADS_TYPE=_long, ADS_CATEGORY=_long,
    ADS_NAME=_text, ADS_SUMMARY=_text, ADS_GUIDE=_text, ADS_SAVE_WAY=_text,
    ADS_SDATE=_stamp, ADS_EDATE=_stamp, ADS_OS_TYPE=_long, ADS_CONTRACT_PRICE=_long,
    ADS_REWARD_PRICE=_long, ADS_ORDER=_long, ADS_REJOIN_TYPE=_text, ADS_REQUIRE_ADID=_text,
)
SCHEDULE_SCHEMA = _schema(
    SCH_IDX=_long, ADS_IDX=_long, MDA_IDX_ARR=_text, SCH_CLK_NUM=_long, SCH_TURN_NUM=_long, SCH_TYPE=_text,
)
REPORT_SCHEMA = _schema(
    RPT_TIME_DATE=_day, RPT_TIME_TIME=_stamp, ADS_IDX=_long, MDA_IDX=_long, RPT_TIME_CLK=_long,
    RPT_TIME_TURN=_long, RPT_TIME_SCOST=_long, RPT_TIME_ACOST=_long, RPT_TIME_COST=_long, RPT_TIME_EARN=_long,
)
SHAPE_SCHEMA = _schema(ADS_SAVE_WAY=_text, ADS_SHAPE=_text)
MAPPING_SCHEMA = _schema(NAME=_text, INDUSTRY=_text)

# The final table, in output order.
FINAL_COLUMNS = [
    "KEY", "DATE", "TIME", "MDA", "NAME", "SAVE_WAY", "GUIDE", "OS_TYPE", "REJOIN_TYPE", "SHAPE", "RPT_TYPE",
    "MDA_ARR", "START_QUARTER", "START_TIME", "START_DATE", "END_DATE", "INDUSTRY", "TIME_CLK", "TIME_TURN",
    "ADV_COST", "REWARD_COST", "MDA_COST", "CVR", "ATS", "1000_W_EFFICIENCY", "CONTRACT_PRICE", "SCH_KEY",
    "LIMIT_TYPE",
]
FLOAT_COLUMNS = [
    "TIME_CLK", "TIME_TURN", "ADV_COST", "REWARD_COST", "MDA_COST", "CVR", "ATS", "1000_W_EFFICIENCY",
    "CONTRACT_PRICE",
]
# Columns that must be present for a row to count as analysable.
REQUIRED_REPORT = ["TIME_CLK", "TIME_TURN", "ADV_COST", "1000_W_EFFICIENCY"]
REQUIRED_CAMPAIGN = ["NAME", "SAVE_WAY", "GUIDE", "OS_TYPE", "REJOIN_TYPE", "START_QUARTER", "START_TIME"]
REQUIRED_SCHEDULE = ["RPT_TYPE", "TURN_GOAL"]

# Operating-system codes.
OS_CODES = {"ANDROID": [2, 3, 8], "IOS": [1], "WEB": [7]}

# The eight industries, the catch-all class, and answers that stand for one of them.
INDUSTRIES = ["F&B/식품", "커머스/유통", "뷰티/헬스", "가전/가구", "게임", "서비스", "금융/보험", "교육/공공"]
OTHER_INDUSTRY = "기타"
INDUSTRY_SYNONYMS = {
    "핀테크": "금융/보험",
    "쇼핑": "커머스/유통",
    "의류": "커머스/유통",
    "의류/잡화": "커머스/유통",
    "쇼핑/유통": "커머스/유통",
    "가전/가구 부속품": "커머스/유통",
    "생활": "커머스/유통",
    "숙박": "서비스",
    "소프트웨어": "서비스",
    "플랫폼": "서비스",
    "꽃배달": "서비스",
    "부동산/임대": "서비스",
    "부동산": "서비스",
    "건강기능식품": "뷰티/헬스",
    "건강/헬스": "뷰티/헬스",
    "헬스/뷰티": "뷰티/헬스",
    "위생/헬스": "뷰티/헬스",
    "카페": "F&B/식품",
    "가구/가전": "가전/가구",
    "가구": "가전/가구",
}

# What belongs to each class, as shown to the classifier and used by the keyword rules.
INDUSTRY_HINTS = {
    "금융/보험": ["은행", "카드", "증권", "보험", "핀테크"],
    "커머스/유통": ["의류", "잡화", "액세서리", "폰케이스", "매트", "필름", "라이너", "오픈마켓", "쇼핑"],
    "서비스": ["법률", "세무", "꽃배달", "배달", "숙박", "플랫폼", "소프트웨어", "체험"],
    "게임": ["게임"],
    "교육/공공": ["학원", "인강", "정부", "지자체", "자격증"],
    "뷰티/헬스": ["화장품", "건강기능식품", "병원", "다이어트", "생리대", "기저귀"],
    "F&B/식품": ["쌀", "고기", "음식점", "카페", "가공식품", "음료"],
    "가전/가구": ["가전", "자동차", "가구", "조립PC", "제조"],
}
# Special cases that outrank the hints.
INDUSTRY_OVERRIDES = {
    "게임용 ?PC": "가전/가구",
    "보드게임 ?카페": "서비스",
    "자동차 ?(매트|키링|필름)": "커머스/유통",
    "법무법인|변호사": "서비스",
}
# Quiz and promotion wording around the advertised item.
NAME_NOISE = r"\[정답입력\]|맞추기|검색 후|20[0-9]{2}[-./]?[0-9]{2}[-./]?[0-9]{2}"

# Texts that a CSV round trip through pandas turns into a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Category lists of the segment label, in label order.
FACTOR_LEVELS = {
    "INDUSTRY": INDUSTRIES,
    "OS_TYPE": ["WEB", "ANDROID", "IOS"],
    "START_QUARTER": ["1Q", "2Q", "3Q", "4Q"],
    "REJOIN_TYPE": ["NONE", "ADS_CODE_DAILY_UPDATE", "REJOINABLE"],
    "LIMIT_TYPE": ["UNLIMITED", "LIMITED"],
}
FACTORS = ["INDUSTRY", "OS_TYPE", "REJOIN_TYPE", "START_QUARTER", "LIMIT_TYPE"]
MEASURES = ["CVR", "1000_W_EFFICIENCY", "ATS"]
CONDITION_COLUMNS = ["SHAPE", "MDA", "START_TIME"]

# Prediction column per measure, goals with their weights and report labels.
PREDICTION_NAMES = {"CVR": "CVR", "1000_W_EFFICIENCY": "EFF", "ATS": "ATS"}
GOALS = {
    "highcvr": {"CVR": 0.5, "EFF": 0.25, "ATS": 0.25},
    "higheff": {"CVR": 0.25, "EFF": 0.5, "ATS": 0.25},
    "highats": {"CVR": 0.25, "EFF": 0.25, "ATS": 0.5},
}
GOAL_LABELS = {"highcvr": "이익", "higheff": "비용", "highats": "안정성"}


@dataclass(frozen=True)
class CleanRules:
    """Thresholds of the cleaning step."""

    first_start: dt.datetime = dt.datetime(2024, 7, 27)
    unlimited_from: int = 99_999_999
    unlimited_goal: int = 100_000
    dropped_goal: int = 9_999_999
    all_media: str = "ALL"
    os_codes: dict[str, list[int]] = field(default_factory=lambda: OS_CODES)
    exact_decimal: bool = False
