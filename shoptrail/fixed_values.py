"""Data that results depend on literally, in natural order."""

# City dimension: city id, city name, area.
CITY_AREAS = (
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
)

# Area -> level; areas not listed get the last level.
AREA_LEVELS = {
    "华北": "A_Level",
    "华东": "A_Level",
    "华中": "B_Level",
    "华南": "B_Level",
    "西南": "C_Level",
    "西北": "C_Level",
}
OTHER_AREA_LEVEL = "D_Level"

# Product status labels ("Thrid" is the published spelling of the value).
OWN_PRODUCT = "Self"
OTHER_PRODUCT = "Thrid Party"

# "No category" / "no product" in an action row.
NOTHING = -1

# Visit length in seconds: bucket name, first and last second that counts.
VISIT_BUCKETS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 5, 6),
    ("7s_9s", 8, 9),
    ("10s_30s", 11, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)

# Actions per session: bucket name, first and last count.
STEP_BUCKETS = (
    ("1_3", 2, 3),
    ("4_6", 5, 6),
    ("7_9", 8, 9),
    ("10_30", 11, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)

# The same buckets without the gaps at 4, 7 and 10 (and at one step).
VISIT_BUCKETS_CLOSED = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)
STEP_BUCKETS_CLOSED = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)

# Names of the result tables.
RESULT_TABLES = {
    "session_ratio": "session_stat_ratio_0911",
    "session_sample": "session_extract_0911",
    "top_categories": "session_top10_0912",
    "top_category_sessions": "session_top10session_0912",
    "page_rates": "page_split_convert_rate_0912",
    "area_top3": "area_top3_product_0912",
    "ad_user_counts": "ad_user_click_count",
    "ad_blacklist": "ad_blacklist",
    "ad_city_totals": "ad_stat",
    "ad_province_top3": "ad_province_top3",
    "ad_trend": "ad_click_trend",
}

# Job defaults.
SAMPLE_ALLOWANCE = 100
TOP_CATEGORIES = 10
TOP_SESSIONS = 10
TOP_PRODUCTS = 3
TOP_ADS = 3
BAN_ABOVE_CLICKS = 100
TRIGGER_SECONDS = 5
