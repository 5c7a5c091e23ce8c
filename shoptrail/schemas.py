"""Schemas of the input tables and of the keyed advertising tables."""

from pyspark.sql import types as T


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_text, _long, _int = T.StringType(), T.LongType(), T.IntegerType()

USER_VISIT_ACTION = _struct(
    date=_text,
    user_id=_long,
    session_id=_text,
    page_id=_long,
    action_time=_text,
    search_keyword=_text,
    click_category_id=_long,
    click_product_id=_long,
    order_category_ids=_text,
    order_product_ids=_text,
    pay_category_ids=_text,
    pay_product_ids=_text,
    city_id=_long,
)
USER_INFO = _struct(
    user_id=_long, username=_text, name=_text, age=_int, professional=_text, city=_text, sex=_text
)
PRODUCT_INFO = _struct(product_id=_long, product_name=_text, extend_info=_text)
CITY_AREA = _struct(city_id=_long, city_name=_text, area=_text)

AD_USER_COUNTS = _struct(date=_text, userid=_long, adid=_long, clickCount=_long)
AD_BLACKLIST = _struct(userid=_long)
AD_CITY_TOTALS = _struct(date=_text, province=_text, city=_text, adid=_long, clickCount=_long)
AD_PROVINCE_TOP3 = _struct(date=_text, province=_text, adid=_long, clickCount=_long)
AD_TREND = _struct(date=_text, hour=_text, minute=_text, adid=_long, clickCount=_long)
