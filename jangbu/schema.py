"""Canonical column names, types and rename maps of the price survey."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Header of the survey files -> canonical name, in file order.
SURVEY_HEADERS = {
    "일련번호": "id",
    "시장/마트 번호": "market_id",
    "시장/마트 이름": "market_name",
    "품목 번호": "item_id",
    "품목 이름": "item_name",
    "실판매규격": "sales_unit",
    "가격(원)": "price",
    "년도-월": "year_month",
    "비고": "remark",
    "시장유형 구분(시장/마트) 코드": "market_type_code",
    "시장유형 구분(시장/마트) 이름": "market_type_name",
    "자치구 코드": "district_code",
    "자치구 이름": "district_name",
    "점검일자": "inspection_date",
}

# Tag of an API record -> canonical name, in API order.
API_TAGS = {
    "P_SEQ": "id",
    "M_SEQ": "market_id",
    "M_NAME": "market_name",
    "A_SEQ": "item_id",
    "A_NAME": "item_name",
    "A_UNIT": "sales_unit",
    "A_PRICE": "price",
    "P_YEAR_MONTH": "year_month",
    "ADD_COL": "remark",
    "P_DATE": "inspection_date",
    "M_TYPE_CODE": "market_type_code",
    "M_TYPE_NAME": "market_type_name",
    "M_GU_CODE": "district_code",
    "M_GU_NAME": "district_name",
}

# Header of the cleaned category tables -> canonical name.
CLEAN_HEADERS = {
    **SURVEY_HEADERS,
    "년도": "year",
    "월": "month",
    "카테고리": "category",
}


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


RAW = _strings(SURVEY_HEADERS.values())
API = _strings(API_TAGS.keys())

CLEAN = T.StructType(
    [
        T.StructField("market_name", T.StringType()),
        T.StructField("item_id", T.DoubleType()),
        T.StructField("item_name", T.StringType()),
        T.StructField("sales_unit", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("year_month", T.StringType()),
        T.StructField("remark", T.StringType()),
        T.StructField("market_type_name", T.StringType()),
        T.StructField("district_name", T.StringType()),
        T.StructField("year", T.LongType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("category", T.StringType()),
    ]
)

# Columns the cleaning step removes.
UNUSED = ["id", "market_id", "inspection_date", "market_type_code", "district_code"]


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Return `df`, or raise at plan time when a needed column is absent."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; present are {df.columns}")
    return df
