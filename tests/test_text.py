"""Text repair, parsing and keyword rules on hand-made cells."""

import pytest
from pyspark.sql import functions as F

from jangbu import rules
from jangbu.functions import keywords, text


def values(spark, expression, cells, dtype="string"):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {dtype}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_year_and_month(spark):
    cells = ["2023-.3", "2024-11", "2024-xx", "20a4-05", "2024-1d", "2024", None]
    assert values(spark, text.year_of, cells) == [2023, 2024, 2024, None, 2024, 2024, None]
    assert values(spark, text.month_of, cells) == [3, 11, 0, 5, 0, 0, 0]


def test_numbers(spark):
    cells = ["12", " 3.5 ", ".3", "1e3", "-4", "12d", "12f", "nan", "NaN", "N/A", "", None]
    want = [12.0, 3.5, 0.3, 1000.0, -4.0, None, None, None, None, None, None, None]
    assert values(spark, text.number, cells) == want


def test_cell_tail_and_null_tokens(spark):
    assert values(spark, text.cut_at, ['abc";def', "abc", '";x', None]) == ["abc", "abc", "", None]
    assert values(spark, text.null_tokens, ["nan", "NaN", "", "x", None]) == [None, None, None, "x", None]


def test_base_name(spark):
    assert values(spark, text.base_name, [" 쌀(이천쌀) 20kg 1포", "무", "(x)", None]) == ["쌀", "무", "", None]


def test_prices(spark):
    assert values(spark, text.price_from_text, ["3,980원", "980", "원", None]) == [3980, 980, None, None]
    parts = values(spark, text.unit_price_parts, ["(100g당 2,633원)", "(1봉당 5,980원)", "none", None])
    assert [tuple(p) if p else None for p in parts] == [(100.0, "g", 2633), (1.0, "봉", 5980), None, None]


def test_product_id(spark):
    assert values(spark, text.product_id, ["/p/123?x=1", "/p/1?u=a/b", "7"]) == ["123", "b", "7"]


def test_markup_text(spark):
    assert values(spark, text.markup_text, [" <b>a&amp;b</b>\n<i>&lt;3</i> ", "&amp;lt;"]) == ["a&b\n<3", "&lt;"]


@pytest.mark.parametrize(
    "item, category",
    [
        ("굵은소금(천일염) 1kg", "젓갈/장/소스"),
        ("동태", "생선/해산물"),
        ("통조림(참치) 150g", "가공식품"),
        ("냉동참조기(20cm,국산)", "생선/해산물"),
        ("멸치액젓 1kg", "생선/해산물"),
        ("쌀(이천쌀) 20kg 1포", "농산물"),
        ("달걀(30개)", "축산물"),
        ("우유 1L", "유제품"),
        ("생수 500ml 1병", "음료"),
        ("치약 160g 1개", "기타"),
    ],
)
def test_category_rules(spark, item, category):
    assert values(spark, keywords.category_of, [item]) == [category]


def test_include_exclude(spark):
    cells = ["손질고등어300g", "쌈용맛배추(팩)", None, "", "(균)꾸이오징어다리50g", "사과"]
    assert values(spark, keywords.include_exclude, cells) == [True, False, False, False, False, False]
    shorter = lambda c: keywords.include_exclude(c, exclude=rules.TITLE_EXCLUDE_SHORT)
    assert values(spark, shorter, cells) == [True, False, False, False, True, False]


def test_long_word_lists_give_the_same_answer(spark):
    words = [f"w{i}." for i in range(80)]
    cells = ["a w7. b", "w7x", "w79.", None]
    assert values(spark, lambda c: keywords.contains_any(c, words), cells) == [True, False, True, False]


def test_group_labels(spark):
    cells = ["양배추", "오이맛고추", "양파 오이", "무", None]
    labels = values(spark, lambda c: keywords.group_labels(c, rules.ITEM_GROUPS), cells)
    assert [sorted(x) for x in labels] == [["cabbage"], ["cucumber"], ["cucumber", "onion"], [], []]
