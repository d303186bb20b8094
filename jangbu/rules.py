"""Word lists and rules of the survey and listing jobs.

All of these are fixed values: the words and, where a rule list is ordered, their order decide results.
"""

# Ordered category rules: the first category with a contained keyword wins.
CATEGORY_RULES = [
    (
        "농산물",
        [
            "파프리카", "토마토", "콩나물", "콩", "쪽파", "열무", "양파", "양배추", "애호박",
            "쌀", "시금치", "수박", "대파", "당근", "감자", "갓", "고구마", "미나리", "무",
            "상추", "오이", "가지", "브로콜리", "버섯", "깻잎", "사과", "배", "참외", "복숭아", "딸기",
            "포도", "귤", "단감", "오렌지", "생강", "부추", "배추", "바나나", "두부", "도라지", "마늘",
            "풋고추", "고춧가루", "호박", "감", "파",
        ],
    ),
    ("축산물", ["돼지고기", "소고기", "닭고기", "계란", "삼겹살", "쇠고기", "달걀", "달걀(중란)", "달걀(특란)"]),
    (
        "생선/해산물",
        [
            "조기", "조개", "전복", "새우", "오징어", "갈치", "명태", "꽃게", "굴", "낙지",
            "마른멸치", "동태", "냉동참조기", "고등어", "멸치",
        ],
    ),
    (
        "젓갈/장/소스",
        [
            "식용유", "식초", "설탕", "소금", "케찹", "마요네즈", "참기름", "된장", "간장", "고추장",
            "새우젓", "멸치액젓",
        ],
    ),
    (
        "가공식품",
        [
            "라면", "즉석밥", "통조림", "컵라면", "만두", "부침가루", "밀가루", "국수",
            "햄", "맛김", "어묵", "소시지", "빵",
        ],
    ),
    ("음료", ["콜라", "사이다", "소주", "맥주", "생수"]),
    ("유제품", ["우유", "치즈"]),
]
OTHER_CATEGORY = "기타"

# Output name of each stored category.
CATEGORY_SLUGS = {
    "농산물": "agriculture",
    "축산물": "livestock",
    "생선/해산물": "seafood",
    "젓갈/장/소스": "sauce",
    "가공식품": "instant",
    "음료": "beverage",
    "유제품": "dairy",
}

# Item groups: label -> word contained in the item name.
ITEM_GROUPS = {
    "onion": "양파",
    "cucumber": "오이",
    "cabbage": "배추",
    "pork": "돼지고기",
    "chicken": "닭고기",
    "squid": "오징어",
    "pollack": "명태",
    "mackerel": "고등어",
}
ITEM_GROUP_CATEGORIES = ["농산물", "축산물", "생선/해산물"]

# Unit repairs: (exact item name, price divisor, unit written instead).
UNIT_FIXES = [("오이 1개", 2, "1개")]

# Items whose profiles are compared.
PROFILE_ITEMS = [
    "양파", "애호박", "무", "상추", "오이", "사과", "배", "배추",
    "돼지고기", "닭고기", "조기", "오징어", "명태", "고등어",
]

# Words a listing title must contain one of, and those it must not contain.
TITLE_INCLUDE = ["명태", "고등어", "오징어", "양파", "오이", "배추", "돼지고기", "닭고기"]
TITLE_EXCLUDE = ["맛", "가공", "조미", "채", "깡", "튀김", "꾸이"]
TITLE_EXCLUDE_SHORT = ["맛", "가공", "조미", "채", "깡", "튀김"]

# Markets near the school.
NEAR_MARKETS = ["백련시장", "망원시장", "마포농수산물시장", "대림시장", "증산종합시장"]

# Cell texts that stand for a missing value, and the marker of a broken cell tail.
NULL_TOKENS = ["nan", "NaN", ""]
CELL_TAIL_MARKER = '";'
JUNK_HEADER_TEXT = "일련번호,"

# Zero prices: items above this share (percent) are removed, others imputed.
ZERO_RATIO_LIMIT = 30.0
# Tukey fences, and the relative rank error of the approximate variant.
FENCE_FACTOR = 1.5
QUARTILE_ERROR = 0.05
# Least cosine similarity of a title to a target.
SIMILARITY_LIMIT = 0.005

# Page markup of product tiles (class names) and of list items.
TILE_CLASS = "emitem_info"
TILE_NAME_CLASS = "mnemitem_goods_tit"
TILE_PRICE_CLASS = "ssg_price"
ITEM_CLASS = "_3m7zfsGIZR"
ITEM_LINK_CLASS = "_3OaphyWXEP"
ITEM_TITLE_CLASS = "_1J1f1i2vk0"
ITEM_PRICE_CLASS = "hDcL3_EQRC"
ITEM_UNIT_PRICE_CLASS = "_1RLV-iAg2_"
