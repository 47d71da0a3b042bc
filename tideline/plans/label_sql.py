"""Comparison SQL of the label queries, with values of its own.

Nothing here is taken from ``functions.labels``: a wrong score, band or weight
there shows as a difference.  The scores are tenths by value in the order
18-24, 25-29, 30-34, 35-39, 40-49, 50+.
"""

# Fixed values.
SCORES = """score AS (
  SELECT dim, val, grp, CAST(pts * w / 10 AS DOUBLE) AS pts FROM (
    SELECT dim, w, unnest(string_split(vals, ' ')) AS val, p FROM (VALUES
      ('category', 0.3, '珠宝 礼品箱包 鞋靴 服饰内衣 个护化妆 数码', [9, 8, 6, 4, 2, 1]),
      ('category', 0.3, '母婴 钟表 厨具 电脑办公 家居家装 家用电器 图书、音像、电子书刊 手机 汽车用品', [2, 4, 6, 8, 9, 7]),
      ('category', 0.3, '运动健康 食品饮料、保健食品', [1, 2, 4, 6, 8, 9]),
      ('brand', 0.2, 'Redmi 苹果 联想 TCL 小米', [9, 7, 5, 3, 2, 1]),
      ('brand', 0.2, '长粒香 金沙河 索芙特 CAREMiLLE 欧莱雅 香奈儿', [1, 3, 5, 7, 8, 9]),
      ('price', 0.15, '高价商品', [1, 2, 3, 4, 5, 6]),
      ('price', 0.15, '中价商品', [2, 4, 6, 7, 8, 7]),
      ('price', 0.15, '低价商品', [8, 6, 4, 3, 2, 1]),
      ('time', 0.1, '凌晨', [2, 1, 1, 1, 1, 1]),
      ('time', 0.1, '早晨', [1, 1, 1, 1, 2, 3]),
      ('time', 0.1, '上午', [2, 2, 2, 2, 3, 4]),
      ('time', 0.1, '中午', [4, 4, 4, 4, 4, 3]),
      ('time', 0.1, '下午', [4, 5, 5, 5, 5, 4]),
      ('time', 0.1, '晚上', [8, 7, 6, 5, 4, 3]),
      ('time', 0.1, '夜间', [9, 7, 5, 3, 2, 1]),
      ('keyword', 0.15, '时尚与潮流', [9, 7, 5, 3, 2, 1]),
      ('keyword', 0.15, '性价比', [2, 4, 6, 7, 8, 8]),
      ('keyword', 0.15, '科技与数码', [8, 6, 4, 3, 2, 1]),
      ('keyword', 0.15, '学习与发展', [4, 5, 6, 7, 8, 7]),
      ('keyword', 0.15, '健康与养生', [1, 2, 4, 6, 8, 9]),
      ('keyword', 0.15, '家庭与育儿', [1, 2, 4, 6, 8, 7]),
      ('os', 0.1, 'Android', [8, 7, 6, 5, 4, 3]),
      ('os', 0.1, 'iOS', [7, 6, 5, 4, 3, 2])) t(dim, w, vals, p)),
  LATERAL (SELECT unnest(['18-24', '25-29', '30-34', '35-39', '40-49', '50+']) AS grp, unnest(p) AS pts))"""

ZODIAC = """CASE WHEN md <= 119 THEN '摩羯座' WHEN md <= 218 THEN '水瓶座' WHEN md <= 320 THEN '双鱼座' WHEN md <= 419 THEN '白羊座'
  WHEN md <= 520 THEN '金牛座' WHEN md <= {0} THEN '双子座' WHEN md <= 722 THEN '巨蟹座' WHEN md <= 822 THEN '狮子座'
  WHEN md <= 922 THEN '处女座' WHEN md <= {1} THEN '天秤座' WHEN md <= {2} THEN '天蝎座' WHEN md <= 1221 THEN '射手座'
  ELSE '摩羯座' END"""
SIGN, CLASSIC_SIGN = ZODIAC.format(621, 1023, 1122), ZODIAC.format(620, 1022, 1121)

AGE_GROUP = """CASE WHEN age <= 17 THEN '0-17' WHEN age <= 24 THEN '18-24' WHEN age <= 29 THEN '25-29' WHEN age <= 34 THEN '30-34'
  WHEN age <= 39 THEN '35-39' WHEN age <= 49 THEN '40-49' ELSE '50+' END"""

DAY_PART = """CASE WHEN {0} < 6 THEN '凌晨' WHEN {0} < 9 THEN '早晨' WHEN {0} < 12 THEN '上午' WHEN {0} < 14 THEN '中午'
  WHEN {0} < 18 THEN '下午' WHEN {0} < 22 THEN '晚上' WHEN {0} < 24 THEN '夜间' END"""
EARLY_PART = """CASE WHEN {0} < 5 THEN '凌晨' WHEN {0} < 8 THEN '早晨' WHEN {0} < 12 THEN '上午' WHEN {0} < 14 THEN '中午'
  WHEN {0} < 18 THEN '下午' WHEN {0} < 21 THEN '晚上' WHEN {0} < 24 THEN '夜间' END"""

TOTAL_GROUP = """CASE WHEN total_score >= 0.75 THEN '18-24' WHEN total_score >= 0.69 THEN '25-29'
  WHEN total_score >= 0.585 THEN '30-34' WHEN total_score >= 0.47 THEN '35-39' WHEN total_score >= 0.365 THEN '40-49'
  WHEN total_score >= 0.26 THEN '50+' ELSE '数据无效' END"""

_SUFFIXES = ("18_24", "25_29", "30_34", "35_39", "40_49", "50")


def _six(prefix: str, key: str, rows: dict[str, tuple], default: str) -> str:
    """Six columns of weighted scores, typed in thousandths."""
    return ", ".join(
        f"CASE {key} " + " ".join(f"WHEN '{v}' THEN {s[i] / 1000}" for v, s in rows.items()) + f" ELSE {default} END::DOUBLE "
        f"AS {prefix}_{suffix}"
        for i, suffix in enumerate(_SUFFIXES)
    )


DEVICE_SIX = _six("device", "os", {"Android": (80, 70, 60, 50, 40, 30), "iOS": (70, 60, 50, 40, 30, 20)}, "NULL")
SEARCH_SIX = _six("search", "search_category", {
    "时尚与潮流": (135, 105, 75, 45, 30, 15), "性价比": (30, 60, 90, 105, 120, 120), "科技与数码": (120, 90, 60, 45, 30, 15),
    "学习与发展": (60, 75, 90, 105, 120, 105), "健康与养生": (15, 30, 60, 90, 120, 105), "家庭与育儿": (15, 30, 60, 90, 120, 105),
}, "0")
