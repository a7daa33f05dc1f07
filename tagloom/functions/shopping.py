"""Codes and labels of bought goods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Colour codes; any other colour is 0.
COLOUR_CODES = {
    "银色": 1, "香槟金色": 2, "黑色": 3, "白色": 4, "梦境极光【卡其金】": 5, "梦境极光【布朗灰】": 6, "粉色": 7,
    "金属灰": 8, "金色": 9, "乐享金": 10, "布鲁钢": 11, "月光银": 12, "时尚光谱【浅金棕】": 13, "香槟色": 14,
    "香槟金": 15, "灰色": 16, "樱花粉": 17, "蓝色": 18, "金属银": 19, "玫瑰金": 20,
}

# Product type codes; any other type is 0, and 11 is not in use.
TYPE_CODES = {
    "4K电视": 9, "Haier/海尔冰箱": 10, "LED电视": 12, "Leader/统帅冰箱": 13, "冰吧": 14, "冷柜": 15, "净水机": 16,
    "前置过滤器": 17, "取暖电器": 18, "吸尘器/除螨仪": 19, "嵌入式厨电": 20, "微波炉": 21, "挂烫机": 22, "料理机": 23,
    "智能电视": 24, "波轮洗衣机": 25, "滤芯": 26, "烟灶套系": 27, "烤箱": 28, "燃气灶": 29, "燃气热水器": 30,
    "电水壶/热水瓶": 31, "电热水器": 32, "电磁炉": 33, "电风扇": 34, "电饭煲": 35, "破壁机": 36, "空气净化器": 37,
}

# Colours and product types that mark a purchase as female, and the two labels.
FEMALE_COLOURS = ["樱花粉", "白色", "香槟色", "香槟金"]
FEMALE_TYPES = ["料理机", "挂烫机", "吸尘器/除螨仪"]
FEMALE = "女"
MALE = "男"

# Share of votes that decides, and the rules of the three outcomes.
VOTE_SHARE = 0.6
MALE_RULE, FEMALE_RULE, NEUTRAL_RULE = "0", "1", "-1"


def dictionary_code(value: Column, codes: Mapping[str, int]) -> Column:
    """Code of a value in a small fixed dictionary, 0 when it is not listed."""
    pairs = [F.lit(part) for pair in codes.items() for part in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), value), F.lit(0))


def purchase_label(colour: Column, product_type: Column, colours: Sequence[str] = FEMALE_COLOURS,
                   types: Sequence[str] = FEMALE_TYPES) -> Column:
    """Female when the colour or the type is listed, else male."""
    listed = F.coalesce(colour.isin(*colours), F.lit(False)) | F.coalesce(product_type.isin(*types), F.lit(False))
    return F.when(listed, FEMALE).otherwise(MALE)


def vote_rule(male: Column, female: Column, total: Column) -> Column:
    """Rule of the gender with strictly more than the deciding share of votes, else neutral."""
    return (F.when(male / total > VOTE_SHARE, MALE_RULE)
            .when(female / total > VOTE_SHARE, FEMALE_RULE).otherwise(NEUTRAL_RULE))
