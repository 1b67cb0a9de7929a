"""Word lists and tokenizers for reviews."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keywords that place a review in a sub-category.
SUB_CATEGORY_KEYWORDS = {
    "物流": ["快递", "发货", "物流", "送货", "配送", "收到", "速度", "慢", "快", "等了", "到货", "签收"],
    "质量": ["质量", "坏了", "差劲", "结实", "耐用", "好用", "不好用", "太差", "很差", "还不错", "不行",
             "可以", "不错", "烂", "破", "次品", "假货", "正品", "真品", "劣质"],
    "价格": ["价格", "便宜", "贵", "划算", "性价比", "不值", "值得", "价钱", "降价", "优惠", "活动", "打折",
             "太贵", "实惠"],
    "服务": ["服务", "客服", "态度", "回复", "售后", "退换", "退货", "退款", "换货", "处理", "解决", "投诉",
             "差评"],
    "包装": ["包装", "包裹", "盒子", "袋子", "完好", "破损", "损坏", "压坏", "完好无损", "拆开"],
    "描述": ["描述", "相符", "不符", "图片", "实物", "色差", "尺寸", "大小", "颜色", "样子", "差别", "差距",
             "一致", "不一致"],
    "使用体验": ["使用", "体验", "效果", "功能", "操作", "方便", "简单", "好用", "实用", "舒适", "手感", "感觉",
                 "感受"],
}

# Words left out of word counts.
STOPWORDS = frozenset([
    "的", "了", "是", "我", "不", "在", "也", "就", "都", "有", "和", "很", "要", "会", "这", "那", "还",
    "没", "一", "个", "用", "好", "看", "上", "下", "去", "来", "说", "到", "着", "你", "他", "她", "它",
    "们", "吗", "啊", "吧", "呢", "哦", "买", "太", "让", "给", "被", "把", "对", "从", "能", "可以",
    "这个", "那个", "什么", "怎么", "为什么", "因为", "所以", "为了", "但是", "而且", "如果", "虽然", "不过", "还是",
    "觉得", "知道", "应该", "已经", "真的", "比较", "非常",
])

# A token of only these characters is punctuation.
PUNCTUATION = "，。！？、；：'（）【】 "

_CJK = r"㐀-䶿一-鿿"


_WORD = rf"[\p{{L}}\p{{M}}\p{{N}}_&&[^{_CJK}]]++"
# The look-ahead takes the token, the rest moves on: a whole word, or one CJK character.
TOKEN = rf"(?=([{_CJK}]{{2}}|{_WORD}))(?:[{_CJK}]|{_WORD})"


def word_tokens(text: Column) -> Column:
    """Array of tokens: words of letters, digits and underscore; CJK text as pairs of
    neighbouring characters.

    Needs no dictionary. A segmenter that has one can be plugged in as a vectorised UDF.
    """
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1))


def is_countable(word: Column, stopwords=STOPWORDS) -> Column:
    """Two characters or more, not a stop-word, not only digits, not only punctuation."""
    return (
        (F.length(word) >= 2)
        & ~word.isin(*sorted(stopwords))
        & ~word.rlike(rf"^(?:\p{{N}}++|[{PUNCTUATION}]++)$")
    )


def any_keyword(text: Column, keywords: list[str]) -> Column:
    """Case-insensitive: does the text hold any of the keywords; null never does."""
    return F.coalesce(text.rlike("(?iu)" + "|".join(keywords)), F.lit(False))
