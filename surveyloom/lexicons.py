"""Word lists, patterns and standard scales used by the rules.

Every function that needs one of these takes it as an argument and uses the list
here only as its default, so another domain can bring its own lists.
"""

from __future__ import annotations

# Topic filter for crawled questions.
QUESTION_MARKERS = ["?", "？", "how", "what", "which", "would", "do you", "您", "请", "是否", "如何"]

TRAVEL_KEYWORDS = [
    "旅游", "旅行", "出行", "酒店", "住宿", "景区", "景点", "导游", "满意",
    "服务", "交通", "游客", "定制", "行程", "预订", "体验", "评价", "房间",
    "hotel", "room", "travel", "trip", "tour", "vacation", "guest",
    "service", "stay", "accommodation", "satisfied", "experience",
    "destination", "restaurant", "food", "location", "flight",
]

# Crawler categories, tested in this order; the first hit wins.
CRAWL_CATEGORIES = [
    ("satisfaction", ["满意", "satisfied", "satisfaction"]),
    ("room", ["房间", "room", "住宿", "accommodation"]),
    ("service", ["服务", "service", "员工", "staff"]),
    ("food", ["餐", "food", "meal", "breakfast", "dining"]),
    ("location", ["位置", "location", "交通", "transportation"]),
    ("price", ["价格", "price", "费用", "cost"]),
    ("recommendation", ["推荐", "recommend"]),
    ("attraction", ["景点", "attraction", "景区"]),
    ("tour", ["导游", "guide", "行程", "itinerary"]),
]

# Keyword dictionary of the cleaning step, in order; the first keyword wins.
CLEANING_CATEGORIES = [
    ("住宿", "accommodation"), ("酒店", "accommodation"), ("民宿", "accommodation"),
    ("交通", "transportation"), ("航班", "transportation"), ("机票", "transportation"),
    ("火车", "transportation"), ("地铁", "transportation"), ("租车", "transportation"),
    ("美食", "food"), ("餐厅", "food"), ("小吃", "food"), ("早餐", "food"),
    ("景点", "attraction"), ("门票", "attraction"), ("博物馆", "attraction"),
    ("签证", "visa"), ("护照", "visa"), ("入境", "visa"), ("证件", "visa"),
    ("预算", "budget"), ("价格", "budget"), ("费用", "budget"), ("花费", "budget"),
]

DEFAULT_CATEGORY = "general"

# Options of the crawler.
CRAWL_OPTION_PREFIX = r"^[A-Z0-9①-⑩][.)、．]\s*"
CRAWL_OPTION_DROPPED = ["请选择", "Please Select", "其他"]
CRAWL_OPTION_LIMIT = 10
CRAWL_OPTION_MAX_CHARS = 99
OPTION_SEPARATOR = " / "

# Options of the cleaning step. The strict prefix needs its punctuation;
# the lenient one treats it as optional and so also eats a leading letter.
CLEANING_OPTION_PREFIX = r"^[A-Za-z0-9][.、)）]\s*"
CLEANING_OPTION_PREFIX_LENIENT = r"^[A-Za-z0-9][.、)）]?\s*"
DEFAULT_OPTIONS = {"en": ["Yes", "No"], "zh": ["是", "否"]}
YES_NO_OPTIONS = {"en": ["Yes", "No", "Have", "Don't have"], "zh": ["是", "否", "有", "没有"]}

# Type detection from the joined option text.
RATING_MARKS = ["1-5", "1-10", "0-10", "scale", "rating", "分"]
YES_NO_WORDS = ["yes", "no", "是", "否"]
MULTIPLE_MARKS = ["多选", "multiple"]

# Words that make a question hard.
COMPLEXITY_HARD_WORDS = {
    "en": ["Visa", "Policy", "Planning", "Budget", "Compare", "Why"],
    "zh": ["签证", "政策", "规划", "预算", "比较", "为什么"],
}
DIFFICULTY_HARD_WORDS = {
    "en": ["describe", "explain", "comprehensive", "evaluate", "perspective", "why"],
    "zh": ["描述", "解释", "详细", "评估", "看法", "为什么"],
}

# Topics for the coverage report.
TOPICS = {
    "en": [
        ("Hotel/Accommodation", ["hotel", "accommodation", "room", "stay", "inn"]),
        ("Travel/General", ["travel", "trip", "journey", "tour", "tourism"]),
        ("Flight/Transport", ["flight", "airline", "plane", "transport", "bus"]),
        ("Food/Dining", ["food", "meal", "dining", "restaurant", "eat"]),
        ("Service/Satisfaction", ["service", "staff", "satisfaction", "quality"]),
    ],
    "zh": [
        ("Hotel/Accommodation", ["酒店", "住宿", "房间", "宾馆", "饭店"]),
        ("Travel/General", ["旅游", "旅行", "行程", "度假"]),
        ("Flight/Transport", ["航班", "飞机", "交通", "机场"]),
        ("Food/Dining", ["餐饮", "食物", "吃饭", "餐厅"]),
        ("Service/Satisfaction", ["服务", "满意", "推荐", "态度"]),
    ],
}

# Fixed values: (word, synonym) pairs; the last pair for a word wins.
SYNONYMS = {
    "en": [
        ("hotel", "accommodation"), ("hotels", "accommodation"),
        ("inn", "accommodation"), ("resort", "accommodation"),
        ("surveys", "survey"), ("travels", "travel"), ("service", "hospitality"),
        ("services", "hospitalitys"), ("hotel", "property"),
        ("trip", "travel"), ("journey", "travel"),
    ],
    "zh": [("宾馆", "酒店"), ("饭店", "酒店"), ("住宿", "酒店"), ("游览", "旅游")],
}

# Chinese stop words of the retrieval step. The English list is Spark ML's own.
STOP_WORDS_ZH = ["的", "了", "是", "我", "你", "在", "和", "有", "去", "吗", "我们", "什么"]

# Standard answer scales for questions without options, tested in this order:
# (Chinese mark, English marks, Chinese options, English options, question type)
STANDARD_SCALES = [
    ("满意", ["satisfied"], "非常满意 / 满意 / 一般 / 不满意 / 非常不满意",
     "Very Satisfied / Satisfied / Neutral / Dissatisfied / Very Dissatisfied", "single_choice"),
    ("评分", ["rate", "rating"], "1-5分", "1-5 scale", "rating"),
    ("推荐", ["recommend"], "0-10分", "0-10 scale (NPS)", "rating"),
    ("质量", ["quality"], "优秀 / 良好 / 一般 / 较差 / 很差",
     "Excellent / Good / Average / Poor / Very Poor", "single_choice"),
]

# Replacements used when a bank is enlarged by variants, in order.
VARIANT_WORDS = [
    ("酒店", ["宾馆", "住宿", "旅馆"]),
    ("服务", ["接待", "款待"]),
    ("hotel", ["property", "accommodation"]),
    ("service", ["hospitality"]),
]

# Which page layout a url belongs to, tested in this order.
SITE_LAYOUTS = [
    ("wjx", ["wjx.cn"]),
    ("wenjuan", ["wenjuan.com", "surveyyes.com"]),
    ("jotform", ["jotform.com"]),
]
SITE_SOURCE_NAMES = {"wjx": "问卷星", "wenjuan": "问卷网", "jotform": "Jotform"}

# Links that lead to a survey form.
SURVEY_LINK_PATTERNS = [
    r"wjx\.cn/.*[vm]m?/",
    r"wenjuan\.com/.*detail",
    r"jinshuju\.net/f/",
    r"jotform\.com/form",
    r"surveymars\.com/.*survey",
    r"surveymonkey\.com/r/",
    r"forms\.app/.*forms/",
]
LINKS_PER_PAGE = 30

NOT_ANSWERED = "not_answered"


def default_stop_words(lang: str) -> list[str]:
    """Stop words for ``lang``: Spark ML's English list, or the fixed Chinese list."""
    if lang == "zh":
        return STOP_WORDS_ZH
    from pyspark.ml.feature import StopWordsRemover

    return list(StopWordsRemover.loadDefaultStopWords("english"))
