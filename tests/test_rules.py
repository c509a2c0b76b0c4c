"""Every branch of the column rules, with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from surveyloom import lexicons as lex
from surveyloom.functions import options as opt
from surveyloom.functions import predicates as pred
from surveyloom.functions import rules, scoring
from surveyloom.functions import text as txt


def evaluate(spark, schema, cases, make):
    """Values of ``make(columns...)`` for each case, in order."""
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], f"_i int, {schema}").repartition(3)
    out = df.select("_i", make(*[F.col(n) for n in names]).alias("v")).collect()
    return [r["v"] for r in sorted(out, key=lambda r: r["_i"])]


def check(spark, schema, cases, make):
    inputs = [c[:-1] for c in cases]
    assert evaluate(spark, schema, inputs, make) == [c[-1] for c in cases]


def test_clean_text(spark):
    check(spark, "t string", [
        ("<b>Good</b>, isn’t it?", "Good isn t it?"), ("café   (bon)!", "café bon !"),
        (None, ""), ("", ""), ("<p></p>", ""), ("酒店、好吗？", "酒店 好吗"), ("a_b\t\nc", "a_b c"),
    ], txt.clean_text)


def test_clean_question_text(spark):
    check(spark, "t string", [
        ("Ask Q1. How are you?", "How are you?"), ("...- What now", "What now"), ("2 beds?", "beds?"),
        ("3D maps?", "D maps?"), ("12", "12"), (None, ""), ("ask  why", "why"), ("1: 您好？", "您好？"), ("  x ", "x"),
    ], txt.clean_question_text)


def test_strip_and_numbering(spark):
    check(spark, "t string", [("　 a \n", "a"), ("", "")], txt.strip)
    check(spark, "t string", [("12. a", "a"), ("3)b", "b"), ("4、c", "c"), ("5 d", "5 d")], txt.strip_numbering)


def test_crawled_options(spark):
    check(spark, "o array<string>", [
        (["A. Daily", "B) Weekly", "Please Select", " "], "Daily / Weekly"), (["One"], None), (None, None),
        ([str(i) + "x" for i in range(12)], " / ".join(str(i) + "x" for i in range(10))),
        (["x" * 100, "short", "tiny"], "short / tiny"), (["请选择", "其他", "好", "坏"], "好 / 坏"), (["①、a", "②．b"], "a / b"),
    ], opt.join_crawled_options)


def test_standard_options(spark):
    cases = [(["A. Daily", "Friend"], ["Daily", "Friend"]), (["Yes", "No"], ["Yes", "No"]), ([], ["Yes", "No"]),
             (None, ["Yes", "No"]), ([" "], ["Yes", "No"]), ([None, "1) a   b"], ["a b"])]
    check(spark, "o array<string>", cases, opt.standardize_options)
    lenient = [(["A. Daily", "Friend"], ["Daily", "riend"]), (["Yes", "No"], ["es", "o"])]
    check(spark, "o array<string>", lenient, lambda o: opt.standardize_options(o, prefix=lex.CLEANING_OPTION_PREFIX_LENIENT))
    check(spark, "o array<string>", [([], []), (None, [])], lambda o: opt.standardize_options(o, default=None))
    check(spark, "o array<string>", [([], ["是", "否"])], lambda o: opt.standardize_options(o, lex.DEFAULT_OPTIONS["zh"]))


def test_split_count_ids(spark):
    check(spark, "r string", [("A / B;C,, D", ["A", "B", "C", "D"]), ("", [])], opt.split_options)
    check(spark, "r string", [("a/b/c", 3), ("a", 1), ("", None), (None, None)], opt.option_count)
    check(spark, "s bigint", [(7, "Q0007"), (12345, "Q12345")], rules.padded_id)


def test_type_from_option_text(spark):
    check(spark, "o string, t string", [
        ("", "x", "open_ended"), (None, "x", "open_ended"), ("1-5 scale", "x", "rating"), ("十分好 / 一般", "x", "rating"),
        ("Yes / No", "x", "yes_no"), ("是 / 否", "x", "yes_no"), ("Know / Nothing", "x", "single_choice"),
        ("A / B", "multiple answers", "multiple_choice"), ("A / B", "多选", "multiple_choice"),
        ("Yes / No", "multiple answers", "yes_no"), ("A / B", "x", "single_choice"),
    ], rules.type_from_option_text)


def test_type_from_option_count(spark):
    check(spark, "o array<string>", [
        ([], "open_ended"), (None, "open_ended"), (["Yes", "Maybe"], "yes_no"), (["a", "b"], "single_choice"),
        (["a"], "single_choice"), (["a", "b", "c", "Yes"], "single_choice"), (list("abcde"), "multiple_choice"),
    ], rules.type_from_option_count)


def test_categories(spark):
    cases = [("Is the room service fine?", "room"), ("Very SATISFIED", "satisfaction"), ("餐厅", "food"), ("zzz", "general")]
    check(spark, "t string", cases, rules.category_by_groups)
    for name, words in lex.CRAWL_CATEGORIES:
        assert evaluate(spark, "t string", [(words[0],)], rules.category_by_groups) == [name]
    # The dictionary decides, not the text: 住宿 stands before 价格.
    check(spark, "t string", [("价格和住宿", "accommodation"), ("价格", "budget"), ("", "general"), (None, "general")], rules.category_by_keyword)


def test_complexity(spark):
    def text(n, word=""):
        return word + "x" * (n - len(word))

    def options(n):
        return [str(i) for i in range(n)]

    check(spark, "t string, o array<string>, k string", [
        (text(61, "Visa"), options(7), "multiple_choice", "hard"), (text(45), options(5), "multiple_choice", "medium"),
        (text(25), options(2), "yes_no", "easy"), (text(25, "visa"), options(2), "yes_no", "easy"),
        (text(25, "Visa"), options(2), "yes_no", "medium"), (text(60), options(2), "yes_no", "easy"),
        (text(40), options(2), "yes_no", "easy"), (text(20), options(2), "yes_no", "easy"),
        (text(41), [], "open_ended", "medium"), (text(61), [], "yes_no", "medium"), (text(61), options(7), "multiple_choice", "hard"),
    ], scoring.complexity)


def test_difficulty(spark):
    def en(n, last="w"):
        return " ".join(["w"] * (n - 1) + [last])

    check(spark, "t string, k string, o string, l string", [
        ("Is the room clean", "yes_no", "Yes / No", "en", 1), ("Describe your trip", "open_ended", "", "en", 4),
        (en(16), "single_choice", "/".join("abcdefgh"), "en", 4), (en(31, "why"), "open_ended", "", "en", 5),
        ("字" * 21, "rating", "", "zh", 2), (en(15), "rating", "", "en", 1), (en(16), "rating", "", "en", 2),
        ("字" * 51, "rating", None, "zh", 3), ("为什么", "rating", "", "zh", 2), ("why", "rating", "", "zh", 1),
        ("x", "MULTIPLE_CHOICE", "", "en", 2), (None, None, None, "en", 1), ("x", "rating", "/".join("abcdef"), "en", 1),
    ], scoring.difficulty_score)


def test_language_stars_percent(spark):
    check(spark, "t string", [("Hotel 酒店", "zh"), ("Hotel", "en")], txt.detect_lang)
    check(spark, "s int", [(3, "★★★☆☆"), (5, "★★★★★"), (1, "★☆☆☆☆")], scoring.stars)
    check(spark, "s double", [(0.29, 28), (1.0, 100), (0.059, 5)], scoring.match_percent)


@pytest.mark.parametrize("text,options,kind,expected", [
    ("Were you satisfied?", "", "open_ended", ("Very Satisfied / Satisfied / Neutral / Dissatisfied / Very Dissatisfied", "single_choice", True)),
    ("您满意吗", None, "open_ended", ("非常满意 / 满意 / 一般 / 不满意 / 非常不满意", "single_choice", True)),
    ("A moderate price", "", "open_ended", ("1-5 scale", "rating", True)),
    ("请评分", "", "open_ended", ("1-5分", "rating", True)),
    ("Would you recommend us", "", "open_ended", ("0-10 scale (NPS)", "rating", True)),
    ("quality?", "", "open_ended", ("Excellent / Good / Average / Poor / Very Poor", "single_choice", True)),
    ("satisfied?", "a / b", "yes_no", ("a / b", "yes_no", False)),
    ("nothing", "", "open_ended", ("", "open_ended", False)),
])
def test_standard_scale(spark, text, options, kind, expected):
    df = spark.createDataFrame([(text, options, kind)], "t string, o string, k string")
    assert tuple(df.select(*opt.standard_scale(F.col("t"), F.col("o"), F.col("k"))).first()) == expected


def test_inline_options(spark):
    df = spark.createDataFrame([("Pick one (bus/train/plane ride)",), ("Pick (a/b)",), ("选（公交车、火车、飞机、步行走路）吧",), ("No (slash in this one)",)], "t string")
    got = [tuple(r) for r in df.select(*opt.inline_options(F.col("t"))).collect()]
    assert got == [("Pick one", ["bus", "train", "plane ride"]), ("Pick (a/b)", None),
                   ("选吧", ["公交车", "火车", "飞机", "步行走路"]), ("No (slash in this one)", None)]


def test_decode_options(spark):
    df = spark.createDataFrame([('["a","b"]',), ('{"min":1,"max":5,"labels":["x"]}',), ("a / b",), (None,), ("",)], "r string")
    got = [(r[0], r[1] and r[1].asDict()) for r in df.select(*opt.decode_options(F.col("r"))).collect()]
    assert got == [(["a", "b"], None), (None, {"min": 1, "max": 5, "labels": ["x"]}), (["a", "b"], None), (None, None), (None, None)]


def test_predicates(spark):
    check(spark, "t string", [
        ("how hot", False), ("how room", True), ("how is it going", False), ("the hotel room", False),
        ("how room" + "x" * 493, False), ("how room" + "x" * 492, True), (None, False), ("请问您酒店怎么样呢", True),
    ], pred.is_on_topic)
    check(spark, "t string", [("a?", True), ("a？ ", True), ("a? b", False)], pred.ends_with_question_mark)
    check(spark, "e boolean", [(True, True), (None, True), (False, False)], pred.is_effective)
    check(spark, "a string", [("x", True), (None, True), ("", True), ("not_answered", False), ("N/A", True)], pred.is_answered)
    check(spark, "c string", [("General", False), ("room", True)], pred.not_default_category)
    check(spark, "t string", [("", False), (None, False), ("x", True)], pred.not_empty)


def test_dedup_key(spark):
    def key(text, lang):
        return txt.dedup_key(text, lang, ["the"], {"hotels": "hotel"}, [("hotel", "inn"), ("hotel", "stay")])

    check(spark, "t string, l string", [
        ("The hotels?", "en", "stay"), ("hotel", "en", "stay"), ("Große X!", "fr", "große x!"), (None, "en", ""),
        ("宾馆好，吗 ok", "zh", "酒店 店好 好吗 ok"), ("住宿好吗 ok", "zh", "酒店 店好 好吗 ok"), ("好", "zh", "好"),
    ], key)


def test_terms(spark):
    check(spark, "t string", [("The Hotel a é_1 the ok", ["hotel", "é_1", "ok"]), ("我们 的 酒店", ["酒店"])],
          lambda t: txt.terms(t, ["the", "我们"]))
