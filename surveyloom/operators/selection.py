"""Choosing questions: by id, category, difficulty, requirement or at random."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.operators.firstwins import first_wins, top_per_group
from surveyloom.session import stored

#: Runs of 1, 2, 4 .. bands; the largest has all of them.
LEVELS = 8
BANDS = 1 << LEVELS


def rows_by_ids(bank: DataFrame, wanted: DataFrame, id_col: str = "id", order: str = "seq") -> DataFrame:
    """First row per wanted id; ids that do not exist give no row."""
    return first_wins(bank.join(wanted.select(id_col).distinct(), id_col, "left_semi"), [id_col], order)


def by_id(bank: DataFrame, value: int, id_col: str = "id", order: str = "seq") -> DataFrame:
    return bank.filter(F.col(id_col) == value).orderBy(order).limit(1)


def by_value(bank: DataFrame, column: str, value: str) -> DataFrame:
    """Case-sensitive equality; NULL never matches."""
    return bank.filter(F.col(column) == value)


def by_categories(bank: DataFrame, categories: list[str]) -> DataFrame:
    return bank.filter(F.col("category").isin(*categories))


def by_difficulty(bank: DataFrame, low: float, high: float) -> DataFrame:
    """Difficulty within the range, both ends included."""
    return bank.filter(F.col("difficulty").between(low, high))


def split_by(df: DataFrame, test: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, the others); NULL counts as not passed."""
    passed = F.coalesce(test, F.lit(False))
    return df.filter(passed), df.filter(~passed)


def random_questions(bank: DataFrame, n: int, seed: int, id_col: str = "id") -> DataFrame:
    """``n`` questions picked by a hash of id and seed: the same on every run and partitioning."""
    return (
        bank.withColumn("_h", F.md5(F.concat_ws("-", F.col(id_col).cast("string"), F.lit(str(seed)))))
        .orderBy("_h", id_col)
        .limit(n)
        .drop("_h")
    )


def expand_questionnaires(questionnaires: DataFrame, bank: DataFrame) -> DataFrame:
    """One row per listed question, with its position in the list and its bank columns."""
    listed = questionnaires.select(
        F.col("id").alias("questionnaire_id"), F.posexplode("question_ids").alias("position", "question_id")
    )
    return listed.join(bank.withColumnRenamed("id", "question_id"), "question_id")


def _band(difficulty: Column, low: Column, high: Column) -> Column:
    """Band of a difficulty between the least and the largest of the bank, which are cut into ``BANDS``."""
    share = F.coalesce(F.try_divide(difficulty - low, high - low), F.lit(0.0))
    return F.least(F.greatest(F.floor(share * BANDS), F.lit(0)), F.lit(BANDS - 1)).cast("int")


def covering_bands(wanted: DataFrame) -> DataFrame:
    """``wanted`` with (level, node) of the fewest whole bands, or runs of 2^level bands, between bands ``first`` and ``last``.

    At most two runs of each length are needed. The two bands at the ends are not among them, since a range may cover
    them in part.
    """
    left, right = F.expr("shiftright(first + shiftleft(1, level), level)"), F.expr("shiftright(last, level)")
    ends = wanted.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))).withColumns({"left": left, "right": right})
    taken = F.array_compact(F.array(
        F.when((F.col("left") % 2 == 1) & (F.col("left") < F.col("right")), F.col("left")),
        F.when((F.col("right") % 2 == 1) & (F.col("left") + F.col("left") % 2 < F.col("right")), F.col("right") - 1),
    ))
    return ends.withColumn("node", F.explode(taken)).drop("left", "right")


def matching_questions(bank: DataFrame, requirements: DataFrame, most: int) -> DataFrame:
    """(questionnaire_id, question_count, id, category, difficulty): questions in a category and the difficulty range of
    a questionnaire, among them its first ``question_count``, which is at most ``most``.

    A band join: the difficulties are cut into bands and runs of bands, each with its first questions by rank. A range
    is a few whole runs, which need no test, and a band at each end, whose questions are tested. The run that has
    enough questions first says up to which id any other needs to be read, so a questionnaire joins little more than
    it takes, however finely difficulties vary and however large a category is.
    """
    limits = bank.agg(F.min("difficulty").alias("low"), F.max("difficulty").alias("high"))
    low, high = limits.select("low").scalar(), limits.select("high").scalar()
    rows = bank.select("id", "category", "difficulty").where("difficulty is not null").withColumn("band", _band(F.col("difficulty"), low, high))
    # The first questions of a run are among the first of its bands, so only those are written to all levels.
    bands = top_per_group(rows, ["category", "band"], ["id"], most)
    runs = bands.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))).withColumn("node", F.expr("shiftright(band, level)"))
    heads = stored(top_per_group(runs, ["category", "level", "node"], ["id"], most, rank="place").drop("band"), "runs")
    # No questionnaire can use more than its count of one difficulty.
    cells = top_per_group(rows, ["category", "difficulty"], ["id"], most)

    wanted = requirements.select(
        F.col("id").alias("questionnaire_id"), "question_count", F.explode(F.array_distinct("categories")).alias("category"),
        F.element_at("difficulty_range", 1).alias("from"), F.element_at("difficulty_range", 2).alias("upto"),
    ).where((F.col("from") <= F.col("upto")) & (F.col("from") <= high) & (F.col("upto") >= low))
    wanted = stored(wanted.withColumns({"first": _band(F.col("from"), low, high), "last": _band(F.col("upto"), low, high)}), "requirements")
    whole = covering_bands(wanted).drop("from", "upto", "first", "last")
    enough = heads.select("category", "level", "node", F.col("place").alias("question_count"), F.col("id").alias("enough"))
    bound = whole.join(enough, ["category", "level", "node", "question_count"]).groupBy("questionnaire_id").agg(F.min("enough").alias("enough"))
    fits = (F.col("id") <= F.coalesce("enough", F.col("id")))
    out = ["questionnaire_id", "question_count", "id", "category", "difficulty"]
    inner = whole.join(bound, "questionnaire_id", "left").join(heads, ["category", "level", "node"]).where(fits & (F.col("place") <= F.col("question_count")))
    ends = wanted.withColumn("band", F.explode(F.array_distinct(F.array("first", "last")))).join(bound, "questionnaire_id", "left")
    tested = ends.join(cells, ["category", "band"]).where(fits & F.col("difficulty").between(F.col("from"), F.col("upto")))
    return inner.select(*out).unionByName(tested.select(*out))


def questions_for_requirements(bank: DataFrame, requirements: DataFrame) -> DataFrame:
    """For every questionnaire the first ``question_count`` questions, by id, in one of its categories
    and in its difficulty range."""
    most = requirements.agg(F.max("question_count")).first()[0] or 0
    ranked = top_per_group(matching_questions(bank, requirements, most), ["questionnaire_id"], ["id"], most, rank="rank")
    return ranked.filter(F.col("rank") <= F.col("question_count")).select(
        "questionnaire_id", "rank", F.col("id").alias("question_id"), "category", "difficulty"
    )


def preview(df: DataFrame, text: str, n: int = 3, chars: int = 80, order: str = "seq") -> DataFrame:
    """The first rows, texts cut for display."""
    return df.orderBy(order).limit(n).select(order, F.substring(text, 1, chars).alias("sample"))
