"""Question hierarchy, relationships and next-question recommendations.

Nodes are (question_id, cluster_id, complexity, category). Inside a cluster the levels are
easy < medium < hard; the parent of a node is the lowest id of the nearest lower level that exists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.operators.firstwins import top_per_group
from surveyloom.session import stored
from surveyloom.sources.ids import ordered_index, ranked_within


def build_hierarchy(nodes: DataFrame) -> DataFrame:
    """Nodes with ``parent_id`` (NULL for roots), ``depth``, ``is_root`` and ``is_leaf``.

    Three minima per cluster decide everything, so this is one small aggregate and one join.
    """
    level = F.col("complexity")
    heads = nodes.groupBy("cluster_id").agg(
        *[F.min(F.when(level == x, F.col("question_id"))).alias(x) for x in ("easy", "medium", "hard")]
    )
    joined = nodes.join(heads, "cluster_id")
    easy, medium, hard = F.col("easy"), F.col("medium"), F.col("hard")
    parent = F.when(level == "medium", easy).when(level == "hard", F.coalesce(medium, easy))
    medium_depth = F.when(easy.isNotNull(), 1).otherwise(0)
    depth = F.when(level == "medium", medium_depth).when(
        level == "hard", F.when(medium.isNotNull(), medium_depth + 1).when(easy.isNotNull(), 1).otherwise(0)
    ).otherwise(0)
    has_child = (
        F.when(level == "easy", (F.col("question_id") == easy) & (medium.isNotNull() | hard.isNotNull()))
        .when(level == "medium", (F.col("question_id") == medium) & hard.isNotNull())
        .otherwise(False)
    )
    return joined.select(
        *[F.col(c) for c in nodes.columns], parent.alias("parent_id"), depth.alias("depth"),
        parent.isNull().alias("is_root"), (~has_child).alias("is_leaf"),
    )


def hierarchy_summary(tree: DataFrame) -> DataFrame:
    return tree.agg(
        F.count("*").alias("total_nodes"), F.max("depth").alias("max_depth"),
        F.count_if("is_root").alias("root_nodes"), F.count_if("is_leaf").alias("leaf_nodes"),
    )


def relationships(tree: DataFrame, associations: DataFrame) -> DataFrame:
    """Edges (source_id, target_id, edge_type).

    ``parent``: parent to child. ``cluster``: each question to the next id of its cluster, so the
    number of edges stays linear. ``category``: each root to the first root of every associated
    category. ``associations`` has (category, associated).
    """
    parents = tree.filter(F.col("parent_id").isNotNull()).select(
        F.col("parent_id").alias("source_id"), F.col("question_id").alias("target_id"), F.lit("parent").alias("edge_type")
    )
    order = ordered_index(tree.select("cluster_id", "question_id"), ["cluster_id", "question_id"], "idx")
    following = order.select("cluster_id", (F.col("idx") - 1).alias("idx"), F.col("question_id").alias("target_id"))
    chain = order.join(following, ["cluster_id", "idx"]).select(
        F.col("question_id").alias("source_id"), "target_id", F.lit("cluster").alias("edge_type")
    )
    roots = tree.filter("is_root").select("question_id", "category")
    firsts = roots.groupBy(F.col("category").alias("associated")).agg(F.min("question_id").alias("target_id"))
    targets = associations.join(firsts, "associated").select("category", "target_id")
    across = (
        roots.join(targets, "category")
        .filter(F.col("question_id") != F.col("target_id"))
        .select(F.col("question_id").alias("source_id"), "target_id", F.lit("category").alias("edge_type"))
    )
    return parents.unionByName(chain).unionByName(across)


def graph_data(tree: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes with in and out degree, edges) for a relationship chart."""
    def end(column: str, out: int) -> Column:
        return F.struct(F.col(column).alias("question_id"), F.lit(out).alias("o"), F.lit(1 - out).alias("i"))

    ends = edges.select(F.inline(F.array(end("source_id", 1), end("target_id", 0))))
    degrees = ends.groupBy("question_id").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))
    nodes = tree.join(degrees, "question_id", "left").fillna(0, ["out_degree", "in_degree"])
    return nodes, edges


def ranked_groups(tree: DataFrame) -> DataFrame:
    """(kind, grp, rank, question_id): the members of every parent, cluster and category in id order.

    Built once per hierarchy; reuse it (written) for many recommendation runs.
    """
    def members(kind: str, column: str) -> DataFrame:
        return tree.filter(F.col(column).isNotNull()).select(
            F.lit(kind).alias("kind"), F.col(column).cast("string").alias("grp"), "question_id"
        )

    everything = members("parent", "parent_id").unionByName(members("cluster", "cluster_id")).unionByName(
        members("category", "category")
    )
    return ranked_within(everything, ["kind", "grp"], ["question_id"], "rank")


def next_questions(
    tree: DataFrame, groups: DataFrame, current: DataFrame, answers: DataFrame,
    associations: DataFrame, answer_rules: list[tuple[str, str]], k: int,
) -> DataFrame:
    """The next ``k`` questions per user.

    ``current`` (user_id, question_id): where each user is. ``answers`` (user_id, question_id, answer),
    one per user and question. ``answer_rules``: (keyword, category) pairs. Candidates: children of the current question (1), its cluster (2), categories whose rule keyword
    occurs in the current answer (3), categories associated with its own (4). Best strategy first,
    then id; answered questions and the current one are left out.

    A group may be huge, so a user does not meet all its members: of m excluded questions none can
    push a candidate further back than rank k + m, so only those first ranks are looked up, by an
    equi-join on (group, rank).
    """
    pairs = answers.select("user_id", "question_id", "answer").unionByName(
        current.select("user_id", "question_id", F.lit(None).cast("string").alias("answer"))
    )
    seen = stored(pairs.groupBy("user_id", "question_id").agg(F.max("answer").alias("answer")), "seen")
    reach = seen.groupBy("user_id").agg((F.count("*") + k).alias("reach"))
    # One row per user, read by three strategies.
    at = stored(
        current.join(tree.select("question_id", "cluster_id", "category"), "question_id")
        .join(seen, ["user_id", "question_id"])
        .join(reach, "user_id"),
        "current",
    )
    own = F.array(
        F.struct(F.lit(1).alias("strategy"), F.lit("parent").alias("kind"), F.col("question_id").cast("string").alias("grp")),
        F.struct(F.lit(2).alias("strategy"), F.lit("cluster").alias("kind"), F.col("cluster_id").cast("string").alias("grp")),
    )
    probes = at.select("user_id", "reach", F.inline(own))
    answer = F.coalesce("answer", F.lit(""))
    hits = F.array_compact(F.array(*[F.when(answer.contains(word), category) for word, category in answer_rules]))
    by_rule = at.select(
        "user_id", "reach", F.lit(3).alias("strategy"), F.lit("category").alias("kind"),
        F.explode(hits.cast("array<string>")).alias("grp"),
    )
    by_category = at.join(associations, "category").select(
        "user_id", "reach", F.lit(4).alias("strategy"), F.lit("category").alias("kind"), F.col("associated").alias("grp")
    )
    looked_up = (
        probes.unionByName(by_rule)
        .unionByName(by_category)
        .distinct()
        .select("user_id", "strategy", "kind", "grp", F.explode(F.sequence(F.lit(1).cast("bigint"), "reach")).alias("rank"))
        .join(groups, ["kind", "grp", "rank"])
    )
    candidates = looked_up.groupBy("user_id", "question_id").agg(F.min("strategy").alias("strategy"))
    open_ones = candidates.join(seen.select("user_id", "question_id"), ["user_id", "question_id"], "left_anti")
    return top_per_group(open_ones, ["user_id"], ["strategy", "question_id"], k, rank="rank")


def first_questions(tree: DataFrame, interests: DataFrame, users: DataFrame, k: int) -> DataFrame:
    """The first ``k`` questions per user: roots in the categories of interest, else all roots.

    ``interests`` has (user_id, category). Each category gives at most its first ``k`` roots, which
    is all one user can take from it.
    """
    roots = tree.filter("is_root").select("question_id", "category")
    heads = top_per_group(roots, ["category"], ["question_id"], k)
    own = stored(
        interests.select("user_id", "category").distinct().join(heads, "category").select("user_id", "question_id"),
        "own-roots",
    )
    general = roots.orderBy("question_id").limit(k).agg(F.collect_list("question_id")).scalar()
    without = users.select("user_id").distinct().join(own, "user_id", "left_anti")
    fallback = without.select("user_id", F.explode(general).alias("question_id"))
    return top_per_group(own.unionByName(fallback), ["user_id"], ["question_id"], k, rank="rank")
