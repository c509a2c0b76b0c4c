"""Parsing of transcripts: roles of lines by a hidden Markov model, and canonical rendering of turns.

A transcript is its lines, whether they come as one text or in many rows. A state is a role, and whether the line
begins a turn. A line shows its speaker marker (``User:``, ``Assistant:`` and the like), and three features: whether it
begins a block (a row, or what a marker opens), how long it is and whether it ends with a question mark. Marker
probabilities are given; all others are counted over the training transcripts. Turns are cut where Viterbi's path
begins one, and all lines up to the next belong to it.

Viterbi runs on chunks of a transcript's lines: a chunk is a max-plus matrix between the states at its ends. Products
of ``FAN`` matrices are those of larger pieces, up to the whole; from there down each piece learns the best states at
the ends of its parts, and at last each chunk is decoded by itself. So a transcript of any length is split, no task
holds more than a chunk or ``FAN`` matrices of it, and the result is that of Viterbi over the whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.llm.ngram_join import whole_groups
from surveyloom.session import stored
from surveyloom.sources.ids import ranked_within

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)
#: Markers of each role, compared without case. A marker stands at the start of a line, before a colon or in brackets.
MARKERS = {
    "system": ("system", "instruction", "instructions", "context"),
    "user": ("user", "human", "customer", "q", "question", "prompt", "me", "client"),
    "assistant": ("assistant", "ai", "bot", "agent", "a", "answer", "response", "chatbot", "model"),
}
#: Probability that a marked line has the marker's role, and that another role has it.
MARKED, ASTRAY = 0.996, 1e-7
#: Share of transitions, dealt over all states, that training may not have seen; small enough for a marker to decide.
UNSEEN = 1e-4
#: Lines of a chunk, pieces of a run, and chunks that are gone through together for the begin of a turn.
CHUNK_LINES, FAN, GROUP_CHUNKS = 64, 64, 4_096
LENGTHS = (20, 80, 200)


def marker(line: Column) -> tuple[Column, Column]:
    """Number of the role that a line is marked with (-1: none), and the line without the marker."""
    names = "|".join(sorted((m for of in MARKERS.values() for m in of), key=len, reverse=True))
    pattern = rf"^\s*(?:\*\*|#+ ?)?[\[<]?({names})(?:[\]>]:?|(?:\*\*)?\s*:(?:\*\*)?)\s*"
    name = F.lower(F.regexp_extract(line, "(?i)" + pattern, 1))
    role = F.lit(-1)
    for i, r in enumerate(ROLES):
        role = F.when(name.isin(*MARKERS[r]), i).otherwise(role)
    return role, F.when(role >= 0, F.regexp_replace(line, "(?i)" + pattern, "")).otherwise(line)


def lines(turns: DataFrame) -> DataFrame:
    """Lines of the rows (conv_id, turn, text, and others that are kept): at, mark (role number, -1: none), plain, kind.

    ``kind`` has the features as one number: first of its block (8), length class (2 to 6), question (1).
    """
    number = F.coalesce(F.col("turn").cast("long"), F.lit(-1))
    split = turns.withColumn("turn", number).select("*", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("at", "line")).drop("text")
    mark, rest = marker(F.col("line"))
    split = split.withColumns({"mark": mark, "plain": rest}).drop("line")
    kind = (
        F.when((F.col("at") == 0) | (F.col("mark") >= 0), 8).otherwise(0)
        + sum((F.length("plain") > n).cast("int") for n in LENGTHS) * 2
        + F.col("plain").rlike(r"\?\s*$").cast("int")
    )
    return split.withColumn("kind", kind)


class Model:
    """Log probabilities: ``start`` and ``step`` between states, ``show`` of line kinds by state."""

    def __init__(self, emissions: list, follows: list, starts: list, inner: list):
        self.show = np.ones((STATES, 16))
        for row in emissions:
            self.show[2 * row.role + (row.at == 0), row.kind] += row.n
        self.show = np.log(self.show / self.show.sum(1, keepdims=True))
        step = np.full((STATES, STATES), 0.01)
        ends = {row.role: (row.turns, row.single) for row in inner}
        lines = {row.role: row.lines for row in inner}
        # A turn goes from its first line to inner lines, and from its last line to the first of another turn.
        for row in follows:
            turns, single = ends.get(row.a, (1, 0))
            step[2 * row.a + 1, 2 * row.b + 1] += row.n * single / turns
            step[2 * row.a, 2 * row.b + 1] += row.n * (turns - single) / turns
        for role, (turns, single) in ends.items():
            step[2 * role + 1, 2 * role] += turns - single
            step[2 * role, 2 * role] += lines[role] - turns - (turns - single)
        self.step = np.log((1 - UNSEEN) * step / step.sum(1, keepdims=True) + UNSEEN / STATES)
        start = np.full(STATES, 0.01)
        for row in starts:
            start[2 * row.role + 1] += row.n
        self.start = np.log((1 - UNSEEN) * start / start.sum() + UNSEEN / STATES)
        self.marked = np.zeros((len(ROLES) + 1, STATES))
        for m in range(len(ROLES)):
            self.marked[m] = np.log(np.where(np.arange(STATES) // 2 == m, MARKED, ASTRAY))
            self.marked[m, ::2] = np.log(1e-6)  # a marker begins a turn

    def emissions(self, marks: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        return self.show[:, kinds].T + self.marked[marks]

    def transfer(self, shown: np.ndarray) -> np.ndarray:
        """Best log probability from each state before the lines to each state at the last one."""
        out = self.step + shown[0]
        for e in shown[1:]:
            out = (out[:, :, None] + self.step[None]).max(1) + e
        return out

    def decode(self, shown: np.ndarray, before: int, last: int) -> np.ndarray:
        """Best states between a given state before the lines (-1: the transcript begins) and the given last one."""
        score = (self.start if before < 0 else self.step[before]) + shown[0]
        back = []
        for e in shown[1:]:
            ways = score[:, None] + self.step
            back.append(ways.argmax(0))
            score = ways.max(0) + e
        path = [int(score.argmax()) if last < 0 else last]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return np.array(path[::-1])


def fit(turns: DataFrame, role: str = "role") -> Model:
    """Counts over all of ``turns`` whose role is known; a row is a turn. Consecutive turns are met by their numbers."""
    number = (F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col(role)) - 1).cast("int")
    known = turns.select("conv_id", "turn", "text", number.alias("role")).where(F.col("role") >= 0)
    shown = lines(known).groupBy("role", F.least("at", F.lit(1)).alias("at"), "kind").agg(F.count("*").alias("n"))
    numbered = known.groupBy("conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn")).agg(F.min("role").alias("a"))
    after = numbered.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("a").alias("b"))
    follows = numbered.join(after, ["conv_id", "turn"]).groupBy("a", "b").agg(F.count("*").alias("n"))
    first = numbered.groupBy("conv_id").agg(F.min(F.struct("turn", "a")).alias("f"))
    starts = first.groupBy(F.col("f.a").alias("role")).agg(F.count("*").alias("n"))
    size = F.size(F.split(F.coalesce("text", F.lit("")), "\n"))
    inner = known.groupBy("role").agg(F.count("*").alias("turns"), F.sum((size == 1).cast("long")).alias("single"), F.sum(size).alias("lines"))
    return Model(shown.collect(), follows.collect(), starts.collect(), inner.collect())


def _parts(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    for table, starts in whole_groups(batches, keys):
        for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True):
            yield table.slice(a, b - a)


PIECE = "conv string, piece long, matrix array<double>, opening array<double>"


def _pieces(conv: list, piece: list, matrix: list, opening: list) -> pa.RecordBatch:
    numbers = pa.list_(pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array(conv, pa.string()), pa.array(piece, pa.int64()), pa.array([m.ravel().tolist() for m in matrix], numbers), pa.array([o.tolist() for o in opening], numbers)],
        ["conv", "piece", "matrix", "opening"],
    )


def _transfer(shared):
    """The matrix of each chunk of lines, and the scores of its last states if it is the first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, found = shared.value, []
        for rows in _parts(batches, ["conv", "chunk"]):
            shown = model.emissions(rows["mark"].to_numpy(), rows["kind"].to_numpy())
            opening = model.start + shown[0]
            for e in shown[1:]:
                opening = (opening[:, None] + model.step).max(0) + e
            found.append((rows["conv"][0].as_py(), rows["chunk"][0].as_py(), model.transfer(shown), opening))
            if len(found) == 1000:
                yield _pieces(*map(list, zip(*found, strict=True)))
                found = []
        if found:
            yield _pieces(*map(list, zip(*found, strict=True)))

    return run


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same of each run of pieces."""
    for rows in _parts(batches, ["conv", "parent"]):
        matrices = np.array(rows["matrix"].to_pylist()).reshape(-1, STATES, STATES)
        whole, opening = matrices[0], np.array(rows["opening"][0].as_py())
        for m in matrices[1:]:
            whole, opening = (whole[:, :, None] + m[None]).max(1), (opening[:, None] + m).max(0)
        yield _pieces([rows["conv"][0].as_py()], [rows["parent"][0].as_py()], [whole], [opening])


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best states before (-1: the transcript begins) and at the end of each piece of a run, from those of the run."""
    for rows in _parts(batches, ["conv", "parent"]):
        matrices, before, last = np.array(rows["matrix"].to_pylist()).reshape(-1, STATES, STATES), rows["before"][0].as_py(), rows["last"][0].as_py()
        score, back = (np.array(rows["opening"][0].as_py()) if before < 0 else matrices[0][before]), []
        for m in matrices[1:]:
            ways = score[:, None] + m
            back.append(ways.argmax(0))
            score = ways.max(0)
        path = [last]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        path = path[::-1]
        yield pa.RecordBatch.from_arrays(
            [rows["conv"].combine_chunks().cast(pa.string()), rows["piece"].combine_chunks(), pa.array([before, *path[:-1]], pa.int32()), pa.array(path, pa.int32())], ["conv", "piece", "before", "last"]
        )


def _decode(shared):
    """The state of each line of a chunk whose ends are known."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for rows in _parts(batches, ["conv", "chunk"]):
            shown = model.emissions(rows["mark"].to_numpy(), rows["kind"].to_numpy())
            path = model.decode(shown, rows["before"][0].as_py(), rows["last"][0].as_py())
            for batch in rows.drop_columns(["mark", "kind", "before", "last"]).append_column("state", pa.array(path, pa.int32())).combine_chunks().to_batches():
                yield batch

    return run


def line_roles(turns: DataFrame, model: Model) -> DataFrame:
    """Every line: conv, conv_id, turn, at (line of the row), place (in the transcript, from 0), chunk, plain, role, begins."""
    shared = turns.sparkSession.sparkContext.broadcast(model)
    rows = turns.select("conv_id", "turn", "text", F.xxhash64("text").alias("digest"), F.monotonically_increasing_id().alias("row"))
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    given = ranked_within(lines(rows).withColumn("conv", conv), ["conv"], ["turn", "digest", "row", "at"], "place")
    given = given.withColumn("place", F.col("place") - 1).withColumn("chunk", F.floor(F.col("place") / CHUNK_LINES)).drop("digest", "row")
    dealt = given.select("conv", "chunk", "place", "mark", "kind").repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "place")
    levels = [stored(dealt.mapInArrow(_transfer(shared), PIECE), "transcript-pieces")]
    parent = F.floor(F.col("piece") / FAN).alias("parent")
    while levels[-1].agg(F.max("piece")).first()[0]:
        runs = levels[-1].select("conv", parent, "piece", "matrix", "opening").repartition("conv", "parent").sortWithinPartitions("conv", "parent", "piece")
        levels.append(stored(runs.mapInArrow(_combine, PIECE), "transcript-pieces"))
    best = F.array_position("opening", F.array_max("opening")) - 1
    ends = levels.pop().select("conv", "piece", F.lit(-1).alias("before"), best.cast("int").alias("last"))
    for below in reversed(levels):
        runs = below.select("conv", parent, "piece", "matrix", "opening").join(ends.withColumnRenamed("piece", "parent"), ["conv", "parent"])
        runs = runs.repartition("conv", "parent").sortWithinPartitions("conv", "parent", "piece")
        ends = stored(runs.mapInArrow(_split, "conv string, piece long, before int, last int"), "transcript-ends")
    ready = given.join(ends.withColumnRenamed("piece", "chunk"), ["conv", "chunk"]).repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "place")
    kept = ["conv", "conv_id", "turn", "at", "place", "chunk", "plain"]
    schema = ", ".join(f"{c} {given.schema[c].dataType.simpleString()}" for c in kept)
    found = ready.select(*kept, "mark", "kind", "before", "last").mapInArrow(_decode(shared), f"{schema}, state int")
    role = F.element_at(F.array(*[F.lit(r) for r in ROLES]), F.floor(F.col("state") / 2).cast("int") + 1)
    return found.select(*kept, role.alias("role"), ((F.col("state") % 2 == 1) | (F.col("place") == 0)).alias("begins"))


def parse(turns: DataFrame, model: Model) -> DataFrame:
    """The turns of the transcripts in ``turns`` (conv_id, turn, text): conv_id, place, turn, at, role, n_lines, rendered.

    A transcript is the lines of all rows of a conv_id, in the order of the rows' numbers. ``place`` counts its lines
    from 0; ``turn`` and ``at`` name the row, and the line in it, where the turn begins. ``rendered`` is the canonical
    form, without the marker. A null text is one empty line, a null number stands before all others (as -1). Rows that
    repeat a number follow each other in the order of a hash of their texts, equal ones one after the other. Rows
    without conv_id are one transcript. Other columns are ignored.
    """
    found = stored(line_roles(turns, model), "transcript-lines")
    # The turn of a line begins at the last beginning so far: in its chunk, else in the chunks before it, which are
    # gone through in groups, and these in turn.
    chunks = found.groupBy("conv", "chunk").agg(F.max(F.when(F.col("begins"), F.col("place"))).alias("start")).withColumn("group", F.floor(F.col("chunk") / GROUP_CHUNKS))
    before = lambda order, *by: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    groups = chunks.groupBy("conv", "group").agg(F.max("start").alias("start"))
    groups = groups.select("conv", "group", F.max("start").over(before("group", "conv")).alias("earlier"))
    carried = chunks.withColumn("near", F.max("start").over(before("chunk", "conv", "group"))).join(groups, ["conv", "group"])
    carried = carried.select("conv", "chunk", F.coalesce("near", "earlier").alias("carried"))
    inside = Window.partitionBy("conv", "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    placed = found.withColumn("start", F.max(F.when(F.col("begins"), F.col("place"))).over(inside)).join(carried, ["conv", "chunk"])
    placed = placed.withColumn("start", F.coalesce("start", "carried"))
    first = F.col("place") == F.col("start")
    named = {c: F.max(F.when(first, F.col(c))).alias(c) for c in ("conv_id", "turn", "at", "role")}
    made = placed.groupBy("conv", F.col("start").alias("place")).agg(
        *named.values(), F.count("*").alias("n_lines"), F.array_sort(F.collect_list(F.struct("place", "plain"))).alias("own")
    )
    text = F.trim(F.array_join(F.transform("own", lambda x: x["plain"]), "\n"))
    rendered = F.concat(F.lit("<|"), "role", F.lit("|>\n"), text, F.lit("\n<|end|>"))
    return made.select("conv_id", "place", "turn", "at", "role", "n_lines", rendered.alias("rendered"))


def rendered_transcripts(turns: DataFrame, names: dict[str, str], rows: int = 4) -> DataFrame:
    """(conv_id, turn, text): ``rows`` consecutive turns as one text, each opened by the name of its role (``User: ..``)."""
    name = F.lit("User")
    for role, shown in names.items():
        name = F.when(F.col("role") == role, shown).otherwise(name)
    said = F.concat(name, F.lit(": "), F.coalesce("text", F.lit("")))
    packed = turns.groupBy("conv_id", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / rows).alias("turn")).agg(F.array_sort(F.collect_list(F.struct("turn", said.alias("said")))).alias("own"))
    return packed.select("conv_id", "turn", F.array_join(F.transform("own", lambda x: x["said"]), "\n").alias("text"))
