"""Prediction by partial matching over bytes, pretrained on a corpus, and a smoothed word model to hold it against.

A context is the last 0 to ``ORDER`` bytes; texts start after ``ORDER`` end bytes (0xFF, never part of UTF-8) and end
with one. The longest known context predicts first. An unseen byte costs an escape (method C: distinct successors over
occurrences plus distinct successors) to the context one byte shorter, where the bytes that the longer context knew are
excluded; bytes unseen everywhere share what the empty context leaves. The trie is static, so the totals without
excluded bytes depend only on a context and are stored with it.

Counts cover every training text, and every context predicts. A trie of at most ``MOST_NODES`` nodes is sent to every
task. A larger one stays in stored tables: texts are dealt into chunks of about ``CHUNK_BYTES``, the different bytes
after contexts of a chunk are listed once, when the bytes are counted, and joined with the trie; each chunk then meets
the answers to its own list. That list is never longer than the chunk, however large the trie is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.lookup import SortedHash
from surveyloom.llm.tokens import SPACES, Slice, mix, slices
from surveyloom.session import stored

ORDER = 5
END = 0xFF
#: Nodes up to which a trie is sent to every task.
MOST_NODES = 1_000_000
#: Bytes of the texts, on average, that are scored together if the trie is larger.
CHUNK_BYTES = 1 << 25
#: Words whose counts are sent to every task; the counts of all other words are joined.
MOST_WORDS = 1 << 18


def contexts(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Per byte and end of every text, the last ORDER bytes and the byte as one number; and the bounds of the texts."""
    n, rows = len(part.data), len(part)
    lengths = np.diff(part.starts)
    begin = part.starts[:-1] + np.arange(rows) * (ORDER + 1) + ORDER
    stream = np.full(n + rows * (ORDER + 1), END, np.uint8)
    real = np.arange(n) + np.repeat(begin - part.starts[:-1], lengths)
    stream[real] = part.data
    code = np.zeros(len(stream) - ORDER, np.uint64)
    for k in range(ORDER + 1):
        code = (code << np.uint64(8)) | stream[k : len(code) + k]
    bounds = np.zeros(rows + 1, np.int64)
    np.cumsum(lengths + 1, out=bounds[1:])
    keep = np.arange(bounds[-1]) + np.repeat(np.arange(rows) * ORDER, lengths + 1)
    return code[keep], bounds


class Counter:
    """Counts of 64-bit codes, merged whenever many have gathered."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, codes: np.ndarray, times: int = 1) -> None:
        codes, counts = np.unique(codes, return_counts=True)
        self.parts.append((codes, counts * times))
        self.size += len(codes)
        if len(self.parts) > 1 and self.size > 2_000_000:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) > 1:
            codes = np.concatenate([c for c, _ in self.parts])
            counts = np.concatenate([n for _, n in self.parts])
            order = np.argsort(codes)
            codes, counts = codes[order], counts[order]
            cuts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            self.parts = [(codes[cuts], np.add.reduceat(counts, cuts))]
        self.size = 0
        return self.parts[0] if self.parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of batches (chunk, held_out, text): how often the words occur in training texts (kind 0), and per chunk the bytes
    after contexts (kind 1) of all texts, 0 times if only held-out texts have them."""
    grams, words, chunk = Counter(), Counter(), 0

    def rows(kind: int, counter: Counter) -> Iterator[pa.RecordBatch]:
        codes, counts = counter.merge()
        for i in range(0, len(codes), 100_000):
            part = codes[i : i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), kind, np.int32)), pa.array(np.full(len(part), chunk * kind)), pa.array(part.view(np.int64)), pa.array(counts[i : i + 100_000])],
                ["kind", "chunk", "code", "n"],
            )
        counter.parts = []

    for batch in batches:
        chunks, held = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.r_[True, chunks[1:] != chunks[:-1]]) if len(chunks) else []
        for start, end in zip(starts, [*starts[1:], len(chunks)], strict=True):
            if chunks[start] != chunk:
                yield from rows(1, grams)
                chunk = int(chunks[start])
            for training in (True, False):
                for part in slices(batch.column(2)[start:end].filter(pa.array(held[start:end] != training))):
                    grams.add(contexts(part)[0], int(training))
                    hashes, _ = part.words(SPACES) if training else ([], None)
                    if len(hashes):
                        words.add(hashes)
            for kind, counter in ((1, grams), (0, words)):
                if sum(len(c) for c, _ in counter.parts) > 3_000_000:
                    yield from rows(kind, counter)
    yield from rows(1, grams)
    yield from rows(0, words)


def _key(order: int, code: np.ndarray, context: bool) -> np.ndarray:
    return mix(mix(code + np.uint64(1)) ^ np.uint64((2 * order + context + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def trie_logs(order: np.ndarray, code: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys, in order, and logs of the nodes of a trie (order, code of context and byte, count) and of their contexts.

    A node has the log10 of its probability and of its count; a context that of its escape, of what the context one
    byte shorter has besides its own bytes, and of the escape there.
    """
    low = np.uint64(8)
    keys, logs = [], []
    nodes: dict[int, tuple] = {}
    for k in range(ORDER + 1):
        own, n = code[order == k], count[order == k].astype(float)
        by = np.argsort(own)
        own, n = own[by], n[by]
        context = own >> low
        cuts = np.flatnonzero(np.r_[len(own) > 0, context[1:] != context[:-1]]) if len(own) else np.zeros(0, int)
        total = np.add.reduceat(n, cuts) if len(cuts) else np.zeros(0)
        kinds = np.diff(np.r_[cuts, len(own)]).astype(float)
        # What the context one byte shorter has besides the bytes known here.
        if k:
            up_code, up_n, up_context, up_total, up_kinds = nodes[k - 1]
            same = up_n[np.searchsorted(up_code, own & np.uint64((1 << 8 * k) - 1))]
            known = np.add.reduceat(same, cuts) if len(cuts) else np.zeros(0)
            at = np.searchsorted(up_context, context[cuts] & np.uint64((1 << 8 * (k - 1)) - 1))
            rest, rest_kinds = up_total[at] - known, up_kinds[at] - kinds
        else:
            rest, rest_kinds = np.zeros(len(cuts)), np.zeros(len(cuts))
        nodes[k] = (own, n, context[cuts], total, kinds)
        norm = np.repeat(total + kinds, kinds.astype(int))
        keys += [_key(k, own, False), _key(k, context[cuts], True)]
        with np.errstate(divide="ignore"):
            down = np.where(rest_kinds > 0, np.log10(np.maximum(rest + rest_kinds, 1)), 0.0)
            skip = np.where(rest_kinds > 0, np.log10(np.maximum(rest_kinds, 1)) - down, 0.0)
            logs += [
                np.stack([np.log10(n / norm), np.log10(n), np.zeros(len(n))], 1),
                np.stack([np.log10(kinds / (total + kinds)), down, skip], 1),
            ]
    key, log = np.concatenate(keys), np.concatenate(logs)
    by = np.argsort(key)
    return key[by], log[by]


def _build(chosen: pa.Table) -> pa.Table:
    """``trie_logs`` of the nodes of a trie that is broadcast, which are one group."""
    key, log = trie_logs(chosen["order"].to_numpy(), chosen["code"].to_numpy().view(np.uint64), chosen["n"].to_numpy())
    return pa.table({"key": pa.array(key.view(np.int64)), **{f"log{i}": pa.array(np.ascontiguousarray(log[:, i])) for i in range(3)}})


class Trie:
    """Log probabilities of a static trie, from the rows of ``trie_logs``."""

    def __init__(self, key: np.ndarray, logs: list[np.ndarray], fresh: float):
        """``fresh``: log10 probability of a byte that no context knows."""
        self.fresh = fresh
        by = np.argsort(key)
        self.table = SortedHash(key[by])
        self.logs = np.empty((len(key), 3))
        for i, column in enumerate(logs):
            self.logs[:, i] = column[by]

    def score(self, code: np.ndarray) -> np.ndarray:
        """log10 probability of each byte after its context."""
        out = np.zeros(len(code), np.float64)
        open_ = np.arange(len(code))
        escaped = np.zeros(len(code), bool)
        down, skip = np.zeros(len(code)), np.zeros(len(code))
        for k in range(ORDER, -1, -1):
            own = code[open_] & np.uint64((1 << 8 * (k + 1)) - 1)
            at = self.table.find(_key(k, own, False))
            hit = at >= 0
            done, entry = open_[hit], at[hit]
            out[done] += np.where(escaped[done], self.logs[entry, 1] - down[done], self.logs[entry, 0])
            open_, own = open_[~hit], own[~hit]
            if not len(open_):
                break
            at = self.table.find(_key(k, own >> np.uint64(8), True))
            known = at >= 0
            here, node = open_[known], at[known]
            out[here] += np.where(escaped[here], skip[here], self.logs[node, 0])
            escaped[here] = True
            down[here], skip[here] = self.logs[node, 1], self.logs[node, 2]
        out[open_] += self.fresh
        return out


class Answers:
    """Log probabilities of the bytes after contexts that a chunk of texts has."""

    def __init__(self, code: np.ndarray, log: np.ndarray):
        code, first = np.unique(code, return_index=True)
        key = mix(code)
        by = np.argsort(key)
        self.table, self.logs = SortedHash(key[by]), log[first][by]

    def score(self, code: np.ndarray) -> np.ndarray:
        return self.logs[self.table.find(mix(code))]


class Levels:
    """The whole trie as stored tables: ``nodes`` (code, n) and ``totals`` (context, total, kinds) of each order."""

    def __init__(self, nodes: list[DataFrame], totals: list[DataFrame], fresh: float):
        self.nodes, self.totals, self.fresh = nodes, totals, fresh

    def _contexts(self, k: int, here: DataFrame) -> DataFrame:
        """The contexts ``here`` of order ``k`` with the logs of their escape: context, total, kinds, down, skip."""
        own = self.totals[k].join(here, "context", "left_semi")
        if not k:
            return own.withColumns({"down": F.lit(0.0), "skip": F.lit(0.0)})
        nodes = self.nodes[k].withColumn("context", F.shiftright("code", 8)).join(here, "context", "left_semi")
        known = nodes.select("context", F.col("code").bitwiseAND((1 << 8 * k) - 1).alias("code")).join(self.nodes[k - 1], "code")
        known = known.groupBy("context").agg(F.sum("n").alias("known"))
        shorter = self.totals[k - 1].toDF("up", "up_total", "up_kinds")
        own = own.join(known, "context").withColumn("up", F.col("context").bitwiseAND((1 << 8 * (k - 1)) - 1)).join(shorter, "up")
        rest_kinds = F.col("up_kinds") - F.col("kinds")
        down = F.when(rest_kinds > 0, F.log10(F.col("up_total") - F.col("known") + rest_kinds)).otherwise(0.0)
        skip = F.when(rest_kinds > 0, F.log10(rest_kinds) - down).otherwise(0.0)
        return own.select("context", "total", "kinds", down.alias("down"), skip.alias("skip"))

    def find(self, wanted: DataFrame) -> DataFrame:
        """Different codes of the longest order: code, n (null: not a node), below (log10 probability after an escape
        from its context) and score (that without an escape before).

        Order by order from the empty context up, each stored, so that a step joins only the one before. A key is
        shared by at most 256 rows.
        """
        lower = None
        for k in range(ORDER + 1):
            codes = wanted.select(F.col("code").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("code")).distinct()
            codes = stored(codes.withColumn("context", F.shiftright("code", 8)), "ppm-wanted", compression="zstd")
            contexts = stored(self._contexts(k, codes.select("context").distinct()), "ppm-escapes", compression="zstd")
            found = codes.join(self.nodes[k], "code", "left").join(contexts, "context", "left")
            if lower is None:
                below = without = F.lit(self.fresh)
            else:
                found = found.withColumn("suffix", F.col("code").bitwiseAND((1 << 8 * k) - 1)).join(lower.toDF("suffix", "n_lower", "below_lower", "without"), "suffix")
                below = F.when(F.col("n_lower").isNotNull(), F.log10("n_lower") - F.col("down")).otherwise(F.col("skip") + F.col("below_lower"))
                without = F.col("without")
            norm = F.col("total") + F.col("kinds")
            score = (
                F.when(F.col("n").isNotNull(), F.log10(F.col("n") / norm))
                .when(F.col("total").isNotNull(), F.log10(F.col("kinds") / norm) + below)
                .otherwise(without)
            )
            lower = stored(found.select("code", "n", below.alias("below"), score.alias("score")), "ppm-order", compression="zstd")
        return lower


def fit_trie(grams: DataFrame, most: int | None = None) -> Trie | Levels:
    """Trie of byte counts (code, n) of the longest contexts, as stored tables if it has more than ``most`` nodes."""
    most = MOST_NODES if most is None else most
    nodes = [stored(grams.select("code", "n"), "ppm-level")]
    for k in range(ORDER - 1, -1, -1):
        shorter = nodes[0].withColumn("code", F.col("code").bitwiseAND((1 << 8 * (k + 1)) - 1))
        nodes.insert(0, stored(shorter.groupBy("code").agg(F.sum("n").alias("n")), "ppm-level"))
    sizes = [level.count() for level in nodes]
    fresh = float(np.log10(1 / max(1.0, 256.0 - sizes[0])))
    if sum(sizes) > most:
        context = F.shiftright("code", 8).alias("context")
        totals = [stored(level.groupBy(context).agg(F.sum("n").alias("total"), F.count("*").alias("kinds")), "ppm-contexts") for level in nodes]
        return Levels(nodes, totals, fresh)
    every = nodes[0].select(F.lit(0).alias("order"), "code", "n")
    for k, level in enumerate(nodes[1:], 1):
        every = every.unionAll(level.select(F.lit(k).alias("order"), "code", "n"))
    # The logs are worked out in a task, of a bounded number of nodes; the driver takes them as they are.
    built = every.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_build, "key long, log0 double, log1 double, log2 double").toArrow()
    return Trie(built["key"].to_numpy().view(np.uint64), [built[f"log{i}"].to_numpy() for i in range(3)], fresh)


def _score(batch: pa.RecordBatch | pa.Table, bytes_: Trie | Answers, words: SortedHash, logs: np.ndarray) -> pa.RecordBatch:
    """Of texts (row, doc_id, held_out, text): the sums of what is here, and the words that are not, with their times."""
    tokens, known, base, total, rare, times = [], [], [], [], [], []
    for part in slices(batch["text"]):
        code, ends = contexts(part)
        sums = np.concatenate([[0.0], np.cumsum(bytes_.score(code))])
        total.append(sums[ends[1:]] - sums[ends[:-1]])
        hashes, bounds = part.words(SPACES)
        at = words.find(hashes)
        found = at >= 0
        sums = np.concatenate([[0.0], np.cumsum(np.where(found, logs[at], 0.0))])
        seen = np.concatenate([[0], np.cumsum(found)])
        tokens.append(np.diff(bounds))
        base.append(sums[bounds[1:]] - sums[bounds[:-1]])
        known.append(seen[bounds[1:]] - seen[bounds[:-1]])
        for i in range(len(part)):
            own = hashes[bounds[i] : bounds[i + 1]]
            own, n = np.unique(own[~found[bounds[i] : bounds[i + 1]]], return_counts=True)
            rare.append(own.view(np.int64))
            times.append(n)
    lists = []
    for values in (rare, times):
        offsets = np.zeros(batch.num_rows + 1, np.int32)
        np.cumsum([len(x) for x in values], out=offsets[1:])
        lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values))))
    given = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (batch[c] for c in ("row", "doc_id", "held_out"))]
    return pa.RecordBatch.from_arrays(
        [*given, *(pa.array(np.concatenate(x)) for x in (tokens, known, base, total)), *lists],
        ["row", "doc_id", "held_out", "n_words", "known", "base", "score", "rare", "times"],
    )


def _score_batches(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _score(batch, *model.value)

    return score


def _score_chunk(model):
    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        own = Answers(answers["code"].to_numpy().view(np.uint64), answers["log"].to_numpy())
        return pa.Table.from_batches([_score(texts, own, *model.value[1:])])

    return score


def score_documents(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Log10 probability of every text under models of the texts for which the column ``held_out`` is false.

    One row per row of ``docs``: doc_id, held_out, n_tokens (words and one end), n_known (tokens seen in training),
    train_tokens, base_score (words counted with one added) and score (prediction by partial matching over the bytes
    of the text with A-Z as a-z). A null text is empty and consists of its end alone. A null ``held_out`` counts as
    training. Repeated rows are scored, and counted in training, each for itself. Without training texts, base_score
    is 0 for an end alone, and every byte has probability 1/256. Other columns are ignored.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    # Stored, so that a text is in the same chunk each time.
    given = stored(given.withColumns({"row": F.monotonically_increasing_id(), "size": F.coalesce(F.octet_length("text"), F.lit(0)) + 1}), "ppm-texts", compression="zstd")
    texts, rows, size = given.agg(F.count_if(~F.col("held_out")), F.count("*"), F.coalesce(F.sum("size"), F.lit(1))).first()
    bits = min(33, max(1, CHUNK_BYTES * rows // size).bit_length() - 1)
    given = given.withColumn("chunk", F.shiftright("row", bits)).drop("size")
    counted = given.select("chunk", "held_out", "text").mapInArrow(_count, "kind int, chunk long, code long, n long")
    # Dealt and sorted by code, so that what is added up or joined by code below moves and takes little.
    asked = counted.repartition("kind", "code").groupBy("kind", "code", "chunk").agg(F.sum("n").alias("n"))
    asked = stored(asked.sortWithinPartitions("kind", "code"), "ppm-asked", compression="zstd")
    words, asked = asked.where("kind = 0").select(F.col("code").alias("word"), "n"), asked.where("kind = 1").drop("kind")
    grams = stored(asked.groupBy("code").agg(F.sum("n").alias("n")), "ppm-counts")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n, v = sums[0] + texts, sums[1] + (texts > 0)
    trie = fit_trie(grams.where("n > 0"))
    frequent = words.orderBy(F.desc("n"), "word").limit(MOST_WORDS).toArrow()
    keys, logs = frequent["word"].to_numpy().view(np.uint64), np.log10(frequent["n"].to_numpy() + 1.0)
    by = np.argsort(keys)
    levels = trie if isinstance(trie, Levels) else None
    model = spark.sparkContext.broadcast((None if levels else trie, SortedHash(keys[by]), np.append(logs[by], 0.0)))
    schema = f"row long, doc_id {given.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_words long, known long, base double, score double, rare array<long>, times array<long>"
    if levels is None:
        scored = given.mapInArrow(_score_batches(model), schema)
    else:
        found = levels.find(grams.select("code")).select("code", F.col("score").alias("log"))
        answers = asked.select("chunk", "code").join(found, "code")
        scored = given.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_score_chunk(model), schema)
    scored = stored(scored, "ppm-scored", compression="zstd")
    model.destroy()
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    rest = rare.join(words, "word").groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("logs"))
    end, norm = float(np.log10(texts + 1.0)), float(np.log10(n + v + 1.0))
    return scored.join(rest, "row", "left").select(
        "doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("more", F.lit(0)) + F.lit(int(texts > 0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("logs", F.lit(0.0)) + end - (F.col("n_words") + 1) * norm).alias("base_score"), "score",
    )
