"""Language identification by interpolated Kneser-Ney character models, held together in sorted hash arrays.

A text is its lower-cased letters; any other characters between two letters are one word end. A character is predicted
from up to three characters before it in the same word (a word starts after word ends). Every language has its own
model; the arrays hold the n-grams that any language has seen, with one log probability per language. The language
with the lowest cross-entropy per character wins. Rejection is calibrated on the training texts: a text is rejected
if its cross-entropy is above that of nearly all training texts of the language.

Every n-gram of the training texts counts. While they are few, all of them are broadcast. Otherwise counts, discounts
and probabilities are computed in Spark, the most frequent n-grams are broadcast with their exact probabilities, and
those of a text that are not among them are joined with the stored model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.lookup import SortedHash
from surveyloom.llm.tokens import mix
from surveyloom.session import stored

ORDER = 4
SLICE_CHARS = 1 << 18
#: Most n-grams of the longest order that are broadcast (of up to eight languages, fewer of more); all others are joined.
MOST_GRAMS = 400_000
#: Weights of the cross-entropy from which the one with the best likelihood of the training labels is taken.
SHARPNESS = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)
UNKNOWN = "und"
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters (Unicode categories L*)."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def characters(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, symbols, bounds of rows) of slices of whole texts. A symbol is a letter's code point, or 0 for a word end."""
    texts = column.to_pylist()
    first = 0
    while first < len(texts):
        last, size, rows = first, 0, []
        while last < len(texts) and (last == first or size + len(texts[last] or "") <= SLICE_CHARS):
            rows.append((texts[last] or "").lower() + "\n")
            size += len(rows[-1])
            last += 1
        codes = np.frombuffer("".join(rows).encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = letters()[codes]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        symbols = np.where(letter, codes, 0)[keep].astype(np.uint64)
        ends = np.cumsum([len(r) for r in rows])
        kept = np.concatenate([[0], np.cumsum(keep)])
        yield first, symbols, kept[np.concatenate([[0], ends])]
        first = last


def grams(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol with the three before it in its word: (third and second, first and own), 21 bits each."""
    n = len(symbols)
    before = []
    known = np.ones(n, bool)
    for k in (1, 2, 3):
        previous = np.zeros(n, np.uint64)
        previous[k:] = symbols[:-k] if n > k else previous[k:]
        known = known & (previous != 0)
        before.append(np.where(known, previous, np.uint64(0)))
    bits = np.uint64(21)
    return (before[2] << bits) | before[1], (before[0] << bits) | symbols


def shorten(high: np.ndarray, low: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams cut to their last ``order`` symbols."""
    if order >= 4:
        return high, low
    if order == 3:
        return high & np.uint64((1 << 21) - 1), low
    return np.zeros_like(high), low if order == 2 else low & np.uint64((1 << 21) - 1)


def context(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return high, low >> np.uint64(21)


def _key(high: np.ndarray, low: np.ndarray, order: int, is_context: bool) -> np.ndarray:
    # The order is mixed in by itself: added to ``high``, it made n-grams of two orders share a key.
    kind = np.uint64((2 * order + is_context + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
    return mix(mix(mix(high + np.uint64(1)) ^ kind) * np.uint64(0x9E3779B97F4A7C15) + low)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[str, list] = {}

    def rows(lang: str, least: int) -> Iterator[pa.RecordBatch]:
        own = parts[lang]
        high, low, n = (np.concatenate([p[i] for p in own]) for i in range(3))
        order = np.lexsort((low, high))
        high, low, n = high[order], low[order], n[order]
        cuts = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
        parts[lang] = [(high[cuts], low[cuts], np.add.reduceat(n, cuts))]
        if len(cuts) >= least:
            high, low, n = parts[lang].pop()
            for i in range(0, len(n), 100_000):
                size = len(n[i : i + 100_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * size, pa.string()), pa.array(high[i : i + size].view(np.int64)), pa.array(low[i : i + size].view(np.int64)), pa.array(n[i : i + size])],
                    ["lang", "high", "low", "n"],
                )

    for batch in batches:
        langs = batch.column(0)
        for lang in set(langs.to_pylist()):
            own = batch.filter(pc.equal(langs, lang)).column(1)
            for _, symbols, _ in characters(own):
                if not len(symbols):
                    continue
                high, low = grams(symbols)
                _, at, n = np.unique(_key(high, low, ORDER, False), return_index=True, return_counts=True)
                parts.setdefault(lang, []).append((high[at], low[at], n))
                if sum(len(p[2]) for p in parts[lang]) > 1_000_000:
                    yield from rows(lang, 500_000)
    for lang in list(parts):
        if parts[lang]:
            yield from rows(lang, 0)


class Models:
    """Log probabilities (base 2) per language of all n-grams, and interpolation weights of their contexts."""

    def __init__(self, langs: list[str], lang: np.ndarray, high: np.ndarray, low: np.ndarray, n: np.ndarray):
        self.langs = langs
        count = len(langs)
        keys, logs = [], []
        # Distinct n-grams per order, and counts per language: occurrences at the highest order and at word starts,
        # numbers of different preceding symbols below.
        levels = []
        raw = (high, low, lang, n.astype(float))
        types = raw
        for order in range(ORDER, 0, -1) if len(n) else ():
            h, l, g, c = types
            levels.append((order, h, l, g, c))
            if order > 1:
                sh, sl = shorten(raw[0], raw[1], order - 1)
                first = sh & np.uint64((1 << 21) - 1) if order - 1 == 3 else sl >> np.uint64(21) if order - 1 == 2 else np.ones_like(sl)
                occurrences = self._sum(sh, sl, raw[2], raw[3])
                th, tl = shorten(h, l, order - 1)
                different = self._sum(th, tl, g, np.ones(len(g)))
                start = self._sum(sh, sl, raw[2], (first == 0).astype(float))[3] > 0
                types = (*different[:3], np.where(start, occurrences[3], different[3]))
        below, below_keys = None, None
        for order, h, l, g, c in reversed(levels):
            key = _key(h, l, order, False)
            grid, index = np.unique(key, return_inverse=True)
            first = np.zeros(len(grid), np.int64)
            first[index] = np.arange(len(key))
            counts = np.zeros((len(grid), count))
            np.add.at(counts, (index, g), c)
            ch, cl = context(h[first], l[first])
            ckey = _key(ch, cl, order, True)
            contexts, of = np.unique(ckey, return_inverse=True)
            total, kinds = np.zeros((len(contexts), count)), np.zeros((len(contexts), count))
            np.add.at(total, of, counts)
            np.add.at(kinds, of, counts > 0)
            ones, twos = (counts == 1).sum(0), (counts == 2).sum(0)
            discount = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.95)
            weight = np.where(total > 0, discount * kinds / np.maximum(total, 1e-9), 1.0)
            if below is None:
                self.symbols = len(grid) + 1
                lower = np.full((len(grid), count), 1.0 / self.symbols)
            else:
                sh, sl = shorten(h[first], l[first], order - 1)
                lower = below[np.searchsorted(below_keys, _key(sh, sl, order - 1, False))]
            p = np.maximum(counts - discount, 0) / np.maximum(total[of], 1e-9) + weight[of] * lower
            below, below_keys = p, grid
            keys += [grid, contexts]
            logs += [np.log2(p), np.log2(weight)]
        if keys:
            key, log = np.concatenate(keys), np.concatenate(logs).astype(np.float32)
            by = np.argsort(key)
            self.table, self.logs = SortedHash(key[by]), log[by]
        else:
            self.symbols, self.table, self.logs = 1, SortedHash(np.zeros(0, np.uint64)), np.zeros((0, count), np.float32)

    @staticmethod
    def _sum(h, l, g, c):
        order = np.lexsort((g, l, h))
        h, l, g, c = h[order], l[order], g[order], c[order]
        cuts = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (l[1:] != l[:-1]) | (g[1:] != g[:-1])])
        return h[cuts], l[cuts], g[cuts], np.add.reduceat(c, cuts)

    def score(self, symbols: np.ndarray) -> np.ndarray:
        """log2 probability of each symbol in each language."""
        high, low = grams(symbols)
        out = np.zeros((len(symbols), len(self.langs)), np.float32)
        open_ = np.arange(len(symbols))
        for order in range(ORDER, 0, -1):
            h, l = shorten(high[open_], low[open_], order)
            at = self.table.find(_key(h, l, order, False))
            hit = at >= 0
            out[open_[hit]] += self.logs[at[hit]]
            open_, h, l = open_[~hit], h[~hit], l[~hit]
            if not len(open_):
                return out
            at = self.table.find(_key(*context(h, l), order, True))
            known = at >= 0
            out[open_[known]] += self.logs[at[known]]
        out[open_] -= np.log2(self.symbols)
        return out


class Head:
    """The most frequent n-grams of the longest order, with the log probabilities of the whole models."""

    def __init__(self, langs: list[str], high: np.ndarray, low: np.ndarray, logs: np.ndarray):
        key = _key(high, low, ORDER, False)
        by = np.argsort(key)
        self.langs, self.table = langs, SortedHash(key[by])
        self.logs = np.concatenate([logs[by], np.zeros((1, len(langs)))]).astype(np.float32)

    def score(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log2 probability of each symbol in each language (0: its n-gram is not here), and which are not here."""
        at = self.table.find(_key(*grams(symbols), ORDER, False))
        return self.logs[at], at < 0


def _suffix(order: int) -> tuple[Column, Column]:
    """``shorten`` on the columns high and low."""
    mask = (1 << 21) - 1
    high = F.col("high").bitwiseAND(mask) if order == 3 else F.lit(0).cast("long")
    return high, F.col("low") if order > 1 else F.col("low").bitwiseAND(mask)


class Tables:
    """The models as stored tables, by order: ``grams`` (high, low, p) and ``contexts`` (high, before, weight), with a
    value per language in each array."""

    def __init__(self, counts: DataFrame, langs: list[str]):
        """``counts``: lang, high, low, n of all n-grams of the longest order."""
        self.langs = langs
        number = (F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")) - 1).cast("int")
        levels = {ORDER: counts.select(number.alias("g"), "high", "low", F.col("n").alias("seen"), F.col("n").alias("c"))}
        for order in range(ORDER - 1, 0, -1):
            high, low = _suffix(order)
            level = levels[order + 1].groupBy("g", high.alias("high"), low.alias("low")).agg(F.sum("seen").alias("seen"), F.count("*").alias("kinds"))
            first = {3: F.col("high"), 2: F.shiftright("low", 21), 1: F.lit(1)}[order]
            level = level.withColumn("c", F.when(first == 0, F.col("seen")).otherwise(F.col("kinds")))
            levels[order] = stored(level.select("g", "high", "low", "seen", "c"), "language-level")
        self.symbols = levels[1].select("low").distinct().count() + 1
        self.grams: dict[int, DataFrame] = {}
        self.contexts: dict[int, DataFrame] = {}
        for order in range(1, ORDER + 1):
            self._add(order, levels[order])

    def _each(self, of: str, otherwise) -> Column:
        """Array with the value of every language from the map ``of``."""
        return F.transform(F.sequence(F.lit(0), F.lit(len(self.langs) - 1)), lambda i: F.coalesce(F.try_element_at(F.col(of), i), otherwise))

    def _add(self, order: int, level: DataFrame) -> None:
        few = {r.g: r for r in level.groupBy("g").agg(F.count_if(F.col("c") == 1).alias("ones"), F.count_if(F.col("c") == 2).alias("twos")).collect()}
        discounts = [min(max(few[i].ones / max(few[i].ones + 2 * few[i].twos, 1), 0.1), 0.95) for i in range(len(self.langs))]
        discount = F.array(*[F.lit(d) for d in discounts])
        before = F.shiftright("low", 21).alias("before")
        entries = lambda *values: F.map_from_entries(F.collect_list(F.struct("g", *values)))
        sums = level.groupBy("g", "high", before).agg(F.sum("c").cast("double").alias("total"), F.count("*").alias("kinds"))
        weight = F.get(discount, F.col("g")) * F.col("kinds") / F.col("total")
        sums = sums.withColumn("weight", weight).groupBy("high", "before").agg(entries("total").alias("t"), entries("weight").alias("w"))
        contexts = stored(sums.select("high", "before", self._each("t", F.lit(0.0)).alias("total"), self._each("w", F.lit(1.0)).alias("weight")), "language-contexts")
        self.contexts[order] = contexts.select("high", "before", "weight")
        found = level.groupBy("high", "low").agg(entries(F.col("c").cast("double").alias("c")).alias("m"), F.sum("c").alias("n"))
        found = found.select("high", "low", before, "n", self._each("m", F.lit(0.0)).alias("counts"))
        found = found.join(F.broadcast(contexts) if order == 1 else contexts, ["high", "before"])
        if order == 1:
            found = found.withColumn("lower", F.array_repeat(F.lit(1.0 / self.symbols), len(self.langs)))
        else:
            high, low = _suffix(order - 1)
            found = found.withColumns({"h": high, "l": low}).join(self.grams[order - 1].select(F.col("high").alias("h"), F.col("low").alias("l"), F.col("p").alias("lower")), ["h", "l"])
        p = F.transform(
            F.arrays_zip("counts", "discount", "total", "weight", "lower"),
            lambda x: F.greatest(x["counts"] - x["discount"], F.lit(0.0)) / F.greatest(x["total"], F.lit(1e-9)) + x["weight"] * x["lower"],
        )
        self.grams[order] = stored(found.withColumn("discount", discount).select("high", "low", "n", p.alias("p")), "language-grams")

    def head(self, most: int) -> Head:
        """The most frequent n-grams, down to the power of two at which they are at most ``most``."""
        grams = self.grams[ORDER]
        sizes = grams.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).agg(F.count("*").alias("grams")).orderBy(F.desc("p")).collect()
        kept, least = 0, None
        for size in sizes:
            if kept + size.grams > most:
                break
            kept, least = kept + size.grams, 1 << size.p
        logs = F.transform("p", lambda x: F.log2(x).cast("float")).alias("logs")
        chosen = grams.where(F.col("n") >= least if least else F.lit(False)).select("high", "low", logs).toArrow()
        flat = chosen["logs"].combine_chunks().flatten().to_numpy().reshape(-1, len(self.langs))
        return Head(self.langs, chosen["high"].to_numpy().view(np.uint64), chosen["low"].to_numpy().view(np.uint64), flat)

    def find(self, wanted: DataFrame, order: int = ORDER) -> DataFrame:
        """Probabilities of different n-grams, seen or not: (high, low, p). A key is shared by at most an alphabet of rows."""
        grams = self.grams[order].select("high", "low", F.col("p").alias("known"))
        found = wanted.join(grams, ["high", "low"], "left").withColumn("before", F.shiftright("low", 21))
        contexts = self.contexts[order]
        found = found.join(F.broadcast(contexts) if order == 1 else contexts, ["high", "before"], "left")
        if order == 1:
            found = found.withColumn("lower", F.array_repeat(F.lit(1.0 / self.symbols), len(self.langs)))
        else:
            high, low = _suffix(order - 1)
            lower = self.find(wanted.select(high.alias("high"), low.alias("low")).distinct(), order - 1)
            found = found.withColumns({"h": high, "l": low}).join(lower.toDF("h", "l", "lower"), ["h", "l"])
        backed = F.when(F.col("weight").isNull(), F.col("lower")).otherwise(F.zip_with("weight", "lower", lambda w, x: w * x))
        return found.select("high", "low", F.coalesce("known", backed).alias("p"))


def fit(training: DataFrame, most: int = MOST_GRAMS) -> Models | Tables:
    """Models of ``training`` (lang, text), both not null, from all its n-grams.

    They are ``Models`` if the n-grams of the longest order are at most ``most``, else ``Tables``.
    """
    counted = training.select("lang", "text").mapInArrow(_count, "lang string, high long, low long, n long")
    counts = stored(counted.groupBy("lang", "high", "low").agg(F.sum("n").alias("n")), "language-counts")
    sizes = counts.groupBy("lang").agg(F.count("*").alias("grams")).collect()
    langs = sorted(r.lang for r in sizes)
    if sum(r.grams for r in sizes) > _room(most, langs):
        return Tables(counts, langs)
    chosen = counts.toArrow()
    index = {lang: i for i, lang in enumerate(langs)}
    numbers = np.array([index[x] for x in chosen["lang"].to_pylist()], np.int64)
    return Models(langs, numbers, chosen["high"].to_numpy().view(np.uint64), chosen["low"].to_numpy().view(np.uint64), chosen["n"].to_numpy())


def _room(most: int, langs: list[str]) -> int:
    """A broadcast n-gram has a value per language."""
    return most * 8 // max(8, len(langs))


def _rare(high: np.ndarray, low: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, ...]:
    """Different n-grams per row and how often each occurs; and how many there are up to each row."""
    by = np.lexsort((low, high, row))
    high, low, row = high[by], low[by], row[by]
    cuts = np.flatnonzero(np.r_[len(row) > 0, (high[1:] != high[:-1]) | (low[1:] != low[:-1]) | (row[1:] != row[:-1])]) if len(row) else np.zeros(0, int)
    return high[cuts].view(np.int64), low[cuts].view(np.int64), np.diff(np.r_[cuts, len(row)]), np.searchsorted(row[cuts], np.arange(1, rows + 1))


def _entropies(models):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = models.value
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            if not batch.num_rows:
                continue
            sums = np.zeros((batch.num_rows, len(model.langs)))
            sizes = np.zeros(batch.num_rows, np.int64)
            rare = [], [], []
            ends = np.zeros(batch.num_rows + 1, np.int32)
            for first, symbols, bounds in characters(batch.column(3)):
                rows = len(bounds) - 1
                sizes[first : first + rows] = np.diff(bounds)
                full = np.flatnonzero(np.diff(bounds))
                ends[first + 1 : first + rows + 1] = ends[first]
                if not len(full):
                    continue
                if isinstance(model, Head):
                    logs, missing = model.score(symbols)
                    own = np.repeat(np.arange(rows), np.diff(bounds))[missing]
                    *found, upto = _rare(*(x[missing] for x in grams(symbols)), own, rows)
                    for values, part in zip(rare, found, strict=True):
                        values.append(part)
                    ends[first + 1 : first + rows + 1] += upto.astype(np.int32)
                else:
                    logs = model.score(symbols)
                sums[first + full] = np.add.reduceat(logs.astype(np.float64), bounds[full])
            width = len(model.langs)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(sums.ravel()), width).cast(pa.list_(pa.float64())) if width else pa.array([[]] * batch.num_rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(number, number + batch.num_rows)), batch.column(0), batch.column(1), batch.column(2), pa.array(sizes), lists,
                 *(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *x]))) for x in rare)],
                ["row", "doc_id", "held_out", "lang", "n_symbols", "sums", "high", "low", "times"],
            )
            number += batch.num_rows

    return score


def _joined(scored: DataFrame, tables: Tables) -> DataFrame:
    """``scored`` with the n-grams added that were not broadcast."""
    rare = scored.select("row", F.explode(F.arrays_zip("high", "low", "times")).alias("x")).select("row", "x.*")
    found = stored(tables.find(rare.select("high", "low").distinct()), "language-rare")
    logs = [F.sum(F.col("times") * F.log2(F.get("p", F.lit(i)))) for i in range(len(tables.langs))]
    more = rare.join(found, ["high", "low"]).groupBy("row").agg(F.array(*logs).alias("more"))
    added = F.when(F.col("more").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "more", lambda a, b: a + b))
    return scored.drop("high", "low", "times").join(more, "row", "left").withColumn("sums", added).drop("more")


def identify(docs: DataFrame, held_out, reject_above: float = 0.999, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = MOST_GRAMS) -> DataFrame:
    """Language of every text: (doc_id, held_out, lang_pred, score, cross_entropy, rejected), a row per row of ``docs``.

    Models are learned from rows with ``held_out`` false and a language that is not null. ``score`` is the probability
    of the predicted language among those learned. ``rejected``: the cross-entropy (bits per character) exceeds the
    ``reject_above`` quantile of the training texts predicted as that language. A null text, or one without letters,
    is ``und`` with score 0 and is rejected, and so is every text if nothing was learned. Ties go to the language
    that sorts first. Repeated rows are predicted each for itself. Other columns are ignored. ``most`` bounds what is
    broadcast and changes no result.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    models = fit(given.where("not held_out and lang is not null and text is not null"), most)
    shared = models.head(_room(most, models.langs)) if isinstance(models, Tables) else models
    schema = f"row long, doc_id {given.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang string, n_symbols long, sums array<double>, high array<long>, low array<long>, times array<long>"
    scored = stored(given.mapInArrow(_entropies(spark.sparkContext.broadcast(shared)), schema), "language-scores")
    if isinstance(models, Tables):
        scored = stored(_joined(scored, models), "language-sums")
    scored = scored.withColumn("entropy", F.transform("sums", lambda x: -x / F.greatest("n_symbols", F.lit(1))))
    if not models.langs:
        return scored.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
    langs = F.array(*[F.lit(x) for x in models.langs])
    best = F.array_min("entropy")
    scored = scored.withColumns({"best": best, "lang_pred": F.when(F.col("n_symbols") > 0, F.element_at(langs, F.array_position("entropy", F.col("best")).cast("int")))})

    def likelihood(sharp: float, value):
        total = F.aggregate("entropy", F.lit(0.0), lambda acc, e: acc + F.exp(F.lit(sharp) * (F.col("best") - e)))
        return F.exp(F.lit(sharp) * (F.col("best") - value)) / total

    labelled = scored.where(F.col("lang_pred").isNotNull() & ~F.col("held_out") & F.col("lang").isin(models.langs))
    own = F.element_at("entropy", F.array_position(langs, F.col("lang")).cast("int"))
    fits = labelled.agg(*[F.sum(F.log(F.greatest(likelihood(s, own), F.lit(1e-12)))).alias(f"s{i}") for i, s in enumerate(SHARPNESS)]).first()
    sharp = max(range(len(SHARPNESS)), key=lambda i: fits[i] if fits[i] is not None else 0.0)
    limits = labelled.groupBy("lang_pred").agg(F.percentile_approx("best", reject_above, 10_000).alias("limit")).collect()
    limit = F.create_map(*[F.lit(x) for r in limits for x in (r.lang_pred, r.limit)]) if limits else F.create_map(F.lit(""), F.lit(0.0))
    return scored.select(
        "doc_id", "held_out", F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("lang_pred").isNull(), 0.0).otherwise(likelihood(SHARPNESS[sharp], F.col("best"))).alias("score"),
        F.when(F.col("lang_pred").isNotNull(), F.col("best")).alias("cross_entropy"),
        F.coalesce(F.col("best") > F.try_element_at(limit, F.col("lang_pred")), F.lit(True)).alias("rejected"),
    )
