"""Quality rules on tokeniser fertility, after counting rules on words and lines.

A text is split into words ``[^\\x20\\x09-\\x0D]+``, and its words joined by single spaces go through two public
vocabularies: characters per token and the entropy of the token distribution come from a byte-level BPE, the share of
byte tokens from a BPE with byte fallback. Both cut at spaces, so each different word is encoded once per slice.
A text is rejected if a figure lies outside the band of its language: the median of all texts that pass the counting
rules, plus or minus ``width`` times half the distance between the 16 % and 84 % quantiles.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.llm.tokens import NEWLINE, SPACES, chain, mix, slices
from surveyloom.session import stored

VOCABULARIES = "/opt/tokenizers"
BPE_FILE, PIECE_FILE = "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"
SLICE_BYTES = 1 << 21
#: Words kept encoded between slices of a task.
MOST_CACHED = 200_000
#: The split pattern that belongs to the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
CONTINUATION = np.zeros(256, bool)
CONTINUATION[0x80:0xC0] = True


class Vocabularies:
    def __init__(self, bpe: bytes, piece: bytes):
        import sentencepiece
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in bpe.splitlines() if line)}
        self.bpe = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.piece = sentencepiece.SentencePieceProcessor(model_proto=piece)
        self.is_byte = np.array([self.piece.is_byte(i) for i in range(self.piece.vocab_size())])
        self.cache: dict[int, tuple[list[int], int, int]] = {}

    def words(self, hashes: np.ndarray, texts) -> list[tuple[list[int], int, int]]:
        """Per word: its byte-level tokens, and the numbers of pieces and of byte pieces. ``texts``: word by position."""
        if len(self.cache) > MOST_CACHED:
            self.cache.clear()
        out = [self.cache.get(h) for h in hashes.tolist()]
        new = [i for i, x in enumerate(out) if x is None]
        spelled = [texts(i) for i in new]
        for i, word, pieces in zip(new, spelled, self.piece.encode(spelled, num_threads=1) if new else [], strict=True):
            bytes_ = int(self.is_byte[pieces].sum()) if pieces else 0
            out[i] = self.cache[int(hashes[i])] = (self.bpe.encode_ordinary(" " + word), len(pieces), bytes_)
        return out


_loaded: tuple | None = None


def _vocabularies(files) -> Vocabularies:
    global _loaded
    tag = tuple(zlib.crc32(f) for f in files.value)
    if _loaded is None or _loaded[0] != tag:
        _loaded = (tag, Vocabularies(*files.value))
    return _loaded[1]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _rows(bounds: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "chars_per_token", "byte_share", "entropy"]


def _measure(files):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = _vocabularies(files)
        for batch in batches:
            if not batch.num_rows:
                continue
            out: dict[str, list] = {name: [] for name in COLUMNS}
            for part in slices(batch.column(2), lower=False, size=SLICE_BYTES):
                start, end, bounds = part.spans(SPACES)
                hashes, row, count = part.hashes(start, end), _rows(bounds), len(part)
                words = np.diff(bounds)
                chars = part.counts(~(SPACES | CONTINUATION))
                out["n_words"].append(words)
                out["word_chars"].append(chars)
                out["n_symbols"].append(part.counts(SYMBOLS))

                line_start, line_end, lines = part.spans(NEWLINE)
                holds = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
                line_row = _rows(lines)[holds]
                line = mix(part.hashes(line_start[holds], line_end[holds]) + line_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                first = np.unique(line, return_index=True)[1]
                out["n_dup_lines"].append(np.bincount(line_row, minlength=count) - np.bincount(line_row[first], minlength=count))

                runs = chain(hashes, 3)
                inside = row[: len(runs)] == row[2:] if len(runs) else np.zeros(0, bool)
                at = np.flatnonzero(inside)
                own = mix(runs[at] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                _, which, times = np.unique(own, return_inverse=True, return_counts=True)
                twice = at[times[which] > 1] if len(at) else at
                cover = np.zeros(len(hashes) + 4, np.int64)
                np.add.at(cover, twice, 1)
                np.add.at(cover, twice + 3, -1)
                out["n_repeat_words"].append(_sums(np.cumsum(cover)[: len(hashes)] > 0, bounds))

                distinct, where, which = np.unique(hashes, return_index=True, return_inverse=True)
                data = part.data.tobytes()
                spelled = vocabularies.words(distinct, lambda i: data[start[where[i]] : end[where[i]]].decode("utf-8", "replace"))
                sizes = np.array([len(t) for t, _, _ in spelled], np.int64)
                pieces, byte_pieces = (np.array([s[k] for s in spelled], np.int64) for k in (1, 2))
                flat = np.fromiter((t for s in spelled for t in s[0]), np.int64, int(sizes.sum()))
                offset = np.concatenate([[0], np.cumsum(sizes)])
                size = sizes[which] if len(which) else sizes
                ends = np.cumsum(size)
                tokens = flat[np.repeat(offset[:-1][which] - (ends - size), size) + np.arange(int(size.sum()))] if len(which) else flat
                n_tokens = _sums(size, bounds)
                key = np.sort((np.repeat(row, size) << 17) | tokens)
                cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
                n = np.diff(np.r_[cuts, len(key)]).astype(float)
                weighted = np.bincount(key[cuts] >> 17, weights=n * np.log2(n), minlength=count) if len(cuts) else np.zeros(count)
                with np.errstate(divide="ignore", invalid="ignore"):
                    bits = np.log2(n_tokens) - weighted / n_tokens
                    out["entropy"].append(np.where(n_tokens > 1, bits / np.log2(n_tokens), 0.0))
                    out["chars_per_token"].append(np.where(n_tokens > 0, (chars + words - 1) / n_tokens, 0.0))
                    all_pieces = _sums(pieces[which], bounds)
                    out["byte_share"].append(np.where(all_pieces > 0, _sums(byte_pieces[which], bounds) / all_pieces, 0.0))
                out["n_tokens"].append(n_tokens)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(np.concatenate(out[c])) for c in COLUMNS)], ["doc_id", "lang", *COLUMNS])

    return measure


def measures(docs: DataFrame, vocabularies: str = VOCABULARIES, id_col: str = "doc_id", text_col: str = "text", group_col: str = "lang") -> DataFrame:
    """The figures of each text. The vocabulary files, of a few MB, go to the tasks with the driver's broadcast."""
    files = docs.sparkSession.sparkContext.broadcast(tuple(Path(vocabularies, f).read_bytes() for f in (BPE_FILE, PIECE_FILE)))
    given = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(group_col).cast("string"), F.lit("")).alias("lang"), F.col(text_col).alias("text"))
    whole = ", ".join(f"{c} long" for c in COLUMNS[:6])
    schema = f"doc_id {given.schema['doc_id'].dataType.simpleString()}, lang string, {whole}, chars_per_token double, byte_share double, entropy double"
    return given.mapInArrow(_measure(files), schema)


#: Figures and the least half width of their bands: a figure that hardly varies gets a band of some width all the same.
FIGURES = {"chars_per_token": 0.05, "byte_share": 0.01, "entropy": 0.02}
#: Bins of a figure per unit, and the largest value that has a bin of its own.
BINS, WIDEST = 10_000, 100


def bands(found: DataFrame, width: float = 6.0) -> DataFrame:
    """Per language, the band of each figure: lang, and its lower and upper end (``_low``, ``_high``).

    The quantiles are those of all rows, counted in bins, so they do not depend on how the rows were dealt.
    """
    values = F.array(*[F.struct(F.lit(c).alias("figure"), F.col(c).alias("value")) for c in FIGURES])
    flat = found.select("lang", F.inline(values)).withColumn("bin", F.floor(F.least(F.col("value"), F.lit(WIDEST)) * BINS))
    counted = flat.groupBy("lang", "figure", "bin").agg(F.count("*").alias("n"))
    # A language has at most ``BINS * WIDEST`` bins of a figure.
    each = Window.partitionBy("lang", "figure")
    upto = counted.withColumns({"upto": F.sum("n").over(each.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("n").over(each)})
    quantile = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), (F.col("bin") + 0.5) / BINS))
    found = upto.groupBy("lang", "figure").agg(quantile(0.16).alias("low"), quantile(0.5).alias("middle"), quantile(0.84).alias("high"))
    ends = []
    for c, least in FIGURES.items():
        half = width * F.greatest((F.col("high") - F.col("low")) / 2, F.lit(least))
        own = F.col("figure") == c
        ends += [F.max(F.when(own, F.col("middle") - half)).alias(f"{c}_low"), F.max(F.when(own, F.col("middle") + half)).alias(f"{c}_high")]
    return found.groupBy("lang").agg(*ends)


def quality(docs: DataFrame, width: float = 6.0, **options) -> DataFrame:
    """Figures and verdict per row of ``docs``: ``base_failed`` and ``kept``, after the figures of ``measures``.

    A null or blank text has no words and fails the counting rules. A null language is a language of its own. Repeated
    rows are judged each for itself, and each counts for the bands. Other columns are ignored.
    """
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    found = stored(measures(docs, **options).withColumn("base_failed", failed), "fertility")
    # A table of known size: with few languages Spark sends it to the tasks, and no language meets in one of them.
    judged = found.join(stored(bands(found.where("not base_failed"), width), "fertility-bands"), "lang", "left")
    inside = F.expr("chars_per_token between chars_per_token_low and chars_per_token_high and byte_share <= byte_share_high and entropy >= entropy_low")
    return judged.withColumn("kept", F.coalesce(~F.col("base_failed") & inside, F.lit(False))).select("doc_id", "lang", *COLUMNS, "base_failed", "kept")
