"""Each corpus operator against a brute-force version, and on nulls, empty and long texts, repeats and empty tables."""

import collections
import hashlib
import math
import random
import re
import time
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from surveyloom.llm import blocks, components, decontaminate, fertility, language, line_spread, ngram_join, pfair, ppm, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rep string, gram long, text_key long, probabilities string, hit string"
EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "é ñ 漢字"), (6, "word " * 30_000), (6, "word " * 30_000), (None, "a null id stands here"), (7, "same id"), (7, "other text")]


def _docs(spark, rows, parts=3):
    """Rows (doc_id, text[, lang[, source]]) with columns whose names the operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None, "x", 1, 2, "p", "h") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def _texts(seed, n, size=60, words=80):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(words)}{'' if rng.random() < 0.8 else rng.randrange(900)}" for _ in range(rng.randrange(1, size))) for _ in range(n)]


def _words(text, pattern=rb"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").encode().lower())


# 1: fertility -------------------------------------------------------------------------------------------------------

def test_fertility_counts(spark):
    texts = [*_texts(1, 30), "a b c a b c a b", "x #|x\nx #|x\n\n \n \n<&>", "漢 字\r\n漢 字", None, "", "word " * 3000]
    got = {r.doc_id: r for r in fertility.quality(_docs(spark, list(enumerate(texts)))).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        times = collections.Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        covered = {k + j for k in range(len(words) - 2) if times[tuple(words[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 50 or 2 * len(covered) > len(words)) and (not r.base_failed or not r.kept)


def test_fertility_tokens_are_those_of_the_whole_text(spark):
    texts = _texts(2, 5) + ["naïve 漢字 don't  stop\n12,5"]
    files = [(fertility.VOCABULARIES + "/" + f) for f in (fertility.BPE_FILE, fertility.PIECE_FILE)]
    own = fertility.Vocabularies(*(open(f, "rb").read() for f in files))
    got = {r.doc_id: r for r in fertility.measures(_docs(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        tokens = own.bpe.encode_ordinary(" " + " ".join(t.split()))
        counts = np.array(list(collections.Counter(tokens).values())) / len(tokens)
        assert got[i].n_tokens == len(tokens)
        assert got[i].entropy == pytest.approx(-(counts * np.log2(counts)).sum() / math.log2(len(tokens)))


def test_fertility_bands_and_verdicts(spark):
    rng = random.Random(41)
    texts = [(i, " ".join(rng.choice(["hotel", "morning", "the", "of", "window", "people", "river"]) + str(rng.randrange(40)) * (rng.random() < 0.3) for _ in range(rng.randrange(45, 90))), rng.choice(["en", None, "de"])) for i in range(160)]
    texts += [(200, "\u6f22\u5b57\u3042 " * 3 + " ".join("\u9f98" * k for k in range(1, 60)), "en"), (201, " ".join(f"q{k}zxv" for k in range(60)), "en"), (202, "a b " * 40, "en"), (203, None, "en")]
    found = fertility.quality(_docs(spark, texts)).collect()
    width, least = 6.0, fertility.FIGURES
    for lang in ("", "en", "de"):
        own = [r for r in found if r.lang == lang]
        passed = [r for r in own if not r.base_failed]
        ends = {}
        for c in least:
            bins = np.sort(np.floor(np.minimum([r[c] for r in passed], fertility.WIDEST) * fertility.BINS))
            low, middle, high = ((bins[math.ceil(q * len(bins) - 1e-9) - 1] + 0.5) / fertility.BINS for q in (0.16, 0.5, 0.84))
            half = width * max((high - low) / 2, least[c])
            ends[c] = (middle - half, middle + half)
        for r in own:
            inside = ends["chars_per_token"][0] <= r.chars_per_token <= ends["chars_per_token"][1] and r.byte_share <= ends["byte_share"][1] and r.entropy >= ends["entropy"][0]
            assert r.kept == (not r.base_failed and inside)
    verdict = {r.doc_id: (r.base_failed, r.kept) for r in found}
    assert verdict[200] == (False, False) and verdict[202] == (True, False) and verdict[203] == (True, False)
    assert sum(r.kept for r in found) > 100


# 2: toxicity --------------------------------------------------------------------------------------------------------

def test_toxicity_chain_learns_and_uses_the_earlier_category(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = [f"w{rng.randrange(300)}" for _ in range(40)] + (rng.sample(["vile", "scum", "rot"], 2) if bad else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1, int(bad)))
    marks = spark.createDataFrame([x for x in labels if x[0] % 2 == 0] + [(2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    found = toxicity.toxicity(_docs(spark, rows), marks, {"bad": "1 - quality", "toxic": "toxic"})
    assert found.columns.count("probabilities") == 1
    wrong = [r.doc_id for r in found.collect() if (r.probabilities[1] >= 0.5) != (r.doc_id % 4 == 0)]
    assert len(wrong) <= 6


def test_toxicity_chain_of_three_categories(spark):
    """The links against a plain refit: out-of-fold probabilities of every earlier category enter the next one."""
    rng, rows, labels = random.Random(23), [], []
    for i in range(500):
        bad = [rng.random() < 0.3]
        bad += [bad[0] and rng.random() < 0.8, rng.random() < 0.2]
        marks = [w for b, own in zip(bad, (["vile", "scum"], [], ["rot", "muck"]), strict=True) if b for w in own]
        words = [f"w{rng.randrange(200)}" for _ in range(30)] + marks
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, *map(int, bad)))
    marks = spark.createDataFrame(labels + [(3, 1, 1, 1), (4, None, 0, 0)], "doc_id long, a int, b int, c int")
    # Rows that repeat a labelled id do not weigh more: of their texts the smallest counts.
    repeats = [(i, "zzz " * 5) for i in range(0, 500, 7)] * 2
    got = {(r.doc_id, r.text): r.probabilities for r in toxicity.toxicity(_docs(spark, rows + repeats), marks, {"a": "a", "b": "b", "c": "c"}).collect()}
    least = {}
    for i, t in rows + repeats:
        least[i] = min(least.get(i, t), t)
    truth = {i: v for i, *v in labels}
    truth[3] = min(truth[3], [1, 1, 1])
    ids = sorted(truth)
    x = [list(toxicity.features(pa.array([least[i]])))[0] for i in ids]
    y, fold = np.array([truth[i] for i in ids], float), np.array([zlib.crc32(str(i).encode()) % toxicity.FOLDS for i in ids])
    earlier, links = np.zeros((len(ids), 0)), []
    odds = lambda p: np.log(np.clip(p, 1e-4, 1 - 1e-4) / (1 - np.clip(p, 1e-4, 1 - 1e-4)))
    flat = lambda sets: (np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
    for k in range(3):
        outside = np.zeros(len(ids))
        for f in range(toxicity.FOLDS):
            rest, own = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            link = toxicity.fit_link([x[i] for i in rest], earlier[rest], y[rest, k])
            outside[own] = toxicity.predict(link, *flat([x[i] for i in own]), len(own), earlier[own])
        links.append(toxicity.fit_link(x, earlier, y[:, k]))
        earlier = np.column_stack([earlier, odds(outside)])
    assert links[1].earlier[0] > 0.5  # the second category follows from the first alone
    for i, t in rows[::11]:
        before = np.zeros((1, 0))
        own = list(toxicity.features(pa.array([t])))
        for k, link in enumerate(links):
            p = toxicity.predict(link, *flat(own), 1, before)
            assert got[i, t][k] == pytest.approx(p[0], rel=1e-6)
            before = np.column_stack([before, odds(p)])


def test_toxicity_scores_a_batch_a_few_texts_at_a_time(monkeypatch):
    """The features of a whole batch at once, with their weights, took most of the memory of the Python tasks."""
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(i % 60)) for i in range(400)]
    chain = [toxicity.Link(np.sin(np.arange(1 << toxicity.BITS) + k), np.full(k, 0.3), 0.1) for k in range(3)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array([*texts, None])})
    score = lambda: next(toxicity._apply(SimpleNamespace(value=chain), 0)(iter([batch]))).column(1).to_pylist()
    whole, sizes, plain = score(), [], toxicity.predict
    monkeypatch.setattr(toxicity, "SPAN", 200, raising=False)
    monkeypatch.setattr(toxicity, "predict", lambda link, columns, *rest: sizes.append(len(columns)) or plain(link, columns, *rest))
    assert score() == [pytest.approx(p, rel=1e-12) for p in whole] and len(whole) == 401 and max(sizes) <= 200


def test_toxicity_without_labels_and_on_edges(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(_docs(spark, EDGES), none, {"toxic": "toxic"}).collect()
    assert len(got) == len(EDGES) and all(r.probabilities[0] < 1e-9 for r in got)


# 3: language --------------------------------------------------------------------------------------------------------

def _probability(counts, context, symbol, alphabet):
    """Interpolated Kneser-Ney by its recursion, over dictionaries {n-gram: count} by order."""
    order = len(context) + 1
    table = counts[order]
    ones, twos = (sum(c == k for c in table.values()) for k in (1, 2))
    d = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.95)
    same = {g: c for g, c in table.items() if g[:-1] == context}
    lower = 1 / alphabet if order == 1 else _probability(counts, context[1:], symbol, alphabet)
    if not same:
        return lower
    total = sum(same.values())
    return max(same.get((*context, symbol), 0) - d, 0) / total + d * len(same) / total * lower


def test_language_models_are_kneser_ney(spark):
    train = ["abab cab", "bac abba", "cab cab ab"]
    models = language.fit(spark.createDataFrame([("x", t) for t in train], "lang string, text string"))
    grams = collections.Counter()
    for t in train:
        for word in t.split():
            s = (0, 0, 0, *map(ord, word), 0)
            for k in range(3, len(s)):
                c = s[k - 3 : k]
                last = max((j for j, v in enumerate(c) if v == 0), default=-1)
                grams[(*[0] * (last + 1), *c[last + 1 :], s[k])] += 1
    counts = {4: dict(grams)}
    types = dict(grams)
    for order in (3, 2, 1):
        different = collections.Counter(g[1:] for g in types)
        raw = collections.Counter()
        for g, c in grams.items():
            raw[g[4 - order :]] += c
        types = {g: raw[g] if order > 1 and g[0] == 0 else c for g, c in different.items()}
        counts[order] = types
    alphabet = len(counts[1]) + 1
    symbols = np.array([*map(ord, "abz"), 0], np.uint64)
    got = 2 ** models.score(symbols)[:, 0].astype(float)
    contexts = [(0, 0, 0), (0, 0, ord("a")), (0, ord("a"), ord("b")), (ord("a"), ord("b"), ord("z"))]
    want = [_probability(counts, c, int(s), alphabet) for c, s in zip(contexts, symbols, strict=True)]
    assert got == pytest.approx(want, rel=1e-4)


def test_language_held_out_and_edges(spark):
    rng = random.Random(4)
    of = {"aa": "abcde", "bb": "uvwxy"}
    rows = [(i, " ".join("".join(rng.choice(of[lang]) for _ in range(5)) for _ in range(12)), lang) for i in range(80) for lang in [("aa", "bb")[i % 2]]]
    docs = _docs(spark, rows + [(900 + k, t) for k, (_, t) in enumerate(EDGES)] + [(990, "12 34", "aa"), (991, "abc", None)])
    got = {r.doc_id: r for r in language.identify(docs, F.col("doc_id") % 4 == 2).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert [got[i].lang_pred for i in (900, 901, 902, 990)] == ["und"] * 4 and got[900].rejected and got[900].score == 0
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = language.identify(_docs(spark, EDGES), F.lit(True)).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and len(nothing) == len(EDGES)


def test_language_keeps_all_ngrams(spark):
    rng = random.Random(14)
    of = {"aa": "abcde", "bb": "uvwxyab", "cc": "klm"}
    say = lambda lang, n: " ".join("".join(rng.choice(of[lang]) for _ in range(rng.randrange(1, 7))) for _ in range(n))
    rows = [(i, say("aa", 60), "aa") for i in range(60)] + [(100 + i, say("bb", 30), "bb") for i in range(20)] + [(200 + i, say("cc", 3), "cc") for i in range(3)]
    rows += [(300, say("cc", 20), None), (301, "qqq zzz ab", None), (302, None, None), (303, "...", "aa")]
    docs = _docs(spark, rows)
    pick = lambda most: {r.doc_id: r for r in language.identify(docs, F.col("doc_id") % 7 == 2, most=most).collect()}
    whole = pick(1_000_000)
    for most in (0, 100):  # none or some are broadcast
        got = pick(most)
        assert got.keys() == whole.keys() and len(got) == len(rows)
        for i, r in got.items():
            assert (r.lang_pred, r.rejected, r.held_out) == (whole[i].lang_pred, whole[i].rejected, whole[i].held_out)
            assert r.score == pytest.approx(whole[i].score, rel=1e-3)
            assert r.cross_entropy == (whole[i].cross_entropy and pytest.approx(whole[i].cross_entropy, rel=1e-5))
        assert got[300].lang_pred == "cc"  # a language of few and short texts


# 5: mixing ----------------------------------------------------------------------------------------------------------

def test_pfair_schedule_is_edf_and_less_than_a_block_off(spark):
    rng = random.Random(6)
    for _ in range(3):
        sources = [(f"s{i}", rng.randrange(1, 9), rng.randrange(1, 40)) for i in range(6)]
        got = pfair.schedule(spark.createDataFrame(sources, "source string, tickets long, blocks long")).collect()
        done, clock = dict.fromkeys((s for s, _, _ in sources), 0), []
        total = sum(b for _, _, b in sources)
        time_of = lambda v, k: sum(min(b * k, w * v) for _, w, b in sources) / k
        window = {(s, i): (math.floor(time_of(i, w) + 1e-9), math.ceil(time_of(i + 1, w) - 1e-9)) for s, w, b in sources for i in range(b)}
        for slot in range(total):
            ready = [(window[s, done[s]][1], s) for s, _, b in sources if done[s] < b and window[s, done[s]][0] <= slot]
            s = min(ready)[1]
            clock.append((slot, s, done[s]))
            done[s] += 1
        assert sorted((r.slot, r.source, r.block) for r in got) == clock
        assert all(window[r.source, r.block] == (r.release, r.deadline) and r.release <= r.slot < r.deadline for r in got)


def test_mix_places_every_row_in_digest_order(spark):
    rows = [(i, "t", "en", f"s{min(i % 7, 2)}") for i in range(400)] + [(1, "t", "en", "s1"), (None, "t", "en", None)]
    got = pfair.mix(_docs(spark, rows), block_rows=8).collect()
    assert len(got) == len(rows) and len({(r.slot, r.place) for r in got}) == len(rows)
    for source in ("s0", "s1", "s2"):
        own = [r.doc_id for r in sorted(got, key=lambda r: (r.slot, r.place)) if r.source == source]
        assert own == sorted(own, key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
    assert pfair.mix(_docs(spark, EDGES).limit(0)).count() == 0


# 6: lines -----------------------------------------------------------------------------------------------------------

def test_widespread_lines_go(spark):
    rows = [(i, f"own {i} {'body ' * 20}\nAll  rights reserved\nrare {i % 3}", "en", f"s{i % 12}") for i in range(60)]
    rows += [(100, "all rights RESERVED", "en", "s1"), (101, None, "en", None), (102, "", "en", "s2"), (102, "", "en", "s2")]
    got = {r.doc_id: r for r in line_spread.remove_widespread(_docs(spark, rows)).collect()}
    assert got[5].text == f"own 5 {'body ' * 20}\nrare 2" and (got[5].n_lines, got[5].n_removed) == (3, 1)
    assert got[100].text == "" and (got[100].n_spread, got[100].n_removed) == (1, 1)  # it stands once
    assert got[101].text is None and got[102].text == "" and got[102].n_lines == 0
    near = line_spread.widespread(line_spread.lines(_docs(spark, rows)), sites=4).count()  # three lines on 4 sites, one on 12
    assert near == 4


def _cut_lines(rows, sites):
    """Texts without lines on so many sites, by plain code."""
    plain = lambda l: b" ".join(_words(l))
    where = collections.defaultdict(set)
    for _, text, _, source in rows:
        for line in (text or "").split("\n"):
            if plain(line) and source is not None:
                where[plain(line)].add(source)
    times, out = collections.Counter(r[1] for r in rows), []
    for doc, text, _, _ in rows:
        split = [] if text is None else text.split("\n")
        spread = [bool(plain(l)) and len(where[plain(l)]) >= sites for l in split]
        n, hit = sum(bool(plain(l)) for l in split), sum(spread)
        whole = hit == 0 or hit == n and times[text] > 1
        out.append((str(doc), text if whole else "\n".join(l for l, s in zip(split, spread, strict=True) if not s), n, hit, 0 if whole else hit))
    return sorted(out, key=str)


def test_lines_equal_brute_force(spark):
    rng = random.Random(16)
    common = [f"Menu {k}" for k in range(6)] + ["cookie  notice", "Cookie notice"]
    rows = []
    for i in range(150):
        own = [rng.choice(common) if rng.random() < rng.choice([0.1, 0.6, 0.95, 1.0]) else rng.choice([f"line {i}", "", " \t", f"few {i % 20}"]) for _ in range(rng.randrange(1, 9))]
        rows.append((i, "\n".join(own), "en", rng.choice([None, *(f"s{k}" for k in range(14))])))
    rows += [(200 + i, "Menu 1\nMenu 2", "en", f"s{i}") for i in range(3)] + [(300, "Menu 1\nMenu 3\n", "en", "s1"), (301, "Menu 4", "en", "s1"), (301, "Menu 4", "en", "s1"), (None, "Menu 5\nx", "en", "s1")]
    rows += [(i, f"t\n{t}", "en", "s1") for i, t in EDGES if t is not None]
    got = line_spread.remove_widespread(_docs(spark, rows), sites=10).collect()
    assert sorted(((str(r.doc_id), r.text, r.n_lines, r.n_spread, r.n_removed) for r in got), key=str) == _cut_lines(rows, 10)
    assert any(r.n_removed == r.n_lines > 0 for r in got) and any(r.n_spread == r.n_lines > r.n_removed for r in got)


def test_lines_of_a_very_long_document(spark):
    """A document of 100,000 lines, every other one widespread, takes seconds."""
    text = "\n".join(f"own {k}" if k % 2 else f"menu {k % 50}" for k in range(100_000))
    rows = [(1, text, "en", "s0")] + [(2 + i, "\n".join(f"menu {k}" for k in range(0, 50, 2)), "en", f"s{i}") for i in range(12)]
    started = time.time()
    got = {r.doc_id: r for r in line_spread.remove_widespread(_docs(spark, rows)).collect()}
    assert got[1].n_removed == 50_000 and got[1].text == "\n".join(f"own {k}" for k in range(1, 100_000, 2)) and got[3].n_removed == 0
    assert time.time() - started < 60


# 7: pages -----------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def network():
    texts = _texts(7, 40, size=40)
    return blocks.fit(["<article>" + "".join(f"<p>{t}</p>" for t in texts) + "</article>"], layouts=500)


def test_block_network_on_unseen_layouts(network):
    rng = np.random.default_rng(123)
    texts = _texts(8, 40, size=40)
    right = total = 0
    for _ in range(80):
        page, known = blocks.layout(rng, texts, " ".join(texts).split())
        found = blocks.cut(page)
        assert [b.text for b in found] == [t for t, _ in known]
        kept = blocks.label(network, [blocks.describe(found)])[0]
        right, total = right + int((kept == np.array([m for _, m in known])).sum()), total + len(known)
    assert right > 0.93 * total


def _texts_of(page):
    return [b.text for b in blocks.cut(page)]


def test_block_cutting():
    page = "<body><script>var a='</p><p>x';</script><p>a &amp;amp;\n b<b>c</b><p>d<!-- <p>no --><div>e<br>f</div>tail <"
    assert _texts_of(page) == ["a &amp; bc", "d", "e f", "tail <"]
    assert blocks.cut(None) == [] and blocks.cut("") == [] and len(blocks.cut("<p>x" * 5000)) == 5000
    assert _texts_of("<p>foo<script>x</script>bar <svg><title>no</title></svg>z</p>") == ["foobar z"]
    assert _texts_of("<p>a <math><mi>x</mi></math> <noscript>b</noscript><object>c</object></p>") == ["a x bc"]
    assert _texts_of("<ul><li>a<div>b<li>c<ul><li>d</ul>e</ul><table><tr><td>f<td>g<tr><td>h</table>i") == list("abcdefghi")
    assert _texts_of("<p>a<svg>b<p>c") == ["ab", "c"]  # a hidden element that never ends hides nothing


def test_block_paths_and_links():
    open_inline = "".join(f"<i class=x{k}>" for k in range(60))
    found = blocks.cut(f"<article><nav>{open_inline}menu</nav><p>text <a href=/>link <b><i><u><s>deep</a> end</p><div class='ad box'>buy</div></article><p>out")
    assert [b.article for b in found] == [False, True, False, None]
    bit = lambda b, name: b.path >> blocks._slot(name, blocks.PATH_SIZE) & 1
    assert bit(found[0], "nav") and bit(found[0], "x59") and not bit(found[1], "nav") and bit(found[1], "article") and bit(found[2], "box")
    assert [b.linked for b in found] == [0, len("link") + len("deep"), 0, 0]
    assert blocks.describe(found).shape == (4, blocks.INPUT)


def test_all_words_and_marks_count():
    base = " ".join(["word"] * 400)
    first, second = (blocks.describe(blocks.cut(f"<p>{a}</p>"))[0] for a in (base, base.replace("word", "other. ©", 201).replace("other. ©", "word", 200)))
    slot = blocks.PATH_SIZE + blocks._slot("other", blocks.WORD_SIZE)
    assert second[slot] - first[slot] == pytest.approx(1 / 401, abs=1e-4) and second[-5] > first[-5] and second[-4] == 1 and first[-4] == 0


def test_block_cutting_takes_linear_time():
    for page in ('<a href="' * 110_000, "<p class='" + "x " * 500_000, "<div>a" * 60_000, "<b>" * 60_000 + "<p>" + "</b>x<i>" * 60_000, "<div>" * 30_000 + "<li>x</li>" * 30_000, "<svg>" * 100_000, "</p" * 300_000):
        started = time.time()
        found = blocks.cut(page)
        blocks.describe(found[:2000])
        assert time.time() - started < 10, page[:20]


#: Pages written by hand, not by ``layout``: blocks of the main text, and those of other parts.
HAND = [
    ("""<html><head><title>T</title></head><body><div id="masthead"><h1>The Daily</h1></div><ul class="menu"><li><a href=/>Home</a><li><a href=/n>News</a></ul>
<div class="post"><h2>{0}</h2><p>{1}<p>{2}<blockquote>{3}</blockquote></div><div class="sidebar"><h3>Popular</h3><a href=/1>One</a></div>
<div id="footer">© 2020 The Daily. All rights reserved.</div></body></html>""", 4),
    ("""<body><div class="cookie-banner">We use cookies. <button>Accept</button></div><nav><a href=/>Start</a> | <a href=/b>Blog</a></nav>
<main><article><header class=ad>Sponsored content</header><h1>{0}</h1><p>{1}</p><ul><li>{2}</li></ul><p>{3}</p></article></main>
<section id="comments"><h2>Comments</h2><div class="comment"><p>Nice words, thanks.</p></div></section><footer><p>Contact</p></footer>""", 4),
    ("""<header><a href="/">Logo</a></header><form class=search><label>Search</label><input></form><div role=main><div class="entry-content"><p>{0}</p><p>{1}</p><pre>{2}</pre></div></div>
<aside><h3>Related</h3><ul><li><a href=/x>Other</a></ul></aside>""", 3),
]


def test_hand_written_pages(network):
    texts = [t for t in _texts(19, 40, size=60) if len(t.split()) > 12]
    right = total = 0
    for page, n in HAND:
        for k in range(0, 24, 4):
            own = texts[k % 20 : k % 20 + n]
            found = blocks.cut(page.format(*own))
            kept = blocks.label(network, [blocks.describe(found)])[0]
            main = np.array([b.text in own for b in found])
            assert main.sum() == n
            right, total = right + int((kept == main).sum()), total + len(found)
    assert right > 0.85 * total


def test_main_text_edges(spark):
    pages = spark.createDataFrame([(1, "u", None, 1), (2, None, "", 2), (3, "u", "<article><p>some words here</p></article>", 3), (3, "u", "<article><p>some words here</p></article>", 3)], "page_id long, url string, html string, text long")
    got = blocks.main_text(pages, layouts=60).collect()
    assert blocks.main_text(pages.limit(0), layouts=60).collect() == []
    assert len(got) == 4 and all(r.n_chars == len(r.text) for r in got) and {r.text for r in got if r.page_id < 3} == {""}


# 8: benchmark -------------------------------------------------------------------------------------------------------

def test_contamination(spark):
    pattern = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    items = [(i, t) for i, t in enumerate(_texts(9, 12, size=30))] + [(50, "Short item"), (51, None), (52, "...")]
    rng, rows = random.Random(10), []
    for i, t in enumerate(_texts(11, 60)):
        extra = rng.choice(items)[1] or ""
        rows.append((i, t + " " + (extra.upper().replace(" ", ", ") if i % 3 == 0 else "") + " tail"))
    rows += [(200 + k, t) for k, (_, t) in enumerate(EDGES)] + [(0, rows[0][1])]
    windows = collections.defaultdict(set)
    for item, t in items:
        w = _words(t, pattern)
        n = min(13, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[p : p + n])].add(item)
    got = decontaminate.contamination(_docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows)
    by = {r.doc_id: r for r in got}
    for doc, t in rows:
        w, hit, own = _words(t, pattern), set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if found := windows.get(tuple(w[p : p + n])):
                    hit.update(range(p, p + n))
                    own |= found
        r = by[doc]
        assert (r.n_words, r.n_hit, r.n_items) == (len(w), len(hit), len(own))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(map(str, own))).encode()).hexdigest()
        assert r.contaminated == (bool(hit) and 20 * len(hit) >= len(w))


def test_contamination_without_broadcast_and_without_items(spark, monkeypatch):
    docs, items = _docs(spark, [(1, "a b c"), (None, "x y"), (2, None)]), spark.createDataFrame([(1, "b C")], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", 0)
    assert {r.doc_id: r.n_hit for r in decontaminate.contamination(docs, items).collect()} == {1: 2, None: 0, 2: 0}
    assert decontaminate.contamination(docs, items.limit(0)).where("contaminated").count() == 0
    assert sorted(r.doc_id or 0 for r in decontaminate.remove_contaminated(docs, items).collect()) == [0, 2]


# 9: join ------------------------------------------------------------------------------------------------------------

def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 90), (100, 95), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {v for k, v in got.items() if k <= 60} == {1} and {got[k] for k in (90, 95, 100)} == {90} and len(got) == 63


def test_overlaps_are_intersections():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, 80).astype(np.uint64)) for _ in range(9)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    off = ~np.eye(len(sets), dtype=bool)
    assert (ngram_join.overlaps(sets, width=32)[off] == want[off]).all()


@pytest.mark.parametrize(("words", "num", "den"), [(3, 9, 10), (5, 4, 5)])
def test_join_equals_brute_force(spark, monkeypatch, words, num, den):
    monkeypatch.setattr(ngram_join, "DENSE_ROWS", 8)
    monkeypatch.setattr(ngram_join, "SPARSE_ROWS", 8)
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", 4)
    rng, texts = random.Random(12), []
    for base in range(6):
        own = [f"b{base}x{k}" for k in range(rng.randrange(30, 120))]
        for _ in range(25):
            copy = list(own)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    rows = list(enumerate(texts + ["", None, "a", "A", "a b"])) + [(500, texts[0].upper()), (500, texts[0].upper()), (None, texts[0])]
    rows += [(600, texts[30]), (600, texts[60])]
    got = ngram_join.jaccard_components(_docs(spark, rows), words, num, den).collect()
    assert len(got) == len(rows)
    sets = []
    for _, t in rows:
        w = _words(t)
        sets.append({tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    union = ngram_join.Union(1000)
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and rows[i][0] is not None and rows[j][0] is not None and den * both >= num * (len(a) + len(sets[j]) - both):
                union.join(rows[i][0], rows[j][0])
    want = {(i, len(s), None if i is None else union.find(i)) for (i, _), s in zip(rows, sets, strict=True)}
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == want


# 10: scoring --------------------------------------------------------------------------------------------------------

def _ppm(counts, order, context, symbol):
    """Probability by the recursion with escapes and exclusion, over {context: Counter}."""
    p, known = 1.0, set()
    for k in range(min(order, len(context)), -1, -1):
        seen = counts.get(context[len(context) - k :])
        if not seen:
            continue
        rest = {s: n for s, n in seen.items() if s not in known}
        if not rest:
            continue
        total = sum(rest.values()) + len(rest)
        if symbol in rest:
            return p * rest[symbol] / total
        p *= len(rest) / total
        known |= set(rest)
    return p / max(1, 256 - len(known))


def test_ppm_equals_the_recursion(spark, monkeypatch):
    monkeypatch.setattr(ppm, "MOST_WORDS", 20)
    rows = [(i, t) for i, t in enumerate(_texts(13, 40, size=25))] + [(300, "Ünseen Bytes\n"), (301, None), (302, ""), (302, "")]
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2} | {300}
    docs = _docs(spark, rows)
    got = ppm.score_documents(docs, (F.crc32(F.col("doc_id").cast("string")) % 7 == 2) | (F.col("doc_id") == 300)).collect()
    assert len(got) == len(rows)
    counts, tokens = collections.defaultdict(collections.Counter), collections.Counter()
    pad = bytes([ppm.END]) * ppm.ORDER
    for i, t in rows:
        if i not in held:
            tokens.update([*_words(t), None])
            s = pad + (t or "").encode().lower() + b"\xff"
            for k in range(ppm.ORDER, len(s)):
                for n in range(ppm.ORDER + 1):
                    counts[s[k - n : k]][s[k]] += 1
    total, distinct = sum(tokens.values()), len(tokens)
    text = dict(rows)
    for r in got:
        s = pad + (text[r.doc_id] or "").encode().lower() + b"\xff"
        want = sum(math.log10(_ppm(counts, ppm.ORDER, s[k - ppm.ORDER : k], s[k])) for k in range(ppm.ORDER, len(s)))
        own = [*_words(text[r.doc_id]), None]
        assert r.score == pytest.approx(want, rel=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(tokens[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(sum(math.log10((tokens[w] + 1) / (total + distinct + 1)) for w in own))


def test_ppm_without_training(spark):
    got = ppm.score_documents(_docs(spark, [(1, "ab")]), F.lit(True)).collect()[0]
    assert got.score == pytest.approx(3 * math.log10(1 / 256)) and (got.n_tokens, got.n_known, got.train_tokens) == (2, 0, 0)


def test_ppm_keeps_all_contexts(spark, monkeypatch):
    texts = [*_texts(31, 40), *(t.upper() + " \u00e9\u00e8 {};" for t in _texts(32, 4)), "zq" * 30, None, "", "\u6f22\u5b57 never seen before"]
    docs = _docs(spark, list(enumerate(texts)))
    pick = lambda: {r.doc_id: r.score for r in ppm.score_documents(docs, (F.col("doc_id") % 5 == 2) | (F.col("doc_id") == 47)).collect()}
    whole = pick()
    for most in (1, 300):  # contexts that are not broadcast predict all the same
        monkeypatch.setattr(ppm, "MOST_NODES", most)
        got = pick()
        assert got.keys() == whole.keys() and all(got[i] == pytest.approx(whole[i], rel=1e-11) for i in got)


def test_ppm_asks_for_a_code_once_per_chunk(spark, monkeypatch):
    # A large trie does not pass through the driver, and copies of a text add no rows to what is joined with it.
    texts = [*_texts(33, 6), *["the same text, over and over {}"] * 60, None, "never seen \u6f22"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    held = (F.col("doc_id") % 5 == 2) | (F.col("doc_id") == len(texts) - 1)
    pick = lambda: {r.doc_id: r.score for r in ppm.score_documents(docs, held).collect()}
    whole, kept, taken = pick(), {}, []
    stored, to_arrow = ppm.stored, type(docs).toArrow
    monkeypatch.setattr(ppm, "MOST_NODES", 1)
    monkeypatch.setattr(ppm, "CHUNK_BYTES", 600)  # several chunks
    monkeypatch.setattr(ppm, "stored", lambda df, label, *a, **b: kept.setdefault(label, stored(df, label, *a, **b)) if label == "ppm-asked" else stored(df, label, *a, **b))
    monkeypatch.setattr(type(docs), "toArrow", lambda df: taken.append(df.columns) or to_arrow(df))
    got = pick()
    assert all(got[i] == pytest.approx(whole[i], rel=1e-11) for i in whole) and got.keys() == whole.keys()
    assert taken == [["word", "n"]]  # of a trie nothing
    rows = kept["ppm-asked"].where("kind = 1").select("chunk", "code").collect()
    chunks = {r.chunk for r in rows}
    pad = bytes([ppm.END]) * ppm.ORDER
    streams = [pad + (t or "").encode().lower() + b"\xff" for t in texts]
    codes = {s[k - ppm.ORDER : k + 1] for s in streams for k in range(ppm.ORDER, len(s))}
    assert len(chunks) > 3 and len(rows) == len(set(rows)) and len({r.code for r in rows}) == len(codes)
    every = sum(len({s[k - ppm.ORDER : k + 1] for k in range(ppm.ORDER, len(s))}) for s in streams)
    assert len(rows) < every / 2


# all ----------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("rows", [EDGES, []], ids=["edges", "empty"])
def test_edges_give_a_row_each(spark, rows):
    docs = _docs(spark, rows)
    never = F.lit(False)
    marks = spark.createDataFrame([(4, 0, 1)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert fertility.quality(docs).count() == len(rows)
    assert toxicity.toxicity(docs, marks, {"toxic": "toxic"}).count() == len(rows)
    assert language.identify(docs, never).count() == len(rows)
    assert pfair.mix(docs).count() == len(rows)
    assert line_spread.remove_widespread(docs).count() == len(rows)
    assert decontaminate.contamination(docs, items).count() == len(rows)
    assert ngram_join.jaccard_components(docs).count() == len(rows)
    assert ppm.score_documents(docs, never).count() == len(rows)
