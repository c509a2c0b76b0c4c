"""Transcripts against a plain Viterbi over all lines, with small chunks, and against the turns they were made of."""

import random
import re

import numpy as np
import pytest

from surveyloom.llm import queries, transcripts

SCHEMA = "conv_id long, turn long, role string, text string, place string, chunk long, kind int, state string, conv string"


def _turns(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "p", 1, 2, "s", "c") for r in rows], SCHEMA).repartition(parts)


def _conversations(seed, n=14):
    rng, rows = random.Random(seed), []
    say = lambda size, end: " ".join(f"w{rng.randrange(50)}" for _ in range(size)) + end
    for c in range(n):
        for t in range(rng.choice([1, 3, 6, 40 if c == 0 else 9])):
            user = t % 2 == 0
            rows.append((c, t, "user" if user else "assistant", "\n".join(say(rng.randrange(3, 8 if user else 60), "?" if user else ".") for _ in range(1 if user else rng.randrange(1, 5)))))
    return rows


MARK = re.compile(r"^\s*(?:\*\*|#+ ?)?[\[<]?(%s)(?:[\]>]:?|(?:\*\*)?\s*:(?:\*\*)?)\s*" % "|".join(sorted((m for of in transcripts.MARKERS.values() for m in of), key=len, reverse=True)), re.IGNORECASE)


def _plain(model, texts):
    """(role, begins, line) of every line of a transcript given as the texts of its rows, by Viterbi over the whole."""
    marks, kinds, shown = [], [], []
    for text in texts:
        for at, line in enumerate((text or "").split("\n")):
            found = MARK.match(line)
            mark = next((i for i, r in enumerate(transcripts.ROLES) if found and found.group(1).lower() in transcripts.MARKERS[r]), -1)
            line = line[found.end() :] if mark >= 0 else line
            marks.append(mark)
            kinds.append((8 if at == 0 or mark >= 0 else 0) + 2 * sum(len(line) > n for n in transcripts.LENGTHS) + bool(re.search(r"\?\s*$", line)))
            shown.append(line)
    e = model.emissions(np.array(marks), np.array(kinds))
    score, back = model.start + e[0], []
    for row in e[1:]:
        ways = score[:, None] + model.step
        back.append(ways.argmax(0))
        score = ways.max(0) + row
    path = [int(score.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return [(transcripts.ROLES[s // 2], s % 2 == 1 or i == 0, line) for i, (s, line) in enumerate(zip(path[::-1], shown, strict=True))]


def _turns_of(lines):
    out = []
    for place, (role, begins, line) in enumerate(lines):
        if begins:
            out.append([place, role, []])
        out[-1][2].append(line)
    return [(place, role, len(own), f"<|{role}|>\n" + "\n".join(own).strip(" ") + "\n<|end|>") for place, role, own in out]


@pytest.mark.parametrize("sizes", [None, (4, 3, 2)], ids=["whole", "small chunks"])
def test_lines_and_turns_equal_one_viterbi(spark, monkeypatch, sizes):
    if sizes:
        for name, value in zip(("CHUNK_LINES", "FAN", "GROUP_CHUNKS"), sizes, strict=True):
            monkeypatch.setattr(transcripts, name, value)
    rows = _conversations(5)
    model = transcripts.fit(_turns(spark, rows))
    # Rows with several marked and unmarked lines, without markers, and one turn that goes on over many chunks.
    mixed = [(c, t, None, text) for c, t, _, text in rows if c < 6] + [(20, 0, None, "User: hello?\nAssistant: hi there\nand more\nUser: bye"), (20, 1, None, "**Bot**: x\n[user] y\n# System: z\nnote: no marker")]
    mixed += [(21, 0, None, "Assistant: " + "\n".join(f"line {k} " + "long " * 30 for k in range(90))), (22, None, None, None), (22, 3, None, "Human: a\n\nb"), (None, 0, None, "AI: b")]
    lines = transcripts.line_roles(_turns(spark, mixed), model).collect()
    turns = transcripts.parse(_turns(spark, mixed), model).collect()
    for conv in {c for c, *_ in mixed}:
        texts = [x for _, _, x in sorted((t if t is not None else -1, i, x) for i, (c, t, _, x) in enumerate(mixed) if c == conv)]
        want = _plain(model, texts)
        got = sorted((r for r in lines if r.conv_id == conv), key=lambda r: r.place)
        assert [(r.role, r.begins, r.plain) for r in got] == want and [r.place for r in got] == list(range(len(want)))
        assert sorted((r.place, r.role, r.n_lines, r.rendered) for r in turns if r.conv_id == conv) == _turns_of(want)
    said = sorted((r.place, r.role, r.rendered) for r in turns if r.conv_id == 20)
    assert [r for _, r, _ in said] == ["user", "assistant", "user", "assistant", "user", "system"] and said[1][2] == "<|assistant|>\nhi there\nand more\n<|end|>"
    assert [(r.n_lines, r.turn, r.at) for r in turns if r.conv_id == 21] == [(90, 0, 0)]
    assert sorted((r.turn, r.at) for r in turns if r.conv_id == 20) == [(0, 0), (0, 1), (0, 3), (1, 0), (1, 1), (1, 2)]


def test_rendered_transcripts_are_recovered(spark):
    rows = _conversations(9, 30)
    turns = _turns(spark, rows)
    texts = transcripts.rendered_transcripts(turns, {"user": "User", "assistant": "Assistant"}, rows=3)
    assert texts.where("conv_id = 0").count() < len([r for r in rows if r[0] == 0])
    got = transcripts.parse(texts, transcripts.fit(turns)).collect()
    want = sorted((c, role, f"<|{role}|>\n{text}\n<|end|>") for c, _, role, text in rows)
    assert sorted((r.conv_id, r.role, r.rendered) for r in got) == want


def test_edges(spark):
    model = transcripts.fit(_turns(spark, [(1, 0, "user", "a"), (1, 1, "assistant", "b\nc")]))
    assert transcripts.parse(_turns(spark, []), model).count() == 0
    none = transcripts.fit(_turns(spark, []))
    same = [(3, 1, None, "User: q\nAssistant: r")] * 3 + [(None, None, None, None), (None, None, None, "[bot] x"), (4, 0, None, "word " * 40_000)]
    for m in (model, none):
        got = transcripts.parse(_turns(spark, same), m).collect()
        assert [r.rendered for r in sorted((r for r in got if r.conv_id == 3), key=lambda r: r.place)] == ["<|user|>\nq\n<|end|>", "<|assistant|>\nr\n<|end|>"] * 3
        assert sum(r.n_lines for r in got if r.conv_id is None) == 2 and sum(r.n_lines for r in got if r.conv_id == 4) == 1


def test_query_parses_rows_and_texts(spark):
    got = queries.op4_transcripts(spark, "/root/testdata/sf0.001").collect()
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    for form in ("rows", "texts"):
        assert {r.conv_id for r in got if r.form == form} == {t.conv_id for t in turns}
    right = {(t.conv_id, f"<|{t.role}|>\n{t.text.strip(' ')}\n<|end|>") for t in turns}
    assert sum((r.conv_id, r.rendered) in right for r in got if r.form == "texts") > 0.99 * len(turns)
    assert sum((r.conv_id, r.rendered) in right for r in got if r.form == "rows") > 0.8 * len(turns)  # without markers, and few to learn from
