"""The manifest against a plain tree, with proofs that are folded by hand."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from surveyloom.llm import columns, manifest, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, tree string, id string"
H = lambda x: hashlib.sha256(x.encode()).hexdigest()


def _leaf(doc, source, lang, n, text):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def _runs(nodes):
    """Levels of runs up to the last single node."""
    out = []
    while len(nodes) > 1:
        out.append([nodes[i : i + 8] for i in range(0, len(nodes), 8)])
        nodes = [H("".join(run)) for run in out[-1]]
    return out, (nodes[0] if nodes else None)


def _brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded) of (doc_id, text, lang, source, n_chars), as a sorted list."""
    groups = {}
    for doc, text, lang, source, n in rows:
        lower = None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        tampered = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0
        leaf = _leaf(doc, source, lang, n, text)
        groups.setdefault((lang is not None, (lang or "").encode()), []).append((doc is not None, doc or 0, leaf, _leaf(doc, source, lang, n, lower) if tampered else leaf, doc))
    trees = [_runs([x[2] for x in sorted(groups[g])]) for g in sorted(groups)]
    forest, root = _runs([t for _, t in trees])
    out = []
    for rank, g in enumerate(sorted(groups)):
        own, subroot = trees[rank]
        for i, (_, _, leaf, cur, doc) in enumerate(sorted(groups[g])):
            proof = []
            for levels, at in ((own, i), (forest, rank)):
                for runs in levels:
                    run, place = runs[at // 8], at % 8
                    proof += run[:place] + run[place + 1 :]
                    cur, at = H("".join([*run[:place], cur, *run[place + 1 :]])), at // 8
            out.append((str(doc), leaf, subroot, root, "".join(proof), cur))
    return sorted(out)


def _found(spark, rows):
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    leaf = lambda text: manifest.leaf_digest([F.col(c) for c in ("doc_id", "source", "lang", "n_chars")] + [text])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf(columns.lower_ascii(F.col("text"))))
    return manifest.manifest(docs, leaf(F.col("text")), tampered).collect()


@pytest.mark.parametrize(("levels", "langs"), [(4, 3), (1, 3), (2, 11), (1, 70)])
def test_equals_a_plain_tree(spark, monkeypatch, levels, langs):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    rng = random.Random(levels * 100 + langs)
    rows = [(i, rng.choice(["Text ", "text", "É Ñ", "", None]), f"l{rng.randrange(langs)}", rng.choice(["s", None]), rng.choice([1, None])) for i in range(200)]
    # One group with more than half of all rows; repeated rows and ids, a null id, a null and an empty group, groups of one.
    rows += [(1000 + i, f"Hot {i}", "hot", "s", i) for i in range(530)]
    rows += [(5, "same", "hot", None, None)] * 3 + [(5, "other", "hot", None, None), (None, "Null id", "hot", None, None), (2**60 + 1, "Large id", "hot", None, None), (None, None, None, None, None), (7, "X", "", "s", 1)]
    rows += [(8, "A", "z", "s", 1), (9, "B", "ZZ", "s", 1), (10, "Long " * 50_000, "é", "s", 1), (11, "B", "\U0001f600", "s", 1), (12, "B", "￮", "s", 1)]
    got = _found(spark, rows)
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof, r.folded_root) for r in got) == _brute(rows)
    for r in got[::37]:  # a proof is enough to reach the root from the leaf
        node, at = r.leaf, 0
        for place, size in zip(r.places, r.sizes, strict=True):
            rest = r.proof[at : at + 64 * (size - 1)]
            node, at = H(rest[: 64 * place] + node + rest[64 * place :]), at + len(rest)
        assert node == r.root and at == len(r.proof)


@pytest.mark.parametrize("rows", [[], [(3, "A", None, None, None)], [(3, "A", "en", "s", 1), (3, "A", "en", "s", 1)], [(i, "T", "en", "s", 1) for i in range(9)]])
def test_small_tables(spark, rows):
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof, r.folded_root) for r in _found(spark, rows)) == _brute(rows)


def test_query_derives_digests(spark):
    got = queries.op12_merkle_manifest(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = got.collect()
    assert {r.verified for r in rows} == {True, False} and len({r.root for r in rows}) == 1
    assert all(r.verified == (r.folded_root == r.root) for r in rows)
