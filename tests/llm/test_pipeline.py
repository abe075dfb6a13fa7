"""The corpus pipeline against a brute-force version of its stages."""

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from couchlog.llm import quality
from couchlog.llm.words import utf8
from tests.llm.tables import documents, write
from tests.llm.test_dedup import NO_ID, brute_groups, ranked


def corpus():
    rng = random.Random(11)
    words = ["the", "of", "house", "tree", "and", "water", "is", "stone", "river", "cloud", "green", "seven"]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", ",", "."]) + str(rng.randint(0, 30)) for _ in range(n))
    items = [(k, " ".join(f"item{k}word{j}" for j in range(20))) for k in range(3)]
    shared = [prose(6) for _ in range(3)]
    rows, labels = [], []
    for i in range(90):
        good = i % 4 > 0
        text = prose(rng.randint(30, 80)) if good else "!! ".join(prose(30).upper().split())
        if good and i % 5 == 0:
            text += "\n" + rng.choice(shared) + "\n" + prose(5)
        if good and i % 11 == 1:
            text = prose(10) + " " + items[i % 3][1] + " " + prose(10)
        rows.append((i, text))
        labels.append((i, int(good), 0))
    rows += [(200 + k, rows[1][1]) for k in range(3)] + [(300, rows[2][1] + " more")]
    rows += [(400, None), (401, ""), (None, prose(40)), (None, prose(40)), rows[3], rows[3]]
    return rows, items, labels


def brute(rows, items, labels):
    """Rows that reach the last stage."""
    truth = {i: q for i, q, _ in labels}
    x = quality.features(*utf8(pa.array([t for _, t in rows], pa.string())))
    import zlib

    once = {i: k for k, (i, _) in enumerate(rows)}  # repeated ids of labelled rows have one text here
    learn = [k for i, k in once.items() if i in truth and zlib.crc32(str(i).encode()) % 4 != 2]
    model = quality.fit(*[np.array(sorted((x[k] for k in learn if truth[rows[k][0]] == q), key=lambda r: r.tobytes())) for q in (1, 0)])
    rows = [r for r, s in zip(rows, model.score(x.astype(float))) if s >= quality.CUT]
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").lower()
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            first[key(line)] = min(first.get(key(line), NO_ID), ranked(i))
    cut = lambda i, t: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or first[key(x)] >= ranked(i))
    rows = [(i, cut(i, t or "")) for i, t in rows]
    sets, groups = brute_groups(rows)
    best = {}
    for k, (r, s, g) in enumerate(zip(rows, sets, groups)):
        if s and (g not in best or ranked(r[0]) < ranked(rows[best[g]][0])):
            best[g] = k
    rows = [r for k, (r, s, g) in enumerate(zip(rows, sets, groups)) if not s or best[g] == k]
    return [(i, t) for i, t in rows if not any(item in t for _, item in items)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows, items, labels = corpus()
    folder = tmp_path_factory.mktemp("corpus") / "sf"
    return write(spark, folder, rows, items, labels), brute(rows, items, labels)


def test_stages(spark, tables):
    folder, wanted = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "1 AS id", "'a' AS row", "2 AS n_dropped", "3 AS score")
    columns = docs.columns
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, folder)
        assert docs.columns == columns
    found = docs.collect()
    assert sorted((ranked(r.doc_id), r.text) for r in found) == sorted((ranked(i), t) for i, t in wanted)
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in found)
    assert {(r.id, r.row, r.n_dropped, r.score) for r in found} == {(1, "a", 2, 3)}


def test_run(spark, tables):
    folder, wanted = tables
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert sorted({ranked(p.doc_id) for p in pieces}) == sorted({ranked(i) for i, _ in wanted})
    by_doc = {}
    for p in pieces:
        by_doc[p.doc_id] = by_doc.get(p.doc_id, 0) + p.length
        total = {q.doc_id: q.doc_tokens for q in pieces}
    assert all(by_doc[i] == total[i] for i in by_doc if i is not None)


def test_stages_are_named_and_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "MinHash near-dedup", "benchmark decontamination", "packing"]


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, tmp_path / "sf")).collect() == []
