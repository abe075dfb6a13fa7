"""Small tables with the odd cases that every operator has to stand."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use themselves.
CLASHING = ["id", "row", "rest", "block", "payload", "version", "score", "keep", "n_lines", "n_dropped", "kept", "key", "gram", "secrets", "_id"]


def odd_rows(seed=0, n=60, vocabulary=40, length=90):
    """Random words with passages and lines in common; nulls, empty and long texts, ties, repeated rows."""
    rng = random.Random(seed)
    words = [f"{rng.choice('abcdefgh')}{k}{rng.choice(['', '!', 'é', ','])}" for k in range(vocabulary)]
    make = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passages = [make(rng.randint(20, length)) for _ in range(5)]
    lines = [make(rng.randint(1, 6)) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [rng.choice(passages)] if rng.random() < 0.6 else []
        parts += [make(rng.randint(0, length // 2)) for _ in range(rng.randint(0, 3))]
        rng.shuffle(parts)
        parts.insert(rng.randint(0, len(parts)), rng.choice(lines))
        rows.append((3 * i + 1, rng.choice(["\n", " ", "  "]).join(parts)))
    rows += [(500, None), (501, ""), (502, " \n\t "), (503, "word"), (None, passages[0]), (None, None)]
    rows += [(510, passages[1]), (510, passages[2]), rows[0], rows[0], (520, make(20_000))]
    rows += [(530 + k, passages[3] + " " + make(3)) for k in range(12)] + [(550 + k, passages[4]) for k in range(12)]
    rng.shuffle(rows)
    return rows


def documents(spark, rows, extra=False):
    """A frame of rows (doc_id, text) with the columns of `documents`, and with clashing ones if `extra`."""
    full = [(i, t, None if k % 3 else "en", f"s{k % 2}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(full, DOCS).repartition(3)
    if extra:
        df = df.selectExpr("*", *[f"'{name}' AS {name}" for name in CLASHING])
    return df


def write(spark, folder, rows=None, benchmark=(), labels=(), pages=()):
    """The tables as Parquet, for queries that read a folder; no rows make an empty table."""
    documents(spark, rows or [(0, "x")]).filter("true" if rows else "false").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([*benchmark, (0, "")], "item_id bigint, text string").limit(len(benchmark)).write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([*labels, (0, 0, 0)], "doc_id bigint, quality int, toxic int").limit(len(labels)).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([*pages, (0, "", "")], "page_id bigint, url string, html string").limit(len(pages)).write.parquet(f"{folder}/pages.parquet")
    return str(folder)
