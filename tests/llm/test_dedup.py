"""Line, word, byte and near-duplicate dedup against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from couchlog.llm import components, exchange, line_dedup, minhash_dedup, substring_dedup, suffix_dedup
from couchlog.llm.blocks import Block, squeeze
from tests.llm.tables import documents, odd_rows, write

NO_ID = (1 << 63) - 1
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def ranked(i):
    return NO_ID if i is None else i


def brute_lines(rows):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            first[key(line)] = min(first.get(key(line), NO_ID), ranked(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] >= ranked(i)]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def brute_windows(rows, window, split, join):
    """Units of each text, and what is left of them."""
    first, units = {}, []
    for i, t in rows:
        u = split(t or "")
        units.append(u)
        for p in range(len(u) - window + 1):
            w = tuple(u[p : p + window])
            first[w] = min(first.get(w, NO_ID), ranked(i))
    out = []
    for (i, _), u in zip(rows, units):
        gone = np.zeros(len(u), bool)
        for p in range(len(u) - window + 1):
            if first[tuple(u[p : p + window])] < ranked(i):
                gone[p : p + window] = True
        spans = int((np.diff(gone, prepend=False).astype(int) * gone).sum())
        out.append((i, len(u), int(gone.sum()), spans, sha(join([x for x, g in zip(u, gone) if not g]))))
    return out


def brute_sets(rows):
    out = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append(set(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def brute_groups(rows):
    """Group of each row by links at 0.75, as the list index of its first member."""
    sets, parent = brute_sets(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return sets, [find(k) for k in range(len(rows))]


def same(found, wanted):
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(tuple, found), key=key) == sorted(wanted, key=key)


@pytest.fixture(scope="module")
def rows():
    return odd_rows()


def test_lines(spark, rows):
    cut = line_dedup.drop_repeated_lines(documents(spark, rows, extra=True))
    found = cut.select("rest.doc_id", "n_lines", "n_dropped", F.sha2("text", 256))
    same(found.collect(), brute_lines(rows))
    assert "rest" in cut.columns and "_id" in cut.schema["rest"].dataType.names


def test_bitmaps_tell_the_kept_lines(spark):
    rows = [(1, "a line of text\nother\n"), (2, "A LINE OF TEXT \nown line here"), (3, "x\n a line of text\nown line here")]
    maps = {r.id: r for r in line_dedup.keep_bitmaps(documents(spark, rows)).collect()}
    bits = {i: np.unpackbits(np.frombuffer(zlib.decompress(r.keep), np.uint8))[: r.n_lines].tolist() for i, r in maps.items()}
    assert bits == {1: [1, 1, 1], 2: [0, 1], 3: [1, 0, 0]}


def test_lines_of_one_hash_over_many_ranges():
    """Ranges that begin and end within a hash, in every split of the sorted rows."""
    ids = [1, 1, 2, 3, 3, 4, 1, 5, 2, 2, 6]
    hashes = [5, 5, 5, 5, 5, 5, 6, 6, 7, 7, 8]
    rng = random.Random(1)
    for _ in range(200):
        cuts = sorted(rng.choices(range(len(ids) + 1), k=4))
        parts = [slice(a, b) for a, b in zip([0, *cuts], [*cuts, len(ids)])]
        rows = []
        for part in parts:
            n = len(ids[part])
            columns = [hashes[part], [0] * n, ids[part], [0] * n]
            batch = [pa.record_batch([*[pa.array(c, pa.int64()) for c in columns], pa.array(range(n), pa.int32())], list("abcde"))]
            batch = [batch[0].slice(0, n // 2), batch[0].slice(n // 2)]
            rows += [r for out in line_dedup._stream(iter(batch)) for r in out.to_pylist()]
        first = {}
        for r in rows:
            if r["pending"]:
                first[r["h1"]] = min(first.get(r["h1"], 99), r["first"])
        gone = [(r["h1"], r["id"]) for r in rows if (r["id"] > first[r["h1"]] and r["line"] >= 0 if r["pending"] else True)]
        assert sorted(gone) == [(5, 2), (5, 3), (5, 3), (5, 4), (6, 5)]


@pytest.mark.parametrize("block_bytes", [1500, 1 << 22])
def test_words(spark, rows, block_bytes):
    found = substring_dedup.remove_repeated_words(documents(spark, rows, extra=True), block_bytes)
    found = found.select(F.when(F.col("id") != NO_ID, F.col("id")), "n_words", "n_removed", F.size("spans"), F.sha2("kept", 256))
    same(found.collect(), brute_windows(rows, 50, WORD.findall, " ".join))


@pytest.mark.parametrize("seed", [1, 2])
def test_words_of_a_small_vocabulary(spark, seed):
    """Few distinct words: windows repeat within and across documents, and the graph branches often."""
    rows = odd_rows(seed, n=40, vocabulary=3, length=120)
    found = substring_dedup.remove_repeated_words(documents(spark, rows), 4000)
    found = found.select(F.when(F.col("id") != NO_ID, F.col("id")), "n_words", "n_removed", F.size("spans"), F.sha2("kept", 256))
    same(found.collect(), brute_windows(rows, 50, WORD.findall, " ".join))


def test_paths_are_compacted(spark):
    """A chain of nine nodes and one of one: every node learns its head and its distance."""
    rows = [(k, 1, k - 1 if k > 1 else None, 7 if k > 1 else 0) for k in range(1, 10)] + [(50, 1, None, 0)]
    found = substring_dedup.paths(spark.createDataFrame(rows, "gram bigint, low bigint, before bigint, step bigint"))
    assert {r.gram: (r.head, r.dist) for r in found.collect()} == {k: (1, 7 * (k - 1)) for k in range(1, 10)} | {50: (50, 0)}


@pytest.mark.parametrize("hot_blocks", [2, 4096])
@pytest.mark.parametrize("block_bytes", [1500, 1 << 22])
def test_bytes(spark, rows, block_bytes, hot_blocks):
    found = suffix_dedup.remove_repeated_bytes(documents(spark, rows, extra=True), block_bytes, 4000, hot_blocks)
    found = found.select(F.when(F.col("id") != NO_ID, F.col("id")), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    same(found.collect(), brute_windows(rows, 50, lambda t: list(t.encode()), bytes))


@pytest.mark.parametrize("fan", [2, 3])
def test_bytes_over_several_hops(spark, rows, fan):
    found = suffix_dedup.remove_repeated_bytes(documents(spark, rows), 20_000, 12_000, 2, fan)
    found = found.select(F.when(F.col("id") != NO_ID, F.col("id")), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    same(found.collect(), brute_windows(rows, 50, lambda t: list(t.encode()), bytes))


def test_grams_are_spread_over_the_parts():
    """Anchors have low hashes; each part still gets about as many of their grams."""
    text = np.random.default_rng(5).integers(97, 123, 400_000, np.uint8)
    block = Block(squeeze(np.array([1]), np.array([0, len(text)]), text))
    at, gram = suffix_dedup.anchors(block)
    assert len(at) > 30_000
    sizes = np.diff(suffix_dedup._parts(np.sort(gram), 40))
    assert sizes.max() < 1.3 * sizes.mean() and sizes.min() > 0.7 * sizes.mean()


def test_every_hop_moves_rows_in_proportion_to_the_blocks(spark):
    """With eight times the blocks and the parts, a hop has at most eight times the rows, and each run meets its part."""
    fan = 4
    for blocks, parts in [(16, 16), (128, 128), (5, 1), (1, 30)]:
        ways = exchange.Exchange(blocks, parts, fan)
        bounds = np.arange(parts + 1)

        def ask(batches, ways=ways, bounds=bounds):
            for batch in batches:
                for block in batch.column(0).to_pylist():
                    yield from ways.send(block, bounds, lambda s, e: f"{block}/{s}".encode() if (block + s) % 7 else b"")

        def reply(sent):
            assert len({x.split(b"/")[1] for x in sent}) == 1
            return [b"answer to " + x for x in sent]

        hop = spark.range(blocks).mapInArrow(ask, exchange.ROWS)
        assert hop.count() <= fan * blocks
        for k in range(1, ways.hops):
            hop = ways.deal(hop, k)
            assert hop.count() <= fan * (blocks + parts)
        back = ways.answer(hop, reply)
        for k in range(ways.hops - 1, 0, -1):
            assert back.count() <= fan * (blocks + parts)
            back = ways.gather(back, k)
        assert back.count() <= fan * blocks
        got = ways.asked(spark.range(blocks).mapInArrow(ask, exchange.ROWS), reply).toArrow()
        told = {(b, part): bits for b, x in zip(got["cell"].to_pylist(), got["reply"]) for part, bits in ways.received(x)}
        assert told == {(b, p): f"answer to {b}/{p}".encode() for b in range(blocks) for p in range(parts) if (b + p) % 7}


def test_bytes_with_nul_and_runs(spark):
    rng = random.Random(4)
    pool = ["".join(rng.choice("ab é\0") for _ in range(rng.randint(30, 150))) for _ in range(6)]
    rows = [(i, "".join(rng.choice(pool)[rng.randint(0, 20) :] for _ in range(rng.randint(0, 5)))) for i in range(40)]
    rows += [(100, "a" * 300), (101, "b" + "a" * 200), (102, "ab" * 90), (99, "ba" * 80)]
    found = suffix_dedup.remove_repeated_bytes(documents(spark, rows), 1000, 4000)
    found = found.select("id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    same(found.collect(), brute_windows(rows, 50, lambda t: list(t.encode()), bytes))


def test_loser_tree_merges_and_knows_prefixes():
    rng = random.Random(3)
    for k in (1, 2, 3, 7):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(50)) for _ in range(rng.randint(0, 30))) for _ in range(k)]
        shared = lambda a, b: next((i for i in range(50) if a[i] != b[i]), 50)
        coded = [(r, [0] + [shared(x, y) for x, y in zip(r, r[1:])]) for r in runs]
        taken, common = suffix_dedup.merge_runs([(r, c) for r, c in coded if r])
        heads = [iter(r) for r in runs if r]
        merged = [next(heads[t]) for t in taken]
        assert merged == sorted(x for r in runs for x in r)
        assert common[1:] == [shared(x, y) for x, y in zip(merged, merged[1:])]


def near_rows(seed=5):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(15):
        base = [rng.choice(words) for _ in range(rng.choice([3, 6, 12, 60, 150]))]
        for _ in range(rng.choice([1, 3, 12])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                w[rng.randrange(len(w))] = rng.choice(words)
            base = w if rng.random() < 0.2 else base
            rows.append((2 * len(rows) + 1, " ".join(w).upper() if rng.random() < 0.2 else "  ".join(w)))
    rng.shuffle(rows)
    return rows


def test_near_duplicates(spark):
    rows = near_rows() + [(9001, None), (9003, ""), (9005, " \n")]
    sets, groups = brute_groups(rows)
    low = {}
    for (i, _), g in zip(rows, groups):
        low[g] = min(low.get(g, NO_ID), i)
    found = minhash_dedup.near_duplicates(documents(spark, rows, extra=True), 20_000).select("id", "n_shingles", "component")
    same(found.collect(), [(i, len(s), low[g]) for (i, _), s, g in zip(rows, sets, groups)])


def test_near_duplicates_of_odd_rows(spark, rows):
    sets, groups = brute_groups(rows)
    low = {}
    for (i, _), g in zip(rows, groups):
        low[g] = min(low.get(g, NO_ID), ranked(i))
    found = minhash_dedup.near_duplicates(documents(spark, rows, extra=True), 20_000).select("id", "n_shingles", "component")
    same(found.collect(), [(ranked(i), len(s), low[g] if s else ranked(i)) for (i, _), s, g in zip(rows, sets, groups)])
    kept = minhash_dedup.deduplicate(documents(spark, rows, extra=True))
    assert kept.columns == documents(spark, rows, extra=True).columns
    first = {}
    for (i, t), s, g in zip(rows, sets, groups):
        if s:
            first[g] = min(first.get(g, NO_ID), ranked(i))
    ids = sorted(ranked(r.doc_id) for r in kept.select("doc_id").collect())
    assert ids == sorted([*first.values(), *[ranked(i) for (i, _), s in zip(rows, sets) if not s]])


def test_a_link_that_no_star_shows(spark):
    """A chain of edits: neighbours are alike, the ends are not, all are one component."""
    words = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(words[: 120 - 8 * k] + [f"x{j}" for j in range(8 * k)])) for k in range(12)]
    sets, groups = brute_groups(rows)
    assert len(set(groups)) == 1
    found = minhash_dedup.near_duplicates(documents(spark, rows)).select("id", "component").collect()
    assert {r.component for r in found} == {0}


def test_lanes_and_estimate(spark):
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 40, minhash_dedup.HASHES, dtype=np.uint64)
    b = np.where(rng.random(len(a)) < 0.6, a, rng.integers(0, 1 << 40, len(a), dtype=np.uint64))
    packed = [minhash_dedup.packed_lanes(x).tolist() for x in (a, b)]
    df = spark.createDataFrame([tuple(packed)], "a array<bigint>, b array<bigint>")
    row = df.select(minhash_dedup.equal_lanes(F.col("a"), F.col("b")).alias("n"), minhash_dedup.estimate(F.col("a"), F.col("b")).alias("s")).first()
    low = np.uint64((1 << minhash_dedup.BITS) - 1)
    equal = int(((a & low) == (b & low)).sum())
    assert row.n == equal and abs(row.s - (equal / len(a) - 1 / 16) / (15 / 16)) < 1e-9


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 90), (90, 95), (200, 200), (7, 3), (100, 95)]
    found = components.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    wanted = {k: 1 for k in range(1, 41)} | {90: 90, 95: 90, 100: 90}
    assert {r.id: r.component for r in found.collect()} == wanted


@pytest.mark.parametrize("name", ["op2_debruijn", "op3_suffix_dedup", "op6_minhash", "op8_line_dedup"])
def test_empty_table(spark, tmp_path, name):
    from couchlog.llm.queries import QUERIES

    assert QUERIES[name](spark, write(spark, tmp_path)).collect() == []


def test_a_long_passage_is_one_path_and_leaves_few_windows_open(spark):
    rng = random.Random(8)
    fresh = lambda n: " ".join(f"{rng.random():.9f}" for _ in range(n))
    passage = fresh(600)
    rows = [(k, f"{fresh(40)} {passage} {fresh(40)}") for k in range(6)]
    blocks = substring_dedup.Blocks(substring_dedup.inputs(documents(spark, rows)), 20_000)
    placed = substring_dedup.paths(substring_dedup.graph(blocks))
    lengths = placed.groupBy("head").agg((F.max("dist") + substring_dedup.GRAM).alias("length"))
    assert lengths.agg(F.max("length")).first()[0] > 600 - 2 * 50
    known = substring_dedup._told(blocks, placed.join(lengths, "head"))
    opened = blocks.map_with([known], substring_dedup._open_windows, "h1 bigint, h2 bigint, block bigint, low bigint")
    # only windows over the ends of the passage, in each of the six documents, of 3786 in all
    assert 0 < opened.select("h1").distinct().count() <= 6 * 2 * 50
