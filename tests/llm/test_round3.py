"""Mixing, token alignment and periodic runs against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from couchlog.llm import mixing, periodic_runs, token_alignment
from couchlog.llm.queries import QUERIES
from tests.llm.tables import documents, odd_rows, write

ASCII_SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    out, word = [], ""
    for c in text or "":
        if c in ASCII_SPACE:
            out, word = out + [word] if word else out, ""
        else:
            word += c
    return out + [word] if word else out


@pytest.fixture(scope="module")
def rows():
    return odd_rows(7, n=40) + [(900, "odd spaces  x"), (901, "<|endoftext|> don't  stop <s>"), (902, "a\n\n b\t c \n"), (903, " ▁x"), (904, "🙂 \x00")]


# --- mixing --------------------------------------------------------------------------------------


def brute_targets(words, weights, share, most):
    """Sources in order -> targets, by sharing the excess round after round."""
    order = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, fixed = {}, set()
    left = share * sum(words.values())
    while True:
        free = [s for s in order if s not in fixed]
        for s in free:
            target[s] = Fraction(left) * weight[s] / sum(weight[t] for t in free)
        over = [s for s in free if target[s] >= most * words[s]]
        if not over:
            return target
        for s in over:
            target[s] = Fraction(most * words[s])
            left -= target[s]
        fixed |= set(over)


def sized(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id bigint, source string, size bigint").repartition(parts)


def test_targets_and_whole_copies(spark):
    rng = random.Random(2)
    sources = ["b", "a", "é", None, "", "zz", "A", "\U0001f642"]
    rows = [(i, sources[min(int(rng.expovariate(0.5)), 7)], int(rng.lognormvariate(4, 1.5))) for i in range(1500)]
    rows += [(5000, "giant", 40_000), (5001, "giant", 50), (5002, "none", 0), (None, None, 30), (None, None, 30)]
    words = defaultdict(int)
    for _, s, n in rows:
        words[s] += n
    target = brute_targets(words, (5, 2, 1), Fraction(3, 2), 2)
    found = mixing.mix(sized(spark, rows), fan=32).select("row.*", "source_size", "target", "copies", "taken").collect()
    assert sorted((r.doc_id or -1, r.source or "", r.size) for r in found) == sorted((i or -1, s or "", n) for i, s, n in rows)
    taken = Counter()
    for r in found:
        ratio = target[r.source] / words[r.source] if words[r.source] else 0
        assert int(ratio) <= r.copies <= int(ratio) + 1 and r.copies <= 2 and r.taken == r.copies * r.size
        assert r.source_size == words[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        taken[r.source] += r.taken
    largest = {s: max(n for _, t, n in rows if t == s) for s in words}
    for s in words:
        assert abs(taken[s] - target[s]) <= (largest[s] if s == "giant" else 0.02 * target[s] + 40), s


def test_rounding_keeps_words_and_expectation():
    rng = random.Random(3)
    for _ in range(2000):
        size, other = rng.randint(1, 50), rng.randint(1, 50)
        p, q = rng.random(), rng.random()
        results = [mixing.duel(size, p, other, q, u) for u in (np.arange(400) + 0.5) / 400]
        for a, b in set(results):
            assert 0 <= a <= 1 and 0 <= b <= 1 and (a in (0, 1) or b in (0, 1))
            assert abs(size * a + other * b - size * p - other * q) < 1e-9
        assert abs(np.mean([a for a, _ in results]) - p) < 0.005 and abs(np.mean([b for _, b in results]) - q) < 0.005 * max(1, size / other)


def test_mixing_does_not_depend_on_partitioning(spark):
    rng = random.Random(4)
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", rng.randint(0, 60)) for i in range(4000)]
    runs = [
        sorted(map(tuple, mixing.mix(sized(spark, rows, parts), fan=8).select("row.doc_id", "copies", "target").collect())) for parts in (1, 5)
    ]
    assert runs[0] == runs[1]
    more = mixing.mix(sized(spark, rows), weights=(1,), share=Fraction(1, 4), fan=8)
    assert {r.copies for r in more.collect()} == {0, 1}
    with pytest.raises(ValueError):
        mixing.targets(more, share=Fraction(5, 2))


def test_mixing_query(spark, rows, tmp_path):
    found = QUERIES["op11_mixing"](spark, write(spark, tmp_path / "sf", rows))
    assert found.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted((r.doc_id or -1, r.size) for r in found.collect()) == sorted((i or -1, len(words_of(t))) for i, t in rows)
    clashing = sized(spark, [(1, "a", 4)]).selectExpr("*", "1 AS leaf", "2 AS share", "3 AS copies", "4 AS `row`")
    assert mixing.mix(clashing).select("row.leaf", "row.share", "row.copies", "row.row").collect() == [(1, 2, 3, 4)]


# --- token alignment -------------------------------------------------------------------------------


def brute_alignment(rows):
    """Every link of every text, by comparing byte ranges."""
    a_coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_coder.encode_special_tokens = True
    b_coder = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    as_bytes = lambda k: bytes([int(b_coder.id_to_piece(k)[3:5], 16)]) if b_coder.is_byte(k) else b_coder.id_to_piece(k).replace("▁", " ").encode()

    def ranges(tokens):
        out, at = [], 0
        for k, b in tokens:
            out.append((at, at + len(b), k))
            at += len(b)
        return out

    texts, count = [], Counter()
    for i, t in rows:
        a, b = [], []
        if t:
            a = [(k, bytes(letters[c] for c in a_coder.id_to_token(k))) for k in a_coder.encode(" " + t, add_special_tokens=False).ids]
            b = [(k, as_bytes(k)) for k in b_coder.encode(t)]
            if {b"".join(x for _, x in side) for side in (a, b)} != {(" " + t).encode()}:
                a, b = [], []
        a, b, links, j = ranges(a), ranges(b), [], 0
        for s, e, k in a:
            while j and b[j - 1][1] > s:
                j -= 1
            while j < len(b) and b[j][1] <= s:
                j += 1
            links += [(k, m) for f, g, m in b[j : j + e - s + 1] if f < e and g > s]
        ends = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        of = lambda side, lo, hi: ",".join(str(k) for _, e, k in side if lo < e <= hi)
        groups = ";".join(f"{of(a, lo, hi)}|{of(b, lo, hi)}" for lo, hi in zip([0, *ends], ends)) if len(a) < 500 else None
        texts.append((i, len(a), len(b), len(ends), links, groups))
        count.update(set(links))
    most = defaultdict(int)
    for (k, _), n in count.items():
        most[k] = max(most[k], n)
    return [(i, x, y, g, len(ls), sum(count[p] == most[p[0]] for p in ls), sum(count[p] for p in ls), s) for i, x, y, g, ls, s in texts]


def plain(found, names, rows):
    key = lambda r: tuple((x is not None, x) for x in r[:7])
    return sorted([tuple(getattr(r, n) for n in names) for r in found], key=key), sorted(rows, key=key)


@pytest.mark.parametrize("block_bytes,fan,parts", [(1 << 22, 64, 3), (1500, 2, 9)])
def test_alignment(spark, rows, block_bytes, fan, parts):
    rng = random.Random(5)
    alphabet = [" ", "  ", "\n", "\t", "a", "the", " of", "é", "12", "!?", "中文", "<0x41>", "\x0b", "🙂", "ing"]
    texts = rows + [(2000 + k, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))) for k in range(150)]
    docs = documents(spark, texts, extra=True).repartition(parts)
    found = token_alignment.align(docs, groups=True, block_bytes=block_bytes, fan=fan).select("row.*", *[F.col(n).alias(f"x_{n}") for n in NAMES], "groups", "groups_sha256").collect()
    wanted = brute_alignment(texts)
    got, wanted = plain(found, ["doc_id", *[f"x_{n}" for n in NAMES], "groups"], wanted)
    assert [r[:7] for r in got] == [r[:7] for r in wanted]
    assert all(w[7] is None or g[7] == w[7] for g, w in zip(got, wanted))
    assert all(r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") for r in found)
    assert {r.score for r in found} == {"score"}


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def test_alignment_query(spark, rows, tmp_path):
    found = QUERIES["op12_token_alignment"](spark, write(spark, tmp_path / "sf", rows))
    got, wanted = plain(found.collect(), ["doc_id", *NAMES], [r[:7] for r in brute_alignment(rows)])
    assert found.columns == ["doc_id", *NAMES, "groups_sha256"] and got == wanted


def test_merge_of_runs_over_many_frames(monkeypatch):
    monkeypatch.setattr(token_alignment, "FRAME", 7)
    rng = np.random.default_rng(1)
    count, runs = Counter(), []
    for _ in range(9):
        keys = np.unique((rng.integers(0, 6, 60) << 16 | rng.integers(0, 30, 60)).astype(np.uint32))
        counts = rng.integers(1, 5, len(keys)).astype(np.uint32)
        runs.append(token_alignment.write_run(keys, counts))
        count.update(dict(zip(keys.tolist(), counts.tolist())))
    most = {a: max(n for k, n in count.items() if k >> 16 == a) for a in range(6)}
    chunks = [c for c in token_alignment.with_best(token_alignment.merge(runs))]
    found = [tuple(map(int, r)) for c in chunks for r in zip(*c)]
    assert found == [(k, n, int(n == most[k >> 16])) for k, n in sorted(count.items())]


# --- periodic runs ---------------------------------------------------------------------------------


def brute_runs(words, min_length=6, exponent=4):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(min_length, exponent * q):
                if not any(all(words[k] == words[k + d] for k in range(i, j + q - d)) for d in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


@pytest.mark.parametrize("limits", [(6, 4), (4, 2), (20, 2), (3, 3), (10, 5)])
def test_runs_of_random_sequences(limits):
    rng = random.Random(sum(limits))
    for _ in range(600):
        n, kinds = rng.randint(0, 70), rng.choice([1, 2, 3, 6])
        seq = [rng.randrange(kinds) for _ in range(n)]
        if n and rng.random() < 0.6:
            a, p = rng.randrange(n), rng.randint(1, 9)
            seq = [x if i < a or a + (i - a) % p >= n else seq[a + (i - a) % p] for i, x in enumerate(seq)]
        words = np.array(seq, np.uint64) + np.uint64(1)
        wanted = brute_runs(seq, *limits)
        assert periodic_runs.runs_of(words, *limits) == wanted
        stretches = periodic_runs.candidates(words, np.array([0, n]), *limits)
        assert sorted((b + s, x, q) for b, e in stretches for s, x, q in periodic_runs.runs_of(words[b:e], *limits)) == wanted


def brute_digest(doc_id, text):
    words = words_of(text)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words) if n < 1000 else periodic_runs.runs_of(np.unique(words, return_inverse=True)[1])
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    dropped = {i for s, x, q in runs for i in range(s + q, s + x)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, best[1] * 1000 // best[2] if runs else None,
        sha("".join(f"{s},{x},{q}\n" for s, x, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_periodic_runs_query(spark, rows, tmp_path):
    rng = random.Random(6)
    more = [(3000 + k, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for k in range(200)]
    more += [(4000, "x " * 3000), (4001, "x y\n" * 5 + "x x x x x x"), (4002, ("a b c " * 4)[:-3] + "d"), (None, "z " * 9)]
    folder = write(spark, tmp_path / "sf", rows + more)
    found = QUERIES["op13_periodic_runs"](spark, folder)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted([brute_digest(i, t) for i, t in rows + more], key=key)


def test_periodic_runs_keep_columns_and_texts(spark):
    docs = documents(spark, [(1, "say a b a b a b a b end"), (2, None)], extra=True)
    found = {r.row.doc_id: r for r in periodic_runs.find_runs(docs).collect()}
    assert found[1].collapsed == "say a b end" and [tuple(r) for r in found[1].runs] == [(1, 8, 2)] and found[1].n_words == 10
    assert found[2].collapsed == "" and found[2].runs == [] and found[1].row.row == "row"
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, exponent=1)


@pytest.mark.parametrize("name", ["op11_mixing", "op12_token_alignment", "op13_periodic_runs"])
def test_empty_table(spark, tmp_path, name):
    assert QUERIES[name](spark, write(spark, tmp_path / "sf")).collect() == []
