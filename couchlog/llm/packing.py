"""Packing along a space-filling curve.

Every document becomes token ids and a vector of hashed words, projected to `DIMS` dimensions. The
cell of the vector on a Hilbert curve is the document's key. Documents are range-sorted by key, and
the token stream of each range is cut every `length` tokens, so a sequence holds documents that lie
next to each other on the curve. What remains at the end of a range is cut into powers of two, the
lengths that need no padding.

Defined cases: a null or empty text is the end token alone; the string of a special token in a text is
that token, as the tokenizer has it; a very long text is one row, and is cut into as many sequences as it needs; rows with equal id or equal text, and
null ids, are packed like any other, ordered by (key, id, text hash, tokens); other columns play no
part; an empty table gives no sequence.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from couchlog.llm.common import NO_ID, documents, inputs, schema, stage
from couchlog.llm.words import mix, utf8, word_bounds, word_hashes

LENGTH = 1024
DIMS = 4
LEVELS = 15
END = 0
#: Ids are kept in 16 bits on their way; the vocabulary has fewer than 65,536.
STORED = "<u2"
_TOKENS = "id bigint, key bigint, tokens binary"
_PIECE = 12 << 20

# White space beyond the ASCII kinds that split words here, and the bytes it may begin with; texts
# with any are encoded as a whole.
_ODD_SPACE = regex.compile(r"[\s--[\x20\x09-\x0D]]", regex.V1)
_ODD_LEAD = np.zeros(256, bool)
_ODD_LEAD[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True


@lru_cache(maxsize=2)
def special_tokens(path: str) -> dict[str, int]:
    """The special tokens of a JSON vocabulary; its tokenizer takes their strings in a text for them."""
    return {token["content"]: token["id"] for token in json.load(open(path))["added_tokens"]}


@lru_cache(maxsize=2)
def _encoding(path: str, special: tuple[tuple[str, int], ...]) -> tiktoken.Encoding:
    """The byte-level BPE of the JSON vocabulary, from its rank file: the same ids, faster."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(special))


class Encoder:
    """Token ids of texts. Each distinct piece between spaces is encoded once per call.

    `special` are strings that are one token wherever a text holds them; such texts have to be given to `whole`.
    """

    def __init__(self, path: str, special: dict[str, int] | None = None):
        self.special = special or {}
        self._coding = _encoding(path, tuple(sorted(self.special.items())))
        size = len(self._coding._mergeable_ranks)
        self._width = np.array([len(self._coding.decode_single_token_bytes(i)) for i in range(size)], np.int64)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Where each token ends, in bytes from the first one's start."""
        return np.cumsum(self._width[ids])

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and first index per text of the parts that the vocabulary's pattern never joins.

        A part is a word with the one space before it. Of the white space in between, what stands
        directly before a word without space is cut once more: its last character is a part.
        """
        starts, ends, first = word_bounds(data, offsets)
        some = first[:-1] < first[1:]
        before = np.empty_like(starts)
        before[1:] = ends[:-1]
        before[first[:-1][some]] = offsets[:-1][some]
        spaced = (starts > before) & (data[starts - 1] == 0x20)
        begin = starts - spaced
        gap = np.flatnonzero(begin > before)
        lone = np.where(spaced[gap], begin[gap], begin[gap] - 1)
        tail = offsets[:-1].copy()
        tail[some] = ends[first[1:][some] - 1]
        all_s = np.concatenate([begin, before[gap], lone, tail])
        all_e = np.concatenate([ends, lone, begin[gap], offsets[1:]])
        full = all_e > all_s
        all_s, all_e = all_s[full], all_e[full]
        order = np.argsort(all_s, kind="stable")
        return all_s[order], all_e[order], np.searchsorted(all_s[order], offsets)

    def _encode_pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, and how many each has. Words with a space before them go in one string."""
        size = ends - starts
        joint = (data[starts] == 0x20) & (size > 1)
        joint &= data[np.minimum(starts + 1, len(data) - 1)] != 0x20
        counts = np.zeros(len(starts), np.int64)
        many = np.flatnonzero(joint)
        flat = np.zeros(0, np.uint32)
        if len(many):
            width = size[many]
            cuts = np.cumsum(width)
            take = np.arange(cuts[-1]) + np.repeat(starts[many] - (cuts - width), width)
            flat = np.array(self._coding.encode_ordinary(data[take].tobytes().decode()), np.uint32)
            token_ends = np.cumsum(self._width[flat])
            at = np.searchsorted(token_ends, cuts)
            if not np.array_equal(token_ends[at], cuts):  # a token spans two pieces
                flat, joint[:] = np.zeros(0, np.uint32), False
            else:
                counts[many] = np.diff(at + 1, prepend=0)
        lists = {
            int(i): self._coding.encode_ordinary(data[starts[i] : ends[i]].tobytes().decode()) for i in np.flatnonzero(~joint)
        }
        for i, ids in lists.items():
            counts[i] = len(ids)
        out = np.empty(int(counts.sum()), np.uint32)
        at = np.cumsum(counts) - counts
        own = np.repeat(joint, counts)
        out[own] = flat
        for i, ids in lists.items():
            out[at[i] : at[i] + len(ids)] = ids
        return out, counts

    def plain(self, text: str) -> list[int]:
        """Ids of one text, the strings of special tokens as plain text."""
        return self._coding.encode_ordinary(text)

    def whole(self, text: str) -> list[int]:
        """Ids of one text with special tokens."""
        return self._coding.encode(text, allowed_special=set(self.special), disallowed_special=())

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the index of each text's first id (one more than texts)."""
        starts, ends, first = self.pieces(data, offsets)
        _, rep, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        flat, size = self._encode_pieces(data, starts[rep], ends[rep])
        at = np.cumsum(size) - size
        n = size[which]
        out_at = np.concatenate([[0], np.cumsum(n)])
        take = np.arange(out_at[-1]) + np.repeat(at[which] - out_at[:-1], n)
        return flat[take], out_at[first]


def hilbert_key(cells: np.ndarray, levels: int) -> np.ndarray:
    """Position on the Hilbert curve of points in a grid of 2^levels cells a side; one row per point."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (levels - 1)
    while q > 1:  # undo the rotations, from the largest cube to the smallest
        low = q - 1
        for i in range(dims):
            inside = (x[i] & q) != 0
            swap = np.where(inside, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(inside, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (levels - 1)
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(levels - 1, -1, -1):  # interleave
        for i in range(dims):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_keys(data: np.ndarray, offsets: np.ndarray, dims: int = DIMS, levels: int = LEVELS) -> np.ndarray:
    """Hilbert key of every text's hashed words: each word adds a fixed random direction."""
    starts, ends, first = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends, lower=True)
    count = np.diff(first)
    owner = np.repeat(np.arange(len(count)), count)
    cells = np.zeros((len(count), dims), np.int64)
    for k in range(dims):
        direction = mix(hashes + np.uint64(k + 1)).view(np.int64) / 2.0**63
        mean = np.bincount(owner, direction, len(count)) / np.sqrt(np.maximum(count, 1))
        place = 1 / (1 + np.exp(-2 * mean))
        cells[:, k] = np.minimum(place * (1 << levels), (1 << levels) - 1).astype(np.int64)
    return hilbert_key(cells, levels)


def special_texts(data: np.ndarray, offsets: np.ndarray, special: Iterable[str]) -> list[int]:
    """Indexes of the texts that hold the string of a special token."""
    found, text = set(), data[offsets[0] : offsets[-1]].tobytes()
    for token in special:
        wanted = token.encode()
        at = text.find(wanted)
        while at >= 0:
            place = at + int(offsets[0])
            k = int(np.searchsorted(offsets, place, "right")) - 1
            if place + len(wanted) <= offsets[k + 1]:
                found.add(k)
            at = text.find(wanted, at + 1)
    return sorted(found)


def odd_texts(data: np.ndarray, offsets: np.ndarray) -> list[int]:
    """Indexes of the texts with white space of other kinds."""
    leads = np.flatnonzero(_ODD_LEAD[data[offsets[0] : offsets[-1]]]) + offsets[0]
    maybe = np.unique(np.searchsorted(offsets, leads, "right") - 1)
    return [k for k in maybe.tolist() if _ODD_SPACE.search(data[offsets[k] : offsets[k + 1]].tobytes().decode())]


def tokenize(docs: DataFrame, ranks_path: str, end: int = END, special: dict[str, int] | None = None) -> DataFrame:
    """id, key, tokens (`STORED` numbers), `end` after each text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks_path, special)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            ids = batch.column("id").to_numpy()
            i = 0
            while i < len(ids):
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _PIECE)) - 1)
                part = offsets[i : j + 1]
                flat, at = encoder(data, part)
                own = [flat[at[k] : at[k + 1]] for k in range(j - i)]
                for k in {*odd_texts(data, part), *special_texts(data, part, encoder.special)}:
                    own[k] = np.array(encoder.whole(data[part[k] : part[k + 1]].tobytes().decode()), np.uint32)
                rows = [np.append(x, np.uint32(end)).astype(STORED).tobytes() for x in own]
                yield pa.record_batch(
                    [pa.array(ids[i:j]), pa.array(curve_keys(data, part)), pa.array(rows, pa.binary())], ["id", "key", "tokens"]
                )
                i = j

    return docs.select("id", "text").mapInArrow(encode, schema(_TOKENS))


def _tail(n: int) -> list[int]:
    """n as a sum of falling powers of two."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def pack_sorted(docs: list[tuple[int, np.ndarray]] | Iterator[tuple[int, np.ndarray]], length: int, base: int) -> Iterator[tuple]:
    """(id, start, piece, doc_tokens, sequence_id, offset) along a stream of documents.

    Full sequences are given out at once; only the last, unfinished one is held back.
    """
    sequence, used = base, 0
    held: list[tuple] = []
    for doc_id, ids in docs:
        at = 0
        while at < len(ids):
            n = min(length - used, len(ids) - at)
            held.append((doc_id, at, ids[at : at + n], len(ids), sequence, used))
            at, used = at + n, used + n
            if used == length:
                yield from held
                held, sequence, used = [], sequence + 1, 0
    sizes, room = iter(_tail(used)), 0
    sequence -= 1
    for doc_id, at, piece, total, _, _ in held:
        while len(piece):
            if not room:
                size = next(sizes)
                room, sequence = size, sequence + 1
            n = min(room, len(piece))
            yield doc_id, at, piece[:n], total, sequence, size - room
            piece, at, room = piece[n:], at + n, room - n


def pack(docs: DataFrame, length: int = LENGTH, ranks_path: str | None = None, special: dict[str, int] | None = None) -> DataFrame:
    """Pieces of documents in sequences: id, start, tokens, doc_tokens, sequence_id, offset.

    `ranks_path` and `special` are the merges and special tokens of the tokenizer, by default both of `byte_bpe_50k`.
    """
    if ranks_path is None:
        ranks_path = public_tokenizers.path("byte_bpe_50k.tiktoken")
        special = special_tokens(public_tokenizers.path("byte_bpe_50k.json")) if special is None else special
    rows = stage(tokenize(docs, ranks_path, special=special))
    order = ["key", "id", "check", "tokens"]
    ranges = rows.withColumn("check", F.crc32("tokens")).repartitionByRange(*order[:3]).sortWithinPartitions(*order)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (
            (i, np.frombuffer(t.as_py(), STORED))
            for batch in batches
            for i, t in zip(batch.column("id").to_pylist(), batch.column("tokens"))
        )
        out: list[tuple] = []
        names = ["id", "start", "tokens", "doc_tokens", "sequence_id", "offset"]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            ids, starts, tokens, total, seq, offset = zip(*rows)
            ids = [None if i == NO_ID else i for i in ids]
            columns = [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array([t.astype("<u4").tobytes() for t in tokens], pa.binary())]
            return pa.record_batch([*columns, *[pa.array(c, pa.int64()) for c in (total, seq, offset)]], names)

        for row in pack_sorted(stream, length, TaskContext.get().partitionId() << 40):
            out.append(row)
            if len(out) == 4096:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    return ranges.select("id", "tokens").mapInArrow(
        fill, schema("id bigint, start bigint, tokens binary, doc_tokens bigint, sequence_id bigint, offset bigint")
    )


def piece_digests(packed: DataFrame) -> DataFrame:
    return packed.select(
        F.col("id").alias("doc_id"),
        "start",
        (F.octet_length("tokens") / 4).cast("bigint").alias("length"),
        F.crc32("tokens").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(pack(inputs(documents(spark, sf_dir))))
