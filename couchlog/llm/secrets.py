"""Secret scan: fixed patterns, plus strings that are new to a compressor primed with their surroundings.

A candidate is a run of at least `min_length` token characters with a word of a sensitive context
within `near` characters on either side, line breaks included (a word that is part of the run itself
does not count); runs joined by dots, such as the parts of a JWT, share their context, and all runs of
a PEM block whose label has such a word are candidates. Every candidate is measured. Its novelty is
its marginal compressed size: the zstandard frame of the surroundings and the candidate, less the
frame of the surroundings, both primed with a dictionary of identifiers and of parts of words. How
far letters as such shrink depends on the surroundings, so the novelty is held against that of the
same characters shuffled: names and words lose what makes them known, keys and hashes have nothing to
lose. A candidate of at least `min_size` bytes a character that reaches `min_novelty` of its shuffled
form is reported as kind `novel`, unless a base span covers it. `Context` holds all of these settings.

Defined cases: a null or empty text has no span; a very long text is read whole, in time proportional
to its length; rows are independent, so null ids and repeated rows play no part; other columns are
kept, one that has the name of the result (in any case) is replaced; positions count code points, the
end is exclusive; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from random import Random

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from couchlog.llm.common import documents, schema

# The base patterns, in the order in which kinds are listed.
BASE = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
# Least length of the value (assign) or of the match.
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = [*BASE, "novel"]

# Names that code and configuration are made of; the compressor knows them beforehand.
IDENTIFIERS = """
password passwd secret token api_key apikey access_key secret_key client_id client_secret private_key
public_key authorization bearer basic credentials session cookie username user email account login
config configuration settings environment variable default value string integer boolean float double
import export return function class public private protected static final const void null none true
false self this new delete insert update select from where order group join values table index
http https www com org net localhost example index.html application/json text/plain utf-8 content-type
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef
aaaaaaaaaaaaaaaa xxxxxxxxxxxxxxxx 0000000000000000 ----------------
"""

# Endings, beginnings and stems that long words and names are made of.
WORD_PARTS = """
able ible ally ance ence ated ation ational ative ator ers est ful fulness ical ify ings ions ious ise ism istic
ities ity ive ization ize less lessness ments ness ology ography ous ship tions ture ward wise
anti auto com con contra counter dis extra hyper inter macro micro mis multi non over para photo post pre pro
pseudo semi sub super tele thermo trans ultra under uni
act count cover develop duct electro fact form graph ground hand head hold know light line manage mark meter nation
normal object open order part place play port press quest record refer report respons scribe serv sign spect stand
struct tain tend tract turn vent verse view work write
"""

# Words that make a context sensitive.
SENSITIVE = (
    r"(?i:passw|passphrase|(?<![a-z])pass(?![a-z])|pwd|secret|token|(?:api|access)_?key|credential|private|bearer"
    r"|auth(?!ors?(?![a-z]))|signature|cookie|session)"
)


@dataclass(frozen=True)
class Context:
    """What is measured, and against what."""

    words: str = SENSITIVE  # a regular expression
    near: int = 48
    min_length: int = 16
    min_size: float = 0.5  # compressed bytes a character: less is a repeated or known string
    min_novelty: float = 0.92  # of the same characters shuffled: random keys have 0.95 to 1
    around: int = 256
    identifiers: str = IDENTIFIERS + WORD_PARTS


DEFAULT = Context()

_PATTERNS = {kind: re.compile(p, re.ASCII) for kind, p in BASE.items()}
# 32 lower-case hex digits in a row: a cheap test before every match of the open pattern is looked at.
_HEX = re.compile(r"[0-9a-f]{32,}", re.ASCII)
_DOTTED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]+={0,2}(?:\.[A-Za-z0-9+/_-]+={0,2})+", re.ASCII)
_PEM_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----", re.ASCII)
_PEM_END = re.compile(r"-----END ([A-Z0-9 ]+)-----", re.ASCII)
# Where the end line is missing: the first character that no line of a block has.
_PEM_OVER = re.compile(r"-----END |[^A-Za-z0-9+/=\s\\:,.\"'-]", re.ASCII)


@cache
def _patterns(words: str, min_length: int) -> tuple[re.Pattern, re.Pattern]:
    run = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}" % min_length
    return re.compile(words, re.ASCII), re.compile(run, re.ASCII)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Leftmost non-overlapping matches of each kind that are long enough."""
    spans = []
    for m in _PATTERNS["assign"].finditer(text):
        if len(m[1]) >= LEAST["assign"]:
            spans.append((m.start(), m.end(), "assign"))
    for m in _PATTERNS["access"].finditer(text) if "AKIA" in text else ():
        if len(m[0]) >= LEAST["access"]:
            spans.append((m.start(), m.end(), "access"))
    spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return spans


class Novelty:
    """Marginal compressed bytes under a dictionary of identifiers."""

    def __init__(self, identifiers: str = DEFAULT.identifiers):
        primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._compressor = zstandard.ZstdCompressor(level=9, dict_data=primed, write_checksum=False, write_content_size=False)

    def __call__(self, candidate: str, around: str) -> int:
        known = around.encode(errors="surrogatepass")
        size = len(self._compressor.compress(known + candidate.encode(errors="surrogatepass")))
        return size - len(self._compressor.compress(known))

    def is_new(self, candidate: str, around: str, context: Context = DEFAULT) -> bool:
        size = self(candidate, around)
        if size < context.min_size * len(candidate):
            return False
        shuffled = "".join(Random(len(candidate)).sample(candidate, len(candidate)))
        return size >= context.min_novelty * self(shuffled, around)


def _pem_blocks(text: str, sensitive: re.Pattern) -> list[tuple[int, int]]:
    """From begin line to end line, of blocks with a sensitive word in their label."""
    ends: dict[str, list[int]] = {}
    for m in _PEM_END.finditer(text):
        ends.setdefault(m[1], []).append(m.start())
    blocks, at = [], 0
    while m := _PEM_BEGIN.search(text, at):
        own = ends.get(m[1], [])
        k = bisect_left(own, m.end())
        if k < len(own):
            end = own[k]
        else:
            over = _PEM_OVER.search(text, m.end())
            end = over.start() if over else len(text)
        at = max(m.end(), end)
        if sensitive.search(m[1]):
            blocks.append((m.start(), at))
    return blocks


def candidates(text: str, context: Context = DEFAULT) -> Iterator[tuple[int, int]]:
    """Runs of token characters in a sensitive context, in order."""
    sensitive, run = _patterns(context.words, context.min_length)
    words = [m.span() for m in sensitive.finditer(text)]
    if not words:
        return
    starts, near = [s for s, _ in words], context.near
    dotted = [m.span() for m in _DOTTED.finditer(text)]
    blocks = _pem_blocks(text, sensitive) if "-----BEGIN " in text else []
    i = j = 0
    for m in run.finditer(text):
        start, end = low, high = m.span()
        while i < len(dotted) and dotted[i][1] <= start:
            i += 1
        if i < len(dotted) and dotted[i][0] <= start:
            low, high = dotted[i]
        while j < len(blocks) and blocks[j][1] <= start:
            j += 1
        before, after = bisect_left(starts, start) - 1, bisect_left(starts, end)
        close = before >= 0 and words[before][1] >= low - near or after < len(words) and starts[after] <= high + near
        if close or (j < len(blocks) and blocks[j][0] <= start):
            yield start, end


def novel_spans(text: str, base: list[tuple[int, int, str]], novelty: Novelty, context: Context = DEFAULT) -> list[tuple[int, int, str]]:
    """Incompressible strings in a sensitive context that no base span covers."""
    spans = []
    base = sorted(base)
    k = covered = 0
    for start, end in candidates(text, context):
        while k < len(base) and base[k][0] <= start:
            covered = max(covered, base[k][1])
            k += 1
        if end <= covered:
            continue
        around = text[max(0, start - context.around) : start] + " " + text[end : end + context.around]
        if novelty.is_new(text[start:end], around, context):
            spans.append((start, end, "novel"))
    return spans


def listed(spans: list[tuple[int, int, str]]) -> str:
    """kind:start:end by start, then kind as listed."""
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def scan_secrets(docs: DataFrame, text_col: str = "text", context: Context = DEFAULT, into: str = "secrets") -> DataFrame:
    """All rows and columns of `docs`, plus `into`: an array of (kind, start, end)."""
    spans_type = "array<struct<kind: string, start: int, end: int>>"
    out = docs.drop(into)
    names = out.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(context.identifiers)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = []
            for text in batch.column(names.index(text_col)):
                text = text.as_py() or ""
                base = base_spans(text)
                spans = sorted(base + novel_spans(text, base, novelty, context), key=lambda x: (x[0], KINDS.index(x[2])))
                found.append([{"kind": k, "start": s, "end": e} for s, e, k in spans])
            yield pa.record_batch([*batch.columns, pa.array(found, kind)], [*names, into])

    return out.mapInArrow(scan, schema(f"{fields}, `{into}` {spans_type}"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [[(x["start"], x["end"], x["kind"]) for x in row] for row in batch.column("secrets").to_pylist()]
        base = [[x for x in row if x[2] in BASE] for row in rows]
        counts = [pa.array([sum(x[2] == kind for x in row) for row in base], pa.int64()) for kind in BASE]
        digests = [hashlib.sha256(listed(row).encode()).hexdigest() for row in base]
        yield pa.record_batch(
            [batch.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array([listed(r) for r in rows], pa.string())],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "secrets").mapInArrow(
        _digest, schema("doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
    )
