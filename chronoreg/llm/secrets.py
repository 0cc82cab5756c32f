"""Secret scans by patterns and by dictionary-primed zstandard novelty.

The patterns find assignments, access keys and long hexadecimal runs. Novelty adds what no pattern names: a candidate
is a long run of token characters with letters and digits close behind a sensitive word, or behind such a run with only
dots, quotes or white space between (the lines of a key, the parts of a JWT). Of a run that a pattern matches in part
the rest is a candidate. Its novelty is the number of
bytes that zstandard needs on top of the surrounding text, when it already knows a dictionary of identifiers (fixed
ones and those that are frequent in the corpus). An identifier, a path or a string that repeats itself costs next to
nothing; a random string costs most of its length and is reported, as often as it stands near a sensitive word: its
copies are taken out of the surrounding text.

Rows are judged alone, so a task holds one slice of a batch at a time and nothing is shuffled but the identifier counts.
Defined results: a null or empty text has no spans; repeated rows and ids each give their own row, a null doc_id too;
columns other than doc_id and text are ignored by :func:`find_secrets` and kept by :func:`redact_secrets`.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoreg.llm import common

# Kinds in the order in which ties are listed, and the patterns of the base kinds.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LEAST = 16
HEX_LEAST = 32
# Words that make a context sensitive, and common identifiers of code.
SENSITIVE = ("access", "api", "auth", "bearer", "cert", "client", "cred", "key", "pass", "private", "pwd", "secret", "sign", "token")
IDENTIFIERS = (
    "access_key_id api_key authorization base64 bearer buffer client_id client_secret config connection_string "
    "const container context credentials database default description document element encoding environment example "
    "export function header hostname identifier import index integer interface language length localhost message "
    "module namespace number object parameter password private protected public request response return secret_key "
    "server session signature static string template timestamp token username value version"
)

#: Characters around a candidate that prime the compressor, and how close the sensitive word must be.
CONTEXT = 256
NEAR = 48
#: A candidate's least length, and the least novel bytes per character.
LEAST = 20
NOVELTY = 0.55
#: The least length of what is left of a candidate beside a base span, to be measured.
REST = 8
#: Identifiers of the corpus in the dictionary: the most frequent ones.
DICTIONARY_SIZE = 512

_assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_access = re.compile(ACCESS)
# A run of [0-9a-f]+ is greedy, so asking for the least length at once finds the same runs.
_hex = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)
_candidate = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
_sensitive = re.compile("|".join(SENSITIVE), re.IGNORECASE | re.ASCII)
_mixed = re.compile(r"(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])")
#: What may stand between adjoining candidates (the backslash is a line end's in a quoted string), a short part of a
#: dotted token too; and the last line of a key block.
_gap = re.compile(r"""[.\s"'`\\]+|\.[A-Za-z0-9+/_=-]+\.""")
_last_line = re.compile(r"""["'\s\\]{1,8}([A-Za-z0-9+/=]{1,76})["'\s\\]{1,8}n?-----END""")
_splits = [re.compile(r"="), re.compile(r"[^A-Za-z0-9]")]

SPANS = "array<struct<kind:string,start:long,end:long>>"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points of the patterns' matches; matches that are too short are dropped."""
    found = [(m.start(), m.end(), "assign") for m in _assign.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), m.end(), "access") for m in _access.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in _hex.finditer(text)]
    return found


def _around(text: str, start: int, end: int) -> str:
    """What stands around text[start:end], without its copies: a secret that stands twice is none the less one.

    A copy may have another name or prefix before it, so the candidate's own long parts are looked for as well.
    """
    own = text[start:end]
    parts = {own} | {x for split in _splits for x in split.split(own) if len(x) >= LEAST and _mixed.match(x)}
    # Copies that the context's edge cuts are found too; each is blanked in its place, so the edge stays where it is.
    before, after = text[max(0, start - CONTEXT - len(own)) : start], text[end : end + CONTEXT + len(own)]
    for part in sorted(parts, key=lambda x: (-len(x), x)):
        reach, blank = CONTEXT + len(part), "\0" * len(part)  # a copy farther away does not touch the context
        before, after = before[-reach:].replace(part, blank), after[:reach].replace(part, blank)
    return (before[-CONTEXT:] + after[:CONTEXT]).replace("\0", "")


def _outside(start: int, end: int, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The parts of start..end outside the base spans; the name before an assignment is none."""
    parts = []
    for s, e, kind in [*sorted(x for x in base if start < x[1] and x[0] < end), (end, end, "")]:
        if start < min(s, end) and kind != "assign":
            parts.append((start, min(s, end)))
        start = max(start, e)
    return parts


def _goes_on(text: str, start: int, end: int, base: list[tuple[int, int, str]]) -> bool:
    """Whether a part too short to be measured carries on the letters and digits of a key or hexadecimal run."""
    beside = any(kind != "assign" and (e == start or s == end) for s, e, kind in base)
    return beside and end - start < REST and text[start:end].isalnum()


class _Taken:
    """The base spans of a text. Those of a kind don't overlap, so the ones that a stretch meets are found by bisection."""

    def __init__(self, spans: list[tuple[int, int, str]]):
        self._kinds = [sorted(x for x in spans if x[2] == kind) for kind in KINDS]
        self._ends = [[e for _, e, _ in own] for own in self._kinds]

    def overlapping(self, start: int, end: int) -> list[tuple[int, int, str]]:
        found = []
        for own, ends in zip(self._kinds, self._ends, strict=True):
            at = bisect_right(ends, start)
            while at < len(own) and own[at][0] < end:
                found.append(own[at])
                at += 1
        return found


class Novelty:
    """Measures marginal compressed bytes with one dictionary."""

    def __init__(self, identifiers: list[str]):
        words = " ".join([*identifiers, IDENTIFIERS]).encode()
        primed = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._compressor = zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False, write_checksum=False)

    def marginal(self, around: str, candidate: str) -> int:
        base = len(self._compressor.compress(around.encode("utf-8", "surrogatepass")))
        return len(self._compressor.compress((around + candidate).encode("utf-8", "surrogatepass"))) - base

    def novel(self, text: str, start: int, end: int) -> bool:
        own = text[start:end]
        # A long candidate is judged by its incompressible share, so its own repetitions count against it.
        return bool(_mixed.match(own)) and self.marginal(_around(text, start, end), own) >= NOVELTY * len(own)

    def spans(self, text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        found: set[tuple[int, int, str]] = set()
        sensitive, last = False, 0
        base_of = _Taken(taken).overlapping
        for m in _candidate.finditer(text):
            start, end = m.span()
            # The lines of a key and the parts of a dotted token share the sensitive word before the first of them.
            sensitive = sensitive and bool(_gap.fullmatch(text, last, start)) or bool(_sensitive.search(text, max(0, start - NEAR), start))
            last = end
            if not sensitive or not _mixed.match(m[0]):
                continue
            base = base_of(start, end)
            if not base:
                found |= {(start, end, "novel")} if self.novel(text, start, end) else set()
            for s, e in _outside(start, end, base) if base else ():
                found |= {(s, e, "novel")} if _goes_on(text, s, e, base) or e - s >= REST and self.novel(text, s, e) else set()
            # A key block's last line may be too short to be a candidate.
            if (base or (start, end, "novel") in found) and (rest := _last_line.match(text, end)):
                found |= {(s, e, "novel") for s, e in _outside(*rest.span(1), base_of(*rest.span(1)))}
        return sorted(found)


def _ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def corpus_identifiers(docs: DataFrame, size: int = DICTIONARY_SIZE) -> list[str]:
    """The most frequent joined identifiers (two words and more, of 8 to 64 characters) of all texts; `size` at most reach the driver."""
    rows = (
        docs.select(F.explode(F.expr(r"regexp_extract_all(text, '[A-Za-z]+(?:_[A-Za-z]+)+', 0)")).alias("word"))
        .where("length(word) BETWEEN 8 AND 64")
        .groupBy("word")
        .count()
        .where("count > 1")
        .orderBy(F.desc("count"), "word")
        .limit(size)
    )
    return [r.word for r in reversed(rows.collect())]  # zstandard reaches the end of a dictionary most cheaply


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row; spans are (kind, start, end) in code points by start, then kind."""
    identifiers = corpus_identifiers(docs)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(identifiers)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for part in common.slices(batches):
            rows = []
            for text in part.column(1).to_pylist():
                spans = base_spans(text or "")
                spans += novelty.spans(text or "", spans)
                rows.append([{"kind": k, "start": s, "end": e} for s, e, k in _ordered(spans)])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(kernel, f"doc_id long, spans {SPANS}")


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every span of text replaced by a mark, and n_chars counted anew where it exists."""
    identifiers = corpus_identifiers(docs)
    at = docs.columns.index("text")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(identifiers)
        for part in common.slices(batches):
            out = []
            for text in part.column(at).to_pylist():
                if text:
                    spans = base_spans(text)
                    spans += novelty.spans(text, spans)
                    pieces, last = [], 0
                    for start, end, _ in _ordered(spans):
                        if start >= last:
                            pieces += [text[last:start], mark]
                        last = max(last, end)
                    text = "".join([*pieces, text[last:]])
                out.append(text)
            columns = list(part.columns)
            columns[at] = pa.array(out, part.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    out = docs.mapInArrow(kernel, docs.schema)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from find_secrets()."""
    joined = lambda spans: f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    count = lambda kind: f"CAST(size(filter(spans, s -> s.kind = '{kind}')) AS LONG) AS n_{kind}"
    return found.selectExpr(
        "doc_id", count("assign"), count("access"), count("hex"),
        f"sha2({joined('''filter(spans, s -> s.kind <> 'novel')''')}, 256) AS base_sha256",
        f"{joined('spans')} AS spans",
    )
