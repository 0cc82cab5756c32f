"""Alignment of two tokenizers against whole texts, pair by pair."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from chronoreg.llm import alignment, queries
from corpus import by_id, corpus, frame

ODD = ["a", "b", "'s", "é", "ß", " ", "  ", "\n", "\t", "\r", ";\r", " ", "　", "\x85", "1", "23", "!", "…", "日本", "▁", "<|endoftext|>", "<s>", "<0x0A>", "ﬁ", "Å", "\x00", "😀", "́", " the", "ing"]


@pytest.fixture(scope="module")
def whole():
    """Both tokenizers on whole texts, without units."""
    import sentencepiece
    from tokenizers import Tokenizer

    byte_tokenizer, pieces, _ = queries.alignment_paths()
    one = Tokenizer.from_file(byte_tokenizer)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=pieces)
    letters = {c: b for b, c in _letters().items()}

    def tokens(text):
        a = [(i, bytes(letters[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode()) for i, p in ((i, two.id_to_piece(i)) for i in two.encode(text))]
        same = all(b"".join(x for _, x in side) == (" " + text).encode() for side in (a, b))
        return (a, b) if text and same else ([], [])

    return tokens


def _letters():
    """The usual table of byte-level vocabularies."""
    own = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + list(range(ord("®"), ord("ÿ") + 1))
    out, n = {b: chr(b) for b in own}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + n)
            n += 1
    return out


def expected(texts, tokens):
    linked, shown, sizes = {}, {}, {}
    for doc, text in texts.items():
        a, b = tokens(text)
        spans = []
        for side in (a, b):
            ends = np.cumsum([len(x) for _, x in side])
            spans.append([(i, int(e) - len(x), int(e)) for (i, x), e in zip(side, ends)])
        linked[doc] = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        low, groups = 0, []
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if low <= s and e <= cut) for side in spans))
            low = cut
        shown[doc], sizes[doc] = ";".join(groups), (len(a), len(b), len(groups))
    counts = Counter(p for pairs in linked.values() for p in set(pairs))
    most = defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    return counts, {
        doc: (doc, *sizes[doc], len(pairs), sum(counts[p] == most[p[0]] for p in pairs), sum(counts[p] for p in pairs), hashlib.sha256(shown[doc].encode()).hexdigest() if sizes[doc][0] else "")
        for doc, pairs in linked.items()
    }


def rows():
    rng = random.Random(7)
    odd = [(5000 + i, "".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))), 0, "") for i in range(400)]
    return corpus(9) + odd + [(9000, "w" * 3000 + " " * 3000, 0, ""), (9001, " ", 0, ""), (9002, "\n", 0, ""), (9003, " a", 0, "")]


@pytest.mark.parametrize("block_bytes", [1 << 22, 500])
def test_alignment(spark, whole, block_bytes):
    some = rows()
    counts, want = expected(by_id(some), whole)
    got = {r.doc_id: tuple(r) for r in alignment.align(frame(spark, some), *queries.alignment_paths(), block_bytes=block_bytes).collect()}
    assert got == want
    table = {(r.a, r.b): r.documents for r in alignment.pairs(frame(spark, some), *queries.alignment_paths(), block_bytes=block_bytes).collect()}
    assert table == dict(counts)
    assert sum(x[1] == 0 for x in want.values()) > 20 and len(counts) > 400


def test_empty_table(spark):
    assert alignment.align(frame(spark, []), *queries.alignment_paths()).collect() == []
    only = [tuple(r) for r in alignment.align(frame(spark, [(1, None, 0, ""), (2, "", 0, "")]), *queries.alignment_paths()).collect()]
    assert sorted(only) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_merge_of_many_frames():
    """Runs of several frames, with pairs that stand in one run or in all."""
    rng = np.random.default_rng(2)
    runs, total = [], Counter()
    for i in range(9):
        pairs = np.unique(rng.integers(0, 1 << 35, alignment.FRAME * (i % 3) + 5).astype(np.uint64) if i % 2 else np.arange(0, 3 * alignment.FRAME, i + 1).astype(np.uint64))
        documents = rng.integers(1, 9, len(pairs)).astype(np.uint32)
        total.update(dict(zip(pairs.tolist(), documents.tolist())))
        runs.append([f for x in zip(alignment._frames(pairs), alignment._frames(documents)) for f in x])
    parts = list(alignment.merged(runs))
    pairs, counts = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    assert len(parts) > 3 and (np.diff(pairs.astype(np.int64)) > 0).all()
    assert dict(zip(pairs.tolist(), counts.tolist())) == total


def test_long_runs_of_one_character():
    aligner = alignment.Aligner(*queries.alignment_paths())
    for text in (" " * 1_000_000, "\n" * 1_000_000, " " + "a" * 1_000_000):
        n_a, n_b, n_groups, _, pairs = aligner([text.encode()])[0]
        assert n_a and n_b and n_groups and len(pairs) >= max(n_a, n_b)
