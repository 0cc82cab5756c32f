"""Word windows, byte strings and near duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from chronoreg.llm import common, near, repeats, suffix
from corpus import by_id, corpus, frame

WORD = r"[^\x20\x09-\x0D]+"
sha = lambda b: hashlib.sha256(b).hexdigest()


@pytest.mark.parametrize(("seed", "window"), [(1, 13), (2, 13), (2, 40), (3, 56), (1, 5), (1, 2), (2, 1)])
def test_word_windows(spark, seed, window):
    rows = corpus(seed)
    got = {r.doc_id: tuple(r) for r in repeats.digest(frame(spark, rows), window).collect()}
    first, want = {}, {}
    for doc, text in sorted(by_id(rows).items()):
        words = re.findall(WORD, text)
        gone = [False] * len(words)
        for a in range(len(words) - window + 1):
            if first.setdefault(tuple(words[a : a + window]), doc) < doc:
                gone[a : a + window] = [True] * window
        want[doc] = (doc, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g).encode()))
    assert got == want
    assert sum(x[2] for x in want.values()) > 100


def test_candidates_of_each_level(spark, monkeypatch):
    """Passages of 10, 20, 30 and 40 words in two documents each: the longer the windows, the fewer documents are left."""
    assert repeats.lengths(13) == [7] and repeats.lengths(40) == [7, 14, 28] and repeats.lengths(56) == [7, 14, 28]
    rows = [(1000 + i, " ".join(f"x{i}-{j}" for j in range(60)), 0, "") for i in range(5)]
    for n, size in enumerate((10, 20, 30, 40)):
        shared = " ".join(f"s{n}-{j}" for j in range(size))
        rows += [(2 * n + k, " ".join(f"a{n}-{k}-{j}" for j in range(50)) + " " + shared + " " + " ".join(f"b{n}-{k}-{j}" for j in range(50)), 0, "") for k in (0, 1)]
    left, stage = [], common.stage

    def counted(df):
        out = stage(df)
        left.append(out.count())
        return out

    monkeypatch.setattr(common, "stage", counted)
    got = {r.doc_id: r.n_removed for r in repeats.digest(frame(spark, rows), 40).collect()}
    assert len(left) == 3 and left == sorted(left, reverse=True) and 2 <= left[-1] < left[0] <= 8 and {d for d, n in got.items() if n} == {7} and got[7] == 40
    left.clear()
    assert not any(r.n_removed for r in repeats.digest(frame(spark, rows[:5]), 40).collect()) and left == [0]  # ends at once


def test_kept_text_itself(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(1, text, 0, ""), (2, "before " + text + " after", 0, "")]
    got = {r.doc_id: r.kept for r in repeats.remove_repeats(frame(spark, rows)).collect()}
    assert got == {1: text, 2: "before after"}


def _held_bytes(rows, window=50):
    """The contract's columns by a dictionary of all strings."""
    first, want = {}, {}
    for doc, text in sorted(by_id(rows).items()):
        raw = text.encode()
        gone = bytearray(len(raw))
        for a in range(len(raw) - window + 1):
            if first.setdefault(raw[a : a + window], doc) < doc:
                gone[a : a + window] = b"\1" * window
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        want[doc] = (doc, len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept))
    return want


@pytest.mark.parametrize(("seed", "hot"), [(1, suffix.HOT), (2, suffix.HOT), (1, 0), (2, 1), (3, 3)])
def test_byte_strings(spark, seed, hot):
    """With a low bound the windows of all or of most grams are dealt one by one."""
    rows = corpus(seed)
    want = _held_bytes(rows)
    assert {r.doc_id: tuple(r) for r in suffix.digest(frame(spark, rows), hot=hot).collect()} == want
    assert sum(x[2] for x in want.values()) > 1000


def test_a_phrase_in_a_third_of_all_documents(spark):
    """Phrases of 30, 49 and 60 bytes with other text around them in each document: many distinct runs of one gram."""
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz "
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    phrases = [text(30), text(49), text(60)]
    rows = [(i, text(90) + phrases[i % 9] + text(90) if i % 9 < 3 else text(200), 0, "") for i in range(900)]
    rows += [(1000 + i, rows[i][1][40:] + text(20), 0, "") for i in (0, 1, 2, 9, 10)]
    rng.shuffle(rows)
    want = _held_bytes(rows)
    got = {r.doc_id: tuple(r) for r in suffix.digest(frame(spark, rows), hot=20).collect()}
    assert got == want and sum(x[2] >= 60 for x in want.values()) > 90


@pytest.mark.parametrize("alphabet", [b"ab", b"abc\x00\xff"])
def test_deep_shallow_sort(alphabet):
    rng = random.Random(5)
    text = bytes(rng.choice(alphabet) for _ in range(900)) * 2
    places = np.arange(len(text) - 50)
    groups = list(suffix.sorted_groups(np.frombuffer(text, np.uint8), places, 50))
    strings = [text[g[0] : g[0] + 50] for g in groups]
    assert strings == sorted(set(text[p : p + 50] for p in places))
    assert all(text[s : s + 50] == x for g, x in zip(groups, strings) for s in g) and sum(map(len, groups)) == len(places)


def _sets(rows, words=5):
    out = {}
    for doc, text in by_id(rows).items():
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))
        out[doc] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    return out


@pytest.mark.parametrize("similarity", [0.85, 0.8])
def test_near_duplicates(spark, similarity):
    rows = corpus(3, n=90)
    sets = _sets(rows)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= round(100 * similarity) * len(sets[a] | sets[b]):
                one, two = root(a), root(b)
                parent[max(one, two)] = min(one, two)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near.near_duplicates(frame(spark, rows), similarity).collect()}
    assert got == {d: (len(sets[d]), root(d), root(d) == d) for d in sets}
    assert sum(not k for *_, k in got.values()) > 3


def test_chain_of_links_and_hot_copies(spark):
    """Neighbours of a chain are alike, its ends are not; and one text in a third of all rows."""
    words = [f"w{i}" for i in range(260)]
    chain = [(i, " ".join(words[2 * i : 2 * i + 200]), 0, "") for i in range(30)]
    hot = [(100 + i, "the same few words in very many rows " * 3, 0, "") for i in range(40)]
    other = [(500 + i, " ".join(f"{i}-{j}" for j in range(30)), 0, "") for i in range(40)]
    got = {r.doc_id: r.component_id for r in near.near_duplicates(frame(spark, chain + hot + other), 0.85).collect()}
    assert all(got[i] == 0 for i in range(30)) and all(got[100 + i] == 100 for i in range(40)) and all(got[500 + i] == 500 + i for i in range(40))


def test_texts_that_polynomials_modulo_a_power_of_two_confuse(spark):
    """Thue-Morse words and their complements: no shingle in common, no window held before."""
    one = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{one} {rest}", 0, ""), (2, f"{two} {rest}", 0, ""), (3, " ".join([one] * 5), 0, ""), (4, " ".join([two] * 5), 0, "")]
    assert {r.doc_id: r.n_removed for r in repeats.digest(frame(spark, rows)).collect()} == {1: 0, 2: 0, 3: 0, 4: 0}
    assert {r.doc_id: r.component_id for r in near.near_duplicates(frame(spark, rows[2:])).collect()} == {3: 3, 4: 4}


@pytest.mark.parametrize("window", [16, 33, suffix.MOST_WINDOW])
def test_windows_of_other_lengths(spark, window):
    rows = corpus(4, n=30)
    got = {r.doc_id: r.n_removed for r in suffix.digest(frame(spark, rows), window).collect()}
    first, want = {}, {}
    for doc, text in sorted(by_id(rows).items()):
        raw = text.encode()
        gone = bytearray(len(raw))
        for a in range(len(raw) - window + 1):
            if first.setdefault(raw[a : a + window], doc) < doc:
                gone[a : a + window] = b"\1" * window
        want[doc] = sum(gone)
    assert got == want
    with pytest.raises(ValueError):
        suffix.digest(frame(spark, rows), suffix.MOST_WINDOW + 1)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    parts = [np.unique(base[:300]), np.unique(base[100:]), base[:1]]  # the first two share 200 of 400
    rows = near.sketches(np.concatenate(parts), np.cumsum([0, *map(len, parts)]), 600)
    assert abs((rows[0] == rows[1]).mean() - 0.5) < 0.08
    assert (rows != np.uint64(0xFFFFFFFFFFFFFFFF)).all()  # every coordinate is filled, for one element too


def test_near_stage_keeps_columns_and_rows_without_id(spark):
    rows = corpus(4)
    docs = frame(spark, rows)
    out = near.without_near_duplicates(docs)
    assert out.columns == docs.columns and out.where("doc_id IS NULL").count() == 1


@pytest.mark.parametrize("operator", [repeats.digest, suffix.digest, near.near_duplicates])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).collect() == []
