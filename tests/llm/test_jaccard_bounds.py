"""Hashes, bitmaps and candidate growth of the n-gram Jaccard join."""

import random

import numpy as np
import pyarrow as pa
import pytest

from framelake.llm import jaccard, text_hash
from tests.llm.conftest import prose


def thue_morse(n, one, two):
    return "".join(two if bin(k).count("1") % 2 else one for k in range(n))


def test_words_of_equal_polynomials_stay_apart(make_docs):
    """Two words of 1,024 letters that agree under every polynomial modulo 2**64."""
    x, y = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    s = next(text_hash.slices(pa.array([f"{x} {y}"])))
    plain, chained = text_hash.words(s).hash, text_hash.words(s, seed=0).hash
    assert plain[0] == plain[1] and chained[0] != chained[1]
    rows = [(1, "x y z " + x), (2, "x y z " + y), (3, "x y z " + x)]
    got = {r.doc_id: r.component_id for r in jaccard.join(make_docs(rows), 4, 85).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_chained_hash_tells_parts_apart():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 3, 5000, dtype=np.uint8)
    start = rng.integers(0, 4900, 3000)
    end = start + rng.integers(0, 60, 3000)
    for seed in (0, 9):
        h = text_hash.chained_hash(data, start, end, seed)
        by = {}
        for a, z, v in zip(start, end, h.tolist()):
            by.setdefault(data[a:z].tobytes(), set()).add(v)
        assert all(len(v) == 1 for v in by.values())
        assert len({v for (v,) in by.values()}) == len(by)
    assert (text_hash.chained_hash(data, start, end, 0) != text_hash.chained_hash(data, start, end, 1)).all()


def test_bitmaps_never_overstate_what_is_missing():
    rng = np.random.default_rng(2)
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 700))) for _ in range(2))
        only_a, only_b = jaccard.missing(jaccard.bitmap(a), jaccard.bitmap(b))
        assert only_a <= len(np.setdiff1d(a, b)) and only_b <= len(np.setdiff1d(b, a))


@pytest.fixture
def counted(monkeypatch):
    """Rows of the tables that a join writes."""
    seen, cut = {}, jaccard.cut

    def counting(df, name):
        out = cut(df, name)
        seen[name] = out.count()
        return out
    monkeypatch.setattr(jaccard, "cut", counting)
    return seen


def group(seed, copies, words=60):
    """Texts that share half of their words with one another: each pair is a
    candidate by its common part, and none reaches the threshold."""
    rng = random.Random(seed)
    shared = prose(seed, words).split()
    return [" ".join(shared + prose(seed * 1000 + k + 1, words // 3).split() if rng.random() < 2 else shared) for k in range(copies)]


def test_pairs_grow_with_the_rows(make_docs, counted):
    """Five times the rows, in groups five times as large: at most six times
    the pairs that are verified."""
    def rows(copies):
        texts = [t for g in range(4) for t in group(g + 1, copies)]
        texts += [prose(900, 80) + f" {prose(901 + k, 2)}" for k in range(copies)]            # near copies of one text
        return list(enumerate(texts + [prose(5000 + k, 40) for k in range(copies)]))
    some = {}
    for copies in (12, 60):
        got = jaccard.join(make_docs(rows(copies)), 5, 80).collect()
        near = {r.component_id for r in got if 4 * copies <= r.doc_id < 5 * copies}
        assert near == {4 * copies}
        some[copies] = counted["jaccard-star"] + counted["jaccard-pairs"]
    assert some[60] <= 6 * max(some[12], 1)
