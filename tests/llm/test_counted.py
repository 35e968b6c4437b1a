"""Operators 11 to 13: exact duplicates, phrases, alignment of tokenizers."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm import alignment, exact_dedup, phrases
from tests.llm.conftest import DOCS, ODD, prose


def flat(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def groups_of(rows):
    """(doc_id, keep_id, group_size, kept, sha256) by brute force."""
    by = defaultdict(list)
    for r in rows:
        by[flat(r[1])].append(r[0])
    out = []
    for text, ids in by.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        out += [(i, ids[0], len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest()) for k, i in enumerate(ids)]
    return Counter(out)


def test_cuckoo_filter_holds_what_was_inserted():
    rng = random.Random(1)
    f, hashes = exact_dedup.CuckooFilter(8), [rng.getrandbits(64) for _ in range(900)]
    assert all(f.insert(h) for h in hashes)
    assert all(f.may_hold(h) for h in hashes)
    for h in hashes[:450]:
        f.delete(h)
    assert all(f.may_hold(h) for h in hashes[450:])
    # with 450 of 1,024 places taken, a miss passes with a chance of some 4 in 65,536
    assert sum(f.may_hold(rng.getrandbits(64)) for _ in range(20_000)) < 20
    assert not any(f.held) or sum(1 for x in f.held if x) == 450


def test_bucket_grows_from_its_stored_keys():
    b = exact_dedup.Bucket()
    digests = [hashlib.sha256(str(k).encode()).digest() for k in range(3000)]
    for k, d in enumerate(digests):
        b.insert(d, k, 1)
        b.insert(d, k + 9, 2)
    assert b.filter.log2 >= 10 and len(b.keys) == 3000
    assert all(b.keys[d] == [k, 3, False] for k, d in enumerate(digests))
    for d in digests[:1000]:
        b.delete(d, None, 3)
    assert len(b.keys) == 2000 and all(b.filter.may_hold(b.hash(d)) for d in digests[1000:])
    assert sum(1 for x in b.filter.held if x) == 2000


def same_rows(rng, n):
    return [(rng.choice([None, *range(n)]), rng.choice(["a  b", "a b", "a\tb", "", None, f"t{rng.randrange(9)}"])) for _ in range(n)]


def test_exact_groups_of_odd_rows(spark, make_docs):
    rows = [*ODD, (11, "same  text\ntwice"), (12, " "), (0, ""), *same_rows(random.Random(2), 60)]
    got = Counter(map(tuple, exact_dedup.digest(make_docs(rows)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()))
    assert got == groups_of(rows)


def test_exact_empty_table(make_docs):
    assert exact_dedup.digest(make_docs([])).collect() == []


def test_index_inserts_and_deletes(make_docs):
    rng = random.Random(3)
    first, second = same_rows(rng, 80), same_rows(rng, 80)
    index = exact_dedup.build(make_docs(first), buckets=8)
    index = exact_dedup.insert(index, make_docs(second))
    gone = [first[0], first[3], *second[:30], (999, "never there"), (0, "nor this")]
    index = exact_dedup.delete(index, make_docs(gone))
    left = Counter((i, flat(t)) for i, t in [*first, *second]) - Counter((i, flat(t)) for i, t in gone)
    want = groups_of(list(left.elements()))
    got = exact_dedup.resolve(index).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest"))).collect()
    assert Counter(map(tuple, got)) == want
    keys = index.keys.where("held is null").collect()
    assert sum(k["n"] for k in keys) == sum(left.values())
    # a filter holds one fingerprint for each live key
    held = sum(sum(1 for x in memoryview(r["held"]).cast("H") if x) for r in index.keys.where("held is not null").collect())
    assert held == len(keys)


def test_unequal_texts_of_one_digest_stay_apart(make_docs):
    rows = [(k, f"text {k % 7}") for k in range(40)]
    weak = lambda text: F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 1))  # noqa: E731  16 digests at most
    docs = make_docs(rows)
    got = exact_dedup.resolve(exact_dedup.build(docs, digest_of=weak, buckets=4)).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert Counter(map(tuple, got)) == Counter((k, k % 7, 6 if k % 7 < 5 else 5, k < 7) for k in range(40))


def test_keep_one_keeps_whole_rows(make_docs):
    rows = [(3, "x  y"), (1, "x y"), (1, "x y"), (None, "x y"), (5, "z"), (None, None)]
    out = exact_dedup.keep_one(make_docs(rows))
    assert out.columns == DOCS.names
    assert sorted((r["doc_id"], r["text"]) for r in out.collect() if r["doc_id"] is not None) == [(1, "x y"), (5, "z")]
    assert out.count() == 3


# ---- phrases

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrases_of(rows, least, top, covered=80):
    f = Counter()
    for r in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (r[1] or "").translate(LOW)):
            w = re.findall("[^\x20\x09]+", piece)
            for k in range(1, 5):
                f.update((r[2] or "und", tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    n = Counter()
    for (g, p), a in f.items():
        if len(p) == 1:
            n[g] += a
    c = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    dropped = {(g, p[s:s + k]) for (g, p), a in c.items() for k in range(2, len(p)) for s in range(len(p) - k + 1) if 100 * a >= covered * f[g, p[s:s + k]]}
    out = defaultdict(list)
    for (g, p), a in c.items():
        if (g, p) not in dropped:
            score, _, x, y = min((2_000_000 * a // (f[g, p[:k]] + f[g, p[k:]]), k, f[g, p[:k]], f[g, p[k:]]) for k in range(1, len(p)))
            out[g].append((-score, -a, " ".join(p).encode(), x, y))
    return sorted((g, r + 1, p.decode(), -a, x, y, n[g], -s) for g, rs in out.items() for r, (s, a, p, x, y) in enumerate(sorted(rs)[:top]))


def noisy(seed, docs):
    rng = random.Random(seed)
    words = ["Ab", "aB", "c", "d", "é", "漢字", "ff", "g"]
    ends = [" ", " ", " ", "\t", " \t ", ". ", "\n", "!"]
    return [(k, "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(40))), rng.choice(["en", "fr", None, "und"])) for k in range(docs)]


def found(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize("least,top", [(30, 2000), (5, 7)])
def test_phrases_equal_brute_force(make_docs, least, top):
    rows = [*((*r, None)[:3] for r in ODD if not (r[1] and len(r[1]) > 400_000)), *noisy(4, 120), *[(7, "one passage that is held by many rows", "de")] * 40]
    want = phrases_of(rows, least, top)
    assert want and found(phrases.mine(make_docs(rows), least, top)) == want


def test_phrases_without_rows_or_words(make_docs):
    assert found(phrases.mine(make_docs([]))) == []
    assert found(phrases.mine(make_docs([(1, None), (2, ""), (3, " .,! \n")]))) == []


def test_phrases_do_not_depend_on_chunks(make_docs, monkeypatch):
    rows = noisy(5, 60)
    batch = pa.RecordBatch.from_arrays([pa.array([r[2] or "und" for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"])

    def counted(limit):
        c, n = Counter(), 0
        for x in phrases.chunks(iter([batch.slice(0, 17), batch.slice(17)]), limit):
            n += 1
            rows, times = phrases.merged(phrases.suffixes(x.code, x.follows, np.ones(len(x.words), bool), 3))
            for r, t in zip(rows, times):
                c[tuple((x.langs[k - 1], x.words[k - 1]) if k else None for k in r)] += t
        return c, n
    whole, small = counted(1 << 30), counted(100)
    assert whole[1] == 1 and small[1] > 10 and whole[0] == small[0]


def test_quicksort_counts_prefixes(monkeypatch):
    rng = np.random.default_rng(6)
    words = [rng.integers(0 if d else 1, 12, 20_000).astype(np.int64) for d in range(4)]
    for d in range(1, 4):
        words[d][words[d - 1] == 0] = 0
    weight = rng.integers(1, 4, 20_000)
    want = Counter()
    for row, w in zip(zip(*words), weight):
        for d in range(1, 5):
            if row[d - 1]:
                want[row[:d]] += int(w)
    for cutoff in (4096, 1):
        monkeypatch.setattr(phrases, "SORTED", cutoff)
        for leading in (1, 2, 3):
            got = {tuple(int(words[k][at]) for k in range(d)): n for at, d, n in phrases.frequent_prefixes(words, weight, 25, leading)}
            assert got == {p: n for p, n in want.items() if n >= 25 and len(p) >= leading}


def test_scores_are_exact_beyond_64_bits(spark):
    # the expression of the score on counts whose product passes 64 bits
    a, l, r = 9_000_000_000_000_000_001, 9_000_000_000_000_000_003, 9_000_000_000_000_000_007
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    big = lambda c: F.col(c).cast("decimal(20,0)")
    got = df.select(F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * big("a"), big("l") + big("r")).alias("s")).first()[0]
    assert got == 2_000_000 * a // (l + r)


# ---- alignment

def aligned_by_hand(rows):
    """The contract, token by token."""
    a_path, b_path = alignment.paths()
    p = alignment.load(a_path, b_path)
    a_bytes, b_bytes = p.a_bytes.to_pylist(), p.b_bytes.to_pylist()
    docs, count = [], Counter()
    for i, text in rows:
        whole = (" " + (text or "")).encode()
        a = p.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = p.b.encode(text or "")
        ok = text and b"".join(a_bytes[x] for x in a) == whole and b"".join(b_bytes[x] for x in b) == whole
        groups, links = [], []
        if ok:
            ends = lambda ids, of: np.cumsum([len(of[x]) for x in ids]).tolist()
            ea, eb = ends(a, a_bytes), ends(b, b_bytes)
            links = [(x, y) for x, m in zip(a, ea) for y, n in zip(b, eb) if m == n] if len(a) < 3000 else None
            both = sorted(set(ea) & set(eb))
            if links is None:
                at_a, at_b = dict(zip(ea, a)), dict(zip(eb, b))
                links = [(at_a[m], at_b[m]) for m in both]
            ga = gb = 0
            for m in both:
                za, zb = ea.index(m, ga) + 1, eb.index(m, gb) + 1
                groups.append((a[ga:za], b[gb:zb]))
                ga, gb = za, zb
            count.update(links)
        docs.append((i, len(a) if ok else 0, len(b) if ok else 0, groups, links))
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    text = lambda gs: ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in gs)
    return Counter((i, na, nb, len(gs), len(ls), sum(count[x] == best[x[1]] for x in ls), sum(count[x] for x in ls),
                    hashlib.sha256(text(gs).encode()).hexdigest() if gs else "") for i, na, nb, gs, ls in docs), count


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_equals_brute_force(make_docs):
    rows = [r for r in ODD if not (r[1] and len(r[1]) > 300_000)]
    rows += [(20, "<|endoftext|> <s> </s> <unk> <0x41> ▁ plain"), (21, "a\u0000b▁c"), (22, "  two  spaces "), (23, " nbsp　wide"), (24, "é ﬁ ½"),
             (25, "the cat sat on the mat, the end."), (26, "the cat sat on the mat, the end."), (27, "don't 12345 O'Neill naïve 😀👩‍👩‍👧 \r\n\ttab")]
    rows += [(30 + k, prose(k, 50)) for k in range(20)]
    want, count = aligned_by_hand(rows)
    docs = make_docs(rows)
    assert Counter(map(tuple, alignment.align(docs).select(*ALIGNED).collect())) == want
    assert {(r["a"], r["b"]): r["n"] for r in alignment.pair_counts(docs).collect()} == count


def test_alignment_encodes_a_stretch_once(monkeypatch):
    """Stretches between single spaces give the ids of whole texts, a known
    one is not encoded again, and what is known stays bounded."""
    p = alignment.load(*alignment.paths())
    assert p.apart
    rng = np.random.default_rng(5)
    marks = [" ", " ", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\ufeff", "\u200b", "\x00", "'s", "'", "don't", "a", "word", "B",
             "12", "3", "é", "e\u0301", "\u0301", "ﬁ", "½", "漢字", "😀", "<|endoftext|>", "</s>", "<0x41>", ".", "...", "-", "_"]
    texts = ["".join(rng.choice(marks, rng.integers(1, 40))) for _ in range(2000)]
    whole = [p.a.encode(" " + t, add_special_tokens=False).ids for t in texts], [p.b.encode(t) for t in texts]
    for bound in (1 << 21, 500):
        monkeypatch.setattr(alignment, "KNOWN_BYTES", bound)
        known = alignment.Stretches(p)
        for lo in range(0, 2000, 250):
            for (ids, at), want in zip(known.encode(texts[lo:lo + 250]), whole):
                assert [ids[i:j].tolist() for i, j in zip(at, at[1:])] == want[lo:lo + 250]
            assert known.size <= bound + sum(map(len, texts[lo:lo + 250]))
    known = alignment.Stretches(p)
    known.encode(["the cat sat on the mat and the cat sat"])
    assert list(known) == ["the", "cat", "sat", "on", "mat", "and"]
    known.encode(["the mat  and\tthe cat"])
    assert list(known)[6:] == ["mat  and\tthe"]
    assert [x.tolist() for x in known.encode([])[0]] == [[], [0]]


def test_alignment_of_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want, _ = aligned_by_hand([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert Counter(map(tuple, alignment.digest(docs).select(*ALIGNED).collect())) == want


def test_alignment_without_tokens(make_docs):
    assert alignment.align(make_docs([])).collect() == []
    assert [tuple(r)[1:] for r in alignment.align(make_docs([(1, None), (2, "")])).select(*ALIGNED).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_identity_map_leaves_out_bytes_that_b_has_twice():
    assert alignment.identity([b"a", b"b", b"", b"c"], [b"", b"a", b"c", b"a"]).tolist() == [-1, -1, -1, 2]


def test_groups_by_ends():
    a, b = alignment.groups(np.array([2, 1, 3]), np.array([1, 2, 1, 2]))
    assert a.tolist() == [False, True, True] and b.tolist() == [False, True, False, True]
    rng = np.random.default_rng(7)
    for _ in range(200):
        cut = lambda n: np.diff(np.concatenate(([0], np.sort(rng.choice(np.arange(1, 60), n, replace=False)), [60])))
        x, y = cut(rng.integers(0, 30)), cut(rng.integers(0, 30))
        i, j = alignment.groups(x, y)
        assert set(np.cumsum(x)[i]) == set(np.cumsum(y)[j]) == set(np.cumsum(x)) & set(np.cumsum(y))
