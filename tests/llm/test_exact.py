"""Operators with a contract, against brute force over odd rows."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from framelake.llm import decontaminate, jaccard, packing, pii, simhash, substrings
from tests.llm.conftest import ODD, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def brute_substrings(rows, length):
    seen = Counter(t[i:i + length] for _, t in rows for i in range(len(t) - length + 1))
    out = []
    for k, t in rows:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = 1
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((k, len(t), int(gone.sum()), int((np.diff(np.concatenate(([0], gone))) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def substring_rows():
    a, b = prose(1, 400), prose(2, 300)
    near = a[:900] + "#" + a[901:1500] + "@@" + a[1500:]
    return [*[r for r in ODD if r[0] not in (6, 7)], (20, a), (21, a), (22, near), (23, b + a[200:800]), (24, "ab" * 700), (25, "q" * 399), (26, "q" * 400), (27, b[:350] + "é" + b[350:]),
            (28, a[:400]), (29, a[1:400]), (30, "z" * 1000)]


def test_substrings(make_docs):
    rows = substring_rows()
    got = rows_of(substrings.digest(make_docs(rows)))
    assert got == brute_substrings([(k, (t or "").encode()) for k, t in rows], 400)


def test_substrings_across_parts_of_a_long_text(make_docs, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK", 700)
    rows = [(1, prose(5, 700)), (2, "intro " + prose(5, 700)[500:3000]), (3, prose(6, 500))]
    texts = [t.encode() for _, t in rows]
    units = []
    import pyarrow as pa
    for d, t in enumerate(texts):
        for data, _, offset, first, last in substrings.blocks(pa.array([t.decode()]), 400):
            q, a, lo, hi, tier = substrings.find_units(data, first, last, 400)
            core, hull, a, lo, hi, tier, _ = substrings.split_units(q, a, lo, hi, tier, 1, 400)
            units += [(int(c), d, int(x - y + offset[0])) for c, x, y in zip(core, a, lo)]
    assert len(units) == sum(len(t) - 399 for t in texts)            # every window start once
    seen = Counter(u[0] for u in units)
    truth = Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
    assert all((seen[c] > 1) == (truth[texts[d][i:i + 400]] > 1) for c, d, i in units)


def brute_components(rows, n, part, whole):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and whole * len(a & b) >= part * len(a | b):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (k, _), x in zip(rows, label):
        if k is not None:
            least[x] = min(k, least.get(x, k))
    return sorted(((k, len(s), None if k is None else least[x] if s else k) for (k, _), s, x in zip(rows, sets, label)), key=repr)


def near_rows():
    base = prose(3, 120).split()
    rows = [*ODD]
    for k in range(100, 160):                          # copies of growing distance, in a chain
        w = list(base)
        for j in range(k % 7):
            w[(k * 13 + j * 29) % len(w)] = f"w{k}{j}"
        rows.append((k, " ".join(w)))
    rows += [(200 + k, " ".join(base[:60] + prose(k, 60).split())) for k in range(40)]        # one shared passage
    return rows


@pytest.mark.parametrize("n,part", [(4, 85), (5, 80)])
def test_jaccard(make_docs, n, part):
    rows = near_rows()
    assert rows_of(jaccard.join(make_docs(rows), n=n, part=part)) == brute_components(rows, n, part, 100)


def test_jaccard_cells_over_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL", 8)
    monkeypatch.setattr(jaccard, "COMMON", 4)
    rows = near_rows()
    assert rows_of(jaccard.join(make_docs(rows), n=4, part=85)) == brute_components(rows, 4, 85, 100)


def test_keep_one(make_docs):
    rows = near_rows()
    kept = jaccard.keep_one(make_docs(rows))
    assert kept.columns == make_docs(rows).columns
    part = brute_components(rows, 5, 80, 100)
    want = Counter(k for k, s, c in part if not s or k is None) + Counter({k for k, s, c in part if s and k is not None and k == c})
    assert Counter(r["doc_id"] for r in kept.collect()) == want


def brute_hits(rows, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(LOWER))
    wins = {}
    for k, t in items:
        w = split(t)
        for i in range(len(w) - min(13, len(w)) + 1) if w else ():
            wins.setdefault(tuple(w[i:i + 13]), set()).add("null" if k is None else str(k))
    out = []
    for k, t in rows:
        w, hit, names = split(t), set(), set()
        for size in {len(x) for x in wins}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in wins:
                    hit.update(range(i, i + size))
                    names |= wins[tuple(w[i:i + size])]
        out.append((k, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [decontaminate.MAX_BROADCAST_WINDOWS, 1])
def test_decontaminate(spark, make_docs, monkeypatch, limit):
    monkeypatch.setattr(decontaminate.scan, "__defaults__", (13, limit))
    item = prose(11, 30)
    items = [(1, item), (2, "Short item"), (3, None), (4, ""), (2, "Short item"), (None, prose(12, 13)), (10, prose(13, 13).upper())]
    rows = [*[r for r in ODD if r[0] != 6], (50, "Zz " + item + " end"), (51, prose(9, 3000) + " " + item), (52, "a SHORT, item!"), (53, prose(12, 13)), (54, prose(13, 13)), (55, " ".join(item.split()[:12]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(decontaminate.digest(make_docs(rows), bench)) == brute_hits(rows, items)
    kept = decontaminate.remove(make_docs(rows), bench)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(k for k, _, _, _, _, bad in brute_hits(rows, items) if not bad)
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove(make_docs(rows), bench, mode="spans").collect()}
    assert cut[50] == "Zz  end" and cut[52] == "a !" and cut[1] is None and cut[5] == rows[6][1]


def brute_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for kind, pattern in (("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m.group())
            if (8 <= len(d) <= 15) if kind == "phone" else (16 <= len(d) <= 19 and pii.luhn(d)):
                out.append((kind, *m.span()))
    return out


PERSONAL = ["a@b.c", "x@y@z.org, a@b", "me@ex-ample.co.uk.", "1.2.3.4.5.6.7.8 and 999.1.1.1 1.2.3.256", "00.01.002.0003", "4111 1111 1111 1111", "4111-1111-1111-11112", "7536784127813050 4845168114407329",
            "+1 (301) 555-0346", "+12345", "+1+2 333 4444 55", "é +49 30 1234567 ü", "@ @@ .@. a@.b", "9" * 50, "1." * 20, "tel (017) 555-7713", "mail joe (at) example (dot) com", "+1 (826) 555-4081 190.137.223.204"]


def test_pii(make_docs):
    rows = [*[r for r in ODD if r[0] != 7], *enumerate(PERSONAL, 100)]
    got = {(r["doc_id"], r["base_sha256"]): r for r in pii.digest(make_docs(rows)).collect()}
    for k, t in rows:
        base = brute_spans(t or "")
        joined = ",".join(f"{a}:{b}:{c}" for a, b, c in base)
        r = got[(k, hashlib.sha256(joined.encode()).hexdigest())]
        assert [r[f"n_{x}"] for x in pii.KINDS] == [sum(s[0] == x for s in base) for x in pii.KINDS]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))
    spans = {r["doc_id"]: r["spans"] for r in got.values()}
    assert spans[107] == "card:0:16,card:17:33"              # two cards that the base pattern takes for one number
    masked = {r["doc_id"]: r for r in pii.mask(make_docs(rows)).collect()}
    assert masked[102]["text"] == "<EMAIL>." and masked[102]["n_chars"] == 8 and masked[1]["text"] is None and masked[5]["text"] == ODD[6][1]


def test_pii_is_linear():
    text = "a" * 200_000 + "@" + "1." * 100_000 + "9" * 200_000 + "+1" + "(" * 100_000
    assert [s[:2] for s in pii.base_spans(text)][0] == ("email", 0)


def test_packing(make_docs):
    import public_tokenizers
    from tokenizers import Tokenizer
    rows = [*ODD, (60, "a <|endoftext|> b"), *[(300 + k, prose(k, 40 * (k % 37) + 1)) for k in range(120)]]
    got = packing.digest(make_docs(rows)).toPandas()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for k, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids), 2048), len(ids)] if len(ids) > 2048 else [0, len(ids)]
        import zlib
        for n, (a, z) in enumerate(zip(cuts, cuts[1:])):
            want[(k, n, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes()))] += 1
    assert Counter((None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()) == want
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g["offset"].to_numpy() == np.cumsum(g["length"].to_numpy()) - g["length"].to_numpy()).all() and g["length"].sum() <= 2048
    assert got["sequence_id"].nunique() == -(-int(got["length"].sum()) // 2048)


def test_packing_in_groups(make_docs, monkeypatch):
    rows = [(k, prose(k, 30 + k)) for k in range(150)]
    pieces = packing.tokenize(make_docs(rows))
    one, many = packing.pack(pieces).toPandas(), packing.pack(pieces, group_tokens=8000).toPandas()
    assert len(one) == len(many) == len(rows) and many.groupby("sequence_id")["length"].sum().max() <= 2048
    assert many["sequence_id"].nunique() <= one["sequence_id"].nunique() + 2


def test_swaps_empty_bins():
    bins = packing.Bins([600, 500, 500, 400, 400, 300, 300], 1000)
    bins.items, bins.fill = [[0, 5], [1, 3], [2, 4], [6]], [900, 900, 900, 300]
    bins.improve()
    assert sorted(sum(bins.items, [])) == list(range(7)) and sum(bool(b) for b in bins.items) == 3


def test_fingerprints(make_docs):
    rows = [*ODD, (400, prose(1, 200)), (401, prose(2, 200)), (402, prose(1, 200))]
    got = simhash.digest(make_docs(rows)).toPandas()
    assert len(got) == len(rows)
    have = {(k, t or "") for k, t in rows}
    order = sorted((t or "" for k, t in rows if k is not None and k >= 9), key=lambda t: min(k for k, x in have if k is not None and k >= 9 and x == t))
    shas = set(got["edited_sha256"])
    for a, b in zip(order[:-1], order[1:]):
        if a != prose(1, 200):
            h = len(a) // 2
            assert hashlib.sha256((a[:len(a) - h] + b[:h]).encode()).hexdigest() in shas
    prints = got.set_index("doc_id")["fingerprint"].to_dict()
    assert prints[400] == prints[402] != prints[401] and prints[2] == "0" * 32
    assert got[got.doc_id == 400]["near_edited"].iloc[0] > got[got.doc_id == 400]["near_next"].iloc[0]
    single = simhash.digest(make_docs([(1, "only one here")])).collect()
    assert len(single) == 1 and single[0]["near_next"] == 1.0


@pytest.mark.parametrize("radius", [1, 3, 6])
def test_near_fingerprints(spark, radius):
    rng = np.random.default_rng(radius)
    base = [int.from_bytes(rng.bytes(16), "little") for _ in range(20)]
    full = base + [b ^ sum(1 << int(x) for x in rng.choice(128, size=k, replace=False)) for b in base for k in (1, 2, 4, 6, 7)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    pairs = [(signed(v & (1 << 64) - 1), signed(v >> 64)) for v in full]
    df = spark.createDataFrame(pairs, "f0 long, f1 long")
    got = {(r["a0"], r["a1"], r["b0"], r["b1"], r["distance"]) for r in simhash.near(df, df, radius).collect()}
    want = {(*p, *q, (x ^ y).bit_count()) for p, x in zip(pairs, full) for q, y in zip(pairs, full) if 0 < (x ^ y).bit_count() <= radius}
    assert got == want
