"""Trained operators: held-out results, odd rows, empty tables, the pipeline."""

import random

import numpy as np
import pytest

import corpus_pipeline
from framelake.llm import components, decontaminate, jaccard, language, packing, passages, pii, quality, rtree, simhash, substrings, toxicity
from framelake.llm.catalog import QUERIES
from tests.llm.conftest import ODD, prose


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, source string")


def test_quality(spark, make_docs):
    good = [(1000 + k, prose(k, 80)) for k in range(150)]
    bad = [(2000 + k, " ".join(w.upper() + "!!" for w in prose(k, 80).split())) for k in range(60)]
    lab = [(k, 1, 0, None) for k, _ in good] + [(k, 0, 0, None) for k, _ in bad] + [(None, 1, 1, None), (1, None, None, None)]
    rows = [*ODD, *good, *bad]
    got = quality.digest(make_docs(rows), labels(spark, lab)).toPandas()
    assert len(got) == len(rows) and got["score"].between(0, 1).all()
    held = got[got["held_out"] & (got["doc_id"] >= 1000)]
    assert len(held) > 10 and (held["predicted"] == (held["doc_id"] < 2000)).mean() > 0.95


def test_language(make_docs):
    rng = random.Random(4)
    parts = {"aa": ["tion", "the", "ing", "er"], "bb": ["ung", "sch", "ßen", "über"], "cc": ["ción", "ñar", "os", "que"]}
    rows = [(1000 + k, " ".join("".join(rng.choice(p) for _ in range(3)) for _ in range(30)), lang) for lang, p in parts.items() for k in range(ord(lang[0]) * 100, ord(lang[0]) * 100 + 60)]
    got = language.digest(make_docs([*ODD, *rows])).toPandas()
    truth = {r[0]: r[2] for r in rows}
    held = got[got["held_out"] & got["doc_id"].isin(truth)]
    assert len(held) > 30 and (held["lang_pred"] == held["doc_id"].map(truth)).all()
    odd = got.set_index("doc_id")["lang_pred"]
    assert all(odd[k] == "und" for k in (1, 2, 3, 4)) and odd[5] != "und" and got["score"].between(0, 1).all()


def test_toxicity(spark, make_docs):
    rng = random.Random(8)
    marks = ["worthlezz", "disguzting", "pathetik"]
    rows = []
    for k in range(300):
        w = prose(5000 + k, 60).split()
        if k % 3 == 0:
            w[10], w[40] = rng.sample(marks, 2)
        rows.append((1000 + k, " ".join(w)))
    lab = [(k, 1, int((k - 1000) % 3 == 0), None) for k, _ in rows]
    got = toxicity.digest(make_docs([*ODD, *rows]), labels(spark, lab)).toPandas()
    held = got[got["held_out"] & (got["doc_id"] >= 1000)]
    assert len(got) == len(ODD) + 300 and (held["predicted"] == ((held["doc_id"] - 1000) % 3 == 0)).mean() > 0.95
    assert got["score"].between(0, 1).all() and (got[got["doc_id"] < 1000]["predicted"] == 0).all()


def test_models_without_labels(spark, make_docs):
    none, docs = labels(spark, []), make_docs(ODD)
    assert {r["score"] for r in quality.digest(docs, none).collect()} == {0.5}
    assert {r["score"] for r in toxicity.digest(docs, none).collect()} == {0.0}
    assert {r["lang_pred"] for r in language.digest(docs).collect()} == {"und"}


def test_passages(make_docs):
    shared = prose(77, 70)
    edited = shared.split()
    edited[20], edited[45] = "changed", "words here"
    rows = [*ODD, (500, prose(50, 90) + " " + shared + " " + prose(51, 30)), (501, prose(52, 40) + " " + shared), (502, prose(53, 200)),
            (503, prose(54, 20) + " " + " ".join(edited) + " " + prose(55, 20)), (504, prose(56, 30) + " " + " ".join(shared.split()[:30]) + " " + prose(57, 60))]
    got = {r["doc_id"]: r for r in passages.digest(make_docs(rows)).collect()}
    assert set(got) == {500, 501, 503}
    assert got[500]["spans"] == "90:160" and got[501]["spans"] == "40:110" and got[503]["n_words_covered"] >= 70


def test_passages_of_a_template(make_docs):
    """Header and footer with unlike words between, and a stray seed before a passage."""
    head, foot, line = prose(81, 60), prose(82, 60), prose(83, 51)
    rows = [(600 + 10 * gap + k, f"{head} {prose(gap * 7 + k, gap)} {foot}") for gap in (40, 90, 140) for k in range(3)]
    rows += [(9000 + k, f"{prose(900 + k, 40)} {prose(84, 7)} {prose(910 + k, 18)} {line}") for k in range(2)]
    got = {r["doc_id"]: r["spans"] for r in passages.digest(make_docs(rows)).collect()}
    assert got == {600 + 10 * gap + k: f"0:60,{60 + gap}:{120 + gap}" for gap in (40, 90, 140) for k in range(3)} | {9000 + k: "65:116" for k in range(2)}


def test_passages_of_rows_without_id(spark, make_docs):
    """Rows without an id hide no other copies, whichever key is least."""
    rows, least = [], 0
    for k in range(8):
        line = prose(700 + k, 60)
        copies = [(2 * k, f"{line} {prose(720 + k, 20)}"), (2 * k + 1, f"{prose(740 + k, 20)} {line}"), (None, f"{prose(760 + k, 9)} {line}")]
        rows += copies
        key = "xxhash64(coalesce(cast(doc_id as string), 'null'), xxhash64(text))"
        least += spark.createDataFrame(copies, "doc_id long, text string").selectExpr("doc_id", f"{key} as r").orderBy("r").first()["doc_id"] is None
    rows += [(50, prose(780, 60)), (None, prose(780, 60))]
    got = {r["doc_id"]: (r["spans"], r["other_id"]) for r in passages.digest(make_docs(rows)).collect()}
    assert least and got == {2 * k: ("0:60", 2 * k + 1) for k in range(8)} | {2 * k + 1: ("20:80", 2 * k) for k in range(8)} | {50: ("0:60", None)}


def test_passages_of_common_phrases(spark, make_docs):
    """Seeds of a passage that other rows of lower key have as phrases, and
    a passage that a row has twice."""
    line, twice = prose(790, 60).split(), prose(791, 60)
    rows = [(1, prose(792, 20) + " " + " ".join(line)), (2, " ".join(line) + " " + prose(793, 30))]
    rows += [(100 * k + v, f"{prose(1000 + 100 * k + v, 30)} {' '.join(line[k:k + 6])} {prose(9000 + 100 * k + v, 30)}") for k in range(1, 55) for v in range(6)]
    rows += [(60_000, f"{twice} {prose(794, 40)} {twice}"), (60_001, f"{prose(795, 25)} {twice}")]
    rows += [(60_010 + k, f"{prose(796 + k, 10)} " + "over and over again " * (40 + k)) for k in range(2)]
    got = {r["doc_id"]: r["spans"] for r in passages.digest(make_docs(rows)).collect()}
    assert got.pop(60_010) == "10:170" and got.pop(60_011) in ("10:174", "10:170")
    assert got == {1: "20:80", 2: "0:60", 60_000: "0:60,100:160", 60_001: "25:85"}


def test_parts_of_chains():
    """The parts cover what all alike parts of a chain together cover."""
    rng = np.random.default_rng(5)
    for _ in range(60):
        a, b, xs, ys = [], [], [], []
        for part in range(int(rng.integers(2, 7))):
            n = int(rng.integers(passages.K, 30))
            xs += [len(a), len(a) + n - passages.K] if n > passages.K else [len(a)]
            ys += [len(b), len(b) + n - passages.K] if n > passages.K else [len(b)]
            same = rng.integers(0, 1 << 60, n).tolist()
            a += same + rng.integers(0, 1 << 60, int(rng.integers(0, 25))).tolist()
            b += same + rng.integers(0, 1 << 60, int(rng.integers(1, 25))).tolist()
        u, v, want, got = np.array(a, np.uint64), np.array(b, np.uint64), set(), set()
        for i in range(len(xs)):
            for j in range(i, len(xs)):
                n, m = xs[j] - xs[i] + passages.K, ys[j] - ys[i] + passages.K
                if min(n, m) >= passages.MIN_PIECE and len(set(a[xs[i]:xs[i] + n]) & set(b[ys[i]:ys[i] + m])) >= passages.MIN_ALIKE * max(n, m):
                    want |= set(range(xs[i], xs[i] + n))
        for x0, x1, y0, y1, hit in passages.align(u, v, xs, ys):
            assert hit == len(set(a[x0:x1]) & set(b[y0:y1])) >= passages.MIN_ALIKE * max(x1 - x0, y1 - y0)
            got |= set(range(x0, x1))
        assert want == got


def test_chain_is_best():
    """The Fenwick chain scores as the quadratic recurrence does."""
    rng = np.random.default_rng(3)
    for _ in range(50):
        n = int(rng.integers(2, 25))
        x = np.sort(rng.choice(200, n, replace=False))
        y = rng.integers(0, 120, n)
        best = [0.0] * n
        for i in range(n):
            best[i] = passages.K
            for j in range(i):
                if y[j] < y[i]:
                    gain = best[j] - passages.GAP * (x[i] - x[j] + y[i] - y[j])
                    if gain > 0:
                        best[i] = max(best[i], gain + min(passages.K, x[i] - x[j], y[i] - y[j]))
        for run in passages.chain(x, y)[:1]:
            assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(run, run[1:]))
            assert len(set(run)) == len(run)


@pytest.mark.parametrize("seed", range(5))
def test_rtree_against_all_pairs(seed):
    rng = np.random.default_rng(seed)
    n = 150
    base = rng.poisson(4, (n // 3, 8))
    points = np.vstack([base, base + rng.integers(0, 2, base.shape), rng.poisson(4, base.shape)])
    sizes, label = points.sum(1), rng.integers(0, 60, n)
    limits = sizes - rng.integers(0, 3, n)
    tree = rtree.RTree(points, sizes, label, limits)
    got = {(min(a, b), max(a, b)) for x, y in tree.partners(85, 100) for a, b in zip(x.tolist(), y.tolist())}
    i, j = np.triu_indices(n, 1)
    need = rtree.overlap_needed(sizes[i], sizes[j], 85, 100)
    ok = ((label[i] != label[j]) & (np.minimum(points[i], points[j]).sum(1) >= need) & (np.minimum(limits[i], limits[j]) >= need)
          & (np.minimum(sizes[i], sizes[j]) * 100 >= np.maximum(sizes[i], sizes[j]) * 85))
    assert got == set(zip(i[ok].tolist(), j[ok].tolist()))


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(k, k + 1) for k in range(100, 130)] + [(7, 7)]
    label = list(range(200))
    for a, b in links:
        x, y = label[a], label[b]
        label = [min(x, y) if v in (x, y) else v for v in label]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {v: label[v] for a, b in links if a != b for v in (a, b)}


def test_empty_tables(spark, make_docs):
    docs, none, bench = make_docs([]), labels(spark, []), spark.createDataFrame([], "item_id long, text string")
    for got in (quality.digest(docs, none), language.digest(docs), toxicity.digest(docs, none), passages.digest(docs), substrings.digest(docs), jaccard.digest(docs),
                simhash.digest(docs), decontaminate.digest(docs, bench), pii.digest(docs), packing.digest(docs)):
        assert got.count() == 0
    assert decontaminate.digest(make_docs(ODD), bench).where("contaminated").count() == 0


def test_queries_are_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_pipeline(spark, sf="/root/testdata/sf0.001"):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.count()
        kept = stage(spark, kept, sf)
        assert kept.columns == docs.columns and 0 < kept.count() <= before
    model = quality.fit(quality.with_statistics(docs), quality.labelled(spark.read.parquet(f"{sf}/labels.parquet"), "quality", quality.learn_rows(5, 0)))
    first = corpus_pipeline.STAGES[0][1](spark, docs, sf)
    scored = {r["doc_id"]: r["score"] for r in quality.score_statistics(quality.with_statistics(docs), model).collect()}
    assert {r["doc_id"] for r in first.collect()} == {k for k, v in scored.items() if v >= quality.THRESHOLD}
    packed = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in kept.select("doc_id").collect()}


def test_training_rows_merge_by_label_and_two_hashes(spark):
    base = prose(70, 300).split()
    near = " ".join([*base[:150], "changed", *base[151:]])
    hot = prose(71, 40)
    sharing = [(prose(80 + k, 160) + " " + hot, k % 2) for k in range(40)]       # a fifth of each text
    rows = [(" ".join(base), 0), (" ".join(base), 0), (near, 0), (near, 1), ("", 0), ("", 1), *sharing]
    got = {(r["text"], r["y"]) for r in toxicity.once(spark.createDataFrame(rows, "text string, y int")).collect()}
    assert (near, 1) in got                                  # a toxic text made from a clean one stays
    assert sum(t in (near, " ".join(base)) and y == 0 for t, y in got) == 1
    assert {("", 0), ("", 1)} <= got and len(got & set(sharing)) >= 30
