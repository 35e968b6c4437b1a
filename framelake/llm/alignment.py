"""Cross-tokenizer alignment (operator 13).

Each text is encoded by a byte-level BPE (A, with a space in front) and by a
sentencepiece BPE (B, which adds that space).  Byte offsets at which tokens of
both end cut the tokens into groups.  The tokens that end there together are a
link; as every token has bytes, a group has exactly one, between its last A
and its last B token.

No token of either covers a single space and text before it, so a text is the
sequence of its stretches between such spaces, each encoded by itself with a
space in front.  A task encodes a stretch once and remembers its ids, within a
bound.  Tokenizers of another build get whole texts.

Identity map: ``same[a]`` is the B id with the bytes of A id ``a``.  A group
of one A and one B token has equal bytes on both sides, so its link is
``(a, same[a])`` (bytes that B has twice, as a piece and as a byte token, are
left out of the map).  Such links are counted in vectors as long as A's
vocabulary, one a task.  The links of all other groups are the only rows of the pair
shuffle, summed up by document first.

Defined results: null and empty texts, and texts whose joined A or B bytes are
not space plus text, have no tokens: zeros and an empty digest.  The strings of
special tokens are plain text.  Repeated rows are documents of their own.  An
empty table gives no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import cut, keyed
from framelake.session import ship_package

BATCH_BYTES = 1 << 20          # text encoded at once
KNOWN_BYTES = 1 << 21          # text of the stretches that a task remembers, besides one batch
ROWS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "same_ids binary, pair_a binary, pair_b binary, pair_n binary, counted binary")


def paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 characters are themselves, the other bytes follow from
    code point 256 on in order."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Pair:
    """Both tokenizers with the bytes of their ids."""

    a: object
    b: object
    a_bytes: pa.LargeBinaryArray
    b_bytes: pa.LargeBinaryArray
    a_len: np.ndarray
    b_len: np.ndarray
    same: np.ndarray        # A id -> B id of the same bytes, or -1
    texts: pa.LargeBinaryArray        # "id,", then "id|" of A, "id,", then "id;" of B
    apart: bool             # whether stretches of a text can be encoded one by one


@lru_cache(maxsize=2)
def load(a_path: str, b_path: str) -> Pair:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    alphabet, vocab = byte_alphabet(), a.get_vocab(with_added_tokens=False)
    a_bytes = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        # a special token's string is no byte-level entry and never comes out
        a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else b""
    b_bytes = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        if b.is_byte(i):
            b_bytes.append(bytes([int(piece[1:-1], 16)]))
        elif b.is_control(i) or b.is_unknown(i):
            b_bytes.append(b"")
        else:
            b_bytes.append(piece.replace("▁", " ").encode())
    texts = [f"{i}{end}".encode() for n, ends in ((len(a_bytes), ",|"), (len(b_bytes), ",;")) for end in ends for i in range(n)]
    return Pair(a, b, *(pa.array(x, pa.large_binary()) for x in (a_bytes, b_bytes)), np.array([len(x) for x in a_bytes]), np.array([len(x) for x in b_bytes]),
                identity(a_bytes, b_bytes), pa.array(texts, pa.large_binary()), _apart(a, b))


def _apart(a, b) -> bool:
    """Whether no token of A or B can reach over a single space: A splits
    texts at them (byte-level words, nothing normalised, no added token but
    special ones), and B leaves texts as they are, has no piece with a space
    after something else and spells unknown characters in bytes."""
    spec = json.loads(a.to_str())
    split = spec["pre_tokenizer"] or {}
    plain = (spec["normalizer"] is None and spec["truncation"] is None and split.get("type") == "ByteLevel" and split.get("use_regex")
             and not split.get("add_prefix_space") and all(t["special"] for t in spec["added_tokens"]))
    probe = " a\u0301  \ufb01\t\xa0\uff21 "
    ids = range(b.get_piece_size())
    return bool(plain and b.decode(b.encode(probe)) == probe and any(b.is_byte(i) for i in ids)
                and not any(re.search("[^\u2581]\u2581", b.id_to_piece(i)) for i in ids))


def identity(a_bytes: list[bytes], b_bytes: list[bytes]) -> np.ndarray:
    """For each A id the one B id of the same bytes, -1 without or with several."""
    ids: dict[bytes, int] = {}
    for i, x in enumerate(b_bytes):
        if x:
            ids[x] = -1 if x in ids else i
    return np.array([ids.get(x, -1) if x else -1 for x in a_bytes], np.int64)


def groups(a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which A and which B tokens end a group, from the byte lengths of two
    encodings of the same bytes."""
    a_end, b_end = np.cumsum(a_len), np.cumsum(b_len)
    ends = np.zeros((2, int(a_end[-1]) + 1 if len(a_end) else 1), bool)
    ends[0, a_end] = True
    ends[1, b_end] = True
    return ends[1, a_end], ends[0, b_end]


def written(pair: Pair, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> np.ndarray:
    """Places in ``pair.texts`` that spell the groups: ``a1,a2|b1;a3|b2,b3;``."""
    na, nb = len(pair.a_bytes), len(pair.b_bytes)
    out = np.empty(len(a) + len(b), np.int64)
    # an A token comes after the B tokens of the groups before, a B token after the A tokens of its own
    b_before = np.concatenate(([0], np.flatnonzero(last_b) + 1))
    a_upto = np.flatnonzero(last_a) + 1
    out[np.arange(len(a)) + b_before[np.cumsum(last_a) - last_a]] = a + last_a * na
    out[np.arange(len(b)) + a_upto[np.cumsum(last_b) - last_b]] = b + (2 * na + last_b * nb)
    return out


def encode(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document with its irregular pairs, and one row per task
    (``counted``) with the vector of its identity links."""
    ship_package(docs.sparkSession)
    rows = keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = [c.split()[0] for c in ROWS.split(", ")]
    types = [pa.int64()] * 5 + [pa.string()] + [pa.binary()] * 5

    def batch(cols):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    def run(batches):
        pair = load(a_path, b_path)
        vector, known = np.zeros(len(pair.a_bytes), np.int64), Stretches(pair)
        for big in batches:
            size = np.cumsum([len(t) for t in big.column(1).to_pylist()]) // BATCH_BYTES
            edges = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), big.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                b = big.slice(lo, hi - lo)
                rows = _aligned(pair, b.column(1).to_pylist(), vector, known)
                if rows:
                    yield batch([b.column(0).to_pylist(), *zip(*rows), [None] * len(rows)])
        if vector.any():
            yield batch([[None]] * 10 + [[vector.astype("<i8").tobytes()]])
    return rows.mapInArrow(run, ROWS)


_NONE = (0, 0, 0, 0, "", b"", b"", b"", b"")


class Stretches(dict):
    """Numbers of stretches of text, and the ids of each in both encodings."""

    # a space between characters that are none; what Python takes for a space includes all that A does
    split = re.compile(r" (?<=\S )(?=\S)").split

    def __init__(self, pair: Pair):
        self.pair = pair
        self._forget()

    def _forget(self):
        self.clear()
        self.new: list[str] = []
        self.size = 0
        self.ids, self.ends = (array("q"), array("q")), (array("q", [0]), array("q", [0]))

    def __missing__(self, stretch: str) -> int:
        n = self[stretch] = len(self)
        self.new.append(stretch)
        return n

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and B the ids of all texts (none empty) in a row, and where each text begins."""
        if self.size > KNOWN_BYTES:
            self._forget()
        at, first = array("q"), [0]
        for t in texts:
            at.extend(map(self.__getitem__, self.split(t) if self.pair.apart else [t]))
            first.append(len(at))
        if self.new:
            self.size += sum(map(len, self.new))
            of_a = [e.ids for e in self.pair.a.encode_batch_fast([" " + t for t in self.new], add_special_tokens=False)]
            for ids, ends, of in zip(self.ids, self.ends, (of_a, self.pair.b.encode(self.new, num_threads=1))):
                ends.extend((np.cumsum([len(x) for x in of]) + len(ids)).tolist())
                ids.extend(chain.from_iterable(of))
            self.new = []
        out, k = [], np.frombuffer(at, np.int64)
        for ids, ends in zip(self.ids, self.ends):
            ends = np.array(ends)
            size = np.diff(ends)[k]
            to = np.concatenate(([0], np.cumsum(size)))
            out.append((np.array(ids)[np.repeat(ends[k] - to[:-1], size) + np.arange(to[-1])], to[first]))
        return out


def _spelled(table: pa.LargeBinaryArray, at: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """Entries ``at`` of ``table`` as one run of bytes, and where each begins."""
    got = table.take(pa.array(at))
    return memoryview(got.buffers()[2] or b"").cast("B"), np.frombuffer(got.buffers()[1], np.int64)[:len(at) + 1]


def _aligned(pair: Pair, texts: list[str], vector: np.ndarray, known: Stretches) -> list[tuple]:
    """Of each text n_a .. groups_sha256, its identity links (A ids), and its
    other pairs with how often each occurs; adds the identity links to
    ``vector``.  The texts are taken as one run of bytes: both encodings end
    where a text ends."""
    good, out = [k for k, t in enumerate(texts) if t], [_NONE] * len(texts)
    while good:
        (a, from_a), (b, from_b) = known.encode([texts[k] for k in good])
        whole, kept = [(" " + texts[k]).encode() for k in good], range(len(good))
        for ids, at, table in ((a, from_a, pair.a_bytes), (b, from_b, pair.b_bytes)):
            data, ends = _spelled(table, ids)
            kept = [g for g in kept if data[ends[at[g]]:ends[at[g + 1]]] == whole[g]]
        if len(kept) == len(good):
            break
        good = [good[g] for g in kept]
    else:
        return out
    last_a, last_b = groups(pair.a_len[a], pair.b_len[b])
    end_a, end_b = np.flatnonzero(last_a), np.flatnonzero(last_b)
    link_a, link_b = a[end_a], b[end_b]
    first = np.searchsorted(end_a, from_a)
    single = (np.diff(end_a, prepend=-1) == 1) & (np.diff(end_b, prepend=-1) == 1) & (pair.same[link_a] == link_b)
    vector += np.bincount(link_a[single], minlength=len(vector))
    text = np.repeat(np.arange(len(good)), np.diff(first))
    same, from_same = link_a[single].astype("<u4"), np.searchsorted(text[single], np.arange(len(good) + 1))
    pairs = link_a[~single] << 32 | link_b[~single]
    of = text[~single]
    order = np.lexsort((pairs, of))
    pairs, of = pairs[order], of[order]
    new = np.flatnonzero(np.concatenate(([True], (pairs[1:] != pairs[:-1]) | (of[1:] != of[:-1])))) if len(pairs) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(pairs)))
    from_pair = np.searchsorted(of[new], np.arange(len(good) + 1))
    left, right, times = (pairs[new] >> 32).astype("<u4"), (pairs[new] & 0xFFFFFFFF).astype("<u4"), times.astype("<u4")
    data, ends = _spelled(pair.texts, written(pair, a, b, last_a, last_b))
    starts = ends[from_a + from_b]
    for g, k in enumerate(good):
        n = int(first[g + 1] - first[g])
        s, p = slice(from_same[g], from_same[g + 1]), slice(from_pair[g], from_pair[g + 1])
        out[k] = (int(from_a[g + 1] - from_a[g]), int(from_b[g + 1] - from_b[g]), n, n, hashlib.sha256(data[starts[g]:starts[g + 1] - 1]).hexdigest(),
                  same[s].tobytes(), left[p].tobytes(), right[p].tobytes(), times[p].tobytes())
    return out


def _sums(encoded: DataFrame, size: int) -> np.ndarray:
    """The sum of all tasks' vectors: as many numbers as A has ids, whatever
    the number of documents."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            for v in b.column(0).to_pylist():
                total += np.frombuffer(v, "<i8")
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["a", "n"])
    rows = encoded.where("counted is not null").select("counted").mapInArrow(run, "a int, n long").groupBy("a").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, np.int64)
    out[rows["a"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return out


def _pairs(encoded: DataFrame) -> DataFrame:
    """Irregular pairs of each document: row, a, b, k (times in it)."""
    def run(batches):
        for b in batches:
            n = [len(x) // 4 for x in b.column("pair_a").to_pylist()]
            cols = [np.frombuffer(b"".join(b.column(c).to_pylist()), "<u4").astype(np.int32) for c in ("pair_a", "pair_b", "pair_n")]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column("row").to_numpy(), n)), *map(pa.array, cols)], names=["row", "a", "b", "k"])
    return encoded.where("n_links > 0").select("row", "pair_a", "pair_b", "pair_n").mapInArrow(run, "row long, a int, b int, k int")


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row per document with its counts over the corpus."""
    own = paths()
    a_path, b_path = a_path or own[0], b_path or own[1]
    spark = docs.sparkSession
    # written first, so that a row keeps its number when a task is run again
    encoded = cut(encode(docs, a_path, b_path), "aligned").withColumn("row", F.monotonically_increasing_id())
    pair = load(a_path, b_path)
    vector, same = _sums(encoded, len(pair.a_bytes)), pair.same

    # pairs of irregular groups; a pair of the identity map can also end a longer group
    shuffled = cut(_pairs(encoded).groupBy("a", "b").agg(F.sum("k").alias("n")), "aligned-pairs")
    ids = np.flatnonzero(vector)
    identity_rows = spark.createDataFrame([(int(i), int(same[i]), int(vector[i])) for i in ids], "a int, b int, n long")
    counts = cut(shuffled.unionByName(identity_rows).groupBy("a", "b").agg(F.sum("n").alias("n")), "aligned-counts")
    # bounded by the vocabularies: the best count of each B id, the count of each identity pair
    best = np.zeros(len(pair.b_bytes), np.int64)
    for b, n in counts.groupBy("b").agg(F.max("n").alias("n")).toLocalIterator():
        best[b] = n
    fast = vector.copy()
    known = spark.createDataFrame([(int(i), int(same[i])) for i in ids], "a int, b int")
    for a, n in counts.join(known, ["a", "b"]).select("a", "n").toLocalIterator():
        fast[a] = n
    shared = spark.sparkContext.broadcast((fast, (fast > 0) & (fast == best[same])))
    top = spark.createDataFrame([(int(b), int(best[b])) for b in np.flatnonzero(best)], "b int, best long")

    irregular = (_pairs(encoded).join(counts.join(top, "b").select("a", "b", "n", (F.col("n") == F.col("best")).cast("long").alias("is_best")), ["a", "b"])
                 .groupBy("row").agg(F.sum(F.col("k") * F.col("n")).alias("sum_more"), F.sum(F.col("k") * F.col("is_best")).alias("best_more")))

    def regular(batches):
        count, is_best = shared.value
        for b in batches:
            sums, bests = [], []
            for i in b.column("same_ids").to_pylist():
                i = np.frombuffer(i, "<u4")
                sums.append(int(count[i].sum()))
                bests.append(int(is_best[i].sum()))
            yield pa.RecordBatch.from_arrays([*b.columns[:7], pa.array(sums, pa.int64()), pa.array(bests, pa.int64())],
                                             names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "sum_same", "best_same"])
    kept = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    rows = (encoded.where("counted is null").select(*kept, "same_ids")
            .mapInArrow(regular, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, sum_same long, best_same long"))
    zero = F.lit(0).cast("long")
    return (rows.join(irregular, "row", "left")
            .select(*kept[1:6], (F.col("best_same") + F.coalesce("best_more", zero)).alias("n_best"),
                    (F.col("sum_same") + F.coalesce("sum_more", zero)).alias("count_sum"), "groups_sha256"))


def pair_counts(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """All linked id pairs of the corpus with their counts: a, b, n."""
    own = paths()
    a_path, b_path = a_path or own[0], b_path or own[1]
    encoded = cut(encode(docs, a_path, b_path), "aligned").withColumn("row", F.lit(0).cast("long"))
    pair = load(a_path, b_path)
    vector = _sums(encoded, len(pair.a_bytes))
    spark = docs.sparkSession
    rows = spark.createDataFrame([(int(i), int(pair.same[i]), int(vector[i])) for i in np.flatnonzero(vector)], "a int, b int, n long")
    return (_pairs(encoded).groupBy("a", "b").agg(F.sum("k").alias("n")).unionByName(rows)
            .groupBy("a", "b").agg(F.sum("n").alias("n")))


def digest(docs: DataFrame) -> DataFrame:
    return align(docs)
