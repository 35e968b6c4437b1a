"""Best-fit packing with swap-based local search (operator 10).

Texts become token ids (an end id follows each), texts longer than a sequence
are cut, and the pieces are packed by their lengths alone.  Pieces are dealt
over groups of about ``group_tokens`` tokens.  Each group starts from best fit
in decreasing order and then improves its underfull bins: one-for-one,
two-for-one exchanges and moves between bins that increase the sum of squared
fills, until bins empty.  The bins with much room that remain go through the
same step again, dealt anew over as many groups as their tokens need, until
one group holds them all or their number hardly falls, so the rest that is
wasted doesn't grow with the groups.

Null texts count as empty: one piece with the end id only.  Repeated rows are
separate pieces, and equal ones are numbered, so they spread over the groups.  An empty table gives no rows.  Only ``doc_id`` and ``text``
are read.  The number of sequences depends on the rows alone, not on the
number of tasks.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import arrow_map, cut, keyed

SIZE = 2048
END_ID = 0
END_OF_TEXT = "<|endoftext|>"
GROUP_TOKENS = 8 << 20        # tokens packed by one task; bounds its memory
SPARE = 64                    # a bin with more room than size / SPARE is worth emptying
FEWER = 1000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def encoder(ranks_path: str):
    """The byte-level BPE of ``ranks_path``; the text of its one special token
    becomes that token's id, as with the library that reads the JSON form."""
    import public_tokenizers
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={END_OF_TEXT: len(ranks)})


def ranks_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def tokenize(docs: DataFrame, path: str | None = None, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """The pieces of every text.  Only a text of more than ``size`` ids is cut:
    its first piece takes what full pieces leave."""
    path = path or ranks_path()

    def make(b: pa.RecordBatch):
        enc = encoder(path)
        cols: list[list[int]] = [[], [], [], [], []]
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
            ids = np.append(enc.encode_to_numpy(text.as_py(), allowed_special="all"), end_id).astype("<u4")
            cuts = [0, *range(len(ids) % size or size, len(ids), size), len(ids)] if len(ids) > size else [0, len(ids)]
            for k, (a, z) in enumerate(zip(cuts, cuts[1:])):
                for c, v in zip(cols, (doc_id, k, a, z - a, zlib.crc32(ids[a:z].tobytes()))):
                    c.append(v)
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          names=["doc_id", "piece", "start", "length", "ids_crc32"])
    rows = keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows, make, PIECES)


class Bins:
    """Bins of one group: best fit by a sorted list of free room, then local
    search.  An item is an index into ``length``."""

    def __init__(self, length: list[int], size: int):
        self.length, self.size = length, size
        self.items: list[list[int]] = []
        self.fill: list[int] = []

    def best_fit(self, order: list[int]) -> None:
        by_room: dict[int, list[int]] = {}       # room left -> bins
        rooms: list[int] = []                    # sorted distinct rooms
        for i in order:
            n = self.length[i]
            at = bisect_left(rooms, n)
            if at < len(rooms):
                room = rooms[at]
                b = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[at]
            else:
                b, room = len(self.items), self.size
                self.items.append([])
                self.fill.append(0)
            self.items[b].append(i)
            self.fill[b] += n
            left = room - n
            if left:
                if left not in by_room:
                    by_room[left] = []
                    insort(rooms, left)
                by_room[left].append(b)

    def _put(self, a: int, out: list[int], b: int, back: list[int]) -> None:
        """Items ``out`` of bin a go to b, items ``back`` of b to a."""
        for x, y, moved in ((a, b, out), (b, a, back)):
            for i in moved:
                self.items[x].remove(i)
                self.items[y].append(i)
                self.fill[x] -= self.length[i]
                self.fill[y] += self.length[i]

    def improve(self) -> None:
        """While a step increases the sum of squared fills: take from bins
        with much room, emptiest first, and fill the others, fullest first.
        The sum is bounded, so the search ends."""
        changed = True
        while changed:
            changed = False
            open_bins = sorted((b for b in range(len(self.items)) if 0 < self.fill[b] < self.size), key=lambda b: (self.fill[b], b))
            for source in [b for b in open_bins if self.size - self.fill[b] > self.size // SPARE]:
                for target in reversed(open_bins):
                    while target != source and self.items[source] and self.fill[source] <= self.fill[target] < self.size and self._step(source, target):
                        changed = True

    def _step(self, a: int, b: int) -> bool:
        """The best exchange that moves tokens from bin a into the fuller b."""
        room, n = self.size - self.fill[b], self.length
        best: tuple[int, list[int], list[int]] = (0, [], [])
        own, other = sorted(self.items[a], key=n.__getitem__), sorted(self.items[b], key=n.__getitem__)
        sizes = [n[i] for i in own]
        at = bisect_left(sizes, room + 1) - 1                       # move one
        if at >= 0:
            best = (sizes[at], [own[at]], [])
        for j in other:                                             # one for one
            if best[0] == room:
                break
            at = bisect_left(sizes, room + n[j] + 1) - 1
            if at >= 0 and sizes[at] - n[j] > best[0]:
                best = (sizes[at] - n[j], [own[at]], [j])
        lows = [n[j] for j in other]
        for i in range(len(own)):                                   # two for one, both ways
            if best[0] == room:
                break
            for k in range(i + 1, len(own)):
                pair = sizes[i] + sizes[k]
                at = bisect_left(lows, pair - room)
                if at < len(lows) and pair - lows[at] > best[0]:
                    best = (pair - lows[at], [own[i], own[k]], [other[at]])
        for i in range(len(other)):
            if best[0] == room:
                break
            for k in range(i + 1, len(other)):
                at = bisect_left(sizes, room + lows[i] + lows[k] + 1) - 1
                if at >= 0 and sizes[at] - lows[i] - lows[k] > best[0]:
                    best = (sizes[at] - lows[i] - lows[k], [own[at]], [other[i], other[k]])
        # squared fills rise whenever tokens move to a bin that ends up fuller
        if best[0] <= 0 or (self.fill[b] + best[0]) ** 2 + (self.fill[a] - best[0]) ** 2 <= self.fill[a] ** 2 + self.fill[b] ** 2:
            return False
        self._put(a, best[1], b, best[2])
        return True


def pack_lengths(length: list[int], size: int = SIZE) -> list[list[int]]:
    """Bins (lists of indexes) of one group."""
    bins = Bins(length, size)
    bins.best_fit(sorted(range(len(length)), key=lambda i: (-length[i], i)))
    bins.improve()
    return [b for b in bins.items if b]


def _pack_groups(pieces: DataFrame, groups: int, level: int, size: int) -> DataFrame:
    """Pack each of ``groups`` hash groups; a bin's number has level, group and
    place in it."""
    dealt = (pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", "copy", F.lit(level)), F.lit(groups)).cast("int"))
             .repartition(groups, "grp").sortWithinPartitions("grp", "length", "doc_id", "piece", "ids_crc32", "copy"))

    def run(batches):
        held: list[pa.Table] = []

        def flush():
            t = pa.concat_tables(held).combine_chunks()
            length = t["length"].to_numpy()
            seq, off, room = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            grp = t["grp"][0].as_py()
            for k, members in enumerate(pack_lengths(length.tolist(), size)):
                m = np.array(members)
                seq[m] = (level << 56) | (grp << 32) | k
                off[m] = np.cumsum(length[m]) - length[m]
                room[m] = size - int(length[m].sum())
            out = t.drop_columns(["grp"]).append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(off)).append_column("room", pa.array(room))
            return out.to_batches(max_chunksize=20_000)
        now = None
        for b in batches:
            t = pa.Table.from_batches([b])
            g = t["grp"].to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist(), len(g)]
            for a, z in zip(edges, edges[1:]):
                if a == z:
                    continue
                if held and g[a] != now:
                    yield from flush()
                    held.clear()
                now = g[a]
                held.append(t.slice(a, z - a))
        if held:
            yield from flush()
    return dealt.mapInArrow(run, PIECES + ", copy long, sequence_id long, offset long, room long")


def numbered(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``copy``, 1 up to the number of equal rows: counted
    within tasks first, so equal rows meet as counts only."""
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    counts = pieces.groupBy(*cols).agg(F.count("*").alias("n"))
    return counts.select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))


def pack(pieces: DataFrame, size: int = SIZE, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    done = None
    rest, level, cols = cut(numbered(pieces), "pieces"), 0, ["doc_id", "piece", "start", "length", "ids_crc32"]
    tokens, bins = rest.agg(F.sum("length")).first()[0] or 0, None
    while True:
        groups = max(1, -(-tokens // group_tokens))
        packed = cut(_pack_groups(rest, groups, level, size), "packed")
        # a bin with little room is as good as full; the others are tried again together
        spare = F.col("room") > size // SPARE
        left, open_bins, all_bins = packed.agg(F.sum(F.when(spare, F.col("length"))), F.count_if(spare & (F.col("offset") == 0)), F.count_if(F.col("offset") == 0)).first()
        left = left or 0
        # another deal is worth its while as long as it saves a bin in FEWER
        again = groups > 1 and left > 0 and (bins is None or all_bins <= bins - bins // FEWER - 1)
        part = packed.where(~spare) if again else packed
        part = part.select(*cols, "sequence_id", "offset")
        done = part if done is None else done.unionByName(part)
        if not again:
            return done
        rest, tokens, bins, level = packed.where(spare).select(*cols, "copy"), left, open_bins, level + 1


def digest(docs: DataFrame) -> DataFrame:
    return pack(tokenize(docs))
