"""Best-fit packing of documents into sequences under conflicts.

A bin holds ``capacity`` words and never two pieces of one source or of one
cluster of duplicates.  Pieces come in decreasing size.  Bins are kept ordered by
what is left in them, each with a bitmap of its sources and one of its clusters;
the search starts at the tightest bin that is large enough and goes on to its
successors until one is compatible, else a bin is opened.

Documents longer than a bin are cut into pieces; whole bins of one document need
no search.  Pieces are dealt by hash into shards of about ``SHARD`` words, each of
which is packed on its own, so that neither a large source nor a large cluster
meets in one task and a shard's search is bounded.  The pieces of bins with more
than ``SLACK`` of the capacity left are dealt anew to shards of the same size and
packed again, round after round, until they are in one shard or a round saves less
than ``SETTLED`` of all bins.  Only ids, sizes, sources and clusters are moved, no
texts.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, n_tasks_for, words

CAPACITY = 4096
SHARD = 1 << 18
SLACK = 1 / 64
SETTLED = 1 / 1000
_BLOCK = 512  # bins

_PLACED = "shard int, bin int, slot int, doc_id bigint, piece int, first_word bigint, n_words bigint, source string, cluster bigint"
_ROUND = _PLACED + ", full_bin int"


def text_cluster(text: Column) -> Column:
    """A cluster of texts equal but for ASCII white space and case of A-Z; none for texts without words."""
    found = words(text)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.size(found) > 0, F.xxhash64(F.translate(F.array_join(found, " "), upper, lower)))


class _OpenBins:
    """Bins with room, by what is left and then by number, in blocks of up to ``2 * _BLOCK``.

    A block knows sources and clusters that all of its bins hold, so the search passes
    it at once where each of its bins conflicts: a source that is in most bins costs a
    step a block and not one a bin.
    """

    def __init__(self, sources: list[int], clusters: list[int]):
        self.sources, self.clusters = sources, clusters  # bitmaps of all bins
        self.blocks: list[list[tuple[int, int]]] = []
        self.last: list[tuple[int, int]] = []
        self.shared: list[tuple[int, int]] = []  # at least this is in all bins of a block

    def take(self, size: int, source: int, cluster: int) -> tuple[int, int] | None:
        """Removes and returns the tightest bin that takes the piece."""
        first = (size, -1)
        for k in range(bisect_left(self.last, first), len(self.blocks)):
            if self.shared[k][0] & source or self.shared[k][1] & cluster:
                continue
            block = self.blocks[k]
            start = bisect_left(block, first)
            for i in range(start, len(block)):
                room, chosen = block[i]
                if not (self.sources[chosen] & source or self.clusters[chosen] & cluster):
                    del block[i]
                    self._shrunk(k)
                    return room, chosen
            if not start:
                self.shared[k] = self._held_by_all(block)
        return None

    def add(self, room: int, chosen: int) -> None:
        entry = (room, chosen)
        if not self.blocks:
            self.blocks, self.last, self.shared = [[entry]], [entry], [(self.sources[chosen], self.clusters[chosen])]
            return
        k = min(bisect_left(self.last, entry), len(self.blocks) - 1)
        block = self.blocks[k]
        insort(block, entry)
        self.last[k] = block[-1]
        self.shared[k] = self.shared[k][0] & self.sources[chosen], self.shared[k][1] & self.clusters[chosen]
        if len(block) > 2 * _BLOCK:
            halves = [block[:_BLOCK], block[_BLOCK:]]
            self.blocks[k : k + 1] = halves
            self.last[k : k + 1] = [half[-1] for half in halves]
            self.shared[k : k + 1] = [self._held_by_all(half) for half in halves]

    def _held_by_all(self, block: list[tuple[int, int]]) -> tuple[int, int]:
        sources = clusters = -1
        for _, k in block:
            sources &= self.sources[k]
            clusters &= self.clusters[k]
        return sources, clusters

    def _shrunk(self, k: int) -> None:
        if self.blocks[k]:
            self.last[k] = self.blocks[k][-1]
        else:
            del self.blocks[k], self.last[k], self.shared[k]


def best_fit(items: Iterable[tuple[int, object, object]], capacity: int) -> list[tuple[int, int]]:
    """(bin, slot) of each item (size, source, cluster), taken in the order given.

    A null source or cluster conflicts with nothing; one that comes once needs no bit.
    """
    items = list(items)
    bits: list[dict[object, int]] = []
    for column in (1, 2):
        often = (x for x, n in Counter(item[column] for item in items).items() if n > 1 and x is not None)
        bits.append({x: 1 << i for i, x in enumerate(often)})
    sources: list[int] = []
    clusters: list[int] = []
    slots: list[int] = []
    bins = _OpenBins(sources, clusters)
    out = []
    for size, source, cluster in items:
        s, c = bits[0].get(source, 0), bits[1].get(cluster, 0)
        found = bins.take(size, s, c)
        if found is None:
            found = capacity, len(slots)
            sources.append(0)
            clusters.append(0)
            slots.append(0)
        room, chosen = found
        out.append((chosen, slots[chosen]))
        sources[chosen] |= s
        clusters[chosen] |= c
        slots[chosen] += 1
        if room > size:
            bins.add(room - size, chosen)
    return out


def _pack(capacity: int):
    def packed(table: pa.Table) -> pa.Table:
        order = [("n_words", "descending"), ("cluster", "ascending"), ("doc_id", "ascending"), ("piece", "ascending"), ("source", "ascending")]
        table = table.sort_by(order)
        items = zip(*(table[c].to_pylist() for c in ("n_words", "source", "cluster")), strict=True)
        found = best_fit(items, capacity)
        room: dict[int, int] = {}
        for (at, _), size in zip(found, table["n_words"].to_pylist(), strict=True):
            room[at] = room.get(at, capacity) - size
        # Without the other bins the full ones come out alike, numbered as they are opened.
        full = {at: i for i, at in enumerate(at for at in sorted(room) if room[at] <= capacity * SLACK)}
        places = [pa.array([x[k] for x in found], pa.int32()) for k in (0, 1)]
        names = ["doc_id", "piece", "first_word", "n_words", "source", "cluster"]
        marks = pa.array([full.get(x[0]) for x in found], pa.int32())
        return pa.Table.from_arrays([table["shard"], *places, *(table[c] for c in names), marks], ["shard", "bin", "slot", *names, "full_bin"])

    return packed


def pack(docs: DataFrame, cluster: Column | None = None, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Every piece of every document with its place.

    Columns: ``shard`` and ``bin`` name the bin, ``slot`` the order in it;
    ``doc_id``, ``piece`` (0, 1, ...), ``first_word`` and ``n_words`` name the
    words; ``source`` and ``cluster`` are what conflicts (``cluster`` is
    :func:`text_cluster` unless given).  Documents without words (empty or null
    texts) have nothing to pack and no row; null ids are packed like others;
    repeated rows are packed as often as they come, never two in a bin.  An empty
    table gives an empty table.
    """
    scratch = Scratch(docs.sparkSession)
    text = F.col("text").cast("string")
    sized = scratch.cut(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            (text_cluster(text) if cluster is None else cluster).cast("long").alias("cluster"),
            F.size(words(text)).cast("long").alias("size"),
        ).where("size > 0")
    )
    total = sized.agg(F.sum("size")).first()[0] or 0
    starts = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(capacity).cast("long"))
    pieces = sized.select("doc_id", "source", "cluster", "size", F.posexplode(starts).alias("piece", "first_word"))
    pieces = pieces.withColumn("n_words", F.least(F.col("size") - F.col("first_word"), F.lit(capacity))).drop("size")
    names = [x.split()[0] for x in _PLACED.split(", ")]
    bins = F.sum((F.col("slot") == 0).cast("long"))
    first_shard, done, now, all_bins = 0, [], None, 0
    while True:
        n = n_tasks_for(total, shard)
        salt = [F.lit(first_shard)] * bool(first_shard)
        dealt = F.pmod(F.xxhash64("doc_id", "piece", "cluster", "source", *salt), F.lit(n)).cast("int") + first_shard
        then = scratch.cut(pieces.withColumn("shard", dealt).groupBy("shard").applyInArrow(_pack(capacity), _ROUND))
        found = then.agg(bins.alias("bins")).first()
        saved = loose.bins - (found.bins or 0) if now is not None else 0
        if now is not None and saved <= 0:
            return _union([*done, now.select(*names)])
        if now is not None:
            done.append(now.where("full_bin is not null").withColumn("bin", F.col("full_bin")).select(*names))
            all_bins -= saved
        else:
            all_bins = found.bins or 0
        loose = then.where("full_bin is null").agg(bins.alias("bins"), F.sum("n_words").alias("words")).first()
        if n == 1 or not loose.bins or (now is not None and saved < all_bins * SETTLED):
            return _union([*done, then.select(*names)])
        now, first_shard, total = then, first_shard + n, loose.words
        pieces = now.where("full_bin is null").drop("shard", "bin", "slot", "full_bin")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
