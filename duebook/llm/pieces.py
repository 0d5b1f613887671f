"""Sampled segmentation into SentencePiece pieces, and lossless decoding.

Every way to cut a text into pieces of the vocabulary is a path of its lattice; a
path's probability is proportional to the product of its pieces' probabilities to
the power ``alpha``.  Forward filtering sums the probabilities of all paths to a
position; backward sampling walks from the end and draws each piece given where
it ends.  Draws are hashes of the seed, the row's key and the position, so a row
is cut alike whatever rows are around it.

No piece crosses from a letter to a following space, so the lattice of a text
falls apart into runs of spaces with the word after them: the forward pass is
done once for each distinct run of a batch, the backward pass for all runs of a
batch together.  A character without a piece stands for its UTF-8 bytes; a
literal U+2581, which marks spaces in pieces, is always bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 0.7
SEED = 2026
_MARK = "▁"
_RUN = re.compile(r" *[^ ]+| +", re.DOTALL)
_AT_ONCE = 1 << 20  # characters
_KEPT = 1 << 22  # edges of known runs
_NONE = -(1 << 31)
_NOT_YET = -1
_GUIDE = np.uint64(48)


def vocabulary(path: str = MODEL) -> tuple[list[bytes], list[tuple[str, int]], list[int]]:
    """(bytes of each id, (text, id) of each piece, id of each byte) of a model file.

    Special pieces have no text and are never sampled.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    raw, pieces, of_byte = [], [], [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            of_byte[int(piece[3:5], 16)] = i
            raw.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            raw.append(b"")
        else:
            text = piece.replace(_MARK, " ")
            if re.search(r"[^ ] ", text):
                raise ValueError(f"piece {i} holds a space after a letter")
            raw.append(text.encode())
            pieces.append((text, i))
    return raw, pieces, of_byte


class Lattice:
    """Forward passes of distinct runs, and the backward pass over many runs.

    A piece's probability falls with its place in the vocabulary, as in Zipf's law.
    The edges that end at a position are stored as cumulative probabilities after
    the position's number; an edge is drawn by walking from the position's first one.
    Characters are followed only as far as some piece begins with them.
    The forward pass works in logarithms and sums edges for each position alone, so runs
    of any length and weight have their sums and none bears on another's.
    """

    def __init__(self, pieces: list[tuple[str, int]], of_byte: list[int], alpha: float):
        self.byte_weight = -alpha * np.log(len(pieces) + 3)  # weights are logarithms
        self.of_byte = of_byte
        self.extra: dict[str, int] = {}  # characters of several bytes, numbered below zero
        self.extra_ids: list[list[int]] = []
        self.longest = max((len(text) for text, _ in pieces), default=1)
        self.by_length = _prefixes(pieces, self.longest, alpha)
        self._forget()

    def _forget(self) -> None:
        self.number = _Numbers()
        self.chars = 0
        self.tables = (np.zeros(0), np.zeros(0, np.uint8), np.zeros(0, np.int32))
        self.first = np.zeros(0, np.int64)  # the first edge that ends at each position
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _bytes(self, char: str) -> tuple[float, int]:
        ids = [self.of_byte[b] for b in char.encode()]
        if len(ids) == 1:
            return self.byte_weight, ids[0]
        if char not in self.extra:
            self.extra[char] = len(self.extra)
            self.extra_ids.append(ids)
        return self.byte_weight * len(ids), -1 - self.extra[char]

    def _edges(self, points: np.ndarray, left: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(end, weight, id) of all edges of each length from one; ``left`` is the number of
        characters from each one to the end of its run."""
        begin, hashes = np.arange(len(points)), np.zeros(len(points), np.uint64)
        for length, (known, guide, weight, of) in enumerate(self.by_length, 1):
            end = begin + (length - 1)
            hashes = _longer(hashes, points[end])
            found = guide[(hashes >> _GUIDE).astype(np.int64)]
            lower = np.flatnonzero(known[found] < hashes)
            while len(lower):
                found[lower] += 1
                lower = lower[known[found[lower]] < hashes[lower]]
            ids = np.where(known[found] == hashes, of[found], _NONE)
            piece = np.flatnonzero(ids >= 0)
            yield end[piece], weight[found[piece]], ids[piece]
            if length == 1:
                alone = np.flatnonzero(ids < 0)
                other, which = np.unique(points[alone], return_inverse=True)
                spelled = [self._bytes(chr(c)) for c in other.tolist()]
                yield alone, np.array([x[0] for x in spelled])[which] if spelled else np.zeros(0), np.array([x[1] for x in spelled], dtype=np.int32)[which]
            more = np.flatnonzero((ids != _NONE) & (left[begin] > length))
            begin, hashes = begin[more], hashes[more]

    def learn(self, runs: list[str]) -> None:
        """The forward pass of runs not known yet."""
        points = _points("".join(runs))
        sizes = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
        starts = np.cumsum(sizes) - sizes
        n = len(points)
        at = np.arange(n) - np.repeat(starts, sizes) + 1
        edges = list(self._edges(points, np.repeat(sizes, sizes) - at + 1))
        per_end = np.zeros(n, np.int64)
        for end, _, _ in edges:
            per_end[end] += 1
        # edges by the place where they end, then by end and length
        last = int(at.max())
        order = np.argsort(at.astype(np.uint16) if last < 1 << 16 else at, kind="stable")
        each = per_end[order]
        heads = np.cumsum(each) - each
        begin = np.empty(n, np.int64)
        begin[order] = heads
        total = int(per_end.sum())
        weight, source, ids, length = np.empty(total), np.empty(total, np.int64), np.empty(total, np.int32), np.empty(total, np.uint8)
        cursor, step = begin.copy(), 0
        for k, (end, weights, of) in enumerate(edges):
            step += k != 1  # characters spelled in bytes come second, also of length one
            to = cursor[end]
            cursor[end] += 1
            weight[to], ids[to], length[to] = weights, of, step
            source[to] = np.where(at[end] == step, n, end - step)
        reach, sums = np.zeros(n + 1), np.empty(total)
        nodes = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=last + 1)[1:])]).tolist()
        bounds = np.append(heads, total)
        borders = bounds[nodes].tolist()
        for a, b, e, f in zip(nodes, nodes[1:], borders, borders[1:]):
            first, many = heads[a:b] - e, each[a:b]
            value = weight[e:f] + reach[source[e:f]]
            most = np.maximum.reduceat(value, first)
            value = np.exp(value - np.repeat(most, many))
            whole = np.add.reduceat(value, first)
            reach[order[a:b]] = most + np.log(whole)
            sums[e:f] = value / np.repeat(whole, many)
        more = np.flatnonzero(each > 1)
        k = 1
        while len(more):
            to = heads[more] + k
            sums[to] += sums[to - 1]
            k += 1
            more = more[each[more] > k]
        # the same edges by end and length
        ends = np.cumsum(per_end)
        first = ends - per_end
        moved = np.arange(total) + np.repeat(begin - first, per_end)
        keys = np.repeat(np.arange(n), per_end) + np.minimum(sums[moved], 1.0)
        keys[ends - 1] = np.arange(n) + 1.0
        self.first = np.concatenate([self.first, len(self.tables[0]) + first])
        self.starts, self.sizes = np.concatenate([self.starts, self.chars + starts]), np.concatenate([self.sizes, sizes])
        self.tables = tuple(np.concatenate(x) for x in zip(self.tables, (keys + self.chars, length[moved], ids[moved]), strict=True))
        self.chars += n

    def all(self, texts: pa.Array, keys: pa.Array, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`sample` of a column, some texts at once."""
        seeds = row_seeds(np.asarray(keys.fill_null(0)), seed)
        found, sizes, part, chars, first = [], [], [], 0, 0
        for i, text in enumerate(texts):
            part.append(text.as_py() or "")
            chars += len(part[-1])
            if chars >= _AT_ONCE or i + 1 == len(texts):
                ids, each = self.sample(part, seeds[first : i + 1])
                found.append(ids)
                sizes.append(each)
                part, chars, first = [], 0, i + 1
        return (np.concatenate(found), np.concatenate(sizes)) if found else (np.zeros(0, np.int32), np.zeros(0, np.int64))

    def sample(self, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        runs = [_RUN.findall(" " + text) if text else [] for text in texts]
        flat = list(chain.from_iterable(runs))
        if not flat:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        if len(self.tables[0]) > _KEPT:
            self._forget()
        number, known = self.number, len(self.number)
        which = np.fromiter(map(number.__getitem__, flat), dtype=np.int64, count=len(flat))
        if len(number) > known:
            self.learn(list(islice(number, known, None)))
        keys, lengths, ids = self.tables
        per_text = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
        text_of = np.repeat(np.arange(len(runs)), per_text)
        size = self.sizes[which]
        ends = np.cumsum(size)
        text_start = np.concatenate([[0], ends])[np.cumsum(per_text) - per_text]
        slots = np.full(int(ends[-1]) + 1, _NONE, dtype=np.int32)
        # of the runs not done: end of what is left, in the tables and in all texts; what is left
        node, place, left, seed = self.starts[which] + size - 1, ends.copy(), size, seeds[text_of]
        origin = text_start[text_of]
        while len(node):
            drawn, edge = node + _uniform(seed, place - origin), self.first[node]
            later = np.flatnonzero(keys[edge] <= drawn)
            while len(later):
                edge[later] += 1
                later = later[keys[edge[later]] <= drawn[later]]
            slots[place] = ids[edge]
            step = lengths[edge].astype(np.int64)
            left = left - step
            live = np.flatnonzero(left > 0)
            node, place, left, seed, origin = (node - step)[live], (place - step)[live], left[live], seed[live], origin[live]
        chosen = np.flatnonzero(slots != _NONE)
        found = slots[chosen]
        borders = np.concatenate([[0], ends])[np.cumsum(per_text)]
        counts = np.diff(np.searchsorted(chosen, borders, side="right"), prepend=0)
        if (found < 0).any():
            owner = np.repeat(np.arange(len(texts)), counts)
            spelled = [self.extra_ids[-1 - i] if i < 0 else (i,) for i in found.tolist()]
            owner = np.repeat(owner, [len(x) for x in spelled])
            found = np.array(list(chain.from_iterable(spelled)), dtype=np.int32)
            counts = np.bincount(owner, minlength=len(texts))
        return found, counts.astype(np.int64)


class _Numbers(dict):
    """Numbers runs as they come."""

    def __missing__(self, run: str) -> int:
        self[run] = found = len(self)
        return found


def _prefixes(pieces: list[tuple[str, int]], longest: int, alpha: float) -> list[tuple[np.ndarray, ...]]:
    """For each length: hashes of the beginnings of pieces, sorted and closed by the largest
    number; where those with given first bits begin; weight and id of each, which is
    ``_NOT_YET`` unless a piece ends there."""
    sizes = np.array([len(text) for text, _ in pieces], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    points, ids = _points("".join(text for text, _ in pieces)), np.array([i for _, i in pieces], dtype=np.int32)
    weights = -alpha * np.log(np.arange(len(pieces)) + 3.0)
    hashes, out = np.zeros(len(pieces), np.uint64), []
    for length in range(1, longest + 1):
        long = np.flatnonzero(sizes >= length)
        hashes[long] = _longer(hashes[long], points[starts[long] + length - 1])
        known = np.unique(hashes[long])
        weight, of = np.zeros(len(known) + 1), np.full(len(known) + 1, _NOT_YET, dtype=np.int32)
        whole = np.flatnonzero(sizes == length)
        place = np.searchsorted(known, hashes[whole])
        weight[place], of[place] = weights[whole], ids[whole]
        guide = np.searchsorted(known, np.arange(1 << 16, dtype=np.uint64) << _GUIDE).astype(np.int32)
        out.append((np.append(known, ~np.uint64(0)), guide, weight, of))
    return out


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def _hashes(points: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` consecutive code points, modulo 2 ** 64."""
    out = np.zeros(max(0, len(points) - length + 1), dtype=np.uint64)
    for k in range(length):
        out = _longer(out, points[k : k + len(out)])
    return out


def _longer(hashes: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The hashes of texts with one more code point."""
    with np.errstate(over="ignore"):
        out = (hashes + points + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def _mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(seeds: np.ndarray, at: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = _mixed(seeds + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (mixed >> np.uint64(11)).astype(np.float64) / (1 << 53)


def row_seeds(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(keys.astype(np.int64).view(np.uint64) + _mixed(np.array([seed], dtype=np.uint64)))


class Pieces:
    """A vocabulary on its executors."""

    def __init__(self, spark: SparkSession, path: str = MODEL):
        self._sent = spark.sparkContext.broadcast(vocabulary(path))

    def encode(self, text: Column, key: Column, alpha: float = ALPHA, seed: int = SEED) -> Column:
        """Array of sampled ids; null for a null text, empty for an empty one.  ``key`` is
        a long; rows without one share a seed."""
        sent = self._sent

        def batches(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            _, pieces, of_byte = sent.value
            lattice = Lattice(pieces, of_byte, alpha)
            for texts, keys in columns:
                yield _as_lists(*lattice.all(texts, keys, seed), texts)

        return F.arrow_udf(batches, "array<int>")(text.cast("string"), key.cast("long"))

    def round_trip(self, text: Column, key: Column, alpha: float = ALPHA, seed: int = SEED) -> Column:
        """``ids`` as :meth:`encode` gives them, and ``lossless``: whether they decode to
        the text.  Both in one visit to Python."""
        sent = self._sent

        def batches(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            raw, pieces, of_byte = sent.value
            raw = np.array(raw, dtype=object)
            lattice = Lattice(pieces, of_byte, alpha)
            for texts, keys in columns:
                found, sizes = lattice.all(texts, keys, seed)
                ends = np.cumsum(sizes)
                same = [decoded(found[e - n : e], raw) == (t.as_py() or "") for t, n, e in zip(texts, sizes, ends, strict=True)]
                yield pa.StructArray.from_arrays([_as_lists(found, sizes, texts), pa.array(same, pa.bool_())], ["ids", "lossless"])

        return F.arrow_udf(batches, "struct<ids: array<int>, lossless: boolean>")(text.cast("string"), key.cast("long"))

    def decode(self, ids: Column) -> Column:
        """The text whose ids these are; null for null."""
        sent = self._sent

        def batches(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            raw = np.array(sent.value[0], dtype=object)
            for column in columns:
                flat, ends = np.asarray(column.flatten()), np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(column), 0)))
                starts = np.concatenate([[0], ends])
                texts = [decoded(flat[a:b], raw) if known else None for a, b, known in zip(starts, ends, column.is_valid().to_pylist(), strict=False)]
                yield pa.array(texts, pa.string())

        return F.arrow_udf(batches, "string")(ids)


def _as_lists(found: np.ndarray, sizes: np.ndarray, texts: pa.Array) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(np.asarray(texts.is_null()), False)), pa.array(found))


def decoded(ids: np.ndarray, raw: np.ndarray) -> str:
    return b"".join(raw[ids].tolist()).decode("utf-8", "replace").removeprefix(" ")


def sampled_pieces(docs: DataFrame, path: str = MODEL, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``ids``, ``n_pieces`` and ``lossless`` (the ids decode to the text) of
    every row.

    A null text has null ids, no pieces and counts as lossless; an empty text has an
    empty array.  Equal rows are cut alike; an empty table gives an empty table.
    """
    pieces = Pieces(docs.sparkSession, path)
    cut = docs.select("doc_id", pieces.round_trip(F.col("text"), F.col("doc_id"), alpha, seed).alias("cut"))
    n = F.coalesce(F.size("cut.ids"), F.lit(0)).cast("long")
    return cut.select("doc_id", "cut.ids", n.alias("n_pieces"), "cut.lossless")
