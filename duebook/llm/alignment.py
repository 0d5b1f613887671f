"""Alignment of the tokens of two tokenizers, and how often token ids are linked.

Both tokenizers cut the same bytes, a space and the text.  Where tokens of both end
at one byte, they cut the text into groups; two tokens are linked if they share one.
The count of an id pair is the number of texts that hold it linked.

Most groups are one token of A and the token of B with the same bytes.  These are
looked up in a precomputed array and counted in a vector as long as A's vocabulary.
Only pairs of other groups are shuffled, after each chunk of texts has numbered its
distinct groups and counted its distinct pairs; the counts come back to the chunk,
which needs them once for each distinct group.  Vectors over A's vocabulary are the
only data that reach the driver.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_BYTES = 1 << 22  # of text; a longer text is a chunk of its own
_MARK = "▁"
# Fixed value: the pre-tokenization of byte-level BPE.
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Visible Latin-1 characters stand for themselves, the others follow from U+0100 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _within(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``starts[k], ..., starts[k] + sizes[k] - 1`` of all k, one after another."""
    first = np.cumsum(sizes) - sizes
    return np.repeat(starts - first, sizes) + np.arange(int(sizes.sum()))


def _firsts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``; empty runs have 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(sizes, dtype=np.int64)
    return total[ends] - total[ends - sizes]


@dataclass
class Aligned:
    """Tokens of many texts and the groups they fall into, both in order."""

    a: np.ndarray
    b: np.ndarray
    a_sizes: np.ndarray  # tokens of A in each group
    b_sizes: np.ndarray
    n_a: np.ndarray  # tokens of A in each text
    n_b: np.ndarray
    n_groups: np.ndarray

    @property
    def text_of_group(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n_groups)), self.n_groups)


class Pair:
    """Two tokenizers, the bytes of their tokens and A's tokens that B has too."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken

        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        self.a_bytes = [b""] * len(spec["model"]["vocab"])
        for token, i in spec["model"]["vocab"].items():
            self.a_bytes[i] = b"" if i in special else bytes(alphabet[c] for c in token)
        # Merging by rank gives the file's own merges: ids rise with the merges, and
        # each token is what its own bytes merge into (a test checks both).
        ranks = {token: i for i, token in enumerate(self.a_bytes) if token}
        self.a = tiktoken.Encoding("a", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.b_bytes, same = [], {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
                same.setdefault(self.b_bytes[i], i)
            elif self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i):
                self.b_bytes.append(b"")
            else:
                self.b_bytes.append(piece.replace(_MARK, " ").encode())
                same[self.b_bytes[i]] = i
        self.n_a, self.n_b = len(self.a_bytes), len(self.b_bytes)
        self.a_lengths = np.array([len(x) for x in self.a_bytes])
        self.b_lengths = np.array([len(x) for x in self.b_bytes])
        self.identity = np.array([same.get(x, -1) if x else -1 for x in self.a_bytes])
        # each id with what may follow it in a digest, as bytes
        shown = [f"{i}{end}" for n, ends in ((self.n_a, ",|"), (self.n_b, ",;")) for end in ends for i in range(n)]
        self.shown_sizes = np.array([len(x) for x in shown])
        self.shown = np.array(shown, dtype=bytes).view(np.uint8).reshape(len(shown), -1)
        self.is_shown = np.arange(self.shown.shape[1]) < self.shown_sizes[:, None]

    def tokens(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both tokenizers; none for a text that either does not give back."""
        found = self.b.encode([t or "" for t in texts], num_threads=1)
        a, b = [], []
        for text, pieces in zip(texts, found, strict=True):
            spaced = " " + (text or "")
            ids = self.a.encode_ordinary(spaced) if text else []
            raw = spaced.encode()
            whole = text and b"".join(map(self.a_bytes.__getitem__, ids)) == raw
            whole = whole and b"".join(map(self.b_bytes.__getitem__, pieces)) == raw
            a.append(ids if whole else [])
            b.append(pieces if whole else [])
        return a, b

    def align(self, texts: list[str | None]) -> Aligned:
        a_lists, b_lists = self.tokens(texts)
        n_a, n_b = (np.array([len(x) for x in lists], np.int64) for lists in (a_lists, b_lists))
        a = np.fromiter(chain.from_iterable(a_lists), np.int64, int(n_a.sum()))
        b = np.fromiter(chain.from_iterable(b_lists), np.int64, int(n_b.sum()))
        a_ends, b_ends = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        # texts end alike in both, so the ends of all texts can be compared at once
        a_cut, b_cut = (np.flatnonzero(_held(x, y)) for x, y in ((a_ends, b_ends), (b_ends, a_ends)))
        per_text = np.searchsorted(a_cut, np.cumsum(n_a), "left")
        return Aligned(a, b, np.diff(a_cut, prepend=-1), np.diff(b_cut, prepend=-1), n_a, n_b, np.diff(per_text, prepend=0))

    def digests(self, x: Aligned) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2`` for each text, empty without tokens."""
        a_last, b_last = np.zeros(len(x.a), bool), np.zeros(len(x.b), bool)
        a_last[np.cumsum(x.a_sizes) - 1] = True
        b_last[np.cumsum(x.b_sizes) - 1] = True
        place_a = np.arange(len(x.a)) + np.repeat(_firsts(x.b_sizes), x.a_sizes)
        place_b = np.arange(len(x.b)) + np.repeat(np.cumsum(x.a_sizes), x.b_sizes)
        # ids in their order, each with the number of its row in ``shown``
        code = np.empty(len(x.a) + len(x.b), np.int64)
        code[place_a] = x.a + a_last * self.n_a
        code[place_b] = 2 * self.n_a + x.b + b_last * self.n_b
        out, first = [], 0
        for n in (x.n_a + x.n_b).tolist():
            mine = code[first : first + n]
            text = self.shown[mine][self.is_shown[mine]][:-1]  # without the last semicolon
            out.append(hashlib.sha256(text.tobytes()).hexdigest() if n else "")
            first += n
        return out


def _held(x: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Whether each of the rising numbers ``x`` is among the rising numbers ``among``."""
    if not len(among):
        return np.zeros(len(x), bool)
    return among[np.minimum(np.searchsorted(among, x), len(among) - 1)] == x


@cache
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


# --- chunks -------------------------------------------------------------------


def _same_groups(x: Aligned, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one group of each kind among ``group``, the kind of each): groups with the same
    tokens.  Kinds come from hashes and are compared token by token; should two kinds
    ever meet, they are hashed anew."""
    firsts = _firsts(x.a_sizes), _firsts(x.b_sizes)
    sides = [(ids, start[group], sizes[group]) for ids, start, sizes in zip((x.a, x.b), firsts, (x.a_sizes, x.b_sizes), strict=True)]
    for salt in count():
        total = np.zeros(len(group), np.uint64)
        for side, (ids, start, sizes) in enumerate(sides):
            at = _within(start, sizes)
            place = at - np.repeat(start, sizes)
            mixed = _mixed((ids[at] + (place << 20)).astype(np.uint64) ^ (np.uint64(2 * salt + side + 1) << np.uint64(56)))
            total = _mixed(total + np.add.reduceat(mixed, _firsts(sizes))) if len(group) else total
        _, first, kind = np.unique(total, return_index=True, return_inverse=True)
        alike = True
        for ids, start, sizes in sides:
            model = first[kind]
            alike = alike and np.array_equal(sizes[model], sizes)
            alike = alike and np.array_equal(ids[_within(start[model], sizes)], ids[_within(start, sizes)])
        if alike:
            return group[first], kind


def _ids_of_kinds(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, n_ids: int):
    """Distinct ids of each group, as (id, times, number of ids of the group)."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    key, times = np.unique(of * n_ids + ids[_within(starts, sizes)], return_counts=True)
    return key % n_ids, times, np.bincount(key // n_ids, minlength=len(sizes))


@dataclass
class Chunk:
    """What a chunk of texts needs of the corpus, and what it tells it.

    A text is a list of codes with their numbers of groups: the id of A for a pair of
    the identity array, else ``n_a`` and the number of the kind of group.
    """

    pairs: np.ndarray  # a * n_b + b, rising
    pair_texts: np.ndarray  # texts that hold the pair, but for pairs of the identity array
    identity_texts: np.ndarray  # texts that hold a and its identity, for each a
    kind_pairs: np.ndarray  # pairs of each kind of group
    kind_pair: np.ndarray  # their places in ``pairs``
    kind_links: np.ndarray  # their links
    codes: np.ndarray
    times: np.ndarray
    n_codes: np.ndarray  # of each text
    n_links: np.ndarray


def chunk_of(x: Aligned, tokenizers: Pair) -> Chunk:
    n_texts, n_a, n_b = len(x.n_a), tokenizers.n_a, tokenizers.n_b
    text = x.text_of_group
    a_start, b_start = _firsts(x.a_sizes), _firsts(x.b_sizes)
    n_links = _sums(x.a_sizes * x.b_sizes, x.n_groups)

    plain = (x.a_sizes == 1) & (x.b_sizes == 1)
    plain[plain] = tokenizers.identity[x.a[a_start[plain]]] == x.b[b_start[plain]]
    plain_key, plain_times = np.unique(text[plain] * n_a + x.a[a_start[plain]], return_counts=True)
    identity_texts = np.bincount(plain_key % n_a, minlength=n_a)

    other = np.flatnonzero(~plain)
    model, kind = _same_groups(x, other)
    n_kinds = max(1, len(model))
    a_ids, a_times, a_n = _ids_of_kinds(x.a, a_start[model], x.a_sizes[model], n_a)
    b_ids, b_times, b_n = _ids_of_kinds(x.b, b_start[model], x.b_sizes[model], n_b)
    # all distinct ids of A with all distinct ids of B of a kind
    kind_of_a = np.repeat(np.arange(len(model)), a_n)
    b_at = _within(_firsts(b_n)[kind_of_a], b_n[kind_of_a])
    a_at = np.repeat(np.arange(len(a_ids)), b_n[kind_of_a])
    pairs, kind_pair = np.unique(a_ids[a_at] * n_b + b_ids[b_at], return_inverse=True)
    kind_links = a_times[a_at] * b_times[b_at]
    kind_pairs = a_n * b_n

    kind_key, kind_times = np.unique(text[other] * n_kinds + kind, return_counts=True)
    of_text, of_kind = kind_key // n_kinds, kind_key % n_kinds
    held = kind_pair[_within(_firsts(kind_pairs)[of_kind], kind_pairs[of_kind])]
    text_pair = np.unique(np.repeat(of_text, kind_pairs[of_kind]) * max(1, len(pairs)) + held)
    held = text_pair % max(1, len(pairs))
    same = tokenizers.identity[pairs // n_b] == pairs % n_b
    pair_texts = np.bincount(held, minlength=len(pairs))
    also = (text_pair // max(1, len(pairs)))[same[held]] * n_a + (pairs // n_b)[held[same[held]]]
    identity_texts = identity_texts + np.bincount(also[~np.isin(also, plain_key)] % n_a, minlength=n_a)
    pair_texts[same] = 0

    texts = np.concatenate([plain_key // n_a, of_text])
    order = np.argsort(texts, kind="stable")
    codes = np.concatenate([plain_key % n_a, n_a + of_kind])[order]
    times = np.concatenate([plain_times, kind_times])[order]
    n_codes = np.bincount(texts, minlength=n_texts)
    return Chunk(pairs, pair_texts, identity_texts, kind_pairs, kind_pair, kind_links, codes, times, n_codes, n_links)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str | None]]]:
    """(ids, texts) of up to ``CHUNK_BYTES``, one text at least."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if texts and size + len(text or "") > CHUNK_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(text)
            size += len(text or "")
    if texts:
        yield ids, texts


_TEXT, _DICTIONARY, _VECTOR = range(3)
_STATED = (
    "kind int, chunk long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "codes array<int>, times array<int>, "
    "pairs array<long>, pair_texts array<long>, kind_pairs array<int>, kind_pair array<int>, kind_links array<long>, id "
)


def _align_and_count(paths: tuple[str, str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text, one dictionary of groups and pairs for each chunk, and one
    vector of identity counts for the partition."""
    from pyspark import TaskContext

    first = TaskContext.get().partitionId() << 32
    tokenizers, total, id_type = pair(*paths), None, pa.null()
    i32, i64 = pa.int32(), pa.int64()
    none = np.zeros(0, np.int64)

    def row(kind, chunk, numbers, digests, codes, times, lists, ids):
        n = len(ids)
        columns = [
            pa.array([kind] * n, i32), pa.array([chunk] * n, i64), *(pa.array(v, i64) for v in numbers), pa.array(digests, pa.string()),
            codes, times, *lists, ids,
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _STATED.split(", ")])

    def single(*values):
        return [_lists(v, np.array([len(v)]), t) for v, t in zip(values, (i64, i64, i32, i32, i64), strict=True)]

    def empty(n):
        return [pa.nulls(n, pa.list_(t)) for t in (i64, i64, i32, i32, i64)]

    def watched():
        nonlocal id_type
        for batch in batches:
            id_type = batch["id"].type
            yield batch

    for number, (ids, texts) in enumerate(_chunks(watched())):
        x = tokenizers.align(texts)
        c = chunk_of(x, tokenizers)
        total = c.identity_texts if total is None else total + c.identity_texts
        numbers = (x.n_a, x.n_b, x.n_groups, c.n_links)
        codes, times = _lists(c.codes, c.n_codes, i32), _lists(c.times, c.n_codes, i32)
        yield row(_TEXT, first + number, numbers, tokenizers.digests(x), codes, times, empty(len(ids)), pa.array(ids, id_type))
        lists = single(c.pairs, c.pair_texts, c.kind_pairs, c.kind_pair, c.kind_links)
        nothing = pa.nulls(1, pa.list_(i32))
        yield row(_DICTIONARY, first + number, [[None]] * 4, [None], nothing, nothing, lists, pa.nulls(1, id_type))
    if total is not None:
        at = np.flatnonzero(total)
        nothing = pa.nulls(1, pa.list_(i32))
        yield row(_VECTOR, None, [[None]] * 4, [None], nothing, nothing, single(at, total[at], none, none, none), pa.nulls(1, id_type))


def _scored(n_b: int, vectors, mine: pa.Table, answers: pa.Table) -> pa.Table:
    """Sums over the links of a chunk's texts, from the counts of its pairs."""
    counts, best = vectors
    kind = mine["kind"].to_numpy()
    found = mine.filter(pa.array(kind == _DICTIONARY))
    pairs = found["pairs"].combine_chunks().flatten().to_numpy()
    kind_pairs, kind_pair, kind_links = (found[c].combine_chunks().flatten().to_numpy() for c in ("kind_pairs", "kind_pair", "kind_links"))
    known = answers["pair"].to_numpy()
    order = np.argsort(known)
    a = pairs // n_b
    total = counts[a]  # of pairs of the identity array; the others have answers
    answered = _held(pairs, known[order])
    total[answered] = answers["n"].to_numpy()[order][np.searchsorted(known[order], pairs[answered])]
    at_best = total == best[a]
    sums = [_sums(v[kind_pair] * kind_links, kind_pairs) for v in (total, at_best)]
    values = np.concatenate([counts, sums[0]]), np.concatenate([counts == best, sums[1]]).astype(np.int64)

    texts = mine.filter(pa.array(kind == _TEXT))
    codes, times = texts["codes"].combine_chunks(), texts["times"].combine_chunks().flatten().to_numpy()
    sizes, flat = np.diff(codes.offsets.to_numpy()), codes.flatten().to_numpy()
    out = [pa.array(_sums(value[flat] * times, sizes)) for value in values]
    kept = ["id", "n_a", "n_b", "n_groups", "n_links"]
    return pa.table([*(texts[c] for c in kept), out[1], out[0], texts["groups_sha256"]], [*kept, "n_best", "count_sum", "groups_sha256"])


def align(docs: DataFrame, id_column: str = "doc_id", text: str = "text", paths: tuple[str, str] = (TOKENIZER_A, TOKENIZER_B)) -> DataFrame:
    """Per row of ``docs`` its id, ``a_ids`` and ``b_ids`` and the sizes of the groups
    on both sides (``a_sizes``, ``b_sizes``), in order.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte
    (such as those with U+2581), have empty lists.  Ids may be null or repeat.
    """
    schema = f"{_typed(docs, id_column)}, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = pair(*paths)
        id_type = pa.null()

        def watched():
            nonlocal id_type
            for batch in batches:
                id_type = batch["id"].type
                yield batch

        for ids, texts in _chunks(watched()):
            x = tokenizers.align(texts)
            lists = [(x.a, x.n_a), (x.b, x.n_b), (x.a_sizes, x.n_groups), (x.b_sizes, x.n_groups)]
            columns = [pa.array(ids, id_type), *(_lists(v, n, pa.int32()) for v, n in lists)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "a_ids", "b_ids", "a_sizes", "b_sizes"])

    found = _named(docs, id_column, text).mapInArrow(rows, schema)
    return found.withColumnRenamed("id", id_column)


def _named(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))


def _typed(docs: DataFrame, id_column: str) -> str:
    return f"id {docs.schema[id_column].dataType.simpleString()}"


@dataclass
class Links:
    """``counts``: ``a_id``, ``b_id`` and ``n_docs`` of every linked id pair.
    ``documents``: a row for each text with its tokens, groups and links."""

    counts: DataFrame
    documents: DataFrame


def link(docs: DataFrame, id_column: str = "doc_id", text: str = "text", paths: tuple[str, str] = (TOKENIZER_A, TOKENIZER_B)) -> Links:
    """All links of the texts of ``docs`` and their counts over all rows.

    ``documents`` has the id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``
    (links whose count is the highest of their A id, ties included), ``count_sum`` and
    ``groups_sha256``.  Every row counts as a text of its own, also where ids are null
    or repeat.  Texts without tokens (see :func:`align`) have zeros and ''.  Other
    columns of ``docs`` are not read.  An empty table gives empty tables.

    A task holds a chunk of texts, or one longer text with its distinct pairs.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    tokenizers = pair(*paths)
    n_a, n_b = tokenizers.n_a, tokenizers.n_b
    stated = _STATED.rsplit(", ", 1)[0] + f", {_typed(docs, id_column)}"
    rows = scratch.cut(_named(docs, id_column, text).mapInArrow(lambda batches: _align_and_count(paths, batches), stated))

    def told(kind: int) -> DataFrame:
        each = rows.where(F.col("kind") == kind).select("chunk", F.explode(F.arrays_zip("pairs", "pair_texts")).alias("x"))
        return each.select("chunk", F.col("x.pairs").alias("pair"), F.col("x.pair_texts").alias("n"))

    asked = scratch.cut(told(_DICTIONARY).where("n > 0"))
    irregular = scratch.cut(asked.groupBy("pair").agg(F.sum("n").alias("n")))
    vector = told(_VECTOR).groupBy(F.col("pair").alias("a")).agg(F.sum("n").alias("n"))
    a_of: Column = F.floor(F.col("pair") / n_b).cast("long")
    counts, best = np.zeros(n_a, np.int64), np.zeros(n_a, np.int64)
    for r in vector.toArrow().to_pylist():  # one row for each id of A at most, as below
        counts[r["a"]] = best[r["a"]] = r["n"]
    for r in irregular.groupBy(a_of.alias("a")).agg(F.max("n").alias("n")).toArrow().to_pylist():
        best[r["a"]] = max(best[r["a"]], r["n"])

    sent = spark.sparkContext.broadcast((counts, best))
    answers = asked.select("chunk", "pair").join(irregular, "pair")
    mine = rows.where(F.col("kind") != _VECTOR).drop("pair_texts")
    shown = f"{_typed(docs, id_column)}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    documents = mine.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        lambda left, right: _scored(n_b, sent.value, left, right), shown
    )
    at = np.flatnonzero(counts)
    identity = pa.table({"a_id": at, "b_id": tokenizers.identity[at], "n_docs": counts[at]})
    named = irregular.select(a_of.alias("a_id"), (F.col("pair") % n_b).alias("b_id"), F.col("n").alias("n_docs"))
    return Links(named.union(spark.createDataFrame(identity)), documents.withColumnRenamed("id", id_column))
