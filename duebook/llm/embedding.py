"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated at random (three rounds of random signs and a fast Hadamard
transform) and hashed to the nearest of the ``2 * dim`` signed axes; a bucket is
the hash of several rotations (Andoni et al., "Practical and Optimal LSH for
Angular Distance", 2015).  Each table holds a vector once; it also probes the
buckets in which one of its hashes is the second nearest axis.  Pairs that meet are
compared exactly, in double precision.

Equal vectors are one node with a count, so copies cost nothing beyond it.  The
number of rotations per bucket follows the logarithm of the number of nodes, rounded
up, so there are at least as many buckets as nodes and a vector meets no more by
chance as their number grows.  The number of tables follows from a trial at the
vectors' own dimension: random pairs at the least cosine are hashed with as many
rotations, and a pair is to be missed by all tables in one of ``1 / MISSED`` cases.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, tasks
from .components import components

COSINE = 0.95
MISSED = 0.005
LEAST_TABLES = 6
# Pairs on which the share that meets in a table is measured, and tables used for it.
TRIAL_PAIRS, TRIAL_TABLES = 512, 16
SEED = 20261


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    rows, width = x.shape
    half = 1
    while half < width:
        y = x.reshape(rows, width // (2 * half), 2, half)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(rows, width)
        half *= 2
    return x


def bucket_codes(vectors: np.ndarray, tables: int, rotations: int, seed: int = SEED) -> np.ndarray:
    """(vector, table, 1 + rotations) bucket codes: the own bucket, then the probes."""
    n, dim = vectors.shape
    width = 1 << max(0, (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = vectors
    signs = np.random.default_rng([seed, width]).integers(0, 2, (tables, rotations, 3, width)) * 2 - 1
    out = np.zeros((n, tables, 1 + rotations), dtype=np.int64)
    at = np.arange(n)
    for t in range(tables):
        axes = np.zeros((rotations, 2, n), dtype=np.int64)
        for r in range(rotations):
            x = padded
            for s in signs[t, r]:
                x = hadamard(x * s)
            size = np.abs(x)
            for rank in (0, 1):
                best = size.argmax(axis=1)
                axes[r, rank] = 2 * best + (x[at, best] < 0)
                size[at, best] = -1
        for probe in range(1 + rotations):
            for r in range(rotations):
                out[:, t, probe] = out[:, t, probe] * (2 * width) + axes[r, int(probe == r + 1)]
    return out


@cache
def meeting_share(dim: int, rotations: int, least: float) -> float:
    """How many random pairs of ``dim`` dimensions at cosine ``least`` meet in a table, less
    two standard errors of the trial."""
    if dim < 2:
        return 1.0
    rng = np.random.default_rng([SEED, dim, rotations])
    a, b = rng.standard_normal((2, TRIAL_PAIRS, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = least * a + math.sqrt(max(0.0, 1 - least * least)) * b / np.linalg.norm(b, axis=1, keepdims=True)
    of_a, of_b = (bucket_codes(x, TRIAL_TABLES, rotations, SEED + 1) for x in (a, b))
    met = (of_a[:, :, :1] == of_b).any(axis=2) | (of_b[:, :, :1] == of_a).any(axis=2)
    share = met.mean()
    return max(0.01, share - 2 * math.sqrt(share * (1 - share) / met.size))


def tables_for(dim: int, rotations: int, least: float = COSINE) -> int:
    missed = 1 - meeting_share(dim, rotations, least)
    return max(LEAST_TABLES, math.ceil(math.log(MISSED) / math.log(missed))) if missed > 0 else LEAST_TABLES


def _hashes(rotations: int, tables: int):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, dims = np.asarray(batch["node"]), np.asarray(batch["dim"])
            vectors = batch["embedding"]
            for dim in np.unique(dims):
                here = np.flatnonzero(dims == dim)
                x = np.asarray(vectors.take(pa.array(here)).flatten(), dtype=np.float64).reshape(len(here), dim)
                codes = bucket_codes(x / np.abs(x).max(axis=1, keepdims=True), tables, rotations)
                n, t, p = codes.shape
                columns = [
                    pa.array(np.repeat(nodes[here], t * p)),
                    pa.array(np.full(n * t * p, dim, dtype=np.int32)),
                    pa.array(np.tile(np.repeat(np.arange(t, dtype=np.int32), p), n)),
                    pa.array(codes.reshape(-1)),
                    pa.array(np.tile(np.arange(p) == 0, n * t)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["node", "dim", "tab", "bucket", "own"])

    return hashed


def _similar(least: float):
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(pc.list_value_length(batch["x"]))
            for dim in np.unique(lengths):
                part = batch.filter(pa.array(lengths == dim))
                pairs = (np.asarray(part[c].flatten(), dtype=np.float64).reshape(-1, dim) for c in ("x", "y"))
                x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in pairs)
                cosine = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
                yield part.select(["a", "b"]).filter(pa.array(cosine >= least))

    return compared


def valid(vector: Column) -> Column:
    """A vector with a direction: not null, without null or non-finite parts, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def embedding_links(nodes: DataFrame, least: float = COSINE) -> DataFrame:
    """Pairs ``a < b`` of ``nodes`` (columns node, embedding; one row per distinct
    vector) with a cosine of ``least`` or more, each once."""
    scratch = Scratch(nodes.sparkSession)
    wide = nodes.select("node", "embedding", F.size("embedding").alias("dim"))
    n, small, dim = nodes.agg(F.count("*"), F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    width = 1 << max(0, ((dim or 1) - 1).bit_length())
    rotations = max(1, math.ceil(math.log(max(n, 2)) / math.log(2 * width)))
    tables = max(tables_for(d, rotations, least) for d in {small or 1, dim or 1})
    hashed = scratch.cut(wide.repartition(tasks(nodes.sparkSession), "node").mapInArrow(_hashes(rotations, tables), "node long, dim int, tab int, bucket long, own boolean"))
    own = hashed.where("own").select("dim", "tab", "bucket", F.col("node").alias("p"))
    probe = hashed.select("dim", "tab", "bucket", F.col("node").alias("q"))
    met = own.join(probe, ["dim", "tab", "bucket"]).where("p <> q")
    pairs = scratch.cut(met.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), "dim").distinct())
    x = nodes.select(F.col("node").alias("a"), F.col("embedding").alias("x"))
    y = nodes.select(F.col("node").alias("b"), F.col("embedding").alias("y"))
    full = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return scratch.cut(full.mapInArrow(_similar(least), "a long, b long"))


def embedding_groups(vectors: DataFrame, least: float = COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every vector.

    Rows sharing a ``vec_id`` are one vector, the smallest of theirs; rows without
    an id are one, with null ids.  Vectors that are null, empty, zero or have null
    or non-finite parts link with nothing, and vectors of different lengths do not
    link.  An empty table gives an empty table.
    """
    scratch = Scratch(vectors.sparkSession)
    each = scratch.cut(vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    good = each.where(F.col("vec_id").isNotNull() & valid(F.col("embedding")))
    nodes = scratch.cut(good.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")))
    links = embedding_links(nodes, least)
    sizes = nodes.select("node", "copies")
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
    others = both.join(sizes.select(F.col("node").alias("other"), F.col("copies").alias("of_other")), "other")
    degrees = scratch.cut(others.groupBy("node").agg(F.sum("of_other").alias("near")))
    roots = components(links, "a", "b")
    known = scratch.cut(
        nodes.join(degrees, "node", "left")
        .join(roots, "node", "left")
        .select(
            "embedding",
            (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("root"),
        )
    )
    mine = F.when(F.col("vec_id").isNotNull() & valid(F.col("embedding")), F.col("embedding")).alias("embedding")
    found = each.select("vec_id", mine).join(known, "embedding", "left")
    component = F.coalesce("root", "vec_id")
    return found.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
