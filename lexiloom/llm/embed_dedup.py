"""Embedding near-duplicates by cross-polytope hashing.

A vector is padded to a power of two, rotated three times by random signs and a
fast Hadamard transform, and hashed to its nearest signed axis; several such hashes
make up a table's bucket. Each vector is filed under its own bucket and, in order
of lost length, under the next likely ones. Vectors that meet are verified by cosine
in double precision, and a spanning forest of the verified links goes on to
connected components, first of one table, then of all: what one table has joined need
not meet again. Within a component every vector is then held against every
other, in blocks, so links that hashing missed there count too.

The number of hashes follows the number of vectors, so that buckets hold few
strangers; the number of tables follows from it, so that two vectors at the least
cosine meet with the chance ``recall``. Buckets and components of any size are dealt
out by pairs of blocks of ``BLOCK`` vectors; nothing is capped, and what is emitted
is one link per joined vector and one count per vector and block.

Vectors that are null, empty, zero or hold a null or a non-finite component link
with nothing: no links, a component of their own, kept. Only vectors of one length
link. Equal vectors are one class: they link with one another if their cosine with
themselves rounds to the least cosine or more, and their links are counted once per
class, times copies. Floats are kept as they are, all other numbers as doubles. Null ids are ignored when a component's least id is taken;
repeated ids are separate vectors that share an id. An empty table gives none.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.llm.common import sorted_groups, sorted_runs, stored, temporary
from lexiloom.llm.components import components

SEED, PROBES, RANKS, BLOCK = 20, 4, 4, 8192
#: Rows of a bucket up to which all its pairs are compared at once for many buckets.
SMALL = 16
#: Rows of a block that are held against all others at once.
ROWS = 512
#: Strangers that a bucket may be expected to hold, all probes counted.
STRANGERS = 0.15


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, orthonormal."""
    n, h = x.shape[1], 1
    while h < n:
        pairs = x.reshape(len(x), -1, 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


def padded(dim: int) -> int:
    return 1 << max(1, (dim - 1).bit_length())


def hashes_for(n: int, dim: int) -> int:
    k = 1
    while n * (PROBES + 1) > STRANGERS * (2 * padded(dim)) ** k and (2 * padded(dim)) ** (k + 1) < 1 << 62:
        k += 1
    return k


@lru_cache
def _combinations(k: int) -> np.ndarray:
    """Ranks of the axes that a bucket may take, one column per hash; the first is all nearest."""
    return np.array([c for c in itertools.product(range(RANKS), repeat=k) if sum(c) < RANKS])


@lru_cache
def _signs(table: int, k: int, size: int) -> np.ndarray:
    return np.random.default_rng([SEED, table, k, size]).choice([-1.0, 1.0], (k, 3, size))


def buckets(x: np.ndarray, table: int, k: int) -> np.ndarray:
    """Bucket numbers of each row of unit vectors: its own, then its probes (fewer than PROBES for tiny dimensions)."""
    size = padded(x.shape[1])
    x = np.pad(x, ((0, 0), (0, size - x.shape[1])))
    ranks = min(RANKS, size)
    codes, costs = [], []
    for signs in _signs(table, k, size):
        y = x
        for s in signs:
            y = hadamard(y * s)
        far = np.abs(y)
        top = np.argpartition(-far, ranks - 1, axis=1)[:, :ranks]
        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(far, top, 1), axis=1, kind="stable"), 1)
        length = np.take_along_axis(far, top, 1)
        codes.append(top * 2 + (np.take_along_axis(y, top, 1) < 0))
        costs.append((length[:, :1] - length) ** 2)
    wanted = _combinations(k)
    wanted = wanted[(wanted < ranks).all(axis=1)]
    cost = sum(c[:, wanted[:, j]] for j, c in enumerate(costs))
    number = sum(c[:, wanted[:, j]].astype(np.int64) * (2 * size) ** j for j, c in enumerate(codes))
    cost[:, 0] = -1
    probes = min(PROBES + 1, len(wanted))
    return np.take_along_axis(number, np.argsort(cost, axis=1, kind="stable")[:, :probes], 1)


@lru_cache
def tables_for(k: int, dim: int, cosine: float, recall: float) -> int:
    """Tables needed for two vectors at the cosine to meet, from 2,000 random pairs."""
    rng = np.random.default_rng(SEED)
    a, b = rng.standard_normal((2, 2000, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = cosine * a + math.sqrt(1 - cosine**2) * b / np.linalg.norm(b, axis=1, keepdims=True) if dim > 1 else a
    p, q = buckets(a, 0, k), buckets(b, 0, k)
    met = float((p[:, :, None] == q[:, None, :]).any(axis=(1, 2)).mean())
    return max(1, math.ceil(math.log(1 - recall) / math.log(max(1 - met, 1e-9)))) if met < 1 else 1


def unit_rows(raw, kind: str = "f4") -> np.ndarray:
    """Unit vectors in double precision from equally long bytes of floats of a kind."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _classed(kind: str):
    """Function for mapInPandas: bytes of each usable vector and the digest that names its class; nulls for others."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw, named = [], []
            for v in batch["embedding"]:
                x = None if v is None else np.array(v, dtype=np.float64)
                good = x is not None and len(x) and np.isfinite(x).all() and (x != 0).any()
                data = (x.astype(kind) + 0).tobytes() if good else None  # adding 0 makes -0 and 0 alike
                raw.append(data)
                named.append(None if data is None else hashlib.md5(data).digest())
            yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "cls": named, "vec": raw})

    return run


def forest(x: np.ndarray, cosine: float) -> tuple[list[int], list[int]]:
    """Links that span the components of the rows; every pair is accounted for."""
    left, right, rest = [], [], np.arange(len(x))
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            near = x[rest] @ x[i] >= cosine
            if near.any():
                found = rest[near].tolist()
                left += [i] * len(found)
                right += found
                queue += found
                rest = rest[~near]
    return left, right


def bucket_links(x: np.ndarray, keys: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links by place, of rows sorted by key: all of buckets of up to ``SMALL`` rows, many at once, and spanning ones of larger buckets."""
    new = np.ones(len(x), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    bucket, starts = np.cumsum(new) - 1, np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(x)))
    left, right = [np.zeros(0, int)], [np.zeros(0, int)]
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        a, b = forest(x[s : s + n], cosine)
        left.append(s + np.array(a, int))
        right.append(s + np.array(b, int))
    few = np.flatnonzero((sizes > 1) & (sizes <= SMALL))
    few = np.flatnonzero(np.isin(bucket, few))
    for d in range(1, SMALL):
        i = np.flatnonzero(bucket[few[d:]] == bucket[few[:-d]])
        if not len(i):
            break
        i = i[np.einsum("ij,ij->i", x[few[i]], x[few[i + d]]) >= cosine]
        left.append(few[i])
        right.append(few[i + d])
    return np.concatenate(left), np.concatenate(right)


def _dealt(rows: DataFrame, key: list[str], n: str) -> DataFrame:
    """Deal groups of ``n`` rows by pairs of blocks (i, j); ``b`` is a row's own block."""
    return (
        rows.withColumn("blocks", F.ceil(F.col(n) / BLOCK).cast("int"))
        .withColumn("b", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("b", "other"), "j": F.greatest("b", "other")})
        .drop("other", "blocks", n)
        .repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key, "i", "j")
        .sortWithinPartitions(*key, "i", "j")
    )


def _filed(nodes: DataFrame, parts: str, n: int, cosine: float, recall: float, kind: str) -> DataFrame:
    """Buckets (cls, key, and root if known) of classes (cls, vec, and root) in the first table or in all ``others``; a key stands for length, table and bucket."""
    known = [c for c in ("cls", "root") if c in nodes.columns]

    def filed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, rows in batch.groupby(batch["vec"].map(len)):
                x, names = unit_rows(rows["vec"].tolist(), kind), {c: rows[c].to_numpy() for c in known}
                dim = x.shape[1]
                k = hashes_for(n, dim)
                for table in range(tables_for(k, dim, cosine, recall)):
                    if (table == 0) == (parts == "first"):
                        numbers = buckets(x, table, k)
                        times = numbers.shape[1]
                        yield pd.DataFrame({c: np.repeat(v, times) for c, v in names.items()} | {"dim": dim, "part": table, "bucket": numbers.ravel()})

    found = nodes.select(*known, "vec").mapInPandas(filed, "".join(f"{c} binary, " for c in known) + "dim int, part int, bucket long")
    return stored(found.select(*known, F.xxhash64("dim", "part", "bucket").alias("key")), f"embedding-buckets-{parts}")


def _met(nodes: DataFrame, signatures: DataFrame, cosine: float, kind: str) -> DataFrame:
    """Verified links (u, v) that span what meets in a bucket of several classes, not all of one root."""
    counts, wanted = [F.count("*").alias("n")], "n > 1"
    if "root" in signatures.columns:
        counts, wanted = [*counts, F.min("root").alias("least"), F.max("root").alias("most")], "n > 1 AND least <> most"
    shared = signatures.groupBy("key").agg(*counts).filter(wanted).select("key", "n")
    met = signatures.select("cls", "key").join(shared, "key").join(nodes.select("cls", "vec"), "cls")

    order = ["key", "i", "j"]

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in sorted_runs(batches, order):
            for _, rows in run.groupby(run["vec"].map(len)):  # keys of two lengths may be equal by chance
                names, at = rows["cls"].to_numpy(), rows[order].to_numpy("int64")
                left, right = bucket_links(unit_rows(rows["vec"].tolist(), kind), at, cosine)
                if len(left):
                    yield pd.DataFrame({"u": names[left], "v": names[right]})

    return _dealt(met, ["key"], "n").mapInPandas(linked, "u binary, v binary")


def rooted(nodes: DataFrame, cosine: float, recall: float, kind: str = "f4") -> DataFrame:
    """(node, root) of classes (cls, vec) that links join, from what hashing brings together.

    The first table alone joins most of a dense group; in the other tables a bucket
    whose classes have one root already is left out, before any vector moves to it.
    """
    n = nodes.count()
    first = stored(components(_met(nodes, _filed(nodes.select("cls", "vec"), "first", n, cosine, recall, kind), cosine, kind)), "embedding-first")
    known = nodes.join(first, F.col("cls") == F.col("node"), "left").select("cls", "vec", F.coalesce("root", "cls").alias("root"))
    more = _met(nodes, _filed(known, "others", n, cosine, recall, kind), cosine, kind)
    return components(more.unionByName(first.select(F.col("node").alias("u"), F.col("root").alias("v"))))


def link_counts(members: DataFrame, cosine: float, kind: str = "f4") -> DataFrame:
    """(cls, n_links): for classes (root, cls, vec, copies), the copies in other classes of its component at the cosine or over."""
    sizes = stored(members.groupBy("root").agg(F.count("*").alias("n")), "component-sizes")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in sorted_groups(batches, ["root", "i", "j"]):
            i, j = rows["i"].iloc[0], rows["j"].iloc[0]
            for _, own in rows.groupby(rows["vec"].map(len)):
                x, copies, names, b = unit_rows(own["vec"].tolist(), kind), own["copies"].to_numpy(), own["cls"].to_numpy(), own["b"].to_numpy()
                left, right = np.flatnonzero(b == i), np.flatnonzero(b == j)
                other, back = x[right].T, np.zeros(len(right), "int64")
                for at in range(0, len(left), ROWS):
                    rows_ = left[at : at + ROWS]
                    near = x[rows_] @ other >= cosine
                    if i == j:
                        near[np.arange(len(rows_)), np.arange(at, at + len(rows_))] = False
                    else:
                        back += near.T @ copies[rows_]
                    yield pd.DataFrame({"cls": names[rows_], "n_links": near @ copies[right]})
                if i != j:
                    yield pd.DataFrame({"cls": names[right], "n_links": back})

    counts = _dealt(members.join(sizes, "root"), ["root"], "n").mapInPandas(counted, "cls binary, n_links long")
    return counts.groupBy("cls").agg(F.sum("n_links").alias("n_links"))


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, recall: float = 0.997) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id and kept."""
    kind = "f4" if vectors.schema["embedding"].dataType.elementType == T.FloatType() else "f8"
    base = stored(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInPandas(_classed(kind), "vec_id long, cls binary, vec binary"), "vectors")
    nodes = stored(base.dropna(subset=["cls"]).groupBy("cls").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.any_value("vec").alias("vec")), "vector-classes")
    with temporary(keep_last=True):
        roots = stored(rooted(nodes, cosine, recall, kind), "vector-components")
    named = nodes.join(roots.withColumnRenamed("node", "cls"), "cls")
    counts = link_counts(named.select("root", "cls", "vec", "copies"), cosine, kind)
    least = stored(named.groupBy("root").agg(F.min("first").alias("least")), "least")
    linked = named.select("cls", "root").join(least, "root").join(counts, "cls").select("cls", "n_links", "least")
    by_class = nodes.select("cls", "first", "copies").join(linked, "cls", "left")
    by_class = by_class.select("cls", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "first").alias("least"))
    found = base.select("vec_id", "cls").join(by_class, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
