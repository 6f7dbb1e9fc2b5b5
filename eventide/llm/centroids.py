"""Centroid clustering in integers, with PCA-rotated filtering.

Vectors become integers floor(scale * x).  One pass sums the second moments of all of them; their
eigenvectors give a rotation, and each vector is written once with its ``leading`` rotated coordinates and the norm of
the rest.  For a vector and a centroid the squared distance of the leading coordinates plus the squared difference of
the two norms is never more than their squared distance.  A vector is compared with the centroid of the smallest bound
first; centroids whose bound, less a slack for rounding, is above that distance are out, and the others are
compared in integers.  The rotation only decides how many are left, never the result.

No vector is ever shuffled: a round sends one sum for each centroid and component from each task, and the
driver holds centroids alone (``k`` x ``dims`` integers).

Edge cases: vectors of another length, null vectors and vectors with a null or non-finite component are left out, so
an empty table gives no rows; ties go to the smaller centroid number; rows with equal ids are separate
vectors (as first centroids, equal hashes are ordered by components); a null id sorts after every hash; with fewer
vectors than ``k`` there are fewer centroids; integers are held to +-2**27, so that every distance fits a long; further
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.base import by_value, materialize

MOST = 1 << 27
SLACK = 1e-9
BLOCK = 1 << 19  # bounds that a task holds at once


def integers(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), held to +-MOST."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * x), -MOST, MOST).astype(np.int64)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A column of lists of ``dims`` numbers as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def kept(df: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """(_id, _v): the vectors of ``dims`` finite components, as doubles."""
    d = df.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return d.filter((F.size("_v") == dims) & finite)


@dataclass
class Rotation:
    """Centre and orthonormal directions, of falling variance."""

    mean: np.ndarray
    axes: np.ndarray
    leading: int

    def apply(self, ints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading rotated coordinates, and the norm of the others."""
        y = (ints - self.mean) @ self.axes
        return np.ascontiguousarray(y[:, :self.leading]), np.sqrt((y[:, self.leading:] ** 2).sum(axis=1))


def fit_rotation(vectors: DataFrame, dims: int, scale: float, leading: int) -> Rotation:
    """Principal axes of all vectors, from (dims + 1)(dims + 2) / 2 sums."""
    at = np.triu_indices(dims + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for b in batches:
            y = np.ones((b.num_rows, dims + 1))
            y[:, 1:] = integers(matrix(b.column(0), dims), scale)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(at[0].astype(np.int32)), pa.array(at[1].astype(np.int32)), pa.array(total[at])], names=["i", "j", "s"])

    sums = vectors.select("_v").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    m = np.zeros((dims + 1, dims + 1))
    for r in sums:
        m[r.i, r.j] = m[r.j, r.i] = r.s
    mean = m[0, 1:] / max(m[0, 0], 1.0)
    _, axes = np.linalg.eigh(m[1:, 1:] / max(m[0, 0], 1.0) - np.outer(mean, mean))
    return Rotation(mean, axes[:, ::-1], max(1, min(leading, dims)))


def rotated(vectors: DataFrame, dims: int, scale: float, rotation: Rotation) -> DataFrame:
    """(id, v, lead, rest): integers, leading rotated coordinates and residual norm of every vector."""
    kind = vectors.schema["_id"].dataType.simpleString()

    def lists(x: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ints = integers(matrix(b.column(1), dims), scale)
            lead, rest = rotation.apply(ints)
            yield pa.RecordBatch.from_arrays([b.column(0), lists(ints.astype(np.int32)), lists(lead), pa.array(rest)], names=["id", "v", "lead", "rest"])

    return vectors.mapInArrow(run, f"id {kind}, v array<int>, lead array<double>, rest double")


@dataclass
class Centroids:
    """Integer centroids and what the filter compares."""

    ints: np.ndarray
    lead: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, ints: np.ndarray, rotation: Rotation) -> Centroids:
        return cls(ints, *rotation.apply(ints))

    def bounds(self, lead: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances, by vector and centroid."""
        own, theirs = (lead ** 2).sum(axis=1)[:, None], (self.lead ** 2).sum(axis=1)
        low = own + theirs - 2 * (lead @ self.lead.T) + (rest[:, None] - self.rest) ** 2
        return low - SLACK * (own + rest[:, None] ** 2 + theirs + self.rest ** 2 + 1)

    def nearest(self, ints: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid, in integers; ties go to the smaller number."""
        low = self.bounds(lead, rest)
        first = ((ints - self.ints[low.argmin(axis=1)]) ** 2).sum(axis=1)
        row, centroid = np.nonzero(low <= first[:, None])
        exact = np.full(low.shape, np.iinfo(np.int64).max)
        exact[row, centroid] = ((ints[row] - self.ints[centroid]) ** 2).sum(axis=1)
        best = exact.argmin(axis=1)
        return best, exact[np.arange(len(best)), best]

    def assign(self, b: pa.RecordBatch, first: int = 0) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of a batch whose columns from ``first`` on are v, lead, rest: (rows, integers, nearest, distance)."""
        step = max(1, BLOCK // len(self.ints))
        ints = matrix(b.column(first), self.ints.shape[1]).astype(np.int64)
        lead, rest = matrix(b.column(first + 1), self.lead.shape[1]), b.column(first + 2).to_numpy(zero_copy_only=False)
        for at in range(0, b.num_rows, step):
            rows = slice(at, at + step)
            yield rows, ints[rows], *self.nearest(ints[rows], lead[rows], rest[rows])


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The integers of the ``k`` vectors with the smallest SHA-256 of salt and id, in that order."""
    digest = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    return np.array([r.v for r in vectors.select("v", digest.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()], dtype=np.int64)


def moved(vectors: DataFrame, now: Centroids, rotation: Rotation) -> Centroids:
    """Each centroid replaced by the floored mean of the vectors nearest to it; one without vectors stays."""
    k, dims = now.ints.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for b in batches:
            for _, ints, best, _ in now.assign(b):
                some = np.unique(best)
                for c in some:
                    total[c, 0] += (best == c).sum()
                    total[c, 1:] += ints[best == c].sum(axis=0)
        c, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[c, j])], names=["c", "j", "s"])

    sums = vectors.select("v", "lead", "rest").mapInArrow(run, "c int, j int, s long")
    total = [[0] * (dims + 1) for _ in range(k)]
    for r in sums.groupBy("c", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        total[r.c][r.j] = int(r.s)
    ints = [[s // t[0] for s in t[1:]] if t[0] else old for t, old in zip(total, now.ints.tolist())]
    return Centroids.of(np.array(ints, dtype=np.int64), rotation)


def cluster(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, k: int = 16, rounds: int = 3, scale: float = 64.0,
            salt: str = "1:", leading: int = 16) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance) of every kept vector after ``rounds`` rounds, the centroids' integers)."""
    vectors = kept(df, id_col, vector_col, dims)
    kind = vectors.schema["_id"].dataType.simpleString()
    rotation = fit_rotation(vectors, dims, scale, leading)
    stored = materialize(rotated(vectors, dims, scale, rotation))
    start = first_centroids(stored, k, salt)
    if not len(start):
        return df.sparkSession.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long"), start
    now = Centroids.of(start, rotation)
    for _ in range(rounds):
        now = moved(stored, now, rotation)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, _, best, distance in now.assign(b, first=1):
                yield pa.RecordBatch.from_arrays([b.column(0)[rows], pa.array(best.astype(np.int32)), pa.array(distance)], names=[id_col, "cluster", "distance"])

    return stored.mapInArrow(run, f"`{id_col}` {kind}, cluster int, distance long"), now.ints


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with the sums of distances over its cluster and over all, and its centroid's digest: a join with one row for
    each centroid, whose number bounds what is sent to the tasks."""
    spark: SparkSession = assigned.sparkSession
    assigned = materialize(assigned)
    sums = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    each = [(c, sums.get(c, 0), sum(sums.values()), d) for c, d in enumerate(digests)]
    named = spark.createDataFrame(each, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(named), "cluster").select(assigned.columns[0], "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 16, dims: int = 64, rounds: int = 3, scale: int = 64, salt: str = "1:") -> str:
    """The same clustering in DuckDB SQL: every distance, no filter."""
    near = """a{i} AS MATERIALIZED (SELECT rid, min(d * 65536 + c) % 65536 AS c, min(d * 65536 + c) // 65536 AS d FROM (SELECT rid, c,
  CAST(list_sum(list_transform(list_zip(v.x, m.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS HUGEINT) AS d FROM v, c{i} m) GROUP BY rid)"""
    move = """s{i} AS (SELECT c, j, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(x) AS x, generate_subscripts(x, 1) AS j FROM a{i} JOIN v USING (rid)) GROUP BY c, j),
c{n} AS MATERIALIZED (SELECT c, coalesce(f.x, o.x) AS x FROM c{i} o LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS x FROM s{i} GROUP BY c) f USING (c))"""
    steps = ",\n".join(f"{near.format(i=i)},\n{move.format(i=i, n=i + 1)}" for i in range(rounds))
    return f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM (SELECT sha256('{salt}' || vec_id) AS h, x FROM v ORDER BY h, x LIMIT {k})),
{steps},
{near.format(i=rounds)},
t AS (SELECT c, sum(d) AS ci FROM a{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(ci AS BIGINT) AS cluster_inertia,
  CAST((SELECT sum(d) FROM a{rounds}) AS BIGINT) AS inertia, sha256(list_aggregate(list_transform(m.x, lambda y: CAST(y AS VARCHAR)), 'string_agg', ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (rid) JOIN t USING (c) JOIN c{rounds} m USING (c)"""


by_value(__name__)
