"""Lloyd's clustering in integers, nearest centroids by equal-average equal-variance search.

Components are floored to integers, so sums, distances and new centroids are exact and no result
depends on how Spark deals out the rows. For a vector x and a centroid c of k components, with component means m and
lengths v of what deviates from them, the squared distance is at least
k (mx - mc)^2 + (vx - vc)^2. Centroids are sorted by their mean; a search begins at the vector's mean and goes
outward on both sides. A side ends where k (mx - mc)^2 alone exceeds the best distance so far (all
further centroids have a larger one); on the way, centroids whose whole bound exceeds it are skipped, and only the rest
get an exact integer distance. Bounds are doubles, widened by far more than their rounding, hence no
nearest centroid is rejected. A batch of vectors goes through these steps together.

A round reads the vectors once, adds up each task's vectors by cluster and moves one row of sums a cluster and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lidarframe.llm.common import materialise, table

CLUSTERS = 40
ROUNDS = 5
COMPONENTS = 64
SCALE = 256
SEED = 2
_LARGEST = 1 << 27  # of a component: 64 squared differences of such numbers fit into a long
_BATCH = 4096
_SLACK = 1e-9


class Centroids:
    """Centroids in order of their means, ready for searches. ``visited`` counts exact distances."""

    def __init__(self, rows: np.ndarray):
        self.rows = np.asarray(rows, np.int64)
        sums = self.rows.sum(1)
        self.order = np.argsort(sums, kind="stable")
        self.sorted = self.rows[self.order]
        self.mean, self.deviation = _moments(self.sorted)
        self.visited = 0

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each row, the smaller one in ties, and its squared distance."""
        n, k = x.shape
        last = len(self.rows)
        mean, deviation = _moments(x)
        high = np.searchsorted(self.mean, mean)  # the next centroid on each side
        low = high - 1
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, last)
        going = np.arange(n)
        while going.size:
            # the side whose next centroid has the closer mean
            below = np.where(low[going] >= 0, mean[going] - self.mean[np.maximum(low[going], 0)], np.inf)
            above = np.where(high[going] < last, self.mean[np.minimum(high[going], last - 1)] - mean[going], np.inf)
            down = below <= above
            at = np.where(down, low[going], high[going])
            low[going[down]] -= 1
            high[going[~down]] += 1
            gap = k * np.minimum(below, above) ** 2
            limit = best[going] * (1 + _SLACK) + 1
            # both sides are beyond the mean inequality: the rest is further still
            going, at, gap, limit = (a[gap <= limit] for a in (going, at, gap, limit))
            bound = gap + (deviation[going] - self.deviation[at]) ** 2
            near = bound <= limit
            who, c = going[near], at[near]
            diff = x[who] - self.sorted[c]
            distance = np.einsum("ij,ij->i", diff, diff)
            self.visited += len(who)
            name = self.order[c]
            better = (distance < best[who]) | ((distance == best[who]) & (name < number[who]))
            best[who[better]] = distance[better]
            number[who[better]] = name[better]
            going = going[(low[going] >= 0) | (high[going] < last)]
        return number, best


def _moments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean = x.mean(1)
    return mean, np.sqrt(((x - mean[:, None]) ** 2).sum(1))


def _matrix(column: pa.ListArray, components: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, components)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _BATCH):
            yield batch.slice(start, _BATCH)


def integer_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = COMPONENTS,
    scale: float = SCALE,
) -> DataFrame:
    """(vec_id, v array<long>) of the rows whose vector has ``components`` components, none null or
    non-finite; v is floor(scale * x) in doubles. Numbers from 2^27 on are an error, as their distances leave a long."""
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{vector_column}`").cast("array<double>").alias("v")
    ).where(
        f"size(v) = {components} and forall(v, x -> coalesce(not isnan(x) and abs(x) < double('infinity'), false))"
    )
    large = F.expr(f"exists(v, x -> abs({scale}D * x) >= {_LARGEST}D)")
    problem = F.raise_error(F.lit("vectors with components too large for integer distances")).cast("array<bigint>")
    floored = F.expr(f"transform(v, x -> cast(floor({scale}D * x) as bigint))")
    return rows.select("vec_id", F.when(large, problem).otherwise(floored).alias("v"))


def first_centroids(kept: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:vec_id``, in this order; a null id counts as an
    empty one, equal ids go by their components."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = kept.select(F.sha2(name.cast("binary"), 256).alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return np.array([r.v for r in rows], np.int64)


def _summed(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(centroids)
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in _batches(batches):
            x = _matrix(batch.column("v"), centroids.shape[1])
            number, _ = search.nearest(x)
            np.add.at(sums, number, x)
            counts += np.bincount(number, minlength=len(counts))
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array(counts[full]), pa.array(list(sums[full]), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"],
        )

    return run


def improve(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: floor of the mean of each centroid's vectors, component by component; empty ones stay."""
    parts = kept.select("v").mapInArrow(_summed(centroids), "cluster int, n long, sums array<bigint>")
    places = range(centroids.shape[1])
    totals = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.col("sums")[k].cast("decimal(38,0)")) for k in places]).alias("sums"),
    )
    out = centroids.copy()
    for r in totals.collect():  # a row for each cluster
        out[r.cluster] = [int(s) // r.n for s in r.sums]
    return out


def _digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = COMPONENTS,
    scale: float = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for each usable row.

    Rows whose vector is null, of another length, or holds null or non-finite components are left out; a
    null vec_id stays null. Repeated rows are rows like any other. With fewer rows than ``clusters``
    each is a centroid at first; equal centroids leave all but the first empty. A table without a usable row
    gives an empty table. Other columns are not read, so their names cannot clash.
    """
    kept = materialise(integer_vectors(vectors, id_column, vector_column, components, scale), "integers")
    centroids = first_centroids(kept, clusters, seed)
    if not len(centroids):
        centroids = np.zeros((1, components), np.int64)
    else:
        for _ in range(rounds):
            centroids = improve(kept, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(centroids)
        for batch in _batches(batches):
            number, distance = search.nearest(_matrix(batch.column("v"), components))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance, pa.int64())],
                ["vec_id", "cluster", "distance"],
            )

    found = materialise(kept.mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters")
    inertia = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    total = sum(inertia.values())
    facts = [(k, d, total, _digest(centroids[k])) for k, d in sorted(inertia.items())]
    known = kept.sparkSession.createDataFrame(
        facts, "__cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.join(F.broadcast(known), F.col("cluster") == F.col("__cluster")).select(  # a row for each cluster
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op11_eenns_clustering(spark, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The rounds one after the other, each by comparing all vectors with all centroids."""
    nearest = """
n{k} AS (
  SELECT r, c AS cluster, d AS distance FROM (
    SELECT x.r, c{k}.c, list_sum(list_transform(list_zip(x.v, c{k}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM x, c{k}) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
    update = """
s{k} AS (
  SELECT cluster, p, sum(e)::BIGINT AS s, count(*) AS n
  FROM (SELECT cluster, unnest(v) AS e, generate_subscripts(v, 1) AS p FROM n{k} JOIN x USING (r)) GROUP BY ALL),
m{k} AS (SELECT cluster, list((s - (((s % n) + n) % n)) // n ORDER BY p) AS v FROM s{k} GROUP BY cluster),
c{j} AS MATERIALIZED (SELECT c, coalesce(m{k}.v, c{k}.v) AS v FROM c{k} LEFT JOIN m{k} ON c = cluster)"""
    steps = []
    for k in range(ROUNDS):
        steps += [nearest.format(k=k), update.format(k=k, j=k + 1)]
    return f"""
WITH x AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {COMPONENTS}
    AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM x) ORDER BY h, v LIMIT {CLUSTERS}),
{",".join(steps).strip()},
{nearest.format(k=ROUNDS).strip()}
SELECT vec_id, cluster::INTEGER AS cluster, distance,
  (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c{ROUNDS}.v, ',')) AS centroid_sha256
FROM n{ROUNDS} JOIN x USING (r) JOIN c{ROUNDS} ON c = cluster
"""


OP11_SQL = _sql()
