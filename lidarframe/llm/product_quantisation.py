"""Near-duplicate vectors by product quantisation, without false dismissals.

Vectors are scaled to length one, so cosine >= c means distance <= r = sqrt(2 - 2c).

- Coarse lists: every vector belongs to the cell of its nearest coarse centroid. A vector x probes
  another cell if its distance to the plane half way between both centroids is at most r; a
  vector within r of x cannot lie in any cell that is not probed.
- Codes: the residual to the cell's centroid is cut into subspaces and each part replaced by its
  nearest codeword. A vector keeps the distance err to what its codes stand for.
- Search: distances of a query to the codes of a list are sums of table entries. A member is a
  candidate if this distance is at most r + err, which holds for all within r by the triangle inequality.
- Rerank: the cosine of candidates in double precision.

The centroids are fitted on at most ``SAMPLE`` vectors; they steer the work, the result does not
depend on them. Lists are cut into tiles of about ``TILE`` members, each with its own queries, so
no list is gathered in one task. Equal vectors of a label are one class and are searched once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lidarframe.llm.common import materialise, table
from lidarframe.llm.components import connected_components

SAMPLE = 8192
CELL_ROWS = 2048  # vectors of a list, on average
MAX_CELLS = 1024
SUBSPACES = 8
CODES = 64
TILE = 4096
_SLACK = 1e-6  # of distances, far above rounding and far below what would cost time


def _unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between rows."""
    d = (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None]
    return np.maximum(d, 0, out=d)


def _k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    pick = np.random.default_rng(7).permutation(len(x))[: min(k, len(x))]
    centres = x[np.sort(pick)].copy()
    for _ in range(rounds):
        near = _distances(x, centres).argmin(1)
        count = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        full = count > 0
        centres[full] = sums[full] / count[full, None]
    return np.unique(centres, axis=0)


class Quantiser:
    """Coarse centroids and codewords for vectors of one dimension."""

    def __init__(self, dim: int, sample: np.ndarray | None = None, cells: int = 1):
        if sample is None:
            self.centres = np.zeros((1, dim))
            residual = np.zeros((1, dim))
        else:
            self.centres = _k_means(sample, cells)
            residual = sample - self.centres[_distances(sample, self.centres).argmin(1)]
        self.parts = [p for p in np.array_split(np.arange(dim), SUBSPACES) if p.size]
        self.words = [_k_means(residual[:, p], CODES) for p in self.parts]
        gaps = np.sqrt(_distances(self.centres, self.centres))
        self.gaps = np.where(gaps == 0, 1, gaps)

    def encode(self, unit: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the distances between vectors and what the codes stand for."""
        residual = unit - self.centres[cell]
        codes = np.empty((len(unit), len(self.parts)), np.uint8)
        err = np.zeros(len(unit))
        for k, (p, words) in enumerate(zip(self.parts, self.words)):
            d = _distances(residual[:, p], words)
            codes[:, k] = d.argmin(1)
            diff = residual[:, p] - words[codes[:, k]]
            err += (diff * diff).sum(1)
        return codes, np.sqrt(err)

    def table_distances(self, unit: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Distances of queries to the codes of one list: sums of table entries."""
        residual = unit - self.centres[cell]
        total = np.zeros((len(unit), len(codes)))
        for k, (p, words) in enumerate(zip(self.parts, self.words)):
            total += _distances(residual[:, p], words)[:, codes[:, k]]
        return np.sqrt(total)

    def place(self, unit: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector; for each vector and cell if the cell must be probed."""
        d = _distances(unit, self.centres)
        cell = d.argmin(1)
        own = d[np.arange(len(unit)), cell]
        plane = (d - own[:, None]) / (2 * self.gaps[cell])
        return cell, plane <= radius + _SLACK


def _vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix in double precision) for each dimension in an Arrow list column."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(offsets)
    found = []
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        found.append((rows, values[offsets[rows][:, None] + np.arange(dim)]))
    return found


def fit(classes: DataFrame, sample: int = SAMPLE) -> dict[int, Quantiser]:
    """A quantiser for each dimension in at most ``sample`` vectors, taken by a hash of their ids."""
    rows = classes.count()
    taken = classes.orderBy(F.xxhash64("cid"), "cid").select("vec").limit(sample).toArrow()
    models = {}
    if taken.num_rows:
        cells = min(MAX_CELLS, max(1, rows // CELL_ROWS))
        for _, matrix in _vectors(taken.column("vec").combine_chunks()):
            models[matrix.shape[1]] = Quantiser(matrix.shape[1], _unit(matrix), cells)
    return models


_PLACED = "cid bigint, weight bigint, label int, dim int, cell int, home boolean, vec array<double>"


def _placer(models: dict[int, Quantiser], radius: float):
    """For each class: a row with its cell (home), and one for each later cell that it probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                column = part.column("vec")
                column = pa.ListArray.from_arrays(column.offsets, column.values)
                for rows, raw in _vectors(column):
                    model = models.get(raw.shape[1]) or Quantiser(raw.shape[1])
                    cell, probe = model.place(_unit(raw), radius)
                    probe &= np.arange(probe.shape[1]) > cell[:, None]
                    who, other = np.nonzero(probe)
                    who = np.r_[np.arange(len(rows)), who]
                    at = pa.array(rows[who])
                    data = pa.array(list(raw[who]), pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("cid").take(at),
                            part.column("weight").take(at),
                            part.column("label").take(at),
                            pa.array(np.full(len(who), raw.shape[1], np.int32)),
                            pa.array(np.r_[cell, other].astype(np.int32)),
                            pa.array(np.arange(len(who)) < len(rows)),
                            data,
                        ],
                        ["cid", "weight", "label", "dim", "cell", "home", "vec"],
                    )

    return run


class _Tile:
    """Members of a part of a list; answers queries and sums up links."""

    def __init__(self, model: Quantiser, cell: int, cid, weight, raw: np.ndarray):
        self.model, self.cell, self.cid, self.weight, self.raw = model, cell, cid, weight, raw
        self.norm = np.sqrt((raw * raw).sum(1))
        self.codes, self.err = model.encode(raw / self.norm[:, None], np.full(len(raw), cell))
        self.links = np.zeros(len(raw), np.int64)
        self.root = np.arange(len(raw))

    def _find(self, k: int) -> int:
        root = self.root
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    def search(self, cid, weight, home, raw, cosine: float, radius: float):
        """Links of each query (number, weighted), and edges that connect each with its links."""
        norm = np.sqrt((raw * raw).sum(1))
        near = self.model.table_distances(raw / norm[:, None], self.cell, self.codes)
        hits = near <= radius + self.err[None] + _SLACK
        hits &= ~home[:, None] | (self.cid[None] < cid[:, None])  # a pair of the list once
        q, m = np.nonzero(hits)
        keep = np.empty(len(q), bool)
        for s in range(0, len(q), 1 << 14):
            a, b = q[s : s + (1 << 14)], m[s : s + (1 << 14)]
            dots = np.einsum("ij,ij->i", raw[a], self.raw[b])
            keep[s : s + (1 << 14)] = dots / (norm[a] * self.norm[b]) >= cosine
        q, m = q[keep], m[keep]
        np.add.at(self.links, m, weight[q])
        links = np.zeros(len(raw), np.int64)
        np.add.at(links, q, self.weight[m])
        edges = []
        for k, members in zip(*_runs(q, m)):
            roots = {self._find(x) for x in members.tolist()}
            first = min(roots)
            for x in roots:
                edges.append((cid[k], self.cid[x]))
                self.root[x] = first
        return links, edges


def _runs(q: np.ndarray, m: np.ndarray) -> tuple[list, list]:
    starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if q.size else np.empty(0, int)
    return q[starts].tolist(), np.split(m, starts[1:]) if q.size else []


_FOUND = "src bigint, dst bigint, n bigint"


def _searcher(models: dict[int, Quantiser], cosine: float, radius: float):
    """For rows sorted by list, tile and members first: (src, null, n) counts n links, (src, dst) is an edge."""

    def found(src, dst, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(src, pa.int64()), pa.array(dst, pa.int64()), pa.array(n, pa.int64())], ["src", "dst", "n"]
        )

    def close(tile: _Tile | None) -> Iterator[pa.RecordBatch]:
        if tile is not None and (some := tile.links > 0).any():
            yield found(tile.cid[some], [None] * int(some.sum()), tile.links[some])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tile, members = None, None, []
        for batch in batches:
            columns = {n: batch.column(n).to_numpy() for n in ("cid", "weight", "label", "dim", "cell", "tile")}
            member = batch.column("member").to_numpy(zero_copy_only=False)
            home = batch.column("home").to_numpy(zero_copy_only=False)
            keys = np.stack([columns[n] for n in ("label", "dim", "cell", "tile")] + [~member], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1 if len(keys) else []
            vec = batch.column("vec")
            for s, e in zip([0, *cuts], [*cuts, len(keys)]):
                if s == e:
                    continue
                own = tuple(keys[s, :4].tolist())
                if own != key:
                    yield from close(tile)
                    key, tile, members = own, None, []
                part = vec.slice(s, e - s)
                raw = np.asarray(part.flatten()).reshape(e - s, own[1])
                cid, weight = columns["cid"][s:e], columns["weight"][s:e]
                if member[s]:
                    members.append((cid, weight, raw))
                    continue
                if tile is None and members:
                    model = models.get(own[1]) or Quantiser(own[1])
                    tile = _Tile(model, own[2], *(np.concatenate(x) for x in zip(*members)))
                    members = []
                if tile is None:
                    continue  # no vector lives here
                for k in range(0, len(cid), 64):
                    p = slice(k, k + 64)
                    links, edges = tile.search(cid[p], weight[p], home[s:e][p], raw[p], cosine, radius)
                    if (some := links > 0).any():
                        yield found(cid[p][some], [None] * int(some.sum()), links[some])
                    if edges:
                        src, dst = zip(*edges)
                        yield found(src, dst, [None] * len(edges))
        yield from close(tile)

    return run


def near_duplicate_vectors(
    vectors: DataFrame,
    cosine: float = 0.98,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    sample: int = SAMPLE,
    tile: int = TILE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row.

    n_links counts the other rows of the same label at ``cosine`` or above; component_id is the
    smallest id reachable over links; kept says that it is the row's own. Rows with a null label, or
    a vector that is null, empty, zero or holds null or non-finite components, have no links and
    their own id. Vectors of different lengths are not linked. Repeated rows are rows like any
    other and link with each other; all rows with the smallest id of a component are kept. A row with
    a null id takes part and is never kept. An empty table gives an empty table.
    """
    rows = materialise(
        vectors.select(
            F.col(id_column).cast("long").alias("vec_id"),
            F.col(label_column).cast("int").alias("label"),
            F.col(vector_column).cast("array<double>").alias("vec"),
        ).withColumn(
            "usable",
            F.expr(
                "coalesce(label is not null and size(vec) > 0 and forall(vec, v -> coalesce("
                "not isnan(v) and abs(v) < double('infinity'), false)) and exists(vec, v -> v <> 0), false)"
            ),
        ),
        "vectors",
    )
    usable = rows.where("usable")
    classes = materialise(
        usable.groupBy("label", "vec")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("weight"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    models = fit(classes, sample)
    placed = materialise(
        classes.select("cid", "weight", "label", "vec").mapInArrow(_placer(models, radius), _PLACED), "placed"
    )
    where = ["label", "dim", "cell"]
    tiles = placed.where("home").groupBy(*where).agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    members = placed.where("home").join(tiles, where).withColumn("tile", F.expr("pmod(xxhash64(cid), tiles)"))
    queries = placed.join(tiles, where).withColumn("tile", F.explode(F.expr("sequence(0L, tiles - 1L)")))
    columns = [*where, "tile", "member", "home", "cid", "weight", "vec"]
    work = (
        members.withColumn("member", F.lit(True))
        .select(*columns)
        .unionByName(queries.withColumn("member", F.lit(False)).select(*columns))
        .repartition(*where, "tile")
        .sortWithinPartitions(*where, "tile", F.desc("member"), "cid")
    )
    found = materialise(work.mapInArrow(_searcher(models, cosine, radius), _FOUND), "found")
    parts = connected_components(found.where("dst is not null").select("src", "dst"))
    links = found.where("dst is null").groupBy("src").agg(F.sum("n").alias("others"))
    member = (
        classes.join(parts, classes.cid == parts.node, "left")
        .join(links, classes.cid == links.src, "left")
        .select(
            "label",
            "vec",
            "first_id",
            F.coalesce("component", "cid").alias("component"),
            (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        )
    )
    member = materialise(member, "members")
    least = member.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = member.join(least, "component").select("label", "vec", "n_links", "component_id")
    linked = usable.join(named, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )


def op2_product_quantisation(spark, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


# Dot products of doubles are summed in another order than in Spark, so equality is up to rounding.
OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
usable AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL)) = 0
  AND len(list_filter(e, lambda x: isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
n AS (
  SELECT r, vec_id, label, list_filter(e, lambda x: x IS NOT NULL) AS e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM usable),
links AS (
  SELECT a.r AS src, b.r AS dst, b.vec_id AS id FROM n a JOIN n b ON a.label = b.label AND a.r <> b.r
  AND CASE WHEN len(a.e) = len(b.e) THEN list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.98 END),
reach AS (
  SELECT r AS src, r AS dst FROM v UNION SELECT reach.src, links.dst FROM reach JOIN links ON reach.dst = links.src),
comp AS (SELECT reach.src AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON reach.dst = v.r GROUP BY 1),
deg AS (SELECT src AS r, count(*) AS n FROM links GROUP BY 1)
SELECT v.vec_id, coalesce(deg.n, 0)::BIGINT AS n_links, comp.component_id,
  coalesce(v.vec_id = comp.component_id, false) AS kept
FROM v JOIN comp USING (r) LEFT JOIN deg USING (r)
"""
