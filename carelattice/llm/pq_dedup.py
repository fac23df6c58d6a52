"""Near-duplicate embeddings by product quantisation.

Coarse centroids split unit vectors into inverted lists; a residual's subspaces are
coded with small codebooks. Each vector is a query: it visits every list that can
hold a vector near enough, reads distances to coded vectors from a table per
subspace, and the survivors are compared by exact cosine in double precision.

Two bounds keep the search whole whatever the codebooks are like. A list is skipped
only if the query lies further than the search radius beyond the plane between the
list's centroid and another. A coded vector is skipped only if its table distance
exceeds the radius by more than its own coding error, which is stored.

Equal vectors are merged before the search. Both bounds hold for a pair from either
side, so a query only visits its own list and later ones, and a link found in a later
list counts for both. Lists are cut into blocks of rows, so a task holds one block and
streams its queries. Per vector and block one count goes out, and of the links only a
spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.llm.common import by_record, written
from carelattice.llm.components import connected_components, join_spread

# The index is fitted on about this many distinct vectors, chosen by hash; all are indexed.
SAMPLE = 20_000
LISTS = 16
SUBSPACES = 8
CODES = 64
# Vectors of a list held by a task, and queries compared with them at once.
BLOCK = 4_096
_QUERIES = 128
# Vectors whose joined parts a task remembers.
_JOINED = 500_000
# Slack on all bounds for rounding.
_SLACK = 1e-6


def kmeans(points: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """At most ``k`` centroids of ``points``; empty ones are dropped."""
    points = np.unique(points, axis=0)
    if len(points) <= k:
        return points
    centres = points[np.random.default_rng(seed).choice(len(points), k, replace=False)]
    for _ in range(rounds):
        nearest = np.argmin(distances(points, centres), axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        sizes = np.bincount(nearest, minlength=len(centres))
        centres = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


@dataclass(frozen=True)
class Index:
    """Coarse centroids and one codebook per subspace."""

    centres: np.ndarray
    books: tuple[np.ndarray, ...]

    def split(self, residuals: np.ndarray) -> list[np.ndarray]:
        return np.array_split(residuals, len(self.books), axis=1)

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and coding error of unit vectors."""
        lists = np.argmin(distances(units, self.centres), axis=1)
        rest = units - self.centres[lists]
        codes = np.stack([np.argmin(distances(part, book), axis=1)
                          for part, book in zip(self.split(rest), self.books)], axis=1)
        coded = np.concatenate([book[codes[:, m]] for m, book in enumerate(self.books)], axis=1)
        return lists, codes.astype(np.uint8), np.sqrt(((rest - coded) ** 2).sum(1))

    def probes(self, units: np.ndarray, radius: float) -> np.ndarray:
        """Which lists may hold a vector within ``radius`` of each unit vector."""
        to = distances(units, self.centres)
        apart = np.sqrt(distances(self.centres, self.centres))
        may = np.ones(to.shape, bool)
        for rank in np.argsort(to, axis=1)[:, :8].T:
            own = to[np.arange(len(to)), rank][:, None]
            may &= to - own <= 2 * radius * apart[rank] + _SLACK
        return may

    def table_distances(self, units: np.ndarray, one: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of queries to coded vectors of list ``one``, by table lookup."""
        total = np.zeros((len(units), len(codes)))
        for m, (part, book) in enumerate(zip(self.split(units - self.centres[one]), self.books)):
            total += distances(part, book)[:, codes[:, m]]
        return total


def fit_index(units: np.ndarray, lists: int = LISTS, subspaces: int = SUBSPACES, codes: int = CODES) -> Index:
    centres = kmeans(units, lists)
    rest = units - centres[np.argmin(distances(units, centres), axis=1)]
    return Index(centres, tuple(kmeans(part, min(codes, 256)) for part in
                                np.array_split(rest, min(subspaces, units.shape[1]), axis=1)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of a list column as doubles, shorter ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _unit(raw: np.ndarray) -> np.ndarray:
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _forest(pairs: np.ndarray, parent: dict[int, int]) -> list[tuple[int, int]]:
    """The pairs that join parts not yet joined in ``parent``, which is updated."""

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for a, b in pairs.tolist():
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _search(index: Index, width: int, cosine: float):
    """The task side of the search: blocks and queries in order of list and block."""
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, parent = None, {}
        held: list[tuple[np.ndarray, ...]] = []
        block: tuple[np.ndarray, ...] | None = None

        def compare(ids: np.ndarray, raw: np.ndarray, times: np.ndarray, away: np.ndarray, one: int) -> pa.RecordBatch:
            own, copies, theirs, codes, errors = block
            units = _unit(raw)
            near = np.sqrt(index.table_distances(units, one, codes)) <= radius + errors[None, :] + _SLACK
            q, x = np.nonzero(near & (ids[:, None] != own[None, :]))
            a, b = raw[q], theirs[x]
            cosines = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
            linked = cosines >= cosine
            q, x = q[linked], x[linked]
            both = away[q]
            counts = np.bincount(q, copies[x], len(ids)).astype(np.int64)
            back = np.bincount(x[both], times[q[both]], len(own)).astype(np.int64)
            named, counts = np.concatenate([ids, own]), np.concatenate([counts, back])
            some = np.flatnonzero(counts)
            if len(parent) > _JOINED:  # costs only some repeated links
                parent.clear()
            edges = np.array(_forest(np.stack([ids[q], own[x]], axis=1), parent), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([named[some], edges[:, 0]])),
                pa.array(np.concatenate([named[some], edges[:, 1]])),
                pa.array(np.concatenate([counts[some], np.zeros(len(edges), np.int64)]))], names=["a", "b", "links"])

        for batch in by_record(batches, 4 * _QUERIES):
            cells = [list(c) for c in zip(*[batch.column(i).to_pylist() for i in range(4)])]
            cuts = [0, *[i for i in range(1, len(cells)) if cells[i] != cells[i - 1]], len(cells)]
            for at, stop in zip(cuts, cuts[1:]):
                part, (*where, kind) = batch.slice(at, stop - at), cells[at]
                if where != cell:
                    cell, parent, held, block = where, {}, [], None
                ids, raw = part.column("cid").to_numpy(), _matrix(part.column("embedding"), width)
                if kind == 0:
                    codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), np.uint8)
                    held.append((ids, part.column("copies").to_numpy(), raw, codes.reshape(len(ids), -1),
                                 part.column("error").to_numpy()))
                    continue
                if block is None and held:
                    block = tuple(np.concatenate(x) for x in zip(*held))
                if block is not None:
                    times, away = part.column("copies").to_numpy(), part.column("own").to_numpy() != where[1]
                    for i in range(0, len(ids), _QUERIES):
                        some = slice(i, i + _QUERIES)
                        yield compare(ids[some], raw[some], times[some], away[some], where[1])

    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.93, sample: int = SAMPLE, lists: int = LISTS,
                    block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Rows are compared when their labels are equal and not NULL and their vectors
    have the same length. A NULL, empty or zero vector, or one with a NULL, NaN or
    infinite component, links with nothing and is its own component. ``n_links``
    counts the other rows with cosine at least ``cosine``, copies and repeated rows
    included; ``component_id`` is the smallest id reachable; ``kept`` is
    ``vec_id = component_id``. NULL ids do not become component ids unless alone.
    Other columns are ignored; an empty table gives no row.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"),
                          F.col(label_col).alias("label"))
    kind = rows.schema["embedding"].dataType.simpleString()
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(
        F.col("label").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0),
        F.lit(False))
    distinct = written(
        rows.where(usable).groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .withColumn("cid", F.monotonically_increasing_id()), "distinct-vectors")
    number, width = distinct.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    alone = [F.col("vec_id"), F.lit(0).cast("bigint").alias("n_links"),
             F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")]
    if not number:
        return rows.select(*alone)

    chosen = distinct.select("embedding")
    if number > sample:
        chosen = chosen.where(F.pmod(F.xxhash64("embedding"), F.lit(1 << 31)) < int(sample / number * (1 << 31)))
    fitted = sorted(tuple(r[0]) + (0.0,) * (width - len(r[0])) for r in chosen.collect())
    index = fit_index(_unit(np.array(fitted or [[1.0] * width], np.float64).reshape(-1, width)), lists)
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_record(batches):
            units = _unit(_matrix(batch.column("embedding"), width))
            found, codes, errors = index.encode(units)
            probes = index.probes(units, radius) & (np.arange(len(index.centres)) >= found[:, None])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array(errors), pa.array([np.flatnonzero(p).astype(np.int32) for p in probes], pa.list_(pa.int32()))],
                names=[*batch.schema.names, "list", "codes", "error", "probes"])

    label_kind = rows.schema["label"].dataType.simpleString()
    coded = written(
        distinct.select("cid", "copies", "label", "embedding", F.size("embedding").alias("dims")).mapInArrow(
            place, f"cid bigint, copies bigint, label {label_kind}, embedding {kind}, dims int, list int, "
                   "codes binary, error double, probes array<int>"), "coded-vectors")
    cell = ["label", "dims", "list"]
    sizes = coded.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    stored = coded.drop("probes").withColumn("own", F.col("list")).join(sizes, cell).withColumn(
        "block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    asked = coded.withColumn("own", F.col("list")).withColumn("list", F.explode("probes")).join(sizes, cell).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    names = ["home", "list", "block", "kind", "cid", "copies", "own", "embedding", "codes", "error"]
    home = F.concat_ws(":", F.col("dims").cast("string"), F.col("label").cast("string")).alias("home")
    both = stored.select(home, F.lit(0).alias("kind"), *[c for c in names if c not in ("home", "kind")]).select(*names).unionByName(
        asked.select(home, F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("codes"),
                     *[c for c in names if c not in ("home", "kind", "codes")]).select(*names))
    found = written(
        both.repartition("home", "list", "block").sortWithinPartitions("home", "list", "block", "kind")
        .mapInArrow(_search(index, width, cosine), "a bigint, b bigint, links bigint"), "vector-links")

    counts = found.groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("others"))
    roots = connected_components(found.where("a <> b").select("a", "b"))
    linked = roots.join(distinct, roots.node == distinct.cid).select("cid", "root", "least")
    smallest = linked.groupBy("root").agg(F.min("least").alias("smallest"))
    smallest = join_spread(linked, smallest, "root", "cid").select("cid", "smallest")
    labels = (
        distinct.join(counts, "cid", "left").join(smallest, "cid", "left")
        .select("label", "embedding",
                (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                F.coalesce("smallest", "least").alias("component_id"))
    )
    matched = rows.where(usable).join(labels, ["label", "embedding"]).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
    return matched.unionByName(rows.where(~usable).select(*alone))
