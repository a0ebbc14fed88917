"""Near-duplicate vectors by an inverted file with product quantisation.

A coarse quantiser puts every vector into one list, its residual into one code per subspace.
A query probes each list that can hold a neighbour near enough: a vector on the other side of
the plane between two centroids is at least as far away as that plane. Of a neighbour's way only
the share in the direction across the plane counts, about 1 / sqrt(dimensions) of it; ``SPREAD``
times that is probed. ``spread=None`` probes by the whole way, which loses no neighbour and visits
nearly all lists. Inside a list, table lookups give the distance to every quantised vector; the
known error of each bounds the true distance from below, so that nothing is lost there, and what
remains is compared exactly.

The quantisers are fitted to a bounded sample (``SAMPLE_ROWS``); every vector is indexed.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelore.llm.components import connected_components, spanning_links
from pagelore.llm.storage import stage, temporaries

THRESHOLD = 0.93
SAMPLE_ROWS = 20_000
SUBSPACES = 8
CODES = 256
#: Probes reach so many standard deviations of a neighbour's way across a plane between lists.
SPREAD = 3.0
#: Vectors of a list and queries to it meet in blocks of about so many.
BLOCK_ROWS = 2048
_SLACK = 1e-6
_PAIRS = 1 << 16


@dataclass
class Quantiser:
    """Coarse centroids and, for each subspace, the codes of residuals."""

    centroids: np.ndarray  # lists x dimensions
    books: np.ndarray  # subspaces x codes x dimensions of a subspace

    @property
    def dimensions(self) -> int:
        return self.centroids.shape[1]

    @classmethod
    def fit(cls, unit: np.ndarray, lists: int, subspaces: int = SUBSPACES) -> "Quantiser":
        centroids = _means(unit, lists)
        residual = unit - centroids[_nearest(unit, centroids)]
        width = unit.shape[1] // subspaces
        parts = residual.reshape(len(unit), subspaces, width)
        codes = min(CODES, len(unit))
        return cls(centroids, np.stack([_means(parts[:, j], codes) for j in range(subspaces)]))

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, codes, squared norm of the quantised vector, and distance to it."""
        lists = _nearest(unit, self.centroids)
        residual = unit - self.centroids[lists]
        m, width = self.books.shape[0], self.books.shape[2]
        parts = residual.reshape(len(unit), m, width)
        codes = np.stack([_nearest(parts[:, j], self.books[j]) for j in range(m)], axis=1)
        rebuilt = self.centroids[lists] + self.rebuilt(codes)
        error = np.linalg.norm(unit - rebuilt, axis=1)
        return lists, codes.astype(np.uint8), (rebuilt**2).sum(1), error

    def rebuilt(self, codes: np.ndarray) -> np.ndarray:
        m = self.books.shape[0]
        return np.concatenate([self.books[j][codes[:, j]] for j in range(m)], axis=1)

    def probes(self, unit: np.ndarray, own: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Which lists (columns) have their plane to the own list within each row's reach."""
        d2 = _squares(unit, self.centroids)
        between = np.sqrt(np.maximum(_squares(self.centroids, self.centroids), 0.0))[own]
        ahead = d2 - d2[np.arange(len(unit)), own][:, None]
        return ahead <= 2 * between * (reach[:, None] + _SLACK) + _SLACK

    def distances(
        self, unit: np.ndarray, centroid: int, codes: np.ndarray, norms: np.ndarray
    ) -> np.ndarray:
        """Distance of each row to each quantised vector of one list, by table lookups."""
        m, width = self.books.shape[0], self.books.shape[2]
        parts = unit.reshape(len(unit), m, width)
        inner = np.repeat((unit @ self.centroids[centroid])[:, None], len(codes), axis=1)
        for j in range(m):
            table = parts[:, j] @ self.books[j].T
            inner += table[:, codes[:, j]]
        return np.sqrt(np.maximum((unit**2).sum(1)[:, None] - 2 * inner + norms[None, :], 0.0))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a**2).sum(1)[:, None] - 2 * (a @ b.T) + (b**2).sum(1)[None, :]


def _nearest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = [_squares(a[i : i + 4096], b).argmin(1) for i in range(0, len(a), 4096)]
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def _means(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means from evenly spread first centres; an empty cluster keeps its centre."""
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        of = _nearest(points, centres)
        n = np.bincount(of, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, points)
        centres[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return centres


def probe_reach(reach: float, sizes: np.ndarray, spread: float | None = SPREAD) -> np.ndarray:
    """How far across a plane between lists the neighbours within ``reach`` of vectors of these
    sizes are looked for."""
    share = np.ones(len(sizes)) if spread is None else np.minimum(1.0, spread / np.sqrt(sizes))
    return reach * share


def _readable(rows: DataFrame) -> DataFrame:
    """(row, vec_id, label, size, vec): vec is 64-bit binary, null where a vector can link with
    nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes, vectors = _usable(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + batch.num_rows)), batch.column(0), batch.column(1),
                    sizes, vectors,
                ],
                ["row", "vec_id", "label", "size", "vec"],
            )
            row += batch.num_rows

    wanted = rows.select(
        F.col("vec_id").cast("long"), F.col("label").cast("string"),
        F.col("embedding").cast("array<double>"),
    )
    return wanted.mapInArrow(run, "row long, vec_id long, label string, size int, vec binary")


def _usable(lists: pa.ListArray) -> tuple[pa.Array, pa.Array]:
    """Sizes and 64-bit bytes of vectors that are finite and not zero; 0 and null for others."""
    edges = lists.offsets.to_numpy()
    values = pc.fill_null(lists.values, math.nan).to_numpy(zero_copy_only=False).astype("<f8")
    filled = lists.is_valid().to_numpy(zero_copy_only=False) & (edges[1:] > edges[:-1])
    squares = np.zeros(len(lists))
    if filled.any():
        bounds = np.stack([edges[:-1][filled], edges[1:][filled]], axis=1).ravel()
        with np.errstate(over="ignore", invalid="ignore"):
            # Every other sum is one between the vectors; the last bound may be the end.
            squares[filled] = np.add.reduceat(np.append(values**2, 0.0), bounds)[::2]
    usable = np.isfinite(squares) & (squares > 0)
    raw = [
        values[a:b].tobytes() if ok else None
        for a, b, ok in zip(edges[:-1].tolist(), edges[1:].tolist(), usable.tolist())
    ]
    sizes = np.where(usable, edges[1:] - edges[:-1], 0)
    return pa.array(sizes, pa.int32()), pa.array(raw, pa.binary())


def _matrix(column: pa.Array, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows, filled up with zeros to one width, and their norms."""
    out = np.zeros((len(column), width))
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    if len(column):
        out[np.arange(width) < np.asarray(sizes)[:, None]] = np.frombuffer(data[edges[0] : edges[-1]], "<f8")
    return out, np.linalg.norm(out, axis=1)


def _units(vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return vectors / norms[:, None]


def fit(classes: DataFrame, n: int, sample_rows: int = SAMPLE_ROWS) -> Quantiser | None:
    """Quantisers for vectors of all sizes, from about ``sample_rows`` of them."""
    if not n:
        return None
    width = classes.agg(F.max("size")).first()[0]
    width = -(-width // SUBSPACES) * SUBSPACES
    share = min(1.0, sample_rows / n)
    chosen = F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = classes.where(chosen).select("size", "vec").toArrow()
    if not sample.num_rows:
        sample = classes.select("size", "vec").limit(1).toArrow()
    vectors, norms = _matrix(
        sample.column("vec").combine_chunks(), sample.column("size").to_pylist(), width
    )
    order = np.lexsort(vectors.T)  # the order of rows in a table is no given
    lists = max(1, min(4096, len(vectors), round(math.sqrt(n) / 4)))
    return Quantiser.fit(_units(vectors, norms)[order], lists)


def index(
    classes: DataFrame, quantiser: Quantiser, reach: float, spread: float | None = SPREAD
) -> DataFrame:
    """Every class of equal vectors with its list, codes and the lists that it probes.

    Of two lists that may hold neighbours of each other, the smaller one's vectors probe."""
    names = ["class", "label", "size", "n", "vec", "list", "codes", "norm", "error", "probes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sizes = batch.column(2).to_numpy()
                vectors, norms = _matrix(batch.column(4), sizes, quantiser.dimensions)
                unit = _units(vectors, norms)
                lists, codes, square, error = quantiser.encode(unit)
                near = quantiser.probes(unit, lists, probe_reach(reach, sizes, spread))
                probes = [np.flatnonzero(p[k:]) + k for p, k in zip(near, lists.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i) for i in range(5)), pa.array(lists, pa.int32()),
                        pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(square),
                        pa.array(error), pa.array(probes, pa.list_(pa.int32())),
                    ],
                    names,
                )

    return classes.select(*names[:5]).mapInArrow(
        run,
        "class long, label string, size int, n long, vec binary, list int, codes binary,"
        " norm double, error double, probes array<int>",
    )


def links(indexed: DataFrame, quantiser: Quantiser, threshold: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b, n): with b null, class a links with n vectors of other classes in one block; else
    a and b belong together. Blocks name enough pairs to connect what links, not all of them."""
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    key = ["label", "size", "list"]
    held = indexed.groupBy(*key).agg(F.ceil(F.count("*") / block_rows).alias("v_blocks"))
    asked = indexed.select("label", "size", F.explode("probes").alias("list"))
    asked = asked.groupBy(*key).agg(F.ceil(F.count("*") / block_rows).alias("q_blocks"))
    blocks = stage(held.join(asked, key), "vector-blocks")
    salt = F.xxhash64("class")
    vectors = indexed.join(blocks, key).select(
        *key, F.pmod(salt, F.col("v_blocks")).alias("v"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("q_blocks") - 1)).alias("q"),
        "class", "n", "vec", "codes", "norm", "error",
    )
    queries = indexed.select(
        "label", "size", F.col("list").alias("own"), "class", "n", "vec", F.explode("probes").alias("list")
    )
    queries = queries.join(blocks, key).select(
        *key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("v_blocks") - 1)).alias("v"),
        F.pmod(salt, F.col("q_blocks")).alias("q"), "own", "class", "n", "vec",
    ).select(*(F.col(c).alias(f"q_{c}") for c in (*key, "v", "q", "own", "class", "n", "vec")))

    def search(asking: pa.Table, holding: pa.Table) -> pa.Table:
        if not asking.num_rows or not holding.num_rows:
            return _found([], [], [], [], [])
        asking, holding = asking.combine_chunks(), holding.combine_chunks()
        width, size = quantiser.dimensions, holding["size"][0].as_py()
        u, u_norm = _matrix(asking["q_vec"].chunk(0), [size] * asking.num_rows, width)
        v, v_norm = _matrix(holding["vec"].chunk(0), [size] * holding.num_rows, width)
        raw = b"".join(holding["codes"].to_pylist())
        codes = np.frombuffer(raw, dtype=np.uint8).reshape(holding.num_rows, -1)
        here = holding["list"][0].as_py()
        u_class, v_class = asking["q_class"].to_numpy(), holding["class"].to_numpy()
        u_n, v_n = asking["q_n"].to_numpy(), holding["n"].to_numpy()
        inside = asking["q_own"].to_numpy() == here
        error, norm = holding["error"].to_numpy(), holding["norm"].to_numpy()
        u_links, v_links = np.zeros(len(u), dtype=np.int64), np.zeros(len(v), dtype=np.int64)
        low = high = np.zeros(0, dtype=np.int64)
        step = max(1, _PAIRS * 8 // len(v))
        unit = _units(u, u_norm)
        for at in range(0, len(u), step):
            bound = quantiser.distances(unit[at : at + step], here, codes, norm) - error[None, :]
            i, j = np.nonzero(bound <= reach + _SLACK)
            i += at
            once = ~inside[i] | (u_class[i] < v_class[j])
            i, j = i[once], j[once]
            for k in range(0, len(i), _PAIRS):
                x, y = i[k : k + _PAIRS], j[k : k + _PAIRS]
                cosine = np.einsum("ij,ij->i", u[x], v[y]) / (u_norm[x] * v_norm[y])
                x, y = x[cosine >= threshold], y[cosine >= threshold]
                np.add.at(u_links, x, v_n[y])
                np.add.at(v_links, y, u_n[x])
                low, high = spanning_links(
                    np.concatenate([low, u_class[x]]), np.concatenate([high, v_class[y]])
                )
        return _found(u_class[u_links > 0], u_links[u_links > 0], v_class[v_links > 0],
                      v_links[v_links > 0], (low, high))

    met = [*key, "v", "q"]
    both = queries.groupBy(*(f"q_{c}" for c in met)).cogroup(vectors.groupBy(*met))
    return both.applyInArrow(search, "a long, b long, n long")


def _found(u, u_links, v, v_links, pairs) -> pa.Table:
    low, high = pairs if len(pairs) else ([], [])
    a = np.concatenate([u, v, low]).astype(np.int64)
    counted = len(u) + len(v)
    b = pa.concat_arrays([pa.nulls(counted, pa.int64()), pa.array(high, pa.int64())])
    n = np.concatenate([u_links, v_links, np.zeros(len(low))]).astype(np.int64)
    return pa.table({"a": pa.array(a), "b": b, "n": pa.array(n)})


def near_duplicate_vectors(
    rows: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS,
    block_rows: int = BLOCK_ROWS, spread: float | None = SPREAD,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row a vector.

    Two vectors of one label and length link if their cosine in double precision is at least
    ``threshold``. Null labels, null or empty vectors, those with null or non-finite components
    and zero vectors link with nothing. Equal vectors of a label are one class: they are
    searched once and count one by one. component_id is the smallest vec_id that links reach
    (null ids do not count), ``kept`` whether it is the vector's own. Other columns than vec_id,
    embedding and label are ignored. ``spread`` says how far lists are probed; None finds all.
    """
    with temporaries(rows.sparkSession):
        joined = stage(
            _with_components(rows, threshold, sample_rows, block_rows, spread), "vector-rows", keep=True
        )
    heads = joined.groupBy(F.col("component").alias("of")).agg(F.min("vec_id").alias("component_id"))
    heads = stage(heads, "vector-heads", keep=True)
    return joined.join(heads, F.col("component") == F.col("of")).select(
        "vec_id", "n_links", "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _with_components(
    rows: DataFrame, threshold: float, sample_rows: int, block_rows: int, spread: float | None
) -> DataFrame:
    """(vec_id, n_links, component); components are named by a class, or by the row where a
    vector links with nothing."""
    alone = F.lit(-1) - F.col("row")
    found = stage(_readable(rows), "vectors")
    usable = found.where("label is not null and vec is not null")
    classes = stage(
        usable.groupBy("label", "size", "vec").agg(F.min("row").alias("class"), F.count("*").alias("n")),
        "vector-classes",
    )
    quantiser = fit(classes, classes.count(), sample_rows)
    if quantiser is None:
        return found.select("vec_id", F.lit(0).cast("long").alias("n_links"), alone.alias("component"))
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    indexed = stage(index(classes, quantiser, reach, spread), "vector-index")
    met = stage(links(indexed, quantiser, threshold, block_rows), "vector-links")
    counts = met.where("b is null").groupBy(F.col("a").alias("c")).agg(F.sum("n").alias("links"))
    parts = connected_components(met.where("b is not null").select("a", "b"))
    named = classes.join(counts, F.col("class") == F.col("c"), "left").join(
        parts, F.col("class") == F.col("node"), "left"
    )
    named = stage(
        named.select(
            F.col("label").alias("l"), F.col("vec").alias("v"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
            F.coalesce("component", "class").alias("component"),
        ),
        "vector-components",
    )
    joined = found.join(named, (F.col("vec") == F.col("v")) & (F.col("label") == F.col("l")), "left")
    return joined.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", alone).alias("component"),
    )
