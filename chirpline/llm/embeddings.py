"""Near-duplicate embeddings by product quantisation.

Unit vectors go to the inverted list of their nearest coarse centroid, and
their residual is coded subspace by subspace. A search looks its distances up
in a table for each probed list (asymmetric distances), keeps what could lie
within the limit given each code's own error, and computes the exact cosine of
what is left. Centroids and codebooks are fitted on a bounded sample; every
vector is indexed and searched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpline.llm.common import staged
from chirpline.llm.components import Forest, components

# The sample that centroids and codebooks are fitted on: vectors, and numbers in all.
SAMPLE_ROWS = 1 << 14
SAMPLE_VALUES = 1 << 22
MOST_LISTS = 1 << 10
SUBSPACES = 8
CODES = 64
ROUNDS = 8

# Sample vectors that probing is calibrated on and how many at a time, the neighbours towards which pairs
# are made of each, and how many pairs of the sample itself are taken at a time.
PROBED_ROWS = 1 << 11
PROBED_AT_ONCE = 1 << 7
NEIGHBOURS = 8
PAIRS_AT_ONCE = 1 << 12

# Vectors of a block, about, and blocks handed to Python at a time.
BLOCK = 1 << 10
BLOCK_ROWS = 16


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)


def k_means(x: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's algorithm from the first ``k`` rows; a centre that loses all rows stays where it is."""
    centres = x[:k].copy()
    for _ in range(ROUNDS):
        own = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        sizes = np.bincount(own, minlength=len(centres))
        some = sizes > 0
        centres[some] = sums[some] / sizes[some, None]
    return centres


def limit_pairs(sample: np.ndarray, limit: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors as far apart as a link may be, and the pairs of the sample that are links.

    From each of some vectors a step of length ``limit`` is taken towards each
    of its nearest neighbours, so the pairs lie in the directions that vectors
    there fill, be they all or few.
    """
    made: list[tuple[np.ndarray, np.ndarray]] = []
    linked: list[tuple[np.ndarray, np.ndarray]] = []
    for start in range(0, min(PROBED_ROWS, len(sample)), PROBED_AT_ONCE):
        x = sample[start : min(start + PROBED_AT_ONCE, PROBED_ROWS)]
        square = np.maximum(2 - 2 * x @ sample.T, 0)
        square[square < 1e-9] = np.inf  # the vector itself, and others of its direction
        n = min(NEIGHBOURS, len(sample))
        columns = np.argpartition(square, n - 1, axis=1)[:, :n].ravel()
        rows = np.repeat(np.arange(len(x)), n)
        some = np.isfinite(square[rows, columns])
        made.append((start + rows[some], columns[some]))
        rows, columns = np.nonzero(square <= limit**2)
        linked.append((start + rows[:PAIRS_AT_ONCE], columns[:PAIRS_AT_ONCE]))
    a, b = (sample[np.concatenate(x)] for x in zip(*made, strict=True))
    across = b - (a * b).sum(axis=1, keepdims=True) * a
    size = np.linalg.norm(across, axis=1)
    a, across = a[size > 1e-9], across[size > 1e-9] / size[size > 1e-9, None]
    angle = 2 * math.asin(min(1.0, limit / 2))
    found = [np.concatenate(x) for x in zip(*linked, strict=True)]
    return [(a, math.cos(angle) * a + math.sin(angle) * across), (sample[found[0]], sample[found[1]])]


@dataclass
class Index:
    """Coarse centroids, a codebook for each slice of the dimensions, and how far a search probes.

    A pair within ``limit`` (a distance of unit vectors) may lie on two sides
    of the border between two cells. A list is probed if its border is no
    farther than ``margin``, which is measured: so that the share ``recall`` of
    the pairs of ``limit_pairs`` are found from one side or the other, and of
    each kind of them. A margin of ``limit`` covers every pair.
    """

    centres: np.ndarray
    slices: list[tuple[int, int]]
    books: list[np.ndarray]
    limit: float
    margin: float

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int, limit: float, recall: float) -> Index:
        centres = k_means(sample, min(lists, len(sample)))
        rest = sample - centres[nearest(sample, centres)]
        edges = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int).tolist()
        slices = list(zip(edges[:-1], edges[1:], strict=True))
        books = [k_means(np.ascontiguousarray(rest[:, a:b]), min(CODES, len(rest))) for a, b in slices]
        index = cls(centres, slices, books, limit, limit if recall >= 1 else 0.0)
        if 0 < recall < 1:
            needed = [index.needed(a, b) for a, b in limit_pairs(sample, limit) if len(a)]
            index.margin = max([0.0, *(float(np.quantile(x, recall, method="higher")) for x in needed)])
        return index

    def needed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The margin with which one of two vectors would probe the other's list, for each pair."""
        cells = nearest(a, self.centres), nearest(b, self.centres)
        apart = np.linalg.norm(self.centres[cells[0]] - self.centres[cells[1]], axis=1)
        out = []
        for x, own, other in ((a, *cells), (b, *cells[::-1])):
            beyond = ((x - self.centres[other]) ** 2).sum(axis=1) - ((x - self.centres[own]) ** 2).sum(axis=1)
            out.append(np.where(apart > 0, beyond / np.maximum(2 * apart, 1e-12), 0))
        return np.minimum(*out)

    def distances(self, x: np.ndarray, lists: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Squared distances of rows to the centres of some lists."""
        centres = self.centres[lists]
        return (x**2).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres**2).sum(axis=1)[None, :]

    def probes(self, x: np.ndarray, own: np.ndarray, lists: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Whether rows, of lists ``own``, probe each of ``lists``."""
        centres = self.centres[lists]
        apart = np.sqrt(np.maximum(self.distances(self.centres[own], lists), 0))
        mine = ((x - self.centres[own]) ** 2).sum(axis=1)
        return (self.distances(x, lists) - mine[:, None] <= 2 * apart * self.margin + 1e-9).reshape(len(x), len(centres))

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and each code's distance to its vector."""
        rest = x - self.centres[own]
        codes = np.empty((len(x), len(self.slices)), dtype=np.uint8)
        square = np.zeros(len(x))
        for i, (a, b) in enumerate(self.slices):
            codes[:, i] = nearest(rest[:, a:b], self.books[i])
            square += ((rest[:, a:b] - self.books[i][codes[:, i]]) ** 2).sum(axis=1)
        return codes, np.sqrt(square)

    def near(self, x: np.ndarray, cell: int, codes: np.ndarray, errors: np.ndarray) -> np.ndarray:
        """Which members of list ``cell`` (columns) may lie within the limit of each row: none that does is left out."""
        rest = x - self.centres[cell]
        square = np.zeros((len(x), len(codes)))
        for i, (a, b) in enumerate(self.slices):
            part, book = rest[:, a:b], self.books[i]
            table = (part**2).sum(axis=1)[:, None] - 2 * part @ book.T + (book**2).sum(axis=1)[None, :]
            square += table[:, codes[:, i]]
        return np.sqrt(np.maximum(square, 0)) <= self.limit + errors[None, :] + 1e-6


def block_links(
    index: Index, cell: int, least: float, q: dict[str, np.ndarray], m: dict[str, np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links between a block of queries and one of a list's members.

    Returns ids and their numbers of linked vectors, and a spanning forest. A
    link counts for its query, and for the member too if the member's own
    search would not come to the query's list; so a link found either way
    counts once for both.
    """
    may = index.near(q["unit"], cell, m["codes"], m["errors"])
    rows, columns = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
    linked = np.zeros(may.shape, dtype=bool)
    if len(rows):
        dots = q["vector"][rows] @ m["vector"][columns].T
        cosine = dots / (q["norm"][rows, None] * m["norm"][None, columns])
        linked[np.ix_(rows, columns)] = cosine >= least
    linked &= may & (q["id"][:, None] != m["id"][None, :])
    found = linked @ m["n"]
    lists, place = np.unique(q["cell"], return_inverse=True)
    back = index.probes(m["unit"], np.full(len(m["id"]), cell), lists)
    unseen = (linked & ~back[:, place].T).T @ q["n"]
    forest = Forest(len(rows) + len(columns))
    inside = linked[np.ix_(rows, columns)]
    for i in np.flatnonzero(inside.any(axis=1)):
        forest.link(i, len(rows) + np.flatnonzero(inside[i]))
    nodes, heads = forest.edges()
    ids = np.concatenate([q["id"][rows], m["id"][columns]])
    counted = np.concatenate([q["id"], m["id"]]), np.concatenate([found, unseen])
    some = counted[1] > 0
    return counted[0][some], counted[1][some], ids[nodes], ids[heads]


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    # Scaled first, so that squares of very large or small components stay in range.
    norm = np.sqrt((vectors**2).sum(axis=1))
    return vectors / norm[:, None], norm


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """Rows of lists of ``dim`` numbers, in double precision and scaled by their largest component."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x


def _fields(packed: pa.ListScalar, dim: int) -> dict[str, np.ndarray]:
    """The columns of a block, which Spark hands over as a list of structs."""
    structs = packed.values
    out = {}
    for name in ("id", "n", "cell", "errors"):
        if structs.type.get_field_index(name) >= 0:
            out[name] = structs.field(name).to_numpy(zero_copy_only=False)
    if structs.type.get_field_index("codes") >= 0:
        out["codes"] = np.frombuffer(b"".join(structs.field("codes").to_pylist()), np.uint8).reshape(len(structs), -1)
    out["vector"] = _matrix(structs.field("embedding"), dim)
    out["unit"], out["norm"] = _unit(out["vector"])
    return out


def _links_of(classes: DataFrame, dim: int, least: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """Numbers of links ``id, links`` and connecting links ``a, b`` of the classes of one dimension."""
    count = classes.count()
    size = min(SAMPLE_ROWS, max(1, SAMPLE_VALUES // dim))
    taken = classes.select("id", "embedding").orderBy(F.xxhash64("id"), "id").limit(size).select("embedding").collect()
    vectors = np.array([row[0] for row in taken], dtype=np.float64)
    sample, _ = _unit(vectors / np.abs(vectors).max(axis=1, keepdims=True))
    lists = max(1, min(MOST_LISTS, math.isqrt(count) // 2, len(sample) // 8))
    index = Index.fit(sample, lists, math.sqrt(max(0.0, 2 - 2 * least)), recall)
    # At most MOST_LISTS centres and SAMPLE_VALUES numbers, whatever the input.
    shared = classes.sparkSession.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                unit, _ = _unit(_matrix(part.column("embedding"), dim))
                own = nearest(unit, index.centres)
                codes, errors = index.encode(unit, own)
                probes = [pa.array(np.flatnonzero(x), pa.int32()) for x in index.probes(unit, own)]
                ends = np.cumsum([0, *map(len, probes)])
                added = [
                    pa.array(own, pa.int32()),
                    pa.array([x.tobytes() for x in codes], pa.binary()),
                    pa.array(errors),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(probes)),
                ]
                names = [*part.schema.names, "cell", "codes", "errors", "probes"]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names)

    schema = classes.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")
    indexed = staged(
        classes.mapInArrow(assign, f"{schema}, cell int, codes binary, errors double, probes array<int>"), "index"
    )
    searching = indexed.select("label", F.explode("probes").alias("list"), "id", "n", "embedding", "cell")
    blocks = F.ceil(F.count("*") / BLOCK).cast("int")
    of_id = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")

    def packed(rows: DataFrame, fields: list[str], name: str) -> DataFrame:
        counted = staged(rows.groupBy("label", "list").agg(blocks.alias("blocks")), "lists")
        return (
            rows.join(counted, ["label", "list"])
            .groupBy("label", "list", of_id)
            .agg(F.collect_list(F.struct(*fields)).alias(name))
            .drop("block")
        )

    members = packed(indexed.withColumnRenamed("cell", "list"), ["id", "n", "embedding", "codes", "errors"], "members")
    queries = packed(searching, ["id", "n", "embedding", "cell"], "queries")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            cells = batch.column("list").to_pylist()
            for cell, q, m in zip(cells, batch.column("queries"), batch.column("members"), strict=True):
                ids, found, a, b = block_links(index, cell, least, _fields(q, dim), _fields(m, dim))
                nothing = [pa.nulls(len(ids), pa.int64()), pa.nulls(len(a), pa.int64())]
                columns = [(ids, nothing[1]), (found, nothing[1]), (nothing[0], a), (nothing[0], b)]
                joined = [pa.concat_arrays([pa.array(x, pa.int64()) for x in both]) for both in columns]
                yield pa.RecordBatch.from_arrays(joined, ["id", "links", "a", "b"])

    met = queries.join(members, ["label", "list"]).select("list", "queries", "members")
    found = staged(met.mapInArrow(search, "id long, links long, a long, b long"), "found", BLOCK_ROWS)
    return found.filter("id IS NOT NULL").select("id", "links"), found.filter("a IS NOT NULL").select("a", "b")


def embedding_groups(vectors: DataFrame, least: float = 0.93, recall: float = 0.995) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors of equal labels and lengths whose cosine is at least ``least`` are
    linked. A vector that is null, empty or zero, or holds null, NaN or an
    infinity, links with nothing; so does one whose label or ``vec_id`` is
    null. Equal vectors meet in a class before the search and count as links
    of each other; rows that share a ``vec_id`` are one node of the components
    and each have their row. Other columns are not looked at. An empty table
    gives no rows. Lengths are worked through one by one; there should be few.

    ``recall`` is the share of links at the limit itself, those hardest to
    find, that probing is calibrated to; 1 probes so far that none is missed.
    """
    rows = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding"
    )
    # One scan of the array: nothing missing, and the sum of squares positive.
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    zero = F.forall("embedding", lambda x: x == 0)
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    rows = rows.withColumn("valid", F.coalesce(sound & ~odd & ~zero, F.lit(False)))
    classes = staged(
        rows.filter("valid")
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))
        .withColumn("dim", F.size("embedding")),
        "classes",
    )
    counted, edges = None, None
    for (dim,) in classes.select("dim").distinct().orderBy("dim").collect():
        links, joins = _links_of(classes.filter(F.col("dim") == dim).drop("dim"), dim, least, recall)
        counted = links if counted is None else counted.unionByName(links)
        edges = joins if edges is None else edges.unionByName(joins)
    if counted is None:
        return rows.select(
            "vec_id",
            F.lit(0).cast("long").alias("n_links"),
            F.col("vec_id").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    reached = components(edges).withColumnRenamed("node", "id")
    summed = counted.groupBy("id").agg(F.sum("links").alias("links"))
    known = staged(
        classes.join(summed, "id", "left")
        .join(reached, "id", "left")
        .select(
            F.col("label").alias("l"),
            F.col("embedding").alias("e"),
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        ),
        "known",
    )
    sound_rows = rows.filter("valid").join(known, (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e")))
    alone = rows.filter("not valid").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        sound_rows.select("vec_id", "n_links", "component_id")
        .unionByName(alone)
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
