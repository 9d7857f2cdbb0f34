"""Near-duplicate embeddings by sorted projection passes.

Each pass gives every vector the signs of `BITS` random projections, read as one number, and sorts all
vectors by it. Close vectors share a long prefix and stand close together, so each vector is compared
in double precision with the `WINDOW` vectors after it. The passes only say which vectors belong together:
the pairs found in any of them connect the vectors to groups, and a task writes one edge per vector and
pass. The number of passes grows with the table (`passes`), because in a larger table a pair must agree
in more signs to stand in one window.

All pairs of a group are then compared in double precision, in bounded blocks dealt as in `ngram_join`, so
a cluster of any size has all its links; a task writes one row per vector. A link is missed only if no
pass and no chain of other links brings its two vectors together.

A pass is a range sort. The window of the last rows of a partition goes on in the next partition: both
ends of each partition are compared in a second, small step.

Equal vectors are one vector: they are linked with each other and share their links, so a very common
vector costs one row.

Defined results: vectors that are null, empty or zero or hold null or non-finite components link with
nothing; vectors of different lengths do not link. Rows that repeat an id count as rows, and so do rows
without id; those name no component and are not kept. Only vec_id and embedding are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkflow.llm.common import components, runs, slices
from perkflow.llm.ngram_join import grouped, in_blocks, lowest_labels
from perkflow.sources.scratch import materialise

THRESHOLD = 0.95
PASSES = 16  # at least
MISSED = 1e-4  # of the pairs at the threshold that all passes together may miss in even data
WINDOW = 100
BLOCK = 1024  # vectors of one side of an exact comparison
BITS = 63
_STEP = 256
_EDGES = "a long, b long, seam long, place int, bits binary"


def stored_kind(vectors: DataFrame) -> str:
    """Vectors are kept and moved in the precision they come in; all arithmetic is in double."""
    return "<f4" if isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vec_key (null if unusable) and vec (the components, see `stored_kind`)."""
    kind = stored_kind(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            keys, values = [], []
            for row in batch.column(1):
                vector = np.zeros(0)
                if row.is_valid and len(row.values) and not row.values.null_count:
                    vector = row.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                good = len(vector) and np.isfinite(vector).all() and 0 < _length(vector) < np.inf
                packed = vector.astype(kind).tobytes() if good else None
                values.append(packed)
                keys.append(hashlib.md5(packed).digest() if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(values, pa.binary())],
                names=["vec_id", "vec_key", "vec"],
            )

    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return rows.mapInArrow(run, "vec_id long, vec_key binary, vec binary")


def _length(vector: np.ndarray) -> float:
    """Root of the sum of squares without overflow."""
    top = np.abs(vector).max()
    return float(top * np.sqrt(((vector / top) ** 2).sum())) if top else 0.0


def passes(n: int) -> int:
    """Passes for n vectors. A pair must agree in about log2(n / WINDOW) signs to stand in one window."""
    agree = (1 - np.arccos(THRESHOLD) / np.pi) ** max(1.0, np.log2(max(1, n) / WINDOW))
    return max(PASSES, int(np.ceil(np.log(MISSED) / np.log1p(-agree))))


def projections(dim: int, number: int) -> np.ndarray:
    """Random directions of a pass, the same on every executor."""
    return np.random.default_rng((dim, number)).standard_normal((dim, BITS))


def projected(reps: DataFrame, number_of_passes: int, kind: str) -> DataFrame:
    """One row per vector and pass: dim, pass, order (the sign bits), rep and the vector."""
    size = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        powers = np.int64(1) << np.arange(BITS - 1, -1, -1)
        for batch in slices(batches, 1024):
            ids = batch.column(0).to_numpy()
            sizes = np.array([len(v.as_buffer()) // size for v in batch.column(1)])
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                vecs = batch.column(1).take(pa.array(at))
                matrix = np.frombuffer(b"".join(vecs.to_pylist()), kind).reshape(len(at), dim).astype(np.float64)
                matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
                for number in range(number_of_passes):
                    if (dim, number) not in planes:
                        planes[dim, number] = projections(int(dim), number)
                    order = (matrix @ planes[dim, number] > 0) @ powers
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), dim, np.int32)),
                            pa.array(np.full(len(at), number, np.int32)),
                            pa.array(order),
                            pa.array(ids[at]),
                            vecs,
                        ],
                        names=["dim", "pass", "order", "rep", "vec"],
                    )

    schema = "dim int, pass int, order long, rep long, vec binary"
    return reps.select("rep", "vec").mapInArrow(run, schema)


def close_pairs(unit: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs within the window whose later member is not among the first `kept` rows."""
    first, second = [], []
    for low in range(0, len(unit), _STEP):
        high = min(len(unit), low + _STEP + WINDOW)
        cosine = unit[low : low + _STEP] @ unit[low:high].T
        a, b = np.nonzero(cosine >= THRESHOLD)
        near = (b > a) & (b - a <= WINDOW) & (b + low >= kept)
        first.append(low + a[near])
        second.append(low + b[near])
    a = np.concatenate(first) if first else np.zeros(0, np.int64)
    b = np.concatenate(second) if second else np.zeros(0, np.int64)
    return a, b


def chains(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One edge at most per row, which connect the same rows as the pairs of positions (a, b)."""
    label = lowest_labels(len(ids), a, b)
    moved = np.flatnonzero(label != np.arange(len(ids)))
    a, b = ids[moved], ids[label[moved]]
    return np.minimum(a, b), np.maximum(a, b)


def _unit(vectors: list[bytes], dim: int, kind: str) -> np.ndarray:
    matrix = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), dim).astype(np.float64)
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix**2).sum(axis=1, keepdims=True))


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(a))
    columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64())]
    columns += [none.cast(k) for k in (pa.int64(), pa.int32(), pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "seam", "place", "bits"])


def _ends(ids: np.ndarray, vectors: list[bytes], seam: int, places: np.ndarray) -> pa.RecordBatch:
    """Rows to compare across a seam; place counts from the seam, negative before it."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.nulls(len(ids)).cast(pa.int64()),
            pa.array(np.full(len(ids), seam)),
            pa.array(places.astype(np.int32)),
            pa.array(vectors, pa.binary()),
        ],
        names=["a", "b", "seam", "place", "bits"],
    )


def _sweep(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Pairs of one sorted partition, and the rows at both of its ends."""
    here = TaskContext.get().partitionId()
    number = None
    ids, vectors = np.zeros(0, np.int64), []
    seen = 0
    for batch in batches:
        for part in runs([batch], 2):
            dim, own = part.column(0)[0].as_py(), (part.column(0)[0].as_py(), part.column(1)[0].as_py())
            if own != number:
                number, ids, vectors = own, np.zeros(0, np.int64), []
            new_ids, new = part.column(3).to_numpy(), part.column(4).to_pylist()
            if seen < WINDOW:
                take = min(len(new), WINDOW - seen)
                yield _ends(new_ids[:take], new[:take], here, seen + np.arange(take))
                seen += take
            kept = len(ids)
            ids, vectors = np.concatenate([ids, new_ids]), vectors + new
            yield _edges(*chains(ids, *close_pairs(_unit(vectors, dim, kind), kept)))
            ids, vectors = ids[-WINDOW:], vectors[-WINDOW:]
    if len(ids):
        yield _ends(ids, vectors, here + 1, np.arange(-len(ids), 0))


def _across(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Pairs of the last rows before and the first rows after a seam."""
    for group in runs(batches, 1):
        ids, place = group.column(1).to_numpy(), group.column(2).to_numpy()
        vectors = group.column(3).to_pylist()
        sizes = np.array([len(v) // np.dtype(kind).itemsize for v in vectors])
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            unit = _unit([vectors[i] for i in at], dim, kind)
            cosine = unit @ unit.T
            x, y = np.nonzero(cosine >= THRESHOLD)
            x, y = at[x], at[y]
            near = (place[x] < 0) & (place[y] >= 0) & (place[y] - place[x] <= WINDOW) & (ids[x] != ids[y])
            a, b = chains(ids, x[near], y[near])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def connecting_pairs(reps: DataFrame, kind: str) -> DataFrame:
    """(a, b) of different linked vectors, a < b, that connect all vectors whose link a pass found."""
    spark = reps.sparkSession
    number = reps.count()
    number_of_passes = passes(number)
    rows = projected(reps, number_of_passes, kind)
    # Partitions well above the window, so that a window crosses one seam at most.
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(most, number * number_of_passes // (8 * WINDOW)))
    order = ["dim", "pass", "order", "rep"]
    swept = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    swept = materialise(swept.mapInArrow(lambda batches: _sweep(batches, kind), _EDGES), "sweeps")
    ends = swept.filter(F.col("seam").isNotNull()).select("seam", F.col("a").alias("id"), "place", "bits")
    ends = ends.repartition("seam").sortWithinPartitions("seam")
    across = ends.mapInArrow(lambda batches: _across(batches, kind), "a long, b long")
    inside = swept.filter(F.col("seam").isNull()).select("a", "b")
    return inside.union(across).distinct()


def link_counts(ids: np.ndarray, unit: np.ndarray, copies: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Linked rows of each vector across the two blocks, or within the one."""
    two = block.min() != block.max()
    links = np.zeros(len(ids), np.int64)
    for low in range(0, len(ids), _STEP):
        here = np.arange(low, min(len(ids), low + _STEP))
        near = unit[here] @ unit.T >= THRESHOLD
        near[here - low, here] = False
        if two:
            near &= block[here][:, None] != block
        links[here] = near @ copies
    return links


def exact_links(reps: DataFrame, groups: DataFrame, kind: str) -> DataFrame:
    """(rep, links) from all pairs of each group (rep, component_id), in bounded blocks."""
    sizes = groups.groupBy("component_id").agg(F.count(F.lit(1)).alias("n"))
    members = groups.join(sizes, "component_id")
    members = in_blocks(members, ["component_id"], F.col("n"), "rep", BLOCK)
    members = members.join(reps.select("rep", "copies", "vec"), "rep")
    members = members.select("component_id", "low", "high", "rep", "block", "copies", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, 3):
            ids, block, copies = (group.column(i).to_numpy() for i in (3, 4, 5))
            vectors = group.column(6).to_pylist()
            unit = _unit(vectors, len(vectors[0]) // np.dtype(kind).itemsize, kind)
            links = link_counts(ids, unit, copies, block)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links)], names=["rep", "links"])

    dealt = grouped(members, ["component_id"], run, "rep long, links long")
    return dealt.groupBy("rep").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    rows = materialise(usable(vectors), "vectors")
    good = rows.filter(F.col("vec_key").isNotNull())
    # Vectors go by a number of their own, because rows that repeat an id may hold different vectors.
    keyed = good.groupBy("vec_key").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec")
    )
    reps = materialise(keyed.withColumn("rep", F.monotonically_increasing_id()), "distinct_vectors")
    kind = stored_kind(vectors)
    found = materialise(components(connecting_pairs(reps, kind)).withColumnRenamed("id", "rep"), "groups")
    # The names are stored, so that a component with very many vectors meets a side of known size.
    names = materialise(
        found.join(reps.select("rep", "first_id"), "rep").groupBy("component_id").agg(
            F.min("first_id").alias("name")
        ),
        "names",
    )
    known = (
        reps.select("vec_key", "rep", "first_id", "copies")
        .join(exact_links(reps, found, kind), "rep", "left")
        .join(found, "rep", "left")
        .join(names, "component_id", "left")
        .select(
            "vec_key",
            F.coalesce("name", "first_id").alias("component_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    out = rows.select("vec_id", "vec_key").join(known, "vec_key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
