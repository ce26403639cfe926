"""Whitening of vectors: blockwise QR, bidiagonal singular values, projection.

Entries are quantised to whole numbers, so that sums, and with them the centre, are exact.
Each task folds blocks of centred rows into one triangular factor, factors are folded
sixteen at a time until one is left, and its singular values and right vectors, found by
`bidiagonal`, give the covariance's eigenvalues and directions without ever squaring the
rows. What the driver and a task hold is of the size of a vector's square; the vectors stay
where they are and are projected in a pass of their own.

Defined cases: vectors that are null, empty or hold null or non-finite entries, or entries of
2^45 and more, are left out; so are vectors of another length than the most frequent one
(ties: the longest). Rows that share an id, or have none, are vectors of their own. Directions
without variance, up to rounding, are no components; so a single vector, equal vectors and an
empty table give no row. Equal eigenvalues are numbered in any order. A deviation beyond a long
is null. Only the id and vector columns are read.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.bidiagonal import EPS, bidiagonal, dqds, vectors
from docengine.sources.workspace import RunFolder

STEPS = 64  # whole numbers per unit
SHIFT = 1_000_000
LARGEST = 2.0**45
BLOCK = 4096
FAN = 16


@dataclass
class Whitening:
    """Centre, as number and sums of quantised vectors, values and directions (columns)."""

    rows: int
    sums: np.ndarray
    values: np.ndarray
    directions: np.ndarray
    trace: float


def quantised(batch: pa.RecordBatch) -> dict[int, tuple[list, np.ndarray]]:
    """Ids and whole-numbered vectors of a batch's usable rows, by length."""
    column = batch.column(1)
    sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0)
    found = {}
    for size in pa.compute.unique(sizes).to_pylist():
        if not size:
            continue
        part = batch.filter(pa.compute.equal(sizes, size))
        flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(float)
        rows = flat.reshape(part.num_rows, size)
        usable = (np.abs(rows) < LARGEST).all(axis=1)  # not so for null and non-finite entries
        whole = np.floor(STEPS * rows[usable]).astype(np.int64) + SHIFT
        if len(whole):
            found[size] = (part.column(0).filter(pa.array(usable)).to_pylist(), whole)
    return found


def centred(whole: np.ndarray, rows: int, sums: np.ndarray) -> np.ndarray:
    """Rows less their centre, rounded once: the centre's whole part goes first."""
    return (whole - sums // rows) - (sums % rows) / rows


def _sums(batches):
    totals: dict[int, list] = {}
    for batch in batches:
        for size, (_, whole) in quantised(batch).items():
            held = totals.setdefault(size, [0, 0])
            held[0] += len(whole)
            held[1] = held[1] + whole.sum(axis=0).astype(object)
    for size, (rows, sums) in totals.items():
        yield pa.record_batch(
            [pa.array([size]), pa.array([rows]), pa.array([[str(s) for s in sums]])],
            ["size", "rows", "sums"],
        )


def _fold(rows: int, sums: np.ndarray):
    size = len(sums)

    def run(batches):
        factor = np.zeros((0, size))
        for batch in batches:
            _, whole = quantised(batch).get(size, ([], np.zeros((0, size), np.int64)))
            for at in range(0, len(whole), BLOCK):
                part = centred(whole[at : at + BLOCK], rows, sums)
                factor = np.linalg.qr(np.vstack([factor, part]), mode="r")
        if len(factor):
            yield pa.record_batch(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([factor.tobytes()])],
                ["part", "factor"],
            )

    return run


def _fold_factors(size: int):
    def run(table: pa.Table) -> pa.Table:
        factor = np.zeros((0, size))
        table = table.sort_by("part")
        for held in table.column("factor").to_pylist():
            factor = np.linalg.qr(
                np.vstack([factor, np.frombuffer(held).reshape(-1, size)]), mode="r"
            )
        part = table.column("part")[0].as_py() // FAN
        return pa.table({"part": pa.array([part], pa.int64()), "factor": [factor.tobytes()]})

    return run


def fit(rows: DataFrame, folder: RunFolder) -> Whitening | None:
    """Centre, eigenvalues and eigenvectors of `(id, vector)` rows' quantised vectors."""
    totals = folder.write(
        rows.mapInArrow(_sums, "size long, rows long, sums array<string>"), "sums"
    )
    sizes = totals.groupBy("size").agg(F.sum("rows").alias("rows"))
    most = sizes.orderBy(F.desc("rows"), F.desc("size")).limit(1).collect()
    if not most:
        return None
    size, count = most[0]["size"], most[0]["rows"]
    at = totals.where(F.col("size") == size).select(F.posexplode("sums"))
    summed = at.groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect()
    sums = np.array([int(r["s"]) for r in sorted(summed)], np.int64)

    factors = folder.write(
        rows.mapInArrow(_fold(count, sums), "part long, factor binary"), "factors"
    )
    left = factors.agg(F.max("part")).collect()[0][0]
    while True:  # parts are numbered anew, sixteen to one, until one is left
        factors = factors.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(
            _fold_factors(size), "part long, factor binary"
        )
        left //= FAN
        if not left:
            break
    last = np.frombuffer(factors.collect()[0]["factor"]).reshape(-1, size)
    square = np.vstack([last, np.zeros((size - len(last), size))])
    diagonal, upper, right = bidiagonal(square)
    found = dqds(diagonal, upper)
    some = found > (size * EPS) ** 2 * found[0]
    if not found[0] > 0:
        return Whitening(count, sums, found[:0], right[:, :0], 0.0)
    directions = right @ vectors(diagonal, upper, found[some])
    lead = directions[np.abs(directions).argmax(axis=0), np.arange(some.sum())]
    return Whitening(
        count, sums, found[some] / count, directions * np.sign(lead), float(found.sum()) / count
    )


def _deviations(whole: np.ndarray, rows: int, sums: np.ndarray) -> list:
    """Exact sums of squares of rows * x - sums; null beyond a long."""
    largest = int(np.abs(whole).max()) * rows + int(np.abs(sums).max())
    if len(sums) * largest**2 < 2**63:
        return ((rows * whole - sums) ** 2).sum(axis=1).tolist()
    # Few are that far from the centre; the rest fit after the multiples cancel.
    base = sums // rows
    near, rest = whole - base, sums - rows * base
    if len(sums) * (int(np.abs(near).max()) * rows + rows) ** 2 < 2**63:
        return ((rows * near - rest) ** 2).sum(axis=1).tolist()
    exact = ((rows * near.astype(object) - rest) ** 2).sum(axis=1)
    return [v if v < 2**63 else None for v in exact]


def _project(model: Whitening, components: int):
    scaled = model.directions[:, :components] / np.sqrt(model.values[:components])

    def run(batches):
        for batch in batches:
            ids, whole = quantised(batch).get(len(model.sums), ([], None))
            for at in range(0, len(ids), BLOCK):
                part = whole[at : at + BLOCK]
                white = centred(part, model.rows, model.sums) @ scaled
                ends = pa.array(np.arange(len(part) + 1) * white.shape[1], pa.int32())
                yield pa.record_batch(
                    [
                        pa.array(ids[at : at + BLOCK], pa.int64()),
                        pa.array(_deviations(part, model.rows, model.sums), pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(white.ravel())),
                    ],
                    ["id", "deviation", "whitened"],
                )

    return run


def whitened(rows: DataFrame, model: Whitening, components: int) -> DataFrame:
    """`(id, deviation, whitened)` of `(id, vector)` rows, up to `components` entries each."""
    return rows.mapInArrow(
        _project(model, components), "id long, deviation long, whitened array<double>"
    )


def _moments(batches):
    count, first, second = 0, 0.0, 0.0
    for batch in batches:
        if batch.num_rows:
            white = np.array(batch.column(0).flatten()).reshape(batch.num_rows, -1)
            count += len(white)
            first = first + white.sum(axis=0)
            second = second + white.T @ white
    if count:
        yield pa.record_batch([pa.array([[*first, *second.ravel()]])], ["moments"])


def identity_error(white: DataFrame, rows: int, size: int) -> float:
    """Largest entry of the covariance of `whitened`, less the identity, without sign.

    The rows are centred already, up to rounding; what is left of their mean is taken off.
    """
    moments = white.select("whitened").mapInArrow(_moments, "moments array<double>")
    at = moments.select(F.posexplode("moments")).groupBy("pos").agg(F.sum("col").alias("s"))
    total = np.array([r["s"] for r in sorted(at.collect())]) / rows
    mean, second = total[:size], total[size:].reshape(size, size)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(size)).max())


COLUMNS = (
    "vec_id long, component int, n long, deviation long, whitened double, "
    "explained double, identity_error double"
)


def whiten(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 32
) -> DataFrame:
    """`COLUMNS`: a row per usable vector and component, components by falling eigenvalue."""
    spark = table.sparkSession
    rows = table.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    model = fit(rows, RunFolder(spark))
    size = min(components, len(model.values)) if model else 0
    if not size:
        return spark.createDataFrame([], COLUMNS)
    white = whitened(rows, model, size)
    error = identity_error(white, model.rows, size)
    shares = F.lit([float(v / model.trace) for v in model.values[:size]])
    return white.select("id", "deviation", F.posexplode("whitened")).select(
        F.col("id").alias("vec_id"),
        (F.col("pos") + 1).alias("component"),
        F.lit(model.rows).cast("long").alias("n"),
        "deviation",
        F.col("col").alias("whitened"),
        F.element_at(shares, F.col("pos") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
