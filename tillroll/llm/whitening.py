"""Whitening of embeddings by their leading components, found by contour integration.

Spark counts, sums and multiplies: the distinct vectors, their sums, and the covariance of
the centred vectors, a matrix as wide as a vector whatever the number of rows. Its leading
eigenvectors come from that matrix alone, by FEAST: inertia counts place intervals around
the wanted eigenvalues, a quadrature over a circle around each, every node a solve with a
complex shift, projects random vectors onto its eigenspace, and Rayleigh-Ritz takes the
components out of it. The inertia tells how many eigenvalues an interval holds, so none can
be missed. Every row is then projected where it lies.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tillroll.llm.common import discard, saved_at

COMPONENTS = 4
#: Steps of a vector entry to one: entries are counted in 1/256.
SCALE = 256
#: Quadrature nodes on the upper half of the circle.
NODES = 16
#: Residual, as a share of the matrix norm, from which a component may count as settled.
TOLERANCE = 1e-12
#: Vectors projected beyond those in the circle.
SPARE = 4
MAX_ROUNDS = 40
LONG = np.iinfo(np.int64)


# --- eigenvalues of the covariance -------------------------------------------------


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are above ``shift``.

    By Sylvester's law that is the number of positive pivots of the shifted matrix when it is
    eliminated symmetrically, with pivots of one row or of two, whichever stays well away
    from zero: the largest entry on the diagonal unless another one is much larger.
    """
    a = matrix - shift * np.eye(len(matrix))
    tiny = np.finfo(float).eps * max(np.abs(a).max(initial=0.0), np.finfo(float).tiny)
    above = 0
    while len(a):
        size = np.abs(a)
        at = int(np.argmax(size.diagonal()))
        row, column = np.unravel_index(int(np.argmax(size)), a.shape)
        if size[at, at] >= 0.64 * size[row, column]:
            pivots = [at]
        else:
            pivots = [int(row), int(column)]
        if size[row, column] <= tiny:
            break  # what is left is zero: these eigenvalues equal the shift
        block = a[np.ix_(pivots, pivots)]
        # A pivot of two rows is indefinite by the rule: one eigenvalue on either side.
        above += int(block[0, 0] > 0) if len(pivots) == 1 else 1
        rest = np.delete(np.arange(len(a)), pivots)
        side = a[np.ix_(rest, pivots)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        a = (a + a.T) / 2
    return above


def intervals(matrix: np.ndarray, wanted: int, top: float) -> list[tuple[float, float, int]]:
    """Circles (centre, radius, eigenvalues inside) around the ``wanted`` largest eigenvalues.

    Bisection on the inertia places each eigenvalue, and every step serves all of them.
    Eigenvalues too close to be told apart share a circle, which may thus hold more than are
    wanted. A circle reaches half-way to the nearest eigenvalue outside of it.
    """
    size, close = len(matrix), 1e-9 * top
    counts = {-close: size, top: 0}

    def place(number: int) -> float:
        low = max(shift for shift, above in counts.items() if above >= number)
        high = min(shift for shift, above in counts.items() if above < number)
        while high - low > close / 8:
            middle = (low + high) / 2
            counts[middle] = inertia(matrix, middle)
            low, high = (middle, high) if counts[middle] >= number else (low, middle)
        return (low + high) / 2

    circles, number, above = [], 0, np.inf
    while number < wanted:
        group = [place(number + 1)]
        below = -np.inf
        while number + len(group) < size:
            after = place(number + len(group) + 1)
            if group[-1] - after > close:
                below = after
                break
            group.append(after)
        spread = (group[0] - group[-1]) / 2
        gap = min(above - group[0], group[-1] - below, 2 * top)
        circles.append(((group[0] + group[-1]) / 2, spread + gap / 2, len(group)))
        number, above = number + len(group), group[-1]
    return circles


def project(matrix: np.ndarray, centre: float, radius: float, inside: int, norm: float) -> np.ndarray:
    """Orthonormal eigenvectors (columns) of the ``inside`` eigenvalues in a circle."""
    size = len(matrix)
    turns = np.exp(1j * np.pi * (np.arange(NODES) + 0.5) / NODES)
    space = np.random.default_rng(0).standard_normal((size, min(size, inside + SPARE)))
    before = np.inf
    for _ in range(MAX_ROUNDS):
        # The lower half of the circle gives the conjugates, so the real part is enough.
        projected = np.zeros_like(space)
        for turn in turns:
            shifted = (centre + radius * turn) * np.eye(size) - matrix
            projected += (radius * turn * np.linalg.solve(shifted, space.astype(complex))).real
        basis, _ = np.linalg.qr(projected)
        values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
        space = basis @ turned
        left = np.abs(matrix @ space - space * values).max(axis=0)
        # Values that only look like eigenvalues can fall into the circle: they never settle.
        settled = (np.abs(values - centre) < radius) & (left <= TOLERANCE * norm)
        if settled.sum() == inside:
            residual = left[settled].max()
            if residual >= before / 2:  # a further round no longer halves it
                return space[:, settled]
            before = residual
    raise ArithmeticError(f"{settled.sum()} of {inside} eigenvalues within {radius} of {centre}")


def feast(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a covariance, falling, and their vectors (columns).

    Fewer if the matrix has fewer that are above rounding error. Vectors of equal
    eigenvalues are any orthonormal basis of their space.
    """
    size = len(matrix)
    norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))  # no eigenvalue is above
    if norm == 0 or not wanted:
        return np.zeros(0), np.zeros((size, 0))
    wanted = min(wanted, inertia(matrix, size * np.finfo(float).eps * norm))
    circles = intervals(matrix, wanted, norm * (1 + 1e-9))
    found = np.hstack([project(matrix, *circle, norm) for circle in circles])
    basis, _ = np.linalg.qr(found)
    values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
    return values[::-1][:wanted], (basis @ turned)[:, ::-1][:, :wanted]


# --- vectors ----------------------------------------------------------------------


def _steps(vectors: pa.ListArray, size: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows that can be used, and their entries in whole steps, one row each.

    A vector is left out if it or an entry is null, an entry is not finite, or, with ``size``
    given, if it has another length.
    """
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    usable = vectors.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0)
    flat = vectors.flatten()
    entries = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    usable &= bad[starts[1:]] == bad[starts[:-1]]
    if size is None:
        return usable, np.zeros((0, 0), np.int64)
    usable &= lengths == size
    rows = np.flatnonzero(usable)
    picked = entries[starts[rows][:, None] + np.arange(size)] if len(rows) else np.zeros((0, size))
    with np.errstate(over="ignore"):
        whole = np.floor(SCALE * picked)
    inside = np.clip(whole, float(LONG.min), float(2**63 - 1024))  # the ends of long
    return rows, inside.astype(np.int64)


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        usable, _ = _steps(batch["vector"], None)
        lengths = batch["vector"].value_lengths().filter(pa.array(usable))
        counted = lengths.cast(pa.int64()).value_counts()
        yield pa.RecordBatch.from_arrays(
            [counted.field("values"), counted.field("counts")], ["size", "n"]
        )


def _packed(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, steps = _steps(batch["vector"], size)
            distinct = {row.tobytes() for row in steps.astype("<i8")}
            yield pa.RecordBatch.from_arrays([pa.array(list(distinct), pa.binary())], ["x"])

    return run


def _unpacked(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """The vectors of a batch of the fit list."""
    column = batch["x"]
    data = b"".join(x.as_buffer().to_pybytes() for x in column)
    return np.frombuffer(data, "<i8").reshape(-1, size)


class _Centre:
    """The mean of the fit list, and deviations from it, exact while they fit into a long."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.mean = np.array([s / n for s in sums])

    def _whole(self, steps: np.ndarray) -> np.ndarray:
        """n * x - S; as Python integers where a long is too small."""
        most = max(int(steps.max(initial=0)), -int(steps.min(initial=0))) * self.n
        if most + max(map(abs, self.sums)) > LONG.max:
            return steps.astype(object) * self.n - np.array(self.sums, object)
        return steps * self.n - np.array(self.sums, np.int64)

    def centred(self, steps: np.ndarray) -> np.ndarray:
        return np.asarray(self._whole(steps) / self.n, np.float64)

    def deviations(self, steps: np.ndarray) -> list[int | None]:
        """Sum of squares of n * x - S; None where it is beyond a long."""
        whole = self._whole(steps)
        most = max(int(whole.max(initial=0)), -int(whole.min(initial=0)))
        if most * most * steps.shape[1] <= LONG.max:
            return (whole * whole).sum(axis=1).tolist()
        exact = (whole.astype(object) ** 2).sum(axis=1)
        return [int(x) if x <= LONG.max else None for x in exact]


def _sums(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * size, 0
        for batch in batches:
            steps = _unpacked(batch, size)
            wide = steps.astype(object) if np.abs(steps.astype(float)).max(initial=0) > 2**40 else steps
            total = [a + int(b) for a, b in zip(total, wide.sum(axis=0), strict=True)]
            n += len(steps)
        dims = pa.array(range(-1, size), pa.int32())
        # As text: Arrow's decimals and Spark's both hold 38 digits, longs do not.
        yield pa.RecordBatch.from_arrays([dims, pa.array([str(n), *map(str, total)])], ["dim", "s"])

    return run


def _products(size: int, values: Callable[[np.ndarray], np.ndarray]) -> Callable:
    """Sums of products of the columns of ``values(x)``, row i of the matrix as (i, row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            rows = values(_unpacked(batch, size))
            total = rows.T @ rows if total is None else total + rows.T @ rows
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))],
                ["i", "products"],
            )

    return run


def _second_moments(fit: DataFrame, n: int, size: int, values: Callable) -> np.ndarray:
    """Matrix of mean products over the fit list: partial sums by task, added up by entry."""
    sums = (
        fit.mapInArrow(_products(size, values), "i int, products array<double>")
        .select("i", F.posexplode("products").alias("j", "product"))
        .groupBy("i", "j")
        .agg(F.sum("product").alias("product"))
        .collect()  # as many numbers as a vector has entries, squared
    )
    width = max(row["i"] for row in sums) + 1
    matrix = np.zeros((width, width))
    for row in sums:
        matrix[row["i"], row["j"]] = row["product"] / n
    return (matrix + matrix.T) / 2


def _whitened(size: int, centre: _Centre, scaled: np.ndarray, explained: list[float], error: float):
    width = scaled.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, steps = _steps(batch["vector"], size)
            values = centre.centred(steps) @ scaled
            many = len(rows) * width
            columns = [
                batch["id"].take(pa.array(np.repeat(rows, width))),
                pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(rows))),
                pa.array([centre.n] * many, pa.int64()),
                pa.array(centre.deviations(steps), pa.int64()).take(
                    pa.array(np.repeat(np.arange(len(rows)), width))
                ),
                pa.array(values.ravel()),
                pa.array(np.tile(explained, len(rows)), pa.float64()),
                pa.array([error] * many, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, list(NAMES))

    return run


NAMES = ("id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def whiten(
    embeddings: DataFrame,
    components: int = COMPONENTS,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Each row's whitened value along each of the leading components, a row for each.

    id, component (from 1), n, deviation, whitened, explained, identity_error. A vector that
    is null, empty, or has null or non-finite entries is left out, as is one of another
    length than most rows have (of equally many, the longer). Entries become whole steps
    x = floor(256 * c), held at the ends of a long. The fit list is each distinct x once, n
    of them with sums S; its covariance has divisor n. ``deviation`` is the sum of
    (n * x - S)^2, null where it exceeds a long. ``whitened`` is x - S / n along the component
    over the root of its eigenvalue, ``explained`` the eigenvalue's share of the trace, and
    ``identity_error`` the largest absolute entry of the whitened fit list's covariance minus
    the identity. Components without variance are left out, so a table whose vectors are all
    equal, or one without usable rows, gives no rows. Repeated rows and null ids stay. Other
    columns are not read.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col(id_column).alias("id"), F.col(vector).alias("vector"))
    schema = StructType([StructField("id", rows.schema["id"].dataType)])
    for name in NAMES[1:]:
        schema = schema.add(name, {"component": "integer", "n": "long", "deviation": "long"}.get(name, "double"))

    def renamed(df: DataFrame) -> DataFrame:
        return df.withColumnRenamed("id", id_column)

    none = renamed(spark.createDataFrame([], schema))
    lengths = (
        rows.mapInArrow(_lengths, "size bigint, n bigint")
        .groupBy("size")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), F.desc("size"))
        .first()
    )
    if lengths is None:
        return none
    size = lengths["size"]
    # Copies are combined in each batch, each task and once more after the shuffle.
    fit, fit_path = saved_at(rows.mapInArrow(_packed(size), "x binary").distinct(), "fit-list")
    sums = {
        row["dim"]: int(row["s"])
        for row in fit.mapInArrow(_sums(size), "dim int, s string")
        .groupBy("dim")
        .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        .collect()
    }
    centre = _Centre(sums[-1], [sums[i] for i in range(size)])
    covariance = _second_moments(fit, centre.n, size, centre.centred)
    values, vectors = feast(covariance, min(components, size))
    if not len(values):
        discard(spark, fit_path)
        return none
    scaled = vectors / np.sqrt(values)
    spread = _second_moments(fit, centre.n, size, lambda x: centre.centred(x) @ scaled)
    discard(spark, fit_path)
    error = float(np.abs(spread - np.eye(len(values))).max())
    explained = (values / np.trace(covariance)).tolist()
    return renamed(rows.mapInArrow(_whitened(size, centre, scaled, explained, error), schema))
