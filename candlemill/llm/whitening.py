"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Components of a vector become whole numbers, ``floor(64 * c)`` (plus 1,000,000 in the contract,
which cancels out wherever the mean is taken off). The fit list holds every distinct vector
once, packed into blocks and written to the shared folder. Each pass over it is one Spark job
that adds up ``Xc^T (Xc Q)`` of centred blocks; only that product, as large as ``Q``, reaches
the driver. A polynomial recurrence over such passes damps the spectrum below the wanted
eigenvalues, then QR and Rayleigh-Ritz follow, until the residuals certify the components.

Edge cases: rows whose vector is NULL, empty or holds a NULL or non-finite component are left
out, and so are rows with ``|floor(64 * c)|`` beyond 2^31 - 1 and rows whose vector is not as
long as those of most fitted vectors. A NULL ``vec_id`` stays. Repeated rows each give their
rows. Directions without variance can't be whitened: a component exists only where its
eigenvalue is above 1e-12 of the largest, so an empty table, or one with a single distinct
vector, gives no rows. ``deviation`` beyond a long is NULL. Other columns are ignored.
"""

from decimal import Decimal
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from candlemill.llm.common import staged
from candlemill.llm.vectors import floored, matrices, packed, pieces, unpacked

SCALE = 64
LIMIT = (1 << 31) - 1
COMPONENTS = 16
#: Vectors in one block of the fit list.
BLOCK = 4096
#: Passes of one polynomial, steps of the spectrum's first estimate, polynomials at most.
DEGREE = 10
PROBES = 10
ROUNDS = 60
#: Directions below this share of the largest eigenvalue have no variance to speak of.
FLAT = 1e-12
#: More partial sums than this are added up in tasks before they reach the driver.
FAN_IN = 128

OUTPUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def _packed_rows(batches):
    for piece in pieces(batches, "embedding"):
        for _, matrix in matrices(piece.column("embedding")):
            x, _ = floored(matrix, SCALE, LIMIT)
            for rows, width, values in packed(x):
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, x.shape[1], np.int32)), pa.array(np.full(n, width, np.int32)), values],
                    ["dims", "width", "x"],
                )


def _blocks(batches):
    """Packed vectors joined into blocks of one length and width."""
    held = {}

    def block(key):
        data = b"".join(held.pop(key))
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([data], pa.binary())],
            ["dims", "width", "x"],
        )

    for batch in batches:
        for dims, width, x in zip(*(batch.column(c).to_pylist() for c in ("dims", "width", "x"))):
            rows = held.setdefault((dims, width), [])
            rows.append(x)
            if len(rows) >= BLOCK:
                yield block((dims, width))
    for key in list(held):
        yield block(key)


def _matrices(batches):
    for batch in batches:
        for dims, width, x in zip(*(batch.column(c) for c in ("dims", "width", "x"))):
            yield unpacked(x.as_buffer(), width.as_py(), dims.as_py())


def fit_list(embeddings):
    """Every distinct integer vector once, in blocks ``(dims, width, x)`` in the shared folder.

    Copies are dropped in each task before the shuffle, so a common vector costs no more
    than one row a task.
    """
    rows = embeddings.select("embedding").mapInArrow(_packed_rows, "dims int, width int, x binary")
    return staged(rows.distinct().mapInArrow(_blocks, "dims int, width int, x binary"), "fit-list")


def _moments(batches):
    """Exact sums and sums of squares per vector length and place."""
    sums = {}
    for x in _matrices(batches):
        wide = x if np.abs(x).max() < 1 << 25 else x.astype(object)
        n, s, q = sums.get(x.shape[1], (0, 0, 0))
        sums[x.shape[1]] = (
            n + len(x),
            s + wide.sum(axis=0).astype(object),
            q + (wide * wide).sum(axis=0).astype(object),
        )
    exact = pa.decimal128(38, 0)
    for dims, (n, s, q) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(dims, dims, np.int32)),
                pa.array(np.arange(dims, dtype=np.int32)),
                pa.array(np.full(dims, n, np.int64)),
                pa.array([Decimal(int(v)) for v in s], exact),
                pa.array([Decimal(int(v)) for v in q], exact),
            ],
            ["dims", "place", "n", "s", "q"],
        )


def moments(blocks):
    """``(n, S, Q)`` of the most common vector length: count, sums and sums of squares per place."""
    rows = blocks.mapInArrow(_moments, "dims int, place int, n long, s decimal(38,0), q decimal(38,0)")
    total = rows.groupBy("dims", "place").agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("n", "s", "q")])
    total = staged(total, "moments")
    top = total.filter("place = 0").orderBy(F.desc("n"), F.desc("dims")).first()
    if top is None:
        return 0, [], []
    rows = total.filter(F.col("dims") == top["dims"]).orderBy("place").collect()
    return int(top["n"]), [int(r["s"]) for r in rows], [int(r["q"]) for r in rows]


class Fit:
    """The centred fit list as an operator: each product with it is one pass over the blocks."""

    def __init__(self, embeddings, fan_in=FAN_IN):
        blocks = fit_list(embeddings)
        self.n, self.sums, squares = moments(blocks)
        self.dims, self.fan_in, self.passes = len(self.sums), fan_in, 0
        self.blocks = blocks.filter(F.col("dims") == self.dims).select("width", "x", "dims")
        self.parts = max(1, self.blocks.rdd.getNumPartitions())
        # Exact until the last division.
        spread = sum(self.n * q - s * s for q, s in zip(squares, self.sums))
        self.trace = spread / (self.n * self.n) if self.n else 0.0
        self.mean = np.array([s / self.n for s in self.sums])

    def _summed(self, part, shape):
        """The sum over all blocks of ``part(centred block)``."""
        mean = self.mean

        def partial(batches):
            total = np.zeros(shape)
            for x in _matrices(batches):
                total += part(x - mean)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

        def added(batches):
            found = sorted(v.as_py() for batch in batches for v in batch.column("part"))
            total = np.zeros(shape)
            for v in found:
                total += np.frombuffer(v).reshape(shape)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

        sums = self.blocks.mapInArrow(partial, "part binary")
        count = self.parts
        while count > self.fan_in:
            count = ceil(sqrt(count))
            sums = sums.repartition(count).mapInArrow(added, "part binary")
        self.passes += 1
        rows = sorted(bytes(r["part"]) for r in sums.collect())
        return sum((np.frombuffer(r).reshape(shape) for r in rows), np.zeros(shape))

    def product(self, q):
        """The covariance times ``q``."""
        return self._summed(lambda x: x.T @ (x @ q), q.shape) / self.n

    def covariance_of(self, w):
        """The covariance of the centred rows times ``w``, by one more pass."""

        def part(x):
            z = x @ w
            return z.T @ z

        return self._summed(part, (w.shape[1], w.shape[1])) / self.n


def _spectrum(fit, rng):
    """Estimates ``(least, greatest)`` of the eigenvalues, by a few Lanczos steps."""
    basis, alphas, betas = [], [], []
    v = rng.standard_normal(fit.dims)
    v /= np.linalg.norm(v)
    for _ in range(min(PROBES, fit.dims)):
        basis.append(v)
        w = fit.product(v[:, None])[:, 0]
        alphas.append(float(v @ w))
        for _ in range(2):
            for b in basis:
                w -= (b @ w) * b
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= 1e-10 * max(alphas):
            break
        v = w / betas[-1]
    values, vectors = np.linalg.eigh(np.diag(alphas) + np.diag(betas[:-1], 1) + np.diag(betas[:-1], -1))
    left = betas[-1] * np.abs(vectors[-1])
    return max(0.0, values[0] - left[0]), values[-1] + left[-1]


def _filtered(fit, q, vq, least, cut, greatest):
    """``q`` under a Chebyshev polynomial of the covariance that is small on [least, cut].

    ``vq`` is the covariance times ``q``; the scaled recurrence keeps the block's size near 1.
    """
    centre, half = (cut + least) / 2, max((cut - least) / 2, 1e-300)
    sigma = first = half / (greatest - centre)
    last, now = q, (vq - centre * q) * (first / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - sigma)
        nxt = (2 * following / half) * (fit.product(now) - centre * now) - (sigma * following) * last
        last, now, sigma = now, nxt, following
    return now


def components(fit, count=COMPONENTS, seed=0):
    """``(values, vectors)``: the largest eigenvalues and their unit vectors, certified.

    A pair is certified when its residual is at most 1e-11 of its distance to the other
    eigenvalues found, or as small as rounding lets it be.
    """
    if fit.trace <= 0:
        return np.zeros(0), np.zeros((fit.dims, 0))
    count = min(count, fit.dims)
    width = min(fit.dims, 2 * count)
    rng = np.random.default_rng(seed)
    least, greatest = (0.0, 0.0) if width == fit.dims else _spectrum(fit, rng)
    q = np.linalg.qr(rng.standard_normal((fit.dims, width)))[0]
    for _ in range(ROUNDS):
        vq = fit.product(q)
        middle = q.T @ vq
        values, turn = np.linalg.eigh((middle + middle.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        residual = np.linalg.norm(vq - q * values, axis=0)[:count]
        gaps = np.abs(values[:count, None] - values)
        gaps[np.arange(count), np.arange(count)] = np.inf
        allowed = np.maximum(1e-11 * gaps.min(axis=1), fit.dims * np.finfo(float).eps * values[0])
        if (residual <= allowed).all():
            kept = values[:count] > FLAT * values[0]
            return values[:count][kept], np.linalg.qr(q)[0][:, :count][:, kept]
        greatest = max(greatest, values[0])
        cut = min(max(values[-1], least + 1e-9 * greatest), values[count - 1])
        q = np.linalg.qr(_filtered(fit, q, vq, least, cut, greatest))[0]
    raise RuntimeError(f"components not certified after {fit.passes} passes: residuals {residual}")


def _deviations(x, n, sums):
    """Exact ``sum((n * x - S)^2)`` per row; None beyond a long."""
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if len(sums) * reach * reach < 1 << 62:
        off = n * x - np.array(sums, dtype=np.int64)
        return pa.array((off * off).sum(axis=1))
    off = n * x.astype(object) - np.array(sums, dtype=object)
    return pa.array([int(v) if v < 1 << 63 else None for v in (off * off).sum(axis=1)], pa.int64())


def whitened(embeddings, count=COMPONENTS, fan_in=FAN_IN):
    """``embeddings`` projected on the certified components, each scaled to unit variance."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    fit = Fit(rows, fan_in)
    values, vectors = components(fit, count)
    if not len(values):
        return rows.sparkSession.createDataFrame([], OUTPUT)
    scaled = vectors / np.sqrt(values)
    error = float(np.abs(fit.covariance_of(scaled) - np.eye(len(values))).max())
    explained, k = values / fit.trace, len(values)
    n, sums, mean, dims = fit.n, fit.sums, fit.mean, fit.dims
    names = [c.split()[0] for c in OUTPUT.split(", ")]

    def project(batches):
        for piece in pieces(batches, "embedding", 1 << 18):
            ids = piece.column("vec_id")
            for at, matrix in matrices(piece.column("embedding")):
                if matrix.shape[1] != dims:
                    continue
                x, fits = floored(matrix, SCALE, LIMIT)
                m = len(x)
                # Each output row repeats what belongs to its input row.
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(at[fits])).take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, np.int64)),
                        _deviations(x, n, sums).take(each),
                        pa.array(((x - mean) @ scaled).reshape(-1)),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names,
                )

    return rows.mapInArrow(project, OUTPUT)
