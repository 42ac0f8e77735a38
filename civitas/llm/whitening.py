"""Embedding whitening by incremental eigendecomposition.

Every partition keeps the spectrum of its own scatter matrix -- count, mean,
eigenvalues, eigenvectors -- and applies centred rank-one updates to it: each
solves the secular equation 1 + sum z_j^2 / (d_j - x) = 0 between the old
eigenvalues, after deflation of the directions the update does not touch, and
turns the eigenvectors by the solution. Rows come in chunks that QR first
shrinks to at most as many directions as there are dimensions, with the same
scatter; a chunk of one row is the plain update by one centred row. Spectra of
partitions are combined, FAN at a time on the executors, by successive
rank-one updates with the eigenpairs of the other and one for the distance of
the means. A last distributed pass projects all rows, centred exactly, on the
combined basis and solves the small eigenproblem of their covariance there
(Rayleigh-Ritz), which takes out what the updates have rounded off.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed, shared, table, unpacked
from .vectors import finite, matrix, reduced, state_row, width_of

SCALE, SHIFT = 1024, 100_000
CHUNK = 4096        # rows that one QR shrinks
COMPONENTS = 8
EPS = np.finfo(float).eps
STEPS = 60          # halvings of an interval between two poles


def secular(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of diag(d) + w w^T; d ascending and distinct, w without zeros.

    Root i lies between d_i and the next pole; it is searched as a distance to
    the nearer one, all roots at once. The vectors belong exactly to a
    neighbouring update whose roots these are, which keeps them orthogonal.
    """
    k = len(d)
    gap = np.append(d[1:], d[-1] + w @ w) - d
    near = np.arange(k)
    half = 1 + (w * w / (d[None, :] - d[:, None] - gap[:, None] / 2)).sum(axis=1) < 0
    half[-1] = False
    near = near + half
    poles = d[None, :] - d[near][:, None]
    low = np.where(half, -gap / 2, 0.0)
    high = np.where(half, 0.0, gap / 2)
    high[-1] = gap[-1]
    for _ in range(STEPS):
        x = (low + high) / 2
        right = 1 + (w * w / (poles - x[:, None])).sum(axis=1) < 0
        low, high = np.where(right, x, low), np.where(right, high, x)
    x = (low + high) / 2
    apart = poles - x[:, None]                      # pole j minus root i
    own = d[None, :] - d[:, None]
    np.fill_diagonal(own, 1.0)
    z = np.exp((np.log(np.abs(apart)).sum(axis=0) - np.log(np.abs(own)).sum(axis=0)) / 2) * np.sign(w)
    turn = (z / apart).T
    return d[near] + x, turn / np.linalg.norm(turn, axis=0)


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of vectors diag(values) vectors^T + v v^T."""
    order = np.argsort(values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    z = vectors.T @ v
    norm = np.linalg.norm(z)
    small = 8 * EPS * max(norm * norm, np.abs(values).max(initial=0.0))
    if norm * norm <= small * EPS or norm == 0:
        return values, vectors
    touched = np.abs(z) * norm > small
    last = None
    for i in np.flatnonzero(touched):               # equal eigenvalues: turn the update into one of the two
        if last is not None:
            r = np.hypot(z[last], z[i])
            c, s = z[i] / r, z[last] / r
            if abs(c * s * (values[i] - values[last])) <= small:
                a, b = vectors[:, last].copy(), vectors[:, i].copy()
                vectors[:, last], vectors[:, i] = c * a - s * b, s * a + c * b
                z[last], z[i], touched[last] = 0.0, r, False
                p, q = values[last], values[i]
                values[last], values[i] = c * c * p + s * s * q, s * s * p + c * c * q
        last = i
    if not touched.any():                           # the update is below the rounding of the eigenvalues
        return values, vectors
    at = np.flatnonzero(touched)
    at = at[np.argsort(values[at], kind="stable")]
    d, w = values[at], z[at]
    if len(d) > 1 and (np.diff(d) <= 0).any():      # a rotation rounded two poles together
        d = d + np.arange(len(d)) * small * EPS
    new, turn = secular(d, w)
    values[at], vectors[:, at] = new, vectors[:, at] @ turn
    return values, vectors


@dataclass
class Spectrum:
    n: float
    mean: np.ndarray
    values: np.ndarray      # of the scatter matrix
    vectors: np.ndarray

    @staticmethod
    def empty(d: int) -> Spectrum:
        return Spectrum(0.0, np.zeros(d), np.zeros(d), np.eye(d))

    def update(self, n: float, mean: np.ndarray, directions) -> None:
        """Take in ``n`` rows of that mean whose scatter is the sum of the directions' squares."""
        for v in directions:
            self.values, self.vectors = rank_one(self.values, self.vectors, v)
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, np.sqrt(self.n * n / (self.n + n)) * (mean - self.mean))
        self.mean = self.mean + (mean - self.mean) * (n / (self.n + n))
        self.n += n

    def add_rows(self, y: np.ndarray, chunk: int = CHUNK) -> None:
        for i in range(0, len(y), chunk):
            part = y[i:i + chunk]
            mean = part.mean(axis=0)
            self.update(len(part), mean, np.linalg.qr(part - mean, "r") if len(part) > 1 else ())

    def add(self, other: Spectrum) -> None:
        positive = other.values > 0
        self.update(other.n, other.mean, (np.sqrt(other.values[positive]) * other.vectors[:, positive]).T)

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array([self.n]), self.mean, self.values, self.vectors

    @staticmethod
    def read(state: bytes, d: int) -> Spectrum:
        a = np.frombuffer(state).copy()
        return Spectrum(a[0], a[1:d + 1], a[d + 1:2 * d + 1], a[2 * d + 1:].reshape(d, d))


def merge_spectra(d: int):
    def merge(a: bytes, b: bytes) -> bytes:
        s = Spectrum.read(a, d)
        s.add(Spectrum.read(b, d))
        return b"".join(np.ascontiguousarray(x).tobytes() for x in s.arrays())
    return merge


def add_longs(a: bytes, b: bytes) -> bytes:
    return (np.frombuffer(a, np.int64) + np.frombuffer(b, np.int64)).tobytes()


def add_doubles(a: bytes, b: bytes) -> bytes:
    return (np.frombuffer(a) + np.frombuffer(b)).tobytes()


def merge_moments(k: int):
    """Counts, means and centred scatters of two sets of rows."""
    def merge(a: bytes, b: bytes) -> bytes:
        x, y = np.frombuffer(a), np.frombuffer(b)
        n, step = x[0] + y[0], y[1:k + 1] - x[1:k + 1]
        scatter = x[k + 1:] + y[k + 1:] + (np.outer(step, step) * (x[0] * y[0] / n)).ravel()
        return np.concatenate(([n], x[1:k + 1] + step * (y[0] / n), scatter)).tobytes()
    return merge


@dataclass
class Whitening:
    """A fit: ``n`` rows, their whole-number ``sums`` by dimension, unit eigenvectors as columns, falling eigenvalues."""
    n: int
    sums: np.ndarray
    scale: int
    shift: int
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n, the whole part taken off before the fraction."""
        whole = self.sums // self.n
        return (x - whole).astype(float) - (self.sums - whole * self.n) / self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - sums)^2, exact whatever its size."""
        far = np.abs(x - self.sums // self.n).max(initial=0) + 1
        if int(far) * self.n < 1 << 62 and (int(far) * self.n) ** 2 * max(1, x.shape[1]) < 1 << 62:
            return ((self.n * (x - self.sums // self.n) - (self.sums - self.sums // self.n * self.n)) ** 2).sum(axis=1).tolist()
        rest = [int(s) for s in self.sums]
        return [sum((self.n * v - s) ** 2 for v, s in zip(row, rest, strict=True)) for row in x.tolist()]


def fit(df: DataFrame, vector: str = "embedding", *, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT,
        chunk: int = CHUNK) -> Whitening | None:
    """The leading ``components`` directions of all usable vectors; None if there is no row or no dimension.

    Rows with a null vector or a null, NaN or infinite entry are left out;
    shorter vectors end in entries of 0. Directions without variance are left
    out, as nothing can be scaled to variance one there. The driver sees one
    state of (dimensions + 2)^2 numbers, not rows.
    """
    spark = df.sparkSession
    rows = df.select(F.col(f"`{vector}`").alias("v")).filter(finite(F.col("v")))
    d = width_of(rows, "v")

    def over(make):
        """Task function: one state of the whole partition, none if it has no rows."""
        def run(batches):
            state = make()
            for b in batches:
                if b.num_rows:
                    state.take(matrix(b.column(0), d, scale, shift))
            if state.n:
                yield state_row(*state.arrays())
        return rows.mapInArrow(run, "id long, state binary")

    class Sums:
        def __init__(self):
            self.n, self.s = 0, np.zeros(d, np.int64)

        def take(self, x):
            self.n, self.s = self.n + len(x), self.s + x.sum(axis=0)

        def arrays(self):
            return np.append(self.s, self.n).astype(np.int64),

    class Updates:
        def __init__(self):
            self.spectrum = Spectrum.empty(d)

        n = property(lambda self: self.spectrum.n)

        def take(self, x):
            self.spectrum.add_rows((x - shift).astype(float), chunk)

        def arrays(self):
            return self.spectrum.arrays()

    got = reduced(over(Sums), add_longs, "whitening-sums") if d else None
    if got is None:
        return None
    got = np.frombuffer(got, np.int64)
    spectrum = Spectrum.read(reduced(over(Updates), merge_spectra(d), "whitening-spectra"), d)
    basis = np.linalg.qr(spectrum.vectors[:, np.argsort(-spectrum.values, kind="stable")])[0]
    model = Whitening(int(got[-1]), got[:-1].copy(), scale, shift, basis, np.ones(d), 0.0)

    sent = shared(spark, model)

    class Ritz:
        def __init__(self):
            self.n, self.model, self.h = 0, sent(), np.zeros((d, d))

        def take(self, x):
            y = self.model.centred(x) @ self.model.vectors
            self.n, self.h = self.n + len(x), self.h + y.T @ y

        def arrays(self):
            return self.h,

    h = np.frombuffer(reduced(over(Ritz), add_doubles, "whitening-ritz")).reshape(d, d) / model.n
    values, turn = np.linalg.eigh((h + h.T) / 2)
    trace = float(np.trace(h))
    top = [i for i in np.argsort(-values, kind="stable")[:components] if values[i] > 1e-13 * max(trace, 1e-300)]
    model = Whitening(model.n, model.sums, scale, shift, basis @ turn[:, top], values[top], trace)
    k = len(top)
    if not k:
        return model
    sent_model = shared(spark, model)

    class Moments:
        def __init__(self):
            self.n, self.model, self.state = 0, sent_model(), None

        def take(self, x):
            w = self.model.project(x)
            mean = w.mean(axis=0)
            state = np.concatenate(([len(w)], mean, ((w - mean).T @ (w - mean)).ravel()))
            self.state = state if self.state is None else np.frombuffer(merge_moments(k)(self.state.tobytes(), state.tobytes()))
            self.n = self.state[0]

        def arrays(self):
            return self.state,

    state = np.frombuffer(reduced(over(Moments), merge_moments(k), "whitening-check"))
    model.identity_error = float(np.abs(state[k + 1:].reshape(k, k) / state[0] - np.eye(k)).max())
    return model


def whiten(df: DataFrame, model: Whitening | None, vector: str = "embedding") -> DataFrame:
    """The usable rows of ``df`` with ``whitened`` (array<double>) and ``deviation`` (decimal(38,0), exact).

    Defined cases: rows with a null vector or an entry that is null, NaN or
    infinite go; repeated rows stay and give equal values; without a model
    (nothing to fit) there are no rows; vectors shorter than the model's end in
    entries of 0; input columns called ``whitened`` or ``deviation`` are replaced.
    """
    rows = packed(df.filter(finite(F.col(f"`{vector}`"))), F.col(f"`{vector}`").alias("_v"))
    if model is None:
        return unpacked(rows.limit(0), whitened=F.array().cast("array<double>"), deviation=F.lit(None).cast("decimal(38,0)"))
    sent, (d, k) = shared(df.sparkSession, model), model.vectors.shape

    def run(batches):
        m = sent()
        for b in batches:
            x = matrix(b.column(1), d, m.scale, m.shift)
            w = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * k, m.project(x).ravel())
            yield pa.RecordBatch.from_arrays([b.column(0), w, pa.array([str(v) for v in m.deviation(x)], pa.string())],
                                             names=["row", "_w", "_dev"])

    out = rows.mapInArrow(run, rows.drop("_v").schema.add("_w", T.ArrayType(T.DoubleType())).add("_dev", "string"))
    return unpacked(out, whitened=F.col("_w"), deviation=F.col("_dev").cast("decimal(38,0)"))


def op13_query(spark, sf_dir):
    """Eight whitened components of every usable embedding; ``deviation`` is null where it passes 64 bits."""
    df = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit(df)
    n, values, trace, error = (model.n, model.values, model.trace, model.identity_error) if model else (0, np.zeros(0), 1.0, 0.0)
    explained = F.array(*[F.lit(float(v / trace)) for v in values]).cast("array<double>")
    out = whiten(df, model).select("vec_id", F.posexplode("whitened").alias("at", "whitened"), "deviation")
    return out.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
                      F.expr("try_cast(deviation AS bigint)").alias("deviation"), "whitened",
                      F.get(explained, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"))
