"""Operator 13: whitening of embeddings by the leading components of their covariance.

Every entry c becomes the whole number x = floor(64 c) + 1000000. Sums are exact; the covariance is
centred before multiplying, block by block of rows, and its d * d entries are added up by Spark.
The eigenvalues of that matrix come from Householder tridiagonalisation and Sturm-count bisection,
the components from inverse iteration, reorthogonalised within clusters of eigenvalues, on the
driver: its size is that of the dimensions, not of the rows. Rows are projected where they lie.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .base import only, prepare, staged

#: Components at most; rows that are multiplied at once.
COMPONENTS, ROWS = 32, 4096
#: The scale and shift of an entry.
SCALE, SHIFT = 64, 1_000_000
LONG = 1 << 63


# ------------------------------------------------------------------ symmetric eigenvectors
def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder reduction: the diagonal and the other diagonal of T, and Q with A = Q T Q'."""
    a = np.array(a, float)
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1:, k]
        largest = np.abs(x).max()
        if largest == 0 or not np.any(x[1:]):
            continue
        v = x / largest
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        p = a[k + 1:, k + 1:] @ v
        w = p - (v @ p) * v
        a[k + 1:, k + 1:] -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] -= 2 * v * (v @ a[k + 1:, k])
        a[k, k + 1:] = a[k + 1:, k]
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def sturm_counts(d: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each point."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    below = np.zeros(len(at), np.int64)
    p = np.ones(len(at))
    for i in range(len(d)):
        p = d[i] - at - ((e[i - 1] / p) * e[i - 1] if i else 0.0)
        p = np.where(np.abs(p) < tiny, -tiny, p)
        below += p < 0
    return below


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection of Gershgorin's interval to the last bits."""
    n = len(d)
    reach = np.zeros(n)
    reach[:-1] += np.abs(e)
    reach[1:] += np.abs(e)
    span = max(np.abs(d).max() + reach.max(), np.finfo(float).tiny)
    lo = np.full(k, (d - reach).min() - span * 1e-15)
    hi = np.full(k, (d + reach).max() + span * 1e-15)
    rank = n - 1 - np.arange(k)  # an eigenvalue is the point where the count passes its rank
    while True:
        mid = lo + (hi - lo) / 2
        if np.all(hi - lo <= np.finfo(float).eps * np.maximum(np.maximum(np.abs(lo), np.abs(hi)), span * 1e-6)):
            return mid
        right = sturm_counts(d, e, mid) <= rank
        lo, hi = np.where(right, mid, lo), np.where(right, hi, mid)


def _solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """(T - shift) x = b by elimination with partial pivoting; zero pivots become tiny ones."""
    n = len(d)
    u, v, w, x = d - shift, np.append(e, 0.0), np.zeros(n), b.copy()
    least = np.finfo(float).eps * max(np.abs(d).max(), np.abs(e).max() if n > 1 else 0.0, np.finfo(float).tiny)
    low = e.copy()
    for i in range(n - 1):
        if abs(low[i]) > abs(u[i]):  # swap rows i and i + 1
            u[i], low[i] = low[i], u[i]
            v[i], u[i + 1] = u[i + 1], v[i]
            w[i], v[i + 1] = v[i + 1], w[i]
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(u[i]) < least:
            u[i] = least
        m = low[i] / u[i]
        u[i + 1] -= m * v[i]
        v[i + 1] -= m * w[i]
        x[i + 1] -= m * x[i]
    if abs(u[-1]) < least:
        u[-1] = least
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            x[i] -= v[i] * x[i + 1]
        if i + 2 < n:
            x[i] -= w[i] * x[i + 2]
        x[i] /= u[i]
        if abs(x[i]) > 1e200:
            x /= np.abs(x).max()
    return x


def tridiagonal_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of falling eigenvalues by inverse iteration. Within a cluster,
    eigenvalues nearer than 1e-3 of the norm, each is kept orthogonal to the earlier ones."""
    n, k = len(d), len(values)
    norm = max(np.abs(d).max(), np.abs(e).max() if n > 1 else 0.0)
    rng = np.random.default_rng(13)
    out = np.zeros((n, k))
    first, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        gap = 4 * np.finfo(float).eps * norm
        shift = value if j == first else min(value, shift - gap)
        x = rng.uniform(-1, 1, n)
        for _ in range(5):
            x = _solve(d, e, shift, x)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
            size = np.linalg.norm(x)
            if size < 1e-8:
                x = rng.uniform(-1, 1, n)
                continue
            x /= size
        out[:, j] = x
    return out


def leading_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as
    columns. Eigenvalues that rounding cannot tell from zero are left out."""
    d, e, q = tridiagonal(v)
    values = leading_eigenvalues(d, e, min(k, len(d)))
    values = values[values > len(d) * np.finfo(float).eps * np.abs(values).max(initial=0.0)]
    return values, q @ tridiagonal_vectors(d, e, values)


# ------------------------------------------------------------------ passes over the rows
def _whole(vectors, d: int) -> np.ndarray:
    """The x of a batch's vectors, one row each."""
    c = np.array([np.asarray(v, np.float64) for v in vectors]).reshape(len(vectors), d)
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


def _sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sums of their x."""
    def add(batches):
        n, total = 0, [0] * d
        for b in batches:
            x = _whole(b["v"], d)
            n += len(x)
            # halves of 32 bits add up without overflow
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            total = [t + (h << 32) + l for t, h, l in zip(total, high, low)]
        yield pd.DataFrame({"i": range(d), "n": n, "high": [t >> 32 for t in total], "low": [t & 0xFFFFFFFF for t in total]})

    found = (rows.mapInPandas(add, "i int, n bigint, high bigint, low bigint").groupBy("i")
             .agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect())  # d rows
    out = {r["i"]: r for r in found}
    return out[0]["n"], [(out[i]["high"] << 32) + out[i]["low"] for i in range(d)]


def _covariance(rows: DataFrame, d: int, n: int, centred) -> np.ndarray:
    """The d * d covariance, divisor n, of the doubles that ``centred`` makes of a batch."""
    at = np.triu_indices(d)

    def multiply(batches):
        total = np.zeros((d, d))
        for b in batches:
            for lo in range(0, len(b), ROWS):
                y = centred(b["v"].iloc[lo:lo + ROWS])
                total += y.T @ y
        yield pd.DataFrame({"i": at[0].astype("int32"), "j": at[1].astype("int32"), "s": total[at]})

    out = np.zeros((d, d))
    for r in (rows.mapInPandas(multiply, "i int, j int, s double").groupBy("i", "j")
              .agg(F.sum("s").alias("s")).collect()):  # d (d + 1) / 2 rows
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"] / n
    return out


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Per row the sum of (n x - S)^2, exactly; null where it does not fit a long."""
    most = max((max(abs(n * int(hi) - s), abs(n * int(lo) - s))
                for hi, lo, s in zip(x.max(axis=0), x.min(axis=0), sums)), default=0)
    if most * most * max(len(sums), 1) < LONG and n * int(np.abs(x).max(initial=0)) < LONG:
        y = n * x - np.array(sums, np.int64)
        return (y * y).sum(axis=1).tolist()
    out = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    return [v if v < LONG else None for v in out]


def _means(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n without loss: the whole part of the mean is taken away in whole numbers."""
    return (x - np.array([s // n for s in sums], np.int64)).astype(float) - np.array([(s % n) / n for s in sums])


def vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part: ``embedding`` not null nor empty, without null or
    non-finite entries, none so large that its x does not fit half a long, and of the most frequent
    length (ties: the longer)."""
    rows = only(embeddings, "vec_id", "embedding").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    fits = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float(1 << 56)))  # false for NaN, which sorts above
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & fits)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("v") == (lengths[0]["d"] if lengths else 0))


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per row of ``embeddings`` (vec_id, embedding) that takes part (see :func:`vectors`) and per
    component, numbered from 1 by falling eigenvalue e: vec_id, component, n, deviation, whitened,
    explained, identity_error.

    whitened is the projection of x - S / n on the component over sqrt(e); deviation the row's exact
    sum of (n x - S)^2 (null beyond a long); explained e over the trace; identity_error the largest
    entry of the whitened rows' covariance less the identity. Repeated rows each count and come
    out; without rows, or where all are equal, the result is empty; components whose eigenvalue
    rounding cannot tell from zero are left out. Other columns are ignored.
    """
    spark = prepare(embeddings.sparkSession)
    rows = vectors(embeddings)
    first = rows.select(F.size("v").alias("d")).head()
    d = first["d"] if first else 1
    n, sums = _sums(rows, d) if first else (0, [0])
    values, basis = np.zeros(0), np.zeros((d, 0))
    if n:
        cov = _covariance(rows, d, n, lambda v: _means(_whole(v, d), n, sums))
        values, basis = leading_components(cov, components)
    if not len(values):
        return spark.createDataFrame([], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
                                         "explained double, identity_error double")
    k, scaled = len(values), basis / np.sqrt(values)

    def project(batches):
        for b in batches:
            if len(b):
                x = _whole(b["v"], d)
                yield pd.DataFrame({"vec_id": b["vec_id"], "deviation": pd.array(_deviations(x, n, sums), "Int64"),
                                    "v": list(_means(x, n, sums) @ scaled)})

    kind = dict(rows.dtypes)["vec_id"]
    out = staged(rows.mapInPandas(project, f"vec_id {kind}, deviation bigint, v array<double>"), "whitened")
    mean = out.select(*[F.avg(F.col("v")[i]) for i in range(k)]).head()
    middle = np.array(list(mean), float)
    error = _covariance(out, k, n, lambda v: np.stack(v.to_numpy()) - middle) - np.eye(k)
    explained = F.array(*[F.lit(float(e / np.trace(cov))) for e in values])
    return (out.select("vec_id", "deviation", F.posexplode("v").alias("i", "whitened"))
            .select("vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    explained[F.col("i")].alias("explained"), F.lit(float(np.abs(error).max())).alias("identity_error")))
