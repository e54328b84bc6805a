"""Full-covariance Gaussian mixture fitted by expectation maximisation.

One EM iteration is ONE Spark job for any number of models: a ``mapInArrow`` pass
evaluates the E-step of every model on Arrow batches, adds up the M-step sums of
every component (``sum r``, ``sum r x``, ``sum r (x-c)(x-c)^T`` about the previous
mean ``c``) and the log-likelihood exactly (:mod:`moments`), and one aggregate
adds up the tasks.  Values of a row are computed term by term, never by a product
whose rounding depends on the rows beside it, so a fit is the same bits under any
partitioning.  Only K x D^2 numbers reach the driver, where each covariance is
factorised once per iteration (eigendecomposition, pseudo-inverse and
pseudo-determinant so that singular covariances are allowed) and shipped back
inside the next task closure.  Scoring rows with a fitted model is a narrow Arrow
UDF (no shuffle); rows whose vector is NULL get NULL.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .kmeans import first_k_seeds, fit_grid, kmeanspp_init, nearest_of, total_shift
from .moments import (
    BITS, LIMBS, Grid, Sums, batch_matrix, columns, group_co_moments, joined, limb_products, limbs, packed, part_rows, rounded, spread, total, vectors,
)

LOG_2PI = math.log(2.0 * math.pi)
# Fixed values of the reference M-step and stop rule
MIN_COMPONENT_MASS = 1e-10
EPSILON = 0.005


def psd_factor(cov: np.ndarray):
    """``(U, log_pdet, rank)`` with ``||(x-m) U||^2`` the Mahalanobis term.

    Eigenvalues at or below ``1e6 * eps * max|lambda|`` count as zero
    (pseudo-inverse / pseudo-determinant, the usual ``allow_singular`` rule).
    """
    cov = np.asarray(cov, dtype=np.float64)
    cov = 0.5 * (cov + cov.T)
    s, u = np.linalg.eigh(cov)
    tol = 1e6 * np.finfo(np.float64).eps * (np.max(np.abs(s)) if s.size else 0.0)
    if s.size and np.min(s) < -tol:
        raise ValueError("covariance matrix is not positive semidefinite")
    keep = s > tol
    inv = np.where(keep, 1.0 / np.where(keep, s, 1.0), 0.0)
    return u * np.sqrt(inv), float(np.sum(np.log(s[keep]))), int(keep.sum())


@dataclass
class GaussianMixtureModel:
    weights: list
    means: list
    covs: list  # K x D x D nested lists
    iterations: int = 0
    history: list = field(default_factory=list)  # (iteration, total_shift, log_likelihood, ll_change)
    log_likelihood: float | None = None
    converged: bool = True

    @property
    def k(self) -> int:
        return len(self.weights)

    def factors(self):
        out = []
        for w, m, c in zip(self.weights, self.means, self.covs):
            u, logdet, rank = psd_factor(np.asarray(c))
            const = (math.log(w) if w > 0 else float("-inf")) - 0.5 * (rank * LOG_2PI + logdet)
            out.append((const, np.asarray(m, dtype=np.float64), u))
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, float(w), [float(v) for v in m], [float(v) for v in np.asarray(c).ravel()])
                for i, (w, m, c) in enumerate(zip(self.weights, self.means, self.covs))]
        return spark.createDataFrame(rows, "cluster int, weight double, mean array<double>, cov array<double>")

    def history_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(int(i), float(s), float(ll), float(c)) for i, s, ll, c in self.history],
            "iteration int, total_shift double, log_likelihood double, ll_change double",
        )


# --- NumPy kernels (run inside tasks) ----------------------------------------


def log_joint_np(x: np.ndarray, factors) -> np.ndarray:
    """``l_ik = ln pi_k + ln N(x_i; mu_k, Sigma_k)`` for a batch, each row by itself."""
    return np.ascontiguousarray(log_joint_of(np.ascontiguousarray(x.T), factors).T)


def log_joint_of(columns: np.ndarray, factors) -> np.ndarray:
    """As :func:`log_joint_np`, K x rows, of rows that are given by their columns."""
    n = columns.shape[1]
    out, d, acc = np.empty((len(factors), n)), np.empty(n), np.empty(n)
    for k, (const, mean, u) in enumerate(factors):
        y = np.zeros((u.shape[1], n))
        part = np.empty_like(y)
        for c, m, w in zip(columns, mean, u):
            np.subtract(c, m, out=d)
            np.multiply(w[:, None], d, out=part)
            y += part
        acc[:] = 0.0
        for v in y:
            v *= v
            acc += v
        acc *= 0.5
        np.subtract(const, acc, out=out[k])
    return out


def logsumexp_of(l: np.ndarray) -> np.ndarray:
    """As :func:`logsumexp_np`, of a K x rows matrix, with the same bits."""
    m = l.max(axis=0)
    safe = np.where(np.isfinite(m), m, 0.0)
    e = np.exp(l - safe)
    with np.errstate(divide="ignore"):
        # from 8 terms on NumPy adds the ones of a row in another order
        return safe + np.log(e.sum(axis=0) if len(l) < 8 else np.ascontiguousarray(e.T).sum(axis=1))


def logsumexp_np(l: np.ndarray) -> np.ndarray:
    m = np.max(l, axis=1)
    safe = np.where(np.isfinite(m), m, 0.0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.sum(np.exp(l - safe[:, None]), axis=1))


def responsibilities_np(l: np.ndarray, mode: str = "softmax") -> np.ndarray:
    """Softmax of the joint log densities, or the reference's sequential variant.

    ``sequential``: for k = 0..K-1 in turn, ``l_k <- l_k - logsumexp(l)`` with
    the already updated entries, then ``r = exp(l)`` (rows need not sum to 1).
    """
    if mode == "softmax":
        return np.exp(l - logsumexp_np(l)[:, None])
    if mode == "sequential":
        l = l.copy()
        for k in range(l.shape[1]):
            l[:, k] = l[:, k] - logsumexp_np(l)
        return np.exp(l)
    raise ValueError(f"unknown responsibility mode {mode!r}")


# --- narrow scoring (Arrow UDFs) ----------------------------------------------


def _score_udf(model: GaussianMixtureModel, dim: int, what: str, spark=None):
    if spark is not None:
        ship_package(spark)
    factors = model.factors()

    def score(v: pa.Array) -> pa.Array:
        x = batch_matrix(pa.RecordBatch.from_arrays([v], ["f"]), "f", dim)
        l = log_joint_np(x, factors)
        if what == "log_joint":
            return vectors(l, v)
        if what in ("softmax", "sequential"):
            return vectors(responsibilities_np(l, what), v)
        out = np.full(len(v), np.nan) if what == "logsumexp" else np.zeros(len(v), np.int32)
        there = np.asarray(v.is_valid())
        out[there] = logsumexp_np(l) if what == "logsumexp" else np.argmax(l, axis=1)
        return pa.array(out, mask=~there)

    rtype = {"logsumexp": "double", "predict": "int"}.get(what, "array<double>")
    return F.arrow_udf(score, rtype)


def gaussian_logpdf(df: DataFrame, model: GaussianMixtureModel, col: str = "features", out: str = "log_joint") -> DataFrame:
    """Add ``ARRAY<DOUBLE>`` of ``ln pi_k + ln N(x; mu_k, Sigma_k)`` per component."""
    return df.withColumn(out, _score_udf(model, len(model.means[0]), "log_joint", df.sparkSession)(F.col(col)))


def em_estep(df: DataFrame, model: GaussianMixtureModel, mode: str = "softmax", col: str = "features", out: str = "resp") -> DataFrame:
    return df.withColumn(out, _score_udf(model, len(model.means[0]), mode, df.sparkSession)(F.col(col)))


def row_logsumexp(df: DataFrame, model: GaussianMixtureModel, col: str = "features", out: str = "lse") -> DataFrame:
    return df.withColumn(out, _score_udf(model, len(model.means[0]), "logsumexp", df.sparkSession)(F.col(col)))


def em_predict(df: DataFrame, model: GaussianMixtureModel, col: str = "features", out: str = "cluster") -> DataFrame:
    """Arg-max of the joint log density (ties -> lowest component)."""
    return df.withColumn(out, _score_udf(model, len(model.means[0]), "predict", df.sparkSession)(F.col(col)))


# --- one fused pass ------------------------------------------------------------


#: Binary places of the row log-likelihoods in their sum.
LL_PLACES = 40


def _run_pass(df: DataFrame, g: Grid, tasks: list[tuple], col: str, mode: str = "softmax") -> list[tuple]:
    """(sum r, sum r x, sum r (x-c)(x-c)^T, log-likelihood, rows) of every (centers, factors, seeds).

    With ``factors`` the responsibilities are the E-step of a model; with ``seeds``
    they are hard nearest-seed indicators (EM initialisation).  All sums are exact
    sums of limb products: of responsibilities to 60 binary places, of the others
    to 60 places below the largest product.
    """
    dim, exps, width = g.dim, g.exps, max(len(t[0]) for t in tasks)
    upper = np.triu_indices(dim)
    shapes = {"n": (1,), "bad": (1,), "ll": (2,), "r": (LIMBS, width), "rx": (LIMBS, width, dim), "rxx": (LIMBS, width, len(upper[0]))}
    tasks = [(np.asarray(c, dtype=np.float64), f, s) for c, f, s in tasks]
    # exponents of x - c, whatever c
    wide = [np.maximum(exps, np.frexp(np.abs(c).max(0))[1]) + 1 for c, _, _ in tasks]

    def fn(batches):
        parts: dict[int, Sums] = {}
        for b in batches:
            for x in columns(batch_matrix(b, col, dim)):
                qx = limbs(x, exps[:, None])
                for m, (centers, factors, seeds) in enumerate(tasks):
                    s = parts.setdefault(m, Sums(shapes))
                    k = len(centers)
                    if factors is not None:
                        l = log_joint_of(x, factors)
                        lse = logsumexp_of(l)
                        good = np.isfinite(lse)
                        s.add("bad", x.shape[1] - good.sum(), 0)
                        r = np.exp(l - lse) if mode == "softmax" else responsibilities_np(np.ascontiguousarray(l.T), mode).T
                        lse, r = np.where(good, lse, 0.0), np.where(good, r, 0.0)
                        whole = np.rint(lse)
                        s.add("ll", [whole.sum(), np.rint(np.ldexp(lse - whole, LL_PLACES)).astype(np.int64).sum()])
                    else:
                        r = (nearest_of(x, seeds) == np.arange(k)[:, None]).astype(np.float64)
                    s.add("n", x.shape[1], 0)
                    qr = limbs(r, np.zeros((k, 1), int))
                    s.add("r", qr.sum(axis=2), (slice(None), slice(0, k)))
                    s.add("rx", limb_products(qr, qx), (slice(None), slice(0, k)))
                    for a in range(k):
                        xc = x - centers[a][:, None]
                        qc, qy = limbs(xc, wide[m][:, None]), limbs(xc * r[a], wide[m][:, None])
                        s.add("rxx", limb_products(qy, qc)[:, upper[0], upper[1]], (slice(None), a))
        yield from part_rows(parts)

    found, out = total(df.select(col), fn, shapes), []
    for m, (centers, _, _) in enumerate(tasks):
        t, k = found[m], len(centers)
        if t["bad"][0]:
            raise ValueError(f"the densities of {t['bad'][0]} rows are not finite")
        nk = rounded(joined(t["r"])[:k], -LIMBS * BITS)
        sx = rounded(joined(t["rx"])[:k], exps - (LIMBS + 1) * BITS)
        second = np.zeros((k, dim, dim))
        second[:, upper[0], upper[1]] = rounded(joined(t["rxx"])[:k], (wide[m][:, None] + wide[m])[upper] - (LIMBS + 1) * BITS)
        second[:, upper[1], upper[0]] = second[:, upper[0], upper[1]]
        ll = float(rounded([t["ll"][0] * (1 << LL_PLACES) + t["ll"][1]], -LL_PLACES)[0])
        out.append((nk, sx, second, ll, int(t["n"][0])))
    return out


def _mstep(nk, sx, g, centers, n):
    """pi, mu, Sigma from the sums; Sigma about the NEW means (no ridge term)."""
    k, dim = sx.shape
    nk_c = np.maximum(nk, MIN_COMPONENT_MASS)
    weights = nk_c / n
    means = sx / nk_c[:, None]
    covs = []
    for j in range(k):
        c = np.asarray(centers[j])
        a = sx[j] - nk[j] * c
        delta = means[j] - c
        m = g[j] - np.outer(delta, a) - np.outer(a, delta) + nk[j] * np.outer(delta, delta)
        s = m / nk_c[j]
        covs.append(0.5 * (s + s.T))
    return weights, means, covs


def em_mstep(df: DataFrame, model: GaussianMixtureModel, mode: str = "softmax", col: str = "features", g: Grid | None = None):
    """One fused E+M pass: ``(new model, log-likelihood of the given model, rows)``."""
    return _msteps(df, [model], g or fit_grid(df, len(model.means[0]), col), mode, col)[0]


def _msteps(df: DataFrame, models: list, g: Grid, mode: str, col: str) -> list[tuple]:
    found = _run_pass(df, g, [(m.means, m.factors(), None) for m in models], col, mode)
    out = []
    for model, (nk, sx, second, ll, n) in zip(models, found):
        w, m, c = _mstep(nk, sx, second, model.means, n)
        out.append((GaussianMixtureModel([float(x) for x in w], [x.tolist() for x in m], [x.tolist() for x in c]), ll, n))
    return out


def em_init(
    df: DataFrame,
    k: int,
    init: str | list = "k-means++",
    seed: int = 42,
    power: float = 1.0,
    init_cov: str = "centered",
    col: str = "features",
    id_col: str = "id",
) -> GaussianMixtureModel:
    """Initial mixture from a hard nearest-seed assignment.

    Weight = class size / N, mean = class mean, covariance = centred class
    covariance / class size (``init_cov="second_moment"`` keeps the
    reference's uncentred ``X^T X / N``).
    """
    data = df.where(F.col(col).isNotNull())
    return _inits(data, [k], _seeds(data, [k], init, seed, power, col, id_col), init_cov, col)[0][0]


def _seeds(data, ks, init, seed, power, col, id_col) -> list[list[float]]:
    """Seeds of the largest k; those of a smaller one come first."""
    if isinstance(init, str):
        if init == "k-means++":
            _, seeds = kmeanspp_init(data, max(ks), seed, power, col, id_col)
        elif init == "first":
            _, seeds = first_k_seeds(data, max(ks), id_col, col)
        else:
            raise ValueError(f"unknown init {init!r}")
    else:
        seeds = [list(map(float, s)) for s in init]
        if len(seeds) != max(ks):
            raise ValueError("init must hold k means")
    return seeds


def _inits(data, ks, seeds, init_cov, col) -> tuple[list[GaussianMixtureModel], Grid]:
    """Initial mixtures of all ``ks`` in one scan and the grid."""
    dim = len(seeds[0])
    g = fit_grid(data, dim, col)
    centers = [np.asarray(seeds[:k]) if init_cov == "centered" else np.zeros((k, dim)) for k in ks]
    models = []
    for k, c, (nk, sx, second, _, n) in zip(ks, centers, _run_pass(data, g, [(c, None, seeds[: len(c)]) for c in centers], col)):
        means, covs = [], []
        for j in range(k):
            cnt = nk[j]
            mu = sx[j] / cnt if cnt > 0 else np.asarray(seeds[j])
            means.append(mu.tolist())
            if init_cov == "second_moment":
                covs.append((second[j] / n).tolist())
            else:
                delta = mu - c[j]
                cov = (second[j] / cnt - np.outer(delta, delta)) if cnt > 0 else np.zeros((dim, dim))
                covs.append((0.5 * (cov + cov.T)).tolist())
        models.append(GaussianMixtureModel([float(x / n) for x in nk], means, covs))
    return models, g


def em_settled(history: list[tuple[int, float, float, float]], tol: float) -> bool:
    """The stop rule over rows (iteration, shift, log-likelihood, its change)."""
    if not history:
        return False
    _, shift, _, gain = history[-1]
    two_back = history[-3][1] if len(history) > 2 else math.inf
    return shift <= tol or gain <= tol or abs(two_back - shift) <= tol


def em_fit(
    df: DataFrame,
    k: int,
    init: str | list | GaussianMixtureModel = "k-means++",
    seed: int = 42,
    power: float = 1.0,
    resp: str = "softmax",
    tol: float = EPSILON,
    max_iter: int | None = None,
    init_cov: str = "centered",
    col: str = "features",
    id_col: str = "id",
    persist: bool = True,
) -> GaussianMixtureModel:
    """EM until the summed mean shift or the log-likelihood change is <= ``tol``.

    Also stops when the shift is within ``tol`` of the shift two iterations
    back (oscillation guard).  There is no limit unless ``max_iter`` gives one;
    a fit that it ends has ``converged`` False.  Missing cells and densities that
    are not finite raise.  The log-likelihood of an iteration is that of the parameters
    it starts from.
    """
    return em_fit_many(df, [k], init, seed, power, resp, tol, max_iter, init_cov, col, id_col, persist)[0]


def em_fit_many(
    df: DataFrame,
    ks: list[int],
    init: str | list | GaussianMixtureModel = "k-means++",
    seed: int = 42,
    power: float = 1.0,
    resp: str = "softmax",
    tol: float = EPSILON,
    max_iter: int | None = None,
    init_cov: str = "centered",
    col: str = "features",
    id_col: str = "id",
    persist: bool = True,
) -> list[GaussianMixtureModel]:
    """The fits of all ``ks`` side by side: each scan is an EM step of every model that has not settled."""
    # rows without a feature vector cannot be assigned; impute NaN cells beforehand
    data = df.select(id_col, col).where(F.col(col).isNotNull())
    held: list[DataFrame] = []
    try:
        given = isinstance(init, GaussianMixtureModel)
        if persist:
            data = spread(data)
            if isinstance(init, str):
                held.append(data.persist(StorageLevel.MEMORY_AND_DISK))
        seeds = init.means if given else _seeds(data, ks, init, seed, power, col, id_col)
        if persist:
            data = packed(data, len(seeds[0]), col).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(data)
        models, g = ([init], fit_grid(data, len(seeds[0]), col)) if given else _inits(data, ks, seeds, init_cov, col)
        for one in held[:-1]:  # only the seeding needs rows; the grid's scan has packed them
            one.unpersist()
        histories: list[list[tuple[int, float, float, float]]] = [[] for _ in models]
        while going := [m for m, h in enumerate(histories) if not em_settled(h, tol) and (max_iter is None or len(h) < max_iter)]:
            for m, (new, ll, _) in zip(going, _msteps(data, [models[m] for m in going], g, resp, col)):
                h = histories[m]
                gain = abs(ll - h[-1][2]) if h else math.inf
                h.append((len(h) + 1, total_shift(models[m].means, new.means), ll, gain))
                models[m] = new
                if not (math.isfinite(h[-1][1]) and math.isfinite(ll)):
                    raise ValueError("parameters are not finite")
        for model, h in zip(models, histories):
            model.iterations, model.history = len(h), h
            model.log_likelihood = h[-1][2] if h else None
            model.converged = em_settled(h, tol)
        return models
    finally:
        for one in held:
            one.unpersist()


def em_steps(df: DataFrame, model: GaussianMixtureModel, steps: int, resp: str = "softmax", col: str = "features"):
    g = fit_grid(df, len(model.means[0]), col)
    for _ in range(steps):
        model, _, _ = em_mstep(df, model, resp, col, g)
    return model


def cluster_stats(df: DataFrame, dim: int, col: str = "features", cluster_col: str = "cluster") -> DataFrame:
    """Per class: size, weight (size / N), mean and population covariance (D x D, row by row), from exact co-moments."""
    found = sorted(group_co_moments(df, dim, cluster_col, col).items())
    n = sum(int(m.n[0, 0]) for _, m in found)
    rows = [(k, int(m.n[0, 0]), int(m.n[0, 0]) / n, m.mean.tolist(), m.covariance.tolist()) for k, m in found]
    return df.sparkSession.createDataFrame(rows, f"{cluster_col} int, n bigint, weight double, mean array<double>, cov array<array<double>>")


def log_likelihood(df: DataFrame, model: GaussianMixtureModel, col: str = "features") -> DataFrame:
    """One row: ``sum_i logsumexp_k l_ik`` of ``model`` over ``df`` (lazy; Arrow UDF + sum)."""
    return row_logsumexp(df, model, col).agg(F.sum("lse").alias("ll"), F.count(F.lit(1)).cast("bigint").alias("n"))
