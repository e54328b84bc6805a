"""DuckDB oracle SQL for the registered queries (brute force, no shared code).

Iterative operators (K-means steps, K-means++ seeding, EM steps) are unrolled
into CTE chains by small generators below; full fits are unrolled to a number of
passes that is above what they take, and the stop rule is found with window flags.
The 64 x 64 eigenvectors come from a recursive CTE of Jacobi rotations, 32
disjoint ones per step; Gaussian densities from a recursive CTE that eliminates
the covariance beside a unit matrix.
"""

from __future__ import annotations

from .inputs import LINEITEM_COLS, LINEITEM_ID_KEYS, LINEITEM_SEEDS, SEED, TEST_FRAC

E = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS f, CASE WHEN label = 1 THEN 1 ELSE 0 END AS label FROM embeddings"
D = 64


def U(step: int, idexpr: str = "vec_id") -> str:
    return f"((('0x' || substr(md5(concat_ws('|', {SEED}, {step}, {idexpr})), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)"


def R(x: str, d: int = 6) -> str:
    return f"(round(({x})::DOUBLE, {d}) + 0.0)"


def SIG9(x: str) -> str:
    e = f"floor(log10(abs({x})))"
    p = f"pow(10, abs({e}))"
    return (
        f"(CASE WHEN ({x}) = 0 THEN 0.0 WHEN {e} >= 0 THEN round(({x}) / {p}, 8) * {p} "
        f"ELSE round(({x}) * {p}, 8) / {p} END + 0.0)"
    )


def SIG6(x: str) -> str:
    """Six significant digits (differences of large numbers)."""
    e = f"floor(log10(abs({x})))"
    return f"(CASE WHEN ({x}) = 0 THEN 0.0 ELSE round(({x}) / pow(10, {e}), 5) * pow(10, {e}) END + 0.0)"


#: Fixed value of the reference stop rule.
TOL = 0.005


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def rec_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def unnest_cte(name: str, src: str) -> str:
    return f"{name} AS (SELECT vec_id, unnest(f) AS v, unnest(range(0, len(f))) AS pos FROM {src})"


def first_k(name: str, src: str, k: int) -> str:
    return (
        f"{name} AS (SELECT (row_number() OVER (ORDER BY vec_id) - 1)::INT AS cluster, f AS c FROM {src} "
        f"QUALIFY row_number() OVER (ORDER BY vec_id) <= {k})"
    )


def assign_cte(name: str, src: str, cents: str) -> str:
    """Nearest centroid, ties to the lowest cluster id; keeps features and label."""
    return (
        f"{name} AS (SELECT p.vec_id, p.f, p.label, q.cluster FROM {src} p, {cents} q "
        f"QUALIFY row_number() OVER (PARTITION BY p.vec_id ORDER BY list_distance(p.f, q.c), q.cluster) = 1)"
    )


def lloyd_ctes(prefix: str, src: str, cents0: str, steps: int) -> tuple[list[str], str]:
    """``steps`` Lloyd updates from centroid CTE ``cents0``; returns (ctes, final centroid CTE)."""
    ctes = [unnest_cte(f"{prefix}x", src)]
    cur = cents0
    for t in range(steps):
        a, m, n, c = f"{prefix}a{t}", f"{prefix}m{t}", f"{prefix}n{t}", f"{prefix}c{t + 1}"
        ctes.append(assign_cte(a, src, cur))
        ctes.append(
            f"{m} AS (SELECT a.cluster, x.pos, avg(x.v) AS mv FROM {prefix}x x JOIN {a} a ON x.vec_id = a.vec_id "
            f"GROUP BY a.cluster, x.pos)"
        )
        ctes.append(f"{n} AS (SELECT cluster, list(mv ORDER BY pos) AS c FROM {m} GROUP BY cluster)")
        ctes.append(f"{c} AS (SELECT o.cluster, coalesce(n.c, o.c) AS c FROM {cur} o LEFT JOIN {n} n ON o.cluster = n.cluster)")
        cur = c
    return ctes, cur


def kmeanspp_ctes(prefix: str, src: str, k: int, power: int = 1) -> tuple[list[str], str]:
    """Unrolled K-means++ seeding; returns (ctes, seed CTE with cluster, c, vec_id)."""
    w = (lambda d: d) if power == 1 else (lambda d: f"pow({d}, {power})")
    ctes = [f"{prefix}s0 AS (SELECT vec_id, f FROM {src} ORDER BY {U(0)}, vec_id LIMIT 1)"]
    for s in range(1, k):
        prev_d = f"{prefix}d{s - 1}"
        if s == 1:
            ctes.append(f"{prefix}d1 AS (SELECT e.vec_id, e.f, list_distance(e.f, q.f) AS dmin FROM {src} e, {prefix}s0 q)")
        else:
            ctes.append(
                f"{prefix}d{s} AS (SELECT d.vec_id, d.f, least(d.dmin, list_distance(d.f, q.f)) AS dmin "
                f"FROM {prev_d} d, {prefix}s{s - 1} q)"
            )
        ctes.append(
            f"{prefix}s{s} AS (SELECT vec_id, f FROM {prefix}d{s} WHERE {w('dmin')} > 0 "
            f"ORDER BY -ln({U(s)}) / {w('dmin')}, vec_id LIMIT 1)"
        )
    union = " UNION ALL ".join(f"SELECT {s} AS cluster, f AS c, vec_id FROM {prefix}s{s}" for s in range(k))
    ctes.append(f"{prefix}seeds AS ({union})")
    return ctes, f"{prefix}seeds"


def split_ctes(src: str) -> list[str]:
    return [
        f"sp_u AS (SELECT *, {U(0)} AS u FROM {src})",
        f"sp_n AS (SELECT floor(count(*) * {TEST_FRAC})::BIGINT AS n FROM {src})",
        "sp_r AS (SELECT *, row_number() OVER (ORDER BY u, vec_id) AS rn FROM sp_u)",
        "train AS (SELECT vec_id, f, label FROM sp_r WHERE rn > (SELECT n FROM sp_n))",
        "test AS (SELECT vec_id, f, label FROM sp_r WHERE rn <= (SELECT n FROM sp_n))",
    ]


# --- confusion / metrics --------------------------------------------------------


def counts_select(pred: str, label: str = "quality", src: str = "labels") -> str:
    eq = f"{label} = {pred}"
    ne = f"{label} <> {pred}"
    return (
        f"SELECT count(*) FILTER (WHERE {eq})::BIGINT AS correct, count(*) FILTER (WHERE {ne})::BIGINT AS incorrect, "
        f"count(*) FILTER (WHERE {eq} AND {label} <> 0)::BIGINT AS tp, count(*) FILTER (WHERE {eq} AND {label} = 0)::BIGINT AS tn, "
        f"count(*) FILTER (WHERE {ne} AND {label} <> 1)::BIGINT AS fp, count(*) FILTER (WHERE {ne} AND {label} = 1)::BIGINT AS fn "
        f"FROM {src}"
    )


def metrics_select(counts: str) -> str:
    """Unrounded metrics over a counts subquery/CTE name."""
    inf = "'inf'::DOUBLE"
    return (
        f"SELECT *, CASE WHEN ppv + tpr = 0 THEN {inf} ELSE 2 * ppv * tpr / (ppv + tpr) END AS f1 FROM ("
        f"SELECT *, CASE WHEN correct + incorrect = 0 THEN NULL ELSE 100.0 * correct / (correct + incorrect) END AS accuracy, "
        f"CASE WHEN tp + fn = 0 THEN {inf} ELSE 100.0 * tp / (tp + fn) END AS tpr, "
        f"CASE WHEN tp + fp = 0 THEN {inf} ELSE 100.0 * tp / (tp + fp) END AS ppv, "
        f"CASE WHEN tn + fp = 0 THEN {inf} ELSE 100.0 * tn / (tn + fp) END AS tnr FROM {counts})"
    )


MET = ["accuracy", "tpr", "ppv", "tnr", "f1"]


# --- Gaussian mixtures of any width, in long tables ------------------------------
# A mixture p is p_w(cluster, w), p_m(cluster, pos, m) and p_c(cluster, i, j, v); rows are x(vec_id, pos, v).


def long_rows(name: str, src: str) -> str:
    return f"{name} AS MATERIALIZED (SELECT vec_id, unnest(f) AS v, unnest(range(0, len(f))) AS pos FROM {src})"


def mixture_of(p: str, x: str, weighted: str) -> list[str]:
    """Weights, means and covariances of rows ``weighted``(vec_id, cluster, r)."""
    return [
        f"{p}_n AS MATERIALIZED (SELECT cluster, greatest(sum(r), 1e-10) AS nk FROM {weighted} GROUP BY cluster)",
        f"{p}_w AS MATERIALIZED (SELECT cluster, nk / (SELECT count(DISTINCT vec_id) FROM {x}) AS w FROM {p}_n)",
        f"{p}_m AS MATERIALIZED (SELECT g.cluster, x.pos, sum(g.r * x.v) / any_value(n.nk) AS m FROM {weighted} g "
        f"JOIN {x} x ON g.vec_id = x.vec_id JOIN {p}_n n ON n.cluster = g.cluster GROUP BY g.cluster, x.pos)",
        f"{p}_z AS MATERIALIZED (SELECT g.vec_id, g.cluster, x.pos, g.r, x.v - m.m AS z FROM {weighted} g JOIN {x} x ON g.vec_id = x.vec_id "
        f"JOIN {p}_m m ON m.cluster = g.cluster AND m.pos = x.pos)",
        f"{p}_c AS MATERIALIZED (SELECT a.cluster, a.pos AS i, b.pos AS j, sum(a.r * a.z * b.z) / any_value(n.nk) AS v FROM {p}_z a "
        f"JOIN {p}_z b ON a.vec_id = b.vec_id AND a.cluster = b.cluster JOIN {p}_n n ON n.cluster = a.cluster GROUP BY a.cluster, a.pos, b.pos)",
    ]


def eliminated(p: str, d: int) -> list[str]:
    """p_r(cluster, c, pos, l), p_d(cluster, c, d): covariance = L diag(d) L^T and p_r = L^-1, by elimination of [covariance | 1]."""
    return [
        f"""{p}_e(step, cluster, i, j, v) AS (
            SELECT 0, cluster, i::INT, j::INT, v FROM {p}_c
            UNION ALL SELECT 0, cluster, i::INT, (j + {d})::INT, CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0 END FROM {p}_c
            UNION ALL SELECT a.step + 1, a.cluster, a.i, a.j, a.v - f.v * q.v / o.v FROM {p}_e a
            JOIN {p}_e f ON f.cluster = a.cluster AND f.i = a.i AND f.j = a.step
            JOIN {p}_e q ON q.cluster = a.cluster AND q.i = a.step AND q.j = a.j
            JOIN {p}_e o ON o.cluster = a.cluster AND o.i = a.step AND o.j = a.step
            WHERE a.i > a.step AND a.j > a.step)""",
        f"{p}_r AS MATERIALIZED (SELECT cluster, i AS c, j - {d} AS pos, v AS l FROM {p}_e WHERE step = i AND j >= {d})",
        f"{p}_d AS MATERIALIZED (SELECT cluster, i AS c, v AS d FROM {p}_e WHERE step = i AND j = i)",
    ]


def densities(out: str, p: str, x: str, d: int) -> list[str]:
    """out(vec_id, cluster, l, lse): joint log densities of rows ``x`` under mixture ``p`` and their log-sum-exp."""
    return [
        f"{out}_y AS MATERIALIZED (SELECT x.vec_id, m.cluster, r.c, sum(r.l * (x.v - m.m)) AS y FROM {x} x JOIN {p}_m m ON m.pos = x.pos "
        f"JOIN {p}_r r ON r.cluster = m.cluster AND r.pos = x.pos GROUP BY x.vec_id, m.cluster, r.c)",
        f"{out}_l AS MATERIALIZED (SELECT y.vec_id, y.cluster, ln(any_value(w.w)) - 0.5 * ({d} * ln(2 * pi()) + sum(ln(o.d)) + sum(y.y * y.y / o.d)) AS l "
        f"FROM {out}_y y JOIN {p}_d o ON o.cluster = y.cluster AND o.c = y.c JOIN {p}_w w ON w.cluster = y.cluster GROUP BY y.vec_id, y.cluster)",
        f"{out} AS MATERIALIZED (SELECT vec_id, cluster, l, mx + ln(sum(exp(l - mx)) OVER (PARTITION BY vec_id)) AS lse "
        f"FROM (SELECT *, max(l) OVER (PARTITION BY vec_id) AS mx FROM {out}_l))",
    ]


def em_step(out: str, p: str, x: str, d: int) -> list[str]:
    """One EM step from mixture ``p`` (densities ``out``_j) to mixture ``out``."""
    return [
        *eliminated(p, d), *densities(f"{out}_j", p, x, d),
        f"{out}_g AS MATERIALIZED (SELECT vec_id, cluster, exp(l - lse) AS r FROM {out}_j)",
        *mixture_of(out, x, f"{out}_g"),
    ]


def em_start(prefix: str, src: str, k: int) -> list[str]:
    """K-means++ seeds, nearest-seed classes and the mixture ``prefix``p0 of them; rows ``prefix``x."""
    kc, seeds = kmeanspp_ctes(f"{prefix}pp", src, k)
    return [
        *kc, assign_cte(f"{prefix}ia", src, seeds), long_rows(f"{prefix}x", src),
        f"{prefix}ig AS MATERIALIZED (SELECT vec_id, cluster, 1.0::DOUBLE AS r FROM {prefix}ia)", *mixture_of(f"{prefix}p0", f"{prefix}x", f"{prefix}ig"),
    ]


def em_run(prefix: str, src: str, k: int, d: int, steps: int) -> list[str]:
    """``steps`` EM steps, the history under the stop rule (``prefix``h), the iterations (``prefix``it) and the last mixture ``prefix``fin."""
    ctes, hist = em_start(prefix, src, k), []
    for t in range(1, steps + 1):
        now, old = f"{prefix}p{t}", f"{prefix}p{t - 1}"
        ctes += em_step(now, old, f"{prefix}x", d)
        hist.append(
            f"SELECT {t} AS t, (SELECT sum(lse) FROM {now}_j WHERE cluster = 0) AS ll, (SELECT sum(s) FROM (SELECT sqrt(sum((a.m - b.m) * (a.m - b.m))) AS s "
            f"FROM {old}_m a JOIN {now}_m b ON a.cluster = b.cluster AND a.pos = b.pos GROUP BY a.cluster)) AS shift"
        )
    inf = "'inf'::DOUBLE"
    ctes += [
        f"{prefix}a AS MATERIALIZED ({' UNION ALL '.join(hist)})",
        f"{prefix}f AS (SELECT t, ll, shift, coalesce(abs(ll - lag(ll) OVER (ORDER BY t)), {inf}) AS llc, "
        f"abs(coalesce(lag(shift, 2) OVER (ORDER BY t), {inf}) - shift) <= {TOL} AS osc FROM {prefix}a)",
        f"{prefix}h AS MATERIALIZED (SELECT * FROM (SELECT *, coalesce(bool_or(shift <= {TOL} OR llc <= {TOL} OR osc) OVER (ORDER BY t ROWS BETWEEN "
        f"UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS stopped FROM {prefix}f) WHERE NOT stopped)",
        f"{prefix}it AS MATERIALIZED (SELECT max(t) AS n_iter FROM {prefix}h)",
    ]
    for part in ("w", "m", "c"):
        rows = " UNION ALL ".join(f"SELECT {t} AS t, * FROM {prefix}p{t}_{part}" for t in range(1, steps + 1))
        ctes.append(f"{prefix}fin_{part} AS MATERIALIZED (SELECT * EXCLUDE (t) FROM ({rows}) WHERE t = (SELECT n_iter FROM {prefix}it))")
    return ctes + eliminated(f"{prefix}fin", d)


def em_classes(out: str, p: str, x: str, d: int) -> list[str]:
    """out(vec_id, cluster): arg-max of the joint log density, ties to the lowest component."""
    return [
        *densities(f"{out}_j", p, x, d),
        f"{out} AS MATERIALIZED (SELECT vec_id, cluster FROM {out}_j QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY l DESC, cluster) = 1)",
    ]


def params_select(p: str, n: str = "") -> str:
    return (
        f"SELECT c.cluster, {n}c.i::BIGINT AS i, c.j::BIGINT AS j, {R('w.w')} AS weight, {R('m.m')} AS mean, {R('c.v')} AS cov FROM {p}_c c "
        f"JOIN {p}_w w ON w.cluster = c.cluster JOIN {p}_m m ON m.cluster = c.cluster AND m.pos = c.i"
    )


# --- eigenvectors of a D x D matrix by Jacobi rotations, D / 2 disjoint ones per step ----------------


def jacobi_wide(src: str, d: int, sweeps: int = 8) -> list[str]:
    """eig(k, lam) and vec(k, pos, v), largest first, of the symmetric matrix ``src``(i, j, v); d even.

    Step r of a sweep pairs the indices as a round-robin tournament does.
    """
    m = d - 1
    theta = "((q.v - a.v) / (2 * o.v))"
    return [
        f"seat AS MATERIALIZED (SELECT r, i, CASE WHEN i = {m} THEN r WHEN i = r THEN {m} ELSE (2 * r - i + {2 * m}) % {m} END AS p "
        f"FROM (SELECT unnest(range(0, {m}))::INT AS r), (SELECT unnest(range(0, {d}))::INT AS i))",
        f"""jac(step, kind, i, j, v) AS (
            SELECT 0, 0, i::INT, j::INT, v FROM {src}
            UNION ALL SELECT 0, 1, i::INT, j::INT, CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0 END FROM {src}
            UNION ALL (WITH rot AS MATERIALIZED (
                SELECT s.i, s.p, 1 / sqrt(t * t + 1) AS c, (CASE WHEN s.i < s.p THEN -t ELSE t END) / sqrt(t * t + 1) AS g FROM (
                    SELECT s.i, s.p, CASE WHEN o.v = 0 THEN 0.0 ELSE
                        (CASE WHEN {theta} >= 0 THEN 1.0 ELSE -1.0 END) / (abs({theta}) + sqrt({theta} * {theta} + 1)) END AS t
                    FROM seat s JOIN jac o ON o.kind = 0 AND o.i = least(s.i, s.p) AND o.j = greatest(s.i, s.p)
                    JOIN jac a ON a.kind = 0 AND a.i = least(s.i, s.p) AND a.j = a.i
                    JOIN jac q ON q.kind = 0 AND q.i = greatest(s.i, s.p) AND q.j = q.i
                    WHERE s.r = o.step % {m} AND o.step < {sweeps * m}
                      AND (SELECT max(abs(v)) FROM jac WHERE kind = 0 AND i <> j) > 1e-13) s)
            SELECT a.step + 1, 0, a.i, a.j, ri.c * rj.c * a.v + ri.g * rj.c * b.v + ri.c * rj.g * d.v + ri.g * rj.g * e.v
            FROM jac a JOIN rot ri ON ri.i = a.i JOIN rot rj ON rj.i = a.j
            JOIN jac b ON b.kind = 0 AND b.i = ri.p AND b.j = a.j JOIN jac d ON d.kind = 0 AND d.i = a.i AND d.j = rj.p
            JOIN jac e ON e.kind = 0 AND e.i = ri.p AND e.j = rj.p WHERE a.kind = 0
            UNION ALL SELECT a.step + 1, 1, a.i, a.j, rj.c * a.v + rj.g * d.v
            FROM jac a JOIN rot rj ON rj.i = a.j JOIN jac d ON d.kind = 1 AND d.i = a.i AND d.j = rj.p WHERE a.kind = 1))""",
        "done AS MATERIALIZED (SELECT * FROM jac WHERE step = (SELECT max(step) FROM jac))",
        "eig AS MATERIALIZED (SELECT row_number() OVER (ORDER BY v DESC) AS k, i, greatest(v, 0.0) AS lam FROM done WHERE kind = 0 AND i = j)",
        "vec AS MATERIALIZED (SELECT e.k, v.i AS pos, v.v FROM done v JOIN eig e ON v.kind = 1 AND v.j = e.i)",
    ]


def principal(src: str = "e") -> list[str]:
    """z(vec_id, pos, v), eig, vec and sv(k, sv, pct, cum) of the standardised rows of ``src``."""
    return [
        long_rows("xr", src),
        "z AS MATERIALIZED (SELECT vec_id, pos, CASE WHEN sd > 0 THEN (v - mu) / sd ELSE 0.0 END AS v FROM (SELECT *, avg(v) OVER (PARTITION BY pos) AS mu, "
        "stddev_pop(v) OVER (PARTITION BY pos) AS sd FROM xr))",
        "gm AS MATERIALIZED (SELECT a.pos AS i, b.pos AS j, avg(a.v * b.v) AS v FROM z a JOIN z b ON a.vec_id = b.vec_id GROUP BY a.pos, b.pos)",
        *jacobi_wide("gm", D),
        f"pv AS (SELECT k, sqrt((SELECT count(*) FROM {src}) * lam) AS sv, 100 * lam / sum(lam) OVER () AS pct FROM eig)",
        "sv AS (SELECT k, sv, pct, sum(pct) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM pv)",
    ]


def scores(k: int, src: str = "e") -> list[str]:
    """pr(vec_id, f, label): the rows of ``src`` on their first ``k`` principal components."""
    return [
        *principal(src),
        f"ps AS MATERIALIZED (SELECT z.vec_id, c.k, sum(z.v * c.v) AS y FROM z JOIN vec c ON c.pos = z.pos WHERE c.k <= {k} GROUP BY z.vec_id, c.k)",
        f"pr AS MATERIALIZED (SELECT p.vec_id, p.f, e.label FROM (SELECT vec_id, list(y ORDER BY k) AS f FROM ps GROUP BY vec_id) p JOIN {src} e ON e.vec_id = p.vec_id)",
    ]


# --- per-query SQL ---------------------------------------------------------------


def _seeds3() -> list[str]:
    return [f"e AS ({E})", first_k("s", "e", 3), assign_cte("a", "e", "s")]


def _dunn_from(a: str) -> str:
    return (
        f"SELECT min(d) FILTER (WHERE ca <> cb) AS min_inter, max(d) FILTER (WHERE ca = cb) AS max_intra FROM "
        f"(SELECT x.cluster AS ca, y.cluster AS cb, list_distance(x.f, y.f) AS d FROM {a} x JOIN {a} y ON x.vec_id < y.vec_id)"
    )


def _stats_cols_sql() -> dict[str, str]:
    out = {}
    # column statistics on lineitem
    out["column_stats"] = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {SIG9(f'avg({c})')} AS mean, {SIG9(f'stddev_pop({c})')} AS std, count({c})::BIGINT AS n FROM lineitem"
        for c in LINEITEM_COLS
    )
    zcols = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS z{i}" for i, c in enumerate(LINEITEM_COLS))
    parts = " UNION ALL ".join(
        f"SELECT l_linenumber::BIGINT AS l_linenumber, '{c}' AS \"column\", {R(f'avg(z{i})')} AS avg_z, {R(f'min(z{i})')} AS min_z, "
        f"{R(f'max(z{i})')} AS max_z FROM z GROUP BY l_linenumber"
        for i, c in enumerate(LINEITEM_COLS)
    )
    out["standardize_columns"] = with_(f"z AS (SELECT l_linenumber, {zcols} FROM lineitem)") + parts
    pairs = []
    for i, a in enumerate(LINEITEM_COLS):
        for j, b in enumerate(LINEITEM_COLS):
            x, y = (a, b) if i <= j else (b, a)
            pairs.append(f"SELECT '{a}' AS col_i, '{b}' AS col_j, {SIG9(f'covar_pop({x}, {y})')} AS cov FROM lineitem")
    out["covariance_narrow"] = " UNION ALL ".join(pairs)
    return out


def lse2(a: str, b: str) -> str:
    m = f"greatest({a}, {b})"
    return f"({m} + ln(exp({a} - {m}) + exp({b} - {m})))"


#: EM passes that the unrolled fits hold; the fits of the tables take 2 to 13.
EM_STEPS = 20


def _em_sql() -> dict[str, str]:
    out = {}
    init = [f"e AS ({E})", *em_start("", "e", 2)]
    out["em_init"] = rec_(*init) + params_select("p0")
    lj = [
        *init, *eliminated("p0", D), *densities("j", "p0", "x", D),
        "lj AS (SELECT vec_id, max(l) FILTER (WHERE cluster = 0) AS l0, max(l) FILTER (WHERE cluster = 1) AS l1, max(lse) AS lse FROM j GROUP BY vec_id)",
    ]
    out["gaussian_logpdf"] = rec_(*lj) + f"SELECT vec_id, {R('l0')} AS l0, {R('l1')} AS l1 FROM lj"
    out["logsumexp"] = rec_(*lj) + f"SELECT vec_id, {R('lse')} AS lse FROM lj"
    out["em_estep_softmax"] = rec_(*lj) + f"SELECT vec_id, {R('exp(l0 - lse)')} AS r0, {R('exp(l1 - lse)')} AS r1 FROM lj"
    seq = lj + [
        "q0 AS (SELECT vec_id, l0 - lse AS a0, l1 FROM lj)",
        f"q1 AS (SELECT vec_id, a0, l1 - {lse2('a0', 'l1')} AS a1 FROM q0)",
    ]
    out["em_estep_sequential"] = rec_(*seq) + f"SELECT vec_id, {R('exp(a0)')} AS r0, {R('exp(a1)')} AS r1 FROM q1"
    out["em_mstep"] = rec_(*init, *em_step("p1", "p0", "x", D)) + params_select("p1")
    ll = rec_(*lj) + f"SELECT {SIG9('sum(lse)')} AS ll, count(*)::BIGINT AS n FROM lj"
    out["log_likelihood"] = ll
    out["log_likelihood_rows"] = ll
    out["em_2iter"] = rec_(*init, *em_step("p1", "p0", "x", D), *em_step("p2", "p1", "x", D)) + params_select("p2")
    run = [f"e AS ({E})", *em_run("", "e", 2, D, EM_STEPS)]
    out["em_history"] = rec_(*run) + (
        f"SELECT t::BIGINT AS iteration, {R('shift')} AS total_shift, {SIG9('ll')} AS log_likelihood, {SIG9('llc')} AS ll_change FROM h"
    ).replace(SIG9("llc"), f"CASE WHEN isinf(llc) THEN llc ELSE {SIG6('llc')} END")
    out["em_full"] = rec_(*run, *em_classes("pc", "fin", "x", D)) + "SELECT vec_id, cluster::INT AS cluster FROM pc"
    held = [f"e AS ({E})", *split_ctes("e"), *em_run("", "train", 2, D, EM_STEPS), long_rows("tx", "test"), *em_classes("pc", "fin", "tx", D)]
    out["em_predict"] = rec_(*held) + "SELECT vec_id, cluster::INT AS cluster FROM pc"
    return out


def kmeans_run(prefix: str, src: str, seeds: str, passes: int) -> tuple[list[str], str]:
    """Lloyd passes from ``seeds`` to the stop rule; the CTE of the centroids after the last pass that runs."""
    lc, _ = lloyd_ctes(prefix, src, seeds, passes)
    prev = [seeds] + [f"{prefix}c{t}" for t in range(1, passes)]
    shifts = " UNION ALL ".join(
        f"SELECT {t} AS t, (SELECT sum(list_distance(a.c, b.c)) FROM {prev[t - 1]} a JOIN {prefix}c{t} b ON a.cluster = b.cluster) AS change"
        for t in range(1, passes + 1)
    )
    cents = " UNION ALL ".join(f"SELECT {t} AS t, cluster, c FROM {prefix}c{t}" for t in range(1, passes + 1))
    return lc + [
        f"{prefix}sh AS MATERIALIZED ({shifts})",
        f"{prefix}fl AS (SELECT t, change = lag(change, 1, 0.0) OVER (ORDER BY t) OR change <= {TOL} AS stop FROM {prefix}sh)",
        f"{prefix}ex AS (SELECT max(t) AS last FROM (SELECT t, coalesce(bool_or(stop) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED "
        f"PRECEDING AND 1 PRECEDING), false) AS stopped FROM {prefix}fl) WHERE NOT stopped)",
        f"{prefix}fin AS MATERIALIZED (SELECT cluster, c FROM ({cents}) WHERE t = (SELECT last FROM {prefix}ex))",
    ], f"{prefix}fin"


#: Lloyd passes that the unrolled fits of the embeddings hold; they take 5 to 25.
LLOYD_PASSES = 60


def _kmeans_report(base: list[str], src: str, init: str, ks=(2, 3)) -> str:
    """Per (k, split): K-means fitted on train to its stop rule, counts, metrics, distances."""
    ctes, selects = base + split_ctes(src), []
    for k in ks:
        p = f"k{k}_"
        if init == "first":
            ctes.append(first_k(f"{p}s", "train", k))
            seeds = f"{p}s"
        else:
            kc, seeds = kmeanspp_ctes(f"{p}pp", "train", k)
            ctes += kc
        lc, final = kmeans_run(p, "train", seeds, LLOYD_PASSES)
        ctes += lc
        for split in ("train", "test"):
            a = f"{p}{split}_a"
            ctes.append(assign_cte(a, split, final).replace(" AS (", " AS MATERIALIZED (", 1))
            ctes.append(f"{p}{split}_met AS ({metrics_select(f'({counts_select(CLUSTER, LABEL, a)})')})")
            ctes.append(f"{p}{split}_dn AS ({_dunn_from(a)})")
            selects.append(
                f"SELECT {k} AS k, '{split}' AS split, correct, incorrect, tp, tn, fp, fn, "
                + ", ".join(f"{R(c)} AS {c}" for c in MET)
                + f", {R('min_inter')} AS min_inter, {R('max_intra')} AS max_intra, {R('min_inter / max_intra')} AS dunn "
                f"FROM {p}{split}_met, {p}{split}_dn"
            )
    return rec_(*ctes) + " UNION ALL ".join(selects)


def _em_report(base: list[str], src: str, d: int, ks=(2, 3)) -> str:
    """Per (k, split): EM fitted on train to its stop rule, counts, metrics, Silhouette, iterations."""
    ctes, selects = base + split_ctes(src) + [long_rows("tex", "test")], []
    for k in ks:
        p = f"k{k}_"
        ctes += em_run(p, "train", k, d, EM_STEPS)
        for split, x in (("train", f"{p}x"), ("test", "tex")):
            a = f"{p}{split}_a"
            ctes += em_classes(f"{a}c", f"{p}fin", x, d)
            ctes.append(f"{a} AS MATERIALIZED (SELECT s.vec_id, s.f, s.label, c.cluster FROM {split} s JOIN {a}c c ON c.vec_id = s.vec_id)")
            ctes.append(f"{p}{split}_met AS ({metrics_select(f'({counts_select(CLUSTER, LABEL, a)})')})")
            ctes.append(f"{p}{split}_sil AS ({silhouette_from(a)})")
            selects.append(
                f"SELECT {k} AS k, '{split}' AS split, correct, incorrect, tp, tn, fp, fn, "
                + ", ".join(f"{R(c)} AS {c}" for c in MET)
                + f", {R('silhouette')} AS silhouette, {R(f'(SELECT n_iter FROM {p}it)')} AS iterations, "
                "CASE WHEN silhouette IS NULL THEN 'failed' ELSE 'ok' END AS status "
                f"FROM {p}{split}_met, {p}{split}_sil"
            )
    return rec_(*ctes) + " UNION ALL ".join(selects)


CLUSTER, LABEL = "cluster", "label"


# --- full fits with their stop rules (unrolled to max_iter, stop found with window flags) ----

KMEANS_MAX_ITER = 100


def _kmeans_fit_sql(k: int = 3, max_iter: int = KMEANS_MAX_ITER) -> str:
    """Lloyd history under the stop rule: pass t counts unless its shift equals the
    previous one (first compared with 0) or an earlier pass already moved <= tol."""
    kc, seeds = kmeanspp_ctes("pp", "e", k)
    lc, _ = lloyd_ctes("l", "e", seeds, max_iter)
    prev = [seeds] + [f"lc{t}" for t in range(1, max_iter)]
    shifts = " UNION ALL ".join(
        f"SELECT {t} AS t, (SELECT sum(list_distance(a.c, b.c)) FROM {prev[t - 1]} a JOIN lc{t} b ON a.cluster = b.cluster) AS change"
        for t in range(1, max_iter + 1)
    )
    return with_(
        f"e AS ({E})", *kc, *lc,
        f"sh AS ({shifts})",
        "fl AS (SELECT t, change, change = lag(change, 1, 0.0) OVER (ORDER BY t) AS eq, change <= "
        f"{TOL} AS small FROM sh)",
        "st AS (SELECT t, change, bool_or(eq) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS eq_upto, "
        "coalesce(bool_or(small) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS small_before FROM fl)",
    ) + f"SELECT t::BIGINT AS iteration, {R('change')} AS total_shift FROM st WHERE NOT eq_upto AND NOT small_before ORDER BY t"


def silhouette_from(a: str) -> str:
    """Mean Euclidean Silhouette of CTE ``a`` (vec_id, f, cluster); NULL unless 2 <= clusters <= N-1."""
    return (
        f"SELECT CASE WHEN k >= 2 AND k <= n - 1 THEN sil END AS silhouette FROM ("
        f"SELECT avg(s) AS sil, count(*) AS n, (SELECT count(DISTINCT cluster) FROM {a}) AS k FROM ("
        f"SELECT x.vec_id, CASE WHEN sz.sz = 1 THEN 0.0 WHEN greatest(coalesce(r.ai, 0), r.bi) = 0 THEN 0.0 "
        f"ELSE (r.bi - coalesce(r.ai, 0)) / greatest(coalesce(r.ai, 0), r.bi) END AS s FROM {a} x "
        f"JOIN (SELECT cluster, count(*) AS sz FROM {a} GROUP BY cluster) sz ON x.cluster = sz.cluster "
        f"LEFT JOIN (SELECT vec_id, max(md) FILTER (WHERE other = own) AS ai, min(md) FILTER (WHERE other <> own) AS bi FROM ("
        f"SELECT p.vec_id, p.cluster AS own, q.cluster AS other, avg(list_distance(p.f, q.f)) AS md FROM {a} p JOIN {a} q "
        f"ON p.vec_id <> q.vec_id GROUP BY p.vec_id, p.cluster, q.cluster) GROUP BY vec_id) r ON x.vec_id = r.vec_id))"
    )


# --- small-D Gaussian via Cholesky (lateral column aliases), used for lineitem ----------------


def _s(i: int, j: int) -> str:
    return f"s{min(i, j)}{max(i, j)}"


def chol_select(d: int) -> str:
    """Select-list computing Cholesky factor ``l{i}{j}`` and ``logdet`` from ``s{i}{j}`` (i <= j)."""
    out = []
    for j in range(d):
        acc = " - ".join([_s(j, j)] + [f"l{j}{k} * l{j}{k}" for k in range(j)])
        out.append(f"sqrt({acc}) AS l{j}{j}")
        for i in range(j + 1, d):
            acc = " - ".join([_s(i, j)] + [f"l{i}{k} * l{j}{k}" for k in range(j)])
            out.append(f"({acc}) / l{j}{j} AS l{i}{j}")
    out.append("2 * (" + " + ".join(f"ln(l{j}{j})" for j in range(d)) + ") AS logdet")
    return ", ".join(out)


def maha_select(d: int, x: str = "e.f", p: str = "p") -> str:
    """Forward substitution ``y = L^-1 (x - m)``; returns select-list ending with ``maha``."""
    out = []
    for i in range(d):
        acc = " - ".join([f"({x}[{i + 1}] - {p}.m{i})"] + [f"{p}.l{i}{k} * y{k}" for k in range(i)])
        out.append(f"({acc}) / {p}.l{i}{i} AS y{i}")
    out.append(" + ".join(f"y{i} * y{i}" for i in range(d)) + " AS maha")
    return ", ".join(out)


def gauss_params_ctes(name: str, d: int, body: str) -> list[str]:
    """``body`` yields cluster, w, m0..m{d-1}, s{i}{j}; adds the Cholesky columns."""
    return [f"{name}_raw AS MATERIALIZED ({body})", f"{name} AS MATERIALIZED (SELECT *, {chol_select(d)} FROM {name}_raw)"]


def gauss_step_ctes(out: str, params: str, src: str, d: int) -> list[str]:
    """One EM step (softmax) for rows ``src(rid, f)``; new params named ``out``."""
    lj = (
        f"SELECT e.rid, e.f, p.cluster, {maha_select(d)}, "
        f"ln(p.w) - 0.5 * ({d} * ln(2 * pi()) + p.logdet + maha) AS l FROM {src} e, {params} p"
    )
    means = ", ".join(f"sum(r * f[{i + 1}]) / greatest(sum(r), 1e-10) AS m{i}" for i in range(d))
    covs = ", ".join(
        f"sum(g.r * (g.f[{i + 1}] - m.m{i}) * (g.f[{j + 1}] - m.m{j})) / m.nk AS s{i}{j}" for i in range(d) for j in range(i, d)
    )
    mcols = ", ".join(f"m.m{i}" for i in range(d))
    body = (
        f"SELECT g.cluster, m.nk / (SELECT count(*) FROM {src}) AS w, {mcols}, {covs} FROM {out}_r g JOIN "
        f"(SELECT cluster, greatest(sum(r), 1e-10) AS nk, {means} FROM {out}_r GROUP BY cluster) m ON g.cluster = m.cluster "
        f"GROUP BY g.cluster, m.nk, {mcols}"
    )
    return [
        f"{out}_l AS MATERIALIZED ({lj})",
        f"{out}_r AS MATERIALIZED (SELECT rid, f, cluster, lse, exp(l - lse) AS r FROM (SELECT *, mx + ln(sum(exp(l - mx)) "
        f"OVER (PARTITION BY rid)) AS lse FROM (SELECT *, max(l) OVER (PARTITION BY rid) AS mx FROM {out}_l)))",
    ] + gauss_params_ctes(out, d, body)


def _lineitem_em_sql(steps: int = 40) -> str:
    d = len(LINEITEM_COLS)
    zl = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()" for c in LINEITEM_COLS)
    seeds_vals = ", ".join(f"({i}, [{', '.join(repr(float(v)) for v in s_)}]::DOUBLE[])" for i, s_ in enumerate(LINEITEM_SEEDS))
    means = ", ".join(f"avg(f[{i + 1}]) AS m{i}" for i in range(d))
    covs = ", ".join(f"covar_pop(f[{i + 1}], f[{j + 1}]) AS s{i}{j}" for i in range(d) for j in range(i, d))
    ctes = [
        f"z AS MATERIALIZED (SELECT row_number() OVER () AS rid, [{zl}] AS f FROM lineitem)",
        f"sd AS (SELECT * FROM (VALUES {seeds_vals}) t(cluster, c))",
        "ia AS MATERIALIZED (SELECT z.rid, z.f, sd.cluster FROM z, sd "
        "QUALIFY row_number() OVER (PARTITION BY z.rid ORDER BY list_distance(z.f, sd.c), sd.cluster) = 1)",
    ]
    ctes += gauss_params_ctes("q0", d, f"SELECT cluster, count(*)::DOUBLE / (SELECT count(*) FROM z) AS w, {means}, {covs} FROM ia GROUP BY cluster")
    prev = "q0"
    for t in range(1, steps + 1):
        ctes += gauss_step_ctes(f"q{t}", prev, "z", d)
        prev = f"q{t}"
    gap = " + ".join(f"(a.m{i} - b.m{i}) * (a.m{i} - b.m{i})" for i in range(d))
    hist = " UNION ALL ".join(
        f"SELECT {t} AS t, (SELECT sum(lse) FROM q{t}_r WHERE cluster = 0) AS ll, "
        f"(SELECT sum(sqrt({gap})) FROM q{t - 1} a JOIN q{t} b ON a.cluster = b.cluster) AS shift"
        for t in range(1, steps + 1)
    )
    inf = "'inf'::DOUBLE"
    ctes += [
        f"hs AS MATERIALIZED ({hist})",
        f"fl AS (SELECT t, shift, coalesce(abs(ll - lag(ll) OVER (ORDER BY t)), {inf}) AS llc, "
        f"abs(coalesce(lag(shift, 2) OVER (ORDER BY t), {inf}) - shift) <= {TOL} AS osc FROM hs)",
        f"it AS (SELECT max(t) AS t FROM (SELECT t, coalesce(bool_or(shift <= {TOL} OR llc <= {TOL} OR osc) OVER (ORDER BY t ROWS BETWEEN "
        "UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS stopped FROM fl) WHERE NOT stopped)",
        "fin AS MATERIALIZED (SELECT * EXCLUDE (t) FROM (" + " UNION ALL ".join(f"SELECT {t} AS t, * FROM q{t}" for t in range(1, steps + 1))
        + ") WHERE t = (SELECT t FROM it))",
        f"pr AS (SELECT e.rid, p.cluster, {maha_select(d)}, ln(p.w) - 0.5 * ({d} * ln(2 * pi()) + p.logdet + maha) AS l "
        "FROM z e, fin p QUALIFY row_number() OVER (PARTITION BY e.rid ORDER BY l DESC, p.cluster) = 1)",
    ]
    return with_(*ctes) + "SELECT cluster::INT AS cluster, count(*)::BIGINT AS n FROM pr GROUP BY cluster"


def _lineitem_kmeans_sql(k: int = 3, max_iter: int = 45) -> str:
    """K-means++ + Lloyd on z-scored lineitem to the stop rule; rows per final cluster.

    The final centroids are those of the last executed pass (an uncounted
    equal-shift pass still replaces them)."""
    parts = [f"{c}::BIGINT" for c in LINEITEM_ID_KEYS] + [f"round(100 * {c})::BIGINT" for c in LINEITEM_COLS]
    rid = f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 13))::BIGINT"
    zl = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()" for c in LINEITEM_COLS)
    kc, seeds = kmeanspp_ctes("pp", "z", k)
    lc, _ = lloyd_ctes("l", "z", seeds, max_iter)
    prev = [seeds] + [f"lc{t}" for t in range(1, max_iter)]
    shifts = " UNION ALL ".join(
        f"SELECT {t} AS t, (SELECT sum(list_distance(a.c, b.c)) FROM {prev[t - 1]} a JOIN lc{t} b ON a.cluster = b.cluster) AS change"
        for t in range(1, max_iter + 1)
    )
    cents = " UNION ALL ".join(f"SELECT {t} AS t, cluster, c FROM lc{t}" for t in range(1, max_iter + 1))
    return with_(
        f"z AS MATERIALIZED (SELECT {rid} AS vec_id, [{zl}] AS f, 0 AS label FROM lineitem)",
        *kc, *lc,
        f"sh AS MATERIALIZED ({shifts})",
        f"fl AS (SELECT t, change = lag(change, 1, 0.0) OVER (ORDER BY t) OR change <= {TOL} AS stop FROM sh)",
        "ex AS (SELECT max(t) AS last FROM (SELECT t, coalesce(bool_or(stop) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED "
        "PRECEDING AND 1 PRECEDING), false) AS stopped FROM fl) WHERE NOT stopped)",
        f"fin AS MATERIALIZED (SELECT cluster, c FROM ({cents}) WHERE t = (SELECT last FROM ex))",
        assign_cte("fa", "z", "fin"),
    ) + "SELECT cluster::INT AS cluster, count(*)::BIGINT AS n FROM fa GROUP BY cluster"


# --- small symmetric eigenvalues by cyclic Jacobi rotations (one CTE per rotation) ---------


def _a(i: int, j: int) -> str:
    return f"a{min(i, j)}{max(i, j)}"


def jacobi_ctes(src: str, d: int, sweeps: int = 10) -> tuple[list[str], str]:
    """Eigenvalues of the symmetric matrix in one-row CTE ``src`` (columns a{i}{j}, i <= j)."""
    ctes, prev, n = [], src, 0
    cols = [_a(i, j) for i in range(d) for j in range(i, d)]
    for _ in range(sweeps):
        for p in range(d):
            for q in range(p + 1, d):
                n += 1
                apq, app, aqq = _a(p, q), _a(p, p), _a(q, q)
                theta = f"({aqq} - {app}) / (2 * {apq})"
                t = (f"CASE WHEN {apq} = 0 THEN 0.0 ELSE (CASE WHEN {theta} >= 0 THEN 1.0 ELSE -1.0 END) / "
                     f"(abs({theta}) + sqrt({theta} * {theta} + 1)) END")
                new = {app: f"{app} - t * {apq}", aqq: f"{aqq} + t * {apq}", apq: "0.0"}
                for r in range(d):
                    if r in (p, q):
                        continue
                    new[_a(r, p)] = f"c * {_a(r, p)} - s * {_a(r, q)}"
                    new[_a(r, q)] = f"s * {_a(r, p)} + c * {_a(r, q)}"
                sel = ", ".join(f"{new.get(c, c)} AS {c}" for c in cols)
                ctes.append(
                    f"jr{n} AS MATERIALIZED (SELECT {sel} FROM (SELECT *, t * c AS s FROM (SELECT *, 1 / sqrt(t * t + 1) AS c FROM "
                    f"(SELECT *, {t} AS t FROM {prev}))))"
                )
                prev = f"jr{n}"
    return ctes, prev


def _lineitem_svd_sql() -> str:
    d = len(LINEITEM_COLS)
    corr = ", ".join(
        (f"1.0::DOUBLE AS {_a(i, j)}" if i == j else f"corr({LINEITEM_COLS[i]}, {LINEITEM_COLS[j]}) AS {_a(i, j)}")
        for i in range(d) for j in range(i, d)
    )
    jc, fin = jacobi_ctes("cm", d)
    diag = " UNION ALL ".join(f"SELECT {_a(i, i)} AS lam FROM {fin}" for i in range(d))
    return with_(
        f"cm AS MATERIALIZED (SELECT {corr} FROM lineitem)",
        *jc,
        f"ev AS (SELECT row_number() OVER (ORDER BY lam DESC) AS k, greatest(lam, 0.0) AS lam FROM ({diag}))",
        "nn AS (SELECT count(*) AS n FROM lineitem)",
        "pv AS (SELECT k, sqrt((SELECT n FROM nn) * lam) AS sv, 100 * lam / sum(lam) OVER () AS pct FROM ev)",
    ) + (
        f"SELECT k::BIGINT AS k, {R('sv')} AS singular_value, {R('pct')} AS pct_variance, "
        f"{R('sum(pct) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS cum_pct FROM pv"
    )


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["matrix_shape"] = "SELECT count(*)::BIGINT AS n_rows, max(len(embedding))::BIGINT AS n_dims FROM embeddings"
    q["binarize_label"] = "SELECT vec_id, label AS label_raw, CASE WHEN label = 1 THEN 1 ELSE 0 END AS label FROM embeddings"
    q["with_row_id"] = "SELECT vec_id, (row_number() OVER (ORDER BY vec_id) - 1)::BIGINT AS row_id FROM embeddings"
    q["explode_columns"] = (
        "SELECT vec_id AS id, " + ", ".join(f'CAST(embedding[{i + 1}] AS DOUBLE) AS "{i}"' for i in range(64)) + ", "
        "CASE WHEN label = 1 THEN 1 ELSE 0 END AS label FROM embeddings"
    )
    cells = ", ".join(f"printf('%.4f', f[{i + 1}]) AS \"{i}\"" for i in range(64))
    q["matrix_text"] = with_(f"e AS ({E})") + (
        f"SELECT vec_id AS id, {cells}, label FROM e"
    )
    q["matrix_parse"] = with_(f"e AS ({E})", unnest_cte("x", "e")) + (
        "SELECT x.vec_id, x.pos::BIGINT AS pos, CASE WHEN (x.vec_id + x.pos) % 7 = 0 THEN NULL "
        "ELSE printf('%.4f', x.v)::DOUBLE END AS v, e.label FROM x JOIN e ON x.vec_id = e.vec_id"
    )
    q["plot_frame"] = with_(*_seeds3()) + "SELECT vec_id, cluster, f[1] AS pc1, f[2] AS pc2, f[3] AS pc3 FROM a"

    nan = [
        f"e AS ({E})",
        unnest_cte("x", "e"),
        "n AS (SELECT vec_id, pos, CASE WHEN (vec_id + pos) % 7 = 0 THEN 'NaN'::DOUBLE ELSE v END AS v FROM x)",
    ]
    q["column_means_nan"] = with_(*nan) + (
        f"SELECT pos::BIGINT AS pos, {R('avg(CASE WHEN isnan(v) THEN NULL ELSE v END)')} AS mean, "
        "count(CASE WHEN isnan(v) THEN NULL ELSE v END)::BIGINT AS n FROM n GROUP BY pos"
    )
    q["impute_mean"] = with_(
        *nan,
        "m AS (SELECT pos, avg(CASE WHEN isnan(v) THEN NULL ELSE v END) AS mean FROM n GROUP BY pos)",
        "c AS (SELECT vec_id, count(*) FILTER (WHERE isnan(v)) AS n_imputed FROM n GROUP BY vec_id)",
    ) + (
        f"SELECT n.vec_id, n.pos::BIGINT AS pos, {R('CASE WHEN isnan(n.v) THEN m.mean ELSE n.v END')} AS value, "
        "c.n_imputed::BIGINT AS n_imputed FROM n JOIN m ON n.pos = m.pos JOIN c ON n.vec_id = c.vec_id"
    )
    q.update(_stats_cols_sql())
    q["standardize_array"] = with_(f"e AS ({E})", unnest_cte("x", "e")) + (
        "SELECT vec_id, pos::BIGINT AS pos, "
        + R(
            "CASE WHEN stddev_pop(v) OVER (PARTITION BY pos) > 0 THEN (v - avg(v) OVER (PARTITION BY pos)) / "
            "stddev_pop(v) OVER (PARTITION BY pos) ELSE 0 END"
        )
        + " AS z FROM x"
    )
    q["covariance_wide"] = with_(
        "x AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS v, unnest(range(0, 64)) AS pos FROM embeddings)"
    ) + (
        f"SELECT a.pos::BIGINT AS i, b.pos::BIGINT AS j, {SIG9('covar_pop(a.v, b.v)')} AS cov "
        "FROM x a JOIN x b ON a.vec_id = b.vec_id GROUP BY a.pos, b.pos"
    )
    q["svd_trace"] = with_(
        f"e AS ({E})", unnest_cte("x", "e"), "s AS (SELECT pos, stddev_pop(v) AS sd FROM x GROUP BY pos)",
        "nn AS (SELECT count(*) AS n FROM e)",
    ) + (
        "SELECT (SELECT n FROM nn)::BIGINT AS n, count(*) FILTER (WHERE sd > 0)::BIGINT AS d, "
        + R("(SELECT n FROM nn) * count(*) FILTER (WHERE sd > 0)", 4)
        + " AS sum_s2 FROM s"
    )
    pc = rec_(f"e AS ({E})", *principal())
    q["singular_values"] = pc + f"SELECT k::BIGINT AS k, {R('sv')} AS singular_value FROM sv"
    q["explained_variance"] = pc + (
        f"SELECT k::BIGINT AS k, {R('sv')} AS singular_value, {R('pct')} AS pct_variance, {R('cum')} AS cum_pct FROM sv"
    )
    q["svd_wide"] = q["explained_variance"]
    norm = f"{R('sqrt(list_sum([y * y FOR y IN f]))')} AS pc_norm"
    q["project_k"] = rec_(f"e AS ({E})", *scores(1)) + f"SELECT vec_id, {R('abs(f[1])')} AS pc1_abs FROM pr"
    q["project_wide"] = rec_(f"e AS ({E})", *scores(40)) + f"SELECT vec_id, {norm}, {R('abs(f[1])')} AS pc1_abs FROM pr"
    q["prepare"] = rec_(f"e AS ({E})", *scores(40), *split_ctes("pr")) + (
        f"SELECT vec_id, CASE WHEN rn <= (SELECT n FROM sp_n) THEN 'test' ELSE 'train' END AS split, {norm} FROM sp_r"
    )
    q["kmeans_projected"] = _kmeans_report([f"e AS ({E})", *scores(40)], "pr", "k-means++")
    q["em_projected"] = _em_report([f"e AS ({E})", *scores(40)], "pr", 40)

    q["vector_text"] = pc + " UNION ALL ".join(
        f"SELECT '{name}' AS name, k::BIGINT AS k, printf('%.4f', {c}) AS line FROM sv" for name, c in (("singular_value", "sv"), ("pct_variance", "pct"))
    )
    q["matrix_round_trip"] = with_(f"e AS ({E})", unnest_cte("x", "e")) + (
        "SELECT x.vec_id, x.pos::BIGINT AS pos, printf('%.4f', x.v)::DOUBLE AS v, e.label FROM x JOIN e ON x.vec_id = e.vec_id"
    )
    q["number_text_ids"] = with_(
        "n AS (SELECT 'X' || (vec_id % 97) || '.V1.' AS name, CAST(embedding[1] AS DOUBLE) AS x FROM embeddings)",
        "d AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS id FROM (SELECT DISTINCT name FROM n))",
    ) + f"SELECT d.id::BIGINT AS name_id, count(*)::BIGINT AS n, {R('avg(x)')} AS mean0 FROM n JOIN d ON n.name = d.name GROUP BY d.id"
    numbered = ", ".join(f'f[{i + 1}] AS "{i}"' for i in range(D))
    q["clusters_text"] = with_(*_seeds3()) + f"SELECT cluster, {numbered} FROM a"
    q["em_clusters_text"] = rec_(f"e AS ({E})", *em_run("", "e", 2, D, EM_STEPS), *em_classes("pc", "fin", "x", D)) + (
        f"SELECT pc.cluster::INT AS cluster, e.vec_id AS id, {numbered} FROM e JOIN pc ON pc.vec_id = e.vec_id"
    )
    q["row_id_repeated"] = (
        "SELECT l_returnflag, (sum(n) OVER (ORDER BY l_returnflag) - n)::BIGINT AS first_id, (sum(n) OVER (ORDER BY l_returnflag) - 1)::BIGINT AS last_id, "
        "n::BIGINT AS n FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag)"
    )
    q["split_repeated_ids"] = (
        f"SELECT 'test' AS split, floor(count(*) * {TEST_FRAC})::BIGINT AS n FROM labels UNION ALL "
        f"SELECT 'train' AS split, (count(*) - floor(count(*) * {TEST_FRAC}))::BIGINT AS n FROM labels"
    )
    kc, seeds = kmeanspp_ctes("pp", "e", 12)
    q["kmeanspp_many"] = with_(f"e AS ({E})", *kc) + f"SELECT cluster, vec_id FROM {seeds}"
    q["em_init_second_moment"] = rec_(
        f"e AS ({E})", *em_start("", "e", 2),
        "s_c AS MATERIALIZED (SELECT g.cluster, a.pos AS i, b.pos AS j, sum(a.v * b.v) / (SELECT count(*) FROM e) AS v FROM ig g "
        "JOIN x a ON a.vec_id = g.vec_id JOIN x b ON b.vec_id = g.vec_id GROUP BY g.cluster, a.pos, b.pos)",
    ) + params_select("p0").replace("FROM p0_c c", "FROM s_c c")
    q["evaluate_em_failed"] = _em_report([f"e AS ({E})"], "e", D, ks=(1,))
    q["split_exact"] = with_(f"e AS ({E})", *split_ctes("e")) + (
        "SELECT vec_id, CASE WHEN rn <= (SELECT n FROM sp_n) THEN 'test' ELSE 'train' END AS split FROM sp_r"
    )
    q["split_text"] = with_(f"e AS ({E})", *split_ctes("e")) + (
        f"SELECT e.vec_id AS id, {cells}, e.label, "
        "CASE WHEN rn <= (SELECT n FROM sp_n) THEN 'test' ELSE 'train' END AS split FROM e JOIN (SELECT vec_id, rn FROM sp_r) r ON e.vec_id = r.vec_id"
    )
    q["uniform_pick"] = f"SELECT vec_id, {U(0)} AS u FROM embeddings ORDER BY u, vec_id LIMIT 1"
    q["weighted_pick"] = with_(
        f"e AS ({E})",
        "s AS (SELECT f AS c FROM e QUALIFY row_number() OVER (ORDER BY vec_id) <= 2)",
        "d AS (SELECT e.vec_id, min(list_distance(e.f, s.c)) AS dmin FROM e, s GROUP BY e.vec_id)",
        f"p1 AS (SELECT 1::BIGINT AS power, vec_id FROM d WHERE dmin > 0 ORDER BY -ln({U(1)}) / dmin, vec_id LIMIT 1)",
        f"p2 AS (SELECT 2::BIGINT AS power, vec_id FROM d WHERE dmin * dmin > 0 ORDER BY -ln({U(1)}) / (dmin * dmin), vec_id LIMIT 1)",
    ) + "SELECT * FROM p1 UNION ALL SELECT * FROM p2"
    kc, seeds = kmeanspp_ctes("pp", "e", 3)
    q["kmeanspp_init"] = with_(f"e AS ({E})", *kc) + f"SELECT cluster, vec_id FROM {seeds}"

    q["pairwise_distance"] = with_(
        f"e AS ({E})",
        "p AS (SELECT a.vec_id, b.vec_id AS other, list_distance(a.f, b.f) AS d FROM e a JOIN e b ON a.vec_id <> b.vec_id)",
        "n AS (SELECT vec_id, other AS nearest_id, d AS nearest_dist FROM p QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, other) = 1)",
        "g AS (SELECT vec_id, max(d) AS farthest_dist, avg(d) AS mean_dist FROM p GROUP BY vec_id)",
    ) + (
        f"SELECT n.vec_id, n.nearest_id, {R('n.nearest_dist')} AS nearest_dist, {R('g.farthest_dist')} AS farthest_dist, "
        f"{R('g.mean_dist')} AS mean_dist FROM n JOIN g ON n.vec_id = g.vec_id"
    )
    q["assign_nearest"] = with_(*_seeds3()) + "SELECT vec_id, cluster FROM a"
    q["cluster_means"] = with_(
        *_seeds3(), unnest_cte("x", "e"), "cnt AS (SELECT cluster, count(*)::BIGINT AS n FROM a GROUP BY cluster)"
    ) + (
        f"SELECT a.cluster, cnt.n, x.pos::BIGINT AS pos, {R('avg(x.v)')} AS mean FROM x JOIN a ON x.vec_id = a.vec_id "
        "JOIN cnt ON a.cluster = cnt.cluster GROUP BY a.cluster, cnt.n, x.pos"
    )
    q["cluster_stats"] = with_(
        f"e AS ({E})", first_k("s", "e", 2), assign_cte("a", "e", "s"), long_rows("x", "e"),
        "g AS MATERIALIZED (SELECT vec_id, cluster, 1.0::DOUBLE AS r FROM a)", *mixture_of("p", "x", "g"),
    ) + params_select("p", "(SELECT count(*) FROM g WHERE g.cluster = c.cluster)::BIGINT AS n, ")
    lc, c1 = lloyd_ctes("l", "e", "s", 1)
    q["centroid_shift"] = with_(
        f"e AS ({E})", first_k("s", "e", 3), *lc,
        f"sh AS (SELECT s.cluster, list_distance(s.c, n.c) AS shift FROM s JOIN {c1} n ON s.cluster = n.cluster)",
    ) + f"SELECT cluster, {R('shift')} AS shift, {R('sum(shift) OVER ()')} AS total_shift FROM sh"
    lc, c3 = lloyd_ctes("l", "e", "s", 3)
    q["kmeans_3iter"] = with_(f"e AS ({E})", first_k("s", "e", 3), *lc, assign_cte("fin", "e", c3)) + "SELECT vec_id, cluster FROM fin"
    lc, final = kmeans_run("l", "train", "s", LLOYD_PASSES)
    q["kmeans_predict"] = with_(f"e AS ({E})", *split_ctes("e"), first_k("s", "train", 3), *lc, assign_cte("res", "test", final)) + (
        "SELECT vec_id, cluster FROM res"
    )
    seeds_vals = ", ".join(f"({i}, [{', '.join(repr(float(v)) for v in s)}]::DOUBLE[])" for i, s in enumerate(LINEITEM_SEEDS))
    zl = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()" for c in LINEITEM_COLS)
    q["lineitem_assign"] = with_(
        f"z AS (SELECT row_number() OVER () AS rid, [{zl}] AS f FROM lineitem)",
        f"s AS (SELECT * FROM (VALUES {seeds_vals}) t(cluster, c))",
        "a AS (SELECT z.rid, s.cluster, list_distance(z.f, s.c) AS d FROM z, s "
        "QUALIFY row_number() OVER (PARTITION BY z.rid ORDER BY list_distance(z.f, s.c), s.cluster) = 1)",
    ) + f"SELECT cluster::INT AS cluster, count(*)::BIGINT AS n, {R('avg(d)')} AS mean_dist FROM a GROUP BY cluster"
    dn = with_(*_seeds3(), f"dd AS ({_dunn_from('a')})")
    q["min_intercluster"] = dn + f"SELECT {R('min_inter')} AS min_inter FROM dd"
    q["max_intracluster"] = dn + f"SELECT {R('max_intra')} AS max_intra FROM dd"
    q["dunn_index"] = dn + (
        f"SELECT {R('min_inter')} AS min_inter, {R('max_intra')} AS max_intra, {R('min_inter / max_intra')} AS dunn FROM dd"
    )
    q["silhouette"] = with_(
        *_seeds3(),
        "p AS (SELECT x.vec_id, x.cluster AS own, y.cluster AS other, list_distance(x.f, y.f) AS d FROM a x JOIN a y ON x.vec_id <> y.vec_id)",
        "m AS (SELECT vec_id, own, other, avg(d) AS md FROM p GROUP BY vec_id, own, other)",
        "sz AS (SELECT cluster, count(*) AS sz FROM a GROUP BY cluster)",
        "r AS (SELECT vec_id, max(md) FILTER (WHERE other = own) AS ai, min(md) FILTER (WHERE other <> own) AS bi FROM m GROUP BY vec_id)",
        "sv AS (SELECT a.vec_id, CASE WHEN sz.sz = 1 THEN 0.0 WHEN greatest(coalesce(r.ai, 0), r.bi) = 0 THEN 0.0 "
        "ELSE (r.bi - coalesce(r.ai, 0)) / greatest(coalesce(r.ai, 0), r.bi) END AS s FROM a JOIN sz ON a.cluster = sz.cluster "
        "LEFT JOIN r ON a.vec_id = r.vec_id)",
        "nc AS (SELECT count(*) AS k FROM sz)",
    ) + (
        f"SELECT CASE WHEN (SELECT k FROM nc) >= 2 AND (SELECT k FROM nc) <= count(*) - 1 THEN {R('avg(s)')} END AS silhouette, "
        "(SELECT k FROM nc)::BIGINT AS n_clusters FROM sv"
    )
    q["confusion"] = counts_select("toxic")
    cases = " UNION ALL ".join(
        f"SELECT '{name}' AS \"case\", * FROM ({counts_select(pred)})"
        for name, pred in (("toxic", "toxic"), ("all_one", "1"), ("inverted", "1 - quality"))
    )
    q["classification_metrics"] = with_(f"c AS ({cases})", f"m AS ({metrics_select('c')})") + (
        "SELECT \"case\", correct, incorrect, tp, tn, fp, fn, " + ", ".join(f"{R(c)} AS {c}" for c in MET) + " FROM m"
    )
    rows = [
        ("Accuracy", "pct", "accuracy"), ("True Positives", "int", "tp"), ("True Negatives", "int", "tn"),
        ("False Positives", "int", "fp"), ("False Negatives", "int", "fn"),
        ("True Positive Rate (sensitivity)", "pct", "tpr"), ("Positive Prediction Value (precision)", "pct", "ppv"),
        ("True Negative Rate (specificity)", "pct", "tnr"), ("F1 Score", "pct", "f1"),
    ]
    rep = " UNION ALL ".join(
        f"SELECT {i}::BIGINT AS pos, '{name}' AS metric, "
        + (f"printf('%.2f', round({c}, 2)) || '%'" if kind == "pct" else f"CAST({c} AS VARCHAR)")
        + " AS value FROM m"
        for i, (name, kind, c) in enumerate(rows)
    )
    q["metrics_report"] = with_(f"c AS ({counts_select('toxic')})", f"m AS ({metrics_select('c')})") + rep
    q.update(_em_sql())
    q["evaluate_k"] = _kmeans_report([f"e AS ({E})"], "e", "first")
    q["kmeans_fit"] = _kmeans_fit_sql()
    q["evaluate_em"] = _em_report([f"e AS ({E})"], "e", D)
    q["lineitem_em"] = _lineitem_em_sql()
    q["lineitem_kmeans"] = _lineitem_kmeans_sql()
    q["lineitem_svd"] = _lineitem_svd_sql()
    return q


ORACLES: dict[str, str] = build()
