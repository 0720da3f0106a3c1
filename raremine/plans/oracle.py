"""SQL twins (DuckDB dialect) of the registered queries.

They are written independently of the Spark code (different formulations where
natural) and serve as the correctness oracle.  Floats are rounded to the same
number of places on both sides.
"""

from __future__ import annotations

from raremine.plans.standins import NUMERIC, PERSON_CLEAN_SQL, with_ctes

SEED = 42


def det_round_sql(sql: str) -> str:
    """Rewrite every ``round(x, d)`` into floor(x * 10^d + 0.5) / 10^d, the
    same IEEE arithmetic as the Spark side (built-in rounding differs between
    engines on half-way cases)."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 6, None
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        inner = det_round_sql(sql[j + 6:comma])
        digits = int(sql[comma + 1:k].strip())
        out.append(sql[i:j])
        x, scale = f"CAST({inner} AS DOUBLE)", f"CAST(1e{digits} AS DOUBLE)"
        out.append(f"(CASE WHEN abs({x}) * {scale} < 4503599627370496.0"
                   f" THEN floor({x} * {scale} + CAST(0.5 AS DOUBLE)) / {scale} ELSE {x} END)")
        i = k + 1


def r6(expr: str, alias: str, digits: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) AS {alias}"


def person_data_cte(features=NUMERIC, name: str = "data", drop_total: bool = True,
                    all_zero_filter: bool = True) -> str:
    """featureFormat(['poi', *features]) of the cleaned stand-in (nulls -> 0,
    all-zero rows dropped), label as DOUBLE."""
    sel = ", ".join(f"coalesce({f}, 0.0) AS {f}" for f in features)
    where = ["id <> 'TOTAL'"] if drop_total else []
    if all_zero_filter:
        where.append("(" + " OR ".join(f"coalesce({f}, 0.0) <> 0" for f in features) + ")")
    w = (" WHERE " + " AND ".join(where)) if where else ""
    return f"{name} AS (SELECT id, CAST(poi AS DOUBLE) AS label, {sel} FROM person_clean{w})"


def strat_split_ctes(folds: int, test_size: float = 0.1, seed: int = SEED, src: str = "data",
                     out: str = "test") -> list[str]:
    """Stratified shuffle split: class sizes by largest remainder, md5 order."""
    return [
        f"cc AS (SELECT label, count(*) AS n FROM {src} GROUP BY label)",
        f"""sz1 AS (SELECT label, n, CAST(ceil({test_size} * sum(n) OVER ()) AS BIGINT) AS nt,
                   sum(n) OVER () AS ntot FROM cc)""",
        """sz2 AS (SELECT label, nt, nt * n / ntot AS ex, floor(nt * n / ntot) AS fl FROM sz1)""",
        """sz AS (SELECT label, CAST(fl + CASE WHEN row_number() OVER (ORDER BY ex - fl DESC, label)
                   <= nt - sum(fl) OVER () THEN 1 ELSE 0 END AS BIGINT) AS k FROM sz2)""",
        f"folds AS (SELECT range AS fold FROM range({folds}))",
        f"""rk AS (SELECT f.fold, d.*, row_number() OVER (PARTITION BY f.fold, d.label
                   ORDER BY md5(concat_ws('|', '{seed}', CAST(f.fold AS VARCHAR), d.id)), d.id) AS rn
                   FROM {src} d CROSS JOIN folds f)""",
        f"{out} AS (SELECT rk.* EXCLUDE (rn) FROM rk JOIN sz USING (label) WHERE rn <= sz.k)",
    ]


def gnb_fold_pred_ctes(features, src: str = "data", test: str = "test", out: str = "pred") -> list[str]:
    p = range(len(features))
    g_sel = ", ".join(f"avg({f}) AS m{j}, var_pop({f}) AS v{j}" for j, f in enumerate(features))
    t_sel = ", ".join(f"sum(t.{f} - g.m{j}) AS s{j}, sum(pow(t.{f} - g.m{j}, 2)) AS q{j}"
                      for j, f in enumerate(features))
    g_cols = ", ".join(["g.n"] + [f"g.m{j}, g.v{j}" for j in p])
    tr_sel = ", ".join(
        f"m{j} - coalesce(s{j}, 0) / nullif(n - tn, 0) AS mu{j}, "
        f"greatest((n * v{j} - coalesce(q{j}, 0)) / nullif(n - tn, 0) "
        f"- pow(coalesce(s{j}, 0) / nullif(n - tn, 0), 2), 0) AS var{j}" for j in p)
    varall = [f"sum(ntr * (var{j} + pow(mu{j}, 2))) / sum(ntr) - pow(sum(ntr * mu{j}) / sum(ntr), 2)"
              for j in p]
    eps = f"1e-9 * greatest({', '.join(varall)})" if len(varall) > 1 else f"1e-9 * ({varall[0]})"
    const = " + ".join(f"ln(2 * pi() * (tr.var{j} + fe.eps))" for j in p)
    quad = " + ".join(f"pow(t.{f} - tr.mu{j}, 2) / (tr.var{j} + fe.eps)" for j, f in enumerate(features))
    return [
        f"g AS (SELECT label AS cls, count(*) AS n, {g_sel} FROM {src} GROUP BY label)",
        f"""tstat AS (SELECT f.fold, g.cls, {g_cols}, count(t.id) AS tn, {t_sel}
              FROM folds f CROSS JOIN g LEFT JOIN {test} t ON t.fold = f.fold AND t.label = g.cls
              GROUP BY f.fold, g.cls, {g_cols})""",
        f"tr AS (SELECT fold, cls, n - tn AS ntr, {tr_sel} FROM tstat)",
        f"fe AS (SELECT fold, sum(ntr) AS ntot, {eps} AS eps FROM tr GROUP BY fold)",
        f"""sc AS (SELECT t.fold, t.id, t.label, tr.cls,
              ln(tr.ntr / fe.ntot) - 0.5 * ({const}) - 0.5 * ({quad}) AS jll
              FROM {test} t JOIN tr ON tr.fold = t.fold JOIN fe ON fe.fold = t.fold WHERE tr.ntr > 0)""",
        f"""{out} AS (SELECT fold, id, label, cls AS prediction FROM (
              SELECT *, row_number() OVER (PARTITION BY fold, id ORDER BY jll DESC, cls) AS r FROM sc)
              WHERE r = 1)""",
    ]


def counts_metrics_select(src: str = "pred") -> str:
    return f"""
SELECT CAST(total AS BIGINT) AS total, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
       {r6('(tp + tn) / total', 'accuracy')},
       {r6('tp / nullif(tp + fp, 0)', 'precision')},
       {r6('tp / nullif(tp + fn, 0)', 'recall')},
       {r6('2 * tp / nullif(2 * tp + fp + fn, 0)', 'f1')},
       {r6('5 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0)) / nullif(4 * (tp / nullif(tp + fp, 0)) + tp / nullif(tp + fn, 0), 0)', 'f2')}
FROM (SELECT count(*) AS total,
             count(*) FILTER (WHERE prediction = 1 AND label = 1) AS tp,
             count(*) FILTER (WHERE prediction = 1 AND label = 0) AS fp,
             count(*) FILTER (WHERE prediction = 0 AND label = 1) AS fn,
             count(*) FILTER (WHERE prediction = 0 AND label = 0) AS tn
      FROM {src} WHERE prediction IN (0, 1))"""


def sql_eval_shuffle_cv(folds: int = 1000) -> str:
    ctes = [PERSON_CLEAN_SQL, person_data_cte()] + strat_split_ctes(folds) + gnb_fold_pred_ctes(NUMERIC)
    return with_ctes(*ctes) + counts_metrics_select("pred")


PERSON_DATA = PERSON_CLEAN_SQL + ",\n" + person_data_cte()

LO = "CAST(0.0001 AS DOUBLE)"


def _minmax(c: str) -> str:
    span = f"coalesce(nullif(max({c}) OVER () - min({c}) OVER (), 0), 1)"
    return f"{LO} + ({c} - min({c}) OVER ()) / {span} * (CAST(1.0 AS DOUBLE) - {LO}) AS {c}"


def minmax_cte(src: str, cols, keep=("id", "poi"), out: str = "scaled") -> str:
    return f"{out} AS (SELECT {', '.join(keep)}, {', '.join(_minmax(c) for c in cols)} FROM {src})"


MINMAX_SQL = minmax_cte("train", NUMERIC + ["email_address_code"])


def inter_order(columns) -> list[str]:
    """Interaction names pair by pair, written for the twins on their own."""
    out = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            if i <= j:
                out.append(a + "*" + b)
            if i < j:
                out.append(a + "+" + b)
            if i != j:
                out += [a + "/" + b, a + "-" + b]
    return out


def inter_sql(name: str) -> str:
    """SQL of an interaction column name 'a*b', 'a+b', 'a/b', 'a-b'."""
    for op in ("*", "+", "/", "-"):
        if op in name:
            a, b = name.split(op, 1)
            if op == "/":
                return f"({a} / nullif({b}, 0))"
            return f"({a} {op} {b})"
    raise ValueError(name)


def kfold_sql(src: str, label: str, k: int, out: str, seed: int = SEED) -> str:
    return (f"{out} AS (SELECT *, (row_number() OVER (PARTITION BY {label} ORDER BY "
            f"md5(concat_ws('|', '{seed}', id)), id) - 1) % {k} AS kfold FROM {src})")


def long_sql(src: str, cols, label: str | None = None, key: str | None = None) -> str:
    parts = []
    for c in cols:
        extra = (f", {label} AS label" if label else "") + (f", {key} AS id" if key else "")
        parts.append(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x{extra} FROM {src}")
    return " UNION ALL ".join(parts)


def anova_sql(src: str, cols, label: str, out: str) -> str:
    return (f"{out}_l AS ({long_sql(src, cols, label)}),\n"
            f"{out}_g AS (SELECT feature, label, count(*) AS n, avg(x) AS m, var_pop(x) AS v "
            f"FROM {out}_l GROUP BY feature, label),\n"
            f"{out}_t AS (SELECT feature, sum(n) AS nn, count(*) AS k, sum(n * m) / sum(n) AS mm, "
            f"sum(n * v) AS ssw FROM {out}_g GROUP BY feature),\n"
            f"{out} AS (SELECT g.feature, (sum(g.n * pow(g.m - t.mm, 2)) / nullif(t.k - 1, 0)) / "
            f"nullif(t.ssw / nullif(t.nn - t.k, 0), 0) AS f FROM {out}_g g JOIN {out}_t t USING (feature) "
            f"GROUP BY g.feature, t.k, t.ssw, t.nn)")


def outlier_sql(src: str, cols, how_far: float, worst_th: int, out: str) -> list[str]:
    qs = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{j}, quantile_cont({c}, 0.75) AS q3_{j}"
                   for j, c in enumerate(cols))
    hf = f"CAST({how_far} AS DOUBLE)"
    flags = " + ".join(
        f"CASE WHEN {c} >= q1_{j} - (q3_{j} - q1_{j}) * {hf} AND {c} <= q3_{j} + (q3_{j} - q1_{j}) * {hf} "
        f"THEN 0 ELSE 1 END" for j, c in enumerate(cols))
    return [f"{out}_q AS (SELECT {qs} FROM {src})",
            f"{out}_f AS (SELECT id, CAST({flags} AS INTEGER) AS n_flags FROM {src}, {out}_q)",
            f"{out} AS (SELECT id, n_flags FROM {out}_f WHERE n_flags >= 1 AND n_flags > "
            f"(SELECT max(n_flags) FROM {out}_f WHERE n_flags >= 1) - {worst_th})"]


def spearman_sql(src: str, cols, out: str) -> list[str]:
    return [f"{out}_l AS ({long_sql(src, cols, key='id')})",
            f"{out}_r AS (SELECT id, feature, rank() OVER (PARTITION BY feature ORDER BY x) + "
            f"(count(*) OVER (PARTITION BY feature, x) - 1) / CAST(2 AS DOUBLE) AS r FROM {out}_l)",
            f"{out} AS (SELECT a.feature AS f1, b.feature AS f2, CASE WHEN a.feature = b.feature THEN 1.0 "
            f"ELSE corr(a.r, b.r) END AS rho FROM {out}_r a JOIN {out}_r b ON a.id = b.id GROUP BY a.feature, b.feature)"]
