"""Hypothesis tests T-1..T-10 and their nine instances."""

from __future__ import annotations

from pyspark.sql import functions as F

from saldora.catalog.questions_queries import AGE_BAND_SQL, AGE_GROUP_SQL, RECENCY_SQL, YES, profile
from saldora.catalog.registry import Book
from saldora.catalog.roles import track_a, track_b, track_b_secondary
from saldora.catalog.roles_sql import A, B, B2, r, with_roles
from saldora.functions.expr import age_band, age_group, recency_band, round_to
from saldora.functions.metrics import adopted
from saldora.operators import stats as st

BOOK = Book()
add = BOOK.add


def _rounded(df, **digits):
    return df.withColumns({c: round_to(c, n) for c, n in digits.items()})


def _chi(df, a, b, correction=True):
    out = st.chi_square(df, a, b, correction).drop("p")
    return _rounded(out, statistic=6, cramers_v=8)


def _chi_sql(ctes, a, b, frame, yates=False):
    term = "greatest(abs(o - e) - 0.5, 0)" if yates else "(o - e)"
    return with_roles(ctes, f"""
      , obs AS (SELECT {a} AS a, {b} AS b FROM {frame} WHERE ({a}) IS NOT NULL AND ({b}) IS NOT NULL),
      ra AS (SELECT a, count(*)::DOUBLE AS ra FROM obs GROUP BY 1),
      cb AS (SELECT b, count(*)::DOUBLE AS cb FROM obs GROUP BY 1),
      nn AS (SELECT count(*)::DOUBLE AS n FROM obs),
      cell AS (SELECT a, b, count(*)::DOUBLE AS o FROM obs GROUP BY 1, 2),
      grid AS (SELECT coalesce(o, 0) AS o, ra * cb / n AS e
               FROM ra CROSS JOIN cb CROSS JOIN nn LEFT JOIN cell ON cell.a = ra.a AND cell.b = cb.b),
      res AS (SELECT sum({term} * {term} / e) AS s, (SELECT count(*) FROM ra) AS rr, (SELECT count(*) FROM cb) AS cc FROM grid)
      SELECT {r('s', 6)} AS statistic, ((rr - 1) * (cc - 1))::BIGINT AS dof, n::BIGINT AS n,
        {r('sqrt(s / (n * (least(rr, cc) - 1)))', 8)} AS cramers_v FROM res, nn""")


def _u(df, value, group, positive):
    out = st.mann_whitney(df, value, group, positive).drop("p")
    return _rounded(out, rank_biserial=8, z=6)


def _u_sql(ctes, value, one, frame):
    return with_roles(ctes, f"""
      , x AS (SELECT {value} AS v, ({one}) AS one FROM {frame}),
      mid AS (SELECT v, one, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk FROM x),
      t AS (SELECT sum(rk) FILTER (one) AS r1, count(*) FILTER (one)::DOUBLE AS a, count(*) FILTER (NOT one)::DOUBLE AS b FROM mid),
      tie AS (SELECT sum(c * c * c - c) AS ties FROM (SELECT count(*)::DOUBLE AS c FROM x GROUP BY v)),
      w AS (SELECT r1 - a * (a + 1) / 2 AS u, a, b,
        sqrt(a * b / 12 * ((a + b + 1) - ties / ((a + b) * (a + b - 1)))) AS sd FROM t, tie)
      SELECT u::DOUBLE AS u, a::BIGINT AS n1, b::BIGINT AS n2, {r('1 - 2 * u / (a * b)', 8)} AS rank_biserial,
        {r('(greatest(u, a * b - u) - a * b / 2 - 0.5) / sd', 6)} AS z FROM w""")


add("t1_mann_whitney_balance_churn", lambda s, d: _u(track_a(s, d), "current_balance", "churn", 1),
    _u_sql(A, "current_balance", "churn = 1", "a"))
add("t2_chi_square_age_group", lambda s, d: _chi(track_a(s, d), age_group(), "churn"),
    _chi_sql(A, AGE_GROUP_SQL, "churn", "a"))
add("t3_chi_square_tier", lambda s, d: _chi(track_a(s, d), "customer_nw_category", "churn"),
    _chi_sql(A, "customer_nw_category", "churn", "a"))
add("t4_chi_square_recency", lambda s, d: _chi(profile(s, d), recency_band(), "churn"),
    _chi_sql(A, RECENCY_SQL, "churn", "a"))
add("t5_chi_square_prior_contact", lambda s, d: _chi(track_b(s, d), "previous_contact_flag", "y"),
    _chi_sql(B, "previous_contact_flag", "y", "b", yates=True))
add("t5_chi_square_uncorrected", lambda s, d: _chi(track_b(s, d), "previous_contact_flag", "y", correction=False),
    _chi_sql(B, "previous_contact_flag", "y", "b"))
add("t6_chi_square_prior_outcome", lambda s, d: _chi(track_b(s, d), "poutcome", "y"), _chi_sql(B, "poutcome", "y", "b"))
add("t7_chi_square_job", lambda s, d: _chi(track_b(s, d), "job", "y"), _chi_sql(B, "job", "y", "b"))
add("t8_chi_square_age_band", lambda s, d: _chi(track_b(s, d), age_band(), "y"), _chi_sql(B, AGE_BAND_SQL, "y", "b"))
add("t8_mann_whitney_age", lambda s, d: _u(track_b(s, d), "age", "y", "yes"), _u_sql(B, "age", "y = 'yes'", "b"))
add("t9_mann_whitney_balance_adoption", lambda s, d: _u(track_b_secondary(s, d), "balance", "y", "yes"),
    _u_sql(B2, "balance", "y = 'yes'", "b2"))


# ------------------------------------------------ the operators by their own name


def t_1_p(s, d):
    """Chi-square with p for even degrees of freedom, where the tail is elementary."""
    parts = [
        st.chi_square(track_a(s, d), "customer_nw_category", "churn").select(F.lit("tier").alias("analysis"), "dof", "statistic", "p"),
        st.chi_square(profile(s, d), recency_band(), "churn").select(F.lit("recency").alias("analysis"), "dof", "statistic", "p"),
    ]
    return _rounded(parts[0].unionByName(parts[1]), statistic=6, p=8)


def _p_sql():
    def part(label, expr, terms):
        tail = "exp(-s / 2) * (" + " + ".join(["1", "s / 2"][:terms]) + ")"
        return f"""SELECT '{label}' AS analysis, {2 * terms}::BIGINT AS dof, {r('s', 6)} AS statistic, {r(tail, 8)} AS p FROM (
          SELECT sum((coalesce(o, 0) - e) * (coalesce(o, 0) - e) / e) AS s FROM (
            SELECT ra.a, cb.b, ra.n * cb.n / (SELECT count(*)::DOUBLE FROM a) AS e FROM
              (SELECT {expr} AS a, count(*)::DOUBLE AS n FROM a GROUP BY 1) ra CROSS JOIN
              (SELECT churn AS b, count(*)::DOUBLE AS n FROM a GROUP BY 1) cb) g
          LEFT JOIN (SELECT {expr} AS a, churn AS b, count(*)::DOUBLE AS o FROM a GROUP BY 1, 2) c ON c.a = g.a AND c.b = g.b)"""
    return with_roles(A, part("tier", "customer_nw_category", 1) + "\nUNION ALL " + part("recency", RECENCY_SQL, 2))


add("t_1_chi_square_p", t_1_p, _p_sql())
add("t_2_cramers_v", lambda s, d: _chi(track_b(s, d), "education", "y").select("cramers_v", "n"),
    f"SELECT cramers_v, n FROM ({_chi_sql(B, 'education', 'y', 'b')})")
add("t_3_mann_whitney_vintage", lambda s, d: _u(track_a(s, d), "vintage", "churn", 1).select("u", "n1", "n2"),
    f"SELECT u, n1, n2 FROM ({_u_sql(A, 'vintage', 'churn = 1', 'a')})")
def _erfc_sql(x):
    """The series and the continued fraction of the expression, as folds over 60 terms."""
    terms = "CAST(list_reverse(range(1, 61)) AS DOUBLE[])"
    return f"""CASE WHEN {x} < 2 THEN
      1 - 2 / sqrt(pi()) * {x} * exp(-({x}) * ({x})) * list_reduce(list_concat([1.0::DOUBLE], {terms}), lambda t, n: 1 + 2 * ({x}) * ({x}) / (2 * n + 1) * t)
      ELSE exp(-({x}) * ({x})) / (sqrt(pi()) * list_reduce(list_concat([({x})::DOUBLE], {terms}), lambda t, n: ({x}) + (n / 2) / t)) END"""


def _chi_p_sql(s, dof):
    even = f"list_sum(list_transform(range(0, {dof} // 2), lambda i: exp(i * ln({s} / 2) - lgamma(i + 1) - {s} / 2)))"
    odd = f"""({_erfc_sql(f'sqrt({s} / 2)')}) + coalesce(list_sum(list_transform(range(1, ({dof} - 1) // 2 + 1),
      lambda i: exp((i - 0.5) * ln({s} / 2) - lgamma(i + 0.5) - {s} / 2))), 0)"""
    return f"least(1, CASE WHEN {dof} % 2 = 0 THEN {even} ELSE {odd} END)"


_U_P_SQL = f"least(1, {_erfc_sql('greatest(z, 0) / sqrt(2)')})"
add("t_4_mann_whitney_p",
    lambda s, d: _rounded(st.mann_whitney(track_a(s, d), "vintage", "churn", 1).select("z", "p"), z=6, p=6),
    f"SELECT z, {r(_U_P_SQL, 6)} AS p FROM ({_u_sql(A, 'vintage', 'churn = 1', 'a')})")
add("t_5_rank_biserial", lambda s, d: _u(track_b(s, d), "euribor3m", "y", "yes").select("rank_biserial"),
    f"SELECT rank_biserial FROM ({_u_sql(B, 'round(euribor3m * 1000)', chr(121) + ' = ' + chr(39) + 'yes' + chr(39), 'b')})")
add("t_6_median_difference",
    lambda s, d: _rounded(st.median_by_group(track_a(s, d), "current_balance", "churn", 1), m1=4, m2=4, diff=4),
    with_roles(A, f"""SELECT {r('m1', 4)} AS m1, {r('m2', 4)} AS m2, {r('m1 - m2', 4)} AS diff FROM (
      SELECT median(current_balance) FILTER (churn = 1) AS m1, median(current_balance) FILTER (churn = 0) AS m2 FROM a)"""))
add("t_6_median_difference_secondary",
    lambda s, d: _rounded(st.median_by_group(track_b_secondary(s, d), "balance", "y", "yes"), m1=4, m2=4, diff=4),
    with_roles(B2, f"""SELECT {r('m1', 4)} AS m1, {r('m2', 4)} AS m2, {r('m1 - m2', 4)} AS diff FROM (
      SELECT median(balance) FILTER (y = 'yes') AS m1, median(balance) FILTER (y = 'no') AS m2 FROM b2)"""))
add("t_7_bootstrap_median_difference", lambda s, d: st.median_diff(track_a(s, d), "current_balance", "churn", 1))
add("t_8_two_proportions",
    lambda s, d: _rounded(st.two_proportion(track_b(s, d), "previous_contact_flag", adopted()), p1=8, p2=8, diff=8, lo=8, hi=8),
    with_roles(B, f"""
      , t AS (SELECT avg({YES}) FILTER (previous_contact_flag) AS p1, avg({YES}) FILTER (NOT previous_contact_flag) AS p2,
        count(*) FILTER (previous_contact_flag) AS n1, count(*) FILTER (NOT previous_contact_flag) AS n2 FROM b),
      u AS (SELECT *, p1 - p2 AS d, 1.959964::DOUBLE * sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2) AS w FROM t)
      SELECT {r('p1', 8)} AS p1, {r('p2', 8)} AS p2, n1, n2, {r('d', 8)} AS diff, {r('d - w', 8)} AS lo, {r('d + w', 8)} AS hi FROM u"""))


def t_9(s, d):
    """The published summary: one row per analysis with effect size, interval and p."""
    a, ap, b, b2 = track_a(s, d), profile(s, d), track_b(s, d), track_b_secondary(s, d)
    flag, y = "previous_contact_flag", "y"
    share = st.two_proportion(b, flag, adopted())
    contact = st.chi_row("T5", st.chi_square(b, flag, y)).drop("ci_low", "ci_high").withColumns(
        {"ci_low": share.select("lo").scalar(), "ci_high": share.select("hi").scalar()})
    return st.test_summary([
        st.rank_row("T1", st.mann_whitney(a, "current_balance", "churn", 1), st.median_diff(a, "current_balance", "churn", 1)),
        st.chi_row("T2", st.chi_square(a, age_group(), "churn")),
        st.chi_row("T3", st.chi_square(a, "customer_nw_category", "churn")),
        st.chi_row("T4", st.chi_square(ap, recency_band(), "churn")),
        contact,
        st.chi_row("T6", st.chi_square(b, "poutcome", y)),
        st.chi_row("T7", st.chi_square(b, "job", y)),
        st.chi_row("T8", st.chi_square(b, age_band(), y)),
        st.rank_row("T9", st.mann_whitney(b2, "balance", y, "yes"), st.median_diff(b2, "balance", y, "yes")),
    ])


add("t_9_test_summary", t_9)


def t_9_p(s, d):
    """Statistic, effect size and p of all nine analyses."""
    a, ap, b, b2 = track_a(s, d), profile(s, d), track_b(s, d), track_b_secondary(s, d)
    chi = {
        "T2": st.chi_square(a, age_group(), "churn"), "T3": st.chi_square(a, "customer_nw_category", "churn"),
        "T4": st.chi_square(ap, recency_band(), "churn"), "T5": st.chi_square(b, "previous_contact_flag", "y"),
        "T6": st.chi_square(b, "poutcome", "y"), "T7": st.chi_square(b, "job", "y"), "T8": st.chi_square(b, age_band(), "y"),
    }
    rank = {"T1": st.mann_whitney(a, "current_balance", "churn", 1), "T9": st.mann_whitney(b2, "balance", "y", "yes")}
    rows = [st.chi_row(n, t) for n, t in chi.items()] + [st.rank_row(n, t) for n, t in rank.items()]
    return _rounded(st.test_summary(rows).select("analysis", "statistic", "effect_size", "p", "effect_label"), statistic=4, effect_size=6, p=6)


def _t_9_p_sql():
    chi = {
        "T2": _chi_sql(A, AGE_GROUP_SQL, "churn", "a"), "T3": _chi_sql(A, "customer_nw_category", "churn", "a"),
        "T4": _chi_sql(A, RECENCY_SQL, "churn", "a"), "T5": _chi_sql(B, "previous_contact_flag", "y", "b", yates=True),
        "T6": _chi_sql(B, "poutcome", "y", "b"), "T7": _chi_sql(B, "job", "y", "b"), "T8": _chi_sql(B, AGE_BAND_SQL, "y", "b"),
    }
    rank = {"T1": _u_sql(A, "current_balance", "churn = 1", "a"), "T9": _u_sql(B2, "balance", "y = 'yes'", "b2")}
    parts = [f"SELECT '{n}' AS analysis, statistic, cramers_v AS e, {_chi_p_sql('statistic', 'dof')} AS p FROM ({q})" for n, q in chi.items()]
    parts += [f"SELECT '{n}', u, rank_biserial, {_U_P_SQL} FROM ({q})" for n, q in rank.items()]
    return f"""SELECT analysis, {r('statistic', 4)} AS statistic, {r('e', 6)} AS effect_size, {r('p', 6)} AS p,
      CASE WHEN abs(e) < 0.1 THEN 'negligible' WHEN abs(e) < 0.3 THEN 'small' WHEN abs(e) < 0.5 THEN 'moderate' ELSE 'large' END AS effect_label
      FROM ({' UNION ALL '.join(parts)})"""


add("t_9_p_values", t_9_p, _t_9_p_sql())
add("t_10_effect_label",
    lambda s, d: st.chi_square(track_b(s, d), "poutcome", "y").select(st.effect_label("cramers_v").alias("effect_label")),
    f"""SELECT CASE WHEN cramers_v < 0.1 THEN 'negligible' WHEN cramers_v < 0.3 THEN 'small'
      WHEN cramers_v < 0.5 THEN 'moderate' ELSE 'large' END AS effect_label FROM ({_chi_sql(B, 'poutcome', 'y', 'b')})""")
