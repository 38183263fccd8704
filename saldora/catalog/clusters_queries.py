"""Segmentation K1..K12; quality indices also on stand-in labels that SQL can repeat."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from saldora.catalog.registry import Book
from saldora.catalog.roles import stand_in_segments, track_a
from saldora.catalog.roles_sql import A, SEGMENTS, key_hash, r, with_roles
from saldora.functions.expr import round_to
from saldora.operators import segment as sg
from saldora.operators.clusters import fit_all, unmoved
from saldora.operators.relational import attach
from saldora.session import materialise, right_size, scratch_path
from saldora.sources import read_csv, write_csv

BOOK = Book()
add = BOOK.add


def _r(df, digits, *cols):
    return df.withColumns({c: round_to(c, digits) for c in cols})


def _asinh(c):
    return f"sign({c}) * asinh(abs({c}))"


FEATS_SQL = ", ".join(f"{_asinh(c) if c in sg.SKEWED else c + '::DOUBLE'} AS {c}" for c in sg.FEATURES)


def scaled(s, d):
    feats = sg.segment_features(track_a(s, d))
    return sg.standardise(feats, sg.FEATURES)[0]


def scaled_once(s, d):
    """The same from stored features: the tables are read and joined once, however many passes follow."""
    feats = materialise(sg.segment_features(track_a(s, d)))
    return sg.standardise(feats, sg.FEATURES)[0]


def scaled_stand_in(s, d):
    labels = stand_in_segments(s, d).select("customer_id", "segment")
    return attach(scaled(s, d), labels, "customer_id")


add("k1_segment_features",
    lambda s, d: _r(sg.segment_features(track_a(s, d)), 6, *sg.FEATURES),
    with_roles(A, "SELECT customer_id, " + ", ".join(f"{r(c, 6)} AS {c}" for c in sg.FEATURES)
               + f" FROM (SELECT customer_id, {FEATS_SQL} FROM a)"))
SCALED_CTE = f""", f AS (SELECT customer_id, segment, {FEATS_SQL} FROM g),
  z AS (SELECT customer_id, segment, """ + ", ".join(
    f"({c} - (SELECT avg({c}) FROM f)) / (SELECT stddev_pop({c}) FROM f) AS {c}" for c in sg.FEATURES) + " FROM f)"
add("k2_standardised_features",
    lambda s, d: _r(scaled(s, d), 6, *sg.FEATURES),
    with_roles(SEGMENTS, SCALED_CTE + " SELECT customer_id, " + ", ".join(f"{r(c, 6)} AS {c}" for c in sg.FEATURES) + " FROM z"))


def k3(s, d):
    """Best of ten restarts, k = 4: (restarts, best cost, worst cost)."""
    frame = scaled_once(s, d)
    vectors = sg.as_vector(frame, sg.FEATURES).select("customer_id", "features")
    vectors = right_size(vectors, frame.count()).persist()
    try:
        best = sg.kmeans(vectors, sg.FINAL_K, key="customer_id")
    finally:
        vectors.unpersist()
    return best.label(vectors).groupBy("segment").agg(F.count(F.lit(1)).alias("customers")).withColumns(
        {"best_cost": F.lit(best.cost), "worst_cost": F.lit(max(best.costs)), "restarts": F.lit(len(best.costs))})


add("k3_kmeans_restarts", k3)
K_RANGE = range(2, 7)


def _all_runs(s, d):
    """Stored vectors and all restarts for k = 2..6."""
    frame = scaled_once(s, d)
    vectors = sg.as_vector(frame, sg.FEATURES).select("customer_id", "features")
    vectors = right_size(vectors, frame.count()).persist()
    return vectors, fit_all(vectors, vector_to_array("features"), K_RANGE, sg.RESTARTS, sg.SEED, key="customer_id")


def k3_fixed_point(s, d):
    """For every k the best run once more: assign all rows, recompute the centres, compare."""
    vectors, found = _all_runs(s, d)
    parts = []
    for k, runs in found.items():
        best = sg.best_of(runs)
        again = unmoved(vectors, vector_to_array("features"), best.centres)
        sizes = F.array(*[F.lit(n) for n in best.sizes])[F.col("cluster")]
        parts.append(again.agg(
            F.lit(k).alias("k"), F.lit(len(runs)).alias("restarts"), F.count(F.lit(1)).alias("clusters"),
            F.sum("rows").alias("customers"), (F.max("moved") < 1e-6).alias("unmoved"),
            F.every(sizes == F.col("rows")).alias("sizes_agree")))
    return reduce(lambda a, b: a.unionByName(b), parts)


add("k3_fixed_point", k3_fixed_point, with_roles(A, """
  SELECT k::INT AS k, 10 AS restarts, k::BIGINT AS clusters, (SELECT count(*) FROM a) AS customers, true AS unmoved, true AS sizes_agree
  FROM (SELECT unnest(range(2, 7)) AS k)"""))


def k4_costs_fall(s, d):
    """The best cost of each k, checked to fall as k grows; ten restarts each."""
    vectors, found = _all_runs(s, d)
    best = {k: min(r.cost for r in runs) for k, runs in found.items()}
    rows = vectors.agg(F.count(F.lit(1)).alias("customers"))
    falls = F.array(*[
        F.struct(F.lit(k).alias("k"), F.lit(k == K_RANGE[0] or best[k] < best[k - 1]).alias("falls")) for k in K_RANGE])
    return rows.select("customers", F.inline(falls))


add("k4_costs_fall", k4_costs_fall, with_roles(A, """
  SELECT (SELECT count(*) FROM a) AS customers, k::INT AS k, true AS falls FROM (SELECT unnest(range(2, 7)) AS k)"""))
add("k4_evaluate_k", lambda s, d: sg.evaluate_k(scaled_once(s, d), sg.FEATURES))
DIST = "sqrt(" + " + ".join(f"(p.{c} - q.{c}) ** 2" for c in sg.FEATURES) + ")"


def _silhouette_sql(sample):
    return with_roles(SEGMENTS, SCALED_CTE + f""",
      smp AS (SELECT * FROM z ORDER BY {key_hash('customer_id')}, customer_id LIMIT {sample}),
      dd AS (SELECT p.customer_id, p.segment AS own, q.segment AS other, sum({DIST}) AS t,
               count(*) FILTER (p.customer_id <> q.customer_id) AS others, count(*) AS n
             FROM smp p CROSS JOIN smp q GROUP BY 1, 2, 3),
      ab AS (SELECT customer_id, max(CASE WHEN own = other THEN t / others END) AS a, min(CASE WHEN own <> other THEN t / n END) AS b
             FROM dd GROUP BY 1)
      SELECT {r('avg((b - a) / greatest(a, b))', 6)} AS silhouette FROM ab""")


def _silhouette(sample):
    return lambda s, d: _r(
        sg.silhouette(scaled_stand_in(s, d), sg.FEATURES, "segment", "customer_id", sample), 6, "silhouette")


# the published sample, and a smaller one that the test tables exceed
add("k5_silhouette", _silhouette(sg.SILHOUETTE_SAMPLE), _silhouette_sql(sg.SILHOUETTE_SAMPLE))
add("k5_silhouette_of_sample", _silhouette(100), _silhouette_sql(100))
CENTRES = ", ".join(f"avg({c}) AS {c}" for c in sg.FEATURES)
add("k6_davies_bouldin",
    lambda s, d: _r(sg.davies_bouldin(scaled_stand_in(s, d), sg.FEATURES, "segment"), 6, "davies_bouldin"),
    with_roles(SEGMENTS, SCALED_CTE + f""",
      cc AS (SELECT segment, {CENTRES} FROM z GROUP BY 1),
      sp AS (SELECT p.segment, avg({DIST}) AS s FROM z p JOIN cc q USING (segment) GROUP BY 1),
      pairs AS (SELECT p.segment AS i, max((si.s + sj.s) / {DIST}) AS w FROM cc p JOIN cc q ON p.segment <> q.segment
                JOIN sp si ON si.segment = p.segment JOIN sp sj ON sj.segment = q.segment GROUP BY 1)
      SELECT {r('avg(w)', 6)} AS davies_bouldin FROM pairs"""))


def k7_nearest(s, d):
    """Every customer's segment against the nearest centre, found by its own ranking of distances."""
    vectors, found = _all_runs(s, d)
    best = sg.best_of(found[sg.FINAL_K])
    far = [
        F.struct(
            F.aggregate(
                F.zip_with(vector_to_array("features"), F.array(*[F.lit(float(v)) for v in c]), lambda a, b: F.pow(a - b, 2.0)),
                F.lit(0.0), lambda t, v: t + v).alias("far"),
            F.lit(i).alias("segment"))
        for i, c in enumerate(best.centres)
    ]
    return best.label(vectors).select("customer_id", (F.col("segment") == F.least(*far)["segment"]).alias("nearest"))


add("k7_nearest_centre", k7_nearest, with_roles(A, "SELECT customer_id, true AS nearest FROM a"))


def k7(s, d):
    """Segments of all customers, and the churn they go with."""
    return sg.segment_customers(track_a(s, d))


add("k7_segment_assignment", k7)
PROFILE_SQL = f"""SELECT segment, count(customer_id) AS customer_count, {r('avg(age)', 2)} AS avg_age, {r('avg(vintage)', 2)} AS avg_vintage_days,
  {r('avg(current_balance)', 2)} AS avg_current_balance, {r('median(current_balance)', 2)} AS median_current_balance,
  {r('avg(current_month_credit)', 2)} AS avg_month_credit, {r('avg(current_month_debit)', 2)} AS avg_month_debit,
  {r('avg(churn)', 2)} AS churn_rate, {r('count(*)::DOUBLE / (SELECT count(*) FROM g) * 100.0::DOUBLE', 1)} AS pct_of_customers FROM g GROUP BY 1"""
add("k8_segment_profile", lambda s, d: sg.display_profile(sg.segment_profile(stand_in_segments(s, d))), with_roles(SEGMENTS, PROFILE_SQL))
for _attr in ("customer_nw_category", "occupation"):
    add(f"k9_segment_mix_{_attr}",
        lambda s, d, a=_attr: _r(sg.segment_mix(stand_in_segments(s, d), "segment", a), 6, "share", "base_share"),
        with_roles(SEGMENTS, f"""SELECT segment, {_attr} AS level, count(*) AS n,
          {r('count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY segment)', 6)} AS share,
          {r(f'(sum(count(*)) OVER (PARTITION BY {_attr}))::DOUBLE / sum(count(*)) OVER ()', 6)} AS base_share FROM g GROUP BY 1, 2"""))
add("k10_smallest_segment", lambda s, d: _r(sg.smallest_segment(stand_in_segments(s, d)), 6, "share"),
    with_roles(SEGMENTS, f"""SELECT min(n) AS smallest, sum(n)::BIGINT AS total, {r('min(n)::DOUBLE / sum(n)', 6)} AS share
      FROM (SELECT segment, count(*) AS n FROM g GROUP BY 1)"""))
add("k11_segment_names", lambda s, d: sg.segment_names(sg.segment_profile(stand_in_segments(s, d))),
    with_roles(SEGMENTS, """
      , p AS (SELECT segment, avg(current_balance) AS bal, avg(current_month_credit) AS cred, avg(vintage) AS vin FROM g GROUP BY 1),
      o AS (SELECT segment AS o FROM p ORDER BY bal DESC LIMIT 1),
      t AS (SELECT segment AS t FROM p WHERE segment <> (SELECT o FROM o) ORDER BY cred DESC LIMIT 1),
      h AS (SELECT segment AS h FROM p WHERE segment NOT IN ((SELECT o FROM o), (SELECT t FROM t)) ORDER BY vin LIMIT 1)
      SELECT segment, CASE WHEN segment = (SELECT o FROM o) THEN 'High Balance, Low Activity'
        WHEN segment = (SELECT t FROM t) THEN 'High Activity, High Churn'
        WHEN segment = (SELECT h FROM h) THEN 'Newer Customers' ELSE 'Mass Retail' END AS name FROM p"""))


def k12(s, d):
    """Assignments written as CSV and read back, counted per segment."""
    labels = stand_in_segments(s, d).select("customer_id", "segment")
    path = write_csv(labels, scratch_path(s, "segments_csv"))
    return read_csv(s, path, labels.schema).groupBy("segment").agg(F.count("customer_id").alias("customers"))


add("k12_segment_output", k12, with_roles(SEGMENTS, "SELECT segment, count(*) AS customers FROM g GROUP BY 1"))
