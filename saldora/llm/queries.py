"""The operators as registered queries over their whole tables; the mix has two."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldora.llm import (
    decontaminate, fingerprint, language, manifest, mixing, neardup, quality, revisit, runs, secrets,
    substring, topk, toxicity,
)
from saldora.llm.rows import held_out, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_token", "n_key"
    )


def op2_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = held_out(5, 0)
    space = quality.train(docs, labels, ~out)
    return quality.score(docs, space).select(
        "doc_id", out.alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_shard = F.array_sort(F.transform("pieces", lambda p: F.struct(p["shard"], p["pass"], p["first"], p["words"])))
    listed = F.transform(by_shard, lambda p: F.concat_ws(":", p["shard"], p["pass"], p["first"], p["words"]))
    return mixing.draw_mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", F.array_join(listed, ",").alias("pieces")
    )


def op3_mixed_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shuffled_shards(mixing.draw_mix(table(spark, sf_dir, "documents"), carried=["text"]))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicate_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_class", (F.col("doc_id") == F.col("class_id")).alias("stays")
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisit.resolve_revisits(revisit.captures(table(spark, sf_dir, "pages")))
    entries = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return found.select(
        "record_id", "url", "at", "status", "response_id", F.array_join(entries, "; ").alias("headers"), "digest"
    )


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = held_out(3, 1)
    model = toxicity.train(docs, labels, ~out)
    return toxicity.score(docs, model).select(
        "doc_id", out.alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out(3, 1)
    found = language.identify_language(table(spark, sf_dir, "documents"), ~out)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op10_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(held_out(3, 0), lowered).otherwise(F.col("text"))
    found = manifest.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], tampered={"text": changed})
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified"
    )


def _with_periods(docs: DataFrame) -> DataFrame:
    """``documents`` with the periodic stretches that the contract of op13 plants: where 10 divides
    h, the words from a on repeat the first p of them."""
    planted = """transform(array(regexp_extract_all(coalesce(text, ''), '[^\\\\x20\\\\x09-\\\\x0D]+', 0)), w ->
      if(size(w) = 0, '', concat_ws(' ', transform(sequence(0, size(w) - 1), i -> get(w, cast(
        if(i < g % size(w), i, g % size(w) + (i - g % size(w)) % (1 + (size(w) - g % size(w)) div (3 + g % 8)))
      as int))))))[0]"""
    h = F.crc32(F.col("doc_id").cast("string"))
    return docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g")).select(
        "doc_id", F.when(F.col("h") % 10 == 0, F.expr(planted)).otherwise(F.col("text")).alias("text")
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.collapse_runs(_with_periods(table(spark, sf_dir, "documents")))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    # greatest length, then smallest start, then smallest period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    return found.withColumn("x", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("x.col2")).alias("start"),
        F.col("x.length").alias("length"), (-F.col("x.col3")).alias("period"),
        F.expr("1000 * x.length div -x.col3").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_secret_scan, op2_quality_neighbours, op3_source_mix, op3_mixed_shards, op4_near_duplicates,
        op5_fingerprints, op6_warc_revisits, op7_repeated_passages, op8_toxicity, op9_language,
        op10_benchmark_hits, op11_topk_search, op12_merkle_manifest, op13_periodic_runs,
    )
}

# ------------------------------------------------------------------ SQL twins

_BENCHMARK_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (
  SELECT item, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
  FROM b WHERE len(w) > 0),
grams AS (SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS gram FROM bi),
sizes AS (SELECT DISTINCT size FROM grams),
di AS (
  SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size),
hits AS (
  SELECT di.r, di.i, di.size, grams.item
  FROM (SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram FROM di) di
  JOIN grams ON di.gram = grams.gram AND di.size = grams.size),
covered AS (SELECT r, count(DISTINCT pos) AS n_hit
  FROM (SELECT r, unnest(range(i, i + size)) AS pos FROM hits) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""

_REPEATS_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
g AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM p),
repeated AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS pos FROM g WHERE h IN (SELECT h FROM repeated)),
words AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (
  SELECT words.r, count(*) AS n, string_agg(x, ' ' ORDER BY words.pos) AS t
  FROM words LEFT JOIN gone ON words.r = gone.r AND words.pos = gone.pos WHERE gone.r IS NULL GROUP BY words.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) AS BIGINT) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

_REVISITS_SQL = r"""
WITH p AS (
  SELECT page_id, md5(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS bytes,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u,
    page_id * 60 AS fetched FROM pages),
q AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(regexp_extract(u, '^([^?]*)', 1), '^([^/]*)', 1)),
      '^www\.', ''), ':(80|443)$', '') AS host,
    regexp_replace(regexp_extract(regexp_extract(u, '^([^?]*)', 1), '^[^/]*(.*)$', 1), '/(index\.html?)?$', '') AS path,
    list_sort([x FOR x IN string_split(regexp_extract(u, '\?(.*)$', 1), '&')
      IF x <> '' AND NOT regexp_matches(x, '^(fbclid|gclid|ref|sessionid|utm_[a-z]*)(=|$)')]) AS own
  FROM p),
c AS (
  SELECT page_id, digest, bytes, fetched, CASE WHEN u IS NOT NULL THEN
    host || path || CASE WHEN len(own) > 0 THEN '?' || array_to_string(own, '&') ELSE '' END END AS url FROM q),
v AS (
  SELECT page_id, url, digest, fetched + 86400 * (1 + CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 7) AS BIGINT) % 30) AS again
  FROM c),
latest AS (
  SELECT v.page_id, max(c.fetched) AS fetched FROM v LEFT JOIN c ON c.url = v.url AND c.fetched < v.again GROUP BY v.page_id),
f AS (
  SELECT v.page_id, v.url, v.digest, v.again, c.page_id AS full_id, c.digest AS full_digest, c.bytes
  FROM v JOIN latest USING (page_id) LEFT JOIN c ON c.url = v.url AND c.fetched = latest.fetched)
SELECT 'revisit-' || page_id AS record_id, url, again AS at,
  CASE WHEN full_id IS NULL THEN 'missing' WHEN digest = full_digest THEN 'resolved' ELSE 'changed' END AS status,
  'response-' || full_id AS response_id,
  CASE WHEN digest = full_digest THEN 'cache-control: max-age=3600; content-length: ' || bytes
    || '; content-type: text/html; date: ' || again || '; etag: W/"' || digest || '"' END AS headers,
  CASE WHEN digest = full_digest THEN full_digest END AS digest
FROM f
"""

_TOPK_SQL = r"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
t AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM t WHERE n <= 5
"""

# crc32 of a decimal, unsigned, from its definition
_CRC_SQL = """CAST(xor(4294967295, list_reduce(list_concat([4294967295],
    list_transform(range(1, length(CAST({0} AS VARCHAR)) + 1), lambda i: ord(CAST({0} AS VARCHAR)[i]))),
    lambda a, c: list_reduce(list_concat([xor(a, c)], range(8)),
      lambda x, _: xor(x >> 1, 3988292384 * (x & 1))))) AS BIGINT)"""

_FIELD_SQL = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD_SQL.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_MANIFEST_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT *, CASE WHEN doc_id IS NOT NULL AND {_CRC_SQL.format("doc_id")} % 3 = 0
    THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed FROM documents),
l AS (SELECT doc_id, lang, {_leaf_sql("text")} AS leaf, {_leaf_sql("changed")} AS checked FROM d),
g AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n,
    CAST(dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS BIGINT) AS grp FROM l),
up AS (  -- all nodes below the groups' roots
  SELECT grp, 0 AS lv, CAST(i AS BIGINT) AS i, CAST(n AS BIGINT) AS n, leaf AS h FROM g
  UNION ALL
  SELECT grp, lv + 1, i // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY grp, lv, i // 8),
subs AS (SELECT grp, h FROM up WHERE n = 1),
top AS (
  SELECT 0 AS lv, grp AS i, (SELECT count(*) FROM subs) AS n, h FROM subs
  UNION ALL
  SELECT lv + 1, i // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY lv, i // 8),
flank AS (  -- for every leaf and level, what stands before and after its node
  SELECT g.grp, g.i AS leaf_i, up.lv,
    coalesce(string_agg(up.h, '' ORDER BY up.i) FILTER (up.i < g.i // CAST(pow(8, up.lv) AS BIGINT)), '') AS a,
    coalesce(string_agg(up.h, '' ORDER BY up.i) FILTER (up.i > g.i // CAST(pow(8, up.lv) AS BIGINT)), '') AS b
  FROM g JOIN up ON up.grp = g.grp AND up.n > 1 AND up.i // 8 = g.i // CAST(pow(8, up.lv + 1) AS BIGINT) GROUP BY ALL
  UNION ALL
  SELECT g.grp, g.i, 1000 + top.lv,
    coalesce(string_agg(top.h, '' ORDER BY top.i) FILTER (top.i < g.grp // CAST(pow(8, top.lv) AS BIGINT)), ''),
    coalesce(string_agg(top.h, '' ORDER BY top.i) FILTER (top.i > g.grp // CAST(pow(8, top.lv) AS BIGINT)), '')
  FROM g JOIN top ON top.n > 1 AND top.i // 8 = g.grp // CAST(pow(8, top.lv + 1) AS BIGINT) GROUP BY ALL),
path AS (
  SELECT grp, leaf_i, string_agg(a || b, '' ORDER BY lv) AS p, list(struct_pack(a := a, b := b) ORDER BY lv) AS f
  FROM flank GROUP BY ALL),
root AS (SELECT h FROM top WHERE n = 1),
folded AS (
  SELECT g.*, p, coalesce(len(f), 0) AS steps, f, subs.h AS subroot, (SELECT h FROM root) AS root
  FROM g JOIN subs USING (grp) LEFT JOIN path ON path.grp = g.grp AND path.leaf_i = g.i),
walk AS (
  SELECT grp, i, 0 AS k, checked AS h, steps, f FROM folded
  UNION ALL
  SELECT grp, i, k + 1, sha256(f[k + 1].a || h || f[k + 1].b), steps, f FROM walk WHERE k < steps)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(p, '')) AS proof_sha256, walk.h AS folded_root, walk.h = root AS verified
FROM folded JOIN walk ON walk.grp = folded.grp AND walk.i = folded.i AND walk.k = walk.steps
"""

_RUNS_SQL = rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, {_CRC_SQL.format("doc_id")} AS h,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (
  SELECT r, doc_id, w, len(w) AS n, coalesce(h % 10 = 0, false) AND len(w) > 0 AS planted,
    (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS d FROM t),
v AS (
  SELECT r, doc_id, n, CASE WHEN planted THEN
      list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // d) END]) ELSE w END AS w FROM u),
five AS (
  SELECT r, i, hash(w[i + 1:i + 5]) AS g, CASE WHEN i > 0 THEN w[i] END AS l
  FROM (SELECT r, w, unnest(range(n - 4)) AS i FROM v WHERE n >= 6)),
-- pairs of places with equal words from there on and other words before
pairs AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM five x JOIN five y ON x.r = y.r AND x.g = y.g AND y.i > x.i
  JOIN v ON v.r = x.r
  WHERE x.l IS DISTINCT FROM y.l AND 4 * (y.i - x.i) <= v.n - x.i),
long AS (
  SELECT pairs.*, v.w, v.n FROM pairs JOIN v USING (r)
  WHERE w[i + 1:i + greatest(5, 3 * q)] = w[i + q + 1:i + q + greatest(5, 3 * q)] AND i + q + greatest(6 - q, 3 * q) <= n),
ends AS (
  SELECT r, i, q, q + coalesce(list_position(list_transform(range(n - i - q), lambda k: w[i + k + 1] = w[i + q + k + 1]), false) - 1, n - i - q) AS size
  FROM long),
runs AS (SELECT r, i AS start, size, min(q) AS q FROM ends WHERE size >= greatest(6, 4 * q) GROUP BY r, i, size),
per AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || size || ',' || q || chr(10), '' ORDER BY start, q) AS listed,
    first(struct_pack(s := start, z := size, q := q) ORDER BY size DESC, start, q) AS x FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + q, start + size)) AS pos FROM runs),
kept AS (
  SELECT a.r, string_agg(a.x, ' ' ORDER BY a.pos) AS t FROM (SELECT r, unnest(w) AS x, unnest(range(n)) AS pos FROM v WHERE r IN (SELECT r FROM runs)) a
  LEFT JOIN gone ON gone.r = a.r AND gone.pos = a.pos WHERE gone.r IS NULL GROUP BY a.r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, x.s AS start, x.z AS length, x.q AS period, 1000 * x.z // x.q AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(t, array_to_string(w, ' '))) AS collapsed_sha256
FROM v LEFT JOIN per USING (r) LEFT JOIN kept USING (r)
"""

# The others have no SQL form: trained scores, MinHash values and hash orders, and offsets
# of regular expression matches. Tests hold them against brute force.
ORACLE: dict[str, str] = {
    "op6_warc_revisits": _REVISITS_SQL,
    "op7_repeated_passages": _REPEATS_SQL,
    "op10_benchmark_hits": _BENCHMARK_SQL,
    "op11_topk_search": _TOPK_SQL,
    "op12_merkle_manifest": _MANIFEST_SQL,
    "op13_periodic_runs": _RUNS_SQL,
}
