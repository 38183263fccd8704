"""Not-modified revisit records of a web archive resolved to what they stand for.

A revisit says that a page had not changed. It is resolved to the latest earlier full
response of the same canonical URL; the validators must agree, and the response's headers
are merged with those a not-modified answer may update.

Records: record_id, url, at (seconds), kind ('response' or 'revisit'), headers (map, names
in any case), digest (of the payload).

The as-of join works in two steps, so that a URL with a third of all records is no group of
its own: inside a (URL, time span) the last response so far, and for what has none, the last
response of the latest earlier span, found over one row per (URL, span).

Validators: entity tags compare weakly; without tags on both sides, equal Last-Modified
dates; without those, equal payload digests. Status: ``resolved``, ``changed`` (the
validators differ), ``unverified`` (nothing to compare), ``missing`` (no earlier response).
Only ``resolved`` rows have merged headers.

Cases: an equal time is not earlier. Responses of equal time: the one with the greatest
record_id counts. A null URL or time is ``missing``. Null headers count as none. Repeated
revisits are resolved each. Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SPAN_SECONDS = 3_600

# Header names a not-modified answer must not change, and query parameters
# that do not name a resource.
KEPT_HEADERS = (
    "content-encoding", "content-length", "content-range", "content-type", "transfer-encoding",
)
TRACKING = ("fbclid", "gclid", "ref", "sessionid", "utm_[a-z]*")


def canonical_url(url: str | Column) -> Column:
    """Scheme, ``www.``, default port, fragment, tracking parameters, index page and final slash off.

    Host in lower case, remaining parameters in order.
    """
    u = F.trim(F.col(url) if isinstance(url, str) else url)
    u = F.regexp_replace(u, r"#.*$", "")
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    place, query = F.regexp_extract(u, r"^([^?]*)", 1), F.regexp_extract(u, r"\?(.*)$", 1)
    host = F.lower(F.regexp_extract(place, r"^([^/]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(place, r"^[^/]*(.*)$", 1), r"/(index\.html?)?$", "")
    tracking = "^(" + "|".join(TRACKING) + ")(=|$)"
    own = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(tracking)))
    tail = F.when(F.size(own) > 0, F.concat(F.lit("?"), F.array_join(own, "&"))).otherwise("")
    return F.when(u.isNotNull(), F.concat(host, path, tail))


def _named(headers: str) -> Column:
    """Header map with lower-case names; of names that differ in case only, one entry."""
    none = F.create_map().cast("map<string,string>")
    entries = F.map_entries(F.coalesce(F.col(headers), none))
    lower = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(lower, lambda e: e["key"]))
    values = F.transform(names, lambda n: F.array_max(F.filter(lower, lambda e: e["key"] == n))["value"])
    return F.map_from_arrays(names, values)


def merged_headers(stored: Column, update: Column) -> Column:
    """``stored`` with the entries of ``update`` that a not-modified answer may change."""
    allowed = F.map_filter(update, lambda k, v: ~k.isin(*KEPT_HEADERS))
    left = F.map_filter(stored, lambda k, v: ~F.map_contains_key(allowed, k))
    return F.map_concat(left, allowed)


def _tag(headers: str) -> Column:
    return F.regexp_replace(F.expr(f"{headers}['etag']"), "^W/", "")


def resolve_revisits(records: DataFrame, span: int = SPAN_SECONDS) -> DataFrame:
    """One row per revisit: record_id, url, at, status, response_id, headers, digest."""
    rows = records.select(
        "record_id", canonical_url("url").alias("url"), F.col("at").cast("long").alias("at"), "kind",
        _named("headers").alias("headers"), "digest",
    ).withColumn("span", F.floor(F.col("at") / span))
    full = F.when(
        F.col("kind") == "response", F.struct("at", F.col("record_id").alias("id"), "headers", "digest")
    )
    rows = rows.where(F.col("kind").isin("response", "revisit")).withColumn("full", full)
    placed = rows.where("url is not null and at is not null")
    lost = rows.where("(url is null or at is null) and kind = 'revisit'")
    # at equal times revisits come first: they see earlier responses only
    so_far = (
        Window.partitionBy("url", "span").orderBy("at", F.col("kind").desc(), "record_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = placed.withColumn("found", F.last("full", ignorenulls=True).over(so_far)).where("kind = 'revisit'")
    ends = placed.groupBy("url", "span").agg(
        F.max_by("full", F.when(F.col("full").isNotNull(), F.struct("at", "record_id"))).alias("latest")
    )
    before = Window.partitionBy("url").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "url", "span", F.last("latest", ignorenulls=True).over(before).alias("earlier")
    ).where("earlier is not null")
    joined = inside.join(carried, ["url", "span"], "left").withColumn("found", F.coalesce("found", "earlier"))
    columns = ["record_id", "url", "at", "headers", "digest"]
    both = joined.select(*columns, "found").unionByName(
        lost.select(*columns, F.lit(None).cast(full_type(joined)).alias("found"))
    )
    both = both.withColumn("stored", F.col("found.headers"))
    mine, theirs = _tag("headers"), _tag("stored")
    since, date = F.expr("headers['last-modified']"), F.expr("stored['last-modified']")
    agree = (
        F.when(mine.isNotNull() & theirs.isNotNull(), mine == theirs)
        .when(since.isNotNull() & date.isNotNull(), since == date)
        .otherwise(F.col("digest") == F.col("found.digest"))
    )
    status = (
        F.when(F.col("found").isNull(), "missing")
        .when(agree, "resolved").when(~agree, "changed").otherwise("unverified")
    )
    return both.withColumn("status", status).select(
        "record_id", "url", "at", "status", F.col("found.id").alias("response_id"),
        F.when(F.col("status") == "resolved", merged_headers(F.col("stored"), F.col("headers"))).alias("headers"),
        F.when(F.col("status") == "resolved", F.col("found.digest")).alias("digest"),
    )


def full_type(df: DataFrame):
    return df.schema["found"].dataType


def captures(pages: DataFrame) -> DataFrame:
    """A crawl log of a page table: each page's response and a later revisit of its URL.

    Page ``i`` is fetched at minute ``i`` and asked for again after 1 to 30 days, by the
    MD5 of its id, with its own validators; where another page of the same canonical URL
    was fetched in between, that one is the latest response and the validators differ.
    Pages without an id have no time; a null html has the digest of an empty payload.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.md5(html).alias("digest"),
        F.octet_length(html).cast("string").alias("bytes"),
    )
    fetched = F.col("page_id") * 60
    draw = F.conv(F.substring(F.md5(F.col("page_id").cast("string")), 1, 7), 16, 10).cast("long")
    again = fetched + 86_400 * (1 + draw % 30)
    tag = F.concat(F.lit('"'), F.col("digest"), F.lit('"'))
    response = F.struct(
        F.concat(F.lit("response-"), F.col("page_id")).alias("record_id"), fetched.alias("at"),
        F.lit("response").alias("kind"),
        F.create_map(
            F.lit("ETag"), tag, F.lit("Content-Type"), F.lit("text/html"),
            F.lit("Content-Length"), F.col("bytes"), F.lit("Date"), fetched.cast("string"),
        ).alias("headers"),
    )
    revisit = F.struct(
        F.concat(F.lit("revisit-"), F.col("page_id")).alias("record_id"), again.alias("at"),
        F.lit("revisit").alias("kind"),
        F.create_map(
            F.lit("etag"), F.concat(F.lit("W/"), tag), F.lit("content-length"), F.lit("0"),
            F.lit("date"), again.cast("string"), F.lit("cache-control"), F.lit("max-age=3600"),
        ).alias("headers"),
    )
    return rows.select("page_id", "url", "digest", F.explode(F.array(response, revisit)).alias("r")).select(
        "r.record_id", "url", "r.at", "r.kind", "r.headers", "digest"
    )
