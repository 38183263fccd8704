from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import functions as F
from saldora.llm import revisit
from saldora.llm.queries import op6_warc_revisits

from tests_llm_helpers import rows

KIND = pa.schema([
    ("record_id", pa.string()), ("url", pa.string()), ("at", pa.int64()), ("kind", pa.string()),
    ("headers", pa.map_(pa.string(), pa.string())), ("digest", pa.string()), ("span", pa.string()),
])


def _frame(spark, records):
    columns = [[r[k] for r in records] for k in KIND.names[:-1]] + [["x"] * len(records)]
    return spark.createDataFrame(pa.table(columns, schema=KIND))


def _brute(records):
    out = {}
    for v in (r for r in records if r["kind"] == "revisit"):
        mine = {k.lower(): x for k, x in v["headers"] or []}
        before = [
            r for r in records
            if r["kind"] == "response" and r["url"] == v["url"] and None not in (r["url"], r["at"], v["at"]) and r["at"] < v["at"]
        ]
        full = max(before, key=lambda r: (r["at"], r["record_id"]), default=None)
        if full is None:
            out[v["record_id"]] = ("missing", None, None)
            continue
        theirs = {k.lower(): x for k, x in full["headers"] or []}
        if "etag" in mine and "etag" in theirs:
            same = mine["etag"].removeprefix("W/") == theirs["etag"].removeprefix("W/")
        elif "last-modified" in mine and "last-modified" in theirs:
            same = mine["last-modified"] == theirs["last-modified"]
        elif v["digest"] and full["digest"]:
            same = v["digest"] == full["digest"]
        else:
            same = None
        merged = theirs | {k: x for k, x in mine.items() if k not in revisit.KEPT_HEADERS}
        status = {True: "resolved", False: "changed", None: "unverified"}[same]
        out[v["record_id"]] = (status, full["record_id"], merged if same else None)
    return out


def test_against_brute_force(spark):
    draw = random.Random(6)
    records = []
    for i in range(600):
        names = [("ETag", f'"{draw.randrange(2)}"'), ("Last-Modified", f"d{draw.randrange(2)}"), ("Content-Length", str(i)), ("Date", str(i))]
        headers = None if draw.random() < 0.05 else [h for h in names if draw.random() < 0.6]
        records.append({
            "record_id": f"r{i:04}", "url": draw.choice(["hot.org/a"] * 6 + ["b.org", "c.org/x", None]),
            "at": draw.choice([None] + [draw.randrange(20_000)] * 30), "kind": draw.choice(["response", "revisit", "request"]),
            "headers": headers, "digest": draw.choice(["p", "q", None]),
        })
    records.append({**records[0], "record_id": "twin", "kind": "revisit", "at": 5})
    found = {r["record_id"]: r for r in rows(revisit.resolve_revisits(_frame(spark, records)))}
    expected = _brute(records)
    assert found.keys() == expected.keys()
    for k, (status, response, headers) in expected.items():
        r = found[k]
        got = None if r["headers"] is None else dict(r["headers"])
        assert (r["status"], r["response_id"], got) == (status, response, headers)
    assert {e[0] for e in expected.values()} == {"missing", "resolved", "changed", "unverified"}
    assert rows(revisit.resolve_revisits(_frame(spark, []))) == []


def test_canonical_urls(spark):
    pairs = {
        "http://www.Example.com:80/a/?utm_source=x&ref=1#t": "example.com/a",
        "https://example.com/a/index.html": "example.com/a",
        "https://m.example.com/A?b=2&a=1&gclid=3": "m.example.com/A?a=1&b=2",
        "example.com": "example.com",
        "https://example.com/": "example.com",
        "": "",
    }
    frame = spark.createDataFrame(pa.table([list(pairs)], names=["u"])).select("u", revisit.canonical_url("u").alias("c"))
    assert {r["u"]: r["c"] for r in rows(frame)} == pairs
    assert spark.range(1).select(revisit.canonical_url(F.lit(None).cast("string"))).first()[0] is None


def test_query_resolves_every_page(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = rows(op6_warc_revisits(spark, sf_dir))
    records = rows(revisit.captures(pages).withColumn("url", revisit.canonical_url("url")))
    expected = _brute(records)
    assert len(found) == pages.count() and {r["record_id"]: (r["status"], r["response_id"]) for r in found} == {
        k: v[:2] for k, v in expected.items()
    }
