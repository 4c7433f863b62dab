"""Not-modified revisit records resolved against the latest earlier full response.

Records have ``record_id, url, at, kind`` ("response" or "revisit"), ``headers`` (map, names in lower
case) and ``digest`` of the payload. A revisit is joined, by canonical url, to the last response with an
earlier time; of several with that time to the one with the greatest id. The validators decide: equal
entity tags (a weak mark is ignored), or without a tag on both sides equal last-modified dates. The
resolved record has the response's headers, overlaid with those a not-modified answer may renew.

The as-of join is an as-of aggregate: time is cut into ranges of near equal rows. Within a url and range
a window carries the last response on; across ranges the last response of each (url, range) is carried
over one row a range. A url with a third of all records is so spread over all ranges.

Status: "resolved", "no_response" (nothing earlier), "changed" (validators differ), "unchecked" (no
validator on both sides). Only resolved records get a digest and merged headers. Records without url,
time or kind are left out: nothing can be joined to them. Null headers are empty. Repeated records give
repeated results. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cascata.llm.common import store

RANGES = 256
#: Headers of a not-modified answer that renew the stored ones.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical(url: Column) -> Column:
    """Lower-case host without "www.", no scheme, default port, fragment, tracking query or last slash."""
    bare = F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    bare = F.regexp_replace(bare, r"#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    asked = F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(asked, lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ref)=")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def latest_earlier(records: DataFrame, ranges: int = RANGES) -> DataFrame:
    """Adds ``base``, the last earlier response of the same ``_u`` as a struct, or null."""
    cuts = records.agg(F.percentile_approx("at", [k / ranges for k in range(1, ranges)], 10_000)).first()[0]
    cuts = sorted(set(cuts or []))
    found = F.lit(0)
    if cuts:
        found = F.size(F.filter(F.lit(cuts), lambda c: c < F.col("at")))
    ranged = records.withColumn("_r", found)
    full = F.when(F.col("kind") == "response", F.struct("at", "record_id", "headers", "digest"))
    rows = store(ranged.withColumn("_full", full), "records")
    # The last response of a url and time, then of a url and range.
    last = F.max_by("_full", F.struct("at", "record_id"))
    responses = rows.where("kind = 'response'")
    ends = responses.groupBy("_u", "_r").agg(last.alias("_end"))
    asked = rows.select("_u", "_r").distinct().join(ends, ["_u", "_r"], "left")
    earlier = Window.partitionBy("_u").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    carried = asked.withColumn("_carried", F.last("_end", ignorenulls=True).over(earlier)).select("_u", "_r", "_carried")
    # Records of one time see only what is earlier: one row a url and time, moved on by one.
    times = rows.groupBy("_u", "_r", "at").agg(
        F.max_by("_full", F.when(F.col("kind") == "response", F.col("record_id"))).alias("_here")
    )
    inside = Window.partitionBy("_u", "_r").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = times.withColumn("_before", F.last("_here", ignorenulls=True).over(inside)).drop("_here")
    # A url and range come together in one row each, so these joins do not fan out.
    revisits = rows.where("kind = 'revisit'").drop("_full")
    joined = revisits.join(before, ["_u", "_r", "at"]).join(carried, ["_u", "_r"])
    return joined.withColumn("base", F.coalesce("_before", "_carried")).drop("_before", "_carried", "_r")


def resolve(records: DataFrame) -> DataFrame:
    """``record_id, url, at, status, response_id, digest, headers`` for every revisit."""
    known = records.select(
        "record_id", canonical(F.col("url")).alias("_u"), "at", "kind", "digest",
        F.coalesce("headers", F.map_from_arrays(F.array(), F.array()).cast("map<string,string>")).alias("headers"),
    ).where("_u is not null and at is not null and kind in ('response', 'revisit')")
    found = latest_earlier(known)

    def validator(headers: str, name: str) -> Column:
        return F.regexp_replace(F.try_element_at(F.col(headers), F.lit(name)), "^W/", "")

    tag, base_tag = validator("headers", "etag"), validator("base.headers", "etag")
    date, base_date = validator("headers", "last-modified"), validator("base.headers", "last-modified")
    checked = (
        F.when(F.col("base").isNull(), "no_response")
        .when(tag.isNotNull() & base_tag.isNotNull(), F.when(tag == base_tag, "resolved").otherwise("changed"))
        .when(date.isNotNull() & base_date.isNotNull(), F.when(date == base_date, "resolved").otherwise("changed"))
        .otherwise("unchecked")
    )
    renewed = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    stays = F.map_filter("base.headers", lambda k, v: ~F.map_contains_key(renewed, k))
    ok = F.col("status") == "resolved"
    return found.withColumn("status", checked).select(
        "record_id", F.col("_u").alias("url"), "at", "status",
        F.col("base.record_id").alias("response_id"),
        F.when(ok, F.col("base.digest")).alias("digest"),
        F.when(ok, F.map_concat(stays, renewed)).alias("headers"),
    )
