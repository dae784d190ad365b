"""Not-modified revisits of web archives: each one resolved to the response that it confirms.

A revisit record ("304 Not Modified") has headers and no payload. It belongs to the latest earlier full response of the
same canonical URL, if that response's validators are the ones the revisit names: the entity tag (compared weakly), or
without one the modification date. The resolved record has the response's status, payload reference and headers, with
those headers replaced that a 304 may update.

The as-of join does not gather a URL: records are dealt by range of (URL, time), so a URL with a third of all records
spans many partitions; inside one the latest response is a running maximum. What a partition's last response of a URL
means for the following ones is carried by one row for each URL and partition it spans. Payloads are never moved: the
result refers to the record that has it.

Nulls and repeats: records without URL or time are not resolved ("no-earlier-response"); of several responses at one
time the largest record id counts (none is smallest), then the largest payload digest; a response at the revisit's own
time is not earlier; repeated revisits each give a row. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored

#: Header fields that a 304 response may update in a stored response (fixed values, RFC 9110 section 15.4.5 and RFC 9111 section 3.2).
UPDATABLE = ["age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "set-cookie", "vary", "warning"]
#: Query parameters that name a visit, not a resource.
TRACKING = "(utm_[a-z]+|gclid|fbclid|sessionid|sid|phpsessid|ref)"
#: WARC dates are whole seconds here; a capture's date in the derived table starts from this second.
EPOCH = 1_700_000_000


def canonical_url(url: Column) -> Column:
    """Scheme and ``www.``/``m.`` dropped, host lowered, default port, fragment, tracking parameters and last slash gone."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), ":(80|443)$", "")
    rest = F.regexp_replace(bare, "^[^/?]*", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^?]*", 0), "/+$", "")
    query = F.split(F.regexp_replace(rest, "^[^?]*\\??", ""), "&")
    kept = F.array_join(F.array_sort(F.filter(query, lambda q: (q != "") & ~q.rlike(f"^{TRACKING}="))), "&")
    return F.concat(F.regexp_replace(host, "^(www|m)\\.", ""), path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def parsed_headers(block: Column) -> Column:
    """Header fields of an HTTP header block by lower-case name; repeated fields are joined by commas."""
    lines = F.filter(F.split(block, "\r?\n"), lambda line: line.rlike("^[^:\\s]+:"))
    fields = F.transform(
        lines, lambda line: F.struct(F.lower(F.regexp_extract(line, "^[^:]+", 0)).alias("k"), F.trim(F.regexp_replace(line, "^[^:]+:", "")).alias("v"))
    )
    names = F.array_distinct(F.transform(fields, lambda f: f["k"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.array_join(F.transform(F.filter(fields, lambda f: f["k"] == n), lambda f: f["v"]), ", ")))


def merged_headers(stored_headers: Column, update: Column) -> Column:
    """The stored response's headers, updated by what a 304 may change."""
    allowed = F.map_filter(update, lambda k, _: k.isin(UPDATABLE))
    return F.map_concat(F.map_filter(stored_headers, lambda k, _: ~F.array_contains(F.map_keys(allowed), k)), allowed)


def header_text(headers: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat_ws(": ", e["key"], e["value"])), "\n")


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def latest_responses(records: DataFrame) -> DataFrame:
    """Revisits with ``found``: the latest earlier full response of their URL as a struct, or null."""
    spark = records.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    response = F.struct("ts", "record_id", "status", "headers", "payload_digest")
    placed = records.where("url IS NOT NULL AND ts IS NOT NULL").select(
        "record_id", "kind", "url", "ts", "headers", "payload_digest", F.when(F.col("kind") == "response", response).alias("response")
    )
    placed = stored(placed.repartitionByRange(parts, "url", "ts").withColumn("part", F.spark_partition_id()))
    # Structs with maps have no order, so the running maximum is over time and id, and keeps the rest beside it.
    earlier = Window.partitionBy("url", "part").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    best = F.max_by("response", F.when(F.col("response").isNotNull(), F.struct("ts", "record_id", "payload_digest")))
    found = placed.withColumn("found", best.over(earlier)).where("kind = 'revisit'")
    ends = placed.groupBy("url", "part").agg(best.alias("last"))
    spanning = ends.groupBy("url").agg(F.count("*").alias("n")).where("n > 1").select("url")
    before = Window.partitionBy("url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.join(spanning, "url").withColumn("carried", F.last("last", ignorenulls=True).over(before)).select("url", "part", "carried")
    return found.join(carried, ["url", "part"], "left").withColumn("found", F.coalesce("found", "carried")).select("record_id", "url", "ts", "headers", "found")


def resolve(records: DataFrame) -> DataFrame:
    """One row for each revisit of ``records`` (record_id, kind, target_uri, ts, status, http, payload_digest).

    ``outcome`` is resolved, stale (the latest earlier response has other validators), no-validator, or
    no-earlier-response. Only a resolved revisit has ``response_id, status, payload_digest`` and merged ``headers``.
    """
    read = records.select(
        F.col("record_id").cast("bigint").alias("record_id"),
        "kind",
        canonical_url(F.col("target_uri")).alias("url"),
        F.col("ts").cast("bigint").alias("ts"),
        F.col("status").cast("int").alias("status"),
        parsed_headers(F.coalesce("http", F.lit(""))).alias("headers"),
        "payload_digest",
    )
    read = stored(read.where("kind IN ('response', 'revisit')"))
    placeless = read.where("kind = 'revisit' AND (url IS NULL OR ts IS NULL)")
    found = latest_responses(read)
    found = found.unionByName(placeless.select("record_id", "url", "ts", "headers", F.lit(None).cast(found.schema["found"].dataType).alias("found")))
    tag, date = F.col("headers")["etag"], F.col("headers")["last-modified"]
    same = F.when(tag.isNotNull(), _weak(tag) == _weak(F.col("found.headers")["etag"])).otherwise(date == F.col("found.headers")["last-modified"])
    outcome = (
        F.when(F.col("found").isNull(), "no-earlier-response")
        .when(tag.isNull() & date.isNull(), "no-validator")
        .when(F.coalesce(same, F.lit(False)), "resolved")
        .otherwise("stale")
    )
    judged = found.withColumn("outcome", outcome)
    resolved = F.col("outcome") == "resolved"
    return judged.select(
        "record_id",
        "url",
        "outcome",
        F.when(resolved, F.col("found.record_id")).alias("response_id"),
        F.when(resolved, F.col("found.status")).alias("status"),
        F.when(resolved, F.col("found.payload_digest")).alias("payload_digest"),
        F.when(resolved, header_text(merged_headers(F.col("found.headers"), F.col("headers")))).alias("headers"),
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """WARC records derived from a table of pages: two dated responses and one revisit of every page.

    A page's first response is dated by its id, the second one follows half a day later; every third page has changed by
    then, and with it its entity tag and payload. Every page is visited again: even ids a day after the first response,
    odd ones between the two, every thirteenth id before both. The visit names the first response's tag; every fifth one
    finds another tag, every seventh names a date only, every eleventh has no validator at all. Rows without page_id or
    url give records that are not resolved.
    """
    number = F.col("page_id")
    page = pages.select(number.cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.md5(F.coalesce("html", F.lit(""))).alias("digest"))
    ts = number * 60 + EPOCH
    date = F.concat(F.lit("day "), F.floor(number / 100).cast("string"))

    def response(place: int, seconds: int, digest: Column) -> DataFrame:
        head = F.concat(F.lit('HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nETag: "'), digest, F.lit('"\r\nLast-Modified: '), date)
        return page.select(
            (4 * number + place).alias("record_id"),
            F.lit("response").alias("kind"),
            F.col("url").alias("target_uri"),
            (ts + seconds).alias("ts"),
            F.lit(200).alias("status"),
            F.concat(head, F.lit("\r\nCache-Control: max-age=60\r\n\r\n")).alias("http"),
            digest.alias("payload_digest"),
        )

    tag = F.when(number % 5 == 0, F.lit("changed")).otherwise(F.col("digest"))
    validator = (
        F.when(number % 11 == 0, F.lit(""))
        .when(number % 7 == 0, F.concat(F.lit("Last-Modified: "), date, F.lit("\r\n")))
        .otherwise(F.concat(F.lit('ETag: W/"'), tag, F.lit('"\r\n')))
    )
    later = F.when(number % 13 == 0, -3600).when(number % 2 == 0, 86_400).otherwise(20_000)
    revisit = page.select(
        (4 * number + 2).alias("record_id"),
        F.lit("revisit").alias("kind"),
        F.col("url").alias("target_uri"),
        (ts + later).alias("ts"),
        F.lit(304).alias("status"),
        F.concat(F.lit("HTTP/1.1 304 Not Modified\r\n"), validator, F.lit("Cache-Control: max-age=120\r\nContent-Type: text/plain\r\n\r\n")).alias("http"),
        F.lit(None).cast("string").alias("payload_digest"),
    )
    changed = F.when(number % 3 == 0, F.md5(F.concat("digest", F.lit("-2")))).otherwise(F.col("digest"))
    return response(0, 0, F.col("digest")).unionByName(response(1, 43_200, changed)).unionByName(revisit)
