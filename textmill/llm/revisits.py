"""Not-modified revisits of web archives: which full response a 304 stands for.

Records have ``record_id long, url string, time long, kind string ('response' or 'revisit'),
status int, etag string, last_modified string, digest string,
headers array<struct<name string, value string>>``; a header name may occur more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Header fields of a 304 that do not replace those of the stored response.
NOT_MERGED = (
    "connection",
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authorization",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)
#: Time ranges a URL's records are cut into at most.
TIME_RANGES = 1024


def canonical_url(url: Column) -> Column:
    """One key for spellings of one address; null stays null.

    Without fragment, scheme, user, ``www.``/``m.`` and a default port; the host in lower case;
    without tracking parameters, then an empty query, and without slashes at the end.
    """
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    bare = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, "^([^/?]*)", 1))
    rest = F.regexp_replace(bare, "^[^/?]*", "")
    host = F.regexp_replace(host, "^.*@", "")
    host = F.regexp_replace(host, "^(www|m)[.]", "")
    host = F.regexp_replace(host, ":(80|443)$", "")
    rest = F.regexp_replace(rest, "([?&])(utm_[a-z]+|ref)=[^&]*", "$1")
    rest = F.regexp_replace(rest, "&+", "&")
    rest = F.regexp_replace(rest, "[?]&", "?")
    rest = F.regexp_replace(rest, "[?&]+$", "")
    rest = F.regexp_replace(rest, "/+$", "")
    rest = F.regexp_replace(rest, "/+[?]", "?")
    return F.concat(host, rest)


def same_entity(one: Column, other: Column) -> Column:
    """Weak comparison of entity tags: a ``W/`` in front does not count."""
    return F.regexp_replace(one, "^W/", "") == F.regexp_replace(other, "^W/", "")


def merge_headers(stored: Column, fresh: Column) -> Column:
    """The stored fields, with those the 304 may update replaced, and its new ones appended."""
    lowered = lambda f: F.lower(f["name"])
    fresh = F.coalesce(fresh, F.array().cast("array<struct<name:string,value:string>>"))
    stored = F.coalesce(stored, F.array().cast("array<struct<name:string,value:string>>"))
    permitted = F.filter(fresh, lambda f: F.coalesce(~lowered(f).isin(*NOT_MERGED), F.lit(False)))
    names = F.transform(permitted, lowered)
    kept = F.filter(stored, lambda f: ~F.coalesce(F.array_contains(names, lowered(f)), F.lit(False)))
    return F.concat(kept, permitted)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: the latest earlier full response of its URL, checked and merged.

    A full response has ``kind = 'response'`` and status 200.  *Earlier* is a smaller ``time``;
    of responses at one time the one with the largest ``record_id`` counts.  ``outcome`` is
    ``resolved`` if the first validator that the revisit has (entity tag, modification date,
    payload digest) equals the response's, ``mismatch`` if not, ``unchecked`` if it has none,
    and ``unresolved`` without an earlier response.  ``headers`` is merged for ``resolved`` and
    ``unchecked``; otherwise the revisit's own.  Revisits without URL or time are
    ``unresolved``; repeated revisits each give a row; responses without URL, time or id answer
    nothing.  Other columns are ignored.

    A URL with very many records is cut into ranges of time.  Ranges hand on their last
    response, so no task holds more than a range of one URL.
    """
    rows = records.select(
        F.struct("record_id", "url", "time", "etag", "last_modified", "digest", "headers").alias("record"),
        canonical_url(F.col("url")).alias("key"),
        F.col("time").alias("at"),
        F.coalesce(F.col("kind") == "revisit", F.lit(False)).alias("asks"),
        F.coalesce((F.col("kind") == "response") & (F.col("status") == 200), F.lit(False)).alias("answers"),
    ).filter("asks or answers")
    ends = rows.agg(F.min("at").alias("low"), F.max("at").alias("high")).first()
    width = 1 if ends["low"] is None else max(1, -(-(ends["high"] - ends["low"] + 1) // TIME_RANGES))
    known = F.col("key").isNotNull() & F.col("at").isNotNull()
    timed = rows.filter(known).withColumn("part", F.floor(F.col("at") / F.lit(width)))
    timed = timed.filter("asks or record.record_id is not null")
    answer = F.when(F.col("answers"), F.col("record"))

    # A response at the time of a revisit is not earlier, so it stands behind it.
    within = Window.partitionBy("key", "part").orderBy("at", F.col("asks").desc(), "record.record_id")
    found = timed.withColumn("near", F.last(answer, ignorenulls=True).over(within))
    asked = found.filter("asks")

    moment = F.struct("at", "record.record_id")
    lasts = timed.groupBy("key", "part").agg(
        F.max_by(answer, F.when(F.col("answers"), moment)).alias("last")
    )
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lasts = lasts.select("key", "part", F.last("last", ignorenulls=True).over(earlier).alias("far"))
    matched = asked.join(lasts, ["key", "part"], "left").select(
        "key", "record", F.coalesce("near", "far").alias("response")
    )
    lost = rows.filter("asks").filter(~F.coalesce(known, F.lit(False)))
    matched = matched.unionByName(
        lost.select("key", "record", F.lit(None).cast(matched.schema["response"].dataType).alias("response"))
    )
    equal = (
        F.when(F.col("record.etag").isNotNull(), same_entity(F.col("record.etag"), F.col("response.etag")))
        .when(
            F.col("record.last_modified").isNotNull(),
            F.col("record.last_modified") == F.col("response.last_modified"),
        )
        .when(F.col("record.digest").isNotNull(), F.col("record.digest") == F.col("response.digest"))
    )
    checked = F.coalesce("record.etag", "record.last_modified", "record.digest").isNotNull()
    outcome = (
        F.when(F.col("response").isNull(), "unresolved")
        .when(~checked, "unchecked")
        .when(F.coalesce(equal, F.lit(False)), "resolved")
        .otherwise("mismatch")
    )
    usable = F.col("outcome").isin("resolved", "unchecked")
    return matched.withColumn("outcome", outcome).select(
        F.col("record.record_id").alias("revisit_id"),
        F.col("record.url").alias("url"),
        F.col("key").alias("canonical_url"),
        F.col("record.time").alias("time"),
        F.col("outcome"),
        F.when(usable, F.col("response.record_id")).alias("response_id"),
        F.when(usable, F.col("response.time")).alias("response_time"),
        F.when(usable, F.col("response.digest")).alias("digest"),
        F.when(usable, merge_headers(F.col("response.headers"), F.col("record.headers")))
        .otherwise(F.col("record.headers"))
        .alias("headers"),
    )


def attach_payload(resolved: DataFrame, payloads: DataFrame) -> DataFrame:
    """Put ``payload`` of ``payloads (record_id, payload)`` beside the responses found; null if none."""
    named = payloads.select(F.col("record_id").alias("response_id"), "payload")
    return resolved.join(named, "response_id", "left")
