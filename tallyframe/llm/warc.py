"""Not-modified revisits: find the full response that a revisit record refers to, and put the two together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Responses at most whose payload is copied for many revisits.
HOT = 10_000
#: Query parameters that do not name a page.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid|sessionid"
#: Headers that a 304 response may update (RFC 9110 and 9111); all others stay as the full response had them.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: Column) -> Column:
    """Host and path of a URL without scheme, user, default port, fragment, tracking parameters and end slash.

    Host in lower case, a leading ``www.`` or ``m.`` left out, remaining parameters sorted. Null and empty give "".
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), "#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    before = F.regexp_extract(bare, r"^([^?]*)", 1)
    host = F.regexp_replace(F.lower(F.regexp_extract(before, "^([^/]*)", 1)), "^.*@", "")
    port = F.when(F.lower(F.trim(F.coalesce(url, F.lit("")))).startswith("https:"), F.regexp_replace(host, ":443$", "")).otherwise(F.regexp_replace(host, ":80$", ""))
    host = F.regexp_replace(port, r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_replace(before, "^[^/]*", ""), "/+$", "")
    asked = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.rlike(rf"^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def resolve_revisits(records: DataFrame, rows_in_bucket: int = 100_000, permitted: tuple[str, ...] = PERMITTED, answers: int = 1_000) -> DataFrame:
    """Resolve every revisit among ``records`` (record_id, url, at, kind, headers map<string,string>, payload).

    ``kind`` is ``response`` for a full response and ``revisit`` for a not-modified answer. ``at`` is a number or a timestamp, of any fineness. Returned for each revisit:
    ``record_id, url_key, at, refers_to, outcome, headers, payload``. ``refers_to`` is the latest full response of the same canonical
    URL at an earlier time (ties: the larger record_id). ``outcome``: ``resolved`` when the revisit has an etag or, lacking that,
    a last-modified header that equals the response's; ``mismatch`` when it differs, ``unchecked`` when neither header is on
    both sides, ``missing`` when there is no earlier response. Resolved rows have the response's payload and its headers, of
    which the permitted ones are replaced or added from the revisit; others keep their own headers and a null payload.

    Header names compare in lower case, null headers count as none, a null time or url key "" is a value like any other
    (null times come first, and match nothing earlier). Repeated rows are resolved each. Extra columns are dropped. No rows
    give no rows.

    The as-of join is split by time: each URL's records are ordered inside time buckets of about ``rows_in_bucket`` rows of the
    whole table, and each bucket takes over the last response before it from one row per URL and bucket, so a URL with a third
    of all rows is spread over many tasks. Payloads are joined at the end by URL, time and record, and take no part in any sort; a
    payload that more than ``answers`` revisits (and a ten-thousandth of all records) refer to is copied for each so many of them, so that
    a hot response is spread too.
    """
    lowered = F.map_from_entries(F.array_distinct(F.transform(F.map_entries(F.coalesce("headers", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))))
    slim = records.select("record_id", canonical_url(F.col("url")).alias("url_key"), "at", "kind", lowered.alias("headers"))
    low, high, count = slim.agg(F.min("at").cast("double"), F.max("at").cast("double"), F.count("*")).first()
    width = max(((high or 0) - (low or 0)) / max(1, count // rows_in_bucket), 1e-9)
    slim = slim.withColumn("bucket", F.coalesce(F.floor((F.col("at").cast("double") - F.lit(low or 0)) / F.lit(width)), F.lit(-1)))
    known = F.when((F.col("kind") == "response") & F.col("at").isNotNull(), F.struct("at", "record_id"))
    # Inside a bucket: the last response of a strictly earlier time, as at equal times revisits come before responses.
    earlier = Window.partitionBy("url_key", "bucket").orderBy("at", F.col("kind") == "response").rowsBetween(Window.unboundedPreceding, -1)
    inside = slim.withColumn("near", F.max(known_key(known)).over(earlier))
    last = slim.groupBy("url_key", "bucket").agg(F.max(known_key(known)).alias("newest"))
    before = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("far", F.max("newest").over(before)).select("url_key", "bucket", "far")
    asked = inside.where((F.col("kind") == "revisit")).join(carried, ["url_key", "bucket"]).select(
        "record_id", "url_key", "at", F.col("headers").alias("own"), F.when(F.col("at").isNotNull(), F.coalesce("near", "far")).alias("hit")
    ).withColumn("refers_to", F.col("hit.record_id"))
    hit = ["url_key", "refers_to", "then"]
    asked = asked.withColumn("then", F.col("hit.at")).drop("hit")
    # Hot responses are fewer than HOT, so that they are broadcast and payloads shuffled once.
    parts = asked.where("refers_to is not null").groupBy(*hit).agg(F.ceil(F.count("*") / max(answers, count // HOT)).alias("parts"))
    parts = F.broadcast(parts.where("parts > 1"))
    asked = asked.join(parts, hit, "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("record_id", "at"), F.col("parts")), F.lit(0))).drop("parts")
    sources = records.where("kind = 'response'").select(
        canonical_url(F.col("url")).alias("url_key"), F.col("record_id").alias("refers_to"), F.col("at").alias("then"), "payload", lowered.alias("theirs")
    ).join(parts, hit, "left")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1))
    sources = sources.withColumn("part", each).drop("parts").dropDuplicates([*hit, "part"])
    joined = asked.join(sources, [*hit, "part"], "left")
    same = lambda name: (F.col("own")[name] == F.col("theirs")[name])
    outcome = (
        F.when(F.col("refers_to").isNull(), "missing")
        .when(same("etag").isNotNull(), F.when(same("etag"), "resolved").otherwise("mismatch"))
        .when(same("last-modified").isNotNull(), F.when(same("last-modified"), "resolved").otherwise("mismatch"))
        .otherwise("unchecked")
    )
    allowed = F.map_filter("own", lambda k, _: k.isin(*permitted))
    merged = F.map_concat(F.map_filter("theirs", lambda k, _: ~F.coalesce(F.array_contains(F.map_keys(allowed), k), F.lit(False))), allowed)
    return joined.withColumn("outcome", outcome).select(
        "record_id", "url_key", "at", "refers_to", "outcome",
        F.when(F.col("outcome") == "resolved", merged).otherwise(F.col("own")).alias("headers"),
        F.when(F.col("outcome") == "resolved", F.col("payload")).alias("payload"),
    )


def known_key(known: Column) -> Column:
    """What of a response decides which is latest: time, then record."""
    return F.when(known.isNotNull(), F.struct(known["at"].alias("at"), known["record_id"].alias("record_id")))
