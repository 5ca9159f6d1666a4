"""Resolution of not-modified revisits in web archives.

A revisit record says that a page had not changed and holds no payload. ``resolve`` finds, for each, the latest earlier
full response of the same canonical URL, tells whether the validators agree, and merges the headers a not-modified
answer may carry into the response's. Where the validators disagree, the response found is not what the server had in mind, and no headers are merged.

Validators: entity tags are compared weakly (``W/"x"`` and ``"x"`` agree, as a not-modified answer may do), and where both sides have one they decide; else the times of the last
modification do; without a validator on both sides, ``agrees`` is null and the headers are merged on the URL's word.

The as-of join goes by time slices: inside a slice of a URL a window finds the latest response; where the slice has none, the last response
of an earlier slice is taken, from one summary row for each URL and slice. So a page captured very often is dealt
out by slices, and the last step sees one row for each slice.

Cases: a null URL or time resolves to nothing, and such rows take no part in window and join; of records with one time a revisit comes before responses, and of responses the greatest id is the
latest; a null header map counts as empty; header names are compared and given in lower case, and of names that differ by case alone the first in their order as written wins; a very long URL or header is one
value like others; repeated revisits
are resolved one by one; an empty table gives an empty result; extra columns pass through, but for those with the names of the result's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gantry.llm.shared import private

SLICE_SECONDS = 3600
#: Headers that a not-modified answer may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that don't tell pages apart.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sid|sessionid)="


def canonical(url: Column) -> Column:
    """Host in lower case without www. or m., default ports, fragment, tracking parameters and trailing slash; query sorted; no scheme."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"(?i)^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r":(80|443)$", ""), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _entries(entries: Column) -> Column:
    """Entries of headers with their names in lower case first, in order; those without a name go."""
    return F.array_sort(F.transform(F.filter(entries, lambda e: e["key"].isNotNull()), lambda e: F.struct(F.lower(e["key"]).alias("k"), e["key"].alias("as"), e["value"].alias("v"))))


def with_merged(df: DataFrame, stored: Column, fresh: Column, name: str) -> DataFrame:
    """``df`` with ``name``: the stored headers (entries of a map), updated by the permitted ones of the fresh answer. Names are in lower case; of names that differ by case the first counts.

    Each step is a column of its own, so the lambdas of the next refer to it and don't hold it.
    """
    old, new = private(df, "_stored", "_fresh")
    none = F.array().cast("array<struct<key:string,value:string>>")
    first = lambda c: F.filter(c, lambda e, i: (i == 0) | (e["k"] != F.get(F.col(c), i - 1)["k"]))
    steps = df.withColumns({old: _entries(F.coalesce(stored, none)), new: _entries(F.coalesce(F.map_entries(fresh), none))})
    steps = steps.withColumns({old: first(old), new: F.filter(first(new), lambda e: e["k"].isin(*PERMITTED))})
    kept = F.filter(old, lambda e: ~F.exists(new, lambda n: n["k"] == e["k"]))
    both = F.transform(F.concat(kept, new), lambda e: F.struct(e["k"].alias("key"), e["v"].alias("value")))
    return steps.withColumn(name, F.map_from_entries(both)).drop(old, new)


def _opaque(etag: Column) -> Column:
    """An entity tag without the mark of a weak one."""
    return F.regexp_replace(F.trim(etag), "^[Ww]/", "")


def resolve(records: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """The revisits of ``records`` with ``found_id``, ``found_ts``, ``agrees`` and ``merged_headers`` (null where nothing is found or the validators disagree).

    records: record_id, url, ts (timestamp), kind ('response' or 'revisit'), etag, modified, headers, and any other columns.
    """
    out = ("found_id", "found_ts", "agrees", "merged_headers")
    url, part, late, own, last, before, found_ = private(records, "_url", "_slice", "_late", "_own", "_last", "_before", "_found")
    keyed = records.withColumns({url: canonical(F.col("url")), part: F.floor(F.unix_micros("ts") / (slice_seconds * 1_000_000)), late: (F.col("kind") == "response").cast("int")})
    timed = F.col(url).isNotNull() & F.col("ts").isNotNull()
    placed = keyed.filter(timed & F.col("kind").isin("response", "revisit"))
    lost = keyed.filter((F.col("kind") == "revisit") & ~timed)
    page = F.when(F.col(late) == 1, F.struct(F.col("ts"), F.col("record_id").alias("id"), "etag", "modified", F.array_sort(F.map_entries("headers")).alias("headers")))
    order = Window.partitionBy(url, part).orderBy("ts", late, "record_id").rowsBetween(Window.unboundedPreceding, -1)
    mine = placed.withColumn(own, F.last(page, ignorenulls=True).over(order)).filter("kind = 'revisit'")
    lasts = placed.filter(F.col(late) == 1).groupBy(url, part).agg(F.max(page).alias(last))
    slices = placed.select(url, part).distinct().join(lasts, [url, part], "left")
    earlier = Window.partitionBy(url).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    earlier = slices.withColumn(before, F.last(last, ignorenulls=True).over(earlier)).select(url, part, before)
    joined = mine.join(earlier, [url, part], "left").withColumn(found_, F.coalesce(own, before))
    joined = joined.unionByName(lost, allowMissingColumns=True)
    found = F.col(found_)
    same = F.coalesce(_opaque(F.col("etag")) == _opaque(found["etag"]), F.col("modified") == found["modified"])
    kept = [F.col(c) for c in records.columns if c not in out]
    (headers,) = private(joined, "_merged")
    return with_merged(joined, found["headers"], F.col("headers"), headers).select(
        *kept,
        found["id"].alias("found_id"),
        found["ts"].alias("found_ts"),
        F.when(found.isNotNull(), same).alias("agrees"),
        F.when(found.isNotNull() & F.coalesce(same, F.lit(True)), F.col(headers)).alias("merged_headers"),
    )


def page_records(pages: DataFrame) -> DataFrame:
    """Each page as a full response at second page_id of the crawl, and as a revisit half a second after page 10 * page_id,
    whose validator is its own digest: it agrees unless the URL has been captured with another content since."""
    start = F.timestamp_seconds(F.col("page_id").cast("double"))
    again = F.timestamp_seconds(F.col("page_id") * 10 + F.lit(0.5))
    header = lambda name: F.create_map(F.lit("ETag"), F.md5("html"), F.lit(name), F.length("html").cast("string"))
    row = lambda ts, kind, headers: pages.select(F.col("page_id").alias("record_id"), "url", ts.alias("ts"), F.lit(kind).alias("kind"), F.md5("html").alias("etag"), F.lit(None).cast("string").alias("modified"), headers.alias("headers"))
    return row(start, "response", header("Content-Length")).unionByName(row(again, "revisit", header("Expires")))


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve(page_records(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    headers = F.array_join(F.transform(F.array_sort(F.map_entries("merged_headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return found.select(F.col("record_id").alias("page_id"), canonical(F.col("url")).alias("canonical_url"), "found_id", F.unix_micros("found_ts").alias("found_us"), "agrees", headers.alias("headers"))


OP3_SQL = r"""
WITH p AS (
  SELECT page_id, html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '') AS bare FROM pages
), parts AS (
  SELECT page_id, html,
    regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*', 0)), ':(80|443)$', ''), '^(www|m)\.', '') AS host,
    regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|ref|fbclid|gclid|sid|sessionid)='))) AS q
  FROM p
), c AS (
  SELECT page_id, md5(html) AS etag, length(html) AS n, host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS curl FROM parts
), best AS (
  SELECT v.page_id, max(r.page_id) AS found_id FROM c v JOIN c r ON v.curl = r.curl AND r.page_id < v.page_id * 10 + 0.5 GROUP BY 1
)
SELECT v.page_id, v.curl AS canonical_url, b.found_id, b.found_id * 1000000 AS found_us, r.etag = v.etag AS agrees,
  CASE WHEN r.etag = v.etag THEN 'content-length=' || r.n || ';etag=' || v.etag || ';expires=' || v.n END AS headers
FROM c v LEFT JOIN best b USING (page_id) LEFT JOIN c r ON r.page_id = b.found_id
"""
