"""URL filters by dated lists: entries become intervals, captures are joined as of their time.

A list entry (entry_key, action, since) says that from `since` on a key is blocked or allowed,
until the key's next entry. A key is a domain, which covers its hosts, or a host with the
first part of a path (`host/part`). A capture is judged by the entries active when it was
fetched; the longest matching key decides.

Intervals and captures meet by key and by `SLOT` seconds of time: an interval has a row in
each slot it lies in, so a key that many captures share is spread over time, and a capture
meets the few intervals of its slot only.

Defined cases: of entries for one key and time, block wins; a capture without url or time,
or before all entries, is not blocked; repeated captures are judged each; captures without
id as well; hosts and keys compare in lower case; null keys, actions and times of entries are left
out. Only SQL functions are used.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SLOT = 30 * 86400


def host(url: Column) -> Column:
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def first_part(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*/([^/?#]+)", 1)


def url_keys(url: Column) -> Column:
    """(key, rank) pairs a list may name: the domains above a host, the host, host/part."""
    labels = F.split(host(url), r"\.")
    size = F.size(labels)
    domains = F.transform(
        F.sequence(F.lit(1), size),
        lambda n: F.struct(
            F.array_join(F.slice(labels, size - n + 1, n), ".").alias("key"), n.alias("rank")
        ),
    )
    part = F.array(
        F.struct(
            F.lower(F.concat(host(url), F.lit("/"), first_part(url))).alias("key"),
            (size + 1).alias("rank"),
        )
    )
    return F.when(host(url) != "", F.concat(domains, part))


def intervals(entries: DataFrame) -> DataFrame:
    """key, action, since, until (null: still active); one entry per key and time."""
    dated = (
        entries.where("entry_key is not null and action is not null and since is not null")
        .groupBy(F.lower("entry_key").alias("key"), "since")
        .agg(F.max("action").alias("action"))  # "block" comes after "allow"
    )
    until = F.lead("since").over(W.partitionBy("key").orderBy("since"))
    return dated.withColumn("until", until)


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """capture_id, url, fetched, blocked, entry_key, since: a row per row of `captures`.

    `captures` has capture_id, url, fetched; entry_key and since name the entry that decides.
    """
    second = F.col("fetched").cast("timestamp").cast("long")
    last = captures.agg(F.max(second)).first()[0]
    slot = F.floor(second / SLOT)
    begin = F.floor(F.col("since").cast("timestamp").cast("long") / SLOT)
    end = F.coalesce(F.col("until").cast("timestamp").cast("long"), F.lit(last))
    end = F.floor(F.least(end, F.lit(last)) / SLOT)
    active = (
        intervals(entries)
        .where(begin <= end)
        .select("key", "action", "since", "until", F.explode(F.sequence(begin, end)).alias("slot"))
    )
    match = (F.col("since") <= F.col("fetched")) & (
        F.col("until").isNull() | (F.col("fetched") < F.col("until"))
    )
    # A url fetched at one time has one verdict, however often it is listed.
    rows = captures.select("capture_id", "url", "fetched")
    keyed = (
        rows.groupBy("url", "fetched")
        .agg(F.count("*").alias("n"))
        .select("url", "fetched", slot.alias("slot"), F.explode(url_keys(F.col("url"))).alias("k"))
        .select("url", "fetched", "slot", "k.key", "k.rank")
    )
    hits = (
        keyed.join(active, ["key", "slot"])
        .where(match)
        .groupBy("url", "fetched")
        .agg(F.max_by(F.struct("key", "action", "since"), "rank").alias("hit"))
    )
    return rows.join(hits, ["url", "fetched"], "left").select(
        "capture_id",
        "url",
        "fetched",
        F.coalesce(F.col("hit.action") == "block", F.lit(False)).alias("blocked"),
        F.col("hit.key").alias("entry_key"),
        F.col("hit.since").alias("since"),
    )


def dated_list(pages: DataFrame) -> DataFrame:
    """entry_key, action, since: a list made from `pages`, whose hosts come and go on it.

    Every host is blocked, allowed and blocked again at times that follow from its pages;
    every host's path parts are allowed, then blocked.
    """
    day = F.lit("2024-01-01").cast("timestamp").cast("long")

    def dated(keys: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
        start = F.col("first") * 31 % 300
        rows = F.array(
            *(
                F.struct(
                    F.lit(action).alias("action"),
                    (day + (start + offset) * 86400).cast("timestamp").alias("since"),
                )
                for action, offset in steps
            )
        )
        return keys.select("entry_key", F.explode(rows).alias("e")).select("entry_key", "e.*")

    def seen(key: Column) -> DataFrame:
        return (
            pages.select(key.alias("entry_key"), "page_id")
            .where("entry_key <> ''")
            .groupBy("entry_key")
            .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        )

    url = F.col("url")
    part = F.when(first_part(url) != "", F.concat(host(url), F.lit("/"), first_part(url)))
    hosts = [
        ("block", F.lit(0)),
        ("allow", 20 + F.col("n") % 40),
        ("block", 100 + F.col("first") % 60),
    ]
    parts = [("allow", 10 + F.col("n") % 50), ("block", 90 + F.col("first") % 30)]
    return dated(seen(host(url)), hosts).union(dated(seen(part), parts))


def captures_of(pages: DataFrame) -> DataFrame:
    """capture_id, url, fetched: every page with a time in 2024 that follows from its id."""
    day = F.lit("2024-01-01").cast("timestamp").cast("long")
    second = day + F.col("page_id") * 7919 % 366 * 86400 + F.col("page_id") * 104729 % 86400
    return pages.select(
        F.col("page_id").alias("capture_id"), "url", second.cast("timestamp").alias("fetched")
    )


ORACLE = r"""
WITH p AS (
  SELECT page_id, url,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         regexp_extract(url, '^[^:/?#]+://[^/?#]*/([^/?#]+)', 1) AS part,
         TIMESTAMP '2024-01-01' + to_days(CAST(page_id * 7919 % 366 AS INTEGER))
           + to_seconds(page_id * 104729 % 86400) AS fetched
  FROM pages),
keys AS (
  SELECT host AS k, min(page_id) AS f, count(*) AS n, 1 AS kind FROM p WHERE host <> '' GROUP BY host
  UNION ALL
  SELECT host || '/' || part, min(page_id), count(*), 2 FROM p WHERE part <> '' GROUP BY 1),
entries AS (
  SELECT lower(k) AS k, action, TIMESTAMP '2024-01-01' + to_days(CAST(f * 31 % 300 + o AS INTEGER)) AS since
  FROM (
    SELECT k, f, 'block' AS action, 0 AS o FROM keys WHERE kind = 1
    UNION ALL SELECT k, f, 'allow', 20 + n % 40 FROM keys WHERE kind = 1
    UNION ALL SELECT k, f, 'block', 100 + f % 60 FROM keys WHERE kind = 1
    UNION ALL SELECT k, f, 'allow', 10 + n % 50 FROM keys WHERE kind = 2
    UNION ALL SELECT k, f, 'block', 90 + f % 30 FROM keys WHERE kind = 2)),
dated AS (SELECT k, since, max(action) AS action FROM entries GROUP BY k, since),
spans AS (SELECT *, lead(since) OVER (PARTITION BY k ORDER BY since) AS until FROM dated),
own AS (
  SELECT page_id, fetched, array_to_string(list_slice(l, len(l) - n + 1, len(l)), '.') AS k, n AS rank
  FROM (SELECT page_id, fetched, l, unnest(range(1, len(l) + 1)) AS n
        FROM (SELECT page_id, fetched, string_split(host, '.') AS l FROM p WHERE host <> ''))
  UNION ALL
  SELECT page_id, fetched, lower(host || '/' || part), len(string_split(host, '.')) + 1 FROM p
  WHERE host <> ''),
hits AS (
  SELECT page_id, arg_max(s.k, rank) AS k, arg_max(action, rank) AS action, arg_max(since, rank) AS since
  FROM own JOIN spans s ON own.k = s.k AND fetched >= since AND (until IS NULL OR fetched < until)
  GROUP BY page_id)
SELECT p.page_id AS capture_id, url, fetched, coalesce(action = 'block', false) AS blocked,
       hits.k AS entry_key, since
FROM p LEFT JOIN hits USING (page_id)
"""
