"""URL filter: captures against dated lists, as of their fetch date.

List events (key, day, seq, action) become validity intervals: an event holds from
its day until the next event of its key; ``remove`` ends an entry without a new one.
A key is a host, a parent domain, or a host and its first path segment
("host/segment").  A capture is blocked or allowed by the most specific key that is
active on its fetch day: path before host before parent domains, longer ones first.

A verdict depends on (host, segment, day) only.  Captures are reduced to these
distinct triples before the as-of join, so a host with a third of all captures brings
its distinct segments and days, not its captures, and the verdicts return by an
equi-join.  Everything is DataFrame functions.

Null or unparsable urls have no host and match nothing (verdict ``none``); captures
without a date match nothing; events without key, day or action are ignored; of
events of one key and day the highest seq holds.  Repeated rows get equal verdicts,
extra columns are not read, empty tables give no rows or no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
SEGMENT = "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)"
#: Fixed values of the query's lists: first day, days, events of a listed key.
FIRST_DAY, DAYS, EVENTS = "2024-01-01", 366, 3


def intervals(events: DataFrame) -> DataFrame:
    """(key, action, since, until): until is exclusive, null while the entry holds."""
    order = Window.partitionBy("key").orderBy("day", "seq")
    e = events.filter("key is not null and day is not null and action is not null")
    e = e.select("key", "action", F.col("day").alias("since"), F.lead("day").over(order).alias("until"))
    return e.filter("action in ('block', 'allow') and (until is null or until > since)")


def with_parts(captures: DataFrame) -> DataFrame:
    """Adds host, segment and fetch day; url and day are read."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    return captures.select("*", host.alias("host"), F.regexp_extract(F.coalesce("url", F.lit("")), SEGMENT, 1).alias("segment"))


def keys_of(triples: DataFrame) -> DataFrame:
    """A row for each key of a triple with its rank, the path highest."""
    labels = F.split("host", "[.]")
    parents = F.expr("""transform(sequence(1, greatest(size(labels) - 1, 1)),
        i -> named_struct('rank', size(labels) - i + 1, 'key', array_join(slice(labels, i, size(labels)), '.')))""")
    path = F.when(F.col("segment") != "", F.array(F.struct(F.lit(1000).alias("rank"), F.concat("host", F.lit("/"), "segment").alias("key")))).otherwise(
        F.expr("cast(array() as array<struct<rank:int,key:string>>)"))
    return (triples.filter("host <> '' and day is not null").withColumn("labels", labels)
            .select("host", "segment", "day", F.explode(F.concat(parents, path)).alias("k")).select("host", "segment", "day", "k.rank", "k.key"))


def verdicts(captures: DataFrame, events: DataFrame) -> DataFrame:
    """``captures`` (url, day) with host, n_active entries, verdict, matched key and since."""
    parts = with_parts(captures)
    triples = parts.select("host", "segment", "day").distinct()
    hits = keys_of(triples).join(intervals(events), "key").filter("since <= day and (until is null or day < until)")
    best = hits.groupBy("host", "segment", "day").agg(
        F.count("*").alias("n_active"), F.max(F.struct("rank", "key", "action", "since")).alias("m"))
    out = parts.join(best, ["host", "segment", "day"], "left")
    verdict = F.when(F.col("m.action") == "block", "blocked").when(F.col("m.action") == "allow", "allowed").otherwise("none")
    return out.select(*[F.col(c) for c in captures.columns], "host", F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
                      verdict.alias("verdict"), F.col("m.key").alias("matched"), F.col("m.since").alias("since"))


def _draw(*parts) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 8), 16, 10).cast("long")


def derived_events(pages: DataFrame) -> DataFrame:
    """Dated list events for hosts, domains and paths of the pages: a third of the keys
    is listed, day and action of each event are drawn by a hash of key and number."""
    triples = with_parts(pages.select("url")).select("host", "segment", F.to_date(F.lit(FIRST_DAY)).alias("day")).distinct()
    keys = keys_of(triples).select("key").distinct().filter(_draw(F.lit("listed"), "key") % 3 == 0)
    e = keys.select("key", F.explode(F.sequence(F.lit(1), F.lit(EVENTS))).alias("seq"))
    action = F.element_at(F.array(F.lit("block"), F.lit("allow"), F.lit("remove")), (_draw(F.lit("action"), "key", "seq") % 3 + 1).cast("int"))
    return e.select("key", F.date_add(F.to_date(F.lit(FIRST_DAY)), (_draw(F.lit("day"), "key", "seq") % DAYS).cast("int")).alias("day"), "seq", action.alias("action"))


def op4_query(pages: DataFrame) -> DataFrame:
    """All pages; a page's fetch day is drawn from its id."""
    day = F.date_add(F.to_date(F.lit(FIRST_DAY)), F.pmod(F.col("page_id") * 37, F.lit(DAYS)).cast("int"))
    out = verdicts(pages.select("page_id", "url", day.alias("day")), derived_events(pages))
    return out.select("page_id", "host", F.col("day").cast("string").alias("fetch_day"), "n_active", "verdict", "matched", F.col("since").cast("string").alias("since"))


def _sql_keys(triples: str) -> str:
    return f"""
  SELECT host, segment, day, len(labels) - i + 1 AS rank, array_to_string(labels[i:], '.') AS key
  FROM (SELECT *, string_split(host, '.') AS labels, unnest(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1)) AS i
        FROM {triples} WHERE host <> '' AND day IS NOT NULL)
  UNION ALL
  SELECT host, segment, day, 1000 AS rank, host || '/' || segment AS key FROM {triples}
  WHERE host <> '' AND segment <> '' AND day IS NOT NULL"""


def _sql_draw(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 8) AS BIGINT)"


OP4_SQL = f"""
WITH p AS (SELECT page_id, lower(regexp_extract(coalesce(url, ''), '{HOST}', 1)) AS host,
                  regexp_extract(coalesce(url, ''), '{SEGMENT}', 1) AS segment,
                  DATE '{FIRST_DAY}' + CAST(((page_id * 37 % {DAYS}) + {DAYS}) % {DAYS} AS INTEGER) AS day FROM pages),
t AS (SELECT DISTINCT host, segment, day FROM p),
k AS ({_sql_keys('t')}),
listed AS (SELECT DISTINCT key FROM k WHERE {_sql_draw("'listed'", 'key')} % 3 = 0),
ev AS (SELECT key, seq, DATE '{FIRST_DAY}' + CAST({_sql_draw("'day'", 'key', 'seq')} % {DAYS} AS INTEGER) AS day,
              ['block', 'allow', 'remove'][CAST({_sql_draw("'action'", 'key', 'seq')} % 3 + 1 AS INTEGER)] AS action
       FROM (SELECT key, unnest(range(1, {EVENTS + 1})) AS seq FROM listed)),
iv AS (SELECT key, action, day AS since, lead(day) OVER (PARTITION BY key ORDER BY day, seq) AS until FROM ev),
h AS (SELECT k.host, k.segment, k.day, count(*) AS n_active,
             arg_max({{'key': k.key, 'action': iv.action, 'since': iv.since}}, k.rank) AS m
      FROM k JOIN iv ON k.key = iv.key AND iv.since <= k.day AND (iv.until IS NULL OR k.day < iv.until)
      WHERE iv.action <> 'remove' GROUP BY ALL)
SELECT page_id, p.host, CAST(p.day AS VARCHAR) AS fetch_day, coalesce(n_active, 0) AS n_active,
       CASE m.action WHEN 'block' THEN 'blocked' WHEN 'allow' THEN 'allowed' ELSE 'none' END AS verdict,
       m.key AS matched, CAST(m.since AS VARCHAR) AS since
FROM p LEFT JOIN h ON p.host = h.host AND p.segment = h.segment AND p.day = h.day"""
