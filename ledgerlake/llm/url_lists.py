"""Judge page captures by the URL list entries that were active when they were fetched.

A list is a feed of dated changes: on a day a domain, a path prefix or an address is added or removed. Changes of
one entry become validity intervals (from the day of an addition to the day before its next removal). A capture is
judged as of its own day: active entries for its address, each of its path prefixes, its host and every parent domain
count; the most specific one decides, and "allow" beats "block" among equals. Only DataFrame functions are used.

Skew: hosts are made distinct before parent domains are looked up, and paths before their prefixes are, so a host that
owns a third of all captures costs one row there; captures themselves are joined by key to tables with one row per key, in joins that AQE may
split. What one key can gather is bounded by the days and the lists there are, not by captures.

Defined cases: a null, blank or unparsable address, a host of over 253 characters and a null day match nothing
("none", kept); on one day an addition beats a removal; entries with a null field are void; repeated captures are
each judged; prefixes are host and whole path segments without a closing slash, of any number, and longer ones are more
specific; an empty feed or table gives "none" or no rows; further columns pass through, and only names that
begin with "_" are reserved.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import table

ENTRY_FIELDS = ("list", "action", "kind", "value", "change", "dated")
MAX_HOST = 253
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://"
HOST = SCHEME + r"(?:[^/?#@]*@)?([^/?#:@]+)"
SEGMENT = SCHEME + r"[^/?#]*/([^/?#]+)"
PATH = SCHEME + r"[^/?#]*/([^?#]+)"
REST = SCHEME + r"[^/?#]*([^#]*)"
#: How specific a match is: an address, a path prefix (and its number of segments), else the number of labels of the domain.
RANK = {"url": 2_000_000_000, "prefix": 1000}


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, HOST, 1))
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when((F.length(host) > 0) & (F.length(host) <= MAX_HOST), host)


def prefix_of(url: Column) -> Column:
    """Host and first path segment."""
    segment = F.regexp_extract(url, SEGMENT, 1)
    return F.when(segment != "", F.concat(host_of(url), F.lit("/"), segment))


def path_of(url: Column) -> Column:
    """Host and all path segments."""
    path = F.regexp_extract(url, PATH, 1)
    return F.when(path != "", F.concat(host_of(url), F.lit("/"), path))


def address_of(url: Column) -> Column:
    """Host, path and query; no scheme, port, fragment or closing slash."""
    return F.concat(host_of(url), F.regexp_replace(F.regexp_extract(url, REST, 1), r"/$", ""))


def intervals(entries: DataFrame) -> DataFrame:
    """list, action, kind, value, since, until (null: still active) of all entries."""
    whole = entries.select(*ENTRY_FIELDS).dropna()
    key = ["list", "action", "kind", "value"]
    daily = whole.groupBy(*key, "dated").agg(F.max(F.col("change") == "add").alias("added"))
    # A window holds the changes of one entry: at most one a day.
    turn = daily.withColumn("before", F.lag("added", 1, False).over(Window.partitionBy(*key).orderBy("dated"))).where("added <> before")
    until = F.lead("dated").over(Window.partitionBy(*key).orderBy("dated"))
    return turn.withColumn("until", until).where("added").select(*key, F.col("dated").alias("since"), "until")


def _depth(prefix: Column) -> Column:
    """Path segments of a prefix."""
    return F.size(F.split(prefix, "/")) - 1


def _rules(valid: DataFrame, kind: str, key: str) -> DataFrame:
    """One row per value: all its intervals."""
    rank = F.size(F.split("value", r"\.")) if kind == "domain" else F.lit(RANK[kind])
    if kind == "prefix":
        rank = rank + _depth(F.col("value"))
    rule = F.struct(rank.alias("rank"), (F.col("action") == "allow").alias("allow"), "list", "kind", "value", "since", "until")
    return valid.where(F.col("kind") == kind).groupBy(F.col("value").alias(key)).agg(F.collect_list(rule).alias(f"{key}_rules"))


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "fetched_on") -> DataFrame:
    """`captures` with verdict (block, allow, none), kept, n_active and the deciding entry's list, kind, value, since."""
    valid = intervals(entries)
    rows = captures.withColumns({"_host": host_of(F.col(url)), "_path": path_of(F.col(url)), "_address": address_of(F.col(url))})
    hosts = rows.select("_host").where(F.col("_host").isNotNull()).distinct()
    labels = F.split("_host", r"\.")
    parents = hosts.withColumn("_domain", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))))
    by_host = parents.join(_rules(valid, "domain", "_domain"), "_domain").groupBy("_host").agg(F.flatten(F.collect_list("_domain_rules")).alias("_host_rules"))
    # Only as many segments as entries have are looked up, so that a path of very many costs no more; one row of depths.
    depths = valid.where("kind = 'prefix'").agg(F.collect_set(_depth(F.col("value"))).alias("_depths"))
    parts = F.split("_path", "/")
    asked = rows.select("_path").where(F.col("_path").isNotNull()).distinct().crossJoin(depths)
    asked = asked.select("_path", F.explode(F.transform(
        F.filter("_depths", lambda k: (k >= 1) & (F.try_element_at(parts, k + 1) != "")), lambda k: F.array_join(F.slice(parts, F.lit(1), k + 1), "/"))).alias("_prefix"))
    by_path = asked.join(_rules(valid, "prefix", "_prefix"), "_prefix").groupBy("_path").agg(F.flatten(F.collect_list("_prefix_rules")).alias("_path_rules"))
    rows = rows.join(by_host, "_host", "left").join(by_path, "_path", "left").join(_rules(valid, "url", "_address"), "_address", "left")
    none = F.slice(F.array(F.struct(
        F.lit(0).alias("rank"), F.lit(False).alias("allow"), F.lit("").alias("list"), F.lit("").alias("kind"), F.lit("").alias("value"),
        F.lit("1970-01-01").cast("date").alias("since"), F.lit("1970-01-01").cast("date").alias("until"))), 1, 0)
    every = F.concat(*[F.coalesce(F.col(c), none) for c in ("_host_rules", "_path_rules", "_address_rules")])
    active = F.filter(every, lambda x: (x["since"] <= F.col(day)) & (x["until"].isNull() | (F.col(day) < x["until"])))
    rows = rows.withColumn("_active", active).withColumn("_best", F.array_max("_active"))
    found = F.col("_best").isNotNull()
    verdict = F.when(~found, "none").when(F.col("_best.allow"), "allow").otherwise("block")
    return rows.select(
        *[F.col(f"`{c}`") for c in captures.columns], F.col("_host").alias("host"), verdict.alias("verdict"), (verdict != "block").alias("kept"),
        F.size("_active").cast("long").alias("n_active"), F.col("_best.list").alias("list"), F.col("_best.kind").alias("kind"),
        F.col("_best.value").alias("value"), F.col("_best.since").alias("since"),
    )


# The given tables hold neither fetch days nor lists; both are derived from the pages by rule: a page is fetched on
# a day of 2024 given by its id, and hosts, their base domains and their sections enter lists by the MD5 of their name.
FIRST_DAY = "2024-01-01"


def derived_captures(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod("page_id", F.lit(366)).cast("int")).alias("fetched_on"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """Feed of changes for every base domain, host, section and address that the rule picks."""
    base = F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1)
    named = pages.select(host_of(F.col("url")).alias("host"), prefix_of(F.col("url")).alias("prefix"), address_of(F.col("url")).alias("address"))
    values = named.select(F.explode(F.array(
        F.struct(F.lit("domain").alias("kind"), base.alias("value")), F.struct(F.lit("domain").alias("kind"), F.col("host").alias("value")),
        F.struct(F.lit("prefix").alias("kind"), F.col("prefix").alias("value")), F.struct(F.lit("url").alias("kind"), F.col("address").alias("value")),
    )).alias("v")).select("v.kind", "v.value").where("value <> ''").distinct()
    number = lambda at: F.conv(F.substring(F.md5(F.concat(F.col("kind"), F.lit(":"), F.col("value")).cast("binary")), at, 4), 16, 10).cast("int")
    drawn = values.withColumns({"pick": number(1) % 8, "first": number(5) % 300, "stay": number(9) % 90 + 1, "again": number(13) % 60 + 1, "often": number(17) % 3})
    day = lambda c: F.date_add(F.lit(FIRST_DAY).cast("date"), c)
    change = lambda c, d: F.struct(F.lit(c).alias("change"), day(d).alias("dated"))
    once = [change("add", F.col("first")), change("remove", F.col("first") + F.col("stay"))]
    twice = [*once, change("add", F.col("first") + F.col("stay") + F.col("again"))]
    feed = F.when(F.col("often") == 0, F.array(once[0])).when(F.col("often") == 1, F.array(*once)).otherwise(F.array(*twice))
    action = F.when(F.col("pick") == 0, "allow").otherwise("block")
    name = F.when(F.col("pick") == 0, "trusted").when(F.col("pick") == 1, "spam").otherwise("abuse")
    picked = drawn.where("pick <= 2").select(name.alias("list"), action.alias("action"), "kind", "value", F.explode(feed).alias("c"))
    return picked.select("list", "action", "kind", "value", "c.change", "c.dated")


def op8_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge(derived_captures(pages), derived_entries(pages))


OP8_SQL = r"""
WITH parsed AS (
  SELECT page_id, url, DATE '2024-01-01' + (page_id % 366)::INT AS fetched_on,
    regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.+$', '') AS h,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) AS segment,
    regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1), '/$', '') AS rest FROM pages),
named AS (
  SELECT page_id, url, fetched_on, CASE WHEN length(h) BETWEEN 1 AND 253 THEN h END AS host,
    CASE WHEN segment <> '' THEN segment END AS segment, rest FROM parsed),
keyed AS (SELECT *, host || '/' || segment AS prefix, host || rest AS address FROM named),
picked AS (
  SELECT DISTINCT * FROM (
    SELECT 'domain' AS kind, regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) AS value FROM keyed
    UNION ALL SELECT 'domain', host FROM keyed UNION ALL SELECT 'prefix', prefix FROM keyed UNION ALL SELECT 'url', address FROM keyed)
  WHERE value <> ''),
drawn AS (
  SELECT kind, value, ('0x' || m[1:4])::INT % 8 AS pick, ('0x' || m[5:8])::INT % 300 AS first, ('0x' || m[9:12])::INT % 90 + 1 AS stay,
    ('0x' || m[13:16])::INT % 60 + 1 AS again, ('0x' || m[17:20])::INT % 3 AS often
  FROM (SELECT *, md5(kind || ':' || value) AS m FROM picked)),
feed AS (
  SELECT CASE pick WHEN 0 THEN 'trusted' WHEN 1 THEN 'spam' ELSE 'abuse' END AS list, pick = 0 AS allow, kind, value, c AS change,
    DATE '2024-01-01' + d::INT AS dated
  FROM (SELECT *, 'add' AS c, first AS d FROM drawn UNION ALL SELECT *, 'remove', first + stay FROM drawn WHERE often >= 1
        UNION ALL SELECT *, 'add', first + stay + again FROM drawn WHERE often = 2)
  WHERE pick <= 2),
candidates AS (
  SELECT page_id, 'url' AS kind, address AS value, 2000 AS rank FROM keyed UNION ALL SELECT page_id, 'prefix', prefix, 1000 FROM keyed
  UNION ALL SELECT page_id, 'domain', array_to_string(labels[k:], '.'), len(labels) - k + 1
  FROM (SELECT page_id, string_split(host, '.') AS labels, unnest(range(1, len(string_split(host, '.')) + 1)) AS k FROM keyed WHERE host IS NOT NULL)),
asked AS (SELECT c.*, k.fetched_on FROM candidates c JOIN keyed k USING (page_id) WHERE value IS NOT NULL),
latest AS (
  SELECT a.page_id, a.rank, f.allow, f.list, a.kind, a.value, f.dated AS since
  FROM asked a ASOF JOIN feed f ON a.kind = f.kind AND a.value = f.value AND a.fetched_on >= f.dated
  WHERE f.change = 'add'),
best AS (
  SELECT page_id, count(*) AS n, max(struct_pack(rank, allow, list, kind, value, since)) AS b FROM latest GROUP BY page_id)
SELECT page_id, url, fetched_on, host, CASE WHEN b IS NULL THEN 'none' WHEN b.allow THEN 'allow' ELSE 'block' END AS verdict,
  coalesce(b.allow, true) AS kept, coalesce(n, 0)::BIGINT AS n_active, b.list AS list, b.kind AS kind, b.value AS value, b.since AS since
FROM keyed LEFT JOIN best USING (page_id)
"""
