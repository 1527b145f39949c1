"""URL filter: fixed rules, and a list of canonical URLs behind a blocked Bloom filter.

The list is a table of any size. Its canonical URLs are hashed into ``BLOCKS`` blocks of
eight 64-bit words, one bit in each, so the filter has one row per block at most: that
bound makes it safe to broadcast, and a longer list only fills its bits. A page whose eight
bits are all set is a possible hit and goes to an exact hash join with the list, which
removes false positives; all other pages are decided where they are read, without a
shuffle. Everything is a column expression.

Defined cases: a null url, or one without ``://``, has empty host and path, no rule and
the verdict allow; repeated rows are judged row by row; an empty list allows what no rule
blocks. Columns beside page_id and url are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import common

#: Blocks of the filter: 512 KB of bits, whatever the list.
BLOCKS = 1 << 13
WORDS = 8

#: (verdict, host, path); of several that fit, the longest wins.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Words in a host's name that put a page's URL on the list.
TERMS = ("adult", "casino", "pills", "porn", "xxx", "replica")


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(common.lower_az(rest), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, ``m.`` and standard ports, path without a last slash, index
    page or ``.html``, query without tracking; null where there is no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^(www|m)\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"(/index\.html|\.html|/)$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.regexp_replace(query, r"(^|&)(utm_[a-z]+|ref)=[^&]*", "")
    kept = F.regexp_replace(kept, r"^&", "")
    whole = F.concat(host, path, F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("?"), kept)))
    return F.when(host_of(url) != "", whole)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule; null without one."""
    out = F.lit(None).cast("struct<rule:string, verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        shown = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, shown).otherwise(out)
    return out


def listed(pages: DataFrame) -> DataFrame:
    """The list: canonical URLs of pages with a listed term in the host, or a title of
    which at least half the words end in a run of symbols."""
    title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    noisy = 2 * F.regexp_count(title, F.lit(r"[#*$%]{3}|(&amp;){3}")) >= F.regexp_count(title, F.lit(r"[^ ]+"))
    bad = host_of(F.col("url")).rlike("|".join(TERMS)) | ((title != "") & noisy)
    return pages.where(bad).select(canonical(F.col("url")).alias("canonical")).where("canonical is not null").distinct()


def _block(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(BLOCKS))


def _mask(text: Column, word: int) -> Column:
    """The bit of the ``word``-th word of a block that ``text`` sets."""
    at = F.shiftrightunsigned(F.xxhash64(text, F.lit("bits")), 6 * word).bitwiseAND(F.lit(63))
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


def bloom(urls: DataFrame) -> DataFrame:
    """The filter over ``urls.canonical``: (block, w0..w7), at most BLOCKS rows."""
    text = F.col("canonical")
    return urls.groupBy(_block(text).alias("block")).agg(
        *[F.bit_or(_mask(text, i)).alias(f"w{i}") for i in range(WORDS)]
    )


def judge(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict of every row; ``urls`` has canonical."""
    url, text = F.col("url"), F.col("canonical")
    rows = pages.select("page_id", "url").select(
        "page_id",
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        canonical(url).alias("canonical"),
    ).withColumn("fit", rule_of(F.col("host"), F.col("path"))).withColumn("block", _block(text))
    probed = rows.join(F.broadcast(bloom(urls)), "block", "left")
    possible = F.lit(True)
    for i in range(WORDS):
        possible = possible & (F.col(f"w{i}").bitwiseAND(_mask(text, i)) != 0)
    # A rule decides alone, so only pages without one can be hits.
    possible = F.coalesce(possible & F.col("fit").isNull() & text.isNotNull(), F.lit(False))
    probed = probed.withColumn("possible", possible)
    exact = urls.select("canonical", F.lit("block").alias("found")).hint("shuffle_hash")
    hits = probed.where("possible").join(exact, "canonical", "left")
    rest = probed.where("not possible").withColumn("found", F.lit(None).cast("string"))
    return hits.unionByName(rest).select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", "found", F.lit("allow")).alias("verdict"),
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages")
    return judge(pages, listed(pages))


_HOST = """translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""

ORACLE = rf"""
WITH p AS (
  SELECT page_id, html, {_HOST} AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\?([^#]*)', 1),
      '(^|&)(utm_[a-z]+|ref)=[^&]*', '', 'g'), '^&', '') AS query,
    regexp_extract(coalesce(html, ''), '<title>([^<]*)</title>', 1) AS title
  FROM pages),
c AS (
  SELECT page_id, host, path, title,
    CASE WHEN host <> '' THEN
      regexp_replace(regexp_replace(host, '^(www|m)\.', ''), ':(80|443)$', '')
      || regexp_replace(path, '(/index\.html|\.html|/)$', '')
      || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS canonical
  FROM p),
l AS (
  SELECT DISTINCT canonical FROM c
  WHERE canonical IS NOT NULL AND (regexp_matches(host, 'adult|casino|pills|porn|xxx|replica')
    OR (title <> '' AND 2 * len(regexp_extract_all(title, '[#*$%]{{3}}|(&amp;){{3}}'))
      >= len(regexp_extract_all(title, '[^ ]+'))))),
r(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
f AS (
  SELECT c.*, (SELECT r.host || r.path || ' ' || r.verdict FROM r
    WHERE (c.host = r.host OR suffix(c.host, '.' || r.host)) AND prefix(c.path, r.path)
    ORDER BY len(r.host || r.path) DESC LIMIT 1) AS fit
  FROM c)
SELECT page_id, host, path, split_part(fit, ' ', 1) AS rule,
  CASE WHEN fit IS NOT NULL THEN split_part(fit, ' ', 2)
    WHEN canonical IN (SELECT canonical FROM l) THEN 'block' ELSE 'allow' END AS verdict
FROM f
"""
