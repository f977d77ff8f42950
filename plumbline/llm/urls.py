"""Operator 2: URL filter by a blocked Bloom filter and an exact hash join.

Listed URLs are brought to a canonical form. A Bloom filter of 256-bit blocks (four longs, one bit set
in each) is built with ``bit_or`` over the list; a page probes one block, so one lookup decides. Possible
hits alone go on to a hash join with the list, which removes the false positives. Everything is DataFrame
expressions. Before the list, ordered host and path rules decide; the longest rule that fits wins.

Defined cases: a null url or one without ``://`` has an empty host and path, fits no rule, and is listed
only if the list holds such a url (canonical form null is never listed); repeated pages and repeated list
entries are judged row by row and count once; an empty list blocks nothing; other input columns stay, whatever their
names, unless they have an output's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (host, path, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Rules are literals of the plan; a longer list belongs in the table of listed URLs.
MAX_RULES = 1_000
#: Listed URLs a block; 256 bits for 16 keys of 4 bits give about 0.3 % of false positives.
KEYS_A_BLOCK = 16
#: A filter of at most so many blocks (40 bytes each, 5 MB) is broadcast; a larger one is joined by shuffle.
BROADCAST_BLOCKS = 1 << 17
#: A list of at most so many URLs is broadcast for the exact join.
BROADCAST_LIST = 20_000
#: Salts of the exact join: a hot URL is dealt over so many tasks.
SALTS = 16


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    """After the first ``://`` up to ``?``, ``#`` or the end; null without ``://``."""
    after = F.substr(url, F.instr(url, "://") + 3)
    return F.when(F.instr(url, "://") > 0, F.substring_index(F.substring_index(after, "#", 1), "?", 1))


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(_lower(F.substring_index(_rest(url), "/", 1)), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    rest = _rest(url)
    return F.coalesce(F.when(F.instr(rest, "/") > 0, F.substr(rest, F.instr(rest, "/"))), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a leading ``www.`` or ``m.`` and path without final slashes; null without a host."""
    h = F.regexp_replace(host(url), r"^(www|m)\.", "")
    return F.when(host(url) != "", F.concat(h, F.regexp_replace(path(url), "/+$", "")))


def fitting_rule(h: Column, p: Column, rules=RULES) -> Column:
    """The longest rule (struct rule, verdict) that fits host and path, or null; ties: the smaller string."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    longest = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    fits = [((h == F.lit(a)) | h.endswith(f".{a}")) & p.startswith(b) for a, b, _ in longest]
    return F.coalesce(*[F.when(f, F.struct(F.lit(a + b).alias("rule"), F.lit(v).alias("verdict"))) for f, (a, b, v) in zip(fits, longest, strict=True)])


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, m0..m3): the filter of ``listed.canonical``; at most ``blocks`` rows, built with partial aggregation."""
    h = F.xxhash64("canonical")
    rows = listed.select(F.pmod(F.xxhash64("canonical", F.lit("block")), F.lit(blocks)).alias("block"), *[_bit(h, i).alias(f"b{i}") for i in range(4)])
    return rows.groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"m{i}") for i in range(4)])


def _bit(h: Column, i: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict; ``listed`` has a column ``url`` of blocked URLs."""
    out = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c not in out]
    canon = listed.select(canonical(F.col("url")).alias("canonical")).where("canonical IS NOT NULL").distinct()
    n = canon.count()
    blocks = max(1, -(-n // KEYS_A_BLOCK))
    h = F.xxhash64("_canonical")
    # the pages' own columns travel as one struct, so they can have any names
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in kept if c != "html"]), F.lit(SALTS))
    probed = pages.select(F.struct(*kept).alias("row"), salt.alias("_salted"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), canonical(F.col(url)).alias("_canonical"))
    probed = probed.withColumn("_fit", fitting_rule(F.col("host"), F.col("path"), rules))
    probed = probed.withColumn("_block", F.when(F.col("_fit").isNull(), F.pmod(F.xxhash64("_canonical", F.lit("block")), F.lit(blocks))))
    filt = bloom(canon, blocks)
    filt = F.broadcast(filt) if blocks <= BROADCAST_BLOCKS else filt
    masks = [(F.col(f"m{i}").bitwiseAND(_bit(h, i)) != 0) for i in range(4)]
    if blocks <= BROADCAST_BLOCKS:
        probed = probed.join(filt, F.col("_block") == F.col("block"), "left")
        probed = probed.withColumn("_maybe", F.coalesce(masks[0] & masks[1] & masks[2] & masks[3], F.lit(False)))
    else:  # pages that a rule has decided have no block and stay out of the shuffle
        open_, decided = probed.where("_block IS NOT NULL"), probed.where("_block IS NULL").withColumn("_maybe", F.lit(False))
        met = open_.join(filt, F.col("_block") == F.col("block"), "left")
        probed = met.withColumn("_maybe", F.coalesce(masks[0] & masks[1] & masks[2] & masks[3], F.lit(False))).select(*open_.columns, "_maybe").unionByName(decided)
    # only possible hits carry a key into the exact join; the others have a null key and never meet the list
    probed = probed.withColumn("_key", F.when(F.col("_maybe"), F.col("_canonical"))).withColumn("_salt", F.when(F.col("_maybe"), F.col("_salted")))
    exact = canon.withColumn("_listed", F.lit(True))
    if n <= BROADCAST_LIST:
        done = probed.join(F.broadcast(exact), F.col("_key") == F.col("canonical"), "left")
    else:
        exact = exact.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        possible, rest = probed.where("_maybe"), probed.where("NOT _maybe").withColumn("_listed", F.lit(None).cast("boolean"))
        hit = possible.join(exact, (F.col("_key") == F.col("canonical")) & (F.col("_salt") == F.col("salt")), "left").drop("canonical", "salt")
        done = hit.unionByName(rest)
    verdict = F.coalesce(F.col("_fit.verdict"), F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow")))
    return done.select(*[F.col("row").getField(c).alias(c) for c in kept], "host", "path", F.col("_fit.rule").alias("rule"), verdict.alias("verdict"))


def repeated(pages: DataFrame, url: str = "url") -> DataFrame:
    """(url): one URL of each canonical form that two or more pages carry, the list that the query blocks."""
    return pages.groupBy(canonical(F.col(url)).alias("_c")).agg(F.count("*").alias("_n"), F.min(url).alias("url")).where("_n > 1 AND _c IS NOT NULL").select("url")


def op2(spark, sf_dir: str) -> DataFrame:
    """Rules first; pages without a rule are blocked if their canonical URL is a crawl trap, on two or more pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, repeated(pages)).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN split_part(split_part(substr(url, instr(url, '://') + 3), '#', 1), '?', 1) END AS rest FROM pages),
hp AS (SELECT page_id, coalesce(translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(CASE WHEN contains(rest, '/') THEN substr(rest, instr(rest, '/')) END, '') AS path FROM u),
c AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '') END AS canonical,
  (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') AS r1,
  (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') AS r2,
  (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') AS r3,
  (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') AS r4 FROM hp)
SELECT page_id, host, path,
  CASE WHEN r2 THEN 'example.net/en/' WHEN r3 THEN 'example.com/de/' WHEN r4 THEN 'org/fr/' WHEN r1 THEN 'net/' END AS rule,
  CASE WHEN r2 THEN 'allow' WHEN r3 THEN 'block' WHEN r4 THEN 'allow' WHEN r1 THEN 'block'
       WHEN canonical IS NOT NULL AND count(*) OVER (PARTITION BY canonical) > 1 THEN 'block' ELSE 'allow' END AS verdict
FROM c
"""
