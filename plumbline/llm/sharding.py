"""Operator 4: placement of keys on shards by a permutation-filled lookup table.

Every shard orders the slots of a prime-sized table by its own permutation (offset and skip from a hash
of its name); the shards take turns, each claiming its next free slot, until the table is full. Shares
differ by one slot at most, and adding or removing a shard moves few other keys. A key's slot is a
hash modulo the table size, so placement is one hash and one lookup in a broadcast table of fixed size.

Placement is pure DataFrame work. Filling is a loop over table_size slots on the driver and does not
depend on the data. Defined cases: a null key is placed as the empty string, equal keys share a shard,
an empty input gives no rows; input columns named ``slot`` or ``shard`` are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARDS = [f"shard-{i:02d}" for i in range(16)]
#: Prime, and over sixty slots for each of the 16 shards.
TABLE_SIZE = 1021
#: The broadcast table is at most this long.
MAX_TABLE = 1_000_003


def _digest(x: str) -> int:
    return int(hashlib.md5(x.encode()).hexdigest()[:15], 16)


def fill(shards: list[str], size: int) -> list[int]:
    """The index of the shard that owns each slot; shards take turns in the order given."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names")
    if size < len(shards) or size > MAX_TABLE or any(size % p == 0 for p in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be a prime, at least the number of shards")
    place = [_digest(f"offset:{s}") % size for s in shards]
    skip = [_digest(f"skip:{s}") % (size - 1) + 1 if size > 2 else 1 for s in shards]
    owner, left = [-1] * size, size
    while left:
        for i in range(len(shards)):
            while owner[place[i]] >= 0:
                place[i] = (place[i] + skip[i]) % size
            owner[place[i]] = i
            left -= 1
            if not left:
                break
    return owner


def slot(key: Column, size: int) -> Column:
    """The key's slot: 60 bits of md5, so that any engine gives the same."""
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long") % size).cast("int")


def lookup_table(spark, shards: list[str] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """(slot int, shard string), one row per slot."""
    names = F.array(*map(F.lit, shards))
    owner = fill(shards, size)
    rows = ",".join(map(str, owner))
    owners = F.split(F.lit(rows), ",")
    one = spark.range(1).select(F.posexplode(owners).alias("slot", "owner"))
    return one.select("slot", F.element_at(names, F.col("owner").cast("int") + 1).alias("shard"))


def assign(df: DataFrame, key: str, shards: list[str] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with ``slot`` and ``shard``: one broadcast join, no shuffle, so a hot key costs nothing."""
    rest = df.select([c for c in df.columns if c not in ("slot", "shard")])
    placed = rest.withColumn("slot", slot(F.col(key), size))
    return placed.join(F.broadcast(lookup_table(df.sparkSession, shards, size)), "slot", "left").select(*rest.columns, "slot", "shard")


def write(df: DataFrame, path: str, key: str, shards: list[str] = SHARDS, size: int = TABLE_SIZE, max_rows: int = 1_000_000) -> None:
    """Write ``df`` under ``path/shard=.../``; files hold ``max_rows`` rows at most and no task gathers a shard."""
    assign(df, key, shards, size).write.option("maxRecordsPerFile", max_rows).partitionBy("shard").parquet(path)


def op4(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return assign(docs.select("doc_id", "source"), "doc_id")


_NAMES = ", ".join(f"'{s}'" for s in SHARDS)
#: The oracle fills the table with a recursive query, one claim a step.
OP4_SQL = f"""
WITH RECURSIVE shards AS (SELECT unnest(range({len(SHARDS)})) AS i, unnest([{_NAMES}]) AS shard),
prefs AS (SELECT i, shard,
    ('0x' || substr(md5('offset:' || shard), 1, 15))::BIGINT % {TABLE_SIZE} AS o,
    ('0x' || substr(md5('skip:' || shard), 1, 15))::BIGINT % {TABLE_SIZE - 1} + 1 AS s FROM shards),
orders AS (SELECT i, list((o + j * s) % {TABLE_SIZE} ORDER BY j) AS perm FROM prefs, range({TABLE_SIZE}) t(j) GROUP BY i),
fill AS (
  SELECT 0 AS step, []::BIGINT[] AS taken
  UNION ALL
  SELECT step + 1, list_append(taken, list_filter(perm, lambda x: NOT list_contains(taken, x))[1])
  FROM fill JOIN orders ON i = step % {len(SHARDS)} WHERE step < {TABLE_SIZE}),
owners AS (SELECT taken[k] AS slot, (k - 1) % {len(SHARDS)} AS i FROM (SELECT taken FROM fill WHERE step = {TABLE_SIZE}), range(1, {TABLE_SIZE + 1}) t(k))
SELECT doc_id, source, d.slot::INT AS slot, shard
FROM (SELECT doc_id, source, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {TABLE_SIZE} AS slot FROM documents) d
LEFT JOIN owners USING (slot) LEFT JOIN shards USING (i)
"""
