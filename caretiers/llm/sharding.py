"""Placement by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size. The shards take
turns; each claims the first free slot of its order, until no slot is free. A document's key is hashed
to a slot, and the table, which has a fixed number of rows, is broadcast. A shard that is added or
removed moves little more than its own share of the slots.

A null id counts as the empty key; equal ids go to the same shard; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretiers.llm.common import documents

SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
#: Prime, and a thousand times the number of shards, so that shares differ by about a thousandth.
SLOTS = 65537


def number(text: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{text}".encode(), usedforsecurity=False).hexdigest()[:15], 16)


def lookup_table(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """For each slot the index of the shard that claimed it. ``slots`` must be prime."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct, at least one, and at most as many as slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    place = [number(s, "offset") % slots for s in shards]
    step = [number(s, "skip") % (slots - 1) + 1 for s in shards]
    table = [-1] * slots
    free = slots
    while free:
        for i in range(len(shards)):
            while table[place[i]] >= 0:
                place[i] = (place[i] + step[i]) % slots
            table[place[i]] = i
            free -= 1
            if not free:
                break
    return table


def with_claims(docs: DataFrame, key: str, shards: tuple[str, ...], slots: int) -> DataFrame:
    """``docs`` as ``d`` beside ``c``, the slot and shard of each row."""
    table = ",".join(map(str, lookup_table(shards, slots)))
    names = F.array(*map(F.lit, shards))
    claimed = (
        docs.sparkSession.range(1)
        .select(F.posexplode(F.split(F.lit(table), ",")).alias("slot", "claim"))
        .select(F.col("slot").cast("long").alias("slot"), F.element_at(names, F.col("claim").cast("int") + 1).alias("shard"))
    )
    slot = F.expr(f"pmod(cast(conv(substr(md5(coalesce(cast(d.`{key}` as string), '')), 1, 15), 16, 10) as bigint), {slots}L)")
    return docs.alias("d").join(F.broadcast(claimed).alias("c"), slot == F.col("c.slot"))


def place(docs: DataFrame, key: str = "doc_id", shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``key``, its ``slot`` and its ``shard`` for every row."""
    return with_claims(docs, key, shards, slots).select(f"d.{key}", "c.slot", "c.shard")


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> None:
    """Writes the rows under ``path/_shard=<name>``, their columns unchanged; a large shard is split over tasks."""
    rows = with_claims(docs, key, shards, slots).select("d.*", F.col("c.shard").alias("_shard"))
    rows.hint("rebalance", "_shard").write.partitionBy("_shard").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(documents(spark, sf_dir))
