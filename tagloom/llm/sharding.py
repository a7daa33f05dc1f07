"""Placement of documents by a permutation-filled lookup table.

Every shard has an order of preference over the slots of a table of prime size,
given by an offset and a step. The shards take turns; each claims the first free
slot of its order, until none is free (a shard of weight w takes w turns a
round). A document's slot is its hash modulo the table size, so finding its
shard is one look into the table. When a shard is lost, almost only the
documents of its slots move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import local_frame

TABLE_SIZE = 65_537  # prime, about a thousand slots for each of the shards below
SHARDS = {f"shard-{i:02d}": 1 for i in range(64)}


def preference(name: str, size: int) -> tuple[int, int]:
    """Offset and step of a shard's order; any step visits all slots, as the size is prime."""
    digest = hashlib.md5(name.encode()).hexdigest()
    return int(digest[:15], 16) % size, int(digest[15:30], 16) % (size - 1) + 1


def fill(shards: Mapping[str, int], size: int = TABLE_SIZE) -> list[int]:
    """The shard number of every slot; shards are numbered by name, so their order of listing does not matter."""
    if size < 2 or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table size must be prime")
    names = sorted(shards)
    if not names or min(shards.values()) < 0 or not any(shards.values()):
        raise ValueError("at least one shard needs a positive weight")
    table, free = [-1] * size, size
    orders = [preference(name, size) for name in names]
    at = [offset for offset, _ in orders]
    while True:
        for number, name in enumerate(names):
            for _ in range(shards[name]):
                while table[at[number]] >= 0:
                    at[number] = (at[number] + orders[number][1]) % size
                table[at[number]] = number
                free -= 1
                if not free:
                    return table


def slot_of(key: str, size: int = TABLE_SIZE):
    """Slot of a key: the first 60 bits of its MD5 digest modulo the size; null keys have the slot of the empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(size))


def place(docs: DataFrame, shards: Mapping[str, int] = SHARDS, size: int = TABLE_SIZE, id_col: str = "doc_id") -> DataFrame:
    """The id, slot and shard of every row.

    Rows of one id go to one shard, null ids to the shard of the empty text; the text is not looked at, so nulls and lengths
    there do not matter. An empty table gives no rows; further columns are ignored. The table has ``size`` rows whatever the
    data, so it is sent to every task; no row is shuffled.
    """
    names = sorted(shards)
    table = local_frame(docs.sparkSession, [(slot, names[n]) for slot, n in enumerate(fill(shards, size))], "_slot long, shard string")
    keyed = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id")).withColumn("slot", slot_of("doc_id", size))
    return keyed.join(F.broadcast(table), F.col("slot") == F.col("_slot")).select("doc_id", "slot", "shard")


def oracle(shards: Mapping[str, int] = SHARDS, size: int = TABLE_SIZE) -> str:
    """The same in SQL, with the filled table as a list."""
    names = sorted(shards)
    numbers = ",".join(str(n) for n in fill(shards, size))
    listed = ",".join(f"'{n}'" for n in names)
    return f"""
        SELECT doc_id, slot, list_extract([{listed}], 1 + list_extract(filled, slot + 1)) AS shard
        FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {size} AS slot FROM documents) d,
             (SELECT [{numbers}] AS filled) t"""
