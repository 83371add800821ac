"""Dealing rows to shards (operator 1), in DataFrame expressions only.

Method: a lookup table filled by permutations. Each shard prefers the slots of a table of prime size in an
order of its own, made of an offset and a step from a digest of its name. Shards take turns; each claims
the first slot of its order that is free, until the table is full. A key's slot is its digest modulo the
table's size, and the slot names the shard. Shards so get shares that differ by one slot, and when a shard
goes, few keys of the others move.

The table is one SQL expression: rounds of turns, in which each shard's order is kept without the slots
claimed in earlier rounds, so a turn looks at no more entries than there are shards. It has ``slots`` rows,
a parameter that does not grow with the data and is checked, and is broadcast; rows are placed without
a shuffle, so a key that very many rows share is no burden.

Defined cases: a null key is a key of its own (the digest of the empty text, which it shares with an empty
key). Rows with the same key go to the same shard. Empty tables give no rows. Names of shards are distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.keys import others

#: A prime, 100 times the number of shards or more, so that shares differ by 1 % at most.
SHARDS, SLOTS = 64, 6421
#: The largest table that is built and broadcast.
MOST_SLOTS = 65_537


def digest(value: Column, salt: str = "") -> Column:
    """52 bits of the MD5 of a text, null as empty."""
    text = F.concat(F.lit(salt), F.coalesce(value.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def lookup_table(spark: SparkSession, names: list[str], slots: int = SLOTS) -> DataFrame:
    """slot, shard (name) for every slot."""
    if len(set(names)) != len(names) or not names:
        raise ValueError("shards need distinct names")
    if slots > MOST_SLOTS or slots < len(names) or slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"the table's size has to be a prime from the number of shards to {MOST_SLOTS}")
    shards, size = F.array(*map(F.lit, names)), F.lit(slots)
    steps = F.transform(
        shards, lambda name: F.struct(F.pmod(digest(name, "offset "), size).alias("first"), (F.pmod(digest(name, "step "), size - 1) + 1).alias("by"))
    )
    orders = F.transform(steps, lambda s: F.transform(F.sequence(F.lit(0).cast("long"), size - 1), lambda j: (s["first"] + j * s["by"]) % size))
    none = F.array().cast("array<bigint>")
    # A shard's order has lost earlier rounds' slots; of its first entries at most one per shard is claimed in this round.
    turn = lambda claimed, order: F.concat(claimed, F.slice(F.array_except(F.slice(order, 1, len(names)), claimed), 1, 1))
    rounds = F.aggregate(
        F.sequence(F.lit(1), F.lit(-(-slots // len(names)))),
        F.struct(orders.alias("orders"), none.alias("claimed")),
        lambda state, _: _next_round(state, turn, none),
        lambda state: state["claimed"],
    )
    # Claims in the order they were made: the n-th claim belongs to shard n modulo the number of shards.
    table = spark.range(1).select(F.posexplode(rounds).alias("turn", "slot"))
    return table.select("slot", F.element_at(shards, (F.col("turn") % len(names) + 1).cast("int")).alias("shard"))


def _next_round(state: Column, turn, none: Column) -> Column:
    now = F.aggregate(state["orders"], none, turn)
    # The round's claims are worked out once and then used twice.
    return F.element_at(
        F.transform(
            F.array(now),
            lambda claims: F.struct(
                F.transform(state["orders"], lambda order: F.array_except(order, claims)).alias("orders"), F.concat(state["claimed"], claims).alias("claimed")
            ),
        ),
        1,
    )


def shard(rows: DataFrame, key: str, names: list[str], slots: int = SLOTS) -> DataFrame:
    """``rows`` with ``slot`` and ``shard`` by ``key``; columns of ``rows`` with these names are replaced."""
    table = F.broadcast(lookup_table(rows.sparkSession, names, slots))  # at most MOST_SLOTS rows
    kept = others(rows, "slot", "shard")
    return rows.select(*kept, F.pmod(digest(F.col(key)), F.lit(slots)).alias("slot")).join(table, "slot").select(*kept, "slot", "shard")


def write_shards(rows: DataFrame, key: str, names: list[str], path: str, slots: int = SLOTS, files: int = 8) -> None:
    """Write ``rows`` below ``path``, a folder per shard with up to ``files`` files, however uneven the keys are."""
    placed = shard(rows, key, names, slots)
    dealt = placed.withColumn("file", F.pmod(F.xxhash64(*others(rows, "shard")), F.lit(files)))
    dealt.repartition(F.col("shard"), F.col("file")).drop("slot", "file").write.partitionBy("shard").parquet(path)


def op1_sharding(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """doc_id, slot and shard of every document."""
    names = [f"shard-{k:03d}" for k in range(shards)]
    return shard(docs.select("doc_id"), "doc_id", names, slots)
