"""Shards of equal row counts that keep linked documents together: balanced label propagation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import written
from brindle.llm.numbering import positions

CELLS = 64


def link_groups(text: Column) -> list[Column]:
    """Two hashes that equal texts share (null as empty): documents with both alike are linked with each other."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def _quota_moves(wishes: DataFrame, room: DataFrame, turn: int) -> DataFrame:
    """Of the rows that wish to enter a shard, those that its room takes: whole groups first, by their hash.

    Wishes are counted by shard and cell of the group's hash (CELLS counts for each shard at most); cells enter in order
    until the room is used up, and of the cell at which it is, a share of the rows, drawn anew in each turn.
    """
    cell = F.pmod(F.xxhash64("g1", "g2"), F.lit(CELLS)).cast("int")
    wishes = wishes.withColumn("cell", cell)
    counts = wishes.groupBy("wish", "cell").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("wish").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    limits = counts.withColumn("upto", upto).join(F.broadcast(room), F.col("wish") == F.col("in_shard"), "left")
    left = F.coalesce("room", F.lit(0)) - F.col("upto") + F.col("n")
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), left / F.col("n")))
    limits = F.broadcast(limits.select("wish", "cell", share.alias("share")))
    lucky = F.pmod(F.xxhash64(F.lit(turn), "doc_id", "g1"), F.lit(1 << 20)) / float(1 << 20)
    return wishes.join(limits, ["wish", "cell"]).withColumn("moves", lucky < F.col("share")).drop("cell", "share")


def propagate(nodes: DataFrame, quota: int, shards: int, rounds: int) -> DataFrame:
    """Labels (column shard) for linked documents (doc_id, g1, g2), at most about quota to a shard.

    A document starts at a shard of its own hash. In each round the groups' members are counted by shard, a group's
    favourite is the shard with room that has most of its members (of equals one by the group's hash), and documents
    where fewer are wish to move there. Wishes are granted as an exchange: a shard takes as many as it has room for and
    as wish to leave it. Counts of a group have `shards` rows at most, so a group with a third of all rows is joined as
    a few counted rows, never as pairs.
    """
    state = nodes.withColumn("shard", F.pmod(F.xxhash64(F.lit(3), "g1", "doc_id"), F.lit(shards)).cast("int"))
    every = nodes.sparkSession.range(shards).select(F.col("id").cast("int").alias("in_shard"))
    for turn in range(rounds):
        votes = written(state.groupBy("g1", "g2", "shard").agg(F.count("*").alias("votes")), "shard-votes")
        sizes = votes.groupBy("shard").agg(F.sum("votes").alias("n"))
        room = every.join(F.broadcast(sizes), F.col("in_shard") == F.col("shard"), "left").select("in_shard", (quota - F.coalesce("n", F.lit(0))).alias("room"))
        # The open shard with most of a group's members; those where fewer are wish to go there.
        opened = votes.join(F.broadcast(room.filter("room > 0")), F.col("shard") == F.col("in_shard"))
        rank = F.struct("votes", F.xxhash64("g1", "shard").alias("lot"), "shard")
        best = opened.groupBy("g1", "g2").agg(F.max(rank).alias("best"))
        wish = votes.join(best, ["g1", "g2"]).filter(rank < F.col("best")).select("g1", "g2", "shard", "votes", F.col("best.shard").alias("wish"))
        leaving = wish.groupBy("shard").agg(F.sum("votes").alias("leave"))
        room = room.join(F.broadcast(leaving), F.col("in_shard") == F.col("shard"), "left").select("in_shard", F.greatest(F.lit(0).cast("long"), F.col("room") + F.coalesce("leave", F.lit(0))).alias("room"))
        wanted = state.join(wish.drop("votes"), ["g1", "g2", "shard"], "left").select(*state.columns, "wish")
        moving = _quota_moves(wanted.filter("wish is not null"), room, turn)
        moved = moving.withColumn("shard", F.when(F.col("moves"), F.col("wish")).otherwise(F.col("shard"))).select(*state.columns)
        state = written(wanted.filter("wish is null").select(*state.columns).unionByName(moved), "shard-labels")
    return state


def shard_documents(docs: DataFrame, shards: int = 24, rounds: int = 4, slack: float = 0.25) -> DataFrame:
    """Puts every row of docs (doc_id, text) into one of `shards` shards whose row counts differ by one at most.

    Documents with equal texts are linked. Linked documents get labels by propagate(), under quotas `slack` above the
    even size, as labels only bring a group's documents together; documents without links fill the room that is left;
    then all rows are numbered in the order of their labels and groups and cut into equal
    ranges, so a group is cut only where it is larger than a shard's room or lies across a range's end. Null texts are
    empty (and so equal); a null doc_id is a document like others; repeated rows are documents of their own; an empty
    table gives an empty result; with fewer rows than shards some shards stay empty.

    Returns doc_id, size (UTF-8 bytes plus 8), text_crc32, law ('rows'), shard, slot (gapless in a shard) and
    grown_shard (null under this law).
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    g1, g2 = link_groups(F.col("text"))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"), g1.alias("g1"), g2.alias("g2"))
    nodes = written(narrow, "shard-nodes")
    total = nodes.count()
    counted = nodes.groupBy("g1", "g2").agg(F.count("*").alias("n"))
    linked_groups = counted.filter("n > 1").select("g1", "g2")
    quota = max(1, -(-total // shards))
    largest = counted.agg(F.max("n")).first()[0] or 1
    # A group that is larger than a shard fills one shard after the other.
    linked = propagate(nodes.join(linked_groups, ["g1", "g2"], "left_semi"), math.ceil(quota * (1 + slack)), shards, rounds + min(shards, (largest // quota) * 2))
    single = nodes.join(linked_groups, ["g1", "g2"], "left_anti")
    # Documents without links go where room is left, by a hash: bounds has a row for each shard.
    sizes = {r["shard"]: r["n"] for r in linked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    room = [max(0, quota - sizes.get(k, 0)) for k in range(shards)]
    whole = max(1, sum(room))
    upto, filled = 0, F.lit(shards - 1)
    chance = F.pmod(F.xxhash64(F.lit(9), "doc_id", "g1"), F.lit(1 << 30)) / float(1 << 30)
    for k in range(shards - 1, -1, -1):
        upto = sum(room[: k + 1])
        filled = F.when(chance < upto / whole, F.lit(k)).otherwise(filled)
    placed = linked.unionByName(single.withColumn("shard", filled.cast("int")).select(*linked.columns))
    placed = placed.withColumn("cell", F.pmod(F.xxhash64(F.lit(5), "g1", "g2"), F.lit(8 * CELLS)).cast("int"))
    order = positions(placed, ["shard", "cell"], ["g1", "g2"], [F.col("doc_id")], target=max(500, total // 20_000))
    small, more = divmod(total, shards)
    head = more * (small + 1)  # the first `more` shards have a row more
    at = F.col("position")
    shard = F.when(at < head, F.floor(at / (small + 1))).otherwise(more + F.floor((at - head) / max(1, small)))
    slot = F.when(at < head, at % (small + 1)).otherwise((at - head) % max(1, small))
    return order.select(
        "doc_id",
        "size",
        F.col("crc").cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        shard.cast("int").alias("shard"),
        slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
