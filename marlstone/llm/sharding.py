"""Balanced label propagation: documents with equal texts move to one shard while counts stay even. DataFrame functions only.

Law `rows`: the shards' row counts differ by at most one. Documents start dealt evenly by a hash key; that deal
fixes every shard's capacity. The documents of one text (two or more) are a unit; a unit above the capacity is
dealt by rank into ceil(size / capacity) parts, full ones and one rest, each a unit. In each round a unit without a shard
wants, of the shards with room for all of it, the one that holds most of its members; where none of those holds any,
a shard by hash, the likelier the more room it has. Each shard takes larger units first as long as they fit, and units it
has no room for want another one in the next round. Rounds end when no unit is left that fits anywhere; what is left then, fewer units
than shards, is cut into as few pieces as the largest rooms allow. Documents without links stay where they are as
far as there is room and else fill the other shards. So only texts above a shard's capacity and those last units are cut.

Size is the text's UTF-8 bytes plus 8; null text counts as empty and equals it. Null and repeated doc_ids are
rows of their own. An empty table gives no rows.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import discard, hash_key, prefix_sums, ranks, stable, table

SEED = "shard-1:"


def _array(numbers: list[int]) -> Column:
    return F.array(*[F.lit(int(k)).cast("long") for k in numbers])


def _wishes(units: DataFrame, room: list[int]) -> DataFrame:
    """Adds `wish` to the units that fit in some shard; the others go."""
    chance = lambda s: (F.pmod(F.xxhash64("unit", s), F.lit(1 << 30)) + 1) / F.lit(float(1 << 30))
    fits = F.filter(
        F.transform(_array(room), lambda r, s: F.struct(F.coalesce(F.try_element_at("held", s), F.lit(0).cast("long")).alias("own"), (F.log(chance(s)) / F.greatest(r, F.lit(1))).alias("draw"), s.alias("shard"), r.alias("room"))),
        lambda x: x["room"] >= F.col("c"),
    )
    return units.withColumn("wish", F.array_max(fits)["shard"]).where("wish is not null")


def _place(units: DataFrame, room: list[int]) -> tuple[list[DataFrame], DataFrame, list[int]]:
    """Tables (unit, shard) of the units placed whole, those that fit nowhere, and the room left. Units are unit, c, held."""
    placed, room = [], list(room)
    while True:
        # larger units first: a hex digit of the size's power of two, then a hash
        order = F.concat(F.lower(F.hex(F.greatest(F.lit(0), 15 - F.floor(F.log2("c"))))), F.md5(F.col("unit").cast("string")))
        wanting = _wishes(units, room).withColumn("order", order).withColumn("limit", F.element_at(_array(room), F.col("wish") + 1))
        took = stable(prefix_sums(wanting, ["wish"], "c", "order", ["unit"], "before").where("before + c <= limit").select("unit", "c", F.col("wish").cast("int").alias("shard")))
        filled = took.groupBy("shard").agg(F.sum("c").alias("c")).collect()
        if not filled:
            return placed, units, room
        for r in filled:
            room[r["shard"]] -= r["c"]
        placed.append(took.select("unit", "shard"))
        after = stable(units.join(took.select("unit"), "unit", "left_anti"))
        discard(units)
        units = after


def _cut(units: list[tuple[int, int]], room: list[int]) -> tuple[list[tuple[int, int, int, int]], list[int]]:
    """Pieces (unit, lo, hi, shard) of the units (unit, size) that fit nowhere whole: ranks lo to hi go to the shard."""
    pieces, room = [], list(room)
    for unit, size in sorted(units, key=lambda u: (-u[1], u[0])):
        lo = 0
        while lo < size:
            rest = size - lo
            snug = [s for s in range(len(room)) if room[s] >= rest]
            s = min(snug, key=lambda k: (room[k], k)) if snug else max(range(len(room)), key=lambda k: (room[k], -k))
            hi = lo + min(rest, room[s])
            pieces.append((unit, lo, hi, s))
            room[s] -= hi - lo
            lo = hi
    return pieces, room


def _fill(free: DataFrame, room: list[int]) -> DataFrame:
    """(node, shard) of the documents without links: those that fit stay, the others fill what room is left elsewhere."""
    ranked = stable(ranks(free, ["shard"], "key", ["node"], "r"))
    have = {r["shard"]: r["c"] for r in ranked.groupBy("shard").agg(F.count(F.lit(1)).alias("c")).collect()}
    over = [max(0, have.get(s, 0) - room[s]) for s in range(len(room))]
    lack = [max(0, room[s] - have.get(s, 0)) for s in range(len(room))]
    first = [0, *itertools.accumulate(over)][:-1]
    at = lambda numbers: F.element_at(_array(numbers), F.col("shard") + 1)
    turn = at(first) + F.col("r") - at(room)
    other = F.size(F.filter(_array(list(itertools.accumulate(lack))), lambda end: end <= turn))
    return ranked.select("node", F.when(F.col("r") < at(room), F.col("shard")).otherwise(other).cast("int").alias("shard"))


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is `rows`)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("grp"), hash_key(SEED, F.col(id_col)).alias("key"),
    )
    d = stable(ranks(d.withColumn("all", F.lit(0)), ["all"], "key", ["grp", "doc_id"], "node").drop("all"))
    n = d.count()
    room = [n // shards + (s < n % shards) for s in range(shards)]
    whole = max(1, n // shards)
    groups = stable(d.groupBy("grp").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    start = F.pmod("node", F.lit(shards)).cast("int").alias("shard")
    known = stable(d.join(groups, "grp", "left").select("node", "key", "grp", "c", start))
    linked = known.where("c is not null")
    large = ranks(linked.where(F.col("c") > whole), ["grp"], "key", ["node"], "r")
    nodes = stable(
        linked.where(F.col("c") <= whole).select("node", "key", F.xxhash64("grp", F.lit(0).cast("long")).alias("unit"), "shard")
        .unionByName(large.select("node", "key", F.xxhash64("grp", F.floor(F.col("r") / whole).cast("long")).alias("unit"), "shard"))
    )
    held = nodes.groupBy("unit", "shard").agg(F.count(F.lit(1)).alias("own"))
    units = stable(held.groupBy("unit").agg(F.sum("own").alias("c"), F.map_from_entries(F.collect_list(F.struct("shard", "own"))).alias("held")))
    placed, left, room = _place(units, room)
    rest = [(r["unit"], r["c"]) for r in left.select("unit", "c").collect()]  # fewer than there are shards
    pieces, room = _cut(rest, room)
    goes = []
    if placed:
        found = placed[0]
        for p in placed[1:]:
            found = found.unionByName(p)
        goes.append(nodes.select("node", "unit").join(found, "unit").select("node", "shard"))
    if pieces:
        cut = docs.sparkSession.createDataFrame(pieces, "unit long, lo long, hi long, to int")
        few = ranks(nodes.where(F.col("unit").isin([u for u, _ in rest])), ["unit"], "key", ["node"], "r")
        goes.append(few.join(F.broadcast(cut), "unit").where("r >= lo and r < hi").select("node", F.col("to").alias("shard")))
    goes.append(_fill(known.where("c is null").select("node", "key", "shard"), room))
    to = goes[0]
    for g in goes[1:]:
        to = to.unionByName(g)
    placed = d.select("node", "doc_id", "size", "text_crc32", "key").join(to, "node")
    return ranks(placed, ["shard"], "key", ["node"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
