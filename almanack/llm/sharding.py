"""Even shards that keep linked documents together, by balanced label propagation.

Documents with equal texts are linked. Every round, linked documents look at the shards
their neighbours are in (counts by group and shard) and propose to move to one of their
group's home shards: those with most of the group and most room, as many as its size
needs. A shard accepts whole groups, in an order drawn anew each round, up to its quota and a
little slack; what leaves it in the same round counts as room, so full shards swap rows
in pairs and rings. Rounds go on until one brings hardly more rows home. Rows that are
not at home then, what exceeds a quota, and documents without neighbours are dealt out
last, group by group, and fill every shard to its quota exactly, so row counts are at
most one apart (law "rows") and only groups at the edge of a shard are cut.

Only numbers of proposals by pair of shards and level of the order come to the driver,
at most shards squared times LEVELS.
Rows of a group are interchangeable while they move: a group with a third of all rows is
sixteen counts, needs several shards and gets as many homes. Where rows meet their group
again, a large group is dealt out in cells, as many as its size asks for, and what is
known of it is repeated for each cell; ranks are taken in buckets. So no task gets a group.

Defined cases: a null text has size 1, the crc32 of the empty text, and is linked with
null and empty texts; rows are what is counted, so repeated ids take a slot each and
null ids take one; with fewer rows than shards, some are empty; further columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanack.llm.tables import BROADCAST_IDS, buckets, numbered, text_of
from almanack.session import hand_over

SHARDS = 16
#: Room beyond the quotas while rows move, and the share of the linked rows that a round
#: has to bring home for another one.
SLACK, GAIN = 0.05, 0.01
#: Levels of the order in which groups are accepted; level 0 is for those of several homes.
LEVELS = 64
LAW = "rows"
#: Rows of a cell of a group; smaller groups are one cell.
CELL_ROWS = 250
_GRAIN = 1 << 20


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _literal(values: list, kind: str):
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def accepted(load: np.ndarray, asked: np.ndarray, quota: list[int]) -> tuple[list[int], list[float]]:
    """Up to which level each shard accepts, and which share of that level's rows.

    `asked` counts proposals by shard, wanted shard and level. All are accepted at first;
    shards beyond their quota go down by levels, whereby rows stay in other shards, until
    nothing changes. These are the highest levels that fit together.
    """
    size, levels = len(quota), asked.shape[2]
    upto = np.concatenate((np.zeros((size, size, 1), np.int64), asked.cumsum(axis=2)), axis=2)
    into = upto.sum(axis=0)
    level = [levels] * size

    def filled(t: int) -> int:
        return int(load[t] + into[t, level[t]] - sum(upto[t, u, level[u]] for u in range(size)))

    changed = True
    while changed:
        changed = False
        for t in range(size):
            while level[t] and filled(t) > quota[t]:
                level[t], changed = level[t] - 1, True
    share = []
    for t in range(size):
        more = int(asked[:, t, level[t]].sum()) if level[t] < levels else 0
        share.append(min(1.0, max(0, quota[t] - filled(t)) / more) if more else 0.0)
    return level, share


def propagated(held: DataFrame, quota: list[int], rounds: int | None = None) -> DataFrame:
    """(group, members, shard, n): how many of each group's rows a shard holds, after
    they moved towards their neighbours; rows at home only, all of a group in one shard
    or in as many as it needs. Rows of a group are interchangeable, so counts
    say it all, and a group of any size is as many rows as there are shards."""
    largest, size = max(max(quota), 1), len(quota)
    needed = F.ceil(F.col("members") / largest)
    held = hand_over(held.withColumn("needed", needed), "shards-held")
    ample = [q + math.ceil(q * SLACK) for q in quota]
    before, turn = 0, 0
    wide = F.col("needed") > 1
    mostly = Window.partitionBy("group").orderBy(F.desc("n"), F.xxhash64("group", "shard"))
    home = F.when(wide, F.col("place") <= F.col("needed")).otherwise(F.col("n") == F.col("members"))
    claim = F.when(wide, F.col("members") / F.col("needed")).otherwise(F.col("n"))
    while rounds is None or turn < rounds:
        state = held.withColumn("place", F.row_number().over(mostly))
        totals = state.groupBy("shard").agg(
            F.sum(F.when(home, F.col("n")).otherwise(0)).alias("home"),
            F.sum(F.when(home, claim).otherwise(0.0)).alias("claimed"),
            F.sum("n").alias("load"),
        ).collect()
        load, room = np.zeros(size, np.int64), [float(q > 0) for q in quota]
        for r in totals:
            load[r["shard"]] = r["load"]
            room[r["shard"]] = max(0.0, 1 - r["claimed"] / max(quota[r["shard"]], 1))
        at_home = sum(r["home"] for r in totals)
        if at_home == load.sum() or (turn and at_home - before < GAIN * load.sum()):
            break
        before = at_home
        drawn = F.pmod(F.xxhash64("group", "shard", F.lit(turn)), F.lit(_GRAIN))
        there = F.get(_literal(room, "double"), F.col("shard")) * (1 + drawn / F.lit(float(_GRAIN))) / 2
        worth = F.when(wide, F.col("n").cast("double")).otherwise(F.col("n") / F.col("members") + there)
        best = Window.partitionBy("group").orderBy(F.desc("worth"), F.xxhash64("group", "shard"))
        state = held.withColumn("worth", worth).withColumn("place", F.row_number().over(best))
        homes = state.where(F.col("place") <= F.col("needed"))
        homes = homes.groupBy("group").agg(F.sort_array(F.collect_list("shard")).alias("homes"))  # at most all shards
        wish = F.get("homes", F.pmod(drawn, F.size("homes")).cast("int"))
        stays = F.array_contains("homes", F.col("shard"))
        order = F.when(wide, 0).otherwise(1 + F.pmod(F.xxhash64("group", F.lit(-1 - turn)), F.lit(LEVELS - 1))).cast("int")
        proposed = held.join(homes, "group").withColumn("to", F.when(stays, F.col("shard")).otherwise(wish))
        proposed = proposed.withColumn("order", order)
        asked = np.zeros((size, size, LEVELS), np.int64)
        wishes = proposed.where(F.col("shard") != F.col("to"))
        for f in wishes.groupBy("shard", "to", "order").agg(F.sum("n").alias("n")).collect():
            asked[f["shard"], f["to"], f["order"]] = f["n"]
        level, share = accepted(load, asked, ample)
        upto = F.get(_literal(level, "int"), F.col("to"))
        part = F.floor(F.col("n") * F.get(_literal(share, "double"), F.col("to")))
        go = F.when(F.col("order") < upto, F.col("n")).when(wide & (F.col("order") == upto), part).otherwise(0)
        go = F.when(F.col("shard") == F.col("to"), 0).otherwise(go).cast("bigint")
        parts = F.array(
            F.struct(F.col("shard").alias("shard"), (F.col("n") - go).alias("n")),
            F.struct(F.col("to").alias("shard"), go.alias("n")),
        )
        moved = proposed.select("group", "members", "needed", F.inline(parts)).where(F.col("n") > 0)
        moved = moved.groupBy("group", "members", "needed", "shard").agg(F.sum("n").alias("n"))
        held = hand_over(moved, "shards-held")
        turn += 1
    state = held.withColumn("place", F.row_number().over(mostly))
    return hand_over(state.where(home).select("group", "members", "shard", "n"), "shards-home")


def sharded(
    docs: DataFrame, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id", rounds: int | None = None
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    body = text_of(text)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(body.cast("binary"))).alias("group"),
    )
    rows = hand_over(rows, "shard-rows")
    count = rows.count()
    quota = quotas(count, shards)
    hashed = F.pmod(F.xxhash64("row", F.lit("slot")), F.lit(buckets(count)))
    first = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard")
    held = rows.groupBy("group", first).agg(F.count(F.lit(1)).alias("n"))
    members = F.sum("n").over(Window.partitionBy("group")).alias("members")
    held = held.select("group", members, "shard", "n").where(F.col("members") > 1)
    held = hand_over(held, "shards-first")
    # Groups beyond CELL_ROWS (at most one for so many rows) are dealt out in cells.
    cells = F.ceil(F.col("members") / CELL_ROWS).cast("int").alias("cells")
    large = held.where(F.col("members") > CELL_ROWS).select(F.col("group").alias("_large"), cells).distinct()
    large = hand_over(large, "shards-large")
    if large.count() <= BROADCAST_IDS:
        large = F.broadcast(large)
    celled = lambda df: df.join(large, df["group"] == large["_large"], "left").drop("_large")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("cells", F.lit(1)) - 1))
    held = propagated(held, quota, rounds)
    # Rows in the order of their groups; large groups have further buckets of their own.
    cell = F.coalesce(F.pmod(F.xxhash64("row", F.lit("cell")), F.col("cells")), F.lit(0)).cast("int")
    own = buckets(count) + F.pmod(F.xxhash64("group"), F.lit(_GRAIN)) * F.lit(1 << 40) + cell
    dealt = F.when(F.col("cells").isNull(), F.pmod(F.xxhash64("group", F.lit("slot")), F.lit(buckets(count)))).otherwise(own)
    by_group = [F.col("group"), F.col("row")]
    ordered = celled(rows).select("row", "group", cell.alias("cell"), dealt.alias("dealt"))

    # The rows of a group, in any order, take the places that its shards hold.
    before = F.sum("n").over(Window.partitionBy("group").orderBy("shard")) - F.col("n")
    places = celled(held.select("group", "shard", "n", before.alias("_from"))).select("group", every.alias("cell"), "shard", "n", "_from")
    linked = ordered.join(places.select("group", "cell").distinct(), ["group", "cell"], "left_semi")
    linked = numbered(linked, ["group"], [F.col("row")], hashed, "nth")
    within = (F.col("nth") >= F.col("_from")) & (F.col("nth") < F.col("_from") + F.col("n"))
    state = linked.join(places, ["group", "cell"]).where(within).select("row", "group", "dealt", "shard")
    placed = numbered(state, ["shard"], by_group, F.col("dealt"), "slot").select("row", "shard", "slot")
    placed = hand_over(placed, "shards-ranked")
    stays = placed.where(F.col("slot") < F.get(_literal(quota, "bigint"), F.col("shard")))
    have = {r["shard"]: r["count"] for r in stays.groupBy("shard").count().collect()}
    taken = [have.get(s, 0) for s in range(shards)]

    # The rest fills what is open, shard after shard.
    rest = ordered.join(stays.select("row"), "row", "left_anti").withColumn("all", F.lit(0))
    rest = numbered(rest, ["all"], by_group, F.col("dealt"), "rank")
    starts = [0]
    for q, t in zip(quota, taken):
        starts.append(starts[-1] + q - t)
    after = F.size(F.filter(_literal(starts[1:], "bigint"), lambda end: end <= F.col("rank")))
    filled = rest.select("row", after.cast("int").alias("shard"), "rank")
    slot = F.get(_literal(taken, "bigint"), F.col("shard")) + F.col("rank") - F.get(_literal(starts, "bigint"), F.col("shard"))
    filled = filled.select("row", "shard", slot.alias("slot"))
    place = stays.select("row", "shard", "slot").unionByName(filled)
    return rows.join(place, "row").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
