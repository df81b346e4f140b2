"""Balanced label propagation: copies of a text gather in one shard while shards stay even in bytes.

Documents with equal texts are linked. Members of a group are alike and of one size, so the state of the propagation is
a count per group and shard, never a link table: a group of any size is at most one row per shard. In each round a
group's members propose to move to the shard that holds most of the group, of those that are not full; a shard takes
proposals, largest gain first, up to its quota. Documents without links are dealt out last, by prefix sums, to make the shards even.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import settle, uniform

SHARDS = 8
ROUNDS = 6
#: Rows that one task orders at a time when places or prefix sums are computed.
BUCKET_ROWS = 20_000


def _lookup(values: dict[int, int], key: Column) -> Column:
    return F.get(F.array(*[F.lit(int(v)) for _, v in sorted(values.items())]).cast("array<bigint>"), key)


def _loads(counts: DataFrame, shards: int) -> dict[int, int]:
    """Bytes per shard; one row per shard reaches the driver."""
    found = {r["shard"]: int(r["b"]) for r in counts.groupBy("shard").agg(F.sum(F.col("n") * F.col("size")).alias("b")).collect()}
    return {s: found.get(s, 0) for s in range(shards)}


def _round(counts: DataFrame, quota: int, shards: int, seed: int) -> DataFrame:
    """One round over ``(grp, size, shard, n)``: the moves that the quotas allow, applied."""
    loads = _loads(counts, shards)
    room = [s for s in range(shards) if loads[s] < quota]
    at_most = F.max(F.struct("n", F.pmod(F.xxhash64("grp", "shard", F.lit(seed)), F.lit(1 << 20)).alias("tie"), "shard"))
    best = counts.where(F.col("shard").isin(room)).groupBy("grp").agg(at_most.alias("top")).select(
        "grp", F.col("top.shard").alias("aim"), F.col("top.n").alias("most"))
    better = (F.col("shard") != F.col("aim")) & (F.col("n") <= F.col("most"))
    gain = F.when(better, F.floor(4 * F.log2(F.col("most") - F.col("n") + 1)).cast("int"))
    asked = settle(counts.join(best, "grp", "left").withColumn("gain", gain))
    # what is asked of each shard by gain, in quarter doublings: some 250 rows for each shard, whatever the number of groups
    wishes = asked.where("gain IS NOT NULL").groupBy("aim", "gain").agg(F.sum(F.col("n") * F.col("size")).alias("b")).collect()
    share = []
    for aim in room:
        free = quota - loads[aim]
        for row in sorted((w for w in wishes if w["aim"] == aim), key=lambda w: -w["gain"]):
            taken = min(free, int(row["b"]))
            share.append((aim, row["gain"], taken / int(row["b"])))
            free -= taken
    table = counts.sparkSession.createDataFrame(share, "aim int, gain int, allowed double")
    asked = asked.join(F.broadcast(table), ["aim", "gain"], "left")
    # a share of the members goes; of single members, those whose draw is below it
    draw = uniform(F.concat_ws("|", F.col("grp"), F.col("shard")), f"move{seed}")
    moving = F.when(F.col("allowed").isNotNull(), F.floor(F.col("n") * F.col("allowed") + draw)).otherwise(F.lit(0)).cast("bigint")
    moved = asked.withColumn("go", F.least(moving, F.col("n")))
    stay = moved.select("grp", "size", "shard", (F.col("n") - F.col("go")).alias("n"))
    gone = moved.where("go > 0").select("grp", "size", F.col("aim").alias("shard"), F.col("go").alias("n"))
    return settle(stay.unionByName(gone).where("n > 0").groupBy("grp", "size", "shard").agg(F.sum("n").alias("n")))


def _running(rows: DataFrame, value: Column, order: list[str]) -> DataFrame:
    """``before``: the sum of ``value`` over earlier rows by ``(bucket, *order)``, in two passes over bounded buckets."""
    totals = rows.groupBy("bucket").agg(F.sum(value).alias("total"))
    back = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("bucket", F.coalesce(F.sum("total").over(back), F.lit(0)).alias("start"))
    inside = Window.partitionBy("bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return local.join(starts, "bucket").withColumn("before", F.col("start") + F.col("inside")).drop("start", "inside")


def _buckets(n: int) -> int:
    return max(1, -(-n // BUCKET_ROWS))


def _fill(rows: DataFrame, n: int, total: int, room: dict[int, int]) -> DataFrame:
    """Give each row the shard in whose share of ``room`` its middle byte falls when all rows lie end to end."""
    shards, whole = sorted(room), max(1, sum(room.values()))
    bucket = F.floor(F.col("draw") * _buckets(n)).cast("bigint")
    placed = _running(rows.withColumn("bucket", bucket), F.col("size"), ["draw", "doc_id"])
    middle = (F.col("before") + F.col("size") / 2) * (whole / max(1, total))
    shard, end = F.lit(shards[-1]), whole
    for s in reversed(shards):
        shard = F.when(middle < end, F.lit(s)).otherwise(shard)
        end -= room[s]
    return placed.withColumn("shard", shard).drop("bucket", "before")


def balanced_shards(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, rounds: int = ROUNDS,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` per document; shards are even in bytes, slots gapless from 0.

    ``size`` is the text's UTF-8 bytes plus one. Null and empty texts are equal texts. A group that is larger than a
    shard's share is cut over as few shards as the quotas allow. Rows with the same id and text are placed one by one;
    a null id stays null. Other columns, whatever their names, are not read. An empty table gives no rows.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    base = settle(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(body) + 1).cast("bigint").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.md5(body).alias("grp"),
        ).withColumn("draw", uniform(F.concat_ws("|", F.col("doc_id").cast("string"), F.monotonically_increasing_id()), "shard"))
    )
    groups = base.groupBy("grp").agg(F.count(F.lit(1)).alias("members"))
    linked_groups = settle(groups.where("members > 1").select("grp"))
    is_linked = linked_groups.select("grp", F.lit(True).alias("linked"))
    known = settle(base.join(is_linked, "grp", "left").withColumn("linked", F.coalesce("linked", F.lit(False))))
    row = known.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        F.count(F.when(~F.col("linked"), 1)).alias("singles"),
        F.percentile_approx(F.when(~F.col("linked"), F.col("size")), 0.5).alias("half"),
    ).first()
    quota = -(-int(row["bytes"]) // shards)

    first = F.floor(F.col("draw") * shards).cast("int")
    counts = settle(
        known.where("linked").withColumn("shard", first).groupBy("grp", "size", "shard").agg(F.count(F.lit(1)).alias("n"))
    )
    for seed in range(rounds):
        counts = _round(counts, quota, shards, seed)
    loads = _loads(counts, shards)

    # members take the places of their group's counts, in the order of their draws
    spans = counts.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("shard", "n"))).alias("places"), F.sum("n").alias("all"))
    ends = F.transform("places", lambda p, i: F.struct(p["shard"].alias("shard"), F.aggregate(
        F.slice("places", F.lit(1), i + 1), F.lit(0).cast("bigint"), lambda a, x: a + x["n"]).alias("end")))
    spans = spans.select("grp", "all", ends.alias("ends"))
    chosen = F.get(F.filter("ends", lambda e: F.col("place") < e["end"]), F.lit(0))["shard"]
    bucket = F.floor(F.col("draw") * F.ceil(F.col("all") / BUCKET_ROWS)).cast("bigint")
    members = settle(known.where("linked").join(spans.select("grp", "all"), "grp").withColumn("bucket", bucket))
    linked = settle(_places(members, "grp").join(spans.drop("all"), "grp").withColumn("shard", chosen).select(
        "doc_id", "size", "text_crc32", "draw", "shard"))
    loads = _loads(linked.withColumn("n", F.lit(1)), shards)

    # large single documents first, then the small ones to level what is left
    singles = known.where(~F.col("linked")).select("doc_id", "size", "text_crc32", "draw")
    placed = [linked]
    for part in (F.col("size") > F.lit(row["half"]), F.col("size") <= F.lit(row["half"])):
        some = singles.where(part)
        had = some.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("b")).first()
        if not had["n"]:
            continue
        room = _room(loads, int(had["b"]))
        filled = settle(_fill(some, had["n"], int(had["b"]), room).select(linked.columns))
        placed.append(filled)
        more = _loads(filled.withColumn("n", F.lit(1)), shards)
        loads = {s: loads[s] + more[s] for s in loads}
    out = placed[0]
    for frame in placed[1:]:
        out = out.unionByName(frame)
    return _slots(out, int(known.count()))


def _room(loads: dict[int, int], more: int) -> dict[int, int]:
    """How many of ``more`` bytes each shard takes so that the fullest shards come out as even as they can."""
    level, order = 0, sorted(loads.values())
    for k in range(1, len(order) + 1):
        level = (sum(order[:k]) + more) / k
        if k == len(order) or level <= order[k]:
            break
    return {s: max(0, int(level - b)) for s, b in loads.items()}


def _slots(rows: DataFrame, n: int) -> DataFrame:
    """Number the rows of each shard from 0."""
    rows = settle(rows.withColumn("bucket", F.floor(F.col("draw") * _buckets(n)).cast("bigint")))
    return _places(rows, "shard").select("doc_id", "size", "text_crc32", "shard", F.col("place").alias("slot"))


def _places(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` with ``place``, their number from 0 within ``by`` in the order of their draws, in two passes.

    ``bucket`` cuts the draws so that no bucket of a group has many more than ``BUCKET_ROWS`` rows.
    """
    sizes = rows.groupBy(by, "bucket").agg(F.count(F.lit(1)).alias("c"))
    back = Window.partitionBy(by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(by, "bucket", F.coalesce(F.sum("c").over(back), F.lit(0)).alias("start"))
    inside = Window.partitionBy(by, "bucket").orderBy("draw", "doc_id")
    numbered = rows.withColumn("inside", F.row_number().over(inside) - 1).join(starts, [by, "bucket"])
    return numbered.withColumn("place", (F.col("start") + F.col("inside")).cast("bigint")).drop("start", "inside", "bucket")


def cut_links(sharded: DataFrame) -> DataFrame:
    """``linked, cut``: pairs of equal texts, and those whose members lie in different shards (by crc32 and size)."""
    here = sharded.groupBy("text_crc32", "size", "shard").agg(F.count(F.lit(1)).alias("n"))
    pairs = here.groupBy("text_crc32", "size").agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("kept"))
    total = F.col("n") * (F.col("n") - 1) / 2
    return pairs.agg(F.sum(total).alias("linked"), F.sum(total - F.col("kept")).alias("cut"))
