"""Mixing sources to target weights by proportionate-fair scheduling of blocks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.frames import packed, with_columns
from jobtide.plans.store import stored

#: A pattern table of at most so many rows is broadcast (some 40 bytes each); a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000
#: Rows per cell of the distributed ranking, and cells per group of cells.
CELL_ROWS, GROUP_CELLS = 512, 1024


def earliest_deadline_first(shares: Column, slots: Column) -> Column:
    """The order of one period as an array of (source index, occurrence).

    Occurrence j of a source with c of Q slots has the window [floor(j*Q/c), ceil((j+1)*Q/c)). Every slot goes to the
    released occurrence with the earliest deadline, ties to the lower index. The shares add up to exactly one block per
    slot, so a released occurrence always exists and no deadline is missed: at any time a source has had less than one
    block more or less than its share.
    """

    def step(state: Column, slot: Column) -> Column:
        offers = F.transform(
            F.arrays_zip(shares.alias("share"), state["done"].alias("done")),
            lambda x, i: F.when(
                (x["done"] < x["share"]) & (F.floor(x["done"] * slots / x["share"]) <= slot),
                F.struct(
                    F.ceil((x["done"] + 1) * slots / x["share"]).alias("deadline"), i.alias("index"), x["done"].alias("j")
                ),
            ),
        )
        chosen = F.array_min(F.array_compact(offers))
        return F.struct(
            F.transform(state["done"], lambda d, i: F.when(i == chosen["index"], d + 1).otherwise(d)).alias("done"),
            F.concat(
                state["order"], F.array(F.struct(chosen["index"].alias("index"), chosen["j"].alias("j")))
            ).alias("order"),
        )

    start = F.struct(
        F.transform(shares, lambda _: F.lit(0).cast("long")).alias("done"),
        F.array().cast("array<struct<index:int,j:bigint>>").alias("order"),
    )
    return F.aggregate(F.sequence(F.lit(0).cast("long"), slots - 1), start, step, lambda state: state["order"])


def _weight(weights: Mapping[str | None, float] | None, power: float) -> Column:
    if weights is None:
        return F.pow(F.col("n").cast("double"), F.lit(power))
    if not weights or not all(weight > 0 for weight in weights.values()):
        raise ValueError("weights are positive, and there is at least one")
    weight = F.lit(float(min(weights.values())))
    for name, value in weights.items():
        weight = F.when(F.col("source") == F.lit(_key(name)), F.lit(float(value))).otherwise(weight)
    return weight


def _key(name: str | None) -> str:
    return "unknown" if name is None else f"={name}"


def _prefix_sums(counted: DataFrame) -> DataFrame:
    """Rows of a source before each of its cells, summed in two levels so that no task holds all cells of a source."""
    grouped = counted.withColumn("group", F.floor(F.col("cell") / GROUP_CELLS))
    totals = grouped.groupBy("source", "group").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("source").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("source", "group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "group").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    local = grouped.withColumn("local", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return local.join(bases, ["source", "group"]).select("source", "cell", (F.col("local") + F.col("base")).alias("first"))


def _schedule(sources: DataFrame, period: int) -> DataFrame:
    """One row per source, phase and occurrence: its slot in the period, and where and how often the phase runs.

    A phase is a run of periods with the same shares. A new one begins where a source has less than a full share left
    and where it has nothing left: at most two changes per source.
    """
    one = sources.agg(F.sort_array(F.collect_list(F.struct("source", "share", "blocks"))).alias("s")).where(F.size("s") > 0)
    full = F.transform("s", lambda x: F.floor(x["blocks"] / x["share"]))
    ends = F.transform("s", lambda x: F.ceil(x["blocks"] / x["share"]))
    starts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0).cast("long")), full, ends)))
    phases = one.select("s", F.posexplode(starts).alias("at", "begin"), starts.alias("starts")).where(
        F.col("at") + 1 < F.size("starts")
    )
    left = F.transform("s", lambda x: F.greatest(F.lit(0).cast("long"), F.least(x["share"], x["blocks"] - x["share"] * F.col("begin"))))
    phases = phases.select("s", "begin", F.get("starts", F.col("at") + 1).alias("end"), left.alias("left"))
    phases = phases.withColumn("slots", F.aggregate("left", F.lit(0).cast("long"), lambda a, x: a + x))
    earlier = Window.orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    phases = phases.withColumn(
        "offset", F.coalesce(F.sum(F.col("slots") * (F.col("end") - F.col("begin"))).over(earlier), F.lit(0))
    )
    order = phases.select(
        "s", "begin", "slots", "offset", F.posexplode(earliest_deadline_first(F.col("left"), F.col("slots"))).alias("slot", "x")
    )
    return order.select(
        F.col("s")[F.col("x.index")]["source"].alias("source"), "begin", F.col("x.j").alias("j"), "slots", "offset", "slot"
    )


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    source_col: str = "source",
    id_col: str = "doc_id",
    block_rows: int = 16,
    period: int = 1000,
    power: float = 0.5,
) -> DataFrame:
    """Place every row in a mixed order in which each source has its target weight at any time.

    Each source is cut into blocks of *block_rows* rows in the order of a hash of the id. Weights become whole numbers of
    blocks per period of about *period* blocks (at least one per source). Blocks are scheduled by earliest deadline
    first inside their release times and deadlines, so a source deviates from its share by less than one block. A
    source that runs out gives its time to the others, which keep their proportions. No row is dropped or repeated.

    *weights*: source to weight; a source that is not named has the smallest given weight. Without weights they are
    the row counts to the *power*. NULL is a source of its own.

    Returns the input columns and ``mix_slot`` (place of the row's block in the mix), ``mix_rank`` (row within the
    block), ``mix_block`` (block within the source) and ``mix_share`` (blocks of the source per period while it lasts);
    sorting by slot and rank gives the order. Input columns of these names are replaced. Rows without an id are ordered
    by a hash of their other columns; repeated rows all stay; an empty table gives an empty result.
    """
    columns = docs.columns
    whole = F.xxhash64(*[F.col(f"`{name}`") for name in columns])
    ident = F.col(f"`{id_col}`")
    source = F.col(f"`{source_col}`").cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit(_key(None))).alias("source"), ident.alias("id"),
        F.when(ident.isNull(), whole).otherwise(F.xxhash64(ident)).alias("hash"), packed(docs, columns).alias("row"),
    )
    cells = max(16, -(-rows.count() // CELL_ROWS))
    # Cells are ranges of the hash, so a row's rank does not depend on how many cells there are.
    rows = rows.withColumn("cell", F.floor((F.col("hash") / F.lit(2.0**64) + F.lit(0.5)) * F.lit(cells)))
    counted = stored(rows.groupBy("source", "cell").agg(F.count("*").alias("n")), "mix-cells")

    sources = counted.groupBy("source").agg(F.sum("n").alias("n")).withColumn("weight", _weight(weights, power))
    everything = sources.agg(F.sum("weight").alias("sum")).first()["sum"] or 1.0
    sources = stored(
        sources.select(
            "source", F.ceil(F.col("n") / F.lit(block_rows)).alias("blocks"),
            F.greatest(F.lit(1).cast("long"), F.round(F.col("weight") / F.lit(everything) * period).cast("long")).alias("share"),
        ),
        "mix-sources",
    )
    schedule = stored(_schedule(sources, period), "mix-schedule")
    count = sources.agg(F.count("*").alias("n"), F.sum("share").alias("slots")).first()
    bound = (2 * count["n"] + 1) * (count["slots"] or 0)
    starts = schedule.groupBy("source").agg(F.sort_array(F.collect_set("begin"), asc=False).alias("begins"))
    plan = _prefix_sums(counted).join(sources.join(starts, "source"), "source")

    in_cell = Window.partitionBy("source", "cell").orderBy("hash", "id")
    ranked = rows.withColumn("at", F.row_number().over(in_cell) - 1).join(plan, ["source", "cell"])
    ranked = ranked.withColumn("rank", F.col("first") + F.col("at"))
    ranked = ranked.withColumn("block", F.expr(f"rank div {int(block_rows)}"))
    ranked = ranked.withColumn("turn", F.expr("block div share")).withColumn("j", F.expr("block % share"))
    ranked = ranked.withColumn("begin", F.get(F.filter("begins", lambda b: b <= F.col("turn")), F.lit(0)))
    side = F.broadcast(schedule) if bound <= BROADCAST_ROWS else schedule
    placed = ranked.join(side, ["source", "begin", "j"])
    slot = F.col("offset") + (F.col("turn") - F.col("begin")) * F.col("slots") + F.col("slot")
    return with_columns(placed, columns, {
        "mix_slot": slot, "mix_rank": (F.col("rank") % block_rows).cast("int"), "mix_block": F.col("block"),
        "mix_share": F.col("share"),
    })
