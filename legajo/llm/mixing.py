"""Mixing sources to target weights by Pfair scheduling.

Weights are whole parts of a period, the sum of all parts. Each source's rows are cut into blocks. Block i (from 0) of a source with
w of H parts is released at slot floor(i H / w) and due by slot ceil((i + 1) H / w); at each slot the released block
with the earliest deadline goes. On one sequence with full use every deadline is met, so after any number of slots each source has its
share to less than one block, as long as all have blocks left. The order repeats after H slots: one period is scheduled, in one
row of H steps whatever the data's size, and every block finds its slot from its number. A step looks at the blocks that are due next only,
so that its cost does not grow with the sources.

``tempered_parts`` keeps the period near MOST_PARTS at most: beyond it targets are rounded to whole parts, and ``share`` has what was asked for.

``splits`` is another schedule for callers who name it (``by="halves"``): it keeps any parts exactly and has no period, but promises less. Two
sides of a and b parts need no period: block k of the one goes to slot floor(k (a + b) / a) and the other side fills the rest, which is Pfair
for both. Sources of like parts are put in groups, groups in classes, and both are halved down to the source; classes are split off one by one, the
largest first. Each split adds less than one block times the source's share of its side, which is less than six blocks in all.

Rows are numbered within their source without gathering a source: they are dealt by hash into bins of bounded size, numbered in
their bin, and bins are numbered on by their counts. Slots go to the bins, which need a few each, and with them to the rows. No row is dropped
or repeated; when a source runs dry its slots stay empty and the others go on at their own pace.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legajo.llm.scratch import saved

#: Parts of a period that ``tempered_parts`` makes at most, but for one of each source.
MOST_PARTS = 1_000_000
#: Slots of a period that are scheduled before their blocks are put away, and slots for whose deadlines blocks are held ready.
CHUNK, AHEAD = 256, 64
#: Sources in a group, about.
GROUP_SOURCES = 1000
#: Parts of the smallest target at least, so that rounding moves no target by more than a sixteenth.
LEAST_PARTS = 8
BIN_ROWS = 4096


def tempered_parts(docs: DataFrame, source: str = "source", power: float = 0.7, parts: int = 1000, weight: Column | None = None) -> DataFrame:
    """(source, parts, share): targets in proportion to a power of the sources' row counts, times ``weight``.

    ``weight`` is an expression on ``source``. ``share`` is the target before rounding. There are about ``parts`` parts in all, or as many more as give the smallest source LEAST_PARTS
    within MOST_PARTS. Each source has one part at least.
    """
    name = F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")
    sizes = docs.groupBy(name).agg(F.pow(F.count("*"), F.lit(power)).alias("size"))
    if weight is not None:
        sizes = sizes.withColumn("size", F.col("size") * weight)
    total = F.sum("size")
    scale = F.least(F.greatest(parts / total, LEAST_PARTS / F.min("size")), MOST_PARTS / total)
    one = sizes.agg(F.struct(scale.alias("scale"), total.alias("total")).alias("one")).scalar()
    whole = F.greatest(F.lit(1), F.round(F.col("size") * one["scale"])).cast("long")
    return sizes.select("source", whole.alias("parts"), (F.col("size") / one["total"]).alias("share"))


def _no_keys() -> Column:
    return F.array().cast("array<bigint>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _earliest(state: Column, keys: Column) -> Column:
    """One slot: the keys released at it come in, the smallest of all goes out.

    ``near`` has the blocks due up to ``bound``, which are the only ones looked at until there are none; ``far`` the others and ``fresh`` those that came in since.
    """

    def entered(x: Column) -> Column:
        near = F.concat(x["near"], F.filter(keys, lambda k: k <= x["bound"]))
        fresh = F.concat(x["fresh"], F.filter(keys, lambda k: k > x["bound"]))
        return F.struct(near.alias("near"), fresh.alias("fresh"), x["far"].alias("far"), x["bound"].alias("bound"))

    def refilled(x: Column) -> Column:
        pool = F.struct(F.concat(x["far"], x["fresh"]).alias("keys"))
        pool = _let(pool, lambda p: F.struct(p["keys"].alias("keys"), (F.array_min(p["keys"]) + AHEAD * F.col("n")).alias("bound")))

        def cut(p: Column) -> Column:
            near = F.filter(p["keys"], lambda k: k <= p["bound"])
            return F.struct(near.alias("near"), _no_keys().alias("fresh"), F.filter(p["keys"], lambda k: k > p["bound"]).alias("far"), p["bound"].alias("bound"))

        return _let(pool, cut)

    def popped(x: Column) -> Column:
        first = F.array_min(x["near"])
        left = F.array_remove(x["near"], first)
        return F.struct(
            left.alias("near"), x["fresh"].alias("fresh"), x["far"].alias("far"), x["bound"].alias("bound"), F.array_append(state["out"], first).alias("out")
        )

    return _let(_let(_let(state, entered), lambda x: F.when(F.size(x["near"]) > 0, x).otherwise(refilled(x))), popped)


def period(targets: DataFrame) -> DataFrame:
    """(source, nth, slot, parts, period): the slots of one period, from (source, parts).

    Sources without parts have no slot. A block's key is its deadline times the number of sources, plus its source's place among their names.
    """
    queue = F.array_sort(F.collect_list(F.struct("source", F.col("parts").cast("long").alias("parts"))))
    one = targets.filter("parts > 0").agg(queue.alias("queue"), F.coalesce(F.sum("parts"), F.lit(0)).cast("long").alias("h")).filter("h > 0")
    one = one.select("h", F.size("queue").cast("long").alias("n"), F.posexplode("queue").alias("rank", "x"))
    ranks = saved(one.select("h", "n", F.col("rank").cast("long").alias("rank"), "x.source", "x.parts"), "targets")
    blocks = ranks.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("nth"))
    key = F.expr("((nth + 1) * h + parts - 1) div parts * n + rank")
    released = blocks.select("h", "n", F.expr("nth * h div parts").alias("slot"), key.alias("key"))
    # Every slot, also one at which nothing is released.
    every = ranks.filter("rank = 0").select("h", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("h") - 1)).alias("slot"), F.lit(None).cast("long").alias("key"))
    slots = released.unionByName(every).groupBy("h", "n", "slot").agg(F.collect_list("key").alias("keys"))
    chunk = F.array_sort(F.collect_list(F.struct("slot", "keys"))).alias("slots")
    chunks = slots.groupBy("h", "n", F.call_function("div", "slot", F.lit(CHUNK)).alias("chunk")).agg(chunk)
    row = chunks.groupBy("h", "n").agg(F.array_sort(F.collect_list(F.struct("chunk", "slots"))).alias("chunks"))
    held = [_no_keys().alias("near"), _no_keys().alias("fresh"), _no_keys().alias("far"), F.lit(-1).cast("long").alias("bound")]

    def scheduled_chunk(state: Column, chunk: Column) -> Column:
        carried = [state[c].alias(c) for c in ("near", "fresh", "far", "bound")]
        return F.aggregate(
            chunk["slots"],
            F.struct(*carried, _no_keys().alias("out")),
            lambda a, x: _earliest(a, x["keys"]),
            lambda a: F.struct(*[a[c].alias(c) for c in ("near", "fresh", "far", "bound")], F.array_append(state["out"], a["out"]).alias("out")),
        )

    none = F.array().cast("array<array<bigint>>").alias("out")
    order = F.aggregate("chunks", F.struct(*held, none), scheduled_chunk, lambda a: F.flatten(a["out"]))
    # Outer, as Spark would compute the schedule once more in a not-empty filter below the explode.
    order = row.select("h", "n", F.posexplode_outer(order).alias("slot", "key"))
    order = order.select("h", F.col("slot").cast("long").alias("slot"), (F.col("key") % F.col("n")).alias("rank"), F.expr("key div n").alias("due"))
    # The block with this deadline is the last one whose fluid end is not behind it.
    nth = F.expr("due * parts div h - 1").alias("nth")
    return order.join(ranks.drop("h", "n"), "rank").select("source", nth, "slot", "parts", F.col("h").alias("period"))


def _halved(items: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(keys, item, steps) from (keys, item, parts), one row per group of ``keys``, and (keys, parts) of the groups.

    ``steps`` has the splits above an item within its group, from its own on: parts of its side, of both sides, and whether it is the first.
    """
    one = items.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("item", "parts"))).alias("items"))
    sums = F.expr("aggregate(items, array(0L), (s, x) -> array_append(s, element_at(s, -1) + x.parts))")
    # Through an explode of one row, so that the lambdas below do not add up again for each item.
    one = one.select(*keys, "items", F.explode_outer(F.array(sums)).alias("sums"))
    side = "sums[least(size(items), shiftleft(shiftright(i, {0}) + 1, {0}))] - sums[shiftleft(shiftright(i, {0}), {0})]"
    split = f"struct({side.format('l')} AS own, {side.format('(l + 1)')} AS both, shiftright(i, l) % 2 = 0 AS first)"
    steps = f"filter(transform(sequence(0, length(bin(size(items)))), l -> {split}), x -> x.own < x.both)"
    rows = one.select(*keys, F.expr(f"inline(transform(items, (x, i) -> struct(x.item AS item, {steps} AS steps)))"))
    return rows, one.select(*keys, F.element_at("sums", -1).alias("parts"))


def splits(targets: DataFrame) -> DataFrame:
    """(source, steps): the splits above each source that has parts, from its own to the one of all, for any number of sources and parts."""
    rows = targets.filter("parts > 0").select(F.col("source").alias("item"), F.col("parts").cast("long").alias("parts"))
    rows = rows.withColumn("class", F.length(F.bin("parts")))
    # At most 64 classes.
    sizes = rows.groupBy("class").agg(F.ceil(F.count("*") / GROUP_SOURCES).alias("groups"))
    rows = rows.join(F.broadcast(sizes), "class").withColumn("group", F.pmod(F.xxhash64("item"), F.col("groups")))
    inner, groups = _halved(rows.select("class", "group", "item", "parts"), ["class", "group"])
    outer, classes = _halved(groups.withColumnRenamed("group", "item"), ["class"])
    one = classes.agg(F.array_sort(F.collect_list(F.struct((-F.col("class")).alias("item"), "parts"))).alias("items"))
    # What is left from each class on, largest class first.
    left = F.expr("reverse(aggregate(reverse(items), array(0L), (s, x) -> array_append(s, element_at(s, -1) + x.parts)))")
    one = one.select("items", F.explode_outer(F.array(left)).alias("rest"))
    above = "transform(reverse(sequence(0, i)), j -> struct(rest[j] AS own, rest[greatest(j - 1, 0)] AS both, false AS first))"
    steps = f"filter(concat(array(struct(x.parts AS own, rest[i] AS both, true AS first)), {above}), x -> x.own < x.both)"
    top = one.select(F.expr(f"inline(transform(items, (x, i) -> struct(-x.item AS class, {steps} AS top)))"))
    outer = outer.select("class", F.col("item").alias("group"), F.col("steps").alias("outer")).join(F.broadcast(top), "class")
    found = inner.join(outer, ["class", "group"])
    return found.select(F.col("item").alias("source"), F.concat("steps", "outer", "top").alias("steps"))


def _slot(total: int) -> Column:
    """The slot of ``block_no`` by ``__steps``, for ``total`` parts."""
    # Products of two numbers of parts; in longs while they fit.
    k = "(k % s.own)" if total < 3_000_000_000 else "cast(k % s.own AS decimal(19))"
    ahead = f"if(s.first, {k} * s.both, ({k} + 1) * s.both - 1) div s.own"
    return F.expr(f"aggregate(__steps, block_no, (k, s) -> k div s.own * s.both + {ahead})")


def _bin_slots(counts: DataFrame, targets: DataFrame, block: int) -> DataFrame:
    """``counts`` with ``__first``, the first block of the bin, and ``__slots``, the slots of its blocks; null without a target."""
    # A source's slots by the number of the block in the period: one row for each source, of as many slots as it has parts.
    nths = F.transform(F.array_sort(F.collect_list(F.struct("nth", "slot"))), lambda x: x["slot"])
    slots = period(targets).groupBy(F.col("source").alias("__source"), "parts", "period").agg(nths.alias("nths"))
    first = F.expr(f"__before div {block}")
    # A bin's numbers are those of the source's rows from __before on, so its blocks follow each other.
    last = F.expr(f"(__before + __count - 1) div {block}")
    at = lambda b: F.call_function("div", b, F.col("parts")) * F.col("period") + F.get("nths", (b % F.col("parts")).cast("int"))
    found = F.when(F.col("parts").isNotNull(), F.transform(F.sequence(first, last), at))
    return counts.join(slots, "__source", "left").select(*counts.columns, first.alias("__first"), found.alias("__slots"))


def scheduled(docs: DataFrame, targets: DataFrame, doc: str = "doc_id", source: str = "source", block: int = 32, by: str = "deadlines") -> DataFrame:
    """``docs`` with ``block_no``, ``slot`` and ``position``; existing columns of these names are replaced.

    ``by`` is ``deadlines``, whose lag is below one block, or ``halves`` (``splits``), whose lag is below six; the data never choose.
    Rows of a source are taken in an order by their hash, so that it does not follow the input's.
    ``position`` is slot * block + place in the block: unique, with gaps where blocks are short or a source ran dry. A null source is the source ``""``. Rows of a source without
    a target have no slot and come last, with a null ``position``. Equal rows are interchangeable.
    """
    if by not in ("deadlines", "halves"):
        raise ValueError(f"no schedule by {by}")
    names = ("block_no", "slot", "position")
    docs = docs.drop(*names)
    bins = max(1, docs.count() // BIN_ROWS)
    # Of the whole row, so that rows with a null or repeated id do not fill a bin.
    place = F.xxhash64(*docs.columns)
    rows = docs.withColumns({"__source": F.coalesce(F.col(source).cast("string"), F.lit("")), "__hash": place})
    rows = rows.withColumn("__bin", F.pmod(F.col("__hash"), F.lit(bins)))
    counts = rows.groupBy("__source", "__bin").agg(F.count("*").alias("__count"))
    upto = Window.partitionBy("__source").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__count").over(upto), F.lit(0)))
    # To the counts, not the rows: a source has a count for each of its bins.
    if by == "halves":
        steps = splits(targets).select(F.col("source").alias("__source"), F.col("steps").alias("__steps"))
        counts = counts.join(steps, "__source", "left")
        slot = _slot(targets.filter("parts > 0").agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0])
    else:
        counts = _bin_slots(counts, targets, block)
        slot = F.get("__slots", (F.col("block_no") - F.col("__first")).cast("int"))
    within = Window.partitionBy("__source", "__bin").orderBy("__hash", doc)
    rows = rows.withColumn("__n", F.row_number().over(within)).join(counts.drop("__count"), ["__source", "__bin"])
    rank = F.col("__before") + F.col("__n") - 1
    rows = rows.withColumns({"block_no": F.floor(rank / block).cast("long"), "__place": F.pmod(rank, F.lit(block))})
    rows = rows.withColumn("slot", slot.cast("long"))
    return rows.withColumn("position", (F.col("slot") * block + F.col("__place")).cast("long")).select(*docs.columns, *names)


def mixed(docs: DataFrame, targets: DataFrame, doc: str = "doc_id", source: str = "source", block: int = 32) -> DataFrame:
    """The rows of ``docs`` in mixed order: written to files, their names and rows are in the order of the mix."""
    rows = scheduled(docs, targets, doc, source, block)
    order = [F.col("position").asc_nulls_last(), F.col(doc)]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)
