"""Mixing sources by a time-varying curriculum.

A source has a schedule: its weight over the training time 0 to 1, linear between knots. The integral of the
schedule is the source's share of the mix. Within a source, documents come in a fixed hash order, pass after
pass; the tokens consumed before a document, inverted through the integrated schedule, give the time at
which it is seen. Sorting by that time interleaves all sources as the schedules ask.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabweave.llm.text import WORD, free_name, word_count
from tabweave.session import materialize

Schedule = Sequence[tuple[float, float]]

# Documents of a source are laid out in so many stretches of its hash order, each of them a window's group.
STRETCH_DIGITS = 3


def area(schedule: Schedule) -> float:
    """Integral of a schedule over the training time."""
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False))


def _checked(schedule: Schedule) -> Schedule:
    times = [t for t, _ in schedule]
    if times[:1] != [0] or times[-1:] != [1] or sorted(set(times)) != times or min(w for _, w in schedule) < 0:
        raise ValueError("A schedule goes from time 0 to 1 in rising steps, with weights of 0 or more")
    if area(schedule) <= 0:
        raise ValueError("A schedule needs some weight")
    return schedule


def _time_of(schedule: Schedule, share: Column) -> Column:
    """The time until which the schedule has spent ``share`` (0 to 1) of its integral."""
    spent, cuts = 0.0, []
    whole = area(schedule)
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        part = (t1 - t0) * (w0 + w1) / 2
        if part > 0:
            cuts.append((spent, spent + part, t0, w0, (w1 - w0) / (t1 - t0)))
        spent += part
    found = None
    for low, high, t0, w0, slope in cuts:
        over = share * F.lit(whole) - F.lit(low)
        # The stable root of w0 * x + slope / 2 * x^2 = over.
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * over, F.lit(0.0)))
        at = F.lit(t0) + F.when(over <= 0, F.lit(0.0)).otherwise(F.lit(2.0) * over / (F.lit(w0) + root))
        inside = share * F.lit(whole) < F.lit(high)
        last = high == cuts[-1][1]
        found = (F.when(inside | F.lit(last), at)) if found is None else found.when(inside | F.lit(last), at)
    return F.least(found, F.lit(1.0))


def _by_rank(schedules: Sequence[Schedule], rank: Column, value) -> Column:
    """``value`` of the schedule of each rank; schedules repeat."""
    turn = F.pmod(rank - 1, F.lit(len(schedules)))
    chosen = None
    for i, schedule in enumerate(schedules):
        chosen = F.when(turn == i, value(schedule)) if chosen is None else chosen.when(turn == i, value(schedule))
    return chosen


def source_targets(
    sizes: DataFrame, key: str, size: str, schedules: Sequence[Schedule], share: float, most: float
) -> DataFrame:
    """One row per source: ``key``, ``source_size``, ``target``, ``rank``.

    ``sizes`` has partial sizes. The targets share ``share`` times the whole by the schedules' integrals, taken
    in turn by the order of the keys; a target stops at ``most`` times its source's size and the excess goes to
    the others by weight. That is the water level at which the capped targets add up to the whole: with the
    sources in the order of cap / weight, the greatest of the levels that would hold if all before were capped.
    """
    totals = sizes.groupBy(key).agg(F.sum(size).alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    ranked = totals.withColumn("rank", F.row_number().over(everything.orderBy(key)))
    weights = ranked.withColumn("_w", _by_rank(schedules, F.col("rank"), lambda s: F.lit(area(s))))
    capped = weights.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    order = everything.orderBy(F.col("_cap") / F.col("_w"), key)
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing))
    whole = F.sum("source_size").over(everything) * F.lit(float(share))
    levels = capped.withColumn("_level", (whole - before) / after)
    level = F.max("_level").over(everything)
    target = F.greatest(F.least(F.col("_cap"), level * F.col("_w")), F.lit(0.0))
    return levels.select(key, "source_size", target.alias("target"), "rank")


def mix_sources(
    docs: DataFrame,
    schedules: Sequence[Schedule],
    share: float = 1.5,
    most: float = 2.0,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``taken`` and ``positions``; such columns are replaced.

    Sources are ordered by code point, null last, and take the schedules in turn. A source's documents come in
    the order of a hash of key and text, in whole passes as long as its target lasts; the last pass ends within
    a document, of which only the first words are taken, so a source's words taken are its rounded target.
    ``positions`` has the time of each pass that takes words, and is empty if none does.

    Null texts have size 0 and are never taken, null keys are hashed as nothing, repeated rows follow each
    other. A source is cut into stretches of its hash order, summed first and then laid out one window each, so
    no task holds a source. The targets are a table with one row per source.
    """
    for schedule in schedules:
        _checked(schedule)
    added = ("size", "source_size", "target", "taken", "positions")
    base = docs.drop(*[a for a in added if a not in (key, text, source)])
    names = [*base.columns, *added]
    sk, h, stretch, start, done, rank = (
        free_name(x, names) for x in ("_source", "_hash", "_stretch", "_start", "_done", "_rank")
    )
    doc, words, kind = (F.col(f"`{c}`") for c in (key, text, source))
    # '1' alone sorts behind '0' and any name.
    keyed = base.withColumn(sk, F.when(kind.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), kind)))
    keyed = keyed.withColumn("size", word_count(words)).withColumn(h, F.md5(F.concat_ws("|", doc.cast("string"), words)))
    keyed = keyed.withColumn(stretch, F.substring(h, 1, STRETCH_DIGITS))
    # A row for each stretch, written so that the texts are not read for each use of it.
    sums = materialize(keyed.groupBy(sk, stretch).agg(F.sum("size").alias("_n")), "stretches")
    targets = source_targets(sums, sk, "_n", schedules, share, most)
    earlier = Window.partitionBy(sk).orderBy(stretch).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn(start, F.coalesce(F.sum("_n").over(earlier), F.lit(0))).join(targets, sk)
    starts = starts.select(sk, stretch, start, "source_size", "target", F.col("rank").alias(rank))
    within = Window.partitionBy(sk, stretch).orderBy(h, doc.asc_nulls_last(), "size")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    laid = keyed.withColumn(done, F.coalesce(F.sum("size").over(within), F.lit(0))).join(starts, [sk, stretch])
    laid = laid.withColumn(start, F.col(start) + F.col(done))
    budget = F.floor(F.col("target") + 0.5)
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - passes * F.col("source_size") - F.col(start)
    partly = F.greatest(F.least(rest, F.col("size")), F.lit(0))
    # One more pass if it takes any word of the document.
    visits = F.when(F.col("size") > 0, passes + F.when(partly > 0, 1).otherwise(0)).otherwise(F.lit(0))

    def time(n: Column) -> Column:
        share_spent = (n * F.col("source_size") + F.col(start)).cast("double") / budget.cast("double")
        return _by_rank(schedules, F.col(rank), lambda s: _time_of(s, share_spent))

    times = F.transform(F.sequence(F.lit(0).cast("bigint"), visits - 1), time)
    return laid.select(
        *[F.col(f"`{c}`") for c in base.columns],
        "size",
        "source_size",
        "target",
        (passes * F.col("size") + partly).cast("bigint").alias("taken"),
        F.when(visits > 0, times).otherwise(F.array().cast("array<double>")).alias("positions"),
    )


def training_order(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix as it is trained on: a row for each pass over a document, sorted by time.

    The last pass of a document that is only partly taken has its first words, joined by spaces; all others have the
    whole text. Needs the columns of :func:`mix_sources`, which are left out. Documents that are never taken, null
    and empty texts among them, have no row; keys are not looked at; equal times are ordered by pass.
    """
    at, left = (free_name(x, mixed.columns) for x in ("_at", "_left"))
    n = free_name("_pass", mixed.columns)
    passes = mixed.select("*", F.posexplode("positions").alias(n, at))
    passes = passes.withColumn(left, F.col("taken") - F.col(n) * F.col("size"))
    words = F.col(f"`{text}`")
    head = F.slice(F.regexp_extract_all(words, F.lit(WORD), F.lit(0)), F.lit(1), F.col(left).cast("int"))
    cut = F.when(F.col(left) >= F.col("size"), words).otherwise(F.array_join(head, " "))
    gone = {"size", "source_size", "target", "taken", "positions"}
    kept = [cut.alias(text) if c == text else F.col(f"`{c}`") for c in mixed.columns if c not in gone]
    return passes.repartitionByRange(F.col(at), F.col(n)).sortWithinPartitions(at, n).select(*kept)
