"""Mixing sources to target weights: rows below a hash threshold, found by histograms instead of a sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.operators.ordering import col, fresh, with_row_index
from drover.session import stage

#: A word is a run of these.
WORD = r"[^\x20\x09-\x0D]+"

#: Bits of a row's draw, and of the tie that orders rows with equal draws.
BITS = 60
#: Bits that one histogram resolves: each has at most 4,096 buckets for a source.
DIGIT = 12


def count_words(text: str | Column) -> Column:
    """Words of a text, 0 for NULL."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def draw(columns: Sequence[str], seed: int = 0) -> Column:
    """A number of 60 bits from the values of a row: the first 15 hex digits of an MD5.

    The same row draws the same number at every run, wherever it lies.
    """
    parts = [F.coalesce(col(c).cast("string"), F.lit("-")) for c in columns]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float, source: str = "source") -> DataFrame:
    """`target` for each row of `sources` (a source and its `words`).

    Sources in order of their names, NULL last, weigh `weights`, over and over.
    They divide `share` times all words by weight; none gets more than `most`
    times its own, and what it can't take goes to the others by weight.
    """
    if share > most:
        raise ValueError("the sources can't give that many words")
    keyed = sources.withColumn("_last", col(source).isNull())
    ranked = with_row_index(keyed, ["_last", source], "_rank").drop("_last")
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = stage(ranked.withColumn("_weight", weight).drop("_rank"), "weights")
    limit = F.col("words") * F.lit(float(most))
    total = ranked.agg(F.sum("words").alias("w"), F.sum("_weight").alias("v")).first()
    # A level is what a weight of one gets; it rises as more sources are full.
    level, full = share * (total["w"] or 0) / (total["v"] or 1), 0
    while True:
        over = F.col("_weight") * F.lit(level) > limit
        state = ranked.agg(
            F.count_if(over).alias("full"),
            F.sum(F.when(over, F.col("words")).otherwise(0)).alias("words"),
            F.sum(F.when(over, 0.0).otherwise(F.col("_weight"))).alias("weight"),
        ).first()
        if state["full"] == full:
            break
        full = state["full"]
        if not state["weight"]:
            break
        level = (share * total["w"] - most * state["words"]) / state["weight"]
    wanted = F.when(over, limit).otherwise(F.col("_weight") * F.lit(level))
    return ranked.withColumn("target", wanted).drop("_weight")


def _digit(level: int, code: str, tie: str) -> Column:
    """The level-th twelve bits of a row's draw, then of its tie."""
    name, at = (code, level) if level < BITS // DIGIT else (tie, level - BITS // DIGIT)
    return F.shiftright(col(name), BITS - DIGIT * (at + 1)).bitwiseAND(F.lit((1 << DIGIT) - 1))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each `budget` of a source the hash threshold below which its rows hold about so many words.

    `rows` are stored rows of source, words, draw and tie; `budgets` of source and
    budget, several for a source if need be. Returns source, budget, last_draw,
    last_tie, included: a row counts if its draw and tie are less, or equal and
    included. All budgets of a source go along one order, so what a smaller one
    takes a larger one takes too. The sum misses the budget by at most half the
    row at the threshold; a budget above all words has a threshold above all rows.

    A histogram of words by the first twelve bits finds the bucket in which a budget ends.
    Only the rows of that bucket are stored and resolved by the next twelve bits,
    until one row is left there: for n rows that takes log n to the base of 4,096
    rounds. Ties follow equal draws; rows that agree in these too count as one.
    """
    end = F.lit(1 << BITS)
    found = None
    # Rows still in question, each with the budgets whose bucket it lies in.
    open_ = budgets.select("source", "budget", F.col("budget").cast("double").alias("left"))
    keys, level, current = ["source"], 0, rows
    while True:
        counted = current.groupBy(*keys, _digit(level, "draw", "tie").alias("digit")).agg(
            F.sum("words").alias("words"), F.count(F.lit(1)).alias("rows")
        )
        names = ", ".join(keys)
        running = F.expr(f"sum(words) OVER (PARTITION BY {names} ORDER BY digit)")
        counted = counted.withColumn("through", running)
        same = [counted[k].eqNullSafe(open_[k]) for k in keys]
        ends = (
            open_.join(counted, [*same, counted["through"] > open_["left"]])
            .groupBy(open_["source"], open_["budget"], open_["left"])
            .agg(F.min(F.struct("digit", "words", "rows", "through")).alias("at"))
        )
        # What is wanted of the bucket, which is all that the next round looks at.
        rest = F.col("left") - (F.col("at.through") - F.col("at.words"))
        ends = stage(ends.select("source", "budget", rest.alias("left"), "at.digit", "at.words", "at.rows"), "boundary")
        if level == 0:
            reached = ends.select(F.col("source").alias("s"), F.col("budget").alias("b"))
            beyond = open_.join(
                reached, [open_["source"].eqNullSafe(F.col("s")), open_["budget"] == F.col("b")], "left_anti"
            )
            found = beyond.select("source", "budget", end.alias("last_draw"), end.alias("last_tie"), F.lit(True).alias("included"))
        if level == 0:
            match = [current["source"].eqNullSafe(ends["source"])]
        else:
            match = [current[k].eqNullSafe(ends[k]) for k in ("source", "budget")]
        inside = current.join(ends, [*match, _digit(level, "draw", "tie") == ends["digit"]]).select(
            ends["source"], ends["budget"], ends["left"], ends["rows"], ends["words"].alias("held"),
            current["words"], "draw", "tie",
        )
        inside = stage(inside, "boundary-rows")
        level += 1
        single = F.col("rows") == 1 if level < 2 * BITS // DIGIT else F.lit(True)
        done = inside.where(single).groupBy("source", "budget").agg(
            F.max("draw").alias("last_draw"),
            F.max("tie").alias("last_tie"),
            # Nearer with the row than without it.
            F.max(F.col("held") < 2 * F.col("left")).alias("included"),
        )
        found = found.unionByName(done)
        current = inside.where(~single).select("source", "budget", "words", "draw", "tie")
        if current.isEmpty():
            return stage(found, "thresholds")
        keys = ["source", "budget"]
        open_ = ends.where(~single).select("source", "budget", "left")


def mix(
    df: DataFrame,
    size: str = "size",
    source: str = "source",
    by: str | None = None,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    seed: int = 0,
) -> DataFrame:
    """Choose how often each row goes into a mix whose sources hold their target numbers of words.

    A source's target (`targets`) is so many whole rounds of all its rows, and a
    rest below one round, for which rows under the hash threshold are taken once
    more. `by` names a column made with `draw`; without it all columns are drawn
    from. Rows with equal draws are told apart by their place in storage.

    Adds source_size, target and taken (words with repeats), replacing columns
    of these names; `size` counts the words, NULL as 0. NULL is a source of its
    own; repeated rows each count; an empty table gives an empty one. A source's
    taken words miss its target by at most half of one row. `df` is stored
    once, so drop texts that the mix needn't carry.

    Rows are never sorted. What is joined to them has one row for each source;
    Spark broadcasts it only if it is small enough, and splits hot sources if not.
    """
    kept = [c for c in df.columns if c not in ("source_size", "target", "taken")]
    inner = {name: fresh(df.columns, f"_{name}") for name in ("draw", "tie", "words")}
    code = col(by) if by else draw([c for c in df.columns], seed)
    place = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
    stored = stage(
        df.select(
            *map(col, kept),
            code.alias(inner["draw"]),
            F.shiftrightunsigned(place, 64 - BITS).alias(inner["tie"]),
            F.coalesce(col(size), F.lit(0)).cast("long").alias(inner["words"]),
        ),
        "mixing",
    )
    rows = stored.select(col(source).alias("source"), *(col(inner[c]).alias(c) for c in ("words", "draw", "tie")))
    per_source = targets(rows.groupBy("source").agg(F.sum("words").alias("words")), weights, share, most)
    rounds = F.least(F.floor(F.col("target") / F.col("words")), F.lit(most))
    rounds = F.when(F.col("words") > 0, rounds).otherwise(0).cast("int")
    wanted = stage(per_source.withColumn("rounds", rounds), "targets")
    rest = F.greatest(F.col("target") - F.col("rounds") * F.col("words"), F.lit(0.0))
    ends = thresholds(rows, wanted.select("source", rest.alias("budget"))).drop("budget")
    plan = wanted.select(F.col("source").alias("_s"), F.col("words").alias("_size"), "target", "rounds").join(
        ends, F.col("_s").eqNullSafe(F.col("source"))
    )
    plan = plan.select(
        F.struct("_s", "_size", "target", "rounds", "last_draw", "last_tie", "included").alias("_plan"), "_s"
    )
    at = {name: col(inner[name]) for name in inner}
    once = (at["draw"] < F.col("_plan.last_draw")) | (at["draw"] == F.col("_plan.last_draw")) & (
        (at["tie"] < F.col("_plan.last_tie")) | (at["tie"] == F.col("_plan.last_tie")) & F.col("_plan.included")
    )
    return stored.join(plan, col(source).eqNullSafe(F.col("_s"))).select(
        *map(col, kept),
        F.col("_plan._size").alias("source_size"),
        F.col("_plan.target").alias("target"),
        (at["words"] * (F.col("_plan.rounds") + once.cast("int"))).cast("long").alias("taken"),
    )
