"""Mixing sources to target token counts by entropy balancing.

Document i of source s gets the rate w_i in [0, most] that is closest to the uniform one in bounded
(Fermi-Dirac) entropy while the source's words meet their target: maximize sum h(w_i), h(w) =
-w log w - (most - w) log(most - w), subject to sum w_i size_i = target_s.  The solution is an
exponential tilt, w_i = most / (1 + exp(-lambda_s size_i / scale_s)), and lambda_s is the minimum of
a convex dual whose gradient is (words taken at the rates) - target.  Newton's steps for all sources
are aggregations over a table of (source, size, documents), kept inside a bracket that each step
narrows, so that they converge for any start.

Rates become copies in two steps.  Inside a source the sizes are walked from large to small; each
takes the whole number of copies that brings the words taken so far next to the words due so far, so
an error left by long documents is made up by shorter ones.  The copies of a size go to its documents
in the order of a hash of their ids, each getting the quotient and the first ones one more.

Everything is DataFrame expressions.  Sums of rates are decimal, so their order does not matter and
reruns agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tilewright.llm._common import numbered, staged, table, word_count

#: Newton's rounds, and the share of a target that may be missed before rounding.
ROUNDS, TOLERANCE = 40, 1e-9

#: Sizes walked in one inner fold (keeps growing arrays short).
CHUNK = 256


def targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights repeat over the sources by code
    point, null last; all targets sum to share of all sizes; none exceeds most times its source's
    size, the excess being reshared by weight among the others until none does."""
    every = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(F.row_number().over(every) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    # The level t with sum(min(cap, t * weight)) = total: sources fill up in the order of cap / weight.
    s = s.withColumn("full_at", F.col("cap") / F.col("weight"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before, onward, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(whole) * float(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(whole)
    return s.select("source", "source_size", F.coalesce(F.least(F.col("cap"), level["level"] * F.col("weight")), F.col("cap")).alias("target"))


def _rate(lam: Column, x: Column, most: float) -> Column:
    return F.lit(float(most)) / (1 + F.exp(-lam * x))


def _exact(x: Column) -> Column:
    """A sum of doubles that does not depend on their order."""
    return F.sum(x.cast("decimal(38,9)")).cast("double")


def dual(cells: DataFrame, goals: DataFrame, most: float) -> DataFrame:
    """(source, lam, scale, target) at the minimum of the dual; cells: (source, size, n)."""
    scale = cells.filter("size > 0").groupBy("source").agg(_exact(F.col("size") * F.col("n")).alias("tokens"), F.sum("n").alias("docs"))
    state = goals.join(scale, goals.source.eqNullSafe(scale.source)).select(goals.source, "target", (F.col("tokens") / F.col("docs")).alias("scale"), "tokens")
    # A source that is used up (or not at all) has its minimum at infinity.
    share = F.col("target") / (F.col("tokens") * float(most))
    state = state.select("source", "target", "scale", F.when(share >= 1 - 1e-12, F.lit(float("inf"))).when(share <= 1e-12, F.lit(float("-inf"))).otherwise(F.lit(0.0)).alias("lam"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), F.lit(False).alias("done"))
    state = staged(state, "dual")
    for _ in range(ROUNDS):
        here = cells.filter("size > 0").join(state.filter("NOT done AND abs(lam) < double('inf')"), cells.source.eqNullSafe(state.source)).select(state.source, "size", "n", "lam", (F.col("size") / F.col("scale")).alias("x"))
        w = _rate(F.col("lam"), F.col("x"), most)
        sums = here.groupBy("source").agg(_exact(w * F.col("size") * F.col("n")).alias("got"), _exact(w * (1 - w / most) * F.col("x") * F.col("size") * F.col("n")).alias("slope"))
        both = state.join(sums, state.source.eqNullSafe(sums.source), "left").select(state["*"], "got", "slope")
        gap = F.col("got") - F.col("target")
        low, high = F.when(gap < 0, F.col("lam")).otherwise(F.col("low")), F.when(gap > 0, F.col("lam")).otherwise(F.col("high"))
        step = F.col("lam") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (step > low) & (step < high)
        # Outside of the bracket: halve it where both ends are known, else go out in doubling steps.
        middle = F.when((low > -1e6) & (high < 1e6), (low + high) / 2).when(gap < 0, F.greatest(F.col("lam") * 2, F.lit(1.0))).otherwise(F.least(F.col("lam") * 2, F.lit(-1.0)))
        met = F.abs(gap) <= TOLERANCE * F.col("target")
        done = F.col("done") | F.col("got").isNull() | met
        state = staged(both.select("source", "target", "scale", F.when(done, F.col("lam")).when(inside, step).otherwise(middle).alias("lam"), F.when(done, F.col("low")).otherwise(low).alias("low"), F.when(done, F.col("high")).otherwise(high).alias("high"), done.alias("done")), "dual")
        if not state.filter("NOT done").limit(1).count():
            break
    return state.select("source", "target", "scale", "lam")


def whole_copies(cells: DataFrame, solved: DataFrame, most: int) -> DataFrame:
    """(source, size, n, copies): how many copies all documents of a source and size get together."""
    at = cells.join(solved, cells.source.eqNullSafe(solved.source), "left").select(cells.source, "size", "n", F.coalesce(F.when(F.col("lam") == float("inf"), F.lit(float(most))).when(F.col("lam") == float("-inf"), F.lit(0.0)).otherwise(_rate(F.col("lam"), F.col("size") / F.col("scale"), most)), F.lit(0.0)).alias("rate"))
    # One row per source with its different sizes: their number is bounded by the longest document.
    lists = at.groupBy("source").agg(F.expr("array_sort(collect_list(struct(-size AS minus, n, rate)))").alias("cells"))
    walked = f"""
      flatten(aggregate(
        sequence(0, cast((size(cells) - 1) / {CHUNK} AS int)),
        named_struct('owed', 0D, 'out', cast(array() AS array<array<struct<size: bigint, n: bigint, copies: bigint>>>)),
        (chunks, c) -> aggregate(
          slice(cells, c * {CHUNK} + 1, {CHUNK}),
          named_struct('owed', chunks.owed, 'out', cast(array() AS array<struct<size: bigint, n: bigint, copies: bigint>>)),
          (done, cell) -> transform(
            array(IF(cell.minus = 0, 0L, cast(least(greatest(round((done.owed - cell.minus * cell.n * cell.rate) / -cell.minus), 0D), cast({most} * cell.n AS double)) AS bigint))),
            k -> named_struct(
              'owed', done.owed - cell.minus * cell.n * cell.rate + cell.minus * k,
              'out', concat(done.out, array(named_struct('size', -cell.minus, 'n', cell.n, 'copies', k)))))[0],
          made -> named_struct('owed', made.owed, 'out', concat(chunks.out, array(made.out)))),
        chunks -> chunks.out))"""
    return lists.select("source", F.explode(F.expr(walked)).alias("c")).select("source", "c.*")


def mixed(docs: DataFrame, weights: list[float], share: float, most: int = 2, text: str = "text", source: str = "source", id: str = "doc_id") -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) for each row of docs: size counts its words,
    taken = copies * size, copies in 0..most.

    Null, empty and blank texts have size 0 and no copies; a null source is a source of its own, last
    in order; repeated rows are documents of their own, interchangeable where their ids are equal;
    rows with a null id take part; an empty table gives an empty result.  Other columns are not
    read."""
    rows = staged(docs.select(docs[id].cast("long").alias("doc_id"), docs[source].alias("source"), word_count(docs[text]).alias("size")), "sizes")
    cells = staged(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    goals = staged(targets(cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, float(most)), "targets")
    shares = staged(whole_copies(cells, dual(cells, goals, float(most)), most), "copies")
    # A key for (source, size) that joins null sources as well.
    key = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("source"), F.col("size"))
    about = shares.withColumn("key", key).join(goals, shares.source.eqNullSafe(goals.source)).select("key", "n", shares["copies"].alias("all_copies"), "source_size", "target")
    ranked = numbered(rows.select("doc_id", "size", key.alias("key")), ["key"], ["doc_id"])
    copies = F.expr("CAST(all_copies DIV n + IF(rn < all_copies % n, 1, 0) AS bigint)")
    return ranked.join(about, "key").select("doc_id", ranked["size"], "source_size", "target", copies.alias("copies"), (copies * ranked["size"]).alias("taken"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"), [5, 2, 1], 1.5).select("doc_id", "size", "source_size", "target", "taken", "copies")
