"""Mixing sources to target token weights by entropy balancing.

Among all document rates that meet every source's token target, the ones
closest in relative entropy to taking each document once are exponentially
tilted: ``rate = exp(lambda_source)``. The multipliers solve the convex dual
``sum(size * exp(lambda)) - lambda * target`` by Newton steps, each one an
aggregate over the documents, grouped beforehand into classes of equal source
and size (their rates are equal). The rates are then rounded into whole copies
per class, systematically along the sizes: long and short documents of a source
are taken at the same rate, and its words end within one document of the target.
A class's odd copies go to its rows with the smallest hashes.

Targets: sources in code-point order (null last) weigh ``WEIGHTS`` repeating
and share ``BUDGET`` of all words; a target stops at ``MAX_COPIES`` times its
source's words and the excess is shared among the others by weight.

Defined results: null text has no words; a document without words takes none of
them, and is repeated at its source's rate like any other.
Null ids are hashed like any value. Rows with equal id, source and text are
treated alike, so a source with repeated rows may miss its target by the last
class's repeats. An empty table gives an empty result. Extra columns pass
through; the report replaces those of its own names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.common import WORD, replacing, staged, text_of

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
MAX_COPIES = 2
MAX_STEPS = 40
TOLERANCE = 1e-9
RANK_BUCKETS = 256
NUDGES = 4              # copies moved per source after rounding
_CLASS = ["_m_sid", "size"]


def targets(sources: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MAX_COPIES) -> DataFrame:
    """``source, source_size`` (one row per source) plus ``_m_sid`` and ``target``.
    Water level: in the order of ``most * size / weight`` the first sources are
    the capped ones; the level is what the rest get per unit of weight."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sources.withColumn("_m_sid", F.row_number().over(by_name) - 1)
    turn = F.col("_m_sid") % len(weights)
    weight = F.lit(float(weights[-1]))
    for i, w in reversed(list(enumerate(weights[:-1]))):
        weight = F.when(turn == i, F.lit(float(w))).otherwise(weight)
    s = s.withColumns({"_m_w": weight, "_m_cap": F.lit(float(most)) * F.col("source_size")})
    order = Window.orderBy(F.col("_m_cap") / F.col("_m_w"), "_m_sid")
    whole = Window.partitionBy()
    s = s.withColumns({
        "_m_full": F.coalesce(F.sum("_m_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "_m_left": F.sum("_m_w").over(order.rowsBetween(0, Window.unboundedFollowing)),
        "_m_all": F.lit(float(budget)) * F.sum("source_size").over(whole),
        "_m_pos": F.row_number().over(order)})
    s = s.withColumn("_m_tau", (F.col("_m_all") - F.col("_m_full")) / F.col("_m_left"))
    fits = F.when(F.col("_m_tau") * F.col("_m_w") <= F.col("_m_cap"), F.struct("_m_pos", "_m_tau"))
    s = s.withColumn("_m_level", F.min(fits).over(whole)["_m_tau"])
    return s.select("source", "_m_sid", "source_size", F.coalesce(
        F.least(F.col("_m_cap"), F.col("_m_level") * F.col("_m_w")), F.col("_m_cap")).alias("target"))


def solve(classes: DataFrame, goals: DataFrame, steps: int = MAX_STEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """``_m_sid, _m_lambda``: Newton on the dual, one aggregate per step."""
    lam = goals.select("_m_sid", "target", F.lit(0.0).alias("_m_lambda"))
    for _ in range(steps):
        words = (classes.join(lam, "_m_sid").groupBy("_m_sid")
                 .agg(F.sum(F.col("_m_n") * F.col("size") * F.exp("_m_lambda")).alias("_m_g")))
        step = F.when(F.col("_m_g") > 0, (F.col("target") - F.col("_m_g")) / F.col("_m_g")).otherwise(F.lit(0.0))
        # a source without words or target has nothing to solve
        step = F.when(F.col("target") > 0, step).otherwise(F.lit(0.0))
        nxt = staged(lam.join(words, "_m_sid", "left").select(
            "_m_sid", "target", (F.col("_m_lambda") + F.coalesce(step, F.lit(0.0))).alias("_m_lambda"),
            F.abs(F.coalesce(step, F.lit(0.0))).alias("_m_step")), "mix-newton")
        lam = nxt.drop("_m_step")
        worst = nxt.agg(F.max("_m_step")).first()[0]
        if worst is None or worst < tolerance:
            break
    return lam.select("_m_sid", "_m_lambda")


def round_copies(classes: DataFrame, goals: DataFrame, lam: DataFrame, most: int = MAX_COPIES) -> DataFrame:
    """``_m_k``: whole copies per class. Systematic rounding along the documents
    of a source by size: those before and in a class take ``floor(rate * number
    + start)`` copies together, so every stretch of sizes keeps the rate. Then
    at most ``NUDGES`` single copies per source are added or taken away, each of
    the size that brings the words nearest to the target."""
    goals = goals.select("_m_sid", "target", (F.pmod(F.xxhash64("source"), F.lit(1 << 20)) / (1 << 20)).alias("_m_u"))
    c = classes.join(goals, "_m_sid").join(lam, "_m_sid")
    # rounded: a rate of one or two copies is met exactly
    c = c.withColumn("_m_q", F.when(F.col("target") > 0, F.least(F.round(F.exp("_m_lambda"), 9), F.lit(float(most)))).otherwise(0.0))
    source = Window.partitionBy("_m_sid")
    c = c.withColumn("_m_upto", F.sum("_m_n").over(source.orderBy("size").rowsBetween(Window.unboundedPreceding, 0)))

    def copies(number):
        return F.floor(F.col("_m_q") * number + F.col("_m_u"))

    c = c.withColumn("_m_k", copies(F.col("_m_upto")) - copies(F.col("_m_upto") - F.col("_m_n")))
    for _ in range(NUDGES):
        c = c.withColumn("_m_r", F.col("target") - F.sum(F.col("_m_k") * F.col("size")).over(source))
        can = F.when(F.col("_m_r") > 0, F.col("_m_k") < F.lit(most) * F.col("_m_n")).otherwise(F.col("_m_k") > 0)
        gap = F.abs(F.abs("_m_r") - F.col("size"))
        nearer = can & (gap < F.abs("_m_r"))
        c = c.withColumn("_m_o", F.min(F.when(nearer, F.struct(gap.alias("gap"), "size"))).over(source)["size"])
        c = c.withColumn("_m_k", F.col("_m_k") + F.when(
            nearer & (F.col("size") == F.col("_m_o")), F.signum("_m_r")).otherwise(0).cast("long"))
    return c.select(*_CLASS, "_m_n", "_m_k")


def mix(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """One row per input row without its text: ``size, source_size, target,
    copies, taken``, and ``_m_h``, the hash that picks rows inside a class."""
    t = text_of(text)
    docs = replacing(docs, *({"size", "source_size", "target", "copies", "taken"} - {source_col}))
    rows = docs.withColumns({"size": F.regexp_count(t, F.lit(WORD + "+")).cast("long"),
                             "_m_source": F.col(source_col), "_m_h": F.xxhash64(F.col(id_col), t)}).drop(text)
    rows = staged(rows, "mix-rows")
    per_class = rows.groupBy(F.col("_m_source").alias("source"), "size").agg(F.count(F.lit(1)).alias("_m_n"))
    goals = staged(targets(per_class.groupBy("source").agg(F.sum(F.col("size") * F.col("_m_n")).alias("source_size"))),
                   "mix-targets")
    same = per_class["source"].eqNullSafe(goals["source"])
    classes = staged(per_class.join(goals, same).select("_m_sid", "size", "_m_n"), "mix-classes")
    copies = round_copies(classes, goals, solve(classes, goals))

    rows = (rows.join(goals.withColumnRenamed("source", "_m_name"),
                      F.col("_m_source").eqNullSafe(F.col("_m_name"))).drop("_m_name", "_m_source"))
    # rank inside a class, in pieces: a hot class is spread over RANK_BUCKETS
    piece = [*_CLASS, "_m_b"]
    rows = rows.withColumn("_m_b", F.pmod(F.col("_m_h"), F.lit(RANK_BUCKETS)).cast("int"))
    counts = rows.groupBy(*piece).agg(F.count(F.lit(1)).alias("_m_c"))
    before = Window.partitionBy(*_CLASS).orderBy("_m_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (counts.withColumn("_m_before", F.coalesce(F.sum("_m_c").over(before), F.lit(0))).drop("_m_c")
              .join(copies, _CLASS))
    rank = F.rank().over(Window.partitionBy(*piece).orderBy("_m_h")) + F.col("_m_before")
    rows = rows.join(starts, piece)
    extra = (rank <= F.col("_m_k") % F.col("_m_n")).cast("long")
    rows = rows.withColumn("copies", F.floor(F.col("_m_k") / F.col("_m_n")).cast("long") + extra)
    return (rows.withColumn("taken", F.col("copies") * F.col("size"))
            .drop("_m_sid", "_m_b", "_m_before", "_m_n", "_m_k"))


def mixed(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """The mix itself: the columns of ``docs``, each row repeated as often as it
    is taken. Decisions depend only on id, source and text."""
    plan = mix(docs.select(id_col, source_col, text), text, id_col, source_col)
    plan = (plan.where("copies > 0").groupBy("_m_h", F.col(source_col).alias("_m_src"))
            .agg(F.max("copies").cast("int").alias("_m_copies")))
    rows = docs.withColumn("_m_h", F.xxhash64(F.col(id_col), text_of(text)))
    out = rows.join(plan, (rows["_m_h"] == plan["_m_h"]) & rows[source_col].eqNullSafe(plan["_m_src"]))
    return (out.withColumn("_m_i", F.explode(F.array_repeat(F.lit(0), F.col("_m_copies"))))
            .select(*[F.col(c) if c != "_m_h" else rows[c] for c in docs.columns]))
