"""Sharding as a minimax contiguous partition.

Atomic groups (rows of equal text) stand in the order of a 64-bit hash of the
text. The smallest capacity at which at most ``shards`` contiguous runs hold
all groups is found by binary search, each capacity checked greedily; the cuts
are where that greedy pass cuts.

The order is summed into 2^14 cells, which is all that reaches the driver. A
cell in which the greedy pass cuts (at the capacity found or at the one below,
which fails) is opened into 2^14 finer cells and the search repeats, until
every such cell is a single group: the capacity is then the exact optimum over
the groups themselves, at any input size, with a bounded driver.

Defined results: null text counts as no bytes (size 1). Equal texts share a
shard. Null ids and repeated rows are placed like any other row. Fewer groups
than shards leave shards empty; an empty table gives an empty result. Extra
columns pass through, but for those the result replaces by name.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.common import replacing, staged, text_of

SHARDS = 16
LAW = "bytes"
CELL_BITS = 14      # cells per level: 16,384
SUB_CELLS = 64      # pieces of one cell when slots are numbered


def _greedy(ends: list[int], biggest: int, capacity: int, shards: int) -> list[int] | None:
    """Indices of the first cell of each further run, or None if it takes more
    than ``shards`` runs. ``ends`` are running totals."""
    if biggest > capacity:
        return None
    cuts, done, at = [], 0, 0
    while at < len(ends):
        at = bisect_right(ends, done + capacity, at)
        if at < len(ends):
            cuts.append(at)
            if len(cuts) >= shards:
                return None
        done = ends[at - 1]
    return cuts


def minimax_cuts(sizes: list[int], shards: int) -> tuple[int, list[int], list[int]]:
    """Smallest feasible capacity, its cuts, and where the greedy pass would cut
    at one less (the cells that decide whether a smaller one exists)."""
    if not sizes:
        return 0, [], []
    ends, biggest = list(accumulate(sizes)), max(sizes)
    lo, hi = max(biggest, -(-ends[-1] // shards)), ends[-1]
    while lo < hi:
        mid = (lo + hi) // 2
        if _greedy(ends, biggest, mid, shards) is None:
            lo = mid + 1
        else:
            hi = mid
    tight, done, at = [], 0, 0
    while at < len(ends) and len(tight) < shards:      # the pass at lo - 1
        nxt = max(bisect_right(ends, done + lo - 1, at), at + (sizes[at] > lo - 1))
        if nxt < len(ends):
            tight.append(nxt)
        at, done = nxt, ends[nxt - 1]
    over = [i for i, x in enumerate(sizes) if x > lo - 1][:shards]
    return lo, _greedy(ends, biggest, lo, shards) or [], sorted({*tight, *over})


def _cell(key: Column, level: int) -> Column:
    """Number of the cell of this level; monotone in the signed key."""
    return F.shiftright(key, max(0, 64 - CELL_BITS * level))


def cut_keys(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """Capacity and the first key of each further shard. ``groups`` has ``_s_key``
    and ``_s_size`` and may hold one row per document: sums are map-side first."""
    def sums(rows: DataFrame, level: int) -> list:
        cell = _cell(F.col("_s_key"), level).alias("cell")
        return (rows.groupBy(cell).agg(F.sum("_s_size").alias("size"), F.min("_s_key").alias("first"),
                                       F.max("_s_key").alias("last")).collect())

    cells = [(r["first"], r["last"], r["size"], 1) for r in sums(groups, 1)]
    while True:
        cells.sort()
        capacity, cuts, tight = minimax_cuts([c[2] for c in cells], shards)
        # a cut before cell i depends on how cells i - 1 and i divide
        open_ = {i for j in (*cuts, *tight) for i in (j - 1, j) if 0 <= i < len(cells) and cells[i][0] != cells[i][1]}
        if not open_:
            return capacity, [cells[i][0] for i in cuts]
        finer = []
        for level in sorted({cells[i][3] for i in open_}):
            inside = F.lit(False)
            for i in open_:
                if cells[i][3] == level:
                    inside = inside | F.col("_s_key").between(cells[i][0], cells[i][1])
            finer += [(r["first"], r["last"], r["size"], level + 1) for r in sums(groups.where(inside), level + 1)]
        cells = [c for i, c in enumerate(cells) if i not in open_] + finer


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row without its text: ``size``, ``shard``, ``slot``."""
    t = text_of(text)
    docs = replacing(docs, "size", "shard", "slot")
    rows = docs.withColumns({"size": F.octet_length(t).cast("long") + 1, "_s_key": F.xxhash64(t)}).drop(text)
    rows = staged(rows, "shard-rows")
    _, cuts = cut_keys(rows.select("_s_key", F.col("size").alias("_s_size")), shards)
    number = F.lit(0)
    for key in cuts:
        number = number + (F.col("_s_key") >= F.lit(key)).cast("int")
    rows = rows.withColumns({"shard": number.cast("int"), "_s_cell": _cell(F.col("_s_key"), 1),
                             "_s_sub": F.pmod(F.xxhash64(id_col), F.lit(SUB_CELLS)).cast("int")})
    # slots: running count of the pieces before, plus the place inside the piece;
    # a hot group is spread over SUB_CELLS pieces by its ids
    piece = ["shard", "_s_cell", "_s_sub"]
    counts = rows.groupBy(*piece).agg(F.count(F.lit(1)).alias("_s_n"))
    before = Window.partitionBy("shard").orderBy("_s_cell", "_s_sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_s_start", F.coalesce(F.sum("_s_n").over(before), F.lit(0))).drop("_s_n")
    place = Window.partitionBy(*piece).orderBy("_s_key", id_col)
    return (rows.withColumn("_s_at", F.row_number().over(place) - 1).join(starts, piece)
            .withColumn("slot", (F.col("_s_start") + F.col("_s_at")).cast("long"))
            .drop("_s_key", "_s_cell", "_s_sub", "_s_at", "_s_start"))
