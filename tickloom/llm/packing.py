"""Best-two-fit packing of tokenised documents into sequences.

Documents are tokenised once, map-side; only documents longer than a sequence
are cut. Pieces differ for packing by their length alone, so the packing is
worked out on the histogram of lengths (at most ``seq_len`` counts, all that
reaches the driver): a bin is filled greedily, largest length that fits first;
then its smallest piece is replaced by two unpacked ones that fill the gap it
leaves more tightly, as long as that helps. A filled bin repeats for as long as
its lengths last, so the plan is a short list of runs. Pieces take their place
in it by their rank among pieces of the same length: rank inside the partition
plus a running count over partitions. No sort, no window over the pieces.

Defined results: null text counts as empty; an empty document is the end id
alone. Null ids and repeated rows are packed like other rows. An empty table
gives an empty result. Extra columns named in ``keep`` are carried along unless the result has the name.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tickloom.llm.common import giving_back, staged, text_of
from tickloom.llm.tokencount import CHUNK_BYTES, WordCounter, token_ids, word_counter

SEQ_LEN = 2048
END_ID = 0
_ROWS = 1024                # pieces in one batch of results


def whole_ids(texts: pa.Array, counter: WordCounter, limit: int = CHUNK_BYTES):
    """(row, little-endian 32-bit token ids) of every text of a binary column, in
    turn. Distinct words of a chunk are tokenised once, as ragged arrays."""
    row, held = 0, []
    for rows, counts, ids in token_ids(texts, counter, limit):
        data, begin = ids.astype("<u4").tobytes(), 0
        for r, end in zip(rows.tolist(), (np.cumsum(counts) * 4).tolist()):
            while row < r:
                yield row, b"".join(held)
                row, held = row + 1, []
            held.append(data[begin:end])
            begin = end
    while row < len(texts):
        yield row, b"".join(held)
        row, held = row + 1, []


def _pieces(tokenizer: str, seq_len: int, end_id: int, keep_ids: bool, keep: list[str], schema: pa.Schema):
    end = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * seq_len

    def run(batches):
        counter, seen = word_counter(tokenizer), [0] * (seq_len + 1)
        part = TaskContext.get().partitionId()
        for batch in batches:
            def results():
                kept = [batch.column(j).take(pa.array(row, pa.int32())) for j in range(len(keep))]
                cols = [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                        pa.array([part] * len(row), pa.int32()), pa.array(rank, pa.int64())]
                return pa.RecordBatch.from_arrays(
                    kept + cols + ([pa.array(ids, pa.binary())] if keep_ids else []), names=schema)

            row, piece, start, length, crc, rank, ids = [], [], [], [], [], [], []
            for i, data in whole_ids(batch.column(batch.num_columns - 1), counter):
                data += end
                for k, b in enumerate(range(0, len(data), step)):
                    part_ids = data[b:b + step]
                    n = len(part_ids) // 4
                    row.append(i), piece.append(k), start.append(b // 4), length.append(n)
                    crc.append(zlib.crc32(part_ids)), rank.append(seen[n])
                    seen[n] += 1
                    if keep_ids:
                        ids.append(part_ids)
                if len(row) >= _ROWS:
                    yield results()
                    row, piece, start, length, crc, rank, ids = [], [], [], [], [], [], []
            if row:
                yield results()
    return run


def tokenised(docs: DataFrame, tokenizer: str, keep: list[str], text: str = "text", seq_len: int = SEQ_LEN,
              end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece; ``_p_part`` and ``_p_rank`` number pieces of a length."""
    src = docs.select(*keep, text_of(text).cast("binary").alias("_p_text"))
    fields = [src.schema[c] for c in keep] + [
        T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("_p_part", T.IntegerType()), T.StructField("_p_rank", T.LongType())]
    fields += [T.StructField("ids", T.BinaryType())] if keep_ids else []
    schema = T.StructType(fields)
    run = _pieces(tokenizer, seq_len, end_id, keep_ids, keep, [f.name for f in fields])
    return src.mapInArrow(giving_back(run), schema)


def best_two_fit(counts: dict[int, int], seq_len: int = SEQ_LEN) -> list[tuple[int, dict[int, int]]]:
    """Runs (repeats, {length: copies}) that use up ``counts``."""
    left = {n: c for n, c in counts.items() if c > 0}
    order = sorted(left)
    runs = []
    while left:
        used: dict[int, int] = {}
        gap = seq_len

        def spare(n):
            return left[n] - used.get(n, 0)

        i = len(order) - 1
        while gap > 0 and i >= 0:
            i = min(i, bisect_right(order, gap) - 1)
            if i < 0:
                break
            n = order[i]
            take = min(spare(n), gap // n)
            if take:
                used[n] = used.get(n, 0) + take
                gap -= take * n
            i -= 1
        while gap > 0 and sum(used.values()) > 1:
            small = min(used)
            room, best = gap + small, (small, None)
            lo, hi = 0, bisect_right(order, room) - 1
            while lo <= hi:                       # two pointers over the lengths left
                a, b = order[lo], order[hi]
                if spare(b) < 1 or a + b > room:
                    hi -= 1
                elif spare(a) < (2 if lo == hi else 1):
                    lo += 1
                else:
                    if a + b > best[0]:
                        best = (a + b, (a, b))
                        if a + b == room:
                            break
                    lo += 1
            if best[1] is None:
                break
            used[small] -= 1
            if not used[small]:
                del used[small]
            for n in best[1]:
                used[n] = used.get(n, 0) + 1
            gap = room - best[0]
        repeats = min(left[n] // c for n, c in used.items())
        runs.append((repeats, dict(sorted(used.items(), reverse=True))))
        for n, c in used.items():
            left[n] -= repeats * c
            if not left[n]:
                del left[n]
                order.pop(bisect_right(order, n) - 1)
    return runs


def _segments(runs) -> dict[str, np.ndarray]:
    """Per run and length: which ranks it takes and where they go."""
    taken, seq, rows = {}, 0, []
    for repeats, used in runs:
        offset = 0
        for n, c in used.items():
            first = taken.get(n, 0)
            rows.append((n, first, c, seq, offset))
            taken[n] = first + repeats * c
            offset += n * c
        seq += repeats
    rows.sort()
    a = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return {"key": (a[:, 0] << 48) + a[:, 1], "first": a[:, 1], "copies": a[:, 2], "seq": a[:, 3], "offset": a[:, 4]}


def pack(docs: DataFrame, tokenizer: str, keep: list[str], text: str = "text", seq_len: int = SEQ_LEN,
         end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``keep`` columns, ``piece, start, length, ids_crc32,
    sequence_id, offset`` and, on request, the ids."""
    keep = [c for c in keep if c not in ("piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset")]
    pieces = staged(tokenised(docs, tokenizer, keep, text, seq_len, end_id, keep_ids), "pack-pieces")
    counts = pieces.groupBy("length", "_p_part").agg(F.count(F.lit(1)).alias("_p_n"))
    before = Window.partitionBy("length").orderBy("_p_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_p_before", F.coalesce(F.sum("_p_n").over(before), F.lit(0))).drop("_p_n")
    hist = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("_p_n")).collect()}
    seg = _segments(best_two_fit(hist, seq_len))
    out_cols = [c for c in pieces.columns if c not in ("_p_part", "_p_rank")]
    ranked = pieces.join(starts, ["length", "_p_part"]).select(
        *out_cols, (F.col("_p_rank") + F.col("_p_before")).alias("_p_rank"))
    schema = T.StructType([ranked.schema[c] for c in out_cols] + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = [f.name for f in schema]

    def place(batches):
        for batch in batches:
            n = batch.column(names.index("length")).to_numpy()
            rank = batch.column(batch.num_columns - 1).to_numpy()
            at = np.searchsorted(seg["key"], (n << 48) + rank, side="right") - 1
            k = rank - seg["first"][at]
            c = seg["copies"][at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(j) for j in range(batch.num_columns - 1)]
                + [pa.array(seg["seq"][at] + k // c), pa.array(seg["offset"][at] + (k % c) * n)], names=names)

    return ranked.mapInArrow(giving_back(place), schema)
