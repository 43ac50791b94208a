"""Ranked lexical search by bag deduplication.

For a set of query items, every document is reduced in one pass to its bag: the
counts of those of its terms that some item holds, and its length in terms.
Documents with the same bag and the same length norm ``m`` score alike for every
item, so they form a class: classes are found by a hash of bag and norm and told
apart by the bags themselves (grouping compares both, with map-side partial
aggregation, so a class of any size costs one row a task). Each class is scored
once; a task keeps the best ``TOP`` classes of each item, and only classes that
win for some item are expanded into documents, by ascending id, of which again
``TOP`` at most matter.

Items are taken in blocks of about ``BLOCK_ITEMS`` items and ``BLOCK_POSTINGS``
distinct item terms; only a block's vocabulary and its winners' keys are sent to
all tasks, so neither grows with the documents.

Defined results: a null or empty text has no term; such documents count neither
in N nor in L and score nothing, such items have no result. Rows of one
``doc_id`` are documents of their own; a null id comes after all others. Items of
equal id and text count once; of equal id and another text each has its own
ranks. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.common import staged, text_of

TOP = 20
BLOCK_ITEMS = 20_000
BLOCK_POSTINGS = 500_000
CHUNK_BYTES = 4 << 20       # text that is split at once
CELLS = 1 << 22             # scores, or single products, held at once
#: Term characters are all but ASCII ones that are no digit or letter; only A-Z are lower-cased.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() and chr(b) not in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
              else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms(text: memoryview | bytes, limit: int = CHUNK_BYTES):
    """The terms of a UTF-8 text in lists, of about ``limit`` bytes each."""
    folded, at = bytes(text).translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + limit) if len(folded) - at > limit else -1
        yield folded[at:end if end >= 0 else len(folded)].split()
        at = end if end >= 0 else len(folded)


def _counts(text, number) -> tuple[int, dict[int, int]]:
    total, tf = 0, {}
    for found in terms(text):
        total += len(found)
        for t in map(number, found):
            if t is not None:
                tf[t] = tf.get(t, 0) + 1
    return total, tf


def _item_terms(batches):
    """(item_key, text) -> (item_key, term, repeats)."""
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            tf: dict[bytes, int] = {}
            for found in terms(text):
                for t in found:
                    tf[t] = tf.get(t, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([key] * len(tf), pa.int64()), pa.array(list(tf), pa.binary()),
                                              pa.array(list(tf.values()), pa.int64())], ["item_key", "term", "repeats"])


def _bags(number: dict[bytes, int]):
    """(doc_id, text) -> (doc_id, n, bag): pairs of term number and count, as
    little-endian 32-bit integers, by term number."""
    def run(batches):
        for batch in batches:
            ns, bags = [], []
            for text in batch.column(1):
                n, tf = _counts(text.as_buffer() or b"", number.get)
                ns.append(n)
                bags.append(np.array(sorted(tf.items()), "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ns, pa.int64()), pa.array(bags, pa.binary())],
                                             ["doc_id", "n", "bag"])
    return run


def _flat(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term numbers, counts and how many of them each bag has."""
    pairs = np.frombuffer(b"".join(bags.to_pylist()), "<i4").reshape(-1, 2)
    lens = np.array([len(b) // 8 for b in bags.to_pylist()], np.int64)
    return pairs[:, 0].astype(np.int64), pairs[:, 1].astype(np.int64), lens


def _frequencies(size: int):
    """(bag, docs) -> a partial document frequency per term."""
    def run(batches):
        df = np.zeros(size, np.int64)
        for batch in batches:
            term, _, lens = _flat(batch.column(0))
            np.add.at(df, term, np.repeat(batch.column(1).to_numpy(), lens))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["term", "df"])
    return run


class Best:
    """The best classes of each item so far: higher score, then smaller id."""

    def __init__(self, items: int, top: int):
        self.items, self.top, self.floor = items, top, np.ones(items, np.int64)
        self.kept = [np.zeros(0, np.int64)] * 5             # item, score, first id, hash, norm

    def offer(self, scores: np.ndarray, first: np.ndarray, hashes: np.ndarray, norms: np.ndarray) -> None:
        floor = self.floor
        if len(scores) > self.top:
            floor = np.maximum(floor, np.partition(scores, len(scores) - self.top, axis=0)[-self.top])
        row, item = np.nonzero(scores >= floor)
        new = [item, scores[row, item], first[row], hashes[row], norms[row]]
        item, score, ids, h, m = (np.concatenate(p) for p in zip(self.kept, new))
        order = np.lexsort((ids, -score, item))
        starts = np.flatnonzero(np.diff(item[order], prepend=-1))
        within = np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))
        order = order[within < self.top]
        self.kept = [c[order] for c in (item, score, ids, h, m)]
        full = order[np.searchsorted(item[order], np.arange(self.items), side="right") - 1] if len(order) else order
        counts = np.bincount(item[order], minlength=self.items)
        has = counts >= self.top
        self.floor[has] = score[full[has]]


_NO_ID = np.iinfo(np.int64).max


def _score(indptr: np.ndarray, items: np.ndarray, weight: np.ndarray, n_items: int, top: int):
    """Classes (bag, m, first_id, h) -> each task's best per item. Postings of a
    term lie at ``indptr[term]:indptr[term + 1]``; ``weight`` is w times repeats."""
    def run(batches):
        best = Best(n_items, top)
        for batch in batches:
            term, tf, lens = _flat(batch.column(0))
            m, h = batch.column(1).to_numpy(), batch.column(3).to_numpy()
            first = batch.column(2).fill_null(_NO_ID).to_numpy()
            value = 1_000_000_000 * tf // (1000 * tf + 12 * np.repeat(m, lens))
            spread = indptr[term + 1] - indptr[term]
            ends = np.cumsum(lens)
            products = np.concatenate([[0], np.cumsum(spread)])[ends]       # up to the end of each class
            at = 0
            while at < batch.num_rows:
                done = products[at - 1] if at else 0
                to = min(at + max(1, CELLS // n_items), int(np.searchsorted(products, done + CELLS, side="right")))
                to = min(max(to, at + 1), batch.num_rows)
                a, b = (int(ends[at - 1]) if at else 0), int(ends[to - 1])
                s = spread[a:b]
                post = np.repeat(indptr[term[a:b]] - (np.cumsum(s) - s), s) + np.arange(int(s.sum()))
                row = np.repeat(np.repeat(np.arange(to - at), lens[at:to]), s)
                scores = np.zeros((to - at) * n_items, np.int64)
                np.add.at(scores, row * n_items + items[post], np.repeat(value[a:b], s) * weight[post])
                best.offer(scores.reshape(-1, n_items), first[at:to], h[at:to], m[at:to])
                at = to
        item, score, ids, h, m = best.kept
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(score), pa.array(ids, mask=ids == _NO_ID), pa.array(h), pa.array(m)],
            ["item", "score", "first_id", "h", "m"])
    return run


def _first(rows: DataFrame, by: list[str], order: list[Column], top: int, rank: str) -> DataFrame:
    """The ``top`` rows of each group, numbered; Spark limits groups before the shuffle."""
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= top)


def _block(docs: DataFrame, postings: list, top: int) -> DataFrame | None:
    """Best documents of one block of items; ``postings`` are (item_key, term, repeats)."""
    spark = docs.sparkSession
    keys = sorted({p[0] for p in postings})
    words = sorted({bytes(p[1]) for p in postings})
    item_no, number = {k: i for i, k in enumerate(keys)}, {w: i for i, w in enumerate(words)}
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text"))
    bags = staged(src.mapInArrow(_bags(number), "doc_id long, n long, bag binary"), "search-bags")
    n_docs, n_terms = bags.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n_docs:
        return None
    norm = F.expr(f"75 + cast({25 * n_docs} as decimal(38,0)) * n div {n_terms}").cast("long")
    bags = bags.where(F.octet_length("bag") > 0).withColumn("m", norm).withColumn("h", F.xxhash64("bag", "m"))
    classes = staged(bags.groupBy("h", "m", "bag").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("docs")),
                     "search-classes")
    partial = classes.select("bag", "docs").mapInArrow(_frequencies(len(words)), "term long, df long")
    df = np.zeros(len(words), np.int64)
    for t, n in partial.groupBy("term").agg(F.sum("df")).collect():         # at most the block's vocabulary
        df[t] = n
    w = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df]
    rows = sorted((number[bytes(t)], item_no[k], r) for k, t, r in postings)
    indptr = np.searchsorted(np.array([r[0] for r in rows], np.int64), np.arange(len(words) + 1))
    items = np.array([r[1] for r in rows], np.int64)
    weight = np.array([w[t] * r for t, _, r in rows], np.int64)
    scored = classes.select("bag", "m", "first_id", "h").mapInArrow(
        _score(indptr, items, weight, len(keys), top), "item long, score long, first_id long, h long, m long")
    best = [F.col("score").desc(), F.col("first_id").asc_nulls_last()]
    winners = staged(_first(scored, ["item"], [*best, "h", "m"], top, "place").drop("place"), "search-winners")
    # at most top classes per item of the block: a bounded list of keys
    won = bags.join(F.broadcast(winners.select("h", "m").distinct()), ["h", "m"], "left_semi")
    by_id = [F.col("doc_id").asc_nulls_last()]
    members = _first(won.select("h", "m", "bag", "doc_id"), ["h", "m", "bag"], by_id, top, "member")
    members = members.withColumn("first_id", F.first("doc_id").over(
        Window.partitionBy("h", "m", "bag").orderBy("member")))
    same = [members[c].eqNullSafe(winners[c]) for c in ("h", "m", "first_id")]
    pairs = winners.join(members.drop("bag", "member"), same[0] & same[1] & same[2]).select("item", "score", "doc_id")
    ranked = _first(pairs, ["item"], [F.col("score").desc(), *by_id], top, "rank")
    names = spark.createDataFrame(pa.table({"item": pa.array(range(len(keys)), pa.int64()),
                                            "item_key": pa.array(keys, pa.int64())}))
    return ranked.join(F.broadcast(names), "item").select("item_key", "rank", "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, block_items: int = BLOCK_ITEMS,
           block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents with a score
    above 0 of each item of ``queries`` (``item_id, text``)."""
    spark = docs.sparkSession
    items = staged(queries.select("item_id", text_of().alias("text")).distinct()
                   .withColumn("item_key", F.monotonically_increasing_id()), "search-items")
    postings = staged(items.select("item_key", F.col("text").cast("binary").alias("text"))
                      .mapInArrow(_item_terms, "item_key long, term binary, repeats long"), "search-postings")
    blocks = max(1, -(-items.count() // block_items), -(-postings.count() // block_postings))
    out = spark.createDataFrame([], "item_key long, rank int, doc_id long, score long")
    for b in range(blocks):
        held = postings.where(F.pmod(F.xxhash64("item_key"), F.lit(blocks)) == b)
        held = [tuple(r) for r in held.collect()]           # one block's terms
        found = _block(docs, held, top) if held else None
        out = out if found is None else out.unionByName(found)
    return out.join(items.select("item_key", "item_id"), "item_key").select("item_id", "rank", "doc_id", "score")
