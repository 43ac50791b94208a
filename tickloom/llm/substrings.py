"""Removal of long repeated byte strings by a blockwise suffix sort with the ranks
of a difference-cover sample.

Every byte covered by a LENGTH-byte string that also starts anywhere else goes.
Spark tasks have no random access to the corpus, so suffixes travel as strips,
dealt to buckets. A bucket holds the strings around one
anchor: the GRAM-byte string with the smallest hash among those that lie in a
LENGTH-byte window (the leftmost on ties), so equal windows have equal anchors
at equal offsets and meet in the same bucket; anchors that occur once need no
comparison at all. An occurrence of an anchor travels as its strip, the bytes a
window through it can
reach (``LENGTH - GRAM`` to the left, LENGTH to the right). Equal strips are one
class and travel once; in a bucket with a single class all windows repeat and
no bytes travel at all.

A task sorts its buckets one after the other, BLOCK strips or one bucket at a
time. The suffixes at the positions of a difference cover modulo COVER are ranked
first, by COVER bytes and, where these tie, by the rank COVER bytes further on. The
suffixes at each other start follow from these ranks: by the bytes up to the next
position of the sample, then by the rank there. Suffixes of one start lie at equal
offsets from the anchor, so they meet the sample at equal shifts. Equal windows are
neighbours in that order, and neighbours count by their bytes: nothing rests on a
hash. A bucket of more than BUCKET classes is cut into buckets of its parts: the
window starts go by cells, and strips with an equal window in a cell share the bytes
that all windows of the cell have in common. Parts that are equal (by 128-bit keys)
are one class, parts that share nothing are done, and only the others' bytes travel;
where these are still too many, the cells get narrower, down to single windows.

Defined results: null text counts as empty; texts under LENGTH bytes lose
nothing. Repeated rows and equal texts of LENGTH bytes or more are wholly
covered. Null ids pass through. Removal works on bytes and may leave a partial
UTF-8 sequence, so kept texts are binary. An empty table gives an empty result. Extra
columns named in ``keep`` are carried along unless the result has the name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import bitmap, groups_of, in_bitmap, staged, text_of

LENGTH, GRAM = 400, 100
REACH = LENGTH - GRAM                       # windows of an anchor start up to this far before it
COVER = 73
#: a difference cover: the powers of 2 modulo 73 differ by every residue
COVER_SET = sorted({pow(2, k, COVER) for k in range(9)})
BUCKET = 8192                               # strips of a bucket that one task sorts
SPLIT = 4                                   # cells that the parts of a larger one are cut into
BLOCK = 2048                                # strips of small buckets that are sorted together
CHUNK = 1 << 19                             # bytes of a text worked on at once
GRAM_BITS = 1 << 25
_POS = 20                                   # low bits of an anchor's sort key: its place in a chunk

_rng = np.random.default_rng(400100)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 61, 1 << 62)) * 8 + 5
_UNBASE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Anchors:
    """Anchor positions of a text, with the hashes of their grams and strips."""

    def __init__(self):
        n = CHUNK + LENGTH + 1
        self.up, self.down = _powers(_BASE, n), _powers(_UNBASE, n)

    def _chunk(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, w = len(b), REACH + 1
        p = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[b] * self.up[:n], out=p[1:])
        gram = _mix((p[GRAM:] - p[:-GRAM]) * self.down[:n - GRAM + 1])
        m = len(gram)
        place = np.arange(m, dtype=np.uint64)
        key = (gram >> np.uint64(_POS) << np.uint64(_POS)) | place
        full = -(-m // w) * w
        rows = np.full(full, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
        rows[:m] = key
        rows = rows.reshape(-1, w)
        ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
        back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        least = np.minimum(back[:m - w + 1], ahead[w - 1:m]) & np.uint64((1 << _POS) - 1)
        at = least[np.concatenate([[True], least[1:] != least[:-1]])].astype(np.int64)
        return at, gram[at]

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(text)
        if n < LENGTH:
            return (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))
        b = np.frombuffer(text, dtype=np.uint8)
        parts = []
        for c in range(0, n - LENGTH + 1, CHUNK):       # windows that start in this chunk
            at, gram = self._chunk(b[c:min(n, c + CHUNK + LENGTH - 1)])
            parts.append((at + c, gram))
        at, first = np.unique(np.concatenate([a for a, _ in parts]), return_index=True)
        gram = np.concatenate([g for _, g in parts])[first]
        strip = [xxhash.xxh3_64_intdigest(text[max(0, s - REACH):s + LENGTH], seed=min(s, REACH)) for s in at.tolist()]
        return at.astype(np.int32), gram.view(np.int64), np.array(strip, dtype=np.uint64).view(np.int64)


def anchored(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, the text's hash and length, and its anchors."""
    keep = [c for c in keep if c != "n_bytes"]
    t = text_of(text).cast("binary")
    src = docs.select(*keep, F.unhex(F.md5(t)).alias("_b_th"), F.octet_length(t).cast("long").alias("n_bytes"), t.alias("_b_t"))
    out = src.drop("_b_t").withColumns({"_b_pos": F.array().cast("array<int>"), "_b_gram": F.array().cast("array<long>"),
                                        "_b_strip": F.array().cast("array<long>")}).schema
    names, k = [f.name for f in out], len(keep) + 2

    def run(batches):
        anchors = Anchors()
        for b in batches:
            got = [anchors.of(t) for t in b.column(k).to_pylist()]
            ends = pa.array(np.concatenate([[0], np.cumsum([len(g[0]) for g in got])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([g[i] for g in got]))) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:k], *lists], names=names)

    return src.mapInArrow(run, out)


def _aligned(strips: list[bytes], left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strips as rows with their anchors in one column, and the first and last
    window start that lies inside each."""
    rows = np.zeros((len(strips), REACH + LENGTH), dtype=np.uint8)
    for r, (s, n) in enumerate(zip(strips, left.tolist())):
        rows[r, REACH - n:REACH - n + len(s)] = np.frombuffer(s, dtype=np.uint8)
    size = np.array([len(s) for s in strips])
    return rows, REACH - left, REACH - left + size - LENGTH


_SPAN = REACH + LENGTH
#: positions of the cover sample in a strip whose anchor stands at REACH
_SAMPLES = [c for c in range(_SPAN) if c % COVER in COVER_SET]
_FIRST = min(c for c in _SAMPLES if c >= REACH)


def sample_ranks(rows: np.ndarray) -> dict[int, np.ndarray]:
    """Ranks, in byte order, of the rows' suffixes at each position of the cover
    sample. From the right: COVER bytes decide, and their ties the rank COVER
    bytes further on, which is a position of the sample again."""
    n, ranks = len(rows), {}
    for c in reversed(_SAMPLES):
        key = np.zeros((n, COVER + 4), dtype=np.uint8)
        part = rows[:, c:c + COVER]
        key[:, :part.shape[1]] = part
        if c + COVER in ranks:
            key[:, COVER:] = ranks[c + COVER].astype(">u4").view(np.uint8).reshape(n, 4)
        key = key.view(f"S{COVER + 4}").ravel()
        order = np.argsort(key)
        key = key[order]
        rank = np.zeros(n, dtype=np.uint32)
        rank[order[1:]] = np.cumsum(key[1:] != key[:-1])
        ranks[c] = rank
    return ranks


def sorted_suffixes(rows: np.ndarray):
    """(start, the rows in byte order of their suffixes there), one suffix bucket
    at a time, from the last start to the first: at a position of the sample by its
    ranks, elsewhere by the first byte and then as the suffixes one further on."""
    ranks, order = sample_ranks(rows), None
    small = np.uint16 if len(rows) <= 1 << 16 else np.uint32
    for s in range(_FIRST, -1, -1):
        if s in ranks:
            order = np.argsort(ranks[s].astype(small), kind="stable")
        else:
            order = order[np.argsort(rows[order, s], kind="stable")]
        if s <= REACH:
            yield s, order


def _extend(rows, lo, hi, p, q, first, last, step=4096):
    """Widen the rows' ranges by the windows that rows p and q have in common."""
    for at in range(0, len(p), step):
        x, y = p[at:at + step], q[at:at + step]
        differ = rows[x] != rows[y]
        before, after = differ[:, REACH - 1::-1], differ[:, REACH:]
        a = np.where(before.any(axis=1), REACH - before.argmax(axis=1), 0)
        z = np.where(after.any(axis=1), REACH + after.argmax(axis=1), _SPAN) - LENGTH
        a = np.maximum(a, np.maximum(lo[x], lo[y]))
        z = np.minimum(z, np.minimum(hi[x], hi[y]))
        ok = a <= z
        for r in (x[ok], y[ok]):
            np.minimum.at(first, r, a[ok])
            np.maximum.at(last, r, z[ok])


def repeated_starts(strips: list[bytes], left: np.ndarray, bucket: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of a window of each strip that repeats in another
    one of its bucket (first > last: none). Equal windows are neighbours among the
    sorted suffixes; neighbours count by their bytes."""
    rows, lo, hi = _aligned(strips, left)
    n = len(rows)
    bucket = np.zeros(n, dtype=np.int64) if bucket is None else bucket
    first, last = np.full(n, REACH + 1), np.full(n, -1)
    cols = np.ascontiguousarray(rows.T)
    was, pairs, held = np.full(n, -1), [], 0

    def settle():
        both = np.unique(np.concatenate(pairs))
        _extend(rows, lo, hi, both // n, both % n, first, last)

    for s, order in sorted_suffixes(rows):
        v = order[(lo[order] <= s) & (s <= hi[order])]
        after = np.full(n, -1)
        after[v[:-1]] = v[1:]
        p = np.flatnonzero((after >= 0) & (after != was))
        q, was = after[p], after
        # cheap tests of a common window here before bytes are read; who fails is tested again at the next start
        same = bucket[p] == bucket[q]
        for k in (s, s + LENGTH // 4, s + LENGTH - 1):
            same &= cols[k][p] == cols[k][q]
        was[p[~same]] = -1
        pairs.append(p[same] * n + q[same])
        held += len(pairs[-1])
        if held > 1 << 20:
            settle()
            pairs, held = [], 0
    if held:
        settle()
    return first, last


_CLASS = ["_b_gram", "_b_strip"]
_STRIP = [*_CLASS, "left", "bytes", "large"]


def _cut_strips(batches):
    """Bytes of the asked strips of each text."""
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_()]
    for b in batches:
        rows = []

        def held():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=_STRIP)

        for text, asked in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for a in asked:
                s = a["pos"]
                rows.append((a["_b_gram"], a["_b_strip"], min(s, REACH), text[max(0, s - REACH):s + LENGTH], a["large"]))
            if len(rows) > 4000:
                yield held()
                rows = []
        if rows:
            yield held()


def _sort_buckets(batches):
    """Over strips sorted by bucket: whole buckets, as many as BLOCK strips take,
    are sorted together. Held: a batch, a block and a bucket."""
    held, size = [], 0

    def found():
        g = pa.concat_tables(held)
        gram = g.column("_b_gram").to_numpy()
        first, last = repeated_starts(g.column("bytes").to_pylist(), g.column("left").to_numpy().astype(np.int64), gram)
        some = first <= last
        return pa.RecordBatch.from_arrays(
            [pa.array(gram[some]), g.column("_b_strip").combine_chunks().filter(pa.array(some)),
             pa.array(first[some].astype(np.int32)), pa.array(last[some].astype(np.int32))],
            names=[*_CLASS, "first", "last"])

    for g in groups_of(batches, 1):
        held.append(g)
        size += g.num_rows
        if size >= BLOCK:
            yield found()
            held, size = [], 0
    if held:
        yield found()


def _sizes(classes: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Buckets of several classes, and how many the largest has."""
    sizes = staged(classes.groupBy("_b_gram").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1"), name)
    return sizes, sizes.agg(F.max("classes")).first()[0] or 0


def _ranges(strips: DataFrame, most: int, bucket: int, width: int = REACH + 1) -> DataFrame:
    """Repeated window starts per class, bucket by bucket; the largest has ``most`` classes."""
    small = strips.where("not large").drop("large").repartition("_b_gram").sortWithinPartitions(*_CLASS)
    out = small.mapInArrow(_sort_buckets, f"_b_gram long, _b_strip {strips.schema['_b_strip'].dataType.simpleString()}, first int, last int")
    if most <= bucket:
        return out

    # the others by cells of fewer starts: a part's bucket is what all windows of the cell hold, its class all its bytes
    width = -(-width // SPLIT)
    large, lo = strips.where("large"), F.lit(REACH) - F.col("left")
    hi = lo + F.octet_length("bytes") - LENGTH
    cells = large.select("*", lo.alias("lo"), hi.alias("hi"), F.explode(F.sequence(
        F.floor(lo / width).cast("int"), F.floor(hi / width).cast("int"))).alias("cell"))
    cells = cells.withColumns({"l": F.col("cell") * width, "r": F.least(F.col("cell") * width + (width - 1), F.lit(REACH))})
    cells = cells.withColumns({"first": F.greatest("lo", "l"), "last": F.least("hi", "r")})
    core = F.col("bytes").substr(F.col("r") - F.col("lo") + 1, F.col("l") + LENGTH - F.col("r"))
    whole = F.col("bytes").substr(F.col("first") - F.col("lo") + 1, F.col("last") + LENGTH - F.col("first"))
    parts = staged(cells.select(*(F.col(c).alias(f"of{c}") for c in _CLASS), F.xxhash64(core, "l").alias("_b_gram"),
                                F.unhex(F.md5(F.concat(F.col("first").cast("string").cast("binary"), F.lit(b":"), whole)))
                                .alias("_b_strip"), "first", "last"), "sub-parts")
    key = [*_CLASS, "first", "last"]
    classes = staged(parts.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("of_b_gram", "of_b_strip")).alias("at")),
                     "sub-part-classes")
    found = classes.where("n > 1").select(*key)
    sizes, most = _sizes(classes, "sub-part-mixed") if width > 1 else (None, 0)
    if most:
        asked = staged(classes.join(sizes, "_b_gram").select(
            F.col("at.of_b_gram").alias("_b_gram"), F.col("at.of_b_strip").alias("_b_strip"), "first", "last",
            F.struct(*_CLASS).alias("part"), (F.col("classes") > bucket).alias("_large")), "sub-part-asked")
        some = F.xxhash64(*_CLASS)
        cut = in_bitmap(large, some, bitmap(asked, some), "_in").where("_in").select(*_CLASS, "left", "bytes").join(asked, _CLASS)
        cut = staged(cut.select(
            "part.*", (F.lit(REACH) - F.col("first")).alias("_left"),
            F.col("bytes").substr(F.col("first") + F.col("left") - (REACH - 1), F.col("last") + LENGTH - F.col("first")).alias("bytes"),
            "_large").toDF(*_STRIP), "sub-part-strips")
        found = found.unionByName(_ranges(cut, most, bucket, width))
    found = found.withColumnsRenamed({"first": "_first", "last": "_last"})
    back = parts.join(found, _CLASS).groupBy("of_b_gram", "of_b_strip").agg(F.min("_first").alias("first"), F.max("_last").alias("last"))
    return out.unionByName(back.withColumnsRenamed({f"of{c}": c for c in _CLASS}))


def repeats(docs: DataFrame, keep: list[str], text: str = "text", bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): rows have the ``keep`` columns, ``_b_th`` and ``n_bytes``;
    spans have ``_b_th`` and ``spans``, the maximal repeated runs (start, end) of
    each distinct text that has any."""
    rows = staged(anchored(docs, keep, text), "sub-anchors")
    texts = staged(rows.where(F.col("n_bytes") >= LENGTH).groupBy("_b_th").agg(
        F.count(F.lit(1)).alias("copies"), F.max("n_bytes").alias("n_bytes"),
        F.max(F.struct("_b_pos", "_b_gram", "_b_strip")).alias("a")), "sub-texts")
    at = texts.select("_b_th", "n_bytes", "copies", F.explode(F.arrays_zip("a._b_pos", "a._b_gram", "a._b_strip")).alias("e"))
    at = at.select("_b_th", "n_bytes", "copies", F.col("e._b_pos").alias("pos"), F.col("e._b_gram").alias("_b_gram"),
                   F.col("e._b_strip").alias("_b_strip"))
    shared = at.groupBy("_b_gram").agg(F.sum("copies").alias("n")).where("n > 1")
    gram = F.col("_b_gram")
    at = staged(in_bitmap(at, gram, bitmap(shared, gram, GRAM_BITS), "_in", GRAM_BITS).where("_in").drop("_in"), "sub-shared")
    classes = staged(at.groupBy(*_CLASS).agg(F.sum("copies").alias("n"), F.min(F.struct("_b_th", "pos")).alias("at")), "sub-classes")
    sizes, most = _sizes(classes, "sub-mixed")

    # bytes of one strip of each class in buckets with several
    asked = (classes.join(sizes, "_b_gram").groupBy(F.col("at._b_th").alias("_b_th"))
             .agg(F.collect_list(F.struct(F.col("at.pos").alias("pos"), *_CLASS, (F.col("classes") > bucket).alias("large"))).alias("asked")))
    asked = staged(asked, "sub-asked")
    strips = staged(_with_text(docs, text, asked).mapInArrow(
        _cut_strips, "_b_gram long, _b_strip long, left int, bytes binary, large boolean"), "sub-strips")

    # a class seen twice repeats throughout its strip; the others as sorted
    whole = classes.where("n > 1").select(*_CLASS, F.lit(REACH).alias("before"), F.lit(LENGTH).alias("after"))
    part = (_ranges(strips, most, bucket).join(classes.where("n > 1").select(*_CLASS), _CLASS, "left_anti")
            .select(*_CLASS, (F.lit(REACH) - F.col("first")).alias("before"), (F.col("last") + GRAM).alias("after")))
    found = staged(whole.unionByName(part), "sub-ranges")
    runs = at.join(found, _CLASS).select(
        "_b_th", F.greatest(F.col("pos") - F.col("before"), F.lit(0)).alias("start"),
        F.least((F.col("pos") + F.col("after")).cast("long"), F.col("n_bytes")).cast("int").alias("end"))
    return rows.drop("_b_pos", "_b_gram", "_b_strip"), staged(_merged(runs), "sub-spans")


def _merged(runs: DataFrame) -> DataFrame:
    """Maximal runs per text; a text's runs are as many as its anchors at most."""
    per = runs.distinct().groupBy("_b_th").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("r"))

    def merge(batches):
        for b in batches:
            out = []
            for runs in b.column(1).to_pylist():
                spans = []
                for r in runs:
                    if spans and r["start"] <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], r["end"])
                    else:
                        spans.append(r)
                out.append(spans)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, b.column(1).type)], names=["_b_th", "spans"])

    return per.mapInArrow(merge, "_b_th binary, spans array<struct<start: int, end: int>>")


def _with_text(docs: DataFrame, text: str, asked: DataFrame) -> DataFrame:
    """One text for each ``_b_th`` asked for, with the asked column(s). Texts not
    asked for are left out before the shuffle; equal texts are one map-side."""
    t = text_of(text).cast("binary")
    src = docs.select(t.alias("_b_t"), F.unhex(F.md5(t)).alias("_b_th"))
    key = F.xxhash64("_b_th")
    src = in_bitmap(src, key, bitmap(asked, key), "_in").where("_in").select("_b_th", "_b_t").dropDuplicates(["_b_th"])
    return src.join(asked, "_b_th").select("_b_t", *(c for c in asked.columns if c != "_b_th"), "_b_th")


def kept_bytes(docs: DataFrame, spans: DataFrame, rows: DataFrame, text: str = "text") -> DataFrame:
    """``_b_th, n_removed, n_spans, kept`` for each distinct text that loses bytes."""
    sized = spans.join(rows.select("_b_th", "n_bytes").distinct(), "_b_th")
    all_gone = (F.size("spans") == 1) & (F.col("spans")[0]["start"] == 0) & (F.col("spans")[0]["end"] == F.col("n_bytes"))
    gone = sized.where(all_gone).select("_b_th", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                                        F.lit(b"").alias("kept"))
    asked = staged(sized.where(~all_gone).select("_b_th", "spans"), "sub-cut")
    names = ["_b_th", "n_removed", "n_spans", "kept"]

    def cut(batches):
        for b in batches:
            removed, kept = [], []
            for t, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                edges = [0, *(e for r in s for e in (r["start"], r["end"])), len(t)]
                kept.append(b"".join(t[x:y] for x, y in zip(edges[::2], edges[1::2])))
                removed.append(len(t) - len(kept[-1]))
            yield pa.RecordBatch.from_arrays(
                [b.column(2), pa.array(removed, pa.int64()), pa.array([len(s) for s in b.column(1).to_pylist()], pa.int64()),
                 pa.array(kept, pa.binary())], names=names)

    part = _with_text(docs, text, asked).mapInArrow(cut, "_b_th binary, n_removed long, n_spans long, kept binary")
    return gone.unionByName(part)
