"""Near-duplicates by b-bit MinHash.

Each document's set of word shingles gives PERMS minima; bands of ROWS minima
are the candidate buckets, and of every minimum only the low LOW_BITS bits are
kept, packed by bit planes: two signatures' similarity is a bit count over XORs,
corrected for chance collisions. Pairs that share a bucket and whose estimate
is at least ESTIMATE are confirmed on their full shingle sets.

Equal sets are one class before any pair is made, and pairs of a group of near
copies are never listed. First each class is confirmed with the most similar of
its buckets' first members, which joins most groups. In buckets that still hold
several components, the members whose estimate with a member of another
component is high enough are found from the signatures; then their full sets
meet bucket by bucket, and every such pair is confirmed there unless the links
found before have joined it. Only confirmed links leave a bucket. A pair is
tested in the first bucket it shares. Buckets are compared in blocks of BLOCK
(signatures) and SET_BLOCK (sets) members.

A pair at the threshold itself is missed with a chance of about 5e-6 by the
bands and 1e-5 by the estimate.

Defined results: words are lower-cased in A-Z only. With fewer than ``words``
words the whole sequence is the one shingle; a text without words (or null) has
no shingles and no links. Rows of equal id and different text are linked through
their id. A class whose rows all have null ids takes part in no link; its rows
have a null component. Repeated rows share a class. An empty table gives an
empty result. Extra columns are dropped by :func:`near_groups` and kept by
:func:`near_dedup`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import WORD, bitmap, drop_ids, giving_back, groups_of, in_bitmap, staged, text_of
from tickloom.llm.components import components

WORDS = 5
PERCENT = 75            # linked if 100 * intersection >= PERCENT * union
PERMS, ROWS, LOW_BITS = 128, 4, 4
ESTIMATE = 0.58
BLOCK, SET_BLOCK = 4096, 1024
BUCKET_BITS = 1 << 25   # bitmap of shared buckets: 4 MB
_CACHE = 100_000
_PLANES = [f"s{i}" for i in range(2 * LOW_BITS)]

_rng = np.random.default_rng(20240601)
_MUL = (_rng.integers(0, 1 << 32, PERMS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_XOR = _rng.integers(0, 1 << 32, PERMS, dtype=np.uint64).astype(np.uint32)
_STEP = _rng.integers(0, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Shingles:
    """Sorted distinct 64-bit shingle hashes of UTF-8 texts."""

    def __init__(self, words: int = WORDS):
        self.words, self.seen = words, {}

    def of(self, text: bytes) -> np.ndarray:
        words = text.lower().split()        # bytes: A-Z and ASCII white space only
        n, k, seen = len(words), self.words, self.seen
        if n < k:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)] if n else [], dtype=np.uint64)
        if len(seen) > _CACHE:
            seen.clear()
        for w in set(words).difference(seen):
            seen[w] = xxhash.xxh3_64_intdigest(w)
        ids = np.array(list(map(seen.__getitem__, words)), dtype=np.uint64)
        h = ids[:n - k + 1] * _STEP[0]
        for j in range(1, k):
            h += ids[j:n - k + 1 + j] * _STEP[j]
        return np.unique(_mix(h))


def minima(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(PERMS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(out, ((x[at:at + 2048, None] * _MUL) ^ _XOR).min(axis=0), out=out)
    return out


def packed(mins: np.ndarray) -> np.ndarray:
    """Low bits by plane: for each bit, PERMS bits in two 64-bit words; the
    first words of all planes, then the second ones."""
    bits = ((mins[None, :] >> np.arange(LOW_BITS, dtype=np.uint32)[:, None]) & 1).astype(np.uint8)
    return np.packbits(bits, axis=1).view(np.int64).T.reshape(-1)


def bands(mins: np.ndarray) -> np.ndarray:
    rows = mins.reshape(-1, ROWS).astype(np.uint64)
    h = np.arange(len(rows), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(ROWS):
        h = _mix((h ^ rows[:, j]) + _STEP[j])
    return h.view(np.int64)


def estimate(equal):
    """Similarity from the number of equal low-bit minima, less the share that
    agrees by chance."""
    chance = 2.0 ** -LOW_BITS
    return (equal / float(PERMS) - chance) / (1 - chance)


def equal_minima(a: str, b: str) -> Column:
    """Equal minima of two rows with columns ``a_s0..`` and ``b_s0..``."""
    differ = []
    for half in (0, LOW_BITS):
        d = None
        for j in range(LOW_BITS):
            x = F.col(f"{a}_s{half + j}").bitwiseXOR(F.col(f"{b}_s{half + j}"))
            d = x if d is None else d.bitwiseOR(x)
        differ.append(F.bit_count(d))
    return F.lit(PERMS) - differ[0] - differ[1]


def _text_key(text: str) -> Column:
    return F.unhex(F.md5(text_of(text).cast("binary")))


def signatures(docs: DataFrame, id_col: str = "doc_id", text: str = "text", keyed: bool = False) -> DataFrame:
    """One row per input row; ``keyed`` adds ``th``, the key of its text."""
    th = [_text_key(text).alias("th")] if keyed else []
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text).cast("binary").alias("text"), *th)
    names = ["id", "n_shingles", "ck", *_PLANES, "bands", *(["th"] if keyed else [])]

    def run(batches):
        shingles = Shingles()
        for b in batches:
            ns, keys, sigs, buckets = [], [], [], []
            for t in b.column(1).to_pylist():
                s = shingles.of(t)
                ns.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                if len(s):
                    m = minima(s)
                    sigs.append(packed(m))
                    buckets.append(bands(m))
                else:
                    sigs.append(np.zeros(2 * LOW_BITS, dtype=np.int64))
                    buckets.append(np.zeros(0, dtype=np.int64))
            sig = np.array(sigs).reshape(-1, 2 * LOW_BITS)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in buckets])]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *buckets])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ns, pa.int64()), pa.array(keys, pa.binary()),
                 *(pa.array(sig[:, i].copy()) for i in range(2 * LOW_BITS)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), *b.columns[2:]], names=names)

    planes = ", ".join(f"{p} long" for p in _PLANES)
    return src.mapInArrow(giving_back(run), f"id long, n_shingles long, ck binary, {planes}, bands array<long>"
                          + (", th binary" if keyed else ""))


def confirm(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """The pairs ``a, b`` of nodes whose full shingle sets reach the threshold.
    Texts are found again by the class's id and checked to be of that class."""
    asked = pairs.select(F.col("a").alias("node"), "a", "b").union(pairs.select(F.col("b").alias("node"), "a", "b"))
    asked = staged(asked.join(nodes.select("node", "rep", "ck"), "node").select("a", "b", "node", "rep", "ck"), "near-asked")
    src = _texts(docs, asked, id_col, text)
    rows = asked.join(src, "rep").select("a", "b", "node", "ck", "text")

    def run(batches):
        shingles, last = Shingles(), {}
        a_out, b_out = [], []
        for g in groups_of(batches, 2):
            sets = {}
            for node, ck, t in zip(*(g.column(i).to_pylist() for i in (2, 3, 4))):
                if node not in sets:
                    s = last.get(ck)
                    if s is None:
                        s = shingles.of(t)
                        if xxhash.xxh3_128_digest(s.tobytes()) != ck:
                            continue            # another text of the same id
                        if len(last) > 64:
                            last.clear()
                        last[ck] = s
                    sets[node] = s
            if len(sets) == 2:
                x, y = sets.values()
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= PERCENT * (len(x) + len(y) - both):
                    a_out.append(g.column(0)[0].as_py())
                    b_out.append(g.column(1)[0].as_py())
            if len(a_out) >= 5000:
                yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])
                a_out, b_out = [], []
        if a_out:
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])

    return rows.repartition("a", "b").sortWithinPartitions("a", "b", "node").mapInArrow(giving_back(run), "a long, b long")


_NAMES = ["bucket", "i", "j", "blk", "node", "comp", *_PLANES]
SMALL = 16              # members up to which a bucket's pairs are found for many buckets at once


def _estimates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimates of signatures along the last axis (planes)."""
    differ = np.bitwise_or.reduce(x[..., :LOW_BITS] ^ y[..., :LOW_BITS], axis=-1)
    rest = np.bitwise_or.reduce(x[..., LOW_BITS:] ^ y[..., LOW_BITS:], axis=-1)
    return estimate(PERMS - np.bitwise_count(differ).astype(np.int64) - np.bitwise_count(rest))


def _blocks(comp, blk, i, j, sig, step=500_000):
    """Pairs between components of one block pair, in slices: numbers and estimates."""
    left = np.flatnonzero(blk == i)
    right = left if i == j else np.flatnonzero(blk == j)
    step = max(1, step // max(1, len(right)))
    for at in range(0, len(left) if len(right) else 0, step):
        part = left[at:at + step]
        est = _estimates(sig[part][:, None, :], sig[right][None, :, :])
        ok = (est >= ESTIMATE) & (comp[part][:, None] != comp[right][None, :])
        if i == j:
            ok &= part[:, None] < right[None, :]
        x, y = np.nonzero(ok)
        yield part[x], right[y], est[x, y]


def _involved(c: dict) -> np.ndarray:
    """Rows that have a high enough estimate with a row of another component, in
    the whole groups (bucket, i, j) of sorted rows."""
    n = len(c["node"])
    change = np.ones(n, dtype=bool)
    change[1:] = (c["bucket"][1:] != c["bucket"][:-1]) | (c["i"][1:] != c["i"][:-1]) | (c["j"][1:] != c["j"][:-1])
    start = np.flatnonzero(change)
    size = np.diff(np.append(start, n))
    hit = np.zeros(n, dtype=bool)
    for k in range(2, SMALL + 1):               # all groups of k members together
        at = start[size == k]
        for u in range(k if len(at) else 0):
            for v in range(u + 1, k):
                x, y = at + u, at + v
                ok = (c["comp"][x] != c["comp"][y]) & ((c["i"][x] == c["j"][x]) | (c["blk"][x] != c["blk"][y]))
                x, y = x[ok], y[ok]
                ok = _estimates(c["sig"][x], c["sig"][y]) >= ESTIMATE
                hit[x[ok]] = True
                hit[y[ok]] = True
    for at, k in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist()):
        g = slice(at, at + k)
        for x, y, _ in _blocks(c["comp"][g], c["blk"][g], c["i"][at], c["j"][at], c["sig"][g]):
            hit[at + x] = True
            hit[at + y] = True
    return hit


def _match(batches):
    """Over rows sorted by (bucket, i, j): the involved ones' bucket and node.
    Held: a batch and the group that goes on into the next."""
    held = None

    def found(c):
        hit = _involved(c)
        return pa.RecordBatch.from_arrays([pa.array(c["bucket"][hit]), pa.array(c["node"][hit])], names=["bucket", "node"])

    for batch in batches:
        c = {k: batch.column(m).to_numpy(zero_copy_only=False) for m, k in enumerate(_NAMES[:6])}
        c["sig"] = np.stack([batch.column(m).to_numpy() for m in range(6, len(_NAMES))], axis=1).view(np.uint64)
        if held is not None:
            c = {k: np.concatenate([held[k], c[k]]) for k in c}
        n = len(c["node"])
        if not n:
            continue
        same = (c["bucket"] == c["bucket"][-1]) & (c["i"] == c["i"][-1]) & (c["j"] == c["j"][-1])
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        held = {k: v[cut:] for k, v in c.items()}
        if cut:
            yield found({k: v[:cut] for k, v in c.items()})
    if held is not None:
        yield found(held)


def _confirm_in_buckets(batches):
    """Over rows sorted by (bucket, i, j) with full sets: the confirmed links
    that join components inside each block pair."""
    out: list = [[], []]
    planes = slice(6, 6 + 2 * LOW_BITS)
    shingles = Shingles()
    for g in groups_of(batches, 3):
        bucket, i, j = (g.column(k)[0].as_py() for k in range(3))
        blk, node = g.column("blk").to_numpy(), g.column("node").to_numpy()
        comp = np.unique(g.column("comp").to_numpy(), return_inverse=True)[1]
        sig = np.stack([c.to_numpy() for c in g.columns[planes]], axis=1).view(np.uint64)
        bands_ = np.array(g.column("bands").to_pylist(), dtype=np.int64)
        band = int((bands_[0] == bucket).argmax())
        cks, texts, sets = g.column("ck").to_pylist(), g.column("text"), {}

        def set_of(k):
            if k not in sets:
                got = shingles.of(texts[k].as_py())
                # another text of the same id is no member of the class
                sets[k] = got if xxhash.xxh3_128_digest(got.tobytes()) == cks[k] else got[:0]
            return sets[k]

        root = list(range(int(comp.max()) + 1))

        def find(v):
            while root[v] != v:
                root[v] = root[root[v]]
                v = root[v]
            return v

        for x, y, est in _blocks(comp, blk, i, j, sig):
            first = (bands_[x][:, :band] == bands_[y][:, :band]).any(axis=1)    # shared an earlier bucket
            x, y, est = x[~first], y[~first], est[~first]
            for k in np.argsort(-est, kind="stable").tolist():
                p, q = x[k], y[k]
                u, v = find(int(comp[p])), find(int(comp[q]))
                if u == v:
                    continue
                s, t = set_of(int(p)), set_of(int(q))
                both = len(np.intersect1d(s, t, assume_unique=True))
                if both and 100 * both >= PERCENT * (len(s) + len(t) - both):
                    root[u] = v
                    out[0].append(min(node[p], node[q]))
                    out[1].append(max(node[p], node[q]))
        if len(out[0]) > 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=["a", "b"])
            out = [[], []]
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=["a", "b"])


def _in_blocks(m: DataFrame, buckets: DataFrame, block: int) -> DataFrame:
    """Rows of the given buckets (with their counts ``n``), cut into blocks; a row
    goes to each block pair its block is part of."""
    m = m.join(buckets.select("bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "bucket")
    m = m.withColumn("blk", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    m = m.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return m.withColumns({"i": F.least("blk", "o"), "j": F.greatest("blk", "o")}).drop("blocks", "o")


def _together(m: DataFrame, *more: str) -> DataFrame:
    """The rows of a block pair in one task, one after the other."""
    return m.select(*_NAMES, *more).repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")


def _rest(members: DataFrame, nodes: DataFrame, comps: DataFrame, docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Links between components that share a bucket."""
    m = members.join(comps, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("comp"))
    m = staged(m, "near-members")
    mixed = staged(m.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                   .where("lo < hi"), "near-mixed")
    rows = _together(_in_blocks(m, mixed, BLOCK).join(nodes.select("node", *_PLANES), "node"))
    hit = staged(rows.mapInArrow(giving_back(_match), "bucket long, node long").distinct(), "near-hit")

    # the texts of those members: a text travels better than its set
    asked = hit.select("node").distinct().join(nodes.select("node", "rep", "ck"), "node")
    asked = staged(asked, "near-asked")
    texts = asked.join(_texts(docs, asked, id_col, text), "rep").select("node", "ck", "text")
    sizes = hit.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    # the blocks are dealt while rows are narrow; signatures and texts join last
    rows = _in_blocks(hit.join(m, ["bucket", "node"]), sizes, SET_BLOCK)
    rows = rows.join(nodes.select("node", "bands", *_PLANES), "node").join(texts, "node")
    rows = _together(rows, "bands", "ck", "text")
    return rows.mapInArrow(giving_back(_confirm_in_buckets), "a long, b long").distinct()


def _texts(docs: DataFrame, asked: DataFrame, id_col: str, text: str) -> DataFrame:
    """``rep, text`` of the ids asked for; other texts are left out before any shuffle."""
    src = docs.select(F.col(id_col).cast("long").alias("rep"), text_of(text).cast("binary").alias("text"))
    key = F.xxhash64("rep")
    return in_bitmap(src, key, bitmap(asked, key), "_asked").where("_asked").select("rep", "text")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``."""
    out = _groups(docs, id_col, text)
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", "kept")


def _groups(docs: DataFrame, id_col: str, text: str, keyed: bool = False) -> DataFrame:
    """``id, n_shingles, component_id, kept, ck`` per input row, and ``th`` if ``keyed``."""
    sigs = staged(signatures(docs, id_col, text, keyed), "near-signatures")
    # classes of equal sets; the smallest id stands for the class
    best = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("rep"), *_PLANES, "bands")).alias("m")
    nodes = (sigs.where("n_shingles > 0").groupBy("ck").agg(best).where("m.rep is not null")
             .select("ck", "m.rep", *(f"m.{p}" for p in _PLANES), "m.bands"))
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "near-classes")

    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = staged(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("center"))
                    .where("n > 1").select("bucket", "center"), "near-buckets")
    key = F.col("bucket")
    mine = in_bitmap(buckets, key, bitmap(shared, key, BUCKET_BITS), "_shared", BUCKET_BITS).where("_shared")
    members = staged(mine.select("node", "bucket").join(shared, "bucket"), "near-bucket-members")

    # rows of one id and different texts: linked through the id
    same_id = nodes.groupBy("rep").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    same_id = nodes.join(same_id, "rep").where("node > a").select("a", F.col("node").alias("b"))

    # first round: with the most similar of the buckets' first members
    star = members.where("node <> center").select("node", "center").distinct()
    sig = lambda s, k: nodes.select(F.col("node").alias(k), *(F.col(p).alias(f"{s}_{p}") for p in _PLANES))
    star = star.join(sig("a", "node"), "node").join(sig("b", "center"), "center")
    star = star.withColumn("est", estimate(equal_minima("a", "b"))).where(F.col("est") >= ESTIMATE)
    star = star.groupBy("node").agg(F.max(F.struct("est", -F.col("center"))).alias("m"))
    tested = staged(star.select((-F.col("m.col2")).alias("a"), F.col("node").alias("b")), "near-pairs")
    links = staged(confirm(tested, nodes, docs, id_col, text).union(same_id), "near-links")
    comps = components(links)

    more = staged(_rest(members.select("bucket", "node"), nodes, comps, docs, id_col, text), "near-links")
    if more.limit(1).count():
        comps = components(links.unionByName(more))

    reps = nodes.select("ck", "node", "rep").join(comps, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = reps.groupBy("label").agg(F.min("rep").alias("component_id"))
    reps = staged(reps.join(staged(least, "near-least"), "label").select("ck", "component_id"), "near-result")
    out = sigs.select("id", "n_shingles", "ck", *(["th"] if keyed else [])).join(reps, "ck", "left")
    out = out.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``docs``: of each group one row, of the smallest id. A row
    without an id goes where its set is in a group with an id; of equal sets
    without any id one row stays. Rows without words are in no group and stay."""
    out = staged(_groups(docs.select(id_col, text), id_col, text, keyed=True), "near-decided")
    dropped = staged(out.where(~F.col("kept") & F.col("id").isNotNull()).select(F.col("id").alias("_drop")).distinct(), "near-drop")
    repeated = staged(out.where("id is not null").groupBy(F.col("id").alias("_drop")).agg(F.count(F.lit(1)).alias("n"))
                      .where("n > 1").select("_drop"), "near-repeated")
    # rows that an id tells apart
    single = drop_ids(docs.where(F.col(id_col).isNotNull()), staged(dropped.union(repeated).distinct(), "near-drop"), id_col)
    # the others: the text of each group's row is chosen, then one row of that text
    again = repeated.select(F.col("_drop").alias("id"))
    kept = out.where("kept and n_shingles > 0")
    kept = kept.where("id is null").unionByName(kept.join(again, "id", "left_semi").select(*kept.columns))
    chosen = (kept.groupBy("component_id", F.when(F.col("id").isNull(), F.col("ck")).alias("set"))
              .agg(F.min("th").alias("_n_th")).select(F.col("component_id").alias("_n_id"), "_n_th"))
    chosen = staged(chosen, "near-chosen")
    cols, key = docs.columns, F.xxhash64(F.col(id_col))
    rows = in_bitmap(docs, key, bitmap(repeated, F.xxhash64("_drop")), "_maybe")
    same = rows.where("_maybe").join(repeated, rows[id_col] == repeated["_drop"], "left_semi").select(*cols)
    rows = same.unionByName(docs.where(F.col(id_col).isNull()))
    wordy = text_of(text).rlike(WORD)
    one = rows.where(wordy).withColumn("_n_key", _text_key(text))
    one = one.join(chosen, one[id_col].eqNullSafe(chosen["_n_id"]) & (one["_n_key"] == chosen["_n_th"]), "left_semi")
    whole = F.struct(*cols)
    one = one.groupBy(id_col, "_n_key").agg(F.min_by(whole, F.xxhash64(whole)).alias("_n_row")).select("_n_row.*")
    return single.unionByName(rows.where(~wordy)).unionByName(one)
