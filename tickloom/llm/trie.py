"""Prefix trie of conversations by truncation peeling.

Every conversation's turns become a chain of 128-bit keys (a turn's key covers
all turns before it), streamed in turn order; texts are hashed before any
shuffle. Identical conversations are first counted together, so that no path is
too hot to be dealt out, and the paths are sorted in ranges. A task then peels
its rows in chunks: from the greatest depth down, the conversations that end at
a depth join the surviving nodes, equal neighbours become one node, the node is
finished from what its children handed up, and the last turn is stripped. Nodes
that may go on beyond a chunk's ends (its first and last path, one node per
depth and end) are handed out unfinished and are peeled once more together.

Paths are held in rows of ``BLOCK`` turns. Deeper conversations are peeled block
by block from the deepest: what survives at a block's top enters the block above
as paths that end there. A row, a chunk and the list of open nodes are bounded,
however long a conversation or large a group of equal ones is; one conversation's
turns pass through one task in order, as a stream.

Defined results: null role or text counts as empty; null turns come first; turns
that tie are ordered by a digest of role and text, and repeated rows are turns
of their own. Rows without ``conv_id`` belong to no conversation. An empty table
has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.llm.common import staged

BLOCK = 4096                # turns in one path row
CHUNK_BYTES = 16 << 20      # paths that are peeled at once
HUNDRED = 100
HEADS = 6                   # a conversation takes fewer turns than this from its hundred's first
IDS_PER_ROW = 4096
_ENTRY = np.dtype([("k1", ">i8"), ("k2", ">i8"), ("chars", ">u4")])
_NODE = ("kind int, depth long, k1 long, k2 long, p1 long, p2 long, chars long, n_convs long, conv_id long, "
         "n_children long, n_leaves long, saved long")
_NODE_NAMES = [c.split()[0] for c in _NODE.split(", ")]
DONE, OPEN, TOP = 0, 1, 2
EMPTY_SHA = sha256(b"").hexdigest()


def turn_digest(role: str, text: str) -> Column:
    """16 bytes that stand for a turn; the role's length keeps the two apart."""
    role, text = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    whole = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return F.unhex(F.substring(whole, 1, 32))


def borrowed(conv_id: int) -> int:
    """How many turns a conversation takes from the first of its hundred."""
    return zlib.crc32(str(conv_id).encode()) % HEADS


class _Rows:
    """Python rows gathered into Arrow batches."""

    def __init__(self, schema: pa.Schema, limit: int = 4 << 20):
        self.schema, self.limit, self.rows, self.size = schema, limit, [], 0

    def add(self, row: tuple, size: int = 64):
        self.rows.append(row)
        self.size += size
        if self.size >= self.limit:
            yield self.take()

    def take(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows)) or [[] for _ in self.schema]
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, self.schema)], schema=self.schema)


_PATH = "conv_id long, block int, last boolean, top1 long, top2 long, k1 long, k2 long, path binary"
_PATH_SCHEMA = pa.schema([("conv_id", pa.int64()), ("block", pa.int32()), ("last", pa.bool_()), ("top1", pa.int64()),
                          ("top2", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("path", pa.binary())])


def _longs(key: bytes) -> tuple[int, int]:
    return int.from_bytes(key[:8], "big", signed=True), int.from_bytes(key[8:], "big", signed=True)


def _chains(block: int):
    """Over rows sorted by hundred (its first conversation leading), conversation
    and turn: the rebuilt conversations' path rows."""
    def run(batches):
        out = _Rows(_PATH_SCHEMA)
        hundred = conv = None
        heads, key, top, path, number, seen, h = [], bytes(16), bytes(16), bytearray(), 0, 0, 0

        def emit(last: bool):
            yield from out.add((conv, number, last, *_longs(top), *_longs(key), bytes(path)), 64 + len(path))

        def feed(digest: bytes, chars: int):
            nonlocal key, top, path, number
            if len(path) == block * _ENTRY.itemsize:
                yield from emit(False)
                top, path, number = key, bytearray(), number + 1
            key = blake2b(key + digest, digest_size=16).digest()
            path += key + chars.to_bytes(4, "big")

        for batch in batches:
            convs, bases, digests, chars = (batch.column(i).to_pylist() for i in range(4))
            for c, base, digest, n in zip(convs, bases, digests, chars):
                if c != conv:
                    if conv is not None:
                        yield from emit(True)
                    if base != hundred:
                        hundred, heads = base, []
                    conv, seen, h = c, 0, borrowed(c)
                    key, top, path, number = bytes(16), bytes(16), bytearray(), 0
                    if c != base:
                        for turn in heads[:h]:
                            yield from feed(*turn)
                seen += 1
                if c == base and len(heads) < HEADS:
                    heads.append((digest, n))
                if c == base or seen > h:
                    yield from feed(digest, n)
        if conv is not None:
            yield from emit(True)
        yield out.take()
    return run


def paths(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows ``conv_id, block, last, top1, top2, k1, k2, path`` of the rebuilt
    conversations: the key at the block's top, the key of the row's last turn,
    and per turn 16 bytes of key and 4 of its text's code points."""
    conv = F.col("conv_id")
    rows = turns.where(conv.isNotNull()).select(
        conv.cast("long").alias("conv_id"), (conv - conv % HUNDRED).cast("long").alias("base"),
        turn_digest("role", "text").alias("digest"),
        F.char_length(F.coalesce(F.col("text"), F.lit(""))).alias("chars"), "turn")
    rows = rows.repartition("base").sortWithinPartitions(
        "base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv_id", "base", "digest", "chars").mapInArrow(_chains(block), _PATH)


def _grouped(new: np.ndarray, items: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Neighbouring items up to the next ``new`` one become one."""
    at = np.flatnonzero(new)
    out = {k: np.add.reduceat(items[k], at) for k in ("n", "kids", "leaves", "saved")}
    out["first"] = items["first"][at]
    out["last"] = np.maximum.reduceat(items["last"], at)
    out["conv"] = np.minimum.reduceat(items["conv"], at)
    return out


def peel(rows: pa.Table, base: int):
    """Peel sorted paths (columns top1, top2, path, n, conv, kids, leaves, saved),
    all of the block that starts at depth ``base``; yields one batch per depth."""
    joined = rows.column("path").combine_chunks()
    flat = np.frombuffer(b"".join(joined.to_pylist()), _ENTRY)
    k1, k2, chars = (flat[f].astype(np.int64) for f in ("k1", "k2", "chars"))
    length = np.array([len(p) for p in joined.to_pylist()], np.int64) // _ENTRY.itemsize
    start = np.cumsum(length) - length
    col = {k: rows.column(k).to_numpy() for k in ("top1", "top2", "n", "conv", "kids", "leaves", "saved")}
    count, order = len(length), np.argsort(-length, kind="stable")
    bounds = np.searchsorted(-length[order], -np.arange(length.max() + 2))       # rows longer than each depth
    schema = pa.schema([(n, pa.int32() if n == "kind" else pa.int64()) for n in _NODE_NAMES])
    nodes = {k: np.zeros(0, np.int64) for k in ("first", "last", "n", "conv", "kids", "leaves", "saved")}
    for d in range(int(length.max()), -1, -1):
        ended = np.sort(order[bounds[d]:np.searchsorted(-length[order], -d, side="right")])
        items = {k: np.concatenate([nodes[k], ended if k in ("first", "last") else col[k][ended]]) for k in nodes}
        by = np.argsort(items["first"], kind="stable")
        items = {k: v[by] for k, v in items.items()}
        where = items["first"]
        a, b = (k1[start[where] + d - 1], k2[start[where] + d - 1]) if d else (col["top1"][where], col["top2"][where])
        new = np.ones(len(where), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        nodes = _grouped(new, items)
        a, b, where = a[new], b[new], nodes["first"]
        if d:
            edge = (nodes["first"] == 0) | (nodes["last"] == count - 1)
            text = chars[start[where] + d - 1]
            up = (k1[start[where] + d - 2], k2[start[where] + d - 2]) if d > 1 else (col["top1"][where], col["top2"][where])
            nodes["leaves"] = np.where(~edge & (nodes["kids"] == 0), 1, nodes["leaves"])
            nodes["saved"] = np.where(edge, nodes["saved"], nodes["saved"] + (nodes["n"] - 1) * text)
            kind = np.where(edge, OPEN, DONE)
        else:
            up, text, kind = (np.zeros_like(a), np.zeros_like(a)), np.zeros_like(a), np.full(len(a), TOP)
        values = [kind.astype(np.int32), np.full(len(a), base + d), a, b, *up, text, nodes["n"], nodes["conv"],
                  nodes["kids"], nodes["leaves"], nodes["saved"]]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], schema=schema)
        if d:                                   # strip: an unfinished child hands nothing up yet
            nodes["kids"] = np.where(edge, 0, 1)
            nodes["leaves"] = np.where(edge, 0, nodes["leaves"])
            nodes["saved"] = np.where(edge, 0, nodes["saved"])


def _peel_chunks(base: int, limit: int):
    def run(batches):
        held, size = [], 0
        for batch in batches:
            step = max(1, batch.num_rows * limit // max(batch.nbytes, 1))
            for at in range(0, batch.num_rows, step):
                held.append(batch.slice(at, step))
                size += batch.nbytes * held[-1].num_rows // max(batch.num_rows, 1)
                if size >= limit:
                    yield from peel(pa.Table.from_batches(held), base)
                    held, size = [], 0
        if sum(b.num_rows for b in held):
            yield from peel(pa.Table.from_batches(held), base)
    return run


def _merge_open(batches):
    """Peel the unfinished nodes of all chunks, sorted by falling depth and key."""
    schema = pa.schema([(n, pa.int32() if n == "kind" else pa.int64()) for n in _NODE_NAMES])
    out, up, handed, node, depth = _Rows(schema), {}, {}, None, None

    def finish():
        kids, leaves, saved = up.get((node["k1"], node["k2"]), (0, 0, 0))
        kids, leaves, saved = kids + node["n_children"], leaves + node["n_leaves"], saved + node["saved"]
        leaves, saved = leaves if kids else 1, saved + (node["n_convs"] - 1) * node["chars"]
        parent = (node["p1"], node["p2"])
        k, n, s = handed.get(parent, (0, 0, 0))
        handed[parent] = (k + 1, n + leaves, s + saved)
        yield from out.add((DONE, depth, node["k1"], node["k2"], *parent, node["chars"], node["n_convs"], node["conv_id"],
                            kids, leaves, saved))

    for batch in batches:
        for row in batch.to_pylist():
            if node and (row["depth"], row["k1"], row["k2"]) == (depth, node["k1"], node["k2"]):
                for k in ("n_convs", "n_children", "n_leaves", "saved"):
                    node[k] += row[k]
                node["conv_id"] = min(node["conv_id"], row["conv_id"])
                continue
            if node:
                yield from finish()
                if row["depth"] != depth:
                    up, handed = handed, {}
            node, depth = row, row["depth"]
    if node:
        yield from finish()
        for (a, b), (kids, leaves, saved) in handed.items():
            yield from out.add((TOP, depth - 1, a, b, 0, 0, 0, 0, None, kids, leaves, saved))
    yield out.take()


def _tops(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("kind") == TOP).groupBy("k1", "k2").agg(
        F.sum("n_convs").alias("n"), F.min("conv_id").alias("conv"), F.sum("n_children").alias("kids"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"))


def nodes(found: DataFrame, block: int = BLOCK, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The trie's nodes from staged :func:`paths`: ``depth, k1, k2`` (key), ``p1,
    p2`` (parent's key, null at the root), ``conv_id, n_convs, n_children,
    n_leaves, saved``."""
    spark = found.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    zero = F.lit(0).cast("long")
    deepest = found.agg(F.max("block")).first()[0]
    if deepest is None:
        return spark.createDataFrame([], _NODE).drop("kind", "chars")
    done, tops = [], None
    for b in range(deepest, -1, -1):
        here = found.where(F.col("block") == b)
        entries = here.where("last").groupBy("top1", "top2", "path").agg(
            F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv")).select(
            "top1", "top2", "path", "n", "conv", zero.alias("kids"), zero.alias("leaves"), zero.alias("saved"))
        if tops is not None:
            whole = here.select(F.col("conv_id").alias("conv"), "top1", "top2", "path")
            entries = entries.unionByName(tops.drop("k1", "k2").join(whole, "conv"))
        entries = staged(entries, "trie-entries")
        peeled = staged(entries.repartitionByRange(n, "top1", "top2", "path").sortWithinPartitions("top1", "top2", "path")
                        .mapInArrow(_peel_chunks(b * block, chunk_bytes), _NODE), "trie-peeled")
        rest = peeled.where(F.col("kind") == OPEN).repartition(1).sortWithinPartitions(
            F.col("depth").desc(), "k1", "k2").mapInArrow(_merge_open, _NODE)
        rest = staged(rest, "trie-merged")
        done += [peeled.where(F.col("kind") == DONE), rest.where(F.col("kind") == DONE)]
        tops = _tops(peeled.unionByName(rest))
        if b:
            tops = staged(tops, "trie-tops")
    null = F.lit(None).cast("long")
    root = tops.select(zero.alias("depth"), "k1", "k2", null.alias("p1"), null.alias("p2"), F.col("conv").alias("conv_id"),
                       F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
                       F.greatest("leaves", F.lit(1)).alias("n_leaves"), "saved")
    for part in done:
        root = root.unionByName(part.select(root.columns))
    return root


def _join_ids(batches):
    """Sorted (k1, k2, conv_id) -> rows of up to IDS_PER_ROW joined ids of a key."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("ids", pa.binary())])
    out, key, held = _Rows(schema), None, []

    def emit():
        ids = ",".join(map(str, held)).encode()
        yield from out.add((*key, held[0], ids), 64 + len(ids))

    for batch in batches:
        for a, b, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if key != (a, b) or len(held) == IDS_PER_ROW:
                if held:
                    yield from emit()
                key, held = (a, b), []
            held.append(c)
    if held:
        yield from emit()
    yield out.take()


def _hash_ids(batches):
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
    out, key, digest = _Rows(schema), None, None
    for batch in batches:
        for a, b, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            if key == (a, b):
                digest.update(b"," + ids)
                continue
            if key is not None:
                yield from out.add((*key, digest.hexdigest()), 128)
            key, digest = (a, b), sha256(ids)
    if key is not None:
        yield from out.add((*key, digest.hexdigest()), 128)
    yield out.take()


def ends(found: DataFrame) -> DataFrame:
    """Per key that conversations end at: SHA-256 of their ids, ascending and
    comma-joined. The ids are joined in ranges first; a key's task only streams
    those rows through the hash."""
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = found.where("last").select("k1", "k2", "conv_id")
    rows = rows.repartitionByRange(n, "k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id")
    rows = rows.mapInArrow(_join_ids, "k1 long, k2 long, first long, ids binary")
    rows = rows.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return rows.mapInArrow(_hash_ids, "k1 long, k2 long, ends_sha256 string")


def trie(turns: DataFrame, block: int = BLOCK, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``."""
    found = staged(paths(turns, block), "trie-paths")
    every = nodes(found, block, chunk_bytes)
    parents = every.where(F.col("n_children") > 0).select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("parent_conv_id"))
    out = every.join(ends(found), ["k1", "k2"], "left").join(parents, ["p1", "p2", "depth"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                      F.col("saved").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
