"""Every operator against a brute-force version on awkward rows, and on an
empty table."""

from __future__ import annotations

import hashlib
import itertools
import zlib

import numpy as np
import pytest
from hypothesis import example, given, settings, strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tickloom.llm import chat, components, exact, mixing, near, packing, pii, quality, rules, shards, substrings
from tickloom.llm.common import bitmap, in_bitmap
from tickloom.llm.queries import QUERIES, tokenizer_path


def rows_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


# -- helpers ----------------------------------------------------------------
def test_bitmap_lets_every_key_through(spark):
    rows = spark.range(0, 5000).withColumn("h", F.xxhash64("id"))
    bm = bitmap(rows.where("id % 7 = 0"), F.col("h"))
    got = in_bitmap(rows, F.col("h"), bm, "hit").where("hit").select("id").collect()
    ids = {r[0] for r in got}
    assert ids >= set(range(0, 5000, 7)) and len(ids) < 800


def test_components(spark):
    r = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in r.integers(0, 300, (220, 2)) if a != b] + [(i, i + 1) for i in range(400, 460)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = dict(rows_of(components.components(spark.createDataFrame(links, "a long, b long")), "node", "label"))
    assert got == {x: find(x) for x in root}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 7 ------------------------------------------------------------------------
def test_exact_groups_and_filter(messy, empty):
    rows = rows_of(messy, "doc_id", "text")
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    got = rows_of(exact.exact_groups(messy.withColumn("t", F.coalesce("text", F.lit("")))), "doc_id", "t", "keep_id", "group_size", "kept")
    assert len(got) == len(rows)
    for i, t, keep, size, kept in got:
        want = max((x for x in groups[t] if x is not None), default=None)
        assert (keep, size, kept) == (want, len(groups[t]), i == want)
    kept = exact.exact_dedup(messy)
    assert kept.columns == messy.columns
    assert sorted(t or "" for t, in rows_of(kept, "text")) == sorted(groups)
    assert exact.exact_groups(empty).count() == 0 and exact.exact_dedup(empty).count() == 0


# -- 4 ------------------------------------------------------------------------
def test_shards(messy, empty):
    out = shards.shard(messy.withColumn("key", F.xxhash64(F.coalesce("text", F.lit(""))))
                       .withColumn("t", F.coalesce("text", F.lit(""))), 5)
    got = rows_of(out, "doc_id", "t", "key", "size", "shard", "slot")
    assert len(got) == messy.count()
    assert all(size == len(t.encode()) + 1 for _, t, _, size, _, _ in got)
    per = {}
    for _, t, key, size, shard, slot in got:
        per.setdefault(shard, []).append((slot, size, t))
    for rows in per.values():
        assert sorted(s for s, _, _ in rows) == list(range(len(rows)))
    assert all(len({s for s, rows in per.items() for _, _, x in rows if x == t}) == 1 for _, t, *_ in got)
    sizes = {}
    for _, _, key, size, _, _ in got:
        sizes[key] = sizes.get(key, 0) + size
    best = brute.smallest_capacity([sizes[k] for k in sorted(sizes)], 5)
    assert max(sum(s for _, s, _ in rows) for rows in per.values()) == best
    assert shards.shard(empty).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=25), st.integers(1, 6))
def test_minimax_cuts(sizes, n):
    capacity, cuts, _ = shards.minimax_cuts(sizes, n)
    runs = [sum(sizes[a:b]) for a, b in itertools.pairwise([0, *cuts, len(sizes)])]
    assert len(runs) <= n and capacity == (brute.smallest_capacity(sizes, n) if sizes else 0)
    assert max(runs, default=0) == capacity


def test_cells_open_until_the_optimum(spark, monkeypatch):
    monkeypatch.setattr(shards, "CELL_BITS", 2)
    r = np.random.default_rng(5)
    rows = [(int(k), int(s)) for k, s in zip(r.integers(-2**63, 2**63 - 1, 40), r.integers(1, 90, 40))]
    groups = spark.createDataFrame(rows, "_s_key long, _s_size long")
    capacity, _ = shards.cut_keys(groups, 4)
    assert capacity == brute.smallest_capacity([s for _, s in sorted(rows)], 4)


# -- 3 ------------------------------------------------------------------------
def test_mix(messy, empty):
    got = rows_of(mixing.mix(messy), "source", "size", "source_size", "target", "copies", "taken")
    assert len(got) == messy.count()
    sizes = {}
    for i, t, s in rows_of(messy, "doc_id", "text", "source"):
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    want = brute.mix_targets(sizes)
    for source, size, source_size, target, copies, taken in got:
        assert source_size == sizes[source] and target == pytest.approx(want[source])
        assert taken == copies * size <= 2 * size
    mixed = mixing.mixed(messy)
    assert mixed.columns == messy.columns
    assert mixed.count() == sum(g[4] for g in got)
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_mix_comes_near_its_targets_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    run = lambda n: sorted(rows_of(mixing.mix(docs.repartition(n)), "doc_id", "source", "target", "taken"))
    got = run(3)
    assert got == run(7)
    per = {}
    for _, s, target, taken in got:
        per.setdefault(s, [target, 0])[1] += taken
    assert all(abs(taken - target) <= 0.03 * target for target, taken in per.values())


def test_mix_takes_long_and_short_documents_at_one_rate(spark):
    """A hot source with many sizes of one document each; its rate is below one."""
    r = np.random.default_rng(5)
    size = lambda: int(r.lognormal(5.5, 0.7)) + 1
    docs = [(i, "c" if i < 1500 else "abde"[i % 4], " ".join(["w"] * size())) for i in range(4060)]
    got = rows_of(mixing.mix(spark.createDataFrame(docs, "doc_id long, source string, text string")),
                  "source", "size", "source_size", "target", "copies")
    for source in "abcde":
        rows = sorted(g[1:] for g in got if g[0] == source)
        rate = rows[0][2] / rows[0][1]
        assert abs(sum(g[0] * g[3] for g in rows) - rows[0][2]) <= rows[0][0]
        for part in [*np.array_split(rows, 10), rows[-30:]]:
            assert abs(np.mean([g[3] for g in part]) - rate) <= 0.1


# -- 2 ------------------------------------------------------------------------
def test_pack(messy, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    want = []
    for i, t in rows_of(messy, "doc_id", "text"):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 256):
            part = np.array(ids[k:k + 256], dtype="<u4").tobytes()
            want.append((i, k // 256, k, len(part) // 4, zlib.crc32(part), part))
    out = packing.pack(messy, tokenizer_path(), ["doc_id"], seq_len=256, keep_ids=True)
    got = rows_of(out, "doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset")
    null_first = lambda r: (r[0] is not None, *((-1 if r[0] is None else r[0],)), *r[1:])
    assert sorted((null_first((*g[:5], bytes(g[5]))) for g in got)) == sorted(map(null_first, want))
    per = {}
    for g in got:
        per.setdefault(g[6], []).append((g[7], g[3]))
    for pieces in per.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 256
    assert len(per) <= 1.03 * -(-sum(g[3] for g in got) // 256) + 1
    assert packing.pack(empty, tokenizer_path(), ["doc_id"]).count() == 0


@pytest.mark.parametrize("limit", [100, 1 << 22])
def test_ids_of_messy_texts_equal_the_library(messy, limit):
    import pyarrow as pa
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    texts = [t or "" for t, in rows_of(messy, "text")]
    column = pa.array([t.encode() for t in texts], pa.binary())
    for t, (_, ids) in zip(texts, packing.whole_ids(column, packing.word_counter(tokenizer_path()), limit), strict=True):
        assert ids == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
@example({33: 13})          # no two fit together
def test_best_two_fit_uses_everything(counts):
    used, bins = {}, 0
    for repeats, bin_ in packing.best_two_fit(counts, 64):
        assert sum(n * c for n, c in bin_.items()) <= 64 and repeats > 0
        bins += repeats
        for n, c in bin_.items():
            used[n] = used.get(n, 0) + repeats * c
    assert used == counts
    total = sum(n * c for n, c in counts.items())
    # every bin but the last is more than half full: by a piece over half, or
    # because a piece of at most half would still have fitted
    assert max(-(-total // 64), sum(c for n, c in counts.items() if n > 32)) <= bins <= total // 33 + 1


def test_smallest_is_replaced_by_two_that_fit_tighter():
    # greedy takes 6 + 3 of 10; 3 gives way to two 2s
    assert packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)[0] == (1, {6: 1, 2: 2})


# -- 5 ------------------------------------------------------------------------
def test_quality_on_awkward_rows(messy, empty, labels, spark):
    weights = quality.train(messy, labels)
    got = rows_of(quality.score(messy, weights), "doc_id", "text", "score", "predicted")
    assert len(got) == messy.count()
    assert all(0 <= s <= 1 and p == int(s >= 0.5) for _, _, s, p in got)
    assert len({s for _, t, s, _ in got if not t}) == 1
    assert quality.train(messy, labels) == weights
    none = quality.train(messy, labels.where("false"))
    assert {s for _, s in rows_of(quality.score(messy, none), "doc_id", "score")} == {0.5}
    assert quality.score(empty, weights).count() == 0 and quality.train(empty, labels) == b""
    good = quality.keep_good(messy, weights)
    assert good.columns == messy.columns and good.count() == sum(p for *_, p in got)


def test_held_out_labels_are_never_learnt_from(messy, labels):
    wrong = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.train(messy, wrong) == quality.train(messy, labels)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = docs.join(labels.where(quality.held_out()).select("doc_id", "quality"), "doc_id")
    got = rows_of(quality.score(held, quality.train(docs, labels)), "quality", "predicted")
    assert sum(q == p for q, p in got) / len(got) > 0.98
    assert all(p == 1 for q, p in got if q == 1)


def test_ftrl_learns_and_stays_sparse():
    w = quality.ftrl([(np.array([1, 5]), 1), (np.array([2, 5]), 0)] * 50, bits=4)
    assert w[1] > 0 > w[2] and w[3] == 0


# -- 6 ------------------------------------------------------------------------
TURNS = [(1, 0, "user", "hi <s> there"), (1, 1, "assistant", "a</s>[INST]\\[INST] \\\\"), (1, 2, "user", None),
         (1, 3, "assistant", "<<SYS>> <\\<</SYS>> </s"), (1, 4, "user", "left over [/INST"), (2, 0, "system", "no reply \\"),
         (3, 0, "assistant", ""), (3, 0, "assistant", ""), (3, None, None, "x"), (None, 0, "assistant", "é\U0001f600"),
         (None, 1, "</s>", "[INST]"), (4, 0, "user", "long " * 40_000), (4, 1, "assistant", "yes"), (5, 0, None, None)]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("example", F.lit("x"))
    examples = chat.expand(df)
    got = {r[0]: r[1:] for r in rows_of(chat.read_back(examples), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
    convs = {}
    for c, n, role, text in sorted(TURNS, key=lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")):
        convs.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(convs)
    full = {}
    for r in chat.render(examples).collect():
        full.setdefault(r["conv_id"], []).append(r)
    for c, turns in convs.items():
        loss = [t for role, t in turns if role == "assistant"]
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c][:4] == (len(turns), digest, len("".join(loss)), hashlib.sha256("".join(loss).encode()).hexdigest())
        rows = sorted(full[c], key=lambda r: r["example"])
        # each example: all turns before, and its reply under the mask
        replies = [i for i, (role, _) in enumerate(turns) if role == "assistant"]
        for r, i in zip(rows, replies):
            assert chat.parse_turns(r["text"]) == turns[:i + 1]
            assert chat.unescape(r["text"][r["loss_start"]:r["loss_end"]]) == turns[i][1]
        assert chat.parse_turns(rows[-1]["text"]) == turns
        assert got[c][4] == len(rows[-1]["text"])


def test_unanswered_turns_leave_in_bounded_rows(spark):
    """One conversation, most of it without replies, and one without any."""
    turns = [(c, n, "assistant" if c == 1 and n in (30, 31) else "user", f"{n} " + "<s>x" * 20_000) for c in (1, 2) for n in range(40)]
    examples = chat.expand(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).cache()
    parts = rows_of(examples.withColumn("n", F.length("delta")), "conv_id", "example", "n", "target")
    turn = len(chat.format_turn("user", turns[0][3])) + 1
    assert max(p[2] for p in parts) < (1 << 20) + 2 * turn
    assert sorted((p[0], p[1]) for p in parts if p[3] is not None) == [(1, 0), (1, 1)]
    whole = sorted(rows_of(chat.render(examples), "conv_id", "example", "text"))
    assert [w[:2] for w in whole] == [(1, 0), (1, 1), (1, 2), (2, 0)]
    said = {c: [t[2:] for t in turns if t[0] == c] for c in (1, 2)}
    assert [chat.parse_turns(w[2]) for w in whole] == [said[1][:31], said[1][:32], said[1], said[2]]
    got = {r[0]: r[1:] for r in rows_of(chat.read_back(examples), "conv_id", "n_turns", "turns_sha256", "formatted_chars")}
    for c in (1, 2):
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said[c]).encode()).hexdigest()
        assert got[c] == (40, digest, len(whole[-1 if c == 2 else 2][2]))
    # a changed context or a moved span of any example is found
    for changed in ({"delta": F.concat(F.lit("<s>user[INST]more</s>"), "delta")}, {"loss_end": F.col("loss_end") - 1}):
        with pytest.raises(Exception, match="differs from its rows"):
            chat.read_back(examples.withColumns(changed)).collect()


def test_chat_examples_hold_their_whole_context(spark):
    """Conversations of several blocks and of one; each example's rows give all turns before its reply."""
    turns = [(c, n, "assistant" if n % 5 == 3 else "user", f"{n} " + "<s>x" * (15_000 if c == 1 else 10))
             for c in (1, 2, None) for n in range(60 if c == 1 else 7)]
    steps = chat.expand(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).cache()
    examples = chat.whole(steps).cache()
    got = {}
    for r in sorted(examples.collect(), key=lambda r: (str(r["conv_id"]), r["example"], r["part"])):
        got.setdefault((r["conv_id"], r["example"]), []).append(r)
        assert len(r["context"]) < 3 * chat.PART
    assert max(len(rows) for rows in got.values()) > 2
    for c in (1, 2, None):
        said = [t[2:] for t in turns if t[0] == c]
        replies = [n for n, (role, _) in enumerate(said) if role == "assistant"]
        assert sorted(e for k, e in got if k == c) == list(range(len(replies) + 1))
        for e, n in enumerate([*replies, len(said) - 1]):
            rows = got[c, e]
            text = "".join(r["context"] for r in rows) + (rows[-1]["target"] or "")
            assert chat.parse_turns(text) == said[:n + 1]
            assert [r["final"] for r in rows] == [False] * (len(rows) - 1) + [True]
            if e < len(replies):
                assert chat.unescape(text[rows[-1]["loss_start"]:rows[-1]["loss_end"]]) == said[n][1]
    # a word changed in an early turn, as one later example has it
    hit = (F.col("conv_id") == 2) & (F.col("example") == 1)
    bad = examples.withColumn("context", F.when(hit, F.replace("context", F.lit("0 <"), F.lit("9 <"))).otherwise(F.col("context")))
    assert bad.exceptAll(examples).count() == 1
    with pytest.raises(Exception, match="differs from its rows"):
        chat.read_examples(bad).collect()


def test_chat_of_no_turns(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.expand(none).count() == 0 and chat.read_back(chat.expand(none)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\", "<", "[", "s>", "/", "a"]), max_size=12))
def test_escape_is_reversible(parts):
    text = "".join(parts)
    assert chat.unescape(chat.escape(text)) == text
    assert not any(m in chat.escape(text) for m in (chat.BOS, chat.EOS, chat.INST, "[/INST]", "<<SYS>>", "<</SYS>>"))
    assert chat.parse_turns(chat.format_turn(text, text) * 2) == [(text, text)] * 2


# -- 8 ------------------------------------------------------------------------
def test_near_groups(clean_ids, empty):
    want = brute.near_components(rows_of(clean_ids, "doc_id", "text"))
    got = rows_of(near.near_groups(clean_ids), "doc_id", "n_shingles", "component_id", "kept")
    assert {g[0]: g[1:] for g in got} == {i: (n, c, i == c) for i, (n, c) in want.items()}
    kept = near.near_dedup(clean_ids)
    assert kept.columns == clean_ids.columns
    assert sorted(i for i, in rows_of(kept, "doc_id")) == sorted(i for i, (_, c) in want.items() if i == c)
    assert near.near_groups(empty).count() == 0 and near.near_dedup(empty).count() == 0


def test_near_groups_with_repeated_and_missing_ids(messy):
    got = rows_of(near.near_groups(messy), "doc_id", "n_shingles", "component_id", "kept")
    assert len(got) == messy.count()
    by_id = {}
    for i, n, c, k in got:
        by_id.setdefault(i, set()).add((n, c, k))
    assert len(by_id[0]) == 1 and len(by_id[20]) == 1
    # a missing id takes its class's component, and none where the class has no id
    assert {c for _, c, _ in by_id[None]} >= {None}


def test_near_dedup_keeps_one_row_of_a_group_without_or_with_repeated_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(1, a), (1, a), (1, a + " end"), (None, a), (None, b), (None, b), (5, c), (5, c), (6, d), (7, d + " end"), (7, ""),
            (8, "alone with its id"), (2, ""), (2, ""), (None, ""), (None, None)]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, kept string")
    got = near.near_dedup(docs)
    assert got.columns == docs.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    got = sorted(((i, t and t[0]) for i, t in rows_of(got, "doc_id", "text")), key=key)
    assert got == sorted([(1, "a"), (5, "c"), (6, "d"), (8, "a"), (7, ""), (2, ""), (2, ""), (None, ""), (None, None), (None, "b")], key=key)


@pytest.mark.parametrize("block", [3, 4096])
def test_chain_of_near_copies_is_one_component(spark, monkeypatch, block):
    """Neighbours are linked, the ends are not: the rounds must find every link."""
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "SET_BLOCK", block)
    monkeypatch.setattr(near, "SMALL", block)
    words = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(words[4 * i:4 * i + 120])) for i in range(60)] + [(100 + i, " ".join(words[300:400][::-1]) + f" z{i}") for i in range(20)]
    want = brute.near_components(docs)
    got = {r[0]: (r[1], r[2]) for r in rows_of(near.near_groups(spark.createDataFrame(docs, "doc_id long, text string")),
                                              "doc_id", "n_shingles", "component_id")}
    assert got == want


def test_estimate_follows_similarity():
    r = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.75, 0.9):
        errors = []
        for _ in range(20):
            both = r.integers(0, 2**63, int(1000 * share), dtype=np.uint64)
            rest = r.integers(0, 2**63, (2, (1000 - len(both)) // 2), dtype=np.uint64)
            a, b = (near.packed(near.minima(np.unique(np.concatenate([both, x])))).view(np.uint64) for x in rest)
            d = (a ^ b)
            differ = sum(int(np.bitwise_count(np.bitwise_or.reduce(d[h:h + near.LOW_BITS]))) for h in (0, near.LOW_BITS))
            errors.append(near.estimate(near.PERMS - differ) - share)
        assert abs(np.mean(errors)) < 0.04


# -- 9 ------------------------------------------------------------------------
def test_rule_counts(messy, empty, labels):
    out = rules.judge(messy.withColumn("t", F.coalesce("text", F.lit(""))), labels)
    got = rows_of(out, "t", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert len(got) == messy.count()
    for t, *counts, failed, kept in got:
        want = brute.rule_counts(t)
        assert tuple(counts) == want
        assert failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (failed and kept)
    assert rules.judge(empty, labels).count() == 0
    none = rules.judge(messy, labels.where("false"))
    assert none.where("kept = base_failed").count() == 0


@pytest.mark.parametrize("n,k,p", [(10, 0, .1), (50, 3, .2), (200, 40, .21), (1000, 2, .01), (30, 29, .9)])
def test_binomial_tail(n, k, p):
    from math import comb
    assert rules.binomial_at_most(k, n, p) == pytest.approx(sum(comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1)), rel=1e-9)


def test_cutoffs_reject_what_labels_allow(spark):
    """Good documents have few symbols, bad ones many: with enough labels a cutoff
    between them is safe; with a tenth of them none is."""
    def rows(n):
        return [(i, "en", 200, 1000, 2 if i % 2 else 300, 0, 0, 10, False) for i in range(n)]
    schema = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, base_failed boolean"
    many = spark.createDataFrame(rows(6000), schema)
    labels = many.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    found = rules.cutoffs(many, labels)
    assert 0.002 <= found["en", "symbols"] < 0.3
    few = many.where("doc_id < 600")
    assert rules.cutoffs(few, labels) == {}
    # the bound holds for what is rejected
    assert rules.is_safe(0, 3000, rules.ALPHA / 4, rules.DELTA / 20)


def _holdout(spark, groups):
    """Rows of (lang, number of rows, number of texts, symbols), all good."""
    data, at = [], 0
    for lang, n, texts, symbols in groups:
        data += [(at + i, lang, 200, 1000, symbols, 0, 0, 10, False, at + i % texts) for i in range(n)]
        at += n
    schema = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long, n_lines long, base_failed boolean, _r_th long")
    rows = spark.createDataFrame(data, schema)
    return rows, rows.select("doc_id", F.lit(1).alias("quality"))


def test_copies_are_no_trials(spark):
    rows, labels = _holdout(spark, [("en", 4000, 300, 2)])
    assert rules.cutoffs(rows, labels) == {}
    assert rules.cutoffs(rows.withColumn("_r_th", F.col("doc_id")), labels) != {}


def test_small_strata_are_judged_together_but_not_against_their_holdout(spark):
    rows, labels = _holdout(spark, [("de", 700, 700, 2), ("fr", 700, 700, 2), (None, 1, 1, 90)])
    found = rules.cutoffs(rows, labels)
    assert {s for s, _ in found} == {"de", "fr", "other"}
    # the one other is within the limit of the pool, and all of its own stratum
    assert found["de", "symbols"] < 0.09 <= found["other", "symbols"]
    assert not any(s == "es" for s, _ in found)


@given(st.dictionaries(st.sampled_from(["a", "b", "c", "d", "e"]), st.integers(0, 4000)))
def test_families_can_pass(sizes):
    own, pooled = rules.families(sizes, 0.005, 0.05, 4)
    assert sorted(own + pooled) == sorted(sizes)
    for s in own:
        assert rules.is_safe(0, sizes[s], 0.005, 0.05 / (4 * (len(own) + bool(pooled))))


def test_step_down_hands_finished_parts_on():
    # n = 1,196 is the least that passes a twentieth, 875 a quarter of a chain's share
    assert rules.step_down({i: (1000, [0, 0]) for i in range(20)}, 0.005, 0.05) == {}
    chains = {0: (5000, [0, 0]), 1: (800, [0, 9]), 2: (50, [0])}
    assert rules.is_safe(0, 800, 0.005, 0.05 / 2) and not rules.is_safe(0, 800, 0.005, 0.05 / 3)
    assert rules.step_down(chains, 0.005, 0.05) == {0: 1, 1: 0}


def test_false_rejection_is_controlled():
    """A rule that rejects just over the limit is accepted with chance delta at most."""
    rng, wrong, limit = np.random.default_rng(5), 0, 0.005
    for _ in range(2000):
        chains = {c: (1500, [int(rng.binomial(1500, limit * 1.02))]) for c in range(6)}
        wrong += bool(rules.step_down(chains, limit, 0.05))
    assert wrong <= 0.05 * 2000 + 3 * (0.05 * 0.95 * 2000) ** 0.5


def test_judge_against_plain_python(spark):
    """Counts by plain Python, cutoffs as found, every row's verdict."""
    docs = spark.createDataFrame([(i, "en", " ".join(f"w{i}x{k}" for k in range(60)) + " #$" * (40 if i % 5 == 0 else 0))
                                  for i in range(1500)], "doc_id long, lang string, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 5 != 0).cast("int").alias("quality"))
    rows = rules.features(docs)
    found = rules.cutoffs(rows, labels)
    assert "symbols" in {r for _, r in found}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rules.judge(docs, labels).collect():
        words = texts[r["doc_id"]].split()
        ratios = {"symbols": sum(c in rules.SYMBOLS for w in words for c in w) / sum(map(len, words)),
                  "word_length": sum(map(len, words)) / len(words), "dup_lines": 0.0,
                  "repeats": r["n_repeat_words"] / len(words)}
        bad = r["base_failed"] or any(ratios[rule] > c for (_, rule), c in found.items())
        assert r["kept"] == (not bad)
    assert "_r_th" not in rules.judge(docs, labels).columns


# -- 10 -----------------------------------------------------------------------
@pytest.mark.parametrize("bucket", [substrings.BUCKET, 1])
def test_substrings(messy, empty, bucket):
    data = rows_of(messy, "doc_id", "text")
    want = sorted(brute.without_repeats([t for _, t in data]))
    rows, spans = substrings.repeats(messy, ["doc_id", "n_bytes"], bucket=bucket)
    cut = substrings.kept_bytes(messy, spans, rows)
    out = rows.join(cut, "_b_th", "left").join(
        messy.select(F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("_b_th"), F.coalesce("text", F.lit("")).alias("t"))
        .distinct(), "_b_th")
    got = rows_of(out, "n_bytes", F.coalesce("n_removed", F.lit(0)), F.coalesce("n_spans", F.lit(0)),
                  F.sha2(F.coalesce("kept", F.col("t").cast("binary")), 256))
    assert sorted(got) == want
    rows, spans = substrings.repeats(empty, ["doc_id"])
    assert rows.count() == 0 and spans.count() == 0 and substrings.kept_bytes(empty, spans, rows).count() == 0


def test_planted_passages_go_from_400_bytes(spark, tmp_path):
    """Passages of 51 to 75 words, each in two texts that share nothing else: those of at least 400
    bytes go, to the byte, and shorter ones stay, as the contract has it."""
    r = np.random.default_rng(10)
    words = lambda n: " ".join("".join(map(chr, r.integers(97, 123, r.integers(2, 10)))) for _ in range(n))
    passages = [words(n) for n in range(51, 76) for _ in range(2)] + [words(80)[:n] for n in (399, 400)]
    size = [len(p) for p in passages]
    texts = [t for p in passages for t in (f"{words(90)}\n{p}\n{words(90)}", f"{words(200)} {p} {words(30)}")]
    assert sum(n < 400 for n in size) > 10 and sum(n >= 400 for n in size) > 10
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op10_suffix_blockwise"](spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [(x.n_removed, x.n_spans) for x in got] == [(n, 1) if n >= 400 else (0, 0) for n in size for _ in range(2)]
    assert [(x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got] == brute.without_repeats(texts)


def near_copies(seed):
    """Texts around one passage, changed in a few places, cut short at either end or periodic."""
    r = np.random.default_rng(seed)
    base, texts = r.integers(97, 123, 900, dtype=np.uint8), []
    for k in range(60):
        t = base.copy()
        for at in r.integers(0, 900, r.integers(0, 4)):
            t[at] = r.integers(97, 100)
        start, end = int(r.choice([0, 0, 150, 313])), int(r.choice([900, 900, 800, 713]))
        lead = "".join(map(chr, r.integers(97, 123, r.integers(0, 60)))) if start == 0 else ""
        texts.append(lead + t[start:end].tobytes().decode())
    return texts + ["a" * n for n in (399, 400, 401, 450, 700, 900)] + ["a" * 410 + "b" * k for k in (1, 2, 90)] + [
        "b" * k + "a" * 410 for k in (1, 2, 90)]


@pytest.mark.parametrize("bucket", [1, 6])
def test_large_buckets_equal_brute_force(spark, bucket):
    """Buckets too large to sort are cut into those of their parts, some of which are again too large."""
    texts = near_copies(bucket)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, spans = substrings.repeats(docs, ["doc_id"], bucket=bucket)
    cut = substrings.kept_bytes(docs, spans, rows).withColumn("kept_sha256", F.sha2("kept", 256))
    got = {r["doc_id"]: r for r in rows.select("doc_id", "_b_th", "n_bytes").join(cut, "_b_th").collect()}
    for k, (n, removed, n_spans, kept) in enumerate(brute.without_repeats(texts)):
        assert (k in got) == (removed > 0)
        assert not removed or (got[k]["n_removed"], got[k]["n_spans"], got[k]["kept_sha256"]) == (removed, n_spans, kept)


def test_a_large_bucket_is_not_written_window_by_window(spark, monkeypatch):
    """One passage of 300 bytes in 60 texts that share nothing else: their strips are told apart by
    at most 4 parts each, not by 301 windows, and no bytes are sent again."""
    r = np.random.default_rng(12)
    some = lambda n: "".join(map(chr, r.integers(97, 123, n)))
    passage, wrote, staged = some(300), {}, substrings.staged

    def spy(df, name):
        wrote[name] = (out := staged(df, name)).count()
        return out

    monkeypatch.setattr(substrings, "staged", spy)
    texts = [some(500) + passage + some(500) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, spans = substrings.repeats(docs, ["doc_id"], bucket=16)
    assert spans.count() == 0 and wrote["sub-strips"] > 30
    assert max(wrote.values()) <= 5 * wrote["sub-strips"] and "sub-part-strips" not in wrote


def test_difference_cover():
    d = substrings.COVER_SET
    assert len(d) == 9 and {(a - b) % substrings.COVER for a in d for b in d} == set(range(substrings.COVER))


def strips_of_buckets(seed, size, most):
    """Strips around the anchors of made-up buckets, some cut short at an end of
    their text, some periodic, with bytes 0 among them."""
    r = np.random.default_rng(seed)
    out = []
    for bucket in range(size):
        core = np.tile(r.integers(0, 3, int(r.choice([7, 73, 700])), dtype=np.uint8), 100)[:700]
        for _ in range(r.integers(2, most)):
            s = core.copy()
            for at in r.integers(0, 700, r.integers(0, 4)):
                if not 300 <= at < 400:
                    s[at] = 65
            left, right = int(r.choice([300, 300, 0, 211])), int(r.choice([400, 400, 100, 333]))
            out.append((bucket, left, s[300 - left:300 + right].tobytes()))
    out = sorted(set(out))
    return [s for _, _, s in out], np.array([n for _, n, _ in out]), np.array([b for b, _, _ in out])


@pytest.mark.parametrize("size, most", [(1, 40), (12, 6), (40, 3)])
def test_repeated_starts_equal_brute_force(size, most):
    strips, left, bucket = strips_of_buckets(size, size, most)
    first, last = substrings.repeated_starts(strips, left, bucket)
    at = [{300 - n + k: s[k:k + 400] for k in range(len(s) - 399)} for s, n in zip(strips, left.tolist())]
    for x in range(len(strips)):
        starts = [i for i in at[x] if any(at[x][i] == at[y].get(i) for y in range(len(strips)) if y != x and bucket[x] == bucket[y])]
        assert (first[x], last[x]) == ((min(starts), max(starts)) if starts else (301, -1))


def test_suffixes_are_in_byte_order():
    strips, left, _ = strips_of_buckets(5, 6, 9)
    rows = substrings._aligned(strips, left)[0]
    suffix = lambda k, s: rows[k, s:].tobytes()
    for c, rank in substrings.sample_ranks(rows).items():
        names = sorted({suffix(k, c) for k in range(len(rows))})
        assert [names[i] for i in rank] == [suffix(k, c) for k in range(len(rows))]
    seen = []
    for s, order in substrings.sorted_suffixes(rows):
        seen.append(s)
        assert [suffix(k, s) for k in order] == sorted(suffix(k, s) for k in range(len(rows)))
    assert seen == list(range(300, -1, -1))


def test_anchors_of_a_long_text_do_not_depend_on_chunks(monkeypatch):
    r = np.random.default_rng(2)
    text = bytes(r.integers(97, 123, 30_000, dtype=np.uint8)) + b"ab" * 2000
    whole = substrings.Anchors().of(text)
    monkeypatch.setattr(substrings, "CHUNK", 1000)
    parts = substrings.Anchors().of(text)
    assert all((a == b).all() for a, b in zip(whole, parts))


# -- 1 ------------------------------------------------------------------------
def test_base_spans(messy, empty):
    out = pii.extract(messy.withColumn("t", F.coalesce("text", F.lit(""))), ["doc_id", "t", "spans"])
    got = rows_of(out, "t", "base", "spans")
    assert len(got) == messy.count()
    for t, base, spans in got:
        assert [tuple(b) for b in base] == brute.base_spans(t)
        assert set(map(tuple, base)) <= set(map(tuple, spans))
    assert pii.extract(empty, ["doc_id"]).count() == 0


def test_patterns_find_what_the_rules_miss(spark):
    """"phone: +..." is learnt; a number without the plus is found in its place,
    and left alone elsewhere."""
    r = np.random.default_rng(4)
    word = lambda: "".join(r.choice(list("abcdefgh"), 5))
    docs = [(i, f"{word()} {word()} phone: +1 650 {r.integers(200, 999)} {r.integers(1000, 9999)} {word()}") for i in range(40)]
    docs += [(100, "call me phone: 650 555 0199 soon"), (101, "order number 650 555 0199 shipped"), (102, "phone: none given")]
    out = {r["doc_id"]: r for r in pii.extract(spark.createDataFrame(docs, "doc_id long, text string"), ["doc_id"]).collect()}
    assert out[100]["base"] == [] and [tuple(s) for s in out[100]["spans"]] == [("phone", 15, 27)]
    assert out[101]["spans"] == [] and out[102]["spans"] == []
    assert all(out[i]["base"] == out[i]["spans"] for i in range(40))


def test_patterns_learn_where_a_third_of_the_forms_is_unknown(spark):
    """Of the numbers after "phone:" a third has no plus. After "serial:" most are
    plain and after "paid:" most are of other kinds: these find nothing."""
    r = np.random.default_rng(6)
    word = lambda: "".join(r.choice(list("abcdefgh"), 5))
    number = lambda: f"650 {r.integers(200, 999)} {r.integers(1000, 9999)}"
    docs = [(i, f"{word()} {word()} phone: {'+1 ' if i < 60 else ''}{number()} {word()}") for i in range(90)]
    docs += [(100 + i, f"{word()} {word()} serial: {'+1 ' if i < 6 else ''}{number()} {word()}") for i in range(60)]
    docs += [(200 + i, f"{word()} {word()} paid: {f'+1 {number()}' if i < 6 else '4111 1111 1111 1111' if i < 7 else f'10.0.0.{i}'} {word()}")
             for i in range(20)] + [(300, f"{word()} {word()} paid: {number()} {word()}")]
    out = {r["doc_id"]: r for r in pii.extract(spark.createDataFrame(docs, "doc_id long, text string"), ["doc_id"]).collect()}
    assert all(out[i]["base"] == [] and [s["kind"] for s in out[i]["spans"]] == ["phone"] for i in range(60, 90))
    assert all(out[i]["base"] == out[i]["spans"] for i in [*range(60), *range(100, 160), *range(200, 220), 300])
