"""Token counts, the conversation trie and ranked search against brute force."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm import brute
from tickloom.llm import packing, search, tokencount, trie
from tickloom.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def counter():
    return tokencount.WordCounter(tokenizer_path())


# -- token counts -------------------------------------------------------------
ODD = ("abcdefghijklmnopqrstuvwxyz" * 2 + "ABCÀÉÖØßÿ×÷ªµº²½'''\"!.-0123456789  \n\t\r\x1c\x85\xa0 　́"
       "̈İΣσς漢字🙂﻿\x00़")


def _counts(counter, texts, limit=tokencount.CHUNK_BYTES):
    return tokencount.count_tokens(pa.array([t.encode() for t in texts], pa.binary()), counter, limit).tolist()


@pytest.mark.parametrize("limit", [tokencount.CHUNK_BYTES, 40])
def test_token_counts_equal_the_library(counter, limit):
    r = random.Random(1)
    texts = ["".join(r.choice(ODD) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    texts += [t[:9] + "<|endoftext|>" + t[9:] + "<|startoftext|><|endoftext|>" for t in texts[:200]]
    texts += ["", " ", "\n\n", "<|endoftext|>", "<|endoftext", "<|ENDOFTEXT|>", "I'LL we've 's's", "aaaa" * 3000, "haha" * 999]
    assert _counts(counter, texts, limit) == brute.library_tokens(tokenizer_path(), texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_token_counts_of_any_text(texts):
    counter = tokencount.word_counter(tokenizer_path())
    assert _counts(counter, texts) == brute.library_tokens(tokenizer_path(), texts)


@pytest.mark.parametrize("limit", [tokencount.CHUNK_BYTES, 40])
def test_token_ids_equal_the_library(counter, limit):
    from tokenizers import Tokenizer
    r = random.Random(2)
    texts = ["".join(r.choice(ODD) for _ in range(r.randint(0, 60))) for _ in range(500)]
    texts += [t[:9] + "<|endoftext|>" + t[9:] + "<|startoftext|><|endoftext|>" for t in texts[:100]] + ["", "aaaa" * 500]
    tok = Tokenizer.from_file(tokenizer_path())
    got = packing.whole_ids(pa.array([t.encode() for t in texts], pa.binary()), counter, limit)
    for (row, ids), (i, t) in zip(got, enumerate(texts), strict=True):
        assert row == i and np.frombuffer(ids, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_merging_is_rank_synchronous_and_left_to_right(counter):
    table = counter.table
    lens = np.array([1, 5, 2])
    got = table.count(np.frombuffer(b"a" + b"aaaaa" + b"zq", np.uint8), lens)
    assert got.tolist() == brute.library_tokens(tokenizer_path(), ["a", "aaaaa", "zq"])
    assert table.count(np.zeros(0, np.uint8), np.zeros(0, np.int64)).tolist() == []


def test_unknown_tokenizer_form_is_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        tokencount.RankTable(tokenizer_path("byte_bpe_50k.json"))


def test_token_counts_of_messy_rows(messy, empty):
    out = tokencount.token_counts(messy.withColumnRenamed("kept", "n_tokens"), tokenizer_path())
    assert "text" not in out.columns and out.columns.count("n_tokens") == 1
    rows = messy.select("doc_id", "text").collect()
    want = brute.library_tokens(tokenizer_path(), [r.text for r in rows])
    got = out.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        ((r.doc_id, len((r.text or "").encode()), n, n > 2048) for r, n in zip(rows, want)), key=str)
    assert tokencount.token_counts(empty, tokenizer_path()).count() == 0


# -- trie ---------------------------------------------------------------------
TURNS = "conv_id long, turn long, role string, text string, depth long, k1 string, path string, base long"


def _turn_rows():
    r = random.Random(3)
    rows = [(c, t, r.choice(["user", "assistant", None]), r.choice(["a", "bé", "ccc🙂", None, ""]))
            for c in [*range(0, 230), -5, -3, 777, 100000] for t in range(r.choice([1, 2, 3, 5, 8, 8, 20]))]
    rows += [(c, t, "user", "same") for c in range(300, 360) for t in (None, 1, 2)]     # one hot group of copies
    rows += [(400, t, "user", "deep") for t in range(70)] + [(401, t, "user", "deep") for t in range(60)]
    rows += [(402, t, "user", "deep" if t < 50 else "z") for t in range(70)]
    rows += [(None, 0, "user", "nobody"), (500, 0, "a", "bc"), (501, 0, "ab", "c")]
    return rows


@pytest.mark.parametrize("block, chunk", [(trie.BLOCK, trie.CHUNK_BYTES), (4, 300), (7, 1)])
def test_trie_equals_brute_force(spark, block, chunk):
    rows = _turn_rows()
    df = spark.createDataFrame([(*x, 1, "k", "p", 2) for x in rows], TURNS).repartition(5)
    got = sorted((tuple(r) for r in trie.trie(df, block, chunk).collect()), key=str)
    assert got == brute.trie(rows)


def test_trie_of_one_deep_conversation_and_of_nothing(spark):
    df = spark.range(0, 9000).selectExpr("cast(7 as long) conv_id", "id turn", "'user' role", "cast(id as string) text")
    got = trie.trie(df)
    assert got.count() == 9001 and got.agg({"n_leaves": "max", "saved_tokens": "max"}).first() == (1, 0)
    assert trie.trie(df.limit(0)).count() == 0


def test_trie_is_deterministic_for_ties(spark):
    rows = [(100, 0, "user", x) for x in ("b", "a", "c", "a")]
    df = spark.createDataFrame(rows, TURNS.split(", depth")[0])
    a = sorted(map(str, trie.trie(df.repartition(4)).collect()))
    assert a == sorted(map(str, trie.trie(df.repartition(2)).collect())) and len(a) == 5


# -- search -------------------------------------------------------------------
WORDS = ["the", "The", "été", "Été", "x1", "漢字", "a", "b", "c", "d-e", "f_g", "🙂", "zz"]


@pytest.mark.parametrize("items, postings", [(search.BLOCK_ITEMS, search.BLOCK_POSTINGS), (7, 20)])
def test_search_equals_brute_force(spark, items, postings):
    r = random.Random(4)
    docs = [(i if i % 50 else None, " ".join(r.choice(WORDS) for _ in range(r.randint(0, 12)))) for i in range(400)]
    docs += [(1000 - i, "the été été") for i in range(60)] + [(5, None), (6, ""), (7, "the été été"), (7, "the été été")]
    asked = [(i, " ".join(r.choice(WORDS) for _ in range(r.randint(0, 6)))) for i in range(30)]
    asked += [(1, "the"), (1, "the"), (2, None), (None, "été")]
    d = spark.createDataFrame([(*x, 1, 2, "b") for x in docs], "doc_id long, text string, n long, h long, bag string")
    q = spark.createDataFrame([(*x, 9) for x in asked], "item_id long, text string, score long")
    got = search.search(d, q, block_items=items, block_postings=postings)
    assert sorted((tuple(x) for x in got.collect()), key=str) == brute.lexical_search(docs, asked)


def test_search_of_messy_rows(spark, messy, empty):
    asked = [(i, t) for i, t in enumerate(["one same line", "ba re", "changed 日本語", "", "no-such-term-anywhere"])]
    q = spark.createDataFrame(asked, "item_id long, text string")
    docs = [tuple(r) for r in messy.select("doc_id", "text").collect()]
    assert sorted((tuple(x) for x in search.search(messy, q).collect()), key=str) == brute.lexical_search(docs, asked)
    assert search.search(empty, q).count() == 0 and search.search(messy, q.limit(0)).count() == 0


def test_best_classes_of_a_task_keep_ties_by_id():
    best = search.Best(2, 3)
    for lo in range(0, 40, 8):
        ids = np.arange(lo, lo + 8)[::-1].copy()
        scores = np.stack([np.full(8, 5), ids % 4], axis=1).astype(np.int64)
        best.offer(scores, ids, ids, ids)
    item, score, ids, _, _ = best.kept
    assert list(zip(item, score, ids)) == [(0, 5, 0), (0, 5, 1), (0, 5, 2), (1, 3, 3), (1, 3, 7), (1, 3, 11)]


def test_classes_are_limited_before_the_shuffle(spark):
    """Expanding a winning class never shuffles more than TOP members a task."""
    from pyspark.sql import functions as F
    rows = spark.range(100).selectExpr("id doc_id", "id % 2 h")
    plan = search._first(rows, ["h"], [F.col("doc_id").asc_nulls_last()], 20, "r")._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("WindowGroupLimit") == 2


def test_registered_queries_equal_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op13_search_bag_dedup"](spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == brute.lexical_search(docs, items)
    got = QUERIES["op11_token_counts_ranks"](spark, SF).select("doc_id", "n_tokens").collect()
    assert dict(map(tuple, got)) == dict(zip([d for d, _ in docs], brute.library_tokens(tokenizer_path(), [t for _, t in docs])))
