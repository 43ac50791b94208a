"""Every pipeline stage on awkward rows, an empty table and a table of equal rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm import brute
from tests.llm.conftest import DOCS
from tickloom.llm.common import staged

STAGE = dict(P.STAGES)


@pytest.fixture(scope="module")
def folder(spark, labels, tmp_path_factory):
    """A data folder with awkward labels; the documents come from the tests."""
    path = str(tmp_path_factory.mktemp("pipeline"))
    labels.write.parquet(f"{path}/labels.parquet")
    return path


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def through(spark, docs, folder):
    out = []
    for name, stage in P.STAGES:
        before = docs
        docs = staged(stage(spark, docs, folder), "test-awkward")
        out.append((name, before, docs))
    return out


def test_awkward_rows_go_through_every_stage(spark, messy, folder):
    seen = through(spark, messy, folder)
    assert all(after.columns == messy.columns for _, _, after in seen[:-1])
    for _, before, after in seen[:3]:          # these stages only leave rows out
        assert after.exceptAll(before).count() == 0
    mixed, pieces = seen[3][2], seen[4][2]
    assert mixed.distinct().exceptAll(seen[3][1].distinct()).count() == 0
    assert pieces.where("piece = 0").count() == mixed.count()


def test_exact_stage_on_nulls_and_repeats(spark, messy, folder):
    after = STAGE["exact dedup"](spark, messy, folder)
    last = {}
    for i, t in rows(messy, "doc_id", "text"):
        t = t or ""
        last[t] = max((x for x in (i, last.get(t)) if x is not None), default=None)
    assert sorted(rows(after.select("doc_id", F.coalesce("text", F.lit("")).alias("t")), "t", "doc_id"), key=str) == \
        sorted(last.items(), key=str)


def test_near_stage_on_awkward_texts(spark, clean_ids, folder):
    docs = staged(STAGE["exact dedup"](spark, clean_ids, folder), "test-awkward")
    after = STAGE["MinHash near-dedup"](spark, docs, folder)
    want = {i for i, (_, c) in brute.near_components([(i, t or "") for i, t in rows(docs, "doc_id", "text")]).items() if i == c}
    assert {i for i, in rows(after, "doc_id")} == want


def test_mixing_stage_on_awkward_sources(spark, clean_ids, folder):
    """Words taken against targets from plain Python, a null source included."""
    size, source = {}, {}
    for i, s, t in rows(clean_ids, "doc_id", "source", "text"):
        size[i], source[i] = len((t or "").encode().split()), s
    taken, total = {}, {}
    for i, n in size.items():
        total[source[i]] = total.get(source[i], 0) + n
    copies = {i: n for i, n in rows(STAGE["mixing sources to target weights"](spark, clean_ids, folder).groupBy("doc_id").count(),
                                    "doc_id", "count")}
    assert max(copies.values()) <= 2 and set(copies) <= set(size)
    for i, n in copies.items():
        taken[source[i]] = taken.get(source[i], 0) + n * size[i]
    for s, target in brute.mix_targets(total).items():
        longest = max(size[i] for i in size if source[i] == s)
        assert abs(taken.get(s, 0) - target) <= max(longest, 1)


def test_no_usable_label_rejects_nothing(spark, messy, folder, tmp_path):
    spark.createDataFrame([(1, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    after = STAGE["quality classifier"](spark, messy, str(tmp_path))
    assert after.exceptAll(messy).count() == 0 and messy.exceptAll(after).count() == 0


def test_an_empty_table_gives_empty_stages(spark, empty, folder):
    assert [after.count() for _, _, after in through(spark, empty, folder)] == [0] * 5


def test_equal_rows_and_empty_texts_only(spark, folder, tmp_path):
    spark.createDataFrame([(1, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    text = "the same words again and again in every row of it"
    data = [(i % 3, text, None, "a", None, None, *"slnetcpq") for i in range(9)] + [(i, None, None, None, None, None, *"slnetcpq") for i in range(4)]
    docs = spark.createDataFrame(data, DOCS)
    seen = through(spark, docs, str(tmp_path))
    assert sorted(rows(seen[1][2], "doc_id", "text"), key=str) == sorted([(2, text), (3, None)], key=str)
    assert seen[2][2].count() <= 2 and {t for t, in rows(seen[2][2], "text")} >= {text}
    assert {t for t, in rows(seen[3][2], "text")} >= {text}
