"""The corpus pipeline, stage by stage, against plain Python on what the stage
before it kept."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

import corpus_pipeline as P
from tests.conftest import SF001
from tests.llm import brute
from tickloom.llm import mixing, quality
from tickloom.llm.common import staged
from tickloom.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF001}/documents.parquet"), []
    for name, stage in P.STAGES:
        before = docs
        docs = staged(stage(spark, docs, SF001), "test-stage")
        out.append((name, before, docs))
    return out


def by_id(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages_and_columns(spark, stages):
    assert [n for n, *_ in stages] == ["quality classifier", "exact dedup", "MinHash near-dedup",
                                       "mixing sources to target weights", "best-fit packing"]
    columns = spark.read.parquet(f"{SF001}/documents.parquet").columns
    assert all(after.columns == columns for _, _, after in stages[:-1])
    assert all(before.count() and after.count() for _, before, after in stages)


def test_quality_stage(spark, stages):
    _, before, after = stages[0]
    weights = quality.train(before, spark.read.parquet(f"{SF001}/labels.parquet"))
    good = {r["doc_id"] for r in quality.score(before, weights).where("score >= 0.5").collect()}
    assert set(by_id(after)) == good and 0 < len(good) < before.count()


def test_exact_stage(stages):
    _, before, after = stages[1]
    last = {}
    for i, t in by_id(before).items():
        last[t] = max(i, last.get(t, i))
    assert by_id(after) == {i: t for t, i in last.items()}


def test_near_stage(stages):
    _, before, after = stages[2]
    docs = by_id(before)
    assert by_id(after) == {i: docs[i] for i, (_, c) in brute.near_components(list(docs.items())).items() if i == c}


def test_mixing_stage(stages):
    _, before, after = stages[3]
    plan = {r["doc_id"]: r for r in mixing.mix(before).collect()}
    rows = after.groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in rows} == {i: r["copies"] for i, r in plan.items() if r["copies"]}
    sizes, taken, largest = {}, {}, {}
    for r in plan.values():
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, target in brute.mix_targets(sizes).items():
        # sources of ten documents: within half of one of them
        assert abs(taken[s] - target) <= max(0.05 * target, largest[s] / 2)


def test_packing_stage(stages):
    from tokenizers import Tokenizer
    _, before, after = stages[4]
    tok, want = Tokenizer.from_file(tokenizer_path()), []
    for r in before.select("doc_id", "text").collect():
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        want += [(r["doc_id"], k // 2048, zlib.crc32(np.array(ids[k:k + 2048], "<u4").tobytes())) for k in range(0, len(ids), 2048)]
    got = after.collect()
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in got) == sorted(want)
    per = {}
    for r in got:
        per.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in per.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(per) <= 1.02 * -(-sum(r["length"] for r in got) // 2048) + 1


def test_workers_give_back_freed_memory(spark):
    """After a task that took and freed much, an idle worker holds little more than before."""
    from tickloom.llm.common import giving_back

    def held():
        with open("/proc/self/smaps_rollup") as f:
            return sum(int(line.split()[1]) for line in f if line.startswith("Pss_Anon")) // 1024

    def take(batches):
        import sys
        for b in batches:
            freed = [bytes(2000) for _ in range(100_000)]
            sys.kept_by_test = bytes(2000)      # outlives the task, above what is freed
            del freed
            yield b

    def ask(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_pydict({"mb": [held()]})

    one = spark.range(1).repartition(1)
    before = one.mapInArrow(ask, "mb long").first()[0]
    one.mapInArrow(giving_back(take), "id long").collect()
    assert one.mapInArrow(ask, "mb long").first()[0] < before + 60
