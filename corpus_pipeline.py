"""A training corpus from ``documents``. Each stage takes (spark, docs, sf_dir),
works on all that its predecessor kept, and is written and read again before
the next; all but the last return the columns of ``documents``.

Defined results: a null text counts as empty in every stage. Empty texts score by
the classifier's bias; those it accepts are equal, so one of them stays, and it has
no shingles and no words. Without a usable label nothing is rejected. Of repeated
rows (equal id and text) one stays in exact dedup; rows of equal id and different
text are one group in near-dedup. A null id sorts below any other. A null source is
a source, the last. An empty table gives empty stages. Extra columns pass through
all stages but the last, whatever their names; the last has those of its pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import exact, mixing, near, packing, quality
from tickloom.llm.common import staged, table
from tickloom.llm.queries import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays."""
    return exact.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id."""
    return near.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: none, one or two rows."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents with their places in sequences."""
    return packing.pack(docs, tokenizer_path(), keep=["doc_id", "source"])


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Not SQL-expressible (a trained classifier and a tokenizer decide); tests/llm
#: compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.lower().replace(" ", "-"))
    return docs
