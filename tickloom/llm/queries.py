"""The contract's queries: thin layers that apply an operator to its whole
table and derive the digest columns from what it returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import (
    chat, exact, mixing, near, packing, pii, quality, rules, search, shards, substrings, tokencount, trie)
from tickloom.llm.common import staged, table, text_of


TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where a public tokenizer's file lies on this machine (every worker has it)."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.extract(table(spark, sf_dir, "documents"), ["doc_id"])
    count = {k: F.size(pii.of_kind("base", k)).cast("long").alias(f"n_{k}") for k in pii.KINDS}
    return out.select("doc_id", *count.values(), F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
                      pii.joined(F.col("spans")).alias("spans"))


def op2_pack_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), keep=["doc_id"])


def op3_mix_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_shard_minimax(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = shards.shard(docs.withColumn("text_crc32", F.crc32(text_of())))
    return out.select("doc_id", "size", "text_crc32", F.lit(shards.LAW).alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op5_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    out = quality.score(docs, weights)
    return out.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


#: Conversation -7 of the contract: control strings inside texts.
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op6_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    steps = staged(chat.expand(turns.unionByName(probe)), "op6-steps")      # read twice by whole
    return chat.read_examples(chat.whole(steps))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = exact.exact_groups(docs.withColumn("text_sha256", F.sha2(text_of(), 256)))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_near_dedup_bbit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_rules_risk_controlled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    out = rules.judge(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


def op10_suffix_blockwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("whole_sha256", F.sha2(text_of(), 256))
    rows, spans = substrings.repeats(docs, ["doc_id", "whole_sha256"])
    cut = substrings.kept_bytes(docs, spans, rows).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    none = F.lit(0).cast("long")
    return rows.join(cut, "_b_th", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"))


def op11_token_counts_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.token_counts(docs, tokenizer_path())


def op12_trie_truncation_peeling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"))


def op13_search_bag_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_pii_bootstrap, op2_pack_best_two_fit, op3_mix_entropy, op4_shard_minimax, op5_quality_ftrl, op6_chat_prefix_targets,
    op7_exact_dedup, op8_near_dedup_bbit, op9_rules_risk_controlled, op10_suffix_blockwise, op11_token_counts_ranks,
    op12_trie_truncation_peeling, op13_search_bag_dedup)}

SQL: dict[str, str] = {
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    # the unsigned CRC-32 of the id's digits, bit by bit; a node's subtree by pairs of prefixes
    "op12_trie_truncation_peeling": """
        WITH src AS (
          SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
          FROM conversations WHERE conv_id IS NOT NULL),
        crc AS (
          SELECT conv_id, conv_id - conv_id % 100 AS base,
                 list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''),
                                                                             lambda c: ascii(c)::BIGINT)),
                   lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                     lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)) AS raw
          FROM (SELECT DISTINCT conv_id FROM src)),
        ids AS (SELECT conv_id, base, xor(raw, 4294967295) % 6 AS h FROM crc),
        rebuilt AS (
          SELECT i.conv_id, pos, role, text FROM ids i JOIN src s ON s.conv_id = i.conv_id
          WHERE pos > h OR i.conv_id = base
          UNION ALL
          SELECT i.conv_id, pos, role, text FROM ids i JOIN src s ON s.conv_id = base
          WHERE pos <= h AND i.conv_id <> base),
        chain AS (
          SELECT conv_id, row_number() OVER w AS depth, length(text) AS chars,
                 sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w) AS node
          FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
          UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
        member AS (
          SELECT *, lag(node) OVER w AS parent, depth = max(depth) OVER (PARTITION BY conv_id) AS last
          FROM chain WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
        nodes AS (
          SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars,
                 string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last) AS ended
          FROM member GROUP BY node, depth),
        kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
        under AS (
          SELECT DISTINCT a.node, b.node AS below FROM member a JOIN member b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
        sums AS (
          SELECT u.node, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((n - 1) * chars)::BIGINT AS saved_tokens
          FROM under u JOIN nodes b ON b.node = u.below LEFT JOIN kids k ON k.node = u.below GROUP BY u.node)
        SELECT x.conv_id, x.depth, p.conv_id AS parent_conv_id, x.n AS n_convs, coalesce(n_children, 0) AS n_children,
               n_leaves, saved_tokens, sha256(coalesce(x.ended, '')) AS ends_sha256
        FROM nodes x JOIN sums s ON s.node = x.node LEFT JOIN kids k ON k.node = x.node
        LEFT JOIN nodes p ON p.node = x.parent AND x.depth > 0""",
    "op13_search_bag_dedup": r"""
        WITH words AS (
          SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
        len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
        total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM len),
        norm AS (SELECT doc_id, 75 + (25 * n * docs) // terms AS m FROM len, total),
        weight AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
                   FROM tf, total GROUP BY term, docs),
        asked AS (
          SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        scored AS (
          SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
          FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN norm USING (doc_id) GROUP BY ALL)
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 20""",
}
