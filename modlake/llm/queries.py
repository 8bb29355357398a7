"""The registered queries of these operators, and their SQL where SQL can express them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modlake.llm.mixing import sql as mixing_sql
from modlake.llm.sql import OP11_SQL, OP12_SQL, OP13_SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modlake.llm.lm_scoring import score

    return score(table(spark, sf_dir, "documents"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modlake.llm.simhash_dedup import hex_fingerprint, near_components

    found = near_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def tokenizer(name: str) -> str:
    """The place of a tokenizers file; the vocabulary itself is no part of this library."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modlake.llm.packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modlake.llm.token_store import read_tokens, write_tokens

    manifest = write_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return read_tokens(spark, manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modlake.llm.preference import format_preferences, paired_with_next_answered

    out = format_preferences(paired_with_next_answered(table(spark, sf_dir, "conversations")))
    trained = lambda mask: F.aggregate(F.filter(mask, lambda m: m["trained"]), F.lit(0).cast("long"), lambda n, m: n + m["length"])
    return out.select(
        F.col("pair_id").alias("conv_id"), F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"),
        *[F.sha2(c, 256).alias(f"{c}_sha256") for c in ("prompt", "chosen", "rejected")],
        trained("chosen_mask").alias("chosen_trained"), trained("rejected_mask").alias("rejected_trained"),
    )


#: Turns of a conversation in the given table are unique and not null; the operator does not need that.
OP5_SQL = """
WITH last AS (SELECT conv_id, max(turn) AS last_turn, arg_max(coalesce(text, ''), turn) AS answer FROM conversations WHERE role = 'assistant' AND conv_id IS NOT NULL GROUP BY conv_id),
pairs AS (SELECT conv_id, last_turn, answer, coalesce(lead(answer) OVER (ORDER BY conv_id), first_value(answer) OVER (ORDER BY conv_id)) AS other FROM last),
turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS c, CASE WHEN turn = last_turn AND role = 'assistant' THEN other ELSE coalesce(text, '') END AS r,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations JOIN pairs USING (conv_id)),
cut AS (SELECT conv_id, coalesce(min(k) FILTER (WHERE c <> r) - 1, count(*)) AS n FROM turns GROUP BY conv_id),
shown AS (SELECT t.*, n, '<|' || role || '|>' || chr(10) || c || '<|end|>' || chr(10) AS cs, '<|' || role || '|>' || chr(10) || r || '<|end|>' || chr(10) AS rs FROM turns t JOIN cut USING (conv_id))
SELECT conv_id, any_value(n)::BIGINT AS n_prompt_turns,
    sha256(coalesce(string_agg(cs, '' ORDER BY k) FILTER (WHERE k <= n), '')) AS prompt_sha256,
    sha256(coalesce(string_agg(cs, '' ORDER BY k) FILTER (WHERE k > n), '')) AS chosen_sha256,
    sha256(coalesce(string_agg(rs, '' ORDER BY k) FILTER (WHERE k > n), '')) AS rejected_sha256,
    coalesce(sum(length(c) + 8) FILTER (WHERE k > n AND role = 'assistant'), 0)::BIGINT AS chosen_trained,
    coalesce(sum(length(r) + 8) FILTER (WHERE k > n AND role = 'assistant'), 0)::BIGINT AS rejected_trained
FROM shown GROUP BY conv_id
"""


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modlake.llm.quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modlake.llm.mixing import mix

    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"), F.round("weight", 6).alias("weight"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modlake.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP6_SQL = """
WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modlake.llm.fingerprints import compare_with_edits, near_groups
    from modlake.llm.simhash_dedup import hex_fingerprint

    compared = compare_with_edits(table(spark, sf_dir, "documents"))
    grouped = compared.join(near_groups(compared.select("doc_id", "fp")), "fp")
    return grouped.select(
        "doc_id", "n_chars", "edited_sha256", hex_fingerprint(F.col("fp")).alias("fingerprint"),
        hex_fingerprint(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next", "class_id",
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modlake.llm.line_dedup import drop_repeated_lines

    out = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP10_SQL = """
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT r, doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line FROM rows),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT keyed.*, coalesce(doc_id <> keeper, false) AS gone FROM keyed LEFT JOIN common USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modlake.llm.divergence import divergence

    return divergence(table(spark, sf_dir, "documents"))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modlake.llm.lattice import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modlake.llm.line_dedup import LOWER, UPPER
    from modlake.llm.merkle import fold, hex_of, leaf_of, manifest, proof_digest

    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = leaf_of([*map(F.col, fields[:-1]), F.translate("text", UPPER, LOWER)])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, lowered)
    out = manifest(table(spark, sf_dir, "documents"), fields, "lang", "doc_id", keep={"tampered": tampered})
    out = out.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return out.select(
        "doc_id", hex_of(F.col("leaf")).alias("leaf"), "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_packing": op3_packing,
    "op4_token_store": op4_token_store,
    "op5_preference_format": op5_preference_format,
    "op6_top_k": op6_top_k,
    "op7_quality": op7_quality,
    "op8_mixing": op8_mixing,
    "op9_fingerprints": op9_fingerprints,
    "op10_line_dedup": op10_line_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES = {
    "op5_preference_format": OP5_SQL,
    "op8_mixing": mixing_sql(),
    "op6_top_k": OP6_SQL,
    "op10_line_dedup": OP10_SQL,
    "op11_source_divergence": OP11_SQL,
    "op12_embedding_dedup": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
