"""One query per corpus operator over the whole documents table, and SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintlens.llm import bagminhash, bpe, dual_tree, exact_dedup, langid, lm_score, mixing, order_minhash, pii, runs, secret_scan, toxicity, word_bpe
from plaintlens.llm.common import table


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.held_out_scores(table(spark, sf_dir, "documents"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.classes(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hashed = docs.withColumn("text_sha256", F.sha2(exact_dedup.normalised("text"), 256))
    return exact_dedup.exact_groups(hashed, carry=["text_sha256"])


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def tokenizer() -> bpe.Tokenizer:
    return bpe.Tokenizer(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.tokenised(docs.select("doc_id", "text"), tokenizer().with_cache(docs)).drop("token_ids")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = word_bpe.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return word_bpe.tokenised(docs, words, ["n_tokens", "ids_sha256", "decoded_sha256"])


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", runs.repeated(F.col("text"), F.col("doc_id")).alias("text"))
    wanted = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    return runs.periodic_runs(docs, wanted)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_near_dedup": op2_near_dedup,
    "op3_personal_data": op3_personal_data,
    "op4_language": op4_language,
    "op5_mix_sources": op5_mix_sources,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_secrets": op7_secrets,
    "op8_bpe": op8_bpe,
    "op9_fingerprints": op9_fingerprints,
    "op10_toxicity": op10_toxicity,
    "op11_word_bpe": op11_word_bpe,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_ranked_search": op13_ranked_search,
}

#: A text's terms; the driver's SQL knows the same pattern.
TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{dual_tree.UPPER}', '{dual_tree.UPPER.lower()}'), '{dual_tree.TERM}')"

ORACLE = {
    "op6_exact_dedup": r"""
        with t as (
            select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents
        )
        select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
               doc_id = min(doc_id) over g as kept, sha256(norm) as text_sha256
        from t window g as (partition by norm)
    """,
    "op13_ranked_search": f"""
        with docs as (select row_number() over () as r, doc_id, {TERMS} as terms from documents),
        counted as (select r, doc_id, len(terms) as n from docs where len(terms) > 0),
        whole as (select count(*) as documents, cast(sum(n) as bigint) as length from counted),
        wanted as (select distinct item_id, unnest({TERMS}) as term from benchmark),
        freqs as (
            select r, term, count(*) as tf from (select r, unnest(terms) as term from docs)
            where term in (select term from wanted) group by all),
        weights as (
            select term, cast(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) as bigint) as w
            from freqs, whole group by term),
        parts as (
            select r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * documents) // length))) as part
            from freqs join counted using (r) join weights using (term), whole),
        scores as (
            select item_id, doc_id, r, cast(sum(part) as bigint) as score
            from wanted join parts using (term) group by all having sum(part) > 0),
        placed as (
            select *, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as int) as rank
            from scores)
        select item_id, rank, doc_id, score from placed where rank <= 50
    """,
}
