"""Registered queries of the training-data operators, each over its whole table, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from coldspot.llm import bestfit, bpe, langid, neardup, packing, quality, secrets, sharding, spelling, tokencount, topk, toxicity, turntrie
from coldspot.llm.common import stored, table, tokenizer_path


def op1_quality_rules(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return quality.assess(documents, quality.train(documents, table(spark, sf_dir, "labels")))


def op2_language_id(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return langid.predict(documents, langid.train(documents))


def op3_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    found = stored(secrets.candidates(documents), "secret-candidates")
    language, forest = secrets.fit(documents, table(spark, sf_dir, "pages"), found)
    return secrets.scan(documents, language, forest, found=found)


def op6_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


def op7_minhash_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark, sf_dir):
    import public_tokenizers

    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(encoded, path))


def op9_token_counts(spark, sf_dir):
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op10_exact_topk(spark, sf_dir):
    vectors = topk.quantise(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.search(vectors.where("vec_id % 50 = 0"), vectors, k=5)


def op11_spelling_variants(spark, sf_dir):
    return spelling.group(table(spark, sf_dir, "documents"))


def op12_best_fit_packing(spark, sf_dir):
    return bestfit.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op13_conversation_trie(spark, sf_dir):
    return turntrie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_language_id, op3_packing, op4_sharding, op5_secret_scan, op6_toxicity,
    op7_minhash_near_dedup, op8_byte_bpe, op9_token_counts, op10_exact_topk, op11_spelling_variants, op12_best_fit_packing,
    op13_conversation_trie)}

ORACLE_SQL: dict[str, str] = {
    "op4_sharding": sharding.oracle_sql(), "op7_minhash_near_dedup": neardup.ORACLE_SQL,
    "op10_exact_topk": topk.ORACLE_SQL, "op11_spelling_variants": spelling.ORACLE_SQL,
    "op13_conversation_trie": turntrie.ORACLE_SQL}
