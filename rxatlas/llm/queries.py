"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxatlas.llm import common

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        common.prepare(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op5_minhash_neardup(spark, sf_dir):
    """Groups of near-duplicate documents over 4-word shingles."""
    from rxatlas.llm.minhash import near_duplicates
    found = near_duplicates(common.table(spark, sf_dir, "documents"), width=4, percent=80)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Default place of a vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op8_cost_packing(spark, sf_dir):
    """All documents packed into sequences of 4096 tokens."""
    from rxatlas.llm.packing import pack
    return pack(common.table(spark, sf_dir, "documents"), vocabulary())


@query
def op9_bpe_forced(spark, sf_dir):
    """Digests of every document's ids and of their decoding."""
    from rxatlas.llm.bpe import encode_digests
    return encode_digests(common.table(spark, sf_dir, "documents"), vocabulary())


@query
def op4_toxicity_kernel(spark, sf_dir):
    """Toxicity of every document."""
    from rxatlas.llm.toxicity import toxicity
    return toxicity(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


@query
def op6_language_bloom(spark, sf_dir):
    """Language of every document."""
    from rxatlas.llm.langid import language_of
    return language_of(common.table(spark, sf_dir, "documents"))


@query
def op2_host_reputation(spark, sf_dir):
    """Verdict on every page's url."""
    from rxatlas.llm.hosts import judge
    return judge(common.table(spark, sf_dir, "pages"), common.table(spark, sf_dir, "labels"))


@query
def op3_kneser_ney(spark, sf_dir):
    """log10 probability of every document."""
    from rxatlas.llm.ngram import language_model_scores
    return language_model_scores(common.table(spark, sf_dir, "documents"))


@query
def op7_multiset_hash(spark, sf_dir):
    """Fingerprints of every document and of its edited text."""
    from rxatlas.llm.fingerprint import fingerprints
    return fingerprints(common.table(spark, sf_dir, "documents"))


@query
def op1_nn_descent(spark, sf_dir):
    """Links and components of all embeddings."""
    from rxatlas.llm.neighbours import linked_vectors
    found, _ = linked_vectors(common.table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


@query
def op10_licence_scan(spark, sf_dir):
    """Licence families of every document."""
    from rxatlas.llm.licences import scan
    return scan(common.table(spark, sf_dir, "documents"))


@query
def op13_bloom_lines(spark, sf_dir):
    """Every document without the lines that at least five documents repeat."""
    from rxatlas.llm.lines import drop_repeated_lines
    found = drop_repeated_lines(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op11_exact_text_alignment(spark, sf_dir):
    """Alignment of two tokenizers on every document."""
    from rxatlas.llm.align import align_tokenizers
    found = align_tokenizers(common.table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


@query
def op12_vgram_variants(spark, sf_dir):
    """Near words and forms of all words that occur twice."""
    from rxatlas.llm.variants import count_words, group_variants
    words = count_words(common.table(spark, sf_dir, "documents"), least_chars=7, typos=31)
    return group_variants(words.where("n >= 2"), least_chars=7, ratio=10)
