"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxatlas.llm import common
from rxatlas.llm.langid import identify, learn as learn_languages
from rxatlas.llm.minhash import near_duplicates
from rxatlas.llm.packing import pack
from rxatlas.llm.queries import vocabulary
from rxatlas.llm.toxicity import learn as learn_toxicity, score as score_toxicity

COLUMNS = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}
#: Share of a text's letter n-grams that its language must hold.
LANGUAGE_SCORE = 0.3
TOXIC_SCORE = 0.5


def _documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    common.prepare(spark)
    return common.columns(docs, **COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognised language: no letter, null or empty
    text, or n-grams that no learned language holds. Learns from rows with a
    lang; without any, all rows go. Rows are judged one by one, null and repeated
    ids among them."""
    d = _documents(spark, docs)
    filters = learn_languages(d.where(common.fold("doc_id", 5) != 0))
    found = identify(d, filters, "text", "lang", "source", "n_chars")
    keep = F.col("lang_pred") != "und"
    return found.where(keep & (F.col("lang_score") >= LANGUAGE_SCORE)).select(*COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic. Learns from the table of labels.
    Rows are judged one by one, null and repeated ids among them; null and empty
    texts have nothing toxic; without labels nothing goes; an empty table stays
    empty."""
    d = _documents(spark, docs)
    labels = common.columns(common.table(spark, sf_dir, "labels"), doc_id="long", toxic="int")
    labels = labels.where(common.fold("doc_id", 5) != 0)
    model = learn_toxicity(d.select("doc_id", "text"), labels)
    found = score_toxicity(d, model, "text", "lang", "source", "n_chars")
    return found.where(F.col("toxic_score") < TOXIC_SCORE).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id, of each group of near
    duplicates (five-word shingles, similarity 0.8); of rows that share an id the
    one with the smallest text (null first), then lang, source and n_chars. Rows
    without an id belong to no group and stay; null and empty texts are near
    nothing; an empty table stays empty."""
    d = _documents(spark, docs)
    groups = near_duplicates(d, width=5, percent=80)
    kept = groups.where("doc_id = component_id").select("doc_id")
    stay = d.join(kept, "doc_id", "left_semi")
    rest = [c for c in COLUMNS if c != "doc_id"]
    stay = stay.groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("r")).select("doc_id", *[F.col("r")[c].alias(c) for c in rest])
    return stay.union(d.where("doc_id is null").select("doc_id", *rest)).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 4096 tokens; one row per piece. A
    null or empty text is its end id alone; repeated rows are packed as often as
    they occur; an empty table gives no piece."""
    return pack(_documents(spark, docs), vocabulary())


STAGES = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("minhash_near_dedup", near_duplicate_stage),
    ("packing", packing_stage),
]

#: Language filters, the kernel machine and the tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written and read again."""
    common.prepare(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
