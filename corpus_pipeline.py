"""From raw documents to encoded training rows, one stage after the other.

Every stage reads what its predecessor kept; decisions take effect: a document that a stage
rejects is gone for the later ones. All stages but the last return the columns of
documents. Nulls, empty texts and repeated rows are treated as each operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelyard.llm import jaccard_join, mixing, pii, piece_encoding, quality_rules
from modelyard.llm.queries import tokenizer_model
from modelyard.llm.text import free_name
from modelyard.session import new_shared_path, settled
from modelyard.sources.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules keep."""
    return quality_rules.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of copies and near copies; the least id stays.

    A document is an id and its text: texts that share an id are documents of their own, and
    rows that repeat both are one. A row with a null id is nobody's copy and stays.
    """
    named = docs.filter(F.col("doc_id").isNotNull())
    hashes = [F.xxhash64(F.lit(k), "text").alias(free_name(docs, f"text_hash{k}")) for k in (1, 2)]
    texts = named.select("doc_id", F.struct(*hashes).alias("text_key"))
    ambiguous = texts.groupBy("doc_id").agg(F.min("text_key").alias("a"), F.max("text_key").alias("b")).filter("a <> b")
    id_col = "doc_id"
    if not ambiguous.isEmpty():  # the join needs an id per document: number them in the order of doc_id
        id_col = free_name(docs, "document_no")
        known = [free_name(docs, x) for x in ("known_id", "known_hash1", "known_hash2")]
        numbers = settled(
            named.select(F.col("doc_id").alias(known[0]), *[h.alias(x) for h, x in zip(hashes, known[1:])])
            .distinct()
            .orderBy(*known)
            .withColumn(id_col, F.monotonically_increasing_id())
        )
        keyed = named.select("*", *hashes)
        same = [F.col(a) == F.col(b) for a, b in zip(["doc_id", *keyed.columns[-2:]], known)]
        named = keyed.join(numbers, same).select(*docs.columns, id_col)
    # the join passes keys only; the texts are shuffled once, by the key that also finds repeated rows
    ids = jaccard_join.join(named.select(id_col, "text"), id_col).filter("kept").select(id_col).distinct()
    kept = named.join(ids, id_col, "left_semi").dropDuplicates([id_col])
    return kept.select(*docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the kind's name."""
    return pii.mask(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their source ask for."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids and n_tokens of every row."""
    rows = piece_encoding.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_model())
    return rows.drop("decoded").withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("pii", personal_data),
    ("mixing", mixture),
    ("piece_encoding", encoded),
]

#: Label model, sampled paths and the shuffled schedule have no SQL form; tests/llm checks
#: every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
