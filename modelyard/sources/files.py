"""Reading and writing of the saved artefacts."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelyard.operators.parameters import to_bfloat16
from modelyard.operators.synthetic import chat_rows

log = logging.getLogger(__name__)

SAMPLE = "id string, context string, question string, reference string, prediction string"
SYNTHETIC = "context string, question string, answer string, gap_cat string"
CANDIDATE = (
    "model_id string, downloads bigint, likes bigint, params_b double, pipeline_tag string, "
    "tags array<string>, score double, card_quality double, notes string, place int, category string"
)
EVAL_RESULT = (
    "model_id string, dataset string, n_samples bigint, avg_rouge1 double, avg_rouge2 double, "
    "avg_rougeL double, avg_bertscore double, avg_faithfulness double, hallucination_rate double, "
    "avg_judge_score double, gap_categories array<string>"
)
#: Saved results of others, and the summary lines of write_evaluation.
EVAL_FILES = "{eval_*.json,part-*.txt}"


def qa_samples(rows: DataFrame, n: int = 100) -> DataFrame:
    """First ``n`` rows by ``ord``, then without the unanswerable ones.

    Expects ``ord, context, question, answers array<string>``; the first answer is
    the reference and the row's index its id. The order-and-limit is a top-n: each
    task keeps n rows.
    """
    return (
        rows.orderBy("ord")
        .limit(n)
        .filter(F.size("answers") > 0)
        .select(
            F.col("ord").cast("string").alias("id"),
            "context",
            "question",
            F.get("answers", F.lit(0)).alias("reference"),
        )
    )


def read_custom_samples(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    """JSON lines, one sample each; unknown or missing keys fail the read.

    With ``n``, the first lines in file order are taken.
    """
    lines = spark.read.text(path)
    if n is not None:
        lines = (
            lines.select(
                "value",
                F.col("_metadata.file_path").alias("f"),
                F.col("_metadata.file_block_start").alias("b"),
                F.monotonically_increasing_id().alias("i"),
            )
            .orderBy("f", "b", "i")
            .limit(n)
            .select("value")
        )
    required = ["id", "context", "question", "reference"]
    keys = F.json_object_keys("value")
    known = F.array(*[F.lit(k) for k in [*required, "prediction"]])
    wanted = F.array(*[F.lit(k) for k in required])
    sound = (
        keys.isNotNull()
        & (F.size(F.array_except(keys, known)) == 0)
        & (F.size(F.array_except(wanted, keys)) == 0)
    )
    checked = F.when(F.coalesce(sound, F.lit(False)), F.col("value")).otherwise(
        F.raise_error(F.concat(F.lit("not a sample line: "), F.col("value")))
    )
    return lines.select(F.from_json(checked, SAMPLE).alias("s")).select(
        "s.id", "s.context", "s.question", "s.reference", F.coalesce("s.prediction", F.lit("")).alias("prediction")
    )


def read_synthetic(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SYNTHETIC).json(path)


def read_training_text(spark: SparkSession, path: str) -> DataFrame:
    """Saved synthetic rows with the ``text`` column that training needs."""
    return chat_rows(read_synthetic(spark, path))


def _is_object(document: Column) -> Column:
    """One JSON object; the parser takes the first of several, so those are told by form."""
    several = document.rlike(r"(?m)^\}\s*\{")
    kind = F.schema_of_variant(F.try_parse_json(document))
    return F.coalesce(kind.startswith("OBJECT") & ~several, F.lit(False))


def _documents(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Texts that should hold one JSON object each: the lines of a file, or all of it.

    A file whose first line is a whole object has one document per line; any other file is
    one document, over as many lines as it has. Files are read as lines in splits, so a large
    file of results is read by many tasks; each file's kind comes from its first line, found
    by one aggregation. Only the lines of a document of several lines are put together again.
    """
    lines = (
        spark.read.text(path, lineSep="\n", pathGlobFilter=glob, recursiveFileLookup=True)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("i")).alias("at"),
            "value",
        )
        .filter(F.trim("value") != "")
    )
    kinds = (
        lines.groupBy("file")
        .agg(F.min_by("value", "at").alias("head"))
        .select("file", F.col("head").rlike(r"^\s*\{.*\}\s*$").alias("by_line"))
    )
    told = lines.join(kinds, "file")
    whole = (
        told.filter(~F.col("by_line"))
        .groupBy("file")
        .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("rows"))
        .select(F.array_join(F.transform("rows", lambda r: r["value"]), "\n").alias("document"))
    )
    return told.filter("by_line").select(F.col("value").alias("document")).unionByName(whole)


def read_eval_results(spark: SparkSession, path: str, glob: str = EVAL_FILES) -> DataFrame:
    """All results below a folder, those of ``write_evaluation`` included.

    Unreadable documents are left out; ``unreadable_results`` counts them.
    """
    readable = _documents(spark, path, glob).filter(_is_object(F.col("document")))
    return readable.select(F.from_json("document", EVAL_RESULT).alias("r")).select("r.*")


def unreadable_results(spark: SparkSession, path: str, glob: str = EVAL_FILES) -> int:
    return _documents(spark, path, glob).filter(~_is_object(F.col("document"))).count()


def write_candidates(ranked: DataFrame, path: str) -> None:
    ranked.write.mode("overwrite").partitionBy("category").json(path)


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CANDIDATE).json(path)


def write_evaluation(summary: DataFrame, scores: DataFrame, path: str) -> None:
    """Summary and score rows by (model, dataset); a rerun replaces its own part only.

    A summary row is a line that holds the whole result, so its file reads without the
    folder names. The score rows stay rows below their own folder instead of one nested
    list, so an evaluation of any size is written by many tasks.
    """
    keys = ["model_id", "dataset"]
    whole = F.to_json(F.struct(*summary.columns)).alias("value")
    for rows, kind, name in (
        (summary.select(*keys, whole), "text", "summary"),
        (scores, "json", "sample_scores"),
    ):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys)
            .format(kind)
            .save(f"{path}/{name}")
        )


def write_synthetic(rows: DataFrame, path: str) -> None:
    rows.select("context", "question", "answer", "gap_cat").write.mode("overwrite").json(path)


def write_params(params: DataFrame, path: str) -> None:
    """Weights at bfloat16 precision, one folder per model so merges read only theirs."""
    (
        to_bfloat16(params)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model_id")
        .parquet(path)
    )


def save_params_table(params: DataFrame, table: str, buckets: int = 200) -> None:
    """Weights as a catalog table, bucketed and sorted by (tensor, chunk).

    Merges of such a table shuffle and sort no weights. ``buckets`` should leave a few
    hundred MB in each.
    """
    (
        to_bfloat16(params)
        .write.mode("overwrite")
        .bucketBy(buckets, "tensor", "chunk")
        .sortBy("tensor", "chunk")
        .format("parquet")
        .saveAsTable(table)
    )


def append_runs(runs: DataFrame, path: str) -> bool:
    """Append run records; a failing log is a warning, not the end of the run."""
    try:
        runs.write.mode("append").parquet(path)
        return True
    except Exception as err:
        log.warning("run log failed: %s", err)
        return False
