"""Model calls that are paid for once: replies kept by the content of their prompt.

A reply table is a folder of rows (key, model, reply), the key being the sha256 of the model's
name and the prompt. A call reads it, asks for the prompts it lacks, each distinct one once,
and appends the replies in waves; a run that is killed keeps the waves it finished. The
rows are computed once to find what is unseen, and once more for the result. Runs may
append to one table at the same time: at worst a prompt is asked twice, and the least of its
replies counts from then on. Failed calls are not kept, so the next run asks again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelyard.operators.scoring import Model, batched_call
from modelyard.session import written

STORED = "key string, model string, reply string"
WAVES = 8


def prompt_key(model: str, prompt: Column) -> Column:
    """Null for a null prompt. The length keeps (model, prompt) pairs apart."""
    return F.sha2(F.concat(F.lit(f"{len(model)}:{model}:"), prompt), 256)


def stored_replies(spark: SparkSession, path: str) -> DataFrame:
    """Key and reply of everything asked so far; creates the table if there is none."""
    spark.createDataFrame([], STORED).write.mode("ignore").parquet(path)
    return spark.read.schema(STORED).parquet(path).groupBy("key").agg(F.min("reply").alias("reply"))


def looked_up(rows: DataFrame, prompt: str, model: str, path: str) -> DataFrame:
    """Distinct prompts (key, stored, prompt); stored and prompt are null where the other is not."""
    asked = rows.select(prompt_key(model, F.col(prompt)).alias("key"), F.col(prompt).alias("prompt"))
    return (
        asked.filter(F.col("prompt").isNotNull())
        .dropDuplicates(["key"])
        .join(stored_replies(rows.sparkSession, path).select("key", F.lit(True).alias("stored")), "key", "left")
        .select("key", "stored", F.when(F.col("stored").isNull(), F.col("prompt")).alias("prompt"))
    )


def remembered_call(
    rows: DataFrame,
    prompt: str,
    output: str,
    make: Model,
    model: str,
    path: str,
    batch_size: int = 4,
    waves: int = WAVES,
) -> DataFrame:
    """rows with the reply to their prompt, like ``batched_call``; stored replies are not asked for.

    ``model`` names the model and its settings. A wave is a slice of the keys, so each wave's
    prompts spread over all tasks; its replies are appended when all of them are there.
    """
    spark = rows.sparkSession
    prompts = written(looked_up(rows, prompt, model, path), "prompts")
    todo = prompts.filter(F.col("stored").isNull()).select("key", "prompt")
    if not todo.isEmpty():
        for wave in range(waves):
            # the table's files lie by a hash of the key, so every task reads its share of a wave
            part = todo.filter(F.pmod(F.xxhash64("key"), F.lit(waves)) == wave)
            replies = batched_call(part, "prompt", "reply", make, batch_size)
            (
                replies.filter(F.col("reply").isNotNull())
                .select("key", F.lit(model).alias("model"), "reply")
                .write.mode("append")
                .parquet(path)
            )
    # written, so that the join is one of plain shuffles and a prompt of very many rows is split,
    # as are rows without a prompt
    known = written(
        stored_replies(spark, path)
        .join(prompts.select("key"), "key", "left_semi")
        .withColumnRenamed("reply", "_reply"),
        "known-replies",
    )
    keyed = rows.withColumn("_key", prompt_key(model, F.col(prompt)))
    columns = [F.col(f"`{c}`") for c in rows.columns if c != output]
    return keyed.join(known, F.col("_key") == F.col("key"), "left").select(*columns, F.col("_reply").alias(output))
