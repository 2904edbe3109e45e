"""The best models per keyword, kept up to date from changes of the registry.

State of a keyword: its best ``keep`` models, and a floor once models were cut off. Whatever
is not in the state is worse than the floor; so the first n rows are exact as long as there
are n of them, or nothing was ever cut. A change (a model that is new, different or gone)
replaces the model's rows; what a change puts below the floor is left out, as unknown models
may be better. States over parts of a registry merge. Only a keyword that lost so many models
that fewer than n remain above its floor is ``short`` and is read again from the registry.

Rows are those of ``discovery.matching_keywords`` (category, kw_ord, keyword, model columns).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelyard import constants as K
from modelyard.session import written

WORD = ["category", "kw_ord"]
KEEP = 2 * K.PER_KEYWORD


@dataclass
class State:
    rows: DataFrame  # at most ``keep`` per keyword
    floors: DataFrame  # category, kw_ord, floor; keywords nothing was cut from are absent
    keep: int = KEEP

    def save(self, path: str) -> None:
        self.rows.write.mode("overwrite").parquet(f"{path}/rows")
        self.floors.write.mode("overwrite").parquet(f"{path}/floors")

    @staticmethod
    def load(spark, path: str, keep: int = KEEP) -> State:
        return State(spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/floors"), keep)


def _place() -> Column:
    """Ascending from the best: more downloads first, then the id."""
    return F.struct(-F.coalesce("downloads", F.lit(0)).alias("d"), F.col("model_id").alias("id"))


def _cut(rows: DataFrame, floors: DataFrame, keep: int) -> State:
    """The best ``keep`` rows that are not below the floor, and the floors after the cut."""
    order = W.partitionBy(*WORD).orderBy(_place())
    known = rows.join(floors, WORD, "left").filter(F.col("floor").isNull() | (_place() <= F.col("floor"))).drop("floor")
    # at most keep + 1 rows per keyword, written because rows, floors and the next state read them
    ranked = written(
        known.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= keep + 1), "registry-state"
    )
    full = (
        ranked.filter(F.col("_rank") >= keep)
        .groupBy(*WORD)
        .agg(F.count("*").alias("n"), F.min(_place()).alias("floor"))
        .filter("n > 1")
        .select(*WORD, "floor")
    )
    low = floors.unionByName(full).groupBy(*WORD).agg(F.min("floor").alias("floor"))
    return State(ranked.filter(F.col("_rank") <= keep).drop("_rank"), low, keep)


def state_of(hits: DataFrame, keep: int = KEEP) -> State:
    """From a full scan: every (keyword, model) that matches."""
    none = hits.select(*WORD, _place().alias("floor")).limit(0)
    return _cut(hits, none, keep)


def updated(state: State, changed: DataFrame, hits: DataFrame) -> State:
    """After a change: ``changed`` has the ids of all models that are new, different or gone,
    ``hits`` the keyword matches of those that exist now."""
    stay = state.rows.join(changed.select("model_id").distinct(), "model_id", "left_anti")
    return _cut(stay.unionByName(hits), state.floors, state.keep)


def merged(one: State, other: State) -> State:
    """State over two parts of a registry that share no model."""
    floors = one.floors.unionByName(other.floors).groupBy(*WORD).agg(F.min("floor").alias("floor"))
    return _cut(one.rows.unionByName(other.rows), floors, min(one.keep, other.keep))


def short(state: State, n: int = K.PER_KEYWORD) -> DataFrame:
    """Keywords (category, kw_ord) whose first n rows the state no longer knows."""
    counts = state.rows.groupBy(*WORD).agg(F.count("*").alias("n"))
    return state.floors.join(counts, WORD, "left").filter(F.coalesce("n", F.lit(0)) < n).select(*WORD)


def refreshed(state: State, hits: DataFrame, n: int = K.PER_KEYWORD) -> State:
    """The state with its short keywords taken from ``hits``, a scan of the whole registry."""
    gone = short(state, n)
    anew = state_of(hits.join(gone, WORD, "left_semi"), state.keep)
    return State(
        state.rows.join(gone, WORD, "left_anti").unionByName(anew.rows),
        state.floors.join(gone, WORD, "left_anti").unionByName(anew.floors),
        state.keep,
    )


def top(state: State, n: int = K.PER_KEYWORD) -> DataFrame:
    """The first n rows per keyword with their rank; of keywords that are not short."""
    order = W.partitionBy(*WORD).orderBy(_place())
    known = state.rows.join(short(state, n), WORD, "left_anti")
    return known.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
