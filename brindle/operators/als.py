"""Alternating least squares on indexed ratings: fit, tune, store, score, top-k."""

from __future__ import annotations

from itertools import product

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.scores import dot
from brindle.operators.aggregates import rmse
from brindle.operators.factor_table import FactorTable
from brindle.operators.joins import broadcast_join
from brindle.operators.top_products import item_blocks as top_products_blocks
from brindle.operators.top_products import top_products

#: Ratings in a block of users or items; iterations exchange data between all pairs of blocks.
BLOCK_RATINGS = 2_000_000

# Default hyper-parameters, retry threshold and grid.
DEFAULTS = {"rank": 10, "regParam": 0.1, "maxIter": 10, "seed": 42}
TUNE_ABOVE = 1.5
GRID = {"rank": [10, 20], "regParam": [0.05, 0.1], "maxIter": [10, 15]}


def fit(train: DataFrame, *, rating: str = "overall", **params) -> ALSModel:
    """Explicit, non-negative ALS; users or items unseen in training get no prediction."""
    blocks = max(10, -(-train.count() // BLOCK_RATINGS))
    params = {**DEFAULTS, "numUserBlocks": blocks, "numItemBlocks": blocks, **params}
    return ALS(userCol="user_id", itemCol="item_id", ratingCol=rating, nonnegative=True,
               implicitPrefs=False, coldStartStrategy="drop", **params).fit(train)


def holdout_error(model: ALSModel, test: DataFrame, rating: str = "overall") -> float:
    """RMSE over the test rows the model can predict; infinite if there are none."""
    error = rmse(model.transform(test), rating, "prediction").first()[0]
    return float("inf") if error is None else error


def fit_tuned(train: DataFrame, test: DataFrame, *, rating: str = "overall",
              tune_above: float = TUNE_ABOVE, grid: dict | None = None):
    """Fit the defaults; search the grid only if their error is too high.

    Returns (model, rmse, params). The first of equally good settings is kept.
    """
    model = fit(train, rating=rating)
    error, params = holdout_error(model, test, rating), dict(DEFAULTS)
    if error <= tune_above:
        return model, error, params
    grid = grid or GRID
    best = None
    for values in product(*grid.values()):
        candidate = dict(zip(grid, values))
        model = fit(train, rating=rating, **candidate)
        error = holdout_error(model, test, rating)
        if best is None or error < best[1]:
            best = (model, error, candidate)
    return best


def save_artifacts(model: ALSModel, users: DataFrame, items: DataFrame, path: str) -> None:
    """Store model, factors and dictionaries below ``path``, replacing older ones.

    User factors are a :class:`FactorTable`, so that a batch of users is looked up without reading all of them.
    """
    model.write().overwrite().save(f"{path}/model")
    FactorTable.write(model.userFactors, f"{path}/user_factors")
    for name, table in (("item_factors", model.itemFactors), ("user_index", users), ("item_index", items)):
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def load_model(path: str) -> ALSModel:
    """The model stored by :func:`save_artifacts`."""
    return ALSModel.load(f"{path}/model")


def model_from_factors(user_factors: DataFrame, item_factors: DataFrame, rank: int) -> ALSModel:
    """Scoring model over stored factor tables (id int, features array<float>)."""
    jvm = user_factors.sparkSession._jvm
    scorer = jvm.org.apache.spark.ml.recommendation.ALSModel(
        "stored_factors", rank, user_factors._jdf, item_factors._jdf)
    scorer.setUserCol("user_id").setItemCol("item_id").setPredictionCol("prediction")
    return ALSModel(scorer)


def score_pairs(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame, *,
                out: str = "score") -> DataFrame:
    """Factor product for given (user_id, item_id) pairs; unknown ids are dropped."""
    users = user_factors.select(F.col("id").alias("user_id"), F.col("features").alias("__u"))
    items = item_factors.select(F.col("id").alias("item_id"), F.col("features").alias("__i"))
    joined = broadcast_join(broadcast_join(pairs, users, "user_id"), items, "item_id")
    return joined.withColumn(out, dot(F.col("__u"), F.col("__i"))).drop("__u", "__i")


def top_k(model: ALSModel, users: DataFrame, k: int, exclude: DataFrame | None = None,
          blocks: DataFrame | None = None, factors: DataFrame | None = None) -> DataFrame:
    """The ``k`` best items per known user: (user_id, rank, item_id, score).

    ``exclude`` (user_id, item_id) is removed before ranking, whatever its size. ``blocks`` are the model's
    :func:`item_blocks`; without them they are made anew. ``factors`` are those of ``users`` (user_id, features), where
    they have been looked up already; without them all user factors of the model are read.
    """
    if factors is None:
        wanted = users.select("user_id").distinct().where("user_id is not null")
        factors = model.userFactors.select(F.col("id").alias("user_id"), "features").join(wanted, "user_id", "left_semi")
    return top_products(factors, item_blocks(model) if blocks is None else blocks, k, exclude)


def item_blocks(model: ALSModel, path: str | None = None) -> DataFrame:
    """The model's items in blocks for :func:`top_k`: stored once, used for every batch of users."""
    return top_products_blocks(model.itemFactors, path=path)
