"""Exact top-k of factor products without scoring all pairs.

Items lie in blocks, sorted by the length of their vectors, longest first. A user meets the blocks in that order and
keeps the k best items so far. No product with an item of a block is larger than the user's length times the
block's longest: once that is below the user's k-th score, this block and all later ones are left out. Users are dealt
into blocks too, so that a pair of blocks is one matrix product inside a task.

The blocks go out in waves of a bounded size, each by a broadcast hash join on the block's number; only users whose
bound still allows a better item meet the next wave.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.operators.ordering import dense_ids
from brindle.operators.windows import top_per_group
from brindle.session import arrow_rows, as_table, scratch_owner, scratch_path

#: Items and users of a block, bytes of items that are broadcast at once, pairs of blocks that a task gets at once.
ITEMS, USERS, WAVE_BYTES, AT_ONCE = 4096, 512, 64 << 20, 8


def _length(vector: str) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double")))


def item_blocks(item_factors: DataFrame, items: int = ITEMS, path: str | None = None) -> DataFrame:
    """Stored blocks (block, longest, ids, factors, rank) of factors (id, features), longest vectors first.

    Make them once for a model and pass them to :func:`top_products` as often as it is asked. They are stored
    below ``path``, replacing older ones, or else as a scratch table.
    """
    spark = item_factors.sparkSession
    sized = item_factors.where("id is not null and features is not null").select(
        "id", "features", _length("features").alias("length"))
    path = path or scratch_path(spark, "item-blocks")
    with scratch_owner(spark):  # what the numbering writes on the way goes
        numbered = dense_ids(sized, F.col("length").desc(), "id", out="at")
        blocks = numbered.groupBy(F.floor(F.col("at") / items).cast("int").alias("block")).agg(
            F.max("length").alias("longest"), F.collect_list(F.struct("id", "features")).alias("own"))
        blocks = blocks.select("block", "longest", F.col("own.id").alias("ids"), F.flatten("own.features").alias("factors"),
                               F.size(F.col("own.features")[0]).alias("rank"))
        blocks.write.mode("overwrite").parquet(path)
    return spark.read.schema(blocks.schema).parquet(path)


def top_products(users: DataFrame, blocks: DataFrame, k: int, exclude: DataFrame | None = None, *,
                 users_in_block: int = USERS, wave_bytes: int = WAVE_BYTES, scored=None) -> DataFrame:
    """The ``k`` items with the largest product for each user: (user_id, rank, item_id, score).

    ``users`` has distinct user_id and features, ``blocks`` comes from :func:`item_blocks`, ``exclude`` (user_id,
    item_id) is left out before ranking, whatever its size. Equal scores go by item_id; users have fewer items only
    if there are fewer. ``scored``, an accumulator, counts the pairs of a user and a block that were multiplied.
    """
    spark = users.sparkSession
    shape = blocks.agg(F.count(F.lit(1)), F.max("rank"), F.max(F.size("ids"))).first()
    many, rank, largest = shape
    ddl = "user_id long, item_id long, score double"
    if not many:
        return spark.createDataFrame([], "user_id int, rank int, item_id int, score double")
    users = users.where("user_id is not null and features is not null").select("user_id", "features")
    if exclude is None:
        users = users.withColumn("gone", F.array().cast("array<long>"))
    else:
        gone = exclude.groupBy("user_id").agg(F.collect_set(F.col("item_id").cast("long")).alias("gone"))
        users = users.join(gone, "user_id", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<long>")))
    users = users.withColumn("length", _length("features"))
    per_wave = max(1, wave_bytes // (largest * (4 * rank + 8)))
    if many > per_wave:
        users = as_table(users, "asking-users")

    def work(batches):
        import numpy as np
        import pyarrow as pa

        def flat(column, i, kind):
            return column.slice(i, 1).flatten().to_numpy(zero_copy_only=False).astype(kind)

        def rows(state):
            if state is None:
                return pa.RecordBatch.from_pydict({"user_id": pa.array([], pa.int64()), "item_id": pa.array([], pa.int64()),
                                                   "score": pa.array([], pa.float64())})
            _, names, _, _, _, scores, ids = state
            found = np.isfinite(scores)
            return pa.RecordBatch.from_pydict({"user_id": np.repeat(names, found.sum(axis=1)), "item_id": ids[found],
                                               "score": scores[found]})

        def begin(number, own):
            users = own.slice(0, 1).flatten()
            names, length = users.field("user_id").to_numpy(), users.field("length").to_numpy()
            vectors = users.field("features").flatten().to_numpy().astype(np.float64).reshape(len(names), -1)
            gone = users.field("gone")
            owner = np.repeat(np.arange(len(names)), np.diff(gone.offsets.to_numpy()))
            left_out = (owner, gone.flatten().to_numpy())
            return number, names, length, vectors, left_out, np.full((len(names), k), -np.inf), np.zeros((len(names), k), np.int64)

        state = None
        for batch in batches:
            for i in range(batch.num_rows):
                number = batch.column("users")[i].as_py()
                if state is None or state[0] != number:
                    if state is not None:
                        yield rows(state)
                    state = begin(number, batch.column("own").slice(i, 1))
                _, names, length, vectors, (owner, left_out), scores, ids = state
                bound = length * batch.column("longest")[i].as_py() * (1 + 1e-9)
                active = np.flatnonzero(bound >= scores[:, -1])
                if not len(active):
                    continue
                if scored is not None:
                    scored.add(len(active))
                items = flat(batch.column("ids"), i, np.int64)
                factors = flat(batch.column("factors"), i, np.float64).reshape(len(items), -1)
                product = vectors[active] @ factors.T
                if len(left_out):
                    order = np.argsort(items)
                    place = np.minimum(np.searchsorted(items[order], left_out), len(items) - 1)
                    row = np.full(len(names), -1)
                    row[active] = np.arange(len(active))
                    hit = (items[order][place] == left_out) & (row[owner] >= 0)
                    product[row[owner[hit]], order[place[hit]]] = -np.inf
                # Candidates of a user: the items that reach the k-th score, with those kept so far.
                for at, user in enumerate(active):
                    near = np.flatnonzero(product[at] >= scores[user, -1])
                    near = near[np.isfinite(product[at, near])]
                    if not len(near):
                        continue
                    if len(near) > 4 * k:
                        least = np.partition(product[at, near], len(near) - k)[len(near) - k]
                        near = near[product[at, near] >= least]
                    value = np.concatenate([scores[user], product[at, near]])
                    name = np.concatenate([ids[user], items[near]])
                    chosen = np.lexsort((name, -value))[:k]
                    scores[user], ids[user] = value[chosen], name[chosen]
        yield rows(state)

    best = None
    for start in range(0, many, per_wave):
        last = min(many, start + per_wave) - 1
        asking = users
        if best is not None:
            # Of the users, those for whom an item of this wave could still be among the k best.
            longest = blocks.where(F.col("block") == start).first()["longest"]
            kept = best.groupBy(F.col("user_id").alias("known")).agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
            asking = users.join(kept, F.col("user_id") == F.col("known"), "left").where(
                (F.coalesce("n", F.lit(0)) < k) | (F.col("length") * longest * (1 + 1e-9) >= F.col("least"))).drop("known", "least", "n")
            asking = as_table(asking, "asking-users")
        parts = -(-asking.count() // users_in_block)
        if not parts:
            break
        dealt = asking.groupBy(F.pmod(F.xxhash64("user_id"), F.lit(parts)).cast("int").alias("users")).agg(
            F.collect_list(F.struct(F.col("user_id").cast("long").alias("user_id"), "features", "length", "gone")).alias("own"))
        # One row for each pair of a block of users and a block of the wave, the wave's blocks in order.
        pairs = dealt.withColumn("block", F.explode(F.sequence(F.lit(start), F.lit(last)))).join(
            F.broadcast(blocks.where(F.col("block").between(start, last))), "block")
        with arrow_rows(spark, AT_ONCE):
            found = as_table(pairs.select("users", "own", "longest", "ids", "factors").mapInArrow(work, ddl), "products")
        best = found if best is None else as_table(
            top_per_group(best.unionByName(found), ["user_id"], k, F.col("score").desc(), F.col("item_id")).drop("rank"), "products")
    if best is None:
        best = spark.createDataFrame([], ddl)
    return top_per_group(best, ["user_id"], k, F.col("score").desc(), F.col("item_id")).select(
        F.col("user_id").cast("int").alias("user_id"), "rank", F.col("item_id").cast("int").alias("item_id"), "score")
