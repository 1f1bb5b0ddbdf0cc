"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source gets a target number of words: weights share ``SHARE`` of all words, a target stops at ``MOST`` times its
source's size, and what is left over is shared again by weight until no target is above that.

Documents are dealt by a hash of their id into as many blocks per source as the square root of its documents (fewer
for small sources), so that neither the blocks of a source nor the documents of a block are ever many in one place. A source's target takes whole
rounds of all its blocks, then blocks in a permuted order, then part of one block, filled document by document. What
it takes is its quota of block draws. The quotas of all sources are split exactly among the output shards: a tree
halves the shards, and at each node a multivariate hypergeometric draw says how many draws of each source go left. A
shard then holds disjoint runs of its sources' permuted draws and is shuffled by itself.

Only numbers per class of sources reach the driver, of which there are ``CLASSES`` at most: beyond that, several
sources share a class in the tree; their targets and draws stay their own.

Defined results: null texts have size 0; a null source is a source of its own, last in order; rows with one id and
source are drawn together; with no words at all every target is 0. Reruns agree.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Least number of shards, and words that a shard holds on average where there are more.
SHARDS = 64
SHARD_WORDS = 1 << 25
CLASSES = 4096
#: Documents that a block holds at least, on average, where its source has so many.
LEAST = 64
#: Rows of a written table of sources or blocks that may be broadcast; a block has some tens of bytes.
BROADCAST = 300_000
SEED = 20
KEY = ("doc_id", "source", "size")


def _hash(seed: int, *columns: str | Column) -> Column:
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) if isinstance(c, str) else c for c in columns], F.lit(seed))


def ranked(df: DataFrame, order: str) -> DataFrame:
    """Adds ``rank`` (from 0, nulls last): each partition of a range order counts its own rows, and the partitions'
    totals, one row each, give the offsets."""
    n = common.partitions(df.sparkSession)
    keys = [F.col(order).isNull().alias("__null"), F.col(order)]
    dealt = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id())
    dealt = common.stage(dealt, "ranked")
    part = F.shiftright("__id", 33)
    own = dealt.withColumn("__part", part).withColumn("__own", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
    totals = own.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    offsets = totals.withColumn("__before", F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    return own.join(F.broadcast(offsets), "__part").withColumn("rank", F.col("__before") + F.col("__own")).drop("__part", "__own", "__before", "__id")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, n_docs, rank, target) from (doc_id, source, size)."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    turn = F.array(*[F.lit(w) for w in weights])
    sources = common.stage(ranked(sources, "source").withColumn("weight", F.element_at(turn, (F.col("rank") % len(weights) + 1).cast("int"))), "sources")
    total, level, full = None, None, -1
    while True:  # the level only rises, and a source that is full stays full
        above = (F.col("weight") * F.lit(level) > most * F.col("source_size")) if level is not None else F.lit(False)
        r = sources.agg(F.sum("source_size").alias("all"), F.count(F.when(above, 1)).alias("full"), F.sum(F.when(above, F.col("source_size")).otherwise(0)).alias("held"), F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("open")).first()
        total = r["all"] or 0
        if r["full"] == full or not r["open"]:
            break
        full = r["full"]
        level = (share * total - most * (r["held"] or 0)) / r["open"]
    goal = F.least(F.lit(float(level or 0.0)) * F.col("weight"), (most * F.col("source_size")).cast("double"))
    return sources.select("source", "source_size", "n_docs", "rank", goal.cast("double").alias("target"))


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(shards, classes): how many draws of each class every shard gets; shards are of equal size up to one draw."""
    out = np.zeros((shards, len(quotas)), np.int64)
    total = int(quotas.sum())
    bounds = [total * j // shards for j in range(shards + 1)]

    def go(lo: int, hi: int, left: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = left
            return
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        part = rng.multivariate_hypergeometric(left, bounds[mid] - bounds[lo], method="marginals") if left.sum() else left
        go(lo, mid, part)
        go(mid, hi, left - part)

    go(0, shards, quotas.astype(np.int64))
    return out


def _fill(rows):  # of one block: at most about the square root of a source's documents
    """Documents in permuted order that still fit, then one more if that brings the sum nearer."""
    import pandas as pd

    rows = rows.sort_values(["h", "doc_id"], na_position="last", kind="stable").reset_index(drop=True)
    left, taken = float(rows["short"].iloc[0]), []
    for i, n in enumerate(rows["size"]):
        if n <= left:
            left -= n
            taken.append(i)
    rest = rows.drop(index=taken)
    rest = rest[rest["size"] > 0]
    if len(rest):
        i = rest["size"].idxmin()
        if rest["size"][i] - left < left:
            taken.append(i)
    return pd.DataFrame({"rank": rows["rank"][taken], "doc_id": rows["doc_id"][taken]})


class Draws(NamedTuple):
    """What a mix takes, without its documents: ``goals`` by source (source, rank, source_size, target, blocks),
    ``blocks`` by block (rank, block, extra, shards: one for each draw), ``picked`` the documents of a part block."""

    goals: DataFrame
    blocks: DataFrame
    picked: DataFrame


def _held(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it has ``BROADCAST`` rows at most."""
    return F.broadcast(df) if df.count() <= BROADCAST else df


def draw(sizes: DataFrame, shards: int | None = None, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> Draws:
    """The draws of a mix from (doc_id, source, size), dealt out by the splitting tree among ``shards`` shards (by
    default, one for each ``SHARD_WORDS`` words, ``SHARDS`` at least)."""
    spark = sizes.sparkSession
    common.tune(spark)
    goals = targets(sizes, weights, share, most)
    goals = goals.withColumn("blocks", F.ceil(F.col("n_docs") / F.greatest(F.sqrt("n_docs"), F.lit(float(LEAST)))).cast("long"))
    goals = goals.withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    goals = common.stage(goals.withColumn("more", F.col("target") - F.col("rounds") * F.col("source_size")), "targets")
    if shards is None:
        shards = min(65536, max(SHARDS, int((goals.agg(F.sum("target")).first()[0] or 0) / SHARD_WORDS)))

    rows = _placed(sizes, goals, seed, "rounds", "more").withColumnsRenamed({"__rounds": "rounds", "__more": "more", "__rank": "rank", "__block": "block"})
    blocks = rows.groupBy("rank", "block", "rounds", "more").agg(F.sum("size").alias("words"))
    line = W.partitionBy("rank").orderBy(_hash(seed + 1, "rank", "block"), "block")  # some square root of a source's rows
    blocks = blocks.withColumn("before", F.coalesce(F.sum("words").over(line.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    room = F.col("more") - F.col("before")
    blocks = blocks.withColumn("extra", F.when(room >= F.col("words"), 1).when(room > 0, 2).otherwise(0)).withColumn("short", room)
    blocks = common.stage(blocks.select("rank", "block", "rounds", "extra", "short"), "blocks")

    cut = blocks.where("extra = 2").select("rank", "block", "short")  # one block of a source at most
    open_ = rows.select("rank", "doc_id", "size", "block").join(_held(cut), ["rank", "block"])
    open_ = open_.groupBy("rank", "doc_id", "short").agg(F.sum("size").alias("size")).withColumn("h", _hash(seed + 2, "doc_id"))
    kind = sizes.schema["doc_id"].dataType.simpleString()
    picked = common.stage(open_.groupBy("rank").applyInPandas(_fill, f"rank long, doc_id {kind}").select(F.col("rank").alias("__r"), F.col("doc_id").alias("__d")), "picked")

    draws = blocks.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("rounds") + (F.col("extra") > 0).cast("int"))))).where((F.col("rounds") > 0) | (F.col("extra") > 0))
    draws = draws.select("rank", "block", "copy", "extra", (F.col("rank") % CLASSES).cast("int").alias("class"))
    counted = {r["class"]: r["n"] for r in draws.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}  # CLASSES rows at most
    names = sorted(counted)
    split = split_quotas(np.array([counted[c] for c in names], np.int64), shards, seed) if names else np.zeros((shards, 0), np.int64)
    ends = spark.createDataFrame([(c, np.cumsum(split[:, i]).tolist()) for i, c in enumerate(names)], "class int, ends array<long>")
    turn = W.partitionBy("class").orderBy(_hash(seed + 3, "rank", "block", "copy"), "rank", "block", "copy")
    drawn = draws.withColumn("at", F.row_number().over(turn) - 1).join(F.broadcast(ends), "class")
    drawn = drawn.withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("at"))))
    dealt = drawn.groupBy("rank", "block", "extra").agg(F.array_sort(F.collect_list(F.struct("copy", "shard"))).alias("draws"))  # MOST copies at most
    dealt = common.stage(dealt.select(F.col("rank").alias("__r"), F.col("block").alias("__b"), F.col("extra").alias("__extra"), F.col("draws.shard").alias("__draws")), "draws")
    return Draws(goals, dealt, picked)


def _placed(rows: DataFrame, goals: DataFrame, seed: int, *more: str) -> DataFrame:
    """Adds __rank and __block, and columns of ``goals`` by their names after two underscores."""
    g = _held(goals.select(F.col("source").alias("__source"), *[F.col(c).alias(f"__{c}") for c in ("rank", "blocks", *more)]))
    return rows.join(g, rows["source"].eqNullSafe(g["__source"])).withColumn("__block", F.pmod(_hash(seed, "doc_id"), F.col("__blocks"))).drop("__source", "__blocks")


def assigned(rows: DataFrame, draws: Draws, seed: int = SEED, *more: str) -> DataFrame:
    """Adds __shards to each row with a doc_id and a source: the shards that the tree's draws put it into, one for each
    time that it is drawn. Sources, blocks and part blocks are small tables beside the documents, so rows stay where
    they are."""
    found = _placed(rows, draws.goals, seed, *more)
    b = _held(draws.blocks)
    found = found.join(b, (F.col("__rank") == F.col("__r")) & (F.col("__block") == F.col("__b")), "left").drop("__r", "__b")
    p = _held(draws.picked.withColumn("__in", F.lit(True)))
    found = found.join(p, (F.col("__rank") == F.col("__r")) & found["doc_id"].eqNullSafe(p["__d"]), "left").drop("__r", "__d")
    none = F.array().cast("array<int>")
    kept = F.when((F.col("__extra") == 2) & F.col("__in").isNull(), F.slice("__draws", F.lit(1), F.size("__draws") - 1)).otherwise(F.col("__draws"))
    return found.withColumn("__shards", F.coalesce(kept, none)).drop("__rank", "__block", "__extra", "__draws", "__in")


def plan(sizes: DataFrame, shards: int | None = None, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds source_size, target, copies and shards (one per copy) to each row of (doc_id, source, size)."""
    out = assigned(sizes, draw(sizes, shards, seed, weights, share, most), seed, "source_size", "target")
    return out.select("doc_id", "source", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), F.size("__shards").alias("copies"), F.col("__shards").alias("shards"))


def sizes_of(documents: DataFrame) -> DataFrame:
    """(doc_id, source, size) of every document, written to the shared folder: the texts are read once."""
    return common.stage(documents.select("doc_id", "source", F.regexp_count(common.text_or_empty(), F.lit(common.WORD)).cast("long").alias("size")), "sizes")


def mix(documents: DataFrame, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """The mixed documents: each row as often as it is drawn, dealt out by shard and shuffled within each."""
    return dealt(documents, draw(sizes_of(documents), shards, seed), seed).drop("__shard")


def dealt(documents: DataFrame, draws: Draws, seed: int = SEED) -> DataFrame:
    """The rows of ``documents`` as ``draws`` has them, with ``__shard``. Texts are moved once, to their shards."""
    out = assigned(documents, draws, seed).select(*documents.columns, F.posexplode("__shards").alias("__copy", "__shard"))
    order = _hash(seed + 4, "__shard", "doc_id", "__copy")
    salt = F.pmod(_hash(seed + 5, "doc_id", "__copy"), F.lit(16))  # a shard is written by several tasks
    return out.withColumn("__order", order).repartition(common.partitions(documents.sparkSession), "__shard", salt).sortWithinPartitions("__shard", "__order").drop("__copy", "__order")


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is taken of every document, counted in the texts of the written mix; equal rows of ``KEY`` share what was
    taken. ``shards`` are those that hold them."""
    documents = common.table(spark, sf_dir, "documents")
    sizes = sizes_of(documents)
    draws = draw(sizes)
    mixed = common.stage(dealt(documents.select("doc_id", "source", "text"), draws), "mix")
    size = F.regexp_count(common.text_or_empty(), F.lit(common.WORD)).cast("long").alias("size")
    emitted = mixed.select("doc_id", "source", "__shard", size).groupBy(*KEY).agg(F.sum("size").alias("words"), F.array_sort(F.collect_set("__shard")).alias("shards"))
    emitted = common.stage(emitted.select(*[F.col(c).alias(f"__{c}") for c in KEY], "words", "shards"), "taken")
    common.discard(mixed)
    rows = _placed(sizes, draws.goals, SEED, "source_size", "target").groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows"), F.first("__source_size").alias("source_size"), F.first("__target").alias("target"))
    same = [rows[c].eqNullSafe(emitted[f"__{c}"]) for c in KEY]
    found = rows.join(emitted, same[0] & same[1] & same[2], "left")
    taken = F.coalesce(F.expr("words div rows"), F.lit(0)).alias("taken")
    return found.select("doc_id", "size", "source_size", "target", taken, F.coalesce("shards", F.array().cast("array<int>")).alias("shards"), F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("__row")).drop("__row")
