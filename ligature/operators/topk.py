"""Top-k joins of dense vectors within blocks of equal keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..session import ship
from . import tiles

#: Vectors of a tile on average. A pair of tiles is one row: memory does not grow with a block.
TILE = 1024
#: Queries that meet a list of neighbours at a time.
QUERIES = 256


def dense_topk(queries: DataFrame, pool: DataFrame, k: int, block: str = "country") -> DataFrame:
    """(q, p, score, rank): the ``k`` pool vectors with the largest dot product for each query of (id, v, block).

    Several vectors of one id (say, a main and an alternate one) count with their best. Tiles of queries meet tiles of
    the pool in numpy; each pair of tiles keeps its best candidates per query before anything is shuffled.
    """
    ship(queries.sparkSession)
    pairs = tiles.met(queries.select(block, "id", "v"), pool.select(block, "id", "v"), block, TILE).drop(block)
    kind = queries.schema["id"].dataType.simpleString()

    def matrix(tile: pa.ListScalar) -> tuple[pa.Array, np.ndarray]:
        rows = tile.values
        ids, vs = rows.field("id"), rows.field("v")
        return ids, vs.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, p in zip(batch.column(0), batch.column(1), strict=True):
                (qi, qv), (pi, pv) = matrix(q), matrix(p)
                scores = np.round(qv @ pv.T, 12)
                several = len(pi) // max(1, len(pi.unique()))  # an id's further vectors may take up places
                m = min(2 * k * max(1, several), len(pi))
                top = np.argpartition(-scores, m - 1, axis=1)[:, :m] if m < len(pi) else np.broadcast_to(np.arange(len(pi)), scores.shape)
                edge = np.take_along_axis(scores, top, 1).min(axis=1, keepdims=True)
                at = np.nonzero(scores >= edge)  # with all ties at the edge
                yield pa.RecordBatch.from_arrays([qi.take(pa.array(at[0])), pi.take(pa.array(at[1])), pa.array(scores[at])], ["q", "p", "score"])

    found = pairs.mapInArrow(work, f"q {kind}, p {kind}, score double").groupBy("q", "p").agg(F.max("score").alias("score"))
    w = W.partitionBy("q").orderBy(F.round("score", 9).desc(), "p")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def pair_scores(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Adds ``score`` to (q, p): the dot product of their vectors (id, v), the largest if an id has several; null
    where a side has none."""
    a, b = left.select(F.col("id").alias("q"), F.col("v").alias("qv")), right.select(F.col("id").alias("p"), F.col("v").alias("pv"))
    both = pairs.join(a, "q", "left").join(b, "p", "left").withColumn("score", V.dot(F.col("qv"), F.col("pv")))
    return both.groupBy(*pairs.columns).agg(F.max("score").alias("score"))


def weighed(tokens: DataFrame) -> DataFrame:
    """(id, t): the distinct tokens of (id, country, token) with their idf, ln(1 + (N + 1) / (df + 1)) over all records."""
    total = tokens.select("id", "country").distinct().groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    df = tokens.groupBy("country", "token").agg(F.count(F.lit(1)).alias("df")).join(total, "country").select("country", "token", F.log(1 + (F.col("n") + 1) / (F.col("df") + 1)).alias("idf"))
    each = tokens.select("id", "country", "token").distinct().join(df.hint("merge"), ["country", "token"])
    return each.groupBy("id").agg(F.collect_list(F.struct("token", "idf")).alias("t"))


def wide_rerank(wide: DataFrame, tokens: DataFrame, present: DataFrame, n: int = 10, keep_unshared: bool = False) -> DataFrame:
    """(q, p, f_score): of wide top-k pairs (q, p, score) not yet present, the ``n`` best by the summed idf of shared
    tokens (id, source, country, token); ties by score, then id. idf = ln(1 + (N + 1) / (df + 1)) over all records.

    Pairs without a shared token are left out, or with ``keep_unshared`` come last with 0.
    """
    lists = weighed(tokens)
    q, p = lists.toDF("q", "__q").hint("merge"), lists.select(F.col("id").alias("p"), F.col("t.token").alias("__p")).hint("merge")
    new = wide.join(present.hint("merge"), ["q", "p"], "left_anti")
    shared = F.filter("__q", lambda x: F.array_contains("__p", x["token"]))
    scored = new.join(q, "q", "left").join(p, "p", "left").withColumn("__s", shared).where(F.lit(keep_unshared) | (F.size("__s") > 0))
    scored = scored.withColumn("f_score", F.coalesce(F.round(F.aggregate("__s", F.lit(0.0), lambda a, x: a + x["idf"]), 6), F.lit(0.0))).drop("__q", "__p", "__s")
    w = W.partitionBy("q").orderBy(F.desc("f_score"), F.round("score", 9).desc(), "p")
    return scored.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n).select("q", "p", "f_score")


def list_rerank(queries: DataFrame, lists: DataFrame, tokens: DataFrame, present: DataFrame, n: int = 10, block: str = "country", key: str = "text") -> DataFrame:
    """(q, p, score, f_score), as ``wide_rerank`` with ``keep_unshared`` of all that queries (block, key, id) of one key
    find, from its lists (block, key, source, x) of (p, score): the ``n`` best of each list.

    A list meets its queries as a matrix of shared tokens, ``QUERIES`` of them at a time: its rows are not repeated for
    each query.
    """
    ship(queries.sparkSession)
    by = [block, key]
    none = lambda c: F.coalesce(c, F.array())
    held = weighed(tokens)
    seen = present.groupBy(F.col("q").alias("id")).agg(F.collect_list("p").alias("seen"))
    parts = queries.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERIES)).alias("__k"))
    rows = queries.join(parts.hint("merge"), by).join(held.hint("merge"), "id", "left").join(seen.hint("merge"), "id", "left")
    xs = rows.groupBy(*by, F.pmod(F.xxhash64("id"), F.col("__k")).alias("__tile")).agg(F.collect_list(F.struct("id", none(F.col("t.token")).alias("t"), none(F.col("t.idf")).alias("w"), none(F.col("seen")).alias("seen"))).alias("xs"))
    flat = lists.select(*by, "source", F.explode("x").alias("x")).select(*by, "source", "x.p", "x.score")
    ys = flat.join(held.select(F.col("id").alias("p"), F.col("t.token").alias("t")).hint("merge"), "p", "left").groupBy(*by, "source").agg(F.collect_list(F.struct("p", "score", none(F.col("t")).alias("t"))).alias("ys"))
    kind = queries.schema["id"].dataType.simpleString()

    def flattened(v: pa.Array) -> tuple[np.ndarray, pa.Array]:
        return np.repeat(np.arange(len(v)), np.diff(v.offsets.to_numpy())), v.flatten()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                q, p = x.values, y.values
                pi, score = p.field("p"), p.field("score").to_numpy()
                (qr, qt), (pr, pt), (sr, st) = flattened(q.field("t")), flattened(p.field("t")), flattened(q.field("seen"))
                weight = q.field("w").flatten().to_numpy()
                common = pc.unique(qt.filter(pc.is_in(qt, value_set=pt)))
                sides = []
                for r, t, w, size in ((qr, qt, weight, len(q)), (pr, pt, np.ones(len(pt)), len(p))):
                    place = pc.index_in(t, value_set=common).fill_null(-1).to_numpy()
                    m = np.zeros((size, len(common)))
                    m[r[place >= 0], place[place >= 0]] = w[place >= 0]
                    sides.append(m)
                f = np.round(sides[0] @ sides[1].T, 6)
                place = pc.index_in(st, value_set=pi).fill_null(-1).to_numpy()
                f[sr[place >= 0], place[place >= 0]] = -1  # present pairs
                order = np.lexsort((np.array(pi.to_pylist()), -np.round(score, 9)))
                top = order[np.argsort(-f[:, order], axis=1, kind="stable")[:, :n]]
                best = np.take_along_axis(f, top, 1)
                i, j = np.nonzero(best >= 0)
                yield pa.RecordBatch.from_arrays([q.field("id").take(pa.array(i)), pi.take(pa.array(top[i, j])), pa.array(score[top[i, j]]), pa.array(best[i, j])], ["q", "p", "score", "f_score"])

    return xs.join(ys.hint("merge"), by).select("xs", "ys").mapInArrow(work, f"q {kind}, p {kind}, score double, f_score double")
