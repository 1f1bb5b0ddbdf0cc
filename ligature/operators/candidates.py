"""The candidate table: union of channels, scores, caps, later additions, provenance, labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .blocking import best

NO_RANK, NO_TFIDF_RANK = 999, 99
KEY = ["s1_id", "cand_id"]


def union_channels(channels: dict[str, DataFrame]) -> DataFrame:
    """One row per pair with a 0/1 flag per channel; ``emb_score`` is the largest, ``emb_rank`` the smallest."""
    flags = list(channels)
    parts = []
    for name, df in channels.items():
        made = df.withColumns({f: F.lit(int(f == name)) for f in flags})
        for c, kind in (("emb_score", "double"), ("emb_rank", "int")):
            if c not in made.columns:
                made = made.withColumn(c, F.lit(None).cast(kind))
        parts.append(made.select(*KEY, "cand_source", "emb_score", "emb_rank", *flags))
    whole = reduce(DataFrame.unionByName, parts)
    return whole.groupBy(*KEY).agg(F.min("cand_source").alias("cand_source"), F.max("emb_score").alias("emb_score"), F.coalesce(F.min("emb_rank"), F.lit(NO_RANK)).alias("emb_rank"), *[F.max(f).alias(f) for f in flags])


def cap(cands: DataFrame, symbolic: list[str], n: int = 40) -> DataFrame:
    """The ``n`` candidates per S1 over all sources: those of symbolic channels first, then by score."""
    found = F.greatest(*[F.col(c) for c in symbolic]) if len(symbolic) > 1 else F.col(symbolic[0])
    return best(cands, n, found.desc(), F.desc_nulls_last("emb_score"))


def label(cands: DataFrame, gold: DataFrame) -> DataFrame:
    return cands.join(gold.select(*KEY, F.lit(1).alias("label")).hint("merge"), KEY, "left").fillna(0, ["label"])


def add_absent(cands: DataFrame, found: DataFrame, n: int, *order: Column) -> DataFrame:
    """The channel's first ``n`` pairs per S1 that are not candidates yet."""
    return best(found.join(cands, KEY, "left_anti"), n, *order)


def annotate(cands: DataFrame, found: DataFrame, flag: str, rank: str | None = None, score: str | None = None) -> DataFrame:
    """Flag, rank and score of a channel on every row that it found; 0, 99 and 0 elsewhere."""
    cols = [F.lit(1).alias(flag)] + [F.col(c) for c in (rank, score) if c]
    out = cands.join(found.select(*KEY, *cols), KEY, "left").fillna(0, [flag])
    out = out.fillna(NO_TFIDF_RANK, [rank]) if rank else out
    return out.fillna(0.0, [score]) if score else out


def budget_merge(cands: DataFrame, extras: dict[str, DataFrame], budget: int = 30) -> DataFrame:
    """New pairs of several channels, ordered by the number of channels, ``ch_comb``, ``f_score`` and ``emb_score``;
    ``budget`` per S1."""
    flags = list(extras)
    parts = []
    for name, df in extras.items():
        made = df.withColumns({f: F.lit(int(f == name)) for f in flags})
        for c in ("f_score", "emb_score"):
            made = made if c in made.columns else made.withColumn(c, F.lit(0.0))
        parts.append(made.select(*KEY, "f_score", "emb_score", *flags))
    merged = reduce(DataFrame.unionByName, parts).groupBy(*KEY).agg(F.max("f_score").alias("f_score"), F.max("emb_score").alias("emb_score"), *[F.max(f).alias(f) for f in flags])
    new = merged.join(cands, KEY, "left_anti")
    count = reduce(lambda a, b: a + b, [F.col(f) for f in flags])
    comb = [F.desc("ch_comb")] if "ch_comb" in flags else []
    return best(new.withColumn("n_new", count), budget, F.desc("n_new"), *comb, F.desc("f_score"), F.desc("emb_score"))


def provenance(cands: DataFrame, steps: list[tuple[int, list[str]]], base: list[str]) -> DataFrame:
    """``added_by``: 0 if a base channel found the pair, else the number of the first step of which a channel did."""
    hit = lambda cs: reduce(lambda a, b: a | b, [F.col(c) == 1 for c in cs])
    out = F.when(hit(base), 0)
    for n, cs in steps:
        out = out.when(hit(cs), n)
    return cands.withColumn("added_by", out)


def learn_dictionary(pairs: DataFrame, least: int = 3, share: float = 0.6, most: int = 4) -> DataFrame:
    """(src, dst, n, share) from matched names (a, b): unmatched tokens are aligned by position where both sides have
    as many, ``most`` at most; a mapping is kept if it is seen often and is most of its source's occurrences. Equal
    pairs are aligned once; a column ``n`` of theirs says how many a row stands for."""
    a, b = F.split("a", " "), F.split("b", " ")
    each = pairs.groupBy("a", "b").agg((F.sum("n") if "n" in pairs.columns else F.count(F.lit(1))).alias("n"))
    left = each.select("n", F.array_except(b, a).alias("s"), F.array_except(a, b).alias("t")).where((F.size("s") == F.size("t")) & (F.size("s").between(1, most)))
    seen = left.select("n", F.explode(F.arrays_zip("s", "t")).alias("z")).groupBy(F.col("z.s").alias("src"), F.col("z.t").alias("dst")).agg(F.sum("n").alias("n"))
    w = W.partitionBy("src")
    ranked = seen.withColumn("share", F.col("n") / F.sum("n").over(w)).withColumn("rn", F.row_number().over(w.orderBy(F.desc("n"), "dst")))
    return ranked.where((F.col("rn") == 1) & (F.col("n") >= least) & (F.col("share") >= share)).drop("rn")


def top_k(scored: DataFrame, k: int = 15, score: str = "score") -> DataFrame:
    return best(scored, k, F.desc(score), F.desc_nulls_last("emb_score"))


def choose_k(scored: DataFrame, share: float = 0.995, most: int = 40, score: str = "score") -> DataFrame:
    """(k, kept, recall, chosen): gold pairs kept per K, and the smallest K that keeps ``share`` of them."""
    w = W.partitionBy("s1_id").orderBy(F.desc(score), F.desc_nulls_last("emb_score"), "cand_id")
    ranks = scored.withColumn("rk", F.row_number().over(w)).where("label = 1").groupBy("rk").agg(F.count(F.lit(1)).alias("n"))
    total = ranks.agg(F.sum("n").alias("all"))
    ks = scored.sparkSession.range(1, most + 1).select(F.col("id").alias("k"))
    per = ks.join(F.broadcast(ranks), F.col("rk") <= F.col("k"), "left").groupBy("k").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("kept"))  # one row per rank
    out = per.join(F.broadcast(total)).select("k", "kept", F.round(F.col("kept") / F.col("all"), 6).alias("recall"))
    first = F.min(F.when(F.col("recall") >= share, F.col("k"))).over(W.partitionBy(F.lit(0)))
    return out.withColumn("chosen", (F.col("k") == first).cast("int")).fillna(0, ["chosen"])
