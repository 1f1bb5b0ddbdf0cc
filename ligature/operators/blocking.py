"""Candidate retrieval by keys: explode keys, drop keys that too many pool records hold, join, keep the best few."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import spread

MAX_BLOCK = 50


def capped(pool_keys: DataFrame, cap: int = MAX_BLOCK) -> DataFrame:
    """Pool keys (cand_id, cand_source, key) held by at most ``cap`` pool records of their source.

    Counts are combined before the shuffle, so a key that a third of all rows hold costs one row per task.
    """
    few = pool_keys.groupBy("cand_source", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= cap).select("cand_source", "key")
    return pool_keys.join(few, ["cand_source", "key"], "left_semi")


def key_pairs(s1_keys: DataFrame, pool_keys: DataFrame, cap: int = MAX_BLOCK) -> DataFrame:
    """Distinct (s1_id, cand_id, cand_source) that share a key of a block within the cap."""
    return spread(s1_keys, "key").join(capped(pool_keys, cap), "key").select("s1_id", "cand_id", "cand_source").distinct()


def best(pairs: DataFrame, n: int, *order: Column, by: tuple[str, ...] = ("s1_id",)) -> DataFrame:
    """The first ``n`` rows per group; ties end with the candidate's id, so the result does not depend on partitions."""
    w = W.partitionBy(*by).orderBy(*order, "cand_id")
    return pairs.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def as_s1_keys(keys: DataFrame) -> DataFrame:
    return keys.where("source = 1").select(F.col("entity_id").alias("s1_id"), "key")


def as_pool_keys(keys: DataFrame) -> DataFrame:
    return keys.where("source > 1").select(F.col("entity_id").alias("cand_id"), (F.col("source") - 2).alias("cand_source"), "key")


def key_join(keys: DataFrame, cap: int = MAX_BLOCK) -> DataFrame:
    """Pairs from one table of keys (entity_id, source, key) of both sides."""
    return key_pairs(as_s1_keys(keys), as_pool_keys(keys), cap)


def _exploded(records: DataFrame, keys: Column) -> DataFrame:
    return records.select("entity_id", "source", F.explode(keys).alias("key")).where("key IS NOT NULL").distinct()


def address_keys(records: DataFrame) -> DataFrame:
    """H: country, house number and next word; Z: country, postal code and number."""
    house = F.transform("house_cands", lambda h: F.concat(F.lit("H_"), F.col("country"), F.lit("_"), h))
    zips = F.transform(F.when(F.col("zip_pin") != "", F.col("num_tokens")).otherwise(F.array().cast("array<string>")), lambda n: F.concat(F.lit("Z_"), F.col("country"), F.lit("_"), F.col("zip_pin"), F.lit("_"), n))
    return _exploded(records, F.concat(house, zips))


def skeleton_keys(records: DataFrame) -> DataFrame:
    key = F.concat(F.lit("SK_"), F.col("country"), F.lit("_"), F.array_join(F.array_sort(F.split("name_skel", " ")), " "))
    return _exploded(records.where("name_skel <> ''"), F.array(key))


def token_frequencies(records: DataFrame, least: int = 5) -> DataFrame:
    """(country, token, doc_freq) of address tokens of ``least`` letters or more, over all sources."""
    long = F.array_distinct(F.filter("addr_tokens", lambda t: F.length(t) >= least))
    return records.select("country", F.explode(long).alias("token")).groupBy("country", "token").agg(F.count(F.lit(1)).alias("doc_freq"))


def ranked_tokens(records: DataFrame, frequencies: DataFrame, least: int = 5, alphabetic: bool = False) -> DataFrame:
    """(entity_id, source, country, token, rk): a record's distinct tokens, the rarest first, ties by token."""
    long = F.array_distinct(F.filter("addr_tokens", lambda t: (F.length(t) >= least) & (t.rlike(r"(?U)^\p{Alpha}+$") if alphabetic else F.lit(True))))
    tokens = records.select("entity_id", "source", "country", F.explode(long).alias("token"))
    w = W.partitionBy("entity_id").orderBy(F.coalesce("doc_freq", F.lit(0)), "token")
    return tokens.join(frequencies, ["country", "token"], "left").withColumn("rk", F.row_number().over(w)).drop("doc_freq")


def rare_token_keys(records: DataFrame, frequencies: DataFrame) -> DataFrame:
    """E1: the rarest address token; E2: the two rarest, sorted."""
    top = ranked_tokens(records, frequencies).where("rk <= 2").groupBy("entity_id", "source", "country").agg(F.min_by("token", "rk").alias("t1"), F.array_sort(F.collect_list("token")).alias("both"))
    keys = F.array(F.concat(F.lit("E1_"), F.col("country"), F.lit("_"), F.col("t1")), F.when(F.size("both") > 1, F.concat(F.lit("E2_"), F.col("country"), F.lit("_"), F.array_join("both", "_"))))
    return _exploded(top, keys)


def number_keys(records: DataFrame, kind: str, frequencies: DataFrame | None = None) -> DataFrame:
    """K1: two consecutive numbers of two digits or more; K2: postal code and first long word; K3: all numbers;
    K4: the first two skeleton tokens in order; K5: a number of three digits or more and the rarest word."""
    at = lambda *parts: F.concat(F.lit(f"{kind}_"), F.col("country"), *[x for p in parts for x in (F.lit("_"), p)])
    if kind == "K1":
        nums = F.filter("num_tokens", lambda t: F.length(t) >= 2)
        return _exploded(records, F.transform(F.arrays_zip(F.slice(nums, F.lit(1), F.greatest(F.size(nums) - 1, F.lit(0))).alias("a"), F.slice(nums, F.lit(2), F.greatest(F.size(nums) - 1, F.lit(0))).alias("b")), lambda p: at(p["a"], p["b"])))
    if kind == "K2":
        word = F.try_element_at(F.filter("addr_tokens", lambda t: t.rlike(r"(?U)^\p{Alpha}+$") & (F.length(t) >= 4)), F.lit(1))
        return _exploded(records.where("zip_pin <> ''"), F.array(at(F.col("zip_pin"), word)))
    if kind == "K3":
        return _exploded(records.where(F.size("num_tokens") > 0), F.array(at(F.array_join(F.array_sort("num_tokens"), "_"))))
    if kind == "K4":
        toks = F.array_sort(F.split("name_skel", " "))
        return _exploded(records.where("name_skel <> ''").where(F.size(toks) > 1), F.array(at(toks[0], toks[1])))
    if kind == "K5" and frequencies is not None:
        rarest = ranked_tokens(records, frequencies, alphabetic=True).where("rk = 1").select("entity_id", F.col("token").alias("rarest"))
        return _exploded(records.join(rarest, "entity_id"), F.transform(F.filter("num_tokens", lambda t: F.length(t) >= 3), lambda n: at(n, F.col("rarest"))))
    raise ValueError(kind)


def block_sizes(keys: DataFrame) -> DataFrame:
    """(cand_source, key, n) of the pool."""
    return as_pool_keys(keys).groupBy("cand_source", "key").agg(F.count(F.lit(1)).alias("n"))
