"""Writing results, and checks of their form."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ordered_ids(df: DataFrame, key: str) -> DataFrame:
    """(key, ord): rows in the order of the scan."""
    return df.select(key, F.monotonically_increasing_id().alias("ord"))


def result_lists(pairs: DataFrame, s1: DataFrame, rank: str = "rank") -> DataFrame:
    """(s1_id, ids): one row per S1 of (s1_id, ord), its candidates by rank, first seen first, joined by commas."""
    per = pairs.groupBy("s1_id").agg(F.array_sort(F.collect_set(F.struct(rank, "cand_id"))).alias("c"))
    ids = F.array_join(F.array_distinct(F.col("c.cand_id")), ",")
    return s1.join(per, "s1_id", "left").select("s1_id", "ord", F.coalesce(ids, F.lit("")).alias("ids"))


def write_lists(lists: DataFrame, path: str, header: tuple[str, str]) -> None:
    """Tab-separated text in input order, without quoting; the rows are range-sorted over the files."""
    out = lists.orderBy("ord").select(F.col("s1_id").alias(header[0]), F.col("ids").alias(header[1]))
    out.write.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").option("lineSep", "\n").csv(path)


def write_json(spark: SparkSession, value: object, path: str) -> None:
    """A small value, such as thresholds or a dictionary, as one file that any reader of the shared folder finds."""
    spark.createDataFrame([(json.dumps(value, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> object:
    return json.loads("\n".join(r["value"] for r in spark.read.text(path).collect()))


def append_log(metrics: DataFrame, path: str) -> None:
    metrics.withColumn("written", F.current_timestamp()).write.mode("append").parquet(path)


def validate(rows: DataFrame, expected: DataFrame, candidates: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """(rule, severity, n, example) for every rule on rows (s1_id, ids); n is 0 where it holds."""
    exploded = rows.select("s1_id", F.explode(F.filter(F.split("ids", ","), lambda x: x != "")).alias("id"))
    lists = rows.withColumn("l", F.filter(F.split("ids", ","), lambda x: x != ""))
    have, want = rows.select("s1_id").distinct(), expected.select("s1_id").distinct()
    found = [
        ("duplicate_s1", "error", rows.groupBy("s1_id").count().where("count > 1").select(F.col("s1_id").alias("x"))),
        ("repeated_id", "error", lists.where(F.size("l") > F.size(F.array_distinct("l"))).select(F.col("s1_id").alias("x"))),
        ("s1_in_list", "error", exploded.where("id LIKE 'S1-%'").select(F.col("id").alias("x"))),
        ("unknown_prefix", "error", exploded.where("NOT id RLIKE '^S[123]-'").select(F.col("id").alias("x"))),
        ("missing_s1", "error", want.join(have, "s1_id", "left_anti").select(F.col("s1_id").alias("x"))),
        ("extra_s1", "error", have.join(want, "s1_id", "left_anti").select(F.col("s1_id").alias("x"))),
    ]
    if candidates is not None:
        pairs = candidates.select("s1_id", F.col("cand_id").alias("id"))
        found.append(("not_a_candidate", "warning", exploded.join(pairs, ["s1_id", "id"], "left_anti").select(F.col("id").alias("x"))))
    if known is not None:
        found.append(("unknown_id", "error", exploded.join(known.select(F.col("entity_id").alias("id")), "id", "left_anti").select(F.col("id").alias("x"))))
    out = None
    for rule, severity, df in found:
        one = df.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("example")).select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), "n", "example")
        out = one if out is None else out.unionByName(one)
    return out
