"""From scores to matches: exclusivity, two thresholds, and the search for their values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def exclusivity(scored: DataFrame, margin: float = 0.0) -> DataFrame:
    """Each candidate stays with the S1 of the highest (prob, emb_score, then lowest s1_id), or with none if the next
    one is nearer than ``margin``."""
    w = W.partitionBy("cand_id").orderBy(F.desc("prob"), F.desc("emb_score"), "s1_id")
    rows = scored.withColumns({"__rn": F.row_number().over(w), "__next": F.lead("prob").over(w)})
    return rows.where((F.col("__rn") == 1) & (F.col("__next").isNull() | (F.col("prob") - F.col("__next") >= margin))).drop("__rn", "__next")


def thresholds(scored: DataFrame, t_top1: float, t_extra: float) -> DataFrame:
    """Of each S1 whose best row reaches ``t_top1``: that row, and the others that reach ``t_extra``."""
    w = W.partitionBy("s1_id").orderBy(F.desc("prob"), F.desc("emb_score"), "cand_id")
    rows = scored.withColumns({"__rn": F.row_number().over(w), "__top": F.max("prob").over(W.partitionBy("s1_id"))})
    return rows.where((F.col("__top") >= t_top1) & ((F.col("__rn") == 1) | (F.col("prob") >= t_extra))).drop("__rn", "__top")


def decide(scored: DataFrame, s1: DataFrame, t_top1: float = 0.5, t_extra: float = 0.8, margin: float = 0.0, exclusive: bool = True) -> DataFrame:
    """(s1_id, matched_ids): one row per S1 of ``s1``, sorted ids joined by commas, empty without a match.

    Rows of competitors (``is_competitor``) take part in the exclusivity and are then dropped.
    """
    floor = min(t_top1, t_extra) - margin  # a rival below cannot change what is kept
    rows = scored.where(F.col("prob") >= floor)
    rows = exclusivity(rows, margin) if exclusive else rows
    rows = rows.where("is_competitor = 0") if "is_competitor" in rows.columns else rows
    found = thresholds(rows, t_top1, t_extra).groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set("cand_id")), ",").alias("matched_ids"))
    return s1.select("s1_id").distinct().join(found, "s1_id", "left").fillna("", ["matched_ids"])


def entity_score(tp: str, n_pred: str, n_gold: str):
    """F0.5 of one entity; two empty lists agree fully, one empty list not at all."""
    p, r = F.col(tp) / F.col(n_pred), F.col(tp) / F.col(n_gold)
    both = (F.col(n_pred) == 0) & (F.col(n_gold) == 0)
    return F.when(both, 1.0).when((F.col(n_pred) == 0) | (F.col(n_gold) == 0) | (F.col(tp) == 0), 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


def steps(least: float, most: float, step: float = 0.02) -> list[float]:
    """Thresholds from ``least`` to ``most``, as decimals."""
    return [round(least + i * step, 6) for i in range(int(round((most - least) / step)) + 1)]


TOP1, EXTRA, MARGINS = steps(0.10, 0.70), steps(0.40, 0.94), [0.0, 0.05, 0.10]


def grid_search(scored: DataFrame, gold: DataFrame, s1: DataFrame, top1: list[float] = TOP1, extra: list[float] = EXTRA, margins: list[float] = MARGINS, exclusive: tuple[bool, ...] = (True, False)) -> DataFrame:
    """(exclusive, margin, t_top1, t_extra, f05) for every setting with t_extra >= t_top1.

    What an S1 scores depends on t_top1 only through whether its best row reaches it, so each S1 gives one score per
    t_extra and falls into one step of t_top1; the settings are sums over the steps above. One row per S1 and
    t_extra is combined before the shuffle, and the sums per step are a table as large as the grid.
    """
    n_gold = s1.select("s1_id").distinct().join(gold.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_gold")), "s1_id", "left").fillna(0, ["n_gold"])
    hits = scored.join(gold.select("s1_id", "cand_id", F.lit(1).alias("hit")), ["s1_id", "cand_id"], "left").fillna(0, ["hit"])
    out = None
    for on in exclusive:
        for m in margins if on else [0.0]:
            one = _sweep(exclusivity(hits, m) if on else hits, n_gold, sorted(top1), sorted(extra))
            for margin in [m] if on else margins:  # without exclusivity the margin has no effect
                part = one.select(F.lit(on).alias("exclusive"), F.lit(float(margin)).alias("margin"), "t_top1", "t_extra", "f05")
                out = part if out is None else out.unionByName(part)
    return out


def _sweep(rows: DataFrame, n_gold: DataFrame, top1: list[float], extra: list[float]) -> DataFrame:
    w = W.partitionBy("s1_id").orderBy(F.desc("prob"), F.desc("emb_score"), "cand_id")
    reached = F.size(F.filter(F.array(*[F.lit(t) for t in top1]), lambda t: t <= F.col("prob")))
    ranked = rows.where(F.col("prob") >= top1[0]).withColumns({"rn": F.row_number().over(w), "step": reached})
    more = [F.when((F.col("rn") > 1) & (F.col("prob") >= t), 1) for t in extra]
    per = ranked.groupBy("s1_id").agg(F.max("step").alias("step"), F.sum(F.when(F.col("rn") == 1, F.col("hit"))).alias("first"), F.array(*[F.count(c) for c in more]).alias("n"), F.array(*[F.sum(F.when(c == 1, F.col("hit")).otherwise(0)) for c in more]).alias("h"))
    full = n_gold.join(per, "s1_id", "left").withColumn("step", F.coalesce("step", F.lit(0)))
    at = F.array(*[F.struct(F.lit(t).alias("t_extra"), F.lit(i).alias("i")) for i, t in enumerate(extra)])
    long = full.select("step", "n_gold", "first", "n", "h", F.explode(at).alias("x")).select("step", "x.t_extra", "n_gold", (1 + F.col("n")[F.col("x.i")]).alias("n_pred"), (F.col("first") + F.col("h")[F.col("x.i")]).alias("tp"))
    scores = long.select("step", "t_extra", F.when(F.col("step") > 0, entity_score("tp", "n_pred", "n_gold")).otherwise(0.0).alias("f"), (F.col("n_gold") == 0).cast("double").alias("alone"))
    sums = scores.groupBy("step", "t_extra").agg(F.sum("f").alias("f"), F.sum("alone").alias("alone"), F.count(F.lit(1)).alias("n"))
    grid = F.array(*[F.struct(F.lit(t).alias("t_top1"), F.lit(i + 1).alias("i")) for i, t in enumerate(top1)])
    each = sums.select("*", F.explode(grid).alias("g"))  # as large as the grid times its steps
    kept = F.col("step") >= F.col("g.i")
    return each.groupBy(F.col("g.t_top1").alias("t_top1"), "t_extra").agg(F.round(F.sum(F.when(kept, F.col("f")).otherwise(F.col("alone"))) / F.sum("n"), 6).alias("f05")).where("t_extra >= t_top1")


def best_setting(grid: DataFrame) -> DataFrame:
    """The setting of the highest score; ties go to exclusivity, then to the smaller margin and thresholds."""
    return grid.orderBy(F.desc("f05"), F.desc("exclusive"), "margin", "t_top1", "t_extra").limit(1)
