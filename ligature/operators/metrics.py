"""Quality and recall reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .decide import entity_score


def entity_scores(pred: DataFrame, gold: DataFrame, s1: DataFrame) -> DataFrame:
    """(s1_id, tp, n_pred, n_gold, f05) for every S1 from pairs (s1_id, cand_id)."""
    p = pred.select("s1_id", "cand_id").distinct().withColumn("p", F.lit(1))
    g = gold.select("s1_id", "cand_id").distinct().withColumn("g", F.lit(1))
    both = p.join(g, ["s1_id", "cand_id"], "full").fillna(0, ["p", "g"])
    per = both.groupBy("s1_id").agg(F.sum(F.col("p") * F.col("g")).alias("tp"), F.sum("p").alias("n_pred"), F.sum("g").alias("n_gold"))
    out = s1.select("s1_id").distinct().join(per, "s1_id", "left").fillna(0, ["tp", "n_pred", "n_gold"])
    return out.withColumn("f05", F.round(entity_score("tp", "n_pred", "n_gold"), 6))


def macro_f05(pred: DataFrame, gold: DataFrame, s1: DataFrame) -> DataFrame:
    return entity_scores(pred, gold, s1).agg(F.count(F.lit(1)).alias("n_s1"), F.round(F.avg("f05"), 5).alias("macro_f05"))


def recall_report(cands: DataFrame, gold: DataFrame, s1: DataFrame) -> DataFrame:
    """Pair recall, recall of whole entities, and candidates per S1 (mean, 95th percentile, most)."""
    hit = gold.join(cands.select("s1_id", "cand_id", F.lit(1).alias("hit")), ["s1_id", "cand_id"], "left").fillna(0, ["hit"])
    pairs = hit.agg(F.count(F.lit(1)).alias("n_gold"), F.sum("hit").alias("n_hit"))
    entities = hit.groupBy("s1_id").agg(F.min("hit").alias("h")).agg(F.round(F.avg("h"), 6).alias("entity_recall"))
    per = s1.select("s1_id").distinct().join(cands.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n")), "s1_id", "left").fillna(0, ["n"])
    sizes = per.agg(F.round(F.avg("n"), 6).alias("mean_cands"), F.expr("round(percentile(n, 0.95), 6)").alias("p95_cands"), F.max("n").alias("max_cands"))
    one = F.lit(True)
    return pairs.withColumn("pair_recall", F.round(F.col("n_hit") / F.col("n_gold"), 6)).join(entities, one).join(sizes, one)


def recall_cube(cands: DataFrame, gold: DataFrame) -> DataFrame:
    """Recall by country and source with all subtotals; ``all`` marks them."""
    hit = gold.join(cands.select("s1_id", "cand_id", F.lit(1).alias("hit")), ["s1_id", "cand_id"], "left").fillna(0, ["hit"])
    return hit.cube("country", "cand_source").agg(F.count(F.lit(1)).alias("n_gold"), F.sum("hit").alias("n_hit")).select(F.coalesce("country", F.lit("all")).alias("country"), F.coalesce(F.col("cand_source").cast("string"), F.lit("all")).alias("cand_source"), "n_gold", "n_hit", F.round(F.col("n_hit") / F.col("n_gold"), 6).alias("recall"))


def channel_report(cands: DataFrame, gold: DataFrame, flags: list[str]) -> DataFrame:
    """(channel, pairs, hits, unique_hits): gold pairs that only this channel found are unique to it."""
    total = sum((F.col(f) for f in flags), F.lit(0))
    rows = cands.join(gold.select("s1_id", "cand_id", F.lit(1).alias("hit")), ["s1_id", "cand_id"], "left").fillna(0, ["hit"]).withColumn("__n", total)
    long = rows.select("hit", "__n", F.explode(F.array(*[F.struct(F.lit(f).alias("channel"), F.col(f).alias("on")) for f in flags])).alias("c")).where("c.on = 1")
    return long.groupBy("c.channel").agg(F.count(F.lit(1)).alias("pairs"), F.sum("hit").alias("hits"), F.sum(F.when(F.col("__n") == 1, F.col("hit")).otherwise(0)).alias("unique_hits"))


def slice_report(scores: DataFrame) -> DataFrame:
    """(slice, n, mean_f05, tp, n_pred, n_gold) for S1 without, with one, with two and with more matches."""
    kind = F.when(F.col("n_gold") == 0, "0").when(F.col("n_gold") == 1, "1").when(F.col("n_gold") == 2, "2").otherwise("3+")
    return scores.groupBy(kind.alias("slice")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("f05"), 5).alias("mean_f05"), F.sum("tp").alias("tp"), F.sum("n_pred").alias("n_pred"), F.sum("n_gold").alias("n_gold"))


def worst_errors(scored: DataFrame, pred: DataFrame, gold: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` false matches and the ``n`` scored misses with the highest probability."""
    key = ["s1_id", "cand_id"]
    false = pred.select(*key).join(gold.select(*key), key, "left_anti").join(scored.select(*key, "prob"), key).withColumn("kind", F.lit("false"))
    miss = gold.select(*key).join(pred.select(*key), key, "left_anti").join(scored.select(*key, "prob"), key).withColumn("kind", F.lit("miss"))
    top = lambda df: df.orderBy(F.desc("prob"), *key).limit(n)
    return top(false).unionByName(top(miss))


def _missed(cands: DataFrame, gold: DataFrame) -> DataFrame:
    return gold.select("s1_id", "cand_id").join(cands.select("s1_id", "cand_id").hint("merge"), ["s1_id", "cand_id"], "left_anti")


def _key_lists(keys: dict[str, DataFrame]) -> DataFrame:
    """(entity_id, one array for each kind): the keys of a record, which are as few as its own words and numbers."""
    long = reduce(DataFrame.unionByName, [k.select("entity_id", F.lit(i).alias("i"), "key") for i, k in enumerate(keys.values())])
    return long.groupBy("entity_id").agg(*[F.collect_set(F.when(F.col("i") == i, F.col("key"))).alias(name) for i, name in enumerate(keys)])


def _beside(pairs: DataFrame, records: DataFrame, how: str = "inner") -> DataFrame:
    """Both records' columns beside each pair: ``a_*`` and ``b_*``. Records are joined by sorting: written, they are far
    smaller than in the driver's memory."""
    side = lambda p, key: records.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{p}_{c}") for c in records.columns if c != "entity_id"]).hint("merge")
    return pairs.join(side("a", "s1_id"), "s1_id", how).join(side("b", "cand_id"), "cand_id", how)


def _shares(name: str) -> Column:
    return F.coalesce(F.arrays_overlap(f"a_{name}", f"b_{name}"), F.lit(False)).cast("int").alias(name)


def miss_report(cands: DataFrame, gold: DataFrame, keys: dict[str, DataFrame]) -> DataFrame:
    """Per gold pair that is no candidate: which keys both sides share, whatever the block's size."""
    return _beside(_missed(cands, gold), _key_lists(keys), "left").select("s1_id", "cand_id", *[_shares(k) for k in keys])


def block_distribution(sizes: DataFrame, cap: int = 50) -> DataFrame:
    """Number of blocks, median, 95th and 99th percentile and largest size, and the share of rows within the cap."""
    return sizes.groupBy("cand_source").agg(F.count(F.lit(1)).alias("blocks"), F.expr("round(percentile(n, 0.5), 6)").alias("p50"), F.expr("round(percentile(n, 0.95), 6)").alias("p95"), F.expr("round(percentile(n, 0.99), 6)").alias("p99"), F.max("n").alias("largest"), F.round(F.sum(F.when(F.col("n") <= cap, F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("within_cap"))


def exploration(records: DataFrame, gold: DataFrame) -> DataFrame:
    """Per country: rows per source (pivoted), shares of non-ASCII names and of missing addresses, and S1 singletons."""
    rows = records.groupBy("country").pivot("source", [1, 2, 3]).agg(F.count(F.lit(1))).fillna(0)
    rows = rows.select("country", *[F.col(str(i)).alias(f"n_s{i}") for i in (1, 2, 3)])
    share = lambda c: F.round(F.avg(c.cast("int")), 6)
    shares = records.groupBy("country").agg(share(F.col("raw_name").rlike(r"[^\x00-\x7F]")).alias("non_ascii"), share(F.col("raw_address") == "").alias("no_address"))
    s1 = records.where("source = 1").select(F.col("entity_id").alias("s1_id"), "country").join(gold.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n")), "s1_id", "left").fillna(0, ["n"])
    single = s1.groupBy("country").agg(share(F.col("n") == 0).alias("singletons"), F.max("n").alias("most_matches"), F.expr("round(percentile(n, 0.95), 6)").alias("p95_matches"))
    return rows.join(shares, "country").join(single, "country", "left")


def recall_at(ranked: DataFrame, gold: DataFrame, ks: list[int]) -> DataFrame:
    """(k, hits, recall) of ranked pairs (s1_id, cand_id, rank)."""
    rank = gold.join(ranked.select("s1_id", "cand_id", "rank"), ["s1_id", "cand_id"], "left")
    sums = rank.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col("rank") <= k, 1)).alias(f"h{k}") for k in ks])
    return sums.select("n", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"h{k}").alias("hits")) for k in ks])).alias("x")).select("x.k", "x.hits", F.round(F.col("x.hits") / F.col("n"), 6).alias("recall"))


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows whose columns differ between two versions of a table, with both values; missing rows count as changed."""
    a = before.select(F.col(key), F.struct(*columns).alias("was"))
    b = after.select(F.col(key), F.struct(*columns).alias("now"))
    changed = a.join(b, key, "full").where(~F.col("was").eqNullSafe(F.col("now")))
    return changed.select(key, *[F.col(f"was.{c}").alias(f"was_{c}") for c in columns], *[F.col(f"now.{c}").alias(f"now_{c}") for c in columns])


def folds(ids: DataFrame, key: str, parts: int = 5, held: int = 0) -> DataFrame:
    """(key, fold): ``val`` for one part in ``parts`` by the number in the id, the same under any partitioning."""
    number = F.regexp_extract(F.col(key).cast("string"), "([0-9]+)$", 1).cast("long")
    return ids.select(key, F.when((number * 7919 + 13) % parts == held, "val").otherwise("train").alias("fold"))


def _number(key: str):
    return F.regexp_extract(F.col(key).cast("string"), "([0-9]+)$", 1).cast("long")


def stratified(s1: DataFrame, n: int) -> DataFrame:
    """About ``n`` S1 (s1_id, country), each country by its share and one at least, in the order of a hash."""
    shares = s1.groupBy("country").agg(F.count(F.lit(1)).alias("c"))
    total = shares.agg(F.sum("c").alias("all"))
    quota = shares.join(F.broadcast(total)).select("country", F.greatest(F.lit(1), F.round(F.lit(n) * F.col("c") / F.col("all"))).cast("long").alias("quota"))
    w = W.partitionBy("country").orderBy(_number("s1_id") * 7919 % 10007, "s1_id")
    return s1.withColumn("rn", F.row_number().over(w)).join(quota, "country").where("rn <= quota").select("s1_id", "country")


def staged_recall(cands: DataFrame, gold: DataFrame, stages: int = 5) -> DataFrame:
    """(stage, country, cand_source, n_gold, n_hit, recall): recall of the pairs added up to each stage, by country and
    source with all subtotals. A column ``times`` of ``gold`` says how many pairs a row stands for."""
    hit = gold.join(cands.select("s1_id", "cand_id", "added_by").hint("merge"), ["s1_id", "cand_id"], "left")
    times = F.col("times") if "times" in gold.columns else F.lit(1).cast("long")
    sums = [F.sum(F.when(F.col("added_by") <= i, times).otherwise(0)).alias(f"h{i}") for i in range(stages)]
    per = hit.cube("country", "cand_source").agg(F.sum(times).alias("n_gold"), *sums)
    long = per.select(F.coalesce("country", F.lit("all")).alias("country"), F.coalesce(F.col("cand_source").cast("string"), F.lit("all")).alias("cand_source"), "n_gold", F.explode(F.array(*[F.struct(F.lit(i).alias("stage"), F.col(f"h{i}").alias("n_hit")) for i in range(stages)])).alias("x"))
    return long.select("x.stage", "country", "cand_source", "n_gold", "x.n_hit", F.round(F.col("x.n_hit") / F.col("n_gold"), 6).alias("recall"))


def slice_details(scored: DataFrame, pred: DataFrame, gold: DataFrame, s1: DataFrame) -> DataFrame:
    """(slice, n, value): accuracy of the best row for S1 with one match, wrong extras for those with three or more,
    and precision and recall by country and by source."""
    w = W.partitionBy("s1_id").orderBy(F.desc("prob"), F.desc("emb_score"), "cand_id")
    g = gold.select("s1_id", "cand_id", F.lit(1).alias("g"))
    n_gold = gold.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n"))
    top = scored.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("s1_id", "cand_id").join(g, ["s1_id", "cand_id"], "left")
    one = n_gold.where("n = 1").join(top, "s1_id", "left").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.coalesce("g", F.lit(0))), 6).alias("value")).select(F.lit("top1 of one match").alias("slice"), "n", "value")
    extras = pred.select("s1_id", "cand_id").join(n_gold.where("n >= 3"), "s1_id").join(g, ["s1_id", "cand_id"], "left")
    wrong = extras.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.when(F.col("g").isNull(), 1).otherwise(0)), 6).alias("value")).select(F.lit("wrong of three or more").alias("slice"), "n", "value")
    key = ["s1_id", "cand_id"]
    both = pred.select(*key, F.lit(1).alias("p")).join(g, key, "full").fillna(0, ["p", "g"]).join(s1.select("s1_id", "country"), "s1_id").withColumn("source", F.concat(F.lit("S"), F.substring("cand_id", 2, 1)))
    out = one.unionByName(wrong)
    for by in ("country", "source"):
        sums = both.groupBy(by).agg(F.sum("p").alias("np"), F.sum("g").alias("ng"), F.sum(F.col("p") * F.col("g")).alias("tp"))
        for kind, n in (("precision", "np"), ("recall", "ng")):
            out = out.unionByName(sums.select(F.concat(F.lit(f"{kind} "), F.col(by)).alias("slice"), F.col(n).alias("n"), F.when(F.col(n) > 0, F.round(F.col("tp") / F.col(n), 6)).alias("value")))
    return out


def miss_analysis(cands: DataFrame, gold: DataFrame, records: DataFrame, keys: dict[str, DataFrame], nth: int = 20) -> DataFrame:
    """Gold pairs that are no candidates: which keys both sides share, Jaccard similarities of their names and addresses,
    and the score of the S1's ``nth`` best candidate (null if it has fewer)."""
    w = W.partitionBy("s1_id").orderBy(F.desc("emb_score"), "cand_id")
    last = cands.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == nth).select("s1_id", F.col("emb_score").alias("nth_score"))
    r = records.select("entity_id", F.split("name_full", " ").alias("__n"), F.col("addr_tokens").alias("__a")).join(_key_lists(keys).hint("merge"), "entity_id", "left")
    both = _beside(_missed(cands, gold), r).join(last.hint("merge"), "s1_id", "left")
    share = lambda c: F.round(F.size(F.array_intersect(f"a_{c}", f"b_{c}")) / F.size(F.array_union(f"a_{c}", f"b_{c}")), 6)
    return both.select("s1_id", "cand_id", *[_shares(k) for k in keys], share("__n").alias("name_jaccard"), share("__a").alias("addr_jaccard"), "nth_score")


def misses_sample(misses: DataFrame, n: int = 50) -> DataFrame:
    """``n`` misses for a look, in the order of a hash."""
    return misses.orderBy(_number("s1_id") * 7919 % 10007, "s1_id", "cand_id").limit(n)


def key_coverage(records: DataFrame, keys: dict[str, DataFrame]) -> DataFrame:
    """(country, key, share): the share of a country's records that have a key of each kind."""
    out = None
    total = records.groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    for name, k in keys.items():
        have = records.select("entity_id", "country").join(k.select("entity_id").distinct(), "entity_id", "left_semi").groupBy("country").agg(F.count(F.lit(1)).alias("h"))
        part = total.join(have, "country", "left").select("country", F.lit(name).alias("key"), F.round(F.coalesce("h", F.lit(0)) / F.col("n"), 6).alias("share"))
        out = part if out is None else out.unionByName(part)
    return out


def quartiles(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """(by, feature, p25, p50, p75) of numeric columns, nulls left out."""
    long = df.select(by, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in columns])).alias("f")).select(by, "f.*")
    return long.groupBy(by, "feature").agg(*[F.expr(f"round(percentile(x, {p / 100}), 6)").alias(f"p{p}") for p in (25, 50, 75)])


def gold_facts(records: DataFrame, gold: DataFrame) -> DataFrame:
    """(fact, n): S1 by their number of matches, candidates with several S1, pairs across countries, and pool records
    without a match."""
    s1 = records.where("source = 1").select(F.col("entity_id").alias("s1_id")).join(gold.groupBy("s1_id").agg(F.count(F.lit(1)).alias("m")), "s1_id", "left").fillna(0, ["m"])
    hist = s1.groupBy("m").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("matches "), F.col("m").cast("string")).alias("fact"), "n")
    several = gold.groupBy("cand_id").agg(F.count(F.lit(1)).alias("c")).agg(F.count(F.when(F.col("c") > 1, 1)).alias("n")).select(F.lit("several s1").alias("fact"), "n")
    where = records.select("entity_id", "country")
    across = gold.select("s1_id", "cand_id").join(where.toDF("s1_id", "a"), "s1_id").join(where.toDF("cand_id", "b"), "cand_id").agg(F.count(F.when(F.col("a") != F.col("b"), 1)).alias("n")).select(F.lit("across countries").alias("fact"), "n")
    rest = records.where("source > 1").join(gold.select(F.col("cand_id").alias("entity_id")), "entity_id", "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit("distractors").alias("fact"), "n")
    return hist.unionByName(several).unionByName(across).unionByName(rest)


def with_distractors(records: DataFrame, s1: DataFrame, gold: DataFrame, ratio: int = 5) -> DataFrame:
    """Sampled S1, their matches, and ``ratio`` other pool records of the country per S1, in the order of a hash."""
    own = records.join(s1.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_semi").withColumn("role", F.lit("s1"))
    matched = gold.join(s1, "s1_id", "left_semi").select(F.col("cand_id").alias("entity_id")).distinct()
    hits = records.join(matched, "entity_id", "left_semi").withColumn("role", F.lit("match"))
    quota = own.groupBy("country").agg((F.count(F.lit(1)) * ratio).alias("quota"))
    rest = records.where("source > 1").join(matched, "entity_id", "left_anti")
    # a country's first rows by the hash: counts per hash value tell up to which one rows are needed at all
    rest = rest.withColumn("__h", _number("entity_id") * 7919 % 10007)
    counts = rest.groupBy("country", "__h").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("country").orderBy("__h").rowsBetween(W.unboundedPreceding, -1))
    edge = counts.withColumn("b", F.coalesce(before, F.lit(0))).join(quota, "country").where("b < quota").groupBy("country", "quota").agg(F.max("__h").alias("edge"))
    near = rest.join(edge, "country").where("__h <= edge")
    w = W.partitionBy("country").orderBy("__h", "entity_id")
    few = near.withColumn("rn", F.row_number().over(w)).where("rn <= quota").drop("rn", "quota", "edge", "__h").withColumn("role", F.lit("distractor"))
    return own.unionByName(hits).unionByName(few.select(*own.columns))
