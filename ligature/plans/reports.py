"""Queries: metrics, recall, distributions, samples, checks of results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocking, candidates, decide, features, metrics
from ..sources import records, sinks
from . import sql as S
from . import tables as T
from .registry import query


def _scores(norm):
    return metrics.entity_scores(T.matched(norm), T.gold(norm), T.s1_of(norm))


@query("SELECT count(*) AS n_s1, round(avg(f05), 5) AS macro_f05 FROM scores")
def macro_f05(spark, d):
    norm = T.normalized(spark, d)
    return metrics.macro_f05(T.matched(norm), T.gold(norm), T.s1_of(norm))


@query("SELECT s1_id, tp, n_pred, n_gold, f05 FROM scores")
def entity_f05(spark, d):
    return _scores(T.normalized(spark, d))


@query("""SELECT p.n_gold, p.n_hit, round(p.n_hit / p.n_gold, 6) AS pair_recall, e.entity_recall, c.mean_cands, c.p95_cands, c.max_cands FROM
    (SELECT count(*) AS n_gold, count(c.s1_id) AS n_hit FROM gold g LEFT JOIN cand c ON c.s1_id = g.s1_id AND c.cand_id = g.cand_id) p,
    (SELECT round(avg(h), 6) AS entity_recall FROM (SELECT g.s1_id, min(CASE WHEN c.s1_id IS NULL THEN 0 ELSE 1 END) AS h FROM gold g LEFT JOIN cand c ON c.s1_id = g.s1_id AND c.cand_id = g.cand_id GROUP BY g.s1_id)) e,
    (SELECT round(avg(n), 6) AS mean_cands, round(quantile_cont(n, 0.95), 6) AS p95_cands, max(n) AS max_cands FROM (SELECT s1.s1_id, count(c.cand_id) AS n FROM s1 LEFT JOIN cand c ON c.s1_id = s1.s1_id GROUP BY s1.s1_id)) c""")
def recall_report(spark, d):
    norm = T.normalized(spark, d)
    made = metrics.recall_report(T.candidate_table(norm), T.gold(norm), T.s1_of(norm))
    return made.withColumn("n_hit", F.col("n_hit").cast("long"))


@query("""SELECT coalesce(country, 'all') AS country, coalesce(CAST(cand_source AS VARCHAR), 'all') AS cand_source, count(*) AS n_gold, count(hit) AS n_hit, round(count(hit) / count(*), 6) AS recall
    FROM (SELECT g.country, g.cand_source, c.s1_id AS hit FROM gold g LEFT JOIN cand c ON c.s1_id = g.s1_id AND c.cand_id = g.cand_id) GROUP BY CUBE (country, cand_source)""")
def recall_cube(spark, d):
    norm = T.normalized(spark, d)
    return metrics.recall_cube(T.candidate_table(norm), T.gold(norm)).withColumn("n_hit", F.col("n_hit").cast("long"))


@query(" UNION ALL ".join(f"SELECT '{f}' AS channel, count(*) AS pairs, count(g.s1_id) AS hits, count(CASE WHEN ch_addr + ch_skel + ch_rare + ch_k3 = 1 THEN g.s1_id END) AS unique_hits FROM cand c LEFT JOIN gold g ON g.s1_id = c.s1_id AND g.cand_id = c.cand_id WHERE {f} = 1 HAVING count(*) > 0" for f in T.FLAGS))
def channel_report(spark, d):
    norm = T.normalized(spark, d)
    made = metrics.channel_report(T.candidate_table(norm), T.gold(norm), T.FLAGS)
    return made.withColumns({c: F.col(c).cast("long") for c in ("hits", "unique_hits")})


@query("SELECT CASE WHEN n_gold = 0 THEN '0' WHEN n_gold = 1 THEN '1' WHEN n_gold = 2 THEN '2' ELSE '3+' END AS slice, count(*) AS n, round(avg(f05), 5) AS mean_f05, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(n_pred) AS BIGINT) AS n_pred, CAST(sum(n_gold) AS BIGINT) AS n_gold FROM scores GROUP BY 1")
def slice_report(spark, d):
    return metrics.slice_report(_scores(T.normalized(spark, d)))


@query("""(SELECT k.s1_id, k.cand_id, k.prob, 'false' AS kind FROM kept k LEFT JOIN gold g ON g.s1_id = k.s1_id AND g.cand_id = k.cand_id WHERE g.s1_id IS NULL ORDER BY k.prob DESC, k.s1_id, k.cand_id LIMIT 30)
    UNION ALL (SELECT g.s1_id, g.cand_id, p.prob, 'miss' FROM gold g JOIN prob p ON p.s1_id = g.s1_id AND p.cand_id = g.cand_id LEFT JOIN kept k ON k.s1_id = g.s1_id AND k.cand_id = g.cand_id WHERE k.s1_id IS NULL ORDER BY p.prob DESC, g.s1_id, g.cand_id LIMIT 30)""")
def worst_errors(spark, d):
    norm = T.normalized(spark, d)
    return metrics.worst_errors(T.scored(norm), T.matched(norm), T.gold(norm)).select("s1_id", "cand_id", "prob", "kind")


@query(f"""SELECT g.s1_id, g.cand_id, CASE WHEN EXISTS (SELECT 1 FROM k_skel a JOIN k_skel b ON a.key = b.key WHERE a.entity_id = g.s1_id AND b.entity_id = g.cand_id) THEN 1 ELSE 0 END AS skel, CASE WHEN EXISTS (SELECT 1 FROM k_k3 a JOIN k_k3 b ON a.key = b.key WHERE a.entity_id = g.s1_id AND b.entity_id = g.cand_id) THEN 1 ELSE 0 END AS k3
    FROM gold g LEFT JOIN ({S.pairs('k_k3')}) c ON c.s1_id = g.s1_id AND c.cand_id = g.cand_id WHERE c.s1_id IS NULL""")
def miss_report(spark, d):
    norm = T.normalized(spark, d)
    k3 = blocking.number_keys(norm, "K3")
    return metrics.miss_report(blocking.key_join(k3), T.gold(norm), {"skel": blocking.skeleton_keys(norm), "k3": k3})


@query("SELECT source - 2 AS cand_source, count(*) AS blocks, round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.95), 6) AS p95, round(quantile_cont(n, 0.99), 6) AS p99, max(n) AS largest, round(sum(CASE WHEN n <= 3 THEN n ELSE 0 END) / sum(n), 6) AS within_cap FROM (SELECT source, key, count(*) AS n FROM k_skel WHERE source > 1 GROUP BY ALL) GROUP BY source")
def block_distribution(spark, d):
    return metrics.block_distribution(blocking.block_sizes(blocking.skeleton_keys(T.normalized(spark, d))), 3)


@query("""SELECT r.*, g.singletons, g.most_matches, g.p95_matches FROM (SELECT country, count(CASE WHEN source = 1 THEN 1 END) AS n_s1, count(CASE WHEN source = 2 THEN 1 END) AS n_s2, count(CASE WHEN source = 3 THEN 1 END) AS n_s3,
      round(avg(CASE WHEN regexp_matches(raw_name, '[^\\x00-\\x7F]') THEN 1 ELSE 0 END), 6) AS non_ascii, round(avg(CASE WHEN raw_address = '' THEN 1 ELSE 0 END), 6) AS no_address FROM rec GROUP BY country) r
    LEFT JOIN (SELECT country, round(avg(CASE WHEN n = 0 THEN 1 ELSE 0 END), 6) AS singletons, max(n) AS most_matches, round(quantile_cont(n, 0.95), 6) AS p95_matches FROM (SELECT s1.s1_id, s1.country, count(gold.cand_id) AS n FROM s1 LEFT JOIN gold ON gold.s1_id = s1.s1_id GROUP BY ALL) GROUP BY country) g ON g.country = r.country""")
def eda_report(spark, d):
    norm = T.normalized(spark, d)
    return metrics.exploration(norm, T.gold(norm))


@query("SELECT CAST(k.k AS INTEGER) AS k, count(CASE WHEN r.rank <= k.k THEN 1 END) AS hits, round(count(CASE WHEN r.rank <= k.k THEN 1 END) / count(*), 6) AS recall FROM gold g LEFT JOIN (SELECT s1_id, cand_id, row_number() OVER (PARTITION BY s1_id ORDER BY prob DESC, emb_score DESC, cand_id) AS rank FROM prob) r ON r.s1_id = g.s1_id AND r.cand_id = g.cand_id, (SELECT unnest([5, 10, 20]) AS k) k GROUP BY k.k")
def recall_at_k(spark, d):
    from pyspark.sql import Window as W

    norm = T.normalized(spark, d)
    ranked = T.scored(norm).withColumn("rank", F.row_number().over(W.partitionBy("s1_id").orderBy(F.desc("prob"), F.desc("emb_score"), "cand_id")))
    return metrics.recall_at(ranked, T.gold(norm), [5, 10, 20])


_STATS = ["name_jaccard", "num_jaccard", "addr_jaccard", "len_diff", "house_match", "emb_score"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS feature, CAST(min({c}) AS DOUBLE) AS least, CAST(max({c}) AS DOUBLE) AS most, round(avg({c}), 6) AS mean, round(avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 6) AS missing, round(avg(CASE WHEN label = 1 THEN {c} END), 6) AS mean_pos, round(avg(CASE WHEN label = 0 THEN {c} END), 6) AS mean_neg FROM (SELECT s.*, CASE WHEN g.s1_id IS NULL THEN 0 ELSE 1 END AS label FROM sets s LEFT JOIN gold g ON g.s1_id = s.s1_id AND g.cand_id = s.cand_id)" for c in _STATS))
def feature_statistics(spark, d):
    norm = T.normalized(spark, d)
    return features.statistics(candidates.label(T.set_features(norm), T.gold(norm)), _STATS, "label")


@query("SELECT entity_id, CASE WHEN (CAST(substr(entity_id, 4) AS BIGINT) * 7919 + 13) % 5 = 0 THEN 'val' ELSE 'train' END AS fold FROM rec WHERE source = 1")
def split_folds(spark, d):
    return metrics.folds(records.catalog_records(spark, d).where("source = 1"), "entity_id")


@query("""SELECT entity_id, 's1' AS role FROM norm WHERE source = 1 AND CAST(substr(entity_id, 4) AS BIGINT) % 10 = 0 UNION ALL SELECT DISTINCT cand_id, 'match' FROM gold WHERE CAST(substr(s1_id, 4) AS BIGINT) % 10 = 0
    UNION ALL SELECT entity_id, 'distractor' FROM (SELECT n.entity_id, row_number() OVER (PARTITION BY n.country ORDER BY CAST(substr(n.entity_id, 4) AS BIGINT) * 7919 % 10007, n.entity_id) AS rn, q.quota FROM norm n JOIN (SELECT country, count(*) * 2 AS quota FROM norm WHERE source = 1 AND CAST(substr(entity_id, 4) AS BIGINT) % 10 = 0 GROUP BY country) q ON q.country = n.country
      WHERE n.source > 1 AND n.entity_id NOT IN (SELECT cand_id FROM gold WHERE CAST(substr(s1_id, 4) AS BIGINT) % 10 = 0)) WHERE rn <= quota""")
def sample_distractors(spark, d):
    norm = T.normalized(spark, d)
    s1 = T.s1_of(norm).where(F.expr("cast(substring(s1_id, 4) as bigint) % 10 = 0")).select("s1_id")
    return metrics.with_distractors(norm, s1, T.gold(norm), 2).select("entity_id", "role")


@query("SELECT entity_id, name_full AS was_name, upper(name_full) AS now_name FROM norm WHERE entity_id LIKE '%7'")
def snapshot_diff(spark, d):
    norm = T.normalized(spark, d).select("entity_id", F.col("name_full").alias("name"))
    after = norm.withColumn("name", F.when(F.col("entity_id").endswith("7"), F.upper("name")).otherwise(F.col("name")))
    return metrics.snapshot_diff(norm, after, "entity_id", ["name"])


@query("""SELECT 'repeated_id' AS rule, count(*) AS n FROM s1 WHERE s1_id LIKE '%3' UNION ALL SELECT 'missing_s1', count(*) FROM s1 WHERE s1_id LIKE '%9' UNION ALL SELECT 'unknown_prefix', count(*) FROM s1 WHERE s1_id LIKE '%6'
    UNION ALL SELECT 'duplicate_s1', 0 UNION ALL SELECT 's1_in_list', count(*) FROM s1 WHERE s1_id LIKE '%0' UNION ALL SELECT 'extra_s1', 0
    UNION ALL SELECT 'not_a_candidate', count(*) FROM s1 WHERE s1_id LIKE '%6' OR s1_id LIKE '%0' UNION ALL SELECT 'unknown_id', count(*) FROM s1 WHERE s1_id LIKE '%6' OR s1_id LIKE '%0'""")
def validate_output(spark, d):
    """Faults are put into a result on purpose; the report counts them."""
    known = records.catalog_records(spark, d)
    s1 = T.s1_of(known).select("s1_id")
    ends = lambda x: F.col("s1_id").endswith(x)
    rows = s1.where(~ends("9")).withColumn("ids", F.when(ends("3"), "S2-1,S2-1").when(ends("6"), "X-1").when(ends("0"), "S1-4").otherwise(""))
    return sinks.validate(rows, s1, s1.withColumn("cand_id", F.lit("S2-1")), known).select("rule", "n")


@query("SELECT s1_id, CAST(coalesce((SELECT string_agg(cand_id, ',' ORDER BY emb_score DESC, cand_id) FROM cand c WHERE c.s1_id = s1.s1_id), '') AS VARCHAR) AS ids FROM s1")
def candidate_lists(spark, d):
    norm = T.normalized(spark, d)
    s1 = sinks.ordered_ids(T.s1_of(norm), "s1_id")
    return sinks.result_lists(T.candidate_table(norm).withColumn("rank", -F.col("emb_score")), s1).select("s1_id", "ids")


@query("SELECT country, round(avg(CASE WHEN ids = '' THEN 1 ELSE 0 END), 6) AS empty, round(avg(n), 6) AS mean_matches FROM (SELECT s1.s1_id, s1.country, CASE WHEN count(k.cand_id) = 0 THEN '' ELSE 'x' END AS ids, count(k.cand_id) AS n FROM s1 LEFT JOIN kept k ON k.s1_id = s1.s1_id GROUP BY ALL) GROUP BY country")
def output_sanity(spark, d):
    norm = T.normalized(spark, d)
    s1 = T.s1_of(norm)
    out = decide.decide(T.scored(norm), s1).join(s1, "s1_id")
    n = F.when(F.col("matched_ids") == "", 0).otherwise(F.size(F.split("matched_ids", ",")))
    return out.groupBy("country").agg(F.round(F.avg((n == 0).cast("int")), 6).alias("empty"), F.round(F.avg(n), 6).alias("mean_matches"))
