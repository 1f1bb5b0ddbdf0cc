"""Queries: the candidate table, features, decisions, models."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import blocking, candidates, decide, features, models
from ..session import stage
from ..sources import records
from . import tables as T
from .registry import query

_FLAGS = ", ".join(T.FLAGS)


def _int(*cols: str):
    return [F.col(c).cast("int").alias(c) for c in cols]


@query(f"SELECT s1_id, cand_id, cand_source, {_FLAGS}, emb_score FROM scored0")
def channel_union(spark, d):
    return T.uniting(stage(T.normalizing(spark, d), "normalized")).select("s1_id", "cand_id", "cand_source", *T.FLAGS, "emb_score")


@query(f"SELECT s1_id, cand_id, cand_source, {_FLAGS}, emb_score FROM cand")
def candidate_cap(spark, d):
    return T.candidate_table(T.normalized(spark, d)).select("s1_id", "cand_id", "cand_source", *T.FLAGS, "emb_score")


@query("""SELECT s1_id, cand_id, n_new, emb_score FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY n_new DESC, emb_score DESC, cand_id) AS rn FROM
    (SELECT s1_id, cand_id, ch_addr + ch_skel AS n_new, emb_score FROM scored0 WHERE ch_k3 = 0 AND ch_addr + ch_skel > 0)) WHERE rn <= 5""")
def budget_merge(spark, d):
    whole = T.united(T.normalized(spark, d))
    extras = {c: whole.where(F.col(c) == 1).select("s1_id", "cand_id", "emb_score") for c in ("ch_addr", "ch_skel")}
    return candidates.budget_merge(whole.where("ch_k3 = 1"), extras, 5).select("s1_id", "cand_id", "n_new", "emb_score")


@query("""SELECT c.s1_id, c.cand_id, CASE WHEN r.rank IS NULL THEN 0 ELSE 1 END AS ch_tfidf, coalesce(r.rank, 99) AS tfidf_rank FROM cand c LEFT JOIN
    (SELECT s1_id, cand_id, rank FROM (SELECT s1_id, cand_id, row_number() OVER (PARTITION BY s1_id ORDER BY emb_score DESC, cand_id) AS rank FROM scored0) WHERE rank <= 10) r ON r.s1_id = c.s1_id AND r.cand_id = c.cand_id""")
def annotate(spark, d):
    whole = T.united(T.normalized(spark, d))
    w = W.partitionBy("s1_id").orderBy(F.desc("emb_score"), "cand_id")
    found = whole.withColumn("tfidf_rank", F.row_number().over(w)).where("tfidf_rank <= 10")
    made = candidates.annotate(candidates.cap(whole, ["ch_addr", "ch_k3"]), found, "ch_tfidf", "tfidf_rank")
    return made.select("s1_id", "cand_id", "ch_tfidf", "tfidf_rank")


@query("SELECT s1_id, cand_id, CASE WHEN ch_addr = 1 OR ch_k3 = 1 THEN 0 WHEN ch_skel = 1 THEN 1 ELSE 2 END AS added_by FROM cand")
def provenance(spark, d):
    made = candidates.provenance(T.candidate_table(T.normalized(spark, d)), [(1, ["ch_skel"]), (2, ["ch_rare"])], ["ch_addr", "ch_k3"])
    return made.select("s1_id", "cand_id", "added_by")


@query("""SELECT s1_id, cand_id, rn FROM (SELECT s1_id, cand_id, row_number() OVER (PARTITION BY s1_id ORDER BY emb_score DESC, cand_id) AS rn FROM scored0 WHERE ch_k3 = 0 AND ch_skel = 1) WHERE rn <= 3""")
def add_absent(spark, d):
    whole = T.united(T.normalized(spark, d))
    new = candidates.add_absent(whole.where("ch_k3 = 1"), whole.where("ch_skel = 1"), 3, F.desc("emb_score"))
    return new.select("s1_id", "cand_id", F.row_number().over(W.partitionBy("s1_id").orderBy(F.desc("emb_score"), "cand_id")).alias("rn"))


@query("SELECT c.s1_id, c.cand_id, CASE WHEN g.s1_id IS NULL THEN 0 ELSE 1 END AS label FROM cand c LEFT JOIN gold g ON g.s1_id = c.s1_id AND g.cand_id = c.cand_id")
def label_pairs(spark, d):
    norm = T.normalized(spark, d)
    return candidates.label(T.candidate_table(norm), T.gold(norm)).select("s1_id", "cand_id", "label")


@query("SELECT s1_id, cand_id, cand_source FROM gold")
def gt_long(spark, d):
    lists = T.gold(T.normalized(spark, d)).groupBy("s1_id").agg(F.array_join(F.collect_list("cand_id"), ",").alias("matched_entity_ids"))
    return records.gold_pairs(lists.withColumnRenamed("s1_id", "source1_entity_id"))


@query("SELECT entity_id, CAST(source AS BIGINT) * 1000000000000 + CAST(substr(entity_id, 4) AS BIGINT) AS code, entity_id AS back FROM rec")
def encoded_ids(spark, d):
    made = records.catalog_records(spark, d).select("entity_id", records.encoded_id("entity_id").alias("code"))
    return made.withColumn("back", records.decoded_id("code"))


@query("SELECT s1_id, cand_id, name_jaccard, num_jaccard, addr_jaccard, len_diff FROM sets")
def pair_features_sets(spark, d):
    return T.set_features(T.normalized(spark, d)).select("s1_id", "cand_id", "name_jaccard", "num_jaccard", "addr_jaccard", *_int("len_diff"))


@query("""SELECT c.s1_id, c.cand_id, CASE WHEN a.legal = '' OR b.legal = '' THEN -1 WHEN a.legal = b.legal THEN 1 ELSE 0 END AS legal_match,
    CASE WHEN a.house_no = '' OR b.house_no = '' THEN -1 WHEN a.house_no = b.house_no THEN 1 ELSE 0 END AS house_match, CASE WHEN a.zip_pin = '' OR b.zip_pin = '' THEN -1 WHEN a.zip_pin = b.zip_pin THEN 1 ELSE 0 END AS zip_match, CASE WHEN len(a.house_cands) = 0 OR len(b.house_cands) = 0 THEN -1 WHEN list_has_any(a.house_cands, b.house_cands) THEN 1 ELSE 0 END AS house_cand_match,
    CASE WHEN string_split(a.core_name, ' ')[1] = string_split(b.core_name, ' ')[1] AND a.core_name <> '' THEN 1 ELSE 0 END AS first_tok_match, CASE WHEN a.addr_norm = '' OR b.addr_norm = '' THEN 1 ELSE 0 END AS addr_missing_any
    FROM cand c JOIN norm a ON a.entity_id = c.s1_id JOIN norm b ON b.entity_id = c.cand_id""")
def pair_features_flags(spark, d):
    norm = T.normalized(spark, d)
    made = features.flag_features(features.with_records(T.candidate_table(norm), T.full_records(norm)))
    return made.select("s1_id", "cand_id", "legal_match", "house_match", "zip_match", "house_cand_match", "first_tok_match", "addr_missing_any")


@query("""SELECT c.s1_id, c.cand_id, round(jaro_winkler_similarity(a.core_name, b.core_name), 6) AS jw_core, round(1 - levenshtein(a.core_name, b.core_name) / greatest(length(a.core_name), length(b.core_name)), 6) AS lev_core
    FROM cand c JOIN norm a ON a.entity_id = c.s1_id JOIN norm b ON b.entity_id = c.cand_id""")
def pair_features_fuzzy(spark, d):
    norm = T.normalized(spark, d)
    made = features.fuzzy_features(features.with_records(T.candidate_table(norm), T.full_records(norm)))
    return made.select("s1_id", "cand_id", T.rounded(F.col("jw_core")).alias("jw_core"), T.rounded(F.col("lev_core")).alias("lev_core"))


@query()
def pair_features_ratios(spark, d):
    """Ratios of all pairs; string_ratios and the tests hold them against other computations."""
    norm = T.normalized(spark, d)
    made = features.fuzzy_features(features.with_records(T.candidate_table(norm), T.full_records(norm)))
    cols = ["name_token_sort", "name_token_set", "core_ratio", "core_partial", "skel_ratio", "addr_token_set", "lcs_core", "compact_ratio", "dict_name_ratio", "k_ratio"]
    return made.select("s1_id", "cand_id", *[T.rounded(F.col(c)).alias(c) for c in cols])


@query("""SELECT c.s1_id, c.cand_id, round(ln(1 + coalesce(x.n, 0)), 6) AS name_freq_s1, round(ln(1 + coalesce(y.n, 0)), 6) AS name_freq_cand FROM cand c JOIN norm a ON a.entity_id = c.s1_id JOIN norm b ON b.entity_id = c.cand_id
    LEFT JOIN (SELECT country, core_name, count(*) AS n FROM norm GROUP BY ALL) x ON x.country = a.country AND x.core_name = a.core_name LEFT JOIN (SELECT country, core_name, count(*) AS n FROM norm GROUP BY ALL) y ON y.country = b.country AND y.core_name = b.core_name""")
def name_frequency(spark, d):
    norm = T.normalized(spark, d)
    pairs = features.with_records(T.candidate_table(norm), norm.select("entity_id", "country", "core_name"))
    made = features.frequency(features.frequency(pairs, norm, "core_name", "a", "name_freq_s1"), norm, "core_name", "b", "name_freq_cand")
    return made.select("s1_id", "cand_id", T.rounded(F.col("name_freq_s1")).alias("name_freq_s1"), T.rounded(F.col("name_freq_cand")).alias("name_freq_cand"))


@query("""SELECT c.s1_id, c.cand_id, count(y.token) AS rare_tok_overlap FROM cand c LEFT JOIN (SELECT * FROM rare WHERE rk <= 3) x ON x.entity_id = c.s1_id LEFT JOIN (SELECT * FROM rare WHERE rk <= 3) y ON y.entity_id = c.cand_id AND y.token = x.token GROUP BY ALL""")
def rare_overlap(spark, d):
    norm = T.normalized(spark, d)
    ranked = blocking.ranked_tokens(norm, blocking.token_frequencies(norm))
    return features.rare_overlap(T.candidate_table(norm), ranked).select("s1_id", "cand_id", F.col("rare_tok_overlap").cast("long").alias("rare_tok_overlap"))


@query("SELECT s1_id, cand_id, ch_k3 AS ch_keyx, ch_addr + ch_skel + ch_rare + ch_k3 AS n_channels FROM cand")
def channel_features(spark, d):
    return features.channel_features(T.candidate_table(T.normalized(spark, d)), T.FLAGS).select("s1_id", "cand_id", *_int("ch_keyx", "n_channels"))


@query("""SELECT s1_id, cand_id, round(max(emb_score) OVER w - emb_score, 6) AS gap_to_best, count(*) OVER w AS n_cands, round(CASE WHEN max(emb_score) OVER w > 0 THEN emb_score / max(emb_score) OVER w ELSE 0 END, 6) AS emb_score_rel,
    round(CASE WHEN stddev_pop(emb_score) OVER w > 1e-9 THEN (emb_score - avg(emb_score) OVER w) / stddev_pop(emb_score) OVER w ELSE 0 END, 4) AS emb_score_z, rank() OVER (PARTITION BY s1_id ORDER BY emb_score DESC) AS emb_score_rk FROM cand WINDOW w AS (PARTITION BY s1_id)""")
def ctx_relative(spark, d):
    made = features.relative(features.context(T.candidate_table(T.normalized(spark, d))), "emb_score")
    return made.select("s1_id", "cand_id", T.rounded(F.col("gap_to_best")).alias("gap_to_best"), "n_cands", T.rounded(F.col("emb_score_rel")).alias("emb_score_rel"), F.round("emb_score_z", 4).alias("emb_score_z"), "emb_score_rk")


@query("SELECT s1_id, cand_id, rank() OVER (PARTITION BY cand_id ORDER BY emb_score DESC) AS reverse_rank FROM cand")
def reverse_rank(spark, d):
    return features.reverse_rank(T.candidate_table(T.normalized(spark, d))).select("s1_id", "cand_id", "reverse_rank")


_NEAR = "SELECT a.id AS s1_id, b.id AS cand_id, round(list_inner_product(a.v, b.v), 6) AS emb_score, row_number() OVER (PARTITION BY a.id ORDER BY round(list_inner_product(a.v, b.v), 6) DESC, b.id) AS rn FROM vec a JOIN vec b ON a.country = b.country AND a.source = 0 AND b.source > 0"


@query(f"""SELECT c.s1_id, c.cand_id, coalesce(round(max(list_inner_product(x.v, y.v)), 6), 0) AS support FROM (SELECT * FROM ({_NEAR}) WHERE rn <= 8) c JOIN vec x ON x.id = c.cand_id
    LEFT JOIN (SELECT * FROM ({_NEAR}) WHERE rn <= 5) o ON o.s1_id = c.s1_id AND o.cand_id <> c.cand_id LEFT JOIN vec y ON y.id = o.cand_id GROUP BY c.s1_id, c.cand_id""")
def support(spark, d):
    from ..operators import topk

    v = records.vectors(spark, d)
    found = topk.dense_topk(v.where("source = 0"), v.where("source > 0"), 8)
    pairs = found.select(F.col("q").alias("s1_id"), F.col("p").alias("cand_id"), T.rounded(F.col("score")).alias("emb_score"))
    return features.support(pairs, v.select("id", "v")).select("s1_id", "cand_id", T.rounded(F.col("support")).alias("support"))


@query("SELECT s1.s1_id, coalesce(k.ids, '') AS matched_ids FROM s1 LEFT JOIN (SELECT s1_id, string_agg(cand_id, ',' ORDER BY cand_id) AS ids FROM kept GROUP BY s1_id) k ON k.s1_id = s1.s1_id")
def rule_resolve(spark, d):
    """From records to matches: normalise, block, unite, cap, score by rule, decide; nothing is reused."""
    norm = stage(T.normalizing(spark, d), "normalized")
    return decide.decide(T.scored(norm), T.s1_of(norm))


@query("""SELECT c.s1_id, c.cand_id, CASE WHEN CAST(substr(c.s1_id, 4) AS BIGINT) % 10 = 0 THEN 0 ELSE 1 END AS is_competitor FROM cand c WHERE CAST(substr(c.s1_id, 4) AS BIGINT) % 10 = 0
    OR c.cand_id IN (SELECT cand_id FROM cand WHERE CAST(substr(s1_id, 4) AS BIGINT) % 10 = 0)""")
def competitor_rows(spark, d):
    norm = T.normalized(spark, d)
    sampled = T.s1_of(norm).where(F.expr("cast(substring(s1_id, 4) as bigint) % 10 = 0"))
    return features.competitors(T.candidate_table(norm), sampled).select("s1_id", "cand_id", "is_competitor")


@query("SELECT s1_id, cand_id, prob FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY prob DESC, emb_score DESC, cand_id) AS rn FROM prob) WHERE rn <= 15")
def topk_prune(spark, d):
    return candidates.top_k(T.scored(T.normalized(spark, d)), 15, "prob").select("s1_id", "cand_id", "prob")


@query("""SELECT k.k, count(CASE WHEN r.rn <= k.k THEN 1 END) AS kept, round(count(CASE WHEN r.rn <= k.k THEN 1 END) / count(*), 6) AS recall FROM (SELECT unnest(generate_series(1, 40)) AS k) k,
    (SELECT p.*, row_number() OVER (PARTITION BY p.s1_id ORDER BY prob DESC, emb_score DESC, p.cand_id) AS rn, g.s1_id AS hit FROM prob p LEFT JOIN gold g ON g.s1_id = p.s1_id AND g.cand_id = p.cand_id) r WHERE r.hit IS NOT NULL GROUP BY k.k""")
def topk_choose(spark, d):
    norm = T.normalized(spark, d)
    return candidates.choose_k(candidates.label(T.scored(norm), T.gold(norm)), score="prob").select("k", "kept", "recall")


@query("SELECT s1_id, cand_id, prob FROM excl")
def exclusivity(spark, d):
    return decide.exclusivity(T.scored(T.normalized(spark, d))).select("s1_id", "cand_id", "prob")


@query("SELECT s1_id, cand_id, prob FROM excl_m")
def exclusivity_margin(spark, d):
    return decide.exclusivity(T.scored(T.normalized(spark, d)), 0.05).select("s1_id", "cand_id", "prob")


@query("SELECT s1_id, cand_id, prob FROM kept")
def thresholds(spark, d):
    return T.matched(T.normalized(spark, d)).select("s1_id", "cand_id", "prob")


@query("""SELECT s1.s1_id, coalesce(k.ids, '') AS matched_ids FROM s1 LEFT JOIN (SELECT s1_id, string_agg(cand_id, ',' ORDER BY cand_id) AS ids FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY prob DESC, emb_score DESC, cand_id) AS rn, max(prob) OVER (PARTITION BY s1_id) AS top FROM excl_m) WHERE top >= 0.4 AND (rn = 1 OR prob >= 0.6) GROUP BY s1_id) k ON k.s1_id = s1.s1_id""")
def decide_margin(spark, d):
    norm = T.normalized(spark, d)
    return decide.decide(T.scored(norm), T.s1_of(norm), 0.4, 0.6, 0.05)


_STACKED = """SELECT *, row_number() OVER w - 1 AS rank, max(prob) OVER (PARTITION BY s1_id) AS prob_T, first(cand_id) OVER w AS t, count(CASE WHEN prob > 0.5 THEN 1 END) OVER (PARTITION BY s1_id) AS num_gt_05 FROM
    (SELECT *, coalesce(CASE WHEN crn = 1 AND prob > 0.05 THEN nxt ELSE top END, 0) AS best_competing_prob, n03 - CASE WHEN prob > 0.3 THEN 1 ELSE 0 END AS other_gt_03 FROM
      (SELECT *, row_number() OVER w AS crn, lead(CASE WHEN prob > 0.05 THEN prob END) OVER w AS nxt, max(CASE WHEN prob > 0.05 THEN prob END) OVER (PARTITION BY cand_id) AS top, count(CASE WHEN prob > 0.3 THEN 1 END) OVER (PARTITION BY cand_id) AS n03 FROM prob
        WINDOW w AS (PARTITION BY cand_id ORDER BY CASE WHEN prob > 0.05 THEN prob END DESC NULLS LAST, s1_id))) WHERE prob >= 0.05 WINDOW w AS (PARTITION BY s1_id ORDER BY prob DESC, emb_score DESC, cand_id)"""
_HOUSE = "CASE WHEN {a}.house_no = '' OR {b}.house_no = '' THEN -1 WHEN {a}.house_no = {b}.house_no THEN 1 ELSE 0 END"
_NUMS = "CASE WHEN len(list_distinct(list_concat({a}.num_tokens, {b}.num_tokens))) > 0 THEN len(list_intersect({a}.num_tokens, {b}.num_tokens)) / len(list_distinct(list_concat({a}.num_tokens, {b}.num_tokens))) ELSE 0 END"
_STACK = ["rank", "is_top1", "prob_T", "gap_to_T", "num_gt_05", "house_match_T", "num_jaccard_T", "same_src_T", "h_other_mean", "h_other_max", "j_other_mean", "j_other_max", "best_competing_prob", "prob_minus_comp", "other_gt_03"]


@query(f"""SELECT r.s1_id, r.cand_id, r.rank, CASE WHEN r.rank = 0 THEN 1 ELSE 0 END AS is_top1, r.prob_T, round(r.prob_T - r.prob, 6) AS gap_to_T, r.num_gt_05, CASE WHEN r.rank = 0 THEN 0 ELSE {_HOUSE.format(a='x', b='y')} END AS house_match_T, round(CASE WHEN r.rank = 0 THEN 0 ELSE {_NUMS.format(a='x', b='y')} END, 6) AS num_jaccard_T,
    CASE WHEN r.rank > 0 AND x.source = y.source THEN 1 ELSE 0 END AS same_src_T, coalesce(round(o.hm, 6), 0) AS h_other_mean, coalesce(o.hx, 0) AS h_other_max, coalesce(round(o.jm, 6), 0) AS j_other_mean, coalesce(round(o.jx, 6), 0) AS j_other_max, r.best_competing_prob, round(r.prob - r.best_competing_prob, 6) AS prob_minus_comp, r.other_gt_03
    FROM ({_STACKED}) r JOIN norm x ON x.entity_id = r.cand_id JOIN norm y ON y.entity_id = r.t
    LEFT JOIN (SELECT u.s1_id, u.cand_id, avg({_HOUSE.format(a='x', b='z')}) AS hm, max({_HOUSE.format(a='x', b='z')}) AS hx, avg({_NUMS.format(a='x', b='z')}) AS jm, max({_NUMS.format(a='x', b='z')}) AS jx FROM prob u JOIN prob v ON v.s1_id = u.s1_id AND v.cand_id <> u.cand_id AND v.prob > 0.5 AND u.prob >= 0.05 JOIN norm x ON x.entity_id = u.cand_id JOIN norm z ON z.entity_id = v.cand_id GROUP BY u.s1_id, u.cand_id) o ON o.s1_id = r.s1_id AND o.cand_id = r.cand_id""")
def stack_features(spark, d):
    """Second-stage features, but for the six ratios of names and addresses (see string_ratios)."""
    norm = T.normalized(spark, d)
    made = features.stack_features(T.scored(norm), norm)
    kinds = dict(made.dtypes)
    return made.select("s1_id", "cand_id", *[T.rounded(F.col(c)).alias(c) if kinds[c] == "double" else F.col(c) for c in _STACK])


_RULE = "SELECT p.*, prob * 100 AS rule_score, CASE WHEN g.s1_id IS NULL THEN 0 ELSE 1 END AS label FROM prob p LEFT JOIN gold g ON g.s1_id = p.s1_id AND g.cand_id = p.cand_id"


@query(f"SELECT CAST(t.x AS INTEGER) AS threshold, CAST(sum(CASE WHEN rule_score >= t.x THEN label ELSE 0 END) AS BIGINT) AS tp, count(CASE WHEN rule_score >= t.x THEN 1 END) AS kept FROM ({_RULE}), (SELECT unnest(generate_series(30, 94, 2)) AS x) t GROUP BY t.x")
def rule_baseline(spark, d):
    norm = T.normalized(spark, d)
    rows = candidates.label(T.scored(norm), T.gold(norm)).withColumn("rule_score", F.col("prob") * 100)
    return models.rule_sweep(rows).select(F.col("threshold").cast("int").alias("threshold"), "tp", F.col("kept").cast("long").alias("kept"))
