"""Queries: sources and sinks, resumed stages, frequencies, string ratios, all features, models and their decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import similarity, vectors
from ..operators import blocking, candidates, channels, decide, features, metrics, models
from ..session import derived, new_path, ship, stage
from ..sources import records, sinks
from . import resolve as R
from . import sql as S
from . import tables as T
from .registry import query


@query("SELECT entity_id, source, country, raw_name, raw_address FROM rec")
def tsv_records(spark, d):
    """Records written as tab-separated text, loaded, kept as Parquet, and read from there."""
    rows = records.catalog_records(spark, d)
    path = new_path(spark, "tsv-source")
    text = rows.select("entity_id", F.col("raw_name").alias("business_name"), F.col("raw_address").alias("business_address"), "country")
    text.write.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)
    records.cached(spark, path)
    return records.records_of(records.cached(spark, path))


_MATCHED = "SELECT s1.s1_id, coalesce(k.ids, '') AS matched_ids FROM s1 LEFT JOIN (SELECT s1_id, string_agg(cand_id, ',' ORDER BY cand_id) AS ids FROM kept GROUP BY s1_id) k ON k.s1_id = s1.s1_id"


@query(_MATCHED)
def resume_resolve(spark, d):
    """All stages by their settings, twice: the second run reads what the first one wrote, but for its last stage."""
    raw = records.catalog_records(spark, d)
    label = f"{d} {new_path(spark, 'run')}"
    R.resolve(spark, raw, R.Config(label))
    log = R.log_folder(spark)
    return R.resolve(spark, raw, R.Config(label, force="decided", log=log))


@query("SELECT ids, n, ord FROM (SELECT coalesce(string_agg(k.cand_id, ',' ORDER BY k.emb_score DESC, k.cand_id), '') AS ids, count(k.cand_id) AS n, row_number() OVER (ORDER BY CAST(substr(s1.s1_id, 4) AS BIGINT)) AS ord FROM s1 LEFT JOIN cand k ON k.s1_id = s1.s1_id GROUP BY s1.s1_id)")
def written_lists(spark, d):
    """The lists of candidates as written, in the order of the records, and read again."""
    norm = T.normalized(spark, d)
    s1 = T.s1_of(norm).withColumn("ord", F.expr("cast(substring(s1_id, 4) as bigint)"))
    path = new_path(spark, "lists")
    sinks.write_lists(sinks.result_lists(T.candidate_table(norm).withColumn("rank", -F.col("emb_score")), s1), path, ("source1_entity_id", "candidate_entity_ids"))
    back = records.load_tsv(spark, path, records.T.StructType([records.T.StructField(c, records.T.StringType()) for c in ("source1_entity_id", "candidate_entity_ids")]))
    ids = F.col("candidate_entity_ids")
    return records.numbered(back, "ord").select(ids.alias("ids"), F.when(ids == "", 0).otherwise(F.size(F.split(ids, ","))).cast("long").alias("n"), "ord")


@query("SELECT s1_id, cand_id, prob, CASE WHEN CAST(substr(s1_id, 4) AS BIGINT) % 4 = 0 THEN prob / 2 ELSE -1 END AS ce_prob FROM prob")
def external_score(spark, d):
    """A score from another model's file beside each pair, -1 where the file has none."""
    scored = T.scored(T.normalized(spark, d))
    other = stage(scored.where("cast(substring(s1_id, 4) as bigint) % 4 = 0").select("s1_id", "cand_id", (F.col("prob") / 2).alias("ce_prob")), "external")
    return features.with_external(scored, other).select("s1_id", "cand_id", "prob", "ce_prob")


_VEC = f"SELECT entity_id, [round(x, 6) FOR x IN {S.unit('n')}] AS v FROM (SELECT entity_id, {S.letter_counts('name_full')} AS n FROM norm)"


@query(f"SELECT entity_id, array_to_string(list_transform(v, lambda x: CAST(round(x * 1e6) AS BIGINT)), ' ') AS v FROM ({_VEC})")
def name_vectors(spark, d):
    """Names by a plain encoder, the one that the registered channels use; any function of a column will do."""
    made = channels.encoded(T.normalized(spark, d), vectors.letter_counts)
    return made.select("entity_id", F.array_join(F.transform("emb", lambda x: F.round(F.round(x, 6) * 1e6).cast("long").cast("string")), " ").alias("v"))


@query("""SELECT s1_id, cand_id, round(ln(1 + coalesce(x.n, 0)), 6) AS a_freq_s1, round(ln(1 + coalesce(y.n, 0)), 6) AS a_freq_cand FROM (SELECT c.s1_id, c.cand_id, a.country AS ca, b.country AS cb, a.addr_norm AS fa, b.addr_norm AS fb FROM cand c JOIN norm a ON a.entity_id = c.s1_id JOIN norm b ON b.entity_id = c.cand_id) p
    LEFT JOIN (SELECT country, addr_norm, count(*) AS n FROM norm WHERE source = 1 AND addr_norm <> '' GROUP BY ALL) x ON x.country = p.ca AND x.addr_norm = p.fa LEFT JOIN (SELECT country, addr_norm, count(*) AS n FROM norm WHERE source > 1 AND addr_norm <> '' GROUP BY ALL) y ON y.country = p.cb AND y.addr_norm = p.fb""")
def side_frequencies(spark, d):
    norm = T.full_records(T.normalized(spark, d))
    pairs = features.with_records(T.candidate_table(T.normalized(spark, d)), norm.select("entity_id", "country", "core_name", "addr_norm", "street_key"))
    made = features.side_frequencies(pairs, norm)
    return made.select("s1_id", "cand_id", *[T.rounded(F.col(c)).alias(c) for c in ("a_freq_s1", "a_freq_cand")])


def _lcs(a: str, b: str) -> str:
    """The length of the longest common subsequence: one row of the table for each letter, as running maxima."""
    hits = f"list_transform(string_split({a}, ''), lambda c: list_transform(string_split({b}, ''), lambda e: CASE WHEN c = e THEN 1 ELSE 0 END))"
    row = "list_transform(generate_series(1, len(v)), lambda j: list_max(list_transform(generate_series(1, j), lambda i: greatest(acc[i], coalesce(acc[i - 1], 0) + v[i]))))"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE list_last(list_reduce({hits}, lambda acc, v: {row}, list_transform(string_split({b}, ''), lambda e: 0))) END"


def _indel(a: str, b: str) -> str:
    return f"(CASE WHEN length({a}) + length({b}) = 0 THEN 100.0 ELSE 200.0 * ({_lcs(a, b)}) / (length({a}) + length({b})) END)"


_SOME = "SELECT DISTINCT p_name AS t FROM part UNION SELECT DISTINCT p_type || ' ' || p_name FROM part"
_SPLIT = f"SELECT t, string_split(t, ' ') AS w FROM ({_SOME})"
_ALIKE = f"SELECT DISTINCT x.t AS a, y.t AS b, x.ws AS wa, y.ws AS wb FROM (SELECT t, w AS ws, unnest(w) AS k FROM ({_SPLIT})) x JOIN (SELECT t, w AS ws, unnest(w) AS k FROM ({_SPLIT})) y ON x.k = y.k AND x.t < y.t"
_JOINED = "array_to_string(list_sort({x}), ' ')"
_SETS = f"""SELECT a, b, {_JOINED.format(x='wa')} AS sa, {_JOINED.format(x='wb')} AS sb, {_JOINED.format(x='list_intersect(wa, wb)')} AS s, {_JOINED.format(x='list_filter(list_distinct(wa), lambda t: NOT list_contains(wb, t))')} AS p, {_JOINED.format(x='list_filter(list_distinct(wb), lambda t: NOT list_contains(wa, t))')} AS q FROM ({_ALIKE})"""
_SIDE = "CASE WHEN s = '' THEN 0 ELSE 100.0 * (1 - (1 + length({x})) / (2 * length(s) + 1 + length({x}))) END"


@query(f"""SELECT a, b, round({_indel('a', 'b')}, 6) AS ratio, round({_indel('sa', 'sb')}, 6) AS token_sort, round(({_lcs('a', 'b')}) / greatest(length(a), length(b)), 6) AS lcs, round(jaro_winkler_similarity(a, b), 6) AS jaro_winkler,
    round(CASE WHEN s <> '' AND (p = '' OR q = '') THEN 100.0 ELSE greatest(100.0 * (1 - (length(p) + length(q) - 2 * ({_lcs('p', 'q')})) / (2 * length(s) + CASE WHEN s = '' THEN 0 ELSE 2 END + length(p) + length(q))), {_SIDE.format(x='p')}, {_SIDE.format(x='q')}) END, 6) AS token_set FROM ({_SETS})""")
def string_ratios(spark, d):
    """The ratios of all distinct texts of the catalog that share a word."""
    ship(spark)
    p = spark.read.parquet(f"{d}/part.parquet")
    texts = p.select(F.col("p_name").alias("t")).union(p.select(F.concat_ws(" ", "p_type", "p_name"))).distinct()
    words = texts.select("t", F.explode(F.split("t", " ")).alias("k"))
    pairs = words.withColumnRenamed("t", "a").join(words.withColumnRenamed("t", "b"), "k").where("a < b").select("a", "b").distinct()
    a, b = F.col("a"), F.col("b")
    wanted = {"ratio": (similarity.ratio, a, b), "token_sort": (similarity.token_sort_ratio, a, b), "lcs": (similarity.lcs_similarity, a, b), "jaro_winkler": (similarity.jaro_winkler, a, b), "token_set": (similarity.token_set_ratio, a, b)}
    made = pairs.withColumn("m", similarity.measures(wanted))
    return made.select("a", "b", *[T.rounded(F.col(f"m.{c}")).alias(c) for c in wanted])


def _featured(spark, d):
    """All features of all channels' candidates, with labels, by larger countries: rows of the heads of groups."""

    def build():
        norm = T.normalized(spark, d, market=True)
        mapped = channels.rewritten(T.full_records(norm), T.learned(spark, d)).withColumnRenamed("name_mapped", "mapped")
        ranked = blocking.ranked_tokens(norm, blocking.token_frequencies(norm))
        found = T.grouped(spark, d)
        vecs = derived(norm, ["name_full", "addr_norm"], lambda texts: channels.encoded(texts, vectors.letter_counts)).select(F.col("entity_id").alias("id"), F.col("emb").alias("v"))
        made = features.complete(found.table.join(T.times(found.members), "s1_id"), mapped, ranked, vecs, [*channels.BASE, *channels.NEW, *channels.PAIRED])
        return candidates.label(made, T.head_gold(norm, found.members))

    return T.held(spark, "featured", d, build)


@query()
def pair_features_all(spark, d):
    """The 66 inputs of the classifier and the rule score."""
    made = channels.expanded(_featured(spark, d), T.grouped(spark, d).members)
    kinds = dict(made.dtypes)
    return made.select("s1_id", "cand_id", "label", *[T.rounded(F.col(c)).alias(c) if kinds[c] == "double" else F.col(c) for c in ("rule_score", *features.MODEL)])


def _part(column: str = "s1_id"):
    return F.expr(f"cast(substring({column}, 4) as bigint)") % 4


def _rows(df):
    return df.withColumn("part", _part()).repartition("s1_id").sortWithinPartitions("s1_id", "cand_id")


def _forms(df, members, *by):
    """Rows of each form of S1 and value of ``by``, and ``times``: how many S1 have them in common. ``s1_id`` is the form."""
    forms = members.groupBy("head", "form", *by).agg(F.count(F.lit(1)).alias("times")).withColumn("s1_id", F.col("form"))
    return channels.expanded(df, forms).repartition("s1_id").sortWithinPartitions("s1_id", "cand_id", *by)


def _each(scored, members):
    """Rows of forms for every S1."""
    return members.select("s1_id", "form").join(scored.withColumnRenamed("s1_id", "form").hint("merge"), "form").drop("form")


@query()
def train_filter(spark, d):
    """A filter model on the S1 of a quarter of the train fold scores all pairs of all channels; the best 15 of each S1
    stay."""
    norm, found = T.normalized(spark, d, market=True), T.grouped(spark, d)
    rows = candidates.label(channels.filter_features(found.table), T.head_gold(norm, found.members))
    model = models.train(_forms(rows, found.members.where(_part() == 0)), channels.FILTER, rounds=20, depth=4)
    best = candidates.top_k(models.score(model, _forms(rows, found.members), channels.FILTER, "score"), 15)
    return _each(best.select("s1_id", "cand_id", "label", F.round("score", 4).alias("score")), found.members)


def _matcher(spark, d):
    """The classifier on all features: fitted on half of the S1, stopped early by a quarter, to score the rest."""
    rows, members = _featured(spark, d), T.grouped(spark, d).members.withColumn("held", (_part() == 1).cast("int"))
    return rows, models.train(_forms(rows, members.where(_part() < 3), "held"), features.MODEL, rounds=20, depth=4)


def _probabilities(model, rows, members):
    scored = models.score(model, _forms(rows, members), features.MODEL)
    return _each(scored.select("s1_id", "cand_id", "label", F.round("prob", 4).alias("prob")), members)


@query()
def train_matcher(spark, d):
    rows, model = _matcher(spark, d)
    return _probabilities(model, rows, T.grouped(spark, d).members.where(_part() == 3))


@query()
def feature_importance(spark, d):
    _, model = _matcher(spark, d)
    found = models.importance(model, features.MODEL)
    return spark.createDataFrame([(i, c, round(v, 6)) for i, (c, v) in enumerate(found, 1)], "rank int, feature string, importance double")


@query()
def cross_group_proxy(spark, d):
    """Trained on one group of countries, scored on the others."""
    rows, members = _featured(spark, d), T.grouped(spark, d).members
    here = F.col("country") < "Brand#2"
    return _probabilities(models.train(_forms(rows.where(here), members), features.MODEL, rounds=10, depth=4), rows.where(~here), members)


def _stacked(spark, d):
    """Second-stage features of rule probabilities, cross-fitted by S1; a quarter of the S1 plays the competitors."""

    def build():
        norm = T.normalized(spark, d)
        made = features.with_external(features.stack_features(T.scored(norm), norm), T.scored(norm).select("s1_id", "cand_id", F.col("prob").alias("ce_prob")))
        rows = stage(_rows(candidates.label(made, T.gold(norm))).withColumn("is_competitor", (F.col("part") == 3).cast("int")), "stack-rows")  # trees read their rows many times
        return models.cross_fit(rows, [*features.STACK, "ce_prob"], (F.col("part") % 2), first="prob").drop("features")

    return T.held(spark, "stacked", d, build)


@query()
def cross_fit_stack(spark, d):
    return _stacked(spark, d).select("s1_id", "cand_id", "label", "is_competitor", F.round("prob", 4).alias("prob"))


@query()
def stacked_resolve(spark, d):
    """Matches from second-stage probabilities, with the thresholds that the grid finds best, through a file of them."""
    norm = T.normalized(spark, d)
    scored = _stacked(spark, d).select("s1_id", "cand_id", "emb_score", "prob", "is_competitor")
    own = T.s1_of(norm).where(_part() < 3)
    best = decide.best_setting(decide.grid_search(scored.where("is_competitor = 0"), T.gold(norm).join(own.select("s1_id"), "s1_id", "left_semi"), own)).first()
    path = new_path(spark, "thresholds")
    sinks.write_json(spark, {k: best[k] for k in ("exclusive", "margin", "t_top1", "t_extra")}, path)
    c = R.Config.of_file(spark, d, path)
    return decide.decide(scored, own, c.t_top1, c.t_extra, c.margin, c.exclusive)


_SETTINGS = "SELECT CAST(a.x AS DOUBLE) AS t_top1, CAST(b.x AS DOUBLE) AS t_extra FROM (SELECT unnest([{top}]) AS x) a, (SELECT unnest([{extra}]) AS x) b WHERE b.x >= a.x".format(top=", ".join(map(str, decide.TOP1)), extra=", ".join(map(str, decide.EXTRA)))
_RANKED = "SELECT x.*, CASE WHEN g.s1_id IS NULL THEN 0 ELSE 1 END AS hit, row_number() OVER (PARTITION BY x.s1_id ORDER BY prob DESC, emb_score DESC, x.cand_id) AS rn, max(prob) OVER (PARTITION BY x.s1_id) AS top FROM ({rows}) x LEFT JOIN gold g ON g.s1_id = x.s1_id AND g.cand_id = x.cand_id"
_ROWS = {
    (on, m): f"SELECT * FROM (SELECT *, row_number() OVER w AS crn, lead(prob) OVER w AS nxt FROM prob WINDOW w AS (PARTITION BY cand_id ORDER BY prob DESC, emb_score DESC, s1_id)) WHERE crn = 1 AND (nxt IS NULL OR prob - nxt >= {m})" if on else "SELECT * FROM prob"
    for on in (True, False)
    for m in decide.MARGINS
}
_GRID_SQL = " UNION ALL ".join(
    f"""SELECT {on} AS exclusive, CAST({m} AS DOUBLE) AS margin, t_top1, t_extra, round(avg(CASE WHEN n_pred = 0 AND n_gold = 0 THEN 1.0 WHEN n_pred = 0 OR n_gold = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_pred) * (tp / n_gold) / (0.25 * (tp / n_pred) + tp / n_gold) END), 6) AS f05 FROM
    (SELECT g.t_top1, g.t_extra, s.s1_id, any_value(s.n_gold) AS n_gold, count(e.cand_id) AS n_pred, coalesce(sum(e.hit), 0) AS tp FROM ({_SETTINGS}) g CROSS JOIN (SELECT s1.s1_id, count(gold.cand_id) AS n_gold FROM s1 LEFT JOIN gold ON gold.s1_id = s1.s1_id GROUP BY s1.s1_id) s
      LEFT JOIN ({_RANKED.format(rows=rows)}) e ON e.s1_id = s.s1_id AND e.top >= g.t_top1 AND (e.rn = 1 OR e.prob >= g.t_extra) GROUP BY g.t_top1, g.t_extra, s.s1_id) GROUP BY t_top1, t_extra"""
    for (on, m), rows in _ROWS.items()
)


@query(_GRID_SQL)
def grid_search(spark, d):
    """Every setting of both thresholds, the margin and exclusivity."""
    norm = T.normalized(spark, d)
    return decide.grid_search(T.scored(norm), T.gold(norm), T.s1_of(norm))


@query("""SELECT CAST(t.x AS INTEGER) AS threshold, round(avg(CASE WHEN n_pred = 0 AND n_gold = 0 THEN 1.0 WHEN n_pred = 0 OR n_gold = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_pred) * (tp / n_gold) / (0.25 * (tp / n_pred) + tp / n_gold) END), 6) AS f05 FROM
    (SELECT g.x, s.s1_id, any_value(s.n_gold) AS n_gold, count(e.cand_id) AS n_pred, coalesce(sum(e.hit), 0) AS tp FROM (SELECT unnest(generate_series(30, 94, 2)) AS x) g CROSS JOIN (SELECT s1.s1_id, count(gold.cand_id) AS n_gold FROM s1 LEFT JOIN gold ON gold.s1_id = s1.s1_id GROUP BY s1.s1_id) s
      LEFT JOIN (SELECT e.*, CASE WHEN gg.s1_id IS NULL THEN 0 ELSE 1 END AS hit FROM excl e LEFT JOIN gold gg ON gg.s1_id = e.s1_id AND gg.cand_id = e.cand_id) e ON e.s1_id = s.s1_id AND e.prob >= CAST(g.x AS DOUBLE) / 100 GROUP BY g.x, s.s1_id) t GROUP BY t.x""")
def rule_macro(spark, d):
    norm = T.normalized(spark, d)
    return models.rule_macro(T.scored(norm), T.gold(norm), T.s1_of(norm))


_H = "CAST(substr({c}, 4) AS BIGINT) * 7919 % 10007"


@query(f"""SELECT s1_id, country FROM (SELECT s.*, q.quota, row_number() OVER (PARTITION BY s.country ORDER BY {_H.format(c='s.s1_id')}, s.s1_id) AS rn FROM s1 s JOIN
    (SELECT country, greatest(1, CAST(round(100 * count(*) / (SELECT count(*) FROM s1)) AS BIGINT)) AS quota FROM s1 GROUP BY country) q ON q.country = s.country) WHERE rn <= quota""")
def small_set(spark, d):
    """A stratified sample of S1, the start of a small data set."""
    return metrics.stratified(T.s1_of(T.normalized(spark, d)), 100)


@query(" UNION ALL ".join(f"SELECT n.country, '{name}' AS key, round(count(k.entity_id) / count(*), 6) AS share FROM norm n LEFT JOIN (SELECT DISTINCT entity_id FROM {cte}) k ON k.entity_id = n.entity_id GROUP BY n.country" for name, cte in (("address", "k_addr"), ("skeleton", "k_skel"), ("rare", "k_rare"), ("k1", "k_k1"), ("k2", "k_k2"), ("k3", "k_k3"), ("k4", "k_k4"), ("k5", "k_k5"))))
def key_coverage(spark, d):
    norm = T.normalized(spark, d)
    freq = blocking.token_frequencies(norm)
    keys = {"address": blocking.address_keys(norm), "skeleton": blocking.skeleton_keys(norm), "rare": blocking.rare_token_keys(norm, freq)}
    return metrics.key_coverage(norm, keys | {k.lower(): blocking.number_keys(norm, k, freq) for k in ("K1", "K2", "K3", "K4", "K5")})


@query(" UNION ALL ".join(f"SELECT label, '{c}' AS feature, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75 FROM (SELECT s.*, CASE WHEN g.s1_id IS NULL THEN 0 ELSE 1 END AS label FROM sets s LEFT JOIN gold g ON g.s1_id = s.s1_id AND g.cand_id = s.cand_id) GROUP BY label" for c in ("name_jaccard", "addr_jaccard", "len_diff")))
def label_quartiles(spark, d):
    norm = T.normalized(spark, d)
    return metrics.quartiles(candidates.label(T.set_features(norm), T.gold(norm)), "label", ["name_jaccard", "addr_jaccard", "len_diff"])


@query("""SELECT 'matches ' || n AS fact, count(*) AS n FROM (SELECT s1.s1_id, count(gold.cand_id) AS n FROM s1 LEFT JOIN gold ON gold.s1_id = s1.s1_id GROUP BY s1.s1_id) GROUP BY n UNION ALL SELECT 'several s1', count(*) FROM (SELECT cand_id FROM gold GROUP BY cand_id HAVING count(*) > 1)
    UNION ALL SELECT 'across countries', count(*) FROM gold g JOIN norm a ON a.entity_id = g.s1_id JOIN norm b ON b.entity_id = g.cand_id WHERE a.country <> b.country UNION ALL SELECT 'distractors', count(*) FROM norm WHERE source > 1 AND entity_id NOT IN (SELECT cand_id FROM gold)""")
def gold_facts(spark, d):
    norm = T.normalized(spark, d)
    return metrics.gold_facts(norm, T.gold(norm))


@query("""SELECT CAST(st.k AS INTEGER) AS stage, coalesce(country, 'all') AS country, coalesce(CAST(cand_source AS VARCHAR), 'all') AS cand_source, count(*) AS n_gold, count(CASE WHEN added_by <= st.k THEN 1 END) AS n_hit, round(count(CASE WHEN added_by <= st.k THEN 1 END) / count(*), 6) AS recall
    FROM (SELECT g.country, g.cand_source, w.added_by FROM gold g LEFT JOIN w_all w ON w.s1_id = g.s1_id AND w.cand_id = g.cand_id), (SELECT unnest(generate_series(0, 4)) AS k) st GROUP BY GROUPING SETS ((st.k, country, cand_source), (st.k, country), (st.k, cand_source), (st.k))""", market=True)
def staged_recall(spark, d):
    """Recall as channels are added, by country and source."""
    found = T.grouped(spark, d)
    gold = T.head_gold(T.normalized(spark, d, market=True), found.members).join(T.times(found.members), "s1_id")
    return metrics.staged_recall(found.table, gold)


_PR = " UNION ALL ".join(
    f"SELECT '{kind} ' || {by} AS slice, count({side}) AS n, round(CASE WHEN count({side}) > 0 THEN count(CASE WHEN p = 1 AND g = 1 THEN 1 END) / count({side}) END, 6) AS value FROM both_ GROUP BY {by}"
    for by in ("country", "src")
    for kind, side in (("precision", "CASE WHEN p = 1 THEN 1 END"), ("recall", "CASE WHEN g = 1 THEN 1 END"))
)


@query(f"""SELECT 'top1 of one match' AS slice, count(*) AS n, round(avg(CASE WHEN gg.s1_id IS NULL THEN 0 ELSE 1 END), 6) AS value FROM (SELECT s1_id FROM gold GROUP BY s1_id HAVING count(*) = 1) o LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY prob DESC, emb_score DESC, cand_id) AS rn FROM prob) WHERE rn = 1) t ON t.s1_id = o.s1_id LEFT JOIN gold gg ON gg.s1_id = t.s1_id AND gg.cand_id = t.cand_id
    UNION ALL SELECT 'wrong of three or more', count(*), round(avg(CASE WHEN gg.s1_id IS NULL THEN 1 ELSE 0 END), 6) FROM kept k JOIN (SELECT s1_id FROM gold GROUP BY s1_id HAVING count(*) >= 3) o ON o.s1_id = k.s1_id LEFT JOIN gold gg ON gg.s1_id = k.s1_id AND gg.cand_id = k.cand_id
    UNION ALL {_PR.replace('FROM both_', "FROM (SELECT b.*, s.country, 'S' || substr(b.cand_id, 2, 1) AS src FROM (SELECT coalesce(k.s1_id, g.s1_id) AS s1_id, coalesce(k.cand_id, g.cand_id) AS cand_id, CASE WHEN k.s1_id IS NULL THEN 0 ELSE 1 END AS p, CASE WHEN g.s1_id IS NULL THEN 0 ELSE 1 END AS g FROM kept k FULL JOIN gold g ON k.s1_id = g.s1_id AND k.cand_id = g.cand_id) b JOIN s1 s ON s.s1_id = b.s1_id)")}""")
def slice_details(spark, d):
    norm = T.normalized(spark, d)
    return metrics.slice_details(T.scored(norm), T.matched(norm), T.gold(norm), T.s1_of(norm))


_HAS = "CASE WHEN EXISTS (SELECT 1 FROM {k} a JOIN {k} b ON a.key = b.key WHERE a.entity_id = m.s1_id AND b.entity_id = m.cand_id) THEN 1 ELSE 0 END"
_MISSES = f"""SELECT m.s1_id, m.cand_id, {', '.join(f"{_HAS.format(k='k_' + k)} AS {k}" for k in ('k1', 'k2', 'k3', 'k4', 'k5'))}, round({S.jaccard('a.full_t', 'b.full_t')}, 6) AS name_jaccard, round({S.jaccard('a.addr_tokens', 'b.addr_tokens')}, 6) AS addr_jaccard, n.emb_score AS nth_score
    FROM (SELECT g.s1_id, g.cand_id FROM gold g LEFT JOIN (SELECT * FROM cand WHERE ch_k3 = 1) c ON c.s1_id = g.s1_id AND c.cand_id = g.cand_id WHERE c.s1_id IS NULL) m JOIN norm a ON a.entity_id = m.s1_id JOIN norm b ON b.entity_id = m.cand_id
    LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY emb_score DESC, cand_id) AS rn FROM cand WHERE ch_k3 = 1) WHERE rn = 2) n ON n.s1_id = m.s1_id"""


def _misses(spark, d):
    """What the channel of all numbers alone would miss."""
    norm = T.normalized(spark, d)
    freq = blocking.token_frequencies(norm)
    keys = {k.lower(): blocking.number_keys(norm, k, freq) for k in ("K1", "K2", "K3", "K4", "K5")}
    return metrics.miss_analysis(T.candidate_table(norm).where("ch_k3 = 1"), T.gold(norm), norm, keys, 2)


@query(_MISSES)
def miss_analysis(spark, d):
    return _misses(spark, d)


@query(f"SELECT * FROM ({_MISSES}) ORDER BY {_H.format(c='s1_id')}, s1_id, cand_id LIMIT 50")
def misses_sample(spark, d):
    """Fifty of them for a look: the limit is the feature."""
    path = new_path(spark, "misses")
    metrics.misses_sample(_misses(spark, d)).coalesce(1).write.option("sep", "\t").option("header", True).csv(path)
    kinds = "s1_id string, cand_id string, k1 int, k2 int, k3 int, k4 int, k5 int, name_jaccard double, addr_jaccard double, nth_score double"
    return spark.read.option("sep", "\t").option("header", True).schema(kinds).csv(path)
