"""Queries: normalisation, keys, blocking joins, vectors, tf-idf, dictionary."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import addresses, constants, names, vectors
from ..operators import blocking, tfidf, topk
from ..session import stage
from ..sources import records
from . import sql as S
from . import tables as T
from .registry import query


def _text(c: str):
    return F.array_join(c, " ").alias(c)


@query("SELECT entity_id, name_full, core_name, legal, core_sorted FROM norm")
def norm_name(spark, d):
    return T.normalizing(spark, d).select("entity_id", "name_full", "core_name", "legal", "core_sorted")


@query("SELECT entity_id, addr_norm, array_to_string(num_tokens, ' ') AS num_tokens, house_no, array_to_string(house_cands, ' ') AS house_cands, zip_pin FROM norm")
def norm_address(spark, d):
    return T.normalizing(spark, d).select("entity_id", "addr_norm", _text("num_tokens"), "house_no", _text("house_cands"), "zip_pin")


@query(f"SELECT s_suppkey, array_to_string(list_transform(list_filter(regexp_split_to_array(lower(s), '\\s+'), lambda w: w <> ''), lambda w: {S.skeleton('w')}), ' ') AS skel FROM (SELECT s_suppkey, replace(s_name, '#', ' 5mph ') || ' Czech Rhumba' AS s FROM supplier)")
def name_skeleton(spark, d):
    text = F.concat(F.replace("s_name", F.lit("#"), F.lit(" 5mph ")), F.lit(" Czech Rhumba"))
    return spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", names.skeleton(text).alias("skel"))


@query("SELECT doc_id, NOT regexp_matches(w, '[^\\x00-\\x7F]') AS ascii, replace(strip_accents(w), 'ß', 'ss') AS folded FROM (SELECT doc_id, array_to_string(string_split(text, ' ')[1:6], ' ') AS w FROM documents WHERE text IS NOT NULL)")
def translit_text(spark, d):
    w = spark.read.parquet(f"{d}/documents.parquet").where("text IS NOT NULL").select("doc_id", F.array_join(F.slice(F.split("text", " "), 1, 6), " ").alias("w"))
    return w.select("doc_id", names.is_ascii(F.col("w")).alias("ascii"), names.fold_latin(F.col("w")).alias("folded"))


@query("SELECT doc_id, coalesce(NOT regexp_matches(text, '[^\\x00-\\x7F]'), true) AS ascii, replace(strip_accents(coalesce(text, '')), 'ß', 'ss') AS folded FROM documents")
def translit_whole_text(spark, d):
    """As ``translit_text``, on whole texts; a null text counts as empty."""
    w = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("w"))
    return w.select("doc_id", names.is_ascii(F.col("w")).alias("ascii"), names.fold_latin(F.col("w")).alias("folded"))


_STATES = list(constants.STATES.items())
_NAMES, _CODES = [k for k, _ in _STATES], ["" if "&" in k and k != "jammu & kashmir" and "andaman" not in k else v for k, v in _STATES]
_AT = "CAST(c_custkey % {n} AS INTEGER) + 1"


@query(f"SELECT c_custkey, [{', '.join(repr(c) for c in _CODES)}][{_AT.format(n=len(_CODES))}] AS state_code FROM customer")
def state_code(spark, d):
    """Every state by its name; "j & k" is not found, since an ampersand is spelt out before the lookup."""
    name = F.element_at(F.array(*[F.lit(x) for x in _NAMES]), (F.col("c_custkey") % len(_NAMES) + 1).cast("int"))
    raw = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.lit("US").alias("country"), F.concat(F.col("c_custkey").cast("string"), F.lit(" Quarry Road, "), F.initcap(name)).alias("raw_address"))
    return addresses.normalize_addresses(raw, scripts="latin").select("c_custkey", "state_code")


@query("SELECT c_custkey, array_to_string(regexp_extract_all(c_name || ' ' || c_custkey * 7919, '([0-9]{5,})', 1), ' ') AS numbers FROM customer")
def long_numbers(spark, d):
    text = F.concat_ws(" ", "c_name", (F.col("c_custkey") * 7919).cast("string"))
    return spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.array_join(addresses.long_numbers(text), " ").alias("numbers"))


@query("SELECT country, token, doc_freq FROM freq")
def addr_token_df(spark, d):
    return blocking.token_frequencies(T.normalized(spark, d))


@query("SELECT entity_id, token, rk FROM rare WHERE rk <= 3")
def rare_tokens(spark, d):
    norm = T.normalized(spark, d)
    return blocking.ranked_tokens(norm, blocking.token_frequencies(norm)).where("rk <= 3").select("entity_id", "token", "rk")


@query("SELECT source - 2 AS cand_source, key, count(*) AS n FROM k_addr WHERE source > 1 GROUP BY ALL")
def block_sizes(spark, d):
    return blocking.block_sizes(blocking.address_keys(T.normalized(spark, d)))


@query("SELECT source - 2 AS cand_source, key, count(*) AS n FROM k_skel WHERE source > 1 GROUP BY ALL HAVING count(*) <= 3")
def block_cap(spark, d):
    pool = blocking.as_pool_keys(blocking.skeleton_keys(T.normalized(spark, d)))
    return blocking.capped(pool, 3).groupBy("cand_source", "key").agg(F.count(F.lit(1)).alias("n"))


def _key_query(name: str, cte: str, build):
    def run(spark, d):
        norm = T.normalized(spark, d)
        return blocking.key_join(build(norm))

    run.__name__ = name
    query(f"SELECT * FROM ({S.pairs(cte)})")(run)


_key_query("key_join_addr", "k_addr", blocking.address_keys)
_key_query("key_join_skel", "k_skel", blocking.skeleton_keys)
_key_query("key_join_rare", "k_rare", lambda n: blocking.rare_token_keys(n, blocking.token_frequencies(n)))
_key_query("key_join_k1", "k_k1", lambda n: blocking.number_keys(n, "K1"))
_key_query("key_join_k2", "k_k2", lambda n: blocking.number_keys(n, "K2"))
_key_query("key_join_k3", "k_k3", lambda n: blocking.number_keys(n, "K3"))
_key_query("key_join_k4", "k_k4", lambda n: blocking.number_keys(n, "K4"))
_key_query("key_join_k5", "k_k5", lambda n: blocking.number_keys(n, "K5", blocking.token_frequencies(n)))

_TOP = """SELECT q, p, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY q, src ORDER BY round(score, 9) DESC, p) AS rank FROM
    (SELECT a.id AS q, b.id AS p, {src} AS src, list_inner_product(a.v, b.v) AS score FROM vec a JOIN vec b ON a.country = b.country AND {on})) WHERE rank <= {k}"""


@query(_TOP.format(src="b.source", on="a.source = 0 AND b.source > 0", k=20))
def topk_dense(spark, d):
    v = records.vectors(spark, d)
    q = v.where("source = 0")
    found = topk.dense_topk(q, v.where("source = 1"), 20).unionByName(topk.dense_topk(q, v.where("source = 2"), 20))
    return found.withColumn("score", T.rounded(F.col("score")))


@query(_TOP.format(src="b.source", on="a.source > 0 AND b.source = 0", k=3))
def topk_dense_reverse(spark, d):
    v = records.vectors(spark, d)
    return topk.dense_topk(v.where("source > 0"), v.where("source = 0"), 3).withColumn("score", T.rounded(F.col("score")))


@query("""SELECT q, p, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(score, 9) DESC, p) AS rank FROM
    (SELECT a.id AS q, b.id AS p, greatest(list_inner_product(a.v, b.v), list_inner_product(a.v, list_reverse(b.v)), list_inner_product(list_reverse(a.v), b.v), list_inner_product(list_reverse(a.v), list_reverse(b.v))) AS score FROM vec a JOIN vec b ON a.country = b.country AND a.source = 0 AND b.source > 0)) WHERE rank <= 5""")
def topk_dense_best_of(spark, d):
    """Records with a main and an alternate vector count with the best of the four products."""
    v = records.vectors(spark, d)
    both = v.unionByName(v.withColumn("v", F.reverse("v")))
    return topk.dense_topk(both.where("source = 0"), both.where("source > 0"), 5).withColumn("score", T.rounded(F.col("score")))


@query("SELECT a.id AS q, b.id AS p, round(list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))), 6) AS score FROM vec a JOIN vec b ON b.id = a.id + 1")
def pair_cosine(spark, d):
    v = records.vectors(spark, d).withColumn("v", vectors.normalized(F.col("v"))).select("id", "v")
    ids = v.select(F.col("id").alias("q"), (F.col("id") + 1).alias("p")).join(v.select(F.col("id").alias("p")), "p", "left_semi").select("q", "p")
    return topk.pair_scores(ids, v, v).withColumn("score", T.rounded(F.col("score")))


@query("SELECT e.vec_id AS q, e.vec_id + 3 AS p, CASE WHEN b.id IS NULL THEN NULL ELSE round(list_inner_product(a.v, b.v), 6) END AS score FROM embeddings e JOIN vec a ON a.id = e.vec_id LEFT JOIN vec b ON b.id = e.vec_id + 3")
def missing_scores(spark, d):
    v = records.vectors(spark, d).select("id", "v")
    return topk.pair_scores(v.select(F.col("id").alias("q"), (F.col("id") + 3).alias("p")), v, v).withColumn("score", T.rounded(F.col("score")))


@query(f"""SELECT q, p, f_score FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY f_score DESC, round(emb_score, 9) DESC, p) AS rn FROM
    (SELECT w.s1_id AS q, w.cand_id AS p, w.emb_score, round(sum(t.idf), 6) AS f_score FROM
      (SELECT s1_id, cand_id, emb_score FROM scored0 WHERE ch_k3 = 0) w
      JOIN (SELECT DISTINCT entity_id, country, token FROM (SELECT entity_id, country, unnest(list_filter(addr_tokens, lambda x: regexp_full_match(x, '[0-9]+') OR regexp_full_match(x, '[a-z]{{4,}}'))) AS token FROM norm)) a ON a.entity_id = w.s1_id
      JOIN (SELECT DISTINCT entity_id, token FROM (SELECT entity_id, unnest(list_filter(addr_tokens, lambda x: regexp_full_match(x, '[0-9]+') OR regexp_full_match(x, '[a-z]{{4,}}'))) AS token FROM norm)) b ON b.entity_id = w.cand_id AND b.token = a.token
      JOIN (SELECT x.country, x.token, ln(1 + (any_value(n) + 1) / (count(*) + 1)) AS idf FROM (SELECT DISTINCT entity_id, country, token FROM (SELECT entity_id, country, unnest(list_filter(addr_tokens, lambda x: regexp_full_match(x, '[0-9]+') OR regexp_full_match(x, '[a-z]{{4,}}'))) AS token FROM norm)) x JOIN (SELECT country, count(*) AS n FROM norm GROUP BY country) c ON c.country = x.country GROUP BY x.country, x.token) t ON t.country = a.country AND t.token = a.token
      GROUP BY ALL)) WHERE rn <= 10""")
def wide_rerank(spark, d):
    norm = T.normalized(spark, d)
    whole = T.united(norm)
    wide = whole.select(F.col("s1_id").alias("q"), F.col("cand_id").alias("p"), F.col("emb_score").alias("score"))
    present = whole.where("ch_k3 = 1").select(F.col("s1_id").alias("q"), F.col("cand_id").alias("p"))
    tokens = norm.select(F.col("entity_id").alias("id"), "country", F.explode(addresses.rerank_tokens(F.col("addr_tokens"))).alias("token"))
    return topk.wide_rerank(wide, tokens, present)


def _documents(spark, d):
    norm = T.normalized(spark, d)
    return norm.select("country", F.col("entity_id").alias("id"), "source", F.concat_ws(" ", "name_full", "name_skel").alias("text"))


def _text_topk(spark, d, asked: str, k: int, pools: tuple[str, ...]):
    """The ``k`` best for each of the documents ``asked``, of each of the pools."""
    docs = _documents(spark, d)
    made = stage(tfidf.fitted(docs)[1], "weights")
    parts = [tfidf.text_topk(docs.where(asked), docs.where(p), made, k) for p in pools]
    return functools.reduce(DataFrame.unionByName, parts).withColumn("score", T.rounded(F.col("score")))


@query("SELECT country, term, CAST(total AS BIGINT) AS total, df, round(idf, 6) AS idf FROM vocab")
def tfidf_vocab(spark, d):
    return tfidf.fitted(_documents(spark, d))[0].drop("t").withColumn("idf", T.rounded(F.col("idf")))


@query("SELECT country, term, CAST(total AS BIGINT) AS total, df, round(idf, 6) AS idf FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY total DESC, term) AS rn FROM vocab) WHERE rn <= 50")
def tfidf_vocab_limit(spark, d):
    """The fifty most frequent terms of each country."""
    norm = T.normalized(spark, d)
    docs = norm.select("country", F.col("entity_id").alias("id"), F.concat_ws(" ", "name_full", "name_skel").alias("text"))
    return tfidf.vocabulary(tfidf.term_counts(docs), docs, 50).drop("t").withColumn("idf", T.rounded(F.col("idf")))


@query("SELECT country, id, term, round(w, 6) AS w FROM wts")
def tfidf_weights(spark, d):
    docs = _documents(spark, d)
    return tfidf.postings(docs, tfidf.fitted(docs)[1]).select("country", "id", "term", T.rounded(F.col("w")).alias("w"))


_TF = """SELECT q, p, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(score, 9) DESC, p) AS rank FROM
    (SELECT a.id AS q, b.id AS p, sum(a.w * b.w) AS score FROM wts a JOIN wts b ON a.country = b.country AND a.term = b.term AND {on} GROUP BY a.id, b.id)) WHERE rank <= {k}"""


@query(_TF.format(on="a.source = 1 AND b.source = 2", k=10))
def tfidf_topk(spark, d):
    return _text_topk(spark, d, "source = 1", 10, ("source = 2",))


@query(_TF.format(on="a.source = 2 AND b.source = 1", k=5))
def tfidf_topk_reverse(spark, d):
    return _text_topk(spark, d, "source = 2", 5, ("source = 1",))


_TF_WHOLE = """SELECT q, p, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY q, src ORDER BY round(score, 9) DESC, p) AS rank FROM
    (SELECT a.id AS q, b.id AS p, b.source AS src, sum(a.w * b.w) AS score FROM wts a JOIN wts b ON a.country = b.country AND a.term = b.term AND {on} GROUP BY a.id, b.id, b.source)) WHERE rank <= {k}"""


@query(_TF_WHOLE.format(on="a.source = 1 AND b.source > 1", k=10))
def tfidf_topk_pool(spark, d):
    """As ``tfidf_topk``, in each source of the pool."""
    return _text_topk(spark, d, "source = 1", 10, ("source = 2", "source = 3"))


@query(_TF_WHOLE.format(on="a.source > 1 AND b.source = 1", k=5))
def tfidf_topk_pool_reverse(spark, d):
    """As ``tfidf_topk_reverse``, for the records of all sources of the pool."""
    return _text_topk(spark, d, "source > 1", 5, ("source = 1",))


_LEARN = """SELECT src, dst, n, share FROM (SELECT src, dst, n, n / sum(n) OVER (PARTITION BY src) AS share, row_number() OVER (PARTITION BY src ORDER BY n DESC, dst) AS rn FROM
    (SELECT s[i] AS src, t[i] AS dst, count(*) AS n FROM (SELECT s, t, unnest(generate_series(1, len(s))) AS i FROM (SELECT list_filter(y, lambda w: NOT list_contains(x, w)) AS s, list_filter(x, lambda w: NOT list_contains(y, w)) AS t FROM
      (SELECT a.full_t AS x, b.full_t AS y FROM norm a JOIN norm b ON a.country = b.country AND a.addr_tokens[1] = b.addr_tokens[1] AND a.addr_tokens[3] = b.addr_tokens[3] AND a.source = 1 AND b.source > 1))
      WHERE len(s) = len(t) AND len(s) BETWEEN 1 AND 4) GROUP BY ALL)) WHERE rn = 1 AND n >= 1 AND share >= 0.1"""


def _dictionary(spark, d):
    return T.dictionary(T.normalized(spark, d))


@query(f"SELECT src, dst, n, round(share, 6) AS share FROM ({_LEARN})")
def token_dict(spark, d):
    return _dictionary(spark, d).withColumn("share", T.rounded(F.col("share")))


@query(f"SELECT entity_id, (SELECT string_agg(coalesce(l.dst, w.t), ' ' ORDER BY w.i) FROM (SELECT unnest(n.full_t) AS t, generate_subscripts(n.full_t, 1) AS i) w LEFT JOIN ({_LEARN}) l ON l.src = w.t) AS mapped FROM norm n WHERE source > 1")
def dict_rewrite(spark, d):
    table = _dictionary(spark, d).select(F.col("src").alias("t"), "dst")
    toks = T.normalized(spark, d).where("source > 1").select("entity_id", F.posexplode(F.split("name_full", " ")).alias("i", "t"))
    mapped = toks.join(table, "t", "left").select("entity_id", F.struct("i", F.coalesce("dst", "t").alias("t")).alias("x"))
    return mapped.groupBy("entity_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), " ").alias("mapped"))
