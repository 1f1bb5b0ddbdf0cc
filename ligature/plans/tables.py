"""Tables that several queries start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import addresses, names, vectors
from ..operators import blocking, candidates, channels, decide, features
from ..session import derived, spread, stage, version
from ..sources import records

FLAGS = ["ch_addr", "ch_skel", "ch_rare", "ch_k3"]


def rounded(c: Column) -> Column:
    return F.round(c, 6)


_held: dict[tuple, DataFrame | channels.Grouped] = {}


def held(spark: SparkSession, name: str, sf_dir: str, build: Callable[[], DataFrame], tables: tuple[str, ...] = ("part",)) -> DataFrame:
    """A table that several queries start from, written once for each state of the files that it comes from."""
    state = "".join(version(spark.read.parquet(f"{sf_dir}/{t}.parquet")) for t in tables)
    key = (spark.sparkContext.applicationId, name, state)
    if key not in _held:
        _held[key] = stage(build(), name)
    return _held[key]


NORMAL = ["entity_id", "source", "country", "raw_name", "raw_address", "name_full", "core_name", "core_sorted", "legal", "name_skel", "addr_norm", "addr_tokens", "num_tokens", "house_no", "house_cands", "zip_pin", "state_code"]


def normalizing(spark: SparkSession, sf_dir: str, market: bool = False) -> DataFrame:
    """Normalised catalog records. They are ASCII, so no other script needs a Python function."""
    return _normal(spread(_catalog(spark, sf_dir, market), "entity_id")).select(*NORMAL)


def _catalog(spark: SparkSession, sf_dir: str, market: bool) -> DataFrame:
    return records.catalog_records(spark, sf_dir, "p_brand" if market else "p_type")


def _normal(raw: DataFrame) -> DataFrame:
    return addresses.normalize_addresses(names.normalize_names(raw, scripts="latin", halves=False), scripts="latin")


def normalized(spark: SparkSession, sf_dir: str, market: bool = False) -> DataFrame:
    """Normalised catalog records, written to the shared folder: every step of linkage starts from them. Equal texts are
    normalised once."""
    build = lambda: derived(_catalog(spark, sf_dir, market), ["country", "raw_name", "raw_address"], _normal).select(*NORMAL)
    return held(spark, "market" if market else "normalized", sf_dir, build)


def slim(norm: DataFrame) -> DataFrame:
    return norm.select("entity_id", "source", "country", "name_full", "core_name", "name_skel", "legal", "addr_norm", "addr_tokens", "num_tokens", "house_no", "house_cands", "zip_pin")


def gold(norm: DataFrame) -> DataFrame:
    """Pairs with equal country, name and house number."""
    side = lambda key: norm.select(F.col("entity_id").alias(key), "source", "country", "name_full", "house_no")
    a, b = side("s1_id").where("source = 1").drop("source"), side("cand_id").where("source > 1")
    return a.join(b.hint("merge"), ["country", "name_full", "house_no"]).select("s1_id", "cand_id", (F.col("source") - 2).alias("cand_source"), "country")


def s1_of(norm: DataFrame) -> DataFrame:
    return norm.where("source = 1").select(F.col("entity_id").alias("s1_id"), "country")


def token_score(pairs: DataFrame, norm: DataFrame) -> DataFrame:
    """``emb_score`` of pairs: Jaccard of all name and address tokens, in place of an encoder's cosine."""
    toks = norm.select("entity_id", F.concat(F.split("name_full", " "), F.col("addr_tokens")).alias("t"))
    both = pairs.join(toks.toDF("s1_id", "__a").hint("merge"), "s1_id").join(toks.toDF("cand_id", "__b").hint("merge"), "cand_id")
    return both.withColumn("emb_score", rounded(features.jaccard(F.col("__a"), F.col("__b"), F.lit(0.0)))).drop("__a", "__b")


def found_by(norm: DataFrame) -> dict[str, DataFrame]:
    freq = blocking.token_frequencies(norm)
    return {
        "ch_addr": blocking.key_join(blocking.address_keys(norm)),
        "ch_skel": blocking.key_join(blocking.skeleton_keys(norm)),
        "ch_rare": blocking.key_join(blocking.rare_token_keys(norm, freq)),
        "ch_k3": blocking.key_join(blocking.number_keys(norm, "K3")),
    }


def uniting(norm: DataFrame) -> DataFrame:
    """All channels' pairs with flags and scores, before the cap."""
    return token_score(candidates.union_channels(found_by(norm)).drop("emb_score", "emb_rank"), norm)


def united(norm: DataFrame) -> DataFrame:
    return stage(uniting(norm), "candidates")


def capping(pairs: DataFrame) -> DataFrame:
    return candidates.cap(pairs, ["ch_addr", "ch_k3"])


def candidate_table(norm: DataFrame) -> DataFrame:
    return capping(_once(norm, "candidates", uniting))


def set_features(norm: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    made = features.set_features(features.with_records(candidate_table(norm) if pairs is None else pairs, slim(norm)))
    a, b = F.col("a_addr_tokens"), F.col("b_addr_tokens")
    house = features.ternary((F.col("a_house_no") == "") | (F.col("b_house_no") == ""), F.col("a_house_no") == F.col("b_house_no"))
    return made.select("s1_id", "cand_id", "cand_source", *FLAGS, "emb_score", F.col("a_country").alias("country"), rounded(F.col("name_jaccard")).alias("name_jaccard"), rounded(F.col("num_jaccard")).alias("num_jaccard"), "len_diff", rounded(features.jaccard(a, b, F.lit(0.0))).alias("addr_jaccard"), house.alias("house_match"))


def scoring(pairs: DataFrame, norm: DataFrame) -> DataFrame:
    """Pairs with a probability from the rule score."""
    s = features.rule_score(100 * F.col("name_jaccard"), 100 * F.col("addr_jaccard"), F.col("house_match"))
    return set_features(norm, pairs).select("s1_id", "cand_id", "cand_source", "country", "emb_score", F.round(s / 100, 6).alias("prob"))


def scored(norm: DataFrame) -> DataFrame:
    return _once(norm, "scored", lambda n: scoring(candidate_table(n), n))


def matched(norm: DataFrame) -> DataFrame:
    """Pairs that exclusivity and both thresholds keep."""
    return decide.thresholds(decide.exclusivity(scored(norm)), 0.5, 0.8)


def _once(norm: DataFrame, name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What follows from one written table of records, written once for it."""
    key = (norm.sparkSession.sparkContext.applicationId, name, tuple(sorted(norm.inputFiles())))
    if key not in _held:
        _held[key] = stage(build(norm), name)
    return _held[key]


def full_records(norm: DataFrame) -> DataFrame:
    """Records with every field that features read; the catalog's names have no aliases."""
    halves = {c: F.lit("") for c in ("name_a", "name_b", "name_aka_a", "name_aka_b")}
    derived = {"legal2": names.legal_forms(F.col("raw_name"), F.col("legal")), "street_key": addresses.street_key(F.col("raw_address"))}
    return norm.withColumns(halves | derived)


def dictionary(norm: DataFrame) -> DataFrame:
    """(src, dst, n, share) learned from pairs of one country and address; equal names of one address are counted before
    they meet."""
    rows = norm.select("source", "country", "name_full", F.col("addr_tokens")[0].alias("x"), F.col("addr_tokens")[2].alias("y"))
    by = ["country", "x", "y"]
    side = lambda which, name: rows.where(which).groupBy(*by, F.col("name_full").alias(name)).agg(F.count(F.lit(1)).alias(f"n_{name}"))
    met = spread(side("source = 1", "a"), *by).join(side("source > 1", "b").hint("merge"), by)
    return candidates.learn_dictionary(met.select("a", "b", (F.col("n_a") * F.col("n_b")).alias("n")), least=1, share=0.1)


def learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary of the records by larger countries."""
    return held(spark, "dictionary", sf_dir, lambda: dictionary(normalized(spark, sf_dir, market=True)))


def grouped(spark: SparkSession, sf_dir: str) -> channels.Grouped:
    """Candidates of all channels, by larger countries, once for each group of S1 that have them in common."""
    norm = normalized(spark, sf_dir, market=True)
    key = (spark.sparkContext.applicationId, "grouped", tuple(sorted(norm.inputFiles())))
    if key not in _held:
        _held[key] = channels.grouped(norm, vectors.letter_counts, dictionary=learned(spark, sf_dir))
    return _held[key]


def widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of all channels, by larger countries."""
    found = grouped(spark, sf_dir)
    return channels.expanded(found.table, found.members)


def times(members: DataFrame) -> DataFrame:
    """(s1_id, times): how many S1 each head stands for."""
    return members.groupBy(F.col("head").alias("s1_id")).agg(F.count(F.lit(1)).alias("times")).hint("merge")


def head_gold(norm: DataFrame, members: DataFrame) -> DataFrame:
    """``gold`` of the heads of groups: their members have equal fields, so each has as many."""
    heads = members.where("s1_id = head").select(F.col("s1_id").alias("entity_id"))
    s1 = norm.where("source = 1").join(heads.hint("merge"), "entity_id", "left_semi")
    return gold(norm.where("source > 1").unionByName(s1))
