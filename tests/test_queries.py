import math

import duckdb
import pytest

from ligature.operators import features
from ligature.plans import registry

SF = "/root/testdata/sf0.001"


def _plain(v):
    if v is None or isinstance(v, (str, bool)):
        return str(v)
    v = float(v)
    return "None" if math.isnan(v) else f"{v + 0.0:.5f}"


@pytest.fixture(scope="module")
def db():
    found = duckdb.connect()
    for t in ("part", "customer", "supplier", "documents", "embeddings"):
        found.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return found


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_sql(spark, db, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    cur = db.execute(registry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(_plain(dict(zip(names, r, strict=True))[c]) for c in cols) for r in cur.fetchall())
    assert sorted(tuple(_plain(r[c]) for c in cols) for r in df.collect()) == want


def test_every_statement_names_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_whole_texts(spark, tmp_path):
    rows = [(1, "one two three four five six séven"), (2, "plain words only, but more than six of them"), (3, None), (4, ""), (5, "x " * 9000 + "Großé")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["ascii"], r["folded"]) for r in registry.queries()["translit_whole_text"](spark, str(tmp_path)).collect()}
    assert got == {1: (False, "one two three four five six seven"), 2: (True, rows[1][1]), 3: (True, ""), 4: (True, ""), 5: (False, "x " * 9000 + "Grosse")}


@pytest.mark.parametrize("name", ["tfidf_topk_pool", "tfidf_topk_pool_reverse"])
def test_tfidf_searches_every_source(spark, name):
    side = "q" if name.endswith("reverse") else "p"
    got = registry.queries()[name](spark, SF).select(side).distinct().collect()
    assert {r[side].split("-")[0] for r in got} == {"S2", "S3"}


def test_all_features_at_once(spark):
    """The whole table against the operators one by one, and the rule score against its parts."""
    from pyspark.sql import functions as F

    rows = registry.queries()["pair_features_all"](spark, SF)
    assert [c for c in rows.columns if c not in ("s1_id", "cand_id", "label", "rule_score")] == features.MODEL
    rel = registry.queries()["relative_scores"](spark, SF)
    got = rows.join(rel.select("s1_id", "cand_id", F.col("comb_cos_rel").alias("r"), F.col("tfidf_score_rk").alias("k")), ["s1_id", "cand_id"])
    assert got.count() == rows.count() > 300
    assert got.where("abs(r - comb_cos_rel) > 1e-5 OR k <> tfidf_score_rk").count() == 0
    best = F.greatest("name_token_sort", "core_ratio")
    rule = 0.5 * best + 0.3 * F.coalesce("addr_token_set", F.lit(0.0)) + F.when(F.col("house_match") == 1, 20.0).otherwise(0.0)
    assert rows.where(F.abs(rule - F.col("rule_score")) > 1e-4).count() == 0


def test_models_find_held_out_matches(spark):
    rows = registry.queries()["cross_fit_stack"](spark, SF).collect()
    hit = [r["prob"] for r in rows if r["label"] == 1]
    miss = [r["prob"] for r in rows if r["label"] == 0]
    assert hit and sum(hit) / len(hit) > 0.5 > sum(miss) / len(miss)
    top = registry.queries()["train_filter"](spark, SF).groupBy("s1_id").count().agg({"count": "max"}).first()[0]
    assert top <= 15
    found = registry.queries()["feature_importance"](spark, SF).collect()
    assert sorted(r["feature"] for r in found) == sorted(features.MODEL) and abs(sum(r["importance"] for r in found) - 1) < 1e-4


def test_features_use_the_whole_dictionary(spark, monkeypatch):
    """A dictionary beyond what becomes a map is joined, not cut: the rewritten names are the same."""
    from ligature.operators import channels
    from ligature.plans import tables

    def found():
        for key in [k for k in tables._held if k[1] == "featured"]:
            monkeypatch.delitem(tables._held, key)
        rows = registry.queries()["pair_features_all"](spark, SF).select("s1_id", "cand_id", "dict_name_ratio").collect()
        return {(r["s1_id"], r["cand_id"]): r["dict_name_ratio"] for r in rows}

    whole = found()
    monkeypatch.setattr(channels, "MAPPED", 2)
    assert found() == whole


def test_dictionary_counts_pairs(spark):
    """Copies on both sides of an address count with all their pairs, though they are aligned once."""
    from ligature.plans import tables

    rows = [(1, "old ring"), (1, "old ring"), (1, "old bolt"), (2, "new ring"), (3, "new ring"), (3, "new ring"), (2, "dim bolt")]
    norm = spark.createDataFrame([(s, "X", n, ["1", "brand", "2"]) for s, n in rows], "source int, country string, name_full string, addr_tokens array<string>")
    got = {r["src"]: (r["dst"], r["n"]) for r in tables.dictionary(norm).collect()}
    assert got == {"new": ("old", 9), "ring": ("bolt", 3), "dim": ("old", 3), "bolt": ("ring", 2)}


def test_copies_are_asked_once(spark, tmp_path):
    """S1 with equal fields and finds are one group, and its rows are those of all its members."""
    from pyspark.sql import functions as F

    from ligature.plans import tables

    part = spark.read.parquet(f"{SF}/part.parquet").where("p_partkey < 60")
    part.crossJoin(spark.range(0, 12)).withColumn("p_partkey", F.col("p_partkey") + 200 * F.col("id")).drop("id").write.parquet(f"{tmp_path}/part.parquet")
    members = tables.grouped(spark, str(tmp_path)).members
    assert members.select("head").distinct().count() < members.count() == 240
    db = duckdb.connect()
    db.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    for name in ("all_channels", "provenance_counts", "filter_features", "staged_recall"):
        df = registry.queries()[name](spark, str(tmp_path))
        want = db.execute(f"SELECT {', '.join(df.columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
        assert sorted(tuple(map(_plain, r)) for r in df.collect()) == sorted(tuple(map(_plain, r)) for r in want)
