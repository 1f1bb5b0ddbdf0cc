import json

import numpy as np
from pyspark.sql import functions as F

from ligature import session
from ligature.operators import blocking, candidates, features, tfidf, tiles, topk
from ligature.sources import records, sinks
from ligature.streaming.incremental import resolve_stream


def test_tsv_keeps_quotes_and_empty_fields(spark, tmp_path):
    p = tmp_path / "r.tsv"
    p.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tA "b\t\tUS\nS2-2\tC\tnull\tUS\n')
    rows = {r["entity_id"]: r for r in records.records_of(records.load_tsv(spark, str(p))).collect()}
    assert rows["S1-1"]["raw_name"] == 'A "b' and rows["S1-1"]["raw_address"] == "" and rows["S2-2"]["source"] == 2


def test_ids_and_gold_lists(spark):
    df = spark.createDataFrame([("S1-1", "S2-7, S3-80"), ("S1-2", "")], "source1_entity_id string, matched_entity_ids string")
    assert sorted(map(tuple, records.gold_pairs(df).collect())) == [("S1-1", "S2-7", 0), ("S1-1", "S3-80", 1)]
    r = spark.createDataFrame([("S2-7",), ("X",)], "i string").select(records.encoded_id("i").alias("c")).collect()
    assert [x["c"] for x in r] == [2_000_000_000_007, None]


def test_block_cap_drops_hot_keys(spark):
    keys = spark.createDataFrame([("S1-1", 1, "k"), ("S1-1", 1, "h")] + [(f"S2-{i}", 2, "h") for i in range(60)] + [("S2-99", 2, "k")], "entity_id string, source int, key string")
    assert [r["cand_id"] for r in blocking.key_join(keys).collect()] == ["S2-99"]


def test_topk_against_numpy(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE", 8)
    rng = np.random.default_rng(0)
    v = rng.normal(size=(60, 5))
    df = spark.createDataFrame([(i, "x", v[i].tolist()) for i in range(60)], "id long, country string, v array<double>")
    found = topk.dense_topk(df.where("id < 20"), df.where("id >= 20"), 3).collect()
    want = {(q, p) for q in range(20) for p in (20 + np.argsort(-(v[20:] @ v[q]))[:3]).tolist()}
    assert {(r["q"], r["p"]) for r in found} == want


def test_union_is_idempotent_and_keeps_extremes(spark):
    a = spark.createDataFrame([("s", "c", 0, 0.5, 2), ("s", "c", 0, 0.7, 1)], "s1_id string, cand_id string, cand_source int, emb_score double, emb_rank int")
    r = candidates.union_channels({"x": a, "y": a.union(a)}).collect()
    assert len(r) == 1 and (r[0]["x"], r[0]["y"], r[0]["emb_score"], r[0]["emb_rank"]) == (1, 1, 0.7, 1)


def test_competitor_context_equals_full_run(spark):
    rows = spark.createDataFrame([(f"s{i % 4}", f"c{i % 7}", i / 30) for i in range(28)], "s1_id string, cand_id string, emb_score double").dropDuplicates(["s1_id", "cand_id"])
    full = features.reverse_rank(features.context(rows))
    part = features.competitors(full, spark.createDataFrame([("s1",)], "s1_id string"))
    both = part.join(full.select("s1_id", "cand_id", F.col("reverse_rank").alias("r")), ["s1_id", "cand_id"]).where("r <> reverse_rank")
    assert both.count() == 0 and part.where("is_competitor = 0").select("s1_id").distinct().count() == 1


def test_validator_finds_each_fault(spark):
    rows = spark.createDataFrame([("S1-1", "S2-1,S2-1"), ("S1-1", ""), ("S1-2", "S1-9,X-1"), ("S1-8", "S3-5")], "s1_id string, ids string")
    expected = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "s1_id string")
    cands = spark.createDataFrame([("S1-1", "S2-1")], "s1_id string, cand_id string")
    n = {r["rule"]: r["n"] for r in sinks.validate(rows, expected, cands).collect()}
    assert n == {"duplicate_s1": 1, "repeated_id": 1, "s1_in_list": 1, "unknown_prefix": 1, "missing_s1": 1, "extra_s1": 1, "not_a_candidate": 3}


def test_result_lists_keep_first_seen_order(spark):
    pairs = spark.createDataFrame([("a", "c2", 1), ("a", "c1", 2), ("a", "c2", 3)], "s1_id string, cand_id string, rank int")
    s1 = sinks.ordered_ids(spark.createDataFrame([("b",), ("a",)], "s1_id string"), "s1_id")
    assert {r["s1_id"]: r["ids"] for r in sinks.result_lists(pairs, s1).collect()} == {"a": "c2,c1", "b": ""}


def test_stream_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps({"id": i}) for i in range(5)))
    stream = spark.readStream.schema("id long").json(str(tmp_path / "in"))
    q = resolve_stream(stream, lambda b: b.withColumn("twice", F.col("id") * 2), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    assert sorted(r["twice"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 2, 4, 6, 8]


def test_sparse_topk_against_plain(spark, monkeypatch):
    monkeypatch.setattr(tfidf, "TILE", 3)
    monkeypatch.setattr(tfidf, "COLUMNS", 2)
    monkeypatch.setattr(tiles, "SPREAD", 1)
    rng = np.random.default_rng(3)
    w = np.where(rng.random((24, 9)) < 0.4, rng.random((24, 9)), 0)
    rows = [("x", f"d{i}", int(t), float(w[i, t])) for i in range(24) for t in range(9) if w[i, t]]
    df = spark.createDataFrame(rows, "country string, id string, t int, w double")
    q, p = df.where("cast(substring(id, 2) as int) < 8"), df.where("cast(substring(id, 2) as int) >= 8")
    got = {(r["q"], r["p"], r["rank"]): r["score"] for r in tfidf.topk(q, p, 2).collect()}
    for i in range(8):
        scores = sorted(((-float(w[i] @ w[j]), f"d{j}") for j in range(8, 24) if w[i] @ w[j] > 0))[:2]
        for rank, (s, name) in enumerate(scores, 1):
            assert abs(got[f"d{i}", name, rank] + s) < 1e-9


def test_stages_resume(spark):
    made = []

    def build():
        made.append(1)
        return spark.range(3)

    key = f"resume {session.new_path(spark, 'x')}"
    assert [session.resumed(spark, "numbers", key, build).count() for _ in range(2)] == [3, 3] and len(made) == 1
    assert session.resumed(spark, "numbers", key, build, force=True).count() == 3 and len(made) == 2


def test_settings_files(spark, tmp_path):
    sinks.write_json(spark, {"t_top1": 0.3, "names": ["a", "é"]}, str(tmp_path / "s"))
    assert sinks.read_json(spark, str(tmp_path / "s")) == {"t_top1": 0.3, "names": ["a", "é"]}


def test_lines_are_numbered_in_the_order_of_their_files(spark, tmp_path):
    """Spark reads the largest files first; the numbers must follow the files' names and lines all the same."""
    at, lines = 0, []
    for i, n in enumerate((3, 400, 1, 90, 0, 250)):
        (tmp_path / f"part-{i:05d}.csv").write_text("x\n" + "".join(f"{at + k}\n" for k in range(n)))
        at += n
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        back = records.load_tsv(spark, str(tmp_path), records.T.StructType([records.T.StructField("x", records.T.StringType())]))
        lines = records.numbered(back, "ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(lines) == at and all(int(r["x"]) + 1 == r["ord"] for r in lines)


def test_tfidf_of_equal_texts_is_made_once(spark):
    """Copies on both sides: the same neighbours as from the postings of all documents, and one vector a text."""
    words = ["amber", "birch", "cedar", "dune", "ember"]
    rows = [("x" if i % 7 else "y", f"{i:03d}", f"{words[i % 5]} {words[i % 3]}") for i in range(120)]
    docs = spark.createDataFrame(rows, "country string, id string, text string")
    vocab, made = tfidf.fitted(docs)
    counts = tfidf.term_counts(docs)
    plain = tfidf.weights(counts, tfidf.vocabulary(counts, docs))
    key = lambda df: sorted((r["country"], r["id"], r["term"], round(r["w"], 9)) for r in df.collect())
    assert key(tfidf.postings(docs, made)) == key(plain)
    assert made.count() == docs.select("country", "text").distinct().count() < 120
    assert {(r["country"], r["term"], r["total"], r["df"]) for r in vocab.collect()} == {(r["country"], r["term"], r["total"], r["df"]) for r in tfidf.vocabulary(counts, docs).collect()}
    q, p = docs.where("id < '060'"), docs.where("id >= '060'")
    top = lambda df: sorted((r["q"], r["p"], r["rank"], round(r["score"], 9)) for r in df.collect())
    assert top(tfidf.text_topk(q, p, made, 4)) == top(tfidf.topk(plain.where("id < '060'"), plain.where("id >= '060'"), 4))


def test_large_vocabulary_is_not_broadcast(spark, tmp_path):
    """A table that is small on disk only: its documents and vocabulary must not go through the driver."""
    spark.range(50_000).selectExpr("'x' AS country", "cast(id AS string) AS id", "'amber birch' AS text").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        posts = tfidf.postings(docs, tfidf.fitted(docs)[1])
        plan = posts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") >= 3 and plan.count("BroadcastHashJoin") <= 1  # the number of documents of a block


def test_norm_is_bound_once(spark):
    """The text is read once for each letter, not once for each pair of letters."""
    from ligature.functions import vectors

    df = spark.createDataFrame([("amber",)], "t string").select(vectors.letter_counts(F.col("t")).alias("v"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("replace(") == 1
    assert abs(sum(x * x for x in df.first()["v"]) - 1) < 1e-12


def test_misses_are_read_in_one_pass(spark, tmp_path):
    """Records that are small on disk only must not go through the driver; the plan reads the gold pairs once."""
    from ligature.operators import metrics

    rows = spark.range(6).selectExpr("concat('S', 1 + id % 2, '-', id) AS entity_id", "cast(1 + id % 2 AS int) AS source", "concat('k', id div 2) AS key", "'a b' AS name_full", "array('x', 'y') AS addr_tokens")
    rows.write.parquet(str(tmp_path / "r"))
    norm = spark.read.parquet(str(tmp_path / "r"))
    spark.createDataFrame([("S1-0", "S2-1"), ("S1-2", "S2-1"), ("S1-4", "S2-5")], "s1_id string, cand_id string").write.parquet(str(tmp_path / "g"))
    gold = spark.read.parquet(str(tmp_path / "g"))
    cands = spark.createDataFrame([("S1-4", "S2-5", 0.5)], "s1_id string, cand_id string, emb_score double")
    keys = {"k1": norm.select("entity_id", "source", "key"), "k2": norm.select("entity_id", "source", F.lit("same").alias("key")), "k3": norm.where("false").select("entity_id", "source", "key")}
    made = metrics.miss_analysis(cands, gold, norm, keys, 1)
    assert sorted(map(tuple, made.collect())) == [("S1-0", "S2-1", 1, 1, 0, 1.0, 1.0, None), ("S1-2", "S2-1", 0, 1, 0, 1.0, 1.0, None)]
    assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString() and len(made.columns) == 8
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1
    assert sorted(map(tuple, metrics.miss_report(cands, gold, keys).collect())) == [("S1-0", "S2-1", 1, 1, 0), ("S1-2", "S2-1", 0, 1, 0)]


def test_copies_are_asked_once(spark):
    """Copies in two blocks, ids in both: the same rows as asking every query, and one query of each text."""
    from ligature.operators import tiles

    rows = [(b, f"{i:02d}", f"t{i % 3}", [float(i % 3 + 1), float(b == "x")]) for b in "xy" for i in range(24)]
    df = spark.createDataFrame(rows, "country string, id string, text string, v array<double>")
    q, p = df.where("id < '12'"), df.where("id >= '12'")
    asked = []

    def find(a, b):
        asked.append((a.count(), b.count()))
        made = [topk.dense_topk(a.where(F.col("country") == c), b.where(F.col("country") == c), 2).withColumn("country", F.lit(c)) for c in "xy"]
        return made[0].unionByName(made[1])

    top = lambda rows: sorted((r["q"], r["p"], r["rank"], round(r["score"], 9)) for r in rows)
    assert top(tiles.once(q, p, 2, "country", "text", find).collect()) == top(find(q, p).collect())
    assert asked == [(6, 12), (24, 24)]


def test_reranking_reads_tokens_once(spark):
    """Tokens stay lists of their record, so a pair is one row."""
    tokens = spark.createDataFrame([("a", "c", "5"), ("a", "c", "main"), ("b", "c", "5"), ("b", "c", "main"), ("d", "c", "5"), ("e", "c", "oak")], "id string, country string, token string")
    wide = spark.createDataFrame([("a", "b", 0.1), ("a", "d", 0.9), ("a", "e", 0.5), ("a", "x", 0.4)], "q string, p string, score double")
    none = spark.createDataFrame([], "q string, p string")
    made = topk.wide_rerank(wide, tokens, none)
    assert [r["p"] for r in sorted(made.collect(), key=lambda r: -r["f_score"])] == ["b", "d"]
    assert {r["p"]: r["f_score"] > 0 for r in topk.wide_rerank(wide, tokens, none, keep_unshared=True).collect()} == {"b": True, "d": True, "e": False, "x": False}
    assert made._jdf.queryExecution().optimizedPlan().toString().count("LeftAnti") == 1  # the wide pairs are read once


def test_records_beside_pairs_are_not_broadcast(spark, tmp_path):
    """Repeated records are small on disk only: pairs and records are joined by sorting."""
    from ligature.operators import features as ft

    spark.range(1000).selectExpr("concat('S', 1 + id % 2, '-', id) AS entity_id", "cast(1 + id % 2 AS int) AS source", "'a b' AS name_full", "'x' AS addr_norm", "'1' AS house_no", "array('1') AS num_tokens", "'US' AS country").write.parquet(str(tmp_path / "r"))
    norm = spark.read.parquet(str(tmp_path / "r"))
    scored = spark.createDataFrame([("S1-0", "S2-1", 0.9, 0.5), ("S1-0", "S2-3", 0.8, 0.5)], "s1_id string, cand_id string, prob double, emb_score double")
    for made in (ft.with_records(scored, norm), ft.stack_features(scored, norm), candidates.label(scored, norm.selectExpr("entity_id AS s1_id", "entity_id AS cand_id"))):
        assert "BroadcastHashJoin" not in made._jdf.queryExecution().executedPlan().toString() and made.count() == 2


def test_lists_are_reranked_as_their_rows_are(spark):
    """Lists of names, which meet their queries as matrices, against the rows of each query."""
    from pyspark.sql import functions as F

    from ligature.operators import topk

    rows = [(f"S1-{i}", "A", f"n{i % 3}", [f"t{j}" for j in range(12) if (i * 7 + j) % 5 < 2]) for i in range(40)]
    pool = [(f"S2-{i}", [f"t{j}" for j in range(12) if (i * 5 + j) % 4 == 0 and i % 9]) for i in range(60)]
    found = [("A", f"n{n}", 2, [(f"S2-{i}", round(1 - ((i * 11 + n) % 30) / 100, 6)) for i in range(60) if (i + n) % 2]) for n in range(3)]
    tokens = spark.createDataFrame([(r[0], "A", t) for r in rows for t in r[3]] + [(p, "A", t) for p, ts in pool for t in ts], "id string, country string, token string")
    queries = spark.createDataFrame([r[:3] for r in rows], "id string, country string, text string").select("country", "text", "id")
    lists = spark.createDataFrame(found, "country string, text string, source int, x array<struct<p: string, score: double>>")
    present = spark.createDataFrame([(f"S1-{i}", f"S2-{(i * k) % 60}") for i in range(0, 40, 2) for k in (1, 3)], "q string, p string").distinct()
    wide = queries.join(lists, ["country", "text"]).select(F.col("id").alias("q"), F.explode("x").alias("x")).select("q", "x.*")
    want = topk.wide_rerank(wide, tokens, present, 10, keep_unshared=True)
    got = topk.list_rerank(queries, lists, tokens, present, 10)
    plain = lambda df: sorted((r["q"], r["p"], round(r["f_score"], 6)) for r in df.collect())
    assert plain(got) == plain(want) and len(plain(got)) == 400


def test_small_inputs_are_dealt_to_all_tasks(spark):
    from ligature.plans import tables

    made = tables.normalizing(spark, "/root/testdata/sf0.001", market=True)
    assert made.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_products_of_vectors(spark):
    from pyspark.sql import functions as F

    from ligature.functions import vectors

    df = spark.createDataFrame([(1, [1.0, 2.0], [3.0, 4.0]), (2, None, [1.0, 1.0]), (3, [0.5, 0.5], [1.0, -1.0])], "i int, a array<double>, b array<double>")
    got = df.withColumn("x", vectors.product(F.col("a"), F.col("b"))).withColumn("y", vectors.dot(F.col("a"), F.col("b"))).orderBy("i").collect()
    assert [r["x"] for r in got] == [r["y"] for r in got] == [11.0, None, 0.0]


def test_support_of_lists(spark):
    """The best cosine to another of the first five, without a vector, alone, and beyond the five."""
    from ligature.operators import features

    pairs = [("a", f"c{i}", 1 - i / 10) for i in range(7)] + [("b", "c0", 0.5), ("c", "c1", 0.5), ("c", "none", 0.4)]
    unit = lambda x: [x, (1 - x * x) ** 0.5]
    vecs = spark.createDataFrame([(f"c{i}", unit(i / 7)) for i in range(7)], "id string, v array<double>")
    got = {(r["s1_id"], r["cand_id"]): r["support"] for r in features.support(spark.createDataFrame(pairs, "s1_id string, cand_id string, emb_score double"), vecs).collect()}
    v = [unit(i / 7) for i in range(7)]
    want = {("a", f"c{i}"): max(v[i][0] * v[j][0] + v[i][1] * v[j][1] for j in range(5) if j != i) for i in range(7)}
    assert len(got) == len(pairs) and all(abs(got[k] - x) < 1e-9 for k, x in want.items())
    assert [got[k] for k in (("b", "c0"), ("c", "c1"), ("c", "none"))] == [0.0, 0.0, 0.0]


def test_only_missing_features_have_flags(spark):
    from ligature.operators import models

    df = spark.createDataFrame([(float(i % 7), None if i % 5 == 0 else float(i), i % 2) for i in range(200)], "a double, b double, label int")
    model = models.train(df, ["a", "b"], rounds=2, depth=2)
    assert model.flags == ["b"] and model.numFeatures == 3
    assert models.score(model, df, ["a", "b"]).where("prob BETWEEN 0 AND 1").count() == 200
    assert abs(sum(v for _, v in models.importance(model, ["a", "b"])) - 1) < 1e-6


def test_columns_are_sent_once(spark):
    """Equal columns of several similarities are one field, and equal pairs of strings are computed once."""
    from pyspark.sql import functions as F

    from ligature.functions import similarity as m
    from ligature.session import ship

    ship(spark)
    a, b = F.col("a"), F.col("b")
    made = m.measures({"x": (m.ratio, a, b), "y": (m.token_sort_ratio, a, b), "z": (m.ratio, b, F.lit(""))})
    df = spark.createDataFrame([("ab c", "c ab"), (None, "q"), ("", None), ("ab c", "c ab")], "a string, b string")
    got = [tuple(r["m"]) for r in df.withColumn("m", made).collect()]
    assert got == [(m.ratio(p, q), m.token_sort_ratio(p, q), m.ratio(q, "")) for p, q in (("ab c", "c ab"), ("", "q"), ("", ""), ("ab c", "c ab"))]
    assert "c2" in made._jc.toString() and "c3" not in made._jc.toString()


def test_reverse_rank_counts_every_member(spark):
    """A row that stands for several S1 takes as many ranks."""
    from ligature.operators import features

    rows = spark.createDataFrame([("a", "p", 0.9, 3), ("b", "p", 0.9, 2), ("c", "p", 0.5, 4), ("d", "p", 0.1, 1), ("c", "q", 0.2, 4)], "s1_id string, cand_id string, emb_score double, times int")
    got = {(r["s1_id"], r["cand_id"]): r["reverse_rank"] for r in features.reverse_rank(rows).collect()}
    assert got == {("a", "p"): 1, ("b", "p"): 1, ("c", "p"): 6, ("d", "p"): 10, ("c", "q"): 1}


def test_derived_once_for_equal_keys(spark):
    """Equal keys share what is made of them; null keys are kept."""
    from pyspark.sql import functions as F

    from ligature.session import derived

    rows = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, None, None), (4, "y", "z")], "id int, a string, b string")
    made = derived(rows, ["a", "b"], lambda t: t.withColumn("c", F.concat_ws("-", "a", "b")))
    assert {r["id"]: r["c"] for r in made.collect()} == {1: "x", 2: "x", 3: "", 4: "y-z"}
