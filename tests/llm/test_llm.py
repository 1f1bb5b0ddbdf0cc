"""Each operator against brute force, an exact round trip or known answers, with nulls, empty texts, ties and repeats."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ligature.llm import bpe, common, fingerprint, graph, html, media, mixing, neardup, quality, queries, tokenfile, tokens, warc

WORDS = "the of and alpha beta gamma delta omega river stone cloud, light. Été naïve 東京 don't 42 <|endoftext|>".split()


def text_of(n, seed):
    rng = random.Random(seed)
    return "".join(rng.choice(WORDS) + rng.choice([" ", " ", "\n", "  ", "\t"]) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    base = [text_of(rng, i) for i, rng in enumerate([0, 1, 2, 5, 40, 200, 3000])]
    rows = [(i, t, "src", "de", len(t)) for i, t in enumerate(base)]
    rows += [(100, None, None, None, None), (101, base[5], "src", "en", 0), (102, base[5] + " more", "b", "en", 0), (103, " \n ", "b", "en", 0), (104, "x" * 50000, "b", "fr", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


# --- media


@pytest.mark.parametrize("shape", [(1, 1), (7, 5), (64, 64), (3, 5, 3)])
def test_images_round_trip(shape):
    x = np.random.default_rng(1).integers(0, 256, shape, dtype=np.uint8)
    assert (media.decode(media.encode_pgm(x)) == x).all()
    assert (media.decode(media.encode_bmp(x)) == x).all()


def test_other_netpbm_kinds():
    assert media.decode(b"P2\n# c\n2 1\n255\n7 9\n").tolist() == [[7, 9]]
    assert media.decode(b"P1\n2 1\n1 0\n").tolist() == [[0, 255]]
    assert media.decode(b"P4\n2 1\n\x80").tolist() == [[0, 255]]
    for bad in (b"", b"P5\n9 9\n255\nx", b"GIF89a"):
        with pytest.raises(ValueError):
            media.decode(bad)


def test_area_resize_against_means(monkeypatch):
    monkeypatch.setattr(media, "STRIP", 5)
    x = np.random.default_rng(2).integers(0, 256, (24, 18)).astype(np.uint8)
    want = x.reshape(4, 6, 3, 6).mean(axis=(1, 3))
    assert np.allclose(media.area_resize(x, 4, 3), want)
    assert np.allclose(media.area_resize(x, 7, 5).mean(), x.mean(), atol=0.5)


def test_media_payloads(docs, texts):
    out = media.features(common.stage(media.images_of_texts(docs), "media"), keep=("doc_id", "n_bytes")).collect()
    assert len(out) == len(texts)
    for r in out:
        b = texts[r["doc_id"]].encode()
        p = b + bytes(-len(b) % 64 or (0 if b else 64))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))


def test_bmp_masks_and_deep_netpbm():
    pixels = np.array([[0x00112233, 0x00FF8001]], "<u4")
    info = struct.pack("<IiiHHIIiiII", 40, 2, -1, 1, 32, 3, 8, 0, 0, 0, 0) + struct.pack("<III", 0xFF, 0xFF00, 0xFF0000)
    data = struct.pack("<2sIHHI", b"BM", 66 + 8, 0, 0, 66) + info + pixels.tobytes()
    assert media.decode(data).tolist() == [[[0x33, 0x22, 0x11], [0x01, 0x80, 0xFF]]]
    deep = b"P5\n3 1\n65535\n" + np.array([0, 65535, 32768], ">u2").tobytes()
    assert media.decode(deep).tolist() == [[0, 255, 127]]


def test_stored_tiles(spark, docs, texts, tmp_path):
    docs.withColumn("tile", F.lit("x")).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in media.op1_media_columns(spark, str(tmp_path)).collect()}
    for k, t in texts.items():
        b = t.encode()
        x = np.frombuffer(b + bytes(-len(b) % 64 or (0 if b else 64)), np.uint8).reshape(-1, 64).astype(float)
        big = np.kron(x, np.ones((16, 1))).reshape(16, -1, 64).mean(1)  # exact area means by repetition
        tile = np.floor(np.round(big.reshape(16, 16, 4).mean(2), 9) + 0.5)
        assert got[k]["tile_shape"] == "16x16" and abs(got[k]["tile_mean"] - tile.mean()) < 0.02
        rows = np.round(np.kron(x, np.ones((8, 9))).reshape(8, len(x), 9, 64).mean((1, 3)), 6)
        assert got[k]["feature"] == np.packbits(rows[:, :-1] < rows[:, 1:]).tobytes().hex()
    assert len(got) == len(texts) and "tile" not in got[0].asDict()


def test_media_keep_is_replaced(spark):
    df = spark.createDataFrame([(1, media.encode_pgm(np.zeros((2, 2), np.uint8)), "x")], "doc_id long, media binary, feature string")
    assert media.features(df, keep=("doc_id", "feature")).first()["feature"] == "0" * 16


def test_media_nulls_and_damage(spark):
    df = spark.createDataFrame([(1, None), (2, b"junk")], "doc_id long, media binary")
    assert [r["feature"] for r in media.features(df).collect()] == [None, None]


# --- all queries on documents


QUERIES = {n: f for n, f in queries.queries().items() if n.split("_")[0] not in ("op5", "op8")}
CLASHES = ("score", "predicted", "ids", "v", "id", "key", "n", "size", "rank", "block", "shards", "feature", "tile", "component_id", "kind", "x", "start", "media")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows_of_any_kind(spark, tmp_path, name):
    """Nulls, repeated rows and clashing columns: a row for each row. No rows: no rows."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "the river and stone", "en", "a", 1), (1, "the river and stone", "en", "a", 1), (1, "other words here", None, "b", 1), (2, None, None, None, None), (None, "no id", "en", "a", 5), (None, None, None, None, None), (3, "", "en", "b", 0), (4, " \n\t ", "en", "b", 4), (5, "the river and stone", "en", "b", 4)]
    labels = [(1, 1, 0), (5, 0, 1), (None, 1, 0), (3, None, None)]
    for folder, some, marks in (("some", rows, labels), ("none", [], [])):
        spark.createDataFrame(some, schema).withColumns({c: F.lit("x") for c in CLASHES}).write.parquet(str(tmp_path / folder / "documents.parquet"))
        spark.createDataFrame(marks, "doc_id long, quality int, toxic int").withColumns({c: F.lit("x") for c in CLASHES}).write.parquet(str(tmp_path / folder / "labels.parquet"))
    got = QUERIES[name](spark, str(tmp_path / "some")).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    assert QUERIES[name](spark, str(tmp_path / "none")).count() == 0


def test_long_texts_against_the_library(spark):
    long = "".join(text_of(3000, i) for i in range(60)) + "x" * 70_000 + " \n" * 9000
    df = spark.createDataFrame([(1, long)], "doc_id long, text string")
    assert len(long) > bpe.PART_CHARS
    want = reference(bpe.default_vocabulary(), {1: long})[1]
    r = bpe.encode_checked(df, bpe.default_vocabulary()).first()
    assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["decoded_sha256"] == hashlib.sha256(long.encode()).hexdigest()
    assert tokens.token_counts(df, tokens.default_vocabulary()).first()["n_tokens"] == len(reference(tokens.default_vocabulary(), {1: long})[1])


# --- tokens, bpe, token file


def reference(path, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return {k: e.ids for k, e in zip(texts, t.encode_batch(list(texts.values()), add_special_tokens=False), strict=True)}


def test_token_counts(docs, texts):
    want = reference(tokens.default_vocabulary(), texts)
    got = {r["doc_id"]: (r["n_tokens"], r["n_bytes"], r["over_limit"]) for r in tokens.token_counts(docs, tokens.default_vocabulary()).collect()}
    assert got == {k: (len(v), len(texts[k].encode()), len(v) > 2048) for k, v in want.items()}


def test_pieces_with_the_mark_and_without_one():
    own = tokens.encoder(tokens.default_vocabulary())
    texts = {1: f"a{own.mark} {own.mark} {own.mark * 3} b <|endoftext|>x 's don't\u00a0y  é\u0301", 2: own.mark, 3: "plain, words. here,"}
    want = reference(tokens.default_vocabulary(), texts)
    for mark in (own.mark, None):
        one = tokens.Encoder(tokens.default_vocabulary())
        one.mark = mark
        packed = one.packed([t.encode() for t in texts.values()])
        assert [np.frombuffer(x, "<u4").tolist() for x in packed] == list(want.values())
        assert one.count([t.encode() for t in texts.values()]) == [len(x) for x in want.values()]


def test_small_merges_against_plain_merging():
    merges = [(b"a", b"a"), (b"aa", b"a"), (b"b", b"a"), (b"aa", b"ba"), (b"ba", b"aa"), (b"aa", b"aa")]
    vocab = {t: i for i, t in enumerate([b"a", b"b", *(x + y for x, y in merges)])}
    automaton = bpe.Automaton(vocab, merges)

    def plain(word):
        parts = [word[i : i + 1] for i in range(len(word))]
        for x, y in merges:
            i = 0
            while i < len(parts) - 1:
                if (parts[i], parts[i + 1]) == (x, y):
                    parts[i : i + 2] = [x + y]
                i += 1
        return [vocab[p] for p in parts]

    for n in range(1, 12):
        for bits in range(1 << n):
            w = bytes(b"ab"[bits >> i & 1] for i in range(n))
            assert automaton.encode_word(w) == plain(w), w


def test_bpe_round_trip(docs, texts):
    path = bpe.default_vocabulary()
    want = reference(path, texts)
    for r in bpe.decode(bpe.encode(docs, path), path).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == want[r["doc_id"]]
        assert r["decoded"] == texts[r["doc_id"]]
    for r in bpe.encode_checked(docs, path).collect():
        ids = np.array(want[r["doc_id"]], "<u4").tobytes()
        assert (r["n_tokens"], r["ids"], r["ids_sha256"]) == (len(ids) // 4, ids, hashlib.sha256(ids).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_ids_outside_the_vocabulary_emit_nothing():
    own = bpe.codec(bpe.default_vocabulary())
    ids = np.array([own.labels.index(b"a"), 2**31, 10**6, own.labels.index(b"b")], "<u4").tobytes()
    assert own.decode_ids(ids) == "ab"


def test_words_of_letters_go_to_the_model(monkeypatch):
    """With the ids of the whole text; the library is called for what is left only."""
    rng = random.Random(9)
    letters = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
    words = [*letters, *(a + b for a in letters[52:] for b in "aéß"), *("".join(rng.choices(letters[26:], k=rng.randint(2, 12))) for _ in range(3000))]
    signs = ["", ".", ",", "...", "***", "&&&,", "!?", ".,;:!?#%$&*"]
    texts = {i: w + rng.choice(signs) for i, w in enumerate(words)}
    odd = ["don't.", "a'S", "3é.", "é3..", "x€.", "e\u0301.", "I\u0307!", "\u0130.", "ª.", "µ,", "×.", "÷!", "\u03a3\u03a3.", "'s.", "<|endoftext|>.", "a<|endoftext|>!", ".", "...", "é<|.", "\ufb01.", "a\u00adb", "a\u00a0b."]
    texts |= {len(texts) + i: t for i, t in enumerate([*odd, " ".join(odd), " ".join(list(texts.values())[:500])])}
    want = reference(tokens.default_vocabulary(), texts)
    one = tokens.Encoder(tokens.default_vocabulary())
    packed = one.packed([t.encode() for t in texts.values()])
    assert [np.frombuffer(x, "<u4").tolist() for x in packed] == list(want.values())
    assert one.count([t.encode() for t in texts.values()]) == [len(x) for x in want.values()]
    two = tokens.Encoder(tokens.default_vocabulary())
    monkeypatch.setattr(two, "tokenizer", None)
    assert two.packed([b"Word \xc3\xa9t\xc3\xa9"]) == [want_ids(b"Word \xc3\xa9t\xc3\xa9")]


def test_pieces_of_any_white_space():
    every = "".join(f"a{chr(i)}b" for i in range(256))
    texts = ["", " ", "\n\t", " a  b ", every, every.upper(), "é" + every + " ", "a\u2003b\u0085c\x1cd\x1fe", "\x0b\x0c\r", "x"]
    words, places, ends = tokens._cut([t.encode() for t in texts])
    got = [[words[p] for p in places[i:j] if words[p]] for i, j in zip(ends, ends[1:], strict=False)]
    assert got == [(t.lower() if t.isascii() else t).encode().split() for t in texts]
    want = reference(tokens.default_vocabulary(), dict(enumerate(texts)))
    one = tokens.Encoder(tokens.default_vocabulary())
    assert [np.frombuffer(x, "<u4").tolist() for x in one.packed([t.encode() for t in texts])] == list(want.values())
    assert one.count([t.encode() for t in texts]) == [len(x) for x in want.values()]
    assert one.packed([]) == [] and one.count([]) == [] and one.packed([b""]) == [b""] and one.count([b"", b" "]) == [0, 0]


def test_equal_words_reach_the_model_once(monkeypatch):
    """In any case, with any signs around them, in any text of those taken together."""
    own = tokens.Encoder(tokens.default_vocabulary())
    seen, plain = [], own._by_model
    monkeypatch.setattr(own, "_by_model", lambda words: seen.extend(words.to_pylist()) or plain(words))
    texts = ["Été, ÉTÉ! été...", "été;ÉTÉ word word.", "WORD? &word% Word.word"]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.packed([t.encode() for t in texts])] == list(reference(tokens.default_vocabulary(), dict(enumerate(texts))).values())
    assert sorted(seen) == sorted(["word".encode(), "été".encode()])


def test_rows_of_several_batches_are_taken_together():
    column = [pa.record_batch({"k": [i], "t": [b"x" * 10]}) for i in range(7)]
    assert [[b["k"][0].as_py() for b in run] for run in common.together(iter(column), 1, 40)] == [[0, 1, 2], [3, 4, 5], [6]]
    assert list(common.together(iter([]), 1, 40)) == []


def test_cuts_between_letters_and_signs(monkeypatch):
    """Any mix of letters, signs, marks, special tokens and white space has the ids of the whole text, however few bytes go together."""
    rng = random.Random(17)
    some = [*"aAzZéÉßÿÀ×÷µªº.,;:!?#%$&*'<|>3²½\"()-_/@~", *" \n\t\x0b\x1c\x85\xa0\xad", "\u0301", "\u0331", "\u0338", "\u0130", "\u03a3", "\u017f", "\u212a", "\u2019", "\u3000", "\u4e2d", "\U0001f600", "■", "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "word", "Étude", "İ"]
    texts = ["".join(rng.choices(some, k=rng.randint(0, 12))) for _ in range(4000)] + ["".join(rng.choices(some, k=3000)), "a" * 3000 + "É" * 3000 + "." * 3000]
    want = list(reference(tokens.default_vocabulary(), dict(enumerate(texts))).values())
    for sizes in ({}, {"TEXT_BYTES": 500, "WORD_BYTES": 5, "BATCH_BYTES": 40}):
        for name, size in sizes.items():
            monkeypatch.setattr(tokens, name, size)
        for by_rules in (False, True):
            one = tokens.Encoder(tokens.default_vocabulary())
            if by_rules:
                one.words = None
            got = [np.frombuffer(x, "<u4").tolist() for x in one.packed([t.encode() for t in texts])]
            assert [(t, x) for t, x, y in zip(texts, got, want, strict=True) if x != y] == []
            assert one.count([t.encode() for t in texts]) == [len(x) for x in want]


@pytest.mark.parametrize("width", range(1, 33))
def test_bits_side_by_side(width):
    x = np.random.default_rng(width).integers(0, 1 << 32, 512, dtype=np.uint64).astype(np.uint32)
    bits = ((x[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)
    data = tokenfile._narrow(x, width)
    assert data == np.packbits(bits.reshape(-1), bitorder="little").tobytes()
    assert (tokenfile._widen(data, width) == x & np.uint32((1 << width) - 1)).all()


def want_ids(text):
    return np.array(reference(tokens.default_vocabulary(), {0: text.decode()})[0], "<u4").tobytes()


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
@pytest.mark.parametrize("top", [1, 2, 300, 50000, 2**32])
def test_blocks_round_trip(n, top):
    x = np.random.default_rng(n).integers(0, top, n, dtype=np.uint64).astype(np.uint32)
    x[:: max(1, n // 7)] = 2**32 - 1
    data = tokenfile.pack(x)
    assert (tokenfile.unpack(data) == x).all()
    assert (tokenfile.unpack(data, n // 3, n // 2 + 5) == x[n // 3 : n // 2 + 5]).all()


def test_token_file(docs, texts, monkeypatch):
    want = reference(tokens.default_vocabulary(), texts)
    got = {r["doc_id"]: r for r in tokenfile.read_tokens(tokenfile.write_tokens(docs, tokens.default_vocabulary()), with_ids=True).collect()}
    start = 0
    for k in sorted(texts):
        ids = np.array([*want[k], 1], "<u4").tobytes()
        r = got[k]
        assert (r["start"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) == (start, len(ids) // 4, zlib.crc32(ids), ids)
        start += len(ids) // 4


# --- quality


def test_prior_and_separation():
    rng = np.random.default_rng(0)
    good = [("the river and stone of " + text_of(60, i)).encode() for i in range(300)]
    junk = [(" ".join([rng.choice(["ZX!!", "QQ!!", "VV##"])] * 40)).encode() for _ in range(100)]
    x = lambda ts: np.array([quality.describe(t) for t in ts])
    model = quality.fit(x(good[:120]), x(good[120:220] + junk[:50]), x(good[:50] + junk[:50]), np.array([1] * 50 + [0] * 50))
    assert 0.5 < model.prior < 0.85
    s = model.score(x(good[220:] + junk[50:]))
    assert (s[:80] >= 0.7).mean() > 0.95 and (s[80:] < 0.7).mean() > 0.95


def test_quality_edges(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.learn(docs, none)
    out = quality.score(docs.select("doc_id", "text"), model).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert np.isfinite(quality.describe(b"")).all() and np.isfinite(quality.describe(b"\n")).all()


def test_repeated_rows_are_drawn_once(spark):
    rows = [(i, "the river and stone of " + text_of(30, i)) for i in range(400)] + [(1000 + i, f"ZX{i}!! QQ## " * 20) for i in range(100)]
    hot = next(i for i in range(1000, 1050) if zlib.crc32(str(i).encode()) % 4 != 2)
    labels = spark.createDataFrame([(i, 1) for i in range(200)] + [(1000 + i, 0) for i in range(50)], "doc_id long, quality int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    often = once.unionByName(once.where(F.col("doc_id").isin(hot, 3, 300)).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(45)))).drop("n"))
    a, b = (quality.learn(d, labels, sample=300) for d in (once, often))
    assert np.abs(a.weights).max() > 0 and np.allclose(a.weights, b.weights) and np.isclose(a.prior, b.prior)
    picked = spark.createDataFrame([(1, "zz"), (1, "river of stone"), (2, "the sea"), (None, "x")], "doc_id long, text string")
    xs = {t: quality.describe(t.encode()).tobytes() for t in ("zz", "river of stone", "the sea")}
    seen = {}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(quality, "fit", lambda p, u, *a, **b: seen.update(p=p, u=u))
        quality.learn(picked, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert [v.tobytes() for v in seen["p"]] == [min(xs["zz"], xs["river of stone"])] and [v.tobytes() for v in seen["u"]] == [xs["the sea"]]


def test_statistics_of_all_unlabelled(spark):
    """Centre, scale and tails cover every unlabelled document, however few are drawn."""
    texts = {i: text_of(5 + i % 40, i) for i in range(300)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, 1) for i in range(0, 100)], "doc_id long, quality int")
    seen = {}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(quality, "fit", lambda *a, **b: seen.update(b))
        quality.learn(df, labels, sample=20, unlabelled=10)
    x = np.array([quality.describe(texts[i].encode()) for i in range(100, 300)], np.float64)
    corpus = seen["corpus"]
    assert np.allclose(corpus.centre, x.mean(0), atol=1e-5) and np.allclose(corpus.scale, x.std(0) + 1e-4, atol=1e-4)
    w = np.r_[np.linspace(-1, 1, quality.SIZE), 0.5]
    margins = np.sort(quality.ready(x, corpus.centre, corpus.scale) @ w)
    n, above = corpus.tails([w, w], (margins[[49, 149]] + margins[[50, 150]]) / 2)
    assert n == 200 and above.tolist() == [150, 50]


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "the sea", 5.0, "x", 3)], "doc_id long, text string, score double, predicted string, x int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = quality.score(df, quality.learn(df, none))
    assert sorted(out.columns) == ["doc_id", "predicted", "score", "text", "x"] and out.first()["score"] == 0.5
    empty = df.limit(0)
    assert quality.score(empty, quality.learn(empty, none)).count() == 0


def test_held_out_quality(spark):
    """Of the labelled documents that taught nothing, few are on the wrong side of the threshold."""
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in quality.op3_quality_classifier(spark, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(labels[i], r["score"], r["predicted"]) for i, r in got.items() if r["held_out"] and i in labels]
    good, bad = ([s for q, s, _ in held if q == k] for k in (1, 0))
    auc = np.mean([[(g > b) + (g == b) / 2 for b in bad] for g in good])
    assert len(held) > 50 and auc > 0.97 and np.mean([q == p for q, _, p in held]) > 0.93


def test_held_out(spark):
    df = spark.createDataFrame([(i,) for i in range(40)] + [(None,)], "doc_id long")
    got = {r["doc_id"]: r["h"] for r in df.withColumn("h", quality.held_out()).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(40)} | {None: False}


# --- warc


def test_archive(spark, tmp_path):
    long = "<p>" + "é" * 100
    rows = [(3, "u3", long), (1, "u1", long), (2, None, "short"), (4, "u4", "short"), (5, "a\r\nb", None), (None, "n", long), (7, "u7", "a\r\n\r\nb" * 50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    headers, payloads = warc.write_archive(pages)
    out = warc.parse(warc.read_archive(headers, payloads))
    got = {r["page_id"]: r for r in out.collect()}
    assert len(got) == 7 and payloads.count() == 4
    assert {k: (r["record_type"], r["refers_to"]) for k, r in got.items()} == {1: ("response", None), 3: ("revisit", "1"), None: ("revisit", "1"), 2: ("response", None), 4: ("response", None), 5: ("response", None), 7: ("response", None)}
    for p, _, h in rows:
        assert bytes(got[p]["payload"]) == (h or "").encode()
        assert got[p]["length"] == len(got[p]["block"]) and got[p]["digest"] == hashlib.sha256((h or "").encode()).hexdigest()
        if got[p]["record_type"] == "response":
            assert bytes(got[p]["block"]) == (h or "").encode() and bytes(got[p]["record"]).split(b"\r\n\r\n", 1)[1] == (h or "").encode() + b"\r\n\r\n"
    warc.write_files(out, str(tmp_path / "w"), "none")
    whole = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    assert sorted(whole.split(b"WARC/1.1\r\n")[1:]) == sorted(bytes(r["record"])[10:] for r in got.values())


def test_headers_are_exact(spark):
    headers, payloads = warc.write_archive(spark.createDataFrame([(5, "a\r\nb", None), (6, None, "x")], "page_id long, url string, html string"))
    got = {r["page_id"]: r["uri"] for r in warc.parse(warc.read_archive(headers, payloads)).collect()}
    assert got == {5: "a%0D%0Ab", 6: None}
    short = warc.read_archive(headers, payloads).withColumn("record", F.expr("substring(record, 1, length(record) - 1)"))
    with pytest.raises(Exception, match="damaged record"):
        warc.parse(short).collect()


def test_empty_archive(spark):
    headers, payloads = warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.parse(warc.read_archive(headers, payloads)).count() == 0


def test_damaged_payload(spark):
    headers, payloads = warc.write_archive(spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string"))
    bad = payloads.withColumn("payload", F.encode(F.lit("y"), "UTF-8"))
    with pytest.raises(Exception, match="damaged"):
        warc.read_archive(headers, bad).collect()


# --- fingerprints


def plain_vector(text):
    """The fingerprint by plain arithmetic on each piece's hashes."""
    pieces = re.findall(r"(?:[^ \t\n\x0b\f\r]+[ \t\x0b\f\r]*){1,8}", text)
    out = [len(pieces)] + [0] * (fingerprint.WIDE + fingerprint.PACKED)
    for p in pieces:
        h = [xxhash.xxh64(struct.pack("<i", i), seed=xxhash.xxh64(p.encode(), seed=42).intdigest()).intdigest() for i in range(fingerprint.WIDE + fingerprint.HASHES)]
        words = [x % 2**62 for x in h[: fingerprint.WIDE]]
        words += [(x >> j & 1) + (x >> j + 31 & 1) * 2**31 for x in h[fingerprint.WIDE :] for j in range(31)]
        out[1:] = [(a + w) % 2**62 for a, w in zip(out[1:], words, strict=True)]
    return out, Counter(pieces)


def fingerprints_of(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r["v"] for r in fingerprint.fingerprints(rows).collect()}


def test_fingerprints_against_plain_arithmetic(spark):
    texts = ["a b\nc d", "c d\na b", "a b", "c d", "x y", None, "", " \n ", *[text_of(n, n) for n in (1, 8, 9, 200, 2000)]]
    got = fingerprints_of(spark, texts)
    assert got == {i: plain_vector(t or "")[0] for i, t in enumerate(texts)}
    assert got[0] == got[1] != got[2] and got[5] == got[6] == got[7] == [0] * len(got[0])
    df = spark.createDataFrame([tuple(got[i] for i in range(5))], "p array<long>, q array<long>, r array<long>, s array<long>, t array<long>")
    r = df.select((fingerprint.combine(F.col("r"), F.col("s")) == F.col("p")).alias("sum"), (fingerprint.combine(F.col("p"), F.col("s"), -1) == F.col("r")).alias("less"), fingerprint.likeness(F.col("p"), F.col("q")).alias("one"), fingerprint.likeness(F.col("r"), F.col("t")).alias("none")).first()
    assert r["sum"] and r["less"] and r["one"] == 1.0 and r["none"] < 0.5


def test_fingerprint_of_a_very_long_text(spark):
    n = 1_200_000  # pieces, over 2^20
    one, _ = plain_vector("a b c d e f g h ")
    got = fingerprints_of(spark, ["a b c d e f g h \n" * n])[0]
    assert got == [n] + [x * n % 2**62 for x in one[1:]]


def test_fingerprint_query_against_plain(spark, docs, texts, tmp_path):
    docs.withColumn("v", F.lit(1)).withColumn("next", F.lit("x")).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in fingerprint.op6_document_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(texts, reverse=True)
    assert len(got) == len(texts)
    for i, k in enumerate(order):
        t, following = texts[k], texts[order[(i + 1) % len(order)]]
        n = len(t) // 3
        e = t[: len(t) - n] + following[:n]
        assert got[k]["n_chars"] == len(t) and got[k]["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        (own, a), (other, b), (edit, c) = (plain_vector(x) for x in (t, following, e))
        assert got[k]["fingerprint"] == "".join(f"{x:016x}" for x in own[: 1 + fingerprint.WIDE])
        assert got[k]["edited_fingerprint"] == "".join(f"{x:016x}" for x in edit[: 1 + fingerprint.WIDE])
        for name, d, v in (("near_next", b, other), ("near_edited", c, edit)):
            exact = 1.0 if v == own else 0.0 if not a or not d else 2 * sum(a[p] * d[p] for p in a) / (sum(x * x for x in a.values()) + sum(x * x for x in d.values()))
            assert abs(got[k][name] - exact) < 0.2
    assert got[5]["fingerprint"] == got[101]["fingerprint"]
    assert got[6]["near_edited"] > 0.5 > got[6]["near_next"]


def test_fingerprints_of_repeated_rows_and_none(spark, tmp_path):
    rows = [(3, "a b"), (3, "a b"), (3, "c d"), (None, "e"), (None, None), (1, "f g h")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = fingerprint.op6_document_fingerprints(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert fingerprint.op6_document_fingerprints(spark, str(tmp_path / "none")).count() == 0


# --- near duplicates


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (1, 4)] + [(100 + i, 101 + i) for i in range(20)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7} | {100 + i: 100 for i in range(21)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute(texts, k):
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    comp = {i: i for i in texts}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                comp[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_against_brute_force(spark, k):
    rng = random.Random(k)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = {}
    for g in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 150))]
        for _ in range(25 if g == 0 else 6):
            own = list(base)
            for _ in range(rng.randint(0, 8)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts[len(texts)] = " ".join(own)
    texts |= {500: "", 501: "W1 w2", 502: "w1\tW2", 503: "solo"}
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()] + [(504, None, 1)], "doc_id long, text string, rep int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df, words=k).collect()}
    assert got == brute(texts | {504: ""}, k)


def test_near_duplicates_tiles(spark, monkeypatch):
    """Chains in one bucket, whose ends only meet in the comparison of tiles."""
    monkeypatch.setattr(neardup, "TILE", 3)
    monkeypatch.setattr(neardup, "COLUMNS", 7)
    monkeypatch.setattr(neardup, "STAR", 2)
    whole = neardup._linked_cells
    monkeypatch.setattr(neardup, "_linked_cells", lambda *a: whole(*a, cell=10))
    base = [f"v{i}" for i in range(60)]
    texts = {}
    for s in range(40):
        texts[s] = " ".join([f"z{s}" if j == (7 * s) % 60 else f"y{s}" if j == (11 * s + 3) % 60 else w for j, w in enumerate(base)])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df, words=2).collect()}
    assert got == brute(texts, 2)


def test_near_duplicates_find_all_on_given_documents(spark):
    """Every link of the smallest documents, by brute force, and recall of 1."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] or "" for r in rows.collect()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(rows, words=2).collect()}
    assert got == brute(texts, 2)


def test_no_signature_test(spark):
    assert neardup.agreement(80) == 158
    base = [f"v{i}" for i in range(40)]
    texts = {s: " ".join(f"z{s}" if j == s else w for j, w in enumerate(base)) for s in range(8)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df, words=2, agree=0).collect()}
    assert got == brute(texts, 2)


def test_needed_texts_are_found_within_one_small_plan(spark):
    """No job runs before the plan does, and the driver's plan does not hold the bitmap."""
    texts = spark.range(20_000).selectExpr("id", "'t' || id AS text")
    ids = spark.range(0, 20_000, 7).select("id")
    spark.sparkContext.setJobGroup("needed", "")
    found = neardup._needed(ids, texts)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("needed")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found.columns == ["id", "text"]
    assert len(found._jdf.queryExecution().toString()) < 20_000
    got = {r["id"] for r in found.collect()}
    assert got >= set(range(0, 20_000, 7)) and len(got) < 3_200
    assert neardup._needed(ids.where("false"), texts).count() == 0


def test_near_duplicates_empty_table(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# --- html


GOOD = "It is in the nature of things that the river and the stone are by the sea, and that they will be there for you. " * 3


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("<p", ""),
        ("<nav><a href=x>the of and</a></nav><article><h1>T &amp; U</h1><p>one<br>two\n three</p><div class='comments'><p>x</p></div></article><footer>f</footer>", "T & U\none two three"),
        (f"<div class='sidebar'><p>{GOOD}</p></div><p>{GOOD}</p><p>short</p><p>{GOOD}</p>", "\n".join([GOOD.strip(), "short", GOOD.strip()])),
        (f"<p>{GOOD}</p><p><a href=x>{GOOD}</a></p>", GOOD.strip()),
        ("<article><script>var t='</p>';</script><style>p{}</style><!-- c --><p>a<b>b</b>c", "abc"),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_long_text_on_copyright_stays():
    law = "Copyright is the right of an author, and it is for the state to say how long it will be theirs. " + GOOD.strip()
    page = f"<p>{GOOD}</p><p>{law}</p><p>brief</p><p>{GOOD}</p><p>© 2020 Stone Ltd</p><p>Copyright Stone Ltd</p>"
    assert html.main_text(page) == "\n".join([GOOD.strip(), law, "brief", GOOD.strip()])


class Article(HTMLParser):
    """The text blocks of a page's article, by the standard library's parser."""

    CUT = ("p", "h1", "h2", "h3", "li", "ul", "div", "article")

    def __init__(self):
        super().__init__()
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in self.CUT:
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in self.CUT:
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def whole_pages(spark):
    return [r["html"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]


def test_pages_against_another_parser(spark):
    for page in whole_pages(spark):
        other = Article()
        other.feed(page)
        other.close()
        assert html.main_text(page) == "\n".join(x for x in (" ".join(b.split()) for b in other.blocks) if x)


def test_measures_decide_most_blocks(spark):
    """Markup only shifts a class; without articles and class names the measures and neighbours find most of the text."""
    shifted = total = 0
    alike = []
    for page in whole_pages(spark):
        blocks = html.blocks_of(page)
        for b in blocks:
            total += 1
            marked, b.place = html.classify(b), 0
            shifted += html.classify(b) != marked
        plain = re.sub(r"</?(article|footer|nav|aside|header)[^>]*>", "<div>", re.sub(r' class="[^"]*"', "", page))
        got, want = (Counter(html.main_text(x).split("\n")) for x in (plain, page))
        alike.append(2 * (got & want).total() / max(1, got.total() + want.total()))
    assert shifted < total / 3 and np.mean(alike) > 0.75


def test_sections_keep_their_labels_apart():
    note = "Short note"
    page = f"<article><h1>T</h1><p>{GOOD}</p><aside><p>{GOOD}</p></aside><p>{note}</p></article><div class='comments'><p>{GOOD}</p><p>{note} too</p></div>"
    assert html.main_text(page) == "\n".join(["T", GOOD.strip(), note])


def test_extract_rows(spark):
    df = spark.createDataFrame([(1, "u", None), (2, None, "<article>x</article>"), (2, None, "<article>x</article>")], "page_id long, url string, html string")
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in html.extract(df).collect()) == [(1, "", 0), (2, "x", 1), (2, "x", 1)]


# --- mixing


def test_targets(spark):
    sizes = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate([("a", 10), ("b", 1000), ("c", 500), (None, 300)])], "doc_id long, source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    size, weight = {"a": 10, "b": 1000, "c": 500, None: 300}, {"a": 3, "b": 1, "c": 2, None: 3}
    want, full = {}, set()
    while True:
        rest = 1.5 * 1810 - sum(2 * size[s] for s in full)
        want = {s: 2.0 * size[s] if s in full else rest * weight[s] / sum(weight[x] for x in size if x not in full) for s in size}
        above = {s for s in size if s not in full and want[s] > 2 * size[s]}
        if not above:
            break
        full |= above
    assert {k: round(v, 6) for k, v in got.items()} == {k: round(v, 6) for k, v in want.items()}


def test_plan(spark):
    rng = random.Random(5)
    rows = [(i, f"s{i % 4}" if i % 3 else "hot", rng.randint(0, 60)) for i in range(3000)] + [(9999, None, 50), (9999, None, 50)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    out = mixing.plan(df, shards=8).collect()
    assert len(out) == len(rows) and all(0 <= r["copies"] <= 2 and len(r["shards"]) == r["copies"] for r in out)
    for s in {r["source"] for r in out} - {None}:
        own = [r for r in out if r["source"] == s]
        assert abs(sum(r["copies"] * r["size"] for r in own) - own[0]["target"]) <= 60
    per = np.bincount([x for r in out for x in r["shards"]], minlength=8)
    assert per.min() > 0.5 * per.mean()
    again = mixing.plan(df.repartition(7), shards=8).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_split_is_exact():
    q = np.array([100, 0, 37, 5])
    split = mixing.split_quotas(q, 7, 3)
    assert (split.sum(0) == q).all() and split.sum(1).max() - split.sum(1).min() <= 1


def test_empty_mix(spark):
    assert mixing.plan(spark.createDataFrame([], "doc_id long, source string, size long")).count() == 0


def test_mix_query_counts_the_written_rows(spark, tmp_path, monkeypatch):
    rows = [(i, text_of(i % 50, i), f"s{i % 3}") for i in range(400)] + [(9, "one two", None), (None, "a b c", "s0"), (7, text_of(7, 7), "s1"), (7, "x", "s1")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    planned = mixing.plan(mixing.sizes_of(docs)).collect()
    want = sorted(str((r["doc_id"], r["size"], r["source_size"], r["target"], r["copies"] * r["size"])) for r in planned)
    got = mixing.op10_source_mix(spark, str(tmp_path)).collect()
    assert sorted(str(tuple(r)[:5]) for r in got) == want and all(bool(r["shards"]) >= bool(r["taken"]) for r in got)
    lost = next(r["doc_id"] for r in planned if r["copies"] and r["size"] and (r["doc_id"] or 0) > 9)
    whole = mixing.dealt
    monkeypatch.setattr(mixing, "dealt", lambda *a: whole(*a).where(F.col("doc_id") != lost))
    assert [r["taken"] for r in mixing.op10_source_mix(spark, str(tmp_path)).where(F.col("doc_id") == lost).collect()] == [0]


def test_words_are_counted_as_runs(docs, texts):
    got = {r["doc_id"]: r["size"] for r in mixing.sizes_of(docs).collect()}
    assert got == {k: len(t.encode().split()) for k, t in texts.items()}


# --- pipeline


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    good = [(i, "the river and stone of the sea " + text_of(80, 1000 + i), f"s{i % 3}") for i in range(300)]
    junk = [(1000 + i, " ".join([f"Q{i}!!"] * 50), "s0") for i in range(80)]
    copies = [(2000, good[0][1], "s1"), (2001, good[1][1] + " end", "s2")]
    rows = [(i, t, "en", s, len(t)) for i, t, s in good + junk + copies]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, 0) for i in range(150)] + [(1000 + i, 0, 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = common.stage(corpus_pipeline.quality_classifier(spark, docs, str(tmp_path)), "q")
    ids = {r["doc_id"] for r in kept.collect()}
    assert not ids & set(range(1000, 1080)) and len(ids) >= 295
    one = common.stage(corpus_pipeline.minhash_near_dedup(spark, kept, str(tmp_path)), "n")
    left = [r["doc_id"] for r in one.collect()]
    assert not {2000, 2001} & set(left) and len(left) == len(set(left)) and one.columns == docs.columns
    mixed = common.stage(corpus_pipeline.source_mix(spark, one, str(tmp_path)), "m")
    assert mixed.columns == docs.columns and mixed.count() > len(left)
    out = corpus_pipeline.bpe_encoding(spark, mixed, str(tmp_path)).collect()
    by_id = {i: t for i, t, _ in good}
    assert len(out) == mixed.count() and all(r["decoded_sha256"] == hashlib.sha256(by_id[r["doc_id"]].encode()).hexdigest() for r in out)
