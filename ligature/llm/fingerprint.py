"""Document fingerprints by homomorphic multiset hashing, in DataFrame functions only.

A text is taken as the multiset of its paragraphs, long ones cut into pieces of ``WORDS`` words. Each piece is hashed
to a wide vector: ``WIDE`` words of 62 uniform bits, and ``PACKED`` words that hold 0 or 1 in each of two 31-bit lanes.
The fingerprint is the sum of the vectors modulo 2^62 in each word, with the number of pieces. It does not depend on
the order of the pieces; fingerprints add up under concatenation of multisets (``combine``), and pieces can be added or
taken away later. A lane holds the sum of 2^31 - 1 pieces, more than any text can have, without reaching the next one.

The wide words tell multisets apart. The lanes are sums of random signs, so the products of two texts' lanes estimate
the size of their common multiset, and ``likeness`` is twice that over the sum of their own. Its standard error is
1 / sqrt(lanes) for texts without anything in common, and less the more alike they are.

Pieces are rows of an aggregation, whose sums are generated code; they stay in the task that holds their text.

Defined results: null and empty texts have no pieces and the all-zero fingerprint; two such are alike (1), one such
and another text are not (0); equal texts have equal fingerprints. Order: ids descending, null ids last, ties by text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

WORDS = 8
WIDE = 4
#: Per 64-bit hash, 31 words with two lanes each: 62 lanes.
HASHES = 6
PACKED = 31 * HASHES
_MASK = (1 << 62) - 1
_HALF = (1 << 31) - 1
_LANES = 1 | 1 << 31
#: Most buckets of the global order; each is read as one window.
BUCKETS = 16384


def pieces(text: Column) -> Column:
    """The pieces of a text: up to ``WORDS`` words in a row of one line."""
    return F.regexp_extract_all(text, F.lit(rf"(?:\S++[^\S\n]*+){{1,{WORDS}}}"), F.lit(0))


def vectors(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    """``by`` columns, which name one row each, and ``v``, the fingerprint of the row's text as an array of longs: number
    of pieces, wide words, packed lanes. No shuffle is needed if ``df`` is partitioned by some of ``by``."""
    split = df.select(*by, F.explode_outer(pieces(F.col(text))).alias("__p"))
    hashes = [F.when(F.col("__p").isNull(), 0).otherwise(F.xxhash64("__p", F.lit(i))).alias(f"__h{i}") for i in range(WIDE + HASHES)]
    hashed = split.select(*by, F.col("__p").isNotNull().cast("long").alias("__n"), *hashes)
    sums = [F.sum("__n").alias("__s")]
    for i in range(WIDE):  # halves, whose sums cannot overflow
        sums += [F.sum(F.shiftrightunsigned(f"__h{i}", at).bitwiseAND(F.lit(_HALF))).alias(f"__w{i}_{at}") for at in (0, 31)]
    for i in range(WIDE, WIDE + HASHES):
        sums += [F.sum(F.shiftrightunsigned(f"__h{i}", j).bitwiseAND(F.lit(_LANES))).alias(f"__l{i}_{j}") for j in range(31)]
    wide = [(F.col(f"__w{i}_0") + F.shiftleft(F.col(f"__w{i}_31").bitwiseAND(F.lit(_HALF)), 31)).bitwiseAND(F.lit(_MASK)) for i in range(WIDE)]
    lanes = [F.col(f"__l{i}_{j}") for i in range(WIDE, WIDE + HASHES) for j in range(31)]
    return hashed.groupBy(*by).agg(*sums).select(*by, F.array("__s", *wide, *lanes).alias("v"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of both multisets together, or with -1 that of ``a`` without ``b``."""
    word = lambda x, y: (x + y if sign > 0 else x + (F.lit(_MASK) - y) + F.lit(1)).bitwiseAND(F.lit(_MASK))
    return F.zip_with(a, b, word)


def digest(v: Column) -> Column:
    """The number of pieces and the wide words in hex: equal for equal multisets, and they too add up."""
    return F.lower(F.array_join(F.transform(F.slice(v, 1, 1 + WIDE), lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def _product(a: Column, b: Column) -> Column:
    """The sum over all lanes of the products of the sums of signs; a lane's sum of signs is 2 c - n."""
    na, nb = a[0].cast("double"), b[0].cast("double")
    low = lambda x: x.bitwiseAND(F.lit(_HALF))
    high = lambda x: F.shiftrightunsigned(x, 31)
    word = lambda x, y: (F.lit(2.0) * low(x) - na) * (F.lit(2.0) * low(y) - nb) + (F.lit(2.0) * high(x) - na) * (F.lit(2.0) * high(y) - nb)
    lanes = lambda v: F.slice(v, 2 + WIDE, PACKED)
    return F.aggregate(F.zip_with(lanes(a), lanes(b), word), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    """The product of a fingerprint with itself."""
    return _product(v, v)


def likeness(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """0 to 1 from two fingerprints: 1 if they are equal, else the estimated share of common pieces."""
    own = (norm(a) if norm_a is None else norm_a) + (norm(b) if norm_b is None else norm_b)
    shared = F.when(own > 0, 2 * _product(a, b) / own).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).when((a[0] == 0) | (b[0] == 0), F.lit(0.0)).otherwise(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), shared)), 6))


def _bucket(key: Column, splits: list) -> Column:
    """The number of splits that are at most the key, by binary search; null keys before all."""
    if not splits:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(splits).bit_length()))]
    array = F.array(*[F.lit(x) for x in splits])
    at = F.lit(0)
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), at, lambda n, s: F.when((n + s <= len(splits)) & (F.try_element_at(array, n + s) <= key), n + s).otherwise(n))
    return F.when(key.isNull(), F.lit(-1)).otherwise(found)


def with_next(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Adds ``next`` (a struct of ``columns``): of the row that follows in descending order of the key, and of the
    first row for the last one. ``__bucket`` and ``__row`` name a row; ``__ghost`` rows are copies of a bucket's
    successor, which close the bucket and are to be dropped.

    Rows go to buckets between quantiles of the key; the first row of each bucket is also sent, as a ghost, to the
    bucket before it, so every bucket is finished by itself. The number of buckets follows the shuffle partitions, and
    only one key a bucket reaches the driver.
    """
    n = min(BUCKETS, 8 * common.partitions(df.sparkSession))
    keys = df.select(F.col(key).alias("__key"))
    splits = keys.agg(F.percentile_approx("__key", F.array(*[F.lit(i / n) for i in range(1, n)]), F.lit(20 * n)).alias("s")).first()["s"] if n > 1 else None
    splits = sorted(set(splits or []))
    heads = keys.groupBy(_bucket(F.col("__key"), splits).alias("__bucket")).agg(F.max("__key").alias("__key")).collect()  # at most BUCKETS + 1 rows
    heads = sorted(((r["__bucket"], r["__key"]) for r in heads), reverse=True)
    before = [heads[i - 1][0] for i in range(len(heads))]  # of the first bucket: the last
    ghosts = {bucket: other for (bucket, _), other in zip(heads, before, strict=True)}
    tops = {bucket: top for bucket, top in heads}
    spark = df.sparkSession
    top_type = df.schema[key].dataType.simpleString()
    sent = spark.createDataFrame([(tops[b], ghosts[b]) for b in ghosts], f"__top {top_type}, __to int")
    own = df.withColumn("__bucket", _bucket(F.col(key), splits).cast("int"))
    own = own.join(F.broadcast(sent), F.col(key).eqNullSafe(F.col("__top")), "left")
    both = own.withColumn("__to", F.explode(F.when(F.col("__to").isNull(), F.array(F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("g")))).otherwise(F.array(F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("g")), F.struct(F.col("__to").alias("b"), F.lit(True).alias("g"))))))
    both = both.withColumn("__bucket", F.col("__to.b")).withColumn("__ghost", F.col("__to.g")).drop("__to", "__top")
    order = W.partitionBy("__bucket").orderBy("__ghost", F.col(key).desc_nulls_last(), *columns)
    return both.withColumn("next", F.lead(F.struct(*columns)).over(order)).withColumn("__row", F.row_number().over(order))


def edited(text: Column, following: Column) -> Column:
    """The text with its last third replaced by as many of the first code points of another one."""
    n = F.length(text)
    k = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - k), F.substring(following, F.lit(1), k))


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, v): the fingerprint of every whole text (null: empty); repeated rows stay rows."""
    rows = documents.select(F.monotonically_increasing_id().alias("__row"), F.col(key), common.text_or_empty(text).alias("__text"))
    return vectors(rows, "__text", ["__row", key]).drop("__row")


def edits(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, v, edited_v, near_edited, near_next) of every text, of that text with its last third
    taken from the next document's beginning, and of the next document.

    Texts are shuffled once, into buckets of neighbours; their pieces and sums stay in the bucket's task.
    """
    own = documents.select(F.col(key).alias("__key"), common.text_or_empty(text).alias("text"))
    rows = with_next(own, "__key", ["text"])
    rows = rows.select("__bucket", "__row", "__ghost", "__key", "text", edited(F.col("text"), F.col("next.text")).alias("edited"))
    both = F.array(F.struct(F.lit(0).alias("kind"), F.col("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))
    texts = rows.select("__bucket", "__row", "__ghost", "__key", F.explode(F.when(F.col("__ghost"), F.slice(both, 1, 1)).otherwise(both)).alias("t"))
    digest_of = F.when(F.col("t.kind") == 1, F.sha2(F.encode("t.text", "UTF-8"), 256))
    texts = texts.select("__bucket", "__row", "__ghost", "__key", F.col("t.kind").alias("__kind"), F.length("t.text").cast("long").alias("n_chars"), digest_of.alias("edited_sha256"), F.col("t.text").alias("__text"))
    found = vectors(texts, "__text", [c for c in texts.columns if c != "__text"]).withColumn("norm", norm(F.col("v")))
    # a row's text and its edited text are neighbours, and so is the next row's text
    order = W.partitionBy("__bucket").orderBy("__row", "__kind")
    found = found.withColumn("e", F.lead(F.struct("v", "norm", "edited_sha256")).over(order)).withColumn("x", F.lead(F.struct("v", "norm"), 2).over(order))
    found = found.where("__kind = 0 AND NOT __ghost")
    near = lambda other: likeness(F.col("v"), F.col(f"{other}.v"), F.col("norm"), F.col(f"{other}.norm"))
    return found.select(F.col("__key").alias(key), "n_chars", F.col("e.edited_sha256").alias("edited_sha256"), "v", F.col("e.v").alias("edited_v"), near("e").alias("near_edited"), near("x").alias("near_next"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = edits(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", digest(F.col("v")).alias("fingerprint"), digest(F.col("edited_v")).alias("edited_fingerprint"), "near_edited", "near_next")
