"""Near duplicates by min-max hashing.

A document's set holds its distinct shingles of ``words`` words (lower-cased A-Z; words are runs without ASCII white
space; with fewer words, all of them are one shingle). Under each of ``HASHES`` permutations both the smallest and the
largest hash of the set are kept: each agrees between two sets with the probability of their similarity, so half as
many hashes are evaluated for a signature of a given length, and its variance is lower. Bands of ``ROWS`` values make
candidates; at a similarity of 0.8, all 40 bands of 6 fail for one pair in 190,000.

Documents with equal sets are one class. In each bucket of a band the smallest and the largest class are compared with
all others, which is linear in the bucket and joins nearly all of a group of copies. What is left are classes of one
bucket in different components: those outside the bucket's largest component are compared with all others on their full
sets, within cells that one task holds, by products of 0/1 matrices. Only links that join components leave a cell, so
no bucket is expanded into its pairs and no link between components is lost.

Before the sets of a smallest or largest class and another one are compared, their signatures are: at 0.8,
158 of 240 bytes must agree, which a pair fails with a chance below 1e-7; ``agree=0`` leaves this out.

Defined results: null and empty texts have empty sets and are linked with nothing; rows with one id count as one
document; rows with a null id join the component of their equals, or none (null).
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .graph import components

WORDS = 5
PERCENT = 80
HASHES = 120
ROWS = 6
BANDS = 2 * HASHES // ROWS
#: Shingles hashed at a time.
CHUNK = 2048
#: Classes of a bucket that one task holds, where their sets have ``MEAN`` shingles at most on average.
CELL = 4096
MEAN = 1024
#: Rows and columns of the matrices that count common shingles.
TILE = 256
COLUMNS = 8192
#: Members of a star that one task compares with its pivot.
STAR = 500
#: Bits of the map that keeps texts which no pair needs out of the shuffle; for many ids it lets more texts through.
BITS = 1 << 22

_FACTORS = common.constants(HASHES, 3) | np.uint64(1)
_STEPS = common.constants(64, 5) | np.uint64(1)


class Shingler:
    """Sets of 64-bit shingle hashes of texts in UTF-8."""

    def __init__(self, words: int):
        self.words = words

    def set_of(self, text: bytes) -> np.ndarray:
        """The sorted distinct shingle hashes."""
        cut = text.lower().split()  # of bytes: only A-Z and ASCII white space
        if not cut:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, cut), np.uint64, len(cut))
        k = min(self.words, len(h))
        out = np.full(len(h) - k + 1, np.uint64(k))
        for j in range(k):
            out = (out ^ h[j : j + len(out)]) * _STEPS[j]
            out ^= out >> np.uint64(29)
        return np.unique(common.mix64(out))


def min_max(hashes: np.ndarray) -> np.ndarray:
    """The signature of a set that is not empty: the smallest values, then the largest."""
    low = np.full(HASHES, np.uint64(2**64 - 1))
    high = np.zeros(HASHES, np.uint64)
    for at in range(0, len(hashes), CHUNK):
        values = hashes[None, at : at + CHUNK] * _FACTORS[:, None]
        np.minimum(low, values.min(1), out=low)
        np.maximum(high, values.max(1), out=high)
    return np.concatenate([low, high])


def band_keys(signature: np.ndarray) -> np.ndarray:
    part = signature.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for j in range(ROWS):
        key = common.mix64(key * _STEPS[0] ^ part[:, j])
    return key.view(np.int64)


def signatures(documents: DataFrame, words: int, key: str, text: str) -> DataFrame:
    """(id, n, same, sig, keys): size of the set, its digest, low bytes of the signature, hashes of the bands."""
    source = documents.select(F.col(key).alias("id"), F.encode(common.text_or_empty(text), "UTF-8").alias("text"))
    schema = source.select("id").schema.simpleString()[7:-1] + ", n long, same binary, sig binary, keys array<long>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            n, same, sig, keys = [], [], [], []
            for text in batch.column(1).to_pylist():
                found = shingler.set_of(text)
                values = min_max(found) if len(found) else np.zeros(0, np.uint64)
                n.append(len(found))
                same.append(blake2b(found.tobytes(), digest_size=16).digest())
                sig.append((common.mix64(values) & np.uint64(255)).astype(np.uint8).tobytes())
                keys.append(band_keys(values) if len(found) else [])
            made = [pa.array(n, pa.int64()), pa.array(same, pa.binary()), pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["id", "n", "same", "sig", "keys"])

    return common.in_arrow(source, work, schema)


def agreement(percent: int) -> int:
    """Matching bytes of two signatures, of sets at ``percent``, that all but one pair in ten million reach: 5.4 standard
    deviations under the mean."""
    p, n = percent / 100, 2 * HASHES
    return max(0, int(n * (p + (1 - p) / 256) - 5.4 * (n * p * (1 - p)) ** 0.5))


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _alike(pairs: DataFrame, classes: DataFrame, agree: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree in ``agree`` bytes at least."""
    if not agree:
        return pairs.select("a", "b")
    sig = classes.select("id", "sig")
    both = pairs.join(sig.toDF("a", "__sa"), "a").join(sig.toDF("b", "__sb"), "b").select("a", "b", "__sa", "__sb")
    schema = pairs.select("a", "b").schema.simpleString()[7:-1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
                yield batch.select([0, 1]).filter(pa.array((x == y).sum(1) >= agree))

    return common.in_arrow(both, work, schema)


def _linked_cells(open_rows: DataFrame, sets: DataFrame, percent: int, cell: int = CELL) -> DataFrame:
    """Links (a, b) between different components of a bucket, enough of them to join all that are linked.

    ``open_rows`` are (k, id, n, c, minor): the classes of each bucket, their components, and whether a class lies
    outside the bucket's largest component. A bucket of up to ``cell`` classes and as many times ``MEAN`` shingles is
    one cell, which one task holds; a larger one is dealt into groups by a hash of the id, and each pair of groups is a
    cell of its own. A row travels with its set, once for each cell, and only confirmed links leave a cell.
    """
    kind = open_rows.schema["id"].dataType.simpleString()
    groups = open_rows.groupBy("k").agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(cell)), F.ceil(F.sum("n") / F.lit(cell * MEAN))).cast("int").alias("groups"))
    rows = open_rows.join(groups, "k").withColumn("g", F.pmod(F.xxhash64("id"), F.col("groups")).cast("int"))
    rows = rows.join(sets, "id").select("k", "id", "n", "c", "minor", "g", "hashes", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("other"))
    rows = rows.select("k", F.least("g", "other").alias("i"), F.greatest("g", "other").alias("j"), "id", "n", "c", "minor", "g", "hashes")

    def work(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("id").combine_chunks()
        n, g = (table.column(x).to_numpy() for x in ("n", "g"))
        minor = np.array(table.column("minor").to_pylist(), bool)
        c = table.column("c").to_pylist()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("hashes").combine_chunks()]
        left = np.flatnonzero(g == key[1].as_py())
        right = np.flatnonzero(g == key[2].as_py())
        found = _forest(left, right, sets, n, minor, c, percent)
        a, b = (pa.array([x[i] for x in found], pa.int64()) for i in (0, 1))
        return pa.table([ids.take(a), ids.take(b)], ["a", "b"])

    common.tune(open_rows.sparkSession)
    return rows.groupBy("k", "i", "j").applyInArrow(work, f"a {kind}, b {kind}")


def _forest(left: np.ndarray, right: np.ndarray, sets: list[np.ndarray], n: np.ndarray, minor: np.ndarray, c: list, percent: int) -> list[tuple[int, int]]:
    """Linked pairs of a row in ``left`` and one in ``right``, one of them minor, that join components not yet joined."""
    above: dict = {}

    def root(x):
        while x in above:
            x = above[x]
        return x

    out = []
    for xs, ys in ((left[minor[left]], right), (left[~minor[left]], right[minor[right]])):
        for p in range(0, len(xs), TILE):
            for q in range(0, len(ys), TILE):
                x, y = xs[p : p + TILE], ys[q : q + TILE]
                shared = _intersections([sets[i] for i in x], [sets[i] for i in y])
                fits = shared * 100 >= percent * (n[x][:, None] + n[y][None, :] - shared)
                for i, j in np.argwhere(fits).tolist():
                    u, v = root(c[x[i]]), root(c[y[j]])
                    if u != v:
                        above[u] = v
                        out.append((int(x[i]), int(y[j])))
    return out


def _intersections(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections of two lists of sets: products of 0/1 matrices over the values in both."""
    x, y = np.concatenate(xs), np.concatenate(ys)
    rows = [np.repeat(np.arange(len(s)), [len(v) for v in s]) for s in (xs, ys)]
    both = np.intersect1d(x, y)
    out = np.zeros((len(xs), len(ys)), np.int64)
    for at in range(0, len(both), COLUMNS):
        part = both[at : at + COLUMNS]
        made = []
        for values, row, m in ((x, rows[0], len(xs)), (y, rows[1], len(ys))):
            place = np.searchsorted(part, values)
            place[place == len(part)] = 0
            hit = part[place] == values
            matrix = np.zeros((m, len(part)), np.float32)
            matrix[row[hit], place[hit]] = 1
            made.append(matrix)
        out += (made[0] @ made[1].T).astype(np.int64)
    return out


def _sets(ids: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(id, hashes): the sorted shingle hashes of every id, as binary."""
    wanted = _needed(ids, texts).join(ids, "id").select("id", "text")
    kind = texts.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            found = [shingler.set_of(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["id", "hashes"])

    return common.in_arrow(wanted, work, f"id {kind}, hashes binary")


def _needed(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose id may be among ``ids``, by a bitmap of ``BITS`` hash buckets; never fewer. The bitmap
    is a table of ``BITS`` / 64 words at most, which is broadcast: a literal would be printed again in each state of each
    plan that the driver keeps."""
    bucket = F.pmod(F.xxhash64("id"), F.lit(BITS))
    marks = ids.select(bucket.alias("k")).groupBy(F.expr("k div 64").alias("__word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(k % 64 as int))")).alias("__bits"))
    held = texts.withColumn("__k", bucket).join(F.broadcast(marks), F.expr("__k div 64 = __word"))
    return held.where(F.expr("__bits & shiftleft(1L, cast(__k % 64 as int)) <> 0")).select(texts.columns)


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    Texts meet at the pivot ``a``: its text and those of its members are sent to one place, a pivot with many members
    to several places, each with a copy of the pivot's text. A task reads its rows in order and holds one pivot's set.
    """
    pairs = common.stage(pairs.distinct(), "pairs")
    places = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(STAR)).cast("int").alias("k"))
    members = pairs.join(places, "a").select(F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), F.col("k")).cast("int").alias("place"), F.lit(True).alias("member"))
    pivots = places.select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("place"), F.lit(False).alias("member"))
    sent = members.unionByName(pivots)
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    wanted = _needed(ids, texts).join(sent, "id").select("a", "place", "member", "id", "text")
    ready = wanted.repartition(common.partitions(texts.sparkSession), "a", "place").sortWithinPartitions("a", "place", "member", "id")
    kind = pairs.schema["a"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        at, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b = [], []
            rows = zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
            for pivot, place, member, id_, text in rows:
                found = shingler.set_of(text)
                if not member:
                    at, own = (pivot, place), found
                    continue
                if at != (pivot, place):
                    raise ValueError("a pivot's text is missing")
                common_size = len(np.intersect1d(own, found, assume_unique=True))
                if common_size * 100 >= percent * (len(own) + len(found) - common_size):
                    a.append(pivot)
                    b.append(id_)
            yield pa.RecordBatch.from_arrays([pa.array(a, batch.schema.field(0).type), pa.array(b, batch.schema.field(0).type)], ["a", "b"])

    return common.in_arrow(ready, work, f"a {kind}, b {kind}")


def near_duplicates(documents: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text", agree: int | None = None) -> DataFrame:
    """(key, n_shingles, component_id) of every row of ``documents``; see the module's docstring."""
    marked = common.stage(signatures(documents, words, key, text), "signatures")
    groups = marked.where("n > 0").groupBy("same").agg(F.min("id").alias("rep"))
    groups = common.stage(groups, "classes")
    reps = groups.where("rep IS NOT NULL").select("same", F.col("rep").alias("id"))
    classes = common.stage(marked.join(reps, ["same", "id"], "left_semi").dropDuplicates(["same", "id"]).select("id", "n", "sig", "keys"), "representatives")
    # one text per id: that of its class, of which any will do
    texts = documents.select(F.col(key).alias("id"), F.encode(common.text_or_empty(text), "UTF-8").alias("text")).where("id IS NOT NULL")

    bands = classes.select("id", "n", F.explode("keys").alias("k"))
    shared = bands.groupBy("k").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    alive = common.stage(bands.join(shared, "k").select("k", "id", "n", "low", "high"), "buckets")

    sizes = classes.select("id", "n")
    star = alive.select(F.col("low").alias("a"), F.col("id").alias("b"), F.col("n").alias("nb")).unionByName(alive.select(F.col("high").alias("a"), F.col("id").alias("b"), F.col("n").alias("nb"))).where("a <> b").distinct()
    star = star.join(sizes.toDF("a", "na"), "a").where(_sizes_fit("na", "nb", percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = common.stage(_confirmed(_alike(star, classes, agreement(percent) if agree is None else agree), texts, words, percent), "stars")
    found = common.stage(components(links), "components")

    # what is left: classes of one bucket in different components; of three at most, all have met already
    placed = alive.select("k", "id", "n").join(found.toDF("id", "c"), "id", "left").withColumn("c", F.coalesce("c", "id"))
    split = placed.groupBy("k").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count(F.lit(1)).alias("m")).where("c0 < c1 AND m > 3").select("k")
    open_ = common.stage(placed.join(split, "k", "left_semi"), "open")
    main = open_.groupBy("k", "c").agg(F.count(F.lit(1)).alias("m")).groupBy("k").agg(F.max_by("c", F.struct("m", "c")).alias("main"))
    parted = open_.join(main, "k").select("k", "id", "n", "c", (F.col("c") != F.col("main")).alias("minor"))
    sets = common.stage(_sets(open_.select("id").distinct(), texts, words), "sets")
    more = common.stage(_linked_cells(parted, sets, percent), "links")
    over = components(more.join(found.toDF("a", "ca"), "a", "left").join(found.toDF("b", "cb"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    found = found.join(over.toDF("component", "wider"), "component", "left").select("node", F.coalesce("wider", "component").alias("component"))
    single = over.join(found.select("node"), "node", "left_anti")
    whole = found.unionByName(single)

    named = groups.join(whole.toDF("rep", "component"), "rep", "left").select("same", F.coalesce("component", "rep").alias("component_id"))
    out = marked.where("n > 0").select("id", "n", "same").join(named, "same").select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id")
    alone = marked.where("n = 0").select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return out.unionByName(alone)


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(common.table(spark, sf_dir, "documents"), words=2)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
