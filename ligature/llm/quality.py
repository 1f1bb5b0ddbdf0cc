"""Quality classifier by positive-unlabelled learning.

A linear model minimises the non-negative unbiased risk ``pi * R+(P) + max(0, R-(U) - pi * R-(P))`` with the sigmoid
loss. Its gradient steps draw from at most ``SAMPLE`` trusted positives (label 1) and ``UNLABELLED`` documents without
labels, by the order of a hash of the document's id. Everything else works on all rows: the centre and scale of the
features, and the class prior ``pi``, estimated as the smallest ratio of the unlabelled to the positive share above a
threshold of a plain positive-against-unlabelled model, whose tails are counted over every unlabelled document. A last
step maps the model's margin to a probability on labelled training rows.

Features see the text only: shares of kinds of characters, repetition of words and lines, word shapes and hashed pairs
of bytes. Texts are read in slices, so a text of any length needs bounded memory besides itself.

Defined results: null texts count as empty; ids with several different labels, or a null one, teach nothing; without
labelled positives every score is the estimated prior (0.5 if nothing is known); repeated rows get equal scores; an id
on several rows teaches once, by the smallest of its rows' features; documents without an id are scored but teach
nothing; columns of the documents named score or predicted are replaced; an empty table has no scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Most labelled documents of each label, and most unlabelled ones, that gradient steps and the last step draw from.
SAMPLE = 6000
UNLABELLED = 6000
THRESHOLD = 0.7
#: Hash buckets for pairs of bytes.
PAIRS = 64
SLICE = 1 << 20

_DENSE = 22
SIZE = _DENSE + PAIRS
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = ~(_LETTER | _SPACE | _DIGIT)
_PROSE = np.zeros(256, bool)
_PROSE[[ord(c) for c in ".,;:'\"-()?"]] = True


def describe(data: bytes) -> np.ndarray:
    """The features of one text in UTF-8."""
    out = np.zeros(SIZE, np.float32)
    if not data:
        out[0] = 1
        return out
    counts, pairs = np.zeros(256), np.zeros(PAIRS)
    for at in range(0, len(data), SLICE):
        part = np.frombuffer(data, np.uint8, count=min(SLICE + 1, len(data) - at), offset=at)
        counts += np.bincount(part[:SLICE], minlength=256)
        code = part[:-1].astype(np.uint32) * np.uint32(40503) + part[1:] * np.uint32(30011)
        pairs += np.bincount((code >> np.uint32(7)) & np.uint32(PAIRS - 1), minlength=PAIRS)
    n = len(data)
    letters = counts[_LETTER].sum()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    nw = max(1, len(words))
    same = sum(map(eq, words, words[1:]))
    distinct = len(set(words))
    ends = np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)
    starts = np.frombuffer(b"".join([w[:1] for w in words]), np.uint8)
    shout = sum(map(bytes.isupper, words))
    dense = (
        0,
        np.log1p(n),
        counts[_UPPER].sum() / max(1, letters),
        counts[_DIGIT].sum() / n,
        counts[_SYMBOL].sum() / n,
        counts[_SYMBOL & ~_PROSE].sum() / n,
        counts[_PROSE].sum() / n,
        counts[_SPACE].sum() / n,
        counts[10] / n,
        letters / n,
        np.log1p(n / nw),
        same / nw,
        distinct / nw,
        np.log1p(distinct) / np.log1p(nw),
        _SYMBOL[ends].mean() if len(ends) else 0,
        (_SYMBOL & ~_PROSE)[ends].mean() if len(ends) else 0,
        _UPPER[starts].mean() if len(starts) else 0,
        shout / nw,
        len(set(lines)) / max(1, len(lines)),
        np.log1p(nw / max(1, len(lines))),
        sum(1 for w in words if len(w) == 1) / nw,
        -float(sum(p * np.log(p) for p in counts[counts > 0] / n)),
    )
    out[:_DENSE] = dense
    out[_DENSE:] = np.sqrt(pairs / max(1.0, pairs.sum()))
    return out


@dataclass
class Model:
    """Scores features; ``prior`` is the estimated share of positives."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -8, 8) @ self.weights + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.margin(x) + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _adam(gradient, size: int, steps: int, rate: float = 0.02) -> np.ndarray:
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w, t)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, tails: Callable[[np.ndarray], tuple[int, np.ndarray]], least: float = 0.2) -> float:
    """The smallest ratio of the unlabelled to the positive share above a threshold, over the thresholds that keep at
    least ``least`` of the positives. ``tails`` gives the number of unlabelled and how many reach each threshold."""
    p = np.sort(positive)
    at = np.quantile(p, np.linspace(0.0, 1 - least, 200))
    n, above = tails(at)
    share_p = np.maximum(1 - np.searchsorted(p, at, "left") / len(p), 1e-9)
    share_u = above / max(1, n)
    noise = np.sqrt(share_u * (1 - share_u) / max(1, n)) + np.sqrt(share_p * (1 - share_p) / len(p))
    return float(np.clip(min(1.0, float(((share_u + noise) / share_p).min())), 0.02, 0.98))


def ready(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features and a constant."""
    return np.hstack([np.clip((x.astype(np.float64) - centre) / scale, -8, 8), np.ones((len(x), 1))])


@dataclass
class Corpus:
    """What the fit takes from all unlabelled documents: their features' centre and scale, and ``tails``: for the plain
    models of the two halves and thresholds, how many there are and how many reach each threshold."""

    centre: np.ndarray
    scale: np.ndarray
    tails: Callable[[list[np.ndarray], np.ndarray], tuple[int, np.ndarray]]

    @classmethod
    def of(cls, x: np.ndarray, half: np.ndarray) -> Corpus:
        centre, scale = x.mean(0, dtype=np.float64), x.std(0, dtype=np.float64) + 1e-4

        def tails(ws: list[np.ndarray], at: np.ndarray) -> tuple[int, np.ndarray]:
            return len(x), reached(cross_margins(ready(x, centre, scale), half, ws), at)

        return cls(centre, scale, tails)


def cross_margins(x: np.ndarray, half: np.ndarray, ws: list[np.ndarray]) -> np.ndarray:
    """Margins of rows by the model of the other half, or what a model has seen would look easier than it is."""
    return np.where(half == 0, x @ ws[1], x @ ws[0])


def reached(margins: np.ndarray, at: np.ndarray) -> np.ndarray:
    return len(margins) - np.searchsorted(np.sort(margins), at, "left")


def fit(positive: np.ndarray, unlabelled: np.ndarray, known: np.ndarray, labels: np.ndarray, steps: int = 400, decay: float = 1e-3, seed: int = 7, halves: tuple[np.ndarray, np.ndarray] | None = None, corpus: Corpus | None = None) -> Model:
    """The model of smallest non-negative risk from features of trusted positives and of unlabelled texts.

    ``known`` and their ``labels`` set only the scale of the scores. ``halves`` (0 or 1 for each positive and unlabelled
    row) split the plain models that estimate the prior; ``corpus`` stands for all unlabelled documents, if the given
    ones are a sample.
    """
    if halves is None:
        halves = (np.arange(len(positive)) % 2, np.arange(len(unlabelled)) % 2)
    corpus = corpus or Corpus.of(unlabelled, halves[1])
    centre, scale = corpus.centre, corpus.scale
    p, u = ready(positive, centre, scale), ready(unlabelled, centre, scale)
    size = p.shape[1]
    rng = np.random.default_rng(seed)

    held = np.r_[np.full(_DENSE, decay), np.full(size - 1 - _DENSE, 30 * decay), 0.0]

    def plain(w: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ga, gb = _sigmoid(a @ w) - 1, _sigmoid(b @ w)
        return (ga @ a) / len(a) + (gb @ b) / len(b) + held * w

    parts = [(p[halves[0] == i], u[halves[1] == i]) for i in (0, 1)]
    parts = [x if len(x[0]) and len(x[1]) else (p, u) for x in parts]
    ws = [_adam(lambda w, _, a=a, b=b: plain(w, a, b), size, 150) for a, b in parts]
    prior = estimate_prior(cross_margins(p, halves[0], ws), lambda at: corpus.tails(ws, at))

    def batch(x: np.ndarray) -> np.ndarray:
        return x[rng.integers(0, len(x), min(len(x), 1024))]

    def risk(w: np.ndarray, _: int) -> np.ndarray:
        a, b = batch(p), batch(u)
        sa, sb = _sigmoid(a @ w), _sigmoid(b @ w)  # sigmoid loss: of a positive 1 - s, of a negative s
        da, db = (sa * (1 - sa)) @ a / len(a), (sb * (1 - sb)) @ b / len(b)
        negative = sb.mean() - prior * sa.mean()
        if negative >= 0:
            return -prior * da + db - prior * da + held * w
        return -(db - prior * da) + held * w  # step back while the part that cannot be negative is below 0

    w = _adam(risk, size, steps, 0.01)
    model = Model(centre, scale, w[:-1], float(w[-1]), 1.0, 0.0, prior)
    if len(known) and len(set(labels.tolist())) == 2:
        model.slope, model.shift = _scale(model.margin(known), labels)
    return model


def _scale(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the probability of label 1 by margin, with smoothed targets."""
    n1, n0 = int((labels == 1).sum()), int((labels != 1).sum())
    goal = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(labels == 1, 0.5 / n1, 0.5 / n0)  # the classes count alike, or the larger would set the threshold
    size = margins.std() + 1e-9
    x = np.stack([margins / size, np.ones(len(margins))], 1)
    w = np.zeros(2)
    for _ in range(50):
        s = _sigmoid(x @ w)
        h = (x * (weight * s * (1 - s))[:, None]).T @ x + 1e-6 * np.eye(2)
        w -= np.linalg.solve(h, x.T @ (weight * (s - goal)))
    return (float(max(w[0], 1e-6) / size), float(w[1]))


def held_out(key: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def described(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(__key, x): the features (binary, 32-bit floats) of every row, written to the shared folder."""
    source = documents.select(F.col(key).alias("__key"), F.encode(common.text_or_empty(text), "UTF-8").alias("__text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs = [describe(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(xs, pa.binary())], ["__key", "x"])

    return common.stage(common.in_arrow(source, work, source.select("__key").schema.simpleString()[7:-1] + ", x binary"), "features")


def _array(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, SIZE)


def _total(df: DataFrame, size: int, part: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows (x, half) of what ``part`` makes of each batch: ``size`` numbers. Each task adds up its own,
    and the sums of all are added by Spark."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                out += part(_array(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(out)], ["i", "s"])

    sums = common.in_arrow(df.select("x", "half"), work, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()  # ``size`` rows
    out = np.zeros(size)
    for r in sums:
        out[r["i"]] = r["s"]
    return out


def _drawn(known: DataFrame, most: int, n: int) -> DataFrame:
    """The first ``most`` of ``n`` rows by ``order``. Orders are spread evenly, so a bound on them leaves hardly more rows
    than are wanted; ids alone are sorted, and only the drawn rows' features leave their tasks."""
    if not n or not most:
        return known.limit(0)
    share = 1.5 * most / n + 1e-4
    near = known if share >= 1 else known.where(F.col("order") < F.lit(int(-(2**63) + share * 2**64)))
    if share < 1 and near.count() < most:
        near = known
    picked = near.orderBy("order", "__key").limit(most).select("__key")
    return near.join(F.broadcast(picked), "__key", "left_semi")


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, unlabelled: int = UNLABELLED, text: str = "text", key: str = "doc_id", label: str = "quality", features: DataFrame | None = None) -> Model:
    """Fit on at most ``sample`` trusted positives, as many labelled 0, and ``unlabelled`` documents without any row in
    ``labels``, with statistics of all of the latter. Only label rows that are not held out are read as labels.

    ``features`` may pass what ``described`` has written for the documents.
    """
    features = described(documents, text, key) if features is None else features
    given = labels.select(F.col(key).alias("__key"), F.col(label).alias("__label")).withColumn("__label", F.when(~held_out("__key"), F.col("__label")))
    kinds = given.where("__key IS NOT NULL").groupBy("__key").agg(F.min("__label").alias("low"), F.max("__label").alias("high"), F.count("__label").alias("n"), F.count(F.lit(1)).alias("rows"))
    kinds = kinds.select("__key", F.when((F.col("low") == F.col("high")) & (F.col("n") == F.col("rows")), F.col("low")).otherwise(-1).cast("int").alias("kind"))
    once = features.where("__key IS NOT NULL").groupBy("__key").agg(F.min("x").alias("x"))
    order = F.xxhash64(F.col("__key").cast("string"), F.lit(11))
    known = once.join(kinds, "__key", "left").select("__key", F.coalesce("kind", F.lit(2)).alias("kind"), order.alias("order"), F.pmod(F.xxhash64(F.col("__key").cast("string"), F.lit(12)), F.lit(2)).cast("int").alias("half"), "x")
    known = common.stage(known, "known")
    counts = {r["kind"]: r["n"] for r in known.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = []
    for kind, most in ((0, sample), (1, sample), (2, unlabelled)):
        rows += _drawn(known.where(F.col("kind") == kind), most, counts.get(kind, 0)).collect()
    x = {k: np.array([np.frombuffer(r.x, np.float32) for r in rows if r.kind == k]).reshape(-1, SIZE) for k in (0, 1, 2)}
    half = {k: np.array([r.half for r in rows if r.kind == k], np.int64) for k in (0, 1, 2)}
    if not len(x[1]):
        return Model(np.zeros(SIZE), np.ones(SIZE), np.zeros(SIZE), 0.0, 1.0, 0.0, 0.5)
    if len(x[2]):
        rest = known.where("kind = 2")
    else:  # without unlabelled documents, the labelled ones stand for them
        x[2], half[2] = np.vstack([x[0], x[1]]), np.concatenate([half[0], half[1]])
        rest = known.where("kind IN (0, 1)")
    sums = _total(rest, 1 + 2 * SIZE, lambda v, _: np.r_[len(v), v.sum(0, dtype=np.float64), (v.astype(np.float64) ** 2).sum(0)])
    n = max(1.0, sums[0])
    centre = sums[1 : 1 + SIZE] / n
    scale = np.sqrt(np.maximum(sums[1 + SIZE :] / n - centre**2, 0)) + 1e-4

    def tails(ws: list[np.ndarray], at: np.ndarray) -> tuple[int, np.ndarray]:
        found = _total(rest, 1 + len(at), lambda v, h: np.r_[len(v), reached(cross_margins(ready(v, centre, scale), h, ws), at)])
        return int(found[0]), found[1:]

    return fit(x[1], x[2], np.vstack([x[0], x[1]]), np.array([0] * len(x[0]) + [1] * len(x[1])), halves=(half[1], half[2]), corpus=Corpus(centre, scale, tails))


def score(documents: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``documents``, with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    source = documents.withColumn("__text", F.encode(common.text_or_empty(text), "UTF-8")).drop("score", "predicted")
    schema = source.drop("__text").schema.simpleString()[7:-1] + ", score double, predicted int"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs = np.array([describe(t.as_py()) for t in batch.column(batch.num_columns - 1)]).reshape(-1, SIZE)
            yield _scored(batch.columns[:-1], batch.schema.names[:-1], model, xs, threshold)

    return common.in_arrow(source, work, schema)


def _scored(columns: list, names: list[str], model: Model, xs: np.ndarray, threshold: float) -> pa.RecordBatch:
    s = model.score(xs.astype(np.float64))
    return pa.RecordBatch.from_arrays([*columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], [*names, "score", "predicted"])


def score_described(features: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(__key, score, predicted) of every row that ``described`` has written."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _scored([batch.column(0)], ["__key"], model, _array(batch.column(1)), threshold)

    return common.in_arrow(features.select("__key", "x"), work, features.select("__key").schema.simpleString()[7:-1] + ", score double, predicted int")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(spark, sf_dir, "documents")
    features = described(documents)
    model = learn(documents, common.table(spark, sf_dir, "labels"), features=features)
    return score_described(features, model).select(F.col("__key").alias("doc_id"), held_out("__key").alias("held_out"), "score", "predicted")
