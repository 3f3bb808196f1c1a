"""Quality of documents from pairwise preferences.

A labelled pair says that a good document is preferred to a bad one. By the Bradley-Terry model the
chance of that is the logistic function of the difference of the two scores, and a score is linear in
features of the text, so the model is a logistic regression on feature differences without an intercept.
Where good ends is a quantile of the scores: the one below which the share of bad labels lies.

Every labelled document takes part. They are dealt evenly over blocks of both labels, the pairs are made inside a
block, and each Newton step adds up the slopes and curves of all blocks as one Spark job.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.llm.common import kept_in_shared_folder, map_texts
from snapmart.operators.skew import dense_ids

# Fixed values of the contract.
FOLDS, HELD_OUT = 4, 2
ACCEPT = 0.7

# Every document of the commoner label meets so many of the other; a block holds so many documents of the commoner.
PARTNERS = 16
BLOCK = 256
PENALTY = 1e-3
ROUNDS = 30
# Standardised features are cut off here, so that one odd figure cannot outvote the others.
FAR = 4.0

FEATURES = ("words", "word_length", "symbols", "upper", "shouted", "distinct", "commonest", "digits", "exclamations",
            "marked_words", "repeated_lines", "bars", "repeated_pairs", "line_words")

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = b"#$%&*+/<=>@\\^_`{|}~"
_DIGITS = b"0123456789"
_WORD_ENDS = frozenset(_SYMBOLS + b"!")


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    means: tuple[float, ...]
    spreads: tuple[float, ...]
    # the raw score at which good begins
    limit: float


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def features(text: str | None) -> list[float]:
    """Figures of the whole text in the order of ``FEATURES``; null counts as empty."""
    body = (text or "").encode()
    words, size = body.split(), max(len(body), 1)

    def count(characters: bytes) -> int:
        return len(body) - len(body.translate(None, characters))

    n = len(words)
    many = max(n, 1)
    counts = Counter(words)
    lines = [x for x in body.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    return [
        float(np.log1p(n)), sum(map(len, words)) / many, min(count(_SYMBOLS) / many, 3.0), count(_UPPER) / size,
        sum(map(bytes.isupper, words)) / many, len(counts) / many, max(counts.values(), default=0) / many,
        count(_DIGITS) / size, min(count(b"!") / many, 3.0), sum(w[-1] in _WORD_ENDS for w in words) / many,
        (len(lines) - len(set(lines))) / max(len(lines), 1), min(count(b"|") / many, 3.0),
        1.0 - pairs / (n - 1) if n > 1 else 0.0, float(np.log1p(n / max(len(lines), 1))),
    ]


def standard(rows: np.ndarray, model: Model) -> np.ndarray:
    return np.clip((rows - np.array(model.means)) / np.array(model.spreads), -FAR, FAR)


def bradley_terry(better: np.ndarray, worse: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS) -> np.ndarray:
    """Weights under which rows of ``better`` beat those of ``worse``, by Newton steps on the logistic loss."""
    apart = better - worse
    return newton(lambda w: pair_sums(apart, w), apart.shape[1], penalty, rounds)


def pair_sums(apart: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Number, loss, slope and curve of the pairs with these differences, added up, in one row of figures."""
    raw = apart @ weights
    wrong = 1.0 / (1.0 + np.exp(np.clip(raw, -500, 500)))
    curve = (apart * (wrong * (1 - wrong))[:, None]).T @ apart
    return np.concatenate([[len(apart), np.logaddexp(0.0, -raw).sum()], -(apart * wrong[:, None]).sum(axis=0), curve.ravel()])


def newton(sums: Callable[[np.ndarray], np.ndarray], size: int, penalty: float, rounds: int) -> np.ndarray:
    """The weights of the least mean loss with a penalty; ``sums`` gives ``pair_sums`` of all pairs."""
    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        found = sums(w)
        loss, slope, curve = found[1] / found[0], found[2:2 + size] / found[0], found[2 + size:].reshape(size, size) / found[0]
        return loss + penalty / 2 * w @ w, slope + penalty * w, curve + penalty * np.eye(size)

    weights = np.zeros(size)
    loss, slope, curve = at(weights)
    for _ in range(rounds):
        step, part = np.linalg.solve(curve, slope), 1.0
        if np.abs(step).max() < 1e-7:
            break
        tried = at(weights - step)
        while part > 1e-4 and tried[0] > loss:
            part /= 2
            tried = at(weights - part * step)
        weights, (loss, slope, curve) = weights - part * step, tried
    return weights


def quantile_limit(scores: np.ndarray, counts: np.ndarray, share: float) -> float:
    """The score that has ``share`` of all counts below it: half-way between the two neighbours there."""
    order = np.argsort(scores, kind="stable")
    below = np.cumsum(counts[order])
    at = int(np.searchsorted(below, share * below[-1] * (1 - 1e-12)))
    first, second = scores[order[min(at, len(order) - 1)]], scores[order[min(at + 1, len(order) - 1)]]
    return float((first + second) / 2)


def paired(good: np.ndarray, bad: np.ndarray, partners: int = PARTNERS) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of both sides of the pairs: every row of the larger side meets ``partners`` of the other, each
    time another."""
    n = max(len(good), len(bad))
    at = np.arange(n)
    pairs = [(at % len(good), (at + turn * (n // partners + 1)) % len(bad)) for turn in range(partners)]
    return np.concatenate([g for g, _ in pairs]), np.concatenate([b for _, b in pairs])


def fit(good: np.ndarray, bad: np.ndarray, n_good: int, n_bad: int, partners: int = PARTNERS) -> Model | None:
    """The model of two samples of feature rows that stand for so many documents; None if one is empty."""
    if not len(good) or not len(bad):
        return None
    rows = np.concatenate([good, bad])
    spreads = rows.std(axis=0)
    blank = Model((), tuple(rows.mean(axis=0)), tuple(np.where(spreads > 1e-9, spreads, 1.0)), 0.0)
    z_good, z_bad = standard(good, blank), standard(bad, blank)
    better, worse = paired(good, bad, partners)
    weights = bradley_terry(z_good[better], z_bad[worse])
    scores = np.concatenate([z_good @ weights, z_bad @ weights])
    counts = np.concatenate([np.full(len(good), n_good / len(good)), np.full(len(bad), n_bad / len(bad))])
    limit = quantile_limit(scores, counts, n_bad / (n_good + n_bad))
    return Model(tuple(weights), blank.means, blank.spreads, limit)


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<doc_id>, figures`` of every row, worked out once."""
    return kept_in_shared_folder(
        map_texts(docs, doc_id, text, lambda found: [[features(t) for t in found]], "figures array<double>"))


def learn(docs: DataFrame, labels: DataFrame, per_label: int | None = None, doc_id: str = "doc_id", text: str = "text",
          label_id: str = "doc_id", quality: str = "quality") -> Model | None:
    """``learn_measured`` from the texts themselves."""
    return learn_measured(measured(docs, doc_id, text), labels, per_label, doc_id, label_id, quality)


def learn_measured(figures: DataFrame, labels: DataFrame, per_label: int | None = None, doc_id: str = "doc_id",
                   label_id: str = "doc_id", quality: str = "quality") -> Model | None:
    """A model from all documents that are not held out and have a label 0 or 1.

    An id with both labels stands in both classes, an id with several texts once in each. None if a label is
    missing. With ``per_label`` the fit is on so many documents of each label only, those with the smallest hashes of
    id and label; counts of the labels are still over all.
    """
    marks = labels.where(F.col(label_id).isNotNull() & F.col(quality).isin(0, 1)).select(
        F.col(label_id).alias("__id"), F.col(quality).cast("int").alias("__good")).distinct()
    known = figures.where(F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id))).groupBy(F.col(doc_id).alias("__id")).agg(
        F.min("figures").alias("figures"))
    marked = kept_in_shared_folder(known.join(marks, "__id").withColumn("__drawn", F.xxhash64("__id", "__good")))
    counts = {r["__good"]: r["count"] for r in marked.groupBy("__good").count().collect()}
    if len(counts) < 2:
        return None
    if per_label is not None:
        drawn = [marked.where(F.col("__good") == value).orderBy("__drawn", "__id").limit(per_label).collect() for value in (1, 0)]
        return fit(*[np.array([r.figures for r in rows], float) for rows in drawn], counts[1], counts[0])
    return _fit_all(_blocks(marked, counts), counts)


def _blocks(marked: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``rows`` of a block each: label, number, copy and figures of its documents.

    The commoner label is dealt evenly, ``BLOCK`` to a block; the other evenly too, and if a block got fewer than
    ``PARTNERS`` of it, every one goes to several blocks.
    """
    rare = min(counts, key=lambda value: (counts[value], value))
    blocks = -(-counts[1 - rare] // BLOCK)
    copies = min(blocks, -(-blocks * PARTNERS // counts[rare]))
    dealt = [
        dense_ids(marked.where(F.col("__good") == value), ["__drawn", "__id"], "__n", -1)
        .withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        .withColumn("__block", F.pmod(F.col("__n") * n + F.col("__copy"), F.lit(blocks)))
        for value, n in ((rare, copies), (1 - rare, 1))]
    return kept_in_shared_folder(dealt[0].unionByName(dealt[1]).groupBy("__block").agg(
        F.sort_array(F.collect_list(F.struct("__good", "__n", "__copy", "figures"))).alias("rows")).select("rows"))


def _map_blocks(blocks: DataFrame, work, columns: str) -> DataFrame:
    """``work`` over every block's good rows, bad rows and rows that are no copies; the columns that it returns."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for block in batch.column(0):
                rows = block.values
                figures = rows.field("figures").flatten().to_numpy().reshape(len(rows), len(FEATURES))
                good, copy = (rows.field(c).to_numpy() for c in ("__good", "__copy"))
                yield pa.RecordBatch.from_pydict(work(figures[good == 1], figures[good == 0], figures[copy == 0]))

    return blocks.mapInArrow(run, columns)


def _sums(blocks: DataFrame, work) -> np.ndarray:
    """Sums over the blocks of the figures of ``work``; exact, so that their order changes nothing."""
    def listed(*rows):
        found = work(*rows)
        return {"at": np.arange(len(found), dtype=np.int32), "figure": np.asarray(found, float)}

    found = _map_blocks(blocks, listed, "at int, figure double").groupBy("at").agg(
        F.sum(F.col("figure").cast("decimal(38,12)")).alias("figure")).orderBy("at").collect()
    return np.array([float(r.figure) for r in found])


def _fit_all(blocks: DataFrame, counts: dict[int, int]) -> Model:
    n, size = sum(counts.values()), len(FEATURES)
    means = _sums(blocks, lambda good, bad, rows: rows.sum(axis=0)) / n
    spreads = np.sqrt(_sums(blocks, lambda good, bad, rows: ((rows - means) ** 2).sum(axis=0)) / n)
    blank = Model((), tuple(means), tuple(np.where(spreads > 1e-9, spreads, 1.0)), 0.0)

    def sums(weights: np.ndarray) -> np.ndarray:
        def work(good, bad, rows):
            better, worse = paired(good, bad)
            return pair_sums(standard(good, blank)[better] - standard(bad, blank)[worse], weights)

        return _sums(blocks, work)

    weights = newton(sums, size, PENALTY, ROUNDS)
    # the place in the block deals equal scores over several tasks
    scores = _map_blocks(blocks, lambda good, bad, rows: {
        "raw": standard(rows, blank) @ weights, "at": np.arange(len(rows), dtype=np.int32)}, "raw double, at int")
    around = dense_ids(scores, ["raw", "at"], "__n").where(F.col("__n").isin(counts[0], counts[0] + 1)).collect()
    return Model(tuple(weights), blank.means, blank.spreads, sum(r.raw for r in around) / len(around))


def score_rows(rows: np.ndarray, model: Model) -> np.ndarray:
    """Scores from 0 to 1; the model's limit gets ``ACCEPT``."""
    raw = standard(rows, model) @ np.array(model.weights) - model.limit
    return 1.0 / (1.0 + np.exp(np.clip(-raw, -500, 500)) * (1 - ACCEPT) / ACCEPT)


def predict(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``predict_measured`` from the texts themselves."""
    return predict_measured(measured(docs, doc_id, text), model, doc_id)


def predict_measured(figures: DataFrame, model: Model | None, doc_id: str = "doc_id") -> DataFrame:
    """``<doc_id>, held_out, score, predicted`` for every row, from the figures of its whole text alone.

    A null text counts as empty and gets the score of its features like any other. Without a model every score
    is 0.5. Repeated rows each get a row, an empty table gives no rows.
    """
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            rows = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
            scores = np.full(len(rows), 0.5) if model is None else score_rows(rows, model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[doc_id, "score"])

    rows = figures.select(doc_id, "figures")
    scored = rows.mapInArrow(run, T.StructType([rows.schema[0], T.StructField("score", T.DoubleType())]))
    return scored.select(
        doc_id, held_out(F.col(doc_id)).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
