"""Toxic text by a classifier chain of linear models.

The categories are predicted one after another: the model of a category sees the words of a text and the probabilities of the
categories before it. While training, those probabilities are out-of-fold predictions, so a later model learns how
reliable they are on texts that the earlier one has not seen.

Features are the distinct words of a text and the beginnings of words (how many distinct words share one), which also covers compounds
that no labelled text holds, and the number of words. Only features that stand out in a category are used: those whose
share among its texts lies STAND_OUT standard deviations above the rest; each fold chooses its own from its training part.

The chain is fitted on the driver from a bounded sample of labelled rows (`SAMPLE` rows of either toxicity, chosen by a hash of
doc_id) and broadcast: at most `VOCABULARY` features and a weight per feature and category. The sample holds more toxic texts than
the labels do; the intercepts are put back to the share among all labels. Scoring reads whole texts, one row at a time, without a
shuffle.

Defined results: a null or empty text has no words and gets the chain's base rates; labels that are null count as 0, a label
whose doc_id is null or unknown is not used; without labels, or without any toxic one, nothing is toxic.
Repeated rows get equal results.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.texts import in_small_batches, lean, stored

SAMPLE = 4096
VOCABULARY = 1 << 14
LEAST_TEXTS = 3
STAND_OUT = 4.0
FOLDS = 3
PENALTY = 1e-4
STEPS = 60
THRESHOLD = 0.35
CATEGORIES = ("poor", "toxic", "severe")
LETTERS = re.compile(r"[^\W\d_]+")
BEGINNINGS = (3, 4, 5, 6, 7)
CACHE_WORDS = 100_000


def words_of(text: str | None) -> set[str]:
    return set(LETTERS.findall(text.lower())) if text else set()


def features_of(word: str) -> list[str]:
    """The word and its beginnings, marked with a star."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


class Columns(dict):
    """The columns of a word's features; the first CACHE_WORDS words are kept, which are the frequent ones."""

    def __init__(self, vocabulary: dict[str, int]) -> None:
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> tuple[int, ...]:
        known = self.vocabulary
        found = tuple(known[f] for f in features_of(word) if f in known)
        if len(self) < CACHE_WORDS:
            self[word] = found
        return found


@dataclass
class Linear:
    """Weights per feature, and for the number of words and the earlier categories' probabilities."""

    features: np.ndarray
    chain: np.ndarray
    bias: float

    def margin(self, rows: np.ndarray, columns: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        return np.bincount(rows, self.features[columns], minlength=len(earlier)) + (earlier * self.chain).sum(axis=1) + self.bias


@dataclass
class Chain:
    vocabulary: dict[str, int]
    models: list[Linear]

    def probabilities(self, texts: list[str | None], known: Columns) -> np.ndarray:
        """One row per text, one column per category."""
        out = np.zeros((len(texts), len(self.models)))
        for i, text in enumerate(texts):
            words = words_of(text)
            columns = np.fromiter(itertools.chain.from_iterable(map(known.__getitem__, words)), dtype=np.int64)
            rows = np.zeros(len(columns), dtype=np.int64)
            earlier = np.array([[np.log1p(len(words))]])
            for k, model in enumerate(self.models):
                out[i, k] = sigmoid(model.margin(rows, columns, earlier))[0]
                earlier = np.column_stack([earlier, out[i, k]])
        return out


def sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def inner(one: np.ndarray, other: np.ndarray) -> float:
    """Without BLAS, whose threads would wait on each other for vectors of this size."""
    return float((one * other).sum())


def fit_linear(rows: np.ndarray, columns: np.ndarray, width: int, earlier: np.ndarray, wanted: np.ndarray) -> Linear:
    """Logistic regression with an L2 penalty, by L-BFGS."""
    count, extra = len(wanted), earlier.shape[1]
    rate = np.clip(wanted.mean() if count else 0.0, 1e-6, 1 - 1e-6)
    point = np.zeros(width + extra + 1)
    point[-1] = np.log(rate / (1 - rate))
    if not 0 < wanted.sum() < count:
        return Linear(point[:width], point[width:-1], point[-1])

    def loss(at: np.ndarray) -> tuple[float, np.ndarray]:
        model = Linear(at[:width], at[width:-1], at[-1])
        margin = model.margin(rows, columns, earlier)
        off = (sigmoid(margin) - wanted) / count
        slope = np.concatenate([np.bincount(columns, off[rows], minlength=width), (earlier * off[:, None]).sum(axis=0), [off.sum()]])
        slope[:-1] += PENALTY * at[:-1]
        value = np.mean(np.logaddexp(0, margin) - wanted * margin) + PENALTY / 2 * inner(at[:-1], at[:-1])
        return value, slope

    value, slope = loss(point)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        way, weights = -slope, []
        for move, change in reversed(moves):
            weights.append(inner(move, way) / inner(move, change))
            way = way - weights[-1] * change
        if moves:
            way = way * inner(*moves[-1]) / inner(moves[-1][1], moves[-1][1])
        for (move, change), weight in zip(moves, reversed(weights), strict=True):
            way = way + (weight - inner(change, way) / inner(move, change)) * move
        size, descent = 1.0, inner(slope, way)
        while True:
            following = point + size * way
            new_value, new_slope = loss(following)
            if new_value <= value + 1e-4 * size * descent or size < 1e-6:
                break
            size /= 2
        move, change = following - point, new_slope - slope
        point, value, slope = following, new_value, new_slope
        if inner(move, change) > 1e-12:
            moves = [*moves[-7:], (move, change)]
        if np.abs(slope).max() < 1e-6:
            break
    return Linear(point[:width], point[width:-1], float(point[-1]))


def fit_chain(rows: np.ndarray, columns: np.ndarray, sizes: np.ndarray, wanted: np.ndarray, folds: np.ndarray, use: np.ndarray) -> list[Linear]:
    """The models of all categories.

    rows and columns are the features of the texts, sizes their numbers of words, `wanted` has a 0/1 column per category; use[k, f] tells
    which features category k may use in training without fold f, use[k, FOLDS] which in training on all.
    """
    width, earlier, models = use.shape[2], np.log1p(sizes)[:, None], []
    for k in range(wanted.shape[1]):

        def fit(part: np.ndarray, fold: int, k: int = k) -> Linear:
            place, own = np.cumsum(part) - 1, part[rows] & use[k, fold][columns]
            return fit_linear(place[rows[own]], columns[own], width, earlier[part], wanted[part, k])

        unseen = np.zeros(len(sizes))
        for fold in range(FOLDS):
            test = folds == fold
            unseen[test] = sigmoid(fit(~test, fold).margin(rows, columns, earlier))[test]
        models.append(fit(np.ones(len(sizes), dtype=bool), FOLDS))
        earlier = np.column_stack([earlier, unseen])
    return models


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """doc_id, features, words, the categories and fold of at most `size` toxic and `size` other labelled texts."""
    marks = labels.select(
        "doc_id", F.coalesce("toxic", F.lit(0)).alias("toxic"), F.coalesce("quality", F.lit(1)).alias("quality")
    ).filter(F.col("doc_id").isNotNull())
    order = F.xxhash64("doc_id"), F.col("doc_id")
    some = [marks.filter(which).orderBy(*order).limit(size) for which in (F.col("toxic") == 1, F.col("toxic") != 1)]
    chosen = some[0].unionByName(some[1])

    @F.pandas_udf("array<array<string>>")
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: [features_of(word) for word in sorted(words_of(text))])

    texts = in_small_batches(docs).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most 2 * size short rows
    poor, toxic = F.col("quality") == 0, F.col("toxic") == 1
    rows = texts.select("doc_id", features("text").alias("f"), poor.alias("poor"), toxic.alias("toxic"), (poor & toxic).alias("severe"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    return rows.select("doc_id", F.flatten("f").alias("features"), F.size("f").alias("words"), *CATEGORIES, fold.alias("fold"))


def outstanding(sample: DataFrame) -> DataFrame:
    """feature and `use`, a flag per category and fold left out (the last: none), of at most VOCABULARY features."""
    parts = [F.col("fold") != f for f in range(FOLDS)] + [F.lit(True)]
    marks = [(part & F.col(c) if c else part).alias(f"n_{c or 'all'}_{f}") for f, part in enumerate(parts) for c in (*CATEGORIES, None)]
    flagged = sample.select(F.array_distinct("features").alias("features"), *marks)
    names = [name for name in flagged.columns if name != "features"]
    totals = flagged.agg(*(F.count_if(name).alias(name) for name in names)).first()
    counts = flagged.select(F.explode("features").alias("feature"), *names).groupBy("feature").agg(*(F.count_if(name).alias(name) for name in names))
    scores = []
    for c in CATEGORIES:
        for f in range(FOLDS + 1):
            share = totals[f"n_{c}_{f}"] / max(1, totals[f"n_all_{f}"])
            every = F.col(f"n_all_{f}")
            score = (F.col(f"n_{c}_{f}") - every * share) / F.sqrt(every * (share * (1 - share)) + 1e-9)
            scores.append(F.when(every >= LEAST_TEXTS, score).otherwise(0.0))
    rated = counts.select("feature", F.array(*scores).alias("_s")).filter(F.array_max("_s") >= STAND_OUT)
    best = rated.orderBy(F.desc(F.array_max("_s")), "feature").limit(VOCABULARY)
    return best.select("feature", F.transform("_s", lambda score: score >= STAND_OUT).alias("use"))


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Chain:
    sample = stored(labelled_sample(docs, labels, size), "labelled")
    best = outstanding(sample).toArrow().sort_by("feature")
    vocabulary = {feature: i for i, feature in enumerate(best["feature"].to_pylist())}
    use = np.array(best["use"].to_pylist(), dtype=bool).reshape(len(vocabulary), len(CATEGORIES), FOLDS + 1).transpose(1, 2, 0)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("array<int>")
    def columns_of(features: pd.Series) -> pd.Series:
        known = shared.value
        return features.map(lambda own: [known[f] for f in own if f in known])

    texts = sample.select("doc_id", columns_of("features").alias("columns"), "words", *CATEGORIES, "fold").toArrow().sort_by("doc_id")
    each = texts["columns"].to_pylist()
    columns = np.array([c for own in each for c in own], dtype=np.int64)
    rows = np.repeat(np.arange(len(each)), [len(own) for own in each])
    wanted = np.column_stack([texts[c].to_numpy() for c in CATEGORIES]).astype(float)
    models = fit_chain(rows, columns, texts["words"].to_numpy(), wanted, texts["fold"].to_numpy(), use)
    toxic = int(wanted[:, CATEGORIES.index("toxic")].sum())
    n, positive = labels.agg(F.count(F.lit(1)), F.count_if(F.col("toxic") == 1)).first()
    if 0 < toxic < len(each) and 0 < positive < n:
        shift = np.log(positive / (n - positive)) - np.log(toxic / (len(each) - toxic))
        for model in models[CATEGORIES.index("toxic") :]:
            model.bias += shift
    return Chain(vocabulary, models)


def scored(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc (the whole row as a struct, so that no column name can clash) and scores, a struct of the categories' probabilities."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    @F.pandas_udf(", ".join(f"{name} double" for name in CATEGORIES))
    @lean
    def probabilities(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Columns(shared.value.vocabulary)
        for texts in batches:
            yield pd.DataFrame(shared.value.probabilities(texts.tolist(), known), columns=list(CATEGORIES))

    return in_small_batches(docs).select(F.struct("*").alias("doc")).withColumn("scores", probabilities("doc.text"))


def is_toxic(scores: Column, threshold: float = THRESHOLD) -> Column:
    return scores["toxic"] >= threshold


def digest(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: the probability of each category, whether it is toxic, whether a filter keeps it."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    chain = train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    toxic = is_toxic(F.col("scores"))
    return scored(docs, chain).select(
        "doc.doc_id", *(F.col(f"scores.{name}").alias(f"p_{name}") for name in CATEGORIES), toxic.alias("toxic"), (~toxic).alias("kept")
    )


def rejecting(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that are not toxic, columns unchanged; the chain is trained on the folder's labelled documents."""
    chain = train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    return scored(docs, chain).filter(~is_toxic(F.col("scores"))).select("doc.*")
