"""Toxicity by multiple-instance learning.

Only documents are labelled. A sentence with evidence has a probability of being toxic, a document is
toxic if one of its sentences is (noisy-or) or for a reason that no sentence shows (the leak):
1 - (1 - leak) * product over sentences of (1 - p). Maximum likelihood on the documents' labels
gives the weights of words and word beginnings; the sentence scores then locate the offending
sentences.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import hash_unit, quoted, stored, without

#: Bound of the training sample, in labelled documents.
SAMPLE_DOCS = 8000
#: A word or word beginning is evidence if chance alone would show its share of toxic sentences with
#: this probability at most in any of the features tested together (those in MIN_SENTENCES toxic
#: sentences at least).
CHANCE = 0.05
MIN_SENTENCES = 3
OWN_SHARE = 0.9
#: Its odds must also be this many times those of all sentences: in a large sample, chance alone does not
#: explain that a language's common words are a little more frequent in toxic documents.
ODDS = 4.0
#: Lengths of word beginnings.
SHORTEST, LONGEST = 3, 6
#: Sentence score from which a sentence is reported as offending.
OFFENDING = 0.5

_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
_WORD = re.compile(r"[^\W\d_]+")
_SPAN = "array<struct<start: int, end: int, score: double>>"


def word_features(word: str) -> list[str]:
    """The word (marked by a final $) and its beginnings."""
    return [word + "$", *(word[:k] for k in range(SHORTEST, min(LONGEST, len(word)) + 1))]


class Evidence:
    """Finds the features of a vocabulary in the sentences of a text."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary
        # Most words are told off by their first letters.
        self.heads = {f.rstrip("$")[:SHORTEST] for f in vocabulary}

    def of_words(self, words: list[str]) -> list[int]:
        vocabulary, heads = self.vocabulary, self.heads
        found = {
            vocabulary[f]
            for w in set(words)
            if w[:SHORTEST] in heads
            for f in word_features(w)
            if f in vocabulary
        }
        return sorted(found)

    def sentences(self, text: str) -> Iterator[tuple[int, int, list[int]]]:
        """``start, end, feature numbers`` of the sentences with a feature; code points."""
        if not self.of_words(_WORD.findall(text.lower())):
            return
        for match in _SENTENCE.finditer(text):
            found = self.of_words(_WORD.findall(match[0].lower()))
            if found:
                yield match.start(), match.end(), found


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of words and word beginnings, the bias of a sentence with evidence, and the leak."""

    leak: float = 0.0
    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)

    def scorer(self) -> Callable[[str | None], tuple[float, list[tuple[int, int, float]]]]:
        """Maps a text to its score and its sentences with evidence; without evidence, the leak."""
        evidence = Evidence({f: i for i, f in enumerate(self.weights)})
        weights = list(self.weights.values())

        def score(text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
            rest, sentences = 1.0 - self.leak, []
            for start, end, found in evidence.sentences(text or ""):
                logit = self.bias + sum(weights[i] for i in found)
                p = 1.0 / (1.0 + float(np.exp(-logit)))
                rest *= 1.0 - p
                sentences.append((start, end, p))
            return 1.0 - rest, sentences

        return score


def fit_noisy_or(
    bags: list[tuple[int, list[list[int]]]], words: int, steps: int = 400, penalty: float = 0.05
) -> tuple[float, float, np.ndarray]:
    """Leak, bias and word weights from ``(label, sentences as lists of word numbers)``.

    Minimises the negative log-likelihood with an L2 penalty on the weights by Adam. With
    s = log(1 + exp(z)) of a sentence's logit z, a document's log(1 - P) is minus the sum of the s, the
    leak being one more sentence of every document.
    """
    labels = np.array([y for y, _ in bags], float)
    owner = np.array([i for i, (_, ss) in enumerate(bags) for _ in ss], np.int64)
    flat = [(k, w) for k, s in enumerate(s for _, ss in bags for s in ss) for w in s]
    row = np.array([k for k, _ in flat], np.int64)
    column = np.array([w for _, w in flat], np.int64)
    n, sentences = len(bags), len(owner)
    base = np.clip(labels.mean() if n else 0.0, 1e-6, 1 - 1e-6)
    theta = np.concatenate([[np.log(base / (1 - base)), -5.0], np.full(words, 2.0)])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        leak, z = theta[0], np.full(sentences, theta[1])
        z += np.bincount(row, theta[2:][column], sentences)
        soft = np.logaddexp(0.0, leak) + np.bincount(owner, np.logaddexp(0.0, z), n)
        toxic = -np.expm1(-soft)
        # Derivative by each sum: 1 for label 0, -(1 - P) / P for label 1.
        slope = np.where(labels > 0, -(1 - toxic) / np.maximum(toxic, 1e-9), 1.0)
        by_sentence = slope[owner] / (1 + np.exp(-z))
        gradient = np.concatenate(
            [
                [slope.sum() / (1 + np.exp(-leak)), by_sentence.sum() + (theta[1] + 5.0)],
                np.bincount(column, by_sentence[row], words) + penalty * theta[2:],
            ]
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        scale = 0.05 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        theta = theta - scale * first / (np.sqrt(second) + 1e-9)
    return float(1 / (1 + np.exp(-theta[0]))), float(theta[1]), theta[2:]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample_docs: int = SAMPLE_DOCS,
) -> ToxicityModel:
    """A model from the documents of ``docs`` that have a label in ``labels``.

    About ``sample_docs`` labelled documents at most train it, chosen by the hash of the key. Rows without
    key or label do not count; a key with several labels is toxic if one of them is. Equal texts with equal
    labels count once, and words once per different sentence, so copies of a document weigh as one.
    Without labelled documents, every score is 0.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    per_key = known.groupBy(F.col(key).alias("__key")).agg(F.max(F.col(label).cast("int")).alias("y"))
    total = known.select(F.count("*")).first()[0]
    if total > sample_docs:
        per_key = per_key.where(hash_unit(F.col("__key").cast("string")) < sample_docs / total)
    # At most about sample_docs keys and labels: the only broadcast, bounded by that parameter.
    chosen = stored(
        docs.select(F.col(key).alias("__id"), F.col(text).alias("text"))
        .join(F.broadcast(per_key), F.col("__id") == F.col("__key"))
        .select("text", "y")
        .distinct()
    )
    vocabulary = _vocabulary(chosen)
    bags = sorted(
        (r["y"], sorted(set(map(tuple, r["bags"]))))
        for r in chosen.select("y", _bags(F.col("text"), vocabulary).alias("bags")).collect()
    )
    if not bags:
        return ToxicityModel()
    leak, bias, weights = fit_noisy_or(bags, len(vocabulary))
    return ToxicityModel(leak, bias, dict(zip(vocabulary, weights.tolist(), strict=True)))


def _vocabulary(chosen: DataFrame) -> list[str]:
    """The features that are evidence, sorted."""
    sentences = chosen.select("y", F.explode(_sentence_words(F.col("text"))).alias("words"))
    different = stored(sentences.groupBy("words").agg(F.max("y").alias("y")))
    size, positive = different.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < positive < size:
        return []
    p = positive / size
    words = (
        different.select(F.explode("words").alias("word"), "y")
        .groupBy("word")
        .agg(F.count("*").alias("n"), F.sum("y").alias("k"))
    )
    lengths = f"sequence({SHORTEST}, least({LONGEST}, length(word)))"
    beginnings = F.expr(
        f"if(length(word) < {SHORTEST}, array(), transform({lengths}, k -> substring(word, 1, k)))"
    )
    features = F.array_append(beginnings.cast("array<string>"), F.concat("word", F.lit("$")))
    counts = (
        words.select(F.explode(features).alias("feature"), "n", "k")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    )
    tested = stored(counts.where(F.col("k") >= MIN_SENTENCES))
    limit = 2 * math.log(max(tested.count(), 1) / CHANCE)
    n, k = F.col("n"), F.col("k")
    clean = F.when(n > k, (n - k) * F.log((n - k) / (n * (1 - p)))).otherwise(0.0)
    kept = tested.where((k * (1 - p) >= (n - k) * (ODDS * p)) & (2 * (k * F.log(k / (n * p)) + clean) >= limit))
    return without_doubles({r["feature"]: (r["n"], r["k"]) for r in kept.collect()})


def without_doubles(counted: dict[str, tuple[int, int]]) -> list[str]:
    """The features that say something of their own, sorted; ``counted`` has (all, toxic) of each.

    A longer feature adds nothing to a beginning that is as pure. A beginning adds nothing to a purer
    feature that it begins if that one accounts for nearly all its toxic sentences.
    """
    share = {f: k / n for f, (n, k) in counted.items()}
    dropped = set()
    for feature, (_, k) in counted.items():
        for shorter in word_features(feature.rstrip("$"))[1:]:
            if shorter == feature or shorter not in counted:
                continue
            if share[feature] <= share[shorter]:
                dropped.add(feature)
            elif k >= OWN_SHARE * counted[shorter][1]:
                dropped.add(shorter)
    return sorted(counted.keys() - dropped)


def _sentence_words(text: Column) -> Column:
    """The different words of each sentence, sorted."""

    def convert(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            yield pa.array(
                [
                    [sorted(set(_WORD.findall(s.lower()))) for s in _SENTENCE.findall(x.as_py() or "")]
                    for x in array
                ],
                pa.list_(pa.list_(pa.string())),
            )

    convert.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(convert, "array<array<string>>")(text)


def _bags(text: Column, vocabulary: list[str]) -> Column:
    """The feature numbers of each sentence that has some."""
    number = {f: i for i, f in enumerate(vocabulary)}

    def convert(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        evidence = Evidence(number)
        for array in arrays:
            yield pa.array(
                [[found for _, _, found in evidence.sentences(x.as_py() or "")] for x in array],
                pa.list_(pa.list_(pa.int32())),
            )

    convert.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(convert, "array<array<int>>")(text)


def score_documents(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``offending``: spans of the sentences that score OFFENDING.

    One row per input row. NULL and empty texts, and texts without evidence, score the leak. Output
    names replace input columns. An empty table gives an empty result.
    """

    def convert(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spans = pa.list_(
            pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
        )
        score = model.scorer()
        for array in arrays:
            found = [score(x.as_py()) for x in array]
            offending = [
                [{"start": a, "end": b, "score": p} for a, b, p in ss if p >= OFFENDING]
                for _, ss in found
            ]
            yield pa.StructArray.from_arrays(
                [pa.array([s for s, _ in found], pa.float64()), pa.array(offending, spans)],
                names=["score", "offending"],
            )

    convert.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    udf = F.arrow_udf(convert, f"score double, offending {_SPAN}").asNondeterministic()
    base = without(docs, ["score", "offending"])
    columns = [F.col(quoted(c)) for c in base.columns]
    return base.withColumn("__found", udf(F.col(text))).select(
        *columns, "__found.score", "__found.offending"
    )
