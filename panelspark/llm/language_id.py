"""Language identification by hierarchical discrimination.

A text is first given to a language family by linear machines (one family against the others); within
the family, linear support vector machines for each pair of languages vote. Features are hashed letter
n-grams of the whole text. All labelled rows train them: rows are dealt by hash into shards of bounded size,
each Spark task trains every machine on its shard, and a machine is the weighted mean of those of the shards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import hash_unit, quoted, without
from panelspark.llm.linear_svm import train_svm

UNKNOWN = "und"
#: Buckets of the hashed n-grams.
DIM = 1 << 15
#: Labelled rows of a shard, about, and the features (n-grams of a row) that a task holds to train on.
SHARD_ROWS, SHARD_CELLS = 4096, 1 << 22
#: Weights are added up in units of 1 / UNIT, so the order of the shards does not matter.
UNIT = 1 << 20
#: The weights of a machine travel in so many parts.
SLICES = 8
#: A pipeline rejects texts whose predicted language has a lower score.
LEAST_SCORE = 0.3
#: Characters hashed at a time, so memory does not grow with the length of a text.
CHUNK = 1 << 20

#: Language families by ISO 639-1 code (fixed values). A language that is not listed is a family of its own.
FAMILIES = {
    "da": "germanic", "de": "germanic", "en": "germanic", "is": "germanic", "nl": "germanic",
    "no": "germanic", "sv": "germanic",
    "ca": "romance", "es": "romance", "fr": "romance", "gl": "romance", "it": "romance",
    "pt": "romance", "ro": "romance",
    "be": "slavic", "bg": "slavic", "cs": "slavic", "hr": "slavic", "mk": "slavic", "pl": "slavic",
    "ru": "slavic", "sk": "slavic", "sl": "slavic", "sr": "slavic", "uk": "slavic",
    "et": "uralic", "fi": "uralic", "hu": "uralic",
    "lt": "baltic", "lv": "baltic",
}

_LETTER = re.compile(r"[^\W\d_]")
# Odd multipliers that spread the n-grams over the buckets.
_MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], dtype=np.uint32)


def ngram_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sparse unit vector of the 1-, 2- and 3-grams of letters; empty without letters.

    Texts are lowered, every run of other characters becomes one blank, counts are damped by their
    square root.
    """
    counts = np.zeros(DIM, np.float64)
    for first in range(0, len(text or ""), CHUNK):
        piece = re.sub(r"[\W\d_]+", " ", text[first : first + CHUNK].lower())
        codes = np.frombuffer(f" {piece.strip()} ".encode("utf-32-le"), dtype=np.uint32)
        if len(codes) < 3:
            continue
        one = codes * _MIX[0]
        two = (one[:-1] ^ (one[:-1] >> 15)) * _MIX[1] + codes[1:] * _MIX[2]
        three = (two[:-1] ^ (two[:-1] >> 13)) * _MIX[3] + codes[2:] * _MIX[0]
        for grams in (one, two, three):
            spread = grams ^ (grams >> np.uint32(16))
            counts += np.bincount((spread * _MIX[1]) >> np.uint32(17), minlength=DIM)
    index = np.flatnonzero(counts)
    values = np.sqrt(counts[index])
    norm = np.sqrt(values @ values)
    return index, values / norm if norm else values


def has_letter(text: str | None) -> bool:
    """Whether ``text`` has a character of category L; fractions and Roman numerals are numbers."""
    return bool(text) and any(found[0].isalpha() for found in _LETTER.finditer(text))


@dataclass(frozen=True)
class LanguageModel:
    """Weights by machine: families against the rest, then pairs within a family."""

    members: dict[str, list[str]]
    families: list[str]
    pairs: list[tuple[str, str]]
    weights: np.ndarray  # one row for each family, then one for each pair

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: the family's share times the language's share of the pair votes."""
        if not has_letter(text) or not self.families:
            return UNKNOWN, 0.0
        index, values = ngram_features(text)
        margins = 1.0 / (1.0 + np.exp(-4.0 * (self.weights[:, index] @ values)))
        if len(self.families) == 1:
            family, score = self.families[0], 1.0
        else:
            shares = margins[: len(self.families)]
            best = int(np.argmax(shares))
            family, score = self.families[best], float(shares[best] / max(shares.sum(), 1e-12))
        languages = self.members[family]
        if len(languages) == 1:
            return languages[0], score
        votes = dict.fromkeys(languages, 0.0)
        for (a, b), p in zip(self.pairs, margins[len(self.families) :], strict=True):
            if a in votes:
                votes[a] += float(p)
                votes[b] += 1.0 - float(p)
        language = max(languages, key=lambda x: votes[x])
        return language, score * votes[language] / (len(languages) - 1)


def sample_position(key: Column, text: Column) -> Column:
    """Where a row lies between 0 and 1 among the shards: by key and text, so missing keys spread."""
    return hash_unit(F.concat_ws("|", key, F.md5(F.coalesce(text, F.lit("")))))


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    families: dict[str, str] | None = None,
) -> LanguageModel:
    """A model from the rows of ``labelled`` with a language and a letter in the text.

    Every such row trains it. Rows are dealt by the hash of key and text (the same on every run, and NULL or
    repeated keys spread), so shards hold the languages as the table does. A shard's machine counts by the
    rows of its smaller side; one that has a single side there learns nothing from it. Without labelled rows
    the model knows no language.
    """
    known = FAMILIES if families is None else families
    rows = labelled.where(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(key).cast("string").alias("key"), text
    )
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return LanguageModel({}, [], [], np.zeros((0, DIM)))
    members: dict[str, list[str]] = {}
    for language in languages:
        members.setdefault(known.get(language, language), []).append(language)
    names = sorted(members)
    pairs = [p for f in names for p in combinations(members[f], 2)]
    if len(languages) == 1:
        return LanguageModel(members, names, [], np.zeros((1, DIM)))

    shards = -(-sum(totals.values()) // SHARD_ROWS)
    place = sample_position(F.col("key"), F.col(text))
    # Sorted, so a task that runs again reads its rows in the same order.
    dealt = (
        rows.select(place.alias("place"), "lang", F.col(text).alias("text"))
        .repartition(shards, "place")
        .sortWithinPartitions("place", "lang")
    )
    family_of = {x: f for f, xs in members.items() for x in xs}
    machines = len(names) + len(pairs)
    part = DIM // SLICES

    def sides(machine: int, spoken: list[str]) -> np.ndarray:
        """For each row, +1 or -1; 0 if the machine is not concerned."""
        if machine < len(names):
            return np.array([1.0 if family_of[x] == names[machine] else -1.0 for x in spoken])
        first, second = pairs[machine - len(names)]
        return np.array([(x == first) * 1.0 - (x == second) * 1.0 for x in spoken])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((machines, DIM), np.int64), np.zeros(machines, np.int64)
        spoken, features, cells = [], [], 0

        def train() -> None:
            for machine in range(machines):
                signs = sides(machine, spoken)
                least = int(min((signs > 0).sum(), (signs < 0).sum()))
                if least:
                    own = np.flatnonzero(signs)
                    weights = train_svm([features[i] for i in own], signs[own], DIM)
                    sums[machine] += np.rint(weights * (least * UNIT)).astype(np.int64)
                    counts[machine] += least

        for batch in batches:
            for language, cell in zip(batch.column("lang"), batch.column("text"), strict=True):
                body = cell.as_py()
                if not has_letter(body):
                    continue
                spoken.append(language.as_py())
                features.append(ngram_features(body))
                cells += len(features[-1][0])
                if cells > SHARD_CELLS:
                    train()
                    spoken, features, cells = [], [], 0
        train()
        for machine in np.flatnonzero(counts).tolist():
            yield pa.RecordBatch.from_pydict(
                {
                    "machine": pa.array([machine] * SLICES, pa.int32()),
                    "slice": pa.array(range(SLICES), pa.int32()),
                    "sums": pa.array([x.tobytes() for x in sums[machine].reshape(SLICES, part)], pa.binary()),
                    "n": pa.array([counts[machine]] * SLICES, pa.int64()),
                }
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        counts: dict[tuple[int, int], int] = {}
        for batch in batches:
            for machine, piece, data, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = machine, piece
                sums[at] = sums.get(at, 0) + np.frombuffer(data, np.int64)
                counts[at] = counts.get(at, 0) + n
        for at, total in sums.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "machine": pa.array([at[0]], pa.int32()),
                    "slice": pa.array([at[1]], pa.int32()),
                    "sums": pa.array([total.tobytes()], pa.binary()),
                    "n": pa.array([counts[at]], pa.int64()),
                }
            )

    kind = "machine int, slice int, sums binary, n long"
    parts = dealt.select("lang", "text").mapInArrow(learn, kind)
    added = parts.repartition(min(machines * SLICES, 32), "machine", "slice").mapInArrow(add, kind)
    weights = np.zeros((machines, DIM))
    for row in added.collect():  # one for each machine and slice
        piece = slice(row["slice"] * part, (row["slice"] + 1) * part)
        weights[row["machine"], piece] = np.frombuffer(row["sums"], np.int64) / (row["n"] * float(UNIT))
    return LanguageModel(members, names, pairs, weights)


def predict(text: Column, model: LanguageModel) -> Column:
    """``lang_pred`` and ``score`` as a struct."""

    def convert(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            found = [model.predict(x.as_py()) for x in array]
            yield pa.StructArray.from_arrays(
                [pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.float64())],
                names=["lang_pred", "score"],
            )

    convert.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(convert, "lang_pred string, score double").asNondeterministic()(text)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1); one row per input row.

    ``und`` with score 0 if the text is NULL or has no letter, or if the model knows no language.
    Very long texts are hashed piece by piece. Output names replace input columns. An empty table
    gives an empty result.
    """
    base = without(docs, ["lang_pred", "score"])
    found = base.withColumn("__found", predict(F.col(text), model))
    columns = [F.col(quoted(c)) for c in base.columns]
    return found.select(*columns, "__found.lang_pred", "__found.score")


def known_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a language; the columns of ``docs``, whatever their names.

    Rejected are texts that are NULL or without a letter, and texts of which the model is not sure: a score
    below ``LEAST_SCORE``. A model that knows no language rejects only the former. Texts of any length are
    read whole, repeated rows stay, an empty table gives an empty result.
    """
    if not model.families:
        return docs.where(F.col(text).rlike(r"\p{L}"))
    # The row travels as one value, so its columns cannot clash with the prediction.
    row = F.struct(*[F.col(quoted(c)) for c in docs.columns])
    found = docs.select(row.alias("row"), predict(F.col(text), model).alias("found"))
    sure = (F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= LEAST_SCORE)
    return found.where(sure).select("row.*")
