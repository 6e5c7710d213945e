"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter n-gram is bound from the vectors
of its letters, each permuted (rotated) by its place from the end, by multiplying them
elementwise. A text is the bundle, that is the sum, of its n-grams' vectors; a language's
prototype is the bundle of its training texts, each at length one. A text has the
language of the nearest prototype by cosine.

Letter vectors come from a seed and the code point, so any letter of any script has one
and no table is shipped. A worker keeps the vectors of the n-grams it has met.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billbook.llm.common import kept

UNDETERMINED = "und"
# n-grams whose vectors a worker keeps; the table is emptied when full.
KEPT = 60_000
# n-grams that are counted at a time; a longer text is bundled part by part.
PART = 200_000


@dataclass(frozen=True)
class Profile:
    """Parameters of the vectors."""

    dimensions: int = 1024
    n: int = 3
    seed: int = 11


class _Space:
    """Letters, n-grams and their vectors, as one worker has met them."""

    def __init__(self, profile: Profile):
        self.profile = profile
        # Letter number by code point: 0 for what is no letter, -1 not looked at yet.
        self.letter = np.full(0x110000, -1, np.int32)
        self.vectors = [np.zeros(profile.dimensions, np.int8)]
        self.by_fold: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.int64)  # sorted n-gram codes
        self.place = np.zeros(0, np.int64)  # their rows
        self.rows = np.empty((KEPT, self.profile.dimensions), np.int8)

    def _new_letters(self, points: np.ndarray) -> None:
        for point in np.unique(points).tolist():
            char = chr(point).lower()
            if not chr(point).isalpha():
                self.letter[point] = 0
                continue
            if char not in self.by_fold:
                self.by_fold[char] = len(self.vectors)
                random = np.random.default_rng([self.profile.seed, *map(ord, char)])
                self.vectors.append(random.integers(0, 2, self.profile.dimensions, np.int8) * 2 - 1)
            self.letter[point] = self.by_fold[char]

    def codes(self, text: str) -> Iterator[np.ndarray]:
        """A number for each n-gram, in parts; every run of non-letters and both borders are one blank."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = self.letter[points]
        if (letters < 0).any():
            self._new_letters(points[letters < 0])
            letters = self.letter[points]
        padded = np.concatenate(([0], letters, [0])).astype(np.int64)
        padded = padded[np.concatenate(([True], (padded[1:] != 0) | (padded[:-1] != 0)))]
        n = self.profile.n
        if not padded.any():
            return
        for first in range(0, len(padded) - n + 1, PART):
            part = padded[first : first + PART + n - 1]
            code = np.zeros(len(part) - n + 1, np.int64)
            for i in range(n):
                code = (code << 17) | part[i : len(part) - n + 1 + i]
            yield code

    def _bound(self, codes: np.ndarray) -> np.ndarray:
        n = self.profile.n
        blank = np.random.default_rng([self.profile.seed]).integers(0, 2, self.profile.dimensions, np.int8) * 2 - 1
        table = np.stack([blank, *self.vectors[1:]]).astype(np.int8)
        out = np.ones((len(codes), self.profile.dimensions), np.int8)
        for i in range(n):
            out *= np.roll(table, i, axis=1)[(codes >> (17 * i)) & 0x1FFFF]
        return out

    def vectors_of(self, codes: np.ndarray) -> np.ndarray:
        """A row for each of up to KEPT // 2 sorted distinct codes."""
        at = np.minimum(np.searchsorted(self.known, codes), max(len(self.known) - 1, 0))
        new = codes[self.known[at] != codes] if len(self.known) else codes
        if len(new):
            if len(self.known) + len(new) > KEPT:
                self._clear()
                new = codes
            self.rows[len(self.known) : len(self.known) + len(new)] = self._bound(new)
            place = np.concatenate((self.place, np.arange(len(self.known), len(self.known) + len(new))))
            known = np.concatenate((self.known, new))
            order = np.argsort(known)
            self.known, self.place = known[order], place[order]
            at = np.searchsorted(self.known, codes)
        return self.rows[self.place[at]].astype(np.float32)

    def bundles(self, texts: list[str | None]) -> np.ndarray:
        """A row for each text: the sum of its n-grams' vectors; zero without letters."""
        out = np.zeros((len(texts), self.profile.dimensions), np.float32)
        owner: list[np.ndarray] = []
        codes: list[np.ndarray] = []
        held = 0
        for i, text in enumerate(texts):
            for found in self.codes(text or ""):
                owner.append(np.full(len(found), i))
                codes.append(found)
                held += len(found)
                if held > PART:
                    self._add(out, np.concatenate(owner), np.concatenate(codes))
                    owner, codes, held = [], [], 0
        if held:
            self._add(out, np.concatenate(owner), np.concatenate(codes))
        return out

    def _add(self, out: np.ndarray, owner: np.ndarray, codes: np.ndarray) -> None:
        distinct, column = np.unique(codes, return_inverse=True)
        first_owner = owner[0]
        people = owner[-1] - first_owner + 1
        for first in range(0, len(distinct), KEPT // 2):
            width = min(KEPT // 2, len(distinct) - first)
            block = (column >= first) & (column < first + width)
            cell = (owner[block] - first_owner) * width + column[block] - first
            counts = np.bincount(cell, minlength=people * width).reshape(people, width)
            vectors = self.vectors_of(distinct[first : first + width])
            out[first_owner : first_owner + people] += counts.astype(np.float32) @ vectors


def _space(profile: Profile) -> _Space:
    return kept(("langid", profile), lambda: _Space(profile))


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def learn(labelled: DataFrame, profile: Profile = Profile()) -> dict[str, np.ndarray]:
    """Language -> prototype, from rows (text, lang); rows without text or lang teach nothing.

    Every task bundles its own rows, and the driver gets one vector per language.
    """
    rows = labelled.where("text is not null and lang is not null").select("text", "lang")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = _space(profile), {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                units = _unit(space.bundles(part.column("text").to_pylist()))
                for lang in set(langs[first : first + 512]):
                    own = units[langs[first : first + 512] == lang].sum(axis=0, dtype=np.float64)
                    sums[lang] = sums.get(lang, 0) + own
        places = np.arange(profile.dimensions, dtype=np.int32)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * len(places), "place": places, "value": total},
                pa.schema([("lang", pa.string()), ("place", pa.int32()), ("value", pa.float64())]),
            )

    parts = rows.mapInArrow(bundle, "lang string, place int, value double")
    sums = parts.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    prototypes: dict[str, np.ndarray] = {}
    for row in sums.collect():
        prototypes.setdefault(row["lang"], np.zeros(profile.dimensions))[row["place"]] = row["value"]
    return prototypes


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], profile: Profile = Profile()) -> DataFrame:
    """Add lang_pred and score to docs: the nearest prototype's language, and its cosine, at least 0.

    Only `text` is looked at. `und` with score 0 where it is NULL or has no letter, or where nothing
    was learned; ties go to the language first in text order. All columns of docs stay, but for their
    own `lang_pred` and `score`, which are replaced; all rows stay as well.
    """
    langs = sorted(prototypes)
    matrix = _unit(np.array([prototypes[x] for x in langs]).reshape(len(langs), profile.dimensions))
    rows = docs.drop("lang_pred", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = _space(profile)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                bundles = space.bundles(part.column("text").to_pylist())
                has_letters = bundles.any(axis=1)
                cosines = _unit(bundles) @ matrix.T if langs else np.zeros((part.num_rows, 1))
                best = cosines.argmax(axis=1)
                decided = has_letters & bool(langs)
                pred = [langs[b] if d else UNDETERMINED for b, d in zip(best, decided, strict=True)]
                score = np.where(decided, np.clip(cosines.max(axis=1), 0.0, 1.0), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                    [*part.schema.names, "lang_pred", "score"],
                )

    schema = T.StructType(
        [*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return rows.mapInArrow(run, schema)
