"""Toxic texts by a subsequence string-kernel support vector machine on Nyström landmarks.

The kernel of two words counts the subsequences of three characters they share, gaps allowed, weighted by a decay to
the power of the stretch each takes up, word borders being characters too; it is divided by a norm that depends on the
word's length alone.  So a word with inserted or doubled characters stays close to the word it hides.

Training sentences carry the label of their document.  A toxic document says only that some of its words are insults:
words that are frequent in toxic sentences and absent from clean ones stand for them, and words of clean sentences,
above all those the machine takes for insults, are the other class.  Landmarks are a bounded set of these words.
As the machine is linear in the landmarks' kernel values, and these in the counted subsequences, it folds into one
table of weights by subsequence: scoring a word sums table entries and gives exactly the machine's decision value.
A text's score is a logistic function of its highest word value and of the number of words above zero.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACED = re.compile(r"(?<!\S)\w(?:[ .\-_*]{1,2}\w){3,}(?!\S)")
SENTENCE = re.compile(r"[.!?]+\s|\n")
LONGEST = 32
FLOOR = -3.0


@dataclass(frozen=True)
class Settings:
    """toxic_documents and clean_documents bound what is learned from, words_per_class and landmarks the machine."""

    toxic_documents: int = 3_000
    clean_documents: int = 3_000
    words_per_class: int = 1_500
    landmarks: int = 160
    decay: float = 0.7
    stretch: int = 6
    cost: float = 4.0
    mining_rounds: int = 3
    certainty: float = 2.0


def letters(token: str) -> str:
    return "".join(filter(str.isalpha, token))


def units(text: str) -> set[str]:
    """The distinct tokens of a text, and stretches of single spaced-out letters put together."""
    found = set(text.lower().split())
    found.update(m[0] for m in SPACED.finditer(text.lower()))
    return found


def windows(word: str) -> list[str]:
    """A long word is read in overlapping windows."""
    if len(word) <= LONGEST:
        return [word]
    return [word[i:i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


@functools.cache
def places(length: int, decay: float, stretch: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All i < j < k at most a stretch apart, with their weights divided by the length's norm."""
    triples = [(i, j, k) for i in range(length) for k in range(i + 2, min(length, i + stretch + 1)) for j in range(i + 1, k)]
    i, j, k = np.array(triples, np.int64).T
    weight = decay ** (k - i + 1.0)
    return i, j, k, weight / np.sqrt((weight ** 2).sum())


@dataclass
class Alphabet:
    """Numbers of all characters of the words it is made of; 0 is any other character, which no landmark has, 1 a word's border."""

    codes: dict[str, int]

    @property
    def size(self) -> int:
        return len(self.codes) + 2

    @staticmethod
    def of(words: Iterable[str]) -> Alphabet:
        return Alphabet({c: i + 2 for i, c in enumerate(sorted(set().union(*words)))})

    @functools.cached_property
    def look(self) -> np.ndarray:
        table = np.zeros(0x110000, np.int64)
        table[[ord(c) for c in self.codes]] = list(self.codes.values())
        return table

    def triples(self, words: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
        """For words of one length: rows of subsequence numbers, and the weights of the columns."""
        codes = np.ones((len(words), len(words[0]) + 2), np.int64)
        codes[:, 1:-1] = self.look[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)].reshape(len(words), -1)
        i, j, k, weight = places(codes.shape[1], settings.decay, settings.stretch)
        return (codes[:, i] * self.size + codes[:, j]) * self.size + codes[:, k], weight


@dataclass
class Table:
    """Values by subsequence number, zero for all it does not hold: as large as the landmarks' subsequences, whatever the alphabet."""

    numbers: np.ndarray  # sorted
    values: np.ndarray  # one more than numbers, the last one zero

    def places(self, numbers: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.numbers, numbers), len(self.numbers) - 1)
        return np.where(self.numbers[at] == numbers, at, len(self.numbers))

    def __getitem__(self, numbers: np.ndarray) -> np.ndarray:
        return self.values[self.places(numbers)]


def by_length(words: list[str], at_most: int = 4_000) -> Iterator[np.ndarray]:
    """Numbers of words of equal length, in blocks."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        for start in range(0, len(rows), at_most):
            yield rows[start:start + at_most]


@dataclass
class Machine:
    alphabet: Alphabet
    table: Table
    bias: float
    settings: Settings
    logistic: tuple[float, float, float] = (0.0, 0.0, 0.0)
    seen: dict[str, float] | None = None

    def words(self, words: list[str]) -> np.ndarray:
        """Decision values of words (letters only, at least one, at most LONGEST)."""
        out = np.empty(len(words))
        for rows in by_length(words):
            triples, weight = self.alphabet.triples([words[r] for r in rows], self.settings)
            out[rows] = self.table[triples] @ weight + self.bias
        return out

    def tokens(self, tokens: list[str]) -> np.ndarray:
        """Decision values of raw tokens: the highest of their windows; FLOOR without letters."""
        parts = [(n, w) for n, token in enumerate(tokens) if (word := letters(token)) for w in windows(word)]
        out = np.full(len(tokens), FLOOR)
        if parts:
            np.maximum.at(out, [n for n, _ in parts], self.words([w for _, w in parts]))
        return out

    def evidence(self, texts: list[str]) -> np.ndarray:
        """By text: the highest value and the logarithm of 1 plus the number of distinct tokens above zero."""
        if self.seen is None or len(self.seen) > 400_000:
            self.seen = {}
        found = [units(t) for t in texts]
        fresh = [token for token in set().union(*found) if token not in self.seen]
        for start in range(0, len(fresh), 50_000):
            some = fresh[start:start + 50_000]
            self.seen.update(zip(some, self.tokens(some).tolist(), strict=True))
        out = np.empty((len(texts), 2))
        for row, tokens in enumerate(found):
            values = list(map(self.seen.__getitem__, tokens))
            out[row] = max(values, default=FLOOR), np.log1p(sum(v > 0 for v in values))
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        a, b, c = self.logistic
        evidence = self.evidence(texts)
        return 1 / (1 + np.exp(-np.clip(a + b * evidence[:, 0] + c * evidence[:, 1], -30, 30)))


def features(alphabet: Alphabet, words: list[str], landmarks: list[str], settings: Settings) -> np.ndarray:
    """Kernel values of words and landmarks."""
    counted = [alphabet.triples([word], settings) for word in landmarks]
    used = np.unique(np.concatenate([triples[0] for triples, _ in counted]))
    spread = Table(used, np.zeros((len(used) + 1, len(landmarks)), np.float32))
    for column, (triples, weight) in enumerate(counted):
        np.add.at(spread.values[:, column], spread.places(triples[0]), weight)
    out = np.empty((len(words), len(landmarks)))
    for rows in by_length(words, 100):
        triples, weight = alphabet.triples([words[r] for r in rows], settings)
        out[rows] = np.tensordot(spread[triples], weight.astype(np.float32), ((1,), (0,)))
    return out


def squared_hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 30) -> np.ndarray:
    """Weights (the last one the bias) of the linear machine with squared hinge loss, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        active = y * (x @ w) < 1
        own = x[active] * cost[active, None]
        new = np.linalg.solve(ridge + own.T @ x[active], own.T @ y[active])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def fit_machine(positive: list[str], negative: list[str], alphabet: Alphabet, settings: Settings) -> Machine:
    rng = np.random.default_rng(7)
    half = settings.landmarks // 2
    chosen = positive[:half] + [negative[i] for i in rng.permutation(len(negative))[:settings.landmarks - min(half, len(positive))]]
    landmarks = sorted(set(chosen))
    words = positive + negative
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    cost = settings.cost * np.where(y > 0, len(words) / (2 * len(positive)), len(words) / (2 * len(negative)))
    among = features(alphabet, landmarks, landmarks, settings)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 1e-6))  # Nyström map: kernel values times this
    w = squared_hinge(features(alphabet, words, landmarks, settings) @ root, y, cost)
    counted = [alphabet.triples([word], settings) for word in landmarks]
    used = np.unique(np.concatenate([triples[0] for triples, _ in counted]))
    table = Table(used, np.zeros(len(used) + 1))
    for (triples, weight), beta in zip(counted, root @ w[:-1], strict=True):
        np.add.at(table.values, table.places(triples[0]), beta * weight)
    return Machine(alphabet, table, float(w[-1]), settings)


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, ...]:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-3, *[1e-2] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge @ w
        w = w - np.linalg.solve(ridge + (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(len(w)), gradient)
    return tuple(w.tolist())


def with_inserted(words: list[str], rng: np.random.Generator) -> list[str]:
    """Words of five letters or more with one character doubled or put in."""
    out = []
    for word in words:
        if len(word) >= 5:
            at = int(rng.integers(1, len(word)))
            out.append(word[:at] + (word[at - 1] if rng.random() < 0.5 else "x") + word[at:])
    return out


def surplus(toxic: Counter, clean: Counter, sentences: list[int]) -> dict[str, float]:
    """Of the words at least twenty times as frequent in toxic sentences: minus the logarithm of a bound on the chance
    that a word of its count lies so unevenly by accident."""
    out, share = {}, sentences[1] / sum(sentences)
    for word, n in toxic.items():
        other = clean[word]
        if n * sentences[0] >= 20 * other * sentences[1]:
            total = n + other
            out[word] = n * np.log(n / (total * share)) + (other * np.log(other / (total * (1 - share))) if other else 0.0)
    return out


def fit(rows: list[tuple[str, int]], settings: Settings = Settings()) -> Machine | None:
    """The machine from labelled texts; None if a class is missing or no word tells toxic texts from clean ones."""
    toxic, clean, sentences, seen = Counter(), Counter(), [0, 0], set()
    for text, label in rows:
        for sentence in SENTENCE.split(text):
            mark = xxhash.xxh64_intdigest(sentence) ^ label
            if mark not in seen:  # copies of a document say no more than one of them
                seen.add(mark)
                found = {letters(u) for u in units(sentence)}
                (toxic if label else clean).update(w for w in found if 1 < len(w) <= LONGEST)
                sentences[label] += 1
    if not toxic or not clean:
        return None
    evidence = surplus(toxic, clean, sentences)
    needed = np.log(len(toxic)) + settings.certainty
    positive = sorted((w for w, v in evidence.items() if v >= needed), key=lambda w: (-evidence[w], w))
    if not positive:
        return None
    positive = positive[:settings.words_per_class]
    rng = np.random.default_rng(11)
    alphabet = Alphabet.of(list(toxic) + list(clean))
    pool = sorted(w for w in clean if w not in set(positive))
    half = settings.words_per_class // 2
    frequent = [w for w, _ in clean.most_common(half) if w not in set(positive)]
    negative = sorted(set(frequent) | {pool[i] for i in rng.permutation(len(pool))[:half]})
    trained = positive + with_inserted(positive, rng)
    for _ in range(settings.mining_rounds):
        machine = fit_machine(trained, negative, alphabet, settings)
        values = machine.words(pool)
        hard = [pool[i] for i in np.argsort(-values, kind="stable")[:half] if values[i] > -0.5]
        if set(hard) <= set(negative):
            break
        negative = sorted(set(negative) | set(hard))
    evidence = [machine.evidence([t for t, _ in rows[i:i + 200]]) for i in range(0, len(rows), 200)]
    machine.logistic = logistic(np.vstack(evidence), np.array([float(label) for _, label in rows]))
    machine.seen = None
    return machine


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Machine | None:
    """Learn from the first labelled documents of either class by a hash of doc_id.  Null labels and texts teach
    nothing; of several labels of a document the highest holds."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.join(docs.where("text is not null").select("doc_id").distinct(), "doc_id", "left_semi")
    chosen: dict[int, int] = {}
    for label, most in ((0, settings.clean_documents), (1, settings.toxic_documents)):
        first = known.where((F.col("toxic") > 0) == F.lit(bool(label))).select("doc_id")
        first = first.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen |= {r["doc_id"]: label for r in first.collect()}
    found = docs.where("text is not null").where(F.col("doc_id").isin(list(chosen))).select("doc_id", "text").collect()
    return fit([(r["text"], chosen[r["doc_id"]]) for r in sorted(found, key=lambda r: (r["doc_id"], r["text"]))], settings)


def scored(docs: DataFrame, machine: Machine | None, name: str = "score") -> DataFrame:
    """The documents with a score from 0 to 1 of every whole text; all other columns stay.  Null texts count as empty;
    without a machine every score is 0."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(texts):
        return texts.fillna("").to_frame("t").assign(s=shared.value.scores(list(texts.fillna(""))))["s"]

    return docs.withColumn(name, F.pandas_udf(run, "double")("text") if machine else F.lit(0.0))


def score_documents(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """(doc_id, score, predicted): predicted is 1 from a score of 0.5 on.  Only doc_id and text are read."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            scores = shared.value.scores(texts) if shared.value else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")
