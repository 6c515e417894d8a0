"""Language identification by interpolated Kneser-Ney character models, one per language.

Words (runs of letters, lower case) are read with their borders, so a character's context never leaves its word.  The
counts of all n-grams of the highest order over all training documents come from Spark; lower orders are the usual
continuation counts.  Every n-gram stays, so the model grows with the distinct n-grams of the corpus, without a bound;
it is fitted in arrays, without objects for single n-grams.  For every order the model holds one sorted array of n-gram hashes with a column per language: the
interpolated log probability and the weight of the n-gram as a context that was not continued this way.  The language
with the lowest cross-entropy per character wins.  A text whose lowest cross-entropy is above that language's
calibrated bound is marked as rejected.  Calibration rows, all of one in ten by a hash of doc_id, are judged in Spark by
a second model, that of the counts without them: their cross-entropies give the bounds, and how sure their languages are
the scale of the confidence.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W\d_]+")
START, END = "\x02", " "
UNDETERMINED = "und"
SCHEMA = "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"


@dataclass(frozen=True)
class Settings:
    """Bounds and confidence are set on all rows of one in calibration_of by a hash of doc_id; confident_chars are the
    scales to choose from, the first one where there are no such rows."""

    order: int = 4
    calibration_of: int = 10
    keep_share: float = 0.999
    confident_chars: tuple[int, ...] = (48, 6, 12, 24, 96, 192)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def grams_of(words: Counter, order: int) -> Counter:
    """The n-grams of counted words, borders included."""
    grams: Counter = Counter()
    for word, n in words.items():
        shown = START * (order - 1) + word + END
        for i in range(len(word) + 1):
            grams[shown[i:i + order]] += n
    return grams


def ngram_counts(training: DataFrame, settings: Settings) -> DataFrame:
    """(lang, gram, n, rest) of the highest order: how often over all rows of (lang, text, held), and over those that are
    not held out for calibration; words are counted first in every task."""
    order = settings.order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            rows = [(lang, gram, n, 0 if held else n) for (lang, held), counts in words.items()
                    for gram, n in grams_of(counts, order).items()]
            words.clear()
            lang, gram, n, rest = zip(*rows, strict=True) if rows else ((), (), (), ())
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(gram, pa.string()),
                                               pa.array(n, pa.int64()), pa.array(rest, pa.int64())], ["lang", "gram", "n", "rest"])

        words: dict[tuple[str, bool], Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words[lang, held].update(WORD.findall(text.lower()))
            if sum(map(len, words.values())) > 400_000:
                yield flush()
        yield flush()

    found = training.where("lang is not null and text is not null").select("lang", "text", "held")
    counted = found.mapInArrow(run, "lang string, gram string, n long, rest long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("rest").alias("rest"))


def hashed(codes: np.ndarray, order: int) -> np.ndarray:
    """For each place, the hash of the order characters that end there.  Every character is mixed in before the next:
    sums of multiples of the code points would coincide for many n-grams of a large alphabet."""
    out = np.zeros(len(codes), np.uint64)
    for back in reversed(range(order)):
        shifted = np.zeros(len(codes), np.uint64)
        shifted[back:] = codes[:len(codes) - back]
        out ^= shifted + np.uint64(1)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return out


def gram_codes(grams: list[str], order: int) -> np.ndarray:
    """Rows by n-gram, the code points in columns."""
    return np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(-1, order)


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of n-grams of one order."""
    order = codes.shape[1]
    return hashed(codes.astype(np.uint64).ravel(), order)[order - 1::order]


@dataclass
class Model:
    languages: list[str]
    order: int
    unknown: np.ndarray  # log probability of a character no language has, by language
    keys: list[np.ndarray] = field(default_factory=list)  # by order: sorted hashes
    logs: list[np.ndarray] = field(default_factory=list)  # by order: log probability by language
    weights: list[np.ndarray] = field(default_factory=list)  # by order but the highest: log weight as a context by language
    bounds: np.ndarray | None = None
    confident_chars: int = Settings.confident_chars[0]
    table: WordTable | None = None

    def find(self, order: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = self.keys[order - 1]
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return at, keys[at] == hashes

    def word_logs(self, words: list[str]) -> np.ndarray:
        """Rows by word: log probability under every language, then the number of characters read."""
        shown = [START * (self.order - 1) + w + END for w in words]
        codes = np.frombuffer("".join(shown).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        real = np.flatnonzero(codes != ord(START))
        at, hit = self.find(1, hashed(codes, 1)[real])
        logs = np.where(hit[:, None], self.logs[0][at], self.unknown)
        # the context of the character at a place ends at the place before it
        for order in range(2, self.order + 1):
            context, known = self.find(order - 1, hashed(codes, order - 1)[real - 1])
            backed = logs + np.where(known[:, None], self.weights[order - 2][context], 0.0)
            at, hit = self.find(order, hashed(codes, order)[real])
            logs = np.where(hit[:, None], self.logs[order - 1][at], backed)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.r_[0, ends[:-1]]
        return np.hstack([np.add.reduceat(logs, starts, axis=0), (ends - starts)[:, None]])


def fit(rows: list[tuple[str, str, int]], order: int) -> Model:
    """Interpolated Kneser-Ney from (lang, gram, n) of the highest order."""
    langs, grams, n = zip(*rows, strict=True)
    languages = sorted(set(langs))
    own = np.array([languages.index(lang) for lang in langs])
    return fit_counts(languages, own, gram_codes(list(grams), order), np.array(n, np.int64))


def continuations(own: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The next lower order: by language and n-gram, the number of characters that were seen before it."""
    shorter = codes[:, 1:]
    hashes = gram_hashes(shorter)
    by = np.lexsort((hashes, own))
    starts = np.flatnonzero(np.r_[True, (np.diff(own[by]) != 0) | (hashes[by][1:] != hashes[by][:-1])])
    first = by[starts]
    return own[first], shorter[first], np.diff(np.r_[starts, len(by)])


def fit_counts(languages: list[str], own: np.ndarray, codes: np.ndarray, n: np.ndarray) -> Model:
    """The same from arrays: number of the language, code points and count of every n-gram of the highest order."""
    order = codes.shape[1]
    alphabet = len(np.unique(codes[:, -1])) + 1
    levels = [(own, codes, n)]
    for _ in range(order - 1):
        levels.insert(0, continuations(*levels[0][:2]))
    model = Model(languages, order, np.zeros(len(languages)))
    lower = np.zeros((0, 0))  # probabilities of the order before, in the order of its keys
    for size in range(1, order + 1):
        own, codes, n = levels[size - 1]
        starts = np.full((int(size < order), size), ord(START), np.uint32)  # never read, but a context
        every = np.vstack([codes, starts])
        keys, first = np.unique(gram_hashes(every), return_index=True)
        union = every[first]
        at = np.searchsorted(keys, gram_hashes(codes))
        if size == 1:
            contexts, context = np.zeros(1, np.uint64), np.zeros(len(keys), np.int64)
        else:
            contexts, context = np.unique(gram_hashes(union[:, :-1]), return_inverse=True)
            suffix = np.searchsorted(model.keys[-1], gram_hashes(union[:, 1:]))
            before = np.minimum(np.searchsorted(contexts, model.keys[-1]), len(contexts) - 1)
            continued = contexts[before] == model.keys[-1]
        chances = np.zeros((len(keys), len(languages)))
        for column in range(len(languages)):
            mine = own == column
            count = np.zeros(len(keys))
            count[at[mine]] = n[mine]
            ones, twos = int((n[mine] == 1).sum()), int((n[mine] == 2).sum())
            discount = ones / (ones + 2 * twos) if ones and twos else 0.75
            total = np.bincount(context, count, len(contexts))
            kinds = np.bincount(context, count > 0, len(contexts))
            seen = total > 0
            weight = np.where(seen, discount * kinds / np.where(seen, total, 1), 1.0)
            share = np.maximum(count - discount, 0) / np.where(seen, total, 1)[context]
            if size == 1:
                rest = weight[0] / alphabet
                model.unknown[column] = np.log(rest)
                chances[:, column] = share + rest
            else:
                chances[:, column] = share + weight[context] * lower[suffix, column]
                model.weights[-1][:, column] = np.where(continued, np.log(weight[before]), 0.0)
        model.keys.append(keys)
        model.logs.append(np.log(chances))
        if size < order:
            model.weights.append(np.zeros((len(keys), len(languages))))
        lower = chances
        levels[size - 1] = ()
    return model


class WordTable(dict):
    """Numbers of words; new ones are scored together."""

    def __init__(self, model: Model, most: int = 300_000) -> None:
        super().__init__()
        self.model, self.most = model, most
        self.fresh: list[str] = []
        self.scores = np.zeros((0, len(model.languages) + 1))

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.fresh.append(word)
        return at

    def sums(self, texts: list[list[str]]) -> np.ndarray:
        """By text, the sum over its words."""
        if len(self) > self.most:
            self.clear()
            self.scores = self.scores[:0]
        numbers = [np.fromiter(map(self.__getitem__, words), np.int64, len(words)) for words in texts]
        if self.fresh:
            parts = [self.model.word_logs(self.fresh[i:i + 20_000]) for i in range(0, len(self.fresh), 20_000)]
            self.scores = np.vstack([self.scores, *parts])
            self.fresh = []
        return np.array([self.scores[n].sum(axis=0) if len(n) else np.zeros(self.scores.shape[1]) for n in numbers])


def judge(model: Model, texts: list[str | None], table: WordTable) -> list[tuple]:
    """By text: language, confidence, cross-entropy per character (null without letters), rejected."""
    found = [WORD.findall(t.lower()) if t and has_letter(t) else [] for t in texts]
    out = []
    for sums in table.sums(found):
        chars = sums[-1]
        if not chars:
            out.append((UNDETERMINED, 0.0, None, True))
            continue
        entropy = -sums[:-1] / chars
        best = int(entropy.argmin())
        share = np.exp((entropy[best] - entropy) * min(chars, model.confident_chars))
        rejected = model.bounds is not None and entropy[best] > model.bounds[best]
        out.append((model.languages[best], float(1 / share.sum()), float(entropy[best]), bool(rejected)))
    return out


def without(rows: list[tuple[str, str]], languages: list[str], own: np.ndarray, codes: np.ndarray, n: np.ndarray) -> Model | None:
    """The model of the counts less those of these rows of (lang, text); None if nothing is left."""
    words: dict[str, Counter] = defaultdict(Counter)
    for lang, text in rows:
        words[lang].update(WORD.findall(text.lower()))
    left = n.copy()
    for column, lang in enumerate(languages):
        grams = grams_of(words[lang], codes.shape[1])
        if grams:
            mine = np.flatnonzero(own == column)
            hashes = gram_hashes(codes[mine])
            by = np.argsort(hashes)
            at = np.searchsorted(hashes, gram_hashes(gram_codes(list(grams), codes.shape[1])), sorter=by)
            left[mine[by[at]]] -= np.fromiter(grams.values(), np.int64, len(grams))
    return of_rest(languages, own, codes, left)


def of_rest(languages: list[str], own: np.ndarray, codes: np.ndarray, left: np.ndarray) -> Model | None:
    """The model of the counts that are left; None if none is."""
    kept = left > 0
    return fit_counts(languages, own[kept], codes[kept], left[kept]) if kept.any() else None


def judged(other: Model, rows: list[tuple[str, str]], table: WordTable, settings: Settings) -> list[tuple[int, float, list[float]]]:
    """Of rows of (lang, text) with 40 characters or more in a learned language: its number, its cross-entropy, and the
    log likelihood of the language at every scale of the confidence."""
    out = []
    for lang, text in rows:
        sums = table.sums([WORD.findall(text.lower())])[0]
        if lang in other.languages and sums[-1] >= 40:
            column, entropy = other.languages.index(lang), -sums[:-1] / sums[-1]
            scaled = [-entropy * min(sums[-1], chars) for chars in settings.confident_chars]
            out.append((column, float(entropy[column]), [float(x[column] - np.logaddexp.reduce(x)) for x in scaled]))
    return out


def with_bounds(model: Model, bounds: dict[int, float], worst: float, sure: list[float], settings: Settings) -> Model:
    """Set the bounds, the highest of all cross-entropies for a language without one, and the likeliest scale."""
    model.bounds = np.array([bounds.get(i, worst) for i in range(len(model.languages))])
    model.confident_chars = settings.confident_chars[int(np.argmax(sure))]
    return model


def calibrated(model: Model, other: Model | None, rows: list[tuple[str, str]], settings: Settings) -> Model:
    """Set every language's bound so that it keeps the given share of its calibration rows of 40 characters or more, and
    the scale of the confidence at which their languages are likeliest, both as the other model judges these rows.  A
    language without such rows has the highest of all cross-entropies as its bound; without any nothing is rejected."""
    found = judged(other, rows, WordTable(other), settings) if other else []
    own: dict[int, list[float]] = defaultdict(list)
    for column, entropy, _ in found:
        own[column].append(entropy)
    sure = [sum(x[2][i] for x in found) for i in range(len(settings.confident_chars))]
    worst = max((x[1] for x in found), default=np.inf)
    return with_bounds(model, {i: float(np.quantile(v, settings.keep_share)) for i, v in own.items()}, worst, sure, settings)


def calibrated_on(model: Model, other: Model | None, held: DataFrame, settings: Settings) -> Model:
    """The same over all rows of a table, judged in their tasks.  Cross-entropies are rounded up to four digits, so that the
    distinct ones of a language stay few however many rows there are; likelihoods are summed as decimals, in any order."""
    if other is None:
        return with_bounds(model, {}, np.inf, [0.0], settings)
    shared = held.sparkSession.sparkContext.broadcast(other)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        other = shared.value
        if other.table is None:  # kept for the worker's next tasks
            other.table = WordTable(other)
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            found = judged(other, rows, other.table, settings)
            if found:
                column, entropy, sure = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(column, pa.int32()), pa.array(entropy, pa.float64()),
                                                  pa.array(sure, pa.list_(pa.float64()))], ["column", "entropy", "sure"])

    rows = held.select("lang", "text").mapInArrow(run, "column int, entropy double, sure array<double>")
    sums = [F.sum(F.col("sure")[i].cast("decimal(28,9)")).alias(f"sure{i}") for i in range(len(settings.confident_chars))]
    by = rows.withColumn("entropy", F.ceil(F.col("entropy") * 10_000) / 10_000).groupBy("column").agg(
        F.percentile("entropy", settings.keep_share).alias("bound"), F.max("entropy").alias("worst"), *sums).collect()
    sure = [sum(float(r[f"sure{i}"]) for r in by) for i in range(len(settings.confident_chars))]
    worst = max((r["worst"] for r in by), default=np.inf)
    return with_bounds(model, {r["column"]: r["bound"] for r in by}, worst, sure, settings)


def train(training: DataFrame, settings: Settings = Settings()) -> Model | None:
    """The model from (doc_id, lang, text); None if no row has a language and a letter."""
    held = F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(settings.calibration_of)) == 0)
    marked = training.select("lang", "text", held.alias("held"))
    counts = ngram_counts(marked, settings).toArrow()
    if not counts.num_rows:
        return None
    languages = sorted(counts["lang"].unique().to_pylist())
    own = pc.index_in(counts["lang"], pa.array(languages, pa.string())).to_numpy().astype(np.int64)
    codes = np.vstack([gram_codes(chunk.to_pylist(), settings.order) for chunk in counts["gram"].chunks if len(chunk)])
    n, rest = counts["n"].to_numpy(), counts["rest"].to_numpy()
    model = fit_counts(languages, own, codes, n)
    other = of_rest(languages, own, codes, rest) if (rest < n).any() else None
    return calibrated_on(model, other, marked.where("held and lang is not null and text is not null"), settings)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Language of every whole text, however long.  Null, empty and letterless texts are `und` with score 0; so is every
    text if nothing was learned.  Equal cross-entropies go to the first language by name; repeated rows each give a row,
    an empty table none.  Columns other than doc_id and text are not read, whatever their names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        if model and model.table is None:  # kept for the worker's next tasks
            model.table = WordTable(model)
        table = model and model.table
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            rows = judge(model, texts, table) if model else [(UNDETERMINED, 0.0, None, True)] * len(texts)
            if rows:
                lang, score, entropy, rejected = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(lang), pa.array(score, pa.float64()), pa.array(entropy, pa.float64()), pa.array(rejected)],
                    ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
