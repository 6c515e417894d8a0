"""Personal data: overlapping candidate spans, scored by gradient-boosted trees, chosen at calibrated thresholds.

Strict patterns give the base spans, which are always kept.  Loose generators propose further spans: addresses with
written-out signs, numbers with missing signs, unusual separators or no valid check digit.  Trees over the format and
the context of a candidate decide about these.  They learn from all candidates of all documents, in passes over a table of
their distinct features: base spans and their disguised forms in the same place are positive, other candidates are
negative.  The threshold of each kind is the lowest at which all held-out candidates reach the wanted precision; a kind that
never does adds nothing.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakefold.llm import boosting, common

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]  # start, end, kind

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is only tried from its start: from a later digit the match would go on just the same.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
# The loose generators read one stretch of digits and separators at a time; every stretch starts and ends with a digit,
# an opening bracket or a plus sign aside.
STRETCH = re.compile(r"[+(]{0,2}[0-9](?:[ ().\-/ ‐-―]{0,3}[0-9])*")
WORDED = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:@|[\[({<] ?at ?[\])}>]) ?"
                    r"[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[({<] ?dot ?[\])}>]) ?[A-Za-z0-9-]{1,63}){1,6}", re.I)
WORDED_SIGN = re.compile(r"@|[\[({<] ?at ?[\])}>]", re.I)
CONTEXT = (re.compile(r"\b(?:tel|phone|call|fax|mobile|whatsapp|tél)", re.I), re.compile(r"\b(?:card|visa|pay|iban|account|konto|carte)", re.I),
           re.compile(r"\b(?:e?-?mail|contact|write|kontakt)", re.I), re.compile(r"\b(?:ip|host|server|address)\b", re.I),
           re.compile(r"\b(?:version|v|license|no|nr|id|token|key|page|isbn)\b", re.I))
N_FEATURES = 29


def luhn(digits: str) -> bool:
    total = 0
    for place, char in enumerate(reversed(digits)):
        n = int(char) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of the address pattern, found from its sign: a start fails or fits with its whole run."""
    done, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        found = DOMAIN.match(text, sign + 1) if start < sign else None
        if found:
            yield start, found.end(), "email"
            done = found.end()
        else:
            done = sign + 1  # no start before this sign can match past it
        sign = text.find("@", max(done, sign + 1))


def base_spans(text: str) -> list[Span]:
    """The strict spans of every kind, by start and kind."""
    found = list(emails(text)) if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(q := p.lstrip("0")) <= 3 and int(q or 0) <= 255 for p in m[0].split(".")):
                found.append((*m.span(), "ip"))
        for m in CARD.finditer(text):
            if 14 <= m.end() - m.start() and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                found.append((*m.span(), "card"))
        if "+" in text:
            found += [(*m.span(), "phone") for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def shown(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def candidates(text: str) -> list[Span]:
    """Loose spans, overlapping ones included."""
    found: set[Span] = set()
    if WORDED_SIGN.search(text):
        found |= {(*m.span(), "email") for m in WORDED.finditer(text)}
    if not DIGIT.search(text):
        return sorted(found)
    for m in STRETCH.finditer(text):
        start, end = m.span()
        if end - start < 7:
            continue
        n = len(digits_of(m[0]))
        if 7 <= n <= 15:
            found.add((start, end, "phone"))
        if 12 <= n <= 19:
            found.add((start, end, "card"))
        parts = m[0].lstrip("+(").split(".")
        if len(parts) == 4 and all(p.isdigit() for p in parts):
            found.add((end - len(m[0].lstrip("+(")), end, "ip"))
    return sorted(found)


def kind_of_char(char: str) -> int:
    if not char:
        return 0
    return 1 if char.isspace() else 2 if char.isalpha() else 3 if char.isdigit() else 4


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate."""
    start, end, kind = span
    own, before, after = text[start:end], text[max(0, start - 30):start], text[end:end + 30]
    digits, runs = digits_of(own), [len(r) for r in re.findall(r"[0-9]+", own)] or [0]
    parts = own.split(".")
    near = before + after
    return [
        *(float(kind == k) for k in KINDS), len(own), len(digits), sum(map(str.isalpha, own)), len(runs), runs[0], runs[-1],
        max(runs), own.count("."), own.count("-"), own.count(" "), own.count("(") + own.count(")"), float("+" in own),
        float(len(digits) >= 12 and luhn(digits)), float(len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)),
        float("@" in own), float(len(parts[-1])), float(kind_of_char(text[start - 1:start])), float(kind_of_char(text[end:end + 1])),
        sum(map(str.isdigit, near)) / (len(near) + 1), sum(map(str.isalpha, near)) / (len(near) + 1),
        *(float(bool(c.search(near))) for c in CONTEXT),
    ]


def disguised(own: str, kind: str) -> list[str]:
    """Other ways to write a base span."""
    if kind == "email":
        local, domain = own.split("@", 1)
        return [f"{local} [at] {domain.replace('.', ' [dot] ')}", f"{local}(at){domain}", f"{local} @ {domain}"]
    if kind == "phone":
        national = own.lstrip("+").partition(" ")[2] or own.lstrip("+")
        digits = digits_of(national)
        return [national, "-".join((digits[:3], digits[3:6], digits[6:])), f"00{digits_of(own)[0]} {national}"]
    if kind == "card":
        digits = digits_of(own)
        groups = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return [".".join(groups), "  ".join(groups)]
    return []


@dataclass(frozen=True)
class Settings:
    """The precision that a threshold must reach on held-out candidates, and the least threshold."""

    precision: float = 0.99
    least_threshold: float = 0.5


@dataclass
class Detector:
    model: boosting.Boosted | None = None
    thresholds: dict[str, float] = field(default_factory=dict)

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and those together with the chosen candidates that touch no base span and no better choice."""
        base = base_spans(text)
        if self.model is None or not self.thresholds:
            return base, base
        free = [c for c in candidates(text) if c[2] in self.thresholds and not any(c[0] < e and s < c[1] for s, e, _ in base)]
        if not free:
            return base, base
        chance = self.model.probability(np.array([features(text, c) for c in free]))
        chosen: list[Span] = []
        for p, c in sorted(zip(chance.tolist(), free, strict=True), key=lambda pc: (-pc[0], pc[1])):
            if p >= self.thresholds[c[2]] and not any(c[0] < e and s < c[1] for s, e, _ in chosen):
                chosen.append(c)
        return base, sorted(base + chosen, key=lambda s: (s[0], KINDS.index(s[2])))


def some(spans: list[Span], text: str, most: int) -> list[Span]:
    """Of every kind so many at the most, the first by a hash of what they cover and where."""
    out = []
    for kind in KINDS:
        own = [s for s in spans if s[2] == kind]
        if len(own) > most:
            own = sorted(own, key=lambda s: (zlib.crc32(f"{text[s[0]:s[1]]}:{s[0]}".encode("utf-8", "replace")), s))[:most]
        out += own
    return sorted(out)


def training_rows(doc: int, text: str, most: int | None = None) -> Iterator[tuple]:
    """(doc, kind, label, features) of the candidates of a text and of the disguised forms of its base spans; of so many
    spans of a kind, where that is given."""
    base = every = base_spans(text)
    exact = set(every)
    loose = [c for c in candidates(text) if c in exact or not any(c[0] < e and s < c[1] for s, e, _ in every)]
    if most is not None:
        base, loose = some(every, text, most), some(loose, text, most)
    for c in loose:
        yield doc, c[2], int(c in exact), features(text, c)
    for start, end, kind in base:
        before, after = text[max(0, start - 60):start], text[end:end + 60]
        for own in disguised(text[start:end], kind):
            changed = before + own + after
            for c in candidates(changed):
                if c[2] == kind and c[0] == len(before) and c[1] == len(before) + len(own):
                    yield doc, kind, 1, features(changed, c)


def train(docs: DataFrame, settings: Settings = Settings()) -> Detector:
    """A detector from all documents, a quarter of them by a hash of doc_id held out for the thresholds.  Null ids and texts
    teach nothing; every row of a repeated doc_id does."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null and doc_id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = list(training_rows(doc, text))
                if rows:
                    _, kind, label, x = zip(*rows, strict=True)
                    held = (doc * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 62 == 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(kind), pa.array(label, pa.int32()), pa.array([held] * len(rows)), pa.array(x, pa.list_(pa.float64()))],
                        ["kind", "label", "held", "x"])

    found = known.mapInArrow(run, "kind string, label int, held boolean, x array<double>")
    table = common.stored(found.groupBy("kind", "label", "held", "x").agg(F.count(F.lit(1)).alias("n")), "personal-data-candidates")
    learned, held = table.where("not held"), table.where("held")
    if learned.select("label").distinct().count() < 2 or held.isEmpty():
        return Detector()
    model = boosting.fit_on(learned)
    return Detector(model, thresholds(held, model, settings))


def thresholds(held: DataFrame, model: boosting.Boosted, settings: Settings) -> dict[str, float]:
    """The lowest threshold of each kind at which all held-out candidates reach the precision.  Chances are rounded down to
    six digits, so that few distinct ones reach the driver; equal ones stand or fall together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                chance = np.floor(model.probability(boosting.rows_of(batch.column(3))) * 1e6) / 1e6
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(chance)], ["kind", "label", "n", "chance"])

    judged = held.select("kind", "label", "n", "x").mapInArrow(run, "kind string, label int, n long, chance double")
    rows = judged.where(F.col("chance") >= settings.least_threshold).groupBy("kind", "chance").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("right")).orderBy("kind", F.desc("chance")).collect()
    out = {}
    for kind in KINDS:
        own = [r for r in rows if r["kind"] == kind]
        precise = np.cumsum([r["right"] for r in own]) / np.cumsum([r["n"] for r in own])
        good = np.flatnonzero(precise >= settings.precision)
        if len(good):
            out[kind] = own[good[-1]]["chance"]
    return out


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(docs: DataFrame, detector: Detector) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every whole text, however long.  Null texts count as empty;
    repeated rows each give a row, an empty table none; of equally likely candidates that touch, the first by place and
    kind is chosen; columns other than doc_id and text are not read, whatever their names."""
    shared = docs.sparkSession.sparkContext.broadcast(detector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, every = shared.value.spans(text or "")
                rows.append((*(sum(k == kind for _, _, kind in base) for k in KINDS),
                             hashlib.sha256(shown(base).encode()).hexdigest(), shown(every)))
            if rows:
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), [pa.int64()] * 4 + [pa.string()] * 2)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every stretch of overlapping spans replaced by the kind of its first span."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, detector: Detector) -> DataFrame:
    """The documents with personal data replaced in their texts and n_chars set anew; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(detector)

    def run(texts):
        return texts.map(lambda t: t if t is None else redacted(t, shared.value.spans(t)[1]))

    changed = docs.withColumn("text", F.pandas_udf(run, "string")("text"))
    return changed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else changed
