"""Exact merge-type SentencePiece encoding by backtracking, and decoding.

A sequence of pieces is what merging by score yields exactly if every adjacent pair, merged anew from its characters,
gives the same two pieces.  So a word is read from left to right with the longest piece at each place (all matches come
from one pass of an Aho-Corasick automaton); a piece that is not compatible with the one before it gives way to the
longest shorter piece, and a place where none is left is marked in a bitfield and never tried again.

No piece goes on after its leading spaces' word has ended, so a text is cut before each run of spaces and words are
encoded on their own; frequent ones are kept in a bounded table.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

SPACE = "▁"
NEVER = float("-inf")
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Words(dict):
    """Pieces by word, as ids and as text, in two generations that bound the memory: when the newer one is full it becomes
    the older, and what is used again moves up.  Long words are not kept."""

    def __init__(self, encode, most: int = 300_000, longest: int = 48) -> None:
        super().__init__()
        self.encode, self.most, self.longest = encode, most, longest
        self.older: dict[str, tuple[tuple[int, ...], str]] = {}

    def __missing__(self, word: str) -> tuple[tuple[int, ...], str]:
        found = self.older.get(word)
        if found is None:
            ids = tuple(self.encode(word))
            found = ids, " ".join(map(str, ids))
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found


class MergeEncoder:
    def __init__(self, model_file: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = self.library.get_piece_size()
        special = [self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) for i in range(size)]
        self.piece = [self.library.id_to_piece(i) for i in range(size)]
        self.id = {p: i for i, p in enumerate(self.piece) if not special[i]}
        self.score = {p: self.library.get_score(i) for p, i in self.id.items()}
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("a piece spans words; words cannot be encoded on their own")
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.end = self.library.eos_id()
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}
        self.length = list(map(len, self.piece))
        self.compatible: dict[tuple[int, int], bool] = {}
        self.words = Words(self.encode_word)
        self.cut = re.compile(f"{SPACE}+[^{SPACE}]*")

    def merged(self, text: str) -> list[str]:
        """The definition: merge the adjacent pair of the best score, the leftmost of equals, until none is a piece."""
        parts, score = list(text), self.score
        scores = [score.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) > NEVER:
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            for j in (i - 1, i):
                if 0 <= j < len(scores):
                    scores[j] = score.get(parts[j] + parts[j + 1], NEVER)
        return parts

    def fits(self, before: int, piece: int) -> bool:
        """Whether merging gives these two pieces again; before is -1 at the start and -2 after a character without piece."""
        known = self.compatible.get((before, piece))
        if known is None:
            if before < 0:
                known = self.merged(self.piece[piece]) == [self.piece[piece]]
            else:
                known = self.merged(self.piece[before] + self.piece[piece]) == [self.piece[before], self.piece[piece]]
            if len(self.compatible) >= 2_000_000:
                self.compatible.clear()
            self.compatible[before, piece] = known
        return known

    def next_shorter(self, piece: int) -> int:
        """The longest piece that is a proper prefix of this one; -1 if none is."""
        found = self.shorter.get(piece)
        if found is None:
            text = self.piece[piece]
            found = next((self.id[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.id), -1)
            self.shorter[piece] = found
        return found

    def encode_word(self, word: str) -> list[int]:
        size, length, known = len(word), self.length, self.compatible
        longest = [-1] * size
        for last, piece in self.automaton.iter(word):
            longest[last - length[piece] + 1] = piece  # ends ascend: the longest at a place comes last
        # many words are their longest pieces in a row: nothing fails, so there is nothing to go back to
        straight: list[int] = []
        at, before = 0, -1
        while at < size:
            piece = longest[at]
            if piece < 0 or not (known.get((before, piece)) or self.fits(before, piece)):
                return self._backtracked(word, longest)
            straight.append(piece)
            at, before = at + length[piece], piece
        return straight

    def _backtracked(self, word: str, longest: list[int]) -> list[int]:
        size, length, compatible = len(word), self.length, self.compatible
        failed = bytearray(size // 8 + 1)
        found: list[tuple[int, int]] = []  # piece (or -2 for a character without one) and its start
        at, piece = 0, longest[0] if size else -1
        while at < size:
            if piece == -1 and longest[at] == -1:
                found.append((-2, at))
                at += 1
                piece = longest[at] if at < size else -1
                continue
            before = found[-1][0] if found else -1
            while piece >= 0:
                end = at + length[piece]
                if not failed[end >> 3] >> (end & 7) & 1:
                    fits = compatible.get((before, piece))
                    if self.fits(before, piece) if fits is None else fits:
                        break
                shorter = self.shorter.get(piece)
                piece = self.next_shorter(piece) if shorter is None else shorter
            if piece >= 0:
                found.append((piece, at))
                at = end
                piece = longest[at] if at < size else -1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece, at = found.pop()
                if piece == -2:
                    raise AssertionError("a place after a character without piece cannot fail")
        out: list[int] = []
        for piece, at in found:
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(self.bytes[b] for b in word[at].encode())
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text without the end id."""
        if not text:
            return []
        return list(chain.from_iterable(ids for ids, _ in self._words(text)))

    def encode_shown(self, text: str) -> tuple[list[int], str]:
        """Ids of a whole text with the end id, and their decimals joined by spaces."""
        words = self._words(text) if text else []
        ids = list(chain.from_iterable([w[0] for w in words]))
        ids.append(self.end)
        return ids, " ".join([*(w[1] for w in words), str(self.end)])

    def _words(self, text: str) -> list[tuple[tuple[int, ...], str]]:
        return list(map(self.words.__getitem__, self.cut.findall(SPACE + text.replace(" ", SPACE))))

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@functools.cache
def encoder(model_file: str) -> MergeEncoder:
    return MergeEncoder(model_file)


def encode_documents(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the number of ids with the end id, a digest of the ids and one of the decoded text.  A null text
    counts as empty: the end id alone.  Repeated rows each give a row; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(model_file)
        for batch in batches:
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, shown = model.encode_shown(value or "")
                rows.append((doc, len(ids), hashlib.sha256(shown.encode()).hexdigest(),
                             hashlib.sha256(model.decode(ids).encode()).hexdigest()))
            if rows:
                doc, n, ids, decoded = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(ids),
                                                  pa.array(decoded)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(docs[key].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, SCHEMA)
