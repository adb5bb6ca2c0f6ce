"""SentencePiece encoding and decoding by a shared-prefix Viterbi pass.

A text becomes marked words: spaces turn into the mark, which starts a word. Words are cut further where no piece
of the vocabulary joins two neighbouring characters. Each task sorts its new distinct words, so that walking them
in order is a depth-first traversal of their trie, and runs a forward pass that keeps its states on a stack: words
with a common prefix share the states of that prefix.

The state at a position is the best score of any segmentation up to it, and where its last piece starts. For a
unigram vocabulary a piece adds its score. For a BPE vocabulary it does so only where merging leaves it apart from
the piece before it, and is out of the question elsewhere: the encoding of a prefix is the encoding up to some
earlier position and one more piece, so exactly one segmentation has a finite score, and it is what the merge order
prescribes. Words with several leading marks, whose merges have tied scores, are merged directly.
"""

from __future__ import annotations

import re
import zlib
from heapq import heapify, heappop, heappush
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuegrid.llm.common import Numbers, Ragged, text_batches

MARK = "▁"
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Distinct words whose ids a task remembers before it starts anew.
VOCABULARY = 700_000
FAR = -1e18
#: Characters that often end a word; cut off where no piece joins them to the character before.
TAIL = ".,;:!?#$%&*|"


class Vocabulary:
    """Pieces with scores; characters without a piece fall back to the pieces of their bytes, or to ``unknown``."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: dict[int, int], unknown: int = 0, kind: str = "bpe") -> None:
        self.pieces, self.byte_ids, self.unknown, self.kind = pieces, byte_ids, unknown, kind
        self.joined = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        ending: dict[str, set[int]] = {}
        for p in pieces:
            if len(p) > 2:
                ending.setdefault(p[-3:], {2} if p[-2:] in pieces else set()).add(len(p))
        #: by their last three characters, the lengths over one that pieces may have, longest first
        self.ending = {end: sorted(n, reverse=True) for end, n in ending.items()}
        self.line_end_alone = not any("\n" in pair for pair in self.joined)
        self.text = {i: p for p, (i, _) in pieces.items()}
        self.of_byte = {i: b for b, i in byte_ids.items()}
        self.apart: dict[tuple[str, str], bool] = {}

    @classmethod
    def load(cls, path: str, kind: str = "bpe") -> Vocabulary:
        import sentencepiece

        s = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(s.get_piece_size())
        plain = {s.id_to_piece(i): (i, s.get_score(i)) for i in every if not (s.is_control(i) or s.is_unknown(i) or s.is_unused(i) or s.is_byte(i))}
        return cls(plain, {int(s.id_to_piece(i)[3:5], 16): i for i in every if s.is_byte(i)}, s.unk_id(), kind)

    # -- encoding

    def merge(self, word: str) -> list[str]:
        """Merge the best-scored neighbouring pieces, leftmost first among equals, until none can be."""
        parts: list[str] = list(word)
        before, after = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        pieces = self.pieces
        queue = [(-found[1], i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if (found := pieces.get(a + b))]
        heapify(queue)
        while queue:
            _, i, a, b = heappop(queue)
            j = after[i]
            if parts[i] != a or j >= len(parts) or parts[j] != b:
                continue  # one of the two has merged since
            parts[i], parts[j] = a + b, ""
            after[i] = k = after[j]
            if k < len(parts):
                before[k] = i
                if found := pieces.get(parts[i] + parts[k]):
                    heappush(queue, (-found[1], i, parts[i], parts[k]))
            if (h := before[i]) >= 0 and (found := pieces.get(parts[h] + parts[i])):
                heappush(queue, (-found[1], h, parts[h], parts[i]))
        return [p for p in parts if p]

    def _stay_apart(self, a: str, b: str) -> bool:
        known = self.apart.get((a, b))
        if known is None:
            if len(self.apart) > VOCABULARY:
                self.apart.clear()
            known = self.apart[a, b] = self.merge(a + b) == ([a, b] if a else [b])
        return known

    def _lengths(self, word: str, end: int) -> list[int] | range:
        """Lengths over one, longest first, that a piece which ends at ``end`` may have."""
        if end < 3:
            return range(end, 1, -1)
        return self.ending.get(word[end - 3 : end]) or ([2] if word[end - 2 : end] in self.pieces else [])

    def segment(self, words: list[str]) -> Iterator[tuple[str, list[str]]]:
        """(word, pieces) of distinct words, in their order in the trie."""
        get, apart, lengths, bpe = self.pieces.get, self.apart.get, self._lengths, self.kind == "bpe"
        # by position of the word at hand: where the last piece starts, that piece, and the best score
        before, start, last, score = "", [0], [""], [0.0]
        for word in sorted(words):
            if bpe and word.startswith(MARK + MARK):
                yield word, self.merge(word)
                continue
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del start[shared + 1 :], last[shared + 1 :], score[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                alone = get(word[end - 1])
                at, best = end - 1, score[end - 1] + (alone[1] if alone is not None else -1e6)
                for n in lengths(word, end):
                    if n > end or (found := get(word[end - n : end])) is None:
                        continue
                    begin = end - n
                    if bpe:
                        pair = last[begin], word[begin:end]
                        kept = apart(pair)
                        if self._stay_apart(*pair) if kept is None else kept:
                            at, best = begin, score[begin] + found[1]
                            break  # the only segmentation that merging leaves
                    elif score[begin] + found[1] > best:
                        at, best = begin, score[begin] + found[1]
                start.append(at)
                last.append(word[at:end])
                score.append(best)
            before, out, end = word, [], len(word)
            while end:
                out.append(last[end])
                end = start[end]
            yield word, out[::-1]

    def ids(self, parts: list[str]) -> list[int]:
        out = []
        for part in parts:
            found = self.pieces.get(part)
            if found is not None:
                out.append(found[0])
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in part.encode())
            else:
                out.append(self.unknown)
        return out

    # -- decoding

    def spelled(self, ids: list[int]) -> str:
        """What ids spell, marks included; runs of byte pieces become their characters, wrong ones U+FFFD."""
        try:
            return "".join([self.text[i] for i in ids])
        except KeyError:  # a byte, or the unknown piece
            pass
        out, held = [], bytearray()
        for i in ids:
            if i in self.of_byte:
                held.append(self.of_byte[i])
                continue
            if held:
                out.append(held.decode(errors="replace"))
                held.clear()
            out.append(self.text.get(i, " ⁇ "))
        out.append(held.decode(errors="replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids."""
        return unmarked(self.spelled(ids))


def unmarked(spelled: str) -> str:
    said = spelled.replace(MARK, " ")
    return said[1:] if said.startswith(" ") else said


def marked_words(text: str) -> list[str]:
    return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []


class Encoder:
    """Piece ids of texts through a table of ids by marked word, which shares the ids of cores and tails of words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.numbers, self.words, self.true = Numbers(), Ragged(), np.zeros(0, bool)
        self.cores, self.parts, self.spelled = Numbers(), Ragged(), np.zeros(0, bool)

    def _units(self, text: bytes) -> list[bytes]:
        """Marked words, line ends apart where no piece has any."""
        mark = MARK.encode()
        if text and not (text[:1] == b" " or b"  " in text or b"\0" in text or mark in text):
            text = mark + text.replace(b" ", b"\0" + mark)
            return (text.replace(b"\n", b"\0\n\0") if self.vocabulary.line_end_alone else text).split(b"\0")
        return [w.encode() for w in marked_words(text.decode())]

    def _split(self, word: str) -> tuple[str, str]:
        core = word.rstrip(TAIL)
        return (core, word[len(core) :]) if core and word[len(core) - 1 : len(core) + 1] not in self.vocabulary.joined else (word, "")

    def _learn(self) -> None:
        split = [self._split(w.decode()) for w in self.numbers.names[len(self.words) :]]
        both = np.array([(self.cores[a], self.cores[b]) for a, b in split], np.int64).ravel()
        new = self.cores.names[len(self.parts) :]
        place = {w: i for i, w in enumerate(new)}
        found: list[list[int]] = [[]] * len(new)
        for word, parts in self.vocabulary.segment(new):
            found[place[word]] = self.vocabulary.ids(parts)
        if new:
            self.parts.add(np.fromiter((i for ids in found for i in ids), np.uint32), np.array([len(ids) for ids in found], np.int64))
            self.spelled = np.concatenate([self.spelled, [self.vocabulary.spelled(ids) == w for ids, w in zip(found, new, strict=True)]])
        if len(both):
            self.words.add(*self.parts.gather(both, 2))
            self.true = np.concatenate([self.true, self.spelled[both].reshape(-1, 2).all(axis=1)])

    def encode(self, texts: list[bytes | None]) -> tuple[list[np.ndarray], list[bool]]:
        """The ids of each text, and whether decoding them gives it back."""
        if len(self.numbers) > VOCABULARY:
            self.forget()
        numbers = self.numbers
        units = [self._units(t or b"") for t in texts]
        each = [np.fromiter(map(numbers.__getitem__, u), np.int64, len(u)) for u in units]
        self._learn()
        ids = [self.words.gather(at)[0].astype("<i4") for at in each]
        # the ids of a text are those of its words, so what they decode to is what the words' ids do; a mark comes back as a space
        return ids, [bool(self.true[at].all()) and MARK.encode() not in (t or b"") for at, t in zip(each, texts, strict=True)]


def _encode(path: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary.load(path, kind))
        for batch, texts in text_batches(batches):
            ids, true = encoder.encode(texts)
            cuts = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(np.diff(cuts).astype(np.int64)), pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                    pa.array(true), pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(ids))),
                ],
                names=["doc_id", "n_pieces", "ids_crc32", "round_trip", "ids"],
            )

    return run


def encode(docs: DataFrame, model: str, kind: str = "bpe") -> DataFrame:
    """One row per row of docs (doc_id, text): n_pieces, ids_crc32 (little-endian 32-bit ids), round_trip, ids.

    ``round_trip`` says whether the ids, decoded, give the text back: the ids of every distinct word are decoded and
    compared with it, and a text comes back if all its words do. It fails for texts that hold the mark itself, and for
    characters that a vocabulary without byte pieces does not know. Null and empty texts have no pieces. Repeated rows each get their row; other columns are not read; an
    empty table gives an empty result. Every task works on its own partition's words; nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_encode(model, kind), "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean, ids array<int>")


def decode(encoded: DataFrame, model: str, kind: str = "bpe") -> DataFrame:
    """(doc_id, text) of rows with ``ids``; null ids give null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.load(model, kind)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([None if i is None else vocabulary.decode(i) for i in part.column("ids").to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
