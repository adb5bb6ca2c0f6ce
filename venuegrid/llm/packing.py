"""Bounded-space online packing of tokenised documents into training windows.

Every partition keeps a fixed number of open windows. A document first fills whole windows of its own; its rest
goes into the open window with the least sufficient room. When none has room and no window may be opened, the
fullest is topped up from the rest and emitted. The windows still open at the end of a partition are leftovers:
those of MERGED partitions are joined in one small task, whose last partial window is cut into powers of two.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuegrid.llm.common import Numbers, Ragged, keep, text_batches, words_of

#: Open windows in a partition.
OPEN = 32
#: Partitions whose leftovers are merged together; a merging task holds at most MERGED * OPEN windows.
MERGED = 16
#: Distinct words whose ids a task remembers before it starts anew.
VOCABULARY = 1_000_000
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


class WordTokens:
    """Token ids of texts through a table of ids by word.

    The tokenizer must treat white-space-separated words independently, as one does that drops white space
    before it splits; then a text's ids are its words' ids in turn. New words are encoded TOGETHER at a time. With
    ``fold`` it must also lower-case, split letters and digits from other characters, and end the last piece of
    each run of letters in WORD_END: then words share the ids of their lower-cased core and of the punctuation
    after it, and cores of letters alone are encoded as one running text, whose words WORD_END tells apart.
    """

    TOGETHER = 2000
    PUNCTUATION = b".,;:!?#$%&*|"
    WORD_END = "</w>"

    def __init__(self, path: str, fold: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.fold = Tokenizer.from_file(path), fold
        if fold:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            for piece, i in self.tokenizer.get_vocab().items():
                self.ends[i] = piece.endswith(self.WORD_END)
        self.forget()

    def forget(self) -> None:
        self.numbers, self.words = Numbers(), Ragged()
        self.cores, self.parts = Numbers(), Ragged()

    def _split(self, word: bytes) -> tuple[bytes, bytes]:
        core = word.rstrip(self.PUNCTUATION)
        if len(core) == len(word) or b"<|" in word:
            return word, b""
        last = core[-2:]  # an ASCII letter or digit, or a Latin letter of two bytes that stays a letter in lower case
        if last[-1:].isalnum() or (b"\xc3\x80" <= last < b"\xc9\x80" and last not in (b"\xc3\x97", b"\xc3\xb7", b"\xc4\xb0")):
            return core, word[len(core) :]
        return word, b""

    def _plain(self, core: str) -> bool:
        """Whether a core is one run of Latin letters, also when lower-cased."""
        return core.isalpha() and (core.isascii() or (max(core) < "\u0250" and "\u0130" not in core))

    def _encode(self, words: list[str]) -> None:
        """The ids of words, in their order."""
        plain = np.array([self.fold and self._plain(w) for w in words], bool)
        counts, flat = np.zeros(len(words), np.int64), [np.zeros(0, np.uint32), np.zeros(0, np.uint32)]
        if plain.any():
            (found,) = self.tokenizer.encode_batch_fast([" ".join(w for w, p in zip(words, plain, strict=True) if p)], add_special_tokens=False)
            flat[1] = np.array(found.ids, np.uint32)
            counts[plain] = np.diff(np.flatnonzero(self.ends[flat[1]]), prepend=-1)
        if not plain.all():
            found = self.tokenizer.encode([w for w, p in zip(words, plain, strict=True) if not p], is_pretokenized=True, add_special_tokens=False)
            flat[0] = np.array(found.ids, np.uint32)
            counts[~plain] = np.bincount(np.array(found.word_ids, np.int64), minlength=int((~plain).sum()))
        out, of = np.zeros(int(counts.sum()), np.uint32), np.repeat(plain, counts)
        out[~of], out[of] = flat
        self.parts.add(out, counts)

    def _learn(self) -> None:
        names = self.numbers.names[len(self.words) :]
        split = map(self._split, names) if self.fold else ((w, b"") for w in names)
        both = np.array([(self.cores[a], self.cores[b]) for a, b in split], np.int64).ravel()
        new = [w.decode() for w in self.cores.names[len(self.parts) :]]
        for at in range(0, len(new), self.TOGETHER):
            self._encode(new[at : at + self.TOGETHER])
        if len(both):
            self.words.add(*self.parts.gather(both, 2))

    def ids(self, texts: list[bytes | None], end: int) -> Iterator[np.ndarray]:
        """The ids of each text, with ``end`` after the last."""
        if len(self.numbers) > VOCABULARY:
            self.forget()
        numbers = self.numbers
        low = (t.lower() if self.fold and t and b"<|" not in t else t for t in texts)  # special tokens keep their case
        each = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in map(words_of, low)]
        self._learn()
        for at in each:
            out, _ = self.words.gather(at)
            yield np.append(out, np.uint32(end))


class Windows:
    """Open windows by room left; ``emit`` gets the pieces of each window that closes."""

    def __init__(self, length: int, most: int, emit) -> None:
        self.length, self.most, self.emit = length, most, emit
        self.rooms: list[tuple[int, int]] = []
        self.held: dict[int, list] = {}
        self.next = 0

    def add(self, doc, ids: np.ndarray) -> None:
        n, start = len(ids), 0
        while n - start >= self.length:
            self.emit([(doc, start, ids[start : start + self.length], n)])
            start += self.length
        while start < n:
            rest = n - start
            k = bisect_left(self.rooms, (rest, -1))
            if k < len(self.rooms):
                room, name = self.rooms.pop(k)
            elif len(self.rooms) < self.most:
                room, name, self.next = self.length, self.next, self.next + 1
                self.held[name] = []
            else:
                room, name = self.rooms.pop(0)  # the fullest; too small for the rest, so it takes a part and goes
            take = min(room, rest)
            self.held[name].append((doc, start, ids[start : start + take], n))
            start += take
            if take == room:
                self.emit(self.held.pop(name))
            else:
                insort(self.rooms, (room - take, name))


def _rows(pieces: list, sequence: int | None, ids: bool) -> list[tuple]:
    rows, offset = [], 0
    for (doc, _), start, tokens, total in pieces:
        raw = tokens.astype("<u4").tobytes()
        rows.append((doc, start, len(tokens), zlib.crc32(raw), total, sequence, offset if sequence is not None else None, raw if ids else None))
        offset += len(tokens)
    return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])


def _online(path: str, fold: bool, end: int, length: int, most: int, ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, rows, tokens = TaskContext.get().partitionId(), 0, [], WordTokens(path, fold)

        def emit(pieces: list) -> None:
            nonlocal count
            rows.extend(_rows(pieces, (part << 32) + count, ids))
            count += 1

        windows = Windows(length, most, emit)
        for batch, texts in text_batches(batches):
            for doc, found in zip(batch.column("doc_id").to_pylist(), tokens.ids(texts, end), strict=True):
                windows.add((doc, part), found)
            yield _batch(rows)
            rows.clear()
        for name, pieces in windows.held.items():
            yield _batch([(*r[:5], -1 - part, name, r[7]) for r in _rows(pieces, None, True)])

    return run


def _merge(length: int, ids: bool):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out, count = [], 0

        def emit(pieces: list) -> None:
            nonlocal count
            out.extend(_rows(pieces, (1 << 62) + (int(key[0]) << 32) + count, ids))
            count += 1

        rows = rows.sort_values(["sequence_id", "offset", "doc_id", "start"])
        window, room = [], length
        for doc, start, total, raw in zip(rows["doc_id"], rows["start"], rows["doc_tokens"], rows["ids"], strict=True):
            tokens, at = np.frombuffer(raw, "<u4"), 0
            while at < len(tokens):
                take = min(room, len(tokens) - at)
                window.append(((None if pd.isna(doc) else int(doc), 0), int(start) + at, tokens[at : at + take], int(total)))
                at, room = at + take, room - take
                if not room:
                    emit(window)
                    window, room = [], length
        left = length - room
        while left:  # the largest power of two first
            size, part = 1 << (left.bit_length() - 1), []
            left -= size
            while size:
                doc, start, tokens, total = window.pop(0)
                if len(tokens) > size:
                    window.insert(0, (doc, start + size, tokens[size:], total))
                    tokens = tokens[:size]
                part.append((doc, start, tokens, total))
                size -= len(tokens)
            emit(part)
        return _batch(out).to_pandas(integer_object_nulls=True)

    return run


def pack(docs: DataFrame, tokenizer: str, end: int = 2, length: int = 4096, open_windows: int = OPEN, ids: bool = False, fold: bool = False) -> DataFrame:
    """Pack every row's tokens, then ``end``, into sequences of at most ``length`` (a power of two) tokens.

    Reads ``doc_id`` and ``text``; null text counts as empty and packs as the end token alone; repeated rows and
    repeated or null ids are packed row by row; other columns are not read; an empty table gives an empty result.
    Returns per piece doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, with ``ids``, the
    token ids as little-endian unsigned 32-bit numbers (else null). Every sequence is full, or has a power of two
    of tokens, so none needs padding. For ``fold`` see WordTokens.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    packed = keep(rows.mapInArrow(_online(tokenizer, fold, end, length, open_windows, ids), PIECE), "packed")
    group = F.floor((-1 - F.col("sequence_id")) / MERGED).cast("long")
    merged = packed.where("sequence_id < 0").groupBy(group.alias("group")).applyInPandas(_merge(length, ids), PIECE)
    return packed.where("sequence_id >= 0").unionByName(merged)
