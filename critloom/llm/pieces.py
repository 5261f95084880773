"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Texts are encoded with an agenda of adjacent symbol pairs: the pair whose joined piece has the highest
score is merged first, the leftmost of equals, until no adjacent pair joins to a piece. Characters
without a piece become their UTF-8 bytes. In every Arrow batch the words that were not met before and
all decoded texts are held against the sentencepiece library."""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_arrow

SPACE = "▁"       # what a model writes for a blank
WORDS_HELD = 800_000   # encoded words a worker remembers; the memory is emptied when full
SHORT = 48             # characters of a word or part that is remembered; longer parts have an agenda of their own
NEVER = float("-inf")

# Numbers of a model file.
NORMAL, UNKNOWN, CONTROL, BYTE, MERGE_MODEL = 1, 2, 3, 6, 2

codecs.register_error("replace_each_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of every field of a protocol buffer message; messages and strings as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            size = varint()
        yield key >> 3, raw[at:at + size]
        at += size


class Vocabulary:
    """A merge-type model: pieces, scores and byte pieces, read from its file's bytes.

    Models that rewrite characters, squeeze blanks, or hold user-defined or unused pieces are
    refused (ValueError), as are unigram, word and character models."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        self.scores: dict[str, float] = {}
        self.prefix, kind, rewrites = True, 1, False
        for number, value in fields(model):
            part = list(fields(value)) if number <= 5 else []
            if number == 1:
                d = dict(part)
                piece, what = d[1].decode(), d.get(3, NORMAL)
                if what == NORMAL:
                    self.scores[piece] = struct.unpack("<f", d.get(2, bytes(4)))[0]
                elif what not in (UNKNOWN, CONTROL, BYTE):
                    raise ValueError(f"piece {piece!r} is user-defined or unused")
                self.pieces.append(piece)
                self.kinds.append(what)
            elif number == 2:
                kind = dict(part).get(3, 1)
            elif number == 3:
                d = dict(part)
                self.prefix = bool(d.get(3, 1))
                rewrites = bool(d.get(2)) or bool(d.get(4, 1)) or not d.get(5, 1)
            elif number == 5:
                rewrites = rewrites or bool(dict(part).get(2))
        if kind != MERGE_MODEL or rewrites:
            raise ValueError("only merge-type models without normalisation are supported")
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        self.unknown = self.kinds.index(UNKNOWN)
        self.byte_ids = {int(p[1:-1], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        self.bytes = {i: b for b, i in self.byte_ids.items()}
        # Symbols are piece ids; a character without a piece is its code point beyond them.
        self.symbols = np.arange(0x110000, dtype=np.int64) + len(self.pieces)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.symbols[ord(p)] = i
        self.joins, self.joined, self.join_scores = self._joins()
        # Two neighbours that stand together in no piece can never be merged: texts are cut there. Words
        # are cut off first where that holds for every character before a blank.
        self.together = {p[i:i + 2] for p in self.scores for i in range(len(p) - 1)}
        cut = not any(x[0] != SPACE and x[1] == SPACE for x in self.together)
        self.word = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if cut else r"[\s\S]+")
        # Remembered ids are tuples of the same numbers: small, near each other, and no work for the collector.
        self.held: dict[str, tuple[int, ...]] = {}
        self.numbers = list(range(len(self.pieces)))
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.wrong: set[str] = set()  # words that the library encodes otherwise

    def _joins(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys (left symbol, right symbol) of all pairs that join to a piece, the piece and its score."""
        def symbol(s: str) -> int | None:
            return int(self.symbols[ord(s)]) if len(s) == 1 else self.ids.get(s)

        rows = []
        for p, i in self.ids.items():
            for cut in range(1, len(p)):
                left, right = symbol(p[:cut]), symbol(p[cut:])
                if left is not None and right is not None:
                    rows.append((left << 32 | right, i, self.scores[p]))
        rows.sort()
        keys, joined, scores = zip(*rows) if rows else ((), (), ())
        return (np.array([*keys, np.iinfo(np.int64).max], np.int64), np.array([*joined, 0], np.int64),
                np.array([*scores, NEVER], np.float64))

    def pair_scores(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Scores of adjacent pairs; ``NEVER`` for pairs that join to no piece."""
        key = left << 32 | right
        at = np.searchsorted(self.joins, key)
        return np.where(self.joins[at] == key, self.join_scores[at], NEVER)

    def merge_all(self, parts: list[str]) -> list[list[int]]:
        """Ids of many short parts, none empty. The agenda holds the scores of all adjacent pairs of all
        parts; a round merges in every part its best pair, the leftmost of equals."""
        sizes = np.array([len(p) for p in parts])
        sym = self.symbols[np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)]
        part = np.repeat(np.arange(len(parts)), sizes)
        inner = np.append(part[1:] == part[:-1], False)
        agenda = np.full(len(sym), NEVER)
        at = np.flatnonzero(inner)
        agenda[at] = self.pair_scores(sym[at], sym[at + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            lengths = np.diff(np.append(starts, len(part)))
            best = np.maximum.reduceat(agenda, starts)
            live = np.repeat(best > NEVER, lengths)
            done.append((part[~live], sym[~live]))
            top = np.flatnonzero(live & (agenda == np.repeat(best, lengths)))
            top = top[np.append(True, part[top][1:] != part[top][:-1])] if len(top) else top  # leftmost
            left = sym[top]
            sym[top] = self.joined[np.searchsorted(self.joins, left << 32 | sym[top + 1])]
            live[top + 1] = False
            place = np.cumsum(live) - 1  # where a symbol that stays goes
            top, part, sym, agenda = place[top], part[live], sym[live], agenda[live]
            ends = np.append(part[1:] != part[:-1], True) if len(part) else np.zeros(0, bool)
            for at in (top[~ends[top]], top[(top > 0) & (part[top - 1] == part[top])] - 1):
                agenda[at] = self.pair_scores(sym[at], sym[at + 1])
            agenda[top[ends[top]]] = NEVER
        part, sym = np.concatenate([x for x, _ in done]), np.concatenate([x for _, x in done])
        order = np.argsort(part, kind="stable")
        flat, known = sym[order].tolist(), len(self.pieces)
        bounds = np.append(0, np.cumsum(np.bincount(part, minlength=len(parts)))).tolist()
        out = [flat[i:j] for i, j in zip(bounds, bounds[1:])]
        for k in np.unique(part[sym >= known]).tolist():
            out[k] = [i for s in out[k] for i in ([s] if s < known else self.char_ids(chr(s - known)))]
        return out

    def char_ids(self, char: str) -> list[int]:
        """Ids of a character without a piece: its bytes, or the unknown piece."""
        return [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unknown]

    def merge(self, text: str) -> list[str]:
        """The symbols of a text of any length when no adjacent pair joins to a piece. The agenda is a heap,
        and the symbols are linked to their neighbours."""
        symbols: list[str | None] = list(text)
        n, scores = len(symbols), self.scores
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            score = scores.get(text[i:i + 2])
            if score is not None:
                agenda.append((-score, i, i + 1, 2))
        heapify(agenda)

        def add(left: int, right: int) -> None:
            joined = symbols[left] + symbols[right]
            score = scores.get(joined)
            if score is not None:
                heappush(agenda, (-score, left, right, len(joined)))

        while agenda:
            _, left, right, size = heappop(agenda)
            a, b = symbols[left], symbols[right]
            if a is None or b is None or len(a) + len(b) != size:
                continue  # one side was merged away since
            symbols[left], symbols[right] = a + b, None
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
                add(left, after[left])
            if before[left] >= 0:
                add(before[left], left)
        return [s for s in symbols if s is not None]

    def cut(self, word: str) -> list[str]:
        """The word in parts, cut where two neighbours are never merged."""
        ends = [i for i in range(1, len(word)) if word[i - 1:i + 1] not in self.together]
        return [word[i:j] for i, j in zip([0, *ends], [*ends, len(word)])]

    def long_ids(self, part: str) -> list[int]:
        ids: list[int] = []
        for s in self.merge(part):
            known = self.ids.get(s)
            ids.extend([known] if known is not None else self.char_ids(s))
        return ids

    def shared(self, ids: Iterable[int]) -> tuple[int, ...]:
        return tuple(map(self.numbers.__getitem__, ids))

    def learn(self, words: set[str]) -> dict[str, tuple[int, ...]]:
        """Remembers the ids of short words; returns those of long ones, whose parts share one agenda if short."""
        short = [w for w in words if len(w) <= SHORT]
        self.held.update(zip(short, map(self.shared, self.merge_all(short) if short else [])))
        cuts = {w: self.cut(w) for w in words if len(w) > SHORT}
        parts = {p for cut in cuts.values() for p in cut}
        ids = {p: self.long_ids(p) for p in parts if len(p) > SHORT}
        short = [p for p in parts if len(p) <= SHORT]
        ids.update(zip(short, self.merge_all(short) if short else []))
        found = {w: self.shared(chain.from_iterable([ids[p] for p in cut])) for w, cut in cuts.items()}
        self.check(list(words), found)
        return found

    def check(self, words: list[str], found: dict[str, tuple[int, ...]]) -> None:
        """Holds the ids of words against the library's. No merge crosses the start of a word, so a text's
        ids are those of its words; the blank that a text is given in front is the word's own."""
        lone = (self.library.piece_to_id(SPACE),)  # a blank that ends a text; alone it would be an empty text
        theirs = self.library.encode([w[self.prefix:].replace(SPACE, " ") for w in words], num_threads=1)
        for w, ids in zip(words, theirs):
            if (found[w] if w in found else self.held[w]) != (tuple(ids) if w != SPACE else lone):
                self.wrong.add(w)

    def split(self, texts: list[str]) -> list[list[str]]:
        """The words of every text, blanks in front of them included."""
        mark = SPACE if self.prefix else ""
        return [self.word.findall(mark + x.replace(" ", SPACE)) if x else [] for x in texts]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
        """Ids of every text, without begin or end ids, and whether the library agrees on all its words.
        An empty text has no ids."""
        if len(self.held) >= WORDS_HELD:
            self.held.clear()
        held, split = self.held, self.split(texts)
        new = set(chain.from_iterable(split)) - held.keys()
        found = self.learn(new) if new else {}
        held.update(found)  # for this call only: long words are not remembered
        ids = [list(chain.from_iterable(map(held.__getitem__, words))) for words in split]
        for w in found:
            del held[w]
        return ids, [not self.wrong or self.wrong.isdisjoint(words) for words in split]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; each byte that is no UTF-8 becomes a replacement character."""
        kinds, parts, run = self.kinds, [], bytearray()
        if BYTE not in kinds:
            parts = [self.pieces[i] for i in ids if kinds[i] != CONTROL]
        else:
            for i in ids:
                if kinds[i] == BYTE:
                    run.append(self.bytes[i])
                    continue
                if run:
                    parts.append(run.decode("utf-8", "replace_each_byte"))
                    run.clear()
                if kinds[i] != CONTROL:
                    parts.append(self.pieces[i])
            if run:
                parts.append(run.decode("utf-8", "replace_each_byte"))
        text = "".join(parts)
        if self.prefix and text.startswith(SPACE):
            text = text[1:]
        return text.replace(SPACE, " ")


_OWN: dict[bytes, Vocabulary] = {}


def own_vocabulary(model: bytes) -> Vocabulary:
    """This worker's vocabulary of a model, kept with the words that it remembers from task to task (one model's)."""
    if model not in _OWN:
        _OWN.clear()
        _OWN[model] = Vocabulary(model)
    return _OWN[model]


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
           carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``(<id>, carried, ids array<int>, decoded string, agrees boolean)``.

    ``model`` holds the bytes of a merge-type SentencePiece model. ``agrees`` says that the library
    gives the same ids for all words of the text and decodes all ids to the same text. Null texts are
    read as empty: no ids, an empty decoded text. Repeated rows and null ids are encoded as they come;
    an empty table gives no rows; only the named columns are read, so others may have any name. A text
    is encoded whole, in one task."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a vocabulary file: some hundred KB

    def run(batches):
        own = own_vocabulary(sent.value)
        for b in batches:
            texts = [x or "" for x in b.column(0).to_pylist()]
            for i, j in chunks(texts):
                ids, agrees = own.encode(texts[i:j])
                back = [own.decode(x) for x in ids]
                theirs = own.library.decode(ids, num_threads=1)
                agrees = [a and x == y for a, x, y in zip(agrees, back, theirs)]
                held = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*held.columns[1:], pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.string()), pa.array(agrees, pa.bool_())],
                    [*b.schema.names[1:], "ids", "decoded", "agrees"])

    names = (id_col, *carried)
    picked = docs.select(F.col(text_col).alias("_t"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(names)])
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in picked.schema.fields[1:])
    done = map_arrow(picked, run, kinds + "ids array<int>, decoded string, agrees boolean")
    return done.toDF(*names, "ids", "decoded", "agrees")
