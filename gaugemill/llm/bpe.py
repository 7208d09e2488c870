"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding by retained offsets.

The pre-tokeniser is a finite automaton over character kinds. Every kind acts on the automaton's
states as a function; functions compose associatively, so a scan over a whole batch of texts
gives the state before each character, and from it the pieces, without a regular expression.

``coded`` encodes and decodes in one Arrow step, so that a task has one Python worker. What the worker
holds is bounded: texts are scanned ``CHARS`` characters at a time, pieces are cut ``PIECES`` at a time,
and its cache is measured in bytes.

Edge cases: a null or empty text has no ids; a text that is one very long piece is merged with a
heap, in n log n; an empty table stays empty; null identifiers and repeated rows are carried through; columns that are not
named are kept as they are; columns that have a result's name are replaced.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import adding

# Kinds of character. An apostrophe counts as SHORT or LONG where a contraction of one or two
# letters follows it; white space counts as GLUE (a single space that the next piece takes),
# LAST (other white space just before a piece) or SPACE.
LETTER, NUMBER, OTHER, SHORT, LONG, SPACE, GLUE, LAST = range(8)
KINDS = 8
# States: which piece is open before a character.
NONE, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_SPACE, GLUED, TWO_LEFT, ONE_LEFT = range(8)
STATES = 8

#: Letters after an apostrophe that make a contraction.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: The code points with Unicode's property White_Space.
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)

#: Pieces of up to so many bytes are merged by rescanning, longer ones with a heap.
SHORT_PIECE = 48
#: A worker keeps two generations of pieces of about this many bytes.
CACHE_BYTES = 64 << 20
#: Bytes that a kept piece takes besides its characters and ids.
ENTRY_BYTES = 200
#: Texts are scanned together up to so many characters; a longer one alone, by segments of so many.
CHARS = 1 << 20
#: Pieces of a text that exist as strings at a time, and tokens decoded at a time.
PIECES, TOKENS = 1 << 16, 1 << 18


@lru_cache(1)
def code_point_kinds() -> np.ndarray:
    """LETTER, NUMBER, OTHER or SPACE for each code point."""
    major = {"L": LETTER, "N": NUMBER}
    kinds = np.fromiter((major.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    kinds[list(WHITE_SPACE)] = SPACE
    return kinds


def step(state: int, kind: int) -> tuple[int, bool]:
    """The automaton: the state after a character, and whether a piece begins at it."""
    if state == TWO_LEFT:
        return ONE_LEFT, False
    if state == ONE_LEFT:
        return NONE, False
    if kind in (SHORT, LONG) and state not in (IN_OTHER, GLUED):
        return (ONE_LEFT if kind == SHORT else TWO_LEFT), True
    if kind in (LETTER, NUMBER):
        after = IN_LETTERS if kind == LETTER else IN_NUMBERS
        return after, state not in (after, GLUED)
    if kind in (OTHER, SHORT, LONG):
        return IN_OTHER, state not in (IN_OTHER, GLUED)
    if kind == SPACE:
        return IN_SPACE, state != IN_SPACE
    return (GLUED if kind == GLUE else NONE), True


@lru_cache(1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """The functions that sequences of kinds can make of the states, closed under composition.

    Returns: function of each kind (the second half: of a kind at the start of a text), the table
    of compositions (first, then second), the table of each function's values, the table of
    starts by state and kind, the identity.
    """
    single = [tuple(step(s, k)[0] for s in range(STATES)) for k in range(KINDS)]
    first = [(step(NONE, k)[0],) * STATES for k in range(KINDS)]
    number = {tuple(range(STATES)): 0}
    queue = [tuple(range(STATES))]
    while queue:
        f = queue.pop()
        for g in single + first:
            h = tuple(g[s] for s in f)
            if h not in number:
                number[h] = len(number)
                queue.append(h)
    functions = np.array(list(number), np.uint8)
    m = len(functions)
    composed = np.empty((m, m), np.uint16)
    for i, f in enumerate(number):
        for j, g in enumerate(number):
            composed[i, j] = number[tuple(g[s] for s in f)]
    starts = np.array([[step(s, k)[1] for k in range(KINDS)] for s in range(STATES)])
    return np.array([number[f] for f in single + first], np.uint16), composed, functions, starts, 0


def kinds_of(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The kind of every code point of texts laid end to end; ``ends`` are the texts' ends."""
    kinds = code_point_kinds()[points]
    n = len(points)
    follows = np.zeros(n, bool)  # a character of the same text that isn't white space follows
    follows[:-1] = kinds[1:] != SPACE
    follows[ends - 1] = False
    white = kinds == SPACE
    kinds[white & follows] = LAST
    kinds[white & follows & (points == 32)] = GLUE
    marks = np.flatnonzero(points == 39)
    if len(marks):
        text_end = ends[np.searchsorted(ends, marks, "right")]
        padded = np.append(points, [0, 0])
        one = np.where(marks + 1 < text_end, padded[marks + 1], 0)
        two = np.where(marks + 2 < text_end, padded[marks + 2], 0)
        for word in CONTRACTIONS:
            hit = one == ord(word[0])
            if len(word) == 2:
                hit &= two == ord(word[1])
            kinds[marks[hit]] = SHORT if len(word) == 1 else LONG
    return kinds


def piece_starts(points: np.ndarray, ends: np.ndarray, width: int = 512) -> np.ndarray:
    """Where pieces begin, by a blocked associative scan of transition functions.

    The code points are dealt into lanes of ``width``; all lanes advance together, then the
    lanes' totals are scanned by doubling, and each lane's prefix is applied to its entry state.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    of_kind, _, _, starts, _ = monoid()
    kinds = kinds_of(points, ends)
    begins = np.concatenate([[0], ends[:-1]])
    begin, state = np.empty(n, bool), NONE
    for a in range(0, n, CHARS):
        b = min(a + CHARS, n)
        acts = of_kind[kinds[a:b]]
        own = begins[np.searchsorted(begins, a) : np.searchsorted(begins, b)] - a
        acts[own] = of_kind[KINDS + kinds[a:b][own]]
        states, state = scanned(acts, state, width)
        begin[a:b] = starts[states, kinds[a:b]]
    begin[begins] = True
    return np.flatnonzero(begin)


def scanned(acts: np.ndarray, state: int, width: int) -> tuple[np.ndarray, int]:
    """The state before each function of a sequence that ``state`` enters, and the state after it."""
    _, composed, values, _, identity = monoid()
    n = len(acts)
    lanes = -(-n // width)
    grid = np.full(lanes * width, identity, np.intp)
    grid[:n] = acts
    grid = np.ascontiguousarray(grid.reshape(lanes, width).T)
    m = len(composed)
    rows = composed.ravel().astype(np.intp) * m  # a function by the place of its row
    before = np.empty(grid.shape, np.int32)  # what the lane's earlier characters do
    run = np.full(lanes, identity * m, np.intp)
    for j in range(width):
        before[j] = run
        np.take(rows, run + grid[j], out=run, mode="clip")
    total, shift = run // m, 1
    while shift < lanes:
        total = np.concatenate([total[:shift], composed[total[:-shift], total[shift:]]])
        shift *= 2
    reached = values[total, state]
    entry = np.concatenate([[state], reached[:-1]])
    return values[before // m, entry].T.ravel()[:n], int(reached[-1])


def together(texts: list[str]) -> Iterator[list[str]]:
    """The texts in runs of up to CHARS characters, a longer text alone."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > CHARS:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def pieces(texts: list[str]) -> Iterator[tuple[Iterator[list[str]], np.ndarray]]:
    """For each text its pieces, as lists of up to PIECES, and the byte offset in the text at which each one ends."""
    for run in together(texts):
        whole = "".join(run)
        lengths = np.fromiter(map(len, run), np.int64, len(run))
        full = lengths > 0
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(lengths)
        at = np.append(piece_starts(points, ends[full]), len(whole))
        cut = np.searchsorted(at, np.concatenate([[0], ends])).tolist()
        width = np.ones(len(points), np.uint8)
        for more in (0x7F, 0x7FF, 0xFFFF):
            width += points > more
        upto = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[at]
        del points, width
        for i in range(len(run)):
            own = slice(cut[i], cut[i + 1] + 1)
            yield (cut_up(whole, at[own]), upto[own][1:] - upto[own][0]) if full[i] else (iter(()), np.zeros(0, np.int64))


def cut_up(whole: str, at: np.ndarray) -> Iterator[list[str]]:
    for i in range(0, len(at) - 1, PIECES):
        own = at[i : i + PIECES + 1].tolist()
        yield [whole[a:b] for a, b in zip(own, own[1:])]


class Ranks:
    """A vocabulary of ranks, its pair merging with a cache, and decoding."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        size = max(self.rank.values()) + 1
        words = [b""] * size
        for word, i in self.rank.items():
            words[i] = word
        self.lengths = np.fromiter(map(len, words), np.int64, size)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(words), np.uint8)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0  # bytes of the young generation

    def merge(self, piece: bytes) -> list[bytes]:
        """The tokens of a piece: the pair of lowest rank is merged first, the leftmost of equals."""
        rank = self.rank
        if piece in rank:
            return [piece]
        if len(piece) > SHORT_PIECE:
            return self.merge_long(piece)
        n, none = len(piece), len(self.lengths)
        parts = [piece[i : i + 1] for i in range(n)]
        pairs = [rank.get(piece[i : i + 2], none) for i in range(n - 1)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank.get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank.get(parts[i - 1] + parts[i], none)
        return parts

    def merge_long(self, piece: bytes) -> list[bytes]:
        """As merge, with a heap of pairs and links between the parts: n log n."""
        rank, n = self.rank, len(piece)
        end = list(range(1, n + 1))  # of the part that begins there; 0: it was merged away
        left = list(range(-1, n - 1))
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, middle, last = heapq.heappop(heap)
            if end[i] != middle or end[middle] != last:
                continue
            end[i], end[middle] = last, 0
            if last < n:
                left[last] = i
                if (r := rank.get(piece[i : end[last]])) is not None:
                    heapq.heappush(heap, (r, i, last, end[last]))
            if (j := left[i]) >= 0 and (r := rank.get(piece[j:last])) is not None:
                heapq.heappush(heap, (r, j, i, last))
        parts, i = [], 0
        while i < n:
            parts.append(piece[i : end[i]])
            i = end[i]
        return parts

    def encoded(self, piece: str) -> bytes:
        """Two little-endian unsigned 32-bit integers for each token of the piece, from the cache if there: its
        id, and how many bytes of the piece follow it."""
        ids = self.old.get(piece)
        if ids is None:
            raw, rank, both = piece.encode(), self.rank, []
            after = len(raw)
            for token in self.merge(raw):
                after -= len(token)
                both += (rank[token], after)
            ids = array("I", both).tobytes()
        if self.held >= CACHE_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        if len(piece) <= 256:
            self.young[piece] = ids
            self.held += ENTRY_BYTES + len(piece) + len(ids)
        return ids

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as bytes."""
        for ids, _ in self.placed(texts):
            yield ids.tobytes()

    def placed(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of each text, and the byte offset at which each token ends: where the scan ended the token's
        piece, less what merging left behind it in the piece."""
        for lists, upto in pieces(texts):
            both = np.frombuffer(b"".join(self.joined(own) for own in lists), "<u4").reshape(-1, 2)
            after = both[:, 1].astype(np.int64)
            last = after == 0  # of its piece
            if np.count_nonzero(last) != len(upto):
                raise ValueError("tokens and pieces don't agree")
            piece = np.cumsum(last) - last
            yield np.ascontiguousarray(both[:, 0]), upto[piece] - after

    def joined(self, own: list[str]) -> bytes:
        got = list(map(self.young.get, own))
        if None in got:
            got = [self.young.get(p) or self.encoded(p) if g is None else g for p, g in zip(own, got)]
        return b"".join(got)

    def token_ends(self, ids: np.ndarray) -> np.ndarray:
        """The byte offset at which each token ends, by the vocabulary alone."""
        return np.cumsum(self.lengths[ids])

    def decode(self, ids: np.ndarray, ends: np.ndarray | None = None) -> bytes:
        """The bytes of the ids; ids outside the vocabulary are refused.

        ``ends`` are the offsets kept from encoding, by places in the text, which say where each token's bytes
        go; offsets that don't agree with the vocabulary are refused. Without them the lengths come from it.
        """
        if ends is None:
            ends = self.token_ends(ids)
        out = np.empty(ends[-1] if len(ends) else 0, np.uint8)
        if len(ends) != len(ids):
            raise ValueError("offsets and ids differ in number")
        for i in range(0, len(ids), TOKENS):
            own, upto = ids[i : i + TOKENS], ends[i : i + TOKENS]
            first = int(ends[i - 1]) if i else 0
            begin = np.concatenate([[first], upto[:-1]])
            lengths = upto - begin
            if not np.array_equal(lengths, self.lengths[own]):
                raise ValueError("an offset doesn't fit its token")
            source = np.repeat(self.offsets[own] - begin, lengths)
            source += np.arange(first, upto[-1])
            out[first : upto[-1]] = self.bytes[source]
        return out.tobytes()


@lru_cache(2)
def ranks(path: str) -> Ranks:
    return Ranks(path)


def coded(df: DataFrame, path: str, text: str = "text", keep_text: bool = False, ids: str = "ids", ends: str | None = None, decoded: str | None = None, same: str | None = None) -> DataFrame:
    """Adds ``ids`` and whatever else is named: ``ends``, ``decoded`` and ``same``, in one step.

    ``ids`` is binary (little-endian unsigned 32-bit); ``ends`` (binary: little-endian signed 64-bit)
    holds the byte offset of each token's end in the UTF-8 text, so that a span of tokens is found
    in the text without decoding; ``decoded`` has the bytes that ids and offsets stand for, and
    ``same`` tells whether these are the text's. The text itself goes unless ``keep_text``.
    ``path`` is a vocabulary of ranks that every executor has.
    """
    fields = {ids: T.BinaryType()} | {n: k for n, k in ((ends, T.BinaryType()), (decoded, T.BinaryType()), (same, T.BooleanType())) if n}

    def make():
        vocabulary = ranks(path)

        def row(text: str, tokens: np.ndarray, offsets: np.ndarray) -> Iterator:
            back = vocabulary.decode(tokens, offsets) if decoded or same else b""
            yield tokens.tobytes()
            if ends:
                yield offsets.astype("<i8").tobytes()
            if decoded:
                yield back
            if same:
                yield back == text.encode()

        def use(texts):
            texts = [x or "" for x in texts]
            if len(fields) == 1:
                return [list(vocabulary.encode(texts))]
            return list(zip(*(row(t, *found) for t, found in zip(texts, vocabulary.placed(texts))))) or [[] for _ in fields]

        return use

    return adding(df, [text], fields, make, () if keep_text else (text,))


def encode(df: DataFrame, path: str, text: str = "text", keep_text: bool = False, offsets: bool = True, ids: str = "ids", ends: str = "token_ends") -> DataFrame:
    """Adds ``ids`` and, if asked, ``token_ends``; see ``coded``."""
    return coded(df, path, text, keep_text, ids, ends if offsets else None)


def decode(df: DataFrame, path: str, ids: str = "ids", ends: str | None = None, to: str = "decoded") -> DataFrame:
    """Adds ``decoded`` (binary), the bytes of ids that were kept, by their offsets if ``ends`` names them.

    No ids give no bytes.
    """

    def make():
        vocabulary = ranks(path)

        def use(rows, offsets=None):
            return [[vocabulary.decode(np.frombuffer(x or b"", "<u4"), None if e is None else np.frombuffer(e, "<i8")) for x, e in zip(rows, offsets or [None] * len(rows))]]

        return use

    return adding(df, [ids, ends] if ends else [ids], {to: T.BinaryType()}, make)
