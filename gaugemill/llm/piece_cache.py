"""Encoding with the tokenizers library, each distinct piece of text once a worker.

The byte-level model splits a text by a pattern before it merges anything, and a space before a
character that isn't white space always begins a new part of that pattern. Cutting there leaves
the ids as they are, so the library sees each distinct piece once, many of them laid end to end
with such spaces between, and the ids of a text are those of its pieces in order. A piece that ends
in punctuation is made of the ids of the rest and of that punctuation, which the pattern cuts too.

The library finds the strings of added tokens (such as an end-of-text mark) before it applies the
pattern, so a text that holds one goes to it whole. With ``plain`` such strings are ordinary text.
Edge cases: an empty text has no ids; a very long piece is encoded and not kept.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache
from itertools import chain, compress, repeat
from operator import is_, itemgetter

import numpy as np

#: A worker keeps two generations of this many pieces.
CACHE_PIECES = 1_200_000
#: Longer pieces aren't kept.
LONGEST = 200
#: Pieces laid end to end in one call of the library.
BLOCK = 2000
#: A run of these after a letter or digit is always a part of its own.
PUNCTUATION = ".,;:!?%$&*#"

#: The model's alphabet: printable Latin-1 stands for itself, other bytes for letters from 256 on.
SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
ALPHABET = dict(zip((b for b in range(256) if b not in SHOWN), range(256, 512)))
SPACE = chr(ALPHABET[32])


class PieceEncoder:
    def __init__(self, path: str, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not (plain and t.special)]
        # One with a space in it might come about where pieces are laid end to end: then all texts go whole.
        self.added = [""] if any(" " in t for t in added) else added
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.lengths[i] = len(token)  # one character of its alphabet stands for one byte
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def fresh(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces, each with the space before it.

        A piece of letters alone is one part of the pattern, so it goes straight to the model.
        """
        out: dict[str, bytes] = {}
        tokenize = self.tokenizer.model.tokenize
        for p in filter(str.isalpha, pieces):
            word = SPACE + p if p.isascii() else f" {p}".encode().decode("latin-1").translate(ALPHABET)
            out[p] = array("I", [t.id for t in tokenize(word)]).tobytes()
        pieces = [p for p in pieces if p not in out]
        blocks = [pieces[i : i + BLOCK] for i in range(0, len(pieces), BLOCK)]
        for block, ids in zip(blocks, self.library([" " + " ".join(b) for b in blocks])):
            ends = np.cumsum([len(p.encode()) + 1 for p in block])
            cuts = (4 * (np.searchsorted(np.cumsum(self.lengths[ids]), ends, "left") + 1)).tolist()
            raw, start = ids.tobytes(), 0
            for p, end in zip(block, cuts):
                out[p] = raw[start:end]
                start = end
        return out

    def tail(self, text: str) -> bytes:
        """Ids of punctuation that follows a letter or digit."""
        ids = self.tails.get(text)
        if ids is None:
            ids = self.library([text])[0].tobytes()
            if len(self.tails) < CACHE_PIECES and len(text) <= LONGEST:
                self.tails[text] = ids
        return ids

    @staticmethod
    def rejoined(own: list[str]) -> list[str]:
        """Pieces with those that begin with white space, or are empty, put back to what is before them."""
        joined = own[:1]
        for p in own[1:]:
            if p and not p[0].isspace():
                joined.append(p)
            else:
                joined[-1] += " " + p
        return joined

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; the library adds no tokens of its own."""
        whole = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        if not whole:
            return self.by_pieces(texts)
        skipped = set(whole)
        out = self.by_pieces(["" if i in skipped else t for i, t in enumerate(texts)])
        for i, ids in zip(whole, self.library([texts[i] for i in whole])):
            out[i] = ids.tobytes()
        return out

    def by_pieces(self, texts: list[str]) -> list[bytes]:
        cuts = [t.split(" ") for t in texts]
        get = self.young.get
        found, lacking = [], []
        for i, own in enumerate(cuts):
            got = list(map(get, own))
            lack = list(compress(own, map(is_, got, repeat(None))))
            # No kept piece begins with white space, so pieces that do are among those not found.
            if "" in lack or any(map(str.isspace, map(itemgetter(0), lack))):
                own = cuts[i] = self.rejoined(own)
                got = list(map(get, own))
                lack = list(compress(own, map(is_, got, repeat(None))))
            if got[0] is None:
                del lack[0]
            found.append(got)
            lacking.append(lack)
        for got, ids in zip(found, self.library([own[0] for own in cuts])):
            got[0] = ids.tobytes()
        known: dict[str, bytes] = {}
        new: dict[str, None] = {}
        cores: dict[str, str] = {}
        for p in dict.fromkeys(chain.from_iterable(lacking)):
            if (ids := self.old.get(p)) is not None:
                known[p] = ids
                continue
            core = p.rstrip(PUNCTUATION)
            if len(core) < len(p) and core and core[-1] < "ɐ" and core[-1].isalnum():
                cores[p] = p = core
                if get(core) is not None:
                    continue
            new[p] = None
        known |= self.fresh([p for p in new if p not in known])
        for p, core in cores.items():
            known[p] = (known.get(core) or get(core)) + self.tail(p[len(core) :])
        for got, lack in zip(found, lacking):
            i = 0
            for p in lack:
                i = got.index(None, i)
                got[i] = known[p]
        self.young |= {p: ids for p, ids in known.items() if len(p) <= LONGEST}
        if len(self.young) > CACHE_PIECES:
            self.old, self.young = self.young, {}
        return list(map(b"".join, found))


@lru_cache(2)
def piece_encoder(path: str, plain: bool = False) -> PieceEncoder:
    return PieceEncoder(path, plain)
