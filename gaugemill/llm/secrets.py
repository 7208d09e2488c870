"""Secret scans: patterns propose credentials, and a guess-cost estimate weighs their values.

The base spans are those of three patterns: assignments to names such as password, access key
identifiers, and long runs of hexadecimal digits. The method adds spans of kind ``guess``: values
in a credential context (a name such as pwd, passphrase, auth, bearer or private key before
them) whose cheapest guess is dear enough.

The guess cost of a value is found by dynamic programming over its characters: the cheapest split
into dictionary words (with capitals and common substitutions; frequent parts of passwords first, then
the whole words of a public vocabulary of ranks, whose order follows their frequency), dates, repeats, ascending or
descending sequences, keyboard walks and brute-force spans; a split of l parts costs their
product times l!, since an attacker would try shorter splits first.

Offsets count code points, ends are exclusive. Edge cases: null and empty texts have no spans;
repeated rows give the same spans; values of any length are judged whole, over all splits and with
repeated blocks of any size: these are taken from the value's maximal runs, of which there are fewer than
characters, and numbers of parts stop where no larger one could be cheaper. A value after a mere space, as in prose, needs a digit; a match
that is rejected is searched for others from behind its name. Columns of the results' names are
replaced.
"""

from __future__ import annotations

import base64
import math
import re
from bisect import bisect_right
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import adding

# The patterns of the base kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: What introduces a value of the added kind.
CONTEXT = r"""(?i:\b(pwd|passphrase|pass|auth|bearer|credentials?|private_?key|access_?key|client_?key|signing_?key))["']?(?:\x20*[:=]\x20*|\x20)["']?([A-Za-z0-9+/_.=!@#$%^&*-]{8,})"""
NEEDLES = ("password", "passwd", "secret", "token", "apikey", "api_key")
CONTEXT_NEEDLES = ("pwd", "pass", "auth", "bearer", "credential", "_key", "privatekey", "accesskey", "clientkey", "signingkey")
KINDS = ("assign", "access", "hex", "guess")

#: A value counts as a secret from this log10 of guesses on.
LEAST_LOG10 = 9.0
#: Frequent parts of chosen passwords, most frequent first; the words of a vocabulary follow them.
WORDS = (
    "password pass admin welcome login user test secret token key letmein master monkey dragon shadow sunshine princess football baseball "
    "iloveyou love hello freedom whatever trustno hunter changeme default guest root example sample demo prod dev server database mysql "
    "postgres oracle summer winter spring autumn january february march april may june july august september october november december "
    "monday friday sunday apple google star super pepper ginger cookie summer flower lovely ashley michael jordan the and you for not with"
).split()
#: Rows of the keyboard.
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
SUBSTITUTIONS = str.maketrans("4@3!10$57", "aaeiiosst")
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)?\d\d")


@lru_cache(1)
def neighbours() -> dict[str, set[str]]:
    """The neighbours of each key."""
    near: dict[str, set[str]] = {}
    for y, row in enumerate(ROWS):
        for x, key in enumerate(row):
            near[key] = {ROWS[b][a] for b in (y - 1, y, y + 1) for a in (x - 1, x, x + 1) if 0 <= b < len(ROWS) and 0 <= a < len(ROWS[b]) and (a, b) != (x, y)}
    return near


@lru_cache(2)
def dictionary(path: str | None = None) -> tuple[dict[str, int], int]:
    """The rank of each word, from 1, and the longest word's length.

    ``path`` is a vocabulary of ranks: its tokens of a space and three letters or more are words.
    """
    words = dict.fromkeys(WORDS)
    if path:
        with open(path, "rb") as lines:
            pairs = sorted((int(b), base64.b64decode(a)) for a, b in (x.split() for x in lines if x.strip()))
        for _, raw in pairs:
            word = raw.decode(errors="replace").lower()
            if len(word) > 3 and word[0] == " " and word[1:].isalpha():
                words.setdefault(word[1:])
    return {w: i + 1 for i, w in enumerate(words)}, max(map(len, words))


def alphabet(part: str) -> int:
    """The number of characters that brute force would have to try at each place."""
    size = 10 * any(c.isdigit() for c in part) + 26 * any("a" <= c <= "z" for c in part) + 26 * any("A" <= c <= "Z" for c in part)
    return max(size + 33 * any(not c.isalnum() for c in part), 10)


def runs(n: int, goes_on) -> list[int]:
    """For each place where the run that it is in ends; ``goes_on(i)``: i is in a run with i - 1."""
    ends = [n] * n
    for i in range(n - 2, -1, -1):
        ends[i] = ends[i + 1] if goes_on(i + 1) else i + 1
    return ends


def spans_of(value: str, words: str | None = None) -> list[tuple[int, int, float]]:
    """(start, end, log10 of guesses) of every word, date, repeat of one character and sequence."""
    ranks, longest = dictionary(words)
    low, n, found = value.lower(), len(value), []
    plain = low.translate(SUBSTITUTIONS)
    same = runs(n, lambda i: value[i] == value[i - 1])
    for i in range(n):
        for j in range(i + 3, min(n, i + longest) + 1):
            for form, factor in ((low[i:j], 1), (plain[i:j], 2)):
                if form in ranks:
                    found.append((i, j, math.log10(ranks[form] * factor * (1 if value[i:j] == low[i:j] else 2) + 1)))
                    break
        if m := DATE.match(value, i):
            found += [(i, j, math.log10(365 * 60 * 2)) for j in {m.end(), min(m.end(), i + 4)} if j - i >= 4]
        if (j := same[i]) - i >= 3:
            found.append((i, j, math.log10(alphabet(value[i]) * (j - i))))
        for step in (1, -1):
            j = i + 1
            while j < n and value[j].isalnum() and ord(value[j]) - ord(value[j - 1]) == step:
                j += 1
            if j - i >= 3:
                found.append((i, j, math.log10(alphabet(value[i:j]) * (j - i))))
    return found


def ordered(codes: np.ndarray) -> list[np.ndarray]:
    """For k = 0, 1, ...: the rank of each place by its next 2**k codes; the last has no ties.

    What is cut off by the end comes before what goes on.
    """
    levels = [np.unique(codes, return_inverse=True)[1].astype(np.int64)]
    while levels[-1].max(initial=0) < len(codes) - 1:
        one, width = levels[-1], 1 << len(levels) - 1
        two = np.concatenate([one[width:], np.full(min(width, len(one)), -1)])
        levels.append(np.unique(one * (len(codes) + 1) + two + 1, return_inverse=True)[1].astype(np.int64))
    return levels


def common_ahead(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many codes from unlike places i and j on are the same."""
    n, i, j = len(levels[0]), i.copy(), j.copy()
    total = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (i < n) & (j < n)
        same = inside & (levels[k][np.where(inside, i, 0)] == levels[k][np.where(inside, j, 0)])
        step = same.astype(np.int64) << k
        total, i, j = total + step, i + step, j + step
    return total


def runs_of(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all maximal runs: longest stretches of which two least periods or more fit in.

    Every run has a Lyndon word of its period, for one order of the codes or the other, that is the longest
    Lyndon word from some place, and ends where a smaller suffix begins. So n places and two orders
    propose all runs, and common extensions either way tell which proposals are runs.
    """
    n, found = len(codes), set()
    if n < 2:
        return []
    back = ordered(codes[::-1].astype(np.int64))
    for signed in (codes.astype(np.int64), -codes.astype(np.int64)):
        ahead = ordered(signed)
        rank, smaller, stack = ahead[-1].tolist(), [n] * n, []
        for i in range(n - 1, -1, -1):
            while stack and rank[stack[-1]] > rank[i]:
                stack.pop()
            smaller[i] = stack[-1] if stack else n
            stack.append(i)
        i, j = np.arange(n), np.array(smaller)
        period = j - i
        right = j + np.where(j < n, common_ahead(ahead, i, np.minimum(j, n)), 0)
        # To the left: from the places before i and j, in the reversed text.
        left = i - np.where(i > 0, common_ahead(back, n - i, n - j), 0)
        at = right - left >= 2 * period
        found.update(zip(left[at].tolist(), right[at].tolist(), period[at].tolist()))
    return sorted(found)


def least_before(row: np.ndarray) -> np.ndarray:
    """For each place q of the first axis the least of places ceil(q / 2) to q - 1, infinite for q < 2."""
    out = np.full(row.shape, np.inf)
    level, width = row, 1
    while 2 * width < len(row):
        # Windows of ``width`` to 2 * width - 1 places: two of ``width`` cover them.
        q = np.arange(2 * width, min(4 * width, len(row)))
        out[q] = np.minimum(level[q - q // 2], level[q - width])
        level, width = np.minimum(level[:-width], level[width:]), 2 * width
    return out


def log10_guesses(value: str, words: str | None = None) -> float:
    """log10 of the guesses of the cheapest split of the value into patterns; ``words``: see ``dictionary``."""
    n = len(value)
    if not n:
        return 0.0
    near = neighbours()
    low, place = value.lower(), np.arange(n + 1)
    found = sorted(spans_of(value, words), key=lambda x: x[1])
    start, stop = (np.array([x[i] for x in found], np.int64) for i in (0, 1))
    cost = np.array([x[2] for x in found], float)
    stops, heads = np.unique(stop, return_index=True)
    # Blocks that repeat the one before them: k periods of a run, behind k periods of it. Those of one character are found above.
    twice = [x for x in runs_of(np.frombuffer(value.encode("utf-32-le"), np.uint32)) if x[2] > 1]
    again = math.log10(2)
    # Keyboard walks of four keys or more, from any place in a run to any other: (first, end of the run).
    ends = runs(n, lambda i: low[i] in near.get(low[i - 1], ()))
    walks = [(i, ends[i]) for i in range(n) if ends[i] - i >= 4 and (not i or ends[i - 1] == i)]
    key, first = math.log10(2.3), math.log10(len(near))
    each = math.log10(alphabet(value))
    # Splits of more than so many parts cost at least ``bound`` at that place: brute force for all characters, less
    # what runs and walks could save at most, less the best savings of as many spans, and the order of the parts.
    spared = sum(b - a for a, b, *_ in [*twice, *walks]) * each
    savings = -np.sort(-np.maximum((stop - start) * each - cost, 0.0))
    order = np.concatenate([[0.0], np.cumsum(np.log10(np.arange(1, n + 1)))])
    best = np.concatenate([[0.0], np.cumsum(savings)])
    bound = np.maximum(n * each - spared - best[np.minimum(np.arange(n + 1), len(savings))], 0.0) + order
    bound = np.append(np.minimum.accumulate(bound[::-1])[::-1][1:], np.inf)
    # Of the first j characters in so many parts: the cheapest cost, and that without brute force at
    # the end, since a brute-force part never follows another.
    either = np.full(n + 1, np.inf)
    either[0] = 0.0
    known, least = either.copy(), math.inf
    for parts in range(1, n + 1):
        new = np.full(n + 1, np.inf)
        if len(stops):
            new[stops] = np.minimum.reduceat(either[start] + cost, heads)
        for a, b, period in twice:
            rows = -(-(b - a + 1) // period)
            own = np.full(rows * period, np.inf)
            own[: b - a + 1] = either[a : b + 1]
            ahead = least_before(own.reshape(rows, period)).ravel()[: b - a + 1]
            new[a : b + 1] = np.minimum(new[a : b + 1], ahead + again)
        for a, b in walks:
            new[a + 4 : b + 1] = np.minimum(new[a + 4 : b + 1], np.minimum.accumulate(either[a : b - 3] - place[a : b - 3] * key) + first + (place[a + 4 : b + 1] - 1) * key)
        brute = np.full(n + 1, np.inf)
        brute[1:] = np.minimum.accumulate(known[:-1] - place[:-1] * each) + place[1:] * each
        either, known = np.minimum(new, brute), new
        least = min(least, float(either[n]) + order[parts])
        if not np.isfinite(either).any() or bound[parts] >= least:
            break
    return least


class Scanner:
    def __init__(self, least: float = LEAST_LOG10, words: str | None = None):
        self.least, self.cost = least, lambda value: log10_guesses(value, words)
        self.assign, self.context = re.compile(ASSIGN, re.ASCII), re.compile(CONTEXT, re.ASCII)
        self.head = re.compile(CONTEXT[: CONTEXT.index("([A-Za-z0-9+/_.=!@")], re.ASCII)
        self.access, self.hex = re.compile(ACCESS), re.compile(r"[0-9a-f]{24,}")
        self.shape = bytes(120 if chr(b) in "0123456789abcdef" else 45 for b in range(256))

    def __call__(self, text: str | None) -> list[tuple[int, int, int, float | None]]:
        """(start, kind, end, log10 of guesses) of all spans, ordered by start and kind."""
        if not text:
            return []
        found = []
        low = text.lower()
        if any(x in low for x in NEEDLES):
            found += [(m.start(), 0, m.end(), self.cost(m[2])) for m in self.assign.finditer(text) if len(m[2]) >= 6]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end(), None) for m in self.access.finditer(text) if m.end() - m.start() >= 20]
        # Runs of hexadecimal digits are rare: a translated copy is searched for a long run first.
        if b"x" * 24 in text.encode().translate(self.shape):
            found += [(m.start(), 2, m.end(), None) for m in self.hex.finditer(text)]
        if any(x in low for x in CONTEXT_NEEDLES):
            found += self.guesses(text, [(a, b) for a, _, b, _ in found])
        return sorted(found)

    def guesses(self, text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, int, float]]:
        """Spans of the added kind that overlap none that is taken."""
        found, at = [], 0
        # Taken spans as runs that don't overlap, so that one look finds the next.
        joined: list[list[int]] = []
        for x, y in sorted(taken):
            if joined and x <= joined[-1][1]:
                joined[-1][1] = max(y, joined[-1][1])
            else:
                joined.append([x, y])
        ends = [y for _, y in joined]
        while head := self.head.search(text, at):
            at = head.end(1)
            over = joined[k][0] if (k := bisect_right(ends, head.end())) < len(joined) else len(text) + 1
            if over <= head.end() or not (m := self.context.match(text, head.start())):
                continue
            a, b = m.span(2)
            if over < b:
                at = max(at, over)
                continue
            named = any(c in ":=" for c in text[m.end(1) : a])
            if (named or any(c.isdigit() for c in m[2])) and (cost := self.cost(m[2])) >= self.least:
                found.append((a, 3, b, cost))
                at = b
        return found


def scan(df: DataFrame, text: str = "text", to: str = "secrets", least: float = LEAST_LOG10, keep_text: bool = True, words: str | None = None) -> DataFrame:
    """Adds an array of (kind, start, end, log10_guesses), ordered by start and kind."""
    kind = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("log10_guesses", T.DoubleType())]))

    def make():
        scanner = Scanner(least, words)
        return lambda texts: [[[{"kind": KINDS[k], "start": a, "end": b, "log10_guesses": g} for a, k, b, g in scanner(t)] for t in texts]]

    return adding(df, [text], {to: kind}, make, () if keep_text else (text,))


def redact(df: DataFrame, text: str = "text", mark: str = "[secret]", least: float = LEAST_LOG10, words: str | None = None) -> DataFrame:
    """Replaces every span in the text; overlapping spans give one mark, assignments keep their name."""

    def make():
        scanner = Scanner(least, words)
        name = re.compile(ASSIGN, re.ASCII)

        def clean(value: str | None) -> str | None:
            spans = scanner(value)
            if not spans:
                return value
            out, at = [], 0
            for a, k, b, _ in spans:
                if k == 0:
                    a = name.match(value, a).start(2)
                if b <= at:
                    continue
                if a >= at:
                    out += value[at:a], mark
                at = b
            return "".join(out) + value[at:]

        return lambda texts: [[clean(t) for t in texts]]

    columns = df.columns
    return adding(df, [text], {text: T.StringType()}, make).select(*[f"`{c}`" for c in columns])
