"""Secret scans by inferred grammars.

Three plain patterns give the base findings. The values they hold are credentials labelled
by kind; a bounded sample of them (``TRAINING`` per kind, by hash) makes a frequency prefix
tree per kind, whose states are merged while their outgoing frequencies are compatible
within the Hoeffding bound. These automata read the *format* of a token: its character set
first (decimal, hexadecimal, base 32, ...), then a step per character or mark, so that their
states hold lengths and places of marks. Tokens outside the findings, sampled in the same way
with and without digits and marks, make automata of *letters*.

Every token of six or more characters of the base patterns' set is scored by both: it is a
finding too if its likelihood as a credential is ``MARGIN`` nats above that as another token.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import document_keys, small_batches
from headway.session import materialise

KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": re.compile(
        r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{24,}"),
}
NAMES = re.compile(r"(?ai:passw|secret|token|api_?key)")
# Characters of assigned values; a full stop at either end belongs to the sentence.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-][A-Za-z0-9+/_.=-]{4,}[A-Za-z0-9+/_=-]")
MODEL = "model"
TRAINING = 2000  # values per kind that an automaton is fitted to, those with the smallest hashes
ALPHA = 0.05
MARGIN = 7.0  # nats: of a thousand tokens one is taken to be a credential
FLOOR = 1e-4  # probability of what a state has not seen
SYMBOLS = 40  # of ordinary tokens: letters, digits as one, marks, the end
CAPITAL = 0.05  # probability that a letter of an ordinary token is a capital
CAPITALS = 0.02  # probability that all of its letters are
REMEMBERED = 1 << 17  # tokens whose verdict a worker keeps

FORMAT, LETTERS = "format", "letters"
PLAIN, OTHER = "plain", "other"  # tokens of letters alone, and all others

# Character sets from the narrowest on: symbol, members, size.
CHARSETS = [
    ("0", re.compile(r"[0-9]*"), 10), ("h", re.compile(r"[0-9a-f]*"), 16), ("H", re.compile(r"[0-9A-F]*"), 16),
    ("l", re.compile(r"[a-z]*"), 26), ("B", re.compile(r"[A-Z2-7]*"), 32), ("m", re.compile(r"[a-z0-9]*"), 36),
    ("M", re.compile(r"[A-Z0-9]*"), 36), ("L", re.compile(r"[A-Za-z]*"), 52), ("A", re.compile(r"[A-Za-z0-9]*"), 62),
]
MARKS = re.compile(r"[^A-Za-z0-9]")
HEX_LETTERS = re.compile(r"[a-f]*|[A-F]*")
SMALL = math.log(1 - CAPITAL)
UNIT = "x"  # a character of the token's set


def format_of(word: str) -> tuple[list[str], float]:
    """The format of a token, and the log probability of its characters given the format."""
    bare = MARKS.sub("", word)
    symbol, _, size = next((c for c in CHARSETS if c[1].fullmatch(bare)), CHARSETS[-1])
    steps = [UNIT if c.isalnum() else c for c in word]
    return [symbol, *steps], -len(bare) * math.log(size)


def letters_of(word: str) -> tuple[Sequence[str], float]:
    """Folded letters, one symbol for digits, marks; and the log probability of what folding lost."""
    if word.isalpha() and word.islower():
        return word, len(word) * SMALL
    digits = sum(c.isdigit() for c in word)
    capitals, letters = sum(c.isupper() for c in word), sum(c.isalpha() for c in word)
    lost = capitals * math.log(CAPITAL) + (letters - capitals) * SMALL
    if capitals == letters > 1:
        lost = math.log(CAPITALS)
    return ["0" if c.isdigit() else c.lower() for c in word], lost - digits * math.log(10)


CODINGS = {FORMAT: format_of, LETTERS: letters_of}


@dataclass
class Automaton:
    """States with the logarithms of transition and end probabilities over the symbols of a coding."""

    moves: list[dict[str, tuple[int, float]]]
    ends: list[float]
    coding: str
    unseen: list[float]

    def walk(self, symbols: Iterable[str]) -> float:
        """Log probability of a row of symbols."""
        state, total, moves = 0, 0.0, self.moves
        for c in symbols:
            step = moves[state].get(c)
            if step is not None:
                state, p = step
                total += p
                continue
            total += self.unseen[state]
            if self.coding == LETTERS:
                state = 0  # as at the start of another word
            elif state == 0 and moves[0]:
                state = max(moves[0].values(), key=lambda m: m[1])[0]  # the lengths of the most frequent set
        return total + self.ends[state]

    def score(self, word: str) -> float:
        """Log probability of a word."""
        symbols, lost = CODINGS[self.coding](word)
        return lost + self.walk(symbols)


@dataclass
class Mixture:
    """Automata and their shares."""

    parts: list[tuple[float, Automaton]]

    def score(self, word: str) -> float:
        scores = [math.log(share) + a.score(word) for share, a in self.parts]
        best = max(scores)
        return best + math.log(sum(math.exp(s - best) for s in scores))


def infer(words: list[str], alpha: float = ALPHA, coding: str = FORMAT) -> Automaton:
    """Merge compatible states of the frequency prefix tree of ``words``, breadth first.

    Two states are compatible if their end and transition frequencies differ by less than
    the Hoeffding bound, and so do their successors.
    """
    kids: list[dict[str, int]] = [{}]
    passed: list[dict[str, int]] = [defaultdict(int)]
    ended: list[int] = [0]
    for word in words:
        state = 0
        for c in CODINGS[coding](word)[0]:
            passed[state][c] += 1
            if c not in kids[state]:
                kids[state][c] = len(kids)
                kids.append({})
                passed.append(defaultdict(int))
                ended.append(0)
            state = kids[state][c]
        ended[state] += 1
    scale = math.sqrt(0.5 * math.log(2 / alpha))

    def total(s: int) -> int:
        return ended[s] + sum(passed[s].values())

    def differ(f1: int, n1: int, f2: int, n2: int) -> bool:
        return bool(n1 and n2) and abs(f1 / n1 - f2 / n2) > scale * (n1**-0.5 + n2**-0.5)

    def compatible(p: int, q: int) -> bool:
        pairs = [(p, q)]
        while pairs:
            p, q = pairs.pop()
            n1, n2 = total(p), total(q)
            if differ(ended[p], n1, ended[q], n2):
                return False
            for c in passed[p].keys() | passed[q].keys():
                if differ(passed[p].get(c, 0), n1, passed[q].get(c, 0), n2):
                    return False
                if c in kids[p] and c in kids[q]:
                    pairs.append((kids[p][c], kids[q][c]))
        return True

    def fold(p: int, q: int) -> None:
        """Add the tree below q to the states below p."""
        pairs = [(p, q)]
        while pairs:
            p, q = pairs.pop()
            ended[p] += ended[q]
            for c, n in passed[q].items():
                passed[p][c] += n
            for c, child in kids[q].items():
                if c in kids[p]:
                    pairs.append((kids[p][c], child))
                else:
                    kids[p][c] = child

    kept, fringe = [0], [(0, c) for c in sorted(kids[0])]
    while fringe:
        parent, c = fringe.pop(0)
        blue = kids[parent][c]
        if blue in kept:
            continue
        for red in kept:
            if compatible(red, blue):
                kids[parent][c] = red
                fold(red, blue)
                break
        else:
            kept.append(blue)
        fringe = [(s, c) for s in kept for c in sorted(kids[s]) if kids[s][c] not in kept]
    number = {s: i for i, s in enumerate(kept)}
    # every symbol of ordinary tokens counts once more than seen, so that a rare token isn't learned by heart
    more, kinds = (1, SYMBOLS) if coding == LETTERS else (0, 0)
    moves, ends, unseen = [], [], []

    def log(p: float) -> float:
        return math.log(max(p, FLOOR))

    for s in kept:
        n = max(total(s) + kinds, 1)
        moves.append({c: (number[kids[s][c]], log((k + more) / n)) for c, k in passed[s].items()})
        ends.append(log((ended[s] + more) / n))
        unseen.append(log(more / n))
    return Automaton(moves, ends, coding, unseen)


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, stop, kind, value) of the plain patterns, by start and kind."""
    found = []
    if NAMES.search(text):
        for m in PATTERNS["assign"].finditer(text):
            if len(m[2]) >= 6:
                found.append((m.start(), m.end(), "assign", m[2]))
    if "AKIA" in text:
        for m in PATTERNS["access"].finditer(text):
            if len(m[0]) >= 20:
                found.append((m.start(), m.end(), "access", m[0]))
    for m in PATTERNS["hex"].finditer(text):
        found.append((m.start(), m.end(), "hex", m[0]))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, taken: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str]]:
    """(start, stop, token) of the tokens that overlap no base finding."""
    starts, stops = [], []
    for a, b, _, _ in taken:
        if stops and a < stops[-1]:
            stops[-1] = max(stops[-1], b)
        else:
            starts.append(a)
            stops.append(b)
    if not starts:
        return [(*m.span(), m[0]) for m in CANDIDATE.finditer(text)]
    out = []
    for m in CANDIDATE.finditer(text):
        at = bisect_left(starts, m.end()) - 1
        if at < 0 or stops[at] <= m.start():
            out.append((m.start(), m.end(), m[0]))
    return out


SPAN = "struct<start:long,stop:long,kind:string,value:string>"
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string()), ("value", pa.string())])


_SAMPLE = pa.schema([("kind", pa.string()), ("rank", pa.int64()), ("value", pa.string())])


class _Smallest:
    """The distinct values with the smallest hashes, a bounded number of them."""

    def __init__(self, size: int):
        self.size, self.held, self.heap = size, set(), []

    def add(self, value: str) -> None:
        rank = zlib.crc32(value.encode())
        if len(self.heap) == self.size and (-rank, value) <= self.heap[0] or value in self.held:
            return
        self.held.add(value)
        heapq.heappush(self.heap, (-rank, value))
        if len(self.heap) > self.size:
            self.held.discard(heapq.heappop(self.heap)[1])


def samples(docs: DataFrame, rows: int) -> dict[str, list[tuple[int, str]]]:
    """Per kind up to ``rows`` distinct (CRC-32, value), those with the smallest hashes of all texts.

    A task holds ``rows`` values per kind, whatever it reads, and so does the driver.
    """
    kinds = (*KINDS, PLAIN, OTHER)
    small_batches(docs)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {k: _Smallest(rows) for k in kinds}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = base_spans(text or "")
                for _, _, kind, value in found:
                    kept[kind].add(value)
                for _, _, value in candidates(text or "", found):
                    kept[PLAIN if value.isalpha() else OTHER].add(value)
        out = [(k, -rank, value) for k, best in kept.items() for rank, value in best.heap]
        if out:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SAMPLE, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=_SAMPLE)

    every = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(gather, "kind string, rank long, value string")
    every = materialise(every, "secret-samples")
    out = {}
    for kind in kinds:
        best = every.filter(F.col("kind") == kind).select("rank", "value").distinct().orderBy("rank", F.desc("value"))
        out[kind] = [(r[0], r[1]) for r in best.limit(rows).collect()]
    return out


def fit(docs: DataFrame, rows: int = TRAINING) -> tuple[list[Automaton], Mixture | None]:
    """Automata of the labelled credentials by kind, and the mixture of all other tokens.

    The shares of tokens with and without digits or marks are those of their distinct values, which
    the largest hash of a full sample tells.
    """
    found = samples(docs, rows)
    models = [infer([v for _, v in found[k]]) for k in KINDS if found[k]]
    numbers = {
        k: len(found[k]) if len(found[k]) < rows else rows * 2**32 / (found[k][-1][0] + 1) for k in (PLAIN, OTHER)
    }
    total = sum(numbers.values())
    parts = [
        (numbers[k] / total, infer([v for _, v in found[k]], coding=LETTERS)) for k in (PLAIN, OTHER) if found[k]
    ]
    return models, Mixture(parts) if parts else None


def likely(value: str, models: list[Automaton], words: Automaton | Mixture | None, margin: float = MARGIN) -> bool:
    """Whether a token fits a credential format clearly better than it fits other tokens."""
    if not models:
        return False
    if isinstance(words, Mixture) and value.isalpha():
        # a format can't make letters likelier than their smallest set, nor the whole mixture less likely than a part
        most = -len(value) * math.log(16 if HEX_LETTERS.fullmatch(value) else 26)
        share, part = words.parts[0]
        if most - math.log(share) - part.score(value) <= margin:
            return False
    symbols, given = format_of(value)
    best = given + max(m.walk(symbols) for m in models)
    ordinary = words.score(value) if words else (len(value) + 1) * math.log(FLOOR)
    return best - ordinary > margin


def secrets(docs: DataFrame, training: int = TRAINING, margin: float = MARGIN) -> DataFrame:
    """One row per document: doc_id, h, base, spans (arrays of start, stop, kind, value, by start).

    ``base`` are the findings of the patterns, ``spans`` these and what the automata add.
    Positions count code points, ends are exclusive. Null counts as empty; a corpus without
    labelled credentials has no automata and gets base findings only. Tokens of any length
    from six characters on are scored.
    """
    models, words = fit(docs, training)
    verdicts: dict[str, bool] = {}  # of a worker

    def judge(value: str) -> bool:
        known = verdicts.get(value)
        if known is None:
            if len(verdicts) >= REMEMBERED:
                verdicts.clear()
            known = verdicts[value] = likely(value, models, words, margin)
        return known

    @F.arrow_udf(f"struct<base:array<{SPAN}>,spans:array<{SPAN}>>")
    def scan(texts: pa.Array) -> pa.Array:
        base, spans = [], []
        for text in texts.to_pylist():
            text = text or ""
            found = base_spans(text)
            more = [(a, b, MODEL, v) for a, b, v in candidates(text, found) if judge(v)]
            order = (*KINDS, MODEL)
            every = sorted([*found, *more], key=lambda s: (s[0], order.index(s[2]))) if more else found
            for out, listed in ((base, found), (spans, every)):
                out.append([dict(zip(("start", "stop", "kind", "value"), s, strict=True)) for s in listed])
        kind = pa.list_(_SPAN)
        return pa.StructArray.from_arrays([pa.array(base, kind), pa.array(spans, kind)], names=["base", "spans"])

    keys = document_keys(docs, scan(F.col("text").cast("string")).alias("s"))
    return keys.select("doc_id", "h", "s.base", "s.spans")
