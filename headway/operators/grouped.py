"""Packed rows whose columns share dictionaries, for scans that add up slopes of a logistic loss.

Columns that take few different values together (calendar columns of one day, weather of one hour, what
belongs to one stop) form a group: a packed row holds each combination of their values once, and a code per
row. The group's share of all scores is worked out per combination and looked up; its slopes are summed per
combination first. Columns of many values stay as they are. Which columns form a group is found by
counting, and changes nothing but the time of a scan.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

from headway.operators.pieces import matrix

# Combinations of a group for each row of a packed row, at most.
SHARE = 1 / 8
# Rows of a packed row that a scan works on at a time.
CACHED_ROWS = 16_384
# Pairs of codes that are counted without sorting.
PAIRS = 1 << 22


def _codes(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Codes of the different values, and their number."""
    found, codes = np.unique(values, return_inverse=True)
    return codes, len(found)


def _joined(one: np.ndarray, ones: int, other: np.ndarray, others: int) -> tuple[np.ndarray, int]:
    """Codes of the pairs that occur, and their number."""
    pairs = one * others + other
    if ones * others > PAIRS:
        return _codes(pairs)
    known = np.zeros(ones * others, dtype=np.intp)
    known[pairs] = 1
    number = np.cumsum(known) - 1
    return number.take(pairs), int(number[-1]) + 1


def grouping(coded: list[tuple[np.ndarray, int]], most: int) -> list[list[int]]:
    """Columns that share a dictionary, found by counting the combinations of values."""
    groups: list[tuple[list[int], np.ndarray, int]] = []
    for i in sorted(range(len(coded)), key=lambda i: -coded[i][1]):
        codes, size = coded[i]
        fits = []
        for k, (_, other, others) in enumerate(groups):
            pairs, number = _joined(other, others, codes, size)
            if number <= max(most, others):
                fits.append((number - others, k, pairs, number))
        if fits:
            _, k, pairs, number = min(fits, key=lambda f: f[:2])
            groups[k] = ([*groups[k][0], i], pairs, number)
        else:
            groups.append(([i], codes, size))
    return [columns for columns, _, _ in groups]


def compressed(
    blocks: Iterator[tuple[np.ndarray, np.ndarray]], wide: bool = False
) -> Iterator[pa.RecordBatch]:
    """Packed rows with dictionaries; ``blocks`` are matrices of numbers and of places of weights.

    The first two rows of the numbers are weighted rows and positives, the others features. A place is that of
    a weight among all. With ``wide`` the last row of the places is one of a
    weight that lies with the piece, and the last number is its value at the start; both are sorted by place.
    """
    groups: list[list[int]] | None = None
    tails, last = 0, -1
    for numbers, places in blocks:
        new, start = np.zeros(0, dtype=np.int64), np.zeros(0)
        if wide:
            own, places = places[-1], places[:-1]
            first = (own >= 0) & (own != np.r_[last, own[:-1]])
            new, start = own[first], numbers[-1][first]
            here = np.where(own >= 0, tails + np.cumsum(first), 0)  # counts from 1
            numbers, tails, last = numbers[:-1], tails + len(new), int(own[-1])
            places = np.vstack([places, here])
        # rows that stand for one come first
        plain = (numbers[0] == 1.0) & ((numbers[1] == 0.0) | (numbers[1] == 1.0))
        order = np.r_[np.flatnonzero(plain), np.flatnonzero(~plain)]
        simple = int(plain.sum())
        n, s, x, places = numbers[0][order], numbers[1][order], numbers[2:, order], places[:, order]
        s[:simple] = 2.0 * s[:simple] - 1.0
        features = len(x)
        coded = [_codes(c) for c in (*x, *places)]
        most = max(1, int(len(order) * SHARE))
        if groups is None:
            dense = [i for i in range(features) if coded[i][1] > most]
            some = [i for i in range(len(coded)) if i not in dense]
            groups = [[some[i] for i in g] for g in grouping([coded[i] for i in some], most)]
            dense = sorted({i for i in range(features)} - {i for g in groups for i in g})
        parts = [s, n[simple:], x[dense].ravel()]
        ints, codes, shown = [], [], []
        for group in groups:
            code, size = coded[group[0]]
            for i in group[1:]:
                code, size = _joined(code, size, *coded[i])
            example = np.empty(size, dtype=np.intp)
            example[code] = np.arange(len(code))
            held = [i for i in group if i < features]
            taken = [i - features for i in group if i >= features]
            own_place = len(places) - 1 if wide else -1
            parts.append(x[held][:, example].ravel())
            ints.append(places[[i for i in taken if i != own_place]][:, example].ravel().astype(np.int32))
            if own_place in taken:
                ints.append(places[own_place][example].astype(np.int32))
            codes.append(code.astype(np.uint16 if size <= 1 << 16 else np.int32))
            shown.append([held, len([i for i in taken if i != own_place]), int(own_place in taken), size])
        body = b"".join(_even(np.ascontiguousarray(p).tobytes()) for p in (*parts, *ints, *codes))
        head = json.dumps([len(order), simple, dense, shown])
        arrays = [pa.array([v], pa.binary()) for v in (head.encode(), body, new.astype(np.int64).tobytes(), start.tobytes())]
        yield pa.RecordBatch.from_arrays(arrays, ["head", "body", "places", "start"])


def _even(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


class Reader:
    """Values of one type after another from a byte string."""

    def __init__(self, data: pa.Buffer):
        self.data, self.at = data, 0

    def take(self, kind: type, *shape: int) -> np.ndarray:
        count = math.prod(shape)
        found = np.frombuffer(self.data, dtype=kind, count=count, offset=self.at) if count else np.zeros(0, kind)
        size = found.nbytes
        self.at += size + -size % 8
        return found.reshape(shape)


def add_grouped(
    total: np.ndarray, bias: float, weights: np.ndarray, eps: float, batch: pa.RecordBatch,
    tail: np.ndarray | None = None, tail_total: np.ndarray | None = None,
) -> None:
    """Adds the sums of the loss, of the residual and of residual * feature over weighted rows to a total.

    ``weights`` has a zero behind the last weight, and ``total`` a place behind the last sum, for places
    without a weight; ``tail`` and ``tail_total`` have them in front.
    """
    rows, simple, dense, shown = json.loads(batch.column(0)[0].as_buffer().to_pybytes())
    read = Reader(batch.column(1)[0].as_buffer())
    s, n = read.take(np.float64, rows), read.take(np.float64, rows - simple)
    x = read.take(np.float64, len(dense), rows)
    values = [read.take(np.float64, len(held), size) for held, _, _, size in shown]
    places = [(read.take(np.int32, k, size), read.take(np.int32, own, size)) for _, k, own, size in shown]
    codes = [read.take(np.uint16 if size <= 1 << 16 else np.int32, rows) for *_, size in shown]
    shares, sums = [], [np.zeros(size) for *_, size in shown]
    for (held, *_), v, (here, own) in zip(shown, values, places, strict=True):
        share = weights[held] @ v if held else np.zeros(v.shape[1])
        for place in here:
            share += weights.take(place)
        for place in own:
            share += tail.take(place)
        shares.append(share)

    loss = bent = 0.0
    upright, leaning = weights[dense], np.zeros(len(dense))
    # a few thousand rows at a time stay in the processor's cache from their scores to their slopes
    most = min(rows, CACHED_ROWS)
    places_held, numbers_held = np.empty(most, dtype=np.intp), np.empty((2, most))
    cuts = sorted({*range(0, rows, most), simple, rows})
    for low, high in zip(cuts, cuts[1:], strict=False):
        at, (score, found) = places_held[: high - low], numbers_held[:, : high - low]
        part = x[:, low:high]
        np.matmul(upright, part, out=score)
        score += bias
        for share, code in zip(shares, codes, strict=True):
            np.copyto(at, code[low:high])
            score += np.take(share, at, out=found, mode="clip")
        residual, late = found, s[low:high]
        if low < simple:  # rows that stand for one; ``late`` is their sign
            score *= late
            p = _sigmoid(score)  # of the class the row has
            np.subtract(p, 1.0, out=residual)
            residual *= late
            p += eps
            loss -= np.log(p, out=p).sum()
        else:
            p, count = _sigmoid(score), n[low - simple : high - simple]
            loss -= late @ np.log(p + eps) + (count - late) @ np.log(1 - p + eps)
            np.multiply(count, p, out=residual)
            residual -= late
        bent += residual.sum()
        leaning += part @ residual
        for total_of, code in zip(sums, codes, strict=True):
            np.copyto(at, code[low:high])
            np.add.at(total_of, at, residual)
    total[0] += loss
    total[1] += bent
    slopes = total[2:]
    slopes[dense] += leaning
    for (held, *_), v, (here, own), found in zip(shown, values, places, sums, strict=True):
        if held:
            slopes[held] += v @ found
        for place in here:
            np.add.at(slopes, place, found)
        for place in own:
            np.add.at(tail_total, place, found)


def _sigmoid(score: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(score, out=score)
    with np.errstate(over="ignore"):
        np.exp(score, out=score)
    score += 1.0
    return np.divide(1.0, score, out=score)


def blocks(
    packed: Iterator[pa.RecordBatch], numbers: int, starts: Sequence[int], none: int, wide: bool = False
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Matrices of numbers and of places from packed numbers and codes; a code below 0 has no weight.

    With ``wide`` the number before the last is a place too.
    """
    first = np.array(starts, dtype=np.int64)[:, None]
    for batch in packed:
        values = matrix(batch.column(0)[0], np.float64, numbers + 2 * wide)
        codes = matrix(batch.column(1)[0], np.int32, len(starts)).astype(np.int64)
        places = np.where(codes >= 0, codes + first, none) if len(starts) else np.zeros((0, values.shape[1]), np.int64)
        if wide:
            places = np.vstack([places, values[numbers].astype(np.int64)])
            values = np.delete(values, numbers, axis=0)
        yield values, places
