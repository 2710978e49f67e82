"""A gated recurrent network over word ids with a class-factored softmax, in numpy.

A word's probability is that of its class, given the state, times that of the word in its class, given the state too.
Head words have ids from 0 on, `MEMBERS` consecutive ones make a class; the classes after those stand for rare words as a
whole and end there. Rows of the input table are ids, then rare classes, then the start of a document.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np

HIDDEN, MEMBERS = 16, 64
LANES, STEPS, SCORE_STEPS = 256, 32, 32
#: Lanes by steps held at a time: beyond that there are fewer lanes.
CELLS = 1 << 23
LEARNING_RATE, CLIP = 0.08, 5.0
#: Places whose class logits are held at a time, to stay in a core's cache, and the logits that need no maximum taken off.
PIECE, LARGEST = 512, 80.0


@dataclass
class Weights:
    """inputs: gate inputs by id. gates: recurrent. classes and members: output rows, with their biases."""

    inputs: np.ndarray
    gates: np.ndarray
    classes: np.ndarray
    class_bias: np.ndarray
    members: np.ndarray
    member_bias: np.ndarray

    @property
    def head_classes(self) -> int:
        return len(self.member_bias) // MEMBERS

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in vars(self).values()])

    def like(self, flat: np.ndarray) -> Weights:
        out, at = {}, 0
        for name, value in vars(self).items():
            out[name] = flat[at: at + value.size].reshape(value.shape).astype(np.float32)
            at += value.size
        return Weights(**out)


def initial(head_counts: np.ndarray, rare_counts: np.ndarray, seed: int = 7) -> Weights:
    """Small random weights, and biases that give each word its share in training text."""
    rng = np.random.default_rng(seed)
    padded = np.full(-(-len(head_counts) // MEMBERS) * MEMBERS, 1e-9)
    padded[: len(head_counts)] = head_counts
    by_class = np.concatenate([padded.reshape(-1, MEMBERS).sum(1), rare_counts + 0.1])
    rows = len(padded) + len(rare_counts) + 1
    draw = lambda *shape: rng.normal(0, 0.08, shape).astype(np.float32)
    return Weights(
        draw(rows, 3 * HIDDEN), draw(HIDDEN, 3 * HIDDEN), draw(HIDDEN, len(by_class)),
        np.log(by_class / by_class.sum()).astype(np.float32), draw(len(padded), HIDDEN),
        np.log(padded).astype(np.float32))


def _recurrent(w: Weights) -> np.ndarray:
    """[gate, state, gate's state] of update, reset and new, the first two halved as `_cell` takes them."""
    out = w.gates.reshape(HIDDEN, 3, HIDDEN).transpose(1, 0, 2).copy()
    out[:2] *= 0.5
    return out


def _entered(inputs: np.ndarray, rows: np.ndarray, out: np.ndarray) -> np.ndarray:
    """[gate, ..., gate's state] of the words' rows of the input table, update and reset halved, in `out`."""
    at = rows * 3 + np.arange(3, dtype=rows.dtype).reshape(3, *[1] * rows.ndim)
    inputs.reshape(-1, HIDDEN).take(at, axis=0, out=out, mode="clip")
    out[:2] *= 0.5
    return out


def _cell(gates: np.ndarray, x: np.ndarray, state: np.ndarray, y: np.ndarray, new: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Next state of each lane, in `out`. What the backward step needs besides goes to `y` (update, reset, the state's own
    part of the new one) and to `new`. A logistic gate is a hyperbolic tangent of half its argument."""
    np.matmul(state, gates, out=y)
    gate = y[:2]
    gate += x[:2]
    np.tanh(gate, out=gate)
    gate *= 0.5
    gate += 0.5
    np.multiply(y[1], y[2], out=new)
    new += x[2]
    np.tanh(new, out=new)
    np.subtract(state, new, out=out)
    out *= y[0]
    out += new
    return out


def _step(w: Weights, rows: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """Next state, update, reset, own part and new state of lanes that read these rows."""
    x, y = np.empty((2, 3, *state.shape), dtype=np.float32)
    new, out = np.empty((2, *state.shape), dtype=np.float32)
    return _cell(_recurrent(w), _entered(w.inputs, rows, x), state, y, new, out), *y, new


def _beginners(rows: np.ndarray, start: int) -> list[np.ndarray]:
    """The lanes where a document begins, by step."""
    steps, lanes = np.nonzero(rows == start)
    return np.split(lanes, np.searchsorted(steps, np.arange(1, len(rows))))


class _Places:
    """Places in the order of their class, as products with the output rows need them: the states, followed by a one that
    meets the bias."""

    def __init__(self, w: Weights, states: np.ndarray, classes: np.ndarray, ids: np.ndarray) -> None:
        self.order = np.argsort(classes.astype(np.uint16), kind="stable")
        self.classes = classes[self.order]
        self.states = np.empty((len(states), HIDDEN + 1), dtype=np.float32)
        states.take(self.order, axis=0, out=self.states[:, :HIDDEN], mode="clip")
        self.states[:, HIDDEN] = 1
        edges = np.searchsorted(self.classes, np.arange(w.head_classes + 1))
        #: Places whose target is a word of the head, and which member of its class that is.
        self.head = int(edges[-1])
        self.members = ids[self.order[: self.head]] % MEMBERS
        #: Each head class that occurs, and its places.
        self.spans = [(c, slice(i, j)) for c, (i, j) in enumerate(itertools.pairwise(edges.tolist())) if i < j]
        self.pieces = [slice(i, i + PIECE) for i in range(0, len(states), PIECE)]


def _output_rows(w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Output rows of classes, as [class, state], and of members, as [class, member, state], each with its bias at the end."""
    classes = np.column_stack([w.classes.T, w.class_bias])
    return classes, np.column_stack([w.members, w.member_bias]).reshape(-1, MEMBERS, HIDDEN + 1)


def _bounded(rows: np.ndarray) -> bool:
    """No logit of these rows can leave the range of float32 exponentials, since no state leaves -1 to 1."""
    return bool((np.abs(rows).reshape(-1, HIDDEN + 1) @ np.ones(HIDDEN + 1, dtype=np.float32)).max(initial=0) < LARGEST)


def _exponentials(logits: np.ndarray, bounded: bool, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In place, each row to one factor of its own: (sums of the rows, logits of the chosen ones less that factor's)."""
    if not bounded:
        logits -= logits.max(1, keepdims=True)
    picked = logits[np.arange(len(logits)), chosen]
    np.exp(logits, out=logits)
    return logits @ np.ones(logits.shape[1], dtype=np.float32), picked


def _member_logits(places: _Places, rows: np.ndarray, out: np.ndarray) -> np.ndarray:
    """[head place, member] logits, in `out`; only a place's own class is multiplied."""
    for c, at in places.spans:
        np.matmul(places.states[at], rows[c].T, out=out[at])
    return out


def log_probabilities(w: Weights, states: np.ndarray, classes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural log of each target's probability; for a rare class that of the class alone."""
    return _log_probabilities(w, _output_rows(w), states, classes, ids)


def _log_probabilities(w: Weights, output: tuple[np.ndarray, np.ndarray], states: np.ndarray, classes: np.ndarray,
                       ids: np.ndarray) -> np.ndarray:
    places, (by_class, by_member) = _Places(w, states, classes, ids), output
    got, bounded = np.empty(len(states), dtype=np.float32), _bounded(by_class)
    for at in places.pieces:
        total, got[at] = _exponentials(places.states[at] @ by_class.T, bounded, places.classes[at])
        got[at] -= np.log(total)
    members = _member_logits(places, by_member, np.empty((places.head, MEMBERS), dtype=np.float32))
    total, chosen = _exponentials(members, _bounded(by_member), places.members)
    got[: places.head] += chosen - np.log(total)
    out = np.empty_like(got)
    out[places.order] = got
    return out


def targets(rows: np.ndarray, w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """(class, id) of words given by their input rows."""
    words = len(w.member_bias)
    return np.where(rows < words, rows // MEMBERS, w.head_classes + rows - words), rows


def _lanes(documents: list[np.ndarray], lanes: int) -> list[list[int]]:
    """Documents dealt to lanes of about equal length, the longest lane first."""
    order = np.argsort([-len(d) for d in documents], kind="stable")
    held: list[list[int]] = [[] for _ in range(min(lanes, len(documents)))]
    sizes = np.zeros(len(held), dtype=np.int64)
    for number in order.tolist():
        lane = int(np.argmin(sizes))
        held[lane].append(number)
        sizes[lane] += len(documents[number])
    return [held[k] for k in np.argsort(-sizes, kind="stable").tolist()]


def _dealt(documents: list[np.ndarray], lanes: int, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets and owners as [step, lane], and the lanes' lengths. A document's first input is `start`."""
    longest = max(map(len, documents), default=1)
    dealt = _lanes(documents, max(1, min(lanes, CELLS // longest)))
    lengths = np.array([sum(len(documents[n]) for n in lane) for lane in dealt])
    steps = int(lengths.max(initial=0))
    before, after = (np.full((steps, len(dealt)), start, dtype=np.int32) for _ in range(2))
    owner = np.zeros((steps, len(dealt)), dtype=np.int32)
    for k, lane in enumerate(dealt):
        at = 0
        for number in lane:
            words = documents[number]
            after[at: at + len(words), k] = words
            before[at + 1: at + len(words), k] = words[:-1]
            owner[at: at + len(words), k] = number
            at += len(words)
    return before, after, owner, lengths


def score(w: Weights, documents: list[np.ndarray]) -> np.ndarray:
    """Natural log of each document's probability, its rare words as classes only; the state runs through all of it."""
    start, gates, output = len(w.inputs) - 1, _recurrent(w), _output_rows(w)
    before, after, owner, lengths = _dealt(documents, LANES, start)
    total = np.zeros(len(documents))
    state = np.zeros((before.shape[1], HIDDEN), dtype=np.float32)
    for first in range(0, len(before), SCORE_STEPS):
        last = min(first + SCORE_STEPS, len(before))
        live = int((lengths > first).sum())
        state = state[:live].copy()
        states, new, y = np.empty((last - first, live, HIDDEN), dtype=np.float32), np.empty_like(state), np.empty(
            (3, live, HIDDEN), dtype=np.float32)
        rows = before[first:last, :live]
        inputs = _entered(w.inputs, rows, np.empty((3, *rows.shape, HIDDEN), dtype=np.float32))
        for t, beginning in enumerate(_beginners(rows, start)):
            if len(beginning):
                state[beginning] = 0
            state[:] = _cell(gates, inputs[:, t], state, y, new, states[t])
        inside = np.arange(first, last)[:, None] < lengths[:live]
        classes, ids = targets(after[first:last, :live][inside], w)
        got = _log_probabilities(w, output, states[inside], classes, ids)
        total += np.bincount(owner[first:last, :live][inside], got, len(total))
    return total


class Trainer:
    """Adagrad over truncated windows; states carry over from one window to the next, gradients do not."""

    def __init__(self, weights: Weights) -> None:
        self.w = weights.like(weights.flat())
        self.seen = {k: np.full(v.shape, 1e-2, dtype=np.float32) for k, v in vars(self.w).items()}
        self.tokens = 0
        self.rooms: dict[str, np.ndarray] = {}

    def learn(self, documents: list[np.ndarray]) -> int:
        """One pass over the documents; how many windows, and so steps, it took."""
        start = len(self.w.inputs) - 1
        before, after, _, lengths = _dealt(documents, LANES, start)
        state = np.zeros((before.shape[1], HIDDEN), dtype=np.float32)
        first = windows = 0
        while first < len(before):
            live = int((lengths > first).sum())
            last = min(first + STEPS, len(before))
            inside = np.arange(first, last)[:, None] < lengths[:live]
            state = self._window(before[first:last, :live], after[first:last, :live], inside, state[:live], start)
            self.tokens += int(inside.sum())
            first, windows = last, windows + 1
        return windows

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """An array of any content, the same memory for each window, since fresh pages cost time."""
        size = math.prod(shape)
        if name not in self.rooms or len(self.rooms[name]) < size:
            self.rooms[name] = np.empty(size, dtype=np.float32)
        return self.rooms[name][:size].reshape(shape)

    def _window(self, rows: np.ndarray, after: np.ndarray, inside: np.ndarray, state: np.ndarray, start: int) -> np.ndarray:
        w, wide, gates, beginners = self.w, (*rows.shape, HIDDEN), _recurrent(self.w), _beginners(rows, start)
        inputs = _entered(w.inputs, rows, self._room("inputs", 3, *wide))
        entering, stacked, new, error, slopes, stay, to_new = (self._room(name, *wide) for name in (
            "entering", "stacked", "new", "error", "slopes", "stay", "to_new"))
        y, factors = self._room("y", 3, *wide), self._room("factors", 3, *wide)
        for t, beginning in enumerate(beginners):
            entering[t] = state
            if len(beginning):
                entering[t, beginning] = 0
            state = _cell(gates, inputs[:, t], entering[t], y[:, t], new[t], stacked[t])
        update, reset, own = y
        classes, ids = targets(after[inside], w)
        if inside.all():
            self._output(stacked.reshape(-1, HIDDEN), classes, ids, error.reshape(-1, HIDDEN))
        else:
            error[:] = 0
            error[inside] = self._output(stacked[inside], classes, ids, np.empty((len(ids), HIDDEN), dtype=np.float32))
        # What the slope in a state is multiplied by, for each gate.
        np.subtract(1, update, out=stay)
        np.multiply(new, new, out=to_new)
        np.subtract(1, to_new, out=to_new)
        to_new *= stay
        np.subtract(entering, new, out=factors[0])
        factors[0] *= update
        factors[0] *= stay
        np.multiply(to_new, reset, out=factors[2])
        np.subtract(1, reset, out=factors[1])
        factors[1] *= own
        factors[1] *= factors[2]
        through, parts = factors, self._room("parts", 4, *state.shape)
        slope, back = np.zeros_like(state), w.gates.reshape(HIDDEN, 3, HIDDEN).transpose(1, 2, 0).copy()
        for t in range(len(rows) - 1, -1, -1):
            np.add(slope, error[t], out=slopes[t])
            through[:, t] *= slopes[t]
            np.matmul(through[:, t], back, out=parts[:3])
            np.multiply(slopes[t], update[t], out=parts[3])
            np.add.reduce(parts, axis=0, out=slope)
            if len(beginners[t]):
                slope[beginners[t]] = 0
        gates = entering.reshape(-1, HIDDEN).T @ through.reshape(3, -1, HIDDEN)
        np.multiply(slopes, to_new, out=through[2])
        order = np.argsort(rows.ravel().astype(np.uint16), kind="stable") if len(w.inputs) <= 1 << 16 else np.argsort(
            rows.ravel(), kind="stable")
        flat = self._room("flat", rows.size, 3, HIDDEN)
        through.reshape(-1, HIDDEN).take(order[:, None] + rows.size * np.arange(3), axis=0, out=flat, mode="clip")
        entry = rows.ravel()[order]
        heads = np.flatnonzero(np.diff(entry, prepend=-1))
        used = entry[heads]
        self._apply("gates", gates.transpose(1, 0, 2).reshape(HIDDEN, 3 * HIDDEN))
        self._apply("inputs", np.add.reduceat(flat.reshape(-1, 3 * HIDDEN), heads, axis=0), used)
        return state

    def _output(self, hidden: np.ndarray, classes: np.ndarray, ids: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Takes a step on the output rows; the loss's slope in the states, in `out`."""
        places, (by_class, by_member) = _Places(self.w, hidden, classes, ids), _output_rows(self.w)
        back, bounded = self._room("back", *hidden.shape), _bounded(by_class)
        across = np.zeros_like(by_class)
        for at in places.pieces:
            p = places.states[at] @ by_class.T
            shared = self._slopes(p, bounded, places.classes[at])
            np.multiply(p @ by_class[:, :HIDDEN], shared, out=back[at])
            across += p.T @ (places.states[at] * shared)
        q = _member_logits(places, by_member, self._room("members", places.head, MEMBERS))
        members = np.zeros_like(by_member)
        shared = self._slopes(q, _bounded(by_member), places.members)
        weighted, inner = places.states[: places.head] * shared, self._room("inner", places.head, HIDDEN)
        for c, at in places.spans:
            np.matmul(q[at].T, weighted[at], out=members[c])
            np.matmul(q[at], by_member[c, :, :HIDDEN], out=inner[at])
        inner *= shared
        back[: places.head] += inner
        members = members.reshape(-1, HIDDEN + 1)
        self._apply("classes", across[:, :HIDDEN].T.copy())
        self._apply("class_bias", across[:, HIDDEN].copy())
        self._apply("members", members[:, :HIDDEN].copy())
        self._apply("member_bias", members[:, HIDDEN].copy())
        out[places.order] = back
        return out

    @staticmethod
    def _slopes(logits: np.ndarray, bounded: bool, chosen: np.ndarray) -> np.ndarray:
        """Logits become the loss's slopes in them, but for a factor of each row, which is returned."""
        total, _ = _exponentials(logits, bounded, chosen)
        logits[np.arange(len(logits)), chosen] -= total
        return (np.float32(1 / LANES) / total)[:, None]

    def _apply(self, name: str, slope: np.ndarray, at: np.ndarray | slice = slice(None)) -> None:
        np.clip(slope, -CLIP, CLIP, out=slope)
        seen, value = self.seen[name], getattr(self.w, name)
        root = seen[at] + slope * slope
        seen[at] = root
        np.sqrt(root, out=root)
        slope *= LEARNING_RATE
        slope /= root
        value[at] -= slope
