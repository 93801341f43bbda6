"""A small gated recurrent network over word ids in numpy: class-factored softmax, truncated backpropagation.

Documents lie end to end in lanes, which run side by side; a lane's state is carried from window to window and is
zero where a document starts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Width of the state.
HIDDEN = 16
#: Lanes and steps of a window where documents are scored, and where the network learns.
LANES, STEPS = 256, 32
TRAIN_LANES, TRAIN_STEPS = 256, 16
#: Longest part of a document that a lane learns from at a time; the next part starts from a zero state.
TRAIN_PART = 2048
#: Logits are held at most here, so that their exponentials stay finite.
HIGHEST = 60
#: Learning rate, and the squared gradient that every weight starts with.
RATE, START = 0.08, 1e-6


@dataclass(frozen=True)
class Output:
    """Where the targets' probabilities come from.

    Targets from 0 to len(bias) - 1 have logits of their own within their class; class c holds those from edges[c] to
    edges[c + 1] - 1, and classes beyond len(edges) - 1 are single targets of their own. prior: log share of each class;
    bias: log share of each target in its class. Both are counts of the corpus, and are not learnt.
    """

    edges: np.ndarray
    prior: np.ndarray
    bias: np.ndarray

    @property
    def targets(self) -> int:
        return len(self.bias) + len(self.prior) - (len(self.edges) - 1)

    def classes(self) -> np.ndarray:
        """Class of every target."""
        n = len(self.edges) - 1
        return np.concatenate([np.repeat(np.arange(n), np.diff(self.edges)), np.arange(n, len(self.prior))]).astype(np.int32)


def fresh(out: Output, hidden: int, seed: int = 11) -> dict[str, np.ndarray]:
    """Weights that give every target its share of the corpus. Targets are the inputs, too."""
    rng = np.random.default_rng(seed)
    return {"table": rng.normal(0, 0.3, (out.targets, 3 * hidden)).astype(np.float32), "state": rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32),
            "shift": np.zeros(hidden, dtype=np.float32), "class": np.zeros((hidden, len(out.prior)), dtype=np.float32), "word": np.zeros((hidden, len(out.bias)), dtype=np.float32)}


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in sorted(weights)])


def shaped(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    made, at = {}, 0
    for k in sorted(like):
        made[k] = values[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return made


@dataclass
class Lanes:
    """Documents end to end in lanes, the longest lane first. ids: all lanes' ids; fresh: where a document starts."""

    ids: np.ndarray
    fresh: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    order: np.ndarray  # documents in the order that they lie in
    bounds: np.ndarray  # where each of them starts


def in_lanes(ids: np.ndarray, bounds: np.ndarray, lanes: int) -> Lanes:
    """Every document (ids from one bound to the next, none empty) goes to the lane that is shortest, long documents first."""
    sizes = np.diff(bounds)
    heap = [(0, k) for k in range(min(lanes, len(sizes)))]
    held: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-sizes, kind="stable").tolist():
        total, k = heapq.heappop(heap)
        held[k].append(d)
        heapq.heappush(heap, (total + int(sizes[d]), k))
    held.sort(key=lambda ds: -sum(int(sizes[d]) for d in ds))
    order = np.array([d for ds in held for d in ds], dtype=np.int64)
    ends = np.cumsum(sizes[order])
    at = ends - sizes[order]
    moved = np.arange(len(ids)) + np.repeat(bounds[order] - at, sizes[order])
    first = np.zeros(len(ids), dtype=bool)
    first[at] = True
    lane_sizes = np.array([sum(int(sizes[d]) for d in ds) for ds in held], dtype=np.int64)
    return Lanes(ids[moved], first, np.cumsum(lane_sizes) - lane_sizes, lane_sizes, order, at)


class Net:
    """end: the id that ends documents, which also stands before their first word."""

    def __init__(self, out: Output, weights: dict[str, np.ndarray], end: int = 0):
        self.out, self.w, self.end, self.class_of = out, weights, end, out.classes()
        self.sums = {k: np.full_like(v, START) for k, v in weights.items()}

    def windows(self, lanes: Lanes, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of each window: places in lanes.ids, whether they are real, inputs, and whether a document starts; (steps, lanes)."""
        for t in range(0, int(lanes.sizes[0]) if len(lanes.sizes) else 0, steps):
            n = int(np.searchsorted(-lanes.sizes, -t))
            width = min(steps, int(lanes.sizes[0]) - t)
            step = np.arange(t, t + width)[:, None]
            real = step < lanes.sizes[:n]
            places = np.where(real, lanes.starts[:n] + step, lanes.starts[:n])
            starts = lanes.fresh[places] & real
            inputs = np.where(starts | ~real, self.end, lanes.ids[places - 1])
            yield places, real, inputs, starts

    def forward(self, h: np.ndarray, inputs: np.ndarray, starts: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States after each step (steps, lanes, hidden), and what backward needs."""
        steps, n = inputs.shape
        k = h.shape[1]
        given = self.w["table"][inputs]
        states, kept = np.empty((steps, n, k), dtype=np.float32), []
        resets: dict[int, list[int]] = {}
        for t, lane in zip(*map(np.ndarray.tolist, np.nonzero(starts)), strict=True):
            resets.setdefault(t, []).append(lane)
        for t in range(steps):
            if t in resets:
                h = h.copy()
                h[resets[t]] = 0
            own = h @ self.w["state"]
            g = given[t]
            gates = g[:, : 2 * k] + own[:, : 2 * k]
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            z, r = gates[:, :k], gates[:, k:]
            inner = own[:, 2 * k :] + self.w["shift"]
            new = r * inner
            new += g[:, 2 * k :]
            np.tanh(new, out=new)
            after = states[t]
            np.subtract(h, new, out=after)
            after *= z
            after += new
            if keep:
                kept.append((h, z, r, inner, new, resets.get(t)))
            h = after
        return states, kept

    def log_shares(self, states: np.ndarray, targets: np.ndarray, learn: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of each target given its state; with learn, weights of the output move, and the states' gradients come back."""
        own = self.class_of[targets]
        logits = states @ self.w["class"]
        logits += self.out.prior
        np.minimum(logits, HIGHEST, out=logits)
        rows = np.arange(len(targets))
        at = logits[rows, own]
        np.exp(logits, out=logits)
        total = logits @ np.ones(logits.shape[1], dtype=np.float32)
        found = at - np.log(total)
        back = None
        if learn:
            logits /= total[:, None]
            logits[rows, own] -= 1
            back = logits @ self.w["class"].T
            self.move("class", states.T @ logits, len(targets))
        gone = np.zeros_like(self.w["word"]) if learn else None
        order = np.argsort(own, kind="stable")
        cuts = np.searchsorted(own[order], np.arange(len(self.out.edges)))
        for c in range(len(self.out.edges) - 1):
            some = order[cuts[c] : cuts[c + 1]]
            a, b = int(self.out.edges[c]), int(self.out.edges[c + 1])
            if len(some) == 0 or b - a < 2:
                continue
            h = states[some]
            inner = h @ self.w["word"][:, a:b]
            inner += self.out.bias[a:b]
            np.minimum(inner, HIGHEST, out=inner)
            place, every = targets[some] - a, np.arange(len(some))
            at = inner[every, place]
            np.exp(inner, out=inner)
            total = inner @ np.ones(b - a, dtype=np.float32)
            found[some] += at - np.log(total)
            if learn:
                inner /= total[:, None]
                inner[every, place] -= 1
                back[some] += inner @ self.w["word"][:, a:b].T
                gone[:, a:b] = h.T @ inner
        if learn:
            self.move("word", gone, len(targets))
        return found, back

    def move(self, name: str, gradient: np.ndarray, n: int, rows: np.ndarray | None = None) -> None:
        """An AdaGrad step against the mean gradient of n targets; rows: of these rows only."""
        gradient = gradient / np.float32(n)
        if rows is None:
            self.sums[name] += gradient * gradient
            self.w[name] -= RATE * gradient / np.sqrt(self.sums[name])
        else:
            s = self.sums[name][rows] + gradient * gradient
            self.sums[name][rows] = s
            self.w[name][rows] -= RATE * gradient / np.sqrt(s)

    def backward(self, kept: list, ahead: np.ndarray, inputs: np.ndarray, n: int) -> None:
        """ahead: gradients of the states from the outputs."""
        k = ahead.shape[2]
        given, own = np.empty((*inputs.shape, 3 * k), dtype=np.float32), np.empty((*inputs.shape, 3 * k), dtype=np.float32)
        dh = np.zeros_like(ahead[0])
        for t in range(len(kept) - 1, -1, -1):
            h, z, r, inner, new, reset = kept[t]
            dh = dh + ahead[t]
            at = given[t]
            np.multiply(dh * (h - new), z * (1 - z) * 2, out=at[:, :k])  # gates are halves of tanh: twice their slope
            np.multiply(dh * (1 - z), 1 - new * new, out=at[:, 2 * k :])
            np.multiply(at[:, 2 * k :] * inner, r * (1 - r) * 2, out=at[:, k : 2 * k])
            own[t] = at
            own[t, :, 2 * k :] *= r
            dh = dh * z + own[t] @ self.w["state"].T
            if reset is not None:
                dh[reset] = 0
        before = np.stack([x[0] for x in kept]).reshape(-1, k)
        own = own.reshape(-1, 3 * k)
        ids = inputs.ravel()
        order = np.argsort(ids, kind="stable")
        rows, first = np.unique(ids[order], return_index=True)
        self.move("table", np.add.reduceat(given.reshape(-1, 3 * k)[order], first, axis=0), n, rows)
        self.move("state", before.T @ own, n)
        self.move("shift", own[:, 2 * k :].sum(axis=0), n)

    def learn(self, ids: np.ndarray, bounds: np.ndarray) -> None:
        """One pass over documents."""
        parts = np.unique(np.concatenate([bounds, *[np.arange(a, b, TRAIN_PART) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True) if b - a > TRAIN_PART]]))
        lanes = in_lanes(ids, parts, TRAIN_LANES)
        h = np.zeros((len(lanes.sizes), self.w["state"].shape[0]), dtype=np.float32)
        for places, real, inputs, starts in self.windows(lanes, TRAIN_STEPS):
            states, kept = self.forward(h[: real.shape[1]], inputs, starts, True)
            h = states[-1]
            ahead = np.zeros_like(states)
            _, ahead[real] = self.log_shares(states[real], lanes.ids[places[real]], True)
            self.backward(kept, ahead, inputs, int(real.sum()))

    def score(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Natural log probability of each whole document; its last id has to be the end."""
        lanes = in_lanes(ids, bounds, LANES)
        found = np.zeros(len(ids), dtype=np.float64)
        h = np.zeros((len(lanes.sizes), self.w["state"].shape[0]), dtype=np.float32)
        for places, real, inputs, starts in self.windows(lanes, STEPS):
            states, _ = self.forward(h[: real.shape[1]], inputs, starts, False)
            h = states[-1]
            found[places[real]] = self.log_shares(states[real], lanes.ids[places[real]], False)[0]
        out = np.zeros(len(bounds) - 1)
        if len(out):
            out[lanes.order] = np.add.reduceat(found, lanes.bounds)
        return out
