"""A bidirectional gated recurrent network over bytes, in numpy.

It labels every position of fixed windows of bytes. Arrays hold features first
and sequences last, so that the gates are whole rows.
"""

from __future__ import annotations

import io
from typing import NamedTuple

import numpy as np

BLANK = 0x20


class Direction(NamedTuple):
    """Input weights by byte (with the biases), and recurrent weights, of update, reset and candidate."""

    by_byte: np.ndarray  # 3H x 256
    again: np.ndarray  # 3H x H


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x += np.float32(1)
    x *= np.float32(0.5)
    return x


def _states(side: Direction, steps, inputs: np.ndarray, out: np.ndarray) -> None:
    """Fill ``out`` (T x H x B) with the states, in the order of ``steps``."""
    units = side.again.shape[1]
    state = np.zeros(out.shape[1:], np.float32)
    summed = np.empty((3 * units, out.shape[2]), np.float32)
    inner = np.empty_like(summed)
    for t in steps:
        np.take(side.by_byte, inputs[t], axis=1, out=summed, mode="clip")
        np.matmul(side.again, state, out=inner)
        gates, new = summed[: 2 * units], summed[2 * units :]
        gates += inner[: 2 * units]
        update, reset = np.split(_sigmoid(gates), 2)
        reset *= inner[2 * units :]
        new += reset
        np.tanh(new, out=new)
        state -= new
        state *= update
        state += new
        out[t] = state


class BiGru(NamedTuple):
    """Weights of both directions and of the labels, and what the labels stand for."""

    forward: Direction
    backward: Direction
    out: np.ndarray  # K x 2H
    bias: np.ndarray  # K x 1
    labels: list[str]

    def probabilities(self, inputs: np.ndarray) -> np.ndarray:
        """K x T x B label probabilities of T x B bytes (as intp)."""
        length, batch = inputs.shape
        units = self.forward.again.shape[1]
        states = np.empty((length, 2 * units, batch), np.float32)
        _states(self.forward, range(length), inputs, states[:, :units])
        _states(self.backward, reversed(range(length)), inputs, states[:, units:])
        scores = np.matmul(self.out, states)
        scores += self.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores.transpose(1, 0, 2)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(
            out,
            a=self.forward.by_byte,
            b=self.forward.again,
            c=self.backward.by_byte,
            d=self.backward.again,
            e=self.out,
            f=self.bias,
            labels=np.array(self.labels, dtype=str),
        )
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> BiGru:
        got = np.load(io.BytesIO(data))
        a, b, c, d, e, f = (got[k] for k in "abcdef")
        return cls(Direction(a, b), Direction(c, d), e, f, got["labels"].tolist())


def _run(side: Direction, steps: list[int], inputs: np.ndarray):
    """States and all that the way back needs, by step."""
    units, batch = side.again.shape[1], inputs.shape[1]
    state = np.zeros((units, batch), np.float32)
    states, memory = np.empty((len(steps), units, batch), np.float32), []
    for t in steps:
        inner = side.again @ state
        summed = side.by_byte[:, inputs[t]]
        gates = _sigmoid(summed[: 2 * units] + inner[: 2 * units])
        update, reset, held = gates[:units], gates[units:], inner[2 * units :]
        new = np.tanh(summed[2 * units :] + reset * held)
        memory.append((state, update, reset, held, new))
        state = new + update * (state - new)
        states[t] = state
    return states, memory


def _back(side: Direction, steps: list[int], inputs, memory, slope: np.ndarray) -> Direction:
    """Gradients of a direction's weights, through time, from those of its states."""
    units = side.again.shape[1]
    again = np.zeros_like(side.again)
    to_input = np.empty((len(steps), 3 * units, inputs.shape[1]), np.float32)
    carry = np.zeros(slope.shape[1:], np.float32)
    for t, (state, update, reset, held, new) in zip(reversed(steps), reversed(memory), strict=True):
        carry = carry + slope[t]
        d_new = carry * (1 - update) * (1 - new * new)
        d_update = carry * (state - new) * update * (1 - update)
        d_reset = d_new * held * reset * (1 - reset)
        inner = np.concatenate([d_update, d_reset, d_new * reset])
        again += inner @ state.T
        carry = carry * update + side.again.T @ inner
        to_input[t, : 2 * units] = inner[: 2 * units]
        to_input[t, 2 * units :] = d_new
    rows = to_input.transpose(1, 0, 2).reshape(3 * units, -1)
    flat = inputs.reshape(-1)
    by_byte = np.stack([np.bincount(flat, row, 256) for row in rows]).astype(np.float32)
    return Direction(by_byte, again)


def train(
    windows: np.ndarray,
    labels: np.ndarray,
    names: list[str],
    units: int = 8,
    rounds: int = 300,
    batch: int = 256,
    rate: float = 0.02,
    seed: int = 11,
) -> BiGru:
    """Fit a network to N x T windows of bytes, each with the number of its label.

    Cross entropy at every position, backpropagated through time; Adam steps with
    a rate that falls to a tenth. Windows are drawn with equal chances per label.
    """
    rng = np.random.default_rng(seed)
    spread = 1 / np.sqrt(units)

    def start(*shape: int) -> np.ndarray:
        return rng.uniform(-spread, spread, shape).astype(np.float32)

    weights = [start(3 * units, 256), start(3 * units, units), start(3 * units, 256)]
    weights += [start(3 * units, units), start(len(names), 2 * units)]
    weights += [np.zeros((len(names), 1), np.float32)]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    groups = [np.flatnonzero(labels == k) for k in range(len(names))]
    length = windows.shape[1]
    ahead, behind = list(range(length)), list(reversed(range(length)))
    for step in range(1, rounds + 1):
        kind = rng.integers(0, len(names), batch)
        chosen = np.array([groups[k][rng.integers(len(groups[k]))] for k in kind])
        inputs = windows[chosen].T.astype(np.intp)
        sides = Direction(*weights[:2]), Direction(*weights[2:4])
        forward, seen = _run(sides[0], ahead, inputs)
        backward, seen_back = _run(sides[1], behind, inputs)
        states = np.concatenate([forward, backward], axis=1)
        scores = weights[4] @ states + weights[5]
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        slope = scores / scores.sum(axis=1, keepdims=True)
        slope[:, kind, np.arange(batch)] -= 1
        slope /= length * batch
        to_states = weights[4].T @ slope
        d_out = np.einsum("tkb,thb->kh", slope, states, optimize=True)
        d_bias = slope.sum(axis=(0, 2))[:, None]
        one = _back(sides[0], ahead, inputs, seen, to_states[:, :units])
        two = _back(sides[1], behind, inputs, seen_back, to_states[:, units:])
        now = rate * (1 - 0.9 * step / rounds)
        for i, slope_i in enumerate((*one, *two, d_out, d_bias)):
            first[i] += 0.1 * (slope_i - first[i])
            second[i] += 0.01 * (slope_i * slope_i - second[i])
            move = (first[i] / (1 - 0.9**step)) / (
                np.sqrt(second[i] / (1 - 0.99**step)) + np.float32(1e-8)
            )
            weights[i] -= np.float32(now) * move.astype(np.float32)
    a, b, c, d, e, f = weights
    return BiGru(Direction(a, b), Direction(c, d), e, f, names)
