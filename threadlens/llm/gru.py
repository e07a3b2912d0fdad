"""A small bidirectional gated recurrent network over bytes, trained by backpropagation through time, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Byte value that stands before and behind a word.
EDGE = 0


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words with an edge on both sides as rows of bytes, and their lengths."""
    lengths = np.array([len(w) + 2 for w in words])
    rows = np.zeros((len(words), int(lengths.max())), np.uint8)
    for i, w in enumerate(words):
        rows[i, 1 : len(w) + 1] = np.frombuffer(w, np.uint8)
    return rows, lengths


def turned(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each row (first axis) reversed within its length."""
    at = lengths[:, None] - 1 - np.arange(rows.shape[1])[None, :]
    at = np.where(at >= 0, at, np.arange(rows.shape[1])[None, :])
    return rows[np.arange(len(rows))[:, None], at]


@dataclass
class Direction:
    """One gated recurrent layer: input weights of each byte and recurrent weights, for the gates z, r and the state n."""

    given: np.ndarray  # 256 x 3H
    again: np.ndarray  # H x 3H

    def forward(self, rows: np.ndarray, keep: bool = False):
        n, steps, size = len(rows), rows.shape[1], self.again.shape[0]
        state, out, memory = np.zeros((n, size), self.given.dtype), np.empty((n, steps, size), self.given.dtype), []
        for t in range(steps):
            x, u = self.given[rows[:, t]], state @ self.again
            gates = sigmoid(x[:, : 2 * size] + u[:, : 2 * size])
            z, r = gates[:, :size], gates[:, size:]
            new = np.tanh(x[:, 2 * size :] + r * u[:, 2 * size :])
            if keep:
                memory.append((state, z, r, new, u[:, 2 * size :]))
            state = new + z * (state - new)
            out[:, t] = state
        return out, memory

    def backward(self, rows: np.ndarray, memory: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of both weights, given those of every state."""
        size = self.again.shape[0]
        d_given, d_again, d_state = np.zeros_like(self.given), np.zeros_like(self.again), np.zeros_like(d_out[:, 0])
        for t in range(rows.shape[1] - 1, -1, -1):
            before, z, r, new, un = memory[t]
            d = d_out[:, t] + d_state
            d_new = d * (1 - z) * (1 - new**2)
            d_z = d * (before - new) * z * (1 - z)
            d_r = d_new * un * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_new], axis=1)
            d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
            np.add.at(d_given, rows[:, t], d_x)
            d_again += before.T @ d_u
            d_state = d * z + d_u @ self.again.T
        return d_given, d_again


@dataclass
class Network:
    ahead: Direction
    back: Direction
    weights: np.ndarray  # 2H x classes
    bias: np.ndarray

    @classmethod
    def fresh(cls, classes: int, size: int, seed: int, dtype=np.float32) -> Network:
        rng = np.random.default_rng(seed)
        make = lambda *shape: (rng.normal(size=shape) / np.sqrt(size)).astype(dtype)
        return cls(Direction(make(256, 3 * size), make(size, 3 * size)), Direction(make(256, 3 * size), make(size, 3 * size)), make(2 * size, classes), np.zeros(classes, dtype))

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.given, self.ahead.again, self.back.given, self.back.again, self.weights, self.bias]

    def positions(self, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log probabilities of the classes at every position."""
        ahead, _ = self.ahead.forward(rows)
        back, _ = self.back.forward(turned(rows, lengths))
        return log_softmax(np.concatenate([ahead, turned(back, lengths)], axis=2) @ self.weights + self.bias)

    def loss(self, rows: np.ndarray, lengths: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Weighted mean cross entropy of all positions, and its gradient for every parameter."""
        other = turned(rows, lengths)
        ahead, m1 = self.ahead.forward(rows, True)
        back, m2 = self.back.forward(other, True)
        states = np.concatenate([ahead, turned(back, lengths)], axis=2)
        logs = log_softmax(states @ self.weights + self.bias)
        share = (np.arange(rows.shape[1])[None, :] < lengths[:, None]) * weight[:, None]
        share = (share / share.sum()).astype(logs.dtype)
        who = np.arange(len(rows))
        d = np.exp(logs) * share[:, :, None]
        d[who, :, target] -= share
        size = ahead.shape[2]
        d_states = d @ self.weights.T
        # positions behind the end of a word turn into themselves, so turning twice gives the old order
        g1 = self.ahead.backward(rows, m1, d_states[:, :, :size])
        g2 = self.back.backward(other, m2, turned(d_states[:, :, size:], lengths))
        grads = [*g1, *g2, np.einsum("bth,btc->hc", states, d), d.sum(axis=(0, 1))]
        return -float((logs[who, :, target] * share).sum()), grads

    def train(self, words: list[bytes], target: np.ndarray, weight: np.ndarray, rounds: int, batch: int, rate: float, seed: int) -> None:
        """Adam over batches of words of like length, in an order fixed by the seed."""
        rng = np.random.default_rng(seed)
        length = np.array([len(w) for w in words])
        first, second = ([np.zeros_like(p) for p in self.parameters()] for _ in range(2))
        step, total = 0, rounds * -(-len(words) // batch)
        for _ in range(rounds):
            order = np.lexsort((rng.random(len(words)), length + rng.integers(0, 3, len(words))))
            parts = [order[i : i + batch] for i in range(0, len(order), batch)]
            for i in rng.permutation(len(parts)):
                rows, lengths = padded([words[j] for j in parts[i]])
                _, grads = self.loss(rows, lengths, target[parts[i]], weight[parts[i]])
                step += 1
                for p, g, m, v in zip(self.parameters(), grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= (rate * (1 - step / (total + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(p.dtype)


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))
