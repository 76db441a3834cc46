"""Character-level bidirectional LSTM with a CRF over its labels, in numpy.

Characters come as classes (every ASCII sign its own, digits, lower and upper letters, the rest), a
class indexes a table of gate inputs per direction. Labels are O, and begin and inside of each kind.
Windows are arrays of equal length, padded with a class of its own; all arrays run (time, window).
"""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone", "secret")
LABELS = 1 + 2 * len(KINDS)
OTHER, PAD, CLASSES = 128, 129, 130
HIDDEN, EPOCHS, BATCH, RATE, SEED = 20, 10, 48, 0.01, 7

_CLASS = np.arange(129, dtype=np.uint8)
for _low, _high in (("0", "9"), ("a", "z"), ("A", "Z")):
    _CLASS[ord(_low): ord(_high) + 1] = ord(_low)


def begin_label(kind: int) -> int:
    return 1 + 2 * kind


def classes(text: str) -> np.ndarray:
    """Class of every code point."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASS[np.minimum(codes, OTHER)]


#: No inside without its begin or inside before it.
_ALLOWED = np.ones((LABELS, LABELS), bool)
for _k in range(len(KINDS)):
    _ALLOWED[:, begin_label(_k) + 1] = False
    _ALLOWED[[begin_label(_k), begin_label(_k) + 1], begin_label(_k) + 1] = True
_FIRST = np.array([label == 0 or label % 2 == 1 for label in range(LABELS)])


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _logsum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Tagger:
    def __init__(self, hidden: int = HIDDEN, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.hidden = hidden

        def normal(*shape):
            return (draw.standard_normal(shape) * 0.2).astype(np.float32)

        self.p = {f"{name}_{way}": normal(*shape) for way in ("on", "back") for name, shape in (
            ("table", (CLASSES, 4 * hidden)), ("again", (hidden, 4 * hidden)), ("out", (hidden, LABELS)))}
        for way in ("on", "back"):
            self.p[f"table_{way}"][:, hidden: 2 * hidden] += 1.0  # forget gates start open
        self.p |= {"bias": np.zeros(LABELS, np.float32), "steps": np.zeros((LABELS, LABELS), np.float32), "first": np.zeros(LABELS, np.float32)}

    def _run(self, x: np.ndarray, way: str, keep: bool):
        """Hidden states of one direction; with what the way back needs, if asked."""
        h = self.hidden
        table, again = self.p[f"table_{way}"], self.p[f"again_{way}"]
        state, cell = (np.zeros((x.shape[1], h), np.float32) for _ in range(2))
        states, kept = np.empty((*x.shape, h), np.float32), []
        for t in range(len(x)) if way == "on" else range(len(x) - 1, -1, -1):
            a = table[x[t]] + state @ again
            gates, new = _sigmoid(a[:, : 3 * h]), np.tanh(a[:, 3 * h:])
            before, cell = cell, gates[:, h: 2 * h] * cell + gates[:, :h] * new
            squashed = np.tanh(cell)
            if keep:
                kept.append((t, state, before, gates, new, squashed))
            state = gates[:, 2 * h:] * squashed
            states[t] = state
        return states, kept

    def _learn_run(self, x, way, kept, slope, grads):
        """Backpropagate slope (of the hidden states) through one direction."""
        h = self.hidden
        again = self.p[f"again_{way}"]
        inputs = np.empty((*x.shape, 4 * h), np.float32)
        d_again = np.zeros_like(again)
        d_state, d_cell = (np.zeros((x.shape[1], h), np.float32) for _ in range(2))
        for t, state, before, gates, new, squashed in reversed(kept):
            i, f, o = gates[:, :h], gates[:, h: 2 * h], gates[:, 2 * h:]
            d_state = d_state + slope[t]
            d_cell = d_cell + d_state * o * (1 - squashed ** 2)
            a = np.concatenate([d_cell * new * i * (1 - i), d_cell * before * f * (1 - f),
                                d_state * squashed * o * (1 - o), d_cell * i * (1 - new ** 2)], 1)
            inputs[t] = a
            d_again += state.T @ a
            d_state, d_cell = a @ again.T, d_cell * f
        grads[f"again_{way}"] = d_again
        own = x.reshape(-1)
        order = np.argsort(own, kind="stable")
        found, first = np.unique(own[order], return_index=True)
        grads[f"table_{way}"] = table = np.zeros((CLASSES, 4 * h), np.float32)
        table[found] = np.add.reduceat(inputs.reshape(-1, 4 * h)[order], first)

    def _emissions(self, x, keep=False):
        on, kept_on = self._run(x, "on", keep)
        back, kept_back = self._run(x, "back", keep)
        return on @ self.p["out_on"] + back @ self.p["out_back"] + self.p["bias"], (on, kept_on), (back, kept_back)

    def _step(self, x, y):
        """Gradients of the mean negative log-likelihood of labels y."""
        e, (on, kept_on), (back, kept_back) = self._emissions(x, keep=True)
        steps, n = self.p["steps"], x.shape[1]
        ahead, after = np.empty_like(e), np.zeros_like(e)
        ahead[0] = self.p["first"] + e[0]
        for t in range(1, len(x)):
            ahead[t] = e[t] + _logsum(ahead[t - 1][:, :, None] + steps, 1)
        for t in range(len(x) - 2, -1, -1):
            after[t] = _logsum(steps + (e[t + 1] + after[t + 1])[:, None, :], 2)
        total = _logsum(ahead[-1], 1)
        slope = np.exp(ahead + after - total[None, :, None])
        both = np.zeros_like(steps)
        for t in range(1, len(x)):
            both += np.exp(ahead[t - 1][:, :, None] + steps + (e[t] + after[t] - total[:, None])[:, None, :]).sum(0)
        np.subtract.at(both, (y[:-1].reshape(-1), y[1:].reshape(-1)), 1)
        rows = np.arange(x.size)
        slope.reshape(-1, LABELS)[rows, y.reshape(-1)] -= 1
        slope /= n
        grads = {"steps": both / n, "first": slope[0].sum(0), "bias": slope.sum((0, 1))}
        for way, states, kept in (("on", on, kept_on), ("back", back, kept_back)):
            grads[f"out_{way}"] = np.einsum("tbh,tbk->hk", states, slope)
            self._learn_run(x, way, kept, slope @ self.p[f"out_{way}"].T, grads)
        return grads

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE) -> Tagger:
        """Learn from windows x and labels y, both (window, time), by Adam."""
        draw = np.random.default_rng(SEED)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        count, rounds = 0, epochs * -(-len(x) // batch)
        for _ in range(epochs):
            order = draw.permutation(len(x))
            for some in (order[i: i + batch] for i in range(0, len(x), batch)):
                grads = self._step(x[some].T, y[some].T.astype(np.int64))
                norm = np.sqrt(sum(float((g ** 2).sum()) for g in grads.values()))
                count += 1
                speed = rate * (1 - 0.9 * count / rounds) * np.sqrt(1 - 0.999 ** count) / (1 - 0.9 ** count)
                for k, g in grads.items():
                    g = g * min(1.0, 20.0 / (norm + 1e-9))
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g ** 2 - v)
                    self.p[k] -= (speed * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
        return self

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Most likely allowed labels of windows (window, time)."""
        x = x.T
        e, _, _ = self._emissions(x)
        steps = np.where(_ALLOWED, self.p["steps"], -1e4)
        best, come = np.where(_FIRST, self.p["first"], -1e4) + e[0], np.empty(e.shape, np.int8)
        for t in range(1, len(x)):
            ways = best[:, :, None] + steps
            come[t] = ways.argmax(1)
            best = ways.max(1) + e[t]
        labels = np.empty(x.shape, np.int8)
        labels[-1] = best.argmax(1)
        for t in range(len(x) - 1, 0, -1):
            labels[t - 1] = np.take_along_axis(come[t], labels[t][:, None].astype(np.int64), 1)[:, 0]
        return labels.T
