"""A small gated recurrent language model in numpy: truncated backpropagation and a class-factored softmax.

Tokens are numbers by falling frequency; ``END`` both ends a text and stands before it. The state is zero at the
beginning of a text and is carried from window to window. The probability of a token is that of its class,
times that of the token within the class.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

F32 = np.float32
#: Rows whose class logits are made at once, so that they stay in a core's cache.
BLOCK = 2048
#: Logits whose powers, and sums of them, are far from both ends of 32-bit numbers.
MOST_LOGIT = 60


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place; far below zero the power is infinite and the result 0, as it should be."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += F32(1)
    return np.reciprocal(x, out=x)


def _tanh(x: np.ndarray) -> np.ndarray:
    """In place, by the power, which costs half of ``np.tanh``."""
    x *= F32(2)
    _sigmoid(x)
    x *= F32(2)
    x -= F32(1)
    return x


def _softmax(logits: np.ndarray, chosen: np.ndarray, shift: bool, learn: bool) -> tuple[np.ndarray, np.ndarray] | None:
    """The logit of the ``chosen`` one of each column's rows and the sum of the powers of all; ``shift`` where powers may
    overflow. With ``learn``, the gradients of the negative log probabilities replace ``logits`` instead."""
    if shift:
        logits -= logits.max(axis=0)
    size, n = logits.shape
    flat, places = logits.reshape(-1), chosen * n + np.arange(n)
    picked = None if learn else flat.take(places)
    np.exp(logits, out=logits)
    total = np.ones(size, F32) @ logits
    if not learn:
        return picked, total
    logits /= total
    flat[places] = flat.take(places) - F32(1)
    return None


def class_bounds(counts: np.ndarray, classes: int) -> np.ndarray:
    """Where classes begin, of tokens sorted by frequency: about equal sums of the roots of their counts."""
    mass = np.cumsum(np.sqrt(counts))
    cuts = np.searchsorted(mass, mass[-1] * np.arange(1, classes) / classes) + 1
    return np.unique(np.concatenate([[0], np.minimum(cuts, len(counts)), [len(counts)]]))


@dataclass
class Gru:
    bounds: np.ndarray
    end: int
    #: Parameters: inputs by token (reset, update, candidate), recurrent weights, and weights of classes and tokens.
    p: dict[str, np.ndarray]

    def __post_init__(self) -> None:
        #: The class of each token.
        self.of = np.repeat(np.arange(len(self.bounds) - 1, dtype=np.int16), np.diff(self.bounds))

    @classmethod
    def new(cls, counts: np.ndarray, end: int, hidden: int = 16, classes: int = 48, seed: int = 7) -> Gru:
        """Starts at the frequencies of the tokens."""
        rng = np.random.default_rng(seed)
        n, bounds = len(counts), class_bounds(counts, classes)
        logs = np.log(counts + 1.0)
        sums = np.add.reduceat(counts + 1.0, bounds[:-1])
        normal = lambda *shape, by: (rng.standard_normal(shape) * by).astype(F32)
        p = {
            "x": normal(n, 3 * hidden, by=0.2),
            "u": normal(hidden, 2 * hidden, by=0.5 / np.sqrt(hidden)),
            "c": normal(hidden, hidden, by=0.5 / np.sqrt(hidden)),
            "wc": normal(hidden, len(sums), by=0.01),
            "bc": np.log(sums).astype(F32),
            "wo": normal(n, hidden, by=0.01),
            "bo": logs.astype(F32),
        }
        return cls(bounds, end, p)

    @property
    def hidden(self) -> int:
        return len(self.p["c"])

    def vector(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def with_vector(self, flat: np.ndarray) -> Gru:
        p, at = {}, 0
        for k in sorted(self.p):
            p[k] = flat[at : at + self.p[k].size].reshape(self.p[k].shape).astype(F32)
            at += self.p[k].size
        return Gru(self.bounds, self.end, p)

    def _gates(self) -> np.ndarray:
        """The recurrent weights of reset and update, one after the other: a view."""
        n = self.hidden
        return self.p["u"].reshape(n, 2, n).transpose(1, 0, 2)

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        """What tokens put into reset, update and candidate, in blocks of their own, so that numpy works on long runs."""
        return self.p["x"].reshape(-1, self.hidden).take(3 * x + np.arange(3)[:, None], axis=0)

    def _step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        g = self._inputs(x)
        gates = np.matmul(h, self._gates())
        gates += g[:2]
        r, z = _sigmoid(gates)
        c = (r * h) @ self.p["c"]
        c += g[2]
        _tanh(c)
        new = c - h
        new *= z
        new += h
        return new, r, z, c

    def _outputs(self, h: np.ndarray, y: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray | None, np.ndarray | None]:
        """Log probabilities of tokens ``y`` after states ``h``; with ``grads``, adds the gradients of their negative sum
        and returns those of the states instead. Rows are sorted by class, and logits have a column for each row, so that
        numpy works on long runs."""
        p, learn = self.p, grads is not None
        # States are within -1 and 1, so weights bound the logits.
        shift = max((np.abs(p["wc"]).sum(axis=0) + np.abs(p["bc"])).max(), (np.abs(p["wo"]) @ np.ones(self.hidden, F32) + np.abs(p["bo"])).max()) > MOST_LOGIT
        order = np.argsort(self.of[y], kind="stable")
        h, y = h.take(order, axis=0), y.take(order)
        of = self.of[y].astype(np.int64)
        cuts = np.searchsorted(of, np.arange(len(self.bounds)))
        # Logits of the tokens, and the sums that they are a part of, by class and within the class.
        picked, totals = np.zeros((2, len(y)), F32), np.ones((2, len(y)), F32)
        dsums, one = np.empty_like(h), np.ones(len(y), F32)
        for a in range(0, len(y), BLOCK):
            rows = slice(a, a + BLOCK)
            part = h[rows]
            logits = p["wc"].T @ part.T
            logits += p["bc"][:, None]
            found = _softmax(logits, of[rows], shift, learn)
            if not learn:
                picked[0, rows], totals[0, rows] = found
            else:
                grads["wc"] += (logits @ part).T
                grads["bc"] += logits @ one[: len(part)]
                dsums[rows] = logits.T @ p["wc"].T
        for k in np.flatnonzero((np.diff(self.bounds) > 1) & (np.diff(cuts) > 0)).tolist():
            a, b, rows = self.bounds[k], self.bounds[k + 1], slice(cuts[k], cuts[k + 1])
            part, w = h[rows], p["wo"][a:b]
            logits = w @ part.T
            logits += p["bo"][a:b, None]
            found = _softmax(logits, y[rows] - a, shift, learn)
            if not learn:
                picked[1, rows], totals[1, rows] = found
            else:
                grads["wo"][a:b] += logits @ part
                grads["bo"][a:b] += logits @ one[: len(part)]
                dsums[rows] += logits.T @ w
        if learn:
            dh = np.empty_like(dsums)
            dh[order] = dsums
            return None, dh
        out = np.empty_like(one)
        out[order] = (picked - np.log(totals)).sum(axis=0)
        return out, None

    @np.errstate(over="ignore")
    def score(self, texts: list[np.ndarray], window: int = 32, together: int = 1024, outputs: int = 8192) -> np.ndarray:
        """The log probability of each whole text, its end included. Texts of like length run side by side; a text
        that has ended leaves the front of the others. States wait until there are ``outputs`` of them for the
        softmax, however few texts are left."""
        out = np.zeros(len(texts))
        order = np.argsort([-len(t) for t in texts], kind="stable")
        states, targets, rows, waiting = [], [], [], 0

        def flush() -> None:
            nonlocal waiting
            if states:
                logs, _ = self._outputs(np.concatenate(states), np.concatenate(targets))
                out[:] += np.bincount(np.concatenate(rows), logs, len(texts))
            states.clear(), targets.clear(), rows.clear()
            waiting = 0

        for begin in range(0, len(order), together):
            some = order[begin : begin + together]
            lengths = np.array([len(texts[i]) + 1 for i in some])
            h = np.zeros((len(some), self.hidden), F32)
            last = np.full(len(some), self.end)
            # The texts, each with its end, which also stands for what comes after it.
            flat = np.concatenate([part for i in some for part in (texts[i], [self.end])]).astype(np.int64)
            ends = np.cumsum(lengths) - 1
            for start in range(0, lengths[0], window):
                live = int(np.searchsorted(-lengths, -start))
                steps = min(window, lengths[0] - start)
                at = (ends - lengths + 1 + start)[:live, None] + np.arange(steps)
                y = flat.take(np.minimum(at, ends[:live, None]))
                x = np.concatenate([last[:live, None], y[:, :-1]], axis=1)
                h = h[:live]
                # How many texts each step still has.
                left = np.searchsorted(-lengths[:live], -(start + np.arange(steps))).tolist()
                for t, n in enumerate(left):
                    if not n:
                        break
                    new = self._step(x[:n, t], h[:n])[0]
                    h = new if n == len(h) else np.concatenate([new, h[n:]])
                    states.append(new)
                    targets.append(y[:n, t])
                    rows.append(some[:n])
                    waiting += n
                    if waiting >= outputs:
                        flush()
                last = y[:, -1]
        flush()
        return out

    @np.errstate(over="ignore")
    def train(
        self, texts: list[np.ndarray], *, streams: int = 512, window: int = 16, rate: float = 0.15, seed: int = 3, squares: dict | None = None
    ) -> Gru:
        """One pass of truncated backpropagation over ``texts`` in streams side by side, by Adagrad. ``squares``, empty at first,
        carries Adagrad's sums from one call to the next."""
        rng = np.random.default_rng(seed)
        joined = [np.concatenate([[self.end], texts[i]]) for i in rng.permutation(len(texts))]
        tokens = np.concatenate([*joined, [self.end]]) if joined else np.zeros(0, np.int64)
        # At least eight steps of the optimiser, as long as a stream has one window.
        streams = int(max(1, min(streams, (len(tokens) - 1) // (8 * window))))
        length = (len(tokens) - 1) // streams
        if length < 1:
            return self
        model = Gru(self.bounds, self.end, {k: v.copy() for k, v in self.p.items()})
        p, n = model.p, self.hidden
        x = tokens[: streams * length].reshape(streams, length)
        y = tokens[1 : streams * length + 1].reshape(streams, length)
        squares = {} if squares is None else squares
        for k, v in p.items():
            squares.setdefault(k, np.full_like(v, 1e-2))
        grads = {k: np.zeros_like(v) for k, v in p.items() if k != "x"}
        h = np.zeros((streams, n), F32)
        for start in range(0, length, window):
            steps = min(window, length - start)
            inputs = np.ascontiguousarray(x[:, start : start + steps].T)
            # A new text begins at the zero state.
            alive = (inputs != self.end)[:, :, None].astype(F32)
            kept, states = [], []
            for t in range(steps):
                before = h * alive[t]
                h, r, z, c = model._step(inputs[t], before)
                kept.append((before, r, z, c))
                states.append(h)
            for g in grads.values():
                g.fill(0)
            _, dh = model._outputs(np.concatenate(states), y[:, start : start + steps].T.ravel(), grads)
            dh = dh.reshape(steps, streams, n)
            # What the gradients of a step are multiplied by, for all steps at once.
            before, r, z, c = (np.stack(many) for many in zip(*kept))
            by_c, by_z, by_r, stay = z * (1 - c * c), (c - before) * z * (1 - z), before * r * (1 - r), 1 - z
            back, d, dx = np.zeros((streams, n), F32), np.empty((streams, n), F32), np.empty((3, steps, streams, n), F32)
            reset, update = model._gates().transpose(0, 2, 1)
            for k in range(steps - 1, -1, -1):
                np.add(dh[k], back, out=d)
                dr, dz, dc = dx[:, k]
                np.multiply(d, by_c[k], out=dc)
                np.multiply(d, by_z[k], out=dz)
                drh = dc @ p["c"].T
                np.multiply(drh, by_r[k], out=dr)
                back = d * stay[k]
                drh *= r[k]
                back += drh
                back += dr @ reset
                back += dz @ update
                back *= alive[k]
            dx, before, r = dx.reshape(3, -1, n), before.reshape(-1, n), r.reshape(-1, n)
            grads["c"] += (r * before).T @ dx[2]
            for j in (0, 1):
                grads["u"][:, j * n : (j + 1) * n] += before.T @ dx[j]
            # Small unsigned numbers are sorted by their digits.
            inputs = inputs.ravel().astype(np.min_scalar_type(len(p["x"])))
            order = np.argsort(inputs, kind="stable")
            inputs = inputs[order]
            first = np.flatnonzero(np.concatenate([[True], inputs[1:] != inputs[:-1]]))
            dense = np.concatenate([np.add.reduceat(part.take(order, axis=0), first, axis=0) for part in dx], axis=1)
            size = F32(streams * steps)
            for k, g, at in [("x", dense, inputs[first].astype(np.int64)), *((k, g, slice(None)) for k, g in grads.items())]:
                g /= size
                np.clip(g, -0.1, 0.1, out=g)
                sums = squares[k][at]
                sums += g * g
                squares[k][at] = sums
                g *= F32(rate)
                g /= np.sqrt(sums)
                p[k][at] -= g
        return model
