"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Both directions run in one loop as the first axis of every array. Training
maximises the CRF likelihood with Adam; everything is seeded.
"""

from __future__ import annotations

import numpy as np

HIDDEN = 16
PAD, OTHER_LETTER, OTHER = 0, 96, 97
SYMBOLS = 98
NEG = -1e4

_ASCII = np.full(256, OTHER, np.int64)
_ASCII[0x20:0x7F] = np.arange(1, 96)
_ASCII[[*range(0x09, 0x0E)]] = 1


def encode(text: str) -> np.ndarray:
    """Symbol of each code point: printable ASCII apart, other letters alike."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 256, np.where(points < 0x80, _ASCII[np.minimum(points, 255)], OTHER_LETTER),
                    np.where(points < 0x2000, OTHER_LETTER, OTHER)).astype(np.int16)


def allowed(kinds: int) -> np.ndarray:
    """Transition limits of the labels O, B-0, I-0, B-1, I-1, ...: I follows only its own B or I."""
    n = 1 + 2 * kinds
    limit = np.zeros((n + 1, n))  # the last row is the start
    for k in range(kinds):
        inside = 2 + 2 * k
        limit[:, inside] = NEG
        limit[[inside - 1, inside], inside] = 0
    return limit


class Tagger:
    def __init__(self, kinds: int, seed: int = 7, hidden: int = HIDDEN):
        rng, n = np.random.default_rng(seed), 1 + 2 * kinds
        self.hidden, self.labels, self.limit = hidden, n, allowed(kinds).astype(np.float32)
        self.p = {"x": rng.normal(0, 0.3, (2, SYMBOLS, 4 * hidden)), "h": rng.normal(0, 1 / np.sqrt(hidden), (2, hidden, 4 * hidden)),
                  "o": rng.normal(0, 0.3, (2 * hidden, n)), "b": np.zeros(n), "t": np.zeros((n + 1, n))}
        self.p["x"][:, :, hidden: 2 * hidden] += 1.0  # forget gates start open
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.scale = np.concatenate([np.full(3 * hidden, 0.5), np.ones(hidden)]).astype(np.float32)

    def _run(self, ids: np.ndarray, keep: bool):
        """(batch, length, 2 * hidden) states; with ``keep`` also what the backward pass needs."""
        b, n = ids.shape
        H, p, s = self.hidden, self.p, self.scale
        both = np.stack([ids, ids[:, ::-1]])
        wx, wh = p["x"] * s, p["h"] * s
        h, c = np.zeros((2, b, H), np.float32), np.zeros((2, b, H), np.float32)
        hs, trail = np.empty((n, 2, b, H), np.float32), []
        for t in range(n):
            a = np.matmul(h, wh)
            a[0] += wx[0][both[0, :, t]]
            a[1] += wx[1][both[1, :, t]]
            np.tanh(a, out=a)
            gate = a[..., :3 * H] * 0.5 + 0.5
            before, g = c, a[..., 3 * H:]
            c = gate[..., H: 2 * H] * before + gate[..., :H] * g
            tc = np.tanh(c)
            if keep:
                trail.append((h, before, gate, g, tc))
            h = gate[..., 2 * H:] * tc
            hs[t] = h
        out = np.concatenate([hs[:, 0], hs[::-1, 1]], axis=-1).transpose(1, 0, 2)
        return out, both, trail

    def _scores(self, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Emissions of the states; padding can only be O."""
        e = states @ self.p["o"] + self.p["b"]
        e[ids == PAD, 1:] = NEG
        return e

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        return self._scores(self._run(ids, False)[0], ids)

    def decode(self, e: np.ndarray) -> np.ndarray:
        """Best label paths, by Viterbi over the batch."""
        trans = self.p["t"] + self.limit
        score, back = e[:, 0] + trans[-1], []
        for t in range(1, e.shape[1]):
            total = score[:, :, None] + trans[:-1]
            best = total.argmax(1)
            back.append(best)
            score = np.take_along_axis(total, best[:, None], 1)[:, 0] + e[:, t]
        path = [score.argmax(1)]
        for best in reversed(back):
            path.append(np.take_along_axis(best, path[-1][:, None], 1)[:, 0])
        return np.stack(path[::-1], 1)

    def _crf(self, e: np.ndarray, y: np.ndarray):
        """(loss per character, gradient of the emissions, gradient of the transitions)."""
        b, n, k = e.shape
        trans = (self.p["t"] + self.limit).astype(np.float64)
        e = e.astype(np.float64)

        def lse(x, axis):
            m = x.max(axis, keepdims=True)
            return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis))
        alpha, beta = np.empty((b, n, k)), np.zeros((b, n, k))
        alpha[:, 0] = e[:, 0] + trans[-1]
        for t in range(1, n):
            alpha[:, t] = e[:, t] + lse(alpha[:, t - 1][:, :, None] + trans[:-1], 1)
        for t in range(n - 2, -1, -1):
            beta[:, t] = lse(trans[:-1] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        z = lse(alpha[:, -1], 1)
        grad = np.exp(alpha + beta - z[:, None, None])
        gt = np.zeros_like(trans)
        gt[-1] = grad[:, 0].sum(0)
        pair = alpha[:, :-1, :, None] + trans[:-1] + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]
        gt[:-1] = np.exp(pair).sum((0, 1))
        rows = np.arange(b)[:, None]
        right = e[rows, np.arange(n), y].sum() + trans[-1][y[:, 0]].sum() + trans[y[:, :-1], y[:, 1:]].sum()
        grad[rows, np.arange(n), y] -= 1
        np.subtract.at(gt, (np.full(b, k), y[:, 0]), 1)
        np.subtract.at(gt, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        return (z.sum() - right) / (b * n), (grad / b).astype(np.float32), (gt / b).astype(np.float32)

    def gradients(self, ids: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss per character and the gradient of loss * characters per window."""
        H, p, s = self.hidden, self.p, self.scale
        states, both, trail = self._run(ids, True)
        loss, de, dt = self._crf(self._scores(states, ids), y)
        de[ids == PAD] = 0
        g = {"o": np.einsum("bnh,bnk->hk", states, de), "b": de.sum((0, 1)), "t": dt}
        d = (de @ p["o"].T).transpose(1, 0, 2)
        dh_in = np.stack([d[:, :, :H], d[::-1, :, H:]], 1)
        n = ids.shape[1]
        gx, gh = np.zeros_like(p["x"]), np.zeros_like(p["h"])
        dh, dc = np.zeros_like(dh_in[0]), np.zeros_like(dh_in[0])
        wht, slopes = (p["h"] * s).transpose(0, 2, 1), np.empty((n, 2, len(ids), 4 * H), np.float32)
        for t in range(n - 1, -1, -1):
            h0, c0, gate, cand, tc = trail[t]
            i, f, o = gate[..., :H], gate[..., H: 2 * H], gate[..., 2 * H:]
            dh = dh + dh_in[t]
            dc = dc + dh * o * (1 - tc * tc)
            # gate = (1 + tanh) / 2, so its slope in the scaled input is 2 * gate * (1 - gate)
            da = np.concatenate([dc * cand * 2 * i * (1 - i), dc * c0 * 2 * f * (1 - f), dh * tc * 2 * o * (1 - o),
                                 dc * i * (1 - cand * cand)], -1)
            gh += np.matmul(h0.transpose(0, 2, 1), da)
            slopes[t] = da
            dh, dc = np.matmul(da, wht), dc * f
        for side in range(2):
            seen = both[side].T.ravel()
            order = np.argsort(seen, kind="stable")
            at = np.flatnonzero(np.diff(seen[order], prepend=-1))
            gx[side][seen[order][at]] = np.add.reduceat(slopes[:, side].reshape(-1, 4 * H)[order], at)
        g["x"], g["h"] = gx * s, gh * s
        return loss, g

    def fit(self, ids: np.ndarray, y: np.ndarray, epochs: int, batch: int = 48, rate: float = 0.02, seed: int = 3) -> list[float]:
        """Adam with a falling rate; the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        steps, step, history = epochs * -(-len(ids) // batch), 0, []
        for _ in range(epochs):
            order, losses = rng.permutation(len(ids)), []
            for a in range(0, len(ids), batch):
                rows = order[a: a + batch]
                loss, g = self.gradients(ids[rows], y[rows])
                losses.append(loss)
                step += 1
                norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
                clip = min(1.0, 20.0 / (norm + 1e-9))
                lr = rate * (1 - step / (steps + 1))
                for k, x in g.items():
                    x = x * clip
                    m[k] = 0.9 * m[k] + 0.1 * x
                    v[k] = 0.999 * v[k] + 0.001 * x * x
                    self.p[k] = (self.p[k] - lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
            history.append(float(np.mean(losses)))
        return history
