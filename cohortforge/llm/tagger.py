"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PAD = 0
_MARKS = " \n@.+-()[]_%/:#,;'\"=&$!?*|<>\\{}~^`\t"
N_CLASSES = 29 + len(_MARKS) + 2

_CLASS = np.full(0x110000, N_CLASSES - 1, np.uint8)     # other characters
_CLASS[0x80:0x3000] = N_CLASSES - 2                     # mostly letters
for _i in range(26):
    _CLASS[65 + _i] = _CLASS[97 + _i] = 1 + _i
_CLASS[48:58] = 27
for _i, _c in enumerate(_MARKS):
    _CLASS[ord(_c)] = 28 + _i


def classes(text: str) -> np.ndarray:
    """The character class of each code point."""
    return _CLASS[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _logsumexp(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """Weights by name; arrays are (time, batch, features) throughout."""
    w: dict[str, np.ndarray]
    n_tags: int

    @staticmethod
    def new(n_tags: int, embed: int = 12, hidden: int = 16, seed: int = 1) -> Tagger:
        rng = np.random.default_rng(seed)
        w = {"embed": rng.normal(0, 0.3, (N_CLASSES, embed)), "out": rng.normal(0, 0.3, (2 * hidden, n_tags)),
             "bias": np.zeros(n_tags), "move": rng.normal(0, 0.1, (n_tags, n_tags)), "start": np.zeros(n_tags)}
        for d in ("fw", "bw"):
            w[f"{d}_x"] = rng.normal(0, embed ** -0.5, (embed, 4 * hidden))
            w[f"{d}_h"] = rng.normal(0, hidden ** -0.5, (hidden, 4 * hidden))
            w[f"{d}_b"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])  # forget gates open
        return Tagger({k: v.astype(np.float32) for k, v in w.items()}, n_tags)

    # -- the network

    def _lstm(self, d: str, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        wh, hidden = self.w[f"{d}_h"], self.w[f"{d}_h"].shape[0]
        z = x @ self.w[f"{d}_x"] + self.w[f"{d}_b"]
        h = np.zeros((x.shape[1], hidden), np.float32)
        c = np.zeros_like(h)
        out = np.empty((*x.shape[:2], hidden), np.float32)
        times = range(len(x)) if d == "fw" else range(len(x) - 1, -1, -1)
        for t in times:
            g = z[t] + h @ wh
            gates = _sigmoid(g[:, :3 * hidden])
            i, f, o = gates[:, :hidden], gates[:, hidden:2 * hidden], gates[:, 2 * hidden:]
            a = np.tanh(g[:, 3 * hidden:])
            if keep is not None:
                keep.append((t, h, c, i, f, o, a))
            c = f * c + i * a
            h = o * np.tanh(c)
            out[t] = h
        return out

    def _lstm_back(self, d: str, x, keep, dout, grad) -> np.ndarray:
        wx, wh = self.w[f"{d}_x"], self.w[f"{d}_h"]
        dx = np.empty_like(x)
        dh = np.zeros((x.shape[1], wh.shape[0]), np.float32)
        dc = np.zeros_like(dh)
        for t, h, c, i, f, o, a in reversed(keep):
            tc = np.tanh(f * c + i * a)
            dh = dh + dout[t]
            dc = dc + dh * o * (1 - tc * tc)
            dg = np.concatenate([dc * a * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - a * a)], axis=1)
            grad[f"{d}_x"] += x[t].T @ dg
            grad[f"{d}_h"] += h.T @ dg
            grad[f"{d}_b"] += dg.sum(axis=0)
            dx[t] = dg @ wx.T
            dh, dc = dg @ wh.T, dc * f
        return dx

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        x = self.w["embed"][codes]
        return np.concatenate([self._lstm("fw", x), self._lstm("bw", x)], axis=2) @ self.w["out"] + self.w["bias"]

    # -- the CRF

    def _sums(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log sums over all paths to and from each (time, tag)."""
        move = self.w["move"]
        to, since = np.empty_like(e), np.zeros_like(e)
        to[0] = self.w["start"] + e[0]
        for t in range(1, len(e)):
            to[t] = _logsumexp(to[t - 1][:, :, None] + move, 1) + e[t]
        for t in range(len(e) - 2, -1, -1):
            since[t] = _logsumexp(move + (e[t + 1] + since[t + 1])[:, None, :], 2)
        return to, since

    def loss(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tag sequences and its gradients."""
        n_times, n = codes.shape
        x = self.w["embed"][codes]
        keep = {"fw": [], "bw": []}
        h = np.concatenate([self._lstm(d, x, keep[d]) for d in keep], axis=2)
        e = h @ self.w["out"] + self.w["bias"]
        to, since = self._sums(e)
        z = _logsumexp(to[-1], 1)
        rows = np.arange(n)
        gold = self.w["start"][tags[0]] + sum(e[t, rows, tags[t]] for t in range(n_times))
        gold = gold + sum(self.w["move"][tags[t - 1], tags[t]] for t in range(1, n_times))
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        de = np.exp(to + since - z[:, None])
        for t in range(1, n_times):
            both = np.exp(to[t - 1][:, :, None] + self.w["move"] + (e[t] + since[t])[:, None, :] - z[:, None, None])
            grad["move"] += both.sum(axis=0)
            np.subtract.at(grad["move"], (tags[t - 1], tags[t]), 1)
        np.subtract.at(de, (np.arange(n_times)[:, None], rows[None, :], tags), 1)
        grad["start"] += de[0].sum(axis=0)
        flat = de.reshape(-1, self.n_tags)
        grad["out"] = h.reshape(-1, h.shape[2]).T @ flat
        grad["bias"] = flat.sum(axis=0)
        dh = de @ self.w["out"].T
        half = dh.shape[2] // 2
        dx = self._lstm_back("fw", x, keep["fw"], dh[:, :, :half], grad) + self._lstm_back("bw", x, keep["bw"], dh[:, :, half:], grad)
        np.add.at(grad["embed"], codes, dx)
        return float((z - gold).mean()), {k: v / n for k, v in grad.items()}

    def decode(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tag of each place (Viterbi) and its probability."""
        e = self.emissions(codes)
        to, since = self._sums(e)
        z = _logsumexp(to[-1], 1)
        move = self.w["move"]
        best = self.w["start"] + e[0]
        back = np.empty(e.shape, np.int8)
        for t in range(1, len(e)):
            paths = best[:, :, None] + move
            back[t] = paths.argmax(axis=1)
            best = paths.max(axis=1) + e[t]
        tags = np.empty(codes.shape, np.int64)
        tags[-1] = best.argmax(axis=1)
        rows = np.arange(codes.shape[1])
        for t in range(len(e) - 1, 0, -1):
            tags[t - 1] = back[t, rows, tags[t]]
        at = (np.arange(len(e))[:, None], rows[None, :], tags)
        return tags, np.exp((to + since)[at] - z[None, :])


def train(codes: np.ndarray, tags: np.ndarray, n_tags: int, rounds: int = 160, batch: int = 64, rate: float = 0.02,
          seed: int = 1) -> Tagger:
    """Adam on (row, place) arrays of codes and tags."""
    model, rng = Tagger.new(n_tags, seed=seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in model.w.items()}
    s = {k: np.zeros_like(v) for k, v in model.w.items()}
    for r in range(1, rounds + 1):
        pick = rng.integers(0, len(codes), batch)
        _, grad = model.loss(codes[pick].T.astype(np.int64), tags[pick].T.astype(np.int64))
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        step = rate * min(1.0, 2 * (1 - r / (rounds + 1))) * np.sqrt(1 - 0.999 ** r) / (1 - 0.9 ** r)
        for k, g in grad.items():
            g = g * min(1.0, 5.0 / max(norm, 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.999 * s[k] + 0.001 * g * g
            model.w[k] = (model.w[k] - step * m[k] / (np.sqrt(s[k]) + 1e-8)).astype(np.float32)
    return model
