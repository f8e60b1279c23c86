"""A bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as its own hashed vector beside the sum of the vectors of its hashed four-byte grams, the mark before it
included, so that unseen compounds of known stems are read by their characters. Two GRUs run over a window of words,
one from each side; attention weighs their states, and the pooled state gives the window's logit. Training is plain
back-propagation through time with Adagrad.
"""

from __future__ import annotations

import io

import numpy as np

WORD_BUCKETS, GRAM_BUCKETS = 1 << 15, 1 << 16
WORD_DIM, GRAM_DIM, HIDDEN = 4, 6, 8
WINDOW, STRIDE = 8, 1  # words; a window begins at every word

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LOWER[_SEPARATOR] = 0x20


def _inputs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each word, buckets of all grams in order, grams of each word, words of each text)."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b" " + b" ".join(raws) + b"    ", np.uint8)]
    mark = data == 0x20
    edge = np.flatnonzero(mark[1:] != mark[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    four = data[:-3].astype(np.uint32)
    inner = np.ones(len(four), bool)  # in the end: all bytes after the first are of one word
    for i in (1, 2, 3):  # bytes after a word's end don't enter its hash
        inner &= ~mark[i:len(data) - 3 + i]
        four |= (data[i:len(data) - 3 + i] * inner).astype(np.uint32) << np.uint32(8 * i)
    four *= np.uint32(0x9E3779B1)
    at = np.flatnonzero(inner)
    grams = (four[at] >> np.uint32(16)).astype(np.int32)
    per_word = np.maximum(ends - starts - 2, 0)
    total = np.zeros(len(four) + 1, np.uint32)
    np.cumsum(four ^ (four >> np.uint32(15)), out=total[1:])
    length = (ends - starts).astype(np.uint32)
    words = (total[ends] - total[starts]) * np.uint32(0x85EBCA6B) + length * np.uint32(0xC2B2AE35)
    words = ((words ^ (words >> np.uint32(13))) * np.uint32(0x27D4EB2F) >> np.uint32(17)).astype(np.int32)
    begins = np.cumsum([1, *(len(r) + 1 for r in raws)])
    return words, grams, per_word, np.diff(np.searchsorted(starts, begins))


def _windows(counts: np.ndarray, size: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, length, text) of every overlapping window; the last of a text ends with it, a text shorter than a
    window is one; none without words."""
    begins = np.cumsum(counts) - counts
    n = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - size) // stride)), 0)
    text = np.repeat(np.arange(len(counts)), n)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    at = np.minimum(nth * stride, np.maximum(counts[text] - size, 0))
    return begins[text] + at, np.minimum(counts[text], size), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.minimum(x, 40, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Network:
    """Parameters by name: word, gram (vectors), in0/in1, zr0/zr1, c0/c1, bias0/bias1 (GRUs), v, w, b (attention, output),
    and the two numbers that turn a document's largest logit into its score."""

    def __init__(self, **parameters: np.ndarray):
        self.p = parameters

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        rng, h, d = np.random.default_rng(seed), HIDDEN, WORD_DIM + GRAM_DIM

        def some(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        p = {"word": some(WORD_BUCKETS, WORD_DIM, scale=0.05), "gram": some(GRAM_BUCKETS, GRAM_DIM, scale=0.02),
             "v": some(2 * h, scale=0.1), "w": some(2 * h, scale=0.3), "b": np.zeros(1, np.float32), "platt": np.array([1, 0], np.float32)}
        for k in "01":
            p |= {f"in{k}": some(d, 3 * h, scale=d**-0.5), f"zr{k}": some(h, 2 * h, scale=h**-0.5),
                  f"c{k}": some(h, h, scale=h**-0.5), f"bias{k}": np.zeros(3 * h, np.float32)}
        return cls(**p)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.p)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Network:
        with np.load(io.BytesIO(data)) as z:
            return cls(**{k: z[k] for k in z.files})

    def embed(self, words: np.ndarray, grams: np.ndarray, per_word: np.ndarray) -> np.ndarray:
        x = np.zeros((len(words), WORD_DIM + GRAM_DIM), np.float32)
        x[:, :WORD_DIM] = self.p["word"][words]
        have = per_word > 0
        if len(grams):
            at = (np.cumsum(per_word) - per_word)[have]
            x[have, WORD_DIM:] = np.add.reduceat(self.p["gram"][grams], at, axis=0)
        return x

    def _gru(self, k: str, px: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """States (T, n, H) of one direction; ``px`` are the words' input terms, ``index`` (T, n) words of each step."""
        h = np.zeros((index.shape[1], HIDDEN), np.float32)
        states = np.empty((len(index), *h.shape), np.float32)
        for t in range(len(index)) if k == "0" else range(len(index) - 1, -1, -1):
            g = px[index[t]]
            zr = _sigmoid(g[:, :2 * HIDDEN] + h @ self.p[f"zr{k}"])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(g[:, 2 * HIDDEN:] + (r * h) @ self.p[f"c{k}"])
            zm = z * mask[t][:, None]
            if keep is not None:
                keep.append((t, h, z, r, c))
            h = h + zm * (c - h)
            states[t] = h
        return states

    def _forward(self, x: np.ndarray, first: np.ndarray, length: np.ndarray, keep: dict | None = None) -> np.ndarray:
        steps = int(length.max())
        place = np.arange(steps)[:, None]
        mask = (place < length).astype(np.float32)
        index = np.where(place < length, first + place, 0)
        tapes: tuple = ([], []) if keep is not None else (None, None)
        states = np.concatenate([self._gru(k, x @ self.p[f"in{k}"] + self.p[f"bias{k}"], index, mask, tape)
                                 for k, tape in zip("01", tapes, strict=True)], axis=2)
        e = states @ self.p["v"]
        e = np.where(mask > 0, e, -1e9)
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", a, states)
        if keep is not None:
            keep |= {"mask": mask, "index": index, "tapes": tapes, "states": states, "a": a, "pooled": pooled}
        return pooled @ self.p["w"] + self.p["b"][0]

    def window_logits(self, texts: list[str], batch: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """(logit, text) of every window of all texts."""
        words, grams, per_word, counts = _inputs(texts)
        first, length, text = _windows(counts)
        out = np.zeros(len(first), np.float32)
        if len(first):
            x = self.embed(words, grams, per_word)
            for at in range(0, len(first), batch):
                part = slice(at, at + batch)
                lo, hi = int(first[part].min()), int((first[part] + length[part]).max())
                out[part] = self._forward(x[lo:hi], first[part] - lo, length[part])
        return out, text

    def scores(self, texts: list[str]) -> np.ndarray:
        """Of each text, the score of its highest window; of a text without words, that of the bias alone."""
        best = np.full(len(texts), -np.inf)
        logits, text = self.window_logits(texts)
        np.maximum.at(best, text, logits)
        best[np.isinf(best)] = self.p["b"][0]
        a, b = self.p["platt"].astype(float)
        return 1 / (1 + np.exp(-np.clip(a * best + b, -500, 500)))

    def gradients(self, words, grams, per_word, first, length, target, weight) -> tuple[float, dict]:
        """Weighted logistic loss of windows and its gradients, those of the vectors as (rows, gradients)."""
        p, keep = self.p, {}
        x = self.embed(words, grams, per_word)
        logit = self._forward(x, first, length, keep)
        prob = 1 / (1 + np.exp(-np.clip(logit, -60, 60)))
        loss = float(-(weight * np.where(target > 0, np.log(prob + 1e-9), np.log(1 - prob + 1e-9))).sum() / weight.sum())
        d = ((prob - target) * weight / weight.sum()).astype(np.float32)
        states, a, mask, index = keep["states"], keep["a"], keep["mask"], keep["index"]
        g = {"w": d @ keep["pooled"], "b": np.array([d.sum()], np.float32)}
        dpool = d[:, None] * p["w"]
        da = np.einsum("nh,tnh->tn", dpool, states)
        de = a * (da - (a * da).sum(axis=0))
        g["v"] = np.einsum("tn,tnh->h", de, states)
        dstates = a[:, :, None] * dpool[None] + de[:, :, None] * p["v"]
        dx = np.zeros_like(x)
        for k, tape in zip("01", keep["tapes"], strict=True):
            side = slice(0, HIDDEN) if k == "0" else slice(HIDDEN, 2 * HIDDEN)
            dpx = np.zeros((len(x), 3 * HIDDEN), np.float32)
            g[f"zr{k}"], g[f"c{k}"] = np.zeros_like(p[f"zr{k}"]), np.zeros_like(p[f"c{k}"])
            dh = np.zeros((len(d), HIDDEN), np.float32)
            for t, h, z, r, c in reversed(tape):
                dh = dh + dstates[t][:, side]
                m = mask[t][:, None]
                dc = dh * z * m * (1 - c * c)
                dz = dh * m * (c - h) * z * (1 - z)
                drh = dc @ p[f"c{k}"].T
                dr = drh * h * r * (1 - r)
                dzr = np.concatenate([dz, dr], axis=1)
                g[f"c{k}"] += (r * h).T @ dc
                g[f"zr{k}"] += h.T @ dzr
                np.add.at(dpx, index[t], np.concatenate([dzr, dc], axis=1))
                dh = dh * (1 - z * m) + drh * r + dzr @ p[f"zr{k}"].T
            g[f"in{k}"], g[f"bias{k}"] = x.T @ dpx, dpx.sum(axis=0)
            dx += dpx @ p[f"in{k}"].T
        g["word"] = (words, dx[:, :WORD_DIM])
        g["gram"] = (grams, np.repeat(dx[:, WORD_DIM:], per_word, axis=0))
        return loss, g


def _evidence(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of the presence of each word and gram bucket in a toxic text; 0 where the counts say little."""
    present = {0: (np.zeros(WORD_BUCKETS), np.zeros(GRAM_BUCKETS)), 1: (np.zeros(WORD_BUCKETS), np.zeros(GRAM_BUCKETS))}
    for text, label in zip(texts, labels, strict=True):
        words, grams, _, _ = _inputs([text])
        present[int(label)][0][np.unique(words)] += 1
        present[int(label)][1][np.unique(grams)] += 1
    n1, n0 = labels.sum() + 1, len(labels) - labels.sum() + 1
    out = []
    for one, none in zip(present[1], present[0], strict=True):
        odds = np.log((one + 0.5) / n1) - np.log((none + 0.5) / n0)
        out.append(np.where((one + none >= 6) & (odds > 1), odds, 0).astype(np.float32))
    return out[0], out[1]


def train(texts: list[str], labels: np.ndarray, toxic_share: float, epochs: int = 6, batch: int = 256, rate: float = 0.08,
          seed: int = 7) -> Network:
    """Fit on labelled texts. A toxic text teaches through the windows with most evidence, a clean one through its
    windows with most evidence and random ones, since a label says nothing of a single window of a toxic text."""
    net = Network.fresh(seed)
    labels = np.asarray(labels)
    if not len(labels) or not 0 < labels.sum() < len(labels):
        net.p["w"][:] = 0
        net.p["platt"] = np.array([0, 20 if len(labels) and labels.all() else -20], np.float32)
        return net
    rng = np.random.default_rng(seed)
    by_word, by_gram = _evidence(texts, labels)
    net.p["word"][:, 0] += 0.5 * by_word
    net.p["gram"][:, 0] += 0.2 * by_gram
    words, grams, per_word, counts = _inputs(texts)
    first, length, text = _windows(counts)
    at = np.cumsum(per_word) - per_word
    strength = by_word[words] + np.r_[0, np.cumsum(by_gram[grams])][at + per_word] - np.r_[0, np.cumsum(by_gram[grams])][at]
    total = np.r_[0, np.cumsum(strength)]
    evidence = total[first + length] - total[first]
    order = np.lexsort((-evidence, text))
    nth = np.arange(len(order)) - np.searchsorted(text[order], text[order])
    toxic = labels[text[order]] > 0
    chosen = order[(toxic & (nth < 2)) | (~toxic & ((nth < 2) | (rng.random(len(order)) < 3 / (1 + counts[text[order]] / STRIDE))))]
    target = labels[text[chosen]].astype(np.float32)
    weight = np.where(target > 0, len(target) / max(1, target.sum()), len(target) / max(1, (1 - target).sum())).astype(np.float32)
    square = {k: np.full_like(v, 1e-3) for k, v in net.p.items() if k != "platt"}
    for epoch in range(epochs):
        mixed = rng.permutation(len(chosen))
        step = rate / (1 + 0.5 * epoch)
        for s in range(0, len(mixed), batch):
            some = mixed[s:s + batch]
            w = chosen[some]
            rows = (first[w][:, None] + np.arange(WINDOW)[None])[np.arange(WINDOW)[None] < length[w][:, None]]
            sizes = per_word[rows]
            inner = np.repeat(at[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            begin = np.cumsum(length[w]) - length[w]
            _, g = net.gradients(words[rows], grams[inner], sizes, begin, length[w], target[some], weight[some])
            for name, d in g.items():
                if isinstance(d, tuple):
                    where, back = np.unique(d[0], return_inverse=True)
                    summed = np.zeros((len(where), d[1].shape[1]), np.float32)
                    np.add.at(summed, back, d[1])
                    square[name][where] += summed**2
                    net.p[name][where] -= step * summed / np.sqrt(square[name][where])
                else:
                    square[name] += d**2
                    net.p[name] -= step * d / np.sqrt(square[name])
    best = np.full(len(texts), -np.inf)
    for s in range(0, len(texts), 200):
        logits, which = net.window_logits(texts[s:s + 200])
        np.maximum.at(best, s + which, logits)
    best[np.isinf(best)] = net.p["b"][0]
    share = np.clip(toxic_share, 1e-4, 1 - 1e-4)
    net.p["platt"] = _platt(best, labels, np.where(labels > 0, share / labels.mean(), (1 - share) / (1 - labels.mean())))
    return net


def _platt(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50) -> np.ndarray:
    """Slope and offset of a weighted logistic fit with a light ridge, by Newton's method on a scaled logit."""
    scale = max(float(x.std()), 1e-6)
    z = np.column_stack([x / scale, np.ones(len(x))])
    b = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        grad = z.T @ ((p - y) * weight) + 0.5 * b * [1, 0]
        hess = (z * (weight * p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag([0.5, 1e-6])
        move = np.linalg.solve(hess, grad)
        b -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return np.array([max(b[0], 1e-3) / scale, b[1]], np.float32)
