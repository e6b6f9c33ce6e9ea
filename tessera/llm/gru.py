"""A gated recurrent language model in numpy with a class-factored softmax.

    P(w | h) = P(class(w) | h) * P(w | class(w), h)

The ``n_soft`` most frequent words form classes of ``class_size`` words with a
softmax of their own. Less frequent words form tail classes, by frequency band,
whose inner distribution is fixed by the corpus counts. All classes share the
class softmax. Biases start at the corpus frequencies, so that an untrained
model is the unigram model and training adds what the state knows.
"""

from __future__ import annotations

import heapq

import numpy as np

F32 = np.float32


class Layout:
    """Which class each word code belongs to. Codes follow falling counts: 0 is the most
    frequent word; ``n_words`` stands for any word beyond the counted ones (rare)."""

    def __init__(self, counts: np.ndarray, rare_mass: float, n_soft: int = 4096, class_size: int = 64,
                 n_tail: int = 8):
        self.n_words, self.class_size = len(counts), class_size
        self.n_soft = min(n_soft, len(counts) // class_size * class_size)
        self.soft_classes = self.n_soft // class_size
        tail = counts[self.n_soft:] + 0.5
        bands = np.minimum((np.cumsum(tail) / max(tail.sum(), 1e-9) * n_tail).astype(int), n_tail - 1) if len(tail) else tail.astype(int)
        self.tail_class = np.concatenate((bands, [n_tail])).astype(np.int32)  # of codes n_soft..n_words
        self.n_classes = self.soft_classes + n_tail + 1
        self.start = self.n_soft + n_tail + 1  # input id of the text's start
        self.n_inputs = self.start + 1
        mass = np.zeros(n_tail + 1)
        np.add.at(mass, bands, tail)
        mass[n_tail] = rare_mass
        self.tail_mass = mass
        inner = np.zeros(len(tail) + 1)  # log-probability inside the tail class; the rare word's is added later
        if len(tail):
            inner[:-1] = np.log(tail / mass[bands])
        self.inner = inner
        soft = counts[:self.n_soft].reshape(-1, class_size) + 0.5 if self.n_soft else np.zeros((0, class_size))
        self.word_bias = np.log(soft / soft.sum(1, keepdims=True)).astype(F32)
        share = np.concatenate((soft.sum(1), mass)) + 1e-6
        self.class_bias = np.log(share / share.sum()).astype(F32)

    def inputs(self, codes: np.ndarray) -> np.ndarray:
        tail = codes >= self.n_soft
        out = codes.copy()
        out[tail] = self.n_soft + self.tail_class[codes[tail] - self.n_soft]
        return out

    def classes(self, codes: np.ndarray) -> np.ndarray:
        tail = codes >= self.n_soft
        out = codes // self.class_size
        out[tail] = self.soft_classes + self.tail_class[codes[tail] - self.n_soft]
        return out


def _sums(rows: np.ndarray, order: np.ndarray, first: np.ndarray, short: int = 8) -> np.ndarray:
    """Sum of each group of rows; ``order`` has the groups one after the other, ``first`` where each starts."""
    size = np.diff(first, append=len(order))
    out = rows.take(order[first], axis=0)
    for k in range(1, short):
        more = np.flatnonzero(size > k)
        out[more] += rows.take(order[first[more] + k], axis=0)
    for i in np.flatnonzero(size > short).tolist():
        rest = rows.take(order[first[i] + short:first[i] + size[i]], axis=0)
        out[i] += np.ones(len(rest), rows.dtype) @ rest
    return out


NAMES = ("wx", "u", "bg", "wc", "bc", "ww", "bw")


def initial(layout: Layout, hidden: int, seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    return {
        "wx": (r.standard_normal((layout.n_inputs, 3 * hidden)) * 0.3).astype(F32),
        "u": (r.standard_normal((hidden, 3 * hidden)) * 0.5 / np.sqrt(hidden)).astype(F32),
        "bg": np.zeros(3 * hidden, F32),
        "wc": np.zeros((hidden, layout.n_classes), F32), "bc": layout.class_bias.copy(),
        "ww": np.zeros((layout.soft_classes, layout.class_size, hidden), F32), "bw": layout.word_bias.copy(),
    }


def pack(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in NAMES])


def unpack(flat: np.ndarray, layout: Layout, hidden: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, v in initial(layout, hidden).items():
        out[k] = flat[at:at + v.size].reshape(v.shape).astype(F32)
        at += v.size
    return out


def lanes(docs: list[np.ndarray], width: int) -> list[list[int]]:
    """Documents dealt to lanes of nearly equal length, longest first; lanes by falling length."""
    heap = [(0, k) for k in range(max(1, min(width, len(docs))))]
    out: list[list[int]] = [[] for _ in heap]
    for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
        size, k = heapq.heappop(heap)
        out[k].append(i)
        heapq.heappush(heap, (size + len(docs[i]), k))
    return sorted(out, key=lambda lane: -sum(len(docs[i]) for i in lane))


class Gru:
    def __init__(self, layout: Layout, weights: dict[str, np.ndarray]):
        self.layout, self.hidden = layout, weights["u"].shape[0]
        # Classes and words take a state with a last entry of 1: biases lie beside the weights.
        wc = np.concatenate((weights["wc"], weights["bc"][None]))
        ww = np.concatenate((weights["ww"], weights["bw"][..., None]), axis=2)
        self.joint = {"wx": weights["wx"].copy(), "u": weights["u"].copy(), "bg": weights["bg"].copy(), "wc": wc, "ww": ww}
        self.w = self._apart(self.joint)

    @staticmethod
    def _apart(joint: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """Views by the names of ``NAMES``."""
        return {**joint, "wc": joint["wc"][:-1], "bc": joint["wc"][-1], "ww": joint["ww"][..., :-1], "bw": joint["ww"][..., -1]}

    # -- forward ---------------------------------------------------------
    def _inputs(self, wx: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Rows of the input table as (steps, gate, lanes, hidden): each gate of a step is a plane of its own."""
        return wx.reshape(-1, self.hidden).take(ids[:, None] * 3 + np.arange(3)[:, None], axis=0)

    def _planes(self, u: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(u.reshape(self.hidden, 3, self.hidden).transpose(1, 0, 2))

    def _run(self, h: np.ndarray, x: np.ndarray, u: np.ndarray, fresh: np.ndarray, g: np.ndarray, n: np.ndarray):
        """Last state and the states after each step; ``x`` and ``u`` as in ``_halved``. ``g`` and ``n`` take
        what each step made of its gates, or the last step if they hold one."""
        one, half, any_fresh = F32(1), F32(0.5), fresh.any(axis=1)
        out = np.empty((*fresh.shape, self.hidden), x.dtype)
        for t in range(len(x)):
            if any_fresh[t]:
                h = np.where(fresh[t][:, None], F32(0), h)
            gt, nt, new = g[t % len(g)], n[t % len(n)], out[t]
            np.matmul(h, u, out=gt)
            zr = gt[:2]
            zr += x[t, :2]
            np.tanh(zr, out=zr)
            zr += one
            zr *= half
            np.multiply(gt[2], zr[1], out=nt)
            nt += x[t, 2]
            np.tanh(nt, out=nt)
            np.subtract(h, nt, out=new)
            new *= zr[0]
            new += nt
            h = new
        return h, out

    def _steps(self, h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        """States after each step of (steps, lanes) input ids, and a tape for the way back; a start
        id clears the state first."""
        k, w, scale, fresh = self.hidden, self.w, self._scale(), ids == self.layout.start
        x = self._inputs(w["wx"], ids)
        x += w["bg"].reshape(3, 1, k)
        x *= scale.reshape(3, 1, k)
        g, n = np.empty(x.shape, x.dtype), np.empty((*ids.shape, k), x.dtype)
        last, out = self._run(h, x, self._planes(w["u"] * scale), fresh, g, n)
        before = np.concatenate((h[None], out[:-1]))
        before[fresh] = 0
        return last, out, (before, g, n, fresh)

    def _states(self, h: np.ndarray, ids: np.ndarray, wx: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``_steps`` without a tape; ``wx`` and ``u`` are those of ``_halved``."""
        x = self._inputs(wx, ids)
        return self._run(h, x, self._planes(u), ids == self.layout.start, np.empty_like(x[:1]), np.empty_like(x[:1, 0]))

    def _scale(self) -> np.ndarray:
        return np.repeat(np.array([0.5, 0.5, 1.0], F32), self.hidden)

    def _halved(self) -> tuple[np.ndarray, np.ndarray]:
        """Input table and recurrent weights with the gates' halves of sigmoid(x) = (1 + tanh(x / 2)) / 2 in them."""
        scale = self._scale()
        return (self.w["wx"] + self.w["bg"]) * scale, self.w["u"] * scale

    def _bounded(self) -> bool:
        """Whether no logit can overflow exp: states lie in [-1, 1], so absolute weights bound them."""
        w, ones = self.w, np.ones(self.hidden, F32)
        top = max((ones @ np.abs(w["wc"]) + w["bc"]).max(initial=0), (np.abs(w["ww"]) @ ones + w["bw"]).max(initial=0))
        return bool(top < 60)

    def _outputs(self, h: np.ndarray, codes: np.ndarray, grad: bool, bounded: bool = False):
        """Log-probability of each code given its state; with ``grad`` also the gradients of their sum.

        Tokens are taken by class, so that each class is a slice: one product for the logits of its
        words, two for the gradients. All else is done for all tokens at once.
        """
        lay, w = self.layout, self.w
        cls = lay.classes(codes).astype(np.int16)
        order = np.argsort(cls, kind="stable")
        ones = np.ones((len(codes), 1), h.dtype)
        h, codes, cls = np.concatenate((h.take(order, axis=0), ones), axis=1), codes[order], cls[order]
        wc, ww = self.joint["wc"], self.joint["ww"]
        edges = np.searchsorted(cls, np.arange(lay.soft_classes + 1))
        soft = int(edges[-1])  # the tail's tokens come last
        edges = edges.tolist()
        used = [(c, slice(a, b)) for c, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]

        def softmax(logits: np.ndarray, own: np.ndarray) -> np.ndarray:
            """Log-probabilities of the entries ``own``; ``logits`` become their gradients."""
            if not bounded:
                logits -= logits.max(1, keepdims=True)
            at = np.arange(0, logits.size, logits.shape[1]) + own
            lp = logits.ravel().take(at).astype(np.float64)
            np.exp(logits, out=logits)
            total = logits @ np.ones(logits.shape[1], logits.dtype)
            lp -= np.log(total)
            if grad:
                logits *= (-1 / total)[:, None]
                logits.ravel()[at] += 1
            return lp

        p = h @ wc
        lp = softmax(p, cls)
        lp[soft:] += lay.inner[codes[soft:] - lay.n_soft]
        s = np.empty((soft, lay.class_size), h.dtype)
        for c, own in used:
            np.matmul(h[own], ww[c].T, out=s[own])
        lp[:soft] += softmax(s, codes[:soft] % lay.class_size)
        out = np.empty(len(lp))
        out[order] = lp
        if not grad:
            return out
        g = {"wc": h.T @ p, "ww": np.zeros_like(ww)}
        dh, inside = p @ w["wc"].T, np.empty((soft, self.hidden), h.dtype)
        for c, own in used:
            np.matmul(s[own], w["ww"][c], out=inside[own])
            np.matmul(s[own].T, h[own], out=g["ww"][c])
        dh[:soft] += inside
        back = np.empty_like(dh)
        back[order] = dh
        return out, back, g

    def _windows(self, docs: list[np.ndarray], width: int, steps: int):
        """Windows (steps, lanes) over the documents' lanes: input ids, codes, document numbers and which
        places are real. Lanes end one after the other, the last ones first."""
        if not docs:
            return
        dealt = lanes(docs, width)
        order = [i for lane in dealt for i in lane]
        text = np.concatenate([docs[i] for i in order])
        length = np.array([len(docs[i]) for i in order])
        inputs, owner = np.empty_like(text), np.repeat(order, length)
        inputs[1:] = self.layout.inputs(text[:-1])
        inputs[np.cumsum(length) - length] = self.layout.start
        size = np.array([sum(len(docs[i]) for i in lane) for lane in dealt])
        start = np.cumsum(size) - size
        for at in range(0, int(size[0]), steps):
            live = int(np.searchsorted(-size, -at, "left"))  # lanes are by falling length
            step = np.arange(at, min(at + steps, int(size[0])))[:, None]
            real = step < size[:live]
            place = start[:live] + np.minimum(step, size[:live] - 1)
            yield inputs[place], text[place], owner[place], real

    def score(self, docs: list[np.ndarray], width: int = 256, steps: int = 16) -> np.ndarray:
        """Log-probability (natural) of each document, a code array that ends with the end code.

        The state is carried through the windows of a document to its end.
        """
        out = np.zeros(len(docs))
        h = np.zeros((min(width, len(docs)), self.hidden), F32)
        (wx, u), bounded = self._halved(), self._bounded()
        for ids, codes, who, real in self._windows(docs, width, steps):
            h, states = self._states(h[:ids.shape[1]], ids, wx, u)
            out += np.bincount(who[real], self._outputs(states[real], codes[real], False, bounded), len(docs))
        return out

    # -- training --------------------------------------------------------
    def gradients(self, h: np.ndarray, ids: np.ndarray, codes: np.ndarray, real: np.ndarray):
        """Last state, summed log-probability and its gradients over one window (steps, lanes)."""
        last, lp, g, seen = self._backward(h, ids, codes, real)
        return last, lp, self._apart(g), seen

    def _backward(self, h: np.ndarray, ids: np.ndarray, codes: np.ndarray, real: np.ndarray):
        """As ``gradients``, by the names of ``joint``."""
        k, w, any_fresh = self.hidden, self.w, (ids == self.layout.start).any(axis=1)
        last, states, (before, gates, n, fresh) = self._steps(h, ids)
        if real.all():
            lp, dstates, g = self._outputs(states.reshape(-1, k), codes.ravel(), True, self._bounded())
            dstates = dstates.reshape(states.shape)
        else:
            lp, dflat, g = self._outputs(states[real], codes[real], True, self._bounded())
            dstates = np.zeros_like(states)
            dstates[real] = dflat
        # What a state's gradient is multiplied by on its way into z, r and the recurrent part of n.
        z, r, gn = gates[:, 0], gates[:, 1], gates[:, 2]
        rest, into_n = 1 - z, 1 - n * n
        into_n *= rest
        by = np.empty((3, *ids.shape, k), gates.dtype)
        np.subtract(before, n, out=by[0])
        by[0] *= z
        by[0] *= rest
        np.multiply(into_n, r, out=by[2])
        np.subtract(1, r, out=by[1])
        by[1] *= gn
        by[1] *= by[2]
        ut, dh = self._planes(w["u"]).transpose(0, 2, 1), np.zeros_like(h)
        for t in range(len(ids) - 1, -1, -1):
            d, step = dstates[t], by[:, t]
            d += dh
            step *= d
            dh = (step @ ut).sum(0)
            dh += d * z[t]
            if any_fresh[t]:
                dh[fresh[t]] = 0
        rows = by.transpose(1, 2, 0, 3).reshape(-1, 3 * k)
        g["u"] = before.reshape(-1, k).T @ rows
        np.multiply(dstates.reshape(-1, k), into_n.reshape(-1, k), out=rows[:, 2 * k:])  # into the input's part of n
        ids = ids.ravel().astype(np.int16 if self.layout.n_inputs < 1 << 15 else np.int32)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.diff(ids, prepend=-1))
        g["wx"] = _sums(rows, order, first)
        g["bg"] = np.ones(len(first), rows.dtype) @ g["wx"]
        return last, float(lp.sum()), g, ids[first]

    def train(self, docs: list[np.ndarray], past: dict[str, np.ndarray], rate: float = 0.05,
              width: int = 64, steps: int = 20) -> None:
        """One pass of truncated backpropagation with Adagrad; states carry over from window to window.

        Texts longer than a lane are dealt in pieces, each from a clear state: the last windows
        would otherwise hold one text alone and pull the model towards it.
        """
        if not docs:
            return
        most = max(256, -(-sum(map(len, docs)) // width))
        docs = [d[at:at + most] for d in docs for at in range(0, len(d), most)]
        h = np.zeros((min(width, len(docs)), self.hidden), F32)
        n = F32(width * steps)  # of a full window, so that the last lanes do not outweigh it
        # Sums of squares of the gradients as they come, n times those of ``past``.
        sums = {"wx": past["wx"], "u": past["u"], "bg": past["bg"], "wc": np.concatenate((past["wc"], past["bc"][None])),
                "ww": np.concatenate((past["ww"], past["bw"][..., None]), axis=2)}
        sums = {name: v * (n * n) for name, v in sums.items()}
        for ids, codes, _, real in self._windows(docs, width, steps):
            h, _, g, seen = self._backward(h[:ids.shape[1]], ids, codes, real)
            for name, d in g.items():
                rows = seen if name == "wx" else ...
                total = sums[name][rows]
                total += d * d
                if name == "wx":  # a copy of its rows
                    sums[name][rows] = total
                d /= np.sqrt(total)
                d *= F32(rate)
                self.joint[name][rows] += d
        for name, v in self._apart(sums).items():
            past[name][...] = v / (n * n)
