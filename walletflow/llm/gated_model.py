"""Gated recurrent language model in numpy with a class-factored softmax.

Words are numbered by frequency: 0 the end of a text, 1 any word outside the
vocabulary, then the words.  A class is a run of numbers with about the same sum of
square roots of counts: frequent words share small classes, so a token is expected
to meet about as many words in its class as there are classes.  A text starts from
a zero state after an end.  ``Model.score`` carries the state through all
windows of a text; ``Model.learn`` backpropagates inside a window and carries
the state into the next one (truncated backpropagation), with Adagrad steps
on the words and classes that the window holds (the others have no gradient).
"""

from __future__ import annotations

import numpy as np

HIDDEN = 16
WORDS = 1 << 16
CLASSES = 160
BLOCKS = 256  # runs of numbers whose parameters travel together
RUN = WORDS // BLOCKS
NEVER = np.float32(-1e9)
NAMES = ("emb", "rec", "bias", "cls", "cls_bias", "out", "out_bias")
SHAPES = {
    "emb": (WORDS, 3 * HIDDEN), "rec": (HIDDEN, 3 * HIDDEN), "bias": (3 * HIDDEN,),
    "cls": (HIDDEN, CLASSES), "cls_bias": (CLASSES,), "out": (WORDS, HIDDEN), "out_bias": (WORDS,),
}
CELLS = 1 << 16  # exponentials held together, so that they stay in a core's cache
TEXTS = 1024  # texts scored step by step together, for the same reason
RECHECK = 16  # windows learned between two looks at the outputs' range


class Params(dict):
    """Parameters by name; ``bounds``: the first number of each class, and ``WORDS``."""

    bounds = np.linspace(0, WORDS, CLASSES + 1).astype(np.int64)

    def copied(self) -> "Params":
        out = Params({n: v.copy() for n, v in self.items()})
        out.bounds = self.bounds
        return out


def class_bounds(weight: np.ndarray) -> np.ndarray:
    """Bounds of the classes for these counts; the last class holds the numbers without a count."""
    upto = np.cumsum(np.sqrt(weight))
    inner = np.searchsorted(upto, upto[-1] * np.arange(1, CLASSES - 1) / (CLASSES - 1), side="left") + 1
    return np.concatenate([[0], np.minimum(inner, len(weight)), [len(weight), WORDS]]).astype(np.int64)


def initial(counts, seed: int = 42) -> Params:
    """Parameters whose output is the unigram distribution of ``counts`` (one per number)."""
    rng = np.random.default_rng(seed)
    weight = np.zeros(WORDS)
    weight[: len(counts)] = np.asarray(counts, dtype=np.float64) + 0.5
    bounds = class_bounds(weight[: len(counts)])
    upto = np.concatenate([[0.0], np.cumsum(weight)])
    total = upto[bounds[1:]] - upto[bounds[:-1]]
    with np.errstate(divide="ignore", invalid="ignore"):
        cls = np.where(total > 0, np.log(total / total.sum()), NEVER)
        inside = np.where(weight > 0, np.log(weight / np.repeat(total, np.diff(bounds))), NEVER)
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    out = Params({
        "emb": small(WORDS, 3 * HIDDEN), "rec": small(HIDDEN, 3 * HIDDEN), "bias": np.zeros(3 * HIDDEN, np.float32),
        "cls": np.zeros((HIDDEN, CLASSES), np.float32), "cls_bias": cls.astype(np.float32),
        "out": np.zeros((WORDS, HIDDEN), np.float32), "out_bias": inside.astype(np.float32),
    })
    out.bounds = bounds
    return out


def pack(p: Params) -> np.ndarray:
    return np.concatenate([*[p[n].ravel() for n in NAMES], p.bounds.astype(np.float32)])


def unpack(flat: np.ndarray) -> Params:
    out, at = Params(), 0
    for n in NAMES:
        k = int(np.prod(SHAPES[n]))
        out[n] = flat[at:at + k].reshape(SHAPES[n]).astype(np.float32)
        at += k
    out.bounds = flat[at:].astype(np.int64)
    return out


def blocks(p: dict):
    """(number, values) of parameter blocks: a run of words and their outputs each, and last what all share."""
    for c in range(BLOCKS):
        own = slice(c * RUN, (c + 1) * RUN)
        yield c, np.concatenate([p[n][own].ravel() for n in ("emb", "out", "out_bias")])
    yield BLOCKS, np.concatenate([p[n].ravel() for n in ("rec", "bias", "cls", "cls_bias")])


def add_block(p: dict, number: int, values: np.ndarray) -> None:
    """Add to the parameters of one block, in place."""
    if number < BLOCKS:
        own = slice(number * RUN, (number + 1) * RUN)
        parts = [p[n][own] for n in ("emb", "out", "out_bias")]
    else:
        parts = [p[n] for n in ("rec", "bias", "cls", "cls_bias")]
    at = 0
    for part in parts:
        part += values[at:at + part.size].reshape(part.shape).astype(part.dtype)
        at += part.size


def _sigmoid(x):
    """In place of x; an exponential beyond the range is infinite and gives 0."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _sums_by_number(numbers, values):
    """(numbers that occur, sum of the rows of ``values`` of each).  Most occur a few times: their
    second rows are added together, then their third ones; long runs are added by a product."""
    order = np.argsort(numbers.astype(np.uint16), kind="stable")
    numbers, values = numbers[order], np.take(values, order, axis=0)
    first = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
    times = np.diff(np.append(first, len(numbers)))
    sums = np.take(values, first, axis=0)
    few = np.flatnonzero((times > 1) & (times <= 8))
    for k in range(1, 8):
        few = few[times[few] > k]
        sums[few] += np.take(values, first[few] + k, axis=0)
    for i in np.flatnonzero(times > 8):
        own = values[first[i]:first[i] + times[i]]
        sums[i] = np.ones(len(own), own.dtype) @ own
    return numbers[first], sums


def _softmax(x, target, shift: bool):
    """Exponentials of every row (in place of x), the targets' places in them, their sums, and natural log
    probabilities of the targets; ``shift``: take each row's highest value off first."""
    if shift:
        x -= x.max(axis=1, keepdims=True)
    at = np.arange(0, x.size, x.shape[1])
    at += target
    logp = x.reshape(-1)[at].astype(np.float64)
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)  # a product adds faster than a sum by rows
    return x, at, total, logp - np.log(total)


class Model:
    def __init__(self, params: dict):
        self.p = params
        self.bounds = getattr(params, "bounds", Params.bounds)
        self.class_of = np.repeat(np.arange(CLASSES, dtype=np.int16), np.diff(self.bounds))
        self.shift, self.checked = True, 0

    def _bound(self, slack: float = 0.0) -> None:
        """Rows need no shift where no state can bring an exponential near the ends of 32 bits: states lie
        within -1 and 1, so an output is its bias give or take the sum of its weights, and ``slack``."""
        p = self.p
        reach, wide = np.abs(p["out"]).sum(axis=1), np.abs(p["cls"]).sum(axis=0)
        used = (np.diff(self.bounds) > 0) & (p["cls_bias"] > NEVER / 2)
        first = np.minimum(self.bounds[:-1], WORDS - 1)
        lowest = np.maximum.reduceat(p["out_bias"] - reach, first)[used]
        high = max((p["out_bias"] + reach).max(), (p["cls_bias"] + wide).max())
        low = min(lowest.min(initial=0), (p["cls_bias"] - wide).max())
        self.shift = not (high < 60 - slack and low > slack - 60)

    def _step(self, h, x):
        """One token of every text; a text is a column, so that gates are whole runs of memory."""
        u = self.p["rec"].T @ h
        gate = u[: 2 * HIDDEN]
        gate += x[: 2 * HIDDEN]
        z, r = _sigmoid(gate).reshape(2, HIDDEN, -1)
        n = r * u[2 * HIDDEN:]
        n += x[2 * HIDDEN:]
        np.tanh(n, out=n)
        new = h - n
        new *= z
        new += n
        return new, (h, z, r, n, u[2 * HIDDEN:])

    def _in_classes(self, h, cls, inside):
        """(class, rows, exponentials, targets' places, sums, their log probabilities) of every class that occurs, a
        bounded number of rows at once; h is in class order and ends with a column of ones, for the biases."""
        p = self.p
        cuts = np.searchsorted(cls, np.arange(CLASSES + 1))
        for c in np.flatnonzero(np.diff(cuts)):
            own = slice(self.bounds[c], self.bounds[c + 1])
            weights = np.concatenate([p["out"][own].T, p["out_bias"][None, own]])
            step = max(1, CELLS // weights.shape[1])
            for at in range(cuts[c], cuts[c + 1], step):
                rows = slice(at, min(at + step, cuts[c + 1]))
                yield (c, rows, *_softmax(h[rows] @ weights, inside[rows], self.shift))

    def _with_ones(self, h, order):
        """The rows of h in this order and a column of ones."""
        out = np.ones((len(order), HIDDEN + 1), h.dtype)
        out[:, :HIDDEN] = np.take(h, order, axis=0)
        return out

    def _classes(self, h, cls):
        """(rows, exponentials, places of the classes ``cls``, sums, their log probabilities), a bounded number of rows at
        once; h ends with a column of ones."""
        weights, step = np.concatenate([self.p["cls"], self.p["cls_bias"][None]]), CELLS // CLASSES
        for at in range(0, len(h), step):
            rows = slice(at, at + step)
            yield (rows, *_softmax(h[rows] @ weights, cls[rows], self.shift))

    def _in_order(self, target):
        """(order, class, place in the class) of targets, by class."""
        cls = self.class_of[target]
        order = np.argsort(cls, kind="stable")
        cls = cls[order].astype(np.int64)
        return order, cls, target[order] - self.bounds[cls]

    def _logp(self, h, target):
        """Natural log probabilities of the targets."""
        order, cls, inside = self._in_order(target)
        h, logp = self._with_ones(h, order), np.empty(len(h))
        for rows, *_, own in self._classes(h, cls):
            logp[rows] = own
        for _, rows, *_, own in self._in_classes(h, cls, inside):
            logp[rows] += own
        out = np.empty(len(h))
        out[order] = logp
        return out

    def score(self, texts: list, window: int = 32, rows: int = 1 << 18) -> np.ndarray:
        """Natural log probability of each text: number arrays that end with 0.  At most ``rows`` tokens of a
        window are run together; the outputs of several narrow windows are taken together."""
        self._bound()
        order = np.argsort([-len(t) for t in texts], kind="stable")
        length = np.array([len(texts[i]) for i in order])
        out = np.zeros(len(texts))
        states, who, what, held = [], [], [], 0

        def add():
            out[:] += np.bincount(np.concatenate(who), weights=self._logp(np.concatenate(states), np.concatenate(what)), minlength=len(out))
            states.clear(), who.clear(), what.clear()

        most, emb = max(1, min(rows // window, TEXTS)), self.p["emb"] + self.p["bias"]
        for first in range(0, len(order), most):
            some = order[first:first + most]
            size = length[first:first + len(some)]
            h = np.zeros((HIDDEN, len(some)), np.float32)
            last = np.zeros(len(some), dtype=np.int64)
            for at in range(0, int(size[0]), window):
                steps = min(window, int(size[0]) - at)
                on = np.searchsorted(-size, -np.arange(at, at + steps)).tolist()  # longer texts come first
                live = on[0]
                token = np.zeros((steps, live), dtype=np.int64)
                for j in range(live):
                    t = texts[some[j]][at:at + steps]
                    token[: len(t), j] = t
                x = np.take(emb, np.concatenate([last[None, :live], token[:-1]]), axis=0)
                h, last = h[:, :live], token[-1]
                with np.errstate(over="ignore"):
                    for k in range(steps):
                        h, _ = self._step(h[:, :on[k]], np.ascontiguousarray(x[k, :on[k]].T))
                        states.append(np.ascontiguousarray(h.T))
                real = np.arange(at, at + steps)[:, None] < size[:live]
                who.append(np.broadcast_to(some[:live], real.shape)[real])
                what.append(token[real])
                held += sum(on)
                if held >= rows // 4:
                    add()
                    held = 0
        if states:
            add()
        return out

    def learn(self, token: np.ndarray, valid: np.ndarray, h: np.ndarray, last: np.ndarray, memory: dict, rate: float):
        """One window of a batch (time x texts): forward, backward, Adagrad; returns the new state."""
        p = self.p
        if not self.checked:  # a step moves no parameter by more than the rate
            self._bound(RECHECK * rate * (HIDDEN + 1))
            self.checked = RECHECK
        self.checked -= 1
        steps, states, kept = len(token), [], []
        before = np.concatenate([last[None], token[:-1]])
        x = np.take(p["emb"], before, axis=0)
        x += p["bias"]
        h = np.ascontiguousarray(h.T)
        with np.errstate(over="ignore"):
            for k in range(steps):
                h, keep = self._step(h, np.ascontiguousarray(x[k].T))
                states.append(np.ascontiguousarray(h.T))
                kept.append(keep)
        flat = np.concatenate(states)
        on = np.flatnonzero(valid.ravel())
        target = token.ravel()[on]
        order, cls, inside = self._in_order(target)
        on = on[order]  # in class order
        hs = self._with_ones(flat, on)
        scale = np.asarray(1 / max(len(on), 1), dtype=flat.dtype)

        def take(name, g, at=...):
            m = memory[name][at]
            m += g * g
            if isinstance(at, np.ndarray):  # m is a copy then
                memory[name][at] = m
            m = m + 1e-8
            np.sqrt(m, out=m)
            g *= rate
            g /= m
            p[name][at] -= g

        # The gradient of a row's outputs is scale / total times (exponentials, less the total at the target):
        # the factor goes to the narrow sides of the products.
        loss, dh_on = 0.0, np.empty((len(hs), HIDDEN), hs.dtype)
        g_cls = np.zeros((HIDDEN + 1, CLASSES), hs.dtype)
        for rows, e, at, total, logp in self._classes(hs, cls):
            loss -= float(logp.sum())
            e.reshape(-1)[at] -= total
            part = scale / total
            np.multiply(e @ p["cls"].T, part[:, None], out=dh_on[rows])
            g_cls += (e.T @ (hs[rows] * part[:, None])).T
        grown = None  # (class, gradients): summed over the class's rows
        for c, rows, e, at, total, logp in self._in_classes(hs, cls, inside):
            loss -= float(logp.sum())
            e.reshape(-1)[at] -= total
            part = scale / total
            own = slice(self.bounds[c], self.bounds[c + 1])
            dh = e @ p["out"][own]
            dh *= part[:, None]
            dh_on[rows] += dh
            g_out, g_own = e.T @ (hs[rows, :HIDDEN] * part[:, None]), part @ e
            if grown and grown[0] == c:
                g_out, g_own = g_out + grown[1], g_own + grown[2]
            grown = c, g_out, g_own
            if rows.stop == len(cls) or cls[rows.stop] != c:
                take("out", g_out, own)
                take("out_bias", g_own, own)
        take("cls", g_cls[:HIDDEN])
        take("cls_bias", g_cls[HIDDEN])
        dh_all = np.zeros_like(flat)
        dh_all[on] = dh_on
        dh_all = dh_all.reshape(steps, -1, HIDDEN)
        back, rec, g_rec = np.zeros_like(h), p["rec"], np.zeros_like(p["rec"])
        dx, width = np.empty_like(x), h.shape[1]
        own, du = np.empty((2, 3 * HIDDEN, width + 16), x.dtype)[:, :, :width]  # strides off powers of two transpose faster
        for k in range(steps - 1, -1, -1):
            prev, z, r, n, un = kept[k]
            back += dh_all[k].T
            dn = 1 - n * n
            dn *= back
            dz = 1 - z
            dn *= dz
            dr = dn * r
            dz *= z
            dz *= prev - n
            np.multiply(dz, back, out=own[:HIDDEN])
            np.multiply(dr, un, out=own[HIDDEN:2 * HIDDEN])
            own[HIDDEN:2 * HIDDEN] *= 1 - r
            own[2 * HIDDEN:] = dn
            dx[k] = own.T
            du[: 2 * HIDDEN], du[2 * HIDDEN:] = own[: 2 * HIDDEN], dr
            g_rec += prev @ du.T
            back *= z
            back += rec @ du
        dx = dx.reshape(-1, 3 * HIDDEN)
        take("rec", g_rec)
        take("bias", np.ones(len(dx), dx.dtype) @ dx)
        word, sums = _sums_by_number(before.ravel(), dx)
        take("emb", sums, word)
        return h.T, token[-1], loss


def train(params: dict, texts, batch: int = 128, window: int = 32, rate: float = 0.05) -> dict:
    """One pass over number arrays, in batches of similar use; the state runs through a text's windows."""
    return train_rows(params, ((0, i, False, t) for i, t in enumerate(texts)), batch, window, rate)


def train_rows(params: dict, rows, batch: int = 128, window: int = 32, rate: float = 0.05) -> dict:
    """One pass over (step, text, more, numbers): a text's rows come in order, in different steps, and hold
    whole windows; ``more`` tells that another row follows, which starts from this one's last state."""
    model = Model(params.copied() if isinstance(params, Params) else {n: v.copy() for n, v in params.items()})
    memory = {n: np.full_like(v, 1e-3) for n, v in params.items()}
    zero = (np.zeros(HIDDEN, np.float32), 0)
    states, held, now = {}, [], None

    def update():
        held.sort(key=lambda r: -len(r[2]))
        length = np.array([len(t) for _, _, t in held])
        begin = [states.pop(text, zero) for text, _, _ in held]
        h, last = np.stack([b[0] for b in begin]), np.array([b[1] for b in begin], dtype=np.int64)
        for at in range(0, int(length[0]), window):
            live = int(np.searchsorted(-length, -at))  # longer rows come first
            steps = min(window, int(length[0]) - at)
            token = np.zeros((steps, live), dtype=np.int64)
            valid = np.zeros((steps, live), dtype=bool)
            for j in range(live):
                part = held[j][2][at:at + steps]
                token[: len(part), j], valid[: len(part), j] = part, True
            h, last, _ = model.learn(token, valid, h[:live], last[:live], memory, rate)
            for j in np.flatnonzero(length[:live] <= at + window):
                if held[j][1]:
                    states[held[j][0]] = (h[j].copy(), int(last[j]))

    for step, text, more, numbers in rows:
        if held and (step != now or len(held) == batch):
            update()
            held = []
        now = step
        held.append((text, more, numbers))
    if held:
        update()
    return model.p
