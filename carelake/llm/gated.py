"""A small bidirectional gated recurrent network with attention pooling, in numpy.

Each word is the sum of the vectors of its byte n-grams and of its own, by
hashing.  A window of words runs through a gated unit in either direction; the
states are averaged with learned attention, and a linear layer gives the logit.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np

WINDOW = 32
GRAMS = (3, 4, 5, 6)
BUCKETS = 1 << 17
SIGNS = b".,;:!?\"'()[]{}*#&$%|<>-_"
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Words whose n-grams are found at once.
_WORDS = 50_000


def plain(word: bytes) -> bytes:
    return word.lower().strip(SIGNS)


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' n-grams one after the other, and where each word's begin."""
    marked = [b"<" + w + b">" for w in words]
    lengths = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint64)
    room = np.repeat(ends, lengths) - np.arange(len(data))
    of_word = np.repeat(np.arange(len(words)), lengths)
    rolled = data.copy()
    # Of each word: its own bucket, then its n-grams by length and place.
    own = np.array([lengths - n + 1 for n in GRAMS]).clip(0)
    bounds = np.concatenate(([0], np.cumsum(1 + own.sum(axis=0))))
    found = np.empty(bounds[-1], dtype=np.uint64)
    found[bounds[:-1]] = np.fromiter((zlib.crc32(w) for w in words), dtype=np.uint64, count=len(words)) + np.uint64(7)
    # Where the n-gram that begins at a byte goes: ``to`` and the byte's place in the data.
    to = bounds[:-1] + 1 - (ends - lengths)
    for n in range(2, GRAMS[-1] + 1):
        rolled[: len(data) - n + 1] = rolled[: len(data) - n + 1] * np.uint64(257) + data[n - 1 :]
        if n in GRAMS:
            at = np.flatnonzero(room >= n)
            found[to[of_word[at]] + at] = rolled[at] + np.uint64(n << 60)
            to += own[GRAMS.index(n)]
    return ((found * _MIX) >> np.uint64(47)).astype(np.int32), bounds


def grams_of(words: list[bytes], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``grams``, some words at a time; only ``wanted`` buckets, if given."""
    found, ends = [np.zeros(0, dtype=np.int32)], [np.zeros(1, dtype=np.int64)]
    for at in range(0, len(words), _WORDS):
        buckets, bounds = grams(words[at : at + _WORDS])
        if wanted is not None:
            kept = wanted[buckets]
            buckets, bounds = buckets[kept], np.concatenate(([0], np.cumsum(kept)))[bounds]
        found.append(buckets)
        ends.append(bounds[1:] + ends[-1][-1])
    return np.concatenate(found), np.concatenate(ends)


def texts_with(words: list[bytes], index: np.ndarray, text: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For the kinds 0 and 1: how many texts have each bucket.  ``text`` is sorted."""
    buckets, bounds = grams_of(words)
    counts = np.zeros((2, BUCKETS), dtype=np.int64)
    starts = np.flatnonzero(np.diff(text, prepend=-1))
    for rows, k in zip(np.split(index, starts[1:]), wanted[starts]):
        own = np.unique(rows)
        own = own[own >= 0]
        sizes = bounds[own + 1] - bounds[own]
        stops = np.cumsum(sizes)
        at = buckets[np.repeat(bounds[own] - stops + sizes, sizes) + np.arange(stops[-1] if len(own) else 0)]
        of = counts[int(k)]
        of[at] = of[at] + 1  # by one, however often ``at`` has the bucket
    return counts


def telling(counts: np.ndarray, n: np.ndarray, least: float = 3.5) -> np.ndarray:
    """Buckets whose share of the ``n`` texts differs between the kinds by ``least`` standard errors.

    A rare n-gram of one toxic text would be learned by heart; these are the
    n-grams that many texts of one kind have and few of the other.
    """
    n = np.maximum(1, n)
    both = counts.sum(axis=0) / n.sum()
    error = np.sqrt(both * (1 - both) * (1 / n).sum()) + 1e-12
    return np.abs(counts[1] / n[1] - counts[0] / n[0]) > least * error


def windows(n_words: np.ndarray, window: int = WINDOW, stride: int = WINDOW * 3 // 4) -> tuple[np.ndarray, np.ndarray]:
    """For texts of so many words: each window's text, and its first word within it.

    Windows overlap by ``window - stride`` words and cover every word; a text
    without words has one empty window.
    """
    count = 1 + np.maximum(0, -(-(n_words - window) // stride))
    text = np.repeat(np.arange(len(n_words)), count)
    first = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * stride
    return text, first


def _summed(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """``n`` sums of the rows that go to each place."""
    return np.stack([np.bincount(at, weights=c, minlength=n) for c in rows.T], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x = 0.5 * x
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def _swapped(rows: np.ndarray) -> np.ndarray:
    """From (steps, windows, numbers) to (steps, numbers, windows), and back."""
    return np.ascontiguousarray(rows.transpose(0, 2, 1))


@dataclass
class Network:
    """``size`` inputs a word, ``hidden`` states in each direction."""

    size: int = 8
    hidden: int = 8
    seed: int = 5
    p: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        draw = np.random.default_rng(self.seed)
        h, d = self.hidden, self.size
        shapes = {"emb": (BUCKETS, d), "att": (2 * h,), "out": (2 * h,), "bias": (1,)}
        for way in "fb":
            shapes |= {f"w{way}": (d, 3 * h), f"c{way}": (3 * h,), f"u{way}": (h, 3 * h)}
        scale = {"emb": 0.05, "bias": 0.0, "cf": 0.0, "cb": 0.0}
        self.p = {
            k: (draw.standard_normal(s) * scale.get(k, 0.4)).astype(np.float32) for k, s in shapes.items()
        }

    def packed(self) -> dict:
        """What ``unpacked`` makes the network of, without the rows of zeros."""
        rows = np.flatnonzero(self.p["emb"].any(axis=1))
        return {"size": self.size, "hidden": self.hidden, "rows": rows, "p": self.p | {"emb": self.p["emb"][rows]}}

    @classmethod
    def unpacked(cls, packed: dict) -> Network:
        emb = np.zeros((BUCKETS, packed["size"]), dtype=np.float32)
        emb[packed["rows"]] = packed["p"]["emb"]
        own = cls(packed["size"], packed["hidden"], p={})
        # Not the arrays themselves, which a fit would change.
        own.p = {k: v.copy() for k, v in packed["p"].items()} | {"emb": emb}
        return own

    def flat(self, rows: np.ndarray) -> np.ndarray:
        """All numbers in one array, of the table of n-grams only these rows."""
        return np.concatenate([(v[rows] if k == "emb" else v).ravel() for k, v in sorted(self.p.items())])

    def moved(self, rows: np.ndarray, flat: np.ndarray) -> Network:
        """A network of these numbers, in the order of ``flat``, with zeros in other rows."""
        own, at = Network(self.size, self.hidden, p={}), 0
        for k, v in sorted(self.p.items()):
            shape = (len(rows), self.size) if k == "emb" else v.shape
            some = flat[at : at + int(np.prod(shape))].reshape(shape).astype(np.float32)
            at += some.size
            if k == "emb":
                own.p[k] = np.zeros_like(v)
                own.p[k][rows] = some
            else:
                own.p[k] = some
        return own

    def vectors(self, words: list[bytes]) -> np.ndarray:
        """One row per word, and a last row of zeros for places without a word."""
        out = np.zeros((len(words) + 1, self.size), dtype=np.float32)
        moved = self.p["emb"].any(axis=1)
        for at in range(0, len(words), _WORDS):
            buckets, bounds = grams(words[at : at + _WORDS])
            # The other words' vectors are zero.
            some = np.flatnonzero(np.logical_or.reduceat(moved[buckets], bounds[:-1]))
            if len(some):
                sizes = bounds[some + 1] - bounds[some]
                stops = np.cumsum(sizes)
                own = buckets[np.repeat(bounds[some] - stops + sizes, sizes) + np.arange(stops[-1])]
                out[at + some] = np.add.reduceat(self.p["emb"][own], stops - sizes, axis=0)
        return out

    def _run(self, x: np.ndarray, u: np.ndarray, tape: list | None = None) -> np.ndarray:
        """States after each step of ``x`` (steps, windows, 3 * hidden).

        In memory the windows come last, as in the results of ``_into``, so that
        each gate of a step is one stretch of numbers.
        """
        h, u = self.hidden, np.ascontiguousarray(u.T)
        x = x.transpose(0, 2, 1)
        steps, _, n = x.shape
        state = np.zeros((h, n), dtype=np.float32)
        states = np.empty((steps, h, n), dtype=np.float32)
        for t in range(steps):
            past = u @ state
            gates = _sigmoid(x[t, : 2 * h] + past[: 2 * h])
            z, r = gates[:h], gates[h:]
            new = r * past[2 * h :]
            new += x[t, 2 * h :]
            np.tanh(new, out=new)
            if tape is not None:
                tape.append((state, z, r, new, past[2 * h :]))
            state = np.subtract(state, new)
            state *= z
            state += new
            states[t] = state
        return states.transpose(0, 2, 1)

    def _into(self, xs: np.ndarray, way: str) -> np.ndarray:
        """What the inputs (steps, size, windows) add to the gates of a direction."""
        x = self.p[f"w{way}"].T @ xs
        x += self.p[f"c{way}"][:, None]
        return x.transpose(0, 2, 1)

    def _states(self, xs: np.ndarray, tapes: dict) -> np.ndarray:
        """Both directions' states for inputs (steps, windows, size)."""
        xs = _swapped(xs)
        forward = self._run(self._into(xs, "f"), self.p["uf"], tapes.get("f"))
        backward = self._run(self._into(xs[::-1], "b"), self.p["ub"], tapes.get("b"))[::-1]
        states = np.empty((*forward.shape[:2], 2 * self.hidden), dtype=np.float32)
        return np.concatenate([forward, backward], axis=2, out=states)

    def _pool(self, states: np.ndarray, present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Attention over the steps with a word, and the pooled states."""
        scores = np.where(present, states @ self.p["att"], np.float32(-1e4))
        weights = np.exp(scores - scores.max(axis=0))
        weights /= weights.sum(axis=0)
        return weights, np.einsum("tb,tbh->bh", weights, states)

    def logits(self, words: list[bytes], index: np.ndarray, batch: int = 1024) -> np.ndarray:
        """One logit per row of ``index``, whose entries number the words; -1 is none."""
        vectors = self.vectors(words)
        out = np.empty(len(index), dtype=np.float32)
        for at in range(0, len(index), batch):
            some = np.ascontiguousarray(index[at : at + batch].T)
            states = self._states(vectors[some], {})
            out[at : at + batch] = self._pool(states, some >= 0)[1] @ self.p["out"] + self.p["bias"]
        return out

    def _back(self, tape: list, u: np.ndarray, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From the states' gradients those of the gates' inputs (steps, windows, 3 * hidden) and of ``u``."""
        h, grad = self.hidden, _swapped(grad)
        state, z, r, new, past = (np.stack(some) for some in zip(*tape))
        by_new = (1 - z) * (1 - new * new)
        by_z = (state - new) * z * (1 - z)
        by_r = past * r * (1 - r)
        shape = (len(tape), 3 * h, grad.shape[2])
        into_x, into_past = (np.empty(shape, dtype=grad.dtype) for _ in range(2))
        carry = np.zeros_like(grad[0])
        for t in range(len(tape) - 1, -1, -1):
            g, own = grad[t] + carry, into_past[t]
            into_new = into_x[t, 2 * h :]
            np.multiply(g, by_new[t], out=into_new)
            np.multiply(g, by_z[t], out=own[:h])
            np.multiply(into_new, by_r[t], out=own[h : 2 * h])
            np.multiply(into_new, r[t], out=own[2 * h :])
            g *= z[t]
            carry = u @ own
            carry += g
        into_x[:, : 2 * h] = into_past[:, : 2 * h]
        return _swapped(into_x), _swapped(state).reshape(-1, h).T @ _swapped(into_past).reshape(-1, 3 * h)

    def _gradients(self, vectors: np.ndarray, some: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> dict:
        p, h, present = self.p, self.hidden, some >= 0
        xs = vectors[some]
        tapes = {"f": [], "b": []}
        states = self._states(xs, tapes)
        weights, pooled = self._pool(states, present)
        miss = (_sigmoid(pooled @ p["out"] + p["bias"]) - wanted) * weight / len(wanted)
        into_pooled = miss[:, None] * p["out"]
        into_weights = np.einsum("bh,tbh->tb", into_pooled, states)
        into_scores = weights * (into_weights - (weights * into_weights).sum(axis=0))
        into_states = weights[:, :, None] * into_pooled + into_scores[:, :, None] * p["att"]
        grads = {
            "out": miss @ pooled, "bias": np.array([miss.sum()], dtype=np.float32),
            "att": np.einsum("tb,tbh->h", into_scores, states),
        }
        into_xs = 0
        for way, part in (("f", into_states[:, :, :h]), ("b", into_states[::-1, :, h:])):
            into, grads[f"u{way}"] = self._back(tapes[way], p[f"u{way}"], part)
            into = into if way == "f" else into[::-1]
            flat = into.reshape(-1, 3 * h)
            grads[f"w{way}"] = xs.reshape(-1, self.size).T @ flat
            grads[f"c{way}"] = flat.sum(axis=0)
            into_xs = into_xs + into @ p[f"w{way}"].T
        grads["xs"] = into_xs
        return grads

    def fit(
        self, words: list[bytes], index: np.ndarray, wanted: np.ndarray, weight: np.ndarray, telling: np.ndarray, *,
        epochs: int, rate: float = 0.01, batch: int = 256, blank: float = 0.05, decay: float = 0.1,
    ) -> None:
        """Adam on the logistic loss.  Buckets that are not ``telling`` stay zero;
        words are left out at random with the probability ``blank``."""
        buckets, bounds = grams_of(words, telling)
        draw = np.random.default_rng(self.seed)
        buckets = (np.cumsum(telling) - 1)[buckets]
        # Only the telling rows of the table move.
        p = self.p | {"emb": self.p["emb"][telling]}
        first = {k: np.zeros_like(v) for k, v in p.items()}
        second = {k: np.zeros_like(v) for k, v in p.items()}
        whole = self.p
        self.p = p
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(index))
            for at in range(0, len(order), batch):
                chosen = order[at : at + batch]
                some = index[chosen].T.copy()
                some[draw.random(some.shape) < blank] = -1
                used, local = np.unique(some, return_inverse=True)
                local = local.reshape(some.shape)
                lengths = np.where(used >= 0, np.diff(bounds)[used], 0)
                stops = np.concatenate(([0], np.cumsum(lengths)))
                flat = buckets[np.repeat(np.where(used >= 0, bounds[used], 0) - stops[:-1], lengths) + np.arange(stops[-1])]
                owner = np.repeat(np.arange(len(used)), lengths)
                vectors = _summed(owner, p["emb"][flat], len(used) + 1)
                local = np.where(some >= 0, local, len(used))
                grads = self._gradients_at(vectors, local, some >= 0, wanted[chosen], weight[chosen])
                into = _summed(local.ravel(), grads.pop("xs").reshape(-1, self.size), len(used) + 1)
                grads["emb"] = _summed(flat, into[owner], len(p["emb"]))
                step += 1
                for k, g in grads.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    p[k] *= 1 - rate * decay
        emb = np.zeros_like(whole["emb"])
        emb[telling] = p["emb"]
        self.p = p | {"emb": emb}

    def _gradients_at(self, vectors, local, present, wanted, weight) -> dict:
        marked = np.where(present, local, -1)
        return self._gradients(vectors, marked, wanted.astype(np.float32), weight.astype(np.float32))
