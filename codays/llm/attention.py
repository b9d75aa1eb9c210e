"""A small causal self-attention model over class numbers, in numpy.

One head reads windows of ``WINDOW`` classes. Classes are the symbols of
``subword_code``, one to three for each subword id.
"""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

CLASSES, WIDTH, WINDOW, STRIDE = 256, 16, 64, 48
#: Share of the class frequencies mixed into the predictions.
FREQUENCIES = 0.05
LEARNING_RATE = 0.05
#: Single precision holds sums of exponentials of up to this, and their quotients, without a factor.
SAFE_POWER = 40.0
SHAPES = {
    "embedding": (CLASSES, WIDTH),
    "query": (WIDTH, WIDTH),
    "key": (WIDTH, WIDTH),
    "value": (WIDTH, WIDTH),
    "lag": (WINDOW,),
    "output": (WIDTH, CLASSES),
    "bias": (CLASSES,),
}
_LAGS = np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :]
_SEEN = _LAGS >= 0


def initial(frequencies: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Small random weights; the bias starts from the class frequencies."""
    draws = np.random.default_rng(seed)
    weights = {name: draws.normal(0, 0.3, shape) / np.sqrt(WIDTH) for name, shape in SHAPES.items()}
    weights["embedding"] = draws.normal(0, 0.5, SHAPES["embedding"])
    weights["lag"] = np.zeros(WINDOW)
    weights["bias"] = np.log(frequencies)
    return weights


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[name].ravel() for name in SHAPES]).astype(np.float64)


def shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = values[at : at + size].reshape(shape)
        at += size
    return out


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows over sequences that lie one after the other.

    For each window: where it starts, how many classes it holds, and from which
    of them on it scores. Every class is scored in one window; all windows but
    a sequence's first have ``WINDOW - STRIDE`` classes of context to begin with.
    """
    number = np.maximum(1, -(-(lengths - (WINDOW - STRIDE)) // STRIDE)) * (lengths > 0)
    owner = np.repeat(np.arange(len(lengths)), number)
    which = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
    begins = which * STRIDE
    held = np.minimum(WINDOW, lengths[owner] - begins)
    scored_from = np.where(which > 0, WINDOW - STRIDE, 0)
    return (np.cumsum(lengths) - lengths)[owner] + begins, held, scored_from


def _gather(values: np.ndarray, starts: np.ndarray, most: int = WINDOW) -> np.ndarray:
    return np.take(values, starts[:, None] + np.arange(most), mode="clip")


def _exponentials(logits: Callable[[], np.ndarray]) -> np.ndarray:
    """Exponentials of the rows that ``logits`` makes, up to a factor for each row."""
    powers = logits()
    powers -= powers.max()
    np.exp(powers, out=powers)
    if not (powers.sum(axis=-1) > 1e-30).all():
        # One maximum for all is cheaper, but some rows are far below it.
        powers = logits()
        powers -= powers.max(axis=-1, keepdims=True)
        np.exp(powers, out=powers)
    return powers


class Scratch:
    """Arrays that are used again batch after batch, as new ones cost more than what is done with them."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, shape: tuple[int, ...], kind: np.dtype | type) -> np.ndarray:
        size = int(np.prod(shape))
        if name not in self.held or len(self.held[name]) < size:
            self.held[name] = np.empty(size, kind)
        return self.held[name][:size].reshape(shape)

    def rows(self, name: str, table: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows of a table; without a check of their numbers, which takes an array of its own."""
        out = self(name, (*at.shape, table.shape[1]), table.dtype)
        return np.take(table, at, axis=0, out=out, mode="clip")

    def product(self, name: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.matmul(a, b, out=self(name, (*a.shape[:-1], b.shape[-1]), a.dtype))


def _powers(h: np.ndarray, predicting: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Exponentials of the predictions from rows of ``h``, up to a factor for each row.

    The last column of ``h`` is one, the last row of ``predicting`` the bias.
    """
    # No prediction is larger than this, and small ones need no factor.
    lengths = [float(np.sqrt(np.einsum("ij,ij->i", a, a).max(initial=0))) for a in (h[:, :-1], predicting[:-1].T)]
    if lengths[0] * lengths[1] + float(np.abs(predicting[-1]).max()) > SAFE_POWER:
        return _exponentials(lambda: h @ predicting)
    powers = scratch.product("powers", h, predicting)
    return np.exp(powers, out=powers)


def _with_ones(rows: np.ndarray) -> np.ndarray:
    return np.concatenate((rows, np.ones((*rows.shape[:-1], 1), rows.dtype)), axis=-1)


class Slopes:
    """The loss and its gradient summed over windows, from tables of what each class asks, offers and gives.

    Slopes of what a class asks, offers, gives and is are summed by class, and only
    at the end go through the weights, so each window does what differs between windows.
    """

    def __init__(self, w: dict[str, np.ndarray]):
        self.w, kind, self.scratch = w, w["embedding"].dtype, Scratch()
        embedding = w["embedding"]
        # A plain float: a double of numpy would turn all that follows into doubles.
        self.scale = float(1 / np.sqrt(WIDTH))
        self.queries, self.keys = (embedding @ w["query"]) * self.scale, embedding @ w["key"]
        self.values = _with_ones(embedding @ w["value"])
        self.predicting = np.concatenate((w["output"], w["bias"][None]))
        self.back = np.ascontiguousarray(_with_ones(w["output"].T))
        self.additive = np.where(_SEEN, w["lag"][np.maximum(_LAGS, 0)], -1e9).astype(kind)
        most = max(float(np.abs(self.queries @ self.keys.T).max()), float(np.abs(w["lag"]).max()))
        #: Factors of the lags, if exponentials of attention and lag need no other.
        self.factors = np.exp(self.additive) if most <= SAFE_POWER / 2 else None
        self.places = np.arange(CLASSES * 4 * WIDTH).reshape(CLASSES, 4 * WIDTH)
        self.by_class = np.zeros(CLASSES * 4 * WIDTH)
        self.by_lag = np.zeros((WINDOW, WINDOW))
        self.predicted = np.zeros((CLASSES, WIDTH + 1))
        self.loss, self.n = 0.0, 0

    def _attended(self, q: np.ndarray, k: np.ndarray) -> np.ndarray:
        turned, most = k.transpose(0, 2, 1), k.shape[1]
        if self.factors is None:
            return _exponentials(lambda: q @ turned + self.additive[:most, :most])
        p = self.scratch.product("attention", q, turned)
        np.exp(p, out=p)
        p *= self.factors[:most, :most]
        return p

    def add(self, x: np.ndarray, y: np.ndarray, counted: np.ndarray) -> None:
        """Windows of inputs and targets, as long as the longest, of which the counted places are learned."""
        scratch, kind = self.scratch, self.back.dtype
        e = scratch.rows("e", self.w["embedding"], x)
        q, k, v = scratch.rows("q", self.queries, x), scratch.rows("k", self.keys, x), scratch.rows("v", self.values, x)
        p = self._attended(q, k)
        read = scratch.product("read", p, v)
        share = 1 / read[..., -1:]
        # The last column becomes one, as the bias wants it.
        read *= share
        h = scratch("h", read.shape, kind)
        h[...] = read
        h[..., :-1] += e
        whole = bool(counted.all())
        h, y = (h.reshape(-1, WIDTH + 1), y.reshape(-1)) if whole else (h[counted], y[counted])
        guess = _powers(h, self.predicting, scratch)
        sent = scratch.product("sent", guess, self.back)
        sums = sent[:, -1:].copy()
        at = np.arange(len(y)) * CLASSES + y
        flat_guess = guess.reshape(-1)
        right = flat_guess[at]
        self.loss -= float(np.log(right / sums[:, 0] + 1e-30).sum())
        self.n += len(y)
        flat_guess[at] = right - sums[:, 0]
        h /= sums
        self.predicted += guess.T @ h
        sent /= sums
        sent -= scratch.rows("wanted", self.back, y)
        # Both had a one in the last column.
        d_h = scratch("d_h", e.shape, kind)
        if whole:
            d_h.reshape(-1, WIDTH)[...] = sent[:, :-1]
        else:
            d_h[...] = 0
            d_h[counted] = sent[:, :-1]
        # What a row of attention would give in all is what was read by it.
        given = scratch("given", read.shape, kind)
        np.multiply(d_h, share, out=given[..., :-1])
        np.einsum("bij,bij->bi", given[..., :-1], read[..., :-1], out=given[..., -1])
        given[..., -1] *= -1
        d_logits = scratch.product("d_logits", given, v.transpose(0, 2, 1))
        d_logits *= p
        self.by_lag[: x.shape[1], : x.shape[1]] += d_logits.sum(0)
        slopes = scratch("slopes", (*x.shape, 4 * WIDTH), np.float64)
        slopes[..., :WIDTH] = d_h
        slopes[..., WIDTH : 2 * WIDTH] = scratch.product("d_q", d_logits, k)
        slopes[..., 2 * WIDTH : 3 * WIDTH] = scratch.product("d_k", d_logits.transpose(0, 2, 1), q)
        slopes[..., 3 * WIDTH :] = scratch.product("d_v", p.transpose(0, 2, 1), given)[..., :-1]
        places = scratch.rows("places", self.places, x.reshape(-1))
        self.by_class += np.bincount(places.reshape(-1), weights=slopes.reshape(-1), minlength=len(self.by_class))

    def gradient(self) -> dict[str, np.ndarray]:
        w = {name: value.astype(np.float64) for name, value in self.w.items()}
        own, *passed = self.by_class.reshape(CLASSES, 4, WIDTH).transpose(1, 0, 2)
        passed[0] = passed[0] * self.scale
        g = {"output": self.predicted[:, :-1].T, "bias": self.predicted[:, -1], "embedding": own}
        for name, slope in zip(("query", "key", "value"), passed):
            g[name] = w["embedding"].T @ slope
            g["embedding"] = g["embedding"] + slope @ w[name].T
        g["lag"] = np.bincount(_LAGS[_SEEN], weights=self.by_lag[_SEEN], minlength=WINDOW)
        return g


def gradient(
    w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, counted: np.ndarray
) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss of the counted places of a batch of windows, and its gradient."""
    slopes = Slopes(w)
    slopes.add(x, y, counted)
    n = max(1, slopes.n)
    return slopes.loss / n, {name: g / n for name, g in slopes.gradient().items()}


def apart(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of windows that follow each other, so that each class is learned once."""
    number = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(lengths)), number)
    begins = (np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)) * WINDOW
    return (np.cumsum(lengths) - lengths)[owner] + begins, np.minimum(WINDOW, lengths[owner] - begins)


def summed_gradient(
    values: np.ndarray, inputs: np.ndarray, targets: np.ndarray, lengths: np.ndarray, batch: int = 32
) -> tuple[np.ndarray, int]:
    """The gradient summed over all targets, in doubles, and how many these are."""
    slopes = Slopes({name: value.astype(np.float32) for name, value in shaped(values).items()})
    starts, held = apart(lengths)
    # Windows of a length stand together, so that no more is computed than they hold.
    order = np.argsort(-held, kind="stable")
    starts, held = starts[order], held[order]
    for begin in range(0, len(starts), batch):
        own, most = slice(begin, begin + batch), int(held[begin])
        counted = np.arange(most) < held[own][:, None]
        slopes.add(_gather(inputs, starts[own], most), _gather(targets, starts[own], most), counted)
    return flat(slopes.gradient()), slopes.n


class Adam:
    """Steps over flat weights, with a rate that falls to zero over ``steps``."""

    def __init__(self, values: np.ndarray, steps: int, rate: float = LEARNING_RATE):
        self.values, self.steps, self.rate, self.step = values.copy(), steps, rate, 0
        self.mean, self.square = np.zeros_like(values), np.zeros_like(values)

    def follow(self, slope: np.ndarray) -> None:
        rate = self.rate * (1 - self.step / self.steps)
        self.step += 1
        self.mean += 0.1 * (slope - self.mean)
        self.square += 0.05 * (slope**2 - self.square)
        mean, square = self.mean / (1 - 0.9**self.step), self.square / (1 - 0.95**self.step)
        self.values -= rate * mean / (np.sqrt(square) + 1e-8)


@dataclass
class Scorer:
    """The trained model as tables."""

    queries: np.ndarray
    keys: np.ndarray
    lags: np.ndarray
    values: np.ndarray
    embedding: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    frequencies: np.ndarray

    @classmethod
    def of(cls, w: dict[str, np.ndarray], frequencies: np.ndarray) -> "Scorer":
        queries, keys = w["embedding"] @ w["query"] / np.sqrt(WIDTH), w["embedding"] @ w["key"]
        # One more column takes the largest attention that a class can give from all that it gives.
        queries = np.column_stack((queries, -(queries @ keys.T).max(axis=1)))
        keys = np.column_stack((keys, np.ones(CLASSES)))
        lags = np.where(_SEEN, np.exp(w["lag"] - w["lag"].max())[np.maximum(_LAGS, 0)], 0.0)
        values = np.column_stack((w["embedding"] @ w["value"], np.ones(CLASSES)))
        arrays = (queries, keys, lags, values, w["embedding"], w["output"], w["bias"])
        return cls(*[np.ascontiguousarray(a, np.float32) for a in arrays], frequencies)

    def places(
        self, inputs: np.ndarray, targets: np.ndarray, lengths: np.ndarray, groups: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Probability of the target at each place, and that of each group of classes there.

        ``inputs`` and ``targets`` hold the sequences one after the other, with
        ``lengths`` classes each. ``groups`` has a column of ones and zeros for each group.
        """
        chosen = np.zeros(len(inputs))
        masses = np.zeros((len(inputs), groups.shape[1]))
        usual, of_groups = self.frequencies @ groups, _with_ones(groups.astype(np.float32))
        predicting = np.concatenate((self.output, self.bias[None]))
        starts, held, scored_from = windows(lengths)
        scratch = Scratch()
        # Windows that score from the same place on, and of a length, stand together.
        order = np.lexsort((-held, scored_from))
        later = int(np.count_nonzero(scored_from == 0))
        for first, those in ((0, order[:later]), (WINDOW - STRIDE, order[later:])):
            for begin in range(0, len(those), 32):
                own = those[begin : begin + 32]
                most = int(held[own[0]])
                x = _gather(inputs, starts[own], most)
                keys, values = scratch.rows("keys", self.keys, x), scratch.rows("values", self.values, x)
                asking = x[:, first:]
                weights = scratch.product("weights", scratch.rows("queries", self.queries, asking), keys.transpose(0, 2, 1))
                np.exp(weights, out=weights)
                weights *= self.lags[first:most, :most]
                h = scratch.product("read", weights, values)
                # The last column becomes one, as the bias wants it.
                h /= h[..., -1:].copy()
                h[..., :-1] += scratch.rows("embedding", self.embedding, asking)
                at = np.arange(first, most)
                counted = at < held[own][:, None]
                at = at + starts[own][:, None]
                h, at = (h.reshape(-1, WIDTH + 1), at.reshape(-1)) if counted.all() else (h[counted], at[counted])
                y = targets[at]
                powers = _powers(h, predicting, scratch)
                sums = scratch.product("sums", powers, of_groups)
                share = (1 - FREQUENCIES) / sums[:, -1]
                p = powers.reshape(-1)[np.arange(len(y)) * CLASSES + y]
                chosen[at] = p * share + FREQUENCIES * self.frequencies[y]
                masses[at] = sums[:, :-1] * share[:, None] + FREQUENCIES * usual
        return chosen, masses

    def log10(self, inputs: np.ndarray, targets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sum of log10 probabilities of the targets of each sequence."""
        chosen, _ = self.places(inputs, targets, lengths, np.zeros((CLASSES, 0)))
        total = np.concatenate(([0.0], np.cumsum(np.log10(chosen))))
        ends = np.cumsum(lengths)
        return total[ends] - total[ends - lengths]
