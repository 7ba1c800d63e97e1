"""Language-model scoring: a causal self-attention model over subword ids, trained in numpy by Spark tasks, beside word unigrams.

A text is the subword ids of its words in a public byte-pair vocabulary, each word with a leading blank, and an end. The
attention model reads the ids before a place and predicts the id there: the class of the id, then the id in its class,
both from the state of the place. Every id has an input and an output vector of its own. Classes only order the
softmax: the most frequent ids are classes alone, the others are in groups, the smaller the more frequent their ids are.

The weights are fitted on the windows of all training texts, each once. The texts are dealt into ``rounds`` by a hash of
their key. In a round every task starts from the same weights and takes its windows in batches; Spark adds up the tasks'
changes, each weighted by the places that it comes from (for an id's vectors: the places of that id or its class), and
the driver takes the mean. The sums are whole numbers, so their order does not matter. At most ``trainers`` tasks take
part, which bounds the sums that are sent, not the texts.

Scoring lays overlapping windows over every whole text: a window's first ``context`` places only serve as context,
except in a text's first window, so each id is scored once. Windows of many texts are computed together under one
causal mask.

Word counts of any size stay distributed: only words with at least ``common_share`` of all tokens (at most its
reciprocal of them) are broadcast; the other words of each text are joined with the table of counts.

Defined cases: a NULL or empty text is the end alone; without training texts all counts are 0 and the weights stay as
they start; repeated rows get equal scores; other columns are not read.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinspark.llm.common import extended, stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SPLIT = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
WORD, SUBWORD, TEXTS = range(3)  # kinds of counts
FIXED = float(1 << 20)  # weighted changes are added up as whole numbers of this fraction
SLICE = 1 << 17  # numbers to a row of the sums
CELLS = 1 << 17  # numbers in a softmax of several places


@dataclass(frozen=True)
class ModelParameters:
    classes: int = 64
    width: int = 16
    window: int = 40
    context: int = 8
    rounds: int = 4
    trainers: int = 96  # tasks of a round
    steps: int = 500  # of a task, after which the rate has fallen by the root of two
    batch: int = 512  # windows
    rate: float = 0.05
    smoothing: float = 0.1
    common_share: float = 5e-7  # of all tokens; at most 2,000,000 words can have it
    cached_words: int = 400_000
    piece: int = 3_000_000  # characters scored at a time
    seed: int = 7


def encoder(vocabulary: bytes):
    """The byte-pair encoder of a vocabulary file."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
    return tiktoken.Encoding("words", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def subwords(encoding, words: list[bytes]) -> list[list[int]]:
    encode = encoding.encode_ordinary
    return [encode(" " + w.decode("utf-8", "replace")) for w in words]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def word_keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words)).view(np.int64)


def _counted(vocabulary, most: int):
    """Rows (kind, key, n) of texts: word hashes, subword ids, and the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(vocabulary.value)
        words: Counter = Counter()

        def rows() -> pa.RecordBatch:
            distinct, n = list(words), np.fromiter(words.values(), dtype=np.int64, count=len(words))
            ids = subwords(encoding, distinct)
            lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            flat = np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(lengths.sum()))
            sums = np.bincount(flat, weights=np.repeat(n, lengths)).astype(np.int64)
            found = np.flatnonzero(sums)
            kinds = np.repeat(np.array([WORD, SUBWORD], dtype=np.int8), [len(distinct), len(found)])
            columns = kinds, np.concatenate((word_keys(distinct), found)), np.concatenate((n, sums[found]))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)

        texts, names = 0, ["kind", "key", "n"]
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words.update(words_of(text))
                texts += 1
                if len(words) > most:
                    yield rows()
                    words.clear()
        yield rows()
        yield pa.RecordBatch.from_arrays([pa.array([TEXTS], pa.int8()), pa.array([0], pa.int64()), pa.array([texts], pa.int64())], names=names)

    return run


class Attention:
    """One layer of masked self-attention with a residual path over ids; an id is predicted by its class, then in its class.

    Without ``class_of`` each id is a class. The vectors ``r`` and ``c`` of ids in their classes are in the order of classes.
    """

    def __init__(self, ids: int, params: ModelParameters, class_of: np.ndarray | None = None):
        rng = np.random.default_rng(params.seed)
        d, w = params.width, params.window

        def start(*shape: int, scale: float = 0.3) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.window = w
        self.class_of = np.arange(ids) if class_of is None else class_of.astype(np.int64)
        self.order = np.argsort(self.class_of, kind="stable")
        self.rank = np.argsort(self.order)
        self.sizes = np.bincount(self.class_of)
        self.first = np.cumsum(self.sizes) - self.sizes
        classes = len(self.sizes)
        self.p = {"e": start(ids, d), "s": start(w, d, scale=0.1), "q": start(d, d), "k": start(d, d), "v": start(d, d), "o": start(d, d), "u": start(d, classes, scale=0.1), "b": np.zeros(classes, dtype=np.float32)}
        if class_of is not None:
            self.p |= {"r": np.zeros((ids, d), dtype=np.float32), "c": np.zeros(ids, dtype=np.float32)}
        self.mask = np.tril(np.ones((w, w), dtype=bool))

    def forward(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        x = p["e"][inputs] + p["s"]
        d = x.shape[-1]
        # One product over all places of the batch for queries, keys and values.
        joint = np.hstack((p["q"] * np.float32(d**-0.5), p["k"], p["v"]))
        qkv = (x.reshape(-1, d) @ joint).reshape(*x.shape[:-1], 3 * d)
        q, k, v = qkv[..., :d], qkv[..., d : 2 * d], qkv[..., 2 * d :]
        _, a, sums = exponentials(q @ k.transpose(0, 2, 1), self.mask)
        a *= 1 / sums[..., None]
        m = a @ v
        h = x + (m.reshape(-1, d) @ p["o"]).reshape(x.shape)
        return {"x": x, "q": q, "k": k, "v": v, "a": a, "m": m, "h": h}

    def grouped(self, goal: np.ndarray) -> tuple[np.ndarray, list[tuple[slice, slice]], np.ndarray]:
        """The places whose targets share a class, in the order of classes; the range of places and of ids of each such
        class; and the targets' numbers in their classes."""
        own = self.class_of[goal]
        at = np.flatnonzero(self.sizes[own] > 1)
        by_class, begins, classes = runs(own[at].astype(np.int16))
        at = at[by_class]
        ends = np.append(begins[1:], len(at))[: len(begins)]
        ranges = [(slice(b, e), slice(self.first[k], self.first[k] + self.sizes[k])) for k, b, e in zip(classes, begins, ends, strict=True)]
        return at, ranges, self.rank[goal[at]] - self.first[own[at]]

    def logs(self, inputs: np.ndarray, targets: np.ndarray, counted: np.ndarray | None = None) -> np.ndarray:
        """Natural log probability of each target; 0 at places that are not counted."""
        counted = np.ones(targets.shape, dtype=bool) if counted is None else counted
        p = self.p
        h, goal = self.forward(inputs)["h"][counted], targets[counted].astype(np.int64)
        found = np.zeros(len(goal), dtype=h.dtype)
        own = self.class_of[goal]
        for part in pieces(0, len(goal), len(p["b"])):
            found[part] = log_shares(h[part] @ p["u"] + p["b"], own[part])
        if "r" in p:
            at, ranges, number = self.grouped(goal)
            inner, added = h[at], np.zeros(len(at), dtype=h.dtype)
            for places, ids in ranges:
                for part in pieces(places.start, places.stop, ids.stop - ids.start):
                    added[part] = log_shares(inner[part] @ p["r"][ids].T + p["c"][ids], number[part])
            found[at] += added
        result = np.zeros(targets.shape, dtype=found.dtype)
        result[counted] = found
        return result

    def touched(self, inputs: np.ndarray, targets: np.ndarray, counted: np.ndarray) -> dict[str, tuple[np.ndarray | slice, np.ndarray]]:
        """Gradient of the mean log likelihood of the counted places: of each part the rows that it touches and their values."""
        p, f = self.p, self.forward(inputs)
        d = f["x"].shape[-1]
        every = slice(None)
        h, goal = f["h"][counted], targets[counted].astype(np.int64)
        n = max(1, len(goal))
        own, back = self.class_of[goal], np.empty_like(h)
        du, db = np.zeros_like(p["u"]), np.zeros_like(p["b"])
        for part in pieces(0, len(goal), len(p["b"])):
            z = left_over(h[part] @ p["u"] + p["b"], own[part], n)
            du += h[part].T @ z
            db += z.sum(axis=0)
            back[part] = z @ p["u"].T
        g = {"u": (every, du), "b": (every, db)}
        if "r" in p:
            at, ranges, number = self.grouped(goal)
            inner, added = h[at], np.empty((len(at), d), dtype=h.dtype)
            rows = np.concatenate([np.arange(ids.start, ids.stop) for _, ids in ranges]) if ranges else np.zeros(0, dtype=np.int64)
            dr, dc, k = np.zeros((len(rows), d), dtype=h.dtype), np.zeros(len(rows), dtype=h.dtype), 0
            for places, ids in ranges:
                size = ids.stop - ids.start
                for part in pieces(places.start, places.stop, ids.stop - ids.start):
                    z = left_over(inner[part] @ p["r"][ids].T + p["c"][ids], number[part], n)
                    dr[k : k + size] += z.T @ inner[part]
                    dc[k : k + size] += z.sum(axis=0)
                    added[part] = z @ p["r"][ids]
                k += size
            g |= {"r": (rows, dr), "c": (rows, dc)}
            back[at] += added
        flat = lambda x: x.reshape(-1, x.shape[-1])
        dh = np.zeros_like(f["h"])
        dh[counted] = back
        g["o"] = every, flat(f["m"]).T @ flat(dh)
        dm = (flat(dh) @ p["o"].T).reshape(dh.shape)
        da = dm @ f["v"].transpose(0, 2, 1)
        joint = np.empty((*dh.shape[:-1], 3 * d), dtype=dh.dtype)
        scale = np.float32(d**-0.5)
        joint[..., 2 * d :] = f["a"].transpose(0, 2, 1) @ dm
        da -= (dm * f["m"]).sum(axis=-1, keepdims=True)
        da *= f["a"]
        joint[..., :d] = da @ f["k"]
        joint[..., :d] *= scale
        joint[..., d : 2 * d] = da.transpose(0, 2, 1) @ f["q"]
        both = flat(f["x"]).T @ flat(joint)
        g |= {k: (every, both[:, i * d : (i + 1) * d]) for i, k in enumerate("qkv")}
        dx = dh + (flat(joint) @ np.hstack((p["q"], p["k"], p["v"])).T).reshape(dh.shape)
        g["s"] = every, dx.sum(axis=0)
        by_id, begins, ids = runs(inputs.ravel().astype(np.min_scalar_type(len(p["e"]))))
        g["e"] = ids, np.add.reduceat(flat(dx)[by_id], begins, axis=0)
        return g

    def gradient(self, inputs: np.ndarray, targets: np.ndarray, counted: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean log likelihood of the counted places."""
        whole = {}
        for k, (rows, g) in self.touched(inputs, targets, counted).items():
            whole[k] = np.zeros_like(self.p[k])
            whole[k][rows] = g
        return whole

    def step(self, inputs: np.ndarray, targets: np.ndarray, counted: np.ndarray, rate: float, squares: dict[str, np.ndarray]) -> None:
        """Steps of Adagrad, whose sums of squared gradients are in ``squares``; rows without a gradient stay as they are."""
        for k, (rows, g) in self.touched(inputs, targets, counted).items():
            sums = squares[k][rows] + g * g
            squares[k][rows] = sums
            self.p[k][rows] += np.float32(rate) * g / np.sqrt(sums)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the keys, where each distinct key begins in it, and the distinct keys."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
    return order, begins, keys[begins].astype(np.int64)


def pieces(begin: int, end: int, width: int) -> Iterator[slice]:
    """The range in slices, whose softmax over ``width`` numbers a row stays in the processor's cache."""
    size = max(1, CELLS // max(width, 1))
    return (slice(k, min(k + size, end)) for k in range(begin, end, size))


def exponentials(z: np.ndarray, mask: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits, their exponentials (0 outside the mask) and the sums of rows; all rows are shifted by their largest logit
    where a sum would leave the range of a float."""
    def powers() -> tuple[np.ndarray, np.ndarray]:
        e = np.exp(z)
        if mask is not None:
            e *= mask
        return e, (e.reshape(-1, e.shape[-1]) @ np.ones(e.shape[-1], dtype=e.dtype)).reshape(e.shape[:-1])

    with np.errstate(over="ignore", invalid="ignore"):
        e, sums = powers()
    if sums.size and not (sums.min() > 1e-20 and sums.max() < 1e20):
        if mask is not None:
            z = np.where(mask, z, z.dtype.type(-1e9))
        z = z - z.max(axis=-1, keepdims=True)
        e, sums = powers()
    return z, e, sums


def log_shares(z: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Natural log of each row's own share in the softmax."""
    z, _, sums = exponentials(z)
    return z[np.arange(len(z)), own] - np.log(sums)


def left_over(z: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
    """Gradient of the own shares' mean log over ``n`` rows."""
    _, z, sums = exponentials(z)
    z *= (-1 / (n * sums))[:, None]
    z[np.arange(len(z)), own] += z.dtype.type(1 / n)
    return z


def windows(lengths: np.ndarray, window: int, context: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first place and first scored place of the windows over texts of these lengths."""
    step = window - context
    numbers = 1 + np.maximum(0, -(-(lengths - window) // step))
    text = np.repeat(np.arange(len(lengths)), numbers)
    k = np.arange(len(text)) - np.repeat(np.cumsum(numbers) - numbers, numbers)
    return text, k * step, np.where(k > 0, k * step + context, 0)


def placed(classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, params: ModelParameters, end: int):
    """Inputs, targets, scored places and target indices of all windows of texts laid end to end."""
    text, first, scored = windows(lengths, params.window, params.context)
    place = first[:, None] + np.arange(params.window)
    inside = place < lengths[text][:, None]
    index = starts[text][:, None] + np.minimum(place, lengths[text][:, None] - 1)
    inputs = np.where(place > 0, classes[np.maximum(index - 1, 0)], end)
    return inputs, classes[index], inside & (place >= scored[:, None]), index


@dataclass
class Model:
    """Everything that tasks need to score texts; some MB plus the common words."""

    params: ModelParameters
    attention: Attention
    end: int  # the id after those of the vocabulary
    common: np.ndarray  # sorted hashes of the common words
    common_counts: np.ndarray


def group_classes(counts: np.ndarray, classes: int) -> np.ndarray:
    """A class of its own for the most frequent subwords, groups of about equal sums of the roots of counts for the others.

    With such groups the sum over places of the sizes of their classes is least. Subwords that were never counted have
    one class together, as no training place asks for them.
    """
    order = np.argsort(-counts, kind="stable")
    seen = order[: np.count_nonzero(counts)]
    single = min(classes // 2, len(seen))
    class_of = np.full(len(counts), classes - 1)
    class_of[seen[:single]] = np.arange(single)
    roots = np.cumsum(np.sqrt(counts[seen[single:]]))
    groups = classes - 1 - single
    if len(roots):
        class_of[seen[single:]] = single + np.minimum((roots / roots[-1] * groups).astype(int), groups - 1)
    return np.unique(class_of, return_inverse=True)[1].astype(np.int16)


class WordFacts:
    """Subword ids and base facts of distinct words, in a bounded cache."""

    def __init__(self, model: Model, encoding):
        self.model, self.encoding = model, encoding
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.ids = np.zeros(0, dtype=np.int32)
        self.begins, self.lengths = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.base, self.keys = np.zeros(0), np.zeros(0, dtype=np.int64)

    def of(self, words: list[bytes]) -> np.ndarray:
        """Row numbers of the words; ``base`` is NaN for words that are not common."""
        if len(self.numbers) > self.model.params.cached_words:
            self.forget()
        new = list(set(words) - self.numbers.keys())
        if new:
            m = self.model
            ids = subwords(self.encoding, new)
            lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            keys = word_keys(new)
            count = np.zeros(len(new))
            if len(m.common):
                at = np.minimum(np.searchsorted(m.common, keys), len(m.common) - 1)
                count = np.where(m.common[at] == keys, m.common_counts[at], 0.0)
            base = np.where(count > 0, np.log10(count + 0.1), np.nan)
            first = len(self.numbers)
            self.numbers.update(zip(new, range(first, first + len(new)), strict=True))
            self.begins = np.concatenate((self.begins, len(self.ids) + np.cumsum(lengths) - lengths))
            self.lengths = np.concatenate((self.lengths, lengths))
            self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(lengths.sum()))))
            self.base = np.concatenate((self.base, base))
            self.keys = np.concatenate((self.keys, keys))
        return np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int64, count=len(words))


def sequences(texts: list[list[bytes]], facts: WordFacts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word rows, and the subword ids of all texts with their ends laid end to end, with starts and lengths."""
    counts = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    rows = facts.of(list(chain.from_iterable(texts)))
    pieces = facts.lengths[rows]
    total = np.concatenate(([0], np.cumsum(pieces)))
    ends = np.cumsum(counts)
    lengths = total[ends] - total[ends - counts] + 1
    starts = np.cumsum(lengths) - lengths
    ids = np.full(int(lengths.sum()), facts.model.end, dtype=np.int32)
    inner = np.ones(len(ids), dtype=bool)
    inner[starts + lengths - 1] = False
    ids[inner] = facts.ids[np.repeat(facts.begins[rows] - total[:-1], pieces) + np.arange(total[-1])]
    return rows, ids, starts, lengths


def score_texts(texts: list[list[bytes]], facts: WordFacts) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Per tokenised text: model log10, sum of common base logs, number of common words, and its other words' keys."""
    m = facts.model
    rows, ids, starts, lengths = sequences(texts, facts)
    logs = np.zeros(len(ids))
    inputs, targets, scored, index = placed(ids, starts, lengths, m.params, m.end)
    for k in range(0, len(inputs), 512):
        part = slice(k, k + 512)
        logs[index[part][scored[part]]] = m.attention.logs(inputs[part], targets[part], scored[part])[scored[part]]
    logs /= np.log(10)
    base = facts.base[rows]
    common = ~np.isnan(base)
    counts = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(counts)
    sums = np.concatenate(([0.0], np.cumsum(np.where(common, base, 0))))
    number = np.concatenate(([0], np.cumsum(common)))
    other = facts.keys[rows]
    begins = ends - counts
    return np.add.reduceat(logs, starts), sums[ends] - sums[begins], number[ends] - number[begins], [other[b:e][~common[b:e]] for b, e in zip(begins, ends, strict=True)]


def _trained(model, vocabulary, rate: float):
    """Task function: train from the model's weights on every window of the texts; the changes and their places in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        net, params = m.attention, m.params
        start = net.p
        net.p = {k: v.copy() for k, v in start.items()}
        squares = {k: np.full_like(v, 1e-8) for k, v in start.items()}
        facts, rng = WordFacts(m, encoder(vocabulary.value)), np.random.default_rng(params.seed)
        read, asked, steps = np.zeros(m.end + 1), np.zeros(len(net.sizes)), 0

        def learn(texts: list[list[bytes]]) -> None:
            nonlocal steps
            _, ids, starts, lengths = sequences(texts, facts)
            inputs, targets, counted, _ = placed(ids, starts, lengths, params, m.end)
            mixed = rng.permutation(len(inputs))
            for k in range(0, len(mixed), params.batch):
                part = mixed[k : k + params.batch]
                net.step(inputs[part], targets[part], counted[part], rate / (1 + steps / params.steps) ** 0.5, squares)
                steps += 1
            read[:] += np.bincount(inputs.ravel(), minlength=len(read))
            asked[:] += np.bincount(net.class_of[targets[counted]], minlength=len(asked))

        pending: list[list[bytes]] = []
        size = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                pending.append(words_of(text))
                size += len(text or "")
                if size >= params.piece:
                    learn(pending)
                    pending, size = [], 0
        if pending:
            learn(pending)
        changes, net.p = {k: net.p[k] - start[k] for k in start}, start
        if steps:
            values = packed(net, changes, read, asked)
            for k in range(0, len(values), SLICE):
                yield pa.RecordBatch.from_arrays([pa.array([k // SLICE], pa.int32()), pa.array([values[k : k + SLICE].tobytes()], pa.binary())], names=["slice", "sums"])

    return run


def place_weights(net: Attention, read: np.ndarray, asked: np.ndarray) -> dict[str, np.ndarray]:
    """The places that the changes of each part come from, by row of an id's vectors and else one number."""
    in_class = asked[net.class_of[net.order]]
    return {k: read if k == "e" else in_class if k in "rc" else asked.sum(keepdims=True) for k in net.p}


def packed(net: Attention, changes: dict[str, np.ndarray], read: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Weighted changes and places as whole numbers, which tasks' sums add up."""
    weights = place_weights(net, read, asked)
    parts = [np.rint(v.astype(float) * weights[k].reshape(-1, *[1] * (v.ndim - 1)) * FIXED).astype(np.int64).ravel() for k, v in changes.items()]
    return np.concatenate([*parts, read.astype(np.int64), asked.astype(np.int64)])


def moved(net: Attention, sums: np.ndarray) -> None:
    """Add the mean changes of all tasks to the weights."""
    ids, classes = len(net.class_of), len(net.sizes)
    weights = place_weights(net, sums[-ids - classes : -classes].astype(float), sums[-classes:].astype(float))
    at = 0
    for k, v in net.p.items():
        n = np.maximum(weights[k], 1).reshape(-1, *[1] * (v.ndim - 1))
        net.p[k] = (v + sums[at : at + v.size].reshape(v.shape) / FIXED / n).astype(np.float32)
        at += v.size


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: sums of slices by number."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            values = np.frombuffer(raw.as_buffer(), dtype=np.int64)
            sums[number] = sums[number] + values if number in sums else values.copy()
    for number, values in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([values.tobytes()], pa.binary())], names=["slice", "sums"])


SCORED = "row long, n_tokens long, score double, common_logs double, common_words long, others array<long>"


def _scored(model, vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        facts = WordFacts(m, encoder(vocabulary.value))
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            pending: list[list[bytes]] = []
            parts, size = [], 0
            for text in batch.column(batch.num_columns - 1).to_pylist():
                pending.append(words_of(text))
                size += len(text or "")
                if size >= m.params.piece:
                    parts.append((pending, *score_texts(pending, facts)))
                    pending, size = [], 0
            if pending:
                parts.append((pending, *score_texts(pending, facts)))
            others = [x for part in parts for x in part[4]]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in others]))).astype(np.int32)
            keys = np.concatenate(others) if others else np.zeros(0, np.int64)
            join = lambda k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1], pa.array(np.arange(row, row + batch.num_rows)), pa.array([len(ws) + 1 for part in parts for ws in part[0]], pa.int64()),
                    pa.array(join(1).astype(float)), pa.array(join(2).astype(float)), pa.array(join(3).astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys, pa.int64())),
                ],
                names=[*batch.schema.names[:-1], "row", "n_tokens", "score", "common_logs", "common_words", "others"],
            )
            row += batch.num_rows

    return run


def fit(counts: DataFrame, train: DataFrame, vocabulary, params: ModelParameters, doc_id: str, text: str, total_tokens: int) -> Model:
    """Classes from the counts of ids, and weights from the windows of all training texts."""
    end = max(len(vocabulary.value.splitlines()), 1)
    numbers = np.zeros(end + 1)
    for key, n in counts.where(F.col("kind") == SUBWORD).select("key", "n").toPandas().itertuples(index=False):  # at most the vocabulary
        numbers[key] = n
    numbers[end] = counts.where(F.col("kind") == TEXTS).agg(F.sum("n")).collect()[0][0] or 0
    often = counts.where((F.col("kind") == WORD) & (F.col("n") >= max(1.0, params.common_share * total_tokens))).select("key", "n").toPandas()
    order = np.argsort(often["key"].to_numpy(dtype=np.int64))
    net = Attention(end + 1, params, group_classes(numbers, params.classes))
    net.p["b"] = np.log(np.bincount(net.class_of, weights=numbers + params.smoothing)).astype(np.float32)
    net.p["c"] = np.log(numbers[net.order] + params.smoothing).astype(np.float32)
    model = Model(params, net, end, often["key"].to_numpy(dtype=np.int64)[order], often["n"].to_numpy(dtype=float)[order])
    dealt = F.pmod(F.xxhash64(F.lit("round"), F.col(doc_id)), F.lit(params.rounds))
    for k in range(params.rounds):
        start = train.sparkSession.sparkContext.broadcast(model)
        texts = train.where(dealt == k).select(F.col(text)).coalesce(params.trainers)
        changes = texts.mapInArrow(_trained(start, vocabulary, params.rate / (1 + k) ** 0.5), "slice int, sums binary")
        sums = changes.repartition(8, "slice").mapInArrow(_added, "slice int, sums binary").collect()
        if sums:
            moved(net, np.concatenate([np.frombuffer(r["sums"], dtype=np.int64) for r in sorted(sums, key=lambda r: r["slice"])]))
        start.unpersist()
    return model


def scored(docs: DataFrame, held_out: Column, keep: list[Column], doc_id: str = "doc_id", text: str = "text", params: ModelParameters = ModelParameters(), vocabulary_path: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` with n_tokens, n_known, train_tokens, base_score and score of every row.

    Counting and fitting run when this is called; the scores of the texts are written to the shared folder, so that the
    row numbers that join them with the word counts are fixed.
    """
    spark = docs.sparkSession
    with open(vocabulary_path, "rb") as file:
        raw = file.read()
    vocabulary = spark.sparkContext.broadcast(raw)
    train = docs.where(~held_out)
    rows = train.select(F.col(text)).mapInArrow(_counted(vocabulary, params.cached_words), "kind byte, key long, n long")
    counts, _ = stored(rows.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    facts = counts.where(F.col("kind").isin(WORD, TEXTS)).groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()
    of = {r["kind"]: r for r in facts}
    texts = of[TEXTS]["n"] if TEXTS in of else 0
    tokens = texts + (of[WORD]["n"] if WORD in of else 0)
    distinct = (of[WORD]["kinds"] if WORD in of else 0) + (texts > 0)
    model = spark.sparkContext.broadcast(fit(counts, train, vocabulary, params, doc_id, text, tokens))

    kept = docs.select(*keep, F.col(text).alias("_text"))
    names = [f.name for f in kept.schema.fields[:-1]]
    found, _ = stored(kept.mapInArrow(_scored(model, vocabulary), extended(kept, SCORED)), "scores")
    words = counts.where(F.col("kind") == WORD).select("key", "n")
    others = found.select("row", F.explode("others").alias("key")).join(words, "key", "left")
    sums = others.groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("other_logs"), F.count("n").alias("other_known"))
    total = F.lit(float(np.log10(tokens + 0.1 * (distinct + 1))))
    base = F.col("common_logs") + F.coalesce("other_logs", F.lit(0.0)) + float(np.log10(texts + 0.1)) - F.col("n_tokens") * total
    known = F.col("common_words") + F.coalesce("other_known", F.lit(0)) + int(texts > 0)
    return found.join(sums, "row", "left").select(
        *names, "n_tokens", known.cast("long").alias("n_known"), F.lit(int(tokens)).cast("long").alias("train_tokens"), base.alias("base_score"), "score"
    )
