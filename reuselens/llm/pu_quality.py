"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are enough: the weights minimise the
non-negative unbiased risk ``pi E_P[l(g)] + max(0, E_U[l(-g)] - pi E_P[l(-g)])``
with logistic loss ``l`` and class prior ``pi``.  When the second part gets
negative, the step goes up on it instead, which keeps the model from fitting
the unlabelled texts as negatives.  The prior is estimated first: a plain
positive-against-unlabelled model is fitted on half of the sample, and on the
other half the smallest ratio of the unlabelled to the positive share above a
score (with a confidence margin) is the part of the unlabelled texts that can
be positive.  The margins of that half also turn the model's margin into a
probability, by the monotone ratio of the two densities.

A text is described by shares of byte classes, word shapes and repetitions,
each cut into bins at the sample's quantiles, and by hashed byte pairs.  The
fit is one task over a bounded sample: at most ``PER_SIDE`` positives and
``PER_SIDE`` unlabelled texts, those with the smallest hash of their id.

Defined results: null and empty texts get the score of a text without bytes;
labels other than 1, null labels and labels of unknown ids are not positives;
without positives or unlabelled texts every score is the prior 0.5; repeated
rows give repeated rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reuselens.llm import kernels as K

PER_SIDE = 12000
BINS = 16
PAIRS = 512
KNOTS = 60
ROUNDS = 400
RATE = 0.03
PENALTY = 1e-4
ROWS = 512

CLASSES = 12
BYTE_CLASS = np.full(256, 9, np.int64)
for _i, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c",
                             b"\n\r", b".,;:", b"!?", b"*#%&$@^~=+<>_\\/", b"|")):
    BYTE_CLASS[list(_chars)] = _i
BYTE_CLASS[128:192] = 10
BYTE_CLASS[192:] = 11
STATS = CLASSES + 11
DIMENSIONS = STATS * BINS + PAIRS + 1


def describe(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares (``STATS`` a text) and square roots of the shares of hashed byte
    pairs (``PAIRS`` a text)."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    kind = BYTE_CLASS[data]
    counts = np.bincount(row * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES)
    stats = np.zeros((n, STATS), np.float32)
    stats[:, :CLASSES] = counts / np.maximum(size, 1)[:, None]
    starts, ends, text = K.word_bounds(data, offsets)
    words, bounds = K.word_hashes(data, offsets)
    per = np.maximum(np.diff(bounds), 1)

    def share(flag, of=text, by=per):
        return np.bincount(of, weights=flag, minlength=n) / by

    at = CLASSES
    stats[:, at] = np.log1p(np.diff(bounds))
    stats[:, at + 1] = share(ends - starts)
    if len(words):
        first, last = kind[starts], kind[ends - 1]
        second = kind[np.minimum(starts + 1, len(data) - 1)]
        long = ends - starts > 1
        stats[:, at + 2] = share((first == 1) & (second == 1) & long)          # capitals
        stats[:, at + 3] = share((last >= 6) & (last <= 9))                    # ends in a sign
        stats[:, at + 4] = share(~np.isin(first, (0, 1, 2, 10, 11)))           # begins with a sign
        stats[:, at + 5] = share(~long)
        inside = text[1:] == text[:-1]
        stats[:, at + 6] = share((words[1:] == words[:-1]) & inside, text[1:])  # said twice in a row
        for j, pairs in ((7, words), (8, K.chain(words[:-1], words[1:]))):      # distinct words and pairs
            of = text[:len(pairs)]
            order = np.lexsort((pairs, of))
            new = np.ones(len(pairs), bool)
            new[1:] = (pairs[order][1:] != pairs[order][:-1]) | (of[order][1:] != of[order][:-1])
            stats[:, at + j] = share(new, of[order]) * np.sqrt(per) / 16       # in proportion to long texts too
        stats[:, at + 9] = share((first == 1) & ~((second == 1) & long))       # capitalised
    stats[:, at + 10] = counts[:, 4] / per                                     # lines a word
    pair = np.zeros((n, PAIRS), np.float32)
    if len(data) > 1:
        code = (K.LOWER[data[:-1]].astype(np.uint32) * np.uint32(0x9E3779B1)
                ^ K.LOWER[data[1:]].astype(np.uint32) * np.uint32(0x85EBCA6B))
        code = (code >> np.uint32(13)) % np.uint32(PAIRS)
        both = row[1:] == row[:-1]
        pair = np.bincount(row[1:][both] * PAIRS + code[both], minlength=n * PAIRS).reshape(n, PAIRS)
        pair = np.sqrt(pair / np.maximum(size - 1, 1)[:, None]).astype(np.float32)
    return stats, pair


class Design:
    """Rows of a linear model: the bin of each share (``edges``: STATS x
    (BINS - 1)), the byte pairs and a constant. Bins are kept as numbers."""

    def __init__(self, bins: np.ndarray, pair: np.ndarray):
        self.bins, self.pair = bins, pair

    @classmethod
    def of(cls, stats: np.ndarray, pair: np.ndarray, edges: np.ndarray) -> Design:
        bins = np.empty(stats.shape, np.int16)
        for j in range(STATS):
            bins[:, j] = j * BINS + np.searchsorted(edges[j], stats[:, j], "right")
        return cls(bins, pair)

    def __len__(self):
        return len(self.bins)

    def __getitem__(self, rows) -> Design:
        return Design(self.bins[rows], self.pair[rows])

    def margins(self, w: np.ndarray) -> np.ndarray:
        out = self.pair @ w[STATS * BINS:-1].astype(np.float32) + np.float32(w[-1])
        for j in range(STATS):
            out += w[self.bins[:, j]].astype(np.float32)
        return out.astype(np.float64)

    def back(self, v: np.ndarray) -> np.ndarray:
        """The transposed design times a vector."""
        out = np.empty(DIMENSIONS)
        out[:STATS * BINS] = np.bincount(self.bins.reshape(-1), np.repeat(v, STATS), STATS * BINS)
        out[STATS * BINS:-1] = self.pair.T @ v.astype(np.float32)
        out[-1] = v.sum()
        return out


def sigmoid(g):
    return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def _descend(gradient, rounds: int = ROUNDS, rate: float = RATE) -> np.ndarray:
    """Adam steps along ``gradient(w)``."""
    w, m, v = (np.zeros(DIMENSIONS) for _ in range(3))
    for i in range(1, rounds + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.999 ** i)) + 1e-8)
    return w


def fit_non_negative(pos: Design, unl: Design, prior: float) -> np.ndarray:
    """Weights of least non-negative risk."""
    def gradient(w):
        gp, gu = pos.margins(w), unl.margins(w)
        p, u = sigmoid(gp), sigmoid(gu)
        gain = pos.back(p - 1) / len(pos) * prior                    # of pi E_P[l(g)]
        rest = unl.back(u) / len(unl) - prior * pos.back(p) / len(pos)
        risk = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        return (gain + rest if risk >= 0 else -rest) + PENALTY * w

    return _descend(gradient)


def estimate_prior(pos: Design, unl: Design, held_pos: Design, held_unl: Design) -> float:
    """Share of positives among the unlabelled rows."""
    def gradient(w):
        p, u = sigmoid(pos.margins(w)), sigmoid(unl.margins(w))
        return (pos.back(p - 1) / len(pos) + unl.back(u) / len(unl)) / 2 + 10 * PENALTY * w

    w = _descend(gradient, ROUNDS // 2)
    return tail_ratio(held_pos.margins(w), held_unl.margins(w))


def tail_ratio(pos: np.ndarray, unl: np.ndarray) -> float:
    """The least ratio of the unlabelled to the positive share above a margin,
    with a confidence margin."""
    p, u = np.sort(pos), np.sort(unl)
    at = np.quantile(p, np.linspace(0, 0.95, 200))
    above_p = 1 - np.searchsorted(p, at) / len(p)
    above_u = 1 - np.searchsorted(u, at) / len(u)
    margin = np.sqrt(np.log(20) / 2) * (len(p) ** -0.5 + len(u) ** -0.5) / 2
    best = np.argmin((above_u + margin) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def calibrate(pos: np.ndarray, unl: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the probability of a positive by margin: the density ratio
    ``pi f_P / f_U`` of held-back margins in ``KNOTS`` bins, made monotone by
    pooling adjacent violators."""
    edges = np.unique(np.quantile(np.concatenate([pos, unl]), np.linspace(0, 1, KNOTS + 1)))
    if len(edges) < 3:
        return np.array([0.0, 1.0]), np.array([prior, prior])
    p = prior * np.histogram(pos, edges)[0] / len(pos)
    u = np.histogram(unl, edges)[0] / len(unl)
    pools: list[list[float]] = []              # positives, all, middle margins
    for i in range(len(p)):
        pools.append([p[i], u[i] + 1e-9, [(edges[i] + edges[i + 1]) / 2]])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            x = pools.pop()
            pools[-1] = [pools[-1][0] + x[0], pools[-1][1] + x[1], pools[-1][2] + x[2]]
    x = np.array([m for pool in pools for m in pool[2]])
    y = np.array([min(1.0, pool[0] / pool[1]) for pool in pools for _ in pool[2]])
    return x, y


def fit_model(stats: np.ndarray, pair: np.ndarray, positive: np.ndarray) -> dict:
    """Weights from the even rows of either side; prior and calibration from
    the odd ones."""
    edges = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.astype(np.float64).copy()
    rows = Design.of(stats, pair, edges)
    p, u = np.flatnonzero(positive), np.flatnonzero(~positive)
    pos, held_pos, unl, held_unl = (rows[x] for x in (p[::2], p[1::2], u[::2], u[1::2]))
    if not (len(held_pos) and len(held_unl)):
        held_pos, held_unl = pos, unl
    prior = estimate_prior(pos, unl, held_pos, held_unl)
    w = fit_non_negative(pos, unl, prior)
    x, y = calibrate(held_pos.margins(w), held_unl.margins(w), prior)
    return {"edges": edges, "prior": prior, "weights": w, "x": x, "y": y}


def probability(stats: np.ndarray, pair: np.ndarray, model: dict) -> np.ndarray:
    """Score of each text; a hundredth of it keeps margins apart that the
    calibration has pooled."""
    g = Design.of(stats, pair, model["edges"]).margins(model["weights"])
    return 0.99 * np.interp(g, model["x"], model["y"]) + 0.01 * sigmoid(g)


def _smallest(ids: DataFrame, n: int) -> DataFrame:
    """The ``n`` ids with the smallest hash."""
    total = ids.count()
    part = min(1.0, 2.0 * n / max(total, 1) + 1e-6)
    h = F.xxhash64("doc_id")
    return ids.where(h.cast("double") < part * 2.0 ** 64 - 2.0 ** 63).orderBy(h, "doc_id").limit(n)


def fit(docs: DataFrame, positives: DataFrame, labelled: DataFrame, allowed: Column | None = None,
        per_side: int = PER_SIDE) -> dict:
    """Learn from ``docs`` (``doc_id, text``): ``positives`` has the trusted ids,
    ``labelled`` the ids that are not unlabelled; only rows with ``allowed``."""
    rows = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    rows = rows if allowed is None else rows.where(allowed)
    ids = rows.select("doc_id").distinct()
    pos = _smallest(ids.join(positives.select("doc_id").distinct(), "doc_id", "left_semi"), per_side)
    unl = _smallest(ids.join(labelled.select("doc_id").distinct(), "doc_id", "left_anti"), per_side)
    picked = pos.withColumn("positive", F.lit(True)).unionByName(unl.withColumn("positive", F.lit(False)))
    sample = rows.join(F.broadcast(picked), "doc_id")             # 2 * per_side ids at most
    one = sample.groupBy("doc_id", "positive").agg(F.min("text").alias("text"))

    def learned(batches):
        ids, flags, stats, pairs = [], [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            flags += batch.column(1).to_pylist()
            for _, data, off in K.utf8_pieces(batch.column(2), rows=ROWS):
                s, p = describe(data, off)
                stats.append(s)
                pairs.append(p)
        flags = np.array(flags, bool)
        if not flags.any() or flags.all():
            return None
        order = np.argsort(np.array(ids))
        return fit_model(np.concatenate(stats)[order], np.concatenate(pairs)[order], flags[order])

    def train(batches):
        m = learned(batches)
        if m is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([m["prior"]]), pa.array([m["edges"].astype(np.float64).tobytes()], pa.binary()),
                 pa.array([m["weights"].astype(np.float64).tobytes()], pa.binary()),
                 pa.array([m["x"].tobytes()], pa.binary()), pa.array([m["y"].tobytes()], pa.binary())],
                names=["prior", "edges", "weights", "x", "y"])
        K.release_memory()

    got = one.repartition(1).mapInArrow(train, "prior double, edges binary, weights binary, x binary, y binary").collect()
    if not got:
        return {"edges": np.zeros((STATS, BINS - 1)), "prior": 0.5, "weights": np.zeros(DIMENSIONS),
                "x": np.array([0.0, 1.0]), "y": np.array([0.5, 0.5])}
    model = {n: np.frombuffer(got[0][n]) for n in ("edges", "weights", "x", "y")}
    return model | {"prior": got[0]["prior"], "edges": model["edges"].reshape(STATS, BINS - 1)}


def score(docs: DataFrame, model: dict, keep: dict[str, Column] | None = None) -> DataFrame:
    """The columns of ``keep`` (else ``doc_id``) and ``score`` of each row."""
    keep = keep or {"doc_id": F.col("doc_id")}
    body = "text" + "_" * (1 + max((len(n) for n in keep), default=0))
    given = docs.select(*[c.alias(n) for n, c in keep.items()], F.col("text").cast("string").alias(body))
    kinds = ", ".join(f"`{n}` {t}" for n, t in given.dtypes[:-1])
    def run(batches):
        for batch in batches:
            scores = []
            for _, data, off in K.utf8_pieces(batch.column(batch.num_columns - 1), rows=ROWS):
                scores.append(probability(*describe(data, off), model))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.concatenate(scores) if scores else np.zeros(0))],
                names=[*batch.schema.names[:-1], "score"])

    return given.mapInArrow(run, f"{kinds}, score double")


def accepted(docs: DataFrame, model: dict, at: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``at``. Only
    texts go to Python, only scores come back."""
    def run(texts: pa.Array) -> pa.Array:
        scores = [probability(*describe(data, off), model) for _, data, off in K.utf8_pieces(texts, rows=ROWS)]
        K.release_memory()
        return pa.array(np.concatenate(scores) if scores else np.zeros(0))

    return docs.where(F.arrow_udf(run, "double")(F.col("text").cast("string")) >= at)
