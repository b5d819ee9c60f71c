"""Language identification in two steps: family, then language.

A text is the square roots of its counts of hashed byte trigrams (lower-cased
letters; every run of other bytes is one border), scaled to length 1.  Linear
support vector machines (squared hinge loss) choose first among the families,
one against the rest; then, within the chosen family, one for each pair of
languages, whose votes decide, and the sum of margins between equal votes.

Each machine is one group of a Spark job over a bounded sample: at most
``PER_LANGUAGE`` training texts of each language, those with the smallest hash
of their id.  The machines (``DIMENSIONS`` numbers each, one for each family
and each pair of related languages) go to the tasks that predict; their number
depends on the languages alone.

Defined results: ``und`` with score 0 for null, empty and letterless texts and
when nothing was learned; a language alone in its family needs no second step;
equal scores go to the smaller name; repeated rows give repeated rows.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reuselens.llm import kernels as K

DIMENSIONS = 4096
PER_LANGUAGE = 1000
ROUNDS = 150
PENALTY = 1e-4
ROWS = 128

# Families of common languages; any other language is a family
# of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "uralic": ["et", "fi", "hu"],
    "celtic": ["br", "cy", "ga", "gd"],
    "turkic": ["az", "kk", "ky", "tr", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"],
    "iranian": ["fa", "ku", "ps", "tg"],
    "semitic": ["ar", "he", "mt"],
    "dravidian": ["kn", "ml", "ta", "te"],
    "malayic": ["id", "jv", "ms", "su"],
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}

LETTER = np.zeros(256, np.uint8)
LETTER[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
LETTER[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
LETTER[128:] = np.arange(128, 256)


def vectors(data: np.ndarray, offsets: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """One row of length 1 (or 0, without letters) per text, and a constant."""
    n = len(offsets) - 1
    # a border before, between and after the texts
    at = np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))
    code = np.zeros(len(data) + n + 1, np.uint32)
    code[at] = LETTER[data]
    text = np.repeat(np.arange(n), np.diff(offsets) + 1)
    keep = np.append((code[:-1] != 0) | (code[1:] != 0), True)
    keep = np.flatnonzero(keep)                # runs of borders are one border
    text, code = text[np.minimum(keep, len(text) - 1)] if n else keep, code[keep]
    if len(code) < 3:
        return np.concatenate([np.zeros((n, dimensions), np.float32), np.ones((n, 1), np.float32)], axis=1)
    h = (code[:-2] * np.uint32(0x9E3779B1) ^ code[1:-1] * np.uint32(0x85EBCA6B) ^ code[2:] * np.uint32(0xC2B2AE35))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    h = (h >> np.uint32(12)) % np.uint32(dimensions)
    whole = code[1:-1] != 0                    # centred on a letter: never two texts' letters
    counts = np.bincount(text[1:-1][whole] * dimensions + h[whole], minlength=n * dimensions)
    x = np.sqrt(counts.reshape(n, dimensions).astype(np.float32))
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.concatenate([x / np.maximum(norm, 1), np.ones((n, 1), np.float32)], axis=1)


def fit_svm(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, penalty: float = PENALTY) -> np.ndarray:
    """Weights that minimise ``penalty * |w|^2 / 2 + mean(c * max(0, 1 - y x.w)^2)``
    by accelerated gradient steps; ``c`` gives both sides the same weight."""
    c = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    ahead = w
    step = 1 / (2 * 2.0 + penalty)             # rows have length at most sqrt(2)
    t = 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - step * (penalty * ahead - 2 * (x.T @ (c * y * slack)))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + np.float32((t - 1) / t_new) * (new - w)
        w, t = new, t_new
    return w


def training_sample(rows: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """At most ``per_language`` rows (``doc_id, lang, text``) of each language,
    those with the smallest hash of the id. The order is over ids alone."""
    ids = rows.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
    counts = ids.groupBy("lang").agg(F.count("*").alias("n")).collect()  # one row a language
    part = F.lit(1.0)
    for r in counts:
        part = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, 2.0 * per_language / r["n"] + 1e-6))).otherwise(part)
    near = ids.where(F.col("h").cast("double") < part * 2.0 ** 64 - 2.0 ** 63)
    nth = F.row_number().over(W.partitionBy("lang").orderBy("h", "doc_id"))
    picked = near.withColumn("nth", nth).where(F.col("nth") <= per_language).select("doc_id").distinct()
    # per_language ids a language at most
    return rows.join(F.broadcast(picked), "doc_id", "left_semi")


def fit(rows: DataFrame, per_language: int = PER_LANGUAGE) -> dict:
    """The machines learned from ``doc_id, lang, text``."""
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sample = training_sample(rows, per_language)
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("x", pa.binary())])

    def encode(batches):
        for batch in batches:
            made = []
            for _, data, off in K.utf8_pieces(batch.column(2), rows=ROWS):
                made += [v[:-1].astype(np.float16).tobytes() for v in vectors(data, off)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary())],
                                             schema=schema)

    langs = sorted(r[0] for r in sample.select("lang").distinct().collect())
    family = {x: FAMILY_OF.get(x, x) for x in langs}
    families = sorted(set(family.values()))
    machines = [(f, None) for f in families] if len(families) > 1 else []
    machines += [(a, b) for a, b in itertools.combinations(langs, 2) if family[a] == family[b]]
    if not machines:
        return {"langs": langs, "families": families, "family": family, "machines": [], "weights": None}
    sides = []                                 # (machine, language, side)
    for i, (a, b) in enumerate(machines):
        sides += [(i, x, 1 if (family[x] == a if b is None else x == a) else -1)
                  for x in langs if b is None or x in (a, b)]
    sides = sample.sparkSession.createDataFrame(sides, "machine int, lang string, side int")

    def train(pdf):
        import pandas as pd
        pdf = pdf.sort_values("doc_id")
        x = np.frombuffer(b"".join(pdf["x"]), np.float16).reshape(len(pdf), -1).astype(np.float32)
        x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
        w = fit_svm(x, pdf["side"].to_numpy(np.float32))
        return pd.DataFrame({"machine": pdf["machine"].iloc[:1], "w": [w.tobytes()]})

    encoded = sample.select(F.col("doc_id").cast("long"), "lang", "text") \
        .mapInArrow(encode, "doc_id long, lang string, x binary")
    done = encoded.join(F.broadcast(sides), "lang").groupBy("machine") \
        .applyInPandas(train, "machine int, w binary").collect()   # DIMENSIONS numbers a machine
    w = np.zeros((len(machines), DIMENSIONS + 1), np.float32)
    for r in done:
        w[r["machine"]] = np.frombuffer(r["w"], np.float32)
    return {"langs": langs, "families": families, "family": family, "machines": machines, "weights": w}


def decide(x: np.ndarray, model: dict) -> tuple[list[str], np.ndarray]:
    """Language and score of each row of vectors."""
    langs, families, family = model["langs"], model["families"], model["family"]
    n = len(x)
    out, score = np.full(n, langs[0], object), np.ones(n)
    margins = x @ model["weights"].T if model["machines"] else np.zeros((n, 0))
    sure = 1 / (1 + np.exp(-4 * margins))
    chosen = np.zeros(n, int)
    if len(families) > 1:
        chosen = margins[:, :len(families)].argmax(axis=1)
        score = sure[np.arange(n), chosen]
    for f, name in enumerate(families):
        own = [x for x in langs if family[x] == name]
        rows = np.flatnonzero(chosen == f)
        if len(own) == 1:
            out[rows] = own[0]
            continue
        votes = np.zeros((len(rows), len(own)))
        for m, (a, b) in enumerate(model["machines"]):
            if b is not None and family[a] == name:
                i, j = own.index(a), own.index(b)
                votes[:, i] += (margins[rows, m] > 0) + sure[rows, m] / (4 * len(own))
                votes[:, j] += (margins[rows, m] <= 0) + (1 - sure[rows, m]) / (4 * len(own))
        best = votes.argmax(axis=1)
        out[rows] = np.array(own, object)[best]
        within = np.ones(len(rows))
        for m, (a, b) in enumerate(model["machines"]):
            if b is not None and family[a] == name:
                i, j = own.index(a), own.index(b)
                within = np.where(best == i, np.minimum(within, sure[rows, m]), within)
                within = np.where(best == j, np.minimum(within, 1 - sure[rows, m]), within)
        score[rows] *= within
    return list(out), np.asarray(score, np.float64)


def predict(docs: DataFrame, model: dict, keep: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id``, the columns of ``keep``, ``lang_pred`` and ``score`` of each
    row (``doc_id, text``). Only the text is an input of the prediction."""
    keep = keep or {}
    given = docs.select(F.col("doc_id"), *[c.alias(n) for n, c in keep.items()], F.col("text").cast("string"))
    kinds = ", ".join(f"{n} {t}" for n, t in given.dtypes[:-1])

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            lettered = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
            langs, scores = [], []
            if model["langs"]:
                for _, data, off in K.utf8_pieces(texts, rows=ROWS):
                    a, b = decide(vectors(data, off), model)
                    langs += a
                    scores.append(b)
            scores = np.concatenate(scores) if scores else np.zeros(len(texts))
            langs = [x if ok else "und" for x, ok in zip(langs or ["und"] * len(texts), lettered, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(np.where(lettered, scores, 0.0))],
                names=[*batch.schema.names[:-1], "lang_pred", "score"])

    return given.mapInArrow(run, f"{kinds}, lang_pred string, score double")
