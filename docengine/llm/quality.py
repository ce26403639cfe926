"""Quality classifier by co-training a text view and a metadata view.

Each view has a logistic regression of its own: one on the text, as shares and counts and as
hashed words, one on language, source and length. In each round both score all documents
without a label, and the rows one of them is most sure about become labelled rows of the
other. Each view is then calibrated on labelled rows that none was trained on, a last
regression on the calibrated views combines them, and all documents are scored.

Features of all documents are taken once and written, a row of fixed size each; rounds and
scores read that table. A round hands on the `ADDED` surest rows per view and class of the
whole table. Only the labelled rows are a bounded sample, `LABELLED` drawn by a seeded hash
of doc_id; a quarter of each class is held out for calibration (of fewer than four rows of a
class none is, and all rows calibrate).

Defined cases: null text counts as empty, a null metadata value as a value of its own; with
labels of one class only, or none, every document is kept with score 0.5. Rows without doc_id
have no label. Only doc_id, text, lang, source and n_chars are read, and doc_id and quality of
the labels; a document with several labels takes the lowest, one with several rows counts
once as a labelled one, by its least features.
"""

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from docengine.llm.batches import pieces
from docengine.sources.workspace import RunFolder

CHARACTERS = 1_000_000
LABELLED = 8000
ROUNDS = 4
SURE = 0.95
ADDED = 200
META = 64
HASHED = 64


def text_features(text: str | None) -> list[float]:
    text = text or ""
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n, chars = max(1, len(words)), max(1, len(text))
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    same = sum(a == b for a, b in zip(words, words[1:]))
    ends = Counter(w[-1] for w in words)
    odd = sum(c for e, c in ends.items() if not e.isalnum() and e not in ".,;:?")
    letters = Counter(text)
    upper = sum(c for x, c in letters.items() if x.isupper())
    alpha = sum(c for x, c in letters.items() if x.isalpha())
    digit = sum(c for x, c in letters.items() if x.isdigit())
    sign = sum(c for x, c in letters.items() if not x.isalnum() and not x.isspace())
    bare = sum(c for w, c in counts.items() if not any(map(str.isalpha, w)))
    return [
        np.log1p(len(words)),
        alpha / n,
        upper / max(1, alpha),
        digit / chars,
        sign / chars,
        same / n,
        odd / n,
        bare / n,
        len(counts) / n,
        pairs / n,
        max(counts.values(), default=0) / n,
        sum(c for w, c in counts.items() if w.isupper() and len(w) > 1) / n,
        len(set(lines)) / max(1, len(lines)),
        np.log1p(len(text) / max(1, len(lines))),
        sum(c * c for c in counts.values()) / n / n,
        *hashed_words(counts, n),
    ]


def hashed_words(counts: Counter, n: int) -> list[float]:
    """Shares of the words, in any case, that fall into each of `HASHED` places, signed."""
    out = [0.0] * HASHED
    for word, count in counts.items():
        code = zlib.crc32(word.lower().encode("utf-8", "surrogatepass"))
        out[code % HASHED] += count / n if code & 0x80000000 else -count / n
    return out


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    out = [0.0] * META
    size = -1 if n_chars is None else int(np.log2(max(1, n_chars)) * 2)
    for field in (f"l{lang}", f"s{source}", f"n{size}", f"{lang}/{size}"):
        out[zlib.crc32(field.encode("utf-8", "surrogatepass")) % META] += 1.0
    return out


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


def chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


def scaled(x: np.ndarray, view: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return np.clip((x - view[0]) / view[1], -8, 8)


def co_train(rows: list[np.ndarray], y: np.ndarray, train: np.ndarray, surest) -> dict:
    """Weights of both views, their calibration and the combination.

    `rows` are the labelled rows of both views. `surest(weights, given)` finds, for each view
    and class, the unlabelled rows that it is surest about and the other view was not
    given: (view, class, id, features of both views).
    """
    given: list[dict[int, tuple]] = [{}, {}]  # pseudo-labels that a view was handed
    for round in range(ROUNDS + 1):
        weights = []
        for at, extra in enumerate(given):
            more = [extra[k] for k in sorted(extra)]
            x = np.concatenate([rows[at][train], *(f[None] for _, f in more)])
            weights.append(fit(x, np.concatenate([y[train], [v for v, _ in more]])))
        if round == ROUNDS:
            break
        for own, value, id, features in surest(weights, [set(g) for g in given]):
            given[1 - own].setdefault(id, (float(value), features[1 - own]))
    held = ~train if len(set(y[~train])) == 2 else np.ones(len(y), bool)
    marks = [logit(x[held], w)[:, None] for x, w in zip(rows, weights)]
    scales = [fit(m, y[held]) for m in marks]
    calibrated = np.column_stack([logit(m, s) for m, s in zip(marks, scales)])
    return {"weights": weights, "scales": scales, "both": fit(calibrated, y[held])}


def scores(model: dict, text: np.ndarray, meta: np.ndarray) -> list[np.ndarray]:
    """Calibrated chance of good quality by text, by metadata, and by both."""
    out = []
    for view, w, s, x in zip(model["views"], model["weights"], model["scales"], (text, meta)):
        out.append(logit(logit(scaled(x, view), w)[:, None], s))
    return [*map(chance, out), chance(logit(np.column_stack(out), model["both"]))]


FEATURES = "doc_id long, text array<float>, meta array<float>"


def _features(batches: Iterator[pa.RecordBatch]):
    for ids, lang, source, chars, texts in pieces(batches, CHARACTERS):
        text = [text_features(t) for t in texts]
        meta = [meta_features(*m) for m in zip(lang, source, chars)]
        floats = pa.list_(pa.float32())
        yield pa.record_batch(
            [pa.array(ids, pa.int64()), pa.array(text, floats), pa.array(meta, floats)],
            ["doc_id", "text", "meta"],
        )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten()).reshape(len(column), -1).astype(float)


def _moments(batches: Iterator[pa.RecordBatch]):
    count, first, second = 0, 0.0, 0.0
    for batch in batches:
        if batch.num_rows:
            x = np.column_stack([_matrix(batch.column("text")), _matrix(batch.column("meta"))])
            count, first, second = count + len(x), first + x.sum(axis=0), second + (x * x).sum(axis=0)
    if count:
        yield pa.record_batch([pa.array([[float(count), *first, *second]])], ["sums"])


def _views(features: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Mean and scale of each view's columns over all documents."""
    sums = features.select("text", "meta").mapInArrow(_moments, "sums array<double>")
    at = sums.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).collect()
    total = np.array([r["s"] for r in sorted(at)])
    mean, square = np.split(total[1:] / total[0], 2)
    scale = np.sqrt(np.maximum(square - mean * mean, 0)) + 1e-6
    return [(mean[:-META], scale[:-META]), (mean[-META:], scale[-META:])]


def _surest(views: list, weights: list, given: list[set[int]]):
    """The `ADDED` surest rows of a task per view and class."""

    def run(batches):
        best: dict[tuple[int, int], list] = {(v, c): [] for v in (0, 1) for c in (0, 1)}
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            x = [_matrix(batch.column(c)) if ids else None for c in ("text", "meta")]
            for (own, value), held in best.items() if ids else ():
                z = logit(scaled(x[own], views[own]), weights[own])
                p = chance(z if value else -z)
                some = np.flatnonzero(p >= SURE)
                some = some[np.argsort(-p[some], kind="stable")][: ADDED + len(given[1 - own])]
                new = [k for k in some.tolist() if ids[k] not in given[1 - own]]
                held += [(-p[k], ids[k], x[0][k].tolist(), x[1][k].tolist()) for k in new]
                held.sort()
                del held[ADDED:]
        rows = [(own, value, *row) for (own, value), held in best.items() for row in held]
        names = ["own", "value", "least", "doc_id", "text", "meta"]
        if rows:
            yield pa.record_batch([pa.array(c) for c in zip(*rows)], names)

    return run


SUREST = "own long, value long, least double, doc_id long, text array<double>, meta array<double>"


def train(documents: DataFrame, labels: DataFrame, run: RunFolder, seed: int = 5):
    """The features of all documents, and the model; None without labels of both classes."""
    given = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").cast("int").alias("y")
    )
    given = given.where("y is not null")
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", "n_chars", "text"
    )
    features = run.write(rows.mapInArrow(_features, FEATURES), "features")
    # The sample is drawn on ids alone; features go to the driver for the drawn ones only.
    drawn = (
        features.select("doc_id").distinct().join(given, "doc_id")
        .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
        .limit(LABELLED)
    )
    found = (
        features.join(F.broadcast(drawn), "doc_id")  # at most LABELLED rows
        .groupBy("doc_id", "y")
        .agg(F.min(F.struct("text", "meta")).alias("f"))
        .select("doc_id", "y", "f.*")
        .toPandas()
        .sort_values("doc_id")
    )
    y = found.y.to_numpy(float)
    if not 0 < y.sum() < len(y):
        return features, None
    views = _views(features)
    labelled = [
        scaled(np.array(found[c].tolist(), float), v) for c, v in zip(("text", "meta"), views)
    ]
    fold = np.ones(len(y), bool)
    for value in (0, 1):  # a quarter of each class, whatever order their ids have
        own = np.random.default_rng(seed).permutation(np.flatnonzero(y == value))
        fold[own[: len(own) // 4]] = False
    unlabelled = run.write(
        features.where("doc_id is not null").join(given, "doc_id", "left_anti"), "unlabelled"
    )

    def surest(weights, handed):
        best = unlabelled.mapInArrow(_surest(views, weights, handed), SUREST)
        order = Window.partitionBy("own", "value").orderBy("least", "doc_id", "text")
        place = F.row_number().over(order)
        for r in best.withColumn("place", place).where(F.col("place") <= ADDED).collect():
            both = [scaled(np.array(x), v) for x, v in zip((r.text, r.meta), views)]
            yield r.own, r.value, r.doc_id, both

    def in_order(weights, handed):
        return sorted(surest(weights, handed), key=lambda r: r[:3])

    model = co_train(labelled, y, fold, in_order)
    run.drop("unlabelled")
    return features, model | {"views": views}


SCORES = "doc_id long, text_score double, meta_score double, score double, kept boolean"


def _score(model: dict | None, limit: float):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            if model is None:
                found = [np.full(batch.num_rows, 0.5)] * 3
            else:
                text, meta = _matrix(batch.column("text")), _matrix(batch.column("meta"))
                found = scores(model, text, meta)
            kept = found[2] >= limit if model else np.ones(batch.num_rows, bool)
            yield pa.record_batch(
                [batch.column("doc_id"), *map(pa.array, found), pa.array(kept)],
                ["doc_id", "text_score", "meta_score", "score", "kept"],
            )

    return run


def score(documents: DataFrame, labels: DataFrame, limit: float = 0.1, seed: int = 5) -> DataFrame:
    """`SCORES`: a row per row of `documents`; kept if good with a chance of `limit` or more.

    The limit is low, as a clean document lost weighs more than a poor one kept.
    """
    features, model = train(documents, labels, RunFolder(documents.sparkSession), seed)
    return features.mapInArrow(_score(model, limit), SCORES)


def good(documents: DataFrame, labels: DataFrame, limit: float = 0.1, seed: int = 5) -> DataFrame:
    """The rows of `documents` that are kept, as they are."""
    run = RunFolder(documents.sparkSession)
    _, model = train(documents, labels, run, seed)
    run.drop("features")

    def keep(batches):
        for batch in batches:
            view = batch.select(["doc_id", "lang", "source", "n_chars", "text"])
            view = view.set_column(0, "doc_id", view.column(0).cast(pa.int64()))
            parts = _score(model, limit)(_features([view]))
            kept = [k for part in parts for k in part.column("kept").to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
