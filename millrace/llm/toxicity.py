"""Toxicity by a classifier chain of linear models.

Categories are predicted in order; the model of each takes the text's features and the probabilities of the categories
before it. In training those probabilities are out-of-fold predictions, so a later model sees them as good or bad as
they will be on new texts. Features are the presence of words and (at a lower value) of their first 4, 5 and 6 letters;
each fit keeps the features that a chi-square test ties to its category. The decision threshold comes from
the last model's out-of-fold probabilities, weighted to the shares that the classes have among all labelled rows.

The chain is fitted on at most ``MAX_PER_CLASS`` labelled rows of each class of the last category, those of the
smallest hash among those that have a document; classes are counted over all of these, and all documents are scored in one pass without a shuffle.

Rows: null and empty texts have no features and get the probabilities of the intercepts. Label rows with a null id or
label are left out, of several for one id the larger counts; several rows of one id are fitted each. Rows of equal features
get equal probabilities; a text is scored whole, whatever its length. Without both classes nothing is rejected.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import filter_rows, forget, id_text, map_arrow, materialise, table

#: Labelled rows of either class of the last category that are fitted.
MAX_PER_CLASS = 3000
FOLDS, MAX_FEATURES, MIN_ROWS, CHI2, RIDGE = 4, 4000, 3, 12.0, 0.02
PREFIXES, PREFIX_VALUE = (4, 5, 6), 0.5
CATEGORIES = ("low_quality", "toxic")
_WORD = re.compile(r"\w+")


def _hash(name: str) -> int:
    return xxhash.xxh64_intdigest(name) >> 1


def features_of(word: str) -> list[int]:
    """The word, then its beginnings."""
    return [_hash(word)] + [_hash(f"{word[:k]}*") for k in PREFIXES if len(word) >= k]


def _text_features(text: str | None) -> bytes:
    """Sorted distinct features; the lowest bit tells beginnings from words."""
    found = set()
    for word in set(_WORD.findall((text or "").lower())):
        first, *rest = features_of(word)
        found.add(first & ~1)
        found.update(x | 1 for x in rest)
    return np.array(sorted(found), "i8").tobytes()


@dataclass
class Linear:
    """Weights by feature, the intercept, and weights of the earlier categories' probabilities."""

    weights: dict[int, float] = field(default_factory=dict)
    bias: float = 0.0
    chained: list[float] = field(default_factory=list)

    def score(self, total: float, earlier: list[float]) -> float:
        return total + self.bias + sum(a * b for a, b in zip(self.chained, earlier, strict=True))


@dataclass
class Chain:
    categories: tuple[str, ...]
    models: list[Linear]
    threshold: float


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _value(ids: np.ndarray) -> np.ndarray:
    return np.where(ids & 1, PREFIX_VALUE, 1.0)


def _lbfgs(f, x: np.ndarray, steps: int = 60, memory: int = 8) -> np.ndarray:
    value, grad = f(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d = -grad
        alphas = []
        for s, y in reversed(past):
            a = s @ d / (s @ y)
            d = d - a * y
            alphas.append(a)
        if past:
            s, y = past[-1]
            d = d * (s @ y) / (y @ y)
        for (s, y), a in zip(past, reversed(alphas), strict=True):
            d = d + (a - y @ d / (s @ y)) * s
        size = 1.0 if past else min(1.0, 1.0 / (np.abs(grad).sum() + 1e-12))
        for _ in range(25):
            new, new_grad = f(x + size * d)
            if new <= value + 1e-4 * size * (grad @ d):
                break
            size /= 2
        else:
            break
        s, y = size * d, new_grad - grad
        x, change, value, grad = x + s, value - new, new, new_grad
        if s @ y > 1e-12:
            past = [*past[-memory + 1 :], (s, y)]
        if change < 1e-7:
            break
    return x


def fit_linear(rows: list[np.ndarray], y: np.ndarray, earlier: np.ndarray) -> Linear:
    """Ridge logistic regression on the features that a chi-square test keeps."""
    n, ones = len(y), float(y.sum())
    if not 0 < ones < n:
        odds = np.log((ones + 0.5) / (n - ones + 0.5))
        return Linear({}, float(odds), [0.0] * earlier.shape[1])
    ids = np.concatenate(rows) if rows else np.zeros(0, "i8")
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    names, at = np.unique(ids, return_inverse=True)
    df = np.bincount(at, minlength=len(names)).astype("f8")
    pos = np.bincount(at, y[row], minlength=len(names))
    expected = df * ones / n
    chi = (pos - expected) ** 2 / np.maximum(expected, 1e-9) + (pos - expected) ** 2 / np.maximum(df - expected, 1e-9)
    keep = np.flatnonzero((df >= MIN_ROWS) & (chi >= CHI2))
    keep = keep[np.lexsort((names[keep], -chi[keep]))][:MAX_FEATURES]
    place = np.full(len(names), -1)
    place[keep] = np.arange(len(keep))
    on = place[at] >= 0
    row, col, val = row[on], place[at][on], _value(ids[on])
    k, m = len(keep), earlier.shape[1]

    def f(w: np.ndarray):
        z = np.bincount(row, val * w[col], minlength=n) + w[k] + earlier @ w[k + 1 :]
        p = _sigmoid(z)
        loss = np.mean(np.logaddexp(0, z) - y * z) + RIDGE / 200 * (w[:k] @ w[:k] + w[k + 1 :] @ w[k + 1 :])
        r = (p - y) / n
        grad = np.concatenate([np.bincount(col, val * r[row], minlength=k) + RIDGE / 100 * w[:k], [r.sum()], earlier.T @ r + RIDGE / 100 * w[k + 1 :]])
        return loss, grad

    w = _lbfgs(f, np.zeros(k + 1 + m))
    return Linear(dict(zip(names[keep].tolist(), w[:k].tolist(), strict=True)), float(w[k]), w[k + 1 :].tolist())


def _scores(model: Linear, rows: list[np.ndarray], earlier: np.ndarray) -> np.ndarray:
    get = model.weights.get
    return np.array([model.score(sum(get(i, 0.0) * (PREFIX_VALUE if i & 1 else 1.0) for i in r.tolist()), e.tolist()) for r, e in zip(rows, earlier, strict=True)])


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, categories: tuple[str, ...], shares: tuple[float, float] = (1.0, 1.0)) -> Chain:
    """labels: a column for each category. shares: weight of a negative and a positive row in the threshold."""
    n = len(rows)
    fold = np.arange(n) % FOLDS
    earlier, models, last = np.zeros((n, 0)), [], np.zeros(n)
    for k in range(len(categories)):
        y = labels[:, k].astype("f8")
        last = np.zeros(n)
        for j in range(FOLDS):
            out = fold == j
            if out.any() and not out.all():
                model = fit_linear([r for r, o in zip(rows, out, strict=True) if not o], y[~out], earlier[~out])
                last[out] = _scores(model, [r for r, o in zip(rows, out, strict=True) if o], earlier[out])
        models.append(fit_linear(rows, y, earlier))
        earlier = np.column_stack([earlier, _sigmoid(last)])
    return Chain(categories, models, _threshold(last, labels[:, -1] if n else np.zeros(0), shares))


def _threshold(scores: np.ndarray, y: np.ndarray, shares: tuple[float, float]) -> float:
    """The score of the best F1 out of fold, half-way to the next lower one; infinite without both classes."""
    if not 0 < y.sum() < len(y):
        return float("inf")
    order = np.argsort(-scores, kind="stable")
    s, pos = scores[order], y[order] > 0
    tp, fp = np.cumsum(pos) * shares[1], np.cumsum(~pos) * shares[0]
    f1 = 2 * tp / (tp + fp + pos.sum() * shares[1])
    f1[:-1][s[:-1] == s[1:]] = -1
    best = int(np.argmax(f1))
    return float((s[best] + s[min(best + 1, len(s) - 1)]) / 2)


def fit(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES, max_per_class: int = MAX_PER_CLASS) -> Chain:
    """A chain for ``docs`` (doc_id, text) and ``labels`` (doc_id and a 0/1 column for each category)."""
    last = categories[-1]
    marks = labels.where(" AND ".join(f"`{c}` IS NOT NULL" for c in ("doc_id", *categories))).groupBy(F.col("doc_id").cast("long").alias("id")).agg(*[F.max(F.col(c).cast("int")).alias(c) for c in categories])
    # a label without a document is no sample; written, as it is read three times
    marks, path = materialise(marks.join(id_text(docs).select(F.col("doc_id").alias("own")), F.col("id") == F.col("own"), "left_semi"), "labels")
    share = {r[0]: r[1] for r in marks.groupBy(F.col(last) > 0).count().collect()}
    sample = None
    for positive in (True, False):
        part = marks.where((F.col(last) > 0) == positive).orderBy(F.xxhash64("id"), "id").limit(max_per_class)
        sample = part if sample is None else sample.unionByName(part)
    chosen = id_text(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("id"))

    def run(batch: pa.RecordBatch) -> dict:
        return {"id": batch.column(0), "x": [_text_features(t) for t in batch.column(1).to_pylist()]} | {c: batch.column(2 + k) for k, c in enumerate(categories)}

    schema = "id long, x binary, " + ", ".join(f"`{c}` int" for c in categories)
    got = sorted(map_arrow(chosen.select("doc_id", "text", *categories), run, schema).collect(), key=lambda r: (xxhash.xxh64_intdigest(str(r[0])), r[0], bytes(r[1])))
    forget(docs.sparkSession, path)
    rows = [np.frombuffer(bytes(r[1]), "i8") for r in got]
    y = np.array([[int(v > 0) for v in r[2:]] for r in got]).reshape(len(got), len(categories))
    n1 = int(y[:, -1].sum())
    shares = (share.get(False, 0) / max(1, len(got) - n1), share.get(True, 0) / max(1, n1))
    return fit_chain(rows, y, categories, shares)


class _Scorer:
    """Sums of the models' weights over a text's distinct words; each word's share is looked up once."""

    def __init__(self, chain: Chain):
        self.chain, self.cache = chain, {}
        self.features = set().union(*(m.weights for m in chain.models))

    def words(self, word: str) -> tuple[int, ...]:
        first, *rest = features_of(word)
        return tuple(x for x in [first & ~1, *(r | 1 for r in rest)] if x in self.features)

    def probabilities(self, text: str | None) -> tuple[list[float], bool]:
        found, cache = set(), self.cache
        for word in set(_WORD.findall((text or "").lower())):
            got = cache.get(word)
            if got is None:
                if len(cache) > 300_000:
                    cache.clear()
                got = self.words(word)
                if len(word) <= 64:
                    cache[word] = got
            if got:
                found.update(got)
        earlier: list[float] = []
        score = 0.0
        for model in self.chain.models:
            get = model.weights.get
            score = model.score(sum(get(i, 0.0) * (PREFIX_VALUE if i & 1 else 1.0) for i in sorted(found)), earlier)
            earlier.append(float(_sigmoid(score)))
        return earlier, score > self.chain.threshold


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, p_<category> ..., rejected) of each row of ``docs``."""
    names = [f"p_{c}" for c in chain.categories]

    def run(batch: pa.RecordBatch) -> dict:
        got = [scorer.probabilities(t) for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "rejected": [r for _, r in got]} | {n: [round(float(p[k]), 6) for p, _ in got] for k, n in enumerate(names)}

    scorer = _Scorer(chain)
    return map_arrow(id_text(docs), run, "doc_id long, " + ", ".join(f"`{n}` double" for n in names) + ", rejected boolean")


def clean(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the chain doesn't reject, with all their columns."""

    def keep():
        scorer = _Scorer(chain)
        return lambda text: not scorer.probabilities(text)[1]

    return filter_rows(docs, keep, text_col)


def chain_for(docs: DataFrame, labels: DataFrame) -> Chain:
    """The chain of the ``labels`` table: low quality first, then toxic."""
    return fit(docs, labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, chain_for(docs, table(spark, sf_dir, "labels"))).withColumnRenamed("rejected", "toxic")
