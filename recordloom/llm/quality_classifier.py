"""Quality by ordinal cumulative-link regression on graded ratings (operator 6).

P(grade > k) is the logistic function of w.x - t_k: one weight vector over hashed
features of the text, shared by all grades, and one ordered threshold for each
border between them. The model gives an expected grade and the tail probability
of the best grade, by which documents are selected.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import pairwise

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, FloatType, IntegerType, StructField, StructType

from recordloom.llm.common import Memo, filter_rows, map_arrow, table

#: Features, labelled texts of each grade that are fitted on (about), and the grades: toxic, poor, good.
FEATURES, SAMPLE, GRADES = 1 << 18, 2500, 3
#: A feature takes part if so many fitted texts have it, and its mean differs between two grades by so many standard errors.
COMMON, TELLING = 8, 5.0
#: Documents with a smaller tail probability of the best grade are rejected.
ACCEPT = 0.5
STEPS, RATE, RIDGE = 300, 0.2, 3e-4


def _shape(word: str) -> str:
    """Its letters' case and the marks at its end, lengths left out."""
    core = word.rstrip("!%&*$#|.,;:?")
    case = "0" if not core else "A" if core.isupper() and len(core) > 1 else "a" if core.isalpha() else "1" if any(map(str.isdigit, core)) else "x"
    return case + "".join(dict.fromkeys(word[len(core) :]))


def _place(name: str) -> int:
    return xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass"), 7) % (FEATURES - 1) + 1


_word = Memo(lambda w: (_place("w" + w.strip("!%&*$#|.,;:?\"'()").lower()), _place("s" + _shape(w))), 120_000, alone=True)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features, over its whole length.

    A word that occurs has value 1; the shapes of words, and words that repeat the
    word before, have the root of their share of all words. Place 0 is a constant.
    """
    words = (text or "").split()
    got = list(map(_word.__getitem__, words))
    present = {w for w, _ in got}
    n = max(1, len(words))
    shares = Counter(s for _, s in got)
    shares[_place("repeat")] = sum(a == b for a, b in pairwise(words))
    shares[_place("distinct")] = len(present)
    shares[_place("long")] = sum(len(w) > 30 for w in words)
    out = dict.fromkeys(present, 1.0) | {k: 3 * math.sqrt(v / n) for k, v in shares.items() if v} | {0: 1.0}
    return np.fromiter(out, np.int64, len(out)), np.fromiter(out.values(), np.float64, len(out))


class Ordinal:
    """Weights, and ordered thresholds between the grades 0, 1, ..."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def grade(self, text: str | None) -> tuple[float, float]:
        """Expected grade and tail probability of the best grade."""
        at, values = features(text)
        score = float(self.weights[at] @ values)
        tails = 1 / (1 + np.exp(np.clip(self.thresholds - score, -500, 500)))
        return float(tails.sum()), float(tails[-1])


def loss(params: np.ndarray, at: np.ndarray, values: np.ndarray, row: np.ndarray, grades: np.ndarray, n_live: int, n_grades: int, ridge: float) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood with the ridge, and its gradient.

    ``params`` are the weights of the live features, the first threshold and the logs
    of the gaps to the next ones; ``at, values, row`` are the features' triples.
    """
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    w, gaps = params[:n_live], np.exp(params[n_live + 1 :])
    cuts = params[n_live] + np.append(0, np.cumsum(gaps))
    score = np.bincount(row, values * w[at], len(grades))
    upper = np.append(cuts, np.inf)[grades]  # P(grade) = s(upper - score) - s(lower - score)
    lower = np.append(-np.inf, cuts)[grades]
    su, sl = sigmoid(upper - score), sigmoid(lower - score)
    p = np.maximum(su - sl, 1e-12)
    du, dl = su * (1 - su) / p / len(grades), sl * (1 - sl) / p / len(grades)
    by_cut = np.bincount(np.minimum(grades, n_grades - 2), -du * (grades < n_grades - 1), n_grades - 1) + np.bincount(np.maximum(grades - 1, 0), dl * (grades > 0), n_grades - 1)
    by_param = np.cumsum(by_cut[::-1])[::-1]
    grad = np.concatenate([np.bincount(at, values * (du - dl)[row], n_live) + ridge * w, by_param[:1], by_param[1:] * gaps])
    return float(-np.log(p).mean() + ridge / 2 * (w @ w)), grad


def train(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int = GRADES, *, steps: int = STEPS, rate: float = RATE, ridge: float = RIDGE, common: int = COMMON, telling: float = TELLING) -> Ordinal:
    """Fits by full-batch Adam on the cumulative-link likelihood over the features that tell grades apart."""
    weights, thresholds = np.zeros(FEATURES), np.linspace(-1.0, 1.0, n_grades - 1)
    if not len(rows):
        return Ordinal(weights, thresholds)
    at, values = np.concatenate([a for a, _ in rows]), np.concatenate([v for _, v in rows])
    row = np.repeat(np.arange(len(rows)), [len(a) for a, _ in rows])
    seen = np.bincount(at, minlength=FEATURES)
    of = [np.bincount(grades, minlength=n_grades)[g] for g in range(n_grades)]
    sums = [np.bincount(at, values * (grades[row] == g), FEATURES) for g in range(n_grades)]
    squares = [np.bincount(at, values**2 * (grades[row] == g), FEATURES) for g in range(n_grades)]
    apart = np.zeros(FEATURES)
    for low in range(n_grades - 1):  # the grades up to ``low`` against those above
        na, nb = max(1, sum(of[: low + 1])), max(1, sum(of[low + 1 :]))
        ma, mb = sum(sums[: low + 1]) / na, sum(sums[low + 1 :]) / nb
        pooled = sum(squares) / (na + nb) - (sum(sums) / (na + nb)) ** 2
        apart = np.maximum(apart, np.abs(ma - mb) / np.sqrt(np.maximum(pooled, 1e-9) * (1 / na + 1 / nb)))
    often = (seen >= min(common, len(rows))) & (apart >= telling) & (np.arange(FEATURES) > 0)
    keep = often[at]
    live = np.flatnonzero(often)
    at, values, row = np.searchsorted(live, at[keep]), values[keep], row[keep]
    w, gaps = np.zeros(len(live)), np.log(np.diff(thresholds, prepend=thresholds[0] - 1))  # thresholds as a start and positive gaps
    start = thresholds[0]
    params = np.concatenate([w, [start], gaps[1:]])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        _, grad = loss(params, at, values, row, grades, len(live), n_grades, ridge)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        params -= rate * (1 - 0.9 * step / steps) * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
    weights[live] = params[: len(live)]
    return Ordinal(weights, params[len(live)] + np.append(0, np.cumsum(np.exp(params[len(live) + 1 :]))))


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Ordinal:
    """The model of texts in ``docs`` whose ``labels(doc_id, quality, toxic)`` are known.

    Grades: 0 toxic, 1 not toxic and of poor quality, 2 neither. Rows with a null id,
    text or label are left out; of several labels of an id the worst counts, and of
    several texts one. About ``sample`` ids of each grade, by a hash of the id, are
    fitted on; their features, not their texts, come to the driver.
    """
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    known = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg(F.min(grade).alias("grade"))
    rows = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    sizes = {g: n for g, n in known.groupBy("grade").count().collect()}
    if not sizes:
        return train([], np.empty(0, np.int64))
    share = F.element_at(F.create_map(*(F.lit(x) for g in range(GRADES) for x in (g, sample / sizes.get(g, 1)))), F.col("grade"))
    own = (F.xxhash64(F.lit(2), "doc_id") % 1_000_003 + 1_000_003) % 1_000_003 / F.lit(1_000_003.0)
    # About ``sample`` ids of each of three grades, whatever the input: small enough to broadcast, so no text is shuffled.
    picked = rows.join(F.broadcast(known.where(own < share)), "doc_id").select("doc_id", "grade", "text")
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("grade", IntegerType()), StructField("at", ArrayType(IntegerType())), StructField("v", ArrayType(FloatType()))])

    def run(ids: list, grades: list, texts: list) -> list:
        got = [features(t) for t in texts]
        return [ids, grades, [a for a, _ in got], [v for _, v in got]]

    # One text of an id, the one of smallest features, so that a repeated id brings one row to the driver.
    one = map_arrow(picked, run, schema).groupBy("doc_id", "grade").agg(F.min(F.struct("at", "v")).alias("x"))
    seen = sorted(one.select("doc_id", "grade", "x.at", "x.v").collect(), key=lambda r: (r.doc_id, r.grade))
    return train([(np.asarray(r.at, np.int64), np.asarray(r.v)) for r in seen], np.asarray([r.grade for r in seen], np.int64))


def grade(docs: DataFrame, model: Ordinal, *, accept: float = ACCEPT) -> DataFrame:
    """``doc_id, expected_grade, p_best, accepted`` for each row of ``docs``, from its whole text.

    Null and empty texts have no feature but the constant and no words; they are
    graded like any other. Repeated rows repeat; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("expected_grade", DoubleType()), StructField("p_best", DoubleType()), StructField("accepted", BooleanType())])

    def run(ids: list, texts: list) -> list:
        got = [shared.value.grade(t) for t in texts]
        return [ids, [g for g, _ in got], [p for _, p in got], [p >= accept for _, p in got]]

    return map_arrow(docs.select("doc_id", "text"), run, schema)


def drop_rejected(docs: DataFrame, model: Ordinal, *, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` that the model accepts, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return filter_rows(docs, "text", lambda texts: [shared.value.grade(t)[1] >= accept for t in texts])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return grade(docs, fit(docs, table(spark, sf_dir, "labels")))
