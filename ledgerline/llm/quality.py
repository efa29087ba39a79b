"""Quality classifier: document evidence combined with host and path posteriors by hierarchical empirical Bayes.

Document level. A word table of shrunken log odds and a few shape features feed a logistic
regression. Both are fitted on a bounded sample of labelled rows (SAMPLE): the regression sees
each row with a word table counted on the other folds, and the final table counts all of them.

Site level. The documents' probabilities are summed per host and per path of a host, over all
documents. A host's rate is shrunk toward the global rate, a path's toward its host's; the
strength of each prior comes from the spread between groups (method of moments), so a sparse
site says next to nothing. The log odds of the path's rate against the global rate are added to
the document's own.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
import xxhash

from . import vocabularies
from .common import dealt_by_count, materialize, split_batches

#: Labelled documents that the classifier is fitted on, at most.
SAMPLE = 12_000
#: Buckets that words are hashed into.
BUCKETS = 1 << 20
#: Probability of being bad above which a document is rejected.
REJECT_ABOVE = 0.5

WORD = re.compile(r"[^\W\d_]+")
FEATURES = 12
#: Parts of the sample; each is scored by words counted in the others.
FOLDS = 4


def words_of(text: str) -> np.ndarray:
    """The distinct hashed words of a text (letters only, lower case)."""
    hashed = xxhash.xxh32_intdigest
    return np.unique(np.array([hashed(w) for w in set(WORD.findall(text.lower()))], np.int64) % BUCKETS)


def shape_of(text: str) -> list[float]:
    """Shares that tell prose from junk: symbols, capitals, digits, repeated words and lines, and length."""
    n = max(1, len(text))
    tokens = text.split()
    m = max(1, len(tokens))
    lines = [line for line in text.split("\n") if line]
    letters = sum(map(len, WORD.findall(text)))
    spaces = text.count(" ") + text.count("\n")
    repeats = sum(map(str.__eq__, tokens, tokens[1:]))
    return [
        (n - letters - spaces) / n,
        sum(map(str.isupper, tokens)) / m,
        len(re.findall(r"\d", text)) / n,
        1 - len(set(tokens)) / m,
        repeats / m,
        1 - len(set(lines)) / max(1, len(lines)),
        text.count("|") / m,
        float(np.log1p(m)),
        letters / m / 10,
    ]


def evidence(words: np.ndarray, table: np.ndarray) -> list[float]:
    """The strongest, the three strongest and the weakest shrunken log odds among a text's words."""
    own = np.sort(table[words]) if len(words) else np.zeros(1)
    return [float(max(own[-1], 0)), float(np.maximum(own[-3:], 0).sum()), float(min(own[0], 0))]


def word_table(docs: list[np.ndarray], bad: np.ndarray) -> np.ndarray:
    """Log odds of each hashed word between bad and good documents, pulled toward zero by 1.5 standard errors."""
    counts = np.zeros((2, BUCKETS))
    for words, y in zip(docs, bad):
        counts[int(y), words] += 1
    totals = np.array([[(bad == 0).sum()], [(bad == 1).sum()]]) + 1.0
    odds = np.log((counts[1] + 0.5) / totals[1]) - np.log((counts[0] + 0.5) / totals[0])
    margin = 1.5 * np.sqrt(1 / (counts[0] + 0.5) + 1 / (counts[1] + 0.5))
    return np.sign(odds) * np.maximum(np.abs(odds) - margin, 0)


def logistic(rows: np.ndarray, bad: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic regression (the first is the constant), by Newton steps."""
    x = np.column_stack([np.ones(len(rows)), rows])
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - bad) + penalty * weights
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


class Classifier:
    """What documents say by themselves: log odds of being bad."""

    def __init__(self, table: np.ndarray, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.words = np.flatnonzero(table).astype(np.int32)
        self.odds = table[self.words].astype(np.float32)
        self.mean, self.scale, self.weights = mean, scale, weights

    @classmethod
    def fit(cls, docs: list[np.ndarray], shapes: np.ndarray, bad: np.ndarray) -> Classifier:
        if not len(bad):
            return cls(np.zeros(BUCKETS), np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES + 1))
        part = np.arange(len(bad)) % FOLDS
        rows = np.zeros((len(bad), FEATURES))
        for fold in range(FOLDS):
            others, own = np.flatnonzero(part != fold), np.flatnonzero(part == fold)
            table = word_table([docs[i] for i in others], bad[others])
            for i in own:
                rows[i] = evidence(docs[i], table) + list(shapes[i])
        mean, scale = rows.mean(0), rows.std(0) + 1e-6
        return cls(word_table(docs, bad), mean, scale, logistic((rows - mean) / scale, bad.astype(float)))

    def table(self) -> np.ndarray:
        out = np.zeros(BUCKETS, np.float32)
        out[self.words] = self.odds
        return out

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(self.weights[0] + ((rows - self.mean) / self.scale) @ self.weights[1:], -12, 12)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Fit on at most `sample` labelled documents, drawn by a hash of the id. Bad is quality 0 or toxic 1.

    Rows without an id or without any label are passed over; of several labels of one document, one bad one suffices.
    Tasks turn texts into hashed words and shapes; the driver gets those of the sample only, one text for each id (the least).
    """
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    known = labels.where(F.col(id_col).isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
    known = known.groupBy(F.col(id_col).cast("long").alias("labelled")).agg(F.max(bad.cast("int")).alias("bad"))
    step = -(-known.count() // sample) or 1
    drawn = known.where(F.pmod(F.xxhash64("labelled"), F.lit(step)) == 0).orderBy(F.xxhash64("labelled", F.lit(1))).limit(sample)
    texts = docs.select(F.col(id_col).cast("long").alias("labelled"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "labelled")
    texts = texts.groupBy("labelled").agg(F.max("bad").alias("bad"), F.min("text").alias("text"))  # of repeated ids one text

    def featurize(batches):
        vocabularies.forget()
        for whole in batches:
            for batch in split_batches(whole, "text"):
                own = [t or "" for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("labelled"), batch.column("bad"), pa.array([words_of(t).astype("<i4").tobytes() for t in own], pa.binary()), pa.array([shape_of(t) for t in own], pa.list_(pa.float64()))],
                    ["labelled", "bad", "words", "shape"],
                )

    rows = texts.mapInArrow(featurize, "labelled bigint, bad int, words binary, shape array<double>").toPandas()
    rows = rows.sort_values("labelled", kind="stable")
    return Classifier.fit([np.frombuffer(w, "<i4") for w in rows["words"]], np.array(rows["shape"].tolist()).reshape(len(rows), FEATURES - 3), rows["bad"].to_numpy())


def document_scores(docs: DataFrame, model: Classifier, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns keep and evidence, the document's own log odds of being bad (null text: as an empty one)."""
    schema = docs.select(*keep, F.lit(0.0).alias("evidence")).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a bounded vocabulary of BUCKETS at most

    def score(batches):
        vocabularies.forget()
        classifier = shared.value
        table = classifier.table()
        for whole in batches:
            for batch in split_batches(whole, "__text"):
                rows = np.array([evidence(words_of(t or ""), table) + shape_of(t or "") for t in batch.column("__text").to_pylist()]).reshape(-1, FEATURES)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(classifier.score(rows))], [*keep, "evidence"])

    return docs.select(*keep, F.col(text_col).alias("__text")).mapInArrow(score, schema)


def prior_strength(groups: DataFrame, rate: str, around: str) -> float:
    """How many documents the prior of a level counts for: large where groups hardly differ beyond chance (method of moments)."""
    excess = F.sum(F.col("n") * (F.col(rate) - F.col(around)) ** 2 - F.col(around) * (1 - F.col(around)))
    row = groups.agg(excess.alias("excess"), F.sum("n").alias("n"), F.avg(F.col(around) * (1 - F.col(around))).alias("variance")).first()
    if not row["n"]:
        return 1.0
    between = max((row["excess"] or 0.0) / row["n"], 1e-6)
    return float(np.clip((row["variance"] or 0.0) / between, 1.0, 1e6))


def judge(docs: DataFrame, labels: DataFrame, host_col: str = "source", path_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """doc_id, evidence, site (log odds that the host and path add), score (probability of being bad) and keep.

    Every row gets one, repeated rows each; a null host or path is a group of its own, a null text is an empty one.
    Site rates come from sums over all documents, added up in each task before any row is moved. Without labels the
    classifier says nothing: every score is 0.5 and all documents are kept. Other columns are not read.
    """
    model = train(docs, labels, sample, id_col, text_col)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"), F.col(text_col).alias("text"))
    scored = materialize(document_scores(named, model, ["doc_id", "host", "path"]), "evidence")
    p = 1 / (1 + F.exp(-F.col("evidence")))
    paths = materialize(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("bad")), "sites")
    total = paths.agg(F.sum("n"), F.sum("bad")).first()
    rate = min(max((total[1] or 0.0) / (total[0] or 1), 1e-4), 1 - 1e-4)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("rate", F.col("bad") / F.col("n")).withColumn("around", F.lit(rate))
    strength = prior_strength(hosts, "rate", "around")
    hosts = hosts.select("host", ((F.col("bad") + strength * rate) / (F.col("n") + strength)).alias("host_rate"))
    below = paths.join(hosts, "host").withColumn("rate", F.col("bad") / F.col("n"))
    strength = prior_strength(below, "rate", "host_rate")
    site_rate = (F.col("bad") + strength * F.col("host_rate")) / (F.col("n") + strength)
    sites = below.select("host", "path", "n", (F.log(site_rate / (1 - site_rate)) - float(np.log(rate / (1 - rate)))).alias("site"))
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.col("site"))))
    return dealt_by_count(scored, sites, ["host", "path"], ["doc_id"]).select("doc_id", "evidence", "site", score.alias("score"), (score <= REJECT_ABOVE).alias("keep"))
