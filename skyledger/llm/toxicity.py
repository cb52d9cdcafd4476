"""Toxicity of texts by a support vector machine over a subsequence string kernel.

Two words are alike as far as they share subsequences of three characters; a
subsequence that is spread over more characters weighs less (a factor per gap,
up to six characters in all). So an insult with characters put in, left out or
gapped stays close to the plain one. The kernel of two sentences adds up the
squared, normalised likeness of their words; Nystroem landmarks, words of the
labelled sentences, turn it into features on which a linear machine is fitted.

Only documents have labels. A toxic document's sentences are a bag of which at
least one is toxic: fitting and choosing the sentence by the fitted machine
alternate. A logistic curve over a document's sentence margins gives the score.

The machine is fitted on at most ``FIT_ROWS`` labelled documents per class, taken
in hash order; everything else reads every document. Words met before are
remembered per task, up to a fixed number.

Defined results: a missing text is empty; texts without words get the score of
having nothing toxic. Labels without a document, missing labels and missing ids
are not learned from; if a document is labelled twice, toxic counts. Without any
usable label of either class every score is 0. Repeated rows give equal rows. An
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from skyledger.llm.common import sliced, whole_text
from skyledger.staging import StagingArea

#: Most labelled documents of each class that the machine is fitted on.
FIT_ROWS = 4000
#: Landmark words that tell the classes apart, and frequent ones.
LANDMARKS = (224, 32)
#: Scores from here on reject a document.
REJECT = 0.3

#: What the logistic curve looks at, the constant included.
FEATURES = 8
_DECAY = 0.6
_SPANS = [(a, a + b) for a in range(1, 6) for b in range(1, 6) if a + b <= 5]
_WIDTH = 24
#: Squared likeness below this counts as none.
_FAINT = 0.08
_REMEMBERED = 1 << 19
#: Bytes of texts scored at a time.
_LOT = 4 << 20
_FILTER_BITS = 18
_SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n")
_SIGNS = re.compile(r"[\W_]+")
_SPELLED = re.compile(r"(?<!\S)(?:\w[ *_-]){2,}\w(?!\S)")
_EDGES = "\"'`,;:()[]{}<>|#*-_=+&%$"


def sentences(text: str) -> list[set[str]]:
    """The distinct words of every sentence; letters spelled one by one also make a word."""
    text = text.lower()
    found = [set(s.split()) for s in _SENTENCE.split(text)]
    spelled = {"".join(c for c in m if c.isalnum()) for m in _SPELLED.findall(text)}
    return [s for s in (*found, spelled) if s]


def _parts(word: str) -> list[str]:
    """The word and, if it has signs inside, its letters alone; long ones in overlapping parts."""
    word = word.strip(_EDGES)
    forms = [word] if word.isalnum() else list(dict.fromkeys([word, _SIGNS.sub("", word)]))
    half = _WIDTH // 2
    return [f[i:i + _WIDTH] for f in forms for i in range(0, max(1, len(f) - half), half)]


def _subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, code, weight) of every subsequence occurrence."""
    letters = np.array(words, f"U{_WIDTH}").view(np.uint32).reshape(len(words), _WIDTH).astype(np.int64)
    rows, codes, weights = [], [], []
    for middle, last in _SPANS:
        end = letters[:, last:]
        row, at = np.nonzero(end)
        code = (letters[row, at] << 42) | (letters[row, at + middle] << 21) | end[row, at]
        rows.append(row)
        codes.append(code)
        weights.append(np.full(len(row), _DECAY ** (last - 2)))
    return np.concatenate(rows), np.concatenate(codes), np.concatenate(weights)


def _summed(row: np.ndarray, code: np.ndarray, weight: np.ndarray):
    by = np.lexsort((code, row))
    row, code, weight = row[by], code[by], weight[by]
    start = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (code[1:] != code[:-1])][:len(row)])
    return row[start], code[start], np.add.reduceat(weight, start) if len(start) else weight


class WordKernel:
    """Likeness of words to landmark words."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        row, code, weight = _summed(*_subsequences(landmarks))
        self.norm = np.sqrt(np.bincount(row, weight ** 2, len(landmarks)))
        by = np.argsort(code, kind="stable")
        self.code, first = np.unique(code[by], return_index=True)
        self.begin, self.end = first, np.r_[first[1:], len(code)]
        self.mark, self.weight = row[by], weight[by]
        self.known = np.zeros(1 << _FILTER_BITS, bool)
        self.known[self._slot(self.code)] = True

    @staticmethod
    def _slot(code: np.ndarray) -> np.ndarray:
        return ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def __call__(self, words: list[str]) -> np.ndarray:
        """Squared normalised kernel of every word and landmark; faint likeness is 0."""
        n, m = len(words), len(self.landmarks)
        row, code, weight = _subsequences(words)
        norm = np.sqrt(np.bincount(row, weight ** 2, n))  # at most the true one
        near = np.flatnonzero(self.known[self._slot(code)])
        place = np.minimum(np.searchsorted(self.code, code[near]), len(self.code) - 1)
        hit = self.code[place] == code[near]
        near, place = near[hit], place[hit]
        count = self.end[place] - self.begin[place]
        flat = np.repeat(self.begin[place] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        cell = np.repeat(row[near], count) * m + self.mark[flat]
        inner = np.bincount(cell, np.repeat(weight[near], count) * self.weight[flat], n * m).reshape(n, m)
        with np.errstate(divide="ignore", invalid="ignore"):
            like = np.nan_to_num(inner / (norm[:, None] * self.norm))
        close = np.flatnonzero((like ** 2).max(axis=1, initial=0) >= _FAINT)
        if len(close):
            chosen = np.isin(row, close)
            r, _, w = _summed(row[chosen], code[chosen], weight[chosen])
            true = np.sqrt(np.bincount(r, w ** 2, n))[close]
            like[close] = inner[close] / (true[:, None] * np.maximum(self.norm, 1e-12))
        like **= 2
        like[like < _FAINT] = 0
        return like


@dataclass
class Model:
    """Landmarks with their weights, the machine's offset and the logistic curve."""

    kernel: WordKernel | None
    weights: np.ndarray
    offset: float
    curve: np.ndarray

    def margins(self, words: list[str]) -> np.ndarray:
        """What each word adds to its sentence's margin: the strongest of its parts."""
        parts = [_parts(w) for w in words]
        value = self.kernel([p for own in parts for p in own]) @ self.weights
        return np.maximum.reduceat(value, np.cumsum([0, *(len(own) for own in parts[:-1])]))


class Reader:
    """Turns texts into what the logistic curve looks at; remembers words."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def learn(self, texts: list[str]) -> None:
        """Meets the words of many texts at once."""
        if len(self.known) > _REMEMBERED:
            self.known = {}
        words = set().union(*(s.lower().split() for s in texts))
        self._meet({p for w in words if w not in self.known for p in _SENTENCE.split(w) if p})

    def _meet(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        for i in range(0, len(new), 2048):
            part = new[i:i + 2048]
            self.known.update(zip(part, self.model.margins(part).tolist()))

    def __call__(self, text: str) -> list[float]:
        """Of the sentences: highest margin, positive margins together and their share;

        of the words: how many count as toxic, as a share and as such, and what
        they add up to with and without the harmless ones.
        """
        split = sentences(text)
        if not split:
            return [1.0, -1.0] + [0.0] * (FEATURES - 2)
        self._meet(set().union(*split))
        sizes = np.array([len(s) for s in split])
        each = np.fromiter((self.known[w] for s in split for w in s), float, int(sizes.sum()))
        margins = np.add.reduceat(each, np.cumsum(sizes) - sizes) + self.model.offset
        positive = np.clip(margins, 0, None).sum()
        high, words = (each > 0.5).sum(), len(each) + 30
        return [
            1.0, float(np.clip(margins.max(), -2, 6)), np.log1p(positive), positive / (len(split) + 3),
            high / words, np.clip(each, 0, 2).sum() / words, np.clip(each, -2, 2).sum() / words, np.log1p(high),
        ]


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0, rows: int = 4096) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps over lots of rows; the last column is the offset."""
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(30):
        gradient, bend = keep * w, np.diag(keep)
        for i in range(0, len(x), rows):
            own, label = x[i:i + rows].astype(np.float64), y[i:i + rows]
            gap = np.clip(1 - label * (own @ w), 0, None)
            pull = cost[i:i + rows] * (gap > 0)
            gradient -= own.T @ (pull * label * gap)
            bend += own.T @ (pull[:, None] * own)
        step = np.linalg.solve(bend, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _logistic(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the first column is constant."""
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    middle[0], spread[0] = 0.0, 1.0
    x = (x - middle) / spread
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = ridge * w - x.T @ (cost * (y - p))
        step = np.linalg.solve(ridge * np.eye(len(w)) + x.T @ ((cost * p * (1 - p))[:, None] * x), gradient)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    w = w / spread
    w[0] -= w @ middle
    return w


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_sample(docs: DataFrame, labels: DataFrame, area: StagingArea, rows: int = FIT_ROWS) -> DataFrame:
    """text, toxic, weight of at most ``rows`` learnable documents of each class, written; of rows with one doc_id one text."""
    usable = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna()
        .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    counts = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    first = [
        usable.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        .withColumn("weight", F.lit(max(1.0, counts.get(c, 0) / rows)))
        for c in (0, 1)
    ]
    chosen = area.table(first[0].unionByName(first[1]).coalesce(1), "labelled")
    return area.table(
        docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic", "weight").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
        .select("text", "toxic", "weight"),
        "fit-sample",
    )


def landmark_words(sample: DataFrame, many: tuple[int, int] = LANDMARKS) -> list[str]:
    """The words whose presence tells the classes apart best, then frequent ones."""
    words = sample.select(
        "toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))).alias("word")
    ).where((F.length("word") >= 3) & (F.length("word") <= _WIDTH))
    seen = words.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    totals = sample.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    toxic, clean = (max(1, x or 0) for x in totals)
    share = (F.col("t") / toxic, F.col("c") / clean)
    contrast = (share[0] - share[1]) / F.sqrt(share[0] + share[1] + 0.2 / toxic)
    telling = seen.where("t >= 2").orderBy(contrast.desc(), "word").limit(many[0]).collect()
    frequent = seen.orderBy(F.desc("c"), "word").limit(many[1]).collect()
    return list(dict.fromkeys(r["word"] for r in (*telling, *frequent)))


def _bags(kernel: WordKernel, telling: int, most: int = 3):
    """Landmark features of each document's sentences that look most telling, and of its first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, bag = len(kernel.landmarks), 0
        for batch in sliced(batches, "text"):
            out: list[tuple[int, int, float]] = []
            values: list[np.ndarray] = []
            for text, toxic, weight in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "weight"))):
                split = sentences(text)
                words = list(set().union(*split))
                number = {w: i for i, w in enumerate(words)}
                like = np.concatenate(
                    [kernel([w.strip(_EDGES)[:_WIDTH] for w in words[i:i + 2048]]) for i in range(0, len(words), 2048)]
                ) if words else np.zeros((0, m))
                look = like[:, :telling].max(axis=1, initial=0)
                rank = sorted(range(len(split)), key=lambda i: -sum(look[number[w]] for w in split[i]))
                for i in dict.fromkeys([*rank[:most], *range(min(1, len(split)))]):
                    out.append((bag, toxic, weight))
                    values.append(like[[number[w] for w in split[i]]].sum(axis=0, keepdims=True).astype(np.float32))
                bag += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()),
                 pa.array([o[2] for o in out], pa.float64()), pa.array([v.tobytes() for v in values], pa.binary())],
                ["bag", "toxic", "weight", "like"],
            )

    return run


def _points_of(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(model)
        for batch in sliced(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            read.learn(texts)
            x = np.array([read(t) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), batch.column("weight"), pa.array(x.tolist(), pa.list_(pa.float64()))],
                ["toxic", "weight", "x"],
            )

    return run


def fit(docs: DataFrame, labels: DataFrame, area: StagingArea, rows: int = FIT_ROWS) -> Model:
    """Fits on a bounded sample; what reaches the driver is bounded by ``rows`` and ``LANDMARKS``."""
    sample = fit_sample(docs, labels, area, rows)
    landmarks = landmark_words(sample)
    nothing = Model(None, np.zeros(0), 0.0, np.zeros(FEATURES))
    if not landmarks:
        return nothing
    kernel = WordKernel(landmarks)
    bags = sample.repartition(32).mapInArrow(
        _bags(kernel, min(LANDMARKS[0], len(landmarks))), "bag long, toxic int, weight double, like binary"
    ).withColumn("bag", F.concat_ws("-", F.spark_partition_id(), "bag")).toArrow().to_pandas()
    y = np.where(bags["toxic"] > 0, 1.0, -1.0)
    if len(set(y)) < 2:
        return nothing
    values, vectors = np.linalg.eigh(kernel(landmarks) + 1e-3 * np.eye(len(landmarks)))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    like = np.frombuffer(b"".join(bags.pop("like")), np.float32).reshape(len(bags), -1)
    x = np.c_[like @ root.astype(np.float32), np.ones(len(bags), np.float32)]
    del like
    bag = bags["bag"].astype("category").cat.codes.to_numpy()
    cost, chosen = bags["weight"].to_numpy(), np.ones(len(bags), bool)
    balance = np.where(y > 0, (y < 0).sum() / max(1, (y > 0).sum()), 1.0)
    for _ in range(4):
        w = _svm(x, y, np.sqrt(cost * balance) * chosen)
        value = x @ w
        best = np.full(bag.max() + 1, -np.inf)
        np.maximum.at(best, bag, value)
        chosen = (y < 0) | (value >= best[bag])
    model = Model(kernel, root @ w[:-1], float(w[-1]), np.zeros(FEATURES))
    points = sample.repartition(32).mapInArrow(_points_of(model), "toxic int, weight double, x array<double>").toPandas()
    model.curve = _logistic(
        np.array(points["x"].tolist()), points["toxic"].to_numpy(float), points["weight"].to_numpy()
    )
    return model


def _scores(model: Model, text: int):
    """``text``: the place of the text among the row's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(model)
        for batch in batches:
            rows, out = batch.column("row"), []
            own = pa.RecordBatch.from_arrays([rows.field(text)], ["text"])
            for part in sliced(iter([own]), "text", _LOT):
                texts = [t or "" for t in part.column(0).to_pylist()]
                if model.kernel is None:
                    out += [0.0] * len(texts)
                    continue
                read.learn(texts)
                x = np.array([read(t) for t in texts])
                out += (1 / (1 + np.exp(-np.clip(x @ model.curve, -30, 30)))).tolist()
            yield pa.RecordBatch.from_arrays([rows, pa.array(out, pa.float64())], ["row", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """row (all columns of ``docs``) and score of every row."""
    packed = docs.select(F.struct("*").alias("row"))
    schema = T.StructType([packed.schema["row"], T.StructField("score", T.DoubleType())])
    return packed.mapInArrow(_scores(model, docs.columns.index("text")), schema)


def toxicity(docs: DataFrame, labels: DataFrame, area: StagingArea) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, area))
    return scored.select(
        F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"),
    )
