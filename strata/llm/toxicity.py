"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two words counts common character subsequences of length three,
gaps included at a decay, so an insult with characters put in still resembles
itself.  Two sentences compare by the sum of the sharpened kernels of their
words.  Landmarks are the words that most mark labelled toxic documents, and
the words nearest to them that do not; the Nyström map of a sentence is linear
in its words, and so is the machine on it.
A document's score is calibrated on its most toxic sentence and on what all its
sentences add up to.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged

DECAY = 0.6  # weight of one more character spanned
SPAN = 8  # characters that a subsequence may reach over
SHARP = 4  # power of the word kernel (a product of kernels is a kernel)
FAR = 0.35  # words whose kernel to every landmark of the toxic kind is below this have the null feature
LONG = 24  # longer words are read in windows of this length, half overlapping
MAX_LANDMARKS = 100  # bound of the landmarks that mark toxic documents, and of those like them that do not
MAX_DOCUMENTS = {1: 6_000, 0: 6_000}  # bound of the labelled documents that training reads, by label
MAX_SENTENCES = 8_000  # bound of the training sample, per label
MAX_CALIBRATION = 6_000  # bound of the documents that calibrate the score
MIN_DOCS = 3  # toxic training documents in which a landmark occurs
BLOCK = 2_048  # rows of the training matrix that a step of the fit copies
CHANCE = 0.01  # bound of the expected number of landmarks that mark toxic documents by chance alone

_SENTENCE = re.compile(r"[.!?]+(?:\s+|$)|\n+|\s[|]\s")
_STRIP = re.compile(r"[\W_]+")
_SPACED = re.compile(r"(?<!\S)(?:\w[.\-_*]?\s+){2,}\w(?!\S)")


def words_of(sentence: str) -> list[str]:
    """Words as written; letters spelt out one by one also count as the word they make."""
    words = sentence.split()
    if _SPACED.search(sentence):
        words += ["".join(m.group().split()) for m in _SPACED.finditer(sentence)]
    return words


def bare(word: str) -> str:
    """A word without punctuation."""
    return word if word.isalnum() else _STRIP.sub("", word)


def sentences_of(text: str | None) -> list[str]:
    return [s for s in _SENTENCE.split((text or "").lower()) if s and not s.isspace()]


def _triples(word: str) -> dict[str, float]:
    """Weight of each character triple of a word, gaps included."""
    out: dict[str, float] = {}
    for i in range(len(word)):
        for k in range(i + 2, min(len(word), i + SPAN)):
            for j in range(i + 1, k):
                u = word[i] + word[j] + word[k]
                out[u] = out.get(u, 0.0) + DECAY ** (k - i + 1)
    return out


def kernel(a: str, b: str) -> float:
    """Normalised gap-weighted subsequence kernel of two words."""
    x, y = _triples(a), _triples(b)
    dot = sum(v * y.get(u, 0.0) for u, v in x.items())
    norm = sum(v * v for v in x.values()) * sum(v * v for v in y.values())
    return dot / norm**0.5 if norm else 0.0


@dataclass
class Model:
    landmarks: list[str]
    marks: int  # how many of them, the first, mark toxic documents
    nystrom: np.ndarray  # landmarks x rank
    weight: np.ndarray  # rank
    bias: float
    curve: np.ndarray  # of the calibration, over the evidence
    base: float  # share of toxic training documents; the score without a machine

    def word_weights(self) -> np.ndarray:
        return self.nystrom @ self.weight

    def name(self) -> str:
        return hashlib.sha256(repr(self.landmarks).encode() + self.word_weights().tobytes()).hexdigest()


class WordScorer:
    """Sharpened kernels of words to the landmarks, and their weighted sum, remembered per word.

    The first ``marks`` landmarks mark toxic documents: a word whose kernel to
    all of these is below FAR has the null feature.
    """

    def __init__(self, landmarks: list[str], marks: int, weights: np.ndarray | None = None):
        self.marks, self.weights, self.seen, self.hot = marks, weights, {}, set()
        feats = [_triples(w) for w in landmarks]
        self.column: dict[str, int] = {}
        for f in feats:
            for u in f:
                self.column.setdefault(u, len(self.column))
        self.unit = np.zeros((len(self.column), len(landmarks)), np.float32)
        for j, f in enumerate(feats):
            norm = sum(v * v for v in f.values()) ** 0.5
            for u, v in f.items():
                self.unit[self.column[u], j] = v / norm
        self.most = self.unit[:, :marks].max(1) if marks else np.zeros(len(self.column), np.float32)
        # characters that the landmarks use; all others are one class without any triple in common
        chars = sorted({c for u in self.column for c in u})
        self.code = {c: i + 1 for i, c in enumerate(chars)}
        self.base = len(chars) + 1
        self.find = np.zeros(self.base**3, np.int32)
        for u, i in self.column.items():
            a, b, c = (self.code[x] for x in u)
            self.find[(a * self.base + b) * self.base + c] = i + 1

    def _kernels(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of words of one length: the numbers of those near a mark, and their sharpened kernels to all landmarks."""
        n = len(words[0])
        none = np.zeros(0, int), np.zeros((0, self.unit.shape[1]))
        at = [(i, j, k) for i in range(n) for k in range(i + 2, min(n, i + SPAN)) for j in range(i + 1, k)]
        if not at:
            return none
        i, j, k = np.array(at).T
        weight = DECAY ** (k - i + 1.0)
        text = "".join(words)
        flat = np.array([self.code.get(c, 0) for c in text], np.int32).reshape(len(words), n)
        ids = self.find[(flat[:, i] * self.base + flat[:, j]) * self.base + flat[:, k]]
        row, col = np.nonzero(ids)
        # no mark's kernel exceeds what the best mark of every single triple would give
        least = (FAR - 1e-4) * np.sqrt((weight * weight).sum())
        reach = np.bincount(row, weight[col] * self.most[ids[row, col] - 1], len(words)) >= least
        use = reach[row]
        row, col = row[use], col[use]
        if not len(row):
            return none
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        w = weight[col, None].astype(np.float32)
        dots = np.add.reduceat(self.unit[ids[row, col] - 1, :self.marks] * w, first, axis=0)
        # a word's norm is at least that of its triples taken one by one, so this leaves none out
        some = row[first][dots.max(1) >= least]
        if not len(some):
            return none
        # the exact norm: equal triples of a word count together
        real = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64).reshape(len(words), n)[some]
        triple = (real[:, i] << 42) | (real[:, j] << 21) | real[:, k]
        order = np.argsort(triple, axis=1)
        triple, own = np.take_along_axis(triple, order, 1), weight[order]
        new = np.concatenate([np.ones((len(some), 1), bool), triple[:, 1:] != triple[:, :-1]], 1)
        start = np.flatnonzero(new.reshape(-1))
        sums = np.add.reduceat(own.reshape(-1), start)
        norm = np.sqrt(np.bincount(start // own.shape[1], sums * sums, len(some)))
        keep = np.isin(row, some)
        row, col = row[keep], col[keep]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        dots = np.add.reduceat(self.unit[ids[row, col] - 1] * weight[col, None].astype(np.float32), first, axis=0)
        k = np.minimum(dots / norm[:, None], 1.0)
        near = k[:, :self.marks].max(1) >= FAR
        return some[near], (k[near] ** SHARP).astype(np.float64)

    def features(self, words: list[str]) -> dict[str, np.ndarray]:
        """Sharpened kernels of the words that have any; a long word has the largest over its windows."""
        out: dict[str, np.ndarray] = {}
        by_len: dict[int, list[tuple[str, str]]] = {}
        for w in dict.fromkeys(words):
            parts = [w] if len(w) <= LONG else [w[i:i + LONG] for i in range(0, len(w) - LONG // 2, LONG // 2)]
            for x in parts:
                by_len.setdefault(len(x), []).append((x, w))
        for n, group in by_len.items():
            for lo in range(0, len(group) if n >= 3 else 0, 4096):
                part = group[lo:lo + 4096]
                for at, f in zip(*self._kernels([x for x, _ in part])):
                    w = part[at][1]
                    out[w] = np.maximum(out[w], f) if w in out else f
        return out

    def learn(self, written: set[str]) -> None:
        """Work out the scores of words, as written, that were not seen before."""
        if len(self.seen) > 400_000:
            self.seen.clear()
            self.hot.clear()
        seen = self.seen
        new = [(w, bare(w)) for w in written if w not in seen]
        found = {w: float(f @ self.weights) for w, f in self.features([p for _, p in new if p not in seen]).items()}
        for raw, w in new:
            if w not in seen:
                seen[w] = found.get(w, 0.0)
                if w in found:
                    self.hot.add(w)
            if raw != w:
                seen[raw] = seen[w]
                if w in self.hot:
                    self.hot.add(raw)

    def sentence_margins(self, sentences: list[list[str]]) -> list[float]:
        """Of sentences whose words have been learnt."""
        get, none = self.seen.__getitem__, self.hot.isdisjoint
        return [0.0 if none(s) else sum(map(get, s)) for s in sentences]


def pick_landmarks(labelled: DataFrame, odds: float = 1.0, limit: int = MAX_LANDMARKS) -> tuple[list[str], list[str]]:
    """Words that most mark toxic documents, and the nearest words that do not.

    Counts cover the training sample; ``limit`` bounds each kind.  ``odds``
    says how much oftener the sample takes a toxic document than a clean one.
    A mark is in toxic documents at least half of the time (the sample's odds
    taken out), and oftener than by chance: the Chernoff bound of its count,
    times the words counted, is at most CHANCE.  How frequent other marks are
    does not matter.
    """
    total = labelled.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not total[0] or not total[1] or total[1] == total[0]:
        return [], []
    share = total[1] / total[0]
    word = F.regexp_replace(F.col("w"), r"[^\p{L}\p{N}]+", "")
    words = labelled.select("toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"\s+"))).alias("w"))
    stats = words.groupBy("w").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n"))
    stats = stats.groupBy(word.alias("w")).agg(F.sum("a").alias("a"), F.sum("n").alias("n"))
    stats = staged(stats.filter((F.length("w").between(3, LONG)) & (F.col("n") >= MIN_DOCS)), "toxicity-words")
    lift = (F.col("a") - F.col("n") * share) / F.sqrt(F.col("n") * share + 1)
    part = F.col("a") / F.col("n")
    other = F.when(part < 1, (1 - part) * F.log((1 - part) / (1 - share))).otherwise(0.0)
    surprise = F.when(part > share, F.col("n") * (part * F.log(part / share) + other)).otherwise(0.0)
    least = float(np.log(max(stats.count(), 1) / CHANCE))
    pure = F.col("a") >= odds * (F.col("n") - F.col("a"))
    top = stats.withColumn("z", lift).filter(pure & (surprise >= least))
    marks = [r["w"] for r in top.orderBy(F.desc("z"), "w").limit(limit).collect()]

    if not marks:
        return [], []

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = WordScorer(marks, len(marks))
        for b in batches:
            words = b.column(0).to_pylist()
            found = scorer.features(words)
            k = [float(found[w].max()) if w in found else 0.0 for w in words]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(k, pa.float64())], ["w", "k"])

    others = stats.filter(~pure).select("w").mapInArrow(near, "w string, k double")
    others = others.filter("k > 0").orderBy(F.desc("k"), "w").limit(limit).collect()
    return marks, [r["w"] for r in others if r["w"] not in marks]


def _sentence_rows(labelled: DataFrame, landmarks: list[str], marks: int) -> DataFrame:
    """Sentences with a feature: doc, toxic, f (summed kernels)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = WordScorer(landmarks, marks)
        for b in batches:
            docs, toxic, f = [], [], []
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = [[[bare(w) for w in words_of(s)] for s in sentences_of(t)] for t in part.column(1).to_pylist()]
                found = scorer.features([w for t in texts for s in t for w in s])
                for doc, t, sents in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), texts):
                    for s in sents:
                        known = [found[w] for w in s if w in found]
                        if known:
                            docs.append(doc)
                            toxic.append(t)
                            f.append(np.sum(known, axis=0).astype(np.float32))
            if f:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.string()), pa.array(toxic, pa.int32()),
                     pa.array(f, pa.list_(pa.float32()))], ["doc", "toxic", "f"])

    return labelled.select(F.col("doc_id").cast("string").alias("doc"), "text", "toxic").mapInArrow(
        run, "doc string, toxic int, f array<float>")


def training_matrix(f: pa.ChunkedArray, nystrom: np.ndarray) -> np.ndarray:
    """Mapped features of the sentences ``f`` (equal lists), a row of zeros, and a column of ones.

    Filled a block at a time: the driver holds the matrix once.
    """
    x = np.zeros((len(f) + 1, nystrom.shape[1] + 1))
    x[:, -1] = 1
    for lo in range(0, len(f), BLOCK):
        part = f.slice(lo, BLOCK).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        x[lo:min(lo + BLOCK, len(f)), :-1] = part.reshape(-1, nystrom.shape[0]).astype(np.float64) @ nystrom
    return x


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 50.0, rounds: int = 50) -> np.ndarray:
    """Weights of an L2-regularised squared-hinge machine (Newton steps over its support vectors); classes weigh alike."""
    cost = np.where(y > 0, 1 / max((y > 0).sum(), 1), 1 / max((y < 0).sum(), 1)) * c
    w, inside = np.zeros(x.shape[1]), np.ones(len(y), bool)
    for _ in range(rounds):
        square, right = np.zeros((len(w), len(w))), np.zeros(len(w))
        for lo in range(0, len(y), BLOCK):  # a copy of a block, not of the whole matrix
            use = lo + np.flatnonzero(inside[lo:lo + BLOCK])
            rows = x[use]
            part = rows * cost[use, None]
            square += part.T @ rows
            right += part.T @ y[use]
        new = np.linalg.solve(square + np.eye(len(w)) * 0.01, right)
        w = new if inside.all() else 0.5 * (w + new)
        now = y * (x @ w) < 1
        if (now == inside).all() and np.abs(new - w).max() < 1e-6:
            break
        inside = now
    return w


def evidence(margin: np.ndarray, total: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What a document's score is calibrated on: its worst sentence, and what all sentences add up to, per word too."""
    return np.stack([margin, np.log1p(total), np.log1p(100 * total / (words + 10)), np.ones_like(margin)], 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights of a ridge logistic regression (Newton steps); the last column is not penalised."""
    w, pen = np.zeros(x.shape[1]), np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pen), x.T @ (p - y) + pen * w)
        step /= max(1.0, np.abs(step).max() / 4)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _taught(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float, float]:
    """(training documents, share of toxic labels, how much oftener a toxic document is taken than a clean one).

    Ids are chosen by hash among the labelled ones, at most ``MAX_DOCUMENTS``
    of each label, before any text is touched; the chosen ids go to the texts,
    not the texts to the ids.  An id that repeats counts once.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    ids = None
    for t, limit in MAX_DOCUMENTS.items():
        some = known.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id").limit(limit)
        ids = some if ids is None else ids.unionByName(some)
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(ids), "doc_id")
    one = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    rate = {t: min(1.0, limit / max(n.get(t, 0), 1)) for t, limit in MAX_DOCUMENTS.items()}
    return staged(one, "toxicity-labelled"), n.get(1, 0) / max(sum(n.values()), 1), rate[1] / rate[0]


def train(docs: DataFrame, labels: DataFrame, rounds: int = 3) -> Model:
    """Fit on labelled rows whose crc32(doc_id as text) mod 4 is not 2.

    At most ``MAX_DOCUMENTS`` of them are read, by label; the machine is
    fitted on at most ``MAX_SENTENCES`` sentences of each label and calibrated
    on at most ``MAX_CALIBRATION`` documents, chosen by hash; the calibration
    takes out that one label was sampled more than the other.  A toxic
    document need not be toxic in every sentence: after each round only its
    most toxic one, and those beyond the margin, stay positive.  Without two
    classes the score of every document is the share of toxic labels (0
    without labels).
    """
    labelled, base, odds = _taught(docs, labels)
    marks, others = pick_landmarks(labelled, odds)
    landmarks = marks + others
    if not marks:
        return Model([], 0, np.zeros((0, 0)), np.zeros(0), 0.0, np.zeros(4), base)
    sents = staged(_sentence_rows(labelled, landmarks, len(marks)).withColumn("o", F.xxhash64("doc", "f")), "toxicity-sentences")
    picked = [sents.filter(F.col("toxic") == t).orderBy("o", "doc").limit(MAX_SENTENCES) for t in (1, 0)]
    # bounded by MAX_SENTENCES rows of each label
    some = picked[0].unionByName(picked[1]).select("doc", "toxic", "f").toArrow()
    unit = WordScorer(landmarks, len(marks)).unit.astype(np.float64)
    k = np.clip(unit.T @ unit, 0, 1) ** SHARP
    value, vector = np.linalg.eigh(k)
    use = value > 1e-6 * value.max()
    nystrom = vector[:, use] / np.sqrt(value[use])
    toxic, doc = some["toxic"].to_numpy(), some["doc"].to_pylist()
    # sentences without any feature are clean; one row stands for them
    x = training_matrix(some["f"], nystrom)
    del some
    y = np.r_[np.where(toxic == 1, 1, -1), -1]
    w = linear_svm(x, y)
    for _ in range(rounds):
        m = x[:-1] @ w
        best: dict = {}
        for i in np.flatnonzero(toxic == 1):
            if doc[i] not in best or m[i] > m[best[doc[i]]]:
                best[doc[i]] = i
        now = np.where(toxic == 1, np.where(m >= 0, 1, -1), -1)
        now[list(best.values())] = 1
        if (now == y[:-1]).all():
            break
        y = np.r_[now, -1]
        w = linear_svm(x, y)
    model = Model(landmarks, len(marks), nystrom, w[:-1], float(w[-1]), np.zeros(4), base)
    del x
    got = margins(_sample(labelled, MAX_CALIBRATION), model, ("toxic",)).toArrow()  # MAX_CALIBRATION rows of four numbers
    known = evidence(*(got[c].to_numpy() for c in ("margin", "total", "words")))
    model.curve = logistic(known, got["toxic"].to_numpy().astype(float))
    model.curve[-1] -= np.log(odds)
    return model


def _sample(rows: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` documents of ``rows``, by a hash of the id; their texts stay in their partitions."""
    ids = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id").limit(limit)
    return rows.join(ids, "doc_id", "left_semi")


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


#: The scorer of the last model that this Python worker met, with the words it has learnt: tasks share it.
_KEPT: dict[str, WordScorer] = {}


def _scorer(name: str, model: Model) -> WordScorer:
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = WordScorer(model.landmarks, model.marks, model.word_weights())
    return _KEPT[name]


def margins(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and margin, total, words of each whole text.

    ``margin`` is the largest sentence margin (without sentences the bias),
    ``total`` the sum of what lifts sentences above the bias.
    """
    cols = [*keep, *(["text"] if "text" not in keep else [])]
    name = model.name()
    at, kinds = cols.index("text"), ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(name, model)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part, out = b.slice(lo, 512), []
                texts = [[words_of(s) for s in sentences_of(t)] for t in part.column(at).to_pylist()]
                scorer.learn({w for t in texts for s in t for w in s})
                for t in texts:
                    m = scorer.sentence_margins(t)
                    out.append((model.bias + max(m, default=0.0), sum(x for x in m if x > 0), float(sum(map(len, t)))))
                cols = [pa.array(c, pa.float64()) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], *cols], [*keep, "margin", "total", "words"])

    return docs.select(*cols).mapInArrow(run, f"{kinds}, margin double, total double, words double")


def scored(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and score (0 to 1) of each whole text."""
    if not model.landmarks:
        return docs.select(*keep, F.lit(float(model.base)).alias("score"))
    a, b, c, d = (float(x) for x in model.curve)
    z = a * F.col("margin") + b * F.log1p("total") + c * F.log1p(100 * F.col("total") / (F.col("words") + 10)) + d
    p = 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), z))))
    return margins(docs, model, keep).select(*keep, p.alias("score"))


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted.

    NULL and empty texts are scored like texts without any known word.
    Repeated rows give repeated rows.  A NULL doc_id is not held out.
    """
    return scored(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                      (F.col("score") >= threshold).cast("int").alias("predicted"))
