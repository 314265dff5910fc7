"""Toxicity by a support vector machine on a gap-weighted subsequence kernel with Nyström landmarks.

A word is the bag of its three-letter subsequences that span five letters at most, each weighted by
DECAY^span, with marks for the word's ends. The normalised kernel of two words is the cosine of their bags, so
gaps, inserted characters and unknown endings cost a little and not everything. Landmarks are words of
labelled sentences; the machine works on the Nyström map K(x, L) K(L, L)^-1/2 and is trained by multiple
instances: a toxic sentence or document has at least one toxic word, a clean one has none. As the kernel is an
inner product of bags, landmarks and weights fold into one vector, and a word costs one pass over its bag.
The words that make a text toxic are also trained on with a foreign sign at each inner place.

A document's score is that of its worst word, made a probability on the training rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

BITS = 17
DECAY = 0.7
#: Counts that a feature is taken to have had before, so that rare ones say little.
PRIOR = 0.3
#: Shares of clean texts whose worst word is below a text's worst word, and below any word, that is a witness.
WITNESS = (0.7, 0.99)
#: Weight of all changed spellings of a witness in training, and of all of them beside the toxic texts in the probability.
CHANGED_TIMES, CHANGED_SHARE = 3.0, 0.3
#: Distances between the three letters: all with a span of five letters at most.
GAPS = [(1, 1), (1, 2), (2, 1), (1, 3), (3, 1), (2, 2)]
EDGE = re.compile(r"^[^\w]+|[^\w]+$")
#: Three or more single characters with single separators: a word spelt out.
SPELT = re.compile(r"(?<!\w)\w(?:[ .\-_*]\w){2,}(?!\w)")


def bags(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, feature, weight) triples of all words, summed per word and feature."""
    text = "".join(f"\x02{w}\x03" for w in words)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words), dtype=np.int64), [len(w) + 2 for w in words])
    keys, weights = [], []
    for d, e in GAPS:
        n = len(code) - d - e
        if n <= 0:
            continue
        same = owner[:n] == owner[d + e :]
        x = (code[:n] * np.uint64(0x9E3779B97F4A7C15) + code[d : n + d]) * np.uint64(0xC2B2AE3D27D4EB4F) + code[d + e :]
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)
        keys.append((owner[:n] << BITS | x.astype(np.int64))[same])
        weights.append(np.full(int(same.sum()), DECAY ** (d + e + 1)))
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    weight = np.add.reduceat(weight, first) if len(first) else weight
    key = key[first]
    return key >> BITS, key & ((1 << BITS) - 1), weight


def norms(owner: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    return np.sqrt(np.maximum(np.bincount(owner, weight**2, minlength=n), 1e-12))


def project(words: list[str], vector: np.ndarray, chunk: int = 20_000) -> np.ndarray:
    """<bag, vector> / |bag| for every word."""
    out = [np.empty(0)]
    for at in range(0, len(words), chunk):
        part = words[at : at + chunk]
        owner, feature, weight = bags(part)
        out.append(np.bincount(owner, weight * vector[feature], minlength=len(part)) / norms(owner, weight, len(part)))
    return np.concatenate(out)


def core(word: str) -> str:
    return EDGE.sub("", word)


def words_of(text: str | None) -> list[str]:
    """Chunks of a whole text in lower case, and what single spelt-out characters make together."""
    if not text:
        return []
    text = text.lower()
    found = text.split()
    if SPELT.search(text):
        found += [re.sub(r"[ .\-_*]", "", m) for m in SPELT.findall(text)]
    return found


#: Signs and letters that get into insults.
INSERTED = "abcdefghijklmnopqrstuvwxyz-_.*"


def spellings(word: str) -> list[str]:
    """The word with one foreign sign at each inner place, the same ones every time."""
    drawn = np.random.default_rng(list(word.encode("utf-8", "replace"))).integers(0, len(INSERTED), len(word))
    return [word[:i] + INSERTED[drawn[i]] + word[i:] for i in range(1, len(word))]


def newton_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, turns: int = 20) -> np.ndarray:
    """Primal Newton steps for the squared hinge; the last column of ``x`` is the bias."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    was = None
    for _ in range(turns):
        active = y * (x @ w) < 1
        if was is not None and (active == was).all():
            break
        was = active
        a = x[active] * cost[active, None]
        w = np.linalg.solve(ridge + a.T @ x[active], a.T @ y[active])
    return w


def logistic(score: np.ndarray, y: np.ndarray, times: np.ndarray) -> tuple[float, float]:
    """Slope and place of P(y = 1) of weighted rows, with targets drawn in a little so that clean splits stay finite."""
    pos, neg = times[y == 1].sum(), times[y == 0].sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.column_stack([score, np.ones(len(score))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (times * p * (1 - p))[:, None]) + 1e-6 * np.eye(2), x.T @ (times * (target - p)))
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


@dataclass
class Model:
    vector: np.ndarray
    bias: float
    slope: float
    place: float

    def raw(self, words: list[str]) -> np.ndarray:
        return project(words, self.vector) + self.bias

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.place, -500, 500)))


def train(texts: list[str | None], toxic: list[int], landmarks: int = 200, rounds: int = 3, often: float = 0.05) -> Model | None:
    """A model from labelled texts; None without both kinds. Words of a share ``often`` of toxic texts and of no
    clean one are witnesses too."""
    once = dict(zip(texts, toxic, strict=True))  # copies would count as evidence
    texts, toxic = list(once), list(once.values())
    y = np.array(toxic)
    if not (y == 1).any() or not (y == 0).any():
        return None
    docs = [sorted({c for w in words_of(t) if len(c := core(w)) > 1}) for t in texts]
    names = sorted({w for d in docs for w in d})
    if not names:
        return None
    index = {w: i for i, w in enumerate(names)}
    docs_at = [np.array([index[w] for w in d], np.int64) for d in docs]
    # first guess: how much oftener a word's features stand in toxic texts
    uses = [Counter(), Counter()]
    for d, label in zip(docs, toxic, strict=True):
        uses[label].update(d)
    count = np.zeros((2, 1 << BITS))
    for at in range(0, len(names), 20_000):
        part = names[at : at + 20_000]
        owner, feature, weight = bags(part)
        for label in (0, 1):
            n = np.array([uses[label][w] for w in part], float)
            count[label] += np.bincount(feature, weight * n[owner], minlength=1 << BITS)
    expected = count.sum(0) * count[1].sum() / max(1e-9, count.sum())
    score = project(names, np.log((count[1] + PRIOR) / (expected + PRIOR)))
    positive = [d for d, label in zip(docs_at, toxic, strict=True) if label == 1 and len(d)]
    negative = [d for d, label in zip(docs_at, toxic, strict=True) if label == 0 and len(d)]
    frequent = np.array([uses[1][w] >= max(30, often * len(positive)) and not uses[0][w] for w in names])
    vector, bias = None, 0.0
    for turn in range(rounds):
        # witnesses: words of toxic texts that are worse than the worst word of nearly all clean texts, and a
        # text's worst word if it is worse than that of most; a toxic text without such a word has none
        likely, sure = np.quantile([score[d].max() for d in negative], WITNESS) if negative else (-np.inf, -np.inf)
        bad = Counter()
        for d in positive:
            s = score[d]
            bad.update(d[(s > sure) | ((s == s.max()) & (s > likely)) | frequent[d]].tolist())
        # the hardest words of each clean text, and words drawn from all
        good = Counter()
        for d in negative:
            good.update(d[np.argsort(-score[d], kind="stable")[:5]].tolist())
            good.update(d[:: max(1, len(d) // 10)].tolist())
        for w in list(bad):
            if uses[0][names[w]] >= uses[1][names[w]]:
                del bad[w]
        if not bad or not good:
            return None
        used = sorted(bad) + sorted(w for w in good if w not in bad)
        label = np.array([1.0] * len(bad) + [-1.0] * (len(used) - len(bad)))
        times = np.array([min(20, bad[w] if k > 0 else good[w]) for w, k in zip(used, label, strict=True)], float)
        # what a witness looks like with a sign inserted
        changed = [(v, CHANGED_TIMES * times[i] / (len(names[w]) - 1)) for i, w in enumerate(used[: len(bad)]) for v in spellings(names[w]) if v not in index]
        examples = [names[w] for w in used] + [v for v, _ in changed]
        label, times = np.r_[label, np.ones(len(changed))], np.r_[times, [t for _, t in changed]]
        # landmarks: the commonest toxic words, the hardest and some common clean ones
        marks = [w for w, _ in sorted(bad.items(), key=lambda x: (-x[1], x[0]))[: landmarks // 2]]
        clean = sorted((w for w in good if w not in bad), key=lambda w: (-score[w], w))
        marks += clean[: landmarks // 4] + sorted(clean[landmarks // 4 :], key=lambda w: (-good[w], w))[: landmarks // 4]
        dense = np.zeros((len(marks), 1 << BITS), np.float32)
        owner, feature, weight = bags([names[w] for w in marks])
        dense[owner, feature] = weight / norms(owner, weight, len(marks))[owner]
        inner = (dense @ dense.T).astype(float)
        values, vectors = np.linalg.eigh(inner)
        keep = values > 1e-6
        root = vectors[:, keep] / np.sqrt(values[keep])  # K(L, L)^-1/2 on its range
        x = []
        for at in range(0, len(examples), 5_000):
            part = examples[at : at + 5_000]
            owner, feature, weight = bags(part)
            weight = weight / norms(owner, weight, len(part))[owner]
            order = np.searchsorted(owner, np.arange(len(part) + 1))
            x.append(np.array([weight[a:b] @ dense[:, feature[a:b]].T if b > a else np.zeros(len(marks)) for a, b in zip(order[:-1], order[1:], strict=True)]))
        x = np.concatenate(x) @ root
        x = np.column_stack([x, np.ones(len(x))])
        cost = times * np.where(label > 0, 4.0 / max(1.0, times[label > 0].sum()), 4.0 / max(1.0, times[label < 0].sum())) * len(examples) / 2
        w = newton_svm(x, label, cost)
        vector, bias = (dense.T @ (root @ w[:-1])).astype(float), float(w[-1])
        del dense
        score = project(names, vector) + bias
    raw = np.array([score[d].max() if len(d) else score.min() for d in docs_at])
    # a changed spelling of a witness is like a toxic text whose worst word it is
    raw = np.r_[raw, project([v for v, _ in changed], vector) + bias]
    share = CHANGED_SHARE * (y == 1).sum() / max(1, len(changed))
    slope, place = logistic(raw, np.r_[y, np.ones(len(changed))], np.r_[np.ones(len(y)), np.full(len(changed), share)])
    return Model(vector, bias, slope, place)


class Scores(dict):
    """Scores of words seen in a worker; starts anew at ``limit``."""

    def __init__(self, model: Model, limit: int = 800_000):
        self.model, self.limit = model, limit

    def learn(self, words: Iterable[str]) -> None:
        if len(self) > self.limit:
            self.clear()
        new = sorted({w for w in words if w not in self})
        cores = [core(w) for w in new]
        raw = self.model.raw(cores)
        self.update((w, s if len(c) > 1 else -np.inf) for w, c, s in zip(new, cores, raw.tolist(), strict=True))


def toxicity(docs: DataFrame, labels: DataFrame, most_toxic: int = 600, most_clean: int = 1200, most_chars: int = 50_000, threshold: float = 0.7, seed: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted, worst for every row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, toxic 0 or 1): at most ``most_toxic`` and ``most_clean`` labelled rows of the smallest
    hashes, of texts up to ``most_chars`` characters, train the model; held-out rows never do. Texts without
    words, null included, get the score of the least toxic text, as they hold no word to hold against them;
    without labels of both kinds every score is 0. ``worst`` is the word that decided, null without words.
    Rows that share a doc_id are scored each by itself.
    """
    held = (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3) == 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").distinct()
    mine = known.where(~held).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "toxic")
    few = mine.where("toxic = 1").limit(most_toxic).union(mine.where("toxic = 0").limit(most_clean))
    sample = rows.where(f"char_length(text) <= {most_chars} and not held_out").join(F.broadcast(few), "doc_id")
    # an upper bound too for rows that share a doc_id
    got = sample.orderBy(F.xxhash64("doc_id", "text", F.lit(seed)), "doc_id").limit(most_toxic + most_clean).select("text", "toxic").collect()
    model = train([r["text"] for r in got], [r["toxic"] for r in got])

    names = ["doc_id", "held_out", "score", "predicted", "worst"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words = Scores(model) if model else None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [words_of(t.as_py()) for t in part.column("text")]
                raw, worst = np.full(len(texts), -np.inf), [None] * len(texts)
                if known_words is not None:
                    known_words.learn(w for t in texts for w in t)
                    for i, words in enumerate(texts):
                        if words:
                            top = max(words, key=known_words.__getitem__)
                            raw[i], worst[i] = known_words[top], top
                value = model.probability(raw) if model else np.zeros(len(texts))
                yield pa.record_batch(
                    [part.column("doc_id"), part.column("held_out"), pa.array(value), pa.array((value >= threshold).astype(np.int32)), pa.array(worst, pa.string())], names=names
                )

    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int, worst string")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, trained on labels.toxic."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
