"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel of two words counts their common subsequences of three letters, each weighted by
``DECAY`` to the length it spans, so that gaps and inserted characters cost little.  Landmark
words span the Nyström approximation of its space, in which a linear machine is trained.  A
sentence is as toxic as its most toxic word: sentences of non-toxic texts are negative, and the
strongest of a toxic text positive, by its strongest words, chosen anew with each round.

Because the kernel is a product of subsequence weights, the trained machine folds into one
number per subsequence, and a word is scored without meeting the landmarks again.  Words are
scored once per task.

The machine learns from a bounded number of labelled texts; ids, languages and sources are no
inputs.  Defined results: a null, empty or wordless text has the score of no evidence, below
0.5; without labelled texts of both classes every score is 0; repeated rows score alike; a row
with a null id counts as the id ''.
"""

import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import shared
from basketry.llm import words

shared.ship(__name__)

#: Labelled texts of each class that training reads, the first by a hash of their id.
MAX_TOXIC, MAX_CLEAN = 1_500, 2_500
#: Words of clean texts that training holds against the toxic ones, the most frequent.
MAX_CLEAN_WORDS = 60_000
TOXIC_LANDMARKS, CLEAN_LANDMARKS = 48, 24
ROUNDS = 3
#: Words of a toxic text that are taken for its evidence in a round.
STRONGEST = 3
#: Most frequent evidence of which altered copies are learned too.
VARIED = 40
DECAY = 0.6
#: Letters of a word that are compared; longer words are cut into overlapping pieces.
PIECE = 16
CACHE_WORDS = 300_000
_LETTERS = 40
_TRIPLES = _LETTERS**3

_SPACED = re.compile(r"(?<!\S)\S(?:\s\S(?!\S)){2,}")
_JUNK = re.compile(r"[\W_]+")


def clean(word: str) -> str:
    """A word without what isn't a letter or a digit."""
    return word if word.isalnum() else _JUNK.sub("", word)


def sentence_words(text: str) -> list[str]:
    """Lower-case words; letters that stand alone in a row make one word."""
    text = text.lower()
    if _SPACED.search(text):
        text = _SPACED.sub(lambda m: "".join(m[0].split()), text)
    return text.split()


def pieces(word: str) -> list[str]:
    word = clean(word)
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in range(0, len(word) - PIECE // 2, PIECE // 2)]


def _codes(some: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Subsequence numbers of words of one length, and the weights by their span."""
    points = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32).reshape(-1, size).astype(np.int64)
    letter = np.where((points >= 97) & (points < 123), points - 97, 26 + points % (_LETTERS - 26))
    i, j, k = np.array(list(combinations(range(size), 3))).T
    codes = (letter[:, i] * _LETTERS + letter[:, j]) * _LETTERS + letter[:, k]
    return codes, DECAY ** (k - i - 2.0)


def _norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Square roots of the kernels of words with themselves."""
    order = np.argsort(codes, axis=1, kind="stable")
    by_code, weight = np.take_along_axis(codes, order, 1), weights[order]
    new = np.ones(codes.shape, bool)
    new[:, 1:] = by_code[:, 1:] != by_code[:, :-1]
    starts = np.flatnonzero(new)
    sums = np.add.reduceat(weight.ravel(), starts)
    rows = starts // codes.shape[1]
    return np.sqrt(np.bincount(rows, sums**2, len(codes)))


def by_length(parts: list[str]):
    """(places, codes, weights) of words of three letters or more, in bounded blocks."""
    sizes = np.array([len(p) for p in parts])
    for size in range(3, PIECE + 1):
        members = np.flatnonzero(sizes == size)
        for start in range(0, len(members), step := max(1, 1_000_000 // (size**3 // 6 + 1))):
            at = members[start : start + step]
            yield at, *_codes([parts[i] for i in at.tolist()], size)


def features(parts: list[str]) -> np.ndarray:
    """Unit vectors of subsequence weights, one dense row per word: only for landmarks."""
    out = np.zeros((len(parts), _TRIPLES), np.float32)
    for at, codes, weights in by_length(parts):
        np.add.at(out, (at[:, None], codes), weights)
    norms = np.sqrt(np.einsum("ij,ij->i", out, out))
    out /= np.where(norms > 0, norms, 1)[:, None].astype(np.float32)
    return out


def products(parts: list[str], table: np.ndarray) -> np.ndarray:
    """Product of each word's unit vector with the columns of ``table`` (subsequences × any)."""
    out = np.zeros((len(parts), table.shape[1]), np.float32)
    for at, codes, weights in by_length(parts):
        norms = _norms(codes, weights)
        for c in range(table.shape[1]):
            out[at, c] = (table[codes, c] * weights).sum(1) / norms
    return out


class Model:
    """Weight of every subsequence, the bias, and the slope and offset that give probabilities."""

    def __init__(self, table: np.ndarray, bias: float, slope: float = 1.0, offset: float = 0.0):
        self.table, self.bias, self.slope, self.offset = table, bias, slope, offset

    def margins(self, some: list[str]) -> np.ndarray:
        parts, owner = [], []
        for n, word in enumerate(some):
            own = pieces(word)
            parts += own
            owner += [n] * len(own)
        out = np.full(len(some), self.bias, np.float64)
        if parts:
            np.maximum.at(out, owner, products(parts, self.table[:, None])[:, 0] + self.bias)
        return out

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -50, 50)))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 1.0) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3

    def loss(w):
        return w @ ridge @ w / 2 + cost * (weight * np.maximum(1 - y * (x @ w), 0) ** 2).sum()

    for _ in range(30):
        inside = np.flatnonzero(1 - y * (x @ w) > 0)
        own, scale = x[inside], 2 * cost * weight[inside]
        slope = ridge @ w - own.T @ (scale * (y[inside] - own @ w))
        step = np.linalg.solve(ridge + own.T @ (own * scale[:, None]), slope)
        size, now = 1.0, loss(w)
        while loss(w - size * step) > now and size > 1e-4:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of label 1, targets drawn in as in Platt's method."""
    ones, zeros = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        slope = x.T @ (p - target) + 1e-3 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def _spread(ranked: list[str], count: int) -> list[str]:
    """The first ``count`` words that aren't almost the same as an earlier one."""
    chosen: list[str] = []
    ranked = ranked[: 4 * count]
    vectors = features(ranked)
    for i in range(len(ranked)):
        if vectors[i].any() and all(vectors[i] @ vectors[j] < 0.95 for j in chosen) and len(chosen) < count:
            chosen.append(i)
    return [ranked[i] for i in chosen]


def inserted(word: str) -> list[str]:
    """The word with a foreign letter, and with a letter twice, inside."""
    if not 4 <= len(word) < PIECE:
        return []
    return [word[:i] + c + word[i:] for i in range(1, len(word)) for c in ("x", word[i])]


def train(toxic: list[str], harmless: list[str]) -> Model | None:
    """A model from labelled texts; None if one of the classes is empty."""
    if not toxic or not harmless:
        return None
    def parts_of(text: str) -> list[str]:
        return sorted({p for w in set(sentence_words(text)) for p in pieces(w) if len(p) > 2})

    bags, others = [parts_of(t) for t in toxic], [parts_of(t) for t in harmless]
    in_toxic, in_clean = Counter(w for b in bags for w in b), Counter(w for b in others for w in b)

    def odds(word: str) -> float:
        """Lower bound of the log odds that a text with the word is toxic."""
        t = (in_toxic[word] + 0.5) / (len(bags) + 1)
        c = (in_clean[word] + 0.5) / (len(others) + 1)
        return np.log(t / c) - 3 * np.sqrt(1 / (in_toxic[word] + 0.5) + 1 / (in_clean[word] + 0.5))

    signal = {w: o for w in in_toxic if (o := odds(w)) > 0}
    ranked = sorted(signal, key=lambda w: (-in_toxic[w] * signal[w], w))
    usual = sorted(in_clean, key=lambda w: (-in_clean[w], w))
    landmarks = _spread(ranked, TOXIC_LANDMARKS) + _spread(usual, CLEAN_LANDMARKS)
    if not landmarks:
        return None
    vectors = features(landmarks)
    values, axes = np.linalg.eigh(vectors @ vectors.T)
    keep = values > 1e-4
    # Columns of ``basis`` give a word's coordinates from its kernels with the landmarks.
    basis = (axes[:, keep] / np.sqrt(values[keep])).astype(np.float32)
    kernels = np.ascontiguousarray(vectors.T)
    # Evidence is a word of several toxic texts that clean ones use hardly or not at all.
    evidence = sorted(w for w, n in in_toxic.items() if w in signal or (n > 1 and not in_clean[w]))
    place = {w: i for i, w in enumerate(evidence)}
    coordinates = products(evidence, kernels) @ basis
    against = usual[:MAX_CLEAN_WORDS]
    negative = products(against, kernels) @ basis
    weight_against = np.array([in_clean[w] for w in against]) ** 0.5
    own = [np.array([place[w] for w in b if w in place], np.int64) for b in bags]
    # Copies of the best words with a letter put in between teach the machine to bear that.
    altered = sorted({v for w in ranked[:VARIED] for v in inserted(w)} - in_clean.keys())
    variants = products(altered, kernels) @ basis
    # At first a word counts by how many toxic texts it explains.
    margins = np.array([in_toxic[w] * signal.get(w, 0.0) for w in evidence])
    weights, bias = np.zeros(basis.shape[1]), 0.0
    for _ in range(ROUNDS):
        # The strongest words of each toxic text; texts without evidence don't take part.
        strongest = np.concatenate([b[np.argsort(-margins[b], kind="stable")[:STRONGEST]] for b in own])
        strongest = strongest[margins[strongest] > 0]
        if not len(strongest):
            break
        x = np.concatenate([coordinates[strongest], variants, negative])
        ones = len(strongest) + len(variants)
        y = np.concatenate([np.ones(ones), -np.ones(len(negative))])
        weights, bias = _svm(x, y, np.concatenate([np.ones(ones), weight_against]))
        margins = coordinates @ weights + bias
    model = Model((kernels @ (basis @ weights)).astype(np.float32), bias)
    known: dict[str, float] = {}

    def strongest_of(group):
        for b in group:
            if new := [w for w in b if w not in known]:
                known.update(zip(new, model.margins(new).tolist(), strict=True))
        return np.array([max((known[w] for w in b), default=bias) for b in group])

    both = np.concatenate([strongest_of(bags), strongest_of(others)])
    labels = np.concatenate([np.ones(len(bags)), np.zeros(len(others))])
    model.slope, model.offset = _logistic(both, labels)
    return model


def fold(id_col: str = "doc_id", folds: int = 5) -> F.Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def learn(
    docs: DataFrame, labels: DataFrame, most_toxic: int = MAX_TOXIC, most_clean: int = MAX_CLEAN
) -> Model | None:
    """Train on labelled ``docs`` outside fold 0, at most so many of each class."""
    labelled = labels.select("doc_id", "toxic").where(F.col("toxic").isin(0, 1) & (fold() != 0))
    chosen = [
        labelled.where(F.col("toxic") == value)
        .dropDuplicates(["doc_id"])
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
        for value, most in ((1, most_toxic), (0, most_clean))
    ]
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    rows = picked.where("text IS NOT NULL").select("text", "toxic").distinct().collect()
    texts = sorted((r["toxic"], r["text"]) for r in rows)
    return train([t for y, t in texts if y == 1], [t for y, t in texts if y == 0])


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``doc_id, score, strongest`` of every row: the probability, and the word it rests on."""
    own = words.picked(docs, id_col, text_col, carry)
    sent = shared.send(docs.sparkSession, model)

    def run(batches):
        model = shared.received(sent)
        known: dict[str, float] = {}
        for batch in batches:
            for start, end in words.text_slices(words.binary(batch.column(1))):
                texts = batch.column(1).slice(start, end - start).to_pylist()
                each = [set(sentence_words(t)) if t and model else set() for t in texts]
                if len(known) > CACHE_WORDS:
                    known = {}
                new = sorted(set().union(*each).difference(known))
                if new:
                    known.update(zip(new, model.margins(new).tolist(), strict=True))
                margin, strongest = [], []
                for own_words in each:
                    top = max(map(known.__getitem__, own_words)) if own_words else None
                    margin.append(top if own_words else model.bias if model else -np.inf)
                    strongest.append(min(w for w in own_words if known[w] == top) if own_words else None)
                chance = model.probability(np.array(margin)) if model else np.zeros(len(texts))
                made = {
                    "score": pa.array(chance, pa.float64()),
                    "strongest": pa.array(strongest, pa.string()),
                }
                yield words.result(batch, start, end, made)

    kind = words.kind_of(own, "doc_id")
    return own.mapInArrow(run, f"doc_id {kind}, score double, strongest string{words.carried(own)}")
