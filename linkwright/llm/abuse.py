"""Abusive, hateful or sexual content.

A subword-bag classifier: every sentence is the mean of the embeddings of its character n-grams (hashed, so unseen and
misspelt words share vectors with those seen) under a linear softmax; both are trained jointly in numpy. Labels exist
per document only, so training alternates between fitting sentences and choosing, in each flagged document, the
sentences that carry its label. A document's score is that of its worst sentence.

Sentences run on over line and cue breaks, so a line split over two cues is one sentence. Before hashing, texts are
brought to one form: wrong encodings repaired, look-alike letters, accents and case folded, letters spaced or dotted
apart joined, stretched letters shortened, digits inside words read as letters.

The training sample is bounded: at most ``most_flagged`` flagged and ``most_clean`` clean documents, taken in hash
order of their ids while their texts stay within ``most_letters``, go to the driver; every distinct sentence of theirs is learnt. Scoring covers every document and every sentence; the model sent to the tasks
has a fixed size.

Defined results: null and empty texts score 0; without a flagged or without a clean label every score is 0; documents
with several reviews count as flagged when more reviews say so than not.
"""

from __future__ import annotations

import codecs
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkwright.llm.confusables import LOOKALIKES, mapping

CLASSES = ("none", "abuse", "hate", "sexual")
#: n-gram sizes, hash buckets (a power of two), embedding width.
SIZES, BUCKETS, WIDTH = (3, 4, 5, 6), 1 << 17, 16
MOST_FLAGGED, MOST_CLEAN = 1_000, 6_000
#: Letters of the flagged, and of the clean texts of the sample, in all.
MOST_LETTERS = 40_000_000
#: Folds of the documents, rounds of judging, and how often clean sentences taken for harmful are learnt again.
FOLDS, TURNS, MENDS = 3, 2, 3
#: Sentences scored at once.
CHUNK = 20_000
#: Score from which a document is harmful; models are shifted so that this is their best threshold.
THRESHOLD = 0.5

# Format codes of subtitle files; other text in braces or brackets is read like any other.
_TAGS = re.compile(r"<[^>\n]*>|\{(?:\\[^}\n]*|[A-Za-z]:[^}\n]*|\d*)\}")
# each pattern begins with a set of characters, so that the scan stops at these alone; a dash counts after a line break
_SPLIT = re.compile(
    r"[!?।॥:;¡¿♪♫.\[\]{}\n](?:(?<=[!?।॥:;¡¿♪♫])[!?।॥:;¡¿♪♫]*(?!\w)|(?<=\.)(?<!\.\.)(?=[\s\"”»]|$)|(?<=[\[\]{}])|(?<=\n)[ \t]*[-–—](?=[ \t]))", re.M
)
# what any text with letters set apart holds
_ALONE = re.compile(r"[ .*_\-·]\w[ .*_\-·]")
_APART = re.compile(r"(?<!\w)(?:\w[ .*_\-·]{1,2}){2,}\w(?!\w)")
_DOTS = re.compile(r"\.{2,}|…")
_STRETCH = re.compile(r"([^\W\d_])\1{2,}")
_LEET = re.compile(r"[0134578@$!](?<=[^\W\d_].)(?:(?=[^\W\d_])|(?<!!)\b)")
_SPACES = re.compile(r"[\s|*_\-,.!?¡¿\"“”«»()]+")
_MOJIBAKE = re.compile(r"[ÂÃâàå][\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ¡-¿]")
_DIGIT_LETTERS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
_TABLE: dict[int, str] = {}


def _table() -> dict[int, str]:
    if not _TABLE:
        _TABLE.update({ord(c): "".join(x for x in t if not 0x300 <= ord(x) < 0x370) for c, t, _, _ in mapping() if c != "\n"})
        _TABLE.update({ord(c): latin for c, latin in LOOKALIKES.items()})
        _TABLE.update({c: "" for c in range(0x300, 0x370)})
        _TABLE.pop(10, None)
    return _TABLE


def _outside(error: UnicodeError) -> tuple[bytes, int]:
    """Bytes of characters that cp1252 lacks."""
    chars = error.object[error.start : error.end]
    return b"".join(c.encode("latin-1" if ord(c) < 256 else "utf-8") for c in chars), error.end


codecs.register_error("linkwright.outside", _outside)


def repaired(text: str) -> str:
    """UTF-8 that was read as a one-byte encoding, once or twice, read again."""
    for _ in range(2):
        if not _MOJIBAKE.search(text):
            break
        text = text.encode("cp1252", "linkwright.outside").decode("utf-8", "replace")
    return text


def raw_sentences(text: str | None) -> list[str]:
    """Sentences of a subtitle text as written; they run on over line and cue breaks."""
    if not text:
        return []
    if not text.isascii():
        text = repaired(text)
    text = "\n" + "\n".join([line for line in text.splitlines() if "->" not in line and not line.isdigit()])
    if "<" in text or "{" in text:
        text = _TAGS.sub(" ", text)
    return _SPLIT.split(text)


@lru_cache(maxsize=300_000)
def normal(sentence: str) -> str:
    """The form of a sentence that is hashed; empty where nothing is said."""
    s = sentence.lower()
    if not s.isascii():
        s = s.translate(_table()).lower()
    if ".." in s or "…" in s:
        s = _DOTS.sub(" ", s)
    if _ALONE.search(s):
        s = _APART.sub(lambda m: "".join(c for c in m.group() if c.isalnum()), s)
    s = _STRETCH.sub(r"\1", s)
    s = _LEET.sub(lambda m: _DIGIT_LETTERS.get(m.group(), m.group()), s)
    s = _SPACES.sub(" ", s).strip()
    return s if len(s) > 1 else ""


def sentences(text: str | None) -> list[str]:
    """Sentences of a subtitle text in the form that is hashed."""
    return [s for raw in raw_sentences(text) if (s := normal(raw))]


def hashed(items: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the sentences, and the sentence of each."""
    if not items:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = "\n" + " \n".join(items) + " "
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    owner = np.cumsum(codes == 10) - 1
    buckets, owners = [], []
    value = codes.copy()
    for n in range(2, max(SIZES) + 1):
        value = value[:-1] * np.uint32(0x01000193) + codes[n - 1 :] * np.uint32(0x9E3779B1)
        if n in SIZES:
            inside = owner[: len(value)] == owner[n - 1 :]
            mixed = value ^ (value >> np.uint32(15))
            mixed = (mixed * np.uint32(0x85EBCA6B) + np.uint32(n)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
            buckets.append(mixed[inside])
            owners.append(owner[: len(value)][inside])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


class Grams:
    """N-grams of sentences, sorted by sentence."""

    def __init__(self, items: list[str], chunk: int = 20_000) -> None:
        parts, sizes = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for at in range(0, len(items), chunk):
            some = items[at : at + chunk]
            buckets, owners = hashed(some)
            parts.append(buckets[np.argsort(owners, kind="stable")].astype(np.int32))
            sizes.append(np.bincount(owners, minlength=len(some)))
        self.buckets = np.concatenate(parts)
        self.starts = np.cumsum(np.concatenate(sizes))

    def with_more(self, items: list[str]) -> Grams:
        more, out = Grams(items), object.__new__(Grams)
        out.buckets = np.concatenate([self.buckets, more.buckets])
        out.starts = np.concatenate([self.starts, more.starts[1:] + self.starts[-1]])
        return out


@dataclass(frozen=True)
class Model:
    """Per bucket, what one n-gram adds to each class: embedding times output weights, and the bias."""

    table: np.ndarray
    bias: np.ndarray

    def calibrated(self, threshold: float) -> Model:
        """The model whose score is ``THRESHOLD`` where it was ``threshold``."""
        shift = np.zeros_like(self.bias)
        shift[0] = math.log(threshold / (1 - threshold)) - math.log(THRESHOLD / (1 - THRESHOLD))
        return Model(self.table, self.bias + shift)

    def probabilities(self, items: list[str] | Grams) -> np.ndarray:
        grams = items if isinstance(items, Grams) else Grams(items)
        count = len(grams.starts) - 1
        if not count:
            return np.zeros((0, len(CLASSES)))
        sizes = np.diff(grams.starts)
        # every sentence has an n-gram, as it is padded and longer than one letter
        sums = np.concatenate([
            np.add.reduceat(self.table.take(grams.buckets[grams.starts[at] : grams.starts[to]], 0), grams.starts[at:to] - grams.starts[at])
            for at, to in zip(range(0, count, CHUNK), [*range(CHUNK, count, CHUNK), count])
        ])
        logits = sums / np.maximum(sizes, 1)[:, None] + self.bias
        logits -= logits.max(1, keepdims=True)
        out = np.exp(logits)
        return out / out.sum(1, keepdims=True)

    def harm(self, bags: list[list[str]]) -> Iterator[np.ndarray]:
        """What speaks for harm in every sentence of every bag; bags are judged together, about ``CHUNK`` sentences at once."""
        at = 0
        while at < len(bags):
            to, held = at, 0
            while to < len(bags) and held < CHUNK:
                held += len(bags[to])
                to += 1
            own = 1 - self.probabilities([s for bag in bags[at:to] for s in bag])[:, 0]
            yield from np.split(own, np.cumsum([len(bag) for bag in bags[at:to]])[:-1])
            at = to


def fit(grams: Grams, labels: np.ndarray, weights: np.ndarray, epochs: int = 6, batch: int = 256, rate: float = 0.25, seed: int = 0, state: tuple | None = None) -> tuple[Model, tuple]:
    """Embeddings and softmax trained jointly by Adagrad on weighted sentences; ``state`` goes on from an earlier fit."""
    rng = np.random.default_rng(seed)
    dense, starts, count = grams.buckets, grams.starts, len(CLASSES)
    if state is None:
        vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
        out = rng.normal(0, 0.3, (WIDTH, count)).astype(np.float32)
        bias = np.zeros(count, np.float32)
        g_vectors, g_out, g_bias = np.full(BUCKETS, 1e-6, np.float32), np.full_like(out, 1e-6), np.full_like(bias, 1e-6)
    else:
        vectors, out, bias, g_vectors, g_out, g_bias = state
    members = np.flatnonzero((weights > 0) & (np.diff(starts) > 0))
    place = np.zeros(BUCKETS, np.intp)
    for _ in range(epochs):
        shuffled = rng.permutation(members)
        for at in range(0, len(shuffled), batch):
            chosen = shuffled[at : at + batch]
            sizes = starts[chosen + 1] - starts[chosen]
            offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            index = np.repeat(starts[chosen] - offsets, sizes) + np.arange(sizes.sum())
            own = dense[index]
            hidden = np.add.reduceat(vectors.take(own, 0), offsets) / sizes[:, None]
            # einsum keeps to one thread; for matrices this small a BLAS library wakes threads that only wait
            logits = np.einsum("sw,wc->sc", hidden, out) + bias
            logits -= logits.max(1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), labels[chosen]] -= 1
            p *= (weights[chosen] / max(weights[chosen].sum(), 1e-9))[:, None]
            d_out, d_bias, d_hidden = np.einsum("sw,sc->wc", hidden, p), p.sum(0), np.einsum("sc,wc->sw", p, out) / sizes[:, None]
            # the distinct buckets in order, found by marking instead of sorting
            marks = np.zeros(BUCKETS, bool)
            marks[own] = True
            places = np.flatnonzero(marks)
            place[places] = np.arange(len(places))
            inverse = place.take(own)
            d_vectors = np.empty((len(places), WIDTH), np.float32)
            for k in range(WIDTH):
                d_vectors[:, k] = np.bincount(inverse, np.repeat(d_hidden[:, k], sizes), len(places))
            g_vectors[places] += (d_vectors**2).mean(1)
            vectors[places] -= rate * d_vectors / np.sqrt(g_vectors[places])[:, None]
            g_out += d_out**2
            out -= rate * d_out / np.sqrt(g_out)
            g_bias += d_bias**2
            bias -= rate * d_bias / np.sqrt(g_bias)
    # an n-gram that was never seen says nothing
    table = np.where((g_vectors > 1e-6)[:, None], np.einsum("bw,wc->bc", vectors, out), 0).astype(np.float32)
    return Model(table, bias.copy()), (vectors, out, bias, g_vectors, g_out, g_bias)


def train(documents: list[tuple[str, int]], seed: int = 0, weight_of_clean: float = 1.0) -> Model | None:
    """A model from ``(text, class)`` documents; None where only one kind of label is there.

    The documents are dealt into folds. Every fold is judged by a member that has not seen it: a sentence of a flagged
    document keeps its label when that member finds it harmful too, so a wrongly flagged document teaches nothing. All
    distinct clean sentences are in every fit; those a member still takes for harmful are weighted up and learnt again.
    The model is the mean of the members' logits, one table again; its threshold is the one that serves the documents
    best when each is judged by the member that has not seen it. ``weight_of_clean`` says how many clean documents
    stand behind each of the sample.
    """
    parts = [list(dict.fromkeys(sentences(text))) for text, _ in documents]
    classes = np.array([label for _, label in documents])
    seen = [Counter(), Counter()]
    for part, label in zip(parts, classes):
        seen[int(label > 0)].update(part)
    # a sentence of clean documents is clean; a few labels are wrong, so a rare exception is allowed
    bags = [[s for s in part if seen[0][s] <= 0.34 * seen[1][s]] if label else [] for part, label in zip(parts, classes)]
    clean = sorted(s for s in seen[0] if seen[0][s] > 0.34 * seen[1][s])
    if not any(bags) or not clean:
        return None
    fold = np.zeros(len(documents), int)
    for flagged in (True, False):
        own = np.flatnonzero((classes > 0) == flagged)
        fold[own] = np.arange(len(own)) % FOLDS
    chosen = [[(s, 1 / len(bag) ** 0.5) for s in bag] for bag in bags]
    rest: list[list[str]] = [[] for _ in bags]
    index = Grams(clean)

    def member(out: int, turn: int, epochs: int) -> Model | None:
        """A model that has not seen the documents of one fold."""
        inside = [i for i in range(len(documents)) if fold[i] != out]
        counts = Counter(s for i in inside if not classes[i] for s in parts[i])
        weights = np.array([1 + math.log1p(counts[s]) if s in counts else 0.0 for s in clean])
        good = [(s, int(classes[i]), weight) for i in inside for s, weight in chosen[i]]
        others = [s for i in inside for s in rest[i]]
        if not good or not weights.any():
            return None
        lift = max(1.0, 0.3 * (weights.astype(bool).sum() + len(others)) / max(1e-9, sum(x[2] for x in good))) ** 0.7
        data = index.with_more([x[0] for x in good] + others)
        labels = np.array([0] * len(clean) + [x[1] for x in good] + [0] * len(others))
        weights = np.concatenate([weights, [lift * x[2] for x in good], np.ones(len(others))]).astype(np.float32)
        state = None
        for again in range(1 + (turn == TURNS) * MENDS):
            model, state = fit(data, labels, weights, epochs if not again else 2, seed=seed + 10 * turn + out, state=state)
            if turn == TURNS:
                wrong = (labels == 0) & (weights > 0) & (1 - model.probabilities(data)[:, 0] >= 0.2)
                if not wrong.any():
                    break
                weights[wrong] *= 3
        return model

    members: list[Model | None] = []

    def judged(some: list[list[str]]) -> Iterator[tuple[int, np.ndarray]]:
        """Documents by number, and how harmful the member that has not seen them finds each sentence."""
        for k, judge in enumerate(members):
            if judge is not None:
                own = [i for i in np.flatnonzero(fold == k) if some[i]]
                yield from zip(own, judge.harm([some[i] for i in own]))

    for turn in range(TURNS + 1):
        members = [member(k, turn, 5 if turn == TURNS else 2 + turn) for k in range(FOLDS)]
        if turn == TURNS:
            break
        for i, own in judged(bags):
            bar = max(0.5 if turn else 0.3, 0.7 * own.max())
            chosen[i] = [(s, 1.0) for s, x in zip(bags[i], own) if x >= bar]
            rest[i] = [s for s, x in zip(bags[i], own) if x < min(bar, 0.3)]
    known = [m for m in members if m is not None]
    if not known:
        return None
    model = Model(np.mean([m.table for m in known], 0, dtype=np.float32), np.mean([m.bias for m in known], 0, dtype=np.float32))
    unseen = np.zeros(len(documents))
    for i, own in judged(parts):
        unseen[i] = own.max()
    return model.calibrated(best_threshold(unseen, classes > 0, weight_of_clean))


def best_threshold(scores: np.ndarray, flagged: np.ndarray, weight_of_clean: float) -> float:
    """The threshold of the best F-score of documents against their labels, in the middle of the gap below it."""
    order = np.argsort(-scores, kind="stable")
    s, hit = scores[order], flagged[order]
    true, false = np.cumsum(hit), np.cumsum(~hit) * weight_of_clean
    value = 1.25 * true / np.maximum(true + false + 0.25 * hit.sum(), 1e-9)
    value[np.append(s[1:] == s[:-1], False)] = -1
    value[s <= 0] = -1
    at = int(np.argmax(value))
    if value[at] <= 0:
        return THRESHOLD
    below = s[at + 1] if at + 1 < len(s) else 0.0
    return float(np.clip((s[at] + below) / 2, 0.05, 0.95))


def labelled(
    documents: DataFrame, labels: DataFrame, most_flagged: int = MOST_FLAGGED, most_clean: int = MOST_CLEAN, most_letters: int = MOST_LETTERS
) -> tuple[list[tuple[str, int]], float]:
    """The bounded training sample: texts with the class that most of their reviews give; and how many labelled clean
    documents stand behind each of the sample, where a flagged one stands for one."""
    votes = labels.groupBy("doc_id").agg(
        F.sum(F.when(F.col("flagged") == 1, 1).otherwise(-1)).alias("vote"), F.min(F.when(F.col("flagged") == 1, F.col("category"))).alias("category")
    )
    sized = votes.where("vote <> 0").join(documents.select("doc_id", F.length("text").alias("letters")), "doc_id")
    totals = sized.agg(F.count_if(F.col("vote") > 0).alias("flagged"), F.count_if(F.col("vote") < 0).alias("clean")).first()
    some = reduce(
        DataFrame.unionByName,
        [
            # the running total is over the bounded rows alone
            sized.where(sign).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).withColumn("total", F.sum("letters").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))).where(F.col("total") <= most_letters)
            for sign, most in (("vote > 0", most_flagged), ("vote < 0", most_clean))
        ],
    ).select("doc_id", "vote", "category")
    rows = documents.join(F.broadcast(some), "doc_id").select("doc_id", "text", "vote", "category").orderBy("doc_id").collect()
    at = {name: i for i, name in enumerate(CLASSES)}
    sample = [(r.text or "", at.get(r.category, 1) if r.vote > 0 else 0) for r in rows]
    flagged = sum(label > 0 for _, label in sample)
    if not flagged or flagged == len(sample):
        return sample, 1.0
    return sample, totals["clean"] / (len(sample) - flagged) * flagged / totals["flagged"]


def _score(model: Model | None, key: str):
    table = _table()  # built once on the driver, as each worker would take a second for it

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _TABLE.update(table)
        for batch in batches:
            best = np.zeros((len(batch), len(CLASSES)))
            best[:, 0] = 1.0
            if model is not None:
                # a sentence that occurs again in the batch is scored once
                place: dict[str, int] = {}
                owners, uses = [], []
                for i, text in enumerate(batch["text"]):
                    for s in dict.fromkeys(sentences(text)):
                        owners.append(i)
                        uses.append(place.setdefault(s, len(place)))
                if uses:
                    p = model.probabilities(list(place))[np.array(uses)]
                    owner = np.array(owners)
                    order = np.lexsort((p[:, 0], owner))
                    first = np.concatenate([[True], owner[order][1:] != owner[order][:-1]])
                    best[owner[order][first]] = p[order][first]
            out = {key: batch[key], "score": 1 - best[:, 0]}
            for k, name in enumerate(CLASSES[1:], 1):
                out[name] = best[:, k]
            yield pd.DataFrame(out)

    return run


def scores(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(<key>, score, abuse, hate, sexual)`` for every document, by its worst sentence."""
    source = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    sample, weight = labelled(source, labels)
    model = train(sample, weight_of_clean=weight)
    kind = dict(documents.dtypes)[key]
    rows = documents.select(key, F.col(text).alias("text"))
    return rows.mapInPandas(_score(model, key), f"{key} {kind}, score double, abuse double, hate double, sexual double")


def rates(documents: DataFrame, scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Share of harmful documents per source; a null source is a source of its own."""
    both = documents.select("doc_id", "source").join(scored, "doc_id")
    harmful = F.count_if(F.col("score") >= threshold)
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), harmful.alias("harmful"), (harmful / F.count(F.lit(1))).alias("rate"))
