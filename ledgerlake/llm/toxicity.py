"""Toxicity scores from subword bags.

A window of ``WINDOW_WORDS`` words is the bag of its words' features: the word
and its character n-grams (over UTF-8 bytes, A-Z lower-cased, word boundaries
included, 3 to 5 long), hashed into ``BUCKETS`` embeddings. The bag's embeddings are
averaged and go through a linear softmax; embeddings and softmax are trained
together in numpy (AdaGrad). A misspelling that was never seen still shares
most of its n-grams with the word. A text scores as its highest window, so a
long text is not diluted; training follows the highest window of each text.

Labels come from a bounded sample: of the labelled texts outside the held-out
part, at most ``SAMPLE_PER_CLASS`` a class (smallest id hashes), weighted back
to the classes' shares. Everything else covers all texts. Only the text is an
input of a score.

Null text counts as empty; a text without words scores the share of label 1
in training. Without labels of both classes every text scores that share (0
without labels). Rows with a null doc_id are
not held out. Repeated rows are scored each on their own; a doc_id with both
labels counts as toxic.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import batch_columns, bounded_batches, id_remainder

BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
DIM = 12
WINDOW_WORDS = 6
SAMPLE_PER_CLASS = 1500
EPOCHS = 24
#: First epochs, which follow random windows instead of the highest ones.
WARM_EPOCHS = 4
WARM_WINDOWS = 4
BATCH_TEXTS = 64
RATE = 0.6
DECAY = 1e-3
#: Every so many-th text of the sample is set aside; the epoch with the least
#: log loss on these texts is kept.
VALIDATION_EVERY = 5
#: Averages are multiplied by this before the softmax (the bags are long).
SCALE = 16.0
THRESHOLD = 0.3
#: Bytes of text that numpy works on at once; longer texts go in pieces.
PIECE_BYTES = 1 << 18
SEED = 11

_TABLE = np.full(256, 32, np.uint8)
for _c in range(256):
    if chr(_c).isascii() and chr(_c).isalnum():
        _TABLE[_c] = ord(chr(_c).lower())
    elif _c >= 128:
        _TABLE[_c] = _c
_P, _M = np.uint32(0x01000193), np.uint32(0x9E3779B1)
_POWER = np.cumprod(np.full(2 * PIECE_BYTES + 8, _P), dtype=np.uint32)
_INVERSE = np.cumprod(np.full(2 * PIECE_BYTES + 8, np.uint32(pow(int(_P), -1, 1 << 32))), dtype=np.uint32)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = h * _M
    h ^= h >> np.uint32(15)
    h *= _M
    return h >> np.uint32(32 - BUCKET_BITS)


class Bags:
    """The windows of some texts laid end to end, and their features."""

    def __init__(self, texts: list[np.ndarray]):
        """``texts``: mapped bytes, each of at most PIECE_BYTES."""
        sizes = np.array([len(t) + 1 for t in texts])
        data = np.full(int(sizes.sum()) + 4, 32, np.uint8)
        at = np.r_[1, 1 + np.cumsum(sizes)]
        for t, i in zip(texts, at):
            data[i:i + len(t)] = t
        self.data = data
        blank = data == 32
        self.first = np.flatnonzero(~blank[1:] & blank[:-1]) + 1  # first byte of every word
        self.last = np.flatnonzero(~blank[:-1] & blank[1:]) + 1  # byte after it
        of = np.searchsorted(at, self.first, side="right") - 1
        number = np.arange(len(of)) - np.searchsorted(of, np.arange(len(texts)))[of]
        opens = np.flatnonzero(number % WINDOW_WORDS == 0)
        self.start = self.first[opens]  # first byte of every window
        self.text = of[opens]

    def features(self):
        """(buckets, valid, first byte) of n-grams of 3, 4 and 5 bytes, then of
        whole words. A feature belongs to the window of its place."""
        wide = self.data.astype(np.uint32) + np.uint32(1)
        inner = self.data != 32
        h = (wide[:-2] * _P + wide[1:-1]) * _P + wide[2:]
        ok = inner[1:-1]
        yield _bucket(h), ok, 1  # an n-gram's second byte is always of its word
        h = h[:-1] * _P + wide[3:]
        ok = ok[:-1] & inner[2:-1]
        yield _bucket(h + np.uint32(4)), ok, 1
        h = h[:-1] * _P + wide[4:]
        yield _bucket(h + np.uint32(5)), ok[:-1] & inner[3:-1], 1
        # Differences of a running polynomial, shifted to the word's start.
        n = len(wide)
        run = np.r_[np.uint32(0), np.cumsum(wide * _POWER[:n], dtype=np.uint32)]
        yield _bucket((run[self.last] - run[self.first]) * _INVERSE[self.first] + np.uint32(6)), None, self.first

    def logits(self, value: np.ndarray, bias: float) -> np.ndarray:
        """The logit of every window, given each bucket's share in it."""
        if not len(self.start):
            return np.empty(0)
        total = np.zeros(len(self.data), np.float32)
        count = np.zeros(len(self.data), np.int32)
        for bucket, ok, place in self.features():
            if ok is None:
                total[place] += value[bucket]
                count[place] += 1
            else:
                total[1:1 + len(ok)] += value[bucket] * ok
                count[1:1 + len(ok)] += ok
        sums = np.add.reduceat(total, self.start, dtype=np.float64)
        return SCALE * sums / np.add.reduceat(count, self.start) + bias

    def lists(self):
        """(buckets by window, window pointers)."""
        ids, at = [], []
        for bucket, ok, place in self.features():
            if ok is None:
                ids.append(bucket)
                at.append(place)
            else:
                pos = np.flatnonzero(ok)
                ids.append(bucket[pos])
                at.append(pos + 1)
        ids, at = np.concatenate(ids).astype(np.int32), np.concatenate(at)
        window = np.searchsorted(self.start, at, side="right") - 1
        order = np.argsort(window, kind="stable")
        return ids[order], np.searchsorted(window[order], np.arange(len(self.start) + 1))


def mapped(texts: list[str | None]):
    """(text number, mapped bytes) of pieces of at most PIECE_BYTES, cut at
    blanks where there are any."""
    for k, text in enumerate(texts):
        data = _TABLE[np.frombuffer((text or "").encode(), np.uint8)]
        at = 0
        while at < len(data):
            end = min(at + PIECE_BYTES, len(data))
            if end < len(data):
                space = np.flatnonzero(data[at:end] == 32)
                end = at + int(space[-1]) + 1 if len(space) else end
            yield k, data[at:end]
            at = end


def bags(texts: list[str | None]):
    """(text numbers, Bags) of groups of pieces of bounded size."""
    owner, group, size = [], [], 0
    for k, piece in mapped(texts):
        if group and size + len(piece) + 1 > PIECE_BYTES:
            yield np.array(owner), Bags(group)
            owner, group, size = [], [], 0
        owner.append(k)
        group.append(piece)
        size += len(piece) + 1
    if group:
        yield np.array(owner), Bags(group)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def text_logits(texts: list[str | None], value: np.ndarray, bias: float, empty: float) -> np.ndarray:
    """The highest window's logit of every text (``empty`` without words)."""
    out = np.full(len(texts), -np.inf)
    for owner, b in bags(texts):
        np.maximum.at(out, owner[b.text], b.logits(value, bias))
    return np.where(np.isinf(out), empty, out)


def train(texts: list[str], labels: list[int], weights: list[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(embeddings, softmax matrix, softmax bias) by AdaGrad; every epoch
    follows the windows that are highest at its start."""
    rng = np.random.default_rng(SEED)
    table = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    ids, ptr, of, at = [], [np.zeros(1, np.int64)], [], 0
    for owner, b in bags(texts):
        feature, p = b.lists()
        ids.append(feature)
        ptr.append(p[1:] + at)
        of.append(owner[b.text])
        at += len(feature)
    if not at:
        return table, soft, bias
    ids, ptr, of = np.concatenate(ids), np.concatenate(ptr), np.concatenate(of)
    y, weight = np.array(labels), np.array(weights, np.float32)
    some = np.unique(of)  # texts that have words
    lo = np.searchsorted(of, some)
    hi = np.searchsorted(of, some, side="right")
    aside = (some % VALIDATION_EVERY == 0) & (len(some) >= 10 * VALIDATION_EVERY)
    sums = [np.full_like(x, 1e-3) for x in (np.zeros(BUCKETS, np.float32), soft, bias)]
    best, kept = np.inf, (table.copy(), soft.copy(), bias.copy())
    for epoch in range(EPOCHS + 1):
        value = table @ (soft[:, 1] - soft[:, 0])
        logit = SCALE * np.add.reduceat(value[ids], ptr[:-1], dtype=np.float64) / np.diff(ptr) + bias[1] - bias[0]
        top = np.maximum.reduceat(logit, lo)
        if epoch > WARM_EPOCHS:
            test = aside if aside.any() else ~aside
            loss = np.average(np.logaddexp(0, np.where(y[some] == 1, -top, top))[test], weights=weight[some][test])
            if loss < best:
                best, kept = loss, (table.copy(), soft.copy(), bias.copy())
        if epoch == EPOCHS:
            break
        if epoch < WARM_EPOCHS:
            rows = np.concatenate([rng.integers(lo, hi) for _ in range(WARM_WINDOWS)])
            share = 1 / WARM_WINDOWS
        else:
            is_top = np.flatnonzero(logit == np.repeat(top, hi - lo))
            rows, share = is_top[np.unique(of[is_top], return_index=True)[1]], 1.0
        rows = rng.permutation(rows[~np.isin(of[rows], some[aside])])
        step = int(BATCH_TEXTS / share)
        for chosen in (rows[i:i + step] for i in range(0, len(rows), step)):
            size = np.diff(ptr)[chosen]
            begin = np.r_[0, np.cumsum(size)[:-1]]
            place = np.repeat(np.arange(len(chosen)), size)
            feature = ids[np.repeat(ptr[chosen] - begin, size) + np.arange(size.sum())]
            mean = SCALE * np.add.reduceat(table[feature], begin, axis=0) / size[:, None]
            z = mean @ soft + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), y[of[chosen]]] -= 1
            grad = p * (weight[of[chosen]] * share)[:, None]
            g_soft, g_bias = mean.T @ grad, grad.sum(0)
            g_mean = (SCALE * (grad @ soft.T) / size[:, None]).astype(np.float32)
            order = np.argsort(feature, kind="stable")
            bucket, cut = np.unique(feature[order], return_index=True)
            g_row = np.add.reduceat(g_mean[place[order]], cut, axis=0) + DECAY * table[bucket]
            sums[0][bucket] += (g_row**2).mean(1)
            table[bucket] -= RATE * g_row / np.sqrt(sums[0][bucket])[:, None]
            for x, g, s in ((soft, g_soft + DECAY * soft, sums[1]), (bias, g_bias, sums[2])):
                s += g**2
                x -= 0.1 * RATE * g / np.sqrt(s)
    return kept


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list, list, list]:
    """(texts, labels, weights): the bounded training sample."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    usable = usable.filter(id_remainder(F.col("doc_id"), 4) != 2)
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    held = usable.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    total = {r[0]: r[1] for r in held.groupBy("toxic").count().collect()}
    if len(total) < 2:
        return [], [], [float(min(total, default=0))]
    picked = None
    for k in (0, 1):
        part = held.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_CLASS)
        picked = part if picked is None else picked.unionByName(part)
    # At most 2 * SAMPLE_PER_CLASS ids: small enough to broadcast.
    rows = docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text")).collect()
    rows = sorted((r["doc_id"], r["toxic"], r["text"] or "") for r in rows)
    got = {k: sum(r[1] == k for r in rows) for k in (0, 1)}
    share = {k: total[k] / sum(total.values()) * len(rows) / max(got[k], 1) for k in (0, 1)}
    return [r[2] for r in rows], [r[1] for r in rows], [share[r[1]] for r in rows]


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select("doc_id", "text")
    texts, marks, weights = sample(docs, labels.select("doc_id", "toxic"))
    share = sum(w for w, k in zip(weights, marks) if k) / max(sum(weights), 1e-9) if texts else weights[0]
    prior = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    if texts:
        table, soft, bias = train(texts, marks, weights)
        # A bag's logit is linear in its features: one number a bucket is enough to score.
        value, shift = (table @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0])
    else:
        value, shift = np.zeros(BUCKETS, np.float32), prior
    shared = spark.sparkContext.broadcast((value, shift, prior))

    def make():
        def run(rows):
            out = sigmoid(text_logits(rows, *shared.value))
            return {"score": out.tolist(), "predicted": (out >= THRESHOLD).astype(int).tolist()}

        return run

    got = docs.withColumn("held_out", F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False)))
    return batch_columns(got, ["doc_id", "held_out"], ["text"], make, {"score": "double", "predicted": "int"})
