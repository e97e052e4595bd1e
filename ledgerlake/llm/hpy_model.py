"""Scores of a hierarchical Pitman-Yor language model over words.

Text model: a text is its words (maximal runs outside ``[\\x20\\x09-\\x0D]``,
A-Z lower-cased) and an end token. A restaurant stands for a context of two
words, its parent for the last of them, the root for none. The tokens, each with
the two before it, are dealt to shares by the middle word v and packed once
(frequent words as ranks, others as keys of the share's part of a chunk); the
table is bucketed by share, so that no later pass moves it again. Two-word and
one-word restaurants of v are seated in its share. Words of more than half a share
are dealt to several by u too; their one-word restaurants are seated apart, by v.
The root's dishes are dealt by word; shares ask it for their words, by bin.

Base of the root: a word's spelling by a byte model, itself a Pitman-Yor
hierarchy over contexts of up to four symbols of the spelling (bytes, then an
end symbol; the end token is the empty spelling). Its customers are the distinct
words of the training texts; restaurants with the same last two symbols form a
subtree of at most 258**3 dishes.

Seating: each Gibbs sweep unseats all customers of a dish in a restaurant and
seats them again one after another by the Chinese-restaurant rule given the
other dishes' tables and the parent's prediction. Of many customers, blocks that are a
fixed share of those who sit already are seated at once, so a dish costs the
logarithm of its customers; of ``PROPOSALS`` such seatings one is taken by its
weight, which corrects the one-by-one draw towards the exact conditional (with
one or two customers it is exact). The two upper levels of the byte model (at
most 258**2 dishes) are sampled on the driver. Predictive probabilities are
averaged over the last sweeps.

Scoring sums each document's tokens in each share and adds up the shares' sums.
Nothing is broadcast but the byte model's bounded upper levels, the keys of at most
``OFTEN_WORDS`` words and the list of the hot words (at most two for ``DEAL_ROWS``
tokens). Stages are deleted when nothing reads them any more; the draws follow the
dealing, so another number of shares gives other draws of the same law.

Null and empty texts hold the end only. Rows with a null doc_id are not held
out. Repeated rows count and are scored each on their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import bounded_batches, discard, id_remainder, kept, partitions, shuffles_dropped, stage_folder, stored

ORDER = 5
SYMBOLS = 258  # 0: before the text, byte + 1, 257: end
START, END = 0, 257
BITS = 9
#: Discount and concentration by context length.
DISCOUNT = (0.1, 0.2, 0.3, 0.4, 0.5)
CONCENTRATION = (1.0, 1.0, 1.0, 1.0, 1.0)
#: The same of the word levels.
WORD_LAW = ((0.6, 1.0), (0.75, 1.0), (0.85, 1.0))
BURN_IN, SAMPLES, PROPOSALS = 2, 3, 2
#: Customers seated at once, as a share of those of the dish who sit already.
BLOCK = 0.08
SEED = 7
#: Tokens packed together, and words with short codes in what is packed.
CHUNK_TOKENS, OFTEN_WORDS = 2_000_000, 262_143
ALPHA = 0.1
#: Keys of the end token and of the place before a text (no word holds a blank).
END_KEY = int(np.uint64(xxhash.xxh3_64_intdigest(b" ")).view(np.int64))
START_KEY = int(np.uint64(xxhash.xxh3_64_intdigest(b"  ")).view(np.int64))
#: Tokens, or words, of one task's share.
DEAL_ROWS, BIN_WORDS = 1_000_000, 50_000
#: Smaller spelling probabilities (log10) are kept apart, they would underflow.
LEAST_LOG10 = -250.0


def _mask(symbols: int) -> int:
    return (1 << (BITS * symbols)) - 1


# --- keys ------------------------------------------------------------------


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit key of two."""
    with np.errstate(over="ignore"):
        x = a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x = (x + b.view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))).view(np.int64)


def _column(t: pa.Table, name: str) -> np.ndarray:
    return np.ascontiguousarray(t[name].to_numpy())


def spellings(words: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the five-symbol strings that end in each byte and in the end of
    every word, one word after the other, and how many each word has."""
    listed = words.to_pylist()
    data, n = np.frombuffer(b"".join(listed), np.uint8), np.array([len(x) for x in listed], np.int64)
    first, total = np.cumsum(n + ORDER) - (n + ORDER), int((n + ORDER).sum())
    p = np.zeros(total + ORDER, np.int64)
    p[np.arange(len(data)) + np.repeat(np.arange(len(n)) * ORDER + ORDER - 1, n)] = data.astype(np.int64) + 1
    p[first + n + ORDER - 1] = END
    g = p[:total].copy()
    for k in range(1, ORDER):
        g <<= BITS
        g |= p[k:k + total]
    sizes = n + 1
    return g[np.arange(int(sizes.sum())) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)], sizes


def _mix(x: np.ndarray) -> np.ndarray:
    """Well-mixed non-negative numbers of 64-bit keys."""
    with np.errstate(over="ignore"):
        x = x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def _counts(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]][:len(sorted_keys)])
    return sorted_keys[first], np.diff(np.r_[first, len(sorted_keys)])


def _distinct(x: np.ndarray) -> np.ndarray:
    return _counts(np.sort(x))[0]


#: Columns that hold an array a row travel as its bytes.
WHOLE = {"w", "cw"}


def _vector(t: pa.Table, name: str, i: int = 0) -> np.ndarray:
    """The array that a row holds in a column."""
    return np.frombuffer(t[name][i].as_buffer(), np.int64 if name in WHOLE else np.float64)


def _arrays(**columns: list[np.ndarray]) -> dict[str, pa.Array]:
    """Columns with an array a row."""
    return {k: pa.array([np.ascontiguousarray(x, np.int64 if k in WHOLE else np.float64).tobytes() for x in rows], pa.binary())
            for k, rows in columns.items()}


def chunked(docs: DataFrame) -> DataFrame:
    """doc_id, text, held_out. Rows that are not read from files are first
    written to the shared folder, so every scan gives the same."""
    try:
        docs.select("_metadata.file_path")
    except AnalysisException:
        docs = stored(docs.select("doc_id", "text"), "lm-texts")
    return docs.select("doc_id", "text", F.coalesce(id_remainder(F.col("doc_id"), 10) == 0, F.lit(False)).alias("held_out"))


def word_lists(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of words of each text, and all their words (runs outside the
    six ASCII blanks, A-Z lower-cased)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    flat = lists.flatten()
    some = pc.greater(pc.binary_length(flat), 0)
    of = np.repeat(np.arange(len(text)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return np.bincount(of[some.to_numpy(zero_copy_only=False)], minlength=len(text)), flat.filter(some)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, pa.Array]]:
    """Batches of about ``CHUNK_TOKENS`` tokens together: (batches, the sizes of
    their texts in words, words as places in a list, the list)."""
    held, sizes, words, total = [], [], [], 0

    def joined():
        every = pa.chunked_array(words, pa.string()).combine_chunks()
        coded = (every.chunk(0) if isinstance(every, pa.ChunkedArray) else every).dictionary_encode()
        return held[:], np.concatenate(sizes), coded.indices.to_numpy(zero_copy_only=False), coded.dictionary

    for b in batches:
        if not b.num_rows:
            continue
        n, flat = word_lists(b.column(b.schema.get_field_index("text")).cast(pa.string()))
        held.append(b), sizes.append(n), words.append(flat)
        total += len(flat) + len(n)
        if total >= CHUNK_TOKENS:
            yield joined()
            held.clear(), sizes.clear(), words.clear()
            total = 0
    if held:
        yield joined()


def _digests(listed: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(x) for x in listed.cast(pa.binary()).to_pylist()], np.uint64).view(np.int64)


def counted(texts: DataFrame) -> DataFrame:
    """(w, word, cw, ca): the distinct words and the end (an empty word) with
    their occurrences in training texts and in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bs, sizes, place, listed in _chunks(batches):
            train = ~np.concatenate([b.column(0).to_numpy(zero_copy_only=False) for b in bs])
            ca = np.bincount(place, minlength=len(listed))
            cw = np.bincount(place[np.repeat(train, sizes)], minlength=len(listed))
            out = pa.table({"w": np.r_[END_KEY, _digests(listed)],
                            "word": pa.concat_arrays([pa.array([b""]), listed.cast(pa.binary())]),
                            "cw": np.r_[train.sum(), cw], "ca": np.r_[len(train), ca]})
            yield from out.combine_chunks().to_batches(max_chunksize=100_000)

    rows = texts.select("held_out", "text").mapInArrow(run, "w bigint, word binary, cw bigint, ca bigint")
    return rows.groupBy("w").agg(F.min("word").alias("word"), F.sum("cw").alias("cw"), F.sum("ca").alias("ca"))


class Asked(NamedTuple):
    """What is asked of the model: ``packed`` (share, row, keys, body; share < 0:
    row, doc_id, held_out of the texts) and its table's name, ``words`` (w, word, cw, ca), the number of
    shares, the keys with short codes, and the words whose tokens fill more than
    half a share, with the number of shares that they are dealt to."""

    packed: DataFrame
    table: str
    words: DataFrame
    folders: list[str]
    n_all: int
    n_distinct: int
    n_words: int
    shares: int
    often: np.ndarray
    hot: np.ndarray
    parts: np.ndarray


def pack(numbers: list[np.ndarray], flags: np.ndarray) -> bytes:
    """Equally long columns of numbers below 2**32 and one of flags, compressed;
    the four bytes of a number go apart, which packs better."""
    planes = [np.ascontiguousarray(x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T) for x in numbers]
    body = np.concatenate([x.ravel() for x in planes] + [flags.astype(np.uint8)])
    return np.int64(len(flags)).tobytes() + pa.Codec("zstd", 3).compress(body.tobytes(), asbytes=True)


def unpack(packed: bytes, columns: int) -> tuple[list[np.ndarray], np.ndarray]:
    n = int(np.frombuffer(packed, np.int64, 1)[0])
    body = np.frombuffer(pa.Codec("zstd").decompress(packed[8:], n * (4 * columns + 1)), np.uint8)
    numbers = [np.ascontiguousarray(body[4 * i * n:4 * (i + 1) * n].reshape(4, n).T).view(np.uint32).ravel().astype(np.int64)
               for i in range(columns)]
    return numbers, body[4 * columns * n:].astype(bool)


def requests(texts: DataFrame) -> Asked:
    """Every token's triple, packed by share, and the vocabulary."""
    spark, at = texts.sparkSession, []
    words = kept(counted(texts), "lm-words", at)
    n_words, tokens, n_all, n_distinct = words.agg(
        F.count(F.lit(1)), F.sum("ca"), F.sum("cw"), F.sum((F.col("cw") > 0).cast("bigint"))).first()
    shares = max(partitions(spark), (tokens or 0) // DEAL_ROWS)
    least, found = 0, 0  # the least count of at most OFTEN_WORDS words
    for ca, n in sorted(words.groupBy("ca").count().collect(), reverse=True):
        found += n
        if found > OFTEN_WORDS:
            break
        least = ca
    top = words.filter(F.col("ca") >= least).select("w", "ca").collect() if least else []
    often = np.array([START_KEY] + [r[0] for r in sorted(top, key=lambda r: (-r[1], r[0]))], np.int64)
    wide = sorted((r[0], -(-r[1] // (DEAL_ROWS // 2))) for r in words.filter(
        (F.col("ca") > DEAL_ROWS // 2) & (F.col("w") != END_KEY)).select("w", "ca").collect())
    hot, parts = np.array([r[0] for r in wide], np.int64), np.array([r[1] for r in wide], np.uint64)
    shared = spark.sparkContext.broadcast((often, np.argsort(often), hot, parts))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, order, hot, parts = shared.value
        ranked, short = often[order], len(often)
        for bs, sizes, place, listed in _chunks(batches):
            t = pa.Table.from_batches(bs)
            rows, held = _column(t, "row"), t["held_out"].to_numpy()
            key = np.r_[START_KEY, END_KEY, _digests(listed)]
            ends = np.cumsum(sizes + 3)
            ids = np.ones(int(ends[-1]), np.int64)
            inside = np.ones(len(ids), bool)
            inside[ends - 1] = inside[ends - sizes - 3] = inside[ends - sizes - 2] = False
            ids[ends - sizes - 3] = ids[ends - sizes - 2] = 0
            ids[inside] = place + 2
            last = np.zeros(len(ids), bool)  # the places of w: all but the two starts
            last[inside] = last[ends - 1] = True
            at = np.flatnonzero(last)
            u, v, w = ids[at - 2], ids[at - 1], ids[at]
            doc = np.repeat(np.arange(len(sizes)), sizes + 1)
            share = (_mix(key) % np.uint64(shares)).astype(np.int64)[v]
            if len(hot):
                i = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                split = np.flatnonzero((hot[i] == key)[v])
                part = _mix(_mix(key)[u[split]].view(np.int64)) % parts[i[v[split]]]
                share[split] = (_mix(_pair(key[v[split]], part.view(np.int64))) % np.uint64(shares)).astype(np.int64)
            i = np.minimum(np.searchsorted(ranked, key), short - 1)
            code = np.where(ranked[i] == key, order[i], -1)
            by = np.argsort(share.astype(np.uint16) if shares < 65536 else share, kind="stable")
            cuts = np.searchsorted(share[by], np.arange(shares + 1))
            found, lists, bodies = [], [], []
            for s in np.flatnonzero(np.diff(cuts)):
                mine = by[cuts[s]:cuts[s + 1]]
                three = [x[mine] for x in (u, v, w)]
                rare = _distinct(np.concatenate([x[code[x] < 0] for x in three]))
                local = []
                for x in three:
                    c = code[x]
                    c[c < 0] = np.searchsorted(rare, x[c < 0]) + short
                    local.append(c)
                found.append(int(s)), lists.append(key[rare].tobytes())
                bodies.append(pack([*local, np.diff(rows[doc[mine]], prepend=rows[0])], held[doc[mine]]))
            n = len(found)
            yield pa.RecordBatch.from_arrays([
                pa.array(found, pa.int64()), pa.array([int(rows[0])] * n, pa.int64()), pa.nulls(n, t.schema.field("doc_id").type),
                pa.nulls(n, pa.bool_()), pa.array(lists, pa.binary()), pa.array(bodies, pa.binary())], names=names)
            for b in t.combine_chunks().to_batches():
                none = pa.nulls(b.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([
                    pa.array(-1 - _column(pa.Table.from_batches([b]), "row") % shares), b.column("row"), b.column("doc_id"), b.column("held_out"), none, none], names=names)

    names = ["share", "row", "doc_id", "held_out", "keys", "body"]
    rows = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text").mapInArrow(
        run, f"share bigint, row bigint, doc_id {kind}, held_out boolean, keys binary, body binary")
    # The packed rows lie by share, so that no pass over the shares moves them again.
    table = "lm_packed_" + uuid.uuid4().hex
    at.append(stage_folder(spark, "lm-packed"))
    rows.repartition(shares, "share").write.bucketBy(shares, "share").option("path", at[-1]).saveAsTable(table)
    return Asked(spark.table(table), table, words, at, int(n_all or 0), int(n_distinct or 0), n_words, shares, often, hot, parts)


# --- seating ---------------------------------------------------------------


def seat(c, others, base, discount: float, concentration: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """Seat c customers of each dish one after another; ``others``: tables of
    the restaurant's other dishes, ``base``: the parent's probability. Gives
    the tables and the log weight of the draw.

    The first customers are seated singly, later ones in blocks of ``BLOCK``
    of those who sit already; within a block the chance of a new table stays."""
    tables, weight = np.ones(len(c)), np.zeros(len(c))
    live = np.flatnonzero(c > 1)
    live = live[np.argsort(-c[live], kind="stable")]  # those who are done come last
    size, t, w = c[live], tables[live], weight[live]
    grow, theta = discount * base[live], (concentration + discount * others[live]) * base[live]
    seated, n = 1.0, len(live)
    while n:
        block = max(1.0, np.floor(BLOCK * seated))
        m, own, new = np.minimum(block, size[:n] - seated), t[:n], theta[:n] + grow[:n] * t[:n]
        z = seated - discount * own + new
        chance = new / z
        own += rng.binomial(m.astype(np.int64), chance) if block > 1 else (rng.random(n) < chance)
        after = seated + m - discount * own + theta[:n] + grow[:n] * own
        w[:n] += m * np.log((z + np.maximum(after - 1, z)) / 2)
        seated += block
        n = int(np.searchsorted(-size[:n], -seated))
    tables[live], weight[live] = t, w
    return tables, weight


def reseat(c, tables, restaurant, base, level: int, rng, law=None, total=None) -> np.ndarray:
    """One Gibbs step for every dish with customers (the others have no table).
    ``law``: discount and concentration, ``total``: each restaurant's tables, if
    they are not the byte level's and the sum of these rows."""
    if total is None:
        total = np.bincount(restaurant, tables, int(restaurant.max(initial=-1)) + 1)
    has = np.flatnonzero(c > 0)
    others = (total[restaurant] - tables)[has]
    args = (c[has].astype(float), others, base[has], *(law or (DISCOUNT[level], CONCENTRATION[level])), rng)
    taken, weight = seat(*args)
    for _ in range(PROPOSALS - 1):
        t, w = seat(*args)
        more = np.logaddexp(weight, w)
        swap = np.log(rng.random(len(has))) < w - more
        taken, weight = np.where(swap, t, taken), more
    out = np.zeros(len(c))
    out[has] = taken
    return out


def predict(c, tables, restaurant, base, level: int, law=None) -> np.ndarray:
    """The restaurant's predictive probability of every dish."""
    n = int(restaurant.max(initial=-1)) + 1
    d, theta = law or (DISCOUNT[level], CONCENTRATION[level])
    customers, total = np.bincount(restaurant, c, n)[restaurant], np.bincount(restaurant, tables, n)[restaurant]
    return (c - d * tables + (theta + d * total) * base) / (theta + customers)


def upper_levels(rows: list[tuple[int, int, float]]) -> np.ndarray:
    """P(symbol | last symbol) from the customers of the one-symbol contexts
    (at most 258**2 rows), averaged over the last sweeps."""
    rng = np.random.default_rng(SEED)
    c1 = np.zeros((SYMBOLS, SYMBOLS))
    for s, w, n in rows:
        c1[s, w] = n
    base = np.full(SYMBOLS, 1 / (SYMBOLS - 1))
    base[START] = 0
    contexts, root = np.repeat(np.arange(SYMBOLS), SYMBOLS), np.zeros(SYMBOLS, np.int64)
    t1 = (c1 > 0).astype(float)
    t0 = (t1.sum(0) > 0).astype(float)
    mean = np.zeros((SYMBOLS, SYMBOLS))
    for sweep in range(BURN_IN + SAMPLES):
        p0 = predict(t1.sum(0), t0, root, base, 0)
        t1 = reseat(c1.ravel(), t1.ravel(), contexts, np.tile(p0, SYMBOLS), 1, rng).reshape(c1.shape)
        t0 = reseat(t1.sum(0), t0, root, base, 0, rng)
        if sweep >= BURN_IN:
            p0 = predict(t1.sum(0), t0, root, base, 0)
            mean += predict(c1.ravel(), t1.ravel(), contexts, np.tile(p0, SYMBOLS), 1).reshape(c1.shape)
    return mean / SAMPLES


class Subtrees:
    """The restaurants of contexts of two to four symbols in one task."""

    def __init__(self, key: np.ndarray, n: np.ndarray, upper: np.ndarray, rng):
        self.rng, top = rng, ORDER - 1
        self.rows, self.up, self.room = {top: key}, {}, {}
        for level in range(top, 1, -1):
            g = self.rows[level]
            self.room[level] = np.unique(g >> BITS, return_inverse=True)[1]
            if level > 2:
                self.rows[level - 1], self.up[level] = np.unique(g & _mask(level), return_inverse=True)
        g = self.rows[2]
        self.base2 = upper[(g >> BITS) & _mask(1), g & _mask(1)]
        self.c, self.t = {top: n.astype(float)}, {}
        for level in range(top, 1, -1):
            self.t[level] = (self.c[level] > 0).astype(float)
            self._to_parent(level)

    def _to_parent(self, level: int) -> None:
        if level > 2:
            self.c[level - 1] = np.bincount(self.up[level], self.t[level], len(self.rows[level - 1]))

    def predictions(self) -> dict[int, np.ndarray]:
        p = {2: predict(self.c[2], self.t[2], self.room[2], self.base2, 2)}
        for level in range(3, ORDER):
            p[level] = predict(self.c[level], self.t[level], self.room[level], p[level - 1][self.up[level]], level)
        return p

    def sweep(self) -> None:
        p = self.predictions()
        for level in range(ORDER - 1, 1, -1):
            base = p[level - 1][self.up[level]] if level > 2 else self.base2
            self.t[level] = reseat(self.c[level], self.t[level], self.room[level], base, level, self.rng)
            self._to_parent(level)


def _over_subtrees(counts: DataFrame, upper: np.ndarray, final: bool) -> DataFrame:
    """(key, value): the averaged probability of every string, or (not final)
    the customers of the one-symbol contexts after the burn-in."""
    shared = counts.sparkSession.sparkContext.broadcast(upper)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not got:
            return
        key, n = np.concatenate([k for k, _ in got]), np.concatenate([c for _, c in got])
        order = np.argsort(key)
        key, n = key[order], n[order]
        trees = Subtrees(key, n, shared.value, np.random.default_rng([SEED, int(key[0])]))
        for _ in range(BURN_IN):
            trees.sweep()
        if final:
            value = np.zeros(len(key))
            for _ in range(SAMPLES):
                trees.sweep()
                value += trees.predictions()[ORDER - 1]
            value /= SAMPLES
        else:
            key, place = np.unique(trees.rows[2] & _mask(2), return_inverse=True)
            value = np.bincount(place, trees.t[2], len(key))
        for i in range(0, len(key), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(key[i:i + 100_000]), pa.array(value[i:i + 100_000])], names=["key", "value"])

    tree = F.shiftright("key", BITS).bitwiseAND(F.lit(_mask(2)))
    return counts.repartition(partitions(counts.sparkSession), tree).mapInArrow(run, "key bigint, value double")


def fit(counts: DataFrame) -> DataFrame:
    """(key, value) of every string in ``counts`` (key, n; n may be 0): the
    averaged predictive probability of its last symbol after the others."""
    last, before = F.col("key").bitwiseAND(F.lit(_mask(1))), F.shiftright("key", BITS).bitwiseAND(F.lit(_mask(1)))
    pairs = counts.filter("n > 0").select(F.col("key").bitwiseAND(F.lit(_mask(3))).alias("key")).distinct()
    first = pairs.groupBy(before.alias("s"), last.alias("w")).agg(F.count(F.lit(1)).alias("n"))
    upper = upper_levels([(r[0], r[1], float(r[2])) for r in first.collect()])
    met = _over_subtrees(counts, upper, final=False).groupBy(before.alias("s"), last.alias("w")).agg(F.sum("value"))
    upper = upper_levels([(r[0], r[1], float(r[2])) for r in met.collect()])
    return _over_subtrees(counts, upper, final=True)


# --- word levels -----------------------------------------------------------


def sampled(c, restaurant, base, law, rng) -> tuple[np.ndarray, np.ndarray]:
    """(tables after the last sweep, averaged predictions) of whole restaurants.
    A lone customer has one table in any seating, so only the other dishes are
    drawn; a prediction is linear in the tables, so their mean gives its mean."""
    n = int(restaurant.max(initial=-1)) + 1
    t = (c > 0).astype(float)
    total = np.bincount(restaurant, t, n)
    live = np.flatnonzero(c > 1)
    room, drawn, own = restaurant[live], t[live], base[live]
    many, alone = c[live], total - np.bincount(room, drawn, n)
    mean, mean_total = np.zeros(len(live)), np.zeros(n)
    for sweep in range(BURN_IN + SAMPLES):
        drawn = reseat(many, drawn, room, own, 0, rng, law, total)
        total = alone + np.bincount(room, drawn, n)
        if sweep >= BURN_IN:
            mean += drawn / SAMPLES
            mean_total += total / SAMPLES
    t[live] = mean
    d, theta = law
    customers = np.bincount(restaurant, c, n)[restaurant]
    p = (c - d * t + (theta + d * mean_total[restaurant]) * base) / (theta + customers)
    t[live] = drawn
    return t, p


def binned(words: DataFrame, bins: int) -> DataFrame:
    """(bin, w, word, cw) of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of = (_mix(np.ascontiguousarray(b.column(0).to_numpy())) % np.uint64(bins)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(of), *b.columns], names=["bin", "w", "word", "cw"])

    return words.select("w", "word", "cw").mapInArrow(run, "bin bigint, w bigint, word binary, cw bigint")


def spelled(vocab: DataFrame, at: list[str]) -> DataFrame:
    """(bin, w, cw, base, shift), a row a bin with its words as arrays in order of w:
    the probability of the spelling; of a word not trained on, what was taken off its log10."""

    def ask(t: pa.Table) -> pa.Table:
        keys, sizes = spellings(t["word"])
        trained = _counts(np.sort(keys[np.repeat(_column(t, "cw") > 0, sizes)]))
        every = _distinct(keys)
        n = np.zeros(len(every), np.int64)
        n[np.searchsorted(every, trained[0])] = trained[1]
        return pa.table({"bin": np.full(len(every), t["bin"][0].as_py(), np.int64), "key": every, "n": n})

    asked = kept(vocab.groupBy("bin").applyInArrow(ask, "bin bigint, key bigint, n bigint"), "lm-spelling", at)
    model = kept(fit(kept(asked.groupBy("key").agg(F.sum("n").alias("n")), "lm-strings", at)), "lm-bytes", at)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.take(pa.array(np.argsort(_column(left, "w"))))
        keys, sizes = spellings(left["word"])
        order = np.argsort(_column(right, "key"))
        value = np.log10(_column(right, "value")[order])
        log = np.add.reduceat(value[np.searchsorted(_column(right, "key")[order], keys)], np.cumsum(sizes) - sizes)
        lowest = np.maximum(log, LEAST_LOG10)
        cw = _column(left, "cw")
        return pa.table({"bin": pa.array([left["bin"][0].as_py()]), **_arrays(
            w=[_column(left, "w")], cw=[cw], base=[10.0 ** lowest], shift=[np.where(cw > 0, 0.0, log - lowest)])})

    answers = asked.join(model, "key").select("bin", "key", "value")
    return kept(vocab.groupBy("bin").cogroup(answers.groupBy("bin")).applyInArrow(
        run, "bin bigint, w binary, cw binary, base binary, shift binary"), "lm-base", at)


def _each(make):
    """A function of one row (as a table) over the batches of mapInArrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield from make(pa.Table.from_batches([b.slice(i, 1)])).to_batches()

    return run


def root(base: DataFrame, asks: DataFrame, at: list[str]) -> DataFrame:
    """(bin, w, cw, shift, p), a row a bin: predictions of the root from its
    customers, the sums of c over ``asks`` (bin, w, c). Its dishes are dealt by
    word; the sum of the tables is renewed after each sweep."""
    law, drawn = WORD_LAW[0], []

    def met(t: pa.Table, more: pa.Table) -> pa.Table:
        w = _vector(t, "w")
        c = np.zeros(len(w))
        for i in range(len(more)):
            c[np.searchsorted(w, _vector(more, "w", i))] += _vector(more, "c", i)
        return t.append_column("c", _arrays(c=[c])["c"])

    fields = "bin bigint, w binary, cw binary, base binary, shift binary, c binary"
    rows = kept(base.groupBy("bin").cogroup(asks.select("bin", "w", "c").groupBy("bin")).applyInArrow(met, fields), "lm-root", drawn)

    def begun(t: pa.Table) -> pa.Table:
        c, own = _vector(t, "c"), _vector(t, "base")
        live = c > 1
        return pa.table({"bin": t["bin"], "n": [c.sum()], "alone": [float((c == 1).sum())], "total": [float((c > 0).sum())],
                         **_arrays(c=[c[live]], base=[own[live]], t=[np.ones(live.sum())], mean=[np.zeros(live.sum())])})

    state = "bin bigint, n double, alone double, total double, c binary, base binary, t binary, mean binary"
    mine: list[str] = []
    live = kept(rows.select("bin", "c", "base").mapInArrow(_each(begun), state), "lm-live", mine)
    n, total = (float(x or 0) for x in live.agg(F.sum("n"), F.sum("total")).first())
    mean_total = 0.0

    def seating(sweep: int, total: float):
        def step(t: pa.Table) -> pa.Table:
            c, own, tables, mean = (_vector(t, x) for x in ("c", "base", "t", "mean"))
            rng = np.random.default_rng([SEED, sweep, t["bin"][0].as_py()])
            tables = reseat(c, tables, np.zeros(len(c), np.int64), own, 0, rng, law, np.array([total]))
            if sweep >= BURN_IN:
                mean = mean + tables / SAMPLES
            return pa.table({"bin": t["bin"], "n": t["n"], "alone": t["alone"], "total": [t["alone"][0].as_py() + tables.sum()],
                             "c": t["c"], "base": t["base"], **_arrays(t=[tables], mean=[mean])})

        return _each(step)

    for sweep in range(BURN_IN + SAMPLES):
        live = kept(live.mapInArrow(seating(sweep, total), state), "lm-live", mine)
        total = float(live.agg(F.sum("total")).first()[0] or 0)
        discard(live.sparkSession, mine[:-1])
        if sweep >= BURN_IN:
            mean_total += total / SAMPLES

    def told(t: pa.Table, seated: pa.Table) -> pa.Table:
        c, own = _vector(t, "c"), _vector(t, "base")
        tables = (c > 0).astype(float)
        tables[c > 1] = _vector(seated, "mean")
        p = (c - law[0] * tables + (law[1] + law[0] * mean_total) * own) / (law[1] + n)
        return t.select(["bin", "w", "cw", "shift"]).append_column("p", _arrays(p=[p])["p"])

    made = kept(rows.groupBy("bin").cogroup(live.select("bin", "mean").groupBy("bin")).applyInArrow(
        told, "bin bigint, w binary, cw binary, shift binary, p binary"), "lm-root", at)
    discard(live.sparkSession, mine + drawn)
    return made


def answered(asks: DataFrame, level0: DataFrame) -> DataFrame:
    """(asker, v, bin, p, cw, shift): the root's answers in the order of each ask's words."""

    def run(t: pa.Table, up: pa.Table) -> pa.Table:
        w, n = _vector(up, "w"), len(t)
        place = [np.searchsorted(w, _vector(t, "w", i)) for i in range(n)]
        got = {k: [_vector(up, k)[x] for x in place] for k in ("p", "cw", "shift")}
        return pa.table({"asker": t["asker"], "v": t["v"], "bin": t["bin"], **_arrays(**got)})

    return asks.select("asker", "v", "bin", "w").groupBy("bin").cogroup(level0.groupBy("bin")).applyInArrow(
        run, ANSWERS)


def _rooms(x: np.ndarray) -> np.ndarray:
    return np.cumsum(np.r_[False, x[1:] != x[:-1]][:len(x)]).astype(np.int64)


class Share:
    """The distinct triples of a share, in order of (v, u, w), from its packed
    rows. All but hot words have their whole restaurants here."""

    def __init__(self, t: pa.Table, often: np.ndarray, hot: np.ndarray):
        rare = [np.frombuffer(x.as_py(), np.int64) for x in t["keys"]]
        self.vocabulary = _distinct(np.concatenate([often, *rare]))
        self.k, self.blobs = len(self.vocabulary), t
        self.bits = np.int64(int(self.k).bit_length())
        low = (1 << self.bits) - 1
        short = np.searchsorted(self.vocabulary, often)
        self.short, self.rare = short, [np.searchsorted(self.vocabulary, x) for x in rare]
        self.leads = None
        if self.bits > 21:  # three places do not fit 63 bits: number the pairs (v, u)
            some = [_distinct(v << self.bits | u) for u, v, _, _, _ in map(self.tokens, range(len(t)))]
            self.leads = _distinct(np.concatenate(some))
        trained, held = [], []
        for i in range(len(t)):
            key, _, off = self.keyed(i)
            trained.append(_counts(np.sort(key[~off])))
            held.append(_counts(np.sort(key[off]))[0])
        key, n = (np.concatenate([x[i] for x in trained]) for i in range(2))
        order = np.argsort(key)
        key, n = key[order], n[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])
        n = np.add.reduceat(n, first) if len(first) else n
        key = key[first]
        self.key = _distinct(np.concatenate([key, *held]))
        self.n = np.zeros(len(self.key))
        self.n[np.searchsorted(self.key, key)] = n
        self.w, self.room = (self.key & low).astype(np.int32), _rooms(self.key >> self.bits).astype(np.int32)
        every = self.contexts()[1] << self.bits | self.w
        pair = _distinct(every)
        self.of = np.searchsorted(pair, every).astype(np.int32)
        self.pv, self.pw, self.pairs = pair >> self.bits, pair & low, len(pair)
        at = np.searchsorted(self.vocabulary, hot) if len(hot) else np.zeros(0, np.int64)
        here = at < self.k
        here[here] = self.vocabulary[at[here]] == hot[here]
        wide = np.zeros(self.k, bool)
        wide[at[here]] = True
        self.split = wide[self.pv]
        used = np.zeros(self.k, bool)
        used[self.pw] = True
        self.asked = np.flatnonzero(used)

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """u and v of the triples, as places in the vocabulary."""
        lead = self.key >> self.bits
        lead = lead if self.leads is None else self.leads[lead]
        return lead & ((1 << self.bits) - 1), lead >> self.bits

    def tokens(self, i: int):
        (u, v, w, step), held = unpack(self.blobs["body"][i].as_py(), 4)
        return *(self.placed(i, x) for x in (u, v, w)), np.cumsum(step), held

    def placed(self, i: int, x: np.ndarray) -> np.ndarray:
        """Places in the vocabulary of the codes of a packed row."""
        n, many = np.empty_like(x), x < len(self.short)
        n[many], n[~many] = self.short[x[many]], self.rare[i][x[~many] - len(self.short)]
        return n

    def keyed(self, i: int):
        u, v, w, doc, held = self.tokens(i)
        lead = v << self.bits | u
        if self.leads is not None:
            lead = np.searchsorted(self.leads, lead)
        return lead << self.bits | w, doc, held

    def by_bin(self, bins: int):
        """(bin, places of its words in the vocabulary), one after the other."""
        of = (_mix(self.vocabulary[self.asked]) % np.uint64(bins)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        found, n = _counts(of[order])
        for b, x in zip(found.tolist(), np.split(self.asked[order], np.cumsum(n)[:-1])):
            yield b, x

    def wide(self):
        """(v, its pairs) of the hot words."""
        for v in np.unique(self.pv[self.split]):
            yield int(self.vocabulary[v]), np.flatnonzero(self.pv == v)

    def ask(self, share: int, bins: int, c: np.ndarray, part: np.ndarray) -> pa.Table:
        """What the share asks for: of the root (by bin, with the customers c that
        its whole restaurants send there), of the hot words (with its part's customers)."""
        sent = np.bincount(self.pw[~self.split], c[~self.split], self.k)
        rows = [(None, b, self.vocabulary[x], sent[x]) for b, x in self.by_bin(bins)]
        rows += [(v, None, self.vocabulary[self.pw[x]], part[x]) for v, x in self.wide()]
        return ask_table([share] * len(rows), rows)

    def answers(self, t: pa.Table, bins: int) -> dict[str, np.ndarray]:
        """By place in the vocabulary p, cw and shift; ``hot``: p of the hot words' pairs."""
        got = {"p": np.zeros(self.k), "cw": np.zeros(self.k, np.int64), "shift": np.zeros(self.k), "hot": np.zeros(self.pairs)}
        places, wide = dict(self.by_bin(bins)), dict(self.wide())
        for i, (b, v) in enumerate(zip(t["bin"].to_pylist(), t["v"].to_pylist())):
            if v is not None:
                got["hot"][wide[v]] = _vector(t, "p", i)
            elif b is not None:
                for k in ("p", "cw", "shift"):
                    got[k][places[b]] = _vector(t, k, i)
            else:
                got["customers"] = _vector(t, "p", i)
        return got

    def one_word(self, c: np.ndarray, got: dict, rng) -> tuple[np.ndarray, np.ndarray]:
        """(tables, predictions) of the one-word contexts; of hot words as they were told."""
        own = ~self.split
        t, p = np.zeros(self.pairs), got["hot"].copy()
        t[own], p[own] = sampled(c[own], _rooms(self.pv[own]), got["p"][self.pw[own]], WORD_LAW[1], rng)
        return t, p

    def two_words(self, p: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray]:
        return sampled(self.n, self.room, p[self.of], WORD_LAW[2], rng)


ASKS = "asker bigint, v bigint, bin bigint, w binary, c binary"
ANSWERS = "asker bigint, v bigint, bin bigint, p binary, cw binary, shift binary"


def ask_table(askers: list[int], rows: list[tuple]) -> pa.Table:
    return pa.table({"asker": pa.array(askers, pa.int64()), "v": pa.array([r[0] for r in rows], pa.int64()),
                     "bin": pa.array([r[1] for r in rows], pa.int64()), **_arrays(w=[r[2] for r in rows], c=[r[3] for r in rows])})


def merged(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(w, c) of a hot word from its parts' rows."""
    lists = [_vector(t, "w", i) for i in range(len(t))]
    w = _distinct(np.concatenate(lists))
    c = np.zeros(len(w))
    for i, x in enumerate(lists):
        c[np.searchsorted(w, x)] += _vector(t, "c", i)
    return w, c


def hot_asks(parts: DataFrame, answers: DataFrame | None, bins: int) -> DataFrame:
    """What the hot words' restaurants ask of the root, dealt by v: their
    dishes, with one customer each, or (given answers) the tables drawn."""

    def rows(w: np.ndarray, c: np.ndarray, v: int) -> pa.Table:
        of = (_mix(w) % np.uint64(bins)).astype(np.int64)
        some = [(v, int(b), w[of == b], c[of == b]) for b in np.unique(of)]
        return ask_table([-1] * len(some), some)

    def first(t: pa.Table) -> pa.Table:
        w, c = merged(t)
        return rows(w, (c > 0).astype(float), t["v"][0].as_py())

    def later(t: pa.Table, up: pa.Table) -> pa.Table:
        w, c, tables, _ = hot_seated(t, up, bins)
        return rows(w, tables, t["v"][0].as_py())

    by = parts.groupBy("v")
    return by.applyInArrow(first, ASKS) if answers is None else by.cogroup(answers.groupBy("v")).applyInArrow(later, ASKS)


def hot_seated(t: pa.Table, up: pa.Table, bins: int):
    w, c = merged(t)
    of, p0 = (_mix(w) % np.uint64(bins)).astype(np.int64), np.zeros(len(w))
    for i, b in enumerate(up["bin"].to_pylist()):
        p0[of == b] = _vector(up, "p", i)
    rng = np.random.default_rng([SEED, 1, t["v"][0].as_py() & (2 ** 63 - 1)])
    return w, c, *sampled(c, np.zeros(len(w), np.int64), p0, WORD_LAW[1], rng)


def hot_answers(parts: DataFrame, answers: DataFrame, bins: int) -> DataFrame:
    """The hot words' predictions, for each part the ones it asked for."""

    def run(t: pa.Table, up: pa.Table) -> pa.Table:
        w, _, _, p = hot_seated(t, up, bins)
        none = pa.nulls(len(t), pa.binary())
        told = [p[np.searchsorted(w, _vector(t, "w", i))] for i in range(len(t))]
        return pa.table({"asker": t["asker"], "v": t["v"], "bin": t["bin"], **_arrays(p=told), "cw": none, "shift": none})

    return parts.groupBy("v").cogroup(answers.groupBy("v")).applyInArrow(run, ANSWERS)


def over_shares(asked: Asked, answers: DataFrame | None, make, ddl: str, name: str, at: list[str]) -> DataFrame:
    """``make(share number, Share, its answers)`` of every share."""
    shared = asked.packed.sparkSession.sparkContext.broadcast((asked.often, asked.hot))

    def run(t: pa.Table, up: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        return make(t["share"][0].as_py(), Share(t, *shared.value), up)

    by = asked.packed.filter("share >= 0").select("share", "row", "keys", "body").groupBy("share")
    made = by.applyInArrow(lambda t: run(t, None), ddl) if answers is None else by.cogroup(answers.groupBy("asker")).applyInArrow(run, ddl)
    return kept(made, name, at)


class Fitted(NamedTuple):
    asked: Asked
    answers: DataFrame
    bins: int
    folders: list[str]


def fitted(asked: Asked) -> Fitted:
    """The model up to its last level, as what each share is told of it."""
    spark = asked.packed.sparkSession
    bins = max(partitions(spark), asked.n_words // BIN_WORDS)
    spelt, at = [], []
    base = spelled(kept(binned(asked.words, bins), "lm-binned", spelt), spelt)
    discard(spark, spelt[:-1] + asked.folders[:1])

    def first(share: int, s: Share, _) -> pa.Table:
        c = np.bincount(s.of[s.n > 0], minlength=s.pairs).astype(float)
        return s.ask(share, bins, (c > 0).astype(float), c)

    def second(share: int, s: Share, up: pa.Table) -> pa.Table:
        got, rng = s.answers(up, bins), np.random.default_rng([SEED, 2, share])
        c = np.bincount(s.of[s.n > 0], minlength=s.pairs).astype(float)
        t, _ = s.two_words(s.one_word(c, got, rng)[1], rng)
        customers = np.bincount(s.of, t, s.pairs)
        out = s.ask(share, bins, s.one_word(customers, got, rng)[0], customers)
        kept_back = [(None, None, np.zeros(0, np.int64), customers)]
        return pa.concat_tables([out, ask_table([share], kept_back)])

    def level0(asks: DataFrame, hot: DataFrame, at: list[str]) -> DataFrame:
        """The root, given its customers, and what it answers."""
        every, own = asks.filter("bin IS NOT NULL").unionByName(hot), []
        answers = kept(answered(every, root(base, every, own)), "lm-answers", at)
        discard(spark, own)
        return answers

    def told(answers: DataFrame, parts: DataFrame) -> DataFrame:
        return answers.filter("asker >= 0").unionByName(hot_answers(parts, answers.filter("asker < 0"), bins))

    # One table a dish at first; then each level's tables are the next one's customers.
    asks = over_shares(asked, None, first, ASKS, "lm-asks", at)
    parts = asks.filter("v IS NOT NULL")
    answers = level0(asks, kept(hot_asks(parts, None, bins), "lm-hot", at), at)
    last: list[str] = []
    asks = over_shares(asked, told(answers, parts), second, ASKS, "lm-asks", last)
    parts = asks.filter("v IS NOT NULL")
    hot = kept(hot_asks(parts, answers.filter("asker < 0"), bins), "lm-hot", last)
    discard(spark, at)
    answers = level0(asks, hot, last)
    discard(spark, spelt)
    customers = asks.filter("v IS NULL AND bin IS NULL").select(
        "asker", "v", "bin", F.col("c").alias("p"), F.lit(None).cast("binary").alias("cw"), F.lit(None).cast("binary").alias("shift"))
    return Fitted(asked, told(answers, parts).unionByName(customers), bins, last)


def _final(share: int, s: Share, up: pa.Table, bins: int) -> tuple[dict, np.ndarray]:
    got, rng = s.answers(up, bins), np.random.default_rng([SEED, 3, share])
    return got, s.two_words(s.one_word(got["customers"], got, rng)[1], rng)[1]


def fit_words(asked: Asked) -> tuple[DataFrame, int, int]:
    """((u, v, w, cw, shift, p) of every triple asked for, training tokens,
    distinct training words)."""
    model = fitted(asked)
    bins = model.bins

    def run(share: int, s: Share, up: pa.Table) -> pa.Table:
        got, p = _final(share, s, up, bins)
        u, v = s.contexts()
        return pa.table({"u": s.vocabulary[u], "v": s.vocabulary[v], "w": s.vocabulary[s.w],
                         "cw": got["cw"][s.w], "shift": got["shift"][s.w], "p": p})

    rows = over_shares(asked, model.answers, run, "u bigint, v bigint, w bigint, cw bigint, shift double, p double", "lm-model", [])
    return rows, asked.n_all, asked.n_distinct


# --- scores ----------------------------------------------------------------


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    bounded_batches(spark)
    with shuffles_dropped(spark):
        return _scored(docs)


def _scored(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    asked = requests(chunked(docs))
    model = fitted(asked)
    floor = ALPHA * (asked.n_distinct + 1) + asked.n_all
    bins = model.bins

    def run(share: int, s: Share, up: pa.Table) -> pa.Table:
        got, p = _final(share, s, up, bins)
        log = np.log10(p) + got["shift"][s.w]
        cw = got["cw"][s.w]
        base, known = np.log10((cw + ALPHA) / floor), cw > 0
        out = []
        for i in range(len(s.blobs)):
            key, doc, _ = s.keyed(i)
            place, n = np.searchsorted(s.key, key), int(doc.max()) + 1
            of = np.bincount(doc, minlength=n)
            here = np.flatnonzero(of)
            out.append(pa.table({
                "row": here + s.blobs["row"][i].as_py(), "n_tokens": of[here],
                "n_known": np.bincount(doc, known[place], n)[here].astype(np.int64),
                "base_score": np.bincount(doc, base[place], n)[here], "score": np.bincount(doc, log[place], n)[here]}))
        return pa.concat_tables(out)

    sums: list[str] = []
    rows = over_shares(asked, model.answers, run, "row bigint, n_tokens bigint, n_known bigint, base_score double, score double", "lm-sums", sums)
    discard(spark, model.folders)
    texts = asked.packed.filter("share < 0").select("row", "doc_id", "held_out")
    measures = ("n_tokens", "n_known", "base_score", "score")
    total = rows.groupBy("row").agg(*(F.sum(c).alias(c) for c in measures))
    done = stored(texts.join(total, "row").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(asked.n_all).cast("bigint").alias("train_tokens"), "base_score", "score"), "lm-scores")
    discard(spark, sums + asked.folders)
    spark.sql(f"DROP TABLE {asked.table}")
    return done


def perplexity(scores: DataFrame) -> DataFrame:
    """By fold: texts, tokens and the perplexities per token of base and model."""
    per = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scores.groupBy("held_out").agg(
        F.count(F.lit(1)).alias("n_texts"), F.sum("n_tokens").alias("n_tokens"),
        per("base_score").alias("base_perplexity"), per("score").alias("perplexity"))
