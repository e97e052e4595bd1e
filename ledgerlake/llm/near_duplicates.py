"""Near duplicates by bottom-k sketches of one hash function.

A document's set holds the distinct shingles of its words (maximal runs
outside ``[\\x20\\x09-\\x0D]``, A-Z lower-cased); with fewer words than a
shingle the whole sequence is the one element, without words the set is empty
and the document is linked with nothing. Documents are linked if their sets'
Jaccard similarity is at least ``min_pct`` percent.

1. Documents with equal sets form a class; one of them stands for it.
2. The ``K`` smallest hashes of a set are its sketch. Of two linked sets, the
   sketches share at least ``least_shared`` values but for a chance below
   ``RISK`` a pair (sets of at most K shingles: for certain). So they share one
   of the rarest values of each sketch: only the first (values - least shared
   + 1) by corpus frequency go to the inverted lists, and frequent passages
   drop out.
3. Lists give pairs. Each list first links its documents to two of them (stars,
   not all pairs); what is connected by then needs no more pairs. The
   documents of lists that still hold several components are indexed anew by
   their whole sets, each by its rarest shingles only (a linked pair shares one
   of them for certain), and these lists give the pairs between components: a
   passage that many different documents share gives none.
4. The union sketch (the K smallest values of both sketches) estimates the
   similarity; pairs below the bound of step 2 go.
5. The rest is verified on the full sets of words. Verified links give the
   components (alternating stars, in the shared folder).

Rows with a null doc_id take part; a component's id is the smallest doc_id in
it (null if it has none). Repeated rows are copies of each other.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import batch_columns, bounded_batches, named, stored
from ledgerlake.llm.components import components

SHINGLE_WORDS = 3
MIN_PCT = 85
K = 64
#: Chance that one linked pair shares fewer values than assumed.
RISK = 1e-9
#: Star rounds before the remaining pairs are taken from whole sets.
STAR_ROUNDS = 1
#: Word hashes kept by a Python worker.
WORD_MEMO = 500_000
_MIX = [np.uint64(pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64)) for i in range(64)]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def word_set(text: str | None, size: int) -> set:
    """The shingles themselves."""
    w = words_of(text)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return set(zip(*[w[i:] for i in range(size)]))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_MEMO:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def hashed_set(words: list[bytes], size: int, hashes: dict) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    if not words:
        return np.empty(0, np.int64)
    h = np.array([hashes[w] for w in words], np.uint64)
    k = min(size, len(h))
    n = len(h) - k + 1
    x = np.full(n, np.uint64(k))
    for i in range(k):
        x = (x ^ (h[i:i + n] * _MIX[i % 64])) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return np.unique((x ^ (x >> np.uint64(32))).view(np.int64))


def parity_bits(hashes: np.ndarray) -> list[int]:
    """256 bits, each the parity of the values that fall on it: two sets'
    bits differ in no more places than their values do."""
    at = hashes.view(np.uint64)
    odd = (np.bincount(((at >> np.uint64(5)) & np.uint64(255)).astype(np.int64), minlength=256) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).tolist()


def least_shared(k: int, pct: int, risk: float = RISK) -> int:
    """The largest t with P(Binomial(k, pct%) < t) <= risk: of the k smallest
    values of the union, a pair at the similarity bound shares t or more."""
    p, total, t = pct / 100, 0.0, 0
    while t < k:
        total += math.comb(k, t) * p**t * (1 - p) ** (k - t)
        if total > risk:
            break
        t += 1
    return t


def features(docs: DataFrame, size: int) -> DataFrame:
    """rid, doc_id, text, row (the other columns, if any), n, digest, sketch,
    bits."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    base = docs.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", "text",
        *([F.struct(*[named(c) for c in others]).alias("row")] if others else []))

    def make():
        hashes = _Hashes()

        def run(texts):
            out = {"n": [], "digest": [], "sketch": [], "bits": []}
            for t in texts:
                s = hashed_set(words_of(t), size, hashes)
                out["n"].append(len(s))
                out["digest"].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                out["sketch"].append(s[:K])
                out["bits"].append(parity_bits(s))
            return out

        return run

    return batch_columns(base, base.columns, ["text"], make,
                         {"n": "bigint", "digest": "binary", "sketch": "array<bigint>", "bits": "array<bigint>"})


def _prefixes(held: DataFrame, least) -> DataFrame:
    """(v, node, n, rest, hub): the inverted lists of each node's rarest
    values. ``held``: (node, n, v); a linked pair shares at least ``least``
    values of either. ``rest``: values of the node from v on that others hold
    too; ``hub``: how common its values are."""
    counts = held.groupBy("v").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    own = held.join(counts, "v").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("c", "v"))).alias("vs"), (F.sum("c") / F.col("n")).alias("hub"))
    first = F.size("vs") - least.cast("int") + 1  # the values that no other document holds come before these
    return own.filter(first > 0).select(
        "node", "n", "hub", F.size("vs").alias("m"), F.posexplode(F.slice("vs", F.lit(1), first)).alias("at", "x")
    ).select(F.col("x.v").alias("v"), "node", "n", (F.col("m") - F.col("at")).alias("rest"), "hub")


def _least_of(pct: int):
    return F.ceil(F.col("n") * F.lit(pct) / F.lit(100.0))


def _lists(reps: DataFrame, pct: int) -> DataFrame:
    """The inverted lists of retained values."""
    held = reps.select("node", "n", F.explode("sketch").alias("v"))
    return _prefixes(held, F.least(_least_of(pct), F.lit(least_shared(K, pct))))


def _whole_lists(nodes: DataFrame, texts: DataFrame, size: int, pct: int) -> DataFrame:
    """The inverted lists of some nodes' whole sets."""

    def run(batches):
        hashes = _Hashes()
        for b in batches:
            sets = [hashed_set(words_of(t), size, hashes) for t in b.column(1).to_pylist()]
            sizes = np.array([len(x) for x in sets], np.int64)
            rows = np.repeat(np.arange(len(sets)), sizes)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows)), pa.array(sizes[rows]),
                 pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64))], names=["node", "n", "v"])

    picked = texts.join(nodes.select(F.col("node").alias("rid")), "rid").select(F.col("rid").alias("node"), "text")
    held = stored(picked.mapInArrow(run, "node bigint, n bigint, v bigint"), "near-whole-sets")
    return _prefixes(held, _least_of(pct))


def _verified(pairs: DataFrame, reps: DataFrame, texts: DataFrame, size: int, pct: int) -> DataFrame:
    """The pairs (a, b) that the union sketch lets through and the full sets
    confirm."""
    side = reps.select("node", "n", "sketch")
    a = side.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = side.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    met = pairs.join(a, "a").join(b, "b")
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, K)
    shared = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    whole = (F.col("na") <= K) & (F.col("nb") <= K)
    all_shared = F.size(F.array_intersect("sa", "sb"))
    likely = F.when(
        whole, 100 * all_shared >= pct * (F.col("na") + F.col("nb") - all_shared)
    ).otherwise(shared >= least_shared(K, pct))
    sized = 100 * F.least("na", "nb") >= pct * F.greatest("na", "nb")
    left = met.filter(sized).filter(likely).select("a", "b")
    ta = texts.select(F.col("rid").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("rid").alias("b"), F.col("text").alias("tb"))

    def make():
        def run(xs, ys):
            ok, last = [], (None, None)
            for x, y in zip(xs, ys):
                if last[0] != x:
                    last = (x, word_set(x, size))
                s, t = last[1], word_set(y, size)
                both = len(s & t)
                ok.append(100 * both >= pct * (len(s) + len(t) - both))
            return {"ok": ok}

        return run

    with_texts = left.join(tb, "b").join(ta, "a")  # a text of many pairs arrives sorted: its set is built once
    return batch_columns(with_texts, ["a", "b"], ["ta", "tb"], make, {"ok": "boolean"}).filter("ok").drop("ok")


def _labelled(lists: DataFrame, comps: DataFrame | None) -> DataFrame:
    """The lists with each node's component so far, without the lists that
    hold one component only."""
    if comps is None:
        lists = lists.withColumn("comp", F.col("node"))
    else:
        lists = lists.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = lists.groupBy("v").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi").select("v")
    return lists.join(mixed, "v")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _star_pairs(lists: DataFrame, turn: int) -> DataFrame:
    """Each list's documents with the one whose values are the most common
    (the least edited of near copies), and with one picked by a hash."""
    heads = lists.groupBy("v").agg(
        F.max_by("node", "hub").alias("p"), F.min_by("node", F.xxhash64("node", "v", F.lit(turn))).alias("q"))
    met = lists.join(heads, "v").select("comp", F.col("node").alias("x"), F.explode(F.array("p", "q")).alias("y"))
    return _ordered(met.filter("x != y"))


def _rest_pairs(lists: DataFrame, pct: int) -> DataFrame:
    """The pairs between components whose sets can be similar enough: from
    the first value that two sets share on, either must hold as many values as
    the pair has to share; and the parity bits may not differ in more places
    than two sets of these sizes may."""
    left = lists.select("v", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("comp").alias("cx"),
                        F.col("rest").alias("rx"), F.col("bits").alias("bx"))
    right = lists.select("v", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("comp").alias("cy"),
                         F.col("rest").alias("ry"), F.col("bits").alias("by"))
    sized = (100 * F.col("nx") >= pct * F.col("ny")) & (100 * F.col("ny") >= pct * F.col("nx"))
    enough = (100 + pct) * F.least("rx", "ry") >= pct * (F.col("nx") + F.col("ny"))
    apart = sum((F.bit_count(F.col("bx")[k].bitwiseXOR(F.col("by")[k])) for k in range(1, 4)),
                F.bit_count(F.col("bx")[0].bitwiseXOR(F.col("by")[0])))
    close = (100 + pct) * apart <= (100 - pct) * (F.col("nx") + F.col("ny"))
    return _ordered(left.join(right, "v").filter((F.col("cx") < F.col("cy")) & sized & enough & close))


def labelled(docs: DataFrame, size: int = SHINGLE_WORDS, pct: int = MIN_PCT) -> tuple[DataFrame, DataFrame]:
    """(features, labels): features as stored, and per row rid, doc_id, n,
    node (its class), comp, component_id."""
    bounded_batches(docs.sparkSession)
    rows = stored(features(docs, size), "near-features")
    classes = stored(rows.filter("n > 0").groupBy("digest").agg(
        F.min("rid").alias("node"), F.min("doc_id").alias("first_id")), "near-classes")
    reps = rows.select(F.col("rid").alias("node"), "n", "sketch", "bits").join(classes.select("node"), "node")
    reps = stored(reps, "near-reps")
    texts = rows.select("rid", "text")
    lists = stored(_lists(reps, pct), "near-lists")
    edges = tested = comps = None
    for turn in range(STAR_ROUNDS + 1):
        mixed = _labelled(lists, comps)
        if turn < STAR_ROUNDS:
            pairs = _star_pairs(mixed, turn)
        else:
            whole = stored(_whole_lists(mixed.select("node").distinct(), texts, size, pct), "near-whole-lists")
            pairs = _rest_pairs(_labelled(whole, comps).join(reps.select("node", "bits"), "node"), pct)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "near-pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = stored(_verified(pairs, reps, texts, size, pct), "near-edges")
        edges = found if edges is None else edges.unionByName(found)
        comps = stored(components(edges), "near-components")
    of = classes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    ids = of.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    of = of.join(ids, "comp").select("digest", "node", "comp", "component_id")
    slim = rows.select("rid", "doc_id", "n", F.when(F.col("n") > 0, F.col("digest")).alias("digest"))
    return rows, slim.join(of, "digest", "left").select(
        "rid", "doc_id", "n", "node", "comp",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def classify(docs: DataFrame, size: int = SHINGLE_WORDS, pct: int = MIN_PCT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row. (Rows without
    an id are kept only if their component has no id.)"""
    _, labels = labelled(docs.select("doc_id", "text"), size, pct)
    return labels.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                         F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def distinct_documents(docs: DataFrame, size: int = SHINGLE_WORDS, pct: int = MIN_PCT) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: one of each component,
    with its smallest doc_id, and every row without words."""
    rows, labels = labelled(docs, size, pct)
    first = labels.filter((F.col("n") > 0) & F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = first.groupBy("comp").agg(F.min("rid").alias("rid")).select("rid").unionByName(
        labels.filter("n = 0").select("rid"))
    kept = rows.join(stay, "rid")
    return kept.select(*[named(c) if c in ("doc_id", "text") else F.col("row").getField(c).alias(c) for c in docs.columns])
