"""Near duplicates among embeddings by binary codes of randomly rotated vectors.

Vectors are linked if their cosine (in double precision) is at least
``min_cos``. Equal vectors form a class; one of them stands for it.

1. A unit vector is turned by seeded random rotations. The signs of one turned
   vector are its code; beside it are stored <code, turned vector> as a
   correction factor and the turned vector in eight bits a component. For two
   vectors, <code a, turned b> / factor a is an unbiased estimate of the inner
   product, and its error is bounded but for a chance of ``RISK``: a pair whose
   estimate, either way, lies below ``min_cos`` less the bound needs no
   recomputation.
2. Which pairs meet: signs of further rotations, ``bits`` at a time, are
   buckets. Signs of two vectors at the threshold agree with chance
   1 - acos(min_cos) / pi, each; there are as many tables as leave the pair
   apart in all of them with a chance of ``MISS`` (closer pairs: far less; and
   step 3 makes up for that too). ``bits`` grows with the logarithm of the
   number of vectors, so a bucket holds about ``BUCKET`` unrelated vectors at any size.
   Buckets only say what hangs together: each gives a spanning forest of the
   pairs that the bounds leave, not the pairs.
3. The components of these forests are candidates. Within one, all pairs that
   the bounds leave are recomputed from the vectors, in blocks, and counted;
   again a forest goes on, and its components are the result.

Buckets and candidates with more than ``BLOCK`` vectors are dealt out as pairs
of blocks. Exact links are counted one by one (n_links asks for it), so a
candidate of m distinct vectors costs m * m products; no pair becomes a row.

Null or zero vectors and vectors with a null or non-finite component link with
nothing. Vectors of different lengths do not link. Rows with a null vec_id take
part; a component's id is the smallest vec_id in it (null if it has none).
Repeated rows are links of each other. Columns other than vec_id and embedding
are not read. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import bounded_batches, small_side, stored
from ledgerlake.llm.components import components

MIN_COS = 0.9
#: Chance that one estimate errs by more than its bound.
RISK = 1e-9
#: Chance that a pair exactly at the threshold shares no bucket.
MISS = 1e-4
#: Unrelated vectors that a bucket holds on average.
BUCKET = 256
#: Vectors of a bucket or candidate that a task compares at a time, on either side.
BLOCK = 2048
_HEAD = 8  # bytes of the factor and the step before the components of a code


@functools.lru_cache(maxsize=64)
def rotation(dim: int, number: int) -> np.ndarray:
    """dim rows of a random orthogonal matrix of dim, rounded up to whole
    words of 64, columns."""
    width = -(-dim // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng((20, dim, number)).standard_normal((width, width)))
    return (q * np.sign(np.diag(r)))[:dim]


def unit(vector: list | None) -> np.ndarray | None:
    """The vector at length 1, or None if it can link with nothing."""
    if not vector or any(x is None for x in vector):
        return None
    x = np.array(vector, np.float64)
    most = np.abs(x).max()
    if not np.isfinite(most) or most == 0:
        return None
    x = x / most
    return x / np.sqrt(x @ x)


def codes(units: np.ndarray) -> list[bytes]:
    """(correction factor, step, turned vector in eight bits) of each."""
    turned = units @ rotation(units.shape[1], 0)
    width = turned.shape[1]
    step = np.maximum(np.abs(turned).max(1), 1e-30) / 127
    small = np.rint(turned / step[:, None]).astype(np.int8)
    signs = np.where(small >= 0, 1.0, -1.0)
    factor = (signs * turned).sum(1) / math.sqrt(width)
    heads = np.stack([factor, step], 1).astype("<f4")
    return [h.tobytes() + s.tobytes() for h, s in zip(heads, small)]


def decoded(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(factors, steps, components) of some codes."""
    raw = np.frombuffer(b"".join(payloads), np.uint8).reshape(len(payloads), -1)
    heads = np.ascontiguousarray(raw[:, :_HEAD]).view("<f4").astype(np.float64)
    return heads[:, 0], heads[:, 1], raw[:, _HEAD:].view(np.int8).astype(np.float32)


def lowest(factors: np.ndarray, steps: np.ndarray, width: int, min_cos: float, risk: float) -> tuple[np.ndarray, np.ndarray]:
    """Per vector, the least estimate that a linked pair gives with its code
    (but for a chance of ``risk``), and the bound of its rounding."""
    # the error is sqrt(1 - cos^2) * sqrt(1 - f^2) / f times one coordinate of a random unit vector of width - 1
    tail = math.sqrt(1 - risk ** (2 / (width - 2)))
    error = math.sqrt(1 - min_cos**2) * np.sqrt(np.maximum(0, 1 - factors**2)) / factors * tail
    return min_cos - error, math.sqrt(width) * steps / 2


def possible(a: tuple, b: tuple, min_cos: float, risk: float) -> np.ndarray:
    """Which pairs of two lists of decoded codes the bounds leave."""
    (fa, sa, qa), (fb, sb, qb) = a, b
    width = qa.shape[1]
    root = math.sqrt(width)
    (la, ra), (lb, rb) = lowest(fa, sa, width, min_cos, risk), lowest(fb, sb, width, min_cos, risk)
    one = np.where(qa >= 0, 1, -1).astype(np.float32) @ qb.T * (sb / root) / fa[:, None]
    ok = one >= la[:, None] - rb / fa[:, None] - 1e-4
    two = qa @ np.where(qb >= 0, 1, -1).astype(np.float32).T * (sa / root)[:, None] / fb
    return ok & (two >= lb - ra[:, None] / fb - 1e-4)


def bits_and_tables(n: int, min_cos: float = MIN_COS, miss: float = MISS) -> tuple[int, int]:
    bits = max(4, math.ceil(math.log2(max(n, 2) / BUCKET)))
    meet = (1 - math.acos(min_cos) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-meet)))


def _by_length(vectors: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, unit vectors) of the vectors that can link, by their length."""
    units = [unit(v) for v in vectors]
    for dim in sorted({len(u) for u in units if u is not None}):
        at = [i for i, u in enumerate(units) if u is not None and len(u) == dim]
        yield np.array(at), np.stack([units[i] for i in at])


def features(rows: DataFrame) -> DataFrame:
    """rid, vec_id, embedding, digest of the vector (null: links with nothing)."""
    base = rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests = []
            for v in b.column(2).to_pylist():
                whole = np.array(v, np.float64) + 0.0 if unit(v) is not None else None  # + 0.0: one zero
                digests.append(None if whole is None else hashlib.blake2b(whole.tobytes(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(digests, pa.binary())], names=[*b.schema.names, "digest"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, f"{kinds}, digest binary")


def buckets(reps: DataFrame, bits: int, tables: int) -> DataFrame:
    """(dim, bucket, node, code): a row for each vector and table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes = b.column(0).to_numpy()
            for at, units in _by_length(b.column(1).to_pylist()):
                dim, code = units.shape[1], pa.array(codes(units), pa.binary())
                per = rotation(dim, 1).shape[1] // bits
                for first in range(0, tables, per):
                    signs = units @ rotation(dim, 1 + first // per) >= 0
                    for t in range(first, min(tables, first + per)):
                        word = signs[:, (t - first) * bits:(t - first + 1) * bits] @ (1 << np.arange(bits, dtype=np.int64))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), dim, np.int32)), pa.array((np.int64(t) << 40) | word),
                             pa.array(nodes[at]), code], names=["dim", "bucket", "node", "code"])

    return reps.select("node", "embedding").mapInArrow(run, "dim int, bucket long, node long, code binary")


def in_blocks(rows: DataFrame, keys: list[str], block: int) -> DataFrame:
    """``rows`` with the columns i, j, own, sorted by keys, i, j in each
    partition: groups of more than ``block`` rows as pairs of blocks i <= j."""
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > block).select(
        *keys, F.ceil(F.col("c") / block).cast("int").alias("blocks"))
    marked = rows.join(small_side(large, "codes-large"), keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("blocks").cast("bigint")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
        F.least(own, k).alias("i"), F.greatest(own, k).alias("j")))
    dealt = marked.withColumn("own", own).withColumn("p", F.explode(pairs))
    dealt = dealt.select(*rows.columns, "p.i", "p.j", "own")
    return dealt.repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """((i, j), rows) of each group of sorted batches."""
    names = [*keys, "i", "j"]
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1 if b.num_rows > 1 else np.empty(0, int)
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
            now = tuple(int(c[start]) for c in cols)
            if now != last and held:
                yield last[-2:], pa.Table.from_batches(held)
                held = []
            last = now
            held.append(b.slice(start, end - start))
    if held:
        yield last[-2:], pa.Table.from_batches(held)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Per place the smallest place that the edges (a, b) connect it with."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _sides(where: tuple, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the two blocks of a group."""
    return (np.flatnonzero(own == where[0]), np.flatnonzero(own == where[1]))


def _edges(nodes: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[at]), pa.array(nodes[label[at]])], names=["a", "b"])


def bucket_edges(dealt: DataFrame, min_cos: float, risk: float) -> DataFrame:
    """(a, b): forests of the pairs in each bucket that the bounds leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for where, rows in _groups(batches, ["dim", "bucket"]):
            if rows.num_rows < 2:
                continue
            nodes, own = rows["node"].to_numpy(), rows["own"].to_numpy()
            left, right = _sides(where, own)
            whole = decoded(rows["code"].to_pylist())
            ok = possible(tuple(x[left] for x in whole), tuple(x[right] for x in whole), min_cos, risk)
            a, b = np.nonzero(ok)
            a, b = left[a], right[b]
            differ = a != b
            if differ.any():
                yield _edges(nodes, forest(a[differ], b[differ], len(nodes)))

    return dealt.mapInArrow(run, "a long, b long").distinct()


def exact_links(dealt: DataFrame, min_cos: float, risk: float) -> DataFrame:
    """(node, n, to): links with other classes (in rows), and a node that
    this one is connected with, for each group of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for where, rows in _groups(batches, ["comp"]):
            nodes, own, copies = (rows[c].to_numpy() for c in ("node", "own", "copies"))
            units = np.stack([unit(v) for v in rows["embedding"].to_pylist()])
            left, right = _sides(where, own)
            whole = decoded(codes(units))
            ok = possible(tuple(x[left] for x in whole), tuple(x[right] for x in whole), min_cos, risk)
            lines = np.flatnonzero(ok.any(1))
            linked = np.zeros_like(ok)
            linked[lines] = ok[lines] & (units[left[lines]] @ units[right].T >= min_cos)
            linked &= left[:, None] != right
            n = np.zeros(len(nodes), np.int64)
            n[left] += linked @ copies[right]
            if where[0] != where[1]:
                n[right] += copies[left] @ linked
            a, b = np.nonzero(linked)
            label = forest(left[a], right[b], len(nodes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(n), pa.array(nodes[label])], names=["node", "n", "to"])

    return dealt.mapInArrow(run, "node long, n long, to long")


def link(rows: DataFrame, min_cos: float = MIN_COS, risk: float = RISK, miss: float = MISS,
         block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row. (Rows without an
    id are kept only if their component has no id.)"""
    bounded_batches(rows.sparkSession)
    seen = stored(features(rows), "codes-rows")
    classes = seen.filter(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("rid").alias("node"), F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    classes = stored(classes, "codes-classes")
    reps = seen.select(F.col("rid").alias("node"), "embedding").join(classes.select("node", "copies"), "node")
    reps = stored(reps, "codes-reps")
    bits, tables = bits_and_tables(reps.count(), min_cos, miss)
    met = in_blocks(buckets(reps, bits, tables), ["dim", "bucket"], block)
    candidates = stored(components(stored(bucket_edges(met, min_cos, risk), "codes-candidates")), "codes-components")
    held = reps.join(candidates, "node").select("comp", "node", "copies", "embedding")
    counted = stored(exact_links(in_blocks(held, ["comp"], block), min_cos, risk), "codes-links")
    linked = components(counted.filter("node != to").select(F.col("node").alias("a"), F.col("to").alias("b")))
    of = classes.join(counted.groupBy("node").agg(F.sum("n").alias("n")), "node", "left").join(linked, "node", "left")
    of = stored(of.select("digest", "first_id", F.coalesce("comp", "node").alias("comp"),
                          (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "codes-of")
    ids = of.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    of = of.join(ids, "comp").select("digest", "n_links", "component_id", F.lit(True).alias("links"))
    out = seen.select("vec_id", "digest").join(of, "digest", "left")
    component = F.when(F.col("links"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
