"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at both ends and with A-Z
lower-cased; keys of at least ``MIN_CHARS`` code points count, by a 128-bit
hash. ``LineRuns`` holds sorted runs in the shared folder: each new batch of
documents is aggregated to (hash, documents, largest doc_id), anti-joined with
the runs (sort-merge) and added as a run of level 0 of its new hashes; what it
adds to known hashes goes to a run of increments beside it. ``fan_in`` runs of
a level are compacted into one of the next.

``deduplicate`` then drops the lines whose key is in at least ``MIN_DOCS``
documents, except in the largest doc_id that holds it.

Each row is a document. Null or empty text is one empty line, which stays. A
null doc_id is smaller than all others: such a row never keeps a repeated line
that a row with an id holds; if all holders lack an id, all keep it. Repeated
rows with the largest doc_id all keep their lines. Other columns pass through.

A hot line is summed before each shuffle; where its occurrences meet the table
of repeated keys, the join is one that AQE can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import ASCII_SPACE, batch_columns, bounded_batches, fresh_name, named, stage_folder, stored

MIN_CHARS = 40
MIN_DOCS = 5
#: Batches that ``deduplicate`` cuts a table into, by ranges of doc_id.
BATCHES = 4
FAN_IN = 2


def line_key(line: bytes) -> bytes | None:
    """The hash of a line's key, or None for a short one."""
    key = line.strip(ASCII_SPACE)
    if len(key) < MIN_CHARS or (not key.isascii() and len(key.decode("utf-8", "replace")) < MIN_CHARS):
        return None
    return hashlib.blake2b(key.lower(), digest_size=16).digest()


def line_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, h): the keys of each row, each once a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, found = [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                keys = {k for s in (text or "").encode().split(b"\n") if (k := line_key(s))}
                rows += [i] * len(keys)
                found += keys
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())), pa.array(found, pa.binary())], names=["doc_id", "h"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, h binary")


class LineRuns:
    """Levels of sorted runs of (h, n_docs, last_doc, fresh).

    Every hash is fresh in exactly one run: where it was new when its batch
    came. Other runs may hold increments of its count."""

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN):
        self.spark, self.fan_in = spark, fan_in
        self.folder = stage_folder(spark, "line-runs")
        self.levels: dict[int, list[str]] = {}
        self.schema, self._made = None, 0

    def _write(self, df: DataFrame) -> str:
        self._made += 1
        path = f"{self.folder}/run-{self._made:05d}"
        df.sortWithinPartitions("h").write.parquet(path)
        self.schema = self.schema or df.schema
        return path

    @property
    def runs(self) -> list[str]:
        return [p for level in sorted(self.levels) for p in self.levels[level]]

    def read(self, paths: list[str] | None = None) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*(paths or self.runs))

    def add(self, docs: DataFrame) -> None:
        """Merge-anti-join a batch with the runs and add its own run. (The
        join keeps the batch's known hashes too, as increments.)"""
        own = line_keys(docs).groupBy("h").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
        if self.runs:
            known = self.read().filter("fresh").select("h", F.lit(True).alias("known"))
            own = own.join(known.hint("merge"), "h", "left").withColumn("fresh", F.col("known").isNull()).drop("known")
        else:
            own = own.withColumn("fresh", F.lit(True))
        self.levels.setdefault(0, []).append(self._write(own))
        self.compact()

    def compact(self) -> None:
        """Merge every level that holds ``fan_in`` runs into one of the next."""
        level = 0
        while level in self.levels:
            if len(paths := self.levels[level]) >= self.fan_in:
                self.levels.setdefault(level + 1, []).append(self._write(self.merged(paths)))
                self.levels[level] = []
            level += 1

    def merged(self, paths: list[str] | None = None) -> DataFrame:
        """One row per hash over some runs (all of them by default)."""
        return self.read(paths).groupBy("h").agg(
            F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"), F.max("fresh").alias("fresh"))


def in_batches(docs: DataFrame, batches: int = BATCHES) -> list[DataFrame]:
    """``docs`` by ranges of doc_id of equal width (pushed to the scan); rows
    without an id are in the first."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None or batches < 2 or high - low < batches:
        return [docs]
    cuts = [low + (high - low) * k // batches for k in range(1, batches)]
    d = F.col("doc_id")
    first, last = docs.filter(d.isNull() | (d < cuts[0])), docs.filter(d >= cuts[-1])
    return [first, *(docs.filter((d >= a) & (d < b)) for a, b in zip(cuts, cuts[1:])), last]


def with_drops(docs: DataFrame, name: str, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``docs`` and an array column ``name`` of the line hashes to drop there
    (null: none)."""
    bounded_batches(docs.sparkSession)
    runs = LineRuns(docs.sparkSession)
    for batch in in_batches(docs.select("doc_id", "text"), batches):
        runs.add(batch)
    repeated = runs.merged().filter((F.col("n_docs") >= min_docs) & F.col("last_doc").isNotNull())
    repeated = stored(repeated, "repeated-lines")  # a plain shuffle on this side lets AQE split a hot line on the other
    held = line_keys(docs).join(repeated.select("h", "last_doc").hint("merge"), "h")
    held = held.filter(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("last_doc")))
    key = fresh_name(docs, "_drop_id")
    drops = held.groupBy(F.col("doc_id").alias(key)).agg(F.collect_set("h").alias(name))
    met = docs.join(drops, docs["doc_id"].eqNullSafe(drops[key]), "left")
    return met.select(*[named(c) for c in docs.columns], name)


def kept_lines(text: str | None, drop: list[bytes] | None) -> tuple[int, int, str]:
    """(lines, lines dropped, the text without them)."""
    lines = (text or "").encode().split(b"\n")
    if not drop:
        return len(lines), 0, text or ""
    gone = set(drop)
    kept = [s for s in lines if line_key(s) not in gone]
    return len(lines), len(lines) - len(kept), b"\n".join(kept).decode()


def deduplicate(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``docs`` (all its columns) without the repeated lines in ``text``. A
    null text stays null."""
    name = fresh_name(docs, "_drops")
    marked = with_drops(docs, name, min_docs, batches)
    others = [c for c in docs.columns if c != "text"]

    def make():
        return lambda texts, drops: {
            "text": [t if t is None or not d else kept_lines(t, d)[2] for t, d in zip(texts, drops)]}

    return batch_columns(marked, others, ["text", name], make, {"text": "string"}).select(
        *[named(c) for c in docs.columns])


def line_digests(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every row."""
    marked = with_drops(docs.select("doc_id", "text"), "_drops", min_docs, batches)

    def make():
        def run(texts, drops):
            out = {"n_lines": [], "n_dropped": [], "kept_sha256": []}
            for t, d in zip(texts, drops):
                n, dropped, kept = kept_lines(t, d)
                out["n_lines"].append(n)
                out["n_dropped"].append(dropped)
                out["kept_sha256"].append(hashlib.sha256(kept.encode()).hexdigest())
            return out

        return run

    return batch_columns(marked, ["doc_id"], ["text", "_drops"], make,
                         {"n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"})
