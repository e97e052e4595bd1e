"""Spelling variants: words that differ by one edit, found by finite-state
composition.

1. Runs of letters are counted over all documents (each batch sums its own
   words before the shuffle).
2. Two words are near if one inserted, deleted or replaced code point turns
   one into the other. With m the length of the shorter one (the longer has m
   or m + 1), such words share their first or their last m // 2 code points. So
   the vocabulary is dealt out by (m, first half) and, reversed, by (m, last
   half): these are the initial states of the composition. The words of one
   initial state give two minimised acceptors, L (words of length m) and R (of
   length m or m + 1), and the accepted pairs of L o (one edit) o R are
   enumerated. A pair comes up once: the edit stands at the first place where
   the two differ, of two words of one length the smaller code point there is
   on the left, and the reversed words leave out pairs with equal first halves.
3. Initial states with more than ``BLOCK_WORDS`` words are dealt out again:
   blocks of L meet blocks of R, so a task holds two blocks at a time.
4. A word's form is its near word of the largest count, if that is at least
   ``FORM_TIMES`` times its own; roots are reached by doubling the steps, each
   round being written to the shared folder. Counts grow at every step, so the
   rounds are few (log2 of log5 of the largest count).

Null and empty texts hold no word. A null doc_id counts as the empty string in
the deletion rule. Repeated rows count again. Columns other than doc_id and
text are not read. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import bounded_batches, small_side, stored

MIN_LENGTH = 6
MIN_COUNT = 5
#: One distinct run of a document in so many loses a code point.
DELETE_EVERY = 199
#: A form is at least so many times as frequent as the word.
FORM_TIMES = 5
#: Words of one initial state that a task takes at a time, on either side.
BLOCK_WORDS = 4096
RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def words_in(doc_id, text: str | None, every: int = DELETE_EVERY) -> Counter:
    """The words of one text (of any length) and how often they occur."""
    found: Counter = Counter()
    name = "" if doc_id is None else str(doc_id)
    for run, n in Counter(RUN.findall((text or "").translate(_LOWER))).items():
        h = zlib.crc32(f"{name}:{run}".encode())
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        found[run] += n
    return found


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
               every: int = DELETE_EVERY) -> DataFrame:
    """(word, n) of the words of at least ``min_length`` code points that
    occur ``min_count`` times or more."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total: Counter = Counter()
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for word, n in words_in(i, t, every).items():
                    if len(word) >= min_length:
                        total[word] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class Acceptors:
    """Minimised acyclic acceptors over one register: equal right languages
    are one state, within an acceptor and between the two sides."""

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._register: dict[tuple, int] = {}
        self._common: dict[tuple[int, int], list[str]] = {}

    def _state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, *arcs.items())
        state = self._register.get(key)
        if state is None:
            state = self._register[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return state

    def add(self, words: list[str]) -> int:
        """The initial state of the minimised acceptor of sorted distinct
        ``words``: a state is registered when no later word can change it."""
        path: list[tuple[str, dict, bool]] = []  # open states below the initial one: (arc to it, its arcs, final)
        top: dict[str, int] = {}
        top_final = False
        last = ""

        def close(depth: int) -> None:
            while len(path) > depth:
                ch, arcs, final = path.pop()
                (path[-1][1] if path else top)[ch] = self._state(final, arcs)

        for word in words:
            shared = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                shared += 1
            close(shared)
            for ch in word[shared:]:
                path.append((ch, {}, False))
            if path:
                path[-1] = (path[-1][0], path[-1][1], True)
            else:
                top_final = True
            last = word
        close(0)
        return self._state(top_final, top)

    def common(self, p: int, q: int) -> list[str]:
        """The strings that lead from both states to a final one (the
        composed states after the edit)."""
        got = self._common.get((p, q))
        if got is None:
            got, steps = [], [(p, q, "")]
            while steps:
                p2, q2, s = steps.pop()
                if self.final[p2] and self.final[q2]:
                    got.append(s)
                theirs = self.arcs[q2]
                for ch, p3 in self.arcs[p2].items():
                    if (q3 := theirs.get(ch)) is not None:
                        steps.append((p3, q3, s + ch))
            self._common[p, q] = got
        return got

    def one_edit(self, p: int, q: int) -> Iterator[tuple[str, str]]:
        """The accepted pairs (x, y) of the composition from the states p and
        q before the edit: y is x with one code point replaced by a larger one
        or with one inserted, at the first place where they differ."""
        steps = [(p, q, "")]
        while steps:
            p, q, s = steps.pop()
            left = self.arcs[p]
            for b, q2 in self.arcs[q].items():
                for a, p2 in left.items():
                    if a < b:
                        for t in self.common(p2, q2):
                            yield s + a + t, s + b + t
                    if a != b and (q3 := self.arcs[q2].get(a)) is not None:
                        for t in self.common(p2, q3):
                            yield s + a + t, s + b + a + t
                if self.final[p] and self.final[q2]:
                    yield s, s + b
                if (p2 := left.get(b)) is not None:
                    steps.append((p2, q2, s + b))


def _compose(affix: str, reverse: bool, left: dict[str, int], right: dict[str, int]) -> Iterator[tuple]:
    """(x, n of x, y, n of y) for the near words of one initial state."""
    k = len(affix)
    turned = (lambda w: w[::-1]) if reverse else (lambda w: w)
    both = Acceptors()
    p = both.add(sorted(turned(w)[k:] for w in left))
    q = both.add(sorted(turned(w)[k:] for w in right))
    for x, y in both.one_edit(p, q):
        x, y = turned(affix + x), turned(affix + y)
        if not (reverse and x[:k] == y[:k]):
            yield x, left[x], y, right[y]


def _enumerate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs, both ways, of sorted rows (initial state, blocks, word)."""
    state, left, right, out = None, {}, {}, []

    def flush() -> Iterator[pa.RecordBatch]:
        cols = list(zip(*out)) if out else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0] + cols[2], pa.string()), pa.array(cols[1] + cols[3], pa.int64()),
             pa.array(cols[2] + cols[0], pa.string()), pa.array(cols[3] + cols[1], pa.int64())],
            names=["word", "n", "near", "near_n"])
        out.clear()

    def close() -> Iterator[pa.RecordBatch]:
        if state is None or not left or len(right) < 2 and left.keys() >= right.keys():
            return
        for pair in _compose(state[2], state[0], left, right):
            out.append(pair)
            if len(out) >= 50_000:
                yield from flush()

    for b in batches:
        cols = [b.column(i).to_pylist() for i in range(b.num_columns)]
        for reverse, m, affix, i, j, is_left, is_right, word, n in zip(*cols):
            if (now := (reverse, m, affix, i, j)) != state:
                yield from close()
                state, left, right = now, {}, {}
            if is_left:
                left[word] = n
            if is_right:
                right[word] = n
    yield from close()
    yield from flush()


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of near words among
    ``words`` (word, n; distinct words of ``min_length`` >= 2 code points or
    more)."""
    shorter = F.explode(F.filter(F.array(F.col("len") - 1, F.col("len")), lambda m: m >= min_length))
    dealt = words.select("word", "n", F.length("word").alias("len")).select("*", shorter.alias("m"))
    half = (F.col("m") / 2).cast("int")
    dealt = dealt.select("word", "n", "m", (F.col("len") == F.col("m")).alias("short"), F.explode(F.array(
        F.struct(F.lit(False).alias("reverse"), F.expr("left(word, cast(m / 2 as int))").alias("affix")),
        F.struct(F.lit(True).alias("reverse"), F.reverse(F.expr("right(word, cast(m / 2 as int))")).alias("affix")),
    )).alias("s"), half.alias("k")).select("s.reverse", "m", "s.affix", "short", "word", "n")
    state = ["reverse", "m", "affix"]
    large = dealt.groupBy(*state).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > block_words).select(
        *state, F.ceil(F.col("c") / block_words).cast("int").alias("blocks"))
    marked = dealt.join(small_side(large, "spelling-large"), state, "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("blocks").cast("bigint")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    as_left = F.transform(every, lambda j: F.struct(
        own.alias("i"), j.alias("j"), F.lit(True).alias("is_left"), F.lit(False).alias("is_right")))
    as_right = F.transform(every, lambda i: F.struct(
        i.alias("i"), own.alias("j"), F.lit(False).alias("is_left"), F.lit(True).alias("is_right")))
    alone = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.col("short").alias("is_left"),
                             F.lit(True).alias("is_right")))
    places = F.when(F.col("blocks") == 1, alone).when(F.col("short"), F.concat(as_left, as_right)).otherwise(as_right)
    placed = marked.select(*state, "word", "n", F.explode(places).alias("p")).select(
        *state, "p.i", "p.j", "p.is_left", "p.is_right", "word", "n")
    order = [*state, "i", "j"]
    grouped = placed.repartition(*order).sortWithinPartitions(*order)
    return grouped.mapInArrow(_enumerate, "word string, n bigint, near string, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every row of ``forms`` (word, form): forms followed to
    the last word, with doubled steps."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = stored(now.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling-roots")
        now = step.select("word", "root")
        if step.filter("moved").limit(1).count() == 0:
            return now


def group_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                   form_times: int = FORM_TIMES, every: int = DELETE_EVERY,
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``docs``."""
    words = stored(vocabulary(docs, min_length, min_count, every), "spelling-words")
    pairs = near_words(words, min_length, block_words)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))  # code-point order: of UTF-8 bytes
    met = pairs.groupBy("word").agg(F.max("n").alias("own"), F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    often = -F.col("best.minus") >= F.lit(form_times) * F.col("own")
    met = stored(met.select("word", "n_near", F.when(often, F.col("best.near")).alias("form"),
                            F.when(often, -F.col("best.minus")).alias("form_n")), "spelling-near")
    last = roots(met.filter(F.col("form").isNotNull()))
    return words.join(met, "word", "left").join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")
