"""Secret scan: fixed patterns, and guess costs of values in credential context.

A value after a word such as ``pwd:`` or ``login is`` counts as a secret if
even the cheapest way of guessing it is expensive. The cost of a value is found
by dynamic programming over its positions: each segment is a known word, a
date, a repeat, a keyboard walk or a brute-force span, costs the log10 of the
number of guesses for a segment of that kind, and the segmentation with the
smallest sum wins. Every step is linear in the value's length.

Base patterns (ASCII, leftmost and non-overlapping per kind; spans are those of
the whole match, in code points, end exclusive): ``assign``, ``access``,
``hex``. Values found by guess cost are added as kind ``guess`` unless they
overlap a base span. Null text counts as empty; an empty text has no spans and
the digest of the empty string. Rows stay rows: repeated rows are scanned and
returned each on their own, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import math
import re

from pyspark.sql import DataFrame

from ledgerlake.llm.common import batch_columns, bounded_batches

KINDS = ("assign", "access", "hex", "guess")

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A maximal run of 24 or more: the same matches as all runs with the short ones dropped.
HEX = re.compile(r"[0-9a-f]{24,}")
CONTEXT = re.compile(
    r"(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code)?|pwd|pin|login|credentials?|secret|token|auth|"
    r"(?:api|access|private)[ _-]?key)[\"']?(?:\x20?(?:=>|->|[:=])\x20?|\x20(?:is|was)\x20)[\"'`]?([^\s\"'`]{6,})",
    re.I | re.A)
HINTS = ("pass", "pwd", "pin", "login", "credential", "secret", "token", "auth", "key")

#: Cost (log10 guesses) of starting one more segment.
SEGMENT_COST = 1.0
#: Values with at least this many log10 guesses are reported.
MIN_LOG10_GUESSES = 10.0
MAX_PERIOD = 16
#: Of a keyboard walk: keys at least, its start, each key, each change of
#: direction (the first direction too), each upper-case letter.
WALK_KEYS = 4
WALK_START, WALK_KEY, TURN, UPPER = math.log10(47), 0.02, math.log10(4.6), math.log10(2)
#: Of a repeat: that it is one, and each copy beyond the second.
REPEAT, COPY = math.log10(2), 0.001

_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_LEET = str.maketrans("430157$@!", "aeoistsai")
_YEAR = r"(?:19|20)\d\d"
_MONTH, _DAY = r"(?:0[1-9]|1[0-2]|[1-9])", r"(?:0[1-9]|[12]\d|3[01]|[1-9])"
_DATES = [re.compile(p) for p in (
    rf"{_YEAR}([-/._]?){_MONTH}\1{_DAY}", rf"{_DAY}([-/._]?){_MONTH}\1{_YEAR}",
    rf"{_MONTH}([-/._]?){_DAY}\1{_YEAR}", _YEAR)]


def _keyboard() -> dict[str, dict[str, int]]:
    """key -> {neighbour: direction} on a staggered US keyboard."""
    at = {c: (r, i) for r, row in enumerate(_ROWS) for i, c in enumerate(row)}
    back = {v: k for k, v in at.items()}
    steps = [(0, -1), (0, 1), (-1, 0), (-1, 1), (1, -1), (1, 0)]
    return {c: {back[(r + dr, i + di)]: k for k, (dr, di) in enumerate(steps) if (r + dr, i + di) in back}
            for c, (r, i) in at.items()}


KEYBOARD = _keyboard()


def ranked_words(vocabulary: str) -> dict[str, int]:
    """Word -> rank from a public tokenizer file (``tokenizers`` JSON whose
    whole words end in ``</w>``, in the order they were learnt). Bounded by the
    file: about 30,000 entries."""
    with open(vocabulary, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    words = sorted((i, w[:-4]) for w, i in vocab.items() if w.endswith("</w>"))
    return {w: r for r, w in enumerate((w for _, w in words if len(w) >= 3 and w.isalpha() and w.isascii()), 1)}


def _alphabet_cost(c: str) -> float:
    if c.isdigit():
        return 1.0
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return math.log10(26)
    return math.log10(33) if c.isascii() else 2.0


def _case_cost(word: str) -> float:
    up = sum(c.isupper() for c in word)
    if not up:
        return 0.0
    if up == len(word) or (up == 1 and word[0].isupper()):
        return math.log10(2)
    return math.log10(sum(math.comb(len(word), k) for k in range(1, min(up, len(word) - up) + 1)) or 2)


def _lower(value: str) -> str:
    low = value.lower()
    return low if len(low) == len(value) else "".join(c.lower() if len(c.lower()) == 1 else c for c in value)


def _word_cost(value: str, low: str, leet: str, words: dict[str, int]) -> float | None:
    """Of a vocabulary word, also with digits and signs for letters."""
    if (rank := words.get(low)) is not None:
        return math.log10(rank + 1) + _case_cost(value)
    if low != leet and (rank := words.get(leet)) is not None:
        return math.log10(rank + 1) + _case_cost(value) + sum(a != b for a, b in zip(low, leet)) * math.log10(2)
    return None


def segments(value: str, words: dict[str, int], longest: int):
    """(start, end, cost) of every word and every date."""
    n, low = len(value), _lower(value)
    leet = low.translate(_LEET)
    for i in range(n):
        for j in range(i + 3, min(n, i + longest) + 1):
            cost = _word_cost(value[i:j], low[i:j], leet[i:j], words)
            if cost is not None:
                yield i, j, cost
        if value[i].isdigit():
            for k, pattern in enumerate(_DATES):
                for j in range(i + 4, min(n, i + 10) + 1):
                    if m := pattern.fullmatch(value, i, j):
                        yield i, j, math.log10(120 * (365 if k < 3 else 1)) + (math.log10(4) if k < 3 and m[1] else 0)


def guess_cost(value: str, words: dict[str, int], longest: int) -> float:
    """log10 of the guesses of the cheapest segmentation into words, dates,
    keyboard walks of four keys or more, repeats (of up to ``MAX_PERIOD``
    characters, three in all or more) and brute-force spans.

    Every walk and every repeat is in the race, not only the longest: a walk
    costs its start, each key and each turn, a repeat its unit and each copy,
    so running walks (by keys so far and direction) and running repeats (by
    period) are states of the programme and it stays linear in the length."""
    n, low = len(value), _lower(value)
    char = [_alphabet_cost(c) for c in value]
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for i, j, cost in segments(value, words, longest):
        ends[j].append((i, cost))
    periods = range(1, min(MAX_PERIOD, n // 2) + 1)
    repeat = {p: [math.inf] * (n + 1) for p in periods}
    run = dict.fromkeys(periods, 0)
    walks: dict[tuple[int, int | None], float] = {}
    best, brute = [0.0] * (n + 1), math.inf
    for j in range(1, n + 1):
        brute = min(brute, best[j - 1] + SEGMENT_COST) + char[j - 1]
        found = [brute, *(best[i] + SEGMENT_COST + cost for i, cost in ends[j])]

        key = WALK_KEY + (UPPER if value[j - 1].isupper() else 0.0)
        now: dict[tuple[int, int | None], float] = {}
        if low[j - 1] in KEYBOARD:
            now[1, None] = best[j - 1] + SEGMENT_COST + WALK_START + key
            way = KEYBOARD.get(low[j - 2], {}).get(low[j - 1]) if j > 1 else None
            if way is not None:
                for (keys, before), cost in walks.items():
                    state = min(keys + 1, WALK_KEYS), way
                    now[state] = min(now.get(state, math.inf), cost + key + (TURN if way != before else 0.0))
        walks = now
        found += [cost for (keys, _), cost in walks.items() if keys == WALK_KEYS]

        for p in periods:
            run[p] = run[p] + 1 if j > p and value[j - 1] == value[j - 1 - p] else 0
            if run[p] >= p:
                more = repeat[p][j - p] + COPY
                copies = 2 if p > 1 else 3  # three characters at least
                if run[p] >= (copies - 1) * p:
                    i = j - copies * p
                    unit = sum(char[i:i + p])
                    if (rank := words.get(low[i:i + p])) is not None:
                        unit = min(unit, math.log10(rank + 1))
                    more = min(more, best[i] + SEGMENT_COST + unit + REPEAT + (copies - 2) * COPY)
                repeat[p][j] = more
                found.append(more)
        best[j] = min(found)
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def guessed_spans(text: str, base, words, longest: int, limit: float):
    """(start, kind number, end) of costly values in credential context that
    touch no base span, and the largest cost met in the text."""
    low = text.lower()
    if not any(h in low for h in HINTS):
        return [], None
    out, top, k = [], None, 0
    by_start = sorted((s, e) for s, _, e in base)
    reach = []  # furthest end so far, so that one look back is enough
    for s, e in by_start:
        reach.append((s, max(e, reach[-1][1]) if reach else e))
    for m in CONTEXT.finditer(text):
        start, end = m.span(1)
        while end > start and text[end - 1] in ".,;:!?)]}":
            end -= 1
        if end - start < 6:
            continue
        cost = guess_cost(text[start:end], words, longest)
        top = cost if top is None else max(top, cost)
        while k < len(reach) and reach[k][0] < end:
            k += 1
        if cost >= limit and not (k and reach[k - 1][1] > start):
            out.append((start, 3, end))
    return out, top


def _join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, vocabulary: str, min_log10_guesses: float = MIN_LOG10_GUESSES) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256,
    spans, n_guess and max_guess_log10 (null without a value in context)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(ranked_words(vocabulary))

    def make():
        words = shared.value
        longest = max(map(len, words), default=0)

        def run(texts):
            out = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess",
                                   "max_guess_log10")}
            for text in texts:
                text = text or ""
                base = base_spans(text)
                extra, top = guessed_spans(text, base, words, longest, min_log10_guesses)
                for k, name in enumerate(("n_assign", "n_access", "n_hex")):
                    out[name].append(sum(x[1] == k for x in base))
                out["base_sha256"].append(hashlib.sha256(_join(base).encode()).hexdigest())
                out["spans"].append(_join(sorted(base + extra)))
                out["n_guess"].append(len(extra))
                out["max_guess_log10"].append(top)
            return out

        return run

    return batch_columns(docs, ["doc_id"], ["text"], make, {
        "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string",
        "spans": "string", "n_guess": "bigint", "max_guess_log10": "double"})
