"""SentencePiece BPE: encoding by a table of prefixes, and decoding.

A byte-pair encoding is determined prefix by prefix: each prefix of a word has
exactly one last token, the vocabulary piece that ends there and that the last
token of the prefix before it may precede. For every position the pieces that
end there come from an Aho-Corasick automaton over the vocabulary; a piece fits
if merging the two-token text alone gives those two tokens back (the
pair-compatibility test, memorised). The ids are then read backwards from the
end of the word.

The test needs no merging where the merges of both tokens, and those across
their border, make pieces that rank after their parts: merges then happen in
the order of their ranks, both tokens are built as they are alone, and the pair
breaks only if a merge across the border ranks before the one that takes up
either edge symbol. The edge symbols of a piece and the ranks that take them up
are found once by merging the piece alone. Other pairs are merged.

Words: no piece has U+2581 after another character, so merges never cross the
place before a U+2581 that follows another character. Texts are cut there and
each distinct word is encoded once (a bounded memo of recent words).
A character that no piece covers becomes its UTF-8 byte pieces.

Null text counts as empty; an empty text is the end id alone and decodes to "".
"""

from __future__ import annotations

import hashlib
import heapq
import re

from pyspark.sql import DataFrame

from ledgerlake.llm.common import batch_columns, bounded_batches

SPACE = "▁"
#: Entries of the word memo (two generations of it are kept) and of the pair memo of a worker.
MEMO_ENTRIES = 350_000
PAIR_ENTRIES = 1_000_000
#: Marks the memo's entry of a word that does not decode to itself.
ODD = "\0"
_WORDS = re.compile(" *[^ ]+| +")


class Pieces:
    """The vocabulary of a model file, as plain tables (sent to the tasks)."""

    def __init__(self, model_file: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = m.get_piece_size()
        self.key = hashlib.sha256(m.serialized_model_proto()).hexdigest()
        self.eos = m.eos_id()
        self.unk = m.unk_id()
        self.score, self.id, self.byte_id, self.surface = {}, {}, {}, [b""] * n
        for i in range(n):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.surface[i] = bytes([int(piece[3:5], 16)])
            elif m.is_unknown(i):
                self.surface[i] = " ⁇ ".encode()
            elif not m.is_control(i):
                self.score[piece], self.id[piece] = m.get_score(i), i
                self.surface[i] = piece.replace(SPACE, " ").encode()
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("a piece has U+2581 after another character; words cannot be cut there")
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte pieces")


def merged(text: str, score: dict[str, float]) -> list[str]:
    """Plain byte-pair merging of a short text: the best-scored adjacent pair
    first, the leftmost of equals."""
    sym: list[str | None] = list(text)
    nxt, prv = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
    heap: list[tuple[float, int, str, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and nxt[i] < len(sym) and (s := score.get(sym[i] + sym[nxt[i]])) is not None:
            heapq.heappush(heap, (-s, i, sym[i], sym[nxt[i]]))

    for i in range(len(sym) - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        if sym[i] != a or nxt[i] >= len(sym) or sym[nxt[i]] != b:
            continue
        j = nxt[i]
        sym[i], sym[j] = a + b, None
        nxt[i] = nxt[j]
        if nxt[j] < len(sym):
            prv[nxt[j]] = i
        offer(prv[i])
        offer(i)
    return [s for s in sym if s is not None]


def edges(piece: str, score: dict[str, float]) -> tuple[list, list] | None:
    """The symbols that stand at the left and at the right edge while
    ``piece`` is merged alone, each with the score of the merge that takes it
    up (the whole piece: -inf); None if merging does not give the piece, or
    not in the order of ranks."""
    none = float("-inf")
    sym, now = list(piece), float("inf")
    left, right = [sym[0]], [sym[-1]]
    taken: tuple[list[float], list[float]] = ([], [])
    while len(sym) > 1:
        best, i = max((score.get(sym[k] + sym[k + 1], none), -k) for k in range(len(sym) - 1))
        if best == none or best > now:
            return None
        now, i = best, -i
        sym[i:i + 2] = [sym[i] + sym[i + 1]]
        for side, at, edge in ((0, 0, left), (1, -1, right)):
            if sym[at] != edge[-1]:
                edge.append(sym[at])
                taken[side].append(best)
    return list(zip(left, [*taken[0], none])), list(zip(right, [*taken[1], none]))


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, pieces: Pieces):
        import ahocorasick

        self.p = pieces
        self.automaton = ahocorasick.Automaton()
        for piece in pieces.id:
            self.automaton.add_word(piece, (piece, len(piece), {}))
        self.automaton.make_automaton()
        self.pairs = 0
        self.id_text = {piece: str(i) for piece, i in pieces.id.items()}
        self.memo = _Words(self)
        self.edges: dict[str, tuple | None] = {}

    def _edges(self, piece: str) -> tuple | None:
        if piece not in self.edges:
            self.edges[piece] = edges(piece, self.p.score)
        return self.edges[piece]

    def _compatible(self, before: str, piece: str) -> bool:
        """Whether merging ``before + piece`` gives these two tokens back."""
        score = self.p.score
        own, other = self._edges(piece), self._edges(before) if before else None
        if own is None or before and other is None:
            return merged(before + piece, score) == ([before, piece] if before else [piece])
        broken = False
        for a, a_taken in other[1] if before else ():
            for b, b_taken in own[0]:
                if (across := score.get(a + b)) is not None:
                    if len(a) > 1 and across > score[a] or len(b) > 1 and across > score[b]:
                        return merged(before + piece, score) == [before, piece]
                    # of equal ranks the leftmost merges first: the one in ``before``, then the one across
                    broken = broken or across > a_taken and across >= b_taken
        return not broken

    def _fits(self, before: str, piece: str, known: dict[str, bool]) -> bool:
        """Pair compatibility; ``before`` is empty at a word's start. ``known``
        holds the answers so far for ``piece``."""
        self.pairs += 1
        if self.pairs >= PAIR_ENTRIES:
            for _, _, other in self.automaton.values():
                other.clear()
            self.pairs = 0
        got = known[before] = self._compatible(before, piece)
        return got

    def word_pieces(self, word: str) -> list[str]:
        """The tokens of one word. ``last[i]`` is the last token of the prefix
        of i characters. The automaton reports the pieces that end at a
        position, longest first; a position without one holds a character
        outside the vocabulary, which stands for itself."""
        last = ["", *word]
        solved = -1
        for end, (piece, size, known) in self.automaton.iter(word):
            if end == solved:
                continue
            before = last[end + 1 - size]
            good = known.get(before)
            if good or (good is None and self._fits(before, piece, known)):
                last[end + 1] = piece
                solved = end
        out, i = [], len(word)
        while i:
            piece = last[i]
            out.append(piece)
            i -= len(piece)
        out.reverse()
        return out

    def word_ids(self, word: str) -> list[int]:
        get = self.p.id.get
        pieces = self.word_pieces(word)
        ids = [get(piece) for piece in pieces]
        if None not in ids:
            return ids
        byte_id = self.p.byte_id
        return [j for i, piece in zip(ids, pieces)
                for j in ([i] if i is not None else [byte_id[b] for b in piece.encode()])]

    def decode(self, ids: list[int]) -> str:
        """Pieces back to text; control ids vanish, the first blank goes."""
        surface = self.p.surface
        text = b"".join([surface[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    def word(self, word: str) -> str:
        """The ids of one word as text. A word whose ids do not simply decode
        to itself gets its decoded text too: ``ODD`` ids ``ODD`` text."""
        pieces = self.word_pieces(word.replace(" ", SPACE))
        found = [self.id_text.get(piece) for piece in pieces]
        if None not in found:  # vocabulary pieces only: their surfaces are the word
            return " ".join(found)
        ids = self.word_ids(word.replace(" ", SPACE))
        surface = self.p.surface
        # A word starts with a blank's piece and ends before one, so the bytes of a character never span two words.
        back = b"".join([surface[i] for i in ids]).decode("utf-8", "replace")
        text = " ".join([str(i) for i in ids])
        return text if back == word else f"{ODD}{text}{ODD}{back}"

    @staticmethod
    def words(text: str) -> list[str]:
        """The words with U+2581 written as a blank; a blank goes before the text."""
        return _WORDS.findall(" " + text.replace(SPACE, " ")) if text else []

    def encode(self, text: str) -> list[int]:
        """All ids of a text, the end id last."""
        return [i for w in self.words(text) for i in self.word_ids(w.replace(" ", SPACE))] + [self.p.eos]

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, ids as text, decoded text)."""
        words = self.words(text)
        if not words:
            return 1, str(self.p.eos), ""
        memo = self.memo
        parts = [memo[w] for w in words]
        ids = " ".join(parts)
        if ODD in ids:
            split = [p.split(ODD, 2) if p.startswith(ODD) else (None, p, w) for p, w in zip(parts, words)]
            ids, words = " ".join([s[1] for s in split]), [s[2] for s in split]
        back = "".join(words)
        return ids.count(" ") + 2, f"{ids} {self.p.eos}", back[1:] if back.startswith(" ") else back


class _Words(dict):
    """The memo of words: when full, words met since the last turn stay one
    more turn. Long words are not kept."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec, self.older = codec, {}

    def __missing__(self, word: str) -> str:
        if (got := self.older.get(word)) is None:
            got = self.codec.word(word)
            if len(word) > 64:
                return got
        if len(self) >= MEMO_ENTRIES:
            self.older = dict(self)
            self.clear()
        self[word] = got
        return got


#: One codec a Python worker: its memos serve the worker's next tasks too.
_OF_WORKER: dict[str, Codec] = {}


def _codec(docs: DataFrame, model_file: str):
    bounded_batches(docs.sparkSession)
    pieces = Pieces(model_file)
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    key = pieces.key

    def get() -> Codec:
        if key not in _OF_WORKER:
            _OF_WORKER.clear()
            _OF_WORKER[key] = Codec(shared.value)
        return _OF_WORKER[key]

    return get


def encode(docs: DataFrame, model_file: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (doc_id) and ``ids``, the whole encoding."""
    codec = _codec(docs, model_file)

    def make():
        c = codec()
        return lambda texts: {"ids": [c.encode(t or "") for t in texts]}

    return batch_columns(docs, keep or ["doc_id"], ["text"], make, {"ids": "array<int>"})


def decode(encoded: DataFrame, model_file: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (doc_id) and the text that ``ids`` stand for."""
    codec = _codec(encoded, model_file)

    def make():
        c = codec()
        return lambda rows: {"text": [c.decode(ids or []) for ids in rows]}

    return batch_columns(encoded, keep or ["doc_id"], ["ids"], make, {"text": "string"})


def encode_digests(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, in one
    pass over the texts (encoded, then decoded from the ids)."""
    codec = _codec(docs, model_file)

    def make():
        c = codec()

        def run(texts):
            out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for t in texts:
                n, ids, back = c.digest(t or "")
                out["n_tokens"].append(n)
                out["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(back.encode()).hexdigest())
            return out

        return run

    return batch_columns(docs, ["doc_id"], ["text"], make,
                         {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"})
