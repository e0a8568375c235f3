"""SentencePiece BPE by a score-ordered agenda, checked against the library.

A text becomes one symbol per character, a symbol being a number; the agenda holds every
pair of neighbours that together are a piece, best score first and then leftmost; the best
pair is merged and its new neighbours join the agenda, until none is left. Symbols that are
no piece become byte pieces. The agendas of short stretches are the rows of an array, with a
place for each pair of neighbours; the best pair of every row is merged at a time. That of a
long stretch is a heap.

Merges never reach across a place where no piece could: before a word marker that
follows another character, and around a character that is in no longer piece. Texts
are cut there, and the ids of a stretch are remembered. Every batch has the
stretches that were new in it encoded by the library as well; should one differ,
the library's ids are taken and counted in `differing`.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramledger.llm.text import batch, utf8

MARK = "▁"  # stands for a space
REMEMBERED = 1 << 19  # a worker remembers up to twice as many stretches
REMEMBERED_LENGTH = 64
WIDTHS = (4, 8, 12, 16, 24, 32)  # symbols to a row of agendas; longer stretches have heaps
ROWS = 1 << 14  # agendas in one array
SLICE = 256


class Vocabulary:
    """What encoding needs of a model file: pieces with scores and ids, byte pieces, end id."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        sp = self.library
        n = sp.get_piece_size()
        self.end = sp.eos_id()
        self.digits = list(map(str, range(n)))
        self.bytes = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        usual = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.pieces = {sp.id_to_piece(i): i for i in usual}
        longer = [p for p in self.pieces if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in longer):
            raise ValueError("pieces that go on after a word marker are not supported")
        joining = sorted({c for p in longer for c in p} - {MARK})
        inside = "".join(re.escape(c) for c in joining)
        self.stretch = re.compile(f"{MARK}*[{inside}]+|{MARK}+|[^{inside}{MARK}]", re.DOTALL)
        # Symbols: pieces by their ids, then characters that are none but are in longer pieces.
        self.symbols = dict(self.pieces)
        for c in sorted({c for p in longer for c in p}):
            self.symbols.setdefault(c, n + len(self.symbols) - len(self.pieces))
        self.first_other = n
        self.letters = {k: c for c, k in self.symbols.items() if k >= n}
        self.of_letter = np.full(0x110000, -1, np.int32)  # by code point; only joining characters and markers are looked up
        for c, k in self.symbols.items():
            if len(c) == 1:
                self.of_letter[ord(c)] = k
        # (left, right) as one number: what they make, and its rank by score. Equal scores share a rank.
        self.width = n + len(self.letters)
        ranks = {score: k for k, score in enumerate(sorted({-sp.get_score(self.pieces[p]) for p in longer}))}
        pairs = {}
        for p in longer:
            for cut in range(1, len(p)):
                left, right = self.symbols.get(p[:cut]), self.symbols.get(p[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = ranks[-sp.get_score(self.pieces[p])], self.pieces[p]
        self.pairs = pairs
        self.no_rank = len(ranks)
        self.keys = np.array([*sorted(pairs), np.iinfo(np.int64).max], np.int64)
        found = [pairs[k] for k in self.keys[:-1].tolist()] + [(self.no_rank, -1)]
        self.rank_of, self.made_of = (np.array(c, np.int32) for c in zip(*found, strict=True))
        if sp.encode("a b") != sp.encode(["a", "b"])[0] + sp.encode("b"):
            raise ValueError("only models that put a word marker before every text are supported")

    def agendas(self, texts: list[str]) -> list[bytes]:
        """The ids of stretches of texts whose spaces are markers, each id as four bytes."""
        out: list[bytes | None] = [None] * len(texts)
        rows: dict[int, list[int]] = {w: [] for w in WIDTHS}
        for i, text in enumerate(texts):
            n = len(text)
            if n == 1:
                piece = self.pieces.get(text)
                out[i] = packed([piece] if piece is not None else [self.bytes[b] for b in text.encode()])
            elif n > WIDTHS[-1]:
                out[i] = self._spelt(self._by_heap(self.of_letter[_code_points(text)].tolist()))
            else:
                rows[next(w for w in WIDTHS if n <= w)].append(i)
        for width, of in rows.items():
            for start in range(0, len(of), ROWS):
                some = of[start : start + ROWS]
                for i, ids in zip(some, self._by_rows([texts[i] for i in some], width), strict=True):
                    out[i] = ids
        return out

    def _spelt(self, symbols: list[int]) -> bytes:
        """Symbols with those that are no piece as byte pieces."""
        return packed([*chain.from_iterable([s] if s < self.first_other else [self.bytes[b] for b in self.letters[s].encode()] for s in symbols)])

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranks of pairs of symbols, and what they make. Symbols below 0 are in no pair."""
        key = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.keys, key)
        at[(self.keys[at] != key) | (left < 0) | (right < 0)] = len(self.keys) - 1
        return self.rank_of[at], self.made_of[at]

    def _by_rows(self, texts: list[str], width: int) -> list[bytes]:
        n = len(texts)
        # Two places more than symbols: what lies before and after a stretch is in no pair.
        symbols = np.full((n, width + 2), -1, np.int32)
        points = _code_points("".join(t.ljust(width, "\0") for t in texts)).reshape(n, width)
        sizes = np.fromiter(map(len, texts), np.int64, n)
        inside = np.arange(width) < sizes[:, None]
        symbols[:, 1:-1][inside] = self.of_letter[points[inside]]
        # rank, made: of the pair that begins at a place.
        rank, made = (np.full((n, width + 2), x, np.int32) for x in (self.no_rank, -1))
        rank[:, :-1], made[:, :-1] = self._look_up(symbols[:, :-1], symbols[:, 1:])
        before, after = (np.tile(np.arange(width + 2) + d, (n, 1)) for d in (-1, 1))
        open_ = np.arange(n)
        while len(open_):
            best = rank[open_].argmin(axis=1)
            some = rank[open_, best] < self.no_rank
            open_, k = open_[some], best[some]
            if not len(open_):
                break
            symbols[open_, k] = new = made[open_, k]
            gone = after[open_, k]
            symbols[open_, gone] = -1
            rank[open_, gone] = self.no_rank
            beyond, ahead = after[open_, gone], before[open_, k]
            after[open_, k], before[open_, beyond] = beyond, k
            rank[open_, k], made[open_, k] = self._look_up(new, symbols[open_, beyond])
            rank[open_, ahead], made[open_, ahead] = self._look_up(symbols[open_, ahead], new)
        left = symbols >= 0
        flat, ends = symbols[left].tobytes(), [0, *(4 * np.cumsum(left.sum(axis=1))).tolist()]
        out = [flat[i:j] for i, j in zip(ends, ends[1:])]
        for k in np.flatnonzero((symbols >= self.first_other).any(axis=1)).tolist():
            out[k] = self._spelt(np.frombuffer(out[k], np.int32).tolist())
        return out

    def _by_heap(self, symbols: list[int]) -> list[int]:
        pairs, width, n = self.pairs.get, self.width, len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = [(p[0], i, a * width + b, p[1]) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (p := pairs(a * width + b))]
        heapq.heapify(agenda)
        while agenda:
            _, left, pair, made = heapq.heappop(agenda)
            right = after[left]
            if right < 0 or symbols[left] < 0 or symbols[left] * width + symbols[right] != pair:
                continue  # one of the two has been merged since
            symbols[left], symbols[right] = made, -1
            beyond, ahead = after[right], before[left]
            after[left] = beyond
            if beyond >= 0:
                before[beyond] = left
                if p := pairs(made * width + symbols[beyond]):
                    heapq.heappush(agenda, (p[0], left, made * width + symbols[beyond], p[1]))
            if ahead >= 0 and (p := pairs(symbols[ahead] * width + made)):
                heapq.heappush(agenda, (p[0], ahead, symbols[ahead] * width + made, p[1]))
        return [s for s in symbols if s >= 0]

    def by_library(self, stretches: list[str]) -> list[bytes]:
        """The library's ids of stretches, packed. It puts a marker before each text, so what has none follows a line end."""
        line_end = "\n"  # always a byte piece of its own
        head, texts, odd = len(self.library.encode(line_end)), [], []
        for k, s in enumerate(stretches):
            own = s[1:]
            if s[0] == MARK and own and own[0] != MARK:  # a word
                texts.append(own)
                continue
            only_marks = not s.strip(MARK)
            odd.append((k, 0 if s[0] == MARK else head, -1 if only_marks else None))
            texts.append((own if s[0] == MARK else line_end + s).replace(MARK, " ") + line_end * only_marks)
        found = self.library.encode(texts, num_threads=1)
        for k, i, j in odd:
            found[k] = found[k][i:j]
        flat, ends = packed([*chain.from_iterable(found)]), np.cumsum([0, *(4 * n for n in map(len, found))]).tolist()
        return [flat[i:j] for i, j in zip(ends, ends[1:])]


def packed(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Encoder:
    """Encodes texts and remembers the ids of stretches: the recent ones, and those that were before.

    differing: how many stretches of the last call the library encodes otherwise.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.recent, self.earlier, self.differing = vocabulary, {}, {}, 0

    def encode(self, texts: list[str], checked: bool = True) -> list[list[int]]:
        """The ids of each text and the end id; all stretches that are new are compared with the library's."""
        v, known = self.v, self.recent
        split = [v.stretch.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = list(set(chain.from_iterable(split)).difference(known))
        if self.earlier:
            again = [s for s in new if s in self.earlier]
            known.update(zip(again, map(self.earlier.__getitem__, again), strict=True))
            new = [s for s in new if s not in self.earlier]
        ids = v.agendas(new)
        self.differing = 0
        if checked and new:
            for k, theirs in enumerate(v.by_library(new)):
                if ids[k] != theirs:
                    ids[k] = theirs
                    self.differing += 1
        known.update(zip(new, ids, strict=True))
        end = packed([v.end])
        out = [np.frombuffer(b"".join([*map(known.__getitem__, parts), end]), np.int32).tolist() for parts in split]
        for s in new:
            if len(s) > REMEMBERED_LENGTH:
                del known[s]
        if len(known) > REMEMBERED:
            self.earlier, self.recent = known, {}
        return out


@lru_cache(maxsize=1)
def encoder_of(model: bytes) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(Vocabulary(model))


ENCODED = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.large_string()), ("differing", pa.int64())]
)
DIGESTS = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("differing", pa.int64())]
)


def encoded(batches: Iterator[pa.RecordBatch], model: bytes, checked: bool) -> Iterator[tuple[pa.Array, list[list[int]], list[str], int]]:
    encoder = encoder_of(model)
    for whole in batches:
        for start in range(0, whole.num_rows, SLICE):
            rows = whole.slice(start, SLICE)
            texts = [(x.as_py() or b"").decode("utf-8", "replace") for x in rows.column(1)]
            ids = encoder.encode(texts, checked)
            yield rows.column(0), ids, encoder.v.library.decode(ids), encoder.differing


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("text"))


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: str, *, doc_id: str = "doc_id", text: str = "text", checked: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (with the end id), decoded (of these ids), differing: one row per row of docs.

    model: path of a model file of type BPE, on the driver; the tasks are sent its bytes
    (under 1 MB at 32,000 pieces). differing: how many stretches of the row's batch the
    library encodes otherwise; 0 unless its rules differ from these.

    Null and empty texts have the end id alone and decode to the empty text. Bytes that
    are no UTF-8 are read as U+FFFD. Repeated rows give repeated results, a null doc_id
    stays null, an empty table gives no rows. Other columns are not read.
    """
    data = docs.sparkSession.sparkContext.broadcast(read_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, ids, texts, differing in encoded(batches, data.value, checked):
            yield batch(ENCODED, [names, [len(i) for i in ids], ids, texts, [differing] * len(ids)])

    return _rows(docs, doc_id, text).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids array<int>, decoded string, differing bigint")


def digests(docs: DataFrame, model: str, *, doc_id: str = "doc_id", text: str = "text", checked: bool = True) -> DataFrame:
    """encode() with the SHA-256 of the ids, in decimal and joined by spaces, and of the decoded text in their stead."""
    data = docs.sparkSession.sparkContext.broadcast(read_model(model))

    def sha(value: str) -> str:
        return hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = encoder_of(data.value).v.digits
        for names, ids, texts, differing in encoded(batches, data.value, checked):
            yield batch(DIGESTS, [names, [len(i) for i in ids], [sha(" ".join(map(digits.__getitem__, i))) for i in ids], [sha(t) for t in texts],
                                  [differing] * len(ids)])

    return _rows(docs, doc_id, text).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, differing bigint")
