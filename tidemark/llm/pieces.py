"""N-best segmentation over a piece vocabulary, and back.

Text is normalized as the model does: white space becomes the mark of a word's
start. Pieces never cross such marks, so a text is a sequence of words, each with
its own lattice of pieces. Scores add up. Forward Viterbi gives the best score from
a word's start to every place; that is the exact remaining cost of a search that
goes backwards from the end, so A-star takes out complete paths best first and
never one too many. Its first path needs no queue: every step goes on along the best
score, and the second path begins with the cheapest step that it left aside. A text's
best segmentations deviate from the best in few words: the N - 1 words whose second
choice costs least are enough, and only these are searched to the end.

No piece crosses two neighbours that no piece holds side by side. Words are cut there,
so that a new word is mostly made of stretches met before.

Characters the vocabulary lacks become byte pieces. Every row is encoded whole and
on its own; words are remembered by a worker up to a bound. A null text is empty.
"""

from __future__ import annotations

import gc
import heapq
import math
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+$")
END = "\0"  # in no piece
NOTHING = (None, (), {})
MEMORY = 750_000  # words a worker remembers


class Pieces:
    """The vocabulary of a model file, and its lattices."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        # Every beginning of a piece: None, or the ids and score of the piece that it is.
        self.known: dict[str, tuple[tuple[int, ...], float] | None] = {}
        # The same character by character: score and ids of the piece, and what may follow.
        self.tree: dict[str, tuple[float | None, tuple[int, ...], dict]] = {}
        self.bytes: dict[int, int] = {}
        lowest = 0.0
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                for k in range(1, len(piece)):
                    self.known.setdefault(piece[:k], None)
                self.known[piece] = ((i,), model.get_score(i))
                lowest = min(lowest, model.get_score(i))
        below = {"": self.tree} | {beginning: {} for beginning in self.known}
        for beginning, found in self.known.items():
            below[beginning[:-1]][beginning[-1]] = (found[1] if found else None, found[0] if found else (), below[beginning])
        self.pairs = {piece[i : i + 2] for piece, found in self.known.items() if found for i in range(len(piece) - 1)}
        self.longest = max(map(len, self.known), default=1)
        self.floor = lowest - 10.0  # of a character in bytes
        self.unknown = model.unk_id()
        self.memory: dict[str, tuple[float, bytes, float]] = {}
        self.stretches: dict[str, tuple[float, bytes, float]] = {}

    def spelled(self, char: str) -> tuple[tuple[int, ...], float]:
        """A character outside the vocabulary, as bytes."""
        data = char.encode("utf-8", "replace")
        ids = tuple(self.bytes[b] for b in data) if self.bytes else (self.unknown,)
        return ids, self.floor * len(ids)

    def lattice(self, word: str) -> tuple[list[list[tuple[int, tuple[int, ...], float]]], list[float]]:
        """For every end the pieces (start, ids, score) that lead there, and the best score up to it."""
        n, get = len(word), self.known.get
        into: list[list[tuple[int, tuple[int, ...], float]]] = [[] for _ in range(n + 1)]
        best = [0.0] + [-math.inf] * n
        for start in range(n):
            so_far = best[start]
            found = get(word[start], False)
            ids, score = found or self.spelled(word[start])
            into[start + 1].append((start, ids, score))
            if so_far + score > best[start + 1]:
                best[start + 1] = so_far + score
            if found is False:
                continue
            for end in range(start + 2, n + 1):
                found = get(word[start:end], False)
                if found:
                    ids, score = found
                    into[end].append((start, ids, score))
                    if so_far + score > best[end]:
                        best[end] = so_far + score
                elif found is False:
                    break
        return into, best

    def best(self, word: str, n: int) -> list[tuple[float, bytes]]:
        """The ``n`` best segmentations of a word: (score, packed ids), best first; equal ones in a fixed order."""
        into, ahead = self.lattice(word)
        found: list[tuple[float, bytes]] = []
        # (total if completed best, place, pieces so far, score so far): of equal ones, the one nearest to its end goes first
        heap: list[tuple[float, int, Way | None, float]] = [(-ahead[-1], len(word), None, 0.0)]
        push, pop = heapq.heappush, heapq.heappop
        while heap:
            _, place, way, score = pop(heap)
            if not place:
                found.append((score, array("i", way.ids() if way else ()).tobytes()))
                if len(found) == n:
                    break
                continue
            for start, piece, gain in into[place]:
                total = score + gain
                push(heap, (-(ahead[start] + total), start, Way(piece, way), total))
        return found

    def first(self, stretch: str) -> tuple[float, bytes, float]:
        """Score and ids of the best segmentation, as ``best`` finds it, and what the second best costs more."""
        n, tree = len(stretch), self.tree
        # Of every place the best score up to it, the second best, and the step of the best.
        ahead, other = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
        came, taken = [0] * (n + 1), [()] * (n + 1)
        ahead[0] = 0.0
        for start in range(n):
            so_far, end = ahead[start], start
            score, ids, branch = tree.get(stretch[start], NOTHING)
            if score is None:
                ids, score = self.spelled(stretch[start])
            for char in stretch[start + 1 : start + self.longest] + END:
                end += 1
                if score is not None:
                    total = so_far + score
                    if total > ahead[end]:  # of equal ones, the one nearest to the end is taken
                        other[end] = ahead[end]
                        ahead[end] = total
                        came[end] = start
                        taken[end] = ids
                    elif total > other[end]:
                        other[end] = total
                node = branch.get(char)
                if node is None:
                    break
                score, ids, branch = node
        place, pieces, second = n, [], math.inf
        while place:
            second = min(second, ahead[place] - other[place])
            pieces.append(taken[place])
            place = came[place]
        return ahead[-1], array("i", [i for ids in reversed(pieces) for i in ids]).tobytes(), second

    def known_word(self, word: str) -> tuple[float, bytes, float]:
        """Score and ids of a word's best segmentation, and what the second best costs more; remembered."""
        pairs, get = self.pairs, self.stretches.get
        cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in pairs]
        score, parts, second = 0.0, [], math.inf
        for begin, end in zip([0, *cuts], [*cuts, len(word)]):
            stretch = word[begin:end]
            found = get(stretch)
            if found is None:
                if len(self.stretches) >= MEMORY:
                    self.stretches.clear()
                found = self.stretches[stretch] = self.first(stretch)
            score += found[0]
            parts.append(found[1])
            if found[2] < second:
                second = found[2]
        if len(self.memory) >= MEMORY:
            self.memory.clear()
        entry = self.memory[word] = (score, b"".join(parts), second)
        return entry

    def nbest(self, text: str | None, n: int) -> list[tuple[float, bytes]]:
        """The ``n`` best segmentations of a whole text: (score, packed ids)."""
        return self.nbest_normal(self.model.normalize(text or ""), n)

    def nbest_normal(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """The same for a text that is normalized already."""
        names = WORD.findall(text)
        get = self.memory.get
        words = [get(w) or self.known_word(w) for w in names]
        total = sum([w[0] for w in words])
        first = [w[1] for w in words]
        if n == 1 or not words:
            return [(total, b"".join(first))]
        costs = [w[2] for w in words]
        spare = []
        while len(spare) < n - 1 and (least := min(costs)) < math.inf:
            i = costs.index(least)
            spare.append((i, self.best(names[i], n)))
            costs[i] = math.inf
        ways: list[tuple[float, tuple[tuple[int, bytes], ...]]] = [(0.0, ())]
        for i, choices in spare:
            options = [(cost + choices[0][0] - s, (*chosen, (i, ids)) if k else chosen) for cost, chosen in ways for k, (s, ids) in enumerate(choices)]
            ways = heapq.nsmallest(n, options)
        out = []
        for cost, chosen in ways:
            parts = first if not chosen else first.copy()
            for i, ids in chosen:
                parts[i] = ids
            out.append((total - cost, b"".join(parts)))
        return out

    def decode(self, packed: bytes) -> str:
        return self.model.decode(array("i", packed).tolist())


class Way:
    """The pieces from a place to the end of a word: the first, and the way that goes on from it.

    Ways share their ends, so a push costs the same however long the word is. Ways of
    equal total and place are ordered by ids; only then are they walked.
    """

    __slots__ = ("piece", "rest")

    def __init__(self, piece: tuple[int, ...], rest: Way | None) -> None:
        self.piece, self.rest = piece, rest

    def ids(self) -> Iterator[int]:
        way: Way | None = self
        while way is not None:
            yield from way.piece
            way = way.rest

    def __lt__(self, other: Way) -> bool:
        mine, theirs = self.ids(), other.ids()
        for a in mine:
            b = next(theirs, None)
            if b is None or a != b:
                return b is not None and a < b
        return next(theirs, None) is not None


@lru_cache(maxsize=1)
def loaded(path: str) -> Pieces:
    """One vocabulary per worker process, so that its later tasks remember words too.

    It stays until the process ends: the collector need not walk it again and again.
    """
    pieces = Pieces(path)
    gc.freeze()
    return pieces


def encoded(docs: DataFrame, path: str, n: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_pieces and ids_crc32 of the best segmentation, and ``scores``, ``crcs`` of the ``n`` best.

    ``round_trip`` tells whether decoding gives the normalized text back.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(path)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                normal = pieces.model.normalize(text or "")
                ways = pieces.nbest_normal(normal, n)
                best = ways[0][1]
                whole = normal.replace(SPACE, " ").removeprefix(" ")
                crcs = [zlib.crc32(ids) for _, ids in ways]
                rows.append((len(best) // 4, crcs[0], [s for s, _ in ways], crcs, pieces.decode(best) == whole))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.bool_()]
            names = ["n_pieces", "ids_crc32", "scores", "crcs", "round_trip"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["id", *names])

    out = f"id {kind}, n_pieces long, ids_crc32 long, scores array<double>, crcs array<long>, round_trip boolean"
    return docs.select(F.col(id_col).alias("id"), text_col).mapInArrow(run, out).withColumnRenamed("id", id_col)
