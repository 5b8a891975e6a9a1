"""Lexical retrieval packing: documents that share words fill one window together.

1. Tokens. Each document becomes token ids and an end id; texts are cut where a
   piece always ends, and each distinct word of some rows is encoded once. Windows it fills alone
   are cut off first; what remains (less than a window) is to be packed. Ids are
   not kept: checksums of the remainder's prefixes, every ``STEP`` ids, give the
   checksum of any later piece, because CRC-32 is linear.
2. Statistics. Document frequencies of all token ids (bounded by the vocabulary),
   the number of documents and their mean length, over the whole corpus.
3. Shards. Documents are ranged by their rarest tokens into shards of equal size,
   so that related documents meet; ties are split by a hash, so that copies of one
   text never make a large shard. Each shard builds its BM25 index in its task.
4. Filling. The longest unused remainder seeds a window. Unused neighbours are
   taken best score first while they fit. A gap of ``STEP`` or more is closed with
   the head of the best that did not fit, whose rest stays unused. Documents
   without common words come last, so only a shard's last window stays open.

A null text is empty: its document is the end id alone. Repeated rows and ids are
documents of their own. Other columns are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import stored

WINDOW = 1024
STEP = 16  # remainders are cut at multiples of this
END = 0
SHARD = 4000  # documents of a shard
K1, B = 1.2, 0.75
COMMON, LEAST = 4, 64  # a term is common if a quarter of a shard's documents hold it, and so many


CHUNK = 1 << 24  # bytes of text whose words are looked up at once
GPT2 = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LETTER, DIGIT, SIGN, APOSTROPHE, SPACE, END_OF, OTHER = range(1, 8)


def _cuts() -> tuple[bytes, bytes]:
    """A kind for each byte, and for two kinds (16 a + b) whether ``GPT2`` always ends a piece between them.

    No piece depends on what is before it. Of letters beyond ASCII it is only said that
    a space behind one ends its piece. Whitespace keeps what follows, an apostrophe the letters.
    """
    kinds = np.full(256, OTHER, np.uint8)  # control characters, first bytes, and last bytes that whitespace may have
    kinds[0x21:0x7F] = SIGN
    kinds[ord("'")] = APOSTROPHE
    kinds[0x30:0x3A] = DIGIT
    kinds[0x41:0x5B] = kinds[0x61:0x7B] = LETTER
    kinds[list(b" \t\n\v\f\r")] = SPACE
    wide = {c.encode()[-1] for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000"} | set(range(0x80, 0x8B))
    kinds[[b for b in range(0x80, 0xC0) if b not in wide]] = END_OF
    cut = np.zeros(256, np.uint8)
    cut[[16 * a + SPACE for a in (LETTER, DIGIT, SIGN, APOSTROPHE, END_OF)]] = 1
    cut[[16 * LETTER + b for b in (DIGIT, SIGN, APOSTROPHE)]] = 1
    cut[[16 * DIGIT + b for b in (LETTER, SIGN, APOSTROPHE)]] = 1
    cut[[16 * SIGN + b for b in (LETTER, DIGIT)]] = 1
    return kinds.tobytes(), cut.tobytes()


KINDS, CUT = _cuts()


def mapped(values: np.ndarray, table: bytes) -> np.ndarray:
    """Each byte's entry in a table."""
    return np.frombuffer(values.tobytes().translate(table), np.uint8)


def kinds_of(data: np.ndarray) -> np.ndarray:
    """The kind of each byte of UTF-8 text."""
    kinds = mapped(data, KINDS)
    # Characters of two bytes from U+00C0 on are no whitespace.
    two = np.flatnonzero((data >= 0xC3) & (data < 0xE0))
    if len(two):
        kinds = kinds.copy()
        kinds[np.minimum(two + 1, len(kinds) - 1)] = END_OF
    return kinds


def offsets_of(values: pa.Array) -> np.ndarray:
    """Where each value of a binary array begins, and the last one ends."""
    return np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]


def together(alone: np.ndarray, lists: list[np.ndarray], ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in their order, all ids and how many each has: those alone from ``lists``, the others from ``ids`` by their ``counts``."""
    if not lists:
        return ids, counts
    sizes = np.zeros(len(alone), np.int32)
    sizes[alone], sizes[~alone] = [len(x) for x in lists], counts
    out, from_lists = np.empty(int(sizes.sum()), np.uint16), np.repeat(alone, sizes)
    out[from_lists], out[~from_lists] = np.concatenate(lists), ids
    return out, sizes


class Encoder:
    """Byte-level BPE from a file of ranks; ids as 16-bit numbers. ``added`` has the marks that are one token each; others are ordinary text."""

    def __init__(self, path: str, pattern: str, added: dict[str, int] | None = None) -> None:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added or {})
        self.added = set(added or ())
        self.marks = re.compile("|".join(map(re.escape, added))) if added else None
        self.cuttable = pattern == GPT2
        self.width = np.zeros(1 << 16, np.int64)  # bytes of each token
        self.width[list(ranks.values())] = [len(token) for token in ranks]

    def __call__(self, text: str) -> np.ndarray:
        """The ids of one text."""
        allowed = self.added if self.marks and self.marks.search(text) else set()
        return self.plain(text, allowed)

    def plain(self, text: str, allowed: set[str] = frozenset()) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special=allowed, disallowed_special=()).astype(np.uint16)

    def rows(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of many texts (null: none): for some rows at a time, in their order, all ids and how many each row has.

        Each distinct word of these rows is encoded once. Long texts and those with marks are encoded alone.
        """
        texts = pc.fill_null(texts.cast(pa.binary()), b"")
        offsets = offsets_of(texts).astype(np.int64)
        alone = np.diff(offsets) > (CHUNK if self.cuttable else -1)
        for mark in self.added:
            alone |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(texts):
            to = int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1
            to = max(at + 1, min(to, at + (1 << 16)))
            part, apart = texts[at:to], alone[at:to]
            lists = [self(part[i].as_py().decode()) for i in np.flatnonzero(apart).tolist()]
            plain = part.filter(pa.array(~apart)) if len(lists) else part
            ends = offsets_of(plain)
            data = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
            yield together(apart, lists, *self.words(data, ends - ends[0]))
            at = to

    def words(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that lie one after the other in ``data``, from one of ``ends`` to the next, and how many each has."""
        if not len(data):
            return np.zeros(0, np.uint16), np.zeros(len(ends) - 1, np.int32)
        kinds = kinds_of(data)
        first = np.ones(len(data) + 1, np.uint8)
        first[1:-1] = mapped(kinds[:-1] << 4 | kinds[1:], CUT)
        first[ends] = 1
        cuts = np.flatnonzero(first).astype(np.int32)
        words = pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)]).dictionary_encode()
        flat, sizes = self.pieces(words.dictionary)
        codes = words.indices.to_numpy()
        counts = sizes[codes]
        through = np.zeros(len(codes) + 1, np.int32)
        np.cumsum(counts, out=through[1:])
        places = np.repeat((np.cumsum(sizes, dtype=np.int32) - sizes)[codes] - through[:-1], counts)
        places += np.arange(len(places), dtype=np.int32)
        return flat[places], np.diff(through[np.searchsorted(cuts, ends)])

    def pieces(self, words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one after the other, and how many each has."""
        edges, data = offsets_of(words), np.frombuffer(words.buffers()[2], np.uint8)
        kinds = kinds_of(data)
        # Words that begin with a space and end before one are encoded as one text, the others alone.
        alone = (kinds[edges[:-1]] != SPACE) | (mapped(kinds[edges[1:] - 1] << 4 | SPACE, CUT) == 0)
        lists = [self.plain(words[i].as_py().decode()) for i in np.flatnonzero(alone).tolist()]
        lengths = np.diff(edges)
        ids = self.plain(data[: edges[-1]][np.repeat(~alone, lengths)].tobytes().decode())
        ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(lengths[~alone])) + 1
        return together(alone, lists, ids, np.diff(ends, prepend=0).astype(np.int32))


def encoder(path: str, pattern: str, added: dict[str, int] | None = None) -> Encoder:
    return Encoder(path, pattern, added)


@lru_cache(maxsize=1)
def loaded(path: str, pattern: str, added: tuple[tuple[str, int], ...]) -> Encoder:
    """One encoder per worker process, which its later tasks use too."""
    return encoder(path, pattern, dict(added))


# --- checksums ---------------------------------------------------------------------


def _zeros(words: int) -> np.ndarray:
    """What appending ``words`` zero words does to each bit of a CRC-32."""
    base = zlib.crc32(b"\0" * 4 * words)
    # crc32(data, start) continues from start; the constant part is taken out.
    return np.array([zlib.crc32(b"\0" * 4 * words, 1 << i) ^ base for i in range(32)], dtype=np.uint32)


_shifts: dict[int, np.ndarray] = {}


def piece_crc(before: int, through: int, words: int) -> int:
    """CRC-32 of the last ``words`` words, from those of what is before and of everything."""
    if not before:
        return through
    if words not in _shifts:
        _shifts[words] = _zeros(words)
    bits = (before >> np.arange(32)) & 1
    return through ^ int(np.bitwise_xor.reduce(_shifts[words][bits == 1]))


def prefix_crcs(ids: np.ndarray, step: int = STEP) -> list[int]:
    """CRC-32 of the first ``step``, 2 ``step`` ... ids, and of all."""
    data, out, crc = ids.astype("<u4").tobytes(), [], 0
    for at in range(0, len(data), 4 * step):
        crc = zlib.crc32(data[at : at + 4 * step], crc)
        out.append(crc)
    return out


# --- step 1: tokens ----------------------------------------------------------------

TOKENIZED = "full array<long>, crcs array<long>, n long, terms array<int>, tfs array<int>"


def lists(arrays: Sequence[np.ndarray]) -> pa.ListArray:
    """A list column from numpy arrays, without looking at single values."""
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([np.zeros(0, np.int32), *arrays]).astype(np.int32))


def term_counts(ids: np.ndarray, counts: np.ndarray) -> tuple[pa.ListArray, pa.ListArray]:
    """The distinct ids of each row, ascending, and how often it has them; ``counts`` has the ids of each of at most 65,536 rows."""
    keys = np.repeat(np.arange(len(counts), dtype=np.uint32) << 16, counts) | ids
    keys.sort()
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    keys, times = keys[at], np.diff(at, append=len(keys))
    offsets = np.searchsorted(keys, np.arange(len(counts) + 1, dtype=np.int64) << 16).astype(np.int32)
    return tuple(pa.ListArray.from_arrays(offsets, x.astype(np.int32)) for x in (keys & 0xFFFF, times))


def tokenized(docs: DataFrame, path: str, pattern: str, id_col: str, text_col: str, added: dict[str, int] | None = None) -> DataFrame:
    """Per document: checksums of full windows and of the remainder's prefixes, length, token counts."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = loaded(path, pattern, tuple((added or {}).items()))
        longs = pa.list_(pa.int64())
        for batch in batches:
            at = 0
            for ids, counts in encode.rows(batch.column(1)):
                ends = np.cumsum(counts, dtype=np.int64)
                whole, to = np.insert(ids, ends, np.uint16(END)), (ends + np.arange(1, len(ends) + 1)).tolist()
                full, crcs = [], []
                for start, end in zip([0, *to], to):
                    cut = start + (end - start) // WINDOW * WINDOW
                    data = whole[start:cut].astype("<u4").tobytes()
                    full.append([zlib.crc32(data[i : i + 4 * WINDOW]) for i in range(0, len(data), 4 * WINDOW)])
                    crcs.append(prefix_crcs(whole[cut:end]))
                arrays = [pa.array(full, longs), pa.array(crcs, longs), pa.array(counts.astype(np.int64) + 1), *term_counts(ids, counts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(counts)), *arrays], ["id", "full", "crcs", "n", "terms", "tfs"])
                at += len(counts)

    return docs.select(F.col(id_col).alias("id"), text_col).mapInArrow(run, f"id {kind}, {TOKENIZED}")


# --- step 3: keys of a batch --------------------------------------------------------


def rarest_two(terms: pa.ListArray, rank: np.ndarray, rarest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first two ids of each row in the order ``rarest``, -1 where there are none; ``rank`` is an id's place there."""
    offsets = terms.offsets.to_numpy()
    sizes = np.diff(offsets)
    places = rank[terms.values.to_numpy()[offsets[0] : offsets[-1]]]
    filled = np.flatnonzero(sizes)
    first, second = np.full((2, len(sizes)), -1, np.int64)
    if len(filled):
        starts = offsets[:-1][filled] - offsets[0]
        least = np.minimum.reduceat(places, starts)
        first[filled] = rarest[least]
        places[places == np.repeat(least, sizes[filled])] = len(rarest)
        least = np.minimum.reduceat(places, starts)
        two = least < len(rarest)
        second[filled[two]] = rarest[least[two]]
    return first, second


def rows_of(lists: pa.ListArray) -> list[np.ndarray]:
    """The numbers of each list, as views of one array."""
    values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy().tolist()
    return [values[a:b] for a, b in zip(offsets, offsets[1:])]


def last_of(lists: pa.ListArray, otherwise: np.ndarray) -> np.ndarray:
    """The last number of each list, or another where it has none."""
    offsets = lists.offsets.to_numpy()
    filled = np.flatnonzero(np.diff(offsets))
    out = otherwise.copy()
    out[filled] = lists.values.to_numpy()[offsets[1:][filled] - 1]
    return out


# --- step 4: one shard -------------------------------------------------------------


@dataclass
class Shard:
    """The unused remainders of a shard and their index."""

    length: np.ndarray  # ids that are left
    start: np.ndarray = field(init=False)  # ids that are placed already
    doc: np.ndarray  # postings, by term
    term: np.ndarray
    weight: np.ndarray
    edges: np.ndarray = field(init=False)  # where the postings of each term begin
    common: list[np.ndarray] = field(init=False)  # weights in all documents, of terms that many hold; they have no postings
    place: np.ndarray = field(init=False)  # of each term among the common ones, or -1

    def __post_init__(self) -> None:
        self.start = np.zeros(len(self.length), np.int64)
        held = np.bincount(self.term, minlength=1 << 16)
        often = np.flatnonzero(held >= max(len(self.length) // COMMON, LEAST))
        self.place = np.full(1 << 16, -1, np.int64)
        self.place[often] = np.arange(len(often))
        row = self.place[self.term]
        table = np.zeros((len(often), len(self.length)))
        table[row[row >= 0], self.doc[row >= 0]] = self.weight[row >= 0]
        self.common = list(table)
        self.keep(row < 0)

    def keep(self, chosen: np.ndarray) -> None:
        self.doc, self.term, self.weight = self.doc[chosen], self.term[chosen], self.weight[chosen]
        self.edges = np.searchsorted(self.term, np.arange((1 << 16) + 1))

    def scores(self, query: np.ndarray) -> np.ndarray:
        """What the terms of a query weigh in each document, used ones too as long as they are there."""
        places = self.place[query]
        rest = query[places < 0]
        spans = list(zip(self.edges[rest].tolist(), self.edges[rest + 1].tolist()))
        out = np.zeros(len(self.length))
        if spans:
            out = np.bincount(np.concatenate([self.doc[a:b] for a, b in spans]), np.concatenate([self.weight[a:b] for a, b in spans]), minlength=len(out))
        for i in places[places >= 0].tolist():
            out += self.common[i]
        return out

    def shrink(self) -> None:
        """Leaves out the postings of used documents, once they are an eighth of all."""
        left = (self.length > 0)[self.doc]
        if 8 * left.sum() < 7 * len(left):
            self.keep(left)


def build(lengths: np.ndarray, terms: list[np.ndarray], tfs: list[np.ndarray], sizes: np.ndarray, idf: np.ndarray, mean: float) -> tuple[Shard, list[np.ndarray]]:
    """The index of a shard, and the query terms of each document: all that it holds."""
    counts = np.array([len(t) for t in terms], np.int64)
    doc = np.repeat(np.arange(len(terms)), counts)
    term = np.concatenate(terms) if len(doc) else np.zeros(0, np.int64)
    tf = np.concatenate(tfs).astype(np.float64) if len(doc) else np.zeros(0)
    weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[doc] / mean))
    order = np.lexsort((doc, term))
    return Shard(lengths, doc[order], term[order], weight[order]), terms


def fill(shard: Shard, queries: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start, length); every id of every remainder once."""
    length, start = shard.length, shard.start
    windows: list[list[tuple[int, int, int]]] = []
    # Seeds come longest first; a rest that a cut leaves comes in its old place.
    line = np.argsort(-length, kind="stable")
    loose = 0
    for seed in line.tolist():
        while length[seed]:
            window = [(seed, int(start[seed]), int(length[seed]))]
            gap = WINDOW - int(length[seed])
            start[seed] += length[seed]
            length[seed] = 0
            for ranked in (neighbours, leftovers):
                if gap < STEP:
                    break
                skipped = -1
                for other in ranked(shard, queries[seed], line[loose:], gap):
                    size = int(length[other])
                    if size <= gap:
                        window.append((other, int(start[other]), size))
                        gap -= size
                        start[other] += size
                        length[other] = 0
                        if gap < STEP:
                            break
                    elif skipped < 0:
                        skipped = other
                if gap >= STEP and skipped >= 0:
                    size = gap // STEP * STEP
                    window.append((skipped, int(start[skipped]), size))
                    start[skipped] += size
                    length[skipped] -= size
                    gap -= size
            while loose < len(line) and not length[line[loose]]:
                loose += 1
            windows.append(window)
            if not len(windows) % 32:
                shard.shrink()
    return windows


def neighbours(shard: Shard, query: np.ndarray, line: np.ndarray, gap: int = WINDOW) -> list[int]:
    """Unused documents that share a query term, best first, ties by place; of those beyond the gap only the best."""
    if not len(query):
        return []
    length, scores = shard.length, shard.scores(query)
    scores[length == 0] = 0
    beyond = np.where(length > gap, scores, 0.0)
    # A gap only shrinks: what is beyond it never fits, and the best of those is the one that may be cut.
    first = int(beyond.argmax())
    fitting = scores - beyond
    fitting[first] = scores[first]
    found = np.flatnonzero(fitting)
    return found[np.argsort(-fitting[found], kind="stable")].tolist()


def leftovers(shard: Shard, query: np.ndarray, line: np.ndarray, gap: int = WINDOW) -> Iterator[int]:
    """All unused documents, longest first."""
    return (int(d) for d in line if shard.length[d])


PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def packed(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", added: dict[str, int] | None = None) -> DataFrame:
    """One row per piece: id, start, length, checksum, document length, sequence and place there.

    ``added`` has the added tokens of the vocabulary, which a text may hold.

    Ids of sequences are unique, not gapless. Pieces of a sequence follow each
    other from offset 0.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    tokens = stored(tokenized(docs, path, pattern, id_col, text_col, added), "tokens")
    totals = tokens.agg(F.count(F.lit(1)).alias("docs"), F.avg("n").alias("mean")).first()
    if not totals["docs"]:
        return spark.createDataFrame([], f"`{id_col}` {kind}, {PIECE}")
    # One count per token id: bounded by the vocabulary.
    df = dict(tokens.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    idf = np.zeros(1 << 16)
    for term, n in df.items():
        idf[term] = np.log(1 + (totals["docs"] - n + 0.5) / (n + 0.5))
    shared = spark.sparkContext.broadcast(idf)
    mean = max(1.0, float(totals["mean"]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rarest tokens of each document, as the key that brings related ones together."""
        rarest = np.argsort(-shared.value, kind="stable")
        rank = np.empty(len(rarest), np.int64)
        rank[rarest] = np.arange(len(rarest))
        for batch in batches:
            keys = rarest_two(batch.column("terms"), rank, rarest)
            columns = [pa.array(k, pa.int32()) for k in keys]
            # The last checksum of a row's ids: it tells rows that share an id and a length.
            last = last_of(batch.column("crcs"), last_of(batch.column("full"), np.zeros(batch.num_rows, np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns, pa.array(last, pa.int64())], [*batch.schema.names, "k1", "k2", "near"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)  # a shard: SHARD rows, give or take
        if not sum(b.num_rows for b in held):
            return
        # In an order of their own, whatever order they came in.
        table = pa.Table.from_batches(held).sort_by([("n", "descending"), ("id", "ascending"), ("near", "ascending")])
        idf = shared.value
        number = table.column("shard")[0].as_py()
        ids = table.column("id").combine_chunks()
        full, crcs = table.column("full").to_pylist(), table.column("crcs").to_pylist()
        sizes = table.column("n").to_numpy()
        listed = lambda c: rows_of(table.column(c).combine_chunks())
        shard, queries = build(sizes % WINDOW, listed("terms"), listed("tfs"), sizes, idf, mean)
        rows, sequence = [], number << 36
        for d, checks in enumerate(full):
            for i, crc in enumerate(checks):
                rows.append((d, i * WINDOW, WINDOW, crc, int(sizes[d]), sequence, 0))
                sequence += 1
        for window in fill(shard, queries):
            offset = 0
            for d, start, length in window:
                through = crcs[d][-(-(start + length) // STEP) - 1]
                before = crcs[d][start // STEP - 1] if start else 0
                rows.append((d, start + len(full[d]) * WINDOW, length, piece_crc(before, through, length), int(sizes[d]), sequence, offset))
                offset += length
            sequence += 1
        columns = list(zip(*rows))
        names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        arrays = [ids.take(pa.array(columns[0])), *[pa.array(c, pa.int64()) for c in columns[1:]]]
        yield pa.RecordBatch.from_arrays(arrays, ["id", *names])

    shards = max(1, -(-totals["docs"] // SHARD))
    schema = f"id {kind}, {TOKENIZED}, k1 int, k2 int, near long"
    # The row's place in the stored tokens tells even repeated rows apart: they fill several shards.
    ranged = tokens.mapInArrow(place, schema).withColumn("at", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(shards, "k1", "k2", F.xxhash64("id", "n", "near"), "at").drop("at")
    out = ranged.withColumn("shard", F.spark_partition_id()).mapInArrow(pack, f"id {kind}, {PIECE}")
    return out.withColumnRenamed("id", id_col)
