"""Removal of repeated byte strings, by suffix arrays of what can repeat.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts somewhere
else, in the same document or another.

1. Anchors. Every window of ``LENGTH`` bytes has an anchor, its ``GRAM`` bytes with
   the smallest hash; equal windows have equal anchors. Neighbouring windows with
   one anchor are a run (about 80 windows), and only anchors that occur twice go on.
2. Runs with the same anchor and the same content are one context. Where a context
   occurs twice, all its windows do. Where an anchor has several contexts, their
   texts, once each, meet in one task.
3. There the texts are cut into phrases that end where the bytes say so, and the
   suffix array of the phrase sequences is built by grouping (``gsaca``). Phrases
   rank as their bytes do and none is a prefix of another, so this is also the
   order of the byte suffixes. A window, known by the bytes before its first
   phrase and by its place in that order, repeats if another window has the same
   bytes there and stays within LENGTH by the common prefixes in between.
4. Verdicts go back to all runs of a context, and spans to all copies of a text.

An anchor with more than ``MANY`` contexts is not gathered in one task: its windows
are counted by the hash of their bytes, which is the same order cut at depth LENGTH.
Texts are known by a 64-bit hash; a task sends each text once, however many copies
it has. A null text is empty, texts under LENGTH bytes keep all; repeated rows are
copies, so they lose everything; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytehash import flat, mix, portions, prefix_sums, substring_hash
from tidemark.llm.graph import stored
from tidemark.llm.gsaca import suffix_array

LENGTH = 200  # bytes of a repeated string
GRAM = 32  # bytes of an anchor
TRIGGER = 4  # bytes whose hash ends a phrase
MANY = 50_000  # contexts of one anchor that one task takes


def slide_min(values: np.ndarray, w: int) -> np.ndarray:
    """The minimum of every ``w`` neighbours."""
    n = len(values) - w + 1
    if n <= 0:
        return values[:0]
    pad = -len(values) % w
    padded = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def anchored_runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of window starts with the same anchor: (row, first start, last start, hash of the anchor, hash of the run)."""
    none = np.zeros(0, np.int64)
    n = len(data) - length + 1
    if n <= 0:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    sums = prefix_sums(data)
    at = np.arange(len(data) - gram + 1)
    grams = substring_hash(sums, at, at + gram)
    least = slide_min((grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), length - gram + 1)
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    whole = np.arange(n) + length <= offsets[1:][row]
    fresh = np.ones(n, bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    begins = np.flatnonzero(fresh)
    counts = np.add.reduceat(whole.astype(np.int64), begins)
    begins, counts = begins[counts > 0], counts[counts > 0]
    low, high = begins, begins + counts - 1
    spot = anchor[low]
    content = substring_hash(sums, low, high + length) + (spot - low).astype(np.uint64)
    return row[low], low, high, grams[spot], content


def phrase_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, row, stop) of the phrases of each row: every place where TRIGGER bytes hash to a stop, and each row's end.

    ``stop`` is false for an end whose bytes are no stop: other rows have no phrase there.
    """
    words = np.lib.stride_tricks.sliding_window_view(data, TRIGGER).astype(np.uint32)
    value = (words[:, 0] | words[:, 1] << np.uint32(8) | words[:, 2] << np.uint32(16) | words[:, 3] << np.uint32(24)) * np.uint32(2654435769)
    stop = (value >> np.uint32(27)) == 0
    stops = np.flatnonzero(stop)
    row = np.searchsorted(offsets, stops, side="right") - 1
    inside = stops + TRIGGER < offsets[row + 1]
    ends = offsets[1:] - TRIGGER
    starts = np.concatenate([stops[inside], ends])
    rows = np.concatenate([row[inside], np.arange(len(ends))])
    order = np.argsort(starts, kind="stable")
    return starts[order], rows[order], stop[starts[order]]


def common_prefix(data: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Equal bytes from ``a`` and from ``b``, up to ``most``."""
    padded = np.concatenate([data, np.zeros(8 + LENGTH, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded, (len(padded) - 7, 8), (1, 1))
    found = np.zeros(len(a), np.int64)
    active = np.arange(len(a))
    while len(active):
        left = np.ascontiguousarray(eight[a[active] + found[active]]).view(np.uint64).ravel()
        right = np.ascontiguousarray(eight[b[active] + found[active]]).view(np.uint64).ravel()
        differ = left ^ right
        lowest = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, np.bitwise_count(lowest - np.uint64(1)).astype(np.int64) // 8)
        found[active] += equal
        active = active[(equal == 8) & (found[active] < most[active])]
    return np.minimum(found, most)


def repeated_windows(texts: list[bytes], windows: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each text, which of its first ``windows`` windows also start elsewhere in these texts' windows.

    Each text has ``windows + length - 1`` bytes.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    starts, rows, stop = phrase_starts(data, offsets)
    last = np.append(rows[1:] != rows[:-1], True)
    ends = np.where(last, offsets[rows + 1], np.append(starts[1:], 0) + TRIGGER)
    whole = data.tobytes()
    phrases = [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    rank = {p: i + 1 for i, p in enumerate(sorted(set(phrases)))}
    # The last phrase of a text is its final trigger bytes; 0 after it keeps texts apart.
    symbols, home = [], []
    for i, (phrase, final) in enumerate(zip(phrases, last.tolist())):
        symbols.append(rank[phrase])
        home.append(i)
        if final:
            symbols.append(0)
            home.append(-1)
    home_of = np.array(home)
    order = home_of[np.array(suffix_array(symbols))]
    order = order[order >= 0]
    left = offsets[rows + 1] - starts
    a, b = order[:-1], order[1:]
    shared = common_prefix(data, starts[a], starts[b], np.minimum(np.minimum(left[a], left[b]), length))
    position = np.empty(len(order), np.int64)
    position[order] = np.arange(len(order))

    # All windows, with the first phrase start at or after each.
    counts = np.array(windows)
    text = np.repeat(np.arange(len(texts)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = offsets[text] + inner
    after = np.searchsorted(starts, begin)
    ahead = starts[after] - begin
    ahead = np.where((ahead > length - TRIGGER) | ~stop[after], length, ahead)
    sums = prefix_sums(data)
    key = substring_hash(sums, begin, begin + ahead)
    for distance in np.unique(ahead):
        if distance < length:
            cut = np.concatenate([[0], np.cumsum(shared < length - distance)])
            here = np.flatnonzero(ahead == distance)
            key[here] = mix(key[here] + mix(cut[position[after[here]]].astype(np.uint64) + np.uint64(distance << 40)))
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    return np.split(twice, np.cumsum(counts)[:-1])


def spans_of(repeated: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Runs of repeated window starts as covered spans [start, end)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1 + length) for a, b in zip(edges[::2], edges[1::2])]


def _anchors(counted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in portions(batch, 1):
                keys = part.column(0).to_pylist()
                fresh = []
                for key in keys:
                    fresh.append(key not in seen)
                    seen.add(key)
                part = part.filter(pa.array(fresh))
                if not part.num_rows:
                    continue
                data, offsets = flat(part.column(1))
                row, low, high, gram, content = anchored_runs(data, offsets)
                if counted:
                    gram, n = np.unique(gram, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n)], ["h", "n"])
                else:
                    key = part.column(0).to_numpy()[row]
                    at = offsets[row]
                    columns = [gram.view(np.int64), content.view(np.int64), key, (low - at).astype(np.int32), (high - at).astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "c", "key", "low", "high"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text of a task once, compressed."""
    seen: set[int] = set()
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        keys, texts = [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if key not in seen:
                seen.add(key)
                keys.append(key)
                texts.append(pack(text.as_buffer().to_pybytes()))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(texts, pa.binary())], ["key", "packed"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts that a text stands for; once if a text comes again."""
    unpack = zstandard.ZstdDecompressor().decompress
    seen: set[int] = set()
    for batch in batches:
        rows: list[tuple] = []
        for key, packed, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if key in seen:
                continue
            seen.add(key)
            text = unpack(packed)
            rows += [(r["h"], r["c"], r["n"], r["many"], r["high"] - r["low"] + 1, text[r["low"] : r["high"] + LENGTH]) for r in runs]
        columns = list(zip(*rows)) or [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["h", "c", "n", "many", "windows", "bytes"])


def _judge(frame: pd.DataFrame) -> pd.DataFrame:
    """Repeated windows of the contexts of some anchors, by one suffix array."""
    frame = frame.drop_duplicates(["h", "c"])
    found = repeated_windows(frame["bytes"].tolist(), frame["windows"].tolist()) if len(frame) else []
    single = (frame["n"] == 1).tolist()  # a context that occurs twice needs no verdict
    rows = [
        (h, c, low, high)
        for h, c, one, twice in zip(frame["h"].tolist(), frame["c"].tolist(), single, found)
        if one
        for low, high in spans_of(twice)
    ]
    return pd.DataFrame(rows, columns=["h", "c", "start", "end"]).astype("int64")


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of every window of a context."""
    for batch in batches:
        for part in portions(batch, 3):
            texts = part.column(3).to_pylist()
            counts = np.array(part.column(2).to_pylist(), dtype=np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            row = np.repeat(np.arange(len(texts)), counts)
            inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            begin = offsets[row] + inner
            value = substring_hash(prefix_sums(np.frombuffer(b"".join(texts), np.uint8)), begin, begin + LENGTH)
            h, c = (part.column(i).to_numpy()[row] for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h, c, inner, value.view(np.int64))], ["h", "c", "start", "w"])


def repeated_spans(docs: DataFrame, text_col: str = "text", many: int = MANY) -> DataFrame:
    """(key, whole, spans) for the texts that lose bytes; key is ``xxhash64`` of the text.

    ``whole`` marks texts of which there are copies. Spans may overlap.
    """
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).select(F.xxhash64("text").alias("key"), "text")
    texts = texts.where(F.octet_length("text") >= LENGTH)
    copies = texts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    grams = texts.mapInArrow(_anchors(True), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    runs = texts.mapInArrow(_anchors(False), "h long, c long, key long, low int, high int")
    runs = stored(runs.join(grams, "h"), "anchored-runs")
    contexts = stored(runs.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "low", "high")).alias("at")), "contexts")
    kinds = contexts.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    mixed = contexts.join(kinds, "h").select("h", "c", "n", (F.col("kinds") > many).alias("many"), "at.*")
    wanted = mixed.groupBy("key").agg(F.collect_list(F.struct("h", "c", "n", "many", "low", "high")).alias("runs"))
    packed = texts.mapInArrow(_packed, "key long, packed binary").join(wanted, "key").select("key", "packed", "runs")
    bodies = stored(packed.mapInArrow(_contexts, "h long, c long, n long, many boolean, windows long, bytes binary"), "context-bytes")
    buckets = max(1, bodies.count() // 4000)
    grouped = bodies.where("not many").groupBy(F.pmod(F.xxhash64("h"), F.lit(buckets)).alias("bucket"))
    spans = grouped.applyInPandas(_judge, "h long, c long, start long, end long")
    hot = bodies.where("many").select("h", "c", "windows", "bytes").distinct()
    hot = hot.mapInArrow(_windows, "h long, c long, start long, w long")
    twice = hot.groupBy("w").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("w")
    spans = spans.unionByName(hot.join(twice, "w").select("h", "c", "start", (F.col("start") + LENGTH).alias("end")))
    single = contexts.where("n > 1").select("h", "c", F.lit(0).cast("long").alias("start"), F.lit(-1).cast("long").alias("end"))
    marks = runs.join(spans.unionByName(single), ["h", "c"])
    end = F.when(F.col("end") < 0, F.col("high") + LENGTH).otherwise(F.col("low") + F.col("end"))
    marks = marks.select("key", F.struct((F.col("low") + F.col("start")).alias("start"), end.alias("end")).alias("span"))
    by_text = marks.groupBy("key").agg(F.collect_set("span").alias("spans"))
    both = by_text.join(copies.withColumn("whole", F.lit(True)), "key", "full")
    return both.select("key", F.coalesce("whole", F.lit(False)).alias("whole"), "spans")


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans, in order."""
    out: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def kept_bytes(text: bytes, whole: bool | None, spans: list[dict] | None) -> tuple[bytes, int]:
    """What is left of a text, and in how many pieces bytes were removed."""
    if whole:
        return b"", 1
    runs = merged(spans)
    pieces, at = [], 0
    for start, end in runs:
        pieces.append(text[at:start])
        at = end
    return b"".join([*pieces, text[at:]]), len(runs)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, whole, spans in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                body = text.as_buffer().to_pybytes()
                kept, pieces = kept_bytes(body, whole, spans)
                rows.append((len(body), len(body) - len(kept), pieces, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows)) or [[]] * 4
            kinds = [pa.int64()] * 3 + [pa.string()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = repeated_spans(docs, text_col)
    joined = rows.withColumn("key", F.xxhash64("text")).join(found, "key", "left").select("id", "text", "whole", "spans")
    out = joined.mapInArrow(run, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("id", id_col)


def removed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with repeated strings cut out of the text; other columns as they were.

    A cut can fall inside a character; what is left of such a character goes too.
    A null text stays null.
    """
    found = repeated_spans(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if t is None else kept_bytes(t.encode(), whole, spans)[0].decode("utf-8", "ignore")
                for t, whole, spans in zip(*(batch.column(i).to_pylist() for i in range(3)))
            ]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(3)], ["text", "rest"])

    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("rest")
    rows = docs.select(F.col(text_col).alias("text"), rest, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"))
    rows = rows.join(found, "key", "left").select("text", "whole", "spans", "rest")
    kind = rows.schema["rest"].dataType.simpleString()
    out = rows.mapInArrow(run, f"text string, rest {kind}")
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`") for c in docs.columns])
