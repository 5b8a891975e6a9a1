"""Chat formatting: speakers of a transcript by a hidden Markov model.

A transcript is a sequence of rows (conversation, turn, text), each of one or more
lines. The hidden state of a line is the role that speaks it; what is seen is
whether the line starts with a speaker marker, which one, how long it is, whether
it asks, and, on a row's first line, how long the row is. Counts over all labelled
rows give the probabilities. Viterbi finds the best roles of a whole conversation;
neighbouring lines of one role in a row become one turn, rendered canonically.

A conversation may have any number of rows, also in one turn or without a turn. Its
rows are numbered in their order and cut into blocks of ``BLOCK`` rows; each block is reduced to the best scores between the roles before
and at its end (a small matrix), the matrices of a conversation give the best role
at every block's end, and then each block is decoded by itself. The result is that
of one long Viterbi run.

A null text is an empty line. Rows that are repeated exactly count once; rows of one
turn with different texts follow each other by text. Rows without a conversation
form one of their own, rows without a turn come first in theirs. Null and unknown
roles are not counted. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import stored

ROLES = ("system", "user", "assistant")
NONE = len(ROLES)  # no role: before the first row of a conversation
BLOCK = 256

# Words that name a speaker at the start of a line, with or without decoration.
MARKER = re.compile(
    r"^\s*(?:[#>*\[(<|_-]{0,3}\s*)(system|instruction|user|human|customer|question|q|me|assistant|ai|bot|agent|answer|a|gpt|model)"
    r"\s*(?:[\])>|*_-]{0,3})\s*(?::|>|\n|$)\s*",
    re.IGNORECASE,
)
SPEAKERS = {
    **dict.fromkeys(("system", "instruction"), "system"),
    **dict.fromkeys(("user", "human", "customer", "question", "q", "me"), "user"),
    **dict.fromkeys(("assistant", "ai", "bot", "agent", "answer", "a", "gpt", "model"), "assistant"),
}
MARKED = math.log(0.98), math.log(0.01)  # a marker of the role, of another one
STAY = math.log(0.995), math.log(0.0025)  # role of a line without marker inside a row: as before, another


def lines_of(text: str | None) -> list[tuple[str | None, str, str]]:
    """(role of the marker, traits, line without its marker) of each line."""
    text = text or ""
    found = []
    for i, line in enumerate(text.split("\n")):
        m = MARKER.match(line)
        said = line[m.end() :] if m else line
        traits = f"{min(12, len(said).bit_length())}{'?' if said.rstrip().endswith('?') else '.'}"
        if i == 0:
            traits += f" {min(14, len(text).bit_length())} {min(6, text.count(chr(10)))}"
        found.append((SPEAKERS[m[1].lower()] if m else None, traits, said))
    return found


class Model:
    """Log probabilities from counts, with one added to each."""

    def __init__(self, starts: dict, steps: dict, traits: dict) -> None:
        k = len(ROLES)
        self.start = np.log(np.array([starts.get(r, 0) + 1 for r in ROLES], float))
        self.start -= np.logaddexp.reduce(self.start)
        step = np.array([[steps.get((a, b), 0) + 1 for b in ROLES] for a in ROLES], float)
        self.step = np.log(step / step.sum(1, keepdims=True))
        inside = np.full((k, k), STAY[1])
        np.fill_diagonal(inside, STAY[0])
        self.inside = inside
        seen: dict[str, np.ndarray] = {}
        totals = np.zeros((2, k))
        for (role, trait), n in traits.items():
            seen.setdefault(trait, np.zeros(k))[ROLES.index(role)] += n
            totals[int(" " in trait), ROLES.index(role)] += n
        kinds = [max(1, sum((" " in t) == first for t in seen)) for first in (False, True)]
        self.unseen = [np.log(1 / (totals[i] + kinds[i] + 1)) for i in (0, 1)]
        self.traits = {t: np.log((n + 1) / (totals[int(" " in t)] + kinds[int(" " in t)] + 1)) for t, n in seen.items()}

    def emission(self, marker: str | None, traits: str) -> np.ndarray:
        scores = self.traits.get(traits, self.unseen[int(" " in traits)])
        if marker is None:
            return scores
        return scores + np.array([MARKED[0] if r == marker else MARKED[1] for r in ROLES])

    def moves(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(transition into, emission of) every line of some rows."""
        for text in texts:
            for i, (marker, traits, _) in enumerate(lines_of(text)):
                yield (self.step if i == 0 or marker else self.inside), self.emission(marker, traits)


def reduced(model: Model, texts: list[str | None]) -> np.ndarray:
    """Best score from each role before the rows, or none (the last line), to each role at their end."""
    total = None
    for move, emission in model.moves(texts):
        if total is None:
            total = np.vstack([move, model.start]) + emission
        else:
            total = (total[:, :, None] + move[None]).max(1) + emission
    return total


def decoded(model: Model, texts: list[str | None], before: int, end: int | None = None) -> list[int]:
    """The best role of each line, given the role before (``NONE`` at a start) and the one at the end."""
    score, back = None, []
    for move, emission in model.moves(texts):
        if score is None:
            score = (move[before] if before != NONE else model.start) + emission
            continue
        ways = score[:, None] + move
        back.append(ways.argmax(0))
        score = ways.max(0) + emission
    at = int(score.argmax()) if end is None else end
    out = [at]
    for pointers in reversed(back):
        at = int(pointers[at])
        out.append(at)
    return out[::-1]


def render(role: str, text: str) -> str:
    return f"<|{role}|>\n{text.strip()}\n<|end|>"


def rows_of(turns: DataFrame) -> DataFrame:
    """Distinct (conv, turn, text) with the block of each: its place in the conversation by ``BLOCK``.

    Rows are ranged and sorted by all three, so a conversation may lie in any number
    of partitions. Each partition counts its rows of a conversation; the counts of
    the partitions before are added then, to those that go on with a conversation.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), "text").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, place = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            places = []
            for conv in batch.column("conv").to_pylist():
                place = place + 1 if conv == last else 0
                last = conv
                places.append(place)
            columns = [pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "part", "place"])

    ranged = rows.repartitionByRange("conv", "turn", "text").sortWithinPartitions("conv", "turn", "text")
    rows = stored(ranged.mapInArrow(count, f"conv {kind}, turn long, text string, part int, place long"), "rows")
    sizes = rows.groupBy("conv", "part").agg((F.max("place") + 1).alias("size"))
    before = F.sum("size").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # At most one conversation of each partition began before it.
    starts = sizes.withColumn("before", before).where("before > 0")
    same = F.col("l.conv").eqNullSafe(F.col("r.conv")) & (F.col("l.part") == F.col("r.part"))
    place = F.col("l.place") + F.coalesce("r.before", F.lit(0))
    joined = rows.alias("l").join(starts.alias("r"), same, "left")
    return joined.select("l.conv", "l.turn", "l.text", F.floor(place / BLOCK).alias("block"))


def train(turns: DataFrame) -> Model:
    """Counts of first roles, of roles that follow each other, and of line traits, over all labelled rows."""
    rows = turns.where(F.col("role").isin(*ROLES)).select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").distinct()
    one = rows.groupBy("conv_id", "turn").agg(F.min("role").alias("role"))
    later = one.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"))
    steps = one.join(later, ["conv_id", "turn"]).groupBy("role", "next").count().collect()
    first = one.groupBy("conv_id").agg(F.min_by("role", "turn").alias("role")).groupBy("role").count().collect()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, str], int] = {}
            for role, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for _, traits, _ in lines_of(text):
                    counts[role, traits] = counts.get((role, traits), 0) + 1
            columns = [pa.array(c, k) for c, k in zip(zip(*[(*key, n) for key, n in counts.items()]), (pa.string(), pa.string(), pa.int64()))]
            if columns:
                yield pa.RecordBatch.from_arrays(columns, ["role", "traits", "n"])

    # A few hundred traits at most: lengths are counted in powers of two.
    seen = rows.select("role", "text").mapInArrow(run, "role string, traits string, n long").groupBy("role", "traits").agg(F.sum("n").alias("n")).collect()
    return Model({r["role"]: r["count"] for r in first}, {(r["role"], r["next"]): r["count"] for r in steps}, {(r["role"], r["traits"]): r["n"] for r in seen})


def formatted(turns: DataFrame, model: Model) -> DataFrame:
    """conv_id, turn, part, role, rendered: the recovered turns of every conversation.

    ``turns`` has conv_id, turn and text; roles are not read.
    """
    shared = turns.sparkSession.sparkContext.broadcast(model)
    kind = turns.schema["conv_id"].dataType.simpleString()
    # A block of rows is one value: at most BLOCK rows. Nulls sort first.
    said = F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("said")
    blocks = stored(rows_of(turns).groupBy("conv", "block").agg(said), "transcripts")
    same = lambda other: F.col("l.conv").eqNullSafe(F.col(f"{other}.conv"))

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrices = [reduced(shared.value, [r["text"] for r in said]).ravel().tolist() for said in batch.column("said").to_pylist()]
            columns = [batch.column("conv"), batch.column("block"), pa.array(matrices, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["conv", "block", "matrix"])

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bounds([np.array(x["matrix"]).reshape(-1, len(ROLES)) for x in steps]) for steps in batch.column("steps").to_pylist()]
            limits = [
                [{"block": x["block"], "before": before, "end": end} for x, (before, end) in zip(steps, pairs)]
                for steps, pairs in zip(batch.column("steps").to_pylist(), found)
            ]
            item = pa.list_(pa.struct([("block", pa.int64()), ("before", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(limits, item)], ["conv", "limits"])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (conv, *turn)
                for conv, said, before, end in zip(*(batch.column(c).to_pylist() for c in ("conv", "said", "before", "end")))
                for turn in spoken(shared.value, said, NONE if before is None else before, end)
            ]
            columns = list(zip(*out)) or [[]] * 5
            kinds = [batch.schema.field("conv").type, pa.int64(), pa.int32(), pa.string(), pa.string()]
            names = ["conv_id", "turn", "part", "role", "rendered"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    # Only conversations of several blocks need to know what was before and what comes after.
    long = blocks.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = blocks.alias("l").join(long.alias("r"), same("r"), "left_semi")
    steps = parts.mapInArrow(shrink, f"conv {kind}, block long, matrix array<double>")
    steps = steps.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("block", "matrix"))).alias("steps"))
    limits = steps.mapInArrow(bound, f"conv {kind}, limits array<struct<block: long, before: int, end: int>>").select("conv", F.inline("limits"))
    both = same("r") & (F.col("l.block") == F.col("r.block"))
    joined = blocks.alias("l").join(limits.alias("r"), both, "left").select("l.conv", "l.said", "r.before", "r.end")
    return joined.mapInArrow(decode, f"conv_id {kind}, turn long, part int, role string, rendered string")


def bounds(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """The best roles before and at the end of each block of a conversation."""
    score, back = matrices[0][NONE], []
    for matrix in matrices[1:]:
        ways = score[:, None] + matrix[:NONE]
        back.append(ways.argmax(0))
        score = ways.max(0)
    ends = [int(score.argmax())]
    for pointers in reversed(back):
        ends.append(int(pointers[ends[-1]]))
    ends.reverse()
    return list(zip([NONE, *ends[:-1]], ends))


def spoken(model: Model, said: list[dict], before: int, end: int | None) -> Iterator[tuple[int, int, str, str]]:
    """(turn, part, role, rendered) of the rows of a block."""
    roles = iter(decoded(model, [row["text"] for row in said], before, end))
    for row in said:
        part, last, held = -1, None, []
        for marker, _, line in lines_of(row["text"]):
            role = next(roles)
            if role != last or (marker and held):
                if held:
                    yield row["turn"], part, ROLES[last], render(ROLES[last], "\n".join(held))
                part, last, held = part + 1, role, []
            held.append(line)
        yield row["turn"], part, ROLES[last], render(ROLES[last], "\n".join(held))
