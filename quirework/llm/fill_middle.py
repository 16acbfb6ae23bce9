"""Fill-in-the-middle transformation by a parallel automaton scan.

A text is a sequence of units (lines with their ends). Two cuts between units part it into prefix, middle and suffix,
which are put out as prefix-suffix-middle or suffix-prefix-middle, each part behind its mark. One automaton over bytes
finds the ends of units and whether a mark stands in the text:

1. A document is scanned in chunks, each from every state that the automaton may be in where the chunk begins: the chunk
   gives a transition function (start state to end state) and the units that end in it, for each start state. Chunks
   need no knowledge of each other; documents of more than ``chunk`` bytes are dealt out by chunk over all tasks.
2. Transition functions are composed in order, which is associative: prefix sums in a logarithmic number of rounds give
   each chunk's entry state and the units before it.
3. The two cuts are selected by the units before each chunk, and only the chunks they fall into are scanned once more,
   from their entry state, to the byte of the cut.

A cut is drawn by hash of ``seed`` and id, so reruns agree. What meets in one task for one document is its chunks'
functions (about 100 bytes for each chunk, under 10 MB for the longest text that a row can hold), never its chunks.

Defined results: null and empty texts have no unit and stay as they are (``plain``), like texts that hold a mark; a null
id is hashed as no digits; repeated rows are documents of their own, and equal ids give equal draws; a text of one line
has one unit; a text of any length is cut as a whole; an empty table gives an empty result; columns of the input besides
id and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.llm.shared import slices, stage
from quirework.llm.tokens import Text

#: Bytes of a lane: what one step of a scan reads one byte of.
_LANE = 512
_CUT = "doc_id long, text string, n long, marked boolean, first long, second long"


@dataclass(frozen=True)
class Automaton:
    """A deterministic automaton over bytes that starts in state 0.

    ``kind`` is the class of each byte; ``step`` and ``ends`` (class, state) give the next state and whether a unit ends
    with the byte; ``tail`` whether the end of a text ends a unit in a state, ``marked`` whether a mark has been seen.
    """

    kind: np.ndarray
    step: np.ndarray
    ends: np.ndarray
    tail: np.ndarray
    marked: np.ndarray

    @property
    def states(self) -> int:
        return self.step.shape[1]


def unit_automaton(marks: tuple[str, ...], end: bytes = b"\n") -> Automaton:
    """Units end with the byte ``end`` or the text; the smallest automaton that also finds ``marks``."""
    coded = [m.encode() for m in marks]
    begun = sorted({m[:k] for m in coded for k in range(len(m))} | {b""}, key=lambda p: (len(p), p))
    found = len(begun)
    letters = sorted({bytes([x]) for m in coded for x in m} | {end})
    kind = np.zeros(256, np.uint8)
    for k, letter in enumerate(letters):
        kind[letter[0]] = k + 1
    states = [(inside, seen) for inside in (0, 1) for seen in range(found + 1)]
    step = np.zeros((len(letters) + 1, len(states)), np.int64)
    ends = np.zeros(step.shape, np.int64)
    for k, letter in enumerate([None, *letters]):
        for q, (inside, seen) in enumerate(states):
            if seen < found:
                read = begun[seen] + letter if letter else b""
                seen = found if any(read.endswith(m) for m in coded) else max(i for i, p in enumerate(begun) if read.endswith(p))
            ends[k, q] = letter == end
            step[k, q] = states.index((int(letter != end), seen))
    accepts = np.array([[inside, seen == found] for inside, seen in states])
    group = accepts @ np.array([2, 1])
    while True:  # states stay together as long as every byte leads them to the same groups
        _, finer = np.unique(np.vstack([group, group[step], ends]).T, axis=0, return_inverse=True)
        if len(np.unique(finer)) == len(np.unique(group)):
            break
        group = finer
    first = np.unique(group, return_index=True)[1]
    first = first[np.argsort(first)]  # the start state stays 0
    place = np.argsort(np.argsort(np.unique(group, return_index=True)[1]))[np.unique(group, return_inverse=True)[1]]
    return Automaton(kind, place[step[:, first]], ends[:, first], accepts[first, 0], accepts[first, 1].astype(bool))


def scan(auto: Automaton, kinds: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end state, units ended) of each lane for each start state; all lanes advance a byte at a time."""
    order = np.argsort(-length, kind="stable")
    begin, falling = start[order], -length[order]
    lanes, states = len(order), auto.states
    step, ends = auto.step.ravel(), auto.ends.ravel()
    state = np.tile(np.arange(states), (lanes, 1))
    units = np.zeros((lanes, states), np.int64)
    for k in range(int(length.max(initial=0))):
        live = int(np.searchsorted(falling, -k))
        at = kinds[begin[:live] + k].astype(np.int64)[:, None] * states + state[:live]
        units[:live] += ends.take(at)
        state[:live] = step.take(at)
    back = np.empty_like(order)
    back[order] = np.arange(lanes)
    return state[back], units[back]


def compose(state: np.ndarray, units: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Functions of all pieces up to and with each one, since the last one marked ``fresh``, by doubling."""
    state, units = state.copy(), units.copy()
    since = np.arange(len(fresh)) - np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))
    reach = 1
    while reach <= since.max(initial=0):
        later = np.flatnonzero(since >= reach)
        between = state[later - reach]
        ended = units[later - reach] + np.take_along_axis(units[later], between, 1)
        state[later], units[later] = np.take_along_axis(state[later], between, 1), ended
        reach *= 2
    return state, units


def walk(auto: Automaton, kinds: np.ndarray, start: np.ndarray, length: np.ndarray, state: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Bytes from ``start`` until ``units`` (one or more) have ended; ``length`` if they don't end before it."""
    state, left, out = state.copy(), units.copy(), length.copy()
    live = np.arange(len(start))
    for k in range(int(length.max(initial=0))):
        live = live[(length[live] > k) & (left[live] > 0)]
        if not len(live):
            break
        at = kinds[start[live] + k].astype(np.int64) * auto.states + state[live]
        left[live] -= auto.ends.ravel()[at]
        state[live] = auto.step.ravel()[at]
        out[live[left[live] == 0]] = k + 1
    return out


def _lanes(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length) of the lanes of byte ranges; an empty range has one empty lane."""
    count = np.maximum(1, -(-(end - begin) // _LANE))
    row = np.repeat(np.arange(len(begin)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = begin[row] + nth * _LANE
    return row, start, np.minimum(_LANE, end[row] - start)


def _functions(auto: Automaton, kinds: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """Lanes of byte ranges with the function of each range up to and with each lane."""
    row, start, length = _lanes(begin, end)
    fresh = np.ones(len(row), bool)
    fresh[1:] = row[1:] != row[:-1]
    state, units = compose(*scan(auto, kinds, start, length), fresh)
    return row, start, length, fresh, state, units


def _locate(auto: Automaton, kinds: np.ndarray, lanes: tuple, entry: np.ndarray, ranges: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For some ranges, the byte after their ``wanted``-th unit, which must end within them; ``entry`` is each range's state.

    The first lane that reaches the number holds the cut; all those lanes are read again together.
    """
    row, start, length, fresh, state, units = lanes
    at = np.arange(len(row))
    into, passed = state[at, entry[row]], units[at, entry[row]]
    last = np.append(np.flatnonzero(fresh)[1:], len(row)) - 1
    before = np.concatenate([[0], np.cumsum(passed[last])])
    lane = np.searchsorted(passed + before[row], wanted + before[ranges])
    first = fresh[lane]
    state_there, units_there = np.where(first, entry[ranges], into[lane - 1]), np.where(first, 0, passed[lane - 1])
    return start[lane] + walk(auto, kinds, start[lane], length[lane], state_there, wanted - units_there)


def _characters(data: np.ndarray) -> np.ndarray:
    """Characters (code points) before each byte, and of all."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


def _cut_short(auto: Automaton):
    """Both cuts of documents that are one chunk each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            text = Text.of(batch.column("text"))
            kinds, before = auto.kind[text.data], _characters(text.data)
            begin, end = text.offsets[:-1], text.offsets[1:]
            lanes = _functions(auto, kinds, begin, end)
            row, _, _, fresh, state, units = lanes
            last = np.append(np.flatnonzero(fresh)[1:], len(row)) - 1
            ended, final = units[last, 0], state[last, 0]
            n = ended + auto.tail[final]
            draws = [batch.column(h).to_numpy() % (n + 1) for h in ("h1", "h2")]
            cuts = []
            for wanted in (np.minimum(*draws), np.maximum(*draws)):
                at = np.where(wanted > ended, end, begin)
                inside = np.flatnonzero((wanted > 0) & (wanted <= ended))
                at[inside] = _locate(auto, kinds, lanes, np.zeros(len(n), np.int64), inside, wanted[inside])
                cuts.append(before[at] - before[begin])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(n), pa.array(auto.marked[final]), *map(pa.array, cuts)],
                names=["doc_id", "text", "n", "marked", "first", "second"],
            )

    return run


def _split(chunk: int):
    """The chunks of long documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for k in range(batch.num_rows):
                data = batch.column("text")[k].as_buffer()
                parts = range(0, data.size, chunk)
                same = [pa.array([batch.column(c)[k].as_py()] * len(parts), pa.int64()) for c in ("row", "h1", "h2")]
                for some in range(0, len(parts), 64):
                    held = [data.slice(at, min(chunk, data.size - at)).to_pybytes() for at in parts[some : some + 64]]
                    yield pa.RecordBatch.from_arrays(
                        [*(x.slice(some, len(held)) for x in same), pa.array(range(some, some + len(held)), pa.int64()), pa.array(held, pa.binary())],
                        names=["row", "h1", "h2", "part", "bytes"],
                    )

    return run


def _transitions(auto: Automaton):
    """The transition function of each chunk, with its units for each start state and its characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes"):
            column = batch.column("bytes").cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            begin, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
            row, _, _, fresh, state, units = _functions(auto, auto.kind[data], begin, end)
            last = np.append(np.flatnonzero(fresh)[1:], len(row)) - 1
            before = _characters(data)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "h1", "h2", "part")), pa.array(list(state[last])), pa.array(list(units[last])), pa.array(before[end] - before[begin])],
                names=["row", "h1", "h2", "part", "state", "units", "chars"],
            )

    return run


def _select(auto: Automaton):
    """Of one document's functions: its units, and for each cut the chunk, entry state, units to go and characters before."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        shape = (group.num_rows, auto.states)
        own = [np.stack(group.column(c).to_numpy()).reshape(shape) for c in ("state", "units")]
        fresh = np.zeros(group.num_rows, bool)
        fresh[0] = True
        state, units = compose(*own, fresh)
        chars = np.concatenate([[0], np.cumsum(group.column("chars").to_numpy())])
        ended, final = int(units[-1, 0]), state[-1, 0]
        n = ended + int(auto.tail[final])
        draws = [group.column(h)[0].as_py() % (n + 1) for h in ("h1", "h2")]
        out = {"row": group.column("row")[0].as_py(), "n": n, "marked": bool(auto.marked[final])}
        for name, wanted in (("first", min(draws)), ("second", max(draws))):
            if wanted == 0 or wanted > ended:
                out[name] = {"part": -1, "state": 0, "left": 0, "chars": 0 if wanted == 0 else int(chars[-1])}
            else:
                part = int(np.searchsorted(units[:, 0], wanted))
                entry, passed = (int(state[part - 1, 0]), int(units[part - 1, 0])) if part else (0, 0)
                out[name] = {"part": part, "state": entry, "left": wanted - passed, "chars": int(chars[part])}
        cut = pa.struct([("part", pa.int64()), ("state", pa.int64()), ("left", pa.int64()), ("chars", pa.int64())])
        kinds = pa.schema([("row", pa.int64()), ("n", pa.int64()), ("marked", pa.bool_()), ("first", cut), ("second", cut)])
        return pa.Table.from_pylist([out], kinds)

    return run


def _cut_long(auto: Automaton, chunk: int):
    """Scan the selected chunks of long documents again, to the cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            cuts = {}
            for name in ("first", "second"):
                part, entry, left, chars = (batch.column(name).field(k).to_numpy().copy() for k in range(4))
                inside = np.flatnonzero(part >= 0)
                held = [np.frombuffer(batch.column("text")[k].as_buffer(), np.uint8)[part[k] * chunk : (part[k] + 1) * chunk] for k in inside.tolist()]
                if held:
                    data = np.concatenate(held)
                    ends = np.cumsum([len(x) for x in held])
                    begin = ends - [len(x) for x in held]
                    kinds, before = auto.kind[data], _characters(data)
                    lanes = _functions(auto, kinds, begin, ends)
                    found = _locate(auto, kinds, lanes, entry[inside], np.arange(len(inside)), left[inside])
                    chars[inside] += before[found] - before[begin]
                cuts[name] = chars
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "text", "n", "marked")), *(pa.array(x, pa.int64()) for x in cuts.values())],
                names=["doc_id", "text", "n", "marked", "first", "second"],
            )

    return run


def _draw(digest: Column, k: int) -> Column:
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 7,
    percent: int = 100,
    spm_percent: int = 50,
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>"),
    chunk: int = 1 << 15,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every document.

    ``percent`` of the documents are transformed, ``spm_percent`` of those to suffix-prefix-middle. ``marks`` stand before
    prefix, suffix and middle; the first character of each must stand nowhere else in them, so that no text can make up a
    mark with what follows it. ``output`` gives back the text by ``restored``.
    """
    if any(not m or any(c in m[1:] for c in {x[0] for x in marks if x}) for m in marks) or len(set(marks)) < 3:
        raise ValueError("marks must be distinct and begin with characters that stand nowhere else in them")
    auto = unit_automaton(marks)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        _draw(digest, 0).alias("h1"),
        _draw(digest, 1).alias("h2"),
    )
    is_long = F.octet_length("text") > chunk
    short = rows.where(~is_long).mapInArrow(_cut_short(auto), _CUT)
    long = stage(rows.where(is_long).select(F.monotonically_increasing_id().alias("row"), "*"), "long-texts")
    parts = long.mapInArrow(_split(chunk), "row long, h1 long, h2 long, part long, bytes binary").repartition("row", "part")
    functions = parts.mapInArrow(
        _transitions(auto), "row long, h1 long, h2 long, part long, state array<long>, units array<long>, chars long"
    )
    cut = "struct<part:long,state:long,left:long,chars:long>"
    selected = functions.groupBy("row").applyInArrow(_select(auto), f"row long, n long, marked boolean, first {cut}, second {cut}")
    cuts = short.unionByName(long.join(selected, "row").mapInArrow(_cut_long(auto, chunk), _CUT))
    again = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    plain = (F.col("text") == "") | F.col("marked") | (_draw(again, 2) % 100 >= percent)
    prefix = F.substr("text", F.lit(1), F.col("first").cast("int"))
    middle = F.substr("text", (F.col("first") + 1).cast("int"), (F.col("second") - F.col("first")).cast("int"))
    suffix = F.substr("text", (F.col("second") + 1).cast("int"))
    p, s, m = map(F.lit, marks)
    form = F.when(plain, "plain").when(_draw(again, 3) % 100 < spm_percent, "spm").otherwise("psm")
    formed = cuts.withColumn("form", form)
    return formed.select(
        "doc_id",
        "n",
        "form",
        F.when(F.col("form") != "plain", F.col("first")).alias("prefix_chars"),
        F.when(F.col("form") != "plain", F.col("second") - F.col("first")).alias("middle_chars"),
        F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(F.col("text"))
        .alias("output"),
    )


def restored(output: Column, form: Column, marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> Column:
    """The text that ``fill_in_middle`` made an output of, by the output and its form alone."""
    parts = F.split(output, "|".join(re.escape(m) for m in marks))
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
