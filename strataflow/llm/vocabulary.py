"""A vocabulary as minimal acyclic transducers: (lang, term) pairs to lexicographic ordinals and back.

The pairs are sorted over the cluster; each task builds automata of at most ``PART_TERMS`` pairs from its sorted run and writes them
to the shared folder. Whoever reads them holds one part at a time, so memory is bounded whatever the vocabulary's size; the
driver holds a line per part. Ordinals count through all parts, so within a lang they follow the UTF-8 order of its terms.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import pack, rows_to_batches, stored, unpack
from strataflow.sources.files import make_folder, new_scratch

#: Pairs in one automaton.
PART_TERMS = 1 << 17
#: Transitions a task keeps loaded before it lets go of the part used longest ago.
LOADED_EDGES = 4 << 20
#: Ends the lang in a pair; no UTF-8 text holds this byte.
MARK = b"\xff"
#: Bytes of text that are walked together.
WALK_BYTES = 4 << 20
_U = np.uint64


def minimal(entries: Iterable[bytes]) -> Transducer:
    """The minimal automaton of entries that come sorted and distinct: a state is frozen, and shared with an equal one, once no later entry can change it."""
    register: dict[tuple, int] = {}
    counts: list[int] = []
    path: list[list] = [[False, []]]  # the states along the last entry: is it final, its transitions so far

    def freeze(depth: int) -> None:
        while len(path) > depth:
            final, edges = path.pop()
            key = (final, tuple(edges))
            state = register.setdefault(key, len(register))
            if state == len(counts):
                counts.append(final + sum(counts[t] for _, t in edges))
            if path:
                path[-1][1].append((last[len(path) - 1], state))

    last = b""
    for entry in entries:
        same = 0
        for x, y in zip(entry, last, strict=False):
            if x != y:
                break
            same += 1
        freeze(same + 1)
        path.extend([False, []] for _ in range(len(entry) - same))
        path[-1][0] = True
        last = entry
    freeze(0)
    keys, targets, outs = [], [], []
    for state, (final, edges) in enumerate(register):
        ahead = int(final)
        for label, target in edges:
            keys.append(state << 8 | label)
            targets.append(target)
            outs.append(ahead)
            ahead += counts[target]
    final = np.fromiter((f for f, _ in register), np.uint8, len(register))
    return Transducer(np.array(keys, np.int64), np.array(targets, np.int32), np.array(outs, np.int32), final)


class Transducer:
    """Transitions as parallel arrays in order of (state, label). A transition's output counts the entries before those it leads
    to, so the outputs along an entry add up to its ordinal. The root is the last state."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray, outs: np.ndarray, final: np.ndarray):
        self.keys, self.targets, self.outs, self.final = keys, targets, outs, final
        self.root = len(final) - 1
        self.mask = (1 << (2 * len(keys) + 1).bit_length()) - 1
        self.table = np.full(self.mask + 1, -1, np.int32)
        slots, left = self._slot(keys), np.arange(len(keys), dtype=np.int32)
        while len(left):
            at = slots[left]
            open_ = self.table[at] < 0
            self.table[at[open_]] = left[open_]
            left = left[self.table[at] != left]
            slots[left] = (slots[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        x = keys.astype(_U) * _U(0x9E3779B97F4A7C15)
        return ((x >> _U(32)) & _U(self.mask)).astype(np.int64)

    def step(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The transition from each state by its label, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(states), -1, np.int64)
        keys = states.astype(np.int64) << 8 | labels
        slots = self._slot(keys)
        found = self.table[slots].astype(np.int64)
        open_ = np.nonzero((found >= 0) & (self.keys[found] != keys))[0]
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            found[open_] = self.table[slots[open_]]
            there = found[open_]
            open_ = open_[(there >= 0) & (self.keys[there] != keys[open_])]
        return found

    def follow(self, head: bytes) -> tuple[int, int] | None:
        """State and ordinal so far after ``head``."""
        state, before = self.root, 0
        for label in head:
            (edge,) = self.step(np.array([state]), np.array([label]))
            if edge < 0:
                return None
            state, before = int(self.targets[edge]), before + int(self.outs[edge])
        return state, before

    def walk(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, head: bytes = b"") -> np.ndarray:
        """The ordinal of ``head`` + each stretch of ``data``, -1 where it is no entry. All stretches go a byte further at a time."""
        result = np.full(len(starts), -1, np.int64)
        at = self.follow(head)
        if at is None or not len(starts):
            return result
        alive, places, stops = np.arange(len(starts)), starts.astype(np.int64), ends
        states, sums = np.full(len(starts), at[0], np.int32), np.full(len(starts), at[1], np.int64)
        while len(alive):
            done = places == stops
            if done.any():
                hit = done & (self.final[states] > 0)
                result[alive[hit]] = sums[hit]
                go = ~done
                alive, places, stops, states, sums = alive[go], places[go], stops[go], states[go], sums[go]
            edges = self.step(states, data[places])
            go = edges >= 0
            alive, places, stops, edges = alive[go], places[go] + 1, stops[go], edges[go]
            states, sums = self.targets[edges], sums[go] + self.outs[edges]
        return result

    def entry(self, ordinal: int) -> bytes:
        """The entry of an ordinal: at each state the last transition whose output is not beyond what is left."""
        state, out = self.root, bytearray()
        while True:
            if self.final[state] and not ordinal:
                return bytes(out)
            first, stop = np.searchsorted(self.keys, [state << 8, (state + 1) << 8])
            edge = int(first) + int(np.searchsorted(self.outs[first:stop], ordinal, side="right")) - 1
            out.append(int(self.keys[edge]) & 255)
            ordinal -= int(self.outs[edge])
            state = int(self.targets[edge])

    def dump(self) -> bytes:
        return pack(self.keys, self.targets, self.outs, self.final)

    @classmethod
    def load(cls, data: bytes) -> Transducer:
        return cls(*unpack(data, np.int64, np.int32, np.int32, np.uint8))


@dataclass(frozen=True)
class Part:
    """One automaton: its least and greatest entry, its entries, the entries of all parts before it, its file."""

    first: bytes
    last: bytes
    count: int
    before: int
    name: str


_PARTS = pa.schema([("first", pa.binary()), ("last", pa.binary()), ("n", pa.int64()), ("name", pa.string())])


def _uri(folder: str) -> str:
    return folder if "://" in folder else "file://" + folder.removeprefix("file:")


def _write_parts(uri: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(uri)

        def rows() -> Iterator[tuple]:
            held: list[bytes] = []

            def close() -> tuple:
                name = f"{uuid.uuid4().hex}.mat"
                with store.open_output_stream(f"{root}/{name}") as f:
                    f.write(minimal(held).dump())
                return held[0], held[-1], len(held), name

            for b in batches:
                for entry in b.column(0):
                    held.append(entry.as_py())
                    if len(held) == most:
                        yield close()
                        held.clear()
            if held:
                yield close()

        yield from rows_to_batches(rows(), _PARTS)

    return run


def build(kept: DataFrame, part_terms: int = PART_TERMS) -> Vocabulary:
    """``kept`` has distinct (lang string, term binary). Files that lost attempts left behind are not listed and not read."""
    spark = kept.sparkSession
    folder = new_scratch(spark, "vocabulary")
    make_folder(spark, folder)
    entry = F.concat(F.col("lang").cast("binary"), F.lit(MARK), F.col("term"))
    ordered = kept.select(entry.alias("entry")).repartitionByRange("entry").sortWithinPartitions("entry")
    lines = stored(ordered.mapInArrow(_write_parts(_uri(folder), part_terms), "first binary, last binary, n long, name string"), "parts")
    parts, before = [], 0
    for r in lines.orderBy("first").collect():
        parts.append(Part(bytes(r["first"]), bytes(r["last"]), r["n"], before, r["name"]))
        before += r["n"]
    return Vocabulary(_uri(folder), parts)


class Vocabulary:
    """Goes to tasks as it is: the folder and a line per part."""

    def __init__(self, uri: str, parts: list[Part]):
        self.uri, self.parts = uri, parts
        self._loaded: OrderedDict[str, Transducer] = OrderedDict()

    def __getstate__(self) -> tuple:
        return self.uri, self.parts

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def load(self, part: Part) -> Transducer:
        if part.name not in self._loaded:
            from pyarrow import fs

            store, root = fs.FileSystem.from_uri(self.uri)
            with store.open_input_stream(f"{root}/{part.name}") as f:
                self._loaded[part.name] = Transducer.load(f.read())
        self._loaded.move_to_end(part.name)
        while len(self._loaded) > 1 and sum(len(t.keys) for t in self._loaded.values()) > LOADED_EDGES:
            self._loaded.popitem(last=False)
        return self._loaded[part.name]

    def _of_lang(self, lang: bytes) -> list[Part]:
        low, high = lang + MARK, lang + MARK + MARK
        return self.parts[bisect_left(self.parts, low, key=lambda p: p.last) : bisect_right(self.parts, high, key=lambda p: p.first)]

    def ordinals(self, lang: bytes, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The ordinal of each stretch of ``data`` as a term of ``lang``, -1 where it is none. With several parts a stretch visits only those whose range its first bytes allow."""
        result = np.full(len(starts), -1, np.int64)
        parts = self._of_lang(lang)
        heads = _heads(data, starts, ends) if len(parts) > 1 else None
        for part in parts:
            machine = self.load(part)
            if heads is None:
                mine = slice(None)
            else:
                low = _head(part.first[len(lang) + 1 :]) if part.first.startswith(lang + MARK) else _U(0)
                high = _head(part.last[len(lang) + 1 :]) if part.last.startswith(lang + MARK) else _U(2**64 - 1)
                mine = np.nonzero((heads >= low) & (heads <= high))[0]
            got = machine.walk(data, starts[mine], ends[mine], lang + MARK)
            result[mine] = np.where(got >= 0, got + part.before, result[mine])
        return result

    def pair(self, ordinal: int) -> tuple[str, bytes]:
        """Lang and term of an ordinal."""
        part = self.parts[bisect_right(self.parts, ordinal, key=lambda p: p.before) - 1]
        lang, term = self.load(part).entry(ordinal - part.before).split(MARK, 1)
        return lang.decode(), term


def _head(term: bytes) -> np.uint64:
    return _U(int.from_bytes(term[:8].ljust(8, b"\0"), "big"))


def _heads(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first eight bytes of each stretch as a number, in the order of the bytes."""
    out = np.zeros(len(starts), _U)
    for k in range(8):
        at = starts + k
        byte = np.where(at < ends, data[np.minimum(at, len(data) - 1)], 0).astype(_U)
        out = out << _U(8) | byte
    return out


def stretches(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    return np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]


def joined(texts: Iterable[bytes], gap: bytes, cut: Callable[[bytes, int], int], most: int = WALK_BYTES) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Texts as buffers of about ``most`` bytes, each followed by ``gap``: the buffer, where its pieces start, and which text each is of.
    A longer text goes on in the next buffer from ``cut(text, at)``, the first place from ``at`` on where it may be cut."""
    held, starts, owners, size = [], [], [], 0
    for k, text in enumerate(texts):
        at = 0
        while True:
            stop = len(text) if len(text) - at <= most else cut(text, at + most)
            held += [text[at:stop], gap]
            starts.append(size)
            owners.append(k)
            size += stop - at + len(gap)
            at = stop
            if size >= most:
                yield b"".join(held), np.array(starts), np.array(owners)
                held, starts, owners, size = [], [], [], 0
            if at >= len(text):
                break
    if held:
        yield b"".join(held), np.array(starts), np.array(owners)
