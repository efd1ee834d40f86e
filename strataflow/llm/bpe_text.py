"""Byte-level BPE over many texts at once: pre-tokens are found on arrays of code points, and each distinct one is encoded once."""

from __future__ import annotations

import base64
import os
import unicodedata
from functools import cache, cached_property
from itertools import accumulate, chain

import numpy as np
import public_tokenizers
import regex

_U = np.uint64
#: Code points that \s of the pre-token pattern takes (Unicode White_Space), fixed values.
_SPACES = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
SPACE, LETTER, NUMBER, OTHER = range(4)


@cache
def classes() -> np.ndarray:
    """The class of each code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind in "LN":
            table[i] = LETTER if kind == "L" else NUMBER
    table[list(_SPACES)] = SPACE
    return table


@cache
def unassigned() -> np.ndarray:
    """Code points that Python's Unicode version doesn't know; a library may."""
    return np.fromiter((unicodedata.category(chr(i)) == "Cn" for i in range(0x110000)), bool, 0x110000)


@cache
def _probe():
    """Bytes, and the letter a or the digit 1 with a byte after it: those two are one token only if they share a pre-token."""
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    double = {x + bytes([b]): 256 * (k + 1) + b for k, x in enumerate((b"a", b"1")) for b in range(0x80, 256)}
    return tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=single | double, special_tokens={})


@cache
def class_by_library(code: int) -> int:
    """The class of a code point beyond ASCII that is no blank, as the library splits it."""
    for x, kind in (("a", LETTER), ("1", NUMBER)):
        if _probe().encode_ordinary(x + chr(code))[0] > 255:
            return kind
    return OTHER


def pre_tokens(codes: np.ndarray, firsts: np.ndarray, by_library: bool = False) -> np.ndarray:
    """Start of every pre-token of the pattern in public_tokenizers. ``firsts`` are the starts of the texts, empty ones left out.

    ``by_library``: code points unknown to Python are classed as tiktoken does, asked once for each that occurs.
    """
    n = len(codes)
    cls = classes()[codes]
    if by_library:
        at = np.nonzero(unassigned()[codes])[0]
        if len(at):
            new, which = np.unique(codes[at], return_inverse=True)
            cls[at] = np.array([class_by_library(c) for c in new.tolist()], np.uint8)[which]
    head = np.zeros(n + 1, bool)
    head[firsts] = True
    head[n] = True
    run = head.copy()
    run[1:n] |= cls[1:] != cls[:-1]
    start = run[:n].copy()
    # The last blank before other characters: a plain space leads the next pre-token, any other one stands alone.
    b = np.nonzero(run[1:n] & ~head[1:n] & (cls[: n - 1] == SPACE))[0] + 1
    start[b - 1] = True
    start[b[codes[b - 1] == 32]] = False
    # 's 't 'm 'd 're 've 'll where the apostrophe itself starts a pre-token and letters follow.
    q = np.nonzero(start & (codes == 0x27))[0]
    q = q[q + 1 < n]
    q = q[~head[q + 1] & (cls[q + 1] == LETTER)]
    if len(q):
        one = codes[q + 1]
        two = np.where(q + 2 < n, codes[np.minimum(q + 2, n - 1)], 0)
        two = np.where(head[np.minimum(q + 2, n)], 0, two)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long_ = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for hit, size in ((short, 2), (long_ & ~short, 3)):
            at = q[hit]
            start[at + 1] = False
            after = at[at + size < n] + size
            start[after[~head[after] & (cls[after] == LETTER)]] = True
    return np.nonzero(start)[0]


@cache
def _factors() -> tuple[np.ndarray, np.ndarray]:
    """Random numbers by code point, and odd ones by place in a word; places beyond them take the same again."""
    rng = np.random.default_rng(5)
    return rng.integers(0, 1 << 64, 0x110000, np.uint64), rng.integers(0, 1 << 63, 256, np.uint64) * _U(2) + _U(1)


class Split:
    """Texts cut into pre-tokens: the distinct ones (words), and for each occurrence which."""

    def __init__(self, texts: list[str], by_library: bool = False):
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.joined = "".join(texts)
        self.codes = codes = np.frombuffer(self.joined.encode("utf-32-le"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum(self.lengths)])
        firsts = bounds[:-1][self.lengths > 0]
        starts = pre_tokens(codes, firsts, by_library) if len(codes) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(codes))
        #: Number of pre-tokens of each text.
        self.counts = np.diff(np.searchsorted(starts, bounds)) if len(codes) else np.zeros(len(texts), np.int64)
        first, self.which, self.names = self._distinct(starts, ends)
        #: First occurrence of each word.
        self.starts, self.ends = starts[first], ends[first]

    def _distinct(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """First occurrence of each word, the word of each occurrence, and the words' names, ascending; none if two words share one."""
        codes, none = self.codes, np.zeros(0, np.int64)
        if not len(starts):
            return none, none, none.astype(np.uint64)
        sizes, (by_code, by_place) = ends - starts, _factors()
        place = np.arange(len(codes))
        place -= np.repeat(starts, sizes)
        place &= len(by_place) - 1
        x = by_code[codes]
        x *= by_place[place]
        names = np.add.reduceat(x, starts)
        del x, place
        order = np.argsort(names)
        k = names[order]
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        firsts = order[new]
        which = np.empty(len(k), np.int64)
        which[order] = np.cumsum(new) - 1
        # Equal names must be equal strings: compare every occurrence with its first.
        if (sizes == sizes[firsts][which]).all() and (codes[np.arange(len(codes)) + np.repeat(starts[firsts][which] - starts, sizes)] == codes).all():
            return firsts, which, k[new]
        index: dict[str, int] = {}
        every = np.array([index.setdefault(self.joined[a:b], len(index)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)
        return np.unique(every, return_index=True)[1], every, None

    def some(self, at: np.ndarray) -> list[str]:
        """Those words as strings."""
        return [self.joined[a:b] for a, b in zip(self.starts[at].tolist(), self.ends[at].tolist(), strict=True)]

    @cached_property
    def words(self) -> list[str]:
        return self.some(np.arange(len(self.starts)))


@cache
def ranks(name: str) -> dict[bytes, int]:
    with open(name if os.path.isabs(name) else public_tokenizers.path(name), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@cache
def _encoder(name: str):
    import tiktoken

    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(name), special_tokens={})


def encode_words(words: list[str], name: str) -> list[list[int]]:
    """Ids of single pre-tokens by the ranks of a file."""
    one = _encoder(name)._core_bpe.encode_single_piece
    return [one(w.encode()) for w in words]


@cache
def _model(name: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))


@cache
def _byte_letters() -> np.ndarray:
    """The code point of the printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return np.array([b if b in own else next(rest) for b in range(256)], "<u4")


def model_encode_words(words: list[str], name: str) -> list[tuple[int, ...]]:
    """Ids of single pre-tokens by the BPE model of a tokenizers file; as tuples, which the garbage collector doesn't follow."""
    tokenize, raw = _model(name).model.tokenize, [w.encode() for w in words]
    # A letter for each byte, so words keep their places.
    letters = _byte_letters()[np.frombuffer(b"".join(raw), np.uint8)].tobytes().decode("utf-32-le")
    ends = list(accumulate(map(len, raw)))
    return [tuple([t.id for t in tokenize(letters[a:b])]) for a, b in zip([0, *ends], ends, strict=False)]


_WORD = regex.compile(r"[\p{Alphabetic}\p{M}\p{Nd}\p{Pc}\p{Join_Control}]")
_BLANKS, _BLANKS_BEFORE = regex.compile(r"\p{White_Space}*"), regex.compile(r"(?r)\p{White_Space}*")


class AddedTokens:
    """The added tokens of a tokenizers file, found as the library does: the longest of the leftmost, those that are not normalized first."""

    def __init__(self, name: str):
        self.passes = []
        every = _model(name).get_added_tokens_decoder()
        for normalized in (False, True):
            tokens = {t.content: (i, t) for i, t in every.items() if t.content and t.normalized == normalized}
            if tokens:
                self.passes.append((regex.compile("|".join(map(regex.escape, sorted(tokens, key=len, reverse=True)))), tokens))

    def within(self, text: str) -> bool:
        return any(pattern.search(text) for pattern, _ in self.passes)

    def cut(self, text: str) -> list[str | int]:
        """Parts between added tokens, and those tokens' ids, in order."""
        out: list[str | int] = [text]
        for one in self.passes:
            out = [y for x in out for y in (self._cut(x, *one) if isinstance(x, str) else [x])]
        return out

    @staticmethod
    def _cut(text: str, pattern: regex.Pattern, tokens: dict) -> list[str | int]:
        out, done = [], 0
        for m in pattern.finditer(text):
            (number, token), (a, b) = tokens[m[0]], m.span()
            if token.single_word and (a and _WORD.match(text, a - 1) or _WORD.match(text, b)):
                continue
            if token.lstrip:
                a = max(done, _BLANKS_BEFORE.match(text, 0, a).start())
            if token.rstrip:
                b = _BLANKS.match(text, b).end()
            out += [text[done:a], number] if done < a else [number]
            done = b
        return [*out, text[done:]] if done < len(text) else out


class Known:
    """Words and their ids, as arrays: found by name, then compared by code points."""

    def __init__(self):
        none = np.zeros(0, np.int64)
        self.names, self.codes, self.ids = none.astype(np.uint64), none.astype(np.uint32), none
        #: Per name: start and number of code points, start and number of ids.
        self.code_at = self.length = self.id_at = self.size = none

    def find(self, split: Split, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the words ``at`` are known, as places in ``at``, and which known ones they are."""
        lengths = (split.ends - split.starts)[at]
        k = np.searchsorted(self.names, split.names[at])
        k[k == len(self.names)] = 0
        hit = np.nonzero((self.names[k] == split.names[at]) & (self.length[k] == lengths))[0] if len(self.names) else np.zeros(0, np.int64)
        if not len(hit):
            return hit, hit
        k, n = k[hit], lengths[hit]
        same = gather(self.codes, self.code_at[k], n) == gather(split.codes, split.starts[at[hit]], n)
        same = np.logical_and.reduceat(same, np.cumsum(n) - n)
        return hit[same], k[same]

    def add(self, split: Split, at: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        lengths = (split.ends - split.starts)[at]
        names = np.concatenate([self.names, split.names[at]])
        order = np.argsort(names, kind="stable")
        rows = (
            (self.code_at, len(self.codes) + np.cumsum(lengths) - lengths),
            (self.length, lengths),
            (self.id_at, len(self.ids) + np.cumsum(sizes) - sizes),
            (self.size, sizes),
        )
        self.names = names[order]
        self.code_at, self.length, self.id_at, self.size = (np.concatenate(x)[order] for x in rows)
        self.codes = np.concatenate([self.codes, gather(split.codes, split.starts[at], lengths)])
        self.ids = np.concatenate([self.ids, ids])


class Encoder:
    """Texts to ids with a tokenizers file; words seen before in this task are remembered, up to a bound. Those not seen for longest go first."""

    def __init__(self, name: str, remember: int = 200_000):
        self.name, self.remember = name, remember
        # When the first holds half of the bound it takes the second's place.
        self.known, self.before = Known(), Known()
        self.added = AddedTokens(name)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other (int64), and how many each text has. Added tokens are cut out before pre-tokens are found."""
        if not any(map(self.added.within, texts)):
            return self._plain(texts)
        parts, owners, before, tokens, sizes = [], [], [], [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            for x in self.added.cut(text) if self.added.within(text) else [text]:
                if isinstance(x, str):
                    parts.append(x)
                    owners.append(k)
                else:
                    before.append(len(parts))
                    tokens.append(x)
                    sizes[k] += 1
        ids, counts = self._plain(parts)
        np.add.at(sizes, np.array(owners, np.int64), counts)
        return np.insert(ids, np.concatenate([[0], np.cumsum(counts)])[before], tokens), sizes

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = Split(texts)
        if not len(split.starts):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        flat, starts, sizes = self._ids(split)
        per_word = sizes[split.which]
        return gather(flat, starts[split.which], per_word), per_text(per_word, split.counts)

    def _ids(self, split: Split) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each word's start and how many they are."""
        if len(self.known.names) > self.remember // 2:
            self.known, self.before = Known(), self.known
        starts, sizes = np.empty((2, len(split.starts)), np.int64)
        at, before, late = np.arange(len(starts)), 0, np.zeros(0, np.int64)
        if split.names is not None:
            for known in (self.known, self.before):
                hit, k = known.find(split, at)
                starts[at[hit]], sizes[at[hit]] = known.id_at[k] + before, known.size[k]
                at, before = np.delete(at, hit), before + len(known.ids)
                late = at if known is self.known else late
        fresh = model_encode_words(split.some(at), self.name)
        sizes[at] = np.fromiter(map(len, fresh), np.int64, len(fresh))
        starts[at] = before + np.cumsum(sizes[at]) - sizes[at]
        new = np.fromiter(chain.from_iterable(fresh), np.int64, int(sizes[at].sum()))
        flat = new if split.names is None else np.concatenate([self.known.ids, self.before.ids, new])
        if len(late):
            self.known.add(split, late, gather(flat, starts[late], sizes[late]), sizes[late])
        return flat, starts, sizes


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of ``flat`` one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]


def per_text(per_word: np.ndarray, counts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(per_word)])
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]
