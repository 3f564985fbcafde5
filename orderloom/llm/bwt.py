"""Burrows-Wheeler transforms of shards of byte strings, merged by refining an interleave.

A letter is a block of ``width`` bytes, ranked once for all strings of a task;
a suffix is read letter by letter, so its Burrows-Wheeler letter is the block of
``width`` bytes before it. A shard's transform lists its suffixes in order.

The merge never compares or sorts suffixes of different shards. It keeps an
interleave, the shard that each place of the merged order takes its next suffix
from, and starts with one shard after the other. A refinement deals the places
stably by the letter before their suffix: if the interleave was right by k
letters, it is then right by k + 1. Two neighbours whose places split at step k
have k - 1 letters in common; a run of neighbours that no step splits is an
interval of suffixes that share them all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LOW = np.uint64(0xFFFFFFFF)
#: Widest letter; wider ones take more passes to rank, narrower ones more refinements.
WIDEST = 40


def width_for(length: int) -> int:
    """The widest letter of which ``length`` bytes are a whole number."""
    return next(w for w in range(min(WIDEST, length), 0, -1) if length % w == 0)


def _dense(key: np.ndarray, bits: int) -> np.ndarray:
    """Rank of each value of ``bits`` bits among the distinct ones, from 0."""
    n, out = len(key), np.empty(len(key), np.uint64)
    room = np.uint64(n.bit_length())
    if bits + n.bit_length() <= 64:  # the place travels in the low bits, which sorts faster than places alone
        ranked = (key << room) | np.arange(n, dtype=np.uint64)
        ranked.sort()
        order = (ranked & ((np.uint64(1) << room) - np.uint64(1))).view(np.int64)
        ranked >>= room
    else:
        order = np.argsort(key)
        ranked = key[order]
    out[order] = np.cumsum(np.concatenate([[False], ranked[1:] != ranked[:-1]])[:n]).astype(np.uint64)
    return out


def letters(data: np.ndarray, width: int) -> np.ndarray:
    """Rank, from 1, of the letter that starts at each byte; those that reach past the end of ``data`` mean nothing."""
    padded = np.concatenate([data, np.zeros(width + 8, np.uint8)])
    n, have = len(data) + width, min(5, width)
    word = np.zeros(n, np.uint64)
    for i in range(have):
        word = (word << np.uint64(8)) | padded[i : i + n]
    rank, bits = _dense(word, 8 * have), n.bit_length()
    while have < width:
        step = min(have, width - have)  # the second half may overlap the first
        rank = _dense((rank[: len(rank) - step] << np.uint64(bits)) | rank[step:], 2 * bits)
        have += step
    return rank[: len(data)].astype(np.int32) + np.int32(1)


@dataclass
class Strings:
    """Byte strings laid end to end, with their letters. String k takes ``data[start[k]:end[k]]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    width: int

    def __post_init__(self):
        self.letter = letters(self.data, self.width)


@dataclass
class Shard:
    """A transform. Places 0 .. len(ends) stand for the ends of strings, the others for suffixes in order.

    ``before`` is the letter before each place (0: none), ``suffix`` the byte at which each suffix starts.
    """

    ends: int
    before: np.ndarray
    suffix: np.ndarray


def transform(strings: Strings, first: int, last: int, steps: int) -> Shard:
    """The transform of strings ``first`` to ``last``, in order by their first ``steps`` letters."""
    w, a, b = strings.width, int(strings.start[first]), int(strings.end[last - 1])
    where = np.repeat(np.arange(first, last), (strings.end - strings.start)[first:last])
    at = np.arange(a, b, dtype=np.int32)
    whole = at + w <= strings.end[where]  # a letter fits
    suffix, lacks = at[whole], at[whole & (at + 2 * w > strings.end[where])]
    has = np.zeros(b - a, bool)
    has[suffix[suffix - w >= strings.start[where[suffix - a]]] - a] = True

    def preceding(order: np.ndarray) -> np.ndarray:
        """The suffixes a letter longer: first those of one letter, then those before the ones given."""
        return np.concatenate([lacks, order[has[order - a]] - w])

    order = suffix
    for _ in range(steps):
        longer = preceding(order)
        key = (strings.letter[longer].astype(np.uint64) << np.uint64(32)) | np.arange(len(longer), dtype=np.uint64)
        key.sort()
        order = longer[(key & LOW).astype(np.int64)]
    before = np.where(has[order - a], strings.letter[np.maximum(order - w, 0)], 0)
    return Shard(len(lacks), np.concatenate([strings.letter[lacks], before]), order)


@dataclass
class Merged:
    """Suffixes in the order of all shards; ``common``: letters shared with the place before, ``steps`` at most."""

    suffix: np.ndarray
    common: np.ndarray


def merge(shards: list[Shard], steps: int) -> Merged:
    """Refine the interleave ``steps`` times, so that it is right by as many letters."""
    ends = [s.ends for s in shards]
    kind = np.uint8 if len(shards) <= 256 else np.uint32
    sources = np.arange(len(shards), dtype=kind)
    at_end = np.repeat(sources, ends)
    interleave = np.repeat(sources, [len(s.suffix) for s in shards])
    before = np.concatenate([s.before for s in shards]) if shards else np.empty(0, np.int32)
    n_ends, block = len(at_end), np.zeros(len(interleave), np.int32)  # by no letters, ends and suffixes are alike
    common = np.zeros(len(interleave), np.int64)
    for step in range(1, steps + 1):
        taken = np.concatenate([at_end, interleave])
        letter = np.empty(len(taken), np.int32)
        letter[np.argsort(taken, kind="stable")] = before  # each shard gives its places in its own order
        places = np.flatnonzero(letter)
        key = (letter[places].astype(np.uint64) << np.uint64(32)) | places.astype(np.uint64)
        key.sort()
        places, letter = (key & LOW).astype(np.int64), key >> np.uint64(32)
        interleave = taken[places]
        blocks = np.concatenate([np.zeros(n_ends, np.int32), block])[places]
        same = (letter[1:] == letter[:-1]) & (blocks[1:] == blocks[:-1])
        common[1:][same] = step
        block = np.cumsum(np.concatenate([[True], ~same])[: len(places)], dtype=np.int32)
    suffix = np.empty(len(interleave), np.int64)
    suffix[np.argsort(interleave, kind="stable")] = np.concatenate([s.suffix for s in shards]) if shards else []
    return Merged(suffix, common)


def repeated(strings: Strings, copies: np.ndarray, length: int, shard_bytes: int) -> np.ndarray:
    """Of each byte whether the ``length`` bytes from it on, within its string, occur twice or more; a string counts ``copies`` times."""
    steps, found = length // strings.width, np.zeros(len(strings.data), bool)
    cuts = np.unique(np.searchsorted(strings.start, np.arange(0, len(strings.data) + shard_bytes, shard_bytes)))
    shards = [transform(strings, a, b, steps) for a, b in zip(cuts, cuts[1:])]
    merged = merge(shards, steps)
    if not len(merged.suffix):
        return found
    where = np.searchsorted(strings.start, merged.suffix, "right") - 1
    opens = np.flatnonzero(merged.common < steps)  # intervals of suffixes that share all letters
    total = np.add.reduceat(copies[where], opens)
    often = np.repeat(total > 1, np.diff(np.append(opens, len(merged.suffix))))
    found[merged.suffix[often & (merged.suffix + length <= strings.end[where])]] = True
    return found
