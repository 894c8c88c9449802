"""Column-wise construction of the Burrows-Wheeler transform of many strings.

All strings grow by one symbol at a time, from their ends: round j inserts the
suffixes of j symbols.  The transform is a file with one segment for each
symbol: the places, in the order of all suffixes so far, before which the
symbol stands.  The rank of a place in that file is where the longer suffix
goes; a round reads the file once from front to back, ``BLOCK`` entries at a
time, moves the places behind the new suffixes, merges the symbols before
these, and writes it again.  Between rounds only the newest suffix of each
string is in memory.

A symbol is a run of ``q`` bytes, so that rounds are few; each string then
takes part ``q`` times, once for each distance of its runs from its end.
Common prefixes of neighbours are extended symbol by symbol.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np


#: Entries of the transform in memory during a round.
BLOCK = 1 << 16
#: Bytes of each of its two files up to which it stays in memory: buckets of the usual size write nothing to disk.
HELD = 32 << 20


class _File:
    """The transform between rounds: sorted entries, read and written in order, on disk from ``HELD`` bytes on."""

    def __init__(self, files: ExitStack, folder: str | None, low: np.uint64, strings: int):
        self.old, self.out = (files.enter_context(tempfile.SpooledTemporaryFile(HELD, dir=folder)) for _ in range(2))
        self.low, self.strings, self.count = low, strings, 0

    def blocks(self) -> Iterator[np.ndarray]:
        self.old.seek(0)
        for at in range(0, self.count, BLOCK):
            yield np.frombuffer(self.old.read(8 * min(BLOCK, self.count - at)), dtype=np.uint64)

    def merge(self, entry: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Move the places behind the ``new`` suffixes and insert the sorted entries; returns their ranks."""
        places = self.strings + self.count - len(new)
        behind = np.diff(np.concatenate([[0], new - np.arange(len(new)), [places]]))
        shift = np.repeat(np.arange(len(new) + 1, dtype=np.uint32), behind)  # of every place
        rank, done, read = np.empty(len(entry), dtype=np.int64), 0, 0
        self.out.seek(0)  # a round writes no less than the one before: nothing of that is left
        for block in self.blocks():
            block = block + shift[(block & self.low).view(np.int64)]
            upto = int(np.searchsorted(entry, block[-1]))
            at = np.searchsorted(block, entry[done:upto])
            rank[done:upto] = read + at + np.arange(done, upto)
            self.out.write(np.insert(block, at, entry[done:upto]).data)
            done, read = upto, read + len(block)
        rank[done:] = read + np.arange(done, len(entry))
        self.out.write(entry[done:].data)
        self.old, self.out, self.count = self.out, self.old, self.count + len(entry)
        return rank


def symbols(data: np.ndarray, q: int) -> np.ndarray:
    """The ``q`` bytes from every place on as one number, most significant first."""
    total = np.zeros(max(0, len(data) - q + 1), dtype=np.uint64)
    for i in range(q):
        total = (total << np.uint64(8)) | data[i : len(data) - q + 1 + i]
    return total


def sorted_suffixes(symbol: np.ndarray, end: np.ndarray, size: np.ndarray, q: int = 1, folder: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """String and length, in symbols, of every suffix in sorted order.

    String i ends at byte ``end[i]`` and has ``size[i]`` symbols of ``q``
    bytes.  Equal suffixes follow each other in the order of their strings;
    empty suffixes are included.
    """
    count, total = len(end), len(end) + int(size.sum())
    bits = np.uint64(max(1, total.bit_length()))
    if 8 * q + int(bits) > 64:
        raise ValueError(f"{total} suffixes do not fit beside symbols of {q} bytes")
    low = (np.uint64(1) << bits) - np.uint64(1)

    def before(strings: np.ndarray, length: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted entries for the symbols before suffixes of that length at those places, and their strings."""
        more = size[strings] > length
        strings = strings[more]
        entry = (symbol[end[strings] - (length + 1) * q] << bits) | place[more].astype(np.uint64)
        order = np.argsort(entry)
        return entry[order], strings[order]

    with ExitStack() as files:
        file, strings, length = _File(files, folder, low, count), np.arange(count), 0
        place, new = np.arange(count), np.zeros(0, dtype=np.int64)  # empty suffixes keep the order of their strings
        while len(strings):
            entry, strings = before(strings, length, place)
            place = new = count + file.merge(entry, new)
            length += 1

        # Walk every string once from its end to name the suffixes.
        longer, rank = np.zeros(total, dtype=np.int64), count
        for block in file.blocks():
            longer[(block & low).astype(np.int64)] = np.arange(rank, rank + len(block))
            rank += len(block)
    of, symbols_in = np.empty(total, dtype=np.int64), np.empty(total, dtype=np.int64)
    at, strings, length = np.arange(count), np.arange(count), 0
    while len(strings):
        of[at], symbols_in[at] = strings, length
        more = size[strings] > length
        strings, at = strings[more], longer[at[more]]
        length += 1
    return of, symbols_in


def common_prefixes(symbol: np.ndarray, first: np.ndarray, second: np.ndarray, most: int, q: int = 1) -> np.ndarray:
    """Symbols that the texts from ``first`` and from ``second`` on have in common, counted up to ``most``."""
    out = np.zeros(len(first), dtype=np.int64)
    same = np.arange(len(first))
    for i in range(most):
        same = same[symbol[first[same] + i * q] == symbol[second[same] + i * q]]
        out[same] = i + 1
    return out


def later_copies(data: np.ndarray, offsets: np.ndarray, width: int, folder: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """String and start of every ``width``-byte run that also occurs in an earlier string, or earlier in its own."""
    size = np.diff(offsets)
    suffixes = int(size.sum()) + 6 * len(size)
    q = max(q for q in range(1, 7) if width % q == 0 and (q == 1 or 8 * q + suffixes.bit_length() <= 64))
    symbol = symbols(data, q)
    # One string for each distance of its runs from the end; those shorter than a run are of no use.
    string = np.repeat(np.arange(len(size)), q)
    end = offsets[1:][string] - np.tile(np.arange(q), len(size))
    count = np.maximum(end - offsets[:-1][string], 0) // q
    use = count * q >= width
    string, end, count = string[use], end[use], count[use]
    of, length = sorted_suffixes(symbol, end, count, q, folder)
    long = length * q >= width
    start, of = end[of[long]] - length[long] * q, string[of[long]]
    prefix = common_prefixes(symbol, start[:-1], start[1:], width // q, q)
    group = np.concatenate([[0], np.cumsum(prefix * q < width)]) if len(start) else start
    order = np.lexsort((start, group))
    later = np.zeros(len(order), dtype=bool)
    later[1:] = group[order][1:] == group[order][:-1]
    picked = order[later]
    return of[picked], start[picked] - offsets[of[picked]]
