"""Vectorised pair merging over ragged symbol arrays.

A batch of words is one flat symbol array plus word lengths. A round finds each
word's lowest-ranked adjacent pair with a segmented minimum, merges the leftmost
non-overlapping occurrences of that pair in every word at once, and drops the
words in which no pair is left. Two conditions make a round equal to merging one
pair at a time: a pair that may create a pair of equal or lower rank is marked
``single`` and only its leftmost occurrence is merged in a round.
"""

from __future__ import annotations

import ctypes
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NO_RANK = np.int32(2**31 - 1)
#: Words with more symbols than this take the one-at-a-time heap, whose cost does not grow with the square of the length.
LONG_WORD = 4096
_LIBC = ctypes.CDLL(None)


class PairTable:
    """(left symbol, right symbol) -> rank, merged symbol, single flag; open addressing over int64 keys."""

    def __init__(self, left, right, rank, new, single):
        left, right = np.asarray(left, np.int64), np.asarray(right, np.int64)
        self.rank, self.new, self.single = np.asarray(rank, np.int32), np.asarray(new, np.int32), np.asarray(single, bool)
        keys = (left << 32) | right
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots, self.where = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        todo, at = np.arange(len(keys), dtype=np.int32), self._home(keys)
        while len(todo):
            free = self.slots[at] == -1
            first = np.unique(at[free], return_index=True)[1]
            chosen = np.flatnonzero(free)[first]
            self.slots[at[chosen]], self.where[at[chosen]] = keys[todo[chosen]], todo[chosen]
            left_over = np.ones(len(todo), bool)
            left_over[chosen] = False
            todo, at = todo[left_over], (at[left_over] + 1) & self.mask

    def _home(self, keys):
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left, right):
        """Index of each pair in the table, -1 where there is none."""
        keys = (left.astype(np.int64) << 32) | right
        at = self._home(keys)
        got = self.slots[at]
        out = np.where(got == keys, self.where[at], np.int32(-1))
        open_ = np.flatnonzero((got != keys) & (got != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            got = self.slots[at[open_]]
            same = got == keys[open_]
            out[open_[same]] = self.where[at[open_[same]]]
            open_ = open_[~same & (got != -1)]
        return out


def _one_word(sym, table: PairTable) -> np.ndarray:
    """The same result for one long word, with a heap of (rank, position)."""
    sym, n = sym.tolist(), len(sym)
    before, after, alive = [*range(-1, n - 1)], [*range(1, n), -1], [True] * n
    found = table.find(np.array(sym[:-1]), np.array(sym[1:]))
    heap = [(int(table.rank[k]), i, sym[i], sym[i + 1], int(k)) for i, k in enumerate(found.tolist()) if k >= 0]
    heapq.heapify(heap)
    memo: dict = {}

    def push(i, j):
        pair = sym[i], sym[j]
        if pair not in memo:
            memo[pair] = int(table.find(np.array(pair[:1]), np.array(pair[1:]))[0])
        if memo[pair] >= 0:
            heapq.heappush(heap, (int(table.rank[memo[pair]]), i, *pair, memo[pair]))

    while heap:
        _, i, a, b, k = heapq.heappop(heap)
        j = after[i] if alive[i] else -1
        if j < 0 or sym[i] != a or sym[j] != b:
            continue
        sym[i], alive[j], after[i] = int(table.new[k]), False, after[j]
        if after[j] >= 0:
            before[after[j]] = i
            push(i, after[j])
        if before[i] >= 0:
            push(before[i], i)
    return np.array([s for s, ok in zip(sym, alive) if ok], np.int32)


def merge_words(sym: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """(flat symbols, lengths) of the words after all merges, in the same word order. Lengths are 1 at least."""
    sym, lengths = sym.astype(np.int32), lengths.astype(np.int64)
    n_words = len(lengths)
    if not n_words:
        return sym, lengths
    done_sym, done_word, out_len = [], [], lengths.copy()
    word = np.arange(n_words)
    if (big := lengths > LONG_WORD).any():
        ends = np.cumsum(lengths)
        for w in np.flatnonzero(big).tolist():
            got = _one_word(sym[ends[w] - lengths[w] : ends[w]], table)
            done_sym.append(got), done_word.append(np.array([w]))
            out_len[w] = len(got)
        keep = np.repeat(~big, lengths)
        sym, word, lengths = sym[keep], word[~big], lengths[~big]

    def looked_up(sym, ends):
        found = np.full(len(sym), -1, np.int32)
        if len(sym) > 1:
            found[:-1] = table.find(sym[:-1], sym[1:])
            found[ends - 1] = -1
        return found

    found = looked_up(sym, np.cumsum(lengths)) if len(word) else None
    while len(word):
        ends = np.cumsum(lengths)
        starts = ends - lengths
        rank = np.where(found >= 0, table.rank[found], NO_RANK)
        least = np.minimum.reduceat(rank, starts)
        live = least != NO_RANK
        if not live.all():
            keep = np.repeat(live, lengths)
            done_sym.append(sym[~keep]), done_word.append(word[~live])
            out_len[word[~live]] = lengths[~live]
            sym, found, rank, word, lengths, least = sym[keep], found[keep], rank[keep], word[live], lengths[live], least[live]
            if not len(word):
                break
            ends = np.cumsum(lengths)
            starts = ends - lengths
        of = np.repeat(np.arange(len(word)), lengths)
        hits = np.flatnonzero(rank == least[of])
        hit_word = of[hits]
        first = np.ones(len(hits), bool)
        first[1:] = hit_word[1:] != hit_word[:-1]
        # one at a time where the merged symbol may form a pair that comes first
        alone = table.single[found[hits[first]]][np.cumsum(first) - 1]
        # in a run of touching hits (a a a ...), every other one is merged
        run = np.ones(len(hits), bool)
        run[1:] = (hits[1:] != hits[:-1] + 1) | first[1:]
        begin = np.flatnonzero(run)
        parity = (np.arange(len(hits)) - begin[np.cumsum(run) - 1]) & 1
        at = hits[np.where(alone, first, parity == 0)]
        sym[at] = table.new[found[at]]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        stale = np.zeros(len(sym), bool)  # pairs that hold a merged symbol are looked up again
        stale[at] = True
        stale[np.maximum(at - 1, 0)] = True
        left = np.where(at > 0, at - 1, 0)
        gone = ~keep[left]  # the symbol before was merged away: its own left part is stale already
        stale[left[gone] - 1] = True
        lengths = lengths - np.bincount(of[at], minlength=len(word))
        sym, stale, found = sym[keep], stale[keep], found[keep]
        ends = np.cumsum(lengths)
        last = np.zeros(len(sym), bool)
        last[ends - 1] = True
        again = np.flatnonzero(stale & ~last)
        found[last] = -1
        found[again] = table.find(sym[again], sym[again + 1])
    flat, order = np.concatenate(done_sym), np.concatenate(done_word)
    if len(order) and (order[1:] < order[:-1]).any():
        got_len = out_len[order]
        begin = np.cumsum(got_len) - got_len
        back = np.argsort(order, kind="stable")
        flat = flat[ragged_index(begin[back], got_len[back])]
    return flat, out_len


def ragged_index(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i] + lengths[i] - 1 of all i, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(total)


#: Bytes of text that are cut into words at a time.
PART_BYTES = 4_000_000


def give_back() -> None:
    """Returns freed memory to the system: workers are used again, by tasks of other stages too."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def parts(texts: pa.Array, size: int = PART_BYTES):
    """Slices of a string array of about ``size`` bytes each, one text at least; nulls become empty texts."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(sizes, (sizes[begin - 1] if begin else 0) + size, "right")))
        yield begin, texts.slice(begin, end - begin)
        begin = end
    give_back()


def space_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, word index at each place, places of each text from offset to offset) of texts cut at single spaces."""
    cut = pc.split_pattern(texts, " ")
    words = cut.flatten().dictionary_encode()
    offsets = cut.offsets.to_numpy()
    return words.dictionary.to_pylist(), words.indices.to_numpy(zero_copy_only=False), offsets - offsets[0]
