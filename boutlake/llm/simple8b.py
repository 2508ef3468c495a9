"""Simple-8b: runs of small numbers packed into 64-bit words.

The top four bits of a word select how many numbers it holds and how wide each is; the numbers follow from
the lowest bits up. Greedily, each word takes the selector with most numbers that fit. A number of more than
60 bits is an escape: its word holds nothing, and the number itself stands in full after the block's
words. Numbers are cut into blocks of ``BLOCK``; two tables say where each block's words and its full
numbers begin, so any block can be decoded alone and all blocks are decoded together, selector by selector.
"""

from __future__ import annotations

import numpy as np

#: Fixed values of the format: (numbers in a word, bits of each) of selectors 1 to 14. Selector 0 is the escape.
PACKED = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 0
BLOCK = 1024
_LIMITS = np.array([1 << bits for _, bits in PACKED], np.uint64)
_COUNTS = np.array([1, *(n for n, _ in PACKED), 0], np.int64)
_WIDE = BLOCK + PACKED[0][0]


def encode(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of numbers (unsigned), the first word of each block and the first full number of each; only the last block may be short."""
    rows = -(-len(numbers) // BLOCK)
    x = np.zeros(rows * BLOCK, np.uint64)
    x[: len(numbers)] = numbers
    wide = np.zeros((rows, _WIDE), np.uint64)  # zeros behind each block, for words that end beyond it
    wide[:, :BLOCK] = x.reshape(rows, BLOCK)
    level = np.zeros((rows, _WIDE), np.uint8)
    level[:, :BLOCK] = np.searchsorted(_LIMITS, x, "right").reshape(rows, BLOCK)
    choice = np.zeros(rows * _WIDE, np.uint8)
    widest, held = level.ravel(), 1  # over so many numbers from each on
    for s, (n, _) in reversed(list(enumerate(PACKED))):
        if n > held:
            widest, held = np.append(np.maximum(widest[: held - n], widest[n - held :]), widest[held - n :]), n
        np.copyto(choice, np.uint8(s + 1), where=widest <= s)
    choice = choice.reshape(rows, _WIDE)
    step = _COUNTS[choice]
    begins = np.zeros((rows, BLOCK), bool)
    row, at = np.arange(rows), np.zeros(rows, np.int64)
    ends = np.full(rows, BLOCK)
    if rows:
        ends[-1] = len(numbers) - (rows - 1) * BLOCK
    while len(row):
        begins[row, at] = True
        at = at + step[row, at]
        left = at < ends[row]
        row, at = row[left], at[left]
    block, col = np.nonzero(begins)
    chosen = choice[block, col]
    packed = np.zeros(len(block), np.uint64)
    flat = wide.ravel()
    for s, (n, bits) in enumerate(PACKED, 1):
        here = np.flatnonzero(chosen == s)
        if len(here):
            values = flat[(block[here] * _WIDE + col[here])[:, None] + np.arange(n)] << (np.arange(n, dtype=np.uint64) * np.uint64(bits))
            packed[here] = np.bitwise_or.reduce(values, axis=1) | np.uint64(s << 60)
    escaped = np.flatnonzero(chosen == ESCAPE)
    n_packed, n_full = np.bincount(block, minlength=rows), np.bincount(block[escaped], minlength=rows)
    first = np.cumsum(n_packed + n_full) - n_packed - n_full
    words = np.zeros(len(block) + len(escaped), np.uint64)
    ahead = np.cumsum(n_full) - n_full  # full numbers of earlier blocks
    words[np.arange(len(block)) + ahead[block]] = packed
    words[(first + n_packed - ahead)[block[escaped]] + np.arange(len(escaped))] = flat[block[escaped] * _WIDE + col[escaped]]
    return words, first, first + n_packed


def decode(words: np.ndarray, first: np.ndarray, full: np.ndarray, n: int) -> np.ndarray:
    """The n numbers (uint64) of consecutive blocks; first and full count from the start of words."""
    rows = len(first)
    lengths = np.diff(np.append(first, len(words)))
    block = np.repeat(np.arange(rows), lengths)
    is_full = np.arange(len(words)) >= full[block]
    packed, block = words[~is_full], block[~is_full]
    chosen = (packed >> np.uint64(60)).astype(np.int64)
    if (_COUNTS[chosen] == 0).any():
        raise ValueError("a word has a selector that the format does not use")
    before = np.cumsum(_COUNTS[chosen]) - _COUNTS[chosen]
    starts = np.zeros(rows, np.int64)
    starts[block[::-1]] = before[::-1]  # the first word of each block is written last
    at = block * _WIDE + before - starts[block]
    out = np.zeros(rows * _WIDE, np.uint64)
    for s, (n_held, bits) in enumerate(PACKED, 1):
        here = np.flatnonzero(chosen == s)
        if len(here):
            values = packed[here][:, None] >> (np.arange(n_held, dtype=np.uint64) * np.uint64(bits))
            out[at[here][:, None] + np.arange(n_held)] = values & np.uint64((1 << bits) - 1)
    out[at[chosen == ESCAPE]] = words[is_full]
    return out.reshape(rows, _WIDE)[:, :BLOCK].ravel()[:n]
