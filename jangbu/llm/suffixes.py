"""Suffix arrays of short pieces of text, in numpy, to find the strings of a given length that occur more than once."""

from __future__ import annotations

import numpy as np

from jangbu.llm.spans import U64

#: Bytes that the first sort looks at; with their number they fill a word.
_FIRST = 7
_HEADS = np.array([~((1 << 8 * (8 - k)) - 1) & (1 << 64) - 1 if k else 0 for k in range(_FIRST + 1)], U64)
#: Bits of a number that group, group behind and position may fill.
_PACKED = 63
#: Least words that need one byte, two bytes, and so on.
_BYTES = np.array([1 << 8 * k for k in range(8)], U64)


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, zeros behind the end."""
    own = np.concatenate([data, np.zeros(7, np.uint8)]).astype(U64)
    for done in (1, 2, 4):
        own = (own[:-done] << U64(8 * done)) | own[done:]
    return own


def suffix_order(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions sorted by what follows them in their piece, by Larsson-Sadakane refinement.

    Suffixes are grouped by their first seven bytes; then the groups of more than one member are sorted by the
    group of the suffix that stands as far behind as is known already, which doubles the sorted length, until all
    groups are single or the longest piece is passed. A shorter suffix comes before those it begins, equal ones stand by position.
    Group, group behind and position are sorted as one number where they fit in one, which they do up to two million bytes.
    """
    n, size = len(data), np.diff(ends)
    left = np.repeat(ends[1:], size) - np.arange(n)
    # The length decides between a piece that ends and one that goes on with zero bytes.
    short = np.minimum(left, _FIRST)
    key = (_words(data) & _HEADS[short]) | short.astype(U64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    group = np.empty(n, np.int64)
    group[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    bits = n.bit_length()
    done = _FIRST
    while done < size.max():
        open_ = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(open_):
            break
        who = order[open_]
        own = group[who]
        after = np.where(left[who] > done, group[np.minimum(who + done, n - 1)] + 1, 0)
        fresh = np.ones(len(open_), bool)
        if 3 * bits <= _PACKED:
            packed = np.sort((own << 2 * bits) | (after << bits) | who)
            who = packed & ((1 << bits) - 1)
            packed >>= bits
            fresh[1:] = packed[1:] != packed[:-1]
        else:
            place = np.lexsort((who, after, own))
            who, own, after = who[place], own[place], after[place]
            fresh[1:] = (own[1:] != own[:-1]) | (after[1:] != after[:-1])
        order[open_] = who
        new[open_] = fresh
        group[who] = open_[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        done *= 2
    return order


def common_prefixes(data: np.ndarray, ends: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each place of `order` the bytes shared with the suffix before it, up to `depth`, by Kasai's walk.

    Going from a position to the next one loses at most one byte of the prefix shared with the predecessor, so each walk
    goes on where the last stopped. All pieces are walked side by side, one position of each at a time, and compared by eight bytes.
    """
    n, starts, words = len(data), ends[:-1], _words(data)
    stop = np.repeat(ends[1:], np.diff(ends))
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    size = np.diff(ends)
    now = np.zeros(len(starts), np.int64)
    pieces = np.argsort(-size, kind="stable")
    n_open = np.searchsorted(-size[pieces], 0, "left")
    for t in range(int(size.max()) if len(size) else 0):
        while n_open and size[pieces[n_open - 1]] <= t:
            n_open -= 1
        live = pieces[:n_open]
        i = starts[live] + t
        j = before[i]
        length = np.where(j >= 0, np.maximum(now[live] - 1, 0), 0)
        most = np.where(j >= 0, np.minimum(np.minimum(stop[i] - i, stop[j] - j), depth), 0)
        length = np.minimum(length, most)
        on = np.flatnonzero(length < most)
        while len(on):
            reached = length[on]
            equal = 8 - np.searchsorted(_BYTES, words[i[on] + reached] ^ words[j[on] + reached], "right")
            length[on] = reached = np.minimum(reached + equal, most[on])
            on = on[(equal == 8) & (reached < most[on])]
        shared[i] = length
        now[live] = length
    return shared[order]


def repeated(data: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Whether the `size` bytes from each position, within its piece, also stand at another position."""
    out = np.zeros(len(data), bool)
    if len(data):
        order = suffix_order(data, ends)
        same = common_prefixes(data, ends, order, size) >= size
        out[order[same]] = True
        out[order[np.flatnonzero(same) - 1]] = True
    return out
