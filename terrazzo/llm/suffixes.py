"""Suffix arrays of short windows of text, in numpy: Larsson-Sadakane refinement, Kasai's common prefixes, merging by binary search."""

from __future__ import annotations

import numpy as np

#: positions from which Kasai's walk starts side by side
LANE = 32
#: masks that keep the first 0 to 8 bytes of a word
_FIRST = np.array([(1 << 64) - (1 << (64 - 8 * i)) for i in range(9)], np.uint64)
_BYTES = np.array([1 << 8 * i for i in range(1, 8)], np.uint64)


def packed(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number, in the order of the bytes; zeros follow the end."""
    longer = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | longer[i : i + len(data)]
    return out


def suffix_array(words: np.ndarray, room: np.ndarray) -> np.ndarray:
    """All suffixes, sorted; a suffix ends with its window, and an end comes before any byte and differs from any other end.

    words: `packed` text of all windows. room: bytes from each place to the end of its window. Groups of equal ranks are
    refined by the ranks `known` places on, which doubles; suffixes whose rank is their own rest.
    """
    count = len(words)
    left = np.minimum(room, 8)
    words = words & _FIRST[left]
    short = np.flatnonzero(left < 8)
    # a stable sort then puts the shorter of equal words first
    order = np.concatenate([short[np.argsort(left[short], kind="stable")], np.flatnonzero(left == 8)])
    order = order[np.argsort(words[order], kind="stable")]
    new = np.ones(len(order), bool)
    new[1:] = (words[order[1:]] != words[order[:-1]]) | (left[order[1:]] != left[order[:-1]])
    rank = np.empty(count, np.int64)
    slots = np.arange(len(order))
    rank[order] = np.maximum.accumulate(np.where(new, slots, 0))
    alone = new & np.append(new[1:], True)
    active = np.flatnonzero(~alone)
    known = 8
    while len(active):
        places = order[active]
        beyond = places + known
        inside = room[places] > known
        following = np.where(inside, rank[np.where(inside, beyond, 0)] + count, places)
        if count <= 1 << 21:
            # rank, following rank and number in one word, which numpy sorts much faster than it finds an order
            key = (rank[places].astype(np.uint64) << np.uint64(43)) | (following.astype(np.uint64) << np.uint64(21))
            key = np.sort(key | np.arange(len(active), dtype=np.uint64))
            places, key = places[(key & np.uint64((1 << 21) - 1)).astype(np.int64)], key >> np.uint64(21)
        else:
            key = (rank[places] << 32) | following
            by_key = np.argsort(key, kind="stable")
            places, key = places[by_key], key[by_key]
        order[active] = places
        new = np.ones(len(active), bool)
        new[1:] = key[1:] != key[:-1]
        rank[places] = np.maximum.accumulate(np.where(new, active, 0))
        active = active[~(new & np.append(new[1:], True))]
        known *= 2
    return order


def common_prefixes(words: np.ndarray, room: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix of `order` with the one before it.

    Kasai's walk: a text place's common prefix is at least the previous place's less one, so only what is new is
    compared. Walks start at every `LANE`-th place and go side by side.
    """
    count = len(words)
    before = np.full(count, -1, np.int64)
    before[order[1:]] = order[:-1]
    found = np.zeros(count, np.int64)
    starts = np.arange(0, count, LANE)
    length = np.zeros(len(starts), np.int64)
    for d in range(LANE):
        places = starts + d
        if len(places) and places[-1] >= count:
            places, length, starts = places[:-1], length[:-1], starts[:-1]
        other = before[places]
        has = other >= 0
        most = np.where(has, np.minimum(room[places], room[other]), 0)
        length = np.minimum(np.maximum(length - 1, 0), most)
        going = np.flatnonzero(length < most)
        while len(going):
            a, b = places[going] + length[going], other[going] + length[going]
            differ = words[a] ^ words[b]
            equal = np.full(len(going), 8, np.int64)
            odd = np.flatnonzero(differ)
            # leading zero bytes of the difference
            equal[odd] = 7 - np.searchsorted(_BYTES, differ[odd], "right")
            length[going] += equal
            going = going[(equal == 8) & (length[going] < most[going])]
        length = np.minimum(length, most)
        found[places] = length
    return found[order]


def repeated_starts(texts: list[bytes], length: int) -> np.ndarray:
    """Whether the `length` bytes from each place of the joined texts on stand anywhere else in them. No match crosses texts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
    words = packed(data)
    order = suffix_array(words, room)
    shared = common_prefixes(words, room, order)
    out = np.zeros(len(data), bool)
    hit = np.flatnonzero(shared >= length)
    out[order[hit]] = True
    out[order[hit - 1]] = True
    return out


def in_other_runs(keys: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Whether each key also stands in another run: the sorted keys of every run are looked up in all others by binary search.

    `runs`: the run of each key. Keys may repeat within a run.
    """
    out = np.zeros(len(keys), bool)
    order = np.lexsort((keys, runs))
    keys_, runs_ = keys[order], runs[order]
    edges = np.flatnonzero(np.append(True, runs_[1:] != runs_[:-1]))
    parts = [np.unique(p) for p in np.split(keys_, edges[1:])]
    merged = np.sort(np.concatenate(parts)) if parts else keys_
    for begin, part in zip(edges.tolist(), parts, strict=True):
        # a key of this run alone stands once in the merged runs
        times = np.searchsorted(merged, part, "right") - np.searchsorted(merged, part, "left")
        own = keys_[begin : begin + int((runs_ == runs_[begin]).sum())]
        out[order[begin : begin + len(own)]] = times[np.searchsorted(part, own)] > 1
    return out
