"""Rank-synchronous byte-pair merging of many short sequences at once.

Sequences are ragged rows of one flat numpy array. In every round each
unfinished sequence applies its own lowest-ranked pair, all sequences at
the same time. Where no pair that a merge can create ranks as low as the
merge itself, all its (non-overlapping, leftmost first) occurrences in the
sequence are applied in the round; otherwise only the leftmost. Both give
what repeated "merge the best, leftmost pair" gives.
"""

from __future__ import annotations

import numpy as np

NONE = np.int32(2**31 - 1)


class MergeTable:
    """Pairs of symbols -> (rank, merged symbol), as a cascade of hash
    tables: every key sits in the first level where its slot was free."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        self.levels, todo = [], np.arange(len(key))
        factor = 0x9E3779B97F4A7C15
        while len(todo):
            bits = max(8, int(2 * len(todo) - 1).bit_length())
            slot = (key[todo] * np.uint64(factor)) >> np.uint64(64 - bits)
            _, at = np.unique(slot, return_index=True)
            keys = np.full(1 << bits, 2**64 - 1, np.uint64)
            ranks, out = np.full(1 << bits, NONE, np.int32), np.full(1 << bits, -1, np.int32)
            keys[slot[at]], ranks[slot[at]], out[slot[at]] = key[todo[at]], rank[todo[at]], merged[todo[at]]
            self.levels.append((factor, bits, keys, ranks, out))
            todo = np.delete(todo, at)
            factor = (factor * 0xBF58476D1CE4E5B9 + 2) % 2**64 | 1
        # a rank is safe if no pair that holds a merged symbol of it ranks as low or lower
        lowest = np.full(int(max(merged.max(initial=0), left.max(initial=0), right.max(initial=0))) + 1, NONE, np.int32)
        np.minimum.at(lowest, left, rank)
        np.minimum.at(lowest, right, rank)
        self.safe = np.ones(int(rank.max(initial=0)) + 1, bool)
        self.safe[rank[lowest[merged] <= rank]] = False

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        rank, out = np.full(len(key), NONE, np.int32), np.full(len(key), -1, np.int32)
        for factor, bits, keys, ranks, merged in self.levels:
            slot = (key * np.uint64(factor)) >> np.uint64(64 - bits)
            hit = np.flatnonzero(keys[slot] == key)
            rank[hit], out[hit] = ranks[slot[hit]], merged[slot[hit]]
        return rank, out


def merge_all(table: MergeTable, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge every sequence to its end.

    ``symbols``: int32, all sequences one after another; symbols that are in
    no pair may be any number. Returns (surviving symbols, their original
    positions, survivors per sequence); order is kept."""
    n_seq = len(lengths)
    left_over = np.zeros(n_seq, np.int64)
    seq = np.flatnonzero(lengths > 0)
    lens = lengths[seq].astype(np.int64)
    sym, pos = symbols.astype(np.int32), np.arange(len(symbols), dtype=np.int64)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if not len(seq):
        return sym, pos, left_over
    rank, made = np.full(len(sym), NONE, np.int32), np.full(len(sym), -1, np.int32)
    if len(sym) > 1:
        rank[:-1], made[:-1] = table.lookup(sym[:-1], sym[1:])
    ends = np.cumsum(lens)
    rank[ends - 1] = NONE
    while True:
        ends = np.cumsum(lens)
        starts = ends - lens
        best = np.minimum.reduceat(rank, starts)
        over = best == NONE
        if over.any():
            at = np.repeat(over, lens)
            done.append((np.repeat(seq[over], lens[over]), sym[at], pos[at]))
            left_over[seq[over]] = lens[over]
            go = ~at
            sym, pos, rank, made = sym[go], pos[go], rank[go], made[go]
            seq, lens, best = seq[~over], lens[~over], best[~over]
            if not len(seq):
                break
        row = np.repeat(np.arange(len(seq)), lens)
        hits = np.flatnonzero(rank == best[row])
        fresh = np.ones(len(hits), bool)
        fresh[1:] = np.diff(hits) != 1
        run = np.flatnonzero(fresh)
        odd = (hits - np.repeat(hits[run], np.diff(np.append(run, len(hits))))) & 1
        of = row[hits]
        lead = np.ones(len(hits), bool)
        lead[1:] = of[1:] != of[:-1]
        use = (odd == 0) & (table.safe[best[of]] | lead)
        hits, of = hits[use], of[use]
        sym[hits] = made[hits]
        rank[hits] = rank[hits + 1]  # NONE if the right part ended its sequence
        keep = np.ones(len(sym), bool)
        keep[hits + 1] = False
        new = hits - np.arange(len(hits))
        sym, pos, rank, made = sym[keep], pos[keep], rank[keep], made[keep]
        lens = lens - np.bincount(of, minlength=len(lens))
        ends = np.cumsum(lens)
        is_last = np.zeros(len(sym), bool)
        is_last[ends - 1] = True
        again = np.unique(np.concatenate([new, new[new > 0] - 1]))
        again = again[~is_last[again]]
        rank[again], made[again] = table.lookup(sym[again], sym[again + 1])
        rank[new[is_last[new]]] = NONE
    who = np.concatenate([d[0] for d in done])
    order = np.argsort(who, kind="stable")
    return (np.concatenate([d[1] for d in done])[order], np.concatenate([d[2] for d in done])[order], left_over)


def pairs_of(tokens: dict, parts, rank) -> MergeTable:
    """The merge table of a vocabulary in which any two neighbours whose
    concatenation is a token merge. ``tokens``: text -> symbol; ``rank``:
    text -> rank; ``parts``: the texts that merges may make."""
    rows = []
    for t in parts:
        for cut in range(1, len(t)):
            a, b = tokens.get(t[:cut]), tokens.get(t[cut:])
            if a is not None and b is not None:
                rows.append((a, b, rank[t], tokens[t]))
    cols = np.array(rows, np.int64).reshape(-1, 4).T
    return MergeTable(*(c.astype(np.int32) for c in cols))
