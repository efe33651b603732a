"""Maximal repeats of a text from its enhanced suffix array, by a scan of the common-prefix interval tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def suffix_array(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` codes at least, and the common prefix with the one before.

    Prefix doubling: ranks by 1, 2, 4, ... codes. The common prefix of neighbours is found by
    descending through the same ranks; it is exact up to twice the depth.
    """
    n = len(codes)
    ranks = [np.unique(codes, return_inverse=True)[1].astype(np.int64)]
    span = 1
    while span < depth:
        last = ranks[-1]
        after = np.zeros(n, np.int64)
        after[: max(0, n - span)] = last[span:] + 1
        ranks.append(np.unique(last * (n + 1) + after, return_inverse=True)[1].astype(np.int64))
        span *= 2
    order = np.argsort(ranks[-1], kind="stable")
    left, right = order[:-1], order[1:]
    common = np.zeros(max(0, n - 1), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        rank = np.concatenate((ranks[k], np.zeros(2 * span + 2, np.int64)))
        i, j = left + common, right + common
        # past the end nothing agrees; i and j differ, so two ends never meet
        common += np.where((i < n) & (j < n) & (rank[i] == rank[j]), 1 << k, 0)
    return order, np.concatenate((np.zeros(min(n, 1), np.int64), common))


def maximal_repeats(codes: np.ndarray, least: int, most: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(length, all start positions) of every repeat of ``least`` codes or more that no code extends on either side.

    A stack holds the open intervals of the suffix array, each with its common prefix and the
    code left of its members, or -1 once these differ (or a member has none). An interval that
    closes is right-maximal; it is a maximal repeat if its left codes differ. Separators must
    be codes that occur once. ``most`` bounds the length of a repeat where it is known; the
    suffixes are ordered that far.
    """
    if len(codes) < 2:
        return
    order, common = suffix_array(codes, most or len(codes))
    before = np.where(order > 0, codes[order - 1], -1)
    deep = np.flatnonzero(common >= least)
    if not len(deep):
        return
    # runs of neighbours that share ``least`` codes; nothing reaches beyond a run
    cuts = np.flatnonzero(np.diff(deep) > 1) + 1
    for run in np.split(deep, cuts):
        first, last = int(run[0]) - 1, int(run[-1])
        lefts = before[first : last + 1].tolist()
        depths = [*common[first + 1 : last + 1].tolist(), 0]
        stack: list[list[int]] = []  # common prefix, first member, left code
        for k, depth in enumerate(depths):
            start, left = k, lefts[k]
            while stack and stack[-1][0] > depth:
                length, start, code = stack.pop()
                left = code if code == left else -1
                if left == -1:
                    yield length, order[first + start : first + k + 1]
            if not depth:
                continue
            if stack and stack[-1][0] == depth:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == left else -1
            else:
                stack.append([depth, start, left])
