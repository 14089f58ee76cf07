"""Spans of a block reduced to its different ones, so that costly work is done once for each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd


def intern(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each span the number of its kind; for each kind the index of its first span."""
    codes, kinds = pd.factorize(hashes)
    first = np.empty(len(kinds), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return codes, first


def pick(flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The ranges of flat that begin there, in a row."""
    ends = np.cumsum(length)
    return flat[np.repeat(begin - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)]


def spell(
    codes: np.ndarray, flat: np.ndarray, begin: np.ndarray, length: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The values of all spans in a row, and where each document's begin; a kind's value is a range of flat."""
    each = length[codes]
    return pick(flat, begin[codes], each), np.concatenate(([0], np.cumsum(each)))[first]


@dataclass
class _Generation:
    hash: np.ndarray  # sorted
    begin: np.ndarray
    length: np.ndarray
    flat: np.ndarray

    def add(self, hash_: np.ndarray, length: np.ndarray, flat: np.ndarray) -> _Generation:
        begin = len(self.flat) + np.cumsum(length) - length
        columns = zip((self.hash, self.begin, self.length), (hash_, begin, length))
        columns = [np.concatenate(c) for c in columns]
        order = np.argsort(columns[0])
        return _Generation(*(c[order] for c in columns), np.concatenate((self.flat, flat)))


class Kept:
    """The values (integers) of spans met lately by the spans' hashes, as arrays.

    They are two generations: when the younger has most spans, or MEAN times as many integers, it becomes the older.
    """

    MEAN = 16
    LONGEST = 4096

    def __init__(self, most: int, kind: str = "<u4") -> None:
        self.most = most
        self.none = _Generation(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind))
        self.young = self.old = self.none

    def values(
        self, hashes: np.ndarray, learn: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The values of different spans as ranges (begin, length) of an array.

        learn gets the indexes of those that are not known and gives their values in a row and the length of each.
        """
        begin, length = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        flats, base, absent = [], 0, []
        left = np.arange(len(hashes))
        for own in (self.young, self.old):
            if len(own.hash):
                at = np.minimum(np.searchsorted(own.hash, hashes[left]), len(own.hash) - 1)
                hit = own.hash[at] == hashes[left]
                begin[left[hit]], length[left[hit]] = base + own.begin[at[hit]], own.length[at[hit]]
                left = left[~hit]
            flats.append(own.flat)
            base += len(own.flat)
            absent.append(left)
        if len(left):
            flat, sizes = learn(left)
            begin[left], length[left] = base + np.cumsum(sizes) - sizes, sizes
            flats.append(flat)
        flat = np.concatenate(flats)
        new = absent[0][length[absent[0]] <= self.LONGEST]
        if len(new):
            self.young = self.young.add(hashes[new], length[new], pick(flat, begin[new], length[new]))
        if len(self.young.hash) >= self.most or len(self.young.flat) >= self.MEAN * self.most:
            self.young, self.old = self.none, self.young
        return flat, begin, length
