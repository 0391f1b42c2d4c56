"""Key digests of all pairs of a book, reckoned on whole arrays in Arrow batches of loans.

A draw needs the digest of every pair, but only those below the highest bound matter.  Here no pair becomes a row before its digest is
known: a loan comes with its months, and leaves the pairs of two of its months whose digest is low.  What follows works on those few.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Executors get these functions themselves: they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 32_768  # digests reckoned together: their arrays stay in the cache of a core
START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
TURNS = (7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)
PLACES = (1, 0), (5, 1), (3, 5), (7, 0)
DATE = 10  # letters of a date
DAYS = np.datetime64("0001-01-01"), np.datetime64("9999-12-31")  # those written with so many


def _block(state: list[np.ndarray], words: list, steps: int = 64) -> list[np.ndarray]:
    """``steps`` steps of md5 on a block of 16 words, each an array or one number for all."""
    a, b, c, d = state
    t = np.empty_like(a)
    for i in range(steps):
        turn, (by, plus) = TURNS[i // 16][i % 4], PLACES[i // 16]
        if i < 16:
            np.bitwise_xor(c, d, out=t), np.bitwise_and(t, b, out=t), np.bitwise_xor(t, d, out=t)
        elif i < 32:
            np.bitwise_xor(b, c, out=t), np.bitwise_and(t, d, out=t), np.bitwise_xor(t, c, out=t)
        elif i < 48:
            np.bitwise_xor(b, c, out=t), np.bitwise_xor(t, d, out=t)
        else:
            np.invert(d, out=t), np.bitwise_or(t, b, out=t), np.bitwise_xor(t, c, out=t)
        np.add(a, t, out=a)
        word, constant = words[(by * i + plus) % 16], int(abs(math.sin(i + 1)) * 2 ** 32)
        if isinstance(word, int):
            constant += word
        else:
            np.add(a, word, out=a)
        np.add(a, np.uint32(constant & 0xFFFFFFFF), out=a)
        np.left_shift(a, np.uint32(turn), out=t), np.right_shift(a, np.uint32(32 - turn), out=a), np.bitwise_or(a, t, out=a)
        np.add(a, b, out=a)
        a, b, c, d = d, a, b, c
    return [a, b, c, d]


def first_digits(words: list, n: int) -> np.ndarray:
    """The first eight digits of ``n`` digests, as numbers, from the padded words of their texts."""
    state = [np.full(n, x, np.uint32) for x in START]
    for k in range(0, len(words) - 16, 16):
        state = [x + y for x, y in zip(state, _block([x.copy() for x in state], words[k:k + 16]))]
    # The first word of a digest is known three steps before the others.
    return (state[0] + _block([x.copy() for x in state], words[-16:], 61)[1]).byteswap()


def _texts(days: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The letters of dates, a row each, and which dates have another number of letters."""
    dates = days.astype("datetime64[D]")
    odd = (dates < DAYS[0]) | (dates > DAYS[1])
    return np.datetime_as_string(np.where(odd, DAYS[0], dates)).astype(f"S{DATE}").view(np.uint8).reshape(-1, DATE), odd


class Pairs:
    """Pairs of months of the loans of a batch; ``below`` finds those of low digest."""

    def __init__(self, names: pa.Array, months: pa.Array, seed: str, most: int):
        self.tail = b"|" + seed.encode()
        names = names.cast(pa.large_string())
        at = np.frombuffer(names.buffers()[1], np.int64, len(names) + 1, 8 * names.offset)
        self.letters, self.begin, self.length = np.frombuffer(names.buffers()[2] or b"", np.uint8), at[:-1], np.diff(at)
        sizes = months.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        self.loan = np.repeat(np.arange(len(names)), sizes)
        self.day, inverse = np.unique(months.flatten().cast(pa.int32()).to_numpy(zero_copy_only=False), return_inverse=True)
        self.which = inverse.ravel()  # day of an entry
        self.text, self.odd = _texts(self.day)
        month = self.day.astype("datetime64[D]").astype("datetime64[M]").astype(np.int64)[self.which]
        month -= month.min(initial=0)
        # Months of a loan are in order, and so are these over all loans.
        key = self.loan * (int(month.max(initial=0)) + most + 2) + month
        self.first, self.last = np.searchsorted(key, key), np.searchsorted(key, key + most, "right")

    def below(self, bound: int):
        """(as-of entries, target entries) of pairs whose first eight digits are below ``bound``, piece by piece."""
        lengths = self.length[self.loan]
        for length in np.unique(lengths):
            entries = np.flatnonzero(lengths == length)
            ends = np.cumsum((self.last - self.first)[entries])
            start = 0
            while start < len(entries):
                done = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
                yield self._below(entries[start:stop], int(length), bound)
                start = stop

    def _below(self, entries: np.ndarray, length: int, bound: int) -> tuple[np.ndarray, np.ndarray]:
        count = self.last[entries] - self.first[entries]
        total = int(count.sum())
        target = np.arange(total) + np.repeat(self.first[entries] - np.cumsum(count) + count, count)
        days = self.which[target]
        before = length + DATE + 2  # letters up to the target month
        size = before + DATE + len(self.tail)
        padded = (size + 8) // 64 * 64 + 64
        head = np.zeros((len(entries), -(-before // 4) * 4), np.uint8)
        head[:, :length] = self.letters[self.begin[self.loan[entries]][:, None] + np.arange(length)]
        head[:, [length, before - 1]] = ord("|")
        head[:, length + 1:before - 1] = self.text[self.which[entries]]
        middle = np.zeros((len(self.day), padded), np.uint8)
        middle[:, before:before + DATE] = self.text
        rest = b"\0" * (before + DATE) + self.tail + b"\x80"
        rest = np.frombuffer(rest.ljust(padded - 8, b"\0") + (8 * size).to_bytes(8, "little"), "<u4")
        head, middle = head.view("<u4"), middle.view("<u4")
        words = []
        for k, word in enumerate(map(int, rest)):
            if k < head.shape[1]:
                word = np.repeat(head[:, k] | np.uint32(word), count)
            if before // 4 <= k <= (before + DATE - 1) // 4:
                word = middle[:, k][days] | (np.uint32(word) if isinstance(word, int) else word)
            words.append(word)
        low = first_digits(words, total) < bound
        if self.odd.any():  # left to who looks at the digests of the few
            low |= self.odd[days] | np.repeat(self.odd[self.which[entries]], count)
        found = np.flatnonzero(low)
        return np.repeat(entries, count)[found], target[found]


def _task(bound: int, seed: str, most: int, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            numbers, names, months = (batch.column(k) for k in range(3))
            pairs = Pairs(names, months, seed, most)
            entries = months.flatten()
            for begin, target in pairs.below(bound):
                if len(begin):
                    yield pa.RecordBatch.from_arrays([numbers.take(pa.array(pairs.loan[begin])), entries.take(pa.array(begin)),
                                                      entries.take(pa.array(target))], schema=schema)
    return run


def low_pairs(book: DataFrame, bound: str, most: int, seed: int) -> DataFrame:
    """``loan_id, ao_dt, trg_dt`` of pairs of months, at most ``most`` apart, whose ``key_digest`` lies below ``bound``.

    ``book`` has a ``loan_id`` and the ``months`` of its history, in order.  Dates before the year 1 or after 9999 are all returned.
    """
    thin = book.select("loan_id", F.col("loan_id").cast("string").alias("_name"), "months")
    number, months = thin.schema["loan_id"].dataType, thin.schema["months"].dataType.elementType
    schema = T.StructType([T.StructField("loan_id", number), T.StructField("ao_dt", months), T.StructField("trg_dt", months)])
    eight = int(bound, 16) << 4 * (8 - len(bound))
    return thin.mapInArrow(_task(eight, str(seed), most, to_arrow_schema(schema)), schema)
