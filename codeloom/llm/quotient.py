"""A counting quotient filter over 64-bit fingerprints, held losslessly.

A fingerprint below ``2**bits`` is split into a quotient (its high bits) and a remainder. ``occupied`` has a bit per quotient,
``run_end`` a bit per slot: the remainders of one quotient stand together and sorted, runs follow one another in the order of
their quotients. A remainder that was counted more than once is followed by counter slots, marked in ``counter``, that hold its
count less one in base ``2**32``. As quotient and remainder give the fingerprint back, filters of any two quotient sizes hold
their fingerprints in the same order and merge by a merge of sorted sequences; nothing is lost or confused.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

_HEAD = "<BBQQ"
_DIGIT = np.uint64(32)


@dataclass
class QuotientFilter:
    bits: int
    quotient_bits: int
    occupied: np.ndarray
    run_end: np.ndarray
    counter: np.ndarray
    slots: np.ndarray

    @staticmethod
    def of_counts(prints: np.ndarray, counts: np.ndarray, bits: int) -> QuotientFilter:
        """From distinct sorted fingerprints and how often each was seen."""
        quotient_bits = min(bits, max(1, int(len(prints)).bit_length()))
        shift = bits - quotient_bits
        quotients = (prints >> np.uint64(shift)) if shift < 64 else np.zeros(len(prints), np.uint64)
        remainders = prints & np.uint64((1 << shift) - 1)
        extra = (counts - 1).astype(np.uint64)
        high = extra >> _DIGIT
        width = 1 + (extra > 0) + (high > 0)
        first = np.zeros(len(prints) + 1, np.int64)
        np.cumsum(width, out=first[1:])
        slots = np.zeros(first[-1], np.uint64)
        counter = np.ones(first[-1], bool)
        slots[first[:-1]], counter[first[:-1]] = remainders, False
        one, two = extra > 0, high > 0
        slots[first[:-1][one] + 1] = extra[one] & np.uint64(0xFFFFFFFF)
        slots[first[:-1][two] + 2] = high[two]
        run_end = np.zeros(first[-1], bool)
        if len(prints):
            last = np.flatnonzero(np.append(quotients[1:] != quotients[:-1], True))
            run_end[first[last + 1] - 1] = True
        occupied = np.zeros(1 << quotient_bits, bool)
        occupied[quotients.astype(np.int64)] = True
        return QuotientFilter(bits, quotient_bits, occupied, run_end, counter, slots)

    @staticmethod
    def of_prints(prints: np.ndarray, bits: int) -> QuotientFilter:
        distinct, counts = np.unique(prints, return_counts=True)
        return QuotientFilter.of_counts(distinct, counts, bits)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """All fingerprints in ascending order, and their counts."""
        starts = np.flatnonzero(~self.counter)
        run = np.zeros(len(self.slots) + 1, np.int64)
        np.cumsum(self.run_end, out=run[1:])
        quotients = np.flatnonzero(self.occupied)[run[:-1][starts]].astype(np.uint64)
        shift = self.bits - self.quotient_bits
        prints = (quotients << np.uint64(shift) if shift < 64 else np.zeros(len(starts), np.uint64)) | self.slots[starts]
        width = np.diff(np.append(starts, len(self.slots)))
        seen = np.ones(len(starts), np.int64)
        for digit in (1, 2):
            there = width > digit
            seen[there] += (self.slots[starts[there] + digit] << np.uint64(32 * (digit - 1))).astype(np.int64)
        return prints, seen

    @staticmethod
    def merged(filters: list[QuotientFilter], bits: int) -> QuotientFilter:
        """One filter with the sums of all counts: the sorted sequences are merged, equal fingerprints added up."""
        if not filters:
            return QuotientFilter.of_prints(np.zeros(0, np.uint64), bits)
        parts = [f.counts() for f in filters]
        prints, seen = np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])
        order = np.argsort(prints, kind="stable")
        prints, seen = prints[order], seen[order]
        first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1])) if len(prints) else np.zeros(0, np.int64)
        return QuotientFilter.of_counts(prints[first], np.add.reduceat(seen, first) if len(first) else seen, bits)

    def to_bytes(self) -> bytes:
        remainder_bytes = 8 if self.bits - self.quotient_bits > 32 else 4
        kind = np.uint64 if remainder_bytes == 8 else np.uint32
        head = struct.pack(_HEAD, self.bits, self.quotient_bits, len(self.slots), remainder_bytes)
        flags = b"".join(np.packbits(x).tobytes() for x in (self.occupied, self.run_end, self.counter))
        return head + flags + self.slots.astype(kind).tobytes()

    @staticmethod
    def from_bytes(data: bytes) -> QuotientFilter:
        bits, quotient_bits, n, remainder_bytes = struct.unpack_from(_HEAD, data)
        at, flags = struct.calcsize(_HEAD), []
        for size in (1 << quotient_bits, n, n):
            taken = (size + 7) // 8
            flags.append(np.unpackbits(np.frombuffer(data, np.uint8, taken, at), count=size).astype(bool))
            at += taken
        slots = np.frombuffer(data, np.uint64 if remainder_bytes == 8 else np.uint32, n, at).astype(np.uint64)
        return QuotientFilter(bits, quotient_bits, *flags, slots)
