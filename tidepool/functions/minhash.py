"""Word shingles of a text and their MinHash bands.

A shingle (``words`` space tokens of the normalised text; a shorter text is one shingle) is known
by the first 60 bits of its MD5. Permutation i maps it to ``(a_i x + b_i) mod P``; the least value over the
text's shingles is the signature's i-th entry, and ``rows`` entries in a row make a band key. Two texts agree
in an entry with a probability equal to the Jaccard similarity of their shingle sets. The constants
a_i, b_i follow from MD5 as well, so any engine can derive the same signature.

Texts leave the Arrow batch one at a time, and sketches are given back by ``HELD_IDS`` shingle ids: a worker holds
the batch (which Spark bounds in bytes), one text's shingles and these.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b, md5

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Ship this module's code inside the pickled UDF so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRIME = (1 << 31) - 1
#: Shingles permuted at a time: bounds the (permutations x shingles) matrix of a very long text.
STEP = 1 << 12
#: Shingle ids of sketches that are given back together.
HELD_IDS = 1 << 17


def _md5_60(text: str) -> int:
    return int(md5(text.encode("utf-8")).hexdigest()[:15], 16)


def permutations(n: int) -> tuple[list[int], list[int]]:
    """Multipliers 1..P-1 and offsets 0..P-1 of n permutations."""
    return ([1 + _md5_60(f"multiply:{i}") % (PRIME - 1) for i in range(n)],
            [_md5_60(f"add:{i}") % PRIME for i in range(n)])


def each_shingle(norm: str, words: int) -> Iterator[str]:
    """The shingles in order, repeats included."""
    tokens = [t for t in norm.split(" ") if t]
    if not tokens:
        return iter(())
    return (" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1)))


def shingles(norm: str, words: int) -> set[str]:
    return set(each_shingle(norm, words))


def signature(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least permuted value per permutation of the shingle ids (at least one)."""
    x = (ids % PRIME).astype(np.int64)
    least = np.full(len(a), PRIME, dtype=np.int64)
    for at in range(0, len(x), STEP):
        np.minimum(least, ((a[:, None] * x[None, at:at + STEP] + b[:, None]) % PRIME).min(axis=1), out=least)
    return least


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values)))


def _structs(names: list[str], ids: list[np.ndarray], keys: list[np.ndarray]) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(names, pa.string()), _lists(ids), _lists(keys)], ["set_id", "ids", "bands"])


@lru_cache(maxsize=None)
def _udf(words: int, bands: int, rows: int):
    @F.arrow_udf("set_id string, ids array<bigint>, bands array<bigint>")
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        a, b = (np.array(p, dtype=np.int64) for p in permutations(bands * rows))
        names, ids, keys, held = [], [], [], 0
        for norms in batches:
            for norm in norms:
                found = np.unique(np.fromiter(map(_md5_60, each_shingle(norm.as_py(), words)), dtype=np.int64))
                key = np.empty(0, dtype=np.int64)
                if len(found):
                    cut = signature(found, a, b).reshape(bands, rows)
                    key = np.array([int.from_bytes(blake2b(band.tobytes(), digest_size=8).digest(), "big", signed=True)
                                    for band in cut], dtype=np.int64)
                names.append(md5(found.tobytes()).hexdigest())
                ids.append(found)
                keys.append(key)
                held += len(found) + len(key) + 1
                if held > HELD_IDS:
                    yield _structs(names, ids, keys)
                    names, ids, keys, held = [], [], [], 0
            if names:
                yield _structs(names, ids, keys)
                names, ids, keys, held = [], [], [], 0
    return sketch


def sketch_col(norm: Column, words: int, bands: int, rows: int) -> Column:
    """Struct of ``set_id`` (MD5 of the sorted shingle ids), ``ids`` (sorted) and ``bands`` (keys; none
    for a text without words)."""
    return _udf(words, bands, rows)(norm)
