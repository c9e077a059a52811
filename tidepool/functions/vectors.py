"""Token-bucket count vector: per token int(md5(token)) mod dim, counted.

This is the one per-token step kept in Python: an Arrow UDF is ~10x faster than
the equivalent JVM lambda (md5 + four base-16 conversions per token are interpreted inside
higher-order functions). Input is the already normalised text; everything around it stays JVM-side.
Texts leave the Arrow batch one at a time and the memo of tokens is bounded, so a worker holds a batch (which
Spark bounds in bytes) and no more, however many distinct tokens it has.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Ship this module's code inside the pickled UDF so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Tokens whose bucket is remembered (they repeat heavily); the memo starts anew beyond.
MEMO_TOKENS = 100_000


def bucket_vector_py(norm: str | None, dim: int, cache: dict | None = None) -> list[int]:
    from hashlib import md5
    vec = [0] * dim
    if not norm:
        return vec
    cache = {} if cache is None else cache
    for tok in norm.split(" "):
        if not tok:
            continue
        b = cache.get(tok)
        if b is None:
            b = int.from_bytes(md5(tok.encode("utf-8")).digest(), "big") % dim
            if len(cache) >= MEMO_TOKENS:
                cache.clear()
            cache[tok] = b
        vec[b] += 1
    return vec


@lru_cache(maxsize=None)
def _udf(dim: int):
    @F.arrow_udf("array<int>")
    def bucket_vector(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache: dict[str, int] = {}
        for norms in batches:
            counts = np.empty((len(norms), dim), dtype=np.int32)
            for at, norm in enumerate(norms):
                counts[at] = bucket_vector_py(norm.as_py(), dim, cache)
            ends = np.arange(0, counts.size + 1, dim, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(counts.ravel()))
    return bucket_vector


def bucket_vector(norm: Column, dim: int) -> Column:
    return _udf(dim)(norm)
