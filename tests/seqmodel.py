"""Independent arrival-order model of the flags (test-only), from the stated rules.

State is (set of set bits, first holder of each band, set of seen texts); ``step`` takes a state
and one text to its flags, and ``sequential_flags`` folds it over the rows in arrival order.
"""

import re
from collections import Counter
from functools import partial, reduce
from hashlib import md5, sha256
from typing import NamedTuple


class State(NamedTuple):
    bits: frozenset = frozenset()
    holder: dict = {}
    texts: frozenset = frozenset()
    flags: dict = {}


def normalize(text):
    """Lower case, white-space runs as one space, none at the ends."""
    return re.sub(r"\s+", " ", text.lower()).strip()


def digest_number(text):
    return int.from_bytes(md5(text.encode()).digest(), "big")


def bucket_vector(norm, dim):
    per = Counter(digest_number(token) % dim for token in norm.split())
    return [per[j] for j in range(dim)]


def band_key(vec, rows, band_id=0):
    """SHA-256 over the band's counts as 64-bit little-endian integers."""
    raw = bytearray()
    for count in vec[:rows]:
        raw += count.to_bytes(8, "little", signed=True)
    return f"band_{band_id}_{sha256(raw).hexdigest()}"


def step(state, row, size, k, lsh_rows):
    seq, message = row
    norm = normalize(message)
    wanted = frozenset(digest_number(str(seed) + norm) % size for seed in range(k))
    name = md5(norm.encode()).hexdigest()
    band = tuple(bucket_vector(norm, 3 * lsh_rows)[:lsh_rows])
    # Only the first message of a band is ever entered in it, so the band has one holder.
    holder = {band: name, **state.holder}
    flags = (wanted <= state.bits, holder[band] != name, norm in state.texts)
    return State(state.bits | wanted, holder, state.texts | {norm}, {**state.flags, seq: flags})


def sequential_flags(rows, size=100000, k=3, lsh_rows=5):
    """rows: iterable of (seq, message) in any order -> {seq: (bloom_dup, near_dup, exact_dup)}."""
    return reduce(partial(step, size=size, k=k, lsh_rows=lsh_rows), sorted(rows), State()).flags
