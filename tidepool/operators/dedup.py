"""Exact, Bloom and near-duplicate flags in arrival order, as group-by + join.

Every input row carries a unique orderable ``seq``. The sequential semantics (walk the rows in
``seq`` order, test then insert) have closed forms that need no ordering inside a group:

* exact (error-free): a row is a duplicate iff an earlier row has the same message id;
* Bloom: bit b was first set by min(seq) over all rows hashing to b; a row is flagged iff all its
  bits were set by earlier rows (false positives reproduced exactly);
* near: per band key, the earliest row's message id F is the only id the bucket ever holds, so
  a row is flagged iff its id differs from F.

Firsts are computed with ``groupBy(key).agg(min...)`` (map-side partial aggregation, so a key holding
a third of all rows costs one partial row per task) and joined back; AQE splits skewed join
partitions. No window is partitioned by a message key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool import config
from tidepool.functions import hashing, text, vectors
from tidepool.plans.joins import BROADCAST_MAX_ROWS, materialize, sized_lookup

BAND_COLS = tuple(f"k{j}" for j in range(config.LSH_ROWS))


def with_message_keys(df: DataFrame, message: str = "message") -> DataFrame:
    """Add ``norm`` (normalised text) and ``msg_id`` (md5 of it); never NULL."""
    norm = text.normalize(F.coalesce(F.col(message), F.lit("")))
    return df.withColumn("norm", norm).withColumn("msg_id", hashing.message_id(F.col("norm")))


def key_rows(df: DataFrame, size: int | None = None, num_hashes: int = config.BLOOM_HASHES,
             rows: int | None = None, message: str = "message", seq: str = "seq") -> DataFrame:
    """The narrow row every flag needs, written once: ``seq``, ``msg_id``, and on demand the Bloom
    bits (``size`` given) and band counts (``rows`` given). The text is read, normalised and
    hashed a single time and no text column is stored."""
    keyed = with_message_keys(df, message)
    cols = [seq, "msg_id"]
    if size is not None:
        keyed = with_bloom_bits(keyed, size, num_hashes)
        cols += [f"b{i}" for i in range(num_hashes)]
    if rows is not None:
        keyed = with_band(keyed, rows)
        cols += [f"k{j}" for j in range(rows)]
    return materialize(keyed.select(*cols))


# ---------------------------------------------------------------- exact (error-free variant)

def _merge_prior(prior: DataFrame, firsts: DataFrame, keys: list[str]) -> DataFrame:
    """Firsts over prior state and this input. Prior state is earlier than every row here, so a
    prior entry wins its key; only prior entries for this input's keys are read into the merge."""
    known = prior.join(firsts.select(*keys), keys, "left_semi")
    return known.unionByName(firsts.join(known.select(*keys), keys, "left_anti"))


def message_firsts(df: DataFrame, key: str = "msg_id", seq: str = "seq") -> DataFrame:
    """(msg_id, first_seq): earliest arrival of every message id."""
    return df.groupBy(key).agg(F.min(seq).alias("first_seq"))


def repeated_firsts(df: DataFrame, key: str = "msg_id", seq: str = "seq") -> DataFrame:
    """(msg_id, first_seq) of the ids that occur more than once: only those can be duplicates."""
    return df.groupBy(key).agg(F.min(seq).alias("first_seq"), F.count(F.lit(1)).alias("_n")) \
        .where(F.col("_n") > 1).drop("_n")


def exact_flags(df: DataFrame, key: str = "msg_id", seq: str = "seq",
                out: str = "is_exact_duplicate", prior: DataFrame | None = None) -> DataFrame:
    """Error-free exact flag: an earlier row (or ``prior`` state) has the same message id.

    The lookup holds repeated ids and, of ``prior``, this input's ids; all others are unflagged."""
    firsts = repeated_firsts(df, key, seq)
    if prior is not None:
        known = prior.select(key, "first_seq").join(df.select(key), key, "left_semi")
        firsts = known.unionByName(firsts.join(known.select(key), key, "left_anti"))
    firsts = sized_lookup(firsts.withColumnRenamed("first_seq", "_first_seq"))
    return (df.join(firsts, key, "left")
            .withColumn(out, F.coalesce(F.col(seq) > F.col("_first_seq"), F.lit(False)))
            .drop("_first_seq"))


# ---------------------------------------------------------------- Bloom filter

def with_bloom_bits(df: DataFrame, size: int = config.BLOOM_SIZE,
                    num_hashes: int = config.BLOOM_HASHES, norm: str = "norm") -> DataFrame:
    bits = hashing.seeded_bits(F.col(norm), size, num_hashes)
    return df.withColumns({f"b{i}": c for i, c in enumerate(bits)})


def bloom_fill(df_with_bits: DataFrame, num_hashes: int = config.BLOOM_HASHES,
               seq: str = "seq") -> DataFrame:
    """(bit_idx, first_seq): the row that first set each bit. At most ``size`` rows."""
    bits = F.explode(F.array(*[F.col(f"b{i}") for i in range(num_hashes)])).alias("bit_idx")
    return (df_with_bits.select(bits, F.col(seq).alias("s"))
            .groupBy("bit_idx").agg(F.min("s").alias("first_seq")))


def _maybe_broadcast(df: DataFrame, size: int) -> DataFrame:
    # The bit table has at most `size` rows: broadcast only under a fixed bound.
    return F.broadcast(df) if size <= config.BLOOM_BROADCAST_MAX_BITS else df


def bloom_flags(df: DataFrame, size: int = config.BLOOM_SIZE,
                num_hashes: int = config.BLOOM_HASHES, seq: str = "seq",
                out: str = "is_duplicate", prior_fill: DataFrame | None = None) -> DataFrame:
    """Flag rows whose every bit was set by an earlier row (or by ``prior_fill`` state)."""
    withbits = df if "b0" in df.columns else with_bloom_bits(df, size, num_hashes)
    fill = bloom_fill(withbits, num_hashes, seq)
    if prior_fill is not None:
        fill = (prior_fill.select("bit_idx", "first_seq").unionByName(fill)
                .groupBy("bit_idx").agg(F.min("first_seq").alias("first_seq")))
    # Materialised once: the k probes below read the small checkpoint, not the input again.
    fill = _maybe_broadcast(materialize(fill), size)
    return _probe_bits(withbits, fill, num_hashes, seq, out)


def _probe_bits(withbits: DataFrame, fill: DataFrame, num_hashes: int, seq: str,
                out: str) -> DataFrame:
    out_df = withbits
    for i in range(num_hashes):
        probe = fill.select(F.col("bit_idx").alias(f"b{i}"), F.col("first_seq").alias(f"_f{i}"))
        out_df = out_df.join(probe, f"b{i}", "left")
    latest = F.greatest(*[F.col(f"_f{i}") for i in range(num_hashes)]) if num_hashes > 1 \
        else F.col("_f0")
    return (out_df.withColumn(out, F.coalesce(latest < F.col(seq), F.lit(False)))
            .drop(*[f"_f{i}" for i in range(num_hashes)], *[f"b{i}" for i in range(num_hashes)]))


# ---------------------------------------------------------------- token buckets and band key

def with_token_vector(df: DataFrame, dim: int = config.LSH_DIM, norm: str = "norm",
                      out: str = "vector") -> DataFrame:
    """Full dim-long token-bucket count vector (array<int>)."""
    return df.withColumn(out, vectors.bucket_vector(F.col(norm), dim))


def with_band(df: DataFrame, rows: int = config.LSH_ROWS, dim: int | None = None,
              norm: str = "norm") -> DataFrame:
    """Add k0..k{rows-1}: the first ``rows`` token-bucket counts (the band slice), never NULL."""
    dim = dim or rows * 3
    staged = with_token_vector(df, dim, norm, "_vec")
    return staged.withColumns({
        f"k{j}": F.coalesce(F.col("_vec").getItem(j), F.lit(0)).cast("bigint")
        for j in range(rows)}).drop("_vec")


def band_key_col(rows: int = config.LSH_ROWS, band_id: int = config.LSH_BAND_ID) -> Column:
    return hashing.band_key([F.col(f"k{j}") for j in range(rows)], band_id)


def _with_id_pieces(df: DataFrame) -> DataFrame:
    pieces = hashing.hex32_pieces(F.col("msg_id"))
    return df.withColumns({f"_p{i}": p for i, p in enumerate(pieces)})


def _first_id_aggs(seq: str) -> list[Column]:
    """min(seq) and the message id of that row, as fixed-width (hash-aggregatable) buffers."""
    return [F.min(seq).alias("first_seq")] + [
        F.min_by(F.col(f"_p{i}"), F.col(seq)).alias(f"_id{i}") for i in range(3)]


def _first_id_col() -> Column:
    return hashing.hex32_from_pieces([F.col(f"_id{i}") for i in range(3)]).alias("first_msg_id")


def band_firsts(df_with_band: DataFrame, keys: Sequence[str] = BAND_COLS,
                seq: str = "seq") -> DataFrame:
    """Per band key: earliest seq and its message id."""
    agg = _with_id_pieces(df_with_band).groupBy(*keys).agg(*_first_id_aggs(seq))
    return agg.select(*keys, "first_seq", _first_id_col())


def near_flags(df: DataFrame, rows: int = config.LSH_ROWS, seq: str = "seq",
               out: str = "is_near_duplicate", prior: DataFrame | None = None,
               firsts: DataFrame | None = None) -> DataFrame:
    """Flag rows whose band bucket already holds a different message id."""
    keys = [f"k{j}" for j in range(rows)]
    banded = df if "k0" in df.columns else with_band(df, rows)
    firsts = band_firsts(banded, keys, seq) if firsts is None else firsts
    if prior is not None:
        firsts = _merge_prior(prior.select(*keys, "first_seq", "first_msg_id"), firsts, keys)
    lookup = sized_lookup(firsts.select(*keys, "first_msg_id"))
    joined = banded.join(lookup, keys, "inner")
    return (joined.withColumn(out, F.col("msg_id") != F.col("first_msg_id"))
            .drop("first_msg_id", *keys))


def near_flags_with_state(df: DataFrame, rows: int = config.LSH_ROWS, seq: str = "seq",
                          prior: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Near flags of rows with band columns, and the band rows first seen here."""
    keys = [f"k{j}" for j in range(rows)]
    firsts = materialize(band_firsts(df, keys, seq))
    new = firsts if prior is None else firsts.join(prior.select(*keys), keys, "left_anti")
    return near_flags(df, rows, seq, prior=prior, firsts=firsts), new


def lsh_candidates(df: DataFrame, rows: int = config.LSH_ROWS, seq: str = "seq") -> DataFrame:
    """Distinct candidate ids each row sees in its bucket at lookup time ([] if none)."""
    keys = [f"k{j}" for j in range(rows)]
    banded = df if "k0" in df.columns else with_band(df, rows)
    firsts = sized_lookup(band_firsts(banded, keys, seq))
    j = banded.join(firsts, keys, "inner")
    cand = F.when(F.col(seq) > F.col("first_seq"), F.array(F.col("first_msg_id"))) \
        .otherwise(F.array().cast("array<string>"))
    return j.select(F.col(seq), "msg_id", band_key_col(rows).alias("band_key"),
                    cand.alias("candidates"))


def first_seen(keyed: DataFrame, num_hashes: int, rows: int, seq: str = "seq") -> DataFrame:
    """Bloom fill and band firsts in one pass over the rows.

    Each row explodes into its k bit entries plus one band entry; one aggregation returns
    (kind, bit_idx, k0..k{rows-1}, first_seq, first_msg_id) with kind 0 = bit, 1 = band.
    """
    keys = [f"k{j}" for j in range(rows)]
    null_keys = [F.lit(None).cast("bigint").alias(k) for k in keys]
    entries = [F.struct(F.lit(0).alias("kind"), F.col(f"b{i}").alias("bit_idx"), *null_keys)
               for i in range(num_hashes)]
    entries.append(F.struct(F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("bit_idx"),
                            *[F.col(k) for k in keys]))
    ids = [f"_p{i}" for i in range(3)]
    ex = _with_id_pieces(keyed).select(F.col(seq).alias("_s"), *ids,
                                       F.explode(F.array(*entries)).alias("e"))
    agg = ex.select("_s", *ids, "e.*").groupBy("kind", "bit_idx", *keys) \
        .agg(*_first_id_aggs("_s"))
    return agg.select("kind", "bit_idx", *keys, "first_seq", _first_id_col())


def flag_messages(df: DataFrame, size: int = config.BLOOM_SIZE,
                  num_hashes: int = config.BLOOM_HASHES, rows: int = config.LSH_ROWS,
                  message: str = "message", seq: str = "seq") -> DataFrame:
    """The two flags (Bloom exact flag, band near flag): ``seq, msg_id, is_duplicate,
    is_near_duplicate`` per row of a frame with ``seq``.

    One pass over the text writes the narrow key rows; both lookup tables come from them in one
    aggregation, and the probes read them again (the bit table is bounded by ``size``; the band
    table is broadcast only if its measured row count is small).
    """
    keyed = key_rows(df, size, num_hashes, rows, message, seq)
    flagged, _, _ = flag_with_state(keyed, size, num_hashes, rows, seq)
    return flagged


def flag_with_state(keyed: DataFrame, size: int, num_hashes: int, rows: int, seq: str = "seq",
                    prior_bits: DataFrame | None = None, prior_bands: DataFrame | None = None):
    """Bloom + near flags of ``keyed`` (with bits and band columns) against optional prior state.

    Returns (flagged rows, bit rows first set here, band rows first seen here). Prior state is
    first restricted to the keys of this input (semi-join): what is shuffled and broadcast depends
    on the input alone, though the semi-join still scans the whole state.
    """
    keys = [f"k{j}" for j in range(rows)]
    firsts = materialize(first_seen(keyed, num_hashes, rows, seq))
    bits = firsts.filter(F.col("kind") == 0).select("bit_idx", "first_seq")
    bands = firsts.filter(F.col("kind") == 1).select(*keys, "first_seq", "first_msg_id")
    new_bits, new_bands = bits, bands
    if prior_bits is not None or prior_bands is not None:
        # Prior state is earlier than every row here, so a prior entry wins its key. Only prior
        # entries for this input's keys are needed (semi-join); the merged lookups are
        # materialised once so the probes below do not recompute the merge.
        merged = []
        if prior_bits is not None:
            prior = prior_bits.select("bit_idx", "first_seq")
            new_bits = bits.join(prior.select("bit_idx"), "bit_idx", "left_anti")
            merged.append(prior.join(bits.select("bit_idx"), "bit_idx", "left_semi")
                          .unionByName(new_bits).select(
                              F.lit(0).alias("kind"), "bit_idx",
                              *[F.lit(None).cast("bigint").alias(k) for k in keys],
                              "first_seq", F.lit(None).cast("string").alias("first_msg_id")))
        else:
            merged.append(firsts.filter(F.col("kind") == 0))
        if prior_bands is not None:
            prior = prior_bands.select(*keys, "first_seq", "first_msg_id")
            new_bands = bands.join(prior.select(*keys), keys, "left_anti")
            merged.append(prior.join(bands.select(*keys), keys, "left_semi")
                          .unionByName(new_bands).select(
                              F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("bit_idx"),
                              *keys, "first_seq", "first_msg_id"))
        else:
            merged.append(firsts.filter(F.col("kind") == 1))
        firsts = materialize(merged[0].unionByName(merged[1]))
        bits = firsts.filter(F.col("kind") == 0).select("bit_idx", "first_seq")
        bands = firsts.filter(F.col("kind") == 1).select(*keys, "first_seq", "first_msg_id")
    fill = _maybe_broadcast(bits, size)
    n_band = bands.count()
    lookup = bands.select(*keys, "first_msg_id")
    lookup = F.broadcast(lookup) if n_band <= BROADCAST_MAX_ROWS else lookup
    flagged = _probe_bits(keyed, fill, num_hashes, seq, "is_duplicate")
    joined = flagged.join(lookup, keys, "inner")
    out = (joined.withColumn("is_near_duplicate", F.col("msg_id") != F.col("first_msg_id"))
           .drop("first_msg_id", *keys))
    return out, new_bits, new_bands
