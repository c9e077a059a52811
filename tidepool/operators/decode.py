"""Wire decode: JSON object -> (user_id, message) with defaults; rejects keep a reason.

Rules (a row failing any rule never reaches dedup state):
  value NULL / not JSON / not an object      -> reject
  key "message" missing -> ''; string -> kept; null, number, bool, list, object -> reject
  key "user_id" missing -> 'unknown'; string -> kept; anything else -> reject
Parsing goes through VARIANT so missing keys, JSON nulls and non-string types stay distinct. The
parser stops after the first value, so a record must also parse as an array element and as a field
value: each check alone lets one kind of trailing text through, both together none. A record with
an escaped surrogate that has no partner cannot be encoded as text and is rejected too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MESSAGE = ""
DEFAULT_USER = "unknown"


def _field(v: Column, key: str) -> tuple[Column, Column]:
    """(schema of the field or NULL when missing, its string value)."""
    item = F.try_variant_get(v, f"$.{key}", "variant")
    return F.schema_of_variant(item), F.try_variant_get(v, f"$.{key}", "string")


#: An escaped surrogate half without the other half (an even number of backslashes before it).
LONE_SURROGATE = (
    r"(?<!\\)(?:\\\\)*\\u[dD](?:[89abAB][0-9a-fA-F]{2}(?!\\u[dD][c-fC-F][0-9a-fA-F]{2})"
    r"|(?<!\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD])[c-fC-F][0-9a-fA-F]{2})")


def _parses_whole(raw: Column) -> Column:
    as_element = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    as_field = F.try_parse_json(F.concat(F.lit('{"v":'), raw, F.lit("}")))
    return as_element.isNotNull() & as_field.isNotNull()


def with_decoded(wire: DataFrame, value: str = "value") -> DataFrame:
    """Add ``message``, ``user_id`` and ``reject_reason`` (NULL for kept rows)."""
    raw = F.col(value).cast("string")
    staged = wire.withColumn("_v", F.try_parse_json(raw))
    v = F.col("_v")
    msg_t, msg_s = _field(v, "message")
    usr_t, usr_s = _field(v, "user_id")
    reason = (F.when(raw.isNull(), F.lit("null_value"))
              .when(v.isNull() | ~_parses_whole(raw), F.lit("bad_json"))
              .when(raw.contains("\\u") & raw.rlike(LONE_SURROGATE), F.lit("bad_text"))
              .when(~F.schema_of_variant(v).startswith("OBJECT"), F.lit("not_object"))
              .when(msg_t.isNotNull() & (msg_t != F.lit("STRING")), F.lit("message_type"))
              .when(usr_t.isNotNull() & (usr_t != F.lit("STRING")), F.lit("user_id_type")))
    return (staged
            .withColumn("reject_reason", reason)
            .withColumn("message", F.when(F.col("reject_reason").isNull(),
                                          F.coalesce(msg_s, F.lit(DEFAULT_MESSAGE))))
            .withColumn("user_id", F.when(F.col("reject_reason").isNull(),
                                          F.coalesce(usr_s, F.lit(DEFAULT_USER))))
            .drop("_v"))


def decode(wire: DataFrame, value: str = "value") -> DataFrame:
    """Valid rows only (the bad-record skip)."""
    return with_decoded(wire, value).filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejects(wire: DataFrame, value: str = "value") -> DataFrame:
    """Quarantine frame: rejected rows with their reason."""
    return with_decoded(wire, value).filter(F.col("reject_reason").isNotNull()) \
        .drop("message", "user_id")


def encode(df: DataFrame, cols: list[str], out: str = "value") -> DataFrame:
    """JSON object of the given columns (the publisher's wire form)."""
    return df.withColumn(out, F.to_json(F.struct(*[F.col(c) for c in cols])))


# Stored-table constraints: (table, column, NOT NULL, max length or None).
CONSTRAINTS = {
    "processed": [("original_text", True, None), ("hashed_user_id", True, 64),
                  ("predicted_label", False, 50)],
    "outbox": [("reply_text", True, None), ("reply_status", False, 50)],
    "metrics": [("metric_name", True, 100), ("metric_value", True, None), ("batch_id", False, 100)],
}


def constraint_violations(df: DataFrame, table: str, key: str = "id") -> DataFrame:
    """One row per (row, violated rule): NOT NULL and VARCHAR(n) length checks."""
    checks = []
    for col, not_null, max_len in CONSTRAINTS[table]:
        c = F.col(col)
        if not_null:
            checks.append(F.when(c.isNull(), F.lit(f"{col} is null")))
        if max_len is not None:
            checks.append(F.when(F.char_length(c.cast("string")) > F.lit(max_len),
                                 F.lit(f"{col} longer than {max_len}")))
    reasons = F.filter(F.array(*checks), lambda r: r.isNotNull())
    return (df.select(F.lit(table).alias("table_name"), F.col(key).alias("row_id"),
                      F.explode(reasons).alias("reason")))
