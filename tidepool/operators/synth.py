"""Labelled synthetic messages, one per driving row, every choice from a keyed hash.

For driving index i: label -> template -> delay/punctuation -> case variant -> optional word swap
(20 %), user ``user_%05d`` in 100..99999, time = 2024-01-01 08:00 + i * (1..5) minutes. Rows with
``i % 20 == 0`` that have an input row with the same index are copies of that input row, half of
them with the time moved 1..60 minutes later. Deterministic for any partitioning and any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool import config
from tidepool.functions import hashing

# Own wording: message templates and delays.
TEMPLATES = {
    "complaint": [
        "Half of my order was soaked through when the box opened{punct}",
        "The courier marked the order as delivered to a house that burned down {delay} ago{punct}",
        "Your app charged my card twice and then logged me out{punct}",
        "A screw is missing and the manual is for another lamp{punct}",
        "The new filter rattles all night long{punct}",
        "My loyalty points vanished {delay} before the holiday{punct}",
        "The order confirmation shows a stranger's name{punct}",
        "The zip tore on the very first walk{punct}",
    ],
    "praise": [
        "The repair kit saved our camping trip{punct}",
        "Your driver waited while I found my keys, a great touch{punct}",
        "My grandmother set the radio up without any help{punct}",
        "The replacement colour matches the sofa to the shade{punct}",
        "A great manual for once, with real drawings{punct}",
        "The chat agent solved in a minute what took me an evening{punct}",
        "Even the packaging could be reused as a shelf{punct}",
        "Such a great smell when the coffee tin opens{punct}",
    ],
    "inquiry": [
        "Does the tent fit on a train luggage rack{punct}",
        "Would a refund go to the gift card or to my bank{punct}",
        "Is the blue paint safe for a fish tank{punct}",
        "Which battery does the garden clock need{punct}",
        "Do I need the receipt for a refund at the kiosk{punct}",
        "May two people share one workshop ticket{punct}",
        "At what height should the bird box hang{punct}",
        "Does a partial refund change the invoice{punct}",
    ],
}
DELAYS = ["nine days", "a fortnight", "four nights", "eleven weeks", "a season", "two Sundays"]

# Fixed values (generator rules being reproduced): punctuation endings, the one-word swap per
# label with its alternatives and rate, the copy interval, the base time, user id range 100-99999.
PUNCT = [".", "!", "?", ""]
SWAPS = {"complaint": ("order", ["package", "shipment", "item"]),
         "praise": ("great", ["wonderful", "awesome", "fantastic"]),
         "inquiry": ("refund", ["return", "exchange"])}
SWAP_PERCENT = 20
INJECT_EVERY = 20
BASE_TIME = "2024-01-01 08:00:00"
TS_OUT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _h(idx: Column, tag: str, m: int, seed: int) -> Column:
    key = F.concat_ws("|", F.lit(str(seed)), idx.cast("string"), F.lit(tag))
    return hashing.md5_int60(key) % F.lit(m)


def _pick(options: list[str], i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (i + F.lit(1)).cast("int"))


def label_choices(inputs: DataFrame | None) -> list[str]:
    """Known labels that occur in the input rows (in label-code order), else all known labels.

    One aggregate of len(LABELS) booleans reaches the driver, whatever the input size.
    """
    if inputs is None or "label" not in inputs.columns:
        return list(config.LABELS)
    seen = inputs.agg(*[F.max(F.coalesce(F.col("label") == F.lit(lab), F.lit(False)))
                        .alias(lab) for lab in config.LABELS]).first()
    present = [lab for lab in config.LABELS if seen[lab]]
    return present or list(config.LABELS)


def synthesize(driver: DataFrame, idx: str, inputs: DataFrame | None = None,
               seed: int = config.SYNTH_SEED) -> DataFrame:
    """driver: one row per message to generate, ``idx`` unique non-negative long.

    inputs: optional (idx, user_id, message, timestamp, label) rows to copy at i % 20 == 0; its
    labels also choose the label domain (``label_choices``).
    """
    labels = label_choices(inputs)
    out = driver.select(F.col(idx).alias("idx"))
    i = F.col("idx")
    out = out.withColumn("label", _pick(labels, _h(i, "label", len(labels), seed)))
    tmpl = F.lit(None).cast("string")
    for name in labels:
        opts = TEMPLATES[name]
        tmpl = F.when(F.col("label") == name, _pick(opts, _h(i, "template", len(opts), seed))) \
            .otherwise(tmpl)
    msg = F.replace(F.replace(tmpl, F.lit("{delay}"), _pick(DELAYS, _h(i, "delay", len(DELAYS), seed))),
                    F.lit("{punct}"), _pick(PUNCT, _h(i, "punct", len(PUNCT), seed)))
    case = _h(i, "case", 4, seed)
    msg = (F.when(case == 0, F.initcap(msg)).when(case == 1, F.upper(msg))
           .when(case == 2, F.lower(msg)).otherwise(msg))
    out = out.withColumn("message", msg)
    swap_on = _h(i, "swap", 100, seed) < F.lit(SWAP_PERCENT)
    for name, (word, alts) in SWAPS.items():
        alt = _pick(alts, _h(i, "alt", len(alts), seed))
        out = out.withColumn("message", F.when((F.col("label") == name) & swap_on,
                                               F.replace(F.col("message"), F.lit(word), alt))
                             .otherwise(F.col("message")))
    user = F.concat(F.lit("user_"), F.lpad((F.lit(100) + _h(i, "user", 99900, seed)).cast("string"), 5, "0"))
    step = F.lit(1) + _h(i, "step", 5, seed)
    total = i * step  # minutes after the base time, as a long; added as days + minutes
    days = F.floor(total / F.lit(1440)).cast("int")
    ts = F.to_timestamp_ntz(F.lit(BASE_TIME)) + F.make_dt_interval(
        days=days, mins=(total - days.cast("bigint") * F.lit(1440)).cast("int"))
    out = out.withColumn("user_id", user).withColumn("timestamp", F.date_format(ts, TS_OUT))
    out = out.select("idx", "user_id", "message", "timestamp", "label")
    if inputs is None:
        return out
    copies = inputs.filter(F.col("idx") % INJECT_EVERY == 0)
    shift = F.when(_h(F.col("idx"), "shift", 2, seed) == 0,
                   F.lit(1) + _h(F.col("idx"), "minutes", 60, seed)).otherwise(F.lit(0))
    copies = copies.select(
        "idx", F.col("user_id").alias("c_user_id"), F.col("message").alias("c_message"),
        F.date_format(F.col("timestamp") + F.make_dt_interval(mins=shift.cast("int")), TS_OUT)
        .alias("c_timestamp"), F.col("label").alias("c_label"), F.lit(True).alias("c_hit"))
    joined = out.join(copies, "idx", "left")
    hit = F.coalesce(F.col("c_hit"), F.lit(False))
    return joined.select(
        "idx",
        *[F.when(hit, F.col(f"c_{c}")).otherwise(F.col(c)).alias(c)
          for c in ("user_id", "message", "timestamp", "label")])


def label_frequency(messages: DataFrame) -> DataFrame:
    return messages.groupBy("label").agg(F.count(F.lit(1)).alias("label_count"))
