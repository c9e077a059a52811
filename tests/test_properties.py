"""Property tests: Spark column expressions equal their Python definitions on random text."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.seqmodel import bucket_vector, normalize
from tidepool.functions import hashing, text
from tidepool.operators import dedup

# Latin-1 letters and punctuation plus every whitespace character Python's split() knows.
WS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0         　"
ALPHABET = st.sampled_from(list("abcXYZéÉüÜçßñ'?!.,0123456789") + list(WS))
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=50, max_size=80)


@settings(max_examples=4, deadline=None)
@given(TEXTS)
def test_normalize_hash_and_vector_match_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    keyed = df.select("i", text.normalize(F.col("t")).alias("norm"))
    keyed = keyed.withColumn("mod", hashing.md5_mod(F.col("norm"), 1009))
    keyed = dedup.with_token_vector(keyed, dim=15)
    for r in keyed.collect():
        want = normalize(texts[r.i])
        assert r.norm == want
        assert r.mod == int(hashlib.md5(want.encode()).hexdigest(), 16) % 1009
        assert list(r.vector) == bucket_vector(want, 15)
