"""Wire decode edge rows (keep / reject with reason)."""

from tidepool.operators import decode

ROWS = [
    ('{"message":"a","user_id":"u"}', ("u", "a", None)),
    ('{"user_id":"u"}', ("u", "", None)),
    ('{"message":null,"user_id":"u"}', (None, None, "message_type")),
    ('{"message":5,"user_id":"u"}', (None, None, "message_type")),
    ('{"message":true}', (None, None, "message_type")),
    ('{"message":["x"]}', (None, None, "message_type")),
    ('{"message":"a"}', ("unknown", "a", None)),
    ('{"message":"a","user_id":null}', (None, None, "user_id_type")),
    ('{"message":"a","user_id":7}', (None, None, "user_id_type")),
    ("[1,2]", (None, None, "not_object")),
    ('"s"', (None, None, "not_object")),
    ("bad{", (None, None, "bad_json")),
    (None, (None, None, "null_value")),
    ('{"message":"","user_id":"u"}', ("u", "", None)),
    ('{"message":"a"} x', (None, None, "bad_json")),
    ('{"message":"a"}{"message":"b"}', (None, None, "bad_json")),
    ('{"message":"a"},{"message":"b"}', (None, None, "bad_json")),
    ('{"message":"a"}}', (None, None, "bad_json")),
    ('{"message":"a"}]', (None, None, "bad_json")),
    (' {"message":"a"} ', ("unknown", "a", None)),
    ('{"message":"a","x":NaN}', (None, None, "bad_json")),  # a deliberate difference: strict JSON
    (r'{"message":"\ud83d"}', (None, None, "bad_text")),
    (r'{"message":"\ude00 low first"}', (None, None, "bad_text")),
    (r'{"message":"\ud83d\ud83d\ude00"}', (None, None, "bad_text")),
    (r'{"message":"\ud83d\ude00"}', ("unknown", "\U0001f600", None)),
    (r'{"message":"\\ud83d"}', ("unknown", r"\ud83d", None)),
    ('{"message":"it\'s ok?","user_id":"u","extra":1}', ("u", "it's ok?", None)),
]


def test_decode_rules(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(ROWS)], "i int, value string")
    out = {r.i: (r.user_id, r.message, r.reject_reason)
           for r in decode.with_decoded(df).collect()}
    for i, (_, want) in enumerate(ROWS):
        assert out[i] == want, ROWS[i]
    assert decode.decode(df).count() == sum(1 for _, w in ROWS if w[2] is None)
    assert decode.rejects(df).count() == sum(1 for _, w in ROWS if w[2] is not None)


def test_empty_batch(spark):
    df = spark.createDataFrame([], "value string")
    assert decode.decode(df).count() == 0
