"""Equivalent SQL (DuckDB dialect) for every registered query.

The SQL re-derives each role frame from the same parquet tables with the same rules, written
independently of the DataFrame code, so that a match checks the Spark plan end to end.
"""

from __future__ import annotations

from tidepool import config
from tidepool.functions.text import WHITESPACE_RUN, WORD_TOKEN
from tidepool.functions import minhash
from tidepool.operators import minhash as mh, replies, scalable_bloom as growing

TS = "'%Y-%m-%d %H:%M:%S'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def hex_mod(h: str, m: int) -> str:
    acc = "0"
    for i in range(4):
        chunk = f"('0x' || substr({h}, {8 * i + 1}, 8))::BIGINT"
        acc = f"((({acc}) * 4294967296 + {chunk}) % {m})"
    return acc


def md5_mod(x: str, m: int) -> str:
    return hex_mod(f"md5({x})", m)


def normalize(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), {q(WHITESPACE_RUN)}, ' ', 'g'))"


def tokens(norm: str) -> str:
    return f"list_filter(string_split({norm}, ' '), lambda t: t <> '')"


def bucket_count(norm: str, j: int, dim: int = config.LSH_DIM) -> str:
    return (f"CAST(len(list_filter(list_transform({tokens(norm)}, lambda t: {md5_mod('t', dim)}),"
            f" lambda b: b = {j})) AS BIGINT)")


def le_hex(c: str) -> str:
    return " || ".join(f"lpad(hex(({c} >> {8 * j}) & 255), 2, '0')" for j in range(8))


def band_key(cols: list[str]) -> str:
    packed = " || ".join(f"({le_hex(c)})" for c in cols)
    return f"('band_{config.LSH_BAND_ID}_' || sha256(unhex({packed})))"


def unit_interval(key: str, modulus: int = (1 << 31) - 1) -> str:
    return f"((CAST({md5_mod(key, modulus)} AS DOUBLE) + 0.5) / {float(modulus)})"


def reply_sql(label: str, conf: str) -> str:
    known = ", ".join(q(k) for k in replies.TEMPLATES)
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in replies.TEMPLATES.items())
    return (f"CASE WHEN coalesce({conf} > {config.REPLY_THRESHOLD} AND {label} IN ({known}), false)"
            f" THEN CASE {label} {whens} END ELSE {q(replies.FALLBACK)} END")


def label_case(quality: str, toxic: str) -> str:
    return (f"CASE WHEN {toxic} = 1 THEN 'complaint' WHEN {quality} = 0 THEN 'inquiry' "
            f"WHEN {quality} = 1 THEN 'praise' END")


BANDS = [f"k{j}" for j in range(config.LSH_ROWS)]

# Raw messages with normalised text, id, Bloom bits and band counts.
KEYED = f"""
raw AS (SELECT doc_id AS seq, source AS user_id, text AS message, n_chars FROM documents),
normed AS (SELECT *, {normalize('message')} AS norm FROM raw),
keyed AS (
  SELECT *, md5(norm) AS msg_id,
    {', '.join(f"{md5_mod(f"'{i}' || norm", config.BLOOM_SIZE)} AS b{i}" for i in range(config.BLOOM_HASHES))},
    {', '.join(f"{bucket_count('norm', j)} AS k{j}" for j in range(config.LSH_ROWS))}
  FROM normed)"""

FLAGS = KEYED + f""",
fill AS (
  SELECT bit_idx, min(seq) AS first_seq FROM (
    {' UNION ALL '.join(f'SELECT b{i} AS bit_idx, seq FROM keyed' for i in range(config.BLOOM_HASHES))}
  ) GROUP BY bit_idx),
bloom AS (
  SELECT k.seq, coalesce(greatest({', '.join(f'f{i}.first_seq' for i in range(config.BLOOM_HASHES))}) < k.seq, false)
    AS is_duplicate
  FROM keyed k {' '.join(f'JOIN fill f{i} ON f{i}.bit_idx = k.b{i}' for i in range(config.BLOOM_HASHES))}),
bands AS (
  SELECT {', '.join(BANDS)}, min(seq) AS first_seq, arg_min(msg_id, seq) AS first_msg_id
  FROM keyed GROUP BY {', '.join(BANDS)}),
near AS (
  SELECT k.seq, k.msg_id <> b.first_msg_id AS is_near_duplicate, b.first_seq, b.first_msg_id
  FROM keyed k JOIN bands b USING ({', '.join(BANDS)})),
exact AS (
  SELECT seq, seq > min(seq) OVER (PARTITION BY msg_id) AS is_exact_duplicate FROM keyed)"""

PROCESSED = FLAGS + f""",
lab AS (SELECT doc_id AS seq, {label_case('quality', 'toxic')} AS predicted_label FROM labels),
proc0 AS (
  SELECT k.seq AS id, k.message AS original_text, k.message AS cleaned_text,
    sha256(k.user_id) AS hashed_user_id, lab.predicted_label,
    CAST(k.n_chars % 101 AS DOUBLE) / 100.0 AS confidence,
    bl.is_duplicate, nr.is_near_duplicate,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(k.seq) AS created_at
  FROM keyed k JOIN bloom bl USING (seq) JOIN near nr USING (seq) LEFT JOIN lab USING (seq)),
processed AS (
  SELECT *, {reply_sql('predicted_label', 'confidence')} AS reply_text, created_at AS updated_at
  FROM proc0),
outbox AS (
  SELECT id, id AS processed_id, reply_text, 'pending' AS reply_status, created_at,
    CAST(NULL AS TIMESTAMP) AS sent_at FROM processed),
batch AS (
  SELECT id // 100 AS epoch, count(*) AS processed_count,
    count_if(is_duplicate) AS duplicate_count, count_if(is_near_duplicate) AS near_duplicate_count,
    count_if(confidence < {config.LOW_CONFIDENCE}) AS low_confidence_count,
    max(created_at) AS batch_created_at
  FROM processed GROUP BY 1),
metrics AS (
  SELECT CAST(epoch * 4 + pos + 1 AS BIGINT) AS id, metric_name, metric_value,
    CAST(epoch AS VARCHAR) AS batch_id, batch_created_at AS created_at FROM (
    SELECT epoch, batch_created_at, 0 AS pos, 'processed_count' AS metric_name, CAST(processed_count AS DOUBLE) AS metric_value FROM batch
    UNION ALL SELECT epoch, batch_created_at, 1, 'duplicate_count', CAST(duplicate_count AS DOUBLE) FROM batch
    UNION ALL SELECT epoch, batch_created_at, 2, 'near_duplicate_count', CAST(near_duplicate_count AS DOUBLE) FROM batch
    UNION ALL SELECT epoch, batch_created_at, 3, 'low_confidence_count', CAST(low_confidence_count AS DOUBLE) FROM batch))"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


NEWEST = "ORDER BY created_at DESC, id DESC LIMIT 20"

HIST_BOUNDS = ["0.005", "0.01", "0.025", "0.05", "0.075", "0.1", "0.25", "0.5", "0.75", "1.0",
               "2.5", "5.0", "7.5", "10.0"]


def _histogram() -> str:
    parts = [f"SELECT 'bucket' AS series, '{b}' AS le, CAST(count_if(value / 100.0 <= {b}) AS DOUBLE) AS value FROM events"
             for b in HIST_BOUNDS]
    parts.append("SELECT 'bucket', '+Inf', CAST(count(value) AS DOUBLE) FROM events")
    parts.append("SELECT 'sum', '', round(coalesce(sum(value / 100.0), 0.0), 6) FROM events")
    parts.append("SELECT 'count', '', CAST(count(value) AS DOUBLE) FROM events")
    return "\nUNION ALL ".join(parts)


def base_sql() -> dict[str, str]:
    fl, pr = FLAGS, PROCESSED
    return {
        "normalize_text": with_(KEYED, "SELECT seq, norm FROM keyed"),
        "hash_users": "SELECT doc_id AS seq, source AS user_id, sha256(source) AS hashed_user_id FROM documents",
        "message_ids": with_(KEYED, "SELECT seq, msg_id FROM keyed"),
        "exact_duplicates": with_(fl, "SELECT k.seq, k.msg_id, e.is_exact_duplicate FROM keyed k JOIN exact e USING (seq)"),
        "bloom_bits": with_(KEYED, f"SELECT seq, {', '.join(f'b{i}' for i in range(config.BLOOM_HASHES))} FROM keyed"),
        "bloom_fill": with_(fl, "SELECT bit_idx, first_seq FROM fill"),
        "bloom_duplicates": with_(fl, "SELECT seq, is_duplicate FROM bloom"),
        "token_buckets": with_(KEYED, "SELECT seq, array_to_string(list_transform(range(0, "
                               f"{config.LSH_DIM}), lambda j: CAST(len(list_filter(list_transform({tokens('norm')}, "
                               f"lambda t: {md5_mod('t', config.LSH_DIM)}), lambda b: b = j)) AS VARCHAR)), ',') AS vector FROM keyed"),
        "band_keys": with_(KEYED, f"SELECT seq, {band_key(BANDS)} AS band_key FROM keyed"),
        "near_duplicates": with_(fl, "SELECT k.seq, k.msg_id, n.is_near_duplicate FROM keyed k JOIN near n USING (seq)"),
        "lsh_candidates": with_(fl, f"SELECT k.seq, k.msg_id, {band_key(['k.' + b for b in BANDS])} AS band_key, "
                                "CASE WHEN k.seq > n.first_seq THEN n.first_msg_id ELSE '' END AS candidates "
                                "FROM keyed k JOIN near n USING (seq)"),
        "label_summary": with_(pr, "SELECT predicted_label, count(*) AS total_count FROM processed GROUP BY 1"),
        "duplicate_summary": with_(pr, "SELECT CAST(sum(CASE WHEN is_duplicate THEN 1 ELSE 0 END) AS BIGINT) AS exact_duplicates, "
                                   "CAST(sum(CASE WHEN is_near_duplicate THEN 1 ELSE 0 END) AS BIGINT) AS near_duplicates, "
                                   "count(*) AS total_rows FROM processed"),
        "recent_processed": with_(pr, "SELECT id, original_text, predicted_label, confidence, is_duplicate, is_near_duplicate, "
                                  f"reply_text, strftime(created_at, {TS}) AS created_at FROM (SELECT * FROM processed {NEWEST})"),
        "recent_outbox": with_(pr, "SELECT id, processed_id, reply_text, reply_status, "
                               f"strftime(created_at, {TS}) AS created_at FROM (SELECT * FROM outbox {NEWEST})"),
        "recent_metrics": with_(pr, "SELECT id, metric_name, metric_value, batch_id, "
                                f"strftime(created_at, {TS}) AS created_at FROM (SELECT * FROM metrics {NEWEST})"),
        "complaint_spike": with_(pr, "SELECT CAST(count_if(predicted_label = 'complaint') AS BIGINT) AS complaint_count_last_20 "
                                 f"FROM (SELECT * FROM processed {NEWEST})"),
        "spike_alert": with_(pr, "SELECT c AS complaint_count_last_20, CASE WHEN c >= "
                             f"{config.SPIKE_THRESHOLD} THEN 'ALERT' ELSE 'OK' END AS status FROM ("
                             f"SELECT CAST(count_if(predicted_label = 'complaint') AS BIGINT) AS c FROM (SELECT * FROM processed {NEWEST}))"),
        "recent_status": with_(pr, "SELECT id, hashed_user_id, predicted_label AS label, CASE WHEN is_duplicate "
                               "THEN 'duplicate' ELSE 'normal' END AS status FROM (SELECT * FROM processed ORDER BY id DESC LIMIT 10)"),
        "processed_sample": with_(pr, "SELECT id, hashed_user_id, predicted_label, round(confidence, 3) AS confidence, "
                                  "is_duplicate, is_near_duplicate FROM processed ORDER BY id LIMIT 10"),
        "complaint_total": with_(pr, "SELECT CAST(count_if(lower(coalesce(predicted_label, '')) = 'complaint') AS BIGINT) AS complaint_count FROM processed"),
        "complaint_status": with_(pr, "SELECT c AS complaint_count, CASE WHEN c >= "
                                  f"{config.DASHBOARD_ALERT} THEN 'ALERT TRIGGERED' ELSE 'NORMAL' END AS complaint_status FROM ("
                                  "SELECT CAST(count_if(lower(coalesce(predicted_label, '')) = 'complaint') AS BIGINT) AS c FROM processed)"),
        "label_distribution": with_(pr, "SELECT upper(substr(l, 1, 1)) || lower(substr(l, 2)) AS label, count(*) AS label_count "
                                    "FROM (SELECT coalesce(predicted_label, 'unknown') AS l FROM processed) GROUP BY 1"),
        "label_zero_fill": with_(pr, "SELECT upper(substr(l, 1, 1)) || lower(substr(l, 2)) AS label, count(*) AS label_count "
                                 "FROM (SELECT coalesce(predicted_label, 'unknown') AS l FROM processed) GROUP BY 1 "
                                 "UNION ALL SELECT label, CAST(0 AS BIGINT) FROM (VALUES ('Inquiry'), ('Complaint'), ('Praise')) v(label) "
                                 "WHERE NOT EXISTS (SELECT 1 FROM processed)"),
        "duplicate_breakdown": with_(pr, "SELECT 'Duplicate' AS kind, CAST(count_if(is_duplicate) AS BIGINT) AS row_count FROM processed "
                                     "UNION ALL SELECT 'Non-Duplicate', CAST(count(*) - count_if(is_duplicate) AS BIGINT) FROM processed"),
        "top_category": with_(pr, "SELECT coalesce((SELECT label FROM (SELECT upper(substr(l, 1, 1)) || lower(substr(l, 2)) AS label, "
                              "count(*) AS n FROM (SELECT coalesce(predicted_label, 'unknown') AS l FROM processed) GROUP BY 1) "
                              "ORDER BY n DESC, label LIMIT 1), 'N/A') AS top_category"),
        "kpi_counts": with_(pr, "SELECT p AS processed_messages, r AS replies_queued, CASE WHEN m > 0 THEN m ELSE p + r END AS metrics_logged "
                            "FROM (SELECT (SELECT count(*) FROM processed) AS p, (SELECT count(*) FROM outbox) AS r, "
                            "(SELECT count(*) FROM metrics) AS m)"),
        "outbox_orphans": with_(pr, "SELECT o.id, o.processed_id FROM outbox o WHERE o.processed_id NOT IN "
                                "(SELECT id FROM processed WHERE NOT is_duplicate)"),
        "outbox_cascade": with_(pr, "SELECT o.id, o.processed_id, o.reply_status FROM outbox o WHERE o.processed_id IN "
                                "(SELECT id FROM processed WHERE NOT is_duplicate)"),
        "reply_route": with_(pr, "SELECT id, predicted_label, confidence, CASE WHEN coalesce(confidence > "
                             f"{config.REPLY_THRESHOLD} AND predicted_label IN ('complaint', 'praise', 'inquiry'), false) "
                             "THEN 'template' ELSE 'fallback' END AS route, reply_text, "
                             f"coalesce(confidence < {config.LOW_CONFIDENCE}, false) AS is_low_confidence FROM processed"),
        "reply_outbox": with_(pr, f"SELECT id, processed_id, reply_text, reply_status, strftime(created_at, {TS}) AS created_at, "
                              "CAST(sent_at AS VARCHAR) AS sent_at FROM outbox"),
        "batch_metrics": with_(pr, f"SELECT id, metric_name, metric_value, batch_id, strftime(created_at, {TS}) AS created_at FROM metrics"),
        "metric_rollup": with_(pr, "SELECT metric_name, count(*) AS metric_count, round(avg(metric_value), 3) AS avg_value "
                               "FROM metrics GROUP BY 1"),
        "metric_avg": with_(pr, "SELECT metric_name, round(avg(metric_value), 6) AS avg_value FROM metrics GROUP BY 1"),
        "event_counter": "SELECT event_type, count(*) AS events_processed_total FROM events GROUP BY 1",
        "duration_histogram": _histogram(),
        "latest_gauge": "SELECT event_type AS gauge, arg_max(value, (ts, event_id)) AS gauge_value FROM events GROUP BY 1",
    }


WIRE = """
wire AS (
  SELECT 'documents' AS origin, doc_id AS src_id, CAST(0 AS BIGINT) AS part,
    CAST(to_json({'user_id': source, 'message': text}) AS VARCHAR) AS value FROM documents
  UNION ALL SELECT 'conversations', conv_id, turn,
    CAST(to_json({'conv_id': conv_id, 'turn': turn, 'role': role, 'message': text}) AS VARCHAR) FROM conversations
  UNION ALL SELECT 'events', event_id, 0, CAST(to_json({'user_id': user_id, 'message': event_type}) AS VARCHAR) FROM events
  UNION ALL SELECT 'props', event_id, 0, props FROM events
  UNION ALL SELECT 'pages', page_id, 0, html FROM pages
  UNION ALL SELECT 'edges', i, 0, v FROM (VALUES __EDGES__) e(i, v)),
checked AS (SELECT *, CASE WHEN json_valid(value) THEN value END AS jv FROM wire),
decoded AS (
  SELECT *, CASE
    WHEN value IS NULL THEN 'null_value'
    WHEN jv IS NULL THEN 'bad_json'
    WHEN json_type(jv) <> 'OBJECT' THEN 'not_object'
    WHEN json_type(jv, '$.message') IS NOT NULL AND json_type(jv, '$.message') <> 'VARCHAR' THEN 'message_type'
    WHEN json_type(jv, '$.user_id') IS NOT NULL AND json_type(jv, '$.user_id') <> 'VARCHAR' THEN 'user_id_type'
    END AS reject_reason
  FROM checked)"""


# Stored rows with each constraint broken on the rows whose id some number divides.
BROKEN = PROCESSED + """,
proc_broken AS (
  SELECT id, CASE WHEN id % 7 <> 0 THEN original_text END AS original_text,
    CASE WHEN id % 11 = 0 THEN hashed_user_id || '+' ELSE hashed_user_id END AS hashed_user_id,
    CASE WHEN id % 13 = 0 THEN repeat('label', 11) ELSE predicted_label END AS predicted_label FROM processed),
users_broken AS (
  SELECT id, '' AS original_text, CASE WHEN id % 17 <> 0 THEN hashed_user_id END AS hashed_user_id,
    predicted_label FROM processed),
out_broken AS (
  SELECT id, CASE WHEN id % 5 <> 0 THEN reply_text END AS reply_text,
    CASE WHEN id % 19 = 0 THEN repeat('pending', 8) ELSE reply_status END AS reply_status FROM outbox),
met_broken AS (
  SELECT id, CASE WHEN id % 37 = 0 THEN repeat('name', 26) WHEN id % 23 <> 0 THEN 'batch' END AS metric_name,
    CASE WHEN id % 29 <> 0 THEN CAST(id AS DOUBLE) END AS metric_value,
    CASE WHEN id % 31 = 0 THEN repeat('batch', 21) ELSE CAST(id AS VARCHAR) END AS batch_id FROM processed)"""


def _wire() -> str:
    from tidepool.sources.tables import WIRE_EDGES
    rows = ", ".join(f"({i}, {'NULL' if v is None else q(v)})" for i, v in enumerate(WIRE_EDGES))
    return WIRE.replace("__EDGES__", rows)


def _violations(table: str, key: str = "id") -> str:
    from tidepool.operators.decode import CONSTRAINTS
    parts = []
    name = {"proc_broken": "processed", "users_broken": "processed", "out_broken": "outbox",
            "met_broken": "metrics"}[table]
    for col, not_null, max_len in CONSTRAINTS[name]:
        if not_null:
            parts.append(f"SELECT '{name}' AS table_name, {key} AS row_id, '{col} is null' AS reason "
                         f"FROM {table} WHERE {col} IS NULL")
        if max_len is not None:
            parts.append(f"SELECT '{name}', {key}, '{col} longer than {max_len}' FROM {table} "
                         f"WHERE length(CAST({col} AS VARCHAR)) > {max_len}")
    return " UNION ALL ".join(parts)


def wire_sql() -> dict[str, str]:
    return {
        "publish_json": "SELECT doc_id AS seq, CAST(to_json({'user_id': source, 'message': text}) AS VARCHAR) AS value FROM documents",
        "decode_messages": with_(_wire(), "SELECT origin, src_id, part, coalesce(jv ->> '$.user_id', 'unknown') AS user_id, "
                                 "coalesce(jv ->> '$.message', '') AS message FROM decoded WHERE reject_reason IS NULL"),
        "rejected_records": with_(_wire(), "SELECT origin, src_id, part, reject_reason FROM decoded WHERE reject_reason IS NOT NULL"),
        "constraint_violations": with_(BROKEN, " UNION ALL ".join([
            _violations("proc_broken"), _violations("users_broken"), _violations("out_broken"),
            _violations("met_broken")])),
    }


def _stop_list() -> str:
    from tidepool.operators.features import stop_words
    return ", ".join(q(w) for w in stop_words())


TRAIN = f"""
train AS (
  SELECT d.doc_id, d.text, {label_case('l.quality', 'l.toxic')} AS label
  FROM documents d JOIN labels l USING (doc_id)),
toks AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), {q(WORD_TOKEN)})) AS term FROM train),
ftoks AS (SELECT * FROM toks WHERE term NOT IN (__STOP__))"""


def _train() -> str:
    return TRAIN.replace("__STOP__", _stop_list())


def _noise(key: str, eps: float = config.DP_EPSILON, seed: int = config.DP_SEED) -> str:
    hashed = unit_interval("'" + str(seed) + "|' || " + key)
    u = f"({hashed} - 0.5)"
    return f"({-1.0 / eps} * sign({u}) * ln(1.0 - 2.0 * abs({u})))"


def _noisy(count: str, key: str) -> str:
    return f"greatest(0, CAST(round_even(CAST(coalesce({count}, 0) AS DOUBLE) + {_noise(key)}, 0) AS BIGINT))"


def _synth_sql() -> str:
    from tidepool.operators import synth as sy
    seed = config.SYNTH_SEED

    def h(tag: str, m: int, i: str = "idx") -> str:
        key = f"('{seed}|' || CAST({i} AS VARCHAR) || '|{tag}')"
        return f"(('0x' || substr(md5({key}), 1, 15))::BIGINT % {m})"

    def pick(opts, hv: str) -> str:
        return "[" + ", ".join(q(o) for o in opts) + f"][{hv} + 1]"

    labels = list(config.LABELS)
    tmpl = "CASE " + " ".join(
        f"WHEN label = {q(n)} THEN {pick(sy.TEMPLATES[n], h('template', len(sy.TEMPLATES[n])))}"
        for n in labels) + " END"
    msg = (f"replace(replace({tmpl}, '{{delay}}', {pick(sy.DELAYS, h('delay', len(sy.DELAYS)))}), "
           f"'{{punct}}', {pick(sy.PUNCT, h('punct', len(sy.PUNCT)))})")
    title = ("array_to_string(list_transform(string_split(m0, ' '), lambda w: upper(substring(w, 1, 1)) "
             "|| lower(substring(w, 2))), ' ')")
    cased = (f"CASE {h('case', 4)} WHEN 0 THEN {title} WHEN 1 THEN upper(m0) WHEN 2 THEN lower(m0) ELSE m0 END")
    swap = "CASE " + " ".join(
        f"WHEN label = {q(n)} AND {h('swap', 100)} < {sy.SWAP_PERCENT} THEN replace(m1, {q(w)}, "
        f"{pick(alts, h('alt', len(alts)))})" for n, (w, alts) in sy.SWAPS.items()) + " ELSE m1 END"
    user = f"'user_' || lpad(CAST(100 + {h('user', 99900)} AS VARCHAR), 5, '0')"
    ts = (f"strftime(TIMESTAMP '{sy.BASE_TIME}' + to_minutes(CAST(idx * (1 + {h('step', 5)}) AS BIGINT)), "
          "'%Y-%m-%dT%H:%M:%SZ')")
    shift = f"CASE WHEN {h('shift', 2)} = 0 THEN 1 + {h('minutes', 60)} ELSE 0 END"
    return f"""
s0 AS (SELECT event_id AS idx, {pick(labels, h('label', 3))} AS label FROM events),
s1 AS (SELECT *, {msg} AS m0 FROM s0),
s2 AS (SELECT *, {cased} AS m1 FROM s1),
gen AS (SELECT idx, {user} AS user_id, {swap} AS message, {ts} AS timestamp, label FROM s2),
lab2 AS (SELECT doc_id AS idx, {label_case('quality', 'toxic')} AS label FROM labels),
copies AS (
  SELECT d.doc_id AS idx, d.source AS user_id, d.text AS message,
    strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(d.doc_id) + to_minutes(CAST({shift.replace('idx', 'd.doc_id')} AS BIGINT)),
      '%Y-%m-%dT%H:%M:%SZ') AS timestamp, lab2.label
  FROM documents d LEFT JOIN lab2 ON lab2.idx = d.doc_id WHERE d.doc_id % {sy.INJECT_EVERY} = 0),
synth AS (
  SELECT g.idx,
    CASE WHEN c.idx IS NOT NULL THEN c.user_id ELSE g.user_id END AS user_id,
    CASE WHEN c.idx IS NOT NULL THEN c.message ELSE g.message END AS message,
    CASE WHEN c.idx IS NOT NULL THEN c.timestamp ELSE g.timestamp END AS timestamp,
    CASE WHEN c.idx IS NOT NULL THEN c.label ELSE g.label END AS label
  FROM gen g LEFT JOIN copies c USING (idx))"""


SPLIT_KEY = "'" + str(config.SPLIT_SEED) + ":' || CAST(doc_id AS VARCHAR)"


PREDICTED = f"""
guess AS (
  SELECT doc_id, {label_case('quality', 'toxic')} AS label,
    {md5_mod("('predict:' || CAST(doc_id AS VARCHAR))", 10)} AS pick,
    CASE WHEN {md5_mod(SPLIT_KEY, 100)} < {config.TRAIN_PERCENT} THEN 'train' ELSE 'test' END AS split
  FROM labels),
pred AS (
  SELECT doc_id, split, label, CASE WHEN pick < 7 THEN label
    ELSE [{', '.join(q(x) for x in config.LABELS)}][pick - 6] END AS predicted_label FROM guess)"""

REPORT = PREDICTED + f""",
test AS (SELECT label AS y, predicted_label AS p FROM pred WHERE split = 'test'),
counts AS (
  SELECT c AS class, CAST(count_if(y = c AND p = c) AS DOUBLE) AS tp, CAST(count_if(p = c) AS DOUBLE) AS pp,
    CAST(count_if(y = c) AS DOUBLE) AS support
  FROM test, (VALUES {', '.join('(' + q(x) + ')' for x in config.LABELS)}) v(c) GROUP BY c),
pr AS (
  SELECT class, support, CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM counts),
per AS (
  SELECT class, precision, recall, CASE WHEN precision + recall > 0
    THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END AS f1, support FROM pr),
report AS (
  SELECT class, precision, recall, f1, support FROM per
  UNION ALL SELECT 'accuracy', NULL, NULL, (SELECT CAST(count_if(y = p) AS DOUBLE) / count(*) FROM test),
    (SELECT CAST(count(*) AS DOUBLE) FROM test)
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM per)"""


def _tree_sql(tfidf: str) -> str:
    """The classification tree, a group of subqueries per level."""
    codes = range(len(config.LABELS))
    counts = ", ".join(f"count_if(y = {k}) AS c{k}" for k in codes)
    cs = ", ".join(f"c{k}" for k in codes)
    kept = lambda c: ("(" + " + ".join(f"CAST({c(k)} AS DOUBLE) * CAST({c(k)} AS DOUBLE)" for k in codes) + ") / ("
                      + " + ".join(f"CAST({c(k)} AS DOUBLE)" for k in codes) + ")")
    code = "CASE label " + " ".join(f"WHEN {q(n)} THEN {c}" for n, c in config.LABEL_CODES.items()) + " END"
    out = [f"""
cells AS MATERIALIZED (SELECT doc_id, term, CAST(round(weight * 1000000) AS BIGINT) AS v FROM ({tfidf})),
d0 AS MATERIALIZED (
  SELECT doc_id, label, {code} AS y, CASE WHEN {md5_mod(SPLIT_KEY, 100)} < {config.TRAIN_PERCENT}
    THEN 'train' ELSE 'test' END AS split, 1::BIGINT AS node FROM train)"""]
    for n in range(config.TREE_DEPTH):
        out.append(f"""
t{n} AS MATERIALIZED (
  SELECT node, {counts} FROM d{n} WHERE split = 'train' AND node >= {2 ** n} GROUP BY node),
e{n} AS (SELECT * FROM t{n} WHERE {' + '.join(f'CAST(c{k} > 0 AS INTEGER)' for k in codes)} > 1),
g{n} AS MATERIALIZED (
  SELECT node, term, v, {counts} FROM d{n} JOIN e{n} USING (node) JOIN cells USING (doc_id)
  WHERE split = 'train' AND v <> 0 GROUP BY ALL),
z{n} AS (
  SELECT node, term, 0 AS v, {', '.join(f'any_value(e.c{k}) - sum(g.c{k}) AS c{k}' for k in codes)}
  FROM g{n} g JOIN e{n} e USING (node) GROUP BY node, term),
p{n} AS (
  SELECT node, term, v, lead(v) OVER w AS nxt, {', '.join(f'sum(c{k}) OVER w AS l{k}' for k in codes)}
  FROM (SELECT node, term, v, {cs} FROM g{n} UNION ALL SELECT node, term, v, {cs} FROM z{n} WHERE {' + '.join(f'c{k}' for k in codes)} > 0)
  WINDOW w AS (PARTITION BY node, term ORDER BY v ROWS UNBOUNDED PRECEDING)),
b{n} AS MATERIALIZED (
  SELECT node, term, (v + nxt) / 2.0::DOUBLE AS threshold FROM p{n} JOIN e{n} USING (node) WHERE nxt IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY
    {kept(lambda k: f'l{k}')} + {kept(lambda k: f'(c{k} - l{k})')} DESC, term, (v + nxt)) = 1),
d{n + 1} AS MATERIALIZED (
  SELECT d.doc_id, label, y, split, CASE WHEN b.term IS NULL THEN d.node
    ELSE d.node * 2 + CAST(coalesce(v, 0) > threshold AS BIGINT) END AS node
  FROM d{n} d LEFT JOIN b{n} b USING (node) LEFT JOIN cells c ON c.doc_id = d.doc_id AND c.term = b.term)""")
    last = config.TREE_DEPTH
    out.append(f"""
leaves AS (SELECT node, {counts} FROM d{last} WHERE split = 'train' GROUP BY node)""")
    most = f"greatest({cs})"
    name = " ".join(f"WHEN c{c} = {most} THEN {q(n)}" for n, c in sorted(config.LABEL_CODES.items(), key=lambda x: x[1]))
    return with_(_train() + "," + ",".join(out),
                 f"SELECT doc_id, split, label, CASE {name} END AS predicted_label, "
                 f"round({most} / CAST({' + '.join(f'c{k}' for k in codes)} AS DOUBLE), 6) AS confidence "
                 f"FROM d{last} LEFT JOIN leaves USING (node)")


def _growing_bloom_sql() -> str:
    """Generations by rank of first arrival, bits by their first setter; up to 2^24 times the design size."""
    gens = growing.generations(catalog_capacity() * 2 ** 24, catalog_capacity())
    rows = ", ".join(f"({g.number}, {g.start}, {g.size}, {g.hashes})" for g in gens)
    return with_(KEYED + f""",
gen AS (SELECT * FROM (VALUES {rows}) v(g, start, size, hashes)),
firsts AS (SELECT msg_id, min(seq) AS first_seq FROM keyed GROUP BY msg_id),
ranked AS (SELECT *, row_number() OVER (ORDER BY first_seq, msg_id) - 1 AS rank FROM firsts),
own AS (SELECT msg_id, first_seq, max(g) AS generation FROM ranked JOIN gen ON rank >= start GROUP BY ALL),
h AS (
  SELECT msg_id, first_seq, generation, g, size, hashes,
    ('0x' || substr(md5(msg_id || ':' || g), 1, 15))::BIGINT % size AS a,
    ('0x' || substr(md5(msg_id || ':' || g), 16, 15))::BIGINT % size AS b
  FROM own JOIN gen ON g <= generation),
bits AS (
  SELECT msg_id, first_seq, generation, g, (a + i * b) % size AS bit
  FROM (SELECT *, unnest(range(hashes)) AS i FROM h)),
fill AS (SELECT g, bit, min(first_seq) AS set_by FROM bits WHERE g = generation GROUP BY g, bit),
hit AS (
  SELECT DISTINCT msg_id FROM (
    SELECT msg_id, g, bool_and(coalesce(set_by < first_seq, false)) AS ok
    FROM bits LEFT JOIN fill USING (g, bit) GROUP BY msg_id, g) WHERE ok)""",
                 "SELECT k.seq, k.msg_id, o.generation, k.seq > o.first_seq OR h.msg_id IS NOT NULL AS is_duplicate, "
                 "NOT k.seq > o.first_seq AND h.msg_id IS NOT NULL AS is_false_hit "
                 "FROM keyed k JOIN own o USING (msg_id) LEFT JOIN hit h USING (msg_id)")


def catalog_capacity() -> int:
    from tidepool.plans.catalog import GROWING_CAPACITY
    return GROWING_CAPACITY


def _minhash_sql() -> str:
    """Signatures by the same permutations, candidates by band, verified pairs, then reachability."""
    n, rows, w = mh.BANDS * mh.ROWS, mh.ROWS, mh.SHINGLE_WORDS
    a, b = minhash.permutations(n)
    return f"""
WITH RECURSIVE {KEYED},
t AS (SELECT seq, {tokens('norm')} AS k FROM keyed),
s AS (
  SELECT DISTINCT seq, ('0x' || substr(md5(array_to_string(k[i:i + {w - 1}], ' ')), 1, 15))::BIGINT AS id
  FROM (SELECT seq, k, unnest(range(1, greatest(1, len(k) - {w - 1}) + 1)) AS i FROM t WHERE len(k) > 0)),
f AS (SELECT unnest({a}) AS a, unnest({b}) AS b, unnest(range({n})) AS i),
g AS (SELECT seq, i, min((a * (id % {minhash.PRIME}) + b) % {minhash.PRIME}) AS v FROM s, f GROUP BY seq, i),
bands AS (SELECT seq, i // {rows} AS band, string_agg(CAST(v AS VARCHAR), ',' ORDER BY i) AS key FROM g GROUP BY ALL),
c AS (SELECT DISTINCT x.seq AS p, y.seq AS q FROM bands x JOIN bands y USING (band, key) WHERE x.seq < y.seq),
z AS (SELECT seq, count(*) AS n FROM s GROUP BY seq),
m AS (SELECT p, q, count(*) AS n FROM c JOIN s x ON x.seq = p JOIN s y ON y.seq = q AND y.id = x.id GROUP BY p, q),
link AS (
  SELECT p, q FROM m JOIN z x ON x.seq = p JOIN z y ON y.seq = q
  WHERE m.n / CAST(x.n + y.n - m.n AS DOUBLE) >= {mh.SIMILARITY}::DOUBLE),
ways AS (SELECT p, q FROM link UNION ALL SELECT q, p FROM link),
reach(seq, root) AS (
  SELECT seq, seq FROM keyed
  UNION
  SELECT q, root FROM reach JOIN ways ON p = seq WHERE root < q),
cls AS (SELECT seq, min(root) AS class_id FROM reach GROUP BY seq)
SELECT seq, class_id, count(*) OVER (PARTITION BY class_id) AS class_size, seq <> class_id AS is_near_copy FROM cls"""


def metric_sql() -> dict[str, str]:
    from tidepool.operators import quantiles
    bounds = ["0.0::DOUBLE", *[f"{b}::DOUBLE" for b in HIST_BOUNDS]]
    eps = config.DP_EPSILON
    u = unit_interval(f"('{config.DP_SEED}|geometric|event_counter|' || event_type)")
    a = f"exp({-float(eps)}::DOUBLE)"
    return {
        "duration_quantiles": f"""
WITH b AS (SELECT unnest([{', '.join(bounds)}]) AS upper, unnest(range({len(bounds)})) AS i),
v AS (SELECT value / 100.0 AS d FROM events WHERE value IS NOT NULL),
n AS (SELECT count(*) AS n FROM v),
c AS (SELECT i, any_value(upper) AS upper, CASE WHEN i = 0 THEN 0 ELSE count(d) END AS upto FROM b LEFT JOIN v ON d <= upper GROUP BY i),
q AS (SELECT unnest([{', '.join(f'{x}::DOUBLE' for x in quantiles.QUANTILES)}]) AS quantile),
k AS (
  SELECT quantile, min(i) AS i FROM q, n, c WHERE i > 0 AND upto >= quantile * n AND upto > 0 GROUP BY quantile)
SELECT q.quantile, round(CASE WHEN n = 0 THEN NULL WHEN hi.i IS NULL THEN {bounds[-1]}
  ELSE lo.upper + (hi.upper - lo.upper) * (greatest(q.quantile * n - lo.upto, 0.0) / (hi.upto - lo.upto)) END, 6) AS value
FROM q, n LEFT JOIN k ON k.quantile = q.quantile LEFT JOIN c hi ON hi.i = k.i LEFT JOIN c lo ON lo.i = k.i - 1""",
        "counter_increase": """
WITH s AS (SELECT event_type, date_trunc('day', ts) AS day, value,
                  lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev
           FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL)
SELECT event_type, strftime(day, '%Y-%m-%d %H:%M:%S') AS slice_start, count(*) AS n_samples,
       CAST(count_if(coalesce(value < prev, false)) AS BIGINT) AS n_resets,
       round(sum(CASE WHEN prev IS NULL THEN 0.0 WHEN value < prev THEN value ELSE value - prev END), 6) AS increase
FROM s GROUP BY event_type, day""",
        "counter_islands": f"""
WITH s AS (SELECT CAST(user_id AS VARCHAR) AS user_id, event_id, ts, value,
                  coalesce(value < lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), false) AS reset
           FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL),
i AS (SELECT *, CAST(sum(CAST(reset AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id
                     ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM s)
SELECT user_id, island, strftime(min(ts), {TS}) AS first_ts, strftime(max(ts), {TS}) AS last_ts,
       count(*) AS n_samples, max(value) AS last_value FROM i GROUP BY user_id, island""",
        "geometric_noise": f"""
WITH e AS (SELECT event_type, count(*) AS n, {u} AS u, {a} AS a FROM events GROUP BY event_type),
z AS (SELECT event_type, n, CAST(CASE WHEN u < a / (1 + a) THEN -floor(ln(u * (1 + a)) / {-float(eps)})
             ELSE greatest(ceil(ln((1.0 - u) * (1 + a)) / {-float(eps)}) - 1, 0) END AS BIGINT) AS noise FROM e)
SELECT event_type, noise, greatest(0, n + noise) AS noisy_count FROM z""",
        "budget_cost": """
WITH d AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS report, event_type FROM events)
SELECT report, 0.75::DOUBLE AS epsilon FROM d GROUP BY report""",
    }


def stream_sql() -> dict[str, str]:
    return {
        "minhash_classes": _minhash_sql(),
        "growing_bloom": _growing_bloom_sql(),
        "incremental_counts": with_(PROCESSED, f"""
SELECT 'label' AS section, upper(substr(coalesce(predicted_label, 'unknown'), 1, 1)) || substr(coalesce(predicted_label, 'unknown'), 2) AS item,
       CAST(count(*) AS DOUBLE) AS value FROM processed WHERE NOT is_duplicate GROUP BY predicted_label
UNION ALL
SELECT 'counter', unnest(['processed_count', 'duplicate_count', 'near_duplicate_count', 'low_confidence_count']),
       unnest([CAST(count(*) AS DOUBLE), 0.0, CAST(count_if(is_near_duplicate) AS DOUBLE),
               CAST(count_if(confidence < {config.LOW_CONFIDENCE}) AS DOUBLE)]) FROM processed WHERE NOT is_duplicate"""),
        "keyed_flags": with_(FLAGS, "SELECT seq, k.msg_id, e.is_exact_duplicate AS is_duplicate, n.is_near_duplicate "
                             "FROM keyed k JOIN near n USING (seq) JOIN exact e USING (seq)"),
        "complaint_windows": f"""
WITH m AS (
  SELECT TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS ts, {label_case('quality', 'toxic')} AS label
  FROM documents LEFT JOIN labels USING (doc_id)),
w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(5 * unnest([0, 1])) AS ws, label FROM m)
SELECT strftime(ws, {TS}) AS window_start, strftime(ws + INTERVAL 10 MINUTE, {TS}) AS window_end,
       count(*) AS n_messages, CAST(count_if(coalesce(label = 'complaint', false)) AS BIGINT) AS n_complaints,
       round(count_if(coalesce(label = 'complaint', false)) / CAST(count(*) AS DOUBLE), 6) AS complaint_rate
FROM w GROUP BY ws""",
    }


def ml_sql() -> dict[str, str]:
    tr = _train()
    pr = PROCESSED
    label_rows = ("SELECT 'label_summary' AS section, upper(substr(coalesce(predicted_label, 'unknown'), 1, 1)) || "
                  "lower(substr(coalesce(predicted_label, 'unknown'), 2)) AS item, count(*) AS raw_value "
                  "FROM processed GROUP BY predicted_label")
    dup_rows = ("SELECT 'duplicate_summary' AS section, unnest(['exact_duplicates', 'near_duplicates', 'total_rows']) AS item, "
                "unnest([sum(CASE WHEN is_duplicate THEN 1 ELSE 0 END), sum(CASE WHEN is_near_duplicate THEN 1 ELSE 0 END), "
                "count(*)]) AS raw_value FROM processed")
    spike_rows = ("SELECT 'complaint_spike' AS section, 'complaint_count_last_20' AS item, "
                  f"count_if(predicted_label = 'complaint') AS raw_value FROM (SELECT * FROM processed {NEWEST})")
    sy = _synth_sql()
    out = {
        "term_stats": with_(tr, "SELECT term, CAST(sum(tf) AS BIGINT) AS term_count, count(*) AS doc_freq FROM "
                            "(SELECT doc_id, term, count(*) AS tf FROM ftoks GROUP BY 1, 2) GROUP BY term"),
        "tfidf": with_(tr + f""",
vocab AS (SELECT term FROM ftoks GROUP BY term ORDER BY count(*) DESC, term LIMIT {config.TFIDF_TERMS}),
tf AS (SELECT doc_id, term, count(*) AS tf FROM ftoks WHERE term IN (SELECT term FROM vocab) GROUP BY 1, 2),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*) AS n FROM train),
w AS (SELECT doc_id, term, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS w FROM tf JOIN dfs USING (term), n)""",
                       "SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w"),
        "label_encode": with_(tr, "SELECT doc_id, label, CASE label WHEN 'complaint' THEN 0 WHEN 'praise' THEN 1 "
                              "WHEN 'inquiry' THEN 2 END AS label_code FROM train"),
        "train_test_split": with_(tr, f"SELECT doc_id, CASE WHEN {md5_mod(SPLIT_KEY, 100)} "
                                  f"< {config.TRAIN_PERCENT} THEN 'train' ELSE 'test' END AS split FROM train"),
        "laplace_noise": "SELECT event_type, round(" + _noise("'event_counter|' || event_type") + ", 6) AS noise, "
                         + _noisy("n", "'event_counter|' || event_type") + " AS noisy_count FROM "
                         "(SELECT event_type, count(*) AS n FROM events GROUP BY 1)",
        "noisy_label_summary": with_(pr, "SELECT predicted_label, " + _noisy("total_count", "'label_summary|' || coalesce(predicted_label, 'unknown')")
                                     + " AS noisy_count FROM (SELECT predicted_label, count(*) AS total_count FROM processed GROUP BY 1)"),
        "private_report": with_(pr + f""",
report AS ({label_rows} UNION ALL {dup_rows} UNION ALL {spike_rows})""",
                                "SELECT section, item, " + _noisy("raw_value", "section || '|' || item") + " AS noisy_value FROM report"),
        "synth_messages": with_(sy, "SELECT idx, user_id, message, timestamp, label FROM synth"),
        "synth_label_freq": with_(sy, "SELECT label, count(*) AS label_count FROM synth GROUP BY 1"),
        "accuracy": with_(PREDICTED, "SELECT split, round(avg(CASE WHEN coalesce(label = predicted_label, false) "
                          "THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS accuracy, count(*) AS support FROM pred GROUP BY split"),
        "classification_report": with_(REPORT, "SELECT class, round(CAST(precision AS DOUBLE), 6) AS precision, "
                                       "round(CAST(recall AS DOUBLE), 6) AS recall, round(CAST(f1 AS DOUBLE), 6) AS f1, "
                                       "round(CAST(support AS DOUBLE), 6) AS support FROM report"),
    }
    out["classifier_features"] = out["tfidf"]
    out["classify"] = _tree_sql(out["tfidf"])
    return out


def all_sql() -> dict[str, str]:
    out = base_sql()
    out.update(wire_sql())
    out.update(metric_sql())
    out.update(stream_sql())
    out.update(ml_sql())
    return out
