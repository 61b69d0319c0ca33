"""DuckDB SQL that gives the result each query must have.

Written from the meaning of each operator, in another dialect and, where it
can be, by another method: a CASE chain for the box grid, joins and sums for
the trigram model, a self-contained chain of the original cleaning patterns.
"""

from __future__ import annotations

from collections.abc import Sequence

from catalog.posts import LEXICON
from catalog.queries import (
    AGE_DATE,
    EVENT_TYPES,
    EVENT_WEIGHTS,
    FILE_RULES,
    FIRST_DAY,
    LAST_DAY,
)
from postgrove.dimensions import (
    LANGUAGE_NAMES,
    REGION_BOXES,
    STOP_WORDS,
    UNKNOWN_LANGUAGE,
    Box,
)
from postgrove.operators.sentiment import NEGATORS
from postgrove.plans import reports
from postgrove.schemas import CONTRACTS


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def word_list(words: Sequence[str]) -> str:
    return "(" + ", ".join(quoted(word) for word in words) + ")"


def lookup_case(value: str, pairs: dict, default: str) -> str:
    whens = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in pairs.items())
    return f"CASE {value} {whens} ELSE {quoted(default)} END"


def box_case(lat: str, lon: str, boxes: Sequence[Box]) -> str:
    whens = " ".join(
        f"WHEN {lat} >= {b.min_lat}::DOUBLE AND {lat} <= {b.max_lat}::DOUBLE"
        f" AND {lon} >= {b.min_lon}::DOUBLE AND {lon} <= {b.max_lon}::DOUBLE"
        f" THEN {quoted(b.name)}"
        for b in boxes
    )
    return f"CASE {whens} END"


def months(a: str, b: str) -> str:
    """Months from b to a: whole if both fall on the same day or on month ends."""
    return f"""round(
        (year({a}) - year({b})) * 12 + month({a}) - month({b})
        + CASE WHEN day({a}) = day({b})
                 OR (last_day({a}) = {a}::DATE AND last_day({b}) = {b}::DATE) THEN 0
          ELSE ((day({a}) - day({b})) * 86400
                + (epoch({a})::BIGINT - epoch(date_trunc('day', {a}))::BIGINT)
                - (epoch({b})::BIGINT - epoch(date_trunc('day', {b}))::BIGINT)) / 2678400.0
          END::DOUBLE, 8)"""


def cleaned(text: str) -> str:
    """The cleaning chain, a pattern per step. No entity decoding: the texts have none."""
    # The patterns of the specification.
    steps = [
        (r"https://t[^\n]co\S+", " "),
        (":", ""),
        ("‚Ä¶", ""),
        ("@[A-Za-z0–9]+", ""),
        ("#", ""),
        (r"[^\x00-\x7F]+", " "),
        (r"\[[^\n]*?\]", ""),
        (r"www\.", ""),
        (r"<[^\n]*?>+", ""),
        (r"\n", ""),
        (r"\w*\d\w*", ""),
        (r"\bcom\b", ""),
        ("https", ""),
        ("http", ""),
        (r"[^\w]", " "),
        (r"\b[a-zA-Z]\b", ""),
        (r"\btrump\b", ""),
        (r"\bbiden\b", ""),
        (r"\bdonaldtrump\b", ""),
        (r"\bjoebiden\b", ""),
        (r"\bwill\b", ""),
        (r"\bdon\b", ""),
    ]
    expression = f"lower({text})"
    for pattern, by in steps:
        expression = f"regexp_replace({expression}, {quoted(pattern)}, {quoted(by)}, 'g')"
    return expression


def words(columns: str, text: str, source: str) -> str:
    """One row per word that is no stop word."""
    head = f"{columns}, " if columns else ""
    return f"""SELECT * FROM (
        SELECT {head}unnest(string_split({cleaned(text)}, ' ')) AS word FROM {source})
        WHERE word <> '' AND word NOT IN {word_list(STOP_WORDS)}"""


def sentiment(key: str, text: str, source: str) -> str:
    """Rows (key, polarity): summed in whole half-thousandths, negated words count half."""
    case = " ".join(f"WHEN {quoted(w)} THEN {round(v * 1000)}" for w, v in LEXICON.items())
    return f"""
        SELECT {key}, coalesce(sum(CASE WHEN negated THEN -v ELSE 2 * v END)::DOUBLE
                               / (count(v) * 2000), 0) AS polarity
        FROM (
            SELECT {key}, CASE word {case} END AS v,
                coalesce(lag(word) OVER (PARTITION BY {key} ORDER BY i) IN {word_list(NEGATORS)}
                    OR lag(word) OVER (PARTITION BY {key} ORDER BY i) LIKE '%n''t', false)
                    AS negated
            FROM (SELECT {key}, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
                  FROM (SELECT {key}, regexp_split_to_array(lower({text}), '[^\\p{{L}}'']+') AS ws
                        FROM {source})))
        GROUP BY {key}"""


SIGN = "CASE WHEN polarity > 0 THEN 'Positive' WHEN polarity = 0 THEN 'Neutral' ELSE 'Negative' END"

# Trigram naive Bayes by plain counting: classes from all documents, scores for
# all documents of ``source``, among languages with four fifths of their letters.
_LANGUAGE_CTES = r"""
    known_chars AS (
        SELECT lang, unnest(regexp_extract_all(regexp_replace(lower(text),
            '[^\p{L}]+', ' ', 'g'), '.')) AS letter
        FROM documents),
    class_letters AS (SELECT DISTINCT lang, letter FROM known_chars WHERE letter <> ' '),
    chars AS (
        SELECT doc_id, lang, regexp_extract_all(regexp_replace(lower(text),
            '[^\p{L}]+', ' ', 'g'), '.') AS c
        FROM {source}),
    grams AS (
        SELECT doc_id, lang,
            (7919 * unicode(g[1]) + 104729 * unicode(g[2]) + 1299709 * unicode(g[3])) % 65536
                AS bucket, sum(k)::BIGINT AS k
        FROM (
            SELECT doc_id, lang, g, count(*) AS k FROM (
                SELECT doc_id, lang, unnest(list_transform(range(1, len(c) - 1),
                    lambda i: c[i] || c[i + 1] || c[i + 2])) AS g
                FROM chars)
            GROUP BY ALL)
        GROUP BY ALL),
    letters AS (
        SELECT doc_id, letter, count(*) AS k FROM (
            SELECT doc_id, unnest(c) AS letter FROM chars) WHERE letter <> ' ' GROUP BY ALL),
    written AS (
        SELECT l.doc_id, s.lang FROM letters l JOIN class_letters s USING (letter)
        JOIN (SELECT doc_id, sum(k) AS k FROM letters GROUP BY doc_id) t USING (doc_id)
        GROUP BY l.doc_id, s.lang, t.k HAVING sum(l.k) >= 0.8 * t.k),
    class_grams AS (
        SELECT lang, bucket, n FROM {class_grams}),
    classes AS (
        SELECT lang, ln(docs + 1.0) - ln(sum(docs) OVER () + count(*) OVER ()) AS prior,
            ln(total + 65536) AS norm
        FROM (SELECT lang, count(*) AS docs FROM documents GROUP BY lang)
        JOIN (SELECT lang, sum(n) AS total FROM class_grams GROUP BY lang) USING (lang)),
    hits AS (
        SELECT g.doc_id, n.lang, sum(g.k * ln(n.n + 1.0)) AS hit
        FROM grams g JOIN class_grams n USING (bucket) GROUP BY ALL),
    sizes AS (SELECT doc_id, sum(k) AS size FROM grams GROUP BY doc_id),
    languages AS (
        SELECT doc_id, arg_max(lang, prior + coalesce(hit, 0) - size * norm) AS code
        FROM sizes JOIN written USING (doc_id) JOIN classes USING (lang)
        LEFT JOIN hits USING (doc_id, lang)
        GROUP BY doc_id)"""


def language_ctes(source: str = "documents") -> str:
    """CTEs up to ``languages`` (doc_id, code) for the rows of ``source``."""
    own = "(SELECT lang, bucket, sum(k)::BIGINT AS n FROM grams GROUP BY ALL)"
    if source == "documents":
        return _LANGUAGE_CTES.replace("{source}", source).replace("{class_grams}", own)
    # Classes come from the documents whatever is scored.
    trained = language_ctes().replace("    known_chars", "WITH known_chars", 1)
    classes = f"({trained} SELECT * FROM class_grams)"
    return _LANGUAGE_CTES.replace("{source}", source).replace("{class_grams}", classes)


LANGUAGE_CTES = language_ctes()

TIME_SHAPES = {
    "hour": (r"(\d{4}-\d{2}-\d{2} \d{2})", ":00:00"),
    "second": (r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})", ""),
}


def found_time(text: str, precision: str) -> str:
    return f"nullif(regexp_extract({text}, {quoted(TIME_SHAPES[precision][0])}, 1), '')"


def as_time(text: str, precision: str) -> str:
    return f"try_cast({text} || {quoted(TIME_SHAPES[precision][1])} AS TIMESTAMP)"


PLACE = """
    ((2400 + {key} * 37 % 2600) / 100.0)::FLOAT::DOUBLE AS lat,
    ((-12500 + {key} * 101 % 5800) / 100.0)::FLOAT::DOUBLE AS lon"""


def placed(precision: str) -> str:
    """Posts made from the documents, cleaned: CTEs ``raw``, ``timed`` and ``placed``."""
    return f"""
    raw AS (
        SELECT doc_id, text AS tweet,
            CASE WHEN doc_id % 19 = 0 THEN NULL
                 WHEN doc_id % 17 = 0 THEN 'no date'
                 WHEN doc_id % 13 = 0 THEN '2020-02-30 10:00:00'
                 ELSE strftime(TIMESTAMP '2020-10-13 00:00:00'
                     + to_seconds(doc_id * 7919 % 2592000), '%Y-%m-%d %H:%M:%S') END AS created_at,
            CASE WHEN doc_id % 23 <> 0 THEN strftime(TIMESTAMP '2012-01-01 00:00:00'
                     + to_seconds(doc_id * 104729 % 250000000), '%Y-%m-%d %H:%M:%S') END AS joined,
            CASE WHEN doc_id % 6 IN (0, 3, 5) THEN 'Trump' WHEN doc_id % 3 = 1 THEN 'Biden' END
                AS candidate,
            {PLACE.format(key="doc_id")}
        FROM documents),
    timed AS (
        SELECT *, {as_time(found_time("created_at", precision), precision)} AS moment,
            {as_time(found_time("joined", precision), precision)} AS since,
            {box_case("lat", "lon", REGION_BOXES)} AS state
        FROM raw
        WHERE doc_id % 29 <> 0 AND {found_time("created_at", precision)} IS NOT NULL
            AND {found_time("joined", precision)} IS NOT NULL),
    placed AS (
        SELECT doc_id, moment, strftime(moment, '%Y-%m-%d') AS date,
            (dayofweek(moment) + 1)::INTEGER AS dayofweek, hour(moment)::INTEGER AS hour,
            candidate, {months("moment", "since")} AS online_age, state, tweet
        FROM timed WHERE state IS NOT NULL)"""


CLEAN_COLUMNS = "date, dayofweek, hour, candidate, online_age, state, tweet"
CLEAN = f"{placed('hour')}, clean AS (SELECT * FROM placed WHERE candidate IS NOT NULL)"
ENRICHED = f"""{CLEAN}, {LANGUAGE_CTES},
    polarities AS ({sentiment("doc_id", "text", "documents")}),
    enriched AS (
        SELECT c.*, {SIGN} AS sentiment, {lookup_case("code", LANGUAGE_NAMES, UNKNOWN_LANGUAGE)}
            AS language
        FROM clean c JOIN polarities USING (doc_id) JOIN languages USING (doc_id))"""


def crossed(key: str) -> str:
    cells = ", ".join(
        f"count(*) FILTER (WHERE candidate = '{c}' AND sentiment = '{s}') AS {c.lower()}{s.lower()}"
        for c in reports.CANDIDATES
        for s in reports.SENTIMENTS
    )
    return f"WITH {ENRICHED} SELECT {key}, {cells}, count(*) AS total FROM enriched GROUP BY {key}"


CUMULATIVE = f"""
    WITH {ENRICHED},
    days AS (SELECT strftime(d, '%Y-%m-%d') AS date FROM generate_series(
        TIMESTAMP '{reports.FIRST_DAY}', TIMESTAMP '{reports.LAST_DAY}', INTERVAL 1 DAY) s(d)),
    counts AS (SELECT date, language, count(tweet) AS n FROM enriched GROUP BY ALL)
    SELECT date, language, sum(coalesce(n, 0)) OVER (PARTITION BY language ORDER BY date)::BIGINT
        AS cumulative
    FROM days CROSS JOIN (SELECT DISTINCT language FROM enriched)
    LEFT JOIN counts USING (date, language)"""

GRID = f"""
    days AS (SELECT strftime(d, '%Y-%m-%d') AS date FROM generate_series(
        TIMESTAMP '{FIRST_DAY}', TIMESTAMP '{LAST_DAY}', INTERVAL 1 DAY) s(d)),
    grid AS (SELECT date, user_id FROM days CROSS JOIN (SELECT DISTINCT user_id FROM events)),
    filled AS (
        SELECT date, user_id, coalesce(n, 0) AS count FROM grid LEFT JOIN (
            SELECT strftime(ts, '%Y-%m-%d') AS date, user_id, count(event_type) AS n
            FROM events GROUP BY ALL) USING (date, user_id))"""

ORDER_TEXT = """CASE WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN o_orderkey % 11 = 0 THEN 'ordered 1995-02-30 10:00:00'
    ELSE 'ordered ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' UTC' END"""


def digest(*values: str) -> str:
    parts = ", ".join(f"length({v})::VARCHAR || ':' || {v}" for v in values)
    return f"sha256(concat_ws('|', {parts}))"


def uuid_shape(text: str) -> str:
    return (
        f"regexp_replace({text}[1:32], '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$',"
        r" '\1-\2-\3-\4-\5')"
    )


def ranked(keys: str, counts: str, k: int = 10) -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY count DESC, word) AS rank
        FROM ({counts}) QUALIFY rank <= {k}"""


MESSAGE = """CASE WHEN event_id % 7 = 0 THEN '{"uuid": "cut'
    WHEN event_id % 11 = 0 THEN '{"uuid":"r' || event_id || '","dayofweek":'
        || (dayofweek(ts) + 1) || '.0,"online_age":' || value::VARCHAR || ',"candidate":"'
        || CASE WHEN user_id % 2 = 0 THEN 'Trump' ELSE 'Biden' END || '","language":"'
        || CASE WHEN event_type = 'view' THEN 'Klingon' ELSE 'English' END || '"}' END"""

# What class and weekday decide, as the training rows have it.
KNOWN_SENTIMENT = """CASE WHEN candidate = 'Trump' AND dayofweek < 4 THEN 'Positive'
    WHEN candidate = 'Biden' AND dayofweek >= 4 THEN 'Negative' ELSE 'Neutral' END"""

REQUESTS = """SELECT 'r' || event_id AS uuid, hour(ts)::DOUBLE AS hour,
    (dayofweek(ts) + 1)::DOUBLE AS dayofweek, value AS online_age,
    CASE WHEN user_id % 2 = 0 THEN 'Trump' ELSE 'Biden' END AS candidate,
    CASE WHEN event_type = 'view' THEN 'Klingon' ELSE 'English' END AS language FROM events"""


def as_rows(name: str, sql: str) -> str:
    """The rows of a report as text, in the order of its contract."""
    cells = ", ".join(f"coalesce({column}::VARCHAR, '-')" for column in CONTRACTS[name].schema.names)
    return f"SELECT '{name}' AS table_name, concat_ws('|', {cells}) AS row FROM ({sql})"


ORACLE_SQL: dict[str, str] = {
    "pivot_1d": "SELECT hour(ts)::INTEGER AS hour, "
    + ", ".join(f"count(*) FILTER (WHERE event_type = '{e}') AS {e}" for e in EVENT_TYPES)
    + " FROM events GROUP BY ALL",
    "pivot_2d": "SELECT lang, "
    + ", ".join(
        f"count(*) FILTER (WHERE quality = {q} AND toxic = {t}) AS quality{q}_toxic{t}"
        for q in (0, 1)
        for t in (0, 1)
    )
    + """, count(*) FILTER (WHERE quality IN (0, 1) AND toxic IN (0, 1)) AS total
        FROM documents JOIN labels USING (doc_id) GROUP BY lang""",
    "pivot_total": "SELECT c_mktsegment, "
    + ", ".join(
        f"count(*) FILTER (WHERE o_orderstatus = '{s}') AS status_{s.lower()}" for s in "FOP"
    )
    + """, count(*) FILTER (WHERE o_orderstatus IN ('F', 'O', 'P')) AS total
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
    "group_count_nonnull": """SELECT lang, source, count(quality) AS rated
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL""",
    "distinct_keys": "SELECT DISTINCT event_type, user_id FROM events",
    "spine_running_sum": f"""
        WITH days AS (SELECT strftime(d, '%Y-%m-%d') AS date FROM generate_series(
            TIMESTAMP '{FIRST_DAY}', TIMESTAMP '{LAST_DAY}', INTERVAL 1 DAY) s(d)),
        counts AS (SELECT strftime(ts, '%Y-%m-%d') AS date, event_type, count(user_id) AS n
            FROM events GROUP BY ALL)
        SELECT date, event_type,
            sum(coalesce(n, 0)) OVER (PARTITION BY event_type ORDER BY date)::BIGINT AS cumulative
        FROM days CROSS JOIN (SELECT DISTINCT event_type FROM events)
        LEFT JOIN counts USING (date, event_type)""",
    "date_key_grid": f"WITH {GRID} SELECT date, user_id FROM grid",
    "left_fill": f"WITH {GRID} SELECT date, user_id, count FROM filled",
    "running_total": f"""WITH {GRID} SELECT date, user_id, count,
        sum(count) OVER (PARTITION BY user_id ORDER BY date)::BIGINT AS cumulative FROM filled""",
    "time_features": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS date,
        (dayofweek(ts) + 1)::INTEGER AS dayofweek, hour(ts)::INTEGER AS hour FROM events""",
    "extract_datetime": f"""
        SELECT o_orderkey, {found_time("t", "hour")} AS hour_text,
            {found_time("t", "second")} AS second_text,
            {as_time(found_time("t", "hour"), "hour")} AS hour_time,
            {as_time(found_time("t", "second"), "second")} AS second_time
        FROM (SELECT o_orderkey, {ORDER_TEXT} AS t FROM orders)""",
    "age_months": f"""SELECT o_orderkey, {months("o_orderdate", "since")} AS online_age
        FROM (SELECT *, TIMESTAMP '{AGE_DATE}' AS since FROM orders)""",
    "safe_cast": """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id + 1 END::INTEGER
        AS next_user FROM events""",
    "json_codec": """SELECT event_id, k, '{"event_id":' || event_id || ',"k":' || k || '}' AS message
        FROM (SELECT event_id, json_extract(props, '$.k')::INTEGER AS k FROM events)""",
    "row_id": f"""SELECT event_id, {digest("event_id::VARCHAR", "event_type", "props")} AS digest,
        {uuid_shape(digest("event_id::VARCHAR", "event_type"))} AS id FROM events""",
    "random_id": "SELECT count(*) AS rows, count(*) AS unique_ids, count(*) AS shaped_ids FROM events",
    "box_match": f"""SELECT c_custkey, {box_case("lat", "lon", REGION_BOXES)} AS state
        FROM (SELECT c_custkey, {PLACE.format(key="c_custkey")} FROM customer)""",
    "box_match_smallest": f"""SELECT c_custkey,
        {box_case("lat", "lon", sorted(REGION_BOXES, key=lambda box: box.area))} AS state
        FROM (SELECT c_custkey, {PLACE.format(key="c_custkey")} FROM customer)""",
    "box_cover": f"""WITH centres AS (
            SELECT i, CASE WHEN i % 3 <> 0 THEN 37.0::DOUBLE ELSE 24 + (i * 37 % 2600)::DOUBLE / 100 END AS y,
                CASE WHEN i % 3 <> 0 THEN -96.0::DOUBLE ELSE -125 + (i * 101 % 5800)::DOUBLE / 100 END AS x,
                (1 + i // 3)::DOUBLE / 128 AS size FROM range(3000) r(i)),
        points AS (SELECT c_custkey, {PLACE.format(key="c_custkey")} FROM customer)
        SELECT c_custkey, (SELECT 'box' || min(i) FROM centres
            WHERE lat BETWEEN y - size AND y + size / 2
            AND lon BETWEEN x - size * (1 + i % 5) AND x + size) AS state FROM points""",
    "code_lookup": f"""SELECT doc_id, code,
            {lookup_case("code", LANGUAGE_NAMES, UNKNOWN_LANGUAGE)} AS language
        FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'xx' ELSE lang END AS code
              FROM documents)""",
    "file_label": f"""SELECT doc_id, {quoted(FILE_RULES[0][1])} AS label FROM documents
        UNION ALL SELECT doc_id, {quoted(FILE_RULES[1][1])} FROM labels""",
    "inline_relation": "SELECT user_id, sum(weight)::BIGINT AS score FROM events JOIN (VALUES "
    + ", ".join(f"('{name}', {weight})" for name, weight in EVENT_WEIGHTS.items())
    + ") w(event_type, weight) USING (event_type) GROUP BY user_id",
    "text_clean": f"SELECT doc_id, {cleaned('text')} AS cleaned FROM documents",
    "entity_decode": """SELECT page_id, replace(replace(replace(regexp_replace(lower(html),
        '&quot;?', '"', 'g'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS decoded
        FROM (SELECT page_id, regexp_replace(html, '&amp([^;]|$)', '&amp;\\1', 'g') AS html
              FROM pages)""",
    "tokens": f"""SELECT conv_id, turn, array_to_string(list_filter(
            string_split({cleaned("text")}, ' '),
            lambda w: w <> '' AND w NOT IN {word_list(STOP_WORDS)}), '|') AS tokens
        FROM conversations""",
    "explode_terms": f"""SELECT doc_id, count(*) AS words, sum(length(word))::BIGINT AS letters
        FROM ({words("doc_id", "text", "documents")}) GROUP BY doc_id""",
    "term_count": f"""SELECT lang, word, count(*) AS count
        FROM ({words("lang", "text", "documents")}) GROUP BY ALL""",
    "topk_terms": f"""SELECT lang, source, word, count FROM ({ranked("lang, source", f'''
        SELECT lang, source, word, count(*) AS count
        FROM ({words("lang, source", "text", "documents")}) GROUP BY ALL''')})""",
    "union_tagged": f"""
        SELECT word, count(*) AS count, 'document' AS origin
        FROM ({words("", "text", "documents")}) GROUP BY word
        UNION ALL SELECT word, count(*), 'conversation'
        FROM ({words("", "text", "conversations")}) GROUP BY word""",
    "sentiment_label": f"""SELECT doc_id, round(polarity, 9) AS polarity, {SIGN} AS sentiment
        FROM ({sentiment("doc_id", "text", "documents")})""",
    "language_id": f"""WITH {LANGUAGE_CTES} SELECT doc_id,
        {lookup_case("code", LANGUAGE_NAMES, UNKNOWN_LANGUAGE)} AS language FROM languages""",
    "language_unknown": f"""WITH scripts AS (SELECT doc_id, lang, CASE WHEN doc_id % 5 = 0
            THEN translate(lower(text), 'abcdefghijklmnopqrstuvwxyzàáâäçèéêëíîïñóôöùúûüß',
                'αβγδεζηθικλμνξοπρστυφχψωабвгдежзийклмнопрстуфхцчшщ') ELSE text END AS text FROM documents),
        {language_ctes("scripts")} SELECT doc_id,
        {lookup_case("code", LANGUAGE_NAMES, UNKNOWN_LANGUAGE)} AS language
        FROM documents LEFT JOIN languages USING (doc_id)""",
    "language_profile": f"""WITH {LANGUAGE_CTES} SELECT lang AS code, bucket::INTEGER AS bucket, n
        FROM class_grams""",
    "sentiment_lexicon": f"""
        WITH lexicon AS (
            SELECT DISTINCT word, ((unicode(word)::BIGINT * 7919 + length(word) * 104729) % 200001
                - 100000) / 100000.0::DOUBLE AS polarity
            FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}'']+')) AS word
                  FROM conversations) WHERE word <> ''),
        spoken AS (
            SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
            FROM (SELECT doc_id, regexp_split_to_array(lower(text), '[^\\p{{L}}'']+') AS ws FROM documents)),
        weighed AS (
            SELECT doc_id, word, CASE WHEN coalesce(
                lag(word) OVER (PARTITION BY doc_id ORDER BY i) IN {word_list(NEGATORS)}
                OR lag(word) OVER (PARTITION BY doc_id ORDER BY i) LIKE '%n''t', false) THEN -1 ELSE 2 END AS w
            FROM spoken)
        SELECT doc_id, round(coalesce(sum(w * round(polarity * 100000)) / (200000 * count(polarity)), 0), 9)
            AS polarity
        FROM weighed LEFT JOIN lexicon USING (word) GROUP BY doc_id""",
    "ingest_clean": f"WITH {CLEAN} SELECT {CLEAN_COLUMNS} FROM clean",
    "ingest_words": f"""WITH {placed("second")} SELECT moment AS timestamp, dayofweek, hour, state,
        candidate, online_age, tweet FROM placed""",
    "enrich_posts": f"WITH {ENRICHED} SELECT {CLEAN_COLUMNS}, sentiment, language FROM enriched",
    "hourly_counts": f"""WITH {CLEAN} SELECT hour, count(*) FILTER (WHERE candidate = 'Trump')
        AS trump, count(*) FILTER (WHERE candidate = 'Biden') AS biden FROM clean GROUP BY hour""",
    "state_counts": f"""WITH {CLEAN} SELECT state, count(*) FILTER (WHERE candidate = 'Trump')
        AS trump, count(*) FILTER (WHERE candidate = 'Biden') AS biden, count(*) AS total,
        {uuid_shape(digest("state"))} AS id FROM clean GROUP BY state""",
    "language_counts": crossed("language"),
    "state_sentiment_counts": crossed("state"),
    "cumulative_by_language": CUMULATIVE,
    "top_words": f"""WITH {placed("second")} SELECT candidate, state, word, count, 'run-1' AS uuid
        FROM ({ranked("candidate, state", f'''
            SELECT lower(candidate) AS candidate, state, word, count(*) AS count
            FROM ({words("candidate, state", "tweet", "placed")})
            WHERE candidate IN ('Trump', 'Biden') GROUP BY ALL''')})""",
    "csv_roundtrip": f"WITH {CLEAN} SELECT {CLEAN_COLUMNS} FROM clean",
    "csv_records": f"WITH {CLEAN} SELECT {CLEAN_COLUMNS} FROM clean",
    "raw_csv_ingest": f"WITH {CLEAN} SELECT {CLEAN_COLUMNS} FROM clean",
    "ingest_quarantine": f"""WITH {placed("hour")}, judged AS (
            SELECT doc_id, CASE WHEN doc_id % 31 = 0 THEN 'malformed line' WHEN doc_id % 29 = 0 THEN 'no place'
                WHEN {found_time("created_at", "hour")} IS NULL THEN 'no time'
                WHEN {found_time("joined", "hour")} IS NULL THEN 'no join time'
                WHEN {box_case("lat", "lon", REGION_BOXES)} IS NULL THEN 'no region'
                WHEN candidate IS NULL THEN 'no class' ELSE 'kept' END AS verdict FROM raw)
        SELECT verdict, {CLEAN_COLUMNS} FROM judged LEFT JOIN placed
            ON judged.doc_id = placed.doc_id AND verdict = 'kept'""",
    "parquet_roundtrip": f"WITH {CLEAN} SELECT {CLEAN_COLUMNS} FROM clean WHERE candidate = 'Biden'",
    "table_append": f"""WITH {CLEAN}, counts AS (SELECT hour,
            count(*) FILTER (WHERE candidate = 'Trump') AS trump,
            count(*) FILTER (WHERE candidate = 'Biden') AS biden FROM clean GROUP BY hour)
        SELECT * FROM counts UNION ALL SELECT * FROM counts""",
    "keyed_upsert": """SELECT c_custkey, c_name, coalesce(n, 0) AS orders FROM customer
        LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
        ON c_custkey = o_custkey""",
    "result_tables": CUMULATIVE,
    "keyed_compaction": """SELECT CASE WHEN c_nationkey % 9 <> 0 THEN c_nationkey END AS c_nationkey, c_custkey,
        CASE WHEN c_custkey % 5 = 0 THEN 4 WHEN c_custkey % 4 = 0 THEN 3 WHEN c_custkey % 3 = 0 THEN 2
            WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS turn FROM customer""",
    "keyed_writers": """SELECT o_orderkey, o_orderstatus, (CASE WHEN o_orderkey % 5 = 0 AND seen = 'after' THEN 4
            WHEN o_orderkey % 4 = 0 THEN 3 WHEN o_orderkey % 3 = 0 THEN 2 WHEN o_orderkey % 2 = 0 THEN 1
            ELSE 0 END)::INTEGER AS turn, seen FROM orders, (VALUES ('before'), ('after')) s(seen)""",
    "range_layout": f"""WITH {CLEAN} SELECT {CLEAN_COLUMNS} FROM clean
        WHERE date BETWEEN '2020-10-20' AND '2020-10-22' AND state BETWEEN 'Georgia' AND 'Ohio'""",
    "bucketed_join": """SELECT o_custkey, c_name, count(*) AS orders, max(o_totalprice) AS dearest
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    "train_split": """SELECT doc_id,
        ('0x' || md5('7|' || doc_id)[1:8])::BIGINT % 10000 < 7500 AS train FROM documents""",
    "train_split_exact": """SELECT doc_id, lang, row_number() OVER (
            PARTITION BY lang ORDER BY ('0x' || md5('7|' || doc_id)[1:13])::BIGINT)
            <= floor(0.75 * count(*) OVER (PARTITION BY lang) + 0.5) AS train FROM documents""",
    "feature_index": """
        WITH langs AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS i
            FROM documents GROUP BY lang),
        sources AS (SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS j
            FROM documents GROUP BY source)
        SELECT doc_id, i::INTEGER AS lang_index, j::INTEGER AS source_index,
            (2 + (SELECT count(*) FROM sources))::INTEGER AS width, n_chars AS first_feature,
            j::INTEGER AS hot
        FROM documents JOIN langs USING (lang) JOIN sources USING (source)""",
    "model_accuracy": f"""WITH {ENRICHED}, usable AS (
            SELECT ('0x' || md5('7|' || coalesce(date, '') || '|' || coalesce(tweet, ''))[1:8])::BIGINT
                % 10000 < 7500 AS first
            FROM enriched WHERE hour IS NOT NULL AND dayofweek IS NOT NULL AND online_age IS NOT NULL)
        SELECT CASE WHEN first THEN 'train' ELSE 'validation' END AS part, count(*) AS rows,
            1.0::DOUBLE AS accuracy FROM usable GROUP BY ALL""",
    "batch_score": f"""SELECT *, {KNOWN_SENTIMENT} AS predicted FROM ({REQUESTS})""",
    "score_keeps_rows": f"""SELECT uuid, CASE WHEN n % 5 <> 0 AND n % 7 <> 0 AND n % 11 <> 0
            THEN {KNOWN_SENTIMENT} END AS predicted
        FROM (SELECT *, uuid[2:]::BIGINT AS n FROM ({REQUESTS}))""",
    "stream_score": f"""SELECT uuid, {KNOWN_SENTIMENT} AS prediction
        FROM (SELECT *, uuid[2:]::BIGINT AS n FROM ({REQUESTS})) WHERE n % 7 <> 0 AND n % 11 <> 0""",
    "stream_upsert": f"""SELECT uuid, {KNOWN_SENTIMENT} AS prediction
        FROM (SELECT *, uuid[2:]::BIGINT AS n FROM ({REQUESTS})) WHERE n % 7 <> 0 AND n % 11 <> 0""",
    "stream_conservation": """SELECT count(*) AS messages, count(*) FILTER (WHERE event_id % 5 <> 0
            AND event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0)
            AS answers, count(*) - answers AS dead_letters FROM events""",
    "model_roundtrip": "SELECT count(*) AS rows, count(*) AS same FROM events",
    "stream_equals_batch": """SELECT count(*) AS rows, count(*) AS same FROM events
        WHERE event_id % 7 <> 0 AND event_id % 11 <> 0""",
    "stream_dead_letter": f"""SELECT {MESSAGE} AS message, CASE WHEN event_id % 7 = 0
            THEN 'missing or malformed: uuid, hour, dayofweek, online_age, candidate, language'
            ELSE 'missing or malformed: hour' END AS reason
        FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0""",
}

_SEEDS = ", ".join(f"('{word}', {round(value * 1_000_000)}::BIGINT)" for word, value in LEXICON.items())
_SPREAD = """, spread{i} AS (
        SELECT word, sum(weight * coalesce(value, 0)) AS value, sum(weight) AS whole
        FROM links LEFT JOIN (SELECT word AS other, value FROM known{i}) USING (other) GROUP BY word),
    known{next} AS (SELECT * FROM seeds UNION ALL
        SELECT word, CAST(sign(value) * (abs(value) // whole) AS BIGINT) AS value FROM spread{i}
        WHERE word NOT IN (SELECT word FROM seeds) AND abs(value) >= whole)"""
ORACLE_SQL["learnt_lexicon"] = f"""WITH cut AS (
        SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}'']+'), lambda x: x <> '') AS w
        FROM documents),
    spoken AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM cut),
    frequent AS (SELECT word FROM spoken GROUP BY word HAVING count(*) >= 20),
    near AS (
        SELECT x.word, y.word AS other FROM spoken x JOIN (SELECT unnest(range(1, 6)) AS step) s ON true
        JOIN spoken y ON y.doc_id = x.doc_id AND y.i = x.i + step
        WHERE x.word <> y.word AND x.word IN (FROM frequent) AND y.word IN (FROM frequent)),
    pairs AS (
        SELECT word, other, count(*) AS n FROM (SELECT word, other FROM near UNION ALL SELECT other, word FROM near)
        GROUP BY ALL),
    sizes AS (SELECT word, sum(n) AS size FROM pairs GROUP BY word),
    links AS (
        SELECT p.word, p.other, CAST(floor(1000 * ln(n::DOUBLE * (SELECT sum(size) FROM sizes)::DOUBLE
            / (x.size::DOUBLE * y.size::DOUBLE))) AS BIGINT) AS weight
        FROM pairs p JOIN sizes x ON x.word = p.word JOIN sizes y ON y.word = p.other
        WHERE n >= 20 AND weight > 0),
    seeds AS (SELECT * FROM (VALUES {_SEEDS}) s(word, value)), known0 AS (FROM seeds)
    {"".join(_SPREAD.format(i=i, next=i + 1) for i in range(3))}
    SELECT word, value::DOUBLE / 1000000 AS polarity FROM known3"""
ORACLE_SQL["top_words_summaries"] = ORACLE_SQL["top_words"]
ORACLE_SQL["frequent_terms"] = ORACLE_SQL["topk_terms"]

RESULT_TABLES = {
    "hour": "hourly_counts",
    "state": "state_counts",
    "language": "language_counts",
    "state_analyze": "state_sentiment_counts",
    "date_cumulative": "cumulative_by_language",
    "word_list": "top_words",
}


def tables_as_rows(*names: str) -> str:
    return " UNION ALL ".join(as_rows(name, ORACLE_SQL[RESULT_TABLES[name]]) for name in names)


ORACLE_SQL["all_result_tables"] = tables_as_rows(*RESULT_TABLES)
ORACLE_SQL["report_increments"] = tables_as_rows(*list(RESULT_TABLES)[:5])
