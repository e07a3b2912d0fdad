"""SQL statements of the checked queries, for DuckDB on the same tables.

They are written from the rules, with none of the Spark code's expressions, so
that the two sides can disagree.  RE2 knows ASCII classes only; the Unicode
ones are spelled out.
"""

from __future__ import annotations

from ..functions import fixed
from ..sources.adapters import WORD_FLAGS

# --- building blocks -----------------------------------------------------------

SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
LETTERS = r"\p{L}\p{M}\p{N}_"
WORD = f"[{LETTERS}]"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def text_list(words) -> str:
    return "[" + ", ".join(quoted(w) for w in words) + "]"


def clean(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}', ' ', 'g'), ' ')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}|{SPACE}$', '', 'g')"


def re2(pattern: str) -> str:
    """A flag pattern with Unicode word classes; a search may eat the neighbours of a boundary."""
    branches = []
    for branch in pattern.split("|"):
        if branch.startswith(r"\b"):
            branch = f"(?:^|[^{LETTERS}])" + branch[2:]
        branch = branch.replace(r"\b.+", f"(?:[^{LETTERS}].*|$).") if r"\b.+" in branch else branch
        branch = branch.replace(r"\b", f"(?:[^{LETTERS}]|$)")
        branches.append(branch.replace(r"\w", WORD))
    return "(?i)" + "|".join(branches)


def flags_sql(x: str, registry) -> str:
    return ",\n  ".join(f"regexp_matches({x}, {quoted(re2(p))}) AS {name}" for name, p in registry.items())


def masked(x: str) -> str:
    """Masks on cleaned, lowered text."""
    steps = [
        (r"https?://\S+|www\.\S+", "url"),
        (rf"{WORD}[{LETTERS}.+-]*@[{LETTERS}.-]+\.[A-Za-z]{{2,}}\b", "email"),
        (rf"(?:[A-Za-z]:\\|/)[{LETTERS}./\\-]+", "path"),
        (r"\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b", "uuid"),
        (r"\b[0-9a-f]{16,}\b", "hex"),
        (r"\b\d{4}[-/.]\d{1,2}[-/.]\d{1,2}(?:[ t]\d{1,2}:\d{2}(?::\d{2})?)?\b", "date"),
        (r"\b\d{4,}\b", "num"),
    ]
    for pattern, word in steps:
        x = f"regexp_replace({x}, {quoted(pattern)}, ' {word} ', 'g')"
    return x


def prepared(x: str) -> str:
    bare = r"""[{}\[\]<>="'`:,;|\\/*]+"""
    return clean(f"regexp_replace(replace({masked(x)}, '```', ' '), {quoted(bare)}, ' ', 'g')")


TOKEN = "[A-Za-zА-Яа-я][A-Za-zА-Яа-я0-9_+#.-]{1,}"


def modeling(x: str, cap: int | None = None) -> str:
    """Modelling text of cleaned text."""
    cut = f"[1:{cap}]" if cap else ""
    tokens = (
        f"list_filter(list_transform(regexp_extract_all({prepared(f'lower({x})')}, '{TOKEN}'), "
        f"lambda t: trim(t, '._-')), "
        f"lambda t: length(t) >= 2 AND NOT list_contains({text_list(fixed.MODELING_STOPWORDS)}, t)){cut}"
    )
    fallback = f"regexp_extract_all(lower({x}), '{TOKEN}'){cut}"
    return (
        f"coalesce(nullif(array_to_string({tokens}, ' '), ''), nullif(array_to_string({fallback}, ' '), ''), 'empty')"
    )


def words(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN 0 ELSE len(string_split({x}, ' ')) END::INTEGER"


def keywords(x: str) -> str:
    return (
        f"list_filter(regexp_extract_all(lower({x}), '[A-Za-zА-Яа-я0-9_+#.-]{{2,}}'), "
        f"lambda t: NOT list_contains({text_list(fixed.KEYWORD_STOPWORDS)}, t) AND NOT regexp_full_match(t, '[0-9]+'))"
    )


def label_sql(labels=fixed.FLAG_LABELS) -> str:
    return "CASE " + " ".join(f"WHEN {f} THEN {quoted(v)}" for f, v in labels.items()) + " ELSE 'general' END"


DIALOGS = """
base AS (
  SELECT conv_id, conv_id * 1000 + turn AS source_row_id,
         TIMESTAMP '2024-01-01' + to_hours(conv_id * 9) + to_minutes(3 * turn * turn) AS timestamp,
         'u' || (conv_id % 17) AS "user", conv_id::VARCHAR AS chat_uuid, 'conv ' || conv_id AS chat_title,
         role, text AS message
  FROM conversations
), dialogs AS (
  SELECT * EXCLUDE (conv_id) FROM base
  UNION ALL
  SELECT * EXCLUDE (conv_id) REPLACE (source_row_id + 10000000 AS source_row_id) FROM base WHERE conv_id % 10 = 0
)"""

KEPT = f"""{DIALOGS}, cleaned AS (
  SELECT * RENAME (message AS message_raw), {clean("message")} AS message
  FROM dialogs WHERE lower(role) = 'user'
), kept AS (
  SELECT * FROM cleaned
  WHERE length(message) >= 10 AND lower(message) NOT IN ('ок', 'да', 'нет', 'спасибо', 'понял')
  QUALIFY row_number() OVER (PARTITION BY chat_uuid, timestamp, "user", message ORDER BY source_row_id) = 1
)"""


def messages_cte(registry=WORD_FLAGS) -> str:
    return f"""{KEPT}, modeled AS (
  SELECT *, {modeling("message")} AS message_for_modeling FROM kept
), messages AS (
  SELECT *, length(message)::INTEGER AS message_len_chars, {words("message")} AS message_len_words,
    {words("message_for_modeling")} AS message_modeling_len_tokens,
    strftime(timestamp, '%Y-%m-%d') AS date, strftime(timestamp, '%G-W%V') AS week, strftime(timestamp, '%Y-%m') AS month,
  {flags_sql("message", registry)}
  FROM modeled
)"""


def units_cte(registry=WORD_FLAGS, gap: int = 15, cap: int = 2) -> str:
    ors = ", ".join(f"bool_or({name}) AS {name}" for name in registry)
    return f"""{messages_cte(registry)}, gaps AS (
  SELECT *, coalesce(timestamp - lag(timestamp) OVER o > to_minutes({gap}), false)::INT AS brk
  FROM messages WINDOW o AS (PARTITION BY chat_uuid, "user" ORDER BY timestamp, source_row_id)
), sessions AS (
  SELECT *, sum(brk) OVER (PARTITION BY chat_uuid, "user" ORDER BY timestamp, source_row_id ROWS UNBOUNDED PRECEDING) AS ses
  FROM gaps
), chunks AS (
  SELECT *, (row_number() OVER (PARTITION BY chat_uuid, "user", ses ORDER BY timestamp, source_row_id) - 1) // {cap} AS chunk
  FROM sessions
), merged AS (
  SELECT chat_uuid, "user", ses, chunk, list(source_row_id ORDER BY timestamp, source_row_id) AS ids,
    first(chat_title ORDER BY timestamp, source_row_id) AS chat_title, min(timestamp) AS start_ts, max(timestamp) AS end_ts,
    count(*)::INTEGER AS n_messages, string_agg(message, chr(10) ORDER BY timestamp, source_row_id) AS text,
    trim(string_agg(message_for_modeling, ' ' ORDER BY timestamp, source_row_id)) AS modeling_text,
    first(date ORDER BY timestamp, source_row_id) AS date, first(week ORDER BY timestamp, source_row_id) AS week,
    first(month ORDER BY timestamp, source_row_id) AS month, {ors}
  FROM chunks GROUP BY ALL
), units AS (
  SELECT 'merged-' || left(sha1(array_to_string(ids, '|')), 16) AS unit_id, chat_uuid, "user", chat_title, start_ts, end_ts,
    start_ts AS timestamp, n_messages, text, modeling_text, length(text)::INTEGER AS text_len_chars,
    len(string_split_regex(text, '[ \\n]'))::INTEGER AS text_len_words, {words("modeling_text")} AS modeling_len_tokens,
    date, week, month, {", ".join(registry)}, ids[1] AS first_row, ids
  FROM merged
)"""


def top_keywords_cte(source: str, text: str, order: str, n: int = 10) -> str:
    return f"""kw_tokens AS (
  SELECT topic_id, {order} AS ord, unnest({keywords(text)}) AS keyword, generate_subscripts({keywords(text)}, 1) AS pos
  FROM {source}
), kw_counts AS (
  SELECT topic_id, keyword, count(*) AS n, min({{'ord': ord, 'pos': pos}}) AS seen FROM kw_tokens GROUP BY ALL
), kw_ranked AS (
  SELECT topic_id, keyword, n, row_number() OVER (PARTITION BY topic_id ORDER BY n DESC, seen)::INTEGER AS rank FROM kw_counts
  QUALIFY rank <= {n}
), kw_lists AS (
  SELECT topic_id, list(keyword ORDER BY rank) AS kws FROM kw_ranked GROUP BY topic_id
)"""


def topics_cte() -> str:
    return f"""{units_cte()}, labelled AS (SELECT *, {label_sql()} AS label FROM units),
label_ids AS (SELECT label, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS topic_id FROM (SELECT DISTINCT label FROM labelled)),
placed AS (SELECT * FROM labelled JOIN label_ids USING (label))"""


SHARES = ", ".join(f"avg({flag}::INT)::DOUBLE AS {share}" for flag, share in fixed.FLAG_SHARES.items())
ROUNDED_SHARES = ", ".join(f"round({share}, 6) AS {share}" for share in fixed.FLAG_SHARES.values())


def summary_cte() -> str:
    return f"""{topics_cte()}, {top_keywords_cte("placed", "modeling_text", "first_row")}, summary AS (
  SELECT p.topic_id, array_to_string(any_value(k.kws)[1:3], ', ') AS topic_title_auto,
    array_to_string(any_value(k.kws), ', ') AS topic_keywords, count(*) AS n_units, count(DISTINCT "user") AS n_users,
    count(DISTINCT chat_uuid) AS n_chats, count(*) / (SELECT count(*) FROM placed) AS share_of_total,
    avg(text_len_chars) AS avg_len_chars, {SHARES}
  FROM placed p JOIN kw_lists k USING (topic_id) GROUP BY p.topic_id
), trends AS (
  SELECT week, topic_id, count(*) AS n_units FROM placed GROUP BY ALL
)"""


def hash_cte(source: str, key: str, text: str, width: int = 64) -> str:
    """(key, pos, x): feature-hash vectors in long form, float32 like the stored ones."""
    return f"""hash_tokens AS (
  SELECT {key}, unnest(string_split({clean(f"lower({text})")}, ' ')) AS token FROM {source}
), hash_buckets AS (
  SELECT {key}, ('0x' || left(sha1(token), 8))::BIGINT % {width} AS bucket,
    sum(CASE WHEN ('0x' || right(sha1(token), 1))::BIGINT % 2 = 0 THEN 1 ELSE -1 END) AS s
  FROM hash_tokens WHERE token <> '' GROUP BY ALL
), hash_norms AS (
  SELECT k.{key}, coalesce(sqrt(sum(s * s)), 0)::FLOAT AS norm
  FROM {source} k LEFT JOIN hash_buckets USING ({key}) GROUP BY ALL
), hash_vectors AS (
  SELECT n.{key}, pos, CASE WHEN norm = 0 THEN (CASE WHEN pos = 0 THEN 1 ELSE 0 END)::FLOAT
                          ELSE coalesce(s, 0)::FLOAT / norm END AS x
  FROM hash_norms n CROSS JOIN range({width}) r(pos) LEFT JOIN hash_buckets b ON b.{key} = n.{key} AND b.bucket = pos
)"""


def vector_topics_cte(outlier: int | None = None) -> str:
    topic = "label" if outlier is None else f"CASE WHEN label = {outlier} THEN -1 ELSE label END"
    return f"""vectors AS (
  SELECT vec_id AS unit_id, ({topic})::INTEGER AS topic_id, embedding FROM embeddings
), long AS (
  SELECT unit_id, topic_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM vectors
), centroids AS (
  SELECT topic_id, pos, avg(x) AS c FROM long GROUP BY ALL
)"""


NEAREST = """scores AS (
  SELECT l.unit_id, c.topic_id, sum(x * c) / greatest(sqrt(sum(x * x)) * greatest(sqrt(sum(c * c)), 1e-12), 1e-12) AS similarity
  FROM long l JOIN centroids c USING (pos) WHERE l.topic_id = -1 AND c.topic_id <> -1 GROUP BY ALL
), best AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY similarity DESC, topic_id) = 1
)"""


def terms_cte(low: int, high: int, outlier_source: str | None = None) -> str:
    topic = "ascii(lang) * 1000 + ascii(substr(lang, 2, 1))"
    if outlier_source:
        topic = f"CASE WHEN source = '{outlier_source}' THEN -1 ELSE {topic} END"
    grams = " UNION ALL ".join(
        f"SELECT unit_id, topic_id, array_to_string(w[i:i + {n - 1}], ' ') AS term "
        f"FROM worded, unnest(range(1, len(w) - {n - 2})) g(i)"
        for n in range(low, high + 1)
    )
    return f"""docs AS (
  SELECT doc_id AS unit_id, ({topic})::INTEGER AS topic_id, text FROM documents
), worded AS (
  SELECT unit_id, topic_id, regexp_extract_all(lower(text), '{WORD}+') AS w FROM docs
), grams AS ({grams}), counts AS (SELECT topic_id, term, count(*) AS tf FROM grams GROUP BY ALL)"""


def weights_cte(min_share: float) -> str:
    return f"""known AS (
  SELECT *, sum(tf) OVER (PARTITION BY term) AS f, count(*) OVER (PARTITION BY term) AS df FROM counts
), vocabulary AS (
  SELECT * FROM known WHERE df >= {min_share} * (SELECT count(DISTINCT topic_id) FROM counts)
), weights AS (
  SELECT topic_id, term, tf,
    tf * ln(1.0::DOUBLE + (SELECT floor(sum(tf) / (SELECT count(DISTINCT topic_id) FROM counts)) FROM vocabulary) / f::DOUBLE) AS weight
  FROM vocabulary
)"""


def dates(column: str) -> str:
    return f"""strftime({column}, '%Y-%m-%d') AS date, strftime({column}, '%G-W%V') AS week, strftime({column}, '%Y-%m') AS month"""


RAW = """named AS (
  SELECT conv_id * 1000 + turn AS source_row_id,
    TIMESTAMP '2024-01-01' + to_days(conv_id::INT) + to_hours(turn) + to_minutes(5) AS stamp,
    text LIKE '%aux%' AND turn = 3 AS bad_time,
    CASE WHEN turn = 5 THEN '' ELSE 'u' || (conv_id % 17) END AS "user",
    CASE WHEN role = 'system' AND turn = 0 AND conv_id % 2 = 0 THEN '' ELSE conv_id::VARCHAR END AS chat_uuid,
    CASE WHEN turn = 2 THEN '' ELSE ' conv ' || conv_id END AS chat_title,
    role, CASE WHEN role = 'system' THEN '' ELSE text END AS message
  FROM conversations
), canonical AS (
  SELECT source_row_id, CASE WHEN bad_time THEN NULL ELSE stamp END AS timestamp, "user", chat_uuid, chat_title, role, message
  FROM named
)"""
