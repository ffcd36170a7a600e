"""SQL twins of the named queries, in DuckDB's dialect.

They are written from the definitions, not from the Spark plans: row numbers over whole tables
where Spark places cuts, row-level quantiles where Spark reads histograms, the stemmer's regions
as positions where Spark tests prefixes.
"""

from __future__ import annotations

from textlake.functions import labels as L
from textlake.functions import stemming as P
from textlake.functions import text as T
from textlake.functions import unicode as U
from textlake.functions.stopwords import ENGLISH
from textlake.operators.features import STYLE_FEATURES
from textlake.plans.corpus import TURN_LABELS

ORACLE_SQL: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "(" + ", ".join(_text(value) for value in values) + ")"


STOP = _list(ENGLISH)

# RE2 knows ASCII blanks only, so the blanks of Unicode are listed.
_BLANK = (
    r" \t-\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
BLANKS, TOKEN = f"[{_BLANK}]+", f"[^{_BLANK}]+"
URL = T.URL.replace(r"\S+", TOKEN)


def _replace(text: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({text}, {_text(pattern)}, {_text(replacement)}, 'g')"


def _folded(text: str) -> str:
    text = f"translate({text}, {_text(''.join(U.FOLDS))}, {_text(''.join(U.FOLDS.values()))})"
    for letter, plain in U.LIGATURES.items():
        text = f"replace({text}, '{letter}', '{plain}')"
    return text


_EMAIL = r"[\w.+]+@\w[\w.]*\.[A-Za-z]{2,}"


def _emails(text: str) -> str:
    return _replace(text, _EMAIL, T.EMAIL_TOKEN)


def _numbers(text: str) -> str:
    return _replace(text, T.NUMBER, r"\1" + T.NUMBER_TOKEN)


def _dashes(text: str) -> str:
    return f"replace(replace({text}, '-', ' '), '/', ' ')"


def _squeezed(text: str) -> str:
    return f"trim({_replace(text, BLANKS, ' ')})"


def _normalized(text: str) -> str:
    step = _replace(_folded(f"coalesce({text}, '')"), URL, T.URL_TOKEN)
    step = _dashes(_replace(step, T.DATE, T.DATE_TOKEN))
    step = _replace(_numbers(_emails(step)), r"\p{P}", "")
    return _squeezed(f"lower({step})")


def _tokens(text: str) -> str:
    return f"list_filter(string_split({_squeezed(text)}, ' '), lambda w: w <> '')"


def _normal_tokens(text: str) -> str:
    return f"list_filter(string_split({_normalized(text)}, ' '), lambda w: w <> '')"


def _without_stops(words: str) -> str:
    return f"list_filter({words}, lambda w: w NOT IN {STOP})"


def _matches(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, {_text(pattern)}))::INTEGER"


def _as_ascii_word(text: str) -> str:
    """Letters and non-decimal numbers as 'x', so that ASCII word bounds see them as words."""
    return _replace(text, r"[\p{L}\p{No}\p{Nl}]", "x")


def _step(key: str, table: str, id_column: str, expression: str) -> None:
    ORACLE_SQL[key] = f"SELECT {id_column}, {expression} AS result FROM {table}"


PAGE = "(SELECT page_id, url || ' ' || html AS text FROM pages)"
LABELLED = """(SELECT d.doc_id AS id, d.text AS content, d.source AS domain, d.n_chars,
  1 - l.quality AS type FROM documents d LEFT JOIN labels l USING (doc_id))"""
TS_FORMAT = "'%Y-%m-%d %H:%M:%S.%f'"
RAW_DATE = """CASE event_type
  WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
  WHEN 'signup' THEN strftime(ts, '%Y-%m-%d %H:%M:%SZ')
  WHEN 'purchase' THEN strftime(ts, '%Y/%m/%d %H:%M')
  WHEN 'click' THEN strftime(ts, '%b %-d, %Y')
  ELSE 'not-a-date' END"""
PARSED_DATE = """CASE event_type WHEN 'view' THEN ts WHEN 'signup' THEN date_trunc('second', ts)
  WHEN 'purchase' THEN date_trunc('minute', ts)
  WHEN 'click' THEN date_trunc('day', ts)::TIMESTAMP END"""
ARTICLES = f"""(SELECT d.doc_id::VARCHAR AS "Unnamed: 0", d.doc_id::VARCHAR AS id,
  nullif(source, 'src7') AS domain,
  CASE WHEN quality = 1 AND toxic = 0 THEN 'reliable' WHEN quality = 1 THEN 'political'
       WHEN toxic = 0 THEN 'unreliable' WHEN toxic = 1 THEN 'hate' END AS type,
  text AS content, raw AS scraped_at, raw AS inserted_at, raw AS updated_at,
  nullif(regexp_extract(text, '^[^\\n.]*'), '') AS title,
  CASE WHEN lang <> 'en' THEN 'author ' || lang END AS authors,
  NULL::VARCHAR AS keywords, CASE WHEN toxic = 1 THEN lang END AS tags,
  NULL::VARCHAR AS summary, parsed
  FROM documents d LEFT JOIN labels l USING (doc_id)
  LEFT JOIN (SELECT event_id AS doc_id, {RAW_DATE} AS raw, {PARSED_DATE} AS parsed
             FROM events) e USING (doc_id))"""
ARTICLE_COLUMNS = [
    "Unnamed: 0", "id", "domain", "type", "content", "scraped_at", "inserted_at", "updated_at",
    "title", "authors", "keywords", "tags", "summary",
]
COMPLETE = "type IS NOT NULL AND content IS NOT NULL AND domain IS NOT NULL AND id IS NOT NULL"
TYPE_CODE = "CASE WHEN type IN ('reliable', 'political') THEN 0 ELSE 1 END"
STATEMENTS = f"""(SELECT conv_id || '-' || turn AS id,
  ([{', '.join(_text(x) if x else 'NULL' for x in TURN_LABELS)}])[
    ((conv_id + turn) % {len(TURN_LABELS)}) + 1] AS label,
  text AS statement FROM conversations)"""


# --- sources and sinks ---------------------------------------------------------------------

ORACLE_SQL["scan_pruned_limit"] = (
    "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 200")
ORACLE_SQL["csv_round_trip"] = (
    "SELECT doc_id::VARCHAR AS id, text AS content, source AS domain FROM documents")
ORACLE_SQL["csv_skip_bad_lines"] = (
    "SELECT event_id::VARCHAR AS event_id, event_type FROM events "
    "WHERE event_type NOT IN ('error', 'click')")
ORACLE_SQL["csv_folder_layouts"] = """SELECT doc_id::VARCHAR AS id,
  CASE WHEN doc_id % 3 <> 1 THEN text END AS content, source AS domain,
  CASE WHEN doc_id % 3 > 0 THEN lang END AS language FROM documents"""
ORACLE_SQL["csv_parallel_scan"] = r"""SELECT doc_id::VARCHAR AS id,
  text || chr(10) || '"' || source || '", ' || chr(9) || '"" ' || chr(13) || chr(10) || chr(10)
    AS content, source AS domain FROM documents"""
ORACLE_SQL["csv_two_layouts"] = ORACLE_SQL["csv_round_trip"]
ORACLE_SQL["tsv_statements"] = (
    f"SELECT id, label, statement FROM {STATEMENTS}")
ORACLE_SQL["tsv_parallel_scan"] = (
    "SELECT id, label, statement || chr(9) || '\"' || chr(10) AS statement "
    f"FROM {STATEMENTS}")

# --- splits and samples --------------------------------------------------------------------------


def _remainder_shares(total: str, sizes: str, label: str = "label", n: str = "n") -> str:
    """``label, share``: the total shared over classes by largest remainder."""
    return f"""SELECT {label},
      (t * {n}) // a + CASE WHEN row_number() OVER (ORDER BY (t * {n}) % a DESC, {label})
        <= t - sum((t * {n}) // a) OVER () THEN 1 ELSE 0 END AS share
      FROM (SELECT {label}, {n}, ({total})::BIGINT AS t, (sum({n}) OVER ())::BIGINT AS a
            FROM {sizes})"""


def _stratified(rows: str, label: str, id_column: str) -> str:
    """CTEs ending in ``assigned``: the rows with their split."""
    return f"""ranked AS (
      SELECT *, row_number() OVER (
        PARTITION BY {label} ORDER BY md5('42:' || {id_column}), {id_column}) AS place
      FROM {rows}),
    sizes AS (SELECT {label} AS label, count(*) AS n, sum(count(*)) OVER () AS everything
              FROM {rows} GROUP BY {label}),
    held AS (SELECT any_value(everything) AS everything,
                    (any_value(everything)::BIGINT * 2 + 9) // 10 AS m FROM sizes),
    train AS ({_remainder_shares('(SELECT everything - m FROM held)', 'sizes')}),
    rest AS (SELECT label, n - share AS n FROM sizes JOIN train USING (label)),
    val AS ({_remainder_shares('(SELECT m - (m + 1) // 2 FROM held)', 'rest')}),
    assigned AS (
      SELECT r.* EXCLUDE (place), CASE WHEN place <= t.share THEN 'train'
             WHEN place <= t.share + v.share THEN 'val' ELSE 'test' END AS split
      FROM ranked r JOIN train t ON r.{label} = t.label JOIN val v ON r.{label} = v.label)"""


def _sequential(order: str) -> str:
    return f"""CASE WHEN row_number() OVER (ORDER BY {order})
        <= floor(count(*) OVER () * 0.8::DOUBLE) THEN 'train'
      WHEN row_number() OVER (ORDER BY {order})
        <= floor(count(*) OVER () * 0.8::DOUBLE) + floor(count(*) OVER () * 0.1::DOUBLE)
        THEN 'val' ELSE 'test' END"""


ORACLE_SQL["split_files"] = f"""WITH {_stratified('orders', 'o_orderstatus', 'o_orderkey')}
  SELECT split, o_orderstatus, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum
  FROM assigned GROUP BY ALL"""
ORACLE_SQL["chrono_order"] = (
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM events")
ORACLE_SQL["random_split"] = (
    f"SELECT doc_id, {_sequential('md5(concat(42, chr(58), doc_id)), doc_id')} AS split "
    "FROM documents")
_CHRONO = (
    f"SELECT o_orderkey, {_sequential('o_orderdate, o_orderkey')} AS split FROM orders")
ORACLE_SQL["chronological_split"] = _CHRONO
ORACLE_SQL["split_counts"] = f"SELECT split, count(*) AS n FROM ({_CHRONO}) GROUP BY split"
ORACLE_SQL["stratified_split"] = f"""WITH {_stratified('events', 'event_type', 'event_id')}
  SELECT event_id, event_type, split FROM assigned"""
ORACLE_SQL["fit_sample"] = """SELECT doc_id, lang FROM documents
  ORDER BY md5('42:' || doc_id), doc_id LIMIT 300"""
ORACLE_SQL["cv_folds"] = """SELECT doc_id, quality,
  CASE WHEN place <= n // 3 THEN 0 WHEN place <= (2 * n) // 3 THEN 1 ELSE 2 END AS fold
  FROM (SELECT *, count(*) OVER (PARTITION BY quality) AS n, row_number() OVER (
          PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) AS place FROM labels)"""
ORACLE_SQL["bootstrap_sample"] = f"""WITH
  sizes AS (SELECT quality AS label, count(*) AS n FROM labels GROUP BY quality),
  quotas AS ({_remainder_shares('1500', 'sizes')}),
  draws AS (SELECT label, j AS draw,
      ('0x' || substring(md5('42:' || label || ':' || j), 1, 15))::BIGINT % n AS place
    FROM (SELECT label, n, unnest(range(share::BIGINT)) AS j
          FROM quotas JOIN sizes USING (label))),
  ranked AS (SELECT doc_id, quality, row_number() OVER (
      PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) - 1 AS place FROM labels)
  SELECT doc_id, quality, draw FROM ranked r
  JOIN draws d ON r.quality = d.label AND r.place = d.place"""

# --- cleaning -----------------------------------------------------------------------------------------


def _null_counts(columns: list[str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {_text(name)} AS column_name{extra}, "
        f"(count(*) - count(\"{name}\"))::BIGINT AS nulls FROM {ARTICLES}" for name in columns)


ORACLE_SQL["drop_all_null_cols"] = _null_counts(
    [name for name in ARTICLE_COLUMNS if name not in ("keywords", "summary")])
ORACLE_SQL["profile_nulls"] = _null_counts(ARTICLE_COLUMNS, ", count(*) AS rows")
ORACLE_SQL["table_shape"] = (
    f"SELECT count(*) AS rows, {len(ARTICLE_COLUMNS)} AS columns, "
    f"{_text(', '.join(f'{name} string' for name in ARTICLE_COLUMNS))} AS types FROM {ARTICLES}")
ORACLE_SQL["clean_required"] = (
    f"SELECT id, type, domain, md5(content) AS content_md5 FROM {ARTICLES} WHERE {COMPLETE}")
ORACLE_SQL["clean_fill"] = (
    "SELECT id, coalesce(authors, 'unknown_author') AS authors, "
    f"coalesce(title, 'no_title') AS title FROM {ARTICLES}")
ORACLE_SQL["clean_cast"] = (
    "SELECT page_id::VARCHAR AS title, md5(html) AS md5, "
    "TRY_CAST(nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS INTEGER) AS number FROM pages")
ORACLE_SQL["parse_timestamps"] = (
    f"SELECT event_id, strftime({PARSED_DATE}, {TS_FORMAT}) AS parsed FROM events")
ORACLE_SQL["invalid_ts_count"] = (
    "SELECT count(*) FILTER (WHERE event_type = 'error') AS invalid, count(*) AS rows "
    "FROM events")
ORACLE_SQL["label_binarise"] = (
    f"SELECT id, type AS kind, {TYPE_CODE} AS type FROM {ARTICLES} WHERE type IS NOT NULL")
ORACLE_SQL["label_map_default"] = (
    f"SELECT id, label, CASE WHEN label IN {_list(L.RELIABLE_STATEMENTS)} THEN 0 ELSE 1 END "
    f"AS type FROM {STATEMENTS}")
ORACLE_SQL["label_map_strict"] = (
    f"SELECT id, label, CASE WHEN label IN {_list(L.RELIABLE_STATEMENTS)} THEN 0 ELSE 1 END "
    f"AS type FROM {STATEMENTS} WHERE label IN {_list(L.STATEMENT_CODES)}")
ORACLE_SQL["clean_summary"] = f"""SELECT count(*) AS rows_in,
  count(*) FILTER (WHERE NOT ({COMPLETE})) AS missing_required,
  count(*) FILTER (WHERE {COMPLETE} AND parsed IS NULL) AS invalid_timestamps,
  count(*) FILTER (WHERE {COMPLETE} AND parsed IS NOT NULL) AS rows_out,
  count(*) - count(*) FILTER (WHERE {COMPLETE} AND parsed IS NOT NULL) AS rows_dropped
  FROM {ARTICLES}"""
ORACLE_SQL["align_union"] = """
  SELECT doc_id AS id, md5(text) AS text_md5, source AS domain FROM documents
  UNION ALL SELECT page_id, md5(html), NULL FROM pages
  UNION ALL SELECT item_id, md5(text), NULL FROM benchmark"""
_CLEAN = f"""SELECT id, domain, {TYPE_CODE} AS type, content,
  strftime(parsed, {TS_FORMAT}) AS scraped_at, coalesce(title, 'no_title') AS title,
  coalesce(authors, 'unknown_author') AS authors, tags
  FROM {ARTICLES} WHERE {COMPLETE} AND parsed IS NOT NULL"""
ORACLE_SQL["initial_cleaning"] = f"SELECT * REPLACE (md5(content) AS content) FROM ({_CLEAN})"
ORACLE_SQL["preview_sample"] = f"""SELECT id, substring(content, 1, 500) AS preview
  FROM {LABELLED} ORDER BY md5('42:' || id), id LIMIT 3"""

# --- text scalars --------------------------------------------------------------------------------------

_step("norm_url", PAGE, "page_id", _replace("text", URL, T.URL_TOKEN))
_step("norm_date", "documents", "doc_id", _replace(_folded("text"), T.DATE, T.DATE_TOKEN))
_step("norm_dash", PAGE, "page_id", _dashes("text"))
_step("norm_ascii", "documents", "doc_id", _folded("text"))
_step("norm_email", "documents", "doc_id", _emails(_folded("text")))
_step("norm_number", "documents", "doc_id", _numbers(_folded("text")))
_step("norm_punct", "documents", "doc_id", _replace("text", r"\p{P}", ""))
_step("norm_space", PAGE, "page_id", _squeezed("lower(text)"))
_step("normalize_text", "documents", "doc_id", _normalized("text"))
_step("tokenize_ws", "documents", "doc_id", f"array_to_string({_tokens('text')}, '|')")
_step("remove_stopwords", "documents", "doc_id",
      f"array_to_string({_without_stops(_normal_tokens('text'))}, ' ')")
_MODEL_WORDS = f"regexp_extract_all(lower(text), {_text(T.MODEL_WORD)})"
_step("tokenize_words", "documents", "doc_id", f"array_to_string({_MODEL_WORDS}, '|')")
_GRAMS = """list_concat(words, list_transform(range(1, len(words)),
  lambda i: words[i] || ' ' || words[i + 1]))"""
_WORDS = f"(SELECT doc_id, {_without_stops(_MODEL_WORDS)} AS words FROM documents)"
_step("word_bigrams", _WORDS, "doc_id", f"array_to_string({_GRAMS}, '|')")
_step("count_urls", PAGE, "page_id", _matches("text", URL))
_step("count_dates", "documents", "doc_id", _matches(_as_ascii_word("text"), T.DATE))
_step("count_numbers", "documents", "doc_id", _matches(_as_ascii_word("text"), T.WHOLE_NUMBER))
_step("token_length", "documents", "doc_id", _matches("text", TOKEN))
ORACLE_SQL["normalize_columns"] = f"""SELECT page_id, md5(html) AS content_md5,
  {_normalized('html')} AS content_normalized, {_normalized('url')} AS title_normalized
  FROM pages"""
ORACLE_SQL["style_features"] = f"""SELECT id,
  round({_matches('content', r'\p{Lu}')} / (length(content) + 1), 6) AS caps_ratio,
  round((length(content) - length(replace(content, '!', ''))) / (length(content) + 1), 6)
    AS exclamation_density,
  round((length(content) - length(replace(content, '?', ''))) / (length(content) + 1), 6)
    AS question_density,
  words AS content_word_count,
  round(CASE WHEN words > 0 THEN length({_replace('content', BLANKS, '')}) / words
        ELSE 0 END, 6) AS avg_word_length,
  round(length(coalesce(title, '')) / (length(content) + 1), 6) AS title_content_ratio
  FROM (SELECT id, title, content, {_matches('content', TOKEN)} AS words
    FROM (SELECT doc_id AS id, nullif(regexp_extract(text, '^[^\\n.]*'), '') AS title,
          text AS content FROM documents))"""
assert all(name in ORACLE_SQL["style_features"] for name in STYLE_FEATURES)

# --- stemming -------------------------------------------------------------------------------------------


def _region(word: str, start: str, patterns: list[str]) -> str:
    rest = f"substring({word}, {start} + 1)"
    tests = " ".join(
        f"WHEN regexp_matches({rest}, '{p}') THEN {start} + length(regexp_extract({rest}, '{p}'))"
        for p in patterns)
    return f"CASE {tests} ELSE length({word}) END"


def _suffix_step(table: dict[str, str], region: str, conditions: dict[str, str]) -> str:
    """The longest suffix is the leftmost match of the alternation at the end of the word."""
    found = f"regexp_extract(w, '(?:{'|'.join(table)})$')"
    choices = " ".join(
        f"WHEN '{suffix}' THEN CASE WHEN length(w) - {len(suffix)} >= {region}"
        f"{' AND ' + conditions[suffix] if suffix in conditions else ''} "
        f"THEN left(w, length(w) - {len(suffix)}) || '{new}' ELSE w END"
        for suffix, new in table.items())
    return f"CASE {found} {choices} ELSE w END"


def _stems(vocabulary: str) -> str:
    """CTEs ending in ``stems(term, stem)`` for a relation with a column ``term``."""
    vowel = "[aeiouy]"
    short = P.SHORT_SYLLABLE
    plural = f"""CASE WHEN w LIKE '%sses' THEN left(w, length(w) - 2)
      WHEN w LIKE '%ied' OR w LIKE '%ies'
        THEN left(w, length(w) - CASE WHEN length(w) > 4 THEN 2 ELSE 1 END)
      WHEN w LIKE '%us' OR w LIKE '%ss' THEN w
      WHEN regexp_matches(w, '{vowel}.+s$') THEN left(w, length(w) - 1) ELSE w END"""
    ending = "regexp_extract(w, '(?:eedly|ingly|edly|eed|ing|ed)$')"
    mended = f"""CASE WHEN regexp_matches(c, '(?:at|bl|iz)$') THEN c || 'e'
      WHEN regexp_matches(c, '{P.DOUBLE}') THEN left(c, length(c) - 1)
      WHEN length(c) <= r1 AND regexp_matches(c, '{short}') THEN c || 'e' ELSE c END"""
    e_kept = "left(w, length(w) - 1)"
    last = f"""CASE WHEN w LIKE '%e' AND (length(w) - 1 >= r2 OR (length(w) - 1 >= r1
          AND NOT regexp_matches({e_kept}, '{short}'))) THEN {e_kept}
      WHEN w LIKE '%ll' AND length(w) - 1 >= r2 THEN {e_kept} ELSE w END"""
    r1_patterns = ["^(?:gener|commun|arsen)", f"^{P.REGION}"]
    special = " ".join(f"WHEN '{word}' THEN '{stem}'" for word, stem in P.SPECIAL.items())
    finished = _list(P.UNCHANGED_IN_BOTH_NUMBERS)
    step_2 = _suffix_step(P.STEP_2, "r1", {
        "ogi": "w LIKE '%logi'", "li": f"regexp_matches(w, '{P.LI_ENDING}')"})
    step_3 = _suffix_step(P.STEP_3, "r1", {"ative": "length(w) - 5 >= r2"})
    step_4 = _suffix_step(P.STEP_4, "r2", {"ion": "regexp_matches(w, '[st]ion$')"})
    return f"""
    st0 AS (SELECT term, regexp_replace(regexp_replace(
              {_replace('term', "^'|'(?:s'?)?$", '')}, '^y', 'Y'),
              '([aeiouy])y', '\\1Y', 'g') AS w FROM {vocabulary}),
    st1 AS (SELECT *, {_region('w', '0', r1_patterns)} AS r1 FROM st0),
    st2 AS (SELECT *, {_region('w', 'r1', [f'^{P.REGION}'])} AS r2 FROM st1),
    st3 AS (SELECT * REPLACE ({plural} AS w) FROM st2),
    st4 AS (SELECT *, w AS singular, {ending} AS gone,
              CASE WHEN {ending} IN ('ingly', 'edly', 'ing', 'ed')
                THEN left(w, length(w) - length({ending})) END AS c FROM st3),
    st5 AS (SELECT * REPLACE (CASE
              WHEN gone IN ('eedly', 'eed') THEN
                CASE WHEN length(w) - length(gone) >= r1
                     THEN left(w, length(w) - length(gone)) || 'ee' ELSE w END
              WHEN c IS NOT NULL AND regexp_matches(c, '{vowel}') THEN {mended}
              ELSE w END AS w) FROM st4),
    st6 AS (SELECT * REPLACE (regexp_replace(w, '(.[^aeiouy])[yY]$', '\\1i') AS w) FROM st5),
    st7 AS (SELECT * REPLACE ({step_2} AS w) FROM st6),
    st8 AS (SELECT * REPLACE ({step_3} AS w) FROM st7),
    st9 AS (SELECT * REPLACE ({step_4} AS w) FROM st8),
    st10 AS (SELECT * REPLACE ({last} AS w) FROM st9),
    stems AS (SELECT term, CASE WHEN length(term) <= 2 THEN term
              ELSE CASE term {special} ELSE CASE WHEN singular IN {finished} THEN singular
              ELSE replace(w, 'Y', 'y') END END END AS stem FROM st10)"""


def _processed(rows: str, id_column: str, words: str) -> str:
    """CTEs ending in ``processed(id, content_processed)`` from a list-of-words expression."""
    return f"""
    words AS MATERIALIZED (SELECT {id_column} AS id, {_without_stops(words)} AS words
                           FROM {rows}),
    tokens AS (SELECT id, unnest(words) AS term, generate_subscripts(words, 1) AS place
               FROM words),
    vocab AS (SELECT DISTINCT term FROM tokens),
    {_stems('vocab')},
    processed AS (
      SELECT id, coalesce(string_agg(stem, ' ' ORDER BY place), '') AS content_processed
      FROM words LEFT JOIN tokens USING (id) LEFT JOIN stems USING (term) GROUP BY id)"""


_DOCUMENT_TERMS = (
    f"tokens AS (SELECT unnest({_normal_tokens('text')}) AS term FROM documents)")


def _split_contracted(text: str) -> str:
    for first, second in (("can", "not"), ("gon", "na"), ("got", "ta"), ("gim", "me"),
                          ("lem", "me"), ("wan", "na")):
        text = _replace(text, rf"\b{first}{second}\b", f"{first} {second}")
    return text


_WORD_TOKENS = (
    "list_filter(string_split("
    + _squeezed(_replace(_split_contracted(_normalized("text")), r"([$<>+=`^~|])", r" \1 "))
    + ", ' '), lambda w: w <> '')")

ORACLE_SQL["process_text"] = f"""WITH {_processed('documents', 'doc_id', _normal_tokens('text'))}
  SELECT id AS doc_id, content_processed AS result FROM processed"""
ORACLE_SQL["process_text_words"] = f"""WITH {_processed('documents', 'doc_id', _WORD_TOKENS)}
  SELECT id AS doc_id, content_processed AS result FROM processed"""


def _treebank(text: str) -> str:
    """List of words and signs: RE2 rules of our own, in the order of the convention."""
    step = _squeezed(f"coalesce({text}, '')")
    for pattern, new in (
        (r"([«“‘„]|`+)", r" \1 "), (r'^"', " `` "), (r"([ (\[{<])(\"|'')", r"\1 `` "),
        (r"'([a-zA-Z0-9_])\b", "'\x01\\1"), ("'\x01([dmnstDMNST])", r"'\1"), ("\x01", " "),
        (r"""([^.])\.([\])}>"'»”’ ]*)$""", r"\1 . \2 "), (r"(:|,)([^0-9])", r" \1 \2"),
        (r"(:|,)$", r" \1 "), (r"(\.\.+)", r" \1 "), (r"([!#$%&*;?@])", r" \1 "),
        (r"([^'])' ", r"\1 ' "), (r"([()<>{}]|\[|\])", r" \1 "), ("--", " -- "),
    ):
        step = _replace(step, pattern, new)
    step = f"' ' || {step} || ' '"
    for pattern, new in (
        (r"(»|”|’)", r" \1 "), (r"\"|''", " '' "), ("  +", " "),
        (r"([^' ])('s|'S|'m|'M|'d|'D|') ", r"\1 \2 "),
        (r"([^' ])('(?:ll|LL|re|RE|ve|VE)|n't|N'T) ", r"\1 \2 "),
    ) + tuple(
        (rf"(?i)\b({head})({tail}){end}", r" \1 \2 ") for head, tail, end in (
            ("can", "not", r"\b"), ("d", "'ye", r"\b"), ("gim|lem", "me", r"\b"),
            ("gon", "na", r"\b"), ("got", "ta", r"\b"), ("more", "'n", r"\b"), ("wan", "na", " "))
    ) + ((r"(?i) ('t)(is|was)\b", r" \1 \2 "),):
        step = _replace(step, pattern, new)
    return f"list_filter(string_split({step}, ' '), lambda w: w <> '')"


ORACLE_SQL["treebank_words"] = (
    f"SELECT doc_id, array_to_string({_treebank('text')}, ' ') AS result FROM documents")
ORACLE_SQL["process_raw_words"] = f"""WITH
  {_processed('documents', 'doc_id', _treebank('lower(text)'))}
  SELECT id AS doc_id, content_processed AS result FROM processed"""
ORACLE_SQL["process_statements"] = f"""WITH
  {_processed(STATEMENTS, 'id', _normal_tokens('statement'))}
  SELECT id, content_processed FROM processed"""

# --- vocabulary and profile -----------------------------------------------------------------------------

ORACLE_SQL["stem_vocabulary"] = f"""WITH {_DOCUMENT_TERMS},
  vocab AS (SELECT term, count(*) AS n FROM tokens WHERE term NOT IN {STOP} GROUP BY term),
  {_stems('vocab')}
  SELECT term, n, stem FROM vocab JOIN stems USING (term)"""
_STAGES = f"""WITH {_DOCUMENT_TERMS},
  raw AS (SELECT DISTINCT term FROM tokens),
  no_stop AS (SELECT term FROM raw WHERE term NOT IN {STOP}),
  {_stems('no_stop')}"""
ORACLE_SQL["staged_vocabulary"] = f"""{_STAGES}
  SELECT 'raw' AS stage, term FROM raw UNION ALL SELECT 'no_stop', term FROM no_stop
  UNION ALL SELECT DISTINCT 'stemmed', stem FROM stems"""
_SIZES = """SELECT (SELECT count(*) FROM raw) AS raw, (SELECT count(*) FROM no_stop) AS no_stop,
  (SELECT count(DISTINCT stem) FROM stems) AS stemmed"""
ORACLE_SQL["vocabulary_sizes"] = f"{_STAGES} {_SIZES}"
ORACLE_SQL["vocabulary_reduction"] = f"""{_STAGES}
  SELECT *, round((raw - no_stop) * 100 / raw, 6) AS stop_reduction,
    round((no_stop - stemmed) * 100 / no_stop, 6) AS stem_reduction,
    round((raw - stemmed) * 100 / raw, 6) AS total_reduction FROM ({_SIZES})"""
ORACLE_SQL["label_distribution"] = f"""SELECT type, count(*) AS n,
  round(count(*) * 100 / sum(count(*)) OVER (), 6) AS percent FROM {LABELLED} GROUP BY type"""
_SIZED = f"""(SELECT type, {_matches('content', TOKEN)} AS v FROM {LABELLED}
  WHERE type IS NOT NULL)"""
ORACLE_SQL["length_stats"] = f"""SELECT type, count(*) AS n, round(avg(v), 6) AS mean,
  round(median(v), 6) AS median, round(quantile_cont(v, 0.95), 6) AS p95, max(v) AS maximum
  FROM {_SIZED} GROUP BY type"""
ORACLE_SQL["length_histogram"] = f"""WITH sized AS {_SIZED},
  limits AS (SELECT type, min(v)::DOUBLE AS lo, quantile_cont(v, 0.99) AS hi
             FROM sized GROUP BY type),
  placed AS (SELECT type, lo, hi, CASE WHEN hi > lo THEN least(49, floor(
      (least(v, hi) - lo) / ((hi - lo) / 50))) ELSE 0 END::INTEGER AS bin
    FROM sized JOIN limits USING (type))
  SELECT type, bin, round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 50, 6)
    AS bin_start, count(*) AS n FROM placed GROUP BY type, bin"""
ORACLE_SQL["top_sources"] = f"""SELECT type, domain, n, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY type ORDER BY n DESC, domain)::INTEGER AS rank FROM (
    SELECT type, coalesce(nullif(domain, 'src7'), 'missing') AS domain, count(*) AS n
    FROM {LABELLED} WHERE type IS NOT NULL GROUP BY ALL)) WHERE rank <= 10"""
ORACLE_SQL["top_words"] = f"""WITH {_DOCUMENT_TERMS}
  SELECT term, count(*) AS n FROM tokens GROUP BY term ORDER BY n DESC, term LIMIT 100"""
ORACLE_SQL["heavy_words"] = ORACLE_SQL["top_words"]
_ALL_TEXTS = """(SELECT text FROM documents UNION ALL SELECT text FROM conversations
  UNION ALL SELECT text FROM benchmark)"""
ORACLE_SQL["vocabulary_estimates"] = f"""WITH terms AS (
    SELECT DISTINCT unnest({_normal_tokens('text')}) AS term FROM {_ALL_TEXTS})
  SELECT 'raw' AS stage, count(*) AS n, true AS within FROM terms
  UNION ALL SELECT 'no_stop', count(*), true FROM terms WHERE term NOT IN {STOP}"""
ORACLE_SQL["style_quantiles"] = f"""SELECT feature, share::DOUBLE AS share,
  (SELECT count(*) FROM documents) AS n, true AS within
  FROM (SELECT unnest([{', '.join(_text(f) for f in STYLE_FEATURES)}]) AS feature),
       (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95]) AS share)"""
ORACLE_SQL["top_words_processed"] = f"""WITH
  {_processed('documents', 'doc_id', _normal_tokens('text'))},
  stemmed AS (SELECT unnest(string_split(content_processed, ' ')) AS term FROM processed)
  SELECT term, count(*) AS n FROM stemmed WHERE term <> ''
  GROUP BY term ORDER BY n DESC, term LIMIT 100"""
ORACLE_SQL["rank_frequency"] = f"""WITH {_DOCUMENT_TERMS}
  SELECT row_number() OVER (ORDER BY n DESC, term)::INTEGER AS rank, term, n FROM (
    SELECT term, count(*) AS n FROM tokens GROUP BY term ORDER BY n DESC, term LIMIT 10000)"""
_ARTEFACTS = f"""(SELECT type, {_matches('content', URL)} AS url_count,
  {_matches(_as_ascii_word('content'), T.DATE)} AS date_count,
  {_matches(_as_ascii_word('content'), T.WHOLE_NUMBER)} AS number_count FROM {LABELLED})"""
_LONG = f"""(SELECT type, feature, value FROM {_ARTEFACTS}
  UNPIVOT (value FOR feature IN (url_count, date_count, number_count)))"""
ORACLE_SQL["artefact_stats"] = f"""SELECT feature, sum(value)::BIGINT AS total,
  round(avg(value), 6) AS mean, round(median(value), 6) AS median,
  round(quantile_cont(value, 0.95), 6) AS p95 FROM {_LONG} GROUP BY feature"""
ORACLE_SQL["artefact_by_label"] = f"""SELECT type, feature, round(avg(value), 6) AS mean,
  round(median(value), 6) AS median FROM {_LONG} WHERE type IS NOT NULL GROUP BY type, feature"""
ORACLE_SQL["class_ratio"] = f"""SELECT count(*) FILTER (WHERE type = 0) AS negatives,
  count(*) FILTER (WHERE type = 1) AS positives, round(count(*) FILTER (WHERE type = 0)
  / count(*) FILTER (WHERE type = 1), 6) AS ratio FROM {LABELLED}"""
ORACLE_SQL["class_weights"] = f"""SELECT type, count(*) AS n,
  round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
  FROM {LABELLED} WHERE type IS NOT NULL GROUP BY type"""

# --- evaluation -----------------------------------------------------------------------------------------

_RULE = """(SELECT 1 - quality AS label, CASE WHEN n_chars < 400 THEN 1 ELSE 0 END AS prediction
  FROM documents JOIN labels USING (doc_id))"""
ORACLE_SQL["confusion_matrix"] = f"""SELECT a.c AS label, b.c AS prediction,
  (SELECT count(*) FROM {_RULE} r WHERE r.label = a.c AND r.prediction = b.c) AS n
  FROM (VALUES (0), (1)) a(c), (VALUES (0), (1)) b(c)"""
_SCORES = f"""WITH predicted AS {_RULE}, scores AS (
  SELECT c, precision_, recall_, CASE WHEN precision_ + recall_ > 0
      THEN 2 * precision_ * recall_ / (precision_ + recall_) ELSE 0 END AS f1, support
  FROM (SELECT c, support,
      CASE WHEN chosen > 0 THEN hits / chosen ELSE 0 END AS precision_,
      CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall_
    FROM (SELECT c, count(*) FILTER (WHERE label = c AND prediction = c) AS hits,
        count(*) FILTER (WHERE label = c) AS support,
        count(*) FILTER (WHERE prediction = c) AS chosen
      FROM predicted, (VALUES (0), (1)) classes(c) GROUP BY c)))"""
ORACLE_SQL["classification_report"] = f"""{_SCORES}
  SELECT CASE c WHEN 0 THEN 'reliable' ELSE 'fake' END AS class,
    round(precision_, 6) AS precision, round(recall_, 6) AS recall, round(f1, 6) AS f1, support
  FROM scores
  UNION ALL SELECT 'macro avg', round(avg(precision_), 6), round(avg(recall_), 6),
    round(avg(f1), 6), sum(support)::BIGINT FROM scores
  UNION ALL SELECT 'weighted avg', round(sum(precision_ * support) / sum(support), 6),
    round(sum(recall_ * support) / sum(support), 6),
    round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM scores"""
ORACLE_SQL["f1_scores"] = f"""{_SCORES} SELECT round(avg(f1), 6) AS macro_f1,
  round(max(f1) FILTER (WHERE c = 1), 6) AS binary_f1 FROM scores"""
ORACLE_SQL["accuracy"] = f"""SELECT round(avg(CASE WHEN label = prediction THEN 1 ELSE 0 END), 6)
  AS accuracy FROM {_RULE}"""

# --- set operations and chunks --------------------------------------------------------------------------

ORACLE_SQL["union_all"] = """SELECT md5(text) AS text_md5, count(*) AS copies FROM (
  SELECT text FROM documents UNION ALL SELECT text FROM benchmark
  UNION ALL SELECT text FROM conversations) GROUP BY ALL"""
ORACLE_SQL["union_distinct"] = f"""
  SELECT unnest({_normal_tokens('text')}) AS term FROM benchmark
  UNION SELECT unnest({_normal_tokens('text')}) FROM conversations"""
ORACLE_SQL["map_chunks"] = "SELECT event_id, user_id * 2 AS user_id FROM events"
ORACLE_SQL["map_chunks_with_terms"] = f"""SELECT DISTINCT role AS name, unnest(words) AS term
  FROM (SELECT role, {_normal_tokens('text')} AS words FROM conversations)"""

# --- features -------------------------------------------------------------------------------------------

ORACLE_SQL["metadata_features"] = f"""SELECT id, url_count, number_count, article_length FROM
  (SELECT id, {_matches('content', URL)} AS url_count,
    {_matches(_as_ascii_word('content'), T.WHOLE_NUMBER)} AS number_count,
    len({_without_stops(_normal_tokens('content'))})::INTEGER AS article_length FROM {LABELLED})"""


def _bow(k: int) -> str:
    return f"""words AS (SELECT doc_id, {_MODEL_WORDS} AS words FROM documents),
  tokens AS (SELECT doc_id, unnest(words) AS term FROM words),
  vocab AS (SELECT term, count(*) AS tf FROM tokens GROUP BY term
            ORDER BY tf DESC, term LIMIT {k})"""


ORACLE_SQL["bow_vocabulary"] = f"WITH {_bow(10_000)} SELECT term, tf FROM vocab"
ORACLE_SQL["bow_counts"] = f"""WITH {_bow(10_000)}
  SELECT doc_id, term, count(*) AS n FROM tokens JOIN vocab USING (term) GROUP BY doc_id, term"""
ORACLE_SQL["assemble_features"] = f"""WITH {_bow(10_000)},
  counted AS (SELECT doc_id, count(*) AS n FROM tokens JOIN vocab USING (term) GROUP BY doc_id)
  SELECT doc_id, ((SELECT count(*) FROM vocab) + 3)::INTEGER AS width, (coalesce(n, 0) + {_matches('text', URL)}
    + {_matches(_as_ascii_word('text'), T.WHOLE_NUMBER)} + {_matches('text', TOKEN)})::BIGINT
    AS total FROM documents LEFT JOIN counted USING (doc_id)"""
_TFIDF = f"""WITH grams AS (SELECT doc_id, unnest({_GRAMS}) AS term FROM {_WORDS}),
  counts AS (SELECT doc_id, term, count(*) AS n FROM grams GROUP BY doc_id, term),
  vocab AS (SELECT term, sum(n)::BIGINT AS tf, count(*) AS df FROM counts GROUP BY term
    HAVING count(*) >= 10 AND count(*) <= 0.9 * (SELECT count(*) FROM documents)
    ORDER BY tf DESC, term LIMIT 1500),
  weighed AS (SELECT *, ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf
              FROM vocab)"""
ORACLE_SQL["tfidf_vocabulary"] = f"""{_TFIDF}
  SELECT term, tf, df, round(idf, 6) AS idf FROM weighed"""
ORACLE_SQL["tfidf_weights"] = f"""{_TFIDF}
  SELECT doc_id, term, round(n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY doc_id)), 6)
    AS weight FROM counts JOIN weighed USING (term)"""

# --- jobs and streams -----------------------------------------------------------------------------------

ORACLE_SQL["clean_and_split_job"] = f"""WITH cleaned AS ({_CLEAN}),
  {_processed('cleaned', 'id', _normal_tokens('content'))},
  {_stratified('cleaned', 'type', 'id')}
  SELECT id, type, content_processed, split FROM assigned JOIN processed USING (id)"""
ORACLE_SQL["corpus_report"] = f"""WITH
  {_processed('documents', 'doc_id', _normal_tokens('text'))},
  sized AS (SELECT type, len(string_split(nullif(content_processed, ''), ' ')) AS v
            FROM processed JOIN {LABELLED} USING (id)),
  labelled AS (SELECT type, coalesce(v, 0) AS v FROM sized WHERE type IS NOT NULL),
  limits AS (SELECT type, min(v) AS lo, quantile_cont(v, 0.99) AS hi FROM labelled GROUP BY type),
  bins AS (SELECT DISTINCT type, CASE WHEN hi > lo THEN
             least(49, floor((least(v, hi) - lo) / ((hi - lo) / 50))) ELSE 0 END AS bin
           FROM labelled JOIN limits USING (type)),
  stemmed AS (SELECT count(DISTINCT term) AS n FROM (
    SELECT unnest(string_split(content_processed, ' ')) AS term FROM processed) WHERE term <> ''),
  raw AS (SELECT count(DISTINCT term) AS n FROM (
    SELECT unnest({_normal_tokens('text')}) AS term FROM documents)),
  sources AS (SELECT type, least(10, count(DISTINCT domain)) AS n FROM {LABELLED}
              WHERE type IS NOT NULL GROUP BY type)
  SELECT 'label_distribution' AS name, count(*) AS n FROM (SELECT DISTINCT type FROM {LABELLED})
  UNION ALL SELECT 'length_stats', count(DISTINCT type) FROM labelled
  UNION ALL SELECT 'length_histogram', count(*) FROM bins
  UNION ALL SELECT 'top_sources', sum(n)::BIGINT FROM sources
  UNION ALL SELECT 'top_words_normalized', least(100, n) FROM raw
  UNION ALL SELECT 'top_words_processed', least(100, n) FROM stemmed
  UNION ALL SELECT 'rank_frequency', least(10000, n) FROM stemmed
  UNION ALL SELECT 'artefact_stats', 3
  UNION ALL SELECT 'artefact_by_label', 3 * count(DISTINCT type) FROM labelled"""


def _measures(name: str, keys: str, table: str, *measures: str) -> str:
    """A table of the report in long form: keys joined by bars, one row per measure."""
    row = ", ".join(f"coalesce({key}::VARCHAR, 'null')" for key in keys.split())
    return f"""SELECT '{name}' AS name, concat_ws('|', {row}) AS "row",
      unnest({list(measures)}) AS measure,
      unnest([{', '.join(f'round({m}::DOUBLE, 6)' for m in measures)}]) AS value FROM {table}"""


ORACLE_SQL["corpus_report_values"] = f"""WITH
  {_processed('documents', 'doc_id', _normal_tokens('text'))},
  sized AS (SELECT type, coalesce(len(string_split(nullif(content_processed, ''), ' ')), 0) AS v
            FROM processed JOIN {LABELLED} USING (id) WHERE type IS NOT NULL),
  lengths AS (SELECT type, count(*) AS n, avg(v) AS mean, median(v) AS median,
                quantile_cont(v, 0.95) AS p95, max(v) AS maximum FROM sized GROUP BY type),
  limits AS (SELECT type, min(v)::DOUBLE AS lo, quantile_cont(v, 0.99) AS hi
             FROM sized GROUP BY type),
  placed AS (SELECT type, lo, hi, CASE WHEN hi > lo THEN least(49, floor(
      (least(v, hi) - lo) / ((hi - lo) / 50))) ELSE 0 END::INTEGER AS bin
    FROM sized JOIN limits USING (type)),
  bins AS (SELECT type, bin, count(*) AS n,
             any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 50 AS bin_start
           FROM placed GROUP BY type, bin),
  sources AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY n DESC, domain) AS rank FROM (
    SELECT type, coalesce(domain, 'missing') AS domain, count(*) AS n
    FROM {LABELLED} WHERE type IS NOT NULL GROUP BY ALL)),
  normal AS (SELECT term, count(*) AS n FROM (
    SELECT unnest({_normal_tokens('text')}) AS term FROM documents)
    GROUP BY term ORDER BY n DESC, term LIMIT 100),
  ranked AS (SELECT term, n, row_number() OVER (ORDER BY n DESC, term) AS rank FROM (
    SELECT term, count(*) AS n FROM (
      SELECT unnest(string_split(content_processed, ' ')) AS term FROM processed)
    WHERE term <> '' GROUP BY term) ORDER BY rank LIMIT 10000)
  {' UNION ALL '.join((
      _measures('label_distribution', 'type', f"({ORACLE_SQL['label_distribution']})",
                'n', 'percent'),
      _measures('length_stats', 'type', 'lengths', 'n', 'mean', 'median', 'p95', 'maximum'),
      _measures('length_histogram', 'type bin', 'bins', 'bin_start', 'n'),
      _measures('top_sources', 'type domain', '(SELECT * FROM sources WHERE rank <= 10)',
                'n', 'rank'),
      _measures('top_words_normalized', 'term', 'normal', 'n'),
      _measures('top_words_processed', 'term', '(SELECT * FROM ranked WHERE rank <= 100)', 'n'),
      _measures('rank_frequency', 'term', 'ranked', 'rank', 'n'),
      _measures('artefact_stats', 'feature', f"({ORACLE_SQL['artefact_stats']})",
                'total', 'mean', 'median', 'p95'),
      _measures('artefact_by_label', 'type feature', f"({ORACLE_SQL['artefact_by_label']})",
                'mean', 'median')))}"""
ORACLE_SQL["stream_cleaning"] = f"""SELECT doc_id::VARCHAR AS id,
  CASE WHEN lang IN ('en', 'de') THEN 0 ELSE 1 END AS type, source AS domain,
  {_normalized('text')} AS content_normalized FROM documents"""
ORACLE_SQL["stream_term_counts"] = (
    f"SELECT term, count(*) AS n FROM (SELECT unnest({_normal_tokens('text')}) AS term "
    "FROM documents) GROUP BY term")
ORACLE_SQL["stream_clean_summary"] = ORACLE_SQL["clean_summary"]
ORACLE_SQL["repair_encoding"] = "SELECT doc_id, text AS result FROM documents"
ORACLE_SQL["stream_vocabulary"] = (
    f"SELECT DISTINCT unnest({_normal_tokens('text')}) AS term FROM documents")

# --- layouts, classes and split jobs ---------------------------------------------------------------------

# What is left of an instant in each layout, by number of the layout; the last is no date.
_FORM_UNITS = [
    "microsecond", "second", "minute", "second", "minute", "day", "microsecond", "minute",
    "minute", "day", "day", "second", "day", "second", "second", "day",
]
_FORMS = " ".join(
    f"WHEN {i} THEN date_trunc('{unit}', ts)::TIMESTAMP" + " - INTERVAL 2 HOUR" * (i == 14)
    for i, unit in enumerate(_FORM_UNITS))
ORACLE_SQL["parse_timestamp_forms"] = f"""SELECT event_id,
  strftime(CASE event_id % 17 {_FORMS} END, {TS_FORMAT}) AS parsed FROM events"""
_KINDS = """(SELECT coalesce(list_position(['click', 'error', 'purchase', 'signup', 'view'],
    event_type), 0)::INTEGER AS label, (user_id % 7)::INTEGER AS prediction FROM events)"""
_MANY = f"""WITH predicted AS {_KINDS},
  classes AS (SELECT label AS c FROM predicted UNION SELECT prediction FROM predicted
              UNION VALUES (0), (1))"""
ORACLE_SQL["confusion_many_classes"] = f"""{_MANY}
  SELECT a.c AS label, b.c AS prediction,
    (SELECT count(*) FROM predicted r WHERE r.label = a.c AND r.prediction = b.c) AS n
  FROM classes a, classes b"""
ORACLE_SQL["report_many_classes"] = f"""{_MANY},
  counted AS (SELECT c, count(*) FILTER (WHERE label = c AND prediction = c) AS hits,
      count(*) FILTER (WHERE label = c) AS support,
      count(*) FILTER (WHERE prediction = c) AS chosen
    FROM predicted, classes GROUP BY c),
  scores AS (SELECT c, support, CASE WHEN chosen > 0 THEN hits / chosen ELSE 0 END AS p,
      CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r,
      CASE WHEN chosen + support > 0 THEN 2 * hits / (chosen + support) ELSE 0 END AS f
    FROM counted)
  SELECT c::VARCHAR AS class, round(p, 6) AS precision, round(r, 6) AS recall,
    round(f, 6) AS f1, support FROM scores
  UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6),
    sum(support)::BIGINT FROM scores
  UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6),
    round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6),
    sum(support)::BIGINT FROM scores"""
_ORDERS = "(SELECT o_orderkey AS id, o_orderdate AS scraped_at, o_orderstatus AS type FROM orders)"
ORACLE_SQL["split_job_random"] = (
    f"SELECT id, {_sequential('md5(concat(42, chr(58), id)), id')} AS split FROM {_ORDERS}")
ORACLE_SQL["split_job_chronological"] = (
    f"SELECT id, {_sequential('scraped_at, id')} AS split FROM {_ORDERS}")
ORACLE_SQL["split_job_stratified"] = f"""WITH {_stratified(_ORDERS, 'type', 'id')}
  SELECT id, split FROM assigned"""
ORACLE_SQL["model_parts"] = f"""WITH labelled AS (
    SELECT id, type::INTEGER AS type FROM {LABELLED} WHERE type IS NOT NULL),
  {_stratified('labelled', 'type', 'id')}
  SELECT id, type, split AS part FROM assigned"""

_VALIDATION = f"(SELECT id, type FROM ({ORACLE_SQL['model_parts']}) WHERE part = 'val')"
ORACLE_SQL["tree_contributions_add_up"] = f"SELECT id, type, true AS adds_up FROM {_VALIDATION}"
ORACLE_SQL["model_facts"] = f"""SELECT model, type AS label, count(*) AS support, 0::BIGINT AS odd
  FROM {_VALIDATION}, (SELECT unnest(['logreg', 'gbt']) AS model) GROUP BY model, type"""
