"""SQL for DuckDB that gives the rows of the registered queries."""

from __future__ import annotations

from clipwire.checks import params as P

_ARTICLES = """
articles AS (
  SELECT d.doc_id, d.lang,
    CASE WHEN d.lang <> 'de' THEN d.source END AS source_id,
    d.source AS source_name,
    CASE WHEN d.n_chars >= 800 THEN concat(d.lang, ' desk') END AS author,
    split_part(d.text, chr(10), 1) AS title,
    nullif(split_part(d.text, chr(10), 2), '') AS description,
    concat('https://news.example/', d.doc_id) AS url,
    d.text AS content,
    strftime(e.ts, '%Y-%m-%dT%H:%M:%SZ') AS "publishedAt",
    CAST(e.ts AS DATE) AS published_day,
    date_trunc('second', e.ts) AS published_ts,
    e.value AS popularity
  FROM documents d JOIN events e ON d.doc_id = e.event_id
)"""

_MEMORY = """
memory AS (
  SELECT text, concat('pt: ', replace(text, 'license', 'licença')) AS text_pt
  FROM (
    SELECT title AS text FROM articles WHERE lang <> 'en'
    UNION SELECT description FROM articles WHERE lang <> 'en'
    UNION SELECT content FROM articles WHERE lang <> 'en'
  ) AS texts
  WHERE text IS NOT NULL
)"""

_TEXTS = """
texts AS (
  SELECT title AS text FROM articles WHERE title IS NOT NULL
  UNION SELECT description FROM articles WHERE description IS NOT NULL
  UNION SELECT content FROM articles
)"""

_TRANSLATED = """
translated AS (
  SELECT a.*,
    coalesce(d.text_pt, a.description) AS description_pt,
    coalesce(c.text_pt, a.content) AS content_pt,
    coalesce(t.text_pt, a.title) AS title_pt,
    d.text_pt IS NOT NULL AS description_translated,
    c.text_pt IS NOT NULL AS content_translated,
    t.text_pt IS NOT NULL AS title_translated
  FROM articles a
  LEFT JOIN memory d ON a.description = d.text
  LEFT JOIN memory c ON a.content = c.text
  LEFT JOIN memory t ON a.title = t.text
)"""

_WIRED = """
wired AS (
  SELECT source_id, source_name, author, title, description, url, "publishedAt", content,
    published_day, concat('{"lang":"', lang, '"}') AS extra, 0 AS position
  FROM articles
  UNION ALL
  SELECT 'wire', 'Wire', NULL, title, description, url, "publishedAt", content, published_day,
    NULL, 2
  FROM articles
)"""

_FIRST_DAY = "(SELECT min(published_day) FROM articles)"

_STREAMED = f"""
streamed AS (
  SELECT * FROM wired UNION ALL SELECT * FROM wired WHERE published_day = {_FIRST_DAY}
)"""

_OFFSET = """
shifted AS (
  SELECT a.* EXCLUDE ("publishedAt", published_day),
    CASE WHEN a.doc_id % 3 = 0 THEN date_trunc('day', e.ts) ELSE e.ts END AS moment
  FROM articles a JOIN events e ON a.doc_id = e.event_id
), windowed AS (
  SELECT *, CAST(moment AS DATE) AS published_day FROM shifted
  UNION ALL
  SELECT *, CAST(moment AS DATE) - 1 FROM shifted 
  WHERE date_trunc('second', moment) = date_trunc('day', moment)
), offsets AS (
  SELECT *, strftime(moment - INTERVAL 5 HOURS, '%Y-%m-%dT%H:%M:%S-05:00') AS "publishedAt" FROM windowed
)"""

_ID = 'url, author, title, "publishedAt"'
_TRANSLATED_COLUMNS = """description_pt, content_pt, title_pt,
  description_translated, content_translated, title_translated"""
_DAY = """CAST(year(published_day) AS INTEGER) AS year,
  CAST(month(published_day) AS INTEGER) AS month,
  CAST(day(published_day) AS INTEGER) AS day"""
_FROM_DATE = "CAST(published_day AS VARCHAR) AS from_date"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _latest(source: str) -> str:
    """The latest row of each author and title."""
    return f"""(
  SELECT * FROM {source}
  QUALIFY row_number() OVER (
    PARTITION BY author, title ORDER BY "publishedAt" DESC, url DESC
  ) = 1
)"""


def _match(keywords, columns=("description", "content", "title")) -> str:
    hits = [f"contains(lower({c}), '{k}')" for c in columns for k in keywords]
    return "(" + " OR ".join(hits) + ")"


def _whole_word(terms, columns) -> str:
    pattern = "|".join("\\s+".join(t.split()) for t in terms)
    edge = "[^\\p{L}\\p{N}_]"
    tests = [f"regexp_matches(lower({c}), '(^|{edge})({pattern})({edge}|$)')" for c in columns]
    return "(" + " OR ".join(tests) + ")"


# A stream inserts an article with the first day that has its key.
_FIRST_SEEN = """(
    SELECT * FROM wired
    QUALIFY published_day = min(published_day) OVER (PARTITION BY author, title)
  ) AS first_seen"""

_STOP = "(" + ", ".join(f"'{w}'" for w in P.STOPWORDS) + ")"

# Cutting at single whitespace leaves no empty tokens at the end of a text, but does
# keep one token for a text that is empty.
_ML_TOKENS = """
ml AS (
  SELECT url,
    CASE WHEN content <> '' AND regexp_full_match(content, '\\s*') THEN []
      ELSE string_split_regex(regexp_replace(lower(content), '\\s+$', ''), '\\s') END AS tokens
  FROM articles
),
visible AS (
  SELECT url, list_filter(tokens, lambda t: lower(t) NOT IN {stop}) AS tokens FROM ml
),
plain AS (
  SELECT url, list_filter(tokens, lambda t: regexp_matches(t, '^[a-zA-Z]+$')) AS tokens
  FROM visible
),
exploded AS (SELECT url, unnest(tokens) AS word FROM plain),
counts AS (SELECT word, count(*) AS count FROM exploded GROUP BY word)""".replace("{stop}", _STOP)

_SPACE_TOKENS = """
spaced AS (
  SELECT url, list_filter(string_split_regex(content, '\\s+'), lambda t: t <> '') AS tokens
  FROM articles
),
alpha AS (
  SELECT url, list_transform(
      list_filter(tokens, lambda t: regexp_matches(t, '^\\p{L}+$') AND lower(t) NOT IN {stop}),
      lambda t: lower(t)) AS tokens
  FROM spaced
),
freqs AS (
  SELECT word, count(*) AS count
  FROM (SELECT unnest(tokens) AS word FROM alpha) AS w GROUP BY word
)""".replace("{stop}", _STOP)


def _tokens(name: str, source: str) -> str:
    return f"""SELECT url, array_to_string(tokens, '|') AS {name},
  CAST(len(tokens) AS INTEGER) AS n_tokens FROM {source}"""


def _tall(source: str, match: str) -> str:
    day = f"SELECT {_DAY}, published_day, * EXCLUDE (published_day) FROM {source}"
    empty = "CAST(NULL AS VARCHAR) AS source_name, CAST(NULL AS VARCHAR) AS author"
    return f"""
SELECT 'year_month_day_aggregation' AS table_name, year, month, day, {empty}, count(*) AS n
FROM ({day}) AS a GROUP BY year, month, day
UNION ALL
SELECT 'source_author_aggregation', NULL, NULL, NULL, source_name, author, count(*)
FROM {source} GROUP BY source_name, author
UNION ALL
SELECT 'keyword_appearance_aggregation', year, month, day, NULL, NULL, count(*)
FROM ({day}) AS b WHERE {match} GROUP BY year, month, day"""


def _occurrences() -> str:
    parts = []
    for k in P.KEYWORDS:
        found = " + ".join(
            f"coalesce(len(regexp_extract_all(lower({c}), '{k}')), 0)"
            for c in ("description", "content", "title")
        )
        parts.append(f"SELECT {_DAY}, '{k}' AS keyword, {found} AS found FROM articles")
    return f"""SELECT year, month, day, keyword, CAST(sum(found) AS BIGINT) AS occurrences
FROM ({" UNION ALL ".join(parts)}) AS k
GROUP BY year, month, day, keyword HAVING sum(found) > 0"""


_MANY = """
listed AS (
  SELECT word, row_number() OVER (ORDER BY word) AS n FROM (
    SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]{4,}'))) AS word FROM benchmark)
)"""

_IN_WINDOWS = "published_day BETWEEN DATE '2024-01-02' AND DATE '2024-02-01'"
_TOP = "ORDER BY count DESC, word LIMIT"
_PRODUCED = """published_ts BETWEEN TIMESTAMP '2024-01-01 12:00:00'
  AND TIMESTAMP '2024-01-02 12:00:00'"""
_PT = ("description_pt", "content_pt", "title_pt")


def _measures(table: str, stage: str) -> str:
    counts = {
        "rows": "count(*)",
        "bad_dates": "count(*) FILTER (published_day IS NULL)",
        "without_author": "count(*) FILTER (author IS NULL)",
        "without_title": "count(*) FILTER (title IS NULL)",
    }
    return " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, '{name}' AS measure, {count} AS value FROM {table}"
        for name, count in counts.items()
    )


def oracles() -> dict[str, str]:
    art = _with(_ARTICLES)
    sql = {
        "ingest_articles": _with(_ARTICLES, _WIRED)
        + f"SELECT source_id, source_name, {_ID}, description, content, extra, position FROM wired",
        "rejected_articles": art
        + """SELECT concat('{"source":"none","url":"', url, '"}') AS value FROM articles""",
        "rejected_payloads": "SELECT html AS value FROM pages",
        "stamp_from_date": art + "SELECT url, title, '2024-01-31' AS from_date FROM articles",
        "history_union": _with(_ARTICLES, _WIRED)
        + f"""SELECT {_ID}, content, {_FROM_DATE},
  CASE WHEN published_day > {_FIRST_DAY} THEN description END AS description FROM wired""",
        "assign_windows": art + f"SELECT {_ID}, {_FROM_DATE} FROM articles WHERE {_IN_WINDOWS}",
        "assign_windows_closed": _with(_ARTICLES, _OFFSET)
        + f"SELECT {_ID}, {_FROM_DATE} FROM offsets WHERE {_IN_WINDOWS}",
        "window_page_cap": art
        + f"""SELECT url, popularity, {_FROM_DATE} FROM articles WHERE {_IN_WINDOWS}
QUALIFY row_number() OVER (PARTITION BY published_day ORDER BY popularity DESC, url)
  <= {6 * P.PAGE_SIZE}""",
        "producer_window": art + f"SELECT {_ID} FROM articles WHERE {_PRODUCED}",
        "search_query": art
        + "SELECT url, title FROM articles WHERE "
        + _whole_word(P.SEARCH, ("description", "content", "title")),
        "write_overwrite": art + f"SELECT {_ID}, content FROM {_latest('articles')} AS a",
        "write_partition_overwrite": _with(
            _ARTICLES,
            "\nagain AS (SELECT * FROM articles WHERE published_day < DATE '2024-01-03' AND "
            "published_ts BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-03')",
        )
        + f"""SELECT {_ID}, {_FROM_DATE} FROM {_latest('again')} AS a
UNION ALL
SELECT {_ID}, {_FROM_DATE} FROM articles
WHERE published_day NOT IN (SELECT published_day FROM again)""",
        "write_partition_append": art
        + f"""SELECT {_ID}, {_FROM_DATE} FROM articles
UNION ALL
SELECT {_ID}, {_FROM_DATE} FROM articles WHERE {_PRODUCED}""",
        "load_table": art
        + f"SELECT {_ID}, {_FROM_DATE} FROM articles WHERE published_day >= DATE '2024-01-02'",
        "read_csv_export": art
        + "SELECT url, author, title AS title_pt, content AS content_pt FROM articles",
        "table_counts": art
        + f"""SELECT 'raw' AS table_name, {_FROM_DATE}, count(*) AS row_count
FROM articles GROUP BY published_day
UNION ALL
SELECT 'harmonized', NULL, count(*) FROM {_latest('articles')} AS a""",
        "flatten_source": art
        + f"SELECT {_ID}, source_id, source_name, description, content FROM articles",
        "keyword_filter": art
        + f"SELECT {_ID}, content AS content_pt FROM articles WHERE {_match(P.KEYWORDS)}",
        "keyword_match": art
        + f"SELECT url, {_match(P.KEYWORDS)} AS keyword_match FROM articles",
        "relevance_strict": art
        + "SELECT url, title FROM articles WHERE "
        + _whole_word(P.STRICT_KEYWORDS, ("description", "content", "title")),
        "translate_enrich": _with(_ARTICLES, _MEMORY, _TRANSLATED)
        + f"SELECT url, {_TRANSLATED_COLUMNS} FROM translated",
        "translation_pending": _with(_ARTICLES, _MEMORY, _TEXTS)
        + "SELECT text FROM texts WHERE text NOT IN (SELECT text FROM memory)",
        "translate_texts": _with(_ARTICLES, _MEMORY, _TEXTS)
        + """SELECT text,
  CASE WHEN NOT contains(text, 'license') THEN concat('pt: ', text) END AS text_pt,
  CASE WHEN contains(text, 'license') THEN 'license text' END AS error
FROM texts WHERE text NOT IN (SELECT text FROM memory)""",
        "translate_udf": art
        + "SELECT url, "
        + ", ".join(
            f"""CASE WHEN contains({c}, 'license') THEN {c}
    WHEN {c} IS NOT NULL THEN concat('pt: ', {c}) END AS {c}_pt,
  coalesce(NOT contains({c}, 'license'), false) AS {c}_translated"""
            for c in ("description", "content", "title")
        )
        + " FROM articles",
        "dedup_latest": art + f"SELECT {_ID}, content FROM {_latest('articles')} AS a",
        "count_by_day": art
        + f"SELECT {_DAY}, count(*) AS news_count FROM articles GROUP BY published_day",
        "count_by_source_author": art
        + "SELECT source_name, author, count(*) AS news_count FROM articles "
        "GROUP BY source_name, author",
        "count_keyword_days": art
        + f"""SELECT {_DAY}, count(*) AS keyword_appearance_count FROM articles
WHERE {_match(P.KEYWORDS)} GROUP BY published_day""",
        "count_keyword_occurrences": art + _occurrences(),
        "count_keyword_occurrences_many": _with(_ARTICLES, _MANY)
        + f"""SELECT {_DAY}, keyword, CAST(sum(found) AS BIGINT) AS occurrences FROM (
  SELECT published_day, word AS keyword, """
        + " + ".join(
            f"coalesce((length(lower({c})) - length(replace(lower({c}), word, ''))) // length(word), 0)"
            for c in ("description", "content", "title")
        )
        + """ AS found FROM articles, listed
) AS k WHERE found > 0 GROUP BY published_day, keyword""",
        "keyword_filter_many": _with(_ARTICLES, _MANY)
        + f"""SELECT {_ID}, content AS content_pt FROM articles WHERE EXISTS (
  SELECT 1 FROM listed WHERE n % 7 = 1 AND (contains(lower(description), word)
    OR contains(lower(content), word) OR contains(lower(title), word)))""",
        "tokenize_ml": _with(_ARTICLES, _ML_TOKENS) + _tokens("tokens", "ml"),
        "remove_stopwords": _with(_ARTICLES, _ML_TOKENS) + _tokens("filtered_tokens", "visible"),
        "ascii_words": _with(_ARTICLES, _ML_TOKENS) + _tokens("filtered_tokens", "plain"),
        "explode_words": _with(_ARTICLES, _ML_TOKENS) + "SELECT url, word FROM exploded",
        "word_count": _with(_ARTICLES, _ML_TOKENS)
        + "SELECT word, count FROM counts ORDER BY count DESC, word",
        "top_words": _with(_ARTICLES, _ML_TOKENS) + f"SELECT word, count FROM counts {_TOP} 100",
        "rank_words": _with(_ARTICLES, _ML_TOKENS)
        + f"""SELECT word, count,
  CAST(row_number() OVER (ORDER BY count DESC, word) AS INTEGER) AS rank
FROM counts {_TOP} 100""",
        "tokenize_whitespace": _with(_ARTICLES, _SPACE_TOKENS) + _tokens("tokens", "spaced"),
        "alpha_words": _with(_ARTICLES, _SPACE_TOKENS) + _tokens("filtered_tokens", "alpha"),
        "zipf_word_freq": _with(_ARTICLES, _SPACE_TOKENS)
        + "SELECT word, count FROM freqs ORDER BY count DESC, word",
        "zipf_top10": _with(_ARTICLES, _SPACE_TOKENS) + f"SELECT word, count FROM freqs {_TOP} 10",
        "zipf_compare": _with(_ARTICLES, _SPACE_TOKENS)
        + f"""SELECT word, count, CAST(rank AS INTEGER) AS rank,
  CAST(max(count) OVER () AS DOUBLE) / rank AS zipf_expected
FROM (
  SELECT word, count, row_number() OVER (ORDER BY count DESC, word) AS rank
  FROM freqs {_TOP} 10
) AS top""",
        "stream_articles": _with(_ARTICLES, _WIRED, _STREAMED)
        + f"SELECT {_ID}, content FROM streamed",
        "stream_rejects": art
        + "SELECT value FROM "
        "(SELECT unnest(string_split(html, chr(10))) AS value FROM pages) AS lines "
        """WHERE value <> ''
UNION ALL
SELECT concat('{"source":"none","url":"', url, '"}') FROM articles""",
        "stream_stage_merge": _with(_ARTICLES, _WIRED)
        + f"""SELECT {_ID}, content FROM {_latest(_FIRST_SEEN)} AS a""",
        "stream_dedup": _with(_ARTICLES, _WIRED)
        + """SELECT author, title, CAST(min(published_day) AS VARCHAR) AS published_day
FROM wired GROUP BY author, title""",
        "stream_latest": _with(_ARTICLES, _WIRED) + f"SELECT {_ID}, content FROM {_latest('wired')} AS a",
        "quality_rows": _with(
            _ARTICLES,
            _WIRED,
            f"\nrelevant AS (SELECT * FROM wired WHERE {_match(P.KEYWORDS)})",
            f"\nlatest AS (SELECT * FROM {_latest('relevant')} AS r)",
        )
        + " UNION ALL ".join(
            [_measures(t, t if t != "wired" else "raw") for t in ("wired", "relevant", "latest")]
            + [
                f"SELECT '{now}', 'lost', (SELECT count(*) FROM {was}) - (SELECT count(*) FROM {now})"
                for was, now in (("wired", "relevant"), ("relevant", "latest"))
            ]
        ),
        "stream_quality_rows": _with(_ARTICLES, _WIRED, _STREAMED) + _measures("streamed", "raw"),
        "stream_counts_by_day": _with(_ARTICLES, _WIRED, _STREAMED)
        + f"SELECT {_DAY}, count(*) AS news_count FROM streamed GROUP BY published_day",
        "history_after_recent": _with(
            _ARTICLES, _WIRED, f"\nfirst_day AS (SELECT * FROM wired WHERE published_day = {_FIRST_DAY})"
        )
        + f"""SELECT {_ID}, content FROM {_latest('first_day')} AS a
UNION ALL
SELECT {_ID}, content FROM wired WHERE published_day > {_FIRST_DAY}""",
        "merge_after_history": _with(
            _ARTICLES,
            _WIRED,
            """
early AS (
  SELECT * FROM wired WHERE published_day < (SELECT min(published_day) + 2 FROM articles)
), late AS (
  SELECT * FROM wired w WHERE published_day >= (SELECT min(published_day) + 2 FROM articles)
    AND NOT EXISTS (SELECT 1 FROM early e WHERE e.author IS NOT DISTINCT FROM w.author
      AND e.title IS NOT DISTINCT FROM w.title)
)""",
        )
        + f"""SELECT {_ID}, content FROM early
UNION ALL
SELECT {_ID}, content FROM {_latest("(SELECT * FROM late QUALIFY published_day = min(published_day) OVER (PARTITION BY author, title)) AS l")} AS a""",
        "harmonize": _with(
            _ARTICLES,
            _MEMORY,
            _TRANSLATED,
            f"\nrelevant AS (SELECT * FROM translated WHERE {_match(P.PT_KEYWORDS, _PT)})",
        )
        + f"""SELECT {_ID}, source_id, source_name, {_TRANSLATED_COLUMNS}
FROM {_latest('relevant')} AS a""",
        "collect_history": art
        + f"""SELECT {_ID}, popularity, {_FROM_DATE} FROM articles
WHERE {_IN_WINDOWS} AND {_whole_word(P.SEARCH, ("description", "content", "title"))}
QUALIFY row_number() OVER (PARTITION BY published_day ORDER BY popularity DESC, url)
  <= {6 * P.PAGE_SIZE}""",
        "collect_recent": art
        + f"""SELECT {_ID}, popularity, '2024-01-31' AS from_date FROM articles
WHERE {_PRODUCED} AND {_whole_word(P.SEARCH, ("description", "content", "title"))}
ORDER BY popularity DESC, url LIMIT {P.PAGE_SIZE}""",
        "aggregate_all": art + _tall("articles", _match(P.KEYWORDS)),
        "daily_job": _with(
            _ARTICLES,
            _MEMORY,
            _TRANSLATED,
            f"\nrelevant AS (SELECT * FROM translated WHERE {_match(P.PT_KEYWORDS, _PT)})",
            f"\nharmonized AS (SELECT * FROM {_latest('relevant')} AS r)",
        )
        + _tall("harmonized", _match(P.KEYWORDS, _PT)),
    }
    sql["translate_udf_twice"] = sql["translate_udf"]
    sql["dedup_max_by"] = sql["dedup_latest"]
    sql["translate_enrich_few"] = sql["translate_enrich"]
    sql["translate_enrich_large"] = sql["translate_enrich"]
    sql["translation_pending_large"] = sql["translation_pending"]
    sql["daily_incremental"] = sql["daily_job"]
    sql["harmonize_incremental"] = sql["harmonize"]
    sql["harmonize_large"] = sql["harmonize"]
    return sql
