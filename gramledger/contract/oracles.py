"""DuckDB SQL for the queries, recomputing everything from the given tables."""

from __future__ import annotations

SEP = "[^a-z0-9]+"


def _tok(text: str) -> str:
    return f"string_split_regex(regexp_replace(lower({text}), '{SEP}$', ''), '{SEP}')"


def _hash(text: str) -> str:
    letters = f"regexp_replace(lower({text}), '{SEP}', '', 'g')"
    return f"sha1(encode(regexp_replace({letters}, '(.)', concat('\\1', chr(0)), 'g')))"


def _grams(tok: str) -> str:
    return f"list_transform(range(4, len({tok}) + 1), lambda i: array_to_string({tok}[i-3:i], ' '))"


def _counts(docs: str, name: str = "counts", at: str = "") -> str:
    """CTEs counting the phrases of the relation `docs(hash, text)`; `at` is an extra key."""
    key = f"{at}, " if at else ""
    return f"""
      {name}_tok AS (SELECT {key}hash, {_tok("text")} AS tok FROM {docs}),
      {name}_pos AS (SELECT {key}hash, unnest({_grams("tok")}) AS phrase FROM {name}_tok),
      {name}_doc AS (SELECT {key}hash, phrase, count(*) AS n FROM {name}_pos GROUP BY ALL),
      {name} AS (SELECT {key}phrase, count(*) AS doc_count, CAST(sum(n) AS BIGINT) AS total_count
                 FROM {name}_doc GROUP BY ALL)"""


UNIQUE = f"""
  hashed AS (SELECT doc_id, text, {_hash("text")} AS hash FROM documents),
  uniq AS (SELECT hash, arg_min(text, doc_id) AS text, count(*) AS ref_count FROM hashed GROUP BY hash)"""

FEED = f"""
  feed AS (SELECT CAST(doc_id // 3 AS VARCHAR) AS uri, doc_id % 3 AS seq, text,
                  {_hash("text")} AS hash FROM documents)"""


def _latest(name: str, where: str = "true", feed: str = "feed") -> str:
    """CTEs: the last write per URI, and the documents behind them."""
    return f"""
  {name} AS (SELECT uri, max(seq) AS seq, arg_max(hash, seq) AS hash, arg_max(text, seq) AS text
             FROM {feed} WHERE {where} GROUP BY uri),
  {name}_docs AS (SELECT hash, arg_min(text, (seq, uri)) AS text, count(*) AS ref_count
                  FROM {name} GROUP BY hash)"""


BENCH_PHRASES = f"""
  items AS (SELECT {_tok("text")} AS tok FROM benchmark),
  wanted AS (SELECT DISTINCT unnest({_grams("tok")}) AS phrase FROM items)"""

LOOKUP = """
  SELECT phrase, coalesce(doc_count, 0) AS doc_count, coalesce(total_count, 0) AS total_count
  FROM wanted LEFT JOIN counts USING (phrase)"""

ALL_COUNTS = f"WITH {UNIQUE}, {_counts('uniq')} SELECT phrase, doc_count, total_count FROM counts"
FEED_COUNTS = f"""WITH {FEED}, {_latest("now")}, {_counts("now_docs")}
  SELECT phrase, doc_count, total_count FROM counts"""

BEFORE_AFTER = f"{FEED}, {_latest('old', 'seq < 2')}, {_latest('now')}"
CHANGED_COUNTS = f"""WITH {BEFORE_AFTER}, {_counts("old_docs", "a")}, {_counts("now_docs", "b")},
  -- a document in both states is neither added nor taken back, but may shift nothing
  d AS (SELECT phrase,
               coalesce(b.doc_count, 0) - coalesce(a.doc_count, 0) AS d_doc,
               coalesce(b.total_count, 0) - coalesce(a.total_count, 0) AS d_total,
               coalesce(b.doc_count, 0) AS doc_count, coalesce(b.total_count, 0) AS total_count
        FROM a FULL JOIN b USING (phrase)),
  changed AS (SELECT * FROM d WHERE d_doc <> 0 OR d_total <> 0)"""

STATS = f"""WITH {FEED}, {_latest("now")},
  stats AS (SELECT (SELECT count(DISTINCT uri) FROM feed) AS uris,
                   (SELECT count(DISTINCT hash) FROM now) AS unique_docs,
                   (SELECT count(DISTINCT hash) FROM now) AS processed_docs)"""

TOKENS = f"""
  SELECT doc_id,
         CASE WHEN regexp_full_match(lower(text), '{SEP}') THEN [] ELSE {_tok("text")} END AS t
  FROM documents"""

REPORT = f"""WITH {UNIQUE}, {_counts("uniq")}
  SELECT printf('%7d %7d ''%s''', doc_count, total_count, phrase) AS value
  FROM counts ORDER BY phrase"""

ORACLES: dict[str, str] = {
    "tokenize": f"""SELECT doc_id, len(t) AS n_tokens, t[1] AS first_token, t[-1] AS last_token,
        md5(array_to_string(t, ' ')) AS tokens_md5 FROM ({TOKENS})""",
    "doc_hash": f"SELECT doc_id, {_hash('text')} AS hash FROM documents",
    "doc_phrases": f"""
        WITH t AS (SELECT doc_id, {_tok("text")} AS tok FROM documents),
        p AS (SELECT doc_id, unnest({_grams("tok")}) AS phrase,
                     unnest(range(0, greatest(len(tok) - 3, 0))) AS pos FROM t)
        SELECT doc_id, pos, phrase FROM p""",
    "doc_phrase_counts": f"WITH {UNIQUE}, {_counts('uniq')} SELECT hash, phrase, n FROM counts_doc",
    "phrase_counts": ALL_COUNTS,
    "unique_docs": f"WITH {UNIQUE} SELECT hash, text AS content, ref_count FROM uniq",
    "page_phrase_counts": f"""
        WITH docs AS (SELECT {_hash("html")} AS hash, arg_min(html, (page_id, url)) AS text
                      FROM pages GROUP BY 1), {_counts("docs")}
        SELECT phrase, doc_count, total_count FROM counts""",
    "conversation_phrase_counts": f"""
        WITH turns AS (SELECT concat('conversation:', conv_id) AS uri, turn AS seq, text,
                              {_hash("text")} AS hash FROM conversations),
        {_latest("now", feed="turns")}, {_counts("now_docs")}
        SELECT phrase, doc_count, total_count FROM counts""",
    "change_feed": f"""
        SELECT CAST(doc_id // 3 AS VARCHAR) AS uri, doc_id % 3 AS seq, {_hash("text")} AS hash FROM documents
        UNION ALL
        SELECT concat('conversation:', conv_id), turn, {_hash("text")} FROM conversations
        UNION ALL
        SELECT url, page_id, {_hash("html")} FROM pages""",
    "latest_by_uri": f"""WITH {FEED}, {_latest("now")}
        SELECT uri, seq, hash, text AS content FROM now""",
    "doc_ref_counts": f"WITH {FEED}, {_latest('now')} SELECT hash, ref_count FROM now_docs",
    "phrase_lookup": f"WITH {UNIQUE}, {_counts('uniq')}, {BENCH_PHRASES} {LOOKUP}",
    "phrase_report": REPORT,
    "changed_uris": f"""WITH {BEFORE_AFTER}
        SELECT uri, old.hash AS old_hash, now.hash AS new_hash
        FROM now LEFT JOIN old USING (uri) WHERE old.hash IS DISTINCT FROM now.hash""",
    "doc_transitions": f"""WITH {BEFORE_AFTER},
        rc AS (SELECT hash, coalesce(old_docs.ref_count, 0) AS old_count,
                      coalesce(now_docs.ref_count, 0) AS new_count
               FROM old_docs FULL JOIN now_docs USING (hash))
        SELECT hash, old_count, new_count,
               CAST(CASE WHEN old_count = 0 THEN 1 WHEN new_count = 0 THEN -1 ELSE 0 END AS INTEGER)
                 AS multiplier
        FROM rc WHERE old_count <> new_count""",
    "phrase_deltas": f"{CHANGED_COUNTS} SELECT phrase, d_doc, d_total FROM changed",
    "export_changes": f"""{CHANGED_COUNTS}
        SELECT phrase, CAST(2 AS BIGINT) AS seq, doc_count, total_count FROM changed""",
    "incremental_counts": FEED_COUNTS,
    "late_writes": FEED_COUNTS,
    "stream_counts": FEED_COUNTS,
    "export_apply": FEED_COUNTS,
    "live_documents": f"""WITH {FEED}, {_latest("now")}
        SELECT hash, text AS content, ref_count FROM now_docs""",
    "uri_table": f"WITH {FEED}, {_latest('now')} SELECT uri, hash FROM now",
    "ledger_lookup": f"WITH {FEED}, {_latest('now')}, {_counts('now_docs')}, {BENCH_PHRASES} {LOOKUP}",
    "corpus_stats": f"{STATS} SELECT uris, unique_docs, processed_docs FROM stats",
    "corpus_stats_report": f"""{STATS}
        SELECT format('# uris                : {{:,}}', uris) AS value FROM stats UNION ALL
        SELECT format('# unique documents    : {{:,}}', unique_docs) FROM stats UNION ALL
        SELECT format('# processed documents : {{:,}}', processed_docs) FROM stats""",
    "phrase_table": ALL_COUNTS,
    "table_lookup": f"WITH {UNIQUE}, {_counts('uniq')}, {BENCH_PHRASES} {LOOKUP}",
    "phrase_range_layout": f"""WITH {UNIQUE}, {_counts("uniq")}
        SELECT phrase[1:1] AS first_char, count(*) AS phrases,
               CAST(sum(total_count) AS BIGINT) AS occurrences FROM counts GROUP BY ALL""",
    "text_directory": f"""
        WITH files AS (SELECT text FROM documents UNION ALL SELECT '' FROM documents WHERE doc_id % 11 = 0)
        SELECT {_hash("text")} AS hash, count(*) AS ref_count FROM files GROUP BY 1""",
    "directory_stream": f"WITH {FEED}, {_latest('now')} SELECT hash, ref_count FROM now_docs",
    "export_stream": FEED_COUNTS,
    "export_outside": FEED_COUNTS,
    "table_updates": FEED_COUNTS,
    # The sketch is exact for as few documents as a phrase has here.
    "combined_values": f"""WITH {FEED}, {_latest("now")}, {_counts("now_docs")}
        SELECT phrase, count(*) AS doc_count, CAST(sum(n) AS BIGINT) AS total_count, max(n) AS most_in_one, count(*) AS about
        FROM counts_doc GROUP BY phrase""",
    "table_report": REPORT,
    "table_prefix": f"{ALL_COUNTS} WHERE starts_with(phrase, 'a') AND phrase > 'an'",
    "corpus_lag": f"""WITH {FEED}, {_latest('old', 'seq < 2')}, {_latest('now')}
        SELECT (SELECT count(DISTINCT uri) FROM feed) AS uris,
               (SELECT count(DISTINCT hash) FROM now) AS unique_docs,
               (SELECT count(DISTINCT hash) FROM old) AS processed_docs""",
}
