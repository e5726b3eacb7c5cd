"""SQL whose results the queries must equal, written independently of them.

Character-level and token-level recursion stands in for the offset arithmetic, regular
expressions and folds of the library.
"""

from __future__ import annotations

# Fixed value: the default tokens.
_TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]"
_WORD_END = r"[ .,;:!?\-—\t\n\r\f\v]"
_NOT_WORD_END = r"[^ .,;:!?\-—\t\n\r\f\v]"
# Unicode white space and the four separator control characters.
_BLANK = (
    r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)
_ENDS = "'.', '!', '?', chr(10)"

_OBJECTS = "SELECT 'documents/' || doc_id AS object_id, text, strlen(text) AS length FROM documents"


def _parts(size: int) -> str:
    return (
        f"SELECT object_id, text, s AS start, least(s + {size}, length) AS \"end\" "
        f"FROM (SELECT *, unnest(range(0, length, {size})) AS s FROM ({_OBJECTS}))"
    )


def _chunks(part: int, size: int) -> str:
    return (
        f"SELECT object_id, text, start AS part_start, s // {size} AS seq, start + s AS start, "
        f"least(start + s + {size}, \"end\") AS \"end\" "
        f"FROM (SELECT *, unnest(range(0, \"end\" - start, {size})) AS s FROM ({_parts(part)}))"
    )


def _slice(text: str, low: str, high: str) -> str:
    return f"encode({text})[{low} + 1:{high}]"


# Characters of every document with their byte ranges.
_CHARACTERS = f"""
SELECT object_id, c, i, coalesce(sum(strlen(c)) OVER (PARTITION BY object_id ORDER BY i
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS low,
       (sum(strlen(c)) OVER (PARTITION BY object_id ORDER BY i))::BIGINT AS high
FROM (SELECT object_id, unnest(string_split(text, '')) AS c,
             generate_subscripts(string_split(text, ''), 1) AS i
      FROM ({_OBJECTS}) WHERE length > 0)
"""


def _decoded(part: int, size: int) -> str:
    """A character belongs to the chunk of its last byte, if its first byte is in the same part.

    A chunk whose first bytes end a character that nobody completes is cut off from the
    chunk before, and so is the next one, which also loses the character between them.
    """
    return f"""
WITH placed AS (
  SELECT *, low // {part} AS p, (high - 1) // {part} AS p_last,
         (low % {part}) // {size} AS k_first, ((high - 1) % {part}) // {size} AS k
  FROM ({_CHARACTERS})),
chunk AS ({_chunks(part, size)}),
torn AS (
  SELECT object_id, part_start, seq, start,
         max(CASE WHEN leads THEN 0 ELSE 1 END) OVER w = 1 AS some_whole
  FROM (SELECT chunk.*, EXISTS (FROM placed WHERE placed.object_id = chunk.object_id
                                AND placed.low < chunk.start AND placed.high > chunk.start) AS leads
        FROM chunk)
  WINDOW w AS (PARTITION BY object_id, part_start ORDER BY seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
state AS (
  SELECT *, part_start > 0 AND NOT coalesce(some_whole, false) AS alone FROM torn)
SELECT state.object_id, state.part_start, string_agg(c, '' ORDER BY i) AS text,
       CASE WHEN any_value(alone) THEN any_value(start) ELSE min(low) END AS start,
       (CASE WHEN any_value(alone) THEN any_value(start) ELSE min(low) END + sum(strlen(c)))::BIGINT AS "end"
FROM placed JOIN state ON state.object_id = placed.object_id AND state.part_start = placed.p * {part}
  AND state.seq = placed.k
WHERE p = p_last AND (k_first = k OR NOT alone)
GROUP BY state.object_id, state.part_start, seq
"""


def _wrapped(first: str = "0", columns: str = "conv_id, turn, text") -> str:
    before = (
        "coalesce(sum(strlen(text)) OVER (PARTITION BY conv_id ORDER BY turn "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT"
    )
    return (
        f"SELECT {columns}, {first} + {before} AS start, "
        f"{first} + {before} + strlen(text) AS \"end\" FROM conversations"
    )


def _healed(source: str, keys: str, order: str, columns: str, ends: str, inside: str) -> str:
    """Word healing as one row of look-back."""
    return f"""
WITH own AS (
  SELECT *, CASE WHEN regexp_matches(text, '{ends}') THEN regexp_extract(text, '{inside}*$') ELSE '' END AS tail
  FROM ({source})),
linked AS (
  SELECT *, start = coalesce(lag("end") OVER w, 0) AS follows, lag(tail) OVER w AS word
  FROM own WINDOW w AS (PARTITION BY {keys} ORDER BY {order})),
joined AS (
  SELECT *, CASE WHEN follows THEN coalesce(word, '') ELSE '' END AS prefix FROM linked),
measured AS (
  SELECT *, prefix || text AS whole, length(regexp_extract(prefix || text, '^{inside}*')) AS head FROM joined),
cut AS (
  SELECT *, NOT follows AND start > 0 AND head > 0 AND head < length(whole) AS trim,
         left(whole, length(whole) - length(tail)) AS body FROM measured),
done AS (
  SELECT * EXCLUDE (text, start, "end"), CASE WHEN trim THEN substr(body, head + 1) ELSE body END AS text,
         CASE WHEN trim THEN start + head ELSE start - strlen(prefix) END AS start,
         "end" - strlen(tail) AS "end" FROM cut)
SELECT {columns}, text, start, "end" FROM done
WHERE text <> '' AND NOT regexp_full_match(text, '{_BLANK}')
"""


def _resized(source: str, key: str, low: int, high: int, token: str = _TOKEN, ends: str = _ENDS) -> str:
    """Cut one text per key, a chunk per recursion step."""
    return f"""
WITH RECURSIVE tokens AS (
  SELECT {key}, regexp_extract_all(text, '{token}') AS t FROM ({source})),
step AS (
  SELECT {key}, t, 0::BIGINT AS seq, 0::BIGINT AS a, 0::BIGINT AS b, 0::BIGINT AS byte_a, 0::BIGINT AS byte_b,
         '' AS text FROM tokens
  UNION ALL
  SELECT {key}, t, seq + 1, b, b + taken, byte_b, byte_b + strlen(array_to_string(t[b + 1:b + taken], '')),
         array_to_string(t[b + 1:b + taken], '')
  FROM (SELECT *, CASE WHEN last >= {low} THEN last ELSE least(len(t) - b, {high}) END AS taken
        FROM (SELECT *, coalesce(list_max([i FOR i IN range(1, least(len(t) - b, {high}) + 1)
                                           IF t[b + i] IN ({ends})]), 0) AS last
              FROM step WHERE len(t) - b >= {low})))
SELECT {key}, seq - 1 AS seq, text, byte_a AS start, byte_b AS "end" FROM step WHERE seq > 0
"""


def _whole_healed(objects: str) -> str:
    """Objects of one chunk each: the unfinished last word goes."""
    return f"""
SELECT object_id, CASE WHEN regexp_matches(text, '{_WORD_END}')
                       THEN regexp_replace(text, '{_NOT_WORD_END}*$', '') ELSE text END AS text
FROM ({objects}) WHERE length > 0
"""


# The chain at default sizes: what is left of an object is cut.
_WHOLE_HEALED = _whole_healed(_OBJECTS)


def _not_blank(healed: str) -> str:
    return f"SELECT * FROM ({healed}) WHERE text <> '' AND NOT regexp_full_match(text, '{_BLANK}')"


_PREPARED = _resized(_not_blank(_WHOLE_HEALED), "object_id", 50, 200)


def _term_vector(text: str) -> str:
    buckets = f"[('0x' || substr(md5(w), 1, 8))::BIGINT % 64 FOR w IN regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}]+')]"
    counts = f"list_aggregate({buckets}, 'histogram')"
    return f"(SELECT array_to_string([coalesce(h[j], 0) FOR j IN range(0, 64)], ',') FROM (SELECT {counts} AS h))"


def _vectors(prepared: str) -> str:
    return f"SELECT object_id || ':' || start || '-' || \"end\" AS id, {_term_vector('text')} AS vector FROM ({prepared})"


_VECTORS = _vectors(_PREPARED)
_HALVED = """
SELECT 'documents/' || doc_id AS object_id, text, strlen(text) AS length FROM (
  SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN left(text, length(text) // 2) ELSE text END AS text
  FROM documents)
"""


def _resized_stream(source: str, low: int, high: int) -> str:
    """Token-level machine over chunk streams ``(stream, turn, text, start)``.

    A run of chunks that continue each other is a stream of its own.  The end of a chunk
    flushes what reaches the minimum, and a word that two chunks share counts once where
    text is tokenized afresh.
    """
    return rf"""
WITH RECURSIVE linked AS (
  SELECT *, CASE WHEN start = coalesce(lag(start + strlen(text)) OVER w, 0) THEN 0 ELSE 1 END AS gap
  FROM ({source}) WINDOW w AS (PARTITION BY stream ORDER BY turn)),
chunk AS (
  SELECT stream, turn, text, start, sum(gap) OVER (PARTITION BY stream ORDER BY turn) AS island FROM linked),
chunk_tokens AS (
  SELECT stream, island, turn, regexp_extract_all(text, '{_TOKEN}') AS t FROM chunk),
flat AS (
  SELECT stream, island, turn, unnest(t) AS tok, generate_subscripts(t, 1) AS j, len(t) AS n FROM chunk_tokens),
numbered AS (
  SELECT *, row_number() OVER w AS i, (sum(strlen(tok)) OVER w)::BIGINT AS byte_end, lag(tok) OVER w AS before
  FROM flat WINDOW w AS (PARTITION BY stream, island ORDER BY turn, j)),
token AS (
  SELECT stream, island, i, byte_end, tok IN ({_ENDS}) AS stop, j = n AS closes,
         j = 1 AND coalesce(regexp_matches(before, '[\p{{L}}\p{{N}}]$'), false)
               AND regexp_matches(tok, '^[\p{{L}}\p{{N}}]') AS shared
  FROM numbered),
run AS (
  SELECT stream, island, 0::BIGINT AS i, 0::BIGINT AS c, 0::BIGINT AS g, 0::BIGINT AS d, 0::BIGINT AS d_end,
         []::BIGINT[] AS cuts
  FROM (SELECT DISTINCT stream, island FROM token)
  UNION ALL
  SELECT stream, island, i,
    CASE WHEN closes AND c2 >= {low} THEN CASE WHEN d2 >= {low} AND g2 - d2 < {low} THEN g2 - d2 ELSE 0 END
         ELSE c2 END,
    CASE WHEN closes AND c2 >= {low} THEN CASE WHEN d2 >= {low} AND g2 - d2 < {low} THEN g2 - d2 ELSE 0 END
         ELSE g2 END,
    CASE WHEN closes AND c2 >= {low} THEN 0 ELSE d2 END, d_end,
    max_cut || CASE WHEN NOT closes OR c2 < {low} THEN [] WHEN d2 < {low} THEN [byte_end]
                    WHEN g2 - d2 >= {low} THEN [d_end, byte_end] ELSE [d_end] END
  FROM (SELECT *, CASE WHEN c1 < {high} THEN c1 WHEN d1 >= {low} THEN g1 - d1 ELSE 0 END AS c2,
          CASE WHEN c1 < {high} THEN g1 WHEN d1 >= {low} THEN g1 - d1 ELSE 0 END AS g2,
          CASE WHEN c1 < {high} THEN d1 ELSE 0 END AS d2,
          CASE WHEN c1 < {high} THEN []::BIGINT[] WHEN d1 >= {low} THEN [d_end] ELSE [byte_end] END AS max_cut
        FROM (SELECT * EXCLUDE (d_end), CASE WHEN stop THEN g1 ELSE d END AS d1,
                     CASE WHEN stop THEN byte_end ELSE d_end END AS d_end
              FROM (SELECT token.*, run.c + 1 AS c1, run.d, run.d_end,
                           run.g + CASE WHEN shared AND run.c > 0 THEN 0 ELSE 1 END AS g1
                    FROM run JOIN token ON token.stream = run.stream AND token.island = run.island
                                       AND token.i = run.i + 1)))),
cut AS (SELECT stream, island, unnest(cuts) AS b FROM run),
piece AS (
  SELECT stream, island, coalesce(lag(b) OVER (PARTITION BY stream, island ORDER BY b), 0) AS a, b FROM cut),
whole AS (
  SELECT stream, island, string_agg(text, '' ORDER BY turn) AS text, min(start) AS base
  FROM chunk GROUP BY stream, island)
SELECT stream, decode({_slice('text', 'a', 'b')}) AS text, base + a AS start, base + b AS "end"
FROM piece JOIN whole USING (stream, island)
"""


# Word-healed chunks of small parts as streams.
_SMALL_HEALED = f"""
SELECT {{'object_id': object_id, 'part_start': part_start}} AS stream, start AS turn, text, start
FROM ({_healed(
    _decoded(1000, 64), "object_id, part_start", 'start, "end"', "object_id, part_start", _WORD_END, _NOT_WORD_END
)})
"""


def _first_of(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '[.!?\\n]') THEN length(regexp_extract({text}, '^[^.!?\\n]*')) ELSE -1 END"


def _last_of(text: str) -> str:
    return (
        f"CASE WHEN regexp_matches({text}, '[.!?\\n]') "
        f"THEN length({text}) - length(regexp_extract({text}, '[^.!?\\n]*$')) - 1 ELSE -1 END"
    )


def _shifted(position: str) -> str:
    return f"CASE WHEN {position} >= 0 THEN 20 + ({position}) ELSE -1 END"


_DESCRIPTOR = (
    "'{\"objectId\":{\"bucket\":\"up\\\"loads\",\"key\":\"' || split_part(object_id, '/', 2) || "
    "'\"},\"start\":' || start || ',\"end\":' || \"end\" || '}'"
)

_HEX = f"hex({_slice('text', 'start', chr(34) + 'end' + chr(34))})"

_LABELLED = """
SELECT 'v' || vec_id AS id, embedding AS vector, 'embedding' AS source, label AS grade, 0 AS age FROM embeddings
UNION ALL
SELECT 'v' || doc_id, list_reverse(embedding), 'label', quality, 1 FROM labels JOIN embeddings ON doc_id = vec_id
UNION ALL
SELECT 'w' || doc_id, embedding, 'new', quality, 1 FROM labels JOIN embeddings ON doc_id = vec_id
"""
_SHOWN = (
    "id, md5(array_to_string([floor(x::DOUBLE * 1048576)::BIGINT FOR x IN vector], ',')) AS digest, len(vector) AS width, "
    "source, grade::BIGINT AS grade"
)
_UPSERTED = f"SELECT {_SHOWN} FROM ({_LABELLED}) QUALIFY row_number() OVER (PARTITION BY id ORDER BY age DESC) = 1"

_SENT = """
SELECT json_object('Records', [{'s3': {'object': {'key': source || '/' || doc_id}}}]) AS body FROM documents
UNION ALL
SELECT json_object('Event', CASE WHEN event_type = 'error' THEN 's3:TestEvent' END, 'Records',
       [{'s3': {'object': {'key': 'event ' || event_id || ' "é".json'}}}, {'s3': {'object': {'key': 'second'}}}])
FROM events
"""
_KEPT = f"SELECT body FROM ({_SENT}) WHERE coalesce(json_extract_string(body, '$.Event'), '') <> 's3:TestEvent'"

_APPENDED = """SELECT conv_id, row_number() OVER w AS turn, text, (sum(strlen(text)) OVER w)::BIGINT - strlen(text) AS start,
    (sum(strlen(text)) OVER w)::BIGINT AS "end" FROM conversations
    WINDOW w AS (PARTITION BY conv_id ORDER BY CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 ELSE 2 END, turn
                 ROWS UNBOUNDED PRECEDING)"""
_APPENDED_HEALED = _healed(_APPENDED, "conv_id", "turn", "conv_id, turn", _WORD_END, _NOT_WORD_END)
_LINES = """SELECT coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
    translate(coalesce(text, ''), chr(10) || chr(13), '  ') AS line FROM documents"""

ORACLE: dict[str, str] = {
    "written_read": f"""SELECT lang, source, count(*) AS documents, sum(strlen(line) + 1)::BIGINT AS bytes,
        sum(('0x' || substr(md5(line), 1, 8))::BIGINT)::BIGINT AS digest FROM ({_LINES}) GROUP BY ALL""",
    "written_sizes": f"SELECT lang, source, sum(strlen(line) + 1)::BIGINT AS bytes FROM ({_LINES}) GROUP BY ALL",
    "written_part_reads": f"""SELECT lang, source, sum(strlen(line) + 1)::BIGINT AS planned, sum(strlen(line) + 1)::BIGINT AS bytes,
        count(*) AS documents, sum(strlen(line) - strlen(replace(line, 'e', '')))::BIGINT AS es, true AS bounded
        FROM ({_LINES}) GROUP BY ALL""",
    "object_read": f"SELECT object_id, length, md5(text) AS digest FROM ({_OBJECTS})",
    "object_sizes": "SELECT 'pages/' || page_id AS object_id, strlen(html) AS length FROM pages",
    "part_ranges": f'SELECT object_id, strlen(text) AS length, start, "end" FROM ({_parts(1000)})',
    "part_reads": f"""SELECT object_id, start, "end", md5({_slice('text', 'start', '"end"')}) AS digest
        FROM ({_parts(1000)})""",
    "byte_chunks": f"""SELECT object_id, part_start, seq, start, "end",
        md5({_slice('text', 'start', '"end"')}) AS digest FROM ({_chunks(1000, 64)})""",
    "notification_keys": f"""SELECT 'uploads' AS bucket, key, 'uploads/' || key AS object_id
        FROM (SELECT json_extract_string(body, '$.Records[0].s3.object.key') AS key FROM ({_KEPT}))""",
    "notification_records": f"""SELECT key, count(*) AS n
        FROM (SELECT unnest(json_extract_string(body, '$.Records[*].s3.object.key')) AS key FROM ({_KEPT}))
        GROUP BY key""",
    "part_descriptors": f"""SELECT '"' || replace(replace(body, '\\', '\\\\'), '"', '\\"') || '"' AS body
        FROM (SELECT {_DESCRIPTOR} AS body FROM ({_parts(1000)}))""",
    "part_descriptors_parsed": f"""SELECT 'up"loads' AS bucket, object_id AS key, start, "end"
        FROM ({_parts(1000)})""",
    "wrapped_bytes": f"""SELECT conv_id, turn, start, "end", 'utf-8' AS encoding, md5(text) AS digest
        FROM ({_wrapped('74')})""",
    "wrapped_bytes_at": """SELECT conv_id, turn, 1000 - 7 * turn AS start, 1000 - 7 * turn + strlen(text) AS "end",
        md5(text) AS digest FROM conversations""",
    "wrapped_text": f"SELECT *, 'utf-8' AS encoding FROM ({_wrapped('1000 * conv_id')})",
    "wrapped_text_utf16": r"""WITH sized AS (
        SELECT *, 2 * (length(text) + len(regexp_extract_all(text, '[\x{10000}-\x{10FFFF}]'))) AS size
        FROM conversations)
        SELECT conv_id, turn, (sum(size) OVER w)::BIGINT - size AS start, (sum(size) OVER w)::BIGINT AS "end"
        FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
    "wrapped_text_at": """SELECT conv_id, turn, text, 500 * turn AS start, 500 * turn + strlen(text) AS "end"
        FROM conversations""",
    "appended_streams": """SELECT conv_id, role, text, (sum(strlen(text)) OVER w)::BIGINT - strlen(text) AS start,
        (sum(strlen(text)) OVER w)::BIGINT AS "end" FROM conversations
        WINDOW w AS (PARTITION BY conv_id
                     ORDER BY CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 ELSE 2 END, turn)""",
    "distinct_texts": """SELECT md5(text) AS digest, 0 AS start, strlen(text) AS "end"
        FROM (SELECT DISTINCT text FROM documents)""",
    "surplus_texts": """SELECT md5(text) AS digest, strlen(text) AS "end", count(*) - 1 AS surplus
        FROM documents GROUP BY text HAVING count(*) > 1""",
    "decoded_chunks": _decoded(1000, 64),
    "chunk_islands": f"""WITH spoken AS (
        SELECT * FROM ({_wrapped('0', 'conv_id, turn, role, text')}) WHERE role <> 'system'),
        linked AS (SELECT *, CASE WHEN start = coalesce(lag("end") OVER w, 0) THEN 0 ELSE 1 END AS gap
                   FROM spoken WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
        SELECT conv_id, turn, start, (sum(gap) OVER (PARTITION BY conv_id ORDER BY turn))::BIGINT AS island
        FROM linked""",
    "healed_turns": _healed(_wrapped(), "conv_id", "turn", "conv_id, turn", _WORD_END, _NOT_WORD_END),
    "healed_turns_custom": _healed(_wrapped("5"), "conv_id", "turn", "conv_id, turn", r"[e\n]", r"[^e\n]"),
    "healed_chunks": _healed(
        _decoded(1000, 64),
        "object_id, part_start",
        'start, "end"',
        "object_id, part_start",
        _WORD_END,
        _NOT_WORD_END,
    ),
    "resized_documents": _resized("SELECT * FROM documents", "doc_id", 50, 200),
    "resized_documents_small": _resized("SELECT * FROM documents", "doc_id", 15, 40),
    "resized_pages": _resized(
        "SELECT page_id, html AS text FROM pages",
        "page_id",
        20,
        60,
        r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]",
        "'>', chr(10)",
    ),
    "resized_turns": f"""SELECT stream AS conv_id, text, start, "end"
        FROM ({_resized_stream(f"SELECT conv_id AS stream, turn, text, start FROM ({_wrapped()})", 50, 200)})""",
    "appended_resized": f"""SELECT stream AS conv_id, text, start, "end"
        FROM ({_resized_stream(f"SELECT conv_id AS stream, turn, text, start FROM ({_APPENDED_HEALED})", 50, 200)})""",
    "prepared_chunks": f'SELECT object_id, 0 AS part_start, seq, text, start, "end" FROM ({_PREPARED})',
    "prepared_small_chunks": f"""SELECT stream.object_id, stream.part_start, text, start, "end"
        FROM ({_resized_stream(_SMALL_HEALED, 15, 40)})""",
    "quarantined": """SELECT 'documents/' || doc_id AS object_id, 0 AS part_start,
        least(1000, strlen(text) - 1) AS part_end FROM documents
        WHERE strlen(left(text, 1)) > 1 AND strlen(text) > strlen(left(text, 1))""",
    "utf8_boundaries": f"""WITH chunk AS (SELECT *, {_HEX} AS h FROM ({_chunks(1000, 61)})),
        run AS (SELECT *, len(regexp_extract(h, '^([89AB].)*')) // 2 AS lead_bytes,
                       len(regexp_extract(h, '([89AB].)*$')) // 2 AS trail_bytes, len(h) // 2 AS size FROM chunk),
        lead AS (SELECT *, substr(h, 2 * (size - trail_bytes) - 1, 1) AS first_digit FROM run)
        SELECT object_id, start, lead_bytes, trail_bytes,
          CASE WHEN trail_bytes = size THEN 0
               WHEN trail_bytes = CASE WHEN first_digit <= '7' THEN 0 WHEN first_digit IN ('C', 'D') THEN 1
                                    WHEN first_digit = 'E' THEN 2 ELSE 3 END THEN size
               ELSE size - trail_bytes - 1 END AS cut,
          substr(h, 2 * lead_bytes + 1) AS without_left, size - trail_bytes AS without_right,
          greatest(size - lead_bytes - trail_bytes, 0) AS without_both
        FROM lead""",
    "continuation_bytes": "SELECT doc_id, strlen(text) - length(text) AS n FROM documents",
    "delimiter_positions": f"""WITH cut AS (
          SELECT doc_id, text, substr(text, 21, 40) AS mid,
                 [x IN ({_ENDS}) FOR x IN regexp_extract_all(text, '{_TOKEN}')] AS hits FROM documents)
        SELECT doc_id, {_first_of('text')} AS first, {_last_of('text')} AS last,
          {_shifted(_first_of('mid'))} AS first_within, {_shifted(_last_of('mid'))} AS last_within,
          -1::BIGINT AS of_nothing, coalesce(list_position(hits, true), 0)::BIGINT - 1 AS first_token,
          CASE WHEN list_contains(hits, true) THEN len(hits) - list_position(list_reverse(hits), true) ELSE -1 END
            AS last_token
        FROM cut""",
    "byte_lengths": r"""SELECT doc_id, strlen(text) AS utf8,
        2 * (length(text) + len(regexp_extract_all(text, '[\x{10000}-\x{10FFFF}]'))) AS utf16 FROM documents""",
    "token_counts": f"""SELECT doc_id, len(t) AS counted, len(t) AS listed, t[1] AS first,
        md5(array_to_string(t, '|')) AS digest, 1::BIGINT AS whole
        FROM (SELECT doc_id, regexp_extract_all(text, '{_TOKEN}') AS t FROM documents)""",
    "embedding_inputs": f"""SELECT 'documents/' || doc_id || ':' || start || '-' || "end" AS id,
        replace(text, chr(10), ' ') AS text FROM ({_resized('SELECT * FROM documents', 'doc_id', 15, 40)})""",
    "blank_lines": f"""SELECT doc_id, count(*) FILTER (regexp_full_match(line, '{_BLANK}')) AS blank,
        count(*) FILTER (line = '') AS empty
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id""",
    "turn_batches": """SELECT conv_id, batch, string_agg(text, '|' ORDER BY turn) AS texts
        FROM (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 2 AS batch
              FROM conversations) GROUP BY conv_id, batch""",
    "language_batches": """SELECT lang, batch, count(*) AS n, min(doc_id) AS low, max(doc_id) AS high
        FROM (SELECT *, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 100 AS batch
              FROM documents) GROUP BY lang, batch""",
    "prefix_per_batch": f"""SELECT 'c-' || conv_id || '-' || batch || ':' || start || '-' || "end" AS id, turn
        FROM (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 2 AS batch
              FROM ({_wrapped()}))""",
    "term_vectors": f"SELECT doc_id, {_term_vector('text')} AS vector FROM documents",
    "client_vectors": """SELECT doc_id, length(text) || ',' || (length(text) - length(replace(text, 'e', ''))) || ',0'
        AS vector FROM documents""",
    "vector_upsert": _UPSERTED,
    "vector_merge": _UPSERTED,
    "latest_vectors": _UPSERTED,
    "vector_payload": f"SELECT {_SHOWN} FROM ({_LABELLED}) WHERE source = 'embedding'",
    "vector_fetch": f"""SELECT {_SHOWN} FROM ({_LABELLED}) WHERE source = 'embedding'
        AND id IN (SELECT 'v' || doc_id FROM labels)""",
    "vector_count": f"SELECT count(DISTINCT id) AS vectors FROM ({_LABELLED})",
    "ingested_documents": _VECTORS,
    "document_vectors": _VECTORS,
    "streamed_documents": _VECTORS,
    "vector_compacted": _UPSERTED,
    "vector_lookup": f"SELECT * FROM ({_UPSERTED}) WHERE id IN (SELECT 'v' || doc_id FROM labels)",
    "ingested_with_metadata": f"""SELECT d.lang || ':' || v.id AS id, vector, d.lang, 0 AS part FROM ({_VECTORS}) v
        JOIN documents d ON starts_with(v.id, 'documents/' || d.doc_id || ':')""",
    "replaced_objects": _vectors(_resized(_not_blank(_whole_healed(_HALVED)), "object_id", 5, 30)),
}
