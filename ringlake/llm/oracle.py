"""The same queries as SQL for another engine, where SQL expresses them."""

from ringlake.llm.chat import CONTROL, END, MARK, SAYS, TURN

OP8 = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source
), shares AS (
  SELECT *, 3 * source_size AS ceiling,
         CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
           ORDER BY 3 * source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS left_over,
         CAST(sum(weight) OVER (
           ORDER BY 3 * source_size / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS weights_left
  FROM sources
), free AS (
  SELECT left_over AS free_words, weights_left AS free_weights FROM shares
  WHERE ceiling * weights_left > weight * left_over ORDER BY weights_left DESC LIMIT 1
), targets AS (
  SELECT source, source_size,
         CASE WHEN ceiling * weights_left <= weight * left_over THEN CAST(ceiling AS DOUBLE)
              ELSE (weight * free_words) / free_weights END AS target,
         CASE WHEN ceiling * weights_left <= weight * left_over THEN ceiling
              ELSE (weight * free_words) // free_weights END AS budget
  FROM shares LEFT JOIN free ON true
), placed AS (
  SELECT doc_id, size, source_size, target, budget,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, size, doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN CAST(0 AS BIGINT) ELSE CAST((budget // source_size) * size
         + greatest(0, least(size, budget % source_size - before)) AS BIGINT) END AS taken
FROM placed
"""



def _escaped(text: str) -> str:
    out = f"replace({text}, '{MARK}', '{MARK}0')"
    for word in CONTROL:
        out = f"replace({out}, '{word}', '{word[0]}{MARK}1{word[1:]}')"
    return out


# Formatted length: the markers of each turn, and its escaped role and text.
OP3 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), each AS (
  SELECT *, {_escaped("text")} AS content, {len(TURN) + len(SAYS) + len(END)} + length({_escaped("role")}) + length({_escaped("text")}) AS chars FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, content)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, content) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM each GROUP BY conv_id
"""

OP13 = r"""
WITH words AS (
  SELECT row_number() OVER () AS doc, doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), counts AS (
  SELECT doc, doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), sizes AS (
  SELECT doc, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc
), totals AS (
  SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sizes
), held AS (
  SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, totals GROUP BY term, all_docs
), asked AS (
  SELECT item, item_id, term, count(*) AS times
  FROM (SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark)
  GROUP BY ALL
), scored AS (
  SELECT item, item_id, doc, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * all_docs) // all_terms)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN counts USING (term) JOIN sizes USING (doc), totals
  GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 20
"""

ORACLE_SQL: dict[str, str] = {"op3_chat_parts": OP3, "op8_mix_budgets": OP8, "op13_lemp_buckets": OP13}
