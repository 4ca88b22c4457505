"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

OP8 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, regexp_replace(role, '(<|\[)(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g') AS role_out,
    regexp_replace(text, '(<|\[)(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g') AS text_out
  FROM rows
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(length(role_out) + length(text_out) + 20) AS BIGINT) AS formatted_chars,
    string_agg(role, ',' ORDER BY turn, role, text) AS roles,
    list(text ORDER BY turn, role, text)[2] AS second
  FROM marked GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars,
  CASE WHEN roles = 'user,assistant' THEN 'prompt'
    WHEN roles = 'system,user,assistant' AND second <> '' THEN 'instruction'
    ELSE 'messages' END AS layout
FROM whole
"""


def _level(name: str, family: str, nodes: str, out: str) -> str:
    """CTEs that part each family's budget among its members."""
    part = f"PARTITION BY {family}" if family else ""
    columns = f"{family}, {name}" if family else name
    return f"""
{out}_ranked AS (
  SELECT *,
    coalesce(sum(held) OVER ({part} ORDER BY held / weight, {name}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER ({part} ORDER BY held / weight, {name}
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM ({nodes})
), {out}_marked AS (
  SELECT *, CAST(held AS HUGEINT) * weight_left <= (CAST(budget AS HUGEINT) - before) * weight AS is_full
  FROM {out}_ranked
), {out}_parted AS (
  SELECT *, budget - sum(CASE WHEN is_full THEN held ELSE 0 END) OVER ({part}) AS rest,
    sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({part} ORDER BY held / weight, {name}
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({part}) AS total_open
  FROM {out}_marked
), {out} AS (
  SELECT {columns}, CAST(CASE WHEN is_full THEN held
    ELSE (rest * upto) // total_open - (rest * (upto - weight)) // total_open END AS BIGINT) AS share
  FROM {out}_parted
)"""


OP2 = f"""
WITH counted AS (
  SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
    'domain' || (coalesce(TRY_CAST(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS INTEGER), 0) % 4) AS domain,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens
  FROM documents
), docs AS (
  SELECT doc_id, domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM counted
  WHERE tokens > 0 GROUP BY ALL
), supply AS (
  SELECT domain, lang, source, sum(tokens) AS tokens, 3 * sum(tokens) AS held FROM docs GROUP BY ALL
),{_level("domain", "", """
  SELECT domain, sum(held) AS held, (SELECT sum(tokens) * 4 // 5 FROM docs) AS budget,
    CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END AS weight
  FROM supply GROUP BY domain""", "by_domain")},{_level("lang", "domain", """
  SELECT s.domain, lang, sum(held) AS held, any_value(share) AS budget,
    CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 3 WHEN 'fr' THEN 3 WHEN 'es' THEN 2 ELSE 1 END AS weight
  FROM supply s JOIN by_domain d ON s.domain = d.domain GROUP BY s.domain, lang""", "by_lang")},{_level("source", "domain, lang", """
  SELECT s.domain, s.lang, source, held, share AS budget, 1 AS weight
  FROM supply s JOIN by_lang l ON s.domain = l.domain AND s.lang = l.lang""", "by_source")},
leaves AS (
  SELECT s.domain, s.lang, s.source, share // tokens AS whole, share % tokens AS part
  FROM supply s JOIN by_source b ON s.domain = b.domain AND s.lang = b.lang AND s.source = b.source
), ordered AS (
  SELECT d.*, whole, part, md5('7:' || CAST(whole AS BIGINT) || ':' || coalesce(CAST(doc_id AS VARCHAR), 'none')) AS key
  FROM docs d JOIN leaves l ON d.domain = l.domain AND d.lang = l.lang AND d.source = l.source
), placed AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM ordered
)
SELECT doc_id, domain, lang, source, tokens, CAST(unnest(range(CAST(whole AS BIGINT))) AS INTEGER) AS epoch, tokens AS taken
FROM placed
UNION ALL
SELECT doc_id, domain, lang, source, tokens, CAST(whole AS INTEGER), CAST(least(tokens, part - start) AS BIGINT)
FROM placed WHERE start < part
"""


OP7 = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages
), named AS (
  SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
    max(page_id) OVER (PARTITION BY hex, payload_bytes) AS first,
    list_aggregate(list_transform(range(8), lambda k: list_aggregate(list_transform([32768, 1024, 32, 1],
      lambda place: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((CAST('0x' || substr(hex, CAST(5 * k + 1 AS INTEGER), 5) AS INTEGER) // place) % 32 + 1 AS INTEGER), 1)
      ), 'string_agg', '')), 'string_agg', '') AS payload_digest
  FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM named
"""


OP11 = r"""
WITH cut AS (
  SELECT 'd' AS side, doc_id, row_number() OVER () AS row,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
  UNION ALL SELECT 'b', NULL, row_number() OVER (),
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark
), features AS (
  SELECT side, row, unnest(list_concat(words, list_transform(range(1, len(words)),
    lambda k: words[k] || ' ' || words[k + 1]))) AS feature
  FROM cut
), hashed AS (
  SELECT feature, 4294967295 - list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
      range(1, octet_length(encode(feature)) + 1),
      lambda k: list_transform(range(8), lambda j:
        (CAST('0x' || substr(hex(encode(feature)), CAST(2 * k - 1 AS INTEGER), 2) AS BIGINT) >> CAST(j AS INTEGER)) % 2)
    ))), lambda c, bit: xor(c >> 1, CASE WHEN xor(c, bit) % 2 = 1 THEN 3988292384 ELSE 0 END)) AS crc
  FROM (SELECT DISTINCT feature FROM features)
), known AS (
  SELECT side, row, crc % 10000 AS bucket, count(*) AS n
  FROM features JOIN hashed USING (feature) GROUP BY ALL
), sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
  FROM known GROUP BY bucket
), totals AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM sums
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(sums.t AS DOUBLE) + 1) * (CAST(totals.s AS DOUBLE) + 10000)
    / ((CAST(sums.s AS DOUBLE) + 1) * (CAST(totals.t AS DOUBLE) + 10000)))) AS BIGINT) AS gain
  FROM sums, totals
), weighed AS (
  SELECT row, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
  FROM known JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row
), scored AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
      AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM cut LEFT JOIN weighed USING (row) WHERE side = 'd'
), drawn AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
    25 * count(*) OVER (PARTITION BY n_words >= 20) // 100 AS most
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= most THEN place END AS rank
FROM drawn
"""


OP12 = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens,
    sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT *, len(tokens) AS n, list_transform(range(4), lambda k:
    CAST('0x' || substr(h, CAST(8 * k + 1 AS INTEGER), 8) AS BIGINT)) AS d
  FROM cut
), parted AS (
  SELECT doc_id, text, n, CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR d[3] % 100 >= 50 THEN 'plain'
      WHEN d[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(tokens[1:least(d[1] % (n + 1), d[2] % (n + 1))], '') AS prefix,
    array_to_string(tokens[least(d[1] % (n + 1), d[2] % (n + 1)) + 1:greatest(d[1] % (n + 1), d[2] % (n + 1))], '') AS middle,
    array_to_string(tokens[greatest(d[1] % (n + 1), d[2] % (n + 1)) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parted
"""


def llm_sql() -> dict[str, str]:
    return {
        "op2_hierarchical_budgets": OP2,
        "op7_seekable_warc": OP7,
        "op8_chat_schema_fingerprint": OP8,
        "op11_importance_resampling": OP11,
        "op12_fill_in_middle": OP12,
    }
