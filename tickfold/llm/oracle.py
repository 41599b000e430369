"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tickfold.llm.divergence import MIN_DOCS, TOP_TERMS
from tickfold.llm.licenses import KNOWN, SPELLINGS, notices, texts
from tickfold.llm.quality_rules import (FENCE, MAX_REPEAT_PERCENT, MILLION, MIN_GROUP, MIN_WORDS, QUANTILES,
                                        RATES, WINDOW)

OP5 = """
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

OP8 = """
WITH t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM t WHERE len(w) >= 13),
keyed AS (SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS k FROM win),
least AS (SELECT k, min(doc_id) AS low FROM keyed GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS i
  FROM keyed JOIN least USING (k) WHERE low < doc_id),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM t),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
"""

OP1 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS low FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id > low THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id > low THEN low END AS refers_to
FROM f
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    out = (f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    out = (f"regexp_replace({out}, '(?m)^[^a-z0-9\\n©]*(copyright|\\(c\\)|©|all rights reserved)"
           "([^a-z0-9\\n][^\\n]*)?$', ' ', 'g')")
    out = f"regexp_replace(replace({out}, '&', ' and '), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')"
    for old, new in SPELLINGS:
        out = f"regexp_replace({out}, '\\b{old}\\b', '{new}', 'g')"
    return f"sha256(trim({out}))"


OP3 = f"""
WITH known AS (
  SELECT min(license) AS license, {_canonical('text')} AS digest
  FROM (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in sorted({*KNOWN, *texts(), *notices()}))}) AS t(license, text) GROUP BY 2),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
hit AS (
  SELECT DISTINCT doc_id, license FROM line JOIN known ON {_canonical('line')} = digest WHERE line <> ''),
notice AS (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS notices FROM hit GROUP BY doc_id),
whole AS (SELECT doc_id, {_canonical('text')} AS text_digest FROM d)
SELECT doc_id, text_digest, license, notices
FROM whole LEFT JOIN known ON text_digest = digest LEFT JOIN notice USING (doc_id)
"""


def _cutoffs() -> str:
    rates = ", ".join(f"{{'rate': '{r}', 'v': CASE WHEN {bottom} > 0 THEN {top} * {MILLION} // {bottom} END}}"
                      for r, (top, bottom, _, _) in RATES.items())
    least = " ".join(f"WHEN '{r}' THEN {v[2]}" for r, v in RATES.items())
    both = ", ".join(f"'{r}'" for r, v in RATES.items() if v[3] == "both")
    quantile = ", ".join(f"min(cell) FILTER (upto * {b} >= docs * {a}) AS {q}" for q, (a, b) in QUANTILES.items())
    quantile += ", any_value(docs) AS docs"

    def grouped(*keys: str) -> str:
        by = ", ".join([*keys, "rate"])
        return f"""(
  SELECT {by}, {quantile} FROM (
    SELECT {by}, cell, sum(n) OVER (PARTITION BY {by}) AS docs, sum(n) OVER (PARTITION BY {by} ORDER BY cell) AS upto
    FROM (SELECT {by}, cell, count(*) AS n FROM sketched GROUP BY {by}, cell)) GROUP BY {by})"""

    def pick(q: str) -> str:
        return (f"CASE WHEN own.docs >= {MIN_GROUP} THEN own.{q} WHEN l.docs >= {MIN_GROUP} THEN l.{q} ELSE a.{q} END")

    return f"""
rated AS (
  SELECT doc_id, lang, source, base_failed, unnest([{rates}], recursive := true) FROM judged),
sketched AS (
  SELECT lang, source, rate, (v >> greatest(0, length(bin(v)) - 5)) << greatest(0, length(bin(v)) - 5) AS cell
  FROM rated WHERE NOT base_failed AND v IS NOT NULL),
cut AS (
  SELECT own.lang, own.source, own.rate, {pick('low')} AS ql, {pick('high')} AS qh,
         {FENCE} * CASE WHEN qh > ql THEN qh - ql ELSE CASE own.rate {least} END END AS apart,
         ql - apart AS low, qh + apart AS high
  FROM {grouped('lang', 'source')} own
  JOIN {grouped('lang')} l ON own.lang IS NOT DISTINCT FROM l.lang AND own.rate = l.rate
  JOIN {grouped()} a ON own.rate = a.rate),
verdict AS (
  SELECT doc_id, bool_and(coalesce(v <= high AND (r.rate NOT IN ({both}) OR v >= low), true)) AS ok
  FROM rated r LEFT JOIN cut ON r.lang IS NOT DISTINCT FROM cut.lang
    AND r.source IS NOT DISTINCT FROM cut.source AND r.rate = cut.rate
  GROUP BY doc_id)"""


OP10 = f"""
WITH t AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(w[s:s + {WINDOW - 1}], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS s FROM t WHERE len(w) >= {WINDOW})),
again AS (SELECT doc_id, s FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM win) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i) AS n
  FROM (SELECT doc_id, unnest(range(s, s + {WINDOW})) AS i FROM again) GROUP BY doc_id),
counted AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
         (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_upper,
         (length(text) - length(replace(text, '!', '')))::BIGINT AS n_marks
  FROM t LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM counted),{_cutoffs()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND ok AS kept
FROM judged JOIN verdict USING (doc_id)
"""


# CRC-32 (polynomial 0xEDB88320, reflected) byte by byte, with its table made by the same rule.
OP11 = """
WITH step AS (
  SELECT list(list_reduce(list_concat([i], range(8)),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS v
  FROM range(256) r(i)),
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS b
  FROM documents),
s AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(
           list_concat([4294967295], list_transform(b, lambda x: ('0x' || x)::BIGINT)),
           lambda c, x: xor(c >> 8, v[1 + (xor(c, x) & 255)]))) AS text_crc32,
         sum(size) OVER (ORDER BY doc_id) AS upto, sum(size) OVER () AS total
  FROM d, step),
cut AS (SELECT *, least(39, (2 * upto - size) * 40 // (2 * total)) AS shard FROM s)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INT AS grown_shard
FROM cut
"""

OP12 = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
word AS (SELECT doc_id, lang, source, unnest(w) AS term FROM d),
kept AS (
  SELECT lang, term, count(*) AS n_lang FROM word GROUP BY lang, term HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
own AS (SELECT lang, source, term, count(*) AS n FROM word GROUP BY ALL),
grp AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(lang_total, 0) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, count(*) AS v, sum(n_lang) AS lang_total FROM kept GROUP BY lang) USING (lang)),
counted AS (
  SELECT lang, source, term, v, n_lang, lang_total, coalesce(n, 0) AS n,
         sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total
  FROM grp JOIN kept USING (lang) LEFT JOIN own USING (lang, source, term)),
shared AS (
  SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 1) // (total + v)::HUGEINT AS p,
         1 + 1000000000::HUGEINT * (n_lang + 1) // (lang_total + v)::HUGEINT AS q FROM counted),
summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shared a JOIN shared b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
part AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shared WHERE n > 0 AND p > q)
SELECT * FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM part)
WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""


def oracle_sql():
    return {"op1_warc": OP1, "op3_licenses": OP3, "op5_exact_dedup": OP5, "op8_substring_dedup": OP8,
            "op10_quality_rules": OP10, "op11_sharding": OP11, "op12_divergence": OP12}
