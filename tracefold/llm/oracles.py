"""SQL of the queries, for those that SQL can express on whole tables."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

def _share(name: str, nodes: str, parent: str, own: str) -> str:
    """Capped shares of ``given`` among the children of ``nodes`` (parent, own, weight, cap, given)."""
    by = f"PARTITION BY {parent}" if parent else ""
    keys = f"{parent}, {own}" if parent else own
    return f"""
{name}_a AS (SELECT *, coalesce(sum(cap) OVER ({by} ORDER BY cap / weight, {own} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef,
             sum(weight) OVER ({by} ORDER BY cap / weight, {own} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM ({nodes})),
{name}_b AS (SELECT *, cap::HUGEINT * ws + bef * weight <= given::HUGEINT * weight AS is_full FROM {name}_a),
{name}_c AS (SELECT *, coalesce(sum(cap) FILTER (is_full) OVER ({by}), 0) AS used, sum(weight) FILTER (NOT is_full) OVER ({by}) AS op FROM {name}_b),
{name} AS (SELECT {keys}, (CASE WHEN is_full THEN cap ELSE (given - used)::HUGEINT * weight // op END)::BIGINT AS tokens FROM {name}_c)"""


MIXING = f"""
WITH d AS (SELECT doc_id, CASE TRY_CAST(regexp_extract(source, '[0-9]+$') AS INT) % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'code' ELSE 'other' END AS domain,
                  lang, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS held FROM documents),
leaf AS (SELECT domain, lang, source, sum(held)::BIGINT AS held FROM d WHERE source IS DISTINCT FROM 'src19' GROUP BY ALL HAVING sum(held) > 0),
{_share("l0", """SELECT domain, (sum(held) * 4)::BIGINT AS cap, CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'code' THEN 2 ELSE 1 END AS weight,
        (SELECT sum(held) FROM d)::BIGINT AS given FROM leaf GROUP BY domain""", "", "domain")},
{_share("l1", """SELECT domain, lang, (sum(held) * 4)::BIGINT AS cap, CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS weight,
        any_value(tokens) AS given FROM leaf JOIN l0 USING (domain) GROUP BY domain, lang""", "domain", "lang")},
{_share("l2", """SELECT domain, lang, source, held * 4 AS cap, 1 AS weight, tokens AS given FROM leaf JOIN l1 USING (domain, lang)""", "domain, lang", "source")},
ends AS (SELECT domain, lang, source, tokens // held AS epochs, tokens % held AS rest FROM leaf JOIN l2 USING (domain, lang, source)),
placed AS (SELECT *, md5('17:' || epochs || ':' || doc_id) AS place FROM d JOIN ends USING (domain, lang, source) WHERE held > 0),
run AS (SELECT *, sum(held) OVER (PARTITION BY domain, lang, source ORDER BY place) AS upto FROM placed),
took AS (SELECT *, least(held, greatest(0, rest - (upto - held)))::BIGINT AS last FROM run),
rep AS (SELECT *, unnest(range(0, epochs + CASE WHEN last > 0 THEN 1 ELSE 0 END)) AS epoch FROM took)
SELECT doc_id, domain, lang, source, epoch, held AS n_tokens, CASE WHEN epoch < epochs THEN held ELSE last END AS take_tokens FROM rep
"""

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
wins AS (SELECT r, i, array_to_string(w[i:i+4], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM wins) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + o) AS n FROM dup, range(0, 5) t(o) GROUP BY r),
lines AS (SELECT r, source, line, len(regexp_extract_all(line, '{WORD}')) AS words,
                 regexp_replace(trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), '[0-9]+', '0', 'g') AS norm
          FROM (SELECT r, source, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{WORD}')),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
often AS (SELECT source, norm FROM lines GROUP BY ALL HAVING count(DISTINCT r) > 50),
gone AS (SELECT r, sum(words) AS n FROM lines SEMI JOIN often ON lines.source IS NOT DISTINCT FROM often.source AND lines.norm = often.norm GROUP BY r),
b AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dups.n, 0)::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS n_removed
      FROM d LEFT JOIN rep USING (r) LEFT JOIN dups USING (r) LEFT JOIN gone USING (r)),
c AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
SELECT *, NOT base_failed AND n_words - n_removed >= 10 AND n_words - n_removed >= 0.5 * n_words AS kept FROM c
"""

DECONTAMINATION = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s+n-1], ' ') AS k
       FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
             FROM (SELECT item_id, w, least(10, len(w)) AS n FROM i WHERE len(w) > 0))),
dw AS (SELECT doc_id, n, s, array_to_string(w[s:s+n-1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
m AS (SELECT doc_id, s, dw.n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.k = iw.k),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM m) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN l USING (doc_id)
"""

LINE_DEDUP = r"""
WITH lines AS (SELECT doc_id, p, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
               FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS p
                     FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
often AS (SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT doc_id, p, line, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM lines LEFT JOIN often USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to FROM f
"""

SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
wins AS (SELECT doc_id, s, md5(array_to_string(w[s:s+19], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d)),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM wins) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, s + o AS p FROM later, range(0, 20) t(o)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


SEARCH = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
c AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS words FROM d WHERE len(w) > 0),
q AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(w) AS term FROM i) GROUP BY ALL),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM p, c GROUP BY term, docs),
s AS (SELECT i, item_id, r, doc_id, sum(times * weight * (1000000000 * tf // (1000 * tf + 8 * (25 + 75 * n * docs // words))))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN p USING (term), c GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""


def all_sql() -> dict[str, str]:
    return {
        "op3_mixing": MIXING,
        "op4_quality_rules": QUALITY,
        "op5_decontamination": DECONTAMINATION,
        "op7_line_dedup": LINE_DEDUP,
        "op8_warc": WARC,
        "op10_substring_dedup": SUBSTRING_DEDUP,
        "op13_lexical_search": SEARCH,
    }
