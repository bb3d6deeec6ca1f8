"""SQL (DuckDB) for the results of the license scan and of the quality rules."""

from __future__ import annotations

from millrace.llm import divergence as D
from millrace.llm import licenses as L


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _wide(pattern: str) -> str:
    """A rule's pattern over a text in which every word has a space on each side, so that no look-around is needed."""
    bare = pattern.removeprefix("(?i)(?<![^ ])").removesuffix("(?![^ ])")
    return "(?i) " + bare.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(?:  )?") + " "


def license_sql() -> str:
    rules = ",\n".join(
        f"({i}, {_text(r.label)}, {r.priority}, {_text(r.keyword)}, {_text(_wide(r.pattern))}, {str(r.base).lower()})" for i, r in enumerate(L.rules()))
    count = lambda c: f"(length({c}) - length(replace({c}, ' ', ''))) // 2"
    return rf"""
WITH rules(rule, label, priority, keyword, pattern, base) AS (VALUES {rules}),
n AS (SELECT row_number() OVER () AS rid, doc_id,
    trim(regexp_replace(coalesce(text, ''), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g'), ' ') AS norm FROM documents),
p AS (SELECT *, ' ' || replace(norm, ' ', '  ') || ' ' AS wide,
    (CASE WHEN norm = '' THEN 0 ELSE length(norm) - length(replace(norm, ' ', '')) + 1 END)::BIGINT AS n_words FROM n),
t AS (SELECT rid, rule, label, priority, base, string_split_regex(wide, pattern) AS pieces, regexp_extract_all(wide, pattern) AS matches
    FROM p JOIN rules ON contains(' ' || lower(norm) || ' ', keyword) WHERE regexp_matches(wide, pattern)),
u AS (SELECT rid, rule, label, priority, base, i, pieces[i] AS piece, matches[i] AS hit
    FROM (SELECT *, unnest(range(1, len(matches) + 1)) AS i FROM t)),
v AS (SELECT *, {count('piece')} AS before, {count('hit')} AS inside FROM u),
f AS (SELECT rid, rule, label, priority, base, inside,
    sum(before) OVER (PARTITION BY rid, rule ORDER BY i) + coalesce(sum(inside) OVER (PARTITION BY rid, rule ORDER BY i
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM v),
g AS (SELECT *, start + inside AS stop FROM f),
o AS (SELECT *, max(stop) OVER (PARTITION BY rid ORDER BY start, stop DESC, priority, rule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM g),
q AS (SELECT *, lag(stop) OVER w AS stop_before, lag(priority) OVER w AS priority_before, lead(start) OVER w AS start_after,
    lead(priority) OVER w AS priority_after FROM o WHERE reach IS NULL OR reach < stop WINDOW w AS (PARTITION BY rid ORDER BY start)),
k AS (SELECT * FROM q WHERE NOT coalesce(stop_before > start AND priority_before <= priority, false)
    AND NOT coalesce(start_after < stop AND priority_after < priority, false)),
c AS (SELECT *, least(stop, coalesce(lead(start) OVER (PARTITION BY rid ORDER BY start), stop)) - start AS covered FROM k),
b AS (SELECT rid, count(*) AS n_base, min(start)::BIGINT AS first_word, max(start)::BIGINT AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM g WHERE base GROUP BY rid),
s AS (SELECT rid, sum(covered) AS covered FROM c GROUP BY rid),
a AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT rid, label FROM c UNION SELECT rid, label FROM g WHERE base) GROUP BY rid)
SELECT doc_id, n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
    coalesce(labels, '') AS labels, coalesce(covered::DOUBLE / n_words, 0) AS score
FROM p LEFT JOIN b USING (rid) LEFT JOIN s USING (rid) LEFT JOIN a USING (rid)"""


def divergence_sql() -> str:
    words = ", ".join(f"({_text(lang)}, {i}, {_text(w)})" for lang, ws in D.COMMON_WORDS.items() for i, w in enumerate(ws))
    kept = lambda chars: f"length(regexp_replace(text, '{chars}', '', 'g'))"
    part = lambda x: f"CASE WHEN {x} > 0 THEN {x} * log2({x} / ((p + q) / 2)) ELSE 0 END"
    return rf"""
WITH words(lang, k, word) AS (VALUES {words}),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, lang, source,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
x AS (SELECT rid, i, array_to_string(words[i : i + 7], ' ') AS g FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM d WHERE len(words) >= 8)),
r AS (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS later FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM x) WHERE n > 1),
c AS (SELECT rid, sum(least(8, coalesce(later - i, 8)))::BIGINT AS n_repeat_words FROM r GROUP BY rid),
l AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
b AS (SELECT rid, doc_id, lang, source, text, len(words)::BIGINT AS n_words, coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, length(text) AS n,
    {kept('[^a-z]+')} AS lo, {kept('[^A-Z]+')} AS up, {kept('[^0-9]+')} AS di, {kept(r'[\x00-\x7F]+')} AS be
    FROM d LEFT JOIN l USING (rid) LEFT JOIN c USING (rid)),
ch AS (SELECT rid, lang, source, unnest(range(7)) AS k, unnest([lo, up, di, n - word_chars, n_symbols, word_chars - lo - up - di - n_symbols - be, be]) AS n FROM b),
wo AS (SELECT rid, b.lang, source, k, (length(plain) - length(replace(plain, ' ' || word || ' ', ''))) // (length(word) + 2) AS n
    FROM (SELECT rid, lang, source, ' ' || regexp_replace(lower(text), '[^\p{{L}}]+', '  ', 'g') || ' ' AS plain FROM b) b JOIN words ON b.lang = words.lang),
co AS (SELECT rid, lang, source, k, n FROM wo UNION ALL
    SELECT rid, any_value(wo.lang), any_value(wo.source), max(k) + 1, greatest(any_value(n_words), sum(n)) - sum(n) FROM wo JOIN (SELECT rid, n_words FROM b) USING (rid) GROUP BY rid),
h AS (SELECT 'c' AS kind, * FROM ch UNION ALL SELECT 'w', * FROM co),
sh AS (SELECT kind, rid, lang, source, k, n::DOUBLE / greatest(sum(n) OVER (PARTITION BY kind, rid), 1) AS p FROM h),
lw AS (SELECT lang, sum(n_words) AS ref_words FROM b GROUP BY lang),
cm AS (SELECT sh.*, b.n_words, b.n FROM sh JOIN b USING (rid)
    WHERE (kind = 'c' AND b.n >= {D.MIN_CHARS_COMPARED}) OR (kind = 'w' AND n_words >= {D.MIN_WORDS_COMPARED})),
ms AS (SELECT kind, lang, source, k, median(floor(p * {D.SHARE_BINS})) AS m FROM cm GROUP BY ALL),
ml AS (SELECT kind, lang, k, floor(median(m) * 4) AS m FROM ms GROUP BY ALL),
us AS (SELECT kind, lang, k, m / greatest(sum(m) OVER (PARTITION BY kind, lang), 1) AS q FROM ml),
js AS (SELECT cm.kind, rid, any_value(n_words) AS n_words, any_value(n) AS n, max(cm.k) AS degrees, greatest(sum({part('p')} + {part('q')}) / 2, 0) AS divergence
    FROM cm JOIN us ON cm.kind = us.kind AND cm.k = us.k AND cm.lang IS NOT DISTINCT FROM us.lang
    JOIN lw ON cm.lang IS NOT DISTINCT FROM lw.lang WHERE ref_words >= {D.MIN_REFERENCE_WORDS} GROUP BY cm.kind, rid),
far AS (SELECT DISTINCT rid FROM js WHERE divergence > CASE kind WHEN 'c' THEN {D.CHAR_SLACK} + {D.CHAR_CHANCE} / n
    ELSE {D.WORD_SLACK} + (degrees + sqrt(2 * degrees) * {D.WORD_DEVIATIONS}) / (8 * ln(2)) / n_words END),
e AS (SELECT *, n_words < {D.MIN_WORDS} OR 100 * n_repeat_words > {D.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND rid NOT IN (SELECT rid FROM far) AS kept
FROM e"""


def substring_sql() -> str:
    return r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS nth FROM x),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS k FROM f WHERE nth > 1),
a AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
s AS (SELECT a.doc_id, count(*) FILTER (gone.k IS NOT NULL) AS n_removed, string_agg(word, ' ' ORDER BY a.k) FILTER (gone.k IS NULL) AS kept
    FROM a LEFT JOIN gone ON a.doc_id = gone.doc_id AND a.k = gone.k GROUP BY a.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)"""


def decontamination_sql() -> str:
    words = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return rf"""
WITH i AS (SELECT *, least(5, len(w)) AS n FROM (SELECT row_number() OVER () AS rid, item_id, {words} AS w FROM benchmark)),
ig AS (SELECT DISTINCT rid, item_id, n, array_to_string(w[k : k + n - 1], ' ') AS g
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM i WHERE n > 0)),
d AS (SELECT row_number() OVER () AS did, doc_id, {words} AS w FROM documents),
dg AS (SELECT DISTINCT did, doc_id, n, array_to_string(w[k : k + n - 1], ' ') AS g
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM i WHERE n > 0) WHERE len(w) >= n))
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item
FROM (SELECT *, count(*) OVER (PARTITION BY rid) AS n_item FROM ig) ig JOIN dg USING (n, g)
GROUP BY did, doc_id, rid, item_id HAVING count(*) >= 0.8 * any_value(n_item) - 1e-9"""


def infill_sql() -> str:
    """Units as a list, cut by position and put together again; the restored text is the text."""
    return r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
            ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
    c AS (SELECT *, len(u)::BIGINT AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
    p AS (SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
    FROM p
    """
