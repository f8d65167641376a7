"""The results of the queries in DuckDB's SQL, for those that SQL can express."""

OP9_DECONTAMINATION = r"""
WITH folded AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '),
    lambda w: w <> '') AS words
  FROM documents
), item_words AS (
  SELECT item_id, list_filter(string_split(regexp_replace(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '),
    lambda w: w <> '') AS words
  FROM benchmark
), windows AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(words), 10) AS width,
    array_to_string(words[i:i + 9], ' ') AS win
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM item_words WHERE len(words) > 0)
), widths AS (SELECT DISTINCT width FROM windows
), places AS (
  SELECT doc_id, width, i, array_to_string(words[i:i + width - 1], ' ') AS win
  FROM (SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS i FROM folded, widths WHERE len(words) >= width)
), found AS (SELECT doc_id, places.width, i, item FROM places JOIN windows USING (win)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM found GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM folded LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _op7(rounds: int = 60, damping: float = 0.85) -> str:
    """Rules by a window over those that fit; the walks as one step of SQL for each round."""
    steps = "".join(
        f""", walk{n} AS (
  SELECT kind, host, sum(score) AS score FROM (
    SELECT w.kind, s.onto AS host, w.score * s.share * {damping} AS score FROM walk{n - 1} w JOIN steps s ON s.kind = w.kind AND s.host = w.host
    UNION ALL SELECT kind, host, start * {1 - damping} FROM seeds) GROUP BY kind, host)"""
        for n in range(1, rounds + 1)
    )
    return rf"""
WITH rules(verdict, rule) AS (VALUES ('block', 'net/'), ('allow', 'example.net/en/'), ('block', 'example.com/de/'), ('allow', 'org/fr/')),
rows AS (
  SELECT page_id, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS (
  SELECT page_id, host, path, rule, verdict FROM rows LEFT JOIN rules ON
    (host = split_part(rule, '/', 1) OR suffix(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, strpos(rule, '/')))
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1
), counts AS (
  SELECT host, count(*) AS pages, count_if(verdict = 'allow') AS allowed, count_if(verdict = 'block') AS blocked
  FROM ruled WHERE host <> '' GROUP BY host
), chosen AS (
  SELECT 'trust' AS kind, host, allowed AS weight FROM counts WHERE allowed > 0 AND allowed >= pages * 0.5
  UNION ALL SELECT 'distrust', host, blocked FROM counts WHERE blocked > 0 AND blocked >= pages * 0.5
), seeds AS (SELECT kind, host, weight / sum(weight) OVER (PARTITION BY kind) AS start FROM chosen
), links AS (
  SELECT host AS source, unnest(list_distinct(regexp_extract_all(html, '(?i)href\s*=\s*["'']?((?:https?:)?//[^"''\s>]+)', 1))) AS link
  FROM rows WHERE host <> ''
), edges AS (
  SELECT source, target, count(*) AS links FROM (SELECT source,
    translate(regexp_extract(CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target FROM links)
  WHERE target <> '' AND source <> target GROUP BY source, target
), steps AS (
  SELECT 'trust' AS kind, source AS host, target AS onto, links / sum(links) OVER (PARTITION BY source) AS share FROM edges
  UNION ALL SELECT 'distrust', target, source, links / sum(links) OVER (PARTITION BY target) FROM edges
), walk0 AS (SELECT kind, host, start AS score FROM seeds){steps}
, shares AS (SELECT kind, host, score / sum(score) OVER (PARTITION BY kind) AS score FROM walk{rounds}
), hosts AS (
  SELECT host, sum(CASE WHEN kind = 'distrust' THEN score ELSE -score END) AS gap FROM shares GROUP BY host
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN coalesce(gap, 0) > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN hosts USING (host)
"""


OP7_URL_FILTERS = _op7()


_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _op4(threshold: float = 0.6) -> str:
    """All lines against all templates, weighted by document frequencies of all terms.

    The telling terms of the operator only save work.
    """
    from .licences import TEMPLATES

    values = ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(TEMPLATES))

    def terms(text: str) -> str:
        return f"regexp_extract_all({_FOLD.format(text)}, '[a-z0-9]+')"

    return rf"""
WITH templates(template, name, statement) AS (VALUES {values}),
files AS (
  SELECT doc_id, text, array_to_string(list_slice(shelf, 1, CASE WHEN licensed THEN 1 + doc_id % 3 ELSE 3 END), '/')
    || '/' || CASE WHEN licensed THEN 'LICENSE-' ELSE 'text-' END || doc_id AS path, licensed
  FROM (SELECT doc_id, coalesce(text, '') AS text, [coalesce(source, 'none'), coalesce(lang, 'none'), CAST(doc_id // 32 AS VARCHAR)] AS shelf,
      regexp_matches(coalesce(text, ''), '(?i)licen[cs]ed?[^\n]*\s*$') AS licensed FROM documents)
), wanted AS (
  SELECT template, name, term, count(*) AS tf FROM (SELECT template, name, unnest({terms('statement')}) AS term FROM templates) GROUP BY ALL
), having_term AS (
  SELECT term, count(*) AS n FROM (SELECT DISTINCT path, unnest({terms('text')}) AS term FROM files) GROUP BY term
), total AS (SELECT count(*) AS files FROM files
), scales AS (
  SELECT term, ln((1 + files) / (1.0::DOUBLE + coalesce(n, 0))) + 1 AS idf
  FROM (SELECT term FROM wanted UNION SELECT term FROM having_term) LEFT JOIN having_term USING (term), total
), weights AS (
  SELECT template, name, term, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY template)) AS weight FROM wanted JOIN scales USING (term)
), blocks AS (
  SELECT path, unnest(range(len(string_split(text, chr(10))))) AS line, unnest(string_split(text, chr(10))) AS block FROM files
  UNION ALL SELECT path, -1, text FROM files WHERE licensed
), counted AS (
  SELECT path, line, term, count(*) AS tf FROM (SELECT path, line, unnest({terms('block')}) AS term FROM blocks) GROUP BY ALL
), norms AS (
  SELECT path, line, sqrt(sum((tf * idf) ** 2)) AS norm FROM counted JOIN scales USING (term) GROUP BY path, line
), close AS (
  SELECT path, name, round(sum(tf * idf * weight) / any_value(norm), 4) AS cosine
  FROM counted JOIN scales USING (term) JOIN weights USING (term) JOIN norms USING (path, line) GROUP BY path, line, template, name
), own AS (
  SELECT path, name AS licence, cosine FROM close WHERE cosine >= {threshold}
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY cosine DESC, name) = 1
), placed AS (SELECT doc_id, path, regexp_replace(path, '/[^/]*$', '') AS directory, licensed FROM files
), holders AS (
  SELECT directory AS above, path AS origin, licence, cosine FROM own JOIN placed USING (path) WHERE licensed
  QUALIFY row_number() OVER (PARTITION BY directory ORDER BY cosine DESC, path) = 1
), steps AS (
  SELECT directory, depth, array_to_string(string_split(directory, '/')[1:depth], '/') AS above
  FROM (SELECT directory, unnest(range(len(string_split(directory, '/')) + 1)) AS depth FROM (SELECT DISTINCT directory FROM placed))
), nearest AS (
  SELECT directory, origin, licence, cosine FROM steps JOIN holders USING (above)
  QUALIFY row_number() OVER (PARTITION BY directory ORDER BY depth DESC) = 1
)
SELECT doc_id, path, coalesce(own.licence, nearest.licence) AS licence, coalesce(own.cosine, nearest.cosine) AS cosine,
  CASE WHEN own.licence IS NOT NULL THEN 'own' WHEN nearest.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS basis,
  CASE WHEN own.licence IS NOT NULL THEN path ELSE origin END AS origin
FROM placed LEFT JOIN own USING (path) LEFT JOIN nearest USING (directory)
"""


OP4_LICENSE_SCANS = _op4()


OP3_SUFFIX_ARRAY_DEDUP = r"""
WITH docs AS (
  SELECT doc_id, encode(coalesce(text, '')) AS bytes, octet_length(encode(coalesce(text, ''))) AS n_bytes FROM documents
), strings AS (
  SELECT doc_id, place, bytes[place + 1:place + 50] AS s
  FROM (SELECT doc_id, bytes, unnest(range(0, n_bytes - 49)) AS place FROM docs WHERE n_bytes >= 50)
), firsts AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s
), repeated AS (
  SELECT doc_id, place, place > lag(place, 1, -51) OVER (PARTITION BY doc_id ORDER BY place) + 50 AS opens
  FROM strings JOIN firsts USING (s) WHERE doc_id > first
), runs AS (
  SELECT doc_id, min(place) AS start, max(place) + 50 AS stop
  FROM (SELECT doc_id, place, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY place) AS run FROM repeated)
  GROUP BY doc_id, run
), edges AS (
  SELECT source, target, count(*) AS links FROM (SELECT source,
    translate(regexp_extract(CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target FROM links)
  WHERE target <> '' AND source <> target GROUP BY source, target
), steps AS (
  SELECT 'trust' AS kind, source AS host, target AS onto, links / sum(links) OVER (PARTITION BY source) AS share FROM edges
  UNION ALL SELECT 'distrust', target, source, links / sum(links) OVER (PARTITION BY target) FROM edges
), walk0 AS (SELECT kind, host, start AS score FROM seeds){steps}
, shares AS (SELECT kind, host, score / sum(score) OVER (PARTITION BY kind) AS score FROM walk{rounds}
), hosts AS (
  SELECT host, sum(CASE WHEN kind = 'distrust' THEN score ELSE -score END) AS gap FROM shares GROUP BY host
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN coalesce(gap, 0) > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN hosts USING (host)
"""


OP7_URL_FILTERS = _op7()


_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _op4(threshold: float = 0.6) -> str:
    """All lines against all templates, weighted by document frequencies of all terms.

    The telling terms of the operator only save work.
    """
    from .licences import TEMPLATES

    values = ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(TEMPLATES))

    def terms(text: str) -> str:
        return f"regexp_extract_all({_FOLD.format(text)}, '[a-z0-9]+')"

    return rf"""
WITH templates(template, name, statement) AS (VALUES {values}),
files AS (
  SELECT doc_id, text, array_to_string(list_slice(shelf, 1, CASE WHEN licensed THEN 1 + doc_id % 3 ELSE 3 END), '/')
    || '/' || CASE WHEN licensed THEN 'LICENSE-' ELSE 'text-' END || doc_id AS path, licensed
  FROM (SELECT doc_id, coalesce(text, '') AS text, [coalesce(source, 'none'), coalesce(lang, 'none'), CAST(doc_id // 32 AS VARCHAR)] AS shelf,
      regexp_matches(coalesce(text, ''), '(?i)licen[cs]ed?[^\n]*\s*$') AS licensed FROM documents)
), wanted AS (
  SELECT template, name, term, count(*) AS tf FROM (SELECT template, name, unnest({terms('statement')}) AS term FROM templates) GROUP BY ALL
), having_term AS (
  SELECT term, count(*) AS n FROM (SELECT DISTINCT path, unnest({terms('text')}) AS term FROM files) GROUP BY term
), total AS (SELECT count(*) AS files FROM files
), scales AS (
  SELECT term, ln((1 + files) / (1.0::DOUBLE + coalesce(n, 0))) + 1 AS idf
  FROM (SELECT term FROM wanted UNION SELECT term FROM having_term) LEFT JOIN having_term USING (term), total
), weights AS (
  SELECT template, name, term, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY template)) AS weight FROM wanted JOIN scales USING (term)
), blocks AS (
  SELECT path, unnest(range(len(string_split(text, chr(10))))) AS line, unnest(string_split(text, chr(10))) AS block FROM files
  UNION ALL SELECT path, -1, text FROM files WHERE licensed
), counted AS (
  SELECT path, line, term, count(*) AS tf FROM (SELECT path, line, unnest({terms('block')}) AS term FROM blocks) GROUP BY ALL
), norms AS (
  SELECT path, line, sqrt(sum((tf * idf) ** 2)) AS norm FROM counted JOIN scales USING (term) GROUP BY path, line
), close AS (
  SELECT path, name, round(sum(tf * idf * weight) / any_value(norm), 4) AS cosine
  FROM counted JOIN scales USING (term) JOIN weights USING (term) JOIN norms USING (path, line) GROUP BY path, line, template, name
), own AS (
  SELECT path, name AS licence, cosine FROM close WHERE cosine >= {threshold}
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY cosine DESC, name) = 1
), placed AS (SELECT doc_id, path, regexp_replace(path, '/[^/]*$', '') AS directory, licensed FROM files
), holders AS (
  SELECT directory AS above, path AS origin, licence, cosine FROM own JOIN placed USING (path) WHERE licensed
  QUALIFY row_number() OVER (PARTITION BY directory ORDER BY cosine DESC, path) = 1
), steps AS (
  SELECT directory, depth, array_to_string(string_split(directory, '/')[1:depth], '/') AS above
  FROM (SELECT directory, unnest(range(len(string_split(directory, '/')) + 1)) AS depth FROM (SELECT DISTINCT directory FROM placed))
), nearest AS (
  SELECT directory, origin, licence, cosine FROM steps JOIN holders USING (above)
  QUALIFY row_number() OVER (PARTITION BY directory ORDER BY depth DESC) = 1
)
SELECT doc_id, path, coalesce(own.licence, nearest.licence) AS licence, coalesce(own.cosine, nearest.cosine) AS cosine,
  CASE WHEN own.licence IS NOT NULL THEN 'own' WHEN nearest.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS basis,
  CASE WHEN own.licence IS NOT NULL THEN path ELSE origin END AS origin
FROM placed LEFT JOIN own USING (path) LEFT JOIN nearest USING (directory)
"""


OP4_LICENSE_SCANS = _op4()


OP3_SUFFIX_ARRAY_DEDUP = r"""
WITH docs AS (
  SELECT doc_id, encode(coalesce(text, '')) AS bytes, octet_length(encode(coalesce(text, ''))) AS n_bytes FROM documents
), strings AS (
  SELECT doc_id, place, bytes[place + 1:place + 50] AS s
  FROM (SELECT doc_id, bytes, unnest(range(0, n_bytes - 49)) AS place FROM docs WHERE n_bytes >= 50)
), firsts AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s
), removed AS (
  SELECT DISTINCT doc_id, unnest(range(place, place + 50)) AS place FROM strings JOIN firsts USING (s) WHERE doc_id > first
), runs AS (
  SELECT doc_id, min(place) AS start, max(place) + 1 AS stop
  FROM (SELECT doc_id, place, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run FROM removed) GROUP BY doc_id, run
), edges AS (
  SELECT doc_id, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS start, start AS stop FROM runs
  UNION ALL SELECT doc_id, max(stop), NULL FROM runs GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(hex(bytes[start + 1:coalesce(stop, n_bytes)]), '' ORDER BY start) AS bytes
  FROM edges JOIN docs USING (doc_id) GROUP BY doc_id
), sums AS (SELECT doc_id, sum(stop - start) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT docs.doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(coalesce(unhex(kept.bytes), docs.bytes)) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""

OP11_EXACT_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

OP12_SPELLING_VARIANTS = r"""
WITH RECURSIVE table_of AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, run, count(*) AS times FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents) GROUP BY ALL
), bytes AS (
  SELECT run, times, hex(encode(doc || ':' || run)) AS x FROM runs
), hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i:
      (strpos('0123456789ABCDEF', substr(x, i, 1)) - 1) * 16 + strpos('0123456789ABCDEF', substr(x, i + 1, 1)) - 1)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM bytes, table_of
), words AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), cut AS (
  SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT x.word, y.word AS other FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word FROM cut x JOIN words y ON x.a || x.b = y.word
  UNION SELECT y.word, x.word FROM cut x JOIN words y ON x.a || x.b = y.word
), ranked AS (
  SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near
  FROM near JOIN words o ON o.word = other
  QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) = 1
), formed AS MATERIALIZED (
  SELECT words.word, n, CASE WHEN other_n >= 2 * n THEN other END AS form, coalesce(n_near, 0) AS n_near,
    CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words LEFT JOIN ranked USING (word)
), chain AS (
  SELECT word, word AS place, 0 AS step FROM formed
  UNION ALL SELECT chain.word, formed.form, step + 1 FROM chain JOIN formed ON formed.word = chain.place AND formed.form IS NOT NULL
)
SELECT formed.word, n, form, root, n_near, form_n
FROM formed JOIN (SELECT word, arg_max(place, step) AS root FROM chain GROUP BY word) USING (word)
"""

OP13_FILL_IN_MIDDLE = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), numbers AS (
  SELECT *, len(lines) AS n, list_transform(range(0, 4), lambda k: CAST('0x' || substr(digest, k * 8 + 1, 8) AS BIGINT)) AS h FROM cut
), parted AS (
  SELECT doc_id, text, n,
    array_to_string(lines[1:least(h[1] % (n + 1), h[2] % (n + 1))], '') AS prefix,
    array_to_string(lines[least(h[1] % (n + 1), h[2] % (n + 1)) + 1:greatest(h[1] % (n + 1), h[2] % (n + 1))], '') AS middle,
    array_to_string(lines[greatest(h[1] % (n + 1), h[2] % (n + 1)) + 1:], '') AS suffix,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
      WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parted
"""
