"""SQL twins of the corpus queries that SQL can express, written independently of the operators."""

from __future__ import annotations

# -- op1: rules, and decisions carried along links -----------------------------------------

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _host(url: str) -> str:
    return f"coalesce(translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), {_LETTERS}), '')"


def _path(url: str) -> str:
    return f"coalesce(regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"


def _resource(url: str) -> str:
    query = f"coalesce(regexp_extract({url}, '(?s)^.*?://[^?#]*([?][^#]*)', 1), '')"
    path = _path(url)
    return (
        f"CASE WHEN {_host(url)} <> '' THEN {_host(url)} || "
        f"CASE WHEN {path} = '' THEN '/' ELSE {path} END || {query} END"
    )


def _attribute(name: str) -> str:
    value = f"""(?i)\\b{name}\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))"""
    return " || ".join(f"regexp_extract(tag, '{value}', {g})" for g in (1, 2, 3))


URL_FILTER = f"""WITH RECURSIVE rules(rule_host, rule_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rows_in AS (SELECT row_number() OVER () AS rid, * FROM pages),
tags AS (
  SELECT url AS source,
         unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\\b[^>]*>')) AS tag FROM rows_in),
raw_links AS (
  SELECT source, replace(CASE
    WHEN list_contains(regexp_split_to_array(lower({_attribute('rel')}), '\\s+'), 'canonical')
      THEN trim({_attribute('href')})
    WHEN lower({_attribute('http-equiv')}) = 'refresh'
      THEN trim(regexp_extract({_attribute('content')}, '(?i)url\\s*=\\s*[''"]?([^''"]*)', 1))
    END, '&amp;', '&') AS target FROM tags),
links AS (
  SELECT source, CASE
    WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
    WHEN starts_with(target, '//') THEN regexp_extract(source, '(?s)^(.*?)://', 1) || ':' || target
    WHEN starts_with(target, '/') THEN regexp_extract(source, '(?s)^.*?://[^/?#]*') || target
    END AS target FROM raw_links),
ends AS (
  SELECT source AS url FROM links WHERE target IS NOT NULL AND source IS NOT NULL
  UNION SELECT target FROM links WHERE target IS NOT NULL AND source IS NOT NULL),
edges AS (
  SELECT {_resource('source')} AS a, {_resource('target')} AS b FROM links WHERE target IS NOT NULL
  UNION SELECT {_resource('target')}, {_resource('source')} FROM links WHERE target IS NOT NULL),
reach AS (
  SELECT a, b FROM edges WHERE a IS NOT NULL AND b IS NOT NULL
  UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a WHERE e.b IS NOT NULL),
places AS (
  SELECT DISTINCT url, {_host('url')} AS host, {_path('url')} AS path, {_resource('url')} AS node
  FROM (SELECT url FROM rows_in UNION SELECT url FROM ends)),
decided AS (
  SELECT p.*, rule_host || rule_path AS rule, verdict FROM places p
  LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                 AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY length(rule_host || rule_path) DESC) = 1),
spoken AS (SELECT DISTINCT node, verdict FROM decided JOIN ends USING (url) WHERE verdict IS NOT NULL),
aliases AS (
  SELECT r.a AS node, CASE WHEN bool_or(s.verdict = 'allow') THEN 'allow' ELSE 'block' END AS alias
  FROM (SELECT * FROM reach UNION SELECT a, a FROM edges) r JOIN spoken s ON s.node = r.b GROUP BY r.a)
SELECT page_id, host, path, rule, coalesce(verdict, alias, 'allow') AS verdict
FROM rows_in p JOIN decided d ON p.url IS NOT DISTINCT FROM d.url LEFT JOIN aliases USING (node)"""

# -- op4: turns, loss text and lengths -----------------------------------------------------

_CONTROL = r"\\|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|\[ROLE\]|\[/ROLE\]|\[TURN\]|\[/TURN\]"


def _escaped_length(column: str) -> str:
    return f"length({column}) + len(regexp_extract_all({column}, '{_CONTROL}'))"


CHAT = f"""WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                   (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
lengths AS (
  SELECT *, {_escaped_length('text')} + CASE role
    WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
    ELSE 26 + {_escaped_length('role')} END AS chars
  FROM said)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM lengths GROUP BY conv_id"""

# -- op8: counts, sketches, fences ---------------------------------------------------------

_WORD = r"[^\x20\x09-\x0D]+"
_RULES = (
    ("symbols", "n_symbols", "n_words", 50, 75),
    ("dup_lines", "n_dup_lines", "n_lines", 95, 99),
    ("repeats", "n_repeat_words", "n_words", 95, 99),
    ("long_words", "word_chars", "n_words", 50, 75),
    ("short_words", "word_chars", "n_words", 50, 25),
)


def _share(top: str, bottom: str) -> str:
    value = f"((1000 * {top}) // greatest({bottom}, 1))"
    shift = f"greatest(0, length(bin({value})) - 6)"
    return f"(({value} >> {shift}) << {shift})"


def _level(name: str, keys: str) -> str:
    """Fences of one level of merging: groups, languages, all."""
    by = f"{keys}, rule" if keys else "rule"
    return f"""{name}_sketch AS (
  SELECT {by}, p_in, p_out, bucket, sum(n) AS n FROM sketch GROUP BY {by}, p_in, p_out, bucket),
{name}_run AS (
  SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY bucket) AS seen,
         sum(n) OVER (PARTITION BY {by}) AS total FROM {name}_sketch),
{name}_q AS (
  SELECT {by}, any_value(total) AS total, any_value(p_out < p_in) AS below,
         min(bucket) FILTER (WHERE seen * 100 >= total * p_in) AS q_in,
         min(bucket) FILTER (WHERE seen * 100 >= total * p_out) AS q_out
  FROM {name}_run GROUP BY {by}),
{name}_fence AS (
  SELECT *, q_out + CASE WHEN below THEN -10 ELSE 10 END
    * greatest(abs(q_out - q_in), 1 << greatest(0, length(bin(q_out)) - 6)) AS fence
  FROM {name}_q)"""


def _pulled(total: str, fence: str, toward: str) -> str:
    return f"floor(({total} * {fence} + 100 * {toward}) / ({total} + 100))"


_SHARES = " UNION ALL ".join(
    f"SELECT rid, lang, source, '{name}' AS rule, {inner} AS p_in, {outer} AS p_out, "
    f"{_share(top, bottom)} AS bucket FROM judged WHERE NOT base_failed"
    for name, top, bottom, inner, outer in _RULES
)

QUALITY_RULES = f"""WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, lang, source FROM documents),
split AS (SELECT *, regexp_extract_all(text, '{_WORD}') AS words FROM docs),
windows AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
repeated AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, w) > 1),
covered AS (
  SELECT rid, count(DISTINCT i + d) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS d) GROUP BY rid),
lines AS (
  SELECT rid, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '{_WORD}') GROUP BY rid),
counted AS (
  SELECT s.rid, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         coalesce(l.dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         coalesce(l.n, 0) AS n_lines
  FROM split s LEFT JOIN covered c USING (rid) LEFT JOIN lines l USING (rid)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
shares AS ({_SHARES}),
sketch AS (
  SELECT lang, source, rule, p_in, p_out, bucket, count(*) AS n FROM shares
  GROUP BY lang, source, rule, p_in, p_out, bucket),
{_level('fine', 'lang, source')}, {_level('language', 'lang')}, {_level('whole', '')},
fences AS (
  SELECT f.lang, f.source, f.rule,
    {_pulled("f.total", "f.fence", _pulled("l.total", "l.fence", "w.fence"))} AS fence
  FROM fine_fence f JOIN language_fence l ON f.lang IS NOT DISTINCT FROM l.lang AND f.rule = l.rule
  JOIN whole_fence w ON f.rule = w.rule),
verdicts AS (
  SELECT rid, bool_and(CASE WHEN p_out < p_in THEN bucket >= fence ELSE bucket <= fence END) AS kept
  FROM shares s JOIN fences f ON s.lang IS NOT DISTINCT FROM f.lang
    AND s.source IS NOT DISTINCT FROM f.source AND s.rule = f.rule GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(v.kept, true) AS kept
FROM judged LEFT JOIN verdicts v USING (rid)"""

# -- op10: what the archives hold ----------------------------------------------------------

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = " || ".join(
    f"substr('{_BASE32}', 1 + ((CAST('0x' || substr(h, {5 * (i // 4) + 1}, 5) AS BIGINT) >> {15 - 5 * (i % 4)}) & 31)::INT, 1)"
    for i in range(32)
)

WARC = f"""WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
named AS (SELECT *, sha1(payload) AS h, max(page_id) OVER (PARTITION BY payload) AS best FROM payloads)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {_DIGITS} AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM best THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM best THEN best END AS refers_to
FROM named"""

# -- op11: rounds of assignment and averaging, every distance taken ------------------------

_PARTS, _ENTRIES, _ROUNDS = 8, 16, 6


def _assigned(books: str) -> str:
    """Each part's nearest entry and its distance; products of integers are exact in doubles."""
    return f"""(SELECT rid, part, arg_min(entry, struct_pack(e := error, i := entry)) AS entry,
      min(error) AS error FROM (
        SELECT p.rid, p.part, b.entry, CAST(list_dot_product(p.y, p.y) - 2 * list_dot_product(p.y, b.y)
          + list_dot_product(b.y, b.y) AS BIGINT) AS error FROM parts p JOIN {books} b USING (part))
      GROUP BY rid, part)"""


def _round(number: int) -> str:
    before = f"books{number - 1}"
    return f"""mean{number} AS (
  SELECT part, entry, list(CAST((total - ((total % n) + n) % n) // n AS DOUBLE) ORDER BY pos) AS y FROM (
    SELECT part, entry, pos, count(*) AS n, sum(CAST(c AS HUGEINT)) AS total FROM (
      SELECT a.part, a.entry, unnest(p.y) AS c, generate_subscripts(p.y, 1) AS pos
      FROM {_assigned(before)} a JOIN parts p USING (rid, part))
    GROUP BY part, entry, pos) GROUP BY part, entry),
books{number} AS (
  SELECT part, entry, coalesce(m.y, b.y) AS y FROM {before} b LEFT JOIN mean{number} m USING (part, entry)),
"""


CODES = f"""WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id, label,
    list_transform(embedding, lambda c: floor(4096 * CAST(c AS DOUBLE))) AS x
  FROM embeddings WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
parts AS MATERIALIZED (
  SELECT rid, part, x[part * len(x) // {_PARTS} + 1 : (part + 1) * len(x) // {_PARTS}] AS y
  FROM kept, range({_PARTS}) AS r(part)),
books0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id, x) - 1 AS entry, y
  FROM (SELECT * FROM kept ORDER BY vec_id, x LIMIT {_ENTRIES}) JOIN parts USING (rid)),
{"".join(_round(i + 1) for i in range(_ROUNDS))}digest AS (
  SELECT sha256(string_agg(array_to_string(list_transform(y, lambda c: CAST(c AS BIGINT)), ','), ','
    ORDER BY part, entry)) AS codebooks_sha256 FROM books{_ROUNDS}),
coded AS (
  SELECT rid, string_agg(printf('%02x', CAST(entry AS INT)), '' ORDER BY part) AS code,
    CAST(sum(error) AS BIGINT) AS error FROM {_assigned(f"books{_ROUNDS}")} GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  codebooks_sha256 FROM coded JOIN kept USING (rid), digest"""

# -- op13: every window as text, and the words that repeated ones cover --------------------

REPEATS = """WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT rid, doc_id, s, array_to_string(w[s + 1 : s + 13], ' ') AS content
  FROM (SELECT *, unnest(range(len(w) - 12)) AS s FROM texts WHERE len(w) >= 13)),
firsts AS (SELECT content, min(doc_id) AS first FROM windows GROUP BY content),
gone AS (
  SELECT DISTINCT rid, unnest(range(s, s + 13)) AS pos FROM windows JOIN firsts USING (content)
  WHERE first < doc_id OR doc_id IS NULL AND first IS NOT NULL),
words AS (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS pos FROM texts),
left_over AS (
  SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS content
  FROM words ANTI JOIN gone USING (rid, pos) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(content, '')) AS kept_sha256
FROM texts LEFT JOIN left_over USING (rid)"""

SQL: dict[str, str] = {
    "op1_redirect_url_filter": URL_FILTER,
    "op4_schema_chat_format": CHAT,
    "op8_adaptive_quality_rules": QUALITY_RULES,
    "op10_seekable_warc": WARC,
    "op11_laesa_vector_codes": CODES,
    "op13_window_repeats": REPEATS,
}
