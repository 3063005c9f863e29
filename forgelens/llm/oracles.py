"""The results of the corpus queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from . import license_scan, mixing, quality_rules, url_filter

WORD = r"[^\x20\x09-\x0D]+"

MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS key
  FROM documents
), sums AS (
  SELECT source, sum(size)::HUGEINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, ([{", ".join(map(str, mixing.WEIGHTS))}])[(place % {len(mixing.WEIGHTS)})::INT + 1]::HUGEINT AS weight,
         sum(source_size) OVER () AS words
  FROM sums
), filled AS (
  -- Sources that fill first come first; the others share what those before them leave.
  SELECT *, words - {mixing.MOST} * coalesce(sum(source_size) OVER before, 0) AS rest,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS shares
  FROM weighted
  WINDOW before AS (ORDER BY source_size::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT arg_min(rest, source_size::DOUBLE / weight) AS rest, arg_min(shares, source_size::DOUBLE / weight) AS shares
  FROM filled WHERE {mixing.MOST} * source_size * shares >= weight * rest
), targets AS (
  SELECT source, source_size,
         CASE WHEN {mixing.MOST} * source_size * level.shares < weight * level.rest
              THEN ({mixing.MOST} * source_size)::DOUBLE
              ELSE (weight * level.rest)::DOUBLE / level.shares::DOUBLE END AS target
  FROM filled, level
), drawn AS (
  SELECT s.doc_id, s.size, t.source_size::BIGINT AS source_size, t.target,
         CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size::DOUBLE, {float(mixing.MOST)}) ELSE 0.0 END AS rate,
         ('0x' || substr(md5('{mixing.SEED}:' || s.key), 1, {mixing.DRAW_BITS // 4}))::BIGINT::DOUBLE
           / {1 << mixing.DRAW_BITS}::DOUBLE AS drawn
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies
FROM (SELECT *, floor(rate)::BIGINT + (drawn < rate - floor(rate))::BIGINT AS copies FROM drawn)
"""


def _quality() -> str:
    bins = ", ".join(f"'{word}'" for word in quality_rules.WORDS)
    spellings = ", ".join(f"'{word}'" for word in quality_rules.SPELLINGS)
    inside = list(quality_rules.CLASSES.values())
    kinds = ", ".join(
        f"length(regexp_replace(text, '[^{i}]+', '', 'g'))"
        for i in inside
    )

    def distances(reference: str) -> str:
        def one(counts: str, total: str, against: str, against_total: str) -> str:
            parts = f"""list_transform(range(1, len({counts}) + 1), lambda i: (
              CASE WHEN {counts}[i] > 0 THEN ({counts}[i] / {total}::DOUBLE)
                * log2(2 * ({counts}[i] / {total}::DOUBLE) / ({counts}[i] / {total}::DOUBLE + {against}[i] / {against_total}::DOUBLE))
                ELSE 0 END
              + CASE WHEN {against}[i] > 0 THEN ({against}[i] / {against_total}::DOUBLE)
                * log2(2 * ({against}[i] / {against_total}::DOUBLE) / ({counts}[i] / {total}::DOUBLE + {against}[i] / {against_total}::DOUBLE))
                ELSE 0 END) / 2)"""
            return f"sqrt(greatest(0, list_sum({parts})))"

        r = quality_rules
        return f"""
  SELECT f.*, r.of IS NOT NULL OR f.lang IS NULL AS has,
    CASE WHEN n_chars >= {r.LEAST_CHARS} THEN {one("f.kinds", "f.n_chars", "r.kinds", "r.chars")} END
      > {r.CHAR_LIMIT} + {r.CHAR_NOISE} / sqrt(n_chars) AS far_chars,
    CASE WHEN n_words >= {r.LEAST_JUDGED_WORDS} THEN {one("f.times", "f.n_words", "r.times", "r.words")} END
      > {r.WORD_LIMIT} + {r.WORD_NOISE} / sqrt(n_words) AS far_words
  FROM failing f LEFT JOIN {reference} r ON f.lang IS NOT DISTINCT FROM r.of"""

    sums = ", ".join(f"sum(kinds[{i + 1}])::BIGINT" for i in range(len(inside) + 1))
    times = ", ".join(f"sum(times[{i + 1}])::BIGINT" for i in range(len(quality_rules.WORDS) + 1))
    summed = f"SELECT lang AS of, [{sums}] AS kinds, [{times}] AS times, sum(n_chars)::BIGINT AS chars, sum(n_words)::BIGINT AS words"
    good = "NOT base_failed AND NOT coalesce(far_chars, false) AND NOT coalesce(far_words, false)"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id, lang, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT k, regexp_extract_all(text, '{WORD}') AS words FROM docs
), placed AS (
  SELECT k, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM words
), windows AS (
  SELECT k, i, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM placed WINDOW o AS (PARTITION BY k ORDER BY i)
), counted AS (
  SELECT k, i, w3 IS NOT NULL AND count(*) OVER (PARTITION BY k, w, w2, w3) > 1 AS twice FROM windows
), repeats AS (
  SELECT k, count(*) AS n FROM (
    SELECT k, twice OR coalesce(lag(twice, 1) OVER o, false) OR coalesce(lag(twice, 2) OVER o, false) AS covered
    FROM counted WINDOW o AS (PARTITION BY k ORDER BY i)
  ) WHERE covered GROUP BY k
), counts AS (
  SELECT d.k, d.doc_id, d.lang, length(text) AS n_chars, len(w.words)::BIGINT AS n_words,
         [{kinds}] AS classes, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         list_transform(list_filter(w.words, lambda x: x IN ({spellings})), lambda x: lower(x)) AS common,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM docs d JOIN words w USING (k) LEFT JOIN repeats r USING (k)
), features AS (
  SELECT k, doc_id, lang, n_chars, n_words, n_repeat_words, lines,
         list_append(classes, n_chars - list_sum(classes)::BIGINT) AS kinds,
         list_append(list_transform([{bins}], lambda b: len(list_filter(common, lambda x: x = b))),
                     n_words - len(common)) AS times
  FROM counts
), failing AS (
  SELECT *, n_words < {quality_rules.LEAST_WORDS}
         OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED_PERCENT} * n_words AS base_failed
  FROM features
), reference1 AS (
  {summed} FROM failing WHERE NOT base_failed GROUP BY lang
), judged1 AS ({distances("reference1")}
), reference2 AS (
  {summed} FROM judged1 WHERE {good} GROUP BY lang
), judged2 AS ({distances("reference2")}
)
SELECT doc_id, n_words, n_chars - kinds[{list(quality_rules.CLASSES).index("blank") + 1}] AS word_chars,
       kinds[{list(quality_rules.CLASSES).index("symbol") + 1}] AS n_symbols,
       (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_repeat_words, base_failed, {good} AS kept
FROM judged2
"""


def _licenses() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = ", ".join(
        f"CASE WHEN regexp_matches(line, '{license_scan.as_pattern(template)}') THEN '{label}' END"
        for label, template in license_scan.wordings()
    )
    lists, base = [], []
    for phrase, label in license_scan.PHRASES.items():
        parts = phrase.split()
        same = " AND ".join(f"words[i + {1 + k}] = '{part}'" for k, part in enumerate(parts))
        lists.append(f"list_filter(range(0, len(words)), lambda i: {same})")
        base.append(f"CASE WHEN regexp_matches(line, ' {phrase} ') THEN '{label}' END")
    join = "coalesce(array_to_string(list_sort(list_distinct(list_filter({}, lambda x: x IS NOT NULL))), ','), '')"
    return f"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), marked AS (
  SELECT doc_id, words, ' ' || array_to_string(words, ' ') || ' ' AS line, flatten([{", ".join(lists)}]) AS places FROM split
), labelled AS (
  SELECT *, [{", ".join(base)}] AS base, [{found}] AS own FROM marked
)
SELECT doc_id, len(words)::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places) AS first_word,
       list_max(places) AS last_word, {join.format("base")} AS base_labels,
       {join.format("list_concat(base, own)")} AS labels,
       CASE WHEN len(list_filter(own, lambda x: x IS NOT NULL)) > 0 THEN 1.0 WHEN len(places) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE
         AS score
FROM labelled
"""


def _urls() -> str:
    u = url_filter
    cases = []
    for rule in sorted(u.RULES, key=lambda r: (-len(r), r)):
        domain, _, begin = rule.partition("/")
        cases.append(
            f"WHEN (host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '/{begin}') THEN '{rule}'"
        )
    allowed = ", ".join(f"'{rule}'" for rule, verdict in u.RULES.items() if verdict == u.ALLOW)
    levels = []
    for k in range(u.ORDER + 1):
        lower = "a.p" if k else f"{1.0 / u.CODE_POINTS!r}::DOUBLE"
        lower_b = "a.q" if k else f"{1.0 / u.CODE_POINTS!r}::DOUBLE"
        join = f"JOIN level{k - 1} a ON a.gram = right(c.gram, {k})" if k else ""
        levels.append(f"""
counts{k} AS (
  SELECT gram, left(gram, {k}) AS context, x, y, sum(x) OVER w AS xs, sum(y) OVER w AS ys,
         sum((x > 0)::BIGINT) OVER w AS xk, sum((y > 0)::BIGINT) OVER w AS yk
  FROM (SELECT right(gram, {k + 1}) AS gram, sum(x) AS x, sum(y) AS y FROM grams GROUP BY 1)
  WINDOW w AS (PARTITION BY left(gram, {k}))
), level{k} AS (
  SELECT c.gram,
         CASE WHEN xs > 0 THEN (x::DOUBLE + xk::DOUBLE * {lower}) / (xs + xk)::DOUBLE ELSE {lower} END AS p,
         CASE WHEN ys > 0 THEN (y::DOUBLE + yk::DOUBLE * {lower_b}) / (ys + yk)::DOUBLE ELSE {lower_b} END AS q
  FROM counts{k} c {join}
)""")
    letters = f"'{u.UPPER}', '{u.LOWER}'"
    window = " || ".join(f"cs[i + {k}]" for k in range(u.ORDER + 1))
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest,
         CASE WHEN strpos(url, '://') > 0 THEN left(url, strpos(url, '://') + 2) ELSE '' END AS scheme
  FROM pages
), parts AS (
  SELECT page_id, scheme || translate(regexp_extract(rest, '^([^/?#]*)', 1), {letters})
           || substr(rest, length(regexp_extract(rest, '^([^/?#]*)', 1)) + 1) AS text,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), {letters}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), ruled AS (
  SELECT *, CASE {" ".join(cases)} END AS rule FROM parts
), texts AS (
  SELECT text, rule, ('0x' || left(md5(text), 8))::BIGINT % {u.HELD_OUT} = 0 AS held_out,
         CASE WHEN rule IN ({allowed}) THEN count(*) ELSE 0 END AS x,
         CASE WHEN rule NOT IN ({allowed}) THEN count(*) ELSE 0 END AS y
  FROM ruled GROUP BY text, rule
), placed AS (
  SELECT text, held_out, x, y, unnest(list_transform(range(1, length(text) + 2), lambda i: {window})) AS gram
  FROM (SELECT *, string_split(repeat(chr(2), {u.ORDER}) || text || chr(3), '') AS cs FROM texts WHERE text <> '')
), grams AS (
  SELECT gram, sum(CASE WHEN held_out THEN 0 ELSE x END) AS x, sum(CASE WHEN held_out THEN 0 ELSE y END) AS y
  FROM placed GROUP BY gram
), {", ".join(levels)}, sums AS (
  SELECT text, sum(round((ln(p) - ln(q)) * {u.UNIT})::BIGINT) AS ratio FROM placed JOIN level{u.ORDER} USING (gram) GROUP BY text
), scores AS (
  SELECT t.*, ratio::DOUBLE / {float(u.UNIT)}::DOUBLE / (length(t.text) + 1)::DOUBLE AS score FROM texts t JOIN sums USING (text)
), steps AS (
  SELECT floor(score / {u.STEP}::DOUBLE)::BIGINT AS step, sum(x) AS x, sum(y) AS y
  FROM scores WHERE held_out AND rule IS NOT NULL GROUP BY 1
), rights AS (
  SELECT step, step + coalesce(lag(step) OVER (ORDER BY step) + 1, step) AS twice, (sum(x) OVER () - coalesce(sum(x) OVER b, 0)) / nullif(sum(x) OVER (), 0)
             + coalesce(sum(y) OVER b, 0) / nullif(sum(y) OVER (), 0) AS rights
  FROM steps WINDOW b AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), best AS (
  SELECT coalesce((SELECT twice FROM rights WHERE rights IS NOT NULL ORDER BY rights DESC, abs(step), step LIMIT 1)
                  * {u.STEP / 2}::DOUBLE, 0) AS cut
)
SELECT page_id, host, path, r.rule,
       CASE WHEN r.rule IN ({allowed}) THEN 'allow' WHEN r.rule IS NOT NULL THEN 'block'
            WHEN s.score >= best.cut THEN 'allow' ELSE 'block' END AS verdict
FROM ruled r LEFT JOIN scores s USING (text), best
"""


SUFFIXES = """
WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), blocks AS (
  -- Text in blocks, so that a string is cut from a short one.
  SELECT k, doc_id, b * 500 AS base, substr(h, b * 1000 + 1, 1098) AS part
  FROM (SELECT *, unnest(range(0, length(h) // 1000 + 1)) AS b FROM texts)
), strings AS (
  SELECT k, doc_id, base + i AS i, substr(part, 2 * i + 1, 100) AS s
  FROM (SELECT *, unnest(range(0, least(500, length(part) // 2 - 49))) AS i FROM blocks)
), least_of AS (
  SELECT s, min(doc_id) AS m FROM strings GROUP BY s
), hits AS (
  SELECT k, i, i - lag(i) OVER (PARTITION BY k ORDER BY i) AS gap
  FROM strings JOIN least_of USING (s) WHERE m < doc_id
), cuts AS (
  SELECT k, min(i) AS a, max(i) + 50 AS b
  FROM (SELECT k, i, sum((gap IS NULL OR gap > 50)::INT) OVER (PARTITION BY k ORDER BY i) AS span FROM hits)
  GROUP BY k, span
), lists AS (
  SELECT k, list([a, b] ORDER BY a) AS spans FROM cuts GROUP BY k
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes,
       coalesce(list_sum(list_transform(spans, lambda x: x[2] - x[1])), 0)::BIGINT AS n_removed,
       coalesce(len(spans), 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(array_to_string(list_transform(range(0, len(spans) + 1), lambda j:
         substr(h, 2 * CASE WHEN j = 0 THEN 0 ELSE spans[j][2] END + 1,
                2 * (CASE WHEN j = len(spans) THEN length(h) // 2 ELSE spans[j + 1][1] END
                     - CASE WHEN j = 0 THEN 0 ELSE spans[j][2] END))), ''), h))) AS kept_sha256
FROM texts LEFT JOIN lists USING (k)
"""

NEAR = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '{WORD}') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 4
           THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM split
), sized AS (
  SELECT doc_id, s, len(s) AS n FROM sets
), parts AS (
  SELECT doc_id, n, unnest(s) AS x FROM sized
), rare AS (
  SELECT doc_id, n, x, row_number() OVER (PARTITION BY doc_id ORDER BY f, x) AS place
  FROM (SELECT *, count(*) OVER (PARTITION BY x) AS f FROM parts)
), prefix AS (
  -- Similar sets share one of their rarest members.
  SELECT * FROM rare WHERE place <= n - ceil(0.8 * n) + 1
), pairs AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b
  FROM prefix a JOIN prefix b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), links AS (
  SELECT p.a, p.b FROM pairs p JOIN sized x ON x.doc_id = p.a JOIN sized y ON y.doc_id = p.b
  WHERE 100 * len(list_intersect(x.s, y.s)) >= 80 * (x.n + y.n - len(list_intersect(x.s, y.s)))
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached(id, least_id) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT ways.b, reached.least_id FROM reached JOIN ways ON ways.a = reached.id WHERE reached.least_id < ways.b
), found AS (
  SELECT id, min(least_id) AS component_id FROM reached GROUP BY id
)
SELECT s.doc_id, s.n::BIGINT AS n_shingles, f.component_id, s.doc_id = f.component_id AS kept
FROM sized s JOIN found f ON f.id = s.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": _quality(),
        "op5_suffix_dedup": SUFFIXES,
        "op7_url_filter": _urls(),
        "op8_mixing": MIXING,
        "op9_license_scan": _licenses(),
        "op10_near_dedup": NEAR,
    }
