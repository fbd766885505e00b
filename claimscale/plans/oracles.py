"""SQL that gives the same rows as the registered queries.

Written independently of the DataFrame code: paragraphs, for instance, are built
here line by line with window functions.
"""

from __future__ import annotations

from claimscale import fixed

_GROUPS = ", ".join(
    " + ".join(f"(embedding[{j}]::DOUBLE * embedding[{j}]::DOUBLE)" for j in range(i, 65, 5))
    + f" AS g{i}"
    for i in range(1, 6)
)
_POWERS = ", ".join(
    f"((g{i} * g{i}) * (g{i} * g{i})) * ((g{i} * g{i}) * (g{i} * g{i})) AS s{i}"
    for i in range(1, 6)
)
_SUM = "(s1 + s2 + s3 + s4 + s5)"
_SHARES = ", ".join(f"s{i} / {_SUM}" for i in range(1, 6))

_TOPICS = "topics(topic_id, topic, policy) AS (VALUES " + ", ".join(
    f"({x['topic_id']}, '{x['topic']}', '{x['policy']}')" for x in fixed.TOPIC_LABELS
) + ")"

_DIST = f"""
squares AS (SELECT vec_id, label, {_POWERS}
  FROM (SELECT vec_id, label, {_GROUPS} FROM embeddings)),
dist AS (SELECT vec_id, 'Org_' || label AS organisation, [{_SHARES}] AS p FROM squares)
"""

_SCORED = f"""{_TOPICS}, {_DIST},
scored AS (
  SELECT *, list_max(p) AS probability,
         CAST(list_position(p, list_max(p)) - 1 AS INTEGER) AS topic_id
  FROM dist WHERE list_max(p) > 0
)"""

_INITIATIVES = f"""{_SCORED},
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY organisation, topic_id ORDER BY probability DESC, vec_id) AS place
  FROM scored
),
initiatives AS (
  SELECT r.vec_id, r.organisation, r.p, r.probability, r.topic_id, t.topic, t.policy
  FROM ranked r JOIN topics t ON r.topic_id = t.topic_id
  WHERE r.probability > {fixed.MIN_PROBABILITY} AND r.place = 1
)"""

_POSITIONS = "(SELECT unnest(range(0, 5)) AS i) positions"

_CSR = f"""{_INITIATIVES},
mass AS (
  SELECT organisation, CAST(i AS INTEGER) AS topic_id, sum(p[i + 1]) AS esg
  FROM initiatives, {_POSITIONS} GROUP BY organisation, i
),
csr AS (
  SELECT organisation, topic_id,
         round(row_number() OVER (PARTITION BY topic_id ORDER BY esg, organisation)
               * 100.0 / (SELECT count(DISTINCT organisation) FROM initiatives)) AS score
  FROM mass
)"""

_NEWS = f"""
articles AS (
  SELECT event_id, ts AS date, 'org_' || (user_id % 10) AS organisation,
         value - 100 AS tone,
         event_id % (SELECT count(*) FROM embeddings) AS vec_id
  FROM events
),
toned AS (
  SELECT a.organisation, CAST(i AS INTEGER) AS topic_id,
         sum(p[i + 1] * tone) AS weightedTone, sum(p[i + 1]) AS weights
  FROM articles a JOIN dist d ON a.vec_id = d.vec_id, {_POSITIONS}
  GROUP BY a.organisation, i
),
weighted AS (
  SELECT n.organisation, t.policy, t.topic, t.topic_id, n.weightedTone, n.weights,
         n.weightedTone / n.weights AS esg
  FROM toned n JOIN topics t ON n.topic_id = t.topic_id
),
news_scores AS (
  SELECT *, row_number() OVER (PARTITION BY policy ORDER BY esg, organisation) * 100.0
            / (SELECT count(DISTINCT organisation) FROM weighted) AS score
  FROM weighted
)"""

# _NEWS needs "dist" and "topics".
_ALL_NEWS = f"{_TOPICS}, {_DIST}, {_NEWS}"


def _news_after(with_dist: str) -> str:
    return f"{with_dist}, {_NEWS}"


def _cell(source: str, column: str, value: str, name: str) -> str:
    return f"avg(CASE WHEN {column} = '{name}' THEN {value} END) AS \"{name}\""


_POLICIES = [x["policy"] for x in fixed.TOPIC_LABELS]


def _scaled(name: str) -> str:
    low, high = f"min(\"{name}\") OVER ()", f"max(\"{name}\") OVER ()"
    return (
        f"CASE WHEN \"{name}\" IS NOT NULL THEN round(coalesce((\"{name}\" - {low}) / "
        f"nullif({high} - {low}, 0), 0.0), 6) END AS \"{name}\""
    )


def _policy_matrix(relation: str) -> str:
    cells = ", ".join(_cell(relation, "policy", "esg", x) for x in _POLICIES)
    scaled = ", ".join(_scaled(x) for x in _POLICIES)
    return (
        f"SELECT organisation, {scaled} FROM "
        f"(SELECT organisation, {cells} FROM {relation} GROUP BY organisation) m"
    )


def _pillar_matrix(relation: str) -> str:
    cells = ", ".join(
        f"round(avg(CASE WHEN topic = '{x}' THEN score END), 6) AS \"{x}\""
        for x in fixed.PILLARS
    )
    return f"SELECT organisation, {cells} FROM {relation} GROUP BY organisation"


# --- text ------------------------------------------------------------------------

_WHITE = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

_PARAGRAPHS = r"""
printable AS (
  SELECT doc_id, source,
         string_split(regexp_replace(text, '[^\x20-\x7E\t\n\r\x0B\f]', '', 'g'),
                      chr(10)) AS parts
  FROM documents
),
lines AS (
  SELECT doc_id, source, unnest(parts) AS line,
         generate_subscripts(parts, 1) AS line_no
  FROM printable
),
opening AS (
  SELECT *, CASE WHEN NOT starts_with(line, ' ')
                  AND coalesce(ends_with(lag(line) OVER w, '.'), false)
                 THEN 1 ELSE 0 END AS opens
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)
),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY line_no) AS n FROM opening
),
paragraphs AS (
  SELECT doc_id, source, CAST(n AS INTEGER) AS paragraph_no,
         CASE WHEN n = 0 THEN ' ' ELSE '' END
           || string_agg(line, ' ' ORDER BY line_no) AS paragraph
  FROM numbered GROUP BY doc_id, source, n
)"""


_CLEANING = [
    (fixed.HEADER_NUMBER.removeprefix("(?d)"), r"\1"),
    (None, ""),
    (fixed.HYPHEN, "-"),
    (fixed.PUNCTUATION, r"\1"),
    (fixed.LONG_NUMBER, " "),
    (fixed.HOST, " "),
    (fixed.SPACES, " "),
    (fixed.POINTS, "."),
]


def _cleaned(sql: str) -> str:
    for pattern, replacement in _CLEANING:
        if pattern is None:
            sql = f"trim({sql}, {_WHITE})"
        else:
            sql = f"regexp_replace({sql}, '{pattern}', '{replacement}', 'g')"
    return sql


_STATEMENTS = rf"""{_PARAGRAPHS},
sentences AS (
  SELECT doc_id, source, paragraph_no,
         string_split(regexp_replace({_cleaned('paragraph')}, '([.!?])\s+',
                                     '\1' || chr(10), 'g'), chr(10)) AS parts
  FROM paragraphs
),
statements AS (
  SELECT doc_id, source, paragraph_no, trim(unnest(parts), {_WHITE}) AS statement,
         CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS sentence_no
  FROM sentences
)"""

_STOP = ", ".join(f"'{w}'" for w in fixed.STOP_WORDS)


def _folded(column: str) -> str:
    return f"strip_accents(lower({column}))"


def _tokens(column: str) -> str:
    return (
        f"list_filter(string_split_regex({_folded(column)}, '[^\\pL\\pM\\pN]+'), "
        f"lambda t: length(t) >= {fixed.MIN_TOKEN_CHARS} AND t NOT IN ({_STOP}))"
    )


_LONG = f"length(statement) >= {fixed.MIN_STATEMENT_CHARS}"



# --- stems -----------------------------------------------------------------------

_V, _C = "[aeiouy]", "[b-df-hj-np-tv-xzY]"
_MEASURES = {
    "": "",
    "v": _V,
    "m0": f"{_V}{_C}",
    "m1": f"{_V}{_C}.*{_V}{_C}",
}


def _holds(left: str, condition: str) -> str:
    if condition == "st":
        return f"({_holds(left, 'm1')} AND right({left}, 1) IN ('s', 't'))"
    return f"regexp_matches({left}, '{_MEASURES[condition]}')" if condition else "true"


def _stem_case(rules: list[tuple[str, str, str]]) -> str:
    """The first suffix of a step that a word ends in, the longest first."""
    cases = []
    for suffix, new, condition in sorted(rules, key=lambda r: -len(r[0])):
        left = f"left(w, length(w) - {len(suffix)})"
        cases.append(
            f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {_holds(left, condition)} "
            f"THEN {left} || '{new}' ELSE w END"
        )
    return f"CASE {' '.join(cases)} ELSE w END"


_CUT = "left(w, length(w) - 1)"
_SHORT = f"regexp_matches({{0}}, '^{_C}+{_V}[b-df-hj-np-tvz]$')"
_DOUBLE = "|".join(c * 2 for c in "bcdfghjkmnpqrtvwx")
_PAST = f"""CASE
  WHEN ends_with(w, 'eed') THEN CASE WHEN regexp_matches(left(w, length(w) - 3), '{_V}{_C}')
    THEN {_CUT} ELSE w END
  WHEN ends_with(w, 'ed') AND regexp_matches(left(w, length(w) - 2), '{_V}')
    THEN left(w, length(w) - 2) || '#'
  WHEN ends_with(w, 'ing') AND regexp_matches(left(w, length(w) - 3), '{_V}')
    THEN left(w, length(w) - 3) || '#'
  ELSE w END"""
_MENDED = f"""CASE
  WHEN NOT ends_with(w, '#') THEN w
  WHEN regexp_matches(w, '(at|bl|iz)#$') THEN {_CUT} || 'e'
  WHEN regexp_matches(w, '({_DOUBLE}|YY)#$') THEN left(w, length(w) - 2)
  WHEN {_SHORT.format(_CUT)} THEN {_CUT} || 'e'
  ELSE {_CUT} END"""
_FINAL_Y = f"CASE WHEN regexp_matches(w, '{_V}.*[yY]$') AND regexp_matches({_CUT}, '{_V}') THEN {_CUT} || 'i' ELSE w END"
_FINAL_E = f"""CASE
  WHEN NOT ends_with(w, 'e') THEN w
  WHEN regexp_matches({_CUT}, '{_MEASURES["m1"]}') THEN {_CUT}
  WHEN regexp_matches({_CUT}, '{_MEASURES["m0"]}') AND NOT {_SHORT.format(_CUT)} THEN {_CUT}
  ELSE w END"""
_FINAL_L = f"CASE WHEN ends_with(w, 'll') AND regexp_matches({_CUT}, '{_MEASURES['m1']}') THEN {_CUT} ELSE w END"


def _stems(terms: str) -> str:
    """Steps as tables of their own over ``terms`` (term); the last is stemmed (term, base)."""
    steps = [
        _stem_case(fixed.STEM_PLURALS), _PAST, _MENDED, _FINAL_Y, _stem_case(fixed.STEM_STEP_2),
        _stem_case(fixed.STEM_STEP_3), _stem_case(fixed.STEM_STEP_4), _FINAL_E, _FINAL_L,
    ]
    sql = rf"""stem0 AS (
      SELECT term, regexp_replace(regexp_replace(term, '(^|[aeiou])y', '\1Y', 'g'),
                                  'Yyy', 'YyY', 'g') AS w
      FROM {terms} WHERE regexp_matches(term, '^[a-z][a-z][a-z]+$'))"""
    for i, step in enumerate(steps):
        sql += f", stem{i + 1} AS (SELECT term, {step} AS w FROM stem{i})"
    return f"""{sql}, stemmed AS (
      SELECT t.term, coalesce(lower(s.w), t.term) AS base
      FROM {terms} t LEFT JOIN stem{len(steps)} s USING (term))"""


_TERMS = f"""occurring AS (SELECT doc_id, lang, unnest({_tokens('text')}) AS term FROM documents),
terms AS (SELECT term, count(*) AS count FROM occurring GROUP BY term)"""

_OFFERS = " UNION ALL ".join(
    f"SELECT term, {i} AS rule_no, left(term, length(term) - {len(old)}) || '{new}' AS base "
    f"FROM terms WHERE ends_with(term, '{old}')"
    for i, (old, new) in enumerate(fixed.LEMMA_ENDINGS)
)

# --- learned sentences -------------------------------------------------------------


def _bare(word: str) -> str:
    return f"regexp_replace(regexp_replace(lower({word}), '^[^a-z0-9]+', ''), '[^a-z0-9.]+$', '')"


def _type(word: str) -> str:
    return f"regexp_replace({_bare(word)}, '[.]$', '')"


def _log_of(share: str) -> str:
    return f"ln(least(greatest({share}, 1e-12), 1 - 1e-12))"


def _told(hits: str, tries: str, share: str) -> str:
    return f"({hits} * {_log_of(share)} + ({tries} - {hits}) * {_log_of(f'(1 - ({share}))')})"


def _ratio(a: str, b: str, both: str, n: str) -> str:
    p, p1, p2 = f"{b}::DOUBLE / {n}", f"{both}::DOUBLE / {a}", f"({b} - {both})::DOUBLE / ({n} - {a})"
    return (
        f"-2 * ({_told(both, a, p)} + {_told(f'({b} - {both})', f'({n} - {a})', p)}"
        f" - CASE WHEN {a} = {both} THEN 0 ELSE {_told(both, a, p1)} END"
        f" - CASE WHEN {b} = {both} THEN 0 ELSE {_told(f'({b} - {both})', f'({n} - {a})', p2)} END)"
    )


_PLACES = f"""{_PARAGRAPHS},
cleaned AS (SELECT doc_id, paragraph_no, {_cleaned('paragraph')} AS p FROM paragraphs),
lists AS (SELECT list_filter(string_split(p, ' '), lambda w: w <> '') AS ws FROM cleaned),
raw_places AS (SELECT unnest(ws) AS w, unnest(list_append(ws[2:], NULL)) AS following
               FROM lists WHERE len(ws) > 0),
places AS (SELECT {_type('w')} AS word, ends_with({_bare('w')}, '.') AS stopped,
                  {_type('following')} AS next FROM raw_places),
stops AS (SELECT word, count_if(stopped)::BIGINT AS stopped, count_if(NOT stopped)::BIGINT AS open
          FROM places GROUP BY word),
sizes AS (SELECT sum(stopped + open)::BIGINT AS n, sum(stopped)::BIGINT AS n_stopped FROM stops),
signs AS (SELECT *, length(replace(word, '.', '')) AS signs FROM stops, sizes
          WHERE stopped > 0 AND regexp_matches(word, '[a-z]')),
scored AS (
  SELECT word, stopped, open,
         -2 * ({_told('stopped', '(stopped + open)', 'n_stopped::DOUBLE / n')}
               - {_told('stopped', '(stopped + open)', '0.99')})
         * exp(-signs) * (length(word) - signs + 1) * pow(signs::DOUBLE, -open) AS score
  FROM signs)"""

_LEARNED = f"""{_PLACES},
shortened AS (SELECT word FROM scored WHERE score >= {fixed.ABBREVIATION_SCORE}),
starts AS (
  SELECT next AS word, count(*) AS at_start FROM places
  WHERE stopped AND next IS NOT NULL AND NOT regexp_matches(word, '^[a-z]$')
    AND word NOT IN (SELECT word FROM shortened)
  GROUP BY next),
all_ends AS (SELECT sum(at_start)::BIGINT AS ends FROM starts),
starters AS (
  SELECT * FROM (
    SELECT s.word, at_start, stopped + open AS tries,
           {_ratio('ends', '(stopped + open)', 'at_start', 'n')} AS score
    FROM starts s JOIN stops USING (word), sizes, all_ends
    WHERE regexp_matches(s.word, '[a-z]') AND at_start * n > (stopped + open) * ends)
  WHERE score >= {fixed.STARTER_SCORE}),
near AS (
  SELECT word, next, count(*) AS together FROM places
  WHERE stopped AND regexp_matches(next, '[a-z]')
    AND (word IN (SELECT word FROM shortened) OR regexp_matches(word, '^[a-z]$'))
    AND next NOT IN (SELECT word FROM starters)
  GROUP BY word, next HAVING count(*) > 1),
fixed_pairs AS (
  SELECT word, next FROM (
    SELECT r.word, r.next, r.together, x.stopped + x.open AS a, y.stopped + y.open AS b, n
    FROM near r JOIN stops x ON r.word = x.word JOIN stops y ON r.next = y.word, sizes)
  WHERE together * n > a * b AND {_ratio('a', 'b', 'together', 'n')} >= {fixed.PAIR_SCORE})"""

_LEARNED_STATEMENTS = rf"""{_LEARNED},
pieces AS (
  SELECT doc_id, paragraph_no, unnest(parts) AS piece, generate_subscripts(parts, 1) AS piece_no
  FROM (SELECT doc_id, paragraph_no,
               string_split(regexp_replace(p, '([.!?])\s+', '\1' || chr(10), 'g'), chr(10)) AS parts
        FROM cleaned)),
met AS (
  SELECT *, regexp_extract(piece, '(\S+)$', 1) AS last_word,
         regexp_extract(lead(piece) OVER w, '^(\S+)', 1) AS first_word,
         lead(piece) OVER w IS NOT NULL AS has_next
  FROM pieces WINDOW w AS (PARTITION BY doc_id, paragraph_no ORDER BY piece_no)),
judged AS (
  SELECT *, {_type('last_word')} AS word, {_type('first_word')} AS next FROM met),
decided AS (
  SELECT *, has_next AND ends_with(piece, '.') AND (
    regexp_matches(word, '^[a-z]$')
    OR (word IN (SELECT word FROM shortened) AND NOT (
          next IN (SELECT word FROM starters) AND regexp_matches(first_word, '^[^a-z]*[A-Z]')
          AND (word, next) NOT IN (SELECT (word, next) FROM fixed_pairs)))) AS goes_on
  FROM judged),
grouped AS (
  SELECT *, coalesce(sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (
    PARTITION BY doc_id, paragraph_no ORDER BY piece_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sentence_no
  FROM decided),
learned AS (
  SELECT doc_id, paragraph_no, CAST(sentence_no AS INTEGER) AS sentence_no,
         trim(string_agg(piece, ' ' ORDER BY piece_no), {_WHITE}) AS statement
  FROM grouped GROUP BY doc_id, paragraph_no, sentence_no)"""

_BY_LANGUAGE = ", ".join(f"count_if(lang = '{x}') + 0.25::DOUBLE AS w{i}" for i, x in enumerate(("de", "en", "es", "fr")))
_MATRIX = f"""{_TERMS},
matrix AS (SELECT term, count(*) AS count, {_BY_LANGUAGE} FROM occurring GROUP BY term),
lengths AS (SELECT sum(count) AS n, {", ".join(f"sum(w{i}) AS t{i}" for i in range(4))} FROM matrix)"""


def _apart(a: int, b: int) -> str:
    p, q = f"(w{a} / t{a})", f"(w{b} / t{b})"
    return (
        f"SELECT {a}::INTEGER AS topic_a, {b}::INTEGER AS topic_b, round(sqrt(sum("
        f"({p} * log2({p} / (({p} + {q}) / 2)) + {q} * log2({q} / (({p} + {q}) / 2))) / 2)), 6)"
        " AS distance FROM matrix, lengths"
    )


def _markup(column: str) -> str:
    sql = (
        f"regexp_replace({column}, '<(script|style)\\b.*?</(script|style)>', "
        "' ', 'gis')"
    )
    sql = f"regexp_replace({sql}, '<[^>]*>', ' ', 'gs')"
    for entity, char in (
        ("&nbsp;", " "),
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "''"),
        ("&copy;", "©"),
        ("&middot;", "·"),
        ("&amp;", "&"),
    ):
        sql = f"replace({sql}, '{entity}', '{char}')"
    return f"trim(regexp_replace({sql}, '\\s+', ' ', 'g'), {_WHITE})"


_DOCUMENT_FILES = f"""
WITH bound AS (
  SELECT page_id // 10 AS ticker,
         string_agg({_markup('html')}, chr(10) ORDER BY page_id) AS pdf_content
  FROM pages GROUP BY page_id // 10
)
SELECT d.source AS organisation, b.pdf_content, CAST(b.ticker AS VARCHAR) AS ticker,
       d.lang AS description
FROM bound b JOIN documents d ON b.ticker = d.doc_id
"""

_PER_DAY = """
SELECT count(*) AS article_count, CAST(ts AS DATE) AS date,
       'org_' || (user_id % 10) AS organisation
FROM events GROUP BY CAST(ts AS DATE), 'org_' || (user_id % 10)
"""

def _prepared_news(latest: int) -> str:
    return f"""
        WITH titled AS (SELECT page_id, url, CASE WHEN page_id % 10 = 0 THEN ''
                 ELSE regexp_extract(html, '<title>(.+?)</title>', 1) END AS title
          FROM pages),
        articles AS (SELECT DISTINCT e.ts AS date, e.user_id AS ticker, t.url,
                 e.value - 100 AS tone, e.event_type AS source, t.title,
                 lower(c.c_name) AS organisation
          FROM events e JOIN titled t
            ON e.event_id % (SELECT count(*) FROM pages) = t.page_id
          JOIN customer c ON c.c_custkey = e.user_id
          WHERE e.event_id % 3 <> 0 AND length(t.title) > 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY ticker
            ORDER BY date DESC, url, tone, source, title, organisation) AS rank
          FROM articles)
        SELECT date, ticker, url, round(tone, 6) AS tone, source, title, organisation,
               CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE rank <= {latest}"""


ORACLES: dict[str, str] = {
    "walk_the_talk": f"""WITH {_news_after(_CSR)}
        SELECT lower(w.organisation) AS organisation, w.topic_id, w.policy,
               round(w.score, 6) AS walk, round(c.score, 6) AS talk
        FROM news_scores w JOIN csr c
          ON lower(w.organisation) = lower(c.organisation) AND w.topic_id = c.topic_id""",
    "argmax_topic": f"""WITH {_SCORED}
        SELECT vec_id, round(probability, 6) AS probability, topic_id FROM scored""",
    "sql_function": f"""WITH {_SCORED}
        SELECT vec_id, organisation, topic_id, round(probability, 6) AS probability
        FROM scored""",
    "labelled_distribution": f"""WITH {_SCORED}
        SELECT vec_id, organisation, t.topic_id, t.topic, t.policy,
               round(p[t.topic_id + 1], 6) AS probability
        FROM dist, topics t""",
    "indexed_distribution": f"""WITH {_TOPICS}, {_DIST},
        positions AS (SELECT vec_id, unnest(p) AS esg,
                             generate_subscripts(p, 1) - 1 AS topic_id FROM dist)
        SELECT CAST(n.topic_id AS INTEGER) AS topic_id, vec_id, round(esg, 6) AS esg,
               topic, policy
        FROM positions n JOIN topics t ON n.topic_id = t.topic_id""",
    "top_initiatives": f"""WITH {_INITIATIVES}
        SELECT organisation, vec_id, topic, policy, topic_id,
               round(probability, 6) AS probability FROM initiatives""",
    "topic_mass": f"""WITH {_DIST}
        SELECT CAST(i AS INTEGER) AS topic_id, organisation,
               round(sum(p[i + 1]), 6) AS esg
        FROM dist, {_POSITIONS} GROUP BY i, organisation""",
    "rank_score_rounded": f"WITH {_CSR} SELECT organisation, topic_id, score FROM csr",
    "rank_score_plain": f"""WITH {_ALL_NEWS}
        SELECT organisation, policy, topic, topic_id, round(esg, 6) AS esg,
               round(score, 6) AS score FROM news_scores""",
    "score_by_pillar": f"""WITH {_CSR}
        SELECT organisation, topic, round(avg(score), 6) AS score
        FROM csr JOIN topics USING (topic_id) GROUP BY organisation, topic""",
    "pivot_pillar": f"""WITH {_CSR}, named AS (
        SELECT organisation, topic, score FROM csr JOIN topics USING (topic_id))
        {_pillar_matrix('named')}""",
    "pivot_pillar_news": f"WITH {_ALL_NEWS} {_pillar_matrix('news_scores')}",
    "initiative_focus": f"""WITH {_INITIATIVES}, focus AS (
        SELECT organisation, t.policy, p[t.topic_id + 1] AS esg
        FROM initiatives i, topics t)
        {_policy_matrix('focus')}""",
    "pivot_policy_scaled": f"WITH {_ALL_NEWS} {_policy_matrix('weighted')}",
    "weighted_tone": f"""WITH {_ALL_NEWS}
        SELECT organisation, topic_id, topic, policy,
               round(weightedTone, 6) AS "weightedTone", round(weights, 6) AS weights,
               round(esg, 6) AS esg FROM weighted""",
    "articles_per_day": _PER_DAY,
    "articles_per_day_frame": _PER_DAY,
    "distinct_organisations": """
        SELECT count(DISTINCT user_id % 10) AS organisations FROM events""",
    "rows_per_key": "SELECT user_id, count(*) AS count FROM events GROUP BY user_id",
    "distinct_rows": "SELECT DISTINCT event_type, user_id FROM events",
    "latest_n_per_key": f"""
        WITH articles AS (SELECT DISTINCT ts AS date,
                 'org_' || (user_id % 10) AS organisation, value - 100 AS tone FROM events),
        ranked AS (SELECT *, row_number() OVER (
            PARTITION BY organisation ORDER BY date DESC, tone) AS rank FROM articles)
        SELECT date, organisation, round(tone, 6) AS tone, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE rank <= {fixed.LATEST_PER_TICKER}""",
    "latest_n_cut_first": f"""
        WITH ranked AS (SELECT ts AS date, 'org_' || (user_id % 10) AS organisation,
                 value - 100 AS tone, dense_rank() OVER (PARTITION BY user_id % 10
                     ORDER BY ts DESC, value - 100) AS rank FROM events)
        SELECT DISTINCT date, organisation, round(tone, 6) AS tone, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE rank <= {fixed.LATEST_PER_TICKER}""",
    "prefix_theme": """
        SELECT event_id, event_type, user_id FROM events
        WHERE len(list_filter([event_type, 'tag_' || event_type],
                              lambda x: starts_with(x, 'tag_c'))) > 0""",
    "prepared_news": _prepared_news(fixed.LATEST_PER_TICKER),
    "prepared_news_latest_20": _prepared_news(20),
    "paragraphs": f"""WITH {_PARAGRAPHS}
        SELECT doc_id, paragraph_no, paragraph FROM paragraphs""",
    "clean_statements": f"""WITH {_STATEMENTS}
        SELECT doc_id, source, paragraph_no, sentence_no, statement FROM statements
        WHERE length(statement) >= {fixed.MIN_STATEMENT_CHARS}""",
    "statement_arrays": f"""WITH {_STATEMENTS}, found AS (
          SELECT doc_id, count(*) AS n,
                 string_agg(statement, chr(10) ORDER BY paragraph_no, sentence_no) AS s
          FROM statements WHERE statement <> '' GROUP BY doc_id)
        SELECT d.doc_id, CAST(coalesce(n, 0) AS INTEGER) AS statements,
               md5(coalesce(s, '')) AS digest
        FROM documents d LEFT JOIN found USING (doc_id)""",
    "folded_text": f"SELECT doc_id, {_folded('text')} AS folded FROM documents",
    "tokens": f"""WITH found AS (SELECT doc_id, {_tokens('text')} AS t FROM documents)
        SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens,
               array_to_string(t, ' ') AS normalised FROM found""",
    "term_counts": f"""WITH found AS (SELECT unnest({_tokens('text')}) AS term FROM documents)
        SELECT term, count(*) AS count FROM found GROUP BY term""",
    "ranked_terms": f"""WITH {_STATEMENTS}, found AS (
          SELECT unnest({_tokens('statement')}) AS term FROM statements WHERE {_LONG}),
        counted AS (SELECT term, count(*) AS count FROM found GROUP BY term),
        ranked AS (SELECT *, row_number() OVER (ORDER BY count DESC, term) AS rank
                   FROM counted)
        SELECT term, count, rank FROM ranked""",
    "word_stems": f"""WITH {_TERMS}, {_stems('terms')} SELECT term, base FROM stemmed""",
    "stem_dictionary": f"""WITH {_TERMS}, {_stems('terms')},
        bases AS (SELECT base, sum(count)::BIGINT AS count, min(term) AS first
                  FROM stemmed JOIN terms USING (term) GROUP BY base),
        ranked AS (SELECT *, row_number() OVER (ORDER BY count DESC, base) - 1 AS term_id FROM bases)
        SELECT term_id, term, base, count, term = first AS is_first
        FROM stemmed JOIN ranked USING (base)""",
    "word_lemmas": f"""WITH {_TERMS}, offers AS ({_OFFERS}),
        fitting AS (SELECT o.term, o.base, row_number() OVER (PARTITION BY o.term ORDER BY rule_no) AS place
                    FROM offers o JOIN terms k ON o.base = k.term WHERE length(o.base) >= 3)
        SELECT t.term, coalesce(f.base, t.term) AS base
        FROM terms t LEFT JOIN fitting f ON t.term = f.term AND f.place = 1""",
    "folded_terms": """
        SELECT term, strip_accents(lower(term)) AS base FROM (
          SELECT DISTINCT unnest(string_split_regex(text, '[^\\pL\\pM\\pN]+')) AS term
          FROM documents) WHERE term <> ''""",
    "term_bags": f"""WITH {_TERMS},
        ranked AS (SELECT term, row_number() OVER (ORDER BY count DESC, term) - 1 AS term_id FROM terms)
        SELECT doc_id, term_id, count(*) AS n FROM occurring JOIN ranked USING (term)
        GROUP BY doc_id, term_id""",
    "word_stops": f"WITH {_PLACES} SELECT word, stopped, open FROM stops",
    "abbreviations": f"WITH {_PLACES} SELECT word, stopped, open, round(CASE WHEN score > 0 THEN score ELSE 0 END, 6) AS score FROM scored",
    "sentence_starters": f"""WITH {_LEARNED}
        SELECT word, at_start, tries, round(score, 6) AS score FROM starters""",
    "learned_statements": f"""WITH {_LEARNED_STATEMENTS}
        SELECT doc_id, paragraph_no, sentence_no, statement FROM learned WHERE {_LONG}""",
    "relevant_terms": f"""WITH {_MATRIX},
        shares AS ({" UNION ALL ".join(
            f"SELECT {i}::INTEGER AS topic_id, term, w{i} / t{i} AS share, "
            f"(w{i} / t{i}) / (count / n) AS lift FROM matrix, lengths" for i in range(4))}),
        scored AS (SELECT *, round(0.6 * ln(share) + 0.4 * ln(lift), 9) AS relevance FROM shares),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY topic_id
                     ORDER BY relevance DESC, term) AS rank FROM scored)
        SELECT topic_id, CAST(rank AS INTEGER) AS rank, term, round(share, 6) AS share,
               round(lift, 6) AS lift, round(relevance, 6) AS relevance
        FROM ranked WHERE rank <= 20""",
    "topic_distances": f"WITH {_MATRIX} " + " UNION ALL ".join(
        _apart(a, b) for a in range(4) for b in range(a + 1, 4)
    ),
    "clustered_by_several": """
        SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate FROM lineitem""",
    "topic_model_fit": f"""WITH {_STATEMENTS}, found AS (
          SELECT unnest({_tokens('statement')}) AS term FROM statements WHERE {_LONG}),
        counted AS (SELECT term, count(*) AS c, sum(count(*)) OVER () AS n FROM found GROUP BY term)
        SELECT count(*) AS terms, sum(c)::BIGINT AS tokens,
               round(-sum(c / n * ln(c / n)), 6) AS entropy,
               true AS is_better, true AS is_rising FROM counted""",
    "distribution_mass": f"""WITH {_STATEMENTS}
        SELECT doc_id, paragraph_no, sentence_no, CAST(5 AS INTEGER) AS topics,
               1.0::DOUBLE AS mass
        FROM statements WHERE {_LONG}""",
    "topic_model_scores": f"""WITH {_STATEMENTS}
        SELECT doc_id, paragraph_no, sentence_no, true AS is_share,
               true AS is_first_best, true AS is_same_reloaded
        FROM statements WHERE {_LONG}""",
    "topic_terms": """
        SELECT CAST(t AS INTEGER) AS topic_id, CAST(r AS INTEGER) AS rank,
               true AS falls, true AS known
        FROM range(5) topics(t), range(1, 11) ranks(r)""",
    "scored_view": f"""WITH {_STATEMENTS}
        SELECT doc_id, count(*) AS statements, CAST(count(*) AS DOUBLE) AS mass
        FROM statements WHERE {_LONG} GROUP BY doc_id""",
    "modelled_news": f"""WITH {_TOPICS}, found AS (
          SELECT DISTINCT 'org_' || (user_id % 10) AS organisation FROM events)
        SELECT organisation, policy, CAST(topic_id AS INTEGER) AS topic_id,
               true AS is_even_rank
        FROM found, topics""",
    "page_titles": """
        SELECT page_id, regexp_extract(html, '<title>(.+?)</title>', 1) AS title
        FROM pages
        WHERE length(regexp_extract(html, '<title>(.+?)</title>', 1)) > 0""",
    "page_text": f"SELECT page_id, {_markup('html')} AS text FROM pages",
    "joined_pages": """
        SELECT doc_id, replace(text, chr(10) || chr(10), chr(10)) AS text
        FROM documents""",
    "key_from_path": "SELECT doc_id, source AS ticker FROM documents",
    "preview": f"""
        SELECT doc_id, substring(text, 1, {fixed.PREVIEW_CHARS}) AS preview
        FROM documents""",
    "first_rows": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "metadata_join": """
        SELECT doc_id, lower(source) AS organisation, lang, quality, toxic
        FROM documents JOIN labels USING (doc_id)""",
    "delimited_join": """
        SELECT s_suppkey, s_name, n_name FROM supplier
        JOIN nation ON s_nationkey = n_nationkey""",
    "split_key_join": """
        SELECT c_custkey, o_orderkey, c_name, c_mktsegment FROM orders
        JOIN customer ON o_custkey = c_custkey""",
    "rank_by_ranges": """
        SELECT o_orderkey, o_orderstatus, o_totalprice, row_number() OVER (
          PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) AS rank
        FROM orders""",
    "insert_and_append": """
        SELECT c_nationkey AS "columnA", c_name AS "columnB" FROM customer
        UNION ALL SELECT * FROM (VALUES (1, 'one'), (2, 'two'), (60, 'SQL'),
                                        (60, 'local PYTHON'))""",
    "external_table": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "ctas_copy": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "table_names": """
        SELECT CAST(n AS INTEGER) AS parts, s_suppkey, s_name
        FROM supplier, (SELECT unnest([1, 2, 3]) AS n)""",
    "partition_export": """
        SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'""",
    "export_manifest": """
        SELECT 'orders' AS "table", 'report_share' AS share, 'reports' AS schema,
               '' AS partition, count(*) AS rows FROM orders
        UNION ALL
        SELECT 'orders_' || lower(o_orderstatus), 'report_share', 'reports',
               'o_orderstatus = ' || o_orderstatus, count(*)
        FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY o_orderstatus""",
    "shared_table_sums": """
        SELECT c_nationkey, round(sum(o_totalprice), 2) AS total
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey""",
    "shared_table_sql": """
        SELECT l_suppkey, sum(l_quantity) AS total FROM lineitem GROUP BY l_suppkey""",
    "sum_per_key_desc": """
        SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total
        FROM lineitem GROUP BY l_suppkey""",
    "clustered_write": """
        SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem""",
    "json_dimension": f"""WITH {_SCORED}
        SELECT vec_id, topic_id, topic, policy FROM scored JOIN topics USING (topic_id)""",
    "binary_scan": _DOCUMENT_FILES,
    "stream_ingest": _DOCUMENT_FILES,
    "stream_large_metadata": _DOCUMENT_FILES,
    "logo_metadata": """
        SELECT CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS logo_content,
               lower(s_name) AS organisation, n_name AS description
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
}
