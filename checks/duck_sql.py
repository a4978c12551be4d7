"""SQL counterparts of the Spark queries, over the same tables."""

from __future__ import annotations

from checks.setup import CHECK_LEXICONS, CHECK_STOP_WORDS, SETTINGS
from clipsieve.functions.rules import HANDLE_TAG, RULES, TERM, URL, WHITESPACE_CLASS
from clipsieve.operators.entities import ENTITY_MARKERS, TOPIC_SUFFIXES
from clipsieve.operators.integrity import GATE_FAILURES
from clipsieve.operators.lexicon import lexicon_rows

_RULES = RULES["documented"]
# DuckDB has no possessive repeats, and needs none.
PHRASE = r"[A-Z][a-z]+(?: [A-Z][a-z]+)*"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_quoted(word) for word in words) + "]"


def _values(rows) -> str:
    return ", ".join(
        "(" + ", ".join(_quoted(v) if isinstance(v, str) else str(v) for v in row) + ")" for row in rows
    )


_SPACE = _quoted(f"[{WHITESPACE_CLASS}]+")
_ENDS = _quoted(f"^[{WHITESPACE_CLASS}]+|[{WHITESPACE_CLASS}]+$")
_STOP = _list(SETTINGS.noise.stopwords)
_PLATFORM = _list(SETTINGS.noise.platform)
_NOISE = _list(SETTINGS.noise.all_words)


def _strip(value: str) -> str:
    return f"regexp_replace({value}, {_ENDS}, '', 'g')"


def _norm(value: str) -> str:
    return f"trim(regexp_replace(translate(lower({value}), '#_', '  '), {_SPACE}, ' ', 'g'), ' ')"


def _shown(value: str) -> str:
    return f"array_to_string({value}, '|')"


def _rounded(value: str, name: str) -> str:
    return f"round({value}, 6) + 0.0 AS {name}"


def _tokens(value: str) -> str:
    found = f"regexp_extract_all({value}, {_quoted(_RULES.token)})"
    return f"list_filter(list_transform({found}, lambda t: {_norm('t')}), lambda t: t <> '')"


def _drop(value: str, words: str) -> str:
    return f"list_filter({value}, lambda t: NOT list_contains({words}, lower(t)))"


def _reject(entity: str, kind: str) -> str:
    return f"""CASE
      WHEN {entity} = '' OR regexp_matches({entity}, {_quoted(_RULES.punct_only)}) THEN 'punct'
      WHEN regexp_matches({entity}, {_quoted(_RULES.digits_only)}) THEN 'digit_only'
      WHEN contains({entity}, '@') AND {kind} <> 'HANDLE' THEN 'handle_mistype'
      WHEN list_contains({_NOISE}, {_norm(entity)}) THEN 'noise'
      WHEN length({entity}) > 80 THEN 'too_long' END"""


def _tag_type(tag: str) -> str:
    suffixes = _quoted(f"({'|'.join(TOPIC_SUFFIXES)})$")
    markers = _quoted("|".join(ENTITY_MARKERS))
    return (
        f"CASE WHEN NOT regexp_matches(lower({tag}), {suffixes}) AND regexp_matches(lower({tag}), {markers}) "
        "THEN 'HASHTAG_ENTITY' ELSE 'HASHTAG_TOPIC' END"
    )


def _object_key(key: str) -> str:
    path = _quoted(f"$.{key}")
    text = f"json_extract_string(x, {path})"
    return f"""CASE json_type(x, {path})
        WHEN 'VARCHAR' THEN nullif({text}, '') WHEN 'BOOLEAN' THEN CASE WHEN {text} = 'true' THEN 'True' END
        WHEN 'NULL' THEN NULL
        ELSE CASE WHEN {text} NOT IN ('0', '0.0', '[]', '{{}}') THEN {text} END END"""


def _canon(value: str) -> str:
    return f"regexp_replace({_strip(value)}, {_SPACE}, ' ', 'g')"


_LINKS_GONE = (
    f"regexp_replace(regexp_replace(lower(desc_raw), {_quoted(URL)}, ' ', 'g'), "
    f"{_quoted(_RULES.handle)}, ' ', 'g')"
)

# Named subqueries: text and the names it reads.
_CTES: dict[str, str] = {
    "videos": """
      SELECT CAST(doc_id AS VARCHAR) AS video_id, source AS author_id,
        CAST(1700000000 + doc_id * 3600 AS DOUBLE) AS created_at,
        CASE WHEN doc_id % 10 = 9 THEN text
             ELSE text || ' https://v.example/' || CAST(doc_id AS VARCHAR)
                       || ' @' || source || ' #' || lang END AS desc_raw,
        CASE doc_id % 4
          WHEN 0 THEN '["#' || lang || '_life","' || source || ' tv"]'
          WHEN 1 THEN lang || ', #' || source
          WHEN 2 THEN '[{"title":"' || source || ' records"},{"name":"' || lang || '"},7,null]'
          ELSE NULL END AS challenges_raw,
        lang
      FROM documents""",
    "ingested": f"""
      SELECT video_id, author_id, created_at, coalesce(desc_raw, '') AS desc_raw, challenges_raw,
        list_filter(CASE
          WHEN challenges_raw IS NULL THEN CAST([] AS VARCHAR[])
          WHEN {_strip('challenges_raw')} LIKE '[%' AND {_strip('challenges_raw')} LIKE '%]' THEN
            CASE WHEN json_valid(challenges_raw) THEN
              list_transform(json_extract(challenges_raw, '$[*]'), lambda x: CASE json_type(x)
                WHEN 'VARCHAR' THEN json_extract_string(x, '$')
                WHEN 'OBJECT' THEN coalesce({_object_key('title')}, {_object_key('name')},
                                            {_object_key('challenge_name')}) END)
            ELSE CAST([] AS VARCHAR[]) END
          ELSE list_transform(string_split({_strip('challenges_raw')}, ','),
                              lambda p: {_strip("trim(p, '# ')")})
        END, lambda t: t IS NOT NULL AND t <> '') AS tags
      FROM videos""",
    "tokenized": f"""
      SELECT *, list_filter(flatten(list_transform(norms, lambda t: string_split(t, ' '))),
                            lambda t: t <> '') AS words
      FROM (SELECT *, list_transform(tags, lambda t: {_norm("trim(t, '# ')")}) AS norms,
              {_tokens(f"regexp_replace({_LINKS_GONE}, {_quoted(_RULES.inline_tag)}, ' ', 'g')")} AS topic,
              {_tokens(_LINKS_GONE)} AS lex
            FROM ingested)""",
    "evidence": f"""
      SELECT 'check' AS run_id, video_id, author_id, created_at,
        strftime(make_timestamp(CAST(created_at * 1000000 AS BIGINT)), '%Y-%m-%d') AS created_date,
        desc_raw, challenges_raw, tags AS hashtags_list_raw, norms AS hashtags_list_norm,
        'en' AS language_pred, CAST(0.51 AS DOUBLE) AS language_conf, TRUE AS language_keep,
        array_to_string({_drop('list_concat(topic, words)', _NOISE)}, ' ') AS topic_text,
        {_strip(f'''regexp_replace(regexp_replace(nfc_normalize(desc_raw), {_quoted(URL)}, '<URL>', 'g'),
           {_quoted(_RULES.handle)}, '<HANDLE>@\\1</HANDLE>', 'g') || ' ' ||
           array_to_string(list_transform(tags, lambda t: '[HASHTAG: ' || t || ']'), ' ')''')} AS ner_text,
        {_drop('list_concat(lex, words)', _NOISE)} AS lex_tokens,
        list_filter(list_concat(lex, words), lambda t: list_contains({_PLATFORM}, t)) AS noise_hits,
        'views.v1' AS text_view_version,
        len({_drop('list_concat(topic, words)', _NOISE)}) < 5 AS insufficient_topic_evidence,
        list_concat(lex, words) AS all_tokens
      FROM tokenized""",
    "lexicon": f"""
      SELECT * FROM (VALUES {_values(lexicon_rows(CHECK_LEXICONS))}) AS t(family, label, keyword, pos)""",
    "scoring": f"""
      SELECT video_id, unnest(list_concat({_drop('lex_tokens', _NOISE)},
        list_concat(list_filter(hashtags_list_norm, lambda t: t <> ''),
                    list_filter(hashtags_list_norm, lambda t: t <> '')))) AS token
      FROM evidence""",
    "hits": """
      SELECT video_id, family, label, keyword, pos, count(*) AS n
      FROM scoring JOIN lexicon ON token = keyword GROUP BY ALL""",
    "label_scores": """
      SELECT e.video_id, l.family, l.label, CAST(coalesce(sum(h.n), 0) AS DOUBLE) AS score
      FROM evidence e CROSS JOIN (SELECT DISTINCT family, label FROM lexicon) l
      LEFT JOIN hits h ON h.video_id = e.video_id AND h.family = l.family AND h.label = l.label
      GROUP BY ALL""",
    "polarity": """
      SELECT video_id, sum(CASE label WHEN 'positive' THEN score ELSE -score END) AS sentiment_polarity
      FROM label_scores WHERE family = 'sentiment' GROUP BY video_id""",
    "top_tokens": """
      SELECT video_id, family, label,
        row_number() OVER (PARTITION BY video_id, family, label ORDER BY n DESC, pos) AS rank,
        keyword AS token, CAST(n AS DOUBLE) AS weight
      FROM hits QUALIFY rank <= 5""",
    "candidates": f"""
      SELECT *, {_reject('canon', 'entity_type')} AS reason FROM (
        SELECT video_id, surface, {_canon('form')} AS canon, entity_type, source, confidence, ord FROM (
          SELECT video_id, '@' || h AS surface, '@' || h AS form, 'HANDLE' AS entity_type,
            'HANDLE_REGEX' AS source, CAST(0.99 AS DOUBLE) AS confidence, ord FROM (
              SELECT video_id, unnest(regexp_extract_all(ner_text, {_quoted(HANDLE_TAG)}, 1)) AS h,
                generate_subscripts(regexp_extract_all(ner_text, {_quoted(HANDLE_TAG)}, 1), 1) AS ord
              FROM evidence)
          UNION ALL
          SELECT video_id, raw, norm, {_tag_type('norm')}, 'HASHTAG_PARSE',
            CAST(CASE WHEN {_tag_type('norm')} = 'HASHTAG_ENTITY' THEN 0.75 ELSE 0.55 END AS DOUBLE),
            1000000 + ord FROM (
              SELECT video_id, unnest(hashtags_list_raw) AS raw, unnest(hashtags_list_norm) AS norm,
                generate_subscripts(hashtags_list_raw, 1) AS ord FROM evidence)
          UNION ALL
          SELECT video_id, p, p, 'PERSON', 'DESC_MODEL', CAST(0.5 AS DOUBLE), 2000000 + ord FROM (
              SELECT video_id, unnest(regexp_extract_all(ner_text, {_quoted(PHRASE)})) AS p,
                generate_subscripts(regexp_extract_all(ner_text, {_quoted(PHRASE)}), 1) AS ord
              FROM evidence)))""",
    "mentions": """
      SELECT 'check' AS run_id, video_id, surface AS entity_surface, lower(canon) AS entity_canon,
        entity_type, source, confidence, surface AS evidence_snippet, ord
      FROM candidates WHERE reason IS NULL""",
    "cl": """
      SELECT CAST(vec_id AS VARCHAR) AS video_id, label AS cluster_id, embedding FROM embeddings""",
    "sizes": "SELECT cluster_id, count(*) AS size FROM cl GROUP BY cluster_id",
    "centroids": """
      SELECT cluster_id, list(m ORDER BY i) AS centroid FROM (
        SELECT cluster_id, i, avg(CAST(embedding[i] AS DOUBLE)) AS m
        FROM (SELECT cluster_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM cl)
        GROUP BY cluster_id, i) GROUP BY cluster_id""",
    "cosines": """
      SELECT video_id, cl.cluster_id,
        list_cosine_similarity(CAST(embedding AS DOUBLE[]), centroid) AS cosine
      FROM cl JOIN centroids USING (cluster_id)""",
    "coherences": "SELECT cluster_id, count(*) AS size, avg(cosine) AS coherence FROM cosines GROUP BY cluster_id",
    "strengths": """
      SELECT video_id, cl.cluster_id,
        max(list_cosine_similarity(CAST(embedding AS DOUBLE[]), centroid)) AS strength
      FROM cl CROSS JOIN centroids GROUP BY video_id, cl.cluster_id""",
    "shares": """
      SELECT cluster_id, count(*) AS size,
        avg(CASE WHEN coalesce(insufficient_topic_evidence, FALSE) THEN 1.0 ELSE 0.0 END)
          AS pct_insufficient_topic
      FROM cl LEFT JOIN evidence USING (video_id) GROUP BY cluster_id""",
    "metrics": """
      SELECT cluster_id, coherence, pct_insufficient_topic,
        pct_insufficient_topic > 0.5 OR coherence < 0.2 AS platform_bucket
      FROM coherences JOIN shares USING (cluster_id)""",
    "topic_terms": f"""
      SELECT video_id, term, count(*) AS tf FROM (
        SELECT video_id, unnest(regexp_extract_all(lower(topic_text), {_quoted(TERM)})) AS term
        FROM evidence) GROUP BY ALL""",
    "vocabulary": """
      SELECT term, CAST(sum(tf) AS BIGINT) AS total, count(*) AS df FROM topic_terms
      GROUP BY term ORDER BY total DESC, term LIMIT 5000""",
    "weights": """
      SELECT video_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY video_id)) AS weight FROM (
        SELECT video_id, term,
          tf * (ln((1.0 + (SELECT count(*) FROM evidence)) / (1.0 + df)) + 1) AS w
        FROM topic_terms JOIN vocabulary USING (term))""",
    "texts": """
      SELECT video_id, cluster_id, topic_text, hashtags_list_norm FROM cl JOIN evidence USING (video_id)""",
    "view_terms": f"""
      SELECT cluster_id, "view", video_id, term, count(*) AS tf FROM (
        SELECT cluster_id, 'desc' AS "view", video_id,
          unnest(regexp_extract_all(lower(topic_text), {_quoted(TERM)})) AS term FROM texts
        UNION ALL
        SELECT cluster_id, 'hashtags', video_id,
          unnest(regexp_extract_all(lower(array_to_string(hashtags_list_norm, ' ')), {_quoted(TERM)}))
        FROM texts)
      WHERE NOT list_contains({_list(CHECK_STOP_WORDS)}, term) GROUP BY ALL""",
    "view_vocabulary": """
      SELECT cluster_id, "view", term, sum(tf) AS total, count(*) AS df FROM view_terms
      GROUP BY cluster_id, "view", term
      QUALIFY row_number() OVER (PARTITION BY cluster_id, "view" ORDER BY total DESC, term) <= 5000""",
    "keywords": """
      SELECT cluster_id, "view", term, score,
        row_number() OVER (PARTITION BY cluster_id, "view" ORDER BY score DESC, term) AS rank
      FROM (
        SELECT cluster_id, "view", term, round(sum(unit) / any_value(n), 10) AS score FROM (
          SELECT cluster_id, "view", term, n,
            w / sqrt(sum(w * w) OVER (PARTITION BY video_id, "view")) AS unit
          FROM (
            SELECT t.cluster_id, t."view", t.video_id, t.term, n,
              tf * (ln((1.0 + n) / (1.0 + df)) + 1) AS w
            FROM view_terms t JOIN view_vocabulary v
              ON t.cluster_id = v.cluster_id AND t."view" = v."view" AND t.term = v.term
            JOIN (SELECT cluster_id, count(*) AS n FROM texts GROUP BY cluster_id) s
              ON s.cluster_id = t.cluster_id))
        GROUP BY cluster_id, "view", term)
      QUALIFY rank <= 15""",
    "congruence": """
      SELECT c.cluster_id, CASE WHEN d = 0 OR h = 0 THEN 0.0 ELSE both_n / greatest(d + h - both_n, 1) END
        AS keyword_congruence
      FROM (SELECT cluster_id, count(*) FILTER ("view" = 'desc') AS d,
              count(*) FILTER ("view" = 'hashtags') AS h FROM keywords GROUP BY cluster_id) c
      JOIN (SELECT cluster_id, count(*) FILTER (n = 2) AS both_n FROM (
              SELECT cluster_id, term, count(*) AS n FROM keywords GROUP BY ALL) GROUP BY cluster_id) b
        ON b.cluster_id = c.cluster_id""",
    "medians": """
      SELECT cluster_id, CAST(median(len(list_filter(string_split(topic_text, ' '), lambda w: w <> '')))
        AS DOUBLE) AS median_topic_length FROM texts GROUP BY cluster_id""",
    "anchor_rows": """
      SELECT cluster_id, entity_type AS type, entity_canon AS entity, count(*) AS support,
        count(*) / any_value(size) AS coverage,
        row_number() OVER (PARTITION BY cluster_id, entity_type ORDER BY count(*) DESC, entity_canon)
          AS rank
      FROM mentions JOIN cl USING (video_id) JOIN sizes USING (cluster_id)
      GROUP BY cluster_id, entity_type, entity_canon QUALIFY rank <= 10""",
    "quality": """
      SELECT cluster_id, coalesce(anchored, 0) / size AS anchor_coverage,
        coalesce(garbage, 0.0) AS anchor_garbage_rate
      FROM sizes
      LEFT JOIN (SELECT cluster_id, count(*) AS anchored FROM cl
                 WHERE video_id IN (SELECT video_id FROM mentions) GROUP BY cluster_id)
        USING (cluster_id)
      LEFT JOIN (SELECT cluster_id, avg(CASE WHEN coverage < 0.05 THEN 1.0 ELSE 0.0 END) AS garbage
                 FROM anchor_rows GROUP BY cluster_id) USING (cluster_id)""",
    "samples": """
      SELECT cluster_id, video_id, row_number() OVER (PARTITION BY cluster_id ORDER BY video_id) AS rank
      FROM cl QUALIFY rank <= 20""",
    "profiles": """
      SELECT cluster_id, size, coherence, pct_insufficient_topic AS pct_insufficient_topic_evidence,
        anchor_coverage, anchor_garbage_rate, coalesce(keyword_congruence, 0.0) AS keyword_congruence,
        coalesce(median_topic_length, 0.0) AS median_topic_length
      FROM sizes JOIN metrics USING (cluster_id) JOIN quality USING (cluster_id)
      LEFT JOIN congruence USING (cluster_id) LEFT JOIN medians USING (cluster_id)""",
    "flagged": """
      SELECT *, CASE WHEN contains(flags, 'platform_bucket') OR contains(flags, 'low_anchor_coverage')
          THEN 'quarantine_low_evidence'
          WHEN contains(flags, 'low_congruence') THEN 'review' ELSE 'good' END AS recommended_action
      FROM (SELECT *, concat_ws(';',
          CASE WHEN pct_insufficient_topic_evidence > 0.5 THEN 'platform_bucket' END,
          CASE WHEN keyword_congruence < 0.1 THEN 'low_congruence' END,
          CASE WHEN anchor_coverage < 0.2 OR anchor_garbage_rate > 0.25 THEN 'low_anchor_coverage' END)
          AS flags FROM profiles)""",
    "quantiles": """
      SELECT cluster_id, quantile_cont(strength, 0.5) AS strength_median,
        quantile_cont(strength, 0.75) - quantile_cont(strength, 0.25) AS strength_iqr
      FROM strengths GROUP BY cluster_id""",
    "stages": """
      SELECT 'evidence' AS stage, video_id FROM evidence
      UNION ALL SELECT 'embeddings', video_id FROM cl
      UNION ALL SELECT 'entities_by_video', video_id FROM (SELECT DISTINCT video_id FROM mentions)
      UNION ALL SELECT 'clusters', video_id FROM cl""",
    "hashes": """
      SELECT stage, md5(concat_ws('|', CAST(count(*) AS VARCHAR),
        CAST(bit_xor(CAST('0x' || substr(d, 1, 15) AS BIGINT)) AS VARCHAR),
        CAST(sum(CAST('0x' || substr(d, 17, 15) AS BIGINT)) AS VARCHAR))) AS universe_hash
      FROM (SELECT stage, md5(video_id) AS d FROM stages) GROUP BY stage""",
    "sample_check": """
      SELECT count(*) FILTER (EXISTS (SELECT 1 FROM evidence e WHERE e.video_id = s.video_id)
          AND EXISTS (SELECT 1 FROM cl WHERE cl.video_id = s.video_id AND cl.cluster_id = s.cluster_id))
          AS matches,
        count(*) AS total
      FROM samples s WHERE cluster_id IN (
        SELECT cluster_id FROM sizes ORDER BY md5('7:' || CAST(cluster_id AS VARCHAR)) LIMIT 5)""",
    "qa": f"""
      SELECT (SELECT count(*) FROM evidence) AS universe,
        (SELECT count(DISTINCT video_id) FROM mentions) / (SELECT count(*) FROM evidence) AS coverage,
        avg(CASE WHEN regexp_matches(entity_surface, {_quoted(_RULES.punct_only)}) THEN 1.0 ELSE 0.0 END)
          AS garbage_rate,
        coalesce(avg(CASE WHEN contains(entity_surface, '@') THEN 1.0 ELSE 0.0 END)
          FILTER (entity_type IN ('PERSON', 'ORG_BRAND')), 0.0) AS handle_mistype_rate
      FROM mentions""",
}


def _reads(sql: str) -> list[str]:
    import re

    words = set(re.findall(r"[a-z_]+", sql))
    return [name for name in _CTES if name in words]


def _needed(sql: str) -> list[str]:
    found: set[str] = set()
    open_names = _reads(sql)
    while open_names:
        name = open_names.pop()
        if name not in found:
            found.add(name)
            open_names += [other for other in _reads(_CTES[name]) if other != name]
    return [name for name in _CTES if name in found]


def _with(sql: str) -> str:
    names = _needed(sql)
    if not names:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({_CTES[name]})" for name in names) + "\n" + sql


def _mentions_from(source: str) -> str:
    return (
        "SELECT video_id, entity_surface, entity_canon, entity_type, source, confidence, evidence_snippet "
        f"FROM mentions WHERE source = '{source}'"
    )


_PROFILE_COLUMNS = ", ".join(
    _rounded(name, name)
    for name in (
        "coherence",
        "pct_insufficient_topic_evidence",
        "anchor_coverage",
        "anchor_garbage_rate",
        "keyword_congruence",
        "median_topic_length",
    )
)

_FAILURES = (
    "concat_ws('|', "
    + ", ".join(f"CASE WHEN NOT {gate} THEN {_quoted(text)} END" for gate, text in GATE_FAILURES.items())
    + ")"
)

_QUERIES: dict[str, str] = {
    "scan_videos": "SELECT video_id, author_id, created_at, desc_raw, challenges_raw FROM videos",
    "normalize_columns": """
      SELECT video_id, CASE WHEN lang <> 'de' THEN author_id ELSE 'unknown' END AS author_id, created_at,
        desc_raw, CAST(NULL AS VARCHAR) AS challenges_raw FROM videos""",
    "ingest_checks": """
      SELECT count(*) AS raw_rows, count(*) FILTER (lang = 'es') AS rows_without_id,
        count(*) FILTER (lang = 'de') AS rows_without_author,
        count(*) FILTER (lang <> 'de') = 0 AS all_authors_missing FROM videos""",
    "parse_challenges": f"SELECT video_id, {_shown('tags')} AS tags, len(tags) AS n FROM ingested",
    "ingest": f"""
      SELECT video_id, author_id, created_at, desc_raw, challenges_raw,
        {_shown('tags')} AS hashtags_list_raw FROM ingested""",
    "created_date": "SELECT video_id, created_at, created_date FROM evidence",
    "created_date_events": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS created_date FROM events",
    "duplicate_ids": "SELECT author_id AS video_id, count(*) AS n FROM videos GROUP BY author_id HAVING n > 1",
    "keep_one": """
      SELECT author_id, created_at, video_id AS kept_id FROM videos
      QUALIFY row_number() OVER (PARTITION BY author_id ORDER BY created_at DESC, video_id) = 1""",
    "normalize_token": f"""
      SELECT video_id, tag, {_norm('tag')} AS token
      FROM (SELECT video_id, unnest(tags) AS tag FROM ingested)""",
    "hashtag_norm": f"SELECT video_id, {_shown('norms')} AS tags, {_shown('words')} AS words FROM tokenized",
    "topic_text": "SELECT video_id, topic_text FROM evidence",
    "ner_text": "SELECT video_id, ner_text FROM evidence",
    "lex_tokens": f"SELECT video_id, {_shown('lex_tokens')} AS lex_tokens FROM evidence",
    "noise_hits": f"SELECT video_id, {_shown('noise_hits')} AS noise_hits FROM evidence",
    "noise_filter": f"""
      SELECT video_id, {_shown(_drop("string_split(desc_raw, ' ')", _NOISE))} AS kept FROM videos""",
    "insufficient_flag": f"""
      SELECT video_id, n, n < 5 AS insufficient_topic_evidence FROM (
        SELECT video_id, len({_drop('list_concat(topic, words)', _NOISE)}) AS n FROM tokenized)""",
    "language_filter": """
      SELECT video_id, lang AS language_pred, CAST(0.9 AS DOUBLE) AS language_conf, TRUE AS language_keep
      FROM videos WHERE lang = 'en'""",
    "prepare_evidence": f"""
      SELECT * EXCLUDE (all_tokens) REPLACE ({_shown('hashtags_list_raw')} AS hashtags_list_raw,
        {_shown('hashtags_list_norm')} AS hashtags_list_norm, {_shown('lex_tokens')} AS lex_tokens,
        {_shown('noise_hits')} AS noise_hits) FROM evidence""",
    "token_noise_report": f"""
      SELECT section, token, n, row_number() OVER (PARTITION BY section ORDER BY n DESC, token) AS rank
      FROM (
        SELECT unnest(CASE WHEN list_contains({_PLATFORM}, token) THEN ['removed', 'platform']
                           WHEN list_contains({_STOP}, token) THEN ['removed'] ELSE ['kept'] END) AS section,
          token, n
        FROM (SELECT token, count(*) AS n FROM (SELECT unnest(all_tokens) AS token FROM evidence)
              GROUP BY token))
      QUALIFY rank <= 25""",
    "lexicon_hits": "SELECT video_id, family, label, keyword, CAST(pos AS BIGINT) AS pos, n FROM hits",
    "lexicon_scores": "SELECT video_id, family, label, score FROM label_scores",
    "lexicon_top_tokens": "SELECT video_id, family, label, rank, token, weight FROM top_tokens",
    "sentiment_polarity": "SELECT video_id, sentiment_polarity FROM polarity",
    "lexicon_evidence_maps": f"""
      SELECT video_id, CAST({len(CHECK_LEXICONS)} AS BIGINT) AS families, CAST(2 AS BIGINT) AS labels,
        count(*) FILTER (family = 'function_words' AND score > 0) AS labels_with_hits
      FROM label_scores GROUP BY video_id""",
    "entity_canon": f"""
      SELECT video_id, tag, {_canon('tag')} AS canon
      FROM (SELECT video_id, unnest(tags) AS tag FROM ingested)""",
    "handle_mentions": _mentions_from("HANDLE_REGEX"),
    "hashtag_mentions": _mentions_from("HASHTAG_PARSE"),
    "phrase_mentions": _mentions_from("DESC_MODEL"),
    "structured_mentions": f"""
      SELECT video_id, surface AS entity_surface, lower({_canon('surface')}) AS entity_canon,
        'WORK' AS entity_type, 'QA_STRUCTURED' AS source, CAST(0.6 AS DOUBLE) AS confidence,
        surface AS evidence_snippet
      FROM (SELECT 'p' || CAST(p_partkey AS VARCHAR) AS video_id, p_name AS surface FROM part
            UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), s_name FROM supplier)
      WHERE surface <> '' AND ({_reject(_canon('surface'), "'WORK'")}) IS NULL""",
    "hashtag_type": f"""
      SELECT video_id, tag, {_tag_type('tag')} AS type
      FROM (SELECT video_id, unnest(norms) AS tag FROM tokenized)""",
    "entity_reject": f"""
      SELECT word, coalesce({_reject('word', "'PERSON'")}, 'accepted') AS reason, count(*) AS n
      FROM (SELECT unnest(string_split(desc_raw, ' ')) AS word FROM videos) GROUP BY ALL""",
    "mentions": """
      SELECT run_id, video_id, entity_surface, entity_canon, entity_type, source, confidence,
        evidence_snippet FROM mentions""",
    "entities_by_video": """
      SELECT video_id, entity_type, string_agg(entity_canon, '|' ORDER BY ord) AS entities
      FROM mentions GROUP BY video_id, entity_type""",
    "reject_stats": """
      SELECT video_id, reason, count(*) AS n FROM candidates WHERE reason IS NOT NULL GROUP BY ALL""",
    "top_reject_reasons": """
      SELECT reason, count(*) AS n FROM candidates
      WHERE reason IS NOT NULL AND video_id IN (SELECT video_id FROM mentions)
      GROUP BY reason ORDER BY n DESC, reason LIMIT 10""",
    "ner_qa": f"""
      SELECT universe, {_rounded('coverage', 'coverage')}, {_rounded('garbage_rate', 'garbage_rate')},
        {_rounded('handle_mistype_rate', 'handle_mistype_rate')} FROM qa""",
    "cluster_size": "SELECT cluster_id, size FROM sizes",
    "cluster_insufficient": f"""
      SELECT cluster_id, size, {_rounded('pct_insufficient_topic', 'pct_insufficient_topic')} FROM shares""",
    "cluster_coherence": f"SELECT cluster_id, size, {_rounded('coherence', 'coherence')} FROM coherences",
    "cosine_to_centroid": f"SELECT video_id, cluster_id, {_rounded('cosine', 'cosine')} FROM cosines",
    "membership_strength": f"SELECT video_id, cluster_id, {_rounded('strength', 'strength')} FROM strengths",
    "platform_bucket": """
      SELECT video_id, cluster_id, platform_bucket AS is_noise FROM cl JOIN metrics USING (cluster_id)""",
    "cluster_metrics": f"""
      SELECT cluster_id, {_rounded('coherence', 'coherence')},
        {_rounded('pct_insufficient_topic', 'pct_insufficient_topic')}, platform_bucket FROM metrics""",
    "cluster_qa": f"""
      SELECT count(DISTINCT cluster_id) AS clusters, {_rounded('avg(coherence)', 'coherence_mean')},
        {_rounded('median(coherence)', 'coherence_median')},
        count(*) FILTER (platform_bucket) AS flagged FROM metrics""",
    "strength_quantiles": f"""
      SELECT cluster_id, {_rounded('strength_median', 'strength_median')},
        {_rounded('strength_iqr', 'strength_iqr')} FROM quantiles""",
    "vocab_cap": "SELECT term, total, df FROM vocabulary",
    "tfidf_weights": f"SELECT video_id, term, {_rounded('weight', 'weight')} FROM weights",
    "keywords_desc": f"""
      SELECT cluster_id, rank, term, {_rounded('score', 'score')} FROM keywords WHERE "view" = 'desc'""",
    "keywords_hashtags": f"""
      SELECT cluster_id, rank, term, {_rounded('score', 'score')} FROM keywords WHERE "view" = 'hashtags'""",
    "keyword_congruence": f"""
      SELECT cluster_id, {_rounded('keyword_congruence', 'keyword_congruence')} FROM congruence""",
    "median_topic_length": "SELECT cluster_id, median_topic_length FROM medians",
    "cluster_texts": f"""
      SELECT video_id, cluster_id, topic_text, {_shown('hashtags_list_norm')} AS hashtags_list_norm
      FROM texts""",
    "anchor_semi_join": """
      SELECT video_id, cluster_id FROM cl WHERE video_id IN (SELECT video_id FROM mentions)""",
    "anchors": f"""
      SELECT cluster_id, type, rank, entity, support, {_rounded('coverage', 'coverage')}
      FROM anchor_rows""",
    "anchor_quality": f"""
      SELECT cluster_id, {_rounded('anchor_coverage', 'anchor_coverage')},
        {_rounded('anchor_garbage_rate', 'anchor_garbage_rate')} FROM quality""",
    "sample_ids": """
      SELECT cluster_id, string_agg(video_id, '|' ORDER BY video_id) AS sample_video_ids
      FROM samples GROUP BY cluster_id""",
    "profiles": f"SELECT cluster_id, size, {_PROFILE_COLUMNS} FROM profiles",
    "stage_counts": "SELECT stage, count(*) AS n FROM stages GROUP BY stage",
    "universe_hash": "SELECT stage, universe_hash FROM hashes",
    "universe_equal": """
      SELECT s.stage, count(*) FILTER (coalesce(n, 0) = 0) AS missing,
        count(*) FILTER (coalesce(n, 0) > 1) AS repeated
      FROM (SELECT DISTINCT stage FROM stages) s CROSS JOIN (SELECT DISTINCT video_id FROM stages) i
      LEFT JOIN (SELECT stage, video_id, count(*) AS n FROM stages GROUP BY ALL) c
        ON c.stage = s.stage AND c.video_id = i.video_id
      GROUP BY s.stage""",
    "universe_ids": """
      SELECT video_id, stage, coalesce(n, 0) AS n, n_first
      FROM (SELECT i.video_id, s.stage, c.n, coalesce(f.n, 0) AS n_first
        FROM (SELECT DISTINCT video_id FROM stages) i CROSS JOIN (SELECT DISTINCT stage FROM stages) s
        LEFT JOIN (SELECT stage, video_id, count(*) AS n FROM stages GROUP BY ALL) c
          ON c.stage = s.stage AND c.video_id = i.video_id
        LEFT JOIN (SELECT video_id, count(*) AS n FROM stages WHERE stage = 'evidence' GROUP BY ALL) f
          ON f.video_id = i.video_id)
      WHERE coalesce(n, 0) <> n_first""",
    "gate_sample_validity": """
      SELECT matches, total, CASE WHEN total > 0 THEN matches / total ELSE 0.0 END AS sample_video_rate
      FROM sample_check""",
    "integrity_gates": f"""
      SELECT *, CASE WHEN gate_failures = '' THEN 'VALID_FOR_OPERATOR_REVIEW'
                     ELSE 'INVALID_FOR_OPERATOR_REVIEW' END AS run_status
      FROM (SELECT *, {_FAILURES} AS gate_failures FROM (
        SELECT *, sample_video_rate >= 0.9 AS samples_valid, ner_coverage >= 0.9 AS coverage_ok,
          weak_profiles = 0 AS anchors_ok
        FROM (SELECT (SELECT universe_hash FROM hashes WHERE stage = 'evidence') AS universe_hash,
          (SELECT count(DISTINCT universe_hash) FROM hashes) = 1 AS hashes_match,
          (SELECT {_rounded('matches / total', 'r')} FROM sample_check) AS sample_video_rate,
          (SELECT {_rounded('coverage', 'c')} FROM qa) AS ner_coverage,
          (SELECT count(*) FROM profiles WHERE anchor_coverage < 0.2 OR anchor_garbage_rate > 0.25)
            AS weak_profiles)))""",
    "card_flags": "SELECT cluster_id, flags, recommended_action FROM flagged",
    "cluster_index": f"""
      SELECT cluster_id, size, {_rounded('coherence', 'coherence_score')},
        {_rounded('strength_median', 'strength_median')}, {_rounded('strength_iqr', 'strength_iqr')},
        {_rounded('pct_insufficient_topic_evidence', 'pct_insufficient_topic_evidence')},
        {_rounded('keyword_congruence', 'keyword_congruence_score')},
        {_rounded('anchor_coverage', 'anchor_coverage')},
        {_rounded('anchor_garbage_rate', 'anchor_garbage_rate')}, flags, recommended_action
      FROM flagged JOIN quantiles USING (cluster_id) ORDER BY recommended_action, cluster_id""",
    "cluster_sentiment": f"""
      SELECT cluster_id, {_rounded('avg(sentiment_polarity)', 'mean_polarity')}, count(*) AS scored
      FROM cl JOIN polarity USING (video_id) GROUP BY cluster_id""",
    "lexicon_overlay": """
      SELECT cluster_id, family, label, token, weight, video_id,
        row_number() OVER (PARTITION BY cluster_id, family, label ORDER BY weight DESC, token, video_id)
          AS rank
      FROM (SELECT cluster_id, family, label, token, weight, video_id
            FROM top_tokens JOIN cl USING (video_id))
      QUALIFY rank <= 5""",
    "exemplars": """
      SELECT s.cluster_id, s.rank, s.video_id, substr(desc_raw, 1, 180) AS snippet,
        array_to_string(hashtags_list_norm, ' ') AS hashtags
      FROM samples s LEFT JOIN evidence e ON e.video_id = s.video_id""",
    "embed_ids": """
      SELECT video_id, greatest(1, least(64, (SELECT count(*) FROM vocabulary) - 1)) AS dims
      FROM evidence""",
}

SQL: dict[str, str] = {name: _with(sql.strip()) for name, sql in _QUERIES.items()}

SQL["kmeans_facts"] = """
    SELECT count(*) AS n, count(*) AS nearest, count(*) AS strong, true AS cheap FROM embeddings"""
SQL["embed_facts"] = """
    SELECT count(*) AS n, count(*) AS inside, true AS uncorrelated, true AS ordered FROM documents"""
SQL["cluster_facts"] = """
    SELECT count(*) AS n, count(*) AS bounded, count(*) AS flagged_right FROM documents"""



def _fixed(value: str, digits: int) -> str:
    return f"format('{{:.{digits}f}}', CAST({value} AS DOUBLE))"


def _card_sql() -> str:
    """The text of every card, put together from the same parts as the other queries."""
    families = list(CHECK_LEXICONS)

    def keyword_lines(view: str) -> str:
        return f"""SELECT cluster_id,
            string_agg('- ' || term || ' (' || {_fixed("score", 3)} || ')', chr(10) ORDER BY rank) AS block
          FROM keywords WHERE "view" = '{view}' GROUP BY cluster_id"""

    blocks = ", ".join(
        f"'- **{family}**', string_agg(line, chr(10) ORDER BY label) FILTER (family = {_quoted(family)})"
        for family in families
    )
    plain = " || chr(10) || ".join(_quoted(f"- **{family}**") for family in families)
    parts = f"""
      desc_lines AS ({keyword_lines("desc")}),
      tag_lines AS ({keyword_lines("hashtags")}),
      anchor_lines AS (
        SELECT cluster_id, string_agg('- **' || type || '**' || chr(10) || items, chr(10) ORDER BY type) AS block
        FROM (SELECT cluster_id, type, string_agg('  - ' || entity || ' (coverage ' || {_fixed("coverage", 2)}
                || ', support ' || support || ')', chr(10) ORDER BY rank) AS items
              FROM anchor_rows GROUP BY cluster_id, type) GROUP BY cluster_id),
      overlay AS (
        SELECT cluster_id, concat_ws(chr(10), {blocks}) AS block
        FROM (SELECT cluster_id, family, label, '  - ' || label || ': ' ||
                string_agg(token || ' (' || {_fixed("weight", 2)} || ')', ', ' ORDER BY rank) AS line
              FROM ({_QUERIES["lexicon_overlay"]}) GROUP BY cluster_id, family, label)
        GROUP BY cluster_id),
      moods AS (SELECT cluster_id, avg(sentiment_polarity) AS mean_polarity
                FROM cl JOIN polarity USING (video_id) GROUP BY cluster_id),
      examples AS (
        SELECT cluster_id, string_agg(concat_ws(chr(10), '- Video ' || video_id, '  - desc: ' || snippet,
          '  - hashtags: ' || hashtags), chr(10) ORDER BY rank) AS block
        FROM ({_QUERIES["exemplars"]}) GROUP BY cluster_id)"""
    lines = f"""
      SELECT cluster_id, concat_ws(chr(10),
        '# Cluster ' || cluster_id, 'Run: check', 'Size: ' || size, 'Coherence: ' || {_fixed("coherence", 3)},
        'Strength median/IQR: ' || {_fixed("strength_median", 3)} || ' / ' || {_fixed("strength_iqr", 3)},
        'Anchor coverage: ' || {_fixed("anchor_coverage", 2)} || ' (garbage ' || {_fixed("anchor_garbage_rate", 2)} || ')',
        chr(10) || '## What it''s about', '### Description keywords', d.block, '### Hashtag keywords', t.block,
        chr(10) || '## Entities/Anchors (typed)',
        CASE WHEN anchor_coverage < 0.2 OR anchor_garbage_rate > 0.25
             THEN 'Anchors withheld due to quality thresholds.' ELSE a.block END,
        chr(10) || '## Sentiment',
        coalesce('- mean polarity: ' || {_fixed("mean_polarity", 3)}, '- sentiment unavailable'),
        chr(10) || '## Lexicon overlays (top contributing tokens)', coalesce(o.block, {plain}),
        chr(10) || '## Exemplars', x.block) AS card_md
      FROM flagged JOIN quantiles USING (cluster_id)
      LEFT JOIN desc_lines d USING (cluster_id) LEFT JOIN tag_lines t USING (cluster_id)
      LEFT JOIN anchor_lines a USING (cluster_id) LEFT JOIN overlay o USING (cluster_id)
      LEFT JOIN moods USING (cluster_id) LEFT JOIN examples x USING (cluster_id)"""
    shared = ",\n".join(f"{name} AS ({_CTES[name]})" for name in _needed(parts + lines))
    return f"WITH {shared},{parts}{lines}"


SQL["cards"] = _card_sql()

# What is read back from a sink is what was written.
for _sink, _query in {
    "sink_evidence": "prepare_evidence",
    "sink_lexicon": "lexicon_scores",
    "sink_mentions": "mentions",
    "sink_entities": "entities_by_video",
    "sink_embeddings": "embed_ids",
    "sink_profiles": "profiles",
    "sink_index": "cluster_index",
    "sink_manifest": "stage_counts",
}.items():
    SQL[_sink] = SQL[_query]
SQL["sink_clusters"] = f"SELECT video_id, cluster_id, is_noise FROM ({SQL['platform_bucket']})"
SQL["sink_report"] = f"SELECT '- ' || token || ': ' || n AS line FROM ({SQL['token_noise_report']})"
SQL["hook_detector"] = f"""
    SELECT video_id, CASE WHEN seen THEN 'en' ELSE 'xx' END AS language_pred,
           CASE WHEN seen THEN 0.9::DOUBLE ELSE 0.25::DOUBLE END AS language_conf, seen AS language_keep
    FROM (SELECT video_id, contains(desc_raw, ' the ') AS seen FROM ({SQL['ingest']}))"""
SQL["hook_encoder"] = f"""
    SELECT video_id, length(topic_text)::DOUBLE AS chars,
           (length(topic_text) - length(replace(topic_text, 'e', '')))::DOUBLE AS es FROM ({SQL['topic_text']})"""
SQL["hook_entities"] = f"""
    SELECT video_id, word AS surface, 'PERSON' AS type,
           CASE WHEN length(word) % 2 = 1 THEN 0.8::DOUBLE ELSE 0.0::DOUBLE END AS confidence
    FROM (SELECT video_id, split_part(ner_text, ' ', 1) AS word FROM ({SQL['ner_text']}))"""

# Stages that lie together by id give the same rows.
for _colocated, _query in {
    "colocated_texts": "cluster_texts",
    "colocated_insufficient": "cluster_insufficient",
    "colocated_sentiment": "cluster_sentiment",
    "colocated_exemplars": "exemplars",
}.items():
    SQL[_colocated] = SQL[_query]

# A summary only chooses what is counted.
SQL["vocab_cap_summary"] = SQL["vocab_cap"]
SQL["token_noise_summary"] = SQL["token_noise_report"]
SQL["sink_cards"] = """
    SELECT label::BIGINT AS cluster_id, 1::BIGINT AS headings, count(*) AS size FROM embeddings GROUP BY label"""
