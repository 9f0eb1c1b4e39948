"""The check SQL of the queries."""

from __future__ import annotations

from checks import sql as S
from postlens.functions.wordlists import STOP_WORDS

DOCS = "docs AS (SELECT CAST(doc_id AS VARCHAR) AS id_post, text FROM documents)"
CLEAN = f"WITH {DOCS},\n{S.clean_cte('docs')}\n"
TOKENS = f"WITH {DOCS},\ntoks AS MATERIALIZED (SELECT id_post, {S.token_list(S.clean('lower(text)'))} AS tokens FROM docs)\n"
LEMMAS = TOKENS + f""", nouns AS (SELECT DISTINCT unnest(string_split({S.clean('lower(text)')}, ' ')) AS noun FROM benchmark),
tw AS (SELECT id_post, unnest(tokens) AS form, unnest(range(1, len(tokens) + 1)) AS pos FROM toks),
endings(ending, replacement) AS (VALUES ('', ''), ('s', ''), ('ses', 's'), ('ves', 'f'), ('xes', 'x'), ('zes', 'z'),
  ('ches', 'ch'), ('shes', 'sh'), ('men', 'man'), ('ies', 'y')),
cand AS (SELECT DISTINCT form, left(form, length(form) - length(ending)) || replacement AS lemma
  FROM (SELECT DISTINCT form FROM tw) JOIN endings ON form LIKE '%' || ending),
best AS (SELECT form, lemma FROM cand WHERE lemma IN (SELECT noun FROM nouns)
  QUALIFY row_number() OVER (PARTITION BY form ORDER BY length(lemma), lemma) = 1)"""
SCORED = f"WITH {DOCS},\n{S.clean_cte('docs')},\n{S.words_cte('clean', 'processed_text')},\n"
PROFILES = f"WITH {DOCS},\n{S.profile_cte('documents', 'text', 'lang')}"
ENRICHED = "WITH " + S.enriched_with(S.POSTS, "posts") + "\n"
FLAT = "WITH " + S.enriched_with(S.POSTS, "posts") + ",\n" + S.FLAT + "\n"
CHECKED = f"""WITH {S.PAGES}, checked AS (
  SELECT *, CASE WHEN page_id IS NULL THEN 'missing_id'
                 WHEN TRY_CAST(score AS DOUBLE) IS NULL THEN 'bad_number:score' END AS reason FROM raw_pages)
"""
PREVIEW = """left('{' || CASE WHEN page_id IS NULL THEN '' ELSE '"page_id":' || page_id || ',' END
  || '"url":"' || url || '","score":"' || score || '"}', 200)"""
RESULTS = """id_post, language, confidence, polarity, subjectivity, polarity_label, compound, positive, neutral,
  negative, valence_label, final_sentiment, sentiment_confidence, final_score"""
VALENCE = """SELECT id_post, coalesce(compound, 0e0) AS compound, coalesce(positive, 0e0) AS positive,
  coalesce(neutral, 1e0) AS neutral, coalesce(negative, 0e0) AS negative,
  coalesce(valence_label, 'neutral') AS valence_label FROM docs LEFT JOIN valence USING (id_post)"""
NAMES = ["id_post", "text", "label", "type", "lang", "processed", "nlp_processed"]


def profile_row(name: str) -> str:
    kind = "boolean" if "processed" in name else "string"
    n = f"length(CAST({name} AS VARCHAR))"
    return (
        f"SELECT '{name}' AS field, '{kind}' AS type, count({name}) AS present, count(*) - count({name}) AS missing, "
        f"CAST(min({n}) AS BIGINT) AS min_length, CAST(max({n}) AS BIGINT) AS max_length, avg({n}) AS avg_length FROM posts"
    )


def share(field: str) -> str:
    return f"SELECT {field}, count, CAST(count AS DOUBLE) / CAST(sum(count) OVER () AS DOUBLE) AS share"


RUN_POSTS = f"""run_posts AS (SELECT CASE WHEN (conv_id + turn) % 17 > 0 THEN concat_ws('-', conv_id, turn) END AS id_post, text, role AS label,
  'turn ' || turn % 3 AS type FROM conversations),
{S.clean_cte('run_posts')},
fl AS MATERIALIZED (SELECT id_post, {S.letters('original_text')} AS l FROM clean WHERE id_post IS NOT NULL),
fw AS MATERIALIZED (SELECT id_post, l, {S.function_words('l')} AS best FROM fl),
detected AS (SELECT id_post, CASE WHEN length(l) < 3 OR best IS NULL THEN 'unknown' ELSE best END AS language,
  CASE WHEN length(l) < 3 OR best IS NULL THEN 0e0 ELSE {S.confidence('l')} END AS confidence FROM fw),
{S.words_cte('clean', 'processed_text')}, {S.valence_cte()}, {S.polarity_cte()}, {S.ENRICHED}
"""

ORACLE: dict[str, str] = {
    # sources, sinks, state writes
    "scan_posts": "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en'",
    "resolve_roles": "SELECT text, CAST(n_chars AS VARCHAR) AS label, CAST(n_chars AS VARCHAR) AS type FROM documents",
    "duplicate_ids": "SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id HAVING count(*) > 1",
    "upsert_clean": f"""WITH {S.POSTS}, {S.clean_cte('posts')}
SELECT id_post, processed, CASE WHEN processed THEN processed_text ELSE '' END AS processed_text,
  CASE WHEN processed THEN word_count END AS word_count FROM clean""",
    "upsert_nlp": ENRICHED + """SELECT id_post, CASE WHEN processed THEN final_sentiment END AS final_sentiment,
  CASE WHEN processed THEN final_score END AS final_score FROM enriched""",
    "last_write_wins": """SELECT conv_id, turn, role, text FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1""",
    "csv_round_trip": """SELECT doc_id, sha256(text) AS text_sha256,
  CASE doc_id % 3 WHEN 0 THEN '5" of ' || lang WHEN 1 THEN lang || ', "x"' || chr(10) ELSE lang END AS note,
  doc_id % 10 = 3 AS surplus FROM documents""",
    "batch_runs": "WITH " + RUN_POSTS + f"""SELECT id_post, label, type AS type_harcelement, processed_text AS contenu_traite, language AS langue,
  CAST(confidence AS FLOAT) AS langue_confiance, final_sentiment AS sentiment, CAST(final_score AS FLOAT) AS score FROM enriched WHERE id_post IS NOT NULL""",
    "batch_counts": """WITH t AS (SELECT (conv_id + turn) % 17 = 0 AS bad, role = 'user' AND length(text) > 0 AS changed FROM conversations),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE bad) AS bad, count(*) FILTER (WHERE changed OR bad) AS again,
  count(*) FILTER (WHERE changed AND NOT bad) AS redone FROM t)
SELECT 0 AS round, 'clean' AS run, n AS pending, n - bad AS written, NULL::BIGINT AS indexed, bad AS failed FROM c
UNION ALL SELECT 0, 'enrich', n - bad, n - bad, NULL, 0 FROM c UNION ALL SELECT 0, 'index', NULL, NULL, n - bad, 0 FROM c
UNION ALL SELECT 1, 'clean', again, redone, NULL, bad FROM c UNION ALL SELECT 1, 'enrich', redone, redone, NULL, 0 FROM c
UNION ALL SELECT 1, 'index', NULL, NULL, n - bad, 0 FROM c""",
    "batch_quarantine": """SELECT NULL::VARCHAR AS id, 'clean:missing_id' AS reason, 2 * count(*) AS n FROM conversations
WHERE (conv_id + turn) % 17 = 0 HAVING count(*) > 0""",
    "user_scorer": """SELECT conv_id, turn, CASE WHEN role <> 'assistant' THEN 2 * (length(text) - length(replace(text, '!', '')))
  + length(text) - length(replace(text, '?', '')) END AS loudness, CASE WHEN role = 'assistant' THEN 'loudness:ValueError' END AS reason
FROM conversations""",
    "language_accuracy": f"""WITH training AS (SELECT * FROM documents WHERE doc_id % 5 <> 0),
held AS (SELECT CAST(doc_id AS VARCHAR) AS id_post, text, lang FROM documents WHERE doc_id % 5 = 0),
{S.profile_cte('training', 'text', 'lang')}, {S.detect_cte('held', 'text')}, g AS (SELECT lang, language, count(*) AS n
  FROM held JOIN detected USING (id_post) GROUP BY lang, language)
SELECT *, CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY lang) AS DOUBLE) AS share FROM g""",
    "quarantine": CHECKED + f"SELECT page_id AS id, reason, {PREVIEW} AS preview FROM checked WHERE reason IS NOT NULL",
    "index_accounting": CHECKED + """SELECT count(*) FILTER (WHERE reason IS NULL) AS indexed,
  count(*) FILTER (WHERE reason IS NOT NULL) AS failed FROM checked""",
    "failure_breakdown": CHECKED + "SELECT reason, count(*) AS n FROM checked WHERE reason IS NOT NULL GROUP BY reason",
    "first_failures": CHECKED + f"""SELECT page_id AS id, reason, string_split(reason, ':')[1] AS error_type, {PREVIEW} AS preview FROM checked
WHERE reason IS NOT NULL ORDER BY page_id NULLS FIRST, reason, preview LIMIT 5""",
    "preview": f"""WITH {S.POSTS} SELECT id_post, label, type, coalesce(CAST(nlp_processed AS VARCHAR), 'N/A') AS nlp_processed,
  {S.shorten('text', 80)} AS text FROM posts ORDER BY id_post LIMIT 3""",
    "profile_fields": f"WITH {S.POSTS} " + " UNION ALL ".join(profile_row(n) for n in NAMES),
    "docs_to_json": f"""WITH {S.POSTS} SELECT id_post,
  CAST(to_json({{'id_post': id_post, 'text': text, 'label': label, 'type': type}}) AS VARCHAR) AS json FROM posts""",
    # rows
    "clean_rows": f"WITH {S.TURNS} SELECT id_post, text FROM turns WHERE text IS NOT NULL AND length({S.strip_ws('text')}) > 0",
    "make_posts": f"""SELECT CAST(doc_id AS VARCHAR) AS id_post, {S.strip_ws('text')} AS text,
  coalesce(nullif(lang, 'es'), 'unknown') AS label, source AS type, FALSE AS processed, 'kaggle_dataset' AS source
FROM documents WHERE length({S.strip_ws('text')}) > 0""",
    "post_ids": f"""WITH r AS (SELECT {S.strip_ws('text')} AS text, lang AS label FROM documents WHERE length({S.strip_ws('text')}) > 0),
n AS (SELECT *, row_number() OVER (PARTITION BY text, label ORDER BY text) AS copy FROM r)
SELECT sha256(list_aggregate(list_transform(['kaggle_dataset', text, label, label, CAST(copy AS VARCHAR)],
  lambda x: coalesce(length(x) || ':' || x, '-')), 'string_agg', '')) AS id_post, label FROM n""",
    "pending_clean": f"WITH {S.POSTS} SELECT id_post, label, processed FROM posts WHERE processed = FALSE",
    "pending_nlp": f"""WITH {S.POSTS} SELECT id_post, label, processed, nlp_processed FROM posts
WHERE processed AND nlp_processed IS DISTINCT FROM TRUE""",
    "ready_docs": f"WITH {S.POSTS} SELECT id_post, label, processed, nlp_processed FROM posts WHERE processed AND nlp_processed",
    "pending_anti": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "reset_clean": f"WITH {S.POSTS} SELECT id_post, text, label, type, FALSE AS processed, FALSE AS nlp_processed FROM posts",
    "reset_nlp": f"""WITH {S.POSTS}, {S.clean_cte('posts')} SELECT id_post, label, type, original_text, cleaned_text,
  processed_text, word_count, TRUE AS processed, FALSE AS nlp_processed FROM clean""",
    "flatten_docs": FLAT + "SELECT * FROM flat",
    "doc_title": f"SELECT CAST(doc_id AS VARCHAR) AS id_post, {S.shorten('text', 100)} AS titre FROM documents",
    "title_keyword": "SELECT CAST(doc_id AS VARCHAR) AS id_post, CASE WHEN length(text) <= 256 THEN text END AS keyword FROM documents",
    "doc_content": f"WITH {S.TURNS}, {S.clean_cte('turns')} SELECT id_post, {S.first_text('processed_text', 'original_text')} AS contenu FROM clean",
    "safe_timestamp": """SELECT event_id,
  CASE event_type WHEN 'error' THEN epoch_us(TIMESTAMP '2024-06-01 12:00:00')
    WHEN 'purchase' THEN epoch_us(date_trunc('second', ts)) - 7200000000
    WHEN 'signup' THEN epoch_us(date_trunc('day', ts)) ELSE epoch_us(date_trunc('second', ts)) END AS at_micros,
  event_type = 'error' AS is_bad FROM events""",
    "doc_lengths": f"""SELECT CAST(doc_id AS VARCHAR) AS id_post, CAST(length(text) AS BIGINT) AS longueur_texte,
  CAST(len({S.words('text')}) AS BIGINT) AS nb_mots FROM documents""",
    "nlp_empty_default": f"""WITH {S.TURNS}, {S.clean_cte('turns')},
fl AS MATERIALIZED (SELECT id_post, {S.letters('original_text')} AS l FROM clean),
fw AS MATERIALIZED (SELECT id_post, l, {S.function_words('l')} AS best FROM fl),
detected AS (SELECT id_post, CASE WHEN length(l) < 3 OR best IS NULL THEN 'unknown' ELSE best END AS language,
  CASE WHEN length(l) < 3 OR best IS NULL THEN 0e0 ELSE {S.confidence('l')} END AS confidence FROM fw),
{S.words_cte('clean', 'processed_text')}, {S.valence_cte()}, {S.polarity_cte()}, {S.ENRICHED}
SELECT {RESULTS} FROM enriched""",
    # text
    "lower_text": "SELECT CAST(doc_id AS VARCHAR) AS id_post, lower(text) AS lowered FROM documents",
    "strip_special": f"SELECT CAST(doc_id AS VARCHAR) AS id_post, {S.special('text')} AS stripped FROM documents",
    "strip_punct_digits": f"SELECT CAST(doc_id AS VARCHAR) AS id_post, {S.punct_digits('text')} AS stripped FROM documents",
    "langid_clean": f"SELECT CAST(doc_id AS VARCHAR) AS id_post, {S.letters('text')} AS letters FROM documents",
    "strip_html": f"WITH {S.FRAGMENTS} SELECT page_id, {S.html('text')} AS stripped FROM fragments",
    "strip_urls": f"WITH {S.FRAGMENTS} SELECT page_id, {S.sub('text', S.URL)} AS stripped FROM fragments",
    "clean_text": f"WITH {S.FRAGMENTS} SELECT page_id, {S.clean('lower(text)')} AS cleaned_text FROM fragments",
    "clean_entities": f"""WITH e AS (SELECT CAST(doc_id AS VARCHAR) AS id_post, replace(replace(replace(replace(text, ' the ', ' AT&T; '),
  ' of ', ' &copy of&nbsp;'), ' de ', ' &#x41;&#66;d&eacute; &amp;lt; '), '. ', ' R&D; &fjlig;&notin; &copyx &#9 ') AS text FROM documents)
SELECT id_post, {S.clean('lower(text)')} AS cleaned_text FROM e""",
    "abbreviations": f"WITH {S.abbreviation_cte('documents')} SELECT word, round(score, 6) AS score FROM abbr",
    "sentence_counts": f"""WITH {S.FRAGMENTS}, {S.abbreviation_cte('documents')}, given AS (SELECT CAST(doc_id AS VARCHAR) AS id_post, text FROM documents
  UNION ALL SELECT 'page-' || page_id, {S.html('text')} FROM fragments), {S.sentence_cte('given')} SELECT * FROM counted""",
    "tokenize": TOKENS + f"SELECT id_post, {S.joined('tokens')} AS tokens FROM toks",
    "remove_stopwords": TOKENS + f"SELECT id_post, {S.joined(S.no_stop('tokens'))} AS tokens FROM toks",
    "lemmatize_rules": TOKENS + f"SELECT id_post, {S.joined(S.lemmas('tokens'))} AS tokens FROM toks",
    "lemmatize_dict": LEMMAS + """, done AS (SELECT id_post, string_agg(coalesce(lemma, tw.form), ' ' ORDER BY pos) AS tokens
  FROM tw LEFT JOIN best ON best.form = tw.form GROUP BY id_post)
SELECT id_post, coalesce(done.tokens, '') AS tokens FROM docs LEFT JOIN done USING (id_post)""",
    "preprocess_dict": LEMMAS + f""", kept AS (SELECT id_post, coalesce(lemma, tw.form) AS t, pos FROM tw LEFT JOIN best ON best.form = tw.form
  WHERE tw.form NOT IN {S.inlist(STOP_WORDS)}),
done AS (SELECT id_post, string_agg(t, ' ' ORDER BY pos) AS p FROM kept WHERE length(t) > 1 GROUP BY id_post)
SELECT id_post, coalesce(p, '') AS processed_text, way FROM docs LEFT JOIN done USING (id_post), (VALUES ('constant'), ('join')) v(way)""",
    "tokens_final": TOKENS + f"SELECT id_post, {S.joined(S.long_only(S.lemmas(S.no_stop('tokens'))))} AS tokens FROM toks",
    "processed_text": CLEAN + "SELECT id_post, processed_text FROM clean",
    "preprocess": f"""WITH {S.FRAGMENTS}, inputs AS (SELECT CAST(doc_id AS VARCHAR) AS id_post, text FROM documents
  UNION ALL SELECT 'page-' || page_id, text FROM fragments), {S.clean_cte('inputs')}
SELECT id_post, cleaned_text, processed_text, word_count FROM clean""",
    "analyze_terms": f"SELECT CAST(doc_id AS VARCHAR) AS id_post, {S.joined(S.search_terms('text'))} AS terms FROM documents",
    "match_terms": f"""WITH t AS MATERIALIZED (SELECT CAST(doc_id AS VARCHAR) AS id_post, {S.search_terms('text')} AS terms FROM documents)
SELECT id_post, 'all' AS how FROM t WHERE list_contains(terms, 'which') AND list_contains(terms, 'from')
UNION ALL SELECT id_post, 'any' FROM t WHERE list_contains(terms, 'elle') OR list_contains(terms, 'nicht')""",
    # language
    "language_guards": f"""WITH {S.TURNS} SELECT id_post,
  length({S.strip_ws("coalesce(text, '')")}) < 3
  OR length({S.strip_ws(S.sub("coalesce(text, '')", f'[^a-zA-Z{S.WS}]'))}) < 3 AS is_short FROM turns""",
    "language_confidence": f"WITH {S.TURNS}, tl AS MATERIALIZED (SELECT id_post, {S.letters('text')} AS l FROM turns) SELECT id_post, {S.confidence('l')} AS confidence FROM tl",
    "train_language_profiles": PROFILES + " SELECT * FROM profiles",
    "detect_language": PROFILES + ",\n" + S.detect_cte("docs", "text") + " SELECT * FROM detected",
    "detect_language_words": f"""WITH {DOCS}, fl AS MATERIALIZED (SELECT id_post, {S.letters('text')} AS l FROM docs),
fw AS MATERIALIZED (SELECT id_post, l, {S.function_words('l')} AS best FROM fl)
SELECT id_post, CASE WHEN length(l) < 3 OR best IS NULL THEN 'unknown' ELSE best END AS language,
  CASE WHEN length(l) < 3 OR best IS NULL THEN 0e0 ELSE {S.confidence('l')} END AS confidence FROM fw""",
    # sentiment
    "exact_round": f"""WITH x AS (SELECT l_orderkey, l_linenumber, l_extendedprice * (1e0 - l_discount) / 97e0 AS x FROM lineitem)
SELECT l_orderkey, l_linenumber, {S.exact_round('x')} AS rounded, {S.exact_round('(-x)', 2)} AS negative FROM x""",
    "polarity_scores": SCORED + S.polarity_cte() + """
SELECT id_post, coalesce(polarity, 0e0) AS polarity, coalesce(subjectivity, 0e0) AS subjectivity,
  coalesce(polarity_label, 'neutral') AS polarity_label FROM docs LEFT JOIN polar USING (id_post)""",
    "valence_scores": SCORED + S.valence_cte() + "\n" + VALENCE,
    "polarity_of_raw_texts": f"""WITH {S.SHOUTED}, {S.words_cte('shouted', 'text', split=S.polarity_words('text'))}, {S.polarity_cte()}
SELECT id_post, coalesce(polarity, 0e0) AS polarity, coalesce(subjectivity, 0e0) AS subjectivity,
  coalesce(polarity_label, 'neutral') AS polarity_label FROM shouted LEFT JOIN polar USING (id_post)""",
    "sentiment_labels": f"""WITH x AS (SELECT event_id, value / 100e0 - 0.2e0 AS x FROM events)
SELECT event_id, {S.polarity_label('x')} AS polarity_label, {S.valence_label('x')} AS valence_label FROM x""",
    "consensus": ENRICHED + "SELECT id_post, final_sentiment, sentiment_confidence, final_score FROM enriched",
    "enrich": ENRICHED + f"SELECT {RESULTS} FROM enriched",
    "lookup_ways": "WITH " + S.enriched_with("""turns2 AS (SELECT concat_ws('/', conv_id || '-' || turn, CASE WHEN turn % 3 > 0 THEN conv_id END) AS id_post, text
  FROM conversations)""", "turns2") + f""", twice AS (SELECT * FROM enriched UNION ALL SELECT * FROM enriched WHERE split_part(id_post, '/', 1) LIKE '%0-0')
SELECT {RESULTS}, way FROM twice, (VALUES ('constant'), ('join')) v(way)""",
    # reports
    "total_docs": "SELECT count(*) AS total FROM documents",
    "stage_counts": f"""WITH {S.POSTS}, c AS (SELECT count(*) AS total, count(*) FILTER (WHERE processed) AS processed,
  count(*) FILTER (WHERE nlp_processed) AS nlp_processed FROM posts)
SELECT *, total - processed AS not_processed, processed - nlp_processed AS not_nlp_processed FROM c""",
    "label_counts": f"WITH {S.POSTS} SELECT label, count(*) AS count FROM posts GROUP BY label",
    "word_stats": f"""WITH {S.POSTS}, {S.clean_cte('posts')}, a AS (SELECT avg(word_count) AS avg_word_count,
  min(word_count) AS min_word_count, max(word_count) AS max_word_count FROM clean WHERE processed)
SELECT *, printf('%.2f', avg_word_count) AS avg_display FROM a WHERE avg_word_count IS NOT NULL""",
    "language_counts": FLAT + "SELECT langue, count(*) AS count FROM flat GROUP BY langue ORDER BY count DESC, langue LIMIT 10",
    "sentiment_counts": FLAT + "SELECT sentiment, count(*) AS count FROM flat GROUP BY sentiment",
    "terms_sentiment": FLAT + "SELECT sentiment, count(*) AS count FROM flat WHERE sentiment IS NOT NULL GROUP BY sentiment ORDER BY count DESC, sentiment LIMIT 10",
    "terms_language": FLAT + "SELECT langue, count(*) AS count FROM flat WHERE langue IS NOT NULL GROUP BY langue ORDER BY count DESC, langue LIMIT 10",
    "dash_language_share": FLAT + f""", g AS (SELECT langue, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, langue) AS r FROM flat GROUP BY langue),
h AS (SELECT CASE WHEN r <= 2 THEN langue ELSE 'other' END AS langue, CAST(sum(count) AS BIGINT) AS count FROM g GROUP BY 1)
{share('langue')} FROM h""",
    "dash_type_counts": FLAT + "SELECT type_harcelement, count(*) AS count FROM flat GROUP BY type_harcelement",
    "dash_sentiment_share": FLAT + f", h AS (SELECT sentiment, count(*) AS count FROM flat GROUP BY sentiment) {share('sentiment')} FROM h",
    "dash_negative_total": FLAT + "SELECT count(*) FILTER (WHERE sentiment = 'negative') AS negative_posts FROM flat",
    "dash_lang_sentiment": FLAT + "SELECT langue, " + ", ".join(
        f"count(*) FILTER (WHERE sentiment = '{s}') AS {s}" for s in ("negative", "neutral", "positive")
    ) + " FROM flat GROUP BY langue",
    "dash_lang_sentiment_long": FLAT + "SELECT langue, sentiment, count(*) AS count FROM flat GROUP BY langue, sentiment",
    "dash_cube": FLAT + "SELECT langue, type_harcelement, sentiment, count(*) AS count FROM flat GROUP BY ALL",
    "ingest_accounting": f"""WITH {S.TURNS}, f AS (SELECT text IS NOT NULL AS a,
  coalesce(length({S.strip_ws('text')}) > 0, FALSE) AS b FROM turns)
SELECT count(*) AS loaded, count(*) FILTER (WHERE a) AS with_text, count(*) FILTER (WHERE b) AS after_cleaning,
  count(*) FILTER (WHERE b) AS created FROM f""",
    # streams
    "incremental_clean": CLEAN + "SELECT CAST(id_post AS BIGINT) AS doc_id, processed_text, word_count FROM clean",
    "incremental_nlp": ENRICHED + f"SELECT {RESULTS} FROM enriched",
}
ORACLE["remove_stopwords_table"] = ORACLE["remove_stopwords"]
ORACLE["detect_language_joined"] = ORACLE["detect_language"]
ORACLE["valence_scores_joined"] = ORACLE["valence_scores"]
ORACLE["merge_updates"] = ORACLE["last_write_wins_rows"] = ORACLE["last_write_wins"]
