"""Pieces of the check SQL, written from the definitions of the operators."""

from __future__ import annotations

from html.entities import html5

from checks.tables import LEXICON
from postlens.functions.text import word_pattern
from postlens.functions.wordlists import (
    IRREGULAR_NOUNS, LANGUAGE_WORDS, SEARCH_STOP_WORDS, SINGULAR_S, STOP_WORDS,
)

WS = r"\s\x{0B}\x1c-\x1f\x{85}\p{Z}"
MARKUP = (
    r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<![a-z][^>]*>|<\?[^>]*>"
    r"""|</?[a-z](?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*?>"""
)
URL = r"https?://[!$-_a-zA-Z]+"


def q(s) -> str:
    """A SQL literal."""
    if s is None:
        return "NULL"
    if isinstance(s, bool):
        return "TRUE" if s else "FALSE"
    if isinstance(s, (int, float)):
        return repr(s) + ("e0" if isinstance(s, float) else "")
    return "'" + str(s).replace("'", "''") + "'"


def inlist(words) -> str:
    return "(" + ", ".join(q(w) for w in words) + ")"


def sub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, 'g')"


def strip_ws(x: str) -> str:
    return sub(x, f"^[{WS}]+|[{WS}]+$")


def entities(x: str) -> str:
    """Each ampersand starts a piece; a number or a name at its start is a character, or stays."""
    names = "MAP {" + ", ".join(f"{q(n.rstrip(';'))}: {q(t)}" for n, t in html5.items() if n.endswith(";")) + "}"
    bare = inlist(n for n in html5 if not n.endswith(";"))
    head = "regexp_extract(p, '^(#[xX][0-9a-fA-F]+|#[0-9]+|[a-zA-Z][a-zA-Z0-9]*)')"
    digits = "ltrim(substr(h, 2), '0')"
    hexa = "ltrim(substr(h, 3), '0')"
    number = (
        f"CASE WHEN h LIKE '#%' AND substr(h, 2, 1) NOT IN ('x', 'X') AND length({digits}) <= 7 THEN CAST('0' || {digits} AS INTEGER) "
        f"WHEN h LIKE '#%' AND substr(h, 2, 1) IN ('x', 'X') AND length({hexa}) <= 6 THEN CAST('0x0' || {hexa} AS INTEGER) END"
    )
    letter = "CASE WHEN c IS NULL THEN NULL WHEN c BETWEEN 1 AND 55295 OR c BETWEEN 57344 AND 1114111 THEN chr(c) ELSE chr(65533) END"
    named = f"CASE WHEN h NOT LIKE '#%' AND (substr(p, length(h) + 1, 1) = ';' OR h IN {bare}) THEN {names}[h] END"
    text = f"coalesce(list_transform([{number}], lambda c: {letter})[1], {named})"
    rest = "substr(p, length(h) + 1 + CASE WHEN substr(p, length(h) + 1, 1) = ';' THEN 1 ELSE 0 END)"
    piece = (
        f"list_transform([{head}], lambda h: list_transform([{text}], lambda t: CASE WHEN h = '' OR t IS NULL THEN '&' || p "
        f"WHEN t = chr(160) THEN ' ' || {rest} ELSE t || {rest} END)[1])[1]"
    )
    return f"array_to_string(list_transform(string_split({x}, '&'), lambda p, i: CASE WHEN i = 1 THEN p ELSE {piece} END), '')"


def html(x: str) -> str:
    return entities(sub(sub(x, r"(?s)<!\[CDATA\[(.*?)\]\]>", r"\1"), MARKUP))


def collapse(x: str) -> str:
    return f"trim({sub(x, f'[{WS}]+', ' ')})"


def special(x: str) -> str:
    return sub(x, f"[^a-zA-Z0-9{WS}]")


def punct_digits(x: str) -> str:
    return sub(sub(x, "[[:punct:]]"), r"\p{Nd}+")


def clean(x: str) -> str:
    return collapse(punct_digits(special(sub(html(x), URL))))


def contractions(x: str) -> str:
    for a, b in (("can", "not"), ("gon", "na"), ("got", "ta"), ("wan", "na"), ("gim", "me"), ("lem", "me")):
        x = sub(x, rf"\b({a})({b})\b", r"\1 \2")
    return x


def token_list(x: str) -> str:
    return f"list_filter(string_split({contractions(x)}, ' '), lambda t: t <> '')"


def no_stop(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: lower(t) NOT IN {inlist(STOP_WORDS)})"


def lemma(t: str) -> str:
    cases = " ".join(f"WHEN {q(w)} THEN {q(v)}" for w, v in IRREGULAR_NOUNS.items())
    return (
        f"CASE WHEN {t} IN {inlist(IRREGULAR_NOUNS)} THEN (CASE {t} {cases} END) "
        f"WHEN {t} NOT LIKE '%s' OR length({t}) < 4 OR {t} IN {inlist(SINGULAR_S)} THEN {t} "
        f"WHEN regexp_matches({t}, '(ss|us|is|ics)$') THEN {t} "
        f"WHEN {t} LIKE '%ies' AND length({t}) > 4 THEN left({t}, length({t}) - 3) || 'y' "
        f"WHEN regexp_matches({t}, '(ss|x|z|ch|sh)es$') THEN left({t}, length({t}) - 2) "
        f"ELSE left({t}, length({t}) - 1) END"
    )


def lemmas(tokens: str) -> str:
    return f"list_transform({tokens}, lambda t: {lemma('t')})"


def long_only(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: length(t) > 1)"


def joined(tokens: str) -> str:
    return f"array_to_string({tokens}, ' ')"


def final_tokens(x: str) -> str:
    return long_only(lemmas(no_stop(token_list(x))))


def words(x: str) -> str:
    return f"list_filter(string_split(trim({sub(x, f'[{WS}]+', ' ')}), ' '), lambda w: w <> '')"


def first_text(*xs: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({x}, '')" for x in xs) + ", '')"


def shorten(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) > {n} THEN left({x}, {n}) || '...' ELSE {x} END"


def exact_round(x: str, digits: int = 3) -> str:
    s = f"1e{digits}"
    big = "134217729e0"
    high = f"({big} * ({x}) - ({big} * ({x}) - ({x})))"
    p = f"(({x}) * {s})"
    e = f"(({high} * {s} - {p}) + (({x}) - {high}) * {s})"
    f = f"({p} - floor({p}))"
    return (
        f"(CASE WHEN {f} > 0.5e0 OR ({f} = 0.5e0 AND {e} > 0e0) THEN floor({p}) + 1e0 "
        f"WHEN {f} = 0.5e0 AND {e} = 0e0 THEN 2e0 * round({p} / 2e0) ELSE floor({p}) END / {s})"
    )


def micro(x: str) -> str:
    return f"CAST(floor(({x}) * 1e6 + 0.5e0) AS BIGINT)"


def letters(x: str) -> str:
    return f"lower({collapse(sub(f'coalesce({x}, {q(str())})', f'[^a-zA-Z{WS}]'))})"


POSTS = """posts AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id_post, d.text,
         CASE l.toxic WHEN 1 THEN 'harassment' WHEN 0 THEN 'not_harassment' ELSE 'unknown' END AS label,
         d.source AS type, d.lang, (l.quality = 1) AS processed,
         CASE WHEN d.lang = 'en' THEN TRUE WHEN d.lang IN ('fr', 'de') THEN FALSE END AS nlp_processed
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

TURNS = """turns AS (
  SELECT concat_ws('-', conv_id, turn) AS id_post, text FROM conversations
  UNION ALL SELECT 'label-' || doc_id, CASE WHEN toxic = 1 THEN ' ' || chr(9) || ' ' WHEN quality = 1 THEN '' END FROM labels)"""

PAGES = """raw_pages AS (
  SELECT CASE WHEN url LIKE 'https%' THEN page_id END AS page_id, url,
         list_last(string_split(url, '/')) AS score FROM pages)"""

FRAGMENTS = "fragments AS (SELECT page_id, html || ' ' || url AS text FROM pages)"


def clean_cte(source: str, name: str = "clean") -> str:
    """Cleaning of ``source(id_post, text)``."""
    return f"""{name}0 AS MATERIALIZED (SELECT *, lower(coalesce(text, '')) AS original_text FROM {source}),
{name}1 AS MATERIALIZED (SELECT *, {clean('original_text')} AS cleaned_text FROM {name}0),
{name}2 AS MATERIALIZED (SELECT *, {final_tokens('cleaned_text')} AS tokens FROM {name}1),
{name} AS MATERIALIZED (SELECT *, {joined('tokens')} AS processed_text, CAST(len(tokens) AS BIGINT) AS word_count FROM {name}2)"""


LEX = "lex(term, valence, boost, negation, role, polarity, subjectivity, intensity, modifier, negator) AS (VALUES " + ", ".join(
    "(" + ", ".join(q(v) for v in row) + ")" for row in LEXICON
) + ")"


def words_cte(source: str, text: str, name: str = "w", split: str | None = None) -> str:
    """One row per word of ``source(id_post, text)`` with its lexicon entry and its neighbours'; ``split`` gives the words of a text."""
    split = split or f"string_split({text}, ' ')"
    look = ", ".join(
        f"lag({c}, {d}) OVER o AS {c}{d}"
        for c in ("valence", "boost", "negation", "role", "polarity", "intensity", "modifier", "negator")
        for d in (1, 2, 3)
    )
    return f"""{LEX},
{name}s AS (SELECT id_post, {split} AS ws FROM {source} WHERE {text} <> ''),
{name}t AS (SELECT id_post, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM {name}s),
{name} AS MATERIALIZED (
  SELECT {name}t.*, lex.*, {look},
         lead(valence) OVER o AS valence_next, lead(role) OVER o AS role_next, lead(polarity) OVER o AS polarity_next,
         min(CASE WHEN role = 'but' THEN pos END) OVER (PARTITION BY id_post) AS but
  FROM {name}t LEFT JOIN lex ON word = term
  WINDOW o AS (PARTITION BY id_post ORDER BY pos))"""


def _toward(v: str, amount: str) -> str:
    return f"(CASE WHEN {v} < 0e0 THEN {v} + (-({amount})) ELSE {v} + ({amount}) END)"


def valence_cte(words: str = "w", name: str = "valence") -> str:
    """Per document the valence scores; documents without words are absent."""
    steps = []
    decay = {1: "1e0", 2: "0.95e0", 3: "0.9e0"}
    so = {
        1: "FALSE",
        2: "role2 = 'never' AND role1 = 'so'",
        3: "(role3 = 'never' AND role2 = 'so') OR role1 = 'so'",
    }
    sure = {1: "FALSE", 2: "role1 = 'doubt'", 3: "(role2 = 'doubt' OR role1 = 'doubt')"}
    last = f"{name}0"
    for d in (1, 2, 3):
        raised = _toward("v", f"coalesce(boost{d}, 0e0) * {decay[d]}")
        steps.append(f"""{name}{d} AS (SELECT * REPLACE (CASE WHEN pos > {d} AND valence{d} IS NULL THEN {raised} * (CASE
    WHEN {so[d]} THEN 1.25e0 WHEN role{d} = 'without' AND {sure[d]} THEN 1e0 WHEN negation{d} THEN -0.74e0 ELSE 1e0 END)
  ELSE v END AS v) FROM {last})""")
        last = f"{name}{d}"
    scored = """CASE WHEN valence IS NOT NULL AND boost IS NULL
           AND NOT (coalesce(role, '') = 'kind' AND coalesce(role_next, '') = 'of') THEN"""
    return f"""{name}0 AS (SELECT *, CASE
    WHEN role1 = 'no' OR role2 = 'no' OR (role3 = 'no' AND role1 = 'or') THEN valence * -0.74e0
    WHEN role = 'no' AND valence_next IS NOT NULL THEN 0e0 ELSE valence END AS v FROM {words}),
{', '.join(steps)},
{name}4 AS (SELECT id_post, pos, {scored} {micro('''(CASE WHEN role1 = 'least' AND valence1 IS NULL AND coalesce(role2, '') <> 'at'
    THEN v * -0.74e0 ELSE v END) * (CASE WHEN pos < but THEN 0.5e0 WHEN pos > but THEN 1.5e0 ELSE 1e0 END)''')} ELSE 0 END AS score FROM {last}),
{name}5 AS (SELECT id_post, CAST(sum(score) AS BIGINT) AS total,
    CAST(sum(CASE WHEN score > 0 THEN score + 1000000 ELSE 0 END) AS BIGINT) AS pos_sum,
    CAST(sum(CASE WHEN score < 0 THEN 1000000 - score ELSE 0 END) AS BIGINT) AS neg_sum,
    CAST(sum(CASE WHEN score = 0 THEN 1000000 ELSE 0 END) AS BIGINT) AS neu_sum FROM {name}4 GROUP BY id_post),
{name}6 AS (SELECT *, CAST(total AS DOUBLE) / 1e6 AS s, CAST(pos_sum + neg_sum + neu_sum AS DOUBLE) AS everything FROM {name}5),
{name}7 AS (SELECT *, {exact_round('s / sqrt(s * s + 15e0)', 4)} AS compound4 FROM {name}6),
{name} AS MATERIALIZED (SELECT id_post, {exact_round('compound4')} AS compound,
    {exact_round('CAST(pos_sum AS DOUBLE) / everything')} AS positive,
    {exact_round('CAST(neu_sum AS DOUBLE) / everything')} AS neutral,
    {exact_round('CAST(neg_sum AS DOUBLE) / everything')} AS negative,
    {valence_label('compound4')} AS valence_label FROM {name}7)"""


def valence_label(x: str) -> str:
    return f"CASE WHEN {x} >= 0.05e0 THEN 'positive' WHEN {x} <= -0.05e0 THEN 'negative' ELSE 'neutral' END"


def polarity_label(x: str) -> str:
    return f"CASE WHEN {x} > 0.1e0 THEN 'positive' WHEN {x} < -0.1e0 THEN 'negative' ELSE 'neutral' END"


def polarity_cte(words: str = "w", name: str = "polar") -> str:
    clip = lambda x: f"greatest(-1e0, least(1e0, {x}))"
    return f"""{name}0 AS (SELECT *, coalesce(modifier1, FALSE) AND polarity1 IS NOT NULL AS modified FROM {words}
  WHERE polarity IS NOT NULL AND NOT (modifier AND polarity_next IS NOT NULL)),
{name}1 AS (SELECT *, modified AND coalesce(negator2, FALSE) AS turned_modifier FROM {name}0),
{name}2 AS (SELECT *, CASE WHEN turned_modifier THEN 1e0 / intensity1 WHEN modified THEN intensity1 ELSE 1e0 END AS i FROM {name}1),
{name}3 AS (SELECT id_post,
    {micro(f"{clip('polarity * i')} * (CASE WHEN coalesce(negator1, FALSE) OR turned_modifier THEN -0.5e0 ELSE 1e0 END)")} AS p,
    {micro(clip('subjectivity * i'))} AS s FROM {name}2),
{name}4 AS (SELECT id_post, CAST(sum(p) AS DOUBLE) / 1e6 / CAST(count(*) AS DOUBLE) AS p,
    CAST(sum(s) AS DOUBLE) / 1e6 / CAST(count(*) AS DOUBLE) AS s FROM {name}3 GROUP BY id_post),
{name} AS MATERIALIZED (SELECT id_post, {exact_round('p')} AS polarity, {exact_round('s')} AS subjectivity,
    {polarity_label('p')} AS polarity_label FROM {name}4)"""


# All trigrams of a padded text, as those that start at every third character, three times.
GRAM_LIST = "(regexp_extract_all({x}, '...') || regexp_extract_all({x}[2:], '...') || regexp_extract_all({x}[3:], '...'))"


def profile_cte(source: str, text: str, lang: str, top: int = 300) -> str:
    grams = GRAM_LIST.format(x="p")
    log = lambda n: micro(f"ln({n} / CAST(total AS DOUBLE))")
    return f"""pl AS (SELECT {lang} AS lang, {letters(text)} AS l FROM {source} WHERE {lang} IS NOT NULL),
pp AS MATERIALIZED (SELECT lang, ' ' || l || ' ' AS p FROM pl WHERE l <> ''),
pg AS (SELECT lang, unnest({grams}) AS gram FROM pp),
pc AS (SELECT lang, gram, count(*) AS n FROM pg GROUP BY lang, gram),
pr AS (SELECT *, sum(n) OVER (PARTITION BY lang) AS total,
       row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS rank FROM pc),
profiles AS MATERIALIZED (SELECT lang, gram, {log('(n + 0.5e0)')} AS weight, {log('0.5e0')} AS floor FROM pr WHERE rank <= {top})"""


def confidence(l: str) -> str:
    n = f"(CASE WHEN {l} = '' THEN 0 ELSE len(string_split({l}, ' ')) END)"
    return f"least(95, greatest(50, 10 * {n})) / 100e0"


def detect_cte(source: str, text: str, name: str = "detected") -> str:
    """Language and confidence of ``source(id_post, text)`` by the ``profiles`` CTE."""
    grams = GRAM_LIST.format(x="p")
    return f"""dl AS MATERIALIZED (SELECT id_post, {letters(text)} AS l FROM {source}),
dp AS MATERIALIZED (SELECT id_post, ' ' || l || ' ' AS p FROM dl WHERE l <> ''),
dg AS (SELECT id_post, unnest({grams}) AS gram FROM dp),
dc AS (SELECT id_post, gram, count(*) AS n FROM dg GROUP BY id_post, gram),
dn AS (SELECT id_post, sum(n) AS n FROM dc GROUP BY id_post),
floors AS (SELECT lang, max(floor) AS floor FROM profiles GROUP BY lang),
dh AS (SELECT id_post, lang, sum(n * (weight - floor)) AS gain FROM dc JOIN profiles USING (gram) GROUP BY id_post, lang),
ds AS (SELECT dn.id_post, floors.lang, coalesce(gain, 0) + n * floor AS score
       FROM dn CROSS JOIN floors LEFT JOIN dh ON dh.id_post = dn.id_post AND dh.lang = floors.lang
       WHERE dn.id_post IN (SELECT id_post FROM dh)),
db AS (SELECT id_post, lang, row_number() OVER (PARTITION BY id_post ORDER BY score DESC, lang) AS r FROM ds),
{name} AS MATERIALIZED (SELECT dl.id_post,
    CASE WHEN length(l) < 3 OR db.lang IS NULL THEN 'unknown' ELSE db.lang END AS language,
    CASE WHEN length(l) < 3 OR db.lang IS NULL THEN 0e0 ELSE {confidence('l')} END AS confidence
  FROM dl LEFT JOIN db ON db.id_post = dl.id_post AND r = 1)"""


ENRICHED = f"""enriched AS MATERIALIZED (
  SELECT c.*, d.language, d.confidence,
    coalesce(p.polarity, 0e0) AS polarity, coalesce(p.subjectivity, 0e0) AS subjectivity,
    coalesce(p.polarity_label, 'neutral') AS polarity_label,
    coalesce(v.compound, 0e0) AS compound, coalesce(v.positive, 0e0) AS positive,
    coalesce(v.neutral, 1e0) AS neutral, coalesce(v.negative, 0e0) AS negative,
    coalesce(v.valence_label, 'neutral') AS valence_label,
    CASE WHEN c.scored_text = '' THEN 'neutral' ELSE coalesce(v.valence_label, 'neutral') END AS final_sentiment,
    CASE WHEN c.scored_text = '' THEN 0e0
         WHEN coalesce(p.polarity_label, 'neutral') = coalesce(v.valence_label, 'neutral') THEN 0.8e0 ELSE 0.6e0 END AS sentiment_confidence,
    {exact_round('(coalesce(p.polarity, 0e0) + coalesce(v.compound, 0e0)) / 2e0')} AS final_score
  FROM (SELECT *, {first_text('processed_text', 'original_text')} AS scored_text FROM clean) c
  LEFT JOIN detected d ON d.id_post = c.id_post
  LEFT JOIN polar p ON p.id_post = c.id_post LEFT JOIN valence v ON v.id_post = c.id_post)"""


def enriched_with(source_cte: str, source: str, profile_source: str | None = "documents") -> str:
    """The whole chain: clean, train, detect, score. Sentiment is checked on processed texts."""
    return ",\n".join([
        source_cte, clean_cte(source), profile_cte("documents", "text", "lang"),
        detect_cte("clean", "original_text"), words_cte("clean", "processed_text"),
        valence_cte(), polarity_cte(), ENRICHED,
    ])


FLAT = f"""flat0 AS (SELECT *, {first_text('processed_text', 'original_text')} AS contenu FROM enriched),
flat AS MATERIALIZED (SELECT id_post, original_text AS contenu_original, processed_text AS contenu_traite, contenu,
    {shorten(first_text('original_text', 'contenu'), 100)} AS titre,
    label, type AS type_harcelement, 'anonymous' AS auteur, '' AS url,
    language AS langue, confidence AS langue_confiance, final_sentiment AS sentiment, final_score AS score,
    sentiment_confidence AS sentiment_confiance, polarity AS textblob_polarite, subjectivity AS textblob_subjectivite,
    polarity_label AS textblob_sentiment, compound AS vader_compound, positive AS vader_positif,
    neutral AS vader_neutre, negative AS vader_negatif, valence_label AS vader_sentiment,
    CAST(length(contenu) AS BIGINT) AS longueur_texte, CAST(len({words('contenu')}) AS BIGINT) AS nb_mots FROM flat0)"""


def search_terms(x: str) -> str:
    words = f"regexp_extract_all(lower(coalesce({x}, '')), {q(word_pattern(script='', keep=''))})"
    cut = f"flatten(list_transform({words}, lambda w: CASE WHEN length(w) <= 255 THEN [w] ELSE regexp_extract_all(w, '(?s).{{1,255}}') END))"
    return f"list_filter({cut}, lambda t: t NOT IN {inlist(SEARCH_STOP_WORDS)})"


def function_words(l: str) -> str:
    """Language of letters ``l`` by function words, null without any."""
    counts = ", ".join(
        f"len(list_filter(string_split({l}, ' '), lambda w: w IN {inlist(LANGUAGE_WORDS[k])}))" for k in sorted(LANGUAGE_WORDS)
    )
    langs = "[" + ", ".join(q(k) for k in sorted(LANGUAGE_WORDS)) + "]"
    return f"(CASE WHEN list_max([{counts}]) > 0 THEN {langs}[list_position([{counts}], list_max([{counts}]))] END)"


OPENING, CLOSING = "(\\[{\"'«“‘¿¡", ")\\]}\"'»”’"


def bare(w: str) -> str:
    return f"lower({sub(w, f'^[{OPENING}]+|[.!?…,;:{CLOSING}]+$')})"


def abbreviation_cte(source: str, text: str = "text") -> str:
    """``abbr(word, score)`` of the words of ``source``."""
    dotted = f"regexp_matches(w, {q(f'[.][{CLOSING}]*[,;:]?[{CLOSING}]*$')})"
    like = lambda p: f"(k * ln({p}) + (n - k) * ln(1e0 - {p}))"
    p = "least(greatest(CAST(all_k AS DOUBLE) / all_n, 1e-9), 0.99e0)"
    return f"""aw AS (SELECT unnest({words(f"coalesce({text}, '')")}) AS w FROM {source}),
ab AS (SELECT {bare('w')} AS word, {dotted} AS dotted FROM aw),
ac AS (SELECT word, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE dotted) AS DOUBLE) AS k FROM ab GROUP BY word),
asum AS (SELECT sum(n) AS all_n, sum(k) AS all_k FROM ac),
ad AS (SELECT *, CAST(length(replace(word, '.', '')) AS DOUBLE) AS letters FROM ac, asum WHERE k > 0 AND regexp_matches(word, '^\\p{{L}}[\\p{{L}}.]*$')),
ae AS (SELECT word, -2e0 * ({like(p)} - {like('0.99e0')}) * exp(-letters) * (length(word) - letters + 1) * pow(letters, k - n) AS score FROM ad),
abbr AS MATERIALIZED (SELECT * FROM ae WHERE score >= 0.3e0)"""


def sentence_cte(source: str, text: str = "text") -> str:
    """``counted(id_post, sentences)`` of ``source(id_post, text)``."""
    ends, loud = q(f"[.!?…]+[{CLOSING}]*$"), q(f"(?:[!?…]|[.][.])[.!?…]*[{CLOSING}]*$")
    return f"""sw AS (SELECT id_post, {words(f"coalesce({text}, '')")} AS ws FROM {source}),
su AS (SELECT id_post, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS pos FROM sw),
sn AS (SELECT id_post, w, {bare('w')} AS b, lead(w) OVER (PARTITION BY id_post ORDER BY pos) AS nx FROM su),
sc AS (SELECT id_post, 1 + count(*) FILTER (WHERE nx IS NOT NULL AND regexp_matches(w, {ends}) AND NOT regexp_matches(nx, {q(f'^[{OPENING}]*' + chr(92) + 'p{Ll}')})
    AND (regexp_matches(w, {loud}) OR NOT (b IN (SELECT word FROM abbr) OR regexp_full_match(b, '[a-zà-ÿ]')))) AS n FROM sn GROUP BY id_post),
counted AS (SELECT id_post, coalesce(n, 0) AS sentences FROM sw LEFT JOIN sc USING (id_post))"""


SHOUTED = """shouted AS (SELECT CAST(doc_id AS VARCHAR) AS id_post, replace(replace(replace(replace(replace(text, ' the ', ' THE '), ' de ', ' DE! '),
  ' la ', ' "la", '), ' of ', ' st (of)? '), ' to ', ' 😊 ') AS text FROM documents)"""


def polarity_words(x: str) -> str:
    apart = sub(f"lower({x})", "n't" + chr(92) + "b", " n't")
    return f"regexp_extract_all({apart}, {q("n't|[" + chr(92) + "p{L}" + chr(92) + "p{N}]+(?:'[" + chr(92) + "p{L}]+)?")})"
