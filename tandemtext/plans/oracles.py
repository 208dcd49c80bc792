"""DuckDB SQL that computes the same results from the same tables.

The SQL engine has no look-around, so word borders are written into the text as
extra characters first; the statements share a few common table expressions.
"""

from __future__ import annotations

from ..functions.language import INDICATORS, WORD_GROUPS
from ..functions.sentences import EXTRA_BUSINESS, LONG_LIST, PERIOD_TOKEN, SHORT_LIST
from ..functions.text import SPACE_CHARS
from ..operators.language_model import NGRAM_SIZES
from ..operators.training import CONTROL_TOKENS
from .queries import BASE_MS, LEAST_KNOWN, NUM_BATCHES, RUN_TIME, SAMPLE_SEED

ORACLES: dict[str, str] = {}

S = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
W = r"[\p{L}\p{N}_]"
N = r"[^\p{L}\p{N}_]"
# Extra characters: word start, word end, span start, span end, kept period, cut.
WS, WE, SO, SC, KP, CUT = (chr(0xFDD3 + i) for i in range(6))
MARKS = WS + WE + SO + SC


def _sub(text: str, pattern: str, to: str) -> str:
    pattern, to = pattern.replace("'", "''"), to.replace("'", "''")
    return f"regexp_replace({text}, '{pattern}', '{to}', 'g')"


def _strip(text: str) -> str:
    return f"trim({text}, '{SPACE_CHARS}')"


def _quoted(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _exploded(parts: str, cut: str = CUT) -> str:
    """``FROM`` item with one row per piece of ``parts`` (text with cut marks)."""
    return (
        f"(SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS k "
        f"FROM (SELECT doc_id, string_split({parts}, '{cut}') AS p FROM documents))"
    )


# --- sentence splitting


def _prod_text() -> str:
    initial = rf"(^|{N})([A-Z]\.)({S}[A-Z])"
    text = _strip("text")
    for _ in range(2):  # neighbours share a letter
        text = _sub(text, initial, rf"\1\2{SC}\3")
    text = _sub(text, rf"((?:{'|'.join(SHORT_LIST)})\.)({S})", rf"\1{SC}\2")
    return _sub(text, rf"([.!?]){S}+", rf"\1{CUT}")


def _bordered(text: str = "text") -> str:
    """Every word run between a start and an end character."""
    return _sub(_sub(text, rf"(^|{N})({W})", rf"\1{WS}\2"), rf"({W})({N}|$)", rf"\1{WE}\2")


def _spans(version: bool, extras: bool) -> str:
    digits = rf"{WS}\p{{Nd}}+{WE}"
    names = LONG_LIST + (EXTRA_BUSINESS if version else [])
    if not extras:
        names = [n for n in names if n != "etc"]
    # A period or space inside a name separates two words.
    spelled = ["|".join([WS + n.replace(".", f"{WE}\\.{WS}").replace(" ", f"{WE} {WS}") + WE for n in names])]
    alternatives = [rf"{digits}\.{digits}\.{digits}"] if version else []
    alternatives += [rf"{digits}\.{digits}", rf"{digits}\.", rf"{WS}[A-Z]{WE}\.", rf"(?:{spelled[0]})\."]
    if extras:
        alternatives.append(r"\.\.\.+")
    return "|".join(alternatives)


def _spanned(version: bool = True, extras: bool = False) -> str:
    return _sub(_bordered(), f"({_spans(version, extras)})", rf"{SO}\1{SC}")


def _unspan(text: str, following: str) -> str:
    return _sub(text, f"{SO}([^{SO}{SC}]*){SC}({following})", r"\1\2")


def _clean(text: str) -> str:
    return _sub(text, f"[{MARKS}]", "")


def _keep_periods(text: str, with_ellipsis: bool, to: str) -> str:
    for _ in range(2):  # at most two periods per span
        text = _sub(text, rf"({SO}[^{SO}{SC}.]*)\.", rf"\1{to}")
    if with_ellipsis:
        pieces = f"regexp_extract_all({text}, '\\.+|[^.]+')"
        text = (
            f"array_to_string(list_transform({pieces}, lambda x: "
            f"CASE WHEN x LIKE '...%' THEN repeat('{to}', length(x)) ELSE x END), '')"
        )
    return text


def _sentences(profile: str) -> str:
    """SELECT doc_id, pos, sentence."""
    if profile == "prod":
        return (
            f"SELECT doc_id, CAST(k - 1 AS INTEGER) AS pos, replace(piece, '{SC}', '') AS sentence "
            f"FROM {_exploded(_prod_text())} WHERE piece <> ''"
        )
    if profile == "drop_punct":
        text = _keep_periods(_spanned(version=False, extras=False), True, KP)
        text = _sub(text, rf"[.!?]+{S}*", CUT)
        piece = _strip(f"replace({_clean('piece')}, '{KP}', '.')")
    else:
        text = _spanned()
        if profile == "full_lookahead":
            text = _unspan(text, rf" +{WS}\p{{Lu}}")
        text = _sub(text, rf"([.!?]){S}+", rf"\1{CUT}")
        piece = _clean("piece") if profile == "simple" else _strip(_clean("piece"))
    keep = "TRUE" if profile == "simple" else "length(sentence) >= 10"
    return (
        f"SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS INTEGER) AS pos, sentence "
        f"FROM (SELECT doc_id, k, {piece} AS sentence FROM {_exploded(text)}) WHERE {keep}"
    )


def _token_text(profile: str) -> str:
    if profile == "prod":
        # Border characters stay out: names of this profile may start inside a word.
        initial = _strip_none()
        return initial
    if profile == "drop_punct":
        return _clean(_keep_periods(_spanned(version=False), True, PERIOD_TOKEN))
    text = _spanned()
    if profile != "simple":
        text = _unspan(text, ",|$")
    if profile == "full_lookahead":
        text = _unspan(text, rf" +{SO}?{WS}\p{{Lu}}")
    return _clean(_keep_periods(text, False, PERIOD_TOKEN))


def _strip_none() -> str:
    text = "text"
    # A period after a listed name, unless a comma or the end follows.
    text = _sub(text, rf"((?:{'|'.join(SHORT_LIST)}))\.([^,])", rf"\1{KP}\2")
    bordered = _bordered(text)
    # One to three capitals and a period before a word; or one capital, a period, one space, a capital.
    for _ in range(3):
        bordered = _sub(bordered, rf"({WS}[A-Z]{{1,3}}{WE})\.({WS})", rf"\1{KP}\2")
        bordered = _sub(bordered, rf"({WS}[A-Z]{WE})\.({S}{WS}[A-Z])", rf"\1{KP}\2")
    return f"replace({_sub(bordered, f'[{WS}{WE}]', '')}, '{KP}', '{PERIOD_TOKEN}')"


for _profile in ("prod", "drop_punct", "full", "full_lookahead", "simple"):
    ORACLES[f"split_{_profile}"] = _sentences(_profile)

ORACLES["protect_abbreviations"] = "SELECT doc_id, " + ", ".join(
    f"{_token_text(p)} AS text_{p}" for p in ("simple", "full", "full_lookahead", "drop_punct", "prod")
) + " FROM documents"

ORACLES["abbreviation_matches"] = f"""
WITH pieces AS (
  SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS k
  FROM (SELECT doc_id, string_split({_sub(_spanned(extras=True), f'[{SO}{SC}]', CUT)}, '{CUT}') AS p FROM documents)),
placed AS (
  SELECT doc_id, k, {_sub('piece', f'[{WS}{WE}]', '')} AS piece FROM pieces),
summed AS (
  SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY k) AS upto FROM placed)
SELECT doc_id, CAST(k // 2 - 1 AS INTEGER) AS match_no, piece AS match,
       CAST(upto - length(piece) AS INTEGER) AS start_offset, CAST(upto AS INTEGER) AS end_offset
FROM summed WHERE k % 2 = 0"""


# --- language predicates


def _hits(s: str) -> str:
    tokens = f"regexp_extract_all(lower({s}), '{W}+')"
    return " + ".join(f"len(list_filter({tokens}, lambda w: w IN ({_quoted(g)})))" for g in WORD_GROUPS)


def _n_words(s: str) -> str:
    return f"CASE WHEN {_strip(s)} = '' THEN 0 ELSE len(regexp_split_to_array({_strip(s)}, '{S}+')) END"


def _indicator_hits(s: str) -> str:
    return f"len(list_filter([{_quoted(INDICATORS)}], lambda w: contains(lower({s}), w)))"


def _is_english(s: str, extra: str = "0") -> str:
    return f"({_strip(s)} <> '' AND ({_hits(s)} + {extra}) / greatest({_n_words(s)}, 1) >= 0.3)"


PROD = f"sents AS MATERIALIZED ({_sentences('prod')})"
KEPT = f"{PROD}, kept AS MATERIALIZED (SELECT * FROM sents WHERE NOT {_is_english('sentence')})"
NUMBERED = (
    f"{KEPT}, numbered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY doc_id, pos) AS ordinal FROM kept), "
    "chunked AS (SELECT *, (ordinal - 1) // 100 + 1 AS chunk_id, CAST((ordinal - 1) % 100 + 1 AS INTEGER) AS chunk_line FROM numbered), "
    "manifest AS (SELECT chunk_id, 'chunks/chunk_' || chunk_id || '.txt' AS file_path, "
    "CAST(count(*) AS INTEGER) AS sentence_count FROM chunked GROUP BY chunk_id)"
)
LINES = (
    f"{NUMBERED}, pieces AS (SELECT chunk_id, ordinal, unnest(p) AS piece, generate_subscripts(p, 1) AS k FROM "
    r"(SELECT chunk_id, ordinal, regexp_split_to_array(sentence, '\r\n|\r|\n') AS p FROM chunked)), "
    f"stripped AS (SELECT chunk_id, ordinal, k, {_strip('piece')} AS line FROM pieces), "
    "lines AS MATERIALIZED (SELECT chunk_id, CAST(row_number() OVER (PARTITION BY chunk_id ORDER BY ordinal, k) AS INTEGER) AS line_no, "
    "line, left(md5(line), 2) AS kind FROM stripped WHERE line <> '')"
)
STRICT = (
    f"{LINES}, strict AS MATERIALIZED (SELECT chunk_id, line_no, line, "
    "CASE WHEN kind IN ('00', '01', '02') THEN NULL ELSE '[en] ' || line END AS translated, "
    "kind NOT IN ('00', '01', '02') AS ok, "
    "CAST(CASE kind WHEN '00' THEN 3 WHEN '01' THEN 3 WHEN '02' THEN 3 WHEN '03' THEN 2 ELSE 1 END AS INTEGER) AS attempts, "
    "CASE kind WHEN '00' THEN 'service error: ' || left(line, 50) WHEN '01' THEN 'unchanged: ' || left(line, 50) "
    "WHEN '02' THEN 'empty result: ' || left(line, 50) END AS error FROM lines), "
    "done AS MATERIALIZED (SELECT chunk_id FROM strict GROUP BY chunk_id HAVING bool_and(ok)), "
    "pairs AS (SELECT chunk_id, line_no, line, translated FROM strict SEMI JOIN done USING (chunk_id))"
)
PAIRS = (
    f"{NUMBERED}, demo AS (SELECT ordinal AS seq_id, '[en] ' || sentence AS english, sentence AS source_text, chunk_id FROM chunked)"
)

ORACLES["english_ratio_patterns"] = f"""
WITH {PROD}
SELECT doc_id, pos, CAST({_hits('sentence')} AS INTEGER) AS hits, CAST({_n_words('sentence')} AS INTEGER) AS n_words,
       {_is_english('sentence')} AS is_english FROM sents"""
ORACLES["english_ratio_lexicon"] = f"""
WITH sents AS MATERIALIZED ({_sentences('drop_punct')})
SELECT doc_id, pos, CAST({_hits('sentence')} + {_indicator_hits('sentence')} AS INTEGER) AS hits,
       {_is_english('sentence', _indicator_hits('sentence'))} AS is_english FROM sents"""
ORACLES["filter_min_length"] = f"WITH {PROD} SELECT * FROM sents WHERE length(sentence) >= 10"
ORACLES["filter_english"] = f"WITH {KEPT} SELECT * FROM kept"


# --- word-level language detection

def _bare(list_sql: str) -> str:
    return f"list_transform({list_sql}, lambda w: regexp_replace(lower(w), '[^\\p{{L}}]+', '', 'g'))"


def _word_list(text: str) -> str:
    """Bare words of a text; empty list for blank text."""
    return f"CASE WHEN {_strip(text)} = '' THEN [] ELSE {_bare(f"regexp_split_to_array({_strip(text)}, '{S}+')")} END"


def _grams(table: str, keys: str) -> str:
    sizes = " UNION ALL ".join(
        f"SELECT {keys}, substr('_' || word || '_', CAST(i AS INTEGER), {k}) AS ngram "
        f"FROM (SELECT *, unnest(range(1, length(word) + 4 - {k})) AS i FROM {table})"
        for k in NGRAM_SIZES
    )
    return f"({sizes})"


def _model_sql(labelled: str = "lang IS NOT NULL") -> str:
    return f"""
train AS (SELECT lang, word, count(*) AS n FROM
  (SELECT lang, unnest({_word_list('text')}) AS word FROM documents WHERE {labelled}) WHERE word <> '' GROUP BY lang, word),
grams AS MATERIALIZED (SELECT lang, ngram, CAST(sum(n) AS BIGINT) AS n FROM {_grams('train', 'lang, n')} GROUP BY lang, ngram),
totals AS (SELECT lang, sum(n) + (SELECT count(DISTINCT ngram) FROM grams) AS total FROM grams GROUP BY lang),
profile AS MATERIALIZED (SELECT lang, ngram, n, CAST(round(ln((n + 1) / total) * 10000) AS BIGINT) AS score FROM grams JOIN totals USING (lang)),
unseen AS (SELECT lang, CAST(round(ln(1 / total) * 10000) AS BIGINT) AS missing FROM totals)"""


def _word_lang_sql(labelled: str = "lang IS NOT NULL", least_known: float = 0) -> str:
    """Only a language that knows an n-gram of a word, and enough of them, can be the word's; a word may have none."""
    return f"""{_model_sql(labelled)}, {PROD},
vocab AS MATERIALIZED (SELECT word, count(*) AS n FROM (SELECT unnest(list_distinct({_word_list('sentence')})) AS word FROM sents)
  WHERE word <> '' GROUP BY word),
word_grams AS MATERIALIZED (SELECT word, ngram, count(*) AS times FROM {_grams('vocab', 'word')} GROUP BY word, ngram),
scored AS (SELECT w.word, u.lang, sum(w.times * coalesce(p.score, u.missing)) AS score,
    sum(CASE WHEN p.score IS NOT NULL THEN w.times ELSE 0 END) AS known, sum(w.times) AS length
  FROM word_grams w CROSS JOIN unseen u LEFT JOIN profile p ON p.ngram = w.ngram AND p.lang = u.lang GROUP BY ALL),
best AS MATERIALIZED (SELECT word, lang FROM scored WHERE known > 0 AND known >= {least_known} * length
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY score DESC, lang) = 1)"""


def _flags_sql(word_lang: str) -> str:
    """A sentence of words that are all detected, as English."""
    return f"""{word_lang},
used AS (SELECT doc_id, pos, unnest(list_distinct({_word_list('sentence')})) AS word FROM sents),
flags AS (SELECT doc_id, pos, bool_and(coalesce(lang = 'en', FALSE)) AS is_english FROM used LEFT JOIN best USING (word) GROUP BY doc_id, pos),
flagged AS (SELECT doc_id, pos, coalesce(is_english, FALSE) AS is_english FROM sents LEFT JOIN flags USING (doc_id, pos))"""


FLAGS = _flags_sql(_word_lang_sql())
# As the query: two of the languages are known to the model, and a word's language has to know half of its n-grams.
REJECTING = _word_lang_sql("lang IN ('de', 'en')", LEAST_KNOWN)
ORACLES["lang_profile"] = f"WITH {_model_sql()} SELECT lang, ngram, n, score FROM profile"
ORACLES["word_language"] = f"WITH {_word_lang_sql()} SELECT word, n, lang FROM vocab LEFT JOIN best USING (word)"
ORACLES["word_language_rejects"] = f"WITH {REJECTING} SELECT word, n, lang FROM vocab LEFT JOIN best USING (word)"
ORACLES["english_rejects"] = f"WITH {_flags_sql(REJECTING)} SELECT doc_id, pos, is_english FROM flagged"
ORACLES["english_all_words"] = f"WITH {FLAGS} SELECT doc_id, pos, is_english FROM flagged"
ORACLES["english_all_words_null_keys"] = f"""
WITH {FLAGS}
SELECT CASE WHEN doc_id % 97 = 0 THEN NULL ELSE doc_id END AS doc_id, is_english, count(*) AS n, CAST(sum(length(sentence)) AS BIGINT) AS chars
FROM flagged JOIN sents USING (doc_id, pos) GROUP BY ALL"""
ORACLES["chunk_articles_by_words"] = f"""
WITH {FLAGS}, ranked AS (SELECT doc_id, pos, row_number() OVER (ORDER BY doc_id, pos) - 1 AS r FROM flagged WHERE NOT is_english)
SELECT doc_id, pos, r // 100 + 1 AS chunk_id, CAST(r % 100 + 1 AS INTEGER) AS line_no FROM ranked"""


# --- sources

ORACLES["scan_articles"] = "SELECT doc_id, text FROM documents"
ORACLES["scan_articles_explicit"] = "SELECT page_id AS doc_id, html AS text FROM pages"
ORACLES["article_pairs_jsonl"] = f"""
WITH sents AS ({_sentences('drop_punct')})
SELECT doc_id AS article_index, CAST(pos AS BIGINT) AS sentence_index, sentence AS source_text, '[en] ' || sentence AS english FROM sents"""
ORACLES["scan_json_array"] = """
SELECT CASE WHEN lang = 'de' THEN 0 ELSE doc_id END AS article_index, CAST(0 AS BIGINT) AS sentence_index, text
FROM documents WHERE lang NOT IN ('fr', 'es') AND text <> ''"""
ORACLES["scan_json_one_line"] = """
SELECT doc_id AS article_index, CAST(0 AS BIGINT) AS sentence_index, text FROM documents WHERE text <> ''"""
ORACLES["scan_json_unbalanced"] = """
SELECT doc_id AS article_index, CAST(0 AS BIGINT) AS sentence_index, text FROM documents WHERE text <> '' AND lang IS DISTINCT FROM 'fr'"""
ORACLES["record_pairs"] = f"""
SELECT doc_id AS article_index, CAST(0 AS BIGINT) AS sentence_index, text AS source_text,
       CASE WHEN left(md5(text), 2) IN ('00', '01', '02') THEN text ELSE '[en] ' || text END AS english
FROM documents WHERE text <> '' AND NOT {_is_english('text', _indicator_hits('text'))}"""
ORACLES["scan_pairs_jsonl"] = """
SELECT doc_id AS seq_id, '[en] ' || text AS english, text AS source_text, CAST(1 AS BIGINT) AS chunk_id FROM documents"""
ORACLES["chunk_lines"] = f"WITH {LINES} SELECT chunk_id, line_no, line FROM lines"
ORACLES["chunk_manifest"] = f"WITH {NUMBERED} SELECT *, FALSE AS is_translated, CAST({RUN_TIME} AS BIGINT) AS created_at FROM manifest"
ORACLES["manifest_layouts"] = f"WITH {NUMBERED} SELECT chunk_id, sentence_count, CAST({RUN_TIME} AS BIGINT) AS created_at FROM manifest"
ORACLES["chunk_files_roundtrip"] = f"""
WITH {STRICT}
SELECT chunk_id, 'source' AS kind, line_no, line FROM pairs UNION ALL
SELECT chunk_id, 'translated', line_no, translated FROM pairs"""
ORACLES["manifest_scan"] = (
    f"WITH {NUMBERED} SELECT *, FALSE AS is_translated, CAST(NULL AS VARCHAR) AS translated_file FROM manifest"
)
ORACLES["extracted_sentences"] = f"""
WITH sents AS ({_sentences('drop_punct')})
SELECT row_number() OVER (ORDER BY doc_id, pos) + {BASE_MS - 1} AS seq_id, doc_id, sentence FROM sents"""

ORACLES["sequence_pairs"] = f"""
WITH sents AS MATERIALIZED ({_sentences('drop_punct')}),
ids AS (SELECT row_number() OVER (ORDER BY doc_id, pos) + {BASE_MS - 1} AS seq_id, doc_id, sentence FROM sents)
SELECT seq_id AS sequence_id, doc_id AS article_index, sentence AS source_text,
       CASE WHEN left(md5(sentence), 2) IN ('00', '01', '02') THEN sentence ELSE '[en] ' || sentence END AS english
FROM ids WHERE NOT {_is_english('sentence')}"""

# --- chunks, batches and totals

ORACLES["untranslated_chunks"] = f"WITH {STRICT} SELECT chunk_id, sentence_count FROM manifest ANTI JOIN done USING (chunk_id)"
ORACLES["chunk_status"] = (
    f"WITH {STRICT} SELECT (SELECT count(*) FROM done) AS translated, (SELECT count(*) FROM manifest) AS total"
)
ORACLES["mark_translated"] = f"""
WITH {STRICT}
SELECT m.chunk_id, m.sentence_count, d.chunk_id IS NOT NULL AS is_translated,
       CASE WHEN d.chunk_id IS NOT NULL THEN 'chunks/translated_chunk_' || m.chunk_id || '.txt' END AS translated_file,
       CASE WHEN d.chunk_id IS NOT NULL THEN CAST({RUN_TIME} AS BIGINT) END AS translated_at
FROM manifest m LEFT JOIN done d USING (chunk_id)"""
ORACLES["chunk_atomic_translate"] = f"WITH {STRICT} SELECT chunk_id, line_no, line, translated FROM pairs"
ORACLES["chunk_early_stop"] = f"""
WITH {STRICT},
stops AS (SELECT chunk_id, min(line_no) FILTER (NOT ok) AS stop FROM strict GROUP BY chunk_id)
SELECT chunk_id, stop IS NULL AS ok, CAST(sum(attempts) AS INTEGER) AS attempts,
       CAST(CASE WHEN stop IS NULL THEN count(*) ELSE 0 END AS INTEGER) AS n_lines
FROM strict JOIN stops USING (chunk_id) WHERE stop IS NULL OR line_no <= stop GROUP BY chunk_id, stop"""
ORACLES["resumed_chunks"] = f"""
WITH {STRICT},
batches AS (SELECT chunk_id, (row_number() OVER (ORDER BY chunk_id) - 1) % {NUM_BATCHES} AS batch FROM manifest),
stops AS (SELECT chunk_id, min(line_no) FILTER (NOT ok) AS stop FROM strict GROUP BY chunk_id)
SELECT chunk_id, stop IS NULL AS ok, CAST(sum(attempts) AS INTEGER) AS attempts,
       CAST(CASE WHEN stop IS NULL THEN count(*) ELSE 0 END AS INTEGER) AS pairs,
       CASE WHEN batch = 1 AND stop IS NOT NULL THEN 2 ELSE 1 END AS tries
FROM strict JOIN stops USING (chunk_id) JOIN batches USING (chunk_id)
WHERE stop IS NULL OR line_no <= stop GROUP BY chunk_id, stop, batch"""
ORACLES["contamination_check"] = f"""
WITH {LINES}
SELECT chunk_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(*) FILTER (kind IN ('00', '01', '02')) AS INTEGER) AS identical,
       count(*) FILTER (kind IN ('00', '01', '02')) > 0 AS contaminated FROM lines GROUP BY chunk_id"""
BATCHES = (
    f"{NUMBERED}, ranked AS (SELECT chunk_id, row_number() OVER (ORDER BY chunk_id) - 1 AS r FROM manifest), "
    f"batches AS (SELECT chunk_id, CAST(r % {NUM_BATCHES} AS INTEGER) AS batch_number, r // {NUM_BATCHES} AS batch_pos FROM ranked)"
)
ORACLES["completion_log"] = f"""
WITH {BATCHES}
SELECT chunk_id, batch_number > 0 AS is_translated,
       CASE WHEN batch_number > 0 THEN 'chunks/translated_chunk_' || chunk_id || '.txt' END AS translated_file,
       CAST({RUN_TIME} + CASE batch_number WHEN 1 THEN 20 WHEN 2 THEN 10 WHEN 3 THEN 0 END AS BIGINT) AS translated_at
FROM batches"""
ORACLES["round_robin_batches"] = f"WITH {BATCHES} SELECT * FROM batches"
ORACLES["batch_manifest"] = f"""
WITH {BATCHES},
whole AS (SELECT batch_number, count(*) AS n, min(chunk_id) AS a, max(chunk_id) AS b FROM batches GROUP BY ALL)
SELECT CAST(i AS INTEGER) AS batch_number, {NUM_BATCHES} AS total_batches, coalesce(n, 0) AS chunk_count,
       a AS first_chunk, b AS last_chunk,
       CASE WHEN n > 0 THEN 'Translate chunks ' || a || ' to ' || b ELSE 'Empty batch' END AS instructions
FROM range({NUM_BATCHES}) t(i) LEFT JOIN whole ON whole.batch_number = i"""
ORACLES["batch_work_selection"] = f"""
WITH {BATCHES} SELECT chunk_id, sentence_count FROM manifest SEMI JOIN (SELECT * FROM batches WHERE batch_number = 1) USING (chunk_id)"""
ORACLES["article_split_stats"] = f"""
WITH {PROD}, judged AS (SELECT *, {_is_english('sentence')} AS english FROM sents),
counted AS (SELECT doc_id, count(*) AS found, count(*) FILTER (NOT english) AS kept, count(*) FILTER (english) AS skipped,
  string_agg(array_to_string(regexp_split_to_array({_strip('sentence')}, '{S}+')[:3], ' '), '|' ORDER BY pos) FILTER (english) AS heads
  FROM judged GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(found, 0) AS INTEGER) AS found, CAST(coalesce(kept, 0) AS INTEGER) AS kept,
       CAST(coalesce(skipped, 0) AS INTEGER) AS skipped, coalesce(heads, '') AS skipped_heads
FROM documents LEFT JOIN counted USING (doc_id)"""
ORACLES["run_totals"] = f"""
WITH {STRICT}
SELECT (SELECT count(*) FROM kept) AS sentences, (SELECT count(*) FROM sents) - (SELECT count(*) FROM kept) AS skipped,
       (SELECT count(*) FROM manifest) AS chunks, (SELECT count(*) FROM pairs) AS pairs, (SELECT count(*) FROM pairs) AS samples"""
ORACLES["global_ordinal"] = f"WITH {NUMBERED} SELECT doc_id, pos, ordinal FROM numbered"
ORACLES["assign_chunks"] = f"WITH {NUMBERED} SELECT doc_id, pos, ordinal, chunk_id, chunk_line AS line_no FROM chunked"
ORACLES["stream_chunk_ingest"] = f"WITH {NUMBERED} SELECT doc_id, pos, chunk_id, chunk_line AS line_no, sentence FROM chunked"
ORACLES["stream_open_chunk"] = ORACLES["stream_chunk_ingest"]
ORACLES["assign_seq_id"] = f"WITH {NUMBERED} SELECT ordinal + {BASE_MS} AS seq_id, doc_id, pos FROM numbered"
ORACLES["limit_articles"] = "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 100"
ORACLES["limit_articles_nulls"] = """
WITH ids AS (SELECT CASE WHEN doc_id % 10 = 3 THEN NULL ELSE doc_id END AS doc_id FROM documents),
taken AS (SELECT doc_id FROM ids QUALIFY row_number() OVER (ORDER BY doc_id NULLS LAST) <= (SELECT count(*) // 2 FROM ids))
SELECT doc_id, count(*) AS n FROM taken GROUP BY doc_id"""
ORACLES["resume_chunks"] = f"""
WITH {KEPT},
first_run AS (SELECT doc_id, pos, row_number() OVER (ORDER BY doc_id, pos) AS o FROM kept SEMI JOIN labels USING (doc_id)),
second_run AS (SELECT doc_id, pos, row_number() OVER (ORDER BY doc_id, pos) AS o FROM kept ANTI JOIN labels USING (doc_id)),
base AS (SELECT coalesce(max((o - 1) // 100 + 1), 0) AS n FROM first_run),
ids AS (SELECT (o - 1) // 100 + 1 AS chunk_id FROM first_run UNION ALL SELECT (o - 1) // 100 + 1 + (SELECT n FROM base) FROM second_run)
SELECT chunk_id, CAST(count(*) AS INTEGER) AS sentence_count FROM ids GROUP BY chunk_id"""


# --- translation, pairs and training

ORACLES["translate_strict"] = f"WITH {STRICT} SELECT chunk_id, line_no, line, translated, ok, attempts, error FROM strict"
ORACLES["translate_keep_source"] = f"""
WITH {LINES}
SELECT chunk_id, line_no, line, CASE WHEN kind IN ('00', '01', '02') THEN line ELSE '[en] ' || line END AS translated, TRUE AS ok,
       CAST(CASE kind WHEN '00' THEN 3 WHEN '03' THEN 2 ELSE 1 END AS INTEGER) AS attempts FROM lines"""
ORACLES["article_pairs"] = f"""
WITH sents AS MATERIALIZED ({_sentences('drop_punct')})
SELECT doc_id AS article_index, CAST(pos AS BIGINT) AS sentence_index, sentence AS source_text,
       CASE WHEN left(md5(sentence), 2) IN ('00', '01', '02') THEN sentence ELSE '[en] ' || sentence END AS english
FROM sents WHERE NOT {_is_english('sentence', _indicator_hits('sentence'))}"""
ORACLES["assemble_pairs"] = f"""
WITH {STRICT}
SELECT row_number() OVER (ORDER BY chunk_id, line_no) + {BASE_MS} AS seq_id, translated AS english, line AS source_text, chunk_id FROM pairs"""
ORACLES["resumed_pairs"] = ORACLES["assemble_pairs"]
TURNS = """turns AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS k FROM conversations),
zipped AS (SELECT u.conv_id, u.k, u.text AS source_text, a.text AS english FROM turns u JOIN turns a USING (conv_id, k)
  WHERE u.role = 'user' AND a.role = 'assistant')"""
ORACLES["zip_pairs"] = f"WITH {TURNS} SELECT * FROM zipped"
ORACLES["concat_datasets"] = f"""
WITH {PAIRS}, {TURNS} SELECT english, source_text FROM demo UNION ALL SELECT english, source_text FROM zipped"""
ORACLES["translation_memory_join"] = rf"""
WITH cut AS (SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS k
  FROM (SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS p FROM documents)),
stripped AS (SELECT doc_id, k, {_strip('piece')} AS line FROM cut),
lines AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS INTEGER) AS pos, line FROM stripped WHERE line <> ''),
memory AS (SELECT DISTINCT line FROM lines SEMI JOIN labels USING (doc_id))
SELECT doc_id, pos, CASE WHEN m.line IS NOT NULL THEN '[en] ' || m.line END AS translated, m.line IS NOT NULL AS ok
FROM lines LEFT JOIN memory m ON m.line = lines.line"""
ORACLES["memory_hot_line"] = rf"""
WITH cut AS (SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS k
  FROM (SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS p FROM documents)),
stripped AS (SELECT doc_id, k, {_strip('piece')} AS line FROM cut),
own AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS INTEGER) AS pos, line FROM stripped WHERE line <> ''),
lines AS (SELECT doc_id, pos, CASE WHEN (doc_id + pos) % 2 = 0 THEN 'the one frequent line' ELSE line END AS line FROM own),
memory AS (SELECT DISTINCT line FROM own WHERE length(line) % 3 = 0 UNION SELECT 'the one frequent line')
SELECT doc_id, pos, m.line IS NOT NULL AS ok FROM lines LEFT JOIN memory m ON m.line = lines.line"""
ORACLES["training_slices"] = f"WITH {NUMBERED} SELECT ordinal AS seq_id, (ordinal - 1) // 1000 AS batch_index FROM numbered"
ORACLES["next_training_slice"] = f"""
WITH {PAIRS}, half AS (SELECT ((count(*) + 999) // 1000) // 2 AS i FROM demo)
SELECT seq_id, english, (seq_id - 1) // 1000 AS batch_index, i AS next_index FROM demo, half WHERE (seq_id - 1) // 1000 = i"""
ORACLES["limit_articles_texts"] = """
WITH ids AS (SELECT CASE WHEN doc_id % 10 = 3 THEN NULL ELSE 'article-' || (doc_id * 7919 % 1000003) END AS doc_id FROM documents),
taken AS (SELECT doc_id FROM ids QUALIFY row_number() OVER (ORDER BY doc_id NULLS LAST) <= (SELECT count(*) // 3 FROM ids))
SELECT doc_id, count(*) AS n FROM taken GROUP BY doc_id"""
ORACLES["training_batch_summary"] = f"WITH {KEPT} SELECT count(*) AS n_samples, CAST(ceil(count(*) / 1000) AS BIGINT) AS n_batches FROM kept"
ORACLES["progress_status"] = f"""
WITH {KEPT}, n AS (SELECT count(*) AS n, (count(*) + 999) // 1000 AS b FROM kept)
SELECT n AS total_samples, greatest(b - 1, 0) AS batches_trained, greatest(b - 1, 0) AS current_batch,
       CASE WHEN b > 1 THEN 'models/batch_' || (b - 2) END AS model_dir, CAST(0 AS BIGINT) AS start_time,
       greatest(b - 1, 0) * 60 AS last_update FROM n"""
ORACLES["pipeline_status"] = f"""
WITH {KEPT}, n AS (SELECT count(*) AS n, (count(*) + 999) // 1000 AS b FROM kept)
SELECT (SELECT count(*) FROM sents) AS extracted, n AS translated, b AS batches_trained,
       greatest(b - 1, 0) AS batch_index, greatest(b - 1, 0) * 1000 AS training_index,
       (b - 1) * 60 AS last_training FROM n"""
VOCAB = (
    f"{PAIRS}, tokens AS MATERIALIZED (SELECT seq_id, side, unnest(p) AS token, generate_subscripts(p, 1) AS k FROM ("
    f"SELECT seq_id, 's' AS side, regexp_split_to_array({_strip('english')}, '{S}+') AS p FROM demo UNION ALL "
    f"SELECT seq_id, 't', regexp_split_to_array({_strip('source_text')}, '{S}+') FROM demo)), "
    "vocab AS MATERIALIZED (SELECT token, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, token) + "
    f"{len(CONTROL_TOKENS) - 1} AS token_id FROM tokens GROUP BY token)"
)
ORACLES["build_vocab"] = f"WITH {VOCAB} SELECT token, n, token_id FROM vocab"
ORACLES["encode_pad"] = f"""
WITH {VOCAB},
coded AS (SELECT seq_id, side, list(token_id ORDER BY k) AS ids FROM tokens JOIN vocab USING (token) WHERE k <= 126 GROUP BY ALL),
framed AS (SELECT seq_id, side, [CASE side WHEN 's' THEN 4 ELSE 5 END] || ids || [2] AS ids FROM coded),
padded AS (SELECT seq_id, side, array_to_string(list_resize(ids, 128, 1), ' ') AS ids,
  array_to_string(list_resize(list_transform(ids, lambda x: 1), 128, 0), ' ') AS mask FROM framed)
SELECT s.seq_id, s.ids AS input_ids, s.mask AS attention_mask, t.ids AS labels
FROM (SELECT * FROM padded WHERE side = 's') s JOIN (SELECT * FROM padded WHERE side = 't') t USING (seq_id)"""
ORACLES["encode_concat"] = f"""
WITH {PAIRS}, {TURNS},
together AS (SELECT seq_id, english, source_text FROM demo UNION ALL SELECT seq_id, english, source_text FROM demo
  UNION ALL SELECT k, english, source_text FROM zipped),
rows AS MATERIALIZED (SELECT row_number() OVER () AS r, * FROM together),
tokens AS MATERIALIZED (SELECT r, seq_id, side, unnest(p) AS token, generate_subscripts(p, 1) AS k FROM (
  SELECT r, seq_id, 's' AS side, CASE WHEN {_strip('english')} = '' THEN [] ELSE regexp_split_to_array({_strip('english')}, '{S}+') END AS p FROM rows
  UNION ALL
  SELECT r, seq_id, 't', CASE WHEN {_strip('source_text')} = '' THEN [] ELSE regexp_split_to_array({_strip('source_text')}, '{S}+') END FROM rows)),
vocab AS MATERIALIZED (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) + {len(CONTROL_TOKENS) - 1} AS token_id FROM tokens GROUP BY token),
coded AS (SELECT r, side, sum(token_id) AS s, count(*) AS n FROM tokens JOIN vocab USING (token) WHERE k <= 126 GROUP BY ALL),
sides AS (SELECT rows.r, seq_id, coalesce(e.s, 0) AS es, coalesce(e.n, 0) AS en, coalesce(t.s, 0) AS ts, coalesce(t.n, 0) AS tn
  FROM rows LEFT JOIN coded e ON e.r = rows.r AND e.side = 's' LEFT JOIN coded t ON t.r = rows.r AND t.side = 't')
SELECT seq_id, count(*) AS n, CAST(sum(4 + es + 2 + 126 - en) AS BIGINT) AS input_sum, CAST(sum(5 + ts + 2 + 126 - tn) AS BIGINT) AS label_sum,
       CAST(sum(en + 2) AS BIGINT) AS mask_sum FROM sides GROUP BY seq_id"""
SAMPLE = f"(SELECT * FROM benchmark ORDER BY md5('{SAMPLE_SEED}:' || item_id), item_id LIMIT 10)"
ORACLES["spot_check_sample"] = f"SELECT item_id, text FROM {SAMPLE}"
ORACLES["spot_check_compare"] = f"""
SELECT item_id AS sample_id, text AS english_input, text AS reference,
       CASE WHEN left(md5(text), 2) NOT IN ('00', '01', '02') THEN '[en] ' || text END AS predicted FROM {SAMPLE}"""
ORACLES["spot_check_written"] = ORACLES["spot_check_compare"]
