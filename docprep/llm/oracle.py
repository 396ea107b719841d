"""The same results in DuckDB's SQL, where SQL can express them over whole tables in reasonable time."""

from __future__ import annotations

#: Shingle sets joined on each shared sequence: exact, and independent of any sketch.
_QA_PAIRS = """
WITH RECURSIVE words AS (
  SELECT qa_id, regexp_extract_all(lower(coalesce(question, '') || ' ' || coalesce(answer, '')), '[a-z0-9]+') AS w FROM qa_rows
), sequence AS (
  SELECT DISTINCT qa_id, hash(unnest(list_zip(w[:-3], w[2:-2], w[3:]))) AS s FROM words WHERE len(w) >= 3
), kept AS (
  SELECT qa_id, s, count(*) OVER (PARTITION BY qa_id) AS n FROM sequence QUALIFY n >= 40
), common AS (
  SELECT a.qa_id AS qa_id_a, b.qa_id AS qa_id_b, a.n AS na, b.n AS nb, count(*) AS k
  FROM kept a JOIN kept b ON a.s = b.s AND a.qa_id < b.qa_id GROUP BY ALL
), pair AS (
  SELECT qa_id_a, qa_id_b, k = na AND k = nb AS same FROM common WHERE k >= 0.6 * (na + nb - k)
)
"""


#: Letters of other scripts and of phonetic notation over the Latin ones they look like, listed by hand.
_ODD = "аеорсухіјѕԁһүԛԝѵӏҽ" "АВЕКМНОРСТХУІЈЅԌԚԜѴҮ" "αιονρυϲϳ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹ" "սօհոցզյՍՕՏ" "ɡɑɩɪʏʋᴄᴏᴜᴠᴡᴢ"
_PLAIN = "aeopcyxijsdhyqwvle" "ABEKMHOPCTXYIJSGQWVY" "aiovpucj" "ABEZHIKMNOPTYXC" "uohngqjUOS" "gaiiyucouvwz"
#: Classes of characters, for RE2.
_WIDE_FORMS, _JOINED = r"\x{ff01}-\x{ff5e}", r"\x{fb00}-\x{fb06}\x{132}\x{133}\x{1c4}-\x{1cc}\x{1f1}-\x{1f3}"
_UNITS, _MARKS = r"\x{2126}\x{212a}\x{212b}", r"\x{300}-\x{36f}\x{1ab0}-\x{1aff}\x{1dc0}-\x{1dff}\x{20d0}-\x{20ff}\x{fe20}-\x{fe2f}"
_BLANKS = r"\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"
_NOTHING = (
    r"\x00-\x08\x0e-\x1f\x7f-\x{84}\x{86}-\x{9f}\x{ad}\x{61c}\x{115f}\x{1160}\x{17b4}\x{17b5}\x{180b}-\x{180f}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{206f}\x{2800}\x{3164}"
    r"\x{feff}\x{ffa0}\x{fff9}-\x{fffb}\x{fe00}-\x{fe0f}\x{1d173}-\x{1d17a}\x{e0001}\x{e0020}-\x{e007f}\x{e0100}-\x{e01ef}"
)
_PICTURE = r"[\x{2190}-\x{21ff}\x{2300}-\x{23ff}\x{24c2}\x{25a0}-\x{27bf}\x{2900}-\x{297f}\x{2b00}-\x{2bff}\x{3030}\x{303d}\x{3297}\x{3299}\x{1f000}-\x{1faff}]"
_SIGN = r"[\x{a9}\x{ae}\x{203c}\x{2049}\x{2122}\x{2139}]"
#: What belongs to a picture is set aside as a private character, the rest of what prints nothing goes.
_BARE = f"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '({_PICTURE}|{_SIGN})\\x{{fe0f}}', '\\1' || chr(57345), 'g'),
  '({_PICTURE}\\x{{e001}}?)\\x{{200d}}({_PICTURE})', '\\1' || chr(57344) || '\\2', 'g'), '({_PICTURE}\\x{{e001}}?)\\x{{200d}}({_PICTURE})', '\\1' || chr(57344) || '\\2', 'g'), '[{_NOTHING}]', '', 'g')"""
_POSES = f"""(regexp_matches(w, '[{_ODD}]') AND regexp_full_match(w, '[\\p{{Latin}}{_ODD}]+') AND NOT regexp_full_match(w, '[\\x{{370}}-\\x{{3ff}}]'))"""
_P4_TEXTS = "SELECT 'elements' AS tab, doc_id, pos, Text AS t FROM elements UNION ALL SELECT 'chunks_data', doc_id, chunk_no, text_chunk FROM chunks_data"
_P4_CASE = f"""(bare <> t OR regexp_matches(t, '[{_WIDE_FORMS}{_JOINED}{_UNITS}{_MARKS}{_BLANKS}]') OR len(list_filter(regexp_extract_all(t, '\\p{{L}}+'), lambda w: {_POSES})) > 0)"""
#: Only ligatures of ordinary words; the digraphs of single languages don't occur.
_LIGATURES = {0xFB00: "ff", 0xFB01: "fi", 0xFB02: "fl", 0xFB03: "ffi", 0xFB04: "ffl", 0xFB05: "st", 0xFB06: "st"}


def _folded(t: str) -> str:
    """SQL that writes joined, full-width and special space characters as plain ones."""
    for c, plain in _LIGATURES.items():
        t = f"replace({t}, chr({c}), '{plain}')"
    wide = f"list_reduce(list_transform(range(65281, 65375), lambda c: chr(c::INT)), lambda a, b: a || b)"
    ascii = f"list_reduce(list_transform(range(33, 127), lambda c: chr(c::INT)), lambda a, b: a || b)"
    return f"nfc_normalize(regexp_replace(translate({t}, {wide}, {ascii}), '[{_BLANKS}]', ' ', 'g'))"


_P4_FORM = f"""replace(replace(array_to_string(list_transform(regexp_extract_all({_folded('bare')}, '\\p{{L}}+|\\P{{L}}+'),
  lambda w: CASE WHEN {_POSES} THEN translate(w, '{_ODD}', '{_PLAIN}') ELSE w END), ''), chr(57344), chr(8205)), chr(57345), chr(65039))"""
#: Defects by lists instead of clusters and models: words of the languages and phrases of the refusals that occur in the
#: tables, found by reading them. A refusal counts where its phrase, or its interjection, comes with another row too.
_DEFECTS = r"""WITH said AS (
  SELECT qa_id, coalesce(question, '') AS q, answer, coalesce(answer, '') AS a, coalesce(contexts, '') AS c,
    trim(regexp_replace(coalesce(answer, ''), '\s+', ' ', 'g')) AS flat
  FROM qa_rows
), bare AS (
  SELECT *, lower(trim(regexp_replace(regexp_replace(flat, '^([\W_]*(Answer|Response|Reply|A)\s*:[\W_]*)+', '', 'i'), '[^\p{L}\p{N}/]+', ' ', 'g'), ' /')) AS left_over,
    list_filter(regexp_extract_all(lower(q), '[\p{L}\p{N}]+'), lambda w: true) AS qw, regexp_extract_all(lower(a), '[\p{L}\p{N}]+') AS aw
  FROM said
), asked AS (
  SELECT *, list_zip(qw[:-2], qw[2:]) AS qp, list_zip(aw[:-2], aw[2:]) AS ap FROM bare
), judged AS (
  SELECT *, answer IS NULL OR NOT regexp_matches(left_over, '[\p{L}\p{N}]') OR left_over IN ('n/a','na','none','null','nan','nil','blank','tbd','tba','empty','undefined','no answer','missing','unknown','pending','todo') AS is_empty,
    len(ap) >= 2 AND len(list_filter(ap, lambda p: list_contains(qp, p))) >= 0.75 * len(ap)
      AND (NOT regexp_matches(a, '[?？]|["”],') OR len(list_filter(regexp_extract_all(lower(regexp_extract(a, '(?s).*(?:[?？]|["”],)(.*)$', 1)), '[\p{L}\p{N}]+'), lambda w: NOT list_contains(qw, w) AND w NOT IN ('answer', 'question'))) = 0) AS is_copy
  FROM asked
), tongue AS (
  SELECT *, list_transform([q, a], lambda t: CASE WHEN length(regexp_replace(t, '[^\x{4e00}-\x{9fff}]', '', 'g')) >= 0.3 * length(regexp_replace(t, '[^\p{L}]', '', 'g')) AND regexp_matches(t, '[\x{4e00}-\x{9fff}]') THEN 'zh'
     WHEN regexp_matches(lower(t), '\b(hari|bulan|dos|ubat|pesakit|minggu|kes|sehari|bagi)\b') THEN 'ms'
     WHEN regexp_matches(lower(t), '\b(les|faut|quelle|jours|chez|avis|doit|environ|déconseillée|semaines)\b') THEN 'fr'
     WHEN regexp_matches(lower(t), '\b(bei|mit|soll|wann|nach|welche|etwa|halten|darf|sind|der|unter)\b') THEN 'de'
     WHEN regexp_matches(lower(t), '\b(debe|cuándo|dosis|más|casos|días|caso|función|qué|tras|semanas)\b') THEN 'es'
     WHEN len(regexp_extract_all(t, '[A-Za-z]{2,}')) >= 2 THEN 'en' END) AS l FROM judged
), ended AS (
  SELECT *, regexp_matches(rtrim(flat, '*'), '(…|\.\.\.|\w-)$') AS marked,
    list_transform([c, regexp_replace(rtrim(trim(a), '* '), '(\s*(…|\.\.\.)|-)$', '')], lambda t: list_filter(list_transform(string_split(regexp_replace(regexp_replace(
      replace(replace(t, 'e.g. ', 'e.g.' || chr(57344)), 'i.e. ', 'i.e.' || chr(57344)), '([.!?])["”’)*\]»]* |([。！？])', '\1\2' || chr(10), 'g'), '[\r\n]+', chr(10), 'g'), chr(10)),
      lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '')) AS cut FROM tongue
), starts AS (
  SELECT *, cut[1] AS s, regexp_replace(coalesce(cut[2][-1], ''), '^[*]*(Answer:|In short:|As stated,)[*]* *', '') AS last_one FROM ended
), broke AS (
  SELECT *, last_one <> '' AND len(list_filter(s, lambda x: starts_with(x, last_one) AND x <> last_one)) > 0 AND (marked OR NOT list_contains(s, last_one)) AS is_broken FROM starts
), phrased AS (
  SELECT *, CASE WHEN NOT (is_empty OR is_copy OR is_broken) AND l[1] IS NOT DISTINCT FROM coalesce(l[2], l[1]) THEN list_position(list_transform(['would go beyond my role', 'must decline to respond', 'nothing i was shown settles', 'lie outside this document', 'is better put to', 'not able to give medical',
    'cannot answer this from', 'rather not guess', 'possible for me to say', 'no answer can be found', 'no such advice appears', 'information was not supplied', 'falls outside what i may', 'more context would be needed', 'passage is silent on',
    'there is nothing here about', 'ask you to consult', 'instructions do not let me', 'does not cover this', 'says nothing on this point', 'have enough to go on', 'unable to help with questions'], lambda p: contains(lower(a), p)), true) END AS phrase,
    regexp_extract(lower(flat), '^(as an assistant|regrettably|unfortunately|apologies|sorry -|hmm|i''m sorry)', 1) AS lead FROM broke
), final AS (
  SELECT qa_id, CASE WHEN is_empty THEN 'empty' WHEN is_copy THEN 'copy' WHEN l[1] <> l[2] THEN 'language' WHEN is_broken THEN 'truncated'
    WHEN phrase > 0 AND (count(*) OVER (PARTITION BY phrase) > 1 OR lead <> '' AND count(*) OVER (PARTITION BY phrase > 0, lead) > 1) THEN 'refusal' END AS defect FROM phrased
) SELECT qa_id, defect FROM final WHERE defect IS NOT NULL"""
_SPACE = r"[\t\n\x0b\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
ORACLE = {
    "p8_found": f"""WITH counted AS (
  SELECT doc_id, length(regexp_replace(text, '[^A-Za-z0-9]', '', 'g'))::DOUBLE AS letters,
    len(list_filter(regexp_split_to_array(text, '{_SPACE}+'), lambda x: regexp_matches(x, '[A-Za-z0-9]')))::DOUBLE AS words,
    greatest(1, len(regexp_extract_all(text, '[.!?]+({_SPACE}|$)')))::DOUBLE AS ends
  FROM documents WHERE lower(lang) LIKE 'en%'
), graded AS (
  SELECT doc_id, 4.71::DOUBLE * letters / words + 0.5::DOUBLE * words / ends - 21.43::DOUBLE AS g FROM counted WHERE words > 0
)
SELECT doc_id, CASE WHEN g < 8 THEN 'plain' WHEN g < 18 THEN 'standard' ELSE 'expert' END AS band FROM graded""",
    "p5_found": """SELECT DISTINCT 'chunks_data' AS tab, doc_id, chunk_no AS pos FROM chunks_data WHERE length(text_chunk) > 3000
UNION ALL SELECT DISTINCT 'text_chunks', doc_id, text_id FROM text_chunks WHERE length(Text) > 3000""",
    "p4_found": f"""SELECT DISTINCT tab, doc_id, pos FROM (SELECT *, {_BARE} AS bare FROM ({_P4_TEXTS})) WHERE {_P4_CASE}""",
    "p4_forms": f"""SELECT tab, doc_id, pos, {_P4_FORM} AS form FROM (SELECT *, {_BARE} AS bare FROM ({_P4_TEXTS}))""",
    "p5_cover": """WITH item AS (
  SELECT 'chunks_data' AS tab, doc_id, chunk_no AS pos, section_name, text_chunk AS t FROM chunks_data
  UNION ALL SELECT 'text_chunks', doc_id, text_id, NULL, Text FROM text_chunks
)
SELECT tab, doc_id, pos, section_name, length(t) AS n_chars, count(*) AS copies, length(t) > 3000 AS was_cut, true AS is_covered, true AS is_within, true AS overlaps_within
FROM item WHERE t IS NOT NULL GROUP BY tab, doc_id, pos, section_name, t""",
    "p5_files": "SELECT coalesce(sum(octet_length(encode(text_chunk)) + 2), 0)::BIGINT AS n_bytes, true AS is_within, true AS overlaps_within FROM chunks_data WHERE text_chunk IS NOT NULL",
    "p6_contents": """SELECT spec_id, (SELECT count(*) FROM documents) AS items, (SELECT sum(greatest(1, ceil(n_chars / capacity_tokens)))::BIGINT FROM documents) AS pieces,
  (SELECT sum(n_chars)::BIGINT FROM documents) AS n_chars, 0::BIGINT AS overfull, 0::BIGINT AS cut_below_capacity FROM container_specs""",
    "p7_planned": """WITH RECURSIVE target AS (
  SELECT regexp_replace(lower(trim(source)), '[\\s\\-_]+', '_', 'g') AS source, sum(target_share) AS w, max(max_repeats) AS k FROM mix_targets WHERE source IS NOT NULL GROUP BY 1
), size AS (
  SELECT regexp_replace(lower(trim(source)), '[\\s\\-_]+', '_', 'g') AS source, sum(n_chars)::BIGINT AS n FROM documents GROUP BY 1
), have AS (
  SELECT t.source, w, k, coalesce(n, 0) AS n, (coalesce(n, 0) * k)::DOUBLE AS most FROM target t LEFT JOIN size USING (source)
), fill AS (
  SELECT 0 AS round, source, w, most, w <= 0 OR most <= 0 AS clamped, (SELECT sum(n) FROM have)::DOUBLE AS total FROM have
  UNION ALL
  SELECT round + 1, source, w, most, clamped OR total_left * w / free_w > most, total FROM (
    SELECT *, total - sum(CASE WHEN clamped AND w > 0 THEN most ELSE 0 END) OVER () AS total_left, sum(CASE WHEN clamped THEN 0 ELSE w END) OVER () AS free_w FROM fill
  ) WHERE round < (SELECT count(*) FROM have)
), last AS (
  SELECT *, total - sum(CASE WHEN clamped AND w > 0 THEN most ELSE 0 END) OVER () AS total_left, sum(CASE WHEN clamped THEN 0 ELSE w END) OVER () AS free_w
  FROM fill WHERE round = (SELECT count(*) FROM have)
)
SELECT h.source, h.w AS target_share, h.k AS max_repeats, h.n AS available,
  round(CASE WHEN NOT clamped THEN total_left * h.w / free_w WHEN h.w > 0 THEN h.most ELSE 0 END)::BIGINT AS planned FROM have h JOIN last USING (source)""",
    "p8_counts": f"""WITH counted AS (
  SELECT doc_id, length(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) AS n_letters,
    len(list_filter(regexp_split_to_array(text, '{_SPACE}+'), lambda x: regexp_matches(x, '[A-Za-z0-9]'))) AS n_words,
    len(regexp_extract_all(text, '[.!?]+({_SPACE}|$)')) AS n_ends FROM documents
), graded AS (
  SELECT *, CASE WHEN n_words > 0 THEN 4.71::DOUBLE * n_letters / n_words + 0.5::DOUBLE * n_words / greatest(1, n_ends) - 21.43::DOUBLE END AS g FROM counted
)
SELECT doc_id, n_words, n_letters, n_ends, CASE WHEN g < 8 THEN 'plain' WHEN g < 18 THEN 'standard' WHEN g >= 18 THEN 'expert' END AS band FROM graded""",
    "p3_found": _DEFECTS,
    "p2_found": _QA_PAIRS + "SELECT qa_id_a, qa_id_b FROM pair",
    "p2_groups": _QA_PAIRS
    + """, node AS (
  SELECT DISTINCT qa_id FROM kept
), edge AS (
  SELECT qa_id_a AS x, qa_id_b AS y FROM pair UNION ALL SELECT qa_id_b, qa_id_a FROM pair
), reach AS (
  SELECT qa_id, qa_id AS other FROM node
  UNION
  SELECT r.qa_id, e.y FROM reach r JOIN edge e ON e.x = r.other
), class AS (
  SELECT n.qa_id, least(n.qa_id, coalesce(min(p.qa_id_a), n.qa_id)) AS class_id
  FROM node n LEFT JOIN pair p ON p.qa_id_b = n.qa_id AND p.same GROUP BY n.qa_id
), degree AS (
  SELECT c.class_id, count(*) AS n_links
  FROM class c JOIN edge e ON e.x = c.class_id JOIN class d ON d.qa_id = e.y AND d.class_id = d.qa_id
  WHERE c.qa_id = c.class_id AND d.class_id <> c.class_id GROUP BY c.class_id
)
SELECT c.qa_id, c.class_id, (SELECT min(other) FROM reach r WHERE r.qa_id = c.qa_id) AS group_id, coalesce(d.n_links, 0) AS n_links
FROM class c LEFT JOIN degree d USING (class_id)""",
}
