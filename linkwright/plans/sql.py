"""SQL of the registered queries, in the dialect of the checking engine; built from shared common table expressions."""

from __future__ import annotations

from unicodedata import combining, normalize

from linkwright.functions.text import LEGAL_SUFFIXES, SCRIPTS, WIDE_SCRIPTS

# Compatibility forms that the tables hold: other width, joined letters, and the final sigma and sharp s of case folding.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)).replace("'", "''")
# Accented Latin letters with the letter each stands on, and the combining marks of the scripts that the tables hold.
_FOLDED = {c: b for c in map(chr, (*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000))) if len(b := "".join(x for x in normalize("NFKD", c) if not combining(x))) == 1 and b != c}
_ACCENTED, _BARE = "".join(_FOLDED), "".join(_FOLDED.values())
_MARKS = "".join(c for c in map(chr, (*range(0x300, 0x370), *range(0x900, 0x980))) if combining(c))
_SPACE = r"[\s\p{Z}\x1c-\x1f\x85]+"
_PAIRS = "source1_entity_id, candidate_entity_id, target_source"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_SPACE}', ' ', 'g'))"


def norm(x: str) -> str:
    wide = f"replace(replace(translate(coalesce({x}, ''), '{_WIDE}', '{_NARROW}'), 'ﬀ', 'ff'), 'ﬃ', 'ffi')"
    return squeeze(f"replace(replace(lower(nfc_normalize({wide})), 'ς', 'σ'), 'ß', 'ss')")


def punct(x: str) -> str:
    return squeeze(f"regexp_replace({x}, '[\\p{{P}}\\p{{S}}]', ' ', 'g')")


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]+')"


def scripts_in(x: str, scripts: list[str]) -> str:
    """The sorted scripts of the letters of a text; wide and joined forms are letters of another script."""
    wide = "[Ａ-Ｚａ-ｚ]"
    names = {s: {"CJK": "Han"}.get(s, s.capitalize()) for s in scripts}
    tests = [f"CASE WHEN regexp_matches(regexp_replace({x}, '{wide}', '', 'g'), '[\\p{{{name}}}]') AND regexp_matches(regexp_replace({x}, '{wide}|[^\\p{{{name}}}]', '', 'g'), '\\p{{L}}') THEN '{s}' END" for s, name in names.items()]
    others = "".join(f"\\p{{{name}}}" for name in names.values())
    tests.append(f"CASE WHEN regexp_matches({x}, '{wide}') OR regexp_matches(regexp_replace({x}, '[{others}]', '', 'g'), '\\p{{L}}') THEN 'OTHER' END")
    return f"list_sort(list_filter([{', '.join(tests)}], lambda s: s IS NOT NULL))"


def signature(x: str) -> str:
    return f"CASE WHEN len({scripts_in(x, SCRIPTS)}) = 0 THEN 'NONE' ELSE array_to_string({scripts_in(x, SCRIPTS)}, '|') END"


def digest(key: str, seed: int = 0) -> str:
    return f"md5({key} || '|{seed}')"


def jaccard(a: str, b: str, empty: str) -> str:
    union = f"len(list_distinct(list_concat({a}, {b})))"
    return f"CASE WHEN {union} = 0 THEN {empty} ELSE len(list_intersect(list_distinct({a}), list_distinct({b}))) * 1.0 / greatest({union}, 1) END"


RECORDS = f"""
raw AS (
  SELECT 'source1' AS src, * FROM train_source1 UNION ALL SELECT 'source2', * FROM train_source2 UNION ALL SELECT 'source3', * FROM train_source3
), recs AS (
  SELECT src, entity_id, min(coalesce(business_name, '')) AS business_name, min(coalesce(business_address, '')) AS business_address,
         min(trim(coalesce(country, ''))) AS country
  FROM raw GROUP BY src, entity_id
), v1 AS (
  SELECT *, {norm("business_name")} AS name_norm, {norm("business_address")} AS address_norm FROM recs
), v2 AS (
  SELECT *, {punct("name_norm")} AS name_punct, {punct("address_norm")} AS address_punct,
         regexp_extract_all(address_norm, '\\p{{Nd}}+') AS numbers FROM v1
), v AS (
  SELECT *, array_to_string(numbers, '|') AS address_numbers,
         coalesce(list_filter(numbers, lambda x: length(x) BETWEEN 5 AND 6)[-1], '') AS postal_token,
         regexp_replace(array_to_string({tokens("name_punct")}, ' '), '(?:(?:^| )(?:{"|".join(LEGAL_SUFFIXES)}))+$', '') AS name_core,
         CASE WHEN lower(country) = '' THEN 'empty' ELSE lower(country) END AS block
  FROM v2
), truth AS (
  SELECT DISTINCT trim(source1_entity_id, ' ' || chr(9) || chr(10)) AS source1_entity_id, unnest(regexp_extract_all(matched_entity_ids, 'S[23]-\\d+')) AS candidate_entity_id
  FROM train_matches WHERE matched_entity_ids IS NOT NULL
), entities AS (
  SELECT DISTINCT trim(source1_entity_id, ' ' || chr(9) || chr(10)) AS source1_entity_id FROM train_matches
)"""


def exact(view: str, signal: str, most: int) -> str:
    return f"""
SELECT l.entity_id AS source1_entity_id, r.entity_id AS candidate_entity_id, r.src AS target_source, CAST(1.0 AS DOUBLE) AS {signal}
FROM (SELECT *, count(*) OVER (PARTITION BY block, {view}) AS n FROM v WHERE src = 'source1' AND {view} <> '') l
JOIN (SELECT *, count(*) OVER (PARTITION BY block, src, {view}) AS n FROM v WHERE src <> 'source1' AND {view} <> '') r
  ON l.block = r.block AND l.{view} = r.{view}
WHERE l.n <= {most} AND r.n <= {most}"""


def _words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def token_document(name: str, address: str) -> str:
    of_name = f"list_transform(list_filter({_words(name)}, lambda w: length(w) >= 2), lambda w: 'n:' || w)"
    of_address = f"list_transform(list_filter({_words(address)}, lambda w: length(w) >= 4 AND NOT regexp_full_match(w, '\\p{{N}}+')), lambda w: 'a:' || w)"
    digits = f"list_transform(list_filter(regexp_extract_all({address}, '\\p{{Nd}}+'), lambda n: length(n) >= 2), lambda n: 'd:' || n)"
    return f"list_distinct(list_concat(list_concat({of_name}, {of_address}), {digits}))"


def char_document(x: str, low: int, high: int) -> str:
    padded = f"list_transform({_words(x)}, lambda w: ' ' || w || ' ')"
    sizes = ", ".join(
        f"flatten(list_transform({padded}, lambda w: CASE WHEN length(w) >= {n} THEN list_transform(range(1, length(w) - {n} + 2), lambda i: substring(w, i, {n})) ELSE [] END))"
        for n in range(low, high + 1)
    )
    return f"flatten([{sizes}])"


def tfidf(document: str, signal: str, top_k: int, least: float, most_df: int, count_empty: bool = True, always: bool = True) -> str:
    """Common table expressions that end in ``{signal}_lane``."""
    p = signal
    corpus = "" if count_empty else " WHERE n_terms > 0"
    keep = f"df <= {most_df}" if always else f"(n <= {most_df} OR df <= {most_df})"
    return f"""
{p}_doc AS (SELECT src, block, entity_id, {document} AS terms FROM v),
{p}_len AS (SELECT *, len(terms) AS n_terms FROM {p}_doc),
{p}_n AS (SELECT block, src, count(*) AS n FROM {p}_len{corpus} GROUP BY block, src),
{p}_post AS (SELECT src, block, entity_id, term, count(*) AS tf FROM (SELECT src, block, entity_id, unnest(terms) AS term FROM {p}_len) GROUP BY ALL),
{p}_voc AS (
  SELECT block, src, term, ln((1 + n) * 1.0 / (1 + df)) + 1 AS idf
  FROM (SELECT block, src, term, count(*) AS df FROM {p}_post WHERE src <> 'source1' GROUP BY ALL) JOIN {p}_n USING (block, src) WHERE {keep}
),
{p}_q AS (SELECT p.entity_id, o.block, o.src, o.term, (1 + ln(tf)) * idf AS w FROM {p}_post p JOIN {p}_voc o ON p.block = o.block AND p.term = o.term WHERE p.src = 'source1'),
{p}_t AS (SELECT p.entity_id, o.block, o.src, o.term, (1 + ln(tf)) * idf AS w FROM {p}_post p JOIN {p}_voc o ON p.block = o.block AND p.src = o.src AND p.term = o.term),
{p}_qn AS (SELECT entity_id, block, src, sqrt(sum(w * w)) AS n FROM {p}_q GROUP BY ALL),
{p}_tn AS (SELECT entity_id, block, src, sqrt(sum(w * w)) AS n FROM {p}_t GROUP BY ALL),
{p}_sim AS (
  SELECT d.source1_entity_id, d.candidate_entity_id, d.src AS target_source, round(dot / (qn.n * tn.n), 6) AS {signal}
  FROM (SELECT q.entity_id AS source1_entity_id, t.entity_id AS candidate_entity_id, q.block, q.src, sum(q.w * t.w) AS dot
        FROM {p}_q q JOIN {p}_t t USING (block, src, term) GROUP BY ALL) d
  JOIN {p}_qn qn ON qn.entity_id = d.source1_entity_id AND qn.block = d.block AND qn.src = d.src
  JOIN {p}_tn tn ON tn.entity_id = d.candidate_entity_id AND tn.block = d.block AND tn.src = d.src
),
{p}_lane AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY source1_entity_id, target_source ORDER BY {signal} DESC, candidate_entity_id) AS place
    FROM {p}_sim WHERE {signal} >= {least}) WHERE place <= {top_k}
)"""


TOKEN = tfidf(token_document("name_punct", "address_punct"), "token_tfidf", 12, 0.01, 5000)
ADDRESS = tfidf(token_document("''", "address_punct"), "address_tfidf", 20, 0.01, 20000)
CHAR = tfidf(char_document("name_punct", 3, 5), "name_tfidf", 12, 0.18, 5000, count_empty=False, always=False)
BUCKETS = 4_194_304
HASHED = tfidf(f"list_transform({token_document('name_punct', 'address_punct')}, lambda t: CAST(CAST('0x' || substring(md5(t), 1, 12) AS BIGINT) % {BUCKETS} AS VARCHAR))", "token_tfidf", 12, 0.01, 5000)
MOST_EXACT, MOST = 40, 40
_SIGNALS = ["name_tfidf", "address_tfidf", "token_tfidf", "dense_score", "exact_name", "exact_address", "exact_name_core", "exact_numbers"]
_VIEWS = {"name_norm": "exact_name", "address_punct": "exact_address", "name_core": "exact_name_core", "address_numbers": "exact_numbers"}


def _lane(select: str, own: str) -> str:
    columns = ", ".join(s if s == own else f"CAST(0 AS DOUBLE) AS {s}" for s in _SIGNALS)
    return f"SELECT {_PAIRS}, {columns} FROM ({select})"


MERGED = f"""
lanes AS ({" UNION ALL ".join([_lane(exact(view, s, MOST_EXACT), s) for view, s in _VIEWS.items()] + [_lane("SELECT * FROM token_tfidf_lane", "token_tfidf")])}),
merged AS (
  SELECT *, greatest(name_tfidf, address_tfidf, token_tfidf, dense_score) + 0.35 * greatest(exact_name, exact_address, exact_name_core, exact_numbers) AS retrieval_score
  FROM (SELECT {_PAIRS}, {", ".join(f"max({s}) AS {s}" for s in _SIGNALS)} FROM lanes GROUP BY ALL)
),
per_target AS (
  SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id, target_source ORDER BY retrieval_score DESC, candidate_entity_id) AS place FROM merged) WHERE place <= {MOST}
),
capped AS (
  SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY retrieval_score DESC, candidate_entity_id) AS place FROM per_target) WHERE place <= {MOST}
)"""
RANKED = """
ranked AS (
  SELECT *, 1 - (row_number() OVER (PARTITION BY source1_entity_id, target_source ORDER BY retrieval_score DESC, candidate_entity_id) - 1)
    * 1.0 / greatest(count(*) OVER (PARTITION BY source1_entity_id, target_source) - 1, 1) AS retrieval_rank_score FROM capped
)"""
LABELLED = """
labelled AS (SELECT r.*, CASE WHEN t.candidate_entity_id IS NULL THEN 0 ELSE 1 END AS label FROM ranked r LEFT JOIN truth t USING (source1_entity_id, candidate_entity_id))"""
_F = "CASE WHEN predicted = 0 AND actual = 0 THEN 1.0 WHEN hits = 0 THEN 0.0 ELSE 1.25 * (hits * 1.0 / predicted) * (hits * 1.0 / actual) / (0.25 * hits / predicted + hits * 1.0 / actual) END"
GUESSED = "guessed AS (SELECT source1_entity_id, candidate_entity_id, retrieval_score AS score FROM capped WHERE retrieval_score >= 0.6)"
ENTITY_SCORES = f"""
counts AS (
  SELECT source1_entity_id, sum(p) AS predicted, sum(t) AS actual, sum(p * t) AS hits FROM (
    SELECT coalesce(g.source1_entity_id, t.source1_entity_id) AS source1_entity_id,
      CASE WHEN g.source1_entity_id IS NULL THEN 0 ELSE 1 END AS p, CASE WHEN t.source1_entity_id IS NULL THEN 0 ELSE 1 END AS t
    FROM guessed g FULL JOIN truth t ON g.source1_entity_id = t.source1_entity_id AND g.candidate_entity_id = t.candidate_entity_id) GROUP BY 1
),
entity_scores AS (
  SELECT source1_entity_id, predicted, actual, hits, {_F} AS score FROM (
    SELECT e.source1_entity_id, coalesce(predicted, 0) AS predicted, coalesce(actual, 0) AS actual, coalesce(hits, 0) AS hits FROM entities e LEFT JOIN counts USING (source1_entity_id))
)"""
CURVE = f"""
grid AS (SELECT 0.2 + 0.78 * i / 39 AS threshold FROM range(40) r(i)),
known AS (SELECT c.source1_entity_id, c.retrieval_score AS score, CASE WHEN t.candidate_entity_id IS NULL THEN 0 ELSE 1 END AS t
          FROM capped c LEFT JOIN truth t USING (source1_entity_id, candidate_entity_id) WHERE c.source1_entity_id IN (SELECT source1_entity_id FROM entities)),
reached AS (SELECT source1_entity_id, threshold, count(*) AS predicted, sum(t) AS hits FROM known JOIN grid ON score >= threshold GROUP BY ALL),
curve AS (
  SELECT round(threshold, 6) AS threshold, round(avg({_F}), 6) AS macro_score, CAST(sum(predicted) AS BIGINT) AS predicted_links FROM (
    SELECT e.source1_entity_id, g.threshold, coalesce(r.predicted, 0) AS predicted, coalesce(r.hits, 0) AS hits, coalesce(a.actual, 0) AS actual
    FROM entities e CROSS JOIN grid g LEFT JOIN reached r ON r.source1_entity_id = e.source1_entity_id AND r.threshold = g.threshold
    LEFT JOIN (SELECT source1_entity_id, count(*) AS actual FROM truth GROUP BY 1) a ON a.source1_entity_id = e.source1_entity_id) GROUP BY threshold
)"""
RULES = """
listed AS (SELECT trim(source1_entity_id, ' ' || chr(9) || chr(10)) AS entity, matched_entity_ids FROM train_matches),
ids AS (SELECT entity, unnest(list_filter(string_split(coalesce(matched_entity_ids, ''), ','), lambda x: x <> '')) AS id FROM listed),
wanted AS (SELECT entity_id AS entity FROM train_source1),
offences AS (
  SELECT DISTINCT * FROM (
    SELECT 'duplicate_entity' AS category, entity AS example FROM listed GROUP BY entity HAVING count(*) > 1
    UNION ALL SELECT 'duplicate_in_list', entity || ':' || id FROM ids GROUP BY entity, id HAVING count(*) > 1
    UNION ALL SELECT 'self_match', entity || ':' || id FROM ids WHERE id LIKE 'S1-%'
    UNION ALL SELECT 'bad_prefix', entity || ':' || id FROM ids WHERE NOT regexp_matches(id, '^S[123]-')
    UNION ALL SELECT 'missing_entity', entity FROM wanted WHERE entity NOT IN (SELECT entity FROM listed)
    UNION ALL SELECT 'unexpected_entity', entity FROM listed WHERE entity NOT IN (SELECT entity FROM wanted)
  )
)"""


def with_(select: str, *parts: str) -> str:
    return f"WITH {', '.join([RECORDS, *parts])} {select}"


def _record(*columns: str) -> str:
    return with_(f"SELECT src, entity_id, {', '.join(columns)} FROM v")


def oracle_sql() -> dict[str, str]:
    linked = "FROM truth t JOIN v a ON a.src = 'source1' AND a.entity_id = t.source1_entity_id JOIN v b ON b.src <> 'source1' AND b.entity_id = t.candidate_entity_id"
    keys = "t.source1_entity_id, t.candidate_entity_id"
    both = "FROM ranked p JOIN v a ON a.src = 'source1' AND a.entity_id = p.source1_entity_id JOIN v b ON b.src <> 'source1' AND b.entity_id = p.candidate_entity_id"
    words = {s: (tokens(f"{s}.name_punct"), tokens(f"{s}.address_punct")) for s in ("a", "b")}

    def ratio(x: str, digits: int = 6) -> str:
        most = f"greatest(length(a.{x}), length(b.{x}))"
        return f"round(CASE WHEN {most} = 0 THEN 1.0 ELSE least(length(a.{x}), length(b.{x})) * 1.0 / greatest({most}, 1) END, {digits})"

    out = {
        "packed_addresses": """SELECT substring(entity_id, 1, 11) AS pack, CAST(row_number() OVER (PARTITION BY substring(entity_id, 1, 11) ORDER BY entity_id, business_address) AS INTEGER) AS value_pos, business_address AS matched_value
FROM (SELECT DISTINCT entity_id, business_address FROM train_source2 WHERE regexp_full_match(business_address, '[A-Za-z0-9][A-Za-z0-9 ,./#-]*[A-Za-z0-9]') AND regexp_matches(business_address, '[0-9]'))""",
        "normalize_basic": _record("name_norm", "address_norm"),
        "normalize_punct": _record("name_punct", "address_punct"),
        "tokenize": _record(f"array_to_string({tokens('name_punct')}, ' ') AS name_tokens"),
        "name_core": _record("name_core"),
        "number_signature": _record("address_numbers"),
        "postal_token": _record("postal_token"),
        "token_document": _record(f"array_to_string(list_sort({token_document('name_punct', 'address_punct')}), ' ') AS document"),
        "char_ngrams": _record(f"array_to_string(list_sort({char_document('name_punct', 3, 5)}), '~') AS grams"),
        "fold_accents": _record(f"regexp_replace(translate(name_norm, '{_ACCENTED}', '{_BARE}'), '[{_MARKS}]', '', 'g') AS name_ascii"),
        "script_signature": _record(f"{signature('business_name')} AS name_script", f"{signature('business_address')} AS address_script", f"len(list_filter({scripts_in('business_name', SCRIPTS)}, lambda s: s <> 'LATIN')) > 0 AS has_non_latin_name"),
        "script_counts": with_(f"SELECT script, count(*) AS rows FROM (SELECT unnest({scripts_in('business_name', WIDE_SCRIPTS)}) AS script FROM v) GROUP BY 1"),
        "embedding_text": _record("'query: business name: ' || name_norm || ' | address: ' || address_norm || ' | country: ' || block AS text"),
        "unicode_strips": _record("nfc_normalize(business_name) AS nfc", "regexp_replace(business_name, '\\p{P}', '', 'g') AS no_punctuation", "regexp_replace(business_name, '\\p{M}', '', 'g') AS no_marks"),
        "group_split": with_(f"SELECT source1_entity_id, CASE WHEN p < 0.1 THEN 'holdout' WHEN p < 0.2 THEN 'validation' ELSE 'train' END AS split FROM (SELECT *, CAST('0x' || substring({digest('source1_entity_id')}, 1, 13) AS BIGINT) / 4503599627370496.0 AS p FROM entities)"),
        "sampled_queries": with_(f"SELECT entity_id, block AS country FROM (SELECT *, row_number() OVER (PARTITION BY block ORDER BY {digest('entity_id')}, entity_id) AS place FROM v WHERE src = 'source1') WHERE place <= 50"),
        "token_hash_topk": with_("SELECT * FROM token_tfidf_lane", HASHED),
        "country_slug": _record("block AS country_slug"),
        "token_jaccard": with_(f"SELECT {keys}, round({jaccard(words['a'][0], words['b'][0], '1.0')}, 6) AS name_jaccard {linked}"),
        "number_jaccard": with_(f"SELECT {keys}, round({jaccard('a.numbers', 'b.numbers', '0.0')}, 6) AS number_jaccard {linked}"),
        "length_ratio": with_(f"SELECT {keys}, {ratio('name_punct')} AS name_length_ratio, {ratio('address_punct')} AS address_length_ratio {linked}"),
        "frequency_cap_skew": with_(
            "SELECT src, block AS country, count(*) AS keys, CAST(sum(CASE WHEN n > 5 THEN 1 ELSE 0 END) AS BIGINT) AS capped_keys, max(n) AS largest FROM (SELECT src, block, name_norm, count(*) AS n FROM v WHERE name_norm <> '' GROUP BY ALL) GROUP BY src, block"
        ),
        "document_frequency": with_(
            f"SELECT block AS country, src AS target_source, term, count(*) AS df FROM (SELECT src, block, unnest({token_document('name_punct', 'address_punct')}) AS term FROM v WHERE src <> 'source1') GROUP BY ALL"
        ),
        "token_tfidf_topk": with_("SELECT * FROM token_tfidf_lane", TOKEN),
        "address_tfidf_topk": with_("SELECT * FROM address_tfidf_lane", ADDRESS),
        "char_tfidf_topk": with_("SELECT * FROM name_tfidf_lane", CHAR),
        "merge_lanes": with_(f"SELECT {_PAIRS}, {', '.join(_SIGNALS)}, round(retrieval_score, 6) AS retrieval_score FROM merged", TOKEN, MERGED),
        "candidate_cap": with_(f"SELECT {_PAIRS}, round(retrieval_score, 6) AS retrieval_score FROM capped", TOKEN, MERGED),
        "candidate_recall": with_(
            """SELECT CAST(total_links AS BIGINT) AS total_links, CAST(recovered_links AS BIGINT) AS recovered_links, round(recovered_links * 1.0 / total_links, 6) AS pair_recall,
  round(complete * 1.0 / entities, 6) AS entity_recall, candidate_pairs, round(mean_candidates, 6) AS mean_candidates
FROM (SELECT sum(links) AS total_links, sum(hits) AS recovered_links, count(*) AS entities, sum(CASE WHEN links = hits THEN 1 ELSE 0 END) AS complete FROM (
  SELECT source1_entity_id, count(*) AS links, count(c.candidate_entity_id) AS hits FROM truth t LEFT JOIN capped c USING (source1_entity_id, candidate_entity_id) GROUP BY 1)),
 (SELECT CAST(sum(n) AS BIGINT) AS candidate_pairs, avg(n) AS mean_candidates FROM (SELECT count(*) AS n FROM capped GROUP BY source1_entity_id))""",
            TOKEN,
            MERGED,
        ),
        "retrieval_rank": with_(f"SELECT {_PAIRS}, round(retrieval_rank_score, 6) AS retrieval_rank_score FROM ranked", TOKEN, MERGED, RANKED),
        "exact_features": with_(
            f"""SELECT p.source1_entity_id, p.candidate_entity_id, p.target_source,
  round({jaccard(words["a"][0], words["b"][0], "1.0")}, 4) AS name_jaccard, round({jaccard(words["a"][1], words["b"][1], "1.0")}, 4) AS address_jaccard,
  round({jaccard("a.numbers", "b.numbers", "0.0")}, 4) AS number_jaccard,
  CASE WHEN a.postal_token <> '' AND a.postal_token = b.postal_token THEN 1.0 ELSE 0.0 END AS postal_exact,
  CASE WHEN a.name_norm = b.name_norm THEN 1.0 ELSE 0.0 END AS name_exact_normalized,
  CASE WHEN a.name_core <> '' AND a.name_core = b.name_core THEN 1.0 ELSE 0.0 END AS name_core_exact,
  CASE WHEN a.address_norm <> '' AND a.address_norm = b.address_norm THEN 1.0 ELSE 0.0 END AS address_exact_normalized,
  CASE WHEN a.country = b.country THEN 1.0 ELSE 0.0 END AS country_equal,
  CASE WHEN a.address_norm = '' THEN 1.0 ELSE 0.0 END AS query_address_missing, CASE WHEN b.address_norm = '' THEN 1.0 ELSE 0.0 END AS candidate_address_missing,
  {ratio("name_punct", 4)} AS name_length_ratio, {ratio("address_punct", 4)} AS address_length_ratio,
  CASE WHEN p.target_source = 'source3' THEN 1.0 ELSE 0.0 END AS target_is_source3,
  CASE WHEN name_tfidf > 0 THEN 1.0 ELSE 0.0 END AS name_retrieval_lane, CASE WHEN address_tfidf > 0 THEN 1.0 ELSE 0.0 END AS address_retrieval_lane,
  CASE WHEN token_tfidf > 0 THEN 1.0 ELSE 0.0 END AS token_retrieval_lane, CASE WHEN dense_score > 0 THEN 1.0 ELSE 0.0 END AS dense_retrieval_lane,
  round(retrieval_rank_score, 4) AS retrieval_rank_score, dense_score, exact_name, exact_address, exact_name_core, exact_numbers,
  CASE WHEN {signature("a.business_name")} = {signature("b.business_name")} THEN 1.0 ELSE 0.0 END AS name_script_equal,
  CASE WHEN {signature("a.business_name")} <> {signature("b.business_name")} AND 'NONE' NOT IN ({signature("a.business_name")}, {signature("b.business_name")}) THEN 1.0 ELSE 0.0 END AS cross_script_name {both}""",
            TOKEN,
            MERGED,
            RANKED,
        ),
        "label_pairs": with_(f"SELECT {_PAIRS}, label FROM labelled", TOKEN, MERGED, RANKED, LABELLED),
        "hard_negatives": with_(
            f"SELECT {_PAIRS}, label FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id, label ORDER BY retrieval_rank_score DESC, target_source, candidate_entity_id) AS place FROM labelled) WHERE label = 1 OR place <= 12",
            TOKEN,
            MERGED,
            RANKED,
            LABELLED,
        ),
        "entity_fbeta": with_(
            "SELECT source1_entity_id, CAST(predicted AS BIGINT) AS predicted, CAST(actual AS BIGINT) AS actual, CAST(hits AS BIGINT) AS hits, round(score, 6) AS score FROM entity_scores", TOKEN, MERGED, GUESSED, ENTITY_SCORES
        ),
        "macro_fbeta": with_("SELECT round(avg(score), 6) AS macro_score, count(*) AS entities FROM entity_scores", TOKEN, MERGED, GUESSED, ENTITY_SCORES),
        "threshold_curve": with_("SELECT * FROM curve", TOKEN, MERGED, CURVE),
        "best_threshold": with_("SELECT * FROM curve ORDER BY macro_score DESC, threshold DESC LIMIT 1", TOKEN, MERGED, CURVE),
        "group_ids": with_(
            "SELECT e.entity_id AS source1_entity_id, coalesce(string_agg(DISTINCT g.candidate_entity_id, ',' ORDER BY g.candidate_entity_id), '') AS matched_entity_ids FROM (SELECT entity_id FROM v WHERE src = 'source1') e LEFT JOIN guessed g ON g.source1_entity_id = e.entity_id GROUP BY 1",
            TOKEN,
            MERGED,
            GUESSED,
        ),
        "subset_violations": with_("SELECT source1_entity_id, candidate_entity_id FROM truth EXCEPT SELECT source1_entity_id, candidate_entity_id FROM capped", TOKEN, MERGED),
        "validator_report": with_(
            "SELECT o.category, o.offenders, e.examples FROM (SELECT category, count(*) AS offenders FROM offences GROUP BY 1) o JOIN (SELECT category, string_agg(example, ';' ORDER BY example) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY example) AS place FROM offences) WHERE place <= 5 GROUP BY 1) e USING (category)",
            RULES,
        ),
        "truth_explode": with_("SELECT source1_entity_id, candidate_entity_id FROM truth"),
        "match_histogram": with_(
            "SELECT CASE WHEN n >= 10 THEN '10+' ELSE CAST(n AS VARCHAR) END AS matches, count(*) AS entities FROM (SELECT e.source1_entity_id, count(t.candidate_entity_id) AS n FROM entities e LEFT JOIN truth t USING (source1_entity_id) GROUP BY 1) GROUP BY 1"
        ),
        "match_sources": with_("SELECT substring(candidate_entity_id, 1, 2) AS source, count(*) AS links FROM truth GROUP BY 1"),
        "singleton_share": with_(
            "SELECT count(*) AS entities, CAST(sum(CASE WHEN n = 0 THEN 1 ELSE 0 END) AS BIGINT) AS singletons, round(avg(CASE WHEN n = 0 THEN 1.0 ELSE 0.0 END), 6) AS share FROM (SELECT e.source1_entity_id, count(t.candidate_entity_id) AS n FROM entities e LEFT JOIN truth t USING (source1_entity_id) GROUP BY 1)"
        ),
        "missing_profile": "WITH r AS (SELECT * FROM train_source1 UNION ALL SELECT * FROM train_source2 UNION ALL SELECT * FROM train_source3) "
        + " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) AS rows, CAST(sum(CASE WHEN trim(coalesce({c}, '')) = '' THEN 1 ELSE 0 END) AS BIGINT) AS missing FROM r" for c in ("entity_id", "business_name", "business_address", "country")),
        "country_profile": with_("SELECT src, country, rows, round(rows * 1.0 / sum(rows) OVER (PARTITION BY src), 6) AS share FROM (SELECT src, country, count(*) AS rows FROM v GROUP BY ALL)"),
        "country_pivot": with_("SELECT src, " + ", ".join(f"CAST(sum(CASE WHEN country = '{c}' THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c in ("France", "India", "US")) + " FROM v GROUP BY src"),
        "preprocess_counters": with_("SELECT country, count(*) AS rows, CAST(sum(CASE WHEN trim(business_address) = '' THEN 1 ELSE 0 END) AS BIGINT) AS empty_addresses FROM v GROUP BY country"),
        "duplicate_ids": "SELECT entity_id, count(*) AS rows FROM (SELECT * FROM train_source2 UNION ALL SELECT * FROM train_source3) GROUP BY 1 HAVING count(*) > 1",
        "stage_summary": with_(
            "SELECT a.country, count(*) AS scored, CAST(sum(CASE WHEN retrieval_score >= 0.6 THEN 1 ELSE 0 END) AS BIGINT) AS selected, round(min(retrieval_score), 6) AS least, round(max(retrieval_score), 6) AS most FROM capped c JOIN v a ON a.src = 'source1' AND a.entity_id = c.source1_entity_id GROUP BY 1",
            TOKEN,
            MERGED,
        ),
        "dense_topk": "SELECT query_id, target_id, similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, target_id) AS place FROM (SELECT q.vec_id AS query_id, t.vec_id AS target_id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[])), 5) AS similarity FROM embeddings q, embeddings t WHERE q.vec_id % 20 = 0)) WHERE place <= 10",
        "deliveries_per_day": "SELECT date_trunc('day', delivered_at) AS window_start, coalesce(feed_code, 'unknown') AS feed_code, count(*) AS deliveries FROM source_deliveries GROUP BY ALL",
        "first_deliveries": "SELECT DISTINCT entity_id, recorded_at FROM source_deliveries WHERE recorded_at IS NOT NULL",
        "deliveries_per_window": "SELECT date_trunc('day', delivered_at) AS window_start, coalesce(feed_code, 'unknown') AS feed_code, count(*) AS deliveries, round(avg(epoch(date_trunc('second', delivered_at)) - epoch(date_trunc('second', recorded_at))), 6) AS mean_delay_seconds FROM source_deliveries GROUP BY ALL",
        "unique_deliveries": "SELECT entity_id, recorded_at, min(delivered_at) AS first_delivered_at FROM source_deliveries WHERE recorded_at IS NOT NULL GROUP BY ALL",
    }
    for view, signal in _VIEWS.items():
        out[f"exact_block_{signal.removeprefix('exact_')}"] = with_(f"SELECT * FROM ({exact(view, signal, MOST_EXACT)})")
    return out
