"""DuckDB SQL for every registered query (the correctness oracle).

The SQL is written against the plain tables (``documents``, ``events`` ...)
and restates each operator in DuckDB's dialect: list lambdas for the
annotator, RE2 regular expressions for the sequence operators, ordinary
GROUP BY / JOIN for the rest. The lexicon is rendered from the same rule
table (``Lexicon``) the Spark side uses, since it is a parameter, not logic.
"""

from __future__ import annotations

from ..operators.annotate import (CLITIC_PATTERN, NUMBER_PATTERN, NUMBER_TAG, OUTSIDE, PHRASE_LEXICON, TEST_LEXICON,
                                  TOKEN_PATTERN, Lexicon)
from ..functions.text import STRIP_PATTERN
from ..functions.tags import CLASS_LETTERS
from .queries import QUERY_PROFILE, REPORT_MIN_COUNT, TOPK


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(words) -> str:
    return "(" + ", ".join(_q(w) for w in words) + ")"


def tag_sql(lex: Lexicon, t: str = "t") -> str:
    l = f"lower({t})"
    parts = [f"WHEN length({t}) = 1 AND NOT regexp_full_match({t}, '[A-Za-z0-9]') THEN {t}"]
    parts += [f"WHEN {l} IN {_in(words)} THEN {_q(tag)}" for tag, words in lex.words_by_tag()]
    parts.append(f"WHEN regexp_full_match({t}, {_q(NUMBER_PATTERN)}) THEN {_q(NUMBER_TAG)}")
    for suffix, tag in lex.suffix_rules:
        hit = f"ends_with({l}, {_q(suffix)})"
        if tag == lex.noun_tag and lex.proper_tag:
            parts.append(f"WHEN {hit} AND substr({t}, 1, 1) BETWEEN 'A' AND 'Z' THEN {_q(lex.proper_tag)}")
        parts.append(f"WHEN {hit} THEN {_q(tag)}")
    if lex.long_word:
        parts.append(f"WHEN length({l}) > {lex.long_word[0]} THEN {_q(lex.long_word[1])}")
    return "CASE " + " ".join(parts) + f" ELSE {_q(lex.default_tag)} END"


def lemma_sql(lex: Lexicon, t: str, tag: str) -> str:
    parts = [f"WHEN lower({t}) IN {_in(words)} THEN {_q(lemma)}" for lemma, words in lex.words_by_lemma()]
    if lex.proper_tag:
        parts.append(f"WHEN {tag} = {_q(lex.proper_tag)} THEN {t}")
    return "CASE " + " ".join(parts) + f" ELSE lower({t}) END" if parts else f"lower({t})"


def ent_sql(lex: Lexicon, tokens: str = "tokens", i: str = "i") -> str:
    """The first gazetteer with an entry among the token runs that hold token i."""
    parts = []
    for label, by in lex.phrases():
        for n, entries in by.items():
            for back in range(n):
                a = f"{i} - {back}"
                run = f"lower(array_to_string({tokens}[{a}:{a} + {n - 1}], ' '))"
                parts.append(f"WHEN {a} >= 1 AND {a} + {n - 1} <= len({tokens}) AND {run} IN {_in(entries)} THEN {_q(label)}")
    return "CASE " + " ".join(parts) + f" ELSE {_q(OUTSIDE)} END" if parts else _q(OUTSIDE)


def class_sql(g: str, v: str) -> str:
    return (f"CASE WHEN starts_with({g}, 'RB') THEN 'R' WHEN starts_with({g}, 'JJ') THEN 'J' "
            f"WHEN starts_with({g}, 'CC') THEN 'C' WHEN starts_with({g}, 'NN') THEN 'N' "
            f"WHEN starts_with({g}, 'VB') AND {v} = 'be' THEN 'B' WHEN starts_with({g}, 'VB') THEN 'V' "
            f"WHEN starts_with({g}, 'IN') OR starts_with({g}, 'DT') THEN 'D' ELSE 'X' END")


def decode(x: str) -> str:
    return f"regexp_replace(substr({x}, 2), '(^| )[{CLASS_LETTERS}]', '\\1', 'g')"


TOK = "[^ ]*"
ADJ_RE = f"(?: R{TOK})* J{TOK}"


def base_ctes(lex: Lexicon = TEST_LEXICON) -> str:
    """docs -> annotated (lists) -> tagged (encoded strings)."""
    return f"""
docs AS (SELECT doc_id AS id, source AS subreddit, text AS body FROM documents),
tok AS (
  SELECT id, subreddit, body,
         regexp_extract_all(regexp_replace(regexp_replace(body, '{STRIP_PATTERN}', ' ', 'g'),
                                           {_q(CLITIC_PATTERN)}, ' \\1', 'g'), {_q(TOKEN_PATTERN)}, 0) AS tokens
  FROM docs),
tg AS (SELECT *, list_transform(tokens, lambda t: {tag_sql(lex)}) AS tags FROM tok),
ann AS (
  SELECT *, list_transform(tokens, lambda t, i: {lemma_sql(lex, 't', 'tags[i]')}) AS lemmas,
         list_transform(tokens, lambda t, i: {ent_sql(lex)}) AS ents
  FROM tg),
tagged AS (
  SELECT id, subreddit, tags, lemmas AS vals, ents,
         array_to_string(list_transform(tags, lambda g, i: ' ' || {class_sql('g', 'lemmas[i]')} || lemmas[i]), '') AS enc,
         array_to_string(list_transform(ents, lambda e, i: ' ' || CASE WHEN e = 'ORGANIZATION' THEN 'G' ELSE 'O' END || lemmas[i]), '') AS enc_ents
  FROM ann),
direct_runs AS (
  SELECT id, subreddit, run, regexp_extract(run, '^(?:.* [RJC]{TOK})?((?: N{TOK})*)$', 1) AS nouns
  FROM (SELECT id, subreddit, unnest(regexp_extract_all(enc, '((?: [RJCN]{TOK})+) [BVDX]', 1)) AS run FROM tagged)),
direct AS (
  SELECT id, subreddit, TRUE AS is_direct, {decode('nouns')} AS noun,
         unnest(list_transform(regexp_extract_all(run, '{ADJ_RE}', 0), lambda a: {decode('a')})) AS adj
  FROM direct_runs WHERE nouns <> ''),
conn_m AS (
  SELECT id, subreddit, m,
         {decode(f"regexp_extract(m, '^((?: N{TOK})+) B', 1)")} AS noun,
         regexp_extract(m, '^(?: N{TOK})+ B{TOK}((?: [RJC]{TOK})*) {TOK}$', 1) AS middle,
         regexp_extract(m, ' ({TOK})$', 1) AS term
  FROM (SELECT id, subreddit, unnest(regexp_extract_all(enc, '(?: N{TOK})+ B{TOK}(?: [RJC]{TOK})* [^RJC]{TOK}', 0)) AS m
        FROM tagged)),
conn_a AS (
  SELECT id, subreddit, noun, term,
         list_transform(regexp_extract_all(middle, '{ADJ_RE}', 0), lambda a: {decode('a')}) AS adjs
  FROM conn_m),
connected AS (
  SELECT id, subreddit, FALSE AS is_direct, noun,
         unnest(CASE WHEN starts_with(term, 'N')
                     THEN list_append(list_transform(adjs, lambda a: a || ' ' || substr(term, 2)), substr(term, 2))
                     ELSE adjs END) AS adj
  FROM conn_a),
pairs AS (SELECT * FROM connected UNION ALL SELECT * FROM direct),
mentions AS (
  SELECT id, subreddit, unnest(list_transform(regexp_extract_all(enc_ents, '((?: G{TOK})+) O', 1),
                                              lambda r: {decode('r')})) AS org
  FROM tagged),
org_counts AS (
  SELECT lower(org) AS org_lower, subreddit, min(org) AS org, count(*) AS count
  FROM mentions GROUP BY lower(org), subreddit),
adj_counts AS (
  SELECT lower(noun) AS org_lower, subreddit, adj, is_direct, count(*) AS adj_count
  FROM pairs GROUP BY lower(noun), subreddit, adj, is_direct),
joined AS (
  SELECT o.org_lower, o.subreddit, o.org, o.count, a.adj, a.is_direct, a.adj_count
  FROM org_counts o LEFT JOIN adj_counts a ON o.org_lower = a.org_lower AND o.subreddit = a.subreddit),
profile AS (
  SELECT org AS noun, subreddit, CAST(count AS BIGINT) AS numNoun,
         coalesce(string_agg(CASE WHEN is_direct THEN adj || '=' || adj_count END, '|'
                             ORDER BY adj_count DESC, adj ASC), '') AS directAdj,
         coalesce(string_agg(CASE WHEN NOT is_direct THEN adj || '=' || adj_count END, '|'
                             ORDER BY adj_count DESC, adj ASC), '') AS connectedAdj
  FROM joined GROUP BY org_lower, subreddit, org, count),
sentences AS (
  SELECT id, subreddit,
         array_to_string(list_transform(vals, lambda v, i:
            CASE WHEN i = 1 THEN '' WHEN ents[i] = 'ORGANIZATION' AND ents[i - 1] = 'ORGANIZATION' THEN '_' ELSE ' ' END
            || v), '') AS sentence
  FROM tagged WHERE len(regexp_extract_all(enc_ents, '((?: G{TOK})+) O', 1)) > 0),
sentence_tokens AS (
  SELECT id, subreddit,
         CASE WHEN regexp_full_match(lower(sentence), ' +') THEN []::VARCHAR[]
              ELSE string_split(regexp_replace(lower(sentence), ' +$', ''), ' ') END AS text
  FROM sentences),
group_counts AS (SELECT subreddit, count(*) AS commentsNum FROM sentence_tokens GROUP BY subreddit),
big_groups AS (SELECT * FROM group_counts WHERE commentsNum > {QUERY_PROFILE.min_group_comments}),
orgs_rb AS (SELECT subreddit, noun AS org, numNoun AS count FROM profile)
"""


def _with(body: str, lex: Lexicon = TEST_LEXICON) -> str:
    body = body.lstrip()
    if body.startswith(","):
        return "WITH " + base_ctes(lex).strip() + body
    return "WITH " + base_ctes(lex).strip() + "\n" + body


def _java_split_sql(s: str) -> str:
    return (f"CASE WHEN regexp_full_match({s}, ' +') THEN []::VARCHAR[] "
            f"ELSE string_split(regexp_replace({s}, ' +$', ''), ' ') END")


def _jstr(doc: str, path: str) -> str:
    return f"CASE WHEN json_type({doc}, '{path}') = 'VARCHAR' THEN json_extract_string({doc}, '{path}') ELSE '' END"


def _jint(doc: str, path: str) -> str:
    return (f"CASE WHEN json_type({doc}, '{path}') IN ('BIGINT', 'UBIGINT') "
            f"THEN coalesce(TRY_CAST(json_extract_string({doc}, '{path}') AS INTEGER), 0) ELSE 0 END")


def _ann_str(extra: str = "") -> str:
    return ("SELECT id, subreddit, array_to_string(tokens, ' ') AS tokens, array_to_string(lemmas, ' ') AS lemmas, "
            "array_to_string(tags, ' ') AS tags, array_to_string(ents, ' ') AS ents" + extra + " FROM ann")


def oracle() -> dict[str, str]:
    s: dict[str, str] = {}
    # ---- A / B
    s["json_parse"] = "SELECT doc_id AS id, source AS subreddit, text AS body FROM documents"
    s["json_extract_string"] = "SELECT doc_id AS id, text AS body, '' AS id_text, '' AS missing FROM documents"
    s["json_extract_int"] = (f"SELECT event_id, {_jint('props', '$.k')} AS k, "
                             f"{_jint('props', '$.missing')} AS missing FROM events")
    s["body_extract"] = "SELECT doc_id AS id, text AS body FROM documents"
    s["json_error_rows"] = f"""
SELECT source, line_id, CASE WHEN json_valid(line) THEN NULL ELSE 'malformed JSON line' END AS error,
       CASE WHEN json_valid(line) THEN {_jint('line', '$.k')} ELSE 0 END AS k
FROM (SELECT 'events' AS source, event_id AS line_id, props AS line FROM events
      UNION ALL SELECT 'pages', page_id, html FROM pages)"""
    s["text_clean"] = f"SELECT page_id, regexp_replace(html, '{STRIP_PATTERN}', ' ', 'g') AS clean FROM pages"
    s["annotated_merge"] = _with(_ann_str(", 7 AS n_keys").replace("SELECT id, subreddit,", "SELECT id, subreddit,"))
    s["split_tokens"] = (f"SELECT id, len(p) AS n_parts, array_to_string(p, '|') AS parts FROM "
                         f"(SELECT doc_id AS id, {_java_split_sql('text')} AS p FROM documents)")
    s["tag_sequence"] = _with(f"""
SELECT id, subreddit, len(t) AS seq_len, array_to_string(v, '|') AS values, array_to_string(t, '|') AS tags,
       array_to_string(e, '|') AS ents, NULL::VARCHAR AS error
FROM (SELECT id, subreddit, {_java_split_sql("array_to_string(tags, ' ')")} AS t,
             {_java_split_sql("array_to_string(lemmas, ' ')")} AS v,
             {_java_split_sql("array_to_string(ents, ' ')")} AS e FROM ann)""")
    # ---- C
    s["annotate_tokens"] = _with("SELECT id, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM ann")
    s["annotate_tags"] = _with("SELECT id, array_to_string(tags, ' ') AS tags FROM ann")
    s["annotate_lemmas"] = _with("SELECT id, array_to_string(lemmas, ' ') AS lemmas FROM ann")
    s["annotate_ents"] = _with("SELECT id, array_to_string(ents, ' ') AS ents FROM ann")
    s["annotate_full"] = _with(_ann_str())
    s["annotate_phrases"] = _with("SELECT id, array_to_string(ents, ' ') AS ents FROM ann", PHRASE_LEXICON)
    s["annotate_gazetteer"] = _with("""
, low AS (SELECT id, list_transform(tokens, lambda t: lower(t)) AS t FROM tok),
starts AS (SELECT id, t, n, unnest(range(1, len(t) - n + 2)) AS i FROM low, (VALUES (2), (3)) v(n)),
runs AS (SELECT id, n, i, array_to_string(t[i:i + n - 1], ' ') AS g FROM starts),
gazetteer AS (SELECT n, g FROM runs GROUP BY n, g HAVING count(DISTINCT id) > 1),
covered AS (
  SELECT id, p, max(n) AS n FROM (SELECT runs.id, runs.n, unnest(range(i, i + runs.n)) AS p FROM runs JOIN gazetteer USING (n, g))
  GROUP BY id, p),
flat AS (SELECT id, unnest(range(1, len(t) + 1)) AS p FROM low)
SELECT id, coalesce(string_agg(CASE WHEN p IS NOT NULL THEN CASE covered.n WHEN 3 THEN 'PLACE' WHEN 2 THEN 'ORGANIZATION' ELSE 'O' END END,
                               ' ' ORDER BY p), '') AS ents
FROM low LEFT JOIN flat USING (id) LEFT JOIN covered USING (id, p) GROUP BY id""")
    # ---- D
    # D1 by windows, not by the patterns of the operator: tokens one by one, an
    # island for each run between other tokens, its last noun run, its adjectives
    s["direct_pairs"] = _with("""
, flat AS (
  SELECT id, subreddit, p, vals[p] AS v, CASE WHEN starts_with(tags[p], 'RB') THEN 'R' WHEN starts_with(tags[p], 'JJ') THEN 'J'
         WHEN starts_with(tags[p], 'CC') THEN 'C' WHEN starts_with(tags[p], 'NN') THEN 'N' ELSE 'X' END AS c
  FROM (SELECT id, subreddit, tags, vals, unnest(range(1, len(tags) + 1)) AS p FROM tagged)),
isles AS (
  SELECT *, count(*) FILTER (WHERE c = 'X') OVER (PARTITION BY id ORDER BY p ROWS UNBOUNDED PRECEDING) AS isle,
         count(*) FILTER (WHERE c = 'X') OVER (PARTITION BY id) AS n_isles FROM flat),
runs AS (
  SELECT *, max(CASE WHEN c <> 'N' THEN p END) OVER (PARTITION BY id, isle) AS last_other,
         max(CASE WHEN c <> 'R' THEN p END) OVER (PARTITION BY id, isle ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM isles WHERE c <> 'X' AND isle < n_isles),
nouns AS (
  SELECT id, isle, string_agg(v, ' ' ORDER BY p) AS noun FROM runs
  WHERE c = 'N' AND p > coalesce(last_other, 0) GROUP BY id, isle),
adjs AS (
  SELECT a.id, a.subreddit, a.isle, a.p, (SELECT string_agg(r.v, ' ' ORDER BY r.p) FROM runs r
         WHERE r.id = a.id AND r.isle = a.isle AND r.p <= a.p AND r.p > coalesce(a.before, 0)) AS adj
  FROM runs a WHERE a.c = 'J')
SELECT a.id, a.subreddit, TRUE AS is_direct, n.noun, a.adj FROM adjs a JOIN nouns n ON a.id = n.id AND a.isle = n.isle""")
    s["connected_pairs"] = _with("SELECT * FROM connected")
    s["org_mentions"] = _with("SELECT * FROM mentions")
    s["combine_orgs"] = _with("""
SELECT id, subreddit, len(keep) AS n_merged, sentence,
       array_to_string(list_transform(keep, lambda i: tags[i]), ' ') AS tags,
       array_to_string(list_transform(keep, lambda i: ents[i]), ' ') AS ents
FROM (SELECT id, subreddit, tags, ents,
             list_filter(range(1, len(vals) + 1), lambda i:
                NOT (i > 1 AND ents[i] = 'ORGANIZATION' AND ents[i - 1] = 'ORGANIZATION')) AS keep,
             array_to_string(list_transform(vals, lambda v, i:
                CASE WHEN i = 1 THEN '' WHEN ents[i] = 'ORGANIZATION' AND ents[i - 1] = 'ORGANIZATION' THEN '_' ELSE ' ' END
                || v), '') AS sentence
      FROM tagged)""")
    # ---- E
    s["value_count"] = "SELECT event_type, count(*) AS count FROM events GROUP BY event_type"
    s["value_count_sorted"] = s["value_count"] + " ORDER BY count DESC, event_type"
    s["org_counts"] = _with("SELECT * FROM org_counts")
    s["adj_noun_union"] = _with("SELECT * FROM pairs")
    s["adj_counts"] = _with("SELECT * FROM adj_counts")
    s["org_adj_join"] = _with(
        "SELECT org_lower, subreddit, org, count, adj, "
        "CASE WHEN is_direct THEN 'direct' WHEN NOT is_direct THEN 'connected' END AS adj_kind, "
        "coalesce(adj_count, 0) AS adj_count FROM joined")
    s["org_adj_profile"] = _with("SELECT * FROM profile")
    s["org_sentences"] = _with("SELECT * FROM sentences")
    s["orgs_readback"] = _with("SELECT * FROM orgs_rb")
    s["sentence_tokens"] = _with(
        "SELECT id, subreddit, len(text) AS n_tokens, array_to_string(text, ' ') AS text FROM sentence_tokens")
    s["group_counts"] = _with("SELECT * FROM group_counts")
    s["group_counts_sorted"] = _with("SELECT * FROM group_counts ORDER BY commentsNum DESC, subreddit")
    s["groups_over_threshold"] = _with("SELECT * FROM big_groups")
    s["orgs_over_threshold"] = _with(
        f"SELECT * FROM orgs_rb WHERE count >= {QUERY_PROFILE.min_org_count} "
        f"AND subreddit IN (SELECT subreddit FROM big_groups)")
    s["group_sentences"] = _with("SELECT * FROM sentences WHERE subreddit IN (SELECT subreddit FROM big_groups)")
    s["org_totals"] = _with(
        f"SELECT org, CAST(sum(count) AS BIGINT) AS count FROM orgs_rb GROUP BY org "
        f"HAVING sum(count) >= {QUERY_PROFILE.min_org_count}")
    # ---- F
    s["w2v_vocab"] = _with(
        f"SELECT word, count(*) AS count FROM (SELECT unnest(text) AS word FROM sentence_tokens) "
        f"GROUP BY word HAVING count(*) >= {QUERY_PROFILE.min_word_count}")
    sims = f"""
e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
sims AS (
  SELECT a.vec_id, b.vec_id AS other_id,
         list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) AS sim
  FROM e a JOIN e b ON a.vec_id <> b.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, CAST(other_id AS VARCHAR)) AS rank FROM sims)"""
    s["similar_topk"] = (f"WITH {sims.strip()} SELECT vec_id, CAST(rank AS BIGINT) AS rank, other_id, "
                         f"round(sim, 4) AS similarity FROM ranked WHERE rank <= {TOPK}")
    s["mutual_nearest"] = (f"WITH {sims.strip()}, nn AS (SELECT vec_id, other_id, sim FROM ranked WHERE rank = 1) "
                           "SELECT x.vec_id AS a, x.other_id AS b, round(x.sim, 4) AS similarity "
                           "FROM nn x JOIN nn y ON x.vec_id = y.other_id AND x.other_id = y.vec_id "
                           "WHERE CAST(x.vec_id AS VARCHAR) < CAST(x.other_id AS VARCHAR)")
    k = QUERY_PROFILE.num_synonyms
    vocab = f"""
, words AS (SELECT id, subreddit, unnest(text) AS word FROM sentence_tokens),
vocab AS (SELECT word FROM words GROUP BY word HAVING count(*) >= {QUERY_PROFILE.min_word_count}),
totals AS (SELECT org, CAST(sum(count) AS BIGINT) AS count FROM orgs_rb GROUP BY org
           HAVING sum(count) >= {QUERY_PROFILE.min_org_count}),
group_vocab AS (SELECT subreddit, word FROM words WHERE subreddit IN (SELECT subreddit FROM big_groups)
                GROUP BY subreddit, word HAVING count(*) >= {QUERY_PROFILE.min_word_count}),
syn_all AS (
  SELECT 'all' AS subreddit, org, count, CASE WHEN replace(lower(org), ' ', '_') IN (SELECT word FROM vocab)
         THEN least({k}, (SELECT count(*) FROM vocab) - 1) ELSE 0 END AS n FROM totals),
syn_group AS (
  SELECT o.subreddit, o.org, o.count, CASE WHEN v.word IS NOT NULL
         THEN least({k}, (SELECT count(*) FROM group_vocab g WHERE g.subreddit = o.subreddit) - 1) ELSE 0 END AS n
  FROM orgs_rb o LEFT JOIN group_vocab v ON v.subreddit = o.subreddit AND v.word = replace(lower(o.org), ' ', '_')
  WHERE o.count >= {QUERY_PROFILE.min_org_count} AND o.subreddit IN (SELECT subreddit FROM big_groups))"""
    shown = "CAST(n AS INTEGER) AS n_synonyms, TRUE AS descending, TRUE AS other_words"
    s["w2v_doc_vectors"] = _with(vocab + f"""
SELECT s.id, s.subreddit, {QUERY_PROFILE.vector_size} AS dims,
       CAST((SELECT count(*) FROM words w WHERE w.id = s.id AND w.word IN (SELECT word FROM vocab)) AS BIGINT) AS known_words,
       TRUE AS is_mean FROM sentence_tokens s""")
    s["w2v_synonyms_all"] = _with(vocab + f" SELECT subreddit, org, count, {shown} FROM syn_all")
    s["w2v_synonyms_by_group"] = _with(vocab + f" SELECT subreddit, org, count, {shown} FROM syn_group")
    s["synonym_report"] = _with(vocab + """
SELECT CAST(row_number() OVER (ORDER BY count DESC, org, subreddit) - 1 AS BIGINT) AS id, org, subreddit, count,
       CAST(n AS INTEGER) AS n_synonyms, TRUE AS rounded
FROM (SELECT * FROM syn_all UNION ALL SELECT * FROM syn_group) WHERE n > 0""")
    s["synonyms_of_vectors"] = f"""
WITH e AS (SELECT vec_id, label, 'v_' || vec_id AS word, embedding::DOUBLE[] AS v FROM embeddings),
o AS (SELECT vec_id, CAST(label AS BIGINT) AS count, 'V ' || vec_id AS org, v FROM e WHERE vec_id % 7 = 0 AND vec_id % 3 <> 0),
r AS (
  SELECT o.org, o.count, e.word, list_dot_product(o.v, e.v) / (sqrt(list_dot_product(o.v, o.v)) * sqrt(list_dot_product(e.v, e.v))) AS sim
  FROM o JOIN e ON o.vec_id <> e.vec_id),
t AS (SELECT *, row_number() OVER (PARTITION BY org ORDER BY sim DESC, word) AS n FROM r),
l AS (SELECT org, any_value(count) AS count, string_agg(word || '=' || format('{{:.4f}}', round(sim, 4)), '|' ORDER BY n) AS synonyms
      FROM t WHERE n <= {TOPK} GROUP BY org)
SELECT CAST(row_number() OVER (ORDER BY count DESC, org) - 1 AS BIGINT) AS id, org, 'all' AS subreddit, count, synonyms FROM l"""
    s["w2v_oov"] = _with(f"""
, totals AS (SELECT org, CAST(sum(count) AS BIGINT) AS count FROM orgs_rb GROUP BY org
             HAVING sum(count) >= {QUERY_PROFILE.min_org_count}),
vocab AS (SELECT word FROM (SELECT unnest(text) AS word FROM sentence_tokens) GROUP BY word
          HAVING count(*) >= {QUERY_PROFILE.min_word_count})
SELECT org, count, replace(lower(org), ' ', '_') AS qword,
       replace(lower(org), ' ', '_') IN (SELECT word FROM vocab) AS in_vocab
FROM totals""".replace("\n, totals", ", totals", 1))
    # ---- G
    s["adjective_report"] = _with(f"""
, cleaned AS (
  SELECT org_lower, subreddit, is_direct, adj, adj_count,
         row_number() OVER (PARTITION BY org_lower, subreddit, is_direct ORDER BY adj_count DESC, adj) AS rn
  FROM joined WHERE adj_count > 1 AND adj NOT IN ('<', '>')),
lists AS (
  SELECT org_lower, subreddit,
         coalesce(string_agg(CASE WHEN is_direct THEN adj || '=' || adj_count END, '|' ORDER BY rn), '') AS d,
         coalesce(string_agg(CASE WHEN NOT is_direct THEN adj || '=' || adj_count END, '|' ORDER BY rn), '') AS c
  FROM cleaned WHERE rn <= 10 GROUP BY org_lower, subreddit),
items AS (
  SELECT o.org AS noun, o.subreddit, o.count, coalesce(l.d, '') AS directAdjectives,
         coalesce(l.c, '') AS connectedAdjectives
  FROM org_counts o LEFT JOIN lists l ON o.org_lower = l.org_lower AND o.subreddit = l.subreddit
  WHERE o.count > {REPORT_MIN_COUNT} AND (coalesce(l.d, '') <> '' OR coalesce(l.c, '') <> ''))
SELECT CAST(row_number() OVER (ORDER BY count DESC, noun, subreddit) - 1 AS BIGINT) AS id, * FROM items""")
    return s
