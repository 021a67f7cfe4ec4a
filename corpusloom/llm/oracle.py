"""DuckDB SQL for the queries that it can express."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PLAIN_WORDS = (
    f"list_filter(regexp_split_to_array({LOWER.format('text')}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
)
SPACED_WORDS = f"list_filter(regexp_split_to_array({LOWER.format('text')}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

def shingle_links(percent: int) -> str:
    """Sizes and components of documents whose shingle sets are so similar."""
    return f"""WITH RECURSIVE cut AS (SELECT doc_id, {SPACED_WORDS} AS w FROM documents),
  shingle AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM cut, unnest(range(1, greatest(1, len(w) - 4) + 1)) t(i) WHERE len(w) > 0),
  size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1),
  pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingle a JOIN shingle b
    ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
  link AS (SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
    WHERE 100 * c >= {percent} * (x.n + y.n - c)),
  step AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
  reach AS (SELECT doc_id AS d, doc_id AS r FROM documents
    UNION SELECT d, b FROM reach JOIN step ON r = a)
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, (SELECT min(r) FROM reach WHERE d = doc_id) AS component_id
  FROM documents LEFT JOIN size USING (doc_id)"""

CONTAMINATION = f"""WITH item AS (SELECT item_id, {PLAIN_WORDS} AS w FROM benchmark),
  pattern AS (SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
    FROM item, unnest(range(1, greatest(1, len(w) - 12) + 1)) t(i) WHERE len(w) > 0),
  cut AS (SELECT doc_id, {PLAIN_WORDS} AS w FROM documents),
  place AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
    FROM cut, (SELECT DISTINCT k FROM pattern) d, unnest(range(1, len(w) - k + 2)) t(i)),
  hit AS (SELECT doc_id, item_id, i, place.k FROM place JOIN pattern ON place.s = pattern.s AND place.k = pattern.k),
  covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM hit, unnest(range(i, i + k)) t(p) GROUP BY 1),
  found AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) h GROUP BY 1)
  SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit,
    coalesce(found.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= coalesce(len(w), 0) AS contaminated
  FROM cut LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""

INTERACTIONS = """WITH cut AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
  said AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
    FROM labels GROUP BY 1),
  fails AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN cut.doc_id > min(cut.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS f
    FROM cut LEFT JOIN said USING (doc_id)),
  cell AS (SELECT part, f, count(*) AS n, count_if(good) AS g, count_if(toxic) AS x FROM fails GROUP BY 1, 2),
  letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
  orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letter a, letter b, letter c, letter d, letter e
    WHERE length(replace(replace(replace(replace(replace('ABCDE', a.l, ''), b.l, ''), c.l, ''), d.l, ''), e.l, '')) = 0),
  steps AS (SELECT filter_order, step, filter_order[step] AS l, filter_order[:step - 1] AS before
    FROM orders, range(1, 6) r(step)),
  judged AS (SELECT part, filter_order, step, n, g, x, f, contains(f, l) AS here, length(f) AS k,
    length(translate(f, before, '')) < length(f) AS gone FROM cell, steps)
  SELECT part, filter_order, step::INTEGER AS step,
    sum(CASE WHEN NOT here AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN here AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN here AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN here AND k = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN here AND NOT gone THEN g ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN here AND NOT gone THEN x ELSE 0 END)::BIGINT AS toxic_lost,
    sum(CASE WHEN here THEN n * (120 // k) ELSE 0 END)::BIGINT AS shapley
  FROM judged GROUP BY 1, 2, 3"""

ORACLE: dict[str, str] = {
    "op2_parity_jaccard_join": shingle_links(75),
    "op11_filter_interactions": INTERACTIONS,
    "op13_similarity_sketch_dedup": f"SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM ({shingle_links(85)})",
    "op9_benchmark_decontamination": CONTAMINATION,
}
