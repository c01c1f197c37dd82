"""SQL twins of the queries that SQL can express."""

# The letters that are lower-cased.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE
      WHEN len(w) = 0 THEN []
      WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 2),
        lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS s
  FROM words),
members AS (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM members a JOIN members b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
  WHERE 100 * n >= 80 * (len(p.s) + len(q.s) - n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, min(b) AS component_id,
  sets.doc_id = min(b) AS kept
FROM sets JOIN reach ON reach.a = sets.doc_id GROUP BY sets.doc_id, s"""

SUFFIX_ARRAY = """
WITH hexed AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
-- Blocks of 1000 starts, since substr() counts from the beginning of its text.
blocks AS (
  SELECT doc_id, j, substr(h, 2000 * j + 1, 2098) AS b, len(h) // 2 AS n
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2000 + 1)) AS j FROM hexed)),
grams AS (
  SELECT doc_id, 1000 * j + i AS k, hash(substr(b, 2 * i + 1, 100)) AS g
  FROM (SELECT doc_id, j, b, unnest(range(0, least(1000, greatest(n - 49 - 1000 * j, 0)))) AS i
    FROM blocks)),
first_of AS (SELECT g, min(doc_id) AS first FROM grams GROUP BY g),
lost AS (SELECT doc_id, k FROM grams JOIN first_of USING (g) WHERE first < doc_id),
-- Starts in order; a span ends where the next start lies more than 50 bytes on.
ordered AS (
  SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM lost),
numbered AS (
  SELECT doc_id, k, sum(CASE WHEN before IS NULL OR k - before > 50 THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY k) AS span FROM ordered),
spans AS (
  SELECT doc_id, span, min(k) AS a, max(k) + 50 AS b FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL
  SELECT doc_id, coalesce(max(spans.b), 0), any_value(len(h) // 2)
  FROM hexed LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h
  FROM gaps JOIN hexed USING (doc_id) GROUP BY doc_id),
counted AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS n FROM spans GROUP BY doc_id)
SELECT doc_id, (len(hexed.h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
  coalesce(n, 0)::BIGINT AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM hexed JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id)"""


COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex({LOWERED}, '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents)),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM places CROSS JOIN (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
counted AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS total FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM counted WHERE k > 1 AND n >= 100),
absorbed AS (
  SELECT DISTINCT p.lang, p.phrase FROM candidates p JOIN candidates q
  ON p.lang = q.lang AND q.k > p.k AND 100 * q.n >= 100 * p.n
    AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' ')),
cuts AS (
  SELECT lang, phrase, n AS a, j, array_to_string(w[1:j], ' ') AS lhs,
    array_to_string(w[j + 1:], ' ') AS rhs
  FROM (SELECT lang, phrase, n, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j
    FROM candidates ANTI JOIN absorbed USING (lang, phrase))),
scored AS (
  SELECT cuts.*, p.n AS l, q.n AS r, total,
    (1000::HUGEINT * a * total) // (p.n::HUGEINT * q.n) AS score
  FROM cuts JOIN counted p ON p.lang = cuts.lang AND p.phrase = lhs
  JOIN counted q ON q.lang = cuts.lang AND q.phrase = rhs JOIN totals ON totals.lang = cuts.lang),
best AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, total::BIGINT AS n,
  score::BIGINT AS score
FROM best QUALIFY rank <= 2000"""


def _places(phrase):
    """SQL list of the starts of a phrase among the words."""
    parts = [f"w[i + {k}] = '{word}'" for k, word in enumerate(phrase.split(), 1)]
    return f"list_filter(range(0, len(w)), lambda i: {' AND '.join(parts)})"


# What the templates ask for, over the words joined by single blanks.
NOTICES = {
    "mit": [
        "(released|licensed|distributed|available) under (the terms of )?the mit license ",
        "permission is hereby granted free of charge to any person obtaining a copy of "
        "([^ ]+ ){1,12}to deal in ([^ ]+ ){1,4}without restriction ",
    ],
    "apache-2.0": ["licensed under the apache license version 2 0 "],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met "
    ],
    "cc-by-variant": ["licensed under (a )?cc by ((nc|sa|nd) ){1,2}[0-9]+ "],
    "gpl-3.0": ["licensed under the gnu general public license version 3 "],
    "reserved-notice": ["copyright ([^ ]+ ){0,10}all rights reserved "],
}


def license_sql(phrases):
    lists = ", ".join(f"{_places(p)} AS p{k}" for k, p in enumerate(phrases))
    base = ", ".join(
        f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, label in enumerate(phrases.values())
    )
    more = ", ".join(
        "CASE WHEN {} THEN '{}' END".format(
            " OR ".join(f"regexp_matches(line, ' {pattern}')" for pattern in patterns), label
        )
        for label, patterns in NOTICES.items()
    )
    joined = " || ".join(f"p{k}" for k in range(len(phrases)))
    return rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
found AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS line, {lists} FROM words),
labelled AS (
  SELECT doc_id, len(w) AS n, {joined} AS places,
    list_filter([{base}], lambda x: x IS NOT NULL) AS base,
    list_filter([{more}], lambda x: x IS NOT NULL) AS more
  FROM found)
SELECT doc_id, n::BIGINT AS n_words, len(places)::BIGINT AS n_base,
  list_min(places) AS first_word, list_max(places) AS last_word,
  array_to_string(list_sort(base), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(base || more)), ',') AS labels,
  CASE WHEN len(more) > 0 THEN 1.0 WHEN len(places) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM labelled"""
