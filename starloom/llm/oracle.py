"""DuckDB SQL for the operators that SQL can express, written apart from their plans."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op2_line_dedup": """
WITH d AS (SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
n AS (SELECT *, len(l) AS n, list_transform(l, lambda x: len(x) - len(replace(x, ' ', '')) + 1) AS w FROM d),
s AS (SELECT doc_id, text, n, l, i, CASE WHEN w[i] > 50 THEN 1 WHEN w[i] + coalesce(w[i + 1], 0) > 50 THEN 2 ELSE 3 END AS k
  FROM n, unnest(generate_series(1, n)) AS g(i)),
win AS (SELECT doc_id, text, i, k, array_to_string(l[i : i + k - 1], chr(10)) AS t FROM s WHERE i + k - 1 <= n),
later AS (SELECT doc_id, text, i, k FROM (
  SELECT *, row_number() OVER (PARTITION BY t, k ORDER BY doc_id, i) AS nth FROM win) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, text, i + o AS i FROM later, unnest(generate_series(0, k - 1)) AS g(o)),
lines AS (SELECT doc_id, text, i, l[i] AS t FROM d, unnest(generate_series(1, len(l))) AS g(i)),
kept AS (SELECT doc_id, text, string_agg(t, chr(10) ORDER BY i) AS t, count(*) AS c FROM lines ANTI JOIN gone USING (doc_id, text, i) GROUP BY ALL)
SELECT x.doc_id, CASE WHEN x.text IS NOT NULL THEN coalesce(kept.t, '') END AS text, CAST(coalesce(len(string_split(x.text, chr(10))), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(string_split(x.text, chr(10))), 0) - coalesce(kept.c, 0) AS BIGINT) AS n_removed
FROM documents x LEFT JOIN kept ON kept.doc_id = x.doc_id AND kept.text = x.text""",
    "op8_decontamination": f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS t
  FROM b, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS g(i) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (
  SELECT doc_id, i, n, array_to_string(ws[i : i + n - 1], ' ') AS t
  FROM w, sizes, unnest(generate_series(1, len(ws) - n + 1)) AS g(i)),
hit AS (SELECT pos.doc_id, pos.i, pos.n, win.item_id FROM pos JOIN win USING (n, t)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(generate_series(i, i + n - 1)) AS g(p) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op10_exact_dedup": f"""
WITH t AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)""",
    "op12_fim": f"""
WITH u AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS l,
  sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
k AS (SELECT *, len(l) AS n, {", ".join(f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))} FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM k),
p AS (SELECT *, array_to_string(l[1 : a], '') AS pre, array_to_string(l[a + 1 : b], '') AS mid, array_to_string(l[b + 1 :], '') AS suf,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
       WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(len(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(len(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
         ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p""",
    "op13_collocations": f"""
WITH w AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
f AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM w, unnest([1, 2, 3, 4]) AS ks(k), unnest(generate_series(1, len(w) - k + 1)) AS g(i) GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
cuts AS MATERIALIZED (
  SELECT lang, phrase, a, j, array_to_string(w[1 : j], ' ') AS lw, array_to_string(w[j + 1 :], ' ') AS rw FROM c, unnest(generate_series(1, k - 1)) AS s(j)),
many AS MATERIALIZED (SELECT lang, phrase, f FROM f WHERE f >= 30),
lefts AS MATERIALIZED (SELECT cuts.*, many.f AS l FROM cuts JOIN many ON many.lang = cuts.lang AND many.phrase = lw),
cut AS (
  SELECT lefts.lang, lefts.phrase, a, j, l, many.f AS r, (2000000 * CAST(a AS HUGEINT)) // (l + many.f) AS score
  FROM lefts JOIN many ON many.lang = lefts.lang AND many.phrase = rw),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
around AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS most
  FROM c, unnest(generate_series(2, k - 1)) AS ms(m), unnest(generate_series(1, k - m + 1)) AS g(i) GROUP BY ALL),
ranked AS (
  SELECT best.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best LEFT JOIN around USING (lang, phrase) WHERE most IS NULL OR 100 * CAST(most AS HUGEINT) < 80 * a)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
}
