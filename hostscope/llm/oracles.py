"""SQL for the corpus queries that SQL can express, over the same tables."""

from __future__ import annotations

from hostscope.llm import fim, mixing, ngram_join, quality, sharding, vector_codes

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _crc_table() -> list[int]:
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


def sharding_sql(n: int = 8) -> str:
    """The jump hash as recursion on 128-bit integers; the checksum as a fold over bytes by the usual table of a rule."""
    mod = 1 << 64
    step = f"((key * {sharding.MULTIPLIER}::HUGEINT + 1) % {mod}::HUGEINT)"
    jump = lambda k: f"""j{k} AS (SELECT doc_id AS id, (CASE WHEN doc_id < 0 THEN doc_id + {mod}::HUGEINT ELSE doc_id END)::HUGEINT AS key, -1::BIGINT AS at, 0::BIGINT AS nxt FROM ids
 UNION ALL SELECT id, k2, nxt, CAST(floor((nxt + 1)::DOUBLE * (2147483648.0::DOUBLE / ((k2 // 8589934592) + 1)::DOUBLE)) AS BIGINT) FROM (SELECT *, {step} AS k2 FROM j{k} WHERE nxt < {k}))"""  # noqa: E731
    two = f"((({step.replace('key', 'doc_id::HUGEINT')}) * {sharding.MULTIPLIER}::HUGEINT + 1) % {mod}::HUGEINT)"
    return f"""WITH RECURSIVE ids AS (SELECT DISTINCT doc_id FROM documents), {jump(n)}, {jump(n + 1)},
 tb AS (SELECT {_crc_table()}::BIGINT[] AS t), bytes AS (SELECT doc_id, text, hex(encode(coalesce(text, ''))) AS h FROM documents),
 sums AS (SELECT doc_id, text, CASE WHEN h = '' THEN 0 ELSE xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2))::BIGINT)), lambda a, x: xor(a >> 8, t[xor(a, x) % 256 + 1])), 4294967295) END AS crc, len(h) // 2 + 1 AS size FROM bytes, tb),
 placed AS (SELECT s.doc_id, s.size, s.crc, a.at AS shard, b.at AS grown, CAST(({two} // 4294967296 // 16) % {sharding.SLOT_BUCKETS} AS INTEGER) AS bucket FROM sums s JOIN j{n} a ON a.id = s.doc_id AND a.nxt >= {n} JOIN j{n + 1} b ON b.id = s.doc_id AND b.nxt >= {n + 1})
 SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard, row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, crc, size) - 1 AS slot, CAST(grown AS INTEGER) AS grown_shard FROM placed"""


def mixing_sql() -> str:
    w = list(mixing.WEIGHTS)
    return f"""WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size, md5('{mixing.SEED}-' || doc_id) AS k FROM documents),
 s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1), r AS (SELECT *, {w}[(row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % {len(w)} + 1]::DOUBLE AS w, source_size * {mixing.MOST_EPOCHS}::DOUBLE AS cap FROM s),
 o AS (SELECT *, (sum(source_size) OVER ())::DOUBLE * {mixing.SHARE} - coalesce(sum(cap) OVER before, 0) AS rest, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS weight FROM r WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 lv AS (SELECT rest / weight AS level FROM o WHERE rest * w <= cap * weight ORDER BY cap / w, source NULLS LAST LIMIT 1), g AS (SELECT source, source_size, least(cap, coalesce(w * level, cap)) AS target FROM o LEFT JOIN lv ON true),
 p AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole, sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
 SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size, CAST(round(target) AS BIGINT) - whole * source_size - before)) AS BIGINT) AS taken FROM p"""


def dedup_sql() -> str:
    return """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
 FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


def quality_sql() -> str:
    rate = {
        "symbols_per_char": "CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END", "repeats_per_word": "CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END",
        "dup_lines_per_word": "CASE WHEN n_words > 0 THEN n_dup_lines / n_words ELSE 0 END", "chars_per_word": "CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END",
    }
    p = quality.RISK / len(quality.RULES)
    rates = " UNION ALL ".join(f"SELECT stratum, '{r}' AS rule, ({rate[r]})::DOUBLE AS v, q = 1 AS good FROM known" for r in quality.RULES)
    levels = [1 - p * j / quality.STEPS for j in range(quality.STEPS + 1)]
    tail = f"CASE WHEN k > n * {p} THEN 1 ELSE list_sum(list_transform(range(k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p})))) END"
    over = " OR ".join(f"coalesce({rate[r]} > (SELECT cut FROM best b WHERE b.stratum = s.stratum AND rule = '{r}'), false)" for r in quality.RULES)
    return f"""WITH w AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text, {WORDS} AS ws FROM documents),
 pos AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 4), tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM pos),
 rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1), cov AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM rep, range(3) x(k) GROUP BY 1),
 ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM w), dl AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines FROM ln WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY 1),
 s0 AS (SELECT w.doc_id, stratum, text, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN dl USING (doc_id)),
 s AS (SELECT *, n_words < {quality.MIN_WORDS} OR n_repeat_words * 100 > n_words * {quality.REPEAT_PERCENT} AS base_failed FROM s0), lab AS (SELECT doc_id, min(quality) AS q FROM labels GROUP BY 1 HAVING min(quality) IS NOT NULL),
 known AS (SELECT * FROM (SELECT s.* EXCLUDE (text), min(l.q) OVER same AS q, row_number() OVER same AS nth FROM s JOIN lab l ON l.doc_id = s.doc_id WHERE NOT base_failed WINDOW same AS (PARTITION BY stratum, text)) WHERE nth = 1), rates AS ({rates}),
 cuts AS (SELECT DISTINCT stratum, rule, unnest(cs) AS cut FROM (SELECT stratum, rule, quantile_disc(v, {levels}) AS cs FROM rates WHERE good GROUP BY ALL)), alpha AS (SELECT {1 - quality.CONFIDENCE} / (count(DISTINCT stratum) * {len(quality.RULES)}) AS a FROM cuts),
 tests AS (SELECT c.stratum, c.rule, cut, count(*) FILTER (good) AS n, count(*) FILTER (good AND v > cut) AS k, count(*) FILTER (NOT good) AS m, count(*) FILTER (NOT good AND v > cut) AS b FROM cuts c JOIN rates r ON r.stratum = c.stratum AND r.rule = c.rule GROUP BY ALL),
 gains AS (SELECT *, CASE WHEN m > 0 THEN b / m - {quality.COST}::DOUBLE * (k / n) ELSE 0 END AS gain, {tail} <= (SELECT a FROM alpha) AS safe FROM tests),
 best AS (SELECT stratum, rule, cut FROM gains WHERE safe AND gain > 0 QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, cut DESC) = 1)
 SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({over}) AS kept FROM s"""


def ngram_sql() -> str:
    k, p = ngram_join.SHINGLE, ngram_join.PERCENT
    gram = " || ' ' || ".join(f"ws[i + {x}]" for x in range(k))
    return f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
 g AS (SELECT DISTINCT doc_id, {gram} AS t FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {k - 2})) AS i FROM w WHERE len(ws) >= {k}) UNION SELECT doc_id, len(ws) || ':' || array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND {k - 1}),
 n AS (SELECT w.doc_id, count(t) AS n FROM w LEFT JOIN g USING (doc_id) GROUP BY 1), c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
 l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= {p} * (x.n + y.n - shared)), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
 r AS (SELECT doc_id AS id, doc_id AS root FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id)
 SELECT n.doc_id, n.n AS n_shingles, min(r.root) AS component_id FROM n JOIN r ON r.id = n.doc_id GROUP BY ALL"""


def vector_sql() -> str:
    """Every round as two steps over the parts of all vectors: the nearest entry of sixteen, then floored means."""
    v = vector_codes
    apart = "list_sum(list_transform(range(len(x.q)), lambda i: (x.q[CAST(i + 1 AS BIGINT)] - c.q[CAST(i + 1 AS BIGINT)]) * (x.q[CAST(i + 1 AS BIGINT)] - c.q[CAST(i + 1 AS BIGINT)])))"
    ctes = [f"""k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({v.SCALE}::DOUBLE * x) AS BIGINT)) AS q FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"x AS MATERIALIZED (SELECT vec_id, label, p, q[p * len(q) // {v.PARTS} + 1 : (p + 1) * len(q) // {v.PARTS}] AS q FROM k, range({v.PARTS}) t(p))",
            f"c0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, q FROM x WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {v.ENTRIES}))"]
    for r in range(v.ROUNDS + 1):
        ctes.append(f"a{r} AS MATERIALIZED (SELECT vec_id, label, p, q, s.d AS d, s.e AS e FROM (SELECT x.vec_id, x.label, x.p, x.q, min({{'d': {apart}, 'e': c.e}}) AS s FROM x JOIN c{r} c ON c.p = x.p GROUP BY ALL))")
        if r < v.ROUNDS:
            ctes.append(f"""m{r} AS (SELECT p, e, i, CAST(sum(q[i]) AS HUGEINT) AS s, count(*) AS n FROM (SELECT p, e, q, unnest(range(1, len(q) + 1)) AS i FROM a{r}) GROUP BY ALL),
 u{r} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS q FROM m{r} GROUP BY ALL), c{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(u.q, c.q) AS q FROM c{r} c LEFT JOIN u{r} u USING (p, e))""")
    n = v.ROUNDS
    return f"""WITH {", ".join(ctes)}, h AS (SELECT sha256(string_agg(array_to_string(q, ','), ',' ORDER BY p, e)) AS h FROM c{n}),
 o AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{n} GROUP BY ALL)
 SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM o, h"""


def fim_sql() -> str:
    p, s, m = fim.PREFIX, fim.SUFFIX, fim.MIDDLE
    h = lambda k: f"CAST('0x' || substr(g, {8 * k - 7}, 8) AS BIGINT)"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{fim.UNIT.replace(chr(92) + "n", chr(10))}') AS u, sha256('{fim.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS g FROM documents),
 e AS (SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, {h(1)} % (len(u) + 1) AS x, {h(2)} % (len(u) + 1) AS y, t = '' OR contains(t, '{p}') OR contains(t, '{s}') OR contains(t, '{m}') OR {h(3)} % 100 >= {fim.RATE} AS plain, {h(4)} % 100 < {fim.SPM} AS spm FROM d),
 c AS (SELECT doc_id, t, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form, array_to_string(u[1 : least(x, y)], '') AS a, array_to_string(u[least(x, y) + 1 : greatest(x, y)], '') AS b, array_to_string(u[greatest(x, y) + 1 :], '') AS z FROM e),
 o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '{s}' || z || '{p}' || a || '{m}' || b ELSE '{p}' || a || '{s}' || z || '{m}' || b END AS output FROM c)
 SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(a) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(b) AS BIGINT) END AS middle_chars, sha256(output) AS output_sha256, sha256(CASE WHEN form = 'plain' THEN output ELSE a || b || z END) AS restored_sha256 FROM o"""


def oracle_sql() -> dict[str, str]:
    return {"op1_sharding": sharding_sql(), "op3_quality_rules": quality_sql(), "op4_ngram_join": ngram_sql(), "op5_mixing": mixing_sql(), "op9_exact_dedup": dedup_sql(), "op12_vector_codes": vector_sql(), "op13_fill_in_middle": fim_sql()}
