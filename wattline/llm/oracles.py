"""SQL (DuckDB) for the text queries that SQL can express."""

from __future__ import annotations

from wattline.llm import decontamination, mixing, quality

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def seats_sql(rows: str, part: str, order: str, votes: str, seats: str, keep: str) -> str:
    """Sainte-Lague seats of each row of ``rows``: the highest quotients of all candidates."""
    return f"""
SELECT {keep}, sure + count(*) FILTER (place <= {seats} - sure_seats) AS won FROM (
  SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {votes} / (2 * k + 1) DESC, {order}, k) AS place FROM (
    SELECT *, unnest(generate_series(sure, most)) AS k FROM (
      SELECT *, sum(sure) OVER (PARTITION BY {part}) AS sure_seats FROM (
        SELECT *, CAST(greatest(0, floor(per * ({seats} - claims / 2) - 0.5) - 1) AS BIGINT) AS sure,
          CAST(ceil(per * ({seats} + claims / 2) + 0.5) + 1 AS BIGINT) AS most FROM (
          SELECT *, CASE WHEN all_votes > 0 THEN {votes} / all_votes ELSE 0 END AS per FROM (
            SELECT *, count(*) OVER (PARTITION BY {part}) AS claims, CAST(sum({votes}) OVER (PARTITION BY {part}) AS DOUBLE) AS all_votes
            FROM {rows}) AS a) AS b) AS c) AS d) AS e) AS f
GROUP BY {keep}, sure
"""


B, S, SEED = mixing.BLOCK_WORDS, mixing.SHARD_WORDS, mixing.SEED

MIX = f"""
WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
    md5(concat_ws(':', '{SEED}', CAST(doc_id AS VARCHAR))) AS key FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY 1),
weighed AS (SELECT *, ([5.0, 2.0, 1.0])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
    CAST(source_size * 3 AS DOUBLE) AS cap FROM src),
filling AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS all_words, sum(weight) OVER () AS weights,
    coalesce(sum(cap) OVER before, 0) AS fl, coalesce(sum(weight) OVER before, 0) AS fw FROM weighed
    WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, (all_words - fl) / (weights - fw) AS level, cap < weight * ((all_words - fl) / (weights - fw)) AS capped FROM filling),
targets AS (SELECT source, source_size, all_words, 1 AS everyone, floor(all_words / {B} + 0.5) AS seats,
    CASE WHEN capped THEN cap ELSE least(cap, weight * max(CASE WHEN NOT capped THEN level END) OVER ()) END AS target FROM levels),
quotas AS ({seats_sql("targets", "everyone", "source NULLS LAST", "target", "seats", "source, source_size, target")}),
placed AS (SELECT s.*, q.source_size, q.target, q.won AS quota,
    CAST('0x' || substr(key, 1, 8) AS BIGINT) % CAST(greatest(1, ceil(q.source_size / {S})) AS BIGINT) AS shard
  FROM sized s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source),
shards AS (SELECT source, shard, CAST(sum(size) AS DOUBLE) AS words, any_value(quota) AS quota, CAST(ceil(sum(size) / {B}) AS BIGINT) AS blocks
  FROM placed GROUP BY 1, 2),
blocks AS ({seats_sql("shards", "source", "shard", "words", "quota", "source, shard, blocks")}),
whole AS (SELECT p.*, b.blocks, least(b.won, b.blocks * 3) AS won, row_number() OVER line AS place,
    sum(size) OVER (line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop
  FROM placed p JOIN blocks b ON p.source IS NOT DISTINCT FROM b.source AND p.shard = b.shard
  WINDOW line AS (PARTITION BY p.source, p.shard ORDER BY substr(key, 9, 24), doc_id NULLS FIRST, size)),
pieces AS (SELECT *, stop - size AS start, unnest(generate_series(CAST((stop - size) // {B} AS BIGINT), CAST((stop - 1) // {B} AS BIGINT))) AS block FROM whole WHERE size > 0),
drawn AS (SELECT *, won // blocks + CASE WHEN dense_rank() OVER (PARTITION BY source, shard ORDER BY
    md5(concat_ws(':', '{SEED}', source, CAST(shard AS VARCHAR), CAST(block AS VARCHAR))), block) <= won % blocks THEN 1 ELSE 0 END AS times FROM pieces),
got AS (SELECT source, shard, place, sum(times * (least(stop, (block + 1) * {B}) - greatest(start, block * {B}))) AS taken FROM drawn GROUP BY 1, 2, 3)
SELECT w.doc_id, w.size, w.source_size, w.target, CAST(coalesce(g.taken, 0) AS BIGINT) AS taken FROM whole w
LEFT JOIN got g ON w.source IS NOT DISTINCT FROM g.source AND w.shard = g.shard AND w.place = g.place
"""

STATISTICS = {rule: statistic.replace("/", "* 1.0 /") for rule, (statistic, _) in quality.RULES.items()}
TESTS = [(r, c) for r, (_, cutoffs) in quality.RULES.items() for c in cutoffs]
RATE = quality.ALPHA / len(quality.RULES)

QUALITY = f"""
WITH cut AS (SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM documents),
spans AS (SELECT row, i, count(*) OVER (PARTITION BY row, span) AS times FROM
  (SELECT row, i, array_to_string(list_slice(words, i, i + 4), ' ') AS span FROM (SELECT row, words, unnest(generate_series(1, len(words) - 4)) AS i FROM cut) AS a) AS b),
repeats AS (SELECT row, sum(least(5, i - coalesce(last, i - 5))) AS n FROM
  (SELECT row, i, lag(i) OVER (PARTITION BY row ORDER BY i) AS last FROM spans WHERE times > 1) AS a GROUP BY 1),
counted AS (SELECT cut.row, doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len(lines) AS n_lines, len(regexp_extract_all(text, '[A-Z]')) AS n_capitals FROM cut LEFT JOIN repeats ON cut.row = repeats.row),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted),
known AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
long AS ({" UNION ALL ".join(f"SELECT row, doc_id, lang, base_failed, '{r}' AS rule, {s} AS value FROM judged" for r, s in STATISTICS.items())}),
tests(rule, cutoff) AS (VALUES {", ".join(f"('{r}', {c}::DOUBLE)" for r, c in TESTS)}),
tried AS (SELECT lang, t.rule, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (good AND value > cutoff) AS lost,
    count(*) FILTER (NOT good AND value > cutoff) AS caught
  FROM long l JOIN known k ON l.doc_id = k.doc_id JOIN tests t ON l.rule = t.rule WHERE NOT base_failed GROUP BY 1, 2, 3),
tested AS (SELECT *, caught - {quality.GOOD_WEIGHT} * lost AS gain, CASE WHEN lost >= n * {RATE}::DOUBLE THEN 1 ELSE
  list_sum(list_transform(range(0, lost + 1), lambda i: exp(lgamma(n + 1) - CASE WHEN i > 0 THEN lgamma(i + 1) ELSE 0 END - lgamma(n - i + 1)
    + i * ln({RATE}::DOUBLE) + (n - i) * ln(1 - {RATE}::DOUBLE)))) END AS p FROM tried),
families AS (SELECT max(p) AS worst FROM tested GROUP BY lang, rule),
steps AS (SELECT worst, row_number() OVER (ORDER BY worst) AS step, count(*) OVER () AS many FROM families),
level AS (SELECT {quality.DELTA}::DOUBLE / greatest(1, any_value(many) - coalesce(min(step) FILTER (worst > {quality.DELTA}::DOUBLE / (many - step + 1)) - 1, any_value(many))) AS level FROM steps),
chosen AS (SELECT lang, rule, max(struct_pack(gain := gain, cutoff := cutoff)).cutoff AS cutoff FROM tested, level WHERE p <= level AND gain > 0 GROUP BY 1, 2),
broken AS (SELECT DISTINCT row FROM long l JOIN chosen c ON l.lang IS NOT DISTINCT FROM c.lang AND l.rule = c.rule WHERE value > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND b.row IS NULL AS kept
FROM judged j LEFT JOIN broken b ON j.row = b.row
"""

W = decontamination.WINDOW
NORMAL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_sql(columns: str, source: str) -> str:
    text = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
    return f"SELECT {columns}, regexp_extract_all({text}, '{NORMAL}') AS words FROM {source}"


LEAKS = f"""
WITH item AS ({words_sql("item_id", "benchmark")}),
win AS (SELECT DISTINCT item_id, least({W}, len(words)) AS n, array_to_string(list_slice(words, i, i + {W - 1}), ' ') AS span FROM
  (SELECT *, unnest(generate_series(1, greatest(1, len(words) - {W - 1}))) AS i FROM item WHERE len(words) > 0) AS a),
doc AS ({words_sql("row_number() OVER () AS row, doc_id", "documents")}),
place AS (SELECT row, n, i, array_to_string(list_slice(words, i, i + n - 1), ' ') AS span FROM
  (SELECT row, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i FROM doc, (SELECT DISTINCT n FROM win) AS lengths) AS a),
found AS (SELECT row, i, place.n, item_id FROM place JOIN win ON place.n = win.n AND place.span = win.span),
hit AS (SELECT row, count(DISTINCT pos) AS n_hit FROM (SELECT row, unnest(generate_series(i, i + n - 1)) AS pos FROM found) AS a GROUP BY 1),
named AS (SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS id FROM found) AS a GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit ON doc.row = hit.row LEFT JOIN named ON doc.row = named.row
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_sql(columns: str, source: str) -> str:
    text = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
    return f"SELECT {columns}, unnest(regexp_extract_all({text}, '{TERM}')) AS term FROM {source}"


SEARCH = f"""
WITH doc AS ({terms_sql("row_number() OVER () AS row, doc_id", "documents")}),
tf AS (SELECT row, doc_id, term, count(*) AS tf FROM doc GROUP BY ALL),
len AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY 1),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM len),
df AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, corpus GROUP BY term, docs),
asked AS (SELECT item_id, term, count(*) AS times FROM ({terms_sql("item_id", "benchmark")}) AS q GROUP BY ALL),
scored AS (SELECT item_id, doc_id, tf.row, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words)))) AS BIGINT) AS score
  FROM asked JOIN df ON asked.term = df.term JOIN tf ON asked.term = tf.term JOIN len ON tf.row = len.row, corpus GROUP BY 1, 2, 3)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0) AS r
WHERE rank <= 10
"""

NEAREST = """
WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS f FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.f, c.f) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id IS DISTINCT FROM c.vec_id AND len(q.f) = len(c.f) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM scored) AS r
WHERE rank <= 5
"""

ORACLES = {
    "op1_mixing": MIX,
    "op3_quality": QUALITY,
    "op8_decontamination": LEAKS,
    "op11_lexical_search": SEARCH,
    "op12_vector_search": NEAREST,
}
