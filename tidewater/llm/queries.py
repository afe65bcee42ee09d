"""The registered queries of the operators, and SQL for those that SQL can express.

Each applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op1_mix, op2_urls, op3_warc, op4_jaccard, op5_toxicity, op6_lines, op7_decontaminate, op8_topk, op9_licenses, op10_chat, op11_repair, op12_tokens, op13_runs
from .common import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_mix.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(op2_urls.RULES), "host string, path string, verdict string")
    return op2_urls.judge(table(spark, sf_dir, "pages"), rules)


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each derived record; the record itself as its digest and length."""
    records = op3_warc.derive(op3_warc.responses_of(table(spark, sf_dir, "pages")))
    return records.select("page_id", "warc_type", "refers_to", "record_id", "target_uri", "block_digest", "length", "links", F.sha2("record", 256).alias("record_sha256"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_jaccard.joined(table(spark, sf_dir, "documents"))


def op5_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return op5_toxicity.scored(docs, op5_toxicity.fitted(docs, table(spark, sf_dir, "labels")))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_lines.judged(table(spark, sf_dir, "documents"))


def op7_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op7_decontaminate.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_topk.top_k(table(spark, sf_dir, "embeddings"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_licenses.licenses(table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given conversations, and one (-7) of nothing but control strings."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", op10_chat.PROBE), (-7, 1, "assistant", op10_chat.PROBE)], given.schema)
    read = op10_chat.read_back(op10_chat.formatted(given.unionByName(probe)))
    conv = F.when(F.col("has") == 1, F.col("conv")).alias("conv_id")
    return read.select(conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by a rule; the repaired ones as their digest."""
    rows, signed, audits = op11_repair.repair(op11_repair.damaged(table(spark, sf_dir, "conversations")))
    both = signed.join(audits, ["has", "conv"]).join(op11_repair.repaired_digests(rows, audits), ["has", "conv"])
    conv = F.when(F.col("has") == 1, F.col("conv")).alias("conv_id")
    return both.select(conv, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_tokens.counted(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, some with a tail that goes round; runs and collapsed text as their digests."""
    found = op13_runs.detected(table(spark, sf_dir, "documents"), rewrite=op13_runs.repeated_tails)
    best = found.withColumn("best", op13_runs.longest_for_its_period(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(op13_runs.written_out(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_url_filters,
        op3_warc_derivatives,
        op4_ngram_jaccard,
        op5_toxicity_scores,
        op6_line_dedup,
        op7_benchmark_hits,
        op8_exact_topk,
        op9_license_scan,
        op10_chat_format,
        op11_conversation_repair,
        op12_token_counts,
        op13_periodic_runs,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 8))::BIGINT AS at
  FROM documents),
per AS (
  SELECT *, [5.0, 2.0, 1.0][(rank - 1) % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap
  FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source)),
tried AS (
  SELECT *, sum(source_size::DOUBLE) OVER () * 1.5::DOUBLE AS budget,
         (sum(source_size::DOUBLE) OVER () * 1.5::DOUBLE
          - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS tried
  FROM per),
figures AS (
  SELECT *, coalesce(least(cap, weight * line), cap) AS target
  FROM (SELECT *, arg_min(tried, cap / weight * 1.0::DOUBLE) FILTER (tried <= cap / weight) OVER () AS line FROM tried)),
queued AS (
  SELECT d.doc_id, d.source, d.size, f.source_size, f.rank, f.weight, f.line, f.budget, f.target,
         sum(d.size) OVER (PARTITION BY f.rank ORDER BY d.at, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN figures f ON d.source IS NOT DISTINCT FROM f.source),
copies AS (
  SELECT rank, size, line, budget, ((upto + source_size * k) / weight)::DOUBLE AS finish FROM queued, (VALUES (0), (1)) AS t(k)),
served AS (
  SELECT rank, any_value(line) AS line, any_value(budget) AS budget, coalesce(sum(CASE WHEN finish <= line THEN size END), 0) AS served,
         min(CASE WHEN finish > line THEN {'finish': finish, 'size': size} END) AS next
  FROM copies GROUP BY rank),
cuts AS (
  SELECT rank, CASE WHEN next IS NOT NULL AND sum(next.size) OVER (ORDER BY next.finish NULLS LAST, rank) <= budget - sum(served) OVER ()
                    THEN next.finish ELSE line END AS cut FROM served)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * CASE WHEN cut IS NULL THEN 2 ELSE (upto / weight <= cut)::INT + ((upto + source_size) / weight <= cut)::INT END)::BIGINT AS taken, source
FROM queued JOIN cuts USING (rank)
"""

OP2 = f"""
WITH p AS (
  SELECT page_id,
         {_LOWER.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(h, p, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                            ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT page_id, host, path, r.h || r.p AS rule, r.verdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(r.h || r.p) DESC, length(r.h) DESC) AS place
  FROM (SELECT DISTINCT * FROM p) JOIN r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM fits WHERE place = 1) f
  ON p.page_id IS NOT DISTINCT FROM f.page_id AND p.host = f.host AND p.path = f.path
"""

OP4 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))) END AS s
  FROM d),
n AS (SELECT r, doc_id, len(s) AS n, md5(array_to_string(list_sort(s), chr(10))) AS class FROM sets),
reps AS (SELECT min(r) AS r, class, any_value(n) AS n FROM n WHERE n > 0 GROUP BY class),
e AS (SELECT r, unnest(s) AS x FROM sets WHERE r IN (SELECT r FROM reps)),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.r < b.r GROUP BY ALL),
links AS (
  SELECT p.class AS a, q.class AS b FROM common JOIN reps p ON p.r = a JOIN reps q ON q.r = b WHERE 100 * c >= 90 * (p.n + q.n - c)),
pairs AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT class, class FROM reps UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a),
ids AS (SELECT class, min(doc_id) AS id FROM n GROUP BY class),
component AS (SELECT a AS class, min(id) AS id FROM reach JOIN ids ON ids.class = reach.b GROUP BY a)
SELECT doc_id, n::BIGINT AS n_shingles, coalesce(CASE WHEN n > 0 THEN id END, doc_id) AS component_id FROM n LEFT JOIN component USING (class)
"""

_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP7 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}'), lambda x: x <> '') AS w
  FROM documents),
i AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}'), lambda x: x <> '') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS said
  FROM i, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS u(s) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM win),
said_at AS (SELECT r, len(w) AS words, unnest(w) AS x, generate_subscripts(w, 1) AS s FROM d),
ahead AS (SELECT r, words, s, [x, {", ".join(f"lead(x, {k}) OVER o" for k in range(1, 10))}] AS next FROM said_at WINDOW o AS (PARTITION BY r ORDER BY s)),
places AS (SELECT r, s, n, array_to_string(next[1 : n], ' ') AS said FROM ahead, lengths WHERE s + n - 1 <= words),
hits AS (SELECT r, s, p.n, item FROM places p JOIN win USING (n, said)),
hit_words AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS k FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN items USING (r)
"""

OP8 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.r <> c.r),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, place::INT AS rank, vec_id, score FROM k WHERE place <= 20
"""


def _op9() -> str:
    strings = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]::VARCHAR[]"
    rows = []
    for label, notice in op9_licenses.TEMPLATES:
        said = op9_licenses.words(notice)
        m = len(set(said))
        long = m >= op9_licenses.SHORT
        least = -(-m * int(100 * op9_licenses.CONTAINMENT) // 100) if long else m
        rows.append(f"('{label}', {strings(sorted(set(said)))}, {strings(sorted(op9_licenses.TELLING[label] & set(said)))}, {strings(op9_licenses.OTHERS.get(label, ()))}, {len(said) + (len(said) // 4 if long else 0)}, {least})")
    phrases = " UNION ALL ".join(
        f"SELECT r, '{label}' AS label, k FROM numbered WHERE {' AND '.join(f'list_extract(w, k + {i + 1}) = {x!r}' for i, x in enumerate(op9_licenses.words(p)))}" for p, label in op9_licenses.PHRASES
    )
    return f"""
WITH t(label, own, telling, others, span, least) AS (VALUES {", ".join(rows)}),
d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}'), lambda x: x <> '') AS w
  FROM documents),
numbered AS (SELECT r, w, unnest(range(0, len(w))) AS k FROM d WHERE len(w) > 0),
base AS ({phrases}),
runs AS (
  SELECT r, label, telling, others, least, len(own) AS m, list_distinct(w[k + 1 : k + span]) AS run, own
  FROM numbered JOIN t ON list_contains(own, w[k + 1])),
held AS (SELECT r, label, least, m, len(list_intersect(run, own)) AS n FROM runs WHERE list_has_all(run, telling) AND NOT list_has_any(run, others)),
met AS (SELECT r, label, n / m AS share FROM held WHERE n >= least),
found AS (SELECT r, label FROM base UNION SELECT r, label FROM met),
labels AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels FROM found GROUP BY r),
bases AS (SELECT r, count(*) AS n, min(k) AS first, max(k) AS last, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY r),
best AS (SELECT r, max(share) AS share FROM met GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.first::BIGINT AS first_word, b.last::BIGINT AS last_word,
       coalesce(b.labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
       CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN bases b USING (r) LEFT JOIN labels l USING (r) LEFT JOIN best USING (r)
"""


def _op10() -> str:
    marks = " + ".join(f"(length(t) - length(replace(t, '{s}', ''))) // {len(s)}" for s in op10_chat.CONTROL)
    role_marks = marks.replace("(t)", "(role)").replace("(t,", "(role,")
    slashes = lambda c: f"length({c}) - length(replace({c}, chr(92), ''))"
    known = " ".join(f"WHEN '{r}' THEN {len(a) + len(z)}" for r, (a, z) in op10_chat.MARKS.items())
    probe = op10_chat.PROBE
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{probe}'), (-7, 1, 'assistant', '{probe}')),
f AS (
  SELECT *, length(t) + {slashes("t")} + {marks}
         + CASE role {known} ELSE {len("<|role|><|text|><|end|>")} + length(role) + {slashes("role")} + {role_marks} END AS chars FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(t) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN t END, '' ORDER BY turn, role, t), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


OP11 = r"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
  FROM conversations),
crc AS (
  SELECT place, xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(place, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
                    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 20 AS h
  FROM (SELECT DISTINCT place FROM given)),
hurt AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS time
  FROM given JOIN crc USING (place) WHERE h <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) AS k
  FROM (SELECT *, md5(length(role)::VARCHAR || ':' || role || text) AS digest FROM hurt)),
judged AS (
  SELECT conv_id, k, turn, role, text, left(role, 1) AS initial,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
              WHEN k > min(k) OVER (PARTITION BY conv_id, role, text) THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault
  FROM placed),
faults AS (
  SELECT conv_id, max(k) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM judged) GROUP BY conv_id),
-- From the last row to the first: the cheapest way on, in each state (nothing yet, after s, after u, after a).
way(conv_id, k, w0, w1, w2, w3) AS (
  SELECT conv_id, n + 1, {'c': 0::BIGINT, 'a': ''}, {'c': 10::BIGINT, 'a': 'II'}, {'c': 5::BIGINT, 'a': 'I'}, {'c': 0::BIGINT, 'a': ''} FROM faults
  UNION ALL
  SELECT conv_id, k, least(b0, {'c': b2.c + 5, 'a': 'I' || b2.a}, {'c': b3.c + 10, 'a': 'II' || b3.a}),
         least(b1, {'c': b2.c + 5, 'a': 'I' || b2.a}, {'c': b3.c + 10, 'a': 'II' || b3.a}),
         least(b2, {'c': b3.c + 5, 'a': 'I' || b3.a}), least(b3, {'c': b2.c + 5, 'a': 'I' || b2.a})
  FROM (
    SELECT way.conv_id, j.k,
           least({'c': w0.c + 2, 'a': 'D' || w0.a}, {'c': w2.c + e + 1, 'a': 'R' || w2.a}, {'c': w1.c + e + ks, 'a': 'K' || w1.a}, {'c': w2.c + e + ku, 'a': 'K' || w2.a}) AS b0,
           least({'c': w1.c + 2, 'a': 'D' || w1.a}, {'c': w2.c + e + 1, 'a': 'R' || w2.a}, {'c': w2.c + e + ku, 'a': 'K' || w2.a}) AS b1,
           least({'c': w2.c + 2, 'a': 'D' || w2.a}, {'c': w3.c + e + 1, 'a': 'R' || w3.a}, {'c': w3.c + e + ka, 'a': 'K' || w3.a}) AS b2,
           least({'c': w3.c + 2, 'a': 'D' || w3.a}, {'c': w2.c + e + 1, 'a': 'R' || w2.a}, {'c': w2.c + e + ku, 'a': 'K' || w2.a}) AS b3
    FROM way JOIN (
      SELECT conv_id, k, CASE fault WHEN '' THEN 0 WHEN 't' THEN 5 ELSE 1000000000 END AS e,
             CASE initial WHEN 's' THEN 0 ELSE 1000000000 END AS ks, CASE initial WHEN 'u' THEN 0 ELSE 1000000000 END AS ku,
             CASE initial WHEN 'a' THEN 0 ELSE 1000000000 END AS ka
      FROM judged) j ON j.conv_id IS NOT DISTINCT FROM way.conv_id AND j.k = way.k - 1)),
best AS (SELECT conv_id, w0.c AS cost, w0.a AS audit FROM way WHERE k = 1),
edits AS (
  SELECT conv_id, i, edit, count(*) FILTER (edit <> 'I') OVER o AS k, count(*) FILTER (edit <> 'D') OVER o AS place
  FROM (SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS i FROM best WHERE audit <> '')
  WINDOW o AS (PARTITION BY conv_id ORDER BY i)),
made AS (
  SELECT e.conv_id, edit, place, role, coalesce(CASE WHEN edit <> 'I' THEN text END, '') AS text,
         max(CASE WHEN edit = 'K' AND place = 1 AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS s
  FROM edits e LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM e.conv_id AND j.k = e.k WHERE edit <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY place) AS said
  FROM made GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""

_CRC32 = r"""xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split({}, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
                    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""

OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
crc AS (SELECT doc_id, {_CRC32.format("doc_id::VARCHAR")} AS h FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
turns AS (
  SELECT r, len(w) AS n, (h // 10) % len(w) AS a, 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) AS p
  FROM d JOIN crc USING (doc_id) WHERE h % 10 = 0 AND len(w) > 0),
given AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM d),
placed AS (SELECT r, i, coalesce(CASE WHEN i >= a THEN a + (i - a) % p END, i) AS j FROM given LEFT JOIN turns USING (r)),
said AS (SELECT p.r, p.i, g.x FROM placed p JOIN given g ON g.r = p.r AND g.i = p.j),
five AS (
  SELECT r, i, [x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o] AS x, lead(i, 4) OVER o AS whole
  FROM said WINDOW o AS (PARTITION BY r ORDER BY i)),
-- A run of period q agrees with itself q words on, for five words at least from each of its first places.
agree AS (
  SELECT a.r, a.i, b.i - a.i AS q FROM five a JOIN five b ON a.r = b.r AND a.x = b.x AND b.i > a.i JOIN d ON d.r = a.r
  WHERE a.whole IS NOT NULL AND b.whole IS NOT NULL AND 4 * (b.i - a.i) <= len(w)),
stretches AS (
  SELECT r, q, min(i) AS start, count(*) + 4 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS part FROM agree) GROUP BY r, q, part
  HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM stretches s WHERE NOT EXISTS (
    SELECT 1 FROM stretches t WHERE t.r = s.r AND t.q < s.q AND s.q % t.q = 0 AND t.start <= s.start AND t.start + t.length >= s.start + s.length)),
told AS (SELECT r, count(*) AS n, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS said FROM runs GROUP BY r),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY length::DOUBLE / q DESC, start, q) AS place FROM runs) WHERE place = 1),
gone AS (SELECT DISTINCT r, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS said FROM said ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(t.n, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length, b.q::BIGINT AS period,
       (1000 * b.length // b.q)::BIGINT AS exponent_milli, sha256(coalesce(t.said, '')) AS runs_sha256, sha256(coalesce(k.said, '')) AS collapsed_sha256
FROM d LEFT JOIN told t USING (r) LEFT JOIN best b USING (r) LEFT JOIN kept k USING (r)
"""

ORACLE_SQL = {
    "op1_mix_sources": OP1,
    "op2_url_filters": OP2,
    "op4_ngram_jaccard": OP4,
    "op7_benchmark_hits": OP7,
    "op8_exact_topk": OP8,
    "op9_license_scan": _op9(),
    "op10_chat_format": _op10(),
    "op11_conversation_repair": OP11,
    "op13_periodic_runs": OP13,
}
