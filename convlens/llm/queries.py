"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convlens.llm import (
    centroids, chat, decontaminate, fingerprints, licenses, mixing, packing, prefix_trie, quality, simhash, token_counts, toxicity, urls,
)
from convlens.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_simhash_near_dedup(spark, folder):
    return simhash.groups(table(spark, folder, "documents"), shingle=3, max_bits=3)


@query
def op8_toxicity(spark, folder):
    docs, labels = (table(spark, folder, t) for t in ("documents", "labels"))
    kept = ("doc_id", "p_low_quality", "p_toxic", "p_toxic_low_quality", "rejected")
    return toxicity.judge(docs.select("doc_id", "text"), labels).select(*kept)


@query
def op3_benchmark_decontamination(spark, folder):
    docs, items = (table(spark, folder, t) for t in ("documents", "benchmark"))
    found = decontaminate.passages(docs.select("text"), items)
    places = docs.select("doc_id", decontaminate.digest_of(F.col("text")).alias("digest"))
    return places.join(found, "digest").select("doc_id", F.col("item").alias("item_id"), "similarity", "first_word", "n_words")


@query
def op10_token_id_output(spark, folder):
    path = packing.new_path(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    packing.write_blocks(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return packing.read_documents(spark, path)


@query
def op9_source_mixing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    mixed = mixing.with_copies(docs, max_repetition=1.5)
    return mixed.select("doc_id", "source", "n_tokens", F.round("weight", 9).alias("weight"), "copies")


# The exponent in closed form; the partial pass as a running sum over the whole source.
SQL["op9_source_mixing"] = r"""
WITH words AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|1234'), 1, 12) AS BIGINT) AS place
  FROM documents),
totals AS (SELECT source, CAST(sum(n_tokens) AS DOUBLE) AS total FROM words GROUP BY source),
shares AS (SELECT *, total / sum(total) OVER () AS share FROM totals WHERE total > 0),
expo AS (
  SELECT CASE WHEN max(share) = min(share) THEN 0.0
              ELSE greatest(0.0, 1 - ln(1.5) / ln(max(share) / min(share))) END AS a, max(share) AS top FROM shares),
weights AS (
  SELECT source, total, pow(share, a) / sum(pow(share, a)) OVER () AS weight, pow(top / share, 1 - a) AS repetition
  FROM shares, expo
  UNION ALL SELECT source, total, 0.0, 1.0 FROM totals WHERE total = 0),
quota AS (
  SELECT source, weight, CAST(floor(repetition + 1e-9) AS BIGINT) AS passes,
         CAST(greatest(0, floor((repetition - floor(repetition + 1e-9)) * total + 1e-6)) AS BIGINT) AS rest
  FROM weights),
placed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY source ORDER BY place) AS upto FROM words)
SELECT doc_id, p.source, CAST(n_tokens AS BIGINT) AS n_tokens, round(weight, 9) AS weight,
       passes + CAST(rest > 0 AND upto <= rest AS BIGINT) AS copies
FROM placed p JOIN quota q ON p.source IS NOT DISTINCT FROM q.source
"""


@query
def op7_quality_rules(spark, folder):
    return quality.judge(table(spark, folder, "documents"))


# The same counts from rows of words, windows and lines; the same bins from natural logarithms.
SQL["op7_quality_rules"] = r"""
WITH docs AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
places AS (SELECT doc_id, w, unnest(range(len(w) - 7)) AS p FROM docs WHERE len(w) >= 8),
windows AS (SELECT doc_id, p, array_to_string(w[p + 1 : p + 8], ' ') AS g FROM places),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(*) AS n_repeat_words
  FROM (SELECT DISTINCT doc_id, unnest(range(p, p + 8)) AS at FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM docs LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         word_chars / greatest(n_words, 1) AS m1, n_symbols / greatest(n_words, 1) AS m2,
         n_repeat_words / greatest(n_words, 1) AS m3, n_dup_lines / greatest(n_words, 1) AS m4
  FROM base),
long AS (
  SELECT lang, source, unnest([1, 2, 3, 4]) AS m, unnest([m1, m2, m3, m4]) AS v FROM judged WHERE NOT base_failed),
bins AS (
  SELECT lang, source, m, CASE WHEN v < 0.001 THEN 0 ELSE CAST(floor(ln(v / 0.001) / ln(1.02)) AS INTEGER) + 1 END AS bin FROM long),
levels AS (
  SELECT 1 AS lvl, lang, source, m, bin, count(*) AS n FROM bins GROUP BY ALL
  UNION ALL SELECT 2, lang, NULL, m, bin, count(*) FROM bins GROUP BY ALL
  UNION ALL SELECT 3, NULL, NULL, m, bin, count(*) FROM bins GROUP BY ALL),
ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY lvl, lang, source, m ORDER BY bin) AS upto,
         sum(n) OVER (PARTITION BY lvl, lang, source, m) AS whole
  FROM levels),
quartiles AS (
  SELECT lvl, lang, source, m, max(whole) AS docs, min(bin) FILTER (upto >= 0.25 * whole) AS b1, min(bin) FILTER (upto >= 0.75 * whole) AS b3
  FROM ranked GROUP BY ALL),
valued AS (
  SELECT *, CASE WHEN b1 = 0 THEN 0.0 ELSE 0.001 * pow(1.02, b1 - 0.5) END AS q1,
         CASE WHEN b3 = 0 THEN 0.0 ELSE 0.001 * pow(1.02, b3 - 0.5) END AS q3 FROM quartiles),
fence AS (
  SELECT lvl, lang, source, m, docs, q3 + 3 * greatest(q3 - q1, [0.5, 0.05, 0.1, 0.02][m]) AS high,
         CASE WHEN m = 1 THEN q1 - 3 * greatest(q3 - q1, 0.5) ELSE -1 END AS low FROM valued),
applied AS (
  SELECT j.doc_id, f.lvl, f.docs, bool_and([m1, m2, m3, m4][f.m] BETWEEN f.low AND f.high) AS inside
  FROM judged j JOIN fence f
    ON (f.lvl = 1 AND f.lang IS NOT DISTINCT FROM j.lang AND f.source IS NOT DISTINCT FROM j.source)
    OR (f.lvl = 2 AND f.lang IS NOT DISTINCT FROM j.lang) OR f.lvl = 3
  WHERE NOT j.base_failed GROUP BY ALL),
chosen AS (
  SELECT doc_id, arg_min(inside, lvl) AS inside FROM applied WHERE docs >= 50 OR lvl = 3 GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(inside, true) AS kept
FROM judged LEFT JOIN chosen USING (doc_id)
"""


@query
def op5_url_filter(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    labelled = urls.numbered_labels(pages, table(spark, folder, "labels"))
    rules = [
        ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
        ("block", "net/es/"), ("block", "net/fr/"),
    ]
    return urls.judge(pages, labelled, rules)


@query
def op2_license_scan(spark, folder):
    found = licenses.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.array_join("sentence_ids", " ").alias("sentence_ids"), F.array_join(F.sort_array("licenses"), " ").alias("licenses"), "license"
    )


def _license_sql() -> str:
    """Lines as rows: those of a paragraph are put together again by a running count of its breaks."""
    known = ", ".join(f"('{s}', '{n}')" for n, s in licenses.SENTENCES.items())
    rules = ", ".join(f"({i}, '{n}', ' {' '.join(r)} ')" for i, (n, r) in enumerate(licenses.RULES))
    leader = r"^[ \t]*(?:/\*+|\*+/|\*+|//+|#+|--+|;+|%+|<!--+|dnl\b|rem\b)[ \t]*"
    heads = "mit|isc|apache|bsd|gnu [a-z ]*general public|mozilla public|eclipse public"
    return rf"""
WITH known(sentence, id) AS (VALUES {known}), rules(place, name, run) AS (VALUES {rules}),
tagged AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '(?i)(SPDX-License-Identifier):[ \t]*', '\1 ', 'g') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(range(len(l))) AS nr, unnest(l) AS line
  FROM (SELECT doc_id, string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)) AS l FROM tagged)),
bare AS (
  SELECT doc_id, nr, regexp_replace(line, '{leader}', '') AS line,
         coalesce(lag(regexp_matches(line, '{leader}')) OVER (PARTITION BY doc_id ORDER BY nr), false) AND NOT regexp_matches(line, '{leader}') AS torn
  FROM lines),
kinds AS (
  SELECT *, regexp_full_match(line, '[ \t]*') AS blank,
         regexp_full_match(line, '(?i)[ \t]*((?:copyright[ \t]+(?:\(c\)|(?:19|20)[0-9][0-9])|\(c\)|all rights reserved|spdx-license-identifier).*|(?:the )?(?:{heads}) licen[cs]e(?: \(mit\)| \(isc\))?[ \t]*)') AS alone
  FROM bare),
grouped AS (
  SELECT doc_id, nr, line, blank,
         sum(CAST(blank OR alone OR torn AS INTEGER)) OVER w + coalesce(sum(CAST(alone AS INTEGER)) OVER b, 0) AS part
  FROM kinds WINDOW w AS (PARTITION BY doc_id ORDER BY nr), b AS (PARTITION BY doc_id ORDER BY nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
joined AS (SELECT doc_id, min(nr) AS nr, string_agg(line, ' ' ORDER BY nr) AS t FROM grouped WHERE NOT blank GROUP BY doc_id, part),
texts AS (
  SELECT doc_id, 1 AS way, 0 AS nr, text AS t FROM tagged
  UNION ALL SELECT doc_id, 2, nr, t FROM joined),
cut AS (
  SELECT doc_id, way, nr, unnest(range(len(s))) AS pos, unnest(s) AS sentence
  FROM (SELECT doc_id, way, nr, string_split(regexp_replace(t, '[.!?;:]+[ 	-
]+', chr(10), 'g'), chr(10)) AS s FROM texts)),
hits AS (
  SELECT doc_id, way, nr, pos, id FROM cut JOIN known
    ON trim(regexp_replace(lower(cut.sentence), '[^a-z0-9]+', ' ', 'g')) = known.sentence),
runs AS (SELECT doc_id, way, string_agg(id, ' ' ORDER BY nr, pos) AS ids, count(*) AS n FROM hits GROUP BY doc_id, way),
named AS (
  SELECT doc_id, string_agg(DISTINCT name, ' ' ORDER BY name) AS licenses, arg_min(name, place - 1000 * way) AS license
  FROM runs JOIN rules ON contains(' ' || ids || ' ', run) GROUP BY doc_id),
longest AS (SELECT doc_id, arg_max(ids, n * 10 - way) AS ids FROM runs GROUP BY doc_id)
SELECT d.doc_id, coalesce(ids, '') AS sentence_ids, coalesce(licenses, '') AS licenses, license
FROM documents d LEFT JOIN longest USING (doc_id) LEFT JOIN named USING (doc_id)
"""


SQL["op2_license_scan"] = _license_sql()


@query
def op6_token_counts(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.with_counts(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


@query
def op4_chat_formatting(spark, folder):
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    texts = stage(chat.formatted(chat.canonical(rows, "conv_id"), "conv_id"))
    return chat.read_back(texts, "conv_id")


def _chat_sql() -> str:
    escaped = r"replace(text, '\', '\\')"
    for c in sorted(chat.CONTROL, key=len, reverse=True):
        escaped = f"replace({escaped}, '{c}', '{c[0]}\\{c[1:]}')"
    marks = " ".join(f"WHEN '{r}' THEN {len(a) + len(b)}" for r, (a, b) in chat.TURN.items())
    return f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(t, r)),
sized AS (
  SELECT *, length({escaped}) + CASE role {marks} END AS size FROM said)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


SQL["op4_chat_formatting"] = _chat_sql()


@query
def op11_conversation_prefix_trie(spark, folder):
    marked = stage(prefix_trie.marks(table(spark, folder, "conversations")))
    source = F.col("id") - F.col("id") % 5
    head = F.crc32(F.col("id").cast("string").cast("binary")) % 9
    rebuilt, ids = prefix_trie.spliced(marked, source, head, longest=8)
    return prefix_trie.trie(rebuilt, ids)


# Prefixes as whole strings of digests; every node meets all nodes below it. The checksum bit by bit.
SQL["op11_conversation_prefix_trie"] = """
WITH marked AS (
  SELECT conv_id AS id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) AS place, mark, size
  FROM (SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark,
               CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS size
        FROM conversations WHERE conv_id IS NOT NULL)),
talks AS (
  SELECT id, id - id % 5 AS source, turns,
         xor(list_reduce(
           [CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
           lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))
         ), 4294967295) % 9 AS head
  FROM (SELECT id, count(*) AS turns FROM marked GROUP BY id)),
plan AS (SELECT t.*, least(t.head, coalesce(s.turns, 0)) AS taken FROM talks t LEFT JOIN talks s ON s.id = t.source),
rebuilt AS (
  SELECT p.id, m.place, mark, size FROM plan p JOIN marked m ON m.id = p.source AND m.place <= p.taken
  UNION ALL SELECT p.id, m.place - head + taken, mark, size FROM plan p JOIN marked m ON m.id = p.id AND m.place > head),
prefixes AS (
  SELECT id, place AS depth, md5(string_agg(mark, '') OVER (PARTITION BY id ORDER BY place)) AS k, size,
         place = max(place) OVER (PARTITION BY id) AS last
  FROM rebuilt
  UNION ALL SELECT id, 0, '', 0, NOT EXISTS (SELECT 1 FROM rebuilt r WHERE r.id = plan.id) FROM plan),
nodes AS (
  SELECT depth, k, min(id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved, bool_and(last) AS leaf,
         sha256(coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FILTER (last), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, k),
below AS (SELECT DISTINCT a.k AS k, a.depth AS depth, b.k AS bk, b.depth AS bdepth FROM prefixes a JOIN prefixes b ON a.id = b.id AND b.depth >= a.depth),
totals AS (
  SELECT w.k, w.depth, count(*) FILTER (w.bdepth = w.depth + 1) AS n_children, count(*) FILTER (n.leaf) AS n_leaves,
         CAST(sum(n.saved) AS BIGINT) AS saved_tokens
  FROM below w JOIN nodes n ON n.k = w.bk AND n.depth = w.bdepth GROUP BY w.k, w.depth),
parents AS (SELECT DISTINCT w.bk AS k, w.bdepth AS depth, n.conv_id AS parent_conv_id
            FROM below w JOIN nodes n ON n.k = w.k AND n.depth = w.depth WHERE w.bdepth = w.depth + 1)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM nodes JOIN totals USING (k, depth) LEFT JOIN parents USING (k, depth)
"""


@query
def op12_centroid_clustering(spark, folder):
    return centroids.cluster(table(spark, folder, "embeddings"), dimension=64, k=8, rounds=10, factor=1024, seed=3)


def _cluster_sql(rounds: int = 10, k: int = 8) -> str:
    """Every round as one more table: components as rows, distances as sums over them."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS MATERIALIZED (
  SELECT vec, cluster, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS away FROM parts v JOIN c{r} c USING (dim) GROUP BY vec, cluster),
a{r} AS MATERIALIZED (SELECT vec, arg_min(cluster, away * {k} + cluster) AS cluster, min(away) AS away FROM d{r} GROUP BY vec)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (SELECT cluster, dim, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM parts JOIN a{r} USING (vec) GROUP BY cluster, dim),
c{r + 1} AS MATERIALIZED (
  SELECT c.cluster, c.dim, CASE WHEN n IS NULL THEN c.x ELSE (s - ((s % n) + n) % n) // n END AS x
  FROM c{r} c LEFT JOIN s{r} s ON s.cluster = c.cluster AND s.dim = c.dim)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS vec, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
parts AS MATERIALIZED (SELECT vec, unnest(v) AS x, generate_subscripts(v, 1) AS dim FROM kept),
starts AS (
  SELECT vec, row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS cluster FROM kept QUALIFY cluster < {k}),
c0 AS MATERIALIZED (SELECT cluster, dim, x FROM parts JOIN starts USING (vec)),{",".join(steps)},
digests AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, away AS distance, CAST(sum(away) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(away) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (vec) JOIN digests USING (cluster)
"""


SQL["op12_centroid_clustering"] = _cluster_sql()


@query
def op13_document_fingerprints(spark, folder):
    return fingerprints.versions(table(spark, folder, "documents"))
