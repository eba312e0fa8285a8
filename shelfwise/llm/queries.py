"""One query per operator of this package, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    collocations, decontaminate, imatch, lines, near, pieces, quality, rules, runs, sharding,
    substring, token_counts, urls,
)
from shelfwise.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def content(name: str) -> bytes:
    """A vocabulary file, read on the driver and sent with the tasks."""
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


@query
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.deduplicated(table(spark, folder, "documents")).drop("removed")


@query
def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.labelled(table(spark, folder, "documents"))


@query
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """A row without an id has no label and is not held out."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    held_out = F.coalesce(remainder == 0, F.lit(False))
    vectors = quality.word_table(documents)
    network = quality.train(documents, labels.filter(~held_out), vectors)
    scored = quality.scores(documents, vectors, network)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(table(spark, folder, "pages"))


@query
def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.digest(decontaminate.contamination(documents, benchmark))


@query
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.counts(
        table(spark, folder, "documents"), content("byte_bpe_50k.json").decode()
    )


@query
def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(table(spark, folder, "documents"), content("piece_bpe_32k.model"))


@query
def op8_shard(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shuffled(table(spark, folder, "documents"))


def vocabulary() -> rules.Vocabulary:
    return rules.Vocabulary(content("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.measures(table(spark, folder, "documents"), vocabulary())


@query
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.digest(table(spark, folder, "documents"))


@query
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


@query
def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.fingerprints(table(spark, folder, "documents"))


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, folder, "documents"), insert=True)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ORACLES["op1_substring_dedup"] = r"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
g AS (
  SELECT rid, doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) AS gram
  FROM (SELECT *, unnest(generate_series(1, len(words) - 49)) AS i FROM w WHERE len(words) >= 50)),
m AS (SELECT gram, min(doc_id) AS least FROM g GROUP BY gram HAVING min(doc_id) < max(doc_id)),
hit AS (
  SELECT rid, list(DISTINCT k) AS gone
  FROM (SELECT rid, unnest(generate_series(i, i + 49)) AS k
        FROM g JOIN m USING (gram) WHERE least < doc_id)
  GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN gone IS NULL THEN array_to_string(words, ' ') ELSE array_to_string(
    list_filter(list_transform(generate_series(1, len(words)),
      lambda k: CASE WHEN list_contains(gone, k) THEN NULL ELSE words[k] END),
      lambda x: x IS NOT NULL), ' ') END) AS kept_sha256
FROM w LEFT JOIN hit USING (rid)
"""

ORACLES["op2_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 2 THEN words[1] ELSE words[i] || ' ' || words[i + 1] END AS shingle
  FROM (SELECT *, unnest(generate_series(1, greatest(len(words) - 1, 1))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
reach(id, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.id WHERE reach.root < link.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.root AS component_id,
  d.doc_id = r.root AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT id, min(root) AS root FROM reach GROUP BY id) r ON r.id = d.doc_id
"""

ORACLES["op5_decontaminate"] = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size,
    array_to_string(words[i : i + least(len(words), 10) - 1], ' ') AS gram
  FROM (SELECT *, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS i FROM b
        WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM p),
g AS (
  SELECT rid, i, size, array_to_string(words[i : i + size - 1], ' ') AS gram
  FROM (SELECT w.*, s.size, unnest(generate_series(1, len(words) - s.size + 1)) AS i
        FROM w, sizes s WHERE len(words) >= s.size)),
h AS (SELECT rid, i, g.size, item_id FROM g JOIN p USING (size, gram)),
hit AS (SELECT rid, count(DISTINCT k) AS n_hit
        FROM (SELECT rid, unnest(generate_series(i, i + size - 1)) AS k FROM h) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL)
  GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""

ORACLES["op10_line_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, text, source,
    string_split(coalesce(text, ''), chr(10)) AS parts
  FROM documents),
l AS (
  SELECT rid, source, i, parts[i] AS line
  FROM (SELECT *, unnest(generate_series(1, len(parts))) AS i FROM d)
  WHERE regexp_matches(parts[i], '[^\x20\x09-\x0D]')),
wide AS (SELECT line FROM l WHERE source IS NOT NULL GROUP BY line HAVING count(DISTINCT source) >= 10),
n AS (
  SELECT rid, count(*) AS n_lines, count(wide.line) AS n_boilerplate,
    list(i) FILTER (wide.line IS NOT NULL) AS places
  FROM l LEFT JOIN wide USING (line) GROUP BY rid),
c AS (
  SELECT d.*, coalesce(n_lines, 0) AS n_lines, coalesce(n_boilerplate, 0) AS n_boilerplate, places,
    CASE WHEN n_boilerplate = n_lines OR count(*) OVER (PARTITION BY text) > 1 THEN 0
      ELSE coalesce(n_boilerplate, 0) END AS n_removed
  FROM d LEFT JOIN n USING (rid))
SELECT doc_id, n_lines, n_boilerplate, n_removed, sha256(CASE WHEN n_removed = 0
  THEN coalesce(text, '') ELSE array_to_string([parts[i] FOR i IN generate_series(1, len(parts))
  IF NOT list_contains(places, i)], chr(10)) END) AS kept_sha256
FROM c
"""

ORACLES["op11_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, w[i : i + size - 1] AS g
  FROM (SELECT lang, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM w, (VALUES (1), (2), (3)) AS sizes(size) WHERE len(w) >= size)),
f AS (SELECT lang, g, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY lang, g),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE len(g) = 1 GROUP BY lang),
c AS (SELECT lang, g, f AS a FROM f WHERE len(g) > 1 AND f >= 10),
inner_parts AS (
  SELECT lang, part, max(a) AS most
  FROM (SELECT lang, a, unnest([g[1:2], g[2:3]]) AS part FROM c WHERE len(g) = 3) GROUP BY lang, part),
kept AS (
  SELECT c.* FROM c LEFT JOIN inner_parts o ON o.lang = c.lang AND o.part = c.g
  WHERE o.most IS NULL OR 100 * o.most < 50 * c.a),
cut AS (
  SELECT k.lang, k.g, k.a, k.first_words, x.f AS l, y.f AS r, 1000000 * k.a * k.a // (x.f * y.f) AS score
  FROM (SELECT *, unnest(generate_series(1, len(g) - 1)) AS first_words FROM kept) k
  JOIN f x ON x.lang = k.lang AND x.g = k.g[1 : k.first_words]
  JOIN f y ON y.lang = k.lang AND y.g = k.g[k.first_words + 1 : len(k.g)]),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, first_words) = 1),
ranked AS (
  SELECT *, array_to_string(g, ' ') AS phrase FROM low),
top AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
  CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM top JOIN n USING (lang) WHERE rank <= 2000
"""

ORACLES["op13_periodic_runs"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(4294967295, list_reduce(
      list_concat([4294967295], [ascii(x) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
      lambda c, b: list_reduce(list_concat([xor(c, CAST(b AS BIGINT))], range(8)),
        lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))) AS h
  FROM documents),
g AS (SELECT *, len(w) AS n, h // 10 AS g, (h // 10) % len(w) AS a FROM d),
t AS (
  SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
    list_concat(w[1 : a], [w[a + 1 + (i % (1 + (n - a) // (3 + g % 8)))] FOR i IN range(n - a)]) ELSE w END AS w
  FROM g),
f AS (
  SELECT rid, i, n // 4 AS most, md5(array_to_string(w[i : i + 4], ' ')) AS five
  FROM (SELECT rid, w, n, unnest(generate_series(1, n - 4)) AS i FROM t WHERE n >= 6)),
m AS (
  SELECT x.rid, x.i, y.i - x.i AS q FROM f x JOIN f y ON x.rid = y.rid AND x.five = y.five
  AND y.i - x.i BETWEEN 1 AND x.most),
s AS (
  SELECT rid, q, min(i) - 1 AS start, count(*) + 4 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM m)
  GROUP BY rid, q, island HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
r AS (SELECT rid, start, length, min(q) AS period FROM s GROUP BY rid, start, length),
top AS (
  SELECT * FROM r x WHERE NOT EXISTS (
    SELECT 1 FROM r y WHERE y.rid = x.rid AND (y.length * x.period > x.length * y.period
      OR (y.length * x.period = x.length * y.period AND (y.start, y.period) < (x.start, x.period))))),
listed AS (
  SELECT rid, count(*) AS n_runs,
    string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines
  FROM r GROUP BY rid),
gone AS (
  SELECT rid, list(DISTINCT i) AS gone
  FROM (SELECT rid, unnest(generate_series(start + period + 1, start + length)) AS i FROM r) GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start,
  CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period,
  CAST(1000 * length // period AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
    [w[i] FOR i IN generate_series(1, n) IF NOT list_contains(gone, i)] END, ' ')) AS collapsed_sha256
FROM t LEFT JOIN top USING (rid) LEFT JOIN listed USING (rid) LEFT JOIN gone USING (rid)
"""

ORACLES["op12_fingerprints"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n
  FROM documents),
o AS (
  SELECT *, coalesce(lead(rid) OVER w, first_value(rid) OVER w) AS next_rid,
    coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text
  FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (
  SELECT *, concat(substring(text, 1, n - n // 3), substring(next_text, 1, n // 3)) AS edited FROM o),
v AS (
  SELECT rid, edited AS is_edited, t
  FROM (SELECT rid, false AS edited, text AS t FROM e UNION ALL SELECT rid, true, edited FROM e)),
t AS (
  SELECT rid, is_edited, unnest(list_distinct(list_filter(
    regexp_split_to_array(lower(t), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> ''))) AS term
  FROM v),
band AS (
  SELECT term, sha256(term) AS s FROM t WHERE NOT is_edited GROUP BY term
  HAVING count(*) * 50 <= (SELECT count(*) FROM d) AND count(*) * 2000 >= (SELECT count(*) FROM d)),
lex AS (
  SELECT term, draw, CAST(value < 32 AS INT) + CAST(value < 8 AS INT) + CAST(value < 2 AS INT) AS depth, own
  FROM (
    SELECT term, draw, CAST('0x' || substr(s, 3 * draw + 1, 3) AS INT) AS value,
      CAST('0x' || substr(s, 49, 6) AS INT) AS own
    FROM (SELECT *, unnest(range(16)) AS draw FROM band))
  WHERE value < 128),
held AS (
  SELECT DISTINCT rid, is_edited, draw, depth, ((draw * 4 + depth) << 24) + own AS code FROM t JOIN lex USING (term)),
signature AS (
  SELECT rid, is_edited, draw, least, substr(md5(string_agg(code, ',' ORDER BY code)), 1, 6) AS signature
  FROM (SELECT *, unnest(range(depth + 1)) AS least FROM held) GROUP BY ALL),
places AS (SELECT rid, is_edited, draw, least FROM (SELECT DISTINCT rid, is_edited FROM held), range(16) a(draw), range(4) b(least)),
written AS (
  SELECT rid, is_edited, string_agg(coalesce(signature, '------'), '' ORDER BY draw, least) AS f
  FROM places LEFT JOIN signature USING (rid, is_edited, draw, least) GROUP BY ALL),
f AS (
  SELECT v.rid, v.is_edited, coalesce(f, repeat(substr(md5(t), 1, 6), 64)) AS f
  FROM v LEFT JOIN written USING (rid, is_edited)),
x AS (
  SELECT e.doc_id, CAST(e.n AS BIGINT) AS n_chars, sha256(e.edited) AS edited_sha256,
    own.f AS fingerprint, changed.f AS edited_fingerprint, following.f AS following
  FROM e JOIN f own ON own.rid = e.rid AND NOT own.is_edited
  JOIN f changed ON changed.rid = e.rid AND changed.is_edited
  JOIN f following ON following.rid = e.next_rid AND NOT following.is_edited),
p AS (
  SELECT *, [substr(fingerprint, 6 * i + 1, 6) FOR i IN range(64)] AS a,
    [substr(edited_fingerprint, 6 * i + 1, 6) FOR i IN range(64)] AS b,
    [substr(following, 6 * i + 1, 6) FOR i IN range(64)] AS c
  FROM x),
q AS (
  SELECT *, [i FOR i IN range(1, 65) IF a[i] <> '------' OR b[i] <> '------'] AS ab,
    [i FOR i IN range(1, 65) IF a[i] <> '------' OR c[i] <> '------'] AS ac
  FROM p)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  CASE WHEN len(ab) = 0 THEN 1.0 ELSE len([i FOR i IN ab IF a[i] = b[i]]) / len(ab) END AS near_edited,
  CASE WHEN len(ac) = 0 THEN 1.0 ELSE len([i FOR i IN ac IF a[i] = c[i]]) / len(ac) END AS near_next
FROM q
"""
