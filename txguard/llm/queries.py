"""One query for each operator, over its whole table with production parameters, and the SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.llm import (
    bpe_codec,
    chat_format,
    collocations,
    content_sort,
    decontaminate,
    license_scan,
    main_text,
    merkle,
    near_dup,
    pairwise_quality,
    ring_sharding,
    token_counts,
    toxicity,
)
from txguard.llm.documents import table
from txguard.llm.labelled import held_out
from txguard.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        return function(prepare(spark), directory)

    _REGISTRY[function.__name__] = run
    return run


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _texts(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "documents").select("doc_id", "text")


@query
def op1_recurrent_main_text(spark, directory):
    found = main_text.main_text(table(spark, directory, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op2_bpe_codec(spark, directory):
    codec = bpe_codec.Codec(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = bpe_codec.encode_and_decode(_texts(spark, directory), codec)
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_counterfactual_toxicity(spark, directory):
    docs = _texts(spark, directory)
    out = held_out("doc_id", 4, 2)
    model = toxicity.fit(docs, table(spark, directory, "labels"), ~out)
    return _decided(toxicity.score(docs, model), out)


def _decided(scored: DataFrame, out) -> DataFrame:
    """Scores with the decision at the threshold of the contract."""
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op4_positional_license_scan(spark, directory):
    docs = _texts(spark, directory)
    found = license_scan.scan(docs, license_scan.document_frequencies(docs))
    first = F.transform("licenses.places", lambda place: place["first"])
    return found.select(
        "doc_id",
        F.col("licenses.n_words").alias("n_words"),
        F.size("licenses.places").cast("long").alias("n_base"),
        F.array_min(first).cast("long").alias("first_word"),
        F.array_max(first).cast("long").alias("last_word"),
        F.concat_ws(",", "licenses.base_labels").alias("base_labels"),
        F.concat_ws(",", "licenses.labels").alias("labels"),
        F.col("licenses.score").alias("score"),
    )


@query
def op5_bounded_ring(spark, directory):
    sharded = ring_sharding.assign_shards(_texts(spark, directory))
    return sharded.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query
def op6_content_sort(spark, directory):
    return content_sort.mark_duplicates(_texts(spark, directory))


@query
def op7_heap_token_counts(spark, directory):
    count = token_counts.token_counter(spark, public_tokenizers.path("byte_bpe_50k.json"))
    text = F.coalesce("text", F.lit(""))
    counted = _texts(spark, directory).select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), count(F.col("text")).alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@query
def op8_pairwise_quality(spark, directory):
    docs = _texts(spark, directory)
    out = held_out("doc_id", 5, 0)
    model = pairwise_quality.fit(docs, table(spark, directory, "labels"), ~out)
    return _decided(pairwise_quality.score(docs, model), out)


@query
def op9_wu_manber(spark, directory):
    found = decontaminate.find_passages(_texts(spark, directory), table(spark, directory, "benchmark"))
    hits = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + s["past"] - s["first"])
    ids = F.array_sort(F.col("found.items").cast("array<string>"))
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        hits.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (F.size("found.spans") > 0).alias("contaminated"),
    )


@query
def op10_minhash_postings(spark, directory):
    return near_dup.near_duplicates(_texts(spark, directory))


@query
def op11_cogrouped_merkle(spark, directory):
    def leaf(text):
        return merkle.leaf_hash(*(F.col(name) for name in ("doc_id", "source", "lang", "n_chars")), text)

    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = table(spark, directory, "documents").select(
        "doc_id", "source", leaf(F.col("text")).alias("leaf"), F.when(tampered, leaf(merkle.lowered(F.col("text")))).alias("check")
    )
    return merkle.manifest(leaves, "doc_id", "source", check_col="check").drop("source")


@query
def op12_debruijn_collocations(spark, directory):
    return collocations.collocations(table(spark, directory, "documents").select("lang", "text"))


# The turns of conversation -1, which reads like the marks of a template.
PROBE = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]


@query
def op13_prefix_target_chat(spark, directory):
    turns = table(spark, directory, "conversations").select("conv_id", "turn", "role", "text")
    rows = ", ".join(f"struct(-1L AS conv_id, {k}L AS turn, '{role}' AS role, '{text}' AS text)" for k, (role, text) in enumerate(PROBE))
    probe = spark.range(1).selectExpr(f"inline(array({rows}))")
    return chat_format.digests(chat_format.examples(turns.unionByName(probe)))


def oracles() -> dict[str, str]:
    return {
        "op6_content_sort": CONTENT_SORT,
        "op9_wu_manber": WINDOW_JOIN,
        "op10_minhash_postings": SHINGLE_PAIRS,
        "op11_cogrouped_merkle": COGROUPED_MERKLE,
        "op12_debruijn_collocations": DEBRUIJN_COLLOCATIONS,
        "op13_prefix_target_chat": PREFIX_TARGET_CHAT,
    }


CONTENT_SORT = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER best = 1 AS kept,
       sha256(t) AS text_sha256
FROM d
WINDOW best AS (PARTITION BY t ORDER BY chars DESC, doc_id)
"""

PREFIX_TARGET_CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), p AS (
  SELECT *, role = 'assistant' AS trained,
         length(text) + len(regexp_extract_all(text, '<\\*/?s>|\[\\*((/?(SYS|INST|TURN))|NAME)\]')) +
         CASE role WHEN 'system' THEN 14 WHEN 'user' THEN 16 WHEN 'assistant' THEN 10
           ELSE 24 + length(role) + len(regexp_extract_all(role, '<\\*/?s>|\[\\*((/?(SYS|INST|TURN))|NAME)\]')) END AS size,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
         count(*) OVER (PARTITION BY conv_id) AS turns
  FROM t
), e AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY n) AS prefix FROM p
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (trained), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (trained), '')) AS loss_sha256,
       CAST(sum(prefix) FILTER (trained OR n = turns) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

COGROUPED_MERKLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS key,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') ||
         coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS lead,
         text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents
), leaf AS (
  SELECT doc_id, key, sha256(lead || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(lead || coalesce(strlen(low) || ':' || low, '-')) AS tampered
  FROM d
), bits(n, crc) AS (
  -- the table of CRC-32 by bytes
  SELECT i, i FROM range(256) r(i)
), step(n, crc, k) AS (
  SELECT n, crc, 0 FROM bits
  UNION ALL SELECT n, CASE WHEN crc % 2 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END, k + 1 FROM step WHERE k < 8
), crc_table AS (SELECT n, crc FROM step WHERE k = 8),
crc(doc_id, digits, pos, c) AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR), 1, 4294967295 FROM d WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, digits, pos + 1, xor(crc.c >> 8, t.crc)
  FROM crc JOIN crc_table t ON t.n = xor(crc.c & 255, ord(substr(digits, pos, 1)))
  WHERE pos <= length(digits)
), checked AS (
  SELECT l.*, CASE WHEN xor(c.c, 4294967295) % 5 = 0 THEN tampered ELSE leaf END AS node,
         row_number() OVER (PARTITION BY key ORDER BY l.doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaf l LEFT JOIN crc c ON c.doc_id = l.doc_id AND c.pos > length(c.digits)
), nodes(key, lvl, pos, h, n) AS (
  SELECT key, 0, pos, leaf, count(*) OVER (PARTITION BY key) FROM checked
  UNION ALL
  SELECT key, lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 15) // 16
  FROM nodes WHERE n > 1 GROUP BY key, lvl, pos // 16
), sub AS (
  SELECT key, h, row_number() OVER (ORDER BY key) - 1 AS pos FROM nodes WHERE n = 1
), tops(lvl, pos, h, n) AS (
  SELECT 0, pos, h, count(*) OVER () FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 15) // 16
  FROM tops WHERE n > 1 GROUP BY lvl, pos // 16
), sides AS (
  SELECT key, lvl, pos, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
  FROM nodes WHERE n > 1 WINDOW w AS (PARTITION BY key, lvl, pos // 16 ORDER BY pos)
), top_sides AS (
  SELECT lvl, pos, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
  FROM tops WHERE n > 1 WINDOW w AS (PARTITION BY lvl, pos // 16 ORDER BY pos)
), inner_way(key, leaf_pos, lvl, pos, node, proof) AS (
  SELECT key, pos, 0, pos, node, '' FROM checked
  UNION ALL
  SELECT w.key, leaf_pos, w.lvl + 1, w.pos // 16, sha256(a || node || b), proof || a || b
  FROM inner_way w JOIN sides s ON s.key = w.key AND s.lvl = w.lvl AND s.pos = w.pos
), arrived AS (
  SELECT key, leaf_pos, arg_max(node, lvl) AS node, arg_max(proof, lvl) AS proof FROM inner_way GROUP BY key, leaf_pos
), way(key, leaf_pos, lvl, pos, node, proof) AS (
  SELECT a.key, leaf_pos, 0, sub.pos, node, proof FROM arrived a JOIN sub ON sub.key = a.key
  UNION ALL
  SELECT key, leaf_pos, w.lvl + 1, w.pos // 16, sha256(a || node || b), proof || a || b
  FROM way w JOIN top_sides s ON s.lvl = w.lvl AND s.pos = w.pos
), folded AS (
  SELECT key, leaf_pos, arg_max(node, lvl) AS node, arg_max(proof, lvl) AS proof FROM way GROUP BY key, leaf_pos
)
SELECT c.doc_id, c.leaf, sub.h AS subroot, r.h AS root, sha256(f.proof) AS proof_sha256, f.node AS folded_root, f.node = r.h AS verified
FROM checked c JOIN sub ON sub.key = c.key JOIN folded f ON f.key = c.key AND f.leaf_pos = c.pos, (SELECT h FROM tops WHERE n = 1) r
"""

DEBRUIJN_COLLOCATIONS = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), p AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws
  FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t)
), g AS (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM p, range(1, 6) r(k))
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 100
), within AS (
  SELECT lang, array_to_string(ws[i : i + j - 1], ' ') AS phrase, max(f) AS longest
  FROM (SELECT *, unnest(range(1, k - j + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS j FROM c))
  GROUP BY ALL
), cut AS (
  SELECT c.lang, c.phrase, c.f AS a, n.n, cut, l.f AS l, r.f AS r,
         CAST((CAST(1000 AS HUGEINT) * c.f * n.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN n USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(ws[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(ws[cut + 1 :], ' ')
  LEFT JOIN within w ON w.lang = c.lang AND w.phrase = c.phrase
  WHERE w.longest IS NULL OR 100 * w.longest < 100 * c.f
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""

WINDOW_JOIN = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT item_id, ws, least(10, len(ws)) AS size FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark
  ) WHERE len(ws) > 0
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(ws[i : i + size - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS i FROM b)
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT doc_id, size, i, array_to_string(ws[i : i + size - 1], ' ') AS w
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, sizes)
), hits AS (
  SELECT doc_id, item_id, i, size FROM places JOIN windows USING (size, w)
), covered AS (
  SELECT doc_id, count(DISTINCT at_word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS at_word FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

SHINGLE_PAIRS = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)
), both_ways AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON e.a = r.other
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN sizes ON sizes.doc_id = d.doc_id JOIN least ON least.doc_id = d.doc_id
"""
