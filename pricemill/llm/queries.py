"""The operators of this folder as queries over the whole test tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemill.llm import (
    bpe,
    embeddings,
    manifest,
    mixing,
    nearest,
    packing,
    quality,
    secrets,
    simhash,
    spelling,
    substrings,
    toxicity,
    warc,
)
from pricemill.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return run

    return register


@query("op2_secrets")
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scanned(documents(spark, sf_dir), **secrets.WIDELY)
    base = F.filter("spans", lambda s: s["kind"] < secrets.BASE)

    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        F.col("id").alias("doc_id"),
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("bigint").alias("n_live"),
    )


#: White space that separates words, for DuckDB.
_SPLIT = r"[\x20\x09-\x0D]+"


@query(
    "op3_quality_rules",
    rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, text AS raw, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPLIT}'), lambda w: w <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_replace(x, '{_SPLIT}', '', 'g') <> '') AS ls
  FROM documents
), w AS (
  SELECT r, s, list_slice(ws, s, s + 7) AS win FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS s FROM d)
), c AS (
  SELECT r, s, count(*) OVER (PARTITION BY r, win) AS n FROM w
), rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + 8)) AS p FROM c WHERE n > 1)
  GROUP BY r
), l AS (
  SELECT r, source, raw, lower(regexp_replace(trim(regexp_replace(u, '{_SPLIT}', ' ', 'g')), ' +', ' ', 'g'))
           AS line, len(list_filter(regexp_split_to_array(u, '{_SPLIT}'), lambda w: w <> '')) AS n
  FROM (SELECT r, source, raw, unnest(ls) AS u FROM d)
), h AS (
  SELECT coalesce(source, chr(0)) AS host, count(DISTINCT coalesce('x' || raw, '')) AS n FROM d
  GROUP BY 1
), f AS (
  SELECT t.host, line FROM (
    SELECT coalesce(source, chr(0)) AS host, line, count(DISTINCT raw) AS n FROM l GROUP BY 1, 2) t
  JOIN h ON h.host = t.host WHERE t.n >= 20 AND t.n >= 0.001 * h.n
), sh AS (
  SELECT r, sum(n) AS n FROM l JOIN f ON f.host = coalesce(l.source, chr(0)) AND f.line = l.line
  GROUP BY r
), m AS (
  SELECT doc_id, len(ws) AS n_words, length(regexp_replace(text, '{_SPLIT}', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(sh.n, 0)::BIGINT AS n_shared_words
  FROM d LEFT JOIN rep USING (r) LEFT JOIN sh USING (r)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (n_shared_words > 0 AND
         (n_words - n_shared_words < 20 OR n_words - n_shared_words < 0.3 * n_words)) AS kept
FROM m
""",
)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(documents(spark, sf_dir))
    return found.withColumnRenamed("id", "doc_id")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query(
    "op1_embedding_dedup",
    """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), r AS (
  SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x
), c AS (
  SELECT x, min(y) AS least FROM r GROUP BY x
), n AS (
  SELECT x, count(*) AS n_links FROM l GROUP BY x
)
SELECT vec_id, coalesce(n_links, 0) AS n_links,
       least(vec_id, coalesce(least, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.x = vec_id LEFT JOIN c ON c.x = vec_id
""",
)
def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumnsRenamed({"id": "vec_id", "component": "component_id"})


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of the documents with the CRC-32 of their ids, packed into sequences."""
    found = packing.pieces(docs, tokenizer_path("byte_bpe_50k.json"), capacity=1024, end_id=2)
    found = found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(found, capacity=1024).withColumnRenamed("id", "doc_id")


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string")) % 5
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(remainder != 0)
    found = toxicity.scored(documents(spark, sf_dir), labels).withColumnRenamed("id", "doc_id")
    return found.select(
        "doc_id",
        (remainder == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query(
    "op6_warc",
    """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest
  FROM p
), h AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS head FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND head <> page_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 1000 AND head <> page_id THEN head END AS refers_to
FROM h
""",
)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=4, radius=4)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select(
        F.col("id").alias("doc_id"),
        digits.alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query(
    "op9_repeated_passages",
    rf"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPLIT}'), lambda w: w <> '')
           AS ws
  FROM documents
), w AS (
  SELECT doc_id, s, array_to_string(list_slice(ws, s, s + 19), ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM d)
), g AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) AS n FROM w)
  WHERE n > 1
), k AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS kept, count(*) AS n FROM (
    SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM d) u
  ANTI JOIN g USING (doc_id, p)
  GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
""",
)
def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(documents(spark, sf_dir), width=20)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op8_context_mixing")
def op8_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return mixing.scored(docs.withColumn("held_out", held_out)).withColumnRenamed("id", "doc_id")


@query("op10_bpe_automaton")
def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.tokenized(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
    return found.select(
        F.col("id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op11_nearest",
    """
WITH v AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), d AS (
  SELECT q.vec_id AS query_id, q.e, v.vec_id,
         sqrt(list_sum(list_transform(list_zip(q.e, v.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM v q JOIN v ON q.vec_id % 100 = 0 AND len(q.e) = len(v.e) AND (q.vec_id <> v.vec_id OR q.e <> v.e)
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id, e ORDER BY score, vec_id) AS rank, vec_id,
         score
  FROM d
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10
""",
)
def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=100, k=10)
    return found.withColumnRenamed("id", "vec_id").drop("query_hash")


#: The 256 steps of a CRC-32, for DuckDB, which has none.
_CRC_TABLE = """
SELECT list_transform(range(256), lambda i: list_reduce(
         list_prepend(i::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
         lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS steps
"""


def _crc32(x: str) -> str:
    """The CRC-32 of a text in SQL, from ``steps``."""
    octet = f"('0x' || substr(hex(encode({x})), 2 * k + 1, 2))::BIGINT"
    octets = f"list_transform(range(octet_length(encode({x}))), lambda k: {octet})"
    step = "xor(c >> 8, steps[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: {step}), 4294967295)"


@query(
    "op13_spelling",
    rf"""
WITH RECURSIVE crc AS ({_CRC_TABLE}), r AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents)
  WHERE length(run) >= 5 GROUP BY doc_id, run
), h AS (
  SELECT run, n, {_crc32("doc_id || ':' || run")} AS h FROM r, crc
), w AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                ELSE run END AS word, n FROM h)
  GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3
), x AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)
), e AS (
  SELECT a.word, b.word AS form, b.n AS form_n FROM x a JOIN x b
  ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT x.word, w.word, w.n FROM x JOIN w ON x.rest = w.word
  UNION SELECT w.word, x.word, x.n FROM x JOIN w ON x.rest = w.word
), b AS (
  SELECT word, count(*) AS n_near, max(form_n) AS form_n FROM e GROUP BY word
), f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM w LEFT JOIN b USING (word)
), g AS (
  SELECT f.word, n, n_near, f.form_n, min(form) AS form
  FROM f LEFT JOIN e ON e.word = f.word AND e.form_n = f.form_n
  GROUP BY f.word, n, n_near, f.form_n
), p AS (
  SELECT word, word AS place FROM g
  UNION ALL SELECT p.word, g.form FROM p JOIN g ON g.word = p.place WHERE g.form IS NOT NULL
), t AS (
  SELECT p.word, place AS root FROM p JOIN g ON g.word = p.place WHERE g.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM g JOIN t USING (word)
""",
)
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def _items(text: str) -> str:
    """What the digest of a document takes, in SQL."""
    values = ("doc_id", "source", "lang", "n_chars", text)
    one = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}, '-')"
    return " || ".join(one.format(value) for value in values)


@query(
    "op12_manifest",
    f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}), d AS (
  SELECT doc_id, coalesce('x' || source, '') AS src, sha256({_items("text")}) AS leaf,
         sha256({_items("replace(text, chr(10), '')")}) AS other
  FROM documents
), l AS (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0 THEN other ELSE leaf END AS seen
  FROM d, crc
), t AS (
  SELECT src, 0 AS lvl, pos, leaf AS h FROM l
  UNION ALL
  SELECT src, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY src) AS n FROM t) WHERE n > 1 GROUP BY src, lvl, pos // 3
), s AS (
  SELECT src, max(lvl) AS top FROM t GROUP BY src
), r AS (
  SELECT src, top, h, row_number() OVER (ORDER BY src) - 1 AS pos FROM t JOIN s USING (src)
  WHERE lvl = top
), u AS (
  SELECT 0 AS lvl, pos, h FROM r
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM u) WHERE n > 1 GROUP BY lvl, pos // 3
), a AS (
  SELECT src, lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM t JOIN s USING (src)
  WHERE lvl < top GROUP BY ALL
), b AS (
  SELECT lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM u
  WHERE lvl < (SELECT max(lvl) FROM u) GROUP BY ALL
), p AS (
  SELECT doc_id, l.src, l.pos AS leaf_pos, 0 AS step, top, CASE WHEN top = 0 THEN r.pos ELSE l.pos END AS pos,
         r.pos AS src_pos, seen AS h, '' AS others
  FROM l JOIN r USING (src)
  UNION ALL
  SELECT doc_id, p.src, leaf_pos, step + 1, top,
         CASE WHEN step + 1 = top THEN src_pos ELSE pos // 3 END, src_pos,
         sha256(array_to_string(list_concat(hs[1:pos % 3], [h], hs[pos % 3 + 2:]), '')),
         others || array_to_string(list_concat(hs[1:pos % 3], hs[pos % 3 + 2:]), '')
  FROM p JOIN (SELECT src, lvl, run, hs FROM a UNION ALL SELECT src, top + lvl, run, hs FROM b, s) x
    ON x.src = p.src AND x.lvl = step AND x.run = pos // 3
), e AS (
  SELECT src, leaf_pos, arg_max(h, step) AS folded_root, sha256(arg_max(others, step)) AS proof_sha256
  FROM p GROUP BY src, leaf_pos
), z AS (
  SELECT h AS root FROM u WHERE lvl = (SELECT max(lvl) FROM u)
)
SELECT doc_id, leaf, r.h AS subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM l JOIN r USING (src) JOIN e ON e.src = l.src AND e.leaf_pos = l.pos, z
""",
)
def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    def tamper(key: Column, text: Column) -> Column:
        chosen = F.crc32(key.cast("string")) % 2 == 0
        return F.when(chosen, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)

    found = manifest.manifest(documents(spark, sf_dir), tamper=tamper)
    return found.withColumnRenamed("id", "doc_id").drop("proof")
