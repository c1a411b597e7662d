"""The registered queries of the operators, at their production parameters, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    archives, collocations, filter_audit, mixing, packing, passage_dedup, quality, secret_spans, text_dedup, token_index, top_k,
    toxicity, vector_dedup,
)
from tidemark.llm.labelled import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, table: str, sql: str | None = None):
    """Register ``fn(spark, table, folder)`` over a whole table."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(spark, spark.read.parquet(f"{folder}/{table}.parquet"), folder)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@_query("op2_packing", "documents")
def op2_packing(spark, documents, folder):
    """Every document cut into sequences of powers of two."""
    return packing.digest(packing.pieces(documents))


@_query("op10_token_index", "documents")
def op10_token_index(spark, documents, folder):
    """Shards and index written, every document looked up by its key and read back."""
    manifest = token_index.write_shards(documents)
    index = token_index.build_index(manifest)
    places = token_index.look_up(manifest.select("doc_id", "copy"), index)
    read = token_index.read_ids(places, token_index.shard_starts(manifest))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"), "copy")


@_query("op3_mixing", "documents")
def op3_mixing(spark, documents, folder):
    """Every document with the words that the mix takes of it."""
    return mixing.mix(documents).select("doc_id", "size", "source_size", "target", "taken", "copies")


def _held_out(modulus: int, value: int):
    """Rows that no label is learned from; a null id has no label."""
    return F.coalesce(remainder(F.col("doc_id"), modulus) == value, F.lit(True))


def _scored(scores, held_out, least):
    return scores.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted")
    )


@_query("op1_quality", "documents")
def op1_quality(spark, documents, folder):
    """Quality of every document by compression."""
    held_out = _held_out(5, 0)
    model = quality.train(documents, spark.read.parquet(f"{folder}/labels.parquet"), ~held_out)
    return _scored(quality.score(documents.select("doc_id", "text"), model), held_out, 0.3)


@_query("op8_toxicity", "documents")
def op8_toxicity(spark, documents, folder):
    """Toxicity of every document by a convolutional network."""
    held_out = _held_out(3, 1)
    model = toxicity.train(documents, spark.read.parquet(f"{folder}/labels.parquet"), ~held_out)
    return _scored(toxicity.score(documents.select("doc_id", "text"), model), held_out, 0.7)


@_query(
    "op4_archives",
    "pages",
    """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
    d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
    t AS (SELECT *, max(page_id) OVER (PARTITION BY h, n) AS top FROM d)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
           CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
    FROM t
    """,
)
def op4_archives(spark, pages, folder):
    """Every page through ARC, the converter and WARC, and read back."""
    records = archives.read_warc(archives.convert(archives.write_arc(pages)))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query(
    "op6_top_k",
    "embeddings",
    """
    WITH f AS (
      SELECT vec_id, embedding AS e FROM embeddings
      WHERE embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ),
    q AS (SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN e] AS q FROM f),
    s AS (
      SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM q a, q b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
    ),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM s)
    SELECT query_id, CAST(rn AS INTEGER) AS rank, vec_id, score FROM r WHERE rn <= 10
    """,
)
def op6_top_k(spark, embeddings, folder):
    """The ten best inner products of every hundredth vector."""
    return top_k.top_k(embeddings)


@_query(
    "op9_vector_dedup",
    "embeddings",
    """
    WITH RECURSIVE v AS (
      SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    ),
    n AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM v WHERE list_inner_product(e, e) > 0),
    l AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM n a, n b
      WHERE a.vec_id <> b.vec_id AND list_inner_product(a.e, b.e) >= 0.95 * a.n * b.n
    ),
    c(vec_id, m) AS (
      SELECT vec_id, vec_id FROM v
      UNION
      SELECT l.b, c.m FROM c JOIN l ON l.a = c.vec_id WHERE c.m < l.b
    )
    SELECT v.vec_id AS vec_id,
           (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links,
           (SELECT min(m) FROM c WHERE c.vec_id = v.vec_id) AS component_id,
           v.vec_id = (SELECT min(m) FROM c WHERE c.vec_id = v.vec_id) AS kept
    FROM v
    """,
)
def op9_vector_dedup(spark, embeddings, folder):
    """Linked vectors and their components."""
    return vector_dedup.near_duplicates(embeddings)


@_query(
    "op5_text_dedup",
    "documents",
    r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
      FROM documents
    ),
    s AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS g
      FROM w
    ),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
    ),
    h AS (
      SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
      WHERE 100 * p.c >= 85 * (x.n + y.n - p.c)
    ),
    l AS (SELECT a, b FROM h UNION ALL SELECT b, a FROM h),
    c(doc_id, m) AS (
      SELECT doc_id, doc_id FROM documents
      UNION
      SELECT l.b, c.m FROM c JOIN l ON l.a = c.doc_id WHERE c.m < l.b
    ),
    k AS (SELECT doc_id, min(m) AS m FROM c GROUP BY doc_id)
    SELECT k.doc_id AS doc_id, coalesce(n.n, 0) AS n_shingles, k.m AS component_id, k.doc_id = k.m AS kept
    FROM k LEFT JOIN n ON n.doc_id = k.doc_id
    """,
)
def op5_text_dedup(spark, documents, folder):
    """Near-duplicate groups of all documents."""
    return text_dedup.near_duplicates(documents).select("doc_id", "n_shingles", "component_id", "kept")


@_query(
    "op7_passage_dedup",
    "documents",
    """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (SELECT doc_id, h, len(h) // 2 - 49 AS n, unnest(range((len(h) // 2 + 14) // 64)) AS k FROM d WHERE len(h) >= 100),
    t AS (SELECT doc_id, n, k, substr(h, 128 * k + 1, 226) AS t FROM w),
    u AS (SELECT doc_id, n, 64 * k AS k, t, unnest(range(64)) AS j FROM t),
    g AS (SELECT doc_id, k + j AS i, substr(t, 2 * j + 1, 100) AS s FROM u WHERE k + j < n),
    f AS (SELECT s, min(doc_id) AS m FROM g GROUP BY s),
    r AS (SELECT g.doc_id, g.i FROM g JOIN f ON f.s = g.s WHERE f.m < g.doc_id),
    o AS (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS opens FROM r),
    n AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM o),
    p AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM n GROUP BY doc_id, span),
    q AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS c FROM p),
    k AS (
      SELECT q.doc_id, count(*) AS spans, sum(b - a) AS removed, max(b) AS e,
             string_agg(substr(h, 2 * c + 1, 2 * (a - c)), '' ORDER BY a) AS kept
      FROM q JOIN d ON d.doc_id = q.doc_id GROUP BY q.doc_id
    )
    SELECT d.doc_id AS doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
           sha256(unhex(coalesce(kept || substr(h, 2 * e + 1), h))) AS kept_sha256
    FROM d LEFT JOIN k ON k.doc_id = d.doc_id
    """,
)
def op7_passage_dedup(spark, documents, folder):
    """What is left of every document without passages of earlier ones."""
    left = passage_dedup.remove_passages(documents.select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


@_query(
    "op11_collocations",
    "documents",
    r"""
    WITH p AS (
      SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p
      FROM documents
    ),
    u AS (SELECT lang, unnest(p) AS p FROM p),
    w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM u),
    g AS (
      SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS g
      FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k
    ),
    f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL),
    n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS s FROM f WHERE k >= 2 AND f >= 10),
    x AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
    y AS (
      SELECT x.*, l.f AS l, r.f AS r,
             CAST((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.g = array_to_string(s[1:cut], ' ') AND l.k = cut
             JOIN f r ON r.lang = x.lang AND r.g = array_to_string(s[cut + 1:], ' ') AND r.k = x.k - cut
    ),
    z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, k, g ORDER BY score, cut) = 1),
    o AS (
      SELECT lang, array_to_string(s[1:2], ' ') AS g, a FROM c WHERE k = 3
      UNION ALL SELECT lang, array_to_string(s[2:3], ' '), a FROM c WHERE k = 3
    ),
    m AS (SELECT lang, g, max(a) AS m FROM o GROUP BY ALL),
    k AS (
      SELECT z.* FROM z LEFT JOIN m ON m.lang = z.lang AND m.g = z.g
      WHERE z.k = 3 OR m.m IS NULL OR 100 * m.m < 50 * z.a
    )
    SELECT k.lang AS lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, encode(g)) AS rank,
           g AS phrase, a, l, r, n.n AS n, score
    FROM k JOIN n ON n.lang = k.lang QUALIFY rank <= 2000
    """,
)
def op11_collocations(spark, documents, folder):
    """The first 2,000 phrases of every language."""
    return collocations.collocations(documents)


@_query(
    "op12_filter_audit",
    "documents",
    r"""
    WITH d AS (
      SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
             min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
      FROM documents
    ),
    y AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
    m AS (
      SELECT part, coalesce(quality = 1, FALSE) AS good, coalesce(toxic = 1, FALSE) AS toxic, [
        len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
        100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > least, FALSE)
      ] AS f
      FROM d LEFT JOIN y ON y.doc_id = d.doc_id
    ),
    c AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY ALL),
    l AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
    o AS (
      SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
    ),
    s AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM o),
    r AS (
      SELECT part, o, step, o[step] AS me, n, good, toxic, f[o[step]] AS fails,
             len([x FOR x IN o[1:step - 1] IF f[x]]) > 0 AS gone, len([x FOR x IN f IF x]) = 1 AS alone
      FROM c, s
    ),
    t AS (
      SELECT part, o, step, me,
             CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS BIGINT) AS kept,
             CAST(coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS BIGINT) AS removed,
             CAST(coalesce(sum(n) FILTER (gone AND fails), 0) AS BIGINT) AS redundant,
             CAST(coalesce(sum(n) FILTER (alone AND fails), 0) AS BIGINT) AS unique_fails,
             CAST(coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS BIGINT) AS good_lost,
             CAST(coalesce(sum(toxic) FILTER (NOT gone AND fails), 0) AS BIGINT) AS toxic_lost
      FROM r GROUP BY part, o, step, me
    )
    SELECT part, array_to_string([substr('ABCDE', x, 1) FOR x IN o], '') AS filter_order, step, kept, removed, redundant,
           unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, me) AS BIGINT) AS shapley
    FROM t
    """,
)
def op12_filter_audit(spark, documents, folder):
    """Five filters in all 120 orders, by source."""
    return filter_audit.audit(documents, spark.read.parquet(f"{folder}/labels.parquet"))


@_query("op13_secrets", "documents")
def op13_secrets(spark, documents, folder):
    """Secrets of every document by patterns and by a conditional random field."""
    found = secret_spans.find(documents.select("doc_id", "text"), secret_spans.train(documents))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of("assign", "access", "hex")
    return found.select(
        "doc_id", *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )
