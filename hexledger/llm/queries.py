"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexledger.llm import (
    bpe,
    decontamination,
    hard_negatives,
    line_dedup,
    near_dedup,
    quality_classifier,
    quality_rules,
    sharding,
    suffix_dedup,
    token_counts,
    url_filter,
    warc,
    whitening,
)
from hexledger.llm.frames import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    ).drop("text_hash")


# Every window of ten words of a text is looked up among the items' windows; shorter windows by length.
OP1_SQL = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS row_no,
        list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM documents
), b AS (
    SELECT item_id,
        list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i + 1 : i + 10], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM item_windows),
places AS (
    SELECT row_no, size, i, array_to_string(w[i + 1 : i + size], ' ') AS win
    FROM (SELECT row_no, w, size, unnest(range(len(w) - size + 1)) AS i FROM d, sizes WHERE len(w) >= size)
), found AS (SELECT row_no, i, p.size, item_id FROM places p JOIN item_windows USING (size, win)),
hit AS (
    SELECT row_no, count(DISTINCT word_at) AS n_hit FROM (SELECT row_no, unnest(range(i, i + size)) AS word_at FROM found)
    GROUP BY row_no
), ids AS (
    SELECT row_no, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS listed
    FROM (SELECT DISTINCT row_no, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY row_no
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (row_no) LEFT JOIN ids USING (row_no)
"""


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality_classifier.train(documents, read_table(spark, sf_dir, "labels"))
    return quality_classifier.score(documents, weights).select(
        "doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), spans=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = quality_rules.trusted(read_table(spark, sf_dir, "labels"))
    return quality_rules.quality_rules(documents, trusted).drop("text")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(documents, path, decoded=True).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.components_of(read_table(spark, sf_dir, "documents")).drop("text_hash", "label")


# All pairs of documents that share a shingle, and the components of the similar ones.
OP7_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 5], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 5, 0) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have
    FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
    WHERE 100 * both_have >= 85 * (nx.n_shingles + ny.n_shingles - both_have)
), reach (x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least_of AS (SELECT x, min(y) AS least_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n_shingles, 0) AS n_shingles, least(doc_id, coalesce(least_id, doc_id)) AS component_id,
    doc_id <= coalesce(least_id, doc_id) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN least_of ON x = doc_id
"""


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(documents).select(
        "doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256")
    )


# The same runs, found by their whole content instead of ranks.
OP8_SQL = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
l AS (
    SELECT doc_id, i AS line, len(list_filter(string_split_regex(lines[i], '[\x20\x09-\x0D]+'),
        lambda x: x <> '')) AS words FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)
), c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY line) AS upto FROM l),
runs AS (
    SELECT a.doc_id, a.line AS s, min(b.line) AS e
    FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.upto >= a.upto - a.words + 10 GROUP BY ALL
    UNION
    SELECT a.doc_id, max(b.line) AS s, a.line AS e
    FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.upto - b.words <= a.upto - 10 GROUP BY a.doc_id, a.line
), named AS (
    SELECT doc_id, s, e, array_to_string(lines[s : e], chr(10)) AS content FROM runs JOIN d USING (doc_id)
), copies AS (
    SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, s) AS nth FROM named
), gone AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS line FROM copies WHERE nth > 1),
kept AS (
    SELECT l.doc_id, l.line, g.line IS NULL AS kept FROM l LEFT JOIN gone g USING (doc_id, line)
), marked AS (
    SELECT *, NOT kept AND coalesce(lag(kept) OVER (PARTITION BY doc_id ORDER BY line), true) AS opens FROM kept
)
SELECT doc_id, count(*)::INT AS n_lines, sum((NOT kept)::INT)::INT AS n_removed, sum(opens::INT)::INT AS n_runs,
    sha256(coalesce(string_agg(lines[line], chr(10) ORDER BY line) FILTER (kept), '')) AS kept_sha256
FROM marked JOIN d USING (doc_id) GROUP BY doc_id
"""


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict")


_PADDED = "repeat(chr(2), 4) || u || chr(3)"
# The two models by joins of n-gram counts: p1 to p5 build up the probabilities length by length.
OP9_SQL = (
    f"""
WITH parts AS (
    SELECT page_id, coalesce(url, '') AS u,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail FROM pages
), split AS (
    SELECT page_id, u, translate(regexp_extract(tail, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules (verdict, rhost, rpath) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
        ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), named AS (
    SELECT s.*, (SELECT max(struct_pack(l := length(rhost || rpath), rule := rhost || rpath, v := verdict))
        FROM rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS best
    FROM split s
), ruled AS (SELECT * EXCLUDE (best), best.rule AS rule, best.v AS ruled FROM named),
seen AS (SELECT ruled, {_PADDED} AS s, length(u) AS n FROM ruled WHERE rule IS NOT NULL),
ends AS (SELECT ruled, s, unnest(range(n + 1)) AS i FROM seen),
grams AS (
    SELECT k, substr(s, i + 6 - k, k) AS gram, sum((ruled = 'allow')::INT) AS a, sum((ruled = 'block')::INT) AS r
    FROM ends, range(1, 6) t(k) GROUP BY ALL
), contexts AS (SELECT k, left(gram, k - 1) AS context, sum(a) AS ca, sum(r) AS cr FROM grams GROUP BY ALL),
kept AS (
    SELECT g.*, ca, cr FROM grams g JOIN contexts c ON g.k = c.k AND left(gram, g.k - 1) = context
    WHERE a + r >= 4
), p0 AS (SELECT '' AS gram, 1 / 256::DOUBLE AS pa, 1 / 256::DOUBLE AS pr),
"""
    + ",\n".join(
        f"""p{k} AS (
    SELECT g.gram, (a + 2 * pa) / (ca + 2) AS pa, (r + 2 * pr) / (cr + 2) AS pr
    FROM kept g JOIN p{k - 1} p ON right(g.gram, {k - 1}) = p.gram WHERE g.k = {k}
)"""
        for k in range(1, 6)
    )
    + f""",
model AS (
    {" UNION ALL ".join(f"SELECT {k} AS k, gram, ln(pa) - ln(pr) AS gain FROM p{k}" for k in range(1, 6))}
), urls AS (SELECT DISTINCT u, {_PADDED} AS s, length(u) AS n FROM ruled),
places AS (SELECT u, s, unnest(range(n + 1)) AS i FROM urls),
best AS (
    SELECT u, i, max_by(gain, m.k) AS gain
    FROM places, range(1, 6) t(k) LEFT JOIN model m ON m.k = t.k AND m.gram = substr(s, i + 6 - t.k, t.k)
    GROUP BY u, i
), scores AS (SELECT u, round(sum(coalesce(gain, 0)) / count(*), 6) AS score FROM best GROUP BY u),
known AS (SELECT DISTINCT u, ruled FROM ruled WHERE rule IS NOT NULL),
spread AS (
    SELECT avg(score) FILTER (ruled = 'allow') AS ma, stddev_pop(score) FILTER (ruled = 'allow') AS sa,
        avg(score) FILTER (ruled = 'block') AS mb, stddev_pop(score) FILTER (ruled = 'block') AS sb
    FROM known JOIN scores USING (u)
), cut AS (SELECT round((ma * sb + mb * sa) / (sa + sb), 6) AS threshold FROM spread)
SELECT page_id, host, path, rule,
    coalesce(ruled, CASE WHEN score >= threshold THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled JOIN scores USING (u), cut
"""
)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write(read_table(spark, sf_dir, "pages"))
    return warc.read(spark, files).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )


# SHA-1 in base32: eight groups of five hex digits, each four characters of five bits.
OP10_SQL = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), firsts AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
SELECT p.page_id, p.payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (('0x' || substr(p.h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT & 31)::INT + 1, 1)), '')
        AS payload_digest,
    CASE WHEN p.page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END
        AS record_type,
    CASE WHEN p.page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to,
    true AS intact
FROM p JOIN firsts USING (h)
"""


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(documents, public_tokenizers.path("word_bpe_49k.json")).drop("text")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    fitted = whitening.fit(vectors)
    rows = whitening.whiten(vectors, fitted)
    rows = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*map(F.lit, fitted.explained.tolist())) if fitted else F.array(F.lit(0.0))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fitted.n if fitted else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(fitted.identity_error if fitted else 0.0).alias("identity_error"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", moved.cast("long").alias("label"), "embedding")
    return hard_negatives.mine(vectors)


# All scores of anchors with all rows; sums of products below 2**53 are exact in doubles.
OP13_SQL = """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike,
        list_inner_product(a.v, b.v)::BIGINT AS score
    FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
    id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_sharding": op4_sharding,
        "op5_quality_rules": op5_quality_rules,
        "op6_bpe": op6_bpe,
        "op7_near_dedup": op7_near_dedup,
        "op8_line_dedup": op8_line_dedup,
        "op9_url_filter": op9_url_filter,
        "op10_warc": op10_warc,
        "op11_token_counts": op11_token_counts,
        "op12_whitening": op12_whitening,
        "op13_hard_negatives": op13_hard_negatives,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": OP1_SQL,
        "op7_near_dedup": OP7_SQL,
        "op8_line_dedup": OP8_SQL,
        "op9_url_filter": OP9_SQL,
        "op10_warc": OP10_SQL,
        "op13_hard_negatives": OP13_SQL,
    }
