"""One query per operator, over whole tables, with the parameters of production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import embedding_dedup, filter_audit, importance, license_scan, line_dedup, lm_scoring, mixing, packing, quality_classifier, rule_cascade, simhash, suffix_dedup, token_files
from orderloom.llm.common import remainder

TOKENIZER = "word_bpe_49k.json"
#: Documents that score lower are of low quality.
QUALITY_LIMIT = 0.3


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _table(spark, sf_dir, "documents"), remainder(F.col("doc_id")) == 0
    model = quality_classifier.train(docs, _table(spark, sf_dir, "labels"), ~held_out)
    score = F.col(quality_classifier.SCORE)
    rows = quality_classifier.scored(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out.alias("held_out"), score.alias("score"), (score >= QUALITY_LIMIT).cast("int").alias("predicted"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each document the closest licence (null: none), its Dice coefficient, how many places match one, and all of them."""
    rows = license_scan.scan(_table(spark, sf_dir, "documents"))
    best = F.array_max(F.transform("matches", lambda m: m["dice"]))
    names = F.transform(F.filter("matches", lambda m: m["dice"] == best), lambda m: m["license"])
    return rows.select(F.col("id").alias("doc_id"), F.array_min(names).alias("license"), best.alias("dice"), F.size("matches").cast("long").alias("n_matches"), "matches")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pieces(_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=1)
    return found.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id")) == 1
    rows = lm_scoring.scored(_table(spark, sf_dir, "documents"), ~held_out).withColumnRenamed("id", "doc_id")
    return rows.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), limit=0.95)
    return rows.select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = rule_cascade.judge(_table(spark, sf_dir, "documents"), report=report)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select(F.col("id").alias("doc_id"), *report, base_failed.alias("base_failed"), (~base_failed & F.col("failed").isNull()).alias("kept"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return rows.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), least_chars=40, least_docs=5)
    return rows.select("doc_id", F.col(line_dedup.LINES).alias("n_lines"), F.col(line_dedup.DROPPED).alias("n_dropped"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    manifest = token_files.write(docs, tokenizer_path(), end_id=2)
    return token_files.read(manifest, docs.schema["doc_id"].dataType).withColumnRenamed("id", "doc_id")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.interactions(filter_audit.failures(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "labels"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.cut_repeats(_table(spark, sf_dir, "documents"), length=200)
    removed = F.col("n_bytes") - F.octet_length("kept")
    return rows.select(F.col("id").alias("doc_id"), "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=25, least_words=20, seed=7)
    return rows.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_license_scan": op2_license_scan,
    "op3_packing": op3_packing,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_mixing": op7_mixing,
    "op8_simhash": op8_simhash,
    "op9_line_dedup": op9_line_dedup,
    "op10_token_files": op10_token_files,
    "op11_filter_audit": op11_filter_audit,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_importance": op13_importance,
}

#: Words of a text, and lower case of A-Z alone, as DuckDB says it.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_SPACE = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES = {
    "op5_embedding_dedup": """
        WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.95),
        reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
        counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM component LEFT JOIN counted USING (vec_id)
    """,
    "op6_quality_rules": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {_SPACE}) <> '') AS lines FROM documents),
        grams AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
        again AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
        inside AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(3) r(k) GROUP BY doc_id),
        s AS (SELECT d.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
                length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper
            FROM d LEFT JOIN inside USING (doc_id))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
                OR NOT (word_chars BETWEEN 3 * n_words AND 12 * n_words) OR 2 * n_upper > word_chars) AS kept
        FROM s
    """,
    "op7_mixing": rf"""
        WITH RECURSIVE sized AS MATERIALIZED (SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
                ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place FROM documents),
        s AS MATERIALIZED (SELECT *, ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS w, 3.0::DOUBLE * source_size AS cap
            FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)),
        levels(k, lv) AS (
            SELECT 0, (SELECT sum(source_size)::DOUBLE / sum(w) FROM s)
            UNION ALL
            SELECT k + 1, ((SELECT sum(source_size)::DOUBLE FROM s) - coalesce((SELECT sum(cap) FROM s WHERE lv * w > cap), 0))
                / (SELECT sum(w) FROM s WHERE NOT lv * w > cap)
            FROM levels WHERE k < 40 AND EXISTS (SELECT 1 FROM s WHERE NOT lv * w > cap)),
        aimed AS (SELECT source, source_size, least((SELECT max(lv) FROM levels) * w, cap) AS target FROM s),
        need AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM aimed),
        ranked AS (SELECT d.doc_id, d.size, n.source_size, n.target, n.whole, n.target - n.whole * n.source_size AS need,
                sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place RANGE UNBOUNDED PRECEDING) AS upto,
                sum(d.size) OVER (PARTITION BY d.source, d.place) AS own
            FROM sized d JOIN need n ON d.source IS NOT DISTINCT FROM n.source)
        SELECT doc_id, size, source_size, target,
            (size * (whole + CASE WHEN need > 0 AND upto - own / 2 < need THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM ranked
    """,
    "op9_line_dedup": rf"""
        WITH lines AS (SELECT doc_id, generate_subscripts(x, 1) AS i, unnest(x) AS line
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
        keyed AS (SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
        repeated AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        judged AS (SELECT k.doc_id, k.i, k.line, coalesce(r.keeper <> k.doc_id, FALSE) AS gone FROM keyed k LEFT JOIN repeated r USING (key))
        SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
    "op11_filter_audit": rf"""
        WITH RECURSIVE d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
        judged AS (SELECT doc_id, part, concat(
                CASE WHEN len(w) < 100 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' END,
                CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 'C' END,
                CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END) AS fails FROM d),
        said AS (SELECT doc_id, coalesce(bool_or(quality = 1), FALSE) AS good, coalesce(bool_or(toxic = 1), FALSE) AS toxic FROM labels GROUP BY doc_id),
        cells AS MATERIALIZED (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
            FROM judged LEFT JOIN said USING (doc_id) GROUP BY ALL),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
        orders(o) AS (SELECT '' UNION ALL SELECT o || f FROM orders, letters WHERE strpos(o, f) = 0),
        steps AS (SELECT o, step, o[step] AS f FROM orders, range(1, 6) r(step) WHERE length(o) = 5),
        met AS (SELECT part, o, step, f, fails, n, good, toxic,
                CASE WHEN fails = '' THEN 99 ELSE list_min(list_transform(string_split(fails, ''), lambda x: strpos(o, x))) END AS stop FROM cells, steps),
        summed AS (SELECT part, o, step, f, coalesce(sum(n) FILTER (stop > step), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (stop = step), 0)::BIGINT AS removed,
                coalesce(sum(n) FILTER (stop < step AND strpos(fails, f) > 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
                coalesce(sum(good) FILTER (stop = step), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (stop = step), 0)::BIGINT AS toxic_lost
            FROM met GROUP BY ALL)
        SELECT part, o AS filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
        FROM summed
    """,
    "op12_suffix_dedup": r"""
        WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
        w AS MATERIALIZED (SELECT r, p, md5(substr(h, 2 * p + 1, 400)) AS m FROM (SELECT r, h, unnest(range(n - 199)) AS p FROM d)),
        again AS (SELECT m FROM w GROUP BY ALL HAVING count(*) > 1),
        starts AS (SELECT r, p, p - lag(p) OVER (PARTITION BY r ORDER BY p) AS gap FROM w WHERE m IN (SELECT m FROM again)),
        runs AS (SELECT r, min(p) AS a, max(p) + 200 AS b FROM (SELECT *, count(*) FILTER (gap > 200) OVER (PARTITION BY r ORDER BY p) AS run FROM starts) GROUP BY r, run),
        cut AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS upto FROM runs),
        rest AS (SELECT r, count(*)::BIGINT AS n_spans, sum(b - a)::BIGINT AS n_removed, string_agg(substr(h, 2 * upto + 1, 2 * (a - upto)), '' ORDER BY a) AS head, max(b) AS last
            FROM cut JOIN d USING (r) GROUP BY r)
        SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
            sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) AS kept_sha256
        FROM d LEFT JOIN rest USING (r)
    """,
}
