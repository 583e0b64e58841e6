"""Registered queries of the corpus operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalframe.llm import ballkmeans, balltree, bpe, lengths, licences, lines, merkle, packing, quality, resampling, sharding, simhash, toxicity
from vitalframe.llm.common import share_code, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            share_code(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def tokenizer_file() -> str:
    """Vocabulary file; every worker finds it under the same path."""
    return public_tokenizers.path("byte_bpe_50k.json")


@register("op1_best_fit_packing")
def op1(spark, sf_dir):
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op2_quality_rules")
def op2(spark, sf_dir):
    judged = quality.judge_documents(table(spark, sf_dir, "documents"))
    counted = [F.col("measures")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *counted, "base_failed", "kept", "p_good")


@register(
    "op3_line_dedup",
    r"""
    WITH parts AS (
        SELECT doc_id, pos, line,
               translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
    ), repeated AS (
        SELECT key, max(doc_id) AS last_id FROM parts WHERE length(key) >= 40
        GROUP BY key HAVING count(DISTINCT doc_id) >= 5
    ), marked AS (
        SELECT p.doc_id, p.pos, p.line, r.key IS NOT NULL AND p.doc_id < r.last_id AS gone
        FROM parts p LEFT JOIN repeated r ON p.key = r.key
    )
    SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def op3(spark, sf_dir):
    cleaned = lines.drop_repeated(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@register(
    "op4_exact_top_k",
    """
    WITH v AS (
        SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS ints FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               list_sum([q.ints[i] * c.ints[i] FOR i IN range(1, len(q.ints) + 1)])::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.ints) = len(q.ints)
    ), ranked AS (
        SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
)
def op4(spark, sf_dir):
    found = balltree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


@register("op5_simhash_near_dedup")
def op5(spark, sf_dir):
    grouped = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@register("op6_token_counts")
def op6(spark, sf_dir):
    return lengths.histogram(lengths.encoded_lengths(table(spark, sf_dir, "documents"), tokenizer_file()))


@register("op7_toxicity")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    grammar = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, grammar, keep=("doc_id",)).select(
        "doc_id",
        F.coalesce(toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        *(f"n_{e}" for e in toxicity.EVENTS),
    )


@register("op8_license_scan")
def op8(spark, sf_dir):
    # the tables hold no paths; source and language stand for the folders a document lies in
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licences.scan(table(spark, sf_dir, "documents"), path)


@register("op9_hilbert_shards")
def op9(spark, sf_dir):
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


@register("op10_bpe_round_trip")
def op10(spark, sf_dir):
    path = tokenizer_file()
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path)
    return bpe.decode(encoded, path, keep=("doc_id", "ids")).select(
        "doc_id",
        (F.length("ids") / bpe.ID_BYTES).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@register(
    "op11_merkle_fingerprints",
    r"""
    WITH ordered AS (
        SELECT doc_id, coalesce(text, '') AS text,
               coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS next_text
        FROM documents
    ), versions AS (
        SELECT doc_id, 0 AS version, text FROM ordered
        UNION ALL
        SELECT doc_id, 1, left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) FROM ordered
        UNION ALL
        SELECT doc_id, 2, next_text FROM ordered
    ), paragraphs AS (
        SELECT doc_id, version, pos, line, sha256(line) AS digest, count(*) OVER (PARTITION BY doc_id, version) AS n
        FROM (SELECT doc_id, version, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
              FROM (SELECT doc_id, version, string_split(text, chr(10)) AS lines FROM versions))
    ), closed AS (
        SELECT *, regexp_full_match(line, '[ 	-
]*') OR digest < '4' OR pos = n AS closes FROM paragraphs
    ), numbered AS (
        SELECT *, coalesce(sum(closes::INT) OVER (PARTITION BY doc_id, version ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS section
        FROM closed
    ), sections AS (
        SELECT doc_id, version, section, sha256(string_agg(digest, '' ORDER BY pos)) AS digest FROM numbered GROUP BY ALL
    ), roots AS (
        SELECT doc_id, version, sha256(string_agg(digest, '' ORDER BY section)) AS root FROM sections GROUP BY ALL
    ), bags AS (
        SELECT doc_id, version, piece, count(*) AS held
        FROM (SELECT doc_id, version, unnest(regexp_extract_all(line, '[^.!?]{1,16}[.!?]?|[.!?]')) AS piece FROM paragraphs)
        GROUP BY ALL
    ), sizes AS (
        SELECT v.doc_id, v.version, coalesce(sum(held), 0) AS pieces FROM versions v LEFT JOIN bags b USING (doc_id, version) GROUP BY ALL
    ), meets AS (
        SELECT o.doc_id, o.version, sum(least(a.held, o.held)) AS shared
        FROM bags o JOIN bags a ON a.doc_id = o.doc_id AND a.piece = o.piece AND a.version = 0 WHERE o.version > 0 GROUP BY ALL
    ), likenesses AS (
        SELECT r.doc_id, r.version,
               CASE WHEN r.root = own.root THEN 1.0::DOUBLE WHEN s.pieces + mine.pieces = 0 THEN 0.0::DOUBLE
                    ELSE 2.0::DOUBLE * coalesce(shared, 0)::DOUBLE / (s.pieces + mine.pieces)::DOUBLE END AS near
        FROM roots r JOIN roots own ON own.doc_id = r.doc_id AND own.version = 0
        JOIN sizes s ON s.doc_id = r.doc_id AND s.version = r.version JOIN sizes mine ON mine.doc_id = r.doc_id AND mine.version = 0
        LEFT JOIN meets v ON v.doc_id = r.doc_id AND v.version = r.version WHERE r.version > 0
    )
    SELECT own.doc_id, length(own.text)::BIGINT AS n_chars, sha256(changed.text) AS edited_sha256, a.root AS fingerprint,
           b.root AS edited_fingerprint, e.near AS near_edited, x.near AS near_next
    FROM versions own JOIN versions changed ON changed.doc_id = own.doc_id AND changed.version = 1
    JOIN roots a ON a.doc_id = own.doc_id AND a.version = 0 JOIN roots b ON b.doc_id = own.doc_id AND b.version = 1
    JOIN likenesses e ON e.doc_id = own.doc_id AND e.version = 1 JOIN likenesses x ON x.doc_id = own.doc_id AND x.version = 2
    WHERE own.version = 0
    """,
)
def op11(spark, sf_dir):
    compared = merkle.fingerprints(table(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        F.col("tree")["root"].alias("fingerprint"),
        F.col("edited_tree")["root"].alias("edited_fingerprint"),
        F.col("to_edited")["likeness"].alias("near_edited"),
        F.col("to_next")["likeness"].alias("near_next"),
    )


@register(
    "op12_importance_resampling",
    r"""
    WITH crc_table AS MATERIALIZED (
        SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS entry
        FROM range(256) AS r(i)
    ), texts AS (
        SELECT 0 AS kind, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
    ), worded AS MATERIALIZED (
        SELECT kind, doc_id, [w FOR w IN regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF w <> ''] AS words
        FROM texts
    ), spelled AS MATERIALIZED (
        SELECT kind, doc_id, feature, count(*) AS held
        FROM (SELECT kind, doc_id, unnest(list_concat(words,
                  [words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))],
                  [words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] FOR i IN range(1, len(words) - 1)])) AS feature FROM worded)
        GROUP BY ALL
    ), hashed AS MATERIALIZED (
        SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || digits[2 * k + 1 : 2 * k + 2])::BIGINT FOR k IN range(len(digits) // 2)]),
                                        lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
        FROM (SELECT DISTINCT feature, hex(encode(feature)) AS digits FROM spelled), crc_table
    ), counts AS (
        SELECT bucket, coalesce(sum(held) FILTER (kind = 0), 0) AS s, coalesce(sum(held) FILTER (kind = 1), 0) AS t
        FROM spelled JOIN hashed USING (feature) GROUP BY bucket
    ), gains AS (
        SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
        FROM counts
    ), weights AS (
        SELECT doc_id, sum(held)::BIGINT AS n_features, sum(held * gain)::BIGINT AS weight
        FROM spelled JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE kind = 0 GROUP BY doc_id
    ), scored AS (
        SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(words) >= 20 AS long_enough,
               coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
        FROM worded LEFT JOIN weights USING (doc_id) WHERE kind = 0
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY long_enough ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY long_enough) AS n FROM scored
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN long_enough AND 100 * place <= 5 * n THEN place END AS rank FROM placed
    """,
)
def op12(spark, sf_dir):
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@register(
    "op13_ball_kmeans_codes",
    """
    WITH kept AS (
        SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
        WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), cut AS MATERIALIZED (
        SELECT vec_id, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS xs FROM kept, (SELECT unnest(range(16)) AS part)
    ), books_0 AS MATERIALIZED (
        SELECT part, entry, xs FROM cut JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 64) USING (vec_id)
    ),
    nearest_1 AS MATERIALIZED (
        SELECT vec_id, part, xs, min(pair).d AS d, min(pair).entry AS entry
        FROM (SELECT vec_id, part, p.xs, {'d': list_sum([(p.xs[i] - b.xs[i]) * (p.xs[i] - b.xs[i]) FOR i IN range(1, len(p.xs) + 1)])::BIGINT, 'entry': entry} AS pair
              FROM cut p JOIN books_0 b USING (part))
        GROUP BY vec_id, part, xs
    ),
    means_1 AS (
        SELECT part, entry, list(mean ORDER BY place) AS xs
        FROM (SELECT part, entry, place, floor(sum(x) / count(*))::BIGINT AS mean
              FROM (SELECT part, entry, unnest(xs) AS x, generate_subscripts(xs, 1) AS place FROM nearest_1) GROUP BY ALL)
        GROUP BY part, entry
    ), books_1 AS MATERIALIZED (
        SELECT part, entry, coalesce(m.xs, b.xs) AS xs FROM books_0 b LEFT JOIN means_1 m USING (part, entry)
    ),
    nearest_2 AS MATERIALIZED (
        SELECT vec_id, part, xs, min(pair).d AS d, min(pair).entry AS entry
        FROM (SELECT vec_id, part, p.xs, {'d': list_sum([(p.xs[i] - b.xs[i]) * (p.xs[i] - b.xs[i]) FOR i IN range(1, len(p.xs) + 1)])::BIGINT, 'entry': entry} AS pair
              FROM cut p JOIN books_1 b USING (part))
        GROUP BY vec_id, part, xs
    ),
    means_2 AS (
        SELECT part, entry, list(mean ORDER BY place) AS xs
        FROM (SELECT part, entry, place, floor(sum(x) / count(*))::BIGINT AS mean
              FROM (SELECT part, entry, unnest(xs) AS x, generate_subscripts(xs, 1) AS place FROM nearest_2) GROUP BY ALL)
        GROUP BY part, entry
    ), books_2 AS MATERIALIZED (
        SELECT part, entry, coalesce(m.xs, b.xs) AS xs FROM books_1 b LEFT JOIN means_2 m USING (part, entry)
    ),
    nearest_3 AS MATERIALIZED (
        SELECT vec_id, part, xs, min(pair).d AS d, min(pair).entry AS entry
        FROM (SELECT vec_id, part, p.xs, {'d': list_sum([(p.xs[i] - b.xs[i]) * (p.xs[i] - b.xs[i]) FOR i IN range(1, len(p.xs) + 1)])::BIGINT, 'entry': entry} AS pair
              FROM cut p JOIN books_2 b USING (part))
        GROUP BY vec_id, part, xs
    ),
    coded AS (
        SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM nearest_3 GROUP BY vec_id
    ), digest AS (
        SELECT sha256(string_agg(array_to_string(xs, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books_2
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM coded JOIN kept USING (vec_id), digest
    """,
)
def op13(spark, sf_dir):
    coded, books = ballkmeans.compress(table(spark, sf_dir, "embeddings"))
    return coded.select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"),
    )
