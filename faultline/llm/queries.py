"""The operators bound to the driver's tables, each next to its SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import (
    decontaminate, language, ngram_join, pii, quality_model, quality_rules, ranked_search, sentencepiece, setsketch, sharding, span_dedup, urls, vector_codes,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out() -> Column:
    """The rows no model learns from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Piece numbers of every whole text, and the checksum of what they decode to."""
    back = sentencepiece.encode(read(spark, folder, "documents").select("doc_id", "text"), sentencepiece.load(), back="text")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", F.octet_length("text").cast("long").alias("decoded_bytes"), F.crc32(F.col("text").cast("binary")).alias("decoded_crc32"))


@query("op2_pii")
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    spans = pii.find(read(spark, folder, "documents"))
    return spans.select(
        "doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )


@query("op3_language")
def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    learnt = language.dictionaries(docs, ~held_out())
    return language.identify(docs, learnt, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "sure")


@query("op4_shards")
def op4_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_documents(read(spark, folder, "documents"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_ngram_join")
def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.classes(read(spark, folder, "documents")).drop("key")


@query("op6_decontaminate")
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.overlaps(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query("op7_span_dedup")
def op7_span_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that lose text, with the spans they lose."""
    found = span_dedup.repeated_spans(read(spark, folder, "documents"))
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.select("doc_id", F.size("spans").cast("long").alias("n_spans"), length.alias("removed_chars"), spans.alias("spans"))


_PATTERNS = " OR ".join(f"spot ~ '(?s).*{urls.to_regex(p).removeprefix('(?s)')}.*'" for verdict, p in urls.PATTERN_RULES if verdict == "block")
_EXCEPTIONS = " OR ".join(f"spot ~ '(?s).*{urls.to_regex(p).removeprefix('(?s)')}.*'" for verdict, p in urls.PATTERN_RULES if verdict == "allow")


@query(
    "op8_url_filter",
    f"""
    WITH cut AS (
        SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), part AS (
        SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM cut
    ), named AS (
        SELECT *, '.' || host || path AS spot,
               CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
        FROM part
    )
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                WHEN {_EXCEPTIONS} THEN 'allow' WHEN {_PATTERNS} THEN 'block' ELSE 'allow' END AS verdict
    FROM named
    """,
)
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages").select("page_id", "url")
    return urls.filter_urls(pages, urls.default_rules(spark)).select("page_id", "host", "path", "rule", "verdict")


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    ratios = quality_rules.log_ratios(docs, quality_rules.trusted_documents(labels))
    return quality_rules.judge(docs, ratios, carry=["doc_id"])


@query("op10_quality_score")
def op10_quality_score(spark: SparkSession, folder: str) -> DataFrame:
    scores = quality_model.score(read(spark, folder, "documents"), read(spark, folder, "labels"), ~held_out(), ["doc_id"])
    return scores.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def _rounds() -> str:
    """Assignment and replacement as chained queries: near1, book1, near2, ..., the last assignment is near5."""
    near = """near{k} AS (
        SELECT v, p, arg_min(e, d * 256 + e) AS e, min(d) AS d
        FROM (SELECT v, b.p, e, list_sum(list_transform(list_zip(a, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM parts JOIN book{j} b USING (p))
        GROUP BY v, p
    )"""
    book = """mean{k} AS (
        SELECT p, e, list(m ORDER BY i) AS c FROM (
            SELECT p, e, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
            FROM (SELECT n.p, n.e, unnest(range(len(a))) AS i, unnest(a) AS x FROM near{k} n JOIN parts USING (v, p)) GROUP BY p, e, i
        ) GROUP BY p, e
    ), book{k} AS (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{j} b LEFT JOIN mean{k} m ON m.p = b.p AND m.e = b.e)"""
    last = vector_codes.ROUNDS + 1
    return ", ".join(near.format(k=k, j=k - 1) + (", " + book.format(k=k, j=k - 1) if k < last else "") for k in range(1, last + 1))


@query(
    "op11_vector_codes",
    f"""
    WITH kept AS (
        SELECT row_number() OVER (ORDER BY vec_id) - 1 AS v, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS whole
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), parts AS (
        SELECT v, p, list_slice(whole, 1 + p * len(whole) // 4, (p + 1) * len(whole) // 4) AS a FROM kept, range(4) t(p)
    ), book0 AS (SELECT p, v AS e, a AS c FROM parts WHERE v < 256), {_rounds()},
    coded AS (SELECT v, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near5 GROUP BY v),
    named AS (SELECT vec_id, label, code, error FROM coded JOIN kept USING (v))
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book4) AS codebooks_sha256
    FROM named
    """,
)
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    rows, books = vector_codes.compress(read(spark, folder, "embeddings"))
    out = vector_codes.with_label_error(rows)
    code = F.lower(F.hex("code"))
    return out.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


@query(
    "op12_setsketch",
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
    ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
    both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT doc_id, doc_id AS got FROM documents UNION SELECT doc_id, b FROM reach JOIN both_ways ON got = a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM (SELECT doc_id, min(got) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
    """,
)
def op12_setsketch(spark: SparkSession, folder: str) -> DataFrame:
    return setsketch.classes(read(spark, folder, "documents"))


@query(
    "op13_ranked_search",
    r"""
    WITH terms AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM documents
    ), wanted AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ), lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
    whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
    held AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term),
    weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, whole GROUP BY term, docs),
    measures AS (SELECT doc_id, 10 + (90 * n * docs) // total AS m FROM lengths, whole),
    scores AS (
        SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
        FROM wanted JOIN held USING (term) JOIN weights USING (term) JOIN measures USING (doc_id) GROUP BY item_id, doc_id
    )
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 10
    """,
)
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    found = ranked_search.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
