"""One registered query an operator, with production settings, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascata.llm import (
    common,
    decontamination,
    line_dedup,
    minhash,
    quality_classifier,
    quality_rules,
    sentencepiece_codec,
    sharding,
    simhash,
    spelling,
    toxicity,
    url_filters,
    warc,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            common.ship(spark)
            return build(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def piece_model() -> bytes:
    import public_tokenizers

    return sentencepiece_codec.read_model(public_tokenizers.path("piece_bpe_32k.model"))


@query("op1_sentencepiece")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    model = piece_model()
    decoded = table(spark, folder, "documents").select(
        "doc_id", sentencepiece_codec.coded_column(F.col("text"), model).alias("_c")
    ).select("doc_id", "_c.*")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op2_toxicity")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = toxicity.fit(documents, table(spark, folder, "labels"))
    return toxicity.score_documents(documents, model)


@query("op5_sharding")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"), 24)


@query("op7_quality_rules")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op9_quality_classifier")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.score_documents(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )


@query(
    "op10_url_filters",
    """
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NOT NULL AND strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail FROM pages),
parts AS (
  SELECT page_id, regexp_extract(tail, '^([^/?#]*)', 1) AS raw,
    regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
named AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path
  FROM parts),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
hits AS (
  SELECT n.page_id, n.host, n.path, r.h || r.p AS rule, r.v,
    row_number() OVER (PARTITION BY n.page_id ORDER BY length(r.h || r.p) DESC) AS k
  FROM named n LEFT JOIN rules r ON (n.host = r.h OR n.host LIKE '%.' || r.h) AND starts_with(n.path, r.p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM hits WHERE k = 1
""",
)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.judge_pages(table(spark, folder, "pages"), URL_RULES)


@query("op4_simhash")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents"), 3, 2)


@query("op3_decontamination")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("_d")


@query("op6_line_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(documents, counts=True)


@query("op11_minhash")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.fingerprint_documents(table(spark, folder, "documents"))


@query("op12_spelling")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


@query("op13_whitening")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def crawl_records(pages: DataFrame) -> DataFrame:
    """A crawl read off the pages table: a full response a page, and a later revisit of its url.

    Page p is fetched in minute p and asked for again a day later. Of five revisits one brings another
    entity tag, one has only a date, one has no validator, and one comes before the page was fetched.
    """
    kind = F.col("page_id") % 5
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    made = F.col("page_id") * 60

    def headers(*pairs):
        return F.map_from_arrays(F.array(*[F.lit(k) for k, _ in pairs]), F.array(*[v for _, v in pairs]))

    response = F.struct(
        (F.col("page_id") * 2).alias("record_id"), "url", made.alias("at"), F.lit("response").alias("kind"),
        headers(
            ("content-type", F.lit("text/html")), ("date", made.cast("string")), ("etag", tag),
            ("last-modified", made.cast("string")), ("set-cookie", F.lit("a=1")),
        ).alias("headers"),
        F.md5(F.coalesce("html", F.lit(""))).alias("digest"),
    )
    seen = F.when(kind == 3, made - 60).otherwise(made + 86400)
    date = ("date", seen.cast("string"))
    revisit = F.struct(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", seen.alias("at"), F.lit("revisit").alias("kind"),
        F.when(kind == 0, headers(date, ("etag", F.lit('"other"'))))
        .when(kind == 1, headers(date, ("last-modified", made.cast("string")), ("set-cookie", F.lit("b=2"))))
        .when(kind == 2, headers(date))
        .otherwise(headers(date, ("etag", F.concat(F.lit("W/"), tag)), ("server", F.lit("x")))).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return pages.select(F.explode(F.array(response, revisit)).alias("r")).select("r.*")


@query(
    "op8_warc_revisits",
    r"""
WITH bare AS (
  SELECT page_id, md5(coalesce(html, '')) AS h,
    regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '') AS b
  FROM pages WHERE url IS NOT NULL),
keyed AS (
  SELECT page_id, h,
    regexp_replace(regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(list_filter(string_split(regexp_extract(b, '\?(.*)$', 1), '&'),
         lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref)='))) > 0
       THEN '?' || array_to_string(list_sort(list_filter(string_split(regexp_extract(b, '\?(.*)$', 1), '&'),
         lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref)='))), '&') ELSE '' END AS u
  FROM bare),
seen AS (
  SELECT page_id, h, u, page_id * 60 AS made,
    CASE WHEN page_id % 5 = 3 THEN page_id * 60 - 60 ELSE page_id * 60 + 86400 END AS "at" FROM keyed),
found AS (
  SELECT v.page_id, v.u, v."at", v.h, v.made, r.page_id AS p, r.h AS ph, r.made AS pm,
    row_number() OVER (PARTITION BY v.page_id ORDER BY r.made DESC NULLS LAST, r.page_id DESC) AS k
  FROM seen v LEFT JOIN seen r ON v.u = r.u AND r.made < v."at"),
judged AS (
  SELECT *, CASE WHEN p IS NULL THEN 'no_response'
    WHEN page_id % 5 = 0 THEN 'changed'
    WHEN page_id % 5 = 1 THEN CASE WHEN made = pm THEN 'resolved' ELSE 'changed' END
    WHEN page_id % 5 = 2 THEN 'unchecked'
    WHEN h = ph THEN 'resolved' ELSE 'changed' END AS status
  FROM found WHERE k = 1)
SELECT page_id * 2 + 1 AS record_id, u AS url, "at", status, p * 2 AS response_id,
  CASE WHEN status = 'resolved' THEN ph END AS digest,
  CASE WHEN status = 'resolved' THEN 'content-type=text/html;date=' || "at" || ';etag='
    || CASE WHEN page_id % 5 = 1 THEN '"' || ph || '"' ELSE 'W/"' || h || '"' END
    || ';last-modified=' || pm || ';set-cookie=a=1' END AS headers
FROM judged
""",
)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.resolve(crawl_records(table(spark, folder, "pages")))
    shown = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return found.withColumn("headers", F.array_join(shown, ";"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
