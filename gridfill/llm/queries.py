"""One query for each operator over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfill.llm import decontaminate, embedding_dedup, filter_audit, html_text, infill, line_dedup, near_dedup, packing, quality, quotes, repeats, secret_scan, url_rules


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their words inside 10-word windows of the benchmark, and the items found."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(documents, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in reply order without their quotations."""
    return quotes.thread_conversations(_table(spark, sf_dir, "conversations"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their groups at similarity 0.8 over pairs of words."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=2)


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their repeated strings of 200 bytes."""
    return repeats.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their chances of being low or toxic, and whether a filter keeps them."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.fit_and_score(documents, _table(spark, sf_dir, "labels"), keep_text=False).select("row.doc_id", "p_low", "p_toxic")
    limit = quality.Settings().reject
    return scored.withColumn("kept", (F.col("p_low") < limit) & (F.col("p_toxic") < limit))


URL_RULES = """SELECT * FROM VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block') AS rules(host, path, action)"""


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, spark.sql(URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with their links and groups at cosine 0.95."""
    return embedding_dedup.link_vectors(_table(spark, sf_dir, "embeddings"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on over a tenth of their source's pages."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(documents).select("doc_id", "n_lines", "n_dropped", "text")


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their secrets, from an empty ledger."""
    found, _ = secret_scan.scan_versions(_table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    of = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["kind"].isin(*secret_scan.BASE))
    return found.select("doc_id", *[of(k) for k in secret_scan.BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def tokenizer_file() -> str:
    """The word-wise tokenizer's file, where the package that brings it is installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of up to 2048 tokens."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(documents, tokenizer_file())


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents rearranged for filling in the middle, and what they are rebuilt to."""
    done = infill.fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters keep and lose in every order, for each source."""
    return filter_audit.audit(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"), _table(spark, sf_dir, "labels"))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return html_text.extract_text(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_quotes, op3_near_dedup, op4_repeats, op5_quality, op6_url_rules, op7_embedding_dedup, op8_line_dedup,
    op9_secret_scan, op10_packing, op11_infill, op12_filter_audit, op13_html_text)}
