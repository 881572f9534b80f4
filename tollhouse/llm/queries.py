"""The queries opN_<name>: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollhouse.llm import bin_packing, exact_dedup, hilbert_shards, html_text, merkle, nbsvm, oracles, paragraph_dedup, piece_codec, pii_bootstrap, quality_rules, simhash, token_links, url_rules

Query = Callable[[SparkSession, str], DataFrame]

#: Rules of the URL filter: verdict, host, path.
URL_RULES = (
    url_rules.UrlRule("allow", "com", "/"),
    url_rules.UrlRule("block", "example.com", "/en/"),
    url_rules.UrlRule("allow", "www.example.com", "/en/"),
    url_rules.UrlRule("block", "net", "/es/"),
    url_rules.UrlRule("block", "net", "/fr/"),
)
#: Parts of host names that block where no rule speaks: whole labels, or whole between hyphens.
URL_WORDS = ("ads", "adserver", "adult", "casino", "cheap-pills", "free-bets", "malware", "phishing", "porn", "spam", "tracker", "xxx")
#: The same as globs over the canonical URL.
URL_GLOBS = tuple(f"{before}{word}{after}" for word in URL_WORDS for before in ("", "*.", "*-") for after in ("/**", ".*/**", "-*/**", ":*/**"))
SEQUENCE_TOKENS, END_ID = 1024, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encoded(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), kind="bpe")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert_shards.shards(table(spark, sf_dir, "documents"), n=8, dims=("lang", "source"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judged(table(spark, sf_dir, "pages"), URL_RULES, URL_GLOBS).select("page_id", "host", "path", "rule", "verdict")


def op7_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bin_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID, SEQUENCE_TOKENS)
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = nbsvm.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality")
    return scores.select("doc_id", "held_out", "score", "predicted")


def op10_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each span of words that a document loses."""
    spans = paragraph_dedup.substring_removals(table(spark, sf_dir, "documents"))
    return spans.select("doc_id", F.inline("spans")).select("doc_id", F.col("first").alias("first_word"), F.col("n").alias("n_words"), F.col("keep_id").alias("keep_doc_id"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_bootstrap.personal_data(table(spark, sf_dir, "documents"))
    counts = (pii_bootstrap.span_count(F.col("base"), k).alias(f"n_{k}") for k in pii_bootstrap.KINDS)
    base = F.sha2(pii_bootstrap.spans_text(F.col("base")).cast("binary"), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), pii_bootstrap.spans_text(F.concat("base", "added")).alias("spans"))


def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_links.token_links(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


#: The columns of a leaf, in order.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents`` and what its proofs say of the rows after n_chars of some was raised by one."""
    docs = table(spark, sf_dir, "documents")
    hit = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    raised = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    tampered = F.when(hit, merkle.leaf_hash([raised if c == "n_chars" else F.col(c) for c in LEAF]))
    rows = merkle.manifest(docs, LEAF, "lang", "doc_id", fanout=2, carry={"tampered": tampered})
    rows = rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash().alias("proof_sha256"), merkle.folded(F.coalesce("tampered", "leaf")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_quality_rules,
        op3_sentencepiece,
        op4_simhash,
        op5_hilbert_shards,
        op6_url_filter,
        op7_bin_packing,
        op8_html_text,
        op9_quality_classifier,
        op10_paragraph_dedup,
        op11_pii,
        op12_token_links,
        op13_merkle,
    )
}
