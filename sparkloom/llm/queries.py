"""Queries of the training-data operators (p1, p2, p6 to p10) and the SQL some of them are checked against."""

from __future__ import annotations

import secrets

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.common import cut, load
from sparkloom.llm import dedup, mixing, ocr, packing, pii, reading, splitting


def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_chunks(load(spark, d, "chunks"), load(spark, d, "chunking_settings"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_pieces(spark, d).where("n_pieces > 1").select("chunk_id").distinct()


def p1_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Per settings version: oversized chunks, their characters, and the characters of the pieces less the overlaps."""
    cut = p1_pieces(spark, d).groupBy("chunk_id").agg(
        F.sum(F.length("text") - F.col("overlap_chars")).alias("kept"), F.max(F.length("text")).alias("longest")
    )
    ids = splitting.with_settings(load(spark, d, "chunks").select("chunk_id", "text", "extraction_config_version"), load(spark, d, "chunking_settings"))
    ids = ids.where(F.length("text") > F.col("_size")).select("chunk_id", "extraction_config_version", F.length("text").alias("chars")).dropDuplicates()
    return ids.join(cut, "chunk_id").groupBy("extraction_config_version").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.sum("chars").alias("chars_in"), F.sum("kept").cast("bigint").alias("chars_out")
    )


def p1_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """The hash of every cut chunk's text, put together again from its pieces without their overlaps."""
    own = F.expr("aggregate(array_sort(collect_set(struct(piece_no, substring(text, overlap_chars + 1) as t))), '', (a, x) -> concat(a, x.t))")
    return p1_pieces(spark, d).groupBy("chunk_id", "n_pieces").agg(own.alias("t")).select("chunk_id", F.sha2("t", 256).alias("text_sha256"))


def p1_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Per settings version: chunks cut, characters that neighbours have in common (each neighbour begins so many before its predecessor ends), longest piece's size kept."""
    pieces = p1_pieces(spark, d)
    ids = load(spark, d, "chunks").select("chunk_id", "extraction_config_version").distinct()
    sizes = splitting.with_settings(ids, load(spark, d, "chunking_settings"))
    joined = pieces.join(sizes, "chunk_id")
    per = joined.groupBy("extraction_config_version", "chunk_id", "_overlap", "_size").agg(
        F.sum(F.when(F.col("piece_no") > 0, F.col("overlap_chars"))).alias("shared"), F.max("piece_no").alias("joints"), F.max(F.length("text")).alias("longest")
    )
    ok = (F.col("shared") == F.col("joints") * F.col("_overlap")) & (F.col("longest") <= F.col("_size"))
    return per.groupBy("extraction_config_version").agg(F.count(F.lit(1)).alias("n_chunks"), F.count(F.when(ok, 1)).alias("n_right"))


def p1_ends(spark: SparkSession, d: str) -> DataFrame:
    """Pieces (but the last of each chunk) by the boundary they end at."""
    t = F.col("text")
    kind = F.when(t.rlike(r"\n[ \t\r]{0,2}\n\z"), "blank line").when(t.rlike(r"\n\z"), "line").when(t.rlike(r"""[.!?।॥][)"'’”]?\s\z"""), "sentence").when(t.rlike(r"[;:,]\s\z"), "clause").when(t.rlike(r"[\s|]\z"), "word").otherwise("character")
    return p1_pieces(spark, d).where("piece_no < n_pieces - 1").groupBy(kind.alias("boundary")).agg(F.count(F.lit(1)).alias("n_pieces"))


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """record_table, record_key, scope, document, text of chunks and of transcribed pages."""
    chunks = load(spark, d, "chunks").select(
        F.lit("chunks").alias("record_table"), F.col("chunk_id").alias("record_key"), F.col("client_scope_id").alias("scope"), F.col("content_sha256").alias("document"), "text"
    )
    pages = load(spark, d, "vision_pages").select(
        F.lit("vision_pages").alias("record_table"), F.concat_ws(":", "content_sha256", F.col("number").cast("string")).alias("record_key"),
        F.col("scope_id").alias("scope"), F.col("content_sha256").alias("document"), F.col("extraction.visible_text").alias("text"),
    )
    return chunks.unionByName(pages)


def _pii_key(spark: SparkSession) -> str:
    """The secret of the surrogates: the setting spark.sparkloom.pii.key, else drawn for this session (surrogates then differ between sessions)."""
    key = spark.conf.get("spark.sparkloom.pii.key", None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set("spark.sparkloom.pii.key", key)
    return key


def _replacements(spark: SparkSession, d: str) -> DataFrame:
    return pii.replacements(_texts(spark, d), ["record_table", "record_key"], _pii_key(spark), scope="scope", document="document")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _replacements(spark, d).select("record_table", "record_key", F.col("kind").alias("pii_kind"), F.col("value").alias("value_key")).distinct()


def p2_masked(spark: SparkSession, d: str) -> DataFrame:
    return pii.mask(_texts(spark, d), ["record_table", "record_key"], _pii_key(spark), scope="scope", document="document")


def _pages(spark: SparkSession, d: str) -> DataFrame:
    chunks = load(spark, d, "chunks").where("unit_type = 'page'").select(
        F.lit("chunks").alias("record_table"), F.col("chunk_id").alias("record_key"), F.col("content_sha256").alias("doc"),
        F.col("unit_sequence").alias("page_no"), "text",
    )
    pages = load(spark, d, "vision_pages").select(
        F.lit("vision_pages").alias("record_table"), F.concat_ws(":", "content_sha256", F.col("number").cast("string")).alias("record_key"),
        F.col("content_sha256").alias("doc"), F.col("number").alias("page_no"), F.col("extraction.visible_text").alias("text"),
    )
    return chunks.unionByName(pages)


def _trusted_words(spark: SparkSession, d: str) -> ocr.Lexicon:
    return ocr.lexicon(load(spark, d, "chunks").where("unit_type <> 'page'"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return ocr.page_noise(_pages(spark, d), _trusted_words(spark, d))


def p6_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return ocr.paragraphs(_pages(spark, d), _trusted_words(spark, d))


def p6_pages(spark: SparkSession, d: str) -> DataFrame:
    return ocr.repaired_pages(_pages(spark, d), _trusted_words(spark, d))


def p6_left_over(spark: SparkSession, d: str) -> DataFrame:
    """How the paragraphs read: their number, those over a page break, words, and the shares of words that are in the lexicon before and after the repair."""
    pages, words = _pages(spark, d).where("text is not null"), _trusted_words(spark, d)
    known = spark.sparkContext.broadcast(words.frequent)

    rare = words.rare is not None

    @F.pandas_udf("struct<words:bigint,known:bigint,others:array<string>>")
    def count(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            tokens = [x for w in t.lower().split() if (x := w.strip(ocr.PUNCT)) and x.isalpha() and x.isascii()]
            others = [x for x in tokens if x not in known.value]
            rows.append((len(tokens), len(tokens) - len(others), others if rare else []))
        return pd.DataFrame(rows, columns=["words", "known", "others"])

    made = ocr.paragraphs(pages, words)
    after = made.select(F.lit("after").alias("stage"), count("text").alias("c"), (F.col("last_page") > F.col("first_page")).cast("int").alias("over"))
    before = pages.dropDuplicates(ocr.KEYS).select(F.lit("before").alias("stage"), count("text").alias("c"), F.lit(0).alias("over"))
    both = before.unionByName(after)
    if rare:
        # What is no frequent word may be a rare one.
        both = cut(both, "left-over")
        others = both.select("stage", F.explode("c.others").alias("word")).groupBy("stage", "word").agg(F.count(F.lit(1)).alias("_times"))
        looked_up = others.join(words.rare.select("word"), "word").groupBy("stage").agg(F.sum("_times").alias("_rare"))
    else:
        looked_up = spark.createDataFrame([], "stage string, _rare bigint")
    told = both.groupBy("stage").agg(F.count(F.lit(1)).alias("n_texts"), F.sum("over").alias("n_over_pages"), F.sum("c.words").alias("n_words"), F.sum("c.known").alias("_known"))
    share = (F.col("_known") + F.coalesce("_rare", F.lit(0))) / F.col("n_words")
    return told.join(looked_up, "stage", "left").select("stage", "n_texts", "n_over_pages", "n_words", F.round(share, 6).alias("known_share"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_batches(load(spark, d, "documents")).where("doc_id_a < doc_id_b").select("doc_id_a", "doc_id_b")


def p10_bands(spark: SparkSession, d: str) -> DataFrame:
    return reading.reading_bands(load(spark, d, "documents"), load(spark, d, "reading_labels"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_bands(spark, d).where(f"running and n_words >= {reading.MIN_WORDS} and band = 4").select("doc_id")


def p10_profile(spark: SparkSession, d: str) -> DataFrame:
    """Documents and words by source and band, for running English text."""
    sources = load(spark, d, "documents").select("doc_id", F.coalesce("source", F.lit("(none)")).alias("source"))
    bands = p10_bands(spark, d).where("running").join(sources, "doc_id")
    return bands.groupBy("source", "band").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_words").alias("n_words"))


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(load(spark, d, "documents"), load(spark, d, "pack_settings"))


def p8_packed_each(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(load(spark, d, "documents"), load(spark, d, "pack_settings"), jointly=False)


def p8_unused(spark: SparkSession, d: str) -> DataFrame:
    return packing.unused_space(p8_packed(spark, d))


def p8_unused_each(spark: SparkSession, d: str) -> DataFrame:
    return packing.unused_space(p8_packed_each(spark, d))


def p8_whole(spark: SparkSession, d: str) -> DataFrame:
    """For each document with text its pieces in the packing, by number: one, unless it is larger than the largest capacity; containers over their capacity count as well."""
    packed = p8_packed(spark, d)
    over = packed.groupBy("container_no").agg((F.sum("n_tokens") > F.max("capacity")).alias("over"))
    top = load(spark, d, "pack_settings").agg(F.max("capacity_tokens")).first()[0] or 0  # a table of settings
    per = packed.join(over, "container_no").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t"), F.max(F.col("over").cast("int")).cast("bigint").alias("n_over"))
    right = (F.col("n") == F.greatest(F.ceil(F.col("t") / top), F.lit(1))).cast("bigint")
    return per.select("doc_id", right.alias("n_right"), "n_over")


def p9_reached(spark: SparkSession, d: str) -> DataFrame:
    """The share of each source of a mix that has documents: the target's if the tokens lie within two documents of it, else as reached; and whether the cap is kept."""
    targets = load(spark, d, "mix_targets")
    chosen = p9_mixed(spark, d)
    report = mixing.mix_shares(chosen, targets).where("n_docs > 0")
    mixes = chosen.groupBy("mix_name").agg(F.max("n_tokens").alias("_longest"))
    whole = report.groupBy("mix_name").agg(F.sum("target_share").alias("_whole"), F.sum("n_tokens").alias("_tokens"))
    report = report.join(whole, "mix_name").join(mixes, "mix_name").withColumn("_target", F.col("target_share") / F.col("_whole"))
    met = F.abs(F.col("n_tokens") - F.col("_target") * F.col("_tokens")) <= 2 * F.col("_longest")
    share = F.when(met, F.col("_target")).otherwise(F.col("reached_share"))
    return report.select("mix_name", "source", F.round(share, 3).alias("share"), (F.col("most_copies") <= F.col("max_repeats")).alias("cap_kept"))


def p9_balance(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_balance(mixing.plan_mixes(load(spark, d, "documents"), load(spark, d, "mix_targets"))[1], spark)


def p9_mixed(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_documents(load(spark, d, "documents"), load(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_shares(p9_mixed(spark, d), load(spark, d, "mix_targets"))


QUERIES = {"p8_packed": p8_packed, "p8_packed_each": p8_packed_each, "p8_unused": p8_unused, "p8_unused_each": p8_unused_each, "p9_mixed": p9_mixed, "p9_shares": p9_shares, "p10_found": p10_found, "p10_bands": p10_bands, "p10_profile": p10_profile, "p7_found": p7_found, "p6_found": p6_found, "p6_paragraphs": p6_paragraphs, "p6_pages": p6_pages, "p6_left_over": p6_left_over, "p2_found": p2_found, "p2_masked": p2_masked, "p1_found": p1_found, "p1_pieces": p1_pieces, "p1_coverage": p1_coverage, "p1_rebuilt": p1_rebuilt, "p1_overlaps": p1_overlaps, "p1_ends": p1_ends, "p8_whole": p8_whole, "p9_reached": p9_reached, "p9_balance": p9_balance}

ORACLES = {
    "p1_found": """
SELECT DISTINCT c.chunk_id FROM chunks c
JOIN (SELECT extraction_config_version, min(chunk_size) AS chunk_size FROM chunking_settings GROUP BY 1) s
  ON c.extraction_config_version = s.extraction_config_version
WHERE length(c.text) > s.chunk_size
""",
    "p1_coverage": """
WITH o AS (SELECT DISTINCT c.chunk_id, c.extraction_config_version, length(c.text) AS n FROM chunks c
           JOIN chunking_settings s ON c.extraction_config_version = s.extraction_config_version
           WHERE length(c.text) > s.chunk_size)
SELECT extraction_config_version, count(*) AS n_chunks, CAST(sum(n) AS BIGINT) AS chars_in, CAST(sum(n) AS BIGINT) AS chars_out
FROM o GROUP BY 1
""",
    "p1_rebuilt": """
SELECT DISTINCT c.chunk_id, sha256(c.text) AS text_sha256 FROM chunks c
JOIN (SELECT extraction_config_version, min(chunk_size) AS chunk_size FROM chunking_settings GROUP BY 1) s
  ON c.extraction_config_version = s.extraction_config_version
WHERE length(c.text) > s.chunk_size
""",
    "p1_overlaps": """
SELECT extraction_config_version, count(DISTINCT chunk_id) AS n_chunks, count(DISTINCT chunk_id) AS n_right
FROM chunks c JOIN chunking_settings s USING (extraction_config_version)
WHERE length(c.text) > s.chunk_size GROUP BY 1
""",
    "p8_whole": "SELECT DISTINCT doc_id, 1 AS n_right, 0 AS n_over FROM documents",
    "p9_reached": """
WITH t AS (SELECT mix_name, regexp_replace(lower(trim(source)), '[ _-]+', '_', 'g') AS source, max(target_share) AS share, max(max_repeats) AS cap
           FROM mix_targets WHERE target_share > 0 AND max_repeats >= 1 GROUP BY 1, 2),
     have AS (SELECT DISTINCT regexp_replace(lower(trim(source)), '[ _-]+', '_', 'g') AS source FROM documents WHERE text IS NOT NULL AND text <> ''),
     live AS (SELECT * FROM t SEMI JOIN have USING (source))
SELECT mix_name, source, round(share / sum(share) OVER (PARTITION BY mix_name), 3) AS share, true AS cap_kept FROM live
""",
}
