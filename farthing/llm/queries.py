"""Queries of the operators over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farthing.llm import chat, compression, contamination, merkle, minhash, mixing, passages, periods, resharding, secrets, token_files, toxicity, warc
from farthing.llm import sql
from farthing.llm.common import stored, table

#: Folder of the public vocabularies; ``FARTHING_TOKENIZERS`` names another.
TOKENIZERS = os.environ.get("FARTHING_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "word_bpe_49k.json"
TOXIC_AT = 0.3


def tokenizer(name: str = VOCABULARY) -> str:
    return f"{TOKENIZERS}/{name}"


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of words that documents share, with the document that keeps them."""
    return passages.repeated_passages(table(spark, folder, "documents")).select(
        "doc_id", F.col("start").alias("start_word"), (F.col("stop") - F.col("start")).alias("n_words"), F.col("first_doc").alias("first_doc_id"), "removed"
    )


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    names = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    longest = F.array_max(F.transform("matches", lambda m: m.length))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        "contaminated", F.coalesce(longest, F.lit(0)).cast("bigint").alias("longest_match"),
    )


def op3_warc_salvage(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.read_records(warc.write(table(spark, folder, "pages")), payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_chat_parts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id bigint, turn bigint, role string, text string")
    turns = rows.unionByName(extra).select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))
    back = chat.parsed(stored(chat.formatted(turns), "chats"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.char_length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op5_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    return compression.compression_bands(table(spark, folder, "documents"))


def held_out():
    """Rows that labels are never learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"), ~held_out())
    return toxicity.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted")
    )


def op7_flow_resharding(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = resharding.reshard(table(spark, folder, "documents"), resharding.old_layout())
    text = F.coalesce("text", F.lit(""))
    slim = rows.select("doc_id", "shard", "key", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return resharding.slots(slim).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_circulant_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op9_splitting_tree(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.takes(table(spark, folder, "documents"))


def op10_huffman_ids(spark: SparkSession, folder: str) -> DataFrame:
    files, book = token_files.write(table(spark, folder, "documents"), tokenizer())
    return token_files.read(files, book).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_secret_links(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.linked(table(spark, folder, "documents"))
    counts = [secrets.count_of("base", k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    spans = secrets.listed(F.concat("base", "linked"))
    return found.select("doc_id", *counts, F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"), spans.alias("spans"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaves, proofs and roots; half of the rows are checked against a text without its line ends."""
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    told = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(told, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.manifest(table(spark, folder, "documents"), fields, carry={"shown": merkle.leaf_digest(fields, text=text)})
    out = found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("before"), F.col("after")).alias("proof_sha256"),
                       merkle.folded(F.col("shown"), F.col("before"), F.col("after")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """A tenth of the texts, by the hash of their ids, go on from some word by repeating what follows it."""
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    cut = docs.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    cut = cut.withColumn("a", F.expr("if(n > 0, cast(g % n as int), 0)")).withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    tail = "slice(flatten(array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)"
    planted = F.expr(f"array_join(concat(slice(words, 1, a), {tail}), ' ')")
    return cut.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periods.repetitions(with_periodic_tails(table(spark, folder, "documents"))).withColumn("best", periods.longest(F.col("runs")))
    told = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_decontamination, op3_warc_salvage, op4_chat_parts, op5_compression_bands, op6_toxicity,
        op7_flow_resharding, op8_circulant_minhash, op9_splitting_tree, op10_huffman_ids,
        op11_secret_links, op12_merkle_manifest, op13_periodic_runs,
    )
}

_FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op3_warc_salvage": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM f
    """,
    "op4_chat_parts": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (SELECT *, role || chr(10) || text || chr(10) AS told,
                     9 + length(role) + 8 + length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|/?SYS>>|<SYS>>|</SYS>>)', '\1\\\2\3', 'g')) AS chars FROM c)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(told, '' ORDER BY turn)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op8_circulant_minhash": f"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
                                         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
        r(doc_id, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.reached)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
        FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)
    """,
    "op12_merkle_manifest": sql.MERKLE,
    "op13_periodic_runs": sql.RUNS,
}
