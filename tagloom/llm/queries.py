"""The registered queries of the training-data operators and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import (
    chat_format, curriculum, decontamination, embedding_links, jaccard_join, line_templates, nearest, packing, periodic_runs, substring_dedup,
    suffix_dedup, toxicity, whitening,
)
from tagloom.llm.shared import ship_package, stage, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, by a network that has not seen the held-out labels; 0 without labels of both kinds."""
    scored = toxicity.score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), unknown=toxicity.UNKNOWN)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are control strings, rendered, masked and read back."""
    words = "</s>[INST] ok [/INST]"
    odd = spark.createDataFrame([(-7, 0, "user", words), (-7, 1, "assistant", words)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(odd)
    return chat_format.read_back(chat_format.format_chats(turns, tokenizer_path()))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return nearest.nearest(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op4_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of packed sequences of 2048 tokens."""
    pieces = packing.tokenise(table(spark, sf_dir, "documents"), tokenizer_path())
    return packing.pack(pieces).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without bytes in strings of 400 bytes that start elsewhere too."""
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-word windows that an earlier document has."""
    cut = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class and the number of links of every document at a similarity of 0.8 of five-word shingles."""
    return jaccard_join.near_copies(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines whose templates recur in ten texts or more."""
    cut = line_templates.without_recurring(table(spark, sf_dir, "documents"), report=True)
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.9."""
    return embedding_links.links(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, with the training position of its first repeat."""
    mixed = stage(curriculum.mix(table(spark, sf_dir, "documents")), "mix")
    keys = ["doc_id", "source", "content", "start"]
    placed = curriculum.repeats(mixed).groupBy(*keys).agg(F.sum("words").alias("words"), F.min("position").alias("position"))
    placed = placed.select(F.struct(*keys).alias("row"), "words", "position")
    same = mixed["doc_id"].eqNullSafe(F.col("row.doc_id")) & mixed["source"].eqNullSafe(F.col("row.source"))
    same = same & (mixed["content"] == F.col("row.content")) & (mixed["start"] == F.col("row.start"))
    return mixed.join(placed, same & (mixed["size"] > 0), "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"),
        F.round("position", 6).alias("first_position"),
    )


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of every document that stand in windows of ten words of the benchmark, and the items they come from."""
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors along the four leading components of their covariance, at unit variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """The documents; of those whose id's checksum ends in 0 the words from a place on are made to repeat."""
    sum_ = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(sum_ / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), times))
        return F.concat(F.slice(words, 1, a), F.slice(tail, F.lit(1), (n - a).cast("int")))

    words = F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    made = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.array_join(repeated(w), " ")).otherwise(""))[0]
    return docs.select("doc_id", F.when((F.pmod(sum_, F.lit(10)) == 0) & F.col("text").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, a tenth of which get a repeating tail first."""
    found = periodic_runs.find_runs(with_periodic_tails(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"), F.floor(-F.col("top.length") * 1000 / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with the package sent to the workers first."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_sequence_packing": op4_sequence_packing,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_line_dedup": op8_line_dedup,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_source_mixing": op10_source_mixing,
    "op11_decontamination": op11_decontamination,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}
QUERIES = {name: shipped(query) for name, query in QUERIES.items()}

TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
CHECKS = {
    "op3_nearest_neighbours": """
        WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND list_aggregate(list_transform(embedding, lambda x: x * x), 'sum') > 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op6_substring_dedup": """
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        g AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
              FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
        m AS (SELECT s, min(doc_id) AS low FROM g GROUP BY s),
        c AS (SELECT DISTINCT g.doc_id, unnest(range(g.i, g.i + 50)) AS p FROM g JOIN m ON g.s = m.s AND g.doc_id > m.low),
        r AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id)
        SELECT d.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
               sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
                      list_filter(w, lambda x, k: NOT list_contains(gone, k)) END, ' ')) AS kept_sha256
        FROM d LEFT JOIN r ON d.doc_id = r.doc_id""",
    "op11_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, {TERMS} AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {TERMS} AS w FROM benchmark),
        t AS (SELECT item_id, len(s) AS n, array_to_string(s, ' ') AS s FROM (
                SELECT item_id, w[i:i + 9] AS s FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0))),
        g AS (SELECT row_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
              FROM (SELECT row_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM t))),
        m AS (SELECT DISTINCT g.row_id, g.i, g.n, t.item_id FROM g JOIN t ON g.s = t.s AND g.n = t.n),
        h AS (SELECT row_id, count(*) AS n_hit FROM (SELECT DISTINCT row_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY row_id),
        k AS (SELECT row_id, list_sort(list(DISTINCT item_id)) AS ids FROM m WHERE item_id IS NOT NULL GROUP BY row_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0) AS n_items,
               sha256(array_to_string(coalesce(ids, []), ',')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN h ON d.row_id = h.row_id LEFT JOIN k ON d.row_id = k.row_id""",
    "op10_source_mixing": """
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                          md5(CAST(doc_id AS VARCHAR)) AS turn, md5(coalesce(text, '')) AS content FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
              FROM d GROUP BY source),
        w AS (SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size * 3.0::DOUBLE AS cap FROM s),
        l AS (SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, place
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, place
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
        t AS (SELECT source, source_size, place, CASE WHEN level * weight >= cap THEN cap ELSE
                     max(CASE WHEN level * weight < cap THEN level END) OVER () * weight END AS target FROM l),
        p AS (SELECT d.*, t.source_size, t.target, t.place, round(t.target)::BIGINT AS asked,
                     coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY turn, doc_id, content
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        q AS (SELECT *, CASE WHEN source_size > 0 THEN asked // source_size ELSE 0 END AS whole FROM p),
        k AS (SELECT *, CAST(whole * size + greatest(0, least(size, asked - whole * source_size - start)) AS BIGINT) AS taken FROM q),
        f AS (SELECT *, CASE WHEN taken > 0 THEN start / round(target) END AS share,
                     CASE WHEN place % 2 = 0 THEN -0.5::DOUBLE ELSE 0.5::DOUBLE END AS drift FROM k)
        SELECT doc_id, size, source_size, target, taken, round(2 * share / (1 + drift +
               sqrt(greatest(0.0::DOUBLE, (1 + drift) * (1 + drift) - 4 * drift * share))), 6) AS first_position FROM f""",
}
