"""The dealt operators as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm import bpe, embeddings, language, leaks, lines, lm, periods, pii, quality, repeats, sharding, simhash, tries
from postloom.llm.tables import crc_remainder, read
from postloom.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

# Stands for the secret that a user passes; surrogates can't be linked across keys.
SURROGATE_KEY = "example key"


def quality_weights(spark: SparkSession, sf_dir: str) -> quality.Weights:
    """Learnt from the labelled documents outside the held-out fifth."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality.fit(docs, labels.filter(crc_remainder(F.col("doc_id"), 5) != 0))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(read(spark, sf_dir, "documents"), quality_weights(spark, sf_dir))
    return scored.select(
        F.col("id").alias("doc_id"),
        (crc_remainder(F.col("id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"),
        "passages",
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, SURROGATE_KEY).select("doc_id", "n_entities", F.array_join("entity_kinds", ",").alias("kinds"), "text")


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    held_out = crc_remainder(F.col("doc_id"), 7) == 2
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    scored = lm.score_texts(docs, docs.filter(~held_out), path, public_tokenizers.PATTERN)
    scored = scored.withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.95)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = read(spark, sf_dir, "documents")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, bpe.QUICK_PATTERN, with_ids=False)
    return encoded.withColumnRenamed("id", "doc_id")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(read(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and benchmark item found in it; documents without any have no row."""
    found = leaks.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.fit(docs.filter(crc_remainder(F.col("doc_id"), 4) != 2))
    return language.predict(docs, model).select(
        F.col("id").alias("doc_id"),
        (crc_remainder(F.col("id"), 4) == 2).alias("held_out"),
        F.col("language").alias("lang_pred"),
        "score",
        "ambiguous",
    )


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(read(spark, sf_dir, "documents"), min_bytes=200, keep_first=False)
    return cut.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def some_made_periodic(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``; every tenth text, by its id's crc32, repeats a stretch of its words from some word on."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.floor(crc / 10).alias("g"), (crc % 10 == 0).alias("made"))
    rows = rows.withColumn("word", F.when(F.col("made"), F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")))
    rows = rows.withColumn("n", F.size("word"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    source = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1),
        lambda i: F.get("word", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")),
    )
    return rows.select("doc_id", F.when(F.col("made") & (F.col("n") > 0), F.array_join(source, " ")).otherwise(F.col("text")).alias("text"))


def op11_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(some_made_periodic(read(spark, sf_dir, "documents")))
    # Runs come by start, then period; of equal exponents the first stays.
    best = F.reduce(
        "runs",
        F.get("runs", F.lit(0)),
        lambda top, r: F.when(r["length"] * top["period"] > top["length"] * r["period"], r).otherwise(top),
    )
    line = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    found = found.withColumn("best", best)
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(line, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.dedupe_lines(read(spark, sf_dir, "documents"))
    return cut.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def rebuilt_conversations(conversations: DataFrame) -> DataFrame:
    """Each conversation with the first few turns of the first one of its hundred in place of its own."""
    first = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(6)).cast("int")
    heads = conversations.filter(F.col("id") % 100 == 0).select(F.col("id").alias("head_id"), F.slice("turns", 1, 5).alias("head"))
    rows = conversations.withColumn("head_id", F.col("id") - F.col("id") % 100).join(heads, "head_id", "left")
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), first)
    return rows.select("id", F.concat(head, F.slice("turns", first + 1, F.size("turns"))).alias("turns"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = tries.turn_sequences(read(spark, sf_dir, "conversations"))
    nodes = tries.prefix_trie(rebuilt_conversations(sequences))
    return nodes.withColumn("ends_sha256", F.lower(F.hex("ends"))).drop("ends")


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_simhash": op2_simhash,
    "op3_pii": op3_pii,
    "op4_lm": op4_lm,
    "op5_embeddings": op5_embeddings,
    "op6_bpe": op6_bpe,
    "op7_sharding": op7_sharding,
    "op8_leaks": op8_leaks,
    "op9_language": op9_language,
    "op10_repeats": op10_repeats,
    "op11_periods": op11_periods,
    "op12_lines": op12_lines,
    "op13_conversations": op13_conversations,
}

_KEY = """trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"""
LINES = f"""WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, {_KEY} AS key FROM lines
), held AS (
  SELECT key, min(doc_id) AS keep FROM keyed WHERE length(key) >= {lines.MIN_CODE_POINTS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT k.*, h.key IS NOT NULL AND k.doc_id <> h.keep AS gone FROM keyed k LEFT JOIN held h ON k.key = h.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

def crc32_sql(number: str) -> str:
    """crc32 of a number's decimal digits, which this engine lacks: eight steps of one bit for each digit."""
    return f"""list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({number}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))"""


CONVERSATIONS = f"""WITH own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), kept AS (
  SELECT *, xor({crc32_sql("conv_id")}, 4294967295) % 6 AS h FROM own
), rebuilt AS (
  SELECT k.conv_id, list_concat(coalesce(list_slice(b.turns, 1, k.h), []), list_slice(k.turns, k.h + 1, len(k.turns))) AS turns
  FROM kept k LEFT JOIN own b ON b.conv_id = k.conv_id - k.conv_id % 100
), members AS (
  SELECT conv_id, len(turns) AS n_turns, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt
), nodes AS (
  SELECT depth, md5(list_slice(turns, 1, depth)::VARCHAR) AS node, min(conv_id) AS conv_id, count(*) AS n_convs,
    max(n_turns) = depth AS childless, any_value(list_slice(turns, 1, depth)) AS path,
    string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE n_turns = depth) AS ends
  FROM members GROUP BY 1, 2
), weighed AS (
  SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(path[depth].text) END AS saved FROM nodes
), above AS (
  SELECT *, unnest(range(depth + 1)) AS top FROM weighed
), sums AS (
  SELECT top AS depth, md5(list_slice(path, 1, top)::VARCHAR) AS node, count(*) FILTER (WHERE childless) AS n_leaves,
    count(*) FILTER (WHERE depth = top + 1) AS n_children, sum(saved)::BIGINT AS saved_tokens
  FROM above GROUP BY 1, 2
)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, n_children, n_leaves, saved_tokens,
  sha256(coalesce(w.ends, '')) AS ends_sha256
FROM weighed w JOIN sums s ON s.depth = w.depth AND s.node = w.node
LEFT JOIN weighed p ON p.depth = w.depth - 1 AND p.node = md5(list_slice(w.path, 1, w.depth - 1)::VARCHAR)"""

SQL: dict[str, str] = {"op12_lines": LINES, "op13_conversations": CONVERSATIONS}


def registered() -> dict[str, Query]:
    def wrap(query: Query) -> Query:
        return lambda spark, sf_dir: query(prepare(spark), sf_dir)

    return {name: wrap(query) for name, query in QUERIES.items()}
