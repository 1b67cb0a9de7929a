"""Registered queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.llm import (
    chunks,
    html_text,
    packing,
    periodic_runs,
    pieces,
    quality,
    quality_rules,
    simhash,
    tool_calls,
    topk,
    toxicity,
    vector_graph,
    whitening,
)
from clicktide.llm.common import table
from clicktide.session import DEFAULTS, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators rely on, and the package for Python workers."""
    ship_package(spark)
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)


def tokenizer_file(name: str) -> str:
    """Place of a vocabulary file of the public tokenizers, which every machine has installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def register(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


@register("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@register("op3_substring_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage that repeats across documents, with its place and first holder."""
    return chunks.repeated_runs(table(spark, sf_dir, "documents"))


@register("op5_sentencepiece")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    made = pieces.encode_decode(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return made.select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in the packed sequences."""
    docs = table(spark, sf_dir, "documents")
    return packing.piece_digests(packing.pack(docs, tokenizer_file("byte_bpe_50k.json")))


@register("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register(
    "op7_exact_top_k",
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
        FROM embeddings
        WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id
        WHERE q.vec_id % 50 = 0
    )
    SELECT query_id, rank::INTEGER AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    WHERE rank <= 5
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(vectors, vectors.where("vec_id % 50 = 0"))


@register(
    "op9_embedding_near_dedup",
    """
    WITH RECURSIVE v AS (
        SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
    ), e AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.x, b.x) >= 0.9
    ), reach AS (
        SELECT vec_id AS a, vec_id AS b FROM v
        UNION
        SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a
    ), label AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT vec_id, count(e.b) AS n_links, component_id, vec_id = component_id AS kept
    FROM label LEFT JOIN e ON e.a = vec_id GROUP BY vec_id, component_id
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and component of every vector."""
    return vector_graph.near_duplicates(table(spark, sf_dir, "embeddings"))


@register("op2_html_text")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page, with its number of characters."""
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.char_length("text").cast("bigint")
    )


@register(
    "op4_tool_calls",
    """
    WITH RECURSIVE calls AS (
        SELECT *, 'call_' || conv_id || '_' || turn AS call_id, coalesce(role = 'user', false) AS asks
        FROM conversations WHERE coalesce(role <> 'assistant', true)
    ), results AS (
        SELECT *, 'call_' || conv_id || '_' || (turn - 1) AS call_id
        FROM conversations WHERE role = 'assistant'
    ), levels AS (
        SELECT conv_id, turn, call_id, 0 AS level FROM calls c
        WHERE NOT EXISTS (FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
        UNION ALL
        SELECT c.conv_id, c.turn, c.call_id, l.level + 1
        FROM levels l JOIN calls c ON c.conv_id = l.conv_id AND c.turn = l.turn + 2
    )
    SELECT c.conv_id, l.level, false AS is_result, c.turn, c.call_id,
           CASE WHEN EXISTS (FROM results r WHERE r.call_id = c.call_id)
                THEN 'answered' ELSE 'unanswered' END AS status,
           CASE WHEN text IS NULL THEN 'type of prompt'
                WHEN length(text) < 1 THEN 'minLength of prompt'
                WHEN asks AND length(text) > 600 THEN 'maxLength of prompt' ELSE '' END AS problems,
           '{"arguments":{' ||
           CASE WHEN asks THEN '"conversation":' || c.conv_id || ',' ELSE '' END
           || '"prompt":' || coalesce(to_json(text)::VARCHAR, 'null') ||
           CASE WHEN asks THEN ',"turn":' || c.turn ELSE '' END
           || '},"id":"' || c.call_id || '","parent":' ||
           CASE WHEN c.turn > 1 THEN '"call_' || c.conv_id || '_' || (c.turn - 2) || '"' ELSE 'null' END
           || ',"tool":"' || CASE WHEN asks THEN 'answer' ELSE 'configure' END || '"}' AS json
    FROM calls c JOIN levels l USING (call_id)
    UNION ALL
    SELECT r.conv_id, l.level, true, r.turn, r.call_id,
           CASE WHEN l.call_id IS NULL THEN 'orphan' ELSE 'linked' END, '',
           '{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"id":"' || r.call_id || '"}'
    FROM results r LEFT JOIN levels l USING (call_id)
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of every conversation as linked tool calls and results, in canonical JSON."""
    conversations = table(spark, sf_dir, "conversations")
    linked = tool_calls.link(
        tool_calls.calls_of_conversations(conversations),
        tool_calls.results_of_conversations(conversations),
        tool_calls.SCHEMAS,
    )
    return linked.withColumn("problems", F.concat_ws("; ", "problems"))


@register("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, and digests of all runs and the collapsed text."""
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"))


@register(
    "op13_quality_rules",
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text
        FROM documents
    ), w AS (
        SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
               list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM d
    ), windows AS (
        SELECT r, i, list_slice(words, i, i + 7) AS held
        FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
    ), twice AS (
        SELECT r, unnest(list(i)) AS i FROM windows GROUP BY r, held HAVING count(*) > 1
    ), repeats AS (
        SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS place FROM twice) GROUP BY r
    ), c AS (
        SELECT w.r, doc_id, stratum, len(words) AS n_words,
               coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
               len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
               len(lines) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
               length(regexp_replace(text, '[^!?]', '', 'g')) AS n_marks
        FROM w LEFT JOIN repeats ON repeats.r = w.r
    ), v AS (
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
               CASE WHEN NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) THEN
               [1000 * n_symbols // n_words, 1000 * n_repeat_words // n_words,
                1000 * n_dup_lines // n_lines, 1000 * n_capitals // word_chars, 1000 * n_marks // n_words,
                1000 * word_chars // n_words, -(1000 * word_chars // n_words)] END AS x
        FROM c
    ), known AS (
        SELECT doc_id, min(quality) AS label FROM labels
        WHERE quality IN (0, 1) AND doc_id IS NOT NULL
        GROUP BY doc_id HAVING min(quality) = max(quality)
    ), l AS (
        SELECT stratum, label, x, md5(doc_id::VARCHAR) < '8' AS proposing
        FROM v JOIN known USING (doc_id) WHERE NOT base_failed
    ), ranked AS (
        SELECT stratum, rule, value, count(*) OVER (PARTITION BY stratum, rule) AS n,
               count(*) OVER (PARTITION BY stratum, rule ORDER BY value DESC) - count(*) OVER
               (PARTITION BY stratum, rule, value) AS above
        FROM (SELECT stratum, generate_subscripts(x, 1) AS rule, unnest(x) AS value
              FROM l WHERE proposing AND label = 1)
    ), by_rule AS (
        SELECT stratum, level, rule, min(value) AS cutoff
        FROM ranked, (SELECT unnest([0, 1, 2, 4, 8, 16, 32]) AS level)
        WHERE above * 1000 <= level * n GROUP BY ALL
    ), cuts AS (
        SELECT stratum, level, list(cutoff ORDER BY rule) AS y
        FROM (FROM by_rule UNION ALL
              SELECT stratum, -1, rule, max(cutoff) OVER (PARTITION BY rule) FROM by_rule WHERE level = 0)
        GROUP BY stratum, level
    ), counted AS (
        SELECT stratum, level, count(*) FILTER (NOT proposing AND label = 1) AS n,
               count(*) FILTER (NOT proposing AND label = 1 AND bad) AS k,
               count(*) FILTER (proposing AND label = 0 AND bad) * count(*) FILTER (proposing AND label = 1)
               - count(*) FILTER (proposing AND label = 1 AND bad) * count(*) FILTER (proposing AND label = 0)
               AS gain
        FROM (SELECT *, list_bool_or(list_transform(list_zip(x, y), lambda p: p[1] > p[2])) AS bad
              FROM l JOIN cuts USING (stratum))
        GROUP BY stratum, level
    ), tails AS (
        SELECT *, CASE WHEN k >= n * 0.05 THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
                   lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                                 + i * ln(0.05) + (n - i) * ln(0.95)))) END
               > 0.05 / (SELECT count(DISTINCT stratum) FROM counted WHERE n > 0) AS failed
        FROM counted
    ), chosen AS (
        SELECT stratum, arg_max(y, (gain, -level)) AS y
        FROM tails t JOIN cuts USING (stratum, level)
        WHERE gain > 0 AND NOT EXISTS (FROM tails f WHERE f.stratum = t.stratum AND f.failed AND f.level <= t.level)
        GROUP BY stratum
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT coalesce(
               list_bool_or(list_transform(list_zip(x, y), lambda p: p[1] > p[2])), false) AS kept
    FROM v LEFT JOIN chosen USING (stratum)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and the verdict of certified quality rules for every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every vector in the 32 greatest principal directions."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
