"""The operators over their whole tables, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ftrl, langid, line_crf
from .bloom_dedup import duplicate_groups
from .bpe import encode_checked
from .chat import canonical, format_chats, read_loss, read_turns
from .common import table
from .filter_audit import audit
from .fim import fim_digests
from .html_tree import extract
from .mixing import mix
from .pieces import token_counts
from .simhash_gray import near_groups
from .syncmers import edited_fingerprints

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 4096
SHINGLE_WORDS, MAX_BITS_APART = 3, 2

LEVELS = ("domain", "lang", "source")
WEIGHTS = {
    "domain": {"group0": 4, "group1": 3, "group2": 2, "group3": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 2},
    "source": {"src0": 2},
}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.8, 2, 17

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return keep


@query("op1_syncmer_fingerprints")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_checked(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), PIECES, TOKEN_LIMIT)


@query(
    "op5_bloom_dedup",
    r"""
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
    FROM (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
        FROM documents
    )
    WINDOW same AS (PARTITION BY text_sha256)
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "documents"))


@query("op9_simhash_gray")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), size=SHINGLE_WORDS, distance=MAX_BITS_APART)


@query(
    "op8_chat_format",
    r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL
        SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
    ),
    chats AS (
        SELECT conv_id, count(*) AS n_turns,
            string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
            coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS learnt,
            sum(33 + length(role) + length(text)
                + len(regexp_extract_all(role || chr(10) || text, '\\|<\||</?s>|\[/?INST\]'))) AS formatted_chars
        FROM turns GROUP BY conv_id
    )
    SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt) AS loss_chars,
        sha256(learnt) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
    FROM chats
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.sql(
        "SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), "
        "(-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)"
    )
    records = said.unionByName(control).select(
        F.col("conv_id").alias("chat_id"), F.col("turn").alias("position"),
        F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}).alias("payload"),
    )
    chats = format_chats(canonical(records))
    read = chats.select(
        F.col("chat_id").alias("conv_id"), read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("segments")).alias("loss"), F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"), F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


@query("op7_html_main_text")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query("op6_ftrl_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ftrl.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_line_crf_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def with_domain(docs: DataFrame) -> DataFrame:
    """Documents with ``domain``: sources numbered 0-4 are group0, 5-9 group1, ...; others "other"."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), r"(\d{1,9})$", 1)
    group = F.concat(F.lit("group"), F.floor(number.cast("int") / 5).cast("string"))
    return docs.withColumn("domain", F.when(number == "", F.lit("other")).otherwise(group))


def _weight_sql(column: str) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {weight}" for name, weight in WEIGHTS[column].items())
    return f"CASE {column} {cases} ELSE 1 END"


def _fill_sql(nodes: str, parents: str, column: str) -> str:
    """Water-filling among siblings; ``nodes`` has the parents, the column, supply and given."""
    by = f"PARTITION BY {parents}" if parents else ""
    order = f"{by} ORDER BY supply / weight, {column}"
    return f"""
        SELECT * EXCLUDE (water), least(supply, greatest(0, CAST(floor(weight * max(water) OVER ({by}) + 1e-6) AS BIGINT))) AS budget
        FROM (
            SELECT *, CAST(given - coalesce(sum(supply) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
                / CAST(sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS water
            FROM (SELECT *, {_weight_sql(column)} AS weight FROM ({nodes}))
        )"""


MIX_SQL = f"""
    WITH docs AS (
        SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            CASE WHEN regexp_extract(coalesce(source, ''), '(\\d{{1,9}})$', 1) = '' THEN 'other'
                ELSE 'group' || CAST(CAST(regexp_extract(source, '(\\d{{1,9}})$', 1) AS INT) // 5 AS VARCHAR) END AS domain,
            len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens
        FROM documents
    ),
    leaves AS (
        SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) * {MIX_EPOCHS} AS BIGINT) AS supply
        FROM docs GROUP BY ALL
    ),
    root AS (SELECT CAST(floor(sum(tokens) * CAST({MIX_SHARE} AS DOUBLE)) AS BIGINT) AS given FROM leaves),
    a AS ({_fill_sql("SELECT domain, CAST(sum(supply) AS BIGINT) AS supply, (SELECT given FROM root) AS given FROM leaves GROUP BY domain", "", "domain")}),
    b AS ({_fill_sql("SELECT l.*, a.budget AS given FROM (SELECT domain, lang, CAST(sum(supply) AS BIGINT) AS supply FROM leaves GROUP BY ALL) l JOIN a USING (domain)", "domain", "lang")}),
    c AS ({_fill_sql("SELECT l.*, b.budget AS given FROM leaves l JOIN b USING (domain, lang)", "domain, lang", "source")}),
    budgets AS (
        SELECT domain, lang, source, budget // greatest(tokens, 1) AS whole, budget % greatest(tokens, 1) AS rest FROM c
    ),
    ordered AS (
        SELECT docs.*, whole, rest, sum(n_tokens) OVER (
            PARTITION BY domain, lang, source
            ORDER BY md5('{MIX_SEED}:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), ''))
        ) AS running
        FROM docs JOIN budgets USING (domain, lang, source)
    )
    SELECT doc_id, domain, lang, source, n_tokens, CAST(whole + CASE WHEN running <= rest AND whole < {MIX_EPOCHS} THEN 1 ELSE 0 END AS BIGINT) AS copies
    FROM ordered
    """


@query("op3_hierarchical_mix", MIX_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_domain(table(spark, sf_dir, "documents"))
    mixed = mix(docs, LEVELS, WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return mixed.select(
        "doc_id", "domain", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        "n_tokens", "copies",
    )


@query("op11_language_id")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents"))


@query(
    "op12_fill_in_middle",
    r"""
    WITH units AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
            sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
        FROM documents
    ),
    hashed AS (
        SELECT *, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
            CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
        FROM units
    ),
    cut AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            CASE WHEN n = 0 OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 100 THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
        FROM hashed
    ),
    parts AS (
        SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a + 1:b], ''), '') AS m,
            coalesce(array_to_string(units[b + 1:n], ''), '') AS s
        FROM cut
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM parts
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digests(table(spark, sf_dir, "documents"))


@query(
    "op13_filter_audit",
    r"""
    WITH said AS (
        SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
            regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS words
        FROM documents
    ),
    failed AS (
        SELECT said.doc_id, part, concat(
            CASE WHEN len(words) < 100 THEN 'A' END, CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' END,
            CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' END,
            CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
            CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' END) AS fails
        FROM said
    ),
    marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
    kinds AS (
        SELECT part, fails, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
        FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, fails
    ),
    f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
    ),
    steps AS (
        SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before
        FROM orders, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step)
    ),
    placed AS (
        SELECT part, filter_order, step, x, n, good, toxic, contains(fails, x) AS hit,
            len(list_intersect(string_split(before, ''), string_split(fails, ''))) > 0 AND before <> '' AND fails <> '' AS gone, fails = x AS alone
        FROM kinds, steps
    ),
    counted AS (
        SELECT part, filter_order, step, x, coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS kept,
            coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (hit AND gone), 0) AS redundant,
            coalesce(sum(n) FILTER (alone), 0) AS unique_fails, coalesce(sum(good) FILTER (hit AND NOT gone), 0) AS good_lost,
            coalesce(sum(toxic) FILTER (hit AND NOT gone), 0) AS toxic_lost
        FROM placed GROUP BY ALL
    )
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
        CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
        CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
        CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
    FROM counted
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
