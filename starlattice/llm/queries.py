"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlattice.llm import (
    chat,
    decontaminate,
    language_id,
    license_scan,
    mixing,
    prefix_trie,
    quality_rules,
    secret_scan,
    set_join,
    sharding,
    structure_repair,
    token_counts,
    url_filter,
)
from starlattice.llm.common import new_folder, table
from starlattice.llm.turns import joined_sha256

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def register(run):
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return run

    return register


# A matching rule's url host or a subdomain of it, and the start of its path.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

SHARDS = 16


@query("op1_sharding")
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of equal row counts; the digest is taken from the dealt texts."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    dealt = sharding.shuffle_into_shards(docs, SHARDS)
    return dealt.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    "op5_url_filter",
    """
    WITH rules(rule_host, rule_path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
        ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
    cut AS (SELECT row_number() OVER () AS id, page_id,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parsed AS (SELECT id, page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    fitting AS (SELECT p.*, rule_host || rule_path AS rule, verdict, row_number() OVER (PARTITION BY id
            ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS place
        FROM parsed p LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
            AND starts_with(path, rule_path))
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting WHERE place = 1
    """,
)
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, folder, "pages").select("page_id", "url"), rules)


@query(
    "op9_mixing",
    r"""
    WITH sized AS (SELECT doc_id, source, row_number() OVER () AS id,
            coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
            md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS turn FROM documents),
    sources AS (SELECT source, sum(size)::BIGINT AS source_size,
            CASE (row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
        FROM sized GROUP BY source),
    total AS (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS budget FROM sources),
    filled AS (SELECT *, coalesce(sum(2 * source_size) OVER before, 0) AS capped,
            sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight FROM sources
        WINDOW before AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    level AS (SELECT max((budget - capped::DOUBLE) / open_weight::DOUBLE) AS share FROM filled, total),
    targets AS (SELECT source, source_size, weight, least(2.0::DOUBLE * source_size, weight * share) AS target FROM sources, level),
    ended AS (SELECT s.*, t.source_size, t.weight, t.target,
            sum(size) OVER (PARTITION BY s.source ORDER BY turn, id ROWS UNBOUNDED PRECEDING) AS ends
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
    copies AS (SELECT *, (ends + epoch * source_size)::DOUBLE / weight AS finish FROM ended, (VALUES (0), (1)) AS e(epoch)),
    paid AS (SELECT *, sum(size) OVER (ORDER BY finish, turn, epoch ROWS UNBOUNDED PRECEDING) AS running FROM copies)
    SELECT doc_id, size, any_value(source_size) AS source_size, any_value(target) AS target,
        coalesce(sum(size) FILTER (WHERE running <= budget), 0)::BIGINT AS taken
    FROM paid, total GROUP BY id, doc_id, size
    """,
)
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    whole, _ = mixing.mix(docs, keep=["doc_id"])
    return whole.select(
        "doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs")).cast("long").alias("taken")
    )


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every run starts a cache of its own, so that its work does not depend on earlier runs."""
    vocabulary = token_counts.Tokenizer(
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        (("<|endoftext|>", 50256),),
    )
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counts = token_counts.count_tokens(docs, vocabulary, new_folder(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


# The mark of another common template, with a backslash before it and an end mark inside.
MARKED = "\\### Assistant: </turn> ok"


@query(
    "op2_chat_formatting",
    r"""
    WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
            (-7, 1, 'assistant', '\### Assistant: </turn> ok'))),
    escaped AS (SELECT *, replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## ') AS safe,
            replace(replace(replace(replace(role, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## '), ':', '\:') AS safe_role
        FROM turns),
    ended AS (SELECT *, sum(length('### ' || safe_role || ': ' || safe || '</turn>') + 1) OVER prefix AS chars,
            row_number() OVER prefix = count(*) OVER (PARTITION BY conv_id) AS is_last
        FROM escaped WINDOW prefix AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
    SELECT conv_id, count(*)::BIGINT AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
        sum(chars) FILTER (WHERE role = 'assistant' OR is_last)::BIGINT AS formatted_chars
    FROM ended GROUP BY conv_id
    """,
)
def op2_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)], turns.schema)
    back = chat.read_back(chat.expand(turns.unionByName(marked)))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(F.array_join("replies", "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join("replies", ""), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query("op10_language_id")
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language_id.train(language_id.sample(docs))
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(language_id.held_out(), F.lit(False)).alias("held_out"),
        "language.lang_pred",
        "language.score",
        "language.rejected",
    )


@query("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    base = [r.kind for r in secret_scan.BASE_RULES]
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ","
    )
    return found.select(
        "doc_id",
        *[
            (F.size("spans") - F.size(F.array_remove(F.col("spans.kind"), k))).cast("long").alias(f"n_{k}") for k in base
        ],
        F.sha2(written(F.filter("spans", lambda s: s.kind.isin(base))), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


@query(
    "op6_quality_rules",
    r"""
    WITH rows AS (SELECT row_number() OVER () AS id, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
    worded AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
            list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines FROM rows),
    windows AS (SELECT id, unnest(range(len(words) - 2)) AS place, unnest(list_transform(range(len(words) - 2),
            lambda i: words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3])) AS three FROM worded WHERE len(words) >= 3),
    repeated AS (SELECT id, place FROM windows QUALIFY count(*) OVER (PARTITION BY id, three) > 1),
    covered AS (SELECT id, count(DISTINCT place + step)::BIGINT AS n_repeat_words
        FROM repeated, (VALUES (0), (1), (2)) AS s(step) GROUP BY id),
    measured AS (SELECT id, doc_id, lang, source, len(words)::BIGINT AS n_words,
            length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
            len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines) AS n_lines,
            (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
        FROM worded LEFT JOIN covered USING (id)),
    shares AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            n_symbols::DOUBLE / greatest(n_words, 1) AS a, n_dup_lines::DOUBLE / greatest(n_lines, 1) AS b,
            n_repeat_words::DOUBLE / greatest(n_words, 1) AS c, word_chars::DOUBLE / greatest(n_words, 1) AS d FROM measured),
    good AS (SELECT * FROM shares WHERE NOT base_failed),
    levels AS (
        SELECT 1 AS level, lang, source, count(*) AS n, quantile_disc(a, [0.25, 0.75, 0.99]) AS qa, quantile_disc(b, [0.25, 0.75, 0.99]) AS qb,
            quantile_disc(c, [0.25, 0.75, 0.99]) AS qc, quantile_disc(d, [0.25, 0.75, 0.99]) AS qd FROM good GROUP BY lang, source
        UNION ALL SELECT 2, lang, NULL, count(*), quantile_disc(a, [0.25, 0.75, 0.99]), quantile_disc(b, [0.25, 0.75, 0.99]),
            quantile_disc(c, [0.25, 0.75, 0.99]), quantile_disc(d, [0.25, 0.75, 0.99]) FROM good GROUP BY lang
        UNION ALL SELECT 3, NULL, NULL, count(*), quantile_disc(a, [0.25, 0.75, 0.99]), quantile_disc(b, [0.25, 0.75, 0.99]),
            quantile_disc(c, [0.25, 0.75, 0.99]), quantile_disc(d, [0.25, 0.75, 0.99]) FROM good),
    chosen AS (SELECT s.*, l.* EXCLUDE (lang, source), row_number() OVER (PARTITION BY s.id ORDER BY level) AS place
        FROM shares s LEFT JOIN levels l ON (level = 3) OR (n >= 100 AND s.lang IS NOT DISTINCT FROM l.lang
            AND (level = 2 OR s.source IS NOT DISTINCT FROM l.source)))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND coalesce(a <= greatest(CASE WHEN qa[2] > qa[1] THEN qa[2] + 3 * (qa[2] - qa[1]) ELSE qa[3] END, 0.01)
            AND b <= greatest(CASE WHEN qb[2] > qb[1] THEN qb[2] + 3 * (qb[2] - qb[1]) ELSE qb[3] END, 0.05)
            AND c <= greatest(CASE WHEN qc[2] > qc[1] THEN qc[2] + 3 * (qc[2] - qc[1]) ELSE qc[3] END, 0.05)
            AND d <= CASE WHEN qd[2] > qd[1] THEN qd[2] + 3 * (qd[2] - qd[1]) ELSE qd[3] END
            AND d >= qd[1] - 3 * (qd[2] - qd[1]), true) AS kept
    FROM chosen WHERE place = 1
    """,
)
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query(
    "op3_decontamination",
    r"""
    WITH lowered AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
    items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
    starts AS (SELECT item_id, words, unnest(range(greatest(len(words) - 12, 1))) AS place FROM items WHERE len(words) > 0),
    windows AS (SELECT DISTINCT item_id, array_to_string(words[place + 1:place + 13], ' ') AS part,
            least(len(words), 13) AS n FROM starts),
    lengths AS (SELECT DISTINCT n FROM windows),
    places AS (SELECT id, words, unnest(range(len(words))) AS place FROM lowered),
    parts AS (SELECT id, place, n, array_to_string(words[place + 1:place + n], ' ') AS part
        FROM places, lengths WHERE place + n <= len(words)),
    hits AS (SELECT id, place, n, item_id FROM parts JOIN windows USING (part, n)),
    covered AS (SELECT id, count(DISTINCT word)::BIGINT AS n_hit
        FROM (SELECT id, unnest(range(place, place + n)) AS word FROM (SELECT DISTINCT id, place, n FROM hits)) GROUP BY id),
    found AS (SELECT id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT id, item_id::VARCHAR AS item FROM hits) GROUP BY id)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
    FROM lowered LEFT JOIN covered USING (id) LEFT JOIN found USING (id)
    """,
)
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, folder, "documents").select("doc_id", "text"),
        table(spark, folder, "benchmark").select("item_id", "text"),
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


@query("op7_set_join")
def op7_set_join(spark: SparkSession, folder: str) -> DataFrame:
    found = set_join.near_copies(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "class_id", "n_links", "n_derived")


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with planted faults, by a checksum of conversation and turn; nulls are one space."""
    blank = F.lit(" ")
    number = lambda c: F.coalesce(F.col(c).cast("string"), blank)
    written = F.concat(number("conv_id"), F.lit(":"), number("turn"))
    fault = F.crc32(F.encode(written, "UTF-8")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    return (
        turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault"))
        .where("fault != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("fault") == 1, F.lit(""))
            .when(F.col("fault") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("said"),
        )
        .drop("said")
    )


REPAIR_SQL = r"""
    WITH RECURSIVE source AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS written FROM conversations),
    bits(n, value) AS (SELECT n, n::UBIGINT FROM range(256) r(n)),
    table_steps(n, step, value) AS (SELECT n, 0, n::BIGINT FROM range(256) r(n) UNION ALL
        SELECT n, step + 1, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END FROM table_steps WHERE step < 8),
    crc_table AS (SELECT list(value ORDER BY n) AS entries FROM table_steps WHERE step = 8),
    keys AS (SELECT DISTINCT written FROM source),
    crcs(written, step, value) AS (SELECT written, 0, 4294967295::BIGINT FROM keys UNION ALL
        SELECT written, step + 1, xor(value >> 8, entries[(xor(value, ascii(written[step + 1])::BIGINT) & 255) + 1])
        FROM crcs, crc_table WHERE step < length(written)),
    faults AS (SELECT written, xor(value, 4294967295) % 20 AS fault FROM crcs WHERE step = length(written)),
    damaged AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
            CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
        FROM source JOIN faults USING (written), range(2) c(copy) WHERE fault <> 0 AND (copy = 0 OR fault = 3)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM damaged),
    trimmed AS (SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS kept,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) AS said, role[1] AS initial,
            lag(role[1]) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM placed),
    marked AS (SELECT *, CASE WHEN kept = '' THEN 'blank' WHEN said > 1 THEN 'duplicate'
            WHEN kept[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault FROM trimmed),
    states(state, wanted, next) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
    -- Up to two inserted lines before a row: where they lead and what they write.
    inserts AS (SELECT state, state AS reached, '' AS steps, '' AS written FROM states
        UNION ALL SELECT state, next, 'I', wanted || ':' || chr(10) FROM states
        UNION ALL SELECT a.state, b.next, 'II', a.wanted || ':' || chr(10) || b.wanted || ':' || chr(10) FROM states a JOIN states b ON a.next = b.state),
    ways(conv_id, place, state, best) AS (
        SELECT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': '', 'written': ''} FROM (SELECT DISTINCT conv_id FROM marked)
        UNION ALL
        SELECT conv_id, place, state, min(best) FROM (
            SELECT m.conv_id, m.place, e.target AS state, {'cost': w.best.cost + 5 * length(i.steps) + e.price,
                'audit': w.best.audit || i.steps || e.edit, 'written': w.best.written || i.written || e.line} AS best
            FROM ways w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.place = w.place + 1
            JOIN inserts i ON i.state = w.state JOIN states s ON s.state = i.reached,
            LATERAL (SELECT 'D' AS edit, i.reached AS target, 2 AS price, '' AS line
                UNION ALL SELECT 'R', s.next, 1 + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, s.wanted || ':' || text || chr(10)
                    WHERE fault NOT IN ('blank', 'duplicate')
                UNION ALL SELECT 'K', CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END,
                    CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, role || ':' || text || chr(10)
                    WHERE fault NOT IN ('blank', 'duplicate') AND ((initial = 's' AND i.reached = 0)
                        OR (initial = 'u' AND i.reached <> 2) OR (initial = 'a' AND i.reached = 2))) e)
        GROUP BY conv_id, place, state),
    ended AS (SELECT w.conv_id, min({'cost': w.best.cost + 5 * length(i.steps), 'audit': w.best.audit || i.steps,
            'written': w.best.written || i.written}) AS best
        FROM ways w JOIN (SELECT conv_id, max(place) AS place FROM marked GROUP BY conv_id) l
            ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.place = w.place
        JOIN inserts i ON i.state = w.state WHERE i.reached IN (0, 3) GROUP BY w.conv_id),
    counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
            count(*) FILTER (WHERE fault = 'blank')::BIGINT AS blank, count(*) FILTER (WHERE fault = 'duplicate')::BIGINT AS duplicate,
            count(*) FILTER (WHERE fault = 'truncated')::BIGINT AS truncated,
            count(*) FILTER (WHERE place > 1 AND before || initial NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal FROM marked GROUP BY conv_id)
    SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
        coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
        coalesce(best.audit, '') AS audit, sha256(coalesce(left(best.written, length(best.written) - 1), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""


@query("op11_structure_repair", REPAIR_SQL)
def op11_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, damaged by a checksum and repaired; the digest is taken from the repaired rows."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return repaired_digests(turns)


def repaired_digests(turns: DataFrame) -> DataFrame:
    found = structure_repair.repair(damaged(turns))
    lines = found.rows.select("conv_id", "place", "step", F.concat("role", F.lit(":"), "text").alias("part"))
    digests = joined_sha256(lines, "conv_id", ["place", "step"], "\n").withColumnRenamed("conv_id", "digest_of")
    report = found.report.withColumnRenamed("conv_id", "report_of")
    # Conversations that lost every row to the damage have a row too.
    whole = (
        turns.select("conv_id").distinct()
        .join(report, F.col("conv_id").eqNullSafe(F.col("report_of")), "left")
        .join(digests, F.col("conv_id").eqNullSafe(F.col("digest_of")), "left")
    )
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return whole.select(
        "conv_id",
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


TRIE_SQL = r"""
    WITH RECURSIVE turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM conversations WHERE conv_id IS NOT NULL),
    table_steps(n, step, value) AS (SELECT n, 0, n::BIGINT FROM range(256) r(n) UNION ALL
        SELECT n, step + 1, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END FROM table_steps WHERE step < 8),
    crc_table AS (SELECT list(value ORDER BY n) AS entries FROM table_steps WHERE step = 8),
    crcs(conv_id, step, value) AS (SELECT DISTINCT conv_id, 0, 4294967295::BIGINT FROM turns UNION ALL
        SELECT conv_id, step + 1, xor(value >> 8, entries[(xor(value, ascii((conv_id::VARCHAR)[step + 1])::BIGINT) & 255) + 1])
        FROM crcs, crc_table WHERE step < length(conv_id::VARCHAR)),
    shares AS (SELECT conv_id, xor(value, 4294967295) % 6 AS h FROM crcs WHERE step = length(conv_id::VARCHAR)),
    parts AS (SELECT s.conv_id, 0 AS own, t.pos, t.role, t.text FROM shares s JOIN turns t ON t.conv_id = s.conv_id - s.conv_id % 100 AND t.pos <= s.h
        UNION ALL SELECT s.conv_id, 1, t.pos, t.role, t.text FROM shares s JOIN turns t ON t.conv_id = s.conv_id AND t.pos > s.h),
    rebuilt AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth, role, text FROM parts),
    paths AS (SELECT conv_id, depth, length(text) AS chars,
            string_agg(sha256(role || chr(10) || sha256(text)), '' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rebuilt
        UNION ALL SELECT conv_id, 0, 0, '' FROM shares),
    lengths AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
    nodes AS (SELECT path, any_value(p.depth) AS depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
            sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (WHERE p.depth = l.depth), '')) AS ends_sha256
        FROM paths p JOIN lengths l USING (conv_id) GROUP BY path),
    parented AS (SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE left(c.path, length(c.path) - 64) = n.path
            AND c.depth = n.depth + 1) AS n_children FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = left(n.path, length(n.path) - 64)),
    below AS (SELECT left(n.path, 64 * up) AS path, n_children = 0 AS leaf, (n_convs - 1) * chars AS saved
        FROM parented n, LATERAL (SELECT unnest(range(n.depth + 1)) AS up) u)
    SELECT n.conv_id, n.depth::BIGINT AS depth, n.parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
        count(*) FILTER (WHERE leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens, any_value(n.ends_sha256) AS ends_sha256
    FROM parented n JOIN below b ON b.path = n.path GROUP BY n.path, n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children
"""


@query("op12_prefix_trie", TRIE_SQL)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of all conversations, each begun with turns of the first of its hundred."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    lines = prefix_trie.conversation_lines(turns)
    shared = F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % 6
    trie = prefix_trie.prefix_trie(prefix_trie.rebuild(lines, F.col("conv_id") - F.col("conv_id") % 100, shared))
    return trie.nodes.join(prefix_trie.ends_sha256(trie.ends), "node", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


@query("op13_license_scan")
def op13_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = license_scan.find_licenses(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("detections", lambda d: d.base)
    written = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d.label))), ",")
    starts = F.transform(base, lambda d: d.start)
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        written(base).alias("base_labels"),
        written(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d.weight)), F.lit(0.0)).alias("score"),
        F.size("detections").cast("long").alias("n_detections"),
    )
