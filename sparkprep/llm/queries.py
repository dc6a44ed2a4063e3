"""Registered queries of the operators, with SQL where SQL can express the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkprep.llm import quality, rules
from sparkprep.llm.bpe import decode_ids, encode_documents
from sparkprep.llm.fingerprints import exact_groups
from sparkprep.llm.jaccard import similar_documents
from sparkprep.llm.language import held_out, identify, train
from sparkprep.llm.packing import pack_documents
from sparkprep.llm.periods import periodic_runs
from sparkprep.llm.repair import repair
from sparkprep.llm.substrings import remove_repeats
from sparkprep.llm.urls import Rule, judge_urls
from sparkprep.llm.vectors import near_duplicates
from sparkprep.llm.wordpieces import count_tokens
from sparkprep.plans.staging import stage, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_byte_bpe(spark: SparkSession, data_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode_documents(table(spark, data_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return decode_ids(encoded, ranks).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op2_exact_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    return exact_groups(table(spark, data_dir, "documents"))


ORACLE["op2_exact_dedup"] = """
WITH normal AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY t)
"""

@query
def op3_jaccard_join(spark: SparkSession, data_dir: str) -> DataFrame:
    return similar_documents(table(spark, data_dir, "documents"))


@query
def op4_substring_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    return remove_repeats(table(spark, data_dir, "documents")).drop("kept_text")


@query
def op5_token_counts(spark: SparkSession, data_dir: str) -> DataFrame:
    return count_tokens(table(spark, data_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_quality(spark: SparkSession, data_dir: str) -> DataFrame:
    measured = stage(quality.measure(table(spark, data_dir, "documents")), "statistics")
    model = quality.train(measured.filter(~held_out()), table(spark, data_dir, "labels"))
    scored = quality.score(measured, model)
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


@query
def op7_language_id(spark: SparkSession, data_dir: str) -> DataFrame:
    documents = table(spark, data_dir, "documents")
    found = identify(documents, train(documents.filter(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op8_packing(spark: SparkSession, data_dir: str) -> DataFrame:
    return pack_documents(table(spark, data_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op9_embedding_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    return near_duplicates(table(spark, data_dir, "embeddings"))


# The rules that the query applies.
URL_RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


@query
def op10_url_filters(spark: SparkSession, data_dir: str) -> DataFrame:
    return judge_urls(table(spark, data_dir, "pages"), URL_RULES)


ORACLE["op10_url_filters"] = """
WITH rests AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS authority FROM rests
), named AS (
    SELECT page_id,
           translate(authority, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(authority) + 1), '^[^?#]*') AS path
    FROM parts
), ruled AS (
    SELECT *, CASE
        WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/'
    END AS rule FROM named
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


WORD = "[^\\x20\\x09-\\x0D]+"


def plant_runs(documents: DataFrame) -> DataFrame:
    """``doc_id, text``: in a tenth of the documents, chosen by a checksum of the id, a stretch of words recurs to the end."""
    drawn = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = documents.select("doc_id", "text", drawn.alias("h"), F.floor(drawn / 10).cast("long").alias("g"))
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    n = F.size("w").cast("long")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    planted = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, w[int(a + (i - a) % p)])), ' ')")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, data_dir: str) -> DataFrame:
    found = periodic_runs(plant_runs(table(spark, data_dir, "documents")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-1000 * best.less div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_quality_rules(spark: SparkSession, data_dir: str) -> DataFrame:
    documents = table(spark, data_dir, "documents")
    judged = rules.judge(documents, rules.learn_references(documents))
    return judged.select("doc_id", *rules.COUNTS, "base_failed", "kept")


# The first byte of a character says its class; here are the characters of each class in order.
_CLASS_CHARACTERS = [
    "a-z", "A-Z", "0-9", "\\x20", "\\x09-\\x0D", ".,;:!?'\"", "()+\\-/=@\\[\\\\\\]^_`{}~", rules.SYMBOLS, "\\x00-\\x08\\x0E-\\x1F\\x7F",
    "\\x{80}-\\x{2BF}", "\\x{2C0}-\\x{7FF}", "\\x{800}-\\x{FFFF}", "\\x{10000}-\\x{10FFFF}",
]


def _rules_sql() -> str:
    counts = ", ".join("length(regexp_replace(t, '[^{}]', '', 'g'))".format(c.replace("'", "''")) for c in _CLASS_CHARACTERS)
    term = "CASE WHEN {x} > 0 THEN {x} * log2({x} * 2 / (p + s)) ELSE 0 END"
    side = f"(sum({term.format(x='p')}) + sum({term.format(x='s')})) / 2"
    distance = f"sqrt(greatest({side} - (count_if(s > 0) - 1) / (8 * ln(2) * any_value(total)), 0))"
    return f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t, text IS NOT NULL AND lang IS NOT NULL AS teaches,
           strpos('0123456789abcdef', substr(md5(coalesce(text, '')), 1, 1)) AS part
    FROM documents
), split AS MATERIALIZED (
    SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, [{counts}] AS chars FROM docs
), each_word AS MATERIALIZED (
    SELECT r, lang, part, teaches, i, w[i] AS word, w[i + 1] AS second, w[i + 2] AS third FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM split)
), plain AS MATERIALIZED (
    SELECT r, lang, part, teaches, CASE WHEN strlen(word) <= {rules.WORD_BYTES} AND regexp_full_match(core, '\\p{{L}}+') THEN core END AS name
    FROM (SELECT *, lower(regexp_replace(regexp_replace(word, '^[!-/:-@\\[-`{{-~]+', ''), '[!-/:-@\\[-`{{-~]+$', '')) AS core FROM each_word)
), sizes AS (SELECT lang, part, sum(len(w)) AS n, teaches FROM split GROUP BY ALL
), totals AS (
    SELECT lang FROM sizes WHERE teaches GROUP BY lang
    HAVING sum(n) >= {rules.LEAST_REFERENCE} AND sum(n) * {rules.LANGUAGES} >= (SELECT sum(n) FROM sizes WHERE teaches)
), parts AS (SELECT lang, part, n FROM sizes JOIN totals USING (lang) WHERE teaches AND n > 0
), word_parts AS (SELECT lang, part, name, count(*) AS c FROM plain WHERE teaches AND name IS NOT NULL GROUP BY ALL
), word_shares AS (
    SELECT lang, name, median(coalesce(c, 0) / n) AS s
    FROM (SELECT DISTINCT lang, name FROM word_parts) JOIN parts USING (lang) LEFT JOIN word_parts USING (lang, part, name) GROUP BY ALL
), common_words AS (
    SELECT lang, name, s FROM word_shares WHERE s >= {rules.LEAST_SHARE}
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY s DESC, name) <= {rules.COMMON}
), word_reference AS (
    SELECT lang, name, s / sum(s) OVER (PARTITION BY lang) AS s FROM (
        SELECT * FROM common_words UNION ALL
        SELECT lang, '', greatest(0, 1 - coalesce(sum(s), 0)) FROM totals LEFT JOIN common_words USING (lang) GROUP BY lang
    )
), each_class AS MATERIALIZED (
    SELECT r, lang, part, teaches, unnest(chars) AS c, unnest(range(1, {rules.CLASSES + 1})) AS k FROM split
), class_parts AS (
    SELECT lang, part, k, sum(c) AS c, sum(sum(c)) OVER (PARTITION BY lang, part) AS n FROM each_class JOIN totals USING (lang) WHERE teaches GROUP BY lang, part, k
), class_shares AS (SELECT lang, k, median(c / n) AS s FROM class_parts WHERE n > 0 GROUP BY ALL
), class_reference AS (SELECT lang, k, s / sum(s) OVER (PARTITION BY lang) AS s FROM class_shares
), pairs AS MATERIALIZED (
    SELECT r, totals.lang, len(w) AS total, list_sum(chars) AS n_chars FROM split JOIN totals ON coalesce(split.lang, totals.lang) = totals.lang
), doc_words AS (
    SELECT pairs.r, pairs.lang, coalesce(common_words.name, '') AS name, count(*) AS c
    FROM pairs JOIN plain ON plain.r = pairs.r LEFT JOIN common_words ON common_words.lang = pairs.lang AND common_words.name = plain.name GROUP BY ALL
), word_distance AS (
    SELECT r, lang, {distance} AS d FROM (
        SELECT pairs.r, pairs.lang, coalesce(c, 0) / total AS p, s, total
        FROM pairs JOIN word_reference USING (lang) LEFT JOIN doc_words ON doc_words.r = pairs.r AND doc_words.lang = pairs.lang AND doc_words.name = word_reference.name
        WHERE total > 0
    ) GROUP BY r, lang
), class_distance AS (
    SELECT r, lang, {distance} AS d FROM (
        SELECT pairs.r, pairs.lang, c / n_chars AS p, s, n_chars AS total
        FROM pairs JOIN class_reference USING (lang) JOIN each_class ON each_class.r = pairs.r AND each_class.k = class_reference.k WHERE n_chars > 0
    ) GROUP BY r, lang
), far AS (
    SELECT r, total >= 50 AND w.d > 0.35 OR n_chars >= 200 AND c.d > 0.25 AS far
    FROM pairs LEFT JOIN word_distance w USING (r, lang) LEFT JOIN class_distance c USING (r, lang)
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY w.d, lang) = 1
), lines AS (
    SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM split)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r
), repeated AS (
    SELECT r, count(DISTINCT i + k) AS n FROM (
        SELECT r, i, count(*) OVER (PARTITION BY r, word, second, third) AS times FROM each_word WHERE third IS NOT NULL
    ), (SELECT unnest([0, 1, 2]) AS k) WHERE times > 1 GROUP BY r
), counted AS (
    SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(chars[8] AS BIGINT) AS n_symbols, CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words
    FROM split LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r)
), based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(far, false) AS kept
FROM based LEFT JOIN far USING (r)
"""


ORACLE["op12_quality_rules"] = _rules_sql()


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of which a checksum of conversation and turn drops, empties, cuts, repeats or renames some.

    ``present`` is false for a dropped row. Nulls read as one space.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    rows = conversations.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") != 0).alias("present"), times.alias("copy")).drop("copy")


@query
def op13_conversation_repair(spark: SparkSession, data_dir: str) -> DataFrame:
    found = repair(damage(table(spark, data_dir, "conversations")), present=F.col("present"))
    return found.drop("repaired")


def _crc_table() -> list[int]:
    """The 256 steps of the CRC-32 that is computed from the low bit."""
    table = list(range(256))
    for _ in range(8):
        table = [(c >> 1) ^ (0xEDB88320 if c & 1 else 0) for c in table]
    return table


def _repair_sql() -> str:
    def least(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def edit(way: str, cost: str, letter: str) -> str:
        return f"CASE WHEN {way} IS NOT NULL THEN {{'c': ({way}).c + {cost}, 'a': ({way}).a || '{letter}'}} END"

    insert = lambda way: edit(way, "2", "I")
    only = lambda when, way: f"CASE WHEN {when} THEN {way} END"
    to_user = [only("NOT gone AND kind = 'u'", edit(f"x{i}", "cut", "K")) for i in (0, 1, 3)]
    to_user += [only("NOT gone AND kind <> 'u'", edit(f"x{i}", "(2 + cut)", "R")) for i in (0, 1, 3)]
    to_assistant = [only("NOT gone AND kind = 'a'", edit("x2", "cut", "K")), only("NOT gone AND kind <> 'a'", edit("x2", "(2 + cut)", "R"))]
    stay = [edit(f"x{i}", "3", "D") for i in range(4)]
    ends = ["v0", "v3", insert("v2"), insert(f"({insert('v1')})")]
    way = "STRUCT(c INTEGER, a VARCHAR)"
    return f"""
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations
), checksum(k, i, c) AS (
    SELECT DISTINCT k, 1, CAST(4294967295 AS BIGINT) FROM named
    UNION ALL
    SELECT k, i + 1, xor(c >> 8, ({_crc_table()})[(xor(c, CAST(ascii(substr(k, i, 1)) AS BIGINT)) & 255) + 1]) FROM checksum WHERE i <= length(k)
), faults AS (SELECT k, xor(c, 4294967295) % 20 AS fault FROM checksum WHERE i = length(k) + 1
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM named JOIN faults USING (k), (SELECT unnest([0, 1]) AS copy) WHERE fault <> 0 AND (copy = 0 OR fault = 3)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged
), judged AS (
    SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
           CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE 'x' END AS kind,
           NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS open
    FROM placed
), marked AS (
    SELECT conv_id, i, role, text, turn, kind, blank, again AND NOT blank AS copied, blank OR again AS gone, CAST(open AND NOT blank AND NOT again AS INTEGER) AS cut,
           i > 1 AND lag(kind) OVER (PARTITION BY conv_id ORDER BY i) || kind NOT IN ('su', 'ua', 'au') AS wrong
    FROM judged
), paths(conv_id, i, v0, v1, v2, v3) AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT), CAST({{'c': 0, 'a': ''}} AS {way}), CAST(NULL AS {way}), CAST(NULL AS {way}), CAST(NULL AS {way}) FROM conversations
    UNION ALL
    SELECT conv_id, i, {least(stay[0])}, {least(stay[1], only("NOT gone AND kind = 's'", edit('x0', 'cut', 'K')))},
           {least(stay[2], *to_user)}, {least(stay[3], *to_assistant)}
    FROM (
        SELECT paths.* EXCLUDE (i, v2, v3), marked.i, v0 AS x0, v1 AS x1, {least('w2', insert('w3'))} AS x2, {least('w3', insert('w2'))} AS x3, kind, gone, cut
        FROM (SELECT *, {least('v2', insert('v0'), insert('v1'), insert('v3'))} AS w2, {least('v3', insert('v2'))} AS w3 FROM paths) AS paths
        JOIN marked ON marked.conv_id IS NOT DISTINCT FROM paths.conv_id AND marked.i = paths.i + 1
    )
), best AS (
    SELECT conv_id, {least(*ends)} AS way FROM paths QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), letters AS (
    SELECT conv_id, p, substr((way).a, CAST(p AS INTEGER), 1) AS letter FROM (SELECT *, unnest(range(1, length((way).a) + 1)) AS p FROM best)
), steps AS (
    SELECT conv_id, p, letter, count_if(letter <> 'I') OVER earlier AS i, count_if(letter <> 'D') OVER earlier AS o
    FROM letters WINDOW earlier AS (PARTITION BY conv_id ORDER BY p)
), output AS (
    SELECT steps.*, role, text, max(CASE WHEN o = 1 AND letter = 'K' AND kind = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY steps.conv_id) AS system
    FROM steps LEFT JOIN marked ON marked.conv_id IS NOT DISTINCT FROM steps.conv_id AND marked.i = steps.i WHERE letter <> 'D'
), repaired AS (
    SELECT conv_id, string_agg(
        CASE WHEN letter = 'K' THEN role WHEN (o - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY p
    ) AS t
    FROM output GROUP BY conv_id
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(copied) AS duplicate, count_if(cut = 1) AS truncated,
           count_if(wrong) AS illegal
    FROM marked GROUP BY conv_id
)
SELECT best.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST((way).c AS BIGINT) AS cost, (way).a AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM best LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM best.conv_id LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM best.conv_id
"""


ORACLE["op13_conversation_repair"] = _repair_sql()
