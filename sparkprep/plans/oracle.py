"""The same results in plain SQL, for checking the registered queries.

Written against the data model and not against the Spark code: recursion for the
chunker, windows for ranks and splits, joins where Spark works inside a row.
"""

from __future__ import annotations

from sparkprep.functions.text import (
    INSTRUCTION_TEMPLATES,
    LEADING_STOPWORDS,
    QUESTION_TEMPLATES,
    WHITESPACE,
    WHITESPACE_RUN,
)


def _list(items) -> str:
    return "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in items) + "]"


def _strip(text: str) -> str:
    return f"trim({text}, '{WHITESPACE}')"


def _words(text: str) -> str:
    parts = f"regexp_split_to_array({_strip(text)}, '{WHITESPACE_RUN}')"
    return f"list_filter({parts}, lambda w: w <> '')"


def _pick(key: str, n: int) -> str:
    return f"(('0x' || substr({key}, 25, 8))::BIGINT % {n})"


def _round(value: str) -> str:
    return f"round({value}, 6)"


def _stats(value: str, where: str = "true") -> str:
    f = f"FILTER (WHERE {where})"
    return f"""
        count({value}) {f} AS count, coalesce(min({value}) {f}, 0)::INTEGER AS min,
        coalesce(max({value}) {f}, 0)::INTEGER AS max,
        round(coalesce(avg({value}) {f}, 0), 6) AS mean,
        round(coalesce(median({value}) {f}, 0)::DOUBLE, 6) AS median,
        round(coalesce(stddev_samp({value}) {f}, 0), 6) AS std"""


NL = "chr(10)"
SHORT = r"'^[^\n]{1,60}$'"
START, END = "TIMESTAMP '2024-01-05 00:00:00'", "TIMESTAMP '2024-01-20 00:00:00'"


def _ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


# Common table expressions, each after those it reads.

def _told(rows: str, name: str) -> str:
    """``name``: the chunks of ``rows`` with the texts that templates make of them."""
    return f"""
{name}_sentences AS (
  SELECT *, {_strip("string_split(chunk, '.')[1]")} AS sentence FROM {rows}),
{name}_words AS (
  SELECT *, {_words('sentence')} AS ws, ({_words('chunk')})[:10] AS first_words FROM {name}_sentences),
{name}_texts AS (
  SELECT * EXCLUDE (ws, first_words),
    CASE WHEN list_contains({_list(LEADING_STOPWORDS)}, lower(ws[1]))
      THEN array_to_string(ws[2:], ' ') ELSE sentence END AS subject,
    array_to_string(first_words, ' ') AS keywords
  FROM {name}_words),
{name} AS (
  SELECT *,
    replace({_list(QUESTION_TEMPLATES)}[{_pick('k', 5)} + 1], '{{}}', subject) AS question,
    replace({_list(INSTRUCTION_TEMPLATES)}[{_pick('k', 5)} + 1], '{{}}', keywords) AS instruction
  FROM {name}_texts)"""


_PREPARE = f"""
paragraph_lists AS (
  SELECT doc_id, list_filter(string_split(text, {NL}), lambda p: {_strip('p')} <> '') AS ps FROM documents),
paragraphs AS MATERIALIZED (
  SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM paragraph_lists),
last_paragraphs AS MATERIALIZED (SELECT doc_id, max(i) AS n FROM paragraphs GROUP BY doc_id),
fold AS (
  SELECT doc_id, 0::BIGINT AS i, '' AS cur, NULL::VARCHAR AS done FROM last_paragraphs
  UNION ALL
  SELECT doc_id, i,
    CASE WHEN full_up THEN right(cur, 200) || {NL} || {NL} ELSE cur END || p || {NL} || {NL},
    CASE WHEN full_up THEN {_strip('cur')} END
  FROM (SELECT fold.doc_id, paragraphs.i, cur, p, length(cur) + length(p) > 1000 AND length(cur) >= 100 AS full_up
        FROM fold JOIN paragraphs ON paragraphs.doc_id = fold.doc_id AND paragraphs.i = fold.i + 1)),
folded AS MATERIALIZED (SELECT * FROM fold),
closed AS MATERIALIZED (
  SELECT doc_id, i AS pos, done AS chunk FROM folded WHERE done IS NOT NULL
  UNION ALL
  SELECT doc_id, n + 1, {_strip('cur')} FROM folded JOIN last_paragraphs USING (doc_id) WHERE i = n AND length(cur) >= 100),
chunks AS MATERIALIZED (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos)::INTEGER AS chunk_index, chunk
  FROM closed),
keyed AS MATERIALIZED (
  SELECT *, md5(concat_ws('#', doc_id, chunk_index, '0')) AS k FROM chunks),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k)::INTEGER AS sample_rank,
    count(*) OVER (PARTITION BY doc_id) AS n FROM keyed),
sampled AS MATERIALIZED (
  SELECT doc_id, chunk_index, chunk, k, sample_rank,
    CASE WHEN sample_rank <= floor(least(n, 10)::DOUBLE * 0.5::DOUBLE)
      THEN 'qa' ELSE 'instruction' END AS kind
  FROM ranked WHERE sample_rank <= 10),
{_told('keyed', 'told')},
{_told('sampled', 'sampled_told')},
subjects AS (SELECT * FROM sampled_told),
examples AS MATERIALIZED (
  SELECT doc_id, chunk_index, kind, CASE kind WHEN 'qa' THEN question ELSE instruction END AS input_text, chunk AS output_text
  FROM sampled_told),
valid AS (
  SELECT doc_id, chunk_index, kind, input_text, output_text FROM examples
  WHERE length(input_text) BETWEEN 10 AND 1024 AND length(output_text) BETWEEN 20 AND 2048),
splits AS (
  SELECT doc_id, chunk_index, kind, input_text, output_text,
    CASE WHEN r <= floor(n::DOUBLE * 0.8::DOUBLE) THEN 'train'
      WHEN r <= floor(n::DOUBLE * 0.8::DOUBLE) + floor(n::DOUBLE * 0.1::DOUBLE) THEN 'val'
      ELSE 'test' END AS split
  FROM (SELECT *, count(*) OVER () AS n,
      row_number() OVER (ORDER BY md5(concat_ws('#', doc_id, chunk_index, 'split', '0'))) AS r
    FROM valid)),
lengths AS (
  SELECT split, 'input_length' AS field, length(input_text) AS len FROM splits
  UNION ALL SELECT split, 'output_length', length(output_text) FROM splits),
stats AS (
  SELECT split, field, count(*) AS n, avg(len) AS mean, stddev_samp(len) AS std
  FROM lengths GROUP BY ALL),
measured AS (
  SELECT output_input AS input_output_ratio, balance AS split_balance, variability AS length_variability,
    0.3 * least(output_input, 1) + 0.3 * balance + 0.4 * least(variability, 1) AS overall_quality
  FROM (SELECT
      (SELECT avg(mean) FROM stats WHERE field = 'output_length')
        / (SELECT avg(mean) FROM stats WHERE field = 'input_length') AS output_input,
      (SELECT -sum(share * log2(share)) / log2(count(*)) FROM (
        SELECT n / sum(n) OVER () AS share FROM stats WHERE field = 'input_length')) AS balance,
      (SELECT avg(coalesce(std, 0)) / 100 FROM stats) AS variability))"""

_PAGES = f"""
pages AS (
  SELECT doc_id, generate_subscripts(ls, 1)::INTEGER AS page_no, unnest(ls) AS text
  FROM (SELECT doc_id, string_split(text, {NL}) AS ls FROM documents)),
heads AS (
  SELECT doc_id, page_no AS start_page, {_strip('text')} AS title,
    (lead(page_no) OVER (PARTITION BY doc_id ORDER BY page_no) - 1)::INTEGER AS end_page,
    row_number() OVER (PARTITION BY doc_id ORDER BY page_no)::INTEGER AS section_no
  FROM pages WHERE regexp_matches(text, {SHORT}))"""

_FILES = """
files AS (
  SELECT doc_id, '/corpus/' || source || '/' || doc_id || '.pdf' AS path,
    '/corpus/' || source AS directory, text, strlen(text) AS length
  FROM (SELECT doc_id, coalesce(source, 'none') AS source, coalesce(text, '') AS text FROM documents))"""

_TURNS = """
turns AS (
  SELECT u.conv_id || '-' || u.turn AS id, u.text AS input, a.text AS output
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'),
outputs AS (
  SELECT id, input, output,
    array_to_string(ws[:((len(ws) + 1) // 2)], ' ') AS baseline,
    array_to_string(list_filter(ws, lambda w, i: i % 10 <> 0), ' ') AS tuned
  FROM (SELECT *, string_split(output, ' ') AS ws FROM turns)),
predictions AS (
  SELECT id, input, output, 'baseline' AS model, baseline AS prediction FROM outputs
  UNION ALL SELECT id, input, output, 'tuned', tuned FROM outputs)"""

_QA = f"""{_TURNS},
qa AS (
  SELECT id, input, output, CASE {_pick("md5(concat_ws('#', id, 'qa', '0'))", 3)}
    WHEN 0 THEN '  ' || output || {NL} WHEN 1 THEN baseline ELSE tuned END AS prediction
  FROM outputs),
qa_measured AS (
  SELECT avg((p = o)::INTEGER) AS exact_match,
    avg((p <> '' AND o <> '' AND (contains(p, o) OR contains(o, p)))::INTEGER) AS contains_answer
  FROM (SELECT {_strip('lower(prediction)')} AS p, {_strip('lower(output)')} AS o FROM qa))"""


def _metrics(rows: str) -> str:
    """Text metrics of ``rows`` (a name that has id, model, output, prediction)."""
    tokens = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"
    return f"""
toks AS (
  SELECT id, model, {tokens.format('prediction')} AS p, {tokens.format('output')} AS o FROM {rows}),
grams AS (
  SELECT id, model, n, 'p' AS side,
    unnest(list_transform(range(1, len(p) - n + 2), lambda i: array_to_string(p[i:i+n-1], ' '))) AS g
  FROM toks, range(1, 5) r(n)
  UNION ALL
  SELECT id, model, n, 'o',
    unnest(list_transform(range(1, len(o) - n + 2), lambda i: array_to_string(o[i:i+n-1], ' ')))
  FROM toks, range(1, 5) r(n)),
overlap AS (
  SELECT id, model, n, sum(least(cp, co)) AS hits FROM (
    SELECT id, model, n, g, count(*) FILTER (WHERE side = 'p') AS cp,
      count(*) FILTER (WHERE side = 'o') AS co
    FROM grams GROUP BY ALL) GROUP BY ALL),
sized AS (
  SELECT id, model, n, coalesce(hits, 0) AS hits, greatest(len(p) - n + 1, 0) AS np,
    greatest(len(o) - n + 1, 0) AS no, len(p) AS lp, len(o) AS lo
  FROM (SELECT * FROM toks, range(1, 5) r(n)) LEFT JOIN overlap USING (id, model, n)),
rouge AS (
  SELECT id, model, n,
    CASE WHEN hits = 0 THEN 0 ELSE 2 * (hits / np) * (hits / no) / (hits / np + hits / no) END AS f
  FROM sized),
bleu AS (
  SELECT model, CASE WHEN min(h) = 0 THEN 0 ELSE
      exp(avg(ln(h / t))) * CASE WHEN any_value(lp) > any_value(lo) THEN 1
        ELSE exp(1 - any_value(lo) / any_value(lp)) END END AS bleu
  FROM (SELECT model, n, sum(hits) AS h, sum(np) AS t, sum(lp) AS lp, sum(lo) AS lo
        FROM sized GROUP BY ALL) GROUP BY model),
lcs AS (
  SELECT id, model, p, o, 0 AS i, list_transform(o, lambda x: 0) AS dp FROM toks
  UNION ALL
  SELECT id, model, p, o, i + 1,
    list_transform(range(1, len(o) + 1), lambda j: list_max(cand[1:j]))
  FROM (SELECT *, list_transform(range(1, len(o) + 1), lambda j:
          CASE WHEN o[j] = p[i + 1] THEN CASE WHEN j = 1 THEN 1 ELSE dp[j - 1] + 1 END
            ELSE dp[j] END) AS cand
        FROM lcs WHERE i < len(p))),
rouge_l AS (
  SELECT id, model, CASE WHEN h = 0 THEN 0 ELSE 2 * h / (np + no) END AS f
  FROM (SELECT id, model, coalesce(list_max(dp), 0) AS h, len(p) AS np, len(o) AS no
        FROM lcs WHERE i = len(p))),
text_metrics AS (
  SELECT model, 'rouge' || n AS metric, avg(f) AS value FROM rouge WHERE n <= 2 GROUP BY model, n
  UNION ALL SELECT model, 'rougeL', avg(f) FROM rouge_l GROUP BY model
  UNION ALL SELECT model, 'bleu', bleu FROM bleu),
compared AS (
  SELECT metric, b.value AS baseline, t.value AS tuned,
    round(t.value - b.value, 10) AS absolute_improvement,
    round((t.value - b.value) / nullif(b.value, 0) * 100, 10) AS relative_improvement
  FROM text_metrics b JOIN text_metrics t USING (metric)
  WHERE b.model = 'baseline' AND t.model = 'tuned')"""


_CLASSES = """
rows AS (
  SELECT doc_id, quality::VARCHAR AS label, CASE WHEN n_chars >= 500 THEN '1' ELSE '0' END AS prediction
  FROM labels JOIN documents USING (doc_id)),
scores AS (
  SELECT class, support, coalesce(tp / nullif(predicted, 0), 0) AS precision,
    coalesce(tp / nullif(support, 0), 0) AS recall,
    coalesce(2 * tp / nullif(predicted + support, 0), 0) AS f1
  FROM (SELECT class, (SELECT count(*) FROM rows WHERE label = class) AS support,
      (SELECT count(*) FROM rows WHERE prediction = class) AS predicted,
      (SELECT count(*) FROM rows WHERE label = class AND prediction = class) AS tp
    FROM (SELECT label AS class FROM rows UNION SELECT prediction FROM rows)))"""

_RATINGS = f"""{_TURNS},
choices AS (
  SELECT id, ['baseline', 'tuned', 'neither'][{_pick("md5(concat_ws('#', id, 'choice', '0'))", 4)} + 1] AS preference
  FROM turns),
drawn AS (
  SELECT id, model, criterion,
    {_pick("md5(concat_ws('#', id, model, criterion, 'rating', '0'))", 7)}::DOUBLE AS value
  FROM turns, (SELECT unnest(['baseline', 'tuned']) AS model),
    (SELECT unnest(['relevance', 'accuracy', 'fluency']) AS criterion)),
rated AS (SELECT * FROM drawn WHERE value > 0),
rating_means AS (
  SELECT model, criterion, count(*) AS count, avg(value) AS mean, median(value) AS median,
    coalesce(stddev_samp(value), 0) AS std FROM rated GROUP BY ALL)"""

_LOG = """
log AS (
  SELECT event_id, ts, 'm' || (user_id % 2) AS model_id, 'ep' || (user_id % 5) AS endpoint_id,
    props AS request, event_type AS response, value AS latency,
    CASE WHEN event_type = 'error' THEN 'failed request' END AS error,
    CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS severity,
    CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
    (props::JSON ->> '$.k')::DOUBLE / 100 AS usage
  FROM events),
feedback AS (
  SELECT event_id, ts, 'm' || (user_id % 2) AS model_id, 'ep' || (user_id % 5) AS endpoint_id,
    CASE WHEN event_type = 'purchase' THEN value END AS score
  FROM events WHERE event_type IN ('view', 'purchase'))"""

_STREAKS = f"""{_LOG},
numbered AS (
  SELECT *, sum((status <> 'error')::INTEGER) OVER (PARTITION BY endpoint_id ORDER BY ts, event_id) AS island,
    sum((status <> 'error')::INTEGER) OVER (PARTITION BY endpoint_id) AS successes
  FROM log),
streaks AS (
  SELECT endpoint_id, island, any_value(successes) AS successes, count(*) AS failures,
    {_ts('min(ts)')} AS first_ts, {_ts('max(ts)')} AS last_ts,
    CASE WHEN count(*) >= 3 THEN 'critical' ELSE 'warning' END AS level
  FROM numbered WHERE status = 'error' GROUP BY endpoint_id, island)"""

# Rows that arrive six days late, and the fifth of the time in which each arrives.
_ARRIVALS = f"""{_LOG},
span AS (SELECT min(ts) AS a, max(ts) + INTERVAL 6 DAY AS b FROM log),
arrivals AS (
  SELECT log.*, least(4, floor(5 * (epoch_us(ts + CASE WHEN {_pick("md5(concat_ws('#', event_id, 'late', '0'))", 20)} = 0 THEN INTERVAL 6 DAY ELSE INTERVAL 0 DAY END)
      - epoch_us(a)) / (epoch_us(b) - epoch_us(a))))::BIGINT AS batch,
    date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end
  FROM log, span),
marks AS (
  SELECT batch, count(*) AS rows, max(ts) AS newest,
    max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 DAY AS watermark,
    max(max(ts)) OVER (ORDER BY batch) AS newest_so_far
  FROM arrivals GROUP BY batch),
judged AS (SELECT *, coalesce(window_end <= watermark, false) AS is_late FROM arrivals JOIN marks USING (batch))"""

# Versions 1 to 4 of the examples; a row's group says in which it is, and group 5 is edited in the third.
_VERSIONS = f"""{_PREPARE},
grouped AS (
  SELECT *, {_pick("md5(concat_ws('#', doc_id, chunk_index, 'version', '0'))", 6)} AS g FROM examples),
versioned AS MATERIALIZED (
  SELECT v, md5(md5(input_text || CASE WHEN g = 5 AND v >= 3 THEN '!' ELSE '' END) || md5(output_text)) AS content_key, count(*) AS count
  FROM grouped, (SELECT unnest([1, 2, 3, 4]) AS v)
  WHERE list_contains([[1], [1, 2], [1, 2, 3, 4], [3, 4], [1, 3], [1, 2, 3, 4]][g + 1], v)
  GROUP BY ALL),
version_runs AS (
  SELECT content_key, count, min(v)::BIGINT AS from_version, CASE WHEN max(v) < 4 THEN max(v)::BIGINT END AS to_version
  FROM (SELECT *, v - row_number() OVER (PARTITION BY content_key, count ORDER BY v) AS island FROM versioned)
  GROUP BY content_key, count, island)"""

_TRIALS = """
history AS (
  SELECT user_id AS trial, CASE WHEN user_id % 10 = 0 THEN value + 1 END AS best_metric,
    CASE WHEN event_type <> 'signup' THEN event_id::INTEGER END AS step,
    CASE WHEN event_type <> 'signup' THEN value END AS eval_loss
  FROM events),
trial_metrics AS (
  SELECT trial, coalesce(min(best_metric), min(eval_loss), 'inf'::DOUBLE) AS metric
  FROM history GROUP BY trial)"""


def _level(value: str, warning: float, critical: float) -> str:
    return (
        f"CASE WHEN {value} >= {critical} THEN 'critical' "
        f"WHEN {value} >= {warning} THEN 'warning' ELSE 'ok' END"
    )


def _with(body: str, *tables: str) -> str:
    return f"WITH RECURSIVE {', '.join(tables)}\n{body}" if tables else body


def _rating(metric: str, medium: float, good: float) -> str:
    return f"""
      SELECT '{metric}' AS metric, round({metric}, 6) AS value, printf('%.2f', {metric}) AS formatted,
        CASE WHEN {metric} >= {good} THEN 'good' WHEN {metric} >= {medium} THEN 'medium'
          ELSE 'poor' END AS rating,
        CASE WHEN {metric} >= {good} THEN 'Good' WHEN {metric} >= {medium} THEN 'Medium'
          ELSE 'Poor' END AS label FROM measured"""


def _window_measures(value: str, name: str) -> str:
    return f"""count(*) AS {name}_count, round(coalesce(avg({value}), 0), 6) AS mean,
      round(coalesce(median({value}), 0), 6) AS median, round(coalesce(min({value}), 0), 6) AS min,
      round(coalesce(max({value}), 0), 6) AS max"""


def _closed(days: int) -> str:
    """Windows that end before the watermark."""
    return f"w + INTERVAL {days} DAY <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM {{}})"


_STATS_LONG = f"""
  SELECT 'input_length' AS field, {_stats('length(input)')} FROM p
  UNION ALL SELECT 'output_length', {_stats('length(output)')} FROM p
  UNION ALL SELECT 'prediction_length', {_stats('length(prediction)')} FROM p"""

ORACLE: dict[str, str] = {
    # sources and sinks
    "published_files": _with("SELECT path, length, md5(text) AS content_md5 FROM files", _FILES),
    "publish_manifest": _with("SELECT path, length, md5(text) AS md5 FROM files", _FILES),
    "chunk_table": _with("SELECT doc_id, chunk_index, chunk FROM chunks", _PREPARE),
    "structure_table": _with(
        f"""SELECT doc_id, source AS author, len(string_split(text, {NL}))::INTEGER AS pages,
        coalesce((SELECT count(*) FROM heads h WHERE h.doc_id = d.doc_id), 0)::INTEGER AS headings,
        coalesce((SELECT count(*) FROM heads h WHERE h.doc_id = d.doc_id), 0)::INTEGER AS sections FROM documents d""",
        _PAGES,
    ),
    "evaluation_output": _with(
        """SELECT model, metric, round(value, 6) AS value FROM text_metrics
        UNION ALL SELECT model, 'rows', count(*)::DOUBLE FROM predictions GROUP BY model""",
        _TURNS,
        _metrics("predictions"),
    ),
    "assemble_pages": f"""SELECT doc_id,
        array_to_string(list_filter(string_split(text, {NL}), lambda t: t <> ''), {NL} || {NL}) AS text
        FROM documents""",
    "doc_metadata": f"""SELECT doc_id, '' AS title, source AS author,
        CASE WHEN lang = 'en' THEN '' ELSE lang END AS subject, '' AS creator, '' AS producer,
        '' AS creation_date, '' AS modification_date, len(string_split(text, {NL}))::INTEGER AS pages
        FROM documents""",
    "file_metadata": _with(
        f"""SELECT path, doc_id || '.pdf' AS "FileName", length::INTEGER AS "FileSize",
        len(string_split(text, {NL}))::INTEGER AS "PageCount" FROM files""",
        _FILES,
    ),
    "entity_spans": """SELECT doc_id, lang AS type, substr(text, 1, length(text) // 2) AS text,
        0.9::DOUBLE AS confidence FROM documents UNION ALL
        SELECT doc_id, source, substr(text, length(text) // 2 + 1), 0.5::DOUBLE FROM documents""",
    "load_chunks": _with(
        f"""SELECT doc_id, page_no - 1 AS chunk_index, {_strip('text')} AS chunk
        FROM pages WHERE {_strip('text')} <> ''""",
        _PAGES,
    ),
    "read_examples": "SELECT doc_id, 'About: ' || text AS input_text, text AS output_text FROM documents",
    "rejected_lines": """SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN 0 ELSE 1 END::INTEGER AS unreadable
        FROM documents""",
    "read_splits": _with("SELECT split, input_text, output_text FROM splits", _PREPARE),
    "manifest": _with("SELECT split, count(*) AS rows FROM splits GROUP BY split", _PREPARE),
    "read_eval": _with("SELECT * FROM turns", _TURNS),
    "read_questions": _with("SELECT doc_id, text AS question FROM pages", _PAGES),
    "file_inventory": _with(
        """SELECT directory, count(*) AS files, sum(length)::BIGINT AS bytes
        FROM files GROUP BY directory""",
        _FILES,
    ),
    "trial_history": _with(
        "SELECT trial, round(best_metric, 6) AS best_metric, step, round(eval_loss, 6) AS eval_loss FROM history",
        _TRIALS,
    ),
    "render_chunks": _with(
        f"""SELECT doc_id, string_agg('--- Chunk ' || chunk_index || ' ---' || {NL} || chunk || {NL} || {NL},
        '' ORDER BY chunk_index) AS rendered FROM chunks GROUP BY doc_id""",
        _PREPARE,
    ),
    # scalar functions
    "paragraphs": _with(
        """SELECT doc_id, (generate_subscripts(ps, 1) - 1)::INTEGER AS pos, unnest(ps) AS paragraph
        FROM paragraph_lists""",
        _PREPARE,
    ),
    "clean_text": f"""SELECT doc_id, {_strip(r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        regexp_replace(text, '\r\n?', chr(10), 'g'), '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'),
        '[ \t\x{A0}]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g')""")} AS text FROM documents""",
    **{
        name: _with(f"SELECT doc_id, chunk_index, {column} FROM told", _PREPARE)
        for name, column in {
            "first_sentence": "sentence",
            "strip_stopword": "subject",
            "gen_question": "question",
            "keywords": "keywords",
            "gen_instruction": "instruction",
        }.items()
    },
    **{
        name: _with(f"SELECT doc_id, chunk_index, {column} FROM examples", _PREPARE)
        for name, column in {
            "make_examples": "kind, input_text, output_text",
            "training_prompt": f"'Input: ' || input_text || {NL} || 'Output: ' || output_text AS prompt",
        }.items()
    },
    "validate_examples": _with(
        """SELECT doc_id, chunk_index, (v.doc_id IS NOT NULL)::INTEGER AS valid
        FROM examples LEFT JOIN valid v USING (doc_id, chunk_index)""",
        _PREPARE,
    ),
    "valid_counts": _with(
        """SELECT doc_id, count(*) AS examples, count(v.kind) AS valid
        FROM examples e LEFT JOIN valid v USING (doc_id, chunk_index) GROUP BY doc_id""",
        _PREPARE,
    ),
    "token_budget": f"""SELECT doc_id,
        array_to_string(list_concat(ws[:64], list_transform(range(64 - len(ws[:64])), lambda i: '<pad>')), ' ')
          AS tokens, len(ws[:64])::INTEGER AS kept, 64::INTEGER AS labels
        FROM (SELECT doc_id, {_words('text')} AS ws FROM documents)""",
    "extract_answer": _with(
        f"""SELECT id, {_strip("CASE WHEN length(id) % 2 = 0 THEN output ELSE output || ' ' END")} AS answer
        FROM turns""",
        _TURNS,
    ),
    "prediction_content": _with("SELECT id, output AS content FROM turns", _TURNS),
    "probe_questions": _with(
        f"""SELECT doc_id, chunk_index, sample_rank, 'What can you tell me about ' || sentence || '?' AS question,
        CASE WHEN length(chunk) > 200 THEN left(chunk, 200) || '...' ELSE chunk END AS context,
        length(chunk)::INTEGER AS text_length FROM subjects""",
        _PREPARE,
    ),
    # chunks and structure
    "chunk_documents": _with("SELECT doc_id, chunk_index, chunk FROM chunks", _PREPARE),
    "sections": _with("SELECT doc_id, title, start_page, end_page FROM heads", _PAGES),
    "toc": _with(
        """SELECT d.doc_id, (section_no - 1)::INTEGER AS pos, title
        FROM documents d LEFT JOIN heads h ON h.doc_id = d.doc_id""",
        _PAGES,
    ),
    "doc_structure": _with(
        f"""SELECT doc_id, source AS author, len(string_split(text, {NL}))::INTEGER AS pages,
        coalesce((SELECT count(*) FROM heads h WHERE h.doc_id = d.doc_id), 0)::INTEGER AS headings,
        (SELECT max(start_page) FROM heads h WHERE h.doc_id = d.doc_id) AS last_section_start
        FROM documents d""",
        _PAGES,
    ),
    "section_chunks": _with(
        """SELECT p.doc_id, coalesce(section_no, 0)::INTEGER AS section_no, title, page_no, text
        FROM pages p LEFT JOIN heads h ON h.doc_id = p.doc_id
          AND p.page_no >= h.start_page AND (p.page_no <= h.end_page OR h.end_page IS NULL)""",
        _PAGES,
    ),
    "chunk_sections": _with(
        """SELECT filled.doc_id, chunk_index, coalesce(section_no, 0)::INTEGER AS section_no, title
        FROM (SELECT doc_id, (row_number() OVER chunk_order)::INTEGER AS chunk_index,
            coalesce(lag(pos) OVER chunk_order, 1) AS n
          FROM closed WINDOW chunk_order AS (PARTITION BY doc_id ORDER BY pos))
        JOIN filled USING (doc_id, n) ASOF LEFT JOIN heads ON heads.doc_id = filled.doc_id
          AND filled.page_no >= heads.start_page""",
        _PREPARE,
        _PAGES,
        f"""filled AS (SELECT doc_id, page_no, row_number() OVER (PARTITION BY doc_id ORDER BY page_no) AS n
          FROM pages WHERE {_strip('text')} <> '')""",
    ),
    # sampling and splits
    "sample_chunks": _with("SELECT doc_id, chunk_index, chunk, sample_rank, kind FROM sampled", _PREPARE),
    "split_exact": """SELECT doc_id, CASE WHEN r <= floor(n::DOUBLE * 0.8::DOUBLE) THEN 'train'
        WHEN r <= floor(n::DOUBLE * 0.8::DOUBLE) + floor(n::DOUBLE * 0.1::DOUBLE) THEN 'val' ELSE 'test' END AS split
        FROM (SELECT doc_id, count(*) OVER () AS n,
          row_number() OVER (ORDER BY md5(concat_ws('#', doc_id, 'split', '0'))) AS r FROM documents)""",
    "split_hash": """SELECT doc_id, CASE WHEN f < 0.8::DOUBLE THEN 'train'
        WHEN f < 0.8::DOUBLE + 0.1::DOUBLE THEN 'val' ELSE 'test' END AS split
        FROM (SELECT doc_id, ('0x' || substr(md5(concat_ws('#', doc_id, 'split', '0')), 1, 8))::BIGINT::DOUBLE
          / 4294967296 AS f FROM documents)""",
    "holdout": """SELECT doc_id, CASE WHEN split = 'train' AND r > n - ceil(n::DOUBLE * 0.1::DOUBLE)
          THEN 'val' ELSE split END AS split
        FROM (SELECT *, count(*) OVER (PARTITION BY split) AS n, row_number() OVER (PARTITION BY split
            ORDER BY md5(concat_ws('#', doc_id, 'holdout', 'split', '0'))) AS r
          FROM (SELECT doc_id, CASE WHEN ('0x' || substr(md5(concat_ws('#', doc_id, 'split', '0')), 1, 8))::BIGINT::DOUBLE
            / 4294967296 < 0.9::DOUBLE THEN 'train' ELSE 'test' END AS split FROM documents))""",
    "prepare_training_data": _with("SELECT * FROM splits", _PREPARE),
    "split_counts": _with(
        """SELECT s.split, count(e.split) AS count
        FROM (SELECT unnest(['train', 'val', 'test']) AS split) s LEFT JOIN splits e USING (split)
        GROUP BY s.split""",
        _PREPARE,
    ),
    "review_sample": _with(
        "SELECT * FROM turns ORDER BY md5(concat_ws('#', id, 'review', '0')) LIMIT 50", _TURNS
    ),
    # quality
    "length_stats": _with(f"SELECT split, field, {_stats('len')} FROM lengths GROUP BY split, field", _PREPARE),
    "basic_stats": f"SELECT lang, {_stats('length(text)')} FROM documents GROUP BY lang",
    "length_pivot": _with(
        """SELECT split, min(length(input_text))::INTEGER AS input_length_min,
        round(avg(length(input_text)), 6) AS input_length_mean, max(length(input_text))::INTEGER AS input_length_max,
        min(length(output_text))::INTEGER AS output_length_min,
        round(avg(length(output_text)), 6) AS output_length_mean,
        max(length(output_text))::INTEGER AS output_length_max FROM splits GROUP BY split""",
        _PREPARE,
    ),
    "quality_metrics": _with(
        """SELECT round(input_output_ratio, 6) AS input_output_ratio, round(split_balance, 6) AS split_balance,
        round(length_variability, 6) AS length_variability, round(overall_quality, 6) AS overall_quality
        FROM measured""",
        _PREPARE,
    ),
    "quality_ratings": _with(
        " UNION ALL ".join(
            _rating(*r)
            for r in (
                ("input_output_ratio", 0.5, 2.0),
                ("split_balance", 0.7, 0.9),
                ("length_variability", 0.3, 0.7),
                ("overall_quality", 0.5, 0.8),
            )
        ),
        _PREPARE,
    ),
    "quality_report_rows": _with(
        f"""SELECT 'stats' AS section, name, measure, value FROM (
          UNPIVOT (SELECT split || '/' || field AS name, count::DOUBLE AS count, min::DOUBLE AS min, max::DOUBLE AS max,
              mean, median, std FROM (SELECT split, field, {_stats('len')} FROM lengths GROUP BY split, field))
          ON count, min, max, mean, median, std INTO NAME measure VALUE value)
        UNION ALL SELECT 'metrics', name, 'value', round(value, 6) FROM (
          UNPIVOT (SELECT * FROM measured) ON input_output_ratio, split_balance, length_variability, overall_quality
          INTO NAME name VALUE value)""",
        _PREPARE,
    ),
    "dataset_summary": _with(
        f"""SELECT coalesce(split, 'total') AS split, field, {_stats('len')} FROM lengths
        GROUP BY GROUPING SETS ((split, field), (field))""",
        _PREPARE,
    ),
    # metrics
    "rouge_n": _with(
        """SELECT id, model, round(max(f) FILTER (WHERE n = 1), 6) AS rouge1,
        round(max(f) FILTER (WHERE n = 2), 6) AS rouge2 FROM rouge GROUP BY id, model""",
        _TURNS,
        _metrics("predictions"),
    ),
    "rouge_l": _with(
        """SELECT id, model, round(f, 6) AS "rougeL" FROM rouge_l""",
        _TURNS,
        _metrics("predictions"),
    ),
    "bleu": _with("SELECT model, round(bleu, 6) AS bleu FROM bleu", _TURNS, _metrics("predictions")),
    "confusion_matrix": _with(
        "SELECT label, prediction, count(*) AS count FROM rows GROUP BY ALL", _CLASSES
    ),
    "class_scores": _with(
        """SELECT class, support, round(precision, 6) AS precision, round(recall, 6) AS recall,
        round(f1, 6) AS f1 FROM scores""",
        _CLASSES,
    ),
    "classification_metrics": _with(
        """SELECT round((SELECT avg((label = prediction)::INTEGER) FROM rows), 6) AS accuracy,
        round(sum(precision * support) / sum(support), 6) AS precision,
        round(sum(recall * support) / sum(support), 6) AS recall,
        round(sum(f1 * support) / sum(support), 6) AS f1, round(avg(precision), 6) AS macro_precision,
        round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1 FROM scores""",
        _CLASSES,
    ),
    "qa_metrics": _with(
        """SELECT round(exact_match, 6) AS exact_match, round(contains_answer, 6) AS contains_answer
        FROM qa_measured""",
        _QA,
    ),
    "task_metrics": _with(
        """SELECT metric, round(value, 6) AS value FROM text_metrics
        UNION ALL SELECT 'exact_match', round(exact_match, 6) FROM qa_measured
        UNION ALL SELECT 'contains_answer', round(contains_answer, 6) FROM qa_measured""",
        _QA,
        "qa_rows AS (SELECT *, 'any' AS model FROM qa)",
        _metrics("qa_rows"),
    ),
    "embedding_similarity": """SELECT l.vec_id,
        round(list_cosine_similarity(l.embedding::DOUBLE[], r.embedding::DOUBLE[]), 6) AS similarity
        FROM embeddings l JOIN embeddings r ON r.vec_id = l.vec_id + 1""",
    # comparison and human evaluation
    "model_metrics": _with(
        "SELECT model, metric, round(value, 6) AS value FROM text_metrics", _TURNS, _metrics("predictions")
    ),
    "improvement": _with(
        """SELECT metric, round(absolute_improvement, 6) AS absolute,
        round(relative_improvement, 6) AS relative FROM compared""",
        _TURNS,
        _metrics("predictions"),
    ),
    "comparison_table": _with(
        """SELECT metric, round(baseline, 6) AS baseline, round(tuned, 6) AS tuned,
        round(absolute_improvement, 6) AS absolute_improvement,
        round(relative_improvement, 6) AS relative_improvement FROM compared""",
        _TURNS,
        _metrics("predictions"),
    ),
    "compare_outputs": _with(
        """SELECT model, round(avg(length(prediction)), 6) AS mean_length,
        round(median(length(prediction))::DOUBLE, 6) AS median_length,
        min(length(prediction))::INTEGER AS min_length, max(length(prediction))::INTEGER AS max_length,
        count(*) FILTER (WHERE prediction = output) AS reference_match,
        round(avg((prediction = output)::INTEGER) * 100, 6) AS reference_match_percentage,
        (SELECT count(*) FROM outputs WHERE baseline = tuned) AS exact_match,
        round((SELECT avg((baseline = tuned)::INTEGER) FROM outputs) * 100, 6) AS exact_match_percentage
        FROM predictions GROUP BY model""",
        _TURNS,
    ),
    "compare_aligned_outputs": _with("SELECT id, baseline, tuned, output AS reference FROM outputs", _TURNS),
    "review_tasks": _with(
        """SELECT id AS task_id, input AS input_text, output AS reference_output, baseline, tuned,
        0::INTEGER AS more_outputs, 'relevance,accuracy,fluency,preference' AS criteria FROM outputs""",
        _TURNS,
    ),
    "ratings_long": _with("SELECT id AS evaluation_id, preference, model, criterion, value FROM rated JOIN choices USING (id)", _RATINGS),
    "rating_stats": _with(
        """SELECT model, criterion, count, round(mean, 6) AS mean, round(median, 6) AS median,
        round(std, 6) AS std FROM rating_means""",
        _RATINGS,
    ),
    "rating_overall": _with(
        "SELECT model, round(avg(mean), 6) AS overall FROM rating_means GROUP BY model", _RATINGS
    ),
    "preferences": _with(
        """SELECT preference, count(*) AS count FROM choices WHERE preference IS NOT NULL
        GROUP BY preference""",
        _RATINGS,
    ),
    "rating_violations": _with(
        """SELECT id AS evaluation_id, model, criterion,
          CASE WHEN value = 0 THEN 'missing' ELSE 'out_of_bounds' END AS problem
        FROM drawn WHERE value = 0 OR value > 5
        UNION ALL SELECT id, NULL, 'preference',
          CASE WHEN preference IS NULL THEN 'missing' ELSE 'not_an_option' END
        FROM choices WHERE preference IS NULL OR preference = 'neither'""",
        _RATINGS,
    ),
    "evaluation_summary": _with(
        " UNION ALL ".join(
            f"""SELECT 'metrics' AS section, metric AS name, 'value' AS measure, round(value, 6) AS value, '{m}' AS summary_of
        FROM text_metrics WHERE model = '{m}'
        UNION ALL SELECT 'prediction_stats', field, measure, value, '{m}' FROM (
          UNPIVOT (SELECT field, count::DOUBLE AS count, min::DOUBLE AS min, max::DOUBLE AS max, mean, median, std
            FROM ({_STATS_LONG.replace('FROM p', f"FROM predictions WHERE model = '{m}'")}))
          ON count, min, max, mean, median, std INTO NAME measure VALUE value)
        UNION ALL SELECT 'improvement', metric, 'absolute_improvement', round(absolute_improvement, 6), '{m}' FROM compared
        UNION ALL SELECT 'improvement', metric, 'relative_improvement', round(relative_improvement, 6), '{m}' FROM compared
        UNION ALL SELECT 'human_evaluation', model, 'overall', round(avg(mean), 6), '{m}' FROM rating_means GROUP BY model"""
            for m in ("tuned", "baseline")
        ),
        _RATINGS,
        _metrics("predictions"),
    ),
    "example_predictions": _with(
        """(SELECT * FROM predictions WHERE model = 'tuned' ORDER BY id LIMIT 5) UNION ALL
        (SELECT * FROM predictions WHERE model = 'baseline' ORDER BY id LIMIT 5)""",
        _TURNS,
    ),
    "answers_by_model": _with(
        "SELECT id, input AS question, baseline, tuned FROM outputs", _TURNS
    ),
    # the training set as a whole
    "duplicate_inputs": _with(
        f"""SELECT md5({_strip('lower(input_text)')}) AS input_key, count(*) AS count,
        count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'val') AS val,
        count(*) FILTER (WHERE split = 'test') AS test, (count(DISTINCT split) > 1)::INTEGER AS leaked
        FROM splits GROUP BY ALL HAVING count(*) > 1""",
        _PREPARE,
    ),
    "coverage": _with(
        r"""SELECT b.doc_id, length(body)::INTEGER AS source_characters,
        coalesce(covered, 0)::INTEGER AS covered_characters,
        round(coalesce(coalesce(covered, 0) / nullif(length(body), 0), 0), 6) AS coverage
        FROM bodies b LEFT JOIN (
          SELECT doc_id, sum(greatest(stop - greatest(start, coalesce(before, 0)), 0)) AS covered
          FROM (SELECT *, max(stop) OVER (PARTITION BY doc_id ORDER BY start, stop
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM spans)
          GROUP BY doc_id) USING (doc_id)""",
        _PREPARE,
        r"""bodies AS (SELECT doc_id, regexp_replace(text, '[ \t\n\r\f\x0B]+', '', 'g') AS body FROM documents)""",
        r"""spans AS (
          SELECT DISTINCT doc_id, strpos(body, part) AS start, strpos(body, part) + length(part) AS stop
          FROM (SELECT doc_id, regexp_replace(output_text, '[ \t\n\r\f\x0B]+', '', 'g') AS part FROM splits)
            JOIN bodies USING (doc_id) WHERE part <> '' AND contains(body, part))""",
    ),
    "diversity": _with(
        f"""SELECT sum(n)::BIGINT AS examples, count(*) AS kinds,
        round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 6) AS entropy,
        round((log2(sum(n)) - sum(n * log2(n)) / sum(n)) / log2(count(*)), 6) AS evenness,
        (SELECT count(DISTINCT input_text) FROM splits) AS distinct_inputs
        FROM (SELECT ({_words('input_text')})[1] AS template, count(*) AS n FROM splits GROUP BY 1)""",
        _PREPARE,
    ),
    "relevance": _with(
        r"""SELECT doc_id, chunk_index, round(coalesce(len(list_intersect(a, b)) /
          nullif(len(a) + len(b) - len(list_intersect(a, b)), 0), 0), 6) AS relevance
        FROM (SELECT doc_id, chunk_index,
            list_distinct(list_filter(regexp_split_to_array(lower(input_text), '[^\p{L}\p{N}]+'), lambda t: t <> '')) AS a,
            list_distinct(list_filter(regexp_split_to_array(lower(output_text), '[^\p{L}\p{N}]+'), lambda t: t <> '')) AS b
          FROM splits)""",
        _PREPARE,
    ),
    "version_history": _with("SELECT content_key, count, from_version, to_version FROM version_runs", _VERSIONS),
    "version_states": _with("SELECT v::INTEGER AS version, content_key, count FROM versioned", _VERSIONS),
    "version_changes": _with(
        """SELECT version::BIGINT AS version, count(*) FILTER (WHERE b = 1 AND e = 0) AS added, count(*) FILTER (WHERE b = 0 AND e = 1) AS removed, count(*) FILTER (WHERE b = 1 AND e = 1) AS changed
        FROM (SELECT version, content_key, max(b) AS b, max(e) AS e FROM (
            SELECT from_version AS version, content_key, 1 AS b, 0 AS e FROM version_runs
            UNION ALL SELECT to_version + 1, content_key, 0, 1 FROM version_runs WHERE to_version IS NOT NULL) GROUP BY ALL)
        GROUP BY version""",
        _VERSIONS,
    ),
    "version_diff": _with(
        """SELECT content_key, coalesce(o, 0) AS old_count, coalesce(n, 0) AS new_count,
        CASE WHEN o IS NULL THEN 'added' WHEN n IS NULL THEN 'removed' ELSE 'kept' END AS change
        FROM (SELECT md5(md5(input_text) || md5(output_text)) AS content_key, count(*) AS o FROM examples GROUP BY 1)
        FULL JOIN (SELECT md5(md5(input_text) || md5(output_text)) AS content_key, count(*) AS n FROM splits GROUP BY 1)
          USING (content_key)""",
        _PREPARE,
    ),
    # monitoring
    "prediction_log": _with(
        f"SELECT * REPLACE ({_ts('ts')} AS ts, round(latency, 6) AS latency, round(usage, 6) AS usage) FROM log", _LOG
    ),
    "metric_points": _with(
        f"""SELECT {_ts('ts')} AS ts, 'model/' || model_id || '/' || metric AS metric, endpoint_id, status,
          value_int, value_double FROM (
        SELECT ts, model_id, 'prediction_count' AS metric, endpoint_id, status, 1::BIGINT AS value_int,
          NULL::DOUBLE AS value_double FROM log
        UNION ALL SELECT ts, model_id, 'prediction_latency', endpoint_id, NULL, NULL, round(latency, 6) FROM log
        UNION ALL SELECT ts, model_id, 'feedback_count', endpoint_id, NULL, 1, NULL FROM feedback
        UNION ALL SELECT ts, model_id, 'feedback_score', endpoint_id, NULL, NULL, round(score, 6) FROM feedback
          WHERE score IS NOT NULL)""",
        _LOG,
    ),
    "typed_points": _with(
        f"""SELECT {_ts('ts')} AS ts, 'model/' || model_id || '/' || metric AS metric, endpoint_id,
          value_bool, value_int, value_double FROM (
        SELECT ts, model_id, 'failed' AS metric, endpoint_id, (status = 'error')::INTEGER AS value_bool,
          NULL::BIGINT AS value_int, NULL::DOUBLE AS value_double FROM log
        UNION ALL SELECT ts, model_id, 'request_length', endpoint_id, NULL, length(request), NULL FROM log
          WHERE request IS NOT NULL
        UNION ALL SELECT ts, model_id, 'usage', endpoint_id, NULL, NULL, round(usage, 6) FROM log
          WHERE usage IS NOT NULL)""",
        _LOG,
    ),
    "prediction_metrics": _with(
        f"SELECT {_window_measures('latency', 'prediction')} FROM log WHERE ts BETWEEN {START} AND {END}", _LOG
    ),
    "feedback_metrics": _with(
        f"SELECT {_window_measures('score', 'feedback')} FROM feedback WHERE ts BETWEEN {START} AND {END}", _LOG
    ),
    "time_range": _with(
        f"SELECT event_id, {_ts('ts')} AS ts FROM log WHERE ts >= {START} AND ts < {END}", _LOG
    ),
    "recent_entries": _with(
        f"""SELECT event_id, {_ts('ts')} AS ts FROM log
        WHERE ts > (SELECT max(ts) - INTERVAL 720 MINUTE FROM log)""",
        _LOG,
    ),
    "prediction_logs": _with(
        f"""SELECT event_id, {_ts('ts')} AS ts, severity, round(latency, 6) AS latency FROM (
          SELECT * FROM log WHERE model_id = 'm1' AND endpoint_id = 'ep3' AND ts BETWEEN {START} AND {END}
          ORDER BY ts DESC, event_id LIMIT 100)""",
        _LOG,
    ),
    "metrics_by_status": _with(
        f"SELECT model_id, endpoint_id, status, count(*) AS prediction_count, round(avg(latency), 6) AS mean, "
        "round(min(latency), 6) AS min, round(max(latency), 6) AS max FROM log GROUP BY ALL",
        _LOG,
    ),
    "flatten_predictions": _with(
        """SELECT doc_id, page_no - 1 AS position, text AS input, length(text)::INTEGER AS prediction
        FROM pages""",
        _PAGES,
    ),
    "alerts": _with(
        f"""SELECT endpoint_id, {_ts('w')} AS window_start, requests, round(error_rate, 6) AS error_rate,
          {_level('error_rate', 0.05, 0.1)} AS error_alert, round(change, 6) AS run_time_change,
          {_level('change', 0.5, 1.0)} AS run_time_alert, round(usage, 6) AS usage,
          {_level('usage', 0.8, 0.9)} AS usage_alert
        FROM (SELECT *, m / lag(m) OVER (PARTITION BY endpoint_id ORDER BY w) - 1 AS change FROM (
          SELECT endpoint_id, date_trunc('day', ts)::TIMESTAMP AS w, count(*) AS requests,
            avg((status = 'error')::INTEGER) AS error_rate, avg(latency) AS m, avg(usage) AS usage
          FROM log GROUP BY ALL))""",
        _LOG,
    ),
    "failure_streaks": _with("SELECT endpoint_id, first_ts, last_ts, failures, level FROM streaks", _STREAKS),
    "run_rates": _with(
        """SELECT endpoint_id AS step, count(*) AS runs, round(avg((status = 'success')::INTEGER), 6) AS success_rate,
        round(avg((status = 'error')::INTEGER), 6) AS failure_rate, round(avg(latency), 6) AS mean_run_time
        FROM log GROUP BY endpoint_id""",
        _LOG,
    ),
    # trials
    "trial_metric": _with("SELECT trial, round(metric, 6) AS metric FROM trial_metrics", _TRIALS),
    "best_trial": _with(
        "SELECT trial, round(metric, 6) AS metric FROM trial_metrics ORDER BY trial_metrics.metric, trial LIMIT 1",
        _TRIALS,
    ),
    "trial_running_best": _with(
        """SELECT trial, round(metric, 6) AS metric, round(min(metric) OVER (ORDER BY trial), 6) AS best_so_far
        FROM trial_metrics""",
        _TRIALS,
    ),
    "trial_params": _with(
        """SELECT trial, round((trial % 5 + 1) / 100, 6) AS learning_rate, (trial % 4 + 1) * 4 AS batch_size,
        (trial % 3 + 1) * 8 AS lora_r, round(metric, 6) AS metric FROM trial_metrics""",
        _TRIALS,
    ),
    "training_schedule": _with(
        """SELECT n AS examples, b::INTEGER AS batch_size, 4::INTEGER AS accumulation, 3::INTEGER AS epochs,
        0.1::DOUBLE AS warmup_ratio, (n // (b * 4)) * 3 AS steps,
        floor((n // (b * 4)) * 3 * 0.1::DOUBLE)::BIGINT AS warmup_steps
        FROM (SELECT count(*) AS n FROM valid), (SELECT unnest([2, 4, 8]) AS b)""",
        _PREPARE,
    ),
    "stream_late_rows": _with(
        f"""SELECT event_id, {_ts('ts')} AS ts, endpoint_id, status, round(latency, 6) AS latency, {_ts('window_start')} AS window_start, {_ts('window_end')} AS window_end,
          {_ts('watermark')} AS watermark, round((epoch_us(watermark) - epoch_us(ts)) / 1000000, 6) AS behind_seconds, batch
        FROM judged WHERE is_late""",
        _ARRIVALS,
    ),
    "stream_kept_and_late": _with(
        f"""SELECT {_ts('window_start')} AS window_start, {_ts('window_end')} AS window_end, endpoint_id, status, count(*) FILTER (WHERE NOT is_late) AS prediction_count,
          round(sum(latency) FILTER (WHERE NOT is_late), 6) AS total, round(min(latency) FILTER (WHERE NOT is_late), 6) AS min,
          round(max(latency) FILTER (WHERE NOT is_late), 6) AS max, count(*) FILTER (WHERE is_late) AS late
        FROM judged GROUP BY ALL""",
        _ARRIVALS,
    ),
    "stream_progress": _with(
        f"""SELECT batch, count(*) AS rows, count(*) FILTER (WHERE NOT is_late) AS on_time, count(*) FILTER (WHERE is_late) AS late, 0::BIGINT AS undated,
          {_ts('any_value(watermark)')} AS watermark, {_ts('any_value(newest_so_far)')} AS newest FROM judged GROUP BY batch""",
        _ARRIVALS,
    ),
    # streams: all windows and runs, and whether they are closed when the stream has been read
    "stream_metrics": _with(
        f"""SELECT {_ts('w')} AS window_start, {_ts("w + INTERVAL 1 DAY")} AS window_end, endpoint_id, status,
          prediction_count, mean, min, max, ({_closed(1).format('log')})::INTEGER AS final FROM (
          SELECT date_trunc('day', ts)::TIMESTAMP AS w, endpoint_id, status, count(*) AS prediction_count,
            round(avg(latency), 6) AS mean, round(min(latency), 6) AS min, round(max(latency), 6) AS max
          FROM log GROUP BY ALL)""",
        _LOG,
    ),
    "stream_error_alerts": _with(
        f"""SELECT {_ts('w')} AS window_start, {_ts("w + INTERVAL 2 DAY")} AS window_end, endpoint_id,
          requests, errors, round(errors / requests, 6) AS error_rate,
          {_level('errors / requests', 0.05, 0.1)} AS level, ({_closed(2).format('log')})::INTEGER AS final FROM (
          SELECT date_trunc('day', ts)::TIMESTAMP - INTERVAL (back) DAY AS w, endpoint_id, count(*) AS requests,
            count(*) FILTER (WHERE status = 'error') AS errors
          FROM log, range(0, 2) r(back) GROUP BY ALL)""",
        _LOG,
    ),
    "stream_feedback": _with(
        f"""SELECT {_ts('w')} AS window_start, {_ts("w + INTERVAL 1 DAY")} AS window_end, feedback_count,
          mean, min, max, approx_median, ({_closed(1).format('feedback')})::INTEGER AS final FROM (
          SELECT date_trunc('day', ts)::TIMESTAMP AS w, count(*) AS feedback_count,
            round(avg(score), 6) AS mean, round(min(score), 6) AS min, round(max(score), 6) AS max,
            round(quantile_disc(score, 0.5), 6) AS approx_median
          FROM feedback GROUP BY ALL)""",
        _LOG,
    ),
    "stream_chunks": _with("SELECT doc_id, chunk_index, chunk FROM chunks", _PREPARE),
    "stream_failures": _with(
        """SELECT endpoint_id, failures, first_ts, last_ts, level, (island = successes)::INTEGER AS open
        FROM streaks""",
        _STREAKS,
    ),
}

ORACLE["chunk_sections_asof"] = ORACLE["chunk_sections"].replace("SELECT filled.doc_id, chunk_index,", "SELECT filled.doc_id, chunk_index, filled.page_no,", 1)
ORACLE["prediction_metrics_states"] = ORACLE["prediction_metrics"]
ORACLE["feedback_metrics_states"] = ORACLE["feedback_metrics"]
ORACLE["request_latency"] = "SELECT event_id, round(floor(value * 1000000) / 1000000, 6) AS latency FROM events"
ORACLE["read_log"] = _with(
    f"SELECT event_id, {_ts('ts')} AS ts, endpoint_id, status, round(latency, 6) AS latency FROM log WHERE ts BETWEEN {START} AND {END}", _LOG
)
ORACLE["distinct_inputs"] = _with(
    """SELECT u.splits, count(*) AS rows, count(DISTINCT input_text) AS distinct_inputs, 1::INTEGER AS within_error
    FROM splits JOIN (SELECT unnest(['train', 'val', 'test', 'train+val', 'train+test', 'val+test', 'train+val+test']) AS splits) u
      ON list_contains(string_split(u.splits, '+'), splits.split) GROUP BY u.splits""",
    _PREPARE,
)
ORACLE["quality_report_parsed"] = ORACLE["quality_report_rows"]
