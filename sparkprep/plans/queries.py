"""The registered queries: name -> function of (spark, data_dir)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkprep.functions import text as T
from sparkprep.functions.chunks import paragraphs
from sparkprep.functions.overlap import cosine
from sparkprep.functions.hashing import pick, row_key
from sparkprep.functions.stats import MEASURES, basic_stats, round_doubles
from sparkprep.operators import chunking, comparison, dataset, examples, metrics, monitoring
from sparkprep.operators import quality, review, scoring, sketches, splitting, states, structure, trials, versions
from sparkprep.plans.inputs import MODELS, SEPARATOR, SHORT_LINE, Inputs
from sparkprep.plans.prepare import prepare_lengths, prepare_training_data, training_examples
from sparkprep.plans.staging import stage, staging_path
from sparkprep.sources import files, jsonl, logs, publish, sinks
from sparkprep.streaming import chunks as chunk_streams, late, monitor

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
IDENTITY = ["doc_id", "chunk_index"]
START, END = "2024-01-05 00:00:00", "2024-01-20 00:00:00"


def query(define: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register ``define`` under its name, less a leading underscore."""

    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return round_doubles(define(Inputs(spark, data_dir)))

    QUERIES[define.__name__.removeprefix("_")] = run
    return define


def stamp(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


# Sources and sinks


@query
def published_files(i: Inputs) -> DataFrame:
    """Documents written as files, published to another place, and scanned there."""
    first, second = staging_path(i.spark, "files"), staging_path(i.spark, "published")
    sinks.write_files(i.files(), first)
    publish.publish_files(i.spark, first, second, "*.pdf", recursive=True)
    found = files.scan_files(i.spark, second, "*.pdf", recursive=True, empty=True)
    return found.select(F.regexp_extract("path", "/corpus/.*", 0).alias("path"), "length", F.md5("content").alias("content_md5"))


@query
def publish_manifest(i: Inputs) -> DataFrame:
    """What the manifest says of the files that were published."""
    first, second = staging_path(i.spark, "files"), staging_path(i.spark, "published")
    sinks.write_files(i.files(), first)
    publish.publish_files(i.spark, first, second, "*.pdf", recursive=True)
    return publish.published(i.spark, second).select(F.concat(F.lit("/"), "path").alias("path"), "length", "md5")


@query
def chunk_table(i: Inputs) -> DataFrame:
    path = staging_path(i.spark, "chunks")
    sinks.write_chunks(chunking.chunk_documents(i.documents(), separator=SEPARATOR), path)
    return i.spark.read.parquet(path)


@query
def structure_table(i: Inputs) -> DataFrame:
    """Metadata and headings of each document, read back from the JSON that was written."""
    path = staging_path(i.spark, "structures")
    described = i.paged().select("doc_id", F.col("source").alias("author"), "pages")
    sinks.write_structure(structure.document_structure(described, SHORT_LINE), path)
    read = lambda field: F.get_json_object("structure", f"$.{field}")
    return i.spark.read.parquet(path).select(
        "doc_id",
        read("metadata.author").alias("author"),
        read("metadata.pages").cast("int").alias("pages"),
        F.json_array_length(read("toc")).alias("headings"),
        F.json_array_length(read("sections")).alias("sections"),
    )


@query
def evaluation_output(i: Inputs) -> DataFrame:
    """Metrics and the number of predictions, read back from what was written."""
    path = staging_path(i.spark, "evaluation")
    sinks.write_evaluation(comparison.model_metrics(i.predictions()), i.predictions(), path)
    rows = i.spark.read.json(f"{path}/predictions").groupBy("model").agg(F.count("*").cast("double").alias("value"))
    read = i.spark.read.json(f"{path}/metrics").select("model", "metric", "value")
    return read.unionByName(rows.withColumn("metric", F.lit("rows")))


@query
def assemble_pages(i: Inputs) -> DataFrame:
    return i.paged().select("doc_id", structure.assemble_pages(F.col("pages")).alias("text"))


@query
def doc_metadata(i: Inputs) -> DataFrame:
    described = i.paged().select(
        "doc_id", F.col("source").alias("author"), F.nullif("lang", F.lit("en")).alias("subject"), "pages"
    )
    return structure.normalize_metadata(described)


@query
def file_metadata(i: Inputs) -> DataFrame:
    pages = i.files().select(
        "path", F.size(F.split(F.decode("content", "UTF-8"), "\n")).alias("page_count")
    )
    return files.file_metadata(i.files(), pages)


@query
def entity_spans(i: Inputs) -> DataFrame:
    """Both halves of each text as spans."""
    half, end = F.floor(F.length("text") / 2).cast("int"), F.length("text")

    def span(kind: Column, start: Column, stop: Column, confidence: float) -> Column:
        parts = {"type": kind, "start_index": start, "end_index": stop, "confidence": F.lit(confidence)}
        return F.struct(*(v.alias(n) for n, v in parts.items()))

    spans = F.array(span(F.col("lang"), F.lit(0), half, 0.9), span(F.col("source"), half, end, 0.5))
    found = structure.entity_spans(F.col("text"), spans)
    return i.table("documents").select("doc_id", F.inline(found))


@query
def load_chunks(i: Inputs) -> DataFrame:
    lines = i.documents().select("doc_id", F.posexplode(F.split("text", "\n")).alias("chunk_index", "chunk"))
    return chunking.clean_chunks(lines)


def _example_lines(i: Inputs) -> DataFrame:
    """A good JSON line for each document, and one that is broken, incomplete or no object."""
    whole, case = F.col("text"), F.col("doc_id") % 3
    good = F.to_json(F.struct(F.concat(F.lit("About: "), whole).alias("input_text"), whole.alias("output_text")))
    bad = (
        F.when(case == 0, F.concat(F.lit("{broken"), whole))
        .when(case == 1, F.to_json(F.struct(whole.alias("input_text"))))
        .otherwise(F.to_json(F.array(F.struct(whole.alias("input_text")))))
    )
    return i.documents().select("doc_id", F.explode(F.array(good, bad)).alias("value"))


@query
def read_examples(i: Inputs) -> DataFrame:
    return jsonl.parse_examples(_example_lines(i))[0]


@query
def rejected_lines(i: Inputs) -> DataFrame:
    return jsonl.parse_examples(_example_lines(i))[1].select(
        "doc_id", F.col("_corrupt_record").isNotNull().cast("int").alias("unreadable")
    )


def _prepared(i: Inputs) -> DataFrame:
    return prepare_training_data(i.documents(), separator=SEPARATOR)


def _measured(i: Inputs) -> DataFrame:
    return prepare_lengths(i.documents(), separator=SEPARATOR)


@query
def read_splits(i: Inputs) -> DataFrame:
    path = staging_path(i.spark, "splits")
    sinks.write_splits(_prepared(i), path)
    return jsonl.read_splits(i.spark, path).select("split", "input_text", "output_text")


@query
def manifest(i: Inputs) -> DataFrame:
    """The rows that the files of the manifest hold, by split."""
    path = staging_path(i.spark, "manifest")
    sinks.write_splits(_prepared(i), path)
    listed = stage(sinks.manifest(i.spark, path), "manifest-files")
    lines = i.spark.read.option("recursiveFileLookup", "true").text(path).select(F.col("_metadata.file_path").alias("uri"))
    return listed.join(lines, "uri").groupBy("split").agg(F.count("*").alias("rows"))


@query
def read_eval(i: Inputs) -> DataFrame:
    training = F.to_json(F.struct("id", F.col("input").alias("input_text"), F.col("output").alias("output_text")))
    evaluation = F.to_json(F.struct("id", "input", "output"))
    lines = i.turns().select(
        F.when(F.length("id") % 2 == 0, training).otherwise(evaluation).alias("value")
    )
    return jsonl.evaluation_rows(lines).select("id", "input", "output")


@query
def read_questions(i: Inputs) -> DataFrame:
    asked = F.split("text", "\n")
    document = F.when(F.col("doc_id") % 2 == 0, F.to_json(asked)).otherwise(
        F.to_json(F.struct(asked.alias("questions")))
    )
    return i.documents().select("doc_id", F.explode(jsonl.question_list(document)).alias("question"))


@query
def file_inventory(i: Inputs) -> DataFrame:
    return files.file_inventory(i.files())


@query
def trial_history(i: Inputs) -> DataFrame:
    return trials.explode_history(jsonl.parse_trainer_state(i.trainer_states()))


@query
def render_chunks(i: Inputs) -> DataFrame:
    rendered = i.documents().select("doc_id", chunking.render_chunks(i.chunk_list()).alias("rendered"))
    return rendered.filter("rendered <> ''")


# Scalar functions


@query
def _paragraphs(i: Inputs) -> DataFrame:
    found = F.posexplode(paragraphs(F.col("text"), SEPARATOR)).alias("pos", "paragraph")
    return i.documents().select("doc_id", found)


@query
def clean_text(i: Inputs) -> DataFrame:
    return i.documents().select("doc_id", T.clean_text(F.col("text")).alias("text"))


@query
def first_sentence(i: Inputs) -> DataFrame:
    return i.chunked().select(*IDENTITY, T.first_sentence(F.col("chunk")).alias("sentence"))


@query
def strip_stopword(i: Inputs) -> DataFrame:
    subject = T.drop_leading_stopword(T.first_sentence(F.col("chunk")))
    return i.chunked().select(*IDENTITY, subject.alias("subject"))


@query
def gen_question(i: Inputs) -> DataFrame:
    asked = T.question(F.col("chunk"), F.col("sample_key"))
    return i.chunked().select(*IDENTITY, asked.alias("question"))


@query
def keywords(i: Inputs) -> DataFrame:
    return i.chunked().select(*IDENTITY, T.keywords(F.col("chunk")).alias("keywords"))


@query
def gen_instruction(i: Inputs) -> DataFrame:
    told = T.instruction(F.col("chunk"), F.col("sample_key"))
    return i.chunked().select(*IDENTITY, told.alias("instruction"))


@query
def make_examples(i: Inputs) -> DataFrame:
    return examples.make_examples(i.sampled())


@query
def validate_examples(i: Inputs) -> DataFrame:
    return i.examples().select(*IDENTITY, examples.is_valid().cast("int").alias("valid"))


@query
def valid_counts(i: Inputs) -> DataFrame:
    return examples.valid_counts(i.examples())


@query
def training_prompt(i: Inputs) -> DataFrame:
    prompt = T.training_prompt(F.col("input_text"), F.col("output_text"))
    return i.examples().select(*IDENTITY, prompt.alias("prompt"))


@query
def token_budget(i: Inputs) -> DataFrame:
    return scoring.token_budget(i.documents(), 64).select(
        "doc_id",
        F.array_join("input_ids", " ").alias("tokens"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("kept"),
        F.size("labels").alias("labels"),
    )


@query
def extract_answer(i: Inputs) -> DataFrame:
    reply = F.concat(T.qa_prompt(F.col("input")), F.lit(" "), "output", F.lit(" \n"))
    plain = F.when(F.length("id") % 2 == 0, F.col("output")).otherwise(reply)
    return i.turns().select("id", T.answer_of(plain).alias("answer"))


@query
def prediction_content(i: Inputs) -> DataFrame:
    wrapped = F.to_json(F.struct(F.col("output").alias("content")))
    given = F.when(F.length("id") % 2 == 0, wrapped).otherwise(F.col("output"))
    return i.turns().select("id", T.prediction_content(given).alias("content"))


@query
def probe_questions(i: Inputs) -> DataFrame:
    return examples.probe_questions(i.sampled())


# Chunking and structure


@query
def chunk_documents(i: Inputs) -> DataFrame:
    return chunking.chunk_documents(i.documents(), separator=SEPARATOR)


@query
def sections(i: Inputs) -> DataFrame:
    return i.paged().select("doc_id", F.inline(structure.sections(F.col("pages"), SHORT_LINE)))


@query
def toc(i: Inputs) -> DataFrame:
    titles = structure.toc(F.col("pages"), SHORT_LINE)
    return i.paged().select("doc_id", F.posexplode_outer(titles).alias("pos", "title"))


@query
def doc_structure(i: Inputs) -> DataFrame:
    described = i.paged().select("doc_id", F.col("source").alias("author"), "pages")
    built = structure.document_structure(described, SHORT_LINE)
    return built.select(
        "doc_id",
        "metadata.author",
        "metadata.pages",
        F.size("toc").alias("headings"),
        F.get("sections", F.size("sections") - 1)["start_page"].alias("last_section_start"),
    )


@query
def section_chunks(i: Inputs) -> DataFrame:
    return structure.section_chunks(i.paged(), SHORT_LINE)


@query
def chunk_sections(i: Inputs) -> DataFrame:
    return structure.chunk_sections(i.paged(), SHORT_LINE, separator=SEPARATOR)


@query
def chunk_sections_asof(i: Inputs) -> DataFrame:
    """The same from a table of chunks and a table of sections."""
    pages = i.paged()
    return structure.assign_sections(structure.chunk_pages(pages, separator=SEPARATOR), structure.section_table(pages, SHORT_LINE))


# Sampling and splits


@query
def sample_chunks(i: Inputs) -> DataFrame:
    chunks = chunking.chunk_documents(i.documents(), separator=SEPARATOR)
    return examples.sample_chunks(chunks).drop("sample_key")


@query
def split_exact(i: Inputs) -> DataFrame:
    split = splitting.split_exact(i.table("documents").select("doc_id", "source"), ["doc_id"])
    return split.select("doc_id", "split")


@query
def split_hash(i: Inputs) -> DataFrame:
    return splitting.split_hash(i.table("documents").select("doc_id"), ["doc_id"])


@query
def holdout(i: Inputs) -> DataFrame:
    without_val = splitting.split_hash(i.table("documents").select("doc_id"), ["doc_id"], 0.9, 0.0)
    return splitting.holdout(without_val, ["doc_id"])


@query
def _prepare_training_data(i: Inputs) -> DataFrame:
    return _prepared(i)


@query
def split_counts(i: Inputs) -> DataFrame:
    return splitting.split_counts(_prepared(i))


@query
def review_sample(i: Inputs) -> DataFrame:
    return examples.review_sample(i.turns(), ["id"], 50)


# Quality


@query
def length_stats(i: Inputs) -> DataFrame:
    return quality.length_stats(_measured(i))


@query
def _basic_stats(i: Inputs) -> DataFrame:
    docs = i.table("documents").select("lang", F.length("text").alias("length"))
    return docs.groupBy("lang").agg(*(c.alias(m) for m, c in basic_stats("length").items()))


@query
def length_pivot(i: Inputs) -> DataFrame:
    return quality.length_pivot(quality.length_stats(_measured(i)))


@query
def quality_metrics(i: Inputs) -> DataFrame:
    return quality.quality_metrics(quality.length_stats(_measured(i)))


@query
def quality_ratings(i: Inputs) -> DataFrame:
    measured = quality.quality_metrics(quality.length_stats(_measured(i)))
    return quality.quality_ratings(measured)


@query
def quality_report(i: Inputs) -> DataFrame:
    return quality.quality_report(_measured(i))


@query
def quality_report_parsed(i: Inputs) -> DataFrame:
    """The report's JSON document, read back as rows."""
    measures = ", ".join(f"{m} double" for m in MEASURES)
    names = list(quality.RATING_THRESHOLDS)
    schema = f"stats array<struct<split string, field string, {measures}>>, metrics struct<{', '.join(f'{n}: double' for n in names)}>"
    report = stage(quality.quality_report(_measured(i)), "report").select(F.from_json("report", schema).alias("r"))
    lengths = report.select(F.inline("r.stats")).withColumn("name", F.concat_ws("/", "split", "field")).withColumn("section", F.lit("stats"))
    lengths = lengths.unpivot(["section", "name"], list(MEASURES), "measure", "value")
    metrics = report.select(F.lit("metrics").alias("section"), "r.metrics.*").unpivot("section", names, "name", "value")
    return lengths.unionByName(metrics.withColumn("measure", F.lit("value")))


@query
def quality_report_rows(i: Inputs) -> DataFrame:
    return quality.quality_report_rows(stage(quality.length_stats(_measured(i)), "length-stats"))


@query
def dataset_summary(i: Inputs) -> DataFrame:
    return quality.dataset_summary(_measured(i))


# Metrics


@query
def rouge_n(i: Inputs) -> DataFrame:
    return metrics.rouge_scores(i.predictions(), longest=False).select("id", "model", "rouge1", "rouge2")


@query
def rouge_l(i: Inputs) -> DataFrame:
    return metrics.rouge_scores(i.predictions()).select("id", "model", "rougeL")


@query
def bleu(i: Inputs) -> DataFrame:
    return metrics.bleu(i.predictions(), ["model"])


@query
def confusion_matrix(i: Inputs) -> DataFrame:
    return metrics.confusion_matrix(i.class_rows())


@query
def class_scores(i: Inputs) -> DataFrame:
    return metrics.class_scores(metrics.confusion_matrix(i.class_rows()))


@query
def classification_metrics(i: Inputs) -> DataFrame:
    return metrics.classification_metrics(i.class_rows())


@query
def qa_metrics(i: Inputs) -> DataFrame:
    return metrics.qa_metrics(i.qa_rows())


@query
def task_metrics(i: Inputs) -> DataFrame:
    return metrics.task_metrics(i.qa_rows(), task_type="qa")


@query
def embedding_similarity(i: Inputs) -> DataFrame:
    left = i.table("embeddings").select("vec_id", F.col("embedding").alias("a"))
    right = i.table("embeddings").select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return left.join(right, "vec_id").select("vec_id", cosine(F.col("a"), F.col("b")).alias("similarity"))


# Comparison and human evaluation


@query
def model_metrics(i: Inputs) -> DataFrame:
    return comparison.model_metrics(i.predictions())


@query
def improvement(i: Inputs) -> DataFrame:
    measured = comparison.model_metrics(i.predictions())
    sides = [measured.filter(F.col("model") == m).select("metric", "value") for m in MODELS]
    return comparison.improvement(*sides)


@query
def comparison_table(i: Inputs) -> DataFrame:
    return comparison.comparison_table(comparison.model_metrics(i.predictions()), *MODELS)


@query
def compare_outputs(i: Inputs) -> DataFrame:
    return comparison.compare_outputs(i.outputs().withColumnRenamed("output", "reference"))


@query
def compare_aligned_outputs(i: Inputs) -> DataFrame:
    wide = i.outputs()
    sides = [wide.select("id", F.col(c).alias("text")) for c in ("baseline", "tuned", "output")]
    return comparison.align_outputs(*sides)


@query
def review_tasks(i: Inputs) -> DataFrame:
    tasks = review.review_tasks(i.turns(), i.predictions(), MODELS)
    return tasks.select(
        "task_id",
        "input_text",
        "reference_output",
        *(F.col("model_outputs")[m].alias(m) for m in MODELS),
        F.size("more_outputs").alias("more_outputs"),
        F.array_join(F.transform("evaluation_criteria", lambda c: c["name"]), ",").alias("criteria"),
    )


@query
def ratings_long(i: Inputs) -> DataFrame:
    return review.explode_ratings(i.evaluations()).drop("task_id")


@query
def rating_stats(i: Inputs) -> DataFrame:
    return review.rating_stats(review.explode_ratings(i.evaluations()))


@query
def rating_overall(i: Inputs) -> DataFrame:
    return review.rating_overall(review.rating_stats(review.explode_ratings(i.evaluations())))


@query
def preferences(i: Inputs) -> DataFrame:
    return review.preferences(i.evaluations())


@query
def rating_violations(i: Inputs) -> DataFrame:
    i.hold_turns()
    tasks = review.review_tasks(i.turns(), i.predictions(), MODELS)
    return review.rating_violations(i.evaluations(), tasks)


@query
def evaluation_summary(i: Inputs) -> DataFrame:
    """The summary of each model."""
    measured = stage(comparison.model_metrics(i.predictions()), "metrics")
    overall = stage(review.rating_overall(review.rating_stats(review.explode_ratings(i.evaluations()))), "overall")
    table = stage(comparison.comparison_table(measured, *MODELS), "comparison")
    summaries = [
        comparison.evaluation_summary(
            i.predictions().filter(F.col("model") == m), measured.filter(F.col("model") == m).select("metric", "value"), table, overall
        ).withColumn("summary_of", F.lit(m))
        for m in MODELS
    ]
    return summaries[0].unionByName(summaries[1])


@query
def example_predictions(i: Inputs) -> DataFrame:
    shown = [comparison.example_predictions(i.predictions().filter(F.col("model") == m), 5) for m in MODELS]
    return shown[0].unionByName(shown[1])


@query
def answers_by_model(i: Inputs) -> DataFrame:
    answers = i.predictions().select("id", F.col("input").alias("question"), "model", F.col("prediction").alias("answer"))
    return comparison.answers_by_model(answers, MODELS)


# The training set as a whole


@query
def duplicate_inputs(i: Inputs) -> DataFrame:
    return dataset.duplicate_inputs(_prepared(i))


@query
def coverage(i: Inputs) -> DataFrame:
    return dataset.coverage(i.documents(), _prepared(i))


@query
def diversity(i: Inputs) -> DataFrame:
    first_word = F.get(T.words(F.col("input_text")), 0).alias("template")
    return dataset.diversity(_prepared(i).select("input_text", first_word))


@query
def distinct_inputs(i: Inputs) -> DataFrame:
    """The exact number of different inputs of each union of splits, and whether the merged sketches come within their error."""
    rows = _prepared(i).select("split", "input_text")
    unions = [["train"], ["val"], ["test"], ["train", "val"], ["train", "test"], ["val", "test"], ["train", "val", "test"]]
    names = F.explode(F.array(*(F.struct(F.lit("+".join(u)).alias("splits"), F.array(*map(F.lit, u)).alias("of")) for u in unions)))
    pairs = i.spark.range(1).select(names.alias("u")).select("u.*").select("splits", F.explode("of").alias("split"))
    stored = stage(sketches.distinct_sketches(rows, ["split"]), "sketches")
    estimates = sketches.merged_counts(stored.join(F.broadcast(pairs), "split"), ["splits"])
    exact = rows.join(F.broadcast(pairs), "split").groupBy("splits").agg(F.count_distinct("input_text").alias("distinct_inputs"))
    near = F.abs(F.col("estimate") - F.col("distinct_inputs")) <= sketches.ERROR * F.col("distinct_inputs") + 1
    return exact.join(estimates, "splits").select("splits", "rows", "distinct_inputs", near.cast("int").alias("within_error"))


@query
def relevance(i: Inputs) -> DataFrame:
    return dataset.relevance(_prepared(i)).select(*IDENTITY, "relevance")


@query
def version_diff(i: Inputs) -> DataFrame:
    """From all sampled examples to the valid ones."""
    return dataset.version_diff(i.examples(), _prepared(i))


VERSIONS = {0: [1], 1: [1, 2], 2: [1, 2, 3, 4], 3: [3, 4], 4: [1, 3], 5: [1, 2, 3, 4]}


def _history(i: Inputs) -> str:
    """Four versions of the examples, added to a history one after the other: rows come, go, return and change."""
    history = staging_path(i.spark, "history")
    group = pick(row_key(*IDENTITY, F.lit("version")), len(VERSIONS))
    rows = stage(i.examples().withColumn("group", group), "versioned-examples")
    for version in (1, 2, 3, 4):
        there = rows.filter(F.col("group").isin([g for g, versions in VERSIONS.items() if version in versions]))
        edited = F.when((F.col("group") == 5) & F.lit(version >= 3), F.concat("input_text", F.lit("!"))).otherwise(F.col("input_text"))
        versions.extend(history, there.withColumn("input_text", edited), version, version - 1 or None)
    return history


@query
def version_history(i: Inputs) -> DataFrame:
    """Each content as runs of versions."""
    return versions.runs(i.spark, _history(i))


@query
def version_states(i: Inputs) -> DataFrame:
    """The contents of each version, from the history."""
    history = _history(i)
    states = [versions.state_at(i.spark, history, v).withColumn("version", F.lit(v)) for v in (1, 2, 3, 4)]
    return reduce(DataFrame.unionByName, states)


@query
def version_changes(i: Inputs) -> DataFrame:
    return versions.changes(i.spark, _history(i))


# Monitoring


@query
def prediction_log(i: Inputs) -> DataFrame:
    log = i.log()
    return log.select(*(stamp(c) if c == "ts" else c for c in log.columns))


@query
def metric_points(i: Inputs) -> DataFrame:
    points = monitoring.metric_points(i.log()).unionByName(monitoring.feedback_points(i.feedback()))
    return points.select(stamp("ts"), "metric", "endpoint_id", "status", "value_int", "value_double")


@query
def typed_points(i: Inputs) -> DataFrame:
    values = {"failed": F.col("status") == "error", "request_length": F.length("request"), "usage": F.col("usage")}
    points = monitoring.value_points(i.log(), values)
    return points.select(stamp("ts"), "metric", "endpoint_id", F.col("value_bool").cast("int").alias("value_bool"), "value_int", "value_double")


@query
def prediction_metrics(i: Inputs) -> DataFrame:
    return monitoring.prediction_metrics(i.log(), START, END)


@query
def feedback_metrics(i: Inputs) -> DataFrame:
    return monitoring.feedback_metrics(i.feedback(), START, END)


@query
def prediction_metrics_states(i: Inputs) -> DataFrame:
    """The same from states per day, written in two batches."""
    path, log = staging_path(i.spark, "prediction-states"), i.log()
    for batch in (0, 1):
        states.write_states(log.filter(F.col("event_id") % 2 == batch), "latency", path, batch)
    return states.metrics_from_states(i.spark, path, "prediction", START, END)


@query
def feedback_metrics_states(i: Inputs) -> DataFrame:
    path = staging_path(i.spark, "feedback-states")
    states.write_states(i.feedback(), "score", path)
    return states.metrics_from_states(i.spark, path, "feedback", START, END)


@query
def request_latency(i: Inputs) -> DataFrame:
    """The time between the start and the end of each request."""
    start = F.col("ts").cast("timestamp")
    end = F.timestamp_micros(F.unix_micros(start) + F.floor(F.col("value") * 1_000_000))
    return i.events().select("event_id", monitoring.latency_seconds(start, end).alias("latency"))


@query
def read_log(i: Inputs) -> DataFrame:
    """A range of a log table that was appended to twice and compacted once."""
    path, log = staging_path(i.spark, "log"), i.log().select("event_id", "ts", "endpoint_id", "status", "latency")
    logs.append_log(log.filter("event_id % 3 = 0").repartition(4), path)
    logs.append_log(log.filter("event_id % 3 = 1").repartition(4), path)
    logs.compact_log(i.spark, path)
    logs.append_log(log.filter("event_id % 3 = 2"), path)
    return _stamped(logs.read_log(i.spark, path, "event_id bigint, ts timestamp, endpoint_id string, status string, latency double", START, END))


@query
def time_range(i: Inputs) -> DataFrame:
    chosen = monitoring.between(i.log(), START, END, inclusive_end=False)
    return chosen.select("event_id", stamp("ts"))


@query
def recent_entries(i: Inputs) -> DataFrame:
    return monitoring.recent(i.log(), 720).select("event_id", stamp("ts"))


@query
def prediction_logs(i: Inputs) -> DataFrame:
    found = monitoring.prediction_logs(i.log(), "m1", "ep3", START, END, 100)
    return found.select("event_id", stamp("ts"), "severity", "latency")


@query
def metrics_by_status(i: Inputs) -> DataFrame:
    return monitoring.metrics_by_status(i.log())


@query
def flatten_predictions(i: Inputs) -> DataFrame:
    words = F.split("text", "\n")
    batches = i.documents().select(
        "doc_id",
        words.alias("inputs"),
        F.transform(words, lambda w: F.length(w)).alias("predictions"),
    )
    return monitoring.flatten_predictions(batches)


@query
def alerts(i: Inputs) -> DataFrame:
    found = monitoring.alerts(i.log(), "1 day")
    return found.select(*(stamp(c) if c == "window_start" else c for c in found.columns))


@query
def failure_streaks(i: Inputs) -> DataFrame:
    found = monitoring.failure_streaks(i.log())
    return found.select("endpoint_id", stamp("first_ts"), stamp("last_ts"), "failures", "level")


@query
def run_rates(i: Inputs) -> DataFrame:
    runs = i.log().select(
        F.col("endpoint_id").alias("step"),
        (F.col("status") == "success").alias("succeeded"),
        F.col("latency").alias("run_time"),
    )
    return monitoring.run_rates(runs)


# Trials


def _trial_metrics(i: Inputs) -> DataFrame:
    return trials.trial_metric(trials.explode_history(jsonl.parse_trainer_state(i.trainer_states())))


@query
def trial_metric(i: Inputs) -> DataFrame:
    return _trial_metrics(i)


@query
def best_trial(i: Inputs) -> DataFrame:
    return trials.best_trial(_trial_metrics(i))


@query
def trial_running_best(i: Inputs) -> DataFrame:
    return trials.running_best(_trial_metrics(i))


@query
def trial_params(i: Inputs) -> DataFrame:
    user = F.col("user_id")
    params = F.struct(
        ((user % 5 + 1) / 100).alias("learning_rate"),
        ((user % 4 + 1) * 4).alias("batch_size"),
        ((user % 3 + 1) * 8).alias("lora_r"),
    )
    settings = i.events().select(user.alias("trial"), params.alias("params")).distinct()
    return trials.trial_params(_trial_metrics(i), settings)


@query
def training_schedule(i: Inputs) -> DataFrame:
    configs = [
        {"batch_size": b, "accumulation": 4, "epochs": 3, "warmup_ratio": 0.1} for b in (2, 4, 8)
    ]
    return trials.training_schedule(training_examples(i.documents(), separator=SEPARATOR), configs)


# Streams: each runs over what the table holds and returns what has been emitted


def _emitted(i: Inputs, result: DataFrame, label: str) -> DataFrame:
    path, checkpoint = staging_path(i.spark, label), staging_path(i.spark, f"{label}-progress")
    monitor.run_available(result, path, checkpoint)
    return i.spark.read.schema(result.schema).parquet(path)


def _stamped(df: DataFrame) -> DataFrame:
    return df.select(*(stamp(c) if t == "timestamp" else c for c, t in df.dtypes))


def _windows(i: Inputs, result: DataFrame, keys: list[str], entries: DataFrame, label: str) -> DataFrame:
    """All windows; ``final`` are those that end before the watermark."""
    found = monitor.run_windows(result, keys, staging_path(i.spark, label), staging_path(i.spark, f"{label}-progress"))
    bound = entries.agg(F.max("ts") - F.expr("INTERVAL 10 MINUTES")).scalar()
    return _stamped(found.withColumn("final", (F.col("window_end") <= bound).cast("int")))


@query
def stream_metrics(i: Inputs) -> DataFrame:
    result = monitor.windowed_metrics(i.log(i.stream("events")))
    return _windows(i, result, ["window_start", "window_end", "endpoint_id", "status"], i.log(), "metrics")


@query
def stream_error_alerts(i: Inputs) -> DataFrame:
    result = monitor.error_rate_alerts(i.log(i.stream("events")))
    return _windows(i, result, ["window_start", "window_end", "endpoint_id"], i.log(), "alerts")


@query
def stream_feedback(i: Inputs) -> DataFrame:
    result = monitor.feedback_windows(i.feedback(i.stream("events")))
    return _windows(i, result, ["window_start", "window_end"], i.feedback(), "feedback")


@query
def stream_chunks(i: Inputs) -> DataFrame:
    arriving = i.stream("documents").select("doc_id", "text")
    return _emitted(i, chunk_streams.chunk_stream(arriving, separator=SEPARATOR), "chunks")


@query
def stream_failures(i: Inputs) -> DataFrame:
    streaks, state, progress = (staging_path(i.spark, n) for n in ("streaks", "open", "streak-progress"))
    monitor.track_failures(i.log(i.stream("events")), streaks, state, progress).awaitTermination()
    found = monitor.all_failures(i.spark, streaks, state)
    return _stamped(found.withColumn("open", F.col("open").cast("int")))


ARRIVALS = 5


def _late(i: Inputs) -> str:
    """A log of which one row in twenty arrives six days late, delivered in five parts, each read when it has arrived."""
    incoming, path, progress = (staging_path(i.spark, n) for n in ("arriving", "late-windows", "late-progress"))
    log = i.log()
    delayed = pick(row_key("event_id", F.lit("late")), 20) == 0
    arrival = F.col("ts") + F.when(delayed, F.expr("INTERVAL 6 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    ends = log.agg(F.unix_micros(F.min("ts")).alias("a"), F.unix_micros(F.max("ts") + F.expr("INTERVAL 6 DAYS")).alias("b")).first()
    a, b = ends["a"] or 0, ends["b"] or 1
    part = F.least(F.floor(ARRIVALS * (F.unix_micros(arrival) - a) / F.lit(b - a)), F.lit(ARRIVALS - 1))
    rows = stage(log.select(*late.ENTRY, part.alias("part")), "arrivals")
    for number in range(ARRIVALS):
        rows.filter(F.col("part") == number).drop("part").write.mode("append").parquet(incoming)
        arrived = i.spark.readStream.schema(rows.drop("part").schema).parquet(incoming)
        late.track_windows(arrived, path, progress, delay="2 days").awaitTermination()
    return path


@query
def stream_late_rows(i: Inputs) -> DataFrame:
    """The rows that came after their window was closed."""
    return _stamped(late.late_rows(i.spark, _late(i)))


@query
def stream_kept_and_late(i: Inputs) -> DataFrame:
    """All windows: what was counted in time, and how many rows came too late."""
    return _stamped(late.window_totals(i.spark, _late(i)).drop("mean"))


@query
def stream_progress(i: Inputs) -> DataFrame:
    return _stamped(late.progress(i.spark, _late(i)))
