"""JSON lines and JSON documents, read with fixed schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkprep.operators.metrics import read_names

EXAMPLE = "input_text string, output_text string"
EVALUATION = (
    "id string, input string, output string, input_text string, output_text string, "
    "prediction string, label string, model string"
)
_CORRUPT = "_corrupt_record"


def parse_lines(lines: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Parse a JSON object per line; ``_corrupt_record`` keeps a line that is none."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    kept = [c for c in lines.columns if c != value]
    parsed = F.from_json(value, f"{schema}, {_CORRUPT} string", options)
    return lines.select(*kept, parsed.alias("_row")).select(*kept, "_row.*")


def parse_examples(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(rows with both fields, rejected lines)."""
    blank = F.length(F.trim(value)) == 0
    parsed = parse_lines(lines.filter(~blank), EXAMPLE, value)
    complete = (
        F.col(_CORRUPT).isNull()
        & F.col("input_text").isNotNull()
        & F.col("output_text").isNotNull()
    )
    return parsed.filter(complete).drop(_CORRUPT), parsed.filter(~complete)


def read_examples(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(examples, rejected lines) of JSON-lines files; a missing path raises."""
    return parse_examples(spark.read.text(path))


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """Examples below ``split=…`` directories; a split that is absent has no rows."""
    return parse_examples(spark.read.option("basePath", path).text(path))[0]


def read_evaluation(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation rows; training rows are accepted and renamed."""
    return evaluation_rows(spark.read.text(path))


def evaluation_rows(lines: DataFrame) -> DataFrame:
    parsed = parse_lines(lines, EVALUATION).filter(F.col(_CORRUPT).isNull())
    named = parsed.withColumns(
        {
            "input": F.coalesce("input", "input_text"),
            "output": F.coalesce("output", "output_text"),
        }
    ).drop("input_text", "output_text", _CORRUPT)
    return read_names(named).filter(F.col("input").isNotNull() & F.col("output").isNotNull())


def question_list(document: Column) -> Column:
    """Questions of a JSON array, or of the field ``questions`` of a JSON object."""
    return F.coalesce(
        F.from_json(document, "array<string>"),
        F.from_json(document, "struct<questions:array<string>>")["questions"],
    )


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """``question`` rows of one or more question files."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(question_list(F.col("value"))).alias("question"))


TRAINER_STATE = "struct<best_metric:double,log_history:array<struct<step:int,eval_loss:double>>>"


def parse_trainer_state(states: DataFrame, value: str = "value") -> DataFrame:
    """Parse a trainer-state document per row into ``best_metric, log_history``."""
    kept = [c for c in states.columns if c != value]
    return states.select(*kept, F.from_json(value, TRAINER_STATE).alias("s")).select(*kept, "s.*")


def read_trainer_states(spark: SparkSession, path: str) -> DataFrame:
    """``trial, best_metric, log_history`` of ``trial_<n>/…/trainer_state.json`` files."""
    whole = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "trainer_state.json")
        .text(path, wholetext=True)
    )
    trial = F.regexp_extract("_metadata.file_path", r"trial_(\d+)/", 1).try_cast("bigint")
    return parse_trainer_state(whole.select(trial.alias("trial"), "value"))
