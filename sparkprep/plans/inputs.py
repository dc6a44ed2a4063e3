"""Inputs of the registered queries, derived from the shared tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkprep.functions.chunks import chunk_text
from sparkprep.functions.hashing import pick, row_key
from sparkprep.operators.chunking import chunk_documents
from sparkprep.operators.examples import example_lists, sample_chunk_lists
from sparkprep.operators.monitoring import prediction_log
from sparkprep.operators.structure import pages_of
from sparkprep.plans.staging import is_folder, stage, table

# The documents have no blank lines; a line is a paragraph, and a page where pages matter.
SEPARATOR = "\n"
SHORT_LINE = r"^[^\n]{1,60}$"
MODELS = ["baseline", "tuned"]
CRITERIA = ["relevance", "accuracy", "fluency"]


class Inputs:
    """The derived tables of one data directory. All are lazy."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark, self.data_dir = spark, data_dir
        self._turns: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.data_dir, name)

    def documents(self) -> DataFrame:
        return self.table("documents").select("doc_id", "text")

    def chunk_list(self) -> Column:
        return chunk_text(F.col("text"), separator=SEPARATOR)

    def paged(self) -> DataFrame:
        docs = self.table("documents").select("doc_id", "lang", "source", "text")
        return docs.withColumn("pages", pages_of(F.col("text")))

    def sampled(self) -> DataFrame:
        return sample_chunk_lists(self.documents(), self.chunk_list())

    def chunked(self) -> DataFrame:
        """All chunks with the keys that sampling and templates go by."""
        chunks = chunk_documents(self.documents(), separator=SEPARATOR)
        return chunks.withColumn("sample_key", row_key("doc_id", "chunk_index"))

    def examples(self) -> DataFrame:
        """All sampled examples, the invalid ones too."""
        return example_lists(self.documents(), self.chunk_list())

    def files(self) -> DataFrame:
        """Each document as a file: ``path, length, content``."""
        text, source = (F.coalesce(c, F.lit(other)).alias(c) for c, other in (("text", ""), ("source", "none")))
        docs = self.table("documents").select("doc_id", source, text)
        content = F.encode("text", "UTF-8")
        path = F.concat(F.lit("/corpus/"), "source", F.lit("/"), "doc_id", F.lit(".pdf"))
        return docs.select(
            path.alias("path"), F.octet_length("text").alias("length"), content.alias("content")
        )

    def turns(self) -> DataFrame:
        """A user turn (``input``) and the assistant turn right after it (``output``)."""
        if self._turns is not None:
            return self._turns
        turns = self.table("conversations")
        user = turns.filter(F.col("role") == "user").select(
            "conv_id", "turn", F.col("text").alias("input")
        )
        answer = turns.filter(F.col("role") == "assistant").select(
            "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
        )
        keys = ["conv_id", "turn"]
        pairs = user.join(answer, keys)
        return pairs.select(F.concat_ws("-", "conv_id", "turn").alias("id"), "input", "output")

    def hold_turns(self) -> None:
        """Write the turns once, for a query that reads them several times."""
        self._turns = stage(self.turns(), "turns")

    def outputs(self) -> DataFrame:
        """Turns with the outputs of two models: half of the words, and nine words in ten."""
        words = F.split("output", " ")
        half = F.slice(words, F.lit(1), F.floor((F.size(words) + 1) / 2).cast("int"))
        most = F.filter(words, lambda w, i: (i + 1) % 10 != 0)
        return self.turns().select(
            "*",
            F.array_join(half, " ").alias("baseline"),
            F.array_join(most, " ").alias("tuned"),
        )

    def predictions(self) -> DataFrame:
        """``id, input, output, model, prediction``: a row per turn and model."""
        return self.outputs().unpivot(["id", "input", "output"], MODELS, "model", "prediction")

    def qa_rows(self) -> DataFrame:
        """Turns with a prediction that is equal, contained or cut, by hash."""
        rows = self.outputs().withColumn("n", pick(row_key("id", F.lit("qa")), 3))
        padded = F.concat(F.lit("  "), "output", F.lit("\n"))
        prediction = F.when(F.col("n") == 0, padded).when(F.col("n") == 1, F.col("baseline"))
        return rows.select("id", "input", "output", prediction.otherwise(F.col("tuned")).alias("prediction"))

    def class_rows(self) -> DataFrame:
        """The quality label of a document against a guess from its length."""
        labels = self.table("labels").select("doc_id", F.col("quality").cast("string").alias("label"))
        docs = self.table("documents").select("doc_id", "n_chars")
        guess = F.when(F.col("n_chars") >= 500, "1").otherwise("0")
        return labels.join(docs, "doc_id").select(
            "doc_id",
            F.col("label").alias("output"),
            "label",
            guess.alias("prediction"),
        )

    def evaluations(self) -> DataFrame:
        """One human evaluation per turn; ratings and choices come from hashes.

        A rating can be missing or 6, a choice missing or not on offer.
        """

        def rated(model: str, name: str) -> Column:
            value = pick(row_key("id", F.lit(model), F.lit(name), F.lit("rating")), 7)
            return F.when(value > 0, value.cast("double"))

        def scores(model: str) -> Column:
            pairs = [c for name in CRITERIA for c in (F.lit(name), rated(model, name))]
            return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())

        choice = F.get(F.array(*map(F.lit, [*MODELS, "neither"])), pick(row_key("id", F.lit("choice")), 4))
        return self.turns().select(
            F.col("id").alias("evaluation_id"),
            F.col("id").alias("task_id"),
            F.create_map(*(c for m in MODELS for c in (F.lit(m), scores(m)))).alias("ratings"),
            choice.alias("preference"),
        )

    def events(self) -> DataFrame:
        return self.table("events")

    def log(self, events: DataFrame | None = None) -> DataFrame:
        """Events as served requests, with a ``usage`` column for the alerts."""
        events = self.events() if events is None else events
        error = F.when(F.col("event_type") == "error", "failed request")
        return prediction_log(
            events,
            event_id=F.col("event_id"),
            ts=F.col("ts").cast("timestamp"),
            model_id=F.concat(F.lit("m"), (F.col("user_id") % 2).cast("string")),
            endpoint_id=F.concat(F.lit("ep"), (F.col("user_id") % 5).cast("string")),
            latency=F.col("value"),
            error=error,
            request=F.col("props"),
            response=F.col("event_type"),
        ).withColumn("usage", F.get_json_object("request", "$.k").cast("double") / 100)

    def feedback(self, events: DataFrame | None = None) -> DataFrame:
        """Views and purchases as feedback; a purchase has a score."""
        events = self.events() if events is None else events
        return events.filter(F.col("event_type").isin("view", "purchase")).select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            F.concat(F.lit("m"), (F.col("user_id") % 2).cast("string")).alias("model_id"),
            F.concat(F.lit("ep"), (F.col("user_id") % 5).cast("string")).alias("endpoint_id"),
            F.when(F.col("event_type") == "purchase", F.col("value")).alias("score"),
        )

    def trainer_states(self) -> DataFrame:
        """A trainer-state document per event; sign-ups have no history."""
        entry = F.struct(F.col("event_id").cast("int").alias("step"), F.col("value").alias("eval_loss"))
        history = F.when(F.col("event_type") != "signup", F.array(entry))
        best = F.when(F.col("user_id") % 10 == 0, F.col("value") + 1)
        return self.events().select(
            F.col("user_id").alias("trial"),
            F.to_json(F.struct(best.alias("best_metric"), history.alias("log_history"))).alias("value"),
        )

    def stream(self, name: str) -> DataFrame:
        """A table as a stream of files, whether it is one file or a folder of part files."""
        path = f"{self.data_dir}/{name}.parquet"
        reader = self.spark.readStream.schema(self.table(name).schema)
        if is_folder(self.spark, path):
            return reader.parquet(path)
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(self.data_dir)  # streams read folders
