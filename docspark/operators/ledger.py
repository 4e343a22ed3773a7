"""Model replies kept over runs: only prompts without a reply are asked."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.operators.extract import CallSettings, call_model

SCHEMA = "prompt_key string, reply string, call_ms double, call_error string, asked_at timestamp"


def prompt_key(prompt: Column, settings: CallSettings = CallSettings(), model: str = "") -> Column:
    """SHA-256 of the prompt, the settings and the model's name: what a reply depends on."""
    said = json.dumps([model, asdict(settings)], sort_keys=True)
    return F.sha2(F.concat(F.lit(said), F.lit("\n"), prompt), 256)


@dataclass(frozen=True)
class ReplyLedger:
    """A growing Parquet table of replies at ``path``, keyed by ``prompt_key``; ``model`` keeps those of several models apart.

    A run adds its replies in one commit. A job that fails before leaves none of its calls; one that is
    repeated after it asks nothing again. Failed calls are kept as well, with their error, and asked again.
    """

    path: str
    model: str = ""

    def read(self, spark: SparkSession) -> DataFrame:
        """All calls so far; an empty table before the first."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return spark.createDataFrame([], SCHEMA)
        return spark.read.schema(SCHEMA).parquet(self.path)

    def replies(self, spark: SparkSession) -> DataFrame:
        """One row per key: its first reply, or its latest error if it has none."""
        calls = self.read(spark).groupBy("prompt_key").agg(
            F.min_by(F.struct("reply", "call_ms", "call_error"), F.struct(F.col("reply").isNull(), F.when(F.col("reply").isNotNull(), F.col("asked_at")), -F.unix_micros("asked_at"))).alias("c")
        )
        return calls.select("prompt_key", "c.*")

    def record(self, calls: DataFrame) -> None:
        """Add calls (prompt_key, reply, call_ms, call_error), stamped with the time."""
        stamped = calls.withColumn("asked_at", F.current_timestamp())
        stamped.selectExpr(*[f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in SCHEMA.split(", ")]).write.mode("append").parquet(self.path)

    def pending(self, df: DataFrame, prompt: str = "prompt", settings: CallSettings = CallSettings()) -> DataFrame:
        """Distinct (prompt_key, prompt) of ``df`` that no reply is known for; equal prompts are one call.

        The prompts to ask are found by their keys; whole prompts are reduced to one of each kind per task before they move.
        """
        known = self.read(df.sparkSession).filter(F.col("reply").isNotNull()).select("prompt_key").distinct()
        keyed = df.filter(F.col(prompt).isNotNull()).select(prompt_key(F.col(prompt), settings, self.model).alias("prompt_key"), F.col(prompt).alias("prompt"))
        return keyed.dropDuplicates(["prompt_key"]).join(known, "prompt_key", "left_anti")

    def ask(
        self,
        df: DataFrame,
        make: Callable[[], Callable[[str, CallSettings], str]],
        prompt: str = "prompt",
        keep: tuple[str, ...] = ("document_id",),
        settings: CallSettings = CallSettings(),
        tasks: int | None = None,
    ) -> DataFrame:
        """``call_model`` with a memory: asks what is pending, records it, and gives every row its reply, call time and error.

        Rows with an equal prompt share one reply. A null prompt has neither reply nor error.
        """
        self.record(call_model(self.pending(df, prompt, settings), make, "prompt", ("prompt_key",), settings, tasks))
        rows = df.select(*keep, prompt_key(F.col(prompt), settings, self.model).alias("_key"))
        replies = self.replies(df.sparkSession).withColumnRenamed("prompt_key", "_key")
        return rows.join(replies, "_key", "left").drop("_key")
