"""Readers: pipeline and dispute documents, settings, batch result files, and the driver's tables in their roles."""

from __future__ import annotations

import json
import os
import re
import tomllib
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OPTION = "struct<value:string,label:string,ic_passes:int>"
QUESTION = f"struct<question_id:bigint,key:string,version:int,version_id:bigint,label:string,help_text:string,question_type:string,allow_multiple:boolean,is_ic:boolean,options:array<{OPTION}>>"
RUN = "struct<run_id:bigint,name:string,model_name:string,model_provider:string,config:string>"
PAPER = "struct<paper_id:bigint,title:string,abstract:string,split:string>"
CANDIDATE = "struct<rater_key:string,value:string,comment:string,cited_text:string,source_answer_id:bigint>"
DISPUTE = f"struct<dispute_item_id:bigint,paper_id:bigint,paper_title:string,abstract:string,question_key:string,version_id:bigint,candidates:array<{CANDIDATE}>>"
PIPELINE = f"review_id bigint, setup_id bigint, api_base string, papers array<{PAPER}>, questions array<{QUESTION}>, runs array<{RUN}>"
DISPUTES = f"review_id bigint, dispute_set_id bigint, review_name string, dispute_set_name string, api_base string, rater_keys array<string>, runs array<{RUN}>, questions array<{QUESTION}>, disputes array<{DISPUTE}>"

#: The defaults of a run, in effect where neither settings nor the document say otherwise.
SETTINGS_VARIABLE = "INKGRID_SETTINGS"
RUN_DEFAULTS = {
    "concurrency": 8, "rpm": None, "drop_params": False, "citation_max_error_rate": 0.05, "citation_max_ellipsis_gap": 600, "text_source": "full_text", "batching": "all",
    "temperature": None, "reasoning_effort": None, "format_model": None, "format_model_provider": None, "format_temperature": None, "format_model_params": {},
    "format_structured_output": True, "model_params": {}, "cache": False, "cache_first": "questions", "cache_ttl": "1h", "system_prompt": None, "chunk_papers": 10,
    "batch_p1": False, "batch_p2": False, "fail_fast": False, "request_timeout": None,
}
ARBITER_DEFAULTS = RUN_DEFAULTS | {"cache_first": "text", "anonymize_raters": True}


def overlaid(config: str | Mapping | None, settings: Mapping | None = None, defaults: Mapping = RUN_DEFAULTS) -> dict:
    """Defaults, then settings, then what the document's config holds, nulls included: a key that's there counts."""
    given = json.loads(config) if isinstance(config, str) and config else dict(config or {})
    settings = dict(settings or {})
    if unknown := set(settings) - set(defaults):
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    return {**defaults, **settings, **{k: v for k, v in given.items() if k in defaults}}


def pipeline(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """papers (p_order), questions (q_order) and runs (r_order) of one document; unknown keys are ignored."""
    doc = spark.read.schema(PIPELINE).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return {name: _listed(doc, name, order) for name, order in (("papers", "p_order"), ("questions", "q_order"), ("runs", "r_order"))}


def disputes(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    doc = spark.read.schema(DISPUTES).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return {name: _listed(doc, name, order) for name, order in (("disputes", "d_order"), ("questions", "q_order"), ("runs", "r_order"))}


def _listed(doc: DataFrame, name: str, order: str) -> DataFrame:
    return doc.select(F.posexplode(name).alias(order, "x")).select("x.*", order)


def api_base(url: str) -> str:
    return url.rstrip("/")


@dataclass
class Settings:
    providers: dict = field(default_factory=dict)
    runtime: dict = field(default_factory=dict)
    run_defaults: dict = field(default_factory=dict)
    arbiter_run_defaults: dict = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | None = None) -> Settings:
        """From a TOML file: the given one, or that which SETTINGS_VARIABLE names; without one, the defaults. Keys that no section knows are errors."""
        path = path or os.environ.get(SETTINGS_VARIABLE)
        if not path or not os.path.exists(path):
            return cls()
        with open(path, "rb") as f:
            got = tomllib.load(f)
        out = cls(**{k: got.get(k, {}) for k in ("providers", "runtime", "run_defaults", "arbiter_run_defaults")})
        overlaid(None, out.run_defaults)
        overlaid(None, out.arbiter_run_defaults, ARBITER_DEFAULTS)
        return out

    def api_key(self, provider: str) -> str | None:
        """A key as given, or from the environment variable that's named; it never enters a DataFrame."""
        mine = own(self.providers, provider)
        return mine.get("api_key") or os.environ.get(mine.get("api_key_env", ""), None)


def own(settings: Mapping, provider: str | None) -> dict:
    """A provider's settings; of one without any, none."""
    return dict(settings.get((provider or "").lower(), {}))


RESULT_LINE = "custom_id string, response struct<status_code:int, body:struct<choices:array<struct<message:struct<content:string>>>, usage:struct<prompt_tokens:bigint, completion_tokens:bigint, total_tokens:bigint>>>, error struct<message:string>"


def batch_results(spark: SparkSession, *paths: str) -> DataFrame:
    """cid, text, tokens and error of batch result files (outputs and errors); blank and malformed lines are skipped."""
    lines = spark.read.text(list(paths)).where(F.trim("value") != "")
    rows = lines.select(F.from_json("value", RESULT_LINE).alias("r")).where("r.custom_id is not null")
    text = F.get(F.col("r.response.body.choices"), 0)["message"]["content"]
    failed = F.coalesce(F.col("r.error.message"), F.when(F.coalesce(F.col("r.response.status_code"), F.lit(200)) >= 400, F.concat(F.lit("status "), F.col("r.response.status_code").cast("string"))))
    return rows.select(F.col("r.custom_id").alias("cid"), F.when(failed.isNull(), text).alias("text"), F.col("r.response.body.usage.prompt_tokens").alias("input_tokens"), F.col("r.response.body.usage.completion_tokens").alias("output_tokens"), failed.alias("error"))


MESSAGE_LINE = "custom_id string, result struct<type:string, message:struct<content:array<struct<type:string,text:string>>, usage:struct<input_tokens:bigint, output_tokens:bigint, cache_read_input_tokens:bigint, cache_creation_input_tokens:bigint>>, error:struct<type:string, message:string>>"


def message_results(lines: DataFrame) -> DataFrame:
    """cid, type, text, tokens and error of the other provider's result lines (column value); blank and malformed ones are skipped."""
    rows = lines.where(F.trim("value") != "").select(F.from_json("value", MESSAGE_LINE).alias("r")).where("r.custom_id is not null")
    said = F.filter("r.result.message.content", lambda c: c["type"] == "text")
    good, use = F.col("r.result.type") == "succeeded", F.col("r.result.message.usage")
    n = lambda c: F.when(good, F.coalesce(use[c], F.lit(0).cast("bigint")))
    failed = F.when(~good, F.concat_ws(": ", "r.result.type", "r.result.error.message"))
    return rows.select(
        F.col("r.custom_id").alias("cid"), F.col("r.result.type").alias("type"), F.when(good, F.array_join(F.transform(said, lambda c: c["text"]), "")).alias("text"), n("input_tokens").alias("input_tokens"),
        n("output_tokens").alias("output_tokens"), n("cache_read_input_tokens").alias("cached_tokens"), n("cache_creation_input_tokens").alias("cache_write_tokens"), failed.alias("error"),
    )


# -- the driver's tables in their roles


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path that all executors share: in spark.checkpoint.dir, or beside the warehouse where all of Spark runs on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return os.path.join(found or spark.conf.get("spark.sql.warehouse.dir"), f"{name}-{uuid.uuid4().hex}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def papers_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("paper_id"), F.concat(F.lit("Paper "), F.col("doc_id").cast("string")).alias("title"), F.substring("text", 1, 300).alias("abstract"), F.col("source").alias("split"), F.col("doc_id").alias("p_order"))


def source_text_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"), F.col("text").alias("markdown"))
