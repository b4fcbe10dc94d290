"""Chat messages as columns: array<struct<role, blocks: array<struct<text, cache_ttl>>>>."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MESSAGES = "array<struct<role:string,blocks:array<struct<text:string,cache_ttl:string>>>>"
SYSTEM = "You answer questions about one document. Rely on its text alone and quote the passages that support each answer."
#: Fixed value: below so many characters one provider doesn't cache a prompt.
LEAST_CACHED_CHARS = 4096
#: Tokens that the two passes may take where a run doesn't say.
MOST_TOKENS = {1: 4096, 2: 1024}
ARBITER = "You settle disputes between raters of one document. Weigh each candidate's value, reasoning and evidence and decide."
INCLUSION = "This question decides whether the paper is included: a wrong answer can flip that."
NO_TEXT = "No text of the document is given: decide by the candidates alone."


def option_lines(options: Column, many: Column) -> Column:
    """options: array<struct<value, label>>."""
    lines = F.array_join(F.transform(options, lambda o: F.concat(F.lit("  - '"), o["value"], F.lit("' — "), o["label"])), "\n")
    note = F.when(many, "\n  (several may apply)").otherwise("")
    return F.when(F.size(options) > 0, F.concat(F.lit("\n  Options:\n"), lines, note)).otherwise("")


def question_block() -> Column:
    """From the columns key, label, help_text, options, allow_multiple."""
    helped = F.when(F.coalesce(F.col("help_text"), F.lit("")) != "", F.concat(F.lit("\n  Help: "), F.col("help_text"))).otherwise("")
    return F.concat(F.lit("- key='"), F.col("key"), F.lit("': "), F.col("label"), helped, option_lines(F.col("options"), F.col("allow_multiple")))


def dispute_block(anonymous: bool) -> Column:
    """question_block() with a notice of inclusion criteria and the candidates, from is_ic and candidates besides."""
    notice = F.when(F.coalesce(F.col("is_ic"), F.lit(False)), F.concat(F.lit("\n  "), F.lit(INCLUSION))).otherwise("")
    return F.concat(question_block(), notice, F.lit("\n  Candidates:\n"), candidate_lines(F.col("candidates"), F.lit(anonymous)))


def questions_text(groups: DataFrame, block: Column | None = None) -> DataFrame:
    """group_idx (and paper_id, where papers have their own groups), keys and questions (blocks in their order), one row a group."""
    own = ["paper_id"] if "paper_id" in groups.columns else []
    listed = F.array_sort(F.collect_list(F.struct("pos", F.col("key").alias("key"), (question_block() if block is None else block).alias("block"), F.col("version_id").alias("version_id"))))
    rows = groups.groupBy(*own, "group_idx").agg(listed.alias("q"))
    return rows.select(*own, "group_idx", F.col("q.key").alias("keys"), F.col("q.version_id").alias("version_ids"), F.array_join(F.col("q.block"), "\n").alias("questions"))


def message(role: str, *texts: Column) -> Column:
    blocks = F.array(*(F.struct(t.alias("text"), F.lit(None).cast("string").alias("cache_ttl")) for t in texts))
    return F.struct(F.lit(role).alias("role"), blocks.alias("blocks"))


def pass1_messages(source: Column, questions: Column, cache_first: Column, system: str | None = None, without: str | None = None) -> Column:
    """System message, then the text and the questions as two user messages; cache_first says which comes first. No text: `without` instead, or the questions alone."""
    asked, none = F.concat(F.lit("Questions:\n"), questions), F.coalesce(source, F.lit("")) == ""
    text = F.concat(F.lit("Document:\n"), source) if without is None else F.when(none, without).otherwise(F.concat(F.lit("Document:\n"), source))
    head = message("system", F.lit(system or SYSTEM))
    both = F.when(cache_first == "questions", F.array(head, message("user", asked), message("user", text))).otherwise(F.array(head, message("user", text), message("user", asked)))
    return both if without is not None else F.when(none, F.array(head, message("user", asked))).otherwise(both)


def pass2_messages(pass1_text: Column, specs: Column) -> Column:
    """One user message that asks for the answers as JSON; specs: a line "key (type)" for each question."""
    ask = F.concat(F.lit("Write the answers below as JSON, an object with a list \"results\" of key, value, cited_text, comment, confidence.\nKeys:\n"), F.array_join(specs, "\n"), F.lit("\n\nAnswers:\n"), pass1_text)
    return F.array(message("user", ask))


def candidate_lines(candidates: Column, anonymous: Column) -> Column:
    """candidates: array<struct<rater_key, value, comment, cited_text>>; raters are A, B, C ... or their keys."""

    def one(c: Column, i: Column) -> Column:
        name = F.when(anonymous, F.char(F.lit(65) + i)).otherwise(c["rater_key"])
        reason = F.when(F.coalesce(c["comment"], F.lit("")) != "", F.concat(F.lit("\n  Reasoning: "), c["comment"])).otherwise("")
        quote = F.when(F.coalesce(c["cited_text"], F.lit("")) != "", F.concat(F.lit("\n  Evidence: "), c["cited_text"])).otherwise("")
        return F.concat(F.lit("Candidate "), name, F.lit(": "), F.coalesce(c["value"], F.lit("null")), reason, quote)

    lines = F.array_join(F.transform(candidates, one), "\n")
    return F.when(F.coalesce(F.size(candidates), F.lit(0)) > 0, lines).otherwise("(no candidates)")


def cached(messages: Column, provider: Column, enabled: Column, ttl: Column) -> Column:
    """Marks the first user message for the provider's prompt cache: one takes a time to live, one needs a length, others nothing."""
    first = F.array_position(F.transform(messages, lambda m: m["role"]), "user") - 1
    chars = F.aggregate(messages, F.lit(0), lambda n, m: n + F.aggregate(m["blocks"], F.lit(0), lambda k, b: k + F.length(b["text"])))
    able = enabled & ((provider == "anthropic") | ((provider == "gemini") & (chars >= LEAST_CACHED_CHARS)))
    mark = F.when(provider == "anthropic", ttl).otherwise(F.lit("default"))

    def blocks(m: Column) -> Column:
        return F.transform(m["blocks"], lambda b, i: F.struct(b["text"].alias("text"), F.when(i == F.size(m["blocks"]) - 1, mark).alias("cache_ttl")))

    marked = F.transform(messages, lambda m, i: F.when(i == first, F.struct(m["role"].alias("role"), blocks(m).alias("blocks"))).otherwise(m))
    return F.when(able, marked).otherwise(messages)


def warming(messages: Column) -> Column:
    """Messages that write a shared start into the provider's cache: the last one, which is a paper's own, is a placeholder."""
    block = F.array(F.struct(F.lit("warmup").alias("text"), F.lit(None).cast("string").alias("cache_ttl")))
    return F.transform(messages, lambda m, i: F.when(i == F.size(messages) - 1, F.struct(m["role"].alias("role"), block.alias("blocks"))).otherwise(m))


def flat(messages: Column) -> Column:
    """Role and text of each message, for previews."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit("["), m["role"], F.lit("]\n"), F.array_join(F.transform(m["blocks"], lambda b: b["text"]), ""))), "\n\n")


def split_system(messages: Column) -> tuple[Column, Column]:
    """The first system message's text and the other messages in their order."""
    is_system = F.transform(messages, lambda m: m["role"] == "system")
    at = F.array_position(is_system, True)
    text = F.when(at > 0, F.array_join(F.transform(F.get(messages, (at - 1).cast("int"))["blocks"], lambda b: b["text"]), ""))
    return text, F.filter(messages, lambda m, i: i != at - 1)


def _literal(value: object) -> Column:
    """A setting of a run as a column; nested ones by their JSON."""
    if isinstance(value, (dict, list)):
        said = F.lit(json.dumps(value))
        return F.from_json(said, F.schema_of_json(said))
    return F.lit(value)


def request_body(cid: Column, messages: Column, model: Column, provider: str, *, number: int = 1, temperature: float | None = None, params: Mapping | None = None, response_format: Mapping | None = None) -> Column:
    """The line of a batch file for one call of pass 1 or 2. params win over what else would stand in the body; one provider takes no response format."""
    content = lambda ms: F.transform(ms, lambda m: F.struct(m["role"].alias("role"), F.array_join(F.transform(m["blocks"], lambda b: b["text"]), "").alias("content")))
    extra = dict(params or {})
    fields = {"model": model, "max_tokens": F.lit(extra.pop("max_tokens", MOST_TOKENS[number]))}
    if provider not in ("anthropic", "openai", "azure"):
        raise ValueError(f"no batch requests for {provider!r}")
    system, rest = split_system(messages)
    fields["messages"] = content(rest if provider == "anthropic" else messages)
    if temperature is not None:
        fields["temperature"] = F.lit(temperature)
    fields |= {k: _literal(v) for k, v in extra.items()}
    if provider == "anthropic":
        fields["system"] = F.nullif(system, F.lit(""))
    elif response_format is not None:
        fields["response_format"] = _literal(response_format)
    body = F.struct(*(c.alias(k) for k, c in fields.items()))
    if provider == "anthropic":
        return F.to_json(F.struct(cid.alias("custom_id"), body.alias("params")))
    return F.to_json(F.struct(cid.alias("custom_id"), F.lit("POST").alias("method"), F.lit("/v1/chat/completions").alias("url"), body.alias("body")))


def preview(calls: DataFrame, number: int = 1) -> DataFrame:
    """What would be sent: cid, pass, n_chars and the messages as one text."""
    return calls.select("cid", F.lit(number).alias("pass"), flat(F.col("messages")).alias("prompt")).withColumn("n_chars", F.length("prompt"))
