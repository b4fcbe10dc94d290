"""Arbitration: disputed answers settled by an arbiter, with the annotation engine over each paper's own questions.

An item's state is keyed by arbiter run and item; a cell is skipped if the last of its (paper, version) items is complete.
With text source "candidates_only" no text is read or sent. An answer whose question has no disputed item is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from ..operators import disputes as D
from ..operators import grid, prompts, state
from ..sources import documents as S
from . import engine


def arbitration(disputes: DataFrame, questions: DataFrame, reason: engine.Model = engine.reason_dummy, format_: engine.Model = engine.format_dummy) -> Callable[[Mapping], engine.Task]:
    """The Task of arbitration for an arbiter run's settings."""

    def make(config: Mapping) -> engine.Task:
        groups = D.groups_of_papers(disputes, questions, config["batching"])
        return engine.Task(groups, config, "resolution", prompts.dispute_block(config["anonymize_raters"]), reason, format_, prompts.ARBITER, prompts.NO_TEXT)

    return make


def papers_of(disputes: DataFrame) -> DataFrame:
    return D.papers(disputes)


def run(table: state.StateTable, runs: DataFrame, disputes: DataFrame, questions: DataFrame, source_text: DataFrame, settings: Mapping | None = None, *, reason: engine.Model = engine.reason_dummy, format_: engine.Model = engine.format_dummy, dispute_ids: list[int] | None = None, **how) -> list[engine.Outcome]:
    """Arbiter runs over disputes (of the ids that are given), chunk by chunk; resolutions are kept in `table` and posted."""
    disputes = grid.selected(disputes, "dispute_item_id", dispute_ids)
    make = arbitration(disputes, questions, reason, format_)
    return engine.run_all(table, runs, papers_of(disputes), questions, source_text, make, settings, defaults=S.ARBITER_DEFAULTS, total=disputes.count(), **how)


def run_pass1(table: state.StateTable, runs: DataFrame, disputes: DataFrame, source_text: DataFrame, task: engine.Task) -> int:
    return engine.run_pass1(table, runs, papers_of(disputes), source_text, task)


run_pass2, reformat = engine.run_pass2, engine.reformat


def repost(table: state.StateTable, questions: DataFrame, hooks: engine.Hooks, run_ids: list[int] | None = None) -> DataFrame | None:
    return engine.repost_all(table, questions, hooks, run_ids=run_ids, kind="resolution")
