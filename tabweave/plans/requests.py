"""From a template and a request to the jobs that run it.

A template is a handful of jobs, so this works on the driver; whole catalogs are queried as tables in
:mod:`tabweave.plans.catalog`, by the same name formats.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.constants import (
    DERIVED_MARK,
    DERIVED_TAG,
    GROUP_NAME_FORMAT,
    MIGRATION_NAME_FORMAT,
    REQUEST_TAG_FORMAT,
    SOURCE_DEFAULTS,
    TEMPLATE_TAG,
)
from tabweave.plans.compiler import NESTED_STEPS
from tabweave.plans.ingest import Group, Job
from tabweave.sources.cells import select_worksheet
from tabweave.sources.delimited import accepted_format, read_sheet

ROW_COLUMN = "_sheet_row"


@dataclass
class Template:
    """Jobs that are copied for each request, with source settings that override the defaults."""

    name: str
    jobs: Sequence[Job]
    tags: Sequence[str] = (TEMPLATE_TAG,)
    source: Mapping[str, Any] = field(default_factory=dict)


@dataclass
class Request:
    """One ingest: a sheet, the template it starts from, and mappings changed for it."""

    id: str
    file: str
    label: str = ""
    sheet: str | None = None
    owner: str | None = None
    active: bool = True
    original_mapping: str = "migration_group:isi"
    mappings: Mapping[str, Mapping] = field(default_factory=dict)

    @property
    def group(self) -> str:
        return GROUP_NAME_FORMAT.format(request=self.id)

    @property
    def tag(self) -> str:
        return REQUEST_TAG_FORMAT.format(request=self.id)


def comma_list(text: str | None) -> list[str]:
    """A setting entered as a comma list, without its empty entries."""
    return [part for part in (text or "").split(",") if part]


def template_of(request: Request, templates: Mapping[str, Template]) -> Template:
    kind, _, name = request.original_mapping.partition(":")
    if kind != "migration_group":
        raise ValueError(f"Unknown type of original mapping: {kind}")
    if name not in templates:
        raise ValueError(f"No template {name!r}")
    return templates[name]


def _renamed_step(step: Any, names: Mapping[str, str]) -> Any:
    if not isinstance(step, Mapping):
        return step
    step = dict(step)
    plugin = step.get("plugin", "get")
    if plugin == "migration_lookup":
        asked = step.get("migration")
        step["migration"] = names.get(asked, asked) if isinstance(asked, str) else [names.get(m, m) for m in asked]
        if "source_ids" in step:
            step["source_ids"] = {names.get(m, m): columns for m, columns in step["source_ids"].items()}
        if isinstance(step.get("stub_id"), str):
            step["stub_id"] = names.get(step["stub_id"], step["stub_id"])
    for option in NESTED_STEPS.get(plugin, ()):
        if isinstance(step.get(option), Mapping):
            step[option] = renamed_mapping(step[option], names)
    return step


def renamed_mapping(mapping: Mapping, names: Mapping[str, str]) -> dict:
    """A mapping whose lookups name the derived jobs; lookups of jobs outside ``names`` stay."""
    return {
        dest: [_renamed_step(s, names) for s in pipeline] if isinstance(pipeline, list) else _renamed_step(pipeline, names)
        for dest, pipeline in mapping.items()
    }


def source_settings(request: Request, template: Template) -> dict[str, Any]:
    """The request's file and sheet, then the template's settings, then the defaults."""
    return {**SOURCE_DEFAULTS, **template.source, "file": request.file, "worksheet": request.sheet}


def derive_jobs(request: Request, template: Template) -> list[Job]:
    """The template's jobs under the request's names; an inactive request has none.

    A request with mappings of its own has the jobs that it maps, any other all of the template. A job that keeps
    its source keeps its keys.
    """
    if not request.active:
        return []
    absent = set(request.mappings) - {j.name for j in template.jobs}
    if absent:
        raise ValueError(f"No job of the template has the name {', '.join(sorted(absent))}")
    mapped = [j for j in template.jobs if not request.mappings or j.name in request.mappings]
    names = {j.name: MIGRATION_NAME_FORMAT.format(group=request.group, migration=j.name) for j in mapped}
    source = source_settings(request, template)
    own = (DERIVED_MARK, DERIVED_TAG, request.tag)
    return [
        replace(
            job,
            name=names[job.name],
            mapping=renamed_mapping(request.mappings.get(job.name, job.mapping), names),
            keys=job.keys if job.keep_source else source["keys"],
            requires=[names[r] for r in job.requires if r in names],
            tags=list(dict.fromkeys([*job.tags, *template.tags, *own])),
            track_changes=source["track_changes"],
        )
        for job in mapped
    ]


def request_sheet(
    spark: SparkSession, request: Request, template: Template, cells: DataFrame | None = None
) -> DataFrame:
    """The rows of the request's sheet with their row numbers.

    A delimited file is read as it is; the worksheet of a workbook comes from its cell table.
    """
    source = source_settings(request, template)
    if accepted_format(request.file) == "csv":
        options = {k: source[k] for k in ("delimiter", "multiline", "columns", "mode") if k in source}
        return read_sheet(
            spark, request.file, header_row=source["header_row"], row_index_column=ROW_COLUMN, **options
        )
    if cells is None:
        raise ValueError(f"The cells of workbook {request.file} are needed")
    rows = select_worksheet(cells.filter(F.col("file") == request.file), request.sheet, source["header_row"])
    return rows.withColumnRenamed("row_idx", ROW_COLUMN).drop("file")


def request_group(
    spark: SparkSession,
    request: Request,
    templates: Mapping[str, Template],
    entities: DataFrame | None = None,
    files: DataFrame | None = None,
    cells: DataFrame | None = None,
) -> Group:
    """All that is needed to run a request."""
    template = template_of(request, templates)
    sheet = request_sheet(spark, request, template, cells)
    return Group(derive_jobs(request, template), sheet, ROW_COLUMN, entities, files)
