"""The registry of pipeline steps.

A value step maps a Column to a Column. A checking step may also end the field, ignore or fail the
row, or leave a message. A frame step needs the whole frame, for a join or a numbering.
"""

from __future__ import annotations

import datetime
import json
import zlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.constants import FAILED, IGNORED
from tabweave.functions import text
from tabweave.operators import lookups
from tabweave.operators.manifest import number_clashes

VALUE, CHECK, FRAME = "value", "check", "frame"

# Entries of a static map that share a bucket; a value is searched in its bucket only.
BUCKET = 8


@dataclass
class Context:
    """What the steps of a run may look at."""

    migration: str = ""
    run_ts: datetime.datetime = field(default_factory=lambda: datetime.datetime.now(datetime.timezone.utc))
    allowed_paths: Sequence[str] = ()
    allowed_schemes: Sequence[str] = ()
    strict_paths: bool = False
    entities: DataFrame | None = None
    id_map: DataFrame | None = None
    targets: Mapping[str, DataFrame] = field(default_factory=dict)
    files: DataFrame | None = None
    key: str = "src_key"
    # Keys of the sheet's rows that count as targets of the running job; without it, all rows that have not ended.
    own: DataFrame | None = None
    # Copies planned by former imports, ``(migration, src_key, wanted, to)``: their names stay theirs.
    copies: DataFrame | None = None
    # Rows so few beside the tables they look things up in that these are cut down to what is asked, not shuffled.
    few: bool = False
    # Jobs for which a lookup may ask for a stub; without it, all.
    stub_jobs: Sequence[str] | None = None


@dataclass
class StepResult:
    """``halt`` is a struct (status, text) ending the row, ``stop`` a flag ending the field, ``log`` a message."""

    value: Column
    halt: Column | None = None
    stop: Column | None = None
    log: Column | None = None


@dataclass(frozen=True)
class Step:
    build: Callable
    kind: Callable[[dict], str]
    whole_list: bool


_STEPS: dict[str, Step] = {}
_CALLBACKS: dict[str, Callable[[Column, Context], Column]] = {}


def register_step(
    name: str, build: Callable, kind: str | Callable[[dict], str] = VALUE, whole_list: bool = False
) -> None:
    """Make a step known by its id.

    ``build(value, dtype, cfg, ctx)`` returns a Column, or a :class:`StepResult` for a checking step.
    A frame step is ``build(df, value, out, cfg, ctx)`` and returns the frame with the column ``out``.
    Steps see the elements of a list one by one unless they take the ``whole_list``.
    """
    _STEPS[name] = Step(build, kind if callable(kind) else (lambda cfg: kind), whole_list)


def register_callback(name: str, build: Callable[[Column, Context], Column]) -> None:
    _CALLBACKS[name] = build


def find_step(name: str) -> Step:
    if name not in _STEPS:
        raise ValueError(f"Unknown step {name!r}")
    return _STEPS[name]


def halt(status: str, message: Column) -> Column:
    return F.struct(F.lit(status).alias("status"), message.alias("text"))


def message(level: Any, words: Column) -> Column:
    return F.struct(F.lit(str(level)).alias("level"), words.alias("text"))


def shown(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("NULL"))


def _default_value(value, dtype, cfg, ctx):
    default = cfg.get("default_value")
    if default in (None, "", "0", 0, False):
        raise ValueError("Missing default value; nothing to bind")
    if value is None:
        return F.lit(default)
    other = F.array(F.lit(default)) if isinstance(dtype, T.ArrayType) else F.lit(default)
    return F.when(text.is_empty(value, dtype), other.cast(dtype)).otherwise(value)


def _mapped(value: Column, mapping: Mapping) -> Column:
    """What a map of any size has for a value, both as text; of keys that are equal as text the last counts.

    The map is one constant: entries are dealt out to buckets by a checksum of their key.
    """
    entries = {str(k): str(v) for k, v in mapping.items()}
    buckets: list[dict[str, str]] = [{} for _ in range(max(1, len(entries) // BUCKET))]
    for k, v in entries.items():
        buckets[zlib.crc32(k.encode()) % len(buckets)][k] = v
    table = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,string>>")
    place = F.pmod(F.crc32(value.cast("string").cast("binary")), F.lit(len(buckets))).cast("int")
    return F.try_element_at(F.get(table, place), value.cast("string"))


def _no_mapping(value: Column, mapped: Column) -> Column:
    words = F.concat(F.lit("No mapping for value: "), shown(value))
    return F.when(mapped.isNull(), halt(IGNORED, words))


def _static_map_kind(cfg: dict) -> str:
    return VALUE if cfg.get("bypass") or "default_value" in cfg else CHECK


def _static_map(value, dtype, cfg, ctx):
    mapped = _mapped(value, cfg["map"])
    if cfg.get("bypass"):
        return F.coalesce(mapped, value.cast("string"))
    if "default_value" in cfg:
        return F.coalesce(mapped, F.lit(cfg["default_value"]).cast("string"))
    return StepResult(mapped, halt=_no_mapping(value, mapped))


def _skip_on_empty(value, dtype, cfg, ctx):
    empty = text.is_empty(value, dtype)
    method = cfg.get("method", "row")
    if method == "process":
        return StepResult(F.when(~empty, value), stop=empty)
    if method != "row":
        raise ValueError(f"Unknown skip method {method!r}")
    return StepResult(value, halt=F.when(empty, halt(IGNORED, F.lit(cfg.get("message", "")))))


def _concat(value, dtype, cfg, ctx):
    delimiter = cfg.get("delimiter", "")
    if not isinstance(dtype, T.ArrayType):
        return value
    parts = F.transform(value, lambda c: F.coalesce(c.cast("string"), F.lit("")))
    return F.array_join(parts, delimiter)


def _callback_kind(cfg: dict) -> str:
    return FRAME if cfg["callable"] == "filesize" else VALUE


def _callback(value, *rest):
    if isinstance(value, DataFrame):
        return _filesize(value, *rest)
    dtype, cfg, ctx = rest
    if cfg["callable"] not in _CALLBACKS:
        raise ValueError(f"Unknown callback {cfg['callable']!r}")
    return _CALLBACKS[cfg["callable"]](value, ctx)


def _filesize(df, value, out, cfg, ctx):
    """Byte length through a file listing ``(path, length)``."""
    if ctx.files is None:
        return df.withColumn(out, F.lit(None).cast("bigint"))
    sizes = lookups.one_per_key(ctx.files, F.col("path"), F.col("length"))
    return lookups.left_lookup(df, F.col(value), sizes, out)


def _log(value, dtype, cfg, ctx):
    words = F.replace(F.lit(cfg.get("template", ":value")), F.lit(":value"), F.coalesce(value.cast("string"), F.lit("")))
    return StepResult(value, log=message(cfg.get("level", "status"), words))


def _explode(value, dtype, cfg, ctx):
    options = {k: cfg[k] for k in ("limit", "sublimit", "trim", "subtrim") if k in cfg}
    keys = cfg.get("keys") or []
    parts = text.two_level_split(value, cfg.get("delimiter"), cfg.get("subdelimiter"), keys=keys, **options)
    if not isinstance(dtype, T.StringType):
        raise ValueError("subdelimited_explode takes text")
    words = F.lit("The value of subdelimited_explode must be text; it was NULL")
    return StepResult(parts, halt=F.when(value.isNull(), halt(FAILED, words)))


def _file_is_accessible(value, dtype, cfg, ctx):
    if not ctx.allowed_paths and not ctx.allowed_schemes:
        words = F.concat(F.lit("No file access rule is set; passed unchecked: "), shown(value))
        return StepResult(value, log=message("warning", words))
    allowed = text.path_allowed(value, ctx.allowed_paths, ctx.allowed_schemes, ctx.strict_paths)
    words = F.concat(F.lit("File is outside the allowed directories and schemes: "), shown(value))
    return StepResult(value, halt=F.when(~allowed, halt(IGNORED, words)))


def _entities(cfg: dict, ctx: Context) -> DataFrame:
    if ctx.entities is None:
        raise ValueError("No entities to look up")
    return lookups.entities_of(
        ctx.entities, cfg["entity_type"], cfg["value_key"], cfg.get("bundle"), cfg.get("bundle_key")
    )


def _entity_lookup(df, value, out, cfg, ctx):
    return lookups.entity_lookup(df, value, _entities(cfg, ctx), out, bool(cfg.get("ignore_case")), ctx.key, cfg.get("collation"))


def constant_entity(value: Any, cfg: dict, ctx: Context) -> Column:
    """The entity of one value, found by a small job whose filters reach the scan."""
    entities = _entities(cfg, ctx)
    same = F.col("value") == F.lit(value)
    if cfg.get("collation"):
        same = F.collate(F.col("value"), cfg["collation"]) == F.lit(value)
    elif cfg.get("ignore_case"):
        same = F.lower("value") == F.lower(F.lit(value))
    return F.lit(entities.filter(same).agg(F.min("id")).first()[0]).cast(entities.schema["id"].dataType)


def _load_entity(df, value, out, cfg, ctx):
    kind = cfg["entity_type"].removeprefix("entity:")
    if kind not in ctx.targets:
        raise ValueError(f"No rows of type {kind!r} to load from")
    return lookups.load_entity(df, value, ctx.targets[kind], out, row_key=ctx.key, few=ctx.few)


def _file_copy(df, value, out, cfg, ctx):
    """Plan a copy: [source, destination] to the destination without clashes; no bytes move."""
    planned = df.withColumn("_copy_to", F.get(F.col(value), F.lit(1)))
    if cfg.get("file_exists", "rename") != "rename":
        return planned.withColumnRenamed("_copy_to", out)
    # Numeric keys count in numeric order.
    planned = planned.withColumn("_key_number", F.col(ctx.key).try_cast("bigint"))
    order = ["_key_number", ctx.key]
    if ctx.copies is None:
        return number_clashes(planned, "_copy_to", order, out).drop("_copy_to", "_key_number")
    # A row that asks for what it asked for before keeps the name it got.
    own = ctx.copies.filter(F.col("migration") == ctx.migration)
    own = own.groupBy(F.col("src_key").alias("_had_key"), F.col("wanted").alias("_had_wanted")).agg(F.min("to").alias("_had"))
    same = (F.col(ctx.key) == F.col("_had_key")) & (F.col("_copy_to") == F.col("_had_wanted"))
    planned = planned.join(own, same, "left").drop("_had_key", "_had_wanted")
    named = number_clashes(planned, "_copy_to", order, out, given=ctx.copies, had="_had")
    return named.drop("_copy_to", "_key_number", "_had")


register_step("default_value", _default_value, whole_list=True)
register_step("static_map", _static_map, _static_map_kind)
register_step("skip_on_empty", _skip_on_empty, CHECK, whole_list=True)
register_step("concat", _concat, whole_list=True)
register_step("urlencode", lambda value, dtype, cfg, ctx: text.encode_path(value))
register_step("callback", _callback, _callback_kind)
register_step("log", _log, CHECK)
register_step("subdelimited_explode", _explode, CHECK)
register_step("file_is_accessible", _file_is_accessible, CHECK)
register_step("entity_lookup", _entity_lookup, FRAME, whole_list=True)
register_step("load_entity", _load_entity, FRAME)
register_step("file_copy", _file_copy, FRAME, whole_list=True)

register_callback("basename", lambda value, ctx: text.basename(value))
register_callback("date", lambda value, ctx: text.run_date(value, ctx.run_ts))
register_callback("mime_content_type", lambda value, ctx: text.media_type(value))
