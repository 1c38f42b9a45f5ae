"""From a mapping of pipelines to one Spark plan.

Each destination owns a pipeline, and each pipeline is evaluated once: value steps are composed into
one expression, a checking step reads its value from a column, and lookups become left joins. All
pipelines advance together, so a round adds the columns of every pipeline in one projection.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.constants import FAILED, IMPORTED, KEY_SEPARATOR
from tabweave.functions import steps as S
from tabweave.functions.text import bound, is_empty, source_col, target_id
from tabweave.operators import lookups
from tabweave.operators.multivalue import explode_values

STATUS, MESSAGES, STUBS, COPIES = "_status", "_messages", "_stubs", "_copies"
# What a row says besides its values.
REPORT = (STATUS, MESSAGES, STUBS, COPIES)
COPY_TYPE = "struct<field:string,from:string,to:string,wanted:string,move:boolean>"
_STUB_TYPE = "struct<migration:string,src_key:string>"
_ELEMENT_KEY = "_element_key"

# Nested pipelines, and the option that holds the child steps of each.
NESTED_STEPS = {"sub_process": ("process", "values")}


def normalize_steps(pipeline) -> list[dict]:
    """A pipeline as a list of steps; a source named on a later step is read before it."""
    raw = pipeline if isinstance(pipeline, list) else [pipeline]
    steps = []
    for step in raw:
        step = {"plugin": "get", "source": step} if isinstance(step, str) else dict(step)
        plugin = step.setdefault("plugin", "get")
        if plugin != "get" and "source" in step:
            steps.append({"plugin": "get", "source": step.pop("source")})
        steps.append(step)
    return steps


def references(step: dict) -> list[str]:
    """The earlier destinations a step reads."""
    if step["plugin"] == "migration_lookup":
        named = [c for ids in step.get("source_ids", {}).values() for c in ids]
    else:
        source = step.get("source", []) if step["plugin"] == "get" else []
        named = [source] if isinstance(source, str) else list(source)
    return [s[1:] for s in named if s.startswith("@") and not s.startswith("@@")]


@dataclass
class _Field:
    at: int
    name: str
    steps: list[dict]
    cursor: int = 0
    value: Column | None = None
    # The value as long as it is the same for all rows.
    constant: object = None
    stored: bool = True
    stop: str | None = None
    halt: str | None = None
    logs: list[str] = field(default_factory=list)
    stubs: list[str] = field(default_factory=list)
    # Columns with lists of messages and of stubs.
    many_logs: list[str] = field(default_factory=list)
    many_stubs: list[str] = field(default_factory=list)
    copies: list[str] = field(default_factory=list)

    @property
    def done(self) -> bool:
        return self.cursor == len(self.steps) and self.stored

    @property
    def column(self) -> str:
        return f"_v{self.at}"


class MappingPlan:
    """Runs the pipelines of one mapping over a frame of source rows."""

    def __init__(self, df: DataFrame, mapping: Mapping, ctx: S.Context):
        self.df, self.ctx = df, ctx
        self.sources = set(df.columns)
        self.fields = [_Field(i, name, normalize_steps(p)) for i, (name, p) in enumerate(mapping.items())]
        self.by_name = {f.name: f for f in self.fields}
        # Destinations whose final value is a column of the frame.
        self.settled: set[str] = set()
        # Rows that ended before the first lookup; they skip all lookups.
        self.ended: DataFrame | None = None
        self._check_references()

    def _check_references(self) -> None:
        for f in self.fields:
            for step in f.steps:
                for ref in references(step):
                    if ref not in self.by_name:
                        raise ValueError(f"{f.name} refers to {ref}, which is not a destination")
                    if self.by_name[ref].at >= f.at:
                        raise ValueError(f"{f.name} refers to {ref}, which does not come before it")
                if step["plugin"] not in ("get", "migration_lookup", *NESTED_STEPS):
                    S.find_step(step["plugin"])

    def _ready(self, step: dict) -> bool:
        return self.settled.issuperset(references(step))

    def _source(self, name: str) -> Column:
        if name.startswith("@@"):
            name = name[1:]
        elif name.startswith("@"):
            return F.col(self.by_name[name[1:]].column)
        if name not in self.sources:
            raise ValueError(f"Source column {name!r} is not in the sheet")
        return source_col(name)

    def _dtype(self, f: _Field) -> T.DataType:
        if f.stored and f.column in self.df.columns:
            return self.df.schema[f.column].dataType
        return self.df.select(f.value.alias("v")).schema["v"].dataType

    def _get(self, f: _Field, step: dict) -> Column:
        source = step.get("source")
        if source is None:
            if f.value is None:
                raise ValueError(f"{f.name} starts without a source")
            return drop_empty(f.value, self._dtype(f))
        if isinstance(source, str):
            return self._source(source)
        return F.array(*[self._source(s).cast("string") for s in source])

    def _kind(self, step: dict) -> str:
        if step["plugin"] == "get":
            return S.VALUE
        if step["plugin"] == "migration_lookup":
            return S.FRAME
        if step["plugin"] in NESTED_STEPS:
            children = next(step[k] for k in NESTED_STEPS[step["plugin"]] if k in step)
            return S.FRAME if needs_frame(children) else S.CHECK
        return S.find_step(step["plugin"]).kind(step)

    def _guarded(self, f: _Field, value: Column) -> Column:
        return F.when(~F.col(f.stop), value) if f.stop else value

    def _advance(self, f: _Field, columns: dict[str, Column]) -> bool:
        """Compose steps until one needs its value in a column; True if anything was added."""
        moved = False
        while f.cursor < len(f.steps):
            step = f.steps[f.cursor]
            if not self._ready(step):
                break
            kind = self._kind(step)
            if step["plugin"] == "migration_lookup" and f.value is None:
                # Each map is asked with columns of its own.
                f.value, f.stored = F.lit(None).cast("string"), False
                moved = True
            if kind == S.FRAME or (kind == S.CHECK and not f.stored):
                break
            if kind == S.CHECK:
                f.constant = None
                self._check(f, step, columns)
                f.cursor += 1
                return True
            first = f.value is None
            value = self._get(f, step) if step["plugin"] == "get" else self._value(f, step)
            f.constant = step["default_value"] if first and step["plugin"] == "default_value" else None
            f.value, f.stored = self._guarded(f, value), False
            f.cursor += 1
            moved = True
        if not f.stored:
            columns[f.column] = f.value
            f.value, f.stored = F.col(f.column), True
            return True
        return moved

    def _value(self, f: _Field, step: dict) -> Column:
        found = S.find_step(step["plugin"])
        dtype = self._dtype(f) if f.value is not None else None
        if isinstance(dtype, T.ArrayType) and not found.whole_list:
            return F.transform(f.value, lambda e: found.build(e, dtype.elementType, step, self.ctx))
        return found.build(f.value, dtype, step, self.ctx)

    def _check(self, f: _Field, step: dict, columns: dict[str, Column]) -> None:
        dtype = self._dtype(f)
        if step["plugin"] in NESTED_STEPS:
            result = nested(f.value, dtype, step, self.ctx)
        else:
            found = S.find_step(step["plugin"])
            if isinstance(dtype, T.ArrayType) and not found.whole_list:
                result = check_elements(found, f.value, dtype.elementType, step, self.ctx)
            else:
                result = found.build(f.value, dtype, step, self.ctx)
        going = ~F.col(f.stop) if f.stop else F.lit(True)
        if f.halt:
            going = going & F.col(f.halt).isNull()
        columns[f.column] = self._guarded(f, result.value)
        if result.halt is not None:
            new = F.when(going, result.halt)
            name = f"_halt{f.at}_{f.cursor}"
            columns[name] = F.coalesce(F.col(f.halt), new) if f.halt else new
            f.halt = name
        if result.log is not None:
            name = f"_log{f.at}_{f.cursor}"
            columns[name] = F.when(going, result.log)
            f.logs.append(name)
        if result.stop is not None:
            name = f"_stop{f.at}_{f.cursor}"
            columns[name] = F.coalesce(F.col(f.stop) | result.stop, F.lit(True)) if f.stop else result.stop
            f.stop = name
        f.value, f.stored = F.col(f.column), True

    def _is_self(self, step: dict) -> bool:
        names = step.get("migration", [])
        return step["plugin"] == "migration_lookup" and self.ctx.migration in (
            [names] if isinstance(names, str) else names
        )

    def _join(self, f: _Field) -> None:
        """Run the frame step the field waits for."""
        step = f.steps[f.cursor]
        if f.value is None:
            raise ValueError(f"{f.name} starts without a source")
        if step["plugin"] == "entity_lookup" and f.constant is not None:
            # One value for all rows is looked up once, not joined: every row would meet at its key.
            self.df = self.df.withColumn(f.column, S.constant_entity(f.constant, step, self.ctx))
            f.value, f.constant, f.cursor = F.col(f.column), None, f.cursor + 1
            return
        asked, out = f"_ask{f.at}", f"_out{f.at}"
        # A row that has ended asks for nothing.
        ended = [F.col(g.halt) for g in self.fields[: f.at + 1] if g.halt]
        alive = F.coalesce(*ended).isNull() if ended else None
        self.df = self.df.withColumn(asked, f.value if alive is None else F.when(alive, f.value))
        if step["plugin"] == "migration_lookup":
            self._migration_lookup(f, step, asked, out)
        elif step["plugin"] in NESTED_STEPS:
            self._nested(f, step, asked, out)
        else:
            found = S.find_step(step["plugin"])
            if isinstance(self.df.schema[asked].dataType, T.ArrayType) and not found.whole_list:
                self.df = self._each(asked, out, lambda df, v, o, ctx: found.build(df, v, o, step, ctx))
            else:
                self.df = found.build(self.df, asked, out, step, self.ctx)
        if step["plugin"] == "file_copy":
            copy = F.struct(
                F.lit(f.name).alias("field"), F.get(asked, F.lit(0)).alias("from"), F.col(out).alias("to"),
                F.get(asked, F.lit(1)).alias("wanted"), F.lit(bool(step.get("move"))).alias("move"),
            )
            name = f"_copy{f.at}_{f.cursor}"
            self.df = self.df.withColumn(name, F.when(F.col(out).isNotNull(), copy))
            f.copies.append(name)
        self.df = self.df.withColumn(f.column, self._guarded(f, F.col(out))).drop(asked, out)
        f.value, f.stored = F.col(f.column), True
        f.cursor += 1

    def _elements(self, value: str, element: str) -> DataFrame:
        """The elements of a list, one row each: ``_row_key``, place ``_at``, ``element``, and a key of their own."""
        parts = self.df.select(source_col(self.ctx.key).alias("_row_key"), F.posexplode(F.col(value)).alias("_at", element))
        own = F.concat(F.col("_row_key").cast("string"), F.lit(KEY_SEPARATOR), F.col("_at").cast("string"))
        return parts.withColumn(_ELEMENT_KEY, own)

    def _each(self, value: str, out: str, run) -> DataFrame:
        """A frame step for every element of a list, with the results in the list's order."""
        ctx = dataclasses.replace(self.ctx, key=_ELEMENT_KEY)
        done = run(self._elements(value, "_element"), "_element", "_result", ctx)
        listed = done.groupBy("_row_key").agg(F.array_sort(F.collect_list(F.struct("_at", "_result"))).alias("_list"))
        listed = listed.select("_row_key", F.transform("_list", lambda s: s["_result"]).alias("_list"))
        joined = self.df.join(listed, source_col(self.ctx.key) == F.col("_row_key"), "left")
        none = F.when(F.size(value) == 0, F.array().cast(listed.schema["_list"].dataType))
        return joined.withColumn(out, F.coalesce("_list", none)).drop("_row_key", "_list")

    def _nested(self, f: _Field, step: dict, asked: str, out: str) -> None:
        """Pipelines over the elements of a list, each a row of a mapping of its own.

        Their values come back as structs in the list's order. The first element that ends ends the row; messages
        and stubs of all elements are those of the row.
        """
        children = next(step[k] for k in NESTED_STEPS[step["plugin"]] if k in step)
        dtype = self.df.schema[asked].dataType
        if not isinstance(dtype, T.ArrayType):
            raise ValueError("A nested pipeline runs over a list")
        parts = self._elements(asked, "_element")
        if isinstance(dtype.elementType, T.StructType):
            names = dtype.elementType.fieldNames()
        elif isinstance(dtype.elementType, T.MapType):
            names = [n for n in read_sources(children) if not n.startswith("@")]
        else:
            raise ValueError("A nested pipeline runs over a list of maps or structs")
        read = [_child(F.col("_element"), dtype.elementType, n, {}).alias(n) for n in names]
        parts = parts.select("_row_key", "_at", _ELEMENT_KEY, *read)
        own = self.ctx.own
        if own is None:
            own = self.df.filter(first_halt(self.fields).isNull()).select(source_col(self.ctx.key).alias("src_key"))
        ctx = dataclasses.replace(self.ctx, key=_ELEMENT_KEY, own=own)
        done = compile_mapping(parts, children, ctx, ["_row_key", "_at"])
        values = [c for c in done.columns if c not in ("_row_key", "_at", *REPORT)]
        # The message of the end is the last of the element's, if it has one; the row tells it as its own.
        said_end = F.element_at(F.concat(F.array(F.lit("")), F.transform(MESSAGES, lambda m: m["text"])), -1)
        ended = F.when(F.col(STATUS) != IMPORTED, F.struct(F.col(STATUS).alias("status"), said_end.alias("text")))
        logs = F.when(F.col(STATUS) == IMPORTED, F.col(MESSAGES)).otherwise(
            F.slice(MESSAGES, F.lit(1), F.greatest(F.size(MESSAGES) - 1, F.lit(0)))
        )
        one = F.struct("_at", F.struct(*[source_col(v) for v in values]).alias("v"), ended.alias("h"), logs.alias("m"), F.col(STUBS).alias("s"))
        listed = done.groupBy("_row_key").agg(F.array_sort(F.collect_list(one)).alias("_list"))
        made = F.transform("_list", lambda x: x["v"])
        halt, said, stub = (f"_{n}{f.at}_{f.cursor}" for n in ("halt", "said", "stubs"))
        listed = listed.select(
            "_row_key",
            made.alias("_made"),
            F.get(F.filter(F.transform("_list", lambda x: x["h"]), lambda h: h.isNotNull()), F.lit(0)).alias("_end"),
            F.flatten(F.transform("_list", lambda x: x["m"])).alias(said),
            F.flatten(F.transform("_list", lambda x: x["s"])).alias(stub),
        )
        kind = listed.schema["_made"].dataType
        joined = self.df.join(listed, source_col(self.ctx.key) == F.col("_row_key"), "left").drop("_row_key")
        none = F.when(F.size(asked) == 0, F.array().cast(kind))
        joined = joined.withColumn(out, F.coalesce("_made", none))
        joined = joined.withColumn(halt, F.coalesce(F.col(f.halt), F.col("_end")) if f.halt else F.col("_end"))
        self.df = joined.drop("_made", "_end")
        f.halt = halt
        f.many_logs.append(said)
        f.many_stubs.append(stub)

    def _migration_lookup(self, f: _Field, step: dict, asked: str, out: str) -> None:
        names = step["migration"]
        names = [names] if isinstance(names, str) else list(names)
        key, composite = self.ctx.key, isinstance(self.df.schema[asked].dataType, T.ArrayType)
        if composite and step.get("each"):
            self._lookup_each(f, step, names, asked, out)
            return
        if composite:
            self.df = self.df.withColumn(asked, F.array_join(asked, KEY_SEPARATOR, ""))
        else:
            self.df = self.df.withColumn(asked, F.when(F.col(asked).cast("string") != "", F.col(asked).cast("string")))
        source_ids = {
            name: [self._plain_name(c) for c in columns] for name, columns in step.get("source_ids", {}).items()
        }
        own = None
        if self.ctx.migration in names:
            # Rows that have ended get no target, so they are no parents.
            rows = self.ctx.own
            if rows is None:
                rows = self.df.filter(first_halt(self.fields).isNull()).select(source_col(key).alias("src_key"))
            own = (self.ctx.migration, rows)
        elif self.ctx.id_map is None:
            raise ValueError(f"No id map to look up {', '.join(names)}")
        self.df = lookups.migration_lookup(self.df, asked, self.ctx.id_map, names, out, source_ids, key, own, self.ctx.few)
        if step.get("no_stub"):
            return
        target = step.get("stub_id") or names[0]
        missed = F.col(asked).isNotNull() & F.col(out).isNull()
        if self.ctx.stub_jobs is not None and target not in self.ctx.stub_jobs:
            # Nobody would write the stub, so the reference stays empty and the row tells why.
            log = f"_log{f.at}_{f.cursor}"
            words = F.concat(F.lit(f"No row of {target} has the key "), F.col(asked).cast("string"))
            self.df = self.df.withColumn(log, F.when(missed, S.message("warning", words)))
            f.logs.append(log)
            return
        wanted = F.struct(F.lit(target).alias("migration"), F.col(asked).alias("src_key"))
        stub = f"_stub{f.at}_{f.cursor}"
        placeholder = F.when(F.col(stub).isNotNull(), target_id(F.lit(target), F.col(asked)))
        self.df = self.df.withColumn(stub, F.when(missed, wanted))
        self.df = self.df.withColumn(out, F.coalesce(F.col(out), placeholder))
        f.stubs.append(stub)

    def _lookup_each(self, f: _Field, step: dict, names: list[str], asked: str, out: str) -> None:
        """Every value of a list looked up by itself; values without a hit or a stub are left out of the list."""
        child = {k: v for k, v in step.items() if k not in ("each", "source")}
        values = F.transform(asked, lambda e: F.struct(e.cast("string").alias("value")))
        self.df = self.df.withColumn(asked, values)
        self._nested(f, {"plugin": "sub_process", "process": {"id": [{"plugin": "get", "source": "value"}, child]}}, asked, out)
        hits = F.array_compact(F.transform(out, lambda s: s["id"]))
        self.df = self.df.withColumn(out, F.when(F.size(hits) > 0, hits))

    def _plain_name(self, source: str) -> str:
        return self.by_name[source[1:]].column if source.startswith("@") else source

    def run(self, keep: Sequence[str] = (), scratch: bool = False) -> DataFrame:
        while not all(f.done for f in self.fields):
            self.settled = {f.name for f in self.fields if f.done}
            columns: dict[str, Column] = {}
            moved = False
            for f in self.fields:
                if not f.done and self._ready_now(f):
                    moved = self._advance(f, columns) or moved
            if columns:
                self.df = self.df.withColumns(columns)
            waiting = [f for f in self.fields if self._waits(f)]
            # References to the own sheet come last, when it is known which of its rows stay.
            first = [f for f in waiting if not self._is_self(f.steps[f.cursor])]
            if not first and not moved:
                first = waiting
            if not first and not moved:
                raise ValueError("The mapping cannot be ordered")
            if first:
                self._set_ended_aside()
            for f in first:
                self._join(f)
        result = self._result(self.df, self.fields, keep, scratch)
        if self.ended is None:
            return result
        ended = self._result(self.ended, self.fields[: self.split_at], keep, scratch)
        values = [c for c in ended.columns if c not in (*keep, *REPORT)]
        return result.unionByName(ended.drop(*values), allowMissingColumns=True)

    def _set_ended_aside(self) -> None:
        """Part the rows that have ended from the rest before they are shuffled for a lookup.

        Only the leading destinations that are complete count, so that the first of a row's ends is known.
        """
        if self.ended is not None:
            return
        ready = 0
        while ready < len(self.fields) and self.fields[ready].done:
            ready += 1
        halts = [F.col(f.halt) for f in self.fields[:ready] if f.halt]
        if not halts:
            return
        end = F.coalesce(*halts)
        self.split_at, self.ended = ready, self.df.filter(end.isNotNull())
        self.df = self.df.filter(end.isNull())

    def _ready_now(self, f: _Field) -> bool:
        return not f.stored or (f.cursor < len(f.steps) and self._ready(f.steps[f.cursor]))

    def _waits(self, f: _Field) -> bool:
        return (
            f.cursor < len(f.steps)
            and f.stored
            and f.value is not None
            and self._kind(f.steps[f.cursor]) == S.FRAME
            and self._ready(f.steps[f.cursor])
        )

    def _result(self, df: DataFrame, fields: Sequence[_Field], keep: Sequence[str], scratch: bool) -> DataFrame:
        halted = [f for f in fields if f.halt]
        at = F.coalesce(*[F.when(F.col(f.halt).isNotNull(), F.lit(f.at)) for f in halted]) if halted else F.lit(None)
        # What a row says ends with the destination that ended the row.
        said = [
            F.when(at.isNull() | (F.lit(f.at) <= at), F.col(name)) if halted else F.col(name)
            for f in fields
            for name in f.logs
        ]
        end = first_halt(fields)
        level = F.when(end["status"] == FAILED, F.lit("error")).otherwise(F.lit("status"))
        if halted:
            words = F.struct(level.alias("level"), end["text"].alias("text"))
            said.append(F.when(end.isNotNull() & (end["text"] != ""), words))
        messages = F.array_compact(F.array(*said)) if said else F.array()
        lists = [
            F.when(at.isNull() | (F.lit(f.at) <= at), F.col(name)) if halted else F.col(name)
            for f in fields
            for name in f.many_logs
        ]
        messages = _before(messages, lists, "struct<level:string,text:string>")
        stubs = [F.col(name) for f in fields for name in f.stubs]
        stubs = F.array_compact(F.array(*stubs)) if stubs else F.array()
        stubs = _before(stubs, [F.col(name) for f in fields for name in f.many_stubs], _STUB_TYPE)
        copies = [F.col(name) for f in fields for name in f.copies]
        copies = F.array_compact(F.array(*copies)) if copies else F.array()
        return df.select(
            *[source_col(k) for k in keep],
            *destinations(fields, scratch),
            F.coalesce(end["status"], F.lit(IMPORTED)).alias(STATUS),
            messages.cast("array<struct<level:string,text:string>>").alias(MESSAGES),
            stubs.cast(f"array<{_STUB_TYPE}>").alias(STUBS),
            copies.cast(f"array<{COPY_TYPE}>").alias(COPIES),
        )


def _before(own: Column, lists: Sequence[Column], kind: str) -> Column:
    """The elements of ``lists``, then those of ``own``."""
    every = [F.coalesce(x, F.array().cast(f"array<{kind}>")) for x in lists]
    return F.concat(*every, own.cast(f"array<{kind}>")) if every else own


def read_sources(children: Mapping) -> list[str]:
    """The names that nested pipelines read from an element."""
    found: dict[str, None] = {}
    for pipeline in children.values():
        for step in normalize_steps(pipeline):
            named = step.get("source", []) if step["plugin"] == "get" else []
            named = [named] if isinstance(named, str) else list(named)
            named += [c for ids in step.get("source_ids", {}).values() for c in ids]
            found.update(dict.fromkeys(named))
    return list(found)


def needs_frame(children: Mapping) -> bool:
    """Do nested pipelines look anything up, nest further, or leave messages? They then run as rows of their own."""
    for pipeline in children.values():
        for step in normalize_steps(pipeline):
            if step["plugin"] in ("migration_lookup", "log", "file_is_accessible", *NESTED_STEPS):
                return True
            if step["plugin"] != "get" and S.find_step(step["plugin"]).kind(step) == S.FRAME:
                return True
    return False


def first_halt(fields: Sequence[_Field]) -> Column:
    """Why a row ended, by the first destination that ended it; NULL while it goes on."""
    halts = [F.col(f.halt) for f in fields if f.halt]
    return F.coalesce(*halts) if halts else F.lit(None).cast("struct<status:string,text:string>")


def drop_empty(value: Column, dtype: T.DataType) -> Column:
    """A list without its empty elements, NULL if none is left; any other value as it is."""
    if not isinstance(dtype, T.ArrayType):
        return value
    kept = F.filter(value, lambda e: ~is_empty(e, dtype.elementType))
    return F.when(F.size(kept) > 0, kept)


def check_elements(found: S.Step, value: Column, dtype: T.DataType, step: dict, ctx: S.Context) -> S.StepResult:
    """Apply a checking step to the elements of a list; the first element that ends the row ends it."""
    probe = found.build(F.lit(None).cast(dtype), dtype, step, ctx)

    def first(part: str) -> Column:
        each = F.transform(value, lambda e: getattr(found.build(e, dtype, step, ctx), part))
        return F.get(F.filter(each, lambda s: s.isNotNull()), F.lit(0))

    return S.StepResult(
        F.transform(value, lambda e: found.build(e, dtype, step, ctx).value),
        halt=first("halt") if probe.halt is not None else None,
        log=first("log") if probe.log is not None else None,
    )


def bound_step(found: S.Step, value: Column | None, dtype: T.DataType | None, step: dict, ctx: S.Context):
    """A step over a value that is written once for each part of the result, so that chains grow in proportion."""
    if value is None:
        return found.build(value, dtype, step, ctx)

    def run(v: Column):
        if isinstance(dtype, T.ArrayType) and not found.whole_list:
            if found.kind(step) == S.CHECK:
                return check_elements(found, v, dtype.elementType, step, ctx)
            return F.transform(v, lambda e: found.build(e, dtype.elementType, step, ctx))
        return found.build(v, dtype, step, ctx)

    probe = run(F.lit(None).cast(dtype))
    if not isinstance(probe, S.StepResult):
        return bound(value, run)

    def part(name: str) -> Column:
        # A function of one parameter: a second one would be taken for the element's index.
        return bound(value, lambda v: getattr(run(v), name))

    return S.StepResult(**{p: part(p) for p in ("value", "halt", "stop", "log") if getattr(probe, p) is not None})


def _child(element: Column, dtype: T.DataType, name: str, done: Mapping[str, Column]) -> Column:
    if name.startswith("@"):
        if name[1:] not in done:
            raise ValueError(f"{name[1:]} does not come before its use in a nested pipeline")
        return done[name[1:]]
    if isinstance(dtype, T.MapType):
        return F.try_element_at(element, F.lit(name))
    if isinstance(dtype, T.StructType):
        return element[name]
    raise ValueError("A nested pipeline runs over a list of maps or structs")


def nested(value: Column, dtype: T.DataType, step: dict, ctx: S.Context) -> S.StepResult:
    """Run pipelines over the elements of a list; each element becomes a struct of their results.

    Children see their element only, so their steps are value or checking steps.
    """
    if not isinstance(dtype, T.ArrayType):
        raise ValueError("A nested pipeline runs over a list")
    children = next(step[k] for k in NESTED_STEPS[step["plugin"]] if k in step)
    plans = {name: normalize_steps(p) for name, p in children.items()}
    probing = SparkSession.active().range(0)
    kinds: dict[tuple[str, int], T.DataType] = {}
    at: list[tuple[str, int]] = [("", 0)]

    def type_of(current: Column) -> T.DataType:
        # The first run is over a null element, outside of any lambda, where types can be asked for.
        if at[0] not in kinds:
            kinds[at[0]] = probing.select(current.alias("v")).schema["v"].dataType
        return kinds[at[0]]

    def run(element: Column) -> tuple[dict[str, Column], list[Column]]:
        done: dict[str, Column] = {}
        halts: list[Column] = []
        for name, pipeline in plans.items():
            current, stop = None, None
            for number, s in enumerate(pipeline):
                at[0] = (name, number)
                if s["plugin"] == "get":
                    source = s.get("source")
                    if source is None:
                        new = drop_empty(current, type_of(current))
                    elif isinstance(source, str):
                        new = _child(element, dtype.elementType, source, done)
                    else:
                        new = F.array(*[_child(element, dtype.elementType, x, done).cast("string") for x in source])
                else:
                    found = S.find_step(s["plugin"])
                    if found.kind(s) == S.FRAME:
                        raise ValueError(f"{s['plugin']} cannot run inside a nested pipeline")
                    kind = None if current is None else type_of(current)
                    result = bound_step(found, current, kind, s, ctx)
                    if not isinstance(result, S.StepResult):
                        result = S.StepResult(result)
                    if result.halt is not None:
                        halts.append(F.when(~stop, result.halt) if stop is not None else result.halt)
                    new = result.value
                    if result.stop is not None:
                        new_stop = result.stop if stop is None else stop | result.stop
                        current, stop = (F.when(~stop, new) if stop is not None else new), new_stop
                        continue
                current = F.when(~stop, new) if stop is not None else new
            done[name] = current
        return done, halts

    _, probe = run(F.lit(None).cast(dtype.elementType))
    values = F.transform(value, lambda e: F.struct(*[c.alias(n) for n, c in run(e)[0].items() if not n.startswith("_")]))
    if not probe:
        return S.StepResult(values)
    ends = F.transform(value, lambda e: F.coalesce(*run(e)[1]))
    return S.StepResult(values, halt=F.get(F.filter(ends, lambda s: s.isNotNull()), F.lit(0)))


def destinations(fields: Sequence[_Field], scratch: bool = False) -> list[Column]:
    """The target columns: ``f/sub`` pieces gathered into structs, scratch fields left out."""
    groups: dict[str, list[tuple[str | None, Column]]] = {}
    for f in fields:
        top, _, sub = f.name.partition("/")
        if top.startswith("_") and not scratch:
            continue
        groups.setdefault(top, []).append((sub or None, F.col(f.column)))
    columns = []
    for top, pieces in groups.items():
        if all(sub is None for sub, _ in pieces):
            columns.append(pieces[-1][1].alias(top))
        elif any(sub is None for sub, _ in pieces):
            raise ValueError(f"{top} is mapped both as a whole and in parts")
        else:
            columns.append(F.struct(*[c.alias(sub) for sub, c in pieces]).alias(top))
    return columns


def compile_mapping(
    df: DataFrame, mapping: Mapping, ctx: S.Context | None = None, keep: Sequence[str] = (), scratch: bool = False
) -> DataFrame:
    """Rows of ``df`` through the pipelines of ``mapping``.

    The result has the ``keep`` columns, the destinations, the row's status, its messages, the
    placeholder rows it asks for and the copies it plans. Rows that are ignored or failed stay, told apart by their status.
    """
    return MappingPlan(df, mapping, ctx or S.Context()).run(keep, scratch)


def _all_steps(mapping: Mapping) -> list[dict]:
    """All steps of a mapping, nested ones included."""
    found = []
    for pipeline in mapping.values():
        for step in normalize_steps(pipeline):
            found.append(step)
            for option in NESTED_STEPS.get(step["plugin"], ()):
                if option in step:
                    found += _all_steps(step[option])
    return found


def asks_for_stubs(mapping: Mapping) -> bool:
    """May the mapping leave placeholder rows for other jobs?"""
    return any(s["plugin"] == "migration_lookup" and not s.get("no_stub") for s in _all_steps(mapping))


def plans_copies(mapping: Mapping) -> bool:
    """Does the mapping plan copies of files?"""
    return any(s["plugin"] == "file_copy" for s in _all_steps(mapping))


def may_end(step: dict) -> bool:
    """May a step end its row?"""
    if step["plugin"] in ("get", "log", "migration_lookup", *NESTED_STEPS):
        return False
    if step["plugin"] == "skip_on_empty":
        return step.get("method", "row") == "row"
    return S.find_step(step["plugin"]).kind(step) == S.CHECK


def ends_after_own(mapping: Mapping, migration: str) -> bool:
    """May a row end after a lookup in its own job? Other rows may then have referred to it already."""
    seen = False
    for pipeline in mapping.values():
        for step in normalize_steps(pipeline):
            inner = [step] + [s for o in NESTED_STEPS.get(step["plugin"], ()) if o in step for s in _all_steps(step[o])]
            if seen and any(may_end(s) for s in inner):
                return True
            for s in inner:
                names = s.get("migration", []) if s["plugin"] == "migration_lookup" else []
                seen = seen or migration in ([names] if isinstance(names, str) else names)
    return False


def accepted(rows: DataFrame) -> DataFrame:
    """The rows that go to the target."""
    return rows.filter(F.col(STATUS) == IMPORTED).drop(*REPORT)


def messages_of(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """What the rows said, one message per row."""
    return explode_values(rows, MESSAGES, key, "_m").select(*key, "_m.level", "_m.text")
