"""Declarations: what a table is read from, how it is checked and where it goes."""

from __future__ import annotations

import dataclasses
import glob
import json
import os
import posixpath
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from siltstone.functions.text import group_names
from siltstone.functions.types import is_text, parse_type

# Fixed values.
FORMATS = ("csv", "tsv", "tab", "json", "parquet", "fixed_width")
MEMBER_GLOBS = {
    "csv": "*.csv",
    "tsv": "*.tsv",
    "tab": "*.tab",
    "json": "*.json",
    "parquet": "*.parquet",
}
IDENTIFIER = re.compile(r"^[a-zA-Z_][a-zA-Z0-9_]*$")
MAX_IDENTIFIER = 128
ROWS_PER_MB = 8000
TARGET_FILE_SIZE_MB = 128
TARGET_ROWS = 500_000


# Keys of a preprocess step that are not options of its function.
STEP_KEYS = ("action", "scope", "execution_mode", "include", "resources")


class SpecError(ValueError):
    """All problems of a declaration at once."""

    def __init__(self, problems: list[str]):
        self.problems = list(problems)
        super().__init__("; ".join(self.problems))


def is_identifier(name: Any) -> bool:
    return isinstance(name, str) and len(name) <= MAX_IDENTIFIER and bool(IDENTIFIER.match(name))


@dataclass(frozen=True)
class Slice:
    """One column of a fixed-width line; ``start`` counts from 0."""

    name: str
    start: int
    length: int
    type: str = "VARCHAR"
    trim: bool = False
    cast_mode: str = "adaptive"

    @property
    def end(self) -> int:
        return self.start + self.length


@dataclass(frozen=True)
class RecordFilter:
    position: int
    length: int
    value: str


@dataclass(frozen=True)
class FixedWidthSpec:
    columns: tuple[Slice, ...]
    record_filter: RecordFilter | None = None
    min_line_length: int | None = None

    @property
    def line_length(self) -> int:
        return max(piece.end for piece in self.columns)

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any] | None) -> FixedWidthSpec:
        problems: list[str] = []
        entries = (raw or {}).get("columns")
        if not isinstance(entries, list) or not entries:
            raise SpecError(["fixed-width spec needs a non-empty 'columns' list"])
        pieces: list[Slice] = []
        for number, entry in enumerate(entries):
            piece, faults = _slice_from(number, entry)
            problems += faults
            if piece is None:
                continue
            problems += [
                f"column '{piece.name}' overlaps '{other.name}'"
                for other in pieces
                if piece.start < other.end and other.start < piece.end
            ]
            problems += [f"column '{piece.name}' declared twice" for o in pieces if o.name == piece.name]
            pieces.append(piece)

        record = (raw or {}).get("record_type_filter")
        record_filter = None
        if record:
            try:
                record_filter = RecordFilter(record["position"], record["length"], str(record["value"]))
            except KeyError as missing:
                problems.append(f"record_type_filter lacks {missing}")
        shortest = (raw or {}).get("min_line_length")
        if shortest is not None and (not _is_int(shortest) or shortest < 0):
            problems.append("min_line_length must be a non-negative integer")
        if problems:
            raise SpecError(problems)
        return cls(tuple(pieces), record_filter, shortest or None)


def _is_int(value: Any) -> bool:
    return isinstance(value, int) and not isinstance(value, bool)


def _slice_from(number: int, entry: Mapping[str, Any]) -> tuple[Slice | None, list[str]]:
    label = f"column {entry.get('name', number)!r}"
    faults = []
    if not is_identifier(entry.get("name")):
        faults.append(f"{label}: name missing or not an identifier")
    for key, least in (("start", 0), ("length", 1)):
        if not _is_int(entry.get(key)) or entry[key] < least:
            faults.append(f"{label}: {key} must be an integer of at least {least}")
    kind = str(entry.get("type", "VARCHAR")).upper()
    try:
        parse_type(kind, str(entry.get("name")))
    except ValueError as exc:
        faults.append(str(exc))
    if not isinstance(entry.get("trim", False), bool):
        faults.append(f"{label}: trim must be true or false")
    if entry.get("cast_mode", "adaptive") not in ("adaptive", "strict"):
        faults.append(f"{label}: cast_mode must be adaptive or strict")
    if faults:
        return None, faults
    return Slice(
        entry["name"], entry["start"], entry["length"], kind,
        entry.get("trim", False), entry.get("cast_mode", "adaptive"),
    ), []


@dataclass(frozen=True)
class TypedColumn:
    """A column whose type the curated layer enforces."""

    name: str
    type: str
    cast_mode: str = "adaptive"


@dataclass(frozen=True)
class TableSpec:
    name: str
    path: str | tuple[str, ...] | None = None
    format: str = "csv"
    root: str | None = None
    schema: Mapping[str, str] = field(default_factory=dict)
    metadata: Mapping[str, Any] = field(default_factory=dict)
    naming_pattern: str | None = None
    partition_by: tuple[str, ...] = ()
    read_options: Mapping[str, Any] = field(default_factory=dict)
    hive_partitioning: bool = False
    expand_glob: bool = False
    archives: str | None = None
    files: str | None = None
    fixed_width: FixedWidthSpec | None = None
    type_enforcement: Mapping[str, Any] = field(default_factory=dict)
    validations: Mapping[str, Any] = field(default_factory=dict)
    transform: Callable | None = None
    preprocess: Callable[..., str] | None = None
    preprocess_options: Mapping[str, Any] = field(default_factory=dict)
    write_mode: str = "overwrite"
    output_layer: str = "curated"
    batch_strategy: str = "bulk"
    on_unmatched: str = "error"
    full_hash: bool = False

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any], validations: Mapping[str, Any] | None = None) -> TableSpec:
        """Build and check a table; ``validations`` are the data set's defaults."""
        raw = _renamed(raw)
        known = {f.name for f in dataclasses.fields(cls)}
        values = {key: raw[key] for key in raw if key in known and raw[key] is not None}
        schema = load_mapping(raw.get("schema"))
        values["schema"] = schema.get("columns", schema) if isinstance(schema, Mapping) else {}
        layout = raw.get("fixed_width") or load_mapping(raw.get("fixed_width_spec"))
        problems = []
        if layout and not isinstance(layout, FixedWidthSpec):
            layout = dict(layout)
            if raw.get("min_line_length") is not None:
                layout["min_line_length"] = raw["min_line_length"]
            try:
                layout = FixedWidthSpec.from_dict(layout)
            except SpecError as exc:
                problems += [f"table '{raw.get('name')}': {p}" for p in exc.problems]
                layout = None
        values["fixed_width"] = layout or None
        values["partition_by"] = tuple(raw.get("partition_by") or ())
        values["validations"] = {**(validations or {}), **(raw.get("validations") or {})}
        if isinstance(raw.get("path"), list):
            values["path"] = tuple(raw["path"])
        if "name" not in values:
            values["name"] = posixpath.basename(str(raw.get("path") or "unnamed"))
        spec = cls(**values)
        if not problems:
            problems = spec.problems()
        if problems:
            raise SpecError(problems)
        return spec

    @property
    def paths(self) -> list[str]:
        """Input paths with ``root`` in front of relative ones."""
        given = [self.path] if isinstance(self.path, str) else list(self.path or ())
        if not self.root:
            return given
        return [p if "://" in p or p.startswith("/") else posixpath.join(self.root, p) for p in given]

    @property
    def archive_paths(self) -> list[str]:
        given = self.archives or ""
        return [posixpath.join(self.root, given) if self.root and not given.startswith("/") else given]

    @property
    def preserved(self) -> list[str]:
        """Columns that may exist beside a declared schema."""
        names = [*self.metadata, *group_names(self.naming_pattern), *self.partition_by]
        return list(dict.fromkeys(names))

    @property
    def enforced_columns(self) -> list[TypedColumn]:
        """Columns to enforce; empty when enforcement is off.

        Fixed-width tables opt in by declaring any type other than text; other
        formats need ``enabled: true`` and a schema.
        """
        enabled = self.type_enforcement.get("enabled")
        if enabled is False:
            return []
        if self.fixed_width:
            pieces = self.fixed_width.columns
            if all(is_text(p.type) for p in pieces):
                return []
            return [TypedColumn(p.name, p.type, p.cast_mode) for p in pieces]
        if not enabled:
            return []
        return [TypedColumn(name, kind) for name, kind in self.schema.items()]

    def problems(self) -> list[str]:
        from siltstone.operators.checks import config_problems

        out = []
        if not is_identifier(self.name):
            out.append("name is not an identifier")
        if bool(self.path) == bool(self.archives):
            out.append("needs either 'path' or 'archives'")
        if bool(self.archives) != bool(self.files):
            out.append("'archives' and 'files' go together")
        if self.format not in FORMATS:
            out.append(f"format '{self.format}' is not one of {', '.join(FORMATS)}")
        if self.format == "fixed_width" and not self.fixed_width:
            out.append("format fixed_width needs a fixed-width spec")
        for label, value, allowed in (
            ("batch_strategy", self.batch_strategy, ("bulk", "partition_aware")),
            ("output_layer", self.output_layer, ("processed", "curated")),
            ("write_mode", self.write_mode, ("overwrite", "append")),
            ("on_unmatched", self.on_unmatched, ("error", "warn")),
            ("type_enforcement.on_fail", self.type_enforcement.get("on_fail", "null"), ("null", "strict")),
        ):
            if value not in allowed:
                out.append(f"{label} '{value}' is not one of {', '.join(allowed)}")
        if self.output_layer == "processed" and self.transform:
            out.append("output_layer processed cannot be combined with a transform")
        out += [f"partition_by '{c}' is not an identifier" for c in self.partition_by if not is_identifier(c)]
        groups: list[str] = []
        if self.naming_pattern:
            try:
                groups = group_names(self.naming_pattern)
            except re.error as exc:
                out.append(f"naming_pattern does not compile: {exc}")
            out += [f"naming_pattern group '{g}' is not an identifier" for g in groups if not is_identifier(g)]
        if self.batch_strategy == "partition_aware":
            if not self.naming_pattern or not self.partition_by:
                out.append("batch_strategy partition_aware needs naming_pattern and partition_by")
            out += [
                f"partition_by '{key}' is not a group of naming_pattern"
                for key in self.partition_by if self.naming_pattern and key not in groups
            ]
        for column, kind in self.schema.items():
            try:
                parse_type(kind, column)
            except ValueError as exc:
                out.append(str(exc))
        out += config_problems(self.validations)
        return [f"table '{self.name}': {problem}" for problem in out]


def _renamed(raw: Mapping[str, Any]) -> dict[str, Any]:
    """Other accepted spellings; unzipping as a preprocess step is an archive scan."""
    out = dict(raw)
    for other, name in (("path_pattern", "path"), ("transformation", "transform")):
        if other in out:
            out.setdefault(name, out.pop(other))
    step = out.get("preprocess")
    if isinstance(step, Mapping):
        del out["preprocess"]
        action = step.get("action")
        if action == "unzip":
            members = step.get("include") or MEMBER_GLOBS.get(out.get("format", "csv"), "*")
            out.update(archives=out.pop("path", None), files=f"**/{members}")
        elif callable(action):
            out["preprocess"] = action
            more = {k: v for k, v in step.items() if k not in STEP_KEYS}
            if more:
                out["preprocess_options"] = {**more, **out.get("preprocess_options", {})}
        elif action:
            raise SpecError([f"table '{out.get('name')}': preprocess action must be 'unzip' or a function, not {action!r}"])
    if isinstance(out.get("transform"), str):
        raise SpecError([f"table '{out.get('name')}': transform must be a function or class"])
    return out


def _beside(folder: str, table: Mapping[str, Any]) -> dict[str, Any]:
    out = dict(table)
    keys = ["root", "schema", "fixed_width_spec"]
    if not out.get("root"):
        keys += ["path", "path_pattern", "archives"]
    for key in keys:
        value = out.get(key)
        if isinstance(value, str) and "://" not in value and not os.path.isabs(value):
            found = os.path.join(folder, value)
            if glob.glob(found, recursive=True):
                out[key] = found
    return out


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    tables: tuple[TableSpec, ...]
    processed: str
    curated: str
    state: str
    raw: str | None = None
    partition_by: tuple[str, ...] = ()
    transform: Callable | None = None
    output_format: str = "parquet"
    target_rows: int = TARGET_ROWS
    salting: bool = False
    target_file_size_mb: int = TARGET_FILE_SIZE_MB
    compression: str = "snappy"
    max_records_per_file: int | None = None

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> DatasetSpec:
        storage = raw.get("storage") or {}
        root = storage.get("root", raw.get("root", "data"))
        performance = raw.get("performance") or {}
        defaults = raw.get("validations") or {}
        problems: list[str] = []
        tables: list[TableSpec] = []
        for entry in raw.get("tables") or (raw.get("data") or {}).get("tables") or []:
            try:
                tables.append(TableSpec.from_dict(entry, defaults))
            except SpecError as exc:
                problems += exc.problems
        names = [t.name for t in tables]
        problems += [f"table name '{n}' used twice" for n in sorted({n for n in names if names.count(n) > 1})]
        keys = tuple(raw.get("partition_by") or ())
        problems += [f"partition_by '{c}' is not an identifier" for c in keys if not is_identifier(c)]
        if problems:
            raise SpecError(problems)
        return cls(
            name=raw.get("dataset_name", raw.get("name", "dataset")),
            tables=tuple(tables),
            raw=storage.get("raw", posixpath.join(root, "raw")),
            processed=storage.get("processed", posixpath.join(root, "processed")),
            curated=storage.get("curated", posixpath.join(root, "curated")),
            state=storage.get("state", posixpath.join(root, "state")),
            partition_by=keys,
            transform=raw.get("transform"),
            output_format=str(storage.get("format", "parquet")).lower(),
            target_rows=performance.get("target_rows") or raw.get("target_rows", TARGET_ROWS),
            salting=performance.get("salting", False),
            target_file_size_mb=performance.get("target_file_size_mb", TARGET_FILE_SIZE_MB),
            compression=performance.get("compression", "snappy"),
            max_records_per_file=performance.get("max_records_per_file"),
        )

    @classmethod
    def from_file(cls, path: str) -> DatasetSpec:
        """Read a declaration; relative local paths count from its folder, if found there."""
        raw = load_mapping(path)
        folder = os.path.dirname(os.path.abspath(path))
        tables = [_beside(folder, t) for t in raw.get("tables") or (raw.get("data") or {}).get("tables") or []]
        return cls.from_dict({**raw, "tables": tables})

    def partition_keys(self, table: TableSpec) -> list[str]:
        return list(table.partition_by or self.partition_by)


def load_mapping(ref: Any) -> dict:
    """A mapping given in place, or read from a JSON or YAML file."""
    if not isinstance(ref, str):
        return dict(ref or {})
    with open(ref, encoding="utf-8") as handle:
        if ref.endswith(".json"):
            return json.load(handle) or {}
        if ref.endswith((".yaml", ".yml")):
            import yaml

            return yaml.safe_load(handle) or {}
    raise SpecError([f"cannot load '{ref}': use .json, .yaml or .yml"])
