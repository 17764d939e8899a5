"""Canonical schemas, their changes, and a registry that refuses breaking ones."""

from __future__ import annotations

import enum
import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import types as T

from tessera.governance.control import ControlPlane, now


class Change(enum.IntEnum):
    """Kinds of change, the worse the higher."""

    NONE = 0
    ADDITIVE = 1
    WIDENING = 2
    BREAKING = 3


class SchemaRefused(RuntimeError):
    """The registry doesn't take this schema."""


def type_name(t: T.DataType) -> str:
    if isinstance(t, T.DecimalType):
        return f"decimal({t.precision},{t.scale})"
    if isinstance(t, T.ArrayType):
        return f"array<{type_name(t.elementType)}:{str(t.containsNull).lower()}>"
    if isinstance(t, T.MapType):
        return f"map<{type_name(t.keyType)},{type_name(t.valueType)}:{str(t.valueContainsNull).lower()}>"
    if isinstance(t, T.StructType):
        return "struct<" + ",".join(_lines(t)) + ">"
    return t.simpleString().lower()


def _lines(schema: T.StructType) -> list[str]:
    names = [f.name.lower() for f in schema.fields]
    again = sorted({n for n in names if names.count(n) > 1})
    if again:
        raise ValueError(f"columns that differ by case only: {', '.join(again)}")
    return [f"{f.name.lower()}:{type_name(f.dataType)}:{str(f.nullable).lower()}" for f in sorted(schema.fields, key=lambda f: f.name.lower())]


def canonical(schema: T.StructType) -> str:
    """name:type:nullable of each field, lower-cased and sorted, one a line."""
    return "\n".join(_lines(schema))


def schema_hash(schema: T.StructType) -> str:
    return hashlib.sha256(canonical(schema).encode()).hexdigest()


WHOLE = ("tinyint", "smallint", "int", "bigint")


def type_change(old: T.DataType, new: T.DataType) -> Change:
    """How a type changed. What isn't known to be safe is breaking."""
    if old == new:
        return Change.NONE
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return compare(old, new)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return max(type_change(old.elementType, new.elementType), null_change(old.containsNull, new.containsNull))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        if old.keyType != new.keyType:
            return Change.BREAKING
        return max(type_change(old.valueType, new.valueType), null_change(old.valueContainsNull, new.valueContainsNull))
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        grows = new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
        return Change.WIDENING if grows else Change.BREAKING
    a, b = old.simpleString(), new.simpleString()
    if a in WHOLE and b in WHOLE and WHOLE.index(a) < WHOLE.index(b) or (a, b) == ("float", "double"):
        return Change.WIDENING
    return Change.BREAKING


def null_change(old: bool, new: bool) -> Change:
    """Required to nullable widens, nullable to required breaks."""
    return Change.NONE if old == new else Change.WIDENING if new else Change.BREAKING


def compare(old: T.StructType, new: T.StructType) -> Change:
    """The worst change from one schema to another. Names match without case, order doesn't count."""
    _lines(old), _lines(new)
    before, after = ({f.name.lower(): f for f in s.fields} for s in (old, new))
    worst = Change.BREAKING if before.keys() - after.keys() else Change.NONE
    for name, f in after.items():
        if name in before:
            g = before[name]
            worst = max(worst, type_change(g.dataType, f.dataType), null_change(g.nullable, f.nullable))
        else:
            worst = max(worst, Change.ADDITIVE if f.nullable else Change.BREAKING)
    return worst


def changed_columns(old: T.StructType, new: T.StructType) -> tuple[list[str], list[str]]:
    """Names that are new, and names whose type or nullability changed; both sorted."""
    before, after = ({f.name.lower(): f for f in s.fields} for s in (old, new))
    retyped = [n for n, f in after.items() if n in before and (type_name(f.dataType), f.nullable) != (type_name(before[n].dataType), before[n].nullable)]
    return sorted(after.keys() - before.keys()), sorted(retyped)


@dataclass(frozen=True)
class Registered:
    version: int
    change: Change
    new: bool


def register(control: ControlPlane, dataset: str, schema: T.StructType, run_id: str | None = None, strict: bool = False) -> Registered:
    """Registers a schema for a dataset: a known hash changes nothing, a breaking change is refused.

    strict refuses any change. Registrations of all writers take turns.
    """
    digest = schema_hash(schema)
    with control.transaction() as c:
        last = c.execute("SELECT version, hash, fields FROM schema_version WHERE dataset = ? ORDER BY version DESC LIMIT 1", (dataset,)).fetchone()
        if last is None:
            version, change, label, columns = 1, Change.NONE, "INITIAL", ([], [])
        elif last["hash"] == digest:
            return Registered(last["version"], Change.NONE, False)
        else:
            known = T.StructType.fromJson(json.loads(last["fields"]))
            change, columns = compare(known, schema), changed_columns(known, schema)
            if change == Change.BREAKING or strict:
                raise SchemaRefused(f"{dataset}: {change.name.lower()} change against version {last['version']}")
            version, label = last["version"] + 1, max(change, Change.ADDITIVE).name
        c.execute(
            "INSERT INTO schema_version (dataset, version, hash, fields, change, registered_at, run_id, added, retyped) VALUES (?, ?, ?, ?, ?, ?, ?, ?, ?)",
            (dataset, version, digest, schema.json(), label, now(), run_id, *map(json.dumps, columns)),
        )
    return Registered(version, change, True)
