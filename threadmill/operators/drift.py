"""Schemas that drift between files: versioned fingerprints and a chain of migration steps.

The fingerprint of a record is its list of (path, JSON type, kind of value).
Records with one fingerprint share one version of the schema, so the route from
that version to the reference shape is worked out once per version and not once
per record: rename steps first, then defaults for what is missing, then casts.
Every step taken is recorded; the drift report is these records summed by shard.
The versions are kept in the order they were first written in, each with the
changes that led to it from the one before (``history``).

Cases: unreadable payloads (broken JSON, null, JSON that is no object) count for
nothing and give no row. A key with a null value is carried but has no type.
Repeated rows change nothing. A shard without any readable payload has no drift.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import datetime, timezone
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The reference shape: dotted path and JSON type.
REFERENCE = {
    "id": "string",
    "conversation_id": "string",
    "parent": "string",
    "author.role": "string",
    "create_time": "number",
    "content.content_type": "string",
    "content.parts": "array",
    "metadata": "object",
}

#: Rename steps: a leaf name (without case and underscores) and the field whose value it carries.
#: A step applies only where the record doesn't carry the field under its own path.
RENAMES = {
    "id": ("id", "messageid", "msgid", "uuid", "uid", "nodeid"),
    "conversation_id": ("conversationid", "convid", "conversation", "chatid", "threadid", "thread"),
    "parent": ("parent", "parentid", "parentnode", "replyto", "inreplyto", "parentmessageid"),
    "author.role": ("role", "authorrole", "fromrole", "sender", "speaker", "kind", "from", "authortype", "type", "name"),
    "create_time": ("createtime", "createdat", "created", "timestamp", "time", "ts", "sentat", "date"),
    "content.content_type": ("contenttype", "type", "kind", "format", "mime", "mimetype"),
    "content.parts": ("parts", "body", "blocks", "pieces", "segments", "text", "chunks", "items"),
    "metadata": ("metadata", "meta"),
}
ROLES = {"user", "assistant", "system", "tool"}
#: Codes that stand for roles and content types in retyped fields.
ROLE_CODES = {1: "user", 2: "assistant", 3: "system", 4: "tool"}
TYPE_CODES = {1: "text", 2: "multimodal_text"}
CONTENT_TYPES = {"text", "multimodal_text", "thoughts", "reasoning_recap", "user_editable_context", "code", "execution_output", "tether_browsing_display", "tether_quote", "system_error"}
UUID = re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I)
MOMENT = re.compile(r"\d{9,10}(\.\d+)?|\d{4}-\d\d-\d\d([T ]\d\d:\d\d.*)?")
CONTAINERS = {"author", "content"}


def json_type(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    return {str: "string", list: "array", dict: "object"}.get(type(value), "number")


def value_kind(value: object) -> str:
    """What a value looks like, by the domains of the reference fields; '' if like none."""
    if isinstance(value, str):
        if value.lower() in ROLES:
            return "role"
        if value in CONTENT_TYPES:
            return "type"
        if UUID.fullmatch(value):
            return "uuid"
        return "moment" if MOMENT.fullmatch(value) else "prose" if " " in value else ""
    if isinstance(value, bool):
        return ""
    if isinstance(value, (int, float)):
        return "moment" if 9e8 <= value < 1e10 else "code" if isinstance(value, int) and value in ROLE_CODES else ""
    if isinstance(value, list):
        kinds = {value_kind(x) for x in value}
        if len(value) == 1 and kinds <= {"role", "type", "uuid", "moment"}:
            return kinds.pop()
        return "parts" if all(isinstance(x, (str, dict)) or x is None for x in value) else ""
    if isinstance(value, dict):
        if value and all(k.isdigit() for k in value):
            return "parts"
        kinds = {value_kind(x) for x in value.values()} & {"role", "type", "uuid", "moment"}
        return kinds.pop() if len(kinds) == 1 else ""
    return ""


#: The kinds of value each field can carry, apart from its own path.
KIND_OF = {"id": {"uuid"}, "conversation_id": {"uuid"}, "parent": {"uuid", "null"}, "author.role": {"role", "code", "null"}, "create_time": {"moment", "null"}, "content.content_type": {"type", "code", "null"}, "content.parts": {"parts", "prose", "null"}, "metadata": {"object"}}


def _leaf(path: str) -> str:
    return path.rpartition(".")[2].replace("_", "").replace("-", "").lower()


def _may_carry(path: str, value: object) -> list[str]:
    """The fields whose value this may be, by the kind of value; names decide among them later."""
    kind = "null" if value is None else value_kind(value) or ("object" if isinstance(value, dict) else "")
    named = [f for f, names in RENAMES.items() if _leaf(path) in names]
    if path.startswith("author."):
        named = [f for f in named if f == "author.role"] or named
    elif path.startswith("content."):
        named = [f for f in named if f.startswith("content.")] or named
    if kind in ("role", "type"):
        return ["author.role" if kind == "role" else "content.content_type"]
    return [f for f in named if kind in KIND_OF[f] or f == "content.parts" and isinstance(value, str)]


def leaves(record: dict) -> list[tuple[str, object]]:
    """(path, value) of every field: reference fields and whatever may carry one aren't entered, other objects are."""
    out: list[tuple[str, object]] = []
    stack = [("", record)]
    while stack:
        prefix, node = stack.pop()
        for key, value in node.items():
            path = f"{prefix}{key}"
            if path in REFERENCE or path == "metadata":
                out.append((path, value))
            elif isinstance(value, dict) and (path in CONTAINERS or (value and not _may_carry(path, value))):
                stack.append((path + ".", value))
            elif not (path in CONTAINERS and value is None):
                out.append((path, value))
    return out


def fingerprint(record: dict) -> str:
    """The version of the schema a record is written in."""
    rows = []
    for path, value in leaves(record):
        kind = "null" if value is None else value_kind(value)
        rows.append([path, json_type(value), "" if path in REFERENCE else kind, [] if path in REFERENCE else _may_carry(path, value)])
    return json.dumps(sorted(rows), ensure_ascii=False)


@lru_cache(maxsize=4096)
def migration(version: str) -> tuple[dict[str, tuple[str, str]], tuple[tuple[str, str], ...]]:
    """The route from a version to the reference shape.

    Returns field -> (path it stands under, JSON type there), and the steps
    (field, 'renamed' | 'retyped' | 'added'). A field is looked for under its
    own path, then among the paths that may carry it: the longest shared
    container first, then the order of RENAMES.
    """
    rows = json.loads(version)
    types = {path: kind for path, kind, _, _ in rows}
    route = {f: (f, types[f]) for f in REFERENCE if f in types}
    steps = []
    free = {path: fields for path, _, _, fields in rows if path not in REFERENCE}
    for field in REFERENCE:
        names = RENAMES[field]
        found = [p for p, fields in free.items() if field in fields]
        if field in route:
            # a key that is left behind with null, while its value stands elsewhere, was renamed too
            found = [p for p in found if types[field] == "null" and types[p] != "null" and _leaf(p) in names]
        if found:
            best = min(found, key=lambda p: (types[p] == "null", p.rpartition(".")[0] != field.rpartition(".")[0], names.index(_leaf(p)) if _leaf(p) in names else len(names), p))
            route[field] = (best, types[best])
            steps.append((field, "renamed"))
            del free[best]
    steps += [(f, "retyped") for f, (_, kind) in route.items() if kind not in ("null", REFERENCE[f])]
    steps += [(p, "added") for p in free]
    return route, tuple(steps)


def _readable(payload: str | None) -> dict | None:
    try:
        record = json.loads(payload) if payload else None
    except (ValueError, RecursionError):
        return None
    return record if isinstance(record, dict) else None


def _versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard_no, version, records), counted within the batch before anything is shuffled."""
    for batch in batches:
        counts: dict[tuple, int] = {}
        for shard, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if (record := _readable(payload)) is not None:
                key = (shard, fingerprint(record))
                counts[key] = counts.get(key, 0) + 1
        yield pa.record_batch({"shard_no": pa.array([k[0] for k in counts], pa.int64()), "version": pa.array([k[1] for k in counts], pa.string()), "records": pa.array(list(counts.values()), pa.int64())})


def versions(raw: DataFrame) -> DataFrame:
    """(shard_no, version, records): the fingerprints of each shard."""
    return raw.select("shard_no", "payload").mapInArrow(_versions, "shard_no long, version string, records long").groupBy("shard_no", "version").agg(F.sum("records").alias("records"))


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for shard, version in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            route, steps = migration(version)
            out += [(shard, f, "carried") for f in route] + [(shard, f, s) for f, s in steps]
        yield pa.record_batch({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate((("shard_no", pa.int64()), ("field", pa.string()), ("step", pa.string())))})


def drift(raw: DataFrame) -> DataFrame:
    """(shard_no, field, drift): every departure of a shard from the reference shape."""
    steps = versions(raw).select("shard_no", "version").mapInArrow(_steps, "shard_no long, field string, step string").distinct()
    taken = steps.where("step <> 'carried'").select("shard_no", "field", F.col("step").alias("drift"))
    carried = steps.where("step = 'carried'").groupBy("shard_no").agg(F.collect_set("field").alias("carried"))
    shards = steps.select("shard_no").distinct().join(carried, "shard_no", "left")
    all_fields = F.array(*[F.lit(f) for f in REFERENCE])
    removed = shards.select("shard_no", F.explode(F.array_except(all_fields, F.coalesce("carried", F.array().cast("array<string>")))).alias("field"), F.lit("removed").alias("drift"))
    return taken.unionByName(removed)


# -- the consistent table ---------------------------------------------------


def _text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, list):
        return _text(value[0]) if value else None
    if isinstance(value, dict):
        return next((x for x in value.values() if isinstance(x, str)), None)
    return json.dumps(value)


def _coded(value: object, codes: dict[int, str]) -> str | None:
    return codes.get(value, str(value)) if isinstance(value, int) and not isinstance(value, bool) else _text(value)


def _seconds(value: object) -> float | None:
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return float(value)
    text = _text(value)
    try:
        return float(text) if text else None
    except ValueError:
        pass
    try:
        moment = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    return (moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)).timestamp()


def _parts(value: object) -> list[str | None] | None:
    if value is None:
        return None
    if isinstance(value, dict):
        numbered = bool(value) and all(k.isdigit() for k in value)
        value = [value[k] for k in sorted(value, key=int)] if numbered else [value]
    if not isinstance(value, list):
        value = [value]
    return [x if x is None or isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in value]


CASTS = {"author.role": lambda v: _coded(v, ROLE_CODES), "content.content_type": lambda v: _coded(v, TYPE_CODES), "create_time": _seconds, "content.parts": _parts, "metadata": lambda v: None if v is None else json.dumps(v, ensure_ascii=False)}

#: Default steps: what a record without the field has instead. Other fields have no value that would be true of every record, and stay null.
DEFAULTS = {"content.parts": [], "metadata": {}}

UNIFIED = pa.schema([("shard_no", pa.int64()), ("shard_file", pa.string()), ("rec_no", pa.int32()), ("id", pa.string()), ("conversation_id", pa.string()), ("parent", pa.string()), ("role", pa.string()), ("create_time", pa.float64()), ("content_type", pa.string()), ("parts", pa.list_(pa.string())), ("metadata", pa.string()), ("extra", pa.string()), ("changes", pa.list_(pa.string())), ("exported_at", pa.timestamp("us", "UTC"))])
UNIFIED_DDL = "shard_no long, shard_file string, rec_no int, id string, conversation_id string, parent string, role string, create_time double, content_type string, parts array<string>, metadata string, extra string, changes array<string>, exported_at timestamp"


def migrate(record: dict) -> tuple[dict, dict, list[str]]:
    """(reference fields, added fields, steps taken) of one record: renamed, then defaulted, then cast."""
    route, steps = migration(fingerprint(record))
    at = dict(leaves(record))
    fields = {f: at[path] for f, (path, _) in route.items() if path in at}
    missing = [f for f in DEFAULTS if f not in fields]
    fields |= {f: DEFAULTS[f] for f in missing}
    fields = {f: CASTS.get(f, _text)(v) for f, v in fields.items()}
    taken = [f"{s} {f}" for f, s in steps if s == "renamed"] + [f"defaulted {f}" for f in missing] + [f"{s} {f}" for f, s in steps if s != "renamed"]
    return fields, {p: at[p] for p, s in steps if s == "added" and p in at}, taken


def _unify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if (record := _readable(row["payload"])) is None:
                continue
            fields, extra, changes = migrate(record)
            out.append((row["shard_no"], row["shard_file"], row["rec_no"], *(fields.get(f) for f in REFERENCE), json.dumps(extra, ensure_ascii=False) if extra else None, changes, row["exported_at"]))
        yield pa.record_batch([pa.array([r[i] for r in out], f.type) for i, f in enumerate(UNIFIED)], schema=UNIFIED)


def unify(raw: DataFrame) -> DataFrame:
    """All readable records as one message table; of deliveries of one record the latest is kept, of equally late ones the greatest.

    Role names come in lower case; ``extra`` holds fields the reference doesn't
    know as JSON, ``changes`` the steps that were taken.
    """
    rows = raw.select("shard_no", "shard_file", "rec_no", "payload", "exported_at").mapInArrow(_unify, UNIFIED_DDL)
    rows = rows.withColumn("role", F.lower(F.trim("role")))
    rest = [c for c in rows.columns if c not in ("shard_no", "rec_no", "id", "exported_at")]
    return rows.groupBy("shard_no", "rec_no", "id").agg(F.max(F.struct("exported_at", *rest)).alias("r")).select(*[f"r.{c}" if c in rest else c for c in rows.columns if c != "exported_at"])


def changes_between(before: str | None, after: str) -> list[str]:
    """What a version has and the one before lacks, and the other way round, by path and type."""
    shape = lambda v: {p: t for p, t, *_ in json.loads(v)} if v else {}
    old, new = shape(before), shape(after)
    gone, come = sorted(old.keys() - new.keys()), sorted(new.keys() - old.keys())
    kept = sorted(p for p in old.keys() & new.keys() if old[p] != new[p] and "null" not in (old[p], new[p]))
    return [f"- {p}" for p in gone] + [f"+ {p}: {new[p]}" for p in come] + [f"{p}: {old[p]} -> {new[p]}" for p in kept]


HISTORY_DDL = "version_no long, version string, first_shard long, shards long, records long, changes array<string>, steps array<string>"


def history(raw: DataFrame) -> DataFrame:
    """The versions in the order they were first written in, with the changes from the one before and the route to the reference shape.

    There is a row for every distinct fingerprint. Their number follows from the
    shapes that writers use, not from the records, so one task puts them in order.
    """
    by = versions(raw).groupBy("version").agg(F.min("shard_no").alias("first_shard"), F.count("*").alias("shards"), F.sum("records").alias("records"))

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(["first_shard", "version"]).reset_index(drop=True)
        before = [None, *rows["version"][:-1]]
        rows["changes"] = [changes_between(b, v) for b, v in zip(before, rows["version"])]
        rows["steps"] = [[f"{s} {f}" for f, s in migration(v)[1]] for v in rows["version"]]
        return rows.assign(version_no=range(len(rows)))[["version_no", "version", "first_shard", "shards", "records", "changes", "steps"]]

    return by.withColumn("all", F.lit("all")).groupBy("all").applyInPandas(chain, HISTORY_DDL)
