"""Contracts as they are published, and records that were written under other versions of them.

A published contract is the JSON text of an Avro record. `read_contract` makes its
fields Spark types; `published` is the way back. A reader's contract takes records
of a writer's: fields by name or alias, numbers widened, a default where the
writer has no such field, and no field that the reader lacks.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream.operators.contracts import ContractError

BACKWARD, FORWARD, FULL = "backward", "forward", "full"
PROBLEM = "contractProblem"
_UNREAD = "_unread"

# fixed values: names of the types in published contracts
_PRIMITIVES: dict[str, T.DataType] = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}
_NAMES = {kind.typeName(): name for name, kind in _PRIMITIVES.items()}
# fixed values: what each type may be read as, besides itself
_WIDER = {
    "int": ("long", "float", "double"),
    "long": ("float", "double"),
    "float": ("double",),
    "string": ("bytes",),
    "bytes": ("string",),
}
_FITS = {
    "boolean": lambda v: isinstance(v, bool),
    "int": lambda v: _is_whole(v) and -(1 << 31) <= v < 1 << 31,
    "long": lambda v: _is_whole(v) and -(1 << 63) <= v < 1 << 63,
    "float": lambda v: _is_whole(v) or isinstance(v, float),
    "double": lambda v: _is_whole(v) or isinstance(v, float),
    "bytes": lambda v: isinstance(v, str),
    "string": lambda v: isinstance(v, str),
}


def _is_whole(value: Any) -> bool:
    return isinstance(value, int) and not isinstance(value, bool)


@dataclass(frozen=True)
class ContractField:
    """A field of a contract. `branches` are its types in the order of the union, "null" among them."""

    name: str
    branches: tuple[str, ...]
    has_default: bool = False
    default: Any = None
    aliases: tuple[str, ...] = ()

    @property
    def kind(self) -> str:
        return next(b for b in self.branches if b != "null")

    @property
    def nullable(self) -> bool:
        return "null" in self.branches

    @property
    def data_type(self) -> T.DataType:
        return _PRIMITIVES[self.kind]

    def fits(self, branch: str) -> bool:
        return self.default is None if branch == "null" else _FITS[branch](self.default)


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[ContractField, ...] = field(default_factory=tuple)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.data_type, f.nullable) for f in self.fields])

    def find(self, wanted: ContractField) -> ContractField | None:
        """The field that a reader's field stands for: its name first, then its aliases in their order."""
        own = {f.name: f for f in self.fields}
        return next((own[name] for name in (wanted.name, *wanted.aliases) if name in own), None)


def read_contract(text: str, strict: bool = False) -> Contract:
    """The contract of a published text.

    A union is null and one other type. By the rules of the format a default belongs to the first
    branch of a union; contracts in use break that (a union that starts with null and has a text as
    default), so any branch will do unless `strict`. See `default_problems`.
    """
    try:
        record = json.loads(text)
    except ValueError as error:
        raise ContractError(f"not a contract: {error}") from None
    if not isinstance(record, dict) or record.get("type") != "record" or not isinstance(record.get("fields"), list):
        raise ContractError("not a contract: no record")
    name = str(record.get("name", ""))
    fields = tuple(_field(name, f) for f in record["fields"])
    repeated = {f.name for f in fields if sum(g.name == f.name for g in fields) > 1}
    if repeated:
        raise ContractError(f"{name}: fields stand twice: {', '.join(sorted(repeated))}")
    contract = Contract(name, fields)
    problems = default_problems(contract) if strict else _unfit_defaults(contract)
    if problems:
        raise ContractError(f"{name}: " + "; ".join(problems))
    return contract


def _field(record: str, given: Any) -> ContractField:
    if not isinstance(given, dict) or not isinstance(given.get("name"), str):
        raise ContractError(f"{record}: a field has no name")
    kinds = given.get("type")
    branches = tuple(kinds) if isinstance(kinds, list) else (kinds,)
    known = [b for b in branches if isinstance(b, str) and b in _PRIMITIVES]
    if len(known) != 1 or any(b != "null" and b not in known for b in branches) or len(set(branches)) != len(branches):
        raise ContractError(f"{record}: type of field {given['name']} is not supported: {json.dumps(kinds)}")
    return ContractField(given["name"], branches, "default" in given, given.get("default"), tuple(given.get("aliases", ())))


def _unfit_defaults(contract: Contract) -> list[str]:
    return [
        f"default of field {f.name} fits none of its types"
        for f in contract.fields
        if f.has_default and not any(f.fits(b) for b in f.branches)
    ]


def default_problems(contract: Contract) -> list[str]:
    """Defaults that do not belong to the first branch of their union."""
    return [
        f"default of field {f.name} is not of its first type, {f.branches[0]}"
        for f in contract.fields
        if f.has_default and not f.fits(f.branches[0])
    ]


def published(
    name: str, schema: T.StructType, defaults: dict[str, Any] | None = None, aliases: dict[str, tuple[str, ...]] | None = None
) -> str:
    """The text of a contract. A nullable field without another default has null as its default, and each
    default's type comes first in its union."""
    defaults, aliases = defaults or {}, aliases or {}
    fields = []
    for f in schema.fields:
        kind = _NAMES.get(f.dataType.typeName())
        if kind is None:
            raise ContractError(f"{name}: type of field {f.name} is not supported: {f.dataType.simpleString()}")
        entry: dict[str, Any] = {"name": f.name, "type": kind}
        if f.nullable:
            entry["type"] = [kind, "null"] if defaults.get(f.name) is not None else ["null", kind]
        if f.nullable or f.name in defaults:
            entry["default"] = defaults.get(f.name)
        if f.name in aliases:
            entry["aliases"] = list(aliases[f.name])
        fields.append(entry)
    return json.dumps({"type": "record", "name": name, "fields": fields})


def write_contracts(spark: SparkSession, texts: dict[int, str], folder: str) -> None:
    """Publish the texts of a subject's versions, one file in a folder `version=<number>` each."""
    for text in texts.values():
        read_contract(text)
    rows = spark.createDataFrame(sorted(texts.items()), "version int, value string")
    rows.repartition(len(texts), "version").write.partitionBy("version").text(folder)


def read_contracts(spark: SparkSession, folder: str, strict: bool = False) -> dict[int, Contract]:
    """Version → contract, of a subject's folders `version=<number>` with one file each."""
    found = spark.read.schema("value string, version int").text(folder, wholetext=True).collect()  # a row per version
    if len({r.version for r in found}) < len(found) or any(r.version is None for r in found):
        raise ContractError(f"{folder}: a version has one file, in a folder named version=<number>")
    return {r.version: read_contract(r.value, strict) for r in sorted(found, key=lambda r: r.version)}


def resolution_problems(writer: Contract, reader: Contract) -> list[str]:
    """What keeps a reader from taking every record of a writer."""
    problems = []
    for wanted in reader.fields:
        given = writer.find(wanted)
        if given is None:
            if not wanted.has_default:
                problems.append(f"field {wanted.name} is not written and has no default")
            continue
        if given.kind != wanted.kind and wanted.kind not in _WIDER.get(given.kind, ()):
            problems.append(f"field {wanted.name} is written as {given.kind}, which is not read as {wanted.kind}")
        if given.nullable and not wanted.nullable:
            problems.append(f"field {wanted.name} may be written as null")
    return problems


def compatibility_problems(new: Contract, earlier: dict[int, Contract], mode: str = BACKWARD, all_versions: bool = False) -> dict[int, list[str]]:
    """Version → what breaks between a new contract and that version: the last one, or all of them.

    backward: the new contract reads what was written before; forward: earlier ones read what it will
    write; full: both. Versions without a problem are left out.
    """
    if mode not in (BACKWARD, FORWARD, FULL):
        raise ValueError(f"mode must be one of {(BACKWARD, FORWARD, FULL)}, not {mode!r}")
    versions = sorted(earlier) if all_versions else sorted(earlier)[-1:]
    found = {}
    for version in versions:
        problems = [] if mode == FORWARD else resolution_problems(earlier[version], new)
        if mode != BACKWARD:
            problems = problems + resolution_problems(new, earlier[version])
        if problems:
            found[version] = problems
    return found


def _as(wanted: ContractField, given: ContractField | None, value: Column | None) -> Column:
    if given is None or value is None:
        return F.lit(wanted.default).cast(wanted.data_type)
    return value.cast(wanted.data_type)


def read_as(df: DataFrame, writer: Contract, reader: Contract) -> DataFrame:
    """Rows of a writer's columns in the reader's; other columns are left out."""
    problems = resolution_problems(writer, reader)
    if problems:
        raise ContractError("; ".join(problems))
    columns = []
    for wanted in reader.fields:
        given = writer.find(wanted)
        columns.append(_as(wanted, given, F.col(f"`{given.name}`") if given else None).alias(wanted.name))
    return df.select(*columns)


def read_versions(
    records: DataFrame, versions: dict[int, Contract], reader: Contract, value: str = "value", version: str = "version"
) -> DataFrame:
    """JSON records, each written under the version it names, in the reader's fields.

    The frame's other columns stay, but for those that are named like a field. `contractProblem` comes last:
    null, or why a record does not keep its contract (an unknown or missing version, no JSON object, a field
    that is not of its type, a required one that is null); its fields are then what could be read. A default stands for a field that the writer's
    contract lacks, not for one that a record leaves out. Each record is parsed once, under its version.
    """
    for number, writer in versions.items():
        problems = resolution_problems(writer, reader)
        if problems:
            raise ContractError(f"version {number}: " + "; ".join(problems))
    clash = set(records.columns) & {f.name for f in reader.fields}
    others = [F.col(f"`{c}`") for c in records.columns if c not in clash and c not in (value, version)]
    text, number = F.col(value).cast("string"), F.col(version)

    def resolved(writer: Contract) -> Column:
        # nullable, so that a missing required field is seen here instead of trusted
        schema = T.StructType([T.StructField(f.name, f.data_type, True) for f in writer.fields]).add(_UNREAD, "string")

        def fields(written: Column) -> Column:
            missing = [
                F.when(written.getField(f.name).isNull(), F.lit(f"required field {f.name} is null")) for f in writer.fields if not f.nullable
            ]
            no_object = F.when(~F.coalesce(F.ltrim(text).startswith("{"), F.lit(False)) | written.isNull(), F.lit("not a JSON object"))
            unread = F.when(written.getField(_UNREAD).isNotNull(), F.lit("malformed JSON, or a field that is not of its type"))
            pairs = [(wanted, writer.find(wanted)) for wanted in reader.fields]
            members = [_as(w, g, written.getField(g.name) if g else None).alias(w.name) for w, g in pairs]
            return F.struct(*members, F.coalesce(no_object, unread, *missing, F.lit(None).cast("string")).alias(PROBLEM))

        return F.transform(F.array(F.from_json(text, schema, {"columnNameOfCorruptRecord": _UNREAD})), fields)[0]

    unknown = F.struct(
        *[F.lit(None).cast(f.data_type).alias(f.name) for f in reader.fields],
        F.concat(F.lit("no contract for version "), F.coalesce(number.cast("string"), F.lit("null"))).alias(PROBLEM),
    )
    cases = reduce(lambda made, v: made.when(number == v, resolved(versions[v])), versions, F.when(F.lit(False), unknown))
    # one element above the parse keeps Spark from copying it into every field
    read = records.select(*others, F.explode(F.array(cases.otherwise(unknown))).alias("_read"))
    return read.select(*others, "_read.*")
