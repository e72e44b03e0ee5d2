"""Strict, closed-world JSON contracts, evaluated with built-in functions.

``from_json`` ignores unknown keys and turns a missing key into NULL, so it
cannot enforce a closed contract by itself.  Instead each JSON object is
read as ``map<string,string>`` (keys + raw value text), its key set is
compared with the allowed set, and nested arrays are walked with
``transform`` over ``from_json(..., array<string>)``.  The result is an
``array<string>`` of violations per document: empty means the payload
honours the contract.  All of it is JVM-side column expressions; nothing is
collected and no Python runs per row.

Coercion follows the reference's lax mode: an ``int`` accepts ``89``,
``89.0`` and ``"89"`` but not ``89.5`` or ``true``.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halfhourly.functions.columns import parse_iso_utc, parse_naive_utc, wire_bool, wire_int, wire_number
from halfhourly.schemas import INTENSITY_BANDS, MIX_WIRE_FUELS, MIX_WIRE_PERC, MIX_WIRE_ROLLUPS

MAP = T.MapType(T.StringType(), T.StringType())
ARR = T.ArrayType(T.StringType())

#: Leaf kinds and the parsers that decide them: a value whose parse is NULL violates the
#: contract, so the check accepts exactly what ``payloads`` can read.
PARSERS = {
    "int": wire_int,
    "long": lambda s: wire_int(s, "bigint"),
    "number": wire_number,
    "bool": wire_bool,
    "instant": parse_iso_utc,
    "naive": parse_naive_utc,
    "string": None,
}


@dataclass
class Leaf:
    kind: str                      # key of PARSERS
    nullable: bool = False
    required: bool = True
    enum: list[str] | None = None


@dataclass
class Obj:
    fields: dict[str, object]
    open: bool = False             # True: unknown keys allowed (envelopes)
    nullable: bool = False
    required: bool = True


@dataclass
class Arr:
    item: object
    nullable: bool = False
    required: bool = True


def _msg(path: Column, text: str) -> Column:
    return F.array(F.concat(path, F.lit(text)))


def _empty() -> Column:
    return F.array().cast(ARR)


def _cat(parts: list[Column]) -> Column:
    return F.concat(*[F.coalesce(p, _empty()) for p in parts]) if parts else _empty()


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, evaluated once: nothing is shared between the branches of an expression
    inside a lambda, so a value that many checks look at is bound to a lambda variable first."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _check_value(spec, v: Column, path: Column) -> Column:
    """Violations of one JSON value given as raw text (NULL = JSON null)."""
    if isinstance(spec, Obj):
        return F.when(v.isNull(), _empty()).otherwise(_check_object(spec, v, path))
    if isinstance(spec, Arr):
        def elements(arr: Column) -> Column:
            def check(x, i):
                at = F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
                if isinstance(spec.item, Obj):
                    return _check_object(spec.item, x, at)
                return _check_value(spec.item, x, at)
            return _cat([F.when(arr.isNull(), _msg(path, ": not an array")), F.flatten(F.transform(arr, check))])
        return F.when(v.isNull(), _empty()).otherwise(_let(F.from_json(v, ARR), elements))
    parse = PARSERS[spec.kind]
    parts = []
    if parse is not None:
        parts.append(F.when(parse(v).isNull(), _msg(path, f": not {spec.kind}")))
    if spec.enum is not None:
        parts.append(F.when(~v.isin(*spec.enum), _msg(path, ": not an accepted value")))
    return F.when(v.isNull(), _empty()).otherwise(_cat(parts))


def _check_field(sub, m: Column, name: Column, path: Column) -> Column:
    """Violations of the field ``name`` of a parsed object."""
    at, present = F.concat(path, F.lit("."), name), F.map_contains_key(m, name)

    def check(v: Column) -> Column:
        own = []
        if sub.required:
            own.append(F.when(v.isNull() & ~present, _msg(at, ": missing key")))
        if not sub.nullable:
            own.append(F.when(v.isNull() & present, _msg(at, ": null")))
        return _cat([*own, _check_value(sub, v, at)])
    return _let(F.try_element_at(m, name), check)


def _check_object(spec: Obj, text: Column, path: Column) -> Column:
    """Violations of a JSON object given as raw text (NULL = no document)."""
    def fields(m: Column) -> Column:
        parts = [F.when(m.isNull(), _msg(path, ": not an object"))]
        if not spec.open:
            unknown = F.array_except(F.map_keys(m), F.array(*[F.lit(k) for k in spec.fields]))
            parts.append(F.transform(unknown, lambda k: F.concat(path, F.lit("."), k, F.lit(": unknown key"))))
        # neighbouring leaves of one kind are one check over their names, so a wide record stays a small expression
        for _, group in groupby(spec.fields.items(), key=lambda f: repr(f[1]) if isinstance(f[1], Leaf) else f[0]):
            names, subs = zip(*group, strict=True)
            if len(names) == 1:
                parts.append(_check_field(subs[0], m, F.lit(names[0]), path))
            else:
                parts.append(F.flatten(F.transform(F.array(*[F.lit(n) for n in names]),
                                                   lambda n: _check_field(subs[0], m, n, path))))
        return _cat(parts)
    return F.when(text.isNull(), _msg(path, ": null document")).otherwise(_let(F.from_json(text, MAP), fields))


def violations(text: Column, spec: Obj) -> Column:
    """``array<string>`` of contract violations of a JSON document column."""
    return _check_object(spec, text, F.lit("$"))


def split_contract(payloads: DataFrame, spec: Obj, col: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): quarantine rows carry ``violations``.  Both come from
    one cached evaluation only if the caller caches; each side is a filter."""
    checked = payloads.withColumn("violations", violations(F.col(col), spec))
    good = checked.filter(F.size("violations") == 0).drop("violations")
    bad = checked.filter(F.size("violations") > 0)
    return good, bad


def props_contract(df: DataFrame, allowed: list[str], required: list[str], id_col: str,
                   col: str = "props") -> DataFrame:
    """Per row: ``contract_ok`` and the first ``reason`` (malformed,
    unknown_key, missing_key) for a flat JSON object column."""
    m = F.from_json(F.col(col), MAP)          # one parse per document
    keys = F.map_keys(m)
    unknown = F.size(F.array_except(keys, F.array(*[F.lit(k) for k in allowed]))) > 0
    missing = F.lit(False)
    for k in required:
        missing = missing | F.try_element_at(m, F.lit(k)).isNull()
    reason = (F.when(keys.isNull(), F.lit("malformed"))
              .when(unknown, F.lit("unknown_key"))
              .when(missing, F.lit("missing_key")))
    return df.select(F.col(id_col), reason.isNull().alias("contract_ok"), reason.alias("reason"))


# ---------------------------------------------------------------------------
# The wire contracts.  Fixed values: field names and nesting as the feeds send them.
# ---------------------------------------------------------------------------

BAND = Leaf("string", enum=INTENSITY_BANDS)

NATIONAL = Obj({"data": Arr(Obj({
    "from": Leaf("instant"), "to": Leaf("instant"),
    "intensity": Obj({"forecast": Leaf("int"), "actual": Leaf("int", nullable=True), "index": BAND}),
}))})

REGIONAL = Obj({"data": Arr(Obj({
    "from": Leaf("instant"), "to": Leaf("instant"),
    "regions": Arr(Obj({
        "regionid": Leaf("int"), "dnoregion": Leaf("string"), "shortname": Leaf("string"),
        "intensity": Obj({"forecast": Leaf("int"), "index": BAND}),
        "generationmix": Arr(Obj({"fuel": Leaf("string"), "perc": Leaf("number")})),
    })),
}))})

_MIX_RECORD = {"_id": Leaf("long"), "DATETIME": Leaf("naive")}
_MIX_RECORD.update({w: Leaf("number") for w, _ in MIX_WIRE_FUELS})
_MIX_RECORD.update({w: Leaf("number") for w in MIX_WIRE_ROLLUPS})
_MIX_RECORD.update({w: Leaf("number") for w in MIX_WIRE_PERC})

GENERATION_MIX = Obj({
    "success": Leaf("bool"),
    "result": Obj({"records": Arr(Obj(_MIX_RECORD)),
                   "total": Leaf("long", nullable=True, required=False)}, open=True),
}, open=True)

PRICES = Obj({
    "count": Leaf("long"), "next": Leaf("string", nullable=True), "previous": Leaf("string", nullable=True),
    "results": Arr(Obj({
        "value_exc_vat": Leaf("number"), "value_inc_vat": Leaf("number"),
        "valid_from": Leaf("instant"), "valid_to": Leaf("instant"),
        "payment_method": Leaf("string", nullable=True),
    })),
})

CONTRACTS = {"national": NATIONAL, "regional": REGIONAL, "generation_mix": GENERATION_MIX,
             "prices": PRICES}
