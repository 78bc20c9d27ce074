"""CAT-1..4.  File names, templates and series ids as Columns."""

from __future__ import annotations

import re
from functools import lru_cache, reduce
from operator import add, and_
from typing import NamedTuple

from pyspark.sql import Column, functions as F

from tidewell.schema import DEFAULT_SUBLOC, col

RAW_TEMPLATE = "{source}_{station_id@subloc}_{agency_id}_{param@modifier}_{syear}_{eyear}.csv"
YEAR_TEMPLATE = "{source}_{station_id@subloc}_{agency_id}_{param@modifier}_{year}.csv"
PLAIN_TEMPLATE = "{source}_{station_id@subloc}_{agency_id}_{param@modifier}.csv"
TEMPLATES = (RAW_TEMPLATE, YEAR_TEMPLATE, PLAIN_TEMPLATE)
FIELDS = ("source", "station_id", "subloc", "agency_id", "param", "modifier", "year", "syear", "eyear")
SHARD_FIELDS = frozenset(("year", "syear", "eyear"))


class Slot(NamedTuple):
    """One field of a name: the text before it, and the field that may follow it
    after an ``@``."""

    lead: str
    field: str
    extra: str | None

    @property
    def is_shard(self) -> bool:
        return self.field in SHARD_FIELDS

    def expression(self) -> str:
        """The slot as a regular expression with one group, or two with an extra."""
        body = r"(\d{4})" if self.is_shard else "([A-Za-z0-9]+)"
        return re.escape(self.lead) + body + ("(?:@([A-Za-z0-9_]+))?" if self.extra else "")

    def fields(self) -> list[str]:
        return [self.field, self.extra] if self.extra else [self.field]


class Template(NamedTuple):
    """A name as slots and an ending; everything else is derived from these."""

    slots: tuple[Slot, ...]
    ending: str

    def expression(self) -> str:
        return "^" + "".join(s.expression() for s in self.slots) + re.escape(self.ending) + "$"

    def groups(self) -> dict[str, int]:
        return {f: i for i, f in enumerate((f for s in self.slots for f in s.fields()), 1)}

    def without_shard(self) -> Template:
        return Template(tuple(s for s in self.slots if not s.is_shard), self.ending)


@lru_cache(maxsize=64)
def template(text: str) -> Template:
    """``{field}`` and ``{field@extra}`` between literal text."""
    *parts, ending = re.split(r"\{([^}]+)\}", text)
    pairs = zip(parts[::2], parts[1::2], strict=True)
    return Template(tuple(Slot(lead, *(name.split("@", 1) if "@" in name else (name, None))) for lead, name in pairs), ending)


def parse_name(name, templates=TEMPLATES, strict=True) -> Column:
    """CAT-1.  A struct of all fields; the first template that matches wins.  No
    match is an error, or NULL fields when not ``strict``.

    Each template rewrites the name to one text of all fields in fixed order, so
    a name costs one match per template, not one per field."""
    n = F.regexp_extract(col(name), r"[^/\\]+$", 0)
    sep = "\u0001"
    out = None
    for t in templates:
        rx, groups = template(t).expression(), template(t).groups()
        fixed = F.regexp_replace(n, rx, sep.join(f"${groups[f]}" if f in groups else "" for f in FIELDS))
        out = F.when(n.rlike(rx), fixed) if out is None else out.when(n.rlike(rx), fixed)
    if strict:
        out = out.otherwise(F.raise_error(F.concat(F.lit("no template matches "), n)).cast("string"))
    parts = F.split(out, sep, -1)
    fields = [F.nullif(F.element_at(parts, i + 1), F.lit("")) for i in range(len(FIELDS))]
    k = FIELDS.index("subloc")
    fields[k] = F.when(out.isNotNull(), F.coalesce(fields[k], F.lit(DEFAULT_SUBLOC)))
    return F.struct(*[c.alias(f) for c, f in zip(fields, FIELDS)])


def _given(c: Column) -> Column:
    return c.isNotNull() & ~c.isin(DEFAULT_SUBLOC, "none", "")


def _worth(slot: Slot, fields: dict[str, Column]) -> Column:
    """Points of a filled slot: a given extra is worth another one."""
    return 1 + _given(fields[slot.extra]).cast("int") if slot.extra in fields else F.lit(1)


def _filled(slot: Slot, fields: dict[str, Column]) -> Column:
    text = F.concat(F.lit(slot.lead), fields[slot.field].cast("string"))
    return F.concat(text, F.when(_given(fields[slot.extra]), F.concat(F.lit("@"), fields[slot.extra])).otherwise("")) if slot.extra in fields else text


def render_name(fields: dict[str, Column], templates=TEMPLATES, include_shard=True) -> Column:
    """CAT-2.  File name by the template worth most of those whose fields are all
    there; then by more slots, then by order."""
    forms = [template(t) if include_shard else template(t).without_shard() for t in templates]
    offers = []
    for rank, form in enumerate(forms):
        if all(s.field in fields for s in form.slots):
            there = reduce(and_, (fields[s.field].isNotNull() for s in form.slots))
            worth = reduce(add, (_worth(s, fields) for s in form.slots))
            name = F.concat(*(_filled(s, fields) for s in form.slots), F.lit(form.ending))
            offers.append(F.when(there, F.struct(worth.alias("worth"), F.lit(len(form.slots)).alias("slots"), F.lit(-rank).alias("rank"), name.alias("name"))))
    none = F.raise_error(F.lit("no template fits the metadata")).cast("string")
    return F.coalesce(F.array_max(F.array_compact(F.array(*offers)))["name"], none) if offers else none


def wildcard_name(name, provider=False) -> Column:
    """CAT-3.  Year or year-range suffix to ``*``; the provider slot too if asked."""
    n = F.regexp_replace(col(name), r"_\d{4}_\d{4}\.", "_*.")
    n = F.regexp_replace(n, r"_\d{4}\.", "_*.")
    return F.regexp_replace(n, r"^[^_]+_", "*_") if provider else n


def series_id(fields: dict[str, Column], data_key=("station_id", "subloc", "param", "modifier"), provider: str | None = None) -> Column:
    """CAT-4.  Key parts joined by a pipe; default sublocation and modifier are
    left out, a missing key part is an error."""
    parts = [fields[provider]] if provider else []
    for k in data_key:
        c = fields[k]
        if k in ("subloc", "modifier"):
            parts.append(F.when(_given(c), c))
        else:
            parts.append(F.coalesce(c, F.raise_error(F.lit(f"series key {k} is missing")).cast("string")))
    return F.concat_ws("|", *parts)
