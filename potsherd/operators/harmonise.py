"""Harmonising differently shaped source tables into one store of entities.

A source row keeps its columns in ``data`` (map<string,string>). What becomes of it is a declaration: which tables feed an
entity, and from which source columns each attribute takes the first value that is there.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potsherd.functions.values import SENTINELS


@dataclass(frozen=True)
class Entity:
    """How an entity is read: tables (patterns, any case) to include and to ignore, attributes with their source columns in
    order of preference (a text is a constant), the entity whose attributes it inherits, and constants of its own."""

    soort: str
    include: tuple[str, ...]
    ignore: tuple[str, ...] = ()
    attributes: dict[str, tuple[str, ...] | str] = field(default_factory=dict)
    inherits: Entity | None = None
    constants: dict[str, str] = field(default_factory=dict)
    artefact: bool = False

    def all_attributes(self) -> dict[str, tuple[str, ...] | str]:
        """Inherited attributes first; an own one of the same name wins."""
        return (self.inherits.all_attributes() if self.inherits else {}) | self.attributes


def routed(name: Column, include: Iterable[str], ignore: Iterable[str] = ()) -> Column:
    """Whether a table's name has one of the patterns in it and none of the ignored; without patterns none fits."""
    fits = F.lit(False)
    for pattern in include:
        fits = fits | name.rlike(f"(?i){pattern}")
    for pattern in ignore:
        fits = fits & ~name.rlike(f"(?i){pattern}")
    return F.coalesce(fits, F.lit(False))


def first_of(source: Column, names: tuple[str, ...] | str) -> Column:
    """The first of a source row's columns that has a value; a text is a constant, no names are null."""
    if isinstance(names, str):
        return F.lit(names)
    return F.coalesce(*[source[n] for n in names]) if names else F.lit(None).cast("string")


def harmonised(rows: DataFrame, entity: Entity) -> DataFrame:
    """The rows of ``entity``: its attributes, soort, the lineage columns, and the source row as ``brondata``."""
    lineage = [c for c in ("_id", "_seq", "table", "projectcd", "bron", "loadtime", "mdbfile") if c in rows.columns and c not in entity.all_attributes()]
    values = {name: first_of(F.col("data"), names) for name, names in entity.all_attributes().items()}
    values |= {name: F.lit(v) for name, v in entity.constants.items()}
    if entity.artefact:
        values |= {"artefactsoort": F.lit(entity.soort), "soort": F.lit("Artefact")}
    else:
        values |= {"soort": F.lit(entity.soort)}
    mine = rows.where(routed(F.col("table"), entity.include, entity.ignore))
    return mine.select(*lineage, *[v.alias(n) for n, v in values.items()], F.map_concat("data", F.create_map(F.lit("table"), F.col("table"), F.lit("projectcd"), F.col("projectcd"))).alias("brondata"))


def store(rows: DataFrame, entities: Iterable[Entity]) -> DataFrame:
    """All entities in one sparse table."""
    out: DataFrame | None = None
    for entity in entities:
        part = harmonised(rows, entity)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no entities")
    return out


def fresh_id(*parts: Column) -> Column:
    """An identifier that the same row gets in every run."""
    return F.sha2(F.concat_ws(":", *parts), 256)


def without_sentinels(df: DataFrame, names: Iterable[str] | None = None, values: tuple[str, ...] = SENTINELS) -> DataFrame:
    """Text columns with null in place of what stands for no value, number columns with null in place of NaN, maps without such entries."""
    chosen = set(df.columns if names is None else names)
    out = []
    for c, kind in df.dtypes:
        value = F.col(f"`{c}`")
        if c in chosen and kind == "string":
            value = F.when(~value.isin(*values), value)
        elif c in chosen and kind in ("double", "float"):
            value = F.when(~F.isnan(value), value)
        elif c in chosen and kind == "map<string,string>":
            value = F.map_filter(value, lambda _, v: v.isNotNull() & ~v.isin(*values))
        out.append(value.alias(c))
    return df.select(*out)


def sample_project_codes(samples: DataFrame, codes: DataFrame, default: str = "Unknown") -> DataFrame:
    """``samples`` with projectcd looked up by ``project``.

    ``codes`` has project, projectcd and _seq; a code also stands for itself. Of several entries for a project the first by
    _seq counts, an entry of the list before a code for itself; a project without any gets ``default``.
    """
    listed = codes.select(F.col("project").alias("p"), F.col("projectcd").alias("code"), F.lit(0).alias("rank"), "_seq")
    own = codes.select(F.col("projectcd").alias("p"), F.col("projectcd").alias("code"), F.lit(1).alias("rank"), "_seq")
    lookup = listed.unionByName(own).where("p IS NOT NULL").groupBy("p").agg(F.min(F.struct("rank", "_seq", "code")).alias("best")).select("p", "best.code")
    joined = samples.join(lookup, F.col("project") == F.col("p"), "left")
    return joined.select(*[c for c in samples.columns if c != "projectcd"], F.coalesce("code", F.lit(default)).alias("projectcd"))


def toponym_name(name: Column, toponym: Column) -> Column:
    """The project's name or, where it has none, its toponym in title case."""
    from potsherd.functions.values import title_case

    return F.when(F.coalesce(F.trim(name), F.lit("")) == "", title_case(toponym)).otherwise(name)
