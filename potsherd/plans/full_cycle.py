"""The whole cycle: staging rows become clean, linked, typed tables.

Each phase is a function from DataFrame to DataFrame over one store of all entities, told apart by ``soort``. ``run`` writes
the store after each phase as Parquet by ``soort``, so that any phase can be run again from the one before it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from potsherd.functions import dating, geo, values
from potsherd.operators import harmonise, keys, merge, photos, references
from potsherd.plans import model
from potsherd.sources import tables, versions


def column(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def enhance(store: DataFrame, parser: dating.Phrases | None = None, strict_reference: bool = False) -> DataFrame:
    """Codes, numbers, flags, dates and coordinates cleaned; datings read; artefact kinds told by type codes."""
    df = harmonise.without_sentinels(store, [c for c in store.columns if c not in ("brondata", "_id", "table")])
    have = set(df.columns)
    new: dict[str, Column] = {}
    if "projectcd" in have:
        new["projectcd"] = values.project_code(F.col("projectcd"))
    if {"projectnaam", "toponiem"} <= have:
        new["projectnaam"] = harmonise.toponym_name(F.col("projectnaam"), F.col("toponiem"))
    new |= {c: values.clean_label(F.col(c)) for c in model.LABELS if c in have}
    if "tekeningcd" in have:
        new["tekeningcd"] = values.drawing_code(F.col("tekeningcd"))
    if "rapportnr" in have:
        new["rapportnr"] = values.report_number(F.col("rapportnr"), values.report_prefix(F.col("brondata")))
    if "typecd" in have and "artefactsoort" in have:
        new["artefactsoort"] = F.when(F.col("soort") == "Artefact", F.coalesce(values.artefact_kind(F.col("typecd")), F.col("artefactsoort"))).otherwise(F.col("artefactsoort"))
    ints = [c for c in model.INTS if c in have and not (strict_reference and c == "spoordatering_tot")]
    new |= {c: values.to_int(F.col(c)) for c in ints}
    new |= {c: values.to_int(F.col(c), keep=True) for c in model.LOOSE_INTS if c in have}
    new |= {c: values.to_flag(F.col(c)) for c in model.FLAGS if c in have}
    new |= {c: values.to_date(F.col(c)) for c in model.DATES if c in have}
    df = df.withColumns(new)
    if {"xcoor_rd", "ycoor_rd"} <= have:
        x, y = F.col("xcoor_rd").try_cast("double"), F.col("ycoor_rd").try_cast("double")
        df = df.withColumns({"xcoor_rd": x, "ycoor_rd": y}).withColumn("location", geo.location(F.col("xcoor_rd"), F.col("ycoor_rd")))
        df = df.withColumns({"longitude": F.col("location.lon"), "latitude": F.col("location.lat")})
    for source, target in model.DATINGS.items():
        if source in have:
            known = {f"{target}_{end}": column(df, f"{target}_{end}") for end in ("vanaf", "tot")}
            kept = df.withColumns({f"_{n}": c for n, c in known.items()})
            read = dating.dated(kept, source, target, parser, strict_reference)
            explicit = F.col(f"_{target}_vanaf").isNotNull()
            df = read.withColumns({n: F.when(explicit, F.col(f"_{n}").cast("int")).otherwise(F.col(n)) for n in known}).drop(*[f"_{n}" for n in known])
    return df


def with_folders(store: DataFrame) -> DataFrame:
    """Photos with what their folders tell, if the store has folders and projects."""
    if not {"directory", "projectcd"} <= set(store.columns):
        return store
    photo = F.coalesce(F.col("soort") == "Foto", F.lit(False))
    placed = photos.with_folder_facts(store.where(photo), store.where("soort = 'Project'"))
    return store.where(~photo).unionByName(placed, allowMissingColumns=True)


def with_key_flags(store: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Projects that use a find number in several pits get ``vondstkey_met_putnr``."""
    if not {"projectcd", "vondstnr", "putnr"} <= set(store.columns):
        return store.withColumn("vondstkey_met_putnr", F.lit(False))
    several = references.several_parents(store, ["projectcd", "vondstnr"], "putnr", strict_reference).select(F.col("projectcd").alias("_p")).distinct()
    flagged = store.drop("vondstkey_met_putnr").join(several, F.col("projectcd") == F.col("_p"), "left")
    return flagged.withColumn("vondstkey_met_putnr", F.col("_p").isNotNull()).drop("_p")


def with_all_keys(store: DataFrame) -> DataFrame:
    """Each entity's own key and those of what it refers to, by its declaration."""
    names = sorted({n for s in model.SPECS for n in s.patterns()})
    fields = {getattr(x, "segment", x).field for s in model.SPECS for p in s.patterns().values() for x in keys.parse(p)}
    df = store.withColumns({c: F.lit(None).cast("string") for c in sorted(fields) if c not in store.columns})
    new = {}
    for name in names:
        built = [F.when(F.col("soort") == s.soort, keys.build(*keys.parse(s.patterns()[name]))) for s in model.SPECS if name in s.patterns()]
        new[name] = F.coalesce(*built, column(store, name))
    return df.withColumns(new).drop(*[c for c in fields if c not in store.columns])


def move_and_merge(store: DataFrame, excluded_tables: Iterable[str] = (), excluded_projects: Iterable[str] = (), null_keys: bool = False) -> DataFrame:
    """Duplicates merged where an entity says so, all others moved as they are."""
    lineage = [c for c in ("projectcd", "table") if c in store.columns]
    df = store.withColumns({f"_{c}": F.col(c) for c in lineage})
    merged: list[DataFrame] = []
    merging = [s for s in model.SPECS if s.merge_by]
    for spec in merging:
        rows = df.where(F.col("soort") == spec.soort)
        if spec.soort == "Artefact":
            rows = rows.where(merge.to_merge(excluded_tables, excluded_projects))
        out = merge.merge_duplicates(rows, list(spec.merge_by), "_seq", [f"_{c}" for c in lineage], "brondata", null_keys)
        merged.append(out)
    rest = df.where(~F.col("soort").isin([s.soort for s in merging]) | ((F.col("soort") == "Artefact") & merge.to_move(excluded_tables, excluded_projects)))
    moved = rest.withColumns({"lineage": F.array(F.struct(*[f"_{c}" for c in lineage])), "brondata": F.array("brondata"), "brondata_count": F.lit(1)}).drop(*[f"_{c}" for c in lineage])
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), merged, moved)
    filed = F.col("soort").isin(*model.FILES)
    kind = F.when(filed, F.coalesce(column(out, "bestandsoort"), F.col("soort")))
    named = out.withColumn("bestandsoort_oud", F.when(filed, F.col("soort"))).withColumn("bestandsoort", kind).withColumn("soort", F.when(filed, "Bestand").otherwise(F.col("soort")))
    return merge.with_default(named, "artefactsoort", "Onbekend") if "artefactsoort" in named.columns else named


def with_missing(clean: DataFrame, store: DataFrame, strict_reference: bool = False) -> DataFrame:
    """``clean`` with a generated row for each pit, layer, trace, find and box that is referred to but not there."""
    out = clean
    for spec in model.SPECS:
        if spec.missing and {*spec.missing} - {"vondstkey_met_putnr"} <= set(store.columns) and spec.key:
            rows = store.withColumn("vondstkey_met_putnr", F.lit(False)) if "vondstkey_met_putnr" not in store.columns else store
            made = merge.generate_missing(rows, clean, list(spec.missing), keys.build(*keys.parse(spec.key)), spec.soort, spec.not_zero, strict_reference)
            refs = {f"key_{n}": keys.build(*keys.parse(p)) for n, p in spec.references.items() if {getattr(x, "segment", x).field for x in keys.parse(p)} <= set(spec.missing)}
            # they come last, dealt over a wide range of numbers
            place = F.lit(1 << 62) + F.pmod(F.xxhash64("key"), F.lit(1 << 44))
            last = made.withColumns(refs).withColumns({"_seq": place, "_id": F.concat_ws(":", F.lit("generated"), "soort", "key")})
            out = out.unionByName(last.dropDuplicates(["key"]), allowMissingColumns=True)
    return out


def numbered(clean: DataFrame, registry: str | None = None, load: int = 0) -> DataFrame:
    """``ID`` of every row: its place within its soort, from 0 on; entries of a thesaurus keep their own number.

    With a ``registry`` keys keep the number that an earlier ``load`` gave them, and only new ones get one.
    """
    own = "primary_key" if "primary_key" in clean.columns else None
    if registry is None:
        return keys.with_surrogates(clean, "soort", "_seq", own)
    known = keys.with_registered(clean, registry, load)
    return known.withColumn("ID", F.coalesce(F.col(own).cast("bigint"), F.col("ID"))) if own else known


def linked(clean: DataFrame) -> DataFrame:
    """All references resolved in one pass; those to an artefact first by pit, find and subnr, then by subnr where that is unique."""
    return references.set_all(clean, [references.Rule(*r) for r in model.REFERENCES])


def published(clean: DataFrame, declared: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The typed tables by soort."""
    return {soort: tables.conformed(clean.where(F.col("soort") == soort), ddl) for soort, ddl in (declared or model.DECLARED).items()}


def run(spark: SparkSession, staging: DataFrame, entities: Iterable[harmonise.Entity], path: str, start: str = "harmonise", stop: str = "load", strict_reference: bool = False, registry: str | None = None, load: int = 0) -> DataFrame:
    """Run the phases from ``start`` to ``stop``; each reads what the one before it wrote below ``path``, and the last store is returned.

    The typed tables are published together below ``path/load`` (``versions.published``). For ``registry`` and ``load`` see ``numbered``.
    """

    def stored(name: str) -> DataFrame:
        return spark.read.parquet(f"{path}/{name}")

    phases: list[tuple[str, Callable[[], DataFrame]]] = [
        ("harmonise", lambda: harmonise.store(staging, entities)),
        ("enhance", lambda: with_folders(enhance(stored("harmonise"), strict_reference=strict_reference))),
        ("keys", lambda: with_all_keys(with_key_flags(stored("enhance"), strict_reference))),
        ("merge", lambda: with_missing(move_and_merge(stored("keys"), null_keys=strict_reference), stored("keys"), strict_reference)),
        ("references", lambda: linked(numbered(stored("merge"), registry, load))),
    ]
    names = [n for n, _ in phases] + ["load"]
    if start not in names or stop not in names:
        raise ValueError(f"phases are {', '.join(names)}")
    for name, phase in phases:
        if names.index(start) <= names.index(name) <= names.index(stop):
            # a column that no row ever has is left out: Parquet has no type for it
            out = phase()
            out = out.drop(*[c for c, kind in out.dtypes if kind == "void"])
            out.write.mode("overwrite").partitionBy("soort").parquet(f"{path}/{name}")
    if stop == "load":
        versions.publish({f"Def_{soort}": df for soort, df in published(stored("references")).items()}, f"{path}/load")
    return stored(min(stop, "references", key=names.index))
