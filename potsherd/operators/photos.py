"""What the folders of photos tell: their project, their sort, and the material of objects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from potsherd.functions import files


def folder_facts(directories: DataFrame, projects: DataFrame, directory: str = "directory", code: str = "projectcd") -> DataFrame:
    """(directory, projectcd, fotosoort, materiaal) of each different directory.

    A folder's names are cut at slashes and blanks; of several that are project codes the last, innermost one counts.
    """
    each = directories.where(F.col(directory).isNotNull()).select(F.col(directory).alias("directory")).distinct()
    names = each.select("directory", F.posexplode(files.directory_tokens(F.col("directory"))).alias("place", "name"))
    codes = projects.where(F.col(code).isNotNull()).select(F.col(code).alias("name")).distinct()
    inner = names.join(codes, "name").groupBy("directory").agg(F.max_by("name", "place").alias("projectcd"))
    return each.join(inner, "directory", "left").select("directory", "projectcd", files.photo_kind(F.col("directory")).alias("kind")).select("directory", "projectcd", "kind.*")


def with_folder_facts(photos: DataFrame, projects: DataFrame, directory: str = "directory", code: str = "projectcd") -> DataFrame:
    """Photos with the project that their folder names, where they have none, and with fotosoort and materiaal of their folder.

    Folders are far fewer than photos: names meet projects once per folder. Photos without a folder stay as they are.
    """
    facts = folder_facts(photos, projects, directory, code).select(F.col("directory").alias("_directory"), F.col("projectcd").alias("_code"), F.col("fotosoort").alias("_sort"), F.col("materiaal").alias("_material"))
    met = photos.join(facts, F.col(directory) == F.col("_directory"), "left")
    known = lambda c: F.col(c) if c in photos.columns else F.lit(None).cast("string")
    told = F.col("_directory").isNotNull()
    new = {
        code: F.coalesce(F.nullif(known(code), F.lit("")), F.col("_code")),
        "fotosoort": F.when(told, F.col("_sort")).otherwise(known("fotosoort")),
        "materiaal": F.when(told, F.col("_material")).otherwise(known("materiaal")),
    }
    return met.select(*[new.pop(c).alias(c) if c in new else F.col(c) for c in photos.columns], *[c.alias(n) for n, c in new.items()])
