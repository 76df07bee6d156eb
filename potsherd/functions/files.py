"""What the names of photo, drawing and report files tell, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from potsherd.functions.values import bind, padded

# The shapes of file names.
OBJECT_PHOTO = r"(?i)^([a-zA-Z0-9]+)(_B?P([0-9Xx]+))?_H([a-zA-Z0-9]+)(_([a-zA-Z0-9]+))?_([0-9Xx]+)\.[a-z]{3}$"
DRAWING = r"(?i)^([a-zA-Z0-9]+)_([ABCDEPT])([a-zA-Z0-9]+)(_LZW)?\.[a-z]{3}$"
PROJECT_PHOTO = r"(?i)^([a-zA-Z0-9]+)_([FG])([a-zA-Z0-9]+).*\.[a-z]{3}$"
REPORT = r"(?i)^(DAN|DAR)\s*([0-9]{2,3})"
#: Kinds of drawings and project photos by their letter.
DRAWINGS = {
    "A": "Bouwtekeningen_Topografie_Geologie",
    "B": "Veldtekeningen",
    "C": "Overzichtstekeningen",
    "D": "Objecttekening_op_millimeter_papier_of_film",
    "E": "Uitwerkingstekeningen",
    "P": "Veldtekening_Publiceerbaar",
    "T": "Objecttekening_publiceerbaar",
}
PHOTOS = {"F": "Sfeerfoto", "G": "Opgravingsfoto"}
#: Artefact kinds and the words of a path that tell them, in order of precedence.
MATERIALS = (
    ("Bouwaardewerk", ("bouwaardewerk",)),
    ("Aardewerk", ("aardewerk",)),
    ("Aardewerk", ("pijpaard",)),
    ("Menselijk_Bot", ("bot", "menselijk")),
    ("Dierlijk_Bot", ("bot", "dierlijk")),
    ("Glas", ("glas",)),
    ("Leer", ("leer",)),
    ("Steen", ("steen",)),
    ("Kleipijp", ("kleipijp",)),
    ("Hout", ("hout/",)),
    ("Metaal", ("metaal",)),
    ("Munt", ("munt",)),
    ("Schelp", ("schelp",)),
    ("Textiel", ("textiel",)),
)

FIELDS = ("soort", "fototype", "bestandsoort", "projectcd", "putnr", "vondstnr", "subnr", "fotonr", "tekeningcd", "rapportnr", "artefactsoort")


def base_name(path: Column) -> Column:
    """The last segment of a path with slashes of either kind."""
    return F.element_at(F.split(path, r"[/\\]"), -1)


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"(\.[^./\\]+)$", 1))


def single_extension(name: Column) -> Column:
    """``x.jpg.jpg`` as ``x.jpg``: of two extensions the last one goes."""
    return F.regexp_replace(name, r"^(.*[^./\\]\.[^./\\]+)\.[^./\\]+$", "$1")


def no_zeros(value: Column) -> Column:
    return F.regexp_replace(value, "^0+", "")


def project_of(name: Column, directory: Column) -> Column:
    """The leading letters and digits of the name; if these are no project, the project that the directory begins with, if any."""
    own = F.regexp_extract(name, r"(?i)^([a-z0-9]+)", 1)
    above = F.regexp_extract(directory, r"(?i)^/((?:DB|DC)\d+)", 1)
    return F.when(own.rlike("(?i)^(DB|DC)") | (above == ""), F.nullif(own, F.lit(""))).otherwise(above)


def material(path: Column, strict: bool = False) -> Column:
    """The artefact kind that a path tells. ``strict``: whatever is not one of the first kinds is Hout, and Bouwaardewerk is Aardewerk."""
    low = F.lower(path)
    order = [m for m in MATERIALS if not (strict and m[0] in ("Bouwaardewerk", "Hout", "Metaal", "Munt", "Schelp", "Textiel"))]
    out = F.lit("Hout" if strict else None)
    for kind, words in reversed(order):
        fits = low.contains(words[0])
        for w in words[1:]:
            fits = fits & low.contains(w)
        out = F.when(fits, kind).otherwise(out)
    return out


def groups(name: Column, pattern: str, *numbers: int) -> Column:
    """The named groups of a pattern's first match, found by one match; empty where a group took no part."""
    return F.split(F.regexp_replace(name, rf"(?s)^.*?(?:{pattern}).*$", "\u0001".join(f"${k}" for k in numbers)), "\u0001", -1)


def classify(name: Column, full_name: Column, directory: Column, file_type: Column, strict: bool = False) -> Column:
    """struct<FIELDS> of a file. The first shape that fits decides: document, object photo, drawing, project photo, report, "tekening" in the name, other."""
    read = F.struct(single_extension(name).alias("name"), full_name.alias("full"), directory.alias("directory"), F.lower(file_type).alias("type"))
    return bind(read, lambda f: shaped(f, strict))


def shaped(f: Column, strict: bool) -> Column:
    def kind(**values: Column | str) -> Column:
        return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).cast("string").alias(n) for n in FIELDS for v in [values.get(n)]])

    by_letter = lambda table, of, other: F.coalesce(*[F.when(of == k, v) for k, v in table.items()], F.lit(other))
    at = lambda g, k: F.get(g, F.lit(k))
    number = lambda v: F.when(v != "", no_zeros(v))
    counted = lambda v: padded(F.regexp_replace(v, "^0+(?=[0-9])", ""))
    project = project_of(f["name"], f["directory"])

    def drawing(g: Column) -> Column:
        code = F.when(at(g, 1).rlike("^[0-9]+$"), counted(at(g, 1))).otherwise(at(g, 1))
        return kind(soort="Tekening", fototype=at(g, 0), bestandsoort=by_letter(DRAWINGS, at(g, 0), "Overige_tekening"), projectcd=project, tekeningcd=F.concat(at(g, 0), code))

    def report(g: Column) -> Column:
        sort = F.when(at(g, 0).contains("DAR"), "Archeologische_Rapportage").otherwise("Archeologische_Notitie")
        return kind(soort="Rapport", fototype="R", bestandsoort=sort, rapportnr=F.concat(at(g, 0), counted(at(g, 1))))

    def of_object(g: Column) -> Column:
        return kind(soort="Foto", fototype="H", bestandsoort="Objectfoto", projectcd=project, putnr=number(at(g, 0)), vondstnr=number(at(g, 1)), subnr=number(at(g, 2)), fotonr=number(at(g, 3)), artefactsoort=material(f["full"], strict))

    def of_project(g: Column) -> Column:
        return kind(soort="Foto", fototype=at(g, 0), bestandsoort=by_letter(PHOTOS, at(g, 0), "Overige_afbeelding"), projectcd=project, fotonr=no_zeros(at(g, 1)))

    drawn = F.lower(f["name"]).contains("tekening") & ~F.lower(f["name"]).contains("aantekening")
    return (
        F.when(f["type"].isin(".doc", ".docx"), kind(soort="Rapport", fototype="R", bestandsoort="Overige_Rapportage", rapportnr=f["full"]))
        .when(f["name"].rlike(OBJECT_PHOTO), bind(groups(f["name"], OBJECT_PHOTO, 3, 4, 6, 7), of_object))
        .when(f["name"].rlike(DRAWING), bind(groups(f["name"], DRAWING, 2, 3), drawing))
        .when(f["name"].rlike(PROJECT_PHOTO), bind(groups(f["name"], PROJECT_PHOTO, 2, 3), of_project))
        .when(f["name"].rlike(REPORT), bind(groups(f["name"], REPORT, 1, 2), report))
        .when(drawn, kind(soort="Tekening", fototype="T", bestandsoort="Overige_tekening", projectcd=project, tekeningcd=f["full"]))
        .otherwise(kind(soort="Bestand", fototype="N", bestandsoort="Bestand_Overige", projectcd=project))
    )


def directory_tokens(directory: Column) -> Column:
    return F.split(directory, "[/ ]")


def photo_kind(directory: Column) -> Column:
    """struct<fotosoort, materiaal> that a directory tells; the material of object photos is its last segment."""
    low = F.lower(directory)
    of_object = low.contains("objectfoto") | low.contains("h object")
    kind = F.when(of_object, "Objectfoto").when(low.contains("opgravingsfoto"), "Opgravingsfoto").when(low.contains("velddocument"), "Velddocument").otherwise("Overige_afbeelding")
    return F.struct(kind.alias("fotosoort"), F.when(of_object, F.element_at(F.split(directory, "/"), -1)).alias("materiaal"))


def photo_sort(photo_type: Column, directory: Column) -> Column:
    """The sort of a photo by its type's letter and by its directory; a directory counts more, and of directories field documents do."""
    low = F.lower(directory)
    return F.when(low.contains("velddocument"), "Velddocument").when(low.contains("h object"), "Objectfoto").when(photo_type == "H", "Objectfoto").when(photo_type == "G", "Opgravingsfoto").otherwise("Overige_afbeelding")
