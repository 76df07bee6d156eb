"""What the entities are: keys, references, and how each of them passes through the cycle."""

from __future__ import annotations

from dataclasses import dataclass, field

#: The key of a find, with the pit only where a project reuses its find numbers.
FIND = "P:projectcd vondstkey_met_putnr?P:putnr V:vondstnr"

#: Kinds of artefacts; each is harmonised by itself and stored as an Artefact.
ARTEFACTS = ("Aardewerk", "Dierlijk_Bot", "Glas", "Hout", "Bouwaardewerk", "Kleipijp", "Leer", "Menselijk_Bot", "Metaal", "Munt", "Schelp", "Steen", "Textiel", "Onbekend")
#: Kinds of files, which are stored as Bestand.
FILES = ("Foto", "Tekening", "Rapport")


@dataclass(frozen=True)
class Spec:
    """Patterns of an entity's own key and of the keys of what it refers to; whether its duplicates are merged (by which
    columns), and the fields from which missing ones are generated, with the one that must not be 0."""

    soort: str
    key: str | None = None
    references: dict[str, str] = field(default_factory=dict)
    merge_by: tuple[str, ...] = ()
    missing: tuple[str, ...] = ()
    not_zero: str = ""

    def patterns(self) -> dict[str, str]:
        own = {"key": self.key} if self.key else {}
        return own | {f"key_{name}": pattern for name, pattern in self.references.items()}


PROJECT = {"project": "P:projectcd"}
PIT = {"put": "P:projectcd P:putnr"}
LAYER = {"vlak": "P:projectcd [P:putnr] V:vlaknr"}
TRACE = {"spoor": "P:projectcd [P:putnr] [V:vlaknr] S:spoornr"}
BOX = {"doos": "P:projectcd D:doosnr"}
VONDST = {"vondst": FIND}
ARTEFACT = {"artefact": "P:projectcd [P:putnr] V:vondstnr A:artefactnr"}
SUBNR = {"subnr": "P:projectcd S:subnr artefactsoort?A:artefactsoort"}
PHOTO = {
    "foto1": "P:projectcd P:putnr V:vondstnr S:subnr",
    "foto2": "P:projectcd V:vondstnr S:subnr",
    "foto3": "P:projectcd S:subnr",
}

# The segments of all keys.
SPECS = (
    Spec("Put", "P:projectcd P:putnr", PROJECT, missing=("projectcd", "putnr"), not_zero="putnr"),
    Spec("Vlak", "P:projectcd [P:putnr] V:vlaknr", PROJECT | PIT, missing=("projectcd", "putnr", "vlaknr"), not_zero="vlaknr"),
    Spec("Spoor", "P:projectcd [P:putnr] [V:vlaknr] S:spoornr", PIT | LAYER | PROJECT | VONDST, missing=("projectcd", "putnr", "vlaknr", "spoornr"), not_zero="spoornr"),
    Spec("Vulling", "P:projectcd [P:putnr] [V:vlaknr] [S:spoornr] V:vullingnr", PIT | LAYER | PROJECT | VONDST),
    Spec("Stelling", "S:stelling"),
    Spec(
        "Artefact",
        "P:projectcd [P:putnr] V:vondstnr A:artefactnr [S:splitid]",
        BOX | PROJECT | {"abr_materiaal": "A:abr_materiaal", "abr_submateriaal": "A:abr_submateriaal"} | PIT | {"subnr": "P:projectcd S:subnr"} | PHOTO | {"tekening": "P:projectcd T:tekeningcd"} | VONDST,
        merge_by=("key_subnr", "artefactsoort"),
    ),
    Spec("Monster", "M:monstercd", BOX | PROJECT | PIT | TRACE | VONDST, merge_by=("key",)),
    Spec("Monster_Schelp", "M:monstercd ID:Id", {"monster": "M:monstercd", "dt_soort_schelp": "SCH:soort_schelp"}),
    Spec("Monster_Botanie", "M:monstercd ID:Id", {"monster": "M:monstercd", "dt_soort_plant": "PL:soort_botanie", "dt_soort_deel": "DL:deel", "dt_soort_staat": "ST:staat"}),
    Spec("Standplaats", "S:stelling [V:vaknr] [L:volgletter]", {"stelling": "S:stelling"}),
    Spec("Project", "P:projectcd"),
    Spec("Vindplaats"),
    Spec("Vondst", FIND, LAYER | PIT | PROJECT, merge_by=("key",), missing=("projectcd", "putnr", "vondstnr", "vondstkey_met_putnr"), not_zero="vondstnr"),
    Spec("Foto", "P:projectcd [P:putnr] [V:vondstnr] [A:artefactnr] [S:fotonr]", ARTEFACT | {"subnr": "P:projectcd S:subnr"} | VONDST | PHOTO | PROJECT),
    Spec("Fotobeschrijving", None, VONDST),
    Spec("Fotokoppel"),
    Spec("Tekening", "P:projectcd T:tekeningcd", {"tekening": "P:projectcd T:tekeningcd"} | ARTEFACT | {"subnr": "P:projectcd S:subnr"} | VONDST | PROJECT | PIT | TRACE, merge_by=("key",)),
    Spec("Rapport", "R:rapportnr", {"rapport": "R:rapportnr"} | PROJECT, merge_by=("key",)),
    Spec("Bestand", "B:rapportnr", {"rapport": "R:rapportnr"} | PROJECT),
    Spec("Plaatsing", None, {"standplaats": "S:stelling [V:vaknr] [L:volgletter]"} | BOX),
    Spec("Doos", "P:projectcd D:doosnr", {"stelling": "S:stelling"} | PROJECT, missing=("projectcd", "doosnr"), not_zero="doosnr"),
    Spec("ABR", "A:uri"),
    Spec("DT_Soort_Plant", "PL:code"),
    Spec("DT_Soort_Schelp", "SCH:wetenschappelijke_naam"),
    Spec("DT_Soort_Deel", "DL:code"),
    Spec("DT_Soort_Staat", "ST:code"),
)
BY_SOORT = {s.soort: s for s in SPECS}

#: References that are resolved, in order: child's key column, the soort it means, the parent's key column, target, and whether only a single match counts.
REFERENCES = (
    ("key_project", "Project", "key", "projectID", False),
    ("key_put", "Put", "key", "putID", False),
    ("key_vlak", "Vlak", "key", "vlakID", False),
    ("key_spoor", "Spoor", "key", "spoorID", False),
    ("key_vondst", "Vondst", "key", "vondstID", False),
    ("key_stelling", "Stelling", "key", "stellingID", False),
    ("key_doos", "Doos", "key", "doosID", False),
    ("key_standplaats", "Standplaats", "key", "standplaatsID", False),
    ("key_monster", "Monster", "key", "monsterID", False),
    ("key_foto1", "Artefact", "key_foto1", "artefactID", False),
    ("key_foto3", "Artefact", "key_foto3", "artefactID", True),
    ("key_abr_materiaal", "ABR", "key", "abr_materiaalID", False),
    ("key_abr_submateriaal", "ABR", "key", "abr_submateriaalID", False),
    ("key_dt_soort_schelp", "DT_Soort_Schelp", "key", "dt_soort_schelpID", False),
    ("key_dt_soort_plant", "DT_Soort_Plant", "key", "dt_soort_plantID", False),
    ("key_dt_soort_deel", "DT_Soort_Deel", "key", "dt_soort_deelID", False),
    ("key_dt_soort_staat", "DT_Soort_Staat", "key", "dt_soort_staatID", False),
)

#: Columns that hold whole numbers; those of the second list keep what is no number as text.
INTS = (
    "aantal", "artefactnr", "subnr", "putnr", "spoornr", "vondstnr", "vullingnr", "doosnr", "jaar", "conserveren", "weggegooid", "artefactdatering_vanaf", "artefactdatering_tot",
    "vondstdatering_vanaf", "vondstdatering_tot", "spoordatering_vanaf", "spoordatering_tot", "vakno", "splitid", "Id",
)
LOOSE_INTS = ("vlaknr", "fotonr", "fotosubnr", "volgnr")
FLAGS = ("restauratie", "exposabel", "conservering", "uitgeleend", "definitief", "rob", "kb", "archief", "aangelegd")
DATES = ("datum",)
#: Free-text dates and what they become; the first only where it has no year yet.
DATINGS = {"artefactdatering": "artefactdatering", "vondstdatering": "vondstdatering", "spoordatering": "spoordatering"}
LABELS = ("typevoorwerp", "functievoorwerp", "origine", "materiaal", "subcategorie")

#: Attributes of the published tables that the cycle itself makes or reads; a user's own declaration may add more.
DECLARED = {
    "Project": "ID bigint, key string, soort varchar(80), projectcd varchar(12), projectnaam varchar(1024), jaar int, toponiem varchar(1024), trefwoorden varchar(1024), xcoor_rd double, ycoor_rd double, longitude double, latitude double",
    "Put": "ID bigint, key string, soort varchar(80), putnr int, beschrijving string, projectID bigint",
    "Vlak": "ID bigint, key string, soort varchar(80), vlaknr varchar(50), beschrijving string, projectID bigint, putID bigint",
    "Spoor": "ID bigint, key string, soort varchar(80), vlaknr varchar(1024), spoornr int, aard varchar(1024), spoordatering_vanaf int, spoordatering_tot int, projectID bigint, putID bigint, vlakID bigint",
    "Vondst": "ID bigint, key string, soort varchar(80), vlaknr varchar(1024), vondstnr int, vondstdatering_vanaf int, vondstdatering_tot int, projectID bigint, putID bigint, spoorID bigint",
    "Artefact": "ID bigint, key string, soort varchar(80), artefactnr int, artefactsoort string, typevoorwerp varchar(1024), subnr int, putnr int, artefactdatering_vanaf int, artefactdatering_tot int, aantal int, gewicht varchar(1024), projectID bigint, putID bigint, vondstID bigint, doosID bigint, abr_materiaalID bigint, abr_submateriaalID bigint",
    "Doos": "ID bigint, key string, soort varchar(80), doosnr int, inhoud string, projectcd varchar(12), stelling string, uitgeleend boolean, vaknr int, volgletter string, stellingID bigint, projectID bigint",
    "Bestand": "ID bigint, key string, soort varchar(80), bestandsoort string, fototype varchar(1), projectcd varchar(12), fileName varchar(1024), directory string, fileType varchar(32), putnr int, vondstnr int, subnr int, fotonr int, projectID bigint, artefactID bigint",
}
